"""Connected components of a table of links, by rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.session import drop_stage, written_stage


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, component`` for every node of ``links (a, b)``; component is the smallest node reached.

    Rounds alternate the large-star and small-star steps: each node links its larger
    neighbours, then all its neighbours, to the smallest of them, until every node hangs on its
    component's smallest node.  Nothing is gathered by node.  Every table that a join reads is
    written first, so both sides of the join are plain exchanges, of which Spark splits those of hub
    nodes; the tables of a round are removed with it.  No links give no rows.
    """
    spark = links.sparkSession
    edges, path = written_stage(links.select("a", "b").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    for _ in range(max_rounds):
        old = [path]
        # large star: a's larger neighbours hang on the smallest of a and its neighbours
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low, p = written_stage(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        old.append(p)
        large, p = written_stage(both.filter("b > a").join(low, "a").select(F.col("m").alias("a"), "b").distinct())
        old.append(p)
        # small star: from each node's smaller neighbours, all hang on the smallest
        least, p = written_stage(large.groupBy("b").agg(F.min("a").alias("m"), F.count("*").alias("n")))
        old.append(p)
        more = large.join(least.filter("n > 1"), "b").filter("a > m").select(F.col("m").alias("a"), F.col("a").alias("b"))
        edges, path = written_stage(least.select(F.col("m").alias("a"), "b").unionByName(more).distinct())
        for o in old:
            drop_stage(spark, o)
        # stars are left when every larger end hangs on one node, and that node on none
        n = edges.agg(F.count("*").alias("n"), F.count_distinct("b").alias("nodes")).first()
        if n["n"] == n["nodes"] and edges.join(edges.select(F.col("b").alias("a")), "a", "left_semi").isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("a").alias("node")).distinct()
    return edges.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
