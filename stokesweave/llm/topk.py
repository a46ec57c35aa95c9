"""Exact top-k inner products by the threshold algorithm over sorted per-dimension lists.

Rows are dealt to stripes and queries to groups, both of bounded size; a task holds one group and streams one
stripe in blocks.  A block keeps, for each dimension, its rows sorted by that component.  The queries of a group read
the lists in step from both ends and score the rows they meet, all active queries at once.  No unseen row can
score more than the sum of what the lists stand at, on the side where a query's component gains most, so a
query stops in a block when that bound is below its kth score.  The kth score is carried from block to block, so
later blocks start from it.  The stripes' results are merged per query.

Scores are integers.  They are computed as doubles where none can reach 2**53, as 64-bit integers
where none can reach 2**63, else as integers of any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.session import cut_lineage


def integer_vectors(df: DataFrame, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, v``: floor(scale * x) of each component as double.

    Vectors that are null or empty, or hold null or non-finite components, are left out, as are null keys.
    A floor of 2**63 or more in size is no long and raises an error.
    """
    x = F.col(vector).cast("array<double>")
    bad = F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    known = df.select(F.col(key).alias("key"), x.alias("x")).filter(F.col("key").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0))

    def whole(e: Column) -> Column:
        y = F.lit(scale) * e
        return F.when(F.abs(y) < 2.0**63, F.floor(y)).otherwise(F.raise_error(F.lit("a scaled component does not fit 64 bits")).cast("bigint"))

    return known.filter(~bad).select("key", F.transform("x", whole).alias("v"))


class SortedLists:
    """The rows of a block and, for each dimension, their order by that component."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        n, width = rows.shape
        order = np.argsort(rows, axis=0, kind="stable")
        self.sorted = np.take_along_axis(rows, order, axis=0)
        # the depth at which some list first shows a row, from either end
        place = np.empty_like(order)
        np.put_along_axis(place, order, np.broadcast_to(np.arange(n)[:, None], (n, width)), axis=0)
        first = np.minimum(place, n - 1 - place).min(axis=1)
        met = np.argsort(first, kind="stable")
        self.first, self.keys, self.rows = first[met], keys[met], rows[met]


class TopK:
    """The best ``k`` rows so far of a group of queries."""

    def __init__(self, keys: np.ndarray, vectors: np.ndarray, k: int) -> None:
        self.keys, self.vectors, self.k = keys, vectors, k
        self.gains, self.losses = np.maximum(vectors, 0), np.minimum(vectors, 0)
        self.unset = {"f": -np.inf, "i": -(2**63 - 1), "O": -float("inf")}[vectors.dtype.kind]
        self.scores = np.full((len(keys), k), self.unset, dtype=vectors.dtype)
        self.found = np.zeros((len(keys), k), dtype=np.int64)
        # rows and queries whose scores stand in memory at once
        self.slice_rows, self.slice_queries = (4096, 1024) if vectors.dtype != object else (512, 256)

    def search(self, block: SortedLists, first: int = 8) -> int:
        """Offer the rows of a block; the number of scores that were computed."""
        n, active = len(block.keys), np.arange(len(self.keys))
        depth, step, work = 0, first, 0
        while len(active):
            a, b = np.searchsorted(block.first, [depth, depth + step])
            for row in range(a, b, self.slice_rows):
                rows, keys = block.rows[row : min(b, row + self.slice_rows)], block.keys[row : min(b, row + self.slice_rows)]
                for at in range(0, len(active), self.slice_queries):
                    self._offer(active[at : at + self.slice_queries], keys, rows)
            work += len(active) * int(b - a)
            if b == n:
                break
            depth, step = depth + step, 2 * step
            # what an unseen row could score at most; one that equals the kth score may have a smaller key
            bound = self.gains[active] @ block.sorted[n - 1 - depth] + self.losses[active] @ block.sorted[depth]
            active = active[bound >= self.scores[active, -1]]
        return work

    def _offer(self, queries: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> None:
        scores = self.vectors[queries] @ rows.T
        own = self.keys[queries][:, None] == keys
        scores[own] = self.unset
        least = self.scores[queries, -1]
        if len(keys) > self.k and (least == self.unset).any():
            least = np.maximum(least, np.partition(scores, len(keys) - self.k, axis=1)[:, -self.k])
        at, row = np.nonzero((scores >= least[:, None]) & (scores > self.unset))
        if not len(at):
            return
        touched, at_touched = np.unique(at, return_inverse=True)
        changed = queries[touched]
        who = np.concatenate([np.repeat(np.arange(len(changed)), self.k), at_touched])
        score = np.concatenate([self.scores[changed].ravel(), scores[at, row]])
        key = np.concatenate([self.found[changed].ravel(), keys[row]])
        by = score if score.dtype != object else np.unique(score, return_inverse=True)[1]
        best = np.lexsort((key, -by, who))
        starts = np.searchsorted(who[best], np.arange(len(changed)))
        best = best[(starts[:, None] + np.arange(self.k)).ravel()]
        self.scores[changed] = score[best].reshape(-1, self.k)
        self.found[changed] = key[best].reshape(-1, self.k)

    def results(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the query, key and score of each row found."""
        query, rank = np.nonzero(self.scores > self.unset)
        return query, self.found[query, rank], self.scores[query, rank]


def top_k(queries: DataFrame, rows: DataFrame, k: int = 20, block_rows: int = 8192, group_queries: int = 32_768, stripe_rows: int = 262_144) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of largest inner product with each query.

    ``queries`` and ``rows`` hold ``key, v`` as ``integer_vectors`` gives them.  Rows with a query's own key are
    no candidates.  Ties go to the smaller key; rows with equal keys are candidates each for itself.  Fewer
    candidates give fewer rows, none give none.  Vectors shorter than the longest count as padded with zeros.
    Repeated queries are answered once; queries of one key with different vectors are answered each
    for itself, under the same ``query_id``.  A score in the answer that does not fit a long raises an error.
    """
    spark = rows.sparkSession
    # a written stage fixes the row ids, which spread repeated rows over stripes
    numbered = cut_lineage(rows.select("key", "v", F.xxhash64("key", F.monotonically_increasing_id()).alias("uid")))
    asked = cut_lineage(queries.select("key", "v").distinct().withColumn("query", F.monotonically_increasing_id()))

    def extent(df: DataFrame) -> tuple[int, int, int]:
        n, width, low, high = df.agg(F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
        return n, width or 1, max(abs(low or 0), abs(high or 0))

    (n_rows, rows_width, rows_size), (n_queries, queries_width, queries_size) = extent(numbered), extent(asked)
    width = max(rows_width, queries_width)
    largest = width * rows_size * queries_size
    kind = np.float64 if largest < 2**53 else np.int64 if largest < 2**63 - 1 else object
    groups = max(1, -(-n_queries // group_queries))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stripes = max(1, -(-n_rows // stripe_rows), min(-(-tasks // groups), -(-n_rows // block_rows)))

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint")))

    padded = F.concat("v", F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size("v"))).alias("v")
    # a cell is a stripe and a group: every group of queries reads its own copy of the rows, every stripe its own of the queries
    offered = numbered.select(F.pmod("uid", F.lit(stripes)).alias("stripe"), each(groups).alias("group"), F.lit(None).cast("bigint").alias("query"), "key", padded)
    asking = asked.select(each(stripes).alias("stripe"), F.pmod(F.xxhash64("query"), F.lit(groups)).alias("group"), "query", "key", padded)
    cells = offered.unionByName(asking).select((F.col("stripe") * groups + F.col("group")).alias("cell"), "query", "key", "v")

    out = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, asks, best, waiting = None, [], None, []

        def meet() -> None:
            nonlocal best
            if best is None:
                best = TopK(np.concatenate([a[1] for a in asks]), np.concatenate([a[2] for a in asks]), k)
            best.search(SortedLists(np.concatenate([w[0] for w in waiting]), np.concatenate([w[1] for w in waiting])))
            waiting.clear()

        def answers() -> Iterator[pa.RecordBatch]:
            if asks and waiting:
                meet()
            if best is None:
                return
            query, found, scores = best.results()
            numbers = np.concatenate([a[0] for a in asks])
            for i in range(0, len(query), 100_000):
                part = query[i : i + 100_000]
                whole = [int(s) for s in scores[i : i + 100_000]]
                yield pa.RecordBatch.from_arrays([pa.array(numbers[part]), pa.array(best.keys[part]), pa.array(found[i : i + 100_000]), pa.array(whole, pa.int64())], schema=out)

        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            ends = np.flatnonzero(np.diff(ids)) + 1
            for a, b in zip([0, *ends], [*ends, len(ids)]):
                if a == b:
                    continue
                if ids[a] != cell:
                    yield from answers()
                    cell, asks, best, waiting = ids[a], [], None, []
                piece = batch.slice(a, b - a)
                n_asks = len(piece) - piece.column(1).null_count  # queries stand before rows
                keys = piece.column(2).to_numpy(zero_copy_only=False).astype(np.int64)
                vectors = piece.column(3).flatten().to_numpy(zero_copy_only=False).reshape(len(piece), width)
                if kind is object:
                    vectors = np.array(vectors.tolist(), dtype=object).reshape(len(piece), width)
                else:
                    vectors = vectors.astype(kind)
                if n_asks:
                    asks.append((piece.column(1).slice(0, n_asks).to_numpy(zero_copy_only=False).astype(np.int64), keys[:n_asks], vectors[:n_asks]))
                if n_asks < len(piece) and asks:
                    waiting.append((keys[n_asks:], vectors[n_asks:]))
                    if sum(len(w[0]) for w in waiting) >= block_rows:
                        meet()
        yield from answers()

    ordered = cells.repartition(stripes * groups, "cell").sortWithinPartitions("cell", F.col("query").asc_nulls_last())
    best = ordered.mapInArrow(search, "query bigint, query_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
