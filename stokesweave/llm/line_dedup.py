"""Removal of boilerplate lines by the number of distinct sites they stand on.

1. A HyperLogLog sketch of the sites per line hash is built from the raw lines and merged by one aggregation.
2. Lines whose estimate lies near the threshold get an exact distinct count; no other line does.
3. Lines at or over the threshold are removed from their documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.llm.common import text_of
from stokesweave.session import cut_lineage

LG_K = 10  # registers of a sketch, as a power of two; standard error about 1.04 / sqrt(2**LG_K)


def _lines(df: DataFrame, site: str, text: str, *more: Column) -> DataFrame:
    """``more``, position, hash of the trimmed line and of the site for each line with visible characters."""
    names = df.select(*more).columns
    rows = df.select(*more, F.xxhash64(F.col(site)).alias("site"), F.posexplode(F.split(text_of(text), "\n")).alias("at", "line"))
    return rows.filter(F.trim("line") != "").select(*names, "site", "at", F.xxhash64(F.trim("line")).alias("line"))


def boilerplate_lines(df: DataFrame, min_sites: int = 10, site: str = "source", text: str = "text", band: float | None = None) -> DataFrame:
    """``line, sites``: hashes of the lines that stand on at least ``min_sites`` distinct sites.

    ``sites`` is exact for lines within ``band`` (a share of the threshold; five standard errors unless given)
    of the threshold and the sketch's estimate for those above it.  Null sites count as one site.
    """
    if band is None:
        band = 5 * 1.04 / 2 ** (LG_K / 2)
    known = df.filter(F.col(text).isNotNull())
    lines = _lines(known, site, text).select("line", "site")
    # sketches merge before the shuffle, so a line on many documents leaves one row for each task
    sketches = lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LG_K))).alias("sites"))
    estimated = cut_lineage(sketches.filter(F.col("sites") >= min_sites * (1 - band)))
    unsure = estimated.filter(F.col("sites") <= min_sites * (1 + band)).select("line")
    exact = lines.join(unsure, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("sites")).filter(F.col("sites") >= min_sites)
    return estimated.filter(F.col("sites") > min_sites * (1 + band)).unionByName(exact)


def remove_boilerplate(df: DataFrame, min_sites: int = 10, most_removed: float | None = None, site: str = "source", text: str = "text") -> DataFrame:
    """All rows and columns of ``df``, boilerplate lines removed from the text, with ``n_lines`` and ``n_removed``.

    A document all of whose visible lines are boilerplate is a copy of other documents rather than a page with
    boilerplate on it; it keeps its lines, so no document is emptied, and the near-duplicate stage decides on it.
    With ``most_removed``, so does every document of which the removed lines make up more than that share of the
    characters, lines of its own or not.  Blank lines stay.  Null texts stay null
    with no lines; repeated rows are handled alike.  Columns named ``n_lines`` or ``n_removed`` in the input
    are replaced.
    """
    lines = boilerplate_lines(df, min_sites, site, text).select("line")
    found = cut_lineage(lines)
    value = F.xxhash64(text_of(text))
    where = _lines(df, site, text, value.alias("key")).join(found, "line", "left_semi").groupBy("key").agg(F.collect_set("at").alias("marked"))
    names = [c for c in df.columns if c not in ("n_lines", "n_removed")]
    # the row travels as one column, so its names meet no others; its text is split only behind the join
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), value.alias("key"))
    left = F.filter("parts", lambda line, at: F.col("marked").isNull() | ~F.array_contains("marked", at))
    joined = rows.join(where, "key", "left").withColumn("whole", F.col("row").getField(text)).withColumn("parts", F.split("whole", "\n")).withColumn("left", left).withColumn("shorter", F.array_join("left", "\n"))
    if most_removed is None:
        fits = F.exists("left", lambda line: F.trim(line) != "")
    else:
        fits = F.length("whole") - F.length("shorter") <= most_removed * F.length("whole")
    decided = joined.withColumn("cut", F.coalesce(F.col("marked").isNotNull() & fits, F.lit(False)))
    return decided.select(
        *[F.when(F.col("cut"), F.col("shorter")).otherwise(F.col("whole")).alias(c) if c == text else F.col("row").getField(c).alias(c) for c in names],
        F.coalesce(F.size("parts"), F.lit(0)).cast("bigint").alias("n_lines"),
        F.when(F.col("cut"), F.size("marked")).otherwise(0).cast("bigint").alias("n_removed"),
    )


def oracle(min_sites: int = 10, most_removed: float = 0.5) -> str:
    """DuckDB SQL of the ``op4`` query."""
    return f"""
WITH lines AS (
  SELECT doc_id, source, i, string_split(text, chr(10))[i] AS line
  FROM (SELECT doc_id, source, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)
),
bad AS (
  SELECT trim(line) AS line FROM lines WHERE trim(line) <> '' GROUP BY 1 HAVING COUNT(DISTINCT COALESCE(source, chr(0))) >= {min_sites}
),
cut AS (
  SELECT doc_id, COUNT(*) AS n_lines, SUM(CASE WHEN b.line IS NULL THEN 0 ELSE 1 END) AS n_removed,
         string_agg(CASE WHEN b.line IS NULL THEN l.line END, chr(10) ORDER BY i) AS shorter
  FROM lines l LEFT JOIN bad b ON trim(l.line) = b.line GROUP BY doc_id
)
SELECT d.doc_id, CASE WHEN c.ok THEN c.shorter ELSE d.text END AS text, CAST(COALESCE(c.n_lines, 0) AS BIGINT) AS n_lines,
       CAST(CASE WHEN c.ok THEN c.n_removed ELSE 0 END AS BIGINT) AS n_removed
FROM documents d LEFT JOIN (
  SELECT cut.doc_id, cut.n_lines, cut.n_removed, COALESCE(cut.shorter, '') AS shorter,
         cut.n_removed > 0 AND length(t.text) - length(COALESCE(cut.shorter, '')) <= {most_removed} * length(t.text) AS ok
  FROM cut JOIN documents t USING (doc_id)
) c USING (doc_id)
"""
