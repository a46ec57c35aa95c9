"""Bottom-k sketches of documents' word shingles, in DataFrame operations only.

The sketch of a text is the ``k`` smallest distinct hashes of its shingles, in order.  The sketch of
a union is the ``k`` smallest of both sketches, so parts merge; sketches estimate resemblance,
containment and the number of distinct shingles.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.llm.common import text_of

WIDTH, K = 5, 128
LOWEST = -(2**63)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of the text's word shingles, lower-cased; of the whole sequence if it is shorter, none without words."""
    words = F.split(F.trim(F.regexp_replace(F.lower(text), r"\s+", " ")), " ")

    def rolling(w: Column) -> Column:
        last = F.greatest(F.size(w) - width, F.lit(0))
        hashes = F.transform(F.sequence(F.lit(0), last), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))
        return F.when((F.size(w) == 1) & (F.get(w, F.lit(0)) == ""), F.array().cast("array<bigint>")).otherwise(hashes)

    return let(words, rolling)


def sketch(text: Column, width: int = WIDTH, k: int = K) -> Column:
    """Smallest ``k`` distinct shingle hashes, ascending."""
    return F.slice(F.sort_array(F.array_distinct(shingles(text, width))), 1, k)


def distinct_shingles(s: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact while the sketch is not full."""
    reach = (F.element_at(s, -1).cast("double") - F.lit(float(LOWEST))) / F.lit(2.0**64)
    return F.when(F.size(s) < k, F.size(s).cast("double")).otherwise((k - 1) / reach)


def union(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of two sketched sets."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles, 0 to 1; two sets without shingles are alike."""
    return let(union(a, b, k), lambda both: _common(both, a, b))


def _common(both: Column, a: Column, b: Column) -> Column:
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(F.array_intersect(both, a), b)) / F.size(both))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set's shingles that the second holds, 0 to 1; an empty set is contained."""
    shared = let(union(a, b, k), lambda both: _common(both, a, b) * distinct_shingles(both, k))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), shared / distinct_shingles(a, k)))


def fingerprint(s: Column) -> Column:
    """The sketch as a string: its hashes as hex digits, 16 each."""
    return F.array_join(F.transform(s, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def merge(df: DataFrame, by: list[str], s: str = "sketch", k: int = K) -> DataFrame:
    """Sketch of the union of all sketches of a key: ``by, sketch``.

    Distinct hashes are ranked within the key; Spark keeps the ``k`` lowest of each task before
    the shuffle, so a key with a large share of the rows moves ``k`` hashes from each task.
    Null sketches count as empty; a key with empty sketches only has the empty sketch.
    """
    keys = df.select(*by).distinct()
    ranked = (
        df.select(*by, F.explode(s).alias("hash"))
        .distinct()
        .withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy("hash")))
        .filter(F.col("rank") <= k)
        .groupBy(*by)
        .agg(F.sort_array(F.collect_list("hash")).alias("merged"))
    )
    match = [keys[c].eqNullSafe(ranked[c]) for c in by]
    return keys.join(ranked, match, "left").select(*[keys[c] for c in by], F.coalesce("merged", F.array().cast("array<bigint>")).alias("sketch"))


def document_sketches(df: DataFrame, width: int = WIDTH, k: int = K, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_chars, sketch, n_shingles`` of every row; null texts count as empty."""
    t = text_of(text)
    return df.select(F.col(key), F.length(t).cast("bigint").alias("n_chars"), sketch(t, width, k).alias("sketch")).withColumn("n_shingles", distinct_shingles(F.col("sketch"), k))


def _ranges(df: DataFrame, key: str, ranges: int) -> tuple[list[int], list[int]]:
    """Lower bounds of at most ``ranges`` ranges of the key with like numbers of rows, and the smallest key in each."""
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(LOWEST))
    cuts = df.agg(F.percentile_approx(order, [i / ranges for i in range(1, ranges)], 10 * ranges)).first()[0] if ranges > 1 else []
    bounds = [LOWEST, *sorted(set(cuts or []) - {LOWEST})]
    least = {r["range"]: r["least"] for r in df.groupBy(_range_of(order, bounds).alias("range")).agg(F.min(order).alias("least")).collect()}
    held = [i for i in range(len(bounds)) if i in least]
    return [LOWEST] + [bounds[i] for i in held[1:]], [least[i] for i in held]


def _range_of(value: Column, bounds: list[int], group: int = 64) -> Column:
    """Number of the range of a value: first the group of bounds, then the bound within the group."""
    grouped = [bounds[i : i + group] for i in range(0, len(bounds), group)]
    literal = F.array(*[F.array(*[F.lit(b).cast("bigint") for b in g]) for g in grouped])
    at = F.size(F.filter(F.array(*[F.lit(g[0]).cast("bigint") for g in grouped]), lambda b: b <= value)) - 1
    return at * group + F.size(F.filter(F.get(literal, at), lambda b: b <= value)) - 1


def with_next(df: DataFrame, columns: list[str], key: str, tie: str, ranges: int) -> DataFrame:
    """Add ``next_<column>``: the value in the next row by ascending key, in the first row after the last.

    Rows are dealt to ranges of the key, one shuffle; a range also gets a copy of the first row of the
    range after it, which ends its window.  Only bounds and smallest keys, two numbers a range, pass the driver.
    Null keys come first, rows of one key follow each other by ``tie``.
    """
    bounds, least = _ranges(df, key, ranges)
    order = F.coalesce(F.col(key).cast("bigint"), F.lit(LOWEST))
    own = _range_of(order, bounds).alias("own")
    n = len(bounds)
    first = F.get(F.array(*[F.lit(x).cast("bigint") for x in least]), F.col("own")) == order
    places = F.array(F.struct(F.col("own").alias("range"), F.lit(False).alias("guest")))
    guest = F.array(F.struct(F.pmod(F.col("own") + n - 1, F.lit(n)).alias("range"), F.lit(True).alias("guest")))
    dealt = (
        df.withColumn("own", own)
        .withColumn("place", F.explode(F.when(first, F.concat(places, guest)).otherwise(places)))
        .withColumn("order", order)
    )
    window = Window.partitionBy("place.range").orderBy("place.guest", "order", tie)
    return (
        dealt.select("*", *[F.lead(c).over(window).alias(f"next_{c}") for c in columns])
        .filter("not place.guest")
        .drop("own", "place", "order")
    )


def edited_likeness(df: DataFrame, width: int = WIDTH, k: int = K, key: str = "doc_id", text: str = "text", ranges: int | None = None) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has the last quarter of its code points (rounded down) replaced by the first as
    many, or all, of the next document's.  Returns ``key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next, n_shingles, contained_in_edited``.  Null texts count as empty; texts without
    words have an empty fingerprint, alike to another empty one and to nothing else.
    Repeated rows each give a row; rows of one key follow each other by the hash of their text.
    """
    spark = df.sparkSession
    ranges = ranges or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = df.select(F.col(key).alias("key"), text_of(text).alias("text")).withColumn("tie", F.xxhash64("text")).withColumn("sketch", sketch(F.col("text"), width, k))
    follow = with_next(own, ["text", "sketch"], "key", "tie", ranges)
    moved = F.floor(F.length("text") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - moved), F.substring(F.col("next_text"), F.lit(1), moved))
    both = follow.select("key", F.length("text").cast("bigint").alias("n_chars"), "sketch", "next_sketch", edited.alias("edited"))
    done = both.select("key", "n_chars", "sketch", "next_sketch", F.sha2("edited", 256).alias("edited_sha256"), sketch(F.col("edited"), width, k).alias("edited_sketch"))
    return done.select(
        F.col("key").alias(key),
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("sketch")).alias("fingerprint"),
        fingerprint(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch"), k).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch"), k).alias("near_next"),
        distinct_shingles(F.col("sketch"), k).alias("n_shingles"),
        containment(F.col("sketch"), F.col("edited_sketch"), k).alias("contained_in_edited"),
    )
