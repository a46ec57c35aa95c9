"""Keyed building blocks: one row per key, semi/anti joins, set operations and
an equi-join that splits hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.session import cut_lineage

HOT_ROWS = 200_000
PAIRS_PER_ROW = 500  # pairs of a task, as a multiple of the rows of a slice: 10**8
BROADCAST_KEYS = 500_000  # hot keys that are broadcast; more of them are joined by a shuffle
SALTS = 64


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], aggregate) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    ranked = df.select(
        *keys,
        F.struct(*rest).alias("_row"),
        F.struct(*[F.col(o) if isinstance(o, str) else o for o in order]).alias("_rank"),
    )
    best = ranked.groupBy(*keys).agg(aggregate("_row", "_rank").alias("_row"))
    return best.select(*keys, "_row.*").select(df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the highest ``order`` tuple per key.

    An aggregate, not a window: map-side combine leaves one row per key and task
    before the shuffle, so a hot key costs no more than a cold one.
    """
    return _pick(df, keys, order, F.max_by)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Row with the lowest ``order`` tuple per key (explicit order, never storage order)."""
    return _pick(df, keys, order, F.min_by)


def in_ids(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key appears in ``ids``."""
    return df.join(ids, on, "left_semi")


def not_in_ids(df: DataFrame, ids: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows whose key does not appear in ``ids``."""
    return df.join(ids, on, "left_anti")


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Stack by name; columns missing from one input become NULL."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def with_scalars(rows: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row aggregate to every row (scalar subquery, no join)."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return rows.withColumn("_s", packed).select(*rows.columns, "_s.*")


def limit_sources(df: DataFrame, key: str, n: int) -> DataFrame:
    """First ``n`` rows in key order (TakeOrderedAndProject)."""
    return df.orderBy(key).limit(n)


def hot_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], hot_rows: int) -> DataFrame | None:
    """Keys whose rows on a side, or whose pairs, are too many for one task, and the slices each side
    needs (``_cl``, ``_cr``); None when there are none.

    A pair of slices holds at most ``hot_rows`` rows of a side and ``hot_rows * PAIRS_PER_ROW`` pairs.  Where both
    sides are large they are cut alike, which repeats the fewest rows; else the larger one is.
    Only the key columns are read and counts are combined before the shuffle.
    """
    pairs = float(hot_rows * PAIRS_PER_ROW)
    n_left = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nl"))
    n_right = right.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr"))

    def slices(own: str, other: str) -> Column:
        rows = F.least(F.lit(float(hot_rows)), F.greatest(F.lit(pairs**0.5), F.lit(pairs) / F.col(other)))
        return F.ceil(F.col(own) / rows).cast("int")

    cuts = cut_lineage(
        n_left.join(n_right, list(keys))
        .where((F.col("_nl") > hot_rows) | (F.col("_nr") > hot_rows) | (F.col("_nl").cast("double") * F.col("_nr") > pairs))
        .select(*keys, slices("_nl", "_nr").alias("_cl"), slices("_nr", "_nl").alias("_cr"))
    )
    return None if cuts.isEmpty() else cuts


def join_hot(df: DataFrame, keys: Sequence[str], cuts: DataFrame, small: bool, how: str) -> DataFrame:
    """Join rows with the table of hot keys: by broadcast where its size was found small, else salted, as its keys are the hot ones."""
    if small:
        return df.join(F.broadcast(cuts), list(keys), how)
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)))
    spread = cuts.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return salted.join(spread, [*keys, "_salt"], how).drop("_salt")


def small_side(df: DataFrame) -> DataFrame:
    """Marked for a broadcast where a count finds it small, so that the other side is not shuffled."""
    return F.broadcast(df) if df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS else df


def slice_hot_keys(
    left: DataFrame, right: DataFrame, keys: Sequence[str], cuts: DataFrame, small: bool = True
) -> tuple[DataFrame, DataFrame, list[str]]:
    """The rows of hot keys, spread over many tasks for an inner equi-join.

    Each side of a hot key is cut into slices and repeated once per slice of the
    other side, so every pair still meets exactly once.  Slices go by a row's number in a written stage, so
    equal rows spread too and a task that runs twice cuts alike.
    """
    keys = list(keys)

    def sliced(df: DataFrame, own: str, own_slice: str, other: str, other_slice: str) -> DataFrame:
        rows = cut_lineage(join_hot(df, keys, cuts, small, "inner"))
        return (
            rows.withColumn(own_slice, F.pmod(F.monotonically_increasing_id(), F.col(own).cast("long")).cast("int"))
            .withColumn(other_slice, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
            .drop("_cl", "_cr")
        )

    return (
        sliced(left, "_cl", "_sl", "_cr", "_sr"),
        sliced(right, "_cr", "_sr", "_cl", "_sl"),
        keys + ["_sl", "_sr"],
    )


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    condition: Column | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Inner equi-join that slices hot keys.

    One count per key decides; without hot keys, or with ``hot_rows=None``, it is
    a plain join.  Else the rows of hot keys are joined apart from the others.
    """
    keys = list(keys)
    cuts = None if hot_rows is None else hot_keys(left, right, keys, hot_rows)
    if cuts is None:
        out = left.join(right, keys)
    else:
        small = cuts.count() <= BROADCAST_KEYS
        a, b, on = slice_hot_keys(left, right, keys, cuts, small)
        hot = a.join(b, on).drop("_sl", "_sr")
        cold = [join_hot(df, keys, cuts.select(*keys), small, "left_anti") for df in (left, right)]
        out = cold[0].join(cold[1], keys).unionByName(hot)
    return out if condition is None else out.where(condition)
