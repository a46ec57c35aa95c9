"""Exact grouped order statistics whose cost does not depend on key skew.

``percentile`` keeps every distinct value of a group in one task.  Here a rank is found by distributed selection: a histogram between the
least and the greatest value tells the bucket that holds it, and so on within that bucket, until few values are left.  Rows collapse to
counts before every shuffle; no task sorts a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.functions.numeric import finite
from stokesweave.operators.keyed import with_scalars
from stokesweave.session import Stages

MAD_TO_STD = 1.482602218505602  # 1 / (0.75 quantile of the standard normal)
SMALL_BRACKET = 50_000  # values that are put in order at the end
BUCKETS = 4096


def _with_keys(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    return df.where(finite(value)).select(*keys, F.col(value).cast("double").alias("_v"))


def attach(rows: DataFrame, stats: DataFrame, keys: Sequence[str], few_groups: bool) -> DataFrame:
    """Join per-group statistics back to rows.

    ``few_groups`` states that the number of groups is bounded by a parameter
    (bins, channels), which is the bound the broadcast relies on.  Otherwise
    Spark chooses, and AQE splits skewed partitions.
    """
    if not keys:
        return with_scalars(rows, stats)
    return rows.join(F.broadcast(stats) if few_groups else stats, list(keys))


def _narrowed(rows: DataFrame, keys: list[str], state: DataFrame, few_groups: bool) -> DataFrame:
    """Brackets of more than ``SMALL_BRACKET`` values, opened once: each rank goes on in its bucket of ``BUCKETS``.

    Buckets divide a bracket evenly between its least and its greatest value, so both ends are in different ones and every round narrows.
    """
    wide = state.where((F.col("inside") > SMALL_BRACKET) & (F.col("lo") < F.col("hi")))
    brackets = wide.select(*keys, "lo", "hi").distinct()
    v, lo, hi = (F.col(c) / 2 for c in ("_v", "lo", "hi"))  # halves: the difference of the ends is finite
    inside = attach(rows, brackets, keys, few_groups).where(F.col("_v").between(F.col("lo"), F.col("hi")))
    part = F.least(F.floor((v - lo) / (hi - lo) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")
    bucket = F.when(hi - lo > 0, part).otherwise((F.col("_v") > F.col("lo")).cast("int"))
    found = inside.groupBy(*keys, "lo", "hi", bucket.alias("_k")).agg(F.count("*").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
    # at most ``BUCKETS`` rows a bracket
    over = Window.partitionBy(*keys, "lo", "hi").orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumn("_below", F.coalesce(F.sum("_n").over(over), F.lit(0)))
    here = F.col("rank") - F.col("before")
    picked = wide.join(found, [*keys, "lo", "hi"]).where((here >= F.col("_below")) & (here < F.col("_below") + F.col("_n")))
    opened = picked.select(*keys, "n", "w", "rank", F.col("_a").alias("lo"), F.col("_b").alias("hi"), (F.col("before") + F.col("_below")).alias("before"), F.col("_n").alias("inside"))
    return state.where((F.col("inside") <= SMALL_BRACKET) | (F.col("lo") >= F.col("hi"))).unionByName(opened)


def order_statistics(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Mapping[str, Column],
    few_groups: bool = False,
) -> DataFrame:
    """Values at 0-based ranks of the finite values of each group.

    ``wanted`` maps an output name to a rank, which may use the group size ``n``.  Returns the keys, ``n`` and one column
    per rank.  Every rank has a bracket, at first the whole group.  While any holds more than ``SMALL_BRACKET`` values the wide ones are narrowed by a
    histogram of the values in them; then the few that are left are counted in order.
    """
    group_keys = list(keys)
    few_groups = few_groups or not group_keys
    # keys go by names of their own, as those of a caller may be any
    keys = [f"__key{i}" for i in range(len(group_keys))] or ["__all"]
    named = [F.col(k).alias(a) for k, a in zip(group_keys, keys)] or [F.lit(1).alias("__all")]
    rows = df.where(finite(value)).select(*named, F.col(value).cast("double").alias("_v"))
    ends = rows.groupBy(*keys).agg(F.count("_v").alias("n"), F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    asked = F.explode(F.array(*[F.struct(F.lit(i).alias("w"), rank.cast("long").alias("rank")) for i, rank in enumerate(wanted.values())]))
    state = ends.select(*keys, "n", "lo", "hi", asked.alias("_r")).select(*keys, "n", "_r.*", "lo", "hi", F.lit(0).cast("long").alias("before"), F.col("n").alias("inside"))
    stages = Stages()
    state = stages.cut(state)
    narrow = None
    while not state.where((F.col("inside") > SMALL_BRACKET) & (F.col("lo") < F.col("hi"))).isEmpty():
        if narrow is None:  # later rounds read two columns
            rows = narrow = stages.cut(rows)
        state = stages.cut(_narrowed(rows, keys, state, few_groups))

    # ranks in one bracket share its values; a bracket of equal values needs none
    names = list(wanted)
    ranks = [F.max(F.when(F.col("w") == i, F.col("rank"))).alias(f"_r{i}") for i in range(len(names))]
    shared = state.where("lo < hi").groupBy(*keys, "lo", "hi").agg(F.max("n").alias("n"), F.max("before").alias("before"), *ranks)
    kept = attach(rows, shared, keys, few_groups).where(F.col("_v").between(F.col("lo"), F.col("hi")))
    told = ["n", "before", *[f"_r{i}" for i in range(len(names))]]
    counted = kept.groupBy(*keys, "lo", "_v").agg(F.count("*").alias("_c"), *[F.max(c).alias(c) for c in told])
    over = Window.partitionBy(*keys, "lo").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_upto", F.col("before") + F.sum("_c").over(over))

    def here(i: int) -> Column:
        return F.when((F.col(f"_r{i}") < F.col("_upto")) & (F.col(f"_r{i}") >= F.col("_upto") - F.col("_c")), F.col("_v"))

    met = ranked.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(here(i)).alias(name) for i, name in enumerate(names)])
    equal = state.where("lo >= hi").groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("w") == i, F.col("lo"))).alias(name) for i, name in enumerate(names)])
    both = met.unionByName(equal).groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(name).alias(name) for name in names])
    return both.select(*[F.col(a).alias(k) for k, a in zip(group_keys, keys)], "n", *names)


def grouped_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    quantiles: Mapping[str, float],
    few_groups: bool = False,
    bounded: bool = False,
) -> DataFrame:
    """Exact linearly interpolated quantiles of the finite values per group.

    ``bounded`` states that a group cannot grow with the data (channels of one
    spectrum); the built-in ``percentile`` does the same in one pass then.
    """
    keys = list(keys)
    if bounded:
        rows = _with_keys(df, keys, value)
        names = list(quantiles)
        agg = rows.groupBy(*keys).agg(
            F.count("_v").alias("n"), F.percentile("_v", [float(quantiles[k]) for k in names]).alias("_q")
        )
        return agg.select(*keys, "n", *[F.get("_q", F.lit(i)).alias(k) for i, k in enumerate(names)])

    n1 = F.col("n") - 1
    wanted: dict[str, Column] = {}
    for name, p in quantiles.items():
        wanted[f"_lo_{name}"] = F.floor(n1 * F.lit(float(p)))
        wanted[f"_up_{name}"] = F.ceil(n1 * F.lit(float(p)))
    stats = order_statistics(df, keys, value, wanted, few_groups)
    out = []
    for name, p in quantiles.items():
        part = n1 * F.lit(float(p)) - F.floor(n1 * F.lit(float(p)))
        lo, up = F.col(f"_lo_{name}"), F.col(f"_up_{name}")
        out.append((lo + (up - lo) * part).alias(name))
    return stats.select(*keys, "n", *out)


def grouped_median(df, keys, value, name="median", few_groups=False, bounded=False) -> DataFrame:
    return grouped_quantiles(df, keys, value, {name: 0.5}, few_groups, bounded)


def mad_std(
    df: DataFrame, keys: Sequence[str], value: str, few_groups: bool = False, bounded: bool = False
) -> DataFrame:
    """Median and robust standard deviation 1.4826 * median(|x - median|) per group."""
    keys = list(keys)
    med = grouped_median(df, keys, value, "median", few_groups, bounded)
    rows = _with_keys(df, keys, value)
    spread = attach(rows, med.drop("n"), keys, few_groups or not keys).select(
        *keys, "median", F.abs(F.col("_v") - F.col("median")).alias("_dev")
    )
    mad = grouped_median(spread, [*keys, "median"], "_dev", "_mad", few_groups, bounded)
    return mad.select(*keys, "n", "median", (F.col("_mad") * MAD_TO_STD).alias("mad_std"))


def trimmed_mean(
    df: DataFrame, keys: Sequence[str], value: str, fraction: float = 0.2, few_groups: bool = False
) -> DataFrame:
    """Mean after dropping int(fraction * n) values from each end of the group.

    The two cut values come from :func:`order_statistics`; values tied with a
    cut are counted, so no per-group sort is needed.
    """
    keys = list(keys)
    k = F.floor(F.col("n") * F.lit(float(fraction)))
    cuts = order_statistics(
        df,
        keys,
        value,
        {"_cut_lo": k, "_cut_hi": F.col("n") - 1 - k},
        few_groups,
    )
    rows = attach(_with_keys(df, keys, value), cuts, keys, few_groups or not keys)
    v, lo, hi = F.col("_v"), F.col("_cut_lo"), F.col("_cut_hi")
    sums = rows.groupBy(*keys, "n", "_cut_lo", "_cut_hi").agg(
        F.sum(F.when((v > lo) & (v < hi), v).otherwise(0.0)).alias("_mid"),
        F.count_if(v <= lo).alias("_le"),
        F.count_if(v < hi).alias("_lt"),
    )
    kept = F.col("n") - 2 * k
    at_lo = F.col("_le") - k
    at_hi = F.col("n") - k - F.col("_lt")
    total = F.when(lo == hi, lo * kept).otherwise(F.col("_mid") + lo * at_lo + hi * at_hi)
    return sums.select(*keys, "n", (total / kept).alias("trimmed_mean"))
