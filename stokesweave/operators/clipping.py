"""Iterative sigma clipping per group, to convergence or for a fixed number of passes."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.numeric import finite
from stokesweave.operators.keyed import with_scalars
from stokesweave.operators.orderstats import MAD_TO_STD, attach, mad_std
from stokesweave.session import cut_lineage

LIMITS = "centre double, scale double, lo double, hi double, n_kept long"
SMALL_GROUP = 20_000
BLOCK = 1024  # different values of a block of a large group
ROUND_BLOCKS = 3000  # blocks of a group whose values are brought in one round
FEW_BLOCKS = 64  # blocks that are brought at once
EVEN = 64  # places that stand for the values of a block by guess


def clip_array(values: np.ndarray, sigma: float, center: str, scale: str, maxiters: int | None):
    """Clip one finite sample; returns (centre, scale, lo, hi, n_kept).

    ``center`` is ``mean`` or ``median``; ``scale`` is ``std`` (population) or
    ``mad`` (normal-consistent).  The limits are those of the last pass.
    """
    kept = values
    mid = spread = lo = hi = np.nan
    passes = 0
    while kept.size and (maxiters is None or passes < maxiters):
        passes += 1
        mid = np.median(kept) if center == "median" else kept.mean()
        if scale == "mad":
            spread = MAD_TO_STD * np.median(np.abs(kept - np.median(kept)))
        else:
            spread = kept.std()
        lo, hi = mid - sigma * spread, mid + sigma * spread
        inside = kept[(kept >= lo) & (kept <= hi)]
        done = inside.size == kept.size
        kept = inside
        if done:
            break
    return mid, spread, lo, hi, kept.size


def clip_udf(sigma: float, center: str, scale: str, maxiters: int | None):
    """Column function over an array of finite values, returning the clip limits."""

    @F.pandas_udf(LIMITS)
    def limits(samples: pd.Series) -> pd.DataFrame:
        rows = [clip_array(np.asarray(s, dtype=float), sigma, center, scale, maxiters) for s in samples]
        return pd.DataFrame(rows, columns=["centre", "scale", "lo", "hi", "n_kept"])

    return limits


def _small_limits(rows: DataFrame, keys, sigma, center, scale, maxiters) -> DataFrame:
    gathered = rows.groupBy(*keys).agg(F.collect_list("_v").alias("_vals"))
    return gathered.select(*keys, clip_udf(sigma, center, scale, maxiters)("_vals").alias("_l")).select(*keys, "_l.*")


PACKED = "_g long, b_lo double, b_hi double, b_n long, b_mean double, b_m2 double, vals array<double>, counts array<long>"
STATE = "_g long, done boolean, centre double, scale double, lo double, hi double, n_kept long, _min double, _max double, _passes long, _need array<double>"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``_g, _v, _c`` in order, as blocks of up to ``BLOCK`` values: one row each, with its sums and its values."""
    names = [f.split()[0] for f in PACKED.split(", ")]
    types = [pa.int64(), *[pa.float64()] * 2, pa.int64(), *[pa.float64()] * 2, pa.list_(pa.float64()), pa.list_(pa.int64())]

    def blocks(g, v, c, last: bool):
        """Whole blocks, and where the rest begins."""
        out, at = [], 0
        ends = np.append(np.nonzero(np.diff(g))[0] + 1, len(g)) if len(g) else []
        for end in ends:
            while at < end and (end - at >= BLOCK or end < len(g) or last):
                to = min(at + BLOCK, end)
                x, n = v[at:to], c[at:to]
                mean = x[0] + np.sum(n * (x - x[0])) / n.sum()
                out.append((int(g[at]), x[0], x[-1], int(n.sum()), mean, np.sum(n * (x - mean) ** 2), x, n))
                at = to
        return out, at

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(list(col), t) for col, t in zip(zip(*rows), types)], names=names)

    held = (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64))
    for part in batches:
        held = tuple(np.concatenate([h, part.column(i).to_numpy(zero_copy_only=False)]) for i, h in enumerate(held))
        rows, at = blocks(*held, False)
        held = tuple(h[at:] for h in held)
        for i in range(0, len(rows), 256):
            yield batch(rows[i : i + 256])
    rows, _ = blocks(*held, True)
    if rows:
        yield batch(rows)


class _Blocks:
    """Blocks of one group in ascending order.  ``used`` are those whose values were asked for; ones not at hand are taken as evenly filled: a ``guess``."""

    def __init__(self, frame: pd.DataFrame) -> None:
        frame = frame.sort_values("b_lo")
        self.lo, self.hi, self.n, self.mean, self.m2 = (frame[c].to_numpy(dtype=float) for c in ("b_lo", "b_hi", "b_n", "b_mean", "b_m2"))
        self.vals, self.counts = frame["vals"].to_numpy(), frame["counts"].to_numpy()
        self.upto = np.concatenate([[0.0], np.cumsum(self.n)])
        self.used: dict[int, None] = {}
        self.guess = False

    def values(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if self.lo[i] == self.hi[i]:
            return self.lo[i : i + 1], self.n[i : i + 1]
        self.used.setdefault(i)
        if self.vals[i] is not None:
            return np.asarray(self.vals[i], dtype=float), np.asarray(self.counts[i], dtype=float)
        self.guess = True
        return np.linspace(self.lo[i], self.hi[i], EVEN), np.full(EVEN, self.n[i] / EVEN)

    def keep(self, least: float, most: float) -> float:
        """Hold the values in ``[least, most]``: the blocks ``a`` to ``b`` as a whole, the others by their values; their number."""
        a, b = int(np.searchsorted(self.hi, least)), int(np.searchsorted(self.lo, most, side="right"))
        self.span = (a, b)
        below, above = [], []
        self.ends = dict.fromkeys(())
        for i in dict.fromkeys((a, b - 1)) if a < b else ():
            if self.lo[i] < least or self.hi[i] > most:
                self.ends.setdefault(i)
                v, c = self.values(i)
                inside = (v >= least) & (v <= most)
                (below if i == a else above).append((v[inside], c[inside]))
                a, b = (a + 1, b) if i == a else (a, b - 1)
        self.a, self.b = a, max(a, b)
        self.below, self.above = below, above
        return float(self.upto[self.b] - self.upto[self.a] + sum(c.sum() for _, c in below + above))

    def spread(self) -> tuple[float, float]:
        """Mean and population deviation."""
        ends = [(v, c) for v, c in self.below + self.above if c.sum() > 0]
        own = [float(np.average(v, weights=c)) for v, c in ends]
        m = np.concatenate([self.mean[self.a : self.b], own])
        w = np.concatenate([self.n[self.a : self.b], [c.sum() for _, c in ends]])
        q = np.concatenate([self.m2[self.a : self.b], [np.sum(c * (v - x) ** 2) for (v, c), x in zip(ends, own)]])
        mean = m[0] + np.sum(w * (m - m[0])) / w.sum()
        return mean, float(np.sqrt((q.sum() + np.sum(w * (m - mean) ** 2)) / w.sum()))

    def _at(self, rank: float) -> float:
        for v, c in self.below:
            if rank < c.sum():
                return self._pick(v, c, rank)
            rank -= c.sum()
        if rank < self.upto[self.b] - self.upto[self.a]:
            i = min(int(np.searchsorted(self.upto, self.upto[self.a] + rank, side="right")) - 1, self.b - 1)
            return self._pick(*self.values(i), rank + self.upto[self.a] - self.upto[i])
        rank -= self.upto[self.b] - self.upto[self.a]
        v, c = self.above[0] if self.above else self.below[-1] if self.below else self.values(self.b - 1)
        return self._pick(v, c, rank)

    @staticmethod
    def _pick(v: np.ndarray, c: np.ndarray, rank: float) -> float:
        return float(v[min(int(np.searchsorted(np.cumsum(c), rank, side="right")), len(v) - 1)])

    @staticmethod
    def _middle(n: float, at: Callable[[float], float]) -> float:
        low = at(max(0.0, np.floor((n - 1) / 2)))
        return low + (at(max(0.0, np.ceil((n - 1) / 2))) - low) * ((n - 1) / 2 % 1.0)

    def median(self, n: float) -> float:
        return self._middle(n, self._at)

    def mad(self, n: float, mid: float) -> float:
        """Median distance from ``mid``; blocks that are nearer or farther as a whole are counted only."""
        ends = [(v, c) for v, c in self.below + self.above if len(v)]
        lo = np.concatenate([self.lo[self.a : self.b], [v[0] for v, _ in ends]])
        hi = np.concatenate([self.hi[self.a : self.b], [v[-1] for v, _ in ends]])
        w = np.concatenate([self.n[self.a : self.b], [c.sum() for _, c in ends]])
        far = np.maximum(np.abs(lo - mid), np.abs(hi - mid))
        near = np.where(lo > mid, lo - mid, np.where(hi < mid, mid - hi, 0.0))
        by_far, by_near = np.argsort(far), np.argsort(near)
        sum_far, sum_near = np.cumsum(w[by_far]), np.cumsum(w[by_near])

        def at(rank: float) -> float:
            top = far[by_far][min(int(np.searchsorted(sum_far, rank, side="right")), len(w) - 1)]
            low = near[by_near][min(int(np.searchsorted(sum_near, rank, side="right")), len(w) - 1)]
            parts = [self.values(self.a + i) if i < self.b - self.a else ends[i - (self.b - self.a)] for i in np.nonzero((far >= low) & (near <= top))[0]]
            d, c = np.abs(np.concatenate([v for v, _ in parts]) - mid), np.concatenate([c for _, c in parts])
            order = np.argsort(d)
            return self._pick(d[order], c[order], rank - w[far < low].sum())

        return self._middle(n, at)


def _clip_blocks(blocks: _Blocks, least: float, most: float, passes: int, sigma: float, center: str, scale: str, maxiters: int | None) -> tuple:
    """Passes from a state on: exact as long as the values of the blocks that limits or medians fall into are at hand.

    From there on the passes go on by guess, to name the blocks the next round needs.  Returns a row of ``STATE`` without its group.
    """
    n = blocks.keep(least, most)
    ahead = (least, most, passes) if blocks.guess else None  # the state before the first guess
    mid = spread = lo = hi = np.nan
    while n > 0 and (maxiters is None or passes < maxiters):
        if ahead is None:  # what came before is settled
            before, span, blocks.used = (least, most, passes), blocks.span, blocks.ends
        mean, std = blocks.spread()
        median = blocks.median(n) if center == "median" or scale == "mad" else np.nan
        mid = median if center == "median" else mean
        spread = MAD_TO_STD * blocks.mad(n, median) if scale == "mad" else std
        lo, hi = mid - sigma * spread, mid + sigma * spread
        if np.isnan(lo) or np.isnan(hi):
            after = 0.0
        else:
            least, most = max(least, lo), min(most, hi)
            after = blocks.keep(least, most)
        if ahead is None and blocks.guess:
            ahead = before
            if span[1] - span[0] <= FEW_BLOCKS:  # all that can be asked for
                blocks.used.update(dict.fromkeys(range(*span)))
        passes += 1
        rest = after < n if ahead is None else after < n - 0.5
        n = after
        if not rest or len(blocks.used) >= ROUND_BLOCKS // 3:
            break
    if ahead is None:
        return True, mid, spread, lo, hi, int(round(n)), least, most, passes, None
    near = dict.fromkeys(j for i in blocks.used for j in (i, i - 1, i + 1) if 0 <= j < len(blocks.lo))
    need = [float(blocks.lo[j]) for j in [*near][:ROUND_BLOCKS]]
    return False, np.nan, np.nan, np.nan, np.nan, 0, *ahead, need


def _clip_round(sigma: float, center: str, scale: str, maxiters: int | None):
    def run(frame: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        names = [f.split()[0] for f in STATE.split(", ")]
        if frame.empty or state.empty:
            return pd.DataFrame(columns=names)
        s = state.iloc[0]
        row = _clip_blocks(_Blocks(frame), float(s["_min"]), float(s["_max"]), int(s["_passes"]), sigma, center, scale, maxiters)
        return pd.DataFrame([(int(s["_g"]), *row)], columns=names)

    return run


def _looped_limits(rows: DataFrame, keys, groups: DataFrame, sigma, center, scale, maxiters, few_groups) -> DataFrame:
    """Passes over groups of any size without a pass over their rows.

    Values are counted, put in order by ranges over many tasks and cut into blocks of ``BLOCK`` values with their count, mean and sum of squares.  A pass
    needs these sums and the values of the few blocks that a limit or a median falls into.  One task goes through the passes of a
    group by the sums; where values are lacking it goes on by a guess and names the blocks it came by, whose values the next round brings: at
    most ``ROUND_BLOCKS`` of a group at once.  A round settles a pass at least, and mostly all but a few.
    ``groups`` has the keys and a number ``_g``; keys that are NULL count as equal.
    """
    if keys:
        named = groups.withColumnsRenamed({k: f"__key{i}" for i, k in enumerate(keys)})
        rows = rows.join(F.broadcast(named) if few_groups else named, _same_keys(keys))
    else:
        rows = rows.withColumn("_g", F.lit(0).cast("long"))
    counted = rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c"))
    packed = cut_lineage(counted.repartitionByRange("_g", "_v").sortWithinPartitions("_g", "_v").mapInArrow(_pack, PACKED))
    sums = packed.drop("vals", "counts")
    start = {"_min": F.lit(float("-inf")), "_max": F.lit(float("inf")), "_passes": F.lit(0).cast("long"), "_need": F.lit(None).cast("array<double>")}
    state = sums.select("_g").distinct().withColumns(start)
    finished: list[DataFrame] = []
    blocks = sums.withColumns({"vals": F.lit(None).cast("array<double>"), "counts": F.lit(None).cast("array<long>")})
    run = _clip_round(sigma, center, scale, maxiters)
    while True:
        told = state.select("_g", "_min", "_max", "_passes").groupBy("_g")
        state = cut_lineage(blocks.groupBy("_g").cogroup(told).applyInPandas(run, STATE))
        finished.append(state.where("done"))
        state = state.where("not done")
        if state.isEmpty():
            break
        asked = state.select("_g", F.explode("_need").alias("b_lo"), F.lit(True).alias("_asked"))
        blocks = packed.join(state.select("_g"), "_g", "left_semi").join(asked, ["_g", "b_lo"], "left")
        blocks = blocks.withColumns({c: F.when(F.col("_asked"), F.col(c)) for c in ("vals", "counts")}).drop("_asked")
    out = finished[0]
    for part in finished[1:]:
        out = out.unionByName(part)
    limits = ["centre", "scale", "lo", "hi", "n_kept"]
    return out.join(groups, "_g").select(*keys, *limits) if keys else out.select(*limits)


def _same_keys(keys: Sequence[str]) -> Column:
    """Equal keys of rows and of ``__key`` columns, NULL with NULL."""
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__key{i}"))
    return same


def clip_limits(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    sigma: float = 3.0,
    center: str = "median",
    scale: str = "std",
    maxiters: int | None = None,
    bounded: bool = False,
    few_groups: bool = False,
    small_group: int = SMALL_GROUP,
) -> DataFrame:
    """Final clip limits of each group: keys, centre, scale, lo, hi, n_kept.

    Groups of up to ``small_group`` finite values are clipped in one shuffle by a
    numpy helper over arrays.  Larger groups are never gathered: their passes go over sums of
    blocks of ordered values.  ``bounded`` states that all groups are small by nature
    (channels of one spectrum) and skips the size check.
    """
    if center not in ("mean", "median") or scale not in ("std", "mad"):
        raise ValueError("center must be mean or median, scale must be std or mad")
    keys = list(keys)
    rows = df.where(finite(value)).select(*keys, F.col(value).cast("double").alias("_v"))
    if bounded:
        return _small_limits(rows, keys, sigma, center, scale, maxiters)

    sizes = rows.groupBy(*keys).agg(F.count("_v").alias("_n"))
    large = cut_lineage(sizes.where(F.col("_n") > small_group).drop("_n").withColumn("_g", F.monotonically_increasing_id()))
    if not keys:
        if large.isEmpty():
            # one small group
            return _small_limits(rows.withColumn("_all", F.lit(1)), ["_all"], sigma, center, scale, maxiters).drop("_all")
        return _looped_limits(rows, keys, large, sigma, center, scale, maxiters, True)
    if large.isEmpty():
        return _small_limits(rows, keys, sigma, center, scale, maxiters)
    named = large.select(*[F.col(k).alias(f"__key{i}") for i, k in enumerate(keys)])
    few = rows.join(F.broadcast(named) if few_groups else named, _same_keys(keys), "left_anti")
    small = _small_limits(few, keys, sigma, center, scale, maxiters)
    big = _looped_limits(rows, keys, large, sigma, center, scale, maxiters, few_groups)
    return small.unionByName(big)


def sigma_clip(df: DataFrame, keys: Sequence[str], value: str, few_groups: bool = False, **options) -> DataFrame:
    """Rows with a ``clipped`` flag: TRUE for outliers and for missing values."""
    keys = list(keys)
    limits = clip_limits(df, keys, value, few_groups=few_groups, **options).select(
        *keys, F.col("lo").alias("_lo"), F.col("hi").alias("_hi")
    )
    if keys:
        joined = df.join(F.broadcast(limits) if few_groups else limits, keys, "left")
    else:
        joined = with_scalars(df, limits)
    inside = finite(value) & F.col(value).between(F.col("_lo"), F.col("_hi"))
    return joined.withColumn("clipped", ~F.coalesce(inside, F.lit(False))).drop("_lo", "_hi")


def clip_pass(
    df: DataFrame, keys: Sequence[str], value: str, sigma: float = 3.0, few_groups: bool = False
) -> DataFrame:
    """A single median/MAD pass with counts before and after, per group."""
    keys = list(keys)
    stats = mad_std(df, keys, value, few_groups)
    rows = attach(df.where(finite(value)), stats.withColumnRenamed("n", "n_before"), keys, few_groups)
    inside = F.abs(F.col(value) - F.col("median")) <= sigma * F.col("mad_std")
    return rows.groupBy(*keys, "median", "mad_std", "n_before").agg(F.count_if(inside).alias("n_after"))
