"""Leakage envelope and leakage maps."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.numeric import finite
from stokesweave.functions.spectral import hi_snr
from stokesweave.operators.keyed import HOT_ROWS, skew_join, with_scalars
from stokesweave.operators.orderstats import grouped_quantiles, trimmed_mean
from stokesweave.session import Stages

TILE_POINTS = 4_000_000  # points around a tile that one task gathers, 160 MB

# Percent levels of the envelope bins: two- and one-sigma bounds and the median.
LEVELS = {"s2_lo": 0.023, "s1_lo": 0.16, "med": 0.5, "s1_up": 0.84, "s2_up": 0.976}


def equal_width_bins(df: DataFrame, x: str, nbins: int) -> DataFrame:
    """Rows with ``bin``, ``x_lo`` and ``x_hi``; right-open bins between minimum
    and maximum, so rows at the maximum belong to none."""
    usable = df.where(finite(x))
    edge = usable.agg(F.min(x).alias("_lo"), F.max(x).alias("_hi"))
    rows = with_scalars(usable, edge)
    width = (F.col("_hi") - F.col("_lo")) / nbins
    index = F.floor((F.col(x) - F.col("_lo")) / width).cast("int")
    return (
        rows.where(F.col(x) < F.col("_hi"))
        .withColumn("bin", F.least(index, F.lit(nbins - 1)))
        .withColumn("x_lo", F.col("_lo") + F.col("bin") * width)
        .withColumn("x_hi", F.col("_lo") + (F.col("bin") + 1) * width)
        .drop("_lo", "_hi")
    )


def binned_percentiles(
    df: DataFrame, x: str, y: str, nbins: int = 21, levels: Mapping[str, float] = LEVELS
) -> DataFrame:
    """Exact percentiles of ``y`` in equal-width bins of ``x``: bin, centre, n, levels.

    Empty bins have no row.
    """
    binned = equal_width_bins(df, x, nbins)
    keyed = binned.select("bin", ((F.col("x_lo") + F.col("x_hi")) / 2.0).alias("centre"), y)
    return grouped_quantiles(keyed, ["bin", "centre"], y, levels, few_groups=True)


def fit_envelope(
    cat: DataFrame,
    nbins: int = 21,
    degree: int = 2,
    offset: float = 0.002,
    snr_cut: float = 30.0,
    sep: str = "beamdist",
    frac: str = "fracpol",
    signal: str = "stokesI",
    noise: str = "stokesI_err",
    min_sources: int = 100,
) -> list[float]:
    """Ascending coefficients of the leakage envelope over tile separation.

    A polynomial through (bin centre, median + offset) of the high signal to
    noise sources; the zero polynomial when there are fewer than
    ``min_sources``.  Only the ``nbins`` bin rows reach the driver.
    """
    bright = cat.where(hi_snr(signal, noise, snr_cut))
    bins = (
        binned_percentiles(bright, sep, frac, nbins, {"med": 0.5}).select("centre", "med", "n").limit(nbins).collect()
    )
    # the count of bright sources includes the excluded maximum and missing values
    total = bright.count() if sum(r.n for r in bins) < min_sources else min_sources
    if total < min_sources or not bins:
        return [0.0]
    pairs = sorted((r.centre, r.med + offset) for r in bins)
    x, y = np.array(pairs).T
    fit = np.polynomial.Polynomial.fit(x, y, deg=min(degree, len(x) - 1))
    return [float(c) for c in fit.convert().coef]


def aperture_join(
    grid: DataFrame,
    points: DataFrame,
    radius: float,
    node: Sequence[str],
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Points closer than ``radius`` to each grid node in the plane.

    Both carry ``x``/``y``; nodes come out as ``gx``/``gy``.  Cells are as wide as
    the radius and a node looks at its own and the eight around it.
    """
    nodes = grid.select(*node, F.col("x").alias("gx"), F.col("y").alias("gy"))

    def around(c: str) -> Column:
        home = F.floor(F.col(c) / radius)
        return F.explode(F.sequence(home - 1, home + 1))

    probe = nodes.withColumn("_cx", around("gx")).withColumn("_cy", around("gy"))
    home = points.withColumn("_cx", F.floor(F.col("x") / radius)).withColumn("_cy", F.floor(F.col("y") / radius))
    dist = F.hypot(F.col("x") - F.col("gx"), F.col("y") - F.col("gy"))
    pairs = skew_join(probe, home, ["_cx", "_cy"], hot_rows=hot_rows)
    return pairs.withColumn("dist", dist).where(F.col("dist") < radius).drop("_cx", "_cy")


def estimator_grid(points: DataFrame, step: float) -> DataFrame:
    """Nodes every ``step`` over the extent of the points: node_id, x, y.

    The extent is one row; nodes are generated from it in parallel per column.
    """
    box = points.agg(F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("y").alias("y0"), F.max("y").alias("y1"))

    def count(lo: str, hi: str) -> Column:
        # half-open range up to hi + step
        return F.ceil((F.col(hi) + step - F.col(lo)) / step).cast("int")

    cols = box.select("x0", "y0", count("y0", "y1").alias("ny"), F.explode(F.sequence(F.lit(0), count("x0", "x1") - 1)).alias("ix"))
    rows = cols.repartition("ix").select("x0", "y0", "ny", "ix", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)).alias("iy"))
    return rows.select(
        (F.col("ix").cast("long") * F.col("ny") + F.col("iy")).alias("node_id"),
        (F.col("x0") + F.col("ix") * step).alias("x"),
        (F.col("y0") + F.col("iy") * step).alias("y"),
    )


def leakage_map(
    points: DataFrame,
    radius: float,
    step: float | None = None,
    fraction: float = 0.2,
    min_points: int = 5,
    grid: DataFrame | None = None,
    tile_points: int = TILE_POINTS,
) -> DataFrame:
    """Trimmed means of q, u and p around each node: node_id, x, y, n, q, u, p.

    Nodes with fewer than ``min_points`` points get NULL estimates.  The trimming is exact.  The plane is cut into tiles two radii
    wide; a tile's nodes share one copy of the points around it, so a point is repeated for about four tiles whatever the number of nodes.  Tiles with
    more than ``tile_points`` points around them, and nodes that share an id, are trimmed by distributed selection instead.
    """
    stages = Stages()
    good = stages.cut(points.where(finite("q") & finite("u")).select("x", "y", "q", "u", F.hypot("q", "u").alias("p")))
    nodes = stages.cut(grid if grid is not None else estimator_grid(good, step or radius / 4.0))
    side = 2.0 * radius

    def tile(c: str, reach: float) -> Column:
        first, last = F.floor((F.col(c) - reach) / side), F.floor((F.col(c) + reach) / side)
        return F.explode(F.sequence(first, last))

    def placed(df: DataFrame, reach: float) -> DataFrame:
        near = df.where(finite("x") & finite("y"))
        return near.withColumn("_tx", tile("x", reach)).withColumn("_ty", tile("y", reach))

    # a node with an id of its own; rows that share one share an aperture, which may span tiles
    alone = nodes.groupBy("node_id").agg(F.count(F.lit(1)).alias("_n")).where("_n = 1").select("node_id")
    asking = placed(nodes.join(alone, "node_id", "left_semi").select("node_id", "x", "y"), 0.0)
    around = placed(good, float(radius))
    busy = stages.cut(around.groupBy("_tx", "_ty").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > tile_points).select("_tx", "_ty"))
    shared = nodes.join(alone, "node_id", "left_anti").select("node_id", "x", "y")
    far = shared.unionByName(asking.join(busy, ["_tx", "_ty"], "left_semi").select("node_id", "x", "y"))
    tiled, met = (df if busy.isEmpty() else df.join(busy, ["_tx", "_ty"], "left_anti") for df in (asking, around))
    kind = nodes.schema["node_id"].dataType.simpleString()
    wide = (
        tiled.groupBy("_tx", "_ty")
        .cogroup(met.groupBy("_tx", "_ty"))
        .applyInArrow(_tile_means(float(radius), fraction), f"node_id {kind}, n bigint, q double, u double, p double")
    )
    if not far.isEmpty():
        wide = wide.unionByName(_selected_means(far, good, radius, fraction))
    out = nodes.join(wide, "node_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumns({s: F.when(F.col("n") >= min_points, F.col(s)) for s in "qup"})


def _selected_means(nodes: DataFrame, good: DataFrame, radius: float, fraction: float) -> DataFrame:
    """Trimmed means around nodes by distributed selection over the pairs of node and point; no task gathers an aperture."""
    pairs = aperture_join(nodes, good, radius, ["node_id"]).select(
        "node_id", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.col(s).alias("v")) for s in "qup"])).alias("_e")
    )
    means = trimmed_mean(pairs.select("node_id", "_e.s", "_e.v"), ["node_id", "s"], "v", fraction)
    return means.groupBy("node_id").agg(
        F.max("n").alias("n"), *[F.max(F.when(F.col("s") == s, F.col("trimmed_mean"))).alias(s) for s in "qup"]
    )


def _tile_means(radius: float, fraction: float) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """The function that gives the trimmed means around the nodes of one tile from the points around it."""

    def trimmed(values: np.ndarray) -> tuple[int, float | None]:
        values = values[np.isfinite(values)]
        n = len(values)
        if not n:
            return 0, None
        cut = int(np.floor(n * fraction))
        ranked = np.partition(values, [cut, n - 1 - cut])
        lo, hi = ranked[cut], ranked[n - 1 - cut]
        return n, float(lo if lo == hi else ranked[cut : n - cut].mean())

    def run(nodes: pa.Table, points: pa.Table) -> pa.Table:
        x = points["x"].to_numpy()
        order = np.argsort(x, kind="stable")
        x, y, *values = (points[c].to_numpy()[order] for c in ("x", "y", "q", "u", "p"))
        rows: list[list] = []
        for gx, gy in zip(nodes["x"].to_pylist(), nodes["y"].to_pylist()):
            # a strip a little wider than the aperture, then the distance itself
            first, last = np.searchsorted(x, gx - 1.001 * radius), np.searchsorted(x, gx + 1.001 * radius, "right")
            inside = first + np.flatnonzero(np.hypot(x[first:last] - gx, y[first:last] - gy) < radius)
            found = [trimmed(v[inside]) for v in values]
            rows.append([max(n for n, _ in found), *[mean for _, mean in found]])
        out = dict(zip("nqup", zip(*rows))) if rows else dict.fromkeys("nqup", ())
        types = {"n": pa.int64()} | dict.fromkeys("qup", pa.float64())
        return pa.table({"node_id": nodes["node_id"]} | {c: pa.array(out[c], t) for c, t in types.items()})

    return run
