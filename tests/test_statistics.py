import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stokesweave.functions import numeric, spectral
from stokesweave.operators import clipping, complexity, leakage, maps, orderstats, outliers


def frame(spark, groups):
    rows = [(g, float(v)) for g, vals in groups.items() for v in vals]
    return spark.createDataFrame(rows, "g string, v double")


def samples():
    rng = np.random.default_rng(1)
    return {
        "one": [3.0],
        "two": [1.0, 4.0],
        "ties": [2.0] * 50 + [5.0] * 3,
        "normal": rng.normal(0, 1, 501),
        "skewed": rng.lognormal(0, 2, 400),
    }


@pytest.fixture
def tight_brackets(monkeypatch):
    """Narrow every bracket of more than ten values."""
    monkeypatch.setattr(orderstats, "SMALL_BRACKET", 10)
    monkeypatch.setattr(orderstats, "BUCKETS", 16)


def check_quantiles(spark):
    g = samples()
    out = orderstats.grouped_quantiles(frame(spark, g), ["g"], "v", {"a": 0.023, "m": 0.5, "b": 0.976})
    rows = {r.g: r for r in out.collect()}
    assert set(rows) == set(g)
    for k, v in g.items():
        want = np.percentile(v, [2.3, 50, 97.6])
        assert np.allclose([rows[k].a, rows[k].m, rows[k].b], want, rtol=1e-12), k


def test_quantiles_match_numpy(spark):
    check_quantiles(spark)


def test_bracketed_quantiles_match_numpy(spark, tight_brackets):
    check_quantiles(spark)


def test_wide_brackets_under_any_key_name(spark, tight_brackets):
    names = ["_k", "_n", "_a", "lo", "hi", "rank", "w", "before", "inside"]
    values = {k: [float(i * i % 97) for i in range(60 * k)] for k in (1, 2)}
    df = spark.createDataFrame([(k, v) for k, vs in values.items() for v in vs], "key int, x double")
    df = df.select(*[F.col("key").alias(c) for c in names], "x")
    for r in orderstats.grouped_median(df, names, "x").collect():
        assert r.median == np.median(values[r["_k"]])


def test_large_groups_are_clipped_with_wide_brackets(spark, tight_brackets):
    g = {"normal": samples()["normal"]}
    for r in clipping.clip_limits(frame(spark, g), ["g"], "v", 2.5, "median", "std", maxiters=1, small_group=50).collect():
        assert np.allclose([r.centre, r.scale, r.lo, r.hi, r.n_kept], clipping.clip_array(np.array(g[r.g]), 2.5, "median", "std", 1))


def test_selection_among_ten_million_values(spark):
    n = 10_000_000
    mixed = np.arange(n, dtype=np.int64) * 2654435761 % (1 << 32)
    # crowded about 180, with far ends and a value that many rows share
    values = np.where(mixed % 7 == 0, 180.0, 180.0 + (mixed - (1 << 31)) * 1e-13)
    values[:4] = [-1e300, 1e300, 0.0, 5e-324]
    h = F.col("id") * F.lit(2654435761) % F.lit(1 << 32)
    v = F.when(h % 7 == 0, F.lit(180.0)).otherwise(F.lit(180.0) + (h - F.lit(1 << 31)) * F.lit(1e-13))
    v = F.when(F.col("id") == 0, F.lit(-1e300)).when(F.col("id") == 1, F.lit(1e300)).when(F.col("id") == 2, F.lit(0.0)).when(F.col("id") == 3, F.lit(5e-324)).otherwise(v)
    out = orderstats.order_statistics(spark.range(n).select(v.alias("v")), [], "v", {"low": F.lit(1), "a": F.col("n") / 100, "m": F.col("n") / 2, "b": F.col("n") - 1000, "top": F.col("n") - 1})
    values.sort()
    r = out.first()
    assert (r.low, r.a, r.m, r.b, r.top) == (values[1], values[n // 100], values[n // 2], values[n - 1000], values[-1])


def test_global_quantile_and_missing_values(spark, tight_brackets):
    vals = list(np.random.default_rng(2).normal(5, 2, 300))
    df = frame(spark, {"x": [*vals, float("nan"), float("inf")]})
    row = orderstats.grouped_median(df, [], "v").first()
    assert row.n == 300 and math.isclose(row.median, np.median(vals), rel_tol=1e-12)


def test_trimmed_mean_matches_numpy(spark, tight_brackets):
    g = samples()
    rows = {r.g: r.trimmed_mean for r in orderstats.trimmed_mean(frame(spark, g), ["g"], "v", 0.2).collect()}
    for k, v in g.items():
        v = np.sort(v)
        cut = int(0.2 * len(v))
        assert math.isclose(rows[k], v[cut : len(v) - cut].mean(), rel_tol=1e-9), k


def test_mad_std_matches_numpy(spark, tight_brackets):
    g = samples()
    for r in orderstats.mad_std(frame(spark, g), ["g"], "v").collect():
        v = np.asarray(g[r.g])
        assert math.isclose(r.mad_std, orderstats.MAD_TO_STD * np.median(np.abs(v - np.median(v))), rel_tol=1e-9, abs_tol=1e-12)


@pytest.mark.parametrize("center,scale", [("mean", "std"), ("median", "std"), ("median", "mad")])
def test_clip_paths_agree_with_numpy(spark, center, scale):
    rng = np.random.default_rng(8)
    g = {"a": np.r_[rng.normal(0, 1, 60), [25.0, -30.0, 12.0]], "b": rng.normal(3, 0.1, 40), "c": [1.0, 1.0, 1.0]}
    df = frame(spark, g)
    for small in (1000, 30):  # gathered groups, then distributed passes
        got = {r.g: r for r in clipping.clip_limits(df, ["g"], "v", 3.0, center, scale, small_group=small).collect()}
        for k, v in g.items():
            mid, sd, lo, hi, n = clipping.clip_array(np.asarray(v, float), 3.0, center, scale, None)
            assert math.isclose(got[k].lo, lo, rel_tol=1e-9, abs_tol=1e-9) and math.isclose(got[k].hi, hi, rel_tol=1e-9, abs_tol=1e-9)
            assert got[k].n_kept == n


def test_clip_is_idempotent(spark):
    rng = np.random.default_rng(4)
    df = frame(spark, {"a": np.r_[rng.normal(0, 1, 100), [50.0]]})
    once = clipping.sigma_clip(df, ["g"], "v", sigma=3.0)
    kept = once.where("not clipped").drop("clipped")
    assert kept.count() < df.count()
    assert clipping.sigma_clip(kept, ["g"], "v", sigma=3.0).where("clipped").count() == 0


def test_nan_never_flags(spark):
    df = spark.createDataFrame([(float("nan"), 1.0), (2.0, float("nan")), (2.0, 1.0), (None, 1.0)], "a double, b double")
    rows = df.select(numeric.known_gt("a", "b").alias("f")).collect()
    assert [r.f for r in rows] == [False, False, True, False]


def test_division_by_zero_is_null(spark):
    row = spark.createDataFrame([(1.0, 0.0)], "a double, b double").select(numeric.ratio("a", "b").alias("r")).first()
    assert row.r is None


def test_envelope_recovers_polynomial(spark):
    rng = np.random.default_rng(6)
    sep = rng.uniform(0, 4, 4000)
    frac = 0.01 + 0.002 * sep + 0.001 * sep**2
    rows = [(float(s), float(f), 100.0, 1.0) for s, f in zip(sep, frac)]
    cat = spark.createDataFrame(rows, "beamdist double, fracpol double, stokesI double, stokesI_err double")
    coef = leakage.fit_envelope(cat, nbins=16, degree=2, offset=0.0)
    x = np.linspace(0.5, 3.5, 20)
    assert np.allclose(np.polyval(coef[::-1], x), 0.01 + 0.002 * x + 0.001 * x**2, atol=3e-4)


def test_envelope_is_zero_with_few_sources(spark):
    cat = spark.createDataFrame([(1.0, 0.1, 100.0, 1.0)] * 20, "beamdist double, fracpol double, stokesI double, stokesI_err double")
    assert leakage.fit_envelope(cat) == [0.0]


def test_local_outliers_find_planted_values(spark):
    rng = np.random.default_rng(11)
    rows = [(i, float(rng.uniform(10, 20)), float(rng.uniform(-30, -20)), float(rng.normal(0, 5)), i % 10 != 9) for i in range(600)]
    planted = {50, 300, 501}
    rows = [(i, a, d, 900.0 if i in planted else rm, g) for i, a, d, rm, g in rows]
    cat = spark.createDataFrame(rows, "cat_id long, ra double, dec double, rm double, good boolean")
    out = {r.cat_id: r.local_rm_flag for r in outliers.local_outliers(cat, "good").collect()}
    assert len(out) == 600 and all(out[i] for i in planted)
    assert not any(out[i] for i in range(600) if i % 10 == 9)
    assert not any(r.local_rm_flag for r in outliers.local_outliers(cat, "good", reference_compat=True).collect())


def bins_of(spark, ra, dec, target=30, subtree=100_000):
    df = spark.createDataFrame([(i, float(a), float(d)) for i, (a, d) in enumerate(zip(ra, dec))], "cat_id long, ra double, dec double")
    out = {}
    for r in outliers.neighbour_bins(df, "cat_id", target=target).collect():
        out.setdefault(r.sky_bin, set()).add(r.cat_id)
    return sorted(out.values(), key=min)


@pytest.mark.parametrize("subtree", [100_000, 40])
def test_neighbour_bins_hold_the_target(spark, monkeypatch, subtree):
    monkeypatch.setattr(outliers, "SUBTREE", subtree)
    rng = np.random.default_rng(12)
    ra, dec = rng.uniform(0, 360, 900), np.degrees(np.arcsin(rng.uniform(-0.98, 0.98, 900)))
    even = bins_of(spark, ra, dec)
    assert sum(map(len, even)) == 900 and all(30 <= len(b) < 60 for b in even)
    # rows at one position are neighbours, so they stay together
    piled = bins_of(spark, np.r_[ra, np.full(450, 200.0)], np.r_[dec, np.full(450, -45.0)])
    assert sum(map(len, piled)) == 1350 and any(set(range(900, 1350)) <= b for b in piled)
    tiny = spark.createDataFrame([(i, float(i), 0.0) for i in range(4)], "cat_id long, ra double, dec double")
    assert outliers.neighbour_bins(tiny, "cat_id") is None


def test_histograms_and_tasks_cut_alike(spark, monkeypatch):
    rng = np.random.default_rng(31)
    ra = np.r_[rng.uniform(0, 360, 300), rng.normal(120, 0.3, 400), rng.normal(300, 1, 200), [5.0] * 70, 121.0, 122.5]
    dec = np.r_[rng.uniform(-60, 60, 300), rng.normal(10, 0.3, 400), rng.normal(-70, 1, 200), [1.0] * 70, 10.0, 15.0]
    want = bins_of(spark, ra, dec)
    monkeypatch.setattr(outliers, "SUBTREE", 25)
    assert bins_of(spark, ra, dec) == want


def test_no_bin_spans_a_gap(spark):
    rng = np.random.default_rng(7)
    # small fields far apart, one with a few rows only, one over RA 0
    centres = [(40.0, 0.0, 200), (47.0, 0.0, 21), (200.0, -50.0, 90), (200.0, -58.0, 45), (0.0, 30.0, 120), (90.0, 70.0, 3)]
    field = np.concatenate([[k] * n for k, (_, _, n) in enumerate(centres)])
    ra = np.concatenate([a + rng.uniform(-1, 1, n) for a, _, n in centres]) % 360
    dec = np.concatenate([d + rng.uniform(-1, 1, n) for _, d, n in centres])
    for b in bins_of(spark, ra, dec):
        assert len({field[i] for i in b}) == 1


def test_outliers_of_distant_fields_are_found(spark):
    rng = np.random.default_rng(17)
    ra, dec = np.r_[rng.uniform(10, 12, 45), rng.uniform(190, 192, 45), rng.uniform(60, 64, 200)], np.r_[rng.uniform(-31, -29, 45), rng.uniform(40, 42, 45), rng.uniform(0, 4, 200)]
    rm = np.r_[rng.normal(300, 3, 45), rng.normal(-300, 3, 45), rng.normal(0, 3, 200)]
    rm[7], rm[60], rm[150] = -290.0, 295.0, 60.0  # each is ordinary elsewhere
    cat = spark.createDataFrame([(i, float(a), float(d), float(v), True) for i, (a, d, v) in enumerate(zip(ra, dec, rm))], "cat_id long, ra double, dec double, rm double, good boolean")
    found = {r.cat_id for r in outliers.local_outliers(cat, "good").where("local_rm_flag").collect()}
    assert {7, 60, 150} <= found and len(found) <= 8


def test_sigma_add_moments(spark):
    names = "cat_id long, " + ", ".join(f"{c} double" for c in complexity.INPUTS)
    good = (1, 1.0, 1.0, 0.01, 0.01, 0.01, 0.01)
    bad = (2, 1.0, 1.0, 2.0, 0.01, 0.01, 0.01)
    cat = spark.createDataFrame([good, bad], names)
    rows = {r.cat_id: r for r in complexity.sigma_add(cat).collect()}
    assert abs(rows[1].sigma_add - math.sqrt(2)) < 5e-3 and 0.005 < rows[1].sigma_add_err < 0.015
    assert math.isnan(rows[2].sigma_add) and math.isnan(rows[2].sigma_add_err)
    again = {r.cat_id: r.sigma_add for r in complexity.sigma_add(cat.repartition(3)).collect()}
    assert again[1] == rows[1].sigma_add


def test_gridded_map_is_nearest_inside_hull(spark):
    rng = np.random.default_rng(21)
    n, npix, size = 150, 24, 8.0
    ra = np.r_[rng.uniform(8, 12, n), np.full(60, 9.0)]
    dec = np.r_[rng.uniform(-2, 2, n), np.full(60, 0.5) + rng.uniform(0, 0.01, 60)]
    val = rng.normal(0, 1, ra.size)
    cat = spark.createDataFrame([(i, float(a), float(d), float(v)) for i, (a, d, v) in enumerate(zip(ra, dec, val))], "cat_id long, ra double, dec double, v double")
    rows = maps.gridded_map(cat, "v", "cat_id", npix, size).collect()
    assert len(rows) == npix * npix
    hull = maps.hull_vertices(np.stack([ra, dec], axis=1))
    ra0, dec0, step = np.radians(ra.mean()), np.radians(dec.mean()), size / npix
    for r in rows:
        ix = npix - 1 - r.x
        ex, ny = np.radians((ix - (npix / 2 - 1)) * step), np.radians((r.y - (npix / 2 - 1)) * step)
        c = math.sqrt(1 - ex**2 - ny**2)
        nra = math.degrees(ra0 + math.atan2(ex, math.cos(dec0) * c - ny * math.sin(dec0))) % 360
        ndec = math.degrees(math.asin(c * math.sin(dec0) + ny * math.cos(dec0)))
        inside = maps._inside(hull, np.array([nra]), np.array([ndec]))[0]
        if not inside:
            assert r.value is None
        else:
            d = np.hypot(ra - nra, dec - ndec)
            assert r.value in val[d <= d.min() + 1e-9]


def brute_map(ra, dec, npix, size, hull):
    """Index of the nearest point of each pixel by (y, x), -1 outside the hull; ties to the first."""
    ra0, dec0, step = np.mean(ra), np.radians(np.mean(dec)), size / npix
    y, ix = (v.ravel() for v in np.mgrid[0:npix, 0:npix])
    ex, ny = np.radians((ix - (npix / 2 - 1)) * step), np.radians((y - (npix / 2 - 1)) * step)
    c = np.sqrt(np.maximum(0, 1 - ex**2 - ny**2))
    nra = (ra0 + np.degrees(np.arctan2(ex, np.cos(dec0) * c - ny * np.sin(dec0)))) % 360
    ndec = np.degrees(np.arcsin(np.clip(c * np.sin(dec0) + ny * np.cos(dec0), -1, 1)))
    near = np.array([np.hypot(ra - a, dec - d).argmin() for a, d in zip(nra, ndec)])
    near[(ex**2 + ny**2 > 1) | ~maps._inside(hull, nra, ndec)] = -1
    return {(int(a), int(npix - 1 - b)): int(n) for a, b, n in zip(y, ix, near)}


@pytest.mark.parametrize(("limit", "tile"), [(2000, 64), (8, 16), (1, 4)])
def test_gridded_map_equals_brute_force(spark, monkeypatch, limit, tile):
    monkeypatch.setattr(maps, "TILE", tile)
    rng = np.random.default_rng(5)
    npix, size = 48, 150.0  # the corners are off the sphere
    # a crowd far finer than a pixel, copies at one position, both sides of RA 0
    ra = np.r_[rng.uniform(0, 360, 300), 40 + rng.normal(0, 0.01, 300), np.full(40, 90.0), 359.999, 0.001]
    dec = np.r_[rng.uniform(-80, 80, 300), 10 + rng.normal(0, 0.01, 300), np.full(40, -20.0), 0.0, 0.0]
    rows = [(i, float(a), float(d), float(i), f"s{i}") for i, (a, d) in enumerate(zip(ra, dec))]
    cat = spark.createDataFrame(rows + [(-1, None, 3.0, -1.0, "none"), (-2, 5.0, float("nan"), -2.0, "none")], "cat_id long, ra double, dec double, v double, w string")
    got = {(r.y, r.x): (r.v, r.w) for r in maps.gridded_map(cat, ["v", "w"], "cat_id", npix, size, limit=limit).collect()}
    hull = maps.convex_hull(cat.where("cat_id >= 0").selectExpr("ra AS x", "dec AS y"))
    assert {tuple(h) for h in hull} == {tuple(h) for h in maps.hull_vertices(np.stack([ra, dec], axis=1))}
    want = brute_map(ra, dec, npix, size, hull)
    assert len(got) == npix * npix
    assert all(got[k] == ((None, None) if n < 0 else (float(n), f"s{n}")) for k, n in want.items())


def test_gridded_map_of_nothing(spark):
    empty = spark.createDataFrame([], "cat_id long, ra double, dec double, v double")
    rows = maps.gridded_map(empty, "v", "cat_id", 10, 8.0).collect()
    assert len(rows) == 100 and all(r.value is None for r in rows)


def test_inside_hull_edges():
    square = maps.hull_vertices(np.array([(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (1.0, 1.0)]))
    x, y = np.array([0, 2, 0, 2, 1, 0, -0.1, 2.1, 1, 1, 0]), np.array([0, 2, 1, 1, 2, 2.1, 1, 1, -0.1, 2.1, -0.1])
    assert maps._inside(square, x.astype(float), y.astype(float)).tolist() == [True] * 5 + [False] * 6


def test_leakage_map_needs_five_points(spark):
    pts = spark.createDataFrame([(0.1 * i, 0.0, 0.01 * i, 0.0) for i in range(4)] + [(5.0 + 0.01 * i, 0.0, 0.02, 0.01) for i in range(6)], "x double, y double, q double, u double")
    nodes = spark.createDataFrame([(1, 0.1, 0.0), (2, 5.0, 0.0)], "node_id long, x double, y double")
    rows = {r.node_id: r for r in leakage.leakage_map(pts, 1.0, grid=nodes).collect()}
    assert rows[1].n == 4 and rows[1].q is None
    assert rows[2].n == 6 and math.isclose(rows[2].q, 0.02)


def test_leakage_map_shares_points_by_tile(spark, monkeypatch):
    """Nodes of a tile share its points, no pair of node and point is a row; crowded tiles and shared ids give the same by selection."""
    rng = np.random.default_rng(5)
    xy, qu = rng.uniform(-7, 7, (400, 2)), rng.normal(0, 0.1, (400, 2))
    rows = [(*map(float, a), *map(float, b)) for a, b in zip(xy, qu)]
    pts = spark.createDataFrame([*rows, (0.0, 0.0, float("nan"), 0.1), (float("inf"), 0.0, 0.1, 0.1)], "x double, y double, q double, u double")
    nodes = [(i, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-8, 8, (30, 2)))] + [(99, float("nan"), 0.0)]
    grid = spark.createDataFrame(nodes, "node_id long, x double, y double")

    def means(**more) -> dict:
        return {r.node_id: (r.n, r.q, r.u, r.p) for r in leakage.leakage_map(pts, 2.0, **{"grid": grid, **more}).collect()}

    selected = means(tile_points=0)
    twice = leakage.leakage_map(pts, 2.0, grid=grid.unionByName(grid.where("node_id = 3"))).where("node_id = 3").collect()
    assert [r.n for r in twice] == [2 * selected[3][0]] * 2

    def no_pairs(*args, **more):
        raise AssertionError("pairs of nodes and points")

    monkeypatch.setattr(leakage, "aperture_join", no_pairs)
    tiled = means()
    for i, gx, gy in nodes:
        inside = np.flatnonzero(np.hypot(xy[:, 0] - gx, xy[:, 1] - gy) < 2.0)
        want = [len(inside)]
        for v in (qu[inside, 0], qu[inside, 1], np.hypot(*qu[inside].T)):
            cut = int(len(v) * 0.2)
            want.append(float(np.sort(v)[cut : len(v) - cut].mean()) if len(v) >= 5 else None)
        for got in (tiled[i], selected[i]):
            assert got[0] == want[0]
            assert all(a is b is None or math.isclose(a, b, abs_tol=1e-12) for a, b in zip(got[1:], want[1:]))


def test_fit_flags_and_poly(spark):
    row = spark.range(1).select(spectral.eval_poly(F.lit(2.0), [1.0, 2.0, 3.0]).alias("p"), *[c.alias(n) for n, c in spectral.fit_status_flags(F.lit(64)).items()]).first()
    assert row.p == 17.0 and not row.is_negative and row.is_close_to_zero and row.is_not_finite and row.is_not_normal
