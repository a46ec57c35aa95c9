import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from stokesweave.functions import sky
from stokesweave.operators import association
from stokesweave.session import cut_lineage


def haversine(ra1, dec1, ra2, dec2):
    ra1, dec1, ra2, dec2 = map(np.radians, (ra1, dec1, ra2, dec2))
    h = np.sin((dec2 - dec1) / 2) ** 2 + np.cos(dec1) * np.cos(dec2) * np.sin((ra2 - ra1) / 2) ** 2
    return np.degrees(2 * np.arcsin(np.sqrt(np.minimum(1, h))))


def sphere(n, seed):
    rng = np.random.default_rng(seed)
    ra = rng.uniform(0, 360, n)
    dec = np.degrees(np.arcsin(rng.uniform(-1, 1, n)))
    # both sides of RA zero and both poles
    ra[:6] = [0.0, 359.999, 0.001, 10.0, 190.0, 280.0]
    dec[:6] = [0.0, 0.0, 0.0, 89.9, 89.95, -89.9]
    return ra, dec


@pytest.mark.parametrize("radius", [0.3, 2.0, 11.0])
def test_radius_join_equals_brute_force(spark, radius):
    ra, dec = sphere(400, 3)
    left = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(ra, dec))], "lid long, ra double, dec double")
    rb, db = sphere(500, 4)
    right = spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(rb, db))], "rid long, ra double, dec double")
    got = sorted((r.lid, r.rid) for r in association.sky_radius_join(left, right, radius).collect())
    want = [(i, j) for i in range(400) for j in np.nonzero(haversine(ra[i], dec[i], rb, db) < radius)[0]]
    assert got == sorted(want)


def test_radius_join_slices_hot_cells(spark):
    # a third of the right side sits in one spot
    rows = [(i, 10.0 + (0.0 if i % 3 == 0 else i * 0.01), -20.0) for i in range(600)]
    right = spark.createDataFrame(rows, "rid long, ra double, dec double")
    left = spark.createDataFrame([(i, 10.0 + i * 0.05, -20.0) for i in range(40)], "lid long, ra double, dec double")
    plain = association.sky_radius_join(left, right, 0.5, hot_rows=None)
    sliced = association.sky_radius_join(left, right, 0.5, hot_rows=50)
    key = lambda df: sorted((r.lid, r.rid) for r in df.collect())
    assert key(plain) == key(sliced)


def test_offset_inverts_separation_and_bearing(spark):
    df = spark.createDataFrame([(10.0, -30.0, 75.0, 2.5), (359.9, 60.0, 300.0, 1.0)], "ra double, dec double, pa double, s double")
    ra, dec = sky.offset_by("ra", "dec", "pa", "s")
    out = df.withColumns({"r2": ra, "d2": dec})
    for r in out.select("pa", "s", sky.sep_deg("ra", "dec", "r2", "d2").alias("sep"), sky.position_angle("ra", "dec", "r2", "d2").alias("p")).collect():
        assert math.isclose(r.sep, r.s, abs_tol=1e-9) and math.isclose(r.p, r.pa, abs_tol=1e-9)


def test_sin_projection_round_trip(spark):
    df = spark.createDataFrame([(11.0, -29.0), (8.5, -31.0)], "ra double, dec double")
    x, y = sky.sin_project("ra", "dec", F.lit(10.0), F.lit(-30.0))
    back = df.withColumns({"x": x, "y": y})
    r2, d2 = sky.sin_deproject("x", "y", F.lit(10.0), F.lit(-30.0))
    for r in back.select("ra", "dec", r2.alias("r2"), d2.alias("d2")).collect():
        assert math.isclose(r.ra, r.r2, abs_tol=1e-9) and math.isclose(r.dec, r.d2, abs_tol=1e-9)


def test_coord_strings_truncate_toward_zero(spark):
    df = spark.createDataFrame([(187.70593, 12.39112), (0.5, -0.5), (83.6, -5.25)], "ra double, dec double")
    ra, dec = sky.coord_strings("ra", "dec")
    rows = df.select(ra.alias("r"), dec.alias("d")).collect()
    assert [r.r for r in rows] == ["12:30:49.423", "00:02:00.000", "05:34:24.000"]
    assert [r.d for r in rows] == ["12:23:28.03", "00:30:00.00", "-5:15:00.00"]


def test_galactic_pole_and_centre(spark):
    df = spark.createDataFrame([(192.85948, 27.12825), (266.40499, -28.93617)], "ra double, dec double")
    lon, lat = sky.to_galactic("ra", "dec")
    pole, centre = df.select(lon.alias("l"), lat.alias("b")).collect()
    assert math.isclose(pole.b, 90.0, abs_tol=1e-6)
    assert abs(centre.b) < 1e-3 and min(centre.l, 360 - centre.l) < 1e-3


def brute_blends(rows):
    """rows: (source, cat, ra, dec, flux, beam)"""
    out = {}
    for s, c, ra, dec, f, _ in rows:
        mates = [r for r in rows if r[0] == s]
        beam = max(r[5] for r in mates)
        near = [r[4] for r in mates if 0 < haversine(ra, dec, r[2], r[3]) < beam]
        out[c] = (bool(near), len(near), float("nan") if len(mates) == 1 else f / (f + sum(near)))
    return out


@pytest.mark.parametrize("dense,hot_rows", [(2000, None), (20, None), (20, 15)])
def test_blends_equal_brute_force(spark, dense, hot_rows):
    rng = np.random.default_rng(9)
    rows = []
    for i in range(300):
        s = 0 if i < 100 else int(rng.integers(1, 60))  # a third of all rows in one source
        ra, dec = (s * 5.0 + rng.uniform(-0.02, 0.02)) % 360, -30.0 + rng.uniform(0, 0.02)
        if i % 10 == 0:
            ra, dec = s * 5.0 % 360, -30.0  # copies at one position
        rows.append((s, i, float(ra), float(dec), float(rng.uniform(1, 9)), 0.01 + 0.001 * (i % 3)))
    cat = spark.createDataFrame(rows, "source_id long, cat_id long, ra double, dec double, total_i_flux double, beam_maj double")
    want = brute_blends(rows)
    got = association.blended_components(cat, dense=dense, hot_rows=hot_rows).collect()
    assert len(got) == 300
    for r in got:
        flag, n, ratio = want[r.cat_id]
        assert (r.is_blended_flag, r.n_blended) == (flag, n)
        assert (math.isnan(ratio) and math.isnan(r.blend_ratio)) or math.isclose(ratio, r.blend_ratio, rel_tol=1e-9)


def test_nearest_match_takes_lowest_id_on_ties(spark):
    left = spark.createDataFrame([(1, 10.0, 0.0)], "lid long, ra double, dec double")
    right = spark.createDataFrame([(7, 10.0, 0.1), (5, 10.0, 0.1), (6, 10.0, -0.1), (9, 50.0, 0.0)], "rid long, ra double, dec double")
    row = association.nearest_match(left, right, 1.0, "lid", "rid").first()
    assert row.rid in (5, 6) and math.isclose(row.sep, 0.1, abs_tol=1e-9)


def test_nearest_of_a_hundred_thousand_fields(spark):
    rng = np.random.default_rng(12)
    n = 100_000
    # half of the centres crowd two degrees of sky, one stands at each pole
    ra = np.r_[rng.uniform(0, 360, n // 2), rng.uniform(359, 361, n // 2) % 360, 10.0, 200.0]
    dec = np.r_[np.degrees(np.arcsin(rng.uniform(-1, 1, n // 2))), rng.uniform(-1, 1, n // 2), 90.0, -90.0]
    sra = np.r_[rng.uniform(0, 360, 1500), rng.uniform(359.5, 360.5, 1500) % 360, 0.0, 77.0, np.nan]
    sdec = np.r_[np.degrees(np.arcsin(rng.uniform(-1, 1, 1500))), rng.uniform(-0.5, 0.5, 1500), 89.999, -90.0, 0.0]
    fields = spark.createDataFrame(pd.DataFrame({"k": np.arange(ra.size), "ra": ra, "dec": dec}))
    pts = spark.createDataFrame(pd.DataFrame({"cat_id": np.arange(sra.size), "ra": sra, "dec": sdec}))
    got = {r.cat_id: r for r in association.nearest_field(pts, fields, ["k"], "k").collect()}

    def vectors(a, d):
        a, d = np.radians(a), np.radians(d)
        return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)

    centres, places = vectors(ra, dec), vectors(sra[:-1], sdec[:-1])
    assert len(got) == sra.size and got[sra.size - 1].near_k is None
    for at in range(0, len(places), 200):
        d = ((places[at : at + 200, None, :] - centres[None]) ** 2).sum(axis=2)
        for k, row in enumerate(d):
            assert row[got[at + k].near_k] <= row.min() * (1 + 1e-9) + 1e-18


def test_nearest_field_takes_the_lowest_of_equals(spark):
    pts = spark.createDataFrame([(1, 10.0, 0.0), (2, 200.0, 5.0)], "cat_id long, ra double, dec double")
    fields = spark.createDataFrame([("b", 11.0, 0.0), ("a", 9.0, 0.0), ("d", 200.0, 5.0), ("c", 200.0, 5.0), ("z", None, 1.0)], "name string, ra double, dec double")
    assert {r.cat_id: r.near_name for r in association.nearest_field(pts, fields, ["name"], "name").collect()} == {1: "a", 2: "c"}
    with pytest.raises(ValueError):
        association.nearest_field(pts, fields.where("false"), ["name"], "name")


def test_widest_pair_matches_all_pairs(spark):
    rng = np.random.default_rng(5)
    rows = [(s, float((358.0 + rng.uniform(0, 4)) % 360), float(-40 + rng.uniform(0, 2))) for s in range(20) for _ in range(7)]
    pts = spark.createDataFrame(rows, "source_id long, ra double, dec double")
    for r in association.widest_pair(pts).collect():
        mine = [(a, d) for s, a, d in rows if s == r.source_id]
        decs = [d for _, d in mine]
        edge = min(decs) if abs(max(decs)) > abs(min(decs)) else max(decs)
        best = max(haversine(a, edge, b, edge) for a, _ in mine for b, _ in mine)
        assert math.isclose(r.sep, best, abs_tol=1e-9) and not r.wraps


def test_widest_pair_around_the_pole(spark):
    ras = [0.0, 80.0, 130.0, 215.0, 290.0]
    pts = spark.createDataFrame([(1, a, 89.0) for a in ras], "source_id long, ra double, dec double")
    r = association.widest_pair(pts).first()
    best = max(haversine(a, 89.0, b, 89.0) for a in ras for b in ras)
    assert r.wraps and math.isclose(r.sep, best, abs_tol=1e-9)


def test_blends_ignore_missing_beam_and_flux(spark):
    nan = float("nan")
    cat = spark.createDataFrame(
        [(1, 1, 10.0, 0.0, 2.0, nan), (1, 2, 10.001, 0.0, nan, 0.01), (2, 3, 20.0, 0.0, 1.0, nan), (2, 4, 20.001, 0.0, 1.0, nan)],
        "source_id long, cat_id long, ra double, dec double, total_i_flux double, beam_maj double",
    )
    out = {r.cat_id: r for r in association.blended_components(cat).collect()}
    assert out[1].n_blended == 1 and out[1].blend_ratio == 1.0
    assert out[2].n_blended == 1 and math.isnan(out[2].blend_ratio)
    assert out[3].n_blended == 0 and out[3].blend_ratio == 1.0 and not out[4].is_blended_flag


def test_nested_beam_pairs_are_the_pairs(spark, monkeypatch):
    """One row per source holds what the pairs hold, through lists, for sources of several rows, null ids and crowded cells."""
    rng = np.random.default_rng(8)
    sky = lambda n: [(float(r), float(d)) for r, d in zip(rng.uniform(0, 360, n), [*rng.uniform(-90, 90, n // 2), *rng.uniform(84, 90, n - n // 2)])]
    islands = spark.createDataFrame([(i, *p) for i, p in enumerate(sky(60))], "source_id long, ra double, dec double")
    more = spark.createDataFrame([(3, 200.0, 86.0), (None, 10.0, 88.0), (None, 190.0, 88.0), (70, float("nan"), 1.0)], islands.schema)
    beams = [(f"F{i % 4}" if i % 9 else None, i % 5 if i % 7 else None, i % 3, *p) for i, p in enumerate(sky(400))]
    beams += [("RACS_test4_1.05_1", 1, 2, *b[3:]) for b in beams[:200]] + [("RACS_1", 4, 2, *b[3:]) for b in beams[100:300]]
    pointings = spark.createDataFrame(beams, "field_name string, beam_num int, sbid long, ra double, dec double")
    tiles = spark.createDataFrame([("F1",), ("RACS_1",), (None,)], "tile_id string")

    def rows(islands, epoch, **more):
        per_field = cut_lineage(association.source_fields(association.beam_pairs(islands, pointings, 3.0, **more), tiles, epoch))
        kinds = association.split_by_field_count(per_field, ["F1"]).collect()
        named = association.field_rows(per_field) if more else per_field
        known = per_field.withColumn("fields", F.filter("fields", lambda f: f["field_name"].isNotNull())) if more else per_field.where("field_name is not null")
        return [sorted(map(repr, x)) for x in (named.select("source_id", "field_name", "beam_list", "sbids", "dr1").collect(), association.source_beams(known).where("n_fields > 0").collect(), kinds)]

    every = islands.unionByName(more)
    want = rows(every, 0)
    assert len(want[0]) > 50 and any("None" in r for r in want[0])
    assert rows(every, 0, nested=True, longest=3) == want

    plain = rows(islands, 1)

    def no_pairs(*args, **more):
        raise AssertionError("pairs of sources and beams")

    monkeypatch.setattr(association, "sky_radius_join", no_pairs)
    assert rows(islands, 1, nested=True) == plain


def test_associate_shuffles_no_pairs(spark):
    """Sources meet lists of pointings; fields that differ in their test infix alone are one, named once per pointing."""
    from stokesweave.plans.ingest import associate

    rng = np.random.default_rng(9)
    beams = [(f"F_{'test4_1.05_' * (i % 2)}{i % 3}", 8000 + i % 5, i % 7, float(rng.uniform(0, 8)), float(rng.uniform(-4, 4))) for i in range(60)]
    pointings = spark.createDataFrame(beams, "field_name string, sbid long, beam_num int, ra double, dec double")
    rows = [(i, float(rng.uniform(0, 8)), float(rng.uniform(-4, 4)), f"F_{i % 2}") for i in range(50)] + [(50, 200.0, 0.0, "F_1"), (51, None, 0.0, "F_1")]
    islands = spark.createDataFrame(rows, "source_id long, ra double, dec double, tile_id string")

    def as_rows(df):
        return sorted((r["source_id"], r["field_name"], tuple(r["beam_list"]), tuple(r["sbids"]), r["dr1"]) for r in df.collect())

    for epoch in (0, 1):
        out = associate(islands, pointings, epoch, 2.0)
        pairs = association.beam_pairs(islands.drop("tile_id"), pointings, 2.0)
        assert as_rows(out) == as_rows(association.source_fields(pairs, islands.select("tile_id"), epoch))
        assert "hashpartitioning(source_id" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot_rows", [association.HOT_ROWS, 5])
def test_close_pairs_of_small_and_large_groups(spark, monkeypatch, hot_rows):
    """Only groups with many rows go over cells; both ways give all pairs, with repeated, null and missing values."""
    rng = np.random.default_rng(5)
    sizes = {1: 1, 2: 7, 3: association.SMALL_GROUP, 4: association.SMALL_GROUP + 1, 5: 150}
    rows = [(g, g * 1000 + i, float(rng.uniform(-0.05, 0.05) % 360), float(60 + rng.uniform(-0.03, 0.03))) for g, n in sizes.items() for i in range(n)]
    rows += [rows[1], rows[2], (None, 1, 0.0, 60.0), (None, 2, 0.0, 60.0), (2, 1, None, 60.0), (5, 2, 0.0, float("nan")), (2, None, 0.0, 60.0)]
    joined, skew_join = [], association.skew_join

    def noted(left, right, *rest):
        joined.extend(r["g"] for r in left.select("g").distinct().collect())
        return skew_join(left, right, *rest)

    monkeypatch.setattr(association, "skew_join", noted)
    got = association.close_pairs(spark.createDataFrame(rows, "g long, id long, ra double, dec double"), "g", "id", 0.03, hot_rows=hot_rows)
    want = []
    for a in rows:
        for b in rows:
            if None not in (*a, *b) and a[0] == b[0] and a[1] < b[1] and haversine(a[2], a[3], b[2], b[3]) < 0.03:
                want.append((a[0], a[1], b[1]))
    assert sorted((r["g"], r["id"], r["id_2"]) for r in got.collect()) == sorted(want)
    assert set(joined) == {4, 5}
