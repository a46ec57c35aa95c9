"""Work that grew with passes, pairs or draws where it need not: few rounds, lists of pairs, draws in place."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stokesweave.operators import clipping


@pytest.mark.parametrize("center, scale, maxiters", [("median", "std", None), ("mean", "mad", None), ("median", "mad", 7)])
def test_many_passes_over_large_groups_take_few_rounds(spark, monkeypatch, center, scale, maxiters):
    rng = np.random.default_rng(4)
    groups = {"a": rng.uniform(1.0, 1e5, 30_000) ** 2, None: np.round(rng.normal(1e6, 50.0, 9_000)), "c": rng.standard_cauchy(20_000), "few": rng.normal(0.0, 1.0, 50)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values] + [("a", float("nan")), ("a", None)]
    written = []
    cut = clipping.cut_lineage
    monkeypatch.setattr(clipping, "cut_lineage", lambda df: written.append(1) or cut(df))
    got = {r.g: r for r in clipping.clip_limits(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", 1.9, center, scale, maxiters, small_group=100).collect()}
    assert set(got) == set(groups) and len(written) <= 9  # one a pass before
    for g, values in groups.items():
        want = clipping.clip_array(values, 1.9, center, scale, maxiters)
        assert np.allclose(got[g][1:], want, rtol=1e-9, atol=1e-9), g


def test_lists_of_sources_meet_lists_of_pointings(spark, monkeypatch):
    """Cut lists, null beams, blocks and fields, sources on the radius and sources of several rows give what the pairs give."""
    from stokesweave.operators import association

    monkeypatch.setattr(association, "SLICE", 7)
    monkeypatch.setattr(association, "PAIRS", 50)
    rng = np.random.default_rng(11)
    beams = [(f"F{i % 5}" if i % 11 else None, i % 6 if i % 7 else None, f"b{i % 13}" if i % 5 else None, *map(float, rng.uniform(-3, 3, 2))) for i in range(150)]
    beams += [("F9", None, None, 0.0, 0.0), ("F9", 3, "b2", 0.0, 1.0), ("F1", 1, "b10", None, 0.0), ("F1", 1, "b10", float("nan"), 0.0)]
    pointings = spark.createDataFrame(beams, "field_name string, beam_num int, sbid string, ra double, dec double")
    rows = [(f"s{i}", *map(float, rng.uniform(-4, 4, 2))) for i in range(60)] + [("on", 0.0, 2.0), ("s1", 0.5, 0.5), (None, 1.0, 1.0), ("no", None, 1.0), ("nan", float("nan"), 1.0)]
    islands = spark.createDataFrame(rows, "source_id string, ra double, dec double")
    tiles = spark.createDataFrame([("F1",), ("F3",), (None,)], "tile_id string")

    def as_rows(df):
        return sorted(repr((r["source_id"], r["field_name"], r["beam_list"], r["sbids"], r["dr1"])) for r in df.collect())

    want = as_rows(association.source_fields(association.beam_pairs(islands, pointings, 2.0), tiles, 1))
    assert len(want) > 100
    for told in ({"tiles": tiles}, {}):
        pairs = association.beam_pairs(islands, pointings, 2.0, nested=True, epoch=1, **told)
        nested = association.source_fields(pairs, tiles, 1)
        assert as_rows(association.field_rows(nested)) == want and "MapInArrow" in pairs._jdf.queryExecution().toString()

    from stokesweave.operators.fields import components_of_islands

    comps = spark.createDataFrame([("s2", 1), ("s2", 2), ("s3", 3), (None, 4), ("x", 5)], "source_id string, cat_id long")
    n_rows = spark.createDataFrame([("s2", 7), ("s3", 8)], "source_id string, n long")
    plain = components_of_islands(comps, association.field_rows(nested), n_rows)
    late = association.field_rows(components_of_islands(comps, nested, n_rows))
    columns = ["cat_id", "n", "field_name", "beam_list"]
    assert sorted(map(repr, late.select(columns).collect())) == sorted(map(repr, plain.select(columns).collect())) and not plain.isEmpty()


def test_sigma_add_draws_the_same_in_small_blocks(spark, monkeypatch):
    """Draws, medians and deviations are those of the definition, also where squares overflow; few rows are drawn for at once."""
    import pandas as pd

    from stokesweave.operators import complexity

    rng = np.random.default_rng(6)
    n = 200
    seeds = rng.integers(-(2**62), 2**62, n)
    par = [rng.uniform(0.05, 2.0, n) for _ in range(4)]
    for draws, scale in ((1000, 1.0), (7, 1.0), (1000, 1e155), (1000, 1e-200)):
        shape_q, scale_q, shape_u, scale_u = par[0], par[1] * scale, par[2], par[3] * scale
        u = complexity.uniforms(seeds, 2 * draws)
        radius, angle = np.sqrt(-2.0 * np.log(u[:, :draws])), 2.0 * np.pi * u[:, draws:]
        p = np.hypot(scale_q[:, None] * np.exp(shape_q[:, None] * radius * np.cos(angle)), scale_u[:, None] * np.exp(shape_u[:, None] * radius * np.sin(angle)))
        got = complexity.combined_moments(seeds, shape_q, scale_q, shape_u, scale_u, draws)
        assert np.allclose(got[0], np.median(p, axis=1), rtol=1e-12, atol=0)
        assert scale != 1.0 or np.allclose(got[1], p.std(axis=1), rtol=1e-12)
    sizes = []
    moments = complexity.combined_moments
    monkeypatch.setattr(complexity, "combined_moments", lambda s, *rest: sizes.append(len(s)) or moments(s, *rest))
    out = complexity._moments_udf(50).func(*[pd.Series(x) for x in (seeds, *par)])
    assert len(out) == n and sum(sizes) == n and max(sizes) <= 64  # 500 before


def test_gridded_map_builds_no_levels_it_does_not_reach(spark, monkeypatch):
    """Fine levels of the pyramid, as many cells as points each, are made when a tile goes down to them."""
    from stokesweave.operators import maps, nearest

    rng = np.random.default_rng(2)
    rows = [(i, float(x), float(y), float(i)) for i, (x, y) in enumerate(rng.uniform(10, 14, (400, 2)))]
    deepest, pyramid = [], nearest.pyramid
    monkeypatch.setattr(nearest, "pyramid", lambda points, lo, side, depth, *first: deepest.append(depth) or pyramid(points, lo, side, depth, *first))
    cat = spark.createDataFrame(rows, "id long, ra double, dec double, v double")
    got = maps.gridded_map(cat, "v", "id", npix=64, map_size=6.0, limit=500).where("value is not null").count()
    assert got > 500 and max(deepest) == 4  # 14 before


def test_binned_map_reads_its_input_once_for_its_bins(spark):
    from stokesweave.operators import maps

    rng = np.random.default_rng(3)
    rows = [(float(x), float(y), float(v)) for x, y, v in zip(rng.uniform(0, 2, 500), rng.uniform(0, 2, 500), rng.normal(0, 1, 500))]
    reads = spark.sparkContext.accumulator(0)

    def noted(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    df = spark.createDataFrame(rows, "ra double, dec double, v double").repartition(1).mapInArrow(noted, "ra double, dec double, v double")
    out = maps.binned_map(df, "v", 3).collect()
    assert len(out) == 9 and all(r["n"] > 0 for r in out)
    assert reads.value <= 6 * 500  # centre, box and bins


def test_holography_shuffles_no_sources_for_small_tables(spark, monkeypatch):
    """Beams and model are broadcast when counted small, whatever Spark estimates; larger ones are joined as before."""
    from stokesweave.operators import keyed, pixels

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rng = np.random.default_rng(4)
        sources = spark.createDataFrame([(i, i % 3, float(x), float(y)) for i, (x, y) in enumerate(rng.uniform(-1, 1, (40, 2)))], "cat_id long, beam int, ra double, dec double")
        beams = spark.createDataFrame([(b, 0.0, 0.0) for b in (0, 1, 1)], "beam int, beam_ra double, beam_dec double")
        model = spark.createDataFrame([(b, "q", c, y, x, float((b or 0) + c + x * y)) for b in (0, 1, 2, None) for c in (0, 1) for y in range(5) for x in range(5)], "beam int, stokes string, chan int, y int, x int, value double")

        def looked_up():
            out = pixels.holography_lookup(pixels.holography_pixel(sources, beams, 0.01, 0.01, 2, 2), model).select("cat_id", "chan", "leakage")
            return out._jdf.queryExecution().toString(), sorted(map(tuple, out.collect()))

        plan, rows = looked_up()
        monkeypatch.setattr(keyed, "BROADCAST_KEYS", 1)
        other, same = looked_up()
        assert "SortMergeJoin" not in plan and "SortMergeJoin" in other and rows == same and len(rows) > 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
