import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from stokesweave.functions import nested
from stokesweave.operators import fields, keyed, pixels, release
from stokesweave.sources import schema, tables


def test_upsert_is_idempotent(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, name string, v double")
    new = spark.createDataFrame([(2, None), (3, 9.0)], "k int, v double")
    once = tables.upsert(target, new, ["k"])
    twice = tables.upsert(once, new, ["k"])
    rows = sorted(tuple(r) for r in once.collect())
    assert rows == sorted(tuple(r) for r in twice.collect())
    assert rows == [(1, "a", 1.0), (2, "b", None), (3, None, 9.0)]


def test_missing_field_table_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_field_table(spark, str(tmp_path), 0)


def test_metadata_survives_parquet(spark, tmp_path):
    df = spark.createDataFrame([(1.0,)], "x double").select(F.col("x").alias("flux", metadata={"unit": "mJy"}))
    df.write.parquet(str(tmp_path / "m"))
    back = schema.to_jy(spark.read.parquet(str(tmp_path / "m")))
    assert back.schema["flux"].metadata["unit"] == "Jy" and back.first().flux == 1e-3


def test_declared_schema():
    assert len(schema.COLUMNS) == 79 and len({c.name for c in schema.COLUMNS}) == 79
    assert schema.catalogue_schema()["Nchan"].dataType.simpleString() == "int"


def test_write_catalogue(spark, tmp_path):
    df = spark.createDataFrame([("x", 1.0)], "catalog string, ra double")
    out = tables.write_catalogue(df, str(tmp_path / "my-cat.v1"))
    assert out.columns == ["catalog_name", "ra"] and out.schema["ra"].metadata["unit"] == "---"
    params = {r.param: r.value for r in spark.read.json(str(tmp_path / "my-cat.v1/params")).collect()}
    assert params["Catalogue_Name"] == "my_cat"


def test_rename_reserved(spark):
    assert tables.rename_reserved(spark.createDataFrame([(1, 2)], "Maj int, RA int")).columns == ["Maj_axis", "RA"]


def test_select_best_falls_back_and_raises(spark):
    f = spark.createDataFrame([("A", 1, 0), ("B", 2, 0), ("C", 3, 1)], "field_name string, sbid int, sel int")
    assert fields.select_best(f, F.col("field_name").isin("A", "C")).collect()[0].field_name == "C"
    assert fields.select_best(f, F.col("field_name").isin("A", "B")).count() == 2
    with pytest.raises(ValueError):
        fields.select_best(f, F.col("field_name") == "Z", strict=True)


def test_validate_sbid_field(spark):
    f = spark.createDataFrame([("A", 1)], "field_name string, sbid int")
    assert fields.validate_sbid_field(f, "A", 1) and not fields.validate_sbid_field(f, "B", 1)
    with pytest.raises(ValueError):
        fields.validate_sbid_field(f, "A", 2)


def test_integration_time_of_one_block(spark):
    cat = spark.createDataFrame([("X_A", 1), ("Y_B", 2)], "tile_id string, cat_id int")
    f = spark.createDataFrame([("X_", 5, 10.0, 1), ("X_", 6, 20.0, 1), ("Y_", 7, 30.0, 1)], "field_name string, sbid int, scan_tint double, sel int")
    assert {r.cat_id: r.int_time for r in fields.int_time_lookup(cat, f).collect()} == {1: 20.0, 2: 30.0}
    assert {r.int_time for r in fields.int_time_lookup(cat, f, sbid=5).collect()} == {10.0}
    with pytest.raises(ValueError):
        fields.int_time_lookup(cat, f.where("field_name = 'X_'"))


def test_release_kinds(spark):
    cat = spark.range(150).select(F.col("id").alias("cat_id"), (F.col("id") % 2 == 0).alias("stokesI_fit_flag"), F.col("id").cast("double").alias("snr_polint"))
    assert release.release_subset(cat, "full").count() == 150
    assert release.release_subset(cat, "cut").count() == 75
    assert release.release_subset(cat, "test").count() == 100
    with pytest.raises(ValueError):
        release.release_subset(cat, "other")


def test_products_must_cover_the_catalogue(spark):
    cat = spark.createDataFrame([(1,), (2,)], "source_id int")
    have = spark.createDataFrame([(1,), (2,), (3,)], "source_id int")
    assert release.matched_products(have, cat).count() == 2
    assert [r.source_id for r in release.excluded_sources(have, cat).collect()] == [3]
    with pytest.raises(ValueError):
        release.matched_products(have.where("source_id = 1"), cat)


def test_component_or_island_keeps_nan(spark):
    c = spark.createDataFrame([("s", 1, float("nan")), ("s", 2, None)], "source_id string, cat_id int, v double")
    i = spark.createDataFrame([("s", 5.0)], "source_id string, v double")
    rows = {r.cat_id: r.v for r in fields.component_or_island(c, i, ["v"]).collect()}
    assert rows[1] != rows[1] and rows[2] == 5.0
    with pytest.raises(ValueError):
        fields.component_or_island(c, i, ["w"])


def test_push_initialises_missing_array(spark):
    df = spark.createDataFrame([(1, None)], "k int, a array<struct<field: string, done: boolean>>")
    new = F.struct(F.lit("f").alias("field"), F.lit(False).alias("done"))
    row = df.select(nested.push_element("a", new, {"field": "f"}).alias("a")).first()
    assert [tuple(x) for x in row.a] == [("f", False)]


def test_pairing_and_completeness(spark):
    im = spark.createDataFrame([(1, "a")], "k int, image string")
    wt = spark.createDataFrame([(1, "w"), (2, "x")], "k int, weight_image string")
    with pytest.raises(ValueError):
        pixels.require_paired(pixels.pair_weights(im, wt, ["k"]))
    px = spark.createDataFrame([(1, "i"), (1, "q")], "source_id int, stokes string")
    with pytest.raises(ValueError):
        pixels.require_complete(px, ["source_id"])
    with pytest.raises(ValueError):
        pixels.require_one_set(spark.createDataFrame([("a", "p"), ("b", "p")], "ms string, prefix string"))


def test_annulus_noise_clips_outliers(spark):
    import numpy as np

    rng = np.random.default_rng(2)
    rows = [(1, x, y, float(rng.normal(1.0, 0.1))) for x in range(40) for y in range(40)]
    rows = [(s, x, y, 99.0 if (x, y) == (20, 28) else v) for s, x, y, v in rows]
    px = spark.createDataFrame(rows, "source_id int, x int, y int, value double")
    r = pixels.annulus_noise(px, ["source_id"], 3.0, 40, 40).first()
    assert abs(r.background - 1.0) < 0.02 and abs(r.noise - 0.1) < 0.02
    big = pixels.annulus_noise(px, ["source_id"], 3.0, 40, 40, clip=False).first()
    assert big.noise > 1.0


def test_remove_leakage_and_coadd(spark):
    px = spark.createDataFrame([(1, "q", 0, 0, 0, 2.0, 10.0, 1.0), (2, "q", 0, 0, 0, 3.0, 10.0, 3.0)], "beam int, stokes string, chan int, y int, x int, value double, stokes_i double, weight double")
    leak = spark.createDataFrame([(1, "q", 0, 0.1)], "beam int, stokes string, chan int, leakage double")
    fixed = pixels.remove_leakage(px, leak)
    assert {r.beam: r.value for r in fixed.collect()} == {1: 1.0, 2: 3.0}
    assert pixels.coadd(fixed, ["stokes", "chan", "y", "x"]).first().value == (1.0 + 9.0) / 4.0


def test_latest_per_key_ignores_storage_order(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 3, 1), ("a", 2, 9), ("b", 1, 1)], "k string, sbid int, v int")
    assert sorted(tuple(r) for r in keyed.latest_per_key(df.repartition(3), ["k"], ["sbid"]).collect()) == [("a", 3, 1), ("b", 1, 1)]


@pytest.mark.parametrize("hot", [None, 3])
def test_skew_join_keeps_every_pair(spark, hot):
    a = spark.createDataFrame([(i % 4 if i > 10 else 0, i) for i in range(40)], "k int, a int")
    b = spark.createDataFrame([(i % 5 if i > 20 else 0, i) for i in range(50)], "k int, b int")
    got = sorted(tuple(r) for r in keyed.skew_join(a, b, ["k"], hot_rows=hot).select("k", "a", "b").collect())
    want = sorted(tuple(r) for r in a.join(b, "k").select("k", "a", "b").collect())
    assert got == want and len(got) == len(set(got))


@pytest.mark.parametrize("broadcast_keys", [500_000, 0])
def test_skew_join_of_equal_rows_and_of_many_pairs(spark, monkeypatch, broadcast_keys):
    """Keys hot by their product alone, with rows that are all equal: every pair once, slices of even size."""
    from collections import Counter

    monkeypatch.setattr(keyed, "BROADCAST_KEYS", broadcast_keys)
    monkeypatch.setattr(keyed, "PAIRS_PER_ROW", 1)
    a = spark.createDataFrame([(1, "x")] * 90 + [(2, "y")] * 3 + [(None, "n"), (4, "z")], "k int, a string").repartition(3)
    b = spark.createDataFrame([(1, "u")] * 80 + [(1, "v")] * 10 + [(2, "w")] * 99 + [(None, "n"), (3, "t")], "k int, b string").repartition(3)
    got = Counter(tuple(r) for r in keyed.skew_join(a, b, ["k"], hot_rows=100).select("k", "a", "b").collect())
    assert got == {(1, "x", "u"): 7200, (1, "x", "v"): 900, (2, "y", "w"): 297}
    cuts = keyed.hot_keys(a, b, ["k"], 100)
    assert sorted(tuple(r) for r in cuts.collect()) == [(1, 9, 9), (2, 1, 3)]
    left, right, on = keyed.slice_hot_keys(a, b, ["k"], cuts, small=bool(broadcast_keys))
    pairs = [r["count"] for r in left.join(right, on).groupBy(*on).count().collect()]
    assert sum(pairs) == 8397 and max(pairs) <= 200 and len(pairs) == 84


def test_entry_and_registry(spark):
    assert entry.entry(spark).count() > 0
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q) and len(q) > 100
    # the text operators are registered together or not at all
    assert sum(n.startswith("op") and n[2].isdigit() for n in q) in (0, 13)


def near_pole(box, step):
    """Pixel box on an image about the north pole: RA runs about its middle, so corners are moved and seen as vectors."""
    import numpy as np

    xs, ys = [], []
    out = np.radians(0.001 * 3.0 * np.sqrt(2.0))
    for ra, dec, angle in ((box.ra_right, box.dec_high, -45), (box.ra_left, box.dec_low, 135), (box.ra_left, box.dec_high, 45), (box.ra_right, box.dec_low, -135)):
        a, d, t = np.radians([ra, dec, angle])
        at = np.array([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)])
        east, north = np.array([-np.sin(a), np.cos(a), 0]), np.array([-np.sin(d) * np.cos(a), -np.sin(d) * np.sin(a), np.cos(d)])
        to = np.cos(out) * at + np.sin(out) * (np.cos(t) * north + np.sin(t) * east)
        xs.append(np.degrees(to[1]) / -step + 50)
        ys.append(np.degrees(-to[0]) / step + 50)
    return int(np.floor(min(xs))), int(np.ceil(max(xs))), int(np.floor(min(ys))), int(np.ceil(max(ys)))


def test_sky_boxes_become_pixel_boxes(spark):
    from pyspark.sql import functions as F

    from stokesweave.operators import association, pixels

    step = 0.001
    # a source across RA 0, one whose components stand around the pole, one off its image
    rows = [(1, 359.999, 10.0), (1, 0.001, 10.002), (2, 0.0, 89.999), (2, 120.0, 89.999), (2, 240.0, 89.999), (3, 50.0, 0.0)]
    parts = spark.createDataFrame([(*r, 2.0) for r in rows], "source_id long, ra double, dec double, maj double")
    images = spark.createDataFrame(
        [(1, 0.0, 10.0), (2, 0.0, 90.0), (3, 60.0, 0.0), (3, 240.0, 0.0)], "source_id long, ra0 double, dec0 double"
    ).withColumns({"crpix_x": F.lit(51.0), "crpix_y": F.lit(51.0), "cdelt_x": F.lit(-step), "cdelt_y": F.lit(step), "nx": F.lit(101), "ny": F.lit(101), "beam_maj": F.lit(0.001)})
    boxes = association.source_box(parts)
    found = {r.source_id: r for r in pixels.pixel_boxes(boxes, images, "source_id").collect()}
    assert set(found) == {1, 2}
    a = found[1]
    # components within two pixels of the middle, two arc seconds and three beams of margin
    assert 42 <= a.x_lo <= 46 and 54 <= a.x_hi <= 58 and 43 <= a.y_lo <= 47 and 55 <= a.y_hi <= 59
    # all four corners count: the left ones are not on the left here
    p = found[2]
    assert (p.x_lo, p.x_hi, p.y_lo, p.y_hi) == near_pole(boxes.where("source_id = 2").first(), step)
    grid = spark.range(101 * 101).select((F.col("id") % 101).cast("int").alias("x"), F.floor(F.col("id") / 101).cast("int").alias("y"), F.lit(1).cast("long").alias("source_id"))
    box = pixels.pixel_boxes(boxes, images, "source_id").select("source_id", "x_lo", "x_hi", "y_lo", "y_hi")
    assert pixels.cutout(grid, box, ["source_id"]).count() == (a.x_hi - a.x_lo) * (a.y_hi - a.y_lo)
