from pyspark.sql import functions as F

from stokesweave.plans.ingest import ingest
from stokesweave.plans.merge import merge_fields
from stokesweave.sources.spectra_files import read_weights, write_weights


def write_csv(path, header, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join([",".join(header), *[",".join(map(str, r)) for r in rows]]) + "\n")


def test_ingest_one_epoch(spark, tmp_path):
    db = tmp_path / "db" / "epoch_0"
    write_csv(
        db / "field_data.csv",
        ["SBID", "FIELD_NAME", "RA_DEG", "DEC_DEG", "SELECT"],
        [(10, "RACS_test4_1.05_A", 10.0, -30.0, 1), (11, "RACS_test4_1.05_B", 11.5, -30.0, 1), (-1, "RACS_test4_1.05_C", 50.0, 0.0, 0)],
    )
    beams = ["BEAM_NUM", "RA_DEG", "DEC_DEG"]
    write_csv(db / "beam_inf_10-RACS_test4_1.05_A.csv", beams, [(0, 10.0, -30.0), (1, 10.5, -30.0)])
    write_csv(db / "beam_inf_11-RACS_test4_1.05_B.csv", beams, [(0, 11.0, -30.0)])
    write_csv(db / "beam_inf_99-RACS_test4_1.05_Z.csv", beams, [(0, 10.0, -30.0)])
    islands = spark.createDataFrame(
        [(b"s1", 10.2, -30.0, "RACS_test4_1.05_A"), (b"s2", 200.0, 40.0, "RACS_test4_1.05_A")],
        "Source_ID binary, RA double, Dec double, Tile_ID string",
    )
    islands.write.parquet(str(tmp_path / "islands"))
    comps = spark.createDataFrame([(b"g1", b"s1")], "Gaussian_ID binary, Source_ID binary")
    comps.write.parquet(str(tmp_path / "components"))
    spark.sql(f"CREATE DATABASE ingest_test LOCATION '{tmp_path}/warehouse'")
    counts = ingest(spark, str(tmp_path), 0, str(tmp_path / "islands"), str(tmp_path / "components"), "ingest_test")
    assert counts == {"islands": 2, "components": 1, "fields": 2, "beam_inf": 3, "source_fields": 2, "beams": 1}
    row = spark.table("ingest_test.beams").first()
    assert row.source_id == "s1" and row.n_fields == 2 and row.n_fields_dr1 == 1
    assert row.beams["RACS_A"].beam_list == [0, 1] and row.beams["RACS_A"].dr1
    assert row.beams["RACS_B"].sbids == [11] and not row.beams["RACS_B"].dr1


def test_weights_round_trip(spark, tmp_path):
    w = spark.createDataFrame([("i", 0, 2.5), ("i", 1, 4.0)], "stokes string, chan int, weight double")
    write_weights(w, str(tmp_path / "w"), ["stokes"])
    back = read_weights(spark, str(tmp_path / "w"))
    assert sorted((r.chan, r.weight) for r in back.collect()) == [(0, 2.5), (1, 4.0)]
    text = next((tmp_path / "w" / "stokes=i").glob("part-*")).read_text()
    assert text.startswith("#Channel Weight\n0 2.5\n")


def test_merge_keeps_single_fields_and_coadds_multiple(spark):
    cols = "source_id string, field_name string, stokes string, chan int, y int, x int, value double, weight double"
    px = spark.createDataFrame(
        [("a", "F", "i", 0, 0, 0, 1.0, 2.0), ("b", "F", "i", 0, 0, 0, 1.0, 1.0), ("b", "G", "i", 0, 0, 0, 4.0, 2.0)], cols
    )
    pf = spark.createDataFrame(
        [("a", "F", [1], [10], True), ("b", "F", [1], [10], True), ("b", "G", [2], [11], True)],
        "source_id string, field_name string, beam_list array<int>, sbids array<bigint>, dr1 boolean",
    )
    merged, updated = merge_fields(px, pf, ["F", "G"], "M")
    assert {(r.source_id, r.value, r.weight) for r in merged.collect()} == {("a", 1.0, 2.0), ("b", 3.0, 3.0)}
    new = {r.source_id: r for r in updated.where(F.col("field_name") == "M").collect()}
    assert updated.count() == 5 and new["b"].beam_list == [1, 2] and new["b"].sbids == [10, 11]
