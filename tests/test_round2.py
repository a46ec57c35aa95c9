"""Rows that were wrong before: duplicate updates, unknown Gaussians, odd spectra, exact fits, derotated errors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stokesweave.operators.association import blended_components
from stokesweave.operators.faraday import regular_grid
from stokesweave.operators.powerlaw import aic_value
from stokesweave.plans.spectra import spectral_measurements
from stokesweave.sources.tables import read_beam_pointings, upsert, write_upsert


def test_upsert_takes_the_latest_of_one_key(spark, tmp_path):
    target = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k int, v string, at int")
    updates = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (3, "z", 1)], "k int, v string, at int")
    got = sorted(tuple(r) for r in upsert(target, updates, ["k"], order="at").collect())
    assert got == [(1, "y", 2), (2, "b", 0), (3, "z", 1)]
    with pytest.raises(Exception, match="several updates"):
        upsert(target, updates, ["k"]).collect()
    path = str(tmp_path / "t")
    target.write.partitionBy("k").parquet(path)
    write_upsert(spark.createDataFrame([(1, "n", 5)], "k int, v string, at int"), path, "k")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [(1, "n"), (2, "b")]


def test_unknown_number_of_gaussians_is_not_one(spark):
    rows = [("s", 10.0, 0.0, 1.0, 0.02, None), ("s", 10.001, 0.0, 1.0, 0.02, None), ("t", 50.0, 0.0, 1.0, 0.02, 1), ("t", 50.001, 0.0, 1.0, 0.02, 1)]
    import inspect

    names = inspect.signature(blended_components).parameters
    d = {n: p.default for n, p in names.items()}
    cols = [d["source"], *d["pos"], d["flux"], d["beam"], "n_gaus"]
    cat = spark.createDataFrame(rows, cols).withColumn("cat_id", F.monotonically_increasing_id())
    out = blended_components(cat, n_gaus="n_gaus").collect()
    flag = next(c for c in out[0].asDict() if "blend" in c and isinstance(out[0][c], bool))
    assert {r[flag] for r in out if r[d["source"]] == "s"} == {True} and {r[flag] for r in out if r[d["source"]] == "t"} == {False}


def test_exact_fit_ranks_first():
    assert np.isfinite(aic_value(0.0, 1, 30)) and aic_value(0.0, 1, 30) < aic_value(1e-30, 1, 30)
    assert aic_value(0.0, 1, 30) < aic_value(0.0, 2, 30) and np.isnan(aic_value(np.nan, 1, 30))


def test_beam_files_are_read_by_header_name(spark, tmp_path):
    folder = tmp_path / "db" / "epoch_3"
    folder.mkdir(parents=True)
    (folder / "beam_inf_11-F A.csv").write_text("BEAM_NUM,BEAM_TIME,RA_DEG,DEC_DEG\n0,55.5,10.25,-20.5\n1,56.5,11.25,-21.5\n")
    (folder / "beam_inf_12-F_1+2.csv").write_text('DEC_DEG,COMMENT,RA_DEG,BEAM_NUM\r\n-1.5,"a, b",2.5,7\r\n')
    (folder / "beam_inf_13-FC.csv").write_text("BEAM_NUM,RA_DEG\nx,3.5\n")
    (folder / "beam_inf_14-FD.csv").write_text("BEAM_NUM,RA_DEG,DEC_DEG\n")
    (folder / "beam_inf_15-FE.csv").write_text("")
    fields = spark.createDataFrame([("F A", 11), ("F_1+2", 12), ("FC", 13), ("FD", 14), ("FE", 15), ("FF", -1)], "FIELD_NAME string, SBID long")
    got = sorted(tuple(r) for r in read_beam_pointings(spark, str(tmp_path), 3, fields).collect())
    assert got == sorted([("F A", 11, 0, 10.25, -20.5), ("F A", 11, 1, 11.25, -21.5), ("F_1+2", 12, 7, 2.5, -1.5), ("FC", 13, None, 3.5, None)])


def test_polarised_fluxes_of_a_bright_sloped_source(spark):
    freq = np.linspace(744e6, 1032e6, 48)
    rows = []
    for cid, (norm, alpha, frac, rm) in {1: (5.0, -0.8, 0.04, 42.0), 2: (0.5, 0.0, 0.3, -60.0)}.items():
        for c, nu in enumerate(freq):
            i = norm * (nu / 888e6) ** alpha * (1 + 1e-5 * np.sin(7.0 * c))
            v = frac * i * np.exp(2j * (0.4 + rm * (299792458.0 / nu) ** 2))
            rows.append((cid, c, float(nu), float(i), float(v.real), float(v.imag), 1e-3, 1e-3, 1e-3))
    s = spark.createDataFrame(rows, "cat_id long, chan int, freq double, i double, q double, u double, di double, dq double, du double")
    out = {r.cat_id: r for r in spectral_measurements(s, regular_grid(200.0, 5.0), clean=False).collect()}
    for cid, (norm, alpha, frac, _) in {1: (5.0, -0.8, 0.04, 0), 2: (0.5, 0.0, 0.3, 0)}.items():
        r = out[cid]
        at = norm * (r.reffreq_pol / 888e6) ** alpha
        assert abs(r.ifreq0 - at) < 0.01 * at and abs(r.fracpol - frac) < 0.02 * frac and abs(r.polint - frac * at) < 0.02 * frac * at
        assert abs(np.hypot(r.stokes_q, r.stokes_u) - r.polint) < 0.01 * r.polint
        # noise of the channels over the square root of their number, in flux units
        assert 0.8 < r.polint_err / (1e-3 / np.sqrt(48)) < 1.3
