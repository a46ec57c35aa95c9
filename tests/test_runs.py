"""Stokes I modes, added noise and results written back, held against plain Python."""

import glob
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from stokesweave.operators.complexity import added_noise, noise_posterior
from stokesweave.plans import runs
from stokesweave.plans import spectra as spectra_plan
from stokesweave.session import scratch_path

PHI = [float(p) for p in range(-200, 201, 5)]
C = 299792458.0
LIST = "array<struct<field:string,rmsynth1d:boolean,note:string>>"


def lines(spark, sources, n=48, noise=0.001, extra=0.0, seed=3):
    """Thin sources with a Stokes I power law of exponent -0.8: key -> (fraction, angle in radians, rm)."""
    rng = np.random.default_rng(seed)
    rows = []
    for k, (p, a, rm) in sources.items():
        for c in range(n):
            nu = 8e8 + 6e6 * c
            i, angle = 2.0 * (nu / 9e8) ** -0.8, 2 * (a + rm * (C / nu) ** 2)
            q, u = (p * i * f(angle) + rng.normal(0, noise * math.hypot(1, extra)) for f in (math.cos, math.sin))
            rows.append((k, c, nu, float(i), float(q), float(u), noise, noise, noise))
    return spark.createDataFrame(rows, "cat_id long, chan int, freq double, i double, q double, u double, di double, dq double, du double")


SOURCES = {1: (0.3, 0.4, 30.0), 2: (0.1, 1.0, -45.0), 3: (0.2, 0.1, 80.0)}


def test_stokes_i_modes_agree_where_they_should(spark):
    s = lines(spark, SOURCES).cache()
    # the last component has no Taylor terms, the one before a zero where the model is to stand
    taylor = spark.createDataFrame([(1, 2.0, -1.6, 9e8), (2, 0.0, 1.0, 9e8)], "cat_id long, tt0 double, tt1 double, ref_nu double")
    with_terms = {r.cat_id: r for r in spectra_plan.spectral_measurements(s, PHI, stokes_i="taylor", taylor=taylor, clean=False).collect()}
    without = {r.cat_id: r for r in spectra_plan.spectral_measurements(s, PHI, stokes_i="none", clean=False).collect()}
    fitted = {r.cat_id: r for r in spectra_plan.spectral_measurements(s, PHI, clean=False).collect()}
    assert with_terms[1].rmsynth1d and not with_terms[2].rmsynth1d and not with_terms[3].rmsynth1d and with_terms[3].rm is None
    for got in (with_terms[1], fitted[1]):
        assert abs(got.fracpol - 0.3) < 0.005 and abs(got.rm - 30.0) < 0.5 and abs(got.polint - 0.3 * got.ifreq0) < 0.01
        assert math.isclose(got.ifreq0, 2.0 * (got.reffreq_pol / 9e8) ** -0.8, rel_tol=0.01)
    assert not with_terms[1].fit_flag_is_negative and "best_n" not in with_terms[1].asDict()
    for k, (p, _, rm) in SOURCES.items():
        assert without[k].rmsynth1d and without[k].fracpol is None and without[k].ifreq0 is None and abs(without[k].rm - rm) < 1.0
        assert abs(without[k].polint - p * 2.0) < 0.15 * p * 2.0  # a flux, blurred by the slope of I


def test_modes_refuse_unfit_arguments(spark):
    s = lines(spark, {1: SOURCES[1]}, n=4)
    with pytest.raises(ValueError):
        spectra_plan.spectral_measurements(s, PHI, stokes_i="taylor")
    with pytest.raises(ValueError):
        spectra_plan.spectral_measurements(s, PHI, stokes_i="other")


def test_band_shape_and_off_peak_deviation(spark):
    s = spark.createDataFrame([(1, 1.0, 0.1, 0.3), (1, 3.0, 0.2, None), (1, 2.0, 0.2, 0.6), (1, 7.0, 0.0, 0.2), (2, 5.0, None, None)], "cat_id long, freq double, dq double, du double")
    got = {r.cat_id: (r.dqu, r.median_channel_width) for r in spectra_plan.band_shape(s, ["cat_id"]).collect()}
    assert got[1] == (pytest.approx(0.2), 1.0) and got[2] == (None, None)
    phi = [float(p) for p in range(-50, 51)]
    rng = np.random.default_rng(1)
    re, im = rng.normal(0, 2, (2, len(phi)))
    df = spark.createDataFrame([(phi, re.tolist(), im.tolist(), 10.0, 5.0), (phi, re.tolist(), im.tolist(), 0.0, 60.0)], "phi array<double>, re array<double>, im array<double>, peak_phi double, rmsf_fwhm double")
    far, none = [r.m for r in df.select(spectra_plan.off_peak_mad().alias("m")).collect()]
    away = np.abs(np.array(phi) - 10.0) > 10.0
    values = np.concatenate([re[away], im[away]])
    assert far == pytest.approx(np.median(np.abs(values - np.median(values))) / 0.6745) and none is None


def test_noise_posterior_equals_fine_integration():
    for n, ratio in ((3, 5.0), (32, 0.4), (32, 1.0), (200, 4.0), (50, 0.0)):
        chi = n * ratio
        s = np.linspace(0, 400 if n == 3 else 12, 4_000_001)
        log = -0.5 * (n * np.log(1 + s * s) + chi / (1 + s * s))
        total = np.cumsum(np.exp(log - log.max()))
        low, mid, high = np.interp([0.1572, 0.5, 0.8427], total / total[-1], s)
        got = noise_posterior(np.array([n]), np.array([chi]))[0]
        assert got == pytest.approx([mid, mid - low, high - mid], rel=0.02, abs=0.01)
    assert np.isnan(noise_posterior(np.array([2, 5]), np.array([1.0, np.nan]))).all()


def test_added_noise_is_found(spark):
    peaks = spark.createDataFrame([(k, p, math.degrees(a), rm) for k, (p, a, rm) in SOURCES.items()], "cat_id long, polint double, derot_polangle double, rm double")
    for extra in (0.0, 3.0):
        s = lines(spark, SOURCES, n=200, extra=extra).withColumns({c: F.col(c) / F.col("i") for c in ("q", "u", "dq", "du")})
        out = added_noise(s.withColumn("lambda_sq", F.pow(C / F.col("freq"), 2)), peaks).collect()
        assert len(out) == 3
        for r in out:
            assert abs(r.sigma_add_q - extra) < 0.6 and abs(r.sigma_add_u - extra) < 0.6 and 0 < r.sigma_add_q_minus < 1 and 0 < r.sigma_add_q_plus < 1


def brute_merge(rows, results, replace=True):
    out = {}
    for key, old in rows.items():
        new = results.get(key)
        if new is None:
            out[key] = old
        elif old and any(e[0] == new[0] for e in old):
            out[key] = [tuple(b if b is not None else a for a, b in zip(e, new)) if replace and e[0] == new[0] else e for e in old]
        else:
            out[key] = [*(old or []), new]
    return out


ROWS = {
    1: None,
    2: [],
    3: [("a", True, "old")],
    4: [("b", False, None), ("a", False, "old")],
    5: [(None, True, "nameless")],
    6: [("a", True, "left alone")],
}
RESULTS = {1: ("a", True, "n1"), 2: ("a", False, None), 3: ("a", False, None), 4: ("a", True, "n4"), 5: ("a", True, "n5"), 9: ("a", True, "no row")}


def as_dict(df):
    return {r.cat_id: None if r.rm_outputs_1d is None else [tuple(e) for e in r.rm_outputs_1d] for r in df.collect()}


def tables_of(spark):
    target = spark.createDataFrame([(k, v, f"x{k}") for k, v in ROWS.items()], f"cat_id long, rm_outputs_1d {LIST}, run string")
    results = spark.createDataFrame([(k, v) for k, v in RESULTS.items()], "cat_id long, run struct<field:string,rmsynth1d:boolean,note:string>")
    return target, results


@pytest.mark.parametrize("replace", [True, False])
def test_merge_runs_equals_brute_force(spark, replace):
    target, results = tables_of(spark)
    once = runs.merge_runs(target, results, replace=replace)
    assert once.columns == target.columns and {r.run for r in once.collect()} == {f"x{k}" for k in ROWS}  # a column named as the result's
    assert as_dict(once) == brute_merge(ROWS, RESULTS, replace)
    assert as_dict(runs.merge_runs(once, results, replace=replace)) == as_dict(once)
    assert as_dict(runs.merge_runs(target, results.limit(0), replace=replace)) == ROWS
    assert runs.merge_runs(target.limit(0), results, replace=replace).count() == 0


def test_two_results_of_one_key_are_an_error(spark):
    target, results = tables_of(spark)
    with pytest.raises(Exception, match="several results"):
        runs.merge_runs(target, results.unionByName(results)).collect()


def test_store_runs_touches_only_its_parts_and_repeats_safely(spark):
    target, results = tables_of(spark)
    path = scratch_path(spark, "stored")
    runs.store_components(target, path, 64)
    stamps = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{path}/part=*/*.parquet")}
    some = results.where("cat_id in (3, 4)")
    touched = runs.store_runs(spark, path, some, 64)
    kept = {f for f in stamps if int(f.split("part=")[1].split("/")[0]) not in touched}
    assert kept and all(os.stat(f).st_mtime_ns == stamps[f] for f in kept)
    expected = brute_merge(ROWS, {k: RESULTS[k] for k in (3, 4)})
    assert as_dict(spark.read.parquet(path)) == expected
    assert runs.store_runs(spark, path, some, 64) == touched and as_dict(spark.read.parquet(path)) == expected
    runs.store_runs(spark, path, results, 64)
    assert as_dict(spark.read.parquet(path)) == brute_merge(expected, RESULTS)
    assert runs.store_runs(spark, path, results.limit(0), 64) == []


def test_broken_write_names_the_folder_that_keeps_the_rows(spark, monkeypatch):
    target, results = tables_of(spark)
    path = scratch_path(spark, "stored")
    runs.store_components(target, path, 4)

    def broken(*_):
        raise OSError("disk")

    with monkeypatch.context() as m:
        m.setattr(runs, "write_upsert", broken)
        with pytest.raises(RuntimeError, match="kept in") as failure:
            runs.store_runs(spark, path, results, 4)
    kept = spark.read.parquet(str(failure.value).rsplit(" ", 1)[1])
    runs.write_upsert(kept, path, runs.PART)
    assert as_dict(spark.read.parquet(path)) == brute_merge(ROWS, RESULTS)


def test_elements_carry_the_catalogue_keys(spark):
    measured = spectra_plan.spectral_measurements(lines(spark, SOURCES), PHI, max_iter=200)
    dead = measured.limit(0)
    out = {r.cat_id: r.run for r in runs.run_elements(measured, "F", headers=measured.select("cat_id", F.lit(0.1).alias("BMAJ"))).collect()}
    assert runs.run_elements(dead, "F").count() == 0
    for k, (p, _, rm) in SOURCES.items():
        run = out[k]
        assert run.field == "F" and run.rmsynth1d and run.rmclean1d and run.header.BMAJ == 0.1
        summary = run.rmsynth_summary
        assert abs(summary.phiPeakPIfit_rm2 - rm) < 1.0 and abs(summary.fracPol - p) < 0.01 and summary.median_channel_width == pytest.approx(6e6)
        coefficients = summary.polyCoeffs.split(",")
        assert len(coefficients) == 5 and float(coefficients[-2]) == pytest.approx(-0.8, abs=0.05)
        assert summary.sigmaAddQ is not None and summary.dFDFcorMAD > 0 and run.rmclean_summary.mom2CCFDF is not None


def test_catalogue_from_spectra(spark):
    from workbench.q_runs import spectra_to_catalogue

    for mode in ("fit", "taylor"):
        rows = spectra_to_catalogue(spark, "/root/testdata/sf0.001", mode).collect()
        assert rows and all(r.rm is not None and r.polint is not None and r.Nchan == 32 and r.channelwidth == 9e6 for r in rows)
        assert all((r.spectral_index is None) == (mode == "taylor") for r in rows)
