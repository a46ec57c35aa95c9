import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stokesweave.operators import faraday, powerlaw, spectra
from stokesweave.plans.spectra import spectral_measurements

FREQ = np.linspace(744e6, 1032e6, 72)
L2 = (299792458.0 / FREQ) ** 2
PHI = faraday.regular_grid(300.0, 5.0)


def thin(spark, sources, noise=1e-3, flux=1.0):
    rows = []
    for cid, (p, chi, rm) in sources.items():
        v = p * np.exp(2j * (chi + rm * L2))
        rows += [(cid, c, float(FREQ[c]), flux, float(v[c].real), float(v[c].imag), noise, noise, noise) for c in range(FREQ.size)]
    df = spark.createDataFrame(rows, "cat_id long, chan int, freq double, i double, q double, u double, di double, dq double, du double")
    return df.withColumns({"lambda_sq": F.pow(299792458.0 / F.col("freq"), F.lit(2.0)), "dqu": (F.col("dq") + F.col("du")) / 2})


SOURCES = {1: (0.1, 0.4, 42.0), 2: (0.3, 1.1, -128.0), 3: (0.05, 0.0, 7.5)}


def test_thin_source_peaks_at_its_rm(spark):
    s = thin(spark, SOURCES)
    peaks = faraday.fdf_peak(faraday.rm_synthesis(s, PHI), faraday.synthesis_scalars(s))
    for r in peaks.collect():
        p, chi, rm = SOURCES[r.cat_id]
        assert abs(r.rm - rm) < 0.5
        assert abs(r.polint - p) < 0.02 * p
        d = (r.derot_polangle - math.degrees(chi)) % 180
        assert min(d, 180 - d) < 3.0
        assert r.snr_polint > 100


def test_synthesis_equals_numpy(spark):
    s = thin(spark, {1: SOURCES[1]})
    v = SOURCES[1][0] * np.exp(2j * (SOURCES[1][1] + SOURCES[1][2] * L2))
    l0 = L2.mean()
    got = {round(r.phi, 6): complex(r.re, r.im) for r in faraday.rm_synthesis(s, PHI).collect()}
    for phi in PHI:
        assert abs(got[round(phi, 6)] - (v * np.exp(-2j * phi * (L2 - l0))).mean()) < 1e-10


def test_missing_channels_do_not_count(spark):
    s = thin(spark, {1: SOURCES[1]})
    broken = s.withColumn("q", F.when(F.col("chan") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("q")))
    a = {r.phi: (r.re, r.im) for r in faraday.rm_synthesis(broken, PHI).collect()}
    b = {r.phi: (r.re, r.im) for r in faraday.rm_synthesis(s.where("chan % 9 <> 0"), PHI).collect()}
    assert all(np.allclose(a[k], b[k], atol=1e-12) for k in b)


def test_rmsf_is_one_at_zero_depth(spark):
    rows = faraday.rmsf(thin(spark, {1: SOURCES[1]}), PHI).collect()
    assert len(rows) == 2 * len(PHI) - 1
    zero = min(rows, key=lambda r: abs(r.phi))
    assert math.isclose(zero.re, 1.0, abs_tol=1e-12) and abs(zero.im) < 1e-12


def test_clean_recovers_a_delta(spark):
    s = thin(spark, SOURCES)
    cleaned = faraday.rm_clean(
        faraday.rm_synthesis(s, PHI), faraday.rmsf(s, PHI), faraday.synthesis_scalars(s), cutoff=0.002, gain=0.1
    ).collect()
    assert len(cleaned) == 3
    for r in cleaned:
        p, _, rm = SOURCES[r.cat_id]
        model = np.array(r.model_re) + 1j * np.array(r.model_im)
        assert r.ok and r.n_iter > 0
        assert abs(np.array(r.phi)[np.abs(model).argmax()] - rm) <= 5.0
        assert abs(abs(model.sum()) - p) < 0.15 * p


def test_clean_reports_bad_spectra(spark):
    s = thin(spark, {1: SOURCES[1]})
    fdf = faraday.rm_synthesis(s, PHI).withColumn("re", F.lit(float("nan")))
    row = faraday.rm_clean(fdf, faraday.rmsf(s, PHI), faraday.synthesis_scalars(s)).first()
    assert row.ok is False


def test_phi_grid_covers_the_band(spark):
    grid = faraday.phi_grid(thin(spark, {1: SOURCES[1]}))
    fwhm = faraday.rmsf_width(L2.min(), L2.max())
    assert math.isclose(grid[1] - grid[0], fwhm / 5, rel_tol=1e-9) and grid[-1] >= 10 * fwhm - fwhm
    assert min(abs(p) for p in grid) < 1e-9


def test_derotation_undoes_modulation(spark):
    s = thin(spark, {1: SOURCES[1]}).withColumn("source_id", F.lit(5))
    series = spark.createDataFrame([(5, float(t), 2.0) for t in range(10)], "source_id int, t double, rm double")
    theta = faraday.faraday_modulation(series, list(FREQ), time="t", start=2.0, end=7.0)
    turned = {1: (SOURCES[1][0], SOURCES[1][1], SOURCES[1][2] + 2.0)}
    obs = thin(spark, turned).withColumn("source_id", F.lit(5))
    back = {r.chan: (r.q, r.u) for r in spectra.derotate(obs, theta, ["source_id", "chan"]).collect()}
    for r in s.collect():
        assert np.allclose(back[r.chan], (r.q, r.u), atol=1e-9)


def test_derotation_is_identity_without_ionosphere(spark):
    s = thin(spark, {1: SOURCES[1]}).withColumn("source_id", F.lit(5))
    series = spark.createDataFrame([(5, 0.0)], "source_id int, rm double")
    theta = faraday.faraday_modulation(series, list(FREQ))
    back = {r.chan: (r.q, r.u) for r in spectra.derotate(s, theta, ["source_id", "chan"]).collect()}
    assert all(np.allclose(back[r.chan], (r.q, r.u), atol=1e-12) for r in s.collect())


def test_power_law_fit_recovers_slope(spark):
    rng = np.random.default_rng(3)
    truth = {1: (2.0, -0.7), 2: (0.5, 0.4), 3: (1.0, 0.0)}
    rows = []
    for cid, (s0, a) in truth.items():
        for c, f in enumerate(FREQ):
            rows.append((cid, c, float(f), float(s0 * (f / FREQ.mean()) ** a + rng.normal(0, 0.003)), 0.003))
    rows += [(9, c, float(f), float("nan"), 0.003) for c, f in enumerate(FREQ)]
    df = spark.createDataFrame(rows, "cat_id long, chan int, freq double, i double, di double")
    fit = {r.cat_id: r for r in powerlaw.fit_power_law(df).collect()}
    for cid in (1, 2):
        assert fit[cid].best_n == 1 and abs(fit[cid].best_p[1] - truth[cid][1]) < 0.02
        assert 0.5 < fit[cid].chi_sq_red < 1.6 and not fit[cid].is_not_normal
    assert fit[3].best_n == 0 and abs(fit[3].best_p[0] * fit[3].ref_nu - 1.0) < 0.01
    assert not fit[9].ok and fit[9].is_negative and fit[9].is_close_to_zero


def test_occam_rule_agrees_with_helper(spark):
    cases = {1: [10.0, 9.0, 9.5], 2: [10.0, 5.0, 4.0], 3: [3.0, 9.0, 8.0], 4: [float("nan"), 2.0, 1.5]}
    rows = [(k, n, v) for k, vals in cases.items() for n, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "k int, n_terms int, aic double")
    got = {r.k: r.n_terms for r in spectra.occam_aic(df, ["k"]).collect()}
    assert got == {k: powerlaw.pick_model(np.array(v)) for k, v in cases.items()} == {1: 0, 2: 1, 3: 0, 4: 1}


def test_normality_column_agrees_with_helper(spark):
    rng = np.random.default_rng(5)
    groups = {1: rng.normal(0, 1, 80), 2: rng.exponential(1, 80)}
    df = spark.createDataFrame([(k, float(v)) for k, vals in groups.items() for v in vals], "k int, v double")
    for r in spectra.normality(df, ["k"], "v").collect():
        assert math.isclose(r.p_value, powerlaw.normality_p(groups[r.k]), rel_tol=1e-6)


def test_spectral_measurements_end_to_end(spark):
    s = thin(spark, SOURCES).drop("lambda_sq", "dqu")
    dead = s.where("cat_id = 1").withColumns({"cat_id": F.lit(8).cast("long"), "q": F.lit(0.0)})
    out = {r.cat_id: r for r in spectral_measurements(s.unionByName(dead), PHI, cutoff=-3.0, max_iter=300).collect()}
    assert set(out) == {1, 2, 3, 8}
    assert out[8].rmsynth1d is False and out[8].rmclean1d is False and out[8].rm is None
    for k, (_, _, rm) in SOURCES.items():
        assert out[k].rmsynth1d and out[k].rmclean1d and abs(out[k].rm - rm) < 1.0 and out[k].rm_width is not None


@pytest.mark.parametrize("bad", [0, 5])
def test_clip_channels_blanks_all_stokes(spark, bad):
    s = thin(spark, {1: SOURCES[1]}).withColumn("dq", F.when(F.col("chan") == bad, F.lit(0.5)).otherwise(F.lit(0.01) + F.col("chan") * 1e-5))
    rows = {r.chan: r for r in spectra.clip_channels(s, ["cat_id"]).collect()}
    assert rows[bad].clipped and math.isnan(rows[bad].i) and math.isnan(rows[bad].u)
    assert not rows[bad + 1].clipped and rows[bad + 1].i == 1.0


def test_cleaning_queries_reach_the_noise(spark):
    from workbench.registry import QUERIES
    import workbench.q_spectra  # noqa: F401 - importing registers queries

    rows = QUERIES["rm_clean"](spark, "/root/testdata/sf0.001").collect()
    assert rows and sum(r.n_iter > 0 for r in rows) > 0.5 * len(rows)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_one_exchange_whatever_the_depths(spark):
    s = thin(spark, SOURCES)
    grid = faraday.regular_grid(1000.0, 1.0)
    peaks = faraday.spectrum_peaks(s, grid)
    assert exchanges(peaks) == exchanges(faraday.clean_spectra(s, grid)) == exchanges(faraday.rm_synthesis(s, grid)) == 1
    assert len(peaks.columns) == 19
    assert all(abs(r.rm - SOURCES[r.cat_id][2]) < 0.5 for r in peaks.collect())


def test_nested_peaks_equal_long_ones(spark):
    s = thin(spark, SOURCES)
    # other channels are missing from each spectrum, so every one has a band of its own
    s = s.withColumn("q", F.when((F.col("chan") * 7 + F.col("cat_id")) % 11 == 0, F.lit(None)).otherwise(F.col("q"))).where("chan <> 3 + cat_id")
    long = faraday.fdf_peak(faraday.rm_synthesis(s, PHI), faraday.synthesis_scalars(s)).orderBy("cat_id").collect()
    nested = faraday.spectrum_peaks(s, PHI).orderBy("cat_id").collect()
    assert len(long) == len(nested) == 3
    for a, b in zip(long, nested):
        assert a.asDict().keys() == b.asDict().keys()
        assert all(math.isclose(x, y, rel_tol=1e-7, abs_tol=1e-9) for x, y in zip(a, b))


def test_long_grids_are_worked_off_in_parts(spark, monkeypatch):
    s = thin(spark, {2: SOURCES[2]})
    row = faraday.faraday_spectra(s, faraday.regular_grid(60_000.0, 1.0), columns=("peak_phi", "n_chan")).first()
    assert abs(row.peak_phi + 128.0) <= 1.0 and row.n_chan == 72
    whole = faraday.Depths(PHI)
    monkeypatch.setattr(faraday, "MATRIX_CELLS", 500)
    w = np.random.default_rng(1).normal(size=(3, 72)) + 0j
    lam0 = np.array([0.1, 0.11, 0.12])
    direct = np.stack([(v[:, None] * np.exp(-2j * np.outer(L2 - l, PHI))).sum(axis=0) for v, l in zip(w, lam0)])
    assert np.allclose(faraday.Depths(PHI).transform(L2, w, lam0), direct) and np.allclose(whole.transform(L2, w, lam0), direct)


def test_nested_clean_equals_the_joined_one(spark):
    s = thin(spark, SOURCES)
    joined = faraday.rm_clean(faraday.rm_synthesis(s, PHI), faraday.rmsf(s, PHI), faraday.synthesis_scalars(s)).orderBy("cat_id").collect()
    nested = faraday.clean_spectra(s, PHI).orderBy("cat_id").collect()
    for a, b in zip(joined, nested):
        assert a.ok and b.ok and a.n_iter == b.n_iter and np.allclose(a.clean_re, b.clean_re) and np.allclose(a.model_im, b.model_im)


def test_spectra_without_a_usable_channel_leave(spark):
    s = thin(spark, SOURCES).withColumn("u", F.when(F.col("cat_id") == 2, F.lit(float("nan"))).otherwise(F.col("u")))
    assert {r.cat_id for r in faraday.spectrum_peaks(s, PHI).collect()} == {1, 3}
    assert faraday.spectrum_peaks(s.where("false"), PHI).collect() == []


def test_widest_gap_of_uneven_values(spark):
    rng = np.random.default_rng(3)
    v = np.sort(np.concatenate([rng.uniform(0, 1e-3, 20_000), rng.uniform(0.4, 1.0, 300), [0.0, 1.0]]))
    df = spark.createDataFrame([(float(x),) for x in v], "x double")
    assert faraday.widest_gap(df, "x", 0.0, 1.0) == pytest.approx(np.diff(v).max(), abs=1e-15)
    close = np.sort(rng.uniform(0, 1, 30_000))
    close[10_000:] += 1e-9
    df = spark.createDataFrame([(float(x),) for x in close], "x double")
    assert faraday.widest_gap(df, "x", close[0], close[-1]) == pytest.approx(np.diff(close).max(), abs=1e-15)


def test_modulation_of_own_windows_and_bands(spark, monkeypatch):
    monkeypatch.setattr(faraday, "MODULATION_BLOCK", 7)
    rng = np.random.default_rng(2)
    readings = [(int(s), float(t), float(r)) for s, t, r in zip(rng.integers(0, 4, 3000), rng.uniform(-5, 50, 3000), rng.normal(2, 1, 3000))]
    windows = [(k, int(rng.integers(0, 4)), float(rng.uniform(-5, 40)), float(rng.choice([0.5, 3.0, 40.0])), "ab"[k % 2], "kept") for k in range(25)]
    odd = [(90, 1, None, 1.0, "a", "x"), (91, 1, 3.0, None, "a", "x"), (92, 9, 3.0, 1.0, "a", "x"), (93, 1, 3.0, -1.0, "a", "x"), (94, 1, 3.0, 2.0, "none", "x")]
    bands = {"a": FREQ[:5], "b": FREQ[30:33]}
    iono = spark.createDataFrame(readings + [(1, 3.5, float("nan")), (1, None, 2.0)], "source_id int, t double, rm double")
    wins = spark.createDataFrame(windows + odd, "field int, source_id int, start double, length double, band string, note string")
    band = spark.createDataFrame([(b, c, float(f)) for b, fs in bands.items() for c, f in enumerate(fs)], "band string, chan int, freq double")
    got = {(r.field, r.chan): r for r in faraday.window_modulation(iono, wins, band).collect()}
    want = {}
    for field, source, start, length, b, _ in windows:
        rm = np.array([r for s, t, r in readings if s == source and start <= t <= start + length])
        if rm.size:
            want |= {(field, c): (np.exp(2j * rm * (299792458.0 / f) ** 2).mean(), rm.size) for c, f in enumerate(bands[b])}
    assert got.keys() == want.keys()
    assert all(abs(complex(got[k].re, got[k].im) - v) < 1e-9 and got[k].n == n and got[k].note == "kept" for k, (v, n) in want.items())


def test_modulation_meets_few_cells_a_window(spark, monkeypatch):
    """Windows are made of sums over long cells; single readings are met at their ends alone."""
    met = []

    def counted(left, right, *rest):
        out = skew_join(left, right, *rest)
        met.append(out.count())
        return out

    skew_join = faraday.skew_join
    monkeypatch.setattr(faraday, "skew_join", counted)
    iono = spark.range(40_000).select(F.lit(1).alias("source_id"), (F.col("id") / 400.0).alias("t"), (F.col("id") % 7).cast("double").alias("rm"))
    wins = spark.range(60).select("id", F.lit(1).alias("source_id"), (F.col("id") * 0.9 + 0.001).alias("start"), (F.lit(20.0) + F.col("id") % 13).alias("length"), F.lit(0).alias("band"))
    band = spark.createDataFrame([(0, 0, 1e9), (0, 1, 1.2e9)], "band int, chan int, freq double")
    got = faraday.window_modulation(iono, wins, band).collect()
    t, rm = np.arange(40_000) / 400.0, np.arange(40_000) % 7.0
    assert len(got) == 120
    for r in got:
        inside = (t >= r.start) & (t <= r.start + r.length)
        want = np.exp(2j * rm[inside] * (299792458.0 / (1e9, 1.2e9)[r.chan]) ** 2).mean()
        assert r.n == inside.sum() and abs(complex(r.re, r.im) - want) < 1e-9
    assert sum(met) < 60 * 2 * 4 * faraday.MODULATION_BLOCK  # 60 windows of 8,000 and more readings each


def test_power_law_fits_come_to_rest_each_for_itself():
    """A block of spectra gives what each spectrum gives alone; one that is cut short is no success."""
    rng = np.random.default_rng(8)
    x = np.tile(np.linspace(0.8, 1.2, 40), (30, 1))  # frequency over the reference
    ref = np.full(30, 0.95e9)
    true = np.stack([rng.uniform(0.01, 2, 30), rng.normal(-0.7, 0.5, 30), rng.normal(0, 0.5, 30)], axis=1)
    flux = powerlaw._model(true, x, ref) * (1 + 0.01 * rng.normal(size=x.shape))
    weight = np.full(x.shape, 1e4)
    start = np.stack([flux.mean(axis=1), np.zeros(30), np.zeros(30)], axis=1)
    p, err, good = powerlaw.fit_block(x, ref, flux, weight, start)
    assert good.all() and (start[:, 1:] == 0).all()
    for i in range(0, 30, 7):
        one = powerlaw.fit_block(x[i : i + 1], ref[i : i + 1], flux[i : i + 1], weight[i : i + 1], start[i : i + 1])
        assert np.allclose(one[0][0], p[i], rtol=1e-6, atol=1e-9) and np.allclose(one[1][0], err[i], rtol=1e-6)
        # least squares: no gradient is left
        grad = np.einsum("bci,bc->bi", powerlaw._jacobian(p[i : i + 1], x[i : i + 1], ref[i : i + 1]) * 1e4, flux[i : i + 1] - powerlaw._model(p[i : i + 1], x[i : i + 1], ref[i : i + 1]))
        assert (np.abs(grad * err[i]) < 1e-3).all()
    assert not powerlaw.fit_block(x, ref, flux, weight, start, max_steps=1)[2].any()
