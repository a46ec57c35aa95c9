"""Spectra as tables: one row per (component, channel), groups bounded by the
number of channels of the band."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.functions.numeric import NAN, as_col, blank_unless, finite, finite_or_null, known_gt, ratio, zero_to_nan
from stokesweave.operators.clipping import clip_udf

STOKES = ("i", "q", "u")


def blank_zeros(spectra: DataFrame, stokes: Sequence[str] = STOKES, with_bkg: bool = True) -> DataFrame:
    """Exact zeros become NaN; noise and background are blanked where data is not finite."""
    out = spectra.withColumns({s: zero_to_nan(s) for s in stokes})
    blanks: dict[str, Column] = {}
    for s in stokes:
        for col in (f"d{s}", f"b{s}") if with_bkg else (f"d{s}",):
            if col in spectra.columns:
                blanks[col] = blank_unless(col, finite(s))
    return out.withColumns(blanks)


def subtract_background(spectra: DataFrame, stokes: Sequence[str] = STOKES) -> DataFrame:
    return spectra.withColumns({s: F.col(s) - F.col(f"b{s}") for s in stokes})


def fill_rms_median(spectra: DataFrame, keys: Sequence[str], rms: str) -> DataFrame:
    """Missing or zero noise takes the median of the spectrum's usable noise values.

    The window is one spectrum, which the band bounds.
    """
    usable = F.when(finite(rms) & (F.col(rms) != 0), F.col(rms))
    mid = F.median(usable).over(Window.partitionBy(*keys))
    return spectra.withColumn(rms, F.coalesce(usable, mid, F.lit(NAN)))


def spectrum_status(spectra: DataFrame, keys: Sequence[str], stokes: Sequence[str] = STOKES) -> DataFrame:
    """Per spectrum: finite channel counts and whether it can be processed.

    A component fails when any Stokes is entirely missing or Q or U has fewer
    than two finite channels.
    """
    counts = spectra.groupBy(*keys).agg(*[F.count_if(finite(s)).alias(f"n_{s}") for s in stokes])
    ok = F.lit(True)
    for s in stokes:
        ok = ok & (F.col(f"n_{s}") >= (1 if s == "i" else 2))
    return counts.withColumn("ok", ok)


def clip_channels(
    spectra: DataFrame,
    keys: Sequence[str],
    stokes: Sequence[str] = STOKES,
    sigma: float = 5.0,
    maxiters: int | None = 5,
) -> DataFrame:
    """Blank a channel in every Stokes when its noise is an outlier in any of them.

    Noise values are clipped at ``sigma`` MAD deviations from their median.  One
    shuffle: a spectrum is gathered (bounded by its channels), its limits come
    from the numpy clip helper, and the rows are unfolded again.
    """
    rest = [c for c in spectra.columns if c not in keys]
    packed = spectra.groupBy(*keys).agg(F.collect_list(F.struct(*rest)).alias("_rows"))
    limits = clip_udf(sigma, "median", "mad", maxiters)
    packed = packed.withColumns({f"_lim_{s}": limits(F.filter(F.col(f"_rows.d{s}").cast("array<double>"), finite)) for s in stokes})
    rows = packed.select(*keys, *[f"_lim_{s}" for s in stokes], F.inline("_rows"))
    bad = F.lit(False)
    for s in stokes:
        outside = (F.col(f"d{s}") < F.col(f"_lim_{s}.lo")) | known_gt(F.col(f"d{s}"), F.col(f"_lim_{s}.hi"))
        bad = bad | F.coalesce(outside, F.lit(False)) | ~finite(f"d{s}")
    blanked = {
        c: F.when(F.col("_bad"), F.lit(NAN)).otherwise(F.col(c))
        for s in stokes
        for c in (s, f"d{s}", f"b{s}")
        if c in spectra.columns
    }
    return rows.withColumn("_bad", bad).withColumns(blanked).select(*spectra.columns, F.col("_bad").alias("clipped"))


def band_noise(spectra: DataFrame, keys: Sequence[str], stokes: Sequence[str] = STOKES) -> DataFrame:
    """Mean channel noise, full-band noise and mean background per Stokes."""
    aggs = []
    for s in stokes:
        noise = finite_or_null(f"d{s}")
        aggs.append(F.avg(noise).alias(f"d{s}"))
        aggs.append((F.avg(noise) / F.sqrt(F.nullif(F.count(noise), F.lit(0)))).alias(f"d{s}_full_band"))
        if f"b{s}" in spectra.columns:
            aggs.append(F.avg(finite_or_null(f"b{s}")).alias(f"b{s}_full_band"))
    return spectra.groupBy(*keys).agg(*aggs)


def band_average(
    spectra: DataFrame, keys: Sequence[str], start: int, stop: int, chan: str = "chan", freq: str = "freq"
) -> DataFrame:
    """Mean frequency and summed Stokes over channels [start, stop), with Q/I and U/I."""
    part = spectra.where((F.col(chan) >= start) & (F.col(chan) < stop))
    sums = part.groupBy(*keys).agg(
        F.avg(finite_or_null(freq)).alias("freq"),
        *[F.coalesce(F.sum(finite_or_null(s)), F.lit(0.0)).alias(s) for s in STOKES],
    )
    return sums.withColumns({"q_frac": ratio("q", "i"), "u_frac": ratio("u", "i")}).withColumn(
        "p_frac", F.hypot("q_frac", "u_frac")
    )


def band_chunks(
    spectra: DataFrame, keys: Sequence[str], chunks: Sequence[tuple[int, int]], chan: str = "chan"
) -> DataFrame:
    """:func:`band_average` for several channel ranges in one pass (column ``chunk``)."""
    table = F.array(*[F.struct(F.lit(i).alias("chunk"), F.lit(a).alias("a"), F.lit(b).alias("b")) for i, (a, b) in enumerate(chunks)])
    hit = F.filter(table, lambda c: (F.col(chan) >= c["a"]) & (F.col(chan) < c["b"]))
    tagged = spectra.withColumn("_hit", F.explode(hit)).withColumn("chunk", F.col("_hit.chunk")).drop("_hit")
    return band_average(tagged, [*keys, "chunk"], 0, 2**31 - 1, chan)


def channel_width(spectra: DataFrame, keys: Sequence[str], chan: str = "chan", freq: str = "freq") -> DataFrame:
    """First frequency difference of every spectrum, as one aggregate."""
    first_two = F.slice(F.array_sort(F.collect_list(F.struct(chan, freq))), 1, 2)
    pair = spectra.groupBy(*keys).agg(first_two.alias("_p"))
    return pair.select(
        *keys, (F.get("_p", F.lit(1))[freq] - F.get("_p", F.lit(0))[freq]).alias("channel_width")
    )


def align_stokes(
    long_form: DataFrame, keys: Sequence[str], chan: str = "chan", stokes: str = "stokes", value: str = "value"
) -> DataFrame:
    """One row per channel with I, Q and U side by side (conditional aggregate)."""
    return long_form.groupBy(*keys, chan).agg(
        *[F.max(F.when(F.lower(F.col(stokes)) == s, F.col(value))).alias(s) for s in STOKES]
    )


def derotate(spectra: DataFrame, theta: DataFrame, on: Sequence[str], re: str = "re", im: str = "im") -> DataFrame:
    """Undo the ionospheric modulation: (Q + iU) / theta per (source, channel)."""
    joined = spectra.join(theta.select(*on, F.col(re).alias("_re"), F.col(im).alias("_im")), list(on))
    norm = F.col("_re") * F.col("_re") + F.col("_im") * F.col("_im")
    q = ratio(F.col("q") * F.col("_re") + F.col("u") * F.col("_im"), norm)
    u = ratio(F.col("u") * F.col("_re") - F.col("q") * F.col("_im"), norm)
    return joined.withColumns({"q": q, "u": u}).drop("_re", "_im").select(spectra.columns)


def chi_squared(rows: DataFrame, keys: Sequence[str], model: str, data: str, error: str, n_params: int) -> DataFrame:
    """Chi-squared, its reduced form and the least-squares AIC per group."""
    resid = F.col(model) - F.col(data)
    sums = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.pow(resid / F.col(error), 2.0)).alias("chi_sq"),
        F.sum(resid * resid).alias("ssr"),
    )
    return sums.withColumns({"chi_sq_red": ratio("chi_sq", F.col("n") - n_params), "aic": aic_lsq("ssr", "n", n_params)})


def aic_lsq(ssr, n, n_params: int) -> Column:
    """Akaike criterion of a least-squares fit with the small-sample form below
    40 samples per parameter."""
    ssr, n = as_col(ssr), as_col(n)
    base = n * F.ln(ssr / n)
    penalty = F.when(n / n_params >= 40.0, F.lit(2.0 * n_params)).otherwise(
        ratio(n * (2.0 * n_params), n - n_params - 1)
    )
    return base + penalty


def occam_aic(models: DataFrame, keys: Sequence[str], aic: str = "aic", n_terms: str = "n_terms") -> DataFrame:
    """Best model per key: the lowest AIC, unless a model with fewer terms lies
    within 2 of it, in which case the one with the fewest terms wins.

    One aggregate over the handful of models; no window.
    """
    known = models.where(finite(aic))
    gathered = known.groupBy(*keys).agg(
        F.min(F.struct(aic, n_terms)).alias("_best"), F.collect_list(F.struct(n_terms, aic)).alias("_all")
    )
    simpler = F.filter(
        F.array_sort("_all"),
        lambda m: (m[aic] - F.col(f"_best.{aic}") < 2) & (m[n_terms] < F.col(f"_best.{n_terms}")),
    )
    chosen = F.coalesce(F.get(simpler, F.lit(0)), F.struct(F.col(f"_best.{n_terms}"), F.col(f"_best.{aic}")))
    return gathered.select(*keys, chosen.alias("_c")).select(
        *keys, F.col(f"_c.{n_terms}").alias(n_terms), F.col(f"_c.{aic}").alias(aic)
    )


def normality(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """D'Agostino-Pearson omnibus test of normality per group (K2 and p-value).

    Built from the sample skewness and kurtosis aggregates; needs 8 values.
    """
    m = rows.where(finite(value)).groupBy(*keys).agg(
        F.count(value).alias("n"), F.skewness(value).alias("b1"), (F.kurtosis(value) + 3.0).alias("b2")
    )
    n = F.col("n").cast("double")
    y = F.col("b1") * F.sqrt((n + 1) * (n + 3) / (6.0 * (n - 2)))
    beta2 = 3.0 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = F.sqrt(2.0 * (beta2 - 1)) - 1.0
    delta = 1.0 / F.sqrt(0.5 * F.ln(w2))
    alpha = F.sqrt(2.0 / (w2 - 1.0))
    zs = delta * F.asinh(y / alpha)

    mean2 = 3.0 * (n - 1) / (n + 1)
    var2 = 24.0 * n * (n - 2) * (n - 3) / ((n + 1) * (n + 1) * (n + 3) * (n + 5))
    x = (F.col("b2") - mean2) / F.sqrt(var2)
    sb1 = 6.0 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * F.sqrt(6.0 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6.0 + 8.0 / sb1 * (2.0 / sb1 + F.sqrt(1.0 + 4.0 / (sb1 * sb1)))
    denom = 1.0 + x * F.sqrt(2.0 / (a - 4.0))
    term2 = F.signum(denom) * F.cbrt((1.0 - 2.0 / a) / F.abs(denom))
    zk = (1.0 - 2.0 / (9.0 * a) - term2) / F.sqrt(2.0 / (9.0 * a))
    k2 = zs * zs + zk * zk
    # below eight values the statistic is undefined, and the guard also keeps ANSI division safe
    return m.where("n >= 8").select(*keys, "n", k2.alias("k2"), F.exp(-k2 / 2.0).alias("p_value"))
