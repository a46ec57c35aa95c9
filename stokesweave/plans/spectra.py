"""Cubelets to polarisation measurements of every component."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.numeric import array_median, finite
from stokesweave.functions.spectral import curved_power_law, flat_power_law, lambda_sq, power_law, taylor_power_law
from stokesweave.operators.complexity import added_noise
from stokesweave.operators.faraday import (
    cc_moment2,
    clean_components,
    clean_nested,
    clean_spectra,
    faraday_spectra,
    peak_measurements,
    phi_grid,
    rm_synthesis,
)
from stokesweave.operators.keyed import not_in_ids
from stokesweave.operators.pixels import shared_noise
from stokesweave.operators.powerlaw import fit_power_law
from stokesweave.operators.spectra import band_noise, blank_zeros, clip_channels, spectrum_status
from stokesweave.session import cut_lineage
from stokesweave.sources.tables import upsert

MAD_SCALE = 0.6745  # median deviation of a unit normal distribution


def spectral_measurements(
    spectra: DataFrame,
    phi: Sequence[float] | None = None,
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    nterms: int = 2,
    clean: bool = True,
    cutoff: float = -3.0,
    stokes_i: str = "fit",
    taylor: DataFrame | None = None,
    **clean_options,
) -> DataFrame:
    """One row per component with a stage status and all measurements.

    ``spectra`` is long: keys, chan, freq, i, q, u, di, dq, du and optionally
    bi, bq, bu.  Components that fail a stage keep NULL measurements and FALSE
    status; a failure never stops the job.  Amplitudes are fluxes whether or not the
    Stokes I model could be fitted; ``ifreq0`` and ``fracpol`` are NULL where it could not.

    The Stokes I model comes from a power-law ``fit`` of up to ``nterms``, from ``taylor`` terms (``keys, tt0,
    tt1, ref_nu``, unique by key: the values of the Taylor images at the component) or is left out (``none``), when Q and U are taken as they are.
    The last two have no fit columns but flags, which are FALSE.  A component without usable Taylor
    terms fails synthesis.
    """
    if stokes_i not in ("fit", "taylor", "none"):
        raise ValueError("stokes_i must be fit, taylor or none")
    if (stokes_i == "taylor") != (taylor is not None):
        raise ValueError("Taylor terms go with stokes_i='taylor'")
    keys = list(keys)
    has_bkg = {"bi", "bq", "bu"} <= set(spectra.columns)
    ready = clip_channels(blank_zeros(spectra, with_bkg=has_bkg), keys).drop("clipped")
    ready = cut_lineage(
        ready.withColumns({"lambda_sq": lambda_sq("freq"), "dqu": (F.col("dq") + F.col("du")) / 2.0})
    )
    status = spectrum_status(ready, keys).select(*keys, "ok")
    usable = ready.join(status.where("ok").drop("ok"), keys, "left_semi")

    if stokes_i == "fit":
        fit = cut_lineage(fit_power_law(usable, keys, nterms))
        curve = fit.select(*keys, F.posexplode("model").alias("_pos", "i_model"))
        numbered = usable.join(
            usable.groupBy(*keys).agg(F.array_sort(F.collect_list("chan")).alias("_chans")).select(*keys, F.posexplode("_chans").alias("_pos", "chan")),
            [*keys, "chan"],
        )
        modelled = numbered.join(curve, [*keys, "_pos"]).drop("_pos")
        models, flux = fit.select(*keys, "best_n", "best_p", "ref_nu"), fitted_flux()
    elif stokes_i == "taylor":
        modelled = with_taylor_model(usable, taylor, keys)
        models, flux = taylor.select(*keys, "tt0", "tt1", "ref_nu"), taylor_power_law("reffreq_pol", "tt0", "tt1", "ref_nu")
    else:
        modelled = usable.withColumn("i_model", F.lit(1.0))
        models, flux = None, None
    modelled = cut_lineage(modelled)
    grid = list(phi) if phi is not None else phi_grid(usable)
    fractional = modelled.where(finite("i_model") & (F.col("i_model") != 0)).withColumns(
        {c: F.col(c) / F.col("i_model") for c in ("q", "u", "dq", "du", "dqu")}
    )
    fdf = cut_lineage(faraday_spectra(fractional, grid, keys, weight))
    own = peak_measurements(fdf, keys).join(fdf.select(*keys, off_peak_mad().alias("fdf_noise_mad")), keys)
    own = own.join(added_noise(fractional, own, keys), keys, "left")
    peaks = in_flux_units(own, models, flux, keys)

    out = status.withColumnRenamed("ok", "rmsynth1d").join(band_noise(ready, keys), keys, "left").join(band_shape(ready, keys), keys, "left")
    flags = ("is_negative", "is_not_finite", "is_not_normal", "is_close_to_zero")
    if stokes_i == "fit":
        shape = fit.select(*keys, "best_n", "best_p", "best_e", "ref_nu", "chi_sq_red", *[F.col(c).alias(f"fit_flag_{c}") for c in flags])
        out = out.join(shape, keys, "left")
    else:
        out = out.withColumns({f"fit_flag_{c}": F.lit(False) for c in flags})
    out = out.join(peaks, keys, "left")
    out = out.withColumn("rmsynth1d", F.col("rmsynth1d") & F.col("rm").isNotNull())
    if not clean:
        return out
    cleaned = cut_lineage(clean_nested(fdf, keys, cutoff, **clean_options))
    width = cc_moment2(clean_components(cleaned, keys), keys).select(*keys, F.col("mom2").alias("rm_width"))
    done = cleaned.select(*keys, F.col("ok").alias("rmclean1d"), "n_iter")
    out = out.join(done, keys, "left").join(width, keys, "left")
    return out.withColumn("rmclean1d", F.coalesce("rmclean1d", F.lit(False)))


def with_taylor_model(spectra: DataFrame, taylor: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Spectra with ``i_model``, the power law of their Taylor terms; NULL without usable terms."""
    terms = taylor.select(*keys, "tt0", "tt1", F.col("ref_nu").alias("_nu0"))
    curve = taylor_power_law("freq", "tt0", "tt1", "_nu0")
    return spectra.join(terms, list(keys), "left").withColumn("i_model", F.when(finite(curve), curve)).drop("tt0", "tt1", "_nu0")


def fitted_flux() -> Column:
    """Fitted Stokes I at ``reffreq_pol``; NULL where no fit is."""
    norm, alpha, beta = (F.get("best_p", F.lit(i)) for i in range(3))
    return (
        F.when(F.col("best_n") == 0, flat_power_law(norm, "ref_nu"))
        .when(F.col("best_n") == 1, power_law("reffreq_pol", norm, alpha, "ref_nu"))
        .when(F.col("best_n") == 2, curved_power_law("reffreq_pol", norm, alpha, beta, "ref_nu"))
    )


def in_flux_units(peaks: DataFrame, models: DataFrame | None, flux: Column | None, keys: Sequence[str]) -> DataFrame:
    """Peak measurements of fractional spectra as fluxes: amplitudes times ``flux``, the I model at the reference frequency.

    Adds ``ifreq0``, that model value, and ``fracpol``.  A spectrum without a model was divided by a
    unit model, so its amplitudes are fluxes already.
    """
    joined = peaks if models is None else peaks.join(models, list(keys))
    scaled = joined.withColumn("ifreq0", F.lit(None).cast("double") if flux is None else flux)
    fluxes = ("polint", "polint_err", "stokes_q", "stokes_u", "fdf_noise_th", "fdf_noise_mad")
    times = F.coalesce("ifreq0", F.lit(1.0))
    return scaled.withColumns(
        {"fracpol": F.when(F.col("ifreq0").isNotNull(), F.col("polint")), **{c: F.col(c) * times for c in fluxes}}
    ).select(*peaks.columns, "ifreq0", "fracpol")


def off_peak_mad() -> Column:
    """Scaled median deviation of the real and imaginary Faraday spectrum beyond two widths of its peak, of rows of ``faraday_spectra``.

    NULL where no depth lies that far out.
    """
    away = F.filter(F.arrays_zip("phi", "re", "im"), lambda x: F.abs(x["phi"] - F.col("peak_phi")) > 2.0 * F.col("rmsf_fwhm"))
    values = F.concat(F.transform(away, lambda x: x["re"]), F.transform(away, lambda x: x["im"]))
    middle = array_median(values)
    return array_median(F.transform(values, lambda v: F.abs(v - middle))) / MAD_SCALE


def band_shape(spectra: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dqu``, the median Q and U noise, and ``median_channel_width`` of every spectrum."""
    noise = (F.col("dq") + F.col("du")) / 2.0
    packed = spectra.groupBy(*keys).agg(F.collect_list(F.when(finite(noise), noise)).alias("_n"), F.array_sort(F.collect_list("freq")).alias("_f"))
    n = F.greatest(F.size("_f") - 1, F.lit(0))
    steps = F.zip_with(F.slice("_f", F.lit(2), n), F.slice("_f", F.lit(1), n), lambda later, before: later - before)
    return packed.select(*keys, array_median("_n").alias("dqu"), array_median(steps).alias("median_channel_width"))


def pixel_spectra(pixels: DataFrame, noise: DataFrame, freqs: DataFrame, source: str = "source_id") -> DataFrame:
    """Q/U spectra of every pixel with the shared channel noise: input of pixel synthesis.

    ``pixels`` is long with stokes; ``freqs`` maps chan to freq.
    """
    wide = pixels.where(F.col("stokes").isin("q", "u")).groupBy(source, "y", "x", "chan").agg(
        F.max(F.when(F.col("stokes") == "q", F.col("value"))).alias("q"),
        F.max(F.when(F.col("stokes") == "u", F.col("value"))).alias("u"),
    )
    joined = wide.join(shared_noise(noise, [source]), [source, "chan"]).join(freqs, "chan")
    return joined.withColumn("lambda_sq", lambda_sq("freq"))


def pixel_synthesis(pixels: DataFrame, phi: Sequence[float], source: str = "source_id", weight: str = "variance") -> DataFrame:
    """RM synthesis of every pixel: the same transform under a wider key."""
    return rm_synthesis(pixels, phi, [source, "y", "x"], weight)


def pixel_clean(pixels: DataFrame, phi: Sequence[float], source: str = "source_id", weight: str = "variance", **options) -> DataFrame:
    """RM-CLEAN of every pixel."""
    return clean_spectra(pixels, phi, [source, "y", "x"], weight, **options)


def record_stage(results: DataFrame, target: DataFrame, stage: str, keys: Sequence[str]) -> DataFrame:
    """Write a stage's status into the result table; keys without a result get FALSE."""
    keys = list(keys)
    failed = not_in_ids(target.select(*keys), results, keys).withColumn(stage, F.lit(False))
    updates = results.select(*keys, F.coalesce(stage, F.lit(False)).alias(stage)).unionByName(failed)
    return upsert(target, updates, keys, [stage])
