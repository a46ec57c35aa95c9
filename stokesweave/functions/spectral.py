"""Spectral and polarimetric scalar functions as native column expressions."""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

from stokesweave.functions.numeric import NAN, as_col, finite, known_gt, ratio

SPEED_OF_LIGHT = 299792458.0

# Standard normal quantiles of the 15.72 % and 84.27 % levels used to read a
# log-normal from its lower and upper error bars.
Z_LOW = NormalDist().inv_cdf(0.1572)
Z_HIGH = NormalDist().inv_cdf(0.8427)


def lambda_sq(freq) -> Column:
    """Wavelength squared (m^2) of a frequency in Hz."""
    wave = F.lit(SPEED_OF_LIGHT) / as_col(freq)
    return wave * wave


def linear_axis(crval: float, crpix: float, cdelt: float, nchan: int) -> Column:
    """Array of axis values for 0-based channels of a linear header axis."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(nchan - 1)),
        lambda i: F.lit(float(crval)) + (i.cast("double") + 1.0 - float(crpix)) * float(cdelt),
    )


def flat_power_law(norm, ref_nu) -> Column:
    return as_col(norm) * as_col(ref_nu)


def power_law(nu, norm, alpha, ref_nu) -> Column:
    return as_col(norm) * F.pow(as_col(nu) / as_col(ref_nu), as_col(alpha))


def curved_power_law(nu, norm, alpha, beta, ref_nu) -> Column:
    x = as_col(nu) / as_col(ref_nu)
    return as_col(norm) * F.pow(x, as_col(alpha) + as_col(beta) * F.log10(x))


def taylor_power_law(nu, tt0, tt1, ref_nu) -> Column:
    """Power law from the two Taylor-term pixel values: the catalogue exponent
    is -TT1/TT0 with the falling-exponent sign convention, so the model is
    TT0 (nu/nu0)^(TT1/TT0)."""
    return as_col(tt0) * F.pow(as_col(nu) / as_col(ref_nu), ratio(tt1, tt0))


def taylor_alpha(tt0, tt1) -> Column:
    return -ratio(tt1, tt0)


def pol_intensity(q, u) -> Column:
    return F.hypot(as_col(q), as_col(u))


def frac_pol(stokes, i) -> Column:
    return ratio(stokes, i)


def lognorm_params(low, high) -> tuple[Column, Column]:
    """Shape and scale of the log-normal whose 15.72/84.27 % points are given."""
    lo = F.when(as_col(low) > 0, F.ln(as_col(low)))
    hi = F.when(as_col(high) > 0, F.ln(as_col(high)))
    shape = (hi - lo) / (Z_HIGH - Z_LOW)
    mean = (lo * Z_HIGH - hi * Z_LOW) / (Z_HIGH - Z_LOW)
    return shape, F.exp(mean)


def coefficient(text, from_end: int) -> Column:
    """n-th last entry of a comma-joined coefficient string."""
    parts = F.split(as_col(text), ",")
    return F.try_element_at(parts, F.lit(-from_end)).try_cast("double")


def spectral_index(coefs, errors) -> dict[str, Column]:
    """alpha and beta (2nd and 3rd last coefficients) with their errors."""
    return {
        "alpha": coefficient(coefs, 2),
        "alpha_err": coefficient(errors, 2),
        "beta": coefficient(coefs, 3),
        "beta_err": coefficient(errors, 3),
    }


def pad_coefs(values, length: int = 5) -> Column:
    """Coefficient array padded with NaN, reversed, comma joined."""
    values = as_col(values)
    pad = F.array_repeat(F.lit(NAN), F.greatest(F.lit(0), F.lit(length) - F.size(values)))
    full = F.reverse(F.concat(values.cast("array<double>"), pad))
    return F.array_join(
        F.transform(full, lambda v: F.when(F.isnan(v), F.lit("nan")).otherwise(v.cast("string"))), ","
    )


def eval_poly(x, coefs: Sequence[float]) -> Column:
    """Horner evaluation of ascending coefficients known to the driver."""
    x = as_col(x)
    out = F.lit(0.0)
    for c in reversed(list(coefs)):
        out = out * x + F.lit(float(c))
    return out


def epoch_mid(start_mjd, int_time_s) -> Column:
    """Mid-observation epoch in MJD days."""
    return as_col(start_mjd) + as_col(int_time_s) / (2.0 * 86400.0)


def observation_end(start_s, int_time_s) -> Column:
    return as_col(start_s) + as_col(int_time_s)


def complex_pair(re, im) -> Column:
    return F.struct(as_col(re).cast("double").alias("re"), as_col(im).cast("double").alias("im"))


# --- flags -----------------------------------------------------------------


def snr_flag(snr, cut: float = 8.0) -> Column:
    return F.coalesce(as_col(snr) < cut, F.lit(False))


def leakage_flag(frac, envelope) -> Column:
    """Fractional polarisation below the leakage envelope; missing values pass."""
    return known_gt(envelope, frac)


def complex_sigma_add_flag(value, error) -> Column:
    return known_gt(value, as_col(error) * 10.0)


def complex_width_flag(rm_width, rmsf_fwhm) -> Column:
    return known_gt(rm_width, rmsf_fwhm)


def stokes_i_fit_flag(negative, close_to_zero, not_finite) -> Column:
    return as_col(negative) | as_col(close_to_zero) | as_col(not_finite)


def fit_status_flags(code) -> dict[str, Column]:
    """Flags carried by the integer status of an external Stokes I fit."""
    code = as_col(code)
    return {
        "is_negative": code >= 128,
        "is_close_to_zero": code >= 64,
        "is_not_finite": code >= 16,
        "is_not_normal": code >= 5,
    }


def good_rm(
    stokes_i_flag="stokesI_fit_flag",
    channel_flag="channel_flag",
    leak_flag="leakage_flag",
    snr_low="snr_flag",
    snr="snr_polint",
) -> dict[str, Column]:
    """Nested quality levels: usable Stokes I, usable polarisation, usable RM."""
    good_i = ~as_col(stokes_i_flag) & ~as_col(channel_flag)
    good_l = good_i & ~as_col(leak_flag) & known_gt(snr, F.lit(5.0))
    return {"good_i": good_i, "good_l": good_l, "good_rm": good_l & ~as_col(snr_low)}


def quality_cut(
    flags: Sequence[str] = ("snr_flag", "leakage_flag", "channel_flag", "stokesI_fit_flag", "local_rm_flag"),
) -> Column:
    """TRUE where none of the flags is set."""
    keep = F.lit(True)
    for name in flags:
        keep = keep & ~F.col(name)
    return keep


def hi_snr(signal, noise, cut: float) -> Column:
    return F.coalesce(known_gt(ratio(signal, noise), F.lit(float(cut))), F.lit(False))


def finite_pair(a, b) -> Column:
    return finite(a) & finite(b)
