"""Faraday complexity: combined sigma_add from its Q and U estimates."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.numeric import NAN, finite, ratio
from stokesweave.functions.spectral import lognorm_params

DRAWS = 1000
BLOCK = 500  # spectra whose noise values are tried at once
DRAW_BLOCK = 32  # rows drawn for at once: few enough for a core's cache
LARGE = 1e150
PERCENTS = (0.1572, 0.5, 0.8427)  # points of a distribution that stand for its lower bar, middle and upper bar
INPUTS = (
    "sigma_add_Q",
    "sigma_add_U",
    "sigma_add_Q_err_minus",
    "sigma_add_Q_err_plus",
    "sigma_add_U_err_minus",
    "sigma_add_U_err_plus",
)


def uniforms(seeds: np.ndarray, count: int) -> np.ndarray:
    """``count`` reproducible numbers in (0, 1) per seed (mixed counters)."""
    with np.errstate(over="ignore"):
        step = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        z = seeds.astype(np.int64).view(np.uint64)[:, None] + step[None, :]
        shifted = np.empty_like(z)
        for bits, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z ^= np.right_shift(z, np.uint64(bits), out=shifted)
            z *= np.uint64(factor)
        z ^= np.right_shift(z, np.uint64(31), out=shifted)
    z >>= np.uint64(11)
    out = z.astype(float)
    out += 0.5
    out *= 1.0 / (1 << 53)
    return out


def combined_moments(seeds, shape_q, scale_q, shape_u, scale_u, draws: int):
    """Median and population deviation of hypot of two log-normal samples per row.

    Sine and cosine of an angle come from the tangent of its half, the median from one partition: numpy has fast code for these.
    """
    u = uniforms(seeds, 2 * draws)
    radius, t = u[:, :draws], u[:, draws:]
    np.log(radius, out=radius)
    radius *= -2.0
    np.sqrt(radius, out=radius)
    t *= np.pi
    np.tan(t, out=t)
    square = t * t
    radius /= 1.0 + square
    q = np.subtract(1.0, square, out=square)
    q *= radius
    q *= shape_q[:, None]
    np.exp(q, out=q)
    q *= scale_q[:, None]
    v = np.multiply(t, radius, out=t)
    v *= 2.0 * shape_u[:, None]
    np.exp(v, out=v)
    v *= scale_u[:, None]
    most, least = max(q.max(initial=0.0), v.max(initial=0.0)), max(q.min(initial=np.inf), v.min(initial=np.inf))
    if most < LARGE and least > 1.0 / LARGE:  # squares neither overflow nor vanish
        q *= q
        v *= v
        p = np.sqrt(np.add(q, v, out=q), out=q)
    else:
        p = np.hypot(q, v)
    deviation = p.std(axis=1)
    p.partition(draws // 2, axis=1)
    middle = p[:, draws // 2]
    if draws % 2 == 0:
        middle = (middle + p[:, : draws // 2].max(axis=1)) * 0.5
    return middle, deviation


def _moments_udf(draws: int):
    @F.pandas_udf("sigma_add double, sigma_add_err double")
    def run(seed: pd.Series, sq: pd.Series, cq: pd.Series, su: pd.Series, cu: pd.Series) -> pd.DataFrame:
        par = [x.to_numpy(dtype=float) for x in (sq, cq, su, cu)]
        ok = np.all([np.isfinite(x) & (x > 0) for x in par], axis=0)
        out = np.full((len(seed), 2), np.nan)
        rows = np.nonzero(ok)[0]
        for at in range(0, rows.size, DRAW_BLOCK):
            part = rows[at : at + DRAW_BLOCK]
            out[part, 0], out[part, 1] = combined_moments(seed.to_numpy()[part], *[x[part] for x in par], draws)
        return pd.DataFrame(out, columns=["sigma_add", "sigma_add_err"])

    return run


def sigma_add(cat: DataFrame, ident: str = "cat_id", draws: int = DRAWS, drop_inputs: bool = True) -> DataFrame:
    """Median (``sigma_add``) and deviation (``sigma_add_err``) of hypot(Q, U).

    Q and U are log-normal, each read from its lower and upper error bar.  Draws
    are seeded by a hash of the row's id, so they do not depend on partitioning,
    and nothing is shuffled.  Invalid parameters give NaN.
    """
    shape_q, scale_q = lognorm_params(
        F.col("sigma_add_Q") - F.col("sigma_add_Q_err_minus"), F.col("sigma_add_Q") + F.col("sigma_add_Q_err_plus")
    )
    shape_u, scale_u = lognorm_params(
        F.col("sigma_add_U") - F.col("sigma_add_U_err_minus"), F.col("sigma_add_U") + F.col("sigma_add_U_err_plus")
    )
    moments = _moments_udf(draws)(F.xxhash64(ident), shape_q, scale_q, shape_u, scale_u)
    out = cat.withColumn("_m", moments).withColumns({c: F.coalesce(f"_m.{c}", F.lit(NAN)) for c in ("sigma_add", "sigma_add_err")}).drop("_m")
    return out.drop(*INPUTS) if drop_inputs else out


# --- added noise of one spectrum ----------------------------------------------

STEPS = 1000  # noise values tried per spectrum
FAR = 12.0  # log likelihood below its peak beyond which noise values are left out


def thin_residuals(fractional: DataFrame, peaks: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """What a Faraday-thin source leaves over: ``n_q, chi_q, n_u, chi_u`` per spectrum.

    The source has the ``polint``, ``derot_polangle`` and ``rm`` of ``peaks``, in the units of ``fractional`` (``q, u, dq, du,
    lambda_sq``).  ``chi`` sums squared residuals over noise, ``n`` counts channels with finite values and noise above zero.
    """
    keys = list(keys)
    model = peaks.select(*keys, F.col("polint").alias("_p"), F.radians("derot_polangle").alias("_a"), F.col("rm").alias("_rm"))
    angle = 2.0 * (F.col("_a") + F.col("_rm") * F.col("lambda_sq"))
    rows = fractional.join(model, keys)
    out = []
    for s, wave in (("q", F.cos(angle)), ("u", F.sin(angle))):
        left = ratio(F.col(s) - F.col("_p") * wave, F.abs(f"d{s}"))
        out += [F.count(F.when(finite(left), left)).alias(f"n_{s}"), F.coalesce(F.sum(F.when(finite(left), left * left)), F.lit(0.0)).alias(f"chi_{s}")]
    return rows.groupBy(*keys).agg(*out)


def noise_posterior(n: np.ndarray, chi: np.ndarray) -> np.ndarray:
    """Median and its distances to the 15.72 and 84.27 % points of the noise added to unit noise; a row each.

    ``n`` normal residuals with squares that sum to ``chi`` have a likelihood that needs no more than these two, so a
    spectrum takes one vector of noise values whatever its number of channels.  The prior is flat.  NaN for fewer than three.
    """
    out = np.full((len(n), 3), np.nan)
    rows = np.nonzero((n >= 3) & np.isfinite(chi))[0]
    if not rows.size:
        return out
    n, chi = n[rows, None].astype(float), chi[rows, None].astype(float)

    def log_like(s):
        t = 1.0 + s * s
        return -0.5 * (n * np.log(t) + chi / t)

    best = np.sqrt(np.maximum(chi / n - 1.0, 0.0))
    top = log_like(best)
    reach = np.maximum(best, 0.1)
    while True:
        near = log_like(best + reach) > top - FAR
        if not near.any():
            break
        reach = np.where(near, reach * 1.5, reach)
    low = np.maximum(best - reach, 0.0)
    s = low + (best + reach - low) * np.linspace(0.0, 1.0, STEPS)[None, :]
    mass = np.exp(log_like(s) - top)
    total = np.concatenate([np.zeros((len(n), 1)), np.cumsum((mass[:, 1:] + mass[:, :-1]) * np.diff(s, axis=1) / 2.0, axis=1)], axis=1)
    total /= total[:, -1:]
    ends = [np.array([np.interp(p, total[i], s[i]) for i in range(len(s))]) for p in PERCENTS]
    out[rows] = np.stack([ends[1], ends[1] - ends[0], ends[2] - ends[1]], axis=1)
    return out


def added_noise(fractional: DataFrame, peaks: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """``sigma_add_q, sigma_add_q_minus, sigma_add_q_plus`` and the like of U per spectrum: noise beyond the stated one
    that a Faraday-thin source leaves in it, in units of the stated noise.  NULL for fewer than three channels.
    """

    @F.pandas_udf("value double, minus double, plus double")
    def run(n: pd.Series, chi: pd.Series) -> pd.DataFrame:
        parts = [noise_posterior(n.to_numpy()[at : at + BLOCK], chi.to_numpy(float)[at : at + BLOCK]) for at in range(0, len(n), BLOCK)]
        return pd.DataFrame(np.concatenate(parts) if parts else np.empty((0, 3)), columns=["value", "minus", "plus"])

    def known(c: str) -> Column:
        return F.when(finite(c), F.col(c))

    sums = thin_residuals(fractional, peaks, keys)
    found = sums.select(*keys, *[run(f"n_{s}", f"chi_{s}").alias(f"_{s}") for s in ("q", "u")])
    return found.select(*keys, *[known(f"_{s}.{part}").alias(f"sigma_add_{s}{end}") for s in ("q", "u") for part, end in (("value", ""), ("minus", "_minus"), ("plus", "_plus"))])
