"""Weighted 0-, 1- and 2-term power-law fits of Stokes I spectra.

A block of spectra is fitted together by damped Gauss-Newton steps in numpy; the
choice between the models is the AIC rule of :func:`occam_aic`.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIT_FIELDS = (
    "best_n int, best_p array<double>, best_e array<double>, ref_nu double, chi_sq double, chi_sq_red double,"
    " aic double, model array<double>, model_high array<double>, model_low array<double>,"
    " is_negative boolean, is_not_finite boolean, is_not_normal boolean, is_close_to_zero boolean, ok boolean"
)
START_SLOPE = -0.8
NORMALITY_P = 1e-6


def _model(params: np.ndarray, x: np.ndarray, ref: np.ndarray) -> np.ndarray:
    """Model values; the number of parameters selects the form."""
    if params.shape[1] == 1:
        return np.broadcast_to(params[:, :1] * ref[:, None], x.shape)
    power = params[:, 1:2]
    if params.shape[1] == 3:
        power = power + params[:, 2:3] * np.log10(x)
    return params[:, :1] * x**power


def _jacobian(params: np.ndarray, x: np.ndarray, ref: np.ndarray) -> np.ndarray:
    if params.shape[1] == 1:
        return np.broadcast_to(ref[:, None], x.shape)[:, :, None]
    logx = np.log(x)
    shape = _model(np.concatenate([np.ones((len(params), 1)), params[:, 1:]], axis=1), x, ref)
    full = params[:, :1] * shape
    cols = [shape, full * logx]
    if params.shape[1] == 3:
        cols.append(full * np.log10(x) * logx)
    return np.stack(cols, axis=2)


def fit_block(x, ref, flux, weight, start, max_steps: int = 1000):
    """Levenberg-damped weighted least squares for a block of spectra.

    ``weight`` is the inverse variance, zero on unusable channels.
    Returns parameters, their standard errors and a success mask: a spectrum is fitted until its own steps vanish,
    and one that has not come to rest after ``max_steps`` is no success.
    """
    p = start.copy()
    k = p.shape[1]
    damp = np.full(len(p), 1e-3)
    cost = (weight * (flux - _model(p, x, ref)) ** 2).sum(axis=1)
    eye = np.eye(k)
    rested = np.zeros(len(p), dtype=bool)
    everything = (x, ref, flux, weight, p, damp, cost)
    for _ in range(max_steps):
        # only spectra that still move are worked on
        open_ = np.flatnonzero(~rested)
        if not len(open_):
            break
        x, ref, flux, weight, p, damp, cost = (a[open_] for a in everything)
        jac = _jacobian(p, x, ref)
        wj = jac * weight[:, :, None]
        normal = np.einsum("bci,bcj->bij", wj, jac)
        grad = np.einsum("bci,bc->bi", wj, flux - _model(p, x, ref))
        diag = np.einsum("bii->bi", normal)[:, :, None] * eye
        try:
            move = np.linalg.solve(normal + damp[:, None, None] * diag + 1e-300 * eye, grad[:, :, None])[:, :, 0]
        except np.linalg.LinAlgError:
            move = np.zeros_like(p)
        move = np.where(np.isfinite(move), move, 0.0)
        trial = p + move
        with np.errstate(all="ignore"):
            new_cost = (weight * (flux - _model(trial, x, ref)) ** 2).sum(axis=1)
        better = np.isfinite(new_cost) & (new_cost <= cost)
        scale = np.abs(move) <= 1e-12 * (np.abs(p) + 1e-12)
        everything[4][open_] = np.where(better[:, None], trial, p)
        everything[6][open_] = np.where(better, new_cost, cost)
        everything[5][open_] = np.where(better, damp * 0.2, np.minimum(damp * 8.0, 1e12))
        rested[open_] = scale.all(axis=1)
    x, ref, flux, weight, p, damp, cost = everything
    jac = _jacobian(p, x, ref)
    normal = np.einsum("bci,bcj->bij", jac * weight[:, :, None], jac)
    err = np.full_like(p, np.nan)
    for b in range(len(p)):
        try:
            err[b] = np.sqrt(np.diag(np.linalg.inv(normal[b])))
        except np.linalg.LinAlgError:
            continue
    good = rested & np.isfinite(p).all(axis=1) & np.isfinite(err).all(axis=1)
    return p, err, good


def normality_p(z: np.ndarray) -> float:
    """p-value of the D'Agostino-Pearson omnibus test; NaN below eight values."""
    n = float(z.size)
    if n < 8:
        return np.nan
    d = z - z.mean()
    m2 = (d**2).mean()
    if m2 == 0:
        return np.nan
    b1, b2 = (d**3).mean() / m2**1.5, (d**4).mean() / m2**2
    y = b1 * np.sqrt((n + 1) * (n + 3) / (6 * (n - 2)))
    beta2 = 3 * (n * n + 27 * n - 70) * (n + 1) * (n + 3) / ((n - 2) * (n + 5) * (n + 7) * (n + 9))
    w2 = np.sqrt(2 * (beta2 - 1)) - 1
    zs = np.arcsinh(y / np.sqrt(2 / (w2 - 1))) / np.sqrt(0.5 * np.log(w2))
    var2 = 24 * n * (n - 2) * (n - 3) / ((n + 1) ** 2 * (n + 3) * (n + 5))
    xk = (b2 - 3 * (n - 1) / (n + 1)) / np.sqrt(var2)
    sb1 = 6 * (n * n - 5 * n + 2) / ((n + 7) * (n + 9)) * np.sqrt(6 * (n + 3) * (n + 5) / (n * (n - 2) * (n - 3)))
    a = 6 + 8 / sb1 * (2 / sb1 + np.sqrt(1 + 4 / sb1**2))
    den = 1 + xk * np.sqrt(2 / (a - 4))
    zk = (1 - 2 / (9 * a) - np.sign(den) * np.cbrt((1 - 2 / a) / abs(den))) / np.sqrt(2 / (9 * a))
    return float(np.exp(-(zs * zs + zk * zk) / 2))


def aic_value(ssr: float, k: int, n: int) -> float:
    if n - k - 1 <= 0 or not ssr >= 0:
        return np.nan
    ssr = max(ssr, n * np.finfo(float).tiny)  # an exact fit ranks before all others; of several the smallest model
    penalty = 2.0 * k if n / k >= 40 else 2.0 * k * n / (n - k - 1.0)
    return n * np.log(ssr / n) + penalty


def pick_model(aics: np.ndarray) -> int:
    """Lowest AIC, or the fewest terms among simpler models within 2 of it."""
    if np.isnan(aics).all():
        return -1
    best = int(np.nanargmin(aics))
    simpler = [n for n in range(best) if abs(aics[n] - aics[best]) < 2]
    return simpler[0] if simpler else best


def _fit_frames(keys: list[str], nterms: int):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for _, block in frame.groupby(frame["freq"].map(len), sort=False):
                yield _fit_rows(block, keys, nterms)

    return run


def _fit_rows(block: pd.DataFrame, keys: list[str], nterms: int) -> pd.DataFrame:
    freq, flux, err = (np.stack(block[c].to_numpy()).astype(float) for c in ("freq", "i", "di"))
    use = np.isfinite(flux) & np.isfinite(err) & (err > 0)
    n_use = use.sum(axis=1)
    with np.errstate(all="ignore"):
        ref = np.where(n_use > 0, np.where(use, freq, 0).sum(axis=1) / np.maximum(n_use, 1), np.nan)
        x = freq / ref[:, None]
    weight = np.where(use, 1.0 / np.where(use, err, 1.0) ** 2, 0.0)
    safe_flux = np.where(use, flux, 0.0)
    tried = np.nonzero(n_use > 0)[0]
    mids = np.array([np.median(flux[b][use[b]]) if n_use[b] else np.nan for b in range(len(block))])
    fits = []
    for n in range(nterms + 1):
        params, errors = np.full((len(block), n + 1), np.nan), np.full((len(block), n + 1), np.nan)
        good = np.zeros(len(block), bool)
        if tried.size:
            start = np.zeros((tried.size, n + 1))
            start[:, 0] = mids[tried] / (ref[tried] if n == 0 else 1.0)
            if n:
                start[:, 1] = START_SLOPE
            with np.errstate(all="ignore"):
                params[tried], errors[tried], good[tried] = fit_block(
                    x[tried], ref[tried], safe_flux[tried], weight[tried], start
                )
        fits.append((params, errors, good))
    rows = []
    for b in range(len(block)):
        aics = np.full(nterms + 1, np.nan)
        curves = []
        for n, (params, _, good) in enumerate(fits):
            with np.errstate(all="ignore"):
                curve = np.array(_model(params[b : b + 1], x[b : b + 1], ref[b : b + 1])[0])
            curves.append(curve)
            if good[b]:
                aics[n] = aic_value(float(((flux[b] - curve)[use[b]] ** 2).sum()), n + 1, int(n_use[b]))
        n = pick_model(aics)
        if n < 0:
            blank = np.ones(freq.shape[1])
            rows.append((None, [np.nan], [np.nan], np.nan, np.nan, np.nan, np.nan, blank, blank, blank, True, True, True, True, False))
            continue
        p, e, curve = fits[n][0][b], fits[n][1][b], curves[n]
        with np.errstate(all="ignore"):
            high = np.array(_model((p + e)[None], x[b : b + 1], ref[b : b + 1])[0])
            low = np.array(_model((p - e)[None], x[b : b + 1], ref[b : b + 1])[0])
        z = ((flux[b] - curve) / err[b])[use[b]]
        chi = float((z**2).sum())
        dof = int(n_use[b]) - len(p)
        pval = normality_p(z)
        rows.append(
            (
                n,
                p,
                e,
                ref[b],
                chi,
                chi / dof if dof else np.nan,
                aics[n],
                curve,
                high,
                low,
                bool((curve < 0).any()),
                bool(~np.isfinite(curve).all()),
                bool(pval < NORMALITY_P),
                bool(((curve / np.where(use[b], err[b], np.nan))[use[b]] < 1).any()),
                True,
            )
        )
    names = [part.split()[0] for part in FIT_FIELDS.split(",")]
    out = pd.DataFrame(rows, columns=names)
    out["best_n"] = out["best_n"].astype("Int32")
    for k in reversed(keys):
        out.insert(0, k, block[k].to_numpy())
    return out


def nest_spectrum(spectra: DataFrame, keys: Sequence[str], columns: Sequence[str], chan: str = "chan") -> DataFrame:
    """One row per key with channel-ordered arrays (bounded by the band)."""
    packed = spectra.groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct(F.col(chan).alias("_chan"), *columns))).alias("_s")
    )
    return packed.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in columns])


def fit_power_law(
    spectra: DataFrame, keys: Sequence[str] = ("cat_id",), nterms: int = 2, chan: str = "chan"
) -> DataFrame:
    """Best power law of every spectrum with errors, flags and the model curve.

    Needs columns ``freq``, ``i`` and ``di``.  A spectrum that cannot be fitted
    returns NaN parameters, a unit model, all flags TRUE and ``ok`` FALSE.
    """
    if not 0 <= nterms <= 2:
        raise ValueError("nterms must be 0, 1 or 2")
    keys = list(keys)
    rows = nest_spectrum(
        spectra.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for c in ("freq", "i", "di")}),
        keys,
        ["freq", "i", "di"],
        chan,
    )
    key_types = ", ".join(f"`{k}` {spectra.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInPandas(_fit_frames(keys, nterms), f"{key_types}, {FIT_FIELDS}")
