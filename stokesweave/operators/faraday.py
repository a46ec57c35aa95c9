"""RM synthesis, RMSF, peak fitting, RM-CLEAN and ionospheric modulation.

Formulae follow the published method papers: synthesis after Brentjens & de
Bruyn (2005), RM-CLEAN after Heald (2009).  With P = Q + iU and weights w,

    lambda0^2 = sum(w lambda^2) / sum(w)
    F(phi)    = sum(w P exp(-2i phi (lambda^2 - lambda0^2))) / sum(w)
    R(phi)    = sum(w   exp(-2i phi (lambda^2 - lambda0^2))) / sum(w)

A spectrum travels once: its channels are nested under its key by one exchange, then blocks of spectra that share a band are
multiplied by that band's matrix of depths.  Peaks, responses and deconvolution follow in the same stage.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.functions.numeric import finite, known_gt, ratio
from stokesweave.functions.spectral import SPEED_OF_LIGHT, lambda_sq
from stokesweave.operators.keyed import skew_join
from stokesweave.session import cut_lineage

GAP_BUCKETS = 4096
BLOCK = 128  # spectra that are transformed together
MATRIX_CELLS = 1 << 21  # channels times depths that are held at once
FWHM_FACTOR = 3.8  # RMSF width over lambda^2 coverage for a top-hat band


def regular_grid(phi_max: float, dphi: float) -> list[float]:
    """Symmetric Faraday depths -phi_max..phi_max including zero."""
    half = int(round(abs(phi_max / dphi)))
    return [i * dphi for i in range(-half, half + 1)]


def double_grid(phi: Sequence[float]) -> list[float]:
    """Grid of twice the range at the same step, for the RMSF."""
    step = phi[1] - phi[0]
    return regular_grid(step * (len(phi) - 1), step)


def rmsf_width(lambda_sq_min: float, lambda_sq_max: float) -> float:
    return FWHM_FACTOR / (lambda_sq_max - lambda_sq_min)


def phi_grid(
    channels: DataFrame,
    freq: str = "freq",
    phi_max: float | None = None,
    dphi: float | None = None,
    n_samples: int = 5,
) -> list[float]:
    """Depth range and step from the band's lambda^2 coverage where not given.

    The step puts ``n_samples`` points across the RMSF; the range is where
    sensitivity halves for the widest channel, at least ten RMSF widths.
    """
    lam = channels.select(lambda_sq(freq).alias("l2")).where(finite("l2")).distinct()
    span = lam.agg(F.min("l2").alias("lo"), F.max("l2").alias("hi")).first()
    fwhm = rmsf_width(span.lo, span.hi)
    step = dphi or fwhm / n_samples
    reach = phi_max or max(math.sqrt(3.0) / widest_gap(lam, "l2", span.lo, span.hi), 10.0 * fwhm)
    return regular_grid(reach, step)


def widest_gap(values: DataFrame, column: str, lo: float, hi: float) -> float:
    """Largest difference of neighbouring values between ``lo`` and ``hi``.

    Values are dealt to buckets of equal width: gaps within a bucket need its values only, those between buckets the
    ends of at most ``GAP_BUCKETS`` of them.
    """
    x = F.col(column)
    placed = values.select(x.alias("x"), F.floor((x - lo) / ((hi - lo) / GAP_BUCKETS)).alias("b"))
    inside = placed.select((F.lead("x").over(Window.partitionBy("b").orderBy("x")) - F.col("x")).alias("gap"))
    ends = placed.groupBy("b").agg(F.min("x").alias("first"), F.max("x").alias("last"))
    across = ends.select((F.lead("first").over(Window.orderBy("b")) - F.col("last")).alias("gap"))
    return inside.unionByName(across).agg(F.max("gap")).first()[0]


def _weights(weight: str, noise: str | None) -> Column:
    if weight == "uniform":
        return F.lit(1.0)
    if weight != "variance":
        raise ValueError("weight must be variance or uniform")
    if noise is None:
        raise ValueError("variance weights need a noise column")
    return 1.0 / (F.col(noise) * F.col(noise))


def nest_channels(
    spectra: DataFrame,
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    noise: str | None = "dqu",
    lam: str = "lambda_sq",
    model: str | None = None,
) -> DataFrame:
    """One row per spectrum: arrays ``l2, w, q, u, noise`` of its usable channels by wavelength.

    Channels with a missing Q, U, wavelength or noise do not take part; a spectrum without any leaves.  The exchange
    by key moves channels, whatever the number of depths that follow.
    """
    usable = finite("q") & finite("u") & finite(lam)
    if weight == "variance":
        usable = usable & finite(noise) & (F.col(noise) > 0)
    q, u = F.col("q"), F.col("u")
    if model is not None:
        usable = usable & finite(model) & (F.col(model) != 0)
        q, u = ratio(q, model), ratio(u, model)
    sigma = F.col(noise) if noise is not None and noise in spectra.columns else F.lit(None)
    channel = F.struct(*[c.cast("double").alias(n) for n, c in (("l2", F.col(lam)), ("w", _weights(weight, noise)), ("q", q), ("u", u), ("noise", sigma))])
    packed = spectra.where(usable).groupBy(*keys).agg(F.array_sort(F.collect_list(channel)).alias("_c"))
    return packed.select(*keys, *[F.col(f"_c.{c}").alias(c) for c in ("l2", "w", "q", "u", "noise")])


class Depths:
    """Sums over channels at every depth for blocks of spectra of one band; the last band's matrix is kept if it is small."""

    def __init__(self, phi: Sequence[float]) -> None:
        self.phi = np.asarray(phi, dtype=float)
        self.band, self.matrix = b"", None

    def _turns(self, l2: np.ndarray, phi: np.ndarray) -> np.ndarray:
        return np.exp(-2j * np.outer(l2, phi))

    def transform(self, l2: np.ndarray, weighted: np.ndarray, lam0: np.ndarray) -> np.ndarray:
        """``sum(weighted exp(-2i phi (l2 - lam0)))``: rows are spectra, ``weighted`` their channels."""
        # the band's middle is taken out first, so phases stay small; the rest is one rotation per spectrum
        middle = l2.mean()
        small = len(l2) * len(self.phi) <= MATRIX_CELLS
        if small and self.band != l2.tobytes():
            self.band, self.matrix = l2.tobytes(), self._turns(l2 - middle, self.phi)
        out = np.empty((len(weighted), len(self.phi)), dtype=complex)
        step = len(self.phi) if small else max(1, MATRIX_CELLS // len(l2))
        for at in range(0, len(self.phi), step):
            part = self.phi[at : at + step]
            turns = self.matrix if small else self._turns(l2 - middle, part)
            out[:, at : at + step] = (weighted @ turns) * np.exp(2j * np.outer(lam0 - middle, part))
        return out


def _rows_of(column: pa.ListArray) -> list[np.ndarray]:
    values = column.flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return np.split(values, ends[:-1]) if len(ends) else []


def _bands(batch: pa.RecordBatch, first: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, wavelengths, weights, Q + iU and noise of the spectra of each band in a batch."""
    columns = [_rows_of(batch.column(first + k)) for k in range(5)]
    rows: dict[bytes, list[int]] = {}
    for n, l2 in enumerate(columns[0]):
        rows.setdefault(l2.tobytes(), []).append(n)
    for at in rows.values():
        l2, w, q, u, noise = (np.stack([c[n] for n in at]).astype(float) for c in columns)
        yield np.array(at), l2[0], w, q + 1j * u, noise


SCALARS = ("n_chan", "lambda0_sq", "fdf_noise", "rmsf_fwhm", "lambda_sq_var", "freq0", "min_freq", "max_freq")
PEAK = ("phi", "amp", "phi_fit", "amp_fit", "re_fit", "im_fit")
ARRAYS = ("phi", "re", "im", "rmsf_re", "rmsf_im")


def _ratio(a, b) -> np.ndarray:
    """As ``ratio`` of columns: NaN where the quotient is not finite."""
    with np.errstate(divide="ignore", invalid="ignore"):
        out = np.divide(a, b)
    return np.where(np.isfinite(out), out, np.nan)


def _scalars(l2: np.ndarray, w: np.ndarray, noise: np.ndarray) -> dict[str, np.ndarray]:
    total = w.sum(axis=1)
    lam0 = (w * l2).sum(axis=1) / total
    ones = np.ones(len(w))
    # only uniform weights let channels without a noise in
    known = np.isfinite(noise)
    return {
        "n_chan": ones * len(l2),
        "lambda0_sq": lam0,
        "fdf_noise": _ratio(np.sqrt((np.where(known, w * noise, 0.0) ** 2).sum(axis=1)), (w * known).sum(axis=1)),
        "rmsf_fwhm": _ratio(FWHM_FACTOR, ones * (l2.max() - l2.min())),
        "lambda_sq_var": ones * l2.var(),
        "freq0": _ratio(SPEED_OF_LIGHT, np.sqrt(lam0)),
        "min_freq": _ratio(SPEED_OF_LIGHT, ones * np.sqrt(l2.max())),
        "max_freq": _ratio(SPEED_OF_LIGHT, ones * np.sqrt(l2.min())),
    }


def _peaks(phi: np.ndarray, fdf: np.ndarray) -> dict[str, np.ndarray]:
    """As :func:`peak3`, for the rows of a block."""
    amp = np.abs(fdf)
    at, rows = amp.argmax(axis=1), np.arange(len(fdf))
    lo, up = np.maximum(at - 1, 0), np.minimum(at + 1, len(phi) - 1)
    whole = (at > 0) & (at < len(phi) - 1)
    curve = amp[rows, lo] - 2.0 * amp[rows, at] + amp[rows, up]
    s = np.where(whole, _ratio(0.5 * (amp[rows, lo] - amp[rows, up]), curve), 0.0)
    s = np.where(np.isfinite(s), s, 0.0)

    def along(v: np.ndarray) -> np.ndarray:
        a, b, c = v[rows, lo], v[rows, at], v[rows, up]
        return np.where(whole, b + 0.5 * (c - a) * s + 0.5 * (a - 2.0 * b + c) * s * s, b)

    step = np.where(at < len(phi) - 1, phi[up] - phi[at], phi[at] - phi[lo])
    return dict(zip(PEAK, (phi[at], amp[rows, at], phi[at] + s * step, along(amp), along(fdf.real), along(fdf.imag))))


def _lists(values: np.ndarray) -> pa.ListArray:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(values).ravel()))


def _spectrum_batches(phi: list[float], n_keys: int, wanted: list[str], unit: bool) -> Callable:
    """Transform of nested spectra; ``wanted`` columns follow the keys.  ``unit`` puts a unit source at zero depth in place of the data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        depths, response = Depths(phi), Depths(double_grid(phi) if {"rmsf_re", "rmsf_im"} & set(wanted) else [])
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(at, BLOCK)
                for rows, l2, w, p, noise in _bands(batch, n_keys):
                    found: dict[str, np.ndarray] = _scalars(l2, w, noise)
                    lam0, total = found["lambda0_sq"], w.sum(axis=1)[:, None]
                    fdf = depths.transform(l2, w * (np.ones_like(p) if unit else p), lam0) / total
                    found |= {"re": fdf.real, "im": fdf.imag}
                    if len(response.phi):
                        r = response.transform(l2, w, lam0) / total
                        found |= {"rmsf_re": r.real, "rmsf_im": r.imag}
                    found |= {f"peak_{c}": v for c, v in _peaks(depths.phi, fdf).items()}
                    found["phi"] = np.broadcast_to(depths.phi, fdf.shape)
                    arrays = [
                        pa.array(found[c].astype(np.int64)) if c == "n_chan" else _lists(found[c]) if found[c].ndim == 2 else pa.array(found[c], from_pandas=True) for c in wanted
                    ]
                    keys = [batch.column(k).take(pa.array(rows)) for k in range(n_keys)]
                    yield pa.RecordBatch.from_arrays(keys + arrays, names=batch.schema.names[:n_keys] + wanted)

    return run


def faraday_spectra(
    spectra: DataFrame,
    phi: Sequence[float],
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    noise: str | None = "dqu",
    lam: str = "lambda_sq",
    model: str | None = None,
    columns: Sequence[str] = (*ARRAYS, *SCALARS, *(f"peak_{c}" for c in PEAK)),
    unit: bool = False,
) -> DataFrame:
    """One nested row per spectrum: Faraday spectrum, response, scalars and fitted peak, as ``columns`` asks.

    Arrays are ``phi, re, im`` on the given depths and ``rmsf_re, rmsf_im`` on the doubled grid.  One exchange by key; the
    number of depths is not limited, as long grids are worked off in parts.  Spectra of one band share their matrix.
    """
    keys, wanted = list(keys), list(columns)
    phi = sorted(float(p) for p in phi)
    types = {c: "array<double>" for c in ARRAYS} | {c: "long" if c == "n_chan" else "double" for c in (*SCALARS, *(f"peak_{c}" for c in PEAK))}
    nested = nest_channels(spectra, keys, weight, noise, lam, model)
    schema = ", ".join([f"`{k}` {spectra.schema[k].dataType.simpleString()}" for k in keys] + [f"{c} {types[c]}" for c in wanted])
    return nested.mapInArrow(_spectrum_batches(phi, len(keys), wanted, unit), schema)


def rm_synthesis(
    spectra: DataFrame,
    phi: Sequence[float],
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    noise: str | None = "dqu",
    lam: str = "lambda_sq",
    model: str | None = None,
) -> DataFrame:
    """Faraday spectrum per key in long form: phi, re, im, lambda0_sq.

    Channels with a missing Q, U, wavelength or noise do not take part.
    ``model`` names a Stokes I model column to divide by (fractional spectrum).
    """
    return _long(faraday_spectra(spectra, phi, keys, weight, noise, lam, model, ("phi", "re", "im", "lambda0_sq")), keys)


def _long(nested: DataFrame, keys: Sequence[str]) -> DataFrame:
    rows = nested.select(*keys, F.explode(F.arrays_zip("phi", "re", "im")).alias("_f"), "lambda0_sq")
    return rows.select(*keys, *[F.col(f"_f.{c}").alias(c) for c in ("phi", "re", "im")], "lambda0_sq")


def rmsf(
    spectra: DataFrame,
    phi: Sequence[float],
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    noise: str | None = "dqu",
    lam: str = "lambda_sq",
) -> DataFrame:
    """Response to a unit source at zero depth, on the doubled grid, in long form."""
    grid = double_grid(phi)
    return _long(faraday_spectra(spectra, grid, keys, weight, noise, lam, None, ("phi", "re", "im", "lambda0_sq"), unit=True), keys)


def synthesis_scalars(
    spectra: DataFrame,
    keys: Sequence[str] = ("cat_id",),
    weight: str = "variance",
    noise: str = "dqu",
    lam: str = "lambda_sq",
) -> DataFrame:
    """Per key: channel count, reference wavelength, RMSF width, theoretical
    noise of the Faraday spectrum, wavelength variance and frequency range."""
    rows = spectra.where(finite("q") & finite("u") & finite(lam) & finite(noise) & (F.col(noise) > 0))
    rows = rows.withColumn("_w", _weights(weight, noise))
    l2 = F.col(lam)
    out = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_chan"),
        (F.sum(F.col("_w") * l2) / F.sum("_w")).alias("lambda0_sq"),
        (F.sqrt(F.sum(F.pow(F.col("_w") * F.col(noise), 2.0))) / F.sum("_w")).alias("fdf_noise"),
        (F.max(l2) - F.min(l2)).alias("_span"),
        F.var_pop(l2).alias("_var"),
        F.sqrt(F.min(l2)).alias("_lmin"),
        F.sqrt(F.max(l2)).alias("_lmax"),
    )
    return out.select(
        *keys,
        "n_chan",
        "lambda0_sq",
        "fdf_noise",
        ratio(F.lit(FWHM_FACTOR), "_span").alias("rmsf_fwhm"),
        F.col("_var").alias("lambda_sq_var"),
        ratio(F.lit(SPEED_OF_LIGHT), F.sqrt("lambda0_sq")).alias("freq0"),
        ratio(F.lit(SPEED_OF_LIGHT), "_lmax").alias("min_freq"),
        ratio(F.lit(SPEED_OF_LIGHT), "_lmin").alias("max_freq"),
    )


def peak3(fdf: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """Peak of |F| with its two neighbours and the parabola through the three.

    The window runs over one Faraday spectrum, bounded by the depth grid.  A
    peak on the edge of the grid has no parabola and keeps the grid values.
    """
    over = Window.partitionBy(*keys).orderBy("phi")
    amp = fdf.withColumn("amp", F.hypot("re", "im"))
    lagged = amp.select(
        *keys,
        "phi",
        "re",
        "im",
        "amp",
        *[F.lag(c).over(over).alias(f"{c}_lo") for c in ("phi", "re", "im", "amp")],
        *[F.lead(c).over(over).alias(f"{c}_up") for c in ("phi", "re", "im", "amp")],
    )
    rest = [c for c in lagged.columns if c not in keys]
    best = lagged.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct("amp", -F.col("phi"))).alias("_p"))
    rows = best.select(*keys, "_p.*")
    curve = F.col("amp_lo") - 2.0 * F.col("amp") + F.col("amp_up")
    shift = 0.5 * ratio(F.col("amp_lo") - F.col("amp_up"), curve)
    rows = rows.withColumn("_s", F.coalesce(shift, F.lit(0.0)))
    s = F.col("_s")

    def along(c: str) -> Column:
        lo, mid, up = F.col(f"{c}_lo"), F.col(c), F.col(f"{c}_up")
        value = mid + 0.5 * (up - lo) * s + 0.5 * (lo - 2.0 * mid + up) * s * s
        return F.coalesce(value, mid)

    step = F.coalesce(F.col("phi_up") - F.col("phi"), F.col("phi") - F.col("phi_lo"))
    return rows.select(
        *keys,
        "phi",
        "amp",
        (F.col("phi") + s * F.coalesce(step, F.lit(0.0))).alias("phi_fit"),
        along("amp").alias("amp_fit"),
        along("re").alias("re_fit"),
        along("im").alias("im_fit"),
    )


def fdf_peak(fdf: DataFrame, scalars: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """Polarisation measurements at the fitted peak, joined with their errors.

    Amplitude bias is removed as sqrt(A^2 - 2.3 sigma^2) above a signal to noise
    of five; angles are in degrees modulo 180; the intrinsic angle is
    chi0 = chi - RM lambda0^2.
    """
    return _measurements(peak3(fdf.drop("lambda0_sq"), keys).join(scalars, list(keys)), keys)


def spectrum_peaks(spectra: DataFrame, phi: Sequence[float], keys: Sequence[str] = ("cat_id",), **options) -> DataFrame:
    """:func:`fdf_peak` straight from the channels: one exchange by key, no Faraday spectrum leaves its task."""
    return peak_measurements(faraday_spectra(spectra, phi, keys, columns=(*SCALARS, *(f"peak_{c}" for c in PEAK)), **options), keys)


def peak_measurements(nested: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """The columns of :func:`fdf_peak` for rows of :func:`faraday_spectra`."""
    return _measurements(nested.select(*keys, *SCALARS, *[F.col(f"peak_{c}").alias(c) for c in PEAK]), keys)


def _measurements(p: DataFrame, keys: Sequence[str]) -> DataFrame:
    a, noise, n = F.col("amp_fit"), F.col("fdf_noise"), F.col("n_chan")
    snr = ratio(a, noise)
    eff = F.when(known_gt(snr, F.lit(5.0)), F.sqrt(a * a - 2.3 * noise * noise)).otherwise(a)
    angle = F.pmod(F.degrees(0.5 * F.atan2("im_fit", "re_fit")), F.lit(180.0))
    angle0 = F.pmod(angle - F.degrees(F.col("phi_fit") * F.col("lambda0_sq")), F.lit(180.0))
    # the published form has the channel noise, which is sqrt(n) times that of the Faraday spectrum
    var0 = ratio(n * noise * noise, 4.0 * (n - 2) * a * a) * (
        ratio(n - 1, n) + ratio(F.pow("lambda0_sq", F.lit(2.0)), "lambda_sq_var")
    )
    return p.select(
        *keys,
        F.col("phi_fit").alias("rm"),
        (F.col("rmsf_fwhm") * 0.5 * ratio(noise, a)).alias("rm_err"),
        eff.alias("polint"),
        noise.alias("polint_err"),
        F.col("re_fit").alias("stokes_q"),
        F.col("im_fit").alias("stokes_u"),
        angle.alias("polangle"),
        F.degrees(0.5 * ratio(noise, a)).alias("polangle_err"),
        angle0.alias("derot_polangle"),
        F.degrees(F.sqrt(var0)).alias("derot_polangle_err"),
        snr.alias("snr_polint"),
        noise.alias("fdf_noise_th"),
        "rmsf_fwhm",
        F.col("lambda0_sq").alias("refwave_sq_pol"),
        F.col("freq0").alias("reffreq_pol"),
        F.col("min_freq").alias("minfreq"),
        F.col("max_freq").alias("maxfreq"),
        n.alias("nchan"),
    )


# --- RM-CLEAN ----------------------------------------------------------------

CLEAN_FIELDS = (
    "phi array<double>, clean_re array<double>, clean_im array<double>, model_re array<double>,"
    " model_im array<double>, n_iter int, cutoff_used double, ok boolean"
)


def clean_batch(
    dirty: np.ndarray,
    response: np.ndarray,
    cutoff: np.ndarray,
    width: np.ndarray,
    step: float,
    max_iter: int,
    gain: float,
    window: float | None,
):
    """CLEAN a block of spectra of equal length together.

    ``dirty`` is (spectra, n), ``response`` (spectra, 2n - 1) centred on zero
    depth.  Every step works on the spectra still above their cutoff.
    """
    count, n = dirty.shape
    residual = dirty.copy()
    model = np.zeros_like(dirty)
    steps = np.zeros(count, dtype=int)
    live = np.arange(count)
    offsets = np.arange(n)
    allowed = np.ones((count, n), dtype=bool)
    if window is not None:
        first = np.argmax(np.abs(dirty), axis=1)
        allowed = np.abs(offsets[None, :] - first[:, None]) * step <= window
    for _ in range(max_iter):
        amp = np.where(allowed[live], np.abs(residual[live]), 0.0)
        at = amp.argmax(axis=1)
        above = amp[np.arange(live.size), at] >= cutoff[live]
        live, at = live[above], at[above]
        if not live.size:
            break
        part = gain * residual[live, at]
        model[live, at] += part
        shifted = response[live[:, None], (n - 1) - at[:, None] + offsets[None, :]]
        residual[live] -= part[:, None] * shifted
        steps[live] += 1
    sigma = width / (2.0 * math.sqrt(2.0 * math.log(2.0)))
    lags = (np.arange(2 * n - 1) - (n - 1)) * step
    kernel = np.exp(-0.5 * (lags[None, :] / sigma[:, None]) ** 2)
    restored = residual.copy()
    rows, cols = np.nonzero(model)
    for r, c in zip(rows, cols):
        restored[r] += model[r, c] * kernel[r, (n - 1) - c : 2 * n - 1 - c]
    return restored, model, steps


def _clean_frames(keys: list[str], cutoff: float, max_iter: int, gain: float, window: float | None):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for whole, at in ((f, at) for f in frames for at in range(0, len(f), BLOCK)):
            frame = whole.iloc[at : at + BLOCK]
            blocks = []
            # rows of other lengths go apart, so an odd one cannot spoil its block
            parts = ["phi", "re", "im", "rmsf_re", "rmsf_im"]
            shape = pd.Series([tuple(-1 if v is None else len(v) for v in row) for row in zip(*[frame[c] for c in parts])], index=frame.index)
            for (n, *_), block in frame.groupby(shape, sort=False):
                out = block[keys].copy()
                phi = np.stack(block["phi"].to_numpy())
                try:
                    dirty = np.stack(block["re"].to_numpy()) + 1j * np.stack(block["im"].to_numpy())
                    resp = np.stack(block["rmsf_re"].to_numpy()) + 1j * np.stack(block["rmsf_im"].to_numpy())
                    noise = block["fdf_noise"].to_numpy(dtype=float)
                    level = np.full(len(block), float(cutoff)) if cutoff > 0 else -cutoff * noise
                    width = block["rmsf_fwhm"].to_numpy(dtype=float)
                    good = (
                        np.isfinite(dirty).all(axis=1)
                        & np.isfinite(resp).all(axis=1)
                        & np.isfinite(level)
                        & np.isfinite(width)
                        & (resp.shape[1] == 2 * n - 1)
                    )
                    clean = np.full(dirty.shape, np.nan + 0j)
                    model = np.full(dirty.shape, np.nan + 0j)
                    steps = np.zeros(len(block), dtype=int)
                    if good.any():
                        clean[good], model[good], steps[good] = clean_batch(
                            dirty[good], resp[good], level[good], width[good], phi[0, 1] - phi[0, 0], max_iter, gain, window
                        )
                except Exception:  # one bad block must not fail the job: report it as not cleaned
                    clean = model = np.full(phi.shape, np.nan + 0j)
                    steps, level, good = np.zeros(len(block), int), np.full(len(block), np.nan), np.zeros(len(block), bool)
                out["phi"] = list(phi)
                out["clean_re"], out["clean_im"] = list(clean.real), list(clean.imag)
                out["model_re"], out["model_im"] = list(model.real), list(model.imag)
                out["n_iter"], out["cutoff_used"], out["ok"] = steps, level, good
                blocks.append(out)
            if blocks:
                yield pd.concat(blocks)

    return run


def nest_fdf(fdf: DataFrame, keys: Sequence[str], prefix: str = "") -> DataFrame:
    """One row per key with arrays ordered by depth (bounded by the grid)."""
    packed = fdf.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("phi", "re", "im"))).alias("_f"))
    return packed.select(
        *keys,
        *[F.col(f"_f.{c}").alias(f"{prefix}{c}") for c in ("phi", "re", "im")],
    )


def rm_clean(
    fdf: DataFrame,
    response: DataFrame,
    scalars: DataFrame,
    keys: Sequence[str] = ("cat_id",),
    cutoff: float = -3.0,
    max_iter: int = 10_000,
    gain: float = 0.1,
    window: float | None = None,
) -> DataFrame:
    """Deconvolve every Faraday spectrum: one nested row per key.

    A positive cutoff is absolute, a negative one counts noise deviations.
    ``window`` limits components to that many rad/m^2 around the dirty peak.
    Spectra that cannot be cleaned come back with ``ok`` FALSE.
    """
    keys = list(keys)
    rows = (
        nest_fdf(fdf, keys)
        .join(nest_fdf(response, keys, "rmsf_").drop("rmsf_phi"), keys, "left")
        .join(scalars.select(*keys, "fdf_noise", "rmsf_fwhm"), keys, "left")
        .withColumns({c: F.coalesce(c, F.array().cast("array<double>")) for c in ("rmsf_re", "rmsf_im")})
    )
    return clean_nested(rows, keys, cutoff, max_iter, gain, window)


def clean_nested(
    nested: DataFrame, keys: Sequence[str] = ("cat_id",), cutoff: float = -3.0, max_iter: int = 10_000, gain: float = 0.1, window: float | None = None
) -> DataFrame:
    """:func:`rm_clean` of the rows of :func:`faraday_spectra`, which hold all it needs: no exchange."""
    keys = list(keys)
    rows = nested.select(*keys, "phi", "re", "im", "rmsf_re", "rmsf_im", "fdf_noise", "rmsf_fwhm")
    key_types = ", ".join(f"`{k}` {nested.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInPandas(_clean_frames(keys, cutoff, max_iter, gain, window), f"{key_types}, {CLEAN_FIELDS}")


def clean_spectra(spectra: DataFrame, phi: Sequence[float], keys: Sequence[str] = ("cat_id",), weight: str = "variance", noise: str = "dqu", lam: str = "lambda_sq", **options) -> DataFrame:
    """Synthesis, response and RM-CLEAN of every spectrum behind one exchange by key."""
    return clean_nested(faraday_spectra(spectra, phi, keys, weight, noise, lam, columns=(*ARRAYS, "fdf_noise", "rmsf_fwhm")), keys, **options)


def clean_components(cleaned: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """Long form of the clean components: phi, re, im."""
    zipped = F.arrays_zip("phi", "model_re", "model_im")
    rows = cleaned.where("ok").select(*keys, F.explode(zipped).alias("_c"))
    return rows.select(*keys, F.col("_c.phi").alias("phi"), F.col("_c.model_re").alias("re"), F.col("_c.model_im").alias("im")).where(
        (F.col("re") != 0) | (F.col("im") != 0)
    )


def cc_moment2(components: DataFrame, keys: Sequence[str] = ("cat_id",)) -> DataFrame:
    """Square root of the second moment of |components| about their first moment."""
    a, phi = F.hypot("re", "im"), F.col("phi")
    sums = components.groupBy(*keys).agg(
        F.sum(a).alias("_s0"), F.sum(a * phi).alias("_s1"), F.sum(a * phi * phi).alias("_s2")
    )
    mean = ratio("_s1", "_s0")
    return sums.select(
        *keys, mean.alias("mom1"), F.sqrt(F.greatest(F.lit(0.0), ratio("_s2", "_s0") - mean * mean)).alias("mom2")
    )


# --- ionosphere --------------------------------------------------------------


MODULATION_BLOCK = 64  # readings that a short cell of time holds on average
CELL_RADIX = 4  # short cells in a cell of the next level
MOST_LEVELS = 12


def window_modulation(
    iono: DataFrame,
    windows: DataFrame,
    bands: DataFrame,
    key: str = "source_id",
    rm: str = "rm",
    time: str = "t",
    start: str = "start",
    length: str = "length",
    band: str = "band",
    bucket: float | None = None,
) -> DataFrame:
    """theta(channel) of every row of ``windows``: mean of exp(2i RM(t) lambda^2) over its own time and band.

    ``iono`` is a series ``key, time, rm``; ``windows`` has ``key``, ``start``, ``length`` (the units of ``time``), ``band`` and any other columns, which are kept; ``bands``
    lists ``band, chan, freq``.  Returns the columns of ``windows`` with ``chan, re, im, n``; both ends of a window belong to it, and
    windows without a finite reading, without a length or a start have no rows.  Rows that are equal count as one window.

    Readings are summed, by channel, over short cells of time and over cells ``CELL_RADIX`` times as long, and so on up to the mean window.  A window takes
    the longest cells that lie in it, so it meets few of them however many readings it holds; single readings are
    looked at only in a short cell that an end of the window cuts.  A short cell (``bucket``) holds ``MODULATION_BLOCK`` on average.
    """
    rows = windows.where(finite(start) & finite(length) & (F.col(length) >= 0)).distinct()
    series = iono.where(finite(rm) & finite(time)).select(F.col(key).alias("_key"), F.col(time).cast("double").alias("_t"), F.col(rm).cast("double").alias("_rm"))
    mean = rows.agg(F.avg(length)).first()[0] or 1.0
    if bucket and bucket > 0:
        depth = max(0, math.ceil(math.log(mean / bucket, CELL_RADIX)))
        step = float(bucket)
    else:
        crowd = series.groupBy("_key").agg(F.count("*").cast("double").alias("_n"), F.greatest(F.max("_t") - F.min("_t"), F.lit(mean)).alias("_span"))
        held = (crowd.agg(F.sum(F.col("_n") * F.col("_n") / F.col("_span")) / F.sum("_n")).first()[0] or 0.0) * mean
        depth = min(MOST_LEVELS, max(0, math.ceil(math.log(max(held / MODULATION_BLOCK, 1.0), CELL_RADIX))))
        step = mean / CELL_RADIX**depth
    series = series.withColumn("_slot", F.floor(F.col("_t") / step))
    names = windows.columns
    begin, end = F.col(start).cast("double"), F.col(start).cast("double") + F.col(length)
    packed = rows.select(F.struct(*names).alias("_w"), F.col(key).alias("_key"), F.col(band).alias("_band"), begin.alias("_from"), end.alias("_to"))
    packed = packed.withColumns({"_first": F.floor(F.col("_from") / step), "_last": F.floor(F.col("_to") / step)})

    # sums of the cells of every level; the channels are a band's
    listed = bands.where(finite("freq")).select(F.col(band).alias("_band"), "chan", lambda_sq("freq").alias("_l2"))
    angle = 2.0 * F.col("_rm") * F.col("_l2")
    phasors = [F.sum(F.cos(angle)).alias("_re"), F.sum(F.sin(angle)).alias("_im"), F.count("*").alias("_n")]
    totals = [F.sum(c).alias(c) for c in ("_re", "_im", "_n")]
    short = cut_lineage(series.crossJoin(F.broadcast(listed)).groupBy("_key", "_slot", "_band", "chan").agg(*phasors))
    wide = F.array(*[F.struct(F.lit(k).alias("_level"), F.floor(F.col("_slot") / CELL_RADIX**k).alias("_cell")) for k in range(depth + 1)])
    cells = short.select("*", F.explode(wide).alias("_c")).select("*", "_c.*").groupBy("_key", "_level", "_cell", "_band", "chan").agg(*totals)

    def level(k: int, lo: Column, hi: Column) -> Column:
        """Cells from ``lo`` up to but not including ``hi``."""
        item = F.transform(F.sequence(lo, hi - 1), lambda c: F.struct(F.lit(k).alias("_level"), c.alias("_cell")))
        return F.when(lo < hi, item).otherwise(F.filter(item, lambda _: F.lit(False)))

    taken, lo, hi = [], F.col("_first") + 1, F.col("_last")
    for k in range(depth):
        # up to the next border of a longer cell, and from the last one on
        up, down = F.ceil(lo / CELL_RADIX), F.floor(hi / CELL_RADIX)
        apart = up <= down
        taken += [level(k, lo, F.when(apart, up * CELL_RADIX).otherwise(hi)), level(k, F.when(apart, down * CELL_RADIX).otherwise(hi), hi)]
        lo, hi = up, down
    taken.append(level(depth, lo, hi))
    inner = packed.select("_w", "_key", "_band", F.explode(F.flatten(F.array(*taken))).alias("_c")).select("_w", "_key", "_band", "_c.*")
    # the cells at the ends: whole where all their readings are in the window, else reading by reading
    ends = packed.withColumn("_slot", F.explode(F.array_distinct(F.array("_first", "_last"))))
    spans = series.groupBy("_key", "_slot").agg(F.min("_t").alias("_t0"), F.max("_t").alias("_t1"))
    ends = cut_lineage(ends.join(spans, ["_key", "_slot"]).where((F.col("_t1") >= F.col("_from")) & (F.col("_t0") <= F.col("_to"))))
    whole = (F.col("_t0") >= F.col("_from")) & (F.col("_t1") <= F.col("_to"))
    asked = inner.unionByName(ends.where(whole).select("_w", "_key", "_band", F.lit(0).alias("_level"), F.col("_slot").alias("_cell")))
    parts = ["_w", "chan", "_re", "_im", "_n"]
    sums = asked.join(cells, ["_key", "_level", "_cell", "_band"]).select(*parts)
    crossed = ends.where(~whole).select("_w", "_key", "_band", "_from", "_to", "_slot")
    met = skew_join(crossed, series, ["_key", "_slot"], F.col("_t").between(F.col("_from"), F.col("_to"))).select("_w", "_band", "_rm")
    sums = sums.unionByName(met.join(F.broadcast(listed), "_band").groupBy("_w", "chan").agg(*phasors).select(*parts))
    out = sums.groupBy("_w", "chan").agg(*totals)
    return out.select("_w.*", "chan", (F.col("_re") / F.col("_n")).alias("re"), (F.col("_im") / F.col("_n")).alias("im"), F.col("_n").alias("n"))


def faraday_modulation(
    iono: DataFrame,
    freqs: Sequence[float],
    key: str = "source_id",
    rm: str = "rm",
    time: str | None = None,
    start=None,
    end=None,
) -> DataFrame:
    """theta(channel) = time mean of exp(2i RM(t) lambda^2) per source.

    The channel list is a literal array (a band), so the series is neither
    joined nor shuffled before partial aggregation.
    """
    rows = iono if time is None else iono.where(F.col(time).between(F.lit(start), F.lit(end)))
    lam = [(SPEED_OF_LIGHT / float(f)) ** 2 for f in freqs]
    channels = F.posexplode(F.array(*[F.lit(v) for v in lam])).alias("chan", "_l2")
    spread = rows.where(finite(rm)).select(key, F.col(rm).alias("_rm"), channels)
    angle = 2.0 * F.col("_rm") * F.col("_l2")
    return spread.groupBy(key, "chan").agg(F.avg(F.cos(angle)).alias("re"), F.avg(F.sin(angle)).alias("im"))
