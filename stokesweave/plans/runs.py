"""Results of a run as elements of the components' result lists, and their way back into the stored table.

A stored table holds one row per component with the list ``rm_outputs_1d``, one element per run.  Its rows lie in
a fixed number of parts by a hash of the key, so a run reads and writes only the parts that hold its components.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stokesweave.functions.spectral import pad_coefs
from stokesweave.session import drop_stage, written_stage
from stokesweave.sources.tables import write_upsert

PART = "part"

# Summary key of the catalogue and the measurement it holds.
SUMMARY = {
    "dIFullBand": "di_full_band",
    "dQFullBand": "dq_full_band",
    "dUFullBand": "du_full_band",
    "bIFullBand": "bi_full_band",
    "bQFullBand": "bq_full_band",
    "bUFullBand": "bu_full_band",
    "phiPeakPIfit_rm2": "rm",
    "dPhiPeakPIfit_rm2": "rm_err",
    "ampPeakPIfitEff": "polint",
    "dAmpPeakPIfit": "polint_err",
    "peakFDFrealFit": "stokes_q",
    "peakFDFimagFit": "stokes_u",
    "polAngleFit_deg": "polangle",
    "dPolAngleFit_deg": "polangle_err",
    "polAngle0Fit_deg": "derot_polangle",
    "dPolAngle0Fit_deg": "derot_polangle_err",
    "fracPol": "fracpol",
    "freq0_Hz": "reffreq_pol",
    "dFDFth": "fdf_noise_th",
    "fwhmRMSF": "rmsf_fwhm",
    "lam0Sq_m2": "refwave_sq_pol",
    "Ifreq0": "ifreq0",
    "fit_flag_is_negative": "fit_flag_is_negative",
    "fit_flag_is_close_to_zero": "fit_flag_is_close_to_zero",
    "fit_flag_is_not_finite": "fit_flag_is_not_finite",
    "fit_flag_is_not_normal": "fit_flag_is_not_normal",
    "IfitChiSqRed": "chi_sq_red",
    "snrPIfit": "snr_polint",
    "min_freq": "minfreq",
    "max_freq": "maxfreq",
    "median_channel_width": "median_channel_width",
    "N_channels": "nchan",
    "polyOrd": "best_n",
    "poly_reffreq": "ref_nu",
    "dQU": "dqu",
    "dFDFcorMAD": "fdf_noise_mad",
    "sigmaAddQ": "sigma_add_q",
    "dSigmaAddPlusQ": "sigma_add_q_plus",
    "dSigmaAddMinusQ": "sigma_add_q_minus",
    "sigmaAddU": "sigma_add_u",
    "dSigmaAddPlusU": "sigma_add_u_plus",
    "dSigmaAddMinusU": "sigma_add_u_minus",
}


def run_elements(measured: DataFrame, save_name: str, keys: Sequence[str] = ("cat_id",), headers: DataFrame | None = None) -> DataFrame:
    """``keys, run``: the rows of ``spectral_measurements`` as elements of a result list.

    Members are ``field, rmsynth1d, rmclean1d, rmsynth_summary, rmclean_summary`` and, with ``headers`` (keys and
    card columns, unique by key), ``header``.  Measurements the table does not carry become NULL members of their summary.
    The summaries of a failed stage are NULL.
    """
    keys = list(keys)
    have = set(measured.columns)

    def member(column: str, key: str) -> Column:
        return (F.col(column) if column in have else F.lit(None).cast("double")).alias(key)

    coefficients = [pad_coefs(c).alias(k) if c in have else F.lit(None).cast("string").alias(k) for c, k in (("best_p", "polyCoeffs"), ("best_e", "polyCoefferr"))]
    synthesis = F.struct(*[member(c, k) for k, c in SUMMARY.items()], *coefficients)
    clean = F.struct(member("rm_width", "mom2CCFDF"))
    cleaned = F.coalesce("rmclean1d", F.lit(False)) if "rmclean1d" in have else F.lit(False)
    synthesised = F.coalesce("rmsynth1d", F.lit(False))
    members = [
        F.lit(save_name).alias("field"),
        synthesised.alias("rmsynth1d"),
        cleaned.alias("rmclean1d"),
        F.when(synthesised, synthesis).alias("rmsynth_summary"),
        F.when(cleaned, clean).alias("rmclean_summary"),
    ]
    rows = measured
    if headers is not None:
        cards = [c for c in headers.columns if c not in keys]
        rows = measured.join(headers.select(*keys, F.struct(*cards).alias("_header")), keys, "left")
        members.append(F.col("_header").alias("header"))
    return rows.select(*keys, F.struct(*members).alias("run"))


def _fitted(run: Column, have: T.StructType, want: T.StructType) -> Column:
    """``run`` as a value of type ``want``: members by name, NULL where it has none."""
    names = {f.name: f.dataType for f in have.fields}
    parts = []
    for f in want.fields:
        if f.name not in names:
            value = F.lit(None).cast(f.dataType)
        elif isinstance(f.dataType, T.StructType) and isinstance(names[f.name], T.StructType):
            value = F.when(run[f.name].isNotNull(), _fitted(run[f.name], names[f.name], f.dataType))
        else:
            value = run[f.name].cast(f.dataType)
        parts.append(value.alias(f.name))
    return F.struct(*parts)


def merge_runs(target: DataFrame, results: DataFrame, keys: Sequence[str] = ("cat_id",), arr: str = "rm_outputs_1d", run: str = "run", replace: bool = True) -> DataFrame:
    """Put each result's element into the list of its row: the element of the same ``field`` gives way, else it is appended.

    Members the result lacks or holds as NULL keep the value of the element that gives way, unless ``replace``
    is off, when only a missing element is added.  A NULL list becomes a new one.  Rows without a result and elements of
    other runs stay as they are; results without a row are left out.  Merging the same results again changes nothing.
    Several results of one key are an error.
    """
    keys = list(keys)
    want = target.schema[arr].dataType.elementType
    one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several results of one key"))).otherwise(F.first(run))
    new = results.groupBy(*keys).agg(one.alias("_run")).select(*keys, _fitted(F.col("_run"), results.schema[run].dataType, want).alias("_run"), F.lit(True).alias("_hit"))
    old, fresh = F.col(arr), F.col("_run")

    def same(x: Column) -> Column:
        return x["field"].eqNullSafe(fresh["field"])

    def patched(x: Column) -> Column:
        return F.struct(*[F.coalesce(fresh[f.name], x[f.name]).alias(f.name) for f in want.fields])

    known = F.coalesce(F.exists(old, same), F.lit(False))
    swapped = F.transform(old, lambda x: F.when(same(x), patched(x)).otherwise(x)) if replace else old
    merged = F.when(F.col("_hit").isNull(), old).when(known, swapped).otherwise(F.concat(F.coalesce(old, F.array().cast(target.schema[arr].dataType)), F.array(fresh)))
    joined = target.join(new, keys, "left")
    return joined.select(*[merged.alias(c) if c == arr else F.col(c) for c in target.columns])


def part_of(keys: Sequence[str], parts: int) -> Column:
    """The part of the stored table a key lies in."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(parts)).cast("int")


def store_components(components: DataFrame, path: str, parts: int, keys: Sequence[str] = ("cat_id",)) -> None:
    """Write ``components`` as a stored table of ``parts`` parts."""
    placed = components.withColumn(PART, part_of(keys, parts))
    placed.repartition(parts, PART).write.mode("overwrite").partitionBy(PART).parquet(path)


def store_runs(spark: SparkSession, path: str, results: DataFrame, parts: int, keys: Sequence[str] = ("cat_id",), arr: str = "rm_outputs_1d") -> list[int]:
    """Merge a run's elements into the stored table; the parts written.

    Only parts that hold a result are read (partition pruning) and overwritten (dynamic overwrite).  The merged
    rows are written to the shared folder first, so the table is never read and replaced at once, and repeating a
    finished call is safe.  The swap of files is not atomic: if it breaks off, the error names the folder that keeps the merged rows,
    from which ``write_upsert`` completes the table.  ``parts`` is that of ``store_components``.
    """
    keys = list(keys)
    # no more numbers than the table has parts
    touched = sorted(r[0] for r in results.select(part_of(keys, parts)).distinct().collect())
    if not touched:
        return []
    whole = spark.read.parquet(path)
    merged, stage = written_stage(merge_runs(whole.where(F.col(PART).isin(touched)), results, keys, arr))
    try:
        write_upsert(merged.repartition(min(len(touched), parts), PART), path, PART)
    except Exception as broken:
        raise RuntimeError(f"{path} may lack rows of this run's parts; all of them are kept in {stage}") from broken
    drop_stage(spark, stage)
    return touched
