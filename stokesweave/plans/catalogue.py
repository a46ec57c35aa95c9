"""From finished components to the flagged catalogue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.nested import element_where, exists_where
from stokesweave.functions.numeric import finite, inf_to_nan
from stokesweave.functions.sky import to_galactic
from stokesweave.functions.spectral import (
    complex_sigma_add_flag,
    complex_width_flag,
    epoch_mid,
    eval_poly,
    good_rm,
    leakage_flag,
    snr_flag,
    spectral_index,
    stokes_i_fit_flag,
)
from stokesweave.operators.association import blended_components
from stokesweave.operators.complexity import sigma_add
from stokesweave.operators.fields import (
    channel_flag,
    component_or_island,
    constant_columns,
    in_field_rows,
    int_time_lookup,
    pos_err,
    tile_separation,
    validate_sbid_field,
)
from stokesweave.operators.keyed import first_per_key
from stokesweave.operators.leakage import fit_envelope
from stokesweave.operators.outliers import local_outliers
from stokesweave.session import cut_lineage
from stokesweave.sources.schema import COLUMNS, keep_metadata, select_catalogue_columns, to_jy

RUN_FLAGS = {"rmsynth1d": True, "rmclean1d": True}
SUMMARIES = ("rmsynth_summary", "rmclean_summary")


def finished_components(components: DataFrame, per_field: DataFrame, field: str, save_name: str) -> DataFrame:
    """Components of the field's sources whose run is complete, with that run as ``run``.

    ``components`` carries ``rm_outputs_1d``; summaries and header are structs.
    """
    sources = in_field_rows(per_field, field).select(F.col("source_id").alias("Source_ID"))
    where = {"field": save_name, **RUN_FLAGS}
    done = components.join(sources, "Source_ID", "left_semi").where(exists_where("rm_outputs_1d", where, SUMMARIES))
    return done.withColumn("run", element_where("rm_outputs_1d", where, (*SUMMARIES, "header"))).drop("rm_outputs_1d")


def _summary_value(run: DataFrame, key: str) -> Column:
    """Clean summary value, else the synthesis one; headers by card name."""
    members = {f.name: f.dataType for f in run.schema["run"].dataType.fields}

    def has(part: str) -> bool:
        return part in members and key in members[part].names

    options = [F.col(f"run.{p}.{key}") for p in ("rmclean_summary", "rmsynth_summary") if has(p)]
    if not options:
        raise ValueError(f"no summary holds {key}")
    return F.coalesce(*options)


def assemble(done: DataFrame, islands: DataFrame) -> DataFrame:
    """The declared catalogue columns from component, island, summaries and header."""
    cat_keys = list(dict.fromkeys(c.key for c in COLUMNS if c.source == "cat" and c.key != "Source_ID"))
    filled = component_or_island(done, islands, cat_keys, "Source_ID")
    available: dict[str, Column] = {k: F.col(k) for k in [*cat_keys, "Source_ID"]}
    for c in COLUMNS:
        if c.source == "synth":
            available[c.key] = _summary_value(filled, c.key)
        elif c.source == "header":
            available[c.key] = F.col(f"run.header.{c.key}")
    return select_catalogue_columns(filled, available)


def add_flags(
    cat: DataFrame,
    leakage_degree: int = 4,
    leakage_bins: int = 16,
    leakage_snr: float = 30.0,
    reference_compat: bool = False,
) -> tuple[DataFrame, list[float]]:
    """All quality flags; also returns the envelope coefficients."""
    envelope = fit_envelope(cat, leakage_bins, leakage_degree, snr_cut=leakage_snr)
    out = channel_flag(cat.withColumn("snr_flag", snr_flag("snr_polint")))
    out = out.withColumns(
        {
            "leakage_flag": leakage_flag("fracpol", eval_poly("beamdist", envelope)),
            "stokesI_fit_flag": stokes_i_fit_flag(
                "stokesI_fit_flag_is_negative", "stokesI_fit_flag_is_close_to_zero", "stokesI_fit_flag_is_not_finite"
            ),
            "complex_sigma_add_flag": complex_sigma_add_flag("sigma_add", "sigma_add_err"),
            "complex_M2_CC_flag": complex_width_flag("rm_width", "rmsf_fwhm"),
        }
    )
    # outliers and blends read narrow copies, each once, and come back by id
    narrow = out.select("cat_id", "ra", "dec", "rm", F.coalesce(good_rm()["good_rm"], F.lit(False)).alias("_good"))
    local = local_outliers(narrow, "_good", reference_compat=reference_compat).select("cat_id", "local_rm_flag")
    shape = cat.select("source_id", "cat_id", "ra", "dec", "total_I_flux", "beam_maj", "N_Gaus")
    blends = blended_components(shape, flux="total_I_flux", n_gaus="N_Gaus").select(
        "cat_id", "is_blended_flag", "blend_ratio", F.col("n_blended").alias("N_blended")
    )
    out = out.join(local, "cat_id").join(blends, "cat_id")
    return out, envelope


def make_catalogue(
    components: DataFrame,
    islands: DataFrame,
    per_field: DataFrame,
    fields: DataFrame,
    field: str,
    sbid: int | None = None,
    catalogue_name: str | None = None,
    leakage_degree: int = 4,
    leakage_bins: int = 16,
    leakage_snr: float = 30.0,
    reference_compat: bool = False,
) -> DataFrame:
    """Flagged catalogue of one field (all epochs' field rows in ``fields``).

    ``fields`` has ``field_name, sbid, sel, ra, dec, pol_axis, scan_tint``.
    """
    if sbid is not None and not validate_sbid_field(fields, field, sbid):
        raise ValueError(f"SBID {sbid} does not match field {field}")
    save_name = field if sbid is None else f"{field}_{sbid}"
    done = finished_components(components, per_field, field, save_name)
    base = assemble(done, islands)
    if sbid is not None:
        base = keep_metadata(base, base.withColumns({"sbid": F.lit(str(sbid)), "tile_id": F.lit(field)}))
    one_per_name = first_per_key(fields, ["field_name"], ["sbid", "ra", "dec"])
    placed = tile_separation(base.drop("separation_tile_centre"), one_per_name)
    placed = placed.withColumn("beamdist", F.coalesce("separation_tile_centre", "beamdist"))
    placed = sigma_add(int_time_lookup(placed, fields, sbid=sbid, strict=False))
    # read several times from here on: bins, flags, outliers, blends
    placed = cut_lineage(placed)
    if placed.isEmpty():
        raise ValueError("no components found for this field")
    if not placed.where(F.col("int_time").isNull()).isEmpty():
        raise ValueError("some components have no integration time")

    out, envelope = add_flags(placed, leakage_degree, leakage_bins, leakage_snr, reference_compat)
    index = spectral_index("stokesI_model_coef", "stokesI_model_coef_err")
    out = out.withColumns({"spectral_index": index["alpha"], "spectral_index_err": index["alpha_err"]})
    lon, lat = to_galactic("ra", "dec")
    out = out.withColumns({"epoch": epoch_mid("start_time", "int_time"), "l": lon, "b": lat})
    out = pos_err(out)
    out = constant_columns(out, catalogue_name, sbid, field)
    out = out.withColumns(
        {
            "leakage": eval_poly("separation_tile_centre", envelope),
            "complex_flag": F.col("complex_sigma_add_flag") | F.col("complex_M2_CC_flag"),
        }
    )
    return to_jy(keep_metadata(base, inf_to_nan(out)))


def catalogue_checks(cat: DataFrame) -> DataFrame:
    """Rules every catalogue must meet, one row each with the number of offenders."""
    rules = {
        "single_component_blended": F.col("is_blended_flag") & (F.col("N_Gaus") == 1),
        "blend_count_without_flag": F.col("is_blended_flag") != (F.col("N_blended") > 0),
        "negative_error": finite("rm_err") & (F.col("rm_err") < 0),
        "position_outside_sphere": (F.col("ra") < 0) | (F.col("ra") >= 360) | (F.abs("dec") > 90),
    }
    totals = cat.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()])
    return totals.unpivot([], list(rules), "rule", "offenders")
