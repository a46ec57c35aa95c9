"""Repairs of released catalogues: wrong fields and inconsistent sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.sky import sep_deg
from stokesweave.functions.spectral import eval_poly, good_rm, leakage_flag
from stokesweave.operators.association import reassign_fields
from stokesweave.operators.fields import first_per_source
from stokesweave.operators.keyed import in_ids
from stokesweave.operators.leakage import fit_envelope
from stokesweave.operators.outliers import local_outliers
from stokesweave.session import cut_lineage
from stokesweave.sources.schema import keep_metadata, to_jy
from stokesweave.sources.tables import rename_reserved


def repair_fields(
    cat: DataFrame, fields: DataFrame, wanted: Sequence[str], nbins: int = 16, degree: int = 4
) -> tuple[DataFrame, list[float]]:
    """Move sources of unwanted tiles to the nearest wanted field and redo what
    depends on it: units, leakage envelope and flag, local outliers.

    ``fields`` has ``field_name, sbid, sel, ra, dec, scan_start`` (seconds).
    """
    usable = fields.where((F.col("sel") == 1) & F.col("field_name").isin(list(wanted))).withColumn(
        "start_time", F.col("scan_start") / 86400.0
    )
    moved = reassign_fields(
        cat,
        usable,
        ~F.col("tile_id").isin(list(wanted)),
        {"tile_id": "field_name", "sbid": "sbid", "start_time": "start_time"},
        "field_name",
        sep_cols=("separation_tile_centre", "beamdist"),
    )
    moved = cut_lineage(to_jy(keep_metadata(cat, moved)))
    envelope = fit_envelope(moved, nbins, degree)
    flagged = moved.withColumns(
        {
            "leakage_flag": leakage_flag("fracpol", eval_poly("beamdist", envelope)),
            "leakage": eval_poly("separation_tile_centre", envelope),
        }
    )
    marked = flagged.drop("local_rm_flag").withColumn("_good", F.coalesce(good_rm()["good_rm"], F.lit(False)))
    return keep_metadata(moved, local_outliers(marked, "_good").drop("_good")), envelope


def repair_sources(sources: DataFrame, cat: DataFrame, fields: DataFrame) -> DataFrame:
    """Sources of the catalogue with SBID, start and tile of their first
    component, new tile separations and unreserved column names."""
    first = first_per_source(cat, ["sbid", "start_time", "tile_id"]).select(
        F.col("source_id").alias("Source_ID"),
        F.col("sbid").alias("_sbid"),
        F.col("start_time").alias("_start"),
        F.col("tile_id").alias("_tile"),
    )
    kept = in_ids(sources, first.select("Source_ID"), "Source_ID").join(first, "Source_ID")
    centres = fields.where(F.col("sel") == 1).select(
        F.col("field_name").alias("_tile"), F.col("ra").alias("_fra"), F.col("dec").alias("_fdec")
    )
    joined = kept.join(centres, "_tile", "left")
    new = {
        "SBID": F.col("_sbid"),
        "Obs_Start_Time": F.col("_start"),
        "Tile_ID": F.col("_tile"),
        "Separation_Tile_Centre": F.coalesce(sep_deg("RA", "Dec", "_fra", "_fdec"), "Separation_Tile_Centre"),
    }
    types = {f.name: f.dataType for f in sources.schema.fields}
    out = joined.select([new[c].cast(types[c]).alias(c) if c in new else F.col(c) for c in sources.columns])
    return rename_reserved(keep_metadata(sources, out))
