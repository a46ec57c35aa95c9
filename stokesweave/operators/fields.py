"""Selecting sources, fields and observations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stokesweave.functions.sky import lm_rotated, position_angle, sep_deg
from stokesweave.functions.text import short_field, strip_tile_suffix
from stokesweave.operators.keyed import latest_per_key, with_scalars


def in_field(beams: DataFrame, field: str, column: str = "beams") -> DataFrame:
    """Sources whose nested beam map has the field."""
    return beams.where(F.map_contains_key(column, F.lit(field)))


def with_sbid(beams: DataFrame, field: str, sbid: int, column: str = "beams") -> DataFrame:
    """Sources observed in the field by one scheduling block."""
    entry = F.try_element_at(F.col(column), F.lit(field))
    return beams.where(F.coalesce(F.array_contains(entry["sbids"], F.lit(sbid).cast("long")), F.lit(False)))


def in_field_rows(per_field: DataFrame, field: str, sbid: int | None = None, col: str = "field_name") -> DataFrame:
    """The same on the normalised (source, field) form."""
    rows = per_field.where(F.col(col) == field)
    return rows if sbid is None else rows.where(F.array_contains("sbids", F.lit(sbid).cast("long")))


def select_best(
    fields: DataFrame, wanted: DataFrame | Column, select: str = "sel", on: str = "field_name", strict: bool = False
) -> DataFrame:
    """Wanted fields with SELECT = 1, or those with SELECT = 0 when none has 1.

    The choice is one maximum over all wanted rows.  ``strict`` raises when
    nothing is found.
    """
    rows = fields.where(wanted) if isinstance(wanted, Column) else fields.join(wanted, on, "left_semi")
    rows = rows.where(F.col(select).isin(0, 1))
    best = with_scalars(rows, rows.agg(F.max(select).alias("_best")))
    out = best.where(F.col(select) == F.col("_best")).drop("_best")
    if strict and out.isEmpty():
        raise ValueError("no data for the wanted fields")
    return out


def validate_sbid_field(fields: DataFrame, field: str, sbid: int, sbid_col: str = "sbid", name_col: str = "field_name") -> bool:
    """Whether the scheduling block belongs to the field; unknown blocks raise."""
    row = fields.where(F.col(sbid_col) == sbid).select(name_col).limit(1).first()
    if row is None:
        raise ValueError(f"SBID {sbid} not found")
    return row[0] == field


def int_time_lookup(
    cat: DataFrame,
    fields: DataFrame,
    tile: str = "tile_id",
    sbid: int | None = None,
    field_col: str = "field_name",
    sbid_col: str = "sbid",
    tint: str = "scan_tint",
    select: str = "sel",
    strict: bool = True,
) -> DataFrame:
    """Adds ``int_time``: the field's scan time after keeping the highest SBID.

    The trailing pointing letter of the tile is ignored.  With an SBID its own
    field is used for all rows.  ``strict`` raises when a row finds no field.
    """
    named = cat.withColumn("_field", strip_tile_suffix(tile))
    if sbid is None:
        best = select_best(fields, named.select(F.col("_field").alias(field_col)).distinct(), select, field_col, strict)
    else:
        best = select_best(fields, F.col(sbid_col) == sbid, select, field_col, strict)
    latest = latest_per_key(best.select(field_col, sbid_col, tint), [field_col], [sbid_col, tint])
    if sbid is None:
        out = named.join(latest.select(F.col(field_col).alias("_field"), F.col(tint).alias("int_time")), "_field", "left")
    else:
        out = with_scalars(named, latest.agg(F.max(tint).alias("int_time")))
    out = out.drop("_field").select(*cat.columns, "int_time")
    if strict:
        missing = out.where(F.col("int_time").isNull()).limit(1).count()
        if missing:
            raise ValueError("some rows have no integration time")
    return out


def tile_separation(
    cat: DataFrame,
    fields: DataFrame,
    tile: str = "tile_id",
    pos=("ra", "dec"),
    field_col: str = "field_name",
    field_pos=("ra", "dec"),
    pol_axis: str = "pol_axis",
) -> DataFrame:
    """Separation, bearing and rotated (l, m) offsets from the field centre.

    Rows whose tile is not a known field keep NULL.  ``fields`` must hold one row
    per field name.
    """
    centres = fields.select(
        F.col(field_col).alias(tile),
        F.col(field_pos[0]).alias("_fra"),
        F.col(field_pos[1]).alias("_fdec"),
        F.col(pol_axis).alias("_pol"),
    )
    j = cat.join(centres, tile, "left")
    j = j.withColumns({"_sep": sep_deg("_fra", "_fdec", *pos), "_pa": position_angle("_fra", "_fdec", *pos)})
    l, m = lm_rotated("_sep", "_pa", "_pol")
    kept = [c for c in cat.columns if c not in ("separation_tile_centre", "l_tile_centre", "m_tile_centre")]
    return j.select(*kept, F.col("_sep").alias("separation_tile_centre"), l.alias("l_tile_centre"), m.alias("m_tile_centre"))


def channel_flag(cat: DataFrame, nchan: str = "Nchan", name: str = "channel_flag") -> DataFrame:
    """TRUE where a spectrum has fewer than half of the table's maximum channels."""
    top = with_scalars(cat, cat.agg(F.max(nchan).alias("_top")))
    return top.withColumn(name, F.col(nchan) < F.floor(F.col("_top") * 0.5)).drop("_top")


def pos_err(cat: DataFrame, ra_err: str = "ra_err", dec_err: str = "dec_err", per_row: bool = False) -> DataFrame:
    """Larger of the two position errors: the table's maximum, or per row."""
    larger = F.greatest(ra_err, dec_err)
    if per_row:
        return cat.withColumn("pos_err", larger)
    return with_scalars(cat, cat.agg(F.max(larger).alias("pos_err")))


def first_per_source(cat: DataFrame, columns: Sequence[str], source: str = "source_id", ident: str = "cat_id") -> DataFrame:
    """Values of each source's first component (lowest id)."""
    row = cat.groupBy(source).agg(F.min_by(F.struct(*columns), ident).alias("_r"))
    return row.select(source, "_r.*")


def latest_calibration(
    fields: DataFrame,
    leakage_files: DataFrame | None = None,
    cube_files: DataFrame | None = None,
    field_col: str = "field_name",
    cal: str = "cal_sbid",
    wanted_cubes: int = 216,
) -> DataFrame:
    """Row with the highest calibration block per field and its readiness.

    The file tables carry (field, cal_sbid) per file: a leakage product means
    calibrated, exactly ``wanted_cubes`` cube files mean imaged.
    """
    best = latest_per_key(fields, [field_col], [cal, "sbid"])
    on = [field_col, cal]
    for files, name in ((leakage_files, "_nl"), (cube_files, "_nc")):
        if files is None:
            best = best.withColumn(name, F.lit(0).cast("long"))
        else:
            best = best.join(files.groupBy(*on).agg(F.count(F.lit(1)).alias(name)), on, "left")
    return best.withColumns(
        {
            "leakage_ready": F.coalesce(F.col("_nl") > 0, F.lit(False)),
            "cubes_ready": F.coalesce(F.col("_nc") == wanted_cubes, F.lit(False)),
        }
    ).drop("_nl", "_nc")


def field_row(fields: DataFrame, name: str, cal: int, field_col: str = "FIELD_NAME", cal_col: str = "CAL_SBID") -> DataFrame:
    """Survey row of one short tile name and calibration block."""
    return fields.where((F.col(field_col) == short_field(F.lit(name))) & (F.col(cal_col) == cal))


# Science blocks of the first release, in order.
RELEASE_SBIDS = """
8570 8574 8576 8584 8589 8593 8674 12420 12422 12423 12425 12426 12427 12428 12429 12430 12431 12435 12493
12494 12496 12497 12500 12502 13587 13588 13589 13591 13595 13671 13672 13673 13678 13743 13746 13747 13749
"""
# The block holding the beam weights of each of them, in the same order.
WEIGHT_SBIDS = """
8247 8247 8247 8247 8247 8247 8669 11371 11371 11371 11371 11371 11371 11371 11371 11371 11371 11371 11371
11371 11371 11371 11371 11371 11371 11371 11371 11371 11371 13624 13624 13624 13624 13624 13624 13624 13624
"""


def weight_block(sbid: Column | str) -> Column:
    """Weight block of a science block; NULL outside the release."""
    pairs = zip(RELEASE_SBIDS.split(), WEIGHT_SBIDS.split())
    table = F.create_map(*[F.lit(int(v)) for pair in pairs for v in pair])
    return F.try_element_at(table, (F.col(sbid) if isinstance(sbid, str) else sbid).cast("int"))


# Tiles of the pilot area.
PILOT_TILES = """
1416+00A 1351+00A 1326+00A 1237+00A 1302+00A 1416-06A 1351-06A 1326-06A 1302-06A 1237-06A
1418-12A 1353-12A 1328-12A 1303-12A 1237-12A 1424-18A 1357-18A 1331-18A 1305-18A 1239-18A
1429-25A 1402-25A 1335-25A 1307-25A 1240-25A 1212+00A 1212-06A 1212-12A 1213-18A 1213-25A
"""


def pilot_fields() -> list[str]:
    return [f"RACS_{t}" for t in PILOT_TILES.split()]


def field_keys(fields: DataFrame, name: str, select: str = "SELECT") -> DataFrame:
    """Calibration, science and weight blocks of the selected rows of a tile."""
    rows = fields.where((F.col(select) == 1) & (F.col("FIELD_NAME") == short_field(F.lit(name))))
    return rows.select("FIELD_NAME", "CAL_SBID", "SBID", weight_block("SBID").alias("WEIGHT_SBID"))


def unique_tiles(cat: DataFrame, tile: str = "tile_id") -> DataFrame:
    return cat.select(tile).distinct()


def member_flag(df: DataFrame, members: DataFrame, on: str, name: str) -> DataFrame:
    """TRUE where the key is one of ``members``."""
    marked = members.select(on).distinct().withColumn(name, F.lit(True))
    return df.join(marked, on, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def fields_not_in(cat: DataFrame, wanted: DataFrame, tile: str = "tile_id") -> DataFrame:
    """Distinct tiles of the catalogue outside the wanted list."""
    return cat.select(tile).subtract(wanted.select(tile))


def components_of_islands(components: DataFrame, per_field: DataFrame, islands: DataFrame | None = None, source: str = "source_id") -> DataFrame:
    """Component rows beside their source's beam entry (and island row); beside its ``fields`` as one list if these are nested."""
    out = components.join(per_field, source)
    return out if islands is None else out.join(islands, source)


def component_or_island(
    components: DataFrame, islands: DataFrame, columns: Sequence[str], source: str = "source_id"
) -> DataFrame:
    """Value of the component, else of its island.

    The fallback answers an absent (NULL) value only; NaN is a value.  A column
    neither table has is an error.
    """
    lacking = [c for c in columns if c not in components.columns and c not in islands.columns]
    if lacking:
        raise ValueError(f"neither components nor islands have {lacking}")
    from_island = [c for c in columns if c in islands.columns]
    side = islands.select(source, *[F.col(c).alias(f"_isl_{c}") for c in from_island])
    joined = components.join(side, source, "left")
    rest = [c for c in components.columns if c not in columns]
    values = []
    for c in columns:
        options = [F.col(c)] if c in components.columns else []
        options += [F.col(f"_isl_{c}")] if c in from_island else []
        values.append(F.coalesce(*options).alias(c))
    return joined.select(*rest, *values)


def constant_columns(
    cat: DataFrame, catalogue_name: str | None, sbid: int | None = None, field: str | None = None
) -> DataFrame:
    """Columns that hold the same value in every row.

    In single-field mode the SBID, field and tile are overwritten too.
    """
    values: dict[str, Column] = {
        # Fixed values of the release's standard columns
        "rm_method": F.lit("RM Synthesis - Fractional polarization"),
        "telescope": F.lit("ASKAP"),
        "pol_bias": F.lit("2012PASA...29..214G"),
        "catalog": F.lit(catalogue_name).cast("string"),
        "ionosphere": F.lit("FRion"),
        "flux_type": F.lit("Peak"),
        "aperture": F.lit(0.0),
        "complex_test": F.lit("sigma_add OR Second moment"),
    }
    if sbid is not None:
        values.update({"sbid": F.lit(str(sbid)), "field_name": F.lit(field), "tile_id": F.lit(field)})
    return cat.withColumns(values)
