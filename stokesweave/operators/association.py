"""Sky association: radius joins, nearest matches, blends and source-beam grouping.

A radius predicate alone plans as a nested loop.  Both sides are therefore cut
into cells (declination zones times RA bins whose number shrinks towards the
poles), the left row is repeated for the few cells its circle can touch, the
join is an equi-join on the cell, and the exact separation filters the rest.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stokesweave.functions.numeric import as_col, finite, finite_or_null, ratio
from stokesweave.functions.sky import offset_by, position_angle, sep_deg, wrap180, wrap360
from stokesweave.functions.text import normalise_field_name
from stokesweave.operators import nearest
from stokesweave.operators.keyed import HOT_ROWS, in_ids, skew_join, with_scalars
from stokesweave.session import Stages, cut_lineage

PAD = 1e-9
ROW_BITS = 1 << 32
SMALL_GROUP = 32  # rows of a group whose pairs are formed without cells
LONGEST_LIST = 20_000  # pointings that meet the sources of a cell as one list
SLICE = 4096  # sources of a cell that meet its pointings as one list
PAIRS = 2_000_000  # pairs of the two lists that are looked at at once


def _zone_of(dec: Column, height: Column) -> Column:
    return F.floor((dec + 90.0) / height)


def _bins_in_zone(zone: Column, height: Column, width: Column) -> Column:
    """RA bins of a zone: as many as keep a bin at least ``width`` wide on the sky."""
    south = F.greatest(F.lit(-90.0), zone * height - 90.0)
    north = F.least(F.lit(90.0), (zone + 1) * height - 90.0)
    narrow = F.least(F.cos(F.radians(south)), F.cos(F.radians(north)))
    return F.greatest(F.lit(1), F.floor(F.lit(360.0) * narrow / width)).cast("long")


def _cell(zone: Column, ra_bin: Column) -> Column:
    return zone * ROW_BITS + ra_bin


def home_cell(ra, dec, size) -> Column:
    """The one cell that holds a position."""
    ra, dec, size = as_col(ra), as_col(dec), as_col(size)
    zone = _zone_of(dec, size)
    nb = _bins_in_zone(zone, size, size)
    ra_bin = F.least(F.floor(wrap360(ra) / 360.0 * nb), nb - 1)
    return _cell(zone, ra_bin)


def touched_cells(ra, dec, radius, size) -> Column:
    """Array of every cell a circle of ``radius`` around the position can touch."""
    ra, dec, radius, size = wrap360(as_col(ra)), as_col(dec), as_col(radius) + PAD, as_col(size)
    reach = F.abs(dec) + radius
    sin_half = F.sin(F.radians(radius)) / F.cos(F.radians(dec))
    half = F.when(reach >= 90.0, F.lit(180.0)).otherwise(
        F.degrees(F.asin(F.least(F.lit(1.0), sin_half))) + PAD
    )
    first = _zone_of(F.greatest(F.lit(-90.0), dec - radius), size)
    last = _zone_of(F.least(F.lit(90.0), dec + radius), size)

    def in_zone(zone: Column) -> Column:
        nb = _bins_in_zone(zone, size, size)
        lo = F.floor((ra - half) / 360.0 * nb)
        hi = F.floor((ra + half) / 360.0 * nb)
        # the whole ring once the circle spans it
        stop = F.least(hi, lo + nb - 1)
        return F.transform(F.sequence(lo, stop), lambda b: _cell(zone, F.pmod(b, nb)))

    return F.flatten(F.transform(F.sequence(first, last), in_zone))


def sky_radius_join(
    left: DataFrame,
    right: DataFrame,
    radius_deg: float,
    left_pos: tuple[str, str] = ("ra", "dec"),
    right_pos: tuple[str, str] = ("ra", "dec"),
    sep_name: str = "sep",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All pairs closer than ``radius_deg``, with their separation in degrees.

    Apart from the position columns the two inputs must not share column names.
    Position columns of the same name are returned as ``left_*`` and ``right_*``.
    Put the side with fewer rows on the left: it is the one repeated over cells.
    """
    renames_l = {c: f"left_{c}" for c in left_pos if c in right.columns}
    renames_r = {c: f"right_{c}" for c in right_pos if c in left.columns}
    left = left.withColumnsRenamed(renames_l)
    right = right.withColumnsRenamed(renames_r)
    shared = set(left.columns) & set(right.columns)
    if shared:
        raise ValueError(f"columns on both sides: {sorted(shared)}")
    lra, ldec = (renames_l.get(c, c) for c in left_pos)
    rra, rdec = (renames_r.get(c, c) for c in right_pos)

    size = F.lit(max(2.0 * radius_deg, 1e-4))
    probe = left.withColumn("_cell", F.explode(touched_cells(lra, ldec, F.lit(float(radius_deg)), size)))
    home = right.withColumn("_cell", home_cell(rra, rdec, size))
    pairs = skew_join(probe, home, ["_cell"], hot_rows=hot_rows)
    return pairs.withColumn(sep_name, sep_deg(lra, ldec, rra, rdec)).where(F.col(sep_name) < radius_deg).drop("_cell")


def sources_near(df: DataFrame, ra: float, dec: float, radius_deg: float, pos=("ra", "dec")) -> DataFrame:
    """Rows closer than a radius to one given position (a plain filter)."""
    band = F.col(pos[1]).between(dec - radius_deg, dec + radius_deg)
    return df.where(band).where(sep_deg(F.lit(float(ra)), F.lit(float(dec)), pos[0], pos[1]) < radius_deg)


def nearest_match(
    left: DataFrame,
    right: DataFrame,
    radius_deg: float,
    left_id: str,
    right_id: str,
    left_pos=("ra", "dec"),
    right_pos=("ra", "dec"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Nearest right row within a radius for each left row: ids and separation.

    Right rows at one position are reduced to the lowest id first, so a pile of
    copies costs a single candidate.  Ties take the lowest id.
    """
    spots = right.groupBy(*right_pos).agg(F.min(right_id).alias("_rid"))
    seeds = left.select(F.col(left_id).alias("_lid"), *left_pos)
    pairs = sky_radius_join(seeds, spots, radius_deg, left_pos, right_pos, "sep", hot_rows)
    best = pairs.groupBy("_lid").agg(F.min(F.struct("sep", "_rid")).alias("_b"))
    return best.select(
        F.col("_lid").alias(left_id), F.col("_b._rid").alias(right_id), F.col("_b.sep").alias("sep")
    )


def nearest_field(
    sources: DataFrame,
    fields: DataFrame,
    field_cols: Sequence[str],
    tie: str,
    source_pos=("ra", "dec"),
    field_pos=("ra", "dec"),
    prefix: str = "near_",
) -> DataFrame:
    """Nearest of any number of field centres for every source.

    The sky is cut into cells until few centres may be nearest to a place in a cell; a source then ranks the short list of its
    own cell.  Adds ``{prefix}{col}`` for each field column and ``{prefix}sep``.  Equal distances take the lowest ``tie``; sources or
    fields without a position take no part, and such sources get nulls.
    """
    names = list(dict.fromkeys([tie, *field_cols]))
    fra, fdec = field_pos
    placed = fields.where(finite(fra) & finite(fdec)).select(F.struct(*names).alias("_v"), F.col(fra).cast("double").alias("_ra"), F.col(fdec).cast("double").alias("_dec"))
    # centres at one position: the lowest stands for all
    centres = placed.groupBy("_ra", "_dec").agg(F.min("_v").alias("_v")).withColumns(nearest.unit_vector("_ra", "_dec"))
    stages = Stages()
    centres = stages.cut(centres)
    if centres.isEmpty():
        raise ValueError("no field centres")
    ra, dec = source_pos
    places = sources.where(finite(ra) & finite(dec)).select(*[c.alias(a) for a, c in nearest.unit_vector(ra, dec).items()])
    lists, depth = nearest.nearest_lists(stages, places, centres, F.struct(*nearest.AXES, "_ra", "_dec", "_v"))
    lo, side = nearest.SPHERE
    unit = {f"_s{a}": c for a, c in nearest.unit_vector(ra, dec).items()}
    cell = {f"_i{a}": nearest.cell_index(f"_s{a}", b, side, depth) for a, b in zip(nearest.AXES, lo)}
    lists = lists.select(*[F.col(f"i{a}").alias(f"_i{a}") for a in nearest.AXES], "near")
    joined = sources.withColumns(unit).withColumns(cell).join(lists, list(cell), "left")

    def chord(c: Column) -> Column:
        dx, dy, dz = c["x"] - F.col("_sx"), c["y"] - F.col("_sy"), c["z"] - F.col("_sz")
        return dx * dx + dy * dy + dz * dz

    # the squared chord ranks like the separation and needs no trigonometry per centre
    ranked = F.transform("near", lambda c: F.struct(chord(c).alias("_d"), *[c["_v"][n].alias(n) for n in names], c["_ra"].alias("_ra"), c["_dec"].alias("_dec")))
    out = joined.withColumn("_near", F.array_min(ranked))
    added = [F.col(f"_near.{n}").alias(f"{prefix}{n}") for n in field_cols]
    return out.select(*sources.columns, *added, sep_deg("_near._ra", "_near._dec", ra, dec).alias(f"{prefix}sep"))


def reassign_fields(
    catalogue: DataFrame,
    fields: DataFrame,
    wrong: Column,
    columns: dict[str, str],
    tie: str,
    field_pos=("ra", "dec"),
    sep_cols: Sequence[str] = ("separation_tile_centre",),
) -> DataFrame:
    """Move only the wrongly assigned sources to their nearest wanted field.

    ``columns`` maps catalogue columns to field columns (tile id, SBID, start).
    """
    near = nearest_field(catalogue, fields, list(columns.values()), tie, field_pos=field_pos, prefix="_near_")
    near = near.withColumn("_wrong", wrong)
    schema = {f.name: f.dataType for f in catalogue.schema.fields}
    swaps = {
        c: F.when(F.col("_wrong"), F.col(f"_near_{f}").cast(schema[c])).otherwise(F.col(c)) for c, f in columns.items()
    }
    swaps.update({c: F.when(F.col("_wrong"), F.col("_near_sep")).otherwise(F.col(c)) for c in sep_cols})
    return near.select([swaps[c].alias(c) if c in swaps else F.col(c) for c in catalogue.columns])


# --- blended components ------------------------------------------------------

DENSE = 2000


def blended_components(
    cat: DataFrame,
    source: str = "source_id",
    ident: str = "cat_id",
    pos: tuple[str, str] = ("ra", "dec"),
    flux: str = "total_i_flux",
    beam: str = "beam_maj",
    n_gaus: str | None = None,
    dense: int = DENSE,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Blend flag, neighbour count and flux ratio of every component.

    Neighbours are other components of the same source with 0 < separation <
    the source's largest beam.  Components at one position are not neighbours of
    each other.  One-Gaussian sources get FALSE, 0 and NaN.

    Identical positions are merged into one weighted position first.  Sources of
    up to ``dense`` components compare positions in touching beam-sized cells.
    Larger ones compare small cells instead of components wherever a pair of
    cells lies wholly inside or outside the beam.
    """
    ra, dec = pos
    # an unknown number of Gaussians is not one
    single = F.coalesce(F.max(F.col(n_gaus) == 1), F.lit(False)) if n_gaus else F.count(F.lit(1)) == 1
    info = cut_lineage(
        cat.groupBy(source).agg(
            F.max(finite_or_null(beam)).alias("_r"), single.alias("_single"), F.count(F.lit(1)).alias("_size")
        )
    )
    spots = (
        cat.groupBy(source, ra, dec)
        .agg(F.count(F.lit(1)).alias("_n"), F.coalesce(F.sum(finite_or_null(flux)), F.lit(0.0)).alias("_f"))
        .join(info.where(~F.col("_single")).drop("_single"), source)
    )
    near = _near_totals(spots.where(F.col("_size") <= dense), source, pos)
    if not info.where(F.col("_size") > dense).isEmpty():
        near = near.unionByName(_dense_near_totals(spots.where(F.col("_size") > dense), source, pos, hot_rows))
    out = cat.join(info.select(source, "_single"), source).join(near, [source, ra, dec], "left")
    n = F.coalesce("n_blended", F.lit(0)).cast("long")
    share = ratio(flux, F.col(flux) + F.coalesce("_near_flux", F.lit(0.0)))
    return out.select(
        *cat.columns,
        (n > 0).alias("is_blended_flag"),
        n.alias("n_blended"),
        F.when(F.col("_single"), F.lit(float("nan"))).otherwise(share).alias("blend_ratio"),
    )


def _near_totals(spots: DataFrame, source: str, pos: tuple[str, str]) -> DataFrame:
    """Neighbour count and flux per position; sources are bounded by the caller."""
    ra, dec = pos
    sized = spots.withColumn("_cell_size", F.greatest(2.0 * F.col("_r"), F.lit(1e-4)))
    probe = sized.select(source, ra, dec, "_r", F.explode(touched_cells(ra, dec, "_r", "_cell_size")).alias("_cell"))
    home = sized.select(
        source,
        home_cell(ra, dec, "_cell_size").alias("_cell"),
        F.col(ra).alias("_ra2"),
        F.col(dec).alias("_dec2"),
        F.col("_n").alias("_n2"),
        F.col("_f").alias("_f2"),
    )
    return (
        probe.join(home, [source, "_cell"])
        .withColumn("_sep", sep_deg(ra, dec, "_ra2", "_dec2"))
        .where((F.col("_sep") > 0) & (F.col("_sep") < F.col("_r")))
        .groupBy(source, ra, dec)
        .agg(F.sum("_n2").alias("n_blended"), F.sum("_f2").alias("_near_flux"))
    )


def _dense_near_totals(spots: DataFrame, source: str, pos: tuple[str, str], hot_rows: int | None) -> DataFrame:
    """The same for sources with very many positions.

    Positions fall into cells a fraction of the beam wide, and cells are compared
    by their centres and the reach of their members.  A pair of cells within the
    beam adds its totals once per cell; only pairs of cells that the beam's edge
    crosses are compared position by position.
    """
    ra, dec = pos
    parts = F.least(F.lit(256.0), F.greatest(F.lit(2.0), F.floor(F.pow(F.col("_size"), F.lit(0.4)) / 1.2)))
    fine = spots.withColumn("_w", F.greatest(F.col("_r") / parts, F.lit(1e-6)))
    zone = _zone_of(F.col(dec), F.col("_w"))
    fine = fine.withColumn("_z", zone)
    bins = _bins_in_zone(F.col("_z"), F.col("_w"), F.col("_w"))
    fine = fine.withColumn("_nb", bins).withColumn("_b", F.least(F.floor(wrap360(F.col(ra)) / 360.0 * F.col("_nb")), F.col("_nb") - 1))
    fine = fine.withColumns({"_cra": (F.col("_b") + 0.5) * 360.0 / F.col("_nb"), "_cdec": (F.col("_z") + 0.5) * F.col("_w") - 90.0})
    fine = fine.withColumn("_h", sep_deg(ra, F.col(dec), "_cra", "_cdec"))
    cell = [source, "_z", "_b"]
    cells = fine.groupBy(*cell, "_r", "_w", "_cra", "_cdec").agg(
        F.sum("_n").alias("_cn"), F.sum("_f").alias("_cf"), F.max("_h").alias("_h")
    )
    reach = F.col("_r") + 4.0 * F.col("_w")
    size = F.greatest(2.0 * reach, F.lit(1e-4))
    probe = cells.select(*cell, "_r", "_cra", "_cdec", "_h", F.explode(touched_cells("_cra", "_cdec", reach, size)).alias("_cell"))
    home = cells.select(
        source,
        home_cell("_cra", "_cdec", size).alias("_cell"),
        *[F.col(c).alias(f"{c}2") for c in ("_z", "_b", "_cra", "_cdec", "_h", "_cn", "_cf")],
    )
    met = skew_join(probe, home, [source, "_cell"], hot_rows=hot_rows).withColumn(
        "_sep", sep_deg("_cra", "_cdec", "_cra2", "_cdec2")
    )
    slack = F.col("_h") + F.col("_h2")
    within = F.col("_sep") + slack < F.col("_r") - PAD
    apart = F.col("_sep") - slack > F.col("_r") + PAD
    own = (F.col("_z") == F.col("_z2")) & (F.col("_b") == F.col("_b2"))
    inside = met.where(within).groupBy(*cell).agg(
        F.sum("_cn2").alias("_in_n"), F.sum("_cf2").alias("_in_f"), F.max(own).alias("_own")
    )
    # a cell that lies within the beam of itself has counted each of its positions once too often
    whole = fine.join(inside, cell).select(
        source,
        ra,
        dec,
        (F.col("_in_n") - F.when(F.col("_own"), F.col("_n")).otherwise(0)).alias("_n2"),
        (F.col("_in_f") - F.when(F.col("_own"), F.col("_f")).otherwise(0.0)).alias("_f2"),
    )
    edge = met.where(~within & ~apart).select(*cell, "_z2", "_b2")
    mates = fine.select(
        source, F.col("_z").alias("_z2"), F.col("_b").alias("_b2"), F.col(ra).alias("_ra2"), F.col(dec).alias("_dec2"),
        F.col("_n").alias("_n2"), F.col("_f").alias("_f2"),
    )
    asking = fine.select(*cell, ra, dec, "_r").join(edge, cell).drop("_z", "_b")
    crossed = (
        skew_join(asking, mates, [source, "_z2", "_b2"], hot_rows=hot_rows)
        .withColumn("_sep", sep_deg(ra, dec, "_ra2", "_dec2"))
        .where((F.col("_sep") > 0) & (F.col("_sep") < F.col("_r")))
        .select(source, ra, dec, "_n2", "_f2")
    )
    totals = whole.unionByName(crossed).groupBy(source, ra, dec)
    return totals.agg(F.sum("_n2").alias("n_blended"), F.sum("_f2").alias("_near_flux"))


def close_pairs(
    df: DataFrame,
    group: str,
    ident: str,
    radius_deg: float,
    pos=("ra", "dec"),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Unordered pairs (first < second) of one group within a radius.

    Groups of up to ``SMALL_GROUP`` rows meet as they are. In larger ones pairs are only ever formed between
    touching cells, never over a whole group.  The columns are written once, as all steps read them.
    Rows without a finite position have no pairs and would touch every cell.
    """
    base = cut_lineage(df.select(group, ident, *pos).where(finite(pos[0]) & finite(pos[1])))
    sizes = base.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    large = cut_lineage(sizes.where(F.col("_n") > SMALL_GROUP).select(group))

    def second(rows: DataFrame, *keys: Column) -> DataFrame:
        return rows.select(group, *keys, *[F.col(c).alias(f"{c}_2") for c in (ident, *pos)])

    none = large.isEmpty()
    small = base if none else base.join(large, group, "left_anti")
    ordered = F.col(ident) < F.col(f"{ident}_2")
    pairs = small.join(second(small), group).where(ordered)
    if not none:
        size = F.lit(max(2.0 * radius_deg, 1e-4))
        rest = base.join(large, group, "left_semi")
        probe = rest.withColumn("_cell", F.explode(touched_cells(*pos, F.lit(float(radius_deg)), size)))
        home = second(rest, home_cell(*pos, size).alias("_cell"))
        pairs = pairs.unionByName(skew_join(probe, home, [group, "_cell"], ordered, hot_rows).drop("_cell"))
    sep = sep_deg(*pos, *[f"{c}_2" for c in pos])
    return pairs.withColumn("sep", sep).where(F.col("sep") < radius_deg).select(group, ident, f"{ident}_2", "sep")


# --- extent of a source ------------------------------------------------------


def widest_pair(points: DataFrame, source: str = "source_id", pos=("ra", "dec")) -> DataFrame:
    """Eastern (left) and western (right) end of every source on its longest
    declination boundary: one row per source.

    On one declination circle separation grows with the RA difference, so the
    widest pair is the pair of extreme RA offsets from any member.  That makes
    it two aggregates; no pairs are formed.  A source that does not fit into
    half a circle (it surrounds a pole) gets ``wraps`` and the pair closest to
    opposite.
    """
    ra, dec = pos
    anchor = points.groupBy(source).agg(
        F.min_by(ra, F.struct(ra, dec)).alias("_ra0"), F.min(dec).alias("dec_min"), F.max(dec).alias("dec_max")
    )
    offset = wrap180(F.col(ra) - F.col("_ra0"))
    ends = (
        points.join(anchor, source)
        .groupBy(source, "_ra0", "dec_min", "dec_max")
        .agg(F.min(offset).alias("_west"), F.max(offset).alias("_east"))
    )
    boundary = F.when(F.abs("dec_max") > F.abs("dec_min"), F.col("dec_min")).otherwise(F.col("dec_max"))
    ends = cut_lineage(
        ends.select(
            source,
            wrap360(F.col("_ra0") + F.col("_east")).alias("ra_left"),
            wrap360(F.col("_ra0") + F.col("_west")).alias("ra_right"),
            boundary.alias("dec_boundary"),
            "dec_min",
            "dec_max",
            (F.col("_east") - F.col("_west") >= 180.0).alias("wraps"),
        )
    )
    around = ends.where("wraps")
    if not around.isEmpty():
        opposite = _most_opposite(in_ids(points, around, source).select(source, wrap360(F.col(ra)).alias("_ra")), source)
        turned = position_angle("_ra", "dec_boundary", "_far", "dec_boundary") > 180.0
        swapped = around.join(opposite, source).withColumns(
            {
                "ra_left": F.when(turned, F.col("_ra")).otherwise(F.col("_far")),
                "ra_right": F.when(turned, F.col("_far")).otherwise(F.col("_ra")),
            }
        )
        ends = ends.where("not wraps").unionByName(swapped.select(ends.columns))
    return ends.withColumn("sep", sep_deg("ra_left", "dec_boundary", "ra_right", "dec_boundary"))


def _most_opposite(points: DataFrame, source: str) -> DataFrame:
    """Per source the two right ascensions closest to 180 degrees apart.

    Every RA looks for the nearest RA to its antipode.  The search runs inside
    one-degree bins; what lies outside a bin is carried in from a table of at
    most 360 bins per source, so no task sorts a whole source.
    """
    spots = points.distinct()
    seeds = spots.select(source, F.col("_ra").alias("_at"), F.col("_ra").alias("_point"), F.lit(None).cast("double").alias("_from"))
    asks = spots.select(
        source, wrap360(F.col("_ra") + 180.0).alias("_at"), F.lit(None).cast("double").alias("_point"), F.col("_ra").alias("_from")
    )
    rows = seeds.unionByName(asks).withColumn("_bin", F.floor("_at"))
    bins = rows.groupBy(source, "_bin").agg(F.min("_point").alias("_lo"), F.max("_point").alias("_hi"))
    ring = Window.partitionBy(source).orderBy("_bin")
    whole = Window.partitionBy(source)
    before = F.last("_hi", ignorenulls=True).over(ring.rowsBetween(Window.unboundedPreceding, -1))
    after = F.first("_lo", ignorenulls=True).over(ring.rowsBetween(1, Window.unboundedFollowing))
    carried = bins.select(
        source,
        "_bin",
        F.coalesce(before, F.max("_hi").over(whole)).alias("_before"),
        F.coalesce(after, F.min("_lo").over(whole)).alias("_after"),
    )
    inner = Window.partitionBy(source, "_bin").orderBy("_at")
    below = F.last("_point", ignorenulls=True).over(inner.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    above = F.first("_point", ignorenulls=True).over(inner.rangeBetween(Window.currentRow, Window.unboundedFollowing))
    found = (
        rows.withColumns({"_below": below, "_above": above})
        .where(F.col("_from").isNotNull())
        .join(carried, [source, "_bin"])
        .select(
            source,
            "_from",
            F.explode(F.array(F.coalesce("_below", "_before"), F.coalesce("_above", "_after"))).alias("_far"),
        )
    )
    apart = F.abs(wrap180(F.col("_far") - F.col("_from")))
    best = found.groupBy(source).agg(
        F.max_by(F.struct("_from", "_far"), F.struct(apart, -F.col("_from"), -F.col("_far"))).alias("_p")
    )
    return best.select(source, F.col("_p._from").alias("_ra"), F.col("_p._far").alias("_far"))


def source_box(
    components: DataFrame, source: str = "source_id", pos=("ra", "dec"), maj_arcsec: str = "maj"
) -> DataFrame:
    """Padded cutout box of every source: dec_low, dec_high, ra_left, ra_right.

    Corners move out diagonally by the largest major axis times sqrt(2).  A
    source without components has no row.
    """
    ends = widest_pair(components, source, pos)
    pads = components.groupBy(source).agg((F.max(maj_arcsec) / 3600.0 * F.sqrt(F.lit(2.0))).alias("_pad"))
    box = ends.join(pads, source)
    corner = {}
    for name, ra, dec, pa in (
        ("top_right", "ra_right", "dec_max", -45.0),
        ("bottom_left", "ra_left", "dec_min", 135.0),
        ("top_left", "ra_left", "dec_max", 45.0),
        ("bottom_right", "ra_right", "dec_min", -135.0),
    ):
        corner[name] = offset_by(ra, dec, F.lit(pa), "_pad")
    return box.select(
        source,
        F.least(corner["bottom_left"][1], corner["bottom_right"][1]).alias("dec_low"),
        F.greatest(corner["top_left"][1], corner["top_right"][1]).alias("dec_high"),
        corner["top_left"][0].alias("ra_left"),
        corner["top_right"][0].alias("ra_right"),
    )


# --- source, beam, field grouping -------------------------------------------


def beam_pairs(
    islands: DataFrame,
    pointings: DataFrame,
    radius_deg: float = 1.0,
    hot_rows: int | None = HOT_ROWS,
    nested: bool = False,
    source: str = "source_id",
    longest: int = LONGEST_LIST,
    epoch: int | None = None,
    tiles: DataFrame | None = None,
    tile_col: str = "tile_id",
) -> DataFrame:
    """(source, beam pointing) pairs within a radius; columns of both tables.

    ``nested`` gives one row per source instead, with the beams and blocks of its fields: ``source, pointings``.  The sources of a cell and the
    pointings that may touch it then meet as two lists, so no pair is a row and none is shuffled.  Sources that have several rows, and those in
    cells with more than ``longest`` pointings, take the way over pairs.  With an ``epoch`` fields go by their normalised names, which are
    made once per pointing and not once per source: ``source, named``; so does the DR1 flag of the fields where ``tiles`` are given too.
    """
    if not nested:
        return sky_radius_join(pointings, islands, radius_deg, hot_rows=hot_rows)
    listed, told = "pointings", ["beam_num", "sbid"]
    if epoch is not None:
        listed, pointings = "named", pointings.withColumn("field_name", normalise_field_name("field_name", epoch))
        if tiles is not None:
            told, pointings = [*told, "dr1"], _with_dr1(pointings, _known_fields(tiles, epoch, tile_col))
    size = F.lit(max(0.5 * radius_deg, 1e-4))
    rows = cut_lineage(islands.select(source, "ra", "dec")).withColumn("_cell", home_cell("ra", "dec", size))
    reached = pointings.withColumn("_cell", F.explode(touched_cells("ra", "dec", F.lit(float(radius_deg)), size)))
    again = cut_lineage(rows.groupBy(source).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col(source).alias("_again")))
    hot = cut_lineage(reached.groupBy("_cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > longest).select("_cell"))
    apart = []
    if not again.isEmpty():
        same = F.col(source).eqNullSafe(F.col("_again"))
        apart.append(rows.join(again, same, "left_semi"))
        rows = rows.join(again, same, "left_anti")
    if not hot.isEmpty():
        apart.append(rows.join(hot, "_cell", "left_semi").select(source, "ra", "dec", "_cell"))
        rows = rows.join(hot, "_cell", "left_anti")
        reached = reached.join(hot, "_cell", "left_anti")
    place = [F.col(c).cast("double").alias(c) for c in ("ra", "dec")]
    beams = F.sort_array(F.collect_list(F.struct("field_name", *told, *place)))
    lists = reached.groupBy("_cell").agg(beams.alias("_beams"))
    # a list of sources is short whatever their number
    slices = rows.groupBy("_cell").agg(F.ceil(F.count(F.lit(1)) / SLICE).alias("_slices"))
    own = rows.join(slices, "_cell").withColumn("_slice", F.pmod(F.xxhash64(source), F.col("_slices")))
    own = own.groupBy("_cell", "_slice").agg(F.collect_list(F.struct(source, *place)).alias("_sources"))
    kinds = {f.name: f.dataType.simpleString() for f in [islands.schema[source], *pointings.schema.fields]}
    element = f"array<struct<field_name: {kinds['field_name']}, beam_list: array<{kinds['beam_num']}>, sbids: array<{kinds['sbid']}>{', dr1: boolean' if 'dr1' in told else ''}>>"
    out = own.join(lists, "_cell").select("_sources", "_beams").mapInArrow(_meet_lists(radius_deg), f"`{source}` {kinds[source]}, {listed} {element}")
    for part in apart:
        pairs = sky_radius_join(pointings, part.select(source, "ra", "dec"), radius_deg, hot_rows=hot_rows)
        flag = [F.max("dr1").alias("dr1")] if "dr1" in told else []
        by_field = pairs.groupBy(source, "field_name").agg(*_beam_lists(), *flag)
        entry = F.struct(*[c for c in by_field.columns if c != source])
        out = out.unionByName(by_field.groupBy(source).agg(F.sort_array(F.collect_list(entry)).alias(listed)))
    return out


def _beam_lists() -> list[Column]:
    return [F.sort_array(F.collect_list("beam_num")).alias("beam_list"), F.sort_array(F.collect_set("sbid")).alias("sbids")]


def _known_fields(tiles: DataFrame, epoch: int, tile_col: str) -> DataFrame:
    return tiles.select(normalise_field_name(tile_col, epoch).alias("field_name")).distinct()


def _with_dr1(rows: DataFrame, known: DataFrame) -> DataFrame:
    flagged = known.withColumn("_known", F.lit(True))
    return rows.join(flagged, "field_name", "left").withColumn("dr1", F.coalesce("_known", F.lit(False))).drop("_known")


def _unit_vectors(ra: np.ndarray, dec: np.ndarray) -> np.ndarray:
    a, d = np.radians(ra), np.radians(dec)
    return np.stack([np.cos(d) * np.cos(a), np.cos(d) * np.sin(a), np.sin(d)], axis=1)


def _separations(ra1: np.ndarray, dec1: np.ndarray, ra2: np.ndarray, dec2: np.ndarray) -> np.ndarray:
    """As ``sep_deg``."""
    half_dec, half_ra = np.sin(np.radians(dec2 - dec1) / 2.0), np.sin(np.radians(ra2 - ra1) / 2.0)
    hav = half_dec * half_dec + np.cos(np.radians(dec1)) * np.cos(np.radians(dec2)) * half_ra * half_ra
    return np.degrees(2.0 * np.arcsin(np.sqrt(np.minimum(1.0, hav))))


def _meet_lists(radius_deg: float):
    """Sources of a list of sources with what they meet of a list of pointings, which is in order of field, beam and block."""
    limit = math.cos(math.radians(radius_deg))

    def within(lists: tuple, own: slice) -> np.ndarray:
        ra, dec, vectors, beam_ra, beam_dec, beam_vectors = lists
        cosine = vectors[own] @ beam_vectors.T
        met = cosine > limit + PAD
        # the cosine of the separation settles all pairs but those next to the radius
        i, j = np.nonzero((cosine > limit - PAD) & ~met)
        met[i, j] = _separations(beam_ra[j], beam_dec[j], ra[own][i], dec[own][i]) < radius_deg
        return met

    def meet(sources: pa.StructArray, beams: pa.StructArray) -> Iterator[list[pa.Array]]:
        ids, *own = sources.flatten()
        names = [f.name for f in beams.type]
        part = dict(zip(names, beams.flatten()))
        ra, dec, beam_ra, beam_dec = (np.asarray(c.to_numpy(zero_copy_only=False), dtype=float) for c in (*own, part["ra"], part["dec"]))
        lists = (ra, dec, _unit_vectors(ra, dec), beam_ra, beam_dec, _unit_vectors(beam_ra, beam_dec))
        fields = part["field_name"].dictionary_encode(null_encoding="encode")
        field, n_fields = fields.indices.to_numpy(), len(fields.dictionary)
        first = np.searchsorted(field, np.arange(n_fields))  # a pointing of each field
        blocks = part["sbid"].dictionary_encode()
        n_blocks = len(blocks.dictionary)
        rank = np.argsort(pc.sort_indices(blocks.dictionary).to_numpy())
        has_beam, has_block = (np.asarray(part[c].is_valid()) for c in ("beam_num", "sbid"))
        block = rank[blocks.indices.fill_null(0).to_numpy()] if n_blocks else np.zeros(len(field), np.int64)
        in_order = blocks.dictionary.take(pc.sort_indices(blocks.dictionary))
        codes, code = np.unique(field * max(n_blocks, 1) + block, return_inverse=True)  # fields with their blocks, in order
        step = max(1, PAIRS // max(1, len(field)))
        for at in range(0, len(ids), step):
            met = within(lists, slice(at, at + step))
            some = np.nonzero(met.any(axis=1))[0]
            i, j = np.nonzero(met[some])
            shape = (len(some), n_fields)

            def count(rows: np.ndarray, of: np.ndarray) -> np.ndarray:
                return np.bincount(rows * n_fields + of, minlength=shape[0] * n_fields).reshape(shape)

            where, which = np.nonzero(count(i, field[j]))
            known = has_beam[j]
            beam_list = pa.ListArray.from_arrays(_offsets(count(i[known], field[j[known]])[where, which]), part["beam_num"].take(pa.array(j[known])))
            known = has_block[j]
            met_codes = np.bincount(i[known] * len(codes) + code[j[known]], minlength=shape[0] * len(codes)).reshape(shape[0], len(codes))
            rows, c = np.nonzero(met_codes)
            of_field, of_block = np.divmod(codes[c], max(n_blocks, 1))
            sbids = pa.ListArray.from_arrays(_offsets(count(rows, of_field)[where, which]), in_order.take(pa.array(of_block)))
            entry = {"field_name": fields.dictionary.take(pa.array(which)), "beam_list": beam_list, "sbids": sbids}
            if "dr1" in part:
                entry["dr1"] = part["dr1"].take(pa.array(first[which]))
            entries = pa.StructArray.from_arrays([*entry.values()], names=[*entry])
            yield [ids.take(pa.array(at + some)), pa.ListArray.from_arrays(_offsets(np.bincount(where, minlength=len(some))), entries)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for columns in meet(batch.column(0)[k].values, batch.column(1)[k].values):
                    if len(columns[0]):
                        yield pa.RecordBatch.from_arrays(columns, names=["source", "fields"])

    return run


def _offsets(lengths: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))


def source_fields(
    pairs: DataFrame, tiles: DataFrame, epoch: int = 0, source: str = "source_id", tile_col: str = "tile_id"
) -> DataFrame:
    """One row per (source, field): beam list, distinct SBIDs and the DR1 flag.

    This is the normalised storage form.  ``tiles`` lists the catalogue's tiles.  Nested pairs give one row
    per source, with these rows in ``fields``, under the epoch they were named for, if any; ``field_rows`` takes them out.
    """
    known = _known_fields(tiles, epoch, tile_col)
    if "pointings" in pairs.columns or "named" in pairs.columns:
        return _nested_fields(pairs, known, epoch, source)
    grouped = (
        pairs.withColumn("field_name", normalise_field_name("field_name", epoch))
        .groupBy(source, "field_name")
        .agg(*_beam_lists())
    )
    return _with_dr1(grouped, known).select(source, "field_name", "beam_list", "sbids", "dr1")


def _nested_fields(pairs: DataFrame, known: DataFrame, epoch: int, source: str) -> DataFrame:
    """``source, fields`` of nested pairs, row by row; the known tiles are one list, unless the pairs have the flag."""
    if "named" in pairs.columns and "dr1" in pairs.schema["named"].dataType.elementType.names:
        return pairs.select(source, F.col("named").alias("fields"))
    rows = with_scalars(pairs, known.agg(F.collect_set("field_name").alias("_known")))
    if "pointings" in rows.columns:
        rows = _merged_by_name(rows, epoch)

    def entry(f: Column) -> Column:
        return F.struct(
            *[f[c].alias(c) for c in ("field_name", "beam_list", "sbids")],
            F.coalesce(F.array_contains("_known", f["field_name"]), F.lit(False)).alias("dr1"),
        )

    return rows.select(source, F.transform("named", entry).alias("fields"))


def _members(entries: Column, name: str) -> Column:
    return F.transform(entries, lambda f: f[name])


def _merged_by_name(rows: DataFrame, epoch: int) -> DataFrame:
    """``named``: the pointings by the normalised names of their fields."""
    lists = ("beam_list", "sbids")
    named = F.transform("pointings", lambda f: F.struct(normalise_field_name(f["field_name"], epoch).alias("field_name"), *[f[c].alias(c) for c in lists]))
    rows = rows.withColumn("_named", named)

    def all_of(name: Column) -> Column:
        same = F.filter("_named", lambda f: f["field_name"].eqNullSafe(name))
        beams, sbids = (F.flatten(_members(same, c)) for c in lists)
        return F.struct(name.alias("field_name"), F.sort_array(beams).alias("beam_list"), F.sort_array(F.array_distinct(sbids)).alias("sbids"))

    # names that differ in their epoch's infix alone are one field
    merged = F.transform(F.array_distinct(F.transform("_named", lambda f: f["field_name"])), all_of)
    return rows.withColumn("named", F.when(F.size("_named") == F.size(F.array_distinct(F.transform("_named", lambda f: f["field_name"]))), F.col("_named")).otherwise(merged))


def field_rows(per_field: DataFrame, source: str = "source_id") -> DataFrame:
    """One row per (source, field) of the nested form, beside what else a row has."""
    rest = [c for c in per_field.columns if c not in (source, "fields")]
    # ``explode`` would work the list out twice, once to filter empty ones
    return per_field.select(source, *rest, F.explode_outer("fields").alias("_f")).where("_f is not null").select(source, *rest, "_f.*")


def source_beams(per_field: DataFrame, source: str = "source_id") -> DataFrame:
    """Nested form: one row per source with a map field -> struct and counts."""
    if "fields" in per_field.columns:
        inner = F.transform("fields", lambda f: F.struct(f["field_name"].alias("field_name"), F.struct(*[f[c].alias(c) for c in ("beam_list", "sbids", "dr1")])))
        return per_field.select(
            source,
            F.size("fields").cast("long").alias("n_fields"),
            F.size(F.filter("fields", lambda f: f["dr1"])).cast("long").alias("n_fields_dr1"),
            F.map_from_entries(F.sort_array(inner)).alias("beams"),
        )
    entry = F.struct("beam_list", "sbids", "dr1")
    return per_field.groupBy(source).agg(
        F.count(F.lit(1)).alias("n_fields"),
        F.count_if("dr1").alias("n_fields_dr1"),
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("field_name", entry)))).alias("beams"),
    )


def split_by_field_count(per_field: DataFrame, wanted: Sequence[str], source: str = "source_id") -> DataFrame:
    """Sources of the wanted DR1 fields, labelled single or multiple by the
    number of DR1 fields they have overall."""
    if "fields" in per_field.columns:
        counts = per_field.select(
            source,
            F.size(F.filter("fields", lambda f: f["dr1"])).cast("long").alias("n_fields_dr1"),
            F.exists("fields", lambda f: f["dr1"] & f["field_name"].isin(list(wanted))).alias("_wanted"),
        )
    else:
        counts = per_field.groupBy(source).agg(
            F.count_if("dr1").alias("n_fields_dr1"),
            F.max(F.col("dr1") & F.col("field_name").isin(list(wanted))).alias("_wanted"),
        )
    return counts.where("_wanted").select(
        source, "n_fields_dr1", F.when(F.col("n_fields_dr1") == 1, "single").otherwise("multiple").alias("kind")
    )
