"""Names, identifiers and path rewrites."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stokesweave.functions.numeric import as_col

# Fixed name parts of the survey's file and field naming.
TEST_FIELD_INFIX = "_test4_1.05_"
IMAGE_INFIX = ".image.restored."
WEIGHT_INFIX = ".weights."


def normalise_field_name(field, epoch: int | Column) -> Column:
    """Epoch 0 fields carry a test infix that catalogues do not use."""
    field = as_col(field)
    clean = F.replace(field, F.lit(TEST_FIELD_INFIX), F.lit("_"))
    if isinstance(epoch, Column):
        return F.when(epoch == 0, clean).otherwise(field)
    return clean if epoch == 0 else field


def strip_tile_suffix(tile) -> Column:
    """Drop one trailing pointing letter (A or B)."""
    return F.regexp_replace(as_col(tile), "[AB]$", "")


def save_name(field, sbid=None) -> Column:
    """``field`` or ``field_sbid``; a NULL SBID is skipped."""
    if sbid is None:
        return as_col(field)
    sbid = sbid if isinstance(sbid, (str, Column)) else F.lit(sbid)
    return F.concat_ws("_", as_col(field), as_col(sbid).cast("string"))


def short_name(path) -> Column:
    """``parent/name`` of a path."""
    parts = F.split(as_col(path), "/")
    return F.concat_ws("/", F.try_element_at(parts, F.lit(-2)), F.try_element_at(parts, F.lit(-1)))


def weight_path(path) -> Column:
    """Weight image that belongs to a restored image (ionosphere tag removed)."""
    return F.replace(F.replace(as_col(path), F.lit(IMAGE_INFIX), F.lit(WEIGHT_INFIX)), F.lit(".ion"), F.lit(""))


def corrected_path(path) -> Column:
    """Name of the ionosphere-corrected copy."""
    return F.replace(as_col(path), F.lit(".fits"), F.lit(".ion.fits"))


def cutout_name(source_id, image_path) -> Column:
    """``{source}.cutout.{image file name}``."""
    return F.concat(as_col(source_id), F.lit(".cutout."), F.try_element_at(F.split(as_col(image_path), "/"), F.lit(-1)))


def id_before(name, marker: str) -> Column:
    """Identifier part of a file name, up to a marker such as ``.cutout``."""
    base = F.try_element_at(F.split(as_col(name), "/"), F.lit(-1))
    return F.when(F.instr(base, marker) > 0, F.substring_index(base, marker, 1))


def short_field(name) -> Column:
    """Survey prefix plus the short tile name."""
    return F.concat(F.lit("RACS_"), as_col(name))
