"""Combining the cubes of overlapping fields."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.operators.association import split_by_field_count
from stokesweave.operators.pixels import coadd
from stokesweave.sources.tables import upsert

PIXEL_KEYS = ("source_id", "stokes", "chan", "y", "x")


def merge_fields(
    pixels: DataFrame, per_field: DataFrame, wanted: Sequence[str], merge_name: str
) -> tuple[DataFrame, DataFrame]:
    """Merged cubes and the updated (source, field) table.

    Sources covered by one DR1 field keep their pixels; sources in several get
    the weighted mosaic of the wanted fields.  ``pixels`` carries
    ``field_name, value, weight`` beside the pixel keys.
    """
    kinds = split_by_field_count(per_field, wanted)
    chosen = pixels.where(F.col("field_name").isin(list(wanted)))
    labelled = chosen.join(kinds.select("source_id", "kind"), "source_id")
    single = labelled.where(F.col("kind") == "single").select(*PIXEL_KEYS, "value", "weight")
    multiple = coadd(labelled.where(F.col("kind") == "multiple"), PIXEL_KEYS)
    merged = single.unionByName(multiple).withColumn("field_name", F.lit(merge_name))

    entries = (
        per_field.where(F.col("field_name").isin(list(wanted)))
        .join(kinds.select("source_id"), "source_id")
        .groupBy("source_id")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("beam_list")))).alias("beam_list"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("sbids")))).alias("sbids"),
        )
        .withColumns({"field_name": F.lit(merge_name), "dr1": F.lit(True)})
    )
    return merged, upsert(per_field, entries, ["source_id", "field_name"])
