"""Survey ingest: tables in, associated sources out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stokesweave.operators.association import beam_pairs, field_rows, source_beams, source_fields
from stokesweave.sources.tables import read_beam_pointings, read_catalogue, read_field_table, replace_table, valid_sbid


def associate(
    islands: DataFrame, pointings: DataFrame, epoch: int = 0, radius_deg: float = 1.0, tile_col: str = "tile_id"
) -> DataFrame:
    """(source, field) rows of every island near a beam pointing; no pair of source and beam is a row or shuffled."""
    pairs = beam_pairs(islands.select("source_id", "ra", "dec"), pointings, radius_deg, nested=True, epoch=epoch, tiles=islands.select(tile_col), tile_col=tile_col)
    return field_rows(source_fields(pairs, islands.select(tile_col), epoch, tile_col=tile_col))


def ingest(
    spark: SparkSession, root: str, epoch: int, islands_path: str, components_path: str, database: str | None = None
) -> dict[str, int]:
    """Load one epoch into its own database and return row counts per table."""
    database = database or f"epoch_{epoch}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    fields = read_field_table(spark, root, epoch)
    pointings = read_beam_pointings(spark, root, epoch, fields)
    islands = read_catalogue(spark, islands_path)
    components = read_catalogue(spark, components_path)
    flat = pointings.select(
        F.col("FIELD_NAME").alias("field_name"),
        F.col("SBID").alias("sbid"),
        F.col("BEAM_NUM").alias("beam_num"),
        F.col("RA_DEG").alias("ra"),
        F.col("DEC_DEG").alias("dec"),
    )
    positions = islands.select(
        F.col("Source_ID").alias("source_id"), F.col("RA").alias("ra"), F.col("Dec").alias("dec"), F.col("Tile_ID").alias("tile_id")
    )
    per_field = associate(positions, flat, epoch)
    tables = {
        "islands": (islands, "Source_ID"),
        "components": (components, "Gaussian_ID"),
        "fields": (valid_sbid(fields), "FIELD_NAME"),
        "beam_inf": (pointings, "FIELD_NAME"),
        "source_fields": (per_field, "source_id"),
    }
    counts = {name: replace_table(df, f"{database}.{name}", cluster_by=key) for name, (df, key) in tables.items()}
    nested = source_beams(spark.table(f"{database}.source_fields"))
    counts["beams"] = replace_table(nested, f"{database}.beams", cluster_by="source_id")
    return counts
