"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(col: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def pieces_of(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut to at most ``rows`` rows, so that Python objects of one cut stay few."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(df: DataFrame, fn: Callable[[list, list[str]], dict[str, list]], schema: str, key: str, text: str) -> DataFrame:
    """Apply ``fn(keys, texts) -> columns`` to cuts of the table; ``schema`` is a DDL string.

    Only key and text travel to Python, under fixed names, so other columns of the
    input cannot clash.
    """
    narrow = df.select(F.col(key).alias("key"), text_of(text).alias("text"))
    arrow = _arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces_of(batches):
            out = fn(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return narrow.mapInArrow(run, schema)


def _arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
