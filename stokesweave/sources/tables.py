"""Reading and writing survey tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stokesweave.sources.schema import catalogue_params, field_dictionary, fill_blank_units

FIELD_SCHEMA = T.StructType(
    [
        T.StructField("INDEX", T.IntegerType()),
        T.StructField("FIELD_NAME", T.StringType()),
        T.StructField("SBID", T.LongType()),
        T.StructField("CAL_SBID", T.LongType()),
        T.StructField("SELECT", T.IntegerType()),
        T.StructField("RA_DEG", T.DoubleType()),
        T.StructField("DEC_DEG", T.DoubleType()),
        T.StructField("POL_AXIS", T.DoubleType()),
        T.StructField("SCAN_START", T.DoubleType()),
        T.StructField("SCAN_TINT", T.DoubleType()),
        T.StructField("COMMENT", T.StringType()),
    ]
)
BEAM_SCHEMA = T.StructType(
    [
        T.StructField("BEAM_NUM", T.IntegerType()),
        T.StructField("RA_DEG", T.DoubleType()),
        T.StructField("DEC_DEG", T.DoubleType()),
    ]
)


def read_field_table(
    spark: SparkSession, root: str, epoch: int, name: str = "field_data", schema: T.StructType = FIELD_SCHEMA
) -> DataFrame:
    """Survey CSV at ``{root}/db/epoch_{epoch}/{name}.csv``; a missing file is an error.

    Columns are matched by header name, so file column order does not matter.
    """
    path = f"{root.rstrip('/')}/db/epoch_{epoch}/{name}.csv"
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException as e:
        raise FileNotFoundError(path) from e
    known = {f.name: f for f in schema.fields}
    ordered = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in header])
    rows = spark.read.option("header", True).schema(ordered).csv(path)
    return rows.select([f.name for f in schema.fields if f.name in header])


def read_field_jdbc(
    spark: SparkSession,
    url: str,
    name: str,
    partition_column: str = "SBID",
    bounds: tuple[int, int] | None = None,
    partitions: int = 8,
    **options: str,
) -> DataFrame:
    """The same table from a relational database (one database per epoch)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", f'"{name}"')
    if bounds is not None:
        reader = (
            reader.option("partitionColumn", f'"{partition_column}"')
            .option("lowerBound", bounds[0])
            .option("upperBound", bounds[1])
            .option("numPartitions", partitions)
        )
    return reader.options(**options).load()


def valid_sbid(fields: DataFrame, sbid: str = "SBID") -> DataFrame:
    """Drop placeholder rows with a negative SBID."""
    return fields.where(F.col(sbid) >= 0)


def read_beam_pointings(
    spark: SparkSession, root: str, epoch: int, fields: DataFrame, schema: T.StructType = BEAM_SCHEMA
) -> DataFrame:
    """All per-(SBID, field) beam files of the wanted fields as one table.

    One scan over the folder, a file (the beams of one pointing) a row: SBID and field come from
    the file name, columns from each file's own header by name.  A column that a file
    lacks and a value that is not of the column's type are NULL.  Missing or unreadable files
    are skipped, and the wanted fields filter by a join.
    """
    path = f"{root.rstrip('/')}/db/epoch_{epoch}"
    files = (
        spark.read.option("pathGlobFilter", "beam_inf_*.csv")
        .option("ignoreMissingFiles", True)
        .option("ignoreCorruptFiles", True)
        .text(path, wholetext=True)
    )
    # the name comes percent-encoded, with a plus sign left as it is
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))

    def cells(line: Column) -> Column:
        """Fields of a CSV line; a comma inside quotes does not part them."""
        return F.transform(F.split(line, r',(?=(?:[^"]*"[^"]*")*[^"]*$)'), lambda c: F.regexp_replace(F.trim(c), '^"|"$', ""))

    lines = F.filter(F.split(F.regexp_replace("value", "^\ufeff", ""), r"\r?\n"), lambda x: F.trim(x) != "")
    rows = files.select(
        F.regexp_extract(name, r"^beam_inf_\d+-(.+)\.csv$", 1).alias("FIELD_NAME"),
        F.regexp_extract(name, r"^beam_inf_(\d+)-", 1).cast("long").alias("SBID"),
        cells(F.get(lines, F.lit(0))).alias("_header"),
        F.explode(F.slice(lines, F.lit(2), F.greatest(F.size(lines), F.lit(1)))).alias("_line"),
    ).withColumn("_cells", cells(F.col("_line")))
    at = {f.name: F.array_position("_header", f.name).cast("int") for f in schema.fields}
    tagged = rows.select(
        "FIELD_NAME",
        "SBID",
        *[F.when(at[f.name] > 0, F.get("_cells", at[f.name] - 1)).try_cast(f.dataType).alias(f.name) for f in schema.fields],
    )
    wanted = valid_sbid(fields).select("FIELD_NAME", F.col("SBID").cast("long").alias("SBID")).distinct()
    return tagged.join(wanted, ["FIELD_NAME", "SBID"], "left_semi")


def read_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Island or component catalogue (parquet), text columns decoded."""
    return decode_bytes(spark.read.parquet(path))


def read_votable(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a table-data VOTable through the built-in XML source.

    Column names and types come from the FIELD elements (a short list), the rows
    from the TR elements; an empty cell is NULL.
    """
    field_schema = "_name string, _datatype string, _arraysize string, _unit string, _ucd string"
    fields = spark.read.format("xml").option("rowTag", "FIELD").schema(field_schema).load(path)
    columns = fields.coalesce(1).collect()  # the table header
    kinds = {"double": "double", "float": "double", "int": "int", "short": "int", "long": "bigint", "boolean": "boolean"}
    cells = spark.read.format("xml").option("rowTag", "TR").option("nullValue", "").schema("TD array<string>").load(path)
    picked = []
    for i, c in enumerate(columns):
        kind = "string" if c._datatype in ("char", "unicodeChar") else kinds.get(c._datatype, "string")
        meta = {k: v for k, v in (("unit", c._unit), ("ucd", c._ucd)) if v}
        picked.append(F.get("TD", F.lit(i)).try_cast(kind).alias(c._name, metadata=meta))
    return cells.select(picked)


def decode_bytes(df: DataFrame) -> DataFrame:
    """Every BINARY column becomes UTF-8 text."""
    binary = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BinaryType)]
    return df.withColumns({c: F.decode(c, "UTF-8") for c in binary}) if binary else df


def replace_table(df: DataFrame, name: str, partition_by: Sequence[str] = (), cluster_by: str | None = None) -> int:
    """Replace a managed table and return its row count.

    ``cluster_by`` sorts within files so that key lookups skip row groups.
    """
    rows = df.sortWithinPartitions(cluster_by) if cluster_by else df
    writer = rows.write.mode("overwrite").format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name).count()


def upsert(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, order: str | None = None
) -> DataFrame:
    """Unordered upsert of a column subset.

    A matched row takes the update's values (also NULL ones) for the updated
    columns and keeps the others; an unmatched update becomes a new row with
    NULL in the columns it does not carry.  Of several updates of one key the one
    with the largest ``order`` counts; without ``order`` they are an error.
    """
    keys = list(keys)
    columns = [c for c in (columns or updates.columns) if c not in keys]
    value = F.struct(*columns)
    if order:
        one = F.max_by(value, order)
    else:
        one = F.when(F.count(F.lit(1)) > 1, F.raise_error(F.lit("several updates of one key"))).otherwise(F.first(value))
    new = updates.groupBy(*keys).agg(one.alias("_new")).withColumn("_hit", F.lit(True))
    joined = target.join(new, keys, "full_outer")
    types = {f.name: f.dataType for f in target.schema.fields}
    out = []
    for c in target.columns:
        if c in columns:
            out.append(F.when(F.col("_hit"), F.col(f"_new.{c}").cast(types[c])).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    out += [F.col(f"_new.{c}").alias(c) for c in columns if c not in types]
    return joined.select(out)


def write_upsert(merged: DataFrame, path: str, partition_by: str) -> None:
    """Overwrite only the partitions present in ``merged`` (dynamic overwrite)."""
    merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


# Reserved column names and their replacements on output.
OUTPUT_RENAMES = {"catalog": "catalog_name", "interval": "obs_interval"}
SOURCE_RENAMES = {"Min": "Min_axis", "Maj": "Maj_axis", "E_Min": "E_Min_axis", "E_Maj": "E_Maj_axis"}


def rename_present(df: DataFrame, renames: dict[str, str]) -> DataFrame:
    """Rename the columns that exist, keeping their metadata."""
    fields = {f.name: f for f in df.schema.fields}
    return df.select([F.col(c).alias(renames.get(c, c), metadata=fields[c].metadata or {}) for c in df.columns])


def rename_reserved(df: DataFrame) -> DataFrame:
    """Axis columns of a source catalogue get names that are not reserved words."""
    return rename_present(df, SOURCE_RENAMES)


def write_catalogue(df: DataFrame, path: str) -> DataFrame:
    """Write the final catalogue with its dictionary and parameters.

    Returns the catalogue as written.
    """
    out = fill_blank_units(rename_present(df, OUTPUT_RENAMES))
    out.write.mode("overwrite").parquet(f"{path}/catalogue")
    field_dictionary(out).coalesce(1).write.mode("overwrite").json(f"{path}/dictionary")
    catalogue_params(df.sparkSession, path).coalesce(1).write.mode("overwrite").json(f"{path}/params")
    return out


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)
