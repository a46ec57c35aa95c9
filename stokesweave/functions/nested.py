"""Array-of-struct and map helpers for per-component result lists.

A result list is ``ARRAY<STRUCT<field, ...>>`` with one element per processing
run (``save_name``).  Conditions are given as ``{member: value}`` pairs, all of
which must hold; ``present`` lists members that must not be NULL.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stokesweave.functions.numeric import as_col


def _matches(item: Column, where: Mapping[str, object], present: Sequence[str] = ()) -> Column:
    cond = F.lit(True)
    for member, value in where.items():
        cond = cond & F.coalesce(item[member] == F.lit(value), F.lit(False))
    for member in present:
        cond = cond & item[member].isNotNull()
    return cond


def element_where(arr, where: Mapping[str, object], present: Sequence[str] = ()) -> Column:
    """First element meeting the conditions, NULL when there is none."""
    return F.get(F.filter(as_col(arr), lambda x: _matches(x, where, present)), F.lit(0))


def exists_where(arr, where: Mapping[str, object], present: Sequence[str] = ()) -> Column:
    """TRUE when one element meets all conditions."""
    return F.coalesce(F.exists(as_col(arr), lambda x: _matches(x, where, present)), F.lit(False))


def set_element(arr, where: Mapping[str, object], updates: Mapping[str, object]) -> Column:
    """Patch the named members of every matching element."""

    def patch(x: Column) -> Column:
        out = x
        for member, value in updates.items():
            out = out.withField(member, value if isinstance(value, Column) else F.lit(value))
        return F.when(_matches(x, where), out).otherwise(x)

    return F.transform(as_col(arr), patch)


def push_element(arr, element: Column, where: Mapping[str, object]) -> Column:
    """Append ``element`` unless a matching one exists; a NULL array becomes a new one."""
    arr = as_col(arr)
    return (
        F.when(arr.isNull(), F.array(element))
        .when(exists_where(arr, where), arr)
        .otherwise(F.concat(arr, F.array(element)))
    )


def reset_status(df: DataFrame, selected: DataFrame, key: str, arr: str, save_name: str, stage: str) -> DataFrame:
    """Set a stage flag to FALSE in the ``save_name`` element of the selected rows.

    Rows without such an element get one first, so that a later run can patch it.
    """
    chosen = selected.select(key).distinct().withColumn("_chosen", F.lit(True))
    element_type = df.schema[arr].dataType.elementType
    fresh = F.struct(
        *[
            (
                F.lit(save_name) if f.name == "field" else F.lit(False) if f.name == stage else F.lit(None)
            ).cast(f.dataType).alias(f.name)
            for f in element_type.fields
        ]
    )
    prepared = push_element(arr, fresh, {"field": save_name})
    return (
        df.join(chosen, key, "left")
        .withColumn(
            arr,
            F.when(
                F.col("_chosen"), set_element(prepared, {"field": save_name}, {stage: F.lit(False)})
            ).otherwise(F.col(arr)),
        )
        .drop("_chosen")
    )


def explode_beams(df: DataFrame, beams: str = "beams", field: str | None = None) -> DataFrame:
    """One row per (source, field, beam) of the nested beam map."""
    # ``explode`` would work the map out twice, once to filter empty ones
    rows = df.select("*", F.explode_outer(beams).alias("field_name", "_entry")).where("_entry is not null").drop(beams)
    if field is not None:
        rows = rows.where(F.col("field_name") == field)
    return rows.select("*", F.explode(F.array_distinct("_entry.beam_list")).alias("beam_num")).drop("_entry")


def header_map(cards) -> Column:
    """Header cards (array of key/value structs) as a map; blank keys are dropped
    and the last card of a repeated key wins."""
    named = F.filter(as_col(cards), lambda c: F.coalesce(F.trim(c["key"]) != "", F.lit(False)))
    size = F.size(named)
    last = F.filter(
        F.transform(named, lambda c, i: F.struct(c["key"].alias("key"), c["value"].alias("value"), i.alias("pos"))),
        lambda c: ~F.exists(
            F.slice(named, c["pos"] + 2, F.greatest(size - c["pos"] - 1, F.lit(0))), lambda later: later["key"] == c["key"]
        ),
    )
    return F.map_from_entries(F.transform(last, lambda c: F.struct(c["key"], c["value"])))


def json_encode(c) -> Column:
    return F.to_json(as_col(c))


def json_decode(c, schema: T.DataType | str) -> Column:
    return F.from_json(as_col(c), schema)
