"""Ordering, subsets and completeness of a data release."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stokesweave.operators.keyed import in_ids, not_in_ids, with_scalars

TEST_ROWS = 100


def release_order(cat: DataFrame, flag: str = "stokesI_fit_flag", snr: str = "snr_polint", ident: str = "cat_id") -> DataFrame:
    """Good Stokes I fits first, then by falling signal to noise, ties by id."""
    return cat.orderBy(F.col(flag).asc(), F.col(snr).desc(), F.col(ident).asc())


def release_top(cat: DataFrame, n: int = TEST_ROWS, **columns: str) -> DataFrame:
    """First rows of the release order (a top-k, not a full sort)."""
    return release_order(cat, **columns).limit(n)


def release_subset(cat: DataFrame, kind: str, flag: str = "stokesI_fit_flag", **columns: str) -> DataFrame:
    """``full``, ``cut`` (good Stokes I fits) or ``test`` (first 100 rows)."""
    if kind == "full":
        return cat
    if kind == "cut":
        return cat.where(~F.col(flag))
    if kind == "test":
        return release_top(cat, flag=flag, **columns)
    raise ValueError(f"unknown release kind: {kind}")


def order_like_catalogue(products: DataFrame, cat: DataFrame, key: str = "source_id", rank: str = "rank") -> DataFrame:
    """Products in catalogue order, images before weights, Stokes I, Q, U.

    ``cat`` carries the catalogue position of each key as ``rank``; products
    have ``kind`` (image or weight) and ``stokes``.
    """
    stokes = F.array_position(F.array(F.lit("i"), F.lit("q"), F.lit("u")), F.lower("stokes"))
    joined = products.join(cat.select(key, rank), key)
    slot = F.when(F.col("kind") == "weight", 3).otherwise(0) + stokes
    return joined.withColumn("slot", slot.cast("int")).orderBy(rank, "slot", key)


def unique_products(products: DataFrame, cat: DataFrame, key: str = "source_id") -> DataFrame:
    """One row: distinct products and catalogue keys, and whether they agree."""
    n_cat = cat.agg(F.count_distinct(key).alias("n_catalogue"))
    found = products.agg(F.count_distinct(key).alias("n_products"))
    out = with_scalars(found, n_cat)
    return out.withColumn("complete", F.col("n_products") == F.col("n_catalogue"))


def matched_products(products: DataFrame, cat: DataFrame, key: str = "source_id") -> DataFrame:
    """Products of catalogued sources; raises when a source has no product."""
    matched = in_ids(products, cat.select(key).distinct(), key)
    missing = not_in_ids(cat.select(key).distinct(), products, key).limit(1).count()
    if missing:
        raise ValueError("some catalogued sources have no product")
    return matched


def excluded_sources(products: DataFrame, cat: DataFrame, key: str = "source_id") -> DataFrame:
    """Distinct product ids without a catalogue row."""
    return not_in_ids(products.select(key).distinct(), cat, key)


def counts(df: DataFrame, key: str) -> DataFrame:
    """Rows and distinct keys."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(key).alias("n_distinct"))


def distinct_beams(per_field: DataFrame, beams: str = "beam_list") -> DataFrame:
    """Distinct beam numbers held in nested lists."""
    return per_field.select(F.explode(F.array_distinct(beams)).alias("beam_num")).distinct()
