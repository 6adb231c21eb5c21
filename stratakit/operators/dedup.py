"""One row for each key: latest wins, last arrival wins, first for look-ups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def require_columns(df: DataFrame, columns: list[str] | tuple[str, ...], what: str = "table") -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: columns missing: {', '.join(missing)}")


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key (null is a key too) in the given order.

    One shuffle by key; Spark keeps only one row a key and partition before it.  A
    hash leads the key, so that the sort tells rows apart by one number instead of by
    the key's columns, the first of which (a year) may be the same in most rows.
    """
    require_columns(df, keys)
    place = F.row_number().over(W.partitionBy("_hash", *keys).orderBy(*(order or [F.lit(0)])))
    return df.withColumn("_hash", F.xxhash64(*keys)).withColumn("_place", place).where("_place = 1").drop("_place", "_hash")


def latest(df: DataFrame, keys: list[str], timestamp: str = "_ingestion_timestamp", ties: list[Column] | None = None) -> DataFrame:
    """Latest row by ``timestamp``, nulls last; without that column any one row,
    or the first by ``ties``."""
    newest = [F.desc_nulls_last(timestamp)] if timestamp in df.columns else []
    return first_per_key(df, keys, newest + list(ties or []))


def last_arrival(df: DataFrame, keys: list[str], arrival: list[str]) -> DataFrame:
    """The row that came last by ``arrival`` columns, as stream offsets."""
    return first_per_key(df, keys, [F.desc_nulls_last(c) for c in arrival])


def lookup(df: DataFrame, keys: list[str]) -> DataFrame:
    """Look-up rows, one a key, the least by all other columns, so that reruns agree."""
    return first_per_key(df, keys, [F.asc_nulls_last(c) for c in df.columns if c not in keys])


def removed_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows a dedup by ``keys`` removes."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("removed_rows"))
