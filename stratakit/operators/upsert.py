"""Keyed upsert of batches into a Parquet table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.operators.dedup import last_arrival, require_columns
from stratakit.sources.schemas import BUCKET, conformed, grown, keep, kept, read_table, table_or_none, united, without_buckets


def match_condition(keys: list[str], left: str = "t", right: str = "b") -> Column:
    """Equality of all keys; null keys match nothing."""
    condition = F.lit(True)
    for k in keys:
        condition = condition & (F.col(f"{left}.{k}") == F.col(f"{right}.{k}"))
    return condition


def updated_columns(columns: list[str], keys: list[str], preserve: tuple[str, ...] = ()) -> list[str]:
    """What a match overwrites: the batch's columns less keys and preserved ones."""
    return [c for c in columns if c not in keys and c not in preserve]


def merged(target: DataFrame, batch: DataFrame, keys: list[str], preserve: tuple[str, ...] = (), newer_than: str | None = None) -> DataFrame:
    """``target`` after updating matched rows and inserting the others.

    Columns that the batch lacks keep the target's values, columns that the
    target lacks are new; a null in the batch overwrites.  With ``newer_than``
    a match updates only if the batch's value of that column isn't older.
    """
    require_columns(batch, keys, "batch")
    require_columns(target, keys, "target")
    t, b = target.withColumn("_in_t", F.lit(True)).alias("t"), batch.withColumn("_in_b", F.lit(True)).alias("b")
    both = t.join(b, match_condition(keys), "full_outer")
    change = set(updated_columns(batch.columns, keys, preserve))
    update = F.lit(True) if newer_than is None else F.coalesce(F.col(f"b.{newer_than}") >= F.col(f"t.{newer_than}"), F.lit(True))
    takes = F.col("b._in_b").isNotNull() & (F.col("t._in_t").isNull() | update)

    def value(c: str) -> Column:
        if c not in batch.columns:
            return F.col(f"t.{c}")
        if c not in target.columns:
            return F.when(takes, F.col(f"b.{c}"))
        if c in keys:
            return F.coalesce(F.col(f"b.{c}"), F.col(f"t.{c}"))
        if c in change:
            return F.when(takes, F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))
        return F.when(F.col("t._in_t").isNull(), F.col(f"b.{c}")).otherwise(F.col(f"t.{c}"))

    columns = [*target.columns, *[c for c in batch.columns if c not in target.columns]]
    return both.select(*[value(c).alias(c) for c in columns])


def bucket_of(keys: list[str] | tuple[str, ...], buckets: int) -> Column:
    """A row's bucket; keys count by their text, so that a batch whose numbers are
    narrower than the table's finds the same bucket."""
    return F.pmod(F.xxhash64(*[F.col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def touched_parts(rows: DataFrame, parts: list[str]) -> Column:
    """A condition on partition columns alone: those in which ``rows`` has any.

    What comes to the driver are partition values, a bounded number of years and
    buckets; a scan with this condition lists and opens nothing else.
    """
    found: dict = {}
    for *outer, last in rows.select(*parts).distinct().collect():
        found.setdefault(tuple(outer), []).append(last)
    condition = F.lit(False)
    for outer, last in found.items():
        hit = F.col(parts[-1]).isin([v for v in last if v is not None])
        hit = hit | F.col(parts[-1]).isNull() if None in last else hit
        for c, v in zip(parts, outer):
            hit = hit & F.col(c).eqNullSafe(F.lit(v))
        condition = condition | hit
    return condition


def upsert_parquet(
    batch: DataFrame, path: str, keys: list[str], arrival: list[str], preserve: tuple[str, ...] = (), partition_by: str | None = None, newer_than: str | None = None, buckets: int | None = None,
) -> None:
    """Upserts a batch into the table at ``path``; its last row a key wins.

    Only partitions that the batch touches are read and rewritten; the rows of
    a key must stay in their partition, so the partition column is a key.  With
    ``buckets`` a hash of the key is a second level of partitions, so that a small
    batch rewrites a few of a year's buckets and leaves the files of the others;
    the number of buckets is a table's own for good (:func:`rebucket` changes it).
    The result is staged beside the table before partitions are replaced, so a
    failure while merging leaves the table as it was; a rerun repeats the same
    result.  The staged copy is deleted once the partitions are replaced.
    """
    spark = batch.sparkSession
    if partition_by and partition_by not in keys:
        raise ValueError("the partition column must be one of the keys")
    rows = last_arrival(batch, keys, arrival) if arrival else batch.dropDuplicates(keys)
    target = table_or_none(spark, path)
    parts = [partition_by] if partition_by else []
    if buckets:
        name = f"{BUCKET}{buckets}"
        if target is not None and name not in target.columns:
            raise ValueError(f"{path} hasn't {buckets} buckets; rebucket it first")
        rows, parts = rows.withColumn(name, bucket_of(keys, buckets)), [*parts, name]
    elif target is not None and (other := [c for c in target.columns if c.startswith(BUCKET)]):
        raise ValueError(f"{path} has buckets: {other[0]}")
    known = target.schema if target is not None else None
    if target is not None:
        old = target.where(touched_parts(rows, parts)) if parts else target
        rows = merged(old, rows, [*keys, *parts[-1:]] if buckets else keys, preserve, newer_than)
    schema = grown(known, rows.schema, path)
    stage = f"{path.rstrip('/')}_staging/{uuid.uuid4().hex}"
    try:
        rows = conformed(rows, schema)
        rows.write.parquet(stage)
        done = spark.read.schema(rows.schema).parquet(stage)
        if parts:
            if schema != kept(spark, path):
                keep(spark, path, schema)
            done.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).option("partitionOverwriteMode", "dynamic").parquet(path)
        else:
            done.write.mode("overwrite").parquet(path)
            keep(spark, path, schema)
    finally:
        delete(spark, stage)


def rebucket(spark: SparkSession, path: str, keys: list[str], to: str, partition_by: str | None = None, buckets: int | None = None) -> None:
    """The table of ``path`` as a new one at ``to`` with another number of
    buckets, or none."""
    df = without_buckets(read_table(spark, path))
    parts = [partition_by] if partition_by else []
    if buckets:
        df, parts = df.withColumn(f"{BUCKET}{buckets}", bucket_of(keys, buckets)), [*parts, f"{BUCKET}{buckets}"]
    keep(spark, to, united([df.schema]))
    writer = df.hint("rebalance", *parts).write.mode("append") if parts else df.write.mode("append")
    (writer.partitionBy(*parts) if parts else writer).parquet(to)


def delete(spark: SparkSession, path: str) -> None:
    """Removes a folder in any store that Spark can write to."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
