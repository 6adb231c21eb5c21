"""Sinks: layer tables with metadata columns, quarantine, events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from stratakit.operators.dedup import require_columns
from stratakit.operators.indicator import coerce
from stratakit.sources.schemas import conformed, grown, keep, kept, table_or_none, united


def with_metadata(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """Constant text columns, one literal each for the whole batch."""
    return df.withColumns({c: F.lit(v) for c, v in values.items()})


def rebalanced(df: DataFrame, *by: str) -> DataFrame:
    """Rows of a partition meet in few tasks, which AQE cuts where they are over
    its advisory size and joins where they are small: files of even size, however
    many tasks made the rows and whatever one partition holds."""
    return df.hint("rebalance", *by)


def write_counted(df: DataFrame, path: str, partition_by: str | None = None, overwrite: bool = True, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Parquet, partitioned if the column exists; an overwrite replaces only the
    partitions that ``df`` has.  Gives ``rows`` and whatever else ``counts`` asks
    for, counted by the pass that writes.

    The schema that the table has after this is kept with it.  A partitioned write
    or an append of no rows changes nothing; only an overwrite of a whole table
    looks for a row first, and leaves the table if there is none.
    """
    spark, wanted = df.sparkSession, {"rows": F.count(F.lit(1)), **(counts or {})}
    by_parts = bool(partition_by) and partition_by in df.columns
    whole = overwrite and not by_parts
    if whole and df.isEmpty():
        return dict.fromkeys(wanted, 0)
    schema = df.schema
    if not whole:
        known = kept(spark, path)
        if known is None and (old := table_or_none(spark, path)) is not None:
            known = old.schema
        schema = grown(known, df.schema, path)
        df = conformed(df, schema)
        if schema != known:
            keep(spark, path, schema)
    seen = Observation()
    rows = rebalanced(df, partition_by) if by_parts else df
    writer = rows.observe(seen, *[c.alias(n) for n, c in wanted.items()]).write.mode("overwrite" if overwrite else "append")
    if by_parts:
        writer = writer.partitionBy(partition_by)
        if overwrite:
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    if whole:
        keep(spark, path, united([schema]))
    return dict(seen.get)


def write_table(df: DataFrame, path: str, partition_by: str | None = None, overwrite: bool = True) -> bool:
    """:func:`write_counted`; False where no rows were written."""
    return write_counted(df, path, partition_by, overwrite)["rows"] > 0


def bronze_rows(df: DataFrame, source: str, batch_id: str, ingested_at: str, required: tuple[str, ...] = ()) -> DataFrame:
    require_columns(df, required, source)
    return with_metadata(df, {"_ingestion_timestamp": ingested_at, "_source_table": source, "_batch_id": batch_id})


def write_bronze(df: DataFrame, path: str, source: str, batch_id: str, ingested_at: str, required: tuple[str, ...] = (), partition_by: str | None = None, overwrite: bool = True) -> bool:
    return write_table(bronze_rows(df, source, batch_id, ingested_at, required), path, partition_by, overwrite)


def silver_rows(df: DataFrame, batch_id: str, processed_at: str) -> DataFrame:
    return with_metadata(df, {"_silver_processed_at": processed_at, "_silver_batch_id": batch_id})


def write_silver(df: DataFrame, path: str, batch_id: str, processed_at: str, partition_by: str | None = None, overwrite: bool = True, counts: dict[str, Column] | None = None) -> dict[str, int]:
    return write_counted(silver_rows(df, batch_id, processed_at), path, partition_by, overwrite, counts)


def gold_rows(df: DataFrame, batch_id: str, processed_at: str) -> DataFrame:
    return coerce(with_metadata(df, {"_gold_processed_at": processed_at, "_gold_batch_id": batch_id}))


def write_gold(df: DataFrame, path: str, batch_id: str, processed_at: str, partition_by: str | None = "ano", overwrite: bool = True) -> dict[str, int]:
    return write_counted(gold_rows(df, batch_id, processed_at), path, partition_by, overwrite)


def quarantine_rows(df: DataFrame, batch_id: str, layer: str) -> DataFrame:
    return with_metadata(df, {f"_{layer}_batch_id": batch_id, "_quarantine_layer": layer})


def write_quarantine(df: DataFrame, path: str, batch_id: str, layer: str, counts: dict[str, Column] | None = None) -> dict[str, int]:
    """Rejected rows under their batch's partition: a rerun of the batch replaces
    its own rows only.  Batches may differ in their columns."""
    return write_counted(quarantine_rows(df, batch_id, layer).withColumn("batch", F.lit(batch_id)), path, "batch", counts=counts)


def publish(events: DataFrame, servers: str, topic: str) -> None:
    """Encoded events (column ``value``) to a topic."""
    events.select("value").write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()
