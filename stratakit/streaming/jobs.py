"""Micro-batch jobs: messages -> Bronze upsert -> quality gate -> Silver upsert."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from stratakit.operators.dedup import latest
from stratakit.operators.enrich import STUDENT_COLUMNS, Keep, prune
from stratakit.operators.quality import Rule, check, pass_rate
from stratakit.operators.standardize import standardize_common
from stratakit.operators.upsert import upsert_parquet
from stratakit.sources.schemas import MISSING
from stratakit.sources.sinks import write_quarantine, write_table
from stratakit.streaming.events import classified, rejects, valid_rows


@dataclass(frozen=True)
class StreamTables:
    """Where a stream's tables lie, and how its rows are keyed."""

    bronze: str
    silver: str
    quarantine: str
    schema: T.StructType
    keys: tuple[str, ...]
    rules: tuple[Rule, ...] = ()
    partition_by: str | None = "ano"
    preserve: tuple[str, ...] = ()
    keep: Keep = STUDENT_COLUMNS
    rejects: str | None = None
    buckets: int | None = None  #: of each year, by hash of the key: what a batch rewrites
    metrics: str | None = None  #: one row a batch, see :func:`batch_metrics`


ARRIVAL = ("_ingestion_timestamp", "_kafka_partition", "_kafka_offset")


def silver_batch(bronze: DataFrame, keys: list[str], batch_id: str, processed_at: str, keep: Keep = STUDENT_COLUMNS) -> DataFrame:
    """Standard columns, latest row a key (ties: highest partition and offset),
    processing metadata, kept columns only."""
    ties = [F.desc_nulls_last(c) for c in ARRIVAL[1:] if c in bronze.columns]
    rows = latest(standardize_common(bronze), keys, ties=ties)
    stamped = rows.withColumns({"_silver_processed_at": F.lit(processed_at), "_silver_stream_batch_id": F.lit(batch_id)})
    return prune(stamped, keep)


def promote(bronze: DataFrame, tables: StreamTables, references: dict[str, DataFrame], batch_id: str, processed_at: str) -> tuple[int, int]:
    """One Bronze batch through the quality gate into Silver; what fails goes to
    the quarantine under the batch's id, so a replay repeats the same files.
    Gives how many rows are valid and how many are quarantined."""
    rows = silver_batch(bronze, list(tables.keys), batch_id, processed_at, tables.keep)
    checked = check(rows, tables.rules, references, processed_at)
    checked.masked.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total = checked.totals.first()  # fills the cache, too
        valid = total["input_rows"] - total["quarantined_rows"]
        write_quarantine(checked.quarantine, tables.quarantine, batch_id, "silver")
        if valid:
            upsert_parquet(checked.valid, tables.silver, list(tables.keys), [], partition_by=tables.partition_by, buckets=tables.buckets)
        return valid, total["quarantined_rows"]
    finally:
        checked.masked.unpersist()


def batch_time(spark: SparkSession, folder: str, batch_id: str, clock: Callable[[], str]) -> str:
    """The time of a batch: the clock's at its first attempt, the same at every later one."""
    place = f"{folder.rstrip('/')}/{batch_id}"
    try:
        found = spark.read.text(place).first()
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        found = None
    if found is None:
        now = clock()
        spark.createDataFrame([(now,)], "value string").coalesce(1).write.mode("overwrite").text(place)
        return now
    return found[0]


METRICS = T.StructType().add("at", "string").add("messages", "long").add("parsed_rows", "long").add("rejected_rows", "long").add("valid_rows", "long").add("quarantined_rows", "long").add("batch", "string")


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """``batch, at, messages, parsed_rows, rejected_rows, valid_rows,
    quarantined_rows, pass_rate`` of a stream's batches.  ``parsed_rows`` are what
    the classifier lets pass; of them Silver gets the latest of each key."""
    rows = spark.read.schema(METRICS).parquet(path)
    return rows.select("batch", *[f.name for f in METRICS if f.name != "batch"], pass_rate(F.col("valid_rows"), F.col("quarantined_rows")).alias("pass_rate"))


def batch_writer(tables: StreamTables, references: Callable[[], dict[str, DataFrame]], stream: str, clock: Callable[[], str], times: str | None = None) -> Callable[[DataFrame, int], None]:
    """The function for ``foreachBatch``: no rows pass through the driver.

    ``times``: a folder with each batch's time, so that a replay writes the same
    values again; without it the clock is asked at each attempt.
    """

    def write(messages: DataFrame, number: int) -> None:
        spark, batch_id = messages.sparkSession, f"{stream}-{number}"
        done = classified(messages, tables.keys).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            n = done.agg(F.count(F.lit(1)).alias("messages"), F.count_if(F.col("_rule").isNull()).alias("parsed")).first()  # fills the cache, too
            if not n["messages"]:
                return
            now = batch_time(spark, times, batch_id, clock) if times else clock()
            if tables.rejects and n["parsed"] < n["messages"]:
                write_table(rejects(done, now).withColumn("batch", F.lit(batch_id)), tables.rejects, "batch")
            good = bad = 0
            if n["parsed"]:
                valid = valid_rows(done, tables.schema, now)
                upsert_parquet(valid, tables.bronze, list(tables.keys), list(ARRIVAL), tables.preserve, tables.partition_by, buckets=tables.buckets)
                good, bad = promote(valid, tables, references(), batch_id, now)
            if tables.metrics:
                row = (now, n["messages"], n["parsed"], n["messages"] - n["parsed"], good, bad, batch_id)
                write_table(spark.createDataFrame([row], METRICS), tables.metrics, "batch")
        finally:
            done.unpersist()

    return write


def run_stream(source: DataFrame, tables: StreamTables, references: Callable[[], dict[str, DataFrame]], checkpoint: str, stream: str, clock: Callable[[], str]) -> StreamingQuery:
    """Starts a run over all that is there now.  The upserts are idempotent and a
    batch keeps the time of its first attempt (in ``<checkpoint>_times``), so a batch
    that runs again after a failure changes nothing."""
    write = batch_writer(tables, references, stream, clock, f"{checkpoint.rstrip('/')}_times")
    return source.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
