"""Sources: filtered scans, tolerant and strict table reads, streams."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.sources.schemas import kept, read_table, without_buckets

#: Errors of a source that isn't there, or has no data file yet.
MISSING = ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
log = logging.getLogger(__name__)


def in_years(column: str, years: Iterable[int]) -> Column:
    """Whether a date or timestamp lies in one of the years: a range for each run
    of years, which a scan takes, unlike a year computed from the column."""
    condition, run = F.lit(False), []
    for y in [*sorted(set(years)), None]:
        if run and (y is None or y != run[-1] + 1):
            first, after = (F.make_date(F.lit(x), F.lit(1), F.lit(1)) for x in (run[0], run[-1] + 1))
            condition, run = condition | (F.col(column) >= first) & (F.col(column) < after), []
        run.append(y)
    return condition


def scan(
    df: DataFrame, columns: Iterable[str] | None = None, years: Iterable[int] | None = None, year_column: str = "ano", extra: Column | str | None = None, limit: int | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """A source's rows: years, one more condition, columns, and a limit if it is
    above zero.  All of it is left to the optimiser to push into the scan.  A
    source without a year column can give a date instead: ``date_column``."""
    if years:
        df = df.where(in_years(date_column, years) if date_column else F.col(year_column).isin(*years))
    if extra is not None:
        df = df.where(extra)
    if columns:
        df = df.select(*columns)
    return df.limit(limit) if limit and limit > 0 else df


def read_source(
    spark: SparkSession, source: str, schema: T.StructType | str | None = None, years: Iterable[int] | None = None, year_column: str = "ano",
    limit: int | None = None, extra: Column | str | None = None, source_format: str = "parquet", date_column: str | None = None, **options: str,
) -> DataFrame:
    """Scan of a source (any Spark format); a missing one is empty, without
    columns unless a schema is given.  Years apply where their column exists:
    that of the year, or else that of the date."""
    raw = read_or_empty(spark, source, schema, source_format, **options)
    if not raw.columns:
        return raw
    by_date = date_column if year_column not in raw.columns and date_column in raw.columns else None
    return scan(raw, None, years if by_date or year_column in raw.columns else None, year_column, extra, limit, by_date)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType | str | None = None, source_format: str = "parquet", **options: str) -> DataFrame:
    """A table, or an empty frame where the path is missing; other errors rise."""
    try:
        reader = spark.read.format(source_format).options(**options)
        df = (reader.schema(schema) if schema is not None else reader).load(path)
        df.schema  # noqa: B018
        return df
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        return spark.createDataFrame([], schema if schema is not None else T.StructType([]))


def read_bronze(spark: SparkSession, path: str, years: Iterable[int] | None = None, year_column: str | None = "ano", schema: T.StructType | str | None = None) -> DataFrame:
    """Tolerant read under the table's own schema, so that columns and wider
    types that came later are there; partitions are pruned by year."""
    try:
        df = without_buckets(read_table(spark, path, schema))
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        df = spark.createDataFrame([], schema if schema is not None else kept(spark, path) or T.StructType([]))
    return scan(df, None, years if year_column in df.columns else None, year_column or "ano")


def read_silver(spark: SparkSession, path: str, years: Iterable[int] | None = None, year_column: str | None = "ano") -> DataFrame:
    """Strict read: a missing table is an error."""
    df = without_buckets(read_table(spark, path))
    return scan(df, None, years if year_column in df.columns else None, year_column or "ano")


def load_references(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """The reference tables that can be read; one that can't is left out with a
    warning, so that a stream goes on without its foreign keys."""
    found = {}
    for name, path in paths.items():
        try:
            found[name] = read_silver(spark, path, None, None)
        except Exception as e:  # whatever the store raises
            log.warning("reference %s can't be read, its checks are left out: %s", name, e)
    return found


def read_kafka_stream(spark: SparkSession, servers: str, topic: str, starting_offsets: str = "earliest", max_offsets: int | None = None, **options: str) -> DataFrame:
    """``value, topic, partition, offset`` of a topic; data loss doesn't fail it."""
    reader = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", starting_offsets).option("failOnDataLoss", "false").options(**options)
    if max_offsets:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
    return reader.load().select("value", "topic", "partition", "offset")


def read_file_stream(spark: SparkSession, path: str, schema: T.StructType | str, files_per_trigger: int = 1, source_format: str = "parquet") -> DataFrame:
    """A stream of files with the Kafka source's columns, for tests and replays."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).format(source_format).load(path)
