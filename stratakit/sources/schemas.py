"""Schemas of tables that grow: wider types, and a schema kept with the table.

A table's schema lies in ``_schema`` in its folder, which readers of the data
skip.  A scan that names it opens no footer while it is planned, finds columns that
came later, and reads whole numbers that were stored narrower.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Types in order of width; each is read as, or cast to, a later one without loss.
WHOLE = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
NUMBERS = (*WHOLE, T.FloatType(), T.DoubleType())
#: Errors of a table that isn't there, or has no data file yet.
MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
#: Columns that only place a row, not part of the table.
BUCKET = "_bucket_of_"


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds both: the wider number (whole and broken: double), the
    later of date and timestamp, a type beside nothing; else text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in NUMBERS and b in NUMBERS:
        both = max(NUMBERS.index(a), NUMBERS.index(b))
        return T.DoubleType() if both >= len(WHOLE) else NUMBERS[both]
    if isinstance(a, T.DateType) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, T.DateType) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    return T.StringType()


def reads_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether a scan can read the one type as the other, file by file."""
    if stored == wanted or isinstance(stored, T.NullType):
        return True
    if stored in WHOLE and wanted in WHOLE:
        return WHOLE.index(stored) < WHOLE.index(wanted)
    return stored in (*WHOLE[:3], T.FloatType()) and wanted == T.DoubleType() or isinstance(stored, T.DateType) and isinstance(wanted, T.TimestampNTZType)


def united(schemas: Iterable[T.StructType]) -> T.StructType:
    """All fields in the order in which they first come, each of the widest type; nullable."""
    kinds: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema:
            kinds[f.name] = wider(kinds[f.name], f.dataType) if f.name in kinds else f.dataType
    return T.StructType([T.StructField(n, k, True) for n, k in kinds.items()])


def conformed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the fields of ``schema``: cast, or null where absent."""
    kinds = {f.name: f.dataType for f in df.schema}

    def value(f: T.StructField):
        if f.name not in kinds:
            return F.lit(None).cast(f.dataType).alias(f.name)
        return F.col(f.name) if kinds[f.name] == f.dataType else F.col(f.name).cast(f.dataType).alias(f.name)

    return df.select(*map(value, schema))


def union_fragments(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames under their united schema; a column that a frame lacks is null."""
    if not frames:
        raise ValueError("no fragments")
    schema, out = united(df.schema for df in frames), None
    for df in frames:
        rows = conformed(df, schema)
        out = rows if out is None else out.unionByName(rows)
    return out


# ---- kept schemas ----------------------------------------------------------


def _place(path: str) -> str:
    return f"{path.rstrip('/')}/_schema"


def kept(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema that lies with the table, or None."""
    try:
        row = spark.read.text(_place(path), wholetext=True).first()
    except AnalysisException as e:
        if e.getCondition() not in MISSING:
            raise
        return None
    return T.StructType.fromJson(json.loads(row[0])) if row else None


def keep(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Stores the schema with the table; done before rows are written, so that no
    reader misses a column (one that isn't there yet is null)."""
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(_place(path))


def grown(old: T.StructType | None, new: T.StructType, path: str = "") -> T.StructType:
    """The schema of a table after rows of ``new`` come to it; a change that old
    files can't be read under is a ``ValueError``."""
    out = united([old, new] if old is not None else [new])
    for f in old or ():
        if not reads_as(f.dataType, out[f.name].dataType):
            raise ValueError(f"{path}: column {f.name} is {f.dataType.simpleString()} and can't become {out[f.name].dataType.simpleString()} without a rewrite")
    return out


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One scan under the given or kept schema.  A table that has none is merged
    from its files' footers, or, if types differ between them, from its files one
    by one.  A missing table is an error."""
    schema = schema if schema is not None else kept(spark, path)
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    try:
        df = spark.read.option("mergeSchema", "true").parquet(path)
        df.schema  # noqa: B018
        return df
    except (PySparkException, Py4JJavaError) as e:
        if "CANNOT_MERGE" not in str(e):
            raise
    files = spark.read.parquet(path).inputFiles()
    by_schema: dict[str, list[str]] = {}
    for f in files:
        by_schema.setdefault(spark.read.option("basePath", path).parquet(f).schema.json(), []).append(f)
    return union_fragments([spark.read.option("basePath", path).schema(T.StructType.fromJson(json.loads(s))).parquet(*fs) for s, fs in by_schema.items()])


def without_buckets(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith(BUCKET)])


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``, or None only where no data is there."""
    try:
        return read_table(spark, path)
    except AnalysisException as e:
        if e.getCondition() in MISSING:
            return None
        raise
