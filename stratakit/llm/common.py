"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

#: Word pattern of all contracts: runs without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shared_dir(spark: SparkSession) -> str:
    """A new folder name under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir``; only where that is unset
    on one machine (a local master, as in tests) a temporary one is made and set;
    a cluster without one raises ``ValueError``.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="stratakit-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/stage-{uuid.uuid4().hex}"


def staged(df: DataFrame, *partition_by: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Cuts the lineage: later jobs, and retries after a lost executor, read the
    files instead of computing ``df`` again.
    """
    path = shared_dir(df.sparkSession)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, by: str) -> DataFrame:
    """``df`` written once as a table of the shared folder, bucketed by a column,
    so that later groupings by it move none of its rows."""
    spark, name = df.sparkSession, f"stratakit_{uuid.uuid4().hex}"
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").option("path", shared_dir(spark)).option("compression", "zstd").bucketBy(buckets, by).saveAsTable(name)
    found = spark.table(name)
    found.schema  # noqa: B018
    spark.sql(f"drop table {name}")  # the files stay, and so does the plan that reads them
    return found


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def few_at_once(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most so many: Spark's have 10,000, whose
    texts as Python objects a worker would hold all at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def ascii_lower(col):
    """Lower-cases A-Z only, as all contracts ask."""
    return F.translate(col, UPPER, LOWER)


def bounded_sample(rows: DataFrame, group: str, each: int, most: int) -> DataFrame:
    """``doc_id, group`` of ``each`` rows of every group by hash of ``doc_id``,
    ``most`` in all; staged, and small enough to go to every task.

    A share of each group that holds about four times as many rows is cut out
    by hash first, so that no task ranks a whole group.
    """
    keys = rows.select("doc_id", group)
    sizes = staged(keys.groupBy(group).agg(F.count(F.lit(1)).alias("_size")))
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    near = keys.join(sizes, group).where(share < 4.0 * each / F.col("_size"))
    order = W.partitionBy(group).orderBy(share, "doc_id")
    chosen = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= each)
    return staged(chosen.orderBy("_n", group, "doc_id").limit(most).select("doc_id", group))


def running_before(rows: DataFrame, keys: list[Column], order: str, value: Column, name: str, stretch: int = 4096) -> DataFrame:
    """``rows`` with ``name``: the sum of ``value`` over the rows of the same
    keys whose ``order``, a whole number, comes before.

    Sums of stretches of ``order`` are added up first, so that no task sorts
    more than one stretch of a key, or a key's stretches.  Each ``order`` comes once for a key.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = rows.withColumns({n: k for n, k in zip(names, keys)} | {"_v": value, "_s": F.floor(F.col(order) / stretch)})
    sums = rows.groupBy(*names, "_s").agg(F.sum("_v").alias("_sum"))
    before = F.coalesce(F.sum("_sum").over(W.partitionBy(*names).orderBy("_s").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    sums = sums.select(*[F.col(n).alias(f"{n}_") for n in names], F.col("_s").alias("_s_"), before.alias("_before"))
    same = F.col("_s") == F.col("_s_")
    for n in names:
        same &= F.col(n).eqNullSafe(F.col(f"{n}_"))
    own = F.coalesce(F.sum("_v").over(W.partitionBy(*names, "_s").orderBy(order).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    out = rows.withColumn("_own", own).join(sums, same).withColumn(name, F.col("_before") + F.col("_own"))
    return out.drop(*names, *[f"{n}_" for n in names], "_v", "_s", "_s_", "_before", "_own")
