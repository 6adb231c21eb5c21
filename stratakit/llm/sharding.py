"""Sharding by fixed virtual slots (DataFrame functions only).

Every record hashes into one of ``n_slots`` virtual slots for good.  A small
table maps slots to shards; it is stored by version, and rebalancing edits it:
a slot moves only if its shard is over the mean or goes away.  Records never
hash anew.  A later run loads the latest version, and stores a new one only if
the shards have grown apart or their number has changed.

Equal texts under different ids lie in different slots: one text may make up a
third of all rows, and the law ``bytes`` asks for shards of near equal size.

Rows: null ``doc_id`` and null text hash like any value; rows equal in id and
text share a slot; an empty table gives an empty result and a full map.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stratakit.llm.common import documents, shared_dir, staged

N_SLOTS = 4096
N_SHARDS = 16
SEED = 7
#: A map stays while no shard is over the mean by more than this part of it.
TOLERANCE = 0.01


def virtual_slot(*cols: Column, n_slots: int = N_SLOTS) -> Column:
    return F.pmod(F.xxhash64(F.lit(SEED), *cols), F.lit(n_slots)).cast("int")


def slot_bytes(records: DataFrame) -> DataFrame:
    """Rows and bytes per virtual slot; at most ``n_slots`` rows."""
    return records.groupBy("virtual_slot").agg(F.count(F.lit(1)).alias("slot_rows"), F.sum("size").alias("slot_bytes"))


def first_map(spark: SparkSession, n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> DataFrame:
    """Version 1: slots dealt round-robin."""
    slots = spark.range(n_slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return slots.select(F.lit(1).alias("version"), "virtual_slot", (F.col("virtual_slot") % n_shards).cast("int").alias("shard"))


def rebalance(slot_map: DataFrame, sizes: DataFrame, n_shards: int = N_SHARDS) -> DataFrame:
    """The next version of a map, near equal in bytes, by few moves.

    Within each shard the largest slots stay while their sum is within the
    mean; what is over, and all of shards from ``n_shards`` on, goes, largest
    first, to the shard that is lightest at that point.  All of it is one fold over at most ``n_slots`` rows, whose
    number doesn't grow with the data.
    """
    size = F.coalesce(F.col("slot_bytes"), F.lit(0)).cast("double")
    known = slot_map.join(sizes, "virtual_slot", "left").withColumn("b", size)
    mean = F.sum("b").over(W.partitionBy()) / n_shards
    upto = F.sum("b").over(W.partitionBy("shard").orderBy(F.desc("b"), "virtual_slot").rowsBetween(W.unboundedPreceding, 0))
    marked = known.withColumn("stays", ((upto <= mean) | (F.col("b") == 0)) & (F.col("shard") < n_shards))
    slot = F.struct((-F.col("b")).alias("minus"), "virtual_slot", "shard")
    one = marked.agg(
        F.max("version").alias("version"),
        F.sort_array(F.collect_list(F.when(~F.col("stays"), slot))).alias("moving"),
        F.transform(F.array(*[F.struct(F.sum(F.when(F.col("stays") & (F.col("shard") == s), F.col("b")).otherwise(0.0)).alias("load"), F.lit(s).alias("shard")) for s in range(n_shards)]), lambda x: x).alias("loads"),
        F.collect_list(F.when(F.col("stays"), F.struct("virtual_slot", "shard"))).alias("kept"),
    )

    def place(acc: Column, x: Column) -> Column:
        lightest = F.array_min(acc["loads"])["shard"]
        loads = F.transform(acc["loads"], lambda e: F.struct((e["load"] - F.when(e["shard"] == lightest, x["minus"]).otherwise(0.0)).alias("load"), e["shard"].alias("shard")))
        return F.struct(loads.alias("loads"), F.concat(acc["placed"], F.array(lightest)).alias("placed"))

    start = F.struct(F.col("loads"), F.array().cast("array<int>").alias("placed"))
    folded = one.withColumn("placed", F.aggregate("moving", start, place, lambda acc: acc["placed"]))
    moved = F.zip_with("moving", "placed", lambda x, s: F.struct(x["virtual_slot"].alias("virtual_slot"), s.alias("shard")))
    return folded.select(
        (F.coalesce("version", F.lit(0)) + 1).alias("version"),
        F.explode(F.concat("kept", moved)).alias("e"),
    ).select("version", "e.virtual_slot", "e.shard")


def store_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Writes one version beside the others; a retry replaces it whole."""
    slot_map.select("virtual_slot", "shard").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema("virtual_slot int, shard int").parquet(f"{path}/version={version}").withColumn("version", F.lit(version))


def latest_version(spark: SparkSession, path: str) -> int:
    """The highest stored version; 0 where there is no map."""
    try:
        return spark.read.schema("virtual_slot int, shard int, version int").parquet(path).agg(F.max("version")).first()[0] or 0
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return 0
        raise


def unevenness(slot_map: DataFrame, sizes: DataFrame, n_shards: int) -> tuple[float, int]:
    """How far the largest shard is over the mean, as a part of the mean, and
    slots on shards that are no more."""
    size = F.coalesce(F.col("slot_bytes"), F.lit(0))
    by = slot_map.join(sizes, "virtual_slot", "left").groupBy("shard").agg(F.sum(size).alias("b"), F.count(F.lit(1)).alias("slots"))
    one = by.agg(F.max("b").alias("most"), F.sum("b").alias("total"), F.sum(F.when(F.col("shard") >= n_shards, F.col("slots")).otherwise(0)).alias("gone")).first()
    return (one.most * n_shards / one.total - 1 if one.total else 0.0), one.gone or 0


def current_map(spark: SparkSession, sizes: DataFrame, path: str, n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> DataFrame:
    """The map for these sizes: the latest stored version, edited if need be.

    Edits go on while each lowers the largest shard by more than ``TOLERANCE``
    of the mean, or empties shards that are no more; what comes of them is stored
    as the next version.  So a second run over the same records edits nothing.
    """
    version = latest_version(spark, path)
    if not version:
        version = 1
        store_map(first_map(spark, n_slots, n_shards), path, version)
    old = found = load_map(spark, path, version)
    apart, gone = unevenness(old, sizes, n_shards)
    while gone or apart > TOLERANCE:
        edited = staged(rebalance(found, sizes, n_shards))
        now = unevenness(edited, sizes, n_shards)[0]
        if not gone and now > apart - TOLERANCE:
            break
        found, apart, gone = edited, now, 0
    if found is old:
        return old
    store_map(found, path, version + 1)
    return load_map(spark, path, version + 1)


def assign(records: DataFrame, slot_map: DataFrame, sizes: DataFrame) -> DataFrame:
    """``shard`` and ``slot``, the gapless place within the shard.

    Places come from row numbers within each virtual slot plus the rows of the
    shard's earlier slots, so that no task ever sorts a whole shard.  The map
    has ``n_slots`` rows, a fixed bound, and is broadcast.
    """
    rows = F.coalesce(F.col("slot_rows"), F.lit(0))
    before = F.sum(rows).over(W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1))
    places = slot_map.join(sizes, "virtual_slot", "left").select("virtual_slot", "shard", F.coalesce(before, F.lit(0)).alias("before"))
    at = F.row_number().over(W.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size"))
    return records.withColumn("at", at).join(F.broadcast(places), "virtual_slot").withColumn("slot", F.col("before") + F.col("at") - 1).drop("at", "before")


def shard_documents(docs: DataFrame, n_slots: int = N_SLOTS, n_shards: int = N_SHARDS, map_path: str | None = None) -> DataFrame:
    """Puts all rows into shards of near equal bytes; see the module's text.

    ``size`` is the text's UTF-8 bytes plus 1 (null text: 1).  The map's
    versions lie under ``map_path`` (None: a new folder, whose version 1 deals
    slots evenly); see :func:`current_map`.
    """
    spark = docs.sparkSession
    text = F.col("text")
    records = staged(docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).cast("long").alias("text_crc32"),
        virtual_slot(F.col("doc_id"), text, n_slots=n_slots).alias("virtual_slot"),
    ))
    sizes = staged(slot_bytes(records))
    return assign(records, current_map(spark, sizes, map_path or shared_dir(spark), n_slots, n_shards), sizes)


def op5_fixed_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in shards 0 to 15 under the law ``bytes``."""
    return shard_documents(documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )
