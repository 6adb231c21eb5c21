"""Mixing sources to target weights by Sainte-Lague apportionment.

The mix is dealt in equal blocks of words.  Each source gets the number of
blocks that its highest quotients earn, each shard of a source (a seeded deal
of its documents) an integer quota of these in the same way, and blocks within
a shard are drawn in seeded order.  Where a source's target isn't a multiple
of the block, its last block is cut or stretched to meet it.  A shard gives no
row more than its cap, so a source at its cap may miss its target by half a
block a shard.

Rows: null text has size 0 and gives nothing; null source is a source of its
own, last in order; repeated rows count one by one; an empty table gives an
empty result.  Only columns named here are read, so extra columns don't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stratakit.llm.common import WORD, documents, staged

BLOCK_WORDS = 256
SHARD_WORDS = 2_000_000
#: Words of rows equal in id and size that are dealt together, at most (one row where it is longer).
STACK_WORDS = 16_384
SEED = 11
WEIGHTS = (3, 1, 2)


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """``source, source_size`` -> plus ``weight, target``: shares by weight, each
    at most ``cap`` times its source, the excess reshared until none is above.

    In order of cap per weight, the sources before some point stop at their
    caps and the rest share by weight what is left: found by running sums.
    The table has one row for each source.
    """
    nth = F.row_number().over(W.orderBy(F.asc_nulls_last("source")))
    weighed = sources.withColumn("nth", nth).withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("nth") - 1, F.lit(len(weights))) + 1).cast("int")).cast("double"))
    top = F.col("source_size") * F.lit(cap)
    order = W.orderBy(top / F.col("weight"), "nth")
    earlier = order.rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    level = (F.sum("source_size").over(everything) * F.lit(share) - F.coalesce(F.sum(top).over(earlier), F.lit(0.0))) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
    levels = weighed.withColumn("k", F.row_number().over(order)).withColumn("level", level)
    first = F.min(F.when(F.col("level") * F.col("weight") <= top, F.struct("k", "level"))).over(everything)["level"]
    return levels.withColumn("first", first).select("source", "source_size", "weight", F.least(top, F.coalesce(F.col("first") * F.col("weight"), top)).alias("target"))


def apportion(rows: DataFrame, group: list[Column], weight: Column, seats: Column, tie: list[Column], name: str) -> DataFrame:
    """Adds the seats of each row by Sainte-Lague within ``group``.

    Rows surely get the seats well below their exact share; only seats close
    to it compete by quotient ``weight / (2 k + 1)``.  The window of doubt
    allows for every row's rounding, so the result is that of the full method
    with a few competing rows for each row.
    """
    w = W.partitionBy(*group)
    d = rows.withColumns({"_w": weight.cast("double"), "_seats": seats.cast("long")})
    d = d.withColumns({"_n": F.count(F.lit(1)).over(w), "_total": F.sum("_w").over(w)})
    exact = F.coalesce(F.try_divide(F.col("_w") * F.col("_seats"), F.col("_total")), F.lit(0.0))
    doubt = F.ceil(F.coalesce(F.try_divide(exact * F.col("_n"), 2 * F.col("_seats")), F.lit(0.0))) + 2
    d = d.withColumns({"_sure": F.greatest(F.lit(0), F.round(exact) - doubt).cast("long"), "_doubt": doubt.cast("long")})
    d = d.withColumn("_rest", F.col("_seats") - F.sum("_sure").over(w)).withColumn("_id", F.row_number().over(w.orderBy(*tie)))
    rivals = d.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), 2 * F.col("_doubt")))).where(F.col("_w") > 0)
    quotient = F.col("_w") / (2 * (F.col("_sure") + F.col("_k")) + 1)
    won = rivals.withColumn("_place", F.row_number().over(w.orderBy(F.desc(quotient), "_id", "_k"))).where(F.col("_place") <= F.col("_rest"))
    extra = won.groupBy(*[g.alias(f"_g{i}") for i, g in enumerate(group)], F.col("_id").alias("_won_id")).agg(F.count(F.lit(1)).alias("_extra"))
    same = F.col("_id") == F.col("_won_id")
    for i, g in enumerate(group):
        same = same & g.eqNullSafe(F.col(f"_g{i}"))
    out = d.join(extra, same, "left").withColumn(name, F.col("_sure") + F.coalesce("_extra", F.lit(0)))
    return out.drop("_w", "_seats", "_n", "_total", "_sure", "_doubt", "_rest", "_id", "_won_id", "_extra", *[f"_g{i}" for i in range(len(group))])


def lay(rows: DataFrame, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``rows`` (``doc_id, source, size, source_size`` and values of the source)
    with ``shard`` and ``start``, their words' place in the source's shard.

    Rows equal in all columns are dealt by the stack and parted within its shard,
    so one id, or the lack of one, may be any part of a source.
    """
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    stacks = rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")).withColumn("each", F.greatest(F.lit(1), F.expr(f"{STACK_WORDS} div size")))
    stacks = stacks.withColumn("stack", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(n - 1) div each"))))
    stacks = stacks.withColumn("n", F.least("each", F.col("n") - F.col("stack") * F.col("each")))
    dealt = stacks.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "size", "stack"), shards).cast("long"))
    order = W.partitionBy("source", "shard").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id", "size", "stack"), "doc_id", "size", "stack")
    words = F.col("size") * F.col("n")
    first = dealt.withColumn("first", F.sum(words).over(order.rowsBetween(W.unboundedPreceding, 0)) - words)
    laid = first.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    return laid.select(*rows.columns, "shard", (F.col("first") + F.col("nth") * F.col("size")).alias("start"))


def seated(rows: DataFrame, weights: tuple[int, ...], share: float, cap: float, block_words: int) -> DataFrame:
    """``rows`` (``source, size`` and more) with their source's ``source_size``,
    ``target`` and ``blocks``, the seats that its target earns by Sainte-Lague."""
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    blocks = F.round(F.sum("target").over(W.partitionBy()) / block_words)
    sources = staged(apportion(sources, [F.lit(0)], F.col("target"), blocks, [F.asc_nulls_last("source")], "blocks"))
    of = sources.select(F.col("source").alias("of"), "source_size", "target", "blocks")
    return rows.join(of, F.col("source").eqNullSafe(F.col("of")), "inner").drop("of")


def quotas(placed: DataFrame, cap: float, block_words: int) -> DataFrame:
    """``source, shard, cell`` (its words) and ``words``, what the mix takes of it:
    the source's blocks shared by Sainte-Lague among its shards, in words."""
    cells = placed.groupBy("source", "shard").agg(F.sum("size").alias("cell"), F.first("target").alias("target"), F.first("blocks").alias("blocks"))
    cells = apportion(cells, [F.col("source")], F.col("cell"), F.col("blocks"), [F.col("shard")], "quota")
    words = F.col("quota") * block_words + F.when(F.col("shard") == 0, F.round("target").cast("long") - F.col("blocks") * block_words).otherwise(0)
    words = F.least(F.greatest(words, F.lit(0)), F.floor(F.col("cell") * F.lit(cap)).cast("long"))
    return cells.where("cell > 0").select("source", "shard", "cell", words.alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """One row for each document: ``doc_id, source, size, source_size, target, taken``."""
    rows = staged(docs.select("doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    known = seated(rows, weights, share, cap, block_words)
    placed = staged(lay(known.where("size > 0"), shard_words, seed))
    cells = staged(quotas(placed, cap, block_words).select("source", "shard", "cell", F.expr("words div cell").alias("whole"), F.expr("words % cell").alias("part")))

    block = cells.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(cell - 1) div {block_words}"))).alias("block"))
    block = block.withColumn("length", F.least(F.lit(block_words).cast("long"), F.col("cell") - F.col("block") * block_words))
    cell = W.partitionBy("source", "shard")
    drawn = cell.orderBy(F.xxhash64(F.lit(seed + 2), "source", "shard", "block"), "block").rowsBetween(W.unboundedPreceding, 0)
    left = F.col("part") - (F.sum("length").over(drawn) - F.col("length"))
    block = block.withColumn("got", F.greatest(F.lit(0), F.least(left, F.col("length"))))
    block = block.withColumn("before", F.sum("got").over(cell.orderBy("block").rowsBetween(W.unboundedPreceding, 0)) - F.col("got"))
    ends = staged(block.select("source", "shard", "block", "got", "before"))

    def upto(frame: DataFrame, at: Column, more: int, name: str) -> DataFrame:
        """Words drawn in the cell before the place ``at + more``."""
        b = ends.select(F.col("source").alias("s_"), F.col("shard").alias("h_"), F.col("block").alias("b_"), "got", "before")
        f = frame.withColumn("at_", at).withColumn("in_", F.expr(f"at_ div {block_words}"))
        same = F.col("source").eqNullSafe(F.col("s_")) & (F.col("shard") == F.col("h_")) & (F.col("in_") == F.col("b_"))
        drawn = F.col("before") + F.least(F.col("got"), F.col("at_") - F.col("in_") * block_words + more)
        return f.join(b, same, "left").withColumn(name, drawn).drop("s_", "h_", "b_", "got", "before", "at_", "in_")

    # The last word's place stands for the end, so that both ends lie in a block.
    full = upto(placed, F.col("start"), 0, "lo")
    both = upto(full, F.col("start") + F.col("size") - 1, 1, "hi").withColumn("drawn", F.col("hi") - F.col("lo")).drop("lo", "hi")
    whole = cells.select(F.col("source").alias("s_"), F.col("shard").alias("h_"), "whole")
    both = both.join(whole, F.col("source").eqNullSafe(F.col("s_")) & (F.col("shard") == F.col("h_")), "left").withColumn("taken", F.col("whole") * F.col("size") + F.col("drawn"))
    names = ["doc_id", "source", "size", "source_size", "target", "taken"]
    return both.select(*names).unionByName(known.where("size = 0").withColumn("taken", F.lit(0).cast("long")).select(*names))


def op7_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole of ``documents`` mixed; see :func:`mix`."""
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "source")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, as often as the mix's words ask.

    Rows that share a ``doc_id`` are drawn one by one; see :func:`copies`.  They
    are dealt by id and text, so rows without ids spread over a source's shards
    (the stage before leaves one row of each text).
    """
    columns = docs.columns
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()))
    sizes = staged(rows.select("_row", "doc_id", "source", F.xxhash64("text").alias("_text"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")))
    kept = rows.join(copies(sizes).where("copies > 0").select(F.col("_row").alias("_id"), "copies"), F.col("_row") == F.col("_id"))
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*columns)


def copies(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS, seed: int = SEED) -> DataFrame:
    """``rows`` (``doc_id, source, size, _text`` and more) with ``source_size, target, copies``.

    Sources get blocks, and their shards quotas of these, by Sainte-Lague as in
    :func:`mix`.  What is drawn within a shard is whole documents instead of
    blocks, by systematic draws in order of size: the running sum of the shard's
    ratio of quota to size, from a seeded start, gives a document a copy for each
    whole number that it passes there.  So a document gets the ratio rounded down
    or up, the latter with the fraction as probability, and a shard's words at any
    stretch of sizes miss theirs by less than its longest document there (both
    ends of the stretch counted).
    """
    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")
    known = seated(rows, weights, share, cap, block_words)
    dealt = staged(known.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "_text"), shards).cast("long")))
    cells = quotas(dealt.where("size > 0"), cap, block_words)
    cells = staged(cells.select(F.col("source").alias("s_"), F.col("shard").alias("h_"), "cell", "words"))
    same = F.col("source").eqNullSafe(F.col("s_")) & (F.col("shard") == F.col("h_"))
    shard = W.partitionBy("source", "shard").orderBy("size", F.xxhash64(F.lit(seed + 1), "doc_id", "_text"), "doc_id", "_text")
    nth = F.count_if(F.col("size") > 0).over(shard.rowsBetween(W.unboundedPreceding, 0))
    full = dealt.withColumn("nth", nth).join(cells, same, "left").withColumn("begin", F.pmod(F.xxhash64(F.lit(seed + 3), "source", "shard"), F.col("cell")))
    drawn = F.expr("(begin + nth * words) div cell - (begin + (nth - 1) * words) div cell")
    return full.withColumn("copies", F.when(F.col("size") > 0, drawn).otherwise(0).cast("long")).drop("shard", "_text", "blocks", "nth", "begin", "s_", "h_", "cell", "words")
