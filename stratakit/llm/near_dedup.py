"""Near-duplicate groups by fast similarity sketching, banding and exact checks.

Sketch: in round ``i`` every shingle is placed in a hashed bin with a value
that grows with ``i``; bins keep their least value.  A text needs only as many
rounds as fill all bins; from round ``BINS`` on each round fills one bin, so
every coordinate is filled after ``2 * BINS`` rounds at most.  Texts whose
sketches agree on a band of coordinates are candidates.

Candidates are confirmed on full shingle sets, without pairing off groups:
texts of equal sets form a class; in each band bucket the members are compared
with one leader, then, where a bucket still holds several components, with
leaders from outside its largest; what is outside the largest after these rounds
is compared with all members of the bucket, in blocks of bounded size.  So each
two candidates are compared or already connected.

Rows: null text, or text without a word, has no shingles and is linked with
nothing; null ``doc_id`` is linked with nothing and kept; rows repeated in full
are one class; different texts under one ``doc_id`` are linked by it; an empty
table gives an empty result.  Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.llm.common import documents, staged

SHINGLE_WORDS = 5
BINS, ROWS = 200, 5  #: 40 bands; a pair at 0.8 agrees on none with probability 1e-7
PERCENT = 80
#: Buckets of at most so many members are compared pair by pair; larger ones in blocks.
SMALL_BUCKET = 8
BLOCK_X, BLOCK_M = 64, 256
#: Rounds of comparisons with one leader a bucket, before what is left is compared in full.
LEADER_ROUNDS = 3
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: each input bit changes about half the output bits."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _U(0x9E3779B97F4A7C15))
_BASE = 0x5851F42D4C957F2D


def word_hashes(buffer: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of a buffer that ends in a space."""
    space = _SPACE[buffer]
    edge = np.diff(np.concatenate([[True], space]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    powers = np.full(len(buffer) + 1, _BASE, dtype=np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[buffer] * powers[:-1])])
    back = np.full(len(buffer) + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
    back[0] = 1
    return starts, mix((sums[ends] - sums[starts]) * np.cumprod(back)[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[bytes | None], words: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the ``words``-word shingles of each text; a
    shorter text is one shingle."""
    bodies = [(t or b"").lower() + b"\n" for t in texts]
    buffer = np.frombuffer(b"".join(bodies), dtype=np.uint8)
    starts, hashes = word_hashes(buffer)
    cuts = np.searchsorted(starts, np.cumsum([0, *map(len, bodies)]))
    n = max(0, len(hashes) - words + 1)
    full = np.full(n, words, dtype=np.uint64)
    for j in range(words):
        full = mix(full * _U(0x9E3779B97F4A7C15) + hashes[j : j + n])
    out = []
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(full[a : b - words + 1]))
        else:
            h = np.full(min(1, b - a), b - a, dtype=np.uint64)
            for j in range(a, b):
                h = mix(h * _U(0x9E3779B97F4A7C15) + hashes[j : j + 1])
            out.append(h)
    return out


def sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """Fast similarity sketches, one row for each non-empty set."""
    sizes = np.array([len(s) for s in sets])
    items, row = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
    out = np.full((len(sets), bins), np.iinfo(np.uint64).max, dtype=np.uint64)
    flat = out.ravel()
    for i in range(2 * bins):
        h = mix(items ^ _U((i + 1) * 0xD6E8FEB86659FD93 & (1 << 64) - 1))
        place = ((h & _U(0xFFFFFFFF)) * _U(bins) >> _U(32)).astype(np.int64) if i < bins else np.full(len(h), i - bins)
        np.minimum.at(flat, row * bins + place, _U(i << 32) | (h >> _U(32)))
        open_ = (out == np.iinfo(np.uint64).max).any(axis=1)
        if not open_.any():
            break
        left = open_[row]
        items, row = items[left], row[left]
    return out


def bands(sketch: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """64-bit keys of each sketch's bands."""
    parts = sketch.reshape(len(sketch), -1, rows)
    key = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for j in range(rows):
        key = mix(key * _U(0x9E3779B97F4A7C15) + parts[:, :, j])
    return key.astype(np.int64)


def sketched(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id, n_shingles, key1, key2, bands``; the keys are 128 bits of the set."""
    schema = docs.select("doc_id").schema
    for name, kind in (("n_shingles", "long"), ("key1", "long"), ("key2", "long"), ("bands", T.ArrayType(T.LongType()))):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(batch.column("text").to_pylist(), words)
                keys = set_keys(sets)
                real = [s for s in sets if len(s)]
                found = iter(bands(sketches(real))) if real else iter(())
                out = [next(found) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), *(pa.array(k, pa.int64()) for k in keys), pa.array(out, pa.list_(pa.int64()))], names=schema.names)

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(run, schema)


def full_sets(docs: DataFrame, words: int) -> DataFrame:
    """``key1, key2, n_shingles, items``: the shingle set of each text, and its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                sets = shingle_sets(batch.column("text").to_pylist(), words)
                one, two = set_keys(sets)
                yield pa.RecordBatch.from_arrays([pa.array(one, pa.int64()), pa.array(two, pa.int64()), pa.array([len(x) for x in sets], pa.int64()), pa.array([x.astype(np.int64) for x in sets], pa.list_(pa.int64()))], names=["key1", "key2", "n_shingles", "items"])

    return docs.select(F.col("text").cast("binary").alias("text")).mapInArrow(run, "key1 long, key2 long, n_shingles long, items array<long>")


def set_keys(sets: list[np.ndarray]) -> list[list[int]]:
    """Two 64-bit keys of each set."""
    return [[int(mix(s ^ _U(c)).sum().astype(np.int64)) if len(s) else 0 for s in sets] for c in (0x51ED270B, 0xA0761D64)]


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar enough."""
    left = sets.select(F.col("rep").alias("a"), F.col("items").alias("items_a"))
    right = sets.select(F.col("rep").alias("b"), F.col("items").alias("items_b"))
    both = pairs.join(right, "b").join(left, "a")
    same = F.size(F.array_intersect("items_a", "items_b"))
    return both.where(100 * same >= percent * (F.size("items_a") + F.size("items_b") - same)).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``rep, component``: each linked node's least reachable node.

    Alternates large stars (larger neighbours move to the least neighbour) and
    small stars (a node and its smaller neighbours do), each round a grouping
    and a join, until nothing changes.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = staged(small)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("rep"), F.col("v").alias("component"))
        state = now


def in_blocks(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between members ``x`` of a bucket and all its members of
    another component, block by block."""
    cut = lambda of, n: F.pmod(F.xxhash64("rep"), F.ceil(F.col(of) / n)).cast("int")
    every = lambda of, n: F.explode(F.sequence(F.lit(0), F.ceil(F.col(of) / n).cast("int") - 1))
    with_sets = mixed.join(sets, "rep").select("band", "rep", "component", "is_x", "n_x", "n_m", "items")
    xs = with_sets.where("is_x").select("band", cut("n_x", BLOCK_X).alias("i"), every("n_m", BLOCK_M).alias("j"), "rep", "component", "items")
    ms = with_sets.select(F.col("band").alias("band_m"), every("n_x", BLOCK_X).alias("i_m"), cut("n_m", BLOCK_M).alias("j_m"), *[F.col(c).alias(f"{c}_m") for c in ("rep", "component", "items")])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        found_a, found_b = [], []
        if left.num_rows and right.num_rows:
            (ids, comp, sets_x), (ids_m, comp_m, sets_m) = ((t.column(f"rep{m}").to_numpy(), t.column(f"component{m}").to_numpy(), [x.values.to_numpy() for x in t.column(f"items{m}")]) for t, m in ((left, ""), (right, "_m")))
            n_m = np.array([len(s) for s in sets_m])
            values, index = np.unique(np.concatenate(sets_m), return_inverse=True)
            starts = np.cumsum(n_m) - n_m
            for x, c, s in zip(ids, comp, sets_x):
                at = np.minimum(np.searchsorted(values, s), len(values) - 1)
                flag = np.zeros(len(values), dtype=np.int64)
                flag[at[values[at] == s]] = 1
                same = np.add.reduceat(flag[index], starts)
                near = (100 * same >= percent * (len(s) + n_m - same)) & (comp_m != c)
                found_a += [x] * int(near.sum())
                found_b += ids_m[near].tolist()
        return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})

    return xs.groupBy("band", "i", "j").cogroup(ms.groupBy("band_m", "i_m", "j_m")).applyInArrow(run, "a long, b long").distinct()


KEYS = ["key1", "key2", "n_shingles"]


def led(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between each bucket's leader and members of other components.

    ``members``: ``band, rep, n, weight, component, is_x``; leaders come from
    those that ``is_x`` (outside their bucket's largest component) if there are any.
    """
    top = F.max(F.struct("is_x", "weight", (-F.col("rep")).alias("minus"), "n", "component")).alias("top")
    leaders = members.groupBy("band").agg(top).select("band", (-F.col("top.minus")).alias("a"), F.col("top.n").alias("n_a"), F.col("top.component").alias("of_a"))
    enough = (100 * F.least("n", "n_a") >= percent * F.greatest("n", "n_a")) & (F.col("component") != F.col("of_a"))
    return confirmed(members.join(leaders, "band").where(enough).select("a", F.col("rep").alias("b")).distinct(), sets, percent)


def mixed_buckets(members: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets with several components: ``band, rep, n, weight,
    component, is_x, n_x, n_m``."""
    placed = members.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    by = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("k"))
    tops = by.groupBy("band").agg(F.count(F.lit(1)).alias("kinds"), F.sum("k").alias("n_m"), F.max(F.struct("k", "component")).alias("top")).where("kinds > 1")
    tops = tops.select("band", "n_m", (F.col("n_m") - F.col("top.k")).alias("n_x"), F.col("top.component").alias("largest"))
    return placed.join(tops, "band").select("band", "rep", "n", "weight", "component", (F.col("component") != F.col("largest")).alias("is_x"), "n_x", "n_m")


def near_groups(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row for each document."""
    rows = staged(sketched(docs, words))
    real = rows.where("n_shingles > 0 AND doc_id IS NOT NULL")
    # Numbered once and staged, so that later reads see the same numbers.
    classes = real.groupBy(*KEYS).agg(F.min("doc_id").alias("first_id"), F.min_by("bands", "doc_id").alias("bands"))
    classes = staged(classes.withColumn("rep", F.monotonically_increasing_id()))
    # Buckets with more than one class; a leader that shares most buckets.
    spread = classes.select("rep", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    sizes = spread.groupBy("band").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = spread.join(sizes, "band")
    members = staged(shared.join(shared.groupBy("rep").agg(F.sum("size").alias("weight")), "rep").select("band", "rep", "n", "weight"))
    needed = members.select("rep").distinct().join(classes, "rep").select("first_id", "rep", *KEYS)
    bodies = docs.select("doc_id", "text").join(needed, F.col("doc_id") == F.col("first_id"), "left_semi")
    sets = staged(full_sets(bodies, words).join(needed, KEYS).select("rep", "items").dropDuplicates(["rep"]))
    # Texts under one doc_id are one document.
    of_doc = real.select("doc_id", *KEYS).distinct().join(classes, KEYS).select("doc_id", "rep")
    several = of_doc.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z")).where("a <> z").select("doc_id", "a")
    links = staged(of_doc.join(several, "doc_id").where("a <> rep").select("a", F.col("rep").alias("b")))
    mixed = members.withColumns({"component": F.col("rep"), "is_x": F.lit(True)})
    found, n_links = None, -1
    for _ in range(LEADER_ROUNDS):
        links = staged(links.unionByName(led(mixed, sets, percent)).distinct())
        before, n_links = n_links, links.count()
        if n_links == before:
            break  # no link came, so components, buckets and leaders would be the last round's
        found = components(links)
        mixed = staged(mixed_buckets(members, found))
        if mixed.isEmpty():
            break
    # Buckets that hold more than one component still.
    few = mixed.where(f"n_m <= {SMALL_BUCKET}")
    other = few.select("band", F.col("rep").alias("b"), F.col("component").alias("of_b"), F.col("n").alias("n_b"))
    enough = (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")) & (F.col("component") != F.col("of_b"))
    pairs = few.where("is_x").join(other, "band").where(enough).select(F.least("rep", "b").alias("a"), F.greatest("rep", "b").alias("b")).distinct()
    more = staged(confirmed(pairs, sets, percent).unionByName(in_blocks(mixed.where(f"n_m > {SMALL_BUCKET}"), sets, percent)))
    if not more.isEmpty():
        found = components(links.unionByName(more))
    placed = classes.select(*KEYS, "rep", "first_id").join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    keys = placed.join(least, "component").select(*[F.col(c).alias(f"{c}_") for c in KEYS], "component_id")
    same = (F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()
    for c in KEYS:
        same &= F.col(c) == F.col(f"{c}_")
    out = rows.drop("bands").join(keys, same, "left").withColumn("component_id", F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def op2_similarity_sketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents on two-word shingles."""
    return near_groups(documents(spark, sf_dir), words=2)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates stays: the least ``doc_id``, null
    last.  Rows are told apart by a number of their own, so rows that repeat an
    id or have none are compared like others; rows without words all stay; no
    rows give none; other columns pass."""
    rows = staged(docs.withColumn("_row", F.monotonically_increasing_id()))
    groups = near_groups(rows.select(F.col("_row").alias("doc_id"), "text")).select(F.col("doc_id").alias("_of"), "component_id")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "_row")
    several = staged(rows.select("doc_id", "_row").join(groups, F.col("_row") == F.col("_of")))
    first = several.groupBy("component_id").agg(F.min_by("_row", order).alias("_kept"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # The rows that go are the fewer ones: staged, so that Spark needn't shuffle texts where they are few.
    gone = staged(several.join(first, "component_id").where("_of <> _kept").select("_of"))
    return rows.join(gone, F.col("_row") == F.col("_of"), "left_anti").select(*docs.columns)
