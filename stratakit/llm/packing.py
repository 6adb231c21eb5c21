"""Mixture-controlled packing by deficit round-robin over source queues.

Each source is a queue of its documents' tokens, cut into runs of ``LUMP``
tokens.  In every round a queue earns a quantum, its target share of one window,
and serves whole runs while its deficit covers them; what it can't serve yet
carries on over windows and partitions.  A queue's ``k``-th run is thus served
in the round in which the earned tokens first reach ``(k + 1) * LUMP``, so each
run's round is known from its number alone.  Runs of one round go in order of
the time at which they were earned; full runs fill the stream of windows
without a gap, since ``LUMP`` divides the window.  Between two windows a queue
has served within one run of what it has earned.

The last, shorter run of each queue and partition follows after all full runs,
dealt by the same rule; a window's end cuts these.  Queues of weight 0 follow
those with a weight.  Only the last window is padded.

Rows: null text is an empty document (its end id only); null source is a queue
of its own, and there is no bound on the number of queues; repeated rows are
packed one by one; an empty table gives an empty result; texts of any length
are cut freely.  Only named columns are read.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from stratakit.llm.common import documents, few_at_once, running_before, staged

WINDOW = 2048
END_ID = 1
#: Tokens that a queue serves at once.
LUMP = 128
#: Words kept in each worker's table of encoded words.
CACHE_WORDS = 300_000
_RUN = re.compile(r"\s\s")
#: A start between 0 and 1 of each queue's first deficit, so that equal queues don't all serve in the same round.
_GOLDEN = 0.6180339887498949


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def split_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


class WordEncoder(dict):
    """Encodes texts through a table of encoded words.

    The tokenizer never joins a word to the space after it, so a text in which
    white space stands alone is encoded word by word, each with the space
    before it.  Other texts are encoded whole.  Both give the same ids.  The
    vocabulary's added tokens, by content, cut a text and stand for themselves.
    """

    def __init__(self, path: str, pattern: str, limit: int = CACHE_WORDS, added: dict[str, int] | None = None):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
        self.encode, self.limit = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary, limit
        self.added = {k: np.array([v], dtype="<u4").tobytes() for k, v in (added or {}).items()}
        self.cut = re.compile(f"({'|'.join(map(re.escape, sorted(self.added, key=len, reverse=True)))})") if self.added else None

    @staticmethod
    def of(vocabulary: str, ranks: str, pattern: str, limit: int = CACHE_WORDS) -> WordEncoder:
        """``vocabulary``: the tokenizer's own file, which names its added tokens."""
        with open(vocabulary, encoding="utf-8") as f:
            added = json.load(f)["added_tokens"]
        return WordEncoder(ranks, pattern, limit, {x["content"]: x["id"] for x in added})

    def whole(self, text: str) -> bytes:
        return np.array(self.encode(text), dtype="<u4").tobytes()

    def __missing__(self, word: str) -> bytes:
        ids = self.whole(" " + word)
        if len(self) < self.limit:
            self[word] = ids
        return ids

    def plain(self, text: str) -> bytes:
        if _RUN.search(text):
            return self.whole(text)
        first, *words = text.split(" ")
        return self.whole(first) + b"".join(map(self.__getitem__, words))

    def ids(self, text: str) -> bytes:
        if self.cut is None or not self.cut.search(text):
            return self.plain(text)
        return b"".join(self.added[x] if x in self.added else self.plain(x) for x in self.cut.split(text) if x)


class Queues:
    """The runs of one part's queues, filled document by document."""

    def __init__(self, lump: int):
        self.lump, self.size = lump, 4 * lump
        #: Of each source: its number, bytes so far, and the pieces of its open run.
        self.of: dict = {}

    def add(self, doc: tuple, ids: bytes) -> Iterator[tuple]:
        """The pieces that are in full runs now: ``doc, queue, run, start, length, crc, None``."""
        at, n = 0, len(ids)
        queue = self.of.setdefault(doc[1], [len(self.of), 0, []])
        while at < n:
            run, within = divmod(queue[1], self.size)
            end = min(n, at + self.size - within)
            piece = ids[at:end]
            queue[1] += end - at
            row = (*doc, queue[0], run, at // 4, (end - at) // 4, zlib.crc32(piece))
            if end - at < self.size:
                queue[2].append((row, piece))
            if queue[1] % self.size == 0:
                yield from ((*old, within_, None) for old, within_ in self.closed(queue)) if queue[2] else ((*row, 0, None),)
            at = end

    def closed(self, queue: list) -> Iterator[tuple[tuple, int]]:
        within = 0
        for row, _ in queue[2]:
            yield row, within
            within += row[6]
        queue[2] = []

    def rest(self) -> Iterator[tuple]:
        """The pieces of runs that stay short, with their ids."""
        for queue in self.of.values():
            within = 0
            for row, piece in queue[2]:
                yield (*row, within, piece)
                within += row[6]


def cut_runs(docs: DataFrame, lump: int = LUMP, vocabulary: str | None = None, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """Pieces of documents in their queues' runs: ``doc_id, source, doc_tokens,
    part, queue, run, start, length, ids_crc32, within, ids``.

    ``part`` is the task's share of the input, ``queue`` numbers its sources,
    ``run`` the runs of a queue; ``ids`` (little-endian unsigned 32-bit numbers)
    only of short last runs.  Ids end with the end id.
    """
    vocabulary, ranks, pattern = vocabulary or vocabulary_path(), ranks or ranks_path(), pattern or split_pattern()
    schema = docs.select("doc_id", "source").schema
    kinds = (("doc_tokens", "long", pa.int64()), ("queue", "integer", pa.int32()), ("run", "long", pa.int64()), ("start", "long", pa.int64()), ("length", "integer", pa.int32()), ("ids_crc32", "long", pa.int64()), ("within", "integer", pa.int32()), ("ids", "binary", pa.binary()))
    for name, kind, _ in kinds:
        schema = schema.add(name, kind)
    schema = schema.add("part", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, queues, part = WordEncoder.of(vocabulary, ranks, pattern), Queues(lump), TaskContext.get().partitionId()
        end, types = np.array([END_ID], dtype="<u4").tobytes(), None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([*(pa.array(c, t) for c, t in zip(columns, types)), pa.array(np.full(len(rows), part))], names=schema.names)

        for batch in few_at_once(batches):
            types = [batch.schema.field("doc_id").type, batch.schema.field("source").type, *(t for _, _, t in kinds)]
            rows = []
            for i, s, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "source", "text"))):
                ids = encoder.ids(text or "") + end
                rows.extend(queues.add((i, s, len(ids) // 4), ids))
                if len(rows) > 10_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)
        if rows := list(queues.rest()):
            yield batch_of(rows)

    return docs.select("doc_id", "source", "text").mapInArrow(run, schema)


def shares(sources: DataFrame, weights: dict | None) -> DataFrame:
    """``sources`` with ``share``, a queue's part of a window, and ``last``, true
    for queues without a weight: they are served after the others, by their sizes."""
    weight = F.col("total").cast("double")
    last = F.lit(False)
    if weights is not None:
        if any(w < 0 for w in weights.values()):
            raise ValueError("a weight is below 0")
        kind = T.StructType().add("w_", sources.schema["source"].dataType).add("named", "double")
        named = sources.sparkSession.createDataFrame([(k, float(w)) for k, w in weights.items()], kind)
        sources = sources.join(named, F.col("source").eqNullSafe(F.col("w_")), "left")
        last = F.coalesce(F.col("named") <= 0, F.lit(True))
        weight = F.when(last, weight).otherwise(F.col("named"))
    rows = sources.withColumn("last", last).withColumn("weight", weight)
    sums = rows.groupBy(F.col("last").alias("l_")).agg(F.sum("weight").alias("all_weights"))
    return rows.join(F.broadcast(sums), F.col("last") == F.col("l_")).select("source", "last", (F.col("weight") / F.col("all_weights")).alias("share"))


def places(runs: DataFrame, weights: dict | None, window: int = WINDOW, lump: int = LUMP) -> DataFrame:
    """``part, queue, run, place``: where each run begins in the stream.

    ``runs``: ``source, part, queue, n_full, tail``, a row for each queue of a part.
    """
    totals = runs.groupBy("source").agg(F.sum(F.col("n_full") * lump + F.col("tail")).alias("total"))
    known = staged(shares(totals, weights)).select(F.col("source").alias("s_"), "last", "share")
    full = runs.where("n_full > 0")
    full = running_before(full, [F.col("source")], "part", F.col("n_full"), "first")
    full = full.select("source", "part", "queue", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_full") - 1)).alias("run"))
    full = full.select("source", "part", "queue", "run", F.lit(lump).alias("length"), ((F.col("first") + F.col("run") + 1) * lump).alias("earned"), F.lit(False).alias("short"))
    tails = running_before(runs.where("tail > 0"), [F.col("source")], "part", F.col("tail"), "first")
    tails = tails.select("source", "part", "queue", F.col("n_full").alias("run"), F.col("tail").alias("length"), (F.col("first") + F.col("tail")).alias("earned"), F.lit(True).alias("short"))
    phase = F.pmod(F.pmod(F.xxhash64("source"), F.lit(1 << 20)) * _GOLDEN, F.lit(1.0)) * lump
    when = (F.col("earned") - F.least(phase, F.col("earned") * 0.5)) / (F.col("share") * window)
    items = full.unionByName(tails).join(known, F.col("source").eqNullSafe(F.col("s_")))
    items = items.select("part", "queue", "run", "length", "short", "last", when.alias("time"), F.floor(when).alias("round"))
    rounds = items.groupBy("short", "last", "round").agg(F.sum("length").alias("tokens"))
    rounds = running_before(rounds, [F.col("short"), F.col("last")], "round", F.col("tokens"), "before")
    # At most four sections: full runs, then short ones, each with the queues of weight 0 behind.
    section = rounds.groupBy("short", "last").agg(F.sum("tokens").alias("all"))
    section = section.select(F.col("short").alias("t_"), F.col("last").alias("l_"), (F.sum("all").over(W.orderBy("short", "last")) - F.col("all")).alias("base"))
    rounds = rounds.join(F.broadcast(section), (F.col("short") == F.col("t_")) & (F.col("last") == F.col("l_")))
    rounds = rounds.select(F.col("short").alias("t_"), F.col("last").alias("l_"), F.col("round").alias("r_"), (F.col("base") + F.col("before")).alias("begin"))
    same = (F.col("short") == F.col("t_")) & (F.col("last") == F.col("l_")) & (F.col("round") == F.col("r_"))
    order = W.partitionBy("short", "last", "round").orderBy("time", "part", "queue", "run").rowsBetween(W.unboundedPreceding, 0)
    within = items.withColumn("upto", F.sum("length").over(order)).join(rounds, same)
    return within.select("part", "queue", "run", (F.col("begin") + F.col("upto") - F.col("length")).alias("place"))


def pack(docs: DataFrame, weights: dict | None = None, window: int = WINDOW, lump: int = LUMP, vocabulary: str | None = None, ranks: str | None = None, pattern: str | None = None) -> DataFrame:
    """One row for each piece; every token lies in exactly one.

    ``weights`` sets each source's share of a window; None takes the shares of
    the input, so that all queues run dry together.  ``lump`` divides
    ``window``.  Pieces, without their tokens, are staged once as Parquet and
    meet the places of their runs in one join.
    """
    if window % lump:
        raise ValueError("the window isn't a multiple of the run")
    pieces = staged(cut_runs(docs, lump, vocabulary, ranks, pattern))
    short = F.col("ids").isNotNull()
    runs = staged(pieces.groupBy("part", "queue").agg(
        F.first("source").alias("source"), F.coalesce(F.max(F.when(~short, F.col("run") + 1)), F.lit(0)).alias("n_full"), F.coalesce(F.sum(F.when(short, F.col("length"))), F.lit(0)).alias("tail")))
    found = places(runs, weights, window, lump)
    own = [F.col(c).alias(f"{c}_") for c in ("part", "queue", "run")]
    same = (F.col("part") == F.col("part_")) & (F.col("queue") == F.col("queue_")) & (F.col("run") == F.col("run_"))
    placed = pieces.join(found.select(*own, "place"), same).withColumn("at", F.col("place") + F.col("within"))
    # Only pieces of short runs can cross a window's end.
    ends = F.floor((F.col("at") + F.col("length") - 1) / window)
    cut = placed.withColumn("sequence_id", F.explode(F.sequence(F.floor(F.col("at") / window), ends)))
    begin = F.greatest("at", F.col("sequence_id") * window)
    cut = cut.withColumn("skip", (begin - F.col("at")).cast("int")).withColumn("took", (F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * window) - begin).cast("int"))
    crc: Column = F.when(F.col("took") == F.col("length"), F.col("ids_crc32")).otherwise(F.crc32(F.substring("ids", F.col("skip") * 4 + 1, F.col("took") * 4)))
    return cut.select(
        "doc_id", "source", (F.col("start") + F.col("skip")).alias("start"), F.col("took").cast("long").alias("length"), crc.alias("ids_crc32"), "doc_tokens", "sequence_id",
        (begin - F.col("sequence_id") * window).cast("long").alias("offset"),
    )


def op6_drr_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens; see :func:`pack`."""
    return pack(documents(spark, sf_dir))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents; rows as in :func:`pack`'s module text."""
    return pack(docs)
