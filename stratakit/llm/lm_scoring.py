"""Language-model scoring with a probabilistic suffix tree (PST) over words.

The symbols are a text's words and one end token.  A context is the one or two
tokens before a token (an end token stands before a text).  It is kept if it
comes ``LEAST`` times or more and its next-token distribution diverges from its
suffix's: coding its tokens by its own frequencies instead of its suffix's saves
``DIVERGENCE`` bits over the corpus; and if its suffix is kept.  Both bounds are
absolute, so the tree grows with the corpus.  Each token is scored by the
longest kept suffix of what stands before it.  Distributions are smoothed by
absolute discounting towards the suffix's; at the root words have their
frequencies less the share of new words (by Good and Turing), and that share is
spread over all strings by a byte model of the corpus' distinct words.  So the
probabilities of all strings after a context sum to one at most.

How it runs: texts are tokenised once into blocks, one row each, in a table
bucketed by block.  A block asks for the corpus counts of its distinct words,
word pairs, contexts and word triples: it sends them, as 64-bit hashes, in order
and packed, to shards of the hash; a shard adds up what all blocks sent and
answers each block in the order in which it asked.  What a context needs (kinds
of tokens after it, bits saved) is a sum over its distinct followers, each of
which the shard leaves to one block, so no task ever holds all followers of a
frequent word.  Blocks stay where they are; only questions and answers move.

Rows: null or empty text is the end token alone; null ``doc_id`` trains and
isn't held out; repeated rows count and score one by one; an empty table gives
an empty result; without training text all words are spelled, by uniform bytes.
Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratakit.llm.common import bucketed, documents, staged

#: Training tokens after a context that it needs, in a corpus of any size.
LEAST = 2
#: Bits that a context must save over the corpus.
DIVERGENCE = 16.0
#: Taken off each count, for the suffix's distribution.
DISCOUNT = 0.9
BLOCK_BYTES = 8_000_000
#: Training tokens for each shard of hashes.
SHARD_TOKENS = 2_000_000
END = b"\n"
#: Bits saved are added up in whole numbers of this part of a bit.
_PART = 256
_MIX = np.uint64(0x9E3779B97F4A7C15)
WORD, PAIR, NEAR, TRIPLE, FAR, GRAMS = range(6)  #: what blocks ask for; NEAR and FAR are contexts of one and two tokens, GRAMS what they tell of bytes


def _hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def _joined(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hashes of pairs of hashes."""
    h = (a ^ np.uint64(0xD6E8FEB86659FD93)) * _MIX + b
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _pressed(x: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), 8).T).tobytes(), codec="zstd", asbytes=True)


def _unpressed(x: bytes, size: int, kind: type = np.int64) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(x, 8 * size, codec="zstd", asbytes=True), np.uint8).reshape(8, size).T).view(kind).ravel()


# ---- blocks ---------------------------------------------------------------


def tokens_of(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """Of all texts: the word number of each token, end tokens included (number
    0), the words by falling frequency, and each text's tokens."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    real = pc.not_equal(flat, "")
    doc = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    coded = flat.filter(real).dictionary_encode()
    number, count = coded.indices.to_numpy(), np.bincount(doc, minlength=len(lists)) + 1
    order = np.argsort(-np.bincount(number, minlength=len(coded.dictionary)), kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    idx = np.zeros(len(number) + len(lists), dtype=np.int64)
    inside = np.ones(len(idx), dtype=bool)
    inside[np.cumsum(count) - 1] = False
    idx[inside] = rank[number]
    words = coded.dictionary.take(pa.array(order)).cast(pa.binary()).to_pylist()
    return idx, [END, *words], count


def trained(lengths: np.ndarray, held: np.ndarray) -> np.ndarray:
    return np.repeat(~held, lengths)


def blocks(docs: DataFrame, held_out) -> DataFrame:
    """One row a block: ids, which are held out, tokens a document, the packed
    token numbers, the words' hashes, and the words themselves, one after the
    other: those that no training text of the block has, and the others."""
    rows = docs.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    id_kind = rows.schema["doc_id"].dataType
    schema = T.StructType().add("part", "long").add("ids", T.ArrayType(id_kind)).add("held", T.ArrayType(T.BooleanType())).add("lengths", T.ArrayType(T.IntegerType()))
    schema = schema.add("size", "long").add("trained", "long").add("idx", "binary").add("kinds", "long").add("hashes", "binary").add("new_words", "binary").add("old_words", "binary")

    def block(part: int, ids: pa.Array, held: np.ndarray, texts: pa.Array) -> pa.RecordBatch:
        idx, words, lengths = tokens_of(texts)
        own = np.bincount(idx[trained(lengths, held)], minlength=len(words))
        hashes = np.fromiter(map(_hash, words), dtype=np.uint64, count=len(words))
        new, old = (b" ".join(w for w, n in zip(words, own) if (n > 0) == some and w != END) for some in (False, True))
        one = lambda x, t: pa.array([x], t)
        of = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        columns = [
            one(part, pa.int64()), of(ids), of(pa.array(held)), of(pa.array(lengths, pa.int32())), one(len(idx), pa.int64()), one(int(own.sum()), pa.int64()), one(_pressed(idx), pa.binary()),
            one(len(words), pa.int64()), one(hashes.tobytes(), pa.binary()), one(new, pa.binary()), one(old, pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, size = TaskContext.get().partitionId() << 24, [], 0
        for batch in batches:
            bytes_so_far = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False))
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(bytes_so_far, (bytes_so_far[lo - 1] if lo else 0) + BLOCK_BYTES - size, "right")))
                waiting.append(batch.slice(lo, hi - lo))
                size += int(bytes_so_far[hi - 1] - (bytes_so_far[lo - 1] if lo else 0))
                lo = hi
                if lo < batch.num_rows or size >= BLOCK_BYTES:
                    yield from made(part, waiting)
                    part, waiting, size = part + 1, [], 0
        if waiting:
            yield from made(part, waiting)

    def made(part: int, batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        get = lambda c: pa.concat_arrays(table.column(c).chunks)
        yield block(part, get("doc_id"), get("held_out").to_numpy(zero_copy_only=False), get("text"))

    return rows.mapInArrow(run, schema)


# ---- bytes of new words ---------------------------------------------------


def byte_triples(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Byte strings of length three, a space before and after each word, and how often they come."""
    text = np.frombuffer(b"  " + b"  ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = text[:-2] << 16 | text[1:-1] << 8 | text[2:]
    return np.unique(keys[text[1:-1] << 8 | text[2:] != 0x2020], return_counts=True)


class Spelling:
    """Probabilities of strings of bytes, each by the two before it, smoothed
    towards the one before it, all bytes, and the uniform."""

    def __init__(self, grams: np.ndarray, n: np.ndarray):
        self.levels = []
        for mask in (0xFFFFFF, 0xFFFF, 0xFF):
            keys, at = np.unique(grams & mask, return_inverse=True)
            count = np.bincount(at, n, len(keys))
            contexts, of = np.unique(keys >> 8, return_inverse=True)
            self.levels.append((mask, keys, count, contexts, np.bincount(of, count, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(float)))

    def log10(self, words: list[bytes]) -> np.ndarray:
        """Of each word and the space that ends it."""
        if not words:
            return np.zeros(0)
        text = np.frombuffer(b"  " + b"  ".join(words) + b" ", dtype=np.uint8).astype(np.int64)
        keys = text[:-2] << 16 | text[1:-1] << 8 | text[2:]
        p = np.full(len(keys), 1 / 256)
        for mask, known, count, contexts, total, kinds in reversed(self.levels):
            if not len(known):
                continue
            key = keys & mask
            at, of = np.minimum(np.searchsorted(known, key), len(known) - 1), np.minimum(np.searchsorted(contexts, key >> 8), len(contexts) - 1)
            n, here = np.where(known[at] == key, count[at], 0), contexts[of] == key >> 8
            p = np.where(here, (n + kinds[of] * p) / (total[of] + kinds[of]), p)
        sizes = np.array([len(w) for w in words])
        begin = np.cumsum(sizes + 2) - sizes - 2
        inside = np.log10(p)
        inside[begin[1:] - 1] = 0  # the second space between two words
        return np.add.reduceat(inside, begin)


# ---- questions and answers ------------------------------------------------


class Asked:
    """Distinct hashes of one kind in a block, in the order in which it asks."""

    def __init__(self, hashes: np.ndarray, shards: int):
        self.keys, at = np.unique(hashes, return_inverse=True)
        self.at = at.astype(np.int32)
        bits = min(64, 44 + shards.bit_length())
        self.short = self.keys >> np.uint64(64 - bits)  # enough to tell a shard's hashes apart
        shard = ((self.keys >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        self.cuts = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard)) if len(shard) else np.zeros(1, np.int64)
        self.shard = shard[self.cuts[:-1]].astype(np.int64)

    def rows(self, part: int, kind: int, first: np.ndarray, second: np.ndarray | None = None) -> Iterator[tuple]:
        """``kind, shard, part, size, keys, first, second``: a message for each shard."""
        second = np.zeros(len(first), np.int64) if second is None else second
        for s, a, b in zip(self.shard.tolist(), self.cuts[:-1].tolist(), self.cuts[1:].tolist()):
            yield kind, s, part, b - a, _pressed(np.diff(self.short[a:b].astype(np.int64), prepend=np.int64(0))), _pressed(first[a:b].astype(np.int64)), _pressed(second[a:b])


_QUESTION = "kind int, shard long, part long, size long, keys binary, first binary, second binary"
_ANSWER = "kind int, shard long, part long, size long, answer binary, distinct long, once long"


def answered(questions: DataFrame) -> DataFrame:
    """What all blocks sent, added up by hash: for each message twice the sum of
    ``first`` and one more where this message is the first with any (counts), or
    where the sum of ``second`` reaches the test (contexts).  A shard's message
    to no block (-1) tells how many hashes it has, and how many came once.  Of byte
    triples only their sums come back, to no block (triples -1, counts -2)."""

    def run(group: pa.Table) -> pa.Table:
        kind, sizes = group.column("kind")[0].as_py(), group.column("size").to_numpy()
        get = lambda c: [_unpressed(x, k) for x, k in zip(group.column(c).to_pylist(), sizes.tolist())]
        keys, first = np.concatenate([np.cumsum(x) for x in get("keys")]), np.concatenate(get("first"))
        order = np.argsort(keys, kind="stable")
        head = np.append(True, keys[order][1:] != keys[order][:-1])
        nth = np.cumsum(head) - 1
        total = np.bincount(nth, first[order]).astype(np.int64)
        if kind == GRAMS:
            shard = group.column("shard")[0].as_py()
            return table_of([(kind, shard, -1, len(total), _pressed(keys[order][head]), 0, 0), (kind, shard, -2, len(total), _pressed(total), 0, 0)])
        flag = np.zeros(len(keys), dtype=np.int64)
        if kind in (NEAR, FAR):
            saved = np.zeros(len(total), dtype=np.int64)
            np.add.at(saved, nth, np.concatenate(get("second"))[order])
            flag[order] = (saved >= DIVERGENCE * _PART)[nth]
        else:
            some = np.flatnonzero(first[order] > 0)
            flag[order[some[np.append(True, nth[some][1:] != nth[some][:-1])]] if len(some) else []] = 1
        answer = np.empty(len(keys), dtype=np.int64)
        answer[order] = 2 * total[nth]
        answer += flag
        ends = np.cumsum(sizes)
        rows = [(kind, s, p, k, _pressed(answer[e - k : e]), 0, 0) for s, p, k, e in zip(group.column("shard").to_pylist(), group.column("part").to_pylist(), sizes.tolist(), ends.tolist())]
        rows.append((kind, group.column("shard")[0].as_py(), -1, 0, b"", int((total > 0).sum()), int((total == 1).sum())))
        return table_of(rows)

    def table_of(rows: list[tuple]) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()))], names=[x.split(" ")[0] for x in _ANSWER.split(", ")])

    return questions.groupBy("kind", "shard").applyInArrow(run, _ANSWER)


class Block:
    """A block's tokens, what it asks, and what it makes of the answers."""

    def __init__(self, row: dict, shards: int, tokens: int, answers: pa.Table | None = None):
        self.part, self.tokens = row["part"], tokens
        lengths, held = np.array(row["lengths"]), np.array(row["held"], dtype=bool)
        idx = _unpressed(row["idx"], row["size"])
        hashes = np.frombuffer(row["hashes"], dtype=np.uint64)
        self.train, self.first = trained(lengths, held), np.zeros(len(idx), dtype=bool)
        self.starts = np.cumsum(lengths) - lengths
        self.first[self.starts] = True
        self.shards, self.answers = shards, answers
        own = np.bincount(idx[self.train], minlength=len(hashes))
        self.word = Asked(hashes, shards)
        self.place = self.word.at
        self.word.own = np.bincount(self.place, own, len(self.word.keys)).astype(np.int64)
        self.word.at = self.place[idx]
        token = hashes[idx]
        before = np.roll(token, 1)
        before[self.first] = hashes[0]
        self.pair = self.asked(_joined(before, token))
        self.new_words, self.new_at = row["new_words"], np.flatnonzero(own[1:] == 0) + 1
        self.old_words, self.old_at = row.get("old_words"), np.flatnonzero(own[1:]) + 1
        idx = idx.astype(np.int32)
        self.idx, self.token, self.ended = idx, token, np.roll(idx, 1) * ~self.first
        self.hashes = hashes

    def asked(self, hashes: np.ndarray, where: np.ndarray | None = None) -> Asked:
        """The distinct hashes of the tokens (of those in ``where``) and their training counts."""
        found = Asked(hashes if where is None else hashes[where], self.shards)
        found.own = np.bincount(found.at[self.train if where is None else self.train[where]], minlength=len(found.keys))
        return found

    def answer(self, kind: int, size: int) -> tuple[np.ndarray, np.ndarray]:
        """The sums and flags of all hashes of a kind."""
        rows = self.answers.filter(pc.equal(self.answers.column("kind"), kind)).sort_by("shard")
        parts = [_unpressed(x, k) for x, k in zip(rows.column("answer").to_pylist(), rows.column("size").to_pylist())]
        found = np.concatenate([np.zeros(0, np.int64), *parts])
        assert len(found) == size
        return found >> 1, found & 1

    def counts(self) -> Iterator[tuple]:
        """First questions: words and pairs."""
        yield from self.word.rows(self.part, WORD, self.word.own)
        yield from self.pair.rows(self.part, PAIR, self.pair.own)

    def near(self) -> None:
        """What the answers to :meth:`counts` tell of each token."""
        c, self.owns1 = self.answer(WORD, len(self.word.keys))
        self.c = c[self.word.at]
        self.of_near = self.place[self.ended]  # the word before, as a context
        self.n1 = c[self.of_near]
        c2, self.owns2 = self.answer(PAIR, len(self.pair.keys))
        self.c2_of, self.c2 = c2, c2[self.pair.at]
        # Two tokens as a context: the pair that ended one token earlier.
        self.of_far = np.roll(self.pair.at, 1)
        n2 = np.where(self.first, 0, c2[self.of_far])
        self.may = (n2 >= LEAST) & (n2 * np.log2(np.maximum(self.n1, 1)) >= DIVERGENCE)
        self.n2 = n2
        pairs = _joined(self.pair.keys[self.of_far], self.token)
        self.where = np.flatnonzero(self.may)
        self.triple = self.asked(pairs, self.where)

    def saved(self, asked: Asked, owns: np.ndarray, total: np.ndarray, context: np.ndarray, size: int, where: np.ndarray | None, n: np.ndarray, above: np.ndarray, n_above: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each context: its distinct followers that are this block's to count, and the bits they save."""
        some = np.empty(len(asked.keys), dtype=np.int64)
        some[asked.at] = np.arange(len(asked.at))  # a token for each hash
        own = np.flatnonzero((owns > 0) & (total > 0))
        t = some[own] if where is None else where[some[own]]
        mine = n[t] >= LEAST
        own, t = own[mine], t[mine]
        bits = total[own] * np.log2(total[own] / n[t] * n_above[t] / above[t])
        kinds, saved = np.bincount(context[t], minlength=size), np.zeros(size, dtype=np.int64)
        np.add.at(saved, context[t], np.rint(bits * _PART).astype(np.int64))
        return kinds, saved

    def grams(self) -> Iterator[tuple]:
        """Byte triples of those distinct words that are this block's to count."""
        words = self.old_words.split(b" ") if self.old_words else []
        keys, n = byte_triples([w for w, own in zip(words, self.owns1[self.place[self.old_at]]) if own])
        cuts = np.searchsorted(keys, np.arange(257) << 16)
        for shard, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                yield GRAMS, shard, self.part, int(b - a), _pressed(np.diff(keys[a:b], prepend=np.int64(0))), _pressed(n[a:b].astype(np.int64)), _pressed(np.zeros(b - a, np.int64))

    def contexts(self) -> Iterator[tuple]:
        """Second questions: contexts of one token, and triples; and what bytes its words have."""
        self.near()
        yield from self.grams()
        size = len(self.word.keys)
        kinds, saved = self.saved(self.pair, self.owns2, self.c2_of, self.of_near, size, None, self.n1, self.c, np.full(len(self.c), self.tokens))
        yield from self.word.rows(self.part, NEAR, kinds, saved)
        yield from self.triple.rows(self.part, TRIPLE, self.triple.own)

    def far(self) -> Asked:
        """The contexts of two tokens that may be kept."""
        self.c3_of, self.owns3 = self.answer(TRIPLE, len(self.triple.keys))
        found = Asked(self.pair.keys[self.of_far[self.where]], self.shards)
        self.far_at = np.zeros(len(self.idx), dtype=np.int64)
        self.far_at[self.where] = found.at
        return found

    def far_contexts(self) -> Iterator[tuple]:
        """Third questions: contexts of two tokens."""
        self.near()
        found = self.far()
        kinds, saved = self.saved(self.triple, self.owns3, self.c3_of, self.far_at, len(found.keys), self.where, self.n2, self.c2, self.n1)
        yield from found.rows(self.part, FAR, kinds, saved)

    def scores(self, known: int, once: int, spelling: Spelling) -> tuple[np.ndarray, ...]:
        """Of each text: tokens, known tokens, base score, model score."""
        self.near()
        found = self.far()
        base = np.log10((self.c + 0.1) / (self.tokens + 0.1 * (known + 1)))
        unseen = (once + 1) / (self.tokens + 2)  # the share of new words
        spelled = np.zeros(len(self.hashes))
        spelled[self.new_at] = spelling.log10(self.new_words.split(b" ") if self.new_words else [])
        # New words, in no count, only multiply what is left for them by their spelling.
        more = np.where(self.c > 0, 0.0, np.log10(unseen) + spelled[self.idx])
        p = np.where(self.c > 0, (1 - unseen) * self.c / max(self.tokens, 1), 1.0)
        kinds, keep = self.answer(NEAR, len(self.word.keys))
        kept = (keep[self.of_near] > 0) & (self.n1 >= LEAST)
        p = np.where(kept, (np.maximum(self.c2 - DISCOUNT, 0) + DISCOUNT * kinds[self.of_near] * p) / np.maximum(self.n1, 1), p)
        kinds, keep = self.answer(FAR, len(found.keys))
        t = self.where[(keep[found.at] > 0) & kept[self.where]]
        c3 = np.zeros(len(self.idx), dtype=np.int64)
        c3[self.where] = self.c3_of[self.triple.at]
        p[t] = (np.maximum(c3[t] - DISCOUNT, 0) + DISCOUNT * kinds[self.far_at[t]] * p[t]) / self.n2[t]
        add = lambda x: np.add.reduceat(x, self.starts)
        return add(np.ones(len(p), np.int64)), add((self.c > 0).astype(np.int64)), add(base), add(np.log10(p) + more)


def score(docs: DataFrame, held_out) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``,
    and ``mean_score``, a token's; learnt from the rows where the condition
    ``held_out`` is false."""
    spark = docs.sparkSession
    state = bucketed(blocks(docs, held_out), "part")
    tokens = state.agg(F.sum("trained")).first()[0] or 0
    shards = max(16, tokens // SHARD_TOKENS)
    body = state.select("part", "lengths", "held", "size", "idx", "hashes", "new_words")
    names = [x.split(" ")[0] for x in _QUESTION.split(", ")]
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary())

    def sent(rows: Iterator[tuple]) -> pa.Table:
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [()] * len(kinds), kinds)], names=names)

    def counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from sent(Block(row, shards, tokens).counts()).to_batches()

    def ask(which: str):
        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            return sent(getattr(Block(left.to_pylist()[0], shards, tokens, right), which)()) if left.num_rows else sent(iter(()))

        return run

    first = staged(answered(body.mapInArrow(counts, _QUESTION)))
    one = first.where(f"kind = {WORD} and part = -1").agg(F.sum("distinct").alias("known"), F.sum("once").alias("once")).first()
    known, once = one.known or 0, one.once or 0
    to_block = ["part", "kind", "shard", "size", "answer"]
    answers = first.where("part >= 0").select(*to_block)
    with_words = state.select(*body.columns, "old_words")
    second = staged(answered(with_words.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(ask("contexts"), _QUESTION)))
    # Byte triples: at most 256 ** 3, whatever the corpus.
    grams = second.where(f"kind = {GRAMS}").orderBy("shard").select("part", "size", "answer").toPandas()
    keys, sums = (np.concatenate([np.zeros(0, np.int64), *(_unpressed(x, n) for p, n, x in grams.itertuples(index=False) if p == which)]) for which in (-1, -2))
    spelling = spark.sparkContext.broadcast(Spelling(keys, sums))
    answers = answers.unionByName(second.where("part >= 0").select(*to_block))
    third = answered(body.groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(ask("far_contexts"), _QUESTION))
    answers = answers.unionByName(staged(third.where("part >= 0").select(*to_block)))
    schema = docs.select("doc_id").schema.add("held_out", "boolean")
    for name, kind in (("n_tokens", "long"), ("n_known", "long"), ("train_tokens", "long"), ("base_score", "double"), ("score", "double")):
        schema = schema.add(name, kind)

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows:
            return pa.Table.from_arrays([pa.array([], left.schema.field("ids").type.value_type), *(pa.array([], t) for t in (pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()))], names=schema.names)
        ids = left.column("ids").chunk(0).flatten()
        n_tokens, n_known, base, own = Block(left.drop_columns(["ids"]).to_pylist()[0], shards, tokens, right).scores(known, once, spelling.value)
        return pa.Table.from_arrays([ids, left.column("held").chunk(0).flatten(), pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(own), tokens)), pa.array(base), pa.array(own)], names=schema.names)

    return state.select("part", "ids", "lengths", "held", "size", "idx", "hashes", "new_words").groupBy("part").cogroup(answers.groupBy("part")).applyInArrow(run, schema).withColumn("mean_score", F.col("score") / F.col("n_tokens"))


def op1_suffix_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; a tenth, by crc32 of ``doc_id``, is held out."""
    return score(documents(spark, sf_dir), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0)
