"""How two tokenizers' tokens of the same text meet: cuts, groups and links.

A is a byte-level BPE over a space and the text, B a piece BPE which adds that
space itself.  Byte offsets at which tokens of both end cut a text's tokens into
groups; the A and B tokens of a group are linked, each with each.  A pair of ids
counts in as many documents of the corpus as hold it linked.

The merge is in lockstep: one NumPy vector holds the A and B pointers of all
documents of a block.  In each step every document compares the ends of its two
tokens, moves the pointer whose token ends first, or both at a cut, and emits
the links of the group that the cut closed; finished documents are compacted
away.  Since words end in both tokenizers, a long document is cut at words into
several lanes of the vector, and a very long one into units of bounded size, so
that no block waits for one text, or holds it with all its tokens.

How it runs: neither tokenizer joins a word to the space after it, so texts are
cut at single spaces and each distinct word of a slab is encoded once.  A block
is a row: its documents' figures, its distinct id pairs with the documents that
hold each, and which of them each document has how often.  Only the distinct
pairs of blocks go to the corpus' counts and come back to their block.

Rows: null and empty texts, and those that a tokenizer doesn't give back byte by
byte, have no tokens: zeros and ''.  Repeated rows, and rows that share an id or
have none, are documents each.  An empty table gives an empty result.  Only
``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from stratakit.llm.common import documents, staged

#: Bytes of text whose distinct words are encoded together, that are merged together, and of one unit of a long text.
SLAB_BYTES, MERGE_BYTES, UNIT_BYTES = 8_000_000, 2_000_000, 2_000_000
#: Bytes of text of a block's documents.
BLOCK_BYTES = 8_000_000
#: A tokens after which a document goes on in another lane.
LANE = 256
_B_BITS, _PAIR_BITS = 15, 31

#: Bytes beside which a space is no cut: white space, and first or last bytes of white space in UTF-8.
_BEFORE, _AFTER = np.ones(256, dtype=bool), np.ones(256, dtype=bool)
for _x in (*range(0x09, 0x0E), *range(0x1C, 0x21)):
    _BEFORE[_x] = _AFTER[_x] = False
for _x in (*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF):
    _BEFORE[_x] = False
for _x in (0xC2, 0xE1, 0xE2, 0xE3):
    _AFTER[_x] = False


def tokenizer_paths() -> tuple[str, str, str]:
    """Ranks and split pattern of A's vocabulary, and B's model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, public_tokenizers.path("piece_bpe_32k.model")


def ragged(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``begin[k], begin[k] + 1, ...``, ``n[k]`` of them, for each k."""
    before = np.cumsum(n) - n
    return np.repeat(begin - before, n) + np.arange(int(n.sum()))


def spaces_to_cut(raw: np.ndarray) -> np.ndarray:
    """Where texts may be cut: at a space between two characters that aren't white space."""
    cut = np.zeros(len(raw), dtype=bool)
    if len(raw) > 2:
        cut[1:-1] = (raw[1:-1] == 0x20) & _BEFORE[raw[:-2]] & _AFTER[raw[2:]]
    return cut


class Pieces:
    """Encoded words: ids of word k at ``begin[k]``, ``n[k]`` of them."""

    def __init__(self, ids: np.ndarray, n: np.ndarray):
        self.ids, self.n, self.begin = ids, n, np.cumsum(n) - n


class Encoders:
    """Both tokenizers, and the bytes of each token.  Words are encoded with a
    space before them."""

    def __init__(self, ranks: str, pattern: str, model: str):
        with open(ranks, "rb") as f:
            known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.a = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        self.a_bytes = [b""] * (max(known.values()) + 1)
        for token, i in known.items():
            self.a_bytes[i] = token
        pieces = ((i, self.b.id_to_piece(i)) for i in range(self.b.get_piece_size()))
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        self.a_size, self.b_size = (np.array([len(x) for x in table], dtype=np.int32) for table in (self.a_bytes, self.b_bytes))

    def words_a(self, words: list[str], sizes: np.ndarray) -> Pieces:
        """All words at once, a line each; words with white space at an end, which could join a line's end, alone."""
        alone = np.fromiter((w[0].isspace() or w[-1].isspace() for w in words), dtype=bool, count=len(words))
        ids = self.a.encode_to_numpy("\n".join(" " + w for w, x in zip(words, alone) if not x), disallowed_special=()).astype(np.int32)
        ends, word_end = np.cumsum(self.a_size[ids]), np.cumsum(sizes[~alone] + 2) - 1
        last = np.searchsorted(ends, word_end)  # each word's last token
        begin = np.append(0, last[:-1] + 2)  # after the line's end
        n, out = np.zeros(len(words), dtype=np.int64), {}
        n[~alone] = last - begin + 1
        for k in np.flatnonzero(alone):
            out[k] = self.a.encode_ordinary(" " + words[k])
            n[k] = len(out[k])
        flat = np.empty(int(n.sum()), dtype=np.int32)
        at = np.cumsum(n) - n
        if len(begin):
            flat[ragged(at[~alone], n[~alone])] = ids[ragged(begin, n[~alone])]
        for k, x in out.items():
            flat[at[k] : at[k] + n[k]] = x
        return Pieces(flat, n)

    def words_b(self, words: list[str]) -> Pieces:
        found = self.b.encode(words, num_threads=1)
        n = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return Pieces(np.fromiter(chain.from_iterable(found), dtype=np.int32, count=int(n.sum())), n)

    def faithful(self, words: list[str], *found: Pieces) -> np.ndarray:
        """Which words both give back byte by byte."""
        want, good = [b" " + w.encode() for w in words], np.ones(len(words), dtype=bool)
        size = np.fromiter(map(len, want), dtype=np.int64, count=len(want))
        for pieces, table, sizes in zip(found, (self.a_bytes, self.b_bytes), (self.a_size, self.b_size)):
            ends = np.append(0, np.cumsum(sizes[pieces.ids]))
            same = ends[pieces.begin + pieces.n] - ends[pieces.begin] == size
            if same.all() and b"".join(map(table.__getitem__, pieces.ids.tolist())) == b"".join(want):
                continue
            for k, w in enumerate(want):
                good[k] &= b"".join(table[i] for i in pieces.ids[pieces.begin[k] : pieces.begin[k] + pieces.n[k]]) == w
        return good


# ---- merging ---------------------------------------------------------------


def lockstep(a_end: np.ndarray, b_end: np.ndarray, i: np.ndarray, i_stop: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Groups as ``first A, last A, first B, last B`` tokens, step by step.

    Lane k merges the A tokens from ``i[k]`` to before ``i_stop[k]`` with the B
    tokens from ``j[k]``, whose last ends where the lane's last A token does.
    """
    i, j = i.copy(), j.copy()
    i_from, j_from = i.copy(), j.copy()
    while len(i):
        a, b = a_end[i], b_end[j]
        cut = np.flatnonzero(a == b)
        i_cut, j_cut = i[cut], j[cut]
        if len(cut):
            yield i_from[cut], i_cut, j_from[cut], j_cut
        i += a <= b
        j += b <= a
        i_from[cut], j_from[cut] = i_cut + 1, j_cut + 1
        if (i_cut + 1 == i_stop[cut]).any():
            left = np.flatnonzero(i < i_stop)
            i, j, i_from, j_from, i_stop = i[left], j[left], i_from[left], j_from[left], i_stop[left]


def links_of(i_from: np.ndarray, i: np.ndarray, j_from: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The A and B tokens of all links of some groups."""
    n_a, n_b = i - i_from + 1, j - j_from + 1
    n = n_a * n_b
    one = n == 1
    if one.all():
        return i, j
    group, within = np.repeat(np.arange(len(n)), n), ragged(np.zeros(len(n), dtype=np.int64), n)
    return i_from[group] + within // n_b[group], j_from[group] + within % n_b[group]


_DIGITS = np.zeros((1 << 16, 6), dtype=np.uint8)
for _x in range(5):
    _DIGITS[:, 4 - _x] = np.where(np.arange(1 << 16) >= (10**_x if _x else 0), np.arange(1 << 16) // 10**_x % 10 + 48, 0)
_N_DIGITS = (_DIGITS != 0).sum(axis=1)


def written(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All groups as ``a1,a2|b1;``, and where each token's text ends, in that order."""
    a_marks, b_marks = np.flatnonzero(a_cut), np.flatnonzero(b_cut)
    at_a = np.arange(len(a)) + np.append(0, b_marks[:-1] + 1)[np.cumsum(a_cut) - a_cut]
    at_b = np.arange(len(b)) + (a_marks + 1)[np.cumsum(b_cut) - b_cut]
    ids, after = np.empty(len(a) + len(b), dtype=np.int32), np.empty(len(a) + len(b), dtype=np.uint8)
    ids[at_a], ids[at_b] = a, b
    after[at_a], after[at_b] = np.where(a_cut, ord("|"), ord(",")), np.where(b_cut, ord(";"), ord(","))
    text = _DIGITS[ids]
    text[:, 5] = after
    return text[text != 0].tobytes(), np.cumsum(_N_DIGITS[ids] + 1)


class Unit:
    """A stretch of a document, with what alignment finds in it."""

    __slots__ = ("doc", "data", "last", "n_a", "n_b", "n_groups", "text", "pairs", "times")

    def __init__(self, doc: int, data: bytes, last: bool):
        self.doc, self.data, self.last, self.n_a, self.pairs = doc, data, last, 0, None


def units_of(doc: int, data: bytes, size: int = 0) -> Iterator[Unit]:
    """A text in one unit, or a long one cut at words."""
    size = size or UNIT_BYTES
    at = 0
    while len(data) - at > size:
        upto = at + size
        while True:
            found = np.flatnonzero(spaces_to_cut(np.frombuffer(data[at:upto], dtype=np.uint8)))
            if len(found) or upto >= len(data):
                break
            upto += size
        if not len(found):
            break
        yield Unit(doc, data[at : at + int(found[-1])], False)
        at += int(found[-1]) + 1
    yield Unit(doc, data[at:], True)


def align(units: list[Unit], encoders: Encoders) -> None:
    """Fills in the units of one slab; those not given back byte by byte keep ``pairs = None``."""
    raw = np.frombuffer(b"".join(u.data for u in units), dtype=np.uint8)
    size = np.array([len(u.data) for u in units], dtype=np.int64)
    begin = np.cumsum(size) - size
    cut = spaces_to_cut(raw)
    cut[begin] = False
    cut[begin[1:] - 1] = False  # a unit's first and last bytes are its own
    inner = np.flatnonzero(cut)
    starts = np.concatenate([begin, inner + 1])
    starts.sort()
    unit = np.searchsorted(begin, starts, side="right") - 1
    bounds = np.append(starts - np.searchsorted(inner, starts), len(raw) - len(inner)).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw[~cut])]).dictionary_encode()
    words, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    sizes = np.diff(np.frombuffer(coded.dictionary.buffers()[1], dtype=np.int64)[: len(words) + 1])
    a, b = encoders.words_a(words, sizes), encoders.words_b(words)
    bad = ~encoders.faithful(words, a, b)
    lost = np.zeros(len(units), dtype=bool)
    if bad.any():
        lost[unit[bad[code]]] = True
    chunks = np.bincount(unit, minlength=len(units))
    ends = np.cumsum(chunks)
    upto, at = np.cumsum(size), 0
    while at < len(units):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + MERGE_BYTES, side="right")))
        span = slice(int(ends[at] - chunks[at]), int(ends[to - 1]))
        keep = ~lost[unit[span]]
        merge(units, unit[span][keep], code[span][keep], a, b, encoders)
        at = to


def merge(units: list[Unit], unit: np.ndarray, code: np.ndarray, a: Pieces, b: Pieces, encoders: Encoders) -> None:
    """``unit`` and ``code``: of each word, its unit and its number among ``a`` and ``b``."""
    if not len(unit):
        return
    a_n, b_n = a.n[code], b.n[code]
    a_ids, b_ids = a.ids[ragged(a.begin[code], a_n)], b.ids[ragged(b.begin[code], b_n)]
    a_first, b_first = np.cumsum(a_n) - a_n, np.cumsum(b_n) - b_n
    opens = np.append(True, unit[1:] != unit[:-1])
    which = np.cumsum(opens) - 1  # units of this block, numbered
    in_unit = a_first - a_first[opens][which]
    lanes = opens | np.append(True, in_unit[1:] // LANE != in_unit[:-1] // LANE)
    i, j = a_first[lanes].astype(np.int32), b_first[lanes].astype(np.int32)
    stop = np.append(i[1:], len(a_ids)).astype(np.int32)
    high = (np.repeat(which, a_n) << _PAIR_BITS) | (a_ids.astype(np.int64) << _B_BITS)
    found, a_cut, b_cut = [], np.zeros(len(a_ids), dtype=bool), np.zeros(len(b_ids), dtype=bool)
    for group in lockstep(np.cumsum(encoders.a_size[a_ids], dtype=np.int32), np.cumsum(encoders.b_size[b_ids], dtype=np.int32), i, stop, j):
        a_cut[group[1]] = b_cut[group[3]] = True
        link_a, link_b = links_of(*group)
        found.append(high[link_a] | b_ids[link_b])
    pairs, times = np.unique(np.concatenate(found), return_counts=True)
    text, ends = written(a_ids, b_ids, a_cut, b_cut)
    n_a, n_b = (np.add.reduceat(x, np.flatnonzero(opens)) for x in (a_n, b_n))
    n_groups = np.add.reduceat(a_cut, np.cumsum(n_a) - n_a, dtype=np.int64)
    to = ends[np.cumsum(n_a + n_b) - 1]
    pair_to = np.searchsorted(pairs, np.arange(1, len(n_a) + 1) << _PAIR_BITS)
    pairs, times, view = (pairs & ((1 << _PAIR_BITS) - 1)).astype(np.int32), times.astype(np.int32), memoryview(text)
    done = zip(unit[opens].tolist(), n_a.tolist(), n_b.tolist(), n_groups.tolist(), np.append(0, to[:-1]).tolist(), to.tolist(), np.append(0, pair_to[:-1]).tolist(), pair_to.tolist())
    for k, units[k].n_a, units[k].n_b, units[k].n_groups, t0, t1, p0, p1 in done:
        units[k].text, units[k].pairs, units[k].times = view[t0 : t1 - 1], pairs[p0:p1], times[p0:p1]


class Document:
    """The sums of a document's units."""

    __slots__ = ("id", "good", "n_a", "n_b", "n_groups", "sha", "pairs", "times")

    def __init__(self, id_, good: bool):
        self.id, self.good, self.n_a, self.n_b, self.n_groups, self.sha, self.pairs, self.times = id_, good, 0, 0, 0, hashlib.sha256(), [], []

    def add(self, unit: Unit) -> None:
        self.good = self.good and unit.pairs is not None
        if self.good:
            if self.n_a:
                self.sha.update(b";")
            self.sha.update(unit.text)
            self.n_a, self.n_b, self.n_groups = self.n_a + unit.n_a, self.n_b + unit.n_b, self.n_groups + unit.n_groups
            if self.pairs:
                both = np.concatenate([self.pairs[0], unit.pairs])
                distinct, at = np.unique(both, return_inverse=True)
                times = np.zeros(len(distinct), dtype=np.int64)
                np.add.at(times, at, np.concatenate([self.times[0], unit.times]))
                self.pairs, self.times = [distinct], [times]
            else:
                self.pairs, self.times = [unit.pairs], [unit.times]


# ---- blocks ----------------------------------------------------------------


def _pressed(x: np.ndarray) -> bytes:
    """Non-negative 32-bit numbers by byte planes, compressed."""
    return pa.compress(np.ascontiguousarray(x.astype(np.int32).view(np.uint8).reshape(-1, 4).T).tobytes(), codec="zstd", asbytes=True)


def _unpressed(x: bytes, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(pa.decompress(x, 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n).T).view(np.int32).ravel()


_LONGS = ("n_a", "n_b", "n_groups", "n_links", "n_pairs")


def blocks(docs: DataFrame, ranks: str, pattern: str, model: str) -> DataFrame:
    """One row a block: ``block``, arrays by document (``ids``, figures,
    ``sha``), ``kinds`` (distinct pairs), and, packed, those ``pairs``, their
    ``docs``, and of each document's pairs the place there and how often."""
    id_kind = docs.schema["doc_id"].dataType
    schema = T.StructType().add("block", "long").add("ids", T.ArrayType(id_kind))
    for name in _LONGS:
        schema = schema.add(name, T.ArrayType(T.LongType()))
    schema = schema.add("sha", T.ArrayType(T.StringType())).add("kinds", "long")
    for name in ("pairs", "docs", "places", "times"):
        schema = schema.add(name, "binary")

    def row(number: int, done: list[Document], kind: pa.DataType) -> pa.RecordBatch:
        none = np.zeros(0, dtype=np.int32)
        pairs = [d.pairs[0] if d.good and d.pairs else none for d in done]
        times = [d.times[0] if d.good and d.pairs else none for d in done]
        distinct, places = np.unique(np.concatenate(pairs), return_inverse=True)
        figures = {n: [getattr(d, n) if d.good else 0 for d in done] for n in ("n_a", "n_b", "n_groups")} | {"n_links": [int(t.sum()) for t in times], "n_pairs": [len(t) for t in times]}
        columns = [pa.array([number]), pa.array([[d.id for d in done]], pa.list_(kind)), *(pa.array([figures[n]], pa.list_(pa.int64())) for n in _LONGS)]
        columns += [pa.array([[d.sha.hexdigest() if d.good and d.n_a else "" for d in done]], pa.list_(pa.string())), pa.array([len(distinct)])]
        columns += [pa.array([_pressed(x)], pa.binary()) for x in (distinct, np.bincount(places, minlength=len(distinct)), places, np.concatenate(times))]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders, number, open_, kind = Encoders(ranks, pattern, model), TaskContext.get().partitionId() << 32, {}, None
        done: list[Document] = []
        size = 0

        def finished(units: list[Unit]) -> Iterator[pa.RecordBatch]:
            nonlocal done, size, number
            if units:
                align(units, encoders)
            for u in units:
                doc = open_[u.doc]
                doc.add(u)
                size += len(u.data)
                if u.last:
                    done.append(open_.pop(u.doc))
                if size >= BLOCK_BYTES and done:
                    yield row(number, done, kind)
                    done, size, number = [], 0, number + 1

        units, held, at = [], 0, 0
        rows = (batch.slice(k, 256) for batch in batches for k in range(0, len(batch), 256))
        for part in rows:
            kind = part.schema.field("doc_id").type
            for id_, data in zip(part.column("doc_id").to_pylist(), part.column("text").cast(pa.binary()).to_pylist()):
                if not data:
                    done.append(Document(id_, False))
                    continue
                at += 1
                open_[at] = Document(id_, True)
                for unit in units_of(at, data):
                    units.append(unit)
                    held += len(unit.data)
                    if held >= SLAB_BYTES:
                        yield from finished(units)
                        units, held = [], 0
        yield from finished(units)
        if done:
            yield row(number, done, kind)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def held_pairs(found: DataFrame) -> DataFrame:
    """``block, pair, docs``: a row for each distinct pair of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, n, pairs, docs in zip(*(batch.column(c).to_pylist() for c in ("block", "kinds", "pairs", "docs"))):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block)), pa.array(_unpressed(pairs, n)), pa.array(_unpressed(docs, n))], names=["block", "pair", "docs"])

    return found.select("block", "kinds", "pairs", "docs").mapInArrow(run, "block long, pair int, docs int")


def pair_counts(held: DataFrame) -> DataFrame:
    """``pair, count, best``: in how many documents each pair is linked, and
    whether that is the highest count of its A id.  An A id has a row for each B
    id at most, a bound that B's vocabulary sets."""
    sums = held.groupBy("pair").agg(F.sum("docs").alias("count"))
    highest = F.max("count").over(W.partitionBy(F.shiftright("pair", _B_BITS)))
    return sums.select("pair", "count", (F.col("count") == highest).alias("best"))


def tokens_aligned(docs: DataFrame, ranks: str | None = None, pattern: str | None = None, model: str | None = None) -> DataFrame:
    """A row a document: ``doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256``."""
    own = tokenizer_paths() if not (ranks and pattern and model) else ("", "", "")
    found = staged(blocks(docs, ranks or own[0], pattern or own[1], model or own[2]))
    held = held_pairs(found)
    answers = held.select("block", "pair").join(pair_counts(held), "pair")
    schema = docs.select("doc_id").schema
    for name in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"):
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string")

    def figures(block: pa.Table, answer: pa.Table) -> pa.Table:
        n = block.column("n_pairs").combine_chunks().flatten().to_numpy()
        pairs = answer.column("pair").to_numpy()
        order = np.argsort(pairs)
        total, kinds = int(n.sum()), int(block.column("kinds")[0].as_py())
        places, times = (_unpressed(block.column(c)[0].as_py(), total) for c in ("places", "times"))
        if kinds != len(pairs):
            raise ValueError(f"a block of {kinds} pairs has {len(pairs)} answers")
        count, best = answer.column("count").to_numpy()[order], answer.column("best").to_numpy()[order]
        upto = np.cumsum(n)

        def sums(x: np.ndarray) -> pa.Array:
            all_ = np.append(0, np.cumsum(x * times))
            return pa.array(all_[upto] - all_[upto - n])

        flat = lambda c: block.column(c).combine_chunks().flatten()
        columns = [flat("ids"), *map(flat, ("n_a", "n_b", "n_groups", "n_links")), sums(best[places].astype(np.int64)), sums(count[places].astype(np.int64)), flat("sha")]
        return pa.table(columns, names=schema.names)

    kept = found.drop("pairs", "docs")
    return kept.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(figures, schema)


def op12_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents under both tokenizers."""
    return tokens_aligned(documents(spark, sf_dir))
