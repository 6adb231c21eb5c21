"""Token alignment: whole results against plain Python over both tokenizers' own files."""

import hashlib
import json
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from stratakit.llm import alignment
from stratakit.llm.alignment import Document, Encoders, align, links_of, lockstep, op12_lockstep_alignment, tokenizer_paths, tokens_aligned, units_of
from tests.conftest import SF_DIR
from tests.llm import cases
from tokenizers import Tokenizer

ODD = [
    " a", "a ", "  ", "\n", "a\n b", "x  y", "voilà mot   　 z", "▁ x", "a ▁b", "it 's  ok 'll", "<|endoftext|> b", "日本語 ünï 😀  x y", "\x00 a", "a\u0085 b", "c  d",
    "<unk> <s> <0x41>", "a\r\nb \r c", "\x1c a", "é ̈ x", "ﬁ x", "   lead", "trail   ", "word\n", "\nword", "x" * 3000, "ab " * 2000, " a  ", "0 1  2", "한국어 한국어",
]


@pytest.fixture(scope="module")
def own():
    """Token bytes by the tokenizers' own files, and encoders of whole texts."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in keep} | {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        tokens = {i: bytes(byte[c] for c in t) for t, i in json.load(f)["model"]["vocab"].items() if i != 50256}
    b = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def piece(i):
        p = b.id_to_piece(i)
        return bytes([int(p[1:-1], 16)]) if p.startswith("<0x") and p.endswith(">") else p.replace("▁", " ").encode()

    def encode(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        data = [tokens[i] for i in ids[0]], [piece(i) for i in ids[1]]
        return (*ids, *data) if text and all(b"".join(x) == (" " + text).encode() for x in data) else None

    return encode


def brute(text, encode):
    """``n_a, n_b, n_groups, sha`` and the links' id pairs, or None."""
    if not (text and (found := encode(text))):
        return None
    a, b, data_a, data_b = found
    ends = [np.cumsum([len(x) for x in data]).tolist() for data in (data_a, data_b)]
    place = [{e: n for n, e in enumerate(x, 1)} for x in ends]
    groups, links, i, j = [], Counter(), 0, 0
    for cut in sorted(set(ends[0]) & set(ends[1])):
        k, m = place[0][cut], place[1][cut]
        groups.append(",".join(map(str, a[i:k])) + "|" + ",".join(map(str, b[j:m])))
        links.update((x, y) for x in a[i:k] for y in b[j:m])
        i, j = k, m
    return len(a), len(b), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest(), links


def whole(texts, encode):
    """All rows of the query, in order of the texts."""
    each = [brute(t, encode) for t in texts]
    count = Counter(p for x in each if x for p in x[4])
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for x in each:
        if x is None:
            yield (0, 0, 0, 0, 0, 0, "")
        else:
            yield (*x[:3], sum(x[4].values()), sum(n for p, n in x[4].items() if count[p] == best[p[0]]), sum(n * count[p] for p, n in x[4].items()), x[3])


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_equals_brute_force(spark, own):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    want = sorted((d["doc_id"], *x) for d, x in zip(docs, whole([d["text"] for d in docs], own)))
    df = op12_lockstep_alignment(spark, SF_DIR)
    assert [t for c, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    assert sorted((r["doc_id"], *(r[c] for c in COLUMNS)) for r in df.collect()) == want


def test_odd_rows(spark, own):
    rows = cases.rows() + [(100 + n, t, *cases.rows()[0][2:]) for n, t in enumerate(ODD)]
    found = tokens_aligned(spark.createDataFrame(rows, cases.SCHEMA).repartition(3)).collect()
    want = [(r[0], *x) for r, x in zip(rows, whole([r[1] for r in rows], own))]
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], *(r[c] for c in COLUMNS)) for r in found), key=key) == sorted(want, key=key)
    assert tokens_aligned(cases.empty(spark)).collect() == []


@pytest.mark.parametrize("sizes", [(60, 1, 30), (500, 8, 100), (10**6, 10**6, 10**6)])
def test_units_lanes_and_blocks_change_nothing(own, monkeypatch, sizes):
    for name, value in zip(("UNIT_BYTES", "LANE", "MERGE_BYTES"), sizes):
        monkeypatch.setattr(alignment, name, value)
    encoders, texts = Encoders(*tokenizer_paths()), [r[1] for r in cases.rows() if r[1]] + ODD
    units = [u for n, t in enumerate(texts) for u in units_of(n, t.encode())]
    align(units, encoders)
    docs = [Document(n, True) for n in range(len(texts))]
    for u in units:
        docs[u.doc].add(u)
    for d, t in zip(docs, texts):
        want = brute(t, own)
        assert d.good == (want is not None)
        if d.good:
            assert (d.n_a, d.n_b, d.n_groups, d.sha.hexdigest()) == want[:4]
            assert dict(zip(d.pairs[0].tolist(), d.times[0].tolist())) == {a << 15 | b: n for (a, b), n in want[4].items()}


@pytest.mark.parametrize("seed", range(5))
def test_lockstep_finds_all_common_ends(seed):
    rng = np.random.default_rng(seed)
    ends, want, i, j, stop = [[], []], [], [], [], []
    at = 0
    for _ in range(9):
        width = int(rng.integers(1, 60))
        own = [sorted({at + width, *(at + 1 + rng.integers(0, width, rng.integers(0, width))).tolist()}) for _ in range(2)]
        i.append(len(ends[0])), j.append(len(ends[1]))
        for all_, x in zip(ends, own):
            all_ += x
        stop.append(len(ends[0]))
        want += sorted(set(own[0]) & set(own[1]))
        at += width
    a, b = (np.array(x, dtype=np.int32) for x in ends)
    groups = [np.concatenate(x) for x in zip(*lockstep(a, b, np.array(i), np.array(stop), np.array(j)))]
    assert sorted(a[groups[1]].tolist()) == want and (a[groups[1]] == b[groups[3]]).all()
    link_a, link_b = links_of(*groups)
    inner = {(x, y) for f, l, g, m in zip(*(x.tolist() for x in groups)) for x in range(f, l + 1) for y in range(g, m + 1)}
    assert len(link_a) == len(inner) and set(zip(link_a.tolist(), link_b.tolist())) == inner
