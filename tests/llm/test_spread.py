"""Sharding, mixing, packing."""

import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratakit.llm import mixing, packing, sharding
from stratakit.llm.common import documents
from tests.conftest import SF_DIR
from tests.llm.cases import empty, frame, rows, text_bytes, words


def check_shards(found, expected_rows, n_shards):
    by, load = defaultdict(list), Counter()
    for r in found:
        by[r.shard].append(r.slot)
        load[r.shard] += r.size
    assert len(found) == expected_rows and set(by) <= set(range(n_shards))
    assert all(sorted(v) == list(range(len(v))) for v in by.values())
    return [load[s] for s in range(n_shards)]


def test_sharding_edge_rows(spark):
    found = sharding.shard_documents(frame(spark)).collect()
    check_shards(found, len(rows()), 16)
    want = Counter((r[0], len(text_bytes(r[1])) + 1, zlib.crc32(text_bytes(r[1]))) for r in rows())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want
    assert sharding.shard_documents(empty(spark)).count() == 0


def test_shards_are_near_equal_and_maps_keep_versions(spark, tmp_path):
    docs, path = documents(spark, SF_DIR), f"{tmp_path}/map"
    found = sharding.shard_documents(docs, n_shards=4, map_path=path).collect()
    load = check_shards(found, docs.count(), 4)
    assert max(load) - min(load) <= max(r.size for r in found)
    first, second = ({r.virtual_slot: r.shard for r in sharding.load_map(spark, path, v).collect()} for v in (1, 2))
    assert first.keys() == second.keys() == set(range(sharding.N_SLOTS))
    used = {r.virtual_slot for r in found}
    moved = [s for s in used if first[s] != second[s]]
    assert 0 < len(moved) < len(used) / 2 and all(first[s] == second[s] for s in first.keys() - used)


def test_map_is_edited_across_runs(spark, tmp_path):
    docs, path = documents(spark, SF_DIR), f"{tmp_path}/map"
    total = sum(len(text_bytes(r.text)) + 1 for r in docs.collect())
    shards = lambda n: {r.doc_id: (r.shard, r.size) for r in sharding.shard_documents(docs, n_shards=n, map_path=path).collect()}
    first, again = shards(16), shards(16)
    assert first == again and sharding.latest_version(spark, path) == 2
    grown = shards(17)
    assert sharding.latest_version(spark, path) == 3
    moved = sum(size for i, (shard, size) in grown.items() if shard != first[i][0])
    assert 0 < moved < 0.35 * total and any(shard == 16 for shard, _ in grown.values())
    fewer = shards(15)
    assert {shard for shard, _ in fewer.values()} <= set(range(15)) and len(fewer) == len(first)
    assert all(r.shard < 15 for r in sharding.load_map(spark, path, sharding.latest_version(spark, path)).collect())
    assert shards(15) == fewer


@pytest.mark.parametrize("seed", range(6))
def test_rebalanced_map_against_a_loop(spark, seed):
    rng = np.random.default_rng(seed)
    slots, old, new = 60, int(rng.integers(1, 7)), int(rng.integers(1, 7))
    size = {s: int(rng.choice([0, 1, 5, 5, 700])) * int(rng.integers(1, 4)) for s in range(slots) if s % 7}
    shard = {s: int(rng.integers(0, old)) for s in range(slots)}
    mean = sum(size.values()) / new
    load, want, moving = [0] * new, {}, []
    for s in sorted(shard, key=lambda s: (-size.get(s, 0), s)):
        held = sum(size.get(t, 0) for t in shard if shard[t] == shard[s] and (-size.get(t, 0), t) <= (-size.get(s, 0), s))
        if shard[s] < new and (held <= mean or not size.get(s)):
            want[s] = shard[s]
            load[shard[s]] += size.get(s, 0)
        else:
            moving.append(s)
    for s in moving:
        want[s] = min(range(new), key=lambda k: (load[k], k))
        load[want[s]] += size.get(s, 0)
    held = spark.createDataFrame([(1, s, k) for s, k in shard.items()], "version int, virtual_slot int, shard int")
    sizes = spark.createDataFrame([(s, b) for s, b in size.items()], "virtual_slot int, slot_bytes long")
    found = sharding.rebalance(held, sizes, new).collect()
    assert {r.virtual_slot: r.shard for r in found} == want and len(found) == slots and {r.version for r in found} == {2}


def brute_targets(sizes):
    weights = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    target, free, left = {}, set(sizes), Fraction(3, 2) * sum(sizes.values())
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        for s in over:
            target[s] = Fraction(2 * sizes[s])
            left -= target[s]
        free -= over
    return target


@pytest.mark.parametrize("make", [frame, lambda s: documents(s, SF_DIR)], ids=["edge", "sf0.001"])
def test_mix_meets_targets(spark, make):
    docs = make(spark)
    found = mixing.mix(docs).collect()
    sizes, taken = Counter(), Counter()
    for r in docs.select("text", "source").collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(sizes)
    assert len(found) == docs.count()
    for r in found:
        assert r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    assert all(abs(taken[s] - want[s]) <= 1 for s in sizes)
    again = mixing.mix(make(spark).repartition(5)).collect()
    assert Counter((r.doc_id, r.size, r.taken) for r in found) == Counter((r.doc_id, r.size, r.taken) for r in again)


def test_mix_of_nothing(spark):
    assert mixing.mix(empty(spark)).count() == 0
    assert [r.taken for r in mixing.mix(empty(spark).union(spark.createDataFrame([(1, None, "en", "a", 0, 1, 2, 3, "x", 4, "y", "z", 5, 6)], empty(spark).schema))).collect()] == [0]


def test_rows_without_ids_spread_over_shards(spark):
    """Two thirds of a source have no id, and half of these one text."""
    data = [(None if i % 3 else i, "w " * (9 if i % 3 == 1 else 3 + i % 17), "en", "a" if i % 10 else "b") for i in range(30_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    sizes = docs.select("doc_id", "source", F.regexp_count("text", F.lit("w")).cast("long").alias("size"))
    total = Counter()
    for d in data:
        total[d[3]] += len(d[1]) // 2
    rows_ = sizes.withColumn("source_size", F.when(F.col("source") == "a", total["a"]).otherwise(total["b"]).cast("long"))
    laid = mixing.lay(rows_, shard_words=20_000).collect()
    assert Counter((r.doc_id, r.source, r["size"]) for r in laid) == Counter((d[0], d[3], len(d[1]) // 2) for d in data)
    cells = defaultdict(list)
    for r in laid:
        cells[r.source, r.shard].append((r.start, r["size"]))
    assert len(cells) > 10 and max(sum(n for _, n in c) for c in cells.values()) < 20_000 + 5 * mixing.STACK_WORDS
    for cell in cells.values():
        at = 0
        for start, n in sorted(cell):
            assert start == at
            at += n
    want, taken = brute_targets(total), Counter()
    for r in mixing.mix(docs, shard_words=20_000).collect():
        assert 0 <= r.taken <= 2 * r["size"]
        taken[r.source] += r.taken
    # A source that is taken twice over can't round a shard's quota up: half a block a shard, at most.
    assert all(abs(taken[s] - want[s]) <= mixing.BLOCK_WORDS * len([c for c in cells if c[0] == s]) / 2 for s in total)


def test_sainte_lague_against_highest_quotients(spark):
    rng = np.random.default_rng(3)
    groups = {g: (rng.integers(0, 10 ** int(rng.integers(1, 6)), int(rng.integers(1, 12))).tolist(), int(rng.integers(0, 400))) for g in range(40)}
    data = [(g, k, float(w), seats) for g, (ws, seats) in groups.items() for k, w in enumerate(ws)]
    df = spark.createDataFrame(data, "g int, k int, w double, seats long")
    got = {(r.g, r.k): r.won for r in mixing.apportion(df, [F.col("g")], F.col("w"), F.col("seats"), [F.col("k")], "won").collect()}
    for g, (ws, seats) in groups.items():
        won = [0] * len(ws)
        for _ in range(seats if sum(ws) else 0):
            best = max(range(len(ws)), key=lambda k: (Fraction(ws[k], 2 * won[k] + 1), -k))
            won[best] += 1
        assert [got[(g, k)] for k in range(len(ws))] == won, (g, ws, seats)


def ids_of(texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return [np.array([*e.ids, 1], dtype="<u4") for e in t.encode_batch(texts, add_special_tokens=False)]


@pytest.mark.parametrize("make", [frame, lambda s: documents(s, SF_DIR)], ids=["edge", "sf0.001"])
def test_packing_covers_all_tokens(spark, make):
    docs = make(spark).select("doc_id", "text", "source").collect()
    found = packing.pack(make(spark)).collect()
    tiled(found)
    want = Counter()
    by = defaultdict(list)
    for d, ids in zip(docs, ids_of([d.text or "" for d in docs])):
        by[d.doc_id].append(ids)
        want[(d.doc_id, len(ids))] += 1
    have = Counter()
    for r in found:
        if r.start == 0:
            have[(r.doc_id, r.doc_tokens)] += 1
        assert any(len(x) == r.doc_tokens and zlib.crc32(x[r.start : r.start + r.length].tobytes()) == r.ids_crc32 for x in by[r.doc_id])
    assert have == want and sum(r.length for r in found) == sum(k[1] * n for k, n in want.items())


def tiled(found, window=2048):
    place = sorted((r.sequence_id * window + r["offset"], r.length) for r in found)
    assert place[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(place, place[1:]))
    assert all(r.length > 0 and r["offset"] + r.length <= window for r in found)
    return sum(r.length for r in found)


def test_windows_keep_proportions(spark):
    found = packing.pack(documents(spark, SF_DIR)).collect()
    all_tokens = tiled(found)
    total, window = Counter(), defaultdict(Counter)
    for r in found:
        total[r.source] += r.length
        window[r.sequence_id][r.source] += r.length
    share = {s: n / all_tokens for s, n in total.items()}
    # Over any stretch of windows of full runs: what is earned, within two runs and those that other queues owe.
    full, so_far = all_tokens // 2048 - len(share) * 4 * packing.LUMP // 2048 - 1, Counter()
    assert full > 20
    for w in range(full):
        so_far.update(window[w])
        assert all(abs(so_far[s] - 2048 * (w + 1) * share[s]) <= 4 * packing.LUMP + 0.05 * 2048 * (w + 1) * share[s] for s in share)
    assert sum(1 for r in found if r.length < 32) < 0.4 * len(found)


def test_weights_and_no_rows(spark):
    found = packing.pack(documents(spark, SF_DIR), weights={"src0": 3.0, "src1": 1.0}).collect()
    tiled(found)
    by = Counter()
    for r in found:
        if r.sequence_id < 3:
            by[r.source] += r.length
    assert abs(by["src0"] - 3 * by["src1"]) <= 4 * packing.LUMP and by["src0"] + by["src1"] == 3 * 2048
    assert packing.pack(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty(spark), weights={"a": -1.0})
    with pytest.raises(ValueError):
        packing.pack(empty(spark), lump=100)


def test_zero_weights_tile_and_a_thousand_sources_are_queues_of_their_own(spark):
    data = [(i, "w " * 700 * (4 - i % 3), "abc"[i % 3]) for i in range(90)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(4)
    found = packing.pack(docs, weights={"a": 3.0, "b": 1.0, "c": 0.0}).collect()
    assert tiled(found) == sum(len(x) for x in ids_of([d[1] for d in data]))
    assert all(r.source != "c" for r in found if r.sequence_id < 30)
    many = spark.createDataFrame([(i, "x y z " * 60, f"s{i % 1000}") for i in range(3000)], "doc_id long, text string, source string").repartition(3)
    found = packing.pack(many).collect()
    assert tiled(found) == 3000 * len(ids_of(["x y z " * 60])[0])
    half, n = Counter(), max(r.sequence_id for r in found) // 2
    for r in found:
        if r.sequence_id < n:
            half[r.source] += r.length
    assert len(half) >= 990


def test_word_encoder_equals_whole_encoding():
    encoder = packing.WordEncoder.of(packing.vocabulary_path(), packing.ranks_path(), packing.split_pattern(), limit=3)
    texts = ["", " ", "a", " a b ", "a  b", "it's\nfine, isn't it?\n", "x\t y", "\n\n a", "a \n", "日本 語 é", "a b c", "1 22 333 !!! <|endoftext|>", "a <|endoftext|> b", "<|endoftext|><|endoftext|>x  y<|endoftext", " <|endoftext|>\n "]
    assert [np.frombuffer(encoder.ids(t), "<u4").tolist() for t in texts] == [x[:-1].tolist() for x in ids_of(texts)]


def test_stage_meets_targets_in_long_texts(spark):
    """A hot source of which the mix takes a tenth: texts short and long."""
    rng = np.random.default_rng(8)
    data = [(i, "w " * int(n), "en", "c" if i % 100 else "b") for i, n in enumerate(np.exp(rng.uniform(3, 8.3, 3000)))]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string")
    sizes = docs.select("doc_id", "source", F.xxhash64("text").alias("_text"), (F.length("text") / 2).cast("long").alias("size"))
    got = mixing.copies(sizes, weights=(9, 1), share=0.1).collect()
    for source in "bc":
        for low, high in ((0, 10**9), (1280, 10**9), (0, 1280)) if source == "c" else ((0, 10**9),):
            rows_ = [r for r in got if r.source == source and low < r["size"] <= high]
            want = sum(r["size"] * r.target / r.source_size for r in rows_)
            assert abs(sum(r["size"] * r.copies for r in rows_) - want) < (0.06 * want if source == "c" else 4200)
    out = mixing.mixing_stage(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    words_of, target = Counter(), brute_targets(Counter({s: sum(len(d[1]) // 2 for d in data if d[3] == s) for s in "bc"}))
    for r in out.collect():
        words_of[r.source] += len(r.text) // 2
    assert all(abs(words_of[s] - target[s]) < 0.03 * target[s] + 4200 for s in "bc")
