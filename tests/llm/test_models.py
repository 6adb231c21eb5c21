"""Language-model scoring, language identification, quality."""

import functools
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from stratakit.llm import hashed, language_id, lm_scoring, quality
from stratakit.llm.common import documents
from stratakit.llm.context_tree import gram_counts
from tests.conftest import SF_DIR
from tests.llm.cases import empty, frame, words


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 10 == 0


def out():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0


def test_gram_counts_against_a_loop():
    texts = [b"abcabc", b"", b"a", b"xyz xyz"]
    want = Counter()
    for t in texts:
        padded = b"   " + t
        for k in range(3, len(padded)):
            want[int.from_bytes(padded[k - 3 : k + 1], "big")] += 1
    keys, n = gram_counts(texts, 3)
    assert dict(zip(keys.tolist(), n.tolist())) == want


def sums_to_one(table, tree, unseen):
    times = np.ones(tree.width)
    times[0] = unseen
    return np.allclose((table * times).sum(axis=1), 1, atol=1e-3)


class NaiveTree:
    """The suffix tree of words by dictionaries."""

    def __init__(self, docs):
        self.count = [Counter(), Counter(), Counter()]  # of words, pairs, triples
        types = set()
        for own in docs:
            self.count[0].update(own)
            self.count[1].update(zip((b"\n", *own), own))
            self.count[2].update(zip((b"\n", *own), own, own[1:]))
            types.update(w for w in own if w != b"\n")
        self.tokens = sum(self.count[0].values())
        self.unseen = (sum(v == 1 for v in self.count[0].values()) + 1) / (self.tokens + 2)
        self.near, self.far, follow = {}, {}, [defaultdict(dict), defaultdict(dict)]
        for k in (1, 2):
            for g, n in self.count[k].items():
                follow[k - 1][g[:-1]][g[-1]] = n
        for (a,), nexts in follow[0].items():
            n = sum(nexts.values())
            if n >= lm_scoring.LEAST and sum(v * np.log2(v / n * self.tokens / self.count[0][w]) for w, v in nexts.items()) >= lm_scoring.DIVERGENCE:
                self.near[a] = (n, nexts)
        for (a, b), nexts in follow[1].items():
            n = sum(nexts.values())
            saved = sum(v * np.log2(v / n * self.count[0][b] / self.count[1][b, w]) for w, v in nexts.items())
            if n >= lm_scoring.LEAST and saved >= lm_scoring.DIVERGENCE and b in self.near:
                self.far[a, b] = (n, nexts)
        self.grams, self.after = Counter(), [defaultdict(Counter) for _ in range(3)]
        for w in types:
            padded = b"  " + w + b" "
            for i in range(len(padded) - 2):
                for k in range(3):
                    self.after[k][padded[i + 2 - k : i + 2]][padded[i + 2]] += 1

    def spelled(self, w):
        padded, total = b"  " + w + b" ", 0.0
        for i in range(len(padded) - 2):
            p = 1 / 256
            for k in range(3):
                nexts = self.after[k].get(padded[i + 2 - k : i + 2])
                if nexts:
                    p = (nexts[padded[i + 2]] + len(nexts) * p) / (sum(nexts.values()) + len(nexts))
            total += np.log10(p)
        return total

    def known(self, a, b, w):
        """Of a known word after ``a, b``; ``w`` None: of all new words."""
        p = (1 - self.unseen) * self.count[0][w] / self.tokens if w is not None else self.unseen
        for table, context in ((self.near, b), (self.far, (a, b))):
            if context in table:
                n, nexts = table[context]
                p = (max(nexts.get(w, 0) - lm_scoring.DISCOUNT, 0) + lm_scoring.DISCOUNT * len(nexts) * p) / n
        return p

    def score(self, own):
        total, a, b = 0.0, None, b"\n"
        for w in own:
            new = w not in self.count[0]
            total += np.log10(self.known(a, b, None if new else w)) + (self.spelled(w) if new and w != b"\n" else 0)
            a, b = b, w
        return total


def test_lm_is_a_distribution():
    docs = [(*t.split(), b"\n") for t in (b"a b c a b c", b"x b d x b d", b"x y z x y z x y", b"a b c", b"q") for _ in range(12)]
    naive = NaiveTree(docs)
    assert naive.near and naive.far
    for context in [(None, b"\n"), (b"a", b"b"), (b"x", b"b"), (b"z", b"x"), (b"?", b"b"), (b"?", b"?")]:
        assert sum(naive.known(*context, w) for w in [*naive.count[0], None]) == pytest.approx(1, abs=1e-9)
    assert sum(10 ** naive.spelled(bytes([x])) for x in range(256) if x != 32) + 10 ** naive.spelled(b"") < 1


def test_lm_spelling_against_dictionaries():
    train = [b"abra", b"cadabra", b"barb", "é".encode()]
    naive = NaiveTree([(w, b"\n") for w in train])
    asked = [b"abra", b"x", b"rabarbara" * 200, "éa".encode()]
    assert lm_scoring.Spelling(*lm_scoring.byte_triples(train)).log10(asked) == pytest.approx([naive.spelled(w) for w in asked])
    assert lm_scoring.Spelling(*lm_scoring.byte_triples([])).log10([b"ab"]) == pytest.approx([-3 * np.log10(256)])


@pytest.mark.parametrize("make", [frame, lambda s: documents(s, SF_DIR)], ids=["edge", "sf0.001"])
def test_lm_model_against_brute_force(spark, make, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 50_000)
    docs = make(spark).repartition(5)
    texts = [(r.doc_id, (*words(r.text), b"\n")) for r in docs.select("doc_id", "text").collect()]
    naive = NaiveTree([own for i, own in texts if not held(i)])
    assert naive.near and (make is frame or naive.far)
    want, have = defaultdict(list), defaultdict(list)
    for i, own in texts:
        want[i].append(naive.score(own))
    for r in lm_scoring.score(docs, out()).collect():
        have[r.doc_id].append(r.score)
    assert want.keys() == have.keys()
    for i, scores in want.items():
        assert sorted(have[i]) == pytest.approx(sorted(scores), rel=1e-6), i


@pytest.mark.parametrize("make", [frame, lambda s: documents(s, SF_DIR)], ids=["edge", "sf0.001"])
def test_lm_scores_against_brute_force(spark, make):
    docs = make(spark).select("doc_id", "text").collect()
    count = Counter()
    for d in docs:
        if not held(d.doc_id):
            count.update([*words(d.text), b"\n"])
    n, kinds = sum(count.values()), len(count)
    want = Counter()
    for d in docs:
        own = [*words(d.text), b"\n"]
        base = sum(np.log10((count[w] + 0.1) / (n + 0.1 * (kinds + 1))) for w in own)
        want[(d.doc_id, held(d.doc_id), len(own), sum(count[w] > 0 for w in own), n, round(base, 5))] += 1
    found = lm_scoring.score(make(spark), out()).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in found) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in found)


def test_lm_beats_the_base_on_held_out_texts(spark):
    """Over sf0.01: the base gives each new word the whole mass of new words, the
    model a part of it, and of sf0.001's held-out words a quarter are new."""
    found = lm_scoring.score(documents(spark, SF_DIR.replace("0.001", "0.01")), out()).where("held_out").collect()
    assert sum(r.score for r in found) > 0.9 * sum(r.base_score for r in found)


def test_lm_of_no_rows_and_of_no_training_rows(spark):
    assert lm_scoring.score(empty(spark), out()).count() == 0
    found = lm_scoring.score(frame(spark), F.lit(True)).collect()
    assert len(found) == frame(spark).count() and all(r.train_tokens == 0 and np.isfinite(r.score) for r in found)


def test_language_of_held_out_texts(spark):
    docs = documents(spark, SF_DIR)
    fold = language_id.fold(F.col("doc_id"), 3)
    model = language_id.fit(docs.where(fold != 1).select("doc_id", "lang", "text"))
    assert all(sums_to_one(2.0 ** -model.bits[:, :, k].astype(float), model.tree, 256 - (model.tree.width - 1)) for k in range(len(model.langs)))
    right = language_id.identify(docs, model).join(docs.where(fold == 1).select("doc_id", "lang"), "doc_id").select((F.col("lang") == F.col("lang_pred")).alias("ok"), "score").collect()
    assert sum(r.ok for r in right) >= 0.97 * len(right) and all(0 <= r.score <= 1 for r in right)


def naive_ppm(texts, kept, seen):
    """Method C with exclusion over kept contexts, by dictionaries."""
    after = defaultdict(Counter)
    for t in texts:
        padded = b"   " + t
        for i in range(3, len(padded)):
            for d in range(4):
                after[padded[i - d : i]][padded[i]] += 1

    @functools.cache
    def p(context):
        below = {b: 1 / 256 for b in range(256)} if not context else p(context[1:])
        if context and context not in kept or not after[context]:
            return below
        nexts, total = after[context], sum(after[context].values()) + len(after[context])
        rest = max(sum(q for b, q in below.items() if b not in nexts), 1e-12)
        return {b: nexts[b] / total if b in nexts else len(nexts) / total * q / rest for b, q in below.items()}

    def bits(text):
        padded, out = b"   " + text, 0.0
        for i in range(3, len(padded)):
            d = next(d for d in range(3, -1, -1) if not d or padded[i - d : i] in kept)
            out -= np.log2(p(padded[i - d : i])[padded[i]])
        return out

    return bits


def test_ppm_code_lengths_against_dictionaries(spark, monkeypatch):
    texts = {"a": ["abracadabra " * 12, "barbara and abraham " * 9], "b": ["los pueblos " * 14, "donde la luna " * 11, "ñandú"]}
    docs = spark.createDataFrame([(i, lang, t) for i, (lang, t) in enumerate((k, t) for k, v in texts.items() for t in v)], "doc_id long, lang string, text string")
    for most in (language_id.MOST_CELLS, 3000):
        monkeypatch.setattr(language_id, "MOST_CELLS", most)
        model = language_id.fit(docs)
        assert model.bits.size <= most
        shown = {int(c): b for b, c in enumerate(model.tree.classes.tolist()) if c}
        kept = set()
        for d, keys in enumerate(model.tree.contexts, 1):
            for key in keys.tolist():
                back = []
                for _ in range(d):
                    back.append(shown[key % model.tree.width])
                    key //= model.tree.width
                kept.add(bytes(back))
        asked = [b"abra la luna", b"zz \xc3\xb1", b"", b"donde barbara"]
        for k, lang in enumerate(model.langs):
            bits = naive_ppm([t.encode() for t in texts[lang]], kept, shown)
            assert model.tree.sums(asked, model.bits)[:, k] == pytest.approx([bits(t) for t in asked], rel=1e-4)


def test_language_edge_rows(spark):
    docs = frame(spark)
    model = language_id.fit(docs.where("text is not null and lang is not null").select("doc_id", "lang", "text"))
    found = language_id.identify(docs, model).collect()
    assert len(found) == docs.count()
    for r, t in zip(sorted(found, key=lambda r: (r.doc_id is None, r.doc_id)), sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is None, r.doc_id))):
        und = t.text is None or not any(c.isalpha() for c in t.text)
        assert (r.lang_pred == "und") == und and (r.lang_pred in (*model.langs, "und"))
    none = language_id.identify(docs, language_id.fit(empty(spark).select("doc_id", "lang", "text"))).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert language_id.identify(empty(spark), model).count() == 0


def naive_kneser_ney(grams, order):
    """Interpolated modified Kneser-Ney over byte tuples, by dictionaries."""
    levels = {order: Counter(grams)}
    for k in range(order - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    after = {k: defaultdict(dict) for k in levels}
    for k, c in levels.items():
        for g, v in c.items():
            after[k][g[:-1]][g[-1]] = v

    def cuts(c):
        n = [0, *(sum(v == k for v in c.values()) for k in (1, 2, 3, 4))]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        return [0, *(max(0.05, min(k - 0.05, k - (k + 1) * y * (n[k + 1] / n[k] if n[k] else 0.5))) for k in (1, 2, 3))]

    discount = {k: cuts(c) for k, c in levels.items()}

    def p(g):
        k = len(g)
        below = p(g[1:]) if k > 1 else 1 / 256
        own = after[k].get(g[:-1])
        if not own:
            return below
        total, d = sum(own.values()), discount[k]
        back = sum(d[min(v, 3)] for v in own.values()) / total
        return max(own.get(g[-1], 0) - (d[min(own[g[-1]], 3)] if g[-1] in own else 0), 0) / total + back * below

    return p


def test_kneser_ney_against_dictionaries(spark):
    texts = [b"abracadabra", b"abraham", b"cadence and dance", b"barbara"]
    df = spark.createDataFrame([(bytearray(t),) for t in texts], "body binary")
    p = naive_kneser_ney([tuple((b"    " + t)[k : k + 5]) for t in texts for k in range(len(t))], 5)
    asked = ["abra", "dance", "zebra", None, "", " \n\t", "a" * 3000, "\u000babra "]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in quality.perplexities(docs, quality.kneser_ney(quality.gram_table(df))).collect()}
    for i, t in enumerate(asked):
        body = (t or "").strip(" \t\n\x0b\x0c\r").encode()
        want = -sum(np.log2(p(tuple((b"    " + body)[k : k + 5]))) for k in range(len(body)))
        assert found[i].n_bytes == len(body) and found[i].bits == pytest.approx(want, rel=1e-4)


def test_hashed_values():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 2**40, 5000))
    values = rng.random(len(keys))
    asked = rng.integers(0, len(keys), 9000)
    assert (hashed.Hashed(keys, values).of(keys[asked]) == values[asked]).all()
    assert len(hashed.Hashed(keys[:0], values[:0]).of(keys[:0])) == 0


def test_quality_verdicts_against_brute_force(spark, monkeypatch):
    """Perplexities, thresholds and verdicts of sf0.001, in many blocks."""
    monkeypatch.setattr(quality, "BLOCK_BYTES", 60_000)
    monkeypatch.setattr(quality, "GROUP_BLOCKS", 3)
    docs, trusted = documents(spark, SF_DIR), {r.doc_id for r in quality.trusted_labels(spark, SF_DIR).collect()}
    rows_ = {r.doc_id: (r.lang, (r.text or "").strip(" \t\n\x0b\x0c\r").encode()) for r in docs.collect()}
    p = functools.cache(naive_kneser_ney([tuple((b"    " + t)[k : k + 5]) for i, (_, t) in rows_.items() if i in trusted for k in range(len(t))], 5))
    bits = {i: -sum(np.log2(max(1e-12, p(tuple((b"    " + t)[k : k + 5])))) for k in range(len(t))) for i, (_, t) in rows_.items()}
    by = defaultdict(list)
    for i, (lang, t) in rows_.items():
        if i in trusted and t:
            by[lang].append(i), by[None].append(i)
    mean = {g: sum(bits[i] for i in v) / sum(len(rows_[i][1]) for i in v) for g, v in by.items()}
    group = lambda i: rows_[i][0] if len(by[rows_[i][0]]) >= quality.LEAST_TRUSTED else None
    drawn = {i: (bits[i] + quality.PRIOR_BYTES * mean[group(i)]) / (len(t) + quality.PRIOR_BYTES) for i, (_, t) in rows_.items()}
    limit = {g: sorted(drawn[i] for i in v)[int(np.ceil(quality.QUANTILE * len(v))) - 1] * quality.MARGIN for g, v in by.items()}
    found = quality.classify(docs, quality.trusted_labels(spark, SF_DIR)).collect()
    assert len(found) == len(rows_)
    for r in found:
        assert np.log2(r.perplexity) == pytest.approx(bits[r.doc_id] / len(rows_[r.doc_id][1]), rel=1e-3)
        assert np.log2(r.threshold) == pytest.approx(limit[group(r.doc_id)], rel=1e-3)
        assert r.kept == (drawn[r.doc_id] <= limit[group(r.doc_id)])


def test_quality_keeps_trusted_prose_and_rejects_noise(spark):
    docs = documents(spark, SF_DIR)
    found = quality.classify(docs, quality.trusted_labels(spark, SF_DIR)).join(spark.read.parquet(f"{SF_DIR}/labels.parquet"), "doc_id").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_quality_edge_rows(spark):
    docs = frame(spark)
    found = quality.classify(docs, docs.where("doc_id in (1, 3, 9)").select("doc_id")).collect()
    assert len(found) == docs.count()
    for r in found:
        blank = r.n_bytes == 0
        assert (r.perplexity is None) == blank and (not r.kept if blank else True)
    untrusted = quality.classify(docs, docs.where("false").select("doc_id")).collect()
    assert all(r.kept == (r.n_bytes > 0) for r in untrusted)
    assert quality.classify(empty(spark), docs.select("doc_id")).count() == 0


def test_blocks_and_shards_do_not_change_scores(spark, monkeypatch):
    docs = documents(spark, SF_DIR)
    whole = {r.doc_id: r for r in lm_scoring.score(docs, out()).collect()}
    monkeypatch.setattr(lm_scoring, "BLOCK_BYTES", 50_000)
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 1_000)
    parts = {r.doc_id: r for r in lm_scoring.score(docs, out()).collect()}
    assert whole.keys() == parts.keys()
    for i, r in whole.items():
        assert parts[i].score == pytest.approx(r.score, rel=1e-6) and parts[i].base_score == pytest.approx(r.base_score) and parts[i].n_known == r.n_known
