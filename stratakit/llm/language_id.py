"""Language identification by prediction by partial matching (PPM).

For each language a byte context tree with escape probabilities (method C,
with exclusion) gives exact code lengths under frozen statistics; the shortest
code names the language.  Trees are fit on a bounded sample of labelled rows
(``SAMPLE_DOCS`` whole texts a language); every text is scored whole.

Rows: null text or text without a letter is ``und`` with score 0; null ``lang``
never trains; without any labelled row all is ``und``; repeated rows score one
by one.  Only named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratakit.llm.common import bounded_sample, documents
from stratakit.llm.context_tree import ContextTree, backward, gram_counts

DEPTH = 3
#: Labelled texts a language that fit the trees.
SAMPLE_DOCS = 1000
MOST_SAMPLED = 50_000
#: A context needs this many occurrences, and this share of its language's bytes.
LEAST_COUNT, LEAST_SHARE = 8, 1 / 20_000
#: Numbers that the table of all languages' trees may hold (256 MB), whatever was sampled.
MOST_CELLS = 1 << 26


@dataclass
class Ppm:
    langs: list[str]
    tree: ContextTree | None
    bits: np.ndarray | None  #: nodes x symbols x languages


def sample(labelled: DataFrame, docs: int = SAMPLE_DOCS, most: int = MOST_SAMPLED) -> DataFrame:
    """``docs`` rows of each language by hash of ``doc_id``, ``most`` in all.  The
    choice is made without the texts; its bounded list goes to every task."""
    keys = bounded_sample(labelled, "lang", docs, most).select(F.col("doc_id").alias("i_"), F.col("lang").alias("l_"))
    same = F.col("doc_id").eqNullSafe(F.col("i_")) & (F.col("lang") == F.col("l_"))
    return labelled.join(F.broadcast(keys), same, "left_semi")


def counts(texts: DataFrame, depth: int = DEPTH) -> DataFrame:
    """``lang, gram, n`` over all given rows, combined in each task first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by: dict[str, list[bytes]] = {}
            for lang, body in zip(batch.column("lang").to_pylist(), batch.column("body").to_pylist()):
                by.setdefault(lang, []).append(body)
            for lang, bodies in by.items():
                keys, n = gram_counts(bodies, depth)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(n, pa.int64())], names=["lang", "gram", "n"])

    body = texts.select("lang", F.lower("text").cast("binary").alias("body"))
    return body.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def probabilities(tree: ContextTree, by_depth: list[tuple[np.ndarray, np.ndarray, np.ndarray]], seen: int) -> np.ndarray:
    """Symbol probabilities of one language at all nodes.

    ``by_depth``: contexts, symbols, counts for depth 0, 1, and so on.  Symbol
    0 stands for each single byte that no language has shown.
    """
    p = np.full((tree.nodes, tree.width), 1 / 256)
    times = np.ones(tree.width)
    times[0] = 256 - seen
    for d, (context, symbol, n) in enumerate(by_depth):
        keys = tree.contexts[d - 1] if d else np.zeros(1, dtype=np.int64)
        first = tree.first[d - 1] + 1 if d else 0
        if not len(keys):
            continue
        if d > 1:
            p[first : first + len(keys)] = p[tree.first[d - 2] + 1 + np.searchsorted(tree.contexts[d - 2], keys // tree.width)]
        elif d == 1:
            p[first : first + len(keys)] = p[0]
        at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
        here = keys[at] == context
        seen_n = np.zeros((len(keys), tree.width))
        np.add.at(seen_n, (at[here], symbol[here]), n[here])
        total, kinds = seen_n.sum(axis=1, keepdims=True), (seen_n > 0).sum(axis=1, keepdims=True)
        below = p[first : first + len(keys)]
        rest = np.maximum((below * times * (seen_n == 0)).sum(axis=1, keepdims=True), 1e-12)
        with np.errstate(invalid="ignore", divide="ignore"):
            own = np.where(seen_n > 0, seen_n / (total + kinds), kinds / (total + kinds) * below / rest)
        p[first : first + len(keys)] = np.where(total > 0, own, below)
    return p


def fit(labelled: DataFrame, depth: int = DEPTH, docs: int = SAMPLE_DOCS) -> Ppm:
    """Trees of all languages in ``labelled`` (``doc_id, lang, text``).

    The counts that reach the driver come from ``docs`` texts a language.
    """
    rows = counts(sample(labelled, docs), depth).toPandas()
    langs = sorted(rows.lang.unique())
    if not langs:
        return Ppm([], None, None)
    shown = np.unique(np.concatenate([(rows.gram.to_numpy() >> (8 * d)) & 255 for d in range(depth + 1)]))
    classes = np.zeros(256, dtype=np.uint8 if len(shown) < 256 else np.int16)
    classes[shown] = np.arange(1, len(shown) + 1)
    width = len(shown) + 1
    tables, found = [], []
    for lang in langs:
        own = rows[rows.lang == lang]
        context, symbol = backward(own.gram.to_numpy(), depth, classes, width)
        n, by_depth = own.n.to_numpy(), []
        for d in range(depth + 1):
            short = context // width ** (depth - d)
            pairs, index = np.unique(short * width + symbol, return_inverse=True)
            count = np.bincount(index, n)
            by_depth.append((pairs // width, pairs % width, count))
            if d:
                keys, index = np.unique(pairs // width, return_inverse=True)
                total = np.bincount(index, count)
                found.append((d, keys[total >= LEAST_COUNT], total[total >= LEAST_COUNT] / n.sum()))
        tables.append(by_depth)
    # Contexts of all languages, rarer ones left out until the table of the sampled statistics keeps its size.
    least = LEAST_SHARE
    while True:
        contexts = [np.unique(np.concatenate([keys[share >= least] for d, keys, share in found if d == k])) for k in range(1, depth + 1)]
        if (1 + sum(map(len, contexts))) * width * len(langs) <= MOST_CELLS:
            break
        least *= 1.5
    tree = ContextTree.of(contexts, classes, width)
    bits = np.stack([-np.log2(probabilities(tree, t, len(shown))) for t in tables], axis=-1)
    return Ppm(langs, tree, bits.astype(np.float32))


def identify(docs: DataFrame, model: Ppm) -> DataFrame:
    """``doc_id, lang_pred, score``: score is the language's posterior share
    under equal priors, from the exact code lengths."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    known = docs.select("doc_id", F.when(F.col("text").rlike(r"\p{L}"), F.lower("text").cast("binary")).alias("body"))
    schema = docs.select("doc_id").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Ppm = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                body = batch.column("body").to_pylist()
                pred, score = ["und"] * len(body), np.zeros(len(body))
                real = [i for i, b in enumerate(body) if b is not None]
                if m.langs and real:
                    bits = m.tree.sums([body[i] for i in real], m.bits)
                    best = bits.argmin(axis=1)
                    share = 1 / np.exp2(np.maximum(bits.min(axis=1, keepdims=True) - bits, -1000)).sum(axis=1)
                    for k, i in enumerate(real):
                        pred[i], score[i] = m.langs[best[k]], share[k]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(pred), pa.array(score)], names=schema.names)

    return known.mapInArrow(run, schema)


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def op8_ppm_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from two folds of three."""
    docs = documents(spark, sf_dir)
    learn = docs.where((fold(F.col("doc_id"), 3) != 1) & F.col("text").isNotNull() & F.col("lang").isNotNull())
    found = identify(docs, fit(learn.select("doc_id", "lang", "text")))
    return found.select("doc_id", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
