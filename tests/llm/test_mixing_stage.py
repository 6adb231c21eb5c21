"""The pipeline's mixing stage: seats of sources and shards by Sainte-Lague."""

import heapq
from collections import Counter

from pyspark.sql import functions as F
from stratakit.llm import mixing
from tests.conftest import SF_DIR
from tests.llm.cases import empty


def seats(weights, n):
    """Seat by seat, to the highest quotient; ties to the first."""
    heap = [(-w, i, 1) for i, w in enumerate(weights) if w > 0]
    won = Counter()
    for _ in range(n if heap else 0):
        _, i, d = heap[0]
        won[i] += 1
        heapq.heapreplace(heap, (-weights[i] / (d + 2), i, d + 2))
    return won


def test_stage_draws_what_sainte_lague_gives_sources_and_shards(spark):
    """Documents of just one block each, many shards: the draws are the quotas."""
    n = {"a": 1401, "b": 777, None: 203}
    rows = [(i, s) for i, s in enumerate(s for s, k in n.items() for _ in range(k))]
    sizes = spark.createDataFrame(rows, "doc_id long, source string").repartition(3).withColumns({"_text": F.xxhash64("doc_id"), "size": F.lit(256).cast("long")})
    for weights, share in (((3, 1, 2), 1.5), ((1, 7, 2), 0.37)):
        got = mixing.copies(sizes, weights, share, shard_words=256 * 40).withColumn(
            "shard", F.pmod(F.xxhash64(F.lit(mixing.SEED), "doc_id", F.xxhash64("doc_id")), F.ceil(F.col("source_size") / (256 * 40)).cast("long"))).collect()
        assert len(got) == len(rows) and all(0 <= r.copies <= 2 for r in got)
        target = {r.source: r.target for r in got}
        order = sorted(target, key=lambda s: (s is None, s or ""))
        blocks = seats([target[s] for s in order], round(sum(target.values()) / 256))
        for i, s in enumerate(order):
            docs, drawn = Counter(r.shard for r in got if r.source == s), Counter()
            for r in got:
                if r.source == s:
                    drawn[r.shard] += r.copies
            shards = sorted(docs)
            assert len(shards) > 5
            quota = seats([docs[h] for h in shards], blocks[i])
            assert {h: drawn[h] for h in shards[1:]} == {h: min(quota[k], 2 * docs[h]) for k, h in enumerate(shards) if k}
            assert abs(drawn[0] * 256 - min(quota[0] * 256 + round(target[s]) - blocks[i] * 256, 512 * docs[0])) < 256


def test_stage_with_rows_without_words_and_without_rows(spark):
    columns = "doc_id long, text string, source string"
    rows = [(1, None, "a"), (None, " ", None), (2, "one two", "a"), (3, "x y z", None), (3, "x y z w", None)]
    out = mixing.mixing_stage(spark, spark.createDataFrame(rows, columns), SF_DIR)
    assert out.columns == ["doc_id", "text", "source"] and {tuple(r) for r in out.collect()} <= set(rows[2:])
    assert mixing.mixing_stage(spark, spark.createDataFrame([], columns), SF_DIR).count() == 0
    assert mixing.copies(empty(spark).select("doc_id", "source", F.xxhash64("text").alias("_text"), F.lit(0).cast("long").alias("size"))).count() == 0
