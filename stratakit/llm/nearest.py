"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt into shards of up to ``SHARD_ROWS`` and ``SHARD_BYTES``: by the power of two of
their largest component, and by hash within one.  In each shard a graph is
built: a greedy search proposes neighbours for a vector, and pruning with
relaxed distances keeps diverse edges, both ways.  Every query runs a beam
search in every shard; exact inner products of the original vectors in double
precision rank what the shards return.  Queries meet a shard in blocks of the
same order of size as its index, so an index is copied once for each such block
and not for every few queries.

How wide a beam must be depends on the vectors: a few hundred nodes do where they
lie in clusters, and most of a shard where all directions are alike.  So each
shard measures, against brute force over itself, what its graph finds for a
sample of its vectors, and keeps the beam that reaches ``GOAL`` with its index.

Inner product is brought to Euclidean distance by one more coordinate that
gives all vectors of a shard its largest norm.  As norms of one shard are of one
order, a few very long vectors don't blur the distances of the others.  Equal
vectors are one node that carries its least ids: as many as any answer can use.

Rows: a null ``vec_id``; null, empty or zero vectors; and those with null or
non-finite components, or of another length than most, take no part.  Rows
repeated in full count once; rows that share an id with other vectors are queries
and candidates each, and only its own row is left out of a query's answers.  Ties go to the smaller ``vec_id``.  An empty
table gives an empty result.  Only named columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from stratakit.llm.common import staged

K = 20
#: Bytes of vectors in a shard, and of queries in a block.
SHARD_BYTES, BLOCK_BYTES = 1 << 28, 1 << 27
#: Rows of a shard: in larger graphs of this degree the same beam finds less.
SHARD_ROWS = 16384
#: Shards of small tables, for graphs to be built side by side; a shard isn't made smaller than ``SMALL_SHARD`` rows for that.
LEAST_SHARDS, SMALL_SHARD = 4, 4096
DEGREE, BUILD_BEAM, ALPHA = 48, 96, 1.2
#: The narrowest beam of a search; a shard whose beam finds less than ``GOAL`` of the
#: nearest of ``SAMPLE`` of its own vectors gets one twice as wide, and so on.
SEARCH_BEAM, GOAL, SAMPLE = 112, 0.97, 64
ENTRIES, WIDTH = 8, 4
_CHUNK = 256


def beam_search(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids (-1: none) and similarities of the ``beam`` best nodes found for each
    query, best first.  All queries step together."""
    n, q = len(x), len(queries)
    beam = min(beam, n)
    seen = np.zeros((q, n + 1), dtype=bool)
    seen[:, n] = True
    ids = np.broadcast_to(entries, (q, len(entries))).copy()
    seen[np.arange(q)[:, None], ids] = True
    sims = queries @ x[entries].T
    order = np.argsort(-sims, axis=1)[:, :beam]
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    done = np.zeros(ids.shape, dtype=bool)
    rows = np.arange(q)
    while len(rows):
        # The best unexpanded nodes of each active query, WIDTH at a time.
        rank = np.cumsum(~done[rows], axis=1)
        pick = ~done[rows] & (rank <= WIDTH) & (sims[rows] > -np.inf)
        active = pick.any(axis=1)
        rows, pick = rows[active], pick[active]
        if not len(rows):
            break
        width = min(WIDTH, pick.shape[1])
        at = np.argsort(~pick, axis=1, kind="stable")[:, :width]
        real = np.take_along_axis(pick, at, 1)
        node = np.where(real, np.take_along_axis(ids[rows], at, 1), n)
        done[rows[:, None], at] |= real
        new = graph[node].reshape(len(rows), -1)
        fresh = ~seen[rows[:, None], new]
        seen[rows[:, None], new] = True
        score = np.where(fresh, np.einsum("qd,qmd->qm", queries[rows], x[np.where(fresh, new, 0)]), -np.inf)
        all_ids = np.concatenate([ids[rows], new], axis=1)
        all_sims = np.concatenate([sims[rows], score], axis=1)
        all_done = np.concatenate([done[rows], ~fresh], axis=1)
        order = np.argsort(-all_sims, axis=1, kind="stable")
        all_ids, all_sims, all_done = (np.take_along_axis(a, order, 1) for a in (all_ids, all_sims, all_done))
        twin = np.zeros(all_ids.shape, dtype=bool)
        twin[:, 1:] = all_ids[:, 1:] == all_ids[:, :-1]
        if twin.any():
            all_sims[twin], all_done[twin] = -np.inf, True
            order = np.argsort(-all_sims, axis=1, kind="stable")
            all_ids, all_sims, all_done = (np.take_along_axis(a, order, 1) for a in (all_ids, all_sims, all_done))
        if ids.shape[1] < beam:
            more = beam - ids.shape[1]
            ids, sims, done = np.pad(ids, ((0, 0), (0, more)), constant_values=n), np.pad(sims, ((0, 0), (0, more)), constant_values=-np.inf), np.pad(done, ((0, 0), (0, more)), constant_values=True)
        take = min(beam, all_ids.shape[1])
        ids[rows, :take], sims[rows, :take], done[rows, :take] = all_ids[:, :take], all_sims[:, :take], all_done[:, :take]
    return np.where(sims > -np.inf, ids, -1), sims


def robust_prune(x: np.ndarray, nodes: np.ndarray, cands: np.ndarray, degree: int, alpha: float) -> np.ndarray:
    """For each node up to ``degree`` of its candidates (``len(x)``: none): the
    nearest stays and removes those that are closer to it, relaxed by ``alpha``,
    than to the node; then the nearest of the rest; and so on."""
    n = len(x)
    cands = np.sort(cands, axis=1)
    cands[:, 1:][cands[:, 1:] == cands[:, :-1]] = n
    cands[cands == nodes[:, None]] = n
    points = x[np.minimum(cands, n - 1)]
    norm = float((x[0] * x[0]).sum())
    far = np.where(cands < n, np.maximum(2 * (norm - np.einsum("bd,bcd->bc", x[nodes], points)), 0), np.inf)
    order = np.argsort(far, axis=1, kind="stable")
    cands, far, points = np.take_along_axis(cands, order, 1), np.take_along_axis(far, order, 1), np.take_along_axis(points, order[:, :, None], 1)
    between = np.maximum(2 * (norm - points @ points.transpose(0, 2, 1)), 0) * (alpha * alpha)
    alive, b = far < np.inf, np.arange(len(nodes))
    out = np.full((len(nodes), degree), n, dtype=np.int32)
    for r in range(degree):
        some = alive.any(axis=1)
        if not some.any():
            break
        first = alive.argmax(axis=1)
        out[some, r] = cands[b, first][some]
        alive &= ~(between[b, first] <= far)
        alive[b, first] = False
    return out


def build_graph(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, alpha: float = ALPHA, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The graph, ``n`` + 1 rows of neighbours (``n``: none), and entry nodes.
    All rows of ``x`` have one norm."""
    n, rng = len(x), np.random.default_rng(seed)
    entries = np.unique(np.concatenate([[int((x @ x.mean(axis=0)).argmax())], rng.integers(0, n, ENTRIES - 1)]))
    graph = np.full((n + 1, degree), n, dtype=np.int32)
    if n <= degree:
        for i in range(n):
            graph[i, : n - 1] = np.delete(np.arange(n), i)
        return graph, entries
    graph[:n, : degree // 2] = rng.integers(0, n, (n, degree // 2))
    order = rng.permutation(n)
    for at in range(0, n, _CHUNK):
        nodes = order[at : at + _CHUNK]
        found, _ = beam_search(x, graph, entries, x[nodes], beam)
        graph[nodes] = robust_prune(x, nodes, np.concatenate([np.where(found < 0, n, found), graph[nodes]], axis=1), degree, alpha)
        # The edges back: appended where there is room, else pruned anew.
        to, source = graph[nodes].ravel(), np.repeat(nodes, degree)
        source, to = source[to < n], to[to < n]
        by = np.argsort(to, kind="stable")
        source, to = source[by], to[by]
        heads, first, count = np.unique(to, return_index=True, return_counts=True)
        place = np.arange(len(to)) - np.repeat(first, count)
        wide = np.full((len(heads), degree + min(int(count.max()), degree)), n, dtype=np.int32)
        wide[:, :degree] = graph[heads]
        fits = place < wide.shape[1] - degree
        wide[np.repeat(np.arange(len(heads)), count)[fits], degree + place[fits]] = source[fits]
        for lo in range(0, len(heads), _CHUNK):
            graph[heads[lo : lo + _CHUNK]] = robust_prune(x, heads[lo : lo + _CHUNK], wide[lo : lo + _CHUNK], degree, alpha)
    return graph, entries


def needed_beam(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, k: int = K + 1, seed: int = 6) -> int:
    """The beam with which a search of this graph finds ``GOAL`` of the ``k``
    nearest of a sample of its own vectors."""
    own = np.random.default_rng(seed).permutation(len(x))[:SAMPLE]
    k, beam = min(k, len(x)), SEARCH_BEAM
    exact = x[own] @ x.T
    least = -np.partition(-exact, k - 1, axis=1)[:, k - 1 : k]  # of the k nearest; ties are as good
    while beam < len(x):
        found, _ = beam_search(x, graph, entries, x[own], beam)
        hit = np.take_along_axis(exact, np.maximum(found, 0), 1) >= least * (1 - 1e-6 * np.sign(least))
        if (np.minimum((hit & (found >= 0)).sum(axis=1), k)).mean() >= GOAL * k:
            break
        beam *= 2
    return min(beam, len(x))


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, vector`` of the rows that take part."""
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("vector")).where("vec_id IS NOT NULL AND size(vector) > 0")
    rows = rows.where("forall(vector, v -> v IS NOT NULL AND NOT isnan(v) AND abs(v) < double('infinity')) AND exists(vector, v -> v <> 0)")
    lengths = rows.groupBy(F.size("vector").alias("n")).agg(F.count(F.lit(1)).alias("k"))
    best = lengths.agg(F.max_by("n", F.struct("k", (-F.col("n")).alias("m"))).alias("dim"))
    return rows.join(F.broadcast(best), F.size("vector") == F.col("dim")).drop("dim")


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.values.to_numpy()[flat.offsets[0].as_py() :].reshape(len(flat), -1) if len(flat) else np.zeros((0, 1))


def augmented(v: np.ndarray) -> np.ndarray:
    """Vectors in single precision, relative to their largest norm, with the
    coordinate that gives all of them that norm."""
    v = v / np.abs(v).max()
    square = (v * v).sum(axis=1)
    rest = np.sqrt(np.maximum(square.max() - square, 0))
    return (np.concatenate([v, rest[:, None]], axis=1) / np.sqrt(square.max())).astype(np.float32)


def dealt(nodes: DataFrame, shard_rows: int) -> tuple[DataFrame, int]:
    """``shard, rep, least, vector``, and the number of shards.

    A band is a power of two, so there are at most some 2,100 of them; their
    sizes are what reaches the driver.
    """
    banded = nodes.withColumn("band", F.floor(F.log2(F.array_max(F.transform("vector", F.abs)))).cast("int"))
    sizes, table, first = banded.groupBy("band").count().orderBy("band").collect(), [], 0
    for r in sizes:
        table.append((r["band"], first, -(-r["count"] // shard_rows)))
        first += table[-1][2]
    bands = nodes.sparkSession.createDataFrame(table, "band int, first int, parts int")
    shard = F.col("first") + F.pmod(F.xxhash64("least", "vector"), F.col("parts")).cast("int")
    return banded.join(F.broadcast(bands), "band").select(shard.alias("shard"), "rep", "least", "vector"), first


def indexed(shards: DataFrame) -> DataFrame:
    """One row for each shard: the beam to search it with, its ids, vectors, graph
    and entry nodes."""

    def run(group: pa.Table) -> pa.Table:
        v = _matrix(group.column("vector"))
        graph, entries = build_graph(augmented(v))
        beam = needed_beam((v / np.abs(v).max()).astype(np.float32), graph, entries)
        return pa.table({"shard": group.column("shard")[:1], "beam": pa.array([beam], pa.int32()), "ids": pa.array([group.column("rep").to_numpy().tobytes()], pa.binary()), "least": pa.array([group.column("least").to_numpy().tobytes()], pa.binary()), "vectors": pa.array([v.tobytes()], pa.binary()), "graph": pa.array([graph.tobytes()], pa.binary()), "entries": pa.array([entries.astype(np.int64).tobytes()], pa.binary())})

    return shards.groupBy("shard").applyInArrow(run, "shard int, beam int, ids binary, least binary, vectors binary, graph binary, entries binary")


def searched(index: DataFrame, queries: DataFrame, shards: int, blocks: int, keep: int) -> DataFrame:
    """``q, rep, least, score``: for each query vector the ``keep`` best of each
    shard; ties go to the node whose ``least`` id is smaller."""
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = queries.select(F.col("rep").alias("q"), "vector", F.pmod(F.xxhash64("rep", F.lit(1)), F.lit(blocks)).cast("int").alias("of_block"), F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))).alias("of_shard"))

    def run(one: pa.Table, asked: pa.Table) -> pa.Table:
        q, rep, low, score = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if one.num_rows and asked.num_rows:
            get = lambda c, t: np.frombuffer(one.column(c)[0].as_py(), dtype=t)
            ids, least, entries = get("ids", np.int64), get("least", np.int64), get("entries", np.int64)
            v = get("vectors", np.float64).reshape(len(ids), -1)
            graph = get("graph", np.int32).reshape(len(ids) + 1, -1)
            x, asked_v, asked_q = (v / np.abs(v).max()).astype(np.float32), _matrix(asked.column("vector")), asked.column("q").to_numpy()
            for at in range(0, len(asked_q), _CHUNK):
                own = asked_v[at : at + _CHUNK]
                found, _ = beam_search(x, graph, entries, (own / np.abs(own).max(axis=1, keepdims=True)).astype(np.float32), one.column("beam")[0].as_py())
                exact = np.einsum("qd,qmd->qm", own, v[np.maximum(found, 0)])
                exact[found < 0] = -np.inf
                order = np.lexsort((least[np.maximum(found, 0)], -exact), axis=1)[:, :keep]
                found, exact = np.take_along_axis(found, order, 1), np.take_along_axis(exact, order, 1)
                real = found >= 0
                q.append(np.broadcast_to(asked_q[at : at + _CHUNK, None], found.shape)[real])
                rep.append(ids[found[real]])
                low.append(least[found[real]])
                score.append(exact[real])
        return pa.table({"q": np.concatenate(q), "rep": np.concatenate(rep), "least": np.concatenate(low), "score": np.concatenate(score)})

    return left.groupBy("shard", "block").cogroup(right.groupBy("of_shard", "of_block")).applyInArrow(run, "q long, rep long, least long, score double")


def nearest(vectors: DataFrame, is_query, k: int = K, shard_rows: int | None = None, query_block: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products found
    for each row where the condition ``is_query`` holds, that row left out.

    ``shard_rows`` and ``query_block`` are rows of a shard and of a block of
    queries; None: as many as the bytes allow, and at least ``LEAST_SHARDS``
    shards where the table has rows enough.
    """
    rows = staged(usable(vectors))
    ids = W.partitionBy("vector").orderBy("vec_id")
    least = rows.distinct().withColumn("n", F.row_number().over(ids)).where(F.col("n") <= k + 1)
    same = least.groupBy("vector").agg(F.min("vec_id").cast("long").alias("least"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = staged(same.withColumn("rep", F.monotonically_increasing_id()))
    size = nodes.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("dim")).first()
    bytes_each = 8 * (size.dim or 1)
    by_shard, shards = dealt(nodes, shard_rows or max(1, min(SHARD_BYTES // bytes_each, SHARD_ROWS, max(SMALL_SHARD, -(-size.n // LEAST_SHARDS)))))
    asked = staged(rows.where(is_query).distinct().join(nodes.select("vector", "rep"), "vector").select(F.col("vec_id").alias("query_id"), "rep"))
    which = asked.select("rep").distinct()
    blocks = max(1, -(-which.count() // (query_block or max(1, BLOCK_BYTES // bytes_each))))
    index = staged(indexed(by_shard))
    found = staged(searched(index, nodes.join(which, "rep", "left_semi"), shards, blocks, k + 1))
    best = found.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "least", "rep"))).where(F.col("n") <= k + 1)
    spread = best.join(nodes.select("rep", "ids"), "rep").select("q", F.col("rep").alias("node"), "score", F.explode("ids").alias("vec_id"))
    spread = spread.withColumn("n", F.row_number().over(W.partitionBy("q").orderBy(F.desc("score"), "vec_id", "node"))).where(F.col("n") <= k + 1)
    answers = asked.join(spread.select("q", "node", "vec_id", "score"), F.col("rep") == F.col("q")).where("NOT (vec_id = query_id AND node = q)")
    rank = F.row_number().over(W.partitionBy("query_id", "rep").orderBy(F.desc("score"), "vec_id", "node"))
    return answers.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_pruned_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every embedding whose id 20 divides."""
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0)
