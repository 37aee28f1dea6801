"""Approximate nearest neighbours by robust-pruned directed graphs.

Vectors are dealt by hash to shards of about SHARD classes.  In a shard, points
join the graph in random batches: a beam search in the graph so far proposes
neighbours, and relaxed pruning keeps an edge to the nearest proposal and drops
every proposal that is ALPHA times nearer to a kept neighbour than to the point,
so that the kept edges are diverse.  Reverse edges are added and pruned the same
way.  A beam search from the shard's medoid answers a query in every shard, and
the best of all shards are merged.  Scores are Euclidean distances in double
precision on the original vectors.

Equal vectors (-0 equals 0) form a class that is one point of the graph; of a
class only the k + 1 smallest ids can ever be in an answer, so only those are
carried.  This keeps thousands of copies of one vector from crowding out
neighbours, and loses nothing.

Vectors that are null, zero, empty or hold null or non-finite components take no part.
Vectors of different lengths are never compared.  A repeated vec_id counts once
(the smallest vector by components).  Fewer than k candidates give all of them.
An empty table gives an empty result.  Other columns are not read.

Very long vectors are searched like others; equal distances go to the smaller vec_id,
also among points that tie with the last one of the beam's first k + 1.

Cost: a graph is built once per shard in one task of bounded size.  Every query goes
to every shard; a shard's task holds its graph and lets its queries stream by, so
graphs are shuffled once, whatever the number of queries.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import freed, table, written

K = 10
SHARD = 4096  # classes in a graph
DEGREE, BEAM, ALPHA, BATCH = 32, 64, 1.2, 256
SEARCH = 128  # beam of a query: recall of 0.95 or more on full shards


def distances(points: np.ndarray, rows: np.ndarray, to: np.ndarray) -> np.ndarray:
    """Squared distances of points[rows[i, j]] to to[i]; infinite for row -1."""
    d = points[rows] - to[:, None, :]
    out = np.einsum("ijk,ijk->ij", d, d)
    out[rows < 0] = np.inf
    return out


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, to: np.ndarray,
                beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest points that a greedy search finds, nearest first, and
    their squared distances, for every row of ``to`` at once (-1: none)."""
    n = len(to)
    found = np.full((n, beam), -1)
    dist = np.full((n, beam), np.inf)
    open_ = np.zeros((n, beam), bool)
    seen = np.zeros((n, len(points) + 1), bool)  # the last column stands for no point
    found[:, 0], open_[:, 0], seen[:, start] = start, True, True
    dist[:, 0] = distances(points, np.full((n, 1), start), to)[:, 0]
    active = np.arange(n)
    while len(active):
        nearest = np.argmax(open_[active], 1)  # found is sorted: the first open one
        open_[active, nearest] = False
        new = edges[found[active, nearest]].copy()
        at = np.where(new < 0, len(points), new)
        new[np.take_along_axis(seen[active], at, 1)] = -1
        seen[active[:, None], at] = True
        d = np.concatenate([dist[active], distances(points, new, to[active])], 1)
        order = np.argsort(d, 1, kind="stable")[:, :beam]
        dist[active] = np.take_along_axis(d, order, 1)
        found[active] = np.take_along_axis(np.concatenate([found[active], new], 1), order, 1)
        opened = np.concatenate([open_[active], new >= 0], 1)
        open_[active] = np.take_along_axis(opened, order, 1) & np.isfinite(dist[active])
        active = active[open_[active].any(1)]
    return found, dist


def robust_prune(points: np.ndarray, me: np.ndarray, proposed: np.ndarray, degree: int,
                 alpha: float) -> np.ndarray:
    """Up to ``degree`` diverse neighbours of points[me[i]] out of proposed[i]
    (-1: none), nearest first."""
    proposed = np.where(proposed == me[:, None], -1, proposed)
    by_id = np.sort(proposed, 1)
    by_id[:, 1:][by_id[:, 1:] == by_id[:, :-1]] = -1
    d = distances(points, by_id, points[me])
    order = np.argsort(d, 1, kind="stable")
    cand, d = np.take_along_axis(by_id, order, 1), np.take_along_axis(d, order, 1)
    alive = np.isfinite(d)
    out = np.full((len(me), degree), -1)
    row = np.arange(len(me))
    for k in range(degree):
        first = np.argmax(alive, 1)
        has = alive[row, first]
        if not has.any():
            break
        pick = np.where(has, cand[row, first], -1)
        out[:, k] = pick
        alive[row, first] = False
        between = distances(points, cand, points[np.maximum(pick, 0)])
        alive &= ~(has[:, None] & (alpha ** 2 * between <= d))
    return out


def build(points: np.ndarray, degree: int = DEGREE, beam: int = BEAM, alpha: float = ALPHA,
          seed: int = 5) -> tuple[np.ndarray, int]:
    """(edges, start): the graph of a shard."""
    n = len(points)
    edges = np.full((n, degree), -1)
    start = int(np.argmin(((points - points.mean(0)) ** 2).sum(1)))
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    done = 1
    while done < n:
        me = order[done:done + min(done, BATCH)]  # never more than are in the graph
        near, _ = beam_search(points, edges, start, points[me], beam)
        # Points of one batch may be each other's neighbours too.
        peers = np.broadcast_to(me, (len(me), len(me)))
        if len(me) > beam:
            gap = ((points[me][:, None, :] - points[me][None]) ** 2).sum(2)
            peers = me[np.argpartition(gap, beam, 1)[:, :beam]]
        edges[me] = robust_prune(points, me, np.concatenate([near, peers], 1), degree, alpha)
        source = np.repeat(me, degree)
        target = edges[me].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by = np.argsort(target, kind="stable")
        source, target = source[by], target[by]
        to, first, many = np.unique(target, return_index=True, return_counts=True)
        back = np.full((len(to), int(many.max())), -1)
        back[np.repeat(np.arange(len(to)), many), np.arange(len(target)) - np.repeat(first, many)] = source
        for at in range(0, len(to), BATCH):
            rows = to[at:at + BATCH]
            edges[rows] = robust_prune(points, rows, np.concatenate([edges[rows], back[at:at + BATCH]], 1),
                                       degree, alpha)
        done += len(me)
    return edges, start


def sound_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, vector (array<double>) of the rows that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (vectors.where(F.coalesce(finite, F.lit(False)) & F.col("vec_id").isNotNull())
            .select("vec_id", F.transform(v, lambda x: x.cast("double") + 0.0).alias("vector"))
            .where(F.exists("vector", lambda x: x != 0)))
    return rows.groupBy("vec_id").agg(F.min("vector").alias("vector"))


def classes(vectors: DataFrame, k: int) -> DataFrame:
    """vector and the k + 1 smallest vec_ids of each class of equal vectors."""
    place = F.row_number().over(W.partitionBy("vector").orderBy("vec_id"))
    return (sound_vectors(vectors).withColumn("place", place).where(F.col("place") <= k + 1)
            .groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))


def search(vectors: DataFrame, queries: DataFrame, k: int = K, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest vectors (vec_id, embedding) of
    every query (the same columns), the query's own row left out."""
    points = written(classes(vectors, k), "vector_classes")
    asked = written(sound_vectors(queries).withColumnRenamed("vec_id", "query_id"), "vector_queries")
    shards = max(1, -(-points.count() // shard))
    points = points.withColumn("shard", F.pmod(F.xxhash64("vector"), F.lit(shards)).cast("int"))

    def graph(t: pa.Table) -> pa.Table:
        """Edges of a shard, one graph per vector length; row numbers follow the
        order of the vectors."""
        t = t.sort_by([("first", "ascending")])
        size = np.array([len(v) for v in t["vector"]])
        links: list = [None] * len(size)
        start = np.zeros(len(size), bool)
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            edges, first = build(np.array(t["vector"].take(pa.array(at)).to_pylist(), float))
            for i, e in zip(at, edges):
                links[i] = at[e[e >= 0]].tolist()
            start[at[first]] = True
        t = t.append_column("row", pa.array(np.arange(len(size), dtype=np.int32)))
        t = t.append_column("edges", pa.array(links, pa.list_(pa.int32())))
        return t.append_column("start", pa.array(start)).drop_columns(["first"])

    graphs = written(
        points.withColumn("first", F.col("ids")[0]).groupBy("shard")
        .applyInArrow(graph, "vector array<double>, ids array<long>, shard int, row int, "
                             "edges array<int>, start boolean"), "vector_graphs")
    def prepared(points: pa.Table) -> dict[int, tuple]:
        """By vector length: points, edges, start and ids of a shard's graph."""
        points = points.sort_by([("row", "ascending")])
        size = np.array([len(v) for v in points["vector"]])
        out = {}
        for dim in np.unique(size):
            at = np.flatnonzero(size == dim)
            new = np.full(len(size), -1)
            new[at] = np.arange(len(at))
            part = points.take(pa.array(at))
            edges = np.full((len(at), DEGREE), -1)
            for i, e in enumerate(part["edges"].to_pylist()):
                edges[i, :len(e)] = new[e]
            start = int(np.flatnonzero(part["start"].to_numpy())[0])
            out[int(dim)] = np.array(part["vector"].to_pylist(), float), edges, start, part["ids"].to_pylist()
        return out

    def answer(graph: dict[int, tuple], asked: pa.RecordBatch) -> pa.RecordBatch:
        found: list[tuple] = []
        wanted = np.array([len(v) for v in asked.column("vector")])
        for dim in np.unique(wanted):
            if int(dim) not in graph:
                continue
            x, edges, start, ids = graph[int(dim)]
            of = pa.array(np.flatnonzero(wanted == dim))
            q = np.array(asked.column("vector").take(of).to_pylist(), float)
            own = asked.column("id").take(of).to_pylist()
            for a in range(0, len(q), BATCH):
                near, dist = beam_search(x, edges, start, q[a:a + BATCH], max(SEARCH, 2 * k))
                for i, me in enumerate(own[a:a + BATCH]):
                    # Points as far as the last of the first k + 1 stay: vec_id decides among them.
                    tied = dist[i] <= dist[i][min(k, len(dist[i]) - 1)]
                    hits = [(float(np.sqrt(d)), v, me) for p, d in zip(near[i][tied], dist[i][tied]) if p >= 0
                            for v in ids[p] if v != me]
                    found += sorted(hits)[:k]
        score, vec, me = zip(*found) if found else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(me, pa.int64()), pa.array(vec, pa.int64()), pa.array(score, pa.float64())],
                                          ["query_id", "vec_id", "score"])

    def stream(batches):
        """Rows come by shard, its graph first and then its queries."""
        held, graph, of = [], None, None
        for b in batches:
            part, asks = b.column("shard").to_numpy(), ~b.column("row").is_valid().to_numpy(zero_copy_only=False)
            edge = np.flatnonzero((np.diff(part) != 0) | (np.diff(asks.astype(np.int8)) != 0)) + 1
            for a, z in zip([0, *edge], [*edge, b.num_rows]):
                if a == z:
                    continue
                rows = b.slice(int(a), int(z - a))
                if part[a] != of:
                    held, graph, of = [], None, part[a]
                if not asks[a]:
                    held.append(rows)
                    continue
                if graph is None:
                    graph = prepared(pa.Table.from_batches(held)) if held else {}
                    held = []
                yield answer(graph, rows)

    both = graphs.select("shard", "row", F.lit(None).cast("long").alias("id"), "vector", "ids", "edges", "start").union(
        asked.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(None).cast("int"), "query_id",
                     "vector", F.lit(None).cast("array<long>"), F.lit(None).cast("array<int>"), F.lit(None).cast("boolean")))
    streamed = both.repartition("shard").sortWithinPartitions("shard", F.col("row").isNull())
    hits = streamed.mapInArrow(freed(stream), "query_id long, vec_id long, score double")
    rank = F.row_number().over(W.partitionBy("query_id").orderBy("score", "vec_id"))
    return (hits.withColumn("rank", rank).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def op3_pruned_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(vectors, vectors.where("vec_id % 100 = 0"))
