"""Mixing sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources a document
belongs to).  A pattern can supply its tokens up to ``repeats`` times; each
further pass over it costs more (convex).  A min-cost flow over patterns and
sources routes token capacity to the source quotas.  Patterns and sources that are
joined by no shared document are networks of their own: one of a single pattern and
source has one path, and Spark expressions give its flow; every other one goes to a
task of its own, whole, as a table of patterns (not of documents).  From the flow each
(pattern, source) gets a whole number of passes plus a remainder; the remainder is
filled with documents in seeded hash order.

Size: number of runs of characters outside [\\x20\\x09-\\x0D]; a null text has 0.
Quotas: sources in code-point order, null last, weigh 1, 2, 3, 1, 2, 3, ...; they
share the sum of all sizes; a quota stops at ``repeats`` times its source's size
and the excess is shared again by weight (sums per round; any number of sources).

A document whose doc_id and text are repeated is decided alike on every copy.
Documents of size 0 are never taken.  Very long texts count whole.  An empty table
gives an empty result.

Nothing per document is collected or sorted in one task: the cut in the hash
order comes from sums per hash block, then from the rows of the one block in
which the remainder ends.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from conformkit.operators.positions import number_rows

from .common import columns, table, written
from .components import components

WEIGHTS = (1.0, 2.0, 3.0)
REPEATS = 3
BLOCK_BITS = 14


def words(text: Column) -> Column:
    """Runs of characters outside [\\x20\\x09-\\x0D]; a null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long"), F.lit(0).cast("long"))


def targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """source, source_size, target from (source, source_size).

    The share of a unit of weight rises as sources reach their limit, so those that
    are limited stay so; each round is one row of sums."""
    at = number_rows(sizes, [F.col("source").asc_nulls_last()], "place")
    rows = written(at.withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.col("place") % len(weights)).cast("int")))
                   .withColumn("most", (F.col("source_size") * repeats).cast("double")).drop("place"), "source_weights")
    share, limited = None, None
    while True:
        over = F.lit(False) if share is None else F.col("weight") * share > F.col("most")
        got = rows.agg(F.count_if(over).alias("n"), F.sum(F.col("source_size").cast("double")).alias("all"),
                       F.sum(F.when(over, F.col("most")).otherwise(0.0)).alias("held"),
                       F.sum(F.when(over, 0.0).otherwise(F.col("weight"))).alias("weight")).first()
        if got["n"] == limited or not got["weight"]:
            return rows.select("source", "source_size", F.when(over, F.col("most")).otherwise(
                F.col("weight") * F.lit(share or 0.0)).alias("target"))
        limited, share = got["n"], (got["all"] - got["held"]) / got["weight"]


def min_cost_flow(supply: list[tuple[int, list[int]]], quota: list[int],
                  repeats: int = REPEATS) -> dict[tuple[int, int], int]:
    """Route tokens from patterns to quotas at least cost.

    ``supply[p]`` is (tokens of pattern p, its sources).  Pass k (from 1) over a
    pattern costs k for each token.  All paths of the least cost are filled at once
    (by layers, as a maximum flow), then those of the next cost; costs are small
    whole numbers, so there are few rounds.  Returns {(pattern, source): tokens}."""
    n_p, n_s = len(supply), len(quota)
    end = n_p + n_s + 1
    graph: list[list[list]] = [[] for _ in range(end + 1)]

    def arc(a: int, b: int, cap: int, cost: int) -> None:
        graph[a].append([b, cap, cost, len(graph[b])])
        graph[b].append([a, 0, -cost, len(graph[a]) - 1])

    for p, (tokens, sources) in enumerate(supply):
        for k in range(1, repeats + 1):
            arc(0, 1 + p, tokens, k)
        for s in sources:
            arc(1 + p, 1 + n_p + s, repeats * tokens, 0)
    for s, q in enumerate(quota):
        arc(1 + n_p + s, end, q, 0)
    potential = [0] * (end + 1)
    while True:
        dist = [None] * (end + 1)
        dist[0], heap = 0, [(0, 0)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for b, cap, cost, _ in graph[a]:
                nd = d + cost + potential[a] - potential[b]
                if cap > 0 and (dist[b] is None or nd < dist[b]):
                    dist[b] = nd
                    heapq.heappush(heap, (nd, b))
        if dist[end] is None:
            break
        for v in range(end + 1):
            potential[v] += dist[v] if dist[v] is not None else dist[end]
        while _fill_layers(graph, potential, end):
            pass
    flow = {}
    for p, (tokens, _) in enumerate(supply):
        for b, cap, _, _ in graph[1 + p]:
            if b > n_p and repeats * tokens > cap:
                flow[p, b - 1 - n_p] = repeats * tokens - cap
    return flow


def _fill_layers(graph: list[list[list]], potential: list[int], end: int) -> bool:
    """Fill paths of the fewest arcs among those of least cost until none is left."""
    layer = [-1] * (end + 1)
    layer[0], queue = 0, [0]
    for a in queue:
        for b, cap, cost, _ in graph[a]:
            if cap > 0 and layer[b] < 0 and cost + potential[a] == potential[b]:
                layer[b] = layer[a] + 1
                queue.append(b)
    if layer[end] < 0:
        return False
    at = [0] * (end + 1)  # arcs before this one lead nowhere any more
    path: list[list] = []
    a = 0
    while True:
        if a == end:
            push = min(x[1] for x in path)
            for i, x in enumerate(path):
                x[1] -= push
                graph[x[0]][x[3]][1] += push
            first = next(i for i, x in enumerate(path) if not x[1])
            a = graph[path[first][0]][path[first][3]][0]
            del path[first:]
            continue
        while at[a] < len(graph[a]):
            x = graph[a][at[a]]
            if x[1] > 0 and layer[x[0]] == layer[a] + 1 and x[2] + potential[a] == potential[x[0]]:
                break
            at[a] += 1
        if at[a] < len(graph[a]):
            path.append(graph[a][at[a]])
            a = path[-1][0]
        elif a == 0:
            return True
        else:
            back = path.pop()
            a = graph[back[0]][back[3]][0]
            at[a] += 1


def sized(docs: DataFrame, seed: int, sources: str) -> DataFrame:
    """doc_id, size, sources (sorted pattern; a null source counts), key (the
    seeded order) of every document.  Column ``sources`` holds a document's one
    source or the array of its sources."""
    return docs.select("doc_id", words(F.col("text")).alias("size"),
                       pattern(docs, sources).alias("sources"),
                       order_key(F.col("doc_id"), F.col("text"), seed).alias("key"))


def pattern(docs: DataFrame, sources: str) -> Column:
    own = F.col(sources)
    if not isinstance(docs.schema[sources].dataType, ArrayType):
        own = F.array(own)
    return F.array_sort(F.array_distinct(own))


def order_key(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, F.crc32(F.coalesce(text, F.lit(""))))


FLOW = ("sources array<string>, source string, source_size long, target double, passes int, "
        "rest long, wraps boolean, from_words long, upto_words long")


def plan(rows: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """One row per (pattern, source): sources, source, source_size, target,
    passes, rest, wraps, from_cut, cut.  A document of the pattern is taken
    ``passes`` times for the source, and once more if there is a rest and its key
    is in [from_cut, cut) (wraps: outside [cut, from_cut)).  Written, so that its
    size is known and joins with it are planned by it."""
    patterns = written(rows.groupBy("sources").agg(F.sum("size").cast("long").alias("tokens")), "patterns")
    each = patterns.select("sources", "tokens", F.explode("sources").alias("source"))
    quota = targets(each.groupBy("source").agg(F.sum("tokens").alias("source_size")), weights, repeats)
    several = patterns.where(F.size("sources") > 1)
    overlaps = not several.isEmpty()
    if overlaps:  # quotas share the tokens once
        sums = [df.agg(F.sum(c)).first()[0] for df, c in ((patterns, "tokens"), (quota, "source_size"))]
        quota = quota.withColumn("target", F.col("target") * (sums[0] / max(1, sums[1])))
    supply = each.join(quota.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    if overlaps:
        supply = written(supply, "supply")
        net = networks(several)
        supply = supply.join(net, source_name(F.col("source")) == F.col("node"), "left")
        flows = alone(supply.where("net IS NULL"), repeats).union(
            supply.where("net IS NOT NULL").groupBy("net").applyInArrow(lambda t: routed(t, repeats), FLOW))
    else:
        flows = alone(supply, repeats)
    flows = written(flows, "flows")
    ends = flows.select("sources", F.explode(F.array_distinct(F.array("from_words", "upto_words"))).alias("w"))
    cuts = written(_cuts(rows, ends), "cuts")
    low, high = cuts.alias("l"), cuts.alias("h")
    out = (flows.alias("f")
           .join(low, F.expr("f.sources <=> l.sources AND f.from_words = l.w"), "left")
           .join(high, F.expr("f.sources <=> h.sources AND f.upto_words = h.w"), "left")
           .select("f.sources", "f.source", "f.source_size", "f.target", "f.passes", "f.rest", "f.wraps",
                   F.col("l.cut").alias("from_cut"), F.col("h.cut").alias("cut")))
    return written(out, "plan")


def source_name(source: Column) -> Column:
    return F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))


def networks(several: DataFrame) -> DataFrame:
    """node (name of a source), net: the sources that shared documents join."""
    names = several.select(F.transform("sources", source_name).alias("names"))
    edges = names.select(F.get("names", 0).alias("a"), F.explode("names").alias("b"))
    roots = written(components(edges), "networks")
    first = roots.select(F.col("root").alias("node"), F.col("root").alias("net")).distinct()
    return roots.select("node", F.col("root").alias("net")).union(first)


def alone(supply: DataFrame, repeats: int) -> DataFrame:
    """The flow of sources that share no document: up to the quota, spread evenly."""
    flow = F.least(F.rint("target").cast("long"), F.col("tokens") * repeats)
    some = F.col("tokens") > 0
    passes = F.when(some, F.floor(flow / F.col("tokens"))).otherwise(0).cast("int")
    rest = F.when(some, F.pmod(flow, F.col("tokens"))).otherwise(0).cast("long")
    return supply.select("sources", "source", "source_size", "target", passes.alias("passes"), rest.alias("rest"),
                         F.lit(False).alias("wraps"), F.lit(0).cast("long").alias("from_words"), rest.alias("upto_words"))


def routed(t: pa.Table, repeats: int) -> pa.Table:
    """The flow of one network."""
    rows = t.to_pylist()
    order = lambda s: (s is None, s or "")
    names = sorted({r["source"] for r in rows}, key=order)
    at = {s: i for i, s in enumerate(names)}
    of = {r["source"]: r for r in rows}
    tokens = {tuple(r["sources"]): r["tokens"] for r in rows}
    patterns = sorted(tokens, key=lambda p: [order(s) for s in p])
    flow = min_cost_flow([(tokens[p], [at[s] for s in p]) for p in patterns],
                         [int(round(of[s]["target"])) for s in names], repeats)
    out = []
    for i, p in enumerate(patterns):
        start = 0  # the rests of a pattern follow each other round its documents
        for s in p:
            taken = flow.get((i, at[s]), 0)
            passes, rest = divmod(taken, tokens[p]) if tokens[p] else (0, 0)
            end = start + rest
            wraps = end > tokens[p]
            end -= tokens[p] if wraps else 0
            out.append((list(p), s, of[s]["source_size"], of[s]["target"], passes, rest, wraps, start, end))
            start = end
    types = (pa.list_(pa.string()), pa.string(), pa.int64(), pa.float64(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
    return pa.table([pa.array(c, kind) for c, kind in zip(zip(*out), types)], [f.split()[0] for f in FLOW.split(", ")])


def _cuts(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """For (sources, w): the key below which the pattern's documents, in key
    order, come nearest to w words.  Null where w is 0."""
    block = F.shiftright("key", 64 - BLOCK_BITS)
    keyed = rows.withColumn("block", block)
    sums = keyed.groupBy("sources", "block").agg(F.sum("size").alias("n"))
    upto = W.partitionBy("sources").orderBy("block")
    cum = sums.withColumn("after", F.sum("n").over(upto)).withColumn("before", F.col("after") - F.col("n"))
    hit = (ends.where("w > 0").join(cum, "sources")
           .where("before < w AND w <= after").select("sources", "w", "block", "before"))
    inside = (keyed.groupBy("sources", "block", "key").agg(F.sum("size").alias("n"))
              .join(hit, ["sources", "block"])
              .withColumn("upto", F.col("before") + F.sum("n").over(
                  W.partitionBy("sources", "w", "block").orderBy("key"))))
    # A document goes in if its middle lies before the end.
    return (inside.groupBy("sources", "w", "block")
            .agg(F.max(F.when(F.col("upto") - F.col("n") / 2 <= F.col("w"), F.col("key"))).alias("k"))
            .select("sources", "w", F.coalesce(
                F.col("k") + 1, F.shiftleft(F.col("block").cast("long"), 64 - BLOCK_BITS)).alias("cut")))


LEAST_KEY = -(1 << 63)


def times(key: Column) -> Column:
    """How often a document is taken for one (pattern, source) of ``plan``."""
    low = F.coalesce(F.col("from_cut"), F.lit(LEAST_KEY))
    cut = F.coalesce(F.col("cut"), F.lit(LEAST_KEY))
    inside = F.when(F.col("wraps"), (key >= low) | (key < cut)).otherwise((key >= low) & (key < cut))
    return F.col("passes") + (inside & (F.col("rest") > 0)).cast("int")


def mix(docs: DataFrame, seed: int = 7, sources: str = "source", weights=WEIGHTS,
        repeats: int = REPEATS) -> DataFrame:
    """doc_id, size, source, source_size, target, taken: one row per document and
    source it belongs to.  A plan that Spark knows to be small is sent to the
    documents; else both are shuffled by pattern, a hot one split by AQE."""
    rows = written(sized(docs, seed, sources), "sizes")
    p = plan(rows, weights, repeats)
    return (rows.join(p, rows["sources"] == p["sources"])
            .select("doc_id", "size", "source", "source_size", "target",
                    (F.col("size") * times(F.col("key"))).cast("long").alias("taken")))


def mixed_documents(docs: DataFrame, seed: int = 7, sources: str = "source", weights=WEIGHTS,
                    repeats: int = REPEATS) -> DataFrame:
    """The documents that the mix takes, each as often as it is taken, with the
    columns of ``docs``.  The text is not shuffled unless the plan is too large to be
    sent to it."""
    rows = written(sized(docs, seed, sources), "sizes")
    p = plan(rows, weights, repeats).select(
        "passes", "rest", "wraps", "from_cut", "cut", F.col("sources").alias("own"))
    key = order_key(F.col("text.doc_id"), F.col("text.text"), seed)
    whole = docs.select(F.struct(*columns(docs)).alias("text"), pattern(docs, sources).alias("own"))
    taken = F.when(words(F.col("text.text")) > 0, times(key)).otherwise(0)
    return (whole.join(p, "own").withColumn("n", taken).where("n > 0")
            .select("text", F.explode(F.sequence(F.lit(1), F.col("n"))))
            .select("text.*"))


def op9_min_cost_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken", "source")
