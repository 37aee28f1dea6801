"""Sharding by a hierarchical weighted hash tree (native).

A tree has regions, racks and shards.  A row descends it: at each level every
child draws -ln(u) / weight with u a hash of (doc_id, child), and the smallest
draw wins, so a child gets rows in proportion to its weight (an inner node's
weight is the sum of its shards').  A draw depends on nothing but the row and
the child, so a changed weight moves rows only into or out of that child's
subtree, and a new region takes rows only into itself.  ``Tree.grown`` therefore
puts a new shard into a region of its own.  A tree may be opened only up to its
first ``open_shards`` shards: a row whose shard is closed goes by one more weighted
draw over the open ones, and ``grown`` opens the next shard, which takes rows only
into itself.  So the law ``key`` (doc_id and shard count decide; one more shard
takes rows only into itself) holds at every count.

A null doc_id is hashed as the text 'null'; repeated rows go to one shard.  A
null text has size 1 and the checksum of the empty text.  An empty table gives
an empty result.  Other columns are not read.

Slots are positions in the shard, gapless from 0.  They come from counts per
(shard, hash block) and a position inside the block, so no task holds a shard.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, unit_hash, written

ROWS_PER_BLOCK = 50_000  # rows that one task numbers together; only a task size


@dataclass(frozen=True)
class Tree:
    """regions[i][j][k]: weight of shard k in rack j of region i.  Shards are
    numbered in this order; those from ``open_shards`` on are closed (None: none)."""

    regions: tuple[tuple[tuple[float, ...], ...], ...]
    open_shards: int | None = None

    @staticmethod
    def of(n: int) -> "Tree":
        """n shards of weight 1: two regions of two racks of two, opened one
        shard after the other, then one region for each further shard."""
        tree = Tree(((((1.0, 1.0),) * 2),) * 2, 1)
        for _ in range(n - 1):
            tree = tree.grown()
        return tree

    def weights(self) -> list[float]:
        return [w for racks in self.regions for shards in racks for w in shards]

    def grown(self, weight: float | None = None) -> "Tree":
        """One more shard: the next closed one, which has its weight, or a region
        of its own of the given weight (1 without)."""
        if self.open_shards is None:
            return Tree((*self.regions, ((1.0 if weight is None else weight,),)))
        if weight not in (None, self.weights()[self.open_shards]):
            raise ValueError("a closed shard opens with its own weight")
        n = self.open_shards + 1
        return Tree(self.regions, n if n < len(self.weights()) else None)

    def shard(self, key: Column) -> Column:
        """The shard of a row: three nested choices of the smallest draw, and one
        more if that shard is closed."""
        first, regions = 0, []
        for r, racks in enumerate(self.regions):
            inside = []
            for k, shards in enumerate(racks):
                leaves = [(w, f"{r}/{k}/{s}", F.lit(first + s)) for s, w in enumerate(shards)]
                inside.append((sum(shards), f"{r}/{k}", _least(key, leaves)))
                first += len(shards)
            regions.append((sum(w for w, _, _ in inside), f"{r}", _least(key, inside)))
        first_choice = _least(key, regions)
        if self.open_shards is None:
            return first_choice
        again = [(w, f"open/{i}", F.lit(i)) for i, w in enumerate(self.weights()[:self.open_shards])]
        return F.when(first_choice < self.open_shards, first_choice).otherwise(_least(key, again))


def _least(key: Column, children: list[tuple[float, str, Column]]) -> Column:
    """The value of the child with the smallest draw; equal draws go to the
    first child."""
    children = [c for c in children if c[0] > 0]
    if len(children) == 1:
        return children[0][2]
    draws = [-F.log(unit_hash(key, F.lit(name))) / F.lit(float(w)) for w, name, _ in children]
    best = F.least(*draws)
    out = F.lit(None).cast("int")
    for d, (_, _, value) in reversed(list(zip(draws, children))):
        out = F.when(d == best, value).otherwise(out)
    return out


def numbered(df: DataFrame, group: str, order: list[str], n_rows: int,
             rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Add ``slot``: a gapless number from 0 within ``group``.  Rows are dealt to
    hash blocks of about ``rows_per_block`` rows; a block's first slot is the sum
    of the counts of the group's blocks before it (a table of one row per block)."""
    blocks = max(1, -(-n_rows // rows_per_block))
    dealt = df.withColumn("_block", F.pmod(F.xxhash64(*order), F.lit(blocks)))
    counts = dealt.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = W.partitionBy(group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    starts = counts.select(group, "_block", F.coalesce(F.sum("_n").over(before),
                                                       F.lit(0)).alias("_start"))
    inside = F.row_number().over(W.partitionBy(group, "_block").orderBy(*order)) - 1
    return (dealt.withColumn("_inside", inside).join(starts, [group, "_block"])
            .withColumn("slot", F.col("_start") + F.col("_inside"))
            .drop("_block", "_start", "_inside"))


def shard_documents(docs: DataFrame, tree: Tree) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"), F.lit("key").alias("law"),
        tree.shard(key).alias("shard"), tree.grown().shard(key).alias("grown_shard"))
    rows = written(rows, "sharded")
    return numbered(rows, "shard", ["doc_id", "size", "text_crc32"], rows.count()).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op5_hash_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), Tree.of(8))
