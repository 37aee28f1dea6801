"""Packing documents into token windows by Karmarkar-Karp multiway differencing.

A document is its token ids followed by id 1.  Each full window of a longer one is
a sequence of its own; what remains is an item.  Items are dealt by hash to groups
of about GROUP, and a group is packed in one task:

* Differencing.  Every item starts as a partial partition (its length and k - 1
  empty windows).  The two partitions with the largest imbalance (greatest less
  least window) are merged, the greatest window of one with the least of the other,
  until one is left: k near-equal windows.  k starts at the least count that can
  hold the group and rises whenever a window exceeds its capacity.
* Filling.  The fewest windows that the group's tokens fill are kept, the fullest
  ones; the items of the others are cut to fill them up exactly.  Less than one
  window is left over; it is cut into sequences whose lengths are powers of two, as
  those need no padding.

So no sequence is padded, whatever the group.  Only items that fill gaps are cut.

A null text is an empty one (id 1 alone).  Repeated rows are packed each on its own
(rows are dealt by their number too, so many copies of one row spread out).  Equal
lengths are ordered by doc_id, start and row number.  A very long text is a list of
full windows and one item.  An empty table gives an empty result.  Other columns are
not read.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed, table, written
from .packing import WordEncoder, tokenizer_path

TOKENS, END = 2048, 1
GROUP = 1024  # items packed together; a task's size, not a limit on anything
ITEM = "doc_id long, start long, length long, ids binary, ids_crc32 long, doc_tokens long, row long"
PIECE = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def items(docs: DataFrame, tokenizer: str, tokens: int = TOKENS, end: int = END) -> DataFrame:
    """Full windows (ids null) and items (ids as little-endian 32-bit numbers)."""
    names = [f.split()[0] for f in ITEM.split(", ")]
    types = [pa.binary() if n == "ids" else pa.int64() for n in names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = WordEncoder(tokenizer), 0
        for b in batches:
            for at in range(0, b.num_rows, 256):  # a few texts' words at a time
                part = b.slice(at, 256)
                out = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_batch(texts)):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for s in range(0, len(ids), tokens):
                        cut = ids[s:s + tokens].tobytes()
                        full = len(cut) == 4 * tokens
                        out.append((doc, s, len(cut) // 4, None if full else cut, zlib.crc32(cut), len(ids), row))
                        row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return docs.select("doc_id", "text").mapInArrow(freed(run), ITEM)


def differencing(length: np.ndarray, k: int) -> np.ndarray:
    """The window (0 to k - 1) of every item, sums near-equal."""
    n = len(length)
    if k == 1 or n == 0:
        return np.zeros(n, np.int64)
    # A partial partition: sums of its windows that are not empty, falling, and
    # their nodes; a node is an item or two nodes that share a window.
    heap = [(-int(x), i, np.array([x]), np.array([i])) for i, x in enumerate(length)]
    heapq.heapify(heap)
    above = np.arange(2 * n)
    made, order = n, n
    while len(heap) > 1:
        _, _, sa, na = heapq.heappop(heap)
        _, _, sb, nb = heapq.heappop(heap)
        a, b = len(sa), len(sb)
        if a + b <= k:  # the greatest windows of one meet empty ones of the other
            sums, nodes = np.concatenate([sa, sb]), np.concatenate([na, nb])
        else:
            alone_a, alone_b = k - b, k - a
            joined = np.arange(made, made + a + b - k)
            made += len(joined)
            above[na[alone_a:]] = joined
            above[nb[alone_b:][::-1]] = joined
            sums = np.concatenate([sa[:alone_a], sa[alone_a:] + sb[alone_b:][::-1], sb[:alone_b]])
            nodes = np.concatenate([na[:alone_a], joined, nb[:alone_b]])
        fall = np.argsort(-sums, kind="stable")
        sums, nodes = sums[fall], nodes[fall]
        least = int(sums[-1]) if len(sums) == k else 0
        heapq.heappush(heap, (least - int(sums[0]), order, sums, nodes))
        order += 1
    window = np.full(len(above), -1)
    window[heap[0][3]] = np.arange(len(heap[0][3]))
    for node in range(made - 1, -1, -1):  # a node is made after those below it
        if window[node] < 0:
            window[node] = window[above[node]]
    return window[:n]


def balanced(length: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(window of every item, sum of every window), no sum above the capacity."""
    total = int(length.sum())
    k = max(1, -(-total // capacity))
    while True:
        window = differencing(length, k)
        sums = np.bincount(window, length, minlength=k).astype(np.int64)
        over = int(sums.max(initial=0)) - capacity
        if over <= 0:
            return window, sums
        # Leave each window as much room as the greatest one lacked.
        room = max(1, total // k - over)
        k = min(max(k + 1, -(-total // room)), max(len(length), k + 1))


def filled(length: np.ndarray, capacity: int) -> np.ndarray:
    """Rows (item, start in the item, length, sequence, offset); every sequence is
    full or has a power of two of tokens."""
    if not len(length):
        return np.zeros((0, 5), np.int64)
    window, sums = balanced(length, capacity)
    full, rest = divmod(int(length.sum()), capacity)
    by_sum = np.argsort(-sums, kind="stable")
    place = np.empty(len(sums), np.int64)
    place[by_sum] = np.arange(len(sums))
    window, sums = place[window], sums[by_sum]
    powers = [1 << i for i in range(rest.bit_length() - 1, -1, -1) if rest >> i & 1]
    # Items of kept windows, in order.
    kept = np.flatnonzero(window < full)
    kept = kept[np.argsort(window[kept], kind="stable")]
    before = np.cumsum(length[kept]) - length[kept]
    base = np.concatenate([[0], np.cumsum(sums[:full])])
    rows = np.stack([kept, np.zeros_like(kept), length[kept], window[kept], before - base[window[kept]]], 1)
    # The others' tokens on a line, cut at the ends of items and of gaps.
    loose = np.flatnonzero(window >= full)
    loose = loose[np.argsort(window[loose], kind="stable")]
    item_end = np.cumsum(length[loose])
    gaps = np.concatenate([capacity - sums[:full], np.array(powers, np.int64)])
    gap_end = np.cumsum(gaps)
    cuts = np.unique(np.concatenate([[0], item_end, gap_end]))
    at, size = cuts[:-1], np.diff(cuts)
    item = np.searchsorted(item_end, at, "right")
    gap = np.searchsorted(gap_end, at, "right")
    item_start, gap_start = item_end - length[loose], gap_end - gaps
    used = np.concatenate([sums[:full], np.zeros(len(powers), np.int64)])
    return np.concatenate([rows, np.stack([loose[item], at - item_start[item], size, gap,
                                           used[gap] + at - gap_start[gap]], 1)])


def pack(rows: DataFrame, tokens: int = TOKENS, group: int = GROUP) -> DataFrame:
    """The pieces of the rows of ``items`` and their places in sequences."""
    rows = written(rows, "items")
    groups = max(1, -(-rows.count() // group))
    dealt = rows.withColumn("g", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "row"), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), *[(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "row")]])
        number = {c: t[c].to_numpy(zero_copy_only=False) for c in ("start", "length", "ids_crc32", "doc_tokens")}
        whole = np.flatnonzero(number["length"] == tokens)
        rest = np.flatnonzero(number["length"] < tokens)
        cut = filled(number["length"][rest], tokens)
        item = rest[cut[:, 0]]
        ids = t["ids"].combine_chunks()
        crc = [zlib.crc32(ids[int(i)].as_buffer()[4 * s:4 * (s + n)]) if n != number["length"][i] else number["ids_crc32"][i]
               for i, s, n in zip(item, cut[:, 1].tolist(), cut[:, 2].tolist())]
        row = np.concatenate([whole, item])
        zero = np.zeros(len(whole), np.int64)
        base = t["g"][0].as_py() << 32
        out = {
            "doc_id": t["doc_id"].take(pa.array(row)),
            "start": number["start"][row] + np.concatenate([zero, cut[:, 1]]),
            "length": np.concatenate([number["length"][whole], cut[:, 2]]),
            "ids_crc32": np.concatenate([number["ids_crc32"][whole], np.array(crc, np.int64)]),
            "doc_tokens": number["doc_tokens"][row],
            "sequence_id": base + np.concatenate([np.arange(len(whole)), len(whole) + cut[:, 3]]),
            "offset": np.concatenate([zero, cut[:, 4]])}
        return pa.table(out)

    return dealt.groupBy("g").applyInArrow(run, PIECE)


def op12_multiway_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(items(table(spark, sf_dir, "documents"), tokenizer_path()))
