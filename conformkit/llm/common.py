"""Helpers shared by the operators: written tables, column access, and numpy
views of whole Arrow text columns.

Text helpers work on the UTF-8 buffers of an Arrow column, so a task never
builds one Python string per word.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.session import scratch_path

# The characters of [\x20\x09-\x0D].
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as Parquet under the shared checkpoint folder and read it
    back: later steps read files instead of recomputing, also after an executor
    was lost."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def columns(df: DataFrame) -> list[Column]:
    """Every column, names with dots too."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]


def without_white(col: Column) -> Column:
    for c in WHITE:
        col = F.replace(col, F.lit(c), F.lit(""))
    return col


def unit_hash(*cols: Column) -> Column:
    """A double in (0, 1) from the first 52 bits of an md5 of the given columns
    (the same in any engine that has md5)."""
    text = F.concat_ws("|", *[c.cast("string") for c in cols])
    top = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double")
    return (top + F.lit(0.5)) / F.lit(float(2 ** 52))


def text_buffers(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null has an empty span."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks() if col.num_chunks != 1 else col.chunk(0)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    if col.null_count:
        col = pc.fill_null(col, "")
    n = len(col)
    if n == 0 or col.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    off = np.frombuffer(col.buffers()[1], np.int64, n + 1, col.offset * 8)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


MULT = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64


class Powers:
    """MULT^i and MULT^-i modulo 2^64, grown as needed."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 20)
            inv = np.uint64(pow(int(MULT), -1, 1 << 64))
            for name, base in (("up", MULT), ("down", inv)):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))


def mix64(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                powers: Powers, block: int = 1 << 20) -> np.ndarray:
    """A 64-bit hash of the bytes of every span; spans are ascending and do not
    overlap.  Work goes in blocks of about ``block`` bytes."""
    out = np.empty(len(starts), np.uint64)
    a, n = 0, len(starts)
    while a < n:
        base = starts[a]
        b = max(a + 1, int(np.searchsorted(ends, base + block, "right")))
        seg = data[base:ends[b - 1]]
        powers.upto(len(seg) + 1)
        cum = np.zeros(len(seg) + 1, np.uint64)
        np.cumsum((seg.astype(np.uint64) + np.uint64(1)) * powers.up[:len(seg)], out=cum[1:])
        s, e = starts[a:b] - base, ends[a:b] - base
        out[a:b] = (cum[e] - cum[s]) * powers.down[s]
        a = b
    return mix64(out)


def runs(cls: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal non-zero class; no run crosses a
    document border."""
    n = len(cls)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    change = np.empty(n + 1, bool)
    change[0] = change[n] = True
    np.not_equal(cls[1:], cls[:-1], out=change[1:n])
    change[offsets] = True
    edge = np.flatnonzero(change)
    starts, ends = edge[:-1], edge[1:]
    keep = cls[starts] != 0
    return starts[keep], ends[keep]


def white_class() -> np.ndarray:
    """Byte class for words: 0 for white space, else 1."""
    t = np.ones(256, np.uint8)
    t[[ord(c) for c in WHITE]] = 0
    return t


def freed(run):
    """A task function for mapInArrow that hands its freed memory back to the
    system at its end: Python workers live on from stage to stage."""
    def go(batches):
        yield from run(batches)
        import ctypes
        import gc

        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim:
            trim(0)
    return go


def summed(df: DataFrame, count, rows: int, width: int) -> np.ndarray:
    """The sum over all rows of ``df`` of a (rows x width) integer matrix.

    ``count(batch, total)`` adds one Arrow batch to the task's matrix.  Each task
    gives one row per non-zero matrix row; Spark sums them, so what reaches the
    driver is one matrix of that fixed size, however large ``df`` is."""
    names = [f"c{i}" for i in range(width)]

    def run(batches):
        total = np.zeros((rows, width), np.int64)
        for b in batches:
            count(b, total)
        at = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *[pa.array(total[at, i]) for i in range(width)]], ["r", *names])

    schema = "r long, " + ", ".join(f"{n} long" for n in names)
    sums = (df.mapInArrow(freed(run), schema).groupBy("r")
            .agg(*[F.sum(n).alias(n) for n in names]).toArrow())
    out = np.zeros((rows, width), np.int64)
    if sums.num_rows:
        out[sums["r"].to_numpy()] = np.stack([sums[n].to_numpy() for n in names], 1)
    return out
