"""Spelling variants: words one edit apart, found by scanning sorted word lists.

Words are runs of letters; two are near if exactly one code point is inserted,
deleted or replaced.  A word's form is its near word of largest count, if that
count is at least RATIO times its own; its root is the end of the chain of forms.

Lists.  Of two near words, the shorter (or equal) of s letters, either the first or
the last s // 2 letters are the same.  So every word goes into the lists of its own
length and of one letter less, once by its first and once by its last letters, and
a list holds what those leave of it.  A list of more than CELLS letters is split by
the same rule over what is left; with one letter left a list holds at most
90 + 90^2 items, so every list gets small, and each near pair is in one list only
(a list by last letters leaves out pairs that agree on the first ones too).

Scan.  A list is sorted.  Each item goes through the items after it with a band of
three cells per row of the edit matrix; rows up to the longest common prefix (LCP)
with the item before are kept.  Once all cells of a row pass one edit, every item
that shares this prefix is skipped.  A task scans whole lists; numpy advances all
items of a block of lists by one row at a time.

Null or empty texts have no words; a null doc_id is hashed as an empty one; repeated
rows count each on its own; an empty table gives an empty result; very long texts
and words are whole; of near words with equal counts the least in code-point order
is the form.  Other columns are not read.
"""

from __future__ import annotations

import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed, table, written

LETTERS = r"[A-Za-zÀ-ÿ]+"
LEAST_LENGTH, LEAST_COUNT, RATIO = 5, 3, 2
DAMAGE = 97  # a run whose hash it divides loses a letter
CELLS = 1 << 19  # letters of a list that one task scans; above 3 * (90 + 90^2)
BLOCK = 1 << 21  # letters of the lists that are scanned together
KEYS = ["s", "p", "q", "skip", "key"]
NO_SKIP = 1 << 30


def runs(docs: DataFrame) -> DataFrame:
    """doc_id, run: every run of letters, only A-Z lower-cased."""
    text = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(F.col("doc_id"), F.explode(F.regexp_extract_all(text, F.lit(LETTERS), F.lit(0))).alias("run"))


def damaged(doc_id: Column, run: Column) -> Column:
    """The run, without one letter if DAMAGE divides its hash."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % DAMAGE == 0, F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))).otherwise(run)


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n of every word of LEAST_LENGTH letters and LEAST_COUNT uses."""
    long_enough = runs(docs).where(F.char_length("run") >= LEAST_LENGTH)
    words = long_enough.select(damaged(F.col("doc_id"), F.col("run")).alias("word"))
    return (words.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def halves(rows: DataFrame) -> DataFrame:
    """Each row in the list by the first and in that by the last half of what is left."""
    c = F.expr("div(s - p - q, 2)").cast("int")
    first = F.when(F.col("skip") > c, F.struct(
        F.col("s"), (F.col("p") + c).alias("p"), F.col("q"),
        F.when(F.col("skip") < NO_SKIP, F.col("skip") - c).otherwise(F.lit(NO_SKIP)).alias("skip")))
    last = F.struct(F.col("s"), F.col("p"), (F.col("q") + c).alias("q"), F.least("skip", c).alias("skip"))
    return _lists(rows.select("word", "n", F.explode(F.array_compact(F.array(first, last))).alias("k")))


def _lists(rows: DataFrame) -> DataFrame:
    """KEYS, mid (what the key leaves of the word, a byte a letter), word, n."""
    rows = rows.select("k.*", "word", "n")
    length = F.char_length("word")
    key = F.concat(F.substr("word", F.lit(1), F.col("p")), F.substr("word", length - F.col("q") + 1, F.col("q")))
    mid = F.encode(F.substr("word", F.col("p") + 1, length - F.col("p") - F.col("q")), "ISO-8859-1")
    return rows.select("s", "p", "q", "skip", key.alias("key"), mid.alias("mid"), "word", "n")


def lists(words: DataFrame, cells: int = CELLS) -> DataFrame:
    """The rows of all lists, none above ``cells`` letters while it can be split."""
    length = F.char_length("word")
    sizes = F.array(length, F.when(length > F.lit(LEAST_LENGTH), length - 1))
    rows = halves(words.select("word", "n", F.explode(F.array_compact(sizes)).alias("s")).select(
        "word", "n", "s", *[F.lit(0).alias(c) for c in "pq"], F.lit(NO_SKIP).alias("skip")))
    done = None
    while True:
        large = (rows.where("s - p - q > 1").groupBy(*KEYS).agg(F.sum(F.length("mid") + 1).alias("cells"))
                 .where(F.col("cells") > cells).select(*KEYS))
        large = written(large, "large_lists")
        whole = large.isEmpty()
        small = rows if whole else rows.join(large, KEYS, "left_anti").select(*rows.columns)
        done = small if done is None else done.union(small)
        if whole:
            return done
        rows = written(halves(rows.join(large, KEYS, "left_semi")), "split_lists")


# A band is three cells of 0, 1 or 2 (2: more than one edit), written as one number.
DEAD, ROW, TOP = 26, 1 * 9 + 0 * 3 + 1, 2 * 9 + 0 * 3 + 1


def next_rows() -> np.ndarray:
    """The next row's band for every band and every match of the item's letter
    with the query's three letters under the band."""
    out = np.empty((27, 8), np.uint8)
    for band in range(27):
        old = (band // 9, band // 3 % 3, band % 3, 2)
        for match in range(8):
            new, left = 0, 2
            for k in range(3):
                left = min(old[k] + 1 - (match >> k & 1), old[k + 1] + 1, left + 1, 2)
                new = new * 3 + left
            out[band, match] = new
    return out.reshape(-1)


def matrix(mid: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(a row of bytes per item, with a zero before and two after; lengths)."""
    mid = mid.cast(pa.large_binary())
    off = np.frombuffer(mid.buffers()[1], np.int64, len(mid) + 1, mid.offset * 8)
    length = np.diff(off)
    data = np.frombuffer(mid.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    m = np.zeros((len(mid), int(length.max(initial=0)) + 3), np.uint8)
    row = np.repeat(np.arange(len(mid)), length)
    m[row, np.arange(len(data)) - np.repeat(off[:-1] - off[0], length) + 1] = data
    return m, length


def scan(m: np.ndarray, length: np.ndarray, end: np.ndarray, step: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (a < b) of rows one edit apart; ``end`` is where each row's list ends."""
    n, width = m.shape
    depth = width - 2  # one more than the longest item
    same = m[1:, 1:width - 1] == m[:-1, 1:width - 1]
    lcp = np.zeros(n + 1, np.int64)
    lcp[1:n] = np.minimum(np.cumprod(same, 1, dtype=np.uint8).sum(1), length[1:])
    lcp[np.unique(end)] = 0
    # leave[i, d]: the first row after i that does not share i's first d letters.
    leave = np.empty((n, depth + 1), np.int32)
    place = np.arange(n + 1, dtype=np.int32)
    for d in range(depth + 1):
        at = np.where(lcp < max(d, 1), place, np.int32(n))  # lists are left at their end, where lcp is 0
        leave[:, d] = np.minimum.accumulate(at[::-1])[::-1][1:]
    band = np.full((n, depth + 1), ROW, np.uint8)
    band[:, 0] = TOP
    letters, bands, left = m.reshape(-1), band.reshape(-1), leave.reshape(-1)
    q = np.flatnonzero(place[:n] + 1 < end)
    j = q + 1
    t = lcp[j]
    a, b = [], []
    while len(q):
        c, own = letters[j * width + t + 1], q * width + t
        match = ((c == letters[own]) + 2 * (c == letters[own + 1]).view(np.uint8)
                 + 4 * (c == letters[own + 2]).view(np.uint8))
        at = q * (depth + 1) + t
        new = step[bands[at].astype(np.int64) * 8 + match]
        bands[at + 1] = new
        t = t + 1
        dead = new == DEAD
        whole = t == length[j]
        f = np.flatnonzero(whole & ~dead)
        if len(f):
            k = length[q[f]] - length[j[f]]
            cell = np.where(k == 0, new[f] // 3 % 3, np.where(k < 0, new[f] // 9, new[f] % 3))
            f = f[(np.abs(k) <= 1) & (cell == 1)]
            a.append(q[f])
            b.append(j[f])
        move = dead | whole
        j = np.where(dead, left[j * (depth + 1) + t], j + move)
        go = j < end[q]
        if not go.all():
            q, j, t, move = q[go], j[go], t[go], move[go]
        t = np.where(move, lcp[j], t)
    empty = [np.zeros(0, np.int64)]
    return np.concatenate(a or empty), np.concatenate(b or empty)


def near_words(rows: DataFrame, block: int = BLOCK) -> DataFrame:
    """word, near, near_n: every near word of every word, once."""
    step = next_rows()

    def links(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        group = t["group"].to_numpy()
        edge = np.flatnonzero(np.diff(group)) + 1
        bounds = np.concatenate([[0], edge, [len(group)]])
        end = np.repeat(bounds[1:], np.diff(bounds))
        m, length = matrix(t["mid"].chunk(0))
        a, b = scan(m, length, end, step)
        left = (t["s"].to_numpy() - t["p"].to_numpy() - t["q"].to_numpy())[a]
        keep = np.minimum(length[a], length[b]) == left  # others are in the lists of their own length
        skip = t["skip"].to_numpy()[a]
        for i in np.flatnonzero(keep & (skip <= left)):
            w = int(skip[i]) + 1
            keep[i] = not np.array_equal(m[a[i], 1:w], m[b[i], 1:w])
        a, b = a[keep], b[keep]
        one, two = np.concatenate([a, b]), np.concatenate([b, a])
        word = t["word"].chunk(0)
        return pa.RecordBatch.from_arrays([word.take(pa.array(one)), word.take(pa.array(two)),
                                           pa.array(t["n"].to_numpy()[two])], ["word", "near", "near_n"])

    def run(batches):
        held, cells, at, last = [], 0, 0, None
        for b in batches:
            if not b.num_rows:
                continue
            # Lists get running numbers; one may go on in the next batch.
            keys = [b.column(c) for c in KEYS]
            new = np.ones(b.num_rows, bool)
            change = np.zeros(b.num_rows - 1, bool)
            for k in keys:
                change |= pa.compute.not_equal(k[1:], k[:-1]).to_numpy(zero_copy_only=False)
            new[1:] = change
            first = [k[0].as_py() for k in keys]
            new[0] = first != last
            last = [k[len(k) - 1].as_py() for k in keys]
            group = at + np.cumsum(new)
            at = int(group[-1])
            part = pa.Table.from_batches([b.select(["s", "p", "q", "skip", "mid", "word", "n"])]).append_column(
                "group", pa.array(group))
            size = pa.compute.binary_length(b.column("mid")).to_numpy() + 3
            cells += int(size.sum())
            held.append(part)
            if cells > block:
                t = pa.concat_tables(held)
                number = t["group"].to_numpy()
                cut = int(np.searchsorted(number, at))  # the last list may go on
                if cut:
                    yield from blocks(t.slice(0, cut))
                    held = [t.slice(cut)]
                    cells = int((pa.compute.binary_length(held[0]["mid"]).to_numpy() + 3).sum())
        if held:
            yield from blocks(pa.concat_tables(held))

    def blocks(t: pa.Table):
        """Whole lists at a time, about ``block`` letters with the padding."""
        number = t["group"].to_numpy()
        size = pa.compute.binary_length(t["mid"]).to_numpy() + 3
        starts = np.flatnonzero(np.concatenate([[True], np.diff(number) > 0]))
        tall, wide = np.diff(np.append(starts, len(number))), np.maximum.reduceat(size, starts)
        a = 0
        while a < len(starts):
            b, rows_, width = a, 0, 0
            while b < len(starts) and (b == a or (rows_ + tall[b]) * max(width, wide[b]) <= block):
                rows_, width = rows_ + tall[b], max(width, wide[b])
                b += 1
            yield links(t.slice(starts[a], rows_))
            a = b

    sorted_ = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "mid")
    return sorted_.mapInArrow(freed(run), "word string, near string, near_n long")


def roots(forms: DataFrame) -> DataFrame:
    """word, root of every row (word, form) that has a form: pointers are doubled
    until none moves.  Counts at least double along a chain, so it takes at most
    six rounds for any 64-bit counts."""
    now = written(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = now.select(F.col("word").alias("at"), F.col("root").alias("onward"))
        moved = now.join(on, now["root"] == on["at"], "left")
        moved = written(moved.select("word", F.coalesce("onward", "root").alias("root"),
                                     F.col("onward").isNotNull().alias("moved")), "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(words: DataFrame, cells: int = CELLS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row (word, n)."""
    words = written(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("form")))
    found = near_words(lists(words, cells)).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = written(words.join(found, "word", "left").withColumn(
        "is_form", -F.col("best.m") >= RATIO * F.col("n")).select(
        "word", F.when(F.col("is_form"), F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(F.col("is_form"), -F.col("best.m")).alias("form_n")), "near_words")
    ends = roots(found.where("form IS NOT NULL"))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")))
