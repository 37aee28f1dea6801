"""Language identification by rank-order n-gram profiles.

A profile is the list of the most frequent character n-grams (1 to 3 characters,
inside words, word borders counting as one character) in order of frequency, ties
by code point.  A document's language is that of the profile with the least
out-of-place distance: the sum over the document's own most frequent n-grams of
the difference of both ranks, PROFILE where the profile lacks the n-gram.  Equal
distances go to the language first in code-point order.

Training counts the n-grams of every whole text with a language, per language,
in the tasks that read them; only sums per (language, n-gram) are shuffled.  The
profiles (PROFILE n-grams a language, 12 bytes each, so 29 MB for all of the world's
languages) are closed over by the scoring tasks; they grow with the languages and not
with the documents.

score is 1 minus the distance as a share of the largest possible one.  A text
that is null or has no letter, or any text if nothing was learned, is ``und`` with
score 0.  Repeated rows are judged alike; very long texts are counted whole, in parts
cut between words.  An empty table gives an empty result.  Other columns are never
read; ``accepted`` passes them through.

``calibrate`` gives the least score a text must have, per language and number of
distinct n-grams (by powers of two).  Samples are all labelled texts and of each one
head, whose number of words is a power of two picked by the text's hash; each distinct
one counts once, so neither copies nor a share of mislabelled texts under a quarter
moves it far.  From the shortest size up, with the median and the lower quartile of
the n samples' scores, the least score is the mean of

    median - FENCE * max(median - quartile, LEAST_SPREAD)

with weight n and the least score of the next shorter texts (at first 0) with weight
PRIOR: one rule at every size, in which short texts, whose scores vary, set a low bar
and sizes with few samples lean on shorter ones.  A text under its bar stays if one of its halves,
of HALF n-grams at least, is not: texts in two learned languages are like neither.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import freed, table, text_buffers

PROFILE = 300  # n-grams of a profile, and of a document
SLICE = 1 << 21  # code points after which a text is cut for its head
# Bytes of text, and rows, worked on at once; only memory bounds.
BLOCK, ROWS = 1 << 18, 256
UND = "und"
SIZES = 40  # powers of two of distinct n-grams
HALF = 64  # distinct n-grams by which half a text is known
FENCE, LEAST_SPREAD, PRIOR = 8, 0.02, 20
STEPS = 1000  # scores are counted in steps of 1 / STEPS


def letter_table() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)


def sequences(col, letters: np.ndarray, cut: int = SLICE) -> Iterator[tuple[int, np.ndarray]]:
    """For every document that has a letter: (row, its code points with each run
    of other characters as one 0, and a 0 at both ends).  Texts longer than 2 cut come
    in several parts that are cut at such a 0."""
    upto = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(col), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    n, row = len(col), 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(upto, upto[row] + BLOCK, "right")) - 1)
        raw, off = text_buffers(pc.utf8_lower(col.slice(row, end - row)))
        chars = np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
        first = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])[off]
        folded = np.where(letters[chars], chars, 0).astype(np.uint64)
        for r in range(row, end):
            doc = folded[first[r - row]:first[r - row + 1]]
            if not doc.any():
                continue
            doc = np.concatenate([[np.uint64(0)], doc, [np.uint64(0)]])
            doc = doc[np.concatenate([[True], (doc[1:] != 0) | (doc[:-1] != 0)])]
            a, gaps = 0, np.flatnonzero(doc == 0) if len(doc) > 2 * cut else []
            while a < len(doc) - 1:
                b = len(doc) - 1
                if b - a > 2 * cut:
                    b = int(gaps[np.searchsorted(gaps, a + cut)])
                yield r, doc[a:b + 1]
                a = b
        row = end


def ngrams(seq: np.ndarray) -> np.ndarray:
    """The codes of all 1- to 3-grams of a sequence."""
    one = seq[seq != 0]
    two = np.uint64(1 << 63) | (seq[:-1] << np.uint64(21)) | seq[1:]
    mid = seq[1:-1] != 0
    three = ((seq[:-2] << np.uint64(42)) | (seq[1:-1] << np.uint64(21)) | seq[2:])[mid]
    return np.concatenate([one, two, three])


def merged(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    code, inv = np.unique(np.concatenate(codes), return_inverse=True)
    return code, np.bincount(inv, np.concatenate(counts)).astype(np.int64)


def document_counts(col, letters) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, n-gram codes ascending, counts) of each document with a letter."""
    row, codes, counts = -1, [], []
    for r, seq in sequences(col, letters, BLOCK):
        if r != row and codes:
            yield (row, codes[0], counts[0]) if len(codes) == 1 else (row, *merged(codes, counts))
            codes, counts = [], []
        row = r
        code, count = np.unique(ngrams(seq), return_counts=True)
        codes.append(code)
        counts.append(count)
        if len(codes) > 16:
            code, count = merged(codes, counts)
            codes, counts = [code], [count]
    if codes:
        yield (row, codes[0], counts[0]) if len(codes) == 1 else (row, *merged(codes, counts))


def top(code: np.ndarray, count: np.ndarray, k: int) -> np.ndarray:
    """The k most frequent codes, ties to the smaller code."""
    if len(code) > k:
        least = np.partition(count, len(count) - k)[len(count) - k]
        keep = count >= least
        code, count = code[keep], count[keep]
    return code[np.argsort(-count, kind="stable")][:k]


def counted_per_language(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    letters = letter_table()
    for batch in batches:
        lang, text = batch.column("lang"), batch.column("text")
        for name in pc.unique(lang).to_pylist():
            rows = np.flatnonzero(pc.equal(lang, name).to_numpy(zero_copy_only=False))
            cols = (text.take(pa.array(rows[at:at + ROWS])) for at in range(0, len(rows), ROWS))
            code, count, parts, size = [], [], [], 0

            def settle():
                c, n = np.unique(np.concatenate(parts), return_counts=True)
                code.append(c)
                count.append(n)
                parts.clear()

            for _, seq in (s for col in cols for s in sequences(col, letters, BLOCK)):
                parts.append(ngrams(seq))
                size += len(seq)
                if size > BLOCK:
                    settle()
                    size = 0
                    if len(code) > 16:
                        a, b = merged(code, count)
                        code, count = [a], [b]
            if parts:
                settle()
            if code:
                a, b = merged(code, count)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(a), pa.string()), pa.array(a.view(np.int64)), pa.array(b)],
                    ["lang", "gram", "n"])


def train(docs: DataFrame, k: int = PROFILE) -> dict[str, np.ndarray]:
    """{language: n-gram codes in rank order} from the text and lang of docs."""
    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", "lang")
    counts = (rows.mapInArrow(freed(counted_per_language), "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # Codes are unsigned: those with the top bit (2-grams) come after the others.
    order = W.partitionBy("lang").orderBy(F.desc("n"), F.col("gram") < 0, "gram")
    best = (counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("lang", "rank", "gram").collect())
    out: dict[str, list] = {}
    for r in sorted(best, key=lambda r: (r["lang"], r["rank"])):
        out.setdefault(r["lang"], []).append(r["gram"])
    return {lang: np.array(g, np.int64).view(np.uint64) for lang, g in out.items()}


def size_class(grams: int) -> int:
    return min(grams.bit_length() - 1, SIZES - 1)


class Scorer:
    """Out-of-place distances of documents to all profiles at once.  For each n-gram
    the languages that have it and their ranks lie together."""

    def __init__(self, profiles: dict[str, np.ndarray], k: int = PROFILE):
        self.k, self.langs = k, sorted(profiles)
        every = [profiles[name] for name in self.langs]
        grams = np.concatenate(every) if every else np.zeros(0, np.uint64)
        lang = np.repeat(np.arange(len(every), dtype=np.int32), [len(e) for e in every])
        rank = np.concatenate([np.arange(len(e), dtype=np.int32) for e in every]) if every else np.zeros(0, np.int32)
        order = np.argsort(grams, kind="stable")
        self.lang, self.rank = lang[order], rank[order]
        self.codes, self.first = np.unique(grams[order], return_index=True)
        self.first = np.append(self.first, len(grams))

    def distances(self, grams: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.codes, grams)
        at[at == len(self.codes)] = 0
        mine = np.flatnonzero(self.codes[at] == grams)
        first = self.first[at[mine]]
        many = self.first[at[mine] + 1] - first
        upto = np.cumsum(many)
        place = np.arange(upto[-1] if len(upto) else 0) + np.repeat(first - (upto - many), many)
        nearer = self.k - np.abs(self.rank[place] - np.repeat(mine, many))
        return self.k * len(grams) - np.bincount(self.lang[place], nearer, len(self.langs)).astype(np.int64)

    def best(self, code: np.ndarray, count: np.ndarray) -> tuple[int, float]:
        """(language number, score) of a text's n-grams."""
        grams = top(code, count, self.k)
        d = self.distances(grams)
        best = int(np.argmin(d))
        return best, 1 - d[best] / (self.k * len(grams))

    def judge(self, col, letters) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(language number or -1, score, size class) of every row of a text column."""
        which, score, size = np.full(len(col), -1), np.zeros(len(col)), np.zeros(len(col), int)
        if self.langs:
            for row, code, count in document_counts(col, letters):
                which[row], score[row] = self.best(code, count)
                size[row] = size_class(len(code))
        return which, score, size


def predict(docs: DataFrame, profiles: dict[str, np.ndarray]) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    scorer = Scorer(profiles)

    def run(batches):
        letters = letter_table()
        names = pa.array([*scorer.langs, UND], pa.string())
        for b in batches:
            which, score, _ = scorer.judge(b.column("text"), letters)
            lang = names.take(pa.array(np.where(which < 0, len(scorer.langs), which)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), lang, pa.array(score)],
                                             ["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, lang_pred string, score double")


def head(seq: np.ndarray, pick: int) -> np.ndarray | None:
    """The first 2^i words of a sequence, i picked among those that leave some out."""
    ends = np.flatnonzero(seq == 0)[1:]
    if len(ends) < 2:
        return None
    n = 1 << pick % (len(ends) - 1).bit_length()
    return seq[:ends[n - 1] + 1]


def samples(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """lang (its number), size, step, key of the samples of labelled texts: each text
    and its head."""
    def run(batches):
        letters = letter_table()
        for b in batches:
            col, key = b.column("text"), b.column("key").to_numpy()
            which, score, size = scorer.judge(col, letters)
            out, done = [], -1
            for row, seq in sequences(col, letters) if scorer.langs else ():
                if row == done:
                    continue
                done = row
                out.append((int(which[row]), int(size[row]), int(score[row] * STEPS), int(key[row])))
                part = head(seq, int(key[row]) & 0xFFFF)
                if part is not None:
                    code, count = np.unique(ngrams(part), return_counts=True)
                    lang, x = scorer.best(code, count)
                    name = np.frombuffer(hashlib.blake2b(part.tobytes(), digest_size=8).digest(), np.int64)[0]
                    out.append((lang, size_class(len(code)), int(x * STEPS), int(name)))
            kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([s[i] for s in out], kind) for i, kind in enumerate(kinds)],
                                             ["lang", "size", "step", "key"])

    rows = docs.where("text IS NOT NULL AND lang IS NOT NULL").select("text", F.xxhash64("text").alias("key"))
    return rows.mapInArrow(freed(run), "lang int, size int, step int, key long").distinct()


def calibrate(docs: DataFrame, profiles: dict[str, np.ndarray]) -> np.ndarray:
    """The least score per (language number, size class), from the text and lang of
    docs.  Only numbers per language, size class and score step are collected."""
    scorer = Scorer(profiles)
    quartiles = F.percentile("step", F.array(F.lit(0.25), F.lit(0.5)), F.col("n"))
    found = (samples(docs, scorer).groupBy("lang", "size", "step").agg(F.count("*").alias("n"))
             .groupBy("lang", "size").agg(quartiles.alias("q"), F.sum("n").alias("n")).collect())
    own, n = np.zeros((2, max(1, len(scorer.langs)), SIZES))
    for r in found:
        low, middle = np.array(r["q"]) / STEPS
        own[r["lang"], r["size"]] = middle - FENCE * max(middle - low, LEAST_SPREAD)
        n[r["lang"], r["size"]] = r["n"]
    least, shorter = np.empty_like(own), np.zeros(len(own))
    for size in range(SIZES):
        least[:, size] = shorter = (n[:, size] * own[:, size] + PRIOR * shorter) / (n[:, size] + PRIOR)
    return least


def accepted(docs: DataFrame, profiles: dict[str, np.ndarray], least: np.ndarray | None = None) -> DataFrame:
    """The rows of docs, all columns, that have a language with a score above 0
    and, themselves or one half, not under that of ``calibrate`` for their language
    and size."""
    scorer = Scorer(profiles)
    least = np.zeros((max(1, len(scorer.langs)), SIZES)) if least is None else least
    at = docs.columns.index("text")

    def judged(col, letters):
        which, score, size = scorer.judge(col, letters)
        some = (which >= 0) & (score > 0)
        return some, some & (score >= least[which, size]), size

    def run(batches):
        letters = letter_table()
        for b in (batch.slice(i, ROWS) for batch in batches for i in range(0, batch.num_rows, ROWS)):
            some, keep, _ = judged(b.column(at), letters)
            low = np.flatnonzero(some & ~keep)
            texts = b.column(at).take(pa.array(low)).to_pylist()
            for half in ([t[:len(t) // 2] for t in texts], [t[len(t) // 2:] for t in texts]):
                _, good, size = judged(pa.array(half, pa.string()), letters)
                keep[low] |= good & (size >= size_class(HALF))
            yield b.filter(pa.array(keep))

    return docs.mapInArrow(freed(run), docs.schema)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % folds == fold


def op1_rank_order_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = train(docs.where(~held_out(F.col("doc_id"), 4, 2)))
    return predict(docs, profiles).select(
        "doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
