"""Quality classifier: random-indexing word vectors and a two-layer network.

Word vectors.  A token is a run of letters, of digits or of other visible
characters.  It is hashed to one of WORDS rows.  Every row has a fixed sparse
ternary index vector of DIM numbers; a row's context vector is the sum of the
index vectors of the tokens up to WINDOW before and after each of its
occurrences, over all documents and whole texts.  Unit-length context vectors are
the word vectors.

A document's features are the mean of its tokens' vectors.  A two-layer network
(tanh, sigmoid) is fitted with numpy to the features of labelled rows, a fifth of
which is held back to fit one temperature that calibrates its probabilities.

Bounds: the word table is WORDS x DIM numbers for any corpus.  The network is
fitted to at most MAX_TRAIN labelled rows, the first in a hash order; everything
else covers all rows.

A null or empty text has zero features and gets the network's score for them.
Labels that contradict each other for one doc_id, and null labels, are not used.
With one class, or no label, every score is the share of label 1 (0.5 for none).
Repeated rows score alike; an empty table gives an empty result; other columns
are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Powers, freed, runs, span_hashes, summed, table, text_buffers, white_class
from .langid import held_out

WORDS, DIM, NONZERO, WINDOW = 1 << 14, 32, 4, 2
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, SEED = 24, 60, 11
SLICE = 1 << 20  # bytes of text worked on at once; only a memory bound


def token_class() -> np.ndarray:
    """White space 0; letters and all bytes above ASCII 1; digits 2; the rest 3."""
    t = np.where(white_class() == 0, 0, 3).astype(np.uint8)
    for c in range(256):
        if c >= 128 or chr(c).isalpha():
            t[c] = 1
        elif chr(c).isdigit():
            t[c] = 2
    return t


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """(positions, signs) of the non-zero numbers of every row's index vector."""
    rng = np.random.default_rng(SEED)
    positions = np.argsort(rng.random((WORDS, DIM)), 1)[:, :NONZERO]
    return positions, rng.choice([-1.0, 1.0], (WORDS, NONZERO))


def tokens(col, classes: np.ndarray, powers: Powers):
    """Slices of (first row, number of rows, row of the word table and document
    of every token).  A long text comes in several slices of one row."""
    data, off = text_buffers(col)
    n, row = len(off) - 1, 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(off, off[row] + SLICE, "right")) - 1)
        a = int(off[row])
        while True:  # one text longer than a slice is cut between tokens
            b = int(off[end])
            if end == row + 1 and b - a > 2 * SLICE:
                gaps = np.flatnonzero(classes[data[a + SLICE:b]] == 0)
                b = a + SLICE + int(gaps[0]) if len(gaps) else b
            edges = np.clip(off[row:end + 1], a, b) - a
            cls = classes[data[a:b]]
            s, e = runs(cls, edges)
            word = (span_hashes(data[a:b], s, e, powers) >> np.uint64(50)).astype(np.int64)
            yield row, end - row, word, np.searchsorted(edges, s, "right") - 1
            a = b
            if a >= off[end]:
                break
        row = end


def word_vectors(docs: DataFrame) -> np.ndarray:
    """WORDS x DIM unit vectors from all texts of docs."""
    def count(batch: pa.RecordBatch, total: np.ndarray) -> None:
        classes, powers = token_class(), Powers()
        at, sign = index_vectors()
        for _, _, word, doc in tokens(batch.column(0), classes, powers):
            for step in range(1, WINDOW + 1):
                same = doc[step:] == doc[:-step]
                one, two = word[:-step][same], word[step:][same]
                for me, other in ((one, two), (two, one)):
                    for k in range(NONZERO):
                        total += np.bincount(me * DIM + at[other, k], sign[other, k],
                                             WORDS * DIM).astype(np.int64).reshape(WORDS, DIM)

    sums = summed(docs.select("text"), count, WORDS, DIM).astype(np.float32)
    norm = np.linalg.norm(sums, axis=1, keepdims=True)
    return np.divide(sums, norm, out=np.zeros_like(sums), where=norm > 0)


def pooled(col, vectors: np.ndarray, classes: np.ndarray, powers: Powers) -> np.ndarray:
    """The mean word vector of every row of a text column."""
    total, n = np.zeros((len(col), DIM)), np.zeros(len(col))
    for first, rows, word, doc in tokens(col, classes, powers):
        if len(word):
            starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
            total[first + doc[starts]] += np.add.reduceat(vectors[word], starts, 0)
            n[first:first + rows] += np.bincount(doc, minlength=rows)
    return total / np.maximum(n, 1)[:, None]


class Network:
    """features -> tanh -> sigmoid, with a temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.base = float(y.mean()) if len(y) else 0.5
        self.fitted = len(y) >= 10 and 0 < self.base < 1
        if not self.fitted:
            return
        held = np.arange(len(y)) % 5 == 0
        self.mean, self.sd = x.mean(0), x.std(0) + 1e-6
        z, t = self._scaled(x[~held]), y[~held]
        self.p = [rng.normal(0, 1 / np.sqrt(DIM), (DIM, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in self.p], [np.zeros_like(a) for a in self.p], 0
        for _ in range(EPOCHS):
            for rows in np.array_split(rng.permutation(len(t)), max(1, len(t) // 256)):
                step += 1
                grads = self._gradient(z[rows], t[rows])
                for i, g in enumerate(grads):  # Adam
                    m[i] = 0.9 * m[i] + 0.1 * g
                    v[i] = 0.999 * v[i] + 0.001 * g * g
                    self.p[i] = self.p[i] - 0.005 * (m[i] / (1 - 0.9 ** step)) / (
                        np.sqrt(v[i] / (1 - 0.999 ** step)) + 1e-8)
        logit, t = self._logit(self._scaled(x[held])), y[held]
        grid = np.geomspace(0.25, 8, 61)
        loss = [np.logaddexp(0, np.where(t == 1, -logit, logit) / c).mean() for c in grid]
        self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.sd

    def _logit(self, z: np.ndarray) -> np.ndarray:
        a, b, c, d = self.p
        return np.tanh(z @ a + b) @ c + d[0]

    def _gradient(self, z: np.ndarray, t: np.ndarray) -> list[np.ndarray]:
        a, b, c, d = self.p
        h = np.tanh(z @ a + b)
        err = (1 / (1 + np.exp(-(h @ c + d[0]))) - t) / len(t)
        back = err[:, None] * c * (1 - h * h)
        return [z.T @ back + 1e-4 * a, back.sum(0), h.T @ err + 1e-4 * c, np.array([err.sum()])]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.base)
        return 1 / (1 + np.exp(-self._logit(self._scaled(x)) / self.temperature))


def fit(docs: DataFrame, labels: DataFrame, vectors: np.ndarray) -> Network:
    """Fit to the documents that labels (doc_id, quality) name."""
    sample = (labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.min("quality").alias("y"), F.max("quality").alias("most")).where("y = most")
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_TRAIN).select("doc_id", "y"))

    def run(batches):
        classes, powers = token_class(), Powers()
        for b in batches:
            x = pooled(b.column("text"), vectors, classes, powers)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), pa.array(list(x), pa.list_(pa.float64()))],
                ["doc_id", "y", "x"])

    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # MAX_TRAIN rows at most
    found = (rows.select("doc_id", F.col("y").cast("int").alias("y"), "text")
             .mapInArrow(freed(run), "doc_id long, y int, x array<double>")
             .groupBy("doc_id").agg(F.min(F.struct("x", "y")).alias("r")).orderBy("doc_id").collect())
    x = np.array([r["r"]["x"] for r in found]).reshape(-1, DIM)
    return Network(x, np.array([r["r"]["y"] for r in found], float))


def scored(docs: DataFrame, vectors: np.ndarray, network: Network) -> DataFrame:
    """doc_id, score of every row."""
    def run(batches):
        classes, powers = token_class(), Powers()
        for b in batches:
            score = network.score(pooled(b.column("text"), vectors, classes, powers))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(freed(run), "doc_id long, score double")


def op7_random_indexing_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    vectors = word_vectors(docs)
    network = fit(docs, labels.where(~held_out(F.col("doc_id"), 3, 1)), vectors)
    return scored(docs, vectors, network).select(
        "doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
