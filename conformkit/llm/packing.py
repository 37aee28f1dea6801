"""Packing documents into token sequences by vector best-fit.

A document is its token ids followed by id 0; only one longer than a sequence is
cut, into full pieces and a last shorter one.  Pieces are dealt by hash to groups
of about GROUP pieces; a group is packed in one task, longest pieces first.  An
open sequence has a residual vector (tokens, documents, attention cost = the sum
of squared lengths), each as a share of its capacity.  A piece goes to the
sequence, of those that hold it under every capacity, with the least weighted norm
of the residual left after it (or the greatest weighted dot product of piece and
residual); ties go to the sequence opened first.  With no such sequence it opens
one.  Every open sequence is scored; there is no cap on them.

The default capacities are 2048 tokens, 2048 documents and 2048^2 attention cost,
so only tokens bind; lower the others to limit them.  A group loses less than one
sequence to its border, 1 in some thousands.

A null text is an empty one (a piece with id 0 alone).  Repeated rows are packed
each on its own, and dealt by their number in the task that read them too, so many
copies of one row spread over groups.  A very long text is a list of pieces.  An empty
table gives an empty result.  Other columns are not read.

Tokens: a text of plain characters (ASCII, Latin-1, Latin Extended-A) is split
into words by the tokenizer's own pattern and each distinct word is encoded once
per task; any other text is encoded whole.  ``tests/llm`` compares both.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import freed, table, written

TOKENS = 2048
GROUP = 8192  # pieces packed together; a task's size, not a limit on anything
CACHE = 400_000  # words remembered by a task (about 60 MB); beyond it they are encoded again


class Words(dict):
    """Numbers words in the order in which they are first looked up."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


class WordEncoder:
    """The ids of texts, word by word where that is exact."""

    def __init__(self, path: str):
        import os
        import re

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        # For words that are lower case and split already.
        self.bare = Tokenizer(self.tok.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # Plain characters: printable ones up to U+017E and usual white space.
        # NFC leaves any text of them as it is, and each has a one-character
        # lower case among them (U+0130 and U+0149 do not).
        self.plain = re.compile("[\t\n\r -~\xa1-\u012f\u0131-\u0148\u014a-\u017e]*").fullmatch
        # The split pattern of the vocabulary file (a fixed value), its classes
        # written out for plain lower-case characters: letters, numbers, the rest.
        letters, numbers = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\u017e", "0-9\xb2\xb3\xb9\xbc-\xbe"
        self.words = re.compile(
            rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+").findall
        self.special = tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max(vocab.values()) + 1, bool)  # tokens that end a word
        self.last[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.reset()

    def reset(self) -> None:
        self.number = Words()
        self.ids, self.start = np.zeros(1 << 20, np.uint32), np.zeros(1 << 19, np.int64)

    def learn(self) -> None:
        """The ids of the words met since the last call; a text of words with
        spaces between is encoded at once and cut where a token ends a word."""
        new, n = self.number.new, len(self.number) - len(self.number.new)
        self.number.new = []
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            flat = np.array(self.bare.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[flat]) + 1
            if len(ends) != len(part):
                raise ValueError("a word of the split pattern is not one word of the vocabulary")
            used = self.start[n]
            while len(self.start) <= n + len(part):
                self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            while len(self.ids) < used + len(flat):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.start[n + 1:n + 1 + len(part)] = used + ends
            self.ids[used:used + len(flat)] = flat
            n += len(part)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(texts)
        words: list[str] = []
        upto, which = [], []
        for i, text in enumerate(texts):
            if self.plain(text) and not any(s in text for s in self.special):
                words += self.words(text.lower())
                upto.append(len(words))
                which.append(i)
            else:
                out[i] = np.array(self.tok.encode(text, add_special_tokens=False).ids, np.uint32)
        if len(self.number) > CACHE:
            self.reset()
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        self.learn()
        first = self.start[at]
        size = self.start[at + 1] - first
        ends = np.cumsum(size)
        flat = self.ids[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)]
        cuts = np.concatenate([[0], ends])[[0, *upto]]
        for k, i in enumerate(which):
            out[i] = flat[cuts[k]:cuts[k + 1]]
        return out


def pieces(docs: DataFrame, tokenizer: str, tokens: int = TOKENS) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece, row (the number of its
    document in the task)."""
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, row long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, row = WordEncoder(tokenizer), 0
        for b in batches:
            for at in range(0, b.num_rows, 256):  # a few texts' words at a time
                part = b.slice(at, 256)
                out = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                for doc, ids in zip(part.column(0).to_pylist(), encoder.encode_batch(texts)):
                    ids = np.append(ids, np.uint32(0)).astype("<u4")
                    for k, s in enumerate(range(0, len(ids), tokens)):
                        cut = ids[s:s + tokens]
                        out.append((doc, k, s, len(cut), zlib.crc32(cut.tobytes()), row))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.int64()] * 4))],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "row"])

    return docs.select("doc_id", "text").mapInArrow(freed(run), schema)


def best_fit(length: np.ndarray, capacity=(TOKENS, TOKENS, TOKENS ** 2), weights=(1.0, 0.05, 0.05),
             measure: str = "norm") -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of every piece, packed in the given order."""
    n = len(length)
    cap, w = np.asarray(capacity, float), np.asarray(weights, float)
    need = np.stack([length, np.ones(n), length.astype(float) ** 2], 1) / cap
    sequence, offset = np.empty(n, np.int64), np.empty(n, np.int64)
    room = np.empty((3, 1024))  # residual share by capacity, of the open sequences
    name, used = np.empty(1024, np.int64), np.zeros(1024, np.int64)
    open_, made = 0, 0
    slack = 1e-12
    least = need[:, 0].min() if n else 0.0
    for i in range(n):
        x = need[i]
        fits = (room[0, :open_] >= x[0] - slack)
        fits &= room[1, :open_] >= x[1] - slack
        fits &= room[2, :open_] >= x[2] - slack
        at = np.flatnonzero(fits)
        if len(at):
            left = room[:, at]
            if measure == "norm":
                score = w @ (left - x[:, None]) ** 2
            else:
                score = -((w * x) @ left)
            j = int(at[np.argmin(score)])
        else:
            if open_ == room.shape[1]:
                room = np.concatenate([room, np.empty_like(room)], 1)
                name, used = np.concatenate([name, name]), np.concatenate([used, used])
            j, open_ = open_, open_ + 1
            room[:, j], name[j], used[j] = 1.0, made, 0
            made += 1
        sequence[i], offset[i] = name[j], used[j]
        used[j] += length[i]
        room[:, j] -= x
        if room[0, j] < least - slack or room[1, j] < 1 / cap[1] - slack:
            # Full: nothing in the group fits any more.  Order is kept for ties.
            room[:, j:open_ - 1] = room[:, j + 1:open_].copy()
            name[j:open_ - 1] = name[j + 1:open_].copy()
            used[j:open_ - 1] = used[j + 1:open_].copy()
            open_ -= 1
    return sequence, offset


def pack(rows: DataFrame, capacity=(TOKENS, TOKENS, TOKENS ** 2), weights=(1.0, 0.05, 0.05),
         measure: str = "norm", group: int = GROUP) -> DataFrame:
    """Add sequence_id and offset to the rows of ``pieces``."""
    rows = written(rows, "pieces")
    groups = max(1, -(-rows.count() // group))
    keys = ["doc_id", "piece", "ids_crc32"]
    dealt = rows.withColumn("g", F.pmod(F.xxhash64(*keys, "row"), F.lit(groups)))

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("length", "descending"), *[(k, "ascending") for k in keys]])
        sequence, offset = best_fit(t["length"].to_numpy(), capacity, weights, measure)
        base = t["g"][0].as_py() << 32
        t = t.append_column("sequence_id", pa.array(sequence + base)).append_column("offset", pa.array(offset))
        return t.drop_columns(["g", "row"])

    schema = rows.drop("row").schema.add("sequence_id", "long").add("offset", "long")
    return dealt.groupBy("g").applyInArrow(run, schema)


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op10_vector_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(pieces(table(spark, sf_dir, "documents"), tokenizer_path()))
