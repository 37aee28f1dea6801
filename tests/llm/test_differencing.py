"""Packing by multiway differencing: against the token ids, a plain differencing, and odd inputs."""

from __future__ import annotations

import itertools
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conformkit.llm import differencing as D
from conformkit.llm.common import table

SF = "/root/testdata/sf0.001"


def token_ids(texts) -> list[np.ndarray]:
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(D.tokenizer_path())
    return [np.array([*e.ids, 1], "<u4") for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def check_packed(rows, docs, tokens=2048) -> None:
    """Every id in one piece, gapless sequences, no padding; docs are (doc_id, text)."""
    want = defaultdict(list)
    for (doc, _), ids in zip(docs, token_ids([t for _, t in docs])):
        want[doc].append(ids)
    got, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length > 0
        got[r.doc_id].append((r.doc_tokens, r.start, r.length, r.ids_crc32))
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(got) == set(want)
    for doc, lists in want.items():
        pieces = sorted(got[doc])
        assert sum(p[2] for p in pieces) == sum(map(len, lists))
        if len(lists) == 1:
            at = 0
            for size, start, length, crc in pieces:
                assert (size, start) == (len(lists[0]), at)
                assert crc == zlib.crc32(lists[0][at:at + length].tobytes())
                at += length
    for s in sequences.values():
        at = 0
        for offset, length in sorted(s):
            assert offset == at
            at += length
        assert at == tokens or at < tokens and at & (at - 1) == 0


def test_whole_table(spark):
    rows = D.op12_multiway_differencing(spark, SF).collect()
    check_packed(rows, [(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()])
    assert len({r.sequence_id for r in rows}) <= sum(r.length for r in rows) // 2048 + 11


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 9000), (5, "word " * 2047),
            *[(100 + i, "some words here " * (i * 7 % 300)) for i in range(200)]]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("length", "start", "row", "g", "ids")})
    check_packed(D.pack(D.items(df, D.tokenizer_path()), group=50).collect(), docs)
    assert D.pack(D.items(df.limit(0), D.tokenizer_path())).count() == 0


def test_copies_of_one_row_spread_over_groups(spark):
    df = spark.createDataFrame([(7, "a few words")], "doc_id long, text string").withColumn(
        "text", F.explode(F.array_repeat("text", 500)))
    rows = D.pack(D.items(df, D.tokenizer_path()), group=50).collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 5


def plain_differencing(length, k):
    """Sums by the textbook rule, on whole tuples."""
    parts = [(sorted([x] + [0] * (k - 1), reverse=True), i) for i, x in enumerate(length)]
    order = len(parts)
    while len(parts) > 1:
        parts.sort(key=lambda p: (p[0][-1] - p[0][0], p[1]))
        one, two = parts.pop(0), parts.pop(0)
        parts.append((sorted((a + b for a, b in zip(one[0], reversed(two[0]))), reverse=True), order))
        order += 1
    return parts[0][0]


@pytest.mark.parametrize("n,k,seed", list(itertools.product((1, 5, 40, 150), (1, 2, 3, 7, 50), range(2))))
def test_differencing_matches_the_textbook_rule(n, k, seed):
    length = np.random.default_rng(seed).integers(1, 100, n)
    window = D.differencing(length, k)
    assert sorted(np.bincount(window, length, minlength=k).tolist(), reverse=True) == plain_differencing(length.tolist(), k)


def test_windows_are_near_equal_and_their_count_rises():
    length = np.sort(np.random.default_rng(1).integers(1, 200, 2000))[::-1]
    sums = np.bincount(D.differencing(length, 100), length)
    assert sums.max() - sums.min() <= 2
    # 3 items of 60 need three windows of 100, not two.
    window, sums = D.balanced(np.array([60, 60, 60]), 100)
    assert sums.tolist() == [60, 60, 60]


@pytest.mark.parametrize("seed", range(20))
def test_filling_cuts_at_the_gaps(seed):
    rng = np.random.default_rng(seed)
    length = np.sort(rng.integers(1, 64, rng.integers(1, 300)))[::-1]
    rows = D.filled(length, 64)
    sums = np.bincount(rows[:, 3], rows[:, 2]).astype(int)
    assert all(x == 64 or x & (x - 1) == 0 for x in sums)
    for i, n in enumerate(length):
        own = rows[rows[:, 0] == i]
        own = own[np.argsort(own[:, 1])]
        assert own[:, 1].tolist() == [0, *np.cumsum(own[:, 2])[:-1]] and own[:, 2].sum() == n
