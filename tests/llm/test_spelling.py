"""Spelling variants against a plain search, and odd inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from conformkit.llm import spelling
from conformkit.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_words(rows) -> dict[str, int]:
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if n >= 3 and len(w) >= 5}


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def plain_variants(words: dict[str, int]) -> set[tuple]:
    of_length = defaultdict(list)
    for w in words:
        of_length[len(w)].append(w)
    near = {w: [x for k in (-1, 0, 1) for x in of_length[len(w) + k] if one_edit(w, x)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return out


@pytest.mark.parametrize("cells", [spelling.CELLS, 60])
def test_whole_table(spark, cells):
    docs = table(spark, SF, "documents")
    got = [tuple(r) for r in spelling.variants(spelling.vocabulary(docs), cells).collect()]
    want = plain_variants(plain_words([(r.doc_id, r.text) for r in docs.collect()]))
    assert len(got) == len(want) and set(got) == want


@pytest.mark.parametrize("cells", [spelling.CELLS, 40])
def test_dense_words(spark, cells):
    # Few letters and long shared parts: words have many near words, in many lists.
    words = {f"{a}{b}{c}{d}{e}": n * 7 % 50 + 3 for n, (a, b, c, d, e) in enumerate(
        (a, b, c, d, e) for a in "abé" for b in "ab" for c in "aÿ" for d in "ab" for e in "abcd")}
    words |= {w + x: n + 1 for w, n in words.items() for x in ("a", "bb") if n % 3}
    words |= {"x" * 600: 5, "x" * 599 + "y": 11, "x" * 599: 30, "x" * 200 + "y" + "x" * 399: 3}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = [tuple(r) for r in spelling.variants(df, cells).collect()]
    want = plain_variants(words)
    assert len(got) == len(want) and set(got) == want


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "12 -- \U0001f600"), (None, "Colour colour COLOUR colours colours colours"),
            (4, "colour colour"), (4, "colour colour"), (5, "ÀÉtéé ÀÉtéé ÀÉtéé àététéx abcd abcd abcd"), (6, "word " * 30000),
            (7, "words words words color color color")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns(
        {c: F.lit("x") for c in ("word", "n", "key", "mid", "form")})
    got = {tuple(r) for r in spelling.variants(spelling.vocabulary(df)).collect()}
    want = plain_variants(plain_words(docs))
    assert got == want and {r[0] for r in got} == {"colour", "colours", "color", "ÀÉtéé", "words"}
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0


def test_ties_take_the_least_word(spark):
    df = spark.createDataFrame([("aaaab", 9), ("aaaaa", 9), ("aaaac", 3)], "word string, n long")
    got = {r.word: r for r in spelling.variants(df).collect()}
    assert got["aaaac"].form == "aaaaa" and got["aaaaa"].form is None and got["aaaab"].n_near == 2
