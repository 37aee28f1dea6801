"""Column helpers checked against plain Python on a seeded fixture (brute force).

Every helper runs over the same few hundred strings in ONE Spark job; the
expected values are Python's own list/str semantics that the helpers mirror.
"""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from conformkit.functions import arrays as A
from conformkit.functions import dates as D
from conformkit.functions import maps as MP
from conformkit.functions import numbers as N
from conformkit.functions import strings as S
from conformkit.operators.joins import pairs_product, zip_shortest

ALPHABET = "abcdemr z\t\nxyzé"


def _strings(n=300, seed=7):
    rnd = random.Random(seed)
    out = ["", " ", "m", "e", "aaaa", "abab ab", "\t \n lead", "two  spaces", "trail "]
    for _ in range(n):
        out.append("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 25))))
    return out


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, s) for i, s in enumerate(_strings())]
    df = spark.createDataFrame(data, "id int, s string")
    cs = S.chars("s")
    ws = S.words("s")
    out = df.select(
        "id", "s",
        S.lstrip_whitespace("s").alias("lstrip"),
        S.count_substring("s", "ab").alias("count_ab"),
        S.py_slice("s", 3, 7).alias("slice37"),
        S.py_slice("s", 2).alias("slice2_"),
        S.py_step("s", 2).alias("step2"),
        S.py_step("s", 9, 0, 10).alias("step9_0_10"),
        S.py_step("s", 3, 1, 8).alias("step3_1_8"),
        S.py_step("s", -2).alias("step_neg2"),
        S.py_step("s", 1).alias("step1"),
        S.reverse("s").alias("rev"),
        cs.alias("chars"),
        ws.alias("words"),
        S.initials("s").alias("initials"),
        S.word_length_parity("s").alias("parity"),
        S.words_with_prefix("s", "a").alias("a_words"),
        A.joined(A.take_until(cs, "m")).alias("until_m"),
        A.index_of(cs, "e").alias("index_e"),
        A.joined(A.without(cs, "a")).alias("without_a"),
        A.py_range(F.lit(0), F.length("s"), F.lit(3)).alias("range3"),
        A.py_range(F.length("s"), F.lit(0), F.lit(-4)).alias("range_back"),
        A.item(cs, 2).alias("item2"),
        A.item(cs, -1).alias("item_last"),
        A.repeat(cs, 2).alias("twice"),
        A.smallest(cs).alias("min_c"),
        A.largest(cs).alias("max_c"),
        A.distinct(cs).alias("distinct"),
        zip_shortest(ws, F.slice(ws, 2, F.size(ws))).alias("bigrams"),
    )
    return out.collect()


def test_string_slicing_matches_python(rows):
    for r in rows:
        s = r.s
        assert r.slice37 == s[3:7], s
        assert r.slice2_ == s[2:], s
        assert r.step2 == s[::2], s
        assert r.step9_0_10 == s[0:10:9], s
        assert r.step3_1_8 == s[1:8:3], s
        assert r.step_neg2 == s[::-2], s
        assert r.step1 == s[::], s
        assert r.rev == s[::-1], s


def test_string_helpers_match_python(rows):
    for r in rows:
        s = r.s
        assert r.lstrip == s.lstrip(" \t\n\r\f\v"), repr(s)
        assert r.count_ab == s.count("ab"), s
        assert r.chars == list(s), s
        assert r.words == s.split(" "), s
        assert r.initials == "".join(w[:1] for w in s.split(" ")), s
        assert r.parity == ["even" if len(w) % 2 == 0 else "odd" for w in s.split(" ")], s
        assert r.a_words == [w for w in s.split(" ") if w.startswith("a")], s


def test_array_helpers_match_python(rows):
    for r in rows:
        s = r.s
        lst = list(s)
        assert r.until_m == (s[: s.index("m")] if "m" in s else s), s
        assert r.index_e == (s.index("e") if "e" in s else None), s
        assert r.without_a == "".join(c for c in lst if c != "a"), s
        assert r.range3 == list(range(0, len(s), 3)), s
        assert r.range_back == list(range(len(s), 0, -4)), s
        assert r.item2 == (lst[2] if len(lst) > 2 else None), s
        assert r.item_last == (lst[-1] if lst else None), s
        assert r.twice == lst * 2, s
        assert r.min_c == (min(lst) if lst else None), s
        assert r.max_c == (max(lst) if lst else None), s
        assert r.distinct == list(dict.fromkeys(lst)), s
        w = s.split(" ")
        assert [(p["_0"], p["_1"]) for p in r.bigrams] == list(zip(w, w[1:])), s


def test_number_and_label_helpers(spark):
    df = spark.range(-5, 40).select(F.col("id").cast("int").alias("x"))
    got = df.select("x", N.square_if_even("x").alias("sq"), N.plus_ten_percent("x").alias("p"),
                    N.compare_label("x", 10).alias("cmp"), N.even_or_odd_label("x").alias("eo"),
                    N.divisible_by("x", 3, 5).alias("d15")).collect()
    for r in got:
        x = r.x
        assert r.sq == (float(x ** 2) if x % 2 == 0 else None)
        assert r.p == x + x / 10
        assert r.cmp == ("greater" if x > 10 else "less" if x < 10 else "equal")
        assert r.eo == (str(x) if x % 2 == 0 else "ODD")
        assert r.d15 == (x % 3 == 0 and x % 5 == 0)


def test_seeded_int_is_in_range_and_independent_of_partitioning(spark):
    a = spark.range(5000).repartition(7).select("id", N.seeded_int("id", 42).alias("v"))
    b = spark.range(5000).repartition(3).select("id", N.seeded_int("id", 42).alias("v"))
    va = {r.id: r.v for r in a.collect()}
    vb = {r.id: r.v for r in b.collect()}
    assert va == vb
    assert min(va.values()) == 0 and max(va.values()) == 100
    c = {r.id: r.v for r in spark.range(5000).select("id", N.seeded_int("id", 43).alias("v")).collect()}
    assert c != va


def test_map_helpers(spark):
    df = spark.createDataFrame([('{"k": 3, "j": 4}',), ('{"k": 5}',), ("not json",)], "props string")
    m = MP.parse_json_map("props")
    got = df.select(F.sort_array(MP.keys(m)).alias("keys"), MP.lookup(m, "k").alias("k"),
                    MP.lookup(m, "zz").alias("zz"), MP.lookup(MP.put(m, "k", 9), "k").alias("k9"),
                    F.size(MP.put(m, "new", 1)).alias("n_put"),
                    MP.json_path("props", "$.j").alias("j")).collect()
    assert [(r["keys"], r.k, r.zz, r.k9, r.n_put, r.j) for r in got] == [
        (["j", "k"], 3, None, 9, 3, "4"),
        (["k"], 5, None, 9, 2, None),
        (None, None, None, None, None, None),
    ]


def test_date_labels(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2025, 11, 18),)], "d date")
    got = df.select(D.date_label("d").alias("a"), D.upper_label(D.previous_day("d")).alias("b"),
                    D.parse_label(D.upper_label(D.previous_day("d"))).alias("c")).collect()
    assert [(r.a, r.b, r.c) for r in got] == [
        ("01-Jan-2024", "31-DEC-2023", dt.date(2023, 12, 31)),
        ("18-Nov-2025", "17-NOV-2025", dt.date(2025, 11, 17)),
    ]


def test_pairs_product(spark):
    df = spark.createDataFrame([([1, 2], [10, 20, 30])], "a array<int>, b array<int>")
    got = df.select(pairs_product("a", "b").alias("p")).first().p
    assert got == [x * y for x in [1, 2] for y in [10, 20, 30]]


def test_variants_of_drifting_json(spark):
    texts = ['{"k": 1}', '{"k": "x"}', '{"k": [1, 2]}', '{"k": {"a": 1.5}}', "{bad", None, "null", '{"k": null}', "{}", "", "7"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, j string").withColumn("v", MP.parse_variant("j"))
    rows = {r.id: r for r in df.select(
        "id", F.col("v").isNull().alias("bad"), MP.variant_get("v", "$.k", "int").alias("n"),
        MP.variant_get("v", "$.k[1]", "int").alias("second"), MP.variant_get("v", "$.k.a", "double").alias("a"),
        MP.variant_get("v", "$.k").alias("text"), MP.variant_kind("v", "$.k").alias("kind")).collect()}
    assert [i for i, r in rows.items() if r.bad] == [4, 5, 9]
    assert [rows[i].n for i in range(4)] == [1, None, None, None]
    assert (rows[2].second, rows[3].a, rows[1].text, rows[3].text) == (2, 1.5, "x", '{"a":1.5}')
    assert [rows[i].kind for i in (0, 1, 2, 3, 7, 8, 10)] == ["BIGINT", "STRING", "ARRAY<BIGINT>", "OBJECT<a: DECIMAL(2,1)>", "VOID", None, None]
    assert MP.variant_schema(df.where("id IN (0, 8)"), "v") == "OBJECT<k: BIGINT>"
    assert "VARIANT" in MP.variant_schema(df.where("id < 3"), "v")
    faults = MP.json_faults(df.withColumn("g", F.lit("x")), "j", "g").collect()
    assert [tuple(r) for r in faults] == [("x", 11, 1, 2)]
