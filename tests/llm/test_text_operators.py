"""Language ID, exact dedup, near-dedup, mixing, quality: against brute force and
on odd inputs."""

from __future__ import annotations

import hashlib
import math
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from conformkit.llm import exact_dedup, langid, mixing, near_dedup, quality
from conformkit.llm.common import Powers, table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, node int"
ODD = [(1, None, None, None, None, "x", 1), (2, "", "en", "a", 0, "x", 1), (3, "  \n\t", "en", "a", 4, "x", 1),
       (4, "12345 !!", "en", None, 8, "x", 1), (5, "the cat and the dog", "en", "a", 19, "x", 1),
       (5, "the cat and the dog", "en", "a", 19, "x", 1), (6, "der Hund und die Katze", "de", "b", 22, "x", 1),
       (7, "the cat  and\nthe dog", "en", "b", 20, "x", 1), (8, "der und die " * 40_000, "de", "b", 480_000, "x", 1),
       (None, "the end", "en", "b", 7, "x", 1)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def rank_order(text: str, k: int) -> list[str]:
    """The most frequent n-grams of a text, the plain way."""
    text = "".join(c if c.isalpha() else " " for c in text.lower())
    found = Counter()
    for word in text.split():
        w = f" {word} "
        found.update(w[1:-1])
        found.update(w[i:i + 2] for i in range(len(w) - 1))
        found.update(w[i:i + 3] for i in range(len(w) - 2))
    def code(g):
        n = [0 if c == " " else ord(c) for c in g]
        return n[0] if len(n) == 1 else (1 << 63 | n[0] << 21 | n[1]) if len(n) == 2 else n[0] << 42 | n[1] << 21 | n[2]
    return sorted(found, key=lambda g: (-found[g], code(g)))[:k]


def test_language_distance_matches_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(60).toPandas()
    texts = list(docs.text)
    letters = langid.letter_table()
    code = lambda g: (lambda n: n[0] if len(n) == 1 else (1 << 63 | n[0] << 21 | n[1]) if len(n) == 2
                      else n[0] << 42 | n[1] << 21 | n[2])([0 if c == " " else ord(c) for c in g])
    plain = {"x": rank_order(" ".join(texts[:20]), 300), "y": rank_order(" ".join(texts[20:40]), 300)}
    scorer = langid.Scorer({k: np.array([code(g) for g in v], np.uint64) for k, v in plain.items()})
    seen = 0
    for row, codes, counts in langid.document_counts(pa.array(texts), letters):
        mine = rank_order(texts[row], 300)
        assert [code(g) for g in mine] == langid.top(codes, counts, 300).tolist()
        want = [sum(abs(p.index(g) - i) if g in p else 300 for i, g in enumerate(mine)) for p in (plain["x"], plain["y"])]
        assert scorer.distances(langid.top(codes, counts, 300)).tolist() == want
        seen += 1
    assert seen == sum(any(c.isalpha() for c in t) for t in texts)


def test_language_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    out = langid.op1_rank_order_language(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    rows = out.where("held_out AND lang IS NOT NULL").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert rows[0] > 0.98


def test_language_odd_rows(odd, none):
    profiles = langid.train(odd)
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd, profiles).collect()}
    assert got[1] == got[2] == got[3] == got[4] == ("und", 0.0)
    assert got[5][0] == got[7][0] == "en" and got[6][0] == got[8][0] == "de"
    kept = langid.accepted(odd, profiles)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 5, 5, 6, 7, 8]
    assert langid.predict(none, profiles).count() == 0
    assert {r.lang_pred for r in langid.predict(odd, langid.train(none)).collect()} == {"und"}


def test_language_bars_follow_one_rule(spark):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    profiles = langid.train(docs)
    least = langid.calibrate(docs, profiles)
    scorer, letters, samples = langid.Scorer(profiles), langid.letter_table(), defaultdict(set)
    for r in docs.select("text", F.xxhash64("text").alias("key")).where("text IS NOT NULL AND lang IS NOT NULL").collect():
        for n, text in enumerate([r.text]):
            for row, seq in langid.sequences(pa.array([text]), letters):
                words = " ".join("".join(map(chr, seq)).replace("\0", " ").split())
                parts = [words]
                count = len(words.split())
                if count > 1:
                    powers = [2 ** i for i in range(20) if 2 ** i < count]
                    parts.append(" ".join(words.split()[:powers[(r.key & 0xFFFF) % len(powers)]]))
                for k, part in enumerate(parts):
                    which, score, size = scorer.judge(pa.array([part]), letters)
                    samples[which[0], size[0]].add((int(score[0] * 1000), part if k else ("whole", r.text)))
    for lang in range(len(scorer.langs)):
        shorter = 0.0
        for size in range(langid.SIZES):
            steps = np.array(sorted(s for s, _ in samples[lang, size])) / 1000
            if len(steps):
                low, middle = np.quantile(steps, [0.25, 0.5])
                own = middle - 8 * max(middle - low, 0.02)
                shorter = (len(steps) * own + 20 * shorter) / (len(steps) + 20)
            assert least[lang, size] == pytest.approx(shorter)
    both = docs.withColumn("key", F.lit("x")).withColumn("score", F.lit("y"))
    assert langid.accepted(both, profiles, least).schema == both.schema


def test_language_tasks_work_on_small_blocks():
    # Two cores' tasks share an executor's memory: what one holds beyond its batch stays
    # a small part of it, and does not grow with the batch.
    rng = np.random.default_rng(1)
    words = ["".join(chr(c) for c in rng.integers(97, 123, n)) for n in rng.integers(2, 9, 2000)]
    texts = [" ".join(words[i] for i in rng.integers(0, 2000, 500)) for _ in range(3000)]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": ["en", "de", "en"] * 1000})
    assert batch.nbytes > 8 << 20
    scorer, letters = langid.Scorer({"x": np.arange(97, 123, dtype=np.uint64)}), langid.letter_table()
    for task in (lambda: [*langid.counted_per_language(iter([batch]))], lambda: scorer.judge(batch.column("text"), letters)):
        tracemalloc.start()
        task()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 40 << 20


def test_language_counts_whole_texts_in_blocks():
    texts = ["der und die " * 150_000, None, "", "x" * 1_200_000, *["the cat and the dog"] * 700, "12 !"]
    letters, want = langid.letter_table(), {}
    for row, seq in ((r, s) for r, t in enumerate(texts) for _, s in langid.sequences(pa.array([t], pa.string()), letters)):
        want[row] = Counter(langid.ngrams(seq).tolist())
    got = {row: Counter(dict(zip(code.tolist(), count.tolist())))
           for row, code, count in langid.document_counts(pa.array(texts), letters)}
    assert got == want and len(want) == 702
    assert len([*langid.sequences(pa.array(texts[:1]), letters, langid.BLOCK)]) > 4
    langs = ["de", None, "de", "en", *["en", "de"] * 350, "en"]
    batch = pa.RecordBatch.from_pydict({"text": texts, "lang": langs})
    per = defaultdict(Counter)
    for out in langid.counted_per_language(iter([batch])):
        for lang, gram, n in zip(*(c.to_pylist() for c in out.columns)):
            per[lang][gram % (1 << 64)] += n
    assert per == {lang: sum((c for r, c in want.items() if langs[r] == lang), Counter()) for lang in ("de", "en")}


def test_exact_dedup_batches(spark, odd, none):
    index = exact_dedup.fresh_index(spark)
    rows = exact_dedup.decide(odd, index).collect()
    assert len(rows) == len(ODD)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in rows}
    assert got[3] == (3, 3, True) and got[1] == (3, 3, False)
    assert got[7] == (7, 3, True) and got[5] == (7, 3, False)
    again = {r.doc_id: r for r in exact_dedup.decide(spark.createDataFrame(
        [(90, "thecatandthedog" + " " * 50), (91, "new")], "doc_id long, text string"), index).collect()}
    assert (again[90].keep_id, again[90].kept) == (7, False) and again[91].kept
    assert exact_dedup.decide(none, index).count() == 0
    kept = exact_dedup.deduplicate(odd, exact_dedup.fresh_index(spark))
    assert kept.columns == odd.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 6, 7, 8]


def test_index_survives_reopening(spark):
    from conformkit.session import scratch_path

    path = scratch_path(spark, "index")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    exact_dedup.decide(first, exact_dedup.DigestIndex(spark, path, 4)).count()
    index = exact_dedup.DigestIndex(spark, path, 4)
    rows = exact_dedup.decide(spark.createDataFrame([(3, "b")], "doc_id long, text string"), index).collect()
    assert [(r.keep_id, r.kept) for r in rows] == [(2, False)]
    assert exact_dedup.DigestIndex(spark, path).buckets == 4  # as it was made
    grown = exact_dedup.regrown(index, scratch_path(spark, "index"))
    assert grown.buckets == exact_dedup.bucket_count(spark, 2) != 4 and exact_dedup.bucket_count(spark, 10 ** 10) == 9537
    assert sorted(map(tuple, grown.rows().collect())) == sorted(map(tuple, index.rows().collect()))
    rows = exact_dedup.decide(spark.createDataFrame([(4, "a ")], "doc_id long, text string"), grown).collect()
    assert [(r.keep_id, r.kept) for r in rows] == [(1, False)]
    plan = first.select(F.col("text").alias("digest")).hint("merge").join(index.rows().select("digest"), "digest", "left_anti")
    # The new rows are shuffled into the index's buckets, the index is not.
    assert plan._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(") == 1


def plain_shingles(text: str) -> Counter:
    """Shingles as tuples of words: an own version, without hashes."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text.lower())
    return Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def plain_similarities(texts: dict[int, str], counted: list[int]) -> dict[tuple[int, int], float]:
    """Weighted Jaccard similarity of all pairs; idf over the ``counted`` documents."""
    tf = {i: plain_shingles(t) for i, t in texts.items()}
    df = Counter(s for i in counted for s in tf[i])
    n, least = len(counted), max(1, len(counted) / 1024)
    weight = {i: {s: k * (1 + math.log(n / min(max(df[s], least), n)) / math.log(1024)) for s, k in c.items()} for i, c in tf.items()}
    out = {}
    for a in texts:
        for b in texts:
            if a < b and weight[a] and weight[b]:
                shared = sum(min(w, weight[b].get(s, 0)) for s, w in weight[a].items())
                out[a, b] = shared / (sum(weight[a].values()) + sum(weight[b].values()) - shared)
    return out


def components_of(ids, links) -> set[frozenset]:
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        root[find(a)] = find(b)
    out = defaultdict(set)
    for i in ids:
        out[find(i)].add(i)
    return set(map(frozenset, out.values()))


def test_near_dedup_matches_brute_force(spark):
    rng = np.random.default_rng(4)
    words = np.array([f"w{i}" for i in range(400)])
    texts = {}
    for g in range(12):  # copies of a text with 0 to 4 of 150 words changed
        base = rng.choice(words, 150)
        for _ in range(9):
            t = base.copy()
            t[rng.integers(0, 150, rng.integers(0, 5))] = "changed"
            texts[len(texts)] = " ".join(t)
    for _ in range(60):
        texts[len(texts)] = " ".join(rng.choice(words, rng.integers(1, 200)))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    counted = [r.doc_id for r in near_dedup.firsts(docs, 5).collect()]
    similarity = plain_similarities(texts, counted)
    got = defaultdict(set)
    for r in near_dedup.classes(docs).collect():
        got[r.class_id].add(r.doc_id)
        assert r.kept == (r.doc_id == r.class_id)
    # The idf is held as a byte, so a similarity is known to 0.002: classes lie between
    # the components of the links a little above and a little below the threshold.
    above, below = (components_of(texts, [p for p, s in similarity.items() if s >= x]) for x in (0.802, 0.798))
    classes = set(map(frozenset, got.values()))
    assert all(any(c <= k for k in classes) for c in above) and all(any(k <= c for c in below) for k in classes)
    assert len(above) - len(below) <= 6


def test_document_frequencies_count_groups_once(spark):
    # A third of all rows are copies of one text, each with some words changed.
    rng = np.random.default_rng(8)
    words = np.array([f"w{i}" for i in range(5000)])
    base, texts = rng.choice(words, 120), []
    for n in range(400):
        t = base.copy()
        t[rng.integers(5, 115)] = f"own{n}"
        texts.append(" ".join(t))
    texts += [" ".join(rng.choice(words, 120)) for _ in range(800)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counted = [r.doc_id for r in near_dedup.firsts(docs, 5).collect()]
    assert sum(i < 400 for i in counted) <= 4 and sum(i >= 400 for i in counted) >= 795
    classes = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert len({classes[i] for i in range(400)}) == 1  # the group stays whole
    # Two copies share 106 of 126 shingles.  Counted in every copy, those would weigh too
    # little for a link, beside the 20 that only one document has.
    one, two = (set(plain_shingles(t)) for t in texts[:2])
    assert len(one & two) >= 106 and len(one | two) <= 126
    often = 1 + math.log(1200 / 400) / math.log(1024)
    assert 106 * often / (106 * often + 20 * 2) < 0.8


def passage_pairs(spark, passage: list[str]) -> list[tuple[str, str]]:
    """Pairs (text, copy that ends with the passage) in which the copy is the first of
    no group."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(20000)])
    pairs = []
    for _ in range(50):
        base = rng.choice(words, 900)
        pairs.append((" ".join(base), " ".join([*base, *passage])))
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
    counted = {r.doc_id for r in near_dedup.firsts(docs, 5).collect()}
    return [p for i, p in enumerate(pairs) if counted & {2 * i, 2 * i + 1} == {2 * i}]


def test_document_frequencies_count_every_document(spark):
    passage = [f"p{i}" for i in range(30)]
    pairs = passage_pairs(spark, passage)
    docs = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
    counted = {r.doc_id for r in near_dedup.firsts(docs, 5).collect()}
    assert len(pairs) >= 10 and counted == {2 * i for i in range(len(pairs))}  # no first holds the passage
    idf = near_dedup.idf_table(docs, 5)

    def cells(text):
        return next(near_dedup.shingle_words(pa.array([text]), 5, Powers()))[2] >> np.uint32(32 - near_dedup.SKETCH_BITS)
    # It stands in one of the two documents of nearly every group (it joins a few of them).
    assert np.abs(idf[cells(" ".join(passage))] - 255 * math.log(2) / math.log(1024)).max() <= 4
    assert abs(np.median(idf[cells(pairs[0][0])]) - 255 * math.log(len(pairs)) / math.log(1024)) <= 4


def test_shares_add_up_to_one_a_group(spark):
    a, b, c = "one two three four five six seven", "red green blue white black grey pink", "a b c d e f g h i"
    rows = [(1, a), (1, a), (2, a + " "), (None, a), (1, b), (None, c), (None, c), (3, None), (4, " ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = docs.withColumn("digest", near_dedup.text_digest()).alias("d").join(
        near_dedup.shares(docs, 5).alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.digest") == F.col("s.digest")))
    share = defaultdict(int)
    for r in got.select("text", "share").collect():
        share[r.text.strip()] += r.share / near_dedup.UNIT
    assert share == pytest.approx({a: 1, b: 1, c: 1})
    # Most documents of a large group hold what its first ones hold: it counts about once.
    texts = [" ".join([f"w{i}" for i in range(200)] + [f"own{n}"]) for n in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert near_dedup.shares(docs, 5).agg(F.sum("share")).first()[0] < 3 * near_dedup.UNIT


@pytest.mark.parametrize("kept", [0, 3])
def test_late_links_join_components(spark, monkeypatch, kept):
    # Without most of the first comparisons, the links come from those inside the bands.
    rng = np.random.default_rng(6)
    words = np.array([f"w{i}" for i in range(900)])
    texts = []
    for _ in range(2):
        base = rng.choice(words, 100)
        for _ in range(40):
            t = base.copy()
            t[rng.integers(0, 100)] = "changed"
            texts.append(" ".join(t))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = near_dedup.near_pairs
    monkeypatch.setattr(near_dedup, "near_pairs", lambda members: pairs(members).where(F.pmod(F.xxhash64("a", "b"), F.lit(10)) < kept))
    got = {r.doc_id: r.class_id for r in near_dedup.classes(docs).collect()}
    assert got == {i: 40 * (i // 40) for i in range(80)}


def test_near_dedup_keeps_by_document_and_text(spark):
    # doc_id 1 names two texts; the second is a copy of that of doc_id 0.
    a, b = "one two three four five six seven", "red green blue white black grey pink"
    docs = spark.createDataFrame([(1, a), (0, b), (1, b + " ")], "doc_id long, text string")
    assert sorted((r.doc_id, r.text) for r in near_dedup.deduplicate(docs).collect()) == [(0, b), (1, a)]
    same = spark.createDataFrame([(5, a), (5, a + " "), (5, b)], "doc_id long, text string")
    assert sorted(r.text.strip() for r in near_dedup.deduplicate(same).collect()) == [a, b]


def test_near_dedup_shuffles_texts_once(spark, monkeypatch):
    a, b = "one two three", "red green blue"
    rows = [(1, a), (1, a), (2, a + " "), (None, b), (None, b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_dedup.classified(docs)
    monkeypatch.setattr(near_dedup, "classified", lambda *_: found)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        kept = near_dedup.deduplicate(docs)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.text for r in kept.collect()) == [a, b]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    above = plan[:plan.index("LeftSemi")]
    assert "Exchange" not in above and above.count("first(row") == 2  # repeated rows go where the join left them


def test_near_dedup_estimate():
    """Consistent sampling: the share of equal samples is near the similarity."""
    rng = np.random.default_rng(1)
    s, shares, truth = near_dedup.Sampler(), [], []
    for _ in range(200):
        code = np.unique(rng.integers(0, 1 << 32, 300, np.uint32))
        w = rng.choice([1.0, 1.1, 2.0, 5.0], len(code))
        cut = rng.integers(0, 100)
        a, b = slice(0, len(code) - cut), slice(cut, len(code))
        shares.append((s.sample(code[a], w[a]) == s.sample(code[b], w[b])).mean())
        truth.append(w[cut:len(code) - cut].sum() / w.sum())
    assert abs(np.mean(np.array(shares) - truth)) < 0.02
    assert np.abs(np.array(shares) - truth).max() < 0.3


def test_near_dedup_odd_rows(odd, none):
    rows = near_dedup.classes(odd).collect()
    assert len(rows) == len(ODD)
    of = {r.doc_id: r.class_id for r in rows}
    assert of[1] == of[2] == of[3] == 1 and of[5] == of[7] == 5 and of[6] == 6
    assert near_dedup.classes(none).count() == 0
    kept = near_dedup.deduplicate(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 1, 4, 5, 6, 8]


def plain_targets(sizes: dict) -> dict:
    """Shares by weight 1, 2, 3, ... in code-point order, null last; limits of 3 x size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(names)}
    out: dict = {}
    while len(out) < len(names):
        share = (sum(sizes.values()) - sum(out.values())) / sum(weight[s] for s in names if s not in out)
        over = [s for s in names if s not in out and weight[s] * share > 3 * sizes[s]]
        out |= {s: 3 * sizes[s] for s in over} if over else {s: weight[s] * share for s in names if s not in out}
    return out


def test_mixing_targets(spark):
    rng = np.random.default_rng(3)
    cases = [{"a": 10, "b": 100, None: 100}, {}, {None: 0}, {"x": 5}, {"a": 0, "b": 0},
             {f"s{i}": int(10 ** rng.uniform(0, 6)) for i in range(200)} | {None: 7, "": 3, "é": 50}]
    for sizes in cases:
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r.source: r.target for r in mixing.targets(df).collect()}
        assert got == pytest.approx(plain_targets(sizes))


def cost_of(supply, quota, flow, repeats=3) -> tuple[int, int]:
    """(tokens routed, their cost); checks supplies and quotas."""
    per_pattern, per_source = Counter(), Counter()
    for (p, s), n in flow.items():
        assert n > 0 and s in supply[p][1]
        per_pattern[p] += n
        per_source[s] += n
    assert all(per_pattern[p] <= repeats * t for p, (t, _) in enumerate(supply))
    assert all(per_source[s] <= q for s, q in enumerate(quota))
    cost = sum(max(0, min(t, per_pattern[p] - k * t)) * (k + 1) for p, (t, _) in enumerate(supply) for k in range(repeats))
    return sum(flow.values()), cost


def plain_flow(supply, quota, repeats=3) -> tuple[int, int]:
    """(tokens, cost) by pushing one cheapest path after another, found by relaxation."""
    arcs = []  # [from, to, capacity, cost]; the reverse of arc i is i ^ 1
    end = len(supply) + len(quota) + 1

    def arc(a, b, cap, cost):
        arcs.extend([[a, b, cap, cost], [b, a, 0, -cost]])
    for p, (t, sources) in enumerate(supply):
        for k in range(repeats):
            arc(0, 1 + p, t, k + 1)
        for s in sources:
            arc(1 + p, 1 + len(supply) + s, repeats * t, 0)
    for s, q in enumerate(quota):
        arc(1 + len(supply) + s, end, q, 0)
    total = cost = 0
    while True:
        dist, via = {0: 0}, {}
        for _ in range(end + 1):
            for i, (a, b, cap, c) in enumerate(arcs):
                if cap > 0 and a in dist and dist[a] + c < dist.get(b, 1 << 60):
                    dist[b], via[b] = dist[a] + c, i
        if end not in dist:
            return total, cost
        path, v = [], end
        while v:
            path.append(via[v])
            v = arcs[via[v]][0]
        push = min(arcs[i][2] for i in path)
        for i in path:
            arcs[i][2] -= push
            arcs[i ^ 1][2] += push
        total, cost = total + push, cost + push * dist[end]


@pytest.mark.parametrize("seed", range(25))
def test_mixing_flow_is_the_cheapest(seed):
    rng = np.random.default_rng(seed)
    n = int(rng.integers(1, 6))
    supply = [(int(rng.integers(0, 30)), sorted(rng.choice(n, rng.integers(1, n + 1), False).tolist())) for _ in range(rng.integers(1, 12))]
    quota = rng.integers(0, 80, n).tolist()
    assert cost_of(supply, quota, mixing.min_cost_flow(supply, quota)) == plain_flow(supply, quota)


def test_mixing_flow_is_unique_where_it_must_be():
    # Two patterns, one shared: cheapest is to spread repeats evenly.
    flow = mixing.min_cost_flow([(10, [0]), (10, [0, 1])], [15, 5])
    assert flow == {(0, 0): 10, (1, 0): 5, (1, 1): 5}
    assert mixing.min_cost_flow([(10, [0])], [25]) == {(0, 0): 25}


def test_mixing_many_sources_and_networks(spark):
    # 600 sources of their own and 200 pairs that share documents: no table is bounded or raised on.
    rows = [(i, "w " * (1 + i % 9), [f"own{i % 600}"]) for i in range(3000)]
    rows += [(10_000 + i, "w " * (1 + i % 7), [f"a{i % 200}", f"b{i % 200}"] if i % 3 else [f"a{i % 200}"]) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, of array<string>")
    taken, target, most = Counter(), {}, Counter()
    per_doc = Counter()
    for r in mixing.mix(docs, sources="of").collect():
        taken[r.source] += r.taken
        target[r.source], most[r.source] = r.target, max(most[r.source], r["size"])
        per_doc[r.doc_id, r["size"]] += r.taken
    assert len(target) == 1000 and all(n <= 3 * size for (_, size), n in per_doc.items())
    # Each source comes near its target (a document at each of a pattern's ends may be over or under),
    # but for pairs whose documents do not suffice for both.
    near = [s for s in target if abs(taken[s] - target[s]) <= 2 * most[s] + 1]
    assert len(near) >= 0.95 * len(target) and {s for s in target if s.startswith("own")} <= set(near)


def test_mixing_reaches_targets(spark):
    sf = "/root/testdata/sf0.01"
    rows = mixing.op9_min_cost_mixing(spark, sf).collect()
    docs = table(spark, sf, "documents").collect()
    assert len(rows) == len(docs)
    size = {d.doc_id: len([w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in d.text or "").split(" ") if w])
            for d in docs}
    per = Counter()
    for d in docs:
        per[d.source] += size[d.doc_id]
    want = plain_targets(dict(per))
    taken = Counter()
    for r in rows:
        assert r["size"] == size[r.doc_id] and r.source_size == per[r.source] and r.taken % max(1, r["size"]) == 0
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    longest = max(size.values())
    assert all(abs(taken[s] - want[s]) <= longest for s in want)
    again = {r.doc_id: r.taken for r in mixing.op9_min_cost_mixing(spark, sf).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_mixing_odd_rows_and_overlap(spark, odd, none):
    rows = mixing.mix(odd).collect()
    assert len(rows) == len(ODD) and all(r.taken == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(none).count() == 0 and mixing.mixed_documents(none).count() == 0
    copies = mixing.mixed_documents(odd)
    assert copies.columns == odd.columns
    times = Counter(r.doc_id for r in copies.collect())
    sizes = Counter()
    for r in rows:
        sizes[r.doc_id] += r.taken // max(1, r["size"])
    assert times == +sizes
    both = spark.createDataFrame([(i, "w " * 10, ["a", "b"] if i % 2 else ["a"]) for i in range(400)],
                                 "doc_id long, text string, of array<string>")
    taken = mixing.mix(both, sources="of").groupBy("source").agg(F.sum("taken").alias("n"), F.first("target").alias("t")).collect()
    assert all(abs(r.n - r.t) <= 20 for r in taken)


def test_quality_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    out = quality.op7_random_indexing_quality(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out")
    got = out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.min("score"), F.max("score")).first()
    assert got[0] > 0.95 and 0 <= got[1] and got[2] <= 1


def test_quality_odd_rows(spark, odd, none):
    vectors = quality.word_vectors(odd)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (6, None, 0)], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.scored(odd, vectors, quality.fit(odd, labels, vectors)).collect()} == {0.5}
    many = spark.createDataFrame([(i, "good words here" if i % 2 else "BAD ## !!") for i in range(100)], "doc_id long, text string")
    lab = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    v = quality.word_vectors(many)
    net = quality.fit(many, lab, v)
    assert all((r.score >= 0.5) == bool(r.doc_id % 2) for r in quality.scored(many, v, net).collect())
    assert all(0 <= r.score <= 1 for r in quality.scored(odd, v, net).collect())
    assert quality.scored(none, v, net).count() == 0


def test_word_vectors_match_a_plain_count(spark):
    texts = ["a b c a", "b 12 !? c\nd", None, "", "solo"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string")
    at, sign = quality.index_vectors()
    want = np.zeros((quality.WORDS, quality.DIM))
    for _, _, word, doc in quality.tokens(pa.array(texts), quality.token_class(), quality.Powers()):
        for i in range(len(word)):
            for j in range(len(word)):
                if i != j and abs(i - j) <= 2 and doc[i] == doc[j]:
                    want[word[i], at[word[j]]] += sign[word[j]]
    norm = np.linalg.norm(want, axis=1, keepdims=True)
    want = np.divide(want, norm, out=np.zeros_like(want), where=norm > 0)
    assert np.allclose(quality.word_vectors(docs), want, atol=1e-6)
