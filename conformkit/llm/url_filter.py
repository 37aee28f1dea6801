"""URL filter by a character language-model ratio (native).

Rules (host, path) decide the urls they fit.  The urls that an allow rule or a
block rule fits train two smoothed variable-order Markov models over characters,
one of accepted and one of rejected urls; a url that no rule fits is judged by
its length-normalised log-likelihood difference against a cut calibrated on the
ruled urls.

Model: a url is what follows its first ``://`` (else all of it), its characters as
they are, between a start and an end mark.  A table holds, for contexts of 0, 1, 2, 3,
4, 6, 8, 12, ... characters, how often each next character follows in accepted and in
rejected urls.  A context is kept only if ruled urls hold it SUPPORT times and its
counts are likelier by GAIN than the next shorter context makes them, and only kept
contexts are lengthened; so contexts grow with the corpus as far as it supports them,
and there is no greatest length.  The probability of a character is interpolated with
that after the next shorter context, down to uniform over the characters seen:
    p_k(c | ctx) = (n(ctx c) + MU p_{k-1}(c | shorter)) / (n(ctx) + MU).

Training and scoring are one loop over the context lengths.  The positions whose
context is kept so far are the only rows of a round: their grams are counted, joined
to the kept ones, and add the change of the log-likelihood difference to their url.
Equal urls are one row from the start, so copies cost nothing; gathered lists hold
one url's positions.

Calibration: one ruled url in FOLDS (by hash) is held out of the counts.  The cut
minimises the mean of both classes' error rates over the held-out urls, scores
rounded to 1/100 (of equal cuts the one nearest 0); over all ruled urls if a class
has none held out.  With one class missing every unruled url is allowed.

A null url scores as an empty text; repeated urls score alike; very long urls are
scored whole; an empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, written

MU = 4.0
SUPPORT, GAIN = 8, 4.0  # uses of a context; its gain in log-likelihood
FOLDS = 5
START, END = "\x02", "\x03"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule("allow", "com", "/"), Rule("block", "example.com", "/en/"),
         Rule("allow", "www.example.com", "/en/"), Rule("block", "net", "/es/"), Rule("block", "net", "/fr/"))


def address(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3))


def split_url(url: Column) -> tuple[Column, Column]:
    rest = F.coalesce(address(url), F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    host = F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)
    return host, F.regexp_extract(F.substr(rest, F.length(raw) + 1), r"^[^?#]*", 0)


def matching_rule(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """(text, verdict) of the longest rule that fits, null if none; of equally
    long ones that with the longer host.  Rules are a list in code."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.text), len(r.host), r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        text, verdict = F.when(fits, r.text).otherwise(text), F.when(fits, r.verdict).otherwise(verdict)
    return text, verdict


def lengths() -> Iterator[int]:
    """Context lengths: 0, then powers of two and half-way between."""
    yield 0
    k = 1
    while True:
        yield k
        if k > 1:
            yield k + k // 2
        k *= 2


def distinct_urls(rows: DataFrame) -> DataFrame:
    """uid, address, chars (with marks), yes, no: ruled uses of each distinct url that
    count, and held_yes, held_no: those held out."""
    held = F.pmod(F.crc32(F.encode("address", "UTF-8")), F.lit(FOLDS)) == 0
    uses = [F.count_if((F.col("verdict") == v) & (held if h else ~held)).alias(name)
            for name, v, h in (("yes", "allow", False), ("no", "block", False), ("held_yes", "allow", True), ("held_no", "block", True))]
    chars = F.filter(F.split("address", ""), lambda c: c != "")
    return written(rows.groupBy("address").agg(*uses).select(
        F.monotonically_increasing_id().alias("uid"), "address",
        F.concat(F.array(F.lit(START)), chars, F.array(F.lit(END))).alias("chars"), "yes", "no", "held_yes", "held_no"), "urls")


def grams(urls: DataFrame, live: DataFrame, k: int) -> DataFrame:
    """uid, at, ctx (the k characters before position ``at``), c, yes, no of the live
    positions that have so many before them."""
    rows = urls.select("uid", "chars", "yes", "no").join(live, "uid")
    gram = F.transform(F.filter("at", lambda i: i > k), lambda i: F.struct(
        i.alias("at"), F.array_join(F.slice("chars", i - k, k), "").alias("ctx"), F.get("chars", i - 1).alias("c")))
    return rows.select("uid", "yes", "no", F.explode(gram).alias("g")).select("uid", "g.*", "yes", "no")


def log_ratios(urls: DataFrame) -> DataFrame:
    """uid, score: the length-normalised log-likelihood difference of every url."""
    live = urls.select("uid", F.sequence(F.lit(2), F.size("chars")).alias("at"))
    symbols = urls.select(F.explode("chars").alias("c")).agg(F.count_distinct("c").alias("n"))
    before, scores, shorter = None, None, 0
    for k in lengths():
        rows = written(grams(urls, live, k), "url_grams")
        counted = rows.groupBy("ctx", "c").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no"))
        if before is None:
            uniform = 1 / symbols.scalar()
            counted = counted.select("*", uniform.alias("q_yes"), uniform.alias("q_no"))
        else:
            counted = counted.join(before, (F.right("ctx", F.lit(shorter)) == F.col("b_ctx")) & (F.col("c") == F.col("b_c")))
        ctx = W.partitionBy("ctx")  # as many rows as characters that follow it
        for v in ("yes", "no"):
            p = (F.col(v) + MU * F.col(f"q_{v}")) / (F.sum(v).over(ctx) + MU)
            counted = counted.withColumn(f"p_{v}", p)
        better = F.col("yes") * F.log(F.col("p_yes") / F.col("q_yes")) + F.col("no") * F.log(F.col("p_no") / F.col("q_no"))
        ratio = lambda a, b: F.log(F.col(a) / F.col(b))
        tested = counted.select("ctx", "c", "p_yes", "p_no", F.sum(F.col("yes") + F.col("no")).over(ctx).alias("n"),
                                F.sum(better).over(ctx).alias("gain"),
                                (ratio("p_yes", "p_no") - ratio("q_yes", "q_no")).alias("delta"))
        model = written(tested.where((F.col("n") >= SUPPORT) & (F.col("gain") >= GAIN)), "url_model")
        if model.isEmpty():
            break
        hit = written(rows.join(model.select("ctx", "c", "delta"), ["ctx", "c"]).groupBy("uid")
                      .agg(F.sum("delta").alias("delta"), F.collect_list("at").alias("at")), "url_live")
        part = hit.select("uid", "delta")
        scores = part if scores is None else scores.union(part)
        live, shorter = hit.select("uid", "at"), k
        before = model.select(F.col("ctx").alias("b_ctx"), F.col("c").alias("b_c"),
                              F.col("p_yes").alias("q_yes"), F.col("p_no").alias("q_no"))
    length = F.size("chars") - 1
    if scores is None:  # nothing to learn from
        return urls.select("uid", F.lit(0.0).alias("score"))
    sums = scores.groupBy("uid").agg(F.sum("delta").alias("sum"))
    # Rounded, so that the order in which doubles are added does not show.
    return urls.join(sums, "uid", "left").select(
        "uid", F.round(F.coalesce("sum", F.lit(0.0)) / length, 9).alias("score"))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, score of every page."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", F.coalesce(address(F.col("url")), "url", F.lit("")).alias("address"),
                        host.alias("host"), path.alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", rule.alias("rule"), verdict.alias("verdict"))
    urls = distinct_urls(rows)
    scored = written(urls.drop("chars").join(log_ratios(urls), "uid"), "url_scores")
    held = scored.select("score", F.col("held_yes").alias("yes"), F.col("held_no").alias("no"))
    all_ = scored.select("score", (F.col("yes") + F.col("held_yes")).alias("yes"), (F.col("no") + F.col("held_no")).alias("no"))
    cut = F.coalesce(calibrated_cut(held).scalar(), calibrated_cut(all_).scalar())
    ours = F.when(F.coalesce(F.col("score") >= cut, F.lit(True)), "allow").otherwise("block")
    return rows.join(scored.select("address", "score"), "address").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", ours).alias("verdict"), "score")


def calibrated_cut(uses: DataFrame) -> DataFrame:
    """One row ``cut`` from score, yes, no; null if a class is missing.  Works on one
    row per distinct rounded score, of which the smoothing allows a few thousand."""
    bins = (uses.groupBy(F.round(F.col("score"), 2).alias("at"))
            .agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")))
    before, all_ = W.orderBy("at").rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    zero = F.lit(0)
    errors = bins.select(
        "at", (F.try_divide(F.coalesce(F.sum("yes").over(before), zero), F.sum("yes").over(all_))
               + F.try_divide(F.sum("no").over(all_) - F.coalesce(F.sum("no").over(before), zero),
                              F.sum("no").over(all_))).alias("e"))
    # Scores are at least their rounded value less half a step.
    best = F.min(F.when(F.col("e").isNotNull(), F.struct("e", F.abs("at").alias("near"), "at")))
    return errors.agg((best["at"] - F.lit(0.005)).alias("cut"))


def op8_url_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages").select("page_id", "url"))
