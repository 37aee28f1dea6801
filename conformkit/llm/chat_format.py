"""Chat formatting with Spark expressions (native).

The turns of a conversation are collected as structs and sorted by (turn, role,
text); adjacent turns of one role are merged into a run, and the runs are
concatenated:

    <|turn|>ROLE\\nTEXT<|sep|>TEXT<|end|><|turn|>ROLE\\nTEXT<|end|>...

<|sep|> stands between the merged texts, so the original turns can be read back.
Control strings inside a text or role (this template's and those of the [INST]
kind) get a backslash after their first character, or one more where there are
some already; reading back takes one away, so escaping is reversible for every
text.  A newline in a role is written as \\n (and a backslash as \\\\).

``segments`` are the pieces of the formatted text in order, each with its loss
flag: true for exactly the assistant texts.

Null texts and roles are empty; rows with a null turn come first; repeated rows
are repeated turns; the rows of a null conv_id form one conversation.  An empty
table gives an empty result.  Other columns are not read.  One conversation is
one output row, so its turns meet in one task; every step is linear in them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

TURN, SEP, END = "<|turn|>", "<|sep|>", "<|end|>"
# What stands after the first character of a control string.
TAILS = r"\||/?s>|/?INST\]|/?SYS>>"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])(\\*)({TAILS})", r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"([<\[])\\(\\*)({TAILS})", r"$1$2$3")


def _role_out(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def _role_in(role: Column) -> Column:
    # "\\" pairs are set aside first, so that "\\n" is a backslash and an n.
    pairs = F.split(unescape(role), r"\\\\", -1)
    return F.array_join(F.transform(pairs, lambda p: F.replace(p, F.lit("\\n"), F.lit("\n"))), "\\")


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, segments (array of struct text, loss)."""
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    sorted_ = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    at = F.sequence(F.lit(0), F.size("turns") - 1)
    first = F.filter(at, lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    starts = sorted_.withColumn("starts", first)

    def run(start: Column, k: Column) -> Column:
        """The merged turns from one start to the next."""
        end = F.coalesce(F.get("starts", k + 1), F.size("turns"))
        return F.struct(F.get("turns", start)["role"].alias("role"),
                        F.transform(F.slice("turns", start + 1, end - start),
                                    lambda t: t["text"]).alias("texts"))

    runs = starts.select("conv_id", F.transform("starts", run).alias("runs"))

    def pieces(r: Column) -> Column:
        head = F.concat(F.lit(TURN), _role_out(r["role"]), F.lit("\n"))
        one = lambda t, i: F.array(
            F.struct(F.when(i == 0, head).otherwise(F.lit(SEP)).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t).alias("text"), (r["role"] == LOSS_ROLE).alias("loss")))
        end = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
        return F.concat(F.flatten(F.transform(r["texts"], one)), end)

    return (runs.select("conv_id", F.flatten(F.transform("runs", pieces)).alias("segments"))
            .select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                    "segments"))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of struct role, text), loss (text under the mask),
    formatted: from the output of ``format_conversations`` alone."""
    def parse(run: Column) -> Column:
        inner = F.substring(run, len(TURN) + 1, 2 ** 31 - 1)
        role = F.substring_index(inner, "\n", 1)
        texts = F.split(F.substr(inner, F.length(role) + 2), r"<\|sep\|>", -1)
        return F.transform(texts, lambda t: F.struct(_role_in(role).alias("role"), unescape(t).alias("text")))

    runs = F.split("formatted", r"<\|end\|>", -1)
    parts = formatted.withColumn("runs", runs)
    return parts.select(
        "conv_id",
        F.flatten(F.transform(F.slice("runs", 1, F.size("runs") - 1), parse)).alias("turns"),
        F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                 lambda s: unescape(s["text"])), "").alias("loss"),
        "formatted")


TEST_TURN = "</s>[INST] ok [/INST]"


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    made = {"conv_id": F.lit(-1), "turn": F.col("id"), "role": role, "text": F.lit(TEST_TURN)}
    extra = spark.range(2).select(*[made[f.name].cast(f.dataType).alias(f.name) for f in rows.schema])
    back = read_back(format_conversations(rows.unionByName(extra)))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
r AS (
  SELECT *, coalesce(role = lag(role) OVER w, false) AS merged,
         length(regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\]|/?SYS>>)', '\1\\\2\3', 'g')) AS escaped
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(escaped + CASE WHEN merged THEN length('<|sep|>')
                          ELSE length('<|turn|>') + length(role) + 1 + length('<|end|>') END) AS BIGINT) AS formatted_chars
FROM r GROUP BY conv_id
"""
