"""Catalogue queries for column helpers, ordering, joins and positions.

Array results are joined to text (or counted) so both engines return plain
scalar columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conformkit.functions import arrays as A
from conformkit.functions import dates as D
from conformkit.functions import maps as MP
from conformkit.functions import numbers as N
from conformkit.functions import strings as STR
from conformkit.operators import joins as J
from conformkit.operators import ordering as O
from conformkit.plans.catalog import query, table
from conformkit.sinks.files import preview

# ------------------------------------------------------------------ strings


@query("string_basics", "STR-2 STR-3 STR-5 STR-8 STR-9 STR-12 STR-13 STR-14 MTH-6 PRJ-13", r"""
SELECT p_partkey,
       upper(p_name) AS upper_name,
       regexp_replace(p_name, '^\s+', '') AS lstripped,
       substring(p_name, 4, 4) AS slice_3_7,
       p_name AS whole_copy,
       reverse(p_name) AS reversed,
       array_to_string(list_transform(string_split(p_name, ' '), lambda w: left(w, 1)), '') AS initials,
       upper(p_name) AS upper_chars,
       p_name || ' is ' || p_brand AS described,
       array_to_string(list_transform(string_split(p_name, ' '),
           lambda w: CASE WHEN length(w) % 2 = 0 THEN 'even' ELSE 'odd' END), ',') AS word_parity
FROM part
""")
def string_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        STR.upper("p_name").alias("upper_name"),
        STR.lstrip_whitespace("p_name").alias("lstripped"),
        STR.py_slice("p_name", 3, 7).alias("slice_3_7"),
        STR.py_step("p_name", 1).alias("whole_copy"),
        STR.reverse("p_name").alias("reversed"),
        STR.initials("p_name").alias("initials"),
        STR.upper_chars("p_name").alias("upper_chars"),
        STR.format_pair("p_name", "p_brand").alias("described"),
        F.concat_ws(",", STR.word_length_parity("p_name")).alias("word_parity"),
    )


@query("char_steps", "STR-6 STR-7 STR-10", """
SELECT p_partkey,
       array_to_string(list_filter(string_split(p_name, ''), lambda x, i: (i - 1) % 2 = 0), '') AS every_2nd,
       array_to_string(list_filter(string_split(p_name, ''), lambda x, i: i - 1 < 10 AND (i - 1) % 9 = 0), '') AS first_and_9th,
       array_to_string(list_filter(string_split(reverse(p_name), ''), lambda x, i: (i - 1) % 2 = 0), '') AS every_2nd_back,
       CAST(len(string_split(p_name, '')) AS INTEGER) AS n_chars
FROM part
""")
def char_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(
        "p_partkey",
        STR.py_step("p_name", 2).alias("every_2nd"),
        STR.py_step("p_name", 9, 0, 10).alias("first_and_9th"),
        STR.py_step("p_name", -2).alias("every_2nd_back"),
        F.size(STR.chars("p_name")).alias("n_chars"),
    )


@query("substring_count", "STR-4", """
SELECT p_partkey, CAST((length(p_name) - length(replace(p_name, 'r', ''))) // 1 AS INTEGER) AS n_r
FROM part
""")
def substring_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", STR.count_substring("p_name", "r").alias("n_r"))


@query("words_with_prefix", "FLT-5 STR-11 WIN-1", """
SELECT doc_id, pos, word FROM (
    SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word
    FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents))
WHERE starts_with(word, 's')
""")
def words_with_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # posexplode numbers every word of the whole text from 0 in the same task
    # that holds the row: no shuffle, no window.
    exploded = docs.select("doc_id", F.posexplode(STR.words("text")).alias("pos", "word"))
    return exploded.filter(F.col("word").startswith("s"))


@query("take_until", "FLT-7", """
SELECT p_partkey,
       CASE WHEN instr(p_name, 'm') > 0 THEN left(p_name, instr(p_name, 'm') - 1) ELSE p_name END AS before_m
FROM part
""")
def take_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", A.joined(A.take_until(STR.chars("p_name"), "m")).alias("before_m"))


@query("skip_value", "FLT-6", "SELECT p_partkey, replace(p_name, 'a', '') AS without_a FROM part")
def skip_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", A.joined(A.without(STR.chars("p_name"), "a")).alias("without_a"))


# ------------------------------------------------------------------ numbers


@query("divisible", "FLT-4", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE CAST(l_quantity AS INTEGER) % 3 = 0 AND CAST(l_quantity AS INTEGER) % 5 = 0
""")
def divisible(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The divisibility test IS the operator (multiples of 3 and 5); it runs over
    # the whole lineitem table and is not a way of sampling it.
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    return li.filter(N.divisible_by(F.col("l_quantity").cast("int"), 3, 5))


@query("column_arithmetic", "AGG-12 MTH-1 MTH-2", """
SELECT l_orderkey, l_linenumber,
       l_quantity + l_tax AS qty_plus_tax,
       CASE WHEN l_quantity % 2 = 0 THEN pow(l_quantity, 2) END AS even_qty_squared,
       l_extendedprice + l_extendedprice / 10 AS price_plus_10pct
FROM lineitem
""")
def column_arithmetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        "l_orderkey", "l_linenumber",
        N.add("l_quantity", "l_tax").alias("qty_plus_tax"),
        N.square_if_even("l_quantity").alias("even_qty_squared"),
        N.plus_ten_percent("l_extendedprice").alias("price_plus_10pct"),
    )


@query("labels_when", "MTH-4 MTH-5", """
SELECT p_partkey,
       CASE WHEN p_size > 10 THEN 'greater' WHEN p_size < 10 THEN 'less' ELSE 'equal' END AS vs_10,
       CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE 'ODD' END AS even_or_odd
FROM part
""")
def labels_when(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", N.compare_label("p_size", 10).alias("vs_10"),
                    N.even_or_odd_label("p_size").alias("even_or_odd"))


@query("seeded_int", "MTH-3", """
SELECT o_orderkey, CAST(('0x' || substr(md5(o_orderkey || '|42'), 1, 13))::BIGINT % 101 AS INTEGER) AS lucky_number
FROM orders
""")
def seeded_int(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", N.seeded_int("o_orderkey", 42).alias("lucky_number"))


# ------------------------------------------------------------------ arrays


@query("array_basics", "ARR-1 ARR-2 ARR-3 ARR-4 ARR-5 ARR-6 SET-3 SET-4 WIN-2 PRJ-12 AGG-9 AGG-10", """
SELECT p_partkey, p_name,
       array_to_string(list_transform(range(0, length(p_name), 3), lambda x: CAST(x AS VARCHAR)), ',') AS every_3rd_pos,
       string_split(p_name, '')[3] AS third_char,
       string_split(p_name, '')[-1] AS last_char,
       p_name || '!' AS appended,
       left(p_name, 2) || 'xy' AS tail_replaced,
       CAST(len(list_distinct(list_append(string_split(p_name, ''), 'z'))) AS INTEGER) AS n_set_plus_z,
       upper(p_name) AS mapped_upper,
       p_name || p_name AS concatenated,
       CAST(len(string_split(p_name, '')) * 3 AS INTEGER) AS repeated_3_len,
       CAST(list_position(string_split(p_name, ''), 'e') - 1 AS INTEGER) AS first_e,
       list_min(string_split(p_name, '')) AS min_char,
       list_max(string_split(p_name, '')) AS max_char,
       CAST(len(list_distinct(string_split(p_name, ''))) AS INTEGER) AS n_distinct_chars
FROM part
""")
def array_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("p_name", F.col("p_name"))  # PRJ-12
    cs = STR.chars("p_name")
    return p.select(
        "p_partkey", "p_name",
        F.concat_ws(",", A.map_each(A.py_range(F.lit(0), F.length("p_name"), F.lit(3)),
                                    lambda x: x.cast("string"))).alias("every_3rd_pos"),
        A.item(cs, 2).alias("third_char"),
        A.item(cs, -1).alias("last_char"),
        A.joined(A.append(cs, "!")).alias("appended"),
        A.joined(A.replace_tail(cs, 2, F.array(F.lit("x"), F.lit("y")))).alias("tail_replaced"),
        F.size(A.set_add(cs, "z")).alias("n_set_plus_z"),
        A.joined(A.map_each(cs, F.upper)).alias("mapped_upper"),
        A.joined(A.concat(cs, cs)).alias("concatenated"),
        F.size(A.repeat(cs, 3)).alias("repeated_3_len"),
        A.index_of(cs, "e").alias("first_e"),
        A.smallest(cs).alias("min_char"),
        A.largest(cs).alias("max_char"),
        F.size(A.distinct(cs)).alias("n_distinct_chars"),
    )


# ------------------------------------------------------------------ maps / JSON


@query("map_basics", "MAP-1 MAP-2 MAP-3 MAP-4", """
SELECT event_id,
       array_to_string(json_keys(props), ',') AS keys,
       CAST(props->>'$.k' AS INTEGER) AS k_value,
       CAST(len(json_keys(props)) AS INTEGER) AS n_entries,
       CAST(len(list_distinct(list_append(json_keys(props), 'seen'))) AS INTEGER) AS n_after_put,
       CAST(NULL AS INTEGER) AS missing_value,
       json_extract_string(props, '$.k') AS k_text
FROM events
""")
def map_basics(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Parse once into a column: every use below reads the parsed map instead of
    # re-running from_json (Catalyst keeps a projection whose expensive result
    # is used several times).
    e = table(spark, sf_dir, "events").select("event_id", "props").select(
        "event_id", "props", MP.parse_json_map("props").alias("m"))
    m = F.col("m")
    return e.select(
        "event_id",
        F.concat_ws(",", MP.keys(m)).alias("keys"),
        MP.lookup(m, "k").alias("k_value"),
        F.size(m).alias("n_entries"),
        F.size(MP.put(m, "seen", 1)).alias("n_after_put"),
        MP.lookup(m, "no_such_key").alias("missing_value"),
        MP.json_path("props", "$.k").alias("k_text"),
    )


@query("json_props", "JSN-1", """
SELECT event_type, CAST(sum(CAST(props->>'$.k' AS INTEGER)) AS BIGINT) AS k_total,
       count(*) AS n_events
FROM events GROUP BY event_type
""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_type", "props")
    m = MP.parse_json_map("props")
    return (e.groupBy("event_type")
             .agg(F.sum(MP.lookup(m, "k")).alias("k_total"), F.count(F.lit(1)).alias("n_events")))


# ------------------------------------------------------------------ dates


@query("date_labels", "DAT-1 DAT-2 DAT-3 DAT-4", """
SELECT o_orderkey,
       strftime(CAST(o_orderdate AS DATE), '%d-%b-%Y') AS order_label,
       CAST(o_orderdate AS DATE) - 1 AS previous_day,
       upper(strftime(CAST(o_orderdate AS DATE) - 1, '%d-%b-%Y')) AS previous_label,
       CAST(strptime(upper(strftime(CAST(o_orderdate AS DATE) - 1, '%d-%b-%Y')), '%d-%b-%Y') AS DATE) AS parsed_back
FROM orders
""")
def date_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", D.as_date("o_orderdate").alias("d"))
    prev = D.previous_day("d")
    return o.select(
        "o_orderkey",
        D.date_label("d").alias("order_label"),
        prev.alias("previous_day"),
        D.upper_label(prev).alias("previous_label"),
        D.parse_label(D.upper_label(prev)).alias("parsed_back"),
    )


# ------------------------------------------------------------------ ordering


@query("preview", "SNK-6", """
SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey LIMIT 20
""")
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return preview(table(spark, sf_dir, "part").select("p_partkey", "p_name"), 20, ["p_name", "p_partkey"])


@query("top_rows", "SRT-1", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
""")
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.top_rows(o, 5, [F.col("o_totalprice").desc(), F.col("o_orderkey")])


@query("sort_rows", "SRT-2", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey
""")
def sort_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.sort_rows(o, ["o_totalprice", "o_orderkey"])


@query("seeded_order", "SRT-4", """
SELECT o_orderkey, o_totalprice, ('0x' || substr(md5(o_orderkey || '|42'), 1, 13))::BIGINT AS order_key
FROM orders ORDER BY order_key, o_orderkey
""")
def seeded_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return O.seeded_order(o, "o_orderkey", 42, "order_key")


# ------------------------------------------------------------------ pairing


@query("positional_pairs", "JON-3 STR-11", """
SELECT doc_id, CAST(len(w) - 1 AS INTEGER) AS n_pairs,
       CAST(len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) AS INTEGER) AS n_repeats
FROM (SELECT doc_id, string_split(text, ' ') AS w FROM documents)
""")
def positional_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").select(
        "doc_id", STR.words("text").alias("w"))
    # Each word paired with the next one over the whole text: zip with the
    # array shifted by one, shortest wins.
    # Bound to a column once, so the zip is built once per row and not once per use.
    pairs = docs.select("doc_id", J.zip_shortest(F.col("w"), F.slice("w", 2, F.size("w"))).alias("p"))
    return pairs.select(
        "doc_id",
        F.size("p").alias("n_pairs"),
        F.size(F.filter("p", lambda p: p["_0"] == p["_1"])).alias("n_repeats"),
    )


@query("all_pairs", "JON-2", """
SELECT l_orderkey, l_linenumber,
       l_quantity * (1 - l_discount) AS p0, l_quantity * (1 + l_tax) AS p1,
       l_extendedprice * (1 - l_discount) AS p2, l_extendedprice * (1 + l_tax) AS p3
FROM lineitem
""")
def all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    prods = J.pairs_product(F.array("l_quantity", "l_extendedprice"),
                            F.array(1 - F.col("l_discount"), 1 + F.col("l_tax")))
    return li.select("l_orderkey", "l_linenumber",
                     *[prods[i].alias(f"p{i}") for i in range(4)])
