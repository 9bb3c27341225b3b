"""Queries over projections, filters, flags, cleaning, joins and row expansion."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeops.functions import flags, text
from lakeops.functions.arrays import int_range_udf
from lakeops.functions.similarity import token_similarity as score_udf, token_similarity_native as score_native
from lakeops.operators import expand, joins, ordering
from lakeops.operators.filters import filter_table
from lakeops.plans.tables import ACCOUNTS_SQL, DIRTY_ORDERS_SQL, accounts, dirty_orders, table

URGENT = ["1-URGENT", "2-HIGH"]
CLOSED = ["F"]


def filter_cmp(spark, folder):
    return accounts(spark, folder).filter(F.col("c_acctbal") <= 50)


def filter_param(spark, folder):
    accounts(spark, folder).createOrReplaceTempView("lakeops_accounts")
    return filter_table(spark, "lakeops_accounts", "c_acctbal", "<=", 50)


def filter_eq(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_custkey") == 77).select("o_orderkey", "o_custkey")


def filter_isin(spark, folder):
    return table(spark, folder, "orders").filter(F.col("o_custkey").isin([1, 20, 77, 140])).select(
        "o_orderkey", "o_custkey")


def _with_null_priority(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        "o_orderstatus")


def case_flag_df(spark, folder):
    return _with_null_priority(spark, folder).select(
        "o_orderkey", flags.flag_in(F.col("o_orderpriority"), URGENT).alias("urgent"),
        flags.flag_in(F.col("o_orderstatus"), CLOSED).alias("closed"))


def case_flag_sql(spark, folder):
    _with_null_priority(spark, folder).createOrReplaceTempView("lakeops_orders")
    return flags.flag_in_sql(spark, "lakeops_orders", {
        "urgent": ("o_orderpriority", URGENT), "closed": ("o_orderstatus", CLOSED)}, keep=("o_orderkey",))


def case_flag_expr(spark, folder):
    return _with_null_priority(spark, folder).selectExpr(
        "o_orderkey", flags.flag_in_expr("o_orderpriority", URGENT, "urgent"),
        flags.flag_in_expr("o_orderstatus", CLOSED, "closed"))


def strip_prefix(spark, folder):
    return dirty_orders(spark, folder).select(
        "o_orderkey", text.strip_pattern(F.col("o_orderpriority")).alias("without_prefix"),
        text.strip_pattern(F.col("o_orderpriority"), text.PREFIX_OR_LESS_THAN).alias("without_both"))


def money_to_double(spark, folder):
    return dirty_orders(spark, folder).select(
        "o_orderkey", text.money_to_double(F.col("o_totalprice")).alias("o_totalprice"))


def clean_table(spark, folder):
    return text.clean_columns(dirty_orders(spark, folder), {"o_orderpriority": text.PREFIX_OR_LESS_THAN},
                              ["o_totalprice"])


def view_rank(spark, folder):
    ranked = ordering.rank_by(accounts(spark, folder), ["c_mktsegment"], "c_acctbal", name="position")
    ranked.createOrReplaceTempView("lakeops_ranked")
    return spark.table("lakeops_ranked")


def row_number_by_group(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    return ordering.row_number_by(orders, ["o_orderpriority"],
                                  [F.col("o_totalprice").desc(), F.col("o_orderkey")])


def row_id_stable(spark, folder):
    return ordering.stable_row_id(table(spark, folder, "orders").select("o_orderkey"), ["o_orderkey"])


def self_join_inner(spark, folder):
    customer = table(spark, folder, "customer").select("c_custkey", "c_name", "c_acctbal")
    return joins.join_on_key(customer, customer, ["c_custkey"])


def join_diff_keys(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = table(spark, folder, "customer").select("c_custkey", "c_name")
    return joins.join_on_different_keys(orders, customer, "o_custkey", "c_custkey")


def explode_range(spark, folder):
    return expand.explode_range(table(spark, folder, "supplier").select("s_suppkey"), 10)


def explode_range_udf(spark, folder):
    return table(spark, folder, "supplier").select("s_suppkey", F.explode(int_range_udf(F.lit(10))).alias("exploded"))


def duplicate_rows(spark, folder):
    supplier = table(spark, folder, "supplier").select("s_suppkey", "s_acctbal")
    return expand.duplicate_rows(supplier, 1000, "s_suppkey")


def padded_name(spark, folder):
    return table(spark, folder, "supplier").select(
        "s_suppkey", text.padded_name("group_", F.col("s_suppkey")).alias("group_name"))


def scale_expression(spark, folder):
    return accounts(spark, folder).select("c_custkey", text.scale(F.col("c_acctbal"), 2.0).alias("doubled"))


def format_timestamp(spark, folder):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    return table(spark, folder, "events").select(
        "event_id", text.format_time(F.col("ts")).alias("written"),
        text.elapsed_seconds(start, F.col("ts")).alias("elapsed"))


def _text_pairs(spark, folder):
    return table(spark, folder, "part").select(
        "p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("sequence_1"),
        F.concat_ws(" / ", "p_brand", F.upper("p_name")).alias("sequence_2"))


def token_similarity(spark, folder):
    return _text_pairs(spark, folder).select(
        "p_partkey", score_udf(F.col("sequence_1"), F.col("sequence_2")).alias("similarity"))


def token_similarity_native(spark, folder):
    return _text_pairs(spark, folder).select(
        "p_partkey", score_native(F.col("sequence_1"), F.col("sequence_2")).alias("similarity"))


def token_similarity_turns(spark, folder):
    """Every turn of a conversation against the next one, whole texts."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    following = turns.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("next_text"))
    return turns.join(following, ["conv_id", "turn"]).select(
        "conv_id", "turn", score_udf(F.col("text"), F.col("next_text")).alias("similarity"))


def token_similarity_reversed(spark, folder):
    """Every whole turn against its own words in reverse, and against a text that shares no letter with any word."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "text")
    backwards = F.array_join(F.reverse(F.split("text", " ")), " ")
    return turns.select("conv_id", "turn", score_udf(F.col("text"), backwards).alias("same_words"),
                        score_udf(F.col("text"), F.lit("\u0416")).alias("no_letters"))


QUERIES = {f.__name__: f for f in (
    filter_cmp, filter_param, filter_eq, filter_isin, case_flag_df, case_flag_sql, case_flag_expr, strip_prefix,
    money_to_double, clean_table, view_rank, row_number_by_group, row_id_stable, self_join_inner, join_diff_keys,
    explode_range, explode_range_udf, duplicate_rows, padded_name, scale_expression, format_timestamp,
    token_similarity, token_similarity_native, token_similarity_turns,
    token_similarity_reversed)}

_FLAGS = """
    SELECT o_orderkey, CASE WHEN o_orderkey % 9 <> 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END
               AS urgent,
           CASE WHEN o_orderstatus IN ('F') THEN 1 ELSE 0 END AS closed
    FROM orders"""
_FILTERED = f"SELECT * FROM ({ACCOUNTS_SQL}) WHERE c_acctbal <= 50"
_RANGE = """
    SELECT s_suppkey, CAST(unnest(range(10)) AS INTEGER) AS exploded FROM supplier"""

# The three strings to compare: common tokens, and common tokens followed by either side's rest.
_TOKENS = """
    pairs AS (
        SELECT p_partkey, p_name || ' ' || p_type AS one, p_brand || ' / ' || upper(p_name) AS two FROM part),
    token_sets AS (
        SELECT p_partkey,
               list_sort(list_distinct(list_filter(string_split_regex(lower(one), '[^a-z0-9]+'), lambda w: w <> ''))) AS a,
               list_sort(list_distinct(list_filter(string_split_regex(lower(two), '[^a-z0-9]+'), lambda w: w <> ''))) AS b
        FROM pairs),
    strings AS (
        SELECT p_partkey, array_to_string(list_filter(a, lambda w: list_contains(b, w)), ' ') AS common,
               array_to_string(list_filter(a, lambda w: NOT list_contains(b, w)), ' ') AS rest_a,
               array_to_string(list_filter(b, lambda w: NOT list_contains(a, w)), ' ') AS rest_b
        FROM token_sets),
    sides AS (
        SELECT p_partkey, common, trim(common || ' ' || rest_a) AS full_a, trim(common || ' ' || rest_b) AS full_b
        FROM strings),
    compared AS (
        SELECT p_partkey, common AS x, full_a AS y FROM sides
        UNION ALL SELECT p_partkey, common, full_b FROM sides
        UNION ALL SELECT p_partkey, full_a, full_b FROM sides)"""
# Longest common subsequence with one bit per character of x; the texts are under 60 characters.
_LCS = """
    length(x) - bit_count(list_reduce(
        string_split(y, ''),
        lambda open_bits, ch: ((open_bits + (open_bits & m[ch])) | (open_bits - (open_bits & m[ch])))
                           & ((1::BIGINT << length(x)) - 1),
        (1::BIGINT << length(x)) - 1))"""

ORACLES = {
    "filter_cmp": _FILTERED,
    "filter_param": _FILTERED,
    "filter_eq": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey = 77",
    "filter_isin": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (1, 20, 77, 140)",
    "case_flag_df": _FLAGS,
    "case_flag_sql": _FLAGS,
    "case_flag_expr": _FLAGS,
    "strip_prefix": f"""
        SELECT o_orderkey, regexp_replace(o_orderpriority, 'z_', '', 'g') AS without_prefix,
               regexp_replace(o_orderpriority, 'z_|<', '', 'g') AS without_both
        FROM ({DIRTY_ORDERS_SQL})""",
    "money_to_double": f"""
        SELECT o_orderkey, TRY_CAST(regexp_replace(o_totalprice, '[$,]', '', 'g') AS DOUBLE) AS o_totalprice
        FROM ({DIRTY_ORDERS_SQL})""",
    "clean_table": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate,
               regexp_replace(o_orderpriority, 'z_|<', '', 'g') AS o_orderpriority,
               TRY_CAST(regexp_replace(o_totalprice, '[$,]', '', 'g') AS DOUBLE) AS o_totalprice
        FROM ({DIRTY_ORDERS_SQL})""",
    "view_rank": f"""
        SELECT *, rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal DESC NULLS LAST) AS position
        FROM ({ACCOUNTS_SQL})""",
    "row_number_by_group": """
        SELECT o_orderkey, o_orderpriority, o_totalprice,
               row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS row_number
        FROM orders""",
    "row_id_stable": "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS id FROM orders",
    "self_join_inner": """
        SELECT l.c_custkey, l.c_name, l.c_acctbal, r.c_name AS c_name_right, r.c_acctbal AS c_acctbal_right
        FROM customer l JOIN customer r ON l.c_custkey = r.c_custkey""",
    "join_diff_keys": """
        SELECT o_orderkey, o_custkey, o_totalprice, c_custkey, c_name
        FROM orders JOIN customer ON o_custkey = c_custkey""",
    "explode_range": _RANGE,
    "explode_range_udf": _RANGE,
    "duplicate_rows": """
        SELECT s_suppkey, s_acctbal, exploded, s_suppkey || '_' || exploded AS "DISTINCT_ID"
        FROM (SELECT s_suppkey, s_acctbal, CAST(unnest(range(1000)) AS INTEGER) AS exploded FROM supplier)""",
    "padded_name": """
        SELECT s_suppkey, 'group_' || lpad(CAST(s_suppkey AS VARCHAR),
                                           CAST(greatest(length(CAST(s_suppkey AS VARCHAR)), 2) AS INTEGER), '0')
                          AS group_name
        FROM supplier""",
    "scale_expression": f"SELECT c_custkey, c_acctbal * 2.0::DOUBLE AS doubled FROM ({ACCOUNTS_SQL})",
    "format_timestamp": """
        SELECT event_id, strftime(ts, '%d-%b-%Y (%H:%M:%S.%f)') AS written,
               round((epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01 00:00:00')) / 1e6, 1) AS elapsed
        FROM events""",
    "token_similarity": f"""
        WITH {_TOKENS},
        masked AS (
            SELECT p_partkey, x, y, map_from_entries(list_transform(
                       list_distinct(string_split(y, '')),
                       lambda ch: {{'k': ch, 'v': coalesce(CAST(list_sum(list_transform(
                           list_filter(range(1, length(x) + 1), lambda i: x[i] = ch),
                           lambda i: 1::BIGINT << (i - 1))) AS BIGINT), 0)}})) AS m
            FROM compared),
        scored AS (
            SELECT p_partkey, CASE WHEN x = '' OR y = '' THEN 0
                                   ELSE round_even(100 * 2 * ({_LCS}) / (length(x) + length(y)), 0) END AS score
            FROM masked)
        SELECT p_partkey, CAST(max(score) AS INTEGER) AS similarity FROM scored GROUP BY p_partkey""",
    "token_similarity_native": f"""
        WITH {_TOKENS},
        scored AS (
            SELECT p_partkey,
                   CASE WHEN x = '' OR y = '' THEN 0
                        ELSE round(100.0::DOUBLE * (greatest(length(x), length(y)) - levenshtein(x, y))
                                   / greatest(length(x), length(y))) END AS score
            FROM compared)
        SELECT p_partkey, CAST(max(score) AS INTEGER) AS similarity FROM scored GROUP BY p_partkey""",
    "token_similarity_reversed": """
        SELECT conv_id, turn, CASE WHEN regexp_matches(regexp_replace(text, '[\u0080-\u00ff]', '', 'g'), '[\\pL\\pN_]')
                                   THEN 100 ELSE 0 END AS same_words, 0 AS no_letters
        FROM conversations""",
}
