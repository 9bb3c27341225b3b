"""Queries over JSON and XML texts, conversations and hierarchies."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakeops.operators.ordering import with_neighbours
from lakeops.operators.recursive import fixpoint, follow_links
from lakeops.plans.tables import table
from lakeops.sources import nested


def json_props(spark, folder):
    """Properties of events, some cut off in the middle, by a schema merged from all of them."""
    cut = F.when(F.col("event_id") % 50 == 0, F.substring("props", 1, 5)).otherwise(F.col("props"))
    parsed = nested.parse_json(table(spark, folder, "events").select("event_id", cut.alias("text")), "text")
    return nested.flatten_structs(parsed.drop("text"))


def _line_items(spark, folder):
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", F.struct(F.col("l_linenumber").alias("line"), F.col("l_returnflag").alias("flag"),
                               F.array("l_partkey", "l_suppkey").alias("codes")).alias("item"))
    return items.groupBy("l_orderkey").agg(F.array_sort(F.collect_list("item")).alias("items"))


def json_explode(spark, folder):
    """Orders as JSON texts with nested arrays, a few of them broken, opened to a row per code of an item."""
    text = F.to_json(F.struct(F.col("l_orderkey").alias("id"), F.struct("items").alias("basket")))
    broken = F.when(F.col("l_orderkey") % 97 == 0, F.substring(text, 1, 30)).otherwise(text)
    parsed = nested.parse_json(_line_items(spark, folder).select(broken.alias("text")), "text")
    rows = nested.explode_path(parsed.select(F.col("parsed.id").alias("id"), "parsed"),
                               ["parsed", "basket", "items"], ["id"])
    codes = nested.explode_path(rows, ["items", "codes"], ["id", "items_pos"])
    return codes


def xml_explode(spark, folder):
    """The same orders as XML texts, opened to a row per item."""
    items = F.array_join(F.transform("items", lambda i: F.format_string(
        '<item line="%d"><flag>%s</flag></item>', i["line"], i["flag"])), "")
    text = F.concat(F.lit('<order id="'), F.col("l_orderkey").cast("string"), F.lit('">'), items, F.lit("</order>"))
    broken = F.when(F.col("l_orderkey") % 97 == 0, F.substring(text, 1, 30)).otherwise(text)
    schema = StructType.fromDDL("_id BIGINT, item ARRAY<STRUCT<_line: INT, flag: STRING>>")
    parsed = nested.parse_xml(_line_items(spark, folder).select(broken.alias("text")), "text", schema)
    rows = nested.explode_path(parsed.select(F.col("parsed._id").alias("id"), "parsed"), ["parsed", "item"], ["id"])
    return nested.flatten_structs(rows)


def recursive_turns(spark, folder):
    """Every turn of a conversation followed back to the first one, by links to the turn before."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn")
    linked = with_neighbours(turns, ["conv_id"], [F.col("turn")], previous={"before": F.col("turn")})
    links = linked.select(F.struct("conv_id", "turn").alias("node"), F.when(F.col("before").isNotNull(), F.struct(
        "conv_id", F.col("before").alias("turn"))).alias("next"))
    return follow_links(links, "node", "next").select(
        "node.conv_id", "node.turn", F.col("root.turn").alias("first_turn"), "steps", "cyclic")


def recursive_ancestors(spark, folder):
    """All suppliers above each one, where a supplier reports to the one with half its number."""
    suppliers = table(spark, folder, "supplier").select("s_suppkey")
    above = F.floor(F.col("s_suppkey") / 2)
    reports = suppliers.filter("s_suppkey > 0").select("s_suppkey", above.alias("above"))
    steps = reports.select(F.col("s_suppkey").alias("at"), F.col("above").alias("higher"))
    return fixpoint(reports, lambda fresh: fresh.join(steps, F.col("above") == F.col("at")).select(
        "s_suppkey", F.col("higher").alias("above")))


QUERIES = {f.__name__: f for f in (json_props, json_explode, xml_explode, recursive_turns, recursive_ancestors)}

_TEXTS = """
    SELECT CASE WHEN l_orderkey % 97 = 0 THEN substr(text, 1, 30) ELSE text END AS text
    FROM (SELECT l_orderkey, to_json({'id': l_orderkey, 'basket': {'items': list({
                     'line': l_linenumber, 'flag': l_returnflag, 'codes': [l_partkey, l_suppkey]}
                     ORDER BY l_linenumber, l_returnflag, l_partkey, l_suppkey)}})::VARCHAR AS text
          FROM lineitem GROUP BY l_orderkey)"""

ORACLES = {
    "recursive_turns": """
        WITH RECURSIVE links AS (
            SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM conversations),
        walk AS (
            SELECT conv_id, turn, turn AS first_turn, CAST(0 AS BIGINT) AS steps FROM conversations
            UNION ALL SELECT w.conv_id, w.turn, l.before, w.steps + 1
            FROM walk w JOIN links l ON l.conv_id = w.conv_id AND l.turn = w.first_turn WHERE l.before IS NOT NULL)
        SELECT conv_id, turn, arg_max(first_turn, steps) AS first_turn, max(steps) AS steps, FALSE AS cyclic
        FROM walk GROUP BY conv_id, turn""",
    "recursive_ancestors": """
        WITH RECURSIVE up AS (
            SELECT s_suppkey, s_suppkey // 2 AS above FROM supplier WHERE s_suppkey > 0
            UNION SELECT s_suppkey, above // 2 FROM up WHERE above > 0)
        SELECT s_suppkey, above FROM up""",
    "json_props": """
        SELECT event_id, CASE WHEN json_valid(text) THEN CAST(json_extract(text, '$.k') AS BIGINT) END AS parsed_k,
               CASE WHEN NOT json_valid(text) THEN text END AS malformed
        FROM (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN substr(props, 1, 5) ELSE props END AS text FROM events)""",
    "json_explode": f"""
        SELECT id, items_pos, codes_pos, CAST(json_extract(codes, '$[' || codes_pos || ']') AS BIGINT) AS codes
        FROM (SELECT id, items_pos, json_extract(item, '$.codes') AS codes,
                     unnest(range(json_array_length(json_extract(item, '$.codes'))::BIGINT)::INT[]) AS codes_pos
              FROM (SELECT CAST(json_extract(text, '$.id') AS BIGINT) AS id,
                           unnest(json_extract(text, '$.basket.items[*]')) AS item,
                           unnest(range(json_array_length(json_extract(text, '$.basket.items'))::BIGINT)::INT[]) AS items_pos
                    FROM ({_TEXTS}) WHERE json_valid(text)))""",
    "xml_explode": """
        SELECT l_orderkey AS id, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_returnflag,
                   l_partkey, l_suppkey) - 1 AS INTEGER) AS item_pos, l_linenumber AS item__line, l_returnflag AS item_flag
        FROM lineitem WHERE l_orderkey % 97 <> 0""",
}
