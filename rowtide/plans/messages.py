"""Queries over message rows."""

from pyspark.sql import functions as F

from rowtide.operators.ddl import alter_feed
from rowtide.operators.messages import ddl_messages, messages
from rowtide.operators.normalize import deliver, normalize_events
from rowtide.plans import feeds
from rowtide.plans.feed import ALTERS, TX, query
from rowtide.plans.sql import quoted, user_json, with_feeds
from rowtide.plans.values import LINE_JSON, LINE_XML

TOPIC = "all"


def user_events(spark, sf_dir):
    return normalize_events(deliver(feeds.user_state(spark, sf_dir)))


def line_events(spark, sf_dir):
    return normalize_events(deliver(feeds.lineitem_feed(spark, sf_dir)))


def order_events(spark, sf_dir):
    return normalize_events(deliver(feeds.orders_snapshot(spark, sf_dir)))


def _head(tb, event, file="sent_file", pos="sent_pos", time="sent_time", db="shop"):
    return (f"'{{\"sid\":11,\"dbname\":\"{db}\",\"tbname\":\"{tb}\",\"filename\":\"' || {file} || '\",\"position\":' || "
            f"{pos} || ',\"event_time\":' || {time} || ',\"event\":\"' || {event} || '\",\"columns\":['")


USER_MESSAGE = (_head("user_state", "kind") + f" || {user_json()} || CASE WHEN kind = 'update' THEN ',' || "
                + user_json("b_") + " ELSE '' END || ']}'")
USER_IMAGES = f"{user_json()} || ',' || {user_json('b_')}"

# Events of an order here have 64 rows at most and come as one early or late chunk.
LINE_TX = """
lt AS (SELECT l_orderkey, event_ord, any_value(file) AS file, any_value(pos) AS pos, any_value(t) AS t,
              string_agg({line}, '{sep}' ORDER BY row_ord) AS columns FROM c GROUP BY ALL),
lt2 AS (SELECT *, (event_ord - 1) // 9 < count(*) OVER (PARTITION BY l_orderkey) // 9 AS early FROM lt),
ls AS (SELECT *, CASE WHEN early THEN '' ELSE file END AS sent_file, CASE WHEN early THEN 0 ELSE pos END AS sent_pos,
              CASE WHEN early AND event_ord % 9 = 0 THEN 0 ELSE t END AS sent_time FROM lt2)"""


@query("messages_json_event", with_feeds("a", f"""
SELECT 'all' AS topic, NULL AS key, {USER_MESSAGE} AS value FROM sent""", TX))
def messages_json_event(spark, sf_dir):
    """One JSON message per event; early chunks have no position."""
    return messages(user_events(spark, sf_dir), feeds.rules(spark, 1, 2), TOPIC).select("topic", "key", "value")


@query("messages_json_rows", with_feeds("c", f"""
SELECT {_head("lineitem", "'insert'")} || columns || ']}}' AS value FROM ls""", LINE_TX.format(line=LINE_JSON, sep=",")))
def messages_json_rows(spark, sf_dir):
    """One JSON message per event with all its rows, published columns only."""
    return messages(line_events(spark, sf_dir), feeds.rules(spark, 9), TOPIC).select("value")


@query("messages_image_order", with_feeds("a", f"""
SELECT file, pos, {USER_IMAGES} AS images FROM a WHERE kind = 'update'"""))
def messages_image_order(spark, sf_dir):
    """New image first, then the old one it replaces."""
    from rowtide.functions.text import image_json
    from rowtide.operators.messages import images_in_order
    events = normalize_events(feeds.user_state(spark, sf_dir)).where(F.col("event") == "update")
    return events.selectExpr(
        "file", "pos", f"array_join(transform({images_in_order()}, i -> {image_json('i')}), ',') AS images")


ORDER_JSON = ("'{\"o_custkey\":' || o_custkey || ',\"o_orderkey\":' || o_orderkey || ',\"o_orderpriority\":\"' || "
              "o_orderpriority || '\",\"o_orderstatus\":\"' || o_orderstatus || '\",\"price_cents\":' || price_cents || '}'")


@query("messages_row_split", with_feeds("b", f"""
SELECT {_head("orders", "'insert'", "''", "0", "0")} || {ORDER_JSON} || ']}}' AS value FROM b"""))
def messages_row_split(spark, sf_dir):
    """A table with key columns or a topic rule: one message per row."""
    return messages(order_events(spark, sf_dir), feeds.rules(spark, 7, 8), TOPIC).select("value")


@query("messages_split_updates", with_feeds("a", f"""
SELECT user_id::VARCHAR AS key, {USER_MESSAGE} AS value FROM sent""", TX))
def messages_split_updates(spark, sf_dir):
    """Row messages of updates keep the pair of images."""
    rules = feeds.rules_df(spark, [dict(id=41, sid=feeds.SID, db="shop", tb="user_state",
                                        message_key_columns="user_id")])
    return messages(user_events(spark, sf_dir), rules, TOPIC).select("key", "value")


@query("messages_topic", with_feeds("b", """
SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 'urgent' WHEN '2-HIGH' THEN 'high' ELSE 'all' END AS topic,
       count(*) AS n FROM b GROUP BY ALL"""))
def messages_topic(spark, sf_dir):
    rows = messages(order_events(spark, sf_dir), feeds.rules(spark, 7, 8), TOPIC)
    return rows.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


@query("messages_key", with_feeds("b", """
SELECT o_orderkey, o_custkey || ':' || o_orderkey AS key FROM b"""))
def messages_key(spark, sf_dir):
    rows = messages(order_events(spark, sf_dir), feeds.rules(spark, 7, 8), TOPIC)
    return rows.select(F.col("event_ord").alias("o_orderkey"), "key")


@query("messages_ddl", with_feeds("d", f"""
SELECT 'all' AS topic, '{{"sid":11,"dbname":"shop","tbname":"","filename":"' || file || '","position":' || pos ||
  ',"event_time":0,"event":"query","query":' || {quoted("query")} || ',"columns":[]}}' AS value FROM alters""",
                                  f"alters AS ({ALTERS})"))
def messages_ddl(spark, sf_dir):
    return ddl_messages(alter_feed(feeds.statements(spark, sf_dir), feeds.rules(spark)), TOPIC).select(
        "topic", "value")


def _xml(tb, event, columns, file="sent_file", pos="sent_pos", time="sent_time"):
    return (f"'<contenet><sid>11</sid><dbname>shop</dbname><tbname>{tb}</tbname><filename>' || {file} || "
            f"'</filename><position>' || {pos} || '</position><event_time>' || {time} || '</event_time><event>' || "
            f"{event} || '</event>' || {columns} || '</contenet>'")


def _user_xml(p=""):
    text = f"{p}props"
    for old, new in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&#34;"), ("''", "&#39;")]:
        text = f"replace({text}, '{old}', '{new}')"
    return (f"'<columns><column name=\"user_id\">' || user_id || '</column><column name=\"status\">' || {p}status || "
            f"'</column><column name=\"cents\">' || {p}cents || '</column><column name=\"props\">' || {text} || "
            f"'</column></columns>'")


@query("messages_xml", with_feeds("a", f"""
SELECT {_xml("user_state", "kind",
             f"{_user_xml()} || CASE WHEN kind = 'update' THEN {_user_xml('b_')} ELSE '' END")} AS value FROM sent""", TX))
def messages_xml(spark, sf_dir):
    return messages(user_events(spark, sf_dir), feeds.rules(spark, 1, 2), TOPIC, fmt="xml").select("value")


@query("messages_xml_rows", with_feeds("c", f"""
SELECT {_xml("lineitem", "'insert'", "columns")} AS value FROM ls""", LINE_TX.format(line=LINE_XML, sep="")))
def messages_xml_rows(spark, sf_dir):
    """Published columns in the order of the rule's list."""
    return messages(line_events(spark, sf_dir), feeds.rules(spark, 9), TOPIC, fmt="xml").select("value")
