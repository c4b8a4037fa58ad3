"""Queries over fan-out, filters, projections, keys, payloads and codecs."""

from pyspark.sql import functions as F

from rowtide.functions.codec import compress, decompress
from rowtide.functions.text import cell_json, cell_text, cells_of, image_json, image_xml
from rowtide.operators import commands as cmd
from rowtide.operators.messages import images_in_order
from rowtide.operators.normalize import normalize_events, to_changes
from rowtide.operators.rules import message_plan
from rowtide.functions.joins import join_control
from rowtide.plans import feeds
from rowtide.plans.feed import columns_of, query, user_changes
from rowtide.plans.sql import quoted, user_json, with_feeds


def order_changes(spark, sf_dir):
    return to_changes(normalize_events(feeds.orders_snapshot(spark, sf_dir)))


@query("cell_text", """
SELECT event_id, 'i' || CASE WHEN event_type = 'error' THEN '<nil>' ELSE user_id::VARCHAR END AS as_int,
       CASE WHEN event_type = 'error' THEN '<nil>' ELSE props END AS as_text,
       CASE WHEN event_type = 'error' THEN '<nil>'
            ELSE regexp_replace(regexp_replace(printf('%.2f', value), '0+$', ''), '\\.$', '') END AS as_float,
       CASE WHEN event_type = 'error' THEN 'null'
            ELSE regexp_replace(regexp_replace(printf('%.2f', value), '0+$', ''), '\\.$', '') END AS json_float,
       CASE WHEN event_type = 'error' THEN 'null' ELSE """ + quoted("props") + """ END AS json_text
FROM events""")
def cell_texts(spark, sf_dir):
    """Texts of integer, string and float cells, errors standing for NULL."""
    ev = feeds.table(spark, sf_dir, "events")
    known = F.col("event_type") != "error"

    def cell(kind, col):
        return F.struct(F.lit("c").alias("name"), F.lit(kind).alias("type"),
                        F.when(known, F.col(col).cast("string")).alias("value"))
    cells = ev.select("event_id", cell("int", "user_id").alias("i"), cell("string", "props").alias("s"),
                      cell("float", "value").alias("f"))
    return cells.select(
        "event_id", F.expr(f"concat('i', {cell_text('i')})").alias("as_int"),
        F.expr(cell_text("s")).alias("as_text"), F.expr(cell_text("f")).alias("as_float"),
        F.expr(cell_json("f")).alias("json_float"), F.expr(cell_json("s")).alias("json_text"))


@query("rule_fanout", with_feeds("ab", """
SELECT rule_id, tb, count(*) AS n FROM (
  SELECT unnest([1, 2, 3, 4, 5, 6, 12]) AS rule_id, 'user_state' AS tb FROM a
  UNION ALL SELECT unnest([7, 8]), 'orders' FROM b) GROUP BY ALL"""))
def rule_fanout(spark, sf_dir):
    both = user_changes(spark, sf_dir).unionByName(order_changes(spark, sf_dir))
    return (cmd.fan_out(both, feeds.rules(spark)).groupBy(F.col("rule_id"), "tb")
            .agg(F.count(F.lit(1)).alias("n")))


@query("filtered_rows", with_feeds("b", """
SELECT o_orderkey::VARCHAR AS o_orderkey, o_orderstatus FROM b WHERE o_orderstatus = 'F'"""))
def filtered_rows(spark, sf_dir):
    df = cmd.fan_out(order_changes(spark, sf_dir), feeds.rules(spark, 8))
    return df.where(cmd.passes("after")).select(*columns_of("after", ["o_orderkey", "o_orderstatus"]))


# Filters that show the reading order of clauses.
FILTERS = [" o_orderstatus = F , o_orderpriority = 1-URGENT ", "nosuch=1,o_orderstatus=O",
           "o_orderstatus=P,broken,o_orderpriority=none", "broken,o_orderstatus=none", " "]


@query("filter_clauses", with_feeds("b", """
SELECT 101 AS rule_id, count(*) AS n FROM b WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'
UNION ALL SELECT 102, count(*) FROM b WHERE o_orderstatus = 'O'
UNION ALL SELECT 103, count(*) FROM b WHERE o_orderstatus = 'P'
UNION ALL SELECT 104, count(*) FROM b
UNION ALL SELECT 105, count(*) FROM b"""))
def filter_clauses(spark, sf_dir):
    """Trimmed parts, absent columns, and malformed clauses."""
    rules = feeds.rules_df(spark, [
        dict(id=101 + i, sid=feeds.SID, db="shop", tb="orders", target_key_type="string",
             target_key_prefix=f"f{i}", filter_rule=text) for i, text in enumerate(FILTERS)])
    df = cmd.fan_out(order_changes(spark, sf_dir), rules)
    return (df.where(cmd.passes("after"))
            .groupBy("rule_id").agg(F.count(F.lit(1)).alias("n")))


@query("projected_rows", with_feeds("a", """
SELECT 2 AS rule_id, file, pos, 'user_id,status' AS names FROM a
UNION ALL SELECT 1, file, pos, 'user_id,status,cents,props' FROM a"""))
def projected_rows(spark, sf_dir):
    df = cmd.fan_out(user_changes(spark, sf_dir), feeds.rules(spark, 1, 2))
    return df.selectExpr("rule_id", "file", "pos", f"""array_join(CASE WHEN kept_names IS NULL
      THEN after ELSE {cells_of('after', 'kept_names')} END.name, ',') AS names""")


LINE_JSON = "'{\"l_linenumber\":' || l_linenumber || ',\"l_partkey\":' || l_partkey || ',\"qty\":' || qty || '}'"
LINE_XML = ("'<columns><column name=\"qty\">' || qty || '</column><column name=\"l_partkey\">' || l_partkey || "
            "'</column><column name=\"l_linenumber\">' || l_linenumber || '</column></columns>'")


@query("message_projection", with_feeds("c", f"""
SELECT l_orderkey, event_ord, string_agg({LINE_JSON}, ',' ORDER BY row_ord) AS json_columns,
       string_agg({LINE_XML}, '' ORDER BY row_ord) AS xml_columns FROM c GROUP BY ALL"""))
def message_projection(spark, sf_dir):
    """Published columns: name order in JSON, list order in XML."""
    events = normalize_events(feeds.lineitem_feed(spark, sf_dir))
    df = join_control(events, message_plan(feeds.rules(spark)), ["sid", "db", "tb"])
    images = images_in_order()
    return df.selectExpr(
        "tx_id AS l_orderkey", "event_ord",
        f"array_join(transform({images}, i -> {image_json('i', 'json_names', heads='json_heads')}), ',') AS json_columns",
        f"array_join(transform({images}, i -> {image_xml('i', 'kept_names', heads='xml_heads')}), '') AS xml_columns")


@query("target_keys", with_feeds("ab", """
SELECT 1 AS rule_id, file, pos, 'us:' || user_id AS target_key FROM a
UNION ALL SELECT 5, file, pos, 'bystatus:' || status || ':' || user_id FROM a
UNION ALL SELECT 3, file, pos, 'active' FROM a
UNION ALL SELECT 8, '', o_orderkey, 'cust:' || o_custkey || ':' || o_orderkey FROM b"""))
def target_keys(spark, sf_dir):
    users = cmd.fan_out(user_changes(spark, sf_dir), feeds.rules(spark, 1, 3, 5))
    orders = cmd.fan_out(order_changes(spark, sf_dir).withColumn("pos", F.col("event_ord")),
                         feeds.rules(spark, 8))
    both = users.unionByName(orders)
    return both.select("rule_id", "file", "pos", F.expr(cmd.target_key("after")).alias("target_key"))


@query("json_payload", with_feeds("a", f"""
SELECT event_id // 1000 AS f, pos, {user_json()} AS payload FROM a
UNION ALL SELECT -1, page_id, '{{"html":' || {quoted('html')} || ',"page_id":' || page_id || ',"url":'
  || {quoted('url')} || '}}' FROM pages"""))
def json_payload(spark, sf_dir):
    users = cmd.fan_out(user_changes(spark, sf_dir), feeds.rules(spark, 1)).withColumn(
        "f", F.substr(F.col("file"), F.lit(5)).cast("bigint"))
    pages = to_changes(normalize_events(feeds.pages_snapshot(spark, sf_dir)))
    pages = cmd.fan_out(pages.withColumn("pos", F.col("event_ord")), feeds.rules(spark, 13)).withColumn(
        "f", F.lit(-1).cast("bigint"))
    return users.unionByName(pages).select("f", "pos", F.expr(cmd.payload("after")).alias("payload"))


@query("hash_payload", with_feeds("a", """
SELECT file, pos, 'status' AS field, status AS value FROM a
UNION ALL SELECT file, pos, 'user_id', user_id::VARCHAR FROM a"""))
def hash_payload(spark, sf_dir):
    df = cmd.fan_out(user_changes(spark, sf_dir), feeds.rules(spark, 2))
    return df.select("file", "pos", F.expr(f"inline({cmd.hash_fields('after')})")).drop("enc")


@query("zset_scores", with_feeds("c", "SELECT l_orderkey, event_ord, row_ord, l_partkey AS score FROM c"))
def zset_scores(spark, sf_dir):
    changes = to_changes(normalize_events(feeds.lineitem_feed(spark, sf_dir)))
    df = cmd.fan_out(changes, feeds.rules(spark, 9))
    return df.select(F.col("tx_id").alias("l_orderkey"), "event_ord", F.col("row_ord").cast("bigint").alias("row_ord"),
                     F.expr(cmd.score_of("after")).cast("bigint").alias("score"))


@query("ttl_bounds", with_feeds("b", """
SELECT 7 AS rule_id, count(*) AS n, true AS in_bounds, true AS varies FROM b
UNION ALL SELECT 8, count(*), true, false FROM b WHERE o_orderstatus = 'F'"""))
def ttl_bounds(spark, sf_dir):
    """An hour with 20 % of jitter lies in [2880, 4320); without, it is an hour."""
    made = cmd.kv_commands(order_changes(spark, sf_dir), feeds.rules(spark, 7, 8), snapshot_time=0)
    exact = F.when(F.col("rule_id") == 7, (F.col("ttl") >= 2880) & (F.col("ttl") < 4320)).otherwise(
        F.col("ttl") == 3600)
    return made.groupBy("rule_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(exact).alias("in_bounds"),
        (F.min("ttl") < F.max("ttl")).alias("varies"))


def coded(spark, sf_dir):
    """Whole document texts in all four modes."""
    docs = feeds.table(spark, sf_dir, "documents").select("doc_id", "text")
    modes = docs.withColumn("mode", F.explode(F.array(*[F.lit(m) for m in (1, 2, 3, 4)])))
    return modes.withColumn("packed", compress(F.col("text"), F.col("mode"), F.lit(-1)))


@query("compress_payload", """
SELECT unnest([1, 2, 3, 4]) AS mode, count(*) AS n, sum(strlen(text))::BIGINT AS plain_bytes, true AS smaller
FROM documents""")
def compress_payload(spark, sf_dir):
    """Size statistics of the column compression job."""
    df = coded(spark, sf_dir)
    plain = F.octet_length("text").cast("bigint")
    packed = F.octet_length("packed").cast("bigint")
    return df.groupBy("mode").agg(
        F.count(F.lit(1)).alias("n"), F.sum(plain).alias("plain_bytes"),
        (F.sum(packed) < F.sum(plain)).alias("smaller"))


@query("decompress_roundtrip", "SELECT doc_id, unnest([1, 2, 3, 4]) AS mode, md5(text) AS digest FROM documents")
def decompress_roundtrip(spark, sf_dir):
    df = coded(spark, sf_dir)
    return df.select("doc_id", "mode", F.md5(decompress(F.col("packed"), F.col("mode")).cast("binary")).alias("digest"))


@query("dead_letters", with_feeds("ab", """
SELECT 'orders' AS tb, NULL::BIGINT AS rule_id, 'no rule' AS reason, count(*) AS n FROM b GROUP BY ALL
UNION ALL SELECT 'user_state', 21, 'no score', count(*) FROM a WHERE kind <> 'delete'
UNION ALL SELECT 'user_state', 22, 'empty hash', count(*) FROM a WHERE kind <> 'delete'
UNION ALL SELECT 'user_state', 23, 'type conflict', count(*) + count(*) FILTER (WHERE kind = 'update') FROM a
UNION ALL SELECT 'user_state', 24, 'unsupported type', count(*) FROM a
UNION ALL SELECT 'user_state', 25, 'bad compress level', count(*) FROM a"""))
def dead_letters(spark, sf_dir):
    """Refused commands of each kind, and a table without rules."""
    base = dict(sid=feeds.SID, db="shop", tb="user_state")
    rules = feeds.rules_df(spark, [
        dict(base, id=20, target_key_type="string", target_key_prefix="p"),
        dict(base, id=21, target_key_type="zset", target_key_prefix="q", target_zset_score_column="status"),
        dict(base, id=22, target_key_type="hash", target_key_prefix="h", is_full_column=0, replic_columns="none"),
        dict(base, id=23, target_key_type="set", target_key_prefix="p"),
        dict(base, id=24, target_key_type="list", target_key_prefix="l"),
        dict(base, id=25, target_key_type="string", target_key_prefix="z", is_compress=1, compress_level=77),
    ])
    both = user_changes(spark, sf_dir).unionByName(order_changes(spark, sf_dir))
    return (cmd.dead_letters(both, rules).groupBy("tb", F.col("rule_id").cast("bigint").alias("rule_id"), "reason")
            .agg(F.count(F.lit(1)).alias("n")))
