"""Queries over sources, normalization, transactions and DDL."""

from pyspark.sql import functions as F

from rowtide.operators.ddl import alter_feed, resolve_shadow
from rowtide.operators.normalize import deliver, normalize_events, to_changes
from rowtide.operators.positions import delivered_positions
from rowtide.plans import feeds
from rowtide.plans.sql import with_feeds
from rowtide.sources import feed as src

QUERIES, ORACLES = {}, {}


def query(name, oracle=None):
    def register(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return register


def value_of(image, name):
    return F.expr(f"try_element_at(filter({image}, c -> c.name = '{name}'), 1).value")


def columns_of(image, names, prefix=""):
    return [value_of(image, n).alias(prefix + n) for n in names]


def user_changes(spark, sf_dir):
    return to_changes(normalize_events(feeds.user_state(spark, sf_dir)))


PLACE = ["file", "pos", "event_time", "tx_id", "event_ord"]


@query("feed_changes", with_feeds("a", """
SELECT kind AS event, file, pos, t AS event_time, tx_id, event_ord, 0::BIGINT AS row_ord, user_id::VARCHAR AS user_id,
       status, cents::VARCHAR AS cents, props FROM a"""))
def feed_changes(spark, sf_dir):
    return user_changes(spark, sf_dir).select(
        "event", *PLACE, F.col("row_ord").cast("bigint").alias("row_ord"),
        *columns_of("after", feeds.USER_COLUMNS))


@query("feed_update_pairs", with_feeds("a", """
SELECT file, pos, user_id::VARCHAR AS user_id, status, cents::VARCHAR AS cents, props, b_status,
       b_cents::VARCHAR AS b_cents, b_props FROM a WHERE kind = 'update'"""))
def feed_update_pairs(spark, sf_dir):
    ch = user_changes(spark, sf_dir).where(F.col("event") == "update")
    return ch.select("file", "pos", *columns_of("after", feeds.USER_COLUMNS),
                     *columns_of("before", ["status", "cents", "props"], "b_"))


@query("feed_multi_row", with_feeds("c", """
SELECT file, pos, event_ord, row_ord, l_orderkey::VARCHAR AS l_orderkey, l_linenumber::VARCHAR AS l_linenumber,
       l_partkey::VARCHAR AS l_partkey, l_suppkey::VARCHAR AS l_suppkey, qty::VARCHAR AS qty,
       price_cents::VARCHAR AS price_cents FROM c"""))
def feed_multi_row(spark, sf_dir):
    ch = to_changes(normalize_events(feeds.lineitem_feed(spark, sf_dir)))
    return ch.select("file", "pos", "event_ord", F.col("row_ord").cast("bigint").alias("row_ord"),
                     *columns_of("after", feeds.LINE_COLUMNS))


@query("feed_schema_drift", with_feeds("b", """
SELECT o_orderkey, least(4, 3 + o_orderkey % 3) AS n_cells,
       CASE WHEN o_orderkey % 3 = 0 THEN 'o_orderkey,o_custkey,o_orderstatus'
            ELSE 'o_orderkey,o_custkey,o_orderstatus,o_orderpriority' END AS names,
       concat_ws('|', o_orderkey, o_custkey, o_orderstatus,
                 CASE WHEN o_orderkey % 3 > 0 THEN o_orderpriority END) AS "values"
FROM b"""))
def feed_schema_drift(spark, sf_dir):
    """Column lists of four over rows of three, four and five values."""
    raw = feeds.orders_snapshot(spark, sf_dir)
    width = (F.lit(3) + F.col("event_ord") % 3).cast("int")
    drifted = raw.withColumn("table_columns", F.slice("table_columns", 1, 4)).withColumn(
        "rows", F.transform("rows", lambda r: F.slice(r, F.lit(1), width)))
    ch = to_changes(normalize_events(drifted))
    return ch.select(
        F.col("event_ord").alias("o_orderkey"), F.size("after").cast("bigint").alias("n_cells"),
        F.array_join(F.transform("after", lambda c: c["name"]), ",").alias("names"),
        F.array_join(F.transform("after", lambda c: c["value"]), "|").alias("values"))


@query("snapshot_inserts", with_feeds("b", """
SELECT 'insert' AS event, '' AS file, 0::BIGINT AS pos, 0::BIGINT AS event_time,
       o_orderkey::VARCHAR AS o_orderkey, o_custkey::VARCHAR AS o_custkey, o_orderstatus, o_orderpriority,
       price_cents::VARCHAR AS price_cents FROM b"""))
def snapshot_inserts(spark, sf_dir):
    ch = to_changes(normalize_events(feeds.orders_snapshot(spark, sf_dir)))
    return ch.select("event", "file", "pos", "event_time", *columns_of("after", feeds.ORDER_COLUMNS))


@query("resync_tables", """
SELECT 'shop' AS db, 'orders' AS tb, count(*) AS n, min(o_orderkey)::VARCHAR AS lo, max(o_orderkey)::VARCHAR AS hi
FROM orders
UNION ALL SELECT 'web', 'pages', count(*), min(page_id)::VARCHAR, max(page_id)::VARCHAR FROM pages""")
def resync_tables(spark, sf_dir):
    """A request with blanks, a malformed entry and a table nobody knows."""
    tables = {
        ("shop", "orders"): lambda s: (feeds.orders_table(s, sf_dir), feeds.ORDER_COLUMNS, "o_orderkey"),
        ("web", "pages"): lambda s: (feeds.table(s, sf_dir, "pages"), ["page_id", "url"], "page_id"),
    }
    events = src.resync_events(spark, "shop.orders, web.pages,broken,shop.none.x,", tables, feeds.SID)
    first = F.col("after")[0]["value"].cast("bigint")
    return to_changes(normalize_events(events)).groupBy("db", "tb").agg(
        F.count(F.lit(1)).alias("n"), F.min(first).cast("string").alias("lo"),
        F.max(first).cast("string").alias("hi"))


CUT = ("bin.000000", 50004)


@query("snapshot_plus_changes", with_feeds("ab", f"""
SELECT 'orders' AS tb, 'insert' AS event, '' AS file, 0::BIGINT AS pos, o_orderkey::VARCHAR AS k FROM b
UNION ALL SELECT 'user_state', kind, file, pos, user_id::VARCHAR FROM a
WHERE (file > '{CUT[0]}' OR (file = '{CUT[0]}' AND pos > {CUT[1]}))"""))
def snapshot_plus_changes(spark, sf_dir):
    snap = to_changes(normalize_events(feeds.orders_snapshot(spark, sf_dir)))
    both = src.snapshot_then_changes(snap, user_changes(spark, sf_dir), *CUT)
    return both.select("tb", "event", "file", "pos", F.col("after")[0]["value"].alias("k"))


@query("replay_from_position", with_feeds("a", f"""
SELECT kind AS event, file, pos, user_id::VARCHAR AS user_id FROM a
WHERE (file > '{CUT[0]}' OR (file = '{CUT[0]}' AND pos > {CUT[1]}))"""))
def replay_from_position(spark, sf_dir):
    late = src.after_position(user_changes(spark, sf_dir), *CUT)
    return late.select("event", "file", "pos", *columns_of("after", ["user_id"]))


@query("monitored_events", with_feeds("abc", """
SELECT 'user_state' AS tb, count(*) AS n FROM a UNION ALL SELECT 'lineitem', count(DISTINCT (l_orderkey, event_ord)) FROM c"""))
def monitored_events(spark, sf_dir):
    """Only tables with rules come through: the order snapshot has none here."""
    both = (feeds.user_state(spark, sf_dir).unionByName(feeds.lineitem_feed(spark, sf_dir))
            .unionByName(feeds.orders_snapshot(spark, sf_dir).drop("seg")))
    kept = src.monitored(both, feeds.rules(spark, 1, 2, 9))
    return kept.groupBy("tb").agg(F.count(F.lit(1)).alias("n"))


TX = """
tx AS (SELECT *, count(*) OVER (PARTITION BY tx_id) AS cnt, max(event_id) OVER (PARTITION BY tx_id) AS last_id FROM a),
sent AS (
  SELECT event_id, tx_id, event_ord AS n, (event_ord - 1) // 9 AS chunk_no, kind, t, user_id,
         (event_ord - 1) // 9 < cnt // 9 AS early,
         CASE WHEN (event_ord - 1) // 9 < cnt // 9 THEN ''
              ELSE 'bin.' || lpad((last_id // 1000)::VARCHAR, 6, '0') END AS sent_file,
         CASE WHEN (event_ord - 1) // 9 < cnt // 9 THEN 0 ELSE last_id % 1000 * 100 + 4 END AS sent_pos,
         CASE WHEN (event_ord - 1) // 9 < cnt // 9 AND event_ord % 9 = 0 THEN 0 ELSE t END AS sent_time,
         status, cents, props, b_status, b_cents, b_props, file, pos
  FROM tx)"""


@query("tx_chunks", with_feeds("a", """
SELECT tx_id, n, chunk_no, sent_file, sent_pos::BIGINT AS sent_pos, sent_time::BIGINT AS sent_time, kind AS event
FROM sent""", TX))
def tx_chunks(spark, sf_dir):
    sent = deliver(feeds.user_state(spark, sf_dir))
    return sent.select("tx_id", "n", "chunk_no", "sent_file", "sent_pos", "sent_time", "event")


@query("delivered_positions", with_feeds("a", """
SELECT 11 AS sid, tx_id, chunk_no, arg_min(sent_file, n) AS file, arg_min(sent_pos, n)::BIGINT AS pos,
       arg_min(sent_time, n)::BIGINT AS event_time
FROM sent GROUP BY tx_id, chunk_no HAVING arg_min(sent_file, n) <> ''""", TX))
def delivered(spark, sf_dir):
    return delivered_positions(deliver(feeds.user_state(spark, sf_dir)))


ALTERS = """
SELECT 11 AS sid, 'shop' AS db, '' AS tb, 'query' AS event, file, pos, 0::BIGINT AS event_time,
       event_id AS event_ord,
       CASE kind WHEN 0 THEN 'ALTER TABLE user_state ADD COLUMN c' || event_id || ' INT'
                 WHEN 1 THEN 'alter table `user_state` COMMENT ''_user_state_new ' || event_id || ''''
                 ELSE 'ALTER TABLE other.a, orders ADD COLUMN c' || event_id || ' INT' END AS query
FROM d WHERE kind IN (0, 1, 5)"""


@query("alter_feed", with_feeds("d", ALTERS))
def alters(spark, sf_dir):
    return alter_feed(feeds.statements(spark, sf_dir), feeds.rules(spark))


@query("shadow_table_ddl", with_feeds("d", """
SELECT event_id AS event_ord,
       CASE kind WHEN 0 THEN 'user_state' WHEN 1 THEN '_user_state_new' WHEN 5 THEN '__orders_new' ELSE 'orders' END
         AS changed_tb,
       CASE WHEN kind IN (0, 1) THEN 'user_state' ELSE 'orders' END AS tb, kind IN (1, 5) AS is_shadow
FROM d WHERE kind <> 6"""))
def shadow_table_ddl(spark, sf_dir):
    changed = feeds.statements(spark, sf_dir).select(
        "sid", "event_ord", F.explode("changed").alias("c")).select(
        "sid", "event_ord", "c.db", F.col("c.tb").alias("changed_tb"))
    return resolve_shadow(changed, feeds.rules(spark)).select("event_ord", "changed_tb", "tb", "is_shadow")
