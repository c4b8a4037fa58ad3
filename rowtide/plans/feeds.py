"""Change feeds derived from the given tables, and their statement in SQL."""

from pyspark.sql import Window, functions as F

from rowtide.functions.joins import join_control
from rowtide.functions.scan import previous, row_number
from rowtide.schema import rules_df
from rowtide.session import written
from rowtide.sources.feed import positional_row, snapshot_events, typed_columns

SID = 11
# Events of one multi-row event; a server splits longer ones itself.
EVENT_ROWS = 64
# A stretch of event ids that is scanned in one task.
ID_BLOCK = 1 << 20
# Lines of an order that are put in order in one place; an order with more is numbered block by block.
ORDER_LINES = 4096


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(col):
    return F.floor(F.unix_micros(F.col(col).cast("timestamp")) / 1_000_000)


def log_place(ident, prefix="bin."):
    """File and offset of a row by its ordinal: a thousand events per file."""
    return [F.concat(F.lit(prefix), F.lpad(F.floor(F.col(ident) / 1000).cast("string"), 6, "0")).alias("file"),
            (F.col(ident) % 1000 * 100 + 4).alias("pos")]


USER_COLUMNS = ["user_id", "status", "cents", "props"]


def user_state(spark, sf_dir, id_block=ID_BLOCK):
    """Feed of shop.user_state: a user's first event inserts the row, later ones
    update it, an error deletes it."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("event_type").alias("status"),
        F.round(F.col("value") * 100).cast("bigint").alias("cents"), "props",
        seconds("ts").alias("event_time"), F.floor(F.col("event_id") / id_block).alias("_blk"))
    ev = previous(ev, ["user_id"], ["_blk"], ["event_id"], F.struct(*USER_COLUMNS), "prev")
    gone = F.col("prev").isNull() | (F.col("prev.status") == "error")
    error = F.col("status") == "error"
    kind = (F.when(error & gone, None).when(error, "delete").when(gone, "insert").otherwise("update"))
    old_row = F.array(*[F.col(f"prev.{c}").cast("string") for c in USER_COLUMNS])
    new_row = positional_row(USER_COLUMNS)
    rows = (F.when(F.col("event") == "delete", F.array(old_row))
            .when(F.col("event") == "update", F.array(old_row, new_row)).otherwise(F.array(new_row)))
    changes = ev.withColumn("event", kind).where(F.col("event").isNotNull())
    in_tx = Window.partitionBy("tx_id").orderBy("event_id")  # 25 events at most
    return changes.withColumn("tx_id", F.floor(F.col("event_id") / 25)).select(
        F.lit(SID).alias("sid"), F.lit("shop").alias("db"), F.lit("user_state").alias("tb"), "event",
        *log_place("event_id"), "event_time", "tx_id",
        F.row_number().over(in_tx).cast("bigint").alias("event_ord"),
        F.lit(False).alias("is_snapshot"),
        typed_columns(changes, USER_COLUMNS).alias("table_columns"), rows.alias("rows"),
        F.lit(None).cast("string").alias("query"))


USER_STATE_SQL = """
ev AS (
  SELECT event_id, user_id, event_type AS status, round(value * 100)::BIGINT AS cents, props,
         floor(epoch(ts))::BIGINT AS t,
         lag(event_type) OVER w AS p_status, lag(round(value * 100)::BIGINT) OVER w AS p_cents,
         lag(props) OVER w AS p_props
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
kinds AS (
  SELECT *, CASE WHEN status = 'error' THEN 'delete'
                 WHEN p_status IS NULL OR p_status = 'error' THEN 'insert' ELSE 'update' END AS kind
  FROM ev WHERE NOT (status = 'error' AND (p_status IS NULL OR p_status = 'error'))),
a AS (
  SELECT event_id, kind, user_id, t,
         'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos,
         event_id // 25 AS tx_id,
         row_number() OVER (PARTITION BY event_id // 25 ORDER BY event_id) AS event_ord,
         CASE WHEN kind = 'delete' THEN p_status ELSE status END AS status,
         CASE WHEN kind = 'delete' THEN p_cents ELSE cents END AS cents,
         CASE WHEN kind = 'delete' THEN p_props ELSE props END AS props,
         CASE WHEN kind = 'update' THEN p_status END AS b_status,
         CASE WHEN kind = 'update' THEN p_cents END AS b_cents,
         CASE WHEN kind = 'update' THEN p_props END AS b_props
  FROM kinds)"""

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "price_cents"]


def orders_table(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("price_cents"))


def orders_snapshot(spark, sf_dir, **place):
    """Snapshot of shop.orders."""
    return snapshot_events(orders_table(spark, sf_dir), SID, "shop", "orders", ORDER_COLUMNS,
                           "o_orderkey", **place)


ORDERS_SQL = """
b AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
             round(o_totalprice * 100)::BIGINT AS price_cents FROM orders)"""

LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "qty", "price_cents"]


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "qty", "price_cents", "l_shipdate"]


def _rows_of_orders(lines):
    """(l_orderkey, _part, _rows): the lines of each order in events of at most EVENT_ROWS, each order in one place."""
    known = lambda r: r["l_linenumber"].isNotNull() & r["l_partkey"].isNotNull()  # others take a number, but are no rows
    part = lambda p: F.filter(F.slice("_all", p * EVENT_ROWS + 1, EVENT_ROWS), known)
    whole = lines.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER))).alias("_all"))
    parts = F.transform(F.sequence(F.lit(0), F.floor((F.size("_all") - 1) / EVENT_ROWS).cast("int")), lambda p: part(p))
    row = lambda r: F.array(*[F.col(c).cast("string") if c == "l_orderkey" else r[c].cast("string") for c in LINE_COLUMNS])
    return whole.select("l_orderkey", F.posexplode_outer(parts).alias("_part", "_lines")).where(F.size("_lines") > 0).select(
        "l_orderkey", F.col("_part").cast("bigint").alias("_part"), F.transform("_lines", row).alias("_rows"))


def _rows_in_blocks(lines):
    """As `_rows_of_orders`, for orders of any size."""
    # Blocks are a prefix of the order: the line number and a range of parts.
    lines = lines.withColumn("_parts", F.floor(F.col("l_partkey") / 4096))
    lines = row_number(lines, ["l_orderkey"], ["l_linenumber", "_parts"], LINE_ORDER, "_rn")
    return lines.select(
        "l_orderkey", F.floor((F.col("_rn") - 1) / EVENT_ROWS).alias("_part"), "_rn",
        positional_row(LINE_COLUMNS).alias("_row")).groupBy("l_orderkey", "_part").agg(
        F.sort_array(F.collect_list(F.struct("_rn", "_row"))).alias("_rows")).withColumn(
        "_rows", F.transform("_rows", lambda r: r["_row"]))


def lineitem_feed(spark, sf_dir, order_lines=ORDER_LINES):
    """Multi-row inserts into shop.lineitem: a transaction per order, its lines
    in events of at most EVENT_ROWS rows."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("price_cents"), "l_shipdate").where("l_orderkey IS NOT NULL")
    large = written(spark, lines.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > order_lines).select("l_orderkey"))
    if large.isEmpty():
        per_event = _rows_of_orders(lines)
    else:
        per_event = _rows_of_orders(join_control(lines, large, ["l_orderkey"], "left_anti")).unionByName(
            _rows_in_blocks(join_control(lines, large, ["l_orderkey"], "left_semi")))
    return per_event.select(
        F.lit(SID).alias("sid"), F.lit("shop").alias("db"), F.lit("lineitem").alias("tb"),
        F.lit("insert").alias("event"), *log_place("l_orderkey", "line."),
        (F.lit(1_700_000_000) + F.col("l_orderkey")).cast("bigint").alias("event_time"),
        F.col("l_orderkey").alias("tx_id"), (F.col("_part") + 1).alias("event_ord"),
        F.lit(False).alias("is_snapshot"), typed_columns(lines, LINE_COLUMNS).alias("table_columns"),
        F.col("_rows").alias("rows"),
        F.lit(None).cast("string").alias("query"))


LINEITEM_SQL = f"""
c0 AS (
  SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT AS qty,
         round(l_extendedprice * 100)::BIGINT AS price_cents, l_shipdate,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey,
           l_quantity::BIGINT, round(l_extendedprice * 100)::BIGINT, l_shipdate) AS rn
  FROM lineitem),
c AS (
  SELECT *, (rn - 1) // {EVENT_ROWS} + 1 AS event_ord, (rn - 1) % {EVENT_ROWS} AS row_ord,
         'line.' || lpad((l_orderkey // 1000)::VARCHAR, 6, '0') AS file, l_orderkey % 1000 * 100 + 4 AS pos,
         1700000000 + l_orderkey AS t
  FROM c0)"""


def pages_snapshot(spark, sf_dir):
    """Snapshot of web.pages: whole markup text."""
    return snapshot_events(table(spark, sf_dir, "pages"), SID, "web", "pages",
                           ["page_id", "url", "html"], "page_id")


def documents_snapshot(spark, sf_dir):
    """Snapshot of web.documents: whole texts, lang and size."""
    return snapshot_events(table(spark, sf_dir, "documents"), SID, "web", "documents",
                           ["doc_id", "lang", "source", "text", "n_chars"], "doc_id")


# The rules the queries run under.
RULES = [
    dict(id=1, sid=SID, db="shop", tb="user_state", target_key_type="string",
         target_key_prefix="us", target_key_columns="user_id"),
    dict(id=2, sid=SID, db="shop", tb="user_state", target_key_type="hash",
         target_key_prefix="uh", target_key_columns="user_id", is_full_column=0,
         replic_columns="user_id,status", delay_del=1, delay_expire_time=3600, expire_time=28800),
    dict(id=3, sid=SID, db="shop", tb="user_state", target_key_type="set",
         target_key_prefix="active", is_full_column=0, replic_columns="user_id",
         filter_rule="status=purchase"),
    dict(id=4, sid=SID, db="shop", tb="user_state", target_key_type="zset",
         target_key_prefix="spend", is_full_column=0, replic_columns="user_id",
         target_zset_score_column="cents"),
    dict(id=5, sid=SID, db="shop", tb="user_state", target_key_type="string",
         target_key_prefix="bystatus", target_key_columns="status,user_id", expire_time=86400),
    dict(id=6, sid=SID, db="shop", tb="user_state", target_key_type="string",
         target_key_prefix="inv", target_key_columns="user_id", refresh_type=0),
    dict(id=7, sid=SID, db="shop", tb="orders", target_key_type="hash",
         target_key_prefix="order", target_key_columns="o_orderkey", is_compress=2,
         compress_columns="o_orderpriority", expire_range=20),
    dict(id=8, sid=SID, db="shop", tb="orders", target_key_type="string",
         target_key_prefix="cust", target_key_columns="o_custkey,o_orderkey",
         filter_rule="o_orderstatus=F", message_key_columns="o_custkey,o_orderkey",
         message_topic_rule='{"column_name":"o_orderpriority",'
                            '"topic_rule":{"1-URGENT":"urgent","2-HIGH":"high"}}'),
    dict(id=9, sid=SID, db="shop", tb="lineitem", target_key_type="zset",
         target_key_prefix="line", is_full_column=0, replic_columns="l_orderkey,l_linenumber",
         target_zset_score_column="l_partkey", message_is_full_column=0,
         message_replic_columns="qty,l_partkey,l_linenumber"),
    dict(id=10, sid=SID, db="shop", tb="user_state", target_key_type="string", operation=3,
         target_key_prefix="us", target_key_columns="user_id"),
    dict(id=12, sid=SID, db="shop", tb="user_state", target_key_type="hash",
         target_key_prefix="uh", target_key_columns="user_id", is_full_column=0,
         replic_columns="cents", filter_rule="status=purchase", expire_time=28800,
         delay_del=1, delay_expire_time=3600),
    dict(id=13, sid=SID, db="web", tb="pages", target_key_type="string",
         target_key_prefix="page", target_key_columns="page_id"),
    dict(id=14, sid=SID, db="web", tb="documents", target_key_type="string", is_compress=4,
         target_key_prefix="doc", target_key_columns="doc_id"),
    dict(id=15, sid=SID, db="shop", tb="user_state", target_key_type="string", refresh_type=0, operation=3,
         target_key_prefix="uh", target_key_columns="user_id", filter_rule="status=signup"),
    dict(id=16, sid=SID, db="shop", tb="user_state", target_key_type="string", operation=3,
         target_key_prefix="us", target_key_columns="user_id", message_key_columns="user_id"),
]


def rules(spark, *ids):
    """The rules with the given ids, all active ones by default."""
    chosen = [r for r in RULES if (r["id"] in ids if ids else r.get("operation", 0) == 0)]
    return rules_df(spark, chosen)


def rule_table(spark, sf_dir):
    """A rule table of many server ids, one rule per customer, broken ones included."""
    k = F.col("c_custkey")
    pick = lambda values, by: F.element_at(F.array(*[F.lit(v) for v in values]), (by + 1).cast("int"))
    topic = F.concat(F.lit('{"column_name":"k'), (k % 3).cast("string"), F.lit('","topic_rule":{"1":"t'),
                     k.cast("string"), F.lit('","'), (k % 4 + 2).cast("string"), F.lit('":"u"}}'))
    num = lambda c: c.cast("int")
    return table(spark, sf_dir, "customer").select(
        num(k + 1).alias("id"), num(F.lit(SID) + F.col("c_nationkey") % 3).alias("sid"),
        F.concat(F.lit("db"), (F.col("c_nationkey") % 5).cast("string")).alias("db"),
        F.concat(F.lower("c_mktsegment"), (k % 7).cast("string")).alias("tb"),
        num(F.when(k % 11 == 0, 0).when(k % 11 == 1, 2).otherwise(1)).alias("refresh_type"),
        num(F.when(k % 13 == 0, 3).when(k % 5 == 0, 1).otherwise(0)).alias("is_dump"),
        num(k % 7).alias("is_compress"), F.lit(-1).alias("compress_level"), F.lit("").alias("compress_columns"),
        num(F.when(k % 17 == 0, 0).otherwise(60 * (1 + k % 100))).alias("expire_time"),
        num(k % 60).alias("expire_range"), num(k % 3).alias("is_full_column"),
        F.when(k % 2 == 0, " id , name").otherwise("").alias("replic_columns"),
        F.when(k % 19 == 0, "  ").otherwise(
            F.concat(F.lower("c_mktsegment"), F.lit("_"), (k % 23).cast("string"))).alias("target_key_prefix"),
        F.lit("id").alias("target_key_columns"),
        pick(["string", "hash", "set", "zset", "list"], k % 5).alias("target_key_type"),
        F.lit("").alias("target_zset_score_column"),
        pick(["", "status=open", " a = b , c=d", "a=b,c", "a=b=c"], k % 5).alias("filter_rule"),
        num(F.when(k % 10 == 3, 3).when(k % 10 == 4, 4).otherwise(0)).alias("operation"),
        pick(["", "id", "id,name"], k % 3).alias("message_key_columns"),
        F.when(k % 4 == 0, topic).when(k % 4 == 1, "{bad").otherwise("").alias("message_topic_rule"),
        F.lit(0).alias("delay_del"), F.lit(3600).alias("delay_expire_time"),
        num(k % 2).alias("message_is_full_column"),
        F.when(k % 2 == 0, " id , name").otherwise("").alias("message_replic_columns"))


RULE_TABLE_SQL = f"""
r AS (
  SELECT c_custkey + 1 AS id, {SID} + c_nationkey % 3 AS sid, 'db' || (c_nationkey % 5) AS db,
         lower(c_mktsegment) || (c_custkey % 7) AS tb,
         CASE WHEN c_custkey % 11 = 0 THEN 0 WHEN c_custkey % 11 = 1 THEN 2 ELSE 1 END AS refresh_type,
         CASE WHEN c_custkey % 13 = 0 THEN 3 WHEN c_custkey % 5 = 0 THEN 1 ELSE 0 END AS is_dump,
         c_custkey % 7 AS is_compress,
         CASE WHEN c_custkey % 17 = 0 THEN 0 ELSE 60 * (1 + c_custkey % 100) END AS expire_time,
         c_custkey % 60 AS expire_range, c_custkey % 3 AS is_full_column,
         CASE WHEN c_custkey % 19 = 0 THEN '  '
              ELSE lower(c_mktsegment) || '_' || (c_custkey % 23) END AS target_key_prefix,
         ['string', 'hash', 'set', 'zset', 'list'][c_custkey % 5 + 1] AS target_key_type,
         ['', 'status=open', ' a = b , c=d', 'a=b,c', 'a=b=c'][c_custkey % 5 + 1] AS filter_rule,
         CASE WHEN c_custkey % 10 = 3 THEN 3 WHEN c_custkey % 10 = 4 THEN 4 ELSE 0 END AS operation,
         ['', 'id', 'id,name'][c_custkey % 3 + 1] AS message_key_columns,
         CASE WHEN c_custkey % 4 = 0 THEN 'k' || (c_custkey % 3) END AS topic_column,
         CASE WHEN c_custkey % 4 = 0 THEN (c_custkey % 4 + 2)::VARCHAR END AS second_value,
         c_custkey % 2 AS message_is_full_column
  FROM customer)"""


def statements(spark, sf_dir):
    """DDL statements, one per event, of all the kinds the feed has to tell apart."""
    k = F.col("event_id")
    ident = k.cast("string")
    texts = [
        F.concat(F.lit("ALTER TABLE user_state ADD COLUMN c"), ident, F.lit(" INT")),
        F.concat(F.lit("alter table `_user_state_new` COMMENT '_user_state_new "), ident, F.lit("'")),
        F.concat(F.lit("Alter TABLE orders ADD COLUMN c"), ident, F.lit(" INT")),
        F.concat(F.lit("TRUNCATE TABLE orders -- "), ident),
        F.lit("FLUSH"),
        F.concat(F.lit("ALTER TABLE other.a, __orders_new ADD COLUMN c"), ident, F.lit(" INT")),
        F.concat(F.lit("ALTER TABLE _orders2_new ADD COLUMN c"), ident, F.lit(" INT")),
    ]
    tables = [[("shop", "user_state")], [("shop", "_user_state_new")], [("shop", "orders")],
              [("shop", "orders")], [("shop", "orders")], [("other", "a"), ("shop", "__orders_new")],
              [("shop", "_orders2_new")]]
    changed = [F.array(*[F.struct(F.lit(d).alias("db"), F.lit(t).alias("tb")) for d, t in ts]) for ts in tables]
    kind = (k % 7 + 1).cast("int")
    return table(spark, sf_dir, "events").select(
        F.lit(SID).alias("sid"), *log_place("event_id"), k.alias("event_ord"),
        F.element_at(F.array(*texts), kind).alias("query"),
        F.element_at(F.array(*changed), kind).alias("changed"))


STATEMENTS_SQL = f"""
d AS (
  SELECT event_id, event_id % 7 AS kind, {SID} AS sid,
         'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos
  FROM events)"""


def commits(spark, sf_dir):
    """Commits of a log: an error event stands for one without monitored rows."""
    return table(spark, sf_dir, "events").select(
        (F.lit(SID) + F.col("user_id") % 2).cast("int").alias("sid"), seconds("ts").alias("t"),
        F.col("event_id").alias("ord"), (F.col("event_type") != "error").alias("has_data"),
        *log_place("event_id"))


def status_rows(spark, sf_dir):
    """Observed replica status, as text; the master position lags and may step back."""
    k = F.col("event_id")
    seen = F.greatest(k - F.col("user_id") % 5, F.lit(0))
    return table(spark, sf_dir, "events").select(
        (k + 1).alias("seen_ord"), (F.lit(SID) + k % 2).cast("int").alias("sid"),
        F.when(F.col("event_type") == "signup", "m2:3306").otherwise("m1:3306").alias("master_addr"),
        F.concat(F.lit("bin."), F.lpad(F.floor(seen / 1000).cast("string"), 6, "0")).alias("relay_master_log_file"),
        (seen % 1000 * 100 + 4).cast("string").alias("exec_master_log_pos"),
        F.lit("s1:3306").alias("slave_addr"),
        F.concat(F.lit("rep."), F.lpad(F.floor(k / 700).cast("string"), 6, "0")).alias("slave_file"),
        (k % 700 * 90 + 4).cast("string").alias("slave_pos"), seconds("ts").alias("seen_at"))


STATUS_SQL = f"""
m AS (
  SELECT event_id + 1 AS id, {SID} + event_id % 2 AS sid,
         CASE WHEN event_type = 'signup' THEN 'm2:3306' ELSE 'm1:3306' END AS master_mysql_addr,
         'bin.' || lpad((greatest(event_id - user_id % 5, 0) // 1000)::VARCHAR, 6, '0') AS master_binlog_file_name,
         greatest(event_id - user_id % 5, 0) % 1000 * 100 + 4 AS master_binlog_position,
         's1:3306' AS slave_mysql_addr,
         'rep.' || lpad((event_id // 700)::VARCHAR, 6, '0') AS slave_binlog_file_name,
         event_id % 700 * 90 + 4 AS slave_binlog_position, floor(epoch(ts))::BIGINT AS insert_timestamp
  FROM events)"""


def saved_positions(spark, sf_dir):
    """Every position reported for saving, with its arrival in milliseconds."""
    return table(spark, sf_dir, "events").select(
        (F.lit(SID) + F.col("event_id") % 2).cast("int").alias("sid"),
        F.when(F.col("event_type") == "view", "m2:3306").otherwise("m1:3306").alias("mysql_addr"),
        *log_place("event_id"), seconds("ts").alias("timestamp"),
        F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1000).alias("arrival_ms"))
