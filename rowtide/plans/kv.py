"""Queries over commands and the state they lead to."""

from pyspark.sql import functions as F

from rowtide.operators import commands as cmd
from rowtide.operators import state
from rowtide.operators.normalize import deliver, normalize_events, to_changes
from rowtide.plans import feeds
from rowtide.plans.feed import query, user_changes
from rowtide.plans.sql import HASH_ITEMS, LIFE, MEMBER_ITEMS, STRING_ITEMS, alive, user_commands, with_feeds
from rowtide.session import written
from rowtide.sources.feed import insert_resync, monitored, unmonitored


def last_time(spark, sf_dir):
    return feeds.table(spark, sf_dir, "events").agg(F.max(feeds.seconds("ts"))).first()[0]


def commands(spark, sf_dir, *rule_ids, until=None):
    changes = user_changes(spark, sf_dir)
    if until is not None:
        changes = changes.where(F.col("event_time") <= until)
    return cmd.kv_commands(changes, feeds.rules(spark, *rule_ids))


def state_query(name, kind, items, rule_ids, **shape):
    oracle = with_feeds("a", items, user_commands(*rule_ids), LIFE, alive())

    @query(name, oracle)
    def run(spark, sf_dir):
        tables = state.fold(commands(spark, sf_dir, *rule_ids), last_time(spark, sf_dir))
        table = tables[kind].drop("sid", "enc", "enc_level")
        if kind == "zset":
            table = table.withColumn("score", F.col("score").cast("bigint"))
        return table
    return run


state_query("kv_string_state", "string", STRING_ITEMS, (1,))
state_query("kv_string_moved_keys", "string", STRING_ITEMS, (5,))
state_query("kv_hash_state", "hash", HASH_ITEMS, (2,))
state_query("kv_set_state", "set", MEMBER_ITEMS.format(score=""), (3,))
state_query("kv_zset_state", "zset", MEMBER_ITEMS.format(score=", score"), (4,))
# Two rules write other fields of the same hashes, and one also drops them.
state_query("kv_shared_hash", "hash", HASH_ITEMS, (2, 12))
# Two rules with one prefix; the later rule has the last word on each row.
state_query("kv_shared_key", "string", STRING_ITEMS, (1, 10))


@query("kv_commands", with_feeds("a", """
SELECT rule_id, phase, file, pos, event_ord, t, target_type, key AS target_key, op, ttl,
       coalesce(value, array_to_string(list_sort(fields), ',')) AS value, score FROM cmd""",
                                 user_commands(1, 2, 3, 4, 5, 6, 12)))
def kv_commands(spark, sf_dir):
    fields = F.array_join(F.sort_array(F.transform(
        "fields", lambda f: F.concat(f["field"], F.lit("="), f["value"]))), ",")
    return commands(spark, sf_dir, 1, 2, 3, 4, 5, 6, 12).select(
        F.col("rule_id"), F.col("phase"), "file", "pos", "event_ord", "t", "target_type", "target_key", "op", "ttl",
        F.coalesce("value", fields).alias("value"), F.col("score").cast("bigint").alias("score"))


@query("kv_cleanup_commands", with_feeds("a", """
SELECT rule_id, file, pos, key AS target_key, op, value FROM cmd WHERE phase = 0""", user_commands(3, 4, 5, 12)))
def kv_cleanup_commands(spark, sf_dir):
    made = commands(spark, sf_dir, 3, 4, 5, 12).where(F.col("phase") == 0)
    return made.select("rule_id", "file", "pos", "target_key", "op", "value")


@query("kv_invalidations", with_feeds("a", "SELECT DISTINCT 'inv:' || user_id AS target_key FROM a"))
def kv_invalidations(spark, sf_dir):
    return cmd.invalidations(commands(spark, sf_dir, 6))


@query("kv_invalidate_any_type", with_feeds("a", HASH_ITEMS, user_commands(2, 15), LIFE, alive()))
def kv_invalidate_any_type(spark, sf_dir):
    """Hashes under keys that a rule of another type invalidates on sign-up."""
    made = commands(spark, sf_dir, 2, 15)
    return state.fold(made, last_time(spark, sf_dir))["hash"].drop("sid", "enc", "enc_level")


HALF = f"(SELECT (min(floor(epoch(ts))::BIGINT) + max(floor(epoch(ts))::BIGINT)) // 2 FROM events)"


@query("kv_alive_asof", with_feeds(
    "a", f"""SELECT target_type, key AS target_key, dl AS expires_at FROM alive
WHERE target_type <> 'zset' OR key IN (SELECT key FROM ({MEMBER_ITEMS.format(score='')}))""",
    user_commands(1, 2, 4, 5).replace("FROM a WHERE", f"FROM a WHERE t <= {HALF} AND"), LIFE, alive(HALF)))
def kv_alive_asof(spark, sf_dir):
    """Keys alive at the middle of the feed."""
    lo, hi = feeds.table(spark, sf_dir, "events").agg(
        F.min(feeds.seconds("ts")), F.max(feeds.seconds("ts"))).first()
    until = (lo + hi) // 2
    # The commands are read by four jobs, the keys and items once per type.
    made = written(spark, commands(spark, sf_dir, 1, 2, 4, 5, until=until))
    keys = written(spark, state.lives(made))
    members = state.item_lines(made.where(F.col("target_type").isin("set", "zset")))
    return state.existing_keys(keys, members, until).select("target_type", "target_key", "expires_at")


LONG = 1_000_000_000


def _of_server(sid, where):
    """Commands of rule 1 on one of two servers, whose keys bear its number."""
    return (user_commands(1).replace("cmd AS", f"cmd{sid} AS").replace("'us:'", f"'{sid}|us:'")
            .replace("FROM a WHERE true", f"FROM a WHERE {where}").replace("3600", str(LONG)))


@query("kv_two_servers", with_feeds("a", f"""
SELECT string_split(key, '|')[1]::INT AS sid, string_split(key, '|')[2] AS key, value, expires_at FROM ({STRING_ITEMS})""",
                                    _of_server(11, "true"), _of_server(12, f"t <= {HALF}"),
                                    "cmd AS (SELECT * FROM cmd11 UNION ALL SELECT * FROM cmd12)", LIFE, alive()))
def kv_two_servers(spark, sf_dir):
    """Two servers write the same keys; the second one only in the first half of
    the feed, under file names that sort before those of the first."""
    lo, hi = feeds.table(spark, sf_dir, "events").agg(F.min(feeds.seconds("ts")), F.max(feeds.seconds("ts"))).first()
    changes = user_changes(spark, sf_dir)
    other = changes.where(F.col("event_time") <= (lo + hi) // 2).withColumn("sid", F.lit(12)).withColumn(
        "file", F.regexp_replace("file", "^bin", "alt"))
    rules = feeds.rules(spark, 1).withColumn("expire_time", F.lit(LONG))
    rules = rules.unionByName(rules.withColumn("sid", F.lit(12)))
    made = cmd.kv_commands(changes.unionByName(other), rules)
    return state.fold(made, hi)["string"].select("sid", "key", "value", "expires_at")


ORDER_TIME = 1_000


@query("kv_snapshot_hash", with_feeds("b", f"""
SELECT 'order:' || o_orderkey AS key, unnest(['o_orderkey', 'o_custkey', 'o_orderstatus', 'price_cents']) AS field,
       unnest([o_orderkey::VARCHAR, o_custkey::VARCHAR, o_orderstatus, price_cents::VARCHAR]) AS value FROM b
UNION ALL SELECT 'order:' || o_orderkey, 'o_orderpriority', o_orderpriority FROM b"""))
def kv_snapshot_hash(spark, sf_dir):
    """Hashes of the order snapshot; the compressed field is stored packed and
    read back here."""
    from rowtide.functions.codec import decompress
    changes = to_changes(normalize_events(feeds.orders_snapshot(spark, sf_dir)))
    made = cmd.kv_commands(changes, feeds.rules(spark, 7), snapshot_time=ORDER_TIME)
    packed = state.encode(state.fold(made, ORDER_TIME)["hash"], "value", "bytes")
    return packed.select("key", "field", decompress(F.col("bytes"), F.col("enc")).alias("value"))


@query("kv_member_table", with_feeds("c", f"""
SELECT 'line' AS key, '{{"l_linenumber":' || l_linenumber || ',"l_orderkey":' || l_orderkey || '}}' AS member,
       arg_max(l_partkey, rn) AS score FROM c GROUP BY l_orderkey, l_linenumber"""))
def kv_member_table(spark, sf_dir):
    """A scored set that holds a whole table under one key; its lines are made
    to outlive the feed, so that all of them are there at the end."""
    changes = to_changes(normalize_events(feeds.lineitem_feed(spark, sf_dir)))
    made = cmd.kv_commands(changes, feeds.rules(spark, 9)).withColumn("ttl", F.col("ttl") + (1 << 32))
    table = state.fold(made, 1 << 32)["zset"]
    return table.select("key", "member", F.col("score").cast("bigint").alias("score"))


RESYNC_AT = ("bin.000000", 50004)
RESYNC_RULE = dict(id=31, sid=feeds.SID, db="shop", tb="user_state", target_key_type="string",
                   target_key_prefix="rs", target_key_columns="user_id", is_full_column=0,
                   replic_columns="status", expire_time=1_000_000_000)


def kv_resync_state_sql():
    return with_feeds("a", f"""
SELECT 'rs:' || user_id AS key, '{{"status":' || '"' || arg_max(status, o) || '"}}' AS value FROM (
  SELECT user_id, kind, status, CASE WHEN file > '{RESYNC_AT[0]}' OR pos > {RESYNC_AT[1]} THEN 2 ELSE 0 END
           * 1000000000000 + event_id AS o FROM a
  UNION ALL SELECT DISTINCT user_id, 'insert', 'synced', 1000000000000 FROM events)
GROUP BY user_id HAVING arg_max(kind, o) <> 'delete'""")


@query("kv_resync_state", kv_resync_state_sql())
def kv_resync_state(spark, sf_dir):
    """A table resync in the middle of the log: its rows come after the events
    before the pause and before all later ones."""
    from rowtide.sources.feed import snapshot_events
    users = feeds.table(spark, sf_dir, "events").select("user_id").distinct().withColumn(
        "status", F.lit("synced"))
    rows = snapshot_events(users, feeds.SID, "shop", "user_state", ["user_id", "status"], "user_id")
    resync = to_changes(normalize_events(rows))
    changes = insert_resync(user_changes(spark, sf_dir), resync, *RESYNC_AT)
    made = cmd.kv_commands(changes, feeds.rules_df(spark, [RESYNC_RULE]), snapshot_time=0)
    table = state.fold(made, last_time(spark, sf_dir))["string"]
    return table.select("key", "value")


@query("lost_nothing", """
SELECT event_id AS pos, CASE event_id % 7 WHEN 3 THEN 'odd image' WHEN 4 THEN 'no image' WHEN 5 THEN 'unreadable'
                        WHEN 6 THEN 'no rule' ELSE 'write' END AS outcome FROM events
UNION ALL SELECT event_id, 'sent' FROM events WHERE event_id % 7 <> 6""")
def lost_nothing(spark, sf_dir):
    """A feed with every defect its schema allows: each event ends as a command
    or a dead letter, and each of a monitored table is sent."""
    defect = F.col("event_id") % 7
    raw = feeds.table(spark, sf_dir, "events").select(
        F.lit(feeds.SID).alias("sid"), F.lit("shop").alias("db"),
        F.when(defect == 6, "orphans").otherwise("user_state").alias("tb"),
        F.when(defect == 3, "update").when(defect == 5, "broken").otherwise("insert").alias("event"),
        F.lit("bin.000000").alias("file"), F.col("event_id").alias("pos"), feeds.seconds("ts").alias("event_time"),
        F.when(defect != 1, F.col("event_id")).alias("tx_id"), F.when(defect != 0, F.lit(1)).cast("bigint").alias("event_ord"),
        F.when(defect != 2, F.lit(False)).alias("is_snapshot"),
        F.array(F.struct(F.lit("user_id").alias("name"), F.lit("int").alias("type"))).alias("table_columns"),
        F.when(defect == 4, F.array().cast("array<array<string>>")).otherwise(
            F.array(F.array(F.col("user_id").cast("string")))).alias("rows"), F.lit(None).cast("string").alias("query"))
    rules = feeds.rules(spark, 1)
    known = monitored(raw, rules)
    made = cmd.generate(to_changes(normalize_events(known)), rules)
    lost = cmd.without_rule(to_changes(normalize_events(unmonitored(raw, rules))), rules).unionByName(
        cmd.refused(made)).unionByName(cmd.malformed(raw))
    return (cmd.accepted(made).select("pos", F.lit("write").alias("outcome"))
            .unionByName(lost.select("pos", F.col("reason").alias("outcome")))
            .unionByName(deliver(known).select("pos", F.lit("sent").alias("outcome"))))
