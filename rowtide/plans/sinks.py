"""Queries that run a feed through the stream and read the sinks."""

from pyspark.sql import Window, functions as F

from rowtide.plans import feeds
from rowtide.plans.feed import TX, query
from rowtide.plans.kv import RESYNC_AT, RESYNC_RULE, kv_resync_state_sql, last_time
from rowtide.plans.messages import USER_MESSAGE
from rowtide.plans.sql import HASH_ITEMS, LIFE, MEMBER_ITEMS, STRING_ITEMS, alive, user_commands, with_feeds
from rowtide.schema import COMMIT, OP_ADD, OP_DROP, rules_df
from rowtide.session import shared_folder, written
from rowtide.sources.feed import snapshot_events, stream_events
from rowtide.streaming.store import BOTH, KV, MESSAGES, Store, apply_batch, run_available

SLICES = 3


def slices(spark, sf_dir, folder):
    """The feed of user_state as SLICES consecutive stretches of whole log files."""
    feed = feeds.user_state(spark, sf_dir)
    feed.write.parquet(f"{folder}/feed")
    feed = spark.read.parquet(f"{folder}/feed")
    number = F.substr(F.col("file"), F.lit(5)).cast("bigint")
    last = feed.agg(F.max(number)).first()[0]
    part = F.least(F.floor(number * SLICES / F.lit(last + 1)), F.lit(SLICES - 1))
    return [feed.where(part == i) for i in range(SLICES)]


def streamed(spark, sf_dir, rule_ids, mode):
    """Slices arrive one after the other; each is streamed from the checkpoint
    the last run left."""
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    for part in slices(spark, sf_dir, folder):
        part.write.mode("append").parquet(f"{folder}/arrived")
        run_available(spark, stream_events(spark, f"{folder}/arrived"), store, f"{folder}/checkpoint",
                      lambda s: feeds.rules(s, *rule_ids), mode=mode, topic="all")
    return store


@query("sink_messages", with_feeds("a", f"""
SELECT 'all' AS topic, NULL AS key, {USER_MESSAGE} AS value,
       row_number() OVER (ORDER BY file, pos) - 1 AS seq FROM sent""", TX))
def sink_messages(spark, sf_dir):
    """Messages without keys: one partition, numbered through all batches."""
    return streamed(spark, sf_dir, (1,), MESSAGES).read("messages").select("topic", "key", "value", "seq")


@query("sink_ordered_keys", with_feeds("a", f"""
SELECT user_id::VARCHAR AS key, {USER_MESSAGE} AS value, 1 AS n_partitions,
       row_number() OVER (PARTITION BY user_id ORDER BY file, pos) AS place,
       (SELECT count(*) FROM sent) AS n_numbers FROM sent""", TX))
def sink_ordered_keys(spark, sf_dir):
    """Messages with keys: a key's messages lie in one partition in the order of the log, and the numbers of all
    partitions leave no gap."""
    sent = streamed(spark, sf_dir, (16,), MESSAGES).read("messages")
    of_key = Window.partitionBy("key")
    numbers = sent.groupBy("topic", "partition").agg((F.max("seq") - F.min("seq") + 1).alias("n")).agg(F.sum("n").alias("n_numbers"))
    return sent.select("key", "value", F.size(F.collect_set("partition").over(of_key)).alias("n_partitions"),
                       F.row_number().over(of_key.orderBy("seq")).cast("bigint").alias("place")).join(F.broadcast(numbers))


COMMITTED = "50"  # how far after its last event a commit lies


def cut_anywhere(spark, sf_dir):
    """The feed of user_state with commit marks, as SLICES stretches that end inside transactions. Each stretch lies
    in a folder of its own, so that a batch reads no other."""
    last = feeds.table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    cuts = [-1] + [last * (i + 1) // SLICES // 25 * 25 + 12 for i in range(SLICES - 1)] + [last]
    number = F.substr(F.col("file"), F.lit(5)).cast("bigint") * 1000 + F.floor(F.col("pos") / 100)
    stretch = F.coalesce(*[F.when((number > a) & (number <= b), i) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))])
    laid = lambda df: written(spark, df.withColumn("_stretch", stretch).where("_stretch IS NOT NULL"), "_stretch")
    feed = laid(feeds.user_state(spark, sf_dir))
    marks = laid(feed.groupBy("sid", "tx_id").agg(F.max(F.struct("file", "pos", "event_time", "event_ord")).alias("e")).select(
        "sid", "tx_id", F.lit(COMMIT).alias("event"), "e.file", (F.col("e.pos") + int(COMMITTED)).alias("pos"), "e.event_time",
        (F.col("e.event_ord") + 1).alias("event_ord")))
    of = lambda df, i: df.where(F.col("_stretch") == i).drop("_stretch")
    return [of(feed, i).unionByName(of(marks, i), allowMissingColumns=True) for i in range(SLICES)]


def split_store(spark, sf_dir, rule_ids, mode):
    store = Store(spark, f"{shared_folder(spark)}/sink")
    for batch_id, part in enumerate(cut_anywhere(spark, sf_dir)):
        apply_batch(store, part, batch_id, feeds.rules(spark, *rule_ids), mode=mode, topic="all", commit_marks=True)
    return store


COMMIT_TX = TX.replace("last_id % 1000 * 100 + 4", f"last_id % 1000 * 100 + 4 + {COMMITTED}")


@query("sink_split_tx", with_feeds("a", f"""
SELECT 'position' AS kind, tx_id, chunk_no, arg_min(sent_file, n) AS file, arg_min(sent_pos, n)::BIGINT AS pos,
       arg_min(sent_time, n)::BIGINT AS event_time, NULL AS value
FROM sent GROUP BY tx_id, chunk_no HAVING arg_min(sent_file, n) <> ''
UNION ALL SELECT 'message', NULL, NULL, file, pos, t, {USER_MESSAGE} FROM sent""", COMMIT_TX))
def sink_split_tx(spark, sf_dir):
    """Batches end inside transactions; chunks and positions are those of whole transactions."""
    store = split_store(spark, sf_dir, (1,), MESSAGES)
    positions = store.read("positions").select(F.lit("position").alias("kind"), "tx_id", "chunk_no", "file", "pos", "event_time",
                                               F.lit(None).cast("string").alias("value"))
    none = F.lit(None).cast("bigint")
    return positions.unionByName(store.read("messages").select(
        F.lit("message").alias("kind"), none.alias("tx_id"), none.alias("chunk_no"), "file", "pos", "event_time", "value"))


@query("sink_kv", with_feeds("a", HASH_ITEMS, user_commands(2, 12), LIFE, alive()))
def sink_kv(spark, sf_dir):
    store = streamed(spark, sf_dir, (2, 12), KV)
    return store.state(last_time(spark, sf_dir))["hash"].drop("sid", "enc", "enc_level")


@query("sink_both", with_feeds("a", f"""
SELECT 'message' AS sink, count(*) AS n FROM sent UNION ALL SELECT 'string', count(*) FROM ({STRING_ITEMS})
""", TX, user_commands(5), LIFE, alive()))
def sink_both(spark, sf_dir):
    store = streamed(spark, sf_dir, (5,), BOTH)
    count = F.count(F.lit(1)).alias("n")
    rows = store.read("messages").agg(count).select(F.lit("message").alias("sink"), "n")
    keys = store.state(last_time(spark, sf_dir))["string"].agg(count).select(F.lit("string").alias("sink"), "n")
    return rows.unionByName(keys)


@query("sink_replay", with_feeds("a", MEMBER_ITEMS.format(score=", score"), user_commands(4), LIFE, alive()))
def sink_replay(spark, sf_dir):
    """A batch is repeated after a crash, and old batches are merged in between."""
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    parts = slices(spark, sf_dir, folder)
    rules = feeds.rules(spark, 4)
    for batch_id in (0, 1, 1):
        apply_batch(store, parts[batch_id], batch_id, rules, mode=KV)
    store.compact(0)
    for batch_id in (0, 1, 2, 2):
        apply_batch(store, parts[batch_id], batch_id, rules, mode=KV)
    table = store.state(last_time(spark, sf_dir))["zset"].drop("sid", "enc", "enc_level")
    return table.withColumn("score", F.col("score").cast("bigint"))


# After which events rule 5 comes and rule 1 goes.
ADDED, DROPPED = 401, 703


def _place(event):
    return dict(file=f"bin.{event // 1000:06d}", pos=event % 1000 * 100 + 4)


def changing_rules(spark):
    """Rule 1, which is dropped in the log, and rule 5, which is added earlier."""
    one, five = (feeds.rules(spark, i).first().asDict() for i in (1, 5))
    rows = [(one, 0, dict(file=None, pos=None)), (five, OP_ADD, _place(ADDED)), (one, OP_DROP, _place(DROPPED))]
    bare = rules_df(spark, [{**r, "operation": op} for r, op, _ in rows])
    places = spark.createDataFrame([(r["id"], op, p["file"], p["pos"]) for r, op, p in rows],
                                   "id int, operation int, file string, pos bigint")
    return bare.join(F.broadcast(places), ["id", "operation"])


def _while(rule, where):
    return (user_commands(rule).replace("cmd AS", f"cmd{rule} AS").replace("FROM a WHERE", f"FROM a WHERE {where} AND"))


@query("sink_rule_change", with_feeds("a", STRING_ITEMS, _while(1, f"event_id <= {DROPPED}"), _while(5, f"event_id > {ADDED}"),
                                      "cmd AS (SELECT * FROM cmd1 UNION ALL SELECT * FROM cmd5)", LIFE, alive()))
def sink_rule_change(spark, sf_dir):
    """Rules come and go at positions inside batches: each event is applied by the rules in force at its place."""
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    for batch_id, part in enumerate(slices(spark, sf_dir, folder)):
        apply_batch(store, part, batch_id, changing_rules(spark), mode=KV, admit=True)
    return store.state(last_time(spark, sf_dir))["string"].drop("sid", "enc", "enc_level")


@query("sink_resync", kv_resync_state_sql())
def sink_resync(spark, sf_dir):
    """A resync that reaches a running stream: its rows arrive in the batch that has passed their place."""
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    users = feeds.table(spark, sf_dir, "events").select("user_id").distinct().withColumn("status", F.lit("synced"))
    resync = snapshot_events(users, feeds.SID, "shop", "user_state", ["user_id", "status"], "user_id", at=RESYNC_AT).drop("seg")
    for batch_id, part in enumerate(slices(spark, sf_dir, folder)):
        if batch_id == 0:
            part = part.unionByName(resync)
        apply_batch(store, part, batch_id, rules_df(spark, [RESYNC_RULE]), mode=KV, snapshot_time=0, resyncs=True)
    return store.state(last_time(spark, sf_dir))["string"].select("key", "value")


@query("sink_bad_rules", with_feeds("a", f"""
SELECT 'state' AS what, key AS name, value FROM ({STRING_ITEMS}) UNION ALL SELECT 'refused', 'expire_time', '0'
UNION ALL SELECT 'refused', 'target_key_type', 'list'""", user_commands(1), LIFE, alive()))
def sink_bad_rules(spark, sf_dir):
    """From the second batch on the rules have violations; the first set stays in force and the others are listed."""
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    rules = feeds.rules(spark, 1)
    bad = [rules, rules.withColumn("expire_time", F.lit(0)), rules.withColumn("target_key_type", F.lit("list"))]
    for batch_id, part in enumerate(slices(spark, sf_dir, folder)):
        apply_batch(store, part, batch_id, bad[batch_id], mode=KV, admit=True)
    state = store.state(last_time(spark, sf_dir))["string"]
    return state.select(F.lit("state").alias("what"), F.col("key").alias("name"), "value").unionByName(
        store.read("refused").select(F.lit("refused").alias("what"), F.col("field").alias("name"), "value"))
