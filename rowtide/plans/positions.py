"""Queries over log positions."""

from pyspark.sql import functions as F

from rowtide.operators import positions as ops
from rowtide.plans import feeds
from rowtide.plans.feed import query
from rowtide.plans.sql import with_feeds

P_SQL = """
p AS (SELECT 11 + event_id % 2 AS sid,
             CASE WHEN event_type = 'view' THEN 'm2:3306' ELSE 'm1:3306' END AS mysql_addr,
             'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos,
             floor(epoch(ts))::BIGINT AS "timestamp", epoch_us(ts) // 1000 AS arrival_ms, event_id, user_id
      FROM events)"""


def wide(df):
    return df.withColumn("sid", F.col("sid").cast("bigint"))


@query("latest_position", "WITH" + P_SQL + """
SELECT sid, arg_max(mysql_addr, arrival_ms) AS mysql_addr, arg_max(file, arrival_ms) AS file,
       arg_max(pos, arrival_ms) AS pos, arg_max("timestamp", arrival_ms) AS "timestamp" FROM p GROUP BY sid""")
def latest_position(spark, sf_dir):
    return wide(ops.latest_positions(feeds.saved_positions(spark, sf_dir), "arrival_ms"))


# The greedy rule as a recursion; only for the check.
@query("throttled_positions", "WITH RECURSIVE" + P_SQL + """,
g AS (SELECT sid, min(arrival_ms) AS t FROM p GROUP BY sid
      UNION ALL
      SELECT g.sid, (SELECT min(arrival_ms) FROM p WHERE p.sid = g.sid AND p.arrival_ms > g.t + 3600000) AS t
      FROM g WHERE g.t IS NOT NULL)
SELECT p.sid, p.file, p.pos, p."timestamp" FROM p JOIN g ON p.sid = g.sid AND p.arrival_ms = g.t""")
def throttled_positions(spark, sf_dir):
    """At most one save an hour."""
    kept = ops.throttled(feeds.saved_positions(spark, sf_dir), "arrival_ms", 3_600_000)
    return wide(kept.select("sid", "file", "pos", "timestamp"))


START = 1_704_067_200


@query("idle_positions", f"""
WITH c AS (SELECT 11 + user_id % 2 AS sid, floor(epoch(ts))::BIGINT AS t, event_id, event_type <> 'error' AS has_data,
                  'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos
           FROM events),
l AS (SELECT *, coalesce(max(CASE WHEN has_data THEN t END) OVER (PARTITION BY sid ORDER BY t, event_id), {START}) AS last_t
      FROM c),
i AS (SELECT *, (t - last_t) // 60 AS beat FROM l WHERE NOT has_data AND t - last_t >= 60)
SELECT sid, arg_min(file, (t, event_id)) AS file, arg_min(pos, (t, event_id)) AS pos, min(t) AS "timestamp"
FROM i GROUP BY sid, last_t, beat""")
def idle_positions(spark, sf_dir):
    return wide(ops.idle_positions(feeds.commits(spark, sf_dir), START))


@query("position_map_rows", with_feeds("m", "SELECT * FROM m"))
def position_map_rows(spark, sf_dir):
    return wide(ops.observed_map(feeds.status_rows(spark, sf_dir)))


@query("position_map_retained", with_feeds("m", """
SELECT sid, id, insert_timestamp FROM m
WHERE insert_timestamp >= (SELECT max(insert_timestamp) FROM m) - 24 * 3600"""))
def position_map_retained(spark, sf_dir):
    rows = ops.observed_map(feeds.status_rows(spark, sf_dir))
    now = rows.agg(F.max("insert_timestamp")).first()[0]
    return wide(ops.retained_map(rows, now, 0).select("sid", "id", "insert_timestamp"))


ASKED = """
q AS (SELECT 11 + max(event_id) % 2 AS sid, 'm1:3306' AS mysql_addr,
             'bin.' || lpad((max(event_id) // 1000)::VARCHAR, 6, '0') AS file, max(event_id) % 1000 * 100 + 4 AS pos,
             user_id FROM events GROUP BY user_id),
best AS (SELECT q.*, (SELECT max(id) FROM m WHERE m.sid = q.sid AND m.master_mysql_addr = q.mysql_addr
                      AND (m.master_binlog_file_name < q.file OR (m.master_binlog_file_name = q.file
                           AND m.master_binlog_position <= q.pos))) AS id FROM q)"""


def asked(spark, sf_dir):
    """A position per user: that of the user's last event."""
    last = feeds.table(spark, sf_dir, "events").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    return last.select((F.lit(feeds.SID) + F.col("event_id") % 2).cast("int").alias("sid"),
                       F.lit("m1:3306").alias("mysql_addr"), *feeds.log_place("event_id"), "user_id")


@query("translate_position", with_feeds("m", """
SELECT q.user_id, q.sid, q.file, q.pos, m.slave_binlog_file_name AS new_file, m.slave_binlog_position AS new_pos
FROM best q LEFT JOIN m ON m.id = q.id""", ASKED))
def translate_position(spark, sf_dir):
    rows = ops.observed_map(feeds.status_rows(spark, sf_dir))
    return wide(ops.translate(asked(spark, sf_dir), rows).select(
        "user_id", "sid", "file", "pos", "new_file", "new_pos"))


def newest(spark, sf_dir):
    return feeds.status_rows(spark, sf_dir).groupBy("sid").agg(
        F.max(F.struct("slave_file", F.col("slave_pos").cast("bigint").alias("pos"))).alias("n")).select(
        "sid", F.col("n.slave_file").alias("newest_file"), F.col("n.pos").alias("newest_pos"))


@query("switch_policy", with_feeds("m", """
SELECT 0 AS policy, q.user_id, m.slave_binlog_file_name AS new_file, m.slave_binlog_position AS new_pos
FROM best q LEFT JOIN m ON m.id = q.id
UNION ALL
SELECT 1, q.user_id, n.f, n.p FROM q JOIN (
  SELECT sid, max(slave_binlog_file_name) AS f,
         arg_max(slave_binlog_position, (slave_binlog_file_name, slave_binlog_position)) AS p FROM m GROUP BY sid) n
  ON n.sid = q.sid""", ASKED))
def switch_policy(spark, sf_dir):
    rows, saved, new = ops.observed_map(feeds.status_rows(spark, sf_dir)), asked(spark, sf_dir), newest(spark, sf_dir)
    parts = [ops.switch_positions(saved, rows, new, p).select(
        F.lit(p).alias("policy"), "user_id", "new_file", "new_pos") for p in (0, 1)]
    return parts[0].unionByName(parts[1])


RESUME = """
servers AS (SELECT c_custkey AS sid, CASE WHEN c_acctbal < 0 THEN 'm2:3306' ELSE 'm1:3306' END AS current_addr,
                   c_mktsegment = 'BUILDING' AS snap FROM customer),
last AS (SELECT user_id AS sid, arg_max(event_type, event_id) AS kind, max(event_id) AS event_id FROM events GROUP BY ALL),
saved AS (SELECT sid, CASE WHEN kind IN ('click', 'signup') THEN 'm2:3306' ELSE 'm1:3306' END AS mysql_addr,
                 'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos
          FROM last WHERE kind <> 'error'),
um AS (SELECT user_id AS sid, event_id + 1 AS id,
              CASE WHEN event_type = 'signup' THEN 'm2:3306' ELSE 'm1:3306' END AS addr,
              'bin.' || lpad((event_id // 1000)::VARCHAR, 6, '0') AS file, event_id % 1000 * 100 + 4 AS pos,
              'rep.' || lpad((event_id // 700)::VARCHAR, 6, '0') AS sfile, event_id % 700 * 90 + 4 AS spos FROM events),
nw AS (SELECT sid, max(sfile) AS f, arg_max(spos, (sfile, spos)) AS p FROM um GROUP BY sid),
tr AS (SELECT s.sid, max(um.id) AS id FROM saved s JOIN um ON um.sid = s.sid AND um.addr = s.mysql_addr
         AND (um.file < s.file OR (um.file = s.file AND um.pos <= s.pos)) GROUP BY s.sid),
plan AS (SELECT v.sid, CASE WHEN s.sid IS NULL AND v.snap THEN 'snapshot' WHEN s.sid IS NULL THEN 'newest'
                            WHEN s.mysql_addr = v.current_addr THEN 'saved'
                            WHEN tr.id IS NULL THEN 'stop' ELSE 'switched' END AS action,
                s.file, s.pos, um.sfile, um.spos, nw.f, nw.p
         FROM servers v LEFT JOIN saved s USING (sid) LEFT JOIN tr USING (sid) LEFT JOIN um ON um.id = tr.id
         LEFT JOIN nw ON nw.sid = v.sid)"""


@query("resume_plan", "WITH" + RESUME + """
SELECT sid, action, CASE action WHEN 'newest' THEN f WHEN 'saved' THEN file WHEN 'switched' THEN sfile END AS file,
       CASE action WHEN 'newest' THEN p WHEN 'saved' THEN pos WHEN 'switched' THEN spos END AS pos FROM plan""")
def resume_plan(spark, sf_dir):
    """Every customer is a server id; users with that id have a position saved."""
    c = feeds.table(spark, sf_dir, "customer")
    servers = c.select(F.col("c_custkey").alias("sid"),
                       F.when(F.col("c_acctbal") < 0, "m2:3306").otherwise("m1:3306").alias("current_addr"))
    snapshots = c.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("sid"))
    ev = feeds.table(spark, sf_dir, "events")
    last = ev.groupBy(F.col("user_id").alias("sid")).agg(
        F.max(F.struct("event_id", "event_type")).alias("l")).select("sid", "l.*")
    saved = last.where(F.col("event_type") != "error").select(
        "sid", F.when(F.col("event_type").isin("click", "signup"), "m2:3306").otherwise("m1:3306").alias("mysql_addr"),
        *feeds.log_place("event_id"))
    k = F.col("event_id")
    rows = ev.select(
        (k + 1).alias("id"), F.col("user_id").alias("sid"),
        F.when(F.col("event_type") == "signup", "m2:3306").otherwise("m1:3306").alias("master_mysql_addr"),
        *[col.alias(n) for col, n in zip(
            feeds.log_place("event_id"), ("master_binlog_file_name", "master_binlog_position"))],
        F.concat(F.lit("rep."), F.lpad(F.floor(k / 700).cast("string"), 6, "0")).alias("slave_binlog_file_name"),
        (k % 700 * 90 + 4).alias("slave_binlog_position"))
    new = rows.groupBy("sid").agg(
        F.max(F.struct("slave_binlog_file_name", "slave_binlog_position")).alias("n")).select(
        "sid", F.col("n.slave_binlog_file_name").alias("newest_file"),
        F.col("n.slave_binlog_position").alias("newest_pos"))
    return ops.resume_plan(servers, saved, snapshots, rows, new, policy=0)
