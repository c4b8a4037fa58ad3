"""Queries over the rule table."""

from pyspark.sql import functions as F

from rowtide.operators import rules as ops
from rowtide.plans import feeds
from rowtide.plans.feed import query
from rowtide.plans.sql import with_feeds
from rowtide.schema import OP_ACTIVE
from rowtide.sources import feed as src

ACTIVE = "r0 AS (SELECT * FROM r WHERE operation = 0)"


def rules(spark, sf_dir):
    return feeds.rule_table(spark, sf_dir)


def active(spark, sf_dir):
    return src.active_rules(rules(spark, sf_dir))


@query("active_rules", with_feeds("r", """
SELECT id, sid, db, tb, target_key_type, expire_time FROM r WHERE sid = 11 AND operation = 0"""))
def active_rules(spark, sf_dir):
    return src.active_rules(rules(spark, sf_dir), 11).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("id", "sid")], "db", "tb", "target_key_type",
        F.col("expire_time").cast("bigint").alias("expire_time"))


@query("include_tables", with_feeds("r", "SELECT DISTINCT sid, db, tb FROM r0", ACTIVE))
def include_tables(spark, sf_dir):
    return src.include_tables(active(spark, sf_dir)).withColumn("sid", F.col("sid").cast("bigint"))


@query("dump_tables", with_feeds("r", """
SELECT DISTINCT sid, db, tb FROM r0 WHERE is_dump = 1""", ACTIVE))
def dump_tables(spark, sf_dir):
    return src.snapshot_tables(active(spark, sf_dir)).withColumn("sid", F.col("sid").cast("bigint"))


def _check(field, bad):
    return f"SELECT sid, id, '{field}' AS field, {field}::VARCHAR AS value FROM r WHERE {bad}"


@query("rule_violations", with_feeds("r", "\nUNION ALL ".join([
    _check("refresh_type", "refresh_type NOT IN (0, 1)"),
    _check("is_dump", "is_dump NOT IN (0, 1)"),
    _check("is_compress", "is_compress NOT BETWEEN 0 AND 4"),
    _check("expire_time", "expire_time <= 0"),
    _check("expire_range", "expire_range NOT BETWEEN 0 AND 50"),
    _check("is_full_column", "is_full_column NOT IN (0, 1)"),
    _check("target_key_prefix", "replace(target_key_prefix, ' ', '') = ''"),
    _check("target_key_type", "target_key_type NOT IN ('string', 'hash', 'set', 'zset')"),
    _check("filter_rule", "filter_rule IN ('a=b,c', 'a=b=c')"),
])))
def rule_violations(spark, sf_dir):
    found = ops.rule_violations(rules(spark, sf_dir))
    return found.select(F.col("sid").cast("bigint").alias("sid"), F.col("id").cast("bigint").alias("id"),
                        "field", "value")


@query("prefix_conflicts", with_feeds("r", """
SELECT sid, id, target_key_prefix, target_key_type, first_type FROM (
  SELECT *, first_value(target_key_type) OVER (PARTITION BY sid, target_key_prefix ORDER BY id) AS first_type FROM r0)
WHERE first_type <> target_key_type""", ACTIVE))
def prefix_conflicts(spark, sf_dir):
    found = ops.prefix_conflicts(active(spark, sf_dir))
    return found.select(F.col("sid").cast("bigint").alias("sid"), F.col("id").cast("bigint").alias("id"),
                        "target_key_prefix", "target_key_type", "first_type")


@query("rules_by_table", with_feeds("r", """
SELECT sid, db, tb, count(*) AS n_rules, min(id) AS first_id FROM r0 GROUP BY ALL""", ACTIVE))
def rules_by_table(spark, sf_dir):
    return ops.rules_by_table(active(spark, sf_dir)).select(
        F.col("sid").cast("bigint").alias("sid"), "db", "tb", "n_rules",
        F.col("first_id").cast("bigint").alias("first_id"))


def in_force(spark, sf_dir):
    """Rules of which the drops are still in force, and the pending changes."""
    table = rules(spark, sf_dir)
    pending = table.where(F.col("operation") != OP_ACTIVE)
    current = table.where(F.col("operation") != 3)
    return current, pending


@query("rules_after_change", with_feeds("r", """
SELECT id, sid, db, tb, operation FROM r WHERE operation <> 4"""))
def rules_after_change(spark, sf_dir):
    current, pending = in_force(spark, sf_dir)
    return ops.apply_rule_changes(current, pending).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("id", "sid", "operation")], "db", "tb")


@query("rule_change_tables", with_feeds("r", """
SELECT DISTINCT 'snapshot' AS what, sid, db, tb FROM r WHERE operation = 3 AND is_dump = 1
UNION ALL SELECT DISTINCT 'dropped', sid, db, tb FROM r WHERE operation = 4"""))
def rule_change_tables(spark, sf_dir):
    current, pending = in_force(spark, sf_dir)
    snap = ops.tables_to_snapshot(pending).withColumn("what", F.lit("snapshot"))
    gone = ops.tables_dropped(current, pending).withColumn("what", F.lit("dropped"))
    return snap.unionByName(gone).withColumn("sid", F.col("sid").cast("bigint"))


@query("rules_acknowledged", with_feeds("r", """
SELECT id, sid, CASE WHEN operation = 3 THEN 0 ELSE operation END AS operation FROM r WHERE operation <> 4"""))
def rules_acknowledged(spark, sf_dir):
    return ops.acknowledge(rules(spark, sf_dir)).select(
        *[F.col(c).cast("bigint").alias(c) for c in ("id", "sid", "operation")])


def _routes(source):
    return f"""
SELECT 'key' AS what, sid, db, tb, '' AS value, arg_max(message_key_columns, id) AS target
FROM {source} WHERE message_key_columns <> '' GROUP BY ALL
UNION ALL
SELECT 'column', sid, db, tb, '', arg_max(topic_column, id) FROM {source} WHERE topic_column IS NOT NULL GROUP BY ALL
UNION ALL
SELECT 'topic', sid, db, tb, value, arg_max(topic, id) FROM (
  SELECT sid, db, tb, id, '1' AS value, 't' || (id - 1) AS topic FROM {source} WHERE topic_column IS NOT NULL
  UNION ALL SELECT sid, db, tb, id, second_value, 'u' FROM {source} WHERE topic_column IS NOT NULL) GROUP BY ALL"""


def routes(table):
    def line(df, what, value, target):
        return df.select(F.lit(what).alias("what"), F.col("sid").cast("bigint").alias("sid"), "db", "tb",
                         value.alias("value"), F.col(target).alias("target"))
    return (line(ops.message_keys(table), "key", F.lit(""), "key_columns")
            .unionByName(line(ops.topic_columns(table), "column", F.lit(""), "topic_column"))
            .unionByName(line(ops.topic_map(table), "topic", F.col("value"), "topic")))


@query("message_routes", with_feeds("r", _routes("r0"), ACTIVE))
def message_routes(spark, sf_dir):
    return routes(active(spark, sf_dir))


@query("message_routes_after_drop", with_feeds("r", _routes("r1"),
                                               "r1 AS (SELECT * FROM r WHERE operation <> 4)"))
def message_routes_after_drop(spark, sf_dir):
    return routes(ops.apply_rule_changes(*in_force(spark, sf_dir)))


@query("bad_topic_rules", with_feeds("r", "SELECT sid, id, '{bad' AS message_topic_rule FROM r WHERE (id - 1) % 4 = 1"))
def bad_topic_rules(spark, sf_dir):
    found = ops.bad_topic_rules(rules(spark, sf_dir))
    return found.select(F.col("sid").cast("bigint").alias("sid"), F.col("id").cast("bigint").alias("id"),
                        "message_topic_rule")
