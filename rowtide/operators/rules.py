"""Jobs over the rule table: checks, changes, routing maps, compiled form."""

from pyspark.sql import functions as F

from rowtide.functions.codec import level_ok
from rowtide.functions.text import json_heads, split_trim, trim_space, xml_heads
from rowtide.schema import OP_ADD, OP_DROP, TARGET_TYPES, with_defaults
from rowtide.sources.feed import passed

TABLE = ["sid", "db", "tb"]
TOPIC_RULE = "column_name STRING, topic_rule MAP<STRING,STRING>, broken STRING"


def _blank(col):
    return F.replace(col, F.lit(" "), F.lit("")) == ""


def rule_violations(rules, with_targets=True):
    """Every broken constraint of every rule: (id, field, value).

    One violation rejects the whole set. Message-only runs are not checked.
    """
    if not with_targets:
        rules = rules.limit(0)
    clauses = F.split("filter_rule", ",")
    checks = [
        ("refresh_type", ~F.col("refresh_type").isin(0, 1)),
        ("is_dump", ~F.col("is_dump").isin(0, 1)),
        ("is_compress", ~F.col("is_compress").between(0, 4)),
        ("expire_time", F.col("expire_time") <= 0),
        ("expire_range", ~F.col("expire_range").between(0, 50)),
        ("is_full_column", ~F.col("is_full_column").isin(0, 1)),
        ("target_key_prefix", _blank(F.col("target_key_prefix"))),
        ("target_key_type", ~F.col("target_key_type").isin(*TARGET_TYPES)),
        ("filter_rule", ~_blank(F.col("filter_rule"))
         & F.exists(clauses, lambda c: F.size(F.split(c, "=")) != 2)),
    ]
    found = F.array(*[
        F.when(bad, F.struct(F.lit(name).alias("field"), F.col(name).cast("string").alias("value")))
        for name, bad in checks])
    return rules.select("sid", "id", F.inline(F.filter(found, lambda v: v.isNotNull())))


def prefix_conflicts(rules):
    """Rules whose key prefix an earlier rule uses with another target type."""
    first = rules.groupBy("sid", "target_key_prefix").agg(
        F.min_by("target_key_type", "id").alias("first_type"))
    return (rules.join(first, ["sid", "target_key_prefix"])
            .where(F.col("target_key_type") != F.col("first_type"))
            .select("sid", "id", "target_key_prefix", "target_key_type", "first_type"))


def rules_by_table(rules):
    """Number of rules and the first rule of each table."""
    return rules.groupBy(*TABLE).agg(
        F.count(F.lit(1)).alias("n_rules"), F.min("id").alias("first_id"))


def apply_rule_changes(current, pending):
    """Rules after pending changes: added ones appended, dropped ones removed by
    id within their table; a drop of an unknown rule is ignored."""
    added = pending.where(F.col("operation") == OP_ADD)
    dropped = pending.where(F.col("operation") == OP_DROP).select(*TABLE, "id").distinct()
    return current.join(dropped, TABLE + ["id"], "left_anti").select(*current.columns).unionByName(added)


def versions(events, rules):
    """(events, rules in force for them) for each state the rules were in.

    `rules` may hold pending changes with the position (`file`, `pos`) of their
    server's log after which they are in force. A resync read at that position
    already follows the changed rules. One pass per state, so acknowledged changes
    should leave the table; their distinct positions are gathered, no rows.
    """
    if not {"file", "pos"} <= set(rules.columns):
        return [(events, rules)]
    pending = F.coalesce(F.col("operation").isin(OP_ADD, OP_DROP), F.lit(False))
    places = [tuple(r) for r in rules.where(pending).select("sid", "file", "pos").distinct().collect()]
    numbered = rules.withColumn("_from", F.when(pending, passed(places, F.lit(True))).otherwise(0)).drop("file", "pos")
    drops = numbered.where(F.col("operation") == OP_DROP).select(*TABLE, "id", F.col("_from").alias("_until"))
    rows = numbered.where(F.col("operation") != OP_DROP)
    resync = F.coalesce("is_snapshot", F.lit(False))
    events = events.withColumn("_version", F.coalesce(passed(places, resync), F.lit(0)))
    last = max((sum(p[0] == sid for p in places) for sid in {p[0] for p in places}), default=0)
    out = []
    for v in range(last + 1):
        gone = drops.where(F.col("_until") <= v)
        hit = [rows[c] == gone[c] for c in [*TABLE, "id"]] + [rows["_from"] < gone["_until"]]
        now = rows.where(F.col("_from") <= v).join(gone, hit, "left_anti").drop("_from")
        now = now.withColumn("operation", F.when(F.col("operation") == OP_ADD, 0).otherwise(F.col("operation")))
        out.append((events.where(F.col("_version") == v).drop("_version"), now))
    return out


def tables_to_snapshot(pending):
    """Tables of added rules that ask for a snapshot."""
    return (pending.where((F.col("operation") == OP_ADD) & (F.col("is_dump") == 1))
            .select(*TABLE).distinct())


def tables_dropped(current, pending):
    """Tables that lost a rule."""
    dropped = pending.where(F.col("operation") == OP_DROP).select(*TABLE, "id").distinct()
    return current.join(dropped, TABLE + ["id"], "left_semi").select(*TABLE).distinct()


def acknowledge(rules):
    """The stored table once changes are in force: adds become active, drops go."""
    op = F.col("operation")
    return rules.where(op != OP_DROP).withColumn(
        "operation", F.when(op == OP_ADD, 0).otherwise(op))


def message_keys(rules):
    """Key column list per table: the last non-empty one."""
    return (rules.where(F.col("message_key_columns") != "").groupBy(*TABLE)
            .agg(F.max_by("message_key_columns", "id").alias("key_columns")))


def _parsed_topics(rules):
    parsed = F.from_json("message_topic_rule", TOPIC_RULE, {"columnNameOfCorruptRecord": "broken"})
    return rules.where(F.col("message_topic_rule") != "").withColumn("_r", parsed)


def _topic_rules(rules):
    return _parsed_topics(rules).where(F.col("_r.broken").isNull())


def topic_columns(rules):
    """Column that picks the topic, per table: that of the last topic rule."""
    return (_topic_rules(rules).groupBy(*TABLE)
            .agg(F.max_by(F.coalesce("_r.column_name", F.lit("")), "id").alias("topic_column")))


def topic_map(rules):
    """Topic per table and column value; later rules win."""
    return (_topic_rules(rules).select(*TABLE, "id", F.explode("_r.topic_rule").alias("value", "topic"))
            .groupBy(*TABLE, "value").agg(F.max_by("topic", "id").alias("topic")))


def bad_topic_rules(rules):
    """Rules whose topic rule is no valid JSON object."""
    return (_parsed_topics(rules).where(F.col("_r.broken").isNotNull())
            .select("sid", "id", "message_topic_rule"))


def clauses(col):
    """Filter clauses that take part: those before the first malformed one.

    Clauses are read left to right; a mismatch fails the row, and a malformed
    clause ends the reading and lets it pass, so later ones never count.
    """
    parts = F.transform(split_trim(col), lambda c: F.split(c, "="))
    bad = F.array_position(F.transform(parts, lambda p: F.size(p) != 2), True)
    good = F.when(bad == 0, parts).otherwise(
        F.slice(parts, F.lit(1), F.greatest(bad - 1, F.lit(0)).cast("int")))
    return F.transform(good, lambda p: F.struct(
        trim_space(p[0]).alias("name"), trim_space(p[1]).alias("value")))


def compile_rules(rules):
    """What the row jobs need of a rule, worked out once per rule: lists split
    and trimmed, filter clauses parsed, TTL bounds computed, type conflicts
    marked."""
    rules = with_defaults(rules)
    # Types can only meet in one key: the prefix itself for sets, and for values
    # and hashes without key columns; else the prefix and key texts. Of the rules
    # that write, the first settles the type.
    at_prefix = F.col("target_key_type").isin("set", "zset") | (trim_space(F.col("target_key_columns")) == "")
    rules = rules.withColumn("_at_prefix", at_prefix)
    writes = (F.col("refresh_type") != 0) & F.col("target_key_type").isin(*TARGET_TYPES)
    first = rules.where(writes).groupBy("sid", "target_key_prefix", "_at_prefix").agg(
        F.min_by("target_key_type", "id").alias("_first_type"))
    base = F.when(F.col("expire_time") == 0, 86400).otherwise(F.col("expire_time")).cast("bigint")
    spread = F.col("expire_range").cast("bigint")
    jitter = (spread > 0) & (spread < 100)
    full = F.col("is_full_column") > 0
    kept = split_trim(F.col("replic_columns"))
    no_names = F.lit(None).cast("array<string>")
    return rules.join(first, ["sid", "target_key_prefix", "_at_prefix"], "left").select(
        *TABLE, F.col("id").alias("rule_id"),
        F.col("target_key_type").alias("target_type"),
        F.col("target_key_prefix").alias("prefix"),
        split_trim(F.col("target_key_columns")).alias("key_names"),
        F.when(full, no_names).otherwise(kept).alias("kept_names"),
        F.when(full, no_names).otherwise(F.sort_array(F.array_distinct(kept))).alias("json_names"),
        F.when(F.col("filter_rule") == "", F.array().cast("array<struct<name:string,value:string>>"))
        .otherwise(clauses(F.col("filter_rule"))).alias("clauses"),
        trim_space(F.col("target_zset_score_column")).alias("score_name"),
        F.when(jitter, F.floor(base * (100 - spread) / 100)).otherwise(base).alias("ttl_low"),
        F.when(jitter, F.floor(2 * base * spread / 100)).otherwise(F.lit(0)).alias("ttl_span"),
        (F.col("refresh_type") == 0).alias("invalidate"),
        (F.col("delay_del") != 0).alias("delayed"),
        F.col("delay_expire_time").cast("bigint").alias("delay_ttl"),
        F.col("is_compress").alias("enc"),
        F.col("compress_level").alias("enc_level"),
        F.when(F.col("compress_columns") == "", F.array().cast("array<string>"))
        .otherwise(split_trim(F.col("compress_columns"))).alias("enc_names"),
        F.when(~F.col("target_key_type").isin(*TARGET_TYPES), "unsupported type")
        .when((F.col("refresh_type") != 0) & (F.col("_first_type") != F.col("target_key_type")), "type conflict")
        .when(F.col("is_compress").isin(1, 2) & ~level_ok(F.col("compress_level")), "bad compress level")
        .alias("rule_error"),
    ).withColumn("json_heads", F.expr(json_heads("json_names")))


def message_plan(rules, define_columns=True):
    """Per table: key columns, topic column, and the names to publish (from the
    first rule; NULL for all)."""
    names = rules.groupBy(*TABLE).agg(F.min_by(F.struct(
        "message_is_full_column", "message_replic_columns"), "id").alias("_f"))
    full = (F.lit(not define_columns)) | (F.col("_f.message_is_full_column") == 1)
    kept = split_trim(F.col("_f.message_replic_columns"))
    return (names.join(message_keys(rules), TABLE, "left").join(topic_columns(rules), TABLE, "left")
            .select(*TABLE,
                    split_trim(F.col("key_columns")).alias("key_names"), "topic_column",
                    F.when(~full, kept).alias("kept_names"),
                    F.when(~full, F.sort_array(F.array_distinct(kept))).alias("json_names"))
            .withColumns({"json_heads": F.expr(json_heads("json_names")), "xml_heads": F.expr(xml_heads("kept_names"))}))
