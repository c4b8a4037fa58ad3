"""Feeds of row events, snapshots as inserts, and the cuts between the two."""

from functools import reduce

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.schema import EVENTS_RAW, OP_ACTIVE, UNREADABLE


def read_events(spark, path, fmt="parquet"):
    """Row events from files."""
    return spark.read.schema(EVENTS_RAW).format(fmt).load(path)


def stream_events(spark, path, fmt="parquet", schema=EVENTS_RAW, **options):
    """Row events as a stream over a folder that receives log files in order.
    `schema` is EVENTS_CHANGED if statements list the tables they change."""
    reader = spark.readStream.schema(schema).format(fmt)
    for name, value in options.items():
        reader = reader.option(name, value)
    return reader.load(path)


def stream_topic(spark, **options):
    """Row events as a stream from a message topic of JSON events; needs the
    Kafka connector. Option names are written with underscores for dots."""
    reader = spark.readStream.format("kafka")
    for name, value in options.items():
        reader = reader.option(name.replace("_", "."), value)
    return parse_events(reader.load())


def database_table(spark, url, table, column, lower, upper, parts, **properties):
    """A source table read over JDBC in parallel ranges of a numeric column, for
    snapshots straight from a replica."""
    return spark.read.jdbc(url, table, column=column, lowerBound=lower, upperBound=upper,
                           numPartitions=parts, properties=properties)


def parse_events(df, value="value"):
    """Row events from a text column of JSON, as a message topic delivers them.
    Text that is no event stays as one of kind "unreadable" with the text as its
    query, for the dead letters."""
    text = F.col(value).cast("string")
    parsed = df.select(F.from_json(text, EVENTS_RAW).alias("e"), text.alias("_text")).select("e.*", "_text")
    bad = F.col("event").isNull()
    return parsed.select(*[
        F.when(bad, F.lit(UNREADABLE)).otherwise(F.col(c)).alias(c) if c == "event"
        else F.when(bad, F.col("_text")).otherwise(F.col(c)).alias(c) if c == "query" else F.col(c)
        for c in EVENTS_RAW.names])


def _type_tag(dtype):
    kind = dtype.typeName()
    if kind in ("byte", "short", "integer", "long"):
        return "int"
    if kind in ("float", "double"):
        return "float"
    return {"decimal": "decimal", "binary": "binary"}.get(kind, "string")


def typed_columns(df, names):
    """Literal ARRAY<STRUCT<name,type>> for chosen columns of a table."""
    kinds = {f.name: _type_tag(f.dataType) for f in df.schema.fields}
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(kinds[n]).alias("type")) for n in names])


def positional_row(names):
    """A row image in positional form: every value as text."""
    return F.array(*[F.col(n).cast("string") for n in names])


def snapshot_events(df, sid, db, tb, columns, order_key, at=("", 0), seg=0):
    """A whole table as insert events. They carry no log position and time 0;
    `order_key`, a BIGINT, orders them among themselves. A resync passes the
    position at which reading paused."""
    return df.select(
        F.lit(sid).alias("sid"),
        F.lit(db).alias("db"),
        F.lit(tb).alias("tb"),
        F.lit("insert").alias("event"),
        F.lit(at[0]).alias("file"),
        F.lit(at[1]).cast("bigint").alias("pos"),
        F.lit(0).cast("bigint").alias("event_time"),
        F.lit(None).cast("bigint").alias("tx_id"),
        F.col(order_key).cast("bigint").alias("event_ord"),
        F.lit(True).alias("is_snapshot"),
        typed_columns(df, columns).alias("table_columns"),
        F.array(positional_row(columns)).alias("rows"),
        F.lit(None).cast("string").alias("query"),
        F.lit(seg).cast("bigint").alias("seg"),
    )


def parse_table_list(text):
    """Tables of a resync request "db.tb, db.tb2"; malformed entries are skipped."""
    tables = []
    for entry in text.split(","):
        parts = entry.split(".")
        if len(parts) == 2:
            tables.append((parts[0].strip(), parts[1].strip()))
    return tables


def resync_events(spark, text, tables, sid, at=("", 0), seg=0):
    """Insert events for every table of a resync request.

    `tables` maps (db, tb) to a function of (spark) giving the table with its
    column list and order key. Only upserts: keys the table no longer has stay.
    """
    parts = []
    for db, tb in parse_table_list(text):
        if (db, tb) in tables:
            df, columns, order_key = tables[(db, tb)](spark)
            parts.append(snapshot_events(df, sid, db, tb, columns, order_key, at, seg))
    if not parts:
        raise ValueError("no table to read")
    return reduce(lambda a, b: a.unionByName(b), parts)


def after_position(df, file, pos):
    """Rows of the log after a saved position. The first condition alone is one
    that files and row groups can be skipped by."""
    return df.where((F.col("file") >= file) & ((F.col("file") > file) | (F.col("pos") > F.lit(pos).cast("bigint"))))


def snapshot_then_changes(snapshot, changes, file, pos):
    """A snapshot and the changes after the position at which it was taken."""
    return snapshot.unionByName(after_position(changes, file, pos), allowMissingColumns=True)


def insert_resync(changes, resync, file, pos):
    """Place resync rows in the order: after the events at the position where
    reading paused, before all later ones."""
    late = F.struct("file", "pos") > F.struct(F.lit(file), F.lit(pos).cast("bigint"))
    shifted = changes.withColumn("seg", F.col("seg") + F.when(late, 2).otherwise(0))
    placed = (resync.withColumn("seg", F.col("seg") + 1)
              .withColumn("file", F.lit(file)).withColumn("pos", F.lit(pos).cast("bigint")))
    return shifted.unionByName(placed, allowMissingColumns=True)


def passed(places, reached):
    """How many of the places (sid, file, pos) a row of a log has behind it, as a column; where `reached` holds, its
    own place counts as well."""
    if not places:
        return F.lit(0)
    listed = F.array(*[F.struct(F.lit(s).alias("sid"), F.lit(f).alias("file"), F.lit(p).cast("bigint").alias("pos"))
                       for s, f, p in places])
    here = F.struct("file", "pos")

    def behind(p):
        there = F.struct(p["file"].alias("file"), p["pos"].alias("pos"))
        return (p["sid"] == F.col("sid")) & ((there < here) | (reached & (there == here)))
    return F.size(F.filter(listed, behind))


def resync_places(events):
    """Where the log was paused for the resyncs among events: (sid, file, pos)."""
    return events.where(F.col("is_snapshot") & (F.col("file") != "")).select("sid", "file", "pos").distinct()


def in_segments(events, places):
    """Events with `seg`: a resync comes after the log up to its place and before the rest of its server's log."""
    resync = F.coalesce(F.col("is_snapshot") & (F.col("file") != ""), F.lit(False))
    before = F.coalesce(passed(places, F.lit(False)), F.lit(0)).cast("bigint")
    return events.withColumn("seg", before * 2 + F.when(resync, 1).otherwise(0))


def active_rules(rules, sid=None):
    """Rules in force, of one server id or of all."""
    active = rules.where(F.col("operation") == OP_ACTIVE)
    return active if sid is None else active.where(F.col("sid") == sid)


def include_tables(rules):
    """Tables that have rules."""
    return rules.select("sid", "db", "tb").distinct()


def monitored(events, rules):
    """Events of tables that have rules."""
    return join_control(events, include_tables(rules), ["sid", "db", "tb"], "left_semi")


def unmonitored(events, rules):
    """Events of tables without a rule, for the dead letters."""
    return join_control(events, include_tables(rules), ["sid", "db", "tb"], "left_anti")


def snapshot_tables(rules):
    """Tables of which some rule asks for a snapshot, each once."""
    return rules.where(F.col("is_dump") == 1).select("sid", "db", "tb").distinct()
