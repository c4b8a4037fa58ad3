"""Message rows: envelope text, topic and key."""

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.functions.scan import row_number
from rowtide.functions.text import (cell_text, cells_of, image_json, image_text, image_xml, json_quote,
                                    xml_escape)
from rowtide.operators.commands import LOG_BLOCK, SNAPSHOT_BLOCK
from rowtide.operators.rules import TABLE, message_plan, topic_map

# Partitions of a topic, if nothing else is said.
PARTITIONS = 16
CHANNEL = ["topic", "partition"]

# Fixed value: the root tag consumers of the XML form expect, as spelled.
XML_ROOT = "contenet"


# The helpers below give SQL text over the columns of a delivered event.

def images_in_order(pairs="pairs"):
    """Images of an event as published: each new image is followed by the old
    one it replaces."""
    return (f"flatten(transform({pairs}, p -> CASE WHEN event = 'update' THEN array(p.after, p.before) "
            f"ELSE array(p.after) END))")


def json_envelope(images=None, names=None, query=None, decimal_as="string", heads=None):
    """Envelope with header fields in fixed order, over columns sid, db, tb,
    sent_file, sent_pos, sent_time, event."""
    head = f"""'{{"sid":', sid, ',"dbname":', {json_quote('db')}, ',"tbname":', {json_quote('tb')},
      ',"filename":', {json_quote('sent_file')}, ',"position":', sent_pos, ',"event_time":', sent_time,
      ',"event":', {json_quote('event')}"""
    if query is not None:
        return f"""concat({head}, ',"query":', {json_quote(query)}, ',"columns":[]}}')"""
    body = f"array_join(transform({images}, im -> {image_json('im', names, decimal_as, heads)}), ',')"
    return f"""concat({head}, ',"columns":[', {body}, ']}}')"""


def xml_envelope(images=None, names=None, root=XML_ROOT, heads=None):
    body = f"array_join(transform({images}, im -> {image_xml('im', names, heads)}), '')" if images else "''"
    return f"""concat('<{root}><sid>', sid, '</sid><dbname>', {xml_escape('db')}, '</dbname><tbname>',
      {xml_escape('tb')}, '</tbname><filename>', {xml_escape('sent_file')}, '</filename><position>', sent_pos,
      '</position><event_time>', sent_time, '</event_time><event>', {xml_escape('event')}, '</event>',
      {body}, '</{root}>')"""


def messages(events, rules, default_topic, fmt="json", define_columns=True, decimal_as="string"):
    """Message rows of delivered events (see `normalize.deliver`).

    A table with key columns or a topic rule gives one message per row pair, any
    other table one per event. The key is set only for tables with key columns;
    the topic is looked up by the topic column's text in the new image.
    """
    if "sent_file" not in events.columns:
        events = (events.withColumn("sent_file", F.col("file")).withColumn("sent_pos", F.col("pos"))
                  .withColumn("sent_time", F.col("event_time")))
    plan = message_plan(rules, define_columns)
    df = join_control(events, plan, TABLE, "left")
    units = """CASE WHEN key_names IS NOT NULL OR topic_column IS NOT NULL
      THEN transform(pairs, (p, i) -> named_struct('row_ord', i, 'pairs', array(p)))
      ELSE array(named_struct('row_ord', 0, 'pairs', pairs)) END"""
    df = df.selectExpr(
        *TABLE, "event", "seg", "file", "pos", "event_ord", "event_time", "sent_file", "sent_pos",
        "sent_time", "key_names", "topic_column", "kept_names", "json_names", "json_heads", "xml_heads", f"inline({units})")
    if fmt == "json":
        value = json_envelope(images_in_order(), "json_names", decimal_as=decimal_as, heads="json_heads")
    elif fmt == "xml":
        value = xml_envelope(images_in_order(), "kept_names", heads="xml_heads")
    else:
        raise ValueError(f"unknown data format {fmt}")
    # Split units hold one pair; the last cell of the topic column's name counts.
    choice = (f"element_at(concat(array(''), transform({cells_of('pairs[0].after', 'array(topic_column)')}, "
              f"tc -> {cell_text('tc')})), -1)")
    rows = df.selectExpr(
        *TABLE, "seg", "file", "pos", "event_ord", "event_time", "row_ord",
        f"CASE WHEN key_names IS NOT NULL THEN {image_text('pairs[0].after', 'key_names')} END AS key",
        f"CASE WHEN topic_column IS NOT NULL THEN {choice} END AS _choice", f"{value} AS value")
    topics = topic_map(rules).withColumnRenamed("value", "_choice")
    routed = join_control(rows, topics, TABLE + ["_choice"], "left")
    return routed.select(
        F.coalesce("topic", F.lit(default_topic)).alias("topic"), "key", "value",
        "sid", "seg", "file", "pos", "event_time", "event_ord", "row_ord")


def ddl_messages(statements, default_topic, fmt="json"):
    """Message rows of `query` events. The XML form has no place for the text."""
    df = (statements.withColumn("sent_file", F.col("file")).withColumn("sent_pos", F.col("pos"))
          .withColumn("sent_time", F.col("event_time")))
    value = F.expr(json_envelope(query="query") if fmt == "json" else xml_envelope())
    return df.select(
        F.lit(default_topic).alias("topic"), F.lit(None).cast("string").alias("key"),
        value.alias("value"), "sid", "file", "pos", "event_time", "event_ord")


def numbered(rows, ledger=None, partitions=PARTITIONS, log_block=LOG_BLOCK, snapshot_block=SNAPSHOT_BLOCK):
    """Messages with `partition` and `seq`, their number in (topic, partition).

    Rows of one key go to one partition, rows without a key by their server id, so
    what must stay in order shares a partition, and `seq` follows the order of the
    log there. `ledger` holds (topic, partition, next): numbering goes on where
    earlier messages ended. Numbers are counted in blocks of the log, so a topic
    with a single partition is numbered in many tasks.
    """
    place = F.pmod(F.xxhash64(F.coalesce("key", F.concat(F.lit("\0"), F.col("sid").cast("string")))), F.lit(partitions))
    rows = rows.withColumns({"partition": place.cast("int"), "seg": F.coalesce("seg", F.lit(0).cast("bigint")),
                             "row_ord": F.coalesce("row_ord", F.lit(0)), "file": F.coalesce("file", F.lit("")),
                             "pos": F.coalesce("pos", F.lit(0).cast("bigint")), "event_ord": F.coalesce("event_ord", F.lit(0).cast("bigint"))})
    # Blocks are a prefix of the order: a stretch of the log or, as the rows of a snapshot lie at one place, of events.
    logged = (F.col("file") != "") & (F.col("seg") % 2 == 0)
    rows = rows.withColumn("_blk", F.when(logged, F.floor(F.col("pos") / log_block)).otherwise(F.floor(F.col("event_ord") / snapshot_block)))
    # Snapshot blocks span positions only if several snapshots share a file and segment: the position leads then.
    rows = rows.withColumn("_at", F.when(logged, F.lit(0).cast("bigint")).otherwise(F.col("pos")))
    made = row_number(rows, CHANNEL, ["seg", "file", "_at", "_blk"], ["pos", "event_ord", "row_ord", "sid", "value"], "seq").drop("_blk", "_at")
    if ledger is None:
        return made.withColumn("seq", F.col("seq") - 1)
    made = join_control(made, ledger, CHANNEL, "left")
    return made.withColumn("seq", F.col("seq") - 1 + F.coalesce("next", F.lit(0).cast("bigint"))).drop("next")


def next_numbers(rows, ledger=None):
    """The ledger after numbered rows: (topic, partition, next)."""
    reached = rows.groupBy(*CHANNEL).agg((F.max("seq") + 1).alias("next"))
    if ledger is None:
        return reached
    return reached.unionByName(ledger.select(*reached.columns)).groupBy(*CHANNEL).agg(F.max("next").alias("next"))


def in_send_order(rows):
    """Numbered messages as a sender must take them: each channel whole in one
    task, by number. A channel is a serial log, so it has one writer at a time;
    rows are sorted with spilling and pass by one after the other."""
    return rows.repartition(*CHANNEL).sortWithinPartitions(*CHANNEL, "seq")
