"""From positional row events to named images, changes, and delivered batches."""

from pyspark.sql import Window, functions as F

from rowtide.functions.joins import join_control
from rowtide.schema import COMMIT

# Fixed value: a transaction's buffer is sent early once it holds nine events.
EARLY_CHUNK = 9
# Rows of a transaction are numbered in blocks of this many event ordinals.
TX_BLOCK = 1 << 16
ROW_EVENTS = ["insert", "update", "delete"]


def named_image(columns, row):
    """Name the i-th value by the i-th column. A row shorter than the column
    list ends early; surplus values are dropped."""
    width = F.least(F.size(columns), F.size(row))
    return F.transform(F.slice(columns, F.lit(1), width), lambda c, i: F.struct(
        c["name"].alias("name"), c["type"].alias("type"), row[i].alias("value")))


def normalize_events(raw):
    """Events with `pairs`, an array of (after, before) images.

    Rows of an update come as before, after, before, after...; those of an
    insert or delete are single images and stand in the after slot.
    """
    cols, rows = F.col("table_columns"), F.col("rows")
    none = F.lit(None).cast("array<struct<name:string,type:string,value:string>>")
    n_pairs = (F.size(rows) / 2).cast("int")
    updates = F.when(n_pairs > 0, F.transform(
        F.sequence(F.lit(0), F.greatest(n_pairs, F.lit(1)) - 1),
        lambda i: F.struct(named_image(cols, rows[i * 2 + 1]).alias("after"),
                           named_image(cols, rows[i * 2]).alias("before"))))
    singles = F.transform(rows, lambda r: F.struct(
        named_image(cols, r).alias("after"), none.alias("before")))
    if "seg" not in raw.columns:
        raw = raw.withColumn("seg", F.lit(0).cast("bigint"))
    return raw.withColumn(
        "pairs", F.when(F.col("event") == "update", updates).otherwise(singles)
    ).drop("table_columns", "rows")


def to_changes(events):
    """One line per row pair."""
    keep = [c for c in events.columns if c not in ("pairs", "query")]
    # The outer form: for the inner one the optimizer adds a check for empty
    # arrays below, which would work out all images a second time.
    return (events.where(F.col("event").isin(*ROW_EVENTS))
            .select(*keep, F.posexplode_outer("pairs").alias("row_ord", "pair"))
            .where(F.col("row_ord").isNotNull())
            .select(*keep, "row_ord", "pair.after", "pair.before"))


def deliver(raw, tx_block=TX_BLOCK):
    """Transaction chunks as the consumers see them.

    Events of a transaction wait for its commit, but nine waiting events leave
    early: without a position, the ninth also without a time. What is left at
    the commit carries the commit's position: that of its mark if the feed has
    commit marks (which are not delivered themselves), else of the last event. Snapshot events are sent alone, and
    so are events that belong to no known transaction, with their own position.

    Adds n (ordinal in the transaction), chunk_no, sent_file, sent_pos and
    sent_time. Works on events of any form; positional ones are the narrowest
    to shuffle, which happens once.
    """
    keys, block = ["sid", "tx_id"], ["_blk"]
    snapshot = F.coalesce("is_snapshot", F.lit(False))
    loose = F.col("tx_id").isNull() | F.col("sid").isNull()
    ord = F.coalesce("event_ord", F.lit(0))
    tx = raw.where(~snapshot & ~loose).withColumn("_blk", F.floor(ord / tx_block))
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    mark = F.col("event") == COMMIT
    stretches = tx.groupBy(*keys, *block).agg(
        F.count(F.when(mark, None).otherwise(1)).alias("_n"), F.max(F.struct("file", "pos")).alias("_last")).select(
        *keys, *block, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_carry"),
        F.sum("_n").over(whole).alias("_events"), F.max("_last").over(whole).alias("_commit"))
    inside = Window.partitionBy(*keys, *block).orderBy(ord, "file", "pos")
    numbered = tx.where(~F.coalesce(mark, F.lit(False))).join(stretches, keys + block).withColumn(
        "n", F.row_number().over(inside).cast("bigint") + F.col("_carry"))
    n = F.col("n")
    chunk = F.floor((n - 1) / EARLY_CHUNK)
    early = chunk < F.floor(F.col("_events") / EARLY_CHUNK)
    sent = numbered.select(
        *raw.columns, "n",
        chunk.alias("chunk_no"),
        F.when(early, F.lit("")).otherwise(F.col("_commit.file")).alias("sent_file"),
        F.when(early, F.lit(0)).otherwise(F.col("_commit.pos")).cast("bigint").alias("sent_pos"),
        F.when(early & (n % EARLY_CHUNK == 0), F.lit(0))
        .otherwise(F.col("event_time")).cast("bigint").alias("sent_time"))
    alone = raw.where(snapshot | loose).select(
        *raw.columns,
        F.lit(1).cast("bigint").alias("n"),
        F.lit(0).cast("bigint").alias("chunk_no"),
        F.when(snapshot, F.lit("")).otherwise(F.col("file")).alias("sent_file"),
        F.when(snapshot, F.lit(0)).otherwise(F.col("pos")).cast("bigint").alias("sent_pos"),
        F.when(snapshot, F.lit(0)).otherwise(F.col("event_time")).cast("bigint").alias("sent_time"))
    return sent.unionByName(alone)


def commits(raw):
    """Transactions whose commit mark is among the events: (sid, tx_id)."""
    return raw.where((F.col("event") == COMMIT) & F.col("tx_id").isNotNull() & F.col("sid").isNotNull()).select("sid", "tx_id").distinct()


def split_open(raw, done):
    """(events that can go on, events that wait) of a feed with commit marks.

    `done` are the `commits` known. Row events wait for the mark of their
    transaction; snapshot rows, statements and events of no transaction never do.
    """
    snapshot = F.coalesce("is_snapshot", F.lit(False))
    bound = ~snapshot & F.col("event").isin(*ROW_EVENTS, COMMIT) & F.col("tx_id").isNotNull() & F.col("sid").isNotNull()
    bound = F.coalesce(bound, F.lit(False))
    inside = raw.where(bound)
    on = ["sid", "tx_id"]
    return raw.where(~bound).unionByName(join_control(inside, done, on, "left_semi")), join_control(inside, done, on, "left_anti")
