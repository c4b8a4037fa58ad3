"""The key-value state a list of commands leads to.

Two aggregates describe any stretch of the log, and both can be merged:

* key lines, one per (key, block): what the stretch does to the key's life —
  clean-ups before its first write, the first write, how it ends, and the last
  write that is known to have found the key dead;
* item lines, one per (key, item): the last operation on a string's value, a
  hash field, or a member.

A key's life is the chain of its lines. Its epoch starts at the last write that
found the key dead; items whose last operation is older are gone. Blocks are
bounded stretches of the log, so a key that takes a third of the feed is
scanned in as many tasks as the feed has blocks, and items are combined before
they are shuffled. Lines of consecutive stretches join to the line of the whole
stretch, whatever came before it; so a key with more lines than one task should
chain is joined by ranges of the order, file by file, then over runs of files.
"""

from pyspark.sql import Window, functions as F

from rowtide.functions.codec import compress
from rowtide.functions.joins import join_control, join_salted
from rowtide.schema import BLOCK, KEY, ORDER
from rowtide.session import written

ITEM = KEY + ["item", "enc", "enc_level"]
# Lines of a key that one task chains; a key with more is joined range by range.
CHAIN = 4096
RANGE_BLOCKS = 1024


def _place():
    return F.struct(*ORDER)


def ranges_of(blocks, seg, file, blk, width):
    """Nested ranges of the order, finer ones first, as columns: runs of blocks, files, then runs of
    files whose names (of at most `width` characters) start alike, which lie side by side in the order."""
    names = [F.coalesce(F.left(file, F.lit(max(width - cut, 0))), F.lit("")) for cut in (0, 2, 4, 6)]
    return [[seg, names[0], F.floor(blk / blocks)]] + [[seg, name] for name in names]


def look(commands, chain=CHAIN):
    """The target types among commands, and the longest file name if a key may be in over `chain` blocks, else None."""
    types, blocks, width = commands.agg(
        F.collect_set("target_type"), F.approx_count_distinct(F.struct("sid", *BLOCK)),
        F.coalesce(F.max(F.length("file")), F.lit(0))).first()
    return sorted(types), width if blocks > chain else None


def _split(df, chain):
    """Rows of keys with at most `chain` rows, and those of the others, None if there are none."""
    df = written(df.sparkSession, df)
    hot = written(df.sparkSession, df.groupBy(*KEY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > chain).select(*KEY))
    if hot.isEmpty():
        return df, None
    return join_control(df, hot, KEY, "left_anti"), join_control(df, hot, KEY, "left_semi")


def _in_range(df, by):
    """The rows with the columns of a range, and the names of those columns."""
    names = [f"_r{i}" for i in range(len(by))]
    return df.withColumns(dict(zip(names, by))), names


def _reached(spans, ranges=()):
    """Spans with the latest time of the key's earlier blocks."""
    along = Window.orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    if not ranges:
        return spans.withColumn("reached", F.max("hi").over(along.partitionBy(*KEY)))
    spans, by = _in_range(spans, ranges[0])
    whole = spans.groupBy(*KEY, *by).agg(F.min(F.struct(*BLOCK)).alias("_b"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    before = _reached(whole.select(*KEY, *by, "_b.*", "lo", "hi").withColumnsRenamed({b: f"_{b}" for b in by}), ranges[1:])
    before = before.select(*KEY, *[F.col(f"_{b}").alias(b) for b in by], F.col("reached").alias("_before"))
    return (spans.withColumn("reached", F.max("hi").over(along.partitionBy(*KEY, *by))).join(before, KEY + by)
            .withColumn("reached", F.greatest("reached", "_before")).drop(*by, "_before"))


def _steps_back(ops):
    """Whether a block of some server starts before the time an earlier one of its blocks has reached; if none
    does, no key's block does."""
    blocks = ops.groupBy("sid", *BLOCK).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    before = Window.partitionBy("sid").orderBy(*BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return not blocks.withColumn("reached", F.max("hi").over(before)).where(F.col("reached") > F.col("lo")).isEmpty()


def _stepped(ops, clocks, width, chain):
    """(key, block, reached) of the blocks that start before the time an earlier block of the key has reached."""
    spans = ops.groupBy(*KEY, *BLOCK).agg(F.min("t").alias("lo"), F.max("t").alias("hi"))
    if clocks is not None:
        first = clocks.select(
            *KEY, F.lit(-1).cast("bigint").alias("seg"), F.lit("").alias("file"),
            F.lit(0).cast("bigint").alias("blk"), F.col("clock").alias("lo"), F.col("clock").alias("hi"))
        spans = spans.unionByName(first)
    if width is None:
        spans = _reached(spans)
    else:
        few, many = _split(spans, chain)
        spans = _reached(few)
        if many is not None:
            spans = spans.unionByName(_reached(many, ranges_of(RANGE_BLOCKS, *map(F.col, BLOCK), width)))
    return spans.where(F.col("reached") > F.col("lo")).select(*KEY, *BLOCK, "reached")


def for_every_type(commands, types):
    """Commands with what they mean for keys of other types.

    A server has one entry under a key. Dropping the key drops it whatever its
    type, and a plain value replaces it; so for each other type of `types` there
    is a DEL at the same place. With one type there is nothing to add.
    """
    if len(types) < 2:
        return commands
    ends = (F.col("op") == "DEL") | (F.col("op") == "WRITE") & (F.col("target_type") == "string")
    others = F.filter(F.array(*map(F.lit, types)), lambda t: t != F.col("target_type"))
    empty = {c: F.lit(None).cast(commands.schema[c].dataType) for c in ("ttl", "value", "fields", "score") if c in commands.columns}
    added = commands.where(ends).withColumns({"op": F.lit("DEL"), "_type": F.explode(others), **empty})
    return commands.unionByName(added.withColumn("target_type", F.col("_type")).drop("_type"))


def key_lines(commands, clocks=None, width=None, chain=CHAIN):
    """Life of each key in each block, of commands `for_every_type`.

    `clocks` holds (key, clock): the latest time seen before these commands. `width` is
    that of `look`.
    """
    # A clean-up without a ttl changes no deadline, but it moves the clock.
    ops = commands.select(*KEY, *ORDER, "blk", "t", "ttl", "op")

    # The clock never steps back. Blocks that start before the time an earlier
    # block has reached are rare, so the lookup is against a short list, and in an
    # ordered log there are none, which a line per block of the log tells.
    if clocks is None and not _steps_back(ops):
        ops = ops.withColumn("reached", F.lit(None).cast(ops.schema["t"].dataType))
    else:
        ops = ops.join(_stepped(ops, clocks, width, chain), KEY + BLOCK, "left")

    inside = Window.partitionBy(*KEY, *BLOCK).orderBy(
        "pos", "event_ord", "phase", "row_ord", "rule_id")
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    write = F.col("op") == "WRITE"
    seq = (ops.withColumn("t", F.greatest(F.max("t").over(so_far), "reached"))
           .withColumn("dl", F.col("t") + F.col("ttl"))
           .withColumn("n", F.row_number().over(inside))
           .withColumn("prev_dl", F.last("dl", ignorenulls=True).over(before))
           .withColumn("last_write", F.max(F.when(write, F.col("n"))).over(so_far))
           .withColumn("dies", ~write & ((F.col("op") == "DEL")
                                         | F.coalesce(F.col("t") >= F.col("prev_dl"), F.lit(False))))
           .withColumn("broken", F.coalesce(F.max(F.when(F.col("dies"), F.col("n"))).over(so_far), F.lit(0))
                       > F.coalesce("last_write", F.lit(0)))
           .withColumn("prev_broken", F.lag("broken").over(inside))
           .withColumn("prev_write", F.lag("last_write").over(inside)))
    head = F.col("last_write").isNull()
    reborn = write & F.col("prev_write").isNotNull() & (
        F.col("prev_broken") | (F.col("t") >= F.col("prev_dl")))
    return seq.groupBy(*KEY, *BLOCK).agg(
        F.min(_place()).alias("at"),
        F.max("t").alias("clock"),
        # When the key must still live: at the first change of its deadline.
        F.coalesce(F.min(F.when(head & F.col("dl").isNotNull(), F.col("t"))), F.max(F.when(head, F.col("t")))).alias("head_t"),
        F.coalesce(F.max(F.when(head, F.col("dies"))), F.lit(False)).alias("head_broken"),
        F.max_by("dl", F.when(head & F.col("dl").isNotNull(), F.col("n"))).alias("head_dl"),
        F.min(F.when(write, F.col("t"))).alias("write_t"),
        F.min(F.when(write, _place())).alias("write_at"),
        F.max_by("dl", F.when(~head & F.col("dl").isNotNull(), F.col("n"))).alias("tail_dl"),
        F.max_by("broken", "n").alias("tail_broken"),
        F.max(F.when(reborn, _place())).alias("reborn_at"),
    ).drop("seg", "file")


def joined(lines, by=()):
    """The lines of each key and range as one line; `by` are the columns of the range."""
    none = F.lit(None).cast(lines.schema["reborn_at"].dataType)
    lines, by = _in_range(lines, by)
    part = F.struct
    steps = lines.withColumn("s", F.explode(F.array_compact(F.array(
        F.when(F.col("head_t").isNotNull(), part(
            F.lit(0).alias("seq"), F.col("head_t").alias("t"), F.col("head_dl").alias("dl"),
            F.col("head_broken").alias("bad"), none.alias("write_at"), none.alias("reborn_at"))),
        F.when(F.col("write_t").isNotNull(), part(
            F.lit(1).alias("seq"), F.col("write_t").alias("t"), F.col("tail_dl").alias("dl"),
            F.col("tail_broken").alias("bad"), F.col("write_at").alias("write_at"),
            F.col("reborn_at").alias("reborn_at"))),
    )))).select(*KEY, *by, "at", "blk", "clock", "s.*")
    along = Window.partitionBy(*KEY, *by).orderBy("at", "seq")
    so_far = along.rowsBetween(Window.unboundedPreceding, 0)
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    write, timed = F.col("seq") == 1, F.col("dl").isNotNull()
    late = F.coalesce(F.col("t") >= F.col("prev_dl"), F.lit(False))
    chain = (steps.withColumn("n", F.row_number().over(along))
             .withColumn("prev_dl", F.last("dl", ignorenulls=True).over(before))
             .withColumn("last_write", F.max(F.when(write, F.col("n"))).over(so_far))
             .withColumn("dies", F.col("bad") | (~write & late))
             .withColumn("broken", F.coalesce(F.max(F.when(F.col("dies"), F.col("n"))).over(so_far), F.lit(0))
                         >= F.coalesce("last_write", F.lit(1)))
             .withColumn("prev_broken", F.lag("broken").over(along))
             .withColumn("prev_write", F.lag("last_write").over(along)))
    head = F.col("last_write").isNull()
    # Whether the first write found the key dead is known by what came before the range.
    reborn = F.coalesce("reborn_at", F.when(F.col("prev_write").isNotNull() & (F.col("prev_broken") | late), F.col("write_at")))
    return chain.groupBy(*KEY, *by).agg(
        F.min("at").alias("at"),
        F.min_by("blk", "at").alias("blk"),
        F.max("clock").alias("clock"),
        F.coalesce(F.min(F.when(head & timed, F.col("t"))), F.max(F.when(head, F.col("t")))).alias("head_t"),
        F.coalesce(F.max(F.when(head, F.col("dies"))), F.lit(False)).alias("head_broken"),
        F.max_by("dl", F.when(head & timed, F.col("n"))).alias("head_dl"),
        F.min(F.when(write, F.col("t"))).alias("write_t"),
        F.min(F.when(write, F.col("write_at"))).alias("write_at"),
        F.max_by("dl", F.when(~head & timed, F.col("n"))).alias("tail_dl"),
        F.max_by("broken", "n").alias("tail_broken"),
        F.max(F.when(write, reborn)).alias("reborn_at"),
    ).drop(*by)


def narrowed(lines, width, chain=CHAIN):
    """Lines of the same lives, those of keys with over `chain` lines joined by ranges of the order."""
    few, many = _split(lines, chain)
    if many is None:
        return few
    for by in ranges_of(RANGE_BLOCKS, F.col("at.seg"), F.col("at.file"), F.col("blk"), width):
        many = joined(many, by)
    return few.unionByName(many)


def resolve_keys(lines, width=None, chain=CHAIN):
    """Per key: where its last epoch starts, its deadline, whether it was
    dropped, and the time it has reached. With a `width` (see `look`) no task chains
    much more than `chain` lines."""
    life = joined(lines if width is None else narrowed(lines, width, chain))
    wrote = F.col("write_t").isNotNull()
    return life.select(
        *KEY, F.when(wrote, F.coalesce("reborn_at", "write_at")).alias("epoch_at"),
        F.coalesce("tail_dl", "head_dl").alias("deadline"),
        (~wrote | F.col("tail_broken")).alias("dropped"), "clock")


def lives(commands, chain=CHAIN):
    """The resolved keys of commands, which are read several times."""
    types, width = look(commands, chain)
    return resolve_keys(key_lines(for_every_type(commands, types), width=width, chain=chain), width, chain)


def item_lines(commands):
    """Last operation per item: `last` = struct(at, keep, value, score)."""
    content = commands.where(F.col("op").isin("WRITE", "REMOVE"))
    kind = F.col("target_type")
    whole = F.array(F.struct(
        F.when(kind == "string", F.lit("")).otherwise(F.col("value")).alias("field"),
        F.when(kind == "string", F.col("value")).alias("value"),
        F.when(kind == "string", F.lit(0)).otherwise(F.col("enc")).alias("enc")))
    kept = (F.col("op") == "WRITE").alias("keep")
    lines = content.select(
        *KEY, *ORDER, kept, "score", F.col("enc").alias("rule_enc"), F.col("enc_level"),
        F.explode(F.when(kind == "hash", F.col("fields")).otherwise(whole)).alias("i"))
    # A member is told apart by its stored bytes, so by its coding as well;
    # a value's or field's coding is that of its last write.
    member = kind.isin("set", "zset")
    coding = F.when(kind == "hash", F.col("i.enc")).otherwise(F.col("rule_enc"))
    return lines.groupBy(
        *KEY, F.col("i.field").alias("item"),
        F.when(member, F.col("rule_enc")).otherwise(-1).alias("enc"),
        F.when(member & (F.col("rule_enc") > 0), F.col("enc_level")).otherwise(0).alias("enc_level"),
    ).agg(F.max(F.struct(
        _place().alias("at"), "keep", F.col("i.value").alias("value"), "score",
        coding.alias("enc"), F.col("enc_level").alias("enc_level"))).alias("last"))


def merge_items(lines):
    """Item lines of several stretches as one."""
    return lines.groupBy(*ITEM).agg(F.max("last").alias("last"))


def alive_keys(keys, as_of):
    """Keys within their deadline at a time; see `existing_keys` for emptied ones."""
    return (keys.where(~F.col("dropped") & (F.col("deadline") > as_of))
            .select(*KEY, "epoch_at", F.col("deadline").alias("expires_at")))


def existing_keys(keys, items, as_of):
    """Keys a server has at a time: a set or scored set that lost its last member
    is gone, whatever its deadline."""
    alive = alive_keys(keys, as_of)
    member_keys = F.col("target_type").isin("set", "zset")
    held = [contents(keys, items, kind, as_of).select("sid", F.lit(kind).alias("target_type"),
                                                      F.col("key").alias("target_key")).distinct() for kind in ("set", "zset")]
    return alive.where(~member_keys).unionByName(
        alive.where(member_keys).join(held[0].unionByName(held[1]), KEY, "left_semi"))


def contents(keys, items, target_type, as_of):
    """Live items of one target type: sid, key, item, value, score, enc, enc_level, expires_at."""
    alive = alive_keys(keys.where(F.col("target_type") == target_type), as_of)
    items = items.where((F.col("target_type") == target_type) & F.col("last.keep"))
    if target_type in ("set", "zset"):
        # One key holds a whole table: spread its members over many tasks.
        joined = join_salted(items, alive, KEY, spread=["item"])
    else:
        joined = items.join(alive, KEY)
    return joined.where(F.col("last.at") >= F.col("epoch_at")).select(
        "sid", F.col("target_key").alias("key"), "item", F.col("last.value").alias("value"),
        F.col("last.score").alias("score"), F.col("last.enc").alias("enc"),
        F.col("last.enc_level").alias("enc_level"), "expires_at")


def state_tables(keys, items, as_of):
    """The four state tables from resolved keys and merged items."""
    def table(kind, *cols):
        return contents(keys, items, kind, as_of).select("sid", "key", *cols, "enc", "enc_level", "expires_at")

    return {
        "string": table("string", "value"),
        "hash": table("hash", F.col("item").alias("field"), "value"),
        "set": table("set", F.col("item").alias("member")),
        "zset": table("zset", F.col("item").alias("member"), "score"),
    }


def fold(commands, as_of, chain=CHAIN):
    """State tables after all commands, as of a time. Every command must lie at
    or before that time.

    The commands are read by three jobs of which two need only a few narrow
    columns, so they are written once first.
    """
    commands = written(commands.sparkSession, commands)
    return state_tables(lives(commands, chain), item_lines(commands), as_of)


def encode(table, column, bytes_column):
    """A state table with the stored bytes of a value or member column."""
    return table.withColumn(bytes_column, compress(F.col(column), F.col("enc"), F.col("enc_level")))


def as_lines(keys, lines):
    """Resolved keys in the form of key lines, to stand for all lines merged so
    far: one write at the start of the epoch and what became of it."""
    kinds = {f.name: f.dataType for f in lines.schema.fields}
    first = lines.groupBy(*KEY).agg(F.min("at").alias("at"), F.min_by("blk", "at").alias("blk"))
    alive = F.col("epoch_at").isNotNull()
    values = {
        "at": F.col("at"), "blk": F.col("blk"), "clock": F.col("clock"), "head_broken": F.lit(False),
        "write_t": F.when(alive, F.col("clock")), "write_at": F.col("epoch_at"),
        "tail_dl": F.col("deadline"), "tail_broken": F.col("dropped"), "reborn_at": F.col("epoch_at"),
    }
    return keys.join(first, KEY).select(*KEY, *[
        values.get(n, F.lit(None)).cast(t).alias(n) for n, t in kinds.items() if n not in KEY])
