"""Sink tables of a stream, one part per micro-batch.

A micro-batch never rewrites state. It adds the key and item lines of its
commands (see operators.state); the state at any time is the merge of all lines.
Parts are named by batch id and overwritten when a batch is replayed, so a
replay after a crash changes nothing. `compact` merges old parts into one.
"""

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rowtide.operators import state
from rowtide.operators.commands import accepted, generate, malformed, refused, without_rule
from rowtide.operators.ddl import published_statements
from rowtide.operators.messages import PARTITIONS, ddl_messages, in_send_order, messages, next_numbers, numbered
from rowtide.operators.normalize import commits, deliver, normalize_events, split_open, to_changes
from rowtide.operators.positions import delivered_positions
from rowtide.operators.rules import rule_violations, versions
from rowtide.schema import COMMIT, KEY, with_defaults
from rowtide.session import written
from rowtide.sources.feed import in_segments, monitored, resync_places, unmonitored

KV, MESSAGES, BOTH = 0, 1, 2
MERGED = -1


class Store:
    """Tables below one folder that all executors share."""

    def __init__(self, spark, root):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table, batch_id=None):
        return f"{self.root}/{table}" + ("" if batch_id is None else f"/batch_id={batch_id}")

    def put(self, table, batch_id, df):
        df.write.mode("overwrite").parquet(self.path(table, batch_id))

    def part(self, table, batch_id):
        return self.spark.read.parquet(self.path(table, batch_id))

    def read(self, table):
        """All parts, or None before the first batch."""
        try:
            return self.spark.read.parquet(self.path(table))
        except AnalysisException as error:
            # No folder yet, or only what a crashed job left there.
            if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                return None
            raise

    def before(self, table, batch_id):
        """The newest part older than a batch, None if there is none."""
        parts = self.read(table)
        newest = None if parts is None else parts.where(F.col("batch_id") < batch_id).agg(F.max("batch_id")).first()[0]
        return None if newest is None else self.part(table, newest)

    def merged_to(self):
        """The newest batch a finished compaction covers, -1 if none."""
        done = self.read("merged")
        newest = None if done is None else done.agg(F.max("batch_id")).first()[0]
        return MERGED if newest is None else newest

    def merged(self, table, upto):
        """What a compaction up to a batch has made of a table."""
        return self.spark.read.parquet(f"{self.root}/merged_{table}/upto={upto}")

    def lines(self, table):
        """Key or item lines: the newest merged part and the batches after it."""
        upto = self.merged_to()
        parts = self.read(table)
        if upto < 0:
            return None if parts is None else parts.drop("batch_id")
        return self.merged(table, upto).unionByName(parts.where(F.col("batch_id") > upto).drop("batch_id"))

    # -- rules and resyncs ------------------------------------------------------

    def admitted(self, rules, batch_id, with_targets=True):
        """The rules in force for a batch: those given, or the last ones without a violation.

        One violation refuses the whole set; table "refused" lists them. A replay
        takes the rules its batch had. Without any set that could be in force
        nothing is applied.
        """
        known = self.read("rules")
        if known is None or known.where(F.col("batch_id") == batch_id).isEmpty():
            rules = written(self.spark, rules)
            found = written(self.spark, rule_violations(with_defaults(rules), with_targets))
            if not found.isEmpty():
                self.put("refused", batch_id, found)
                rules = self.before("rules", batch_id)
                if rules is None:
                    raise ValueError(f"no valid rules; violations in {self.path('refused', batch_id)}")
            # One file, so that it is there whole or not at all.
            self.put("rules", batch_id, rules.coalesce(1))
        return self.part("rules", batch_id)

    def segmented(self, events, batch_id):
        """Events with their segments. The ledger of resyncs goes on from batch to batch, so what
        follows a resync is placed after it in all later batches."""
        places = resync_places(events)
        earlier = self.before("resyncs", batch_id)
        if earlier is not None:
            places = places.unionByName(earlier).distinct()
        places = written(self.spark, places).where("file IS NOT NULL")
        listed = [tuple(r) for r in places.collect()]
        # A line without a place, so that the newest list is found even if it is empty.
        self.put("resyncs", batch_id, places.unionByName(self.spark.range(1).select(
            *[F.lit(None).cast(t).alias(c) for c, t in places.dtypes])).coalesce(1))
        return in_segments(events, listed)

    # -- transactions ----------------------------------------------------------

    def whole_transactions(self, events, batch_id):
        """The events of a batch that can go on, with those that waited for their commit mark.

        What still waits is kept with the batch it came in and never written again.
        The list of open transactions says how far back the kept events must be
        read, which is seldom beyond the batch before: a log does not interleave
        transactions.
        """
        done = written(self.spark, commits(events))
        ready, waiting = split_open(events, done)
        self.put("held", batch_id, waiting)
        begun = self.part("held", batch_id).select("sid", "tx_id").distinct().withColumn("since", F.lit(batch_id).cast("bigint"))
        # A line without a transaction, so that the newest list is found even if none is open.
        begun = begun.unionByName(self.spark.range(1).select(*[F.lit(None).cast(t).alias(c) for c, t in begun.dtypes]))
        still = self.before("open", batch_id)
        if still is not None:
            since = still.agg(F.min("since")).first()[0]
            if since is not None:
                kept = self.read("held").where((F.col("batch_id") >= since) & (F.col("batch_id") < batch_id)).drop("batch_id")
                ready = ready.unionByName(split_open(kept, done)[0], allowMissingColumns=True)
            begun = begun.unionByName(still)
        begun = begun.groupBy("sid", "tx_id").agg(F.min("since").alias("since"))
        self.put("open", batch_id, begun.join(done, ["sid", "tx_id"], "left_anti"))
        return ready

    # -- messages ---------------------------------------------------------------

    def put_messages(self, rows, batch_id, partitions=PARTITIONS):
        """Write a batch's messages with their numbers, then the ledger the next batch goes on from. A replay finds
        the same ledger and gives the same numbers."""
        ledger = self.before("ledger", batch_id)
        self.put("messages", batch_id, numbered(written(self.spark, rows), ledger, partitions))
        self.put("ledger", batch_id, next_numbers(self.part("messages", batch_id), ledger))

    # -- key-value sink ------------------------------------------------------

    def put_commands(self, commands, batch_id):
        """Write the lines a batch's commands come to. A batch that is already
        merged is left alone."""
        if batch_id <= self.merged_to():
            return
        lo, hi = commands.agg(F.min("t"), F.max("t")).first()
        types, width = state.look(commands)
        earlier = self.before("spans", batch_id)
        types = sorted({*types, *(earlier.first()["types"] if earlier else ())})
        self.put("spans", batch_id, self.spark.range(1).select(
            F.lit(lo).cast("bigint").alias("lo"), F.lit(hi).cast("bigint").alias("hi"),
            F.array(*map(F.lit, types)).cast("array<string>").alias("types")))
        ops = state.for_every_type(commands, types)
        self.put("keys", batch_id, state.key_lines(ops, self._clocks(ops, batch_id, lo), width))
        self.put("items", batch_id, state.item_lines(commands))

    def _clocks(self, commands, batch_id, lo):
        """Times reached by this batch's keys before it; None in the usual case
        that the whole batch is later than all before."""
        earlier = self.read("spans").where(F.col("batch_id") < batch_id)
        reached = earlier.agg(F.max("hi")).first()[0]
        if lo is None or reached is None or reached <= lo:
            return None
        upto = self.merged_to()
        lines = self.read("keys").where((F.col("batch_id") < batch_id) & (F.col("batch_id") > upto)).select(
            *KEY, "clock")
        if upto >= 0:
            lines = lines.unionByName(self.merged("keys", upto).select(*KEY, "clock"))
        mine = commands.select(*KEY).distinct()
        return lines.groupBy(*KEY).agg(F.max("clock").alias("clock")).join(mine, KEY, "left_semi")

    def _width(self, lines):
        """The longest file name if a key may have more lines than one task chains, else None. A key has one line
        per block and batch, and a merged one."""
        blocks, width = lines.agg(F.approx_count_distinct(F.struct("sid", "at.seg", "at.file", "blk")),
                                  F.coalesce(F.max(F.length("at.file")), F.lit(0))).first()
        parts = self.read("spans").agg(F.count(F.lit(1))).first()[0]
        return width if blocks + parts > state.CHAIN else None

    def state(self, as_of):
        """The four state tables as of a time."""
        lines = self.lines("keys")
        keys = state.resolve_keys(lines, self._width(lines))
        return state.state_tables(keys, state.merge_items(self.lines("items")), as_of)

    def compact(self, upto):
        """Merge the lines of all batches up to one. Readers take the result once
        the marker that is written last is there; what a crash left without one is
        overwritten."""
        done = self.merged_to()
        if upto <= done:
            return

        def until(table):
            new = self.read(table).where((F.col("batch_id") <= upto) & (F.col("batch_id") > done)).drop("batch_id")
            return new if done < 0 else new.unionByName(self.merged(table, done))
        lines = until("keys")
        keys = state.resolve_keys(lines, self._width(lines))
        items = state.merge_items(until("items"))
        live = items.where("last.keep").join(
            keys.where(~F.col("dropped")).select(*KEY, "epoch_at"), KEY).where(
            F.col("last.at") >= F.col("epoch_at")).drop("epoch_at")
        live.write.mode("overwrite").parquet(f"{self.root}/merged_items/upto={upto}")
        state.as_lines(keys, lines).write.mode("overwrite").parquet(f"{self.root}/merged_keys/upto={upto}")
        self.put("merged", upto, self.spark.range(1).select(F.lit(done).cast("bigint").alias("after")))


def _union(frames):
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def apply_batch(store, events, batch_id, rules, mode=BOTH, snapshot_time=None, topic="changes", fmt="json",
                send=None, hook=None, commit_marks=False, alters=False, partitions=PARTITIONS, admit=False, resyncs=False):
    """One micro-batch: events to the sinks, key-value first, then positions.

    With `commit_marks` the feed closes each transaction by a line of kind "commit";
    a batch may then cut transactions anywhere, and their events wait in the store
    until the mark comes. Without, a micro-batch must hold whole transactions: one
    that is cut is numbered and positioned per batch. Batches follow the log order.

    `rules` may hold pending changes with the position from which they are in
    force, see `rules.versions`. With `admit`, a set of rules with a violation is refused
    and the last good one stays in force, see `Store.admitted`. With `resyncs`, snapshot rows
    that carry a position are a resync read there: they come after the log up to that
    position and before the rest of it; their first rows must not come later than the log after them.

    Messages carry their number in (topic, partition), which goes on from batch to
    batch; `send(df)` delivers them elsewhere (a Kafka writer, say) and gets each
    partition of a topic as one run of rows in that order. `hook(df)` sees the
    commands. Of the statements (`query` events), if `alters` is set, the ALTERs of
    monitored tables are published, see `ddl.published_statements`; all leave a
    position. Positions are written last, so a crash repeats the batch. Snapshot
    events need `snapshot_time`, the time they count as written.
    """
    if admit:
        rules = store.admitted(rules, batch_id, with_targets=mode != MESSAGES)
    if commit_marks:
        events = store.whole_transactions(events, batch_id)
    if resyncs:
        events = store.segmented(events, batch_id)
    statements = events.where(F.col("event") == "query")
    steps = versions(events, rules)
    published = _union([published_statements(e, r) for e, r in steps]) if alters else None
    steps = [(e.drop("changed"), r) for e, r in steps]
    events = events.drop("changed")
    known = [monitored(e, r) for e, r in steps]
    lost = _union([without_rule(to_changes(normalize_events(unmonitored(e, r))), r) for e, r in steps]).unionByName(malformed(events))
    if mode in (KV, BOTH):
        made = _union([generate(to_changes(normalize_events(k)), r, snapshot_time=snapshot_time) for k, (_, r) in zip(known, steps)])
        store.put("commands", batch_id, made)
        made = store.part("commands", batch_id)
        commands = accepted(made)
        store.put_commands(commands, batch_id)
        lost = lost.unionByName(refused(made))
        if hook:
            hook(commands)
    store.put("dead_letter", batch_id, lost)
    # A transaction goes on when the rules change, so it is cut into chunks whole.
    known = _union([k.where(F.col("event") != COMMIT).withColumn("_version", F.lit(v)) for v, k in enumerate(known)])
    sent = deliver(known.unionByName(events.where(F.col("event") == COMMIT), allowMissingColumns=True))
    if mode in (MESSAGES, BOTH):
        rows = _union([messages(normalize_events(sent.where(F.col("_version") == v).drop("_version")), r, topic, fmt)
                       for v, (_, r) in enumerate(steps)])
        if published is not None:
            rows = rows.unionByName(ddl_messages(published, topic, fmt), allowMissingColumns=True)
        store.put_messages(rows, batch_id, partitions)
        if send:
            send(in_send_order(store.part("messages", batch_id)))
    store.put("positions", batch_id, delivered_positions(sent).unionByName(
        statements.select("sid", "file", "pos", "event_time"), allowMissingColumns=True))


def kafka_sender(**options):
    """A `send` that writes topic, key, value and partition through the Kafka connector, which must be installed;
    a topic needs as many partitions as `apply_batch` numbers."""
    def send(rows):
        writer = rows.select("topic", "key", "value", "partition").write.format("kafka")
        for name, value in options.items():
            writer = writer.option(name.replace("_", "."), value)
        writer.save()
    return send


def run_available(spark, source, store, checkpoint, read_rules, **how):
    """Apply everything the source holds and stop. Rules are read anew for each
    micro-batch; the checkpoint keeps the place for the next run."""
    def each(df, batch_id):
        apply_batch(store, df, batch_id, read_rules(df.sparkSession), **how)
    run = (source.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()
