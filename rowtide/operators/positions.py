"""Log positions: what was delivered, what to save, where to resume."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rowtide.functions.scan import running_max
from rowtide.operators.normalize import EARLY_CHUNK

# Heartbeat and retention defaults.
IDLE_SECONDS = 60
RESERVE_HOURS = 24


def delivered_positions(sent):
    """Position of each delivered batch: that of its first event. Batches
    without a position (early chunks, snapshot events) leave none."""
    return sent.where((F.col("sent_file") != "") & ((F.col("n") - 1) % EARLY_CHUNK == 0)).select(
        "sid", "tx_id", "chunk_no", F.col("sent_file").alias("file"),
        F.col("sent_pos").alias("pos"), F.col("sent_time").alias("event_time"))


def latest_positions(saved, arrival):
    """The last saved line per server id."""
    return saved.groupBy("sid").agg(
        F.max_by(F.struct(*[c for c in saved.columns if c not in ("sid", arrival)]), arrival).alias("_p")
    ).select("sid", "_p.*")


# Points of one server id are scanned in stretches of this many intervals.
STRETCH = 1024
# Before any arrival time, with room to add an interval.
NEVER = -(1 << 62)


def throttled(saved, arrival_ms, interval_ms):
    """Lines a greedy saver keeps: each one later than the last kept by more
    than the interval; an interval of 0 or less keeps all.

    The choice depends on all earlier choices, so no window states it. Time is
    cut into stretches. The first kept point of a stretch lies in its first
    interval or is the first one after it; each such point is followed to the
    last point kept in the stretch. Most paths run together, so a stretch comes
    down to a few (latest start, last kept) pairs. These are chained per server
    id, and the stretches then run with the point kept before them.
    """
    if interval_ms <= 0:
        return saved
    # Of lines with equal arrival time only the first can be kept.
    others = [c for c in saved.columns if c not in ("sid", arrival_ms)]
    points = (saved.groupBy("sid", arrival_ms)
              .agg(F.min(F.struct(*others)).alias("_line"))
              .withColumnRenamed(arrival_ms, "_t")
              .withColumn("_stretch", F.floor(F.col("_t") / (interval_ms * STRETCH))))
    times = points.select("sid", "_stretch", "_t")

    def follow(t):
        """Index of the next kept point after each point, len(t) if none."""
        return np.searchsorted(t, t + interval_ms, side="right")

    def paths(key, frame):
        t = np.sort(frame["_t"].to_numpy())
        step = follow(t)
        last = np.arange(len(t))
        for i in range(len(t) - 1, -1, -1):
            if step[i] < len(t):
                last[i] = last[step[i]]
        n = min(int(np.searchsorted(t, (key[1] * STRETCH + 1) * interval_ms, side="right")) + 1, len(t))
        out = t[last[:n]]
        ends = np.append(out[1:] != out[:-1], True)
        return pd.DataFrame({"sid": key[0], "_stretch": key[1], "_t": t[:n][ends], "out": out[ends]})

    table = times.groupBy("sid", "_stretch").applyInPandas(
        paths, "sid int, _stretch bigint, _t bigint, out bigint")

    def chain(key, frame):
        frame = frame.sort_values(["_stretch", "_t"])
        kept, rows = NEVER, []
        for stretch, part in frame.groupby("_stretch", sort=True):
            rows.append((key[0], stretch, kept))
            at = int(np.searchsorted(part["_t"].to_numpy(), kept + interval_ms, side="right"))
            if at < len(part):
                kept = int(part["out"].to_numpy()[at])
        return pd.DataFrame(rows, columns=["sid", "_stretch", "_kept"])

    starts = table.groupBy("sid").applyInPandas(chain, "sid int, _stretch bigint, _kept bigint")

    def keep(key, frame):
        t = np.sort(frame["_t"].to_numpy())
        step = follow(t)
        i, kept = int(np.searchsorted(t, frame["_kept"].iloc[0] + interval_ms, side="right")), []
        while i < len(t):
            kept.append(int(t[i]))
            i = int(step[i])
        return pd.DataFrame({"sid": key[0], "_t": kept})

    chosen = times.join(starts, ["sid", "_stretch"]).groupBy("sid", "_stretch").applyInPandas(
        keep, "sid int, _t bigint")
    return (points.join(chosen, ["sid", "_t"])
            .select("sid", F.col("_t").alias(arrival_ms), "_line.*").select(*saved.columns))


def idle_positions(commits, start, seconds=IDLE_SECONDS, block_seconds=86_400):
    """Positions saved while no data arrives.

    `commits`: sid, t, ord, has_data, file, pos. After each `seconds` without a
    data batch the next empty commit saves its position.
    """
    df = commits.withColumn("_blk", F.floor(F.col("t") / block_seconds))
    seen = running_max(df, ["sid"], ["_blk"], ["t", "ord"],
                       F.when(F.col("has_data"), F.col("t")), "_last")
    idle = (seen.where(~F.col("has_data"))
            .withColumn("_last", F.coalesce("_last", F.lit(start).cast("bigint")))
            .withColumn("_beat", F.floor((F.col("t") - F.col("_last")) / seconds))
            .where(F.col("_beat") >= 1))
    return (idle.groupBy("sid", "_last", "_beat")
            .agg(F.min(F.struct("t", "ord", "file", "pos")).alias("_c"))
            .select("sid", "_c.file", "_c.pos", F.col("_c.t").alias("timestamp")))


def observed_map(status, first_id=0):
    """Lines for the position map from observed status rows, which hold text."""
    number = lambda name: F.coalesce(F.col(name).try_cast("bigint"), F.lit(0))
    return status.select(
        (F.col("seen_ord") + first_id).alias("id"), "sid",
        F.col("master_addr").alias("master_mysql_addr"),
        F.col("relay_master_log_file").alias("master_binlog_file_name"),
        number("exec_master_log_pos").alias("master_binlog_position"),
        F.col("slave_addr").alias("slave_mysql_addr"),
        F.col("slave_file").alias("slave_binlog_file_name"),
        number("slave_pos").alias("slave_binlog_position"),
        F.col("seen_at").alias("insert_timestamp"))


def retained_map(position_map, now, reserve_hours=RESERVE_HOURS):
    hours = reserve_hours or RESERVE_HOURS
    return position_map.where(F.col("insert_timestamp") >= F.lit(now) - hours * 3600)


def translate(positions, position_map, pos_block=1 << 20):
    """Positions of one server's log on its replica: of the map lines at or
    before the position, the one with the largest id.

    `positions`: sid, mysql_addr, file, pos and any other columns. Both sides
    are laid in one order and a running maximum of (id, replica position) is
    read off, so no pairs are formed. A position without a line gets NULL.
    """
    extra = [c for c in positions.columns if c not in ("sid", "mysql_addr", "file", "pos")]
    known = position_map.select(
        "sid", F.col("master_mysql_addr").alias("mysql_addr"),
        F.col("master_binlog_file_name").alias("file"), F.col("master_binlog_position").alias("pos"),
        F.lit(0).alias("_side"),
        F.struct(F.col("id"), F.col("slave_binlog_file_name").alias("file"),
                 F.col("slave_binlog_position").alias("pos")).alias("_m"))
    asked = positions.select(
        "sid", "mysql_addr", "file", "pos", F.lit(1).alias("_side"),
        F.struct(*[F.col(c) for c in extra] or [F.lit(0).alias("_none")]).alias("_extra"))
    both = known.unionByName(asked, allowMissingColumns=True).withColumn(
        "_blk", F.floor(F.col("pos") / pos_block))
    found = running_max(both, ["sid", "mysql_addr"], ["file", "_blk"], ["pos", "_side"], F.col("_m"), "_best")
    return found.where(F.col("_side") == 1).select(
        "sid", "mysql_addr", "file", "pos", *[F.col(f"_extra.{c}").alias(c) for c in extra],
        F.col("_best.file").alias("new_file"), F.col("_best.pos").alias("new_pos"))


def switch_positions(positions, position_map, newest, policy):
    """Start on the new server: policy 0 goes back to the translated position
    (repeats, no loss), policy 1 takes the newest (loss, no repeats).
    `newest`: sid, newest_file, newest_pos."""
    if policy == 0:
        return translate(positions, position_map)
    if policy == 1:
        return positions.join(newest, "sid", "left").select(
            *positions.columns, F.col("newest_file").alias("new_file"), F.col("newest_pos").alias("new_pos"))
    raise ValueError(f"switch policy {policy} is not available")


def resume_plan(servers, saved, snapshots, position_map, newest, policy=0):
    """How each server id starts.

    `servers`: sid, current_addr; `saved`: sid, mysql_addr, file, pos;
    `snapshots`: sid lines with tables to snapshot; `newest`: sid, newest_file,
    newest_pos. Result: sid, action, file, pos.
    """
    snap = snapshots.select("sid").distinct().withColumn("_snap", F.lit(True))
    moved = switch_positions(saved, position_map, newest, policy).select(
        "sid", "mysql_addr", "file", "pos", "new_file", "new_pos")
    df = (servers.join(moved, "sid", "left").join(snap, "sid", "left").join(newest, "sid", "left"))
    none = F.col("file").isNull() | (F.col("file") == "") | (F.col("pos") == 0)
    same = F.col("mysql_addr") == F.col("current_addr")
    action = (
        F.when(none & F.col("_snap"), "snapshot").when(none, "newest").when(same, "saved")
        .when(F.coalesce("new_pos", F.lit(0)) == 0, "stop").otherwise("switched"))
    pick = lambda now, old, new: (
        F.when(F.col("action") == "newest", F.col(now)).when(F.col("action") == "saved", F.col(old))
        .when(F.col("action") == "switched", F.col(new)))
    return df.withColumn("action", action).select(
        "sid", "action", pick("newest_file", "file", "new_file").alias("file"),
        pick("newest_pos", "pos", "new_pos").alias("pos"))
