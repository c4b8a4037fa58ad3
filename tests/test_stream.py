"""Sinks of a stream: routing, dead letters, replay, hand-over of messages."""

import random

import pytest
from pyspark.sql import functions as F

from rowtide.operators import state
from rowtide.operators.commands import kv_commands
from rowtide.operators.messages import in_send_order, messages, numbered
from rowtide.operators.normalize import deliver, normalize_events, to_changes
from rowtide.operators.positions import delivered_positions
from rowtide.operators.rules import versions
from rowtide.plans import feeds, sinks
from rowtide.schema import COMMIT, EVENTS_CHANGED, EVENTS_RAW, rules_df
from rowtide.session import shared_folder
from rowtide.sources.feed import stream_events
from rowtide.streaming.store import BOTH, KV, MESSAGES, Store, apply_batch, run_available


def feed(seed=1, n=240):
    """Inserts, updates and deletes of few rows, with a table nobody asked for."""
    rng = random.Random(seed)
    live, out = {}, []
    for i in range(n):
        tb = "other" if rng.random() < 0.1 else "t"
        k = str(rng.randint(0, 9))
        row = [k, rng.choice("xyz"), str(rng.randint(0, 99))]
        old = live.get((tb, k))
        if old and rng.random() < 0.25:
            event, rows = "delete", [old]
            del live[tb, k]
        else:
            event, rows = ("update", [old, row]) if old else ("insert", [row])
            live[tb, k] = row
        out.append((1, "d", tb, event, f"f{i // 20:03d}", i % 20 * 10, 1000 + i * 3, i // 5, i % 5 + 1, False,
                    [("id", "int"), ("kind", "string"), ("n", "int")], rows, None))
    return out


RULES = [
    dict(id=1, sid=1, db="d", tb="t", target_key_type="hash", target_key_prefix="h", target_key_columns="id",
         expire_time=40, delay_del=1, delay_expire_time=10),
    dict(id=2, sid=1, db="d", tb="t", target_key_type="set", target_key_prefix="s", filter_rule="kind=x",
         is_full_column=0, replic_columns="id", expire_time=30),
    dict(id=3, sid=1, db="d", tb="t", target_key_type="zset", target_key_prefix="z", target_zset_score_column="kind"),
]
AS_OF = 1000 + 239 * 3


def rows(tables):
    return {(kind, *map(str, r)) for kind, t in tables.items() for r in t.collect()}


def test_stream_equals_batch(spark):
    data, rules = feed(), rules_df(spark, RULES)
    whole = spark.createDataFrame(data, EVENTS_RAW)
    alter = (1, "d", "", "query", "f011", 999, 0, None, 0, False, None, None, "ALTER TABLE t ADD c INT")
    data = data + [alter]
    known = to_changes(normalize_events(whole))
    want = rows(state.fold(kv_commands(known, rules), AS_OF))
    assert want
    folder = shared_folder(spark)
    store = Store(spark, f"{folder}/sink")
    sent = []
    for a, b in ((0, 100), (100, 160), (160, 241)):
        spark.createDataFrame(data[a:b], EVENTS_RAW).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        run_available(spark, stream_events(spark, f"{folder}/in"), store, f"{folder}/checkpoint",
                      lambda s: rules_df(s, RULES), mode=BOTH, alters=True, send=lambda df: sent.append(df.count()))
    assert rows(store.state(AS_OF)) == want
    monitored = whole.where("tb = 't'").count()
    assert store.read("messages").count() == monitored + 1 == sum(sent)
    assert store.read("messages").where("value LIKE '%\"query\":\"ALTER TABLE t ADD c INT\"%'").count() == 1
    dead = {r.reason: r["count"] for r in store.read("dead_letter").groupBy("reason").count().collect()}
    assert dead["no rule"] == len(data) - 1 - monitored and dead["no score"] > 0
    last = store.read("positions").agg(F.max(F.struct("file", "pos"))).first()[0]
    assert (last.file, last.pos) == ("f011", 999)


def test_replay_changes_nothing(spark):
    data, rules = feed(2, 120), rules_df(spark, RULES[:2])
    store = Store(spark, shared_folder(spark))
    parts = [spark.createDataFrame(data[a:b], EVENTS_RAW) for a, b in ((0, 60), (60, 120))]
    for batch_id in (0, 1):
        apply_batch(store, parts[batch_id], batch_id, rules, mode=KV)
    before = rows(store.state(AS_OF - 400))
    apply_batch(store, parts[1], 1, rules, mode=KV)
    store.compact(0)
    apply_batch(store, parts[0], 0, rules, mode=KV)
    assert rows(store.state(AS_OF - 400)) == before


def test_only_alters_of_monitored_tables_are_published(spark):
    def statement(pos, db, text, *changed):
        return (1, db, "", "query", "f001", pos, 0, None, 0, False, None, None, text, list(changed) if changed else None)
    bare = [statement(1, "d", "ALTER TABLE t ADD c INT"), statement(2, "d", "TRUNCATE TABLE t"), statement(3, "x", "ALTER TABLE t ADD c INT")]
    listed = [statement(4, "", "ALTER TABLE other ADD a INT", ("d", "other")), statement(5, "", "ALTER TABLE _t_new ADD e INT", ("d", "_t_new")),
              statement(6, "", "TRUNCATE TABLE t", ("d", "t"))]
    folder = shared_folder(spark)
    for name, schema, data, want in (("bare", EVENTS_RAW, [s[:-1] for s in bare], {1: "ALTER TABLE t ADD c INT"}),
                                     ("listed", EVENTS_CHANGED, bare + listed, {1: "ALTER TABLE t ADD c INT", 5: "ALTER TABLE t ADD e INT"})):
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}")
        store = Store(spark, f"{folder}/sink_{name}")
        run_available(spark, stream_events(spark, f"{folder}/{name}", schema=schema), store, f"{folder}/checkpoint_{name}",
                      lambda s: rules_df(s, RULES), mode=MESSAGES, alters=True)
        found = {r.pos: r.value for r in store.read("messages").collect()}
        assert found.keys() == want.keys() and all(f'"query":"{text}"' in found[pos] for pos, text in want.items())
        assert store.read("positions").agg(F.max("pos")).first()[0] == len(data)


KEYED = [dict(id=1, sid=1, db="d", tb="t", target_key_type="string", target_key_prefix="k", message_key_columns="id"),
         dict(id=2, sid=1, db="d", tb="other", target_key_type="string", target_key_prefix="o")]


def test_messages_are_sent_in_order(spark):
    """Three batches and a replay: numbers go on without gaps, and what a sender gets is in their order."""
    data, rules = feed(3, 240), rules_df(spark, KEYED)
    store, sent = Store(spark, shared_folder(spark)), []
    parts = [spark.createDataFrame(data[a:b], EVENTS_RAW).coalesce(2) for a, b in ((0, 100), (100, 160), (160, 240))]
    for batch_id in (0, 1, 1, 2):
        apply_batch(store, parts[batch_id], batch_id, rules, mode=MESSAGES, partitions=4, send=lambda df: sent.append(
            [r.asDict() for r in df.collect()]))
    assert sorted(sent[1], key=str) == sorted(sent[2], key=str)
    taken = sent[0] + sent[2] + sent[3]
    assert len(taken) == 240
    channels, keys = {}, {}
    for r in taken:
        channels.setdefault((r["topic"], r["partition"]), []).append(r)
        keys.setdefault(r["key"], set()).add(r["partition"])
    assert len(channels) > 1 and all(len(p) == 1 for p in keys.values())
    for rows_ in channels.values():
        assert [r["seq"] for r in rows_] == list(range(len(rows_)))
        places = [(r["file"], r["pos"]) for r in rows_]
        assert places == sorted(places)
    assert store.read("messages").count() == 240


def test_numbers_do_not_depend_on_blocks(spark):
    events = normalize_events(deliver(spark.createDataFrame(feed(4, 120), EVENTS_RAW)))
    rows_ = messages(events, rules_df(spark, KEYED), "all")
    whole = {(r.file, r.pos): (r.partition, r.seq) for r in numbered(rows_, partitions=2).collect()}
    ledger = spark.createDataFrame([("all", 0, 1000), ("all", 1, 5000)], "topic string, partition int, next bigint")
    small = {(r.file, r.pos): (r.partition, r.seq) for r in in_send_order(numbered(rows_, ledger, 2, log_block=30)).collect()}
    assert len(whole) == 120 and small == {k: (p, n + (1000, 5000)[p]) for k, (p, n) in whole.items()}


def with_marks(data, last_pos=7):
    """The events of a feed, each transaction closed by a commit mark."""
    out = []
    for i, e in enumerate(data):
        out.append(e)
        if i + 1 == len(data) or data[i + 1][7] != e[7]:
            out.append((e[0], None, None, COMMIT, e[4], e[5] + last_pos, e[6], e[7], e[8] + 1, False, None, None, None))
    return out


def test_transactions_cut_by_batches(spark):
    """Transactions of two servers, cut anywhere, come out as if their batch had held them whole."""
    one = feed(6, 150)
    two = [(2, "d", "t", *e[3:]) for e in feed(7, 60)]
    long = [(1, "d", "t", "insert", "f900", i, 5000, 900, i + 1, False, [("id", "int")], [[str(i)]], None) for i in range(31)]
    log = with_marks(one + long) + with_marks(two)
    loose = [(1, "d", "t", "insert", "f950", 1, 6000, None, None, False, [("id", "int")], [["5"]], None)]
    rules = rules_df(spark, [{**r, "sid": sid} for sid in (1, 2) for r in KEYED])
    whole = deliver(spark.createDataFrame(log + loose, EVENTS_RAW))
    assert whole.where("event = 'commit'").count() == 0
    assert whole.where("tx_id = 900 AND n > 27").agg(F.min("sent_pos"), F.max("sent_pos")).first()[:] == (37, 37)
    positions = {tuple(r) for r in delivered_positions(whole).collect()}
    values = sorted(r.value for r in messages(normalize_events(whole), rules, "changes").collect())
    store = Store(spark, shared_folder(spark))
    log += loose
    inside = next(i for i, e in enumerate(log) if e[7] == 900) + 10
    # The third batch begins with a mark alone, the fourth is cut inside the long transaction.
    cuts = [0, 33, next(i for i, e in enumerate(log) if i > 90 and e[3] == COMMIT), inside, len(log)]
    for batch_id, (a, b) in enumerate(zip(cuts, cuts[1:])):
        for _ in range(1 + (batch_id == 2)):  # one batch is repeated
            events = spark.createDataFrame(log[a:b], EVENTS_RAW).coalesce(1)
            apply_batch(store, events, batch_id, rules, mode=MESSAGES, commit_marks=True)
    assert sorted(r.value for r in store.read("messages").collect()) == values
    names = ["sid", "tx_id", "chunk_no", "file", "pos", "event_time"]
    got = [tuple(r) for r in store.read("positions").select(*names).collect()]
    assert len(got) == len(positions) and set(got) == positions
    assert store.before("open", 99).where("tx_id IS NOT NULL").count() == 0
    assert store.read("dead_letter").count() == 0


def test_a_batch_reads_its_own_stretch_only(spark, tmp_path):
    spark.range(300).selectExpr(
        "id AS event_id", "timestamp_ntz '2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id) AS ts", "id % 7 AS user_id",
        "elt(int(id % 3) + 1, 'view', 'error', 'purchase') AS event_type", "id / 4 AS value", "concat('p', id) AS props").write.parquet(
        f"{tmp_path}/events.parquet")
    parts = sinks.cut_anywhere(spark, str(tmp_path))
    files = [{r[0] for r in p.select(F.input_file_name()).distinct().collect()} for p in parts]
    assert all(files) and len(set().union(*files)) == sum(map(len, files))
    whole = [r.asDict() for r in feeds.user_state(spark, str(tmp_path)).collect()]
    rows = [(i, r.asDict()) for i, p in enumerate(parts) for r in p.collect()]
    place = lambda r: (r["file"], r["pos"])
    assert sorted((r for _, r in rows if r["event"] != COMMIT), key=place) == sorted(whole, key=place)
    ends = {}
    for r in whole:
        ends[r["tx_id"]] = max(ends.get(r["tx_id"], ("", 0)), (r["file"], r["pos"] + int(sinks.COMMITTED)))
    marks = [(i, r) for i, r in rows if r["event"] == COMMIT]
    assert {r["tx_id"]: place(r) for _, r in marks} == ends and len(marks) == len(ends)
    # Stretches follow the log and end inside transactions.
    assert [i for _, i in sorted((place(r), i) for i, r in rows)] == sorted(i for i, _ in rows)
    assert any(i < j for i, r in rows for j, m in marks if m["tx_id"] == r["tx_id"])


def test_alters_are_off_unless_asked_for(spark):
    text = (1, "d", "", "query", "f001", 1, 0, None, 0, False, None, None, "ALTER TABLE t ADD c INT")
    store = Store(spark, shared_folder(spark))
    apply_batch(store, spark.createDataFrame([text], EVENTS_RAW), 0, rules_df(spark, RULES), mode=MESSAGES)
    assert store.read("messages").count() == 0 and store.read("positions").count() == 1


def test_rules_in_force_at_a_place(spark):
    """Adds, a drop, the same rule added again, two servers, a resync at the place of a change, events without a place."""
    base = dict(db="d", tb="t", target_key_type="string", target_key_prefix="p")
    pending = [(1, 1, 0, None, None), (2, 1, 3, "f1", 10), (1, 1, 4, "f1", 20), (1, 1, 3, "f2", 5), (3, 2, 0, None, None), (3, 2, 4, "f1", 15)]
    rules = rules_df(spark, [{**base, "id": i, "sid": sid, "operation": op} for i, sid, op, _, _ in pending])
    places = spark.createDataFrame(pending, "id int, sid int, operation int, file string, pos bigint")
    rules = rules.join(places, ["id", "sid", "operation"])
    log = [(sid, f, p, False) for sid in (1, 2) for f, p in (("f1", 9), ("f1", 10), ("f1", 11), ("f1", 20), ("f1", 21), ("f2", 5), ("f2", 6))]
    log += [(1, "f1", 10, True), (1, "", 0, True), (None, None, None, None), (3, "f9", 1, False)]
    events = spark.createDataFrame(log, "sid int, file string, pos bigint, is_snapshot boolean")
    found = {}
    for part, now in versions(events, rules):
        active = now.select("sid", "id", "operation").collect()
        assert all(r.operation == 0 for r in active)
        for e in part.collect():
            assert tuple(e) not in found
            found[tuple(e)] = {r.id for r in active if r.sid == e.sid}

    def want(sid, file, pos, snapshot):
        have = {i for i, s, op, _, _ in pending if s == sid and op == 0}
        for i, s, op, f, p in sorted((x for x in pending if x[2]), key=lambda x: x[3:]):
            if s == sid and ((f, p) < (file, pos) or snapshot and (f, p) == (file, pos)):
                have = have | {i} if op == 3 else have - {i}
        return have
    assert found == {e: want(*e) for e in log}
    assert len(versions(events, rules.drop("file", "pos"))) == 1
    (part, now), = versions(events, rules.where("operation = 0"))
    assert part.count() == len(log) and {r.id for r in now.collect()} == {1, 3}


def test_bad_rules_are_refused(spark):
    good = rules_df(spark, RULES[:1])
    bad = rules_df(spark, [RULES[0], {**RULES[1], "expire_time": 0, "filter_rule": "a=b=c"}])
    store = Store(spark, shared_folder(spark))
    with pytest.raises(ValueError, match="no valid rules"):
        store.admitted(bad, 0)
    assert store.read("rules") is None and store.read("refused").count() == 2
    assert store.admitted(bad, 1, with_targets=False).count() == 2  # messages need no targets
    store = Store(spark, shared_folder(spark))
    ids = [[r.id for r in store.admitted(r, n).collect()] for n, r in ((0, good), (1, bad), (0, rules_df(spark, RULES[1:2])), (2, bad))]
    assert ids == [[1], [1], [1], [1]]  # the third is a replay
    assert {(r.batch_id, r.id, r.field) for r in store.read("refused").collect()} == {
        (n, 2, f) for n in (1, 2) for f in ("expire_time", "filter_rule")}
    assert store.admitted(rules_df(spark, []), 3).count() == 0


def test_segments_of_resyncs_go_on(spark):
    """Two resyncs of one server in different batches, rows of the first in both, a replay, a server without any."""
    def event(sid, file, pos, snapshot=False):
        return (sid, "d", "t", "insert", file, pos, 0, None, 1, snapshot, None, None, None)
    batches = [[event(1, "f1", 1), event(1, "f1", 5), event(1, "f1", 6), event(1, "f1", 5, True), event(2, "f1", 9), event(2, "", 0, True)],
               [event(1, "f1", 5, True), event(1, "f1", 7), event(None, None, None, None)],
               [event(1, "f2", 1), event(1, "f2", 1, True), event(1, "f2", 2), event(2, "f2", 3)]]
    want = [{(1, "f1", 1, False, 0), (1, "f1", 5, False, 0), (1, "f1", 6, False, 2), (1, "f1", 5, True, 1), (2, "f1", 9, False, 0), (2, "", 0, True, 0)},
            {(1, "f1", 5, True, 1), (1, "f1", 7, False, 2), (None, None, None, None, 0)},
            {(1, "f2", 1, False, 2), (1, "f2", 1, True, 3), (1, "f2", 2, False, 4), (2, "f2", 3, False, 0)}]
    store = Store(spark, shared_folder(spark))
    for n in (0, 1, 1, 2):
        placed = store.segmented(spark.createDataFrame(batches[n], EVENTS_RAW), n)
        assert {tuple(r) for r in placed.select("sid", "file", "pos", "is_snapshot", "seg").collect()} == want[n]
