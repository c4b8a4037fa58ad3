"""The block-wise fold against the interpreter."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from model import Server
from rowtide.operators import state
from rowtide.schema import ORDER
from rowtide.session import shared_folder
from rowtide.streaming.store import Store

SCHEMA = pa.schema([
    ("seg", pa.int64()), ("file", pa.string()), ("pos", pa.int64()), ("event_ord", pa.int64()),
    ("phase", pa.int32()), ("row_ord", pa.int32()), ("rule_id", pa.int32()), ("blk", pa.int64()),
    ("t", pa.int64()), ("target_type", pa.string()), ("target_key", pa.string()), ("op", pa.string()),
    ("value", pa.string()),
    ("fields", pa.list_(pa.struct([("field", pa.string()), ("value", pa.string()), ("enc", pa.int32())]))),
    ("score", pa.float64()), ("ttl", pa.int64()), ("enc", pa.int32()), ("enc_level", pa.int32())])


def random_commands(seed, n_keys, max_ops, step_back=0.1, names=None):
    """Commands of many keys interleaved in one log of small blocks; with `names`, keys of several types share one."""
    rng = random.Random(seed)
    keys = [(rng.choice(["string", "hash", "set", "zset"]), f"k{i % (names or n_keys)}") for i in range(n_keys)]
    pending = [k for k in keys for _ in range(rng.randint(1, max_ops))]
    rng.shuffle(pending)
    t, out = 100, []
    clock = {}
    for n, (kind, key) in enumerate(pending):
        # Each key has its own clock, so that ties and step-backs are frequent.
        t = clock.get(key, 100) + rng.choice([0, 0, 1, 2, 5])
        if rng.random() < step_back:
            t -= rng.randint(1, 6)
        clock[key] = max(t, clock.get(key, 0))
        scored = kind in ("set", "zset")
        op = rng.choice(["WRITE", "WRITE", "WRITE", "DEL"] + (["REMOVE", "REMOVE"] if scored else ["EXPIRE", "EXPIRE"]))
        ttl = None
        if op in ("WRITE", "EXPIRE") or op == "REMOVE" and rng.random() < 0.6:
            ttl = rng.choice([1, 2, 3, 8, 20])
        if op == "EXPIRE" and rng.random() < 0.1:
            ttl = 0
        item = f"m{rng.randint(0, 2)}"
        out.append(dict(
            seg=0, file=f"f{n // 40:05d}", pos=n % 40 * 10, event_ord=0, phase=rng.randint(0, 1), row_ord=0,
            rule_id=1, blk=n % 40 // 10, t=t, target_type=kind, target_key=key, op=op,
            value=f"v{n}" if kind == "string" and op == "WRITE" else item if scored and op != "DEL" else None,
            fields=[dict(field=item, value=f"v{n}", enc=0)] if kind == "hash" and op == "WRITE" else None,
            score=float(n) if kind == "zset" and op == "WRITE" else None, ttl=ttl, enc=0, enc_level=-1))
    return out


def frame(spark, commands):
    return spark.createDataFrame(pa.Table.from_pylist(commands, schema=SCHEMA)).withColumn("sid", F.lit(1))


def rows(tables):
    found = set()
    for kind, table in tables.items():
        for r in table.collect():
            r = r.asDict()
            item = r.get("field", r.get("member", ""))
            found.add((kind, r["key"], item, r.get("value"), r.get("score"), r["expires_at"]))
    return found


def expected(commands, as_of):
    server = Server()
    for c in sorted(commands, key=lambda c: tuple(c[n] for n in ORDER)):
        server.apply(c)
    return server.contents(as_of)


@pytest.mark.parametrize("seed", [1, 2])
def test_fold_matches_interpreter(spark, seed):
    commands = random_commands(seed, 1500, 14)
    df = frame(spark, commands)
    keys = state.resolve_keys(state.key_lines(df)).persist()
    items = state.item_lines(df).persist()
    last = max(c["t"] for c in commands)
    by_key = expected(commands, 0)
    for as_of in (110, 120, last - 20, last):
        want = {r for r in by_key if r[-1] > as_of}
        assert rows(state.state_tables(keys, items, as_of)) == want
    keys.unpersist()
    items.unpersist()


def test_fold_of_few_hot_keys(spark):
    """Long chains of one key over hundreds of blocks."""
    commands = random_commands(5, 6, 1500)
    last = max(c["t"] for c in commands)
    for as_of in (last - 3,):
        assert rows(state.fold(frame(spark, commands), as_of)) == expected(commands, as_of)


def test_lines_join_range_by_range(spark, monkeypatch):
    """Keys with more lines than a task may chain, of all types, between keys with few."""
    monkeypatch.setattr(state, "RANGE_BLOCKS", 2)
    commands = random_commands(31, 8, 900) + [
        {**c, "target_key": f"few {c['target_key']}"} for c in random_commands(32, 200, 4)]
    for n, c in enumerate(commands):  # in one log, with a row's place of its own
        c["event_ord"] = n
    df = frame(spark, commands)
    types, width = state.look(df, chain=3)
    assert width == 6 and state.look(df)[1] is None and types == sorted({c["target_type"] for c in commands})
    lines = state.key_lines(state.for_every_type(df, types), width=width, chain=3).persist()
    assert lines.groupBy("target_type", "target_key").count().agg(F.max("count")).first()[0] > 200
    assert state.narrowed(lines, width, 3).groupBy("target_type", "target_key").count().agg(F.max("count")).first()[0] <= 3
    last = max(c["t"] for c in commands)
    want = expected(commands, 0)
    for as_of in (130, last - 3):
        assert rows(state.fold(df, as_of, chain=3)) == {r for r in want if r[-1] > as_of}
    lines.unpersist()


def test_an_ordered_log_needs_no_lookup_of_times(spark, monkeypatch):
    """Only a log whose blocks step back in time is looked up key by key; few lines per key are not joined by range."""
    looked = []
    monkeypatch.setattr(state, "_stepped", lambda *a, f=state._stepped: looked.append(1) or f(*a))
    monkeypatch.setattr(state, "joined", lambda lines, by=(), f=state.joined: looked.append(tuple(by)) or f(lines, by))
    commands = random_commands(7, 50, 4)
    back = [{**c, "t": 1000 - c["t"]} for c in commands]
    ordered = [{**c, "t": 1000, "file": "f"} for c in commands]
    for n, c in enumerate(ordered):
        c["event_ord"] = n
    assert rows(state.fold(frame(spark, ordered), 1001, chain=4 * 50)) == expected(ordered, 1001) and looked == [()]
    state.key_lines(frame(spark, back))
    assert looked[-1] == 1


def test_ranges_are_runs_of_the_order(spark):
    """Whatever the names, rows of a range lie side by side and finer ranges lie within wider ones."""
    names = ["", "a", "ab", "ab1", "ab12", "abc", "log.000099", "log.000100", "log.1", "z.01"]
    places = [(seg, name, blk) for seg in (0, 1) for name in names for blk in (0, 1, 2, 5)]
    df = spark.createDataFrame(places, "seg bigint, file string, blk bigint")
    ranges = state.ranges_of(2, F.col("seg"), F.col("file"), F.col("blk"), 10)
    found = sorted(tuple(map(tuple, r)) for r in df.select(F.struct("seg", "file", "blk"), *[F.struct(*r) for r in ranges]).collect())
    for level in range(1, len(ranges) + 1):
        runs = [r[level] for i, r in enumerate(found) if i == 0 or r[level] != found[i - 1][level]]
        assert len(runs) == len(set(runs))
        inner = {}
        for r in found:
            inner.setdefault(r[level - 1], set()).add(r[level])
        assert all(len(v) == 1 for v in inner.values())


def test_keys_of_several_types(spark):
    """A key's drop by a rule of another type, and a plain value written over it, end what was there."""
    commands = random_commands(21, 600, 12, names=150)
    last = max(c["t"] for c in commands)
    want = expected(commands, 0)
    typed = {(kind, key) for kind, key, *_ in want}
    assert len(typed) > len({key for _, key in typed}) // 2
    for as_of in (112, last - 5):
        assert rows(state.fold(frame(spark, commands), as_of)) == {r for r in want if r[-1] > as_of}
    # In batches, the second of which has drops of one type only.
    store = Store(spark, shared_folder(spark))
    cut = len(commands) // 2
    batches = [commands[:cut], [c for c in commands[cut:cut + 300] if c["target_type"] == "string"], commands[cut + 300:]]
    for batch_id, batch in enumerate(batches):
        store.put_commands(frame(spark, batch), batch_id)
    assert rows(store.state(112)) == {r for r in expected([c for b in batches for c in b], 0) if r[-1] > 112}


def test_any_split_into_batches_gives_the_same_state(spark):
    commands = random_commands(9, 300, 14)
    rng = random.Random(9)
    cuts = sorted(rng.sample(range(1, len(commands)), 3))
    store = Store(spark, shared_folder(spark))
    for batch_id, (a, b) in enumerate(zip([0] + cuts, cuts + [len(commands)])):
        batch = frame(spark, commands[a:b])
        store.put_commands(batch, batch_id)
        if batch_id == 1:
            store.compact(1)
            store.put_commands(batch, batch_id)  # replay of a merged batch
        if batch_id == 3:
            store.put_commands(batch, batch_id)  # replay after a crash
    for as_of in (105, 120):
        assert rows(store.state(as_of)) == {r for r in expected(commands, 0) if r[-1] > as_of}


SCRIPTS = {
    "expiry between writes": ([("WRITE", 0, 10, "a"), ("WRITE", 10, 10, "b")], {"b"}),
    "write before expiry": ([("WRITE", 0, 10, "a"), ("WRITE", 9, 10, "b")], {"a", "b"}),
    "expire on a dead key": ([("WRITE", 0, 5, "a"), ("EXPIRE", 5, 50, None)], set()),
    "expire revives nothing": ([("WRITE", 0, 5, "a"), ("EXPIRE", 6, 50, None), ("WRITE", 8, 50, "b")], {"b"}),
    "shorter second ttl": ([("WRITE", 0, 100, "a"), ("EXPIRE", 1, 3, None), ("WRITE", 5, 100, "b")], {"b"}),
    "delayed delete may lengthen": ([("WRITE", 0, 5, "a"), ("EXPIRE", 4, 100, None)], {"a"}),
    "delete then write": ([("WRITE", 0, 50, "a"), ("DEL", 1, None, None), ("WRITE", 1, 50, "b")], {"b"}),
    "time steps back": ([("WRITE", 5, 10, "a"), ("WRITE", 3, 10, "b"), ("WRITE", 14, 10, "c")], {"a", "b", "c"}),
}


@pytest.mark.parametrize("block", [1, 2, 100])
def test_a_removal_does_not_hide_an_expiry(spark, block):
    """A member is removed while the set lives, another once it has expired: the set is a new one at the next write."""
    ops = [("WRITE", 0, 5, "a"), ("WRITE", 1, 5, "b"), ("REMOVE", 2, None, "c"), ("REMOVE", 8, 20, "c"), ("WRITE", 10, 20, "d")]
    commands = [dict(seg=0, file="f", pos=n, event_ord=0, phase=1, row_ord=0, rule_id=1, blk=n // block, t=t, target_type="set",
                     target_key="s", op=op, value=item, fields=None, score=None, ttl=ttl, enc=0, enc_level=-1)
                for n, (op, t, ttl, item) in enumerate(ops)]
    assert expected(commands, 14) == {("set", "s", "d", None, None, 30)}
    assert rows(state.fold(frame(spark, commands), 14)) == expected(commands, 14)
    assert rows(state.fold(frame(spark, commands), 14, chain=0)) == expected(commands, 14)


@pytest.mark.parametrize("block", [1, 100])
def test_ttl_scripts(spark, block):
    commands = []
    for name, (ops, _) in SCRIPTS.items():
        for n, (op, t, ttl, item) in enumerate(ops):
            commands.append(dict(
                seg=0, file="f", pos=n, event_ord=0, phase=1, row_ord=0, rule_id=1, blk=n // block, t=t,
                target_type="hash", target_key=name, op=op, value=None,
                fields=[dict(field=item, value="x", enc=0)] if item else None, score=None, ttl=ttl, enc=0, enc_level=-1))
    table = state.fold(frame(spark, commands), 14)["hash"]
    got = {}
    for r in table.collect():
        got.setdefault(r["key"], set()).add(r["field"])
    assert got == {name: want for name, (_, want) in SCRIPTS.items() if want}
