"""Inputs the schemas allow must never vanish: each ends as a line or as a dead letter."""

import pytest
from pyspark.sql import functions as F
from test_units import events, made

from rowtide.functions.text import float_text
from rowtide.operators import commands as cmd
from rowtide.operators import state
from rowtide.operators.normalize import deliver, normalize_events, to_changes
from rowtide.operators.rules import compile_rules
from rowtide.schema import EVENTS_RAW, rules_df
from rowtide.session import shared_folder
from rowtide.sources import feed as src
from rowtide.streaming.store import Store

ONE = dict(event="insert", rows=[["1", "a"]])


def test_loose_events_are_sent_alone(spark):
    rows = [dict(ONE, pos=1, tx_id=None), dict(ONE, pos=2, is_snapshot=None, event_ord=None), dict(ONE, pos=3)]
    got = {r.pos: (r.sent_pos, r.sent_file) for r in deliver(events(spark, *rows)).collect()}
    assert got == {1: (1, "log.000040"), 2: (3, "log.000040"), 3: (3, "log.000040")}


def test_text_that_is_no_event(spark):
    found = src.parse_events(spark.createDataFrame([("{broken",), ('{"event":"insert","rows":[]}',), (None,)], "value string"))
    assert sorted((r.event, str(r.query)) for r in found.collect()) == [("insert", "None"), ("unreadable", "None"), ("unreadable", "{broken")]
    assert found.schema.names == EVENTS_RAW.names
    assert to_changes(normalize_events(found)).count() == 0
    assert sorted(r.reason for r in cmd.malformed(found).collect()) == ["no image", "unreadable", "unreadable"]


def test_cells_that_are_no_numbers(spark):
    shown = spark.createDataFrame([("abc",), ("1.5",)], "v string").select(
        F.expr(float_text("v", "key")).alias("k"), F.expr(float_text("v", "json")).alias("j")).collect()
    assert [tuple(r) for r in shown] == [("abc", '"abc"'), ("1.5", "1.5")]


def errors(spark, *rules):
    base = dict(sid=31, db="depot", tb="shelf", target_key_prefix="u", target_key_columns="id")
    found = compile_rules(rules_df(spark, [dict(base, id=i, **r) for i, r in enumerate(rules)]))
    return {r.rule_id: r.rule_error for r in found.collect()}


def test_types_conflict_only_where_keys_can_meet(spark):
    assert errors(spark, dict(target_key_type="string"), dict(target_key_type="set")) == {0: None, 1: None}
    assert errors(spark, dict(target_key_type="list"), dict(target_key_type="hash")) == {0: "unsupported type", 1: None}
    assert errors(spark, dict(target_key_type="hash"), dict(target_key_type="string", refresh_type=0)) == {0: None, 1: None}
    assert errors(spark, dict(target_key_type="hash"), dict(target_key_type="string")) == {0: None, 1: "type conflict"}
    assert errors(spark, dict(target_key_type="set"), dict(target_key_type="string", target_key_columns="")) == {0: None, 1: "type conflict"}


def test_missing_rule_fields_take_the_defaults(spark):
    got = made(spark, dict(filter_rule=None, target_key_prefix=None, expire_range=None), ONE).collect()
    assert [(r.op, r.target_key, r.ttl) for r in got] == [("WRITE", ":1", 3600)]


def test_a_snapshot_needs_its_time(spark):
    rules = rules_df(spark, [dict(id=1, sid=31, db="depot", tb="shelf", target_key_type="string", target_key_prefix="p", target_key_columns="id")])
    changes = to_changes(normalize_events(events(spark, dict(ONE, is_snapshot=True, file="", event_time=0))))
    assert [r.reason for r in cmd.dead_letters(changes, rules).collect()] == ["no time"]
    assert [r.t for r in cmd.kv_commands(changes, rules, snapshot_time=500).collect()] == [500]


@pytest.mark.parametrize("key", [1, 3 << 20])
def test_a_later_delete_beats_a_resync_row(spark, key):
    rules = rules_df(spark, [dict(id=1, sid=31, db="depot", tb="shelf", target_key_type="string", target_key_prefix="u", target_key_columns="id")])
    log = events(spark, dict(ONE, file="f", pos=10, event_time=10), dict(ONE, event="delete", file="f", pos=30, event_time=30))
    again = src.snapshot_events(spark.createDataFrame([(1, "synced", key)], "id int, name string, k long"), 31, "depot", "shelf",
                                ["id", "name"], "k", at=("f", 20))
    changes = to_changes(normalize_events(log)).unionByName(to_changes(normalize_events(again)), allowMissingColumns=True)
    made_ = cmd.kv_commands(changes, rules, snapshot_time=20)
    assert state.fold(made_, 31)["string"].count() == 0


def test_an_emptied_set_is_gone(spark):
    rule = dict(target_key_type="set", target_key_columns="")
    commands = made(spark, rule, dict(ONE, pos=1, event_time=5), dict(ONE, event="delete", pos=2, event_time=6))
    keys, items = state.resolve_keys(state.key_lines(commands)), state.item_lines(commands)
    assert state.alive_keys(keys, 7).count() == 1
    assert state.existing_keys(keys, items, 7).count() == 0


def test_what_a_crashed_compaction_leaves_is_overwritten(spark):
    commands = made(spark, {}, dict(ONE, pos=1, event_time=5))
    root = shared_folder(spark)
    store = Store(spark, root)
    for batch in (0, 1):
        store.put_commands(commands, batch)
    spark.range(1).write.parquet(f"{root}/merged_keys/upto=0/_temporary/0")
    spark.range(1).write.parquet(f"{root}/merged_items/upto=0")  # items without the marker
    assert store.merged_to() == -1 and store.state(6)["string"].count() == 1
    store.compact(0)
    assert store.merged_to() == 0 and store.state(6)["string"].count() == 1
    store.put_commands(commands.where("false"), 2)
    store.compact(2)
    assert store.merged_to() == 2 and store.state(6)["string"].count() == 1


def test_positions_are_pushed_down(spark, tmp_path):
    events(spark, dict(file="f1", pos=1), dict(file="f1", pos=9), dict(file="f2", pos=1)).write.parquet(f"{tmp_path}/log")
    late = src.after_position(src.read_events(spark, f"{tmp_path}/log"), "f1", 5)
    assert sorted((r.file, r.pos) for r in late.collect()) == [("f1", 9), ("f2", 1)]
    plan = late._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(file,f1)" in plan
