"""Golden rows for the operators, one table per topic."""

import json
import random
import xml.etree.ElementTree as ET

import pytest
from pyspark.sql import functions as F

from rowtide.functions.codec import compress, decompress
from rowtide.functions.joins import join_control
from rowtide.functions.scan import previous, row_number, running_max
from rowtide.functions.text import float_text, image_json, image_xml, json_cell_quote, json_heads, json_plain, xml_escape, xml_heads
from rowtide.operators import commands as cmd
from rowtide.operators import positions as pos
from rowtide.operators import rules as rule_ops
from rowtide.operators.ddl import alter_feed, resolve_shadow
from rowtide.operators.messages import ddl_messages, messages
from rowtide.operators.normalize import deliver, normalize_events, to_changes
from rowtide.plans import feeds
from rowtide.schema import EVENTS_RAW, rules_df
from rowtide.sources import feed as src


def raw_event(**over):
    base = dict(sid=31, db="depot", tb="shelf", event="update", file="log.000040", pos=9120, event_time=7,
                tx_id=1, event_ord=1, is_snapshot=False,
                table_columns=[("id", "int"), ("name", "string")],
                rows=[["1", "ada"], ["1", "bea"], ["2", "cid"], ["2", "dov"]], query=None)
    return tuple({**base, **over}[n] for n in EVENTS_RAW.fieldNames())


def events(spark, *rows):
    return spark.createDataFrame([raw_event(**r) for r in rows], EVENTS_RAW)


def one(df):
    return df.collect()[0]


@pytest.mark.parametrize("text,key,js", [
    ("100.0", "100", "100"), ("1e6", "1e+06", "1000000"), ("1e21", "1e+21", "1e+21"), ("1e20", "1e+20", "1" + "0" * 20),
    ("1e-7", "1e-07", "1e-7"), ("0.00001", "1e-05", "0.00001"), ("0.0001", "0.0001", "0.0001"),
    ("-2.5", "-2.5", "-2.5"), ("123456.789", "123456.789", "123456.789"), ("0", "0", "0"), ("1e100", "1e+100", "1e+100"),
])
def test_float_text(spark, text, key, js):
    df = spark.range(1).select(F.lit(text).alias("v"))
    assert tuple(one(df.selectExpr(float_text("v", "key"), float_text("v", "json")))) == (key, js)


def test_json_strings(spark):
    texts = ['plain', '', 'a"b\\c', "<&>", "tab\tnl\ncr\r", "\x01\x1f ", "é'"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    got = [r[0] for r in df.selectExpr(json_cell_quote("v")).collect()]
    assert [json.loads(g) for g in got] == texts
    assert got[3] == '"\\u003c\\u0026\\u003e"' and got[5] == '"\\u0001\\u001f\\u2028"'
    broken = spark.sql("select cast(x'61ff62' as string) v").selectExpr(json_cell_quote("v"))
    assert one(broken)[0] == '"a\\ufffdb"'


def test_xml_text(spark):
    df = spark.range(1).select(F.lit("<a b='1'>&\"\n\x01").alias("v"))
    assert one(df.selectExpr(xml_escape("v")))[0] == "&lt;a b=&#39;1&#39;&gt;&amp;&#34;&#xA;�"


def test_texts_of_ascii_are_told_by_one_table(spark):
    short = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    odd = lambda c: ord(c) < 32 or c in '<>&\u2028\u2029'
    shown = lambda t: '"' + "".join(short.get(c, f"\\u{ord(c):04x}" if odd(c) else c) for c in t) + '"'
    texts = [f"a{chr(c)}é{x}" for c in range(0x80) for x in "z<"] + [f"a{chr(c)}z" for c in [*range(0x100), 0x2028, 0x2029, 0x1D11E]]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r[0]: r[1] for r in df.selectExpr("t", json_cell_quote("t")).collect()} == {t: shown(t) for t in texts}
    assert {r[0]: r[1] for r in df.selectExpr("t", json_plain("t")).collect()} == {t: shown(t) == f'"{t}"' for t in texts}


def test_image_json_orders_keys_and_keeps_nulls(spark):
    cells = [("b", "int", "2"), ('a"', "string", None), ("c", "decimal", "1.50"), ("d", "float", "1000000.0")]
    df = spark.createDataFrame([(cells,)], "i array<struct<name:string,type:string,value:string>>")
    assert one(df.selectExpr(image_json("i")))[0] == '{"a\\"":null,"b":2,"c":"1.50","d":1000000}'
    assert one(df.selectExpr(image_json("i", "array('c','b')", "number")))[0] == '{"c":1.50,"b":2}'


def test_sample_update_message(spark):
    rules = rules_df(spark, [dict(id=1, sid=31, db="depot", tb="shelf")])
    df = normalize_events(events(spark, {}))
    got = one(messages(df, rules, "t"))
    assert got.topic == "t" and got.key is None
    assert json.loads(got.value) == {
        "sid": 31, "dbname": "depot", "tbname": "shelf", "filename": "log.000040", "position": 9120,
        "event_time": 7, "event": "update",
        "columns": [{"id": 1, "name": "bea"}, {"id": 1, "name": "ada"}, {"id": 2, "name": "dov"}, {"id": 2, "name": "cid"}]}
    assert list(json.loads(got.value))[:4] == ["sid", "dbname", "tbname", "filename"]
    root = ET.fromstring(one(messages(df, rules, "t", fmt="xml")).value)
    assert root.tag == "contenet"
    assert [[(c.get("name"), c.text) for c in g] for g in root.findall("columns")][0] == [("id", "1"), ("name", "bea")]
    assert len(root.findall("columns")) == 4


def test_messages_without_rules_are_whole_events(spark):
    rules = rules_df(spark, [dict(id=1, sid=31, db="x", tb="y")])
    assert messages(normalize_events(events(spark, {})), rules, "t").count() == 1


def test_row_split_key_and_topic(spark):
    rules = rules_df(spark, [
        dict(id=1, sid=31, db="depot", tb="shelf", message_key_columns="name, id",
             message_topic_rule='{"column_name":"id","topic_rule":{"1":"old"}}'),
        dict(id=2, sid=31, db="depot", tb="shelf",
             message_topic_rule='{"column_name":"id","topic_rule":{"1":"one"}}')])
    got = messages(normalize_events(events(spark, {})), rules, "rest").orderBy("row_ord").collect()
    assert [(r.topic, r.key) for r in got] == [("one", "bea:1"), ("rest", "dov:2")]
    assert [len(json.loads(r.value)["columns"]) for r in got] == [2, 2]


def test_schema_drift(spark):
    cols = [(n, "string") for n in "abcd"]
    df = events(spark, dict(event="insert", table_columns=cols, rows=[["1", "2", "3"]]),
                dict(event="delete", table_columns=cols[:3], rows=[["1", "2", "3", "4"]]))
    got = to_changes(normalize_events(df)).select(F.transform("after", lambda c: c["name"]).alias("n")).collect()
    assert [r.n for r in got] == [["a", "b", "c"], ["a", "b", "c"]]


def test_transaction_chunks(spark):
    rows = [dict(tx_id=t, event_ord=i, pos=1000 * t + i, event="insert") for t, n in ((1, 9), (2, 20)) for i in range(1, n + 1)]
    rows.append(dict(is_snapshot=True, file="", pos=0, tx_id=None, event="insert"))
    sent = deliver(events(spark, *rows), tx_block=4).collect()
    by = {(r.tx_id, r.n): r for r in sent}
    assert {by[1, i].sent_file for i in range(1, 10)} == {""}
    assert (by[1, 9].sent_time, by[1, 8].sent_time) == (0, 7)
    assert by[2, 18].sent_time == 0 and by[2, 18].chunk_no == 1
    assert [(by[2, i].sent_pos, by[2, i].chunk_no) for i in (19, 20)] == [(2020, 2), (2020, 2)]
    assert (by[None, 1].sent_file, by[None, 1].sent_pos) == ("", 0)
    got = pos.delivered_positions(deliver(events(spark, *rows))).collect()
    assert [(r.tx_id, r.chunk_no, r.pos) for r in got] == [(2, 2, 2020)]


FILTER_CASES = {
    "": (True, True), "name=bea": (True, False), " name = bea , id=1": (True, False), "nosuch=1": (True, True),
    "id=9": (False, False), "broken": (True, True), "id=9,broken": (False, False), "broken,id=9": (True, True),
    "id=1=1,id=9": (True, True), " ": (True, True),
}


def test_filter_reading_order(spark):
    rules = rules_df(spark, [dict(id=i, sid=31, db="depot", tb="shelf", target_key_type="string", filter_rule=f)
                             for i, f in enumerate(FILTER_CASES)])
    df = cmd.fan_out(to_changes(normalize_events(events(spark, {}))), rules)
    got = {}
    for r in df.selectExpr("rule_id", "row_ord", f"{cmd.passes('after')} AS ok").collect():
        got.setdefault(r.rule_id, {})[r.row_ord] = r.ok
    assert [(got[i][0], got[i][1]) for i in range(len(FILTER_CASES))] == list(FILTER_CASES.values())


def made(spark, rule, *rows):
    rules = rules_df(spark, [dict(dict(id=1, sid=31, db="depot", tb="shelf", target_key_type="string",
                                       target_key_prefix="p", target_key_columns="id"), **rule)])
    return cmd.kv_commands(to_changes(normalize_events(events(spark, *rows))), rules)


def ops(df):
    return [(r.phase, r.op, r.target_key, r.value, r.ttl) for r in df.orderBy("phase", "row_ord").collect()]


def test_clean_ups_come_first(spark):
    swap = dict(rows=[["1", "a"], ["2", "a"], ["2", "b"], ["1", "b"]])
    got = ops(made(spark, dict(is_full_column=0, replic_columns="name"), swap))
    assert got == [(0, "DEL", "p:1", None, None), (0, "DEL", "p:2", None, None),
                   (1, "WRITE", "p:2", '{"name":"a"}', 3600), (1, "WRITE", "p:1", '{"name":"b"}', 3600)]


def test_clean_up_when_a_filter_column_changes(spark):
    leave = dict(rows=[["1", "a"], ["1", "b"]])
    assert ops(made(spark, dict(filter_rule="name=a"), leave)) == [(0, "DEL", "p:1", None, None)]
    assert ops(made(spark, dict(filter_rule="name=b"), leave))[0][:3] == (1, "WRITE", "p:1")
    assert [o[:2] for o in ops(made(spark, {}, leave))] == [(1, "WRITE")]


def test_set_and_delete_commands(spark):
    leave = dict(rows=[["1", "a"], ["1", "b"]])
    rule = dict(target_key_type="set", is_full_column=0, replic_columns="name")
    assert ops(made(spark, rule, leave)) == [(0, "REMOVE", "p", '{"name":"a"}', None), (1, "WRITE", "p", '{"name":"b"}', 3600)]
    gone = dict(event="delete", rows=[["1", "a"]])
    assert ops(made(spark, rule, gone)) == [(1, "REMOVE", "p", '{"name":"a"}', 3600)]
    assert ops(made(spark, {}, gone)) == [(1, "DEL", "p:1", None, None)]
    assert ops(made(spark, dict(delay_del=1, delay_expire_time=60), gone)) == [(1, "EXPIRE", "p:1", None, 60)]
    assert ops(made(spark, dict(refresh_type=0, target_key_type="set"), gone)) == [(1, "DEL", "p", None, None)]


def test_keys_and_null_text(spark):
    row = dict(event="insert", rows=[[None, "a:b"]])
    assert ops(made(spark, dict(target_key_columns="id,nosuch,name"), row))[0][2] == "p:<nil>:a:b"
    assert ops(made(spark, dict(target_key_columns=""), row))[0][2] == "p"
    assert ops(made(spark, {}, row))[0][3] == '{"id":null,"name":"a:b"}'


def test_ttl(spark):
    row = dict(event="insert", rows=[[str(i), "x"] for i in range(200)])
    assert {o[4] for o in ops(made(spark, dict(expire_time=0), row))} == {86400}
    spread = [o[4] for o in ops(made(spark, dict(expire_time=1000, expire_range=10), row))]
    assert min(spread) >= 900 and max(spread) < 1100 and len(set(spread)) > 50
    assert spread == [o[4] for o in ops(made(spark, dict(expire_time=1000, expire_range=10), row))]
    assert {o[4] for o in ops(made(spark, dict(expire_time=1, expire_range=1), row))} == {0}


def test_codec_modes(spark):
    texts = ["", "x", "é" * 5000, "\x00\x01"]
    df = spark.createDataFrame([(t, m) for t in texts for m in range(5)], "t string, m int")
    packed = df.withColumn("p", compress(F.col("t"), F.col("m"), F.lit(-1))).select(
        "t", "m", "p", decompress(F.col("p"), F.col("m")).alias("back")).collect()
    assert all(r.back == r.t for r in packed)
    assert not any(b"\n" in bytes(r.p) for r in packed if r.m in (2, 4))
    huffman = df.select("t", decompress(compress(F.col("t"), F.lit(1), F.lit(-2)), F.lit(1)).alias("back")).collect()
    assert all(r.back == r.t for r in huffman)


def test_codecs_take_a_value_at_a_time(spark):
    """Arrow batches hold ten thousand values of any weight."""
    df = spark.createDataFrame([("x", 1)], "t string, m int").select(decompress(compress(F.col("t"), F.col("m"), F.lit(-1)), F.col("m")).alias("t"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan


def test_names_are_escaped_once_per_rule(spark):
    """The texts before the values, worked out from the names alone, change no message; absent and repeated names count as before."""
    cells = [("b", "int", "1"), ('q"<', "string", "x&y"), ("b", "float", "2.50"), ("n", "string", None)]
    df = spark.createDataFrame([(cells, names) for names in (None, [], ["b"], ['q"<', "none", "b", "n"])],
                               "i array<struct<name:string,type:string,value:string>>, names array<string>")
    df = df.withColumns({"jh": F.expr(json_heads("names")), "xh": F.expr(xml_heads("names"))})
    for plain, headed in ((image_json("i", "names"), image_json("i", "names", heads="jh")), (image_xml("i", "names"), image_xml("i", "names", heads="xh"))):
        rows = df.selectExpr(f"{plain} AS a", f"{headed} AS b").collect()
        assert [r.a for r in rows] == [r.b for r in rows]
    assert one(df.where("size(names) = 4").selectExpr(f"{image_json('i', 'names', heads='jh')} AS a")).a == '{"q\\"\\u003c":"x\\u0026y","b":1,"b":2.5,"n":null}'


def test_lines_of_orders_of_any_size(spark, tmp_path):
    """Orders that are put in order in one place and orders numbered block by block give the same events."""
    lines = [(o, None if i % 50 == 7 else i % 9, None if i % 40 == 3 else i * 37 % 11000, i % 5, float(i % 3), i * 1.25, f"d{i % 4}")
             for o, n in ((1, 3), (2, 200), (3, 64), (4, 65), (None, 5)) for i in range(n)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, "
                                 "l_extendedprice double, l_shipdate string").write.parquet(f"{tmp_path}/lineitem.parquet")
    found = [sorted((r.tx_id, r.event_ord, r.rows) for r in feeds.lineitem_feed(spark, str(tmp_path), order_lines=n).collect())
             for n in (0, 64, 1000)]
    assert found[0] == found[1] == found[2] and [e[:2] for e in found[0]] == [(1, 1), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (4, 1), (4, 2)]


def test_rule_checks(spark):
    bad = dict(id=11, sid=1, db="shop", tb="orders", target_key_type="list", target_key_prefix="  ", is_compress=7,
               expire_range=80, refresh_type=5, is_dump=2, expire_time=0, is_full_column=3, filter_rule="a")
    good = dict(id=1, sid=1, target_key_type="set", target_key_prefix="p", filter_rule="a=b, c = d", compress_level=99)
    got = rule_ops.rule_violations(rules_df(spark, [bad, good])).collect()
    assert sorted(r.field for r in got) == sorted(
        ["target_key_type", "target_key_prefix", "is_compress", "expire_range", "refresh_type", "is_dump",
         "expire_time", "is_full_column", "filter_rule"])
    assert rule_ops.rule_violations(rules_df(spark, [bad]), with_targets=False).count() == 0


def test_statements(spark):
    texts = [("ALTER TABLE orders x", "orders"), ("alter t _orders_new, _orders_new", "_orders_new"),
             ("ALTER a", "__orders_new"), ("Alter b", "orders"), ("TRUNCATE c", "orders"), ("ALTER", "orders"),
             ("ALTER d", "_orders2_new"), ("ALTER e", "none")]
    df = spark.createDataFrame([(1, "f", i, i, q, [("shop", t)]) for i, (q, t) in enumerate(texts)],
                               "sid int, file string, pos bigint, event_ord bigint, query string, "
                               "changed array<struct<db:string,tb:string>>")
    rules = rules_df(spark, [dict(id=1, sid=1, db="shop", tb="orders")])
    got = {r.event_ord: r for r in alter_feed(df, rules).collect()}
    assert sorted(got) == [0, 1, 2]
    assert got[1].query == "alter t orders, _orders_new" and got[1].tb == "" and got[1].db == "shop"
    assert alter_feed(df, rules, supported=False).count() == 0
    value = one(ddl_messages(alter_feed(df, rules), "t").orderBy("event_ord")).value
    assert json.loads(value)["query"] == "ALTER TABLE orders x" and json.loads(value)["columns"] == []
    assert "<event>query</event></contenet>" in one(ddl_messages(alter_feed(df, rules), "t", "xml")).value
    own = spark.createDataFrame([(1, "shop", "_t_new")], "sid int, db string, changed_tb string")
    named = rules_df(spark, [dict(id=i, sid=1, db="shop", tb=t) for i, t in enumerate(["t", "_t", "_t_new"])])
    assert one(resolve_shadow(own, named)).tb == "_t_new"


def test_resync_list(spark):
    assert src.parse_table_list("depot.shelf, yard.gate_log,bad,a.b.c,") == [("depot", "shelf"), ("yard", "gate_log")]


def test_json_feed(spark):
    line = events(spark, {}).toJSON().first()
    parsed = src.parse_events(spark.createDataFrame([(line,)], "value string"))
    assert one(parsed).rows == one(events(spark, {})).rows


def hot(spark, n=400):
    """Two thirds of the rows under one key."""
    rng = random.Random(3)
    rows = [("hot" if rng.random() < 0.67 else f"k{rng.randint(0, 30)}", i, rng.randint(0, 99)) for i in range(n)]
    df = spark.createDataFrame(rows, "k string, i int, v int").withColumn("b", F.floor(F.col("i") / 16))
    return rows, df


def test_scans_over_blocks(spark):
    rows, df = hot(spark)
    got = {(r.k, r.i): r.n for r in row_number(df, ["k"], ["b"], ["i"], "n").collect()}
    top = {(r.k, r.i): r.m for r in running_max(df, ["k"], ["b"], ["i"], F.col("v"), "m").collect()}
    back = {(r.k, r.i): r.p for r in previous(df, ["k"], ["b"], ["i"], F.struct("i", "v"), "p").collect()}
    seen = {}
    for k, i, v in rows:
        line = seen.setdefault(k, [])
        assert got[k, i] == len(line) + 1
        assert top[k, i] == max([x for _, x in line] + [v])
        assert (tuple(back[k, i]) if back[k, i] else None) == (line[-1] if line else None)
        line.append((i, v))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_broadcast(spark, how):
    _, df = hot(spark)
    small = spark.createDataFrame([(f"k{i}", i) for i in range(0, 30, 2)] + [("hot", 99)], "k string, x int")
    a = join_control(df, small, ["k"], how)
    b = join_control(df, small, ["k"], how, broadcast_bytes=3, salts=4)
    cols = sorted(a.columns)
    key = lambda r: str(tuple(r))
    assert sorted(a.select(cols).collect(), key=key) == sorted(b.select(cols).collect(), key=key)


@pytest.mark.parametrize("interval", [1, 7, 100])
def test_throttle_matches_greedy(spark, interval, monkeypatch):
    monkeypatch.setattr(pos, "STRETCH", 3)
    rng = random.Random(interval)
    rows = []
    for sid in (1, 2):
        t = 0
        for i in range(150):
            t += rng.choice([0, 1, 2, 3, 40])
            rows.append((sid, f"f{i:05d}", i, t))
    df = spark.createDataFrame(rows, "sid int, file string, pos bigint, ms bigint")
    want = set()
    for sid in (1, 2):
        last = None
        for s, f, p, t in rows:
            if s == sid and (last is None or t - last > interval):
                want.add((s, f, p, t))
                last = t
    assert {tuple(r) for r in pos.throttled(df, "ms", interval).collect()} == want
    assert pos.throttled(df, "ms", 0).count() == len(rows)


def test_translation_matches_lookup(spark):
    rng = random.Random(4)
    lines = [(i, 1, f"m{rng.randint(0, 1)}", f"b{rng.randint(0, 3)}", rng.randint(0, 60), "s", "r", i * 10, 0) for i in range(1, 120)]
    known = spark.createDataFrame(lines, "id bigint, sid int, master_mysql_addr string, master_binlog_file_name string, "
                                  "master_binlog_position bigint, slave_mysql_addr string, slave_binlog_file_name string, "
                                  "slave_binlog_position bigint, insert_timestamp bigint")
    asked = [(1, f"m{rng.randint(0, 2)}", f"b{rng.randint(0, 3)}", rng.randint(0, 60), q) for q in range(60)]
    df = spark.createDataFrame(asked, "sid int, mysql_addr string, file string, pos bigint, q int")
    got = {r.q: r.new_pos for r in pos.translate(df, known, pos_block=8).collect()}
    for sid, addr, file, p, q in asked:
        best = max((ln[0] for ln in lines if ln[2] == addr and (ln[3], ln[4]) <= (file, p)), default=None)
        assert got[q] == (best * 10 if best else None)


def test_rule_changes(spark):
    current = rules_df(spark, [dict(id=1, sid=1, db="d", tb="a"), dict(id=2, sid=1, db="d", tb="b")])
    pending = rules_df(spark, [dict(id=2, sid=1, db="d", tb="b", operation=4), dict(id=9, sid=1, db="d", tb="zz", operation=4),
                               dict(id=3, sid=1, db="d", tb="c", operation=3, is_dump=1)])
    assert sorted(r.id for r in rule_ops.apply_rule_changes(current, pending).collect()) == [1, 3]
    assert [r.tb for r in rule_ops.tables_to_snapshot(pending).collect()] == ["c"]
    assert [r.tb for r in rule_ops.tables_dropped(current, pending).collect()] == ["b"]
    assert [(r.id, r.operation) for r in rule_ops.acknowledge(pending).collect()] == [(3, 0)]
