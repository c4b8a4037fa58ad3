"""Registered queries of the subpackage: against their SQL, against plain versions, and on what is held out."""

import hashlib
import sys

import duckdb
import pandas as pd
import pytest
from docs import CLASHING, frame, rows
from pyspark.sql import functions as F
from test_operators import plain_components, plain_contamination, plain_fingerprint
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from rowtide.llm import queries
from rowtide.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    return con


def lines(rows_, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(str(r[i]) for i in order) for r in rows_)


def test_all_are_registered():
    ours = {n: q for n, q in entry.queries().items() if n.startswith("op") or n == "pipeline"}
    assert sorted(int(n[2:].split("_")[0]) for n in ours if n != "pipeline") == list(range(1, 14))
    assert "pipeline" in ours and set(queries.ORACLES) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_like_sql(spark, con, name):
    df = queries.QUERIES[name](spark, SF_DIR)
    cur = con.execute(queries.ORACLES[name])
    names = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(names)
    assert lines(df.collect(), df.columns) == lines(cur.fetchall(), names)


def test_katz_beats_word_counts_on_unseen_texts(spark):
    found = queries.op1_katz(spark, SF_DIR).where("held_out").agg(F.sum("score"), F.sum("base_score"), F.count("*")).first()
    assert found[2] > 10 and found[0] > found[1]


def test_quality_on_unseen_labels(spark):
    sf = "/root/testdata/sf0.01"
    found = queries.op4_quality(spark, sf).where("held_out").join(table(spark, sf, "labels"), "doc_id")
    right = found.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")), F.count("*")).first()
    assert right[1] > 80 and right[0] > 0.95


def test_language_on_unseen_texts(spark):
    found = queries.op10_language(spark, SF_DIR).where("held_out").join(table(spark, SF_DIR, "documents"), "doc_id")
    right = found.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int")), F.count("*")).first()
    assert right[1] > 20 and right[0] > 0.95


def test_held_out_rows_are_not_learned_from(spark, tmp_path):
    """Other labels and languages on the held-out rows leave every prediction as it was."""
    docs, labels = table(spark, SF_DIR, "documents"), table(spark, SF_DIR, "labels")
    from rowtide.llm.common import remainder
    docs.withColumn("lang", F.when(remainder("doc_id", 5) == 0, F.lit("xx")).otherwise(F.col("lang"))).withColumn(
        "source", F.lit("s")).write.parquet(f"{tmp_path}/documents.parquet")
    labels.withColumn("quality", F.when(remainder("doc_id", 3) == 1, 1 - F.col("quality")).otherwise(F.col("quality"))).write.parquet(
        f"{tmp_path}/labels.parquet")
    for name, value in (("op4_quality", "predicted"), ("op10_language", "lang_pred")):
        a, b = (queries.QUERIES[name](spark, d).select("doc_id", value).collect() for d in (SF_DIR, str(tmp_path)))
        assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_simhash_query(spark):
    found = queries.op6_simhash(spark, SF_DIR).toPandas()
    texts = pd.read_parquet(f"{SF_DIR}/documents.parquet").set_index("doc_id")["text"]
    assert all(f"{plain_fingerprint(texts[i]):016x}" == p for i, p in zip(found["doc_id"], found["fingerprint"]))
    root = plain_components([int(p, 16) for p in found["fingerprint"]])
    group = found["fingerprint"].map(lambda p: root[int(p, 16)])
    assert (found.groupby(group)["doc_id"].transform("min") == found["component_id"]).all()


def test_pipeline(spark, tmp_path):
    """Each stage against a plain version on what the one before kept."""
    docs = table(spark, SF_DIR, "documents")
    kept, columns = {}, docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF_DIR)
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        kept[name] = docs.toPandas()
        assert i == 4 or docs.columns == columns
    quality, line, near, clean, ids = kept.values()
    labels = pd.read_parquet(f"{SF_DIR}/labels.parquet").set_index("doc_id")["quality"]
    left = labels[labels.index.isin(quality["doc_id"])]
    assert left.mean() > 0.95 and (labels == 1).sum() - (left == 1).sum() <= 2
    parts = [(r.doc_id, r.source, x) for r in quality.itertuples() for x in r.text.split("\n")]
    sites = pd.DataFrame(parts, columns=["doc", "site", "line"]).query("line.str.strip(' ') != ''").groupby("line")
    many = {x for x, n in sites["site"].nunique().items() if n >= 10}
    first = sites["doc"].min()
    for a, b in zip(quality.sort_values("doc_id").itertuples(), line.sort_values("doc_id").itertuples()):
        assert b.text == "\n".join(x for x in a.text.split("\n") if x not in many or first[x] == a.doc_id)
        assert b.n_chars == len(b.text)
    root = plain_components([plain_fingerprint(t) for t in line["text"]])
    best = line.groupby(line["text"].map(lambda t: root[plain_fingerprint(t)]))["doc_id"].min()
    assert sorted(near["doc_id"]) == sorted(best)
    items = pd.read_parquet(f"{SF_DIR}/benchmark.parquet")
    found = plain_contamination(near["text"], list(zip(items["item_id"], items["text"])), 13)
    assert sorted(clean["doc_id"]) == sorted(d for d, (*_, bad) in zip(near["doc_id"], found) if not bad)
    library = Tokenizer.from_file(f"{queries.TOKENIZERS}/word_bpe_49k.json")
    texts = clean.set_index("doc_id")["text"]
    assert sorted(ids["doc_id"]) == sorted(texts.index)
    for r in ids.itertuples():
        e = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(e) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(e, skip_special_tokens=False).encode()).hexdigest()


def test_stages_on_odd_rows(spark):
    """Nulls, empty texts, repeated rows and clashing names go through every stage; an empty table stays empty."""
    for given in (rows(), []):
        docs = frame(spark, given)
        columns = docs.columns
        for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = stage(spark, docs, SF_DIR)
            if i < 4:
                assert docs.columns == columns and set(CLASHING) <= set(docs.columns)
                docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert docs.count() <= len(given) and (given or docs.count() == 0)


def test_import_without_the_subpackage():
    import subprocess
    code = ("import sys; sys.modules['corpus_pipeline'] = None\n"
            "class Gone:\n"
            "    def find_spec(self, name, *a):\n"
            "        if name in ('corpus_pipeline', 'rowtide.llm'):\n"
            "            raise ModuleNotFoundError(name=name)\n"
            "sys.modules.pop('corpus_pipeline'); sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as e; assert not [n for n in e.queries() if n.startswith('op')] and 'kv_set_state' in e.queries()")
    subprocess.run([sys.executable, "-c", code], check=True)
