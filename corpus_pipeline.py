"""From raw documents to token digests: each stage works on all that the one before kept."""

from pyspark.sql import functions as F

from rowtide.llm import bpe, contamination, lines, quality, simhash
from rowtide.llm.common import table
from rowtide.llm.queries import TOKENIZERS
from rowtide.session import written


def good_documents(spark, docs, sf_dir):
    """Drops documents the quality classifier rejects."""
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")), "quality")
    scored = quality.classify(docs, model, positive=1, name="_quality")
    return scored.where(F.col("_quality") >= 0.5).select(docs.columns)


def without_boilerplate(spark, docs, sf_dir):
    """Takes lines that stand on many sites out of the texts; documents stay, with their new length."""
    clean = lines.remove_boilerplate(docs)
    return clean.select([F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
                         for c in docs.columns])


def one_of_each(spark, docs, sf_dir):
    """Keeps the document with the smallest id of each group of near duplicates."""
    return simhash.keep_one(docs, simhash.near_duplicates(docs, shingle=3, max_bits=3))


def without_benchmark(spark, docs, sf_dir):
    """Drops documents with benchmark passages."""
    found = contamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return contamination.drop(docs, found)


def token_digests(spark, docs, sf_dir):
    """Ids and decoded text of what is left, as digests."""
    return bpe.digests(docs, f"{TOKENIZERS}/word_bpe_49k.json")


STAGES = [
    ("quality classifier", good_documents),
    ("line dedup", without_boilerplate),
    ("simhash near-dedup", one_of_each),
    ("benchmark decontamination", without_benchmark),
    ("bpe encoding", token_digests),
]

# Trained models and tokenizers are beyond SQL; the tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over `documents`, each written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(spark, docs)
    return docs
