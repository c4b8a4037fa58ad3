"""One query per operator over its whole table, with the SQL it is checked with where SQL can say it."""

import os

from pyspark.sql import functions as F

from rowtide.llm import (bpe, contamination, conversations, exact, katz, language, licenses, lines, outliers, pieces, quality, simhash,
                         spelling)
from rowtide.llm.common import remainder, table

TOKENIZERS = os.environ.get("ROWTIDE_TOKENIZERS", "/opt/tokenizers")

QUERIES, ORACLES = {}, {}


def query(sql=None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f
    return register


@query()
def op1_katz(spark, sf_dir):
    """Log10 probability of every document under a bigram model with Katz backoff; a seventh of the ids is held out."""
    return katz.fit_and_score(table(spark, sf_dir, "documents"), remainder("doc_id", 7) == 2)


@query()
def op2_token_counts(spark, sf_dir):
    """Pieces and best score of every text, by the unigram reading of the piece vocabulary."""
    counted = pieces.count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                  f"{TOKENIZERS}/piece_bpe_32k.model")
    return counted.select("doc_id", "n_tokens", "score")


@query("""
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)""")
def op3_exact_dedup(spark, sf_dir):
    """Groups of equal texts; the largest id of each stays."""
    return exact.duplicates(table(spark, sf_dir, "documents"))


@query()
def op4_quality(spark, sf_dir):
    """Probability of label 1 for every document; a third of the ids is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, quality.learnable(table(spark, sf_dir, "labels")), "quality")
    return quality.classify(docs, model, positive=1).select(
        "doc_id", (remainder("doc_id", 3) == 1).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


WORDS_SQL = (r"list_filter(regexp_split_to_array(translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')")


@query(f"""
WITH d AS (SELECT doc_id, {WORDS_SQL.format('text')} AS words FROM documents),
i AS (SELECT item_id, {WORDS_SQL.format('text')} AS words FROM benchmark),
w AS (SELECT DISTINCT item_id, words[s:s + 12] AS win FROM (
        SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS s FROM i WHERE len(words) > 0)),
k AS (SELECT DISTINCT len(win) AS k FROM w),
g AS (SELECT doc_id, s, k, array_to_string(words[s:s + k - 1], ' ') AS g FROM (
        SELECT doc_id, words, k, unnest(range(1, len(words) - k + 2)) AS s FROM d, k WHERE len(words) >= k)),
o AS (SELECT doc_id, s, k, item_id FROM g JOIN w ON array_to_string(win, ' ') = g AND len(win) = k),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM o) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items
      FROM o GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(words), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)""")
def op5_contamination(spark, sf_dir):
    """Benchmark passages of 13 words in every document."""
    found = contamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items",
                        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated")


@query()
def op6_simhash(spark, sf_dir):
    """Components of texts whose fingerprints differ in three bits at most."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(f"""
WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
                  unnest(range(len(string_split(text, chr(10))))) AS place FROM documents),
bad AS (SELECT line, min(doc_id) AS first FROM l WHERE trim(line) <> '' GROUP BY line
        HAVING count(DISTINCT coalesce(source, '')) >= {lines.SITES}),
m AS (SELECT doc_id, l.line, place, first IS NULL OR doc_id = first AS stays FROM l LEFT JOIN bad USING (line))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (stays), '')) AS text_sha256
FROM m GROUP BY doc_id""")
def op7_line_dedup(spark, sf_dir):
    """Every document without boilerplate lines, as a digest of its text."""
    clean = lines.remove_boilerplate(table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


@query()
def op8_bpe(spark, sf_dir):
    """Ids and decoded text of every document, as digests."""
    return bpe.digests(table(spark, sf_dir, "documents"), f"{TOKENIZERS}/word_bpe_49k.json")


def _phrase_sql(phrase):
    stands = " AND ".join(f"words[i + {j + 1}] = '{p}'" for j, p in enumerate(phrase.split(" ")))
    return f"list_filter(range(len(words)), lambda i: {stands})"


def _statements_sql():
    """CTEs `d` (documents as words) and `m` (doc_id, s, e, label, c): the spans that state a licence."""
    values = ", ".join(f"('{label}', '{text}')" for label, text in licenses.TEMPLATES)
    return f"""d AS (SELECT doc_id, {WORDS_SQL.format('text')} AS words FROM documents),
t0 AS (SELECT label, {WORDS_SQL.format('text')} AS every FROM (VALUES {values}) v(label, text)),
t AS (SELECT label, list_distinct(every) AS words, ceil(len(list_distinct(every)) * {licenses.SHARE}) AS need,
             ceil(len(every) / {licenses.SHARE})::BIGINT AS reach FROM t0),
w AS (SELECT doc_id, label, t.words, need, s, d.words[s + 1:s + reach] AS win
      FROM (SELECT doc_id, words, unnest(range(len(words))) AS s FROM d) d JOIN t ON list_contains(t.words, d.words[s + 1])),
f AS (SELECT *, list_intersect(words, win) AS got FROM w WHERE len(list_intersect(words, win)) >= need),
g AS (SELECT doc_id, label, words, s, s + list_max(list_transform(got, lambda x: list_position(win, x))) - 1 AS e, len(got) / len(words) AS c FROM f),
m AS (SELECT doc_id, s, e, label, c FROM g WHERE NOT EXISTS (SELECT 1 FROM g o WHERE o.doc_id = g.doc_id AND o.s <= g.s AND o.e >= g.e
      AND len(o.words) > len(g.words) AND len(list_intersect(o.words, g.words)) = len(g.words)))"""


def _license_sql(statements=False):
    """`statements` adds the column of that name: the different spans that state a licence, in order."""
    places = {label: _phrase_sql(p) for p, label in licenses.PHRASES}
    every = "list_concat(" * (len(places) - 1) + f"p_{licenses.PHRASES[0][1]}" + "".join(f", p_{x})" for _, x in licenses.PHRASES[1:])
    base = " UNION ALL ".join(f"SELECT doc_id, '{x}' AS label FROM b WHERE len(p_{x}) > 0" for _, x in licenses.PHRASES)
    stated = """,
st AS (SELECT doc_id, string_agg(s || '-' || e || ' ' || label || ' ' || c::DOUBLE, ',' ORDER BY s, e, label, c) AS statements
       FROM (SELECT DISTINCT doc_id, s, e, label, c FROM m) GROUP BY doc_id)""" if statements else ""
    return f"""
WITH {_statements_sql()},
b AS (SELECT doc_id, len(words)::BIGINT AS n_words, {', '.join(f'{sql} AS p_{x}' for x, sql in places.items())} FROM d),
p AS (SELECT doc_id, n_words, {every} AS places FROM b),
bl AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM ({base}) GROUP BY doc_id),
al AS (SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM ({base} UNION ALL SELECT doc_id, label FROM m) GROUP BY doc_id),
s AS (SELECT doc_id, max(c) AS c FROM m GROUP BY doc_id){stated}
SELECT p.doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
       coalesce(bl.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN len(places) > 0 THEN 1.0 ELSE coalesce(c, 0.0) END::DOUBLE AS score{", coalesce(st.statements, '') AS statements" if statements else ""}
FROM p LEFT JOIN bl USING (doc_id) LEFT JOIN al USING (doc_id) LEFT JOIN s USING (doc_id){" LEFT JOIN st USING (doc_id)" if statements else ""}"""


@query(_license_sql())
def op9_licenses(spark, sf_dir):
    """Licence phrases and licence statements in every document."""
    return licenses.scan(table(spark, sf_dir, "documents"))


@query(_license_sql(statements=True))
def license_statements(spark, sf_dir):
    """As op9_licenses, with the places of the licence statements of every document."""
    found = licenses.scan(table(spark, sf_dir, "documents"), statements=True)
    one = F.transform("statements", lambda s: F.concat(s["start"].cast("string"), F.lit("-"), s["end"].cast("string"), F.lit(" "), s["label"],
                                                       F.lit(" "), s["containment"].cast("string")))
    return found.withColumn("statements", F.array_join(one, ","))


@query()
def op10_language(spark, sf_dir):
    """Language of every document; a fifth of the ids is held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    profiles = language.fit(docs.where(remainder("doc_id", 5) != 0))
    return language.identify(docs.drop("lang"), profiles).select(
        "doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


@query()
def op11_conversations(spark, sf_dir):
    """Faults of every conversation after damage, its cheapest repair, and a digest of what that gives."""
    return conversations.repair(conversations.damaged(table(spark, sf_dir, "conversations")))


@query()
def op12_outliers(spark, sf_dir):
    """Statistics of every document; kept are those that pass the base rules and lie among their language and source."""
    return outliers.verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query()
def op13_spelling(spark, sf_dir):
    """Words of at least seven letters, their near words, and the frequent form each is a variant of."""
    return spelling.variants(table(spark, sf_dir, "documents"))
