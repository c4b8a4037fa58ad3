"""Finds licence statements: known phrases word by word, and text blocks that contain a template.

A block is a span of a text's words, free of lines, since notices are wrapped: up to
1 / share times as many words as the template has. It contains the template if at
least a given share of the template's words are among its own. The join that finds
the blocks is exact: words are ordered by how often they occur in all documents, the
rarest first; a span with at least `need` of a template's n words has one of the first
n - need + 1 in that order, so texts meet templates on those only (prefix). Too few
words around the place fall away (length), and so do places around which fewer than
`need` template words stand from the met one on in the order (position): a span is
found from the rarest template word it holds. What is left is compared word by word.

A span within one of a template that has all these words and more is no statement of
its own ("CC BY" in "CC BY-NC").
"""

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowtide.llm.common import plain_words, row_key
from rowtide.session import written

# The phrases looked for, and statements as they are commonly worded.
PHRASES = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("bsd", "Released under the BSD License"),
    ("cc-by", "Licensed under CC BY 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License"),
]
SHARE = 0.9
TEMPLATE_BYTES = 2**20  # templates sent to all tasks at a time
STRETCH = 4096  # words of a text that are searched at a time


def phrase_places(words, size, phrase):
    """Array of the places (from 0) where the words of `phrase` stand one after the other."""
    parts = phrase.split(" ")
    some = reduce(and_, [F.array_contains(words, p) for p in parts])
    stands = F.filter(F.sequence(F.lit(0), size - len(parts)),
                      lambda i: reduce(and_, [F.get(words, i + j) == p for j, p in enumerate(parts)]))
    return F.when(some & (size >= len(parts)), stands).otherwise(F.array().cast("array<int>"))


def in_blocks(rows, key, size):
    """`rows` in parts of about TEMPLATE_BYTES by the hash of `key`, each small enough for every task to hold."""
    blocks = (rows.agg(F.sum(size)).first()[0] or 0) // TEMPLATE_BYTES + 1
    for b in range(blocks):
        yield rows if blocks == 1 else rows.where(F.pmod(F.xxhash64(*key), F.lit(blocks)) == b)


def ordered_templates(df, templates, share, text_col):
    """(template, label, reach, words, need, prefix): different words, the rarest in all documents first.

    `reach` is the number of words a span may have.
    """
    spark = df.sparkSession
    given = spark.createDataFrame([(i, label, text) for i, (label, text) in enumerate(templates)], "template int, label string, text string")
    given = given.select("template", "label", plain_words(F.col("text")).alias("all")).where(F.size("all") > 0)
    given = given.select("template", "label", F.array_distinct("all").alias("words"), F.ceil(F.size("all") / F.lit(share)).cast("int").alias("reach"))
    # How often each template word occurs in all documents.
    wanted, often = written(spark, given.select(F.explode("words").alias("word")).distinct()), None
    for part in in_blocks(wanted, ["word"], F.octet_length("word") + 32):
        counted = df.select(F.explode(plain_words(F.col(text_col))).alias("word")).join(F.broadcast(part), "word").groupBy("word").agg(F.count("*").alias("often"))
        often = counted if often is None else often.unionAll(counted)
    ordered = given.select("template", "label", "reach", F.explode("words").alias("word")).join(often, "word", "left").groupBy("template", "label", "reach").agg(
        F.array_sort(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "word"))).alias("o"))
    need = F.ceil(F.size("words") * F.lit(share)).cast("int")
    ordered = ordered.select("template", "label", "reach", F.col("o.word").alias("words")).withColumn("need", F.greatest(F.lit(1), need))
    return ordered.withColumn("prefix", F.slice("words", F.lit(1), F.size("words") - F.col("need") + 1))


def spans_from(own, starts, words, need, reach):
    """Array of (start, end, n): spans of `own` that begin at one of `starts` with a template word and hold `need` of them.

    `n` is the number of different template words among `reach` words; the span ends where it has them all.
    """
    held = F.filter(starts, lambda s: F.array_contains(words, F.get(own, s)) & (F.size(F.array_intersect(words, F.slice(own, s + 1, reach))) >= need))
    got = F.transform(held, lambda s: F.struct(s.alias("start"), F.array_intersect(words, F.slice(own, s + 1, reach)).alias("got")))
    return F.transform(got, lambda m: F.struct(
        m["start"].alias("start"), F.size(m["got"]).alias("n"),
        (m["start"] + F.array_max(F.transform(m["got"], lambda w: F.array_position(F.slice(own, m["start"] + 1, reach), w))) - 1).cast("int").alias("end")))


def up_to(low, high):
    """The numbers from `low`, 0 at least, to `high`; none if there are none."""
    low = F.greatest(low, F.lit(0))
    return F.when(low <= high, F.sequence(low, high)).otherwise(F.array().cast("array<int>"))


def spans_of(texts, marks):
    """The spans of `texts` that hold the templates of `marks`, which are few enough for every task."""
    rare = [r["word"] for r in marks.select("word").distinct().collect()]
    # From a rare word a span reaches this far, and a span around that one as far again.
    far = 2 * (marks.agg(F.max("reach")).first()[0] or 0)

    own = F.col("own")
    parts = F.transform(F.sequence(F.lit(0), F.size(own) - 1, F.lit(STRETCH)), lambda a: F.struct(
        a.alias("a"), F.greatest(a - far, F.lit(0)).alias("first"),
        F.slice(own, F.greatest(a - far, F.lit(0)) + 1, STRETCH + 2 * far).alias("own")))
    texts = texts.select("key", F.explode(parts).alias("p")).select("key", "p.*")
    here = F.filter(F.sequence(F.col("a") - F.col("first"), F.least(F.col("a") - F.col("first") + STRETCH, F.size(own)) - 1), lambda i: F.get(own, i).isin(rare))
    near = F.transform(here, lambda i: F.struct(
        F.get(own, i).alias("word"), F.least(i, F.lit(far)).alias("at"), F.greatest(i - far, F.lit(0)).alias("skipped"),
        F.slice(own, F.greatest(i - far, F.lit(0)) + 1, 2 * far + 1).alias("own")))
    met = texts.select("key", "first", F.explode(near).alias("p")).select("key", (F.col("first") + F.col("p.skipped")).alias("first"), "p.word", "p.at", "p.own")
    met = met.join(F.broadcast(marks.drop("template", "prefix")), "word")
    at, reach = F.col("at"), F.col("reach")
    around = F.slice(own, F.greatest(at - reach + 1, F.lit(0)) + 1, 2 * reach - 1)
    met = met.where(F.size(around) >= F.col("need"))
    from_here = F.slice("words", F.col("place") + 1, F.size("words"))
    met = met.where(F.size(F.array_intersect(from_here, around)) >= F.col("need"))
    spans = spans_from(own, up_to(at - reach + 1, at), F.col("words"), F.col("need"), reach)
    met = met.select("*", F.explode(spans).alias("s"))
    start, end = F.col("s.start"), F.col("s.end")
    inside = F.exists("larger", lambda o: F.exists(
        spans_from(own, up_to(end - o["reach"] + 1, start), o["words"], o["need"], o["reach"]), lambda m: m["end"] >= end))
    return met.where(F.col("larger").isNull() | ~inside).select(
        "key", (F.col("first") + start).alias("start"), (F.col("first") + end).alias("end"), "label", (F.col("s.n") / F.size("words")).alias("containment"))


def template_spans(df, templates=TEMPLATES, share=SHARE, id_col="doc_id", text_col="text"):
    """(key, start, end, label, containment): spans of a text's words, over line breaks, that hold at least `share` of a template's.

    `key` names the row (`row_key`); words count from 0. A span begins with a template
    word, looks at `reach` words and ends with the last different template word found.
    Spans within one of a template with the same words and more are left out. A span
    may come several times. Templates are taken in blocks of TEMPLATE_BYTES, each
    with its own pass over the texts; texts of any length are searched in stretches.
    Null and wordless texts, an empty table and templates without words give no spans.
    """
    spark = df.sparkSession
    ordered = written(spark, ordered_templates(df, templates, share, text_col))
    outer = ordered.select(F.struct("words", "need", "reach").alias("o"), F.explode("words").alias("word"))
    larger = ordered.select("template", "words", F.get("words", F.lit(0)).alias("word")).join(outer, "word").where(
        (F.size("o.words") > F.size("words")) & (F.size(F.array_except("words", "o.words")) == 0))
    larger = larger.groupBy("template").agg(F.collect_list("o").alias("larger"))
    marks = written(spark, ordered.join(larger, "template", "left").select("*", F.posexplode("prefix").alias("place", "word")))
    texts = df.select(row_key(id_col, text_col).alias("key"), plain_words(F.col(text_col)).alias("own")).where(F.size("own") > 0)
    return reduce(DataFrame.unionAll, [spans_of(texts, part) for part in in_blocks(
        marks, ["template", "word"], F.octet_length(F.to_json(F.struct("*"))))])


def scan(df, phrases=PHRASES, templates=TEMPLATES, share=SHARE, id_col="doc_id", text_col="text", statements=False):
    """One row per row of `df`: id, `n_words`, `n_base`, `first_word`, `last_word`, `base_labels`, `labels`, `score`.

    `n_base` counts the places of all phrases; `first_word` and `last_word` are the
    smallest and largest, null without any. Label lists are sorted and joined by
    commas; `labels` adds those of contained templates (`template_spans`). The score is
    1 with a phrase, else the best containment found, else 0. With `statements` there is a
    column of that name: the different spans (start, end, label, containment) in order. Null counts as the empty
    text; further columns are not returned, repeated rows each get their row, an empty
    table gives none. Texts of any length are read whole.
    """
    none = F.array().cast("array<string>")
    rows = df.select(F.col(id_col), row_key(id_col, text_col).alias("key"), plain_words(F.col(text_col)).alias("words"))
    rows = rows.select(id_col, "key", "words", F.size("words").alias("size"))
    rows = rows.select(id_col, "key", F.col("size").cast("long").alias("n_words"),
                       *[phrase_places(F.col("words"), F.col("size"), p).alias(f"_p{i}") for i, (p, _) in enumerate(phrases)])
    places = F.concat(*[F.col(f"_p{i}") for i in range(len(phrases))])
    base = F.concat(*[F.when(F.size(f"_p{i}") > 0, F.array(F.lit(label))).otherwise(none) for i, (_, label) in enumerate(phrases)])
    rows = rows.select(id_col, "key", "n_words", F.size(places).cast("long").alias("n_base"), F.array_min(places).cast("long").alias("first_word"),
                       F.array_max(places).cast("long").alias("last_word"), F.array_sort(F.array_distinct(base)).alias("base"))
    span = F.struct("start", "end", "label", "containment")
    more = template_spans(df, templates, share, id_col, text_col).groupBy("key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best"),
        *([F.array_sort(F.collect_set(span)).alias("stated")] if statements else []))
    more = more.select(F.col("key.id").alias("_i"), F.col("key.h").alias("_h"), F.col("key.n").alias("_n"), *more.columns[1:])
    same = F.col("key.id").eqNullSafe(F.col("_i")) & (F.col("key.h") == F.col("_h")) & (F.col("key.n") == F.col("_n"))
    return rows.join(more, same, "left").select(
        id_col, "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union("base", F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
        *([F.coalesce("stated", F.array()).alias("statements")] if statements else []))
