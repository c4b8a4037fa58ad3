"""Finds benchmark passages in documents with a prefix-filtered join.

An item is cut into windows of a fixed number of words (a shorter item is one
window). A window is contained in a text only if all of its shingles are, so one
of them is a necessary prefix: the rarest, by how often it occurs in all
documents. Documents are joined with the windows on that shingle alone. The place
of the shingle fixes where the window would start; starts outside the text fall
away, and what is left is verified word by word.
"""

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.llm.common import packed, plain_words, row_key, unpacked
from rowtide.session import written

WINDOW = 13
SHINGLE = 3
BLOCK_BYTES = 32 * 2**20  # windows sent to all tasks at a time


def shingles(words, n, k):
    """Hashes of the runs of `k` words, in order; `n` words in all."""
    return F.when(n >= k, F.transform(F.sequence(F.lit(0), n - k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])))


def windows_of(items, id_col, text_col, window):
    """(words, n, items): the different windows with the ids, as strings, of the items that have them.

    A null id is the empty string; an item without words has no window.
    """
    rows = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"), plain_words(F.col(text_col)).alias("words"))
    rows = rows.select("item", "words", F.size("words").alias("size")).where("size > 0")
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.col("size") - window + 1))
    cut = rows.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, window))).alias("words"))
    return cut.groupBy("words").agg(F.collect_set("item").alias("items")).select("words", F.size("words").alias("n"), "items")


def in_blocks(rows, size):
    """`rows` in parts of about BLOCK_BYTES, each small enough for every task to hold."""
    total = rows.agg(F.sum(size)).first()[0] or 0
    blocks = total // BLOCK_BYTES + 1
    for b in range(blocks):
        yield rows if blocks == 1 else rows.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b)


def occurrences(docs, items, window=WINDOW, shingle=SHINGLE, id_col="doc_id", text_col="text", item_col="item_id", item_text_col="text"):
    """(key, start, n, items): where a window stands in a document (words from 0), and whose window it is.

    `key` names the document row (`row_key`); rows alike share it, and have their
    places listed once each.
    """
    spark = docs.sparkSession
    windows = written(spark, windows_of(items, item_col, item_text_col, window))
    texts = docs.select(row_key(id_col, text_col).alias("key"), plain_words(F.col(text_col)).alias("words"))
    texts = texts.select("key", "words", F.size("words").alias("size"))
    size = F.lit(64) + F.aggregate("words", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16) \
        + F.aggregate("items", F.lit(0).cast("long"), lambda a, w: a + F.octet_length(w) + 16)
    found = None
    for part in in_blocks(windows, size):
        for k in sorted(r["k"] for r in part.select(F.least("n", F.lit(shingle)).alias("k")).distinct().collect()):
            own = part.where(F.least("n", F.lit(shingle)) == k)
            own = own.select("*", F.posexplode(shingles(F.col("words"), F.col("n"), k)).alias("offset", "s"))
            placed = texts.select("*", F.posexplode(shingles(F.col("words"), F.col("size"), k)).alias("place", "s"))
            # How often each shingle of a window occurs in all documents.
            wanted = F.broadcast(own.select("s").distinct())
            often = written(spark, placed.select("s").join(wanted, "s").groupBy("s").agg(F.count("*").alias("often")))
            rarest = own.join(often, "s", "left").groupBy("words", "n").agg(
                F.min(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "offset", "s")).alias("r"), F.first("items").alias("items"))
            prefix = written(spark, rarest.where("r.often > 0").select(
                F.col("words").alias("window"), "n", "items", F.col("r.offset").alias("offset"), F.col("r.s").alias("s")))
            met = placed.join(F.broadcast(prefix), "s").withColumn("start", F.col("place") - F.col("offset"))
            met = met.where((F.col("start") >= 0) & (F.col("start") + F.col("n") <= F.col("size")))
            met = met.where(F.slice("words", F.col("start") + 1, F.col("n")) == F.col("window")).select("key", "start", "n", "items")
            found = met if found is None else found.unionAll(met)
    if found is None:
        return texts.where("false").select("key", F.lit(0).alias("start"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("items"))
    return found


def contamination(docs, items, window=WINDOW, share=20, **columns):
    """One row per row of `docs`: id, `n_words`, `n_hit`, `n_items`, `items` (ids as sorted strings), `contaminated`.

    A word is hit if it stands in an occurrence of a window; a document is
    contaminated if at least one in `share` words is hit. Null and wordless texts
    have no words and no hits; an empty benchmark hits nothing. Further columns
    are not returned, and repeated rows each get their row.
    """
    id_col, text_col = columns.get("id_col", "doc_id"), columns.get("text_col", "text")
    found = occurrences(docs, items, window, **columns)
    by_row = found.groupBy("key").agg(F.collect_set(F.struct("start", "n")).alias("spans"), F.collect_set("items").alias("items"))
    covered = F.flatten(F.transform("spans", lambda s: F.sequence(s["start"], s["start"] + s["n"] - 1)))
    hits = by_row.select("key", F.size(F.array_distinct(covered)).cast("long").alias("n_hit"),
                         F.array_sort(F.array_distinct(F.flatten("items"))).alias("items"))
    rows = docs.select(F.col(id_col), row_key(id_col, text_col).alias("key"), F.size(plain_words(F.col(text_col))).cast("long").alias("n_words"))
    hits = hits.select(F.col("key.id").alias("_i"), F.col("key.h").alias("_h"), F.col("key.n").alias("_n"), "n_hit", "items")
    same = F.col("key.id").eqNullSafe(F.col("_i")) & (F.col("key.h") == F.col("_h")) & (F.col("key.n") == F.col("_n"))
    out = rows.join(hits, same, "left").select(
        F.col(id_col), "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("key.h").alias("text_hash"))
    return out.select(id_col, "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items",
                      ((F.col("n_hit") > 0) & (share * F.col("n_hit") >= F.col("n_words"))).alias("contaminated"), "text_hash")


def drop(docs, found, id_col="doc_id", text_col="text"):
    """The rows of `docs` that `found` (from `contamination` of `docs`) does not call contaminated."""
    # The list of what goes is written and looked at before the texts meet it.
    name = lambda id, h: (F.coalesce(id.cast("string"), F.lit("")).alias("_id"), id.isNull().alias("_none"), h.alias("_h"))
    bad = written(docs.sparkSession, found.where("contaminated").select(*name(F.col(id_col), F.col("text_hash"))).distinct())
    own = docs.select(packed(docs), *name(F.col(id_col), F.xxhash64(text_col)))
    return unpacked(join_control(own, bad, ["_id", "_none", "_h"], "left_anti"), docs.columns)
