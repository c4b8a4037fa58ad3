"""Exact duplicates by naming blocks.

Every text is cut into blocks of a fixed number of bytes. Sorted, the different
blocks get integer names; then pairs of neighbouring names are named in turn, until
one name stands for the whole text. Texts are equal if and only if they have the
same length and the same name: names are given to contents, never to hashes.

A block's sort key is its hash. Only where different blocks share a hash do their
bytes join the key, so contents are shuffled once, in the check for that.
"""

from pyspark.sql import functions as F

from rowtide.llm.common import join_groups
from rowtide.session import written

BLOCK = 4096


def blocks(df, id_col, text_col, size, hashed):
    """One row per block: the row's id and own number, its length and digest, the block's place and bytes.

    An empty text has one empty block.
    """
    body = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = df.select(F.col(id_col).alias("_id"), body.alias("body"))
    rows = rows.select("_id", F.monotonically_increasing_id().alias("row"), F.octet_length("body").alias("size"),
                       F.sha2("body", 256).alias("sha"), "body")
    last = F.greatest(F.lit(0), F.floor((F.col("size") - 1) / size)).cast("int")
    cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.substring("body", i * size + 1, F.lit(size)))
    out = rows.select("_id", "row", "size", "sha", F.posexplode(cut).alias("place", "block"))
    return out.withColumn("h", hashed(F.col("block")))


def names(spark, rows, key):
    """The different values of `key` with a name for each: ascending, written so that they stay."""
    different = rows.select(*key).distinct().orderBy(*key)
    return written(spark, different.select(*key, F.monotonically_increasing_id().alias("name")))


def identities(df, id_col="doc_id", text_col="text", size=BLOCK, hashed=F.xxhash64):
    """(_id, row, size, sha, name) per row of `df`; size and name together identify the text.

    `row` numbers the rows of this result. `hashed` only decides which blocks are
    compared byte by byte.
    """
    spark = df.sparkSession
    cut = blocks(df, id_col, text_col, size, hashed)
    contents = cut.groupBy("h", "block").agg(F.count("*").alias("n"))
    clash = written(spark, contents.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h"))
    marked = clash.withColumn("_clash", F.lit(True))
    level = written(spark, cut.join(marked, "h", "left").select(
        "_id", "row", "size", "sha", "place", "h", F.when(F.col("_clash"), F.col("block")).otherwise(F.lit(b"")).alias("own")))
    key, done = ["h", "own"], None
    while True:
        named = level.join(names(spark, level, key), key).select("_id", "row", "size", "sha", "place", "name")
        # Texts of one name are done; the rest go on with pairs. All texts of a length need the same rounds.
        whole = named.where(F.col("size") <= size).select("_id", "row", "size", "sha", "name")
        done = whole if done is None else done.unionAll(whole)
        longer = named.where(F.col("size") > size)
        half = F.col("place").bitwiseAND(F.lit(1)) == 0
        pairs = longer.groupBy("_id", "row", "size", "sha", F.shiftright("place", 1).alias("place")).agg(
            F.max(F.when(half, F.col("name"))).alias("left"), F.coalesce(F.max(F.when(~half, F.col("name"))), F.lit(-1)).alias("right"))
        level = written(spark, pairs)
        if level.isEmpty():
            return done
        key, size = ["left", "right"], 2 * size


def duplicates(df, id_col="doc_id", text_col="text", size=BLOCK, hashed=F.xxhash64):
    """One row per row of `df`: id, `keep_id`, `group_size` (long), `kept`, `text_sha256`.

    Texts are equal if their bytes are; null counts as empty. Of equal texts the
    row with the largest id stays (null only if no id is known); of rows with that
    id in the group, one. Further columns are not returned; an empty table gives
    none.
    """
    spark = df.sparkSession
    found = written(spark, identities(df, id_col, text_col, size, hashed))
    # The row to keep: largest id, of equal ids the first row.
    best = F.max(F.struct(F.col("_id").isNotNull().alias("known"), F.col("_id").alias("id"), (-F.col("row")).alias("row")))
    groups = written(spark, found.groupBy("size", "name").agg(best.alias("k"), F.count("*").alias("group_size")))
    return join_groups(found, groups, ["size", "name"], "group_size").select(
        F.col("_id").alias(id_col), F.col("k.id").alias("keep_id"), "group_size",
        (F.col("row") == -F.col("k.row")).alias("kept"), F.col("sha").alias("text_sha256"))
