"""Removes boilerplate lines: those that stand on many sites.

How many sites a line has is first sketched (HyperLogLog, merged by aggregation).
Lines near the threshold, within the sketch's error, get an exact count. A line
over the threshold stays in the document where it is first (the smallest id), so
no content is lost whole, and goes everywhere else.
"""

from pyspark.sql import functions as F

from rowtide.llm.common import packed
from rowtide.session import written

SITES = 10
LG_REGISTERS = 12
# Six standard errors of 1.04 / sqrt(2^12), and room for the estimator's bias.
MARGIN = 0.15


def numbered(df, id_col, text_col, site_col):
    """One row per line that is not blank: row, place, site and two hashes, which together name the line."""
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("row"), F.coalesce(F.col(site_col).cast("string"), F.lit("")).alias("site"),
                     F.posexplode(F.split(text_col, "\n")).alias("place", "line"))
    return rows.where(F.trim("line") != "").select("id", "row", "site", "place", F.xxhash64("line").alias("a"),
                                                   F.xxhash64(F.lit("line"), "line").alias("b"))


def boilerplate(lines, sites=SITES):
    """(a, b, first): the lines on `sites` or more sites, and the smallest id that has each."""
    spark = lines.sparkSession
    spread = lines.groupBy("a", "b").agg(F.hll_sketch_agg("site", LG_REGISTERS).alias("sketch"), F.min("id").alias("first"))
    spread = spread.select("a", "b", "first", F.hll_sketch_estimate("sketch").alias("about"))
    # Few of many lines are left: rebalanced, they make a file or two instead of one per task of the sketches.
    likely = written(spark, spread.where(F.col("about") >= sites * (1 - MARGIN)).hint("rebalance"))
    near = likely.where(F.col("about") <= sites * (1 + MARGIN))
    exact = (lines.join(near.select("a", "b"), ["a", "b"], "left_semi").select("a", "b", "site").distinct()
             .groupBy("a", "b").agg(F.count("*").alias("n")).where(F.col("n") >= sites))
    sure = likely.where(F.col("about") > sites * (1 + MARGIN)).select("a", "b", "first")
    return sure.unionAll(near.join(exact, ["a", "b"]).select("a", "b", "first"))


def remove_boilerplate(df, sites=SITES, id_col="doc_id", text_col="text", site_col="source"):
    """`df` with its texts cleaned, and `n_lines` and `n_removed` (long; columns of these names give way).

    Lines are parted by newlines and compared byte by byte through 128 bits of
    hashes; blank lines are never removed. A line on `sites` or more sites stays in
    rows with the smallest id that has it, and goes elsewhere; a null site is a
    site of its own, and if all its ids are null a line stays. Null texts stay null
    with no lines, empty texts have one (blank) line. Rows and other columns stay.
    """
    lines = numbered(df, id_col, text_col, site_col)
    bad = written(df.sparkSession, boilerplate(lines, sites).hint("rebalance"))
    gone = (lines.join(bad, ["a", "b"]).where(~F.col("id").eqNullSafe(F.col("first")))
            .groupBy(F.col("id").alias("_id"), F.col("row").alias("_line_row")).agg(F.collect_set("place").alias("_gone")))
    own = df.select(packed(df), F.col(id_col).alias("_own"), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("_h"))
    met = own.join(gone, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_line_row")), "left")
    parts = F.split("_text", "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "_gone")
    clean = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n"))
    n_lines = F.when(F.col("_text").isNotNull(), F.size(parts)).otherwise(0).cast("long")
    n_removed = F.when(F.col("_gone").isNotNull(), F.size("_gone")).otherwise(0).cast("long")
    columns = [c for c in df.columns if c.lower() not in ("n_lines", "n_removed")]
    return met.select(*[clean.alias(c) if c == text_col else F.col("_row").getField(c).alias(c) for c in columns],
                      n_lines.alias("n_lines"), n_removed.alias("n_removed"))
