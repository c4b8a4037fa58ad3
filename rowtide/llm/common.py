"""Pieces several operators share."""

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.session import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
HOT = 1000  # rows of a group from which on it is joined apart
# What stands between words made of digits, letters a-z and everything beyond ASCII.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_columns(df, columns):
    """`df` with `columns` (name -> Column); a column of the same name gives way."""
    clash = {c.lower() for c in columns}
    kept = [c for c in df.columns if c.lower() not in clash]
    return df.select(*[F.col(f"`{c}`") for c in kept], *[v.alias(k) for k, v in columns.items()])


def ascii_lower(col):
    """Lower-cases A-Z and nothing else; `lower` does just that on pure ASCII, at a fraction of the cost."""
    return F.when(F.octet_length(col) == F.char_length(col), F.lower(col)).otherwise(
        F.translate(col, UPPER, UPPER.lower()))


def plain_words(col):
    """Array of the lower-cased words of a text; null and wordless texts give an empty array."""
    parts = F.split(F.coalesce(ascii_lower(col), F.lit("")), BETWEEN_WORDS)
    return F.filter(parts, lambda w: w != "")


def remainder(id_col, mod):
    """crc32 of the id as text, modulo `mod`; ids that are null count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % mod


def row_key(id_col="doc_id", text_col="text"):
    """Names a row by its id and text. Rows alike in both get the same results, so they may share a name."""
    return F.struct(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("h"),
                    F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).alias("n"))


def packed(df):
    """All columns of `df` as one, so that their names meet no others; `unpacked` gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")


def unpacked(df, columns):
    return df.select(*[F.col("_row").getField(c).alias(c) for c in columns])


def join_groups(rows, groups, on, size):
    """Inner join of `rows` with `groups`, that has one row per value of `on` and its number of rows in column `size`.

    Both must be cheap to read twice (tables). The rows of groups of over HOT rows
    meet a broadcast list of those groups, or, beyond the size `join_control` allows,
    are spread over many tasks; only the others are dealt by `on`.
    """
    hot = written(rows.sparkSession, groups.where(F.col(size) > HOT))
    small = groups.where(F.col(size) <= HOT)
    cold = join_control(rows, hot.select(*on), on, "left_anti").join(small, on)
    return join_control(rows, hot, on).select(cold.columns).unionAll(cold)
