"""Ordered scans that stay parallel when one key holds most of the rows.

A plain window sends all rows of a key to one task. Here the key's order is cut
into blocks (any prefix of the order, bounded in size); rows are scanned inside
their block, one summary line per (key, block) is scanned across blocks, and
the carry is joined back. Only summaries of a key ever meet in one task.
"""

from pyspark.sql import Window, functions as F


def _carry(df, keys, block, summary, over):
    """Per (key, block): `over` applied to the summaries of earlier blocks."""
    lines = df.groupBy(*keys, *block).agg(summary.alias("_sum"))
    before = (Window.partitionBy(*keys).orderBy(*block)
              .rowsBetween(Window.unboundedPreceding, -1))
    return lines.select(*keys, *block, over(F.col("_sum")).over(before).alias("_carry"))


def row_number(df, keys, block, order, name):
    """1-based row number per key."""
    carry = _carry(df, keys, block, F.count(F.lit(1)), F.sum)
    inside = Window.partitionBy(*keys, *block).orderBy(*order)
    return (df.join(carry, keys + block)
            .withColumn(name, F.row_number().over(inside).cast("bigint")
                        + F.coalesce("_carry", F.lit(0)))
            .drop("_carry"))


def running_max(df, keys, block, order, value, name):
    """Running maximum of an orderable expression per key, current row included."""
    df = df.withColumn("_val", value)
    carry = _carry(df, keys, block, F.max("_val"), F.max)
    inside = (Window.partitionBy(*keys, *block).orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, 0))
    return (df.join(carry, keys + block)
            .withColumn(name, F.greatest(F.max("_val").over(inside), "_carry"))
            .drop("_carry", "_val"))


def previous(df, keys, block, order, value, name):
    """The value (a non-null struct) of the preceding row of the key."""
    df = df.withColumn("_val", value)
    newest = F.max_by("_val", F.struct(*order))
    carry = _carry(df, keys, block, newest, lambda c: F.last(c))
    inside = Window.partitionBy(*keys, *block).orderBy(*order)
    return (df.join(carry, keys + block)
            .withColumn(name, F.coalesce(F.lag("_val").over(inside), "_carry"))
            .drop("_carry", "_val"))
