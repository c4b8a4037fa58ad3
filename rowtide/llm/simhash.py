"""Near-duplicates by 64-bit fingerprints, searched by multi-index hashing.

A fingerprint has a bit set if over half of the text's shingle hashes have it. It
is cut into segments; two fingerprints that differ in at most r bits differ in few
bits of some segment (with two segments and r = 3, in at most one bit of one). So
every fingerprint asks, for each segment, for all values in a small Hamming ball
around its own, and the table of segment values answers. What meets under one
value is verified by the whole distance.

Only different fingerprints take part. What meets under a value is searched
breadth first: a fingerprint once reached is not compared again, so a dense group
gives as many links as it has members, not pairs. If too many meet under a value
for one task, they are searched in chunks, each with itself and each other one.
"""

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import functions as F

from rowtide.llm.common import join_groups, packed, unpacked, with_columns
from rowtide.llm.graph import components
from rowtide.session import written

BITS = 64
SEED = 42
SEGMENTS = 2
MEETING = 16_384  # fingerprints searched together in one array


def fingerprint(text, shingle=3):
    """The fingerprint of a text as an unsigned integer."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) < shingle:
        hashes = [digest(b" ".join(words), SEED)]
    else:
        hashes = [digest(b" ".join(s), SEED) for s in zip(*(words[k:] for k in range(shingle)))]
    ones = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 65_536):
        part = np.array(hashes[start:start + 65_536], np.uint64)
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df, text_col="text", shingle=3, name="fp"):
    """Adds the fingerprint as a (signed) long; a column of that name gives way."""

    @F.pandas_udf("long")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64))

    return with_columns(df, {name: run(F.col(text_col))})


def reach(max_bits, segments=SEGMENTS):
    """(shift, width, radius) of each segment to search so that no pair within `max_bits` is missed."""
    out, shift = [], 0
    for k in range(segments):
        width = BITS // segments + (k < BITS % segments)
        radius = max_bits // segments - (k > max_bits % segments)
        if radius >= 0:
            out.append((shift, width, radius))
        shift += width
    return out


def meetings(prints, max_bits):
    """(path, fp): who meets under which segment value."""
    parts = []
    for k, (shift, width, radius) in enumerate(reach(max_bits)):
        ones = (1 << width) - 1
        own = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(ones))
        flips = [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(width), n)]
        asked = prints.select("fp", own.alias("own"), F.explode(F.array([F.lit(m) for m in flips])).alias("flip"))
        # Of two values a flip apart, only the one without its lowest bit asks.
        lowest = F.col("flip").bitwiseAND(-F.col("flip"))
        asked = asked.where(F.col("own").bitwiseAND(lowest) == 0)
        parts.append((k, asked.select("fp", F.col("own").bitwiseXOR(F.col("flip")).alias("value")),
                      prints.select(own.alias("value")).distinct()))
    out = None
    for k, asked, there in parts:
        met = asked.join(there, "value", "left_semi").select(
            F.concat_ws(":", F.lit(k), "value").alias("path"), "fp")
        out = met if out is None else out.unionAll(met)
    return out


def cells(crowd, chunks):
    """Those that met in too large numbers, once for each pair of chunks of their meeting that they belong to.

    Any two of a meeting share a cell, and a cell holds two chunks at most.
    """
    own = F.pmod(F.xxhash64("fp"), F.col("chunks"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    rows = crowd.join(chunks, "path").select("path", "fp", own.alias("x"), other.alias("y"))
    return rows.select(F.concat_ws(":", "path", F.least("x", "y"), F.greatest("x", "y")).alias("path"), "fp")


def forest(prints, max_bits):
    """Links (pairs of fingerprints within reach) that connect all that are connected within `prints`."""
    left, links = np.unique(prints), []
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                left = left[~near]
                links.append((np.full(len(found), x), found))
                queue += list(found)
    return links


def linked(spark, prints, max_bits=3, meeting=MEETING):
    """Links (a, b) between the fingerprints `prints` (column fp, each once) that connect all within `max_bits` bits."""

    @F.pandas_udf("array<struct<a:long,b:long>>")
    def search(groups: pd.Series) -> pd.Series:
        out = []
        for group in groups:
            links = forest(np.asarray(group, np.int64).view(np.uint64), max_bits)
            out.append([{"a": a, "b": b} for x, y in links for a, b in zip(x.view(np.int64).tolist(), y.view(np.int64).tolist())])
        return pd.Series(out)

    met = written(spark, meetings(prints, max_bits))
    crowded = met.groupBy("path").agg(F.count("*").alias("n")).where(F.col("n") > meeting)
    crowded = written(spark, crowded.select("path", F.ceil(F.col("n") / meeting).alias("chunks")))
    together = met.join(crowded, "path", "left_anti").unionAll(cells(met, crowded))
    return (together.groupBy("path").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
            .select(F.explode(search("fps")).alias("l")).select("l.a", "l.b").distinct())


def near_duplicates(df, id_col="doc_id", text_col="text", shingle=3, max_bits=3, meeting=MEETING):
    """One row per row of `df`: id, `h` (hash of the text), `fp`, `root`, `component_id`.

    Texts are linked if their fingerprints differ in `max_bits` bits at most;
    `component_id` is the smallest id reachable over links, itself included (null
    if no id of the component is known), and `root` the smallest fingerprint there.
    Null and empty texts have fingerprint 0 and are linked like any other. Repeated
    rows are all returned; further columns are not. Shingles are runs of `shingle`
    words of the text with A-Z lowered; a shorter text is one shingle.
    """
    spark = df.sparkSession
    rows = fingerprints(df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")), "_text", shingle)
    rows = written(spark, rows.select("_id", F.xxhash64("_text").alias("h"), "fp"))
    prints = written(spark, rows.groupBy("fp").agg(F.min("_id").alias("first"), F.count("*").alias("n")))
    roots = written(spark, components(spark, linked(spark, prints.select("fp"), max_bits, meeting)))
    named = prints.join(roots.withColumnRenamed("node", "fp"), "fp")
    smallest = named.groupBy("root").agg(F.min("first").alias("component"))
    named = named.select("fp", "root").join(smallest, "root").select("fp", F.col("root").alias("_root"), "component")
    names = prints.join(named, "fp", "left").select(
        "fp", "n", F.coalesce("_root", "fp").alias("root"), F.when(F.col("_root").isNull(), F.col("first")).otherwise(
            F.col("component")).alias("component_id"))
    return join_groups(rows, written(spark, names), ["fp"], "n").select(F.col("_id").alias(id_col), "h", "fp", "root", "component_id")


def keep_one(df, groups, id_col="doc_id", text_col="text"):
    """Of each component of `groups` (from `near_duplicates` of `df`) one row of `df`: that with the smallest id.

    A null id counts as the largest. Rows with the same id go by the hash of their
    text; of rows alike in both any one stays.
    """
    rows = groups.groupBy("root", id_col, "h").agg(F.count("*").alias("_n"))
    kept = rows.groupBy("root").agg(F.min(F.struct(F.col(id_col).isNull().alias("z"), F.col(id_col).alias("id"), "h", "_n")).alias("k"))
    kept = written(df.sparkSession, kept.select(F.col("k.id").alias("_id"), F.col("k.h").alias("_h"), F.col("k._n").alias("_n")))
    own = df.select(packed(df), F.col(id_col).alias("_own"), F.xxhash64(text_col).alias("_th"))
    met = own.join(kept, F.col("_own").eqNullSafe(F.col("_id")) & (F.col("_th") == F.col("_h")))
    single = met.where("_n = 1")
    repeated = met.where("_n > 1").dropDuplicates(["_id", "_h"])
    return unpacked(single.unionAll(repeated), df.columns)
