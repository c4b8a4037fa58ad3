"""Groups spelling variants: words one edit apart, found along a sorted vocabulary.

A word is compared with a sorted list by the rows of an edit matrix, three cells wide
as one edit allows no more. The row of a prefix is the same for all words that share
it: going on to the next word, the rows up to the common prefix of the two neighbours
are there already, and where a row has no cell below two, the whole range of words
with that prefix is skipped.

The vocabulary is spread by what a pair must share. Of two words one edit apart, the
shorter of length l, let p be the first place where they differ. If p lies in a zone
[a, b), both start with the same a letters and end with the same l - b ones. Words
meet in the lists of (l, zone, these letters), with two zones at first, each half a
word; every pair has one l and one zone. A list of more than MOST_WORDS words is not
searched but handed on, cut into zones half as wide, until they are one letter wide
and a list holds no more than the letters there are.
"""

import math
from bisect import bisect_left
from itertools import chain, groupby, islice

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.llm.common import ascii_lower
from rowtide.session import written

BETWEEN_RUNS = r"[^A-Za-zÀ-ÿ]+"
LEAST_LETTERS, LEAST_TIMES = 7, 2
TIMES_MORE = 10  # how much more frequent a form is than its variant
DAMAGED = 31  # one run in so many loses a letter
MOST_WORDS = 50_000  # of a list that one task holds; longer ones are cut, none is left out
FAR = "\U0010ffff"


def vocabulary(df, id_col="doc_id", text_col="text", least_letters=LEAST_LETTERS, least_times=LEAST_TIMES, damaged=DAMAGED):
    """(word, n): runs of letters, A-Z lower-cased, with how often they occur in all texts.

    A run loses a letter if `damaged` divides the checksum of its document's id and itself (0: none does).
    Null texts have no words; a null id counts as the empty text in the checksum; repeated rows count each.
    """
    runs = F.filter(F.split(ascii_lower(F.col(text_col)), BETWEEN_RUNS), lambda r: F.char_length(r) >= least_letters)
    words = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("word"))
    if damaged:
        words = words.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "word").cast("binary")))
        at = (F.col("h") % F.char_length("word")).cast("int")
        cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.char_length("word")))
        words = words.select(F.when(F.col("h") % damaged == 0, cut).otherwise(F.col("word")).alias("word"))
        words = words.where(F.char_length("word") >= least_letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_times)


def _in_zones(words, *zones):
    """Each word once per zone (l, a, b)."""
    zones = F.array(*[F.struct(*[F.lit(x).cast("int").alias(name) if isinstance(x, int) else x.cast("int").alias(name)
                                 for name, x in zip("lab", zone)]) for zone in zones])
    return words.select("word", "n", F.inline(zones))


def halves(words, least_letters):
    """Every word as the shorter and as the longer of a pair, in the first and in the last half."""
    size, l = F.char_length("word"), F.col("l")
    words = words.select("word", "n", F.explode(F.filter(F.array(size, size - 1), lambda s: s >= least_letters)).alias("l"))
    return _in_zones(words, (l, 0, F.floor(l / 2)), (l, F.floor(l / 2), l + 1))


def narrower(words):
    """Zones cut in two."""
    l, a, b = F.col("_l"), F.col("_a"), F.col("_b")
    middle = F.floor((a + b) / 2)
    words = words.select("word", "n", *[F.col(c).alias(f"_{c}") for c in "lab"])
    return _in_zones(words, (l, a, middle), (l, middle, b))


def common(x, y):
    """Length of the common prefix."""
    for i, (c, d) in enumerate(zip(x, y)):
        if c != d:
            return i
    return min(len(x), len(y))


def near_pairs(words, l, a, b):
    """Places (i, j), i < j, of words of a sorted list that are one edit apart, the shorter of length `l`, and
    first differ in the zone [a, b). All are of length l or l + 1 and share their first `a` letters."""
    lcp = [0, *map(common, words, islice(words, 1, None))]
    for i, q in enumerate(words):
        size = len(q)
        letters = q + "\0\0"
        # Row d: from the first d letters of a word to the first d - 1, d and d + 1 of q.
        rows = [(1, 0, 1)] * (size + 2)
        known = shared = size  # rows that hold for the word before; letters it shares with q
        j = i + 1
        while j < len(words):
            w = words[j]
            known, shared = min(known, lcp[j]), min(shared, lcp[j])
            x, y, z = rows[known]
            d, end = known, len(w)
            while d < end:
                c = w[d]
                x = min(y + 1, x + (d < 1 or c != letters[d - 1]))
                y = min(z + 1, x + 1, y + (c != letters[d]))
                z = min(y + 1, z + (c != letters[d + 1]))
                d += 1
                rows[d] = x, y, z
                if x > 1 and y > 1 and z > 1:
                    break
            if x > 1 and y > 1 and z > 1:
                known = d - 1
                j = bisect_left(words, w[:d] + FAR, j + 1)
                continue
            known = end
            if min(size, end) == l and a <= shared < b and (x, y, z)[1 + size - end] == 1:
                yield i, j
            j += 1


FOUND = "word string, n long, near string, near_n long, l int, a int, b int"


def searched(words, most_words=MOST_WORDS):
    """Rows of FOUND for words in zones: pairs, and the words of lists that are too long (`near` is null)."""
    schema = to_arrow_schema(T.StructType.fromDDL(FOUND))

    def search(rows):
        for (l, a, b, _, _), group in groupby(rows, key=lambda r: (*r[:4], r[4][:r[1]])):
            held = list(islice(group, most_words)) if b - a > 1 else list(group)
            more = list(islice(group, 1))
            if more:
                yield from ((word, n, None, None, l, a, b) for *_, word, n in chain(held, more, group))
            elif len(held) > 1:
                for i, j in near_pairs([r[4] for r in held], l, a, b):
                    yield *held[i][4:], *held[j][4:], None, None, None

    def run(batches):
        found = search(r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns]))
        while some := list(islice(found, 10_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    ends = F.right("word", F.greatest(F.col("l") - F.col("b"), F.lit(0)))
    words = words.withColumns({"head": F.left("word", F.col("a")), "tail": ends}).repartition("l", "a", "b", "head", "tail")
    return words.sortWithinPartitions("l", "a", "b", "tail", "word").select("l", "a", "b", "tail", "word", "n").mapInArrow(run, FOUND)


def near_words(words, least_letters=LEAST_LETTERS, most_words=MOST_WORDS):
    """(word, n, near, near_n): both directions of every pair of words of a vocabulary (word, n) one edit apart."""
    spark = words.sparkSession
    found, left = [], halves(words, least_letters)
    while not found or not left.isEmpty():
        out = written(spark, searched(left if not found else narrower(left), most_words))
        found.append(out.where("near IS NOT NULL").select("word", "n", "near", "near_n"))
        left = out.where("near IS NULL")
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    return pairs.unionByName(pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")))


def roots(forms, most):
    """(word, root) of words with a form: the end of the chain of forms.

    Counts grow tenfold with each form, so chains are as short as the digits of the largest count, `most`; each
    round follows twice as many forms at once.
    """
    found = forms.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(len(str(most)), 2)))):
        further = found.select(F.col("word").alias("root"), F.col("root").alias("next"))
        found = written(forms.sparkSession, found.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return found


def variants(df, id_col="doc_id", text_col="text", least_letters=LEAST_LETTERS, least_times=LEAST_TIMES, times_more=TIMES_MORE,
             damaged=DAMAGED, most_words=MOST_WORDS):
    """(word, form, root, n, n_near, form_n), one row per word of the `vocabulary`.

    A word's form is the most frequent word one edit away (of equal ones the first in code-point order) if it
    is `times_more` times as frequent, else null; `root` is where its forms lead, itself if there is none.
    `least_letters` is 2 at least. Further columns are not returned. An empty table gives no words.
    """
    spark = df.sparkSession
    words = written(spark, vocabulary(df, id_col, text_col, least_letters, least_times, damaged))
    best = near_words(words, least_letters, most_words).groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    most = -F.col("best.less")
    joined = words.join(best, "word", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(
        most >= times_more * F.col("n"), F.struct(F.col("best.near").alias("form"), most.alias("form_n"))).alias("f"))
    joined = written(spark, joined.select("word", "n", "n_near", "f.form", "f.form_n"))
    ends = roots(joined.where("form IS NOT NULL"), joined.agg(F.max("n")).first()[0] or 0)
    return joined.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
