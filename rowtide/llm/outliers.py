"""Quality rules, and robust outliers: minimum covariance determinant per language and source.

Each text comes down to five numbers, transformed so that they spread evenly: the
logarithms of its words and of their mean length, and the square roots of the shares
of symbols, repeated lines and repeated words. They are kept in thousandths, so all
sums are exact and do not depend on the order of rows.

For each language and source the estimate is the mean and covariance of the
`SHARE` of texts that make the determinant least. It is sought by concentration
steps from three starts (all texts; medians and quartiles; directions from the
median): a step takes the texts nearest by Mahalanobis distance and estimates anew, and the
determinant does not grow. The start with the least one wins, and texts too far from
its centre are outliers.

Which texts are the nearest is read off a histogram of distances with fine bins: it
is summed on the map side, whatever a group's share of the rows. All of the last
bin are taken. Steps read a written table of narrow rows; the estimates of all groups
are small and joined by a broadcast of checked size.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.session import written

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 5  # words
LEAST_WORDS, MOST_REPEATED = 10, 20  # percent
SHARE = 0.75
STEPS = 6
LEAST_ROWS = 30  # smaller groups reject nothing
# What the covariance of the nearest 75 % of five normal numbers lacks: 0.75 / P(chi2 of 7 <= 75 % point of chi2 of 5).
CONSISTENCY = 1.41
FARTHEST = 35.9  # squared distance, in variances: one in a million of five normal numbers is farther
UNIT = 1000
# Spreads below these (thousandths) say nothing: they are added to every estimate, so none is singular.
FLOORS = [500, 100, 70, 200, 200]
BINS = 100  # to the natural logarithm of a distance
DIMS = range(len(FLOORS))
GROUP = ["lang", "source"]
X = [f"x{i}" for i in DIMS]
PAIRS = [(i, j) for i in DIMS for j in range(i + 1)]


def repeated_words(words, n):
    """Adds `n_repeat_words` to a frame with columns `words` (array) and its size `n`: words in windows that come twice
    or more, told apart by 64-bit hashes. A text is searched by one sort of its windows, and only if two are alike."""
    def step(df, name, value):
        return df.withColumn(name, F.when(F.col("_some"), value))

    hashes = F.transform(F.sequence(F.lit(0), F.col(n) - WINDOW), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))

    def add(df):
        df = df.withColumn("_hashes", F.when(F.col(n) >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>")))
        df = df.withColumn("_some", F.size(F.array_distinct("_hashes")) < F.size("_hashes"))
        df = step(df, "_sorted", F.sort_array(F.transform("_hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        same = lambda x, at: F.coalesce(x["h"] == F.get("_sorted", at)["h"], F.lit(False))
        df = step(df, "_again", F.filter("_sorted", lambda x, k: same(x, k - 1) | same(x, k + 1)))
        df = step(df, "_starts", F.sort_array(F.transform("_again", lambda x: x["i"])))
        new = F.transform("_starts", lambda p, k: F.least(F.lit(WINDOW), F.coalesce(F.get("_starts", k + 1) - p, F.lit(WINDOW))))
        count = F.coalesce(F.aggregate(F.when(F.col("_some"), new), F.lit(0), lambda total, x: total + x), F.lit(0))
        return df.withColumn("n_repeat_words", count.cast("long")).drop("_hashes", "_some", "_sorted", "_again", "_starts")
    return add


def statistics(df, id_col="doc_id", text_col="text", lang_col="lang", source_col="source"):
    """One narrow row per row of `df`: id, lang, source, the counts, `base_failed`, and the numbers x0 to x4.

    Null counts as the empty text, and as the empty language or source.
    """
    text, bare = F.coalesce(F.col(text_col), F.lit("")), lambda c: F.translate(c, SPACE, "")
    df = df.select(F.col(id_col), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(g) for c, g in zip((lang_col, source_col), GROUP)],
                   text.alias("_text"))
    df = df.select(id_col, *GROUP, F.filter(F.split("_text", r"[\x20\x09-\x0D]+"), lambda w: w != "").alias("_words"),
                   F.char_length(bare(F.col("_text"))).cast("long").alias("word_chars"),
                   (F.char_length("_text") - F.char_length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
                   F.filter(F.split("_text", "\n"), lambda line: bare(line) != "").alias("_lines"))
    df = df.withColumns({"_n": F.size("_words"), "n_lines": F.size("_lines"), "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long")})
    df = repeated_words("_words", "_n")(df.drop("_lines")).withColumn("n_words", F.col("_n").cast("long")).drop("_words", "_n")
    n = F.greatest("n_words", F.lit(1))
    numbers = [F.log(n), F.log(F.greatest("word_chars", F.lit(1)) / n), F.sqrt(F.col("n_symbols") / F.greatest("word_chars", "n_symbols", F.lit(1))),
               F.sqrt(F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1))), F.sqrt(F.col("n_repeat_words") / n)]
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return df.select(id_col, *GROUP, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
                     *[F.round(UNIT * v).cast("long").alias(x) for x, v in zip(X, numbers)])


def solved(estimates):
    """Estimates (group, start, n, m: whole centre, e: the centre's rest, c: covariance) with `logdet` and the inverse
    (p) by Cholesky's decomposition; all groups at once, as SQL over columns."""
    last, one = len(FLOORS), lambda i, j: f"c{i}{j}" + "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
    rounds = []  # of columns that need only those before
    for j in DIMS:
        rounds.append({f"l{j}{j}": f"sqrt({one(j, j)} + {FLOORS[j] ** 2})"})
        rounds.append({f"l{i}{j}": f"({one(i, j)}) / l{j}{j}" for i in range(j + 1, last)})
    rounds.append({f"v{j}{j}": f"1 / l{j}{j}" for j in DIMS})
    for gap in range(1, last):
        rounds.append({f"v{j + gap}{j}": "-(" + " + ".join(f"l{j + gap}{k} * v{k}{j}" for k in range(j, j + gap)) + f") / l{j + gap}{j + gap}"
                       for j in range(last - gap)})
    rounds.append({f"p{i}{j}": " + ".join(f"v{k}{i} * v{k}{j}" for k in range(i, last)) for i, j in PAIRS})
    rounds[-1]["logdet"] = "2 * (" + " + ".join(f"ln(l{i}{i})" for i in DIMS) + ")"
    for columns in rounds:
        estimates = estimates.withColumns({name: F.expr(sql) for name, sql in columns.items()})
    return estimates.select(*GROUP, "start", "n", *[f"m{i}" for i in DIMS], *[f"e{i}" for i in DIMS], *[f"p{i}{j}" for i, j in PAIRS], "logdet")


def from_sums(sums):
    """Mean and covariance from counts and sums about the whole centre m."""
    mean = [F.col(f"s{i}") / F.col("n") for i in DIMS]
    moved = [F.round(mean[i]).cast("long") for i in DIMS]
    return sums.select(*GROUP, "start", "n", *[(F.col(f"m{i}") + moved[i]).alias(f"m{i}") for i in DIMS], *[(mean[i] - moved[i]).alias(f"e{i}") for i in DIMS],
                       *[(F.col(f"s{i}{j}") / F.col("n") - mean[i] * mean[j]).alias(f"c{i}{j}") for i, j in PAIRS])


def sums_about_centre(near):
    """Sums of rows joined with their whole centre."""
    away = [F.col(X[i]) - F.col(f"m{i}") for i in DIMS]
    return near.groupBy(*GROUP, "start", *[f"m{i}" for i in DIMS]).agg(
        F.count("*").alias("n"), *[F.sum(away[i]).alias(f"s{i}") for i in DIMS], *[F.sum(away[i] * away[j]).alias(f"s{i}{j}") for i, j in PAIRS])


def at_distance(rows, estimates):
    """Rows joined with the estimates of their group: `distance` squared, and its `bin`."""
    near = join_control(rows, estimates, GROUP)
    away = [F.col(X[i]) - F.col(f"m{i}") - F.col(f"e{i}") for i in DIMS]
    parts = [F.col(f"p{i}{j}") * away[i] * away[j] * (1 if i == j else 2) for i, j in PAIRS]
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return near.withColumn("distance", total).withColumn("bin", F.floor(BINS * F.log(1 + F.greatest("distance", F.lit(0.0)))).cast("int"))


def least_with(counts, keys, value, share):
    """The smallest value up to which `share` of a key's rows lie; `counts` are (keys, value, n), few per key."""
    so_far = Window.partitionBy(*keys).orderBy(value)
    counts = counts.withColumn("_upto", F.sum("n").over(so_far)).withColumn("_all", F.sum("n").over(Window.partitionBy(*keys)))
    return counts.where(F.col("_upto") >= F.ceil(share * F.col("_all"))).groupBy(*keys).agg(F.min(value).alias(value))


def starts(rows):
    """Estimates to start from: medians and quartiles, all rows, and directions from the median."""
    spark = rows.sparkSession
    values = rows.select(*GROUP, F.inline(F.array(*[F.struct(F.lit(i).alias("dim"), F.col(x).alias("x")) for i, x in enumerate(X)])))
    counts = written(spark, values.groupBy(*GROUP, "dim", "x").agg(F.count("*").alias("n")))
    quartiles = [least_with(counts, [*GROUP, "dim"], "x", share).withColumnRenamed("x", f"q{k}") for k, share in enumerate((0.25, 0.5, 0.75))]
    table = quartiles[0].join(quartiles[1], [*GROUP, "dim"]).join(quartiles[2], [*GROUP, "dim"])
    of = lambda i, c: F.max(F.when(F.col("dim") == i, c))
    spread = [of(i, (F.col("q2") - F.col("q0")) / 1.349) for i in DIMS]
    table = table.groupBy(*GROUP).agg(*[of(i, F.col("q1")).alias(f"m{i}") for i in DIMS], *[spread[i].alias(f"w{i}") for i in DIMS])
    table = written(spark, table)
    zero = [F.lit(0.0).alias(f"e{i}") for i in DIMS]
    medians = table.select(*GROUP, F.lit(0).alias("start"), F.lit(0).cast("long").alias("n"), *[f"m{i}" for i in DIMS], *zero,
                           *[(F.col(f"w{i}") ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    near = join_control(rows, table.withColumn("start", F.lit(1)), GROUP)
    unit = [(F.col(X[i]) - F.col(f"m{i}")) / F.sqrt(F.col(f"w{i}") ** 2 + FLOORS[i] ** 2) for i in DIMS]
    length = sum((u * u for u in unit[1:]), unit[0] * unit[0])
    # Parts of unit vectors in millionths, so that these sums are exact too.
    part = [F.when(length > 0, F.round(unit[i] * unit[j] / length * 1_000_000)).otherwise(0).cast("long") for i, j in PAIRS]
    signs = near.groupBy(*GROUP).agg(F.count("*").alias("n"), *[F.sum(part[k]).alias(f"u{i}{j}") for k, (i, j) in enumerate(PAIRS)]).join(table, GROUP)
    wide = [F.sqrt(F.col(f"w{i}") ** 2 + FLOORS[i] ** 2) for i in DIMS]
    signs = signs.select(*GROUP, F.lit(2).alias("start"), "n", *[f"m{i}" for i in DIMS], *zero, *[
        (F.col(f"u{i}{j}") / 1_000_000 / F.col("n") * len(FLOORS) * wide[i] * wide[j]).alias(f"c{i}{j}") for i, j in PAIRS])
    return medians.unionByName(from_sums(sums_about_centre(near))).unionByName(signs)


def estimates(rows, steps=STEPS, share=SHARE):
    """Centre and inverse covariance of each group of rows (lang, source, x0 to x4), `start` being the one that won."""
    spark = rows.sparkSession
    found = written(spark, solved(starts(rows)))
    for _ in range(steps):
        counts = at_distance(rows, found).groupBy(*GROUP, "start", "bin").agg(F.count("*").alias("n"))
        last = least_with(counts, [*GROUP, "start"], "bin", share).withColumnRenamed("bin", "last")
        found = written(spark, found.join(last, [*GROUP, "start"]))
        near = at_distance(rows, found).where(F.col("bin") <= F.col("last"))
        found = written(spark, solved(from_sums(sums_about_centre(near))))
    best = found.groupBy(*GROUP).agg(F.min(F.struct("logdet", "start")).alias("best")).select(*GROUP, "best.start")
    return found.join(best, [*GROUP, "start"])


def verdicts(df, id_col="doc_id", text_col="text", lang_col="lang", source_col="source", steps=STEPS, share=SHARE,
             least_rows=LEAST_ROWS, farthest=FARTHEST):
    """The `statistics` of every row with `distance` (squared, in variances of its language and source) and `kept`.

    Rows that fail the base rules are not kept, take no part in the estimates and have no distance; nor have
    rows of groups smaller than `least_rows`, which are kept. Repeated rows count each. Further columns are not
    returned. An empty table gives none. A text is one row of arrays, however long.
    """
    spark = df.sparkSession
    rows = written(spark, statistics(df, id_col, text_col, lang_col, source_col))
    sound = rows.where(~F.col("base_failed"))
    sizes = written(spark, sound.groupBy(*GROUP).agg(F.count("*").alias("size")))
    sound = join_control(sound.select(*GROUP, *X), sizes.where(F.col("size") >= least_rows).drop("size"), GROUP)
    found = written(spark, estimates(sound, steps, share))
    near = join_control(rows, found, GROUP, "left")
    away = [F.col(X[i]) - F.col(f"m{i}") - F.col(f"e{i}") for i in DIMS]
    total = sum((F.col(f"p{i}{j}") * away[i] * away[j] * (1 if i == j else 2) for i, j in PAIRS[1:]), F.col("p00") * away[0] * away[0])
    near = near.withColumn("distance", F.when(~F.col("base_failed"), total / CONSISTENCY))
    return near.select(*[c for c in rows.columns if c not in X], "distance",
                       (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= farthest)).alias("kept"))
