"""An n-gram language model with Katz backoff, counted and evaluated by blocks of text.

    P(w | h) = d(c(hw)) c(hw) / c(h)        if hw was seen
             = a(h) P(w | h')               if not; h' is h without its first word
    a(h)     = (1 - sum P(w | h)) / (1 - sum P(w | h'))   over the words seen after h

d is the Good-Turing discount up to count K, and a small fixed share beyond, so
that every history leaves something to unseen words. The lowest level discounts
single words; what that leaves is the probability of an unknown word. Each level
sums to one exactly, as a(h) is computed from the sums themselves.

A word seen after h was seen after h' too. So once the counts are known, all but
a(h) can be worked out where the text is:

1. `blocks`: texts become blocks of token numbers with their own vocabulary.
2. `count`: every block sends each of its different n-grams once, with its count,
   to the n-gram's bucket; buckets add up and answer with the totals. Buckets are
   cut by the n-gram's hash, so frequent words weigh no more than others. The
   bucket's rows are the model's count tables, partitioned by level.
3. `evaluate`: every block scores its tokens down to the level where they were
   seen, sends its share of the sums over seen words (each n-gram is summed by one
   block), and lists the histories whose a(h) its texts need.
4. `score`: a(h) is joined to those lists.
"""

import uuid
from collections import defaultdict
from itertools import chain

import numpy as np
import pandas as pd
import xxhash
from pyspark import TaskContext
from pyspark.sql import functions as F

from rowtide.session import shared_folder, written

ORDER = 2
K = 5
RESERVE = 0.001  # share of counts beyond K that is kept for unseen words
BLOCK_BYTES = 4 * 2**20  # of text; a longer text is a block of its own
BUCKET_GRAMS = 500_000
MOST_BUCKETS = 100_000  # of the table of texts, as Spark has it; more texts share a bucket then
START, END = np.uint64(1), np.uint64(2)  # hashes of what stands before and after a text


def tokenize(text):
    """Words, lower-cased A-Z only: bytes know no other letters and no other white space."""
    return (text or "").encode("utf-8", "replace").lower().split()


def planes(a):
    """Bytes of a number array, the first bytes of all numbers first: they repeat and pack well."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes()


def unplanes(data, dtype):
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(dtype).reshape(-1)


def packed_keys(keys):
    """Ascending hashes by their gaps, whose high bytes are zero."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data):
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


BLOCK = "block long, ids array<string>, held array<boolean>, sizes array<int>, vocabulary binary, tokens binary, n long"


def blocks(df, id_col, text_col, held):
    """Rows of BLOCK: some texts each, as numbers into the block's vocabulary (hashes); number 0 ends each text."""

    def pack(seq, rows):
        numbers = defaultdict()
        numbers.default_factory = numbers.__len__
        numbers[None]  # the end
        tokens = [np.fromiter(chain(map(numbers.__getitem__, tokenize(t)), (0,)), np.int32) for _, t, _ in rows]
        words = np.fromiter((xxhash.xxh64_intdigest(w, 42) if w is not None else END for w in numbers), np.uint64, len(numbers))
        return {"block": (TaskContext.get().partitionId() << 32) + seq, "ids": [i for i, _, _ in rows], "held": [h for _, _, h in rows],
                "sizes": [len(t) for t in tokens], "vocabulary": planes(words), "tokens": planes(np.concatenate(tokens)),
                "n": sum(map(len, tokens))}

    def run(batches):
        rows, size, seq = [], 0, 0
        for batch in batches:
            for i, t, h in zip(batch["id"], batch["text"], batch["held"]):
                rows.append((i, t, bool(h)))
                size += len(t) if t else 0
                if size >= BLOCK_BYTES:
                    yield pd.DataFrame([pack(seq, rows)])
                    rows, size, seq = [], 0, seq + 1
        if rows:
            yield pd.DataFrame([pack(seq, rows)])

    # As text, ids stay as they are; numbers beside nulls would be rounded.
    return df.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text"), held.alias("held")).mapInPandas(run, BLOCK)


def mix(a, b, level):
    """Hash of an n-gram from that of its history and of its last word."""
    x = (a * np.uint64(0x9E3779B97F4A7C15) + b + np.uint64(level)) * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Grams:
    """The n-grams of a block's tokens, by level (1 to order)."""

    def __init__(self, row, order):
        self.ids, self.held, self.sizes = row["ids"], np.array(row["held"], bool), np.array(row["sizes"], np.int64)
        word = unplanes(row["vocabulary"], np.uint64)[unplanes(row["tokens"], np.int32)]
        self.text = np.repeat(np.arange(len(self.sizes), dtype=np.int32), self.sizes)
        place = np.arange(len(word)) - np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        self.train = ~self.held[self.text]
        # Level m needs m - 1 symbols before the token; the start of the text is one.
        self.at = {1: np.arange(len(word), dtype=np.int32)}
        self.key, self.history = {1: word}, {}
        for m in range(2, order + 1):
            before = np.concatenate([[START], self.key[m - 1][:-1]])
            if m == 2:
                before[place == 0] = START
            self.history[m] = before
            self.key[m] = mix(before, word, m)
            self.at[m] = np.flatnonzero(place >= m - 2).astype(np.int32)
        self.first = place == 0

    def different(self, m):
        """(hashes ascending, first token of each, number of each token that has the level)."""
        return np.unique(self.key[m][self.at[m]], return_index=True, return_inverse=True)


def bucket_of(keys, buckets):
    return ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)


COUNTED = "level int, bucket int, block long, keys binary, counts binary, grams long, tokens long, of_count array<long>"


def count(spark, texts, order, buckets):
    """Folder of the count tables (rows of COUNTED by level).

    Rows without a block hold a bucket's n-grams and their counts in training
    texts; the others are a block's answers: count, whether held-out texts have the
    n-gram, and whether it is this block that sums it, in the order of its keys.
    """

    def send(batches):
        for batch in batches:
            for row in batch.to_dict("records"):
                g = Grams(row, order)
                for m in range(1, order + 1):
                    keys, _, number = g.different(m)
                    train = g.train[g.at[m]]
                    value = np.bincount(number[train], minlength=len(keys)) * 2
                    value[number[~train]] |= 1
                    bucket = bucket_of(keys, buckets)
                    cuts = np.flatnonzero(np.diff(bucket, prepend=-1))
                    yield pd.DataFrame([{"level": m, "bucket": int(bucket[a]), "block": row["block"], "keys": packed_keys(keys[a:b]),
                                         "counts": planes(value[a:b])} for a, b in zip(cuts, [*cuts[1:], len(keys)])])

    def add(sent):
        keys = [unpacked_keys(k) for k in sent["keys"]]
        value = np.concatenate([unplanes(c, np.int64) for c in sent["counts"]])
        sizes = [len(k) for k in keys]
        different, number = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(number, value >> 1, len(different)).astype(np.int64)
        held = np.zeros(len(different), np.int64)
        held[number[value & 1 == 1]] = 1
        trained = np.flatnonzero(value > 1)
        sums = np.zeros(len(value), np.int64)
        sums[trained[np.unique(number[trained], return_index=True)[1]]] = 1
        answer = total[number] * 4 + held[number] * 2 + sums
        level, bucket = int(sent["level"].iloc[0]), int(sent["bucket"].iloc[0])
        seen = total > 0
        rows = [{"level": level, "bucket": bucket, "block": None, "keys": packed_keys(different[seen]), "counts": planes(total[seen]),
                 "grams": int(seen.sum()), "tokens": int(total.sum()), "of_count": np.bincount(np.minimum(total[seen], K + 2), minlength=K + 3)[1:K + 2].tolist()}]
        start = 0
        for block, n in zip(sent["block"], sizes):
            rows.append({"level": level, "bucket": bucket, "block": block, "counts": planes(answer[start:start + n]), "of_count": []})
            start += n
        out = pd.DataFrame(rows, columns=["level", "bucket", "block", "keys", "counts", "grams", "tokens", "of_count"])
        return out.astype({"block": "Int64", "grams": "Int64", "tokens": "Int64"})

    folder = shared_folder(spark)
    packets = texts.mapInPandas(send, "level int, bucket int, block long, keys binary, counts binary")
    packets.groupBy("level", "bucket").applyInPandas(add, COUNTED).write.partitionBy("level").option("compression", "zstd").parquet(folder)
    return folder


def discounts(of_count, k=K):
    """Good-Turing discounts of the counts 1 to K, from how many n-grams have each count up to K + 1.

    The largest k for which all are between 0 and 1 is taken; without any (little
    text), half a count is taken off each.
    """
    for top in range(k, 0, -1):
        n = of_count[:top + 1]
        if min(n) <= 0:
            continue
        rest = (top + 1) * n[top] / n[0]
        d = [((r + 1) * n[r] / (r * n[r - 1]) - rest) / (1 - rest) for r in range(1, top + 1)] if rest < 1 else [0]
        if all(0 < x < 1 for x in d):
            return np.array(d + [1 - RESERVE] * (k - top))
    return np.array([(r - 0.5) / r for r in range(1, k + 1)])


def kept_share(d, c):
    """The share of a count that its n-gram keeps."""
    return np.where(c <= K, np.concatenate([[0.0], d])[np.minimum(c, K)], 1 - RESERVE)


EVALUATED = ("kind int, block long, place int, id string, held boolean, n_tokens long, n_known long, base double, part double, "
             "level int, history long, seen double, lower double, times long")

KINDS = {name: {"int": "Int64", "long": "Int64", "double": "float64", "boolean": "boolean", "string": "object"}[kind]
         for name, kind in (x.split() for x in EVALUATED.split(", "))}


def evaluate(texts, answers, order, model):
    """Rows of EVALUATED: kind 0 texts, 1 sums over the words seen after a history, 2 histories a text backs off from."""

    def run(_, own, answered):
        row = own.to_dict("records")[0]
        g = Grams(row, order)
        n = len(g.text)
        block = row["block"]
        answered = answered.sort_values(["level", "bucket"])
        c, p, wanted = {}, {}, {}
        part = np.full(n, np.log10(model["unknown"]))
        out = []
        for m in range(1, order + 1):
            keys, first, number = g.different(m)
            got = np.concatenate([unplanes(x, np.int64) for x in answered["counts"][answered["level"] == m]])
            at = g.at[m]
            c[m], p[m], wanted[m] = np.zeros(n, np.int64), np.zeros(n), np.zeros(n, bool)
            c[m][at], wanted[m][at] = (got >> 2)[number], (got >> 1 & 1)[number] == 1
            before = np.full(n, model["tokens"])
            if m > 1:
                before = np.concatenate([[0], c[m - 1][:-1]])
                if m == 2:
                    before[g.first] = model["texts"]
            found = c[m] > 0
            p[m][found] = kept_share(model["discounts"][m - 1], c[m][found]) * c[m][found] / before[found]
            part[found] = np.log10(p[m][found])
            if m == 1:
                continue
            # The sums that a(h) is made of, for histories that held-out texts have.
            asked = np.concatenate([[False], wanted[m - 1][:-1]])
            if m == 2:
                asked[g.first] = True
            mine = at[first[(got & 1) == 1]]
            mine = mine[asked[mine]]
            histories, number = np.unique(g.history[m][mine], return_inverse=True)
            out.append(pd.DataFrame({"kind": 1, "level": m, "history": histories.view(np.int64),
                                     "seen": np.bincount(number, p[m][mine], len(histories)),
                                     "lower": np.bincount(number, p[m - 1][mine], len(histories))}))
            back = at[(c[m][at] == 0) & (before[at] > 0)]
            lists = pd.DataFrame({"place": g.text[back], "history": g.history[m][back].view(np.int64)})
            lists = lists.groupby(["place", "history"], sort=False).size().reset_index(name="times")
            out.append(lists.assign(kind=2, block=block, level=m))
        base = np.log10((c[1] + 1.0) / (model["tokens"] + 1.0 * (model["words"] + 1)))
        texts_in = len(g.sizes)
        of = lambda weights: np.bincount(g.text, weights, texts_in)
        out.append(pd.DataFrame({"kind": 0, "block": block, "place": np.arange(texts_in), "id": pd.array(g.ids, "object"), "held": g.held,
                                 "n_tokens": g.sizes, "n_known": of(c[1] > 0).astype(np.int64), "base": of(base), "part": of(part)}))
        return pd.concat([x.reindex(columns=list(KINDS)).astype(KINDS) for x in out], ignore_index=True)

    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, EVALUATED)


def fit_and_score(df, held, order=ORDER, id_col="doc_id", text_col="text"):
    """One row per row of `df`: id, `held_out`, `n_tokens`, `n_known`, `train_tokens`, `base_score`, `score`.

    Learns from the rows where the Column `held` is not true. Tokens are the words
    and one end per text; null counts as the empty text. `score` is the log10
    probability of the text, `base_score` that of add-one word counts. Without
    training texts every token is unknown, with probability 1. Further columns are
    not returned; repeated rows each count and get their row.
    """
    spark = df.sparkSession
    # Bucketed by block: the answers come to the texts, which are not shuffled.
    size = df.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BLOCK_BYTES + 1)
    name = f"katz_texts_{uuid.uuid4().hex}"
    (blocks(df, id_col, text_col, F.coalesce(held, F.lit(False))).write.format("parquet").option("compression", "zstd")
     .bucketBy(min(buckets, MOST_BUCKETS), "block").saveAsTable(name))
    texts = spark.table(name)
    tokens = texts.agg(F.sum("n")).first()[0] or 0
    trained = texts.agg(F.sum(F.size(F.filter("held", lambda h: ~h)))).first()[0] or 0
    counted = spark.read.schema(COUNTED).parquet(count(spark, texts, order, tokens // BUCKET_GRAMS + 1))
    sums = [F.sum(F.get("of_count", F.lit(i))).alias(f"n{i}") for i in range(K + 1)]
    stats = {r["level"]: r for r in counted.where("block IS NULL").groupBy("level").agg(
        F.sum("grams").alias("grams"), F.sum("tokens").alias("tokens"), *sums).collect()}
    of_count = {m: [int(stats[m][f"n{i}"] or 0) for i in range(K + 1)] if m in stats else [0] * (K + 1) for m in range(1, order + 1)}
    words, n = (int(stats[1]["grams"]), int(stats[1]["tokens"])) if 1 in stats else (0, 0)
    d = [discounts(of_count[m]) for m in range(1, order + 1)]
    low = np.arange(1, K + 1) * np.array(of_count[1][:K])
    left = float(((1 - d[0]) * low).sum() + RESERVE * (n - low.sum()))
    model = {"tokens": n, "words": words, "texts": int(trained), "discounts": d, "unknown": left / n if n else 1.0}
    answers = counted.where("block IS NOT NULL").select("block", "level", "bucket", "counts")
    rows = written(spark, evaluate(texts, answers, order, model))
    spark.sql(f"DROP TABLE {name}")
    rest = rows.where("kind = 1").groupBy("level", "history").agg(F.sum("seen").alias("seen"), F.sum("lower").alias("lower"))
    rest = rest.select("level", "history", F.log10((1 - F.col("seen")) / (1 - F.col("lower"))).alias("a"))
    off = rows.where("kind = 2").select("block", "place", "level", "history", "times").join(rest, ["level", "history"])
    off = off.groupBy("block", "place").agg(F.sum(F.col("times") * F.col("a")).alias("off"))
    return rows.where("kind = 0").join(off, ["block", "place"], "left").select(
        F.col("id").cast(df.schema[id_col].dataType).alias(id_col), F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"),
        F.col("base").alias("base_score"), (F.col("part") + F.coalesce("off", F.lit(0.0))).alias("score"))
