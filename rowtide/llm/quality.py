"""A supervised text classifier on subword vectors.

A document is the average of learned vectors: one for each word and each of its
character n-grams (with `<` and `>` at the ends), found by hash. A word that equals
the one before it adds one more, so that stuttering text can be told from text with
the same words in another order. A softmax layer makes class probabilities of the
average. Vectors and layer are trained together by stochastic gradient descent.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rowtide.llm.common import remainder, with_columns

GRAMS = (2, 3, 4)
AGAIN = 0  # the bucket of "equals the word before"
STEPS = 48_000
GROUP_WORDS = 100_000  # words taken apart at a time: a bound on memory
ROOM = 10_000_000  # buckets an array of bags has room for: over 32 MB, which malloc maps on its own and returns


@dataclass
class Model:
    """What is left of a trained network for scoring: class scores of each bucket, and of none."""

    classes: list
    scores: np.ndarray  # buckets x classes
    bias: np.ndarray

    def probabilities(self, texts):
        """One row of class probabilities per text; a text without words has those of the bias."""
        logits = np.tile(self.bias.astype(np.float64), (len(texts), 1))
        for start, stop, words in groups(texts):
            vocabulary = {w: i for i, w in enumerate(set(chain.from_iterable(words)))}
            sums, counts = word_scores(list(vocabulary), self.scores)
            for i in range(start, stop):
                own = np.fromiter(map(vocabulary.__getitem__, words[i - start]), np.int64, len(words[i - start]))
                if len(own):
                    again = int((own[1:] == own[:-1]).sum())
                    total = sums[own].sum(0) + again * self.scores[AGAIN]
                    logits[i] += total / (counts[own].sum() + again)
        logits -= logits.max(1, keepdims=True)
        odds = np.exp(logits)
        return odds / odds.sum(1, keepdims=True)


def groups(texts):
    """(first, last + 1, word lists) of runs of texts with about GROUP_WORDS words."""
    start, held, n = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t.split() if t else [])
        n += len(held[-1])
        if n >= GROUP_WORDS:
            yield start, i + 1, held
            start, held, n = i + 1, [], 0
    if held:
        yield start, len(texts), held


def buckets_of(words, size):
    """Yields (bucket, word index) arrays: of the words, then of their n-grams by length."""
    yield np.fromiter((zlib.crc32(w.encode("utf-8", "replace")) for w in words), np.int64, len(words)) % (size - 1) + 1, \
        np.arange(len(words))
    letters = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "replace"), np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    word = np.repeat(np.arange(len(words)), lengths)
    for n in GRAMS:
        if len(letters) < n:
            break
        starts = np.flatnonzero(word[: len(word) - n + 1] == word[n - 1:])
        key = np.full(len(starts), n, np.uint64)
        for k in range(n):
            key = (key ^ letters[starts + k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        yield (key % np.uint64(size - 1)).astype(np.int64) + 1, word[starts]


def word_scores(words, scores):
    """Per word: the class scores of its buckets summed, and how many they are."""
    sums, counts = np.zeros((len(words), scores.shape[1])), np.zeros(len(words))
    for bucket, word in buckets_of(words, len(scores)):
        counts += np.bincount(word, minlength=len(words))
        for k in range(scores.shape[1]):
            sums[:, k] += np.bincount(word, scores[bucket, k], minlength=len(words))
    return sums, counts


def bag(text, size):
    """The different buckets of a text, and the share of each."""
    words = text.split() if text else []
    found = [b for b, _ in buckets_of(words, size)] if words else []
    again = sum(a == b for a, b in zip(words, words[1:]))
    idx, times = np.unique(np.concatenate([*found, np.full(again, AGAIN)]) if found else np.zeros(0, np.int64),
                           return_counts=True)
    return idx.astype(np.int32), (times / max(1, times.sum())).astype(np.float32)


def bags(texts, size):
    """The bags of all texts, as pieces of arrays with room for ROOM buckets.

    The driver holds them next to Spark: they take eight bytes a bucket (what is not
    yet filled takes nothing), and all of it goes back when they do, unlike the
    memory of thousands of small arrays.
    """
    out, free = [], 0
    for text in texts:
        own, share = bag(text, size)
        if len(own) > free:
            free = max(ROOM, len(own))
            idx, weight = np.empty(free, np.int32), np.empty(free, np.float32)
        if len(own):
            at = slice(len(idx) - free, len(idx) - free + len(own))
            idx[at], weight[at] = own, share
            own, share, free = idx[at], weight[at], free - len(own)
        out.append((own, share))
    return out


def train(texts, labels, classes, buckets=2**18, dim=8, steps=STEPS, rate=0.5, seed=7):
    """Fits vectors and output layer to labelled texts.

    Each step takes one document, all in turn in ever new orders; the rate falls to
    zero over the `steps`, as many for any number of texts. Without texts every class
    is equally likely.
    """
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, len(classes)), np.float32), np.zeros(len(classes), np.float32)
    held = bags(texts, buckets)
    targets = np.array([classes.index(c) for c in labels], np.int64)
    step = 0
    while held and step < steps:
        for i in rng.permutation(len(held))[:steps - step]:
            idx, weight = held[i]
            r = rate * (1 - step / steps)
            step += 1
            mean = weight @ vectors[idx]
            logits = mean @ layer + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[targets[i]] -= 1
            back = layer @ error
            layer -= r * np.outer(mean, error)
            bias -= r * 0.1 * error
            if len(idx):
                # Weights are small shares; the step is scaled so that a word is learned as fast in long texts.
                vectors[idx] -= r * (weight / weight.max())[:, None] * back
    return Model(list(classes), vectors @ layer, bias)


def fit(docs, labels, label_col, id_col="doc_id", text_col="text", fit_rows=6000, **options):
    """Trains on the `fit_rows` labels whose ids have the smallest hashes (on all, if there are fewer).

    The bound holds for the training rows only: no more than `fit_rows` rows, with
    their whole texts, come to the driver, whatever the size of the tables. Rows
    without a label are left out; null texts count as empty; of repeated ids every
    row counts up to that number. Without any labelled row all texts score alike.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).dropna()
    order = [F.xxhash64("_id"), "_id", "_label"]
    some = known.orderBy(*order).limit(fit_rows)
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
            .join(some, "_id").orderBy(*order, "_text").limit(fit_rows).collect())
    given = [r["_label"] for r in rows]
    rows.reverse()
    texts = (rows.pop()["_text"] for _ in given)  # each text goes once it is taken apart
    return train(texts, given, sorted(set(given)) or [0, 1], **options)


def classify(df, model, positive, text_col="text", name="score"):
    """Adds the probability of class `positive` as column `name` (a column of that name gives way).

    Nulls count as empty texts and get a score as well. Texts are read whole; rows
    and other columns stay as they are. A class the model never saw scores 0.
    """
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        m = sent.value
        at = m.classes.index(positive) if positive in m.classes else None
        for texts in batches:
            yield pd.Series(m.probabilities(texts.tolist())[:, at] if at is not None else np.zeros(len(texts)))

    return with_columns(df, {name: score(F.col(text_col))})


def learnable(labels, id_col="doc_id"):
    """The labels outside the held-out part: ids whose crc32, modulo 3, is not 1."""
    return labels.where(remainder(id_col, 3) != 1)
