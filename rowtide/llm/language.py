"""Language profiles in a high-dimensional space.

Each letter has a random vector of +1 and -1, made from its code point alone. The
vector of a letter triple binds (multiplies) its letters' vectors, each permuted
(rotated) by its place; a text is the sum (bundle) of its triples, and a language
the sum of its texts' directions. The language with the largest cosine wins.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from rowtide.llm.common import with_columns

DIM = 512
PLACES = 3
# Triples whose vectors a worker keeps ready; all others are bound anew each time, with the same result.
KEPT_ROWS = 128
KEPT_TRIPLES = 16_384
UNKNOWN = "und"


class Letters:
    """Vectors of the letters met so far, ready in each rotation."""

    def __init__(self, dim=DIM, seed=11):
        self.dim, self.seed, self.rows, self.used = dim, seed, {}, 0
        self.turned = np.empty((PLACES, 256, dim), np.int8)
        self.kind = np.full(0x110000, -1, np.int32)  # of a code point: its row, 0 for no letter, -1 not looked up
        self.slots = np.full(KEPT_ROWS**PLACES, -1, np.int32)
        self.triples, self.kept = np.empty((KEPT_TRIPLES, dim), np.float32), 0
        self._row(0)

    def _row(self, code):
        if self.used == self.turned.shape[1]:
            self.turned = np.concatenate([self.turned, np.empty_like(self.turned)], 1)
        v = np.random.default_rng([self.seed, code]).integers(0, 2, self.dim, np.int8) * 2 - 1
        for k in range(PLACES):
            self.turned[k, self.used] = np.roll(v, PLACES - 1 - k)
        self.used += 1
        return self.used - 1

    def codes(self, text):
        """Rows of the text's letters, 0 for each run of anything else, with 0 at both ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        for p in np.unique(points[self.kind[points] < 0]):
            self.kind[p] = self._row(int(p)) if chr(p).isalpha() else 0
        rows = np.concatenate([[0], self.kind[points], [0]])
        return rows[np.concatenate([[True], (rows[1:] != 0) | (rows[:-1] != 0)])]

    def vector(self, text):
        """The bundle of a text, or None without letters."""
        rows = self.codes(text or "").astype(np.int64)
        if not rows.any():
            return None
        mid = np.flatnonzero(rows[1:-1]) + 1
        a, b, c = rows[mid - 1], rows[mid], rows[mid + 1]
        slot = np.full(len(mid), -1, np.int32)
        few = (a | b | c) < KEPT_ROWS
        key = (a[few] * KEPT_ROWS + b[few]) * KEPT_ROWS + c[few]
        new = np.unique(key[self.slots[key] < 0])[:KEPT_TRIPLES - self.kept]
        if len(new):
            self.slots[new] = np.arange(self.kept, self.kept + len(new))
            self.triples[self.kept:self.kept + len(new)] = self.bound(
                new // KEPT_ROWS**2, new // KEPT_ROWS % KEPT_ROWS, new % KEPT_ROWS)
            self.kept += len(new)
        slot[few] = self.slots[key]
        times = np.bincount(slot[slot >= 0], minlength=1)
        used = np.flatnonzero(times)
        out = times[used].astype(np.float32) @ self.triples[used]
        rest = slot < 0
        if rest.any():
            trio, times = np.unique(np.stack([a[rest], b[rest], c[rest]]), axis=1, return_counts=True)
            for start in range(0, len(times), 4096):
                part = slice(start, start + 4096)
                out += times[part].astype(np.float32) @ self.bound(*trio[:, part]).astype(np.float32)
        return out

    def bound(self, a, b, c):
        return self.turned[0, a] * self.turned[1, b] * self.turned[2, c]


@dataclass
class Profiles:
    names: list
    vectors: np.ndarray  # unit length, one row per language

    def best(self, vector):
        """(language, cosine); ties go to the first name, a vector of nothing to none."""
        length = np.linalg.norm(vector) if vector is not None else 0
        if not length or not self.names:
            return UNKNOWN, 0.0
        near = self.vectors @ vector / length
        at = int(near.argmax())
        return self.names[at], float(min(1.0, max(0.0, near[at])))


def fit(df, lang_col="lang", text_col="text", dim=DIM):
    """Profiles from all rows with a language, so a language of a few texts gets its profile too.

    Null languages and texts without letters teach nothing; repeated rows count
    each. Only sums per language and dimension come to the driver. An empty table
    gives no profiles.
    """
    some = df.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))

    def sums(batches):
        letters = Letters(dim)
        for batch in batches:
            total = {}
            for lang, text in zip(batch["lang"], batch["text"]):
                v = letters.vector(text)
                if v is not None and (length := np.linalg.norm(v)):
                    total[lang] = total.get(lang, 0) + v.astype(np.float64) / length
            yield pd.DataFrame({"lang": list(total), "vector": list(total.values())})

    dims = (some.mapInPandas(sums, "lang string, vector array<double>")
            .select("lang", F.posexplode("vector").alias("dim", "x")).groupBy("lang", "dim").agg(F.sum("x").alias("x")))
    rows = dims.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("v")).collect()
    vectors = {r["lang"]: np.array([x["x"] for x in r["v"]]) for r in rows}
    names = sorted(n for n, v in vectors.items() if np.linalg.norm(v))
    return Profiles(names, np.array([vectors[n] / np.linalg.norm(vectors[n]) for n in names], np.float32).reshape(-1, dim))


def identify(df, profiles, text_col="text"):
    """Adds `lang_pred` and `score` (the cosine, 0 at least). Columns of these names give way.

    `und` with score 0 for null texts, texts without letters, and when there are no
    profiles. Texts are read whole; rows and other columns stay as they are.
    """
    sent = df.sparkSession.sparkContext.broadcast(profiles)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        p = sent.value
        letters = Letters(p.vectors.shape[1])
        for texts in batches:
            yield pd.DataFrame([p.best(letters.vector(t)) for t in texts], columns=["lang", "score"])

    named = with_columns(df, {"_named": run(F.col(text_col))})
    return with_columns(named, {"lang_pred": F.col("_named.lang"), "score": F.col("_named.score")}).drop("_named")
