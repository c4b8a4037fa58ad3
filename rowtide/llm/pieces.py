"""Token counts of a unigram vocabulary, without the tokens.

Every piece of the vocabulary that occurs in a text is found by an Aho-Corasick
automaton; dynamic programming over the places carries the best score and the
number of its pieces. Ties are settled as the tokenizer does: of equally good ways
to reach a place, the one whose last piece starts first stays (a later one must be
better). A character that is no piece counts as unknown, 10 below the worst score,
and stands for its UTF-8 bytes.

The tokenizer file's pieces and scores are read as a unigram model. No piece holds
a word mark after another character, so a text falls into words with their marks,
each solved once while a worker remembers it; scores are summed exactly, where the library's 32-bit
sums round in long texts.
"""

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
import sentencepiece
from pyspark.sql import functions as F

from rowtide.llm.common import with_columns

MARK = "▁"
BELOW_WORST = 10.0
# Parts held at a time, and solved parts a worker remembers: bounds on memory.
GROUP_PARTS = 100_000
KEPT_PARTS = 400_000


class Pieces:
    """Pieces with scores, as a tokenizer of bytes for unknown characters has them."""

    def __init__(self, scores):
        self.automaton = ahocorasick.Automaton()
        for i, piece in enumerate(scores):
            if MARK in piece.lstrip(MARK):
                raise ValueError(f"{piece!r} crosses words")
            self.automaton.add_word(piece, i)
        self.sizes = np.fromiter(map(len, scores), np.int64, len(scores))
        self.scores = np.fromiter(scores.values(), np.float64, len(scores))
        self.automaton.make_automaton()
        self.known, self.solved = {}, (np.zeros(0), np.zeros(0, np.int64))
        self.unknown = min(scores.values()) - BELOW_WORST
        # A character of no piece can stand between the parts, as no match crosses it.
        self.gap = next(chr(c) for c in range(0xE000, 0xF8FF) if not any(chr(c) in p for p in scores))
        line = "" if any("\n" in p for p in scores) else "|\n"
        self.part = regex.compile(f"{MARK}*[^{MARK}{line[1:]}]+|{MARK}+{line}")

    @classmethod
    def read(cls, model_proto):
        m = sentencepiece.SentencePieceProcessor(model_proto=model_proto)
        plain = [i for i in range(m.get_piece_size()) if not (m.is_control(i) or m.is_unknown(i) or m.is_byte(i) or m.is_unused(i))]
        return cls({m.id_to_piece(i): m.get_score(i) for i in plain})

    def parts(self, text):
        return self.part.findall(MARK + text.replace(" ", MARK)) if text else []

    def solve(self, parts):
        """(scores, counts) of the best segmentations of non-empty parts."""
        lengths = np.fromiter(map(len, parts), np.int64, len(parts))
        gapped = self.gap.join(parts)
        offset = np.cumsum(lengths + 1) - lengths - 1  # of a part's first character
        found = np.fromiter(chain.from_iterable(self.automaton.iter(gapped)), np.int64).reshape(-1, 2)
        end, piece = found[:, 0] + 1, found[:, 1]
        size, score = self.sizes[piece], self.scores[piece]
        single = np.zeros(len(gapped) + 1, bool)
        single[end[size == 1]] = True
        place = np.arange(lengths.sum()) + np.repeat(np.arange(len(parts)), lengths) + 1
        alone = place[~single[place]]  # ends of unknown characters
        end = np.concatenate([end, alone])
        size = np.concatenate([size, np.ones(len(alone), np.int64)])
        score = np.concatenate([score, np.full(len(alone), self.unknown)])
        # One more place for an unknown character's bytes beyond the first.
        worth = np.ones(len(end), np.int64)
        worth[len(found):] = [len(gapped[i - 1].encode("utf-8", "replace")) for i in alone.tolist()]
        step = end - offset[np.searchsorted(offset, end - 1, "right") - 1]
        # Matches come by end, the longest first; an unknown character is the shortest way to its end.
        order = np.argsort(end, kind="stable")
        order = order[np.argsort(step[order].astype(np.uint16 if lengths.max() < 2**16 else np.int64),
                                 kind="stable")]
        end, size, score, worth = end[order], size[order], score[order], worth[order]
        step = step[order]
        best, count = np.zeros(len(gapped) + 1), np.zeros(len(gapped) + 1, np.int64)
        cuts = np.flatnonzero(np.diff(step)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(end)]):
            e = end[a:b]
            way = best[e - size[a:b]] + score[a:b]
            first = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
            top = np.maximum.reduceat(way, first)
            group = np.repeat(np.arange(len(first)), np.diff([*first, len(e)]))
            # Of equal ways the first has the earliest start.
            pick = np.minimum.reduceat(np.where(way == top[group], np.arange(len(e)), len(e)), first)
            best[e[first]] = top
            count[e[first]] = count[e[pick] - size[a:b][pick]] + worth[a:b][pick]
        last = offset + lengths
        return best[last], count[last]

    def count(self, texts):
        """(scores, piece counts) per text."""
        scores, counts = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
        held, start, n = [], 0, 0
        for i, t in enumerate(texts):
            held.append(self.parts(t))
            n += len(held[-1])
            if n >= GROUP_PARTS or i + 1 == len(texts):
                new = list(set(chain.from_iterable(held)) - self.known.keys())
                if len(self.known) + len(new) > KEPT_PARTS:
                    self.known, self.solved = {}, (np.zeros(0), np.zeros(0, np.int64))
                    new = list(set(chain.from_iterable(held)))
                if new:
                    self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
                    self.solved = tuple(np.concatenate(x) for x in zip(self.solved, self.solve(new)))
                for j, parts in enumerate(held):
                    own = np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))
                    scores[start + j], counts[start + j] = self.solved[0][own].sum(), self.solved[1][own].sum()
                held, start, n = [], i + 1, 0
        return scores, counts


@lru_cache(maxsize=2)
def _pieces(proto):
    return Pieces.read(proto)


def count_tokens(df, model_file, text_col="text"):
    """Adds `n_tokens` (long) and `score` (double, of the best segmentation); columns of these names give way.

    `model_file` is read on the driver and sent to the tasks. Null and empty texts
    have no tokens and score 0. Texts are read whole; rows and other columns stay
    as they are; an empty table stays empty.
    """
    with open(model_file, "rb") as f:
        sent = df.sparkSession.sparkContext.broadcast(f.read())

    @F.pandas_udf("n_tokens long, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        pieces = _pieces(sent.value)
        for texts in batches:
            scores, counts = pieces.count(texts.tolist())
            yield pd.DataFrame({"n_tokens": counts, "score": scores})

    counted = with_columns(df, {"_counted": run(F.col(text_col))})
    return with_columns(counted, {"n_tokens": F.col("_counted.n_tokens"), "score": F.col("_counted.score")}).drop("_counted")
