"""Byte-pair encoding by speculation: longest-match proposals, checked pair by pair.

A proposal is right if each token encodes to itself and no two neighbours would
have merged across their border. Both follow from the merge list alone:

* Merges are made in rank order, and a merge never ranks before its parts (checked
  when the file is read). So while `x` grows on its own, the symbol at its right
  border is, in turn, one of the right spine: a character, ..., the right half of
  `x`, `x`. Each lasts until the rank of the next. The same holds for the left
  spine of a right neighbour `y`.
* A pair (s, u) of the two spines with a merge of rank m breaks the border if m
  comes before s is used up, and not after u is (of equal ranks the left one is
  merged first).

All pairs of a batch are tested together with numpy; only words with a broken
border are merged step by step.
"""

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pandas as pd
import regex
from pyspark.sql import functions as F

from rowtide.llm.common import with_columns

NEVER = 2**31 - 1
WORD_END = "</w>"
END = "\0"  # stands for WORD_END while matching; no byte-level letter
# White space as Unicode defines it, and the pattern of the tokenizer file.
SPACE = r"\t-\r\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Words coded together, words remembered by a worker in each of two generations, letters of words that are merged
# side by side: bounds on memory, not on what is encoded.
GROUP_WORDS = 100_000
KEPT_WORDS = 200_000
WIDE = 32
SLICE = 500  # texts


def byte_letters():
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEndBPE:
    """A tokenizer file of the library's JSON form: NFC, lower case, words cut by a pattern, byte level, `</w>`.

    Token ids come as int32 bytes or, if `decimal`, as text with spaces between."""

    def __init__(self, spec, decimal=False):
        self.decimal = decimal
        spec = json.loads(spec)
        model = spec["model"]
        if model["type"] != "BPE" or model["end_of_word_suffix"] != WORD_END or spec["decoder"] is not None:
            raise ValueError("not a BPE file with word ends and no decoder")
        self.ids = model["vocab"]
        self.texts = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts.update({i: t for t, i in self.special.items()})
        self.at_special = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"].replace(r"\s", SPACE)
        self.cut = regex.compile(pattern)
        self.cut_ascii = re.compile(pattern.replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9"))
        self.letters = str.maketrans({chr(b): c for b, c in byte_letters().items()})
        self.special_words = {t: (self.coded([i]), t) for t, i in self.special.items()}
        self.words, self.older = {}, {}
        self._merge_tables([tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]])

    def _merge_tables(self, merges):
        n = max(self.ids.values()) + 1
        left, right = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
        rank = np.full(n, -1, np.int32)
        self.size, self.pair_rank, self.token_of_rank = n, {}, []
        for r, (a, b) in enumerate(merges):
            a, b, t = self.ids[a], self.ids[b], self.ids[a + b]
            if rank[t] >= 0 or rank[a] >= r or rank[b] >= r:
                raise ValueError("merges must make each token once, after its parts")
            left[t], right[t], rank[t] = a, b, r
            self.pair_rank[a, b] = r
            self.token_of_rank.append(t)
        self.rank = rank
        self.merged = np.array(self.token_of_rank, np.int64)
        # Tokens of the byte-level letters, inside a word and at its end.
        self.letter, self.last_letter = np.zeros(512, np.int64), np.zeros(512, np.int64)
        for c in byte_letters().values():
            self.letter[ord(c)], self.last_letter[ord(c)] = self.ids[c], self.ids[c + WORD_END]
        keys = np.array([a * n + b for a, b in self.pair_rank], np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = order.astype(np.int32)
        self.right_spine, self.left_spine = self._spine(right), self._spine(left)
        # A token is proposed only if the merges lead to it: its halves are, and nothing but its own merge joins them.
        made = np.flatnonzero(rank >= 0)
        made = made[np.argsort(rank[made])]
        clean = self.compatible(left[made], right[made], before=rank[made])
        stable = np.ones(n, bool)
        for t, ok in zip(made, clean):
            stable[t] = ok and stable[left[t]] and stable[right[t]]
        self.matcher = ahocorasick.Automaton()
        for t, i in self.ids.items():
            if stable[i]:
                self.matcher.add_word(t.removesuffix(WORD_END) + END if t.endswith(WORD_END) else t, i)
        self.matcher.add_word(END, -1)  # what is left when a match stops right before the end
        self.matcher.make_automaton()

    def _spine(self, half):
        """Per step: the symbols at the border, and the rank at which each is used up."""
        at, until = np.arange(self.size), np.full(self.size, NEVER, np.int32)
        steps = []
        while (at >= 0).any():
            steps.append((at, until))
            inner = at >= 0
            until = np.where(inner, self.rank[at], np.int32(NEVER))
            at = np.where(inner, half[at], -1)
        return steps

    def compatible(self, x, y, before=NEVER):
        """Whether `x` and `y` stay apart side by side; `before` counts only merges of a lower rank."""
        broken = np.zeros(len(x), bool)
        before = np.broadcast_to(before, len(x))
        outer = np.arange(len(x))
        for s, s_until in self.right_spine:
            outer = outer[s[x[outer]] >= 0]
            i = outer
            for u, u_until in self.left_spine:
                i = i[u[y[i]] >= 0]
                m = self.rank_of(s[x[i]], u[y[i]])
                broken[i] |= (m < before[i]) & (m < s_until[x[i]]) & (m <= u_until[y[i]]) & (m < NEVER)
        return ~broken

    def rank_of(self, x, y):
        """Ranks of the merges of `x` and `y`, NEVER without one."""
        key = x * self.size + y
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], np.int32(NEVER))

    def propose(self, words):
        """Longest matches from the left: token ids, and how many each word has.

        A word that no tokens cover to its end gets the id -1 there.
        """
        found = list(self.matcher.iter_long("".join([w + END for w in words])))
        last = np.fromiter((e for e, _ in found), np.int64, len(found))
        ids = np.fromiter((t for _, t in found), np.int64, len(found))
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        return ids, np.diff(np.searchsorted(last, ends, "right"), prepend=0)

    def merge(self, word):
        """Exact merging, lowest rank first and of equal ranks the left one."""
        parts = [self.ids[c] for c in word[:-1]] + [self.ids[word[-1] + WORD_END]]
        rank = self.pair_rank.get
        ranks = [rank(p, NEVER) for p in zip(parts, parts[1:])]
        while ranks and (r := min(ranks)) < NEVER:
            i = ranks.index(r)
            parts[i:i + 2] = [self.token_of_rank[r]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), NEVER)
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), NEVER)
        return parts

    def merge_all(self, words):
        """`merge` for many words: each round makes the next merge of every word."""
        out = [None] * len(words)
        of = np.array([w for w, word in enumerate(words) if len(word) <= WIDE], np.int64)
        for w, word in enumerate(words):
            if len(word) > WIDE:
                out[w] = self.merge(word)
        if not len(of):
            return out
        sizes = np.array([len(words[w]) for w in of.tolist()])
        letters = np.frombuffer("".join([words[w] for w in of.tolist()]).encode("utf-32-le"), np.uint32)
        parts = np.full((len(of), sizes.max()), -1, np.int64)
        parts[np.arange(parts.shape[1]) < sizes[:, None]] = self.letter[letters]
        parts[np.arange(len(of)), sizes - 1] = self.last_letter[letters[np.cumsum(sizes) - 1]]

        def rank_at(rows, at):
            """Ranks of the pairs that begin at a place; NEVER outside the word."""
            inside = (at >= 0) & (at + 1 < sizes[rows])
            ranks = np.full(len(rows), NEVER, np.int32)
            ranks[inside] = self.rank_of(parts[rows[inside], at[inside]], parts[rows[inside], at[inside] + 1])
            return ranks

        width = parts.shape[1]
        rows, places = np.divmod(np.arange(parts.size), width)
        ranks = rank_at(rows, places).reshape(parts.shape)
        columns = np.arange(width)
        while len(of):
            best = ranks.argmin(axis=1)
            rank = ranks[np.arange(len(of)), best]
            done = rank == NEVER
            if done.any():
                for w, n, ids in zip(of[done].tolist(), sizes[done].tolist(), parts[done].tolist()):
                    out[w] = ids[:n]
                of, sizes, parts, ranks, best, rank = (a[~done] for a in (of, sizes, parts, ranks, best, rank))
                if not len(of):
                    break
            rows = np.arange(len(of))
            parts[rows, best] = self.merged[rank]
            shifted = np.minimum(columns + (columns > best[:, None]), width - 1)
            parts = np.take_along_axis(parts, shifted, 1)
            ranks = np.take_along_axis(ranks, shifted, 1)
            sizes = sizes - 1
            ranks[rows, sizes - 1] = NEVER
            ranks[rows, best] = rank_at(rows, best)
            left = rows[best > 0]
            ranks[left, best[left] - 1] = rank_at(left, best[left] - 1)
        return out

    def coded(self, ids):
        return " ".join(map(str, ids)) if self.decimal else np.array(ids, np.int32).tobytes()

    def encode_words(self, words):
        """Per (byte-level) word: token ids (see the class), and their texts."""
        if not words:
            return []
        ids, counts = self.propose(words)
        of = np.repeat(np.arange(len(words)), counts)
        wrong = np.zeros(len(words), bool)
        wrong[of[ids < 0]] = True
        inside = np.flatnonzero((of[1:] == of[:-1]) & ~wrong[of[1:]])
        pairs, back = np.unique(ids[inside] * self.size + ids[inside + 1], return_inverse=True)
        wrong[of[inside[~self.compatible(pairs // self.size, pairs % self.size)[back]]]] = True
        stop, every = np.cumsum(counts), ids.tolist()
        proposed = [every[a:b] for a, b in zip((stop - counts).tolist(), stop.tolist())]
        wrong = np.flatnonzero(wrong).tolist()
        for w, exact in zip(wrong, self.merge_all([words[w] for w in wrong])):
            proposed[w] = exact
        texts = self.texts
        return [(self.coded(p), " ".join([texts[t] for t in p])) for p in proposed]

    def cut_words(self, text):
        """The words of a text, and its special tokens as they stand."""
        out, at = [], 0
        marks = self.at_special.finditer(text) if any(t in text for t in self.special) else ()
        for m in [*marks, None]:
            plain = text[at:m.start() if m else None]
            if plain.isascii():
                out += self.cut_ascii.findall(plain.lower())
            else:
                # Letters are lowered one by one, so a final sigma gets no form of its own.
                out += self.cut.findall(unicodedata.normalize("NFC", plain).replace("\u03a3", "\u03c3").lower())
            if m:
                out.append(m[0])
                at = m.end()
        return out

    def encode(self, texts):
        """(ids, decoded text) per text; texts go through in groups, so that many words share one pair check."""
        texts = [self.cut_words(t or "") for t in texts]
        out, start = [], 0
        while start < len(texts):
            end, n = start + 1, len(texts[start])
            while end < len(texts) and n + len(texts[end]) <= GROUP_WORDS:
                n += len(texts[end])
                end += 1
            ids_of, text_of = self.known(set(chain.from_iterable(texts[start:end])))
            for words in texts[start:end]:
                ids, text = map(ids_of.__getitem__, words), " ".join(map(text_of.__getitem__, words))
                out.append((" ".join(ids) if self.decimal else np.frombuffer(b"".join(ids), np.int32), text))
            start = end
        return out

    def known(self, need):
        """Ids and texts of words, solved now or remembered. A full generation of words becomes the older one;
        words still met are taken over into the next."""
        found, new = {t: self.special_words[t] for t in need & self.special_words.keys()}, []
        for w in need - found.keys():
            hit = self.words.get(w) or self.older.get(w)
            if hit is None:
                new.append(w)
            else:
                found[w] = hit
        found.update(zip(new, self.encode_words([self.letters_of(w) for w in new])))
        if len(self.words) > KEPT_WORDS:
            self.words, self.older = {}, self.words
        self.words.update(found)
        return {w: ids for w, (ids, _) in found.items()}, {w: text for w, (_, text) in found.items()}

    def letters_of(self, word):
        """The word in byte-level letters."""
        return word.encode().decode("latin-1").translate(self.letters)


@lru_cache(maxsize=2)
def _tokenizer(spec, decimal):
    return WordEndBPE(spec, decimal)


def _coded(df, tokenizer_file, text_col, returns, decimal, row):
    """Adds a struct column of what `row` makes of each text's ids and decoded text."""
    with open(tokenizer_file, encoding="utf-8") as f:
        spec = df.sparkSession.sparkContext.broadcast(f.read())
    names = [r.split()[0] for r in returns.split(", ")]

    @F.pandas_udf(returns)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tokenizer = _tokenizer(spec.value, decimal)
        for texts in batches:
            # A batch holds 64 MB of text at most; slices keep what it grows to small.
            for start in range(0, len(texts), SLICE):
                done = zip(*[row(*c) for c in tokenizer.encode(texts.iloc[start:start + SLICE])])
                yield pd.DataFrame({name: pd.Series(values, dtype=object) for name, values in zip(names, done)}, columns=names)

    # The call itself is no cheap expression: asked for once, not per field.
    coded = with_columns(df, {"_coded": run(F.col(text_col))})
    return with_columns(coded, {name: F.col(f"_coded.{name}") for name in names}).drop("_coded")


def encode(df, tokenizer_file, text_col="text"):
    """Adds `ids` (array<int>) and `decoded` (their token texts joined by a space, as the file names no decoder).

    `tokenizer_file` is read on the driver and sent to the tasks. Null and empty
    texts give no ids and an empty text; every text is encoded whole; rows,
    repeated ones included, and further columns stay as they are, but a column
    named `ids` or `decoded` gives way. An empty table stays empty.
    """
    return _coded(df, tokenizer_file, text_col, "ids array<int>, decoded string", False, lambda ids, text: (ids, text))


def digests(df, tokenizer_file, id_col="doc_id", text_col="text"):
    """doc_id, n_tokens, ids_sha256, decoded_sha256: what `encode` gives, hashed where it is made, so that neither ids
    nor texts leave the tasks."""
    def row(ids, text):
        return ids.count(" ") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    done = _coded(df.select(id_col, text_col), tokenizer_file, text_col, "n_tokens long, ids_sha256 string, decoded_sha256 string", True, row)
    return done.drop(text_col)
