"""Every operator against a plain version on small tables: nulls, empty and long texts, ties, repeated rows, clashing names."""

import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
import xxhash
from docs import PASSAGE, frame, rows
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowtide.functions import joins
from rowtide.llm import (bpe, common, contamination, exact, graph, katz, language, licenses, lines, pieces, quality, queries, simhash)
from rowtide.llm.common import ascii_lower, plain_words, remainder
from rowtide.llm.queries import TOKENIZERS

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
BPE_FILE, PIECE_FILE = f"{TOKENIZERS}/word_bpe_49k.json", f"{TOKENIZERS}/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def docs(spark):
    return frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


def spread(found, *columns):
    return sorted((tuple(str(r[c]) for c in columns) for r in found.collect()))


def crc(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return "".join(c if c in "abcdefghijklmnopqrstuvwxyz0123456789" or ord(c) > 127 else " " for c in low).split(" ")


def words_of(text):
    return [w for w in plain(text) if w]


def test_shared_pieces(docs):
    got = docs.select("text", plain_words(F.col("text")).alias("w"), remainder("doc_id", 7).alias("r"), "doc_id").collect()
    for r in got:
        assert r["w"] == words_of(r["text"])
        assert r["r"] == crc(r["doc_id"]) % 7
    assert docs.select(ascii_lower(F.lit("ÀBÇ Z"))).first()[0] == "ÀbÇ z"


# 1

class PlainKatz:
    def __init__(self, texts, held, order):
        self.order = order
        self.texts = [["<s>"] + katz.tokenize(t) + ["</s>"] for t in texts]
        self.c = [None] + [Counter() for _ in range(order)]
        train = [t for t, h in zip(self.texts, held) if not h]
        for t in train:
            for i in range(1, len(t)):
                for m in range(1, order + 1):
                    if i - m + 1 >= 0:
                        self.c[m][tuple(t[i - m + 1:i + 1])] += 1
        self.started, self.n, self.v = len(train), sum(self.c[1].values()), len(self.c[1])
        self.d = [None] + [katz.discounts([sum(x == r for x in self.c[m].values()) for r in range(1, katz.K + 2)]) for m in range(1, order + 1)]
        self.unknown = 1 - sum(self.kept(1, x) for x in self.c[1].values()) / self.n if self.n else 1.0
        self.after = defaultdict(list)
        for m in range(2, order + 1):
            for g in self.c[m]:
                self.after[g[:-1]].append(g[-1])

    def kept(self, m, c):
        return c * (self.d[m][c - 1] if c <= katz.K else 1 - katz.RESERVE)

    def seen(self, h):
        return self.started if h == ("<s>",) else self.c[len(h)][h]

    def p(self, w, h):
        if not h:
            c = self.c[1].get((w,), 0)
            return self.kept(1, c) / self.n if c else self.unknown
        c = self.c[len(h) + 1].get(h + (w,), 0)
        if c:
            return self.kept(len(h) + 1, c) / self.seen(h)
        return (self.a(h) if self.seen(h) else 1) * self.p(w, h[1:])

    def a(self, h):
        return (1 - sum(self.p(w, h) for w in self.after[h])) / (1 - sum(self.p(w, h[1:]) for w in self.after[h]))

    def score(self, t):
        return sum(math.log10(self.p(t[i], tuple(t[max(0, i - self.order + 1):i]))) for i in range(1, len(t)))


@pytest.mark.parametrize("order", [2, 3])
def test_katz(spark, order, monkeypatch):
    monkeypatch.setattr(katz, "BUCKET_GRAMS", 50)
    r = random.Random(order)
    given = [(i, " ".join(r.choice("a b c d e f g hh Ii jj".split()) for _ in range(r.randrange(12))), None, None) for i in range(60)]
    given += [x for x in rows() if x[1] is None or len(x[1]) < 1000]
    given += [(2**60 + 1, "a b", None, None), (None, "b a", None, None), (-(2**60) - 1, "hh " * 2000, None, None)]
    found = katz.fit_and_score(frame(spark, given).repartition(3), remainder("doc_id", 7) == 2, order=order).collect()
    model = PlainKatz([t for _, t, _, _ in given], [crc(i) % 7 == 2 for i, *_ in given], order)
    expected = sorted(((str(i), model.score(t), len(t) - 1) for (i, *_), t in zip(given, model.texts)))
    got = sorted((str(x["doc_id"]), x["score"], x["n_tokens"]) for x in found)
    assert len(got) == len(expected)
    for a, b in zip(got, expected):
        assert a[0] == b[0] and a[2] == b[2] and a[1] == pytest.approx(b[1], abs=1e-9)
    seen = Counter(w for (i, *_), t in zip(given, model.texts) if crc(i) % 7 != 2 for w in t[1:])
    base = lambda t: sum(math.log10((seen[w] + 1) / (seen.total() + len(seen) + 1)) for w in t[1:])
    plainly = sorted((str(i), sum(w in seen for w in t[1:]), round(base(t), 6)) for (i, *_), t in zip(given, model.texts))
    assert sorted((str(x["doc_id"]), x["n_known"], round(x["base_score"], 6)) for x in found) == plainly
    for x in found:
        assert x["train_tokens"] == model.n
        assert x["held_out"] == (crc(x["doc_id"]) % 7 == 2)
    for h in [("<s>",), *list(model.after)[:20]]:
        assert sum(model.p(w, h) for (w,) in model.c[1]) + model.p("never seen", h) == pytest.approx(1, abs=1e-9)


def test_katz_without_texts(empty, spark):
    assert katz.fit_and_score(empty, F.lit(False)).count() == 0
    alone = katz.fit_and_score(frame(spark, [(1, "a b", None, None)]), F.lit(True)).first()
    assert (alone["train_tokens"], alone["n_known"], alone["n_tokens"], alone["score"], alone["base_score"]) == (0, 0, 3, 0.0, 0.0)


def test_discounts_without_counts():
    assert list(katz.discounts([0] * 6)) == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]
    assert all(0 < d < 1 for d in katz.discounts([100, 40, 20, 10, 8, 5]))


# 2

def unigram_reading(add_prefix):
    """The library's own unigram tokenizer over the same pieces: the model type is set in the file's bytes."""
    proto = open(PIECE_FILE, "rb").read()
    at = proto.index(b"\x12\x06tok_v0\x18\x02") + 9
    proto = proto[:at] + b"\x01" + proto[at + 1:]
    at = proto.rindex(b"\x0a\x08identity") + 13
    assert proto[at] == 1
    return sentencepiece.SentencePieceProcessor(model_proto=proto if add_prefix else proto[:at] + b"\0" + proto[at + 1:])


def test_pieces_like_the_library():
    own, library = pieces.Pieces.read(open(PIECE_FILE, "rb").read()), unigram_reading(False)
    r = random.Random(5)
    texts = [t for _, t, _, _ in rows() if t and len(t) < 1000]
    texts += ["".join(r.choice("abcdefghij tttheeeiiinng'ssll\n\t.,!?é1239ÄöΣßあ") for _ in range(r.randrange(60))) for _ in range(300)]
    parts = sorted({p for t in texts for p in own.parts(t)})
    scores, counts = own.solve(parts)
    for p, c in zip(parts, counts):
        # The n-best search follows scores alone; the first is the best.
        assert len(library.nbest_encode_as_pieces(p, 2)[0]) == c, p


def test_pieces_ties_and_unknown():
    own = pieces.Pieces({"▁a": -1.0, "b": -1.0, "▁ab": -2.0, "c": -1.0, "bc": -2.0, "▁": -5.0, "a": -4.0})
    # Equal scores: the last piece that starts first stays.
    assert [x.tolist() for x in own.solve(["▁ab", "▁abc"])] == [[-2.0, -3.0], [1, 2]]
    assert [x.tolist() for x in own.solve(["▁é"])] == [[-20.0], [3]]  # -5 and the unknown -15, of two bytes


def test_count_tokens(docs, empty):
    own = pieces.Pieces.read(open(PIECE_FILE, "rb").read())
    for r in pieces.count_tokens(docs, PIECE_FILE).collect():
        parts = own.parts(r["text"] or "")
        s, c = own.solve(parts) if parts else (np.zeros(0), np.zeros(0))
        assert (r["n_tokens"], r["score"], r["label"]) == (c.sum(), s.sum(), "x")
    assert pieces.count_tokens(empty, PIECE_FILE).count() == 0


# 3

@pytest.mark.parametrize("size,hashed", [(8, F.xxhash64), (8, lambda b: F.octet_length(b).cast("long")), (4096, F.xxhash64)])
def test_exact(docs, empty, size, hashed):
    given = rows()
    some = docs if size > 8 else docs.where("length(text) < 1000 OR text IS NULL")
    given = [x for x in given if size > 8 or len(x[1] or "") < 1000]
    ids = defaultdict(list)
    for i, t, _, _ in given:
        ids[t or ""].append(i)
    keep = {t: max((i for i in x if i is not None), default=None) for t, x in ids.items()}
    found = exact.duplicates(some, size=size, hashed=hashed)
    expected = sorted((str(i), str(keep[t or ""]), str(len(ids[t or ""])), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, _, _ in given)
    assert spread(found, "doc_id", "keep_id", "group_size", "text_sha256") == expected
    kept = [r for r in found.collect() if r["kept"]]
    assert sorted(r["text_sha256"] for r in kept) == sorted({hashlib.sha256(t.encode()).hexdigest() for t in ids})
    assert all(r["doc_id"] == r["keep_id"] for r in kept)
    assert exact.duplicates(empty, size=size).count() == 0


# 4

def test_quality(spark, docs, empty):
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)] + [(None, 1), (5, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels, "quality", buckets=2**12)
    found = quality.classify(docs, model, positive=1).collect()
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 and r["label"] == "x" for r in found)
    assert quality.classify(empty, model, positive=1).count() == 0
    blank = quality.fit(empty, labels, "quality", buckets=2**12)
    assert {r["score"] for r in quality.classify(docs, blank, positive=1).collect()} == {0.5}


def test_quality_learns_order_and_shape():
    r = random.Random(2)
    good = [" ".join(r.choice("alpha beta gamma delta epsilon".split()) for _ in range(40)) for _ in range(60)]
    stutter = [" ".join(sorted(t.split())) for t in good]  # the same words, repeated in a row
    model = quality.train(good[:40] + stutter[:40], [1] * 40 + [0] * 40, [0, 1], buckets=2**12)
    p = model.probabilities(good[40:] + stutter[40:])[:, 1]
    assert ((p >= 0.5) == ([True] * 20 + [False] * 20)).all()
    assert model.probabilities([None, ""]).shape == (2, 2)


HELD = """
import random, re
from rowtide.llm import quality

def held():
    return int(re.search(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read())[1]) / 1024

r = random.Random(4)
texts = lambda n: [" ".join(str(r.random()) for _ in range(200)) for _ in range(n)]
quality.train(texts(4), [0, 1] * 2, [0, 1], steps=4)
given = texts(3000)
before = held()
model = quality.train(given, [0, 1] * 1500, [0, 1], steps=4)
print(held() - before)
"""


def test_quality_training_gives_its_memory_back():
    out = subprocess.run([sys.executable, "-c", HELD], capture_output=True, text=True, timeout=120, check=True, cwd=ROOT)
    assert float(out.stdout) < 90  # MB



# 5

def plain_contamination(texts, items, window):
    out = []
    wins = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        for s in range(max(1, len(w) - window + 1)) if w else []:
            wins[tuple(w[s:s + window])].add("" if i is None else str(i))
    for t in texts:
        w, hit, has = words_of(t), set(), set()
        for g, who in wins.items():
            for s in range(len(w) - len(g) + 1):
                if tuple(w[s:s + len(g)]) == g:
                    hit |= set(range(s, s + len(g)))
                    has |= who
        out.append((len(w), len(hit), sorted(has), len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


@pytest.mark.parametrize("block_bytes", [2**25, 600])
def test_contamination(spark, docs, empty, block_bytes, monkeypatch):
    monkeypatch.setattr(contamination, "BLOCK_BYTES", block_bytes)
    items = [(1, PASSAGE), (2, "the"), (3, "Same same"), (4, None), (5, "..."), (None, PASSAGE + " more"), (10, "three two"),
             (6, "long0 text0 long1 text1 long2 text2 long3 text3 long4 text4 long5 text5 long6 text6"), (6, "the")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = contamination.contamination(docs, bench)
    expected = sorted((str(i), str(n), str(h), str(who), str(bad)) for (i, *_), (n, h, who, bad)
                      in zip(rows(), plain_contamination([t for _, t, _, _ in rows()], items, 13)))
    assert spread(found, "doc_id", "n_words", "n_hit", "items", "contaminated") == expected
    left = contamination.drop(docs, found)
    assert left.columns == docs.columns
    assert left.count() == sum(bad == "False" for *_, bad in expected)
    assert contamination.contamination(empty, bench).count() == 0
    assert contamination.contamination(docs, bench.limit(0)).where("n_hit > 0 OR contaminated").count() == 0


# 6

def plain_fingerprint(text):
    w = (text or "").encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[i:i + 3]), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints, bits=3):
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    seen = sorted(parent)
    for i, a in enumerate(seen):
        for b in seen[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                parent[find(a)] = find(b)
    return {p: find(p) for p in prints}


def test_fingerprints_and_components(docs, empty):
    found = simhash.near_duplicates(docs)
    root = plain_components([plain_fingerprint(t) for _, t, _, _ in rows()])
    ids = defaultdict(list)
    for i, t, _, _ in rows():
        ids[root[plain_fingerprint(t)]].append(i)
    expected = sorted((str(i), f"{plain_fingerprint(t):016x}", str(min((x for x in ids[root[plain_fingerprint(t)]] if x is not None), default=None)))
                      for i, t, _, _ in rows())
    got = sorted((str(r["doc_id"]), f"{r['fp'] % 2**64:016x}", str(r["component_id"])) for r in found.collect())
    assert got == expected
    kept = simhash.keep_one(docs, found)
    assert kept.columns == docs.columns
    assert kept.count() == len(ids)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(min((x for x in g if x is not None), default=None)) for g in ids.values())
    assert simhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("meeting,bits", [(16_384, 3), (4, 3), (3, 2), (4, 5)])
def test_no_link_is_lost(spark, meeting, bits):
    r = random.Random(meeting)
    prints = {r.getrandbits(64) for _ in range(100)}
    for start in [0, 2**64 - 1, r.getrandbits(64)]:  # dense groups, and chains out of them
        group = [start]
        for _ in range(60):
            x = r.choice(group)
            for b in r.sample(range(64), r.randrange(1, bits + 2)):
                x ^= 1 << b
            group.append(x)
        prints |= set(group)
    frame_ = spark.createDataFrame([(p - 2**64 if p >> 63 else p,) for p in prints], "fp long")
    links = simhash.linked(spark, frame_, bits, meeting)
    assert all(((x["a"] ^ x["b"]) % 2**64).bit_count() <= bits for x in links.collect())
    got = {x["node"] % 2**64: x["root"] % 2**64 for x in graph.components(spark, links).collect()}
    expected = plain_components(prints, bits)
    groups = lambda of: sorted(sorted(g) for g in _by_value(of).values())
    assert groups({p: got.get(p, p) for p in prints}) == groups(expected)


def _by_value(of):
    out = defaultdict(list)
    for k, v in of.items():
        out[v].append(k)
    return out


def test_components_know_stars(spark, monkeypatch):
    edges = lambda *pairs: spark.createDataFrame(list(pairs), "v long, u long")
    assert graph.stars(edges((2, 1), (3, 1), (9, 7))) and graph.stars(edges())
    assert not graph.stars(edges((2, 1), (3, 2))) and not graph.stars(edges((3, 1), (3, 2)))
    tables, written = [], graph.written
    monkeypatch.setattr(graph, "written", lambda s, df: tables.append(written(s, df)) or tables[-1])
    star = [(1, i) for i in range(2, 50)]
    got = graph.components(spark, spark.createDataFrame(star, "a long, b long")).collect()
    assert {x["node"]: x["root"] for x in got} == {i: 1 for i in range(1, 50)}
    assert len(tables) == 1  # the links; no round


def test_components(spark):
    chain = [(i, i + 1) for i in range(1, 70)] + [(1000, 2000), (2000, 1000), (5, 5)] + [(500, 500 + i) for i in range(1, 40)]
    got = {x["node"]: x["root"] for x in graph.components(spark, spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 71)} | {1000: 1000, 2000: 1000} | {500 + i: 500 for i in range(40)}


# 7

def test_lines(spark, docs, empty):
    shared = [(200 + i, f"common line\nown line {i}\n\ncommon line", "en", f"site{i % 12}") for i in range(24)]
    near = [(300 + i, f"nine sites\nleft {i}", "en", f"site{i}") for i in range(9)] + [(320 + i, "ten sites\n", "en", f"site{i}") for i in range(9)]
    near += [(329, "ten sites\n", "en", None), (None, "common line", "en", "site1"), (None, "no ids\n", "en", "s")]
    given = rows() + shared + near
    found = lines.remove_boilerplate(frame(spark, given))
    sites, first = defaultdict(set), {}
    for i, t, _, s in given:
        for x in (t or "").split("\n") if t is not None else []:
            if x.strip(" "):
                sites[x].add(s or "")
                first[x] = min((v for v in (first.get(x), i) if v is not None), default=None)
    expected = []
    for i, t, _, _ in given:
        parts = t.split("\n") if t is not None else []
        stay = [x for x in parts if len(sites.get(x, ())) < 10 or first[x] == i]
        expected.append((str(i), str("\n".join(stay) if t is not None else None), str(len(parts)), str(len(parts) - len(stay))))
    assert spread(found, "doc_id", "text", "n_lines", "n_removed") == sorted(expected)
    assert sorted(found.columns) == sorted({*docs.columns, "n_lines", "n_removed"})
    assert lines.remove_boilerplate(empty).count() == 0
    everywhere = lines.numbered(spark.range(4000).selectExpr("id AS doc_id", "'x' AS text", "concat('s', id % 1000) AS source"), "doc_id", "text", "source")
    assert lines.boilerplate(everywhere, 1000).count() == 1 and lines.boilerplate(everywhere, 1001).count() == 0


def test_few_lines_fill_few_files(spark, monkeypatch):
    tables, written = [], lines.written
    monkeypatch.setattr(lines, "written", lambda s, df: tables.append(written(s, df)) or tables[-1])
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "concat('s', id % 12) AS source",
        "concat_ws('\n', transform(sequence(1, 100), k -> concat('own line ', id, ' ', k)), concat('common line ', id % 35)) AS text")
    found = lines.remove_boilerplate(docs)
    assert found.agg(F.sum("n_removed")).first()[0] == 3000 - 35  # each of 35 lines, on 12 sites, stays once
    assert [(t.count(), len(t.inputFiles())) for t in tables] == [(35, 1), (35, 1)]


# 8

def test_bpe(docs, empty):
    library = Tokenizer.from_file(BPE_FILE)
    coded = bpe.encode(docs, BPE_FILE).select("doc_id", "text", "ids", "decoded").distinct()
    for r in bpe.digests(docs, BPE_FILE).join(coded, "doc_id").where("doc_id NOT IN (3, 7)").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
        assert r["ids"] == ids and r["decoded"] == library.decode(ids, skip_special_tokens=False)
    assert bpe.encode(docs, BPE_FILE).count() == bpe.digests(docs, BPE_FILE).count() == len(rows())
    assert bpe.digests(docs, BPE_FILE).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert bpe.encode(empty, BPE_FILE).count() == 0


def test_bpe_on_noise():
    own, library = bpe.WordEndBPE(open(BPE_FILE, encoding="utf-8").read()), Tokenizer.from_file(BPE_FILE)
    r = random.Random(1)
    texts = ["".join(r.choice("abcdefghij tttheeeiiinng'ssll\n\t.,!?é1239ÄöΣßあ\x85 \x1d") for _ in range(r.randrange(200))) for _ in range(400)]
    texts += ["aaaaaaaaaaaaaaaaa aaaa", "hellohello" * 50, "!!!!!!!!!!!!!!!!!?!?!?!?", "İstanbul Å é́ ́x", "٣٤ ५ x²y³", "<|endoftext|><|startoftext|>x"]
    for t, (ids, decoded) in zip(texts, own.encode(texts)):
        e = library.encode(t, add_special_tokens=False).ids
        assert ids.tolist() == e and decoded == library.decode(e, skip_special_tokens=False)


def test_bpe_merges_side_by_side(monkeypatch):
    own = bpe.WordEndBPE(open(BPE_FILE, encoding="utf-8").read())
    r = random.Random(2)
    words = [own.letters_of("".join(r.choice("aeinrstthé.日") for _ in range(r.randrange(1, 40)))) for _ in range(3000)]
    assert own.merge_all(words) == [own.merge(w) for w in words]
    assert own.merge_all([]) == []
    # Forgetting words changes nothing.
    text = " ".join(f"wort{i % 50} {i}" for i in range(3000))
    expected = own.encode([text])[0]
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    monkeypatch.setattr(bpe, "GROUP_WORDS", 10)
    again = bpe.WordEndBPE(open(BPE_FILE, encoding="utf-8").read(), decimal=True)
    for _ in range(2):
        assert again.encode(["x " + text[:100], text, text])[1:] == [(" ".join(map(str, expected[0].tolist())), expected[1])] * 2


# 9

def plain_spans(text):
    """(start, end, label, share) of every licence statement in a text, with whatever stands within a fuller one taken out."""
    w, found = words_of(text), []
    for label, t in licenses.TEMPLATES:
        need, reach = set(words_of(t)), math.ceil(len(words_of(t)) / licenses.SHARE)
        for s in range(len(w)):
            window = w[s:s + reach]
            got = need & set(window)
            if w[s] in need and len(got) >= math.ceil(len(need) * licenses.SHARE):
                found.append((s, s + max(window.index(x) for x in got), label, len(got) / len(need), need))
    return {m[:4] for m in found if not any(o[0] <= m[0] and o[1] >= m[1] and o[4] > m[4] for o in found)}


def test_licenses(docs, empty, spark):
    def plain_scan(text):
        w, places, base = words_of(text), [], set()
        for phrase, label in licenses.PHRASES:
            p = phrase.split()
            at = [i for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
            places += at
            base |= {label} if at else set()
        stated = plain_spans(text)
        labels, best = base | {m[2] for m in stated}, max((m[3] for m in stated), default=0.0)
        return (len(w), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), 1.0 if base else best)
    more = [(400 + i, f"x {t} y", None, None) for i, (_, t) in enumerate(licenses.TEMPLATES)] + [
        (450, "This program is free software: you can redistribute it and modify it under the terms of the GNU General License", None, None),
        (451, "licensed under apache license version", None, None), (452, "mit license MIT\nLicense", None, None)]
    given = rows() + more
    names = "doc_id n_words n_base first_word last_word base_labels labels score".split()
    assert spread(licenses.scan(frame(spark, given)), *names) == sorted(tuple(str(x) for x in (i, *plain_scan(t))) for i, t, _, _ in given)
    assert licenses.scan(empty).count() == 0


@pytest.mark.parametrize("template_bytes", [licenses.TEMPLATE_BYTES, 4096])
def test_license_statements_over_line_breaks(empty, spark, template_bytes, monkeypatch):
    monkeypatch.setattr(licenses, "TEMPLATE_BYTES", template_bytes)
    mit, bsd = (next(t for x, t in licenses.TEMPLATES if x == label and len(t) > 40) for label in ("mit", "bsd"))
    texts = {1: mit.replace("copy of", "copy\n# of"), 2: bsd.replace("without modification", "without\n * modification"),
             3: "Licensed under CC BY-NC 4.0", 4: "Licensed under CC BY 4.0", 5: "Licensed under\nCC BY 4.0. Photos: licensed under CC BY-NC 4.0",
             6: mit.replace("of charge", "of any charge").replace("software", "program"), 7: " and so on ".join(mit.split(" ")), 8: "", 9: None,
             10: f"{'mit licensed under by the of ' * 2000}{mit} {'cc by nc ' * 2000}", 11: " ".join(["word"] * 4090) + " " + bsd.replace(" ", "\n")}
    texts |= {100 + i: f"x {t} y" for i, (_, t) in enumerate(licenses.TEMPLATES)}
    given = frame(spark, [(i, t, None, None) for i, t in texts.items()])
    found = {i: set() for i in texts}
    for r in licenses.template_spans(given).collect():
        found[r["key"]["id"]].add((r["start"], r["end"], r["label"], r["containment"]))
    assert found == {i: plain_spans(t) for i, t in texts.items()}
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in licenses.scan(given).collect()}
    assert [labels[i] for i in (1, 2, 3, 4, 5)] == [("mit", 1.0), ("bsd", 1.0), ("cc-by-nc", 1.0), ("cc-by", 1.0), ("cc-by,cc-by-nc", 1.0)]
    assert labels[6][0] == "mit" and 0.9 <= labels[6][1] < 1 and labels[7] == ("", 0.0) and labels[11] == ("bsd", 1.0)
    assert licenses.template_spans(empty).count() == 0 and licenses.template_spans(given, templates=[("none", "...")]).count() == 0


def test_license_statements_are_of_every_document(spark, tmp_path):
    """Documents without a statement have their row, words, phrases and score as well."""
    texts = {1: "MIT License here", 2: "Licensed under\nCC BY 4.0. Photos: licensed under CC BY-NC 4.0", 3: "nothing", 4: None}
    frame(spark, [(i, t, None, None) for i, t in texts.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r.asDict() for r in queries.license_statements(spark, str(tmp_path)).collect()}
    op9 = {r["doc_id"]: r.asDict() for r in queries.op9_licenses(spark, str(tmp_path)).collect()}
    assert {i: {c: v for c, v in r.items() if c != "statements"} for i, r in got.items()} == op9 and set(got) == set(texts)
    assert got[1]["n_base"] == 1 and [got[i]["statements"] for i in (1, 3, 4)] == ["", "", ""]
    assert got[2]["statements"] == ",".join(f"{s}-{e} {x} {c}" for s, e, x, c in sorted(plain_spans(texts[2])))


# hot groups

def test_join_groups(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT", 3)
    rows_ = spark.createDataFrame([(k, i) for k, n in ((1, 7), (2, 3), (3, 1), (4, 9)) for i in range(n)], "k long, i long")
    groups = rows_.groupBy("k").agg(F.count("*").alias("n"))
    expected = sorted((k, i, n) for k, n in ((1, 7), (2, 3), (3, 1), (4, 9)) for i in range(n))
    for size in (1 << 20, 0):
        monkeypatch.setattr(common, "join_control", lambda *a, size=size: joins.join_control(*a, broadcast_bytes=size))
        found = common.join_groups(rows_, groups, ["k"], "n")
        assert sorted((r["k"], r["i"], r["n"]) for r in found.collect()) == expected
    assert common.join_groups(rows_.where("false"), groups.where("false"), ["k"], "n").count() == 0


# 10

def test_language(docs, empty, spark):
    named = spark.createDataFrame([(i, f"the house and the garden {i} of the king", "en") for i in range(20)]
                                  + [(100 + i, f"das haus und der garten {i} des königs", "de") for i in range(20)], "doc_id long, text string, lang string")
    profiles = language.fit(named)
    assert profiles.names == ["de", "en"]
    found = language.identify(docs, profiles).collect()
    assert len(found) == len(rows()) and all(0 <= r["score"] <= 1 and r["label"] == "x" for r in found)
    for r in found:
        if not any(c.isalpha() for c in r["text"] or ""):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
    tried = spark.createDataFrame([("THE KING and his house",), ("der könig und das haus",)], "text string")
    assert [r["lang_pred"] for r in language.identify(tried, profiles).collect()] == ["en", "de"]
    nothing = language.fit(empty)
    assert {r["lang_pred"] for r in language.identify(docs, nothing).collect()} == {"und"}
    assert language.identify(empty, profiles).count() == 0


def test_language_vectors_do_not_depend_on_what_is_kept(monkeypatch):
    text = "Größe und Maß, 日本語 — Ünïcode? ab a abc"
    usual = language.Letters(64).vector(text)
    monkeypatch.setattr(language, "KEPT_TRIPLES", 3)
    assert (language.Letters(64).vector(text) == usual).all()
    monkeypatch.setattr(language, "KEPT_ROWS", 4)
    assert (language.Letters(64).vector(text) == usual).all()
    assert language.Letters(64).vector("12 ...") is None and language.Letters(64).vector(None) is None
