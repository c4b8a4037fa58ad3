"""Conversation repair, outliers and spelling variants against plain versions."""

import hashlib
import heapq
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from docs import frame, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rowtide.llm import conversations, outliers, queries, spelling

SF_DIR = "/root/testdata/sf0.001"


# 11

def plain_search(kinds):
    """Uniform-cost search over (cost, audit): the first path to reach a node is its best."""
    heap, done = [(0, "", 0, "")], set()
    while True:
        cost, audit, i, last = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(kinds) and last in ("", "a"):
            return cost, audit
        follows = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", i, follows))
        if i == len(kinds):
            continue
        kind, extra = kinds[i].lower(), 3 if kinds[i].isupper() else 0
        heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last))
        if kind != "d":
            heapq.heappush(heap, (cost + extra + 3, audit + "R", i + 1, follows))
            if kind == follows or kind == "s" and last == "":
                heapq.heappush(heap, (cost + extra, audit + "K", i + 1, kind))


def plain_damage(rows_):
    out = []
    for conv, turn, role, text in rows_:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        if fate == 1:
            text = ""
        if fate == 2:
            text = re.sub("[.!?]", "", text)
        if fate == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if fate == 3 else 1)
    return out


def plain_repair(rows_):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, digest) of the sorted rows of one conversation."""
    order = sorted(rows_, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    turns, seen, faults, kinds = [r[1] for r in order if r[1] is not None], set(), Counter(), ""
    for _, _, role, text in order:
        bare = re.sub(r"[\x20\x09-\x0D]+$", "", text)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        if not bare:
            faults["blank"] += 1
            kinds += "d"
        elif (role, text) in seen:
            faults["duplicate"] += 1
            kinds += "d"
        elif bare[-1] not in ".!?":
            faults["truncated"] += 1
            kinds += initial.upper()
        else:
            kinds += initial
        seen.add((role, text))
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(order, order[1:]))
    cost, audit = plain_search(kinds)
    made, left = [], list(order)
    for letter in audit:
        role, text = left.pop(0)[2:] if letter != "I" else (None, "")
        if letter in "RI":
            role = "assistant" if made and made[-1][0][0] == "u" else "user"
        if letter != "D":
            made.append((role, text))
    assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in made))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults["blank"], faults["duplicate"], faults["truncated"],
            illegal, cost, audit, digest)


def test_search():
    r = random.Random(11)
    for _ in range(5000):
        kinds = "".join(r.choice("duuaaasxUASX") for _ in range(r.randrange(12)))
        assert conversations.search(kinds) == plain_search(kinds)
    long = "".join(r.choice("uauauadxUA") for _ in range(5000))
    assert conversations.search(long) == plain_search(long)


CLASHING = ["gone", "kind", "digest", "audit", "numbers", "initial", "fault", "_fate", "_copy", "cost"]
TALK = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
                     T.StructField("text", T.StringType())] + [T.StructField(c, T.StringType()) for c in CLASHING])


def talk(spark, given):
    return spark.createDataFrame([r + ("x",) * len(CLASHING) for r in given], TALK)


def talks():
    r = random.Random(3)
    out = []
    for conv in range(150):
        for turn in range(r.randrange(9)):
            text = r.choice(["Yes.", "No!", "What", "", " \n\t", "Was? \n", "é日🙂.", "A. b", f"own {conv} {turn}."])
            out.append((conv, turn * r.choice([1, 1, 1, 2]), r.choice(["user", "assistant", "user", "assistant", "system", "tool", ""]), text))
    big = 2**60 + 1
    out += [(big, i, "ua"[i % 2] + "x", f"long {i}. " * (3000 if i % 50 == 0 else 1)) for i in range(300)]
    out += [(None, 1, "user", "a."), (None, None, "assistant", "b."), (7, None, None, None), (7, None, None, None), (8, 3, None, "x."),
            (9, None, "user", "q."), (9, 1, "user", "q."), (9, 1, "user", "q."), (9, 1, "assistant", "other.")]
    return out


def test_conversations(spark):
    given = talks()
    expected = defaultdict(list, {conv: [] for conv, *_ in given})
    for row in plain_damage(given):
        expected[row[0]].append(row)
    damaged = conversations.damaged(talk(spark, given).repartition(3))
    found = conversations.repair(damaged)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = {r[0]: tuple(r[1:]) for r in found.collect()}
    assert got == {conv: plain_repair(r) for conv, r in expected.items()}
    assert (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got.values()
    # The repaired rows themselves.
    made = conversations.repaired(damaged, conversations.reports(damaged)).orderBy("place").collect()
    texts = defaultdict(list)
    for r in made:
        texts[r["conv_id"]].append(f"{r['role']}:{r['text']}")
    assert {c: hashlib.sha256("\n".join(t).encode()).hexdigest() for c, t in texts.items()} == {c: g[-1] for c, g in got.items() if c in texts}


def test_no_conversations(spark):
    assert conversations.repair(conversations.damaged(talk(spark, []))).count() == 0


def test_conversation_query(spark):
    table = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    expected = defaultdict(list, {r["conv_id"]: [] for r in table.collect()})
    for row in plain_damage([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]):
        expected[row[0]].append(row)
    got = {r[0]: tuple(r[1:]) for r in queries.op11_conversations(spark, SF_DIR).collect()}
    assert got == {conv: plain_repair(r) for conv, r in expected.items()}


# 12

def plain_statistics(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    hit, windows = set(), defaultdict(list)
    for i in range(len(words) - 4):
        windows[tuple(words[i:i + 5])].append(i)
    for places in windows.values():
        if len(places) > 1:
            hit.update(p + k for p in places for k in range(5))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, symbols = len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or "")
    dup, repeat = len(lines) - len(set(lines)), len(hit)
    failed = n < 10 or 100 * repeat > 20 * n
    m = max(n, 1)
    x = [math.log(m), math.log(max(chars, 1) / m), math.sqrt(symbols / max(chars, symbols, 1)), math.sqrt(dup / max(len(lines), 1)), math.sqrt(repeat / m)]
    return (n, chars, symbols, dup, repeat, failed), [int(1000 * v + 0.5) for v in x]


def plain_distances(x, steps, share):
    """Squared distances of rows of whole numbers from their least-determinant estimate."""
    x, p = np.array(x, float), 5
    floor, n = np.diag([float(f) ** 2 for f in outliers.FLOORS]), len(x)
    at = lambda s, v: np.sort(v)[math.ceil(s * n) - 1]
    middle = np.array([at(0.5, x[:, i]) for i in range(p)])
    wide = np.array([(at(0.75, x[:, i]) - at(0.25, x[:, i])) / 1.349 for i in range(p)])
    soft = np.sqrt(wide ** 2 + np.diag(floor))
    z = (x - middle) / soft
    length = (z ** 2).sum(1)
    unit = np.where(length[:, None] > 0, z / np.sqrt(np.where(length > 0, length, 1))[:, None], 0)
    begun = [(middle, np.diag(wide ** 2)), (x.mean(0), np.cov(x.T, bias=True)), (middle, p * (unit.T @ unit) / n * np.outer(soft, soft))]
    best = None
    for centre, cov in begun:
        for _ in range(steps):
            d = np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(cov + floor), x - centre)
            bins = np.floor(outliers.BINS * np.log(1 + np.maximum(d, 0)))
            near = x[bins <= at(share, bins)]
            centre, cov = near.mean(0), np.cov(near.T, bias=True)
        det = np.linalg.slogdet(cov + floor)[1]
        if best is None or det < best[0] - 1e-9:
            best = det, np.einsum("ni,ij,nj->n", x - centre, np.linalg.inv(cov + floor), x - centre)
    return best[1] / outliers.CONSISTENCY


def plain_verdicts(given, least_rows, steps=outliers.STEPS):
    counted = [(i, lang or "", source or "", *plain_statistics(text)) for i, text, lang, source in given]
    groups = defaultdict(list)
    for k, (_, lang, source, base, x) in enumerate(counted):
        if not base[-1]:
            groups[lang, source].append((k, x))
    far = {}
    for members in groups.values():
        if len(members) >= least_rows:
            far.update(zip((k for k, _ in members), plain_distances([x for _, x in members], steps, outliers.SHARE)))
    return [(i, base, far.get(k)) for k, (i, _, _, base, _) in enumerate(counted)]


def some_texts(r, n):
    def text():
        words = ["".join(r.choice("aeiounst") for _ in range(r.randrange(2, 8))) for _ in range(r.randrange(8, 120))]
        if r.random() < 0.1:
            words = [w + r.choice(["%%%", "###", "<|>"]) for w in words]
        if r.random() < 0.2:
            words += words[:6]
        if r.random() < 0.05:
            words = [w * 6 for w in words]
        return "".join(w + r.choice("   \n") for w in words)
    return [(i, text(), r.choice(["en", "de", None]), r.choice(["a", "a", "b"])) for i in range(n)]


def same_verdicts(found, expected):
    def line(doc, base, far):
        return str(doc), base, None if far is None else round(far, 3)
    got = sorted((line(r["doc_id"], (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]), r["distance"])
                  for r in found), key=str)
    want = sorted((line(*e) for e in expected), key=str)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    for (*_, a), (*_, b) in zip(got, want):
        assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-4, abs=2e-3))
    for r in found:
        assert r["kept"] == (not r["base_failed"] and (r["distance"] or 0) <= outliers.FARTHEST)


def test_outliers(spark):
    given = some_texts(random.Random(12), 700) + rows()
    found = outliers.verdicts(frame(spark, given).repartition(3), least_rows=5).collect()
    same_verdicts(found, plain_verdicts(given, 5))
    assert sum(not r["kept"] and not r["base_failed"] for r in found) > 0


def test_no_outliers_without_texts(spark):
    assert outliers.verdicts(frame(spark, [])).count() == 0
    alone = outliers.verdicts(frame(spark, [(1, "a b " * 3, None, None), (2, None, "en", "x")])).orderBy("doc_id").collect()
    assert [(r["base_failed"], r["kept"], r["distance"]) for r in alone] == [(True, False, None)] * 2


def test_outlier_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang", "source").collect()
    expected = {e[0]: e for e in plain_verdicts([tuple(r) for r in docs], outliers.LEAST_ROWS)}
    for r in queries.op12_outliers(spark, SF_DIR).collect():
        _, base, far = expected[r["doc_id"]]
        assert tuple(r)[1:7] == base
        assert r["kept"] == (not base[-1] and (far is None or far <= outliers.FARTHEST))


# 13

def plain_vocabulary(given, damaged):
    counts = Counter()
    for i, text in given:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[A-Za-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if damaged and h % damaged == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def plain_variants(vocabulary):
    near, holes = defaultdict(set), defaultdict(set)
    for w in vocabulary:
        for i in range(len(w)):
            holes[w[:i] + "?" + w[i + 1:]].add(w)
            short = w[:i] + w[i + 1:]
            if short in vocabulary:
                near[w].add(short)
                near[short].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in vocabulary.items():
        best = min(near[w], key=lambda x: (-vocabulary[x], x), default=None)
        form[w] = best if best and vocabulary[best] >= 10 * n else None
    out = []
    for w, n in vocabulary.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), vocabulary.get(form[w])))
    return sorted(out, key=str)


def variants_of(found):
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_near_pairs():
    def one(x, y):
        x, y = sorted((x, y), key=len)
        if len(x) == len(y):
            return sum(a != b for a, b in zip(x, y)) == 1
        return any(y[:i] + y[i + 1:] == x for i in range(len(y)))

    r = random.Random(13)
    for t in range(300):
        size = r.choice([2, 3, 5, 7])
        words = sorted({"".join(r.choice("abé"[:2 + t % 2]) for _ in range(size + r.randrange(2))) for _ in range(40)})
        pairs = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words))
                 if min(len(words[i]), len(words[j])) == size and one(words[i], words[j])]
        assert sorted(spelling.near_pairs(words, size, 0, size + 1)) == pairs


def spelled():
    r = random.Random(5)
    base = ["".join(r.choice("abcdeé") for _ in range(r.randrange(6, 12))) for _ in range(60)]
    out = [(i, " ".join(r.choice(base[:1 + r.randrange(60)]) for _ in range(60))) for i in range(150)]
    for i in range(60):
        w = list(r.choice(base))
        at = r.randrange(len(w))
        w[at:at + 1] = r.choice([[], ["x"], [w[at], "Y"]])
        out.append((None if i % 7 == 0 else 200 + i, ("".join(w) + "-") * r.randrange(1, 4)))
    # A chain of three forms, and words that share all but one letter.
    out += [(900 + k, " ".join([w] * n)) for k, (w, n) in enumerate([("chainedaaa", 2), ("chainedaa", 20), ("chaineda", 200), ("chained", 2000)])]
    out += [(950, " ".join(f"samewordhere{c}" for c in "abcdefghijklmnopqrstuvwxyz" * 2)), (951, "ΣSTRASSEÀÉ×÷ straße\x00straße")]
    return out


@pytest.mark.parametrize("most_words", [50_000, 3])
def test_spelling(spark, most_words):
    given = spelled() + [(i, t) for i, t, *_ in rows()]
    df = frame(spark, [(i, t, None, None) for i, t in given]).repartition(3)
    assert variants_of(spelling.variants(df, most_words=most_words)) == plain_variants(plain_vocabulary(given, 31))


def test_spelling_without_words(spark):
    assert spelling.variants(frame(spark, [])).count() == 0
    assert spelling.variants(frame(spark, [(1, None, None, None), (2, "", None, None), (3, "short once longword", None, None)])).count() == 0


def test_spelling_query(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert variants_of(queries.op13_spelling(spark, SF_DIR)) == plain_variants(plain_vocabulary([tuple(r) for r in docs], 31))
