"""Repairs the structure of conversations by depth-first branch and bound.

A repaired conversation has no rows, or a system row or none and then user and
assistant rows in turn, the last one of an assistant. Rows are kept (K), given
another role (R) or deleted (D), and empty rows are inserted (I); each edit has a
cost. Of all repairs the cheapest counts, of equal ones that whose letters in order
(the audit) come first in ASCII.

A node of the search is a place in the rows and the role that came last. Its suffix
bound is the least cost of what follows, worked out backwards over costs alone. The
search keeps an explicit stack, takes letters in ASCII order, and leaves a node whose
cost and bound, or whose letters, cannot beat the incumbent (cost, audit), or that
an earlier prefix reached at no greater cost: two prefixes of one node and one cost
differ before either ends, so the earlier one stays ahead whatever follows.

A conversation is read as a stream of sorted rows: first narrow ones (place, initial
of the role, fault) for the search, then, headed by its audit, the texts. So a task
holds a few numbers per row of one conversation, never its texts.
"""

import hashlib
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from rowtide.session import written

SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3  # costs
BLANK, DUPLICATE, CUT_OFF = 1, 2, 3  # faults

# States are what came last: nothing, a system row, a user row, an assistant row.
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}, "x": {}}
NEXT, NEXT_ROLE = (2, 2, 3, 2), ("user", "user", "assistant", "user")
CACHED_ROWS = 64  # conversations up to this length are remembered by their pattern


def damaged(df, conv_col="conv_id", turn_col="turn", role_col="role", text_col="text"):
    """Rows (conv_id, turn, role, text, gone): one in twenty is dropped (`gone`), emptied, loses its sentence
    ends, comes twice, or is given to the user, by the checksum of its place. Nulls are one space, but for
    conv_id and turn themselves; further columns are not returned."""
    place = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col)]
    rows = df.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col), F.lit(" ")).alias("role"), F.coalesce(F.col(text_col), F.lit(" ")).alias("text"),
                     (F.crc32(F.concat_ws(":", *place).cast("binary")) % 20).alias("_fate"))
    fate = F.col("_fate")
    text = F.when(fate == 1, "").when(fate == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    rows = rows.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
                       (fate == 0).alias("gone"), "_fate")
    return rows.withColumn("_copy", F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_fate", "_copy")


def marked(rows):
    """Narrow rows (conv_id, turn, role, digest, gone, initial, fault); a row's first fault counts."""
    bare = F.rtrim("text", F.lit(SPACE))
    narrow = rows.select(
        "conv_id", "turn", "role", "gone", _digest().alias("digest"), F.substring("role", 1, 1).alias("initial"),
        F.when(bare == "", BLANK).when(~F.substring(bare, -1, 1).isin(".", "!", "?"), CUT_OFF).otherwise(0).alias("fault"))
    # Equal rows of a conversation: all but the first are duplicates. One exchange serves this and the search.
    equal = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    again = ~F.col("gone") & (F.col("fault") != BLANK) & (F.row_number().over(equal) > 1)
    return narrow.repartition("conv_id").withColumn("fault", F.when(again, DUPLICATE).otherwise(F.col("fault")))


def _digest():
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def bounds(kinds):
    """Per place and state: the least cost of what follows."""
    out = [(0, 2 * INSERT, INSERT, 0)]
    for kind in reversed(kinds):
        h, extra = out[-1], TRUNCATED if kind.isupper() else 0
        row = [DELETE + x for x in h]
        if kind != "d":
            for q, to in enumerate(NEXT):
                row[q] = min(row[q], REROLE + extra + h[to])
            for q, to in AFTER[kind.lower()].items():
                row[q] = min(row[q], extra + h[to])
        row[2] = min(row[2], INSERT + row[3])
        out.append((min(row[0], INSERT + row[2]), min(row[1], INSERT + row[2]), row[2], min(row[3], INSERT + row[2])))
    out.reverse()
    return out


def edits(kind, q):
    """(letter, cost, rows taken, next state) of the edits a node allows, in ASCII order."""
    if kind:
        yield "D", DELETE, 1, q
    yield "I", INSERT, 0, NEXT[q]
    if kind and kind != "d":
        extra = TRUNCATED if kind.isupper() else 0
        if q in AFTER[kind.lower()]:
            yield "K", extra, 1, AFTER[kind.lower()][q]
        yield "R", REROLE + extra, 1, NEXT[q]


def first_dive(kinds, bound):
    """A whole repair to start from: at each node the edit of the least cost and bound."""
    i = q = cost = 0
    audit = []
    while i < len(kinds) or q not in (0, 3):
        letter, c, taken, to = min(edits(kinds[i:i + 1], q), key=lambda e: (e[1] + bound[i + e[2]][e[3]], e[0]))
        audit.append(letter)
        i, q, cost = i + taken, to, cost + c
    return cost, audit


def search(kinds):
    """(cost, audit) of the best repair. `kinds` has a letter per row: s, u, a or x for the role, upper case if
    the text is truncated; d if the row must go."""
    n, bound = len(kinds), bounds(kinds)
    best_cost, best = first_dive(kinds, bound)
    path, same = [], 0  # letters of the node; how many of them the incumbent shares at the start
    reached = {}  # (place, state) -> the least cost of a prefix
    stack = [(0, "", 0, 0, 0)]
    while stack:
        depth, letter, i, q, cost = stack.pop()
        if depth:
            del path[depth - 1:]
            path.append(letter)
            same = min(same, depth - 1)
            if same == depth - 1 and best[same:depth] == [letter]:
                same = depth
        least = cost + bound[i][q]
        behind = same < depth and (same >= len(best) or path[same] > best[same])
        if least > best_cost or least == best_cost and behind or reached.get((i, q), cost + 1) <= cost:
            continue
        reached[i, q] = cost
        if i == n and q in (0, 3):
            best_cost, best, same = cost, path[:], len(path)
            continue
        for letter, c, taken, to in reversed(list(edits(kinds[i:i + 1], q))):
            if cost + c + bound[i + taken][to] <= best_cost:
                stack.append((depth + 1, letter, i + taken, to, cost + c))
    return best_cost, "".join(best)


_remembered = lru_cache(maxsize=100_000)(search)


def cheapest(kinds):
    return _remembered(kinds) if len(kinds) <= CACHED_ROWS else search(kinds)


def _records(batches):
    """Rows of a stream of record batches as tuples; ids stay exact beside nulls."""
    for batch in batches:
        yield from zip(*[column.to_pylist() for column in batch.columns])


def _out(schema, rows, size=2000):
    """Record batches of a stream of tuples."""
    schema, held = to_arrow_schema(schema), []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


def _sorted(rows, *first):
    return rows.sortWithinPartitions("conv_id", *first, F.col("turn").asc_nulls_first(), "role", "digest")


def reports(rows):
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit), one per conversation, of rows
    (conv_id, turn, role, text, gone).

    Rows are taken by turn, nulls first; of one turn by role and then by the text's digest. `gone` rows
    count for nothing but keep their conversation; one without other rows has zeros and an empty audit. Ids that
    are null are one conversation. Texts of any length take part by their digest. An empty table gives none.
    """
    schema = T.StructType([rows.schema["conv_id"]] + [T.StructField(c, T.LongType()) for c in NUMBERS] + [T.StructField("audit", T.StringType())])

    def report(conv, group):
        turns, low, high, last, faults, illegal, before, kinds = 0, None, None, None, [0] * 4, 0, None, []
        for _, turn, gone, initial, fault in group:
            if gone:
                continue
            if turn is not None and turn != last:
                low, high, last, turns = turn if low is None else low, turn, turn, turns + 1
            faults[fault] += 1
            if before is not None and before + initial not in ("su", "ua", "au"):
                illegal += 1
            before = initial
            role = initial if initial in ("s", "u", "a") else "x"
            kinds.append("d" if fault in (BLANK, DUPLICATE) else role.upper() if fault == CUT_OFF else role)
        cost, audit = cheapest("".join(kinds))
        return conv, high - low + 1 - turns if turns else 0, *faults[1:], illegal, cost, audit

    def run(batches):
        yield from _out(schema, (report(conv, group) for conv, group in groupby(_records(batches), key=lambda r: r[0])))

    return _sorted(marked(rows)).select("conv_id", "turn", "gone", "initial", "fault").mapInArrow(run, schema)


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _repairs(batches):
    """(conv_id, audit, numbers, rows) of a stream in which each conversation's report comes before its rows;
    the repaired rows are (role, text)."""
    def apply(audit, group):
        q = 0
        for letter in audit:
            role, text = next(group)[3:] if letter != "I" else (None, "")
            if letter == "D":
                continue
            if letter == "K":
                q = AFTER[role[0]][q]
            else:
                role, q = NEXT_ROLE[q], NEXT[q]
            yield role, text

    for conv, group in groupby(_records(batches), key=lambda r: r[0]):
        _, audit, numbers, _, _ = next(group)
        yield conv, audit, numbers, apply(audit, group)


def _headed(rows, found):
    """Texts of the rows that are not gone, sorted, each conversation headed by its report."""
    kinds = {"turn": "long", "role": "string", "digest": "binary", "text": "string", "audit": "string", "numbers": "array<long>"}

    def lines(df, kind, columns):
        return df.select("conv_id", F.lit(kind).alias("kind"), *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in kinds.items()])

    heads = lines(found, 0, {"audit": F.col("audit"), "numbers": F.array(*NUMBERS)})
    texts = lines(rows.where(~F.col("gone")), 1, {"turn": F.col("turn"), "role": F.col("role"), "text": F.col("text"), "digest": _digest()})
    return _sorted(heads.unionByName(texts).repartition("conv_id"), "kind").select("conv_id", "audit", "numbers", "role", "text")


def repaired(rows, found):
    """Rows (conv_id, place, role, text) of the repaired conversations, `place` from 0; `found` are their `reports`."""
    schema = T.StructType([rows.schema["conv_id"], T.StructField("place", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType())])

    def run(batches):
        yield from _out(schema, ((conv, i, role, text) for conv, _, _, repair in _repairs(batches) for i, (role, text) in enumerate(repair)))

    return _headed(rows, found).mapInArrow(run, schema)


def with_digests(rows, found):
    """The reports with `repaired_sha256`: of the repaired rows as `role:text`, joined by line breaks, read as they stream by."""
    schema = T.StructType([*found.schema.fields, T.StructField("repaired_sha256", T.StringType())])

    def digest(repair):
        total = hashlib.sha256()
        for i, (role, text) in enumerate(repair):
            total.update(("\n" * (i > 0) + role + ":" + text).encode())
        return total.hexdigest()

    def run(batches):
        yield from _out(schema, ((conv, *numbers, audit, digest(repair)) for conv, audit, numbers, repair in _repairs(batches)))

    return _headed(rows, found).mapInArrow(run, schema)


def repair(rows):
    """The `reports` of all conversations with the digest of what they are repaired to."""
    return with_digests(rows, written(rows.sparkSession, reports(rows)))
