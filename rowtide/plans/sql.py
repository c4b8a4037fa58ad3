"""Pieces of the SQL the registered queries are checked against."""

from rowtide.plans.feeds import (LINEITEM_SQL, ORDERS_SQL, RULE_TABLE_SQL, STATEMENTS_SQL, STATUS_SQL,
                                 USER_STATE_SQL)

PARTS = {"a": USER_STATE_SQL, "b": ORDERS_SQL, "c": LINEITEM_SQL, "r": RULE_TABLE_SQL,
         "d": STATEMENTS_SQL, "m": STATUS_SQL}


def with_feeds(names, body, *more):
    """A query over the named feeds; `more` are further WITH parts."""
    return "WITH " + ",\n".join([PARTS[n] for n in names] + list(more)) + "\n" + body


def quoted(col):
    """JSON string of a text column."""
    text = col
    for old, new in [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"),
                     ("<", "\\u003c"), (">", "\\u003e"), ("&", "\\u0026")]:
        old = f"chr({ord(old)})" if ord(old) < 32 else f"'{old}'"
        text = f"replace({text}, {old}, '{new}')"
    return f"('\"' || {text} || '\"')"


def user_json(prefix=""):
    """JSON payload of a user_state image, keys sorted."""
    c = lambda n: f"{prefix}{n}"
    return (f"('{{\"cents\":' || {c('cents')} || ',\"props\":' || {quoted(c('props'))} || "
            f"',\"status\":' || {quoted(c('status'))} || ',\"user_id\":' || user_id || '}}')")


MEMBER = "('{\"user_id\":' || user_id || '}')"

AS_OF = "(SELECT max(floor(epoch(ts))::BIGINT) FROM events)"

# Commands of the rules on user_state, as (rule, SELECT list by phase).
_BASE = "event_id, file, pos, event_ord, t"


def _cmd(rule, phase, kind, key, op, where, ttl="NULL", value="NULL", fields="NULL", score="NULL"):
    return (f"SELECT {rule} AS rule_id, {phase} AS phase, {_BASE}, '{kind}' AS target_type, {key} AS key, "
            f"{op} AS op, ({ttl})::BIGINT AS ttl, {value} AS value, {fields}::VARCHAR[] AS fields, "
            f"({score})::BIGINT AS score FROM a WHERE {where}")


def user_commands(*rules):
    """`cmd` CTE: commands of the given rules on user_state, numbered in order."""
    del_op = "CASE WHEN kind = 'delete' THEN 'DEL' ELSE 'WRITE' END"
    lists = {
        1: [_cmd(1, 1, "string", "'us:' || user_id", del_op, "true",
                 "CASE WHEN kind <> 'delete' THEN 3600 END",
                 f"CASE WHEN kind <> 'delete' THEN {user_json()} END")],
        2: [_cmd(2, 1, "hash", "'uh:' || user_id", "CASE WHEN kind = 'delete' THEN 'EXPIRE' ELSE 'WRITE' END",
                 "true", "CASE WHEN kind = 'delete' THEN 3600 ELSE 28800 END",
                 fields="CASE WHEN kind <> 'delete' THEN ['status=' || status, 'user_id=' || user_id] END")],
        12: [_cmd(12, 1, "hash", "'uh:' || user_id", "CASE WHEN kind = 'delete' THEN 'EXPIRE' ELSE 'WRITE' END",
                  "status = 'purchase'", "CASE WHEN kind = 'delete' THEN 3600 ELSE 28800 END",
                  fields="CASE WHEN kind <> 'delete' THEN ['cents=' || cents] END"),
             _cmd(12, 0, "hash", "'uh:' || user_id", "'DEL'",
                  "kind = 'update' AND b_status = 'purchase' AND status <> 'purchase'")],
        3: [_cmd(3, 1, "set", "'active'", "CASE WHEN kind = 'delete' THEN 'REMOVE' ELSE 'WRITE' END",
                 "status = 'purchase'", "3600", MEMBER),
            _cmd(3, 0, "set", "'active'", "'REMOVE'", "kind = 'update' AND b_status = 'purchase'", value=MEMBER)],
        4: [_cmd(4, 1, "zset", "'spend'", "CASE WHEN kind = 'delete' THEN 'REMOVE' ELSE 'WRITE' END",
                 "true", "3600", MEMBER, score="CASE WHEN kind <> 'delete' THEN cents END"),
            _cmd(4, 0, "zset", "'spend'", "'REMOVE'", "kind = 'update'", value=MEMBER)],
        5: [_cmd(5, 1, "string", "'bystatus:' || status || ':' || user_id", del_op, "true",
                 "CASE WHEN kind <> 'delete' THEN 86400 END",
                 f"CASE WHEN kind <> 'delete' THEN {user_json()} END"),
            _cmd(5, 0, "string", "'bystatus:' || b_status || ':' || user_id", "'DEL'",
                 "kind = 'update' AND b_status <> status")],
        # The rule is one for strings; what it drops are hashes. Of an update, the old image counts too.
        15: [_cmd(15, 1, "hash", "'uh:' || user_id", "'DEL'", "status = 'signup'"),
             _cmd(15, 0, "hash", "'uh:' || user_id", "'DEL'", "kind = 'update' AND b_status = 'signup' AND status <> 'signup'")],
        6: [_cmd(6, 1, "string", "'inv:' || user_id", "'DEL'", "true")],
    }
    lists[10] = [q.replace("SELECT 1 AS rule_id", "SELECT 10 AS rule_id") for q in lists[1]]
    union = "\n  UNION ALL ".join(q for r in rules for q in lists[r])
    return ("cmd AS (SELECT *, row_number() OVER (ORDER BY file, pos, event_ord, phase, rule_id) AS o FROM (\n  "
            + union + "))")


# The fold stated with whole-key windows.
LIFE = """
k1 AS (SELECT *, max(t) OVER (PARTITION BY key ORDER BY o) AS te FROM cmd),
k2 AS (SELECT *, sum(CASE WHEN op = 'WRITE' THEN 1 ELSE 0 END) OVER (PARTITION BY key ORDER BY o) AS run,
              te + ttl AS dl FROM k1),
k3 AS (SELECT *, last_value(dl IGNORE NULLS) OVER (PARTITION BY key, run ORDER BY o
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pdl,
              last_value(dl IGNORE NULLS) OVER (PARTITION BY key, run ORDER BY o
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cdl FROM k2),
k4 AS (SELECT *, max(CASE WHEN run = 0 OR op = 'DEL' OR (op <> 'WRITE' AND te >= pdl) THEN 1 ELSE 0 END)
              OVER (PARTITION BY key, run ORDER BY o) AS broken FROM k3),
runs AS (SELECT key, target_type, run, min(o) AS o, arg_min(te, o) AS t0, arg_max(broken, o) AS broken,
                arg_max(cdl, o) AS dl FROM k4 GROUP BY ALL),
starts AS (SELECT *, run > 0 AND (lag(run) OVER w IS NULL OR lag(run) OVER w = 0 OR lag(broken) OVER w = 1
                  OR t0 >= lag(dl) OVER w) AS fresh FROM runs WINDOW w AS (PARTITION BY key ORDER BY run)),
life AS (SELECT key, target_type, max(CASE WHEN fresh THEN o END) AS epoch, arg_max(broken, run) AS broken,
                arg_max(dl, run) AS dl FROM starts WHERE run > 0 GROUP BY ALL)"""


def alive(as_of=AS_OF):
    return f"alive AS (SELECT * FROM life WHERE broken = 0 AND dl > {as_of})"


STRING_ITEMS = """SELECT l.key AS key, arg_max(c.value, c.o) AS value, any_value(l.dl) AS expires_at
FROM alive l JOIN cmd c ON c.key = l.key AND c.op = 'WRITE' GROUP BY l.key"""

HASH_ITEMS = """SELECT l.key AS key, c.f[1] AS field, arg_max(c.f[2], c.o) AS value, any_value(l.dl) AS expires_at
FROM alive l JOIN (SELECT key, o, string_split(unnest(fields), '=') AS f FROM cmd WHERE op = 'WRITE') c
  ON c.key = l.key AND c.o >= l.epoch GROUP BY l.key, c.f[1]"""

MEMBER_ITEMS = """SELECT key, member{score}, dl AS expires_at FROM (
  SELECT l.key, c.value AS member, arg_max(c.op, c.o) AS op, arg_max(c.score, c.o) AS score, any_value(l.dl) AS dl
  FROM alive l JOIN cmd c ON c.key = l.key AND c.o >= l.epoch AND c.value IS NOT NULL GROUP BY l.key, c.value)
WHERE op = 'WRITE'"""
