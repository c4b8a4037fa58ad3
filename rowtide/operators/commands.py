"""From changes and rules to key-value commands in a total order."""

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control
from rowtide.functions.text import cells_of, image_json, joined_texts, texts
from rowtide.operators.rules import TABLE, compile_rules
from rowtide.operators.normalize import ROW_EVENTS
from rowtide.schema import COMMIT, ORDER, UNREADABLE

# A block of the order: 16 MB of log, or a million snapshot rows.
LOG_BLOCK = 1 << 24
SNAPSHOT_BLOCK = 1 << 20
PLACE = ["sid", "db", "tb", "seg", "file", "pos", "event_ord", "row_ord"]


def fan_out(changes, rules):
    """Each change once per rule of its table, with the compiled rule. Cell texts
    are worked out before the rules multiply the rows."""
    changes = changes.withColumns({f"{c}_texts": F.expr(texts(c)) for c in ("after", "before")})
    return join_control(changes, compile_rules(rules), TABLE)


# The helpers below give SQL text over the columns of a fanned-out change; `side`
# is "after" or "before".

def passes(side):
    """No taking-part clause names a cell whose text differs. Clauses on columns
    the row does not have are ignored."""
    return f"NOT exists(clauses, f -> exists({side}_texts, x -> x.name = f.name AND x.text <> f.value))"


def key_text(side):
    return joined_texts(f"{side}_texts", "key_names")


def target_key(side):
    """prefix:v1:v2 for string and hash; the prefix alone for set and zset, or
    when no key column has text."""
    key = f"CASE WHEN target_type NOT IN ('set', 'zset') THEN {key_text(side)} ELSE '' END"
    return f"concat_ws(':', prefix, nullif({key}, ''))"


def payload(side, decimal_as="string"):
    return image_json(side, "json_names", decimal_as, heads="json_heads")


def hash_fields(side):
    cells = f"{side}_texts"
    kept = f"CASE WHEN kept_names IS NULL THEN {cells} ELSE {cells_of(cells, 'array_distinct(kept_names)')} END"
    return (f"transform({kept}, hf -> struct(hf.name AS field, hf.text AS value, "
            f"CASE WHEN array_contains(enc_names, hf.name) THEN enc ELSE 0 END AS enc))")


def score_of(side):
    """Number in the score column; NULL if the column is absent or no number."""
    return f"try_cast(try_element_at(filter({side}, s -> s.name = score_name), 1).value AS double)"


def ttl():
    """Seconds to live with jitter that depends on the row only, so a replay
    sets the same deadline."""
    place = ", ".join(["target_type", "prefix"] + [c for c in ORDER if c != "phase"])
    return f"ttl_low + CASE WHEN ttl_span > 0 THEN pmod(xxhash64({place}), ttl_span) ELSE 0 END"


_FIELDS = "array<struct<field:string,value:string,enc:int>>"
_SCORED, _KEYED = "target_type IN ('set', 'zset')", "target_type IN ('string', 'hash')"



def _commands(decimal_as):
    """Array of the commands of one change under one rule."""
    # The change itself.
    main = f"""named_struct(
      'phase', 1,
      'op', CASE WHEN invalidate THEN 'DEL' WHEN event <> 'delete' THEN 'WRITE' WHEN {_SCORED} THEN 'REMOVE'
                 WHEN delayed THEN 'EXPIRE' ELSE 'DEL' END,
      'target_key', {target_key('after')},
      'value', CASE WHEN NOT invalidate AND ({_SCORED} OR target_type = 'string' AND event <> 'delete')
                    THEN {payload('after', decimal_as)} END,
      'fields', CASE WHEN NOT invalidate AND target_type = 'hash' AND event <> 'delete'
                     THEN {hash_fields('after')} END,
      'score', CASE WHEN NOT invalidate AND target_type = 'zset' AND event <> 'delete'
                    THEN {score_of('after')} END,
      'ttl', CASE WHEN invalidate THEN NULL WHEN event <> 'delete' OR {_SCORED} THEN {ttl()}
                  WHEN delayed THEN delay_ttl END,
      'reason', rule_error)"""

    # What the old image of an update leaves behind. All clean-ups of an event
    # come before its writes.
    moved = f"""({key_text('before')} <> {key_text('after')}
      OR exists(clauses, f -> exists(before_texts, x -> x.name = f.name)
         AND NOT exists(after_texts, x -> x.name = f.name AND x.text = f.value)))"""
    clean = f"""named_struct(
      'phase', 0, 'op', CASE WHEN {_SCORED} THEN 'REMOVE' ELSE 'DEL' END, 'target_key', {target_key('before')},
      'value', CASE WHEN {_SCORED} THEN {payload('before', decimal_as)} END, 'fields', CAST(NULL AS {_FIELDS}),
      'score', CAST(NULL AS double), 'ttl', CAST(NULL AS bigint), 'reason', rule_error)"""
    return f"""array_compact(array(
      CASE WHEN event = 'update' AND {passes('before')} AND ({_SCORED} OR {_KEYED} AND {moved}) THEN {clean} END,
      CASE WHEN {passes('after')} THEN {main} END))"""


_REASON = """CASE WHEN reason IS NOT NULL THEN reason WHEN t IS NULL THEN 'no time' WHEN op <> 'WRITE' THEN NULL
  WHEN target_type = 'zset' AND score IS NULL THEN 'no score'
  WHEN target_type = 'hash' AND size(fields) = 0 THEN 'empty hash' END"""


def generate(changes, rules, snapshot_time=None, decimal_as="string",
             log_block=LOG_BLOCK, snapshot_block=SNAPSHOT_BLOCK):
    """All commands of all changes under all rules of their tables; those a
    server would refuse carry a reason.

    `snapshot_time` is when the snapshot rows count as written; without it, or
    without the time of a log event, no expiry can be told and the command
    carries the reason "no time"."""
    df = fan_out(changes.withColumn("is_snapshot", F.coalesce("is_snapshot", F.lit(False))), rules)
    snapshot_time = "NULL" if snapshot_time is None else int(snapshot_time)
    return df.selectExpr(
        "sid", "seg", "file", "pos", "event_ord", "row_ord", "rule_id", "db", "tb",
        # Blocks are stretches of the order. Rows that lie among log events, at a
        # position of their own segment's log, are cut as the log is.
        f"CASE WHEN is_snapshot AND (file = '' OR seg % 2 = 1) THEN event_ord div {snapshot_block} "
        f"ELSE pos div {log_block} END AS blk",
        f"CASE WHEN is_snapshot THEN bigint({snapshot_time}) ELSE event_time END AS t",
        "target_type", "enc", "enc_level", f"inline({_commands(decimal_as)})",
    ).withColumn("reason", F.expr(_REASON))


def accepted(generated):
    """Commands in their final form.

    op is WRITE (ttl set), REMOVE (one member; with a ttl it also renews the
    key), EXPIRE or DEL. Sorting by ORDER gives the sequence a server would see.
    """
    return generated.where(F.col("reason").isNull()).drop("reason", "db", "tb")


def refused(generated):
    return generated.where(F.col("reason").isNotNull()).select(*PLACE, "rule_id", "reason")


def without_rule(changes, rules):
    """Changes of tables nobody asked for."""
    return join_control(changes, rules.select(*TABLE).distinct(), TABLE, "left_anti").select(
        *PLACE, F.lit(None).cast("int").alias("rule_id"), F.lit("no rule").alias("reason"))


def malformed(events):
    """Row events that no change, or not every change, can be made of: text that
    is no event, no image, or the odd image of an update."""
    n, kind = F.coalesce(F.size("rows"), F.lit(0)), F.col("event")
    reason = (F.when(kind.isNull() | ~kind.isin(*ROW_EVENTS, "query", COMMIT), UNREADABLE)
              .when(kind.isin("query", COMMIT), F.lit(None)).when(n <= 0, "no image")
              .when((kind == "update") & (n % 2 == 1), "odd image"))
    if "seg" not in events.columns:
        events = events.withColumn("seg", F.lit(0).cast("bigint"))
    return events.withColumn("reason", reason).where("reason IS NOT NULL").select(
        *[F.lit(0).alias(c) if c == "row_ord" else F.col(c) for c in PLACE], F.lit(None).cast("int").alias("rule_id"), "reason")


def kv_commands(changes, rules, **how):
    """Commands of all changes; refused ones are left out, see `dead_letters`."""
    return accepted(generate(changes, rules, **how))


def dead_letters(changes, rules, **how):
    """Changes that cannot be applied: tables without a rule and refused commands."""
    return without_rule(changes, rules).unionByName(refused(generate(changes, rules, **how)))


def invalidations(commands):
    """Distinct keys to drop from a cache."""
    return commands.where(F.col("op") == "DEL").select("target_key").distinct()
