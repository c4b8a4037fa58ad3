"""ALTER statements of monitored tables, online-schema-change copies included."""

from pyspark.sql import functions as F

from rowtide.functions.joins import join_control

SHADOW_SUFFIX = "_new"


def resolve_shadow(changed, monitored):
    """Map changed tables (columns sid, db, changed_tb, ...) to monitored ones.

    `db._tb_new` with any number of underscores is the working copy of `db.tb`.
    The possible originals of a name are few (one per leading underscore), so
    they are listed and looked up by equality. An exact match wins; several
    shadow matches are settled by the shortest strip.
    """
    name = F.col("changed_tb")
    stem = F.substr(name, F.lit(1), F.length(name) - len(SHADOW_SUFFIX))
    lead = F.length(stem) - F.length(F.regexp_replace(stem, "^_+", ""))
    shadow = F.when(
        name.endswith(SHADOW_SUFFIX) & (F.length(stem) > 0),
        F.transform(F.sequence(F.lit(0), lead), lambda k: F.struct(
            F.substr(stem, k + 1).alias("tb"), (k + 1).alias("strip"))))
    exact = F.array(F.struct(name.alias("tb"), F.lit(0).alias("strip")))
    options = changed.withColumn("_o", F.explode(F.concat(exact, F.coalesce(shadow, F.array().cast(
        "array<struct<tb:string,strip:int>>"))))).select("*", "_o.tb", "_o.strip").drop("_o")
    tables = monitored.select("sid", "db", "tb").distinct()
    found = join_control(options, tables, ["sid", "db", "tb"])
    line = [c for c in changed.columns]
    return (found.groupBy(*line).agg(F.min(F.struct("strip", "tb")).alias("_m"))
            .select(*line, F.col("_m.tb").alias("tb"), (F.col("_m.strip") > 0).alias("is_shadow")))


def replace_first(text, old, new):
    at = F.instr(text, old)
    return F.when(at > 0, F.concat(
        F.substr(text, F.lit(1), at - 1), new, F.substr(text, at + F.length(old)))).otherwise(text)


def alter_statements(statements):
    """Statements whose first word is ALTER or alter as written."""
    first_word = F.split_part("query", F.lit(" "), F.lit(1))
    return statements.where(first_word.isin("ALTER", "alter") & F.col("query").contains(" "))


def published_statements(events, monitored):
    """The `query` events that consumers get: ALTER statements of monitored tables.

    With the list of changed tables that is `alter_feed`. Events without it, as
    `alter_feed` makes them, carry the database of a monitored table.
    """
    statements = events.where(F.col("event") == "query")
    listed = None
    if "changed" in events.columns:
        listed = alter_feed(statements.where(F.col("changed").isNotNull()), monitored)
        statements = statements.where(F.col("changed").isNull()).drop("changed")
    databases = monitored.select("sid", "db").distinct()
    rest = join_control(alter_statements(statements), databases, ["sid", "db"], "left_semi")
    return rest if listed is None else rest.unionByName(listed, allowMissingColumns=True)


def alter_feed(statements, monitored, supported=True):
    """`query` events of ALTER statements that change a monitored table.

    `statements`: sid, file, pos, event_ord, query, changed ARRAY<STRUCT<db,tb>>.
    The first word must be ALTER or alter as written. The event goes to the
    database of the first changed table; if a changed table is a working copy,
    the first mention of the last such copy is replaced by that table's name.
    """
    if not supported:
        statements = statements.limit(0)
    alters = alter_statements(statements)
    ids = ["sid", "file", "pos", "event_ord", "query"]
    changed = alters.select(*ids, F.posexplode("changed").alias("at", "c")).select(
        *ids, "at", "c.db", F.col("c.tb").alias("changed_tb"))
    hits = resolve_shadow(changed, monitored)
    per_statement = hits.groupBy(*ids).agg(
        F.min(F.struct("at", "db", "tb")).alias("_first"),
        F.max(F.when(F.col("is_shadow"), F.struct("at", "changed_tb"))).alias("_copy"))
    text = F.when(F.col("_copy").isNull(), F.col("query")).otherwise(
        replace_first(F.col("query"), F.col("_copy.changed_tb"), F.col("_first.tb")))
    return per_statement.select(
        "sid", F.col("_first.db").alias("db"), F.lit("").alias("tb"), F.lit("query").alias("event"),
        "file", "pos", F.lit(0).cast("bigint").alias("event_time"), "event_ord", text.alias("query"))
