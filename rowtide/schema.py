"""Column contracts shared by every operator."""

import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

CELL = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("value", T.StringType()),
])
IMAGE = T.ArrayType(CELL)

# One line per row event, images still positional. A line of kind COMMIT closes
# its transaction (sid, tx_id); its file and position are those of the commit.
COMMIT = "commit"
EVENTS_RAW = T.StructType([
    T.StructField("sid", T.IntegerType()),
    T.StructField("db", T.StringType()),
    T.StructField("tb", T.StringType()),
    T.StructField("event", T.StringType()),
    T.StructField("file", T.StringType()),
    T.StructField("pos", T.LongType()),
    T.StructField("event_time", T.LongType()),
    T.StructField("tx_id", T.LongType()),
    T.StructField("event_ord", T.LongType()),
    T.StructField("is_snapshot", T.BooleanType()),
    T.StructField("table_columns", T.ArrayType(T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("type", T.StringType()),
    ]))),
    T.StructField("rows", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("query", T.StringType()),
])

# The same with the tables a statement changes, for feeds that list them.
EVENTS_CHANGED = T.StructType(EVENTS_RAW.fields + [
    T.StructField("changed", T.ArrayType(T.StructType([
        T.StructField("db", T.StringType()),
        T.StructField("tb", T.StringType()),
    ]))),
])

# Kind of what a topic delivered that is no event.
UNREADABLE = "unreadable"

_INT, _STR = T.IntegerType(), T.StringType()

# Rule table. The numbers and names of the first group follow the metadata
# table users already have; target_* and message_* carry the same meaning.
RULES = T.StructType([
    T.StructField("id", _INT),
    T.StructField("sid", _INT),
    T.StructField("db", _STR),
    T.StructField("tb", _STR),
    T.StructField("refresh_type", _INT),
    T.StructField("is_dump", _INT),
    T.StructField("is_compress", _INT),
    T.StructField("compress_level", _INT),
    T.StructField("compress_columns", _STR),
    T.StructField("expire_time", _INT),
    T.StructField("expire_range", _INT),
    T.StructField("is_full_column", _INT),
    T.StructField("replic_columns", _STR),
    T.StructField("target_key_prefix", _STR),
    T.StructField("target_key_columns", _STR),
    T.StructField("target_key_type", _STR),
    T.StructField("target_zset_score_column", _STR),
    T.StructField("filter_rule", _STR),
    T.StructField("operation", _INT),
    T.StructField("message_key_columns", _STR),
    T.StructField("message_topic_rule", _STR),
    T.StructField("delay_del", _INT),
    T.StructField("delay_expire_time", _INT),
    T.StructField("message_is_full_column", _INT),
    T.StructField("message_replic_columns", _STR),
])

# The defaults of the rule table.
RULE_DEFAULTS = {
    "refresh_type": 1,
    "is_dump": 0,
    "is_compress": 0,
    "compress_level": -1,
    "compress_columns": "",
    "expire_time": 3600,
    "expire_range": 0,
    "is_full_column": 1,
    "replic_columns": "",
    "target_key_prefix": "",
    "target_key_columns": "",
    "target_key_type": "",
    "target_zset_score_column": "",
    "filter_rule": "",
    "operation": 0,
    "message_key_columns": "",
    "message_topic_rule": "",
    "delay_del": 0,
    "delay_expire_time": 3600,
    "message_is_full_column": 1,
    "message_replic_columns": "",
}

# Operation codes of the rule table.
OP_ACTIVE, OP_ADD, OP_DROP = 0, 3, 4

# Target types and compression modes.
TARGET_TYPES = ["string", "hash", "set", "zset"]
GZIP, GZIP_BASE64, SNAPPY, SNAPPY_BASE64 = 1, 2, 3, 4

# Total order of commands. `seg` separates the log before, the rows of, and
# the log after a table resync; it is 0 where no resync took place.
ORDER = ["seg", "file", "pos", "event_ord", "phase", "row_ord", "rule_id"]
# Order of changes (no phase and rule yet).
CHANGE_ORDER = ["seg", "file", "pos", "event_ord", "row_ord"]
# A block is a run of the order that is bounded in size whatever the key.
BLOCK = ["seg", "file", "blk"]
# Servers have keys, and an order, of their own.
KEY = ["sid", "target_type", "target_key"]


def with_defaults(rules):
    """Rules with the table's defaults in place of NULL."""
    fill = {c: v for c, v in RULE_DEFAULTS.items() if c in rules.columns}
    return rules.fillna(fill)


def rules_df(spark, rows):
    """Rule DataFrame from dicts; missing columns take the table's defaults."""
    full = [{**RULE_DEFAULTS, **r} for r in rows]
    return spark.createDataFrame(pa.Table.from_pylist(full, schema=to_arrow_schema(RULES)), RULES)
