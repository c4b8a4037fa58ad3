"""Joins of a large side with a control table."""

from pyspark.sql import functions as F

# What the small side may weigh, as JSON text, to be sent to all tasks.
BROADCAST_BYTES = 32 << 20
SALTS = 32


def join_control(big, small, on, how="inner", broadcast_bytes=BROADCAST_BYTES, salts=SALTS):
    """Join `big` with a table that is small in any sane installation.

    The size is checked: up to `broadcast_bytes` the small side is broadcast.
    Beyond that both sides are shuffled, and as one key may hold a
    large part of `big`, its rows are spread over `salts` copies of the small
    side.
    """
    weight = small.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0
    if weight <= broadcast_bytes:
        return big.join(F.broadcast(small), on, how)
    return join_salted(big, small, on, how, salts)


def join_salted(big, small, on, how="inner", salts=SALTS, spread=None):
    """Equi-join with the rows of a hot key of `big` spread over `salts` tasks.

    `spread` names columns that differ among the rows of a key; by default all
    scalar columns are used.
    """
    if spread is None:
        spread = [f.name for f in big.schema.fields
                  if f.dataType.typeName() not in ("map", "array", "struct", "variant")]
    salted = big.withColumn("_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, list(on) + ["_salt"], how).drop("_salt")
