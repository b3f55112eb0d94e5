"""Joins in which one key may hold a third of all rows.

A batch join is left to adaptive execution, which splits large partitions at run time (``create_session`` asks for it
even where that costs a shuffle). Where the engine cannot split, on a stream or below a window, ``spread`` does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_NO_KEY_SHARES = 1024
# A key with more rows than this is busy.
FULL = 8192


def busy_keys(rows: DataFrame, keys: list[str], full: int = FULL) -> DataFrame:
    """The keys that more than ``full`` rows have; at most one for every ``full`` rows, hence few."""
    return rows.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > full).select(*keys)


def spread_keys(
    rows: DataFrame, facts: DataFrame, keys: list[str], digest: Column, spread: int = 1, busy: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Add ``_share`` to both sides so that meeting on (keys, _share) is meeting on keys, in ``spread`` shares a key.

    Each row takes the share its ``digest`` falls into, which is the same when a task is repeated, and each fact is copied
    to all shares. A row without key meets nothing and may go anywhere. All keys are treated alike, unless ``busy`` lists
    those to deal out (see :func:`busy_keys`): then the facts of the others are not copied.
    """
    keyless = F.lit(False)
    for name in keys:
        keyless = keyless | F.col(name).isNull()
    shares = F.lit(spread)
    if busy is not None and spread > 1:
        # Broadcast: a shuffle by the keys alone would leave a busy key in one task again.
        listed = F.broadcast(busy.withColumn("_busy", F.lit(True)))
        rows, facts = rows.join(listed, keys, "left"), facts.join(listed, keys, "left")
        shares = F.when(F.col("_busy"), spread).otherwise(1)
    rows = rows.withColumn("_share", F.pmod(
        digest, F.when(keyless, _NO_KEY_SHARES).otherwise(shares)).cast("int")).drop("_busy")
    if spread == 1:
        return rows, facts.withColumn("_share", F.lit(0))
    return rows, facts.withColumn("_share", F.explode(F.sequence(F.lit(0), shares - 1))).drop("_busy")


def row_digest(df: DataFrame, names: tuple[str, ...] = (), prefix: str = "") -> Column:
    """Hash of the columns ``names`` or else of a row's strings and whole numbers. Other columns can differ in the last
    bit when a task is repeated, and the row would move to another share.
    """
    stable = ("string", "bigint", "int", "smallint", "tinyint", "timestamp", "date")
    chosen = names or [f.name for f in df.schema.fields if f.dataType.simpleString() in stable]
    return F.xxhash64(*[prefix + name for name in chosen])


def lookup_join(rows: DataFrame, facts: DataFrame, keys: list[str], spread: int = 1) -> DataFrame:
    """Left join with a side that has at most one row per key.

    ``spread`` deals every key out over that many shares and copies the facts as often. A batch needs none; give it for
    a stream whose busiest key is too much for one task and whose facts are too large to broadcast.
    """
    if spread == 1:
        return rows.join(facts, keys, "left")
    left, right = spread_keys(rows, facts, keys, row_digest(rows), spread)
    joined = left.join(right, [*keys, "_share"], "left")
    return joined.select(*rows.columns, *[c for c in facts.columns if c not in keys])
