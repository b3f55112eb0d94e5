"""Table checks: keys, constraints, one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Primary keys and constraints of the stored tables.
PRIMARY_KEYS = {
    "user_features": ("user_id", "event_timestamp"),
    "transaction_features": ("transaction_id",),
    "labeled_transactions": ("transaction_id",),
}
CONSTRAINTS = {
    "user_features": {
        "user_id not null": "user_id is not null",
        "event_timestamp not null": "event_timestamp is not null",
    },
    "transaction_features": {
        "transaction_id not null": "transaction_id is not null",
        "user_id not null": "user_id is not null",
        "event_timestamp not null": "event_timestamp is not null",
    },
    "labeled_transactions": {
        "transaction_id not null": "transaction_id is not null",
        "user_id not null": "user_id is not null",
        "label not null": "label is not null",
        "label in (0, 1)": "label is null or label in (0, 1)",
        "event_timestamp not null": "event_timestamp is not null",
    },
}


def check_primary_key(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """K7: the keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def latest_by_key(df: DataFrame, keys: tuple[str, ...], recency: tuple[str, ...]) -> DataFrame:
    """K7: one row per key, the greatest by the ``recency`` expressions.

    An aggregate, not a ranking: every map task sends one row per key, so a key with most of the rows costs no more
    than another.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*[F.expr(e) for e in recency]))
    return df.groupBy(*keys).agg(newest.alias("_row")).select(*keys, "_row.*")


def check_constraints(df: DataFrame, rules: dict[str, str]) -> DataFrame:
    """K8: (rule, violations) for every SQL predicate, in one pass. A predicate that is null counts as violated."""
    broken = [F.count_if(~F.coalesce(F.expr(rule), F.lit(False))).alias(f"_{i}") for i, rule in enumerate(rules.values())]
    rows = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"_{i}").alias("violations")) for i, name in enumerate(rules)
    ])
    return df.agg(*broken).select(F.inline(rows))


def with_created_at(df: DataFrame, at=None) -> DataFrame:
    """K9: load time, now unless given."""
    return df.withColumn("created_at", F.current_timestamp() if at is None else F.lit(at).cast("timestamp"))
