"""The feature store as plain Parquet tables.

Online table: ``<path>/batch_id=N/``, one row per entity and batch, written whole or replaced whole, so a replayed
batch changes nothing. The current value of an entity is the greatest row over all batches; compaction folds them.
Offline table: ``<path>/batch_id=N/event_date=D/``, every version of every feature row.
With a list of commits, a batch counts in both tables from the moment it is listed, and in none before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardpulse.functions.scalars import feature_json, feature_key, time_text, ttl_of
from cardpulse.functions.times import micros
from cardpulse.operators.commits import commit_batch, committed_batches, unbroken
from cardpulse.operators.quality import latest_by_key
from cardpulse.operators.skew import lookup_join
from cardpulse.schema import ONLINE_VIEWS, USER_FEATURES, FeatureView


def _moment(value) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("timestamp")


def online_rows(df: DataFrame, view: FeatureView, written_at=None, slide: str | None = None) -> DataFrame:
    """The current row of each entity in ``df`` with ``written_at`` and ``expires_at`` (now unless given).

    ``slide`` is the one ``df``'s windows were made with. A window whose newest event lies further back than one slide
    is not the first to end after it, hence never current; with the slide known such rows go before the aggregation,
    all but one in (length / slide).
    """
    written = F.current_timestamp() if written_at is None else _moment(written_at)
    if slide is not None:
        end = "window_end" if "window_end" in df.columns else "event_timestamp"
        df = df.where(F.unix_micros(end) - F.unix_micros("last_event_time") <= micros(slide))
    return (
        latest_by_key(df, view.entity, view.recency)
        .withColumn("written_at", written)
        .withColumn("expires_at", F.col("written_at") + F.make_dt_interval(secs=F.lit(view.ttl_seconds)))
    )


def write_online(
    df: DataFrame, view: FeatureView, path: str, batch_id: int, written_at=None, slide: str | None = None,
    files: int | None = None,
) -> None:
    """Upsert the current value of each entity in ``df``. Calling it again with the same batch and the same
    ``written_at`` changes nothing; without ``written_at`` a replay restarts the TTL.

    One table belongs to one sequence of batch ids: a query started on a new checkpoint needs a new path. ``files``
    gathers the batch into that many files; streaming runs without adaptive execution, and would write one per shuffle
    partition.
    """
    rows = online_rows(df, view, written_at, slide)
    if files is not None:
        rows = rows.repartition(files, *view.entity)
    writer = rows.write.mode("overwrite")
    for name in view.entity:  # lets a lookup of a few entities skip row groups
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(f"{path.rstrip('/')}/batch_id={int(batch_id)}")


def _read_batches(spark: SparkSession, paths, commits: str | None = None, after: int | None = None) -> DataFrame:
    """Rows of one or several tables; ``batch_id`` orders the batches of a table, ``_table`` the tables. ``commits``
    lists the batches of the last table that count; others are not opened.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    tables = [
        spark.read.parquet(p)
        .withColumn("batch_id", F.col("batch_id").cast("bigint"))
        .withColumn("_table", F.lit(i))
        for i, p in enumerate(paths)
    ]
    if commits is not None:
        tables[-1] = tables[-1].where(F.col("batch_id").isin(committed_batches(spark, commits, after)))
    out = tables[0]
    for table in tables[1:]:
        out = out.unionByName(table)
    return out


def read_online(
    spark: SparkSession, view: FeatureView, paths, as_of=None, folded_up_to: int | None = None,
    commits: str | None = None,
) -> DataFrame:
    """The live value of every entity at ``as_of`` (now unless given).

    ``paths`` may list a compacted table followed by the one of the running query. ``folded_up_to`` is the last batch
    of the running table that the compacted one holds (see :func:`last_batch`): older ones are neither read nor counted.
    With ``commits``, only batches listed there count (see :func:`push_features`).
    """
    return _live_rows(spark, view, paths, as_of, folded_up_to, commits)


def _live_rows(spark, view, paths, as_of, folded_up_to, commits, upto: int | None = None) -> DataFrame:
    """``upto`` is the last batch of the running table to count."""
    at = F.current_timestamp() if as_of is None else _moment(as_of)
    rows = _read_batches(spark, paths, commits, folded_up_to)
    last = 0 if isinstance(paths, str) else len(list(paths)) - 1
    if folded_up_to is not None:
        rows = rows.where((F.col("_table") < last) | (F.col("batch_id") > folded_up_to))
    if upto is not None:
        rows = rows.where((F.col("_table") < last) | (F.col("batch_id") <= upto))
    current = latest_by_key(rows, view.entity, (*view.recency, "_table", "batch_id"))
    return current.where(at < F.col("expires_at")).drop("_table")


def last_batch(spark: SparkSession, path: str) -> int:
    """The number of a running table's newest batch, read from its folders' names; -1 without any."""
    newest = spark.read.parquet(path).select(F.max(F.col("batch_id").cast("bigint"))).first()[0]
    return -1 if newest is None else newest


def compact_online(
    spark: SparkSession, view: FeatureView, paths, target: str, as_of=None, folded_up_to: int | None = None,
    commits: str | None = None,
) -> int:
    """Fold all batches into one at a *new* path, dropping expired entities; rows end up clustered by entity, so
    that lookups read few row groups. Returns the last batch of the running table (the last of ``paths``) that is in
    it: give it to :func:`read_online` and to the next compaction as ``folded_up_to``, and to
    :func:`expired_batches` to learn what can be removed. With ``commits``, batches are folded up to the first one that is
    not listed: it may still be pushed again.
    """
    listed = [paths] if isinstance(paths, str) else list(paths)
    if target in listed:
        raise ValueError("compaction needs a new target path")
    if commits is None:
        upto = last_batch(spark, listed[-1])
    else:
        done = -1 if folded_up_to is None else folded_up_to
        upto = unbroken(committed_batches(spark, commits, folded_up_to), done)
    live = _live_rows(spark, view, listed, as_of, folded_up_to, commits, upto).drop("batch_id")
    writer = live.repartitionByRange(*view.entity).sortWithinPartitions(*view.entity).write.mode("errorifexists")
    for name in view.entity:
        writer = writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
    writer.parquet(f"{target.rstrip('/')}/batch_id=0")
    return upto


def expired_batches(
    spark: SparkSession, path: str, as_of=None, folded_up_to: int | None = None
) -> DataFrame:
    """Batches of a running table that no read needs any more: (batch_id, folder, reason). Those up to
    ``folded_up_to`` are in the compacted table; of the others, those all of whose values have expired. Removing the
    folders is left to whoever owns the storage.
    """
    at = F.current_timestamp() if as_of is None else _moment(as_of)
    batches = _read_batches(spark, path).groupBy("batch_id").agg(F.max("expires_at").alias("_until"))
    folded = F.lit(False) if folded_up_to is None else F.col("batch_id") <= folded_up_to
    return batches.withColumn("reason", F.when(folded, "folded").when(F.col("_until") <= at, "expired")).where(
        "reason is not null").select(
        "batch_id", F.concat(F.lit(f"{path.rstrip('/')}/batch_id="), F.col("batch_id").cast("string")).alias("folder"),
        "reason")


def write_offline(df: DataFrame, path: str, batch_id: int) -> str:
    """One batch of the offline history, written whole or replaced whole; returns its folder."""
    folder = f"{path.rstrip('/')}/batch_id={int(batch_id)}"
    dated = df.withColumn("event_date", F.to_date("event_timestamp"))
    dated.write.mode("overwrite").partitionBy("event_date").parquet(folder)
    return folder


def push_features(
    df: DataFrame, view: FeatureView, online_path: str, offline_path: str, batch_id: int, written_at=None,
    slide: str | None = None, files: int | None = None, commits: str | None = None,
) -> None:
    """A10: keep feature rows in the offline history and their newest values online.

    ``df`` carries ``event_timestamp``, the time the values became known (a window's end, a transaction's own time),
    never the time of the push. It is computed once: the online values are taken from the history just written.

    With ``commits`` both writes are one: the batch is listed there last, and readers given the same list take listed
    batches only. After a crash between the writes neither table shows the batch, and pushing it again shows it once in
    both; a batch already listed is left untouched.
    """
    spark = df.sparkSession
    if commits is not None and batch_id in committed_batches(spark, commits, batch_id - 1):
        return
    folder = write_offline(df, offline_path, batch_id)
    kept = spark.read.schema(df.schema).parquet(folder).select(*df.columns)
    write_online(kept, view, online_path, batch_id, written_at, slide, files)
    if commits is not None:
        commit_batch(spark, commits, batch_id)


def read_offline(
    spark: SparkSession, view: FeatureView, paths, start=None, end=None, commits: str | None = None,
) -> DataFrame:
    """The history with one row per (entity, event_timestamp): the version of the latest batch. ``start`` and ``end``
    (both inclusive) keep the read to the dates, and then the rows, of a range. With ``commits``, only batches listed
    there count.
    """
    rows = _read_batches(spark, paths, commits)
    if start is not None:
        rows = rows.where((F.col("event_date") >= F.to_date(_moment(start))) & (F.col("event_timestamp") >= _moment(start)))
    if end is not None:
        rows = rows.where((F.col("event_date") <= F.to_date(_moment(end))) & (F.col("event_timestamp") <= _moment(end)))
    keys = (*view.entity, "event_timestamp")
    return latest_by_key(rows, keys, ("_table", "batch_id")).drop("_table", "batch_id")


def get_online_features(
    requests: DataFrame,
    lookups: list[tuple[FeatureView, DataFrame, tuple[str, ...] | None]],
    spread: int = 1,
) -> DataFrame:
    """C4: add named features to each request row; null where an entity is unknown or expired.

    Each lookup is (view, live rows, columns or None for all). Live rows are unique per entity, so requests are
    never multiplied. ``spread`` is for streams, see :func:`cardpulse.operators.skew.lookup_join`.
    """
    out = requests
    for view, live, columns in lookups:
        facts = live.select(*view.entity, *(columns or view.names))
        out = lookup_join(out, facts, list(view.entity), spread)
    return out


def multi_get(live: DataFrame, view: FeatureView, entities: DataFrame, spread: int = 1) -> DataFrame:
    """The JSON value of each listed entity under its key, null where there is none; one row per listed one."""
    (entity,) = view.entity
    values = live.select(entity, feature_json(*view.names).alias("value"))
    return lookup_join(entities, values, [entity], spread).select(
        *entities.columns, feature_key(view.name, entity).alias("key"), "value")


def get_one(live: DataFrame, view: FeatureView, entity_id: str) -> DataFrame:
    """The features of one entity; no row if it has none. The equality reaches the Parquet scan."""
    (entity,) = view.entity
    return live.where(F.col(entity) == entity_id).select(entity, *view.names)


def from_json_value(df: DataFrame, view: FeatureView, value: str = "value") -> DataFrame:
    """Unpack a JSON value into the view's columns."""
    layout = ", ".join(f"{name} {kind}" for name, kind in view.columns)
    return df.withColumn("_v", F.from_json(value, T.StructType.fromDDL(layout))).select(
        *df.columns, *[F.col(f"_v.{name}").alias(name) for name in view.names])


def key_values(df: DataFrame, view: FeatureView) -> DataFrame:
    """The current values as (key, value, ttl_seconds, known_at), for any external key-value writer; ``known_at`` is the
    time of the value as text.
    """
    (entity,) = view.entity
    at = next(c for c in ("window_end", "event_timestamp", "event_time") if c in df.columns)
    return latest_by_key(df, view.entity, view.recency).select(
        feature_key(view.name, entity).alias("key"),
        feature_json(*view.names).alias("value"),
        ttl_of(F.lit(view.name)).alias("ttl_seconds"),
        time_text(at).alias("known_at"),
    )


# Names of the online values in a user's wide row.
_WIDE_NAMES = {
    "tx_5min": {"total_tx": "tx_last_5min_total", "approved_tx": "tx_last_5min_approved",
                "failed_tx": "tx_last_5min_failed"},
    "avg_amount_24h": {"avg_amount": "avg_amount_24h", "stddev_amount": "stddev_amount_24h"},
    "velocity": {"velocity_score": "velocity_score"},
    "device_change": {"distinct_devices": "distinct_devices_24h", "device_change_flag": "device_change_flag"},
    "failed_attempts": {"failed_count": "failed_attempts_30min", "hard_block": "hard_block"},
}


def online_user_features(spark: SparkSession, paths: dict[str, str], as_of=None) -> DataFrame:
    """K1 online: one wide row per user from the five online tables (view name to path), each value live by its own
    TTL, null where it is not. Every user with a live value has a row; one shuffle serves all five.
    """
    out = None
    for name, renamed in _WIDE_NAMES.items():
        live = read_online(spark, ONLINE_VIEWS[name], paths[name], as_of).select(
            "user_id", *[F.col(old).alias(new) for old, new in renamed.items()])
        out = live if out is None else out.unionByName(live, allowMissingColumns=True)
    return out.groupBy("user_id").agg(*[F.max(c).alias(c) for c in USER_FEATURES.names])
