"""Features of a stream from panes: no copy of an event for each window, no state in the engine, late rows corrected.

Each micro-batch is folded to panes, one row per key and slide step, and written whole under its number. The windows of
the users that it touched are then built from their panes of all batches, by the code of the batch form. Counts and
moments of one pane from several batches merge, and distinct members are counted from their own panes, so a batch that is
repeated replaces itself and the order of batches doesn't matter.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import gcd

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cardpulse.functions.times import micros
from cardpulse.operators import features, windows
from cardpulse.operators.store import write_online
from cardpulse.schema import ONLINE_VIEWS, FeatureView

_DAY_US = 86_400_000_000


@dataclass(frozen=True)
class PaneFeature:
    """A feature that panes suffice for. ``fold`` makes panes of a batch, ``merge`` one pane of those of several batches,
    ``windows`` the feature's rows of merged panes. ``pane_us`` is a pane's length, ``reach`` how many of them the longest
    window spans; ``member`` names a column that panes are kept by beside the user.
    """

    view: FeatureView
    slide: str
    pane_us: int
    reach: int
    fold: Callable[[DataFrame], DataFrame]
    merge: Callable[[DataFrame], DataFrame]
    windows: Callable[[DataFrame], DataFrame]
    member: str | None = None


def _counted(view: str, tallies: list[windows.Tally], slide: str, columns: Callable[[DataFrame], DataFrame]) -> PaneFeature:
    pane_us = gcd(micros(slide), *[micros(t.length) for t in tallies])
    return PaneFeature(
        ONLINE_VIEWS[view], slide, pane_us, windows.pane_reach(tallies, slide),
        lambda tx: windows.fold_panes(tx, tallies, slide),
        lambda panes: windows.merge_panes(panes, tallies, slide),
        lambda panes: columns(windows.tallies_of_panes(panes, tallies, slide)))


def amounts_feature(amount: str = "amount", length: str = "24 hours", slide: str = "1 hour") -> PaneFeature:
    """a pane holds the number, sum, spread, least and greatest of its approved amounts."""
    pane_us = gcd(micros(length), micros(slide))
    return PaneFeature(
        ONLINE_VIEWS["avg_amount_24h"], slide, pane_us, micros(length) // pane_us,
        lambda tx: windows.fold_amounts(tx.where(features.APPROVED), length, slide, amount),
        windows.merge_amounts,
        lambda panes: windows.amounts_of_panes(panes, length, slide))


def devices_feature(length: str = "24 hours", slide: str = "1 hour") -> PaneFeature:
    """panes of a user and device; no set of devices is ever built."""
    pane_us = gcd(micros(length), micros(slide))
    return PaneFeature(
        ONLINE_VIEWS["device_change"], slide, pane_us, micros(length) // pane_us,
        lambda tx: windows.fold_members(tx, "device_id", length, slide),
        lambda panes: windows.merge_members(panes, "device_id"),
        lambda panes: features.devices_of(windows.distinct_of_panes(panes, "device_id", length, slide, "distinct_devices")),
        member="device_id")


PANE_FEATURES = {
    "f01": _counted("tx_5min", features.count_tallies(), "1 minute", lambda counts: counts),
    "f02": amounts_feature(),
    "f04": _counted("velocity", features.velocity_tallies(), "1 minute", features.velocity_of),
    "f05": devices_feature(),
    "f06": _counted("failed_attempts", features.failure_tallies(), "5 minutes", features.failures_of),
}


class PaneStore:
    """Panes below ``root``, by level, block and day. Block N of level 0 is micro-batch N; a block of level L holds the
    merged panes of ``every`` blocks of the level below, up to ``levels``.

    Which blocks cover all batches up to one follows from its number alone: at most ``every`` - 1 a level and those of
    the top level. Days let a reader leave out what lies before its oldest pane, so what a batch reads does not grow
    with the number of batches before it. Blocks are replaced whole, and a replayed batch does not see later ones. Blocks
    that a higher level holds, and days behind the longest window and delay, may be deleted.
    """

    def __init__(self, root: str, feature: PaneFeature, every: int = 8, levels: int = 3):
        self.root, self.feature, self.every, self.levels = root.rstrip("/"), feature, every, levels

    def _path(self, level: int, block: int) -> str:
        return f"{self.root}/level={level}/block={block}"

    def blocks(self, batch_id: int) -> list[tuple[int, int]]:
        """(level, block) of those that hold batches 0 to ``batch_id``, each once."""
        out, start, left = [], 0, batch_id + 1
        for level in range(self.levels, -1, -1):
            size = self.every ** level
            count = left // size
            out += [(level, start // size + i) for i in range(count)]
            start, left = start + count * size, left - count * size
        return out

    def _write(self, panes: DataFrame, level: int, block: int) -> None:
        day = F.floor(F.col("_pane") * self.feature.pane_us / _DAY_US).cast("bigint")
        panes.withColumn("pane_day", day).write.mode("overwrite").partitionBy("pane_day").parquet(self._path(level, block))

    def _read(self, spark: SparkSession, schema: StructType, blocks: list[tuple[int, int]]) -> DataFrame:
        layout = StructType([*schema.fields, StructField("pane_day", LongType())])
        rows = spark.read.schema(layout).option("basePath", self.root).parquet(*[self._path(*b) for b in blocks])
        return rows.select(*layout.names)

    def add(self, panes: DataFrame, batch_id: int) -> DataFrame:
        """Write a batch's panes, and the blocks that it completes; returns the batch's panes as written."""
        spark, schema = panes.sparkSession, panes.schema
        self._write(panes, 0, batch_id)
        block = batch_id
        for level in range(1, self.levels + 1):
            if (block + 1) % self.every:
                break
            parts = [(level - 1, block - i) for i in range(self.every)]
            block //= self.every
            self._write(self.feature.merge(self._read(spark, schema, parts).drop("pane_day")), level, block)
        return self._read(spark, schema, [(0, batch_id)]).drop("pane_day")

    def since(self, spark: SparkSession, schema: StructType, batch_id: int, oldest: int) -> DataFrame:
        """The panes of all batches up to ``batch_id`` that are not before pane ``oldest``; not merged."""
        rows = self._read(spark, schema, self.blocks(batch_id))
        return rows.where((F.col("pane_day") >= oldest * self.feature.pane_us // _DAY_US) & (F.col("_pane") >= oldest)).drop(
            "pane_day")


def update_feature(
    batch: DataFrame, batch_id: int, feature: PaneFeature, panes_path: str, online_path: str, members_path: str | None = None,
    written_at=None, files: int | None = None,
) -> None:
    """Fold one micro-batch into panes and write the current values of the users that it touched, with the members of
    their current windows as rows to ``members_path`` if given.
    """
    spark = batch.sparkSession
    store = PaneStore(panes_path, feature)
    new = store.add(feature.fold(batch), batch_id)
    touched = new.groupBy("user_id").agg((F.min("_pane") - feature.reach).alias("_from"))
    oldest = touched.agg(F.min("_from")).first()[0]  # one number, for the partition filter
    panes = store.since(spark, new.schema, batch_id, 0 if oldest is None else oldest)
    mine = feature.merge(panes.join(touched, "user_id").where("_pane >= _from").drop("_from"))
    write_online(feature.windows(mine), feature.view, online_path, batch_id, written_at, feature.slide, files)
    if members_path is not None and feature.member is not None:
        current = spark.read.parquet(f"{online_path.rstrip('/')}/batch_id={batch_id}").select(
            "user_id", F.expr(f"unix_micros(window_start) div {feature.pane_us}").alias("_low"),
            F.expr(f"unix_micros(window_end) div {feature.pane_us}").alias("_high"))
        rows = mine.join(current, "user_id").where("_pane >= _low and _pane < _high").groupBy("user_id", feature.member).agg(
            F.max("_last").alias("last_event_time"))
        if files is not None:
            rows = rows.repartition(files, "user_id")
        rows.write.mode("overwrite").parquet(f"{members_path.rstrip('/')}/batch_id={batch_id}")


def start_pane_features(
    tx: DataFrame, chosen: dict[str, PaneFeature], panes_root: str, online_paths: dict[str, str], checkpoint: str,
    members_paths: dict[str, str] | None = None, trigger: dict | None = None, written_at=None, files: int | None = None,
):
    """Several features as one query: the source is read once a micro-batch. ``chosen`` maps names, below which panes are
    kept, to features; ``online_paths`` (and ``members_paths``) tell where the values of each go.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for name, feature in chosen.items():
                update_feature(batch, batch_id, feature, f"{panes_root.rstrip('/')}/{name}", online_paths[name],
                               (members_paths or {}).get(name), written_at, files)
        finally:
            batch.unpersist()

    writer = tx.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(write)
    return (writer.trigger(**trigger) if trigger else writer).start()


def start_pane_feature(
    name: str, tx: DataFrame, panes_path: str, online_path: str, checkpoint_root: str, trigger: dict | None = None,
    written_at=None, files: int | None = None, members_path: str | None = None,
):
    """One feature of :data:`PANE_FEATURES` into its online table."""
    return start_pane_features(
        tx, {name: PANE_FEATURES[name]}, panes_path, {name: online_path}, f"{checkpoint_root.rstrip('/')}/{name}-panes",
        members_path and {name: members_path}, trigger, written_at, files)


def read_members(live: DataFrame, members_path: str) -> DataFrame:
    """The members of each live value (user_id, batch_id) as rows: those of the batch that the value comes from."""
    rows = live.sparkSession.read.parquet(members_path).withColumn("batch_id", F.col("batch_id").cast("bigint"))
    return rows.join(live.select("user_id", F.col("batch_id").cast("bigint").alias("batch_id")), ["user_id", "batch_id"]).drop("batch_id")
