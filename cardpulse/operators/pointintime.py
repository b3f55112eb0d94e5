"""Point-in-time joins: for every row, the newest feature values known at its time and not yet expired."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardpulse.functions.times import slot_of
from cardpulse.operators.skew import busy_keys, row_digest, spread_keys
from cardpulse.schema import FeatureView

# Shares of a slot of one entity, unless the caller says otherwise.
SPREAD = 8
# Slots are this many TTLs long, so that one feature row in eight is needed in two slots.
_TTLS_PER_SLOT = 8


@dataclass(frozen=True)
class Lookup:
    """Feature rows (entity, ``event_timestamp``, columns) to look up, with the view that gives entity and TTL.

    ``columns`` chooses and orders the values; all of the view's by default. (entity, event_timestamp) must be
    unique, see :func:`cardpulse.operators.quality.latest_by_key`.
    """

    features: DataFrame
    view: FeatureView
    columns: tuple[str, ...] | None = None

    @property
    def names(self) -> list[str]:
        return list(self.columns or self.view.names)


def point_in_time_join(
    spine: DataFrame,
    lookups: list[Lookup],
    ts: str = "event_timestamp",
    spine_key: tuple[str, ...] = (),
    spread: int = SPREAD,
) -> DataFrame:
    """Add each lookup's columns to ``spine``; null where no live row exists.

    A feature row serves rows of its entity from its own time on until its TTL has passed, both inclusive. All
    lookups of one entity share one shuffle and one sort; there is no inequality join and no row is multiplied.

    Rows meet by (entity, time slot), not by entity, so a long history never gathers in one task. The engine can't
    split a window's partition, so a slot with many spine rows is dealt out over ``spread`` shares by a hash of the row
    and its feature rows are copied to all of them; other slots are left whole. Choose it so that the busiest entity's
    slot, divided by it, fits a task; 1 for a spine known to be even. Otherwise the spine's keys are counted beforehand,
    so a spine that is costly to compute should be a stored table. ``spine_key`` names the unique columns of the spine: an entity that holds them can't
    be hot and is not spread.
    """
    by_entity: dict[tuple[str, ...], list[Lookup]] = {}
    for lookup in lookups:
        by_entity.setdefault(lookup.view.entity, []).append(lookup)
    out = spine
    for entity, group in by_entity.items():
        unique = bool(spine_key) and set(spine_key) <= set(entity)
        out = _fill(out, entity, group, ts, spine_key, 1 if unique else spread)
    return out


def _fill(spine, entity, group, ts, spine_key, spread):
    slot_us = _TTLS_PER_SLOT * max(l.view.ttl_seconds for l in group) * 1_000_000
    keys = [*entity, "_slot"]

    rows = spine.select(
        *entity,
        F.unix_micros(ts).alias("_at"),
        slot_of(F.unix_micros(ts), slot_us).alias("_slot"),
        F.lit(1).alias("_kind"),
        F.struct(*spine.columns).alias("_row"),
    )
    facts = None
    for i, lookup in enumerate(group):
        ttl = F.lit(lookup.view.ttl_seconds * 1_000_000).cast("bigint")
        at = F.unix_micros("event_timestamp")
        mine = lookup.features.select(
            *entity,
            at.alias("_at"),
            F.explode(F.sequence(slot_of(at, slot_us), slot_of(at + ttl, slot_us))).alias("_slot"),
            F.lit(0).alias("_kind"),
            F.struct(at.alias("_at"), *lookup.names).alias(f"_v{i}"),
        ).dropna(subset=list(entity))
        facts = mine if facts is None else facts.unionByName(mine, allowMissingColumns=True)

    busy = busy_keys(rows, keys) if spread > 1 else None
    rows, facts = spread_keys(rows, facts, keys, row_digest(spine, spine_key, "_row."), spread, busy)

    # Features sort before spine rows of the same instant, so that a value is usable at its own time.
    known = (
        Window.partitionBy(*keys, "_share").orderBy("_at", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    filled = facts.unionByName(rows, allowMissingColumns=True).select(
        "_at", "_kind", "_row",
        *[F.last(f"_v{i}", ignorenulls=True).over(known).alias(f"_v{i}") for i in range(len(group))],
    ).where(F.col("_kind") == 1)
    columns = []
    for i, lookup in enumerate(group):
        live = F.col("_at") - F.col(f"_v{i}._at") <= lookup.view.ttl_seconds * 1_000_000
        columns += [F.when(live, F.col(f"_v{i}.{name}")).alias(name) for name in lookup.names]
    return filled.select("_row.*", *columns)
