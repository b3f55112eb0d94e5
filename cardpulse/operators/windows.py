"""Sliding event-time windows.

A streaming input uses ``window()`` directly: one stateful aggregation, any output mode.

A batch input first folds the transactions into *panes*, one row per key and slide step. That shuffle carries
map-side partial sums, so a key holding a third of all transactions shrinks to one row per pane in every map task
before anything moves. From there a key owns at most (time span / pane) rows however busy it is, and clustering
the panes by key is safe. Windows are built from panes inside that clustering, so the copies an event has in
overlapping windows (24 for a day sliding by the hour, 60 for an hour sliding by the minute) are never shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import gcd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardpulse.functions.times import interval, micros, slot_of

_ROWS = "_rows"
# Shares of a key's slot among the tasks that copy a stream's rows to windows.
_STREAM_SHARES = 8


@dataclass(frozen=True)
class Tally:
    """Rows matching ``where`` (a SQL predicate; all rows if None) in the last ``length`` before a window's end."""

    name: str
    length: str
    where: str | None = None


def _check(length_us: int, slide_us: int) -> None:
    if slide_us > length_us:
        raise ValueError("slide must not exceed the window length")


def _by_key(panes: DataFrame, key: str) -> DataFrame:
    """Cluster panes by key. The partition count is fixed because the rows multiply behind this shuffle: adaptive
    coalescing would judge it by the few bytes of the panes and leave too few tasks for their windows."""
    return panes.repartition(int(panes.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def with_bounds(df: DataFrame, tick: str, pane_us: int, length_us: int, key: str) -> DataFrame:
    """Replace the index of a window's end by its two timestamps."""
    rest = [c for c in df.columns if c not in (key, tick)]
    return df.selectExpr(
        f"`{key}`",
        f"timestamp_micros({tick} * {pane_us}L - {length_us}L) as window_start",
        f"timestamp_micros({tick} * {pane_us}L) as window_end",
        *rest,
    )


def with_windows(tx: DataFrame, length_us: int, slide_us: int, key: str, time: str) -> DataFrame:
    """A stream's rows with ``_w``, once for each window that holds them.

    The aggregation that follows folds the copies in each task, in a table of all its keys and windows. A task that reads
    a large file would hold those of every key in it, so the rows are dealt out first, by key and slot of a window's
    length: the table then shrinks with the number of shuffle partitions. The tasks that read go to different shares of a
    slot, so that one key's rows don't all meet in one task; no key has more folded rows than it would without.
    """
    rows = tx.where(F.col(time).isNotNull())
    dealt = rows.withColumn("_share", F.spark_partition_id() % _STREAM_SHARES).repartition(
        int(tx.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        key, slot_of(F.unix_micros(time), length_us), "_share").drop("_share")
    return dealt.withColumn("_w", F.window(time, f"{length_us} microseconds", f"{slide_us} microseconds"))


def sliding_tallies(
    tx: DataFrame,
    tallies: list[Tally],
    slide: str,
    key: str = "user_id",
    time: str = "event_time",
) -> DataFrame:
    """Counts per key for every window of the longest length that holds at least one row.

    All counts of a row end at the same ``window_end``. ``last_event_time`` is the newest event of the window.
    """
    if tx.isStreaming:
        return _tallies_by_window(tx, tallies, slide, key, time)
    return _tallies_by_pane(tx, tallies, slide, key, time)


def _matches(where: str | None) -> Column:
    return F.lit(True) if where is None else F.expr(where)


def _tallies_by_window(tx, tallies, slide, key, time):
    longest = max(micros(t.length) for t in tallies)
    _check(longest, micros(slide))
    rows = with_windows(tx, longest, micros(slide), key, time)

    def count(tally: Tally) -> Column:
        matches = _matches(tally.where)
        if micros(tally.length) < longest:
            matches = matches & (F.col(time) >= F.col("_w.end") - interval(micros(tally.length)))
        return F.count_if(matches).alias(tally.name)

    counted = rows.groupBy(key, "_w").agg(*map(count, tallies), F.max(time).alias("last_event_time"))
    return counted.select(
        key,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *[t.name for t in tallies],
        "last_event_time",
    )


def _tallies_by_pane(tx, tallies, slide, key, time):
    return tallies_of_panes(fold_panes(tx, tallies, slide, key, time), tallies, slide, key)


def _grid(tallies: list[Tally], slide: str) -> tuple[int, int, int, list[str | None]]:
    """Longest length, slide and pane in microseconds, and the distinct predicates, first that of all rows."""
    lengths = [micros(t.length) for t in tallies]
    longest, slide_us = max(lengths), micros(slide)
    _check(longest, slide_us)
    return longest, slide_us, gcd(slide_us, *lengths), list(dict.fromkeys([None, *[t.where for t in tallies]]))


def fold_panes(
    tx: DataFrame, tallies: list[Tally], slide: str, key: str = "user_id", time: str = "event_time"
) -> DataFrame:
    """(key, _pane, _n0, _n1, ..., _last): one count per distinct predicate and pane, and the pane's newest event."""
    _, _, pane_us, predicates = _grid(tallies, slide)
    return (
        tx.where(F.col(time).isNotNull())
        .groupBy(key, slot_of(F.unix_micros(time), pane_us).alias("_pane"))
        .agg(
            *[F.expr(f"count_if({p or 'true'}) as _n{i}") for i, p in enumerate(predicates)],
            F.max(time).alias("_last"),
        )
    )


def merge_panes(panes: DataFrame, tallies: list[Tally], slide: str, key: str = "user_id") -> DataFrame:
    """Panes folded from several batches as one row per key and pane."""
    counts = [f"_n{i}" for i in range(len(_grid(tallies, slide)[3]))]
    return panes.groupBy(key, "_pane").agg(*[F.sum(c).alias(c) for c in counts], F.max("_last").alias("_last"))


def pane_reach(tallies: list[Tally], slide: str) -> int:
    """How many panes the longest window spans."""
    longest, _, pane_us, _ = _grid(tallies, slide)
    return longest // pane_us


def tallies_of_panes(panes: DataFrame, tallies: list[Tally], slide: str, key: str = "user_id") -> DataFrame:
    """The windows of :func:`sliding_tallies` from panes, one row per key and pane."""
    longest, slide_us, pane_us, predicates = _grid(tallies, slide)
    lengths = [micros(t.length) for t in tallies]

    # A pane enters the running count at the first window end after it and leaves ``length`` later, so two
    # changes per count describe all windows it belongs to.
    counts = [(t.name, t.where, micros(t.length)) for t in tallies] + [(_ROWS, None, longest)]
    changes = _by_key(panes, key).withColumn(
        "_after", F.explode(F.expr(f"array({', '.join(f'{a}L' for a in sorted({0, *[n // pane_us for n in lengths]}))})")),
    ).selectExpr(
        f"`{key}`", "_pane + 1 + _after as _tick",
        *[f"case _after when 0 then _n{predicates.index(where)} "
          f"when {length // pane_us} then -_n{predicates.index(where)} else 0 end as {name}"
          for name, where, length in counts],
        "case _after when 0 then _last end as _last",
    )
    ends = _fill_windows(changes, [name for name, _, _ in counts], _ROWS, key)
    return with_bounds(_aligned(ends.drop(_ROWS), pane_us, longest, slide_us), "_tick", pane_us, longest, key)


def _aligned(ends: DataFrame, pane_us: int, length_us: int, slide_us: int) -> DataFrame:
    """Keep the window ends whose start is a multiple of the slide."""
    if slide_us == pane_us:
        return ends
    start = F.col("_tick") - length_us // pane_us
    return ends.where(F.pmod(start, F.lit(slide_us // pane_us)) == 0)


def _fill_windows(changes, names, present, key):
    """Turn changes per (key, window end) into one row per window end at which ``present`` is positive.

    Between two changes the counts stand still, so a run of equal windows is written out from its first row. Needs
    ``changes`` of one key to be few; they are bounded by the time span, not by the number of transactions.
    """
    order = f"(partition by `{key}` order by _tick)"
    so_far = f"(partition by `{key}` order by _tick rows between unbounded preceding and current row)"
    runs = changes.selectExpr(
        f"`{key}`", "_tick",
        f"lead(_tick) over {order} as _next",
        *[f"sum({name}) over {so_far} as {name}" for name in names],
        f"max(_last) over {so_far} as last_event_time",
    ).where(f"{present} > 0")
    return _write_out(runs, key, *names, "last_event_time")


def _write_out(runs, key, *names):
    """One row per window end from a run's ``_tick`` up to the one before ``_next``. Of several changes at one window
    end the last one has seen them all; it is the one whose ``_next`` lies ahead."""
    return runs.where("_next > _tick").selectExpr(
        f"`{key}`", "explode(sequence(_tick, _next - 1)) as _tick", *names)


def sliding_amounts(
    tx: DataFrame,
    length: str,
    slide: str,
    amount: str = "amount",
    key: str = "user_id",
    time: str = "event_time",
) -> DataFrame:
    """Average, sample standard deviation, maximum, minimum and sum of ``amount`` per key and window."""
    length_us, slide_us = micros(length), micros(slide)
    _check(length_us, slide_us)
    if tx.isStreaming:
        rows = with_windows(tx, length_us, slide_us, key, time)
        return rows.groupBy(key, "_w").agg(
            F.avg(amount).alias("avg_amount"),
            F.stddev(amount).alias("stddev_amount"),
            F.max(amount).alias("max_amount"),
            F.min(amount).alias("min_amount"),
            F.sum(amount).alias("sum_amount"),
            F.max(time).alias("last_event_time"),
        ).select(
            key,
            F.col("_w.start").alias("window_start"),
            F.col("_w.end").alias("window_end"),
            "avg_amount", "stddev_amount", "max_amount", "min_amount", "sum_amount", "last_event_time",
        )

    return amounts_of_panes(fold_amounts(tx, length, slide, amount, key, time), length, slide, key)


def fold_amounts(
    tx: DataFrame, length: str, slide: str, amount: str = "amount", key: str = "user_id", time: str = "event_time"
) -> DataFrame:
    """(key, _pane, _n, _sum, _spread, _max, _min, _last): a pane's amounts, with the sum of squared distances from the
    pane's own mean.
    """
    pane_us = gcd(micros(length), micros(slide))
    return (
        tx.where(F.col(time).isNotNull())
        .groupBy(key, slot_of(F.unix_micros(time), pane_us).alias("_pane"))
        .agg(*map(F.expr, (
            f"count({amount}) as _n",
            f"sum({amount}) as _sum",
            f"var_pop({amount}) * count({amount}) as _spread",
            f"max({amount}) as _max",
            f"min({amount}) as _min",
            f"max({time}) as _last",
        )))
    )


def _spread_around(mean: str, parts: str) -> str:
    """The sum of squared distances from ``mean`` over ``parts``: each part's inner spread plus the distance of its mean.
    Taking the mean first keeps the sum free of cancellation.
    """
    return (
        f"aggregate(filter({parts}, p -> p._n > 0), 0D, (total, p) -> total + p._spread "
        f"+ p._n * (p._sum / p._n - {mean}) * (p._sum / p._n - {mean}))"
    )


def merge_amounts(panes: DataFrame, key: str = "user_id") -> DataFrame:
    """Panes folded from several batches as one row per key and pane."""
    merged = panes.groupBy(key, "_pane").agg(*map(F.expr, (
        "sum(_n) as _n", "sum(_sum) as _sum", "collect_list(struct(_n, _sum, _spread)) as _parts",
        "max(_max) as _max", "min(_min) as _min", "max(_last) as _last")))
    return merged.withColumn("_mean", F.expr("_sum / nullif(_n, 0)")).selectExpr(
        f"`{key}`", "_pane", "_n", "_sum", f"if(_n > 0, {_spread_around('_mean', '_parts')}, null) as _spread",
        "_max", "_min", "_last")


def amounts_of_panes(panes: DataFrame, length: str, slide: str, key: str = "user_id") -> DataFrame:
    """The windows of :func:`sliding_amounts` from panes, one row per key and pane."""
    length_us, slide_us = micros(length), micros(slide)
    pane_us = gcd(length_us, slide_us)
    # Statistics are taken where a pane enters or leaves, twice per pane, over the few panes of that window; the
    # windows in between repeat them. A leaving pane brings no values, it only marks the change.
    panes_per_window = length_us // pane_us
    changes = _by_key(panes, key).selectExpr(
        f"`{key}`", "_n", "_sum", "_spread", "_max", "_min", "_last",
        f"explode(array(_pane + 1, _pane + 1 + {panes_per_window}L)) as _tick", "_pane",
    ).selectExpr(
        f"`{key}`", "_tick",
        "case when _tick = _pane + 1 then struct(_n, _sum, _spread, _max, _min, _last) end as _p",
    )
    order = f"(partition by `{key}` order by _tick)"
    inside = f"(partition by `{key}` order by _tick range between {panes_per_window - 1} preceding and current row)"
    runs = changes.selectExpr(
        f"`{key}`", "_tick",
        f"lead(_tick) over {order} as _next",
        f"sum(_p._n) over {inside} as _n",
        f"sum(_p._sum) over {inside} as sum_amount",
        f"max(_p._max) over {inside} as max_amount",
        f"min(_p._min) over {inside} as min_amount",
        f"max(_p._last) over {inside} as last_event_time",
        f"collect_list(_p) over {inside} as _panes",
    ).where("last_event_time is not null")
    stats = runs.withColumn("avg_amount", F.expr("sum_amount / nullif(_n, 0)")).withColumn(
        "stddev_amount", F.expr(
            f"case when _n > 1 then sqrt({_spread_around('avg_amount', '_panes')} / (_n - 1)) end"))
    ends = _write_out(
        stats, key, "avg_amount", "stddev_amount", "max_amount", "min_amount", "sum_amount", "last_event_time")
    return with_bounds(_aligned(ends, pane_us, length_us, slide_us), "_tick", pane_us, length_us, key)


def sliding_members(
    tx: DataFrame,
    member: str,
    length: str,
    slide: str,
    key: str = "user_id",
    time: str = "event_time",
) -> DataFrame:
    """The distinct ``member`` values of every key and window, one row for each: (key, window, member).

    Batch only. Each (key, member) pair is followed on its own, so neither a busy key nor a key with very many
    members gathers in one task.
    """
    length_us, slide_us = micros(length), micros(slide)
    pane_us = gcd(length_us, slide_us)
    spans = _member_spans(fold_members(tx, member, length, slide, key, time), member, length_us, pane_us, key)
    ticks = spans.select(
        key, member,
        F.explode(F.sequence("_from", "_to")).alias("_tick"),
        F.col("_last").alias("last_event_time"),
    )
    return with_bounds(_aligned(ticks, pane_us, length_us, slide_us), "_tick", pane_us, length_us, key)


def fold_members(
    tx: DataFrame, member: str, length: str, slide: str, key: str = "user_id", time: str = "event_time"
) -> DataFrame:
    """(key, member, _pane, _last): the panes in which a key meets a member."""
    _check(micros(length), micros(slide))
    return (
        tx.where(F.col(time).isNotNull() & F.col(member).isNotNull())
        .groupBy(key, member, slot_of(F.unix_micros(time), gcd(micros(length), micros(slide))).alias("_pane"))
        .agg(F.max(time).alias("_last"))
    )


def merge_members(panes: DataFrame, member: str, key: str = "user_id") -> DataFrame:
    """Panes folded from several batches as one row per key, member and pane."""
    return panes.groupBy(key, member, "_pane").agg(F.max("_last").alias("_last"))


def _member_spans(panes, member, length_us, pane_us, key):
    """Window ends [_from, _to] in which a member's newest pane is the given one; spans of a member are disjoint."""
    order = Window.partitionBy(key, member).orderBy("_pane")
    last_end = F.col("_pane") + length_us // pane_us
    return panes.select(
        key, member,
        (F.col("_pane") + 1).alias("_from"),
        F.least(last_end, F.lead("_pane").over(order)).alias("_to"),
        "_last",
    )


def sliding_distinct(
    tx: DataFrame,
    member: str,
    length: str,
    slide: str,
    count_name: str,
    key: str = "user_id",
    time: str = "event_time",
) -> DataFrame:
    """Exact number of distinct ``member`` values per key and window, without ever holding the set. Batch only."""
    return distinct_of_panes(fold_members(tx, member, length, slide, key, time), member, length, slide, count_name, key)


def distinct_of_panes(
    panes: DataFrame, member: str, length: str, slide: str, count_name: str, key: str = "user_id"
) -> DataFrame:
    """The windows of :func:`sliding_distinct` from panes, one row per key, member and pane."""
    length_us, slide_us = micros(length), micros(slide)
    pane_us = gcd(length_us, slide_us)
    spans = _member_spans(panes, member, length_us, pane_us, key)
    # +1 where a member's span begins, -1 behind its end; partial sums make this at most one row per key and
    # window end, whatever the number of members.
    edges = spans.select(key, F.explode(F.array(
        F.struct(F.col("_from").alias("tick"), F.lit(1).alias("change"), F.col("_last").alias("last")),
        F.struct((F.col("_to") + 1).alias("tick"), F.lit(-1).alias("change"),
                 F.lit(None).cast("timestamp").alias("last")),
    )).alias("_e"))
    changes = edges.groupBy(key, F.col("_e.tick").alias("_tick")).agg(
        F.sum("_e.change").alias(count_name), F.max("_e.last").alias("_last"))
    ends = _fill_windows(_by_key(changes, key), [count_name], count_name, key)
    return with_bounds(_aligned(ends, pane_us, length_us, slide_us), "_tick", pane_us, length_us, key)
