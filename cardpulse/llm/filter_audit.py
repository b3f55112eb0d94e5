"""What each of five document filters removes, in every order of filters and on average over all orders."""

from __future__ import annotations

import json
from collections.abc import Iterator
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import written

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
# Thresholds of the filters (documented in ``failures``).
LEAST_WORDS = 50
DISTINCT_PERCENT = 65
CAPITAL_PERCENT = 5
MARKS = "#$%&*|"


def solve(matrix: list[list[Fraction]], sides: list[list[Fraction]]) -> list[list[Fraction]]:
    """The solution X of matrix X = sides by elimination in rationals."""
    rows = [m + s for m, s in zip(matrix, sides)]
    n = len(rows)
    for i in range(n):
        pivot = next(r for r in range(i, n) if rows[r][i])
        rows[i], rows[pivot] = rows[pivot], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for r in range(n):
            if r != i and rows[r][i]:
                rows[r] = [x - rows[r][i] * y for x, y in zip(rows[r], rows[i])]
    return [row[n:] for row in rows]


def shapley_weights(n: int = len(FILTERS)) -> list[list[int]]:
    """For each player and each coalition (by bits), the factor of the coalition's value in n! times the player's
    Shapley value.

    The values are the least-squares fit of additive players to all coalitions' values, with the kernel
    (n - 1) / (C(n, s) s (n - s)) as weight of a coalition of s, under the constraint that they add up to the value of
    all players together. Its normal equations, bordered by the constraint, are solved exactly for the indicator of
    each coalition's value; the solution is linear in these.
    """
    full = (1 << n) - 1
    kernel = {s: Fraction(n - 1, comb(n, s.bit_count()) * s.bit_count() * (n - s.bit_count())) for s in range(1, full)}
    member = lambda s, i: s >> i & 1
    matrix = [[sum(2 * w * member(s, i) * member(s, j) for s, w in kernel.items()) for j in range(n)] + [Fraction(1)]
              for i in range(n)] + [[Fraction(1)] * n + [Fraction(0)]]
    sides = [[2 * kernel[s] * member(s, i) if s in kernel else Fraction(0) for s in range(full + 1)] for i in range(n)]
    sides.append([Fraction(int(s == full)) for s in range(full + 1)])
    fit = [[x * factorial(n) for x in row] for row in solve(matrix, sides)[:n]]
    if any(x.denominator != 1 for row in fit for x in row):
        raise ValueError("the equations have no whole solution")
    return [[int(x) for x in row] for row in fit]


def _judge(batches: Iterator) -> Iterator:
    from hashlib import sha256

    import pyarrow as pa

    capitals = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    marks = MARKS.encode()
    continuing = bytes(range(0x80, 0xC0))  # of a character of several bytes, all but the first
    for batch in batches:
        masks, digests = [], []
        for value in batch.column(batch.num_columns - 1):
            raw = (value.as_py() or "").encode()
            words = raw.split()
            length = len(raw.translate(None, continuing))
            masks.append(
                (len(words) < LEAST_WORDS)
                | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
                | (100 * (len(raw) - len(raw.translate(None, capitals))) > CAPITAL_PERCENT * length) << 2
                | (len(raw.translate(None, marks)) < len(raw)) << 3)
            digests.append(sha256(raw).digest())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(masks, pa.int32()), pa.array(digests, pa.binary())],
            names=[*batch.schema.names[:-1], "mask", "digest"])


def failures(docs: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``part`` (null: empty) and ``mask`` of every document, whose bits tell the filters that it fails, A
    first: A has under ``LEAST_WORDS`` words; B has ``100 * distinct words < DISTINCT_PERCENT * words``; C has
    ``100 * capitals A-Z > CAPITAL_PERCENT * code points``; D holds one of ``MARKS``; E equals the text of a document
    with a smaller id. Words lie between ASCII white space; null texts are empty.

    A null id is neither smaller than another nor has smaller ones, so its rows never fail E; of rows with one id none
    is smaller. Each text is read once; equal texts are those of equal SHA-256 digests, and only these and the bits are
    shuffled. Copies are folded to the least id by the map tasks; texts that occur once take no part in the join.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    judged = written(docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).alias("text")).mapInArrow(_judge, f"doc_id {kind}, part string, mask int, digest binary"), "audit-masks")
    copied = judged.groupBy("digest").agg(F.min("doc_id").alias("_least"), F.count(F.lit(1)).alias("_n")).where(
        "_n > 1").drop("_n")
    again = F.coalesce(F.col("doc_id") > F.col("_least"), F.lit(False))
    return judged.join(copied, "digest", "left").select(
        "doc_id", "part", F.col("mask").bitwiseOR(F.when(again, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))


def _step_rows() -> Column:
    """All orders and steps, as an array of (filter_order, step, number of the filter, bits of those before)."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        name, before = "".join(FILTERS[i] for i in order), 0
        for step, i in enumerate(order, 1):
            rows.append({"filter_order": name, "step": step, "_i": i, "_before": before})
            before |= 1 << i
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<filter_order: string, step: int, _i: int, _before: int>>")


def audit(docs: DataFrame, labels: DataFrame, part_col: str = "source", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """For each part, each order of the filters and each step: ``kept`` (documents left after the step), ``removed``
    (here), ``redundant`` (failing the step's filter, removed earlier), ``unique_fails`` (failing this filter only),
    ``good_lost`` and ``toxic_lost`` (removed here, with a label quality = 1 or toxic = 1), ``shapley`` (the filter's
    ``removed`` added up over all orders).

    ``labels`` (doc_id, quality, toxic) may lack documents and may name one several times: any 1 counts. Labels of a null
    id fit none. An empty table gives an empty result. Documents of null parts count under the empty name.

    Documents are counted by part, bits and labels, at most 128 rows a part; from these follows what each of the 32
    coalitions of filters removes, and from that all orders: a step removes the difference of two coalitions.
    """
    marked = labels.where("doc_id is not null").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("_good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("_toxic"))
    rows = failures(docs, part_col, id_col, text_col).join(marked, "doc_id", "left")
    counted = rows.groupBy("part", "mask", "_good", "_toxic").agg(F.count(F.lit(1)).alias("_n"))
    coalitions = range(ALL + 1)

    def removed(which: Column | None) -> Column:
        amount = F.col("_n") if which is None else F.when(which, F.col("_n")).otherwise(0)
        return F.array(*[F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, amount).otherwise(0)) for s in coalitions])

    parts = counted.groupBy("part").agg(
        F.sum("_n").alias("_all"), removed(None).alias("_v"), removed(F.col("_good")).alias("_g"),
        removed(F.col("_toxic")).alias("_t"),
        F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("_n")).otherwise(0)) for i in range(len(FILTERS))]).alias("_only"))
    average = [sum((F.col("_v")[s] * w for s, w in enumerate(weights) if w), F.lit(0)) for weights in shapley_weights()]
    steps = parts.withColumn("_shapley", F.array(*average)).select("*", F.inline(_step_rows()))
    own = F.expr("shiftleft(1, _i)")
    after = F.col("_before").bitwiseOR(own)

    def here(values: str) -> Column:
        return F.get(values, after) - F.get(values, F.col("_before"))

    return steps.select(
        "part", "filter_order", "step", (F.col("_all") - F.get("_v", after)).alias("kept"), here("_v").alias("removed"),
        (F.get("_v", own) - here("_v")).alias("redundant"), F.get("_only", F.col("_i")).alias("unique_fails"),
        here("_g").alias("good_lost"), here("_t").alias("toxic_lost"), F.get("_shapley", F.col("_i")).alias("shapley"))
