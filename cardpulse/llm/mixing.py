"""Mixing sources to target weights: whole word streams cut into blocks, drawn in permuted order, dealt to shards."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.shared import written

PIECE_DDL = "epoch bigint, start bigint, length bigint, draw bigint, block bigint"


def word_count(text: Column) -> Column:
    """The number of words between ASCII white space; 0 of a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("bigint")


def _source_key(source: Column) -> Column:
    """A text that sorts like the source by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most_epochs: int) -> DataFrame:
    """For each source of ``sizes`` (key, size): ``number`` (from 0, by key), ``source_size`` and ``target``.

    The weights repeat over the sources in order. Targets share ``share`` times the whole size by weight, none above
    ``most_epochs`` times its source's size: sources that would be stop there, and the excess goes to the others by
    weight, until none is above. That is one level for all sources that don't stop: sorted by limit per weight, the first
    one that the level left by those before does not fill. Windows here run over one row a source.
    """
    totals = sizes.groupBy("key").agg(F.sum("size").alias("source_size"))
    numbered = totals.withColumn("number", F.row_number().over(Window.orderBy("key")).cast("bigint") - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights)).cast("int") + 1)
    limited = numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size").cast("double") * most_epochs)
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "key")
    before = F.coalesce(F.sum("limit").over(by_limit.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(by_limit.rowsBetween(0, Window.unboundedFollowing))
    everything = Window.partitionBy()
    levels = limited.withColumn("amount", F.sum("source_size").over(everything) * F.lit(float(share)) - before).withColumn(
        "left", left).withColumn("stops", F.col("amount") * F.col("weight") > F.col("limit") * F.col("left"))
    first = F.min(F.when(~F.col("stops"), F.struct(F.col("limit") / F.col("weight"), "key", "amount", "left"))).over(everything)
    level = levels.withColumn("first", first).withColumn(
        "open", F.col("first")["amount"] * F.col("weight") / F.col("first")["left"])
    return level.select("key", "number", "source_size", F.least("limit", F.coalesce("open", "limit")).alias("target"))


def draw_plan(targets: DataFrame, block: int) -> DataFrame:
    """``targets`` with the number of words to draw (``words``), of complete ``epochs``, the words of the next epoch
    (``rest``), ``blocks`` of an epoch, and how many blocks are ``drawn`` in all.
    """
    plan = targets.withColumn("words", F.round("target").cast("bigint")).withColumn(
        "epochs", F.expr("if(source_size > 0, words div source_size, 0L)"))
    plan = plan.withColumn("rest", F.col("words") - F.col("epochs") * F.col("source_size"))
    size = F.lit(block)
    plan = plan.withColumn("blocks", F.ceil(F.col("source_size") / size).cast("bigint"))
    return plan.withColumn("drawn", F.col("epochs") * F.col("blocks") + F.ceil(F.col("rest") / size).cast("bigint"))


def split_quotas(counts, shards: int, seed: int):
    """(shard, counts) of each shard: ``counts`` blocks of each source dealt to ``shards`` shards of equal size but for
    one block. The tree halves the shards; which of a node's blocks go left is a multivariate hypergeometric draw, with a
    generator of its own for each node, so that quotas add up to the counts exactly and repeat with the seed.
    """
    import numpy as np

    total = int(sum(counts))
    if total >= 1_000_000_000:
        raise ValueError("too many blocks to draw from; take larger blocks")
    room = lambda shard: total * shard // shards  # noqa: E731  blocks in the shards before
    stack = [(0, shards, np.asarray(counts, dtype=np.int64))]
    while stack:
        low, high, here = stack.pop()
        if high - low == 1:
            yield low, here
            continue
        middle = (low + high) // 2
        generator = np.random.default_rng([seed, low, high])
        left = generator.multivariate_hypergeometric(here, room(middle) - room(low), method="marginals")
        stack += [(middle, high, here - left), (low, middle, left)]


def _quotas(shards: int, seed: int):
    def run(frames: Iterator) -> Iterator:
        import numpy as np
        import pandas as pd

        frames = list(frames)
        if frames:
            plan = pd.concat(frames).sort_values("number")
            first = np.zeros(len(plan), dtype=np.int64)
            for shard, quota in split_quotas(plan["drawn"].to_numpy(), shards, seed):
                yield pd.DataFrame({"key": plan["key"], "shard": shard, "first": first, "quota": quota})[quota > 0]
                first = first + quota

    return run


def block_shards(plan: DataFrame, shards: int, seed: int) -> DataFrame:
    """(key, draw, shard): the shard of each drawn block of a source. The tree is split in one task, whose input is one
    row a source; its quotas are turned into blocks by many.
    """
    quotas = plan.select("key", "number", "drawn").repartition(1).mapInPandas(
        _quotas(shards, seed), "key string, shard bigint, first bigint, quota bigint")
    return quotas.repartition(F.xxhash64("key", "shard")).select(
        "key", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("quota") - 1)).alias("draw"), "shard")


def permuted(index, count, seed):
    """The place of each ``index`` in a keyed permutation of 0 to ``count`` - 1 (arrays; ``seed`` is the key): a Feistel
    network of four rounds over the next even number of bits, walked until a place is within range.
    """
    import numpy as np

    count = np.asarray(count, dtype=np.uint64)
    seed = np.asarray(seed, dtype=np.uint64)
    bits = np.frexp(np.maximum(count.astype(np.float64) - 1, 0))[1]
    half = np.maximum((bits + 1) // 2, 1).astype(np.uint64)
    mask = (np.uint64(1) << half) - np.uint64(1)
    out = np.asarray(index, dtype=np.uint64).copy()
    todo = np.arange(len(out))
    while len(todo):
        h, m, s = half[todo], mask[todo], seed[todo]
        left, right = out[todo] >> h, out[todo] & m
        for turn in range(4):  # the finaliser of splitmix64 (fixed values) mixes the rounds
            x = right + s + np.uint64((turn + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
            left, right = right, left ^ ((x ^ x >> np.uint64(31)) & m)
        out[todo] = left << h | right
        todo = todo[out[todo] >= count[todo]]
    return out.astype(np.int64)


def _pieces(block: int, seed: int):
    """From rows (.., at, size, source_size, blocks, epochs, rest, source_seed) to the pieces that are drawn."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at, size, whole, blocks, epochs, rest, source = (
                batch.column(i).to_numpy() for i in range(batch.num_columns - 7, batch.num_columns))
            taken = np.where(size > 0, epochs + (rest > 0), 0)
            row = np.repeat(np.arange(len(at)), taken)
            epoch = np.arange(len(row)) - np.repeat(np.cumsum(taken) - taken, taken)
            low, high = at[row] // block, (at[row] + size[row] - 1) // block
            spans = high - low + 1
            piece = np.repeat(np.arange(len(row)), spans)
            number = low[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(spans) - spans, spans)
            row, epoch = row[piece], epoch[piece]
            # The last block of an epoch, which may be short, stays the last one of the permutation.
            full = blocks[row] - 1
            place = number.copy()
            inner = np.flatnonzero(number < full)
            with np.errstate(over="ignore"):
                key = source[row].astype(np.uint64) + np.uint64(seed) * np.uint64(0xD1342543DE82EF95) + epoch.astype(np.uint64)
                place[inner] = permuted(number[inner], full[inner], key[inner])
            # Words before this block's in the order drawn, and how many of its first words the epoch takes.
            room = np.where(epoch < epochs[row], whole[row], rest[row]) - place * block
            begin = np.maximum(at[row], number * block)
            end = np.minimum(np.minimum(at[row] + size[row], (number + 1) * block), number * block + room)
            hit = np.flatnonzero(end > begin)
            row, begin, end = row[hit], begin[hit], end[hit]
            columns = [epoch[hit], begin - at[row], end - begin, epoch[hit] * blocks[row] + place[hit], number[hit]]
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*(c.take(rows) for c in batch.columns[:-7]), *(pa.array(c, pa.int64()) for c in columns)],
                names=[*batch.schema.names[:-7], "epoch", "start", "length", "draw", "block"])

    return run


class Mix:
    """A mix of ``docs`` by source: ``documents`` (row, doc_id, size, source_size, target: one row per document) and
    ``pieces`` (row, doc_id, epoch, start, length, shard, block: words ``start`` to ``start + length`` of the document).

    Sizes are words. Each source is a stream of its documents in an order drawn from the seed, cut into blocks of
    ``block`` words. The mix takes exactly the rounded target of each source: complete epochs, and of the next one the
    blocks that come first in an order of their own; the last of these is cut. ``row`` names a document within the mix
    (its source and place in the stream), so that repeated rows stay apart; of rows that are alike in all, it does not
    matter which is which.

    Null and empty texts have size 0 and no pieces, null ids stay null, a null source is a source and comes last; other
    columns are ignored; an empty table gives an empty mix. Rows of a hot source are never gathered: streams are summed up
    range by range, and one number a source and range crosses them.
    """

    def __init__(self, docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, most_epochs: int = 2,
                 block: int = 1_024, shards: int = 64, seed: int = 0, id_col: str = "doc_id", text_col: str = "text",
                 source_col: str = "source"):
        if share > most_epochs:
            raise ValueError("the share cannot be reached")
        self.shards, self.seed = shards, seed
        sizes = written(docs.select(
            F.col(id_col).alias("doc_id"), _source_key(F.col(source_col)).alias("key"), word_count(F.col(text_col)).alias("size")),
            "mix-sizes").withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "size"))
        self.plan = written(draw_plan(source_targets(sizes, weights, share, most_epochs), block), "mix-plan")
        placed = self._places(sizes).join(self.plan, "key")
        self._placed = written(placed.select(
            F.struct("key", "at", "order", "doc_id").alias("row"), "doc_id", "key", "target", "at", "size", "source_size", "blocks",
            "epochs", "rest", F.xxhash64("key").alias("source_seed")), "mix-places")
        self.documents = self._placed.select("row", "doc_id", "size", "source_size", "target")
        kinds = {f.name: f.dataType.simpleString() for f in self._placed.schema.fields}
        drawn = self._placed.select(
            "row", "doc_id", "key", "at", "size", "source_size", "blocks", "epochs", "rest", "source_seed").mapInArrow(
            _pieces(block, seed), f"row {kinds['row']}, doc_id {kinds['doc_id']}, key string, {PIECE_DDL}")
        self.pieces = drawn.join(block_shards(self.plan, shards, seed), ["key", "draw"]).drop("key", "draw")

    @staticmethod
    def _places(sizes: DataFrame) -> DataFrame:
        """``sizes`` with ``at``, the words before a document in its source's stream."""
        ranged = written(sizes.repartitionByRange("key", "order", "doc_id").withColumn(
            "range", F.spark_partition_id()), "mix-ranges")
        inside = Window.partitionBy("range", "key").orderBy("order", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
        sums = ranged.groupBy("key", "range").agg(F.sum("size").alias("whole"))
        earlier = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
        carried = sums.select("key", "range", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("carried"))
        return ranged.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(
            carried, ["key", "range"]).withColumn("at", F.col("carried") + F.col("inside")).drop("range", "carried", "inside")

    def shuffled(self) -> DataFrame:
        """The pieces by shard, each shard in one task and in an order drawn from the seed."""
        order = F.xxhash64(F.lit(self.seed), "row", "epoch", "start")
        return self.pieces.withColumn("_order", order).repartition(self.shards, "shard").sortWithinPartitions(
            "shard", "_order", "row", "epoch", "start").drop("_order")


def taken_words(mix: Mix) -> DataFrame:
    """``doc_id``, ``size``, ``source_size``, ``target`` and ``taken`` of every document: the words of all its pieces in
    all shards, repeats counted.
    """
    taken = mix.pieces.groupBy("row").agg(F.sum("length").alias("taken"))
    return mix.documents.join(taken, "row", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"))
