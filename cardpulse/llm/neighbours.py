"""Approximate nearest neighbours: multiprobe p-stable hashing, exact distances of all candidates."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cardpulse.llm.shared import written


@dataclass(frozen=True)
class HashPlan:
    """``tables`` tables of ``hashes`` functions floor((a v + b) / width) of the vectors' directions, a normal (a
    2-stable distribution) and b uniform; each query visits ``probes`` buckets of each table. Buckets shrink as hashes
    are added: add them with the logarithm of the number of vectors.
    """

    tables: int = 8
    hashes: int = 6
    width: float = 2.0
    probes: int = 80
    seed: int = 11

    def functions(self, dimension: int):
        import numpy as np

        draw = np.random.default_rng([self.seed, dimension])
        return (draw.normal(size=(dimension, self.tables * self.hashes)),
                draw.uniform(0, self.width, self.tables * self.hashes))


def probe_order(offsets, count: int) -> list[tuple[tuple[int, int], ...]]:
    """The ``count`` perturbations most likely to hold a near vector, best first, starting with none.

    ``offsets`` are the distances, in bucket widths, of a query to the lower border of its bucket in each function.
    A perturbation moves some functions by -1 or +1; the sum of squared distances to the borders it crosses is its
    score, and lower scores succeed more often. A heap makes sets in the order of scores: from a set whose last member
    is the j-th nearest border, the next ones replace it by, or add, the border j + 1.
    """
    borders = sorted([(x * x, at, -1) for at, x in enumerate(offsets)]
                     + [((1 - x) ** 2, at, 1) for at, x in enumerate(offsets)])
    out: list[tuple[tuple[int, int], ...]] = [()]
    heap = [(borders[0][0], (0,))]
    while heap and len(out) < count:
        score, members = heapq.heappop(heap)
        moved = [borders[m][1] for m in members]
        if len(set(moved)) == len(moved):  # a function moves one way only
            out.append(tuple((borders[m][1], borders[m][2]) for m in members))
        j = members[-1]
        if j + 1 < len(borders):
            heapq.heappush(heap, (score - borders[j][0] + borders[j + 1][0], (*members[:-1], j + 1)))
            heapq.heappush(heap, (score + borders[j + 1][0], (*members, j + 1)))
    return out


def usable(vector: Column) -> Column:
    """Neither null nor zero nor empty, without null, infinite or not-a-number components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _bucket_ids(codes, table: int, dimension: int):
    """64-bit names of buckets. Should two buckets share a name, their vectors merely meet more candidates."""
    import numpy as np

    mix = np.full(len(codes), table * 1_000_003 + dimension, dtype=np.uint64)
    for column in codes.T.astype(np.int64).view(np.uint64):
        mix = (mix ^ column) * np.uint64(0x9E3779B97F4A7C15)
        mix ^= mix >> np.uint64(29)
    return mix.view(np.int64)


def _hashed(plan: HashPlan, probing: bool):
    """Rows (bucket, vec_id, vector as bytes of doubles) of each vector: one of each table, or all its probes."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        made: dict[int, tuple] = {}
        for batch in batches:
            by_size: dict[int, list] = {}
            for vec_id, vector in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
                by_size.setdefault(len(values), []).append((vec_id, values))
            for size, rows in by_size.items():
                if size not in made:
                    made[size] = plan.functions(size)
                a, b = made[size]
                step = 20 if probing else 500
                for at in range(0, len(rows), step):
                    part = rows[at:at + step]
                    vectors = np.stack([v for _, v in part])
                    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
                    units = scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))
                    placed = (units @ a + b) / plan.width
                    codes = np.floor(placed).astype(np.int64)
                    buckets, who = [], []
                    for table in range(plan.tables):
                        own = slice(table * plan.hashes, (table + 1) * plan.hashes)
                        if not probing:
                            buckets.append(_bucket_ids(codes[:, own], table, size))
                            who.append(np.arange(len(part)))
                            continue
                        for i in range(len(part)):
                            sets = probe_order((placed[i, own] - codes[i, own]).tolist(), plan.probes)
                            moved = np.repeat(codes[i:i + 1, own], len(sets), axis=0)
                            for k, moves in enumerate(sets):
                                for function, by in moves:
                                    moved[k, function] += by
                            buckets.append(_bucket_ids(moved, table, size))
                            who.append(np.full(len(sets), i))
                    who = np.concatenate(who)
                    raw = [v.tobytes() for _, v in part]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(buckets)), pa.array([part[i][0] for i in who], pa.int64()),
                         pa.array([raw[i] for i in who], pa.binary())], names=["bucket", "vec_id", "vector"])

    return run


def cosines(vectors, query):
    """Cosines of rows with a vector, in doubles; equal rows have equal results, wherever they stand."""
    import numpy as np

    def safe(x):
        most = np.abs(x).max(axis=-1, keepdims=True)
        return np.where((most > 1e150) | (most < 1e-150), x / most, x)

    vectors, query = safe(vectors), safe(query)
    norms = np.sqrt((vectors * vectors).sum(axis=1)) * np.sqrt((query * query).sum())
    return (vectors * query).sum(axis=1) / norms


def nearest_of_block(ids, vectors, query_ids, queries, k: int):
    """(query, id, score) of each query's ``k`` nearest in a block, itself left out; ties go to the smaller id.

    A matrix product finds all that can be among them, rounding included; only those are scored one by one.
    """
    import numpy as np

    def units(x):
        x = x / np.abs(x).max(axis=1, keepdims=True)
        return x / np.sqrt((x * x).sum(axis=1, keepdims=True))

    near = units(queries) @ units(vectors).T
    near[query_ids[:, None] == ids[None, :]] = -np.inf
    out = []
    for row, query_id, query in zip(near, query_ids.tolist(), queries):
        least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -2.0
        at = np.flatnonzero(row >= max(least - 1e-9, -2.0))
        scores = cosines(vectors[at], query)
        best = np.lexsort((ids[at], -scores))[:k]
        out.extend((query_id, int(ids[at[i]]), float(scores[i])) for i in best)
    return out


def _searched(k: int, most_queries: int = 512):
    """From rows sorted by block and side (vectors before queries): each query's nearest within each block."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def arrays(rows):
            raw = np.frombuffer(b"".join(r[1] for r in rows), np.float64)
            return np.array([r[0] for r in rows], dtype=np.int64), raw.reshape(len(rows), -1)

        def search():
            return nearest_of_block(*block, *arrays(queries), k) if block is not None and queries else []

        key, vectors, block, queries, found = None, [], None, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(5)]
            for bucket, salt, side, vec_id, vector in zip(*columns):
                if key != (bucket, salt):
                    found += search()
                    key, vectors, block, queries = (bucket, salt), [], None, []
                if side == 0:
                    vectors.append((vec_id, vector))
                    continue
                if block is None and vectors:
                    block, vectors = arrays(vectors), []
                if block is not None and block[1].shape[1] * 8 == len(vector):
                    queries.append((vec_id, vector))
                    if len(queries) >= most_queries:
                        found += search()
                        queries = []
            if len(found) > 5_000:
                yield _found_batch(found)
                found = []
        found += search()
        if found:
            yield _found_batch(found)

    return run


def _found_batch(found):
    import pyarrow as pa

    q, v, s = zip(*found)
    return pa.RecordBatch.from_arrays(
        [pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())],
        names=["query_id", "vec_id", "score"])


def nearest_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 5, plan: HashPlan = HashPlan(), block: int = 8_192,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score`` (cosine in doubles) of each query's ``k`` nearest candidates.

    Queries are the rows where ``is_query`` holds; candidates all other rows that share a visited bucket with it.
    Every usable vector is in every table, with a null id left out; vectors that are null, zero or not finite take no
    part, and vectors of different lengths don't meet. Rows that repeat an id and a vector count once in a result; of
    rows with one id and different vectors the better score counts. Equal scores go to the smaller id. A query whose
    buckets hold fewer than ``k`` candidates goes on through all blocks of vectors, exactly, so that it has ``k`` rows or
    all candidates there are; other columns are ignored.

    A bucket of more than ``block`` vectors is dealt out over several tasks, and its queries visit all of them; no
    bucket is capped. A task holds one block and some hundred queries, and gives at most ``k`` rows a query and block.
    """
    use = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull())
    base = use.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    asked = use.where(is_query).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    ddl = "bucket bigint, vec_id bigint, vector binary"
    index = base.mapInArrow(_hashed(plan, False), ddl)
    probes = asked.mapInArrow(_hashed(plan, True), ddl)
    sizes = base.mapInArrow(_hashed(plan, False), ddl).groupBy("bucket").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_parts"))
    found = written(_best(_meet(index, probes, sizes, k), k), "neighbours-found")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= k)
    short = asked.join(full, F.col("vec_id") == F.col("query_id"), "left_anti").select("vec_id", "v")
    once = _hashed(replace(plan, tables=1), False)
    if not short.isEmpty():
        by_length = F.octet_length("vector").cast("bigint")
        everything = base.mapInArrow(once, ddl).withColumn("bucket", by_length)
        parts = everything.groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("_parts"))
        rest = short.mapInArrow(once, ddl).withColumn("bucket", by_length)
        more = _meet(everything, rest, parts, k).select("query_id", "vec_id", "score")
        found = _best(found.select("query_id", "vec_id", "score").unionByName(more), k)
    return found.select("query_id", "rank", "vec_id", "score")


def _meet(index: DataFrame, probes: DataFrame, sizes: DataFrame, k: int) -> DataFrame:
    """(query_id, vec_id, score): at most ``k`` of every block of a bucket for each query that visits the bucket."""
    placed = index.join(sizes, "bucket").select(
        "bucket", F.pmod(F.xxhash64("vec_id"), F.col("_parts")).cast("int").alias("salt"), F.lit(0).alias("side"),
        "vec_id", "vector")
    visits = probes.join(sizes, "bucket").select(
        "bucket", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("salt"), F.lit(1).alias("side"),
        "vec_id", "vector")
    return placed.unionByName(visits).repartition("bucket", "salt").sortWithinPartitions("bucket", "salt", "side").mapInArrow(
        _searched(k), "query_id bigint, vec_id bigint, score double")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` candidates of each query, with their rank."""
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
