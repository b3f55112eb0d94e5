"""Repeated strings across and inside documents: hash-compared suffixes at sampled positions."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import written

# An odd multiplier of the prefix hashes, its inverse modulo 2^64, and the seed of the bytes' values (fixed values).
BASE = 0x9E3779B97F4A7C15
SEED = 20_240_117


@lru_cache(maxsize=1)
def _byte_values():
    import numpy as np

    return np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


class _Powers:
    """Powers of the base and of its inverse, grown as longer documents come."""

    def __init__(self):
        import numpy as np

        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int):
        import numpy as np

        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            with np.errstate(over="ignore"):
                for name, step in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                    powers = np.full(size, step, dtype=np.uint64)
                    powers[0] = 1
                    setattr(self, name, np.multiply.accumulate(powers))
        return self.up[:n], self.down[:n]


_POWERS = None


class PrefixHashes:
    """Polynomial hashes of all prefixes of a text; any substring's hash is a difference of two of them."""

    def __init__(self, raw: bytes):
        import numpy as np

        global _POWERS
        if _POWERS is None:
            _POWERS = _Powers()
        values = _byte_values()[np.frombuffer(raw, np.uint8)]
        up, self.down = _POWERS.upto(len(raw) + 1)
        self.sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(values * up[:-1], out=self.sums[1:])

    def windows(self, starts, lengths):
        """Mixed hashes of the substrings at ``starts``; equal substrings have equal ones."""
        import numpy as np

        mixed = (self.sums[starts + lengths] - self.sums[starts]) * self.down[starts]
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return mixed

    def all_windows(self, length: int):
        import numpy as np

        count = len(self.sums) - length
        mixed = (self.sums[length:] - self.sums[:count]) * self.down[:count]
        mixed ^= mixed >> np.uint64(33)
        mixed *= np.uint64(0xFF51AFD7ED558CCD)
        mixed ^= mixed >> np.uint64(33)
        return mixed


def sliding_least(values, width: int):
    """The least of every ``width`` successive values."""
    import numpy as np

    count = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, dtype=values.dtype)
    padded[:len(values)] = values
    shaped = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:count], ahead[width - 1:width - 1 + count])


def anchors(hashes: PrefixHashes, length: int, core: int):
    """(anchor, first, last, core hash) arrays: every start of a ``length``-byte string belongs to one anchor, the place
    of the least core hash inside its string; ``first`` to ``last`` are the starts of an anchor. Equal strings have
    their anchor at the same place, so they can only be found among anchors with equal cores.
    """
    import numpy as np

    cores = hashes.all_windows(core)
    at = np.arange(len(cores), dtype=np.uint64)
    ranked = (cores & np.uint64(0xFFFFFFFF00000000)) | at
    chosen = (sliding_least(ranked, length - core + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]])
    last = np.r_[first[1:], len(chosen)] - 1
    anchor = chosen[first]
    return anchor, first, last, cores[anchor]


# A place is one number: 14 bits of the text's own hash, 31 bits of the anchor's place, 9 bits for the bytes before it
# that its strings cover, and 9 bits for the number of starts. The tag keeps texts apart that share an id.
def pack_places(tag: int, anchor, first, last):
    return (tag << 49) | (anchor << 18) | ((anchor - first) << 9) | (last - first)


def unpack_place(place: int) -> tuple[int, int, int, int]:
    """(tag, first start, last start, anchor)."""
    anchor = place >> 18 & 0x7FFFFFFF
    first = anchor - (place >> 9 & 0x1FF)
    return place >> 49, first, first + (place & 0x1FF), anchor


def _tag(raw: bytes) -> int:
    from zlib import crc32

    return crc32(raw) & 0x3FFF


def _digest(data: bytes, size: int, salt: bytes = b"") -> bytes:
    """``size`` bytes of a digest, as the eight bytes of a number."""
    from hashlib import blake2b

    return blake2b(data, digest_size=size, salt=salt).digest().ljust(8, b"\0")


def _core_hashes(length: int, core: int):
    """The core hash of every anchor."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for value in batch.column(0):
                raw = (value.as_py() or "").encode()
                if len(raw) >= length:
                    cores = anchors(PrefixHashes(raw), length, core)[3]
                    yield pa.RecordBatch.from_arrays([pa.array(cores.view(np.int64))], names=["core"])

    return run


def _anchor_rows(length: int, core: int, digest_bytes: int):
    """(core, body, doc_id, place) of all anchors: the hash of the core and a digest of all bytes that the strings of
    the anchor cover, with their place around it.
    """

    def run(batches: Iterator) -> Iterator:
        import struct

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for doc_id, value in zip(batch.column(0), batch.column(1)):
                raw = (value.as_py() or "").encode()
                if len(raw) < length:
                    continue
                at, first, last, cores = anchors(PrefixHashes(raw), length, core)
                around = (at - first) << 9 | (last - first)
                body = b"".join(
                    _digest(raw[f:e + length], digest_bytes, struct.pack("<q", w))
                    for f, e, w in zip(first.tolist(), last.tolist(), around.tolist()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cores.view(np.int64)), pa.array(np.frombuffer(body, "<i8")),
                     pa.array([doc_id.as_py()] * len(at), pa.int64()), pa.array(pack_places(_tag(raw), at, first, last))],
                    names=["core", "body", "doc_id", "place"])

    return run


def _contexts(length: int, bytes_at_once: int = 4 << 20):
    """(core, body, doc_id, place, context): the bytes that the strings of wanted anchors cover."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def made(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                names=["core", "body", "doc_id", "place", "context"])

        for batch in batches:
            rows, held = [], 0
            for doc_id, text, wanted in zip(*(batch.column(i) for i in range(3))):
                raw = (text.as_py() or "").encode()
                tag = _tag(raw)
                for want in wanted.as_py():
                    own, first, last, _ = unpack_place(want["place"])
                    if own == tag and last + length <= len(raw):
                        rows.append((want["core"], want["body"], doc_id.as_py(), want["place"], raw[first:last + length]))
                        held += last + length - first
                        if held >= bytes_at_once:
                            yield made(rows)
                            rows, held = [], 0
            if rows:
                yield made(rows)

    return run


def common_extension(sums, down, a: int, b: int, most: int) -> int:
    """How many bytes from ``a`` and ``b`` on are equal, up to ``most``: a binary search over prefix hashes."""
    low, high = 0, most
    while low < high:
        half = (low + high + 1) >> 1
        if ((sums[a + half] - sums[a]) * down[a] - (sums[b + half] - sums[b]) * down[b]) & 0xFFFFFFFFFFFFFFFF:
            high = half - 1
        else:
            low = half
    return low


def sort_suffixes(hashes: PrefixHashes, raw: bytes, groups: list[list[int]], at: list[int], room: list[int]) -> list[int]:
    """Rows, group by group, in the order of the bytes from ``at`` on (``room`` of them). Python's merge sort asks for
    few comparisons, and each takes a logarithmic number of hash comparisons.
    """
    from functools import cmp_to_key

    sums, down = memoryview(hashes.sums), memoryview(hashes.down)

    def compare(i, j):
        most = min(room[i], room[j])
        same = common_extension(sums, down, at[i], at[j], most)
        if same == most:
            return room[i] - room[j]
        return raw[at[i] + same] - raw[at[j] + same]

    return [row for group in groups for row in (sorted(group, key=cmp_to_key(compare)) if len(group) > 1 else group)]


def repeated_starts(cores: list[int], contexts: list[bytes], before: list[int], length: int):
    """For each context the starts (bool array) of ``length``-byte strings that another context has as well.

    Contexts with one core hash are sorted by the suffixes at their anchors. With ``back`` bytes before the anchor, two
    strings are equal if their suffixes agree for the other ``length - back`` bytes, which neighbours in the order
    tell, and the bytes before do. Each match is verified byte by byte.
    """
    import numpy as np

    n = len(contexts)
    raw = b"".join(contexts)
    offset = np.cumsum([0] + [len(c) for c in contexts])
    hashes = PrefixHashes(raw)
    before_all = np.array(before)
    width = np.diff(offset) - length
    anchor = offset[:-1] + before_all
    room = offset[1:] - anchor
    groups: dict[int, list[int]] = {}
    for row, c in enumerate(cores):
        groups.setdefault(c, []).append(row)
    order = np.array(sort_suffixes(hashes, raw, list(groups.values()), anchor.tolist(), room.tolist()))
    group_of = np.array(cores)[order]
    # Common extensions of neighbours in the order, all at once.
    a, b = anchor[order[:-1]], anchor[order[1:]]
    low = np.zeros(max(0, n - 1), dtype=np.int64)
    high = np.where(group_of[:-1] == group_of[1:], np.minimum(room[order[:-1]], room[order[1:]]), 0)
    while (low < high).any():
        half = (low + high + 1) >> 1
        same = hashes.windows(a, half) == hashes.windows(b, half)
        low, high = np.where(same, half, low), np.where(same, high, half - 1)
    found = [np.zeros(w + 1, dtype=bool) for w in width.tolist()]
    partner = {}
    sorted_before, sorted_width, sorted_anchor = before_all[order], width[order], anchor[order]
    for back in range(int((before_all - width).min()), int(before_all.max()) + 1):
        fits = np.flatnonzero((sorted_before >= back) & (sorted_before - sorted_width <= back))
        if len(fits) < 2:
            continue
        run = np.r_[0, np.cumsum(low < length - back)][fits].astype(np.uint64)
        starts = sorted_anchor[fits] - back
        keys = hashes.windows(starts, np.full(len(fits), back)) ^ (run * np.uint64(0xD6E8FEB86659FD93))
        by = np.argsort(keys, kind="stable")
        equal = keys[by[1:]] == keys[by[:-1]]
        for left, right in zip(fits[by[:-1][equal]].tolist(), fits[by[1:][equal]].tolist()):
            i, j = int(order[left]), int(order[right])
            span = partner.setdefault((i, j), [back, back])
            if back > span[1] + 1:  # a gap: these starts are a match of their own
                _confirm(contexts, before, found, i, j, span, length)
                span[:] = [back, back]
            span[1] = back
    for (i, j), span in partner.items():
        _confirm(contexts, before, found, i, j, span, length)
    return found


def _confirm(contexts, before, found, i, j, span, length):
    """Marks the starts of a match after comparing its bytes."""
    least, most = span
    one = contexts[i][before[i] - most:before[i] - least + length]
    two = contexts[j][before[j] - most:before[j] - least + length]
    if one != two:
        raise ValueError("a hash collision between different strings; choose another seed")
    for row in (i, j):
        found[row][before[row] - most:before[row] - least + 1] = True


def _group_spans(length: int, rows_at_once: int = 4_000):
    """From contexts sorted by core: (doc_id, place, begin, end) of the bytes that repeated strings cover."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def spans(rows):
            if len(rows) < 2:
                return None
            places = [unpack_place(r[2]) for r in rows]
            found = repeated_starts([r[0] for r in rows], [r[4] for r in rows], [p[3] - p[1] for p in places], length)
            out = []
            for row, place, marks in zip(rows, places, found):
                if row[3] and marks.any():
                    edge = np.flatnonzero(np.diff(np.r_[0, marks.astype(np.int8), 0]))
                    out += [(row[1], row[2] >> 49, place[1] + b, place[1] + e - 1 + length)
                            for b, e in zip(edge[::2].tolist(), edge[1::2].tolist())]
            if not out:
                return None
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], names=["doc_id", "tag", "begin", "end"])

        held: list = []
        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if len(held) >= rows_at_once and row[0] != held[-1][0]:
                    if (made := spans(held)) is not None:
                        yield made
                    held = []
                held.append(row)
        if (made := spans(held)) is not None:
            yield made

    return run


def _window_rows(length: int, digest_bytes: int):
    """(one, two, core, body, doc_id, tag, begin, single) of every start of contexts: a hash and a digest of each string."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for core, doc_id, place, single, context, body in zip(*(batch.column(i).to_pylist() for i in range(6))):
                tag, first, last, _ = unpack_place(place)
                n = last - first + 1
                one = PrefixHashes(context).all_windows(length) >> np.uint64(64 - 8 * digest_bytes)
                two = b"".join(_digest(context[s:s + length], digest_bytes) for s in range(n))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(one.view(np.int64)), pa.array(np.frombuffer(two, "<i8"))]
                    + [pa.array([v] * n, pa.int64()) for v in (core, body, doc_id, tag)]
                    + [pa.array(np.arange(first, last + 1)), pa.array([single] * n)],
                    names=["one", "two", "core", "body", "doc_id", "tag", "begin", "single"])

    return run


def _strings(length: int):
    """From (place, context, starts): (one, two, string) with the bytes of the wanted starts of a context."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for place, context, starts in zip(*(batch.column(i).to_pylist() for i in range(3))):
                first = unpack_place(place)[1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s["one"] for s in starts], pa.int64()), pa.array([s["two"] for s in starts], pa.int64()),
                     pa.array([context[s["begin"] - first:s["begin"] - first + length] for s in starts], pa.binary())],
                    names=["one", "two", "string"])

    return run


def _same_bytes(grouped: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand for more than one row, with their number ``n``, from (keys, bytes, n) grouped by keys and bytes.
    Where a key stands for two different strings of bytes the query fails instead of taking them for equal.
    """
    return grouped.groupBy(*keys).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("_texts")).where(
        F.when(F.col("_texts") == 1, F.col("n") > 1).otherwise(
            F.raise_error("two different strings share a digest").cast("boolean"))).drop("_texts")


def _rows_of(rows: DataFrame, counted: DataFrame, keys: list[str], hot_rows: int) -> DataFrame:
    """The rows whose keys ``counted`` (keys, n) holds. Rows of a key that stands for more than ``hot_rows`` of them are not
    shuffled, since they would all meet in one task: such keys, at most one in ``hot_rows`` rows, are broadcast.
    """
    hot = F.broadcast(counted.where(F.col("n") > hot_rows).select(*keys))
    return rows.join(hot, keys, "left_semi").union(
        rows.join(hot, keys, "left_anti").join(counted.where(F.col("n") <= hot_rows), keys, "left_semi"))


def _hot_spans(contexts: DataFrame, length: int, digest_bytes: int, hot_rows: int) -> DataFrame:
    """The same spans for cores with too many different surroundings for one task: strings are counted by hash and
    digest, and those found more than once are then grouped by their bytes. Both counts have map-side sums, so a string
    that every document has is one row of each task.
    """
    rows = written(contexts.mapInArrow(
        _window_rows(length, digest_bytes),
        "one bigint, two bigint, core bigint, body bigint, doc_id bigint, tag bigint, begin bigint, single boolean"),
        "suffix-strings")
    several = rows.groupBy("one", "two").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = written(_rows_of(rows, written(several, "suffix-counted"), ["one", "two"], hot_rows), "suffix-again")
    starts = again.groupBy("core", "body").agg(F.collect_list(F.struct("one", "two", "begin")).alias("starts"))
    strings = contexts.join(starts, ["core", "body"]).select("place", "context", "starts").mapInArrow(
        _strings(length), "one bigint, two bigint, string binary")
    equal = written(_same_bytes(
        strings.groupBy("one", "two", "string").agg(F.count(F.lit(1)).alias("n")), ["one", "two"]), "suffix-equal")
    return _rows_of(again.where("single"), equal, ["one", "two"], hot_rows).select(
        "doc_id", "tag", "begin", (F.col("begin") + length).alias("end"))


def _removed(length: int):
    """From (doc_id, text, spans): what is left of each text, as bytes, and how much went."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            rows = []
            for text, spans in zip(batch.column(1), batch.column(2)):
                raw = (text.as_py() or "").encode()
                tag = _tag(raw)
                kept, upto, removed, runs = [], 0, 0, 0
                end = -1
                for begin, stop in sorted((s["begin"], s["end"]) for s in spans.as_py() or () if s["tag"] == tag):
                    if begin > end:
                        runs += 1
                        kept.append(raw[upto:begin])
                    removed += max(0, stop - max(begin, end))
                    end = upto = max(end, stop)
                kept.append(raw[upto:])
                rows.append((len(raw), removed, runs, b"".join(kept)))
            n, gone, runs, left = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()),
                 pa.array(left, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def repeated_spans(docs: DataFrame, length: int = 400, core: int = 100, most_in_task: int = 8_000,
                   digest_bytes: int = 8, hot_rows: int = 10_000) -> DataFrame:
    """(doc_id, tag, begin, end): bytes covered by strings of ``length`` bytes that start elsewhere too. Spans overlap.

    1. Anchors with a core that no other anchor has can't repeat; they end here, and they are most.
    2. The others are grouped by core, digest and the bytes that their strings cover; anchors that cover exactly the
       same bytes as another's repeat as a whole. The bytes are a key of the group, with map-side sums. Those that
       over ``hot_rows`` anchors have are found without a shuffle of their anchors.
    3. Different surroundings of one core meet once each, with their bytes; suffixes are sorted and matched
       (``repeated_starts``). A core with more than ``most_in_task`` of them goes to ``_hot_spans`` instead.

    Digests of ``digest_bytes`` bytes only bring equal strings together; bytes are compared in every step, and the query
    fails where a digest stands for two strings.
    """
    core = max(core, length - 511)  # a place has room for 512 starts
    # Here and below the small side of a join is written first, so that the join shuffles both sides itself and a key
    # that very many anchors share can be split.
    keys = written(
        docs.select("text").mapInArrow(_core_hashes(length, core), "core bigint").groupBy("core")
        .agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("core"), "suffix-cores")
    rows = written(
        docs.mapInArrow(_anchor_rows(length, core, digest_bytes), "core bigint, body bigint, doc_id bigint, place bigint")
        .join(keys, "core"), "suffix-anchors")
    wanted = rows.groupBy("doc_id").agg(F.collect_set(F.struct("core", "body", "place")).alias("wanted")).withColumnRenamed(
        "doc_id", "_id")
    contexts = docs.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "wanted").mapInArrow(
        _contexts(length), "core bigint, body bigint, doc_id bigint, place bigint, context binary")
    # Of a group with several members the least id and the least place are kept, which need not belong together: its place
    # tells the shape of the surroundings, and only groups with one member are reported by id.
    surroundings = written(
        contexts.groupBy("core", "body", "context").agg(
            F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id"), F.min("place").alias("place")),
        "suffix-surroundings")
    equal = _rows_of(
        rows, written(_same_bytes(surroundings, ["core", "body"]), "suffix-whole"), ["core", "body"], hot_rows)
    anchor = F.shiftright("place", 18).bitwiseAND(0x7FFFFFFF)
    first = anchor - F.shiftright("place", 9).bitwiseAND(0x1FF)
    whole = equal.select(
        "doc_id", F.shiftright("place", 49).alias("tag"), first.alias("begin"),
        (first + F.col("place").bitwiseAND(0x1FF) + length).alias("end"))

    sizes = written(
        surroundings.groupBy("core").agg(F.count(F.lit(1)).alias("_size")).where("_size > 1"), "suffix-sizes")
    # Written as well, because a join by core may be split, and the sorts below need each core in one task.
    several = written(surroundings.join(sizes, "core").select(
        "core", "doc_id", "place", (F.col("n") == 1).alias("single"), "context", "body", "_size"), "suffix-contexts")
    spans = whole.union(
        several.where(F.col("_size") <= most_in_task).drop("body", "_size").repartition("core")
        .sortWithinPartitions("core", "doc_id", "place")
        .mapInArrow(_group_spans(length), "doc_id bigint, tag bigint, begin bigint, end bigint"))
    if sizes.where(F.col("_size") > most_in_task).limit(1).count():
        spans = spans.union(_hot_spans(several.where(F.col("_size") > most_in_task), length, digest_bytes, hot_rows))
    return spans


def remove_repeats(docs: DataFrame, length: int = 400, core: int = 100, most_in_task: int = 8_000,
                   id_col: str = "doc_id", text_col: str = "text", digest_bytes: int = 8,
                   hot_rows: int = 10_000) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the remaining bytes) of every document.

    Every byte goes that a string of ``length`` bytes covers which also starts anywhere else, in this or another
    document; strings are judged on the input, may overlap, and never cross documents. Texts are their UTF-8 bytes;
    null is empty. A row that repeats id and text is a document like others, so both lose all their strings. Rows with
    one id and different texts stay apart by a tag of the text. Other columns are ignored; an empty table gives an
    empty result.
    """
    base = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    spans = repeated_spans(base, length, core, most_in_task, digest_bytes, hot_rows).groupBy("doc_id").agg(
        F.collect_list(F.struct("tag", "begin", "end")).alias("spans")).withColumnRenamed("doc_id", "_id")
    return base.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")), "left").select("doc_id", "text", "spans").mapInArrow(
        _removed(length), "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
