"""Near-duplicates: SimHash fingerprints that meet through Golay codewords of their segments."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.components import component_roots
from cardpulse.llm.shared import written

# Segments of a fingerprint, from the lowest bit: first bit and width. None is wider than a codeword.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# The generator polynomial of the binary Golay code of length 23 (fixed value).
GOLAY = 0b110001110101
# Links are found up to this distance; see ``segment_keys``.
MOST_BITS = 4
# A key with more fingerprints than this is dealt out in blocks over many tasks.
BLOCK = 20_000


@lru_cache(maxsize=1)
def golay_errors():
    """For each syndrome of 11 bits, the error patterns of weight up to 4 that have it: the one of weight 3 or less
    first, then, if that has weight 3, the five of weight 4; rows are filled up with the first.

    An error pattern leads to a codeword. Any word is 3 bits or less from exactly one codeword (the code is perfect),
    and two words up to 2 bits apart share a codeword of these patterns.
    """
    from itertools import combinations

    import numpy as np

    found: list[list[int]] = [[] for _ in range(1 << 11)]
    for weight in range(5):
        for bits in combinations(range(23), weight):
            pattern = sum(1 << b for b in bits)
            found[int(syndrome(np.array([pattern]))[0])].append(pattern)
    return np.array([(row + row[:1] * 6)[:6] for row in found], dtype=np.int64)


def syndrome(words):
    """The remainder of each 23-bit word by the generator."""
    import numpy as np

    rest = np.asarray(words, dtype=np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return rest


def codeword_indices(words):
    """Six codeword indices (12 bits) of each word, the nearest first; words near their codeword repeat that one."""
    return (words[:, None] ^ golay_errors()[syndrome(words)]) >> 11


def segment_keys(prints):
    """Keys of fingerprints, as (row, key, stored) arrays. Two fingerprints at most 4 bits apart share a key of which
    at least one of them is the stored side.

    By the pigeonhole, of three segments with 4 differing bits in all, either one is equal and another differs in 2
    bits or less, or one differs in 2 bits or less and the two others in 1 bit each. The first case: key = an equal
    segment with any shared codeword of another (33 bits or more); both sides are stored. The second: key = codewords
    of all three (36 bits). A word 1 bit off has the nearest codeword of the other among its own six, so the side whose
    word is even in a named segment, where one bit differs, is stored under its nearest codewords of those two segments
    with any of the third, and the odd side looks under all its triples.
    """
    import numpy as np

    prints = np.asarray(prints, dtype=np.uint64)
    n = len(prints)
    segments = [(prints >> np.uint64(at)).astype(np.int64) & ((1 << width) - 1) for at, width in SEGMENTS]
    codes = [codeword_indices(s) for s in segments]
    fresh = [np.ones((n, 6), bool) for _ in range(3)]  # a codeword that repeats the nearest makes no key again
    for f, c in zip(fresh, codes):
        f[:, 1:] = c[:, 1:] != c[:, :1]
    odd = [np.bitwise_count(s) % 2 == 1 for s in segments]
    rows, keys, stored = [], [], []

    def add(which, key, is_stored):
        rows.append(which)
        keys.append(key)
        stored.append(is_stored)

    for kind, (a, b) in enumerate((a, b) for a in range(3) for b in range(3) if a != b):
        for j in range(6):
            which = np.flatnonzero(fresh[b][:, j])
            add(which, (kind + 1) << 36 | segments[a][which] << 12 | codes[b][which, j], np.ones(len(which), bool))
    # The segment with two differing bits, and the one of the others whose parity tells the sides apart.
    roles = ((0, 1), (1, 2), (2, 1))
    for i in range(6):
        for j in range(6):
            for k in range(6):
                at = (i, j, k)
                store, look = np.zeros(n, bool), np.zeros(n, bool)
                for third, named in roles:
                    look |= odd[named]
                    if all(at[s] == 0 for s in range(3) if s != third):
                        store |= ~odd[named]
                which = np.flatnonzero(fresh[0][:, i] & fresh[1][:, j] & fresh[2][:, k] & (store | look))
                add(which, codes[0][which, i] << 24 | codes[1][which, j] << 12 | codes[2][which, k], store[which])
    return np.concatenate(rows), np.concatenate(keys), np.concatenate(stored)


def fingerprint(words: list[bytes], size: int) -> int:
    """Of the 64-bit hashes of all shingles of ``size`` words, the bits set in over half; 0 without words."""
    import numpy as np
    from xxhash import xxh64_intdigest

    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    begins = np.concatenate([[0], ends[:-1] + 1])
    count = max(1, len(words) - size + 1)
    last = ends[min(size, len(words)) - 1:].tolist()
    hashes = np.array([xxh64_intdigest(joined[b:e], 42) for b, e in zip(begins[:count].tolist(), last)], dtype=">u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, 65_536):
        ones += np.unpackbits(hashes[at:at + 65_536].view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big")


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return (text or "").encode().lower().split()


def _fingerprints(size: int):
    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            prints = np.array([fingerprint(words_of(t.as_py()), size) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"])

    return run


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, print) of every whole text; the fingerprint as a signed 64-bit number. Null texts have print 0."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _fingerprints(shingle), "doc_id bigint, print bigint")


def _keyed(batches: Iterator) -> Iterator:
    import numpy as np
    import pyarrow as pa

    for batch in batches:
        prints = batch.column(0).to_numpy()
        for at in range(0, len(prints), 5_000):
            part = np.ascontiguousarray(prints[at:at + 5_000])
            rows, keys, stored = segment_keys(part.view(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(part[rows]), pa.array(stored)], names=["key", "print", "stored"])


def forest(prints, stored, most: int):
    """(i, j), i < j: links that join what is at most ``most`` bits apart, one fewer than the members of each component.
    Pairs of which neither side is stored are left to another key.

    Of ``prints`` in ascending order, links are taken by their lesser and then their greater end. That order is the same
    in every key, so keys that hold the same texts give the same links, and these fold into one.
    """
    import numpy as np

    n = len(prints)
    root = np.arange(n)
    out = []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for at in range(0, n, 256):
        end = min(n, at + 256)
        near = np.bitwise_count(prints[at:end, None] ^ prints[None, at:]) <= most
        near &= stored[at:end, None] | stored[None, at:]
        near &= np.arange(at, end)[:, None] < np.arange(at, n)[None, :]
        left, right = np.nonzero(near)
        left, right = left + at, right + at
        open_ = root[left] != root[right]
        for i, j in zip(left[open_].tolist(), right[open_].tolist()):
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
        while (root != root[root]).any():
            root = root[root]
    return out


def _links(most: int, limit: int | None):
    """From rows (key, print, stored) sorted by key and print: links (key null) within each key, and the rows of a key
    that has more than ``limit``.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        def emit(key, a, b, stored):
            return pa.RecordBatch.from_arrays(
                [pa.array([key] * len(a), pa.int64()), pa.array(a), pa.array(b), pa.array(stored)],
                names=["key", "a", "b", "stored"])

        def within(keys, prints, stored):
            """Links of whole groups."""
            edge = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            sizes = np.diff(np.r_[edge, len(keys)])
            pairs = edge[sizes == 2]
            bits = prints.view(np.uint64)
            hit = pairs[(stored[pairs] | stored[pairs + 1]) & (np.bitwise_count(bits[pairs] ^ bits[pairs + 1]) <= most)]
            yield emit(None, prints[hit], prints[hit + 1], np.ones(len(hit), bool))
            for begin, size in zip(edge[sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                here = slice(begin, begin + size)
                if limit and size > limit:
                    yield emit(int(keys[begin]), prints[here], prints[here], stored[here])
                elif stored[here].any() and (found := forest(bits[here], stored[here], most)):
                    i, j = np.array(found).T + begin
                    yield emit(None, prints[i], prints[j], np.ones(len(i), bool))

        held: list = []  # the rows of the last key so far
        passed = None  # a key that is being passed on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = (batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False))
            if passed is not None and rows[0][0] == passed:
                n = int(np.searchsorted(rows[0], passed, "right"))
                yield emit(passed, rows[1][:n], rows[1][:n], rows[2][:n])
                rows = tuple(c[n:] for c in rows)
            if not len(rows[0]):
                continue
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            if last or held and held[0][0][0] != rows[0][0]:
                held.append(tuple(c[:last] for c in rows))
                yield from within(*[np.concatenate(c) for c in zip(*held)])
                held = []
            held.append(tuple(c[last:] for c in rows))
            if limit and sum(len(h[0]) for h in held) > limit:
                group = [np.concatenate(c) for c in zip(*held)]
                passed, held = int(group[0][0]), []
                yield emit(passed, group[1], group[1], group[2])
        if held:
            yield from within(*[np.concatenate(c) for c in zip(*held)])

    return run


def _in_blocks(rows: DataFrame) -> DataFrame:
    """The rows of large keys, dealt out: each goes to every pair of blocks that holds its own, under a key of its own
    for each pair of blocks. Memory is then two blocks a task, whatever a key's size.
    """
    sizes = rows.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / (BLOCK // 2)).cast("int").alias("_blocks"))
    own = F.pmod(F.xxhash64("print"), F.col("_blocks")).cast("int")
    return (
        rows.join(sizes, "key").withColumn("_own", own)
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .select(F.xxhash64("key", F.least("_own", "_other"), F.greatest("_own", "_other")).alias("key"), "print", "stored")
    )


def near_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct fingerprints (column print) at most ``MOST_BITS`` apart, directly or
    through others; no group is expanded into all its pairs. A link that several keys find is repeated.
    """
    def linked(rows, limit):
        return rows.repartition("key").sortWithinPartitions("key", "print").mapInArrow(
            _links(MOST_BITS, limit), "key bigint, a bigint, b bigint, stored boolean")

    # Few small rows that will become many. They may come grouped by print: another key makes this a shuffle of its own.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = prints.select("print").repartition(tasks, F.xxhash64("print")).mapInArrow(
        _keyed, "key bigint, print bigint, stored boolean")
    first = written(linked(keyed, BLOCK), "simhash-links")
    large = first.where("key is not null").select("key", F.col("a").alias("print"), "stored")
    return first.where("key is null").union(linked(_in_blocks(large), None)).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every document.

    Fingerprints of ``shingle`` words link at ``MOST_BITS`` or fewer differing bits; a component's id is the smallest
    doc_id in it. Texts without words share fingerprint zero and link like any other. Rows with a null id get the
    component of their fingerprint and never name one (its id is null where all ids are); repeated rows give repeated
    results; other columns are ignored; an empty table gives an empty result.

    Equal fingerprints are one node, so copies, however many, are never compared or linked with each other.
    """
    rows = written(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    distinct = rows.groupBy("print").agg(F.min("doc_id").alias("_least"))
    roots = component_roots(near_links(distinct), "simhash-component")
    members = distinct.join(roots.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "_root", F.coalesce("root", "print"))
    least = members.groupBy("_root").agg(F.min("_least").alias("component_id"))
    named = members.join(least, "_root").select("print", "component_id")
    return rows.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, shingle: int = 5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of each component of ``near_duplicates`` the document with the least id
    stays, with all its columns. Rows with a null id stay; of rows with one id all stay if one of them does.
    """
    gone = near_duplicates(docs, shingle, id_col, text_col).groupBy("doc_id").agg(
        F.bool_and(F.col("doc_id") != F.col("component_id")).alias("_gone")).where("_gone").select(
        F.col("doc_id").alias("_id"))
    return docs.join(gone, docs[id_col] == gone["_id"], "left_anti")
