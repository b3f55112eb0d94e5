"""Periodic runs of words: suffix trees of a text and its reversal answer how far a candidate's period extends."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A run has at least this many words (and two periods).
LEAST_WORDS = 12
# At least so many consecutive words of a run, half of the least length, stand again one period on.
GRAM = LEAST_WORDS // 2


def words_of(text: str | None) -> list[bytes]:
    """The words between ASCII white space, as bytes."""
    return (text or "").encode().split()


def repetitive_parts(ids) -> list[tuple[int, int]]:
    """Disjoint parts (begin, end) of a word sequence such that every run lies in one of them, most often none.

    The first words of a run, all but its last period, start sequences of ``GRAM`` words that occur again within the
    period; they are consecutive, and the period is at most ``GRAM - 1`` more than their number. So a start whose next
    occurrence is further away than its stretch of starts allows is in no run, which may shorten stretches further.
    Equal hashes of different sequences only make parts larger.
    """
    import numpy as np

    n = len(ids)
    if n < LEAST_WORDS:
        return []
    count = n - GRAM + 1
    hashes = np.zeros(count, dtype=np.uint64)
    for k in range(GRAM):
        hashes = hashes * np.uint64(0x9E3779B97F4A7C15) + ids[k:k + count].astype(np.uint64)
        hashes ^= hashes >> np.uint64(29)
    order = np.argsort(hashes, kind="stable")
    same = np.flatnonzero(hashes[order][1:] == hashes[order][:-1])
    if not len(same):
        return []
    starts, ahead = order[same], order[same + 1]
    by_place = np.argsort(starts)
    starts, gaps = starts[by_place], (ahead - starts)[by_place]
    while len(starts):
        edge = np.flatnonzero(np.r_[True, np.diff(starts) != 1])
        sizes = np.diff(np.r_[edge, len(starts)])
        keep = gaps <= np.repeat(sizes, sizes) + GRAM - 1
        if keep.all():
            break
        starts, gaps = starts[keep], gaps[keep]
    if not len(starts):
        return []
    parts: list[tuple[int, int]] = []
    for begin, size in zip(starts[edge].tolist(), sizes.tolist()):
        end = min(n, begin + 2 * size + 2 * GRAM)  # the stretch, its last words, and a last period
        if parts and begin <= parts[-1][1]:
            parts[-1] = (parts[-1][0], max(end, parts[-1][1]))
        else:
            parts.append((begin, end))
    return parts


def suffix_tree(s: list[int]):
    """Ukkonen's tree of ``s``, whose last element 0 occurs nowhere else. Inner nodes are numbered from the root, 0; the
    leaf of suffix j is ~j. Returns each inner node's children by first element, and its incoming label's length.
    """
    kids: list[dict[int, int]] = [{}]
    begin, end, link, leaf_begin = [0], [0], [0], []
    node = edge = length = 0
    waiting = 0  # suffixes that are in the tree only implicitly
    for i, c in enumerate(s):
        waiting += 1
        last = 0  # the node split before this one, which lacks its link
        while waiting:
            if not length:
                edge = i
            here = kids[node]
            first = s[edge]
            child = here.get(first)
            if child is None:
                here[first] = ~len(leaf_begin)
                leaf_begin.append(i)
                if last:
                    link[last] = node
                    last = 0
            else:
                if child >= 0:
                    at = begin[child]
                    span = end[child] - at
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                else:
                    at = leaf_begin[~child]
                if s[at + length] == c:
                    length += 1
                    if last:
                        link[last] = node
                    break
                split = len(kids)
                kids.append({s[at + length]: child, c: ~len(leaf_begin)})
                begin.append(at)
                end.append(at + length)
                link.append(0)
                leaf_begin.append(i)
                here[first] = split
                if child >= 0:
                    begin[child] = at + length
                else:
                    leaf_begin[~child] = at + length
                if last:
                    link[last] = split
                last = split
            waiting -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - waiting + 1
    return kids, [e - b for b, e in zip(begin, end)]


def leaf_tour(kids, spans):
    """The leaves of a tree from left to right, and for each the depth of the deepest node that it shares with the one
    before: the parts of the tree's Euler tour that decide on lowest common ancestors. Also the leaves in the order in
    which the end of the text comes after every word instead of before it.
    """
    leaves, depths, end_last = [], [], []
    stack = [(0, 0, 0)]
    pop, push = stack.pop, stack.append
    while stack:
        node, depth, shared = pop()
        if node < 0:
            if depth >= 0:
                leaves.append(~node)
                depths.append(shared)
            if depth <= 0:
                end_last.append(~node)
            continue
        depth += spans[node]
        order = sorted(kids[node].items())
        if order[0][0]:
            for _, child in order[:0:-1]:
                push((child, depth if child >= 0 else 0, depth))
        else:  # the end of the text: first in one order, last in the other
            push((order[0][1], -1, 0))
            for _, child in order[:0:-1]:
                push((child, depth if child >= 0 else 0, depth))
        child = order[0][1]
        push((child, depth if child >= 0 else 0 if order[0][0] else 1, shared))
    return leaves, depths, end_last


class CommonExtensions:
    """Longest common extensions of suffixes: the least depth between two leaves of the tour, from tables of minima over
    powers of two. All questions are asked at once, so one table is held at a time.
    """

    def __init__(self, leaves, depths):
        import numpy as np

        self.depths = np.array(depths, dtype=np.int64)
        self.rank = np.empty(len(leaves), dtype=np.int64)
        self.rank[leaves] = np.arange(len(leaves))

    def ask(self, i, j):
        """How many elements suffixes ``i`` and ``j`` (arrays, different suffixes) have in common."""
        import numpy as np

        one, two = self.rank[i], self.rank[j]
        low, high = np.minimum(one, two) + 1, np.maximum(one, two)
        level = np.frexp((high - low + 1).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        order = np.argsort(level, kind="stable")
        ends = np.searchsorted(level[order], np.arange(level.max(initial=-1) + 2))
        table = self.depths
        for k in range(len(ends) - 1):
            which = order[ends[k]:ends[k + 1]]
            out[which] = np.minimum(table[low[which]], table[high[which] - (1 << k) + 1])
            step = 1 << k
            table = np.minimum(table[:-step], table[step:]) if len(table) > step else table[:0]
        return out


def next_smaller(rank: list[int]) -> list[int]:
    """For each place the next one with a smaller rank; the last place has the least."""
    out = [0] * len(rank)
    stack = [len(rank) - 1]
    for i in range(len(rank) - 2, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1]
        stack.append(i)
    return out


def runs_of_part(ids: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all maximal periodic stretches of at least two periods.

    Every run holds a Lyndon root: the longest Lyndon word that starts at some place, in the order of words or in the
    reverse one; it reaches to the next smaller suffix. Its period extends to the right as far as the suffixes at its
    two ends agree, and to the left likewise in the reversed text.
    """
    import numpy as np

    n = len(ids)
    text = [i + 1 for i in ids]
    leaves, depths, end_last = leaf_tour(*suffix_tree([*text, 0]))
    right = CommonExtensions(leaves, depths)
    turned, turned_depths, _ = leaf_tour(*suffix_tree([*reversed(text), 0]))
    left = CommonExtensions(turned, turned_depths)
    reverse_rank = np.empty(n + 1, dtype=np.int64)
    reverse_rank[end_last] = np.arange(n, -1, -1)
    place = np.arange(n)
    found = []
    for rank in (right.rank.tolist(), reverse_rank.tolist()):
        after = np.array(next_smaller(rank)[:n], dtype=np.int64)
        ahead = right.ask(place, after)
        back = left.ask(n - place, n - after)
        hit = np.flatnonzero(ahead + back >= after - place)
        found.append(np.stack([place[hit] - back[hit], (after + ahead - place + back)[hit], (after - place)[hit]], axis=1))
    return [tuple(r) for r in np.unique(np.concatenate(found), axis=0).tolist()]


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run of ``words``, by start and period: a stretch with this smallest period, of at
    least two periods and ``LEAST_WORDS`` words, which no neighbouring word extends.
    """
    import numpy as np

    known: dict = {}
    number = known.setdefault
    ids = np.array([number(w, len(known)) for w in words], dtype=np.int64)
    out = []
    for begin, end in repetitive_parts(ids):
        part = np.unique(ids[begin:end], return_inverse=True)[1].tolist()
        out += [(begin + s, size, p) for s, size, p in runs_of_part(part) if size >= LEAST_WORDS]
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept_words(words: list[bytes], runs) -> list[bytes]:
    """The words but those that a run holds after its first period."""
    from itertools import compress

    import numpy as np

    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    table = np.array(runs)
    np.add.at(change, table[:, 0] + table[:, 2], 1)
    np.add.at(change, table[:, 0] + table[:, 1], -1)
    return list(compress(words, (np.cumsum(change[:-1]) == 0).tolist()))


RUN_DDL = "array<struct<start: bigint, length: bigint, period: bigint>>"


def _rows(arrange: Callable | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.list_(pa.struct([(name, pa.int64()) for name in ("start", "length", "period")]))
        for batch in batches:
            counts, found, texts = [], [], []
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                words = words_of(text.as_py())
                if arrange is not None:
                    words = arrange(doc_id.as_py(), words)
                runs = find_runs(words)
                counts.append(len(words))
                found.append([dict(zip(("start", "length", "period"), r)) for r in runs])
                texts.append(b" ".join(kept_words(words, runs)).decode())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(found, kind), pa.array(texts, pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, arrange: Callable | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` (by start, then period) and ``collapsed``, the text without the repetitions in
    runs, of every document; ``arrange`` may change (id, words) to other words before.

    Null and empty texts have no words and no runs, their collapsed text is empty; repeated rows give repeated results;
    null ids stay null; other columns are ignored; an empty table gives an empty result. Texts are worked on whole, each
    where it is read; memory is a few hundred bytes a word of the longest repetitive part.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _rows(arrange), f"doc_id {kind}, n_words bigint, runs {RUN_DDL}, collapsed string")
