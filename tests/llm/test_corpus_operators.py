"""Runs, the filter audit and the mix against plain restatements."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import permutations
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cardpulse.llm import filter_audit, mixing, periodic_runs, queries

SMALL = "/root/testdata/sf0.001"


def runs_by_brute_force(words):
    """Every stretch that keeps some distance between equal words, with no smaller period."""
    known = {}
    x = np.array([known.setdefault(w, len(known)) for w in words], dtype=np.int64)
    out = []
    for q in range(1, len(x) // 2 + 1):
        change = np.diff(np.r_[False, x[:-q] == x[q:], False].astype(np.int8))
        for s, e in zip(np.flatnonzero(change == 1).tolist(), np.flatnonzero(change == -1).tolist()):
            size = e - s + q
            if size >= max(12, 2 * q):
                part = x[s:s + size]
                if not any((part[k:] == part[:-k]).all() for k in range(1, q)):
                    out.append((s, size, q))
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_random_words():
    rnd = random.Random(1)
    for _ in range(1_500):
        n, kinds = rnd.randint(0, 80), rnd.choice([1, 2, 2, 3, 5])
        words = [rnd.randrange(kinds) for _ in range(n)]
        if n and rnd.random() < 0.6:
            a = rnd.randrange(n)
            p = rnd.randint(1, max(1, (n - a) // 2))
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        if n and rnd.random() < 0.4:
            words[rnd.randrange(n)] = "other"
        assert periodic_runs.find_runs(words) == runs_by_brute_force(words)


def test_suffix_tree_gives_suffixes_in_order_and_common_extensions():
    rnd = random.Random(3)
    for _ in range(200):
        s = [rnd.randint(1, 3) for _ in range(rnd.randint(1, 40))] + [0]
        leaves, depths, end_last = periodic_runs.leaf_tour(*periodic_runs.suffix_tree(s))
        assert leaves == sorted(range(len(s)), key=lambda i: s[i:])
        assert end_last == sorted(range(len(s)), key=lambda i: [x or 9 for x in s[i:]])
        pairs = [(i, j) for i in range(len(s)) for j in range(len(s)) if i != j]
        got = periodic_runs.CommonExtensions(leaves, depths).ask(*np.array(pairs).T)
        assert got.tolist() == [next(k for k in range(len(s)) if s[i + k] != s[j + k]) for i, j in pairs]


def test_op11_on_a_whole_table(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    want = set()
    for doc_id, text in docs.items():
        words = (text or "").encode().split()
        h = crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = runs_by_brute_force(words)
        dropped = {i for s, size, q in runs for i in range(s + q, s + size)}
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        lines = "".join(f"{s},{size},{q}\n" for s, size, q in runs)
        want.add((doc_id, len(runs), *best, best[0] if best[0] is None else 1000 * best[1] // best[2],
                  hashlib.sha256(lines.encode()).hexdigest(),
                  hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest()))
    got = queries.op11_runs(spark, SMALL)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {tuple(r) for r in got.collect()} == want and len({w[1] for w in want}) > 2


def test_least_squares_is_the_average_over_all_orders():
    for n in (2, 3, 4, 5):
        weights = filter_audit.shapley_weights(n)
        rnd = random.Random(n)
        value = [0] + [rnd.randint(0, 1_000) for _ in range((1 << n) - 1)]
        for i in range(n):
            total = 0
            for order in permutations(range(n)):
                before = sum(1 << j for j in order[:order.index(i)])
                total += value[before | 1 << i] - value[before]
            assert sum(w * v for w, v in zip(weights[i], value)) == total
    assert filter_audit.solve([[Fraction(0), Fraction(2)], [Fraction(3), Fraction(0)]], [[Fraction(4)], [Fraction(9)]]) == [[3], [2]]


def test_each_filter_at_its_limit(spark):
    fifty = " ".join(f"w{i}" for i in range(50))
    texts = {
        1: (fifty, ""), 2: (fifty.rsplit(" ", 1)[0], "A"), 3: (" ".join(["a"] * 35 + [f"w{i}" for i in range(64)] + ["b"]), ""),
        4: (" ".join(["a"] * 36 + [f"w{i}" for i in range(64)]), ""), 5: (" ".join(["a"] * 37 + [f"w{i}" for i in range(63)]), "B"),
        6: ("AÉ" + "é" * 18 + " " + fifty, ""), 7: (fifty + "|", "D"), 8: (fifty, "E"), 9: (None, "A"), 10: ("", "AE"), 11: ("A" * 5 + "x" * 95, "A"),
        12: ("A" * 6 + "é" * 94, "AC"), 13: (fifty.upper(), "C")}
    df = spark.createDataFrame([(i, t, "s") for i, (t, _) in texts.items()], "doc_id int, text string, source string")
    got = {r.doc_id: "".join(f for k, f in enumerate("ABCDE") if r.mask >> k & 1) for r in filter_audit.failures(df).collect()}
    assert got == {i: f for i, (_, f) in texts.items()}


def test_audit_edges(spark):
    rows = [(1, "a b", None), (2, "a b", None), (2, "a b", ""), (None, "a b", "x"), (None, None, "x"), (3, "", "x"), (4, None, "y")]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id bigint, text string, source string, part int, mask string")
    labels = spark.createDataFrame([(2, 1, 0), (2, 0, 1), (None, 1, 1), (4, None, None)], "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(docs, labels).collect()
    assert Counter(r.part for r in got) == {"": 600, "x": 600, "y": 600}
    first = {(r.part, r.filter_order): r for r in got if r.step == 1}
    assert [getattr(first["", "EABCD"], c) for c in ("kept", "removed", "unique_fails", "good_lost", "toxic_lost")] == [1, 2, 0, 2, 2]
    assert first["x", "EABCD"].removed == 0 and first["y", "EABCD"].removed == 1
    assert all(sum(r.removed for r in got if (r.part, r.filter_order) == ("x", o)) == 3 for o in ("ABCDE", "EDCBA"))
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    assert filter_audit.audit(docs, labels.limit(0)).agg(F.sum("good_lost")).first()[0] == 0


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Sizes by source to targets by resharing the excess until no source is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, left = {}, set(order), Fraction(share) * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        above = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not above:
            target |= {s: level * weight[s] for s in open_}
            break
        for s in above:
            target[s] = Fraction(most * sizes[s])
            left -= target[s]
        open_ -= above
    return target


def check_mix(mix, docs, block):
    """All rules of a mix at once."""
    sizes = {}
    for _, text, source in docs:
        sizes[source] = sizes.get(source, 0) + len((text or "").encode().split())
    target = plain_targets(sizes)
    rows = mixing.taken_words(mix).collect()
    assert Counter((r.doc_id, r["size"]) for r in rows) == Counter((i, len((t or "").encode().split())) for i, t, _ in docs)
    for r in rows:
        assert 0 <= r.taken <= 2 * r["size"]
    source_of = defaultdict(set)
    for i, text, source in docs:
        source_of[i, len((text or "").encode().split())].add(source)
    pieces = mix.pieces.collect()
    taken, shard_size, seen = Counter(), Counter(), defaultdict(list)
    for p in pieces:
        taken[p.row.key] += p.length
        shard_size[p.shard] += 1
        seen[p.row, p.epoch].append((p.start, p.length))
    for spans in seen.values():
        spans.sort()
        assert all(a + n <= b for (a, n), (b, _) in zip(spans, spans[1:]))
    key = {None: "~"} | {s: "=" + s for s in sizes if s is not None}
    for s, want in target.items():
        assert taken[key[s]] == int(want + Fraction(1, 2))
    for r in mix.documents.collect():
        s = None if r.row.key == "~" else r.row.key[1:]
        assert r.source_size == sizes[s] and math.isclose(r.target, float(target[s]), rel_tol=1e-12, abs_tol=1e-12)
    return pieces


def mixed_docs():
    rnd = random.Random(5)
    docs = [(i, " ".join(["w"] * rnd.choice([0, 1, 5, 40, 333])), rnd.choice(["a", "a", "a", "é", "Z", "", None])) for i in range(300)]
    return docs + [(7, "x y", "a"), (7, "x y", "a"), (None, "n n n", "tiny"), (None, None, None), (900, "one " * 5_000, "big")]


def test_mix_of_a_small_table(spark):
    docs = mixed_docs()
    df = spark.createDataFrame([(*d, 1, "k", 3) for d in docs], "doc_id bigint, text string, source string, size int, key string, row int")
    pieces = check_mix(mixing.Mix(df, block=64, shards=4), docs, 64)
    blocks = defaultdict(set)
    for p in pieces:
        blocks[p.row.key, p.epoch, p.block].add(p.shard)
    assert all(len(s) == 1 for s in blocks.values())  # a block is dealt out whole
    of = Counter(s for shards in blocks.values() for s in shards)
    assert set(of) == {0, 1, 2, 3} and max(of.values()) - min(of.values()) <= 1
    again = mixing.Mix(df.repartition(3), block=64, shards=4)
    key = lambda p: (p.row.key, p.row.at, p.epoch, p.start, p.length, p.shard)
    assert sorted(map(key, again.pieces.collect())) == sorted(map(key, pieces))
    other = mixing.Mix(df, block=64, shards=4, seed=1)
    assert sorted(map(key, other.pieces.collect())) != sorted(map(key, pieces))
    shuffled = again.shuffled().withColumn("task", F.spark_partition_id()).collect()
    assert len(shuffled) == len(pieces) and len({(r.shard, r.task) for r in shuffled}) == 4
    assert mixing.taken_words(mixing.Mix(df.limit(0))).count() == 0
    empty = mixing.taken_words(mixing.Mix(df.withColumn("text", F.lit(None).cast("string")))).collect()
    assert len(empty) == len(docs) and {(r.target, r.taken) for r in empty} == {(0.0, 0)}


def test_op13_on_a_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "source").collect()]
    sizes, source = Counter(), {}
    for i, text, s in docs:
        sizes[s] += len((text or "").encode().split())
        source[i] = s
    target, taken = plain_targets(sizes), Counter()
    got = queries.op13_mixing(spark, SMALL)
    assert got.columns == ["doc_id", "size", "source_size", "target", "taken"]
    for r in got.collect():
        taken[source[r.doc_id]] += r.taken
        assert math.isclose(r.target, float(target[source[r.doc_id]]), rel_tol=1e-12)
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)


def test_quotas_follow_the_hypergeometric_law():
    counts = [600, 300, 100]
    draws = []
    for seed in range(400):
        quotas = dict(mixing.split_quotas(counts, 8, seed))
        assert np.array(list(quotas.values())).sum(axis=0).tolist() == counts
        assert all(q.sum() == 125 for q in quotas.values())
        draws.append(quotas[3])
    draws = np.array(draws)
    share = np.array(counts) / 1_000
    assert np.allclose(draws.mean(axis=0), 125 * share, atol=0.9)
    assert np.allclose(draws.var(axis=0), 125 * share * (1 - share) * 875 / 999, rtol=0.25)


@pytest.mark.parametrize("count", [1, 2, 3, 7, 64, 1_000, 4_097])
def test_block_order_is_a_permutation(count):
    orders = [mixing.permuted(np.arange(count), np.full(count, count), np.full(count, key, dtype=np.uint64)) for key in (1, 2)]
    assert all(sorted(o.tolist()) == list(range(count)) for o in orders)
    assert count < 64 or (orders[0] != orders[1]).any()
