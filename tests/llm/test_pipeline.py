"""The pipeline's rows against plain restatements of its stages, and ``run`` against its stages."""

import math
import re

import numpy as np
import public_tokenizers
import pytest
import xxhash

import corpus_pipeline
from cardpulse.llm import pii, toxicity
from cardpulse.llm.shared import written

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, the input first."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        out.append((name, docs))
    return {name: df.collect() for name, df in out}


def test_toxicity_keeps_what_scores_below_one_half(spark, stages):
    model = toxicity.fit_toxicity(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))

    def score(text):
        words = set(re.findall(r"\w+", text.lower()))
        found = {f for w in words for f in toxicity.word_features(w)}
        found |= {f"/{n}/" for n, rule, _ in toxicity.PATTERNS if re.search(rule, text.lower())}
        return 1 / (1 + math.exp(-max(-30, min(30, model.bias + sum(model.weights.get(f, 0.0) for f in found)))))

    want = {r.doc_id for r in stages["input"] if score(r.text) < 0.5}
    assert {r.doc_id for r in stages["toxicity"]} == want and 0 < len(want) < len(stages["input"])


def test_one_of_each_text_stays(stages):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    best = {}
    for r in stages["toxicity"]:
        key = r.text.translate(lower)
        best[key] = max(best.get(key, r), r, key=lambda x: x.doc_id)
    assert sorted(stages["exact dedup"]) == sorted(best.values())


def near_components(docs):
    """The least id of each document's component, where links are any two fingerprints of four words at most 4 bits
    apart. Every pair is tried.
    """
    def bits(text):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    ids = sorted(docs)
    values = np.array([bits(docs[i]) for i in ids], dtype=np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    group = np.arange(len(ids))
    while True:
        least = np.where(near, group[None, :], len(ids)).min(axis=1)
        if (least == group).all():
            return {i: ids[g] for i, g in zip(ids, group)}
        group = least


def test_one_of_each_group_of_near_copies_stays(stages):
    docs = {r.doc_id: r for r in stages["exact dedup"]}
    want = near_components({i: r.text for i, r in docs.items()})
    assert sorted(stages["simhash near-dedup"]) == sorted(docs[i] for i, root in want.items() if i == root)


def test_near_copies_of_a_larger_table_are_those_of_all_pairs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where("doc_id is not null and text is not null")
    want = near_components({r.doc_id: r.text for r in docs.collect()})
    left = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, SF).collect()}
    assert left == {i for i, root in want.items() if i == root} and len(left) < len(want)


def test_only_personal_data_changes(stages):
    before = {r.doc_id: r for r in stages["simhash near-dedup"]}
    after = {r.doc_id: r for r in stages["pii"]}
    assert before.keys() == after.keys()
    private = re.compile(r"[\w.]+@[\w.]+\.com|\b\d{16}\b|\b\d{1,3}(?:\.\d{1,3}){3}\b|\(\d{3}\) \d{3}-\d{4}|\b[0-9a-f]{40}\b|AKIA\w{16}")
    seen = 0
    for doc_id, old in before.items():
        new = after[doc_id]
        assert new.n_chars == len(new.text) and (new.lang, new.source) == (old.lang, old.source)
        found = private.findall(old.text)
        seen += len(found)
        assert not any(x in new.text for x in found)
        assert private.sub("", new.text) == private.sub("", old.text)
    assert seen > 0 and len(pii.TYPES) == 8


def test_packing_holds_all_that_is_left_and_run_gives_the_same(spark, stages):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in stages["pii"]}
    got = {}
    for r in stages["packing"]:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == want
    piece = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens)
    assert sorted(map(piece, corpus_pipeline.run(spark, SF).collect())) == sorted(map(piece, stages["packing"]))
