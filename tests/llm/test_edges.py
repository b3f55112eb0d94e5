"""Every operator and stage on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest

import corpus_pipeline
from cardpulse.llm import (
    bpe, exact_dedup, html_extract, neighbours, packing, periodic_runs, pii, simhash, suffix_dedup, toxicity, url_filter)
from pyspark.sql import functions as F

# Columns named like those that operators add or use inside.
DOC_DDL = ("doc_id bigint, text string, lang string, source string, n_chars bigint, keep_id string, score string, kept int, "
           "component_id double, sequence_id string, ids int, spans int, _norm int, n_entities string, print binary")
LONG = "word " * 60_000 + "x" * 50_000


def doc_rows(spark, rows):
    return spark.createDataFrame(
        [(i, t, None, "s", None, "k", "z", 1, 0.5, "q", 7, 8, 9, "n", b"p") for i, t in rows], DOC_DDL)


ROWS = [(1, "Some Text here that is fine"), (2, "some text HERE that is fine"), (3, None), (4, ""), (5, " \n\t "),
        (6, LONG), (7, LONG), (8, "some text here that is fine"), (8, "some text here that is fine"),
        (None, "nobody's text"), (None, None), (9, "ÄÖ é 日本 😀 ́")]
PAGES = [(1, "http://a.org/x", "<p>one</p><p>two</p>"), (2, None, None), (3, "no scheme", ""), (3, "no scheme", ""),
         (None, "http://a.org/y", "<p>one</p>"), (4, "http://a.org/z", "<p>" + "y" * 300_000)]
VECTORS = [(1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]),
           (7, [None, 1.0]), (50, [2.0, 0.0]), (None, [1.0, 0.0]), (8, [1.0, 0.0, 0.0]), (9, [float("inf"), 0.0]),
           (100, [0.0, 1e200])]
PATH = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LABELS = [(1, 1, 1), (2, 1, 0), (2, 0, 1), (3, 1, None), (None, 0, 1), (8, 0, 0)]


def labels(spark, rows=LABELS):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")


DOC_OPERATORS = {
    "packing": lambda d: packing.pack_documents(d, PATH),
    "suffix": lambda d: suffix_dedup.remove_repeats(d, 40, 10),
    "encode": lambda d: bpe.decode_documents(bpe.encode_documents(d, RANKS, public_tokenizers.PATTERN), RANKS,
                                             public_tokenizers.PATTERN),
    "simhash": lambda d: simhash.near_duplicates(d, 4),
    "exact": exact_dedup.duplicate_groups,
    "runs": periodic_runs.periodic_runs,
    "pii": lambda d: pii.pseudonymise(d, "key"),
    "toxicity": lambda d: toxicity.score_toxicity(d, toxicity.fit_toxicity(d, labels(d.sparkSession)), ["doc_id"]),
}


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_edge_documents(spark, name):
    rows = DOC_OPERATORS[name](doc_rows(spark, ROWS)).collect()
    if name == "packing":
        assert sum(r.length for r in rows) == sum({(r.doc_id, r.start, r.doc_tokens): r.doc_tokens for r in rows if
                                                   r.start == 0 and r.doc_id not in (8, None)}.values()) + sum(
            r.length for r in rows if r.doc_id in (8, None))
        assert sum(r.doc_id == 8 and r.start == 0 for r in rows) == 2
        assert {(r.doc_id, r.doc_tokens) for r in rows if r.doc_id in (3, 4)} == {(3, 1), (4, 1)}
    else:
        assert len(rows) == len(ROWS)
    if name == "exact":
        of = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in rows}
        assert {(1, 8, 4, False), (8, 8, 4, True), (3, 4, 3, False), (4, 4, 3, True), (6, 7, 2, False)} <= of
        assert (None, None, 1, True) in of
    if name == "simhash":
        assert {r.component_id for r in rows if r.doc_id in (3, 4, 5)} == {3}
        assert all(r.fingerprint == "0" * 16 for r in rows if r.doc_id in (3, 4, 5))
    if name == "encode":
        assert {r.doc_id: bytes(r.decoded).decode() for r in rows if r.doc_id in (5, 7, 9)} == {
            5: " \n\t ", 7: LONG, 9: ROWS[-1][1]}
    if name == "suffix":
        assert {r.doc_id: r.n_removed for r in rows if r.doc_id in (3, 4, 6)} == {3: 0, 4: 0, 6: len(LONG)}
    if name == "runs":
        of = {r.doc_id: r for r in rows}
        assert of[3].runs == of[4].runs == [] and of[3].collapsed == "" and of[None].n_words in (0, 2)
        assert [tuple(r) for r in of[6].runs] == [(0, 60_000, 1)] and of[6].collapsed == "word " + "x" * 50_000
    if name == "toxicity":
        assert all(0 <= r.score <= 1 for r in rows)
    if name == "pii":
        assert {r.n_entities for r in rows} == {0} and rows[0].keep_id == "k"


@pytest.mark.parametrize("name", DOC_OPERATORS)
def test_no_documents(spark, name):
    assert DOC_OPERATORS[name](doc_rows(spark, [])).count() == 0


def test_pages(spark):
    pages = spark.createDataFrame([(*p, "c", 1) for p in PAGES], "page_id bigint, url string, html string, host string, text int")
    texts = html_extract.extract_pages(pages).collect()
    assert len(texts) == len(PAGES)
    assert {r.text for r in texts if r.page_id in (2, 3)} == {""}
    assert {r.page_id: r.text for r in texts if r.page_id in (1, None)} == {1: "one\n\ntwo", None: "one"}
    rules = spark.createDataFrame([("org", "/", "block"), ("org", "/", "allow"), ("a.org", "/y", "allow")],
                                  "host string, path string, verdict string")
    judged = url_filter.judge_urls(pages, rules).collect()
    assert sorted((r.page_id or 0, r.host, r.path, r.rule, r.verdict) for r in judged)[0] == (
        0, "a.org", "/y", "a.org/y", "allow")
    assert {(r.rule, r.verdict) for r in judged if r.page_id in (1, 4)} == {("org/", "block")}
    assert {(r.host, r.path, r.rule, r.verdict) for r in judged if r.page_id in (2, 3)} == {("", "", None, "allow")}
    none = spark.createDataFrame([], pages.schema)
    assert html_extract.extract_pages(none).count() == url_filter.judge_urls(none, rules).count() == 0
    assert {r.verdict for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {"allow"}


def test_vectors(spark):
    df = spark.createDataFrame([(*v, 1, "x") for v in VECTORS], "vec_id bigint, embedding array<double>, rank int, score string")
    rows = neighbours.nearest_neighbours(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()
    assert [(r.query_id, r.vec_id, r.score) for r in rows if r.query_id == 50] == [(50, 1, 1.0), (50, 2, 1.0), (50, 100, 0.0)]
    assert [(r.vec_id, r.score) for r in rows if r.query_id == 100] == [(1, 0.0), (2, 0.0), (50, 0.0)]
    assert len({(r.query_id, r.vec_id) for r in rows}) == len(rows)
    assert {r.vec_id for r in rows} <= {1, 2, 50, 100}
    assert neighbours.nearest_neighbours(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_stages(spark, tmp_path):
    folder = str(tmp_path)
    labels(spark).write.parquet(f"{folder}/labels.parquet")
    docs = doc_rows(spark, ROWS)
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, folder)
            assert name == "packing" or out.columns == docs.columns
            if rows is not docs:
                assert out.count() == 0
            elif name == "exact dedup":
                assert sorted(str(r.doc_id) for r in out.collect()) == ["4", "5", "7", "8", "9", "None"]
            elif name == "simhash near-dedup":
                left = [r.doc_id for r in out.collect()]
                assert left.count(None) == 2 and set(left) == {1, 3, 6, 9, None}
            elif name == "pii":
                assert {r.n_chars for r in out.where("doc_id = 9").collect()} == {len(ROWS[-1][1])}
