"""The queries ``opN_*`` of this subpackage over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardpulse.llm import (
    bpe, exact_dedup, filter_audit, html_extract, mixing, neighbours, packing, periodic_runs, pii, simhash, suffix_dedup,
    toxicity, url_filter)
from cardpulse.llm.shared import table

URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=0)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=400)
    return removed.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = bpe.encode_documents(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    decoded = bpe.decode_documents(encoded, path, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score_toxicity(docs, model, ["doc_id"])
    return scored.select(
        "doc_id", toxicity.is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules)


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


# The key of a run is a parameter and belongs in a secret store; this one makes results repeatable.
SURROGATE_KEY = "corpus-surrogates"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


def plant_periods(doc_id, words: list) -> list:
    """The words of a tenth of the documents with a period from some place on; a null id leaves them as they are."""
    from zlib import crc32

    if doc_id is None or not words:
        return words
    g, chosen = divmod(crc32(str(doc_id).encode()), 10)
    if chosen:
        return words
    a = g % len(words)
    p = 1 + (len(words) - a) // (3 + g % 8)
    return words[:a] + [words[a + i % p] for i in range(len(words) - a)]


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(table(spark, sf_dir, "documents"), plant_periods)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(
        ",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.withColumn("_best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), (-F.col("_best.start")).alias("start"),
        F.col("_best.length").alias("length"), (-F.col("_best.period")).alias("period"),
        F.expr("1000 * _best.length div -_best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), share=1.5, most_epochs=2)
    return mixing.taken_words(mix)


QUERIES = {f.__name__: f for f in (op1_packing, op2_suffix_dedup, op3_neighbours, op4_bpe, op5_simhash, op6_toxicity, op7_url_filter, op8_exact_dedup,
    op9_html, op10_pii, op11_runs, op12_filter_audit, op13_mixing)}

_URL_VALUES = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)

ORACLE = {
    "op7_url_filter": f"""
        with rules(rule_host, rule_path, verdict) as (values {_URL_VALUES}),
        cut as (
            select page_id, strpos(url, '://') as p, substr(url, strpos(url, '://') + 3) as rest from pages),
        parts as (
            select page_id,
                case when p > 0 then translate(regexp_extract(rest, '^[^/?#]*'),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') else '' end as host,
                case when p > 0 then regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) else '' end as path
            from cut),
        fits as (
            select parts.*, rule_host || rule_path as rule, verdict,
                row_number() over (partition by page_id order by length(rule_host || rule_path) desc nulls last,
                    length(rule_host) desc, rule_host || rule_path desc, verdict desc) as n
            from parts left join rules
                on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
        select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fits where n = 1
    """,
    "op8_exact_dedup": """
        with norm as (
            select doc_id, translate(coalesce(text, ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
            from documents),
        named as (
            select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
                sha256(t) as text_sha256
            from norm)
        select *, doc_id = keep_id as kept from named
    """,
    "op12_filter_audit": """
        with docs as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as t from documents),
        words as (
            select *, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as w from docs),
        fails as (
            select doc_id, part,
                (case when len(w) < 50 then 'A' else '' end)
                || (case when 100 * len(list_distinct(w)) < 65 * len(w) then 'B' else '' end)
                || (case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) then 'C' else '' end)
                || (case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end)
                || (case when doc_id > min(doc_id) over (partition by t) then 'E' else '' end) as f
            from words),
        marked as (select doc_id, max(quality) as quality, max(toxic) as toxic from labels group by doc_id),
        counted as (
            select part, f, coalesce(quality = 1, false) as good, coalesce(toxic = 1, false) as toxic, count(*) as n
            from fails left join marked using (doc_id) group by all),
        l(x) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
        orders as (
            select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
            where length(list_aggregate(list_distinct([a.x, b.x, c.x, d.x, e.x]), 'string_agg', '')) = 5),
        gone as (
            select counted.*, filter_order, list_min(list_transform(string_split(nullif(f, ''), ''),
                lambda y: strpos(filter_order, y))) as out_at
            from counted, orders),
        steps as (
            select part, filter_order, step, substr(filter_order, step, 1) as letter,
                sum(case when out_at is null or out_at > step then n else 0 end)::bigint as kept,
                sum(case when out_at = step then n else 0 end)::bigint as removed,
                sum(case when contains(f, substr(filter_order, step, 1)) and out_at < step then n else 0 end)::bigint as redundant,
                sum(case when f = substr(filter_order, step, 1) then n else 0 end)::bigint as unique_fails,
                sum(case when out_at = step and good then n else 0 end)::bigint as good_lost,
                sum(case when out_at = step and toxic then n else 0 end)::bigint as toxic_lost
            from gone, range(1, 6) r(step) group by all)
        select part, filter_order, step::int as step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
            (sum(removed) over (partition by part, letter))::bigint as shapley
        from steps
    """,
}
