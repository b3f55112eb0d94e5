"""Exact duplicates by a 128-bit content hash, with the bytes compared inside each hash group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardpulse.llm.shared import ascii_lower


def _digests(normalised: str) -> list:
    return [F.unhex(F.md5(normalised)).alias("_hash"), F.unhex(F.sha2(normalised, 256)).alias("_sha")]


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Two texts are equal when they are identical after lower-casing A-Z; null equals the empty text. Of equal texts
    the row with the largest id stays. Rows that share one id and one text are judged alike. A null id never wins over
    another id; where a group has null ids only, ``keep_id`` is null and its rows are kept. Columns beyond the two
    named ones are ignored; an empty table gives an empty result.

    The first aggregate groups by the 128-bit hash and by the text itself, so that the engine compares bytes inside
    a hash group and a collision becomes two groups. Its map side folds the copies of a task into one row, however
    large a group is. Rows then find their group by two independent digests (384 bits); should one pair of digests ever
    stand for two texts, the query fails instead of merging them.
    """
    texts = docs.select(F.col(id_col).alias("_id"), ascii_lower(F.col(text_col)).alias("_norm"))
    groups = (
        texts.select("_id", "_norm", F.unhex(F.md5("_norm")).alias("_hash"))
        .groupBy("_hash", "_norm").agg(F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
        .select("_hash", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "_keep", "_n")
        .groupBy("_hash", "_sha")
        .agg(F.max("_keep").alias("keep_id"), F.max("_n").alias("group_size"), F.count(F.lit(1)).alias("_texts"))
        .withColumn("group_size", F.when(F.col("_texts") == 1, F.col("group_size")).otherwise(
            F.raise_error("two texts share both digests").cast("bigint")))
        .drop("_texts")
    )
    rows = texts.select("_id", *_digests("_norm"))
    return rows.join(groups, ["_hash", "_sha"]).select(
        F.col("_id").alias(id_col), "keep_id", "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("_sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns.

    Of several rows with the same id and text, one stays; equal texts with null ids only keep one row as well.
    """
    columns = docs.columns
    hashed = docs.withColumn("_norm", ascii_lower(F.col(text_col)))
    groups = hashed.select(F.col(id_col).alias("_id"), "_norm").groupBy(
        F.unhex(F.md5("_norm")).alias("_hash"), "_norm").agg(
        F.max("_id").alias("_keep"), F.count(F.lit(1)).alias("_n"))
    keep = groups.select("_hash", F.unhex(F.sha2("_norm", 256)).alias("_sha"), "_keep")
    rows = docs.withColumn("_norm", ascii_lower(F.col(text_col))).select(*columns, *_digests("_norm"))
    stays = rows.join(
        keep, (rows["_hash"] == keep["_hash"]) & (rows["_sha"] == keep["_sha"])
        & rows[id_col].eqNullSafe(keep["_keep"]), "left_semi")
    return stays.dropDuplicates(["_hash", "_sha"]).select(*columns)
