"""The text pipeline: stages over `documents`, each written as Parquet and read again.

A stage is a function of (spark, docs, sf_dir) that returns a DataFrame. All but the last
return the columns of `documents`. For the stages that look for copies and leaks a document
is its id and its text: of two texts under one id only that goes which was found, a row
without an id is found by its text, and rows that repeat both are one document.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import bpe_codec, decontaminate, line_dedup, ngram_join, quality_fm, registry
from tillstream.llm.stage import stored, table


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return quality_fm.with_scores(docs, model).where(F.col(quality_fm.SCORE) >= 0.5).select(*docs.columns)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that an earlier document holds go, and documents of which no word is left."""
    cut = line_dedup.without_repeats(docs).where(
        (F.col(line_dedup.REMOVED_CHUNKS) == 0) | F.col("text").rlike(line_dedup.WORD)
    )
    length = F.when(F.col(line_dedup.REMOVED_CHUNKS) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", length).select(*docs.columns)


def keyed(docs: DataFrame) -> tuple[DataFrame, str]:
    """The rows with a number for each id and text, in a column of the name returned."""
    name = "document"
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return docs.withColumn(name, F.xxhash64("doc_id", F.coalesce("text", F.lit("")))), name


def without(rows: DataFrame, key: str, gone: DataFrame) -> DataFrame:
    """Rows whose id and key are not among those of `gone` (of_id, of)."""
    same = rows["doc_id"].eqNullSafe(gone["of_id"]) & (rows[key] == gone["of"])
    return rows.join(gone, same, "left_anti").drop(key)


def join_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of similar documents that with the smallest id stays, one without an id last."""
    rows, key = keyed(docs)
    found = ngram_join.classes(rows.select(F.col(key).alias("doc_id"), "text")).select(F.col("doc_id").alias("of"), "component_id").distinct()
    ids = rows.select(F.col(key).alias("k"), F.col("doc_id").alias("of_id")).distinct()
    members = stored(found.join(ids, F.col("of") == F.col("k")).drop("k"), "group-members")
    first = F.min(F.struct(F.col("of_id").isNull(), "of_id", "of"))
    groups = members.groupBy(F.col("component_id").alias("c")).agg(F.count(F.lit(1)).alias("n"), first.alias("first")).where("n > 1")
    # The second key makes both sides shuffle for the join itself, so that a hot group can be split there.
    met = members.join(groups, (F.col("component_id") == F.col("c")) & (F.xxhash64("component_id") == F.xxhash64("c")))
    later = met.where(~(F.col("of").eqNullSafe(F.col("first.of")) & F.col("of_id").eqNullSafe(F.col("first.of_id"))))
    return without(rows, key, later.select("of_id", "of"))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, whole or edited, go."""
    rows, key = keyed(docs)
    found = decontaminate.leaks(rows.select(F.col(key).alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    holders = stored(found.select(F.col("doc_id").alias("holder")).distinct(), "holders")
    ids = rows.select(F.col(key).alias("of"), F.col("doc_id").alias("of_id")).distinct()
    return without(rows, key, ids.join(holders, F.col("of") == F.col("holder"), "left_semi"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining text and the text they decode to."""
    return bpe_codec.with_tokens(docs, public_tokenizers.path(registry.WORD_VOCABULARY))


STAGES = [
    ("quality_classifier", classify),
    ("line_dedup", cut_lines),
    ("ngram_join", join_near),
    ("decontamination", decontaminated),
    ("bpe_codec", encode),
]

# A trained classifier and aligned edits have no SQL form; the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
