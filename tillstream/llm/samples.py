"""Bounded labelled samples for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A sample's inputs go to the driver, where a classifier is trained: so many bytes at most.
SAMPLE_BYTES = 96 << 20


def fold(doc_id: str, folds: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds


def labelled_sample(labels: DataFrame, label: str, usable: Column, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """At most `per_class` ids of each class, chosen by a hash of the id, and the class sizes.

    Rows without id or label don't count; of an id with several labels the larger counts.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("label"))
    )
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    return picked[0].union(picked[1]), sizes


def sampled_rows(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The documents of a bounded sample, with their label. The sample's rows are few enough to broadcast."""
    return docs.join(F.broadcast(sample.withColumnRenamed("doc_id", "_of")), F.col("doc_id") == F.col("_of")).drop("_of")


def once(frame: DataFrame) -> DataFrame:
    """One row for each id, so that repeated documents don't exceed the bound."""
    rest = [c for c in frame.columns if c != "doc_id"]
    return frame.groupBy("doc_id").agg(F.max_by(F.struct(*rest), F.xxhash64(*rest)).alias("row")).select("doc_id", "row.*")


def within_bytes(rows: DataFrame, columns: list[str], limit: int = SAMPLE_BYTES) -> DataFrame:
    """The first rows of a stored sample, by a hash of the id, whose columns together have no more than `limit` bytes.

    One row at least. Only the sizes of the sample's rows meet in one task.
    """
    size = sum((F.octet_length(c).cast("long") for c in columns[1:]), F.octet_length(columns[0]).cast("long"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    running = rows.select(F.col("doc_id").alias("_of"), F.sum(size).over(order).alias("_bytes"), F.row_number().over(order).alias("_row"))
    kept = running.where((F.col("_bytes") <= limit) | (F.col("_row") == 1)).select("_of")
    return rows.join(F.broadcast(kept), F.col("doc_id") == F.col("_of")).drop("_of")
