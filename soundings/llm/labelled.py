"""Labelled documents for fitting classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from soundings.llm.common import staged, whole_text


def fold(parts: int) -> Column:
    """CRC-32 of the doc_id as text, modulo `parts`; a null doc_id counts as an empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, most: int
) -> DataFrame:
    """(doc_id, text, y) of at most `most` labelled documents that are `usable`, chosen by a hash.

    Rows without a label are left out; of several labels for a doc_id the larger counts, and of
    several rows the least text, so that rows are bounded as labels are. The labels joined are
    `most` at the most, which is what bounds the broadcast.
    """
    chosen = (
        labels.filter(usable & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most)
    )
    texts = docs.select(F.col("doc_id"), whole_text().alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id")
    return staged(rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("y").alias("y")), "labelled")
