"""Bounded samples of labelled documents, and the held-out rule of the scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corral.llm.common import texts_of


def id_remainder(modulus: int, col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: null)."""
    return F.pmod(F.crc32(F.col(col).cast("string").cast("binary")), F.lit(modulus)).cast("int")


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, usable: Column, max_rows: int
) -> list[tuple[str, int]]:
    """Up to ``max_rows`` ``(text, label)`` of labelled documents that ``usable`` (a
    condition on ``doc_id``) allows: those whose ids have the smallest hashes.

    Null labels and null ids are left out; an id labelled twice counts once, with
    its largest label; of rows with equal ids the smallest text counts.  Only
    the chosen ids are matched with texts, and only ``max_rows`` texts reach the
    driver.
    """
    rows = texts_of(docs)
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & usable)
        .groupBy("doc_id")
        .agg(F.max("y").alias("y"))
        .join(rows.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    picked = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    chosen = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text"))
    return [(r["text"], r["y"]) for r in sorted(chosen.collect(), key=lambda r: r["doc_id"])]
