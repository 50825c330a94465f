"""Exact histogram of encoded lengths and the totals of every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corral.llm.common import map_batches, text_batches, texts_of
from corral.llm.encode import word_encoder


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_tokens)`` of every row, encoded without special tokens."""

    def run(batches):
        enc = word_encoder(tokenizer)
        for ids, texts in text_batches(batches):
            yield {"doc_id": ids, "n_tokens": [len(b) // 4 for b in enc.encode(texts)]}

    return map_batches(texts_of(docs, id_col, text_col), run, "doc_id long, n_tokens long")


def suffix_sums(histogram: DataFrame, span: int = 1024) -> DataFrame:
    """One row per encoded length with the suffix sums of the histogram.

    ``histogram`` needs ``n_tokens`` (null counts as 0) and ``n_docs``, the number
    of documents; rows of one length are added up.  For each length L that
    occurs: ``n_docs`` of that length, ``docs_ge`` and ``tokens_ge`` (documents
    and their tokens at length L or more), ``docs_le`` and ``kept_at`` (tokens
    left when every document is truncated to L), ``cut_at`` (tokens lost then),
    and ``quantile`` (share of documents of length L or less).

    Only the histogram (one row per distinct length and task) is shuffled.  The
    suffix sums are taken inside spans of ``span`` lengths and over the span
    totals, so no task gets more than ``span`` lengths or all span totals.
    Empty table: no rows.
    """
    hist = (
        histogram.select(F.coalesce(F.col("n_tokens").cast("long"), F.lit(0)).alias("length"), "n_docs")
        .groupBy("length")
        .agg(F.sum("n_docs").alias("n_docs"))
        .withColumn("bin", F.floor(F.col("length") / span))
    )
    after = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bins = (
        hist.groupBy("bin")
        .agg(F.sum("n_docs").alias("bd"), F.sum(F.col("n_docs") * F.col("length")).alias("bt"))
        .select(
            F.col("bin").alias("bin_"),
            F.coalesce(F.sum("bd").over(after), F.lit(0)).alias("docs_after"),
            F.coalesce(F.sum("bt").over(after), F.lit(0)).alias("tokens_after"),
            F.sum("bd").over(whole).alias("all_docs"),
            F.sum("bt").over(whole).alias("all_tokens"),
        )
    )
    inside = Window.partitionBy("bin").orderBy(F.col("length").desc())
    tokens = F.col("n_docs") * F.col("length")
    out = (
        hist.withColumn("d", F.sum("n_docs").over(inside))
        .withColumn("t", F.sum(tokens).over(inside))
        .join(bins, F.col("bin") == F.col("bin_"))
        .select(
            "length",
            "n_docs",
            (F.col("d") + F.col("docs_after")).alias("docs_ge"),
            (F.col("t") + F.col("tokens_after")).alias("tokens_ge"),
            "all_docs",
            "all_tokens",
        )
    )
    longer_docs = F.col("docs_ge") - F.col("n_docs")
    longer_tokens = F.col("tokens_ge") - F.col("n_docs") * F.col("length")
    return out.select(
        "length",
        "n_docs",
        "docs_ge",
        "tokens_ge",
        (F.col("all_docs") - longer_docs).alias("docs_le"),
        (F.col("all_tokens") - longer_tokens + longer_docs * F.col("length")).alias("kept_at"),
        (longer_tokens - longer_docs * F.col("length")).alias("cut_at"),
        ((F.col("all_docs") - longer_docs) / F.col("all_docs")).alias("quantile"),
    )


def totals_at(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """For each context limit (occurring as a length or not): documents and tokens
    in all, tokens kept under truncation to the limit, and documents cut.
    Answered from the histogram alone; ``limits`` is a short list."""
    rows = [
        F.struct(
            F.lit(int(x)).cast("long").alias("context"),
            F.count(F.lit(1)).alias("lengths"),
            F.sum("n_docs").alias("docs"),
            F.sum(F.col("n_docs") * F.col("length")).alias("tokens"),
            F.sum(F.col("n_docs") * F.least(F.col("length"), F.lit(int(x)))).alias("kept"),
            F.sum(F.when(F.col("length") > int(x), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
        )
        for x in limits
    ]
    one = histogram.agg(F.array(*rows).alias("rows"))
    return one.select(F.explode("rows").alias("r")).select("r.context", "r.docs", "r.tokens", "r.kept", "r.docs_cut")
