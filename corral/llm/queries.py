"""Registered queries of the operators, with their production parameters, over
whole tables.  Archives, the filter audit and centroid clustering have oracle SQL;
the results of the others cannot be expressed in SQL (encoders, trained
models, compressed files), so ``tests/llm`` checks each of them
against a brute-force version, a round trip or held-out labels."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corral.llm import (
    chunk_bpe,
    filter_audit,
    forest,
    imatch,
    lengths,
    mih,
    packing,
    pivot_clusters,
    quality,
    repair,
    secrets,
    toxicity,
    warc,
)
from corral.llm.common import documents, staged
from corral.llm.encode import BYTE_BPE, WORD_BPE, tokenizer_path
from corral.plans.tables import table
from corral.session import scratch_location

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}
_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def find_package(spark: SparkSession) -> None:
    """Let the Python workers of a session started elsewhere import this package."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)


def query(fn: QueryFn) -> QueryFn:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        find_package(spark)
        return fn(spark, sf_dir)

    _REGISTRY[fn.__name__] = run
    return run


def queries() -> dict[str, QueryFn]:
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    return {
        "op11_boundary_chain_warc": warc.PAGES_SQL,
        "op12_packed_filter_audit": filter_audit.AUDIT_SQL,
        "op13_laesa_clusters": pivot_clusters.CLUSTERS_SQL,
    }


@query
def op1_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_path(BYTE_BPE))


@query
def op2_imatch_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


@query
def op3_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = lengths.token_counts(documents(spark, sf_dir), tokenizer_path(BYTE_BPE))
    histogram = counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs"))
    return lengths.suffix_sums(staged(histogram, "length_histogram"))


@query
def op4_repair_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_location(spark, "token_files")
    repair.write_token_store(documents(spark, sf_dir), path, tokenizer_path(BYTE_BPE))
    return repair.read_token_store(spark, path, with_ids=False)


@query
def op5_jaccard_forest_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.jaccard_join(documents(spark, sf_dir))[0]


@query
def op6_subword_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


@query
def op7_bradley_terry_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score_quality(docs, model)


@query
def op8_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan_secrets(documents(spark, sf_dir)))


@query
def op9_chunk_reuse_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_bpe.digests(chunk_bpe.encode_decode(documents(spark, sf_dir), tokenizer_path(WORD_BPE)))


@query
def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query
def op11_boundary_chain_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_location(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.page_digests(warc.read_archives(spark, path))


@query
def op12_packed_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op13_laesa_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_clusters.clusters(table(spark, sf_dir, "embeddings"))
