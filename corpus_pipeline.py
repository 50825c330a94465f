"""A corpus pipeline: quality, toxicity, near copies, secrets, packing.

Every stage takes the documents that the stage before kept, written as Parquet
and read again, and works on all of them.  All but the last return the rows that
they keep with all columns of any name as they came, in the same order of columns.
An empty table gives an empty table; long texts are read whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from corral.llm import forest, packing, quality, secrets, toxicity
from corral.llm.common import filter_texts, staged
from corral.llm.encode import BYTE_BPE, tokenizer_path
from corral.llm.queries import find_package
from corral.plans.tables import table


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose Bradley-Terry score is under the cut go.

    A null or empty text is scored by its features, which are all zero.  Ids do not
    matter: each of several rows with one id, a null id or equal texts is judged by
    its own text.  Without labels of both kinds every document stays (or goes, if
    all labels say so)."""
    find_package(spark)
    model = quality.quality_model(docs, table(spark, sf_dir, "labels"))
    return filter_texts(docs, lambda texts: [s >= 0.5 for s in model.score(texts)])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the subword model calls toxic go.

    A null or empty text has no words and gets the model's bias; rows with equal
    or null ids and repeated rows are judged each.  Without usable labels no
    document goes."""
    find_package(spark)
    model = toxicity.toxicity_model(docs, table(spark, sf_dir, "labels"))
    return filter_texts(docs, lambda texts: [model.score(t) < 0.5 for t in texts])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest id.

    Null ids come after all others, and of texts that share an id the one with the
    smallest hash stays; a repeated row stays once.  Null and blank texts are
    one group, as they have no words."""
    find_package(spark)
    return forest.keep_one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the texts; all documents stay, repeated rows too.

    ``n_chars`` (if there is one) is counted anew.  A null text stays null, with a
    count of 0; an empty one stays empty."""
    return secrets.redact_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents in windows of 1024 tokens.

    A null or empty text is its end id alone; rows with equal or null ids are
    documents of their own."""
    find_package(spark)
    return packing.pack_documents(docs, tokenizer_path(BYTE_BPE))


STAGES = [
    ("quality", reject_low_quality),
    ("toxicity", reject_toxic),
    ("jaccard_join", drop_near_copies),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: Encoders and trained models cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
