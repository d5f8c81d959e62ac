"""A corpus pipeline of the operators in ``tidemark.llm``: each stage works on all that its predecessor kept.

All stages but the last return the columns of their input, extra ones under any names included. An empty table goes through all of them and gives no pieces. Nulls, empty texts, ties and repeated rows are said with each stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import ngram_join, packing, pii_crf, quality_gam, quality_rules
from tidemark.llm.common import remove, shared_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns as in ``op1_quality_classifier``, from the documents given. A null or empty
    text is scored like any other (as one without words); a score of exactly 0.5 stays; repeated rows stay or go together, and rows without an id are scored but teach nothing; without labels the model is its start value."""
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 != 1)
    model = quality_gam.fit_labelled(docs, labels)
    return quality_gam.score(docs, model, out="_quality").where("_quality >= 0.5").select(*docs.columns)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go. A null or empty text has fewer words than the base rule asks for and goes; null languages and sources are groups of their own; repeated rows stay or go together."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that of the smallest id. Of equal ids in a group one row stays, a null id only where no row has another; rows without words
    (nulls, blank texts) link with nothing, and of those one of each id and text stays."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every span of personal data becomes its kind in brackets; n_chars follows. Null texts stay null, empty ones empty; equal texts are changed alike, whatever their ids."""
    return pii_crf.redact(docs, pii_crf.fit_spans(docs))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences. Python workers outlive the stage, so they keep fewer words. A null or empty text is its end
    token alone; null ids and repeated rows are pieces like others; ties in length are broken by rank, so any one gives as many sequences."""
    return packing.pack_documents(docs, kept_words=100_000)


STAGES = [("quality classifier", quality), ("quality rules", rules), ("n-gram Jaccard join", near_duplicates), ("personal data", personal_data), ("best-fit packing", packed)]

#: SQL can't express the trained stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage has read is removed once its own result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            remove(spark, before)
        before = path
    return docs
