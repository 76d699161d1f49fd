"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns
a DataFrame that is written as Parquet and read again for the next one. All but the last
return the columns of documents.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from shipreport.llm import decontamination, jaccard, packing, quality, substring
from shipreport.llm.common import small_batches, table
from shipreport.llm.queries import tokenizer_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled ones rejects go."""
    small_batches(spark)
    return quality.good_documents(docs, quality.learnt(docs, table(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id stays."""
    small_batches(spark)
    return jaccard.one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document holds are cut out."""
    small_batches(spark)
    return substring.deduplicated(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; a document that is hardly anything else goes."""
    small_batches(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, with the ids of each piece."""
    small_batches(spark)
    return packing.packed(docs, tokenizer_path(), added=True)


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("packing", pack),
]

#: SQL can express neither the trained model nor the tokenizer; tests hold the stages
#: against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of ``documents``; stages are kept in the shared checkpoint folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="pipeline-")
    docs, place = table(spark, sf_dir, "documents"), f"{shared}/pipeline-{uuid.uuid4()}"
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{place}/{number}")
        docs = spark.read.parquet(f"{place}/{number}")
    return docs
