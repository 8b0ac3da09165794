"""From raw documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the
last return the columns of ``documents``. Between stages the documents are
written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadkit.llm.decontamination import keep_clean
from spreadkit.llm.ngram_join import keep_one
from spreadkit.llm.packing import pack_documents
from spreadkit.llm.queries import WORD_BPE
from spreadkit.llm.repetition import keep_good
from spreadkit.llm.secret_scan import redact
from spreadkit.llm.tables import read, ship_package, stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the repetition rules go."""
    ship_package(spark)
    return keep_good(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the smallest doc_id stays."""
    ship_package(spark)
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return keep_clean(docs, read(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are cut out of the texts; n_chars follows."""
    ship_package(spark)
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redact(docs).withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(length))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 ids, with their ids."""
    ship_package(spark)
    pieces = pack_documents(docs, public_tokenizers.path(WORD_BPE), rule="drop", end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", ngram_join),
    ("benchmark decontamination", decontamination),
    ("secret scans", secret_scans),
    ("packing", packing),
]

# suffix arrays, similarity joins and forests have no SQL form; see tests/llm
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
