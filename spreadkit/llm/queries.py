"""Registered queries: each operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadkit.llm.alignment import align
from spreadkit.llm.collocations import collocations
from spreadkit.llm.decontamination import decontaminate
from spreadkit.llm.hidden_markov import score_texts
from spreadkit.llm.id_planes import write_and_read
from spreadkit.llm.language import identify
from spreadkit.llm.ngram_join import ngram_components
from spreadkit.llm.packing import pack_documents
from spreadkit.llm.repetition import quality
from spreadkit.llm.resampling import resample
from spreadkit.llm.secret_scan import scan
from spreadkit.llm.site_style_tree import extract
from spreadkit.llm.tables import read
from spreadkit.llm.token_counts import token_counts

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` per document."""
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), rule="drop")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_shingles, component_id`` per document."""
    return ngram_components(read(spark, sf_dir, "documents"))


def op3_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The measures, ``base_failed`` and ``kept`` per document."""
    return quality(read(spark, sf_dir, "documents"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece."""
    pieces = pack_documents(read(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE), rule="drop", end_id=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op5_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, url, text, n_chars`` per page."""
    return extract(read(spark, sf_dir, "pages"))


def op6_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_features, log_weight, score, kept`` per document."""
    return resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document and benchmark item found in it."""
    return decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per candidate with the forest's verdict."""
    return scan(read(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` per document."""
    return identify(read(spark, sf_dir, "documents"))


def op10_id_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` per document, from the files read back."""
    docs = write_and_read(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE), rule="keep", end_id=0)
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per document."""
    docs = read(spark, sf_dir, "documents")
    return align(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


def op12_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` per document."""
    return score_texts(read(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of each language."""
    return collocations(read(spark, sf_dir, "documents"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_join": op2_ngram_join,
    "op3_repetition": op3_repetition,
    "op4_packing": op4_packing,
    "op5_site_style_tree": op5_site_style_tree,
    "op6_resampling": op6_resampling,
    "op7_decontamination": op7_decontamination,
    "op8_secrets": op8_secrets,
    "op9_language": op9_language,
    "op10_id_planes": op10_id_planes,
    "op11_alignment": op11_alignment,
    "op12_hidden_markov": op12_hidden_markov,
    "op13_collocations": op13_collocations,
}
