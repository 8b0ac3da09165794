"""Word operators over documents.

A document is one row; its words are the single-space tokens of
:func:`spreadkit.functions.text.tokens`. All three word-count strategies are
the same declarative aggregate; they differ only in how the shuffle is laid
out, which is the point the reference makes with its three variants.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.functions.keys import salt
from spreadkit.functions.text import tokens, word_length


def document_count(docs: DataFrame) -> DataFrame:
    """One row ``n_docs`` (A1)."""
    return docs.agg(F.count(F.lit(1)).alias("n_docs"))


def line_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row ``n_lines, n_chars``: line records and the characters in them."""
    return lines(docs, text).agg(
        F.count(F.lit(1)).alias("n_lines"), F.sum(F.length("text")).cast("bigint").alias("n_chars")
    )


def token_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens`` per document; no shuffle."""
    return docs.select(F.col(doc_id), F.size(tokens(text)).cast("bigint").alias("n_tokens"))


def words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per token occurrence: ``doc_id, word`` (P3); no shuffle."""
    return docs.select(F.col(doc_id), F.explode(tokens(text)).alias("word"))


def lines(docs: DataFrame, text: str = "text") -> DataFrame:
    """Line records (S1): every line of every text is a document of its own.

    Lines end at ``\\r\\n``, ``\\n`` or ``\\r``, as in a text-file source; the
    last one needs no end, and an empty text has no line.
    """
    parts = F.split(F.regexp_replace(text, r"(\r\n|\n|\r)\z", ""), r"\r\n|\n|\r", -1)
    return docs.where(F.col(text) != "").select(F.explode(parts).alias("text"))


def word_count(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    strategy: str = "direct",
    salts: int = 8,
) -> DataFrame:
    """``word, cnt`` over all documents.

    ``direct`` / ``partition``: ``groupBy(word)``; the partial aggregate
    before the exchange combines per document and per partition.
    ``salted``: first ``groupBy(salt, word)`` with a salt derived from
    ``(doc_id, word)``, then ``groupBy(word)``; two exchanges.
    """
    if strategy in ("direct", "partition"):
        occ = docs.select(F.explode(tokens(text)).alias("word"))
        return occ.groupBy("word").agg(F.count(F.lit(1)).alias("cnt"))
    if strategy == "salted":
        occ = words(docs, doc_id, text)
        round1 = occ.groupBy(salt(salts, F.col(doc_id), F.col("word")).alias("salt"), "word").agg(
            F.count(F.lit(1)).alias("cnt")
        )
        return round1.groupBy("word").agg(F.sum("cnt").cast("bigint").alias("cnt"))
    raise ValueError("strategy must be 'direct', 'partition' or 'salted'")


def distinct_word_count(counts: DataFrame) -> DataFrame:
    """Number of distinct words from a word count (A9), one row ``n_words``."""
    return counts.agg(F.count(F.lit(1)).alias("n_words"))


def avg_word_length(counts: DataFrame, word: str = "word") -> DataFrame:
    """Truncating mean length of the distinct words.

    One row ``avg_word_length``; NULL when there is no word. Sums are 64-bit.
    """
    total = F.sum(word_length(word))
    return counts.agg(total.alias("total"), F.count(F.lit(1)).alias("n")).select(
        F.expr("total div n").cast("bigint").alias("avg_word_length")
    )
