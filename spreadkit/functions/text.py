"""Text expressions: tokenising on one space and word length."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tokens(text: Column | str) -> Column:
    """Split a document on single spaces with the reference's rules.

    * leading and inner empty tokens are kept (``" a"`` -> ``["", "a"]``),
    * trailing empty tokens are dropped (``"a b "`` -> ``["a", "b"]``),
    * an empty document gives one empty token (``""`` -> ``[""]``),
    * a document of spaces only gives no token.

    Only the space character separates; newlines and tabs are ordinary
    characters. Spark's ``split`` keeps trailing empties, so trailing spaces are
    trimmed first (``rtrim`` removes spaces only).
    """
    text = F.col(text) if isinstance(text, str) else text
    trimmed = F.rtrim(text)
    return (
        F.when(text == F.lit(""), F.array(F.lit("")))
        .when(trimmed == F.lit(""), F.array().cast(T.ArrayType(T.StringType())))
        .otherwise(F.split(trimmed, " ", -1))
    )


def word_length(word: Column | str) -> Column:
    """Length in Unicode code points (the same measure as DuckDB's ``length``)."""
    word = F.col(word) if isinstance(word, str) else word
    return F.length(word).cast("bigint")
