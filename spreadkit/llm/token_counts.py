"""Token counts: batch encoding in Arrow functions that returns lengths only.

Each Arrow batch is cut into stretches of about equal bytes (a long text
contributes several, cut at safe boundaries), each stretch is encoded in a few
library calls, and only the number of ids of each text leaves the worker. See
``units`` for why the counts equal the library's counts of the whole texts.

Null and empty texts have 0 tokens; rows are independent, so repeated ids,
null ids, an empty table and further columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.textarrays import text_bytes
from spreadkit.llm.units import UnitEncoder
from spreadkit.llm.workers import held

WINDOW_TOKENS = 2048


def encoder(path: str, rule: str, lengths_only: bool) -> UnitEncoder:
    """One per worker process, so its cache of units lives on between tasks."""
    return held(("units", path, rule, lengths_only), lambda: UnitEncoder(path, rule, lengths_only))


@lru_cache(maxsize=1)
def _pieces(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def token_counts(
    docs: DataFrame,
    tokenizer_path: str,
    rule: str = "drop",
    limit: int = WINDOW_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``.

    ``rule`` names the safe boundaries of a ``.json`` vocabulary: ``drop`` where
    white space is dropped, ``keep`` where it is part of the tokens. A
    sentencepiece ``.model`` has no boundary that is safe under its
    normalisation, so its texts are encoded whole.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            if tokenizer_path.endswith(".model"):
                texts = batch.column(1).fill_null("").to_pylist()
                counts = np.array([len(x) for x in _pieces(tokenizer_path).encode(texts, num_threads=1)], np.int64)
            else:
                _, counts = encoder(tokenizer_path, rule, True).encode(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets)), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"]
            )

    return (
        docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
        .mapInArrow(count, "doc_id bigint, n_bytes bigint, n_tokens bigint")
        .withColumn("over_limit", F.col("n_tokens") > limit)
    )
