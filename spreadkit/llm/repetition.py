"""Quality rules on repetition inside a text, from suffix arrays.

The words of a stretch of texts get one suffix array, built by prefix doubling
in numpy: after round r suffixes are ranked by their first 2^r words, and only
suffixes that still tie are sorted again. A word's symbol includes its text, so
suffixes of different texts never tie. The ranks of the rounds also give the
longest common prefix of neighbours, by descending powers of two.

A suffix's longest repeated prefix is the larger of its common prefixes with its
two neighbours; in terms of intervals of the common-prefix array it is the value
of the deepest interval the suffix lies in. The union of these spans is what the
maximal repeated substrings cover.

A text is kept if it passes the base rules and maximal repeats of at least
``MIN_REPEAT`` words cover at most ``MAX_COVERED`` percent of its words and its
longest repeat (of any length from MIN_REPEAT) has at most ``MAX_LONGEST``
percent of them. Null and empty texts have no words and fail the base rules.
Rows are judged on their own: repeated or null ids and further columns change
nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.textarrays import IS_SPACE, mix, ragged, span_hashes, text_bytes, windows, words
from spreadkit.llm.workers import lean

MIN_WORDS = 50
MAX_REPEAT_WORDS = 50  # percent of the words in repeated 3-word windows
MIN_REPEAT = 5
MAX_COVERED = 40
MAX_LONGEST = 25
STRETCH_BYTES = 2 << 20

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "covered_words", "longest_repeat"]


def suffix_ranks(symbols: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffix array of ``symbols``, and for each round r the rank of every
    position by its 2^r next symbols. ``ends`` is where each position's text
    ends; symbols of different texts differ."""
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_ = symbols[order]
    fresh = np.concatenate([[True], sorted_[1:] != sorted_[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    rounds, step = [rank.astype(np.int32)], 1
    while True:
        starts = np.flatnonzero(fresh)
        sizes = np.diff(np.append(starts, n))
        slots = ragged(starts[sizes > 1], sizes[sizes > 1])  # places of tied suffixes
        if not len(slots):
            return order, rounds
        own = order[slots]
        after = own + step
        second = np.where(after < ends[own], rank[np.minimum(after, n - 1)] + 1, 0)
        key = rank[own] * np.int64(n + 1) + second
        moved = np.argsort(key, kind="stable")
        order[slots] = own = own[moved]
        key = key[moved]
        new = np.concatenate([[True], key[1:] != key[:-1]])
        fresh[slots] = new
        rank = rank.copy()
        rank[own] = np.maximum.accumulate(np.where(new, slots, 0))
        rounds.append(rank.astype(np.int32))
        step *= 2


def common_prefixes(order: np.ndarray, rounds: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """Common prefix length of each suffix with the one before it in order."""
    out = np.zeros(len(order), np.int64)
    pairs = np.flatnonzero(rounds[0][order[1:]] == rounds[0][order[:-1]]) + 1
    a, b = order[pairs - 1], order[pairs]
    length = np.zeros(len(pairs), np.int64)
    for r in range(len(rounds) - 1, -1, -1):
        x, y = a + length, b + length
        inside = np.maximum(x, y) < ends[a]
        x, y = np.where(inside, x, 0), np.where(inside, y, 0)
        length += np.where(inside & (rounds[r][x] == rounds[r][y]), 1 << r, 0)
    out[pairs] = length
    return out


def repeated_spans(symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each position the length of the longest substring that starts there
    and occurs somewhere else in its text too."""
    if not len(symbols):
        return np.zeros(0, np.int64)
    order, rounds = suffix_ranks(symbols, ends)
    lcp = common_prefixes(order, rounds, ends)
    out = np.empty(len(symbols), np.int64)
    out[order] = np.maximum(lcp, np.append(lcp[1:], 0))
    return out


def covered(spans: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a span of ``least`` or more."""
    starts = np.flatnonzero(spans >= least)
    edge = np.zeros(len(spans) + 1, np.int64)
    edge[starts] += 1
    np.subtract.at(edge, starts + spans[starts], 1)
    return np.cumsum(edge[:-1]) > 0


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The columns ``MEASURES`` of each text."""
    n = len(offsets) - 1
    out = np.zeros((len(MEASURES), n), np.int64)
    starts, ends, text = words(data, offsets)
    per_text = lambda values, own: np.bincount(own, weights=values, minlength=n).astype(np.int64)
    out[0] = np.bincount(text, minlength=n)
    sums = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    out[1] = per_text(sums[ends] - sums[starts], text)
    sums = np.concatenate([[0], np.cumsum(_SYMBOL[data])])
    out[2] = sums[offsets[1:]] - sums[offsets[:-1]]
    out[3] = _repeated_lines(data, offsets)
    symbols = mix(span_hashes(data, starts, ends) ^ mix(text.astype(np.uint64) + np.uint64(1)))
    last = np.cumsum(out[0])[text]
    spans = repeated_spans(symbols, last)
    out[4] = per_text(covered(spans, 3), text)
    out[5] = per_text(covered(spans, MIN_REPEAT), text)
    np.maximum.at(out[6], text, np.where(spans >= MIN_REPEAT, spans, 0))
    return out


def _repeated_lines(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    n = len(offsets) - 1
    if not len(data):
        return np.zeros(n, np.int64)
    breaks = np.flatnonzero(data == 0x0A)
    starts = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    text = np.searchsorted(offsets, starts, "right") - 1
    ends = np.append(starts[1:], len(data))
    ends = ends - (data[ends - 1] == 0x0A)  # without the line's own \n
    sums = np.concatenate([[0], np.cumsum(~IS_SPACE[data])])
    full = sums[ends] > sums[starts]
    starts, ends, text = starts[full], ends[full], text[full]
    keys = mix(span_hashes(data, starts, ends) ^ mix(text.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(keys, return_index=True)
    return np.bincount(text, minlength=n) - np.bincount(text[first], minlength=n)


def verdict(measures: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``base_failed`` and ``kept`` from the columns ``MEASURES``."""
    n, repeat, cover, longest = measures[0], measures[4], measures[5], measures[6]
    failed = (n < MIN_WORDS) | (100 * repeat > MAX_REPEAT_WORDS * n)
    return failed, ~failed & (100 * cover <= MAX_COVERED * n) & (100 * longest <= MAX_LONGEST * n)


def judged(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Measures, ``base_failed`` and ``kept`` of a column of texts."""
    data, offsets = text_bytes(column)
    parts = [measure(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in windows(offsets, STRETCH_BYTES)]
    measures = np.concatenate(parts, axis=1) if parts else np.zeros((len(MEASURES), 0), np.int64)
    return measures, *verdict(measures)


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the measures, ``base_failed`` and ``kept`` of each row."""
    names = ["doc_id", *MEASURES, "base_failed", "kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            measures, failed, kept = judged(batch.column(1))
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, measures), pa.array(failed), pa.array(kept)], names)

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    fields = ["doc_id bigint", *[f"{m} bigint" for m in MEASURES], "base_failed boolean", "kept boolean"]
    return source.mapInArrow(lean(run), ", ".join(fields))


def keep_good(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is kept, all columns as they are."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judged(batch.column(at))[2]))

    return docs.mapInArrow(lean(run), docs.schema)
