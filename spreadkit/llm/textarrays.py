"""Whole text columns as flat byte arrays, and hashes of spans of them.

The operators of this package work on Arrow batches: the texts of a batch are
one run of UTF-8 bytes plus offsets, and words, tokens or q-grams are pairs of
positions in that run. A span is hashed eight bytes at a time, each piece folded
into the state by a non-linear mixer; all spans of a block take their k-th piece
in one pass of numpy. Long spans go to xxhash one by one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

_LONG_SPAN = 256
_BLOCK_SPANS = 1 << 18
_SEED = np.uint64(0x9E3779B97F4A7C15)
# bytes of a piece that belong to the span, by how many are left
_LEFT = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

# ASCII white space: \x20 and \x09-\x0D, as in the word rule [^\x20\x09-\x0D]+
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1, from 0) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    raw = np.frombuffer(offsets, np.int64 if wide else np.int32) if offsets else np.zeros(1, np.int32)
    offs = raw[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[offs[0] : offs[-1]], offs - offs[0]


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text index of every word ``[^\\x20\\x09-\\x0D]+``."""
    inside = ~IS_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    first = offsets[:-1][offsets[:-1] < offsets[1:]]
    starts[first] = inside[first]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    last = first_to_last(offsets)
    ends[last] = inside[last]
    s = np.flatnonzero(starts)
    return s, np.flatnonzero(ends) + 1, np.searchsorted(offsets, s, "right") - 1


def first_to_last(offsets: np.ndarray) -> np.ndarray:
    """Positions of the last byte of each text that is not empty."""
    return offsets[1:][offsets[:-1] < offsets[1:]] - 1


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every position on as one integer, zeros behind the end."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span ``[start, end)``, of its bytes and its length.
    Equal bytes give equal hashes, in any batch and process."""
    pieces = eights(data)
    out = np.empty(len(starts), np.uint64)
    for i in range(0, len(starts), _BLOCK_SPANS):
        at, left = starts[i : i + _BLOCK_SPANS], ends[i : i + _BLOCK_SPANS] - starts[i : i + _BLOCK_SPANS]
        state = mix(left.astype(np.uint64) * _SEED + _SEED)
        long_ = np.flatnonzero(left > _LONG_SPAN)
        for k in long_:
            digest = np.uint64(xxhash.xxh3_64_intdigest(data[at[k] : at[k] + left[k]].tobytes()))
            state[k] = mix((state[k] ^ digest).reshape(1))[0]
        whole = np.arange(len(at)) if not len(long_) else np.flatnonzero(left <= _LONG_SPAN)
        at, left = at[whole], left[whole]
        while len(whole):
            piece = pieces[at] & _LEFT[np.minimum(left, 8)]
            state[whole] = mix(state[whole] ^ piece)
            more = left > 8
            whole, at, left = whole[more], at[more] + 8, left[more] - 8
        out[i : i + len(state)] = state
    return out


def same_spans(
    data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
    other: np.ndarray, other_starts: np.ndarray, other_ends: np.ndarray,
) -> np.ndarray:
    """Whether each span of ``data`` has the bytes of its span of ``other``."""
    same = (ends - starts) == (other_ends - other_starts)
    pieces, others = eights(data), eights(other)
    row = np.flatnonzero(same)
    long_ = row[(ends - starts)[row] > _LONG_SPAN]
    for k in long_:
        same[k] = np.array_equal(data[starts[k] : ends[k]], other[other_starts[k] : other_ends[k]])
    row = row[(ends - starts)[row] <= _LONG_SPAN]
    at, at_other, left = starts[row], other_starts[row], (ends - starts)[row]
    while len(row):
        equal = ((pieces[at] ^ others[at_other]) & _LEFT[np.minimum(left, 8)]) == 0
        same[row[~equal]] = False
        more = equal & (left > 8)
        row, at, at_other, left = row[more], at[more] + 8, at_other[more] + 8, left[more] - 8
    return same


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions ``start, start + 1, ...`` of every run, one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
    return shift + np.arange(total)


def windows(offsets: np.ndarray, limit: int = 4 << 20) -> Iterator[tuple[int, int]]:
    """Ranges ``[i, j)`` of texts with at most ``limit`` bytes, or one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
