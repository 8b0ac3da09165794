"""Benchmark decontamination by the q-gram lemma.

Benchmark items and texts are lower-cased, every run of characters other than
letters, marks and digits (by Unicode category) becomes one space, and items are cut into two families of
overlapping windows (a short item is one window): ``WINDOW`` long and half
overlapping, and ``EXCERPT - STRIDE + 1`` long, one every ``STRIDE``, so that any
verbatim excerpt of ``EXCERPT`` bytes holds a whole window, however it lies. A
window of m characters that occurs in a text with at most k edits shares at least
m - q + 1 - k * q q-grams with that place, on diagonals (text position minus window
position) that differ by at most k. So:

1. The q-grams of all items form a sorted index, which is broadcast. The windows
   around a q-gram are two ranges, found by its position.
2. Each q-gram of a text that is in the index is a hit on a diagonal. Diagonals
   are cut into bands that overlap by the edit budget, so some band holds all
   hits of an occurrence. Hits are counted by text, window and band.
3. Bands that reach the lemma's bound are verified by banded alignment: the
   window against any substring on the band's diagonals, at most k edits.

Every text is searched whole. The index takes ``INDEX_BYTES`` of benchmark text
at a time; a larger benchmark is searched in blocks of that size. Positions, edits
and q-grams are in code points of the normalised text; only the lengths of windows
are measured in UTF-8 bytes, so that scripts of wide characters get windows of as
much content. The q-grams are of code points folded to a byte each, which can only
add hits; the alignment compares whole code points.

Null and empty texts have no findings. Items shorter than q are found where they
stand word for word, without edits (anywhere in the text if they have q bytes or a
script without spaces). Items with equal texts are one entry of the index and
are each reported; rows with equal or null doc_id are searched one by one and their findings on one
item merged under that id.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.textarrays import mix, ragged, windows
from spreadkit.llm.workers import lean

Q = 12
EDIT_PERCENT = 5
WINDOW = 80
EXCERPT, STRIDE = 64, 8
BAND = 16
INDEX_BYTES = 2 << 20
STRETCH_BYTES = 1 << 20
_FILTER_BITS = 22
_EXPANDED = 1 << 21

FOUND = "doc_id bigint, item_id bigint, start bigint, stop bigint, edits bigint, windows bigint, matched bigint"


@lru_cache
def _letters() -> np.ndarray:
    """Whether a code point is a letter, mark or digit."""
    return np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)), bool, 0x110000)


def code_points(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points and offsets of the normalised texts, each with a space at its end."""
    lowered = [(t or "").lower() + " " for t in texts]
    data = np.frombuffer("".join(lowered).encode("utf-32-le", "replace"), "<u4")
    letter = _letters()[data]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum(keep)])
    return np.where(letter, data, 0x20)[keep].astype(np.uint32), np.concatenate([[0], sums[ends]])


def folded(points: np.ndarray) -> np.ndarray:
    """A byte for each code point; ASCII stays."""
    return np.where(points < 0x80, points, points & 0x7F | 0x80).astype(np.uint8)


def normalised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    points, offsets = code_points(texts)
    return folded(points), offsets


def _cut(at: np.ndarray, lo: int, hi: int, size: int, step: int) -> list[tuple[int, int]]:
    """Windows of ``[lo, hi)``, the last at its end; ``at`` are positions in bytes."""
    if at[hi] - at[lo] <= size:
        return [(lo, hi)]
    begins = np.array([*range(at[lo], at[hi] - size, step), at[hi] - size])
    ends = np.searchsorted(at, begins + size, "right") - 1
    return sorted(set(zip(np.searchsorted(at, begins).tolist(), ends.tolist())))


def _spaced(point: int) -> bool:
    """Whether a letter's script sets spaces between words."""
    return point < 0x0E00 or 0x1100 <= point < 0x1780 or 0x1800 <= point < 0x2E80 or 0xAC00 <= point < 0xD800


def grams(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the Q = 12 folded code points from each position."""
    if len(data) < Q:
        return np.zeros(0, np.uint64)
    eight = np.ndarray(len(data) - 7, "<u8", np.ascontiguousarray(data), strides=(1,)).copy()
    return mix(eight[:-4] * np.uint64(0x9E3779B97F4A7C15) ^ eight[4:])


class Index:
    """The windows of some items, and their q-grams in order of hash."""

    def __init__(self, items: list[tuple[int, str]]):
        ids: dict[str, dict[int, None]] = {}
        for item, text in items:
            ids.setdefault(text, {})[item] = None
        self.ids = [list(own) for own in ids.values()]  # of the items with an entry's text
        points, offsets = code_points(list(ids))
        data = folded(points)
        width = 1 + sum((points >= c).astype(np.int64) for c in (0x80, 0x800, 0x10000))
        at = np.concatenate([[0], np.cumsum(width)])
        families: list[list[tuple[int, int, int]]] = [[], [], []]
        for i, (lo, hi) in enumerate(zip(offsets[:-1].tolist(), (offsets[1:] - 1).tolist())):
            if hi - lo < Q:
                lo += bool(hi > lo and data[lo] == 0x20)
                families[2] += [(lo, hi, i)] * (hi > lo)
                continue
            families[0] += [(a, b, i) for a, b in _cut(at, lo, hi, WINDOW, WINDOW // 2)]
            if at[hi] - at[lo] > EXCERPT - STRIDE + 1:
                families[1] += [(a, b, i) for a, b in _cut(at, lo, hi, EXCERPT - STRIDE + 1, STRIDE)]
        lows, highs, owner = np.array([x for f in families for x in f], np.int64).reshape(-1, 3).T
        self.data, self.points = data, points
        self.low, self.high, self.size = lows, highs, highs - lows
        self.edges = np.cumsum([0, *map(len, families)])
        self.windows = np.bincount(owner, minlength=len(ids))[owner] if len(owner) else np.zeros(0, np.int64)
        self.owner = owner
        # the budget leaves at least one shared q-gram
        self.budget = np.maximum(np.minimum(self.size * EDIT_PERCENT // 100, (self.size - Q) // Q), 0)
        self.bound = self.size - Q + 1 - self.budget * Q
        keys = grams(data)
        many = sum(n for _, n in self._around(np.arange(len(keys))))
        place = np.flatnonzero(many)
        order = np.argsort(keys[place], kind="stable")
        self.place = place[order].astype(np.int32)
        self.keys, self.begins, self.places = np.unique(keys[self.place], return_index=True, return_counts=True)
        self.sums = np.concatenate([[0], np.cumsum(many[self.place])])  # windows around the places before each
        self.entries = offsets
        self.seen = np.zeros(1 << _FILTER_BITS, bool)
        self.seen[(self.keys >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
        # short items, with a space where a word has to begin or end
        self.words: dict[str, list[tuple[int, bool]]] = {}
        for w in range(self.edges[2], self.edges[3]):
            lo, hi = self.low[w], self.high[w]
            spaces = [" " if at[hi] - at[lo] < Q and _spaced(points[k]) else "" for k in (lo, hi - 1)]
            self.words.setdefault(data[lo:hi].tobytes().decode("latin-1").join(spaces), []).append((w, spaces[1] == " "))

    def _around(self, place: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """First window and number of windows of each family around the q-grams
        at ``place``."""
        for a, b in zip(self.edges[:2], self.edges[1:3]):
            first = np.searchsorted(self.high[a:b], place + Q)
            yield a + first, np.maximum(np.searchsorted(self.low[a:b], place, "right") - first, 0)

    def _short(self, data: np.ndarray, offsets: np.ndarray, exact: tuple) -> Iterator[tuple[np.ndarray, ...]]:
        own = ahocorasick.Automaton()
        for word in self.words:
            own.add_word(word, word)
        own.make_automaton()
        hits = []
        for last, word in own.iter(" " + data.tobytes().decode("latin-1")):
            for w, space in self.words[word]:
                stop = last - space
                start = stop - int(self.size[w])
                text = int(np.searchsorted(offsets, start, "right")) - 1
                if stop < offsets[text + 1] and np.array_equal(exact[1][start:stop], exact[0][self.low[w] : self.high[w]]):
                    hits.append((text, w, start - offsets[text], stop - offsets[text], 0))
        if hits:
            yield tuple(np.array(hits, np.int64).T)

    def search(
        self, data: np.ndarray, offsets: np.ndarray, points: np.ndarray | None = None
    ) -> Iterator[tuple[np.ndarray, ...]]:
        """Occurrences: text, window, first and last position, edits; without
        the code points of the texts, of folded ones."""
        exact = (self.data, data) if points is None else (self.points, points)
        if self.words:
            yield from self._short(data, offsets, exact)
        if not len(self.keys) or len(data) < Q:
            return
        hashes = grams(data)
        at = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        same = self.keys[slot] == hashes[at]
        at, slot = at[same], slot[same]
        text = np.searchsorted(offsets, at, "right") - 1
        inside = at + Q <= offsets[1:][text]
        at, slot, text = at[inside], slot[inside], text[inside]
        # hits of a text stay together; texts are taken by their number of expanded hits
        edges = np.searchsorted(text, np.arange(len(offsets)))
        counts = self.sums[self.begins + self.places] - self.sums[self.begins]
        weight = np.concatenate([[0], np.cumsum(counts[slot])])[edges]
        for a, b in windows(weight, _EXPANDED):
            s = slice(edges[a], edges[b])
            parts = -(-int(weight[b] - weight[a]) // _EXPANDED)
            if parts > 1:  # one text with very many: some entries of the index at a time
                yield from self._in_parts(exact, offsets, at[s], slot[s], text[s])
            elif parts:
                yield from self._bands(exact, offsets, at[s], slot[s], text[s], self.begins[slot[s]], self.places[slot[s]])

    def _in_parts(self, exact, offsets, at, slot, text) -> Iterator[tuple[np.ndarray, ...]]:
        """Hits of one text, for ranges of entries with some ``_EXPANDED`` hits each
        (a single entry is not divided: its hits follow the text's length)."""
        which = np.repeat(np.arange(len(self.keys)), self.places)
        seen = np.bincount(slot, minlength=len(self.keys))[which] * np.diff(self.sums)
        entry = np.searchsorted(self.entries, self.place, "right") - 1
        load = np.concatenate([[0], np.cumsum(np.bincount(entry, weights=seen, minlength=len(self.entries) - 1).astype(np.int64))])
        span = np.int64(len(self.data) + 1)
        rank = which * span + self.place  # ascends
        for a, b in windows(load, _EXPANDED):
            lo, hi = (np.searchsorted(rank, slot * span + self.entries[k]) for k in (a, b))
            own = np.flatnonzero(hi > lo)
            yield from self._bands(exact, offsets, at[own], slot[own], text[own], lo[own], (hi - lo)[own])

    def _bands(self, exact, offsets, at, slot, text, begins, n) -> Iterator[tuple[np.ndarray, ...]]:
        """Occurrences for hits at ``at`` and the ``n`` places of the index from ``begins``."""
        place, own = self.place[ragged(begins, n)].astype(np.int64), np.repeat(text, n)
        # positions from the start of the text; the shift keeps diagonals positive
        shift = np.repeat(at - offsets[:-1][text], n) - place + WINDOW
        around = list(self._around(place))
        window = np.concatenate([ragged(first, n) for first, n in around])
        own, shift = (np.concatenate([np.repeat(x, n) for _, n in around]) for x in (own, shift))
        diagonal = shift + self.low[window]
        band, rest = diagonal // BAND, diagonal % BAND
        also = rest < self.budget[window]
        own, window = np.concatenate([own, own[also]]), np.concatenate([window, window[also]])
        band = np.concatenate([band, band[also] - 1])
        if not len(own):
            return
        width = int(band.max()) + 2
        key = (own * np.int64(len(self.low)) + window) * width + band + 1
        found, hits = np.unique(key, return_counts=True)
        window = found // width % len(self.low)
        found, window = found[hits >= self.bound[window]], window[hits >= self.bound[window]]
        own, band = found // width // len(self.low), found % width - 1
        for i in range(0, len(own), 4096):
            s = slice(i, i + 4096)
            yield from self._verify(exact, offsets, own[s], window[s], band[s])

    def _verify(self, exact, offsets, own, window, band) -> Iterator[tuple[np.ndarray, ...]]:
        """Banded alignment of many bands at once: column x of row r is the
        least number of edits between the window's first r code points and a piece of
        text that ends on diagonal x of the band."""
        pattern, data = exact
        most = int(self.budget[window].max(initial=0))
        # an occurrence's path strays at most the budget from its hits
        first = band * BAND - WINDOW - most
        width = BAND + 3 * most + 1
        column = np.arange(width)
        size = self.size[window]
        cost = np.zeros((len(own), width), np.int32)
        best = np.full(len(own), 1 << 20, np.int32)
        end = np.zeros(len(own), np.int64)
        low, high = offsets[:-1][own], offsets[1:][own] - 1
        far = np.int32(1 << 20)
        for r in range(int(size.max(initial=0))):
            spot = (low + first + r)[:, None] + column  # the code point that row r + 1 pairs on each diagonal
            real = (spot >= low[:, None]) & (spot < high[:, None])
            letter = pattern[np.minimum(self.low[window] + r, len(pattern) - 1)][:, None]
            equal = real & (data[np.clip(spot, 0, len(data) - 1)] == letter)
            step = np.where(equal, cost, cost + 1)
            step[:, :-1] = np.minimum(step[:, :-1], cost[:, 1:] + 1)  # a code point of the window without partner
            step = np.where(real | (spot == low[:, None] - 1), step, np.minimum(step, far))
            cost = np.minimum(np.minimum.accumulate(step - column, axis=1) + column, far)
            done = size == r + 1
            if done.any():
                best[done] = cost[done].min(axis=1)
                end[done] = cost[done].argmin(axis=1)
        good = best <= self.budget[window]
        stop = np.clip((first + size + end)[good], 0, (high - low)[good])
        yield own[good], window[good], np.maximum(stop - size[good], 0), stop, best[good]


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row for each document and benchmark item found in it: ``doc_id,
    item_id, start, stop`` (of the first and last window found), ``edits`` (the
    fewest of a window), ``windows`` of the item and how many were ``matched``."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    out = None
    for index in indexes(benchmark, item_col, item_text_col):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column(0)
                for rows in findings(shared.value, batch.column(1).to_pylist()):
                    text, *rest = zip(*rows)
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(text)), *[pa.array(x, pa.int64()) for x in rest]], NAMES
                    )

        part = source.mapInArrow(lean(search), FOUND)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return docs.sparkSession.createDataFrame([], FOUND)
    return out.groupBy("doc_id", "item_id").agg(
        F.min("start").alias("start"), F.max("stop").alias("stop"), F.min("edits").alias("edits"),
        F.max("windows").alias("windows"), F.max("matched").alias("matched"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no benchmark item is found, all columns as
    they are."""
    at = docs.columns.index(text_col)
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for rows in findings(shared.value, batch.column(at).to_pylist()):
                    clean[[r[0] for r in rows]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(lean(search), docs.schema)
    return docs


NAMES = [f.split()[0] for f in FOUND.split(", ")]


def indexes(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text") -> Iterator[Index]:
    """Indexes of blocks of about ``INDEX_BYTES`` of benchmark text."""
    items = benchmark.where(F.col(text_col).isNotNull()).select(
        F.col(item_col).cast("bigint").alias("item"), F.col(text_col).alias("text")
    )
    texts = items.groupBy("text").agg(F.sort_array(F.collect_set("item")).alias("items"), F.count_if(F.col("item").isNull()).alias("nulls"))
    total = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-total // INDEX_BYTES)
    for b in range(blocks):
        own = texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b).collect()
        own.sort(key=lambda r: (r["items"][:1], r.text))
        yield Index([(x, r.text) for r in own for x in [*r["items"], *[None] * bool(r.nulls)]])


def findings(index: Index, texts: list[str | None]) -> Iterator[list[tuple]]:
    """Rows ``text, item, start, stop, edits, windows, matched``, merged by
    text and item; one list for each stretch with any."""
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size < STRETCH_BYTES):
            size += len(texts[j] or "")
            j += 1
        points, offsets = code_points(texts[i:j])
        merged: dict[tuple[int, int], list] = {}
        for found in index.search(folded(points), offsets, points):
            for text, window, start, stop, edits in zip(*(x.tolist() for x in found)):
                row = merged.setdefault((text, index.owner[window]), [start, stop, edits, window, set()])
                row[:3] = min(row[0], start), max(row[1], stop), min(row[2], edits)
                row[4].add(window)
        rows = [
            (i + text, item, start, stop, edits, int(index.windows[w]), len(own))
            for (text, k), (start, stop, edits, w, own) in sorted(merged.items())
            for item in index.ids[k]
        ]
        if rows:
            yield rows
        i = j
