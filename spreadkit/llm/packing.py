"""Packing documents into windows of ids by non-negative least squares.

1. Every document is encoded once, an end id added, and stored with the number
   of whole windows it fills and the length of its tail. Within its file each
   tail is numbered among the tails of the same length.
2. The histogram of tail lengths (fewer bins than a window has ids, whatever
   the corpus) goes to the driver, which makes the plan on counts alone:
   shallow combinations of lengths that fill a window exactly are enumerated,
   their repeat counts solved against the histogram by non-negative least
   squares and rounded down, and what is left is packed greedily, longest
   first. Where nothing left fits a gap, one tail is cut to fit it, so no
   window has padding; the last ids fill windows of powers of two, which need
   none either.
3. The plan is a few thousand ranges of tail numbers (bounded by the window,
   not by the corpus). Each document finds its places by its length and number.

Null and empty texts are the end id alone. Rows with equal or null ids are
packed as separate documents. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import ragged, text_bytes
from spreadkit.llm.token_counts import WINDOW_TOKENS, encoder

ENCODED = "part int, doc_id bigint, n bigint, tail int, tail_rank bigint, full_rank bigint, ids binary"
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"


def running_count(values: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """For each value, how often it came before; ``seen`` is carried on."""
    order = np.argsort(values, kind="stable")
    ordered = values[order]
    begins = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    sizes = np.diff(np.append(begins, len(ordered)))
    out = np.empty(len(values), np.int64)
    out[order] = np.arange(len(values)) - np.repeat(begins, sizes) + seen[ordered]
    np.add.at(seen, ordered, 1)
    return out


def encoded(docs: DataFrame, tokenizer_path: str, rule: str, end_id: int, window: int) -> DataFrame:
    """Step 1, one row per document; ``ids`` holds 16-bit ids where the
    vocabulary allows, else 32-bit ones (``n`` tells which)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen, full = TaskContext.get().partitionId(), np.zeros(window, np.int64), 0
        for batch in batches:
            ids, counts = encoder(tokenizer_path, rule, False).encode(*text_bytes(batch.column(1)))
            ids = np.insert(ids, np.cumsum(counts), end_id)
            if encoder(tokenizer_path, rule, False).tokenizer.get_vocab_size() <= 1 << 16:
                ids = ids.astype(np.uint16)
            n = counts + 1
            whole, tail = n // window, n % window
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(len(n), part, np.int32)),
                    batch.column(0),
                    pa.array(n),
                    pa.array(tail.astype(np.int32)),
                    pa.array(running_count(tail, seen)),
                    pa.array(full + np.cumsum(whole) - whole),
                    binaries(ids, n),
                ],
                ["part", "doc_id", "n", "tail", "tail_rank", "full_rank", "ids"],
            )
            full += int(whole.sum())

    return docs.mapInArrow(encode, ENCODED)


def binaries(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """A binary column of the bytes of consecutive runs of ``ids``."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64) * ids.itemsize
    wide = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(ids))]
    )
    return wide.cast(pa.binary())


# ---------------------------------------------------------------- the plan


def combinations(histogram: np.ndarray, window: int) -> list[tuple[int, ...]]:
    """Two to four lengths that sum to the window: every pair, and triples and
    quadruples whose free members are among the commonest lengths."""
    common = [int(x) for x in np.argsort(-histogram, kind="stable") if histogram[x] and x]
    out = {(a, window - a) for a in range(1, window // 2 + 1) if histogram[a] and histogram[window - a]}
    for size, pool in ((2, common[:64]), (3, common[:16])):
        for free in combinations_with_replacement(sorted(pool), size):
            rest = window - sum(free)
            if rest > 0 and histogram[rest]:
                out.add(tuple(sorted((*free, rest))))
    return sorted(out)


def repeat_counts(combos: list[tuple[int, ...]], histogram: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """Minimise |A x - h| over x >= 0 by coordinate descent, where column j of
    A counts the lengths of combination j. The least-squares problem is convex,
    so each coordinate's exact minimum, clipped at 0, never makes it worse."""
    columns = [np.unique(c, return_counts=True) for c in combos]
    columns = [(rows.tolist(), uses.tolist(), float((uses**2).sum())) for rows, uses in columns]
    residual, x = histogram.astype(float).tolist(), [0.0] * len(combos)
    for _ in range(sweeps):
        moved = 0.0
        for j, (rows, uses, norm) in enumerate(columns):
            new = max(0.0, x[j] + sum(u * residual[r] for r, u in zip(rows, uses)) / norm)
            if step := new - x[j]:
                moved = max(moved, abs(step))
                x[j] = new
                for r, u in zip(rows, uses):
                    residual[r] -= u * step
        if moved < 0.25:
            break
    return np.floor(np.array(x) + 1e-9).astype(np.int64)


class Stock:
    """Tails not yet placed, by length: ranges ``[tail, first, count, start]``
    of tails of length ``tail`` whose ids from ``start`` on are left."""

    def __init__(self, histogram: np.ndarray):
        self.count = [int(x) for x in histogram]
        self.ranges = {n: deque([[n, 0, c, 0]]) for n, c in enumerate(self.count) if c}
        self.present = sum(1 << n for n, c in enumerate(self.count) if c)

    def take(self, length: int, count: int) -> list[tuple[int, int, int, int]]:
        out, own = [], self.ranges[length]
        self._changed(length, -count)
        while count:
            tail, first, size, start = head = own[0]
            used = min(size, count)
            out.append((tail, first, used, start))
            count -= used
            if used == size:
                own.popleft()
            else:
                head[1] += used
                head[2] -= used
        return out

    def put(self, length: int, item: tuple[int, int, int, int]) -> None:
        self.ranges.setdefault(length, deque()).append(list(item))
        self._changed(length, item[2])

    def _changed(self, length: int, by: int) -> None:
        self.count[length] += by
        self.present = self.present | 1 << length if self.count[length] else self.present & ~(1 << length)

    def longest(self, most: int, used: dict[int, int]) -> int:
        """The longest length up to ``most`` with a tail beyond those ``used``."""
        bits = self.present & ((1 << (most + 1)) - 1)
        while bits:
            n = bits.bit_length() - 1
            if self.count[n] > used.get(n, 0):
                return n
            bits &= ~(1 << n)
        return 0


def pack(histogram: np.ndarray, window: int, first_sequence: int = 0) -> np.ndarray:
    """The plan: rows ``tail, first, count, start, length, sequence, offset``.
    The tails of that length numbered ``first + i`` have the piece ``start,
    length`` at ``offset`` in the sequence ``sequence + i``, for i < count."""
    stock, rows, sequence = Stock(histogram), [], first_sequence

    def place(items: list, length: int, at: int, offset: int) -> None:
        for tail, first, count, start in items:
            rows.append((tail, first, count, start, length, at, offset))
            at += count

    def fill(pattern: list[tuple[int, int]], repeats: int) -> None:
        """Pattern members are (length taken, length of its piece)."""
        nonlocal sequence
        offset = 0
        for taken, piece in pattern:
            items = stock.take(taken, repeats)
            place(items, piece, sequence, offset)
            offset += piece
            if piece < taken:
                for tail, first, count, start in items:
                    stock.put(taken - piece, (tail, first, count, start + piece))
        sequence += repeats

    combos = combinations(histogram, window)
    counts = repeat_counts(combos, histogram)
    for j in np.argsort(-counts, kind="stable"):
        repeats = min([int(counts[j]), *(stock.count[n] // combos[j].count(n) for n in set(combos[j]))])
        if repeats > 0:
            fill([(n, n) for n in reversed(combos[j])], repeats)

    left = sum(n * c for n, c in enumerate(stock.count))
    while left >= window:
        pattern, used, gap = [], {}, window
        while gap:
            n = stock.longest(gap, used)
            cut = not n
            if cut:
                n = stock.longest(window - 1, used)
            used[n] = used.get(n, 0) + 1
            pattern.append((n, min(n, gap)))
            gap -= min(n, gap)
            if cut:
                break
        repeats = max(1, min(stock.count[n] // u for n, u in used.items()))
        fill(pattern, repeats)
        left -= repeats * window
    while left:  # the last ids: sequences of powers of two
        target = gap = 1 << (left.bit_length() - 1)
        pattern, used = [], {}
        while gap:
            n = stock.longest(window - 1, used)
            used[n] = used.get(n, 0) + 1
            pattern.append((n, min(n, gap)))
            gap -= min(n, gap)
        fill(pattern, 1)
        left -= target
    return np.array(rows, np.int64).reshape(-1, 7)


class Places:
    """The plan by tail length and number: elementary ranges of numbers that
    share all their rows of the plan."""

    def __init__(self, plan: np.ndarray, window: int):
        self.rows = plan
        self.stride = int((plan[:, 1] + plan[:, 2]).max(initial=0)) + 1
        keys, lists = [], []
        for tail in np.unique(plan[:, 0]):
            own = np.flatnonzero(plan[:, 0] == tail)
            lo, hi = plan[own, 1], plan[own, 1] + plan[own, 2]
            edges = np.unique(np.concatenate([lo, hi]))
            a, b = np.searchsorted(edges, lo), np.searchsorted(edges, hi)
            cell = ragged(a, b - a)
            row = np.repeat(own, b - a)
            order = np.lexsort((plan[row, 3], cell))
            keys.append(int(tail) * self.stride + edges[:-1])
            lists.append((row[order], np.bincount(cell, minlength=len(edges) - 1)))
        self.keys = np.concatenate(keys) if keys else np.zeros(0, np.int64)
        self.list = np.concatenate([x[0] for x in lists]) if lists else np.zeros(0, np.int64)
        sizes = np.concatenate([x[1] for x in lists]) if lists else np.zeros(0, np.int64)
        self.sizes, self.begins = sizes, np.cumsum(sizes) - sizes

    def of(self, tails: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each tail its rows of the plan: which tail, which row."""
        cell = np.searchsorted(self.keys, tails * self.stride + ranks, "right") - 1
        n = self.sizes[cell]
        return np.repeat(np.arange(len(tails)), n), self.list[ragged(self.begins[cell], n)]


# ---------------------------------------------------------------- the operator


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    rule: str = "drop",
    end_id: int = 1,
    window: int = WINDOW_TOKENS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, sequence_id,
    offset, ids`` (the piece's ids, little-endian unsigned 32-bit)."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(encoded(source, tokenizer_path, rule, end_id, window), "encoded")
    spark = docs.sparkSession

    # numbers in each file become numbers in the corpus: what the files before
    # it hold of that length (length 0 stands for whole windows)
    counts = (
        rows.groupBy("part", "tail").agg(F.count("*").alias("c")).where("tail > 0")
        .unionByName(rows.groupBy("part").agg(F.sum(F.expr(f"n div {window}")).alias("c")).withColumn("tail", F.lit(0)))
    )
    before = Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    numbered = counts.select("part", "tail", "c", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    numbered = stored(numbered, "numbered")
    histogram = np.zeros(window, np.int64)
    for row in numbered.groupBy("tail").agg(F.sum("c").alias("c")).collect():  # at most `window` rows
        histogram[row.tail] = row.c
    whole, histogram[0] = int(histogram[0]), 0
    places = spark.sparkContext.broadcast(Places(pack(histogram, window, first_sequence=whole), window))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield from _pieces(batch, places.value, window)

    tails = numbered.where("tail > 0").select("part", "tail", F.col("before").alias("tails_before"))
    fulls = numbered.where("tail = 0").select("part", F.col("before").alias("fulls_before"))
    offsets = tails.join(fulls, "part").unionByName(
        fulls.select("part", F.lit(0).alias("tail"), F.lit(0).cast("bigint").alias("tails_before"), "fulls_before")
    )
    placed = rows.join(offsets, ["part", "tail"]).select(
        "doc_id", "n", "tail", (F.col("tail_rank") + F.col("tails_before")).alias("rank"),
        (F.col("full_rank") + F.col("fulls_before")).alias("full"), "ids",
    )
    return placed.mapInArrow(put, PIECES)


def _pieces(batch: pa.RecordBatch, places: Places, window: int) -> Iterator[pa.RecordBatch]:
    n, tail, rank, full = (batch.column(k).to_numpy().astype(np.int64) for k in (1, 2, 3, 4))
    data, edges = text_bytes(batch.column(5))
    width = 2 if len(data) == 2 * int(n.sum()) else 4
    ids, first = data.view(f"<u{width}"), edges[:-1] // width
    whole = n // window
    which = np.repeat(np.arange(len(n)), whole)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(whole) - whole, whole)
    ends = np.flatnonzero(tail)
    of, row = places.of(tail[ends], rank[ends])
    of, rows = ends[of], places.rows[row]
    doc = np.concatenate([which, of])
    start = np.concatenate([nth * window, whole[of] * window + rows[:, 3]])
    length = np.concatenate([np.full(len(which), window), rows[:, 4]])
    sequence = np.concatenate([full[which] + nth, rows[:, 5] + rank[of] - rows[:, 1]])
    offset = np.concatenate([np.zeros(len(which), np.int64), rows[:, 6]])
    names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
    for a in range(0, len(doc), 1024):  # 1024 pieces hold 8 MB of ids at most
        s = slice(a, a + 1024)
        own = ids[ragged(first[doc[s]] + start[s], length[s])].astype("<u4")
        columns = [pa.array(x[s]) for x in (start, length, n[doc], sequence, offset)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(doc[s])), *columns, binaries(own, length[s])], names
        )
