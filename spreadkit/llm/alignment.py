"""Cross-tokenizer alignment by pointer jumping.

A text, with a space in front, is encoded by a byte-level vocabulary (A) and a
sentencepiece model (B); strings of special tokens inside it are plain text. Both
token sequences cover the same bytes. Every token points to its farthest-right
overlapping token: an A token to the B token that holds its last byte, a B token
to the A token that holds its last byte if that goes on behind it, else to itself.
Doubling all pointers at once, ``next = next[next]``, until none moves brings
every token to the terminal token of its component, which labels the group. A
group ends where both sequences end a token; the two tokens that end there are a
link.

The corpus-wide count of an id pair is the number of links that hold it. Counts
are shuffled by pair; the most frequent reach every worker in a table of bounded
size, the others by a join. A B id's best count is one number per vocabulary
entry.

Encoding goes unit by unit with a cache (see ``units``). A unit ends where a space,
tab or newline follows a visible character: no token of A crosses that place, and
none of B does, since no piece of the model has a space but in front, or a tab or
newline (that is checked; a model with such pieces is given whole texts).

Null and empty texts, and texts whose B bytes are not the text (a literal U+2581
becomes a space), have no tokens: zeros, and an empty ``groups_sha256``. Repeated
and null ids are rows like others, further columns are not read, long texts are
worked through in stretches of units, an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.routed import border
from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import ragged, same_spans, text_bytes, windows
from spreadkit.llm.units import UnitEncoder
from spreadkit.llm.workers import held, lean

# pairs on every worker with their counts
TABLE_PAIRS = 500_000
STRETCH_BYTES = 1 << 20
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x09, 0x0A]] = True
_MASK = np.int64((1 << 32) - 1)


def cut_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of units: a unit begins at a space, tab or newline
    behind a visible character (one that cannot end a Unicode space or U+2581)."""
    cut = np.zeros(len(data) + 1, bool)
    before = data[:-1]
    firm = (before > 0x20) & (before < 0x7F)
    high = np.flatnonzero(before >= 0x80)
    two, three = data[np.maximum(high - 1, 0)], data[np.maximum(high - 2, 0)]
    firm[high] = ~((two == 0xC2) | (three == 0xE1) | (three == 0xE2) | (three == 0xE3))
    cut[1:-1] = _BREAK[data[1:]] & firm
    cut[offsets[:-1]] = True
    starts = np.flatnonzero(cut[:-1])
    ends = np.append(starts[1:], len(data)) if len(starts) else starts
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def _whole(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = np.flatnonzero(offsets[:-1] < offsets[1:])
    return offsets[:-1][own], offsets[1:][own], own


class _Tokens(UnitEncoder):
    """A cache of units with, per unit, whether its tokens' bytes are its own."""

    def __init__(self, entries: list[bytes]):
        self.lengths_only = False
        self.sizes = np.array([len(e) for e in entries], np.int64)
        self.entry_bytes = np.frombuffer(b"".join(entries), np.uint8)
        self.entry_starts = np.cumsum(self.sizes) - self.sizes
        self._forget()

    def _forget(self) -> None:
        super()._forget()
        self.exact = np.zeros(0, bool)

    def _add(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        slots = super()._add(data, starts, ends)
        n = self.counts[slots].astype(np.int64)
        ids = self.flat[ragged(self.begins[slots].astype(np.int64), n)].astype(np.int64)
        own = self.entry_bytes[ragged(self.entry_starts[ids], self.sizes[ids])]
        stops = np.concatenate([[0], np.cumsum(self.sizes[ids])])[np.cumsum(n)]
        begins = np.concatenate([[0], stops[:-1]])
        self.exact = np.concatenate([self.exact, same_spans(data, starts, ends, own, begins, stops)])
        return slots

    def of(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Slots and numbers of tokens of units."""
        slots = self._slots(data, starts, ends)
        return slots, self.counts[slots].astype(np.int64)

    def ids(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.begins[slots].astype(np.int64), n)].astype(np.int64)


class ByteLevel(_Tokens):
    """A ``tokenizers`` file of byte-level entries."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = True
        # the byte-level alphabet: printable bytes stand for themselves, the others
        # for the code points from 256 on, in order
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        super().__init__([bytes(byte_of[c] for c in n) if all(c in byte_of for c in n) else n.encode() for n in names])

    def _library(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = memoryview(data.tobytes())
        texts = [str(body[a:b], "utf-8") for a, b in zip(starts.tolist(), ends.tolist())]
        got = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)


class Pieces(_Tokens):
    """A sentencepiece model. Units stand between NUL characters in one call,
    which are a byte of their own to the model; a unit with a NUL stands behind a
    newline, alone."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        entries = [
            bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)
        ]
        nul, newline = (self.model.piece_to_id(f"<0x{b:02X}>") for b in (0, 10))
        apart = all(self.model.is_byte(i) for i in (nul, newline)) and not any(
            "▁" in n.lstrip("▁") or {"\n", "\t", "\0"} & set(n) for n in names
        )
        self.split = cut_units if apart else _whole
        self.nul = nul if apart else None
        super().__init__(entries)

    def _library(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        body = data.tobytes()
        spans = list(zip(starts.tolist(), ends.tolist()))
        if self.nul is None:  # whole texts; the model adds the space in front itself
            got = [self.model.encode(body[a + 1 : b].decode(), num_threads=1) for a, b in spans]
            return np.array([i for ids in got for i in ids], np.uint32), np.array([len(ids) for ids in got], np.int64)
        odd = {k for k, (a, b) in enumerate(spans) if b"\0" in body[a:b]}
        groups = np.split(np.arange(len(spans)), np.flatnonzero(np.diff(np.cumsum(ends - starts) >> 10)) + 1)
        texts = ["".join("\0" + ("" if k in odd else body[spans[k][0] : spans[k][1]].decode()) for k in g.tolist()) for g in groups]
        counts, flat = np.zeros(len(spans), np.int64), []
        for g, ids in zip(groups, self.model.encode(texts, num_threads=1)):
            own = np.array(ids, np.uint32)
            marks = np.flatnonzero(own == self.nul)
            counts[g] = np.diff(np.append(marks, len(own))) - 1
            flat.append(np.delete(own[marks[0] :], marks - marks[0]))
        out = np.concatenate(flat) if flat else np.zeros(0, np.uint32)
        if odd:
            alone = {k: self.model.encode("\n" + body[spans[k][0] : spans[k][1]].decode(), num_threads=1)[2:] for k in sorted(odd)}
            begins = np.cumsum(counts) - counts
            places = np.repeat(begins[list(alone)], [len(x) for x in alone.values()])
            out = np.insert(out, places, np.concatenate([np.array(x, np.uint32) for x in alone.values()]))
            counts[list(alone)] = [len(x) for x in alone.values()]
        return out, counts


def jump(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """The terminal token (as a number of B) of each A token, then of each B token,
    of two token sequences over the same bytes, given where their tokens end."""
    n_a, n_b = len(ends_a), len(ends_b)
    total = int(ends_a[-1]) if n_a else 0
    ended = np.zeros((2, total + 1), np.int32)
    ended[0][ends_a] = 1
    ended[1][ends_b] = 1
    np.cumsum(ended, axis=1, out=ended)  # tokens that have ended at each place
    holder_a, holder_b = ended[0][ends_b - 1], ended[1][ends_a - 1]  # who holds the last byte
    next_ = np.empty(n_a + n_b, np.int64)
    next_[:n_a] = n_a + holder_b
    next_[n_a:] = np.where(ends_a[holder_a] > ends_b, holder_a, n_a + np.arange(n_b))
    while True:
        after = next_[next_]
        if np.array_equal(after, next_):
            return next_ - n_a
        next_ = after


_DIGITS = 7


def _digits(most: int) -> tuple[np.ndarray, np.ndarray]:
    """Decimal digits of 0 to ``most`` in rows, left-aligned, and their numbers."""
    if most >= 10**_DIGITS:
        raise ValueError("vocabulary too large")
    values = np.arange(most + 1)
    size = np.maximum(1, np.searchsorted(10 ** np.arange(1, _DIGITS), values, "right") + 1)
    power = 10 ** np.maximum(size[:, None] - 1 - np.arange(_DIGITS), 0)
    return (values[:, None] // power % 10 + ord("0")).astype(np.uint8), size


class Aligner:
    """Both encoders and the digits of ids, one per worker process."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.digits, self.width = _digits(max(len(self.a.sizes), len(self.b.sizes)))

    def run(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple]:
        """For stretches of whole units: text of each group, tokens of A and of B in
        each, link pairs, the written groups with an end for each group, and texts
        that turned out not to be covered by their tokens."""
        starts, ends, text = self.b.split(data, offsets)
        if not len(starts):
            return
        for i, j in windows(np.append(starts, ends[-1:]), STRETCH_BYTES):
            s, e = starts[i:j], ends[i:j]
            base, own = int(s[0]), data[int(s[0]) : int(e[-1])]
            slots_a, n_a = self.a.of(own, s - base, e - base)
            slots_b, n_b = self.b.of(own, s - base, e - base)
            good = self.a.exact[slots_a] & self.b.exact[slots_b]
            bad = np.unique(text[i:j][~good])
            good &= ~np.isin(text[i:j], bad)
            yield (*self._align(slots_a[good], n_a[good], slots_b[good], n_b[good], text[i:j][good]), bad)

    def _align(self, slots_a, n_a, slots_b, n_b, text) -> tuple:
        ids_a, ids_b = self.a.ids(slots_a, n_a), self.b.ids(slots_b, n_b)
        ends_a, ends_b = np.cumsum(self.a.sizes[ids_a]), np.cumsum(self.b.sizes[ids_b])
        label = jump(ends_a, ends_b)
        label_a, label_b = label[: len(ids_a)], label[len(ids_a) :]
        last_b = np.flatnonzero(label_b == np.arange(len(ids_b)))  # terminal tokens
        number = np.cumsum(label_b == np.arange(len(ids_b))) - 1
        group_a, group_b = number[label_a], number[label_b]
        size_a, size_b = (np.bincount(g, minlength=len(last_b)) for g in (group_a, group_b))
        up_a, up_b = np.cumsum(size_a), np.cumsum(size_b)
        pairs = ids_a[up_a - 1] << np.int64(32) | ids_b[last_b]
        # a1,a2|b1;a3|b2 : tokens in the order of groups, A before B
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        ids[np.arange(len(ids_a)) + (up_b - size_b)[group_a]] = ids_a
        ids[np.arange(len(ids_b)) + up_a[group_b]] = ids_b
        size = self.width[ids] + 1
        stops = np.cumsum(size)
        body = np.full(int(stops[-1]) if len(ids) else 0, ord(","), np.uint8)
        body[ragged(stops - size, size - 1)] = self.digits.ravel()[ragged(ids * _DIGITS, size - 1)]
        ends = stops[up_a + up_b - 1]  # of groups
        body[stops[up_a + up_b - size_b - 1] - 1] = ord("|")
        body[ends - 1] = ord(";")
        own = np.repeat(text, n_b)[last_b]
        return own, size_a, size_b, pairs, body, ends


ROWS = (
    "part int, row bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "groups_sha256 string, pairs binary, times binary"
)
_NAMES = [f.split()[0] for f in ROWS.split(", ")]


def _sums(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sums of their times."""
    distinct, back = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(back, weights=times, minlength=len(distinct)).astype(np.int64)


def _with_space(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space in front, empty ones without."""
    data, offsets = text_bytes(column)
    some = (np.diff(offsets) > 0).astype(np.int64)
    out = np.full(len(data) + int(some.sum()), 0x20, np.uint8)
    shift = np.cumsum(some)
    out[np.arange(len(data)) + np.repeat(shift, np.diff(offsets))] = data
    return out, offsets + np.concatenate([[0], shift])


def _binary(arrays: list[np.ndarray], kind: str) -> pa.Array:
    return pa.array([a.astype(kind).tobytes() for a in arrays], pa.binary())


def align_rows(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """A row per text: its numbers, digest, distinct link pairs and their times."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = held(("aligner", path_a, path_b), lambda: Aligner(path_a, path_b))
        part, row = TaskContext.get().partitionId(), 0
        for batch in batches:
            data, offsets = _with_space(batch.column(1))
            for i, j in windows(offsets, STRETCH_BYTES):
                found = _texts(own, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                numbers, digests, pairs, times = found
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(j - i, part, np.int32)), pa.array(np.arange(row, row + j - i)),
                        batch.column(0).slice(i, j - i), *[pa.array(x) for x in numbers], pa.array(digests, pa.string()),
                        _binary(pairs, "<i8"), _binary(times, "<i4"),
                    ],
                    _NAMES,
                )
                row += j - i

    return docs.mapInArrow(lean(run, ("aligner", path_a, path_b)), ROWS)


def _texts(own: Aligner, data: np.ndarray, offsets: np.ndarray) -> tuple:
    n = len(offsets) - 1
    numbers = np.zeros((4, n), np.int64)
    hashes: dict[int, object] = {}
    pairs, times = [[np.zeros(0, np.int64)] for _ in range(n)], [[np.zeros(0, np.int64)] for _ in range(n)]
    lost: set[int] = set()
    for text, size_a, size_b, links, body, ends, bad in own.run(data, offsets):
        lost.update(bad.tolist())
        if not len(text):
            continue
        for k, x in enumerate((size_a, size_b, np.ones(len(text)), np.ones(len(text)))):
            numbers[k] += np.bincount(text, weights=x, minlength=n).astype(np.int64)
        kinds, back = np.unique(links, return_inverse=True)
        keys, counts = np.unique(text * len(kinds) + back, return_counts=True)
        edges = np.searchsorted(keys, np.arange(n + 1) * len(kinds))
        first = np.flatnonzero(np.diff(text, prepend=-1))
        raw = memoryview(body)
        for a, b in zip(first.tolist(), np.append(first[1:], len(text)).tolist()):
            d = int(text[a])
            begin, end = int(ends[a - 1]) if a else 0, int(ends[b - 1])
            if d not in hashes:
                hashes[d] = hashlib.sha256()
            else:  # a text that goes on in this stretch
                hashes[d].update(b";")
            hashes[d].update(raw[begin : end - 1])
            cells = slice(edges[d], edges[d + 1])
            pairs[d].append(kinds[keys[cells] % len(kinds)])
            times[d].append(counts[cells])
    digests = [hashes[d].hexdigest() if d in hashes and d not in lost else "" for d in range(n)]
    for d in lost:
        numbers[:, d], pairs[d], times[d] = 0, pairs[d][:1], times[d][:1]
    merged = [(p[-1], t[-1]) if len(p) <= 2 else _sums(np.concatenate(p), np.concatenate(t)) for p, t in zip(pairs, times)]
    return numbers, digests, [m[0] for m in merged], [m[1] for m in merged]


def _columns(batch: pa.RecordBatch, pairs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs, their times, and the pairs' offsets by row."""
    body, offsets = text_bytes(batch.column(pairs))
    times, _ = text_bytes(batch.column(pairs + 1))
    return body.view("<i8"), times.view("<i4").astype(np.int64), offsets // 8


def pair_counts(rows: DataFrame) -> DataFrame:
    """``pair, n`` over all rows of :func:`align_rows`."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs, times, _ = _columns(batch, 0)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in _sums(pairs, times)], ["pair", "n"])

    parts = rows.select("pairs", "times").mapInArrow(lean(count), "pair bigint, n bigint")
    return parts.groupBy("pair").agg(F.sum("n").alias("n"))


_PER_ROW = "part int, row bigint, best bigint, total bigint, rare array<struct<pair:bigint,n:bigint>>"


def align(
    docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for
    each row of ``docs``."""
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    rows = stored(align_rows(source, path_a, path_b), "aligned")
    counts = stored(pair_counts(rows), "pair-counts")
    id_b = F.col("pair").bitwiseAND(F.lit(int(_MASK)))
    tops = counts.groupBy(id_b.alias("b")).agg(F.max("n").alias("top"))
    top_rows = tops.toArrow()  # one row for each entry of B's vocabulary at most
    top = np.zeros(int(max(top_rows.column("b").to_pylist(), default=0)) + 1, np.int64)
    top[top_rows.column("b").to_numpy()] = top_rows.column("top").to_numpy()
    least = border(counts, "n", TABLE_PAIRS)
    table = counts.where(F.col("n") >= least).toArrow()  # at most TABLE_PAIRS rows
    keys, values = table.column("pair").to_numpy(), table.column("n").to_numpy()
    order = np.argsort(keys)
    shared = docs.sparkSession.sparkContext.broadcast((keys[order], values[order], top))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number, best = shared.value
        for batch in batches:
            pairs, times, offsets = _columns(batch, 2)
            n = batch.num_rows
            row = np.repeat(np.arange(n), np.diff(offsets))
            at = np.minimum(np.searchsorted(known, pairs), max(len(known) - 1, 0))
            found = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            value = np.where(found, number[at], 0) if len(known) else np.zeros(len(pairs), np.int64)
            is_best = found & (value == best[pairs & _MASK])
            sums = np.zeros((2, n), np.int64)
            np.add.at(sums[0], row, times * is_best)
            np.add.at(sums[1], row, times * value)
            items = pa.StructArray.from_arrays([pa.array(pairs[~found]), pa.array(times[~found])], ["pair", "n"])
            edges = np.concatenate([[0], np.cumsum(np.bincount(row[~found], minlength=n))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sums[0]), pa.array(sums[1]), pa.ListArray.from_arrays(pa.array(edges), items)],
                ["part", "row", "best", "total", "rare"],
            )

    seen = stored(rows.select("part", "row", "pairs", "times").mapInArrow(lean(look_up), _PER_ROW), "seen")
    listed = seen.select("part", "row", F.explode("rare").alias("r")).select("part", "row", "r.pair", F.col("r.n").alias("times"))
    per_b = tops if not len(top_rows) else F.broadcast(tops)
    rest = counts.where(F.col("n") < least).withColumn("b", id_b).join(per_b, "b").select(
        "pair", "n", (F.col("n") == F.col("top")).alias("is_best")
    )
    rare = listed.join(rest, "pair").groupBy("part", "row").agg(
        F.sum(F.when(F.col("is_best"), F.col("times")).otherwise(0)).alias("rare_best"),
        F.sum(F.col("times") * F.col("n")).alias("rare_total"),
    )
    base = rows.select("part", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    joined = base.join(seen.select("part", "row", "best", "total"), ["part", "row"]).join(rare, ["part", "row"], "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        (F.col("best") + F.coalesce("rare_best", zero)).alias("n_best"),
        (F.col("total") + F.coalesce("rare_total", zero)).alias("count_sum"),
        "groups_sha256",
    )
