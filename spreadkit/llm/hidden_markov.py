"""A hidden Markov language model: Baum-Welch training and exact scoring.

Texts are lower-cased (A-Z) and cut into words ``[^\\x20\\x09-\\x0D]+``; an end
token follows the last. The model generates a text state by state. In a state it
emits a class, and the class a word:

* each of the ``OWN_WORDS`` words most frequent in training, and the end, is a
  class of its own;
* all other words, known or not, fall into ``OTHERS`` classes by their last bytes.
  Within a class a word has (c + 1) / (n + v + 1), with its training count c and
  the class's n tokens and v distinct words; what is left over goes to words
  that training never saw.

So the parameters that depend on states are of fixed size, while the counts of
all words, however many, take part in every probability.

1. Words are counted over all texts: occurrences in training texts and in all.
   Counts are shuffled by word; they grow with the corpus.
2. Texts become sequences of class numbers, written once. Words above a border
   carry their count from a table of bounded size; the others are listed.
3. Baum-Welch: tasks run scaled forward and backward recursions over training
   sequences (cut into pieces of ``PIECE`` tokens, a piece inside a text starting
   from the states' share in training) and emit expected counts, which Spark
   sums; the driver holds one number for each class and state. Expected counts are
   rounded to 2^-16, so sums do not depend on their order.
4. Scaled forward recursion gives the exact likelihood of every whole text. A text
   longer than ``LONG`` tokens is cut into pieces whose transfer matrices (the
   recursion from each state) are multiplied, which is the same number.
5. Listed words meet their counts in a join; sums come back per text.

Null and empty texts are the end alone. A null doc_id is not held out, and not
trained on. Repeated rows count and score separately. With no training texts all
counts are 0 and the states differ by their start values only. Further columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.routed import border
from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import LOWER, eights, mix, ragged, same_spans, span_hashes, text_bytes, windows, words
from spreadkit.llm.workers import lean

STATES = 8
OWN_WORDS = 1 << 14
OTHERS = 1 << 11
ROUNDS = 5
# words on every worker with their counts
TABLE_WORDS = 300_000
PIECE = 128
GROUP_TOKENS = 400_000
LONG = 8192
STAY = 0.9  # first chance of staying in a state
FIXED_POINT = 1 << 16
_STRETCH = 2 << 20


def held_out(id_col: str) -> Column:
    """crc32 of the id as text, mod 7, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``doc_id, text, role``: 0 for training, 1 for held out, 2 for neither."""
    role = F.when(F.col(id_col).isNull(), 2).when(held_out(id_col), 1).otherwise(0)
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), role.alias("role"))


def _binaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Spans of ``data`` as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int32)
    body = data[ragged(starts, ends - starts)]
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def _stretches(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts i to j: their lower-cased bytes, and start, end and text of each word."""
    data, offsets = text_bytes(column)
    for i, j in windows(offsets, _STRETCH):
        own = LOWER[data[offsets[i] : offsets[j]]]
        yield i, j, own, *words(own, offsets[i : j + 1] - offsets[i])


# ------------------------------------------------------------------- counts


def count_words(source: DataFrame) -> DataFrame:
    """``word, c, t``: occurrences in training texts and in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            training = batch.column(1).to_numpy() == 0
            for i, j, own, starts, ends, text in _stretches(batch.column(0)):
                if not len(starts):
                    continue
                _, first, back = np.unique(span_hashes(own, starts, ends), return_index=True, return_inverse=True)
                t = np.bincount(back)
                c = np.bincount(back, weights=training[i:j][text]).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [_binaries(own, starts[first], ends[first]), pa.array(c), pa.array(t)], ["word", "c", "t"]
                )

    parts = source.select("text", "role").mapInArrow(lean(count), "word binary, c bigint, t bigint")
    return parts.groupBy("word").agg(F.sum("c").alias("c"), F.sum("t").alias("t"))


def other_class(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The class (from 0) of words without a class of their own: a hash of the
    last three bytes, and of whether there are more."""
    tail = np.maximum(starts, ends - 3)
    last = eights(data)[tail] & (np.uint64(1) << (8 * (ends - tail)).astype(np.uint64)) - np.uint64(1)
    return (mix(last * np.uint64(4) + (ends - starts > 3)) % np.uint64(OTHERS)).astype(np.int64)


def class_totals(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct training words by ``other_class``."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, kinds = np.zeros((2, OTHERS), np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            of = other_class(data, offsets[:-1], offsets[1:])
            np.add.at(tokens, of, batch.column(1).to_numpy())
            kinds += np.bincount(of, minlength=OTHERS)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(OTHERS, dtype=np.int32)), pa.array(tokens), pa.array(kinds)], ["class", "n", "v"]
        )

    rows = counts.where("c > 0").select("word", "c").mapInArrow(lean(total), "class int, n bigint, v bigint")
    n, v = np.zeros((2, OTHERS), np.int64)
    for r in rows.groupBy("class").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():  # OTHERS rows
        n[r["class"]], v[r["class"]] = r.n, r.v
    return n, v


class Vocabulary:
    """The words above the border with their counts; classes of words.

    Class 0 is the end, classes 1 to ``own`` are words, the rest are shared."""

    def __init__(self, table: pa.Table, tokens: np.ndarray, kinds: np.ndarray, ends: int):
        body, offsets = text_bytes(table.column(0))
        counts = table.column(1).to_numpy().astype(np.int64)
        hashes = span_hashes(body, offsets[:-1], offsets[1:])
        # the most frequent first; ties by hash
        rank = np.lexsort((hashes, -counts))
        own = rank[: OWN_WORDS][counts[rank[:OWN_WORDS]] > 0]
        number = np.full(len(counts), -1, np.int32)
        number[own] = 1 + np.arange(len(own))
        order = np.argsort(hashes, kind="stable")
        self.keys, self.counts, self.number = hashes[order], counts[order], number[order]
        lengths = np.diff(offsets)[order]
        self.body, self.stops = body[ragged(offsets[:-1][order], lengths)], np.cumsum(lengths)
        self.starts = self.stops - lengths
        self.own = len(own)
        self.classes = 1 + self.own + OTHERS
        # shared classes hold what has no class of its own
        of = other_class(body, offsets[:-1][own], offsets[1:][own]) if len(own) else np.zeros(0, np.int64)
        tokens, kinds = tokens.copy(), kinds.copy()
        np.subtract.at(tokens, of, counts[own])
        np.subtract.at(kinds, of, 1)
        self.spread = np.log10(tokens + kinds + 1.0)
        self.totals = np.concatenate([[ends], counts[own], tokens]).astype(np.float64)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Each word's place in the table, or -1."""
        if not len(self.keys):
            return np.full(len(starts), -1)
        hashes = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = self.keys[at] == hashes
        own = np.flatnonzero(known)
        known[own] = same_spans(data, starts[own], ends[own], self.body, self.starts[at[own]], self.stops[at[own]])
        return np.where(known, at, -1)


# ---------------------------------------------------------------- sequences


SEQUENCES = (
    "part int, row bigint, doc_id bigint, role int, n_tokens bigint, known bigint, counts double, spread double, "
    "seq binary, rare array<struct<word:binary,n:bigint>>"
)
_RARE = pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))
_NAMES = ["part", "row", "doc_id", "role", "n_tokens", "known", "counts", "spread", "seq", "rare"]


def sequences(source: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """A row per text: its class numbers (unsigned 16-bit), what the table says of
    its words (``known`` occurrences, the sum ``counts`` of log10(c + 1)), the sum
    ``spread`` of what the score takes off that (log10(n + v + 1) of shared classes,
    log10(c + 1) of single ones), and the words that are not in the table."""
    shared = source.sparkSession.sparkContext.broadcast(vocabulary)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own_part, row = TaskContext.get().partitionId(), 0
        v = shared.value
        logs = np.log10(v.counts + 1.0)
        for batch in batches:
            for i, j, own, starts, ends, text in _stretches(batch.column(1)):
                n = j - i
                number = np.zeros(0, np.int64)
                if len(starts):
                    _, first, back = np.unique(span_hashes(own, starts, ends), return_index=True, return_inverse=True)
                    place = v.look_up(own, starts[first], ends[first])
                    other = other_class(own, starts[first], ends[first])
                    single = np.where(place >= 0, v.number[place], -1) if len(v.keys) else np.full(len(first), -1)
                    classes = np.where(single >= 0, single, 1 + v.own + other)
                    log = np.where(place >= 0, logs[place], 0.0) if len(v.keys) else np.zeros(len(first))
                    cost = np.where(single >= 0, log, v.spread[other])  # taken off the score
                    known = (place >= 0) & (v.counts[place] > 0) if len(v.keys) else np.zeros(len(first), bool)
                    number, rare = classes[back], (place < 0)[back]
                else:
                    first = back = np.zeros(0, np.int64)
                    log = cost = np.zeros(0)
                    known, rare = np.zeros(0, bool), np.zeros(0, bool)
                per = lambda x: np.bincount(text, weights=x[back], minlength=n).astype(np.float64)
                lengths = np.bincount(text, minlength=n)
                # an end behind each text
                seq = np.zeros(len(number) + n, "<u2")
                seq[np.arange(len(number)) + text] = number
                edges = np.concatenate([[0], np.cumsum(lengths + 1)])
                # words that are not in the table, once a text
                listed, times = np.unique(text[rare] * max(len(first), 1) + back[rare], return_counts=True)
                of, word = listed // max(len(first), 1), listed % max(len(first), 1)
                items = pa.StructArray.from_arrays(
                    [_binaries(own, starts[first[word]], ends[first[word]]), pa.array(times.astype(np.int64))], ["word", "n"]
                )
                list_edges = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=n))]).astype(np.int32)
                seq_edges = pa.py_buffer((edges * 2).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, own_part, np.int32)), pa.array(np.arange(row, row + n)),
                        batch.column(0).slice(i, n), batch.column(2).slice(i, n), pa.array((lengths + 1).astype(np.int64)),
                        pa.array(per(known).astype(np.int64)), pa.array(per(log)), pa.array(per(cost)),
                        pa.Array.from_buffers(pa.binary(), n, [None, seq_edges, pa.py_buffer(seq)]),
                        pa.ListArray.from_arrays(pa.array(list_edges), items),
                    ],
                    _NAMES,
                )
                row += n

    return source.mapInArrow(lean(encode), SEQUENCES)


# -------------------------------------------------------------------- model


class Model:
    """Start, transition and emission probabilities."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray, share: np.ndarray):
        self.start, self.move, self.emit, self.share = start, move, emit, share

    @classmethod
    def first(cls, totals: np.ndarray, states: int, seed: int = 20240611) -> "Model":
        """Emissions are the classes' shares, weighted at random state by state;
        states tend to stay."""
        rng = np.random.default_rng(seed)
        emit = (totals[:, None] + 0.5) * rng.gamma(0.5, size=(len(totals), states)) + 1e-3
        emit[0] = totals[0] + 0.5
        move = np.full((states, states), (1 - STAY) / max(states - 1, 1)) + np.eye(states) * (STAY - (1 - STAY) / max(states - 1, 1))
        even = np.full(states, 1 / states)
        return cls(even, move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), even)

    @classmethod
    def of_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray, totals: np.ndarray) -> "Model":
        """Expected counts plus a little of the classes' shares, so that no
        probability is 0."""
        share = emit.sum(axis=0) + 1.0
        emit = emit + 0.5 * (totals[:, None] + 1) / (totals.sum() + len(totals)) * len(totals) / 8 + 1e-6
        move, start = move + 0.1, start + 0.1
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0), share / share.sum())


def _by_time(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequences in order of falling length, how many go on at each time, and
    where each time's rows begin."""
    order = np.argsort(-lengths, kind="stable")
    going = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left")
    return order, going, np.concatenate([[0], np.cumsum(going)])


def expected(model: Model, seq: np.ndarray, starts: np.ndarray, lengths: np.ndarray, inner: np.ndarray) -> tuple:
    """Expected start, transition and emission counts of pieces, and the sum of
    the logarithms of their scales. ``inner`` marks pieces inside a text."""
    move, emit = model.move.astype(np.float32), model.emit.astype(np.float32)
    states = len(move)
    order, going, at = _by_time(lengths)
    begins = starts[order]
    which = np.concatenate([begins[:n] + t for t, n in enumerate(going)])
    obs = seq[which]
    alpha = emit[obs]
    scale = np.empty(len(obs), np.float32)
    first = np.where(inner[order][:, None], model.share, model.start).astype(np.float32)
    for t, n in enumerate(going):
        now = alpha[at[t] : at[t] + n]
        now *= first if t == 0 else alpha[at[t - 1] : at[t - 1] + n] @ move
        scale[at[t] : at[t] + n] = total = now.sum(axis=1)
        now /= total[:, None]
    # weight: emission times backward value over scale, of every row
    weight = emit[obs] / scale[:, None]
    back = np.ones((len(obs), states), np.float32)
    for t in range(len(going) - 2, -1, -1):
        n = going[t + 1]
        later = slice(at[t + 1], at[t + 1] + n)
        weight[later] *= back[later]
        np.matmul(weight[later], move.T, out=back[at[t] : at[t] + n])
    rows = np.arange(going[0], len(obs)) if len(going) else np.zeros(0, np.int64)
    before = rows - np.repeat(going[:-1], going[1:]) if len(rows) else rows
    moves = (alpha[before].T.astype(np.float64) @ weight[rows].astype(np.float64)) * model.move
    alpha *= back
    begin = alpha[: going[0]][~inner[order]].sum(axis=0, dtype=np.float64)
    return begin, moves, obs, alpha, float(np.log10(scale, dtype=np.float64).sum())


def pieces(edges: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length, text and number within the text of pieces of ``most`` tokens."""
    lengths = np.diff(edges)
    n = -(-lengths // most)
    text = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    starts = edges[:-1][text] + number * most
    return starts, np.minimum(most, edges[1:][text] - starts), text, number


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = text_bytes(column)
    return np.frombuffer(data, "<u2"), offsets // 2


def train(rows: DataFrame, vocabulary: Vocabulary, states: int = STATES, rounds: int = ROUNDS) -> Model:
    """Baum-Welch over the training rows of ``sequences``."""
    sc = rows.sparkSession.sparkContext
    model = Model.first(vocabulary.totals, states)
    classes = vocabulary.classes
    names = [f"s{k}" for k in range(states)]
    schema = "line int, " + ", ".join(f"{n} bigint" for n in names)
    training = rows.where("role = 0").select("seq")
    for _ in range(rounds):
        shared = sc.broadcast(model)

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            emit, move, start = np.zeros((classes, states)), np.zeros((states, states)), np.zeros(states)
            for batch in batches:
                seq, edges = _sequences(batch.column(0))
                begins, lengths, _, number = pieces(edges, PIECE)
                cuts = np.concatenate([[0], np.cumsum(lengths)])
                for a, b in windows(cuts, GROUP_TOKENS):
                    s, m, obs, gamma, _ = expected(own, seq, begins[a:b], lengths[a:b], number[a:b] > 0)
                    start += s
                    move += m
                    for k in range(states):
                        emit[:, k] += np.bincount(obs, weights=gamma[:, k], minlength=classes)
            lines = np.concatenate([emit, move, start[None]])
            used = np.flatnonzero(lines.any(axis=1))
            fixed = np.rint(lines[used] * FIXED_POINT).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(used.astype(np.int32)), *[pa.array(fixed[:, k]) for k in range(states)]], ["line", *names]
            )

        sums = training.mapInArrow(lean(expect), schema).groupBy("line").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
        lines = np.zeros((classes + states + 1, states))  # one line a class: the model's own size
        lines[sums.column("line").to_numpy()] = np.stack([sums.column(n).to_numpy() for n in names], axis=1) / FIXED_POINT
        shared.destroy()
        model = Model.of_counts(lines[-1], lines[classes:-1], lines[:classes], vocabulary.totals)
    return model


def log_likelihoods(model: Model, seq: np.ndarray, edges: np.ndarray, long_: int = LONG) -> np.ndarray:
    """log10 of the probability of every sequence, by scaled forward recursion."""
    states = len(model.move)
    starts, lengths, text, number = pieces(edges, long_)
    # a later piece of a long text runs from each state: its transfer matrix
    copies = np.where(number > 0, states, 1)
    piece = np.repeat(np.arange(len(text)), copies)
    state = np.arange(len(piece)) - np.repeat(np.cumsum(copies) - copies, copies)
    inner = (number > 0)[piece]
    order, going, _ = _by_time(lengths[piece])
    begins = starts[piece][order]
    now = np.where(inner[order][:, None], model.move[state[order]], model.start[None, :])
    log = np.zeros(len(piece))
    for t, n in enumerate(going):
        if n < len(now):
            _set(last, log, order, now, scale, n)
            now, scale = now[:n], scale[:n]
        elif t == 0:
            last, scale = np.zeros((len(piece), states)), np.zeros(n)
        if t:
            now = now @ model.move
        now = now * model.emit[seq[begins[:n] + t]]
        total = now.sum(axis=1)
        now /= total[:, None]
        scale = scale + np.log10(total)
    if len(going):
        _set(last, log, order, now, scale, 0)
    out = np.zeros(len(edges) - 1)
    firsts = np.cumsum(copies) - copies
    once = number == 0
    out[text[once]] = log[firsts[once]]
    later = np.flatnonzero(~once)
    held: dict[int, np.ndarray] = {}
    for p in later:  # pieces of a text in order
        d = int(text[p])
        vector = held.get(d)
        if vector is None:
            vector = last[firsts[p - 1]]
        rows = slice(firsts[p], firsts[p] + states)
        top = log[rows].max()
        vector = (vector * 10.0 ** (log[rows] - top)) @ last[rows]
        total = vector.sum()
        out[d] += top + np.log10(total)
        held = {d: vector / total}
    return out


def _set(last, log, order, now, scale, n) -> None:
    """Keep the end values of the rows from ``n`` on."""
    last[order[n : len(now)]] = now[n:]
    log[order[n : len(now)]] = scale[n:]


# ----------------------------------------------------------------- operator


def score_texts(
    docs: DataFrame, states: int = STATES, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for
    each row of ``docs``."""
    source = _source(docs, id_col, text_col)
    counts = stored(count_words(source), "word-counts")
    totals = counts.agg(F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v")).first()
    ends = source.where("role = 0").count()
    n, v = (totals.n or 0) + ends, totals.v + (ends > 0)

    least = border(counts, "t", TABLE_WORDS)
    table = counts.where(F.col("t") >= least).select("word", "c").toArrow()  # at most TABLE_WORDS rows
    vocabulary = Vocabulary(table, *class_totals(counts), ends)
    rows = stored(sequences(source, vocabulary), "sequences")
    model = train(rows, vocabulary, states, rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            likelihood = log_likelihoods(shared.value, *_sequences(batch.column(2)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(likelihood)], ["part", "row", "forward"])

    likelihoods = rows.select("part", "row", "seq").mapInArrow(lean(forward), "part int, row bigint, forward double")
    # words below the border: few occurrences each, so no hot key
    listed = rows.select("part", "row", F.explode("rare").alias("r")).select("part", "row", "r.word", "r.n")
    rare = listed.join(counts.where(F.col("t") < least).select("word", "c"), "word").groupBy("part", "row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log10(F.col("c") + F.lit(1.0))).alias("rare_counts"),
    )
    base = rows.select("part", "row", "doc_id", "role", "n_tokens", "known", "counts", "spread")
    joined = base.join(likelihoods, ["part", "row"]).join(rare, ["part", "row"], "left")
    end_log = float(np.log10(ends + 1.0))
    found = F.col("counts") + F.coalesce("rare_counts", F.lit(0.0))
    return joined.select(
        "doc_id", (F.col("role") == 1).alias("held_out"), "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0)) + F.lit(int(ends > 0))).alias("n_known"),
        F.lit(n).cast("bigint").alias("train_tokens"),
        (found + F.lit(end_log) - F.col("n_tokens") * F.lit(float(np.log10(n + v + 1)))).alias("base_score"),
        (F.col("forward") + found - F.col("spread")).alias("score"),
    )
