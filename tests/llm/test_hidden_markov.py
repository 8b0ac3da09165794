import math
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest

from spreadkit.llm import hidden_markov as H
from spreadkit.llm import queries
from spreadkit.llm.routed import ABOVE_ALL, border

from support import ODD, SF, WORD, docs, empty

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def small_model(states=3, classes=7, seed=1):
    rng = np.random.default_rng(seed)
    unit = lambda x, axis: x / x.sum(axis=axis, keepdims=True)
    return H.Model(
        unit(rng.random(states), 0), unit(rng.random((states, states)), 1), unit(rng.random((classes, states)), 0),
        unit(rng.random(states), 0),
    )


def by_paths(model, seq):
    """The probability of a sequence, state path by state path."""
    states = len(model.start)
    total = 0.0
    for path in product(range(states), repeat=len(seq)):
        p = model.start[path[0]] * model.emit[seq[0], path[0]]
        for a, b, o in zip(path, path[1:], seq[1:]):
            p *= model.move[a, b] * model.emit[o, b]
        total += p
    return total


@pytest.mark.parametrize("long_", [1, 2, 3, 100])
def test_likelihood_equals_the_sum_over_state_paths(long_):
    model, rng = small_model(), np.random.default_rng(3)
    lengths = np.array([1, 6, 3, 7, 2])
    edges = np.concatenate([[0], np.cumsum(lengths)])
    seq = rng.integers(0, 7, edges[-1]).astype("<u2")
    got = H.log_likelihoods(model, seq, edges, long_)
    want = [math.log10(by_paths(model, seq[a:b])) for a, b in zip(edges, edges[1:])]
    assert np.allclose(got, want, rtol=1e-12)
    assert len(H.log_likelihoods(model, seq[:0], np.zeros(1, np.int64), long_)) == 0


def test_a_long_text_in_pieces_is_the_whole_recursion():
    model = small_model()
    seq = np.random.default_rng(5).integers(0, 7, 40_000).astype("<u2")
    edges = np.array([0, 39_000, 40_000])
    assert np.allclose(H.log_likelihoods(model, seq, edges), H.log_likelihoods(model, seq, edges, 10**6), rtol=1e-11)


def test_expected_counts_equal_the_sum_over_state_paths():
    model, states = small_model(), 3
    lengths = np.array([4, 1, 5])
    starts = np.cumsum(lengths) - lengths
    seq = np.random.default_rng(7).integers(0, 7, 10).astype("<u2")
    inner = np.array([False, False, True])
    begin, moves, obs, gamma, _ = H.expected(model, seq, starts, lengths, inner)
    emit = np.stack([np.bincount(obs, gamma[:, k], 7) for k in range(states)], axis=1)
    want_begin, want_moves, want_emit = np.zeros(states), np.zeros((states, states)), np.zeros((7, states))
    for s, n, inside in zip(starts, lengths, inner):
        own, first, paths = seq[s : s + n], model.share if inside else model.start, {}
        for path in product(range(states), repeat=int(n)):
            p = first[path[0]] * model.emit[own[0], path[0]]
            for a, b, o in zip(path, path[1:], own[1:]):
                p *= model.move[a, b] * model.emit[o, b]
            paths[path] = p
        total = sum(paths.values())
        for path, p in paths.items():
            if not inside:
                want_begin[path[0]] += p / total
            for o, k in zip(own, path):
                want_emit[o, k] += p / total
            for a, b in zip(path, path[1:]):
                want_moves[a, b] += p / total
    for got, want in ((begin, want_begin), (moves, want_moves), (emit, want_emit)):
        assert np.allclose(got, want, atol=1e-5)


def brute(rows):
    """Contract columns of ``(doc_id, text)`` rows, one Python loop a token."""
    cut = [(d, WORD.findall((t or "").translate(LOWER))) for d, t in rows]
    role = lambda d: 2 if d is None else int(zlib.crc32(str(d).encode()) % 7 == 2)
    c = Counter(w for d, ws in cut if role(d) == 0 for w in ws)
    ends = sum(role(d) == 0 for d, _ in cut)
    n, v = sum(c.values()) + ends, len(c) + (ends > 0)
    out = []
    for d, ws in cut:
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws) + math.log10((ends + 1) / (n + v + 1))
        known = sum(c[w] > 0 for w in ws) + (ends > 0)
        out.append((d, role(d) == 1, len(ws) + 1, known, n, base))
    return out, c, ends


def test_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = {x[0]: x for x in brute(rows)[0]}
    got = queries.op12_hidden_markov(spark, SF).collect()
    assert len(got) == len(rows)
    for g in got:
        assert tuple(g)[:5] == want[g.doc_id][:5]
        assert g.base_score == pytest.approx(want[g.doc_id][5], rel=1e-9)
        assert g.score < 0
    held = [g for g in got if g.held_out]
    assert sum(g.score for g in held) > 1.02 * sum(g.base_score for g in held)  # negative: a better model of unseen texts


@pytest.mark.parametrize("table_words", [0, 40, 10**6])
def test_score_is_the_class_likelihood_times_the_words_in_their_classes(spark, monkeypatch, table_words):
    """A table of any size gives the same model probabilities."""
    monkeypatch.setattr(H, "TABLE_WORDS", table_words)
    monkeypatch.setattr(H, "OWN_WORDS", 20)
    rng = np.random.default_rng(11)
    texts = [" ".join(f"W{int(x)}" for x in rng.zipf(1.5, 40) if x < 500) for _ in range(60)] + ODD
    rows = list(enumerate(texts))
    df = docs(spark, texts)
    got = {r.doc_id: r for r in H.score_texts(df, rounds=2).collect()}
    want, c, ends = brute(rows)
    for w in want:
        g = got[w[0]]
        assert tuple(g)[:5] == w[:5] and g.base_score == pytest.approx(w[5], rel=1e-9)
    # the model again, from the operator's own parts
    source = H._source(df, "doc_id", "text")
    counts = H.count_words(source)
    least = border(counts, "t", table_words)
    vocabulary = H.Vocabulary(counts.where(f"t >= {least}").select("word", "c").toArrow(), *H.class_totals(counts), ends)
    model = H.train(H.sequences(source, vocabulary), vocabulary, rounds=2)
    known = {bytes(vocabulary.body[a:b]): k for a, b, k in zip(vocabulary.starts, vocabulary.stops, vocabulary.number)}
    n, v = np.zeros((2, H.OTHERS))
    one = lambda w: int(H.other_class(np.frombuffer(w, np.uint8), np.array([0]), np.array([len(w)]))[0])
    for w, k in c.items():
        if known.get(w.encode(), -1) < 0:
            n[one(w.encode())] += k
            v[one(w.encode())] += 1
    for d, t in rows:
        words = [w.encode() for w in WORD.findall((t or "").translate(LOWER))]
        classes = [known[w] if known.get(w, -1) >= 0 else 1 + vocabulary.own + one(w) for w in words] + [0]
        state, log = model.start, 0.0
        for k, o in enumerate(classes):
            state = (state @ model.move if k else state) * model.emit[o]
            log, state = log + math.log10(state.sum()), state / state.sum()
        inside = sum(math.log10((c[w.decode()] + 1) / (n[one(w)] + v[one(w)] + 1)) for w in words if known.get(w, -1) < 0)
        assert got[d].score == pytest.approx(log + inside, rel=1e-6)


def test_training_raises_the_likelihood(spark):
    texts = ["the cat sat on the mat"] * 30 + ["le chat est sur le tapis"] * 30
    scores = [sum(r.score for r in H.score_texts(docs(spark, texts), states=2, rounds=k).collect()) for k in (1, 6)]
    assert scores[1] > scores[0]


def test_nulls_repeats_clashes_and_empty(spark):
    df = docs(spark, ODD, clashes=True)
    df = df.unionAll(df).unionAll(df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:]))
    got = H.score_texts(df, rounds=1).collect()
    rows = [(d, t) for k in range(2) for d, t in enumerate(ODD)] + [(None, t) for t in ODD]
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:5], round(r[5], 6))
    assert sorted(map(key, got)) == sorted(map(key, brute(rows)[0]))
    assert H.score_texts(empty(spark), rounds=1).collect() == []
    nothing = docs(spark, ["a b"] * 3).selectExpr("cast(null as bigint) as doc_id", "text")
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in H.score_texts(nothing, rounds=1).collect())


def test_border(spark):
    counts = spark.createDataFrame([(k,) for k in [1] * 50 + [2] * 20 + [100, 101, 5000]], "t bigint")
    assert border(counts, "t", 10**6) == 1 and border(counts, "t", 22) == 100 and border(counts, "t", 0) == ABOVE_ALL
    assert border(counts, "t", 23) == 2 and border(counts.where("false"), "t", 5) == ABOVE_ALL
