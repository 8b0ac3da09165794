import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from spreadkit.llm import count_rtree, ngram_join, queries
from spreadkit.llm.components import components
from spreadkit.llm.count_rtree import CountRTree, count_vector, least_overlap
from spreadkit.llm.ngram_join import keep_one, ngram_components

from support import ODD, SF, WORD, docs, empty, thue_morse

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    """doc -> (set size, smallest doc reachable), by all pairs that share a shingle."""
    sets = {k: shingles(t) for k, t in texts.items()}
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders, shared = defaultdict(list), Counter()
    for k in sorted(sets):
        for s in sets[k]:
            shared.update((k, h) for h in holders[s])
            holders[s].append(k)
    for (a, b), c in shared.items():
        if 100 * c >= 80 * (len(sets[a]) + len(sets[b]) - c):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), find(k)) for k in sets}


def family(rng, n, words, edits):
    """Copies of one text, each with some words changed."""
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    return out


def corpus(seed):
    """Families around the border of similarity, exact copies, one common
    passage, nested texts, short and odd ones."""
    rng = random.Random(seed)
    texts = []
    for words, edits in ((300, 8), (60, 2), (1200, 30), (12, 1), (40, 3)):
        texts += family(rng, 25, words, edits)
    texts += ["the same text again and again"] * 40 + ["The Same text AGAIN and again"] * 5
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [f"{passage} {' '.join(family(rng, 1, 80, 0))}" for _ in range(90)]
    texts += [" ".join(f"n{i}" for i in range(k)) for k in range(60, 140, 3)]  # a chain of links
    texts += ["a b", "a b", "a", "A", "a b c d", "b a"] + ODD
    rng.shuffle(texts)
    return dict(enumerate(texts))


@pytest.mark.parametrize("seed,chunk,frequent", [(1, 4096, 64), (2, 7, 8)])
def test_components_equal_brute_force(spark, monkeypatch, seed, chunk, frequent):
    monkeypatch.setattr(ngram_join, "CHUNK", chunk)  # blocks in many chunks
    monkeypatch.setattr(ngram_join, "FREQUENT_LEAST", frequent)
    texts = corpus(seed)
    want = brute(texts)
    got = ngram_components(docs(spark, list(texts.values()), clashes=True).repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(want)
    links = Counter(c for _, c in want.values())
    assert max(links.values()) >= 45 and len(links) > 90


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op2_ngram_join(spark, SF).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(texts)


def test_null_and_repeated_ids_and_empty(spark):
    df = docs(spark, ["p q r s t u"] * 3 + ["other words here"])
    rows = ngram_components(df.unionAll(df).unionAll(df.selectExpr("cast(null as bigint) as doc_id", "text"))).collect()
    assert len(rows) == 12
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == {
        (0, 2, 0), (1, 2, 0), (2, 2, 0), (3, 1, 3), (None, 2, None), (None, 1, None)
    }
    assert ngram_components(empty(spark)).collect() == []
    assert ngram_components(docs(spark, [None, "", " "])).orderBy("doc_id").collect() == [(0, 0, 0), (1, 0, 1), (2, 0, 2)]


def test_keep_one(spark):
    df = docs(spark, ["p q r s t u"] * 3 + ["other words here", None, ""], clashes=True)
    got = keep_one(df)
    assert got.columns == df.columns
    assert sorted(r.doc_id for r in got.collect()) == [0, 3, 4, 5]


def test_rtree_finds_every_allowed_pair():
    rng = np.random.default_rng(3)
    sets = []
    for size in (5, 40, 300, 2000):
        base = rng.integers(0, 2**63, size, dtype=np.uint64)
        for _ in range(40):
            own = base.copy()
            own[rng.random(size) < rng.random() * 0.3] = rng.integers(0, 2**63)
            sets.append(np.unique(own))
    vectors, sizes = [count_vector(s) for s in sets], np.array([len(s) for s in sets])
    labels = np.arange(len(sets)) // 3
    tree = CountRTree(vectors, sizes, labels)
    found = {(int(a), int(b)) for q, p in tree.search(vectors, sizes, labels, 80) for a, b in zip(q, p)}
    linked = {
        (a, b) for a in range(len(sets)) for b in range(len(sets))
        if labels[a] != labels[b] and len(np.intersect1d(sets[a], sets[b])) >= least_overlap(sizes[a], sizes[b], 80)
    }
    assert linked and linked <= found and all(labels[a] != labels[b] for a, b in found)
    assert len(found) < 0.5 * len(sets) ** 2
    assert not list(CountRTree([], np.zeros(0, np.int64), np.zeros(0, np.int64)).search(vectors, sizes, labels, 80))
    assert count_rtree.folded(vectors[-1], 64).sum() == sizes[-1]


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(100, 130)] + [(7, k) for k in range(50, 60)] + [(3, 4), (4, 3), (9, 9)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r.id: r.label for r in components(df).collect()}
    assert got == {**{i: 100 for i in range(100, 131)}, 7: 7, **{k: 7 for k in range(50, 60)}, 3: 3, 4: 3, 9: 9}
    assert components(df.where("a < 0")).collect() == []


def test_texts_of_colliding_words_do_not_link(spark):
    """Words that agree under any polynomial hash modulo 2^64 are different words."""
    texts = [" ".join([w, *"abcdefg"]) for n in (1024, 65_536) for w in thue_morse(n, "ex")]
    texts += [" ".join(thue_morse(1024, "pq")[k] for k in bits) for bits in ([0] * 6, [1] * 6)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_components(docs(spark, texts)).collect()}
    assert got == brute(dict(enumerate(texts)))
    assert [got[k][1] for k in range(len(texts))] == list(range(len(texts)))
