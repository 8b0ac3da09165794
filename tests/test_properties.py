"""Property tests: the tokenizer against a model of Java's String.split(" "),
and answers that must not depend on row order or partitioning."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from spreadkit.functions.text import tokens
from spreadkit.operators import counts, geometry, words


def java_split_space(s: str) -> list[str]:
    """String.split(" ") with limit 0: trailing empty strings removed; no
    match at all returns the input itself (so "" gives [""])."""
    if " " not in s:
        return [s]
    parts = s.split(" ")
    while parts and parts[-1] == "":
        parts.pop()
    return parts


TEXT = st.text(alphabet=st.sampled_from(list("ab \n\tc")), max_size=12)


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_tokens_match_java_split(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    got = {r.doc_id: r.t for r in df.select("doc_id", tokens("text").alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [java_split_space(t) for t in texts]


def test_tokens_match_java_split_many(spark):
    rng = random.Random(7)
    texts = ["".join(rng.choice("ab  \n") for _ in range(rng.randint(0, 9))) for _ in range(400)]
    texts += ["", " ", "  ", " a", "a ", "a  b", "  a  "]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r.t for r in df.select("doc_id", tokens("text").alias("t")).collect()}
    assert [got[i] for i in range(len(texts))] == [java_split_space(t) for t in texts]


def test_word_count_matches_python_model(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choice(["x", "y", "", "zz", "x\ny"]) for _ in range(rng.randint(0, 8)))
             for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want: dict[str, int] = {}
    for t in texts:
        for w in java_split_space(t):
            want[w] = want.get(w, 0) + 1
    for strategy in ("direct", "salted", "partition"):
        got = dict(map(tuple, words.word_count(df, strategy=strategy).collect()))
        assert got == want, strategy


def test_counts_do_not_depend_on_partitioning(spark):
    rng = random.Random(3)
    rows = [(i, rng.choice("abcdefg")) for i in range(-500, 500)]
    df = spark.createDataFrame(rows, "key bigint, class string")
    base = sorted(map(tuple, counts.class_count(df).collect()))
    for parts in (1, 3, 13):
        shuffled = df.repartition(parts)
        assert sorted(map(tuple, counts.class_count(shuffled, strategy="two_round", buckets=parts).collect())) == base
        assert counts.most_frequent(counts.class_count(shuffled)).collect() == counts.most_frequent(
            counts.class_count(df)).collect()


def test_diameter_is_at_least_every_pair(spark):
    rng = random.Random(5)
    pts = [(i, [rng.uniform(-5, 5), rng.uniform(-5, 5), rng.uniform(-5, 5)]) for i in range(60)]
    df = spark.createDataFrame(pts, "id bigint, vec array<double>")
    d = geometry.diameter(df).first()[0]
    brute = max(sum((a - b) ** 2 for a, b in zip(p[1], q[1])) ** 0.5 for p in pts for q in pts)
    assert abs(d - brute) <= 1e-12 * brute
    avg = geometry.avg_pairwise_distance(df).first()[0]
    pairs = [sum((a - b) ** 2 for a, b in zip(p[1], q[1])) ** 0.5 for i, p in enumerate(pts) for q in pts[i + 1:]]
    assert abs(avg - sum(pairs) / len(pairs)) <= 1e-9
