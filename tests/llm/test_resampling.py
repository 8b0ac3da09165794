import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spreadkit.llm import queries
from spreadkit.llm.resampling import BUCKETS, TEMPER, feature_counts, features, log_weights, resample
from spreadkit.llm.textarrays import text_bytes

from support import ODD, SF, WORD, docs, empty

LABELS = "doc_id bigint, quality int, toxic int"


def bags(texts):
    buckets, own = features(*text_bytes(pa.array(texts, pa.string())))
    return [Counter(buckets[own == i].tolist()) for i in range(len(texts))]


def test_features_are_uni_and_bigrams():
    texts = ODD + ["a b a b", "A B", "a  b", "b a"]
    got = bags(texts)
    for t, bag in zip(texts, got):
        n = len(WORD.findall(t or ""))
        assert sum(bag.values()) == max(0, 2 * n - 1)
    assert got[-2] == got[-3] != got[-1]
    assert got[-4] - got[-3] - got[-3] == got[-1] - got[-3]  # (a b a b) is twice (a b) and the bigram (b a)


def test_weights_equal_the_definition(spark):
    texts = ["good text here", "good text", "spam spam spam", None, "good spam"]
    df = docs(spark, texts)
    target, raw = feature_counts(df.where("doc_id < 2")), feature_counts(df)
    p, q = Counter(), Counter()
    for i, bag in enumerate(bags(texts)):
        q += bag
        p += bag if i < 2 else Counter()
    for r in log_weights(df, target, raw, np.array([0, 1])).collect():
        bag = bags(texts)[r.doc_id]
        others = p - bag if r.doc_id < 2 else p  # its own counts don't speak for it
        want = sum(
            n * (math.log((others[b] + 1) / (others.total() + BUCKETS)) - math.log((q[b] + 1) / (q.total() + BUCKETS)))
            for b, n in bag.items()
        )
        assert math.isclose(r.log_weight, want, abs_tol=1e-9)


@pytest.mark.parametrize("share", [0.0, 0.1, 0.5, 1.0])
def test_top_k_is_exact(spark, share):
    df = docs(spark, [f"w{i % 17} w{i % 5} x" for i in range(300)]).repartition(4)
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(0, 300, 2)], LABELS)
    rows = resample(df, labels, share=share).collect()
    k = round(300 * share)
    best = sorted(rows, key=lambda r: (-r.score, r.doc_id))[:k]
    assert {r.doc_id for r in rows if r.kept} == {r.doc_id for r in best} and len(rows) == 300


def test_noise_is_gumbel(spark):
    rows = resample(docs(spark, ["same text"] * 4000), spark.createDataFrame([], LABELS), share=0.5).collect()
    noise = np.array([r.score - r.log_weight / r.n_features**TEMPER for r in rows])
    assert abs(noise.mean() - 0.5772) < 0.1 and abs(noise.std() - math.pi / math.sqrt(6)) < 0.1


def test_query_keeps_clean_and_drops_junk(spark):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    got = queries.op6_resampling(spark, sf).join(labels, "doc_id")
    rates = {r.quality: r.share for r in got.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert rates[1] > 0.8 and rates[0] < 0.2


def test_nulls_contradictions_clashes_and_empty(spark):
    df = docs(spark, ODD, clashes=True)
    df = df.unionAll(df).unionAll(df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:]))
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 1, None), (6, 1, 0), (None, 1, 0), (7, None, None)], LABELS)
    rows = resample(df, labels.selectExpr("*", "1 as text")).collect()
    assert len(rows) == 3 * len(ODD)
    assert not any(r.kept for r in rows if r.doc_id is None)
    assert not any(r.kept for r in rows if not r.n_features)  # nothing to judge
    for d in range(len(ODD)):  # equal rows share their fate
        assert len({r.kept for r in rows if r.doc_id == d}) == 1
    assert resample(empty(spark), labels).collect() == []


def test_empty_texts_are_not_eligible(spark):
    """200 empty texts beside good and bad ones: none is kept, nor do they take a place."""
    texts = ["good words of a clean text here"] * 60 + ["bad spam junk noise of it all"] * 60 + [""] * 200
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(0, 120, 2)], LABELS)
    rows = {r.doc_id: r for r in resample(docs(spark, texts), labels).collect()}
    assert sum(r.kept for r in rows.values()) == 60 and not any(rows[i].kept or rows[i].score for i in range(120, 320))


def test_noise_decides_between_texts_of_like_weight(spark):
    """Long texts of one kind: the draw is no cut by weight."""
    rng = np.random.default_rng(1)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choice(words, n)) for n in rng.integers(50, 2000, 300)]
    labels = spark.createDataFrame([(i, int(i % 2), 0) for i in range(100)], LABELS)
    rows = resample(docs(spark, texts), labels, share=0.5).collect()
    by_weight = sorted(rows, key=lambda r: r.log_weight / r.n_features**TEMPER)[150:]
    same = {r.doc_id for r in rows if r.kept} & {r.doc_id for r in by_weight}
    assert 75 < len(same) < 150  # the draw is neither the weight alone nor the noise alone
