
from spreadkit.functions.text import tokens
from spreadkit.operators import words
from spreadkit.sources import tables

from conftest import SF


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_fixture_b(spark):
    d = docs(spark, ["a bb a", "ccc bb ", ""])
    assert words.document_count(d).first()["n_docs"] == 3
    wc = dict(map(tuple, words.word_count(d).collect()))
    assert wc == {"a": 2, "bb": 2, "ccc": 1, "": 1}
    counts = words.word_count(d)
    assert words.distinct_word_count(counts).first()["n_words"] == 4
    assert words.avg_word_length(counts).first()["avg_word_length"] == 1


def test_tokenizer_edge_cases(spark):
    d = docs(spark, ["   ", " a", "a  b", "x\ny z", ""])
    got = [r.t for r in d.orderBy("doc_id").select(tokens("text").alias("t")).collect()]
    # the array literal for the all-space case is empty, and trailing empties are gone
    assert got == [[], ["", "a"], ["a", "", "b"], ["x\ny", "z"], [""]]


def test_strategies_agree(spark):
    d = tables.documents(spark, SF)
    base = sorted(map(tuple, words.word_count(d).collect()))
    for strategy in ("salted", "partition"):
        assert sorted(map(tuple, words.word_count(d, strategy=strategy).collect())) == base
    for salts in (1, 3, 16):
        salted = words.word_count(d, strategy="salted", salts=salts)
        assert sorted(map(tuple, salted.collect())) == base


def test_avg_word_length_empty_is_null(spark):
    d = docs(spark, ["   "])
    assert words.avg_word_length(words.word_count(d)).first()["avg_word_length"] is None


def test_token_counts(spark):
    d = docs(spark, ["a b", "", "  "])
    assert [r.n_tokens for r in words.token_counts(d).orderBy("doc_id").collect()] == [2, 1, 0]


def test_lengths_are_code_points_and_order_is_utf8(spark):
    from spreadkit.operators import counts

    d = docs(spark, ["\U0001F600a é"])  # a supplementary character, then e-acute
    counts_ = words.word_count(d)
    # "\U0001F600a" has 2 code points (3 UTF-16 units), "é" has 1: (2 + 1) div 2 = 1
    assert words.avg_word_length(counts_).first()["avg_word_length"] == 1
    ordered = [r["class"] for r in counts.sorted_by_class(
        spark.createDataFrame([(0, "ｚ"), (1, "\U0001F600"), (2, "z")], "key bigint, class string")
        .transform(counts.class_count)).collect()]
    assert ordered == ["z", "ｚ", "\U0001F600"]  # UTF-8 byte order


def test_lines_are_documents(spark):
    d = docs(spark, ["a b\nc", "x\r\ny\rz\n", "", "\n", "q\n\nr"])
    got = sorted(r.text for r in words.lines(d).collect())
    assert got == sorted(["a b", "c", "x", "y", "z", "", "q", "", "r"])
    assert words.line_count(d).first()["n_lines"] == 9
