from collections import Counter

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from spreadkit.llm import queries
from spreadkit.llm.repetition import judged, keep_good, measure, quality
from spreadkit.llm.textarrays import text_bytes

from support import ODD, SF, WORD, docs, empty, thue_morse


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    n = len(w)

    def covered(m):
        c = Counter(tuple(w[i : i + m]) for i in range(n - m + 1))
        own = [0] * n
        for i in range(n - m + 1):
            if c[tuple(w[i : i + m])] > 1:
                own[i : i + m] = [1] * m
        return sum(own)

    longest = 0
    for m in range(5, n):
        if max(Counter(tuple(w[i : i + m]) for i in range(n - m + 1)).values()) < 2:
            break
        longest = m
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return [n, sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), covered(3), covered(5), longest]


def measured(texts):
    return measure(*text_bytes(pa.array(texts, pa.string()))).T.tolist()


TEXTS = st.lists(st.lists(st.sampled_from(["a", "b", "cé", " ", "\n", "\t", "#|"]), max_size=40).map("".join), max_size=6)


@settings(max_examples=300, deadline=None)
@given(TEXTS)
def test_measures_equal_brute_force(texts):
    assert measured(texts) == [brute(t) for t in texts]


def test_odd_texts():
    texts = ODD + ["a a a a a a a a a a", "the end\n", "the end", "\n\nq\n\nq", "x\n x\nx \nx"]
    assert measured(texts) == [brute(t) for t in texts]


def test_a_very_long_text():
    text = " ".join(["lorem", "ipsum"] * 200_000) + " dolor"
    assert measured([text]) == [[400_001, 2_000_005, 0, 0, 400_000, 400_000, 399_998]]


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op3_repetition(spark, SF).collect()
    assert len(got) == len(rows)
    for r in got:
        want = brute(rows[r.doc_id])
        n, repeat, cover, longest = want[0], *want[4:]
        failed = n < 50 or 100 * repeat > 50 * n
        kept = not failed and 100 * cover <= 40 * n and 100 * longest <= 25 * n
        assert [r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.covered_words, r.longest_repeat] == want
        assert (r.base_failed, r.kept) == (failed, kept)


def test_verdicts():
    clean = " ".join(f"w{i}" for i in range(200))
    half = clean + " " + " ".join(f"w{i}" for i in range(70))  # one repeat of 70 of 270 words
    _, failed, kept = judged(pa.array([clean, half, "w " * 100, "too short"]))
    assert failed.tolist() == [False, True, True, True] and kept.tolist() == [True, False, False, False]
    third = clean + " " + " ".join(f"w{i}" for i in range(60))
    _, failed, kept = judged(pa.array([third]))  # 120 of 260 words lie in repeats
    assert not failed[0] and not kept[0]


def test_keep_good_keeps_rows_as_they_are(spark):
    clean = " ".join(f"w{i}" for i in range(60))
    df = docs(spark, [clean, "bad", None, clean], clashes=True)
    got = keep_good(df)
    assert got.columns == df.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.where("doc_id in (0, 3)").collect()))
    assert keep_good(empty(spark)).collect() == [] and quality(empty(spark)).collect() == []


def test_words_that_collide_under_polynomial_hashes():
    for n in (64, 1024, 65_536):
        x, y = thue_morse(n, "ex")
        texts = [f"{x} q r {y} q r", f"{x}\n{y}", f"{x} q r {x} q r", f"{x}\n{x}"]
        assert measured(texts) == [brute(t) for t in texts]
