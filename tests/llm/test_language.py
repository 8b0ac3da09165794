import zlib

import numpy as np

from spreadkit.llm import language, queries
from spreadkit.llm.language import DIMENSIONS, bundles, identify, learn, letter_vector, predict

from support import ODD, SF, docs, empty


def brute_bundle(text):
    """Trigrams of the lower-cased text, one by one."""
    letters = "".join(c if c.isalpha() else " " for c in (text or "").lower())
    padded = f" {' '.join(letters.split())} "
    out, n = np.zeros(DIMENSIONS), 0
    for a, b, c in zip(padded, padded[1:], padded[2:]):
        if b != " ":  # a trigram is around a letter
            va, vb, vc = (letter_vector(ord(x)).astype(int) for x in (a, b, c))
            out += np.roll(va, 2) * np.roll(vb, 1) * vc
            n += 1
    return n, out


def test_bundles_equal_brute_force():
    texts = ODD + ["Ab, cd! ab", "x", "¿Qué?", "日本語 text", "ß" * 5, "a-b c"]
    for _, counts, vectors in bundles(texts):
        for t, n, v in zip(texts, counts, vectors):
            want = brute_bundle(t)
            assert n == want[0] and np.array_equal(v, want[1])


def test_many_letters_take_the_other_path(monkeypatch):
    monkeypatch.setattr(language, "_SLICE", 100)
    monkeypatch.setattr(language, "_GROUP_CELLS", 300)
    texts = ["".join(chr(0x4E00 + (i * 7 + k) % 400) for k in range(60)) for i in range(30)]
    (_, counts, vectors), = bundles(texts)
    for t, n, v in zip(texts[::10], counts[::10], vectors[::10]):
        want = brute_bundle(t)
        assert n == want[0] and np.array_equal(v, want[1])


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries.op9_language(spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {d for d in rows if zlib.crc32(str(d).encode()) % 4 == 2}
    assert sum(r.lang_pred == rows[r.doc_id].lang for r in held) / len(held) > 0.99
    assert all(0 <= r.score <= 1 for r in got)


def test_prototypes_are_sums_of_bundles(spark):
    df = docs(spark, ["aa bb", "cc", "dd ee", None, "ff"]).selectExpr("*", "element_at(array('x','x','y','y',null), cast(doc_id + 1 as int)) as lang")
    languages, prototypes = learn(df)
    assert languages == ["x", "y"]
    assert np.array_equal(prototypes[0], brute_bundle("aa bb")[1] + brute_bundle("cc")[1])
    assert np.array_equal(prototypes[1], brute_bundle("dd ee")[1])


def test_und_ties_nulls_clashes_and_empty(spark):
    df = docs(spark, ["hello there", "12 34", None, "hello there"], clashes=True).selectExpr("*", "element_at(array('b','b','b','a'), cast(doc_id + 1 as int)) as lang")
    df = df.unionAll(df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:]))
    languages, prototypes = learn(df.where("doc_id is not null"))
    got = {(r.doc_id, r.lang_pred, r.score > 0.99) for r in predict(df, languages, prototypes).collect()}
    # equal prototypes: the smaller name
    assert got == {(d, "und" if i in (1, 2) else "a", i not in (1, 2)) for i in range(4) for d in (i, None)}
    out = identify(df).collect()
    assert len(out) == 8 and not any(r.held_out for r in out if r.doc_id is None)
    assert identify(empty(spark).selectExpr("*", "'x' as lang")).collect() == []
    untaught = identify(docs(spark, ["abc"]).selectExpr("*", "cast(null as string) as lang")).collect()
    assert [(r.lang_pred, r.score) for r in untaught] == [("und", 0.0)]
