import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spreadkit.llm import queries
from spreadkit.llm import units
from spreadkit.llm.textarrays import same_spans, span_hashes, text_bytes, windows, words
from spreadkit.llm.token_counts import token_counts
from spreadkit.llm.units import UnitEncoder

from support import ODD, SF, WORD, docs, empty, thue_morse

RULES = [("word_bpe_49k.json", "drop"), ("byte_bpe_50k.json", "keep")]
EXTRA = ["don't I'LL we've  123 4", "a\n\n b", "ΑΣ ΣΑΣ É́ x ́y", "a\x85 b", "x  y", "a<|endof <|endoftext|> <|end", "<| |>"]


def library(name, texts):
    t = Tokenizer.from_file(public_tokenizers.path(name))
    return [e.ids for e in t.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]


@pytest.mark.parametrize("name,rule", RULES)
def test_ids_equal_the_library(name, rule):
    texts = ODD + EXTRA + ["ab " * 300_000, "y" * 30_000]
    ids, counts = UnitEncoder(public_tokenizers.path(name), rule).encode(*text_bytes(pa.array(texts)))
    want = library(name, texts)
    assert counts.tolist() == [len(x) for x in want]
    assert np.array_equal(ids, np.concatenate([np.array(x, np.uint32) for x in want]))


ALPHABET = st.sampled_from(list("aZ1'.<|> \n\t 　é́") + ["<|endoftext|>"])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=5))
def test_ids_equal_the_library_on_any_text(texts):
    for name, rule in RULES:
        ids, counts = ENCODERS[name].encode(*text_bytes(pa.array(texts, pa.string())))
        want = library_of(name, texts)
        assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


ENCODERS = {name: UnitEncoder(public_tokenizers.path(name), rule) for name, rule in RULES}
LIBRARY = {name: Tokenizer.from_file(public_tokenizers.path(name)) for name, _ in RULES}


def library_of(name, texts):
    return [LIBRARY[name].encode(t, add_special_tokens=False).ids for t in texts]


def test_words_and_hashes():
    texts = ODD + ["x" * (4103) + " " + "x" * (4103) + " " + "x" * (4102)]
    data, offsets = text_bytes(pa.array(texts))
    starts, ends, own = words(data, offsets)
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert got == [w for t in texts for w in WORD.findall(t or "")]
    assert own.tolist() == [i for i, t in enumerate(texts) for _ in WORD.findall(t or "")]
    hashes = span_hashes(data, starts, ends)
    assert len(set(hashes.tolist())) == len(set(got)) and hashes[-2] == hashes[-3] != hashes[-1]
    assert [w for w in windows(np.array([0, 0, 5, 30, 31]), 6)] == [(0, 2), (2, 3), (3, 4)]


@pytest.mark.parametrize("name,rule", RULES)
def test_words_that_collide_under_polynomial_hashes(name, rule):
    texts = [w for n in (64, 1024, 65_536) for w in thue_morse(n, "ex")]
    ids, counts = UnitEncoder(public_tokenizers.path(name), rule).encode(*text_bytes(pa.array(texts)))
    want = library(name, texts)
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_bytes_decide_when_hashes_agree(monkeypatch):
    """With a hash of few values, cached and fresh units still get their own ids."""
    monkeypatch.setattr(units, "span_hashes", lambda data, starts, ends: ((ends - starts) % 3).astype(np.uint64))
    own = UnitEncoder(public_tokenizers.path("word_bpe_49k.json"), "drop")
    for texts in (["one two three four", "five six seven one"], ["eight two nine five", "x" * 700 + " " + "y" * 700]):
        ids, _ = own.encode(*text_bytes(pa.array(texts)))
        assert ids.tolist() == [i for x in library("word_bpe_49k.json", texts) for i in x]


def test_cache_stays_within_its_bytes(monkeypatch):
    monkeypatch.setattr(units, "CACHE_BYTES", 20_000)
    own = UnitEncoder(public_tokenizers.path("word_bpe_49k.json"), "drop")
    for k in range(8):
        texts = [" ".join(f"w{k}x{i}" for i in range(300))]
        ids, _ = own.encode(*text_bytes(pa.array(texts)))
        assert ids.tolist() == library("word_bpe_49k.json", texts)[0] and own._cache_bytes() < 60_000


def test_same_spans():
    data, offsets = text_bytes(pa.array(["abcdefgh", "abcdefgi", "abcdefgh", "a" * 300, "a" * 299 + "b", "a" * 300, ""]))
    s, e = offsets[:-1], offsets[1:]
    pairs = [(0, 1), (0, 2), (3, 4), (3, 5), (0, 6), (6, 6)]
    a, b = np.array(pairs).T
    assert same_spans(data, s[a], e[a], data, s[b], e[b]).tolist() == [False, True, False, True, False, True]


def test_query_counts_every_document(spark):
    got = {r.doc_id: r for r in queries.op1_token_counts(spark, SF).collect()}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = library("word_bpe_49k.json", [r.text for r in rows])
    assert len(got) == len(rows)
    for r, ids in zip(rows, want):
        assert got[r.doc_id].n_tokens == len(ids) and got[r.doc_id].over_limit == (len(ids) > 2048)
        assert got[r.doc_id].n_bytes == len(r.text.encode())


def test_nulls_repeats_clashes_and_empty(spark):
    df = docs(spark, ODD, clashes=True)
    df = df.unionAll(df).unionAll(df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:]))
    path = public_tokenizers.path("word_bpe_49k.json")
    rows = token_counts(df, path).collect()
    want = [len(x) for x in library("word_bpe_49k.json", ODD)]
    assert len(rows) == 3 * len(ODD) and sorted(r.n_tokens for r in rows) == sorted(3 * want)
    assert token_counts(empty(spark), path).collect() == []


def test_sentencepiece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    p = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts(docs(spark, ODD), path).orderBy("doc_id").collect()
    assert [r.n_tokens for r in got] == [len(p.encode(t or "")) for t in ODD]
