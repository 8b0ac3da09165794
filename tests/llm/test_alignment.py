import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from spreadkit.llm import alignment, queries, units
from spreadkit.llm.alignment import Aligner, align, cut_units, jump
from spreadkit.llm.textarrays import text_bytes

from support import ODD, SF, docs, empty, thue_morse

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SPECIAL = ["<s>hi</s>", "<|endoftext|> x <|endoftext|>", "<0x0A> <unk>", "x▁y", "▁", "tab\tsep\r\nline\x0b\x0cq", "a\x00 b\x00\x00", "nb\xa0sp　x", "  two  spaces  ", "\n\n\n", "日本語 テキスト", "🙂🙂 ok", "é é"]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    byte_of = {chr(x): x for x in plain}
    byte_of |= {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}
    bytes_a = lambda i: bytes(byte_of[c] for c in a.id_to_token(i))
    bytes_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, bytes_a, bytes_b


def brute(texts, libraries):
    """The contract's columns by sets of end offsets."""
    a, b, bytes_a, bytes_b = libraries
    rows, links_of = [], []
    for t in texts:
        want = (" " + t).encode() if t else b""
        ids_a = a.encode(" " + t, add_special_tokens=False).ids if t else []
        ids_b = b.encode(t) if t else []
        ta, tb = [bytes_a(i) for i in ids_a], [bytes_b(i) for i in ids_b]
        if not t or b"".join(ta) != want or b"".join(tb) != want:
            rows.append((0, 0, 0, ""))
            links_of.append([])
            continue
        ends_a, ends_b = np.cumsum([len(x) for x in ta]).tolist(), np.cumsum([len(x) for x in tb]).tolist()
        links = [(ids_a[ends_a.index(e)], ids_b[ends_b.index(e)]) for e in sorted(set(ends_a) & set(ends_b))]
        parts, lo = [], 0
        for e in sorted(set(ends_a) & set(ends_b)):
            own = [",".join(str(i) for i, x in zip(ids, ends) if lo < x <= e) for ids, ends in ((ids_a, ends_a), (ids_b, ends_b))]
            parts.append("|".join(own))
            lo = e
        rows.append((len(ids_a), len(ids_b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest()))
        links_of.append(links)
    counts = Counter(x for links in links_of for x in links)
    top = Counter()
    for (_, y), n in counts.items():
        top[y] = max(top[y], n)
    out = []
    for r, links in zip(rows, links_of):
        best = sum(counts[x] == top[x[1]] for x in links)
        out.append((*r[:3], len(links), best, sum(counts[x] for x in links), r[3]))
    return out


def collected(df):
    return [tuple(r)[1:] for r in sorted(df.collect(), key=lambda r: r.doc_id)]


@pytest.mark.parametrize("table", [0, 5, 10**6])
def test_equals_brute_force(spark, libraries, monkeypatch, table):
    monkeypatch.setattr(alignment, "TABLE_PAIRS", table)
    texts = ODD + SPECIAL + ["the cat sat. The Cat", "unbelievably uncharacteristic", "the cat"] + thue_morse(1024, "ex")
    assert collected(align(docs(spark, texts), A, B)) == brute(texts, libraries)


def test_query_equals_brute_force(spark, libraries):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = collected(queries.op11_alignment(spark, SF))
    assert got == brute([r.text for r in rows], libraries)
    assert sum(g[2] for g in got) > 10_000


ALPHABET = st.sampled_from(list("aZ1'.<|> \n\t\r\x0b\x00 \xa0　é́日▁🙂s") + ["<s>", "</s>", "<|endoftext|>", "the", "ing"])
ALIGNER = Aligner(A, B)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=25).map("".join), max_size=5))
def test_units_give_the_whole_texts_tokens(texts):
    data, offsets = alignment._with_space(pa.array(texts, pa.string()))
    starts, ends, text = cut_units(data, offsets)
    a, b = ALIGNER.a.tokenizer, ALIGNER.b.model
    for own, whole in ((ALIGNER.a, lambda t: a.encode(" " + t, add_special_tokens=False).ids), (ALIGNER.b, b.encode)):
        slots, n = own.of(data, starts, ends)
        ids = own.ids(slots, n)
        per = np.bincount(text, weights=n, minlength=len(texts)).astype(int)
        got = [x.tolist() for x in np.split(ids, np.cumsum(per)[:-1])] if texts else []
        assert got == [list(whole(t)) if t else [] for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), min_size=1, max_size=30), st.lists(st.booleans(), min_size=30, max_size=30))
def test_jumps_end_at_the_component(a, b):
    total = len(a)
    ends_a = np.array(sorted({i + 1 for i in range(total) if a[i]} | {total}))
    ends_b = np.array(sorted({i + 1 for i in range(total) if b[i]} | {total}))
    shared = np.array(sorted(set(ends_a.tolist()) & set(ends_b.tolist())))
    want = [int(shared[np.searchsorted(shared, e)]) for e in [*ends_a, *ends_b]]
    assert ends_b[jump(ends_a, ends_b)].tolist() == want


def test_long_texts_in_stretches(monkeypatch, libraries):
    monkeypatch.setattr(alignment, "STRETCH_BYTES", 64)
    monkeypatch.setattr(units, "CACHE_BYTES", 4000)
    texts = ["the quick brown fox\njumps over unbelievable dogs " * 9, "x" * 300, "short", "bad ▁ " + "word " * 40, "y " * 100]
    got = alignment._texts(Aligner(A, B), *alignment._with_space(pa.array(texts)))
    want = brute(texts, libraries)
    assert [tuple(got[0][:3, k]) + (got[1][k],) for k in range(len(texts))] == [w[:3] + w[6:] for w in want]
    assert [int(t.sum()) for t in got[3]] == [w[3] for w in want]


def test_nulls_repeats_clashes_and_empty(spark, libraries):
    df = docs(spark, ODD, clashes=True)
    df = df.unionAll(df).unionAll(df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:]))
    got = [tuple(r)[1:] for r in align(df, A, B).collect()]
    assert Counter(got) == Counter(brute(3 * ODD, libraries))
    assert align(empty(spark), A, B).collect() == []


def test_cut_units_ends():
    data, offsets = text_bytes(pa.array(["", " a b", "", "c\nd", ""]))
    assert [x.tolist() for x in cut_units(data, offsets)] == [[0, 2, 4, 5], [2, 4, 5, 7], [1, 1, 3, 3]]
