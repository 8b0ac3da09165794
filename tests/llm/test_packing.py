import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spreadkit.llm import queries
from spreadkit.llm.packing import Places, combinations, pack, pack_documents, repeat_counts, running_count

from support import ODD, SF, docs, empty
from test_token_counts import library

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, ids_of, window):
    """Pieces tile every document, sequences are gapless and hold no padding."""
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length))
    assert set(pieces) == set(ids_of)
    for doc, own in pieces.items():
        ids, at = np.array(ids_of[doc], "<u4"), 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start : at].tobytes())
        assert at == len(ids)
    assert sorted(sequences) == list(range(len(sequences)))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or at < window and at & (at - 1) == 0


def crc(df):
    return df.withColumn("ids_crc32", F.crc32("ids"))


def test_query_packs_every_document(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = {r.doc_id: [*ids, 1] for r, ids in zip(rows, library("word_bpe_49k.json", [r.text for r in rows]))}
    check(queries.op4_packing(spark, SF).collect(), want, 2048)


def test_small_window_odd_texts_and_clashes(spark):
    texts = ODD + ["a b c d e f g h i j"] * 40 + ["x " * 100, "y " * 64]
    want = {i: [*ids, 1] for i, ids in enumerate(library("word_bpe_49k.json", texts))}
    df = docs(spark, texts, clashes=True).repartition(5)
    check(crc(pack_documents(df, PATH, window=16)).collect(), want, 16)


def test_empty_table_null_and_repeated_ids(spark):
    assert pack_documents(empty(spark), PATH).collect() == []
    df = docs(spark, ["a b", "a b"]).selectExpr("cast(null as bigint) as doc_id", "text").unionAll(docs(spark, ["c"] * 3).selectExpr("7L", "text"))
    rows = pack_documents(df, PATH, window=4).collect()
    assert sum(r.length for r in rows) == 3 + 3 + 2 * 3
    assert {r.doc_id for r in rows} == {None, 7}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 30), min_size=15, max_size=15))
def test_plan_places_every_tail_once(counts):
    window, histogram = 16, np.array([0, *counts])
    plan = pack(histogram, window, first_sequence=3)
    fills = defaultdict(list)
    places = Places(plan, window)
    for tail in range(1, window):
        for rank in range(histogram[tail]):
            _, rows = places.of(np.array([tail]), np.array([rank]))
            at = 0
            for r in plan[rows]:
                assert r[3] == at
                at += r[4]
                fills[r[5] + rank - r[1]].append((r[6], r[4]))
            assert at == tail
    assert sorted(fills) == list(range(3, 3 + len(fills)))
    for own in fills.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == window or at & (at - 1) == 0


def test_least_squares_finds_the_exact_mix():
    """40 x (700, 700, 648) and 25 x (1000, 1048) are recovered whole."""
    h = np.zeros(2048, np.int64)
    h[700], h[648], h[1000], h[1048] = 80, 40, 25, 25
    combos = combinations(h, 2048)
    x = dict(zip(combos, repeat_counts(combos, h)))
    assert x[(648, 700, 700)] >= 39 and x[(1000, 1048)] == 25
    assert len(np.unique(pack(h, 2048)[:, 5])) <= 70


def test_running_count():
    seen = np.zeros(4, np.int64)
    assert running_count(np.array([2, 1, 2, 2]), seen).tolist() == [0, 0, 1, 2]
    assert running_count(np.array([1, 2, 0]), seen).tolist() == [1, 3, 0]
