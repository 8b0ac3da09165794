import zlib

import numpy as np
import public_tokenizers
import pytest

from spreadkit.llm import queries
from spreadkit.llm.id_planes import BLOCK_IDS, from_planes, read_ids, to_planes, write_and_read, write_ids
from spreadkit.llm.tables import work_path

from support import ODD, SF, docs, empty, thue_morse
from test_token_counts import library

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("unit", ["bit", "byte"])
@pytest.mark.parametrize("n,top", [(0, 1), (1, 0), (7, 1), (BLOCK_IDS, 50_000), (BLOCK_IDS + 3, 2**32 - 1)])
def test_planes_round_trip(unit, n, top):
    ids = np.random.default_rng(n).integers(0, top + 1, n, dtype=np.uint64).astype("<u4")
    assert np.array_equal(from_planes(to_planes(ids, unit), n, unit), ids)


def test_query_reads_back_every_id(spark):
    rows = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r.doc_id)
    got = sorted(queries.op10_id_planes(spark, SF).collect(), key=lambda r: r.doc_id)
    at = 0
    assert len(got) == len(rows)
    for r, ids, g in zip(rows, library("byte_bpe_50k.json", [r.text for r in rows]), got):
        own = np.array([*ids, 0], "<u4")
        assert (g.doc_id, g.start, g.n_tokens, g.ids_crc32) == (r.doc_id, at, len(own), zlib.crc32(own.tobytes()))
        at += len(own)


def test_index_seeks_chunks(spark):
    path = work_path(spark, "planes")
    write_ids(docs(spark, ["a b"] * 50), path, PATH, unit="byte")
    index = spark.read.parquet(f"{path}/index").orderBy("start").collect()
    assert index[0].start == 0 and sum(r.n_docs for r in index) == 50
    for r, nxt in zip(index, index[1:]):
        assert nxt.start == r.start + r.n_ids and nxt.first_doc > r.last_doc
    assert read_ids(spark, path).count() == 50


def test_odd_texts_null_and_repeated_ids_and_empty(spark):
    df = docs(spark, ODD, clashes=True)
    nulls = df.selectExpr("cast(null as bigint) as doc_id", *df.columns[1:])
    rows = write_and_read(df.unionAll(df).unionAll(nulls), PATH).orderBy("start").collect()
    assert [r.doc_id for r in rows] == [None] * len(ODD) + sorted(2 * list(range(len(ODD))))
    want = sorted(3 * [len(x) + 1 for x in library("byte_bpe_50k.json", ODD)])
    assert sorted(r.n_tokens for r in rows) == want
    assert [r.start for r in rows] == np.cumsum([0, *[r.n_tokens for r in rows]])[:-1].tolist()
    assert write_and_read(empty(spark), PATH).collect() == []


def test_words_that_collide_under_polynomial_hashes(spark):
    texts = thue_morse(1024, "ab")
    rows = write_and_read(docs(spark, texts), PATH).orderBy("doc_id").collect()
    assert [np.frombuffer(r.ids, "<u4")[:-1].tolist() for r in rows] == library("byte_bpe_50k.json", texts)


def test_rows_of_one_id_spread_over_tasks(spark):
    df = docs(spark, [f"text {i} of many" for i in range(4000)]).selectExpr("cast(null as bigint) AS doc_id", "text")
    path = work_path(spark, "planes")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_ids(df, path, PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert spark.read.parquet(f"{path}/index").select("shard").distinct().count() > 1
    assert read_ids(spark, path).count() == 4000
