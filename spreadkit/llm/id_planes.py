"""Token ids in a file format of bit planes.

A *chunk* holds the ids of whole documents, about ``CHUNK_IDS`` of them, in
blocks of ``BLOCK_IDS``. A block is transposed into planes: plane k is bit k
(or byte k) of every id. Each plane is compressed with zstandard on its own, so
the planes of high bits, which hardly change, cost next to nothing. A chunk is
one record of a Parquet file, which brings commits that survive lost executors
and any store that Spark can write; the chunk index is a second, small table
with what a reader needs to seek: shard, chunk, ids before it, first and last
document, and size.

Shards are ranges of doc_id in ascending order, so ids lie in doc_id order; null
ids come first. Null and empty texts are the end id alone; rows with the same id
are stored as separate documents, next to each other. An empty table gives an
empty file set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spreadkit.llm.tables import work_path
from spreadkit.llm.textarrays import text_bytes
from spreadkit.llm.token_counts import encoder

BLOCK_IDS = 1 << 16
CHUNK_IDS = 1 << 18
CHUNKS = (
    "shard int, chunk int, start bigint, n_ids bigint, n_docs bigint, first_doc bigint, last_doc bigint, "
    "unit string, doc_ids array<bigint>, lengths array<bigint>, planes array<binary>"
)
INDEX = ["shard", "chunk", "start", "n_ids", "n_docs", "first_doc", "last_doc"]


def to_planes(ids: np.ndarray, unit: str = "bit", level: int = 3) -> list[bytes]:
    """Compressed planes of all blocks, low plane first within a block. The
    first entry holds the number of planes of a block."""
    width = max(1, int(ids.max(initial=0)).bit_length())
    n = width if unit == "bit" else -(-width // 8)
    pack, out = zstandard.ZstdCompressor(level=level), [bytes([n])]
    for at in range(0, len(ids), BLOCK_IDS):
        block = np.ascontiguousarray(ids[at : at + BLOCK_IDS], "<u4")
        for k in range(n):
            plane = np.packbits((block >> np.uint32(k)) & np.uint32(1)) if unit == "bit" else block.view(np.uint8)[k::4]
            out.append(pack.compress(plane.tobytes()))
    return out


def from_planes(planes: list[bytes], n_ids: int, unit: str = "bit") -> np.ndarray:
    n, open_ = planes[0][0], zstandard.ZstdDecompressor()
    ids = np.zeros(n_ids, "<u4")
    for b, at in enumerate(range(0, n_ids, BLOCK_IDS)):
        block = ids[at : at + BLOCK_IDS]
        for k in range(n):
            raw = np.frombuffer(open_.decompress(planes[1 + b * n + k]), np.uint8)
            if unit == "bit":
                block |= np.unpackbits(raw, count=len(block)).astype("<u4") << np.uint32(k)
            else:
                block |= raw.astype("<u4") << np.uint32(8 * k)
    return ids


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    rule: str = "keep",
    end_id: int = 0,
    unit: str = "bit",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode all texts and write ``path/chunks`` and ``path/index``."""

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, chunk, start = TaskContext.get().partitionId(), 0, 0
        ids, docs_, lengths, held = [], [], [], 0

        def row() -> pa.RecordBatch:
            own = np.concatenate(ids)
            values = [shard, chunk, start, held, len(docs_), docs_[0], docs_[-1], unit, docs_, lengths, to_planes(own, unit)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, ARROW)], NAMES)

        for batch in batches:
            flat, counts = encoder(tokenizer_path, rule, False).encode(*text_bytes(batch.column(1)))
            edges = np.concatenate([[0], np.cumsum(counts)])
            for doc, a, b in zip(batch.column(0).to_pylist(), edges[:-1], edges[1:]):
                ids += [flat[a:b], np.array([end_id], np.uint32)]
                docs_.append(doc)
                lengths.append(int(b - a) + 1)
                held += lengths[-1]
                if held >= CHUNK_IDS:
                    yield row()
                    chunk, start = chunk + 1, start + held
                    ids, docs_, lengths, held = [], [], [], 0
        if docs_:
            yield row()

    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    # by the text too: rows of one id, or of none, need not share a task
    order = ["doc_id", F.xxhash64("text")]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.mapInArrow(chunks, CHUNKS).write.option("compression", "none").parquet(f"{path}/chunks")

    own = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").select(*INDEX)
    totals = {r.shard: r.n for r in own.groupBy("shard").agg(F.sum("n_ids").alias("n")).collect()}  # one row a file
    shards, before = [], 0
    for shard in sorted(totals):
        shards.append((shard, before))
        before += totals[shard]
    base = spark.createDataFrame(shards, "shard int, before bigint")
    index = own.join(F.broadcast(base), "shard").withColumn("start", F.col("start") + F.col("before")).drop("before")
    index.write.parquet(f"{path}/index")


_INT64 = pa.list_(pa.int64())
ARROW = [pa.int32(), pa.int32(), *[pa.int64()] * 5, pa.string(), _INT64, _INT64, pa.list_(pa.binary())]
NAMES = [f.split()[0] for f in CHUNKS.split(", ")]


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` of every document in the files; ``ids``
    are little-endian unsigned 32-bit, ``start`` counts the ids before it."""

    def open_(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids = from_planes(r["planes"], r["n_ids"], r["unit"])
                n = np.array(r["lengths"], np.int64)
                edges = np.concatenate([[0], np.cumsum(n)])
                bodies = [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                columns = [pa.array(r["doc_ids"], pa.int64()), pa.array(r["start"] + edges[:-1]), pa.array(n)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(bodies, pa.binary())], ["doc_id", "start", "n_tokens", "ids"])

    index = spark.read.parquet(f"{path}/index").select("shard", "chunk", "start")
    chunks = spark.read.schema(CHUNKS).parquet(f"{path}/chunks").drop("start")
    joined = chunks.join(index, ["shard", "chunk"]).select("start", "n_ids", "unit", "doc_ids", "lengths", "planes")
    return joined.mapInArrow(open_, "doc_id bigint, start bigint, n_tokens bigint, ids binary")




def write_and_read(docs: DataFrame, tokenizer_path: str, **options) -> DataFrame:
    """Write the ids of ``docs`` into the shared folder and read them back."""
    spark = docs.sparkSession
    path = work_path(spark, "id-planes")
    write_ids(docs, path, tokenizer_path, **options)
    return read_ids(spark, path)
