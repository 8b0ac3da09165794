"""Jaccard join of documents on word n-grams, by count-vector R-trees.

Two documents link when the Jaccard similarity of their sets of 5-word shingles
is 0.8 or more; documents are grouped into components of links. The sets are of
64-bit shingle hashes.

1. Documents with equal sets are one class, named by its smallest doc_id.
2. Linked sets share one of the first n - ceil(0.8 n) + 1 shingles of each set in
   any one order of all shingles. The order puts frequent shingles last (those
   of passages that many documents share), then goes by hash; frequencies come
   from all documents. Classes that share such a shingle form a block, named by
   the smallest class with it: every link lies within some block.
3. Each class is compared with the block's name it shares most shingles with.
   That already joins most groups of copies, however large, with one comparison
   a class; components of these links are labels.
4. Blocks that hold more than one label are searched with an R-tree over count
   vectors, which skips what has the query's label and bounds overlaps by summed
   minima. A block of many classes is dealt into chunks, each with a tree of its
   own; only classes outside the block's commonest label are sent to all chunks
   (a pair of different labels has one such class).
5. Pairs that the bound allows are compared exactly, and components taken anew.

No pairs within a group of copies are listed, no link between different sets is
lost, and there is no limit on a block or group.

Null and empty texts, and texts of white space, have the empty set and link with
nothing. Rows with a null doc_id get their n_shingles and a null component.
Rows with one doc_id and different texts count as documents of the same name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.components import components
from spreadkit.llm.count_rtree import CountRTree, count_vector, least_overlap
from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import LOWER, mix, span_hashes, text_bytes, windows, words
from spreadkit.llm.workers import lean
from spreadkit.runtime import fits_broadcast

NGRAM = 5
PERCENT = 80
# shingles called frequent, on every worker as 8 bytes each
FREQUENT_LIMIT = 500_000
FREQUENT_LEAST = 64
CHUNK = 4096
_BUFFER = 1 << 21

_P = np.uint64(0x9FB21C651E98DF25)


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    data, offsets = text_bytes(column)
    for i, j in windows(offsets):
        lo = offsets[i]
        own = LOWER[data[lo : offsets[j]]]
        starts, ends, text = words(own, offsets[i : j + 1] - lo)
        hashes = span_hashes(own, starts, ends)
        long_ = _fold([hashes[k : len(hashes) - NGRAM + 1 + k] for k in range(NGRAM)])
        counts = np.bincount(text, minlength=j - i)
        edges = np.concatenate([[0], np.cumsum(counts)])
        for a, n in zip(edges[:-1].tolist(), counts.tolist()):
            if n >= NGRAM:
                yield np.unique(long_[a : a + n - NGRAM + 1])
            else:
                yield _fold([hashes[a + k : a + k + 1] for k in range(n)]) if n else hashes[:0]


def _fold(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of several words in order, and of how many they are."""
    if min(len(p) for p in parts) == 0:
        return np.zeros(0, np.uint64)
    state = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        state = mix(state * _P + part)
    return state


def documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))


def frequent_shingles(docs: DataFrame) -> np.ndarray:
    """Shingles of many documents. Each task counts runs of ``_BUFFER`` shingles
    and passes on those that repeat, so counts are lower bounds, which is all an
    order needs. At most FREQUENT_LIMIT shingles reach the border count."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def repeated() -> pa.RecordBatch:
            keys, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(keys[n > 3].view(np.int64)), pa.array(n[n > 3])], ["tok", "n"])

        for batch in batches:
            for own in shingle_sets(batch.column(0)):
                held.append(own)
                size += len(own)
                if size >= _BUFFER:
                    yield repeated()
                    held, size = [], 0
        if held:
            yield repeated()

    counts = stored(docs.select("text").mapInArrow(lean(count), "tok bigint, n bigint").groupBy("tok").agg(F.sum("n").alias("n")), "counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    border = max(FREQUENT_LEAST, total // FREQUENT_LIMIT + 1)
    rows = counts.where(F.col("n") >= border).select("tok").toArrow()
    return np.sort(rows.column(0).to_numpy().astype(np.int64).view(np.uint64))


def signatures(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """``doc_id, n, f1, f2, prefix``: size and fingerprint of each set, and the
    shingles one of which any linked set must share."""
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = shared.value
        seen = np.zeros(1 << 22, bool)
        seen[(common >> np.uint64(42)).astype(np.int64)] = True
        for batch in batches:
            n, f1, f2, prefixes = [], [], [], []
            for own in shingle_sets(batch.column(1)):
                n.append(len(own))
                f1.append(int(np.add.reduce(mix(own))))
                f2.append(int(np.bitwise_xor.reduce(mix(own * _P + np.uint64(1)))))
                length = len(own) - -(-percent * len(own) // 100) + 1 if len(own) else 0
                if len(common) and len(own):
                    last = seen[(own >> np.uint64(42)).astype(np.int64)]
                    maybe = np.flatnonzero(last)
                    at = np.minimum(np.searchsorted(common, own[maybe]), len(common) - 1)
                    last[maybe] = common[at] == own[maybe]
                    own = np.concatenate([own[~last], own[last]])
                prefixes.append(own[:length].view(np.int64))
            lengths = np.array([len(p) for p in prefixes], np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(n, pa.int64()), pa.array(np.array(f1, np.uint64).view(np.int64)),
                    pa.array(np.array(f2, np.uint64).view(np.int64)), pa.ListArray.from_arrays(offsets, pa.array(flat)),
                ],
                ["doc_id", "n", "f1", "f2", "prefix"],
            )

    return docs.mapInArrow(lean(sign), "doc_id bigint, n bigint, f1 bigint, f2 bigint, prefix array<bigint>")


def needed(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """``docs`` without those that a join on ``ids`` (``most`` of them at most)
    will drop anyway, if the ids are few enough to broadcast."""
    if not fits_broadcast(docs.sparkSession, most, 16):
        return docs
    return docs.join(F.broadcast(ids.select(F.col(ids.columns[0]).alias("doc_id")).distinct()), "doc_id", "left_semi")


def verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` (a written table) whose sets are similar: the count
    vectors' bound first, then the sets themselves."""

    def similar(x: np.ndarray, y: np.ndarray) -> bool:
        need = least_overlap(len(x), len(y), percent)
        if CountRTree._bound(count_vector(x), count_vector(y)) < need:
            return False
        return len(np.intersect1d(x, y, assume_unique=True)) >= need

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [len(x) > 0 and len(y) > 0 and similar(x, y) for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    ends = pairs.select("a").unionAll(pairs.select(F.col("b").alias("a")))
    docs = needed(docs, ends, 2 * pairs.count())
    one = docs.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    two = docs.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(lean(check), "a bigint, b bigint")


def candidates(members: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs of different labels within the blocks of ``members`` (``block, id,
    n, label, minority, chunks``) that the R-trees' bound allows."""

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [count_vector(s).astype("<u4").tobytes() for s in shingle_sets(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.binary())], ["id", "vector"])

    points = docs.mapInArrow(lean(vectors), "id bigint, vector binary")
    home = F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int")
    everywhere = F.sequence(F.lit(0), F.col("chunks") - 1)
    placed = members.join(points, "id").select(
        "block", "id", "n", "label", "vector", "minority", home.alias("home"),
        F.explode(F.when(F.col("minority"), everywhere).otherwise(F.array(home))).alias("chunk"),
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, ids, key = None, None, None
        for own, rows in chunk_parts(batches):
            vectors = [np.frombuffer(v, "<u4").astype(np.int32) for v in rows["vector"]]
            n, label = np.array(rows["n"], np.int64), np.array(rows["label"], np.int64)
            here, asked = np.array(rows["id"], np.int64), np.flatnonzero(rows["minority"])
            if own[:2] != key:
                tree, ids, key = None, None, own[:2]
            if own[2]:  # the chunk's own classes come first: at most about CHUNK
                tree, ids = CountRTree(vectors, n, label), here
            if tree is None:
                continue
            for q, p in tree.search([vectors[k] for k in asked], n[asked], label[asked], percent):
                x, y = here[asked[q]], ids[p]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], ["a", "b"])

    ordered = (
        placed.withColumn("own", F.col("home") == F.col("chunk")).repartition(F.col("block"), F.col("chunk"))
        .sortWithinPartitions("block", "chunk", F.desc("own"))
    )
    return ordered.mapInArrow(lean(search), "a bigint, b bigint").where("a < b").distinct()


def chunk_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, dict[str, list]]]:
    """``(block, chunk, own)`` and rows, from rows in that order: the own classes
    of a chunk in one part, those that are sent to it in parts of ``CHUNK``."""
    key, held = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch.select(["id", "n", "label", "vector", "minority"])
        marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("block", "chunk", "own")]
        cuts = np.flatnonzero(np.logical_or.reduce([m[1:] != m[:-1] for m in marks])) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            part, now = rows.slice(a, b - a).to_pydict(), tuple(m[a].item() for m in marks)
            if held and (now != key or (not key[2] and len(held["id"]) >= CHUNK)):
                yield key, held
                held = None
            key = now
            held = {k: held[k] + v for k, v in part.items()} if held else part
    if held:
        yield key, held


def ngram_components(
    docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``."""
    source = documents(docs, id_col, text_col)
    signed = stored(signatures(source, frequent_shingles(source), percent), "signatures")
    classes = signed.where("n > 0 and doc_id is not null").groupBy("f1", "f2", "n").agg(
        F.min("doc_id").alias("id"), F.first("prefix").alias("prefix")
    )
    tokens = classes.select(F.explode("prefix").alias("tok"), "id", "n")
    names = tokens.groupBy("tok").agg(
        F.min("id").alias("block"), F.min_by("n", "id").alias("block_n"), F.count("*").alias("c")
    ).where("c > 1").drop("c")
    blocks = stored(
        tokens.join(names, "tok").where("id != block").groupBy("block", "block_n", "id", "n").agg(F.count("*").alias("shared")),
        "blocks",
    )

    # one comparison a class, with the name it shares most shingles with
    near = blocks.where(f"100 * least(n, block_n) >= {percent} * greatest(n, block_n)")
    best = near.groupBy("id").agg(F.max(F.struct("shared", (-F.col("block")).alias("minus"))).alias("best"))
    stars = stored(best.select((-F.col("best.minus")).alias("a"), F.col("id").alias("b")), "stars")
    first = stored(verified(stars, source, percent), "links")
    labels = components(first)

    # blocks with more than one label
    members = blocks.select("block", "id", "n").unionByName(
        blocks.groupBy("block").agg(F.min("block_n").alias("n")).select("block", F.col("block").alias("id"), "n")
    )
    labelled = members.join(labels, "id", "left").select("block", "id", "n", F.coalesce("label", "id").alias("label"))
    labelled = stored(labelled, "members")
    sizes = labelled.groupBy("block", "label").agg(F.count("*").alias("m"), F.min("n").alias("low"), F.max("n").alias("high"))
    kinds = sizes.groupBy("block").agg(
        F.max(F.struct("m", "label")).alias("most"), F.sum("m").alias("m"), F.count("*").alias("labels"),
        F.min("low").alias("low"), F.max("high").alias("high"),
    )
    # two classes of unlike size need no search
    mixed = kinds.where(f"labels > 1 and (m > 2 or 100 * low >= {percent} * high)").select(
        "block", F.col("most.label").alias("common"), F.ceil(F.col("m") / CHUNK).cast("int").alias("chunks")
    )
    searched = labelled.join(mixed, "block").select(
        "block", "id", "n", "label", (F.col("label") != F.col("common")).alias("minority"), "chunks"
    )
    pairs = stored(candidates(searched, source, percent), "pairs")
    links = first.unionByName(verified(pairs, source, percent))
    final = components(links)

    named = stored(
        classes.select("f1", "f2", "n", "id").join(final, "id", "left").select(
            "f1", "f2", "n", F.coalesce("label", "id").alias("label")
        ),
        "named",
    )  # written, so that the join below can split a class of many copies
    return signed.drop("prefix").join(named, ["f1", "f2", "n"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that name their component, all columns as they are.
    Rows with a null id stay, as do all rows of a doc_id that stays."""
    found = ngram_components(docs, percent, id_col, text_col)
    gone = found.where("component_id < doc_id").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
