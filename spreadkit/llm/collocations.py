"""Phrase collocations by dynamic itemset counting.

Texts are lower-cased (A-Z) and split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those
into words ``[^\\x20\\x09]+``; everything is counted per language (null: ``und``).

The rows are dealt into ``SHARDS`` written shards, and the shards are scanned in
turn, again and again. Scan ``t`` counts phrases of several lengths at once: words
from the first scan on, and a longer phrase from the first scan before which both
its subphrases (all but the last, all but the first word) had reached the
threshold. A phrase is counted over one full cycle of shards, so its total is
exact; the search ends when no phrase has reached the threshold in the last cycle.

* A worker knows the phrases that have reached the threshold by a Bloom filter of
  bounded size. Filters only grow, and a phrase is counted in scan ``t`` if the
  filter before ``t`` has both its subphrases and the one a cycle earlier had not;
  each phrase is so counted once on each shard, whatever the filter's mistakes.
  A mistake can only let a phrase be counted that is too rare anyway.
* The shards hold words as 64-bit hashes (the last bit says whether the piece goes
  on), so texts are cut into words once, not once a scan. A phrase is the row of
  its words' hashes.
* A task's counts leave it as blocks of phrases, dealt by a hash of the phrase into
  buckets of bounded size; a bucket's blocks are merged by sorting. No task holds
  a language.
* A phrase with a total of ``least`` has ``least / SHARDS`` in some scan. Only phrases
  that may have (a second filter) become rows that are summed over a cycle. The
  counts of a scan are removed when no later sum reads them.

Frequent phrases stay distributed. Cuts, containment and ranks are joins and
aggregates; a language's first rows are taken in two steps over salts.

Null and empty texts have no words. Row ids are not used, so repeated rows count
each time; further columns are not read; an empty table gives an empty result.
Equal scores and counts are ordered by the phrase's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spreadkit.llm.tables import stored, work_path
from spreadkit.llm.textarrays import LOWER, mix, ragged, span_hashes, text_bytes, windows
from spreadkit.llm.workers import lean
from spreadkit.runtime import fits_broadcast, remove_path

LEAST = 100
MOST_WORDS = 5
TOP = 2000
PER_MILLE = 1000
ABSORB_PERCENT = 100
SHARDS = 3
# a filter's size follows the number of words between these numbers of bits
FILTER_BITS = (1 << 20, 1 << 28)
PROBES = 4
BUCKET_WORDS = 1 << 21
SALTS = 32
_STRETCH = 1 << 20
_ROW_WORDS = 1 << 16
_HELD_BYTES = 24 << 20
_P = np.uint64(0x9FB21C651E98DF25)

_APART = np.zeros(256, bool)
_APART[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_INSIDE = ~_APART
_INSIDE[[0x20, 0x09]] = False

_GOES_ON = np.uint64(1)
TOKENS = "lang string, n bigint, words binary"
BLOCKS = "bucket bigint, lang string, length int, keys binary, counts binary"


def pieces_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and whether the next word follows in the same
    piece of the same text."""
    inside = _INSIDE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    if not len(s):
        return s, e, np.zeros(0, bool)
    apart = np.concatenate([[0], np.cumsum(_APART[data])])
    text = np.searchsorted(offsets, s, "right")
    joined = np.zeros(len(s), bool)
    joined[:-1] = (text[1:] == text[:-1]) & (apart[s[1:]] == apart[e[:-1]])
    return s, e, joined


def lang_seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode()))


def prints(seed: np.uint64, columns: list[np.ndarray]) -> np.ndarray:
    """One hash of a language and the words of phrases, for the filter."""
    state = np.full(len(columns[0]), seed, np.uint64)
    for column in columns:
        state = mix(state * _P + column)
    return state


def probes(hashes: np.ndarray, bits: int) -> Iterator[np.ndarray]:
    step = mix(hashes) | np.uint64(1)
    for k in range(PROBES):
        yield (hashes + np.uint64(k) * step) & np.uint64(bits - 1)


def holds(filters: list[np.ndarray], hashes: np.ndarray) -> list[np.ndarray]:
    """For each filter (unsigned 64-bit words, of one size) whether it may have
    each hash."""
    out = [np.ones(len(hashes), bool) for _ in filters]
    for at in probes(hashes, 64 * len(filters[0])):
        word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
        for own, filter_ in zip(out, filters):
            own &= (filter_[word] & bit) > 0
    return out


def to_count(filters: list[np.ndarray], seed: np.uint64, words: np.ndarray, joined: np.ndarray, most: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each length from 2 the places where a phrase starts whose subphrases
    the first filter has, and not the second (if there is one) too."""
    reached = [np.append(x, False) for x in holds(filters, prints(seed, [words]))]
    at = np.flatnonzero(joined)
    for length in range(2, most + 1):
        at = at[reached[0][at] & reached[0][at + 1]]
        done = reached[1][at] & reached[1][at + 1] if len(filters) > 1 else np.zeros(len(at), bool)
        yield length, at[~done]
        if length < most and len(at):
            # a longer phrase starts where this one and the next were counted and
            # have reached; the earlier filter is read as it was in its own scan
            found = holds(filters, prints(seed, [words[at + k] for k in range(length)]))
            reached = [np.zeros(len(words) + 1, bool) for _ in filters]
            for own, yes, counted in zip(reached, found, (np.ones(len(at), bool), done)):
                own[at[yes & counted]] = True
            at = at[joined[at + length - 1]]


def summed(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows of word hashes in the order of their prints, those, and how
    often each occurs (or the sums of ``counts``)."""
    own = prints(np.uint64(0), list(keys.T))
    order = np.argsort(own)
    own, keys = own[order], keys[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (keys[1:] != keys[:-1]).any(axis=1)
    first = np.flatnonzero(fresh)
    n = np.diff(np.append(first, len(keys))) if counts is None else np.add.reduceat(counts[order], first)
    return keys[first], own[first], n.astype(np.int64)


# ------------------------------------------------------------------- shards


def tokenised(source: DataFrame) -> DataFrame:
    """``lang, n, words``: the words of texts, in rows of some thousands that end
    where a piece ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, own, starts, ends, joined in _cut(batches):
            words = span_hashes(own, starts, ends) & ~_GOES_ON | joined
            stops = np.flatnonzero(~joined) + 1  # the last word ends a piece
            edges = [0]
            while edges[-1] < len(words):
                far, near = np.searchsorted(stops, [edges[-1] + _ROW_WORDS, edges[-1]], "right")
                edges.append(int(stops[max(far - 1, near)]))
            body = [words[a:b].astype("<u8").tobytes() for a, b in zip(edges, edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(body)), pa.array(np.diff(edges).astype(np.int64)), pa.array(body, pa.binary())],
                ["lang", "n", "words"],
            )

    return source.mapInArrow(lean(run), TOKENS)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Stretches of texts of one language: bytes, words, and whether a piece goes on."""
    for batch in batches:
        langs = np.array(batch.column(0).to_pylist(), object)
        for lang in sorted(set(langs)):
            data, offsets = text_bytes(batch.column(1).filter(pa.array(langs == lang)))
            for i, j in windows(offsets, _STRETCH):
                own = LOWER[data[offsets[i] : offsets[j]]]
                starts, ends, joined = pieces_words(own, offsets[i : j + 1] - offsets[i])
                if len(starts):
                    yield lang, own, starts, ends, joined


def scan(shard: DataFrame, now: np.ndarray, before: np.ndarray | None, first_cycle: bool, most: int, buckets: int) -> DataFrame:
    """Counts of one shard: ``lang, length, keys, counts``, blocks of phrases; each
    phrase is in one block of one row."""
    filters = [now] if before is None or not before.any() else [now, before]
    shared = shard.sparkSession.sparkContext.broadcast(filters)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, size = shared.value, {}, 0
        longer = own[0].any()
        for batch in batches:
            body, offsets = text_bytes(batch.column(1))
            for lang, a, b in zip(batch.column(0).to_pylist(), offsets, offsets[1:]):
                words = body[a:b].view("<u8")
                joined = (words & _GOES_ON).astype(bool)
                words = words & ~_GOES_ON
                if first_cycle:
                    held.setdefault((lang, 1), []).append(words[:, None])
                    size += words.nbytes
                if longer:
                    for length, at in to_count(own, lang_seed(lang), words, joined, most):
                        if len(at):
                            held.setdefault((lang, length), []).append(words[at[:, None] + np.arange(length)])
                            size += 8 * length * len(at)
                if size > _HELD_BYTES:
                    yield from _blocks(held, buckets)
                    held, size = {}, 0
        yield from _blocks(held, buckets)

    blocks = shard.select("lang", "words").mapInArrow(lean(count), BLOCKS)
    dealt = blocks.repartition("bucket").sortWithinPartitions("bucket", "lang", "length")
    return dealt.mapInArrow(lean(_merged), "lang string, length int, keys binary, counts binary")


def _blocks(held: dict, buckets: int) -> Iterator[pa.RecordBatch]:
    for (lang, length), rows in sorted(held.items()):
        keys, own, n = summed(np.concatenate(rows))
        bucket = (own >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)  # rises with the print
        edges = np.searchsorted(bucket, np.arange(buckets + 1, dtype=np.uint64))
        some = np.flatnonzero(np.diff(edges))
        spans = [(edges[k], edges[k + 1]) for k in some]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(some.astype(np.int64)), pa.array([lang] * len(some)), pa.array(np.full(len(some), length, np.int32)),
                pa.array([keys[a:b].astype("<u8").tobytes() for a, b in spans], pa.binary()),
                pa.array([n[a:b].astype("<i8").tobytes() for a, b in spans], pa.binary()),
            ],
            ["bucket", "lang", "length", "keys", "counts"],
        )


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of one bucket, language and length as one."""
    key, held = None, []

    def row() -> pa.RecordBatch:
        keys, _, n = summed(np.concatenate([k for k, _ in held]), np.concatenate([c for _, c in held]))
        body = [keys.astype("<u8").tobytes()], [n.astype("<i8").tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([key[1]]), pa.array([key[2]], pa.int32()), *[pa.array(x, pa.binary()) for x in body]],
            ["lang", "length", "keys", "counts"],
        )

    for batch in batches:
        for r in batch.to_pylist():
            own = (r["bucket"], r["lang"], r["length"])
            if held and own != key:
                yield row()
                held = []
            key = own
            held.append((np.frombuffer(r["keys"], "<u8").reshape(-1, r["length"]), np.frombuffer(r["counts"], "<i8")))
    if held:
        yield row()


# ------------------------------------------------------------------ filters


def _own_prints(lang: str, keys: np.ndarray) -> np.ndarray:
    return prints(lang_seed(lang), [np.ascontiguousarray(keys[:, k]) for k in range(keys.shape[1])])


def _as_bits(rows: DataFrame, hashes, size: int) -> np.ndarray:
    """A filter of ``size`` words with the prints that ``hashes`` finds in batches of
    ``rows``. Tasks send words of the filter, of which there are a bounded number."""

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(size, np.uint64)
        for batch in batches:
            for some in hashes(batch):
                for place in probes(some, 64 * size):
                    np.bitwise_or.at(own, (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
        at = np.flatnonzero(own)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int64)), pa.array(own[at].view(np.int64))], ["at", "bits"])

    sent = rows.mapInArrow(lean(bits), "at bigint, bits bigint").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(size, np.uint64)
    out[sent.column("at").to_numpy()] = sent.column("bits").to_numpy().view(np.uint64)
    return out


def _block_rows(batch: pa.RecordBatch) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    for r in batch.to_pylist():
        yield r["lang"], np.frombuffer(r["keys"], "<u8").reshape(-1, r["length"]), np.frombuffer(r["counts"], "<i8")


def heavy_bits(part: DataFrame, least: int, size: int) -> np.ndarray:
    """The phrases that one scan counts ``least`` times."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        for lang, keys, n in _block_rows(batch):
            yield _own_prints(lang, keys[n >= least])

    return _as_bits(part, hashes, size)


def key_bits(found: DataFrame, size: int) -> np.ndarray:
    """The phrases of ``found`` (``lang, key, ...``)."""

    def hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
        langs = np.array(batch.column(0).to_pylist(), object)
        data, offsets = text_bytes(batch.column(1))
        lengths = np.diff(offsets) // 8
        for lang in sorted(set(langs)):
            for length in np.unique(lengths[langs == lang]):
                at = np.flatnonzero((langs == lang) & (lengths == length))
                yield _own_prints(lang, data[ragged(offsets[at], lengths[at] * 8)].view("<u8").reshape(-1, length))

    return _as_bits(found.select("lang", "key"), hashes, size)


def totals(parts: list[DataFrame], heavy: np.ndarray, least: int) -> DataFrame:
    """``lang, key, n``: the phrases with ``least`` or more in all ``parts``, of those
    that ``heavy`` may have (all, if each has its share in one part)."""
    rows = reduce(DataFrame.unionByName, parts)
    shared = rows.sparkSession.sparkContext.broadcast(heavy)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, keys, n in _block_rows(batch):
                at = np.flatnonzero(holds([shared.value], _own_prints(lang, keys))[0])
                if len(at):
                    body = keys[at].astype("<u8").tobytes()
                    offsets = (np.arange(len(at) + 1) * 8 * keys.shape[1]).astype(np.int32)
                    key = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(body)])
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), key, pa.array(n[at])], ["lang", "key", "n"])

    picked = rows.mapInArrow(lean(pick), "lang string, key binary, n bigint")
    return picked.groupBy("lang", "key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


# ----------------------------------------------------------------- counting


def frequent_phrases(source: DataFrame, least: int, most: int, shards: int) -> tuple[DataFrame, DataFrame, int]:
    """``lang, key, n`` of all phrases of up to ``most`` words with ``least``
    occurrences, all words of each language, and the size of a filter."""
    spark = source.sparkSession
    path = work_path(spark, "shards")
    dealt = tokenised(source).withColumn("shard", F.floor(F.rand(20240611) * shards).cast("int"))
    dealt.write.option("compression", "zstd").partitionBy("shard").parquet(path)
    rows = spark.read.schema(f"{TOKENS}, shard int").parquet(path)
    sizes = stored(rows.groupBy("lang").agg(F.sum("n").alias("n")), "sizes")
    words = sizes.agg(F.sum("n")).first()[0] or 0
    low, high = (x.bit_length() - 1 for x in FILTER_BITS)
    size = (1 << min(max((words // 16).bit_length(), low), high)) // 64
    buckets = max(32, words // BUCKET_WORDS + 1)

    # filters[t]: the phrases that had reached the threshold before scan t
    filters, parts, heavy, found = [np.zeros(size, np.uint64)], [], [], []
    while True:
        t = len(found)
        now, before = filters[t], filters[t - shards] if t >= shards else None
        if t >= shards and np.array_equal(now, before):
            break
        part = work_path(spark, "scan")
        counted = scan(rows.where(F.col("shard") == t % shards), now, before, t < shards, most, buckets)
        counted.write.option("compression", "zstd").parquet(part)
        parts.append(part)
        tables = [spark.read.schema(counted.schema).parquet(x) for x in parts]
        heavy.append(heavy_bits(tables[-1], -(-least // shards), size))
        found.append(stored(totals(tables, np.bitwise_or.reduce(heavy), least), "reached"))
        filters.append(now | key_bits(found[-1].where(f"octet_length(key) < {8 * most}"), size))
        if t >= shards:
            filters[t - shards] = None
        if len(parts) == shards:  # no later sum reads the oldest
            remove_path(spark, parts.pop(0))
            heavy.pop(0)
        # Spark removes a shuffle's files once the driver's JVM has collected it
        spark._jvm.System.gc()
    remove_path(spark, path)
    # the scans of a phrase's own cycle give its total, others a part of it
    every = reduce(DataFrame.unionByName, found).groupBy("lang", "key").agg(F.max("n").alias("n"))
    return stored(every, "frequent"), sizes, size


def spelled(source: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """``lang, part, word``: the words of the hashes in ``wanted`` (``lang, part``)."""
    shared = source.sparkSession.sparkContext.broadcast(key_bits(wanted.select("lang", F.col("part").alias("key")), size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: dict[str, np.ndarray] = {}  # of this task: no more than are wanted
        for lang, own, starts, ends, _ in _cut(batches):
            words, first = np.unique(span_hashes(own, starts, ends) & ~_GOES_ON, return_index=True)
            at = holds([shared.value], prints(lang_seed(lang), [words]))[0]
            words, first = words[at], first[at]
            at = ~np.isin(words, sent.get(lang, words[:0]))
            words, first = words[at], first[at]
            if not len(words):
                continue
            sent[lang] = np.concatenate([sent.get(lang, words[:0]), words])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(words), pa.string()), pa.array([w.astype("<u8").tobytes() for w in words], pa.binary()),
                    pa.array([own[starts[k] : ends[k]].tobytes().decode() for k in first], pa.string()),
                ],
                ["lang", "part", "word"],
            )

    rows = source.mapInArrow(lean(run), "lang string, part binary, word string").distinct()
    return rows.join(wanted, ["lang", "part"], "left_semi").groupBy("lang", "part").agg(F.min("word").alias("word"))


def _words_of(key: str) -> F.Column:
    """The key's words as an array of 8-byte hashes."""
    return F.expr(f"transform(sequence(1, octet_length({key}), 8), i -> substring({key}, i, 8))")


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    most: int = MOST_WORDS,
    top: int = TOP,
    shards: int = SHARDS,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's first ``top``
    phrases of 2 to ``most`` words that occur ``least`` times or more."""
    spark = docs.sparkSession
    source = docs.where(F.col(text_col).isNotNull()).select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("text")
    )
    found, sizes, size = frequent_phrases(source, least, most, shards)
    phrases = found.where("octet_length(key) >= 16").withColumnRenamed("n", "a")

    # every cut, scored
    cuts = phrases.select("lang", "key", "a", F.expr("explode(sequence(1, octet_length(key) div 8 - 1)) AS k")).select(
        "*", F.expr("substring(key, 1, 8 * k) AS head"), F.expr("substring(key, 8 * k + 1, octet_length(key) - 8 * k) AS tail")
    )
    half = lambda own, name: found.select("lang", F.col("key").alias(own), F.col("n").alias(name))
    if fits_broadcast(spark, sizes.count(), 64):
        sizes = F.broadcast(sizes)
    wide = lambda c: f"cast({c} AS decimal(38, 0))"
    scored = cuts.join(half("head", "l"), ["lang", "head"]).join(half("tail", "r"), ["lang", "tail"]).join(sizes, "lang").select(
        "lang", "key", "a", "k", "l", "r", "n",
        F.expr(f"({PER_MILLE} * {wide('a')} * {wide('n')}) div ({wide('l')} * {wide('r')}) AS score"),
    )
    best = scored.groupBy("lang", "key").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select(
        "lang", "key", "b.a", "b.l", "b.r", "b.n", "b.score"
    )

    # a phrase inside a longer one is inside one that is longer by a word, which
    # is at least as frequent
    inner = phrases.where("octet_length(key) >= 24").select(
        "lang", F.col("a").alias("longer"),
        F.expr("explode(array(substring(key, 1, octet_length(key) - 8), substring(key, 9, octet_length(key) - 8))) AS key"),
    ).groupBy("lang", "key").agg(F.max("longer").alias("longer"))
    kept = best.join(inner, ["lang", "key"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer").cast("decimal(38,0)") < ABSORB_PERCENT * F.col("a").cast("decimal(38,0)"))
    ).drop("longer")

    # spelled out are only those that can be among the first: score and a decide,
    # but for rows that equal the last
    kept = stored(kept, "kept")
    lead = [F.desc("score"), F.desc("a")]
    salt = F.pmod(F.xxhash64("key"), F.lit(SALTS))
    some = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", salt).orderBy(*lead))).where(F.col("rank") <= top)
    last = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*lead))).where(F.col("rank") == top)
    last = last.select("lang", F.col("score").alias("last_score"), F.col("a").alias("last_a"))
    kept = kept.join(last, "lang", "left").where(
        "last_score IS NULL OR score > last_score OR (score = last_score AND a >= last_a)"
    ).drop("last_score", "last_a")
    kept = stored(kept, "first")
    parts = kept.select("lang", "key", F.posexplode(_words_of("key")).alias("pos", "part"))
    text = spelled(source, stored(parts.select("lang", "part").distinct(), "parts"), size)
    phrase = parts.join(text, ["lang", "part"]).groupBy("lang", "key").agg(
        F.sort_array(F.collect_list(F.struct("pos", "word"))).alias("w")
    ).select("lang", "key", F.expr("array_join(transform(w, x -> x.word), ' ') AS phrase"))
    rows = kept.join(phrase, ["lang", "key"])

    order = [F.desc("score"), F.desc("a"), "phrase"]
    salted = Window.partitionBy("lang", F.pmod(F.xxhash64("key"), F.lit(SALTS))).orderBy(*order)
    some = rows.withColumn("rank", F.row_number().over(salted)).where(F.col("rank") <= top)
    ranked = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
