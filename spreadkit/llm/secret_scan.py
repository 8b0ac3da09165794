"""Secret scans: candidates by shape, false positives removed by a random forest.

A candidate is a run of at least ``MIN_LENGTH`` characters ``[A-Za-z0-9+/=_-]``, or,
whatever its length and characters, the whole quoted or white-space-delimited value
that follows a credential's name and ``=`` or ``:`` (or a scheme such as Bearer), or
the password in an address ``scheme://user:password@host``.
Its features are its length, its character transitions (changes of character
class, and the mean log probability of its byte pairs under the corpus), its
dictionary coverage (by frequent words of the corpus), its distinct characters,
whether it looks like part of a path or begins like a published format, and its
neighbouring words.

The corpus statistics come from all texts: byte pairs are counted exactly; words
of 4 to 12 letters too, in dictionaries that a task passes on when they hold
``WORDS_HELD`` words; the sums over all tasks rank the corpus dictionary, so it
does not depend on partitions or batches.

The forest is trained on labelled findings: given ones (``doc_id, start,
label``), or else two equal halves: ``MADE`` findings made from the published shapes
of credentials and of what is taken for them (see ``made_findings``; names of
credentials stand before both), and those of the corpus that a strict rule labels: 1 for a value that is
assigned to a credential's name and mixed, quoted or of mixed case; 0, only where
no credential's name stands before it, for candidates without a digit, numbers,
parts of paths (several word-like segments, or an address or path around it), and
values next to words for checksums and revisions. Both labels weigh the same. At most
``SAMPLE`` findings of each label train it, the smallest by hash; if given findings
have one label only there is nothing to learn and the rule decides alone.

Neighbouring words are those within ``_CONTEXT`` bytes before a candidate. Values
are never written: tables between the steps hold positions, features and hashes.

Null and empty texts have no candidates. Positions are UTF-8 bytes. Rows are
scanned on their own, so repeated and null ids only repeat in the result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.made_findings import PREFIXES, made_findings
from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import LOWER, span_hashes, text_bytes, windows, words
from spreadkit.llm.workers import lean

MIN_LENGTH = 16
WORDS_HELD = 1 << 18
DICTIONARY = 5000
SAMPLE = 20_000
MADE = 6000
TREES, DEPTH, SEED = 30, 9, 13
THRESHOLD = 0.5
REDACTED = "[SECRET]"
STRETCH_BYTES = 2 << 20
_CONTEXT = 48

_RUN = np.zeros(256, bool)
_RUN[[*b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"]] = True
_KIND = np.zeros(256, np.int8)  # 0 other, 1 lower, 2 upper, 3 digit
_KIND[ord("a") : ord("z") + 1] = 1
_KIND[ord("A") : ord("Z") + 1] = 2
_KIND[ord("0") : ord("9") + 1] = 3

# fixed values: neighbouring words
CREDENTIAL = frozenset(
    "token secret password passwd pwd key apikey api_key auth authorization bearer credential credentials access_key "
    "secret_key private_key client_secret access_token session".split()
)
HARMLESS = frozenset(
    "sha sha1 sha256 md5 checksum hash commit revision rev digest etag uuid guid id build version isbn phone tel card "
    "example sample test dummy placeholder".split()
)
_SUFFIX = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "credential", "credentials")
_SEGMENT = re.compile(r"[A-Z]?[a-z]{2,}")
# original case before a candidate: an address, a path or a domain that it continues
_PLACE = re.compile(r"://[^\s\"'<>=]*$|(?:^|[\s\"'`(<=])(?:~|\.{1,2})?/[^\s\"'<>=]*$|[\\/@]$|(?:^|[^A-Za-z0-9])[a-z-]{1,20}\.$")
_EXTENSION = re.compile(r"[.\\/@]?\.[a-z][a-z0-9]{0,4}(?![A-Za-z0-9_.-])|[\\/@][A-Za-z0-9]")
# a value after its separator, as it stands in quotes or up to white space
_VALUE = re.compile(
    rb"(?:=>|:=|=(?!=)|:(?![:=]))[ \t]*(?:(?:bearer|basic|token)[ \t]+)?"
    rb"(?:\"([^\"\r\n]+)\"|'([^'\r\n]+)'|`([^`\r\n]+)`|([^\s]+))",
    re.I,
)
_USERINFO = re.compile(rb"://[^\s/:@\"'<>]*:([^\s/\"'<>]+)@")
_NAME = re.compile(r"([A-Za-z0-9_.-]+)\\?[\"'`]?[ \t]*$")
_NEXT = re.compile(rb"[&,;][\w-]+[=:]|</")  # the value ends before another name or a closing tag
_ASSIGNED = re.compile(r"(?:[=:]|[=:]>|[=:]\s*(?:bearer|basic|token))[\s\"'`]*$")
FEATURES = [
    "length", "digits", "transitions", "pair_log", "dictionary", "distinct", "path", "assigned", "quoted", "credential",
    "harmless", "hexadecimal", "spaces", "published",
]
_COLUMNS = ["doc_id", "start", "stop", "hash", "label", *FEATURES]
CANDIDATES = "doc_id bigint, start bigint, stop bigint, hash bigint, label int, " + ", ".join(f"{f} double" for f in FEATURES)


@dataclass
class Statistics:
    """What the corpus says of byte pairs and words."""

    pair_log: np.ndarray
    dictionary: list[bytes]

    def automaton(self) -> ahocorasick.Automaton:
        own = getattr(self, "_own", None)
        if own is None:
            own = ahocorasick.Automaton()
            for w in self.dictionary:
                own.add_word(w.decode("latin-1"), len(w))
            if len(own):
                own.make_automaton()
            self._own = own
        return own

    def __getstate__(self):
        return {"pair_log": self.pair_log, "dictionary": self.dictionary}


def statistics(docs: DataFrame, text_col: str = "text") -> Statistics:
    """One pass over all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(1 << 16, np.int64)
        found: dict[bytes, int] = {}
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in windows(offsets, STRETCH_BYTES):
                lo = offsets[i]
                own = LOWER[data[lo : offsets[j]]]
                pairs += np.bincount(own[:-1].astype(np.int32) << 8 | own[1:], minlength=1 << 16)
                starts, ends, _ = words(own, offsets[i : j + 1] - lo)
                other = np.concatenate([[0], np.cumsum(_KIND[own] != 1)])
                fit = (ends - starts >= 4) & (ends - starts <= 12) & (other[ends] == other[starts])
                starts, ends = starts[fit], ends[fit]
                _, first, n = np.unique(span_hashes(own, starts, ends), return_index=True, return_counts=True)
                raw = own.tobytes()
                for a, b, c in zip(starts[first].tolist(), ends[first].tolist(), n.tolist()):
                    found[raw[a:b]] = found.get(raw[a:b], 0) + c
                if len(found) > WORDS_HELD:
                    yield _counts({}, found)
                    found = {}
        yield _counts(dict(enumerate(pairs.tolist())), found)

    parts = stored(docs.select(F.col(text_col).alias("text")).mapInArrow(lean(count), "pair int, word binary, n bigint"), "statistics")
    table = np.zeros(1 << 16)
    for r in parts.where("pair is not null").groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 65,536 rows
        table[r.pair] = r.n
    table = table.reshape(256, 256) + 0.5
    top = parts.where("word is not null").groupBy("word").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "word").limit(DICTIONARY)
    return Statistics(np.log(table / table.sum(axis=1, keepdims=True)), [bytes(r.word) for r in top.collect()])


def _counts(pairs: dict[int, int], found: dict[bytes, int]) -> pa.RecordBatch:
    pairs = {k: v for k, v in pairs.items() if v}
    columns = [
        pa.array([*pairs, *[None] * len(found)], pa.int32()), pa.array([*[None] * len(pairs), *found], pa.binary()),
        pa.array([*pairs.values(), *found.values()], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["pair", "word", "n"])


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the candidates."""
    run = np.zeros(len(data) + 2, np.int8)
    run[1:-1] = _RUN[data]
    edge = np.diff(run)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    # runs that cross from one text into the next are cut there
    inner = offsets[1:-1]
    inner = np.unique(inner[(inner > 0) & (inner < len(data))])
    cut = inner[(run[inner] == 1) & (run[inner + 1] == 1)] if len(inner) else inner
    starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    long_ = ends - starts >= MIN_LENGTH
    starts, ends = starts[long_], ends[long_]
    own = assigned(data, offsets)
    if own:
        # assigned values are whole; what is left of the runs around them stays a run
        pieces, at = list(own), 0
        for lo, hi in zip(starts.tolist(), ends.tolist()):
            while at < len(own) and own[at][1] <= lo:
                at += 1
            k = at
            while k < len(own) and own[k][0] < hi:
                pieces += [(lo, own[k][0])] * (own[k][0] - lo >= MIN_LENGTH)
                lo = own[k][1]
                k += 1
            pieces += [(lo, hi)] * (hi - lo >= MIN_LENGTH)
        starts, ends = np.array(sorted(pieces), np.int64).T
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def assigned(data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    """Start and end of the values assigned to a credential's name and of
    passwords in addresses, in order."""
    raw, out = data.tobytes(), []
    sites = np.flatnonzero((data == ord("=")) | (data == ord(":")))
    texts = np.searchsorted(offsets, sites, "right") - 1
    for at, lo, hi in zip(sites.tolist(), offsets[texts].tolist(), offsets[texts + 1].tolist()):
        if out and at < out[-1][1]:
            continue
        found = _USERINFO.match(raw, at, hi)
        if found:
            out.append(found.span(1))
            continue
        name = _NAME.search(raw[max(lo, at - _CONTEXT) : at].decode("latin-1"))
        if not name or not credential_name(name[1].lower()) or raw[at : at + 3] == b"://":
            continue
        found = _VALUE.match(raw, at, hi)
        if not found:
            continue
        start, end = found.span(found.lastindex)
        if found.lastindex == 4:
            value = found[4]
            after = _NEXT.search(value, 1)
            value = value[: after.start()] if after else value
            start += len(value) - len(value.lstrip(b"\\\"'`([{<"))
            end = start + len(value.lstrip(b"\\\"'`([{<").rstrip(b"\\\"'`)]}>.,;:"))
        if start < end:
            out.append((start, end))
    return out


def describe(data: np.ndarray, lo: int, hi: int, start: int, end: int, corpus: Statistics) -> list[float]:
    """The features of one candidate in the text ``[lo, hi)``."""
    body = data[start:end]
    kinds, lower = _KIND[body], LOWER[body]
    n = end - start
    value = lower.tobytes().decode("latin-1")
    known = np.zeros(n, bool)
    if len(corpus.automaton()):
        for stop, size in corpus.automaton().iter(value):
            known[stop - size + 1 : stop + 1] = True
    raw = data[max(lo, start - _CONTEXT) : start].tobytes().decode("latin-1")
    before = raw.lower()
    after = data[end : min(hi, end + 8)].tobytes().decode("latin-1")
    near = re.findall(r"[a-z0-9_]+", before)[-3:]
    account = after[:1] == "@" and re.search(r"://[^\s/@]*:$", before) is not None
    segments = sum(_SEGMENT.fullmatch(x) is not None for x in body.tobytes().decode("latin-1").split("/"))
    path = segments * (segments > 1) 
    path += 0 if account else (_PLACE.search(raw) is not None) + (_EXTENSION.match(after) is not None)
    return [
        float(n),
        float((kinds == 3).mean()),
        float((kinds[1:] != kinds[:-1]).mean()) if n > 1 else 0.0,
        float(corpus.pair_log[lower[:-1], lower[1:]].mean()) if n > 1 else 0.0,
        float(known.mean()),
        len(set(value)) / n,
        float(path),
        float(_ASSIGNED.search(before) is not None),
        float(before[-1:] in ("\"", "'", "`")),
        float(account or any(credential_name(w) for w in near)),
        float(any(w in HARMLESS for w in near)),
        float(re.fullmatch(r"[0-9a-f]+", value) is not None),
        float(len(value.split()) - 1),
        float(body[:12].tobytes().decode("latin-1").startswith(PREFIXES)),
    ]


def credential_name(name: str) -> bool:
    """Whether a lower-case name, or a part of it, names a credential."""
    return name in CREDENTIAL or name.endswith(_SUFFIX) or any(x in CREDENTIAL for x in re.split("[^a-z0-9]+", name))


def rule(x: list[float]) -> int | None:
    """The strict label of a candidate, if it has one. A value assigned to a
    credential's name is never labelled 0."""
    f = dict(zip(FEATURES, x))
    if f["credential"]:
        shaped = f["digits"] < 1 and f["transitions"] > 0.15 if f["digits"] else f["transitions"] > 0 or f["quoted"] and not f["spaces"]
        return 1 if f["assigned"] and shaped else None
    return 0 if not f["digits"] or f["digits"] == 1 or f["path"] or f["harmless"] else None


def described(column: pa.Array, corpus: Statistics) -> Iterator[tuple[int, int, int, str, list[float]]]:
    """Text index, start, stop, value and features of every candidate."""
    data, offsets = text_bytes(column)
    for i, j in windows(offsets, STRETCH_BYTES):
        base = offsets[i]
        starts, ends, text = spans(data[base : offsets[j]], offsets[i : j + 1] - base)
        for s, e, t in zip((starts + base).tolist(), (ends + base).tolist(), (text + i).tolist()):
            lo, hi = int(offsets[t]), int(offsets[t + 1])
            yield t, s - lo, e - lo, data[s:e].tobytes().decode(), describe(data, lo, hi, s, e, corpus)


def candidates(docs: DataFrame, corpus: Statistics, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(corpus)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(described(batch.column(1), shared.value))
            if found:
                text, start, stop, value, x = zip(*found)
                columns = [batch.column(0).take(pa.array(text)), pa.array(start, pa.int64()), pa.array(stop, pa.int64())]
                hashes = [xxhash.xxh64_intdigest(v, SEED) >> 1 for v in value]
                columns += [pa.array(hashes, pa.int64()), pa.array([rule(f) for f in x], pa.int32())]
                columns += [pa.array(f, pa.float64()) for f in zip(*x)]
                yield pa.RecordBatch.from_arrays(columns, _COLUMNS)

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(lean(find), CANDIDATES)


@dataclass
class Forest:
    """The trained trees as nested tuples: (feature, threshold, left, right) or
    a leaf's share of label 1. Without trees the rule decides."""

    trees: list

    def probability(self, x: list[float]) -> float:
        if not self.trees:
            return float(rule(x) == 1)
        total = 0.0
        for node in self.trees:
            while isinstance(node, tuple):
                node = node[2] if x[node[0]] <= node[1] else node[3]
            total += node
        return total / len(self.trees)


def made(corpus: Statistics) -> list[tuple[int, list[float]]]:
    """Label and features of the candidates in made texts; what else than the value
    is found in them is no secret."""
    texts, values, labels = zip(*made_findings([w.decode() for w in corpus.dictionary[:2000]], MADE, SEED))
    out = []
    for t, _, _, found, x in described(pa.array(texts), corpus):
        inside = found in values[t] or values[t] in found
        out.append((labels[t] * inside, x))
    return out


def train(found: DataFrame, corpus: Statistics, findings: DataFrame | None = None) -> Forest:
    """A forest from labelled rows of the candidates ``found``, and from made ones
    if no ``findings`` are given."""
    spark = found.sparkSession
    if findings is not None:
        given = findings.select("doc_id", "start", F.col("label").cast("int").alias("given"))
        found = found.join(given, ["doc_id", "start"]).withColumn("label", F.col("given"))
    labelled = found.where("label in (0, 1)")
    order = ["hash", "doc_id", "start"]
    samples = [labelled.where(F.col("label") == v).orderBy(*order).limit(SAMPLE) for v in (0, 1)]
    rows = samples[0].unionByName(samples[1]).select("label", *FEATURES, F.lit(0).alias("made"))
    if findings is None:
        schema = "label int, " + ", ".join(f"{f} double" for f in FEATURES) + ", made int"
        rows = rows.unionByName(spark.createDataFrame([(y, *x, 1) for y, x in made(corpus)], schema))
    rows = stored(rows, "labelled")
    sizes = {(r.label, r.made): r["count"] for r in rows.groupBy("label", "made").count().collect()}
    if len({label for label, _ in sizes}) < 2:
        return Forest([])
    total = sum(sizes.values())
    weight = F.coalesce(*[F.when((F.col("label") == y) & (F.col("made") == m), total / n) for (y, m), n in sizes.items()]).alias("weight")
    assembled = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows).select("label", "features", weight)
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, weightCol="weight").fit(assembled.coalesce(1))

    def tree(node):
        if node.subtreeDepth() == 0:
            stats = node.impurityStats().stats()
            return stats[1] / (stats[0] + stats[1])
        split = node.split()
        return (split.featureIndex(), split.threshold(), tree(node.leftChild()), tree(node.rightChild()))

    return Forest([tree(t._java_obj.rootNode()) for t in model.trees])


def scan(
    docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, start, stop, value, probability, is_secret`` of each candidate."""
    corpus = statistics(docs, text_col)
    forest = train(stored(candidates(docs, corpus, id_col, text_col), "candidates"), corpus, findings)
    shared = docs.sparkSession.sparkContext.broadcast((corpus, forest))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, forest = shared.value
        for batch in batches:
            found = list(described(batch.column(1), corpus))
            if found:
                text, start, stop, value, x = zip(*found)
                columns = [batch.column(0).take(pa.array(text)), pa.array(start, pa.int64()), pa.array(stop, pa.int64()), pa.array(value)]
                p = pa.array([forest.probability(f) for f in x], pa.float64())
                yield pa.RecordBatch.from_arrays([*columns, p], ["doc_id", "start", "stop", "value", "probability"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    judged = source.mapInArrow(lean(judge), "doc_id bigint, start bigint, stop bigint, value string, probability double")
    return judged.withColumn("is_secret", F.col("probability") > THRESHOLD)


def redact(
    docs: DataFrame, findings: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with every secret in its texts replaced by ``[SECRET]``; other
    columns stay, null texts too."""
    corpus = statistics(docs, text_col)
    forest = train(stored(candidates(docs, corpus, id_col, text_col), "candidates"), corpus, findings)
    shared = docs.sparkSession.sparkContext.broadcast((corpus, forest))
    at = docs.columns.index(text_col)

    def replace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        corpus, forest = shared.value
        for batch in batches:
            cuts: dict[int, list] = {}
            for t, start, stop, _, x in described(batch.column(at), corpus):
                if forest.probability(x) > THRESHOLD:
                    cuts.setdefault(t, []).append((start, stop))
            texts = batch.column(at)
            if cuts:
                new = texts.to_pylist()
                for t, own in cuts.items():
                    raw = new[t].encode()
                    edges = [0, *[x for cut in own for x in cut], len(raw)]
                    new[t] = REDACTED.join(raw[a:b].decode() for a, b in zip(edges[::2], edges[1::2]))
                texts = pa.array(new, texts.type)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1 :]], batch.schema.names)

    return docs.mapInArrow(lean(replace), docs.schema)
