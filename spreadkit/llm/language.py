"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (``DIMENSIONS`` long, drawn from
its code point). A trigram's vector binds the letters' vectors, each permuted by
its place: rho^2(a) * rho(b) * c, where rho rotates by one. A text's vector
bundles (adds) the vectors of its trigrams, a language's prototype those of all
its training texts, and a text is given the language whose prototype has the
largest cosine with it. Bundling is linear, so a batch's bundles are one matrix
product of trigram counts and trigram vectors.

Texts are lower-cased; every run of other characters counts as one space, also
at both ends. A text that is null or has no letter is ``und`` with score 0, as is
every text when nothing could be learned. Ties go to the smallest language name.
Repeated rows are learned from as often as they occur; rows with a null doc_id
are predicted, not learned from and not held out.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DIMENSIONS = 1024
SEED = 77
# learned values of lang; each is a prototype of DIMENSIONS numbers on the driver
MAX_LANGUAGES = 4096
STRETCH_CHARS = 1 << 20
_DENSE_CODES = 1 << 21
_GROUP_CELLS = 1 << 21
_SLICE = 1 << 14
SPACE = 0x20


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(0x110000)])


@lru_cache(maxsize=1 << 14)
def letter_vector(code: int) -> np.ndarray:
    bits = np.random.default_rng([SEED, code]).integers(0, 2, DIMENSIONS, dtype=np.int8)
    return bits * np.int8(2) - np.int8(1)


def trigram_vectors(letters: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Vectors of trigrams; ``codes`` are base-len(letters) numbers."""
    item = np.array([letter_vector(int(c)) for c in letters])
    k = len(letters)
    first, second = np.roll(item, 2, axis=1), np.roll(item, 1, axis=1)
    return (first[codes // (k * k)] * second[codes // k % k] * item[codes % k]).astype(np.float32)


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Alphabet; sorted distinct trigram codes; for each occurrence its text and
    the place of its code among the distinct ones."""
    lowered = [(t or "").lower() for t in texts]
    joined = np.frombuffer(("\n" + "\n".join(lowered) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) + 1 for t in lowered])
    text = np.append(np.repeat(np.arange(len(texts)), sizes), len(texts) - 1)
    is_letter = _letters()[np.minimum(joined, 0x10FFFF)]
    keep = is_letter.copy()
    keep[0] = True
    keep[1:] |= is_letter[:-1]  # one space after each run of letters
    # a text's first space: the one that ends the text before it (or the very first)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    keep[begins] = True
    stream = np.where(is_letter, joined, SPACE)[keep]
    owner = text[keep]
    # no trigram crosses from one text into the next; "no letter" leaves none
    letters, dense = np.unique(stream, return_inverse=True)
    k = len(letters)
    codes = (dense[:-2] * k + dense[1:-1]) * k + dense[2:]
    real = stream[1:-1] != SPACE
    codes, of = codes[real], owner[1:-1][real]
    if k**3 <= _DENSE_CODES:
        present = np.zeros(k**3, bool)
        present[codes] = True
        distinct = np.flatnonzero(present)
        place = np.zeros(k**3, np.int32)
        place[distinct] = np.arange(len(distinct))
        return letters, distinct, of, place[codes]
    distinct, place = np.unique(codes, return_inverse=True)
    return letters, distinct, of, place


def bundles(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Stretches of texts: first index, number of trigrams of each text, and
    their bundled vectors."""
    i = 0
    while i < len(texts):
        j, chars = i, 0
        while j < len(texts) and (j == i or chars + len(texts[j] or "") <= STRETCH_CHARS):
            chars += len(texts[j] or "")
            j += 1
        letters, distinct, of, place = trigrams(texts[i:j])
        counts = np.bincount(of, minlength=j - i)
        out = np.zeros((j - i, DIMENSIONS), np.float32)
        for lo in range(0, len(distinct), _SLICE):  # a bounded number of vectors at a time
            own = distinct[lo : lo + _SLICE]
            inside = (place >= lo) & (place < lo + _SLICE)
            vectors, text, cell = trigram_vectors(letters, own), of[inside], place[inside] - lo
            group = max(1, _GROUP_CELLS // len(own))
            edges = np.searchsorted(text, np.arange(0, j - i + group, group))
            for g, a in enumerate(range(0, j - i, group)):
                b, s = min(j - i, a + group), slice(edges[g], edges[g + 1])
                cells = np.bincount((text[s] - a) * len(own) + cell[s], minlength=(b - a) * len(own))
                out[a:b] += cells.reshape(b - a, len(own)).astype(np.float32) @ vectors
        yield i, counts, out
        i = j


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> tuple[list[str], np.ndarray]:
    """Prototypes of the languages in ``docs``, from all its rows with a language."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())

    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for i, _, vectors in bundles(batch.column(1).to_pylist()):
                for lang in set(langs[i : i + len(vectors)]):
                    own = vectors[langs[i : i + len(vectors)] == lang].sum(axis=0, dtype=np.float64)
                    sums[lang] = sums.get(lang, 0) + own
        for lang, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * DIMENSIONS), pa.array(np.arange(DIMENSIONS, dtype=np.int32)), pa.array(vector)],
                ["lang", "d", "v"],
            )

    parts = known.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInArrow(
        bundle, "lang string, d int, v double"
    )
    # integers in doubles, so the sums don't depend on their order
    rows = parts.groupBy("lang", "d").agg(F.sum("v").alias("v")).groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("d", "v"))).alias("v")
    )
    found = sorted(rows.limit(MAX_LANGUAGES + 1).collect(), key=lambda r: r.lang)
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return [r.lang for r in found], np.array([[x.v for x in r.v] for r in found]).reshape(-1, DIMENSIONS)


def predict(
    docs: DataFrame, languages: list[str], prototypes: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, lang_pred, score``; the score is the cosine, 0 if negative."""
    norms = np.linalg.norm(prototypes, axis=1, keepdims=True) if len(languages) else np.ones((0, 1))
    unit = (prototypes / np.maximum(norms, 1e-9)).astype(np.float32)
    model = docs.sparkSession.sparkContext.broadcast((np.array([*languages, "und"], object), unit))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, own = model.value
        for batch in batches:
            best, score = [], []
            for _, counts, vectors in bundles(batch.column(1).to_pylist()):
                cosine = vectors @ own.T / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
                known = (counts > 0) & (len(own) > 0)
                top = cosine.argmax(axis=1) if len(own) else np.zeros(len(counts), np.int64)
                value = cosine[np.arange(len(top)), top] if len(own) else np.zeros(len(counts))
                best += names[np.where(known, top, len(names) - 1)].tolist()
                score += np.where(known, np.clip(value, 0, 1), 0).astype(np.float64).tolist()
            columns = [batch.column(0), pa.array(best, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    train = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    languages, prototypes = learn(train, lang_col, text_col)
    return predict(docs, languages, prototypes, id_col, text_col).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score"
    )
