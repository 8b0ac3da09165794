"""Quality by importance resampling over hashed n-grams.

Two generative models of a text are bags of hashed word uni- and bigrams: the
target model counts the features of texts labelled as wanted, the raw model
those of all texts. A text's log importance weight is the sum over its features
of log p_target - log p_raw (both smoothed). A text of the target sample is left
out of the target model that weighs it, or its own rare words would speak for it.
The weight is tempered by the text's length: it is divided by the number of its
features to the power ``TEMPER`` (a half), as sums over long texts would else be in
the hundreds and leave nothing to chance. Adding independent Gumbel noise and
taking the k largest draws k texts without replacement in proportion to their
tempered weights. The noise is a hash of doc_id and a seed, so a draw repeats.

k is a share of the rows that can be drawn: by default the share of wanted texts among the
labelled ones. The k-th largest score is found exactly by counting 16-bit digits
of it over all rows (four passes over the small scored table, at most 65,536
counts each on the driver); ties at the border are taken by ascending doc_id.

The target model reads the texts of at most ``TARGET_SAMPLE`` wanted ids, the
smallest by hash; everything else covers all rows. Rows that share a wanted id
are all in the sample. Null and empty texts have no feature, weight 0 and no score,
and are never drawn. Rows with one id and one score share their fate; a null id
never gets in. Labels that contradict each other count as not wanted. Without a
wanted text all weights are 0 and the draw is uniform.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spreadkit.llm.tables import stored
from spreadkit.llm.textarrays import LOWER, mix, span_hashes, text_bytes, windows, words
from spreadkit.operators.select import kth_smallest

BUCKETS = 1 << 16
TARGET_SAMPLE = 100_000
SEED = 41
TEMPER = 0.5
_UNITS = 20  # binary digits of a score behind the point


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the uni- and bigrams of lower-cased words, and their texts."""
    starts, ends, text = words(data, offsets)
    one = span_hashes(LOWER[data], starts, ends)
    same = text[1:] == text[:-1]
    two = mix(one[:-1] * np.uint64(0x9E3779B97F4A7C15) + one[1:])[same]
    buckets = (np.concatenate([one, two]) % np.uint64(BUCKETS)).astype(np.int64)
    return buckets, np.concatenate([text, text[1:][same]])


def feature_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of the buckets over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i, j in windows(offsets):
                lo = offsets[i]
                total += np.bincount(features(data[lo : offsets[j]], offsets[i : j + 1] - lo)[0], minlength=BUCKETS)
        own = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(total[own])], ["bucket", "n"])

    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket bigint, n bigint")
    out = np.zeros(BUCKETS, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # BUCKETS rows at most
        out[r.bucket] = r.n
    return out


def log_ratios(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """log p_target - log p_raw of every bucket; 0 if there is no target."""
    p, q = (target + 1) / (target.sum() + BUCKETS), (raw + 1) / (raw.sum() + BUCKETS)
    return np.log(p) - np.log(q) if target.sum() else np.zeros(BUCKETS)


def correction(buckets: np.ndarray, text: np.ndarray, target: np.ndarray, n: np.ndarray) -> np.ndarray:
    """What each text's log weight changes by when its ``n`` features are taken
    out of the target model."""
    pairs, own = np.unique(text * np.int64(BUCKETS) + buckets, return_counts=True)
    text, count = pairs // BUCKETS, target[pairs % BUCKETS]
    total = target.sum()
    change = own * (np.log(count - own + 1) - np.log(count + 1))
    return np.bincount(text, weights=change, minlength=len(n)) - n * (np.log(total - n + BUCKETS) - np.log(total + BUCKETS))


def log_weights(
    docs: DataFrame, target: np.ndarray, raw: np.ndarray, sample: np.ndarray, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_features, log_weight``; ``sample`` are the ids whose texts the
    target counts hold."""
    model = docs.sparkSession.sparkContext.broadcast((target, log_ratios(target, raw), sample))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, ratios, sample = model.value
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            ids = batch.column(0).fill_null(-1).to_numpy()
            inside = np.isin(ids, sample) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            n, w = np.zeros(len(offsets) - 1, np.int64), np.zeros(len(offsets) - 1)
            for i, j in windows(offsets):
                lo = offsets[i]
                buckets, text = features(data[lo : offsets[j]], offsets[i : j + 1] - lo)
                n[i:j] = np.bincount(text, minlength=j - i)
                w[i:j] = np.bincount(text, weights=ratios[buckets], minlength=j - i)
                own = inside[i:j][text]
                w[i:j] += correction(buckets[own], text[own], target, np.where(inside[i:j], n[i:j], 0))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n), pa.array(w)], ["doc_id", "n_features", "log_weight"])

    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return source.mapInArrow(weigh, "doc_id bigint, n_features bigint, log_weight double")


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_features, log_weight, score, kept`` for each row of ``docs``;
    ``labels`` has ``doc_id, quality, toxic``."""
    rated = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.min(F.expr("coalesce(quality = 1 and toxic = 0, false)")).alias("wanted")
    )
    total, wanted = rated.agg(F.count("*"), F.count_if("wanted")).first()
    sample = (
        rated.where("wanted").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(TARGET_SAMPLE).select(F.col("id").alias(id_col))
    )
    target = docs.select(id_col, text_col).join(F.broadcast(sample), id_col, "left_semi")
    ids = np.sort(np.array([r[0] for r in sample.collect()], np.int64))  # TARGET_SAMPLE at most
    models = feature_counts(target, text_col), feature_counts(docs, text_col)

    unit = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    tempered = F.col("log_weight") / F.pow(F.col("n_features"), F.lit(TEMPER))
    score = F.floor((tempered - F.log(-F.log(unit))) * float(1 << _UNITS)).cast("bigint")
    able = F.col("doc_id").isNotNull() & (F.col("n_features") > 0)
    scored = stored(log_weights(docs, *models, ids, id_col, text_col).withColumn("units", F.when(able, score)), "scored")
    eligible = scored.where("units is not null")
    n = eligible.count()
    k = round(n * ((wanted / total if total else 1.0) if share is None else share))
    kept = F.lit(False)
    if k >= n:
        kept = F.col("units").isNotNull()
    elif k > 0:
        down, ties = kth_smallest(eligible.select((-F.col("units")).alias("key")), "key", k)
        border = -down
        last, _ = kth_smallest(eligible.where(F.col("units") == border), "doc_id", ties)
        kept = (F.col("units") > border) | ((F.col("units") == border) & (F.col("doc_id") <= last))
    return scored.select(
        "doc_id", "n_features", "log_weight", (F.col("units") / float(1 << _UNITS)).alias("score"),
        F.coalesce(kept, F.lit(False)).alias("kept"),
    )
