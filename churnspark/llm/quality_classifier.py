"""Quality by importance resampling: hashed n-gram models of good text against all text.

Each document's n-grams fall into buckets. Two generative models hold the bucket frequencies of
documents labelled good (the target) and of the whole corpus (raw). A document's weight is the
ratio of its likelihoods, taken to ``WEIGHT_NGRAMS`` n-grams so that length alone decides nothing;
documents are drawn without replacement in proportion to it by adding Gumbel noise to the log
ratio and keeping the k highest. Labelled documents tell how many are worth keeping.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import stored, texts_of
from churnspark.llm.shingles import MULTIPLIER, blocks, mix, word_hashes

BUCKETS = 10_000
#: Labelled documents the target model is fitted on at most: those whose ids hash lowest.
MAX_TARGET = 100_000
#: Added to each bucket's count.
SMOOTHING = 1.0
#: N-grams that every document's likelihood ratio is brought to.
WEIGHT_NGRAMS = 100
#: Bands of the mean log ratio per unit, and how far they reach, in the search for the cut.
CUT_BANDS, CUT_REACH = 50, 20
IS_UPPER = np.zeros(256, dtype=np.int64)
IS_UPPER[65:91] = 1
IS_SIGN = np.zeros(256, dtype=np.int64)
IS_SIGN[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = 1
IS_DIGIT = np.zeros(256, dtype=np.int64)
IS_DIGIT[48:58] = 1


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many capitals, signs and digits a word has (0 to 3 of each), as one number."""
    code = np.zeros(len(starts), dtype=np.uint64)
    for kind in (IS_UPPER, IS_SIGN, IS_DIGIT):
        sums = np.concatenate(([0], np.cumsum(kind[data])))
        code = code * np.uint64(4) + np.minimum(sums[ends] - sums[starts], 3).astype(np.uint64)
    return code


def ngram_buckets(texts: list[bytes], buckets: int = BUCKETS):
    """For each text the buckets of its words, word pairs and word shapes.

    Words are lower-cased. A pair of equal words is one n-gram whatever the word, as are words of
    one shape, so that stuttering or shouting text has a likelihood of its own.
    """
    for first, last in blocks(texts):
        some = texts[first:last]
        data = np.frombuffer(b"\n".join(some), dtype=np.uint8)
        words, starts, ends = word_hashes(data)
        limits = np.cumsum([len(t) + 1 for t in some])
        bounds = np.concatenate(([0], np.searchsorted(starts, limits)))
        pairs = mix(words[:-1] * MULTIPLIER + words[1:])
        pairs[words[:-1] == words[1:]] = np.uint64(1)
        shapes = mix(_shapes(data, starts, ends) + np.uint64(2))
        size = np.uint64(buckets)
        one, two, three = ((x % size).astype(np.int64) for x in (words, pairs, shapes))
        for i in range(len(some)):
            a, b = int(bounds[i]), int(bounds[i + 1])
            yield np.concatenate((one[a:b], two[a:max(a, b - 1)], three[a:b]))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
        max_target: int = MAX_TARGET) -> np.ndarray:
    """Log ratio of target to raw for each bucket.

    Raw counts cover all documents. The target is the documents whose label has quality 1, at
    most ``max_target`` of them. Counts are summed per task before the shuffle. Without labelled
    documents every ratio is zero.
    """
    good = (labels.where("doc_id IS NOT NULL AND quality = 1").select("doc_id").distinct()
            .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target))
    good = docs.sparkSession.createDataFrame(good.collect(), "doc_id long")

    def run(batches):
        raw, target = np.zeros(buckets, np.int64), np.zeros(buckets, np.int64)
        for batch in batches:
            texts = [t.encode() for t in batch.column(0).to_pylist()]
            for found, is_good in zip(ngram_buckets(texts, buckets),
                                      batch.column(1).to_pylist(), strict=True):
                counts = np.bincount(found, minlength=buckets)
                raw += counts
                if is_good:
                    target += counts
        some = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]),
                                          pa.array(target[some])], ["bucket", "raw", "target"])

    marked = (texts_of(docs).join(F.broadcast(good.withColumn("good", F.lit(True))), "doc_id",
                                  "left").select("text", F.coalesce("good", F.lit(False))))
    counts = (marked.mapInArrow(run, "bucket long, raw long, target long").groupBy("bucket")
              .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect())
    raw, target = np.full(buckets, SMOOTHING), np.full(buckets, SMOOTHING)
    for row in counts:
        raw[row.bucket] += row.raw
        target[row.bucket] += row.target
    if target.sum() == SMOOTHING * buckets:
        return np.zeros(buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def score(docs: DataFrame, ratios: np.ndarray, seed: int = 0) -> DataFrame:
    """doc_id, n_ngrams, log_ratio (sum over the document's n-grams), mean_ratio and draw.

    ``draw`` is the log weight with Gumbel noise from a hash of doc_id and text, so it does not change
    from run to run; null where a text has no words.
    """
    model = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                found = list(ngram_buckets([t.encode() for t in some.column(2).to_pylist()],
                                           len(model.value)))
                total = [float(model.value[f].sum()) for f in found]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array([len(f) for f in found], pa.int64()),
                     pa.array(total, pa.float64())], ["doc_id", "hash", "n_ngrams", "log_ratio"])

    scored = (texts_of(docs).select("doc_id", F.xxhash64(F.lit(seed), "doc_id", "text")
                                    .alias("hash"), "text")
              .mapInArrow(run, "doc_id long, hash long, n_ngrams long, log_ratio double"))
    uniform = (F.pmod("hash", F.lit(1 << 52)).cast("double") + 0.5) / float(1 << 52)
    mean = F.when(F.col("n_ngrams") > 0, F.col("log_ratio") / F.col("n_ngrams"))
    return scored.select("doc_id", "n_ngrams", "log_ratio", mean.alias("mean_ratio"),
                         (WEIGHT_NGRAMS * mean - F.log(-F.log(uniform))).alias("draw"))


def best_cut(scored: DataFrame, labels: DataFrame) -> float | None:
    """The mean log ratio that best tells labelled good from bad documents; null without both.

    Errors of both classes weigh the same. Of equally good cuts, which a clear gap gives, the
    middle one. Only counts per band leave the executors.
    """
    band = F.floor(CUT_BANDS * F.greatest(F.lit(-CUT_REACH), F.least(
        F.lit(CUT_REACH), F.col("mean_ratio")))).cast("int")
    marked = (labels.where("doc_id IS NOT NULL AND quality IS NOT NULL")
              .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    rows = (scored.where("mean_ratio IS NOT NULL").join(marked, "doc_id")
            .groupBy(band.alias("band"), (F.col("quality") == 1).alias("good")).count().collect())
    good, bad = (np.zeros(2 * CUT_BANDS * CUT_REACH + 2) for _ in range(2))
    for row in rows:
        (good if row.good else bad)[row.band + CUT_BANDS * CUT_REACH] += row["count"]
    if not good.sum() or not bad.sum():
        return None
    lost = np.concatenate(([0], np.cumsum(good))) / good.sum()
    passed = 1 - np.concatenate(([0], np.cumsum(bad))) / bad.sum()
    errors = lost + passed
    best = np.flatnonzero(errors <= errors.min() + 1e-12)
    return (float(best[len(best) // 2]) - CUT_BANDS * CUT_REACH) / CUT_BANDS


def kth_highest(values: DataFrame, column: str, k: int) -> float | None:
    """The k-th highest value, found by counting in ever narrower bands; null when k is 0."""
    if k <= 0:
        return None
    bounds = values.agg(F.min(column), F.max(column)).first()
    low, high, bands = bounds[0], bounds[1], 1000
    while True:
        width = (high - low) / bands
        inside = values.where(F.col(column).between(low, high))
        if width <= 0 or low + width == low or high - width == high:
            # As narrow as doubles go: the few values in it are looked at one by one.
            counts = sorted(inside.groupBy(column).count().collect(), reverse=True)
            for value, n in counts:
                k -= n
                if k <= 0:
                    return value
        at = F.least(F.floor((F.col(column) - low) / width), F.lit(bands - 1)).cast("int")
        found = inside.groupBy(at.alias("band")).agg(
            F.count("*").alias("n"), F.min(column).alias("low"), F.max(column).alias("high"))
        for row in sorted(found.collect(), key=lambda r: -r.band):
            if k <= row.n:
                low, high = row.low, row.high
                break
            k -= row.n
        if low == high:
            return low


def resample(docs: DataFrame, labels: DataFrame, seed: int = 0) -> DataFrame:
    """doc_id, n_ngrams, log_ratio, mean_ratio, draw, kept: one row for each document.

    As many documents are kept as have a mean log ratio above the cut that the labels give (all
    with words, if labels lack one of the classes): those of the k highest draws, with all that
    tie with the last. Null and empty texts, and texts without words, are not kept. Null and
    repeated doc_ids and repeated rows are documents of their own (equal rows draw alike). Other
    columns are ignored.
    """
    scored = stored(score(docs, fit(docs, labels), seed), "scores")
    cut = best_cut(scored, labels)
    drawn = scored.where("draw IS NOT NULL")
    k = drawn.count() if cut is None else drawn.where(F.col("mean_ratio") >= cut).count()
    least = kth_highest(drawn, "draw", k)
    return scored.withColumn("kept", F.lit(False) if least is None else
                             F.coalesce(F.col("draw") >= F.lit(least), F.lit(False)))
