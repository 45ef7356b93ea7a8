"""The resampling classifier: parts against plain versions, and accuracy on held-out labels."""

import math
import re

import numpy as np
from pyspark.sql import functions as F

from churnspark.llm import quality_classifier as qc

LABELS = "doc_id long, quality int, toxic int"


def test_number_of_ngrams_and_equal_pairs():
    texts = [b"", b" ", b"one", b"One two THREE", b"no no no no", b"a\nb c"]
    found = list(qc.ngram_buckets(texts, 1 << 40))
    words = [len(re.findall(rb"[^\x20\x09-\x0D]+", t)) for t in texts]
    assert [len(f) for f in found] == [n + max(0, n - 1) + n for n in words]
    assert found[3][0] == next(qc.ngram_buckets([b"one"], 1 << 40))[0]
    assert len(set(found[4][4:7].tolist())) == 1
    assert found[4][4] == next(qc.ngram_buckets([b"x x"], 1 << 40))[2]


def test_fit_is_the_ratio_of_counts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a a c"), (3, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (2, 0, 0), (None, 1, 0)], LABELS)
    ratios = qc.fit(docs, labels, buckets=97)
    raw, target = np.ones(97), np.ones(97)
    for text, good in ((b"a b", True), (b"a a c", False)):
        for bucket in next(qc.ngram_buckets([text], 97)):
            raw[bucket] += 1
            target[bucket] += good
    assert np.allclose(ratios, np.log(target / target.sum()) - np.log(raw / raw.sum()))
    assert not qc.fit(docs, labels.where("false"), buckets=97).any()


def test_kth_highest(spark):
    rng = np.random.default_rng(1)
    values = [*rng.normal(size=500).tolist(), *[0.25] * 50, -1e300, 1e300, 1e-300]
    table = spark.createDataFrame([(float(v),) for v in values], "v double")
    for k in (1, 2, 77, 250, 300, len(values)):
        assert qc.kth_highest(table, "v", k) == sorted(values, reverse=True)[k - 1]
    assert qc.kth_highest(table, "v", 0) is None


def test_held_out_accuracy_and_draw(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    seen = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0
    result = qc.resample(docs, labels.where(seen)).cache()
    held = result.join(labels.where(~seen), "doc_id").collect()
    right = {q: np.mean([r.kept == bool(q) for r in held if r.quality == q]) for q in (0, 1)}
    assert right[0] >= 0.9 and right[1] >= 0.97
    for r in result.limit(50).collect():
        noise = r.draw - qc.WEIGHT_NGRAMS * r.mean_ratio
        assert -4 < noise < 25 and math.isclose(r.mean_ratio, r.log_ratio / r.n_ngrams)
    kept = [r.draw for r in result.collect() if r.kept]
    rest = [r.draw for r in result.collect() if not r.kept and r.draw is not None]
    assert min(kept) > max(rest)


def test_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(4, 1, 0), (16, 0, 0), (4, None, None), (None, None, None)],
                                   LABELS)
    result = qc.resample(odd_docs, labels)
    assert result.count() == odd_docs.count()
    assert result.where("n_ngrams = 0 AND kept").count() == 0
    everything = qc.resample(odd_docs, labels.where("false"))
    assert everything.where("n_ngrams > 0 AND NOT kept").count() == 0
    assert qc.resample(no_docs, labels).count() == 0


def plain_resample(rows, labels, hashes):
    """(doc_id, log_ratio, draw, kept) of (doc_id, text) rows, with dictionaries and sorting."""
    good = {d for d, q, _ in labels if d is not None and q == 1}
    known = {}
    for d, q, _ in labels:
        if d is not None and q is not None:
            known[d] = max(q, known.get(d, q))
    grams = [next(qc.ngram_buckets([(t or "").encode()])).tolist() for _, t in rows]
    raw, target = {}, {}
    for (d, _), found in zip(rows, grams):
        for b in found:
            raw[b] = raw.get(b, 0) + 1
            target[b] = target.get(b, 0) + (d in good)
    total, mass = sum(raw.values()) + qc.BUCKETS, sum(target.values()) + qc.BUCKETS

    def ratio(b):
        if mass == qc.BUCKETS:
            return 0.0
        return (math.log((target.get(b, 0) + 1) / mass) - math.log((raw.get(b, 0) + 1) / total))

    out = []
    for (d, _), found, h in zip(rows, grams, hashes):
        log_ratio = sum(ratio(b) for b in found)
        mean = log_ratio / len(found) if found else None
        u = (h % (1 << 52) + 0.5) / (1 << 52)
        out.append((d, log_ratio, mean, None if mean is None else
                    qc.WEIGHT_NGRAMS * mean - math.log(-math.log(u))))
    judged = [(mean, known[d]) for d, _, mean, _ in out if mean is not None and d in known]
    n = {q: sum(k == q for _, k in judged) for q in (0, 1)}
    drawn = sorted((r[3] for r in out if r[3] is not None), reverse=True)
    k = len(drawn)
    if n[0] and n[1]:
        cuts = [i / qc.CUT_BANDS for i in range(-qc.CUT_BANDS * qc.CUT_REACH,
                                                qc.CUT_BANDS * qc.CUT_REACH + 3)]
        errors = [sum(m < c and q == 1 for m, q in judged) / n[1]
                  + sum(m >= c and q != 1 for m, q in judged) / n[0] for c in cuts]
        best = [c for c, e in zip(cuts, errors) if e <= min(errors) + 1e-12]
        cut = best[len(best) // 2]
        k = sum(r[2] is not None and r[2] >= cut for r in out)
    least = drawn[k - 1] if k else math.inf
    return [(d, s, draw, draw is not None and draw >= least) for d, s, _, draw in out]


def test_whole_result_equals_brute_force(spark, documents, odd_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select(
        "doc_id", "quality", "toxic")
    some = labels.collect()
    for docs in (documents, odd_docs):
        rows = docs.select("doc_id", "text", F.xxhash64(
            F.lit(0), "doc_id", F.coalesce("text", F.lit(""))).alias("h")).collect()
        want = plain_resample([(r.doc_id, r.text) for r in rows], [tuple(r) for r in some],
                              [r.h for r in rows])
        got = qc.resample(docs, labels).collect()

        def key(r):
            return repr(r[0]), round(r[1], 6), repr(r[3])

        a = sorted(((r.doc_id, r.log_ratio, r.draw, r.kept) for r in got), key=key)
        b = sorted(want, key=key)
        assert len(a) == len(b)
        for x, y in zip(a, b):
            assert x[0] == y[0] and x[3] == y[3] and math.isclose(x[1], y[1], abs_tol=1e-9)
            assert (x[2] is None and y[2] is None) or math.isclose(x[2], y[2], abs_tol=1e-6)
