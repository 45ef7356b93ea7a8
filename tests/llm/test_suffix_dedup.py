"""Repeated passages against a table of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from churnspark.llm import suffix_arrays, suffix_dedup
from conftest_llm import tuples


def _marked(rows, width):
    raws = [(t or "").encode() for _, t in rows]
    seen = Counter(r[i:i + width] for r in raws for i in range(len(r) - width + 1))
    for (doc, _), raw in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for i in range(len(raw) - width + 1):
            if seen[raw[i:i + width]] > 1:
                gone[i:i + width] = b"\1" * width
        yield doc, raw, gone


def kept_bytes(rows, width=200):
    return [(doc, bytes(b for b, g in zip(raw, gone, strict=True) if not g))
            for doc, raw, gone in _marked(rows, width)]


def plain(rows, width=200):
    out = []
    for doc, raw, gone in _marked(rows, width):
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        out.append((doc, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages(seed, n):
    """Texts that share passages at various places, near copies, and periodic texts."""
    rng = random.Random(seed)

    def words(k):
        return " ".join("".join(rng.choices("abcdé", k=rng.randrange(2, 9))) for _ in range(k))
    shared = [words(60) for _ in range(3)]
    texts = []
    for i in range(n):
        text = words(rng.randrange(5, 120))
        for passage in shared:
            if rng.random() < 0.5:
                at, a = rng.randrange(len(text)), rng.randrange(40)
                text = text[:at] + passage[a:len(passage) - rng.randrange(40)] + text[at:]
        texts.append(text)
        if rng.random() < 0.3:
            at = rng.randrange(len(text))
            texts.append(text[:at] + "#" + text[at:])
    return texts + ["No " * 150, "No " * 90, "ab" * 99 + "a", "xy" * 300, words(300) + "No " * 99]


@pytest.mark.parametrize("block,shard", [(1 << 20, 512), (2000, 3)])
def test_cuts_equal_the_table_of_strings(spark, odd_docs, monkeypatch, block, shard):
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_dedup, "SHARD_RUNS", shard)
    rows = [(i, t) for i, t in enumerate(passages(7, 60))] + [(None, "z" * 250), (3, None)]
    rows += [(5, rows[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert tuples(suffix_dedup.digests(suffix_dedup.cut_repeats(docs))) == plain(rows)
    if shard == 3:
        odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
        assert tuples(suffix_dedup.digests(suffix_dedup.cut_repeats(odd_docs))) == plain(odd)


def test_documents_and_empty_table(documents, no_docs):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert tuples(suffix_dedup.digests(suffix_dedup.cut_repeats(documents))) == plain(rows)
    assert suffix_dedup.cut_repeats(no_docs).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_suffix_array_and_common_prefixes(seed):
    rng = np.random.default_rng(seed)
    data = rng.integers(0, 2 + seed, 700).astype(np.uint8)
    data[300:500] = data[:200]
    raw, width = data.tobytes(), 40
    order, rank = suffix_arrays.suffix_array(data, width)
    cut = [raw[i:i + width] for i in order]
    assert cut == sorted(cut)
    begins, lengths = np.array([0, 100, 350]), np.array([100, 250, 350])
    shared = suffix_arrays.common_prefixes(data, order, rank, begins, lengths, width)
    for i in range(len(data)):
        lower = rank[i] - 2
        if lower >= 0:
            a, b, k = raw[i:], raw[order[lower]:], 0
            while k < min(len(a), len(b), width) and a[k] == b[k]:
                k += 1
            assert shared[i] == k
    kinds = suffix_arrays.classes(data, begins, lengths, width)
    whole = range(len(data) - width + 1)
    assert len({(kinds[i], raw[i:i + width]) for i in whole}) \
        == len({kinds[i] for i in whole}) == len({raw[i:i + width] for i in whole})
