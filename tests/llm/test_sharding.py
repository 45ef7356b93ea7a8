"""Histogram sort against a plain sort of all rows."""

import hashlib
import zlib

import pytest

from churnspark.llm import sharding
from churnspark.llm.common import scratch
from conftest_llm import DOCS, tuples


def plain(rows, shards=8):
    """(doc_id, size, crc, shard, slot) by sorting on the driver."""
    keyed = []
    for r in rows:
        text = (r.text or "").encode()
        keyed.append((int(hashlib.md5(text).hexdigest()[:15], 16),
                      sharding.LOW if r.doc_id is None else r.doc_id, len(text) + 1,
                      zlib.crc32(text), r.doc_id))
    keyed.sort(key=lambda k: k[:2])
    total, before, out, slots = sum(k[2] for k in keyed), 0, [], {}
    at = 0
    while at < len(keyed):
        same = [k for k in keyed[at:] if k[:2] == keyed[at][:2]]
        shard = shards * before // total
        for k in same:
            slots[shard] = slots.get(shard, -1) + 1
            out.append((k[4], k[2], k[3], "bytes", shard, slots[shard], None))
        before += sum(k[2] for k in same)
        at += len(same)
    return sorted(out, key=repr)


def run(spark, docs, **options):
    path = scratch(spark, "shards-test")
    found = sharding.write_shards(docs, path, **options)
    return sharding.digests(spark, path, docs.schema), path, found


def test_documents(spark, documents):
    got, _, _ = run(spark, documents)
    assert tuples(got) == plain(documents.collect())


def test_odd_rows_and_clashing_columns(spark, odd_docs):
    docs = odd_docs.withColumnsRenamed({"n_tokens": "shard", "hash": "slot", "kept": "a.b"})
    got, path, _ = run(spark, docs)
    assert tuples(got) == plain(docs.collect())
    back = sharding.read_shards(spark, path, docs.schema).select("doc.*")
    names = [f"c{i}" for i in range(len(docs.columns))]
    assert back.columns == docs.columns
    assert tuples(back.toDF(*names)) == tuples(docs.toDF(*names))


def test_empty_table(spark, no_docs):
    assert run(spark, no_docs)[0].count() == 0


def test_a_third_of_the_rows_are_copies(spark):
    rows = [(i, "copied text" if i % 3 == 0 else f"text {i}" * (i % 7), *"abcd")
            for i in range(3000)]
    docs = spark.createDataFrame(rows, DOCS)
    got, _, _ = run(spark, docs)
    assert tuples(got) == plain(docs.collect())
    sizes = [r.b for r in got.groupBy("shard").agg({"size": "sum"}).toDF("shard", "b").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 150


@pytest.mark.parametrize("most", [2, 16])
def test_few_probes_need_more_rounds_only(documents, most):
    keys = documents.select(*(c.alias(n) for c, n in zip(
        (*sharding.key_columns(documents["text"], documents["doc_id"]),
         sharding.size_of(documents["text"])), ("high", "low", "size"), strict=True))).cache()
    few = sharding.find_splitters(keys, 8, [0] * 7, most)
    many = sharding.find_splitters(keys, 8, [0] * 7, 4096)
    assert (few.rows, few.size) == (many.rows, many.size) and few.rounds > many.rounds


def test_tolerance_ends_earlier_and_holds(spark, documents):
    _, _, exact = run(spark, documents)
    got, _, loose = run(spark, documents, tolerance=0.2)
    assert loose.rounds <= exact.rounds
    each = loose.total_size / 8
    for i in range(7):
        at = (i + 1) * sharding.PIECES - 1
        assert abs(loose.size[at] - (i + 1) * each) <= 0.2 * each
    assert got.count() == documents.count()
