"""The manifest against trees built on the driver."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import merkle
from conftest_llm import tuples


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"
    return h("".join(map(field, (row.doc_id, row.source, row.lang, row.n_chars, text))))


def tree(leaves):
    levels = [leaves]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h("".join(last[i:i + 16])) for i in range(0, len(last), 16)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        first = i - i % 16
        out.append((level[first:i], level[i + 1:first + 16]))
        i //= 16
    return out


def plain(rows):
    small = str.maketrans(merkle.CAPITALS, merkle.SMALL)
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    trees = {}
    for source, own in by.items():
        own.sort(key=lambda r: (r.doc_id is not None, r.doc_id, leaf(r, r.text)))
        trees[source] = tree([leaf(r, r.text) for r in own])
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    top = tree([trees[s][-1][0] for s in order])
    out = []
    for k, source in enumerate(order):
        above = path(top, k)
        for i, r in enumerate(by[source]):
            steps = path(trees[source], i) + above
            node = trees[source][0][i]
            if r.doc_id is not None and r.text is not None and zlib.crc32(
                    str(r.doc_id).encode()) % 5 == 0:
                node = leaf(r, r.text.translate(small))
            for left, right in steps:
                node = h("".join(left) + node + "".join(right))
            out.append((r.doc_id, trees[source][0][i], trees[source][-1][0], top[-1][0],
                        h("".join("".join(a) + "".join(b) for a, b in steps)), node,
                        node == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("height", [1, 2, 3])
def test_documents(documents, height):
    got = merkle.report(merkle.build(documents, height))
    assert tuples(got) == plain(documents.collect())


def test_one_hot_source_over_several_blocks(spark):
    rows = [(i // 2 if i % 50 else None, None if i % 40 == 0 else "hot" if i % 3 else f"s{i % 41}", "en",
             3, f"Text {i // 3}") for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, "
                                       "text string").repartition(7)
    got = merkle.report(merkle.build(docs, 1))
    assert tuples(got) == plain(docs.collect())


def test_odd_rows(odd_docs, no_docs):
    def whole(docs):
        return docs.select("*", F.when(F.col("doc_id") % 3 > 0, F.lit("é")).alias("source"),
                           F.lit(None).cast("string").alias("lang"),
                           F.length("text").alias("n_chars"), F.lit(1).alias("tree"),
                           F.lit(2).alias("path"), F.lit(3).alias("a.b"))
    docs = whole(odd_docs)
    assert tuples(merkle.report(merkle.build(docs))) == plain(docs.collect())
    assert merkle.report(merkle.build(whole(no_docs))).count() == 0
    one = docs.limit(1)
    assert tuples(merkle.report(merkle.build(one))) == plain(one.collect())


@pytest.mark.parametrize("levels", range(1, 5))
def test_addresses_fill_a_block_and_keep_subtrees_together(levels):
    found = [merkle.address(levels, d, np.arange(16 ** d)) for d in range(levels)]
    assert sorted(np.concatenate(found).tolist()) == list(range(merkle.n_nodes(levels)))
    lower = levels - levels // 2
    if levels > 1:  # a subtree of the lower half is one stretch
        upper = levels // 2
        for root in range(16 ** upper):
            own = [merkle.address(levels, upper + d, np.arange(root * 16 ** d, (root + 1) * 16 ** d))
                   for d in range(lower)]
            flat = sorted(np.concatenate(own).tolist())
            assert flat == list(range(flat[0], flat[0] + merkle.n_nodes(lower)))


def test_a_changed_text_breaks_the_proof(documents):
    manifest = merkle.build(documents)
    other = F.unhex(F.lit("00" * 32))
    rows = merkle.proofs(manifest).select(
        merkle.folded(F.col("leaf"), F.col("path")).alias("kept"),
        merkle.folded(other, F.col("path")).alias("broken")).collect()
    assert all(r.kept == manifest.root and r.broken != manifest.root for r in rows)
