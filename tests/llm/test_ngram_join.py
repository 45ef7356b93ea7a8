"""The Jaccard join against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnspark.llm import ngram_join
from conftest_llm import tuples


def plain(rows):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", low)
        sets.append({tuple(words[i:i + 5]) for i in range(len(words) - 4)}
                    if len(words) >= 5 else ({tuple(words)} if words else set()))
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                    root[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=repr)


def variants(seed, groups, copies, words=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    common = rng.sample(vocabulary, 12)
    texts = []
    for _ in range(groups):
        base = common + [rng.choice(vocabulary) for _ in range(words)]
        for _ in range(copies):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            texts.append(" ".join(text))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("star,tile", [(64, 1024), (3, 4)])
def test_groups_equal_all_pairs(spark, odd_docs, monkeypatch, star, tile):
    monkeypatch.setattr(ngram_join, "STAR_ABOVE", star)
    monkeypatch.setattr(ngram_join, "TILE", tile)
    monkeypatch.setattr(ngram_join, "BEST_FIRST", (1, 2, None))
    texts = variants(1, 12, 12) + variants(2, 3, 30, 25) + ["A b", "a  B", "a b c d E", "one"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[5]), (900, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit("x"))
    assert tuples(ngram_join.groups(docs)) == plain(rows)
    if star == 64:
        odd = [(r.doc_id, r.text) for r in odd_docs.collect()]
        assert tuples(ngram_join.groups(odd_docs)) == plain(odd)


def test_empty_table(no_docs):
    assert ngram_join.groups(no_docs).count() == 0


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    assert tuples(ngram_join.groups(documents)) == plain(rows)
    kept = ngram_join.keep_one(documents)
    assert kept.columns == documents.columns
    assert kept.count() == len({c for _, _, c in plain(rows)})


def test_tree_lets_every_possible_pair_through():
    rng = np.random.default_rng(5)
    counts = rng.poisson(3, (700, ngram_join.GROUPS)).astype("<u2")
    counts[350:] = np.maximum(counts[:350].astype(int) - (rng.random((350, 64)) < 0.05), 0)
    sizes = counts.sum(axis=1, dtype=np.int64)
    bound = np.minimum(counts[:, None, :], counts[None, :, :]).sum(axis=2, dtype=np.int64)
    want = {(i, j) for i, j in np.argwhere(9 * bound >= 4 * (sizes[:, None] + sizes)) if i < j}
    found = [(min(i, j), max(i, j)) for left, right in ngram_join.CountTree(sizes, counts).pairs()
             for i, j in zip(left, right, strict=True)]
    assert set(found) == want and len(found) == len(want)


def test_sets_beyond_the_count_type_are_not_bounded(monkeypatch):
    full = np.full((2, ngram_join.GROUPS), 0xFFFF, dtype="<u2")
    sizes = np.array([5_000_000, 5_000_000])
    one, two = np.array([0]), np.array([1])
    assert ngram_join.within_bound(sizes, full, one, two).all()
    assert [len(i) for i, _ in ngram_join.CountTree(sizes, full).pairs()] == [1]
    monkeypatch.setattr(ngram_join, "MOST", 5)
    rng = np.random.default_rng(6)
    sets = []
    for _ in range(40):  # some beyond the limit, some not
        base = rng.integers(0, 1 << 63, rng.integers(60, 900)).astype(np.uint64)
        sets += [np.unique(base), np.unique(base[len(base) // 20:])]
    sizes = np.array([len(s) for s in sets])
    counts = np.array([ngram_join.group_counts(s) for s in sets])
    assert 10 < (counts == 5).all(axis=1).sum() < 75
    found = {(min(i, j), max(i, j)) for left, right in ngram_join.CountTree(sizes, counts).pairs()
             for i, j in zip(left, right, strict=True)}
    assert {(k, k + 1) for k in range(0, 80, 2)} <= found


def test_keep_one_judges_rows(spark):
    """Repeated and null doc_ids: a row leaves only for a row that it is linked with."""
    rng = random.Random(8)
    a, b, c, d, e = (" ".join(rng.choices([f"w{i}" for i in range(500)], k=80)) for _ in range(5))
    rows = [(5, a, "x"), (5, b, "x"), (1, a + " more", "x"), (None, c, "x"), (None, c + " more", "x"),
            (None, d, "x"), (7, e, "x"), (7, e, "x"), (None, e + " more", "x"), (8, None, "x"),
            (8, "", "x"), (None, None, "x"), (9, b + " more", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash string").repartition(3)
    got = ngram_join.keep_one(docs)
    assert got.dtypes == docs.dtypes
    got = tuples(got, "doc_id", "text")
    ends = [(None, c), (None, c + " more")]
    assert sum(g in ends for g in got) == 1
    assert sorted((g for g in got if g not in ends), key=repr) == sorted(
        [(1, a + " more"), (5, b), (None, d), (7, e), (8, None), (8, ""), (None, None)], key=repr)


def test_only_wanted_rows_are_shuffled(spark, monkeypatch):
    """What no pair asks for stays where it is read; what is asked for is whole."""
    rng = random.Random(9)
    ids = ([rng.randrange(-1 << 63, 1 << 63) for _ in range(20_000)]
           + [0, 1, -1, -1 << 63, (1 << 63) - 1])
    rows = spark.createDataFrame([(i, str(i)) for i in ids], "id long, text string")
    wanted = ids[::400] + ids[-5:]
    asked = spark.createDataFrame([(i,) for i in wanted * 2], "x long")
    found = ngram_join._among(rows, "id", asked)
    assert found.columns == rows.columns
    got = [r.id for r in found.collect()]
    assert set(wanted) <= set(got) and len(got) == len(set(got)) <= len(wanted) + 1_000
    assert ngram_join._among(rows, "id", asked.where("false")).count() == 0
    monkeypatch.setattr(ngram_join, "MOST_BITS", 64)  # full: nothing is held back, nothing is lost
    assert set(wanted) <= {r.id for r in ngram_join._among(rows, "id", asked).collect()}


def test_texts_are_not_shuffled_for_their_sets(spark):
    texts = variants(3, 300, 1) * 2 + [None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    some = docs.where("doc_id < 20").select(F.xxhash64("text").alias("text_hash"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sets = ngram_join._sets(docs, some)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        found = {r.id: (r.n, len(set(r.shingles))) for r in sets.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "hashpartitioning(text_hash" not in plan and "SortMergeJoin" not in plan
    names = {r.id for r in ngram_join._points(docs.where("doc_id < 20")).collect()}
    assert names <= set(found) and len(found) < 60
    assert all(n == m for n, m in found.values())


def test_texts_that_quote_one_passage_are_not_compared(spark, monkeypatch):
    """A quoted passage makes many texts meet in large shards; only those that share four fifths of
    their shingles with others are searched for links, and their sets are not sent pair by pair."""
    rng = random.Random(12)
    words = [f"w{i}" for i in range(20_000)]
    passage = rng.sample(words, 40)
    texts = [" ".join(passage + rng.sample(words, 60)) for _ in range(60)]
    near = [" ".join(passage + rng.sample(words, 6)) for _ in range(20)]  # some of them are linked
    rows = list(enumerate(texts + near + [texts[0] + " end"]))
    tiled, checked, spanning = [], [], ngram_join._verified

    def seen(*args, own=ngram_join._open_tiles):
        tiles = own(*args)
        tiled.append(0 if tiles is None else tiles.select("id").distinct().count())
        return tiles

    monkeypatch.setattr(ngram_join, "_open_tiles", seen)
    monkeypatch.setattr(ngram_join, "_verified", lambda pairs, sets: (
        checked.append(pairs.count()), spanning(pairs, sets))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert tuples(ngram_join.groups(docs)) == plain(rows)
    assert len(tiled) == 1 and tiled[0] <= 25
    assert len(checked) == 2


def test_links_of_a_tile_connect_what_all_pairs_connect():
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(30):
        base = np.unique(rng.integers(0, 1 << 63, rng.integers(5, 1500)).astype(np.uint64))
        sets += [np.unique(rng.choice(base, max(1, int(len(base) * f)), replace=False))
                 for f in (1, 0.95, 0.9, 0.85)]
    sizes, root = np.array([len(s) for s in sets]), np.arange(120)
    root[40:44] = 40
    i, j = np.triu_indices(120, 1)
    i, j = i[root[i] != root[j]], j[root[i] != root[j]]
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    links = 9 * both >= 4 * (sizes[i] + sizes[j])
    assert ngram_join._finely_bounded(sets, sizes, i, j)[links].all()
    assert not ngram_join._finely_bounded(sets, sizes, i, j)[both == 0].any()

    def groups(pairs):
        label = root.copy()
        for a, b in pairs:
            label[label == label[a]] = label[b]
        return {frozenset(np.flatnonzero(label == x).tolist()) for x in set(label.tolist())}

    found = ngram_join.spanning_links(sets, root, i, j, both / (sizes[i] + sizes[j]))
    assert links[found].all() and len(found) < links.sum()
    assert groups([(i[k], j[k]) for k in found]) == groups(zip(i[links], j[links], strict=True))
