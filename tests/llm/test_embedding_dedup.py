"""The pivot index against all pairs."""

import numpy as np

from churnspark.llm import embedding_dedup
from conftest_llm import tuples


def plain(rows):
    """Rows of (vec_id, embedding, label); what all pairs give."""
    def usable(r):
        v = r[1]
        return (r[2] is not None and v and all(x is not None and np.isfinite(x) for x in v)
                and any(v))
    root, count = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    good = [i for i, r in enumerate(rows) if usable(r)]
    pairs = set()
    for key in {(rows[i][2], len(rows[i][1])) for i in good}:
        group = [i for i in good if (rows[i][2], len(rows[i][1])) == key]
        x = np.array([rows[i][1] for i in group], dtype=np.float64)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        pairs |= {(group[i], group[j]) for i, j in np.argwhere(x @ x.T >= 0.93) if i < j}
    for i, j in pairs:
        count[i] += 1
        count[j] += 1
        root[find(i)] = find(j)
    out = []
    for i, r in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((r[0], count[i], low, r[0] == low))
    return sorted(out, key=repr), len(pairs)


SCHEMA = "vec_id long, embedding array<float>, label int, node string, weight int"


def clusters(seed, n, width=64, per=5, low=0.9):
    """Vectors around centres, at cosines near the limit."""
    rng = np.random.default_rng(seed)
    out = []
    for _ in range(n):
        centre = rng.normal(size=width)
        centre /= np.linalg.norm(centre)
        for _ in range(per):
            noise = rng.normal(size=width)
            noise -= (noise @ centre) * centre
            noise /= np.linalg.norm(noise)
            c = rng.uniform(low, 1)
            out.append((centre * c + noise * np.sqrt(1 - c * c)).astype(np.float32).tolist())
    return out


def test_odd_rows_and_small_tiles(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "TILE", 7)
    near = clusters(1, 8, width=6, per=9, low=0.99)
    rows = [(i, v, i % 2, "x", 1) for i, v in enumerate(near)]
    odd = [None, [], [0.0] * 6, [1.0, None, 0.0, 0.0, 0.0, 0.0], [float("nan")] * 6, [float("inf")] * 6]
    rows += [(200 + i, v, 1, None, None) for i, v in enumerate(odd)]
    rows += [(300, near[0], None, None, None), (0, near[0], 0, None, None),
             (None, near[0], 0, None, None), (301, [2 * x for x in near[0]], 0, None, None),
             (None, [9.0, 1.0, 1.0, 1.0, 1.0, 1.0], 5, None, None), (302, [1.0, 2.0], 0, None, None)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert tuples(got) == plain(rows)[0]
    empty = spark.createDataFrame([], SCHEMA)
    assert embedding_dedup.near_duplicates(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None, None)], SCHEMA)
    assert tuples(embedding_dedup.near_duplicates(nothing)) == [(1, 0, 1, True)]


def test_recall_at_the_limit(spark):
    """Links found against all pairs, many of them just above the limit; none below it."""
    vectors = clusters(3, 700, low=0.93)
    rows = [(i, v, i % 3, None, None) for i, v in enumerate(vectors)]
    want, pairs = plain(rows)
    got = tuples(embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    links = sum(r[1] for r in got)
    most = {r[0]: r[1] for r in want}
    assert all(n <= most[vec] for vec, n, _, _ in got)
    assert pairs > 300
    assert links / (2 * pairs) >= 0.9


def test_embeddings(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert tuples(embedding_dedup.near_duplicates(table)) == plain(rows)[0]


def copies_of_one(rng, n, width=64, near=0.97):
    """Vectors at one cosine from a common centre, so at about its square from each other."""
    centre = rng.normal(size=width)
    centre /= np.linalg.norm(centre)
    noise = rng.normal(size=(n, width))
    noise -= np.outer(noise @ centre, centre)
    noise /= np.linalg.norm(noise, axis=1, keepdims=True)
    return (near * centre + np.sqrt(1 - near * near) * noise).astype(np.float32)


def test_recall_in_a_dense_group(spark):
    """A third of the rows are near copies of one vector; registered parameters."""
    rng = np.random.default_rng(11)
    vectors = np.concatenate([copies_of_one(rng, 4000),
                              rng.normal(size=(8000, 64)).astype(np.float32)])
    rows = [(i, v.tolist(), 1, None, None) for i, v in enumerate(vectors)]
    x = vectors.astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.array([(x @ v >= 0.93).sum() - 1 for v in x])
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    links = np.zeros(len(rows), dtype=np.int64)
    for r in got:
        links[r.vec_id] = r.n_links
    assert len(got) == len(rows) and (links <= want).all() and want.sum() > 1_000_000
    assert links.sum() / want.sum() >= 0.9


def test_all_rows_about_one_pivot(spark):
    vectors = copies_of_one(np.random.default_rng(12), 150)
    rows = [(i, v.tolist(), 1, None, None) for i, v in enumerate(vectors)]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, SCHEMA))
    assert tuples(got) == plain(rows)[0]
