"""PartEnum joins against all pairs."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from churnspark.llm import spelling
from conftest_llm import tuples

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def plain_counts(rows):
    found = Counter()
    for r in rows:
        for word in RUN.findall(r.text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in word)
            check = zlib.crc32(f"{r.doc_id}:{word}".encode())
            if r.doc_id is not None and check % 199 == 0:
                at = check % len(word)
                word = word[:at] + word[at + 1:]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(counts):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, found in near.items():
        best = min(found, key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= 5 * counts[w]:
            form[w] = best
    out = []
    for w in counts:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, counts[w], len(near[w]),
                    counts[form[w]] if w in form else None))
    return sorted(out, key=repr)


def test_documents(documents):
    assert tuples(spelling.variants(documents)) == plain_variants(plain_counts(documents.collect()))


def table_of(spark, counts):
    text = " ".join(f"{w} " * n for w, n in counts.items())
    return spark.createDataFrame([(None, text, 1)], "doc_id long, text string, word int")


@pytest.mark.parametrize("hot", [0, 1, 64])
def test_chains_ties_and_hot_signatures(spark, monkeypatch, hot):
    """Anagrams share all signatures; with few words to a hot one, halves decide."""
    monkeypatch.setattr(spelling, "HOT", hot)
    rng = np.random.default_rng(5)
    counts = {"".join(rng.permutation(list("aabbcd"))): int(rng.integers(5, 9)) for _ in range(80)}
    counts |= {w + "x": 40 for w in list(counts)[:9]} | {"x" + w: 40 for w in list(counts)[:9]}
    counts |= {"letters": 5, "letterz": 25, "letterzz": 125, "letterzzz": 625, "étéétés": 5,
               "étéété": 30, "étéétè": 30, "aaaaaa": 6, "aaaaaaa": 7, "aaaaab": 40,
               "z" * 200: 5, "z" * 201: 26, "z" * 100 + "y" + "z" * 99: 26}
    got = spelling.variants(table_of(spark, counts))
    assert tuples(got) == plain_variants(counts)


def test_signatures_of_words_within_the_distance_agree():
    rng = np.random.default_rng(3)
    for distance, partitions, parts in ((2, 1, 7), (2, 2, 4), (2, 3, 2), (1, 1, 4)):
        enum = spelling.PartEnum(distance, partitions, parts)
        for _ in range(200):
            word = "".join(rng.choice(list("abcdefgh"), rng.integers(6, 12)))
            at = int(rng.integers(0, len(word)))
            other = word[:at] + ("" if distance == 1 else "xyz"[at % 3]) + word[at + 1:]
            one, two = enum.signatures([word, other])
            assert (one == two).any()
    with pytest.raises(ValueError):
        spelling.subsets(2, 1, 2)


def test_odd_rows(spark, odd_docs, no_docs):
    many = odd_docs
    for _ in range(4):
        many = many.union(odd_docs)
    assert tuples(spelling.variants(many)) == plain_variants(plain_counts(many.collect()))
    assert spelling.variants(no_docs).count() == 0
