"""The edit join against all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from churnspark.llm import line_dedup, queries
from conftest_llm import tuples


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, edits, alphabet="abcdefghé "):
    chars = list(line)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice(alphabet)
        elif kind == 1:
            chars.insert(at, rng.choice(alphabet))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def plain(rows, classes=line_dedup.CLASSES):
    """Rows of (doc_id, text), with distinct rows; the numbers of removed lines of each."""
    places = [(doc, i, line) for doc, text in rows
              for i, line in enumerate((text or "").split("\n"))]

    def counts(line):
        return len(line) >= 20 or any(c.isalpha() or c.isdigit() for c in line)

    kinds = sorted({p[2] for p in places if p[2] and counts(p[2])}, key=lambda k: (len(k), k))
    root = {k: k for k in kinds}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    def edits(n):
        return next((e for low, high, e in classes if low <= n and (high is None or n < high)), 0)

    for i, a in enumerate(kinds):
        for b in kinds[i + 1:]:
            if len(b) - len(a) > edits(len(a)):
                break
            if edits(len(a)) and distance(a, b) <= edits(len(a)):
                root[find(a)] = find(b)
    first, out = {}, {doc: [] for doc, _ in rows}
    for doc, i, line in sorted(places, key=lambda p: (p[0] is not None, p[0] or 0, p[1])):
        if line in root:
            if find(line) in first:
                out[doc].append(i)
            else:
                first[find(line)] = (doc, i)
    return sorted(((doc, len((text or "").split("\n")), len(out[doc]), sorted(out[doc]))
                   for doc, text in rows), key=repr)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_edit_distance(spark, edits):
    rng, rows = random.Random(edits), []
    for _ in range(400):
        a = "".join(rng.choices("abc é", k=rng.randrange(6, 90)))
        b = edited(rng, a, rng.randrange(edits + 3), "abc é")
        a, b = sorted((a, b), key=len, reverse=True)
        if b and len(a) - len(b) <= edits:
            rows.append((a, b))
    chars = [F.filter(F.split(c, ""), lambda x: x != "") for c in "ab"]
    got = spark.createDataFrame(rows, "a string, b string").select(
        "a", "b", line_dedup.edit_distance(*chars, edits).alias("d"),
        F.levenshtein("a", "b").alias("want")).collect()
    assert len(got) > 300
    for r in got:
        assert (r.d == r.want) if r.want <= edits else r.d > edits


def test_signature_bound(spark):
    rng, rows = random.Random(4), []
    for _ in range(300):
        a = "".join(rng.choices("abcdefgh é", k=50))
        rows.append((a, edited(rng, a, 2)))
    chars = [line_dedup.signature(F.filter(F.split(c, ""), lambda x: x != "")) for c in "ab"]
    far = spark.createDataFrame(rows, "a string, b string").select(
        F.bit_count(chars[0].bitwiseXOR(chars[1])).alias("n")).collect()
    assert max(r.n for r in far) <= 8


def test_lines_equal_all_pairs(spark, odd_docs, no_docs):
    rng = random.Random(2)
    bases = ["".join(rng.choices("abcdefghij é", k=rng.randrange(18, 70))) for _ in range(25)]
    rows = []
    for doc in range(60):
        lines = [edited(rng, rng.choice(bases), rng.randrange(4)) for _ in range(6)]
        rows.append((doc, "\n".join([*lines, "short", ""])))
    rows += [(None, rows[0][1] + "\nmore"), (99, None), (98, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for classes in (line_dedup.CLASSES, line_dedup.fixed(3, 20)):
        assert tuples(line_dedup.line_report(docs, classes)) == plain(rows, classes)
    odd = line_dedup.line_report(odd_docs)
    assert odd.count() == odd_docs.count()
    assert line_dedup.line_report(no_docs).count() == 0
    kept = {r.doc_id: r.text for r in line_dedup.drop_lines(
        docs.withColumn("n_chars", F.length("text").cast("long"))).collect()}
    for doc, _, _, gone in plain(rows):
        text = dict(rows)[doc]
        want = None if text is None else "\n".join(
            x for i, x in enumerate(text.split("\n")) if i not in gone)
        assert kept[doc] == want


def test_repeated_rows_are_one_document(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, line), (1, line), (2, line + "!")],
                                 "doc_id long, text string")
    assert tuples(line_dedup.line_report(docs), "doc_id", "n_removed") == [(1, 0), (1, 0), (2, 1)]
    assert line_dedup.drop_lines(odd := docs.withColumn("doc", F.lit("x"))).columns == odd.columns


def spread(rng, line, edits):
    """The line with so many edits at even distances, which leave the shortest stretches."""
    chars = list(line)
    for e in range(edits, 0, -1):
        at = e * len(line) // (edits + 1)
        kind = rng.randrange(3)
        chars[at:at + (kind != 1)] = [] if kind == 2 else ["#"]
    return "".join(chars)


def linked(spark, rows, classes):
    """Pairs of (id, line) by the join and by all pairs."""
    lines = spark.createDataFrame([(i, r, len(r)) for i, r in enumerate(rows)],
                                  "id long, line string, n int").cache()
    a, b = lines.toDF("a", "la", "na"), lines.toDF("b", "lb", "nb")
    most = max(c[2] for c in classes)
    edits = line_dedup.edits_of(F.least("na", "nb"), classes)
    want = {tuple(r) for r in a.join(b, F.expr(f"a < b AND abs(na - nb) <= {most}"))
            .where(F.call_function("levenshtein", "la", "lb", edits) >= 0).select("a", "b").collect()}
    got = {tuple(sorted(r)) for r in line_dedup.near_lines(lines, classes).collect()}
    return got, want


@pytest.mark.parametrize("classes,lengths", [
    (line_dedup.fixed(4, 10), (12, 60)),
    (((8, 14, 1), (14, 30, 2), (30, 60, 3), (60, None, 5)), (8, 80)),
    (line_dedup.CLASSES, (370, 430)), (line_dedup.CLASSES, (1590, 1610))])
def test_every_class_equals_all_pairs(spark, classes, lengths):
    rng, rows = random.Random(lengths[0]), set()
    for _ in range(25):
        base = "".join(rng.choices("abcdefghij é", k=rng.randrange(*lengths)))
        for e in range(1, 6):
            rows |= {base, spread(rng, base, e), edited(rng, base, e)}
    for n in range(lengths[0], min(lengths[0] + 12, lengths[1])):
        rows |= {"x" * n, "ab " * (n // 3)}
    got, want = linked(spark, sorted(rows), classes)
    assert got == want and len(got) > 100


def test_query_finds_a_replaced_word_in_a_long_line(spark, tmp_path):
    """Four edits are within the limit of lines from 1,600 characters on, and none of shorter ones."""
    words = " ".join(f"word{i}" for i in range(250))
    rows = [(1, words + " and wait for the rain"), (2, words + " and hope for the rain"),
            (3, words[:900] + " and wait for the rain"), (4, words[:900] + " and hope for the rain")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op4_line_dedup"](spark, str(tmp_path))
    assert tuples(got, "doc_id", "n_removed") == [(1, 0), (2, 1), (3, 0), (4, 0)]


def test_a_column_with_a_dot(spark):
    line = "a line of more than twenty characters"
    docs = spark.createDataFrame([(1, line, 2), (2, line, 3)], "doc_id long, text string, `a.b` int")
    kept = line_dedup.drop_lines(docs)
    assert kept.columns == docs.columns
    assert tuples(kept.toDF("a", "b", "c")) == [(1, line, 2), (2, "", 3)]


def test_short_lines_that_hold_a_word(spark, tmp_path):
    """Equal ones go at any length, from 8 characters on those one edit apart as well."""
    rows = [(1, "Enststung ench.\nOk\n---\nno\n"), (2, "Enststung ench.\nOk\n---\nna\n"),
            (3, "Enststung enc.\n7\n***"), (4, "Enststxng eych.\n7\n***"),
            (5, "nineteen characters\ntwenty characters ab"),
            (6, "nineteen characterss\ntwenty characters cd")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    want = [(1, []), (2, [0, 1]), (3, [0]), (4, [1]), (5, []), (6, [0, 1])]
    got = queries.QUERIES["op4_line_dedup"](spark, str(tmp_path))
    assert tuples(got, "doc_id", "removed") == want
    kept = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, None).collect()}
    assert kept[2] == "---\nna\n" and kept[6] == "" and kept[1] == rows[0][1]


def test_keys_are_made_in_compiled_code(spark):
    """Functions over arrays run uncompiled, four times slower here; and the keys stay the same."""
    lines = line_dedup._lines(spark.createDataFrame(
        [(1, "short one\n" + "a line of 😀 more than twenty characters\n" + "long " * 100)],
        "doc_id long, text string"), 8)
    lines = spark.createDataFrame(lines.collect(), lines.schema)
    keys = line_dedup._keys(lines, line_dedup.CLASSES)
    assert "lambda" not in keys._jdf.queryExecution().executedPlan().toString()
    want = set()
    for r in lines.collect():
        at = next(i for i, (low, high, _) in enumerate(line_dedup.CLASSES)
                  if r.n >= low and (high is None or r.n < high))
        for edits, low, high, longer, segment, shift, probe in line_dedup._places(
                line_dedup.CLASSES, at):
            length, parts = r.n - longer, edits + 1
            size, rest = divmod(length, parts)
            start = segment * size + max(0, segment - (parts - rest)) + shift
            size += segment >= parts - rest
            if low <= length < high and start >= 0 and start + size <= r.n:
                code = 2 * r.id + probe  # the id's highest bit leaves
                code -= (code >> 63) << 64
                want.add((length, segment, r.line[start:start + size], code))
    table = spark.createDataFrame(list(want), "length int, segment int, part string, code long")
    assert table.count() == keys.count() > 50
    hashed = table.selectExpr("xxhash64(length, segment, encode(part, 'UTF-32')) AS k", "code")
    assert {tuple(r) for r in keys.collect()} == {tuple(r) for r in hashed.collect()}
