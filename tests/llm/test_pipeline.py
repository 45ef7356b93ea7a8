"""The pipeline's stages one after the other, against the brute-force version of each."""

import random
import sys
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import test_line_dedup
import test_ngram_join
import test_suffix_dedup
from churnspark.llm import packing, quality_rules, suffix_dedup
from churnspark.llm.queries import WORD_BPE
from conftest_llm import tuples

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def corpus(seed=3):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choices("abcdeéfgh", k=rng.randrange(2, 9))) for _ in range(900)]

    def words(n):
        return " ".join(rng.choices(vocabulary, k=n))
    passage, line, texts = words(70), words(9), []
    for _ in range(40):
        text = "\n".join(words(rng.randrange(5, 40)) for _ in range(rng.randrange(1, 6)))
        if rng.random() < 0.3:
            text = f"{line}{rng.choice('.!,')}\n{text}"
        if rng.random() < 0.3:
            text += f"\n{words(4)} {passage} {words(4)}"
        texts.append(text)
        if rng.random() < 0.4:
            texts.append(text.replace(" a", " b", 2) + " " + words(3))
    texts += ["too short", None, "", "Same " * 60, "SHOUT!! " * 3 + words(30).upper()]
    return [(i, t, "en", "src", len(t or "")) for i, t in enumerate(texts)]


def kept_by_rules(docs):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    return {r[0] for r in con.execute(
        f"SELECT doc_id FROM ({quality_rules.ORACLE}) WHERE kept").fetchall()}


def check_packing(rows, texts, capacity=2048):
    library = Tokenizer.from_file(WORD_BPE)
    want = []
    for doc, text in texts:
        ids = np.asarray(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        for n, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((doc, n, at, len(part), zlib.crc32(part.tobytes())))
    assert sorted([tuple(r)[:5] for r in rows], key=repr) == sorted(want, key=repr)
    ends = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert all(e <= capacity for e in ends.values())
    return len(ends), -(-sum(w[3] for w in want) // capacity)


def test_stages_equal_brute_force(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    now, current = docs, [(r[0], r[1]) for r in rows]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, None).cache()
        assert now.dtypes == docs.dtypes
        if name == "quality_rules":
            keep = kept_by_rules(current)
            current = [r for r in current if r[0] in keep]
        elif name == "line_dedup":
            gone = {r[0]: r[3] for r in test_line_dedup.plain(current)}
            current = [(d, "\n".join(x for i, x in enumerate(t.split("\n")) if i not in gone[d]))
                       for d, t in current]
        elif name == "ngram_jaccard_join":
            keep = {d for d, _, c in test_ngram_join.plain(current) if d == c}
            current = [r for r in current if r[0] in keep]
        else:
            before = len(current)
            current = [(d, kept.decode(errors="ignore"))
                       for d, kept in test_suffix_dedup.kept_bytes(current)]
            assert before == len(current)
        assert tuples(now, "doc_id", "text", "n_chars") == sorted(
            ((d, t, len(t)) for d, t in current), key=repr)
    used, least = check_packing(corpus_pipeline.STAGES[-1][1](spark, now, None).collect(), current)
    assert used == least


def test_run_and_empty_table(spark, tmp_path):
    spark.createDataFrame(corpus(5), SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 20
    nothing = tmp_path / "nothing"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{nothing}/documents.parquet")
    assert corpus_pipeline.run(spark, str(nothing)).count() == 0


def test_packing_of_documents(documents, odd_docs, no_docs):
    for docs in (documents, odd_docs):
        texts = [(r.doc_id, r.text) for r in docs.collect()]
        used, least = check_packing(packing.pack(docs, WORD_BPE).collect(), texts)
        assert used <= least + 1
    assert packing.pack(no_docs, WORD_BPE).count() == 0


def test_packed_sequences_hold_the_ids(documents):
    some = documents.limit(40).cache()
    pieces = packing.cut_pieces(some, WORD_BPE, with_ids=True).cache()
    placed = packing.place(pieces.drop("ids")).cache()
    whole = {r.sequence_id: r.ids for r in packing.sequences(pieces, placed).collect()}
    ids = {(r.doc_id, r.piece): r.ids for r in pieces.collect()}
    for r in placed.collect():
        assert whole[r.sequence_id][r.offset:r.offset + r.length] == ids[r.doc_id, r.piece]


@pytest.mark.parametrize("capacity,kinds", [(100, (1, 100)), (100, (34, 70)), (2048, (500, 900))])
def test_local_search(capacity, kinds):
    rng = np.random.default_rng(capacity + kinds[0])
    sizes = rng.integers(*kinds, 400)
    first = packing.Bins(sizes, capacity)
    first.best_fit()
    bins = packing.Bins(sizes, capacity)
    bins.best_fit()
    squared = ((capacity - bins.space) ** 2).sum()
    bins.improve(2000)
    assert ((capacity - bins.space) ** 2).sum() >= squared
    full = [b for b in bins.items if b]
    assert sorted(i for b in full for i in b) == list(range(400))
    assert all(sizes[b].sum() <= capacity for b in full) and len(full) <= len(first.items)


def test_quality_ledger(spark, odd_docs, no_docs):
    entries = quality_rules.ledger(odd_docs).cache()
    assert entries.count() == odd_docs.count()
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)",
                    [(r.doc_id, r.text) for r in odd_docs.collect()])
    names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
             "failed", "base_failed", "kept"]
    judged = quality_rules.apply_policy(entries, quality_rules.POLICIES[2])
    want = con.execute(f"SELECT {', '.join(names)} FROM ({quality_rules.ORACLE})").fetchall()
    assert tuples(judged, *names) == sorted(want, key=repr)
    failed = [r.failed for r in entries.collect()]
    for r in quality_rules.ablation(entries, quality_rules.POLICIES[2]).collect():
        bit = quality_rules.BIT[r.rule]
        assert r.failing == sum(f & bit != 0 for f in failed)
        assert r.failing_alone == sum(f == bit for f in failed)
    assert quality_rules.ledger(no_docs).count() == 0
    assert quality_rules.keep_documents(odd_docs).columns == odd_docs.columns
    assert sys.modules["corpus_pipeline"]


def test_local_search_looks_at_all_sizes_and_ends_by_itself():
    sizes = np.array([*range(101, 113), 30, 20, 48, 1998])
    bins = packing.Bins(sizes, 2048)
    bins.items, bins.bin_of = [list(range(14)), [14, 15]], np.array([0] * 14 + [1] * 2)
    bins.space = np.array([2048 - int(sizes[:14].sum()), 2])
    assert bins._step(0)  # 30 and 20 for 48
    assert bins.space[1] == 0 and sorted(bins.items[1]) == [12, 13, 15]

    class Counted(packing.Bins):
        steps = 0

        def _step(self, donor):
            self.steps += 1
            return super()._step(donor)

    sizes = np.random.default_rng(7).integers(500, 900, 9000)
    bins = Counted(sizes, 2048)
    bins.best_fit()
    bins.improve()
    assert bins.steps > 2_000
    assert sorted(i for b in bins.items for i in b) == list(range(9000))
    assert all(sizes[b].sum() == 2048 - room for b, room in zip(bins.items, bins.space, strict=True))
    assert bins.space.min() >= 0
