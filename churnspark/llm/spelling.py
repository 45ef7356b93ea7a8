"""Spelling variants: words one edit apart, through PartEnum signatures of letter multisets.

A word's letters are a binary vector with one dimension per letter and occurrence. One replaced
letter changes two dimensions of it, an inserted or deleted one changes one. The dimensions are
partitioned, and the partitions' parts are enumerated, so that two vectors within that Hamming
distance agree in at least one projection; projections are compared by equi-joins, and words that
meet are verified.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm import checksum_sql
from churnspark.llm.common import stored, texts_of

#: Maximal runs of these letters (in Latin-1, after A-Z were lower-cased) are words.
RUN = re.compile(rb"[a-z\xC0-\xFF]+")
DELETE_EVERY = 199
LEAST_CHARS = 6
LEAST_COUNT = 5
FORM_RATIO = 5
#: Distinct words that a counting task holds before it sends them on.
HELD = 200_000
#: PartEnum: (Hamming distance, partitions, parts of each) for words of one length, and for words
#: whose lengths differ by one.
SAME_LENGTH = (2, 1, 7)
OTHER_LENGTH = (1, 1, 4)
#: Signatures of more words also ask for an equal first or second half (see ``near_pairs``).
HOT = 64


# ---- words ------------------------------------------------------------------------------------------

def _altered(word: bytes, start: int) -> bytes:
    """The word, without one letter if the checksum that began with ``start`` says so."""
    check = zlib.crc32(word.decode("latin-1").encode(), start)
    if check % DELETE_EVERY:
        return word
    at = check % len(word)
    return word[:at] + word[at + 1:]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of every whole text: words of enough letters that occur often enough.

    Words are runs of Latin letters with A-Z lower-cased; where 199 divides the unsigned CRC-32 of
    ``<doc_id>:<word>``, one letter is deleted first. A null text has no words; in a row whose
    doc_id is null nothing is deleted. Counts are combined in the tasks before the shuffle.
    """
    def flush(counts: Counter):
        words = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in words], pa.string()),
             pa.array([counts[w] for w in words], pa.int64())], ["word", "n"])

    def run(batches):
        total: Counter = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                # other characters become question marks, which are not letters
                letters = text.as_py().encode("latin-1", "replace").lower()
                start = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode())
                for word, n in Counter(RUN.findall(letters)).items():
                    if len(word) < LEAST_CHARS:
                        continue
                    if start is not None:
                        word = _altered(word, start)
                        if len(word) < LEAST_CHARS:
                            continue
                    total[word] += n
                if len(total) > HELD:
                    yield from flush(total)
                    total.clear()
        yield from flush(total)

    return (texts_of(docs).mapInArrow(run, "word string, n long").groupBy("word")
            .agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT))


# ---- signatures --------------------------------------------------------------------------------------

def subsets(distance: int, partitions: int, parts: int) -> list[tuple[int, ...]]:
    """Sets of parts (numbered over all partitions) whose projections are the signatures.

    Vectors within ``distance`` differ in at most (distance + 1) / partitions - 1 dimensions, rounded
    up, of some partition, hence in as many of its parts at most; they agree in all others.
    """
    inside = -(-(distance + 1) // partitions) - 1
    if not 0 <= inside < parts:
        raise ValueError("a partition needs more parts than it may have differences")
    return [tuple(p * parts + i for i in chosen) for p in range(partitions)
            for chosen in combinations(range(parts), parts - inside)]


def _random(*shape: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 1 << 64, size=shape, dtype=np.uint64)


def letter_matrix(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, letter, occurrence from 1) of every dimension that is set, as three arrays."""
    raw = np.frombuffer("".join(words).encode("latin-1"), np.uint8).astype(np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), lengths)
    by = np.argsort(owner * 256 + raw, kind="stable")
    code = (owner * 256 + raw)[by]
    new = np.concatenate(([True], code[1:] != code[:-1])) if len(code) else np.zeros(0, bool)
    starts = np.maximum.accumulate(np.where(new, np.arange(len(code)), 0))
    return code // 256, code % 256, np.arange(len(code)) - starts + 1


class PartEnum:
    """Signatures of letter multisets, as 64-bit sums of random values of the projected dimensions."""

    def __init__(self, distance: int, partitions: int, parts: int):
        self.sets = subsets(distance, partitions, parts)
        self.parts = partitions * parts
        self.values = _random(256, 64, seed=parts)
        self.part_of = (_random(256, 64, seed=1000 + parts) % np.uint64(self.parts)).astype(np.int64)
        self.salts = _random(len(self.sets), seed=2000 + parts)

    def signatures(self, words: list[str]) -> np.ndarray:
        """One row per word, one column per set of parts. Occurrences of a letter beyond the 64th
        share the dimensions of the first ones, by their value: sums still tell them apart."""
        word, letter, number = letter_matrix(words)
        times, number = (number - 1) // 64, (number - 1) % 64
        sums = np.zeros((len(words), self.parts), dtype=np.uint64)
        value = self.values[letter, number] * (2 * times + 1).astype(np.uint64)
        np.add.at(sums, (word, self.part_of[letter, number]), value)
        out = np.empty((len(words), len(self.sets)), dtype=np.uint64)
        for i, chosen in enumerate(self.sets):
            mixed = np.full(len(words), self.salts[i])
            for part in chosen:
                mixed = (mixed ^ sums[:, part]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            out[:, i] = mixed
        return out


def _signed(words: DataFrame) -> DataFrame:
    """(sig, side, word): side 0 looks for words of its length, 1 as the shorter and 2 as the longer
    of two words. The signature covers the kind and the (smaller) length."""
    def run(batches):
        same, other = PartEnum(*SAME_LENGTH), PartEnum(*OTHER_LENGTH)
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                words = batch.column(0).slice(at, 4096).to_pylist()
                lengths = np.fromiter(map(len, words), np.uint64, len(words))
                for side, enum, tag in ((0, same, lengths), (1, other, lengths),
                                        (2, other, lengths - np.uint64(1))):
                    mixed = enum.signatures(words) + (
                        tag * np.uint64(0xD1B54A32D192ED03) + np.uint64(min(side, 1)))[:, None]
                    n = mixed.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(mixed.ravel().view(np.int64)),
                         pa.array(np.full(mixed.size, side, dtype=np.int8)),
                         pa.array(words).take(pa.array(np.repeat(np.arange(len(words)), n)))],
                        ["sig", "side", "word"])

    return words.select("word").mapInArrow(run, "sig long, side tinyint, word string")


def one_edit(a: Column, b: Column) -> Column:
    """Whether two different words are one inserted, deleted or replaced character apart."""
    return F.call_function("levenshtein", a, b, F.lit(1)) == 1


def _met(signed: DataFrame, extra: list[str]) -> DataFrame:
    """(u, v), each pair once: words that meet under a signature and are one edit apart."""
    keys = ["sig", *extra]
    one = signed.where("side < 2").select(*keys, F.col("side").alias("kind"), F.col("word").alias("u"))
    two = signed.where("side <> 1").select(
        *keys, F.when(F.col("side") == 0, 0).otherwise(1).cast("tinyint").alias("kind"),
        F.col("word").alias("v"))
    ordered = (F.col("kind") == 1) | (F.col("u") < F.col("v"))
    return (one.join(two, [*keys, "kind"]).where(ordered & one_edit(F.col("u"), F.col("v")))
            .select("u", "v"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(u, v): all pairs of different words one edit apart, u the shorter or the smaller one.

    Signatures that only one side holds go before the join. Where more than ``HOT`` words hold a
    signature, they meet only if their first halves agree (as long as half of the shorter word) or
    what follows does, one of which one edit leaves alone; so anagrams and words of few letters are
    not compared with each other one by one.
    """
    signed = stored(_signed(words), "spelling-signatures")
    counts = signed.groupBy("sig").agg(*(F.count_if(F.col("side") == i).alias(name)
                                         for i, name in enumerate(("same", "shorter", "longer"))))
    wanted = counts.where("same > 1 OR (shorter > 0 AND longer > 0)").select(
        "sig", F.greatest("same", "shorter", "longer").alias("held"))
    used = stored(signed.join(wanted, "sig"), "spelling-keys")
    usual = _met(used.where(F.col("held") <= HOT), [])
    length = F.length("word") - F.when(F.col("side") == 2, 1).otherwise(0)
    middle = F.floor(length / 2).cast("int")
    halves = used.where(F.col("held") > HOT).withColumn("half", F.explode(F.array(
        F.concat(F.lit("<"), F.substr("word", F.lit(1), middle)),
        F.concat(F.lit(">"), F.substr("word", F.length("word") - (length - middle) + 1)))))
    return usual.union(_met(halves, ["half"])).distinct()


# ---- forms and roots ------------------------------------------------------------------------------------

def _followed(forms: DataFrame) -> DataFrame:
    """(word, root) of words that have a form: forms are followed to the last by doubling steps.

    A form occurs five times as often as its word, so chains are short and have no circles.
    """
    now = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        if now.join(ahead, "root", "left_semi").isEmpty():
            return now
        now = stored(now.join(ahead, "root", "left")
                     .select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``word_counts``.

    ``form`` is the near word of largest count, of equal ones the first in code-point order, if it
    occurs at least five times as often as the word. Words without near words have a null form,
    n_near 0 and themselves as root. Other columns of ``docs`` are ignored; an empty table gives
    no rows.
    """
    words = stored(word_counts(docs), "spelling-words")
    pairs = near_pairs(words)
    both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    known = words.select(F.col("word").alias("v"), F.col("n").alias("vn"))
    best = (both.join(known, "v").groupBy(F.col("u").alias("word"))
            .agg(F.count("*").alias("n_near"),
                 F.min(F.struct((-F.col("vn")).alias("order"), F.col("v").alias("form"))).alias("best")))
    judged = words.join(best, "word", "left").withColumn(
        "takes", -F.col("best.order") >= FORM_RATIO * F.col("n"))
    formed = stored(judged.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("takes"), F.col("best.form")).alias("form"),
        F.when(F.col("takes"), -F.col("best.order")).alias("form_n")), "spelling-forms")
    roots = _followed(formed.where("form IS NOT NULL"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


ORACLE = f"""
WITH RECURSIVE {checksum_sql.TABLE},
runs AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz') AS run
         FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS run
               FROM documents)),
each AS (SELECT run, n, {checksum_sql.crc32("doc_id::VARCHAR || ':' || run")} AS h
         FROM (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY doc_id, run), crc_table),
cut AS (SELECT n, CASE WHEN h % {DELETE_EVERY} = 0 THEN substr(run, 1, h % length(run))
                    || substr(run, h % length(run) + 2) ELSE run END AS word FROM each),
w AS (SELECT word, sum(n)::BIGINT AS n FROM cut WHERE length(word) >= {LEAST_CHARS}
      GROUP BY word HAVING sum(n) >= {LEAST_COUNT}),
gap AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word AS u, b.word AS v FROM gap a JOIN gap b
           ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT word, rest FROM gap SEMI JOIN w ON gap.rest = w.word
         UNION SELECT rest, word FROM gap SEMI JOIN w ON gap.rest = w.word),
best AS (SELECT u AS word, count(*) AS n_near, arg_min(v, (-w.n, v)) AS form, max(w.n) AS form_n
         FROM near JOIN w ON v = w.word GROUP BY u),
f AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
        CASE WHEN form_n >= {FORM_RATIO} * w.n THEN form END AS form,
        CASE WHEN form_n >= {FORM_RATIO} * w.n THEN form_n END AS form_n
      FROM w LEFT JOIN best USING (word)),
up AS (SELECT word, word AS root FROM f
       UNION ALL SELECT up.word, f.form FROM up JOIN f ON up.root = f.word
       WHERE f.form IS NOT NULL)
SELECT f.word, f.form, up.root, f.n, f.n_near, f.form_n FROM f JOIN up ON f.word = up.word
  JOIN f last ON up.root = last.word WHERE last.form IS NULL
"""
