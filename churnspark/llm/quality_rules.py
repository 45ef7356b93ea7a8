"""Quality rules as a ledger: every rule is evaluated once and kept as a bit of a mask.

DataFrame functions only. ``ledger`` stores the measurements and the failure bits of every
document; ``apply_policy`` keeps or rejects by a versioned mask of rules; ``ablation`` tells from
the same bits what each rule of a policy costs. Neither reads the texts again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import SPACES, WORD, stored, texts_of

SYMBOLS = "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines",
            "n_capitals", "n_stutter")


@dataclass(frozen=True)
class Rule:
    """A condition, in whole numbers over the measurements, under which a document fails."""

    name: str
    fails: str


#: The place in this tuple is the rule's bit; new rules go to the end.
RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_windows", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "100 * n_symbols > 10 * n_words"),
    Rule("duplicate_lines", "100 * n_dup_lines > 50 * n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 15 * n_words"),
    Rule("capitals", "100 * n_capitals > 30 * word_chars"),
    Rule("stutter", "100 * n_stutter > 20 * n_words"),
)
BIT = {rule.name: 1 << i for i, rule in enumerate(RULES)}


def mask_of(*names: str) -> int:
    return sum(BIT[n] for n in names)


BASE = mask_of("few_words", "repeated_windows")
#: Versions of the policy; a version never changes once documents were filtered by it.
POLICIES = {1: BASE, 2: mask_of(*BIT)}
CURRENT = 2


def _repeat_words() -> Column:
    """Words inside windows that occur twice or more, from ``words``, exactly.

    Windows are sorted as text with their places; places of equal neighbours are put in order,
    and each adds what the one before does not cover.
    """
    covered = F.aggregate(
        F.sort_array(F.transform(
            F.filter(F.sequence(F.lit(0), F.size("sorted") - 1), lambda j: (
                (F.get("sorted", j - 1)["text"].eqNullSafe(F.get("sorted", j)["text"]))
                | (F.get("sorted", j + 1)["text"].eqNullSafe(F.get("sorted", j)["text"])))),
            lambda j: F.get("sorted", j)["at"])),
        F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last")),
        lambda acc, at: F.struct((acc["total"] + F.least(F.lit(WINDOW), at - acc["last"]))
                                 .alias("total"), at.alias("last")),
        lambda acc: acc["total"])
    return F.when(F.size("sorted") > 1, covered).otherwise(0)


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and MEASURES (all long) of every whole text; one row for each input row.

    Null text: no words, all zero. Null doc_ids stay. Other columns are ignored. Only texts in
    which the hashes of two windows agree go through the exact count of repeated windows.
    """
    text = F.col("text")
    parts = texts_of(docs).select(
        "doc_id", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("words"),
        F.filter(F.split("text", "\n"), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
        .alias("lines"))
    hashed = parts.select(
        "doc_id", "words", F.size("words").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        (F.length(text) - F.length(F.translate(text, CAPITALS, ""))).alias("n_capitals"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("words", lambda w, i: (i > 0) & w.eqNullSafe(F.get("words", i - 1))))
        .alias("n_stutter"),
        F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    windows = hashed.withColumn("windows", F.when(
        F.size("hashes") > WINDOW, F.transform(
            F.sequence(F.lit(1), F.size("hashes") - WINDOW + 1),
            lambda i: F.xxhash64(F.slice("hashes", i, WINDOW)))))
    sortable = windows.withColumn("sorted", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size("words") - WINDOW),
            lambda i: F.struct(F.concat_ws(" ", F.slice("words", i + 1, WINDOW)).alias("text"),
                               i.alias("at"))))))
    done = sortable.withColumn("n_repeat_words", _repeat_words())
    return done.select("doc_id", *(F.col(m).cast("long").alias(m) for m in MEASURES))


def ledger(docs: DataFrame) -> DataFrame:
    """``measure`` with ``failed``, the bits of all rules that the document fails."""
    bits = [F.when(F.expr(rule.fails), F.lit(BIT[rule.name])).otherwise(F.lit(0)).cast("long")
            for rule in RULES]
    failed = bits[0]
    for bit in bits[1:]:
        failed = failed.bitwiseOR(bit)
    return measure(docs).withColumn("failed", failed)


def write_ledger(docs: DataFrame) -> DataFrame:
    """The ledger, written to the shared folder: policies and ablations read it, not the texts."""
    return stored(ledger(docs), "rule-ledger")


def apply_policy(entries: DataFrame, mask: int) -> DataFrame:
    """Adds base_failed and kept; ``mask`` holds the rules of the policy."""
    return (entries.withColumn("base_failed", F.col("failed").bitwiseAND(F.lit(BASE)) != 0)
            .withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask | BASE)) == 0))


def ablation(entries: DataFrame, mask: int) -> DataFrame:
    """Per rule of the policy: rule, failing documents, and those no other rule would reject.

    Documents are first counted per mask of failures, of which there are 2^rules at most. An
    empty ledger gives zeros.
    """
    spark = entries.sparkSession
    sets = (entries.select(F.col("failed").bitwiseAND(F.lit(mask)).alias("bits"))
            .groupBy("bits").agg(F.count("*").alias("n")))
    rules = spark.createDataFrame([(r.name, BIT[r.name]) for r in RULES if mask & BIT[r.name]],
                                  "rule string, bit long")
    return (rules.join(F.broadcast(sets), F.col("bits").bitwiseAND(F.col("bit")) != 0, "left")
            .groupBy("rule").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("failing"),
                                 F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"),
                                                         F.col("n"))), F.lit(0))
                                 .alias("failing_alone")))


def keep_documents(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """The documents (all their columns) that the policy keeps; every row is judged by itself."""
    judged = docs.withColumn("doc_row", F.struct(*(F.col(f"`{c}`") for c in docs.columns)))
    # The condition names a column that is not deterministic, so that it is not pushed under the
    # measurements, which would then be evaluated again inside their own lambdas.
    entries = (apply_policy(ledger_of_rows(judged), POLICIES[version])
               .withColumn("place", F.monotonically_increasing_id()))
    return entries.where("kept AND place >= 0").select("doc_row.*")


def ledger_of_rows(judged: DataFrame) -> DataFrame:
    """A ledger whose ``doc_id`` is replaced by the whole row, so that no join is needed."""
    carried = judged.select(F.col("doc_row").alias("doc_id"), "text")
    return ledger(carried).withColumnRenamed("doc_id", "doc_row")


ORACLE = f"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '{WORD}') AS words,
             list_filter(string_split(coalesce(text, ''), chr(10)),
               lambda x: regexp_matches(x, '{WORD}')) AS lines
           FROM documents),
win AS (SELECT r, i, array_to_string(words[i:i + 7], ' ') AS g
        FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) > 8)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win)
        WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p) AS n
        FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM rep) GROUP BY r),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
        list_sum(list_transform(words, lambda x: length(x)))::BIGINT AS chars,
        (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
        (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g')))::BIGINT AS n_capitals,
        coalesce(list_sum(list_transform(range(2, len(words) + 1),
          lambda i: CASE WHEN words[i] = words[i - 1] THEN 1 ELSE 0 END)), 0)::BIGINT AS n_stutter
      FROM w LEFT JOIN cov ON w.r = cov.r),
b AS (SELECT *, coalesce(chars, 0)::BIGINT AS word_chars FROM m),
f AS (SELECT *,
        CASE WHEN n_words < 20 THEN 1 ELSE 0 END
        + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 10 * n_words THEN 4 ELSE 0 END
        + CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 16 ELSE 0 END
        + CASE WHEN 100 * n_capitals > 30 * word_chars THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_stutter > 20 * n_words THEN 64 ELSE 0 END AS failed FROM b)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failed::BIGINT AS failed, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM f
"""

#: Twin of ``ablation`` for the current policy, which has all rules.
ABLATION_ORACLE = f"""
WITH r(rule, bit) AS (VALUES {', '.join(f"('{name}', {bit}::BIGINT)" for name, bit in BIT.items())}),
q AS ({ORACLE})
SELECT rule, count(*) FILTER (WHERE failed & bit <> 0) AS failing,
  count(*) FILTER (WHERE failed = bit) AS failing_alone FROM r, q GROUP BY rule
"""
