"""Shards of near-equal bytes by histogram sort.

Rows are ordered by a key; the boundaries between shards are found by counting, over all
partitions, the exact bytes below candidate keys, and by putting the next candidates between the
two that enclose a boundary, until every boundary meets its tolerance. Only then are the rows
exchanged, once, each straight to its place.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm import checksum_sql
from churnspark.llm.common import stored

#: A shard is written in so many pieces at least, one task each, and more if they get too large.
PIECES = 4
PIECE_BYTES = 128 << 20
MOST_PIECES = 16_384
#: An inner boundary of a shard may miss its place by this share of a piece.
PIECE_TOLERANCE = 0.25
#: Candidate keys in one round of counting, over all open boundaries.
PROBES = 4096
#: Keys are pairs of 64-bit numbers; as one number, the second is counted from here.
LOW = -(1 << 63)
SPAN = 1 << 64

Key = tuple[int, int]


def _number(key: Key) -> int:
    return key[0] * SPAN + key[1] - LOW


def _key(number: int) -> Key:
    return number // SPAN, number % SPAN + LOW


@dataclass
class Histogram:
    """Bytes and rows of the keys between candidates, and the least and greatest key there."""

    size: list[int]
    rows: list[int]
    least: list[Key | None]
    most: list[Key | None]


def buckets_of(high: np.ndarray, low: np.ndarray, probes: Sequence[Key]) -> np.ndarray:
    """Number of probes at or below each key (high, low); probes ascend."""
    at_high = np.array([p[0] for p in probes], dtype=np.int64)
    at_low = np.array([p[1] for p in probes], dtype=np.int64)
    found = np.searchsorted(at_high, high, side="left")
    same = np.searchsorted(at_high, high, side="right") > found
    for value in np.unique(high[same]):
        first, last = (np.searchsorted(at_high, value, side=side) for side in ("left", "right"))
        rows = high == value
        found[rows] = first + np.searchsorted(at_low[first:last], low[rows], side="right")
    return found


def histogram(keys: DataFrame, probes: Sequence[Key]) -> Histogram:
    """Counts ``keys`` (high, low, size) between the probes; a task sends one row per bucket."""
    n = len(probes) + 1

    def run(batches):
        size, rows = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        ends: dict[int, list[Key]] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            high, low, own = (batch.column(i).to_numpy() for i in range(3))
            by = np.lexsort((low, high))
            high, low, own = high[by], low[by], own[by]
            bucket = buckets_of(high, low, probes)
            np.add.at(size, bucket, own)
            np.add.at(rows, bucket, 1)
            first = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
            last = np.concatenate((first[1:] - 1, [len(bucket) - 1]))
            for a, b in zip(first.tolist(), last.tolist(), strict=True):
                least, most = (int(high[a]), int(low[a])), (int(high[b]), int(low[b]))
                known = ends.setdefault(int(bucket[a]), [least, most])
                known[0], known[1] = min(known[0], least), max(known[1], most)
        found = sorted(ends)
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), pa.array(size[found], pa.int64()),
             pa.array(rows[found], pa.int64()),
             *(pa.array([ends[b][end][part] for b in found], pa.int64())
               for end in (0, 1) for part in (0, 1))],
            ["bucket", "size", "rows", "lh", "ll", "mh", "ml"])

    counted = (keys.select("high", "low", "size")
               .mapInArrow(run, "bucket int, size long, rows long, lh long, ll long, mh long, ml long")
               .groupBy("bucket").agg(F.sum("size").alias("size"), F.sum("rows").alias("rows"),
                                      F.min(F.struct("lh", "ll")).alias("least"),
                                      F.max(F.struct("mh", "ml")).alias("most")).collect())
    out = Histogram([0] * n, [0] * n, [None] * n, [None] * n)
    for row in counted:  # PROBES + 1 at most
        out.size[row.bucket], out.rows[row.bucket] = row.size, row.rows
        out.least[row.bucket], out.most[row.bucket] = tuple(row.least), tuple(row.most)
    return out


@dataclass
class Splitters:
    """``keys[i]`` is the first key of piece i + 1; ``rows`` and ``size`` count what lies below."""

    keys: list[Key] = field(default_factory=list)
    rows: list[int] = field(default_factory=list)
    size: list[int] = field(default_factory=list)
    total_rows: int = 0
    total_size: int = 0
    rounds: int = 0


def find_splitters(keys: DataFrame, parts: int, slack: Sequence[float],
                   most: int = PROBES) -> Splitters:
    """Splitters that cut all bytes into ``parts`` equal ones, each within its slack.

    ``slack`` is in bytes, one for each of the parts - 1 splitters; 0 asks for the smallest key
    below which its share of the bytes lies. Every round is one pass over ``keys``; it puts candidates evenly between the least and the greatest
    key of the rows that are still in question, so few rounds are needed wherever keys cluster.
    """
    whole = histogram(keys, [])
    out = Splitters(total_rows=whole.rows[0], total_size=whole.size[0])
    if not out.total_rows:
        return out
    wanted = [-(-i * out.total_size // parts) for i in range(1, parts)]
    settled: dict[int, tuple[Key, int, int]] = {}
    #: open boundaries: least and greatest key of the rows in question
    open_at = {i: (whole.least[0], whole.most[0]) for i in range(len(wanted))}
    while open_at:
        out.rounds += 1
        each = max(2, most // len(open_at))
        probes = set()
        for least, greatest in set(open_at.values()):
            a, b = _number(least), _number(greatest)
            asked = each * sum(v == (least, greatest) for v in open_at.values())
            probes.update((b - (b - a) * i // asked) for i in range(asked) if b > a)
            probes.add(b + 1)
        probes = [_key(p) for p in sorted(probes)]
        seen = histogram(keys, probes)
        size, rows = np.cumsum(seen.size).tolist(), np.cumsum(seen.rows).tolist()
        for i in list(open_at):
            # the first probe below which the share is reached, and the one before it
            at = bisect_left(size, wanted[i])
            near = min((at, max(at - 1, 0)), key=lambda j: abs(size[j] - wanted[i]))
            if slack[i] and abs(size[near] - wanted[i]) <= slack[i]:
                settled[i] = probes[near], rows[near], size[near]
            elif size[at] == wanted[i] or seen.least[at] == seen.most[at]:
                settled[i] = probes[at], rows[at], size[at]
            else:
                open_at[i] = seen.least[at], seen.most[at]
                continue
            del open_at[i]
    for i in range(len(wanted)):
        key, below, size = settled[i]
        out.keys.append(key)
        out.rows.append(below)
        out.size.append(size)
    return out


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def key_columns(text: Column, doc_id: Column) -> tuple[Column, Column]:
    """The sort key: 60 bits of the text's MD5, so that equal texts are neighbours in an order
    that says nothing about the source, then doc_id, nulls first."""
    high = F.conv(F.substring(F.md5(_text(text).cast("binary")), 1, 15), 16, 10).cast("long")
    return high, F.coalesce(doc_id.cast("long"), F.lit(LOW).cast("long"))


def size_of(text: Column) -> Column:
    return (F.octet_length(_text(text)) + 1).cast("long")


def _piece(high: Column, low: Column, splitters: Sequence[Key]) -> Column:
    """Number of splitters at or below the key: a binary search in two literal arrays."""
    if not splitters:
        return F.lit(0)
    highs = F.lit(np.array([k[0] for k in splitters], dtype=np.int64))
    lows = F.lit(np.array([k[1] for k in splitters], dtype=np.int64))
    n = len(splitters)
    bits = [1 << b for b in range(n.bit_length() - 1, -1, -1)]

    def step(found: Column, bit: Column) -> Column:
        at = found + bit - 1
        reached = (F.get(highs, at) < high) | (
            (F.get(highs, at) == high) & (F.get(lows, at) <= low))
        return F.when((at < n) & reached, found + bit).otherwise(found)

    return F.aggregate(F.array(*map(F.lit, bits)), F.lit(0), step)


def write_shards(docs: DataFrame, path: str, shards: int = 8, tolerance: float = 0.0) -> Splitters:
    """Writes ``docs`` to ``path``: shard (a folder each), slot, and the row as the struct ``doc``.

    The size of a row is the UTF-8 bytes of its text (null: none) plus 1. Rows are ordered by
    ``key_columns``; a boundary between shards is the first key below which its share of all bytes
    lies, or, with a tolerance (a share of one shard's bytes), any key within it. Sizes then differ
    by a row or the tolerance. ``slot`` counts the rows of a shard from 0 without a gap. Rows that
    agree in text and doc_id have one key and stay in one shard, in any order; null doc_ids
    come first among equal texts. An empty table gives an empty folder. Other columns, whatever
    their names, stay inside ``doc``. Rows are shuffled once.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    high, low = key_columns(F.col("doc.text"), F.col("doc.doc_id"))
    keys = stored(rows.select(high.alias("high"), low.alias("low"),
                              size_of(F.col("doc.text")).alias("size")), "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 0
    each = max(PIECES, min(MOST_PIECES // shards, -(-total // (shards * PIECE_BYTES))))
    n = shards * each
    found = find_splitters(
        keys, n,
        [PIECE_TOLERANCE * total / n if i % each else tolerance * total / shards
         for i in range(1, n)]) if total else Splitters()
    below = F.lit(np.array([0, *found.rows], dtype=np.int64))
    keyed = rows.select("doc", high.alias("high"), low.alias("low")).withColumn(
        "piece", _piece(F.col("high"), F.col("low"), found.keys))
    placed = keyed.withColumn("shard", F.floor(F.col("piece") / each).cast("int"))
    inside = Window.partitionBy("shard", "piece").orderBy("high", "low")
    slot = (F.get(below, F.col("piece")) - F.get(below, F.col("shard") * each)
            + F.row_number().over(inside) - 1)
    (placed.select("doc", slot.cast("long").alias("slot"), "shard")
     .write.partitionBy("shard").parquet(path))
    return found


def read_shards(spark: SparkSession, path: str, docs_schema: T.StructType) -> DataFrame:
    """The written rows: doc, slot, shard; a filter on shard reads its folder alone."""
    schema = T.StructType([T.StructField("doc", docs_schema), T.StructField("slot", T.LongType()),
                           T.StructField("shard", T.IntegerType())])
    return spark.read.schema(schema).parquet(path)


def digests(spark: SparkSession, path: str, docs_schema: T.StructType) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each written row."""
    text = F.col("doc.text")
    return read_shards(spark, path, docs_schema).select(
        F.col("doc.doc_id").alias("doc_id"), size_of(text).alias("size"),
        F.crc32(_text(text).cast("binary")).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


ORACLE = f"""
WITH {checksum_sql.TABLE},
d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
k AS (SELECT doc_id, t, octet_length(encode(t))::BIGINT + 1 AS size,
        ('0x' || substr(md5(t), 1, 15))::BIGINT AS high FROM d),
b AS (SELECT *, sum(size) OVER (ORDER BY high, doc_id NULLS FIRST
          RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        - sum(size) OVER (PARTITION BY high, doc_id) AS before, sum(size) OVER () AS total FROM k),
s AS (SELECT *, (8 * before // total)::INTEGER AS shard FROM b)
SELECT doc_id, size, {checksum_sql.crc32('t')}::BIGINT AS text_crc32, 'bytes' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY high, doc_id NULLS FIRST) - 1 AS slot,
  NULL::INTEGER AS grown_shard FROM s, crc_table
"""
