"""Removes byte passages that occur more than once, by suffix arrays over shards.

Strings of ``WIDTH`` bytes meet through their anchors (``suffix_arrays.anchors``). Runs of strings
that occur whole elsewhere are settled by their hash; what differs around a shared anchor goes to
shards, where a suffix array with common prefixes tells which strings recur. Anchors shared by
very many different runs are spread over several shards, whose sorted strings are merged by binary
search.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.common import stored, texts_of
from churnspark.llm.suffix_arrays import anchors, classes

WIDTH = 200
BLOCK_BYTES = 1 << 20
#: Runs around one anchor that a single shard takes: about a block of bytes.
SHARD_RUNS = 4096
SEEN = 200_000
RUN = "h long, c long, key long, lo int, hi int, place int, weight int"


def _keyed(docs: DataFrame) -> DataFrame:
    return texts_of(docs).select("doc_id", F.xxhash64("text").alias("key"), "text")


def _runs(texts: DataFrame, width: int) -> DataFrame:
    """Runs of strings with one anchor (weight 1 or 2), and spans already settled (weight 0).

    Runs that a batch of texts holds twice are repeats whatever else there is: their spans are
    noted at once, and one of them goes on with weight 2. So passages and copies that very many
    documents share reach the shuffle once per batch. A text is looked at once per task.
    """
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            keys, texts = [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 strict=True):
                if key not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    keys.append(key)
                    texts.append(text.encode())
            parts = list(anchors(texts, width))
            if not parts:
                continue
            text, lo, hi, place, h, c = (np.concatenate(x) for x in zip(*parts, strict=True))
            key = np.asarray(keys, dtype=np.int64)[text]
            order = np.lexsort((c, h))
            same = (h[order][1:] == h[order][:-1]) & (c[order][1:] == c[order][:-1])
            first = np.concatenate(([True], ~same))
            twice = np.concatenate((same, [False])) | ~first
            settled = np.zeros(len(h), dtype=bool)
            settled[order] = twice
            sent = np.zeros(len(h), dtype=bool)
            sent[order] = first
            weight = np.where(settled, 2, 1)
            columns = [h[sent].view(np.int64), c[sent].view(np.int64), key[sent], lo[sent],
                       hi[sent], place[sent], weight[sent]]
            t, a, b = text[settled], lo[settled], hi[settled] + width
            if len(t):  # neighbours of one text become one span
                new = np.concatenate(([True], (t[1:] != t[:-1]) | (a[1:] > b[:-1])))
                at = np.flatnonzero(new)
                ends = np.concatenate((at[1:], [len(t)])) - 1
                spans = key[settled][at]
                noise = (spans * 31 + a[at] * 1_000_003) ^ (spans >> 17)
                columns = [np.concatenate(x) for x in zip(columns, (
                    noise, noise, spans, a[at], b[ends], a[at], np.zeros(len(at), int)),
                    strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(x, pa.int64()) for x in columns[:3]),
                 *(pa.array(x.astype(np.int32)) for x in columns[3:])],
                ["h", "c", "key", "lo", "hi", "place", "weight"])

    return texts.select("key", "text").mapInArrow(run, RUN)


def _shared_runs(texts: DataFrame, width: int) -> DataFrame:
    """Runs whose anchor occurs elsewhere, with what is known of them; and settled spans."""
    one, run = Window.partitionBy("h"), Window.partitionBy("h", "c")
    rows = (_runs(texts, width).repartition("h")
            .dropDuplicates(["h", "c", "key", "lo", "weight"]))
    counted = (rows.withColumn("n_run", F.sum("weight").over(run))
               .withColumn("nth", F.row_number().over(run.orderBy("key", "lo")))
               .withColumn("n_anchor", F.sum("weight").over(one))
               .withColumn("mixed", F.min("c").over(one) < F.max("c").over(one)))
    return stored(counted.where("weight = 0 OR n_anchor > 1")
                  .select("h", "c", "key", "lo", "hi", "place", "weight", "n_run",
                          (F.col("mixed") & (F.col("nth") == 1) & (F.col("weight") > 0))
                          .alias("compare")), "shared-runs")


def _contexts(texts: DataFrame, runs: DataFrame, width: int) -> DataFrame:
    """The bytes of one run of each kind that has to be compared with others of its anchor."""
    kinds = runs.where("compare")
    sizes = kinds.groupBy("h").agg(F.count("*").alias("m"))
    salted = (kinds.join(sizes, "h").withColumn("salts", F.ceil(F.col("m") / SHARD_RUNS))
              .withColumn("salt", F.pmod("c", "salts").cast("int")))
    wanted = salted.groupBy("key").agg(F.collect_list(F.struct(
        "h", "c", "lo", "hi", F.col("n_run").cast("int").alias("n"), "salt",
        (F.col("salts") > 1).alias("split"))).alias("kinds"))

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for row in batch.to_pylist():
                if row["key"] in seen:
                    continue
                if len(seen) >= SEEN:
                    seen.clear()
                seen.add(row["key"])
                raw = row["text"].encode()
                out = row["kinds"]
                yield pa.RecordBatch.from_pylist(
                    [{**k, "key": row["key"], "bytes": raw[k["lo"]:k["hi"] + width]}
                     for k in out], schema=CONTEXT)

    return (texts.select("key", "text").join(wanted, "key").select("key", "text", "kinds")
            .mapInArrow(run, "h long, c long, key long, lo int, hi int, n int, salt int, "
                             "split boolean, bytes binary"))


CONTEXT = pa.schema([("h", pa.int64()), ("c", pa.int64()), ("key", pa.int64()),
                     ("lo", pa.int32()), ("hi", pa.int32()), ("n", pa.int32()),
                     ("salt", pa.int32()), ("split", pa.bool_()), ("bytes", pa.binary())])
FOUND = "key long, lo int, hi int, s1 long, s2 long, weight int"


def _compare_block(table: pa.Table, width: int) -> pa.RecordBatch | None:
    """Spans of repeats in one shard's block, and the strings of split anchors for the merge."""
    raw = table.column("bytes").to_pylist()
    lengths = np.array([len(r) for r in raw], dtype=np.int64)
    begins = np.cumsum(lengths) - lengths
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    kind = classes(data, begins, lengths, width)
    n, key, lo = (table.column(c).to_numpy() for c in ("n", "key", "lo"))
    split = np.asarray(table.column("split").to_pylist(), dtype=bool)
    starts = lengths - width + 1
    owner = np.repeat(np.arange(len(raw)), starts)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(starts) - starts, starts)
    kind = kind[begins[owner] + offset]
    _, kind = np.unique(kind, return_inverse=True)
    matched = np.bincount(kind, weights=n[owner])[kind] > 1
    # Neighbouring matched starts of one run become a span.
    hit = np.flatnonzero(matched & (n[owner] == 1))
    new = np.concatenate(([True], (np.diff(owner[hit]) != 0) | (np.diff(offset[hit]) != 1))) \
        if len(hit) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    ends = np.concatenate((at[1:], [len(hit)])) - 1 if len(at) else at
    columns = [key[owner[hit[at]]], lo[owner[hit[at]]] + offset[hit[at]],
               lo[owner[hit[at]]] + offset[hit[ends]] + width,
               np.zeros(len(at), int), np.zeros(len(at), int), np.zeros(len(at), int)]
    # One row for each kind of string at an anchor that several shards hold.
    _, one = np.unique(np.where(split[owner], kind, -1), return_index=True)
    one = one[split[owner[one]]]
    if len(one):
        digests = np.frombuffer(b"".join(
            hashlib.blake2b(raw[o][k:k + width], digest_size=16).digest()
            for o, k in zip(owner[one].tolist(), offset[one].tolist(), strict=True)),
            dtype="<i8").reshape(-1, 2)
        begin = lo[owner[one]] + offset[one]
        columns = [np.concatenate(x) for x in zip(columns, (
            key[owner[one]], begin, begin + width, digests[:, 0], digests[:, 1],
            np.where(matched[one], 2, 1)), strict=True)]
    if not len(columns[0]):
        return None
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array(x.astype(t.to_pandas_dtype())) for x, t in zip(columns, kinds, strict=True)],
        ["key", "lo", "hi", "s1", "s2", "weight"])


def _compared(contexts: DataFrame, width: int) -> DataFrame:
    def run_blocks(batches):
        rest: pa.Table | None = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
            while rest is not None:
                cut = cut_at(rest)
                if cut is None:
                    break
                found = _compare_block(rest.slice(0, cut), width)
                rest = rest.slice(cut)
                if found is not None:
                    yield found
        if rest is not None and rest.num_rows:
            found = _compare_block(rest, width)
            if found is not None:
                yield found

    def cut_at(table: pa.Table) -> int | None:
        """The end of the first whole anchors that fill a block."""
        size = np.cumsum([len(x) for x in table.column("bytes").to_pylist()])
        h, salt = table.column("h").to_numpy(), table.column("salt").to_numpy()
        ends = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1])) + 1
        full = ends[size[ends - 1] >= BLOCK_BYTES] if len(ends) else ends
        return int(full[0]) if len(full) else None

    return (contexts.repartition("h", "salt").dropDuplicates(["h", "salt", "c"])
            .sortWithinPartitions("h", "salt").mapInArrow(run_blocks, FOUND))


def _merged(strings: DataFrame) -> DataFrame:
    """Strings of split anchors that two shards hold: sorted runs, merged by binary search."""
    def run(batches):
        parts = [b for b in batches if b.num_rows]
        if not parts:
            return
        table = pa.Table.from_batches(parts)
        s1, s2 = table.column("s1").to_numpy(), table.column("s2").to_numpy()
        both = np.rec.fromarrays([s1, s2])
        names = np.unique(both)
        place = np.searchsorted(names, both)
        total = np.bincount(place, weights=table.column("weight").to_numpy())[place]
        found = table.filter(pa.array((total > 1) & (table.column("weight").to_numpy() == 1)))
        yield from found.select(["key", "lo", "hi"]).to_batches()

    return (strings.where("weight > 0").repartition("s1")
            .mapInArrow(run, "key long, lo int, hi int"))


def repeated_spans(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """(key, lo, hi): spans, which may overlap, of repeats in the text of that 64-bit hash."""
    texts = _keyed(docs)
    runs = _shared_runs(texts, width)
    settled = runs.where("weight = 0").select("key", "lo", "hi").union(
        runs.where("weight > 0 AND n_run > 1").select("key", "lo", F.col("hi") + width))
    found = stored(_compared(_contexts(texts, runs, width), width), "repeats")
    copies = (docs.select(F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
                          F.octet_length(F.coalesce("text", F.lit(""))).alias("hi"))
              .groupBy("key").agg(F.count("*").alias("n"), F.max("hi").alias("hi"))
              .where(f"n > 1 AND hi >= {width}")
              .select("key", F.lit(0).alias("lo"), "hi"))
    return (settled.union(found.where("weight = 0").select("key", "lo", "hi"))
            .union(_merged(found)).union(copies))


def _kept(raw: bytes, marks) -> tuple[bytes, int, int]:
    """What is left without the marked spans, the bytes they cover, and how many runs they are."""
    pieces, end, runs, removed = [], 0, 0, 0
    for lo, hi in sorted((m["lo"], m["hi"]) for m in marks or []):
        if not runs or lo > end:
            runs += 1
            pieces.append(raw[end:lo])
            removed += hi - lo
            end = hi
        elif hi > end:
            removed += hi - end
            end = hi
    pieces.append(raw[end:])
    return b"".join(pieces), removed, runs


def _spans_by_text(docs: DataFrame, width: int) -> DataFrame:
    return (repeated_spans(docs, width).groupBy("key")
            .agg(F.collect_list(F.struct("lo", "hi")).alias("spans")))


def cut_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary) of each document.

    A byte goes if any ``width``-byte string over it starts at another place too, in the same
    document or another. Null text: empty. Texts shorter than ``width`` stay whole. Null doc_ids
    and repeated rows keep one row each; equal texts are copies of each other. Other columns are
    ignored.
    """
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                raws = [t.encode() for t in some.column(1).to_pylist()]
                cut = [_kept(r, m) for r, m in zip(raws, some.column(2).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(r) for r in raws], pa.int64()),
                     pa.array([c[1] for c in cut], pa.int64()),
                     pa.array([c[2] for c in cut], pa.int64()),
                     pa.array([c[0] for c in cut], pa.binary())],
                    ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return (_keyed(docs).join(_spans_by_text(docs, width), "key", "left")
            .select("doc_id", "text", "spans")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                             "kept binary"))


def drop_repeats(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents, all columns, without repeated passages; n_chars follows if there is one.

    A character that a span cuts in two goes whole. Texts without repeats stay as they are.
    """
    def run(batches):
        for batch in batches:
            cut = [None if not marks else _kept(text.encode(), marks)[0].decode(errors="ignore")
                   for text, marks in zip(batch.column(1).to_pylist(),
                                          batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cut, pa.string())], ["doc", "cut"])

    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
    keyed = whole.withColumn("key", F.xxhash64(F.coalesce("doc.text", F.lit(""))))
    new = (keyed.join(_spans_by_text(docs, width), "key", "left")
           .select("doc", F.coalesce("doc.text", F.lit("")).alias("text"), "spans")
           .mapInArrow(run, T.StructType([whole.schema["doc"], T.StructField("cut", T.StringType())])))
    text = F.coalesce("cut", "doc.text")
    return new.select(*(
        text.alias(c) if c == "text"
        else F.length(text).cast(docs.schema[c].dataType).alias(c) if c == "n_chars"
        else F.col(f"doc.`{c}`").alias(c) for c in docs.columns))


def digests(cut: DataFrame) -> DataFrame:
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans",
                      F.sha2("kept", 256).alias("kept_sha256"))
