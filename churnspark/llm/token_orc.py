"""Token ids as ORC files in document order, with row indexes and Bloom filters."""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnspark.llm.common import texts_of
from churnspark.llm.tokens import encoder, text_groups

ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 32 << 20


def _arrays(raw: list[bytes]) -> pa.Array:
    values = np.frombuffer(b"".join(raw), dtype="<i4")
    offsets = np.zeros(len(raw) + 1, dtype=np.int32)
    np.cumsum([len(r) // 4 for r in raw], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 0) -> None:
    """Writes doc_id, n_tokens and ids (array of int) to ``path``, files and rows by doc_id.

    Every document gets ``end_id`` at its end; a null text has that id alone. Null doc_ids come
    first; rows with equal doc_ids stand in the order of a hash of their text, and any number of
    them may go to several files. An empty table gives an empty folder. The ids are integers in
    ORC's run-length encoding; doc_id has minima, maxima and a Bloom filter for every
    ``ROW_INDEX_STRIDE`` rows. Texts, not ids, are shuffled.
    """
    def run(batches):
        codec = encoder(tokenizer_path)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at, n_rows in text_groups(batch.column(1)):
                some = batch.slice(at, n_rows)
                raw = [ids + end for ids in codec.encode(some.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array([len(r) // 4 for r in raw], pa.int64()),
                     _arrays(raw)], ["doc_id", "n_tokens", "ids"])

    ordered = texts_of(docs).withColumn("tie", F.xxhash64("text"))
    (ordered.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids array<int>")
     .write.option("orc.bloom.filter.columns", "doc_id")
     .option("orc.row.index.stride", str(ROW_INDEX_STRIDE))
     .option("orc.stripe.size", str(STRIPE_BYTES)).option("compression", "zstd").orc(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The written rows; stripes are read in parallel, filters on doc_id skip row groups."""
    return (spark.read.schema("doc_id long, n_tokens long, ids array<int>").orc(path))


def lookup(spark: SparkSession, path: str, doc_ids: Sequence[int]) -> DataFrame:
    """The rows of some documents, found through the indexes and Bloom filters."""
    return read_tokens(spark, path).where(F.col("doc_id").isin(list(doc_ids)))


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids before the document in the files), n_tokens, ids_crc32, from the files.

    Within a split the running total is kept by the reading task; the totals of the splits, one
    row each, are summed up in file order and joined back.
    """
    def run(batches):
        place, total = None, 0
        for batch in batches:
            ids, file, block = batch.column(1), batch.column(2), batch.column(3)
            starts, counts, sums = [], [], []
            for row in range(batch.num_rows):
                here = (file[row].as_py(), block[row].as_py())
                if here != place:
                    place, total = here, 0
                values = ids[row].values.to_numpy().astype("<u4", copy=False)
                starts.append(total)
                counts.append(len(values))
                sums.append(zlib.crc32(values.tobytes()))
                total += len(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), file, block, pa.array(starts, pa.int64()),
                 pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                ["doc_id", "file", "block", "within", "n_tokens", "ids_crc32"])

    rows = read_tokens(spark, path)
    file, block = F.col("_metadata.file_name"), F.col("_metadata.file_block_start")
    each = rows.select("doc_id", "ids", file.alias("file"), block.alias("block")).mapInArrow(
        run, "doc_id long, file string, block long, within long, n_tokens long, ids_crc32 long")
    totals = (rows.select("n_tokens", file.alias("file"), block.alias("block"))
              .groupBy("file", "block").agg(F.sum("n_tokens").alias("total")))
    # Files are numbered part-0, part-1 ...; as text, part-100000 would come before part-99999.
    number = F.regexp_extract("file", r"part-(\d+)", 1).cast("long")
    before = Window.orderBy(number, "block").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("file", "block", F.coalesce(F.sum("total").over(before), F.lit(0))
                          .alias("base"))
    return each.join(bases, ["file", "block"]).select(
        "doc_id", (F.col("base") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")
