"""Token counts: pieces are counted once per distinct pre-token and summed per document."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import stored, texts_of
from churnspark.llm.tokens import encoder

#: Longer pre-tokens are rare and are counted where they stand instead of being exchanged.
LONGEST = 256
#: Pre-tokens whose counts are sent to every task: the most frequent ones, this many at most.
HEAD = 200_000
FLUSH = 400_000


def _pre_tokens(texts: DataFrame, tokenizer_path: str) -> DataFrame:
    """(piece, freq) over all documents, pre-aggregated in each task."""
    def run(batches):
        codec, counts = encoder(tokenizer_path), Counter()

        def rows():
            kept = [(p, n) for p, n in counts.items() if len(p) <= LONGEST]
            counts.clear()
            for at in range(0, len(kept), 50_000):
                some = kept[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in some], pa.string()),
                     pa.array([n for _, n in some], pa.int64())], ["piece", "freq"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(codec.pieces(text))
                if len(counts) > FLUSH:
                    yield from rows()
        yield from rows()

    return (texts.select("text").mapInArrow(run, "piece string, freq long")
            .groupBy("piece").agg(F.sum("freq").alias("freq")))


def _counted(pieces: DataFrame, tokenizer_path: str) -> DataFrame:
    """Adds ``tokens``, the library's number of ids for each pre-token."""
    def run(batches):
        codec = encoder(tokenizer_path)
        for batch in batches:
            names = batch.column(0).to_pylist()
            ids = codec.encode_pieces(names)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([len(ids[p]) // 4 for p in names], pa.int64())],
                ["piece", "freq", "tokens"])

    return pieces.mapInArrow(run, "piece string, freq long, tokens long")


def _document_parts(texts: DataFrame, tokenizer_path: str, head) -> DataFrame:
    """Per document one row with the tokens of frequent and of overlong pre-tokens (piece null),
    and one row with the frequency of every other pre-token."""
    def run(batches):
        codec, known = encoder(tokenizer_path), head.value
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                ids, hashes = some.column(0).to_pylist(), some.column(1).to_pylist()
                sizes = some.column(3).to_pylist()
                out = ([], [], [], [], [])
                for doc, h, text, size in zip(ids, hashes, some.column(2).to_pylist(), sizes,
                                              strict=True):
                    total, rest, overlong = 0, [], []
                    for piece, n in Counter(codec.pieces(text)).items():
                        tokens = known.get(piece)
                        if tokens is not None:
                            total += n * tokens
                        elif len(piece) <= LONGEST:
                            rest.append((piece, n))
                        else:
                            overlong.append((piece, n))
                    if overlong:
                        found = codec.encode_pieces(p for p, _ in overlong)
                        total += sum(n * (len(found[p]) // 4) for p, n in overlong)
                    for column, values in zip(out, (
                            [doc] * (1 + len(rest)), [h] * (1 + len(rest)),
                            [size] + [None] * len(rest), [None] + [p for p, _ in rest],
                            [total] + [n for _, n in rest]), strict=True):
                        column.extend(values)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()),
                     pa.array(out[2], pa.int64()), pa.array(out[3], pa.string()),
                     pa.array(out[4], pa.int64())], ["doc_id", "hash", "n_bytes", "piece", "n"])

    return (texts.select("doc_id", F.xxhash64("text").alias("hash"), "text",
                         F.octet_length("text").cast("long").alias("n_bytes"))
            .mapInArrow(run, "doc_id long, hash long, n_bytes long, piece string, n long"))


def _head(pieces: DataFrame, most: int) -> dict[str, int]:
    """Tokens of the most frequent short pre-tokens: as many whole bands of frequency as fit.

    Bands are sixteenths of a doubling, so there are about a thousand; their counts, not the
    pre-tokens, decide what is fetched.
    """
    short = pieces.where(F.length("piece") <= 64).withColumn(
        "band", F.floor(16 * F.log2("freq")).cast("int"))
    least, total = None, 0
    for row in sorted(short.groupBy("band").count().collect(), reverse=True):
        total += row["count"]
        if total > most:
            break
        least = row["band"]
    if least is None:
        return {}
    return {r.piece: r.tokens for r in short.where(F.col("band") >= least)
            .select("piece", "tokens").collect()}


def count_tokens(docs: DataFrame, tokenizer_path: str, limit: int = 1024,
                 head_size: int = HEAD) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text, without keeping ids.

    A pre-token is a run of white space with the run of other characters after it: the library
    never joins anything across its start. (A text with unusual white space is one pre-token.)
    Counts of the ``head_size`` most frequent ones are sent to all tasks; the others are joined.
    ``head_size`` changes the plan's cost, never a result. Null text: empty. Null doc_ids and
    repeated rows keep one row each (equal doc_id and text are summed together and divided).
    Other columns are ignored.
    """
    spark = docs.sparkSession
    texts = texts_of(docs)
    pieces = stored(_counted(_pre_tokens(texts, tokenizer_path), tokenizer_path), "pre-tokens")
    head = spark.sparkContext.broadcast(_head(pieces, head_size))
    parts = stored(_document_parts(texts, tokenizer_path, head), "document-pre-tokens")
    rest = (parts.where("piece IS NOT NULL").join(pieces.select("piece", "tokens"), "piece")
            .groupBy("doc_id", "hash").agg(F.sum(F.col("n") * F.col("tokens")).alias("n")))
    whole = parts.where("piece IS NULL")
    return (whole.select("doc_id", "hash", "n_bytes", "n", F.lit(1).alias("rows"))
            .unionByName(rest.withColumn("n_bytes", F.lit(None).cast("long"))
                         .withColumn("rows", F.lit(0)))
            .groupBy("doc_id", "hash").agg(F.max("n_bytes").alias("n_bytes"),
                                           F.sum("n").alias("n"), F.sum("rows").alias("rows"))
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("rows").cast("int"))))
            .select("doc_id", "n_bytes", (F.col("n") / F.col("rows")).cast("long")
                    .alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > limit))
