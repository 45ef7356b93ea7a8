"""Byte-level BPE encoding and decoding with the tiktoken library and a local rank file."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import texts_of

#: Between a character that is no white space and white space: no match of the split pattern
#: crosses such a place, and none looks beyond it.
SAFE_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")
PART_CHARS = 1 << 16


@lru_cache(maxsize=2)
def load(ranks_path: str, pattern: str):
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def parts(text: str, size: int = PART_CHARS):
    """Cuts a long text at safe places, at least ``size`` characters apart."""
    at = 0
    while len(text) - at > size:
        cut = SAFE_CUT.search(text, at + size)
        if cut is None:
            break
        yield text[at:cut.start()]
        at = cut.start()
    yield text[at:]


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every whole text.

    Null text: no ids. Null or repeated doc_ids and repeated rows: one row for each input row.
    Other columns are ignored. Texts of any length: cut at safe places before the library's
    split, so a part's ids equal the text's.
    """
    def run(batches):
        codec = load(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                ids = [[i for part in parts(t) for i in codec.encode_ordinary(part)]
                       for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Adds ``decoded`` (binary), the bytes of the ids; they need not be whole characters.

    Null ids: empty. Ids outside the vocabulary fail in the library.
    """
    def run(batches):
        codec = load(ranks_path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                some = batch.slice(at, 200)
                raw = [codec.decode_bytes(ids) if ids else b"" for ids in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(raw, pa.binary())], ["doc_id", "ids", "decoded"])

    return tokens.select("doc_id", "ids").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, and hashes of the ids (decimal, joined by a space) and of the bytes."""
    return decoded.select(
        "doc_id", F.size(F.coalesce("ids", F.array().cast("array<int>"))).cast("long")
        .alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
