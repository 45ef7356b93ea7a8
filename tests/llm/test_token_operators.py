"""Encoding, ORC files and counts against plain calls of the libraries."""

import base64
import hashlib
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from churnspark.llm import bpe_codec, token_counts, token_orc
from churnspark.llm.common import scratch
from churnspark.llm.queries import BYTE_BPE, RANKS, WORD_BPE
from churnspark.llm.tokens import PieceEncoder, text_groups
from conftest_llm import ODD, tuples


def plain_tiktoken():
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("path,words", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_pieces_give_the_librarys_ids(path, words, documents):
    texts = [t or "" for t in ODD] + [r.text for r in documents.limit(60).collect()]
    own, library = PieceEncoder(path, words, limit=500), Tokenizer.from_file(path)
    want = [np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    assert list(own.encode(texts)) == want


def test_parts_are_encoded_like_the_whole(documents):
    codec = plain_tiktoken()
    for text in ["".join(r.text for r in documents.limit(20).collect()), "a  b\n\n c " * 999]:
        cut = list(bpe_codec.parts(text, 50))
        assert "".join(cut) == text and len(cut) > 10
        assert [i for p in cut for i in codec.encode_ordinary(p)] == codec.encode_ordinary(text)


def test_codec(odd_docs, no_docs):
    codec = plain_tiktoken()
    want = []
    for row in odd_docs.collect():
        ids = codec.encode_ordinary(row.text or "")
        want.append((row.doc_id, len(ids),
                     hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((row.text or "").encode()).hexdigest()))

    def run(docs):
        return bpe_codec.digests(bpe_codec.decode(
            bpe_codec.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN))
    assert tuples(run(odd_docs)) == sorted(want, key=repr)
    assert run(no_docs).count() == 0


def test_orc_round_trip(spark, odd_docs, no_docs, documents):
    library = Tokenizer.from_file(BYTE_BPE)
    for docs in (odd_docs, documents):
        path = scratch(spark, "test-orc")
        token_orc.write_tokens(docs.repartition(3), path, BYTE_BPE)
        got = sorted(token_orc.digests(spark, path).collect(), key=lambda r: r.start)
        ids = [library.encode(r.text or "", add_special_tokens=False).ids + [0]
               for r in docs.collect()]
        assert sorted((r.n_tokens, r.ids_crc32) for r in got) == sorted(
            (len(x), zlib.crc32(np.asarray(x, "<u4").tobytes())) for x in ids)
        keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
        assert keys == sorted(keys)
        ends = np.cumsum([0] + [r.n_tokens for r in got])
        assert [r.start for r in got] == ends[:-1].tolist()
    assert token_orc.lookup(spark, path, [5, 9]).count() == 2
    empty = scratch(spark, "test-orc")
    token_orc.write_tokens(no_docs, empty, BYTE_BPE)
    assert token_orc.digests(spark, empty).count() == 0


@pytest.mark.parametrize("head", [0, 50, 200_000])
def test_counts(odd_docs, no_docs, documents, head):
    library = Tokenizer.from_file(BYTE_BPE)
    for docs in (odd_docs, documents.limit(80)):
        docs = docs.cache()
        want = []
        for r in docs.collect():
            n = len(library.encode(r.text or "", add_special_tokens=False).ids)
            want.append((r.doc_id, len((r.text or "").encode()), n, n > 1024))
        got = token_counts.count_tokens(docs, BYTE_BPE, head_size=head)
        assert tuples(got) == sorted(want, key=repr)
    assert token_counts.count_tokens(no_docs, BYTE_BPE).count() == 0


def test_files_are_summed_up_by_number(spark, tmp_path):
    """As text, part-100000 comes before part-99999."""
    path = str(tmp_path / "orc")
    docs = spark.createDataFrame([(i, f"document {i} " * (i + 1)) for i in range(30)],
                                 "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "3")
    try:
        token_orc.write_tokens(docs, path, BYTE_BPE)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = tuples(token_orc.digests(spark, path))
    names = {"part-00001": "part-99999", "part-00002": "part-100000"}
    found = sorted(f for f in tmp_path.joinpath("orc").iterdir() if f.name.startswith("part-"))
    assert len(found) == 3
    for f in found:
        number = f.name[:10]
        if number in names:
            f.rename(f.with_name(names[number] + f.name[10:]))
    for crc in tmp_path.joinpath("orc").glob(".*.crc"):
        crc.unlink()
    got = tuples(token_orc.digests(spark, path))
    assert got == want
    ends = 0
    for _, start, n, _ in sorted(got):
        assert start == ends
        ends += n


@pytest.mark.parametrize("path,words", [(BYTE_BPE, False), (WORD_BPE, True)])
def test_blocks_of_texts_give_the_librarys_ids(path, words):
    """Columns are cut in their bytes: slices, empty texts, zeros, odd spaces, texts of no group."""
    texts = ["skipped", "", "a b. c,\n", " \t ", "x\0y \0", "naïve café 你好  .",
             "w" * 90 + ". " + "w" * 90, "", "\n\nA\r\n b", "one <|endoftext|> two", "end. "]
    own, library = PieceEncoder(path, words, limit=7), Tokenizer.from_file(path)
    want = [np.asarray(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
            for t in texts]
    column = pa.array(texts, pa.string()).slice(1)
    assert list(own.encode(column)) == list(own.encode(column.cast(pa.large_string()))) == want[1:]
    assert all(len(p) <= 64 for p in own.known)
    assert list(own.encode([])) == [] and list(own.encode(["", ""])) == [b"", b""]
    assert list(text_groups(column, 12)) == [(0, 3), (3, 1), (4, 1), (5, 1), (6, 2), (8, 1), (9, 1)]


def test_pieces_are_looked_up_once_a_block():
    own, seen = PieceEncoder(BYTE_BPE), []

    class Known(dict):
        def get(self, piece, default=None):
            seen.append(piece)
            return super().get(piece, default)
    own.known = Known()
    assert len(list(own.encode(["the same words again " * 500] * 20))) == 20
    assert len(seen) == len(set(seen))
