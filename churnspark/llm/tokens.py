"""Token ids through the tokenizers library, with a bounded store of ids per piece of text."""

from __future__ import annotations

import os
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space other than space, tab and line ends, or what some library takes for it: texts
#: that hold any are encoded whole.
ODD_SPACE = re.compile("[" + "".join(map(chr, (
    0x0B, 0x0C, *range(0x1C, 0x20), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028,
    0x2029, 0x202F, 0x205F, 0x2060, 0x3000, 0xFEFF))) + "]")
#: A run of white space with the run of other characters after it. Neither the pre-tokenizers
#: nor the merges of the vocabularies used here cross the start of such a run.
PIECE = re.compile(r"[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+")
SEPARATOR = "<|endoftext|>"
MARKS = frozenset(",.")
LATIN = "A-Za-z" + "".join(f"{chr(a)}-{chr(b)}" for a, b in (
    (0xC0, 0xD6), (0xD8, 0xF6), (0xF8, 0x12F), (0x132, 0x24F)))
#: One pre-token: Latin letters, which normal forms leave alone, after a space at most.
PLAIN = re.compile(f" ?[{LATIN}]+")
LATIN_LETTER = re.compile(f"[{LATIN}]")


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where it is printable,
    else the next letter after the first 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {b: chr(b) for b in printable}
    table.update((b, chr(256 + i)) for i, b in enumerate(sorted(set(range(256)) - table.keys())))
    return table
LONG_PIECE = 64
GROUP_BYTES = 4 << 20
PACK = [struct.Struct(f"<{n}I").pack for n in range(2 * LONG_PIECE + 1)]


def text_offsets(texts: pa.Array) -> np.ndarray:
    """Where each text of a string column without nulls starts in its buffer, and the last ends."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)
    return offsets[texts.offset:texts.offset + len(texts) + 1]


def text_groups(texts: pa.Array, limit: int = GROUP_BYTES) -> Iterator[tuple[int, int]]:
    """(first row, rows) of slices of about ``limit`` bytes, or of one longer text."""
    at, ends = 0, text_offsets(texts)[1:] if len(texts) else []
    while at < len(texts):
        start = int(ends[at - 1]) if at else int(text_offsets(texts)[0])
        to = max(at + 1, int(np.searchsorted(ends, start + limit, side="right")))
        yield at, to - at
        at = to


def strings(texts: pa.Array) -> list[str]:
    """The texts of a string column without nulls: as one text that is split, which is faster."""
    whole = pa.ListArray.from_arrays(pa.array([0, len(texts)], pa.int32()), texts)
    out = pc.binary_join(whole, "\0")[0].as_py().split("\0")
    return out if len(out) == len(texts) else texts.to_pylist()


class PieceEncoder:
    """Encodes texts piece by piece; every distinct piece goes to the library once per fill.

    ``drop_spaces``: the vocabulary ignores white space, so pieces are the plain words. The store
    is emptied when it holds ``limit`` pieces; results never depend on what it holds.
    """

    def __init__(self, path: str, drop_spaces: bool = False, limit: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.drop_spaces, self.limit = drop_spaces, limit
        self.known: dict[str, bytes] = {}

    def pieces(self, text: str) -> list[str]:
        if ODD_SPACE.search(text):
            return [text]
        return text.split() if self.drop_spaces else PIECE.findall(text)

    def piece_column(self, texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
        """All pieces of the texts in order, by distinct ones, and each text's first piece.

        Cut in the bytes: white space is a byte of its own there.
        """
        offsets = text_offsets(texts)
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        ends = (offsets - offsets[0]).astype(np.int64)
        space = (data == 32) | (data == 10) | (data == 9) | (data == 13)
        first = np.zeros(len(data), bool)
        first[1:] = space[1:] & ~space[:-1]
        whole = np.flatnonzero(pc.match_substring_regex(texts, ODD_SPACE.pattern)
                               .to_numpy(zero_copy_only=False))
        for text in whole:
            first[ends[text]:ends[text + 1]] = False
            space[ends[text]:ends[text + 1]] = False
        first[ends[:-1][ends[:-1] < ends[1:]]] = True
        starts = np.flatnonzero(first)
        at = np.searchsorted(starts, ends)
        if self.drop_spaces:
            starts = (np.cumsum(~space) - ~space)[starts]
            data = data[~space]
        cuts = np.append(starts, len(data)).astype(np.int32)
        found = pa.Array.from_buffers(pa.string(), len(starts), [
            None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(data))])
        return found.dictionary_encode(), at

    def encode_pieces(self, pieces: Iterable[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian unsigned 32-bit numbers.

        A single pre-token goes straight to the library's model, in the letters that it writes for
        bytes. Other pieces are sent many at a time with the special token between them, at which the library
        cuts a text before anything else; pieces that hold special strings go alone.
        """
        out, plain = {}, []
        tokenize, letters = self.model.tokenize, self.letters
        for piece in pieces:
            if PLAIN.fullmatch(piece) and len(piece) <= LONG_PIECE:
                text = piece.lower() if self.drop_spaces else piece
                if not text.isascii():
                    text = text.encode().decode("latin-1").translate(letters)
                elif text[0] == " ":
                    text = letters[32] + text[1:]
                ids = [t.id for t in tokenize(text)]
                out[piece] = PACK[len(ids)](*ids)
            elif "<|" in piece or len(piece) > 4096 or self.separator is None:
                ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
                out[piece] = np.asarray(ids, dtype="<u4").tobytes()
            else:
                plain.append(piece)
        for at in range(0, len(plain), 1000):
            some = plain[at:at + 1000]
            ids = np.asarray(self.tokenizer.encode_batch_fast(
                [SEPARATOR.join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
            cuts = np.flatnonzero(ids == self.separator)
            raw = ids.tobytes()
            starts = [0, *(4 * (cuts + 1)).tolist()]
            ends = [*(4 * cuts).tolist(), len(raw)]
            out.update((p, raw[a:b]) for p, a, b in zip(some, starts, ends, strict=True))
        return out

    def encode(self, texts: Iterable[str] | pa.Array) -> Iterator[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit numbers."""
        column = texts if isinstance(texts, pa.Array) else pa.array(list(texts), pa.string())
        if column.type != pa.string():
            column = column.cast(pa.string())
        for at, rows in text_groups(column):
            yield from self._joined(column.slice(at, rows))

    def _joined(self, texts: pa.Array) -> Iterator[bytes]:
        pieces, at = self.piece_column(texts)
        distinct = strings(pieces.dictionary)
        found = list(map(self.known.get, distinct))
        if None in found:
            self._fill(distinct, found)
        lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
        starts = np.cumsum(lengths) - lengths
        places = pieces.indices.to_numpy()
        each = lengths[places]
        ends = np.concatenate([[0], np.cumsum(each)])
        ids = np.repeat(starts[places] - ends[:-1], each)
        ids += np.arange(len(ids))
        raw = np.frombuffer(b"".join(found), "<u4")[ids].tobytes()
        cuts = (4 * ends[at]).tolist()
        for start, end in zip(cuts, cuts[1:]):
            yield raw[start:end]

    def _fill(self, pieces: list[str], found: list[bytes | None]) -> None:
        """Puts the ids of the pieces that the store does not hold into ``found`` and the store."""
        gaps = [i for i, ids in enumerate(found) if ids is None]
        if len(self.known) + len(gaps) > self.limit:
            self.known.clear()
        known, whole, ending, overlong = self.known, set(MARKS), [], []
        for i in gaps:
            piece = pieces[i]
            # A comma or full stop after a letter is always cut off by the library's split.
            if piece[-1:] in MARKS and LATIN_LETTER.match(piece[-2:-1]):
                ending.append(piece)
                whole.add(piece[:-1])
            else:
                whole.add(piece)
            if len(piece) > LONG_PIECE:
                overlong += piece, piece[:-1]
        known.update(self.encode_pieces([p for p in whole if p not in known]))
        for piece in ending:
            known[piece] = known[piece[:-1]] + known[piece[-1]]
        for i in gaps:
            found[i] = known[pieces[i]]
        for piece in overlong:
            known.pop(piece, None)


@lru_cache(maxsize=4)
def encoder(path: str, drop_spaces: bool = False) -> PieceEncoder:
    """One encoder per Python worker."""
    return PieceEncoder(path, drop_spaces)
