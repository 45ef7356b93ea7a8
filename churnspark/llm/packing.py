"""Packs token pieces into fixed-length sequences: best fit, then swap-based local search."""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import stored, texts_of
from churnspark.llm.tokens import encoder, text_groups

CAPACITY = 2048
BLOCK = 20_000
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, end_id: int = 0,
               with_ids: bool = False) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32.

    A document is its token ids and ``end_id`` (a null text has that id alone); only documents
    longer than ``capacity`` are cut, into full pieces and a rest. ``with_ids`` adds the ids
    themselves. Null and repeated doc_ids and repeated rows each give their own pieces.
    """
    def run(batches):
        codec = encoder(tokenizer_path, drop_spaces=True)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in batches:
            for at, n_rows in text_groups(batch.column(1)):
                some = batch.slice(at, n_rows)
                rows = ([], [], [], [], [], [])
                raws = codec.encode(some.column(1))
                for doc, raw in zip(some.column(0).to_pylist(), raws, strict=True):
                    raw += end
                    for n, start in enumerate(range(0, len(raw), 4 * capacity)):
                        ids = raw[start:start + 4 * capacity]
                        for column, value in zip(rows, (doc, n, start // 4, len(ids) // 4,
                                                        zlib.crc32(ids), ids), strict=True):
                            column.append(value)
                columns = [pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.int32()),
                           *(pa.array(r, pa.int64()) for r in rows[2:5])]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array([np.frombuffer(r, "<i4") for r in rows[5]],
                                            pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts_of(docs).mapInArrow(run, PIECES + (", ids array<int>" if with_ids else ""))


class Bins:
    """Items in bins of one capacity, with the sizes and bins of all items as arrays."""

    def __init__(self, sizes: np.ndarray, capacity: int):
        self.sizes, self.capacity = sizes.astype(np.int64), capacity
        self.bin_of = np.full(len(sizes), -1, dtype=np.int64)
        self.items: list[list[int]] = []
        self.space = np.zeros(0, dtype=np.int64)

    def best_fit(self) -> None:
        """Largest first, each into the fullest bin that has room for it."""
        by_space: dict[int, list[int]] = {}
        present, space = 0, []
        for item in np.argsort(-self.sizes, kind="stable").tolist():
            size = int(self.sizes[item])
            fitting = present >> size
            if fitting:
                room = size + (fitting & -fitting).bit_length() - 1
                place = by_space[room].pop()
                if not by_space[room]:
                    present &= ~(1 << room)
            else:
                place, room = len(self.items), self.capacity
                self.items.append([])
                space.append(room)
            self.items[place].append(item)
            self.bin_of[item] = place
            space[place] = room - size
            by_space.setdefault(room - size, []).append(place)
            present |= 1 << (room - size)
        self.space = np.asarray(space, dtype=np.int64)

    def move(self, item: int, to: int) -> None:
        old, size = int(self.bin_of[item]), int(self.sizes[item])
        self.items[old].remove(item)
        self.items[to].append(item)
        self.space[old] += size
        self.space[to] -= size
        self.bin_of[item] = to

    def improve(self, steps: float = math.inf) -> None:
        """Local search: empties the least filled bin after the other.

        A document moves to the bin it fills best; failing that, one or two documents are
        exchanged for one smaller document of a bin that has room for the difference. The other
        bin is never less full than the donor, so each step raises the sum of squared fills, and
        the search ends, when every bin with room was given up. The result is a packing at any
        point; ``steps`` can end it earlier.
        """
        least = -(-int(self.sizes.sum()) // self.capacity)
        given_up: set[int] = set()
        while steps > 0 and sum(map(bool, self.items)) > least:
            open_bins = [b for b in np.argsort(-self.space, kind="stable").tolist()
                         if self.items[b] and self.space[b] > 0 and b not in given_up]
            if not open_bins:
                break
            donor = open_bins[0]
            while self.items[donor] and steps > 0 and self._step(donor):
                steps -= 1
            steps -= 1
            if self.items[donor]:
                given_up.add(donor)

    def _step(self, donor: int) -> bool:
        mine = sorted(self.items[donor], key=lambda i: -self.sizes[i])
        other = np.flatnonzero((self.space > 0) & (self.space < self.capacity))
        other = other[(other != donor) & (self.space[other] <= self.space[donor])]
        if not len(other):
            return False
        for item in mine:  # move
            fits = other[self.space[other] >= self.sizes[item]]
            if len(fits):
                self.move(item, int(fits[np.argmin(self.space[fits])]))
                return True
        usable = np.zeros(len(self.space), dtype=bool)
        usable[other] = True
        theirs = np.flatnonzero(usable[self.bin_of])
        sizes, room = self.sizes[theirs], self.space[self.bin_of[theirs]]
        most = np.full(self.capacity + 1, -1, dtype=np.int64)
        np.maximum.at(most, sizes, room)
        # A group of size s goes for the smallest item whose size and room reach s together.
        reach = np.maximum.accumulate(np.where(most >= 0, most + np.arange(len(most)), -1))
        by_size: dict[int, list[int]] = {}
        for item in mine:
            by_size.setdefault(int(self.sizes[item]), []).append(item)
        kinds = list(by_size)  # 63 at most with a capacity of 2,048
        groups = [(by_size[x][0],) for x in kinds]
        groups += [(by_size[x][0], by_size[y][0]) for n, x in enumerate(kinds)
                   for y in kinds[n + 1:]]
        groups += [tuple(by_size[x][:2]) for x in kinds if len(by_size[x]) > 1]
        total = np.asarray([sum(int(self.sizes[i]) for i in g) for g in groups])
        partner = np.searchsorted(reach, total)
        gain = np.where(partner < len(reach), total - partner, 0)
        at = int(np.argmax(gain))
        if gain[at] <= 0:
            return False
        group, size = groups[at], int(partner[at])
        back = int(theirs[np.argmax((sizes == size) & (room == most[size]))])
        to = int(self.bin_of[back])
        self.move(back, donor)
        for item in group:
            self.move(item, to)
        return True


def pack_sizes(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Item numbers of each bin that is not empty."""
    bins = Bins(sizes, capacity)
    bins.best_fit()
    bins.improve()
    return [b for b in bins.items if b]


def place(pieces: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """Adds sequence_id and offset to the pieces (a stored table with a ``length``).

    Pieces are dealt in turn to blocks of about ``block`` rows, whatever their document or
    length; each block is packed by one task, so a block more costs half a sequence at most on
    average. No row is read by more than one task, and none depends on task order. Pieces longer
    than ``capacity`` are refused. An empty table stays empty.
    """
    names = pieces.columns
    blocks = max(1, -(-pieces.count() // block))

    def run(batches):
        task = TaskContext.get().partitionId()
        rows, done = list(batches), 0
        if not rows:
            return
        table = pa.Table.from_batches(rows)
        for at in range(0, table.num_rows, 2 * block):
            part = table.slice(at, 2 * block).combine_chunks()
            sizes = part.column("length").to_numpy()
            if len(sizes) and sizes.max() > capacity:
                raise ValueError("a piece is longer than a sequence")
            sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            for bin_items in pack_sizes(sizes, capacity):
                ends = np.cumsum(sizes[bin_items])
                offset[bin_items] = ends - sizes[bin_items]
                sequence[bin_items] = (task << 32) + done
                done += 1
            yield from (part.append_column("sequence_id", pa.array(sequence))
                        .append_column("offset", pa.array(offset)).to_batches())

    schema = ", ".join(f"`{n}` {t}" for n, t in pieces.dtypes)
    return (pieces.select(*names).repartition(blocks)
            .mapInArrow(run, f"{schema}, sequence_id long, offset long"))


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Places of all pieces of all documents; see ``cut_pieces`` and ``place``."""
    return place(stored(cut_pieces(docs, tokenizer_path, capacity), "pieces"), capacity)


def sequences(pieces: DataFrame, placed: DataFrame) -> DataFrame:
    """sequence_id and the sequence's ids; ``pieces`` come from ``cut_pieces(with_ids=True)``.

    Joined by document and piece, so doc_ids must be unique and not null here. A sequence holds
    ``capacity`` ids at most.
    """
    return (pieces.select("doc_id", "piece", "ids")
            .join(placed.select("doc_id", "piece", "sequence_id", "offset"), ["doc_id", "piece"])
            .groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids")))
                                        .alias("parts"))
            .select("sequence_id", F.flatten("parts.ids").alias("ids")))
