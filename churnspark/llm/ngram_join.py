"""Jaccard self-join of word-shingle sets, found through R-trees of group counts.

A set is a point: the numbers of its shingles in 64 hash groups. Two sets share at most the sum
of the coordinate minima, so a tree whose nodes hold coordinate maxima discards subtrees that
cannot reach the overlap a link needs. The trees stand on shards: two linked sets always share a
rare shingle among those of lowest hash, so each such shingle is a shard and no pair is missed.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm.common import stored, texts_of
from churnspark.llm.components import components, merged
from churnspark.llm.shingles import shingle_sets

GROUPS = 64
#: A set with a larger count in some group has this in all: two such sets are not bounded.
MOST = 0xFFFF
UNBOUNDED = 1 << 58
LEAF = 32
#: Shards of more members are first joined through their smallest member (see ``join``).
STAR_ABOVE = 16
TILE = 2048
TILE_SHINGLES = 2_000_000
#: Hash groups of the second, finer bound within a tile.
FINE = 1024
#: Partners of a set that are looked at first, then, last of all in a tile.
BEST_FIRST = (4, 32, None)
SEEN = 200_000
#: Bits of a bitmap for each of its values, and in all.
BITS, MOST_BITS = 64, 1 << 27
#: Shingles of lowest hash that a set of n puts into shards, and how many of them two linked
#: sets share at least, whatever the other's size. Similarity 0.8: a link leaves out n / 5 of
#: either set at most, and the smaller set has 4 / 5 of the larger one's shingles at least.
REGION = "least(n, n div 5 + 1 + n div 16)"
SHARED = "(1 + ((4 * n + 4) div 5) div 16)"
#: The same of all shingles of a set.
WHOLE_SHARED = "((4 * n + 4) div 5)"


def region_size(n: int) -> int:
    return min(n, n // 5 + 1 + n // 16)


def group_counts(found: np.ndarray) -> np.ndarray:
    """Numbers of a set's shingles in the hash groups."""
    groups = np.bincount((found & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)
    if groups.max() > MOST:
        groups[:] = MOST
    return groups.astype("<u2")


def shared_at_most(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Summed coordinate minima of the rows of counts; unbounded where both are at the type's end."""
    bound = np.minimum(a, b).sum(axis=1, dtype=np.int64)
    return np.where(bound >= GROUPS * MOST, UNBOUNDED, bound)


def _points(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, id, n, region, counts) of each text; id names the set.

    ``region`` and ``counts`` stand in the first row of a set that a task meets, so that many
    copies do not multiply what is shuffled.
    """
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                some = batch.slice(at, 500)
                texts = [t.encode() for t in some.column(2).to_pylist()]
                ids, sizes, regions, counts = [], [], [], []
                for found in shingle_sets(texts):
                    name = int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=8)
                                          .digest(), "little", signed=True)
                    ids.append(name)
                    sizes.append(len(found))
                    if name in seen or not len(found):
                        regions.append(None)
                        counts.append(None)
                        continue
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(name)
                    regions.append(found[:region_size(len(found))].view(np.int64))
                    counts.append(group_counts(found).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(ids, pa.int64()),
                     pa.array(sizes, pa.int64()), pa.array(regions, pa.list_(pa.int64())),
                     pa.array(counts, pa.binary())],
                    ["doc_id", "text_hash", "id", "n", "region", "counts"])

    return (texts_of(docs).select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, id long, n long, region array<long>, "
                             "counts binary"))


def _recount(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("k", F.count("*").over(Window.partitionBy("h")))
            .where("k > 1"))


def _rarest(rows: DataFrame, shared: str) -> DataFrame:
    """(h, id, n, k): each set's rarest shingles of ``rows`` (h, id, n; no row twice), so many that
    two sets that share ``shared`` (an expression of n) of their shingles have one in common.

    Shingles nobody else has go, then sets that have fewer left than ``shared``, twice.
    """
    rows = stored(_recount(rows).select("h", "id", "n", "k"), "shared-shingles")
    of_set = Window.partitionBy("id")
    for _ in range(2):
        rows = rows.withColumn("c", F.count("*").over(of_set)).where(f"c >= {shared}")
        rows = stored(_recount(rows.select("h", "id", "n")).select("h", "id", "n", "k"),
                      "shared-shingles")
    ranked = (rows.withColumn("c", F.count("*").over(of_set))
              .withColumn("r", F.row_number().over(of_set.orderBy("k", "h"))))
    kept = ranked.where(f"c >= {shared} AND r <= c - {shared} + 1").select("h", "id", "n")
    return stored(_recount(kept), "shards")


def _shards(points: DataFrame) -> DataFrame:
    """(h, id, n): the rare shingles under which sets that may be linked meet.

    All sets put their shingles of lowest hash in; those nobody else has go, then sets that have
    fewer left than any link needs, twice. Of what is left, each set keeps its rarest shingles,
    as many as two linked sets cannot all differ in.
    """
    rows = (points.where("region IS NOT NULL").select("id", "n", F.explode("region").alias("h"))
            .repartition("h").dropDuplicates(["h", "id"]))
    return _rarest(rows, SHARED)


class CountTree:
    """R-tree over points of group counts, packed by size and then by a widest coordinate."""

    def __init__(self, sizes: np.ndarray, counts: np.ndarray):
        order = np.argsort(sizes, kind="stable")
        strip = LEAF * max(1, int(np.sqrt(len(sizes) / LEAF)))
        parts = []
        for at in range(0, len(order), strip):
            part = order[at:at + strip]
            widest = int(np.argmax(np.ptp(counts[part], axis=0)))
            parts.append(part[np.argsort(counts[part, widest], kind="stable")])
        self.order = np.concatenate(parts)
        self.sizes, self.counts = sizes[self.order], counts[self.order]
        starts = np.arange(0, len(self.order), LEAF)
        self.levels = [(np.maximum.reduceat(self.counts, starts, axis=0),
                        np.minimum.reduceat(self.sizes, starts))]
        while len(self.levels[-1][1]) > LEAF:
            boxes, least = self.levels[-1]
            starts = np.arange(0, len(least), LEAF)
            self.levels.append((np.maximum.reduceat(boxes, starts, axis=0),
                                np.minimum.reduceat(least, starts)))

    def reach(self, first: int, last: int) -> np.ndarray:
        """Places (in tree order, after ``first``) that some point of the leaf may link with."""
        top, least = self.counts[first:last].max(axis=0), self.sizes[first:last].min()
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            boxes, smallest = self.levels[depth]
            bound = shared_at_most(boxes[nodes], top)
            nodes = nodes[9 * bound >= 4 * (least + smallest[nodes])]
            below = len(self.levels[depth - 1][1]) if depth else len(self.sizes)
            nodes = (nodes[:, None] * LEAF + np.arange(LEAF)).ravel()
            nodes = nodes[nodes < below]
        return nodes[nodes > first]

    def pairs(self):
        """Two arrays of places (in the input's order): pairs that the bound cannot rule out."""
        for first in range(0, len(self.order), LEAF):
            last = min(first + LEAF, len(self.order))
            near = self.reach(first, last)
            for at in range(0, len(near), 1024):
                some = near[at:at + 1024]
                i = np.repeat(np.arange(first, last), len(some))
                j = np.tile(some, last - first)
                i, j = i[i < j], j[i < j]
                keep = within_bound(self.sizes, self.counts, i, j)
                yield self.order[i[keep]], self.order[j[keep]]


def within_bound(sizes: np.ndarray, counts: np.ndarray, i: np.ndarray,
                 j: np.ndarray) -> np.ndarray:
    """Whether the summed coordinate minima of the pairs reach the overlap of a link."""
    out = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 65_536):
        a, b = i[at:at + 65_536], j[at:at + 65_536]
        bound = shared_at_most(counts[a], counts[b])
        out[at:at + 65_536] = 9 * bound >= 4 * (sizes[a] + sizes[b])
    return out


def leaf_pairs(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all pairs inside consecutive groups of the given sizes, each within one leaf."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    places = np.arange(len(ends))
    left, right = [], []
    for step in range(1, int(sizes.max(initial=1))):
        i = places[places + step < ends]
        left.append(i)
        right.append(i + step)
    empty = [np.zeros(0, dtype=np.int64)]
    return np.concatenate(left or empty), np.concatenate(right or empty)


def _whole_shares(batches, keys: list[str]):
    """Tables of whole shards (rows of equal ``keys``), and where each in them begins and ends."""
    rest = None
    for batch in batches:
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part])
        key = [rest.column(k).to_numpy() for k in keys]
        cuts = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in key])) + 1
        if len(cuts):
            yield rest.slice(0, cuts[-1]), np.concatenate(([0], cuts))
            rest = rest.slice(cuts[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def possible_pairs(cuts: np.ndarray, ids: np.ndarray, sizes: np.ndarray, counts: np.ndarray,
                   wanted=lambda i, j: (i, j)) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted pairs within the shards that their trees let through."""
    members = np.diff(cuts)
    small = members <= LEAF  # trees of a single leaf, all at once
    rows = np.flatnonzero(np.repeat(small, members))
    i, j = leaf_pairs(members[small])
    i, j = wanted(rows[i], rows[j])
    low, high = np.minimum(ids[i], ids[j]), np.maximum(ids[i], ids[j])
    by = np.lexsort((high, low))
    new = np.concatenate((np.ones(min(1, len(by)), dtype=bool),
                          (np.diff(low[by]) != 0) | (np.diff(high[by]) != 0)))
    i, j = i[by[new]], j[by[new]]
    keep = within_bound(sizes, counts, i, j)
    found = [(i[keep], j[keep])]
    for a, b in zip(cuts[:-1][~small], cuts[1:][~small], strict=True):
        found += [wanted(a + x, a + y) for x, y in CountTree(sizes[a:b], counts[a:b]).pairs()]
    i, j = (np.concatenate(x) for x in zip(*found, strict=True))
    return i, j


def _tree_pairs(members: DataFrame) -> DataFrame:
    """Pairs (a < b) within each shard that the tree lets through."""
    def run(batches):
        for table, cuts in _whole_shares(batches, ["h"]):
            ids, sizes = table.column("id").to_numpy(), table.column("n").to_numpy()
            counts = np.frombuffer(b"".join(table.column("counts").to_pylist()),
                                   dtype="<u2").reshape(-1, GROUPS)
            i, j = possible_pairs(cuts, ids, sizes, counts)
            if len(i):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.minimum(ids[i], ids[j])), pa.array(np.maximum(ids[i], ids[j]))],
                    ["a", "b"])

    return (members.select("h", "id", "n", "counts").repartition("h").sortWithinPartitions("h")
            .mapInArrow(run, "a long, b long").distinct())


def nearest(i: np.ndarray, j: np.ndarray, score: np.ndarray, best: int | None) -> np.ndarray:
    """Which of the pairs are among the ``best`` of highest score for one of their ends."""
    if best is None or not len(i):
        return np.ones(len(i), dtype=bool)
    ends, pair = np.concatenate((i, j)), np.tile(np.arange(len(i)), 2)
    by = np.lexsort((pair, -score[pair], ends))
    first = np.concatenate(([True], np.diff(ends[by]) != 0))
    begin = np.maximum.accumulate(np.where(first, np.arange(len(by)), 0))
    keep = np.zeros(len(i), dtype=bool)
    keep[pair[by[np.arange(len(by)) - begin < best]]] = True
    return keep


def _finely_bounded(sets: list[np.ndarray], sizes: np.ndarray, i: np.ndarray,
                    j: np.ndarray) -> np.ndarray:
    """``within_bound`` over ``FINE`` groups: over few groups long sets have much in common."""
    used, place = np.unique(np.concatenate((i, j)), return_inverse=True)
    counts = np.zeros((len(used), FINE), dtype=np.uint16)
    for k, at in enumerate(used):
        groups = np.bincount((sets[at] & np.uint64(FINE - 1)).astype(np.int64), minlength=FINE)
        counts[k] = MOST if groups.max() >= MOST else groups
    out = np.zeros(len(i), dtype=bool)
    for at in range(0, len(i), 4096):
        a, b = place[:len(i)][at:at + 4096], place[len(i):][at:at + 4096]
        least = np.minimum(counts[a], counts[b])
        bound = least.sum(axis=1, dtype=np.int64)
        out[at:at + 4096] = ((9 * bound >= 4 * (sizes[i[at:at + 4096]] + sizes[j[at:at + 4096]]))
                             | (counts[a, 0] == MOST) | (counts[b, 0] == MOST))
    return out


def spanning_links(sets: list[np.ndarray], root: np.ndarray, i: np.ndarray, j: np.ndarray,
                   score: np.ndarray, tries=BEST_FIRST) -> list[int]:
    """Places of pairs that are links and connect all components that links among the pairs do.

    Members of one ``root`` are connected. Likely partners are looked at first, and no pair whose
    ends are connected by then.
    """
    _, label = np.unique(root, return_inverse=True)
    above = np.arange(label.max(initial=-1) + 1)

    def top(x):
        while above[x] != x:
            above[x] = x = above[above[x]]
        return x

    links, rest = [], np.arange(len(i))
    for best in tries:
        tops = np.array([top(x) for x in range(len(above))], dtype=np.int64)[label]
        rest = rest[tops[i[rest]] != tops[j[rest]]]
        chosen = nearest(i[rest], j[rest], score[rest], best)
        some, rest = rest[chosen], rest[~chosen]
        for at in some[np.argsort(-score[some], kind="stable")]:
            x, y = top(label[i[at]]), top(label[j[at]])
            if x == y:
                continue
            one, two = sorted((sets[i[at]], sets[j[at]]), key=len)
            place = two.searchsorted(one)
            place[place == len(two)] = 0
            if 9 * int((two[place] == one).sum()) >= 4 * (len(one) + len(two)):
                above[max(x, y)] = min(x, y)
                links.append(int(at))
    return links


def _tile_links(members: DataFrame) -> DataFrame:
    """Links (u, v) between members of the tiles that connect all of a tile that links connect.

    ``members`` have h, tile, block, id, n, root and shingles. Pairs of one root, and pairs of one
    block in a tile of two, are left out. Sets lie beside the tile's members, so no table of pairs
    is made and no set is sent for a pair.
    """
    tries = BEST_FIRST

    def run(batches):
        for table, cuts in _whole_shares(batches, ["h", "tile"]):
            ids, sizes, block, root, tile = (
                table.column(c).to_numpy() for c in ("id", "n", "block", "root", "tile"))
            column = table.column("shingles").combine_chunks()
            ends = column.offsets.to_numpy()
            flat = column.values.to_numpy().view(np.uint64)
            sets = [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
            counts = np.array([group_counts(found) for found in sets]).reshape(-1, GROUPS)
            mixed = tile // 65536 != tile % 65536

            def wanted(i, j):
                keep = (root[i] != root[j]) & (~mixed[i] | (block[i] != block[j]))
                return i[keep], j[keep]

            i, j = possible_pairs(cuts, ids, sizes, counts, wanted)
            keep = _finely_bounded(sets, sizes, i, j)
            i, j = i[keep], j[keep]
            score = np.concatenate([np.zeros(0)] + [
                shared_at_most(counts[i[k:k + 65_536]], counts[j[k:k + 65_536]])
                for k in range(0, len(i), 65_536)]) / (sizes[i] + sizes[j])
            found = spanning_links(sets, root, i, j, score, tries)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[i[found]]), pa.array(ids[j[found]])], ["u", "v"])

    return (members.select("h", "tile", "block", "id", "n", "root", "shingles")
            .repartition("h", "tile").sortWithinPartitions("h", "tile")
            .mapInArrow(run, "u long, v long").distinct())


def _among(rows: DataFrame, column: str, wanted: DataFrame) -> DataFrame:
    """The rows whose ``column``, a 64-bit hash, may be a value of ``wanted``'s only column.

    All rows with such a value stay; about one in ``BITS`` of the others does too. Tasks get a
    bitmap of the values, of 16 MB at most (beyond two million values, more other rows stay), so
    what is not asked for is not shuffled.
    """
    least = BITS * max(1, wanted.count())
    size = min(MOST_BITS, 1 << (least - 1).bit_length())
    place = F.pmod(F.col(column), F.lit(size).cast("long"))
    bits = (wanted.toDF(column)
            .select(F.bitmap_bucket_number(place).alias("piece"),
                    F.bitmap_bit_position(place).alias("bit"))
            .repartition("piece").groupBy("piece").agg(F.bitmap_construct_agg("bit").alias("bits")))
    byte = "cast(conv(hex(substring(bits, cast(bit div 8 AS int) + 1, 1)), 16, 10) AS int)"
    return (rows.withColumn("piece", F.bitmap_bucket_number(place))
            .withColumn("bit", F.bitmap_bit_position(place))
            .join(F.broadcast(bits), "piece")
            .where(f"getbit({byte}, cast(bit % 8 AS int)) = 1").select(*rows.columns))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(id, n, shingles) of the wanted text_hash, and of few others.

    Sets are made where the texts are read, and a task gives each once; texts are not shuffled.
    """
    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = list(shingle_sets([t.encode() for t in
                                           batch.slice(at, 500).column(0).to_pylist()]))
                names = [int.from_bytes(hashlib.blake2b(f.tobytes(), digest_size=8).digest(),
                                        "little", signed=True) for f in found]
                new = []
                for i, name in enumerate(names):
                    if name not in seen:
                        if len(seen) >= SEEN:
                            seen.clear()
                        seen.add(name)
                        new.append(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in new], pa.int64()),
                     pa.array([len(found[i]) for i in new], pa.int64()),
                     pa.array([found[i].view(np.int64) for i in new], pa.list_(pa.int64()))],
                    ["id", "n", "shingles"])

    texts = texts_of(docs).select(F.xxhash64("text").alias("text_hash"), "text")
    return (_among(texts, "text_hash", wanted).select("text")
            .mapInArrow(run, "id long, n long, shingles array<long>").dropDuplicates(["id"]))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets overlap enough, counted on the sets themselves."""
    one = _among(sets, "id", pairs.select("a")).select(
        F.col("id").alias("a"), F.col("n").alias("na"), F.col("shingles").alias("sa"))
    two = _among(sets, "id", pairs.select("b")).select(
        F.col("id").alias("b"), F.col("n").alias("nb"), F.col("shingles").alias("sb"))
    return (pairs.join(one, "a").join(two, "b")
            .where("9L * size(array_intersect(sa, sb)) >= 4L * (na + nb)").select("a", "b"))


def _spanning(pairs: DataFrame, roots: DataFrame | None, sets: DataFrame) -> DataFrame:
    """(node, root) of the components that the links among the pairs add to earlier ones.

    First one pair of each set is verified, with its smallest partner; then every other pair whose
    ends are not connected by then. Pairs inside a component need no check, so a group of near
    copies costs as many checks as it has members.
    """
    first = stored(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "first")
    known = merged(roots, _verified(first, sets).toDF("u", "v"))
    open_pairs = stored(pairs.join(known.toDF("a", "root_a"), "a", "left")
                        .join(known.toDF("b", "root_b"), "b", "left")
                        .where("root_a IS NULL OR root_b IS NULL OR root_a <> root_b")
                        .select("a", "b").join(first, ["a", "b"], "left_anti"), "open-pairs")
    return merged(known, _verified(open_pairs, sets).toDF("u", "v"))


def _whole_shards(large: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame:
    """Shards of all shingles of those sets that meet other components in large shards.

    A region is a quarter of a set, so a passage that many texts quote lets them meet there. A
    link takes four fifths of either set: of all shingles few sets have so many in common with
    others, and each needs to be found under the rarest fifth of them only. Two linked sets that
    are not connected yet share a large shard, hence both are among the sets here.
    """
    rooted = (large.select("h", "id").join(roots.toDF("id", "root"), "id", "left")
              .withColumn("root", F.coalesce("root", "id")))
    mixed = (rooted.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low <> high").select("h"))
    meeting = stored(rooted.join(mixed, "h", "left_semi").select("id").distinct(), "meeting")
    return _rarest(sets.join(meeting, "id", "left_semi")
                   .select("id", "n", F.explode("shingles").alias("h")), WHOLE_SHARED)


def _open_tiles(large: DataFrame, roots: DataFrame, sets: DataFrame) -> DataFrame | None:
    """Members of shards that hold several components, with their sets, dealt to tiles; null if
    no shard does.

    Shards that share a component are put together under one number ``h``, so a pair meets once
    however many shards it shares. Tiles are pairs of blocks of about ``TILE`` members, or fewer
    of ``TILE_SHINGLES`` shingles.
    """
    rooted = stored(large.select("h", "id", "n").join(roots.toDF("id", "root"), "id", "left")
                    .withColumn("root", F.coalesce("root", "id")), "rooted")
    mixed = (rooted.groupBy("h").agg(F.min("root").alias("u"), F.max("root").alias("high"))
             .where("u <> high").select("h", "u"))
    edges = stored(rooted.select("h", "root").distinct().join(mixed, "h")
                   .select("u", F.col("root").alias("v")).distinct(), "mixed")
    if edges.isEmpty():
        return None
    joined = components(edges, "mixed").toDF("root", "shard")
    members = stored(rooted.select("id", "n", "root").distinct().join(joined, "root")
                     .withColumnRenamed("shard", "h"), "members")
    blocks = F.ceil(F.greatest(F.col("m") / TILE, F.col("all") / TILE_SHINGLES)).cast("int")
    found = _among(sets, "id", members.select("id")).select("id", "shingles")
    return (members.join(members.groupBy("h").agg(F.count("*").alias("m"), F.sum("n").alias("all")),
                         "h")
            .withColumn("block", F.pmod(F.xxhash64("id"), blocks.cast("long")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("tile", F.least("block", "other").cast("long") * 65536
                        + F.greatest("block", "other"))
            .join(found, "id"))


@dataclass
class SetJoin:
    """members: doc_id, text_hash, id, n; roots: node, root of every set that is linked to another."""

    members: DataFrame
    roots: DataFrame


def join(docs: DataFrame) -> SetJoin:
    """Sets of 5-word shingles connected by links of Jaccard similarity 0.8 or more.

    Equal sets are one member ``id`` (a 64-bit hash of the set). Small shards give all pairs that
    their tree lets through; large ones first give the pairs with their smallest member. After
    these are verified, the sets that large shards hold of several components are put into shards
    by all their shingles, and these are searched by trees, in tiles, for links across components:
    first with each set's few likeliest partners, last with all that the bounds let through. Null
    texts, texts without words and empty tables have no links; null doc_ids and repeated rows are
    members like others. Other columns are ignored. No step holds a whole shard of unbounded size,
    and no pair list grows with the square of a group of near copies.
    """
    points = stored(_points(docs), "points")
    shards = _shards(points)
    wanted = (points.where("region IS NOT NULL").join(shards.select("id").distinct(), "id",
                                                      "left_semi"))
    one_each = stored(wanted.groupBy("id").agg(F.first("counts").alias("counts"),
                                               F.min("text_hash").alias("text_hash")), "wanted")
    sets = stored(_sets(docs, one_each.select("text_hash")), "sets")
    members = shards.join(one_each.select("id", "counts"), "id")
    small = _tree_pairs(members.where(F.col("k") <= STAR_ABOVE))
    large = shards.where(F.col("k") > STAR_ABOVE)
    stars = (large.join(large.groupBy("h").agg(F.min("id").alias("a")), "h")
             .where("a < id").select("a", F.col("id").alias("b")).distinct())
    roots = _spanning(stored(small.union(stars).distinct(), "pairs"), None, sets)
    tiles = _open_tiles(_whole_shards(large, roots, sets), roots, sets)
    if tiles is not None:
        roots = merged(roots, _tile_links(tiles))
    return SetJoin(points.select("doc_id", "text_hash", "id", "n"), roots)


def _rooted(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n, root of each row; the root names its component."""
    found = join(docs)
    return (found.members.join(found.roots.toDF("id", "root"), "id", "left")
            .withColumn("root", F.coalesce("root", "id")))


def groups(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id reachable by links.

    One row for each input row. A document without words is its own component; a component whose
    doc_ids are all null has a null component_id.
    """
    rooted = _rooted(docs)
    low = rooted.where("n > 0").groupBy("root").agg(F.min("doc_id").alias("low"))
    return rooted.join(low, "root", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("low")).otherwise(F.col("doc_id")).alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents, one row of each group: that of smallest doc_id, nulls last, and among rows
    of that doc_id of smallest text hash.

    Documents without words all stay. Only rows that a link or an equal set ties to the kept one
    leave: rows of one doc_id with other texts are judged alone. Of rows that share doc_id and
    text, one is kept.
    """
    rows = (_rooted(docs).where("n > 0").groupBy("root", "doc_id", "text_hash")
            .agg(F.count("*").alias("copies")))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("root").agg(F.min(place).alias("first"), F.sum("copies").alias("rows"))
    judged = stored(rows.join(first.where("rows > 1"), "root").select(
        "doc_id", "text_hash", place.eqNullSafe(F.col("first")).alias("stays"), "copies")
        .where("NOT stays OR copies > 1"), "judged")
    whole = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"),
                        F.xxhash64(F.coalesce("text", F.lit(""))).alias("hash"))
    same = (F.col("doc.doc_id").eqNullSafe(judged["doc_id"])
            & (F.col("hash") == judged["text_hash"]))
    alone = whole.join(judged, same, "left_anti")
    copies = whole.join(judged.where("stays"), same, "left_semi")
    one = (copies.select(F.col("doc.doc_id").alias("key"), "hash", "doc")
           .dropDuplicates(["key", "hash"]))
    return alone.select("doc.*").union(one.select("doc.*"))
