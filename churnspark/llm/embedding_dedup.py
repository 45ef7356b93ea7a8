"""Near-duplicate vectors through a pivot-permutation index.

A vector is described by its nearest pivots (reference vectors drawn from the table). Inverted
lists, one for each label and pivot, hold the vectors that name the pivot; two vectors of a list
are compared when they share enough pivots, and linked when their cosine is high enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.llm.common import stored
from churnspark.llm.components import components

MIN_COSINE = 0.93
NEAREST = 8
MIN_SHARED = 2
#: One pivot for so many distinct vectors, between the two bounds below.
PER_PIVOT = 64
PIVOTS = (64, 4096)
#: A pivot this close to an earlier one is dropped, so that a dense group does not hold many that
#: are all about equally near and are named by noise.
APART = 0.8
TILE = 1024


def _usable() -> str:
    return ("label IS NOT NULL AND vector IS NOT NULL AND "
            "forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) "
            "AND exists(vector, x -> x <> 0)")


def matrix(arrays: pa.Array, width: int | None = None) -> np.ndarray:
    """Rows of a list array as unit vectors, filled with zeros or cut to ``width``."""
    arrays = arrays.combine_chunks() if isinstance(arrays, pa.ChunkedArray) else arrays
    rows = [np.asarray(a.values, dtype=np.float64) for a in arrays]
    width = width or max((len(r) for r in rows), default=0)
    out = np.zeros((len(rows), width))
    for i, row in enumerate(rows):
        row = row[:width]
        out[i, :len(row)] = row / max(np.abs(row).max(initial=0.0), 1e-300)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.where(norms > 0, norms, 1.0)


def apart(units: np.ndarray) -> np.ndarray:
    """Places of the rows whose cosine with every earlier row that stays is below ``APART``."""
    free = np.ones(len(units), dtype=bool)
    kept = []
    for i in range(len(units)):
        if free[i]:
            kept.append(i)
            free &= units @ units[i] < APART
    return np.asarray(kept, dtype=np.int64)


def _described(nodes: DataFrame, n: int) -> tuple[DataFrame, int]:
    """Adds ``near``, the ids of the nearest pivots in order of distance; and the pivot count.

    The pivots are the distinct vectors of lowest hash, 4,096 at most, without those close to an
    earlier one: a bounded sample that does not depend on the order of rows. Every vector is
    described.
    """
    spark = nodes.sparkSession
    count = min(PIVOTS[1], max(PIVOTS[0], n // PER_PIVOT))
    chosen = [r.vector for r in nodes.orderBy("node").limit(count).select("vector").collect()]
    width = max(map(len, chosen))
    units = matrix(pa.array(chosen, pa.list_(pa.float64())), width)
    units = units[apart(units)].astype(np.float32)
    pivots = spark.sparkContext.broadcast(units)

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                some = batch.slice(at, 2000)
                close = matrix(some.column("vector"), width).astype(np.float32) @ pivots.value.T
                k = min(NEAREST, close.shape[1])
                near = np.argsort(-close, axis=1, kind="stable")[:, :k].astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(list(near), pa.list_(pa.int32()))],
                    [*some.schema.names, "near"])

    schema = ", ".join(f"{c} {t}" for c, t in nodes.dtypes)
    return nodes.mapInArrow(run, f"{schema}, near array<int>"), len(units)


def roots_of(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix the first row it is connected with."""
    n = len(linked)
    root = np.full(n, -1)
    for start in range(n):
        if root[start] < 0:
            frontier = np.array([start])
            root[start] = start
            while len(frontier):
                reached = linked[frontier].any(axis=0) & (root < 0)
                frontier = np.flatnonzero(reached)
                root[frontier] = start
    return root


def _tile_links(table: pa.Table, pivot: int, shared: int) -> Iterator[pa.RecordBatch]:
    """(node, weight, other) of one tile: linked vectors by weight, and one connected node.

    A pair belongs to the list of the smallest pivot it shares, and there to one tile, so it is
    counted once in all. Pivots are compared only among vectors that are near some other.
    """
    block = table.column("block").to_numpy()
    units = matrix(table.column("vector"))
    cosine = units @ units.T
    if block.min() != block.max():
        cosine[block[:, None] == block[None, :]] = -2
    np.fill_diagonal(cosine, -2)
    for i, j in np.argwhere(np.abs(cosine - MIN_COSINE) < 1e-12):
        cosine[i, j] = float((units[i] * units[j]).sum())
    linked = cosine >= MIN_COSINE
    some = np.flatnonzero(linked.any(axis=1))
    if not len(some):
        return
    nodes, weights = table.column("node").to_numpy()[some], table.column("copies").to_numpy()[some]
    near = [np.asarray(a.values) for a in table.column("near").take(pa.array(some))]
    names, flat = np.unique(np.concatenate(near), return_inverse=True)
    has = np.zeros((len(nodes), len(names)), dtype=np.float32)
    has[np.repeat(np.arange(len(nodes)), [len(a) for a in near]), flat.ravel()] = 1
    often = has.sum(axis=0) > 1
    has, names = has[:, often], names[often]
    before = has[:, names < pivot]
    linked = (linked[np.ix_(some, some)] & (has @ has.T >= shared) & (before @ before.T == 0))
    some = np.flatnonzero(linked.any(axis=1))
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[some]), pa.array((linked @ weights)[some].astype(np.int64)),
             pa.array(nodes[roots_of(linked)[some]])], ["node", "weight", "other"])


def _links(described: DataFrame, shared: int) -> DataFrame:
    """(node, weight, other) rows of all tiles of all inverted lists."""
    postings = described.withColumn("pivot", F.explode("near"))
    sizes = postings.groupBy("label", "width", "pivot").agg(F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / TILE).cast("int")
    tiles = (postings.join(sizes.where("members > 1"), ["label", "width", "pivot"])
             .withColumn("block", F.pmod("node", blocks.cast("long")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .withColumn("tile", F.xxhash64("label", "width", F.least("block", "other"),
                                            F.greatest("block", "other"))))

    def run(batches):
        rest = None
        for batch in batches:
            part = pa.Table.from_batches([batch])
            rest = part if rest is None else pa.concat_tables([rest, part])
            pivot, tile = rest.column("pivot").to_numpy(), rest.column("tile").to_numpy()
            cuts = [0, *(np.flatnonzero((pivot[1:] != pivot[:-1]) | (tile[1:] != tile[:-1]))
                         + 1).tolist()]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                yield from _tile_links(rest.slice(a, b - a), int(pivot[a]), shared)
            rest = rest.slice(cuts[-1]).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from _tile_links(rest, int(rest.column("pivot")[0].as_py()), shared)

    return (tiles.select("pivot", "tile", "node", "vector", "copies", "near", "block")
            .repartition("pivot", "tile").sortWithinPartitions("pivot", "tile")
            .mapInArrow(run, "node long, weight long, other long"))


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept of ``vectors(vec_id, embedding, label)``.

    Vectors of one label (not null) and one length are linked when their cosine in double
    precision is 0.93 or more and they share two of their eight nearest pivots (the only one if
    all vectors lie about a single pivot). Equal vectors are one node with a weight, so copies
    cost nothing, and count as linked. Vectors that are null, empty, zero, or hold nulls or
    numbers that are not finite have no links. Repeated rows and repeated or null vec_ids are
    vectors of their own; component_id is the smallest vec_id reached, null when all are null.
    Other columns are ignored.
    """
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>")
                          .alias("vector")).withColumn("usable", F.expr(_usable()))
    rows = rows.withColumn("node", F.when(F.col("usable"), F.xxhash64("label", "vector")))
    nodes = stored(rows.where("usable").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"),
        F.count("*").alias("copies"), F.min("vec_id").alias("low"))
        .withColumn("width", F.size("vector")), "vectors")
    n = nodes.count()
    if n == 0:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    described, pivots = _described(nodes.drop("low"), n)
    links = stored(_links(described, min(MIN_SHARED, pivots)), "vector-links")
    weights = links.groupBy("node").agg(F.sum("weight").alias("weight"))
    roots = components(links.select(F.col("node").alias("u"), F.col("other").alias("v")))
    known = (nodes.select("node", "copies", "low").join(weights, "node", "left")
             .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    known = stored(known, "vector-nodes")
    lowest = known.groupBy("root").agg(F.min("low").alias("component"))
    known = known.join(lowest, "root").select("node", "component", (
        F.coalesce("weight", F.lit(0)) + F.col("copies") - 1).alias("links"))
    return (rows.select("vec_id", "node", "usable").join(known, "node", "left")
            .select("vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("usable"), F.col("component")).otherwise(F.col("vec_id"))
                    .alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
