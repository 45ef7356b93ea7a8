"""Many trees with row draws of their own, grown in a few Spark jobs for all of them together.

A node with more rows than a task should hold is split by histograms that tasks sum up, one job a
level for all trees. The rows of a smaller node are sent to one task, which grows the rest of that
tree by the same histograms. So no task holds more than ``TASK_CELLS`` feature values of a node,
whatever the table's size, and the number of jobs does not depend on the number of trees.

Splits follow Spark ML's forest: at most 32 bins a feature, Gini impurity, ceil(sqrt(features))
features a node, leaves of a least number of rows, sibling leaves of one prediction merged. Grown
trees are stored as arrays, one row a tree. A forest of few nodes is written as Spark ML stores one
and read back as its model, which lies on the driver whole; a larger one stays in its files
(``StoredForest``) and rows are sent to the trees.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from uuid import uuid4

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnspark.operators.trees import POISSON, node_table, spread
from churnspark.session import cut_lineage, shared_folder

BINS = 32
TASK_CELLS = 16_000_000  # feature values of one node in one task
SHUFFLE_BYTES = 64_000_000  # of one task that grows trees
LEAST_GAIN = 1e-12
NODES_AT_ONCE = 512

DRIVER_NODES = 200_000  # of a forest that is read as Spark ML's model
GROUP_NODES = 1_000_000  # of the trees that a task sends rows through

#: Arrays of a tree's nodes, numbered left first: a left child follows its parent, -1 as right
#: child marks a leaf.
ARRAYS = {"right": "<i4", "feature": "<i4", "bin": "u1", "w0": "<f8", "w1": "<f8", "n": "<i8",
          "gain": "<f8"}
PACKED = "tree int, size long, " + ", ".join(f"{c} binary" for c in ARRAYS)
PIECES = PACKED + ", root long, inner boolean, m0 double, m1 double"


def bin_bounds(table: DataFrame, width: int) -> list[np.ndarray]:
    """Ascending thresholds for each place of ``features``; a row belongs to the first bin whose
    threshold is not below its value. Midpoints of at most 32 values, else quantiles of all rows."""
    def values(batches):
        seen = [np.empty(0)] * width
        for batch in batches:
            x = batch.column(0).flatten().to_numpy().reshape(-1, width)
            # one value more than bins is enough to know that there are more
            seen = [np.unique(np.concatenate([s, x[:, i]]))[:BINS + 1] for i, s in enumerate(seen)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(width), pa.int32()), pa.array([s.tolist() for s in seen])],
            ["at", "seen"])

    x = vector_to_array("features")
    found = (table.select(x.alias("x")).mapInArrow(values, "at int, seen array<double>")
             .groupBy("at").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("seen"))))
                                .alias("seen"))
             .select("at", F.slice("seen", 1, BINS + 1).alias("seen")).collect())
    bounds = [np.empty(0)] * width
    many = []
    for r in found:  # one row a feature
        if len(r.seen) > BINS:
            many.append(r.at)
        else:
            v = np.array(r.seen)
            bounds[r.at] = (v[1:] + v[:-1]) / 2
    if many:
        cuts = [i / BINS for i in range(1, BINS)]
        each = table.select(x.alias("x")).select(*[F.get("x", F.lit(i)).alias(f"x{i}")
                                                   for i in many])
        row = each.agg(*[F.percentile_approx(f"x{i}", cuts).alias(f"x{i}") for i in many]).first()
        for i in many:
            bounds[i] = np.unique(row[f"x{i}"])
    return bounds


def bins_of(x: np.ndarray, bounds: Sequence[np.ndarray]) -> np.ndarray:
    """The bin of each value, a byte; ``x`` has a column for each of ``bounds``."""
    out = np.empty(x.shape, np.uint8)
    for i, b in enumerate(bounds):
        out[:, i] = np.searchsorted(b, x[:, i], side="left")
    return out


def draws_of(seed: int, tree: int, keys: Sequence[bytes]) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson, from a hash of seed, tree and key."""
    begun = hashlib.md5(f"forest{seed}:{tree}:".encode())
    digits = []
    for key in keys:
        whole = begun.copy()
        whole.update(key)
        digits.append(whole.digest()[:4])
    return np.searchsorted(np.array(POISSON), np.frombuffer(b"".join(digits), ">u4") / 2 ** 32,
                           side="right").astype(np.uint8)


def binned_rows(table: DataFrame, label: str, key: str, bounds: Sequence[np.ndarray], n_trees: int,
                seed: int, bootstrap: bool) -> DataFrame:
    """y, ``bins`` (a byte a feature) and ``drawn`` (a byte a tree: how often it draws the row)."""
    width = len(bounds)

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            bins = bins_of(batch.column(2).flatten().to_numpy().reshape(n, width), bounds)
            drawn = np.ones((n, n_trees), np.uint8)
            if bootstrap:
                keys = [k.encode() for k in batch.column(0).to_pylist()]
                for t in range(n_trees):
                    drawn[:, t] = draws_of(seed, t, keys)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array([r.tobytes() for r in bins], pa.binary()),
                 pa.array([r.tobytes() for r in drawn], pa.binary())], ["y", "bins", "drawn"])

    return table.select(F.col(key).cast("string"), F.col(label).cast("int"),
                        vector_to_array("features")).mapInArrow(
        run, "y int, bins binary, drawn binary")


def _bytes(column: pa.Array, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(n, -1)


def draw_totals(rows: DataFrame, n_trees: int) -> dict[int, tuple[np.ndarray, int]]:
    """Draws by class and rows of each tree that drew any."""
    def run(batches):
        draws, count = np.zeros((n_trees, 2), np.int64), np.zeros(n_trees, np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy()
            drawn = _bytes(batch.column(1), batch.num_rows)
            for c in (0, 1):
                draws[:, c] += drawn[y == c].sum(axis=0, dtype=np.int64)
            count += (drawn > 0).sum(axis=0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(n_trees), pa.int32()), pa.array(draws[:, 0]),
             pa.array(draws[:, 1]), pa.array(count)], ["tree", "d0", "d1", "n"])

    found = rows.select("y", "drawn").mapInArrow(run, "tree int, d0 long, d1 long, n long") \
        .groupBy("tree").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "n")]).collect()
    return {r.tree: (np.array([r.d0, r.d1]), r.n) for r in found if r.n}  # one row a tree


# ---- splits -----------------------------------------------------------------------------------

def _node_features(seed: int, tree: int, root: int, nodes: int, width: int,
                   level: int = 0) -> np.ndarray:
    """Places of ceil(sqrt(width)) features for each of ``nodes`` nodes below ``root``."""
    chance = np.random.default_rng([seed, tree, root, level]).random((nodes, width))
    take = math.ceil(math.sqrt(width))
    return np.argpartition(chance, take - 1, axis=1)[:, :take]


def _histograms(bins, y, drawn, node, features) -> np.ndarray:
    """Draws of class 0, of class 1 and rows: (features a node, nodes, bins, 3)."""
    nodes, take = features.shape
    out = np.empty((take, nodes, BINS, 3), np.int64)
    at = np.arange(len(node))
    for j in range(take):
        cell = node * BINS + bins[at, features[node, j]]
        one = np.bincount(cell, drawn * y, nodes * BINS)
        out[j, :, :, 0] = (np.bincount(cell, drawn, nodes * BINS) - one).reshape(nodes, BINS)
        out[j, :, :, 1] = one.reshape(nodes, BINS)
        out[j, :, :, 2] = np.bincount(cell, minlength=nodes * BINS).reshape(nodes, BINS)
    return out


def _best_splits(hist: np.ndarray, weights: np.ndarray, leaf: int):
    """Per node: slot of the feature, last bin of the left child, gain, rows of the left child."""
    left = hist.cumsum(axis=2)
    whole, left = left[:, :, -1:], left[:, :, :-1]
    a, b = left[..., :2] * weights, (whole - left)[..., :2] * weights
    p = whole[0, :, 0, :2] * weights
    mass = p.sum(axis=1)

    def purity(w, total):  # sum of squared class weights over the weight
        return np.divide((w ** 2).sum(axis=-1), total, out=np.zeros(total.shape), where=total > 0)

    gain = (purity(a, a.sum(axis=-1)) + purity(b, b.sum(axis=-1))
            - purity(p, mass)[None, :, None]) / np.maximum(mass, 1e-300)[None, :, None]
    few = (left[..., 2] < leaf) | ((whole - left)[..., 2] < leaf)
    gain = np.where(few, -1.0, gain)
    flat = gain.transpose(1, 0, 2).reshape(gain.shape[1], -1)
    best = flat.argmax(axis=1)
    slot, cut = np.divmod(best, BINS - 1)
    at = np.arange(len(best))
    return slot, cut, flat[at, best], left[slot, at, cut, 2]


def _splits(bins, y, drawn, node, features, weights, leaf: int):
    """Slot of the feature, last bin of the left child and gain of every node, some nodes at a time:
    their histograms are many times larger than the few rows of a small node."""
    order = np.argsort(node, kind="stable")
    begins = np.arange(0, len(features), NODES_AT_ONCE)
    edges = np.searchsorted(node[order], np.append(begins, len(features)))
    parts = []
    for begin, a, b in zip(begins, edges[:-1], edges[1:], strict=True):
        own, some = order[a:b], features[begin:begin + NODES_AT_ONCE]
        parts.append(_best_splits(_histograms(bins[own], y[own], drawn[own], node[own] - begin,
                                              some), weights, leaf)[:3])
    return [np.concatenate(x) for x in zip(*parts, strict=True)]


def _grow(bins, y, drawn, weights, depth: int, leaf: int, seed: int, tree: int, root: int):
    """Nodes of one subtree of at most ``depth`` levels of splits, numbered left first."""
    width = bins.shape[1]
    node, levels, start = np.zeros(len(y), np.int64), [], 0
    nodes = 1
    while nodes:
        draws1 = np.bincount(node, drawn * y, nodes)
        w0 = (np.bincount(node, drawn, nodes) - draws1) * weights[0]
        level = {"w0": w0, "w1": draws1 * weights[1], "n": np.bincount(node, minlength=nodes),
                 "feature": np.full(nodes, -1), "bin": np.full(nodes, -1),
                 "gain": np.full(nodes, -1.0), "left": np.full(nodes, -1)}
        levels.append(level)
        # a node can split if both classes are in it and two leaves' rows
        open_ = (level["w0"] > 0) & (level["w1"] > 0) & (level["n"] >= 2 * leaf)
        if len(levels) > depth or not open_.any():
            break
        place = np.cumsum(open_) - 1
        keep = open_[node]
        bins, y, drawn, node = bins[keep], y[keep], drawn[keep], place[node[keep]]
        ids = np.flatnonzero(open_)
        features = _node_features(seed, tree, root, len(ids), width, len(levels))
        slot, cut, gain = _splits(bins, y, drawn, node, features, weights, leaf)
        good = gain > LEAST_GAIN
        chosen = features[np.arange(len(ids)), slot]
        at = ids[good]
        level["feature"][at], level["bin"][at], level["gain"][at] = \
            chosen[good], cut[good], gain[good]
        level["left"][at] = 2 * np.arange(len(at))
        keep = good[node]
        bins, y, drawn, node = bins[keep], y[keep], drawn[keep], node[keep]
        right = bins[np.arange(len(y)), chosen[node]] > cut[node]
        node = 2 * (np.cumsum(good) - 1)[node] + right
        nodes = 2 * len(at)
    return _numbered(levels)


def _numbered(levels: list[dict]) -> dict[str, np.ndarray]:
    """Nodes of all levels in left-first order, after equal sibling leaves were merged."""
    size = None
    for i in range(len(levels) - 1, -1, -1):
        level = levels[i]
        left = level["left"]
        inner = left >= 0
        own = np.ones(len(left), np.int64)
        if inner.any():
            below, l = levels[i + 1], left[inner]
            says = below["w1"] > below["w0"]
            same = (below["left"][l] < 0) & (below["left"][l + 1] < 0) & (says[l] == says[l + 1])
            gone = np.flatnonzero(inner)[same]
            for name in ("left", "feature", "bin", "gain"):
                level[name][gone] = -1
            inner = left >= 0
            own[inner] += size[left[inner]] + size[left[inner] + 1]
        level["size"] = size = own
    out = {k: [] for k in ("id", "right", "feature", "bin", "gain", "w0", "w1", "n")}
    kept, ids = np.array([0]), np.array([0])
    for i, level in enumerate(levels):
        left = level["left"][kept]
        inner = left >= 0
        after = np.full(len(kept), -1)
        if inner.any():
            after[inner] = ids[inner] + 1 + levels[i + 1]["size"][left[inner]]
        for k, v in (("id", ids), ("right", after)):
            out[k].append(v)
        for k in ("feature", "bin", "gain", "w0", "w1", "n"):
            out[k].append(level[k][kept])
        kept = np.concatenate([left[inner], left[inner] + 1])
        ids = np.concatenate([ids[inner] + 1, after[inner]])
        if not len(kept):
            break
    order = np.argsort(np.concatenate(out.pop("id")))
    return {k: np.concatenate(v)[order] for k, v in out.items()}


def _nodes_of(bins, splits: Sequence[tuple]) -> np.ndarray:
    """Heap number of the node that each row reaches by the splits of the top, parents first."""
    node = np.ones(len(bins), np.int64)
    for at, feature, cut in splits:
        here = np.flatnonzero(node == at)
        node[here] = 2 * at + (bins[here, feature] > cut)
    return node


# ---- growing ----------------------------------------------------------------------------------

def _grow_top(rows: DataFrame, totals: Mapping, weights: Mapping, width: int, depth: int, leaf: int,
              seed: int, task_rows: int) -> tuple[dict, dict]:
    """Splits of the nodes of more than ``task_rows`` rows, and such nodes that cannot be split:
    per tree, heap number -> (feature, bin, gain, w0, w1, n); -1 as feature marks a leaf."""
    top: dict[int, dict[int, tuple]] = {t: {} for t in totals}
    large = {(t, 1) for t, (_, n) in totals.items() if n > task_rows}
    while large:
        wanted: dict[int, list[int]] = {}
        for t, at in sorted(large):
            wanted.setdefault(t, []).append(at)
        splits = {t: [(at, *s[:2]) for at, s in sorted(top[t].items()) if s[0] >= 0]
                  for t in wanted}

        def count(batches):
            sums = {t: 0 for t in wanted}
            features = {t: np.concatenate([_node_features(seed, t, at, 1, width) for at in ats])
                        for t, ats in wanted.items()}
            for batch in batches:
                y = batch.column(0).to_numpy()
                bins = _bytes(batch.column(1), len(y))
                drawn = _bytes(batch.column(2), len(y))
                for t, ats in wanted.items():
                    mine = np.flatnonzero(drawn[:, t])
                    node = _nodes_of(bins[mine], splits[t])
                    place = np.searchsorted(ats, node)
                    place[place == len(ats)] = 0
                    here = np.array(ats)[place] == node
                    mine = mine[here]
                    sums[t] = sums[t] + _histograms(bins[mine], y[mine], drawn[mine, t],
                                                    place[here], features[t])
            out = [(t, at, sums[t][:, i].tobytes()) for t, ats in wanted.items()
                   if not isinstance(sums[t], int) for i, at in enumerate(ats)]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(("tree", "node", "hist"), r)) for r in out],
                pa.schema([("tree", pa.int32()), ("node", pa.int64()), ("hist", pa.binary())]))

        def best(found: pd.DataFrame) -> pd.DataFrame:
            t, at = int(found["tree"].iloc[0]), int(found["node"].iloc[0])
            hist = sum(np.frombuffer(h, np.int64) for h in found["hist"]).reshape(-1, 1, BINS, 3)
            slot, cut, gain, left = _best_splits(hist, weights[t], leaf)
            d0, d1, n = hist[0, 0].sum(axis=0)
            feature = _node_features(seed, t, at, 1, width)[0, slot[0]]
            return pd.DataFrame([(t, at, feature, cut[0], gain[0], d0 * weights[t][0],
                                  d1 * weights[t][1], n, left[0])],
                                columns=["tree", "node", "feature", "bin", "gain", "w0", "w1", "n",
                                         "n_left"])

        found = rows.select("y", "bins", "drawn").mapInArrow(
            count, "tree int, node long, hist binary").groupBy("tree", "node").applyInPandas(
            best, "tree int, node long, feature int, bin int, gain double, w0 double, w1 double, "
                  "n long, n_left long").collect()  # one row per large node
        large = set()
        for r in found:
            if r.gain <= LEAST_GAIN or r.node.bit_length() > depth:
                top[r.tree][r.node] = (-1, -1, -1.0, r.w0, r.w1, r.n)
                continue
            top[r.tree][r.node] = (r.feature, r.bin, r.gain, r.w0, r.w1, r.n)
            large |= {(r.tree, 2 * r.node + side) for side, n in
                      enumerate((r.n_left, r.n - r.n_left)) if n > task_rows}
    return top


def _grow_rest(rows: DataFrame, top: Mapping, totals: Mapping, weights: Mapping, width: int,
               depth: int, leaf: int, seed: int) -> DataFrame:
    """``PIECES``: the subtrees whose rows fit one task, numbered from 0 each, and their roots."""
    splits = {t: [(at, *s[:2]) for at, s in sorted(nodes.items()) if s[0] >= 0]
              for t, nodes in top.items()}
    settled = {t: [at for at, s in nodes.items() if s[0] < 0] for t, nodes in top.items()}
    schema = pa.schema([("tree", pa.int32()), ("root", pa.int64()), ("bins", pa.binary()),
                        ("y", pa.binary()), ("drawn", pa.binary())])

    def deal(batches):
        for batch in batches:
            y = batch.column(0).to_numpy().astype(np.uint8)
            bins = _bytes(batch.column(1), len(y))
            drawn = _bytes(batch.column(2), len(y))
            for t in splits:
                mine = np.flatnonzero(drawn[:, t])
                node = _nodes_of(bins[mine], splits[t])
                parts = []
                for at in np.setdiff1d(node, settled[t]).tolist():
                    own = mine[node == at]
                    parts.append({"tree": t, "root": at, "bins": bins[own].tobytes(),
                                  "y": y[own].tobytes(), "drawn": drawn[own, t].tobytes()})
                if parts:
                    yield pa.RecordBatch.from_pylist(parts, schema)

    def grow(part: pd.DataFrame) -> pd.DataFrame:
        def column(name):
            return np.frombuffer(b"".join(part[name]), np.uint8)

        t, root = int(part["tree"].iloc[0]), int(part["root"].iloc[0])
        found = _grow(column("bins").reshape(-1, width), column("y"), column("drawn"), weights[t],
                      depth + 1 - root.bit_length(), leaf, seed, t, root)
        return pd.DataFrame([{**_packed(t, found), "root": root, "inner": found["right"][0] >= 0,
                              "m0": found["w0"][0], "m1": found["w1"][0]}])

    size = sum(n for _, n in totals.values()) * (width + 2)
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(4 * cores, math.ceil(size / SHUFFLE_BYTES))
    return (rows.select("y", "bins", "drawn").mapInArrow(
        deal, "tree int, root long, bins binary, y binary, drawn binary")
        .repartition(parts, "tree", "root").groupBy("tree", "root").applyInPandas(grow, PIECES))


def _joined_nodes(top: Mapping[int, tuple], roots: Mapping[int, tuple]) -> tuple[list, dict]:
    """Numbered nodes of one tree's top, and the number at which each subtree begins.

    ``roots`` has size, whether it is split, and weights of every subtree's root.
    """
    def says(w0, w1):
        return w1 > w0

    shape = {}  # heap number -> size, is a leaf, its prediction
    for at, (size, inner, w0, w1) in roots.items():
        shape[at] = size, not inner, says(w0, w1)
    merged = dict(top)
    for at in sorted(top, reverse=True):
        feature, _, _, w0, w1, n = top[at]
        if feature >= 0:
            (sl, ll, pl), (sr, lr, pr) = shape[2 * at], shape[2 * at + 1]
            if not (ll and lr and pl == pr):
                shape[at] = 1 + sl + sr, False, says(w0, w1)
                continue
            merged[at] = (-1, -1, -1.0, w0, w1, n)
        shape[at] = 1, True, says(w0, w1)
    rows, starts, todo = [], {}, [(1, 0)]
    while todo:
        at, number = todo.pop()
        if at not in top:
            starts[at] = number
            continue
        feature, cut, gain, w0, w1, n = merged[at]
        right = -1
        if feature >= 0:
            right = number + 1 + shape[2 * at][0]
            todo += [(2 * at, number + 1), (2 * at + 1, right)]
        rows.append((number, (right, max(feature, 0), max(cut, 0), w0, w1, n, gain)))
    return rows, starts


def _packed(tree: int, arrays: Mapping[str, np.ndarray]) -> dict:
    """A row of ``PACKED``."""
    inner = arrays["right"] >= 0
    arrays = {**arrays, "feature": np.where(inner, arrays["feature"], 0),
              "bin": np.where(inner, arrays["bin"], 0)}
    return {"tree": tree, "size": len(inner),
            **{c: arrays[c].astype(kind).tobytes() for c, kind in ARRAYS.items()}}


def _whole(tree: int, upper: Sequence[tuple], starts: Mapping[int, int], pieces) -> dict:
    """A row of ``PACKED``: the nodes of a tree's top, and its pieces from where they start."""
    pieces = [p for p in pieces if p.root in starts]  # without those that became one leaf
    size = len(upper) + sum(p.size for p in pieces)
    out = {c: np.empty(size, kind) for c, kind in ARRAYS.items()}
    for p in pieces:
        start = starts[p.root]
        for c, kind in ARRAYS.items():
            values = np.frombuffer(getattr(p, c), kind)
            if c == "right":
                values = np.where(values >= 0, values + start, -1)
            out[c][start:start + p.size] = values
    for number, node in upper:
        for c, value in zip(ARRAYS, node, strict=True):
            out[c][number] = value
    return _packed(tree, out)


def grow_forest(table: DataFrame, label: str, key: str, learner: RandomForestClassifier,
                n_trees: int, bootstrap: bool, task_cells: int = TASK_CELLS,
                driver_nodes: int | None = None) -> "RandomForestClassificationModel | StoredForest":
    """A forest of ``n_trees`` trees by the learner's depth, least leaf and seed.

    Row draws are ``draws_of``; a row of class c weighs draws * n / (2 n_c) in its tree, n and
    n_c being the tree's draws. A tree that draws no row is left out. Forests of more than
    ``driver_nodes`` nodes (``DRIVER_NODES`` by default) stay in files.
    """
    spark, seed = table.sparkSession, learner.getSeed()
    depth, leaf = learner.getMaxDepth(), learner.getMinInstancesPerNode()
    width = table.select(F.size(vector_to_array("features")).alias("n")).first().n
    bounds = bin_bounds(table, width)
    path = f"{shared_folder(spark)}/churnspark/{spark.sparkContext.applicationId}/forest-{uuid4().hex}"
    rows = binned_rows(spread(table, key), label, key, bounds, n_trees, seed, bootstrap).persist()
    try:
        totals = draw_totals(rows, n_trees)
        weights = {t: np.divide(d.sum(), 2 * d, out=np.zeros(2), where=d > 0)
                   for t, (d, _) in totals.items()}
        top = _grow_top(rows, totals, weights, width, depth, leaf, seed,
                        max(1, task_cells // width))
        _grow_rest(rows, top, totals, weights, width, depth, leaf, seed).write.parquet(
            f"{path}/grown")
    finally:
        rows.unpersist()
    grown = spark.read.schema(PIECES).parquet(f"{path}/grown")
    roots: dict[int, dict[int, tuple]] = {t: {} for t in totals}
    for r in grown.select("tree", "root", "size", "inner", "m0", "m1").collect():  # one a subtree
        roots[r.tree][r.root] = (r["size"], r.inner, r.m0, r.m1)
    plan, nodes = {}, 0
    for place, t in enumerate(sorted(totals)):
        upper, starts = _joined_nodes(top[t], roots[t])
        plan[t] = (place, upper, starts)
        nodes += len(upper) + sum(roots[t][at][0] for at in starts)

    def join(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame([_whole(*plan[int(part["tree"].iloc[0])], part.itertuples())])

    whole = grown.groupBy("tree").applyInPandas(join, PACKED)
    settled = [_whole(*own, ()) for t, own in plan.items() if not roots[t]]  # no split of the top
    if settled:
        whole = whole.unionByName(spark.createDataFrame(settled, PACKED))
    whole.write.parquet(f"{path}/trees")
    if nodes > (DRIVER_NODES if driver_nodes is None else driver_nodes):
        return StoredForest(path=f"{path}/trees", bounds=[b.tolist() for b in bounds],
                            numTrees=len(totals), nodes=nodes)
    return _as_model(_node_rows(spark.read.schema(PACKED).parquet(f"{path}/trees")), bounds,
                     learner, len(totals), f"{path}/model")


def _node_rows(packed: DataFrame) -> DataFrame:
    """tree, id, left, and ``ARRAYS``: one row a node; feature and bin are -1 in leaves."""
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a = {c: np.frombuffer(row[c], kind) for c, kind in ARRAYS.items()}
                leaf, ids = a["right"] < 0, np.arange(row["size"], dtype=np.int32)
                kept = {c: np.where(leaf, -1, a[c]).astype(np.int32) for c in ("feature", "bin")}
                yield pa.RecordBatch.from_pydict({
                    "tree": np.full(len(ids), row["tree"], np.int32), "id": ids,
                    "left": np.where(leaf, -1, ids + 1).astype(np.int32), **a, **kept})

    return packed.mapInArrow(run, "tree int, id int, left int, right int, feature int, bin int, "
                                  "w0 double, w1 double, n long, gain double")


def _as_model(nodes: DataFrame, bounds: Sequence[np.ndarray], learner: RandomForestClassifier,
              n_trees: int, path: str) -> RandomForestClassificationModel:
    """Nodes written in the layout of a stored model, and that model."""
    spark = nodes.sparkSession
    # A fit on two rows gives the parameters and their layout as this Spark version stores them.
    two = spark.createDataFrame(
        [(Vectors.dense([0.0] * len(bounds)), float(y), 1.0) for y in (0, 1)],
        ["features", learner.getLabelCol(), learner.getWeightCol()]).withMetadata(
        learner.getLabelCol(), {"ml_attr": {"type": "nominal", "vals": ["0", "1"]}})
    learner.fit(two).write().save(f"{path}-pattern")
    about = json.loads(spark.read.text(f"{path}-pattern/metadata").first()[0])
    about["numTrees"] = about["paramMap"]["numTrees"] = n_trees
    about["uid"] = f"{about['uid']}-{uuid4().hex[:8]}"
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(
        f"{path}/metadata")
    one = spark.read.parquet(f"{path}-pattern/treesMetadata")
    number, *others = one.columns
    spark.range(n_trees).select(F.col("id").cast("int").alias(number)).crossJoin(
        F.broadcast(one.select(*others))).write.parquet(f"{path}/treesMetadata")
    limits = spark.createDataFrame(
        [(i, j, float(v)) for i, b in enumerate(bounds) for j, v in enumerate(b)],
        "feature int, bin int, threshold double")  # at most 31 rows a feature
    mass = F.col("w0") + F.col("w1")
    leaf = F.col("left") < 0
    stored = nodes.join(F.broadcast(limits), ["feature", "bin"], "left").select(
        F.col("tree").alias("treeID"), F.struct(
            "id", F.when(F.col("w1") > F.col("w0"), 1.0).otherwise(0.0).alias("prediction"),
            F.when(mass > 0, 1 - (F.col("w0") ** 2 + F.col("w1") ** 2) / mass ** 2).otherwise(0.0)
            .alias("impurity"),
            F.array("w0", "w1").alias("impurityStats"), F.col("n").alias("rawCount"), "gain",
            F.col("left").alias("leftChild"), F.col("right").alias("rightChild"),
            F.struct(F.col("feature").alias("featureIndex"),
                     F.when(leaf, F.array().cast("array<double>")).otherwise(F.array("threshold"))
                     .alias("leftCategoriesOrThreshold"),
                     F.lit(-1).alias("numCategories")).alias("split")).alias("nodeData"))
    stored.write.parquet(f"{path}/data")
    return RandomForestClassificationModel.load(path)


# ---- forests in files --------------------------------------------------------------------------

class _Tree:
    """The nodes of one tree, to send blocks of rows through it."""

    def __init__(self, row: Mapping):
        right, feature, cut = (np.frombuffer(row[c], ARRAYS[c])
                               for c in ("right", "feature", "bin"))
        at = np.arange(len(right))
        self.tree, self.leaf = row["tree"], right < 0
        # both children of a leaf are the leaf
        self.child = np.stack((np.where(self.leaf, at, at + 1),
                               np.where(self.leaf, at, right)), axis=1).ravel()
        self.feature, self.cut = feature.astype(np.intp), cut

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """Number of the node at which each row ends."""
        flat, ends = bins.ravel(), np.zeros(len(bins), np.intp)
        rows, starts = np.arange(len(bins)), np.arange(len(bins)) * bins.shape[1]
        at = ends[rows]
        while True:
            for _ in range(3):
                at = self.child[2 * at + (flat[starts + self.feature[at]] > self.cut[at])]
            done = self.leaf[at]
            ends[rows[done]] = at[done]
            if done.all():
                return ends
            rows, starts, at = rows[~done], starts[~done], at[~done]


class LeafCounts(_Tree):
    """Rows and draws of each class that reached a tree's leaves, (leaf, class) in one array."""

    def __init__(self, row: Mapping):
        super().__init__(row)
        self.place = np.cumsum(self.leaf) - 1
        self.rows, self.draws = np.zeros((2, 2 * int(self.leaf.sum())), np.int64)

    def add(self, bins: np.ndarray, y: np.ndarray, drawn: np.ndarray) -> None:
        cell = 2 * self.place[self.leaves(bins)] + y
        self.rows += np.bincount(cell, minlength=len(self.rows))
        self.draws += np.bincount(cell, drawn, len(self.rows)).astype(np.int64)


def packed_trees(spark: SparkSession, model) -> tuple[DataFrame, list[np.ndarray], int, int]:
    """``PACKED`` rows of a forest, the thresholds of their bins, and the trees and nodes in all."""
    if isinstance(model, StoredForest):
        return (model.trees(spark), [np.array(b) for b in model.getOrDefault(model.bounds)],
                model.getNumTrees, model.getOrDefault(model.nodes))
    nodes = node_table(spark, model)
    bounds = [np.empty(0)] * model.numFeatures
    for r in nodes.where("left >= 0").groupBy("feature").agg(
            F.sort_array(F.collect_set("threshold")).alias("cuts")).collect():  # one a feature
        bounds[r.feature] = np.array(r.cuts)
    if max(map(len, bounds), default=0) > 255:
        raise ValueError("a feature has more than 255 thresholds")

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        stats = np.stack(part["stats"])
        inner = part["left"].to_numpy() >= 0
        feature, cut = part["feature"].to_numpy(), part["threshold"].to_numpy()
        found = {"right": part["right"].to_numpy(), "feature": feature,
                 "bin": np.array([np.searchsorted(bounds[f], c) if i else 0
                                  for f, c, i in zip(feature, cut, inner)]),
                 "w0": stats[:, 0], "w1": stats[:, 1], "n": part["raw_count"].to_numpy(),
                 "gain": np.zeros(len(part))}
        return pd.DataFrame([_packed(int(part["tree"].iloc[0]), found)])

    packed = nodes.groupBy("tree").applyInPandas(pack, PACKED)
    return packed, bounds, model.getNumTrees, model.totalNumNodes


def over_trees(chunks: DataFrame, n_rows: int, packed: DataFrame, n_trees: int, n_nodes: int,
               width: int, run: Callable[[list, Iterator], Iterator], schema: str) -> DataFrame:
    """``run(trees, rows of chunks)`` for every pair of a block of chunks and a group of trees.

    ``chunks`` hold many rows in one, their bins in ``x``. No task has more than ``TASK_CELLS``
    feature values nor, beyond one tree, ``GROUP_NODES`` nodes; chunks are copied once a group,
    trees once a block.
    """
    cores = chunks.sparkSession.sparkContext.defaultParallelism
    groups = min(n_trees, max(4 * cores, math.ceil(n_nodes / GROUP_NODES)))
    blocks = max(1, math.ceil(n_rows * width / TASK_CELLS))
    def copied(times: int, part: Callable):
        return F.explode(F.transform(F.sequence(F.lit(0), F.lit(times - 1)), part))

    block = F.pmod(F.xxhash64("x"), F.lit(blocks)).cast("int")
    trees = packed.withColumn("part", copied(
        blocks, lambda i: F.pmod("tree", F.lit(groups)) + groups * i))
    rows = chunks.withColumn("block", block).withColumn("part", copied(
        groups, lambda i: i + groups * F.col("block"))).drop("block")
    own, named = packed.columns, chunks.columns

    def task(batches):
        trees = []

        def chunks_of():
            for batch in batches:
                for at in range(batch.num_rows):
                    row = batch.slice(at, 1).to_pylist()[0]
                    if row["x"] is None:  # trees come first
                        trees.append({c: row[c] for c in own})
                    else:
                        yield {c: row[c] for c in named}

        yield from run(trees, chunks_of())

    both = trees.unionByName(rows, allowMissingColumns=True)
    return (both.repartitionById(groups * blocks, "part")
            .sortWithinPartitions(F.col("x").isNotNull(), "tree").drop("part")
            .mapInArrow(task, schema))


class _ForestWriter(DefaultParamsWriter):
    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        self.instance.trees(self.sparkSession).write.parquet(f"{path}/trees")


class _ForestReader(DefaultParamsReader):
    def load(self, path: str) -> "StoredForest":
        return super().load(path)._set(path=f"{path}/trees")


class StoredForest(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A forest whose trees lie in files: tasks read some of them each and send all rows through.

    The votes are counted when ``transform`` is called, and a row of the result is joined with its
    votes, so a stream is scored batch by batch (``foreachBatch``).
    """

    path = Param(Params._dummy(), "path", "folder of the trees", TypeConverters.toString)
    bounds = Param(Params._dummy(), "bounds", "thresholds of each feature",
                   TypeConverters.toListListFloat)
    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    nodes = Param(Params._dummy(), "nodes", "nodes of all trees", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, path=None, bounds=None, numTrees=0, nodes=0):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def getNumTrees(self) -> int:
        return self.getOrDefault(self.numTrees)

    def trees(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(PACKED).parquet(self.getOrDefault(self.path))

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader(cls)

    def _transform(self, dataset):
        packed, bounds, n_trees, n_nodes = packed_trees(dataset.sparkSession, self)
        width = len(bounds)
        # numbers of rows hold only while the rows are the same, hence the checkpoint
        rows = cut_lineage(dataset.withColumn("_row", F.monotonically_increasing_id()))

        def chunk(batches):
            for batch in batches:
                x = batch.column(1).flatten().to_numpy().reshape(-1, width)
                yield pa.RecordBatch.from_pydict({
                    "rows": [batch.column(0).to_numpy().astype("<i8").tobytes()],
                    "x": [bins_of(x, bounds).tobytes()]})

        def votes(trees, chunks):
            grown = []
            for c in chunks:
                if not grown:
                    for t in trees:
                        w0, w1 = (np.frombuffer(t[w], "<f8") for w in ("w0", "w1"))
                        grown.append((_Tree(t), w1 / (w0 + w1)))
                    trees.clear()
                bins = np.frombuffer(c["x"], np.uint8).reshape(-1, width)
                p = np.zeros(len(bins))
                for tree, says in grown:
                    p += says[tree.leaves(bins)]
                yield pa.RecordBatch.from_pydict({
                    "rows": [c["rows"]], "group": [min(t.tree for t, _ in grown)],
                    "p": [p.tobytes()]}, pa.schema([("rows", pa.binary()), ("group", pa.int32()),
                                                    ("p", pa.binary())]))

        def total(part: pd.DataFrame) -> pd.DataFrame:
            part = part.sort_values("group")  # one order of the sum
            p = sum(np.frombuffer(v) for v in part["p"]) / n_trees
            return pd.DataFrame({"_row": np.frombuffer(part["rows"].iloc[0], "<i8"), "p": p})

        chunks = rows.select("_row", vector_to_array("features")).mapInArrow(
            chunk, "rows binary, x binary")
        voted = cut_lineage(
            over_trees(chunks, rows.count(), packed.select("tree", "right", "feature", "bin", "w0", "w1"),
                       n_trees, n_nodes, width, votes, "rows binary, group int, p binary")
            .groupBy("rows").applyInPandas(total, "_row long, p double"))
        both = F.array(1 - F.col("p"), F.col("p"))
        return rows.join(voted, "_row").withColumns({
            "rawPrediction": array_to_vector(F.transform(both, lambda v: v * n_trees)),
            "probability": array_to_vector(both),
            "prediction": (F.col("p") > 0.5).cast("double")}).drop("_row", "p")
