"""Merkle manifest of a table: one tree of digests per source, one tree over the sources.

Trees have sixteen children a node. They are kept as blocks: aligned subtrees of ``HEIGHT`` levels
of edges, whose roots are the leaves of the blocks above. Inside a block the digests stand in van
Emde Boas order: the upper half of the levels first, then each subtree of the lower half, and so on
within each. ``address`` finds a node from its depth and index alone; building and reading siblings
both use it, whatever the size of a cache line or a page.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.llm import checksum_sql
from churnspark.llm.common import stored

ARITY = 16
#: Levels of edges in a block: 16^3 leaves, 139 kB of digests.
HEIGHT = 3
DIGEST = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<at int, siblings binary>>"
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


# ---- layout of a block ----------------------------------------------------------------------

def n_nodes(levels: int) -> int:
    return (ARITY ** levels - 1) // (ARITY - 1)


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Places, in van Emde Boas order, of the nodes ``index`` at a depth of a complete tree."""
    if levels <= 1:
        return np.zeros_like(index)
    upper = levels // 2
    if depth < upper:
        return address(upper, depth, index)
    below = ARITY ** (depth - upper)
    return (n_nodes(upper) + index // below * n_nodes(levels - upper)
            + address(levels - upper, depth - upper, index % below))


@lru_cache(maxsize=None)
def places(levels: int, depth: int) -> np.ndarray:
    return address(levels, depth, np.arange(ARITY ** depth))


def height_of(n: int) -> int:
    """Levels of edges of a whole tree with n leaves; a lone leaf is its own root."""
    height = 0
    while ARITY ** height < n:
        height += 1
    return height


def digest_of(children: bytes) -> bytes:
    """The node over some digests, which are hashed as lowercase hex text."""
    return hashlib.sha256(children.hex().encode()).digest()


def build_block(leaves: bytes, height: int) -> bytes:
    """All digests of a block over 1 to 16^height leaves; absent nodes are zero bytes."""
    nodes = np.zeros((n_nodes(height + 1), DIGEST), dtype=np.uint8)
    count = len(leaves) // DIGEST
    nodes[places(height + 1, height)[:count]] = np.frombuffer(leaves, np.uint8).reshape(-1, DIGEST)
    for depth in range(height - 1, -1, -1):
        row = nodes[places(height + 1, depth + 1)[:count]].tobytes()
        step = ARITY * DIGEST
        above = [digest_of(row[at:at + step]) for at in range(0, len(row), step)]
        count = len(above)
        nodes[places(height + 1, depth)[:count]] = np.frombuffer(
            b"".join(above), np.uint8).reshape(-1, DIGEST)
    return nodes.tobytes()


def siblings(nodes: bytes, height: int, count: int) -> list[list[bytes]]:
    """Per level, from the leaves up, the other digests of the run that each node belongs to."""
    table = np.frombuffer(nodes, np.uint8).reshape(-1, DIGEST)
    out = []
    for depth in range(height, 0, -1):
        row = table[places(height + 1, depth)[:count]].tobytes()
        level = []
        for i in range(count):
            first = i - i % ARITY
            level.append(row[first * DIGEST:i * DIGEST]
                         + row[(i + 1) * DIGEST:(first + ARITY) * DIGEST])
        out.append(level)
        count = -(-count // ARITY)
    return out


# ---- leaves and their ranks ---------------------------------------------------------------------

def _field(column: Column) -> Column:
    text = column.cast("string")
    return F.when(column.isNull(), "-").otherwise(
        F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(row: dict[str, Column]) -> Column:
    """Binary SHA-256 of a row: its fields in order, each with its byte count, ``-`` if null."""
    return F.unhex(F.sha2(F.concat(*(_field(row[c]) for c in FIELDS)).cast("binary"), 256))


def _leaves(docs: DataFrame) -> DataFrame:
    """tree, doc_id, leaf, altered: the leaf of each row, and that of its tampered form if any."""
    row = {c: docs[f"`{c}`"] for c in FIELDS}
    small = {**row, "text": F.translate(row["text"], CAPITALS, SMALL)}
    chosen = F.crc32(row["doc_id"].cast("string").cast("binary")) % 5 == 0
    tree = F.when(row["source"].isNull(), "0").otherwise(F.concat(F.lit("1"), row["source"]))
    return docs.select(tree.alias("tree"), row["doc_id"].cast("long").alias("doc_id"),
                       leaf_digest(row).alias("leaf"),
                       F.when(chosen, leaf_digest(small)).alias("altered"))


def _ranked(leaves: DataFrame, order: list[str], name: str) -> DataFrame:
    """Adds rank, the place within the tree from 0, and n, the number of leaves of the tree.

    Rows are dealt by range and written with their place in a partition; the partitions' counts
    per tree are summed up before, so no tree passes one task.
    """
    placed = stored(leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
                    .withColumn("at", F.monotonically_increasing_id()), name)
    part = F.call_function("shiftright", F.col("at"), F.lit(33))
    runs = placed.groupBy("tree", part.alias("part")).agg(F.min("at").alias("first"),
                                                          F.count("*").alias("here"))
    whole = Window.partitionBy("tree")  # a row per partition that holds leaves of the tree
    bases = runs.select(
        "tree", "part", "first", F.sum("here").over(whole).alias("n"),
        (F.sum("here").over(whole.orderBy("part")) - F.col("here")).alias("before"))
    return (placed.withColumn("part", part).join(bases, ["tree", "part"])
            .withColumn("rank", F.col("before") + F.col("at") - F.col("first"))
            .drop("part", "first", "before", "at"))


# ---- blocks -------------------------------------------------------------------------------------

def _by_block(batches):
    """Whole blocks, as tables, of rows sorted by tree and block."""
    rest = None
    for batch in batches:
        if not batch.num_rows:
            continue
        part = pa.Table.from_batches([batch])
        rest = part if rest is None else pa.concat_tables([rest, part]).combine_chunks()
        keys = list(zip(rest.column(0).to_pylist(), rest.column(1).to_pylist(), strict=True))
        cuts = [i for i in range(1, len(keys)) if keys[i] != keys[i - 1]]
        begin = 0
        for cut in cuts:
            yield rest.slice(begin, cut - begin)
            begin = cut
        rest = rest.slice(begin)
    if rest is not None and rest.num_rows:
        yield rest


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """(tree, block, n, count, root, nodes) over rows (tree, rank, n, leaf)."""
    full = height_of(size)

    def run(batches):
        for table in _by_block(batches):
            n = table.column(3)[0].as_py()
            height = min(full, height_of(n))
            nodes = build_block(b"".join(table.column(4).to_pylist()), height)
            yield pa.RecordBatch.from_pylist([{
                "tree": table.column(0)[0].as_py(), "block": table.column(1)[0].as_py(), "n": n,
                "count": table.num_rows, "root": nodes[:DIGEST], "nodes": nodes}], pa.schema([
                    ("tree", pa.string()), ("block", pa.int64()), ("n", pa.int64()),
                    ("count", pa.int32()), ("root", pa.binary()), ("nodes", pa.binary())]))

    return (rows.select("tree", F.floor(F.col("rank") / size).alias("block"), "rank", "n", "leaf")
            .repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
            .mapInArrow(run, "tree string, block long, n long, count int, root binary, "
                             "nodes binary"))


def _forest(rows: DataFrame, size: int, name: str) -> list[DataFrame]:
    """Tables of blocks, from the leaves up, until every tree has one block."""
    levels = []
    while True:
        blocks = stored(_blocks(rows, size), name)
        levels.append(blocks)
        rest = blocks.where(F.col("n") > size)
        if rest.isEmpty():
            return levels
        rows = rest.select("tree", F.col("block").alias("rank"),
                           F.ceil(F.col("n") / size).alias("n"), F.col("root").alias("leaf"))


def _roots(levels: list[DataFrame], size: int) -> DataFrame:
    """(tree, subroot) from the table in which each tree ends."""
    ends = [b.where(F.col("n") <= size).select("tree", F.col("root").alias("subroot"))
            for b in levels]
    out = ends[0]
    for more in ends[1:]:
        out = out.union(more)
    return out


@dataclass
class Manifest:
    """leaves: tree, rank, n, doc_id, leaf, altered; levels: tables of blocks from the leaves up;
    top: the same over the sources' roots; root: hex, None for an empty table."""

    leaves: DataFrame
    levels: list[DataFrame]
    sources: DataFrame
    top: list[DataFrame]
    root: str | None
    size: int


def build(docs: DataFrame, height: int = HEIGHT) -> Manifest:
    """The manifest of every row of ``docs``; columns other than ``FIELDS`` are ignored.

    Within a source rows ascend by doc_id, nulls first, then by digest, so repeated rows are
    leaves of their own. A null source is a tree of its own, before all others. Texts may be null, empty or of
    any length. A task holds one block of 16^height leaves at a time.
    """
    size = ARITY ** height
    leaves = stored(_ranked(_leaves(docs), ["doc_id", "leaf"], "merkle-leaves"), "merkle-ranks")
    levels = _forest(leaves, size, "merkle-blocks")
    subroots = _roots(levels, size).select(
        F.lit("").alias("tree"), F.col("tree").alias("source_key"), F.col("subroot").alias("leaf"))
    sources = stored(_ranked(subroots, ["source_key"], "merkle-sources"), "merkle-sources")
    top = _forest(sources, size, "merkle-top")
    last = top[-1].select("root").first()  # one row, or none
    return Manifest(leaves, levels, sources, top, last.root.hex() if last else None, size)


# ---- proofs -------------------------------------------------------------------------------------

_CARRIED = "doc_id long, leaf binary, altered binary"


def _paths(members: DataFrame, blocks: DataFrame, size: int) -> DataFrame:
    """tree, rank, doc_id, leaf, altered, top, path: ``blocks`` have ``above`` (the path from their
    root on) and ``top`` (the root of the tree); each is dealt to where its members are."""
    full = height_of(size)
    entry = pa.struct([("at", pa.int32()), ("siblings", pa.binary())])

    def run(batches):
        for table in _by_block(batches):
            head = table.slice(0, 1)
            n, count = head.column(3)[0].as_py(), head.column(4)[0].as_py()
            height = min(full, height_of(n))
            levels = siblings(head.column(5)[0].as_py(), height, count)
            above = head.column(6)[0].as_py() or []
            tops = head.column(7)[0].as_py()
            for begin in range(1, table.num_rows, 512):
                some = table.slice(begin, 512)
                at, found = [], []
                ranks = some.column(2).to_pylist()
                for rank in ranks:
                    i = rank % size
                    for level in levels:
                        at.append(i % ARITY)
                        found.append(level[i])
                        i //= ARITY
                    at += [e["at"] for e in above]
                    found += [e["siblings"] for e in above]
                step = height + len(above)
                path = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(ranks) + 1) * step, pa.int32()),
                    pa.StructArray.from_arrays([pa.array(at, pa.int32()),
                                                pa.array(found, pa.binary())], fields=list(entry)))
                flat = some.combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [flat.column(i).combine_chunks() if flat.num_rows else flat.column(i)
                     for i in (0, 2, 8, 9, 10)]
                    + [pa.array([tops] * len(ranks), pa.binary()), path],
                    ["tree", "rank", "doc_id", "leaf", "altered", "top", "path"])

    both = members.select(
        "tree", F.floor(F.col("rank") / size).alias("block"), "rank",
        *(F.lit(None).cast(t).alias(c) for c, t in (
            ("n", "long"), ("count", "int"), ("nodes", "binary"), ("above", PATH),
            ("top", "binary"))), "doc_id", "leaf", "altered").union(blocks.select(
                "tree", "block", F.lit(-1).cast("long").alias("rank"), "n", "count", "nodes",
                "above", "top", *(F.lit(None).cast(t).alias(c) for c, t in (
                    ("doc_id", "long"), ("leaf", "binary"), ("altered", "binary")))))
    return (both.repartition("tree", "block").sortWithinPartitions("tree", "block", "rank")
            .mapInArrow(run, f"tree string, rank long, {_CARRIED}, top binary, path {PATH}"))


def _descend(levels: list[DataFrame], rows: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """Paths of ``rows``, the leaves; ``ends`` has (tree, above, top) of every tree's root."""
    found = None
    for i in range(len(levels) - 1, -1, -1):
        blocks = levels[i].where(F.col("n") <= size).join(ends, "tree")
        if found is not None:
            inner = levels[i].where(F.col("n") > size).join(
                found.select("tree", F.col("rank").alias("block"), F.col("path").alias("above"),
                             "top"), ["tree", "block"])
            blocks = blocks.unionByName(inner)
        members = rows if i == 0 else levels[i - 1].where(F.col("n") > size).select(
            "tree", F.col("block").alias("rank"), F.lit(None).cast("long").alias("doc_id"),
            F.col("root").alias("leaf"), F.lit(None).cast("binary").alias("altered"))
        found = _paths(members, blocks, size)
        if i:
            found = stored(found, "merkle-paths")
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, altered, subroot (binary) and path of every row.

    The path goes from the leaf to the root over all sources: per level the place among the run's
    nodes and the digests of the others, left to right. It is empty for the only row of a table.
    """
    size = manifest.size
    whole = manifest.top[-1].select("tree", F.array().cast(PATH).alias("above"),
                                    F.col("root").alias("top"))
    sources = manifest.sources.select("tree", "rank", "leaf", F.lit(None).cast("long")
                                      .alias("doc_id"), F.lit(None).cast("binary").alias("altered"))
    tops = _descend(manifest.top, sources, whole, size)
    ends = stored(manifest.sources.select("source_key", "rank").join(
        tops.select("rank", "path", "leaf"), "rank").select(
            F.col("source_key").alias("tree"), F.col("path").alias("above"),
            F.col("leaf").alias("top")), "merkle-ends")
    rows = manifest.leaves.select("tree", "rank", "doc_id", "leaf", "altered")
    return _descend(manifest.levels, rows, ends, size).withColumnRenamed("top", "subroot")


def _hex(binary: Column) -> Column:
    return F.lower(F.hex(binary))


def folded(leaf: Column, path: Column) -> Column:
    """Hex of the root that a leaf (binary) and a path lead to, by built-in functions alone."""
    def step(node: Column, entry: Column) -> Column:
        others, cut = _hex(entry["siblings"]), entry["at"] * (2 * DIGEST)
        return F.sha2(F.concat(F.substr(others, F.lit(1), cut), node,
                               F.substr(others, cut + 1)).cast("binary"), 256)

    return F.aggregate(path, _hex(leaf), step)


def path_digest(path: Column) -> Column:
    """SHA-256 of all siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda e: _hex(e["siblings"])), "")
                  .cast("binary"), 256)


def report(manifest: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``folded_root`` starts from the tampered leaf where there is one; a row is verified if that
    still leads to the root. Rows whose doc_id is null are not tampered with.
    """
    whole = F.lit(manifest.root).cast("string")
    return proofs(manifest).select(
        "doc_id", _hex(F.col("leaf")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"),
        whole.alias("root"), path_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("altered", "leaf"), F.col("path")).alias("folded_root")).withColumn(
            "verified", F.col("folded_root") == F.col("root"))


# ---- SQL twin -------------------------------------------------------------------------------

def _sql_levels(name: str, tree: str, steps: int) -> str:
    """Common tables name0 .. : the levels of trees, each node with its siblings to the left and
    right; a tree of one node stays as it is."""
    out = []
    for i in range(steps):
        run = f"PARTITION BY {tree}, i // 16 ORDER BY i ROWS BETWEEN"
        out.append(f"""{name}{i}s AS (SELECT *,
  coalesce(string_agg(h, '') OVER ({run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(h, '') OVER ({run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {name}{i}),
{name}{i + 1} AS (SELECT {tree}, i // 16 AS i, any_value((n + 15) // 16) AS n,
  CASE WHEN any_value(n) = 1 THEN any_value(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
  FROM {name}{i} GROUP BY {tree}, i // 16)""")
    return ",\n".join(out)


def _sql_climb(name: str, key: str, steps: int, start: str, first: str) -> str:
    """Common tables that lead a node and its proof up the levels."""
    out, before = [], start
    for i in range(steps):
        out.append(f"""{first}{i} AS (SELECT {before}.* EXCLUDE (node, proof),
  CASE WHEN s.n = 1 THEN node ELSE sha256(s.l || node || s.r) END AS node,
  proof || s.l || s.r AS proof
  FROM {before} JOIN {name}{i}s s ON {before}.{key} IS NOT DISTINCT FROM s.{key}
    AND s.i = {before}.{'place' if name == 'a' else 'sp'} // {16 ** i})""")
        before = f"{first}{i}"
    return ",\n".join(out)


def _sql_field(column: str) -> str:
    return (f"CASE WHEN {column} IS NULL THEN '-' ELSE octet_length(encode({column}::VARCHAR))"
            f"::VARCHAR || ':' || {column}::VARCHAR END")


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(c) for c in FIELDS[:-1]) + " || " + (
        _sql_field(text)) + ")"


#: Levels within a source, and over the sources.
_STEPS, _TOP = 5, 3
ORACLE = f"""
WITH {checksum_sql.TABLE},
d AS (SELECT doc_id, source, {_sql_leaf('text')} AS h,
        CASE WHEN {checksum_sql.crc32('doc_id::VARCHAR')} % 5 = 0
          THEN {_sql_leaf(f"translate(text, '{CAPITALS}', '{SMALL}')")} END AS altered
      FROM documents, crc_table),
a0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, h) - 1 AS i,
        count(*) OVER (PARTITION BY source) AS n FROM d),
{_sql_levels('a', 'source', _STEPS)},
t0 AS (SELECT 0 AS one, source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i,
        count(*) OVER () AS n FROM a{_STEPS}),
{_sql_levels('t', 'one', _TOP)},
begun AS (SELECT doc_id, source, i AS place, h AS leaf, coalesce(altered, h) AS node, '' AS proof
          FROM a0),
{_sql_climb('a', 'source', _STEPS, 'begun', 'c')},
midway AS (SELECT c{_STEPS - 1}.*, 0 AS one, t0.i AS sp, t0.h AS subroot
           FROM c{_STEPS - 1} JOIN t0 ON c{_STEPS - 1}.source IS NOT DISTINCT FROM t0.source),
{_sql_climb('t', 'one', _TOP, 'midway', 'e')}
SELECT doc_id, leaf, subroot, t{_TOP}.h AS root, sha256(proof) AS proof_sha256,
  node AS folded_root, node = t{_TOP}.h AS verified
FROM e{_TOP - 1}, t{_TOP}
"""
