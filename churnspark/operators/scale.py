"""Order statistics and running totals that never sort a table in one task.

* :func:`prefix_sum` -- running totals in key order: rows are put in balanced
  key-range buckets, only bucket totals (a bounded table) are accumulated
  globally, and each bucket is then summed on its own.
* :func:`exact_quantiles` -- exact percentiles: sketches bracket the wanted
  ranks, a count fixes the rank of the bracket, only rows inside are ranked.
* :func:`hash_cutoffs` -- exact n-th value of a seeded hash order.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.session import cut_lineage

ROWS_PER_BUCKET = 1_000_000
BOUND_SAMPLE = 50
SMALL_COLUMN = 1_000_000
SKETCH_ACCURACY = 10_000


def rows_from_aggregates(df: DataFrame, label: str,
                         aggregates: Mapping[str, Mapping[str, Column]]) -> DataFrame:
    """One pass over ``df`` for all aggregates, returned as one row per entry."""
    exprs, structs = [], []
    for i, (name, fields) in enumerate(aggregates.items()):
        parts = [F.lit(name).alias(label)]
        for j, (field, expr) in enumerate(fields.items()):
            exprs.append(expr.alias(f"a{i}_{j}"))
            parts.append(F.col(f"a{i}_{j}").alias(field))
        structs.append(F.struct(*parts))
    return df.agg(*exprs).select(F.inline(F.array(*structs)))


# ---- running totals -----------------------------------------------------------

def key_buckets(df: DataFrame, key: str, tie: str | None = None,
                rows_per_bucket: int = ROWS_PER_BUCKET) -> tuple[DataFrame, int]:
    """Add ``_bucket`` and ``_sub``, which follow the order of (key, tie).

    Bounds are quantiles of the key, fetched once, so a recomputed task puts a
    row in the same bucket again. A key that fills several quantiles is split
    further at values of ``tie``, of any type with an order; it is the lower
    bound of its bucket, hence its parts come before the other rows there.
    """
    rows = df.count()
    wanted = math.ceil(rows / rows_per_bucket)
    if wanted <= 1:
        return df.withColumns({"_bucket": F.lit(0.0), "_sub": F.lit(0)}), 1
    cuts = [i / wanted for i in range(1, wanted)]
    bounds = df.agg(F.percentile_approx(key, cuts, max(SKETCH_ACCURACY, 10 * wanted))).first()[0]
    repeats = Counter(bounds)
    splits = [-math.inf, *sorted(repeats), math.inf]
    df = Bucketizer(splits=splits, inputCol=key, outputCol="_bucket").transform(df)
    hot = [v for v, times in repeats.items() if times > 1]
    if tie is None or not hot:
        return df.withColumn("_sub", F.lit(0)), len(splits) - 1
    parts = max(repeats.values()) + 1
    # Every n-th tie by hash, about BOUND_SAMPLE per bucket: bounds decide where
    # rows are summed, never a result.
    every = max(1, rows // (BOUND_SAMPLE * wanted))
    sample = (df.where(F.col(key).isin(hot) & (F.pmod(F.xxhash64(tie), F.lit(every)) == 0))
              .groupBy(key).agg(F.sort_array(F.collect_list(tie)).alias("_all")))
    place = (F.size("_all") / parts)
    hot_rows = sample.select(key, F.array_compact(F.transform(
        F.sequence(F.lit(1), F.lit(parts - 1)),
        lambda i: F.get("_all", F.floor(i * place).cast("int")))).alias("_cuts")).collect()
    small = df.sparkSession.createDataFrame(
        hot_rows, df.select(key, F.array(tie).alias("_cuts")).schema)
    df = df.join(F.broadcast(small), key, "left")
    # Binary search for the cuts below, as every row would else walk through all of them.
    steps = [1 << i for i in reversed(range(parts.bit_length()))]
    below = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda at, step: F.when(
        F.get("_cuts", at + step - 1) < F.col(tie), at + step).otherwise(at))
    sub = F.when(F.col("_cuts").isNull(), F.lit(parts)).otherwise(below)
    return df.withColumn("_sub", sub).drop("_cuts"), len(splits) - 1


def bucket_offsets(df: DataFrame, measures: Sequence[str],
                   groups: Sequence[str] = ()) -> DataFrame:
    """Totals before each bucket and overall, per group; one row per bucket."""
    totals = df.groupBy(*groups, "_bucket", "_sub").agg(
        *[F.sum(m).alias(f"_in_{m}") for m in measures])
    whole = Window.partitionBy(*groups)
    before = whole.orderBy("_bucket", "_sub").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        *groups, "_bucket", "_sub", *[f"_in_{m}" for m in measures],
        *[F.coalesce(F.sum(f"_in_{m}").over(before), F.lit(0)).alias(f"_before_{m}")
          for m in measures],
        *[F.sum(f"_in_{m}").over(whole).alias(f"total_{m}") for m in measures])


def running_in_buckets(df: DataFrame, offsets: DataFrame, key: str, measures: Sequence[str],
                       groups: Sequence[str] = (), tie: str | None = None) -> DataFrame:
    place = [*groups, "_bucket", "_sub"]
    local = (Window.partitionBy(*place).orderBy(key, *([tie] if tie else []))
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    running = df.withColumns({f"_local_{m}": F.sum(m).over(local) for m in measures})
    return running.join(offsets, place).select(
        *[c for c in df.columns if c not in ("_bucket", "_sub")],
        *[(F.col(f"_before_{m}") + F.col(f"_local_{m}")).alias(f"cum_{m}") for m in measures],
        *[F.col(f"total_{m}") for m in measures])


def prefix_sum(df: DataFrame, key: str, measures: Sequence[str], groups: Sequence[str] = (),
               tie: str | None = None, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``cum_<m>`` (ascending key, then tie) and ``total_<m>`` per group.

    ``key`` is a double without NULL or NaN; give a negated column for
    descending order. Keys are unique inside a group unless ``tie`` is given.
    """
    df = cut_lineage(df)
    df, buckets = key_buckets(df, key, tie, rows_per_bucket)
    if buckets == 1:
        whole = Window.partitionBy(*groups)
        upto = (whole.orderBy(key, *([tie] if tie else []))
                .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        return (df.withColumns({f"cum_{m}": F.sum(m).over(upto) for m in measures})
                .withColumns({f"total_{m}": F.sum(m).over(whole) for m in measures})
                .drop("_bucket", "_sub"))
    return running_in_buckets(df, bucket_offsets(df, measures, groups), key, measures,
                              groups, tie)


# ---- exact percentiles ----------------------------------------------------------

def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float],
                    small_column: int = SMALL_COLUMN,
                    accuracy: int = SKETCH_ACCURACY) -> dict[str, list[float | None]]:
    """Exact percentiles with linear interpolation, NULLs left out.

    A column of at most ``small_column`` values uses the built-in exact
    ``percentile``, whose buffer is then bounded; larger ones are bracketed. Both take the same
    two order statistics through the same arithmetic.
    """
    columns, probs = list(columns), list(probs)
    rows = df.count()  # no column holds more values than this
    sizes = dict.fromkeys(columns, rows)
    if rows > small_column:
        sizes = df.agg(*[F.count(F.col(c)).alias(c) for c in columns]).first().asDict()
    small = [c for c in columns if sizes[c] <= small_column]
    large = [c for c in columns if sizes[c] > small_column]
    result: dict[str, list[float | None]] = {}
    if small:
        row = df.agg(*[F.percentile(F.col(c).cast("double"), F.array(*map(F.lit, probs))).alias(c)
                       for c in small]).first()
        result.update({c: list(row[c]) if row[c] is not None else [None] * len(probs)
                       for c in small})
    if large:
        result.update(_bracketed_quantiles(df, large, probs, sizes, accuracy))
    return result


def _bracketed_quantiles(df: DataFrame, columns: list[str], probs: list[float],
                         sizes: Mapping[str, int], accuracy: int) -> dict[str, list[float]]:
    df = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    margin = 2 / accuracy
    edges = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-margin, margin)})
    sketch = df.agg(*[F.percentile_approx(c, edges, accuracy).alias(c) for c in columns]).first()

    def bracket(c: str, p: float) -> tuple[float, float]:
        low, high = p - margin, p + margin
        slack = 2 / sizes[c]  # both neighbours of the wanted rank must be inside
        lo = -math.inf if low <= slack else sketch[c][edges.index(low)]
        hi = math.inf if high >= 1 - slack or margin <= slack else sketch[c][edges.index(high)]
        return (lo if margin > slack else -math.inf), hi

    targets = [(c, p) for c in columns for p in probs]
    brackets = [bracket(c, p) for c, p in targets]
    while True:
        below = df.agg(*[F.count_if(F.col(c) < lo).alias(f"b{t}")
                         for t, ((c, _), (lo, _)) in enumerate(zip(targets, brackets))]).first()
        inside = F.array(*[
            F.when((F.col(c) >= lo) & (F.col(c) <= hi),
                   F.struct(F.lit(t).alias("t"), F.col(c).alias("v")))
            for t, ((c, _), (lo, hi)) in enumerate(zip(targets, brackets))])
        counts = (df.select(F.inline(F.array_compact(inside))).groupBy("t", "v")
                  .agg(F.count("*").alias("n")))
        order = (Window.partitionBy("t").orderBy("v")
                 .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        ranked = counts.withColumn("upto", F.sum("n").over(order))
        ranks = [p * (sizes[c] - 1) for c, p in targets]
        wanted = None
        for t, rank in enumerate(ranks):
            first, last = math.floor(rank) - below[t], math.ceil(rank) - below[t]
            hit = (F.col("t") == t) & (
                ((F.col("upto") > first) & (F.col("upto") - F.col("n") <= first))
                | ((F.col("upto") > last) & (F.col("upto") - F.col("n") <= last)))
            wanted = hit if wanted is None else wanted | hit
        found: dict[int, list] = {}
        for row in ranked.where(wanted).collect():  # at most two rows per target
            found.setdefault(row.t, []).append(row)
        values, missed = {}, []
        for t, rank in enumerate(ranks):
            pick = {}
            for k in (math.floor(rank), math.ceil(rank)):
                for row in found.get(t, []):
                    if row.upto - row.n <= k - below[t] < row.upto:
                        pick[k] = row.v
            if len(pick) < len({math.floor(rank), math.ceil(rank)}):
                missed.append(t)
                continue
            lo, hi = pick[math.floor(rank)], pick[math.ceil(rank)]
            # the built-in's own arithmetic, so that both ways agree to the last bit
            values[t] = lo if lo == hi else (
                (math.ceil(rank) - rank) * lo + (rank - math.floor(rank)) * hi)
        if not missed:
            break
        for t in missed:  # a sketch missed its bound: rank the whole column instead
            brackets[t] = (-math.inf, math.inf)
    return {c: [values[targets.index((c, p))] for p in probs] for c in columns}


# ---- exact cut-offs of a seeded hash order ----------------------------------------

def hash_cutoffs(df: DataFrame, order: str, positions: Mapping[object, Sequence[int]],
                 stratum: str | None = None, digits: int = 4) -> dict[object, list[str | None]]:
    """Hash value at each 1-based position of the hash order, per stratum.

    Counts per hash prefix (at most 16**digits rows per stratum) place each
    position in one prefix; only rows with that prefix are ranked.
    """
    level = F.col(stratum) if stratum else F.lit(None).cast("string")
    keyed = df.select(level.alias("s"), F.col(order).alias("h"),
                      F.substring(order, 1, digits).alias("x"))
    counts: dict[object, list[tuple[str, int]]] = {}
    for row in keyed.groupBy("s", "x").count().orderBy("s", "x").collect():
        counts.setdefault(row.s, []).append((row.x, row["count"]))
    spots = []  # (stratum, index, prefix, rank inside the prefix)
    for s, wanted in positions.items():
        for i, position in enumerate(wanted):
            seen = 0
            for prefix, n in counts.get(s, []):
                if seen < position <= seen + n:
                    spots.append((s, i, prefix, position - seen))
                    break
                seen += n
    result: dict[object, list[str | None]] = {s: [None] * len(w) for s, w in positions.items()}
    if not spots:
        return result
    edge = None
    for s, _, prefix, _ in spots:
        hit = F.col("s").eqNullSafe(F.lit(s)) & (F.col("x") == prefix)
        edge = hit if edge is None else edge | hit
    ranked = keyed.where(edge).withColumn(
        "r", F.row_number().over(Window.partitionBy("s", "x").orderBy("h")))
    pick = None
    for s, _, prefix, rank in spots:
        hit = F.col("s").eqNullSafe(F.lit(s)) & (F.col("x") == prefix) & (F.col("r") == rank)
        pick = hit if pick is None else pick | hit
    values = {(row.s, row.x, row.r): row.h for row in ranked.where(pick).collect()}
    for s, i, prefix, rank in spots:
        result[s][i] = values[(s, prefix, rank)]
    return result
