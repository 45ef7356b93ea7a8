"""K-Means segments: fitting, assignment, profiling, naming, quality."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnspark.operators.preparation import (
    MedianFill, MedianFillModel, PopulationScaler, PopulationScalerModel, QuantileClip,
    QuantileClipModel)
from churnspark.operators.splitting import seeded_sample

# Segment names.
LOYAL = "Loyal Long-term Customers"
PREMIUM = "Premium Heavy Users"
MULTI_LINE = "Multi-line Customers"
REGULAR = "Regular Customers"
HIGH_MAINTENANCE = "High-Maintenance Customers"

MAX_SAMPLE = 50_000  # a silhouette sample is shipped to the tasks, so its size is bounded


def _z(c: str) -> str:
    return f"z_{c}"


def segment_preparation(features: Sequence[str]) -> Pipeline:
    """Median fill, 1 %/99 % clipping and scaling on copies named ``z_<feature>``."""
    cols = [_z(c) for c in features]
    return Pipeline(stages=[MedianFill(inputCols=cols), QuantileClip(inputCols=cols),
                            PopulationScaler(inputCols=cols)])


def with_copies(df: DataFrame, features: Sequence[str]) -> DataFrame:
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"required columns missing: {missing}")
    return df.withColumns({_z(c): F.col(c).cast("double") for c in features})


class NearestCentre(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``Cluster``: index of the nearest centre over the scaled copies."""

    features = Param(Params._dummy(), "features", "scaled columns", TypeConverters.toListString)
    centres = Param(Params._dummy(), "centres", "cluster centres", TypeConverters.identity)

    @keyword_only
    def __init__(self, *, features=None, centres=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        nearest = _nearest(self.getOrDefault(self.features), self.getOrDefault(self.centres))
        return dataset.withColumn("Cluster", nearest["i"])


def _nearest(columns: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Squared distance ``d`` to the nearest centre and its number ``i``."""
    distances = []
    for i, centre in enumerate(centres):
        d = None
        for c, v in zip(columns, centre):
            part = (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
            d = part if d is None else d + part
        distances.append(F.struct(d.alias("d"), F.lit(i).alias("i")))
    return F.array_min(F.array(*distances))


def segment_vectors(scaled: DataFrame, features: Sequence[str]) -> DataFrame:
    assembler = VectorAssembler(inputCols=[_z(c) for c in features], outputCol="features")
    return assembler.transform(scaled).select("features")


def fit_kmeans(vectors: DataFrame, k: int = 5, seed: int = 42, n_init: int = 20,
               max_iter: int = 300, tol: float = 1e-4,
               parallelism: int = 8) -> tuple[KMeansModel, float]:
    """Best of ``n_init`` runs and its training cost. Persist ``vectors`` first.

    Runs are independent Spark jobs, so several are submitted at a time.
    """
    def run(number: int) -> tuple[float, int, KMeansModel]:
        model = KMeans(k=k, seed=seed + number, maxIter=max_iter, tol=tol,
                       solver="block").fit(vectors)
        return model.summary.trainingCost, number, model

    with ThreadPool(min(parallelism, n_init)) as pool:
        cost, _, model = min(pool.map(run, range(n_init)), key=lambda r: r[:2])
    return model, cost


def fit_segments(df: DataFrame, features: Sequence[str], k: int = 5, seed: int = 42,
                 n_init: int = 20) -> PipelineModel:
    """Fitted chain: fill, clip, scale, nearest centre."""
    raw = with_copies(df, features)
    prep = segment_preparation(features).fit(raw)
    vectors = segment_vectors(prep.transform(raw), features).persist()
    try:
        kmeans, _ = fit_kmeans(vectors, k, seed, n_init)
    finally:
        vectors.unpersist()
    nearest = NearestCentre(features=[_z(c) for c in features],
                            centres=[[float(v) for v in c] for c in kmeans.clusterCenters()])
    return PipelineModel(stages=[*prep.stages, nearest])


def segments_with_centres(df: DataFrame, features: Sequence[str],
                          centres: Sequence[Sequence[float]]) -> PipelineModel:
    """Learn fill, clip and scale on ``df`` but take the centres as given."""
    prep = segment_preparation(features).fit(with_copies(df, features))
    nearest = NearestCentre(features=[_z(c) for c in features],
                            centres=[list(map(float, c)) for c in centres])
    return PipelineModel(stages=[*prep.stages, nearest])


def assign_segments(model: PipelineModel, df: DataFrame, features: Sequence[str],
                    names: DataFrame | None = None, keep_scaled: bool = False) -> DataFrame:
    """Input columns plus ``Cluster`` and, with a name table, ``ClusterName``."""
    out = model.transform(with_copies(df, features))
    if not keep_scaled:
        out = out.drop(*[_z(c) for c in features])
    if names is not None:
        out = out.join(F.broadcast(names), "Cluster", "left")  # one row per cluster
    return out


# ---- profiling ----------------------------------------------------------------------

def segment_sizes(df: DataFrame) -> DataFrame:
    counts = df.groupBy("Cluster").agg(F.count("*").alias("CustomerCount"))
    total = F.sum("CustomerCount").over(Window.partitionBy())  # one row per cluster
    return counts.withColumn("Ratio", F.round(F.col("CustomerCount") * 100.0 / total, 6))


def segment_means(df: DataFrame, features: Sequence[str], digits: int = 6) -> DataFrame:
    return df.groupBy("Cluster").agg(*[F.round(F.avg(c), digits).alias(c) for c in features])


def segment_index(df: DataFrame, features: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Segment mean in percent of the overall mean (raw values, NULLs skipped).

    The overall mean comes from the per-segment sums, so one pass is enough.
    """
    sums = df.groupBy("Cluster").agg(*[F.sum(c).alias(f"s_{c}") for c in features],
                                     *[F.count(c).alias(f"n_{c}") for c in features])
    every = Window.partitionBy()  # one row per cluster

    def index(c: str):
        overall = F.sum(f"s_{c}").over(every) / F.sum(f"n_{c}").over(every)
        value = F.col(f"s_{c}") / F.col(f"n_{c}") / overall * 100
        return (value if digits is None else F.round(value, digits)).alias(c)

    return sums.select("Cluster", *[index(c) for c in features])


def _take_highest(left: DataFrame, name: str, figure: str) -> DataFrame:
    best = F.array_max(F.transform(
        "left", lambda r: F.struct(r[figure].alias("v"), (-r["Cluster"]).alias("c"))))
    return left.withColumn(name, -best["c"]).withColumn(
        "left", F.filter("left", lambda r: r["Cluster"] != F.col(name)))


def segment_names(index: DataFrame, revenue: str, care: str, lines: str,
                  tenure: str) -> DataFrame:
    """Greedy naming of the K profile rows; equal figures go to the lower number.

    Order: highest revenue, then care calls, active lines, tenure; the first of
    the rest is regular and any further cluster stays unnamed.
    """
    left = index.agg(F.array_sort(F.collect_list(  # K rows
        F.struct("Cluster", *[F.col(c).alias(a) for c, a in (
            (revenue, "revenue"), (care, "care"), (lines, "lines"), (tenure, "tenure"))]))
    ).alias("left"))
    steps = (("premium", "revenue"), ("care_", "care"), ("multi", "lines"), ("loyal", "tenure"))
    for name, figure in steps:
        left = _take_highest(left, name, figure)
    regular = F.get(F.transform("left", lambda r: r["Cluster"]), F.lit(0))
    named = F.array(*[
        F.struct(cluster.cast("int").alias("Cluster"), F.lit(name).alias("ClusterName"))
        for cluster, name in ((F.col("loyal"), LOYAL), (F.col("premium"), PREMIUM),
                              (F.col("multi"), MULTI_LINE), (regular, REGULAR),
                              (F.col("care_"), HIGH_MAINTENANCE))])
    return left.select(F.inline(named)).where(F.col("Cluster").isNotNull())


def segment_churn(df: DataFrame, label: str) -> DataFrame:
    """Size and churn rate in percent per named segment; NULL labels are skipped."""
    return df.groupBy("Cluster", "ClusterName").agg(
        F.count("*").alias("CustomerCount"),
        F.round(F.avg(label) * 100, 6).alias("ChurnRate"))


# ---- quality ------------------------------------------------------------------------

def _silhouettes(df: DataFrame, features: Sequence[str], labels: Sequence[str], key: str,
                 sample_size: int, seed: int) -> list[tuple[int, float | None]]:
    """(rows, mean Euclidean silhouette) for each column of cluster numbers, over one sample.

    The sample, not the table, is shipped to the tasks. Each task takes its slice of it through one
    distance pass; the memberships of all clusterings stand side by side in one matrix, so further
    clusterings cost a few columns of a product. One cluster alone has no silhouette.
    """
    if sample_size > MAX_SAMPLE:
        raise ValueError(f"sample_size above {MAX_SAMPLE} does not fit the broadcast bound")
    cols = list(features)
    sample = seeded_sample(df, key, sample_size, seed).select(
        *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)],
        *[F.col(c).cast("int").alias(f"c{i}") for i, c in enumerate(labels)])
    local = sample.toPandas()  # at most MAX_SAMPLE rows
    points = local[[f"x{i}" for i in range(len(cols))]].to_numpy(dtype="float64")
    found = [np.unique(local[f"c{i}"].to_numpy(), return_inverse=True)
             for i in range(len(labels))]
    widths = [len(ids) for ids, _ in found]
    if not len(points):
        return [(0, None)] * len(labels)
    shipped = df.sparkSession.sparkContext.broadcast((points, [own for _, own in found], widths))

    def score(batches):
        all_points, owners, sizes = shipped.value
        member = np.hstack([np.eye(k)[own] for own, k in zip(owners, sizes)])
        norms = (all_points ** 2).sum(axis=1)
        total = np.zeros(len(owners))
        for batch in batches:
            rows = batch["row"].to_numpy()
            for start in range(0, len(rows), 256):
                part = rows[start:start + 256]
                at = np.arange(len(part))
                squared = (norms[part][:, None] + norms[None, :]
                           - 2 * all_points[part] @ all_points.T)
                squared[at, part] = 0.0
                sums = np.sqrt(np.maximum(squared, 0.0)) @ member
                first = 0
                for i, (own, k) in enumerate(zip(owners, sizes)):
                    if k > 1:
                        total[i] += _row_silhouettes(sums[:, first:first + k], own, k, part).sum()
                    first += k
        yield pd.DataFrame({"clustering": np.arange(len(owners)), "s": total})

    slices = df.sparkSession.sparkContext.defaultParallelism
    rows = df.sparkSession.range(0, len(points), 1, slices).select(F.col("id").alias("row"))
    sums = {r.clustering: r.s for r in rows.mapInPandas(score, "clustering int, s double")
            .groupBy("clustering").agg(F.sum("s").alias("s")).collect()}
    shipped.unpersist()
    return [(len(points), sums[i] / len(points) if k > 1 else None)
            for i, k in enumerate(widths)]


def _row_silhouettes(sums: np.ndarray, owner: np.ndarray, k: int, part: np.ndarray) -> np.ndarray:
    """Silhouettes of the sample's rows ``part`` from their summed distances to every cluster."""
    sizes, own, at = np.bincount(owner, minlength=k), owner[part], np.arange(len(part))
    a = sums[at, own] / np.maximum(sizes[own] - 1, 1)
    means = sums / sizes
    means[at, own] = np.inf
    b = means.min(axis=1)
    top = np.maximum(a, b)
    s = np.divide(b - a, top, out=np.zeros(len(part)), where=top > 0)
    return np.where(sizes[own] == 1, 0.0, s)


def silhouette(df: DataFrame, features: Sequence[str], key: str, sample_size: int = 10_000,
               seed: int = 42, cluster: str = "Cluster") -> DataFrame:
    """Mean Euclidean silhouette of a seeded sample (one row); null for a single cluster."""
    (n, value), = _silhouettes(df, features, [cluster], key, sample_size, seed)
    return df.sparkSession.createDataFrame(
        [(n, None if value is None else round(value, 6))], "n long, SilhouetteScore double")


def scan_centres(scaled: DataFrame, features: Sequence[str], key: str,
                 centres: Mapping[int, Sequence[Sequence[float]]], sample_size: int = 10_000,
                 seed: int = 42) -> DataFrame:
    """K, Inertia, SilhouetteScore of each set of centres: one projection assigns every row to all
    of them, one aggregate sums the squared distances, one sample gives all silhouettes."""
    cols = [_z(c) for c in features]
    assigned = scaled.select(key, *cols)
    for k, found in centres.items():
        nearest = _nearest(cols, found)
        assigned = assigned.withColumns({f"_c{k}": nearest["i"], f"_d{k}": nearest["d"]})
    ks = list(centres)
    costs = assigned.agg(*[F.sum(f"_d{k}").alias(f"k{k}") for k in ks]).first()
    scores = _silhouettes(assigned, cols, [f"_c{k}" for k in ks], key, sample_size, seed)
    rows = [(k, costs[f"k{k}"], None if s is None else round(s, 6))
            for k, (_, s) in zip(ks, scores)]
    return scaled.sparkSession.createDataFrame(
        rows, "K int, Inertia double, SilhouetteScore double")


def scan_k(scaled: DataFrame, features: Sequence[str], key: str, ks: Sequence[int] = range(2, 9),
           n_init: int = 10, seed: int = 42, sample_size: int = 10_000,
           parallelism: int = 8) -> DataFrame:
    """``scan_centres`` of fitted centres for each K. Persist ``scaled`` before the call.

    The starts of all K are submitted side by side.
    """
    vectors = segment_vectors(scaled, features).persist()

    def run(start: tuple[int, int]) -> tuple[int, float, int, KMeansModel]:
        k, number = start
        model = KMeans(k=k, seed=seed + number, maxIter=300, tol=1e-4,
                       solver="block").fit(vectors)
        return k, model.summary.trainingCost, number, model

    starts = [(k, number) for k in ks for number in range(n_init if k > 1 else 1)]
    try:
        vectors.count()  # cached once, before the starts ask for it together
        if 1 in ks:  # Spark's learner starts at two clusters
            mean = [[r for r in scaled.agg(*[F.avg(_z(c)) for c in features]).first()]]
        with ThreadPool(min(parallelism, len(starts))) as pool:
            done = pool.map(run, [s for s in starts if s[0] > 1], chunksize=1)
    finally:
        vectors.unpersist()
    centres = {}
    for k in ks:
        if k == 1:
            centres[k] = mean
            continue
        best = min((d for d in done if d[0] == k), key=lambda d: (d[1], d[2]))[3]
        centres[k] = [[float(v) for v in c] for c in best.clusterCenters()]
    return scan_centres(scaled, features, key, centres, sample_size, seed)


def project_2d(scaled: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """First two principal components of the scaled columns, plus explained variance.

    A component is turned so that its largest loading (the first of equal ones) is positive.
    """
    assembled = VectorAssembler(inputCols=[_z(c) for c in features], outputCol="_v") \
        .transform(scaled)
    model = PCA(k=2, inputCol="_v", outputCol="_pc").fit(assembled)
    explained = float(sum(model.explainedVariance))
    loadings = model.pc.toArray()
    size = np.abs(loadings)
    first = (size >= size.max(axis=0) - 1e-9).argmax(axis=0)
    turn = [1.0 if loadings[at, i] >= 0 else -1.0 for i, at in enumerate(first)]
    pc = vector_to_array("_pc")
    return model.transform(assembled).select(
        *keep, (pc[0] * turn[0]).alias("PC1"), (pc[1] * turn[1]).alias("PC2"),
        F.lit(explained).alias("explained_variance"))


def segment_state(model: PipelineModel) -> dict[str, dict[str, float]]:
    """Medians, bounds, means and stds per feature, for forms and state tables."""
    found: dict[str, dict[str, float]] = {}
    for stage in model.stages:
        if isinstance(stage, MedianFillModel):
            for c, v in stage.getState().items():
                found.setdefault(c[2:], {})["median"] = v
        elif isinstance(stage, QuantileClipModel):
            for c, (lo, hi) in stage.getState().items():
                found[c[2:]].update(lower=lo, upper=hi)
        elif isinstance(stage, PopulationScalerModel):
            for c, (mean, scale) in stage.getState().items():
                found[c[2:]].update(mean=mean, scale=scale)
    return found
