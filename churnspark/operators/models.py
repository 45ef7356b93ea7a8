"""The five compared classifiers on ``pyspark.ml`` and the runner for them.

Input is a prepared wide feature table (all doubles) with a 0/1 label. Each
pipeline fills gaps with medians and flags them, as the prepared table may be
extended by columns that still have gaps.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnspark.functions.columns import hash_order
from churnspark.operators import forest, trees
from churnspark.operators.evaluation import evaluate
from churnspark.operators.preparation import MedianFill, MissingFlags, RobustScale, _Columns

# Model names.
DUMMY = "Dummy (Most Frequent)"
LOGISTIC = "Logistic Regression"
TREE = "Decision Tree"
FOREST = "Random Forest"
BOOSTING = "HistGradientBoosting"
MODEL_NAMES = (DUMMY, LOGISTIC, TREE, FOREST, BOOSTING)


@dataclass(frozen=True)
class ModelSettings:
    """Hyper-parameters of the compared models."""

    seed: int = 42
    inverse_regularization: float = 0.1
    logistic_iterations: int = 2000
    tree_depth: int = 8
    tree_leaf: int = 20
    forest_trees: int = 350
    forest_leaf: int = 8
    forest_depth: int = 30  # the limit of Spark ML; the compared forest has none
    forest_bootstrap: bool = True
    boosting_rate: float = 0.06
    boosting_rounds: int = 300
    boosting_depth: int = 5  # level-wise stand-in for 31 leaves
    holdout_share: float = 0.1
    early_stopping: bool = True
    stop_patience: int = 10  # rounds in a row without a gain end the fit
    stop_tolerance: float = 1e-7  # gain of the hold-out loss that counts
    first_rounds: int = 40  # rounds of the first fit; doubled while the loss still falls
    max_fit_rows: int | None = None  # fits take all rows; a caller may ask for a trial on fewer


def with_weights(train: DataFrame, label: str, key: str,
                 settings: ModelSettings = ModelSettings()) -> DataFrame:
    """Adds balanced and boosting weights and the boosting hold-out mark.

    The class counts are one row, read as a scalar subquery.
    """
    n = train.agg(F.struct(F.count_if(F.col(label) == 0).alias("neg"),
                           F.count_if(F.col(label) == 1).alias("pos"))).scalar()
    total = n["neg"] + n["pos"]
    positive = F.col(label) == 1
    digits = 6
    limit = format(int(settings.holdout_share * 16 ** digits), f"0{digits}x")
    return train.withColumns({
        "balanced_weight": total / (2 * F.when(positive, n["pos"]).otherwise(n["neg"])),
        "boost_weight": F.when(positive, n["neg"] / n["pos"]).otherwise(1.0),
        "holdout": F.substring(hash_order(f"holdout{settings.seed}", key), 1, digits) < limit,
    })


class MostFrequent(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Majority-class baseline: probability 1 of the majority label for everyone."""

    majority = Param(Params._dummy(), "majority", "the label of most Train rows",
                     TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, majority: int = 0):
        super().__init__()
        self._set(**self._input_kwargs)

    @classmethod
    def fit(cls, train: DataFrame, label: str) -> "MostFrequent":
        row = train.agg(F.count_if(F.col(label) == 1).alias("pos"),
                        F.count("*").alias("n")).first()
        return cls(majority=int(row.pos * 2 > row.n))

    def _transform(self, dataset):
        one = float(self.getOrDefault(self.majority))
        vector = array_to_vector(F.array(F.lit(1.0 - one), F.lit(one)))
        return dataset.withColumn("probability", vector)


def probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


class Assemble(Transformer, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Vector of the feature columns plus the missing flags the model has learned."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset):
        cols = self.getInputCols()
        flags = [f"missing_{c}" for c in cols if f"missing_{c}" in dataset.columns]
        return VectorAssembler(inputCols=cols + flags, outputCol="features").transform(dataset)


class RoundLosses(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the hold-out loss after 0, 1, 2 ... rounds beside a boosted model; changes no row."""

    losses = Param(Params._dummy(), "losses", "loss after each round", TypeConverters.toListFloat)
    rounds = Param(Params._dummy(), "rounds", "rounds of the model", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, losses=None, rounds=0):
        super().__init__()
        self._set(**self._input_kwargs)

    def getLosses(self) -> list[float]:
        return self.getOrDefault(self.losses)

    def getRounds(self) -> int:
        return self.getOrDefault(self.rounds)

    def _transform(self, dataset):
        return dataset


def boosting(label: str, settings: ModelSettings, rounds: int | None = None) -> GBTClassifier:
    return GBTClassifier(
        stepSize=settings.boosting_rate, maxIter=rounds or settings.boosting_rounds,
        maxDepth=settings.boosting_depth, weightCol="boost_weight", seed=settings.seed,
        featuresCol="features", labelCol=label)


def fit_boosting(table: DataFrame, label: str, settings: ModelSettings) -> list:
    """Boosted model and the losses of its rounds, as stages.

    With early stopping, rows marked ``holdout`` are kept out of the fit; their loss after every
    round is read off the fitted trees in one pass. The model ends at the first round after which
    ``stop_patience`` rounds gained no more than ``stop_tolerance``, at every size. As a round never depends on later ones,
    fits of 40, 80, 160 ... rounds are tried until that round is among them; rounds that the
    losses show to be needed are not left to a later fit (``trees.expected_rounds``).
    """
    s = settings
    if not s.early_stopping:
        return [boosting(label, s).fit(table)]
    rest, held = table.where("NOT holdout"), table.where("holdout")
    rounds = min(s.first_rounds, s.boosting_rounds)
    while True:
        model = boosting(label, s, rounds).fit(rest)
        losses = trees.staged_losses(model, held, label, "boost_weight")
        stop = None if losses is None else trees.stop_round(
            losses, s.stop_patience, s.stop_tolerance)
        if stop is not None or rounds >= s.boosting_rounds:
            break
        expected = 0 if losses is None else trees.expected_rounds(
            losses, s.stop_patience, s.stop_tolerance)
        rounds = int(min(max(2 * rounds, expected), s.boosting_rounds))
    kept = rounds if stop is None else stop
    return [trees.some_trees(model, range(kept)),
            RoundLosses(losses=(losses or [])[:kept + 1], rounds=kept)]


def fit_forest(table: DataFrame, label: str, key: str, settings: ModelSettings):
    """A forest whose trees have bootstraps and class weights of their own, voting together.

    Row draws are Poisson variables from a hash of tree and ``key``; within a tree's bootstrap a row of
    class c weighs draws * n / (2 n_c), n and n_c being that bootstrap's draws. All trees grow in
    the same jobs. A bootstrap without rows (tiny tables) gives no tree.
    """
    s = settings
    learner = RandomForestClassifier(
        numTrees=1, bootstrap=False, featureSubsetStrategy="sqrt",
        minInstancesPerNode=s.forest_leaf, maxDepth=s.forest_depth, weightCol="tree_weight",
        seed=s.seed, featuresCol="features", labelCol=label)
    return forest.grow_forest(table, label, key, learner, s.forest_trees, s.forest_bootstrap)


def build_model(name: str, features: Sequence[str], label: str, train_rows: int,
                settings: ModelSettings = ModelSettings()) -> Pipeline:
    s = settings
    cols = list(features)
    common = {"featuresCol": "features", "labelCol": label}
    fill = [MissingFlags(inputCols=cols), MedianFill(inputCols=cols)]
    if name == LOGISTIC:
        # the balanced weights sum to the number of rows
        scale = [RobustScale(inputCols=cols)]
        core = LogisticRegression(
            weightCol="balanced_weight", standardization=False, elasticNetParam=0.0,
            regParam=1.0 / (s.inverse_regularization * max(train_rows, 1)),
            maxIter=s.logistic_iterations, **common)
        return Pipeline(stages=[*fill, *scale, Assemble(inputCols=cols), core])
    if name == TREE:
        core = DecisionTreeClassifier(
            maxDepth=s.tree_depth, minInstancesPerNode=s.tree_leaf,
            weightCol="balanced_weight", seed=s.seed, **common)
    elif name in (FOREST, BOOSTING):
        return Pipeline(stages=[*fill, Assemble(inputCols=cols)])  # their fits are functions
    else:
        raise ValueError(f"unknown model: {name}")
    return Pipeline(stages=[*fill, Assemble(inputCols=cols), core])


def bounded_sample(train: DataFrame, key: str, settings: ModelSettings) -> tuple[DataFrame, int]:
    """All rows and their count; if the caller has set ``max_fit_rows``, about so many, those whose
    key hashes lowest. No job and no query sets it."""
    rows = train.count()
    if settings.max_fit_rows is None:
        return train, rows
    digits = 8
    share = min(1.0, settings.max_fit_rows / max(rows, 1))
    limit = int(share * 16 ** digits)
    order = F.conv(F.substring(hash_order(f"fit{settings.seed}", key), 1, digits), 16, 10)
    return train.where(order.cast("bigint") < limit), min(rows, settings.max_fit_rows)


def fit_model(name: str, train: DataFrame, features: Sequence[str], label: str, key: str,
              settings: ModelSettings = ModelSettings()):
    """Fit one model. Persist ``train`` first when several are fitted."""
    return fit_models([name], train, features, label, key, settings)[name]


def fit_models(names: Iterable[str], train: DataFrame, features: Sequence[str], label: str,
               key: str, settings: ModelSettings = ModelSettings(),
               parallelism: int = 4) -> dict[str, object]:
    """Fit several models side by side on one Train.

    Gaps are learned and filled once for all models; the learners share one persisted table of
    vectors, the logistic model one of scaled vectors. Medians, scaling, class weights and
    learners take all rows, unless the caller has set ``max_fit_rows`` for a trial of the learners.
    """
    names, cols = list(names), list(features)
    done: dict[str, object] = {}
    if DUMMY in names:
        done[DUMMY] = PipelineModel(stages=[MostFrequent.fit(train, label)])
    learners = [n for n in names if n != DUMMY]
    if not learners:
        return done
    weighted = with_weights(train.select(key, label, *cols), label, key, settings)
    fills = Pipeline(stages=[MissingFlags(inputCols=cols), MedianFill(inputCols=cols)]).fit(weighted)
    filled = fills.transform(weighted)
    table, rows = bounded_sample(filled, key, settings)
    pipelines = {n: build_model(n, cols, label, rows, settings).getStages()[2:] for n in learners}
    scaled = any(n == LOGISTIC for n in learners)
    plain = [n for n in learners if n != LOGISTIC]
    kept = [key, label, "balanced_weight", "boost_weight", "holdout"]
    tables = []

    def vectors(stages) -> tuple[list, DataFrame]:
        chain = Pipeline(stages=stages).fit(filled)
        ready = chain.transform(table).select("features", *kept).persist()
        tables.append(ready)
        return chain.stages, ready

    try:
        shared = vectors([Assemble(inputCols=cols)]) if plain else None
        own = vectors(pipelines[LOGISTIC][:-1]) if scaled else None

        def fit(name: str):
            before, table = own if name == LOGISTIC else shared
            if name == BOOSTING:
                last = fit_boosting(table, label, settings)
            elif name == FOREST:
                last = [fit_forest(table, label, key, settings)]
            else:
                last = [pipelines[name][-1].fit(table)]
            return PipelineModel(stages=[*fills.stages, *before, *last])

        with ThreadPool(min(parallelism, len(learners))) as pool:
            done.update(zip(learners, pool.map(fit, learners)))
    finally:
        for table in tables:
            table.unpersist()
    return {n: done[n] for n in names}


def score(model, df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``keep`` columns plus the churn probability ``p``."""
    return model.transform(df).select(*keep, probability().alias("p"))


def compare_models(train: DataFrame, validation: DataFrame,
                   feature_sets: dict[str, Sequence[str]], label: str, key: str,
                   names: Sequence[str] = MODEL_NAMES, threshold: float = 0.5,
                   settings: ModelSettings = ModelSettings()) -> tuple[DataFrame, dict]:
    """Fit every model on every feature set; one metric row per pair.

    Validation scores of all pairs are stacked and evaluated as groups, so
    there is one ranking job instead of one per model.
    """
    stacked, fitted = None, {}
    for feature_set, features in feature_sets.items():
        models = fit_models(names, train, features, label, key, settings)
        for name, model in models.items():
            fitted[(feature_set, name)] = model
            scored = score(model, validation, [label]).select(
                F.lit(feature_set).alias("feature_set"), F.lit(name).alias("model"), label, "p")
            stacked = scored if stacked is None else stacked.unionByName(scored)
    return evaluate(stacked, "p", label, threshold, ["feature_set", "model"]), fitted
