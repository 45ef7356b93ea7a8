"""Models, serving, streaming and segments on small fits."""

import hashlib
import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from churnspark.contracts import SNAPSHOT
from churnspark.functions import columns as C
from churnspark.functions.playbook import GRADE_ACTION
from churnspark.operators import (
    certificates, evaluation, forest, importance, models, segments, trees)
from churnspark.plans import serve
from churnspark.plans import workspace as W
from churnspark.plans.prepare import LABEL
from churnspark.plans.train import train_and_select
from churnspark.streaming import scoring

KEY = SNAPSHOT.id
SEGMENT = list(SNAPSHOT.segment_features)
QUICK = models.ModelSettings(forest_trees=5, forest_depth=4, boosting_rounds=3, tree_leaf=5)


@pytest.fixture(scope="module")
def done(spark, sf):
    return W.prepared(spark, sf)


@pytest.fixture(scope="module")
def bundle(done):
    model = models.fit_model(models.LOGISTIC, done.part("train"), done.features, LABEL, KEY)
    return serve.Bundle(model, 0.5, done.features).check()


def noisy(spark, n=900, seed=0):
    """Two features, one with a signal that takes several rounds to learn."""
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"id": np.arange(n), "a": rng.normal(size=n), "b": rng.normal(size=n)})
    pdf["y"] = ((np.sin(3 * pdf.a) + pdf.b ** 2 + rng.normal(size=n)) > 1).astype(int)
    return spark.createDataFrame(pdf).repartition(1).cache()


def boosted(df, **settings):
    settings = models.ModelSettings(**{"boosting_rounds": 60, "boosting_depth": 2,
                                       "boosting_rate": 0.3, **settings})
    model = models.fit_model(models.BOOSTING, df, ["a", "b"], "y", "id", settings)
    return model, settings


def test_early_boosting_is_the_plain_fit_cut_short(spark):
    """The stopped model predicts like a plain fit of the same rows and number of rounds, and its
    losses are those of plain fits of as many rounds."""
    df = noisy(spark)
    model, settings = boosted(df, first_rounds=4)
    early, kept = model.stages[-2], model.stages[-1]
    assert 1 <= early.getNumTrees == kept.getRounds() < 60
    assert len(kept.getLosses()) == kept.getRounds() + 1
    marked = models.Assemble(inputCols=["a", "b"]).transform(
        models.with_weights(df, "y", "id", settings)).cache()
    rest = marked.where("NOT holdout")
    plain = models.boosting("y", settings, kept.getRounds()).fit(rest)
    want = plain.transform(rest).select("id", models.probability().alias("q"))
    got = early.transform(rest).select("id", models.probability().alias("p"))
    assert got.join(want, "id").selectExpr("max(abs(p - q))").first()[0] < 1e-9
    for rounds in (1, 3, kept.getRounds()):
        part = trees.some_trees(early, range(rounds)).transform(marked.where("holdout")).select(
            "y", "boost_weight", models.probability().alias("p")).toPandas()
        loss = -2 * np.log(np.where(part.y == 1, part.p, 1 - part.p))
        assert np.average(loss, weights=part.boost_weight) == pytest.approx(
            kept.getLosses()[rounds], abs=1e-9)


def test_patience_goes_on_where_one_round_would_stop(spark):
    df = noisy(spark, seed=3)
    long, _ = boosted(df, boosting_rate=0.6, boosting_rounds=40)
    short, _ = boosted(df, boosting_rate=0.6, boosting_rounds=40, stop_patience=1)
    a, b = long.stages[-1].getLosses(), short.stages[-1].getLosses()
    assert len(a) > len(b) + 5 and a[:len(b)] == pytest.approx(b)
    assert min(a) < min(b) - 1e-3


def test_stop_rule():
    assert trees.stop_round([5, 4, 3, 2], 2, 1e-7) is None
    assert trees.stop_round([5, 4, 4, 4], 2, 1e-7) == 3
    assert trees.stop_round([5, 4, 4.5, 3, 3.5, 3.2, 3.1], 2, 1e-7) == 5
    assert trees.stop_round([5, 5 - 1e-8, 5 - 2e-8], 2, 1e-7) == 2
    assert trees.stop_round([], 10, 1e-7) is None


def test_losses_are_stored_with_the_bundle(spark, tmp_path):
    df = noisy(spark, 400)
    model, _ = boosted(df, boosting_rounds=5)
    model.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[-1].getLosses() == model.stages[-1].getLosses()
    a, b = (models.score(m, df, ["id"]).orderBy("id").collect() for m in (model, again))
    assert a == b


def test_without_holdout_rows_all_rounds_are_kept(spark):
    df = noisy(spark, 300)
    model, _ = boosted(df, boosting_rounds=4, holdout_share=0.0)
    assert model.stages[-1].getRounds() == 4 and model.stages[-1].getLosses() == []


def test_forest_votes_with_trees_of_their_own_bootstraps(spark):
    df = noisy(spark, 500)
    settings = models.ModelSettings(forest_trees=6, forest_depth=4)
    model = models.fit_model(models.FOREST, df, ["a", "b"], "y", "id", settings)
    forest = model.stages[-1]
    assert forest.getNumTrees == 6
    rows = certificates.forest_leaves(model, df, "y", "id", settings).collect()
    assert len(rows) == 12 and all(r.n_bad_leaves == r.n_small_leaves == 0 for r in rows)
    ids = df.select("id").toPandas()["id"]
    for tree in (0, 5):
        u = [int(hashlib.md5(f"forest42:{tree}:{i}".encode()).hexdigest()[:8], 16) / 2 ** 32
             for i in ids]
        drawn = np.searchsorted(trees.POISSON, u, side="right")
        assert sum(r.n_draws for r in rows if r.tree == tree) == drawn.sum()
    vector = models.Assemble(inputCols=["a", "b"]).transform(df)
    votes = [t.transform(vector.select("id", "features")).select(
        "id", models.probability().alias("p")).toPandas().set_index("id").p for t in forest.trees]
    got = models.score(model, df, ["id"]).toPandas().set_index("id").p
    assert np.allclose(got, sum(votes) / 6)


def test_jobs_of_a_forest_do_not_grow_with_its_trees(spark):
    df, sc = noisy(spark, 300), spark.sparkContext
    sc.setJobGroup("forest_jobs", "")
    models.fit_model(models.FOREST, df, ["a", "b"], "y", "id", models.ModelSettings(forest_trees=90))
    sc.setJobGroup("others", "")
    assert len(sc.statusTracker().getJobIdsForGroup("forest_jobs")) < 90


def test_forest_of_nodes_beyond_a_task_is_whole(spark):
    df = models.Assemble(inputCols=["a", "b"]).transform(noisy(spark, 900))
    learner = RandomForestClassifier(maxDepth=9, minInstancesPerNode=8, seed=42, labelCol="y",
                                     featuresCol="features", weightCol="tree_weight")
    # nodes of more than 50 rows are split by summed histograms
    grown = forest.grow_forest(df, "y", "id", learner, 7, True, task_cells=100)
    settings = models.ModelSettings(forest_trees=7)
    rows = certificates.forest_leaves(PipelineModel(stages=[grown]), df, "y", "id",
                                      settings).collect()
    assert len(rows) == 14 and all(r.n_bad_leaves == r.n_small_leaves == 0 for r in rows)
    assert max(t.depth for t in grown.trees) > 4


def test_tree_index_gives_the_same_importance(spark):
    df = noisy(spark, 600).withColumn("c", F.lit(1.0)).withColumn("d", F.col("id") % 5 * 1.0)
    features = ["a", "b", "c", "d"]
    settings = models.ModelSettings(boosting_rounds=6, boosting_depth=3, early_stopping=False)
    model = models.fit_model(models.BOOSTING, df, features, "y", "id", settings)
    want = {r.feature: r for r in importance.permutation_importance(
        df, features, "y", "id", lambda t, keep: models.score(model, t, keep)).collect()}
    got = importance.boosted_importance(df, features, "y", "id", model).collect()
    assert {r.feature for r in got} == set(features) == set(want)
    for r in got:
        assert r.importance_mean == pytest.approx(want[r.feature].importance_mean, abs=1e-6)
        assert r.importance_std == pytest.approx(want[r.feature].importance_std, abs=1e-6)
    unused = [r for r in got if r.feature == "c"]
    assert unused[0].importance_mean == unused[0].importance_std == 0.0


def test_a_wrong_model_fails_its_certificate(spark):
    """Certificates must see a model that was fitted on other rows."""
    df = noisy(spark, 500)
    other = df.withColumn("y", 1 - F.col("y"))
    tree = models.fit_model(models.TREE, df, ["a", "b"], "y", "id")
    marked = models.with_weights(other, "y", "id")
    assert certificates.tree_leaves(tree, marked, "y", "balanced_weight", 20).first().n_bad_leaves
    logistic = models.fit_model(models.LOGISTIC, df, ["a", "b"], "y", "id")
    size = "max(abs(gradient))"
    for rows, small in ((models.with_weights(df, "y", "id"), True), (marked, False)):
        found = certificates.logistic_gradient(logistic, rows, "y", "balanced_weight")
        assert (found.selectExpr(size).first()[0] < 5e-5) == small
    model, settings = boosted(df, boosting_rounds=3)
    for rows, bad in ((df, False), (other, True)):
        rest = models.with_weights(rows, "y", "id", settings).where("NOT holdout")
        found = certificates.boosted_leaves(model, rest, "y", "boost_weight")
        assert (found.selectExpr("sum(n_bad_leaves)").first()[0] > 0) == bad


def test_fits_use_a_bounded_sample(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    some, rows = models.bounded_sample(df, "k", models.ModelSettings(max_fit_rows=1000))
    assert rows == 1000 and 850 < some.count() < 1150
    assert models.bounded_sample(df, "k", models.ModelSettings())[0].count() == 5000


def test_fits_take_all_rows_at_any_size(spark):
    """Queries, jobs and callers that set no bound fit on the whole table, 20 million rows or more."""
    df = spark.range(20_500_000).withColumnRenamed("id", "k")
    for settings in (models.ModelSettings(), W.SETTINGS):
        every, rows = models.bounded_sample(df, "k", settings)
        assert rows == every.count() == 20_500_000


def test_the_majority_model_can_be_stored(spark, tmp_path):
    from churnspark.plans.serve import Bundle, score_customers
    df = spark.createDataFrame([(1, 0.5, 1), (2, 0.1, 1), (3, 0.2, 0)], "id int, a double, y int")
    model = models.fit_model(models.DUMMY, df, ["a"], "y", "id")
    Bundle(model, 0.5, ["a"]).save(spark, str(tmp_path))
    scored = score_customers(df, Bundle.load(spark, str(tmp_path))).collect()
    assert [r.churn_probability for r in scored] == [1.0, 1.0, 1.0]


def test_comparison_covers_every_pair(done):
    sets = {"all": done.features, "few": done.features[:3]}
    table, fitted = models.compare_models(done.part("train"), done.part("val"), sets, LABEL, KEY,
                                          settings=QUICK)
    rows = table.collect()
    assert {(r.feature_set, r.model) for r in rows} == set(
        itertools.product(sets, models.MODEL_NAMES)) == set(fitted)
    n = done.part("val").count()
    for r in rows:
        assert r.true_negative + r.false_positive + r.false_negative + r.true_positive == n
        if r.model == models.DUMMY:
            assert r.roc_auc == 0.5


def test_logistic_beats_dummy_on_a_real_signal(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"id": np.arange(600), "a": rng.normal(size=600), "b": rng.normal(size=600)})
    pdf["y"] = (rng.random(600) < 1 / (1 + np.exp(-2 * pdf.a))).astype(int)
    df = spark.createDataFrame(pdf).cache()
    model = models.fit_model(models.LOGISTIC, df, ["a", "b"], "y", "id")
    row = evaluation.evaluate(models.score(model, df, ["y"]), "p", "y").first()
    assert row.roc_auc > 0.75
    table = importance.permutation_importance(
        df, ["a", "b"], "y", "id", lambda t, keep: models.score(model, t, keep),
        rows_per_bucket=100)
    rows = table.collect()
    assert rows[0].feature == "a" and rows[0].importance_mean > 0.1
    assert abs(rows[1].importance_mean) < 0.05


def test_position_is_a_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "k")
    rows = importance.with_position(df, "k", rows_per_bucket=60).collect()
    assert sorted(r._pos for r in rows) == list(range(500))
    assert {r._n for r in rows} == {500}


# ---- serving: ports of the four integration checks ------------------------------

def test_bundle_round_trip(spark, done, bundle, tmp_path):
    bundle.save(spark, str(tmp_path / "b"))
    again = serve.Bundle.load(spark, str(tmp_path / "b"))
    assert 0 < again.threshold < 1 and again.features == bundle.features
    a = serve.score_customers(done.table, bundle)
    b = serve.score_customers(done.table, again)
    assert a.exceptAll(b).count() == 0


def test_feature_count_matches_model(done, bundle):
    assert len(bundle.model.stages[1].getInputCols()) == len(done.features)
    with pytest.raises(ValueError):
        serve.Bundle(bundle.model, 0.5, done.features[:-1]).check()
    with pytest.raises(ValueError):
        serve.Bundle(bundle.model, 1.5, done.features).check()


def test_one_customer(done, bundle):
    r = serve.score_customers(done.table.orderBy(KEY).limit(1), bundle).first()
    assert 0 <= r.churn_probability <= 1 and r.churn_prediction in (0, 1)
    assert r.suggested_action == GRADE_ACTION[r.risk_grade]


def test_probability_changes_with_input(done, bundle):
    one = done.table.orderBy(KEY).limit(1)
    rows = serve.what_if(one, bundle, {"low": {"current_equipment_days": -3.0},
                                       "high": {"current_equipment_days": 3.0}}, [KEY]).collect()
    assert len({r.churn_probability for r in rows}) == 2


def test_absent_columns_are_filled(done, bundle):
    narrow = done.table.select(KEY, *done.features[:4])
    out = serve.score_customers(narrow, bundle)
    assert out.columns[:5] == narrow.columns
    assert out.where("churn_probability IS NULL").count() == 0


def test_stream_equals_batch(spark, sf, done, bundle, tmp_path):
    source = f"{W.folder(spark, sf)}/prepared/without_retention"
    stream = scoring.customer_stream(spark, source, done.table.schema, files_per_trigger=1)
    scoring.score_stream(stream, bundle, str(tmp_path / "out"),
                         str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    want = serve.score_customers(done.table, bundle)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_segment_stream_equals_batch(spark, sf, tmp_path):
    chain = W.segment_chain(spark, sf)
    snap = W.snapshot(spark, sf)
    stream = scoring.customer_stream(spark, f"{W.folder(spark, sf)}/snapshot", snap.schema)
    scoring.write_stream(segments.assign_segments(chain, stream, SEGMENT), str(tmp_path / "o"),
                         str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o")).select(KEY, "Cluster")
    assert got.exceptAll(W.segmented(spark, sf).select(KEY, "Cluster")).count() == 0


def test_final_evaluation_runs_once(done, bundle, tmp_path):
    path = str(tmp_path / "metrics")
    row = serve.evaluate_once(done.part("test"), bundle, LABEL, path, "logistic").first()
    assert row.test_size == done.part("test").count()
    with pytest.raises(FileExistsError):
        serve.evaluate_once(done.part("test"), bundle, LABEL, path, "logistic")


def test_whole_training_job(spark, sf, tmp_path):
    pair = {v: W.prepared(spark, sf, v) for v in ("with_retention", "without_retention")}
    made = train_and_select(pair, str(tmp_path), names=(models.DUMMY, models.LOGISTIC, models.TREE),
                            settings=QUICK, repeats=1)
    assert made.features == pair["without_retention"].features
    assert spark.read.parquet(str(tmp_path / "model_metrics")).count() == 6
    assert spark.read.parquet(str(tmp_path / "threshold_sweep")).count() == 5
    assert spark.read.parquet(str(tmp_path / "test_metrics")).count() == 1
    assert spark.read.parquet(str(tmp_path / "permutation_importance")).count() == \
        len(made.features)
    summary = spark.read.json(str(tmp_path / "gain_summary")).first()
    assert summary.test_n == pair["without_retention"].part("test").count()
    assert 0 <= summary.cumulative_gain.top10pct <= summary.cumulative_gain.top50pct <= 1


# ---- segments ------------------------------------------------------------------------

def test_greedy_names(spark):
    index = spark.createDataFrame(
        [(0, 90.0, 80.0, 70.0, 150.0), (1, 200.0, 300.0, 200.0, 100.0),
         (2, 120.0, 250.0, 90.0, 90.0), (3, 80.0, 90.0, 160.0, 80.0), (4, 70.0, 60.0, 80.0, 90.0)],
        "Cluster int, r double, c double, a double, t double")
    got = {r.Cluster: r.ClusterName for r in segments.segment_names(index, "r", "c", "a", "t")
           .collect()}
    assert got == {0: segments.LOYAL, 1: segments.PREMIUM, 2: segments.HIGH_MAINTENANCE,
                   3: segments.MULTI_LINE, 4: segments.REGULAR}


def test_fitted_segments_store_and_load(spark, sf, tmp_path):
    df = W.snapshot(spark, sf)
    chain = segments.fit_segments(df, SEGMENT, k=3, n_init=3)
    chain.write().overwrite().save(str(tmp_path / "s"))
    a = segments.assign_segments(chain, df, SEGMENT)
    b = segments.assign_segments(PipelineModel.load(str(tmp_path / "s")), df, SEGMENT)
    assert a.exceptAll(b).count() == 0
    assert {r.Cluster for r in a.select("Cluster").distinct().collect()} == {0, 1, 2}
    with pytest.raises(ValueError, match="monthly_revenue"):
        segments.assign_segments(chain, df.drop("monthly_revenue"), SEGMENT)


def test_silhouette_against_brute_force(spark):
    rng = np.random.default_rng(2)
    pts = np.vstack([rng.normal(c, 1, size=(40, 2)) for c in (0, 3, 9)] + [[[50.0, 50.0]]])
    lab = np.array([0] * 40 + [1] * 40 + [2] * 40 + [3])
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(121), "x": pts[:, 0], "y": pts[:, 1],
                                             "Cluster": lab}))
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(2))
    s = []
    for i in range(121):
        own = lab == lab[i]
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, lab == o].mean() for o in set(lab) - {lab[i]})
        s.append((b - a) / max(a, b))
    row = segments.silhouette(df, ["x", "y"], "k").first()
    assert row.n == 121 and row.SilhouetteScore == pytest.approx(np.mean(s), abs=1e-6)
    with pytest.raises(ValueError):
        segments.silhouette(df, ["x", "y"], "k", sample_size=10**6)


def test_more_centres_cost_less(spark, sf):
    scaled = W.segmented(spark, sf, keep_scaled=True).drop("Cluster").cache()
    rows = segments.scan_k(scaled, SEGMENT, KEY, ks=(2, 4), n_init=2).collect()
    assert rows[0].Inertia > rows[1].Inertia
    assert all(-1 <= r.SilhouetteScore <= 1 for r in rows)


def test_examples_prefer_small_keys(spark):
    df = spark.createDataFrame([(3, 0.9), (1, 0.9), (2, 0.1), (5, 0.1), (4, 0.5), (6, 0.6)],
                               "k long, p double")
    got = {r.example: r.k for r in evaluation.example_customers(df, "p", "k").collect()}
    assert got["high"] == 1 and got["low"] == 2 and got["mid"] in (4, 6)
    assert C.HIGH in GRADE_ACTION


def test_statistics_cover_all_rows_of_a_bounded_fit(spark, monkeypatch):
    df = spark.range(2000).select(
        F.col("id").alias("k"), (F.col("id") % 5 == 0).cast("int").alias("y"),
        F.when(F.col("id") % 7 > 0, F.col("id") * F.col("id") % 997).cast("double").alias("x"))
    gap = spark.createDataFrame([(0, 0, None), (1, 0, 5.0)], "k long, y int, x double")
    seen, weigh = [], models.with_weights

    def counted(train, *more):
        seen.append(train.count())
        return weigh(train, *more)

    monkeypatch.setattr(models, "with_weights", counted)
    rows = []
    for most in (50, 10_000):
        model = models.fit_model(models.LOGISTIC, df, ["x"], "y", "k",
                                 models.ModelSettings(max_fit_rows=most))
        rows.append([r.features for r in model.transform(gap).orderBy("k").collect()])
    assert seen == [2000, 2000]
    assert rows[0] == rows[1]


def test_kmeans_runs_over_blocks_of_rows(spark):
    df = noisy(spark, 600).select("id", F.col("a").alias("z_a"), F.col("b").alias("z_b"))
    vectors = segments.segment_vectors(df, ["a", "b"]).persist()
    model, cost = segments.fit_kmeans(vectors, k=3, n_init=2)
    assert model.getSolver() == "block"
    by_rows = min(KMeans(k=3, seed=seed, maxIter=300, tol=1e-4, solver="row").fit(vectors)
                  .summary.trainingCost for seed in (42, 43))
    vectors.unpersist()
    assert cost == pytest.approx(by_rows, rel=1e-9)


def test_importance_goes_through_each_table_once(spark, monkeypatch):
    """The steps do not grow with the features, and blocks give the library's margins."""
    df = noisy(spark, 400).selectExpr("*", "IF(id % 7 = 0, NULL, a * b) AS c", "id % 5 + 0.5 AS d")
    features = ["a", "b", "c", "d"]
    settings = models.ModelSettings(boosting_rounds=9, boosting_depth=4, early_stopping=False)
    model = models.fit_model(models.BOOSTING, df, features, "y", "id", settings)
    before, boosted = PipelineModel(stages=model.stages[:-1]), model.stages[-1]
    rows = before.transform(df).select("features")
    block = trees.block_trees(trees.node_table(spark, boosted), boosted.treeWeights)
    found = block.values(np.array([r.features.toArray() for r in rows.collect()]))
    want = [r.rawPrediction[1] for r in boosted.transform(rows).collect()]
    assert found.shape == (400, 9) and found.sum(axis=1) == pytest.approx(want, abs=1e-12)
    scored = []
    monkeypatch.setattr(PipelineModel, "transform",
                        lambda self, table, own=PipelineModel.transform: (
                            scored.append(1), own(self, table))[1])
    got = {r.feature: r for r in importance.boosted_importance(
        df, features, "y", "id", model).collect()}
    assert len(scored) == 1
    monkeypatch.undo()
    for r in importance.permutation_importance(
            df, features, "y", "id", lambda t, keep: models.score(model, t, keep)).collect():
        assert got[r.feature].importance_mean == pytest.approx(r.importance_mean, abs=1e-9)


def test_rounds_are_fitted_again_only_if_the_losses_leave_it_open():
    falling = [1 + 0.99 ** n for n in range(41)]  # 0.1 a round: far from a tolerance of 1e-7
    assert trees.expected_rounds(falling, 10, 1e-7) > 1000
    assert trees.expected_rounds([1 - n / 64 for n in range(41)], 10, 1e-7) == float("inf")
    near = [1 + 0.5 ** n for n in range(21)]
    assert 20 < trees.expected_rounds(near, 10, 1e-7) < 40
    assert trees.expected_rounds(near[:15], 10, 1e-7) == 0
    assert trees.expected_rounds([1.0] * 30, 10, 1e-7) == 29


def test_a_forest_in_files_is_the_model_of_the_same_forest(spark, tmp_path):
    """Beyond a number of nodes no forest is loaded on the driver: rows are sent to stored trees."""
    df = models.Assemble(inputCols=["a", "b"]).transform(noisy(spark, 700)).cache()
    learner = RandomForestClassifier(maxDepth=9, minInstancesPerNode=8, seed=42, labelCol="y",
                                     weightCol="tree_weight")
    whole, stored = (forest.grow_forest(df, "y", "id", learner, 7, True, 100, driver_nodes=n)
                     for n in (10**6, 0))
    assert isinstance(stored, forest.StoredForest) and stored.getNumTrees == 7
    assert stored.getOrDefault(stored.nodes) == whole.totalNumNodes
    PipelineModel(stages=[stored]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    assert again.stages[0].getOrDefault(again.stages[0].path).startswith(str(tmp_path))
    cols = ["id", "rawPrediction", "probability", "prediction"]
    want = whole.transform(df).orderBy("id").select(cols).collect()
    settings = models.ModelSettings(forest_trees=7)
    for model in (stored, again):
        rows = model.transform(df)
        assert rows.columns == df.columns + cols[1:]
        for a, b in zip(rows.orderBy("id").select(cols).collect(), want, strict=True):
            assert a.id == b.id and a.prediction == b.prediction
            assert a.probability.toArray() == pytest.approx(b.probability.toArray(), abs=1e-12)
            assert a.rawPrediction.toArray() == pytest.approx(b.rawPrediction.toArray(), abs=1e-11)
    a, b = (sorted(certificates.forest_leaves(PipelineModel(stages=[m]), df, "y", "id", settings)
                   .collect()) for m in (whole, stored))
    assert a == b and len(a) == 14 and not any(r.n_bad_leaves or r.n_small_leaves for r in a)


def test_no_forest_beyond_the_bound_reaches_the_driver(spark, monkeypatch):
    """A fit and its scores load no node there: the parts that do are not called."""
    df = noisy(spark, 400)
    monkeypatch.setattr(forest, "DRIVER_NODES", 0)
    for name in ("_as_model", "node_table"):
        monkeypatch.setattr(forest, name, None)
    model = models.fit_model(models.FOREST, df, ["a", "b"], "y", "id",
                             models.ModelSettings(forest_trees=4))
    assert models.score(model, df, ["id"]).where("p BETWEEN 0 AND 1").count() == 400


def test_certificate_of_a_forest_sees_leaves_that_say_otherwise(spark):
    df = noisy(spark, 500)
    settings = models.ModelSettings(forest_trees=4, forest_depth=5)
    model = models.fit_model(models.FOREST, df, ["a", "b"], "y", "id", settings)
    other = df.withColumn("y", F.when(F.col("id") % 3 == 0, 1 - F.col("y")).otherwise(F.col("y")))
    few = df.where("id % 2 = 0")
    for rows, bad, small in ((df, False, False), (other, True, False), (few, True, True)):
        found = certificates.forest_leaves(model, rows, "y", "id", settings).collect()
        assert {r.n_bad_leaves > 0 for r in found} == {bad}
        assert any(r.n_small_leaves for r in found) == small


def test_certificate_of_a_forest_goes_through_the_trees_by_blocks(spark, monkeypatch):
    """No row is made for every row and tree."""
    df = noisy(spark, 300)
    settings = models.ModelSettings(forest_trees=4, forest_depth=3)
    model = models.fit_model(models.FOREST, df, ["a", "b"], "y", "id", settings)
    for owner, name in ((certificates, "_routed"), (trees, "leaves")):
        monkeypatch.setattr(owner, name, None)
    assert certificates.forest_leaves(model, df, "y", "id", settings).count() == 8


def test_splits_of_some_nodes_at_a_time_are_those_of_all_at_once(monkeypatch):
    rng = np.random.default_rng(5)
    bins = rng.integers(0, 32, (4000, 9), dtype=np.uint8)
    y, drawn = rng.integers(0, 2, 4000, dtype=np.uint8), rng.integers(1, 4, 4000, dtype=np.uint8)
    args = (bins, y, drawn, np.array([1.1, 0.9]), 12, 4, 42, 3, 1)
    whole = forest._grow(*args)
    monkeypatch.setattr(forest, "NODES_AT_ONCE", 3)
    some = forest._grow(*args)
    assert len(whole["n"]) > 100 and all((whole[c] == some[c]).all() for c in forest.ARRAYS)
