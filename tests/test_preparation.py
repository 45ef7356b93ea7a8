"""Learn on Train only, apply anywhere, store and load."""

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from churnspark.contracts import SNAPSHOT, TELECOM, VARIANTS, raw_schema
from churnspark.operators import expectations, preparation
from churnspark.plans import workspace as W
from churnspark.plans.prepare import LABEL, prepare_all, prepare_variant
from churnspark.sources.publish import read_published


@pytest.fixture(scope="module")
def split(spark, sf):
    return W.split_table(spark, sf).cache()


@pytest.fixture(scope="module")
def done(split):
    return prepare_variant(split, SNAPSHOT, "without_retention", min_count=4)


def test_train_is_standardised(done):
    stats = done.part("train").agg(*[F.avg(c).alias(f"m_{c}") for c in SNAPSHOT.numeric],
                                   *[F.stddev_pop(c).alias(f"s_{c}") for c in SNAPSHOT.numeric]
                                   ).first()
    for c in SNAPSHOT.numeric:
        assert abs(stats[f"m_{c}"]) < 1e-9 and abs(stats[f"s_{c}"] - 1) < 1e-9


def test_no_gaps_and_one_level_per_row(done):
    nulls = done.table.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in done.features]).first()
    assert sum(nulls) == 0
    credit = sum(F.col(c) for c in done.features if c.startswith("credit_rating_"))
    assert {r[0] for r in done.table.select(credit).distinct().collect()} == {1.0}


def test_other_splits_do_not_leak(split, done):
    shifted = split.withColumn("monthly_minutes", F.when(
        F.col("split") == "train", F.col("monthly_minutes")).otherwise(1e9)).withColumn(
        "credit_rating", F.when(F.col("split") == "train", F.col("credit_rating"))
        .otherwise("9-New"))
    again = prepare_variant(shifted, SNAPSHOT, "without_retention", min_count=4)
    assert again.features == done.features
    assert preparation.scaler_state(again.model) == preparation.scaler_state(done.model)
    assert again.rare_regions == done.rare_regions
    unseen = sum(F.col(c) for c in again.features if c.startswith("credit_rating_"))
    assert again.part("test").select(unseen).distinct().collect()[0][0] == 0.0


def test_variants_differ_by_leak_suspects_only(split, done):
    other = prepare_variant(split, SNAPSHOT, "with_retention", min_count=4)
    extra = expectations.extra_columns(other.table, done.table)
    assert extra == ["retention_calls", "retention_offers_accepted",
                     "made_call_to_retention_team_No", "made_call_to_retention_team_Yes"]
    shared = [c for c in done.features if c in SNAPSHOT.numeric] + [LABEL]
    row = expectations.variant_consistency(other.table, done.table, "customer_id", shared).first()
    assert row.unmatched == 0 and all(row[f"mismatch_{c}"] == 0 for c in shared)


def test_price_flag_is_optional(split):
    flagged = prepare_variant(split, SNAPSHOT, "without_retention", 4, price_flag=True)
    assert flagged.features[-1] == "handset_price_unknown"


def test_stored_preparation_gives_the_same_table(spark, split, done, tmp_path):
    done.model.write().overwrite().save(str(tmp_path / "prep"))
    loaded = PipelineModel.load(str(tmp_path / "prep"))
    again = loaded.transform(split).select("customer_id", *done.features)
    assert again.exceptAll(done.table.select("customer_id", *done.features)).count() == 0


def test_mode_tie_goes_to_the_smallest_value(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), ("c",)], "x string")
    model = preparation.ModeFill(inputCols=["x"]).fit(df)
    assert model.getState() == {"x": "a"}


def test_missing_flags_only_for_columns_with_gaps(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 3.0)], "a double, b double")
    out = preparation.MissingFlags(inputCols=["a", "b"]).fit(df).transform(df)
    assert out.columns == ["a", "b", "missing_b"]
    assert [r.missing_b for r in out.collect()] == [1.0, 0.0]


def test_zero_range_and_zero_std_scale_by_one(spark):
    df = spark.createDataFrame([(2.0,), (2.0,), (2.0,)], "a double")
    for kind in (preparation.RobustScale, preparation.PopulationScaler):
        assert kind(inputCols=["a"]).fit(df).getState() == {"a": [2.0, 1.0]}


def test_whole_preparation_job(spark, sf, tmp_path):
    made = prepare_all(W.snapshot(spark, sf), SNAPSHOT, str(tmp_path), min_count=4)
    assert set(made) == set(VARIANTS)
    processed = read_published(spark, str(tmp_path / "processed"))
    assert processed.count() == W.snapshot(spark, sf).count()
    schema = spark.read.json(str(tmp_path / "feature_schema")).first()
    assert schema.split.train_rows + schema.split.val_rows + schema.split.test_rows \
        == processed.count()


def test_telecom_contract_has_58_columns():
    schema = raw_schema(TELECOM)
    assert len(schema.fields) == 58
    assert len(TELECOM.numeric) == 33 and len(TELECOM.categorical) == 20


def test_telecom_roles_run_end_to_end(spark):
    roles = TELECOM
    rows = []
    for i in range(60):
        row = {f.name: None for f in raw_schema(roles).fields}
        row.update({c: float((i * 7 + k) % 11) for k, c in enumerate(roles.numeric)})
        row.update({c: "Yes" if (i + k) % 2 else "No" for k, c in enumerate(roles.categorical)
                    if c != roles.region})
        row.update(CustomerID=i, Churn="Yes" if i % 3 == 0 else "No",
                   HandsetPrice="Unknown" if i % 5 == 0 else str(10 * i),
                   ServiceArea=None if i % 20 == 0 else f"{'NYC' if i % 2 else 'LAX'}BRO917",
                   RetentionCalls=0.0, RetentionOffersAccepted=0.0,
                   MadeCallToRetentionTeam="No")
        rows.append(tuple(row[f.name] for f in raw_schema(roles).fields))
    df = spark.createDataFrame(rows, raw_schema(roles)).withColumn("split", F.lit("train"))
    done = prepare_variant(df, roles, "without_retention", min_count=10)
    assert done.rare_regions == ["Unknown"]
    assert done.features[:31] == list(roles.median_fill)
    assert done.features[31:33] == ["AgeHH1", "AgeHH2"]
    assert "ServiceArea_Region_Other" in done.features


def test_a_hundred_thousand_levels(spark):
    """Levels are places of one sparse vector, not columns; unseen levels have no entry."""
    n = 100_000
    train = spark.range(n).select(F.format_string("v%06d", F.col("id")).alias("c"),
                                  F.lit("x").alias("d"))
    stages = [*preparation.sparse_levels(["c", "d"], ["ix_c", "ix_d"], ["oh_c", "oh_d"]),
              VectorAssembler(inputCols=["oh_c", "oh_d"], outputCol="features")]
    model = Pipeline(stages=stages).fit(train)
    levels = preparation.level_table(spark, model, ["c", "d"])
    assert levels.count() == n + 1
    assert levels.where("position = 77 AND column_name = 'c'").first().level == "v000077"
    some = spark.createDataFrame([("v000077", "x"), ("unseen", "y"), (None, "x")],
                                 "c string, d string")
    out = model.transform(some)
    names = preparation.vector_feature_names(out)
    assert len(names) == n + 1 and names[77] == "c_v000077" and names[-1] == "d_x"
    got = [(r.features.size, list(r.features.indices)) for r in out.select("features").collect()]
    assert got == [(n + 1, [77, n]), (n + 1, []), (n + 1, [0, n])]


def test_sparse_vector_equals_wide_columns(spark, sf):
    split = W.split_table(spark, sf)
    train = split.where("split = 'train'")
    wide = prepare_variant(split, SNAPSHOT, "without_retention", 4)
    sparse = preparation.build_sparse_preparation(SNAPSHOT, 4).fit(train).transform(split)
    assert preparation.vector_feature_names(sparse) == wide.features
    a = {r.customer_id: list(r.features.toArray())
         for r in sparse.select("customer_id", "features").collect()}
    for r in wide.table.collect():
        assert [r[c] for c in wide.features] == pytest.approx(a[r.customer_id])
