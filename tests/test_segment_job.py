"""The segmentation job stores what its bundle gives again after a reload."""

import pytest
from pyspark.sql import functions as F

from churnspark.plans import workspace as W
from churnspark.plans.segment import SegmentBundle, run_segmentation


def test_job_and_reload(spark, sf, tmp_path):
    df = W.snapshot(spark, sf)
    bundle = run_segmentation(df, W.ROLES, str(tmp_path), k=5, n_init=2, ks=(2, 3))
    again = SegmentBundle.load(spark, f"{tmp_path}/bundle")
    assert again.names == bundle.names and again.features == bundle.features
    assert len(set(again.names.values())) == 5
    stored = spark.read.parquet(f"{tmp_path}/segments")
    fresh = again.assign(df).select(W.ROLES.id, "Cluster", "ClusterName")
    assert stored.exceptAll(fresh).count() == fresh.exceptAll(stored).count() == 0
    assert spark.read.parquet(f"{tmp_path}/segment_index").count() == 5
    scan = spark.read.parquet(f"{tmp_path}/k_evaluation").orderBy("K").collect()
    assert [r.K for r in scan] == [2, 3] and scan[0].Inertia > scan[1].Inertia


def test_new_customers_need_all_features(spark, sf, tmp_path):
    df = W.snapshot(spark, sf)
    bundle = run_segmentation(df, W.ROLES, str(tmp_path), ks=(), centres=W.CENTRES)
    gaps = df.limit(5).withColumn("monthly_revenue", F.lit(None).cast("double"))
    assert bundle.assign(gaps).where("Cluster IS NULL").count() == 0
    with pytest.raises(ValueError, match="required columns"):
        bundle.assign(df.drop("monthly_revenue"))
