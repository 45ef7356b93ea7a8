"""Segmentation job: K scan, fit, names, three stored tables and a bundle for new customers."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from churnspark.contracts import Roles
from churnspark.operators import segments
from churnspark.sources import sinks

# The profile figures that names are given by.
NAMING = ("monthly_revenue", "customer_care_calls", "active_subs", "months_in_service")


@dataclass
class SegmentBundle:
    """What assignment needs: fitted chain, feature names, segment names."""

    model: PipelineModel
    features: list[str]
    names: dict[int, str]

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")
        text = json.dumps({"feature_names": self.features,
                           "cluster_names": {str(k): v for k, v in self.names.items()}})
        spark.createDataFrame([(text,)], "value string").coalesce(1) \
            .write.mode("overwrite").text(f"{path}/bundle")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "SegmentBundle":
        data = json.loads(spark.read.text(f"{path}/bundle").first().value)
        return cls(PipelineModel.load(f"{path}/model"), data["feature_names"],
                   {int(k): v for k, v in data["cluster_names"].items()})

    def assign(self, df: DataFrame) -> DataFrame:
        """Input columns, ``Cluster`` and ``ClusterName``; works on streams as well."""
        names = df.sparkSession.createDataFrame(sorted(self.names.items()),
                                                "Cluster int, ClusterName string")
        return segments.assign_segments(self.model, df, self.features, names)


def run_segmentation(df: DataFrame, roles: Roles, folder: str, k: int = 5, seed: int = 42,
                     n_init: int = 20, ks: Sequence[int] = range(2, 9),
                     centres: Sequence[Sequence[float]] | None = None) -> SegmentBundle:
    """Fits and names segments and stores tables and bundle under ``folder``.

    ``segments``: customer, cluster and name; ``segment_index``: profile in percent of the mean;
    ``k_evaluation``: inertia and silhouette for each K of ``ks`` (left out if there is none).
    ``centres`` takes centres as given instead of fitting them.
    """
    spark, features = df.sparkSession, list(roles.segment_features)
    model = (segments.fit_segments(df, features, k, seed, n_init) if centres is None
             else segments.segments_with_centres(df, features, centres))
    index = segments.segment_index(segments.assign_segments(model, df, features), features, None)
    names = segments.segment_names(index, *NAMING)
    found = {r.Cluster: r.ClusterName for r in names.collect()}  # one row per cluster
    bundle = SegmentBundle(model, features, found)
    bundle.save(spark, f"{folder}/bundle")
    sinks.write_table(bundle.assign(df).select(roles.id, "Cluster", "ClusterName"),
                      f"{folder}/segments")
    sinks.write_table(index.join(names, "Cluster", "left"), f"{folder}/segment_index")
    if len(ks):
        scaled = segments.assign_segments(model, df, features, keep_scaled=True) \
            .drop("Cluster").persist()
        try:
            sinks.write_table(segments.scan_k(scaled, features, roles.id, ks, n_init, seed),
                              f"{folder}/k_evaluation")
        finally:
            scaled.unpersist()
    return bundle
