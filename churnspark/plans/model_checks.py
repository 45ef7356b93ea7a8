"""Queries that certify the fitted models at full feature width, and boosting round by round."""

from __future__ import annotations

from pyspark.sql import functions as F

from churnspark.operators import certificates, models, segments
from churnspark.operators.trees import POISSON
from churnspark.plans import catalog
from churnspark.plans import workspace as W
from churnspark.plans.prepare import LABEL

ID = W.ROLES.id
SEGMENT = list(W.ROLES.segment_features)
#: Figures that must vanish are compared after so many digits.
DIGITS = 4


def _train(spark, sf):
    """Train of the production variant with all weights and the hold-out mark."""
    return models.with_weights(W.prepared(spark, sf).part("train"), LABEL, ID, W.SETTINGS)


@catalog.query
def logistic_certificate(spark, sf):
    """Size of the gradient of the penalised loss per coefficient, over all Train rows."""
    train = _train(spark, sf)
    found = certificates.logistic_gradient(W.fitted(spark, sf, models.LOGISTIC), train, LABEL,
                                           "balanced_weight")
    return found.select("column_name", F.round(F.abs("gradient"), DIGITS).alias("gradient"))


@catalog.query
def logistic_coefficients(spark, sf):
    return certificates.logistic_gradient(W.fitted(spark, sf, models.LOGISTIC), _train(spark, sf),
                                          LABEL, "balanced_weight")


@catalog.query
def tree_certificate(spark, sf):
    """Rows and weights that reach the leaves of the tree, and leaves that say otherwise."""
    return certificates.tree_leaves(W.fitted(spark, sf, models.TREE), _train(spark, sf), LABEL,
                                    "balanced_weight", W.SETTINGS.tree_leaf)


@catalog.query
def forest_certificate(spark, sf):
    """The same for every tree of the forest, over its own bootstrap and class weights."""
    return certificates.forest_leaves(W.fitted(spark, sf, models.FOREST), _train(spark, sf), LABEL,
                                      ID, W.SETTINGS)


@catalog.query
def boosting_certificate(spark, sf):
    """Rows and weights that reach the leaves of every round, and leaves that say otherwise: one
    row, as the number of rounds is the fit's own."""
    rest = _train(spark, sf).where("NOT holdout")
    found = certificates.boosted_leaves(W.fitted(spark, sf, models.BOOSTING), rest, LABEL,
                                        "boost_weight")
    return found.agg(*[f(c).alias(f"{name}_{c}") for c in ("n_rows", "weight")
                       for name, f in (("least", F.min), ("most", F.max))],
                     F.sum("n_bad_leaves").alias("n_bad_leaves"))


@catalog.query
def kmeans_certificate(spark, sf):
    """Customers of the fitted segments, coordinates, and those that are not their cluster's mean."""
    chain, df = W.fitted_segments(spark, sf), W.snapshot(spark, sf)
    assigned = segments.assign_segments(chain, df, SEGMENT, keep_scaled=True)
    nearest = chain.stages[-1]
    gaps = certificates.centre_gaps(assigned, nearest.getOrDefault(nearest.features),
                                    nearest.getOrDefault(nearest.centres))
    far = F.coalesce(F.abs(F.col("centre") - F.col("mean")) > 0.001, F.lit(True))
    return gaps.agg((F.sum("n_rows") / len(SEGMENT)).cast("bigint").alias("n_rows"),
                    F.count("*").alias("n_coordinates"), F.count_if(far).alias("n_far"))


@catalog.query
def boosting_rounds(spark, sf):
    """Hold-out loss after each round of the production model."""
    model = W.fitted(spark, sf, models.BOOSTING)
    kept = next(s for s in model.stages if isinstance(s, models.RoundLosses))
    return spark.createDataFrame(list(enumerate(kept.getLosses())), "round int, holdout_loss double")


@catalog.query
def boosting_flag_rounds(spark, sf):
    """Rounds and hold-out losses of boosting on one 0/1 feature, which has a closed form."""
    flag = (F.col("handset_web_capable") == "Yes").cast("double").alias("x")
    train = W.train_table(spark, sf).select(ID, flag, catalog._label().alias("y"))
    model = models.fit_model(models.BOOSTING, train, ["x"], "y", ID,
                             models.ModelSettings(boosting_depth=1))
    kept = next(s for s in model.stages if isinstance(s, models.RoundLosses))
    rows = [(i, round(v, 6)) for i, v in enumerate(kept.getLosses())]
    return spark.createDataFrame(rows, "round int, holdout_loss double")


def oracle_queries(SNAP: str, SPLIT: str, RARE: str, GROUPED: str) -> dict[str, str]:
    s = W.SETTINGS
    balanced = ("CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY y))")
    levels = " UNION ALL ".join(
        f"SELECT DISTINCT '{c}_' || {GROUPED if c == W.ROLES.region else c} FROM train"
        for c in W.ROLES.categorical)
    names = " UNION ALL ".join(f"SELECT '{c}' AS column_name" for c in (
        *W.ROLES.numeric, certificates.INTERCEPT))
    held = (f"substr(md5('holdout{s.seed}:' || CAST({ID} AS VARCHAR)), 1, 6) < "
            f"'{int(s.holdout_share * 16 ** 6):06x}'")
    boost = """CASE WHEN y = 1 THEN CAST((SELECT count(*) FROM train WHERE y = 0) AS DOUBLE)
    / (SELECT count(*) FROM train WHERE y = 1) ELSE 1.0 END"""
    draw = (f"('0x' || substr(md5('forest{s.seed}:' || tree || ':' || CAST({ID} AS VARCHAR)), 1, 8))"
            "::BIGINT / 4294967296.0::DOUBLE")
    draws = " + ".join(f"CAST(u >= {p!r}::DOUBLE AS INTEGER)" for p in POISSON)
    return {
        "logistic_certificate": f"""WITH {SPLIT}, {RARE}, names AS ({names} UNION ALL {levels})
SELECT column_name, 0.0::DOUBLE AS gradient FROM names WHERE column_name IS NOT NULL""",
        "tree_certificate": f"""WITH {SPLIT}, w AS (SELECT y, {balanced} AS w FROM train)
SELECT 0::INTEGER AS tree, y AS label, count(*) AS n_rows, round(sum(w), 4) AS weight,
  0::BIGINT AS n_bad_leaves, 0::BIGINT AS n_small_leaves FROM w GROUP BY y""",
        "forest_certificate": f"""WITH {SPLIT},
u AS (SELECT tree, y, {draw} AS u FROM train, range({s.forest_trees}) t(tree)),
d AS (SELECT tree, y, {draws} AS n FROM u),
c AS (SELECT tree, y, count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_draws FROM d WHERE n > 0 GROUP BY tree, y)
SELECT CAST(tree AS INTEGER) AS tree, y AS label, n_rows, n_draws,
  round(CAST(sum(n_draws) OVER (PARTITION BY tree) AS DOUBLE) / 2, 4) AS weight,
  0::BIGINT AS n_bad_leaves, 0::BIGINT AS n_small_leaves FROM c""",
        "boosting_certificate": f"""WITH {SPLIT}, w AS (SELECT {ID}, {boost} AS w FROM train),
r AS (SELECT count(*) AS n, round(sum(w), 4) AS w FROM w WHERE NOT {held})
SELECT n AS least_n_rows, n AS most_n_rows, w AS least_weight, w AS most_weight,
  0::BIGINT AS n_bad_leaves FROM r""",
        "kmeans_certificate": f"""WITH {SNAP} SELECT count(*) AS n_rows,
  {5 * len(SEGMENT)}::BIGINT AS n_coordinates, 0::BIGINT AS n_far FROM snap""",
        "boosting_flag_rounds": f"""WITH RECURSIVE {SPLIT},
w AS (SELECT CAST(handset_web_capable = 'Yes' AS INTEGER) AS x, y, {boost} AS w, {held} AS held FROM train),
g AS (SELECT coalesce(sum(w) FILTER (WHERE x = 0 AND y = 1 AND NOT held), 0) AS a1,
  coalesce(sum(w) FILTER (WHERE x = 0 AND y = 0 AND NOT held), 0) AS a0,
  coalesce(sum(w) FILTER (WHERE x = 1 AND y = 1 AND NOT held), 0) AS b1,
  coalesce(sum(w) FILTER (WHERE x = 1 AND y = 0 AND NOT held), 0) AS b0,
  coalesce(sum(w) FILTER (WHERE x = 0 AND y = 1 AND held), 0) AS ha1,
  coalesce(sum(w) FILTER (WHERE x = 0 AND y = 0 AND held), 0) AS ha0,
  coalesce(sum(w) FILTER (WHERE x = 1 AND y = 1 AND held), 0) AS hb1,
  coalesce(sum(w) FILTER (WHERE x = 1 AND y = 0 AND held), 0) AS hb0 FROM w),
f AS (SELECT 0 AS r, 0.0::DOUBLE AS fa, 0.0::DOUBLE AS fb FROM g
  UNION ALL SELECT r + 1,
    fa + CASE WHEN r = 0 THEN (a1 - a0) / (a1 + a0)
      ELSE {s.boosting_rate} * (a1 * 4 / (1 + exp(2 * fa)) - a0 * 4 / (1 + exp(-2 * fa))) / (a1 + a0) END,
    fb + CASE WHEN r = 0 THEN (b1 - b0) / (b1 + b0)
      ELSE {s.boosting_rate} * (b1 * 4 / (1 + exp(2 * fb)) - b0 * 4 / (1 + exp(-2 * fb))) / (b1 + b0) END
  FROM f, g WHERE r < {s.boosting_rounds}),
l AS (SELECT r, 2 * (ha1 * ln(1 + exp(-2 * fa)) + ha0 * ln(1 + exp(2 * fa)) + hb1 * ln(1 + exp(-2 * fb))
    + hb0 * ln(1 + exp(2 * fb))) / (ha1 + ha0 + hb1 + hb0) AS loss FROM f, g),
s AS (SELECT r, loss, min(loss) OVER (ORDER BY r ROWS BETWEEN {s.stop_patience - 1} PRECEDING AND CURRENT ROW) AS low,
    lag(loss, {s.stop_patience}) OVER (ORDER BY r) AS before FROM l),
e AS (SELECT coalesce(min(r) FILTER (WHERE low >= before - {s.stop_tolerance}), {s.boosting_rounds}) AS last FROM s)
SELECT CAST(r AS INTEGER) AS round, round(loss, 6) AS holdout_loss FROM l, e WHERE r <= last""",
    }
