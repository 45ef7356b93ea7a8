"""Scoring, streaming, what-if and the one-shot test with a model whose answer SQL can give: a tree
with one split on a 0/1 feature, fitted, stored and loaded like any other bundle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnspark.operators import models, segments
from churnspark.plans import catalog, serve
from churnspark.plans import workspace as W
from churnspark.streaming import scoring

ID = W.ROLES.id
FLAG = "web_flag"
PAIR = ["monthly_minutes", "current_equipment_days"]
SCORED = ["churn_probability", "churn_prediction", "risk_grade", "suggested_action"]


def _customers(spark, sf) -> DataFrame:
    flag = (F.col("handset_web_capable") == "Yes").cast("double").alias(FLAG)
    return W.split_table(spark, sf).select(ID, "split", flag, catalog._label().alias("y"))


def _bundle(spark, sf) -> serve.Bundle:
    def make() -> str:
        path = f"{W.folder(spark, sf)}/tree_bundle"
        train = _customers(spark, sf).where("split = 'train'")
        model = models.fit_model(models.TREE, train, [FLAG], "y", ID,
                                 models.ModelSettings(tree_depth=1, tree_leaf=1))
        serve.Bundle(model, W.THRESHOLD, [FLAG]).save(spark, path)
        return path

    return serve.Bundle.load(spark, W._once(spark, sf, "tree_bundle", make))


@catalog.query
def tree_bundle_scores(spark, sf):
    """Every customer scored by the loaded bundle."""
    scored = serve.score_customers(_customers(spark, sf).drop("y"), _bundle(spark, sf))
    return scored.select(ID, "split", *SCORED)


@catalog.query
def tree_bundle_stream(spark, sf):
    """The same plan over a stream of stored customers."""
    def run() -> str:
        base = f"{W.folder(spark, sf)}/tree_stream"
        customers = _customers(spark, sf).drop("y")
        customers.write.mode("overwrite").parquet(f"{base}/source")
        stream = scoring.customer_stream(spark, f"{base}/source", customers.schema)
        scoring.score_stream(stream, _bundle(spark, sf), f"{base}/scored",
                             f"{base}/checkpoint").awaitTermination()
        return f"{base}/scored"

    return spark.read.parquet(W._once(spark, sf, "tree_stream", run)).select(ID, "split", *SCORED)


@catalog.query
def tree_bundle_what_if(spark, sf):
    """Every customer again with and without the feature."""
    return serve.what_if(_customers(spark, sf), _bundle(spark, sf),
                         {"with": {FLAG: 1.0}, "without": {FLAG: 0.0}}, [ID])


@catalog.query
def tree_bundle_test(spark, sf):
    """The final metrics on Test, written once."""
    def run() -> str:
        path = f"{W.folder(spark, sf)}/tree_test"
        test = _customers(spark, sf).where("split = 'test'")
        serve.evaluate_once(test, _bundle(spark, sf), "y", path, models.TREE)
        return path

    return spark.read.parquet(W._once(spark, sf, "tree_test", run)).drop("evaluated_on")


@catalog.query
def feature_schema_fields(spark, sf):
    """The fields of the schema document, lists as one text."""
    doc = catalog.feature_schema(spark, sf)
    parts = [F.col(f"split.{s}_{c}").alias(f"{s}_{c}") for s in ("train", "val", "test")
             for c in ("rows", "churn_rate")]
    return doc.select(
        "target", F.col("target_meaning.0").alias("meaning_0"),
        F.col("target_meaning.1").alias("meaning_1"),
        *[F.array_join(c, ",").alias(c) for c in (
            "id_columns", "leak_suspects", "zero_fill_columns", "rare_regions_grouped_to_other")],
        *parts)


@catalog.query
def pca_two_columns(spark, sf):
    """Principal components of two scaled columns, which lie on the diagonals."""
    scaled = W.segmented(spark, sf, keep_scaled=True)
    out = segments.project_2d(scaled, PAIR, [ID])
    return out.select(ID, *[F.round(c, 5).alias(c) for c in ("PC1", "PC2")],
                      F.round("explained_variance", 6).alias("explained_variance"))


def oracle_queries(SPLIT: str, RARE: str, GROUPED: str, SEGMENTED: str, GRADE: str, actions: str,
                   metrics) -> dict[str, str]:
    score = f"""{SPLIT}, w AS (SELECT CASE WHEN handset_web_capable = 'Yes' THEN 1 ELSE 0 END AS x, y,
  CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY y)) AS w FROM train),
leaf AS (SELECT x, sum(w * y) / sum(w) AS p FROM w GROUP BY x),
tested AS (SELECT {ID}, split, y, CASE WHEN handset_web_capable = 'Yes' THEN 1 ELSE 0 END AS x FROM spl)"""
    act = f"act(risk_grade, suggested_action) AS (VALUES {actions})"
    shown = (f"round_even(p, 4) AS churn_probability, CAST(p >= 0.5::DOUBLE AS INTEGER) AS "
             f"churn_prediction, {GRADE} AS risk_grade")
    scored = (f"WITH {score}, {act}, sc AS (SELECT {ID}, split, {shown} FROM tested JOIN leaf USING (x)) "
              f"SELECT {ID}, split, {', '.join(SCORED)} FROM sc LEFT JOIN act USING (risk_grade)")
    names = W.ROLES
    levels = []
    for i, c in enumerate(names.categorical):
        value = GROUPED if c == names.region else c
        levels.append(f"SELECT {i} AS part, '{c}_' || {value} AS column_name, count(*) AS n "
                      f"FROM train WHERE {value} IS NOT NULL GROUP BY 2")
    order = [*names.median_fill, *names.zero_fill]
    raw = {c: ("TRY_CAST(handset_price AS DOUBLE)" if c == names.price else c) for c in order}
    spread = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, CAST((SELECT stddev_pop(coalesce({raw[c]}, "
        + ("0" if c in names.zero_fill else f"(SELECT median({raw[c]}) FROM train)")
        + ")) FROM train) > 0 AS INTEGER)::DOUBLE AS std" for i, c in enumerate(order, 1))
    counts = ", ".join(f"count(*) FILTER (WHERE split = '{s}') AS {s}_rows, "
                       f"round_even(avg(y) FILTER (WHERE split = '{s}'), 4) AS {s}_churn_rate"
                       for s in ("train", "val", "test"))
    a, b = (f"z_{c}" for c in PAIR)
    return {
        "tree_bundle_scores": scored,
        "tree_bundle_stream": scored,
        "tree_bundle_what_if": f"""WITH {score}, {act},
s(scenario, x) AS (VALUES ('with', 1), ('without', 0)),
sc AS (SELECT scenario, {ID}, {shown} FROM spl, s JOIN leaf USING (x))
SELECT scenario, {ID}, {', '.join(SCORED)} FROM sc LEFT JOIN act USING (risk_grade)""",
        "tree_bundle_test": f"""WITH {score},
sc AS (SELECT y, p FROM tested JOIN leaf USING (x) WHERE split = 'test'), {metrics()}
SELECT '{models.TREE}' AS model_file, (SELECT count(*) FROM sc) AS test_size,
  (SELECT round_even(avg(y), 4) FROM sc) AS churn_rate, 0.5::DOUBLE AS threshold,
  round_even(m0.pr_auc, 4) AS pr_auc, round_even(m0.roc_auc, 4) AS roc_auc,
  round_even(CAST(m0.true_positive + m0.true_negative AS DOUBLE) / (SELECT count(*) FROM sc), 4) AS accuracy,
  round_even(coalesce(CAST(m0.true_positive AS DOUBLE) / nullif(m0.true_positive + m0.false_positive, 0), 0), 4) AS precision,
  round_even(coalesce(CAST(m0.true_positive AS DOUBLE) / nullif(m0.true_positive + m0.false_negative, 0), 0), 4) AS recall,
  round_even(coalesce(2.0 * m0.true_positive / nullif(2 * m0.true_positive + m0.false_positive + m0.false_negative, 0), 0), 4) AS f1,
  m0.true_negative, m0.false_positive, m0.false_negative, m0.true_positive FROM m0""",
        "feature_names": f"""WITH {SPLIT}, {RARE}, num AS ({spread}),
lev AS ({' UNION ALL '.join(levels)}),
cat AS (SELECT {len(order)} + row_number() OVER (ORDER BY part, column_name) AS position, column_name,
  CAST(n AS DOUBLE) / (SELECT count(*) FROM train) AS mean FROM lev)
SELECT CAST(position AS INTEGER) AS position, column_name, 0.0::DOUBLE AS mean, std FROM num
UNION ALL SELECT CAST(position AS INTEGER), column_name, round(mean, 6), round(sqrt(mean - mean * mean), 6) FROM cat""",
        "feature_schema_fields": f"""WITH {SPLIT}, {RARE}
SELECT '{names.target}' AS target, '{names.negative}' AS meaning_0, '{names.positive}' AS meaning_1,
  '{names.id}' AS id_columns, '{','.join(names.leak)}' AS leak_suspects,
  '{','.join(names.zero_fill)}' AS zero_fill_columns,
  (SELECT coalesce(string_agg({names.region}, ',' ORDER BY {names.region}), '') FROM rare) AS rare_regions_grouped_to_other,
  {counts} FROM spl""",
        "pca_two_columns": f"""WITH {SEGMENTED}, r AS (SELECT sign(corr({a}, {b})) AS s FROM scaled)
SELECT {ID}, round(({a} + s * {b}) / sqrt(2), 5) AS "PC1", round(({a} - s * {b}) / sqrt(2), 5) AS "PC2",
  1.0::DOUBLE AS explained_variance FROM scaled, r""",
    }
