"""Queries for readers, writers and stored models: written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.contracts import VARIANTS
from churnspark.operators import evaluation, expectations, models, profiling
from churnspark.plans import catalog
from churnspark.plans import workspace as W
from churnspark.plans.prepare import LABEL
from churnspark.plans.segment import SegmentBundle, run_segmentation
from churnspark.plans.serve import Bundle, score_customers
from churnspark.sources import publish, sinks, tables

ID = W.ROLES.id
NO_VALUE = "n.a."


def _path(spark, sf: str, name: str) -> str:
    return f"{W.folder(spark, sf)}/round_trips/{name}"


def _once(spark, sf: str, name: str, write) -> str:
    path = _path(spark, sf, name)

    def make() -> str:
        write(path)
        return path

    return W._once(spark, sf, f"round_trip/{name}", make)


def _schema(df: DataFrame) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])


@catalog.query
def csv_encoded(spark, sf):
    """All columns in another encoding and separator, with a text that needs the encoding."""
    df = W.snapshot(spark, sf).withColumn(
        "note", F.concat(F.lit("café; "), F.col(ID).cast("string")))
    path = _once(spark, sf, "csv_encoded", lambda p: df.write.mode("overwrite").csv(
        p, header=True, sep=";", encoding="iso-8859-1"))
    return tables.read_csv(spark, path, _schema(df), encoding="iso-8859-1", sep=";")


@catalog.query
def csv_na_token(spark, sf):
    """All columns with one explicit token for missing values; other usual tokens stay texts."""
    df = W.snapshot(spark, sf)
    path = _once(spark, sf, "csv_na_token", lambda p: df.write.mode("overwrite").csv(
        p, header=True, nullValue=NO_VALUE))
    return tables.read_csv(spark, path, _schema(df), na_tokens=(NO_VALUE,))


@catalog.query
def feature_list_of_header(spark, sf):
    """Names and order of all features, as the header of the stored feature table gives them."""
    done = W.prepared(spark, sf).table
    path = _once(spark, sf, "feature_table", lambda p: sinks.write_table(done, p, "csv"))
    header = tables.read_csv(spark, path)
    names = tables.feature_list(header, LABEL, [ID, "split"])
    return header.agg(F.count("*").alias("n_rows")).select(
        F.posexplode(F.array(*map(F.lit, names))).alias("position", "column_name"), "n_rows")


@catalog.query
def metrics_read_back(spark, sf):
    metrics = catalog.metrics_long(spark, sf)
    path = _once(spark, sf, "metrics", lambda p: sinks.write_table(metrics, p, "csv"))
    return tables.read_csv(spark, path, _schema(metrics))


@catalog.query
def split_variants_written(spark, sf):
    """The whole feature tables of both variants by split: columns, rows, values and label rate as
    each split's folder gives them."""
    parts = []
    for variant in VARIANTS:
        done = W.prepared(spark, sf, variant)
        path = _once(spark, sf, f"variant_{variant}",
                     lambda p, t=done.table: sinks.write_by_split(t, p))
        for s in ("train", "val", "test"):
            table = tables.read_split(spark, path, s)
            features = [F.col(f"`{c}`") for c in tables.feature_list(table, LABEL, [ID, "split"])]
            parts.append(table.agg(
                F.count("*").alias("n_rows"), F.round(F.avg(LABEL), 6).alias("churn_rate"),
                sum((F.count(c) for c in features), F.lit(0)).cast("bigint").alias("n_values"))
                .select(F.lit(variant).alias("variant"), F.lit(s).alias("split"),
                        F.lit(len(features)).cast("bigint").alias("n_features"), "*"))
    return tables.union_parts(parts)


@catalog.query
def variant_promoted(spark, sf):
    """The whole feature table of the chosen variant, read as the published version."""
    split_variants_written(spark, sf)
    source = _path(spark, sf, f"variant_{VARIANTS[-1]}")

    def write(path: str) -> None:
        publish.publish(spark, source, path)

    table = publish.read_published(spark, _once(spark, sf, "promoted", write))
    return catalog.shown_features(table, W.prepared(spark, sf, VARIANTS[-1]).features)


@catalog.query
def publication_manifest(spark, sf):
    """Rows and row hashes of the published parts, recomputed from the files of the version."""
    variant_promoted(spark, sf)
    target = _path(spark, sf, "promoted")
    stored = {p["part"]: p for p in publish.manifest(spark, target)["parts"]}
    table = publish.read_published(spark, target)
    seen = publish.parts_of(table, "split")
    return spark.createDataFrame(
        [(p["part"], p["n_rows"], p == stored[p["part"]]) for p in seen],
        "split string, n_rows long, as_published boolean")


@catalog.query
def document_read_back(spark, sf):
    """A nested JSON document with overall figures."""
    df = sinks.document(W.snapshot(spark, sf), {
        "customers": F.count("*"), "with_area": F.count(W.ROLES.area),
        "span": F.struct(F.min(ID).alias("first"), F.max(ID).alias("last"))})
    path = _once(spark, sf, "document", lambda p: sinks.write_document(df, p))
    return tables.read_document(spark, path).select(
        "customers", "with_area", F.col("span.first").alias("first"),
        F.col("span.last").alias("last"))


@catalog.query
def columns_by_type(spark, sf):
    df = W.snapshot(spark, sf)
    names = profiling.numeric_columns(df, [ID])
    return df.agg(F.count("*").alias("n_rows")).select(
        F.explode(F.array(*map(F.lit, names))).alias("column_name"), "n_rows")


@catalog.query
def required_columns(spark, sf):
    """Columns asked for that the snapshot lacks, beside what it holds."""
    df = expectations.expect_columns(W.snapshot(spark, sf), [ID, W.ROLES.area])
    lacking = expectations.missing_columns(df, [ID, "absent_one", W.ROLES.price, "absent_two"])
    return df.agg(F.count("*").alias("n_rows")).select(
        F.explode(F.array(*map(F.lit, lacking))).alias("column_name"), "n_rows")


@catalog.query
def feature_order(spark, sf):
    """Passes only if stored table and fitted preparation agree in number and order."""
    done = W.prepared(spark, sf)
    stored = [c for c in done.table.columns if c in done.features]
    expectations.expect_same_features(stored, done.features)
    return done.table.agg(F.count("*").alias("n_rows"))


@catalog.query
def column_difference(spark, sf):
    """Columns that the variant with the leak suspects has beyond the other, with their means."""
    wide, narrow = (W.prepared(spark, sf, v).table for v in VARIANTS)
    extra = [c for c in expectations.extra_columns(wide, narrow)
             if c in W.ROLES.leak_numeric]
    return wide.agg(*[F.count(c).alias(c) for c in extra]).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in extra])))


@catalog.query
def majority_bundle(spark, sf):
    """The majority model, stored, loaded again and used for scoring."""
    def write(path: str) -> None:
        train = W.train_table(spark, sf).select(ID, "age_hh1", _label().alias("y"))
        model = models.fit_model(models.DUMMY, train, ["age_hh1"], "y", ID)
        Bundle(model, W.THRESHOLD, ["age_hh1"]).save(spark, path)

    bundle = Bundle.load(spark, _once(spark, sf, "majority", write))
    scored = score_customers(W.snapshot(spark, sf).select(ID, "age_hh1"), bundle)
    return scored.select(ID, "churn_probability", "churn_prediction")


@catalog.query
def segment_job(spark, sf):
    """Segments from the stored bundle of a job with fixed centres, for all customers."""
    df = W.snapshot(spark, sf)
    path = _once(spark, sf, "segment_job", lambda p: run_segmentation(
        df, W.ROLES, p, ks=(), centres=W.CENTRES))
    named = SegmentBundle.load(spark, f"{path}/bundle").assign(df)
    stored = spark.read.parquet(f"{path}/segments").withColumnRenamed("ClusterName", "stored_name")
    return named.join(stored, [ID, "Cluster"]).select(ID, "Cluster", "ClusterName", "stored_name")


def _label():
    return catalog._label()


@catalog.query
def unscored_rows(spark, sf):
    return evaluation.unscored_rows(W.snapshot(spark, sf), "perc_change_revenues")


@catalog.query
def gain_curve_text_key(spark, sf):
    """The gain curve with a text key, in many buckets with scores tied across them."""
    df = W.formula_scores(spark, sf).select(
        F.format_string("C%09d", F.col(ID)).alias("key"), "y", F.round("p", 1).alias("p"))
    return evaluation.gain_curve(df, "p", "y", "key", rows_per_bucket=50)


# ---- learners where the answer has a closed form -------------------------------------------

def _on_one_flag(spark, sf, name: str, digits: int, **settings) -> DataFrame:
    """Probability for both values of one 0/1 feature."""
    flag = (F.col("handset_web_capable") == "Yes").cast("double").alias("x")
    train = W.train_table(spark, sf).select(ID, flag, _label().alias("y"))
    model = models.fit_model(name, train, ["x"], "y", ID, models.ModelSettings(**settings))
    # the chain may scale x, so the value is kept beside it
    values = train.groupBy("x").agg(F.count("*").alias("n")).withColumn("value", F.col("x"))
    return models.score(model, values, ["value", "n"]).select(
        F.col("value").alias("x"), "n", F.round("p", digits).alias("p"))


@catalog.query
def tree_one_split(spark, sf):
    return _on_one_flag(spark, sf, models.TREE, 6, tree_depth=1, tree_leaf=1)


@catalog.query
def forest_one_tree(spark, sf):
    return _on_one_flag(spark, sf, models.FOREST, 6, forest_trees=1, forest_depth=1, forest_leaf=1,
                        forest_bootstrap=False)


@catalog.query
def boosting_one_round(spark, sf):
    return _on_one_flag(spark, sf, models.BOOSTING, 6, boosting_rounds=1, boosting_depth=1,
                        early_stopping=False)


@catalog.query
def logistic_one_flag(spark, sf):
    return _on_one_flag(spark, sf, models.LOGISTIC, 3, inverse_regularization=1e9)


_WEIGHTED = """w AS (SELECT CASE WHEN handset_web_capable = 'Yes' THEN 1.0::DOUBLE ELSE 0.0 END AS x, y,
  CAST(count(*) OVER () AS DOUBLE) / (2 * count(*) OVER (PARTITION BY y)) AS balanced,
  CASE WHEN y = 1 THEN CAST((SELECT count(*) FROM train WHERE y = 0) AS DOUBLE)
    / (SELECT count(*) FROM train WHERE y = 1) ELSE 1.0 END AS boost FROM train)"""


def oracle_queries(SNAP: str, SPLIT: str, SCORE: str, NAMED: str, sql: dict[str, str]) -> dict[str, str]:
    """Twins; the arguments are table expressions shared with the other twins."""
    share = (f"WITH {SPLIT}, {_WEIGHTED} SELECT x, count(*) AS n, "
             "round(sum(balanced * y) / sum(balanced), {d}) AS p FROM w GROUP BY x")
    return {
        "csv_encoded": f"WITH {SNAP} SELECT *, 'caf' || chr(233) || '; ' || CAST({ID} AS VARCHAR) AS note FROM snap",
        "csv_na_token": f"WITH {SNAP} SELECT * FROM snap",
        "feature_list_of_header": f"""WITH named AS ({sql['feature_names']}), {SNAP}
SELECT CAST(position - 1 AS INTEGER) AS position, column_name, (SELECT count(*) FROM snap) AS n_rows FROM named""",
        "metrics_read_back": sql["metrics_long"],
        "split_variants_written": f"""SELECT variant, split, n_features, n_rows, churn_rate,
  n_features * n_rows AS n_values FROM ({sql['feature_variants']})""",
        "variant_promoted": sql["prepared_features"],
        "publication_manifest": f"""WITH {SPLIT} SELECT split, count(*) AS n_rows, true AS as_published
FROM spl GROUP BY split""",
        "document_read_back": f"""WITH {SNAP} SELECT count(*) AS customers, count(service_area) AS with_area,
  min({ID}) AS first, max({ID}) AS last FROM snap""",
        "columns_by_type": f"""WITH {SNAP} SELECT column_name, (SELECT count(*) FROM snap) AS n_rows
FROM (VALUES {', '.join(f"('{c}')" for c in (
            "monthly_revenue", "perc_change_revenues", "monthly_minutes", "overage_minutes",
            "total_recurring_charge", "perc_change_minutes", "dropped_blocked_calls",
            "customer_care_calls", "active_subs", "months_in_service", "current_equipment_days",
            "age_hh1", "age_hh2", "retention_calls", "retention_offers_accepted"))}) v(column_name)""",
        "column_difference": f"""WITH {SNAP} SELECT 'retention_calls' AS column_name, count(*) AS n_values FROM snap
UNION ALL SELECT 'retention_offers_accepted', count(*) FROM snap""",
        "required_columns": f"""WITH {SNAP} SELECT column_name, (SELECT count(*) FROM snap) AS n_rows
FROM (VALUES ('absent_one'), ('absent_two')) v(column_name)""",
        "feature_order": f"WITH {SNAP} SELECT count(*) AS n_rows FROM snap",
        "majority_bundle": f"""WITH {SPLIT}, m AS (SELECT CASE WHEN 2 * sum(y) > count(*) THEN 1 ELSE 0 END AS one FROM train)
SELECT {ID}, CAST(one AS DOUBLE) AS churn_probability, one AS churn_prediction FROM spl, m""",
        "segment_job": f"""WITH {NAMED} SELECT {ID}, "Cluster", "ClusterName", "ClusterName" AS stored_name
FROM seg LEFT JOIN names USING ("Cluster")""",
        "unscored_rows": f"""WITH {SNAP} SELECT count(*) AS n_rows,
  count(*) FILTER (WHERE perc_change_revenues IS NULL) AS n_unscored FROM snap""",
        "gain_curve_text_key": f"""WITH {SCORE}, r AS (SELECT {ID}, y, round(p, 1) AS p FROM sc),
g AS (SELECT row_number() OVER w AS position, sum(y) OVER w AS cp FROM r WINDOW w AS (ORDER BY p DESC, {ID}
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT position, round(CAST(position AS DOUBLE) / (SELECT count(*) FROM r), 6) AS contacted_share,
       round(CAST(cp AS DOUBLE) / (SELECT sum(y) FROM r), 6) AS gain FROM g
UNION ALL SELECT 0, 0.0, 0.0""",
        "tree_one_split": share.format(d=6),
        "forest_one_tree": share.format(d=6),
        "logistic_one_flag": share.format(d=3),
        "boosting_one_round": f"""WITH {SPLIT}, {_WEIGHTED} SELECT x, count(*) AS n,
  round(1 / (1 + exp(-2 * sum(boost * (2 * y - 1)) / sum(boost))), 6) AS p FROM w GROUP BY x""",
    }
