"""Readers and writers."""

import pytest
from pyspark.sql import functions as F

from churnspark.contracts import SNAPSHOT, raw_schema
from churnspark.functions import columns as C
from churnspark.operators import expectations
from churnspark.sources import publish, sinks, tables

SCHEMA = "id long, amount double, name string"


def test_csv_encoding_separator_and_na_tokens(spark, tmp_path):
    from pyspark.sql.types import StructType
    path = tmp_path / "a.csv"
    path.write_bytes("id;name;amount\n1;가나;1.5\n2;NA;NaN\n3;x;\n".encode("euc-kr"))
    df = tables.read_csv(spark, str(path), StructType.fromDDL(SCHEMA), "euc-kr", ";")
    assert df.orderBy("id").collect() == [(1, 1.5, "가나"), (2, None, None), (3, None, "x")]
    only_na = tables.read_csv(spark, str(path), None, "euc-kr", ";", na_tokens=("NA",))
    assert [r.amount for r in only_na.orderBy("id").collect()] == ["1.5", "NaN", None]
    with pytest.raises(ValueError, match="missing"):
        tables.read_csv(spark, str(path), StructType.fromDDL("id long, other string"),
                        "euc-kr", ";")


def test_raw_snapshot_round_trip(spark, sf, tmp_path):
    from churnspark.plans import workspace as W
    df = W.snapshot(spark, sf)
    sinks.write_table(df, str(tmp_path / "csv"), "csv")
    back = tables.read_raw_csv(spark, str(tmp_path / "csv"), SNAPSHOT)
    names = [f.name for f in raw_schema(SNAPSHOT).fields]
    assert back.select(names).exceptAll(df.select(names)).count() == 0


def test_union_of_parts_needs_all(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(3).write.parquet(a)
    assert tables.read_parts(spark, [a, b]) is None
    spark.range(3, 5).write.parquet(b)
    assert tables.read_parts(spark, [a, b]).count() == 5


def test_split_read_prunes_partitions(spark, tmp_path):
    df = spark.range(9).withColumn("split", F.element_at(
        F.array(*map(F.lit, ("train", "val", "test"))), (F.col("id") % 3 + 1).cast("int")))
    sinks.write_by_split(df, str(tmp_path / "s"))
    part = tables.read_split(spark, str(tmp_path / "s"), "val")
    assert part.count() == 3
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan


def test_feature_list_needs_no_data(spark):
    df = spark.createDataFrame([], "a double, Churn int, b double")
    assert tables.feature_list(df, "Churn") == ["a", "b"]


def test_promotion_refuses_what_is_absent(spark, tmp_path):
    target = str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        publish.publish(spark, str(tmp_path / "no"), target)
    with pytest.raises(FileNotFoundError):
        publish.read_published(spark, target)
    spark.range(4).write.parquet(str(tmp_path / "yes"))
    publish.publish(spark, str(tmp_path / "yes"), target)
    assert publish.read_published(spark, target).count() == 4
    assert publish.manifest(spark, target)["previous"] is None


@pytest.mark.parametrize("broken", ["_switch", "parts_of", "_write_text"])
def test_a_killed_promotion_keeps_the_old_version(spark, tmp_path, monkeypatch, broken):
    old, new, target = (str(tmp_path / x) for x in ("old", "new", "out"))
    table = spark.range(6).select("id", F.when(F.col("id") < 2, "test").otherwise("train")
                                  .alias("split"))
    table.write.parquet(old)
    table.union(table).write.parquet(new)
    first = publish.publish(spark, old, target)

    def killed(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(publish, broken, killed)
        with pytest.raises(RuntimeError):
            publish.publish(spark, new, target)
    assert publish.current_version(spark, target) == first
    assert publish.read_published(spark, target).count() == 6
    second = publish.publish(spark, new, target)
    assert publish.read_published(spark, target).count() == 12
    found = publish.manifest(spark, target)
    assert (found["version"], found["previous"]) == (second, first)
    assert {p["part"]: p["n_rows"] for p in found["parts"]} == {"test": 4, "train": 8}


def test_equal_tables_are_not_joined(spark):
    a = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("double").alias("x"),
                                 F.when(F.col("id") % 5 > 0, "t").alias("y"))
    same = expectations.variant_consistency(a, a.repartition(3), "k", ["x", "y"])
    assert "Join" not in same._jdf.queryExecution().optimizedPlan().toString()
    assert tuple(same.first()) == (3000, 0, 0, 0)
    changed = a.withColumn("x", F.when(F.col("k") == 17, 100.0).otherwise(F.col("x"))) \
        .withColumn("y", F.when(F.col("k") == 18, "u").otherwise(F.col("y"))).where("k <> 19")
    extra = changed.union(spark.createDataFrame(
        [(None, 1.0, "t"), (5000, 1.0, None)], "k long, x double, y string"))
    far, equal = expectations.differing_leaves(a, extra, "k", ["x", "y"])
    assert 4 <= len(far) <= 6 and equal < 3000
    found = expectations.variant_consistency(a, extra, "k", ["x", "y"])
    assert tuple(found.first()) == (3002, 3, 1, 1)
    none = expectations.variant_consistency(a, a.where("false"), "k", ["x"])
    assert tuple(none.first()) == (3000, 3000, 0)


def test_documents(spark, tmp_path):
    doc = sinks.document(spark.range(4), {
        "n": F.count("*"), "nested": F.struct(F.max("id").alias("top"))})
    sinks.write_document(doc, str(tmp_path / "d"))
    row = tables.read_document(spark, str(tmp_path / "d")).first()
    assert row.n == 4 and row.nested.top == 3


def test_fingerprint_tells_cells_and_nulls_apart(spark):
    rows = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("<null>", "x"), ("", "x")]
    prints = {tables.table_fingerprint(spark.createDataFrame([r], "a string, b string")).first()
              for r in rows}
    assert len(prints) == len(rows)


def test_fingerprint_ignores_order_but_not_content(spark, tmp_path):
    df = spark.range(50).withColumn("x", F.when(F.col("id") % 7 != 0, F.col("id") * 2))
    base = tables.table_fingerprint(df).collect()
    assert tables.table_fingerprint(df.orderBy(F.desc("id")).repartition(3)).collect() == base
    assert tables.table_fingerprint(df.withColumn("x", F.col("id"))).collect() != base
    (tmp_path / "f.bin").write_bytes(b"abc")
    row = tables.file_fingerprint(spark, str(tmp_path / "f.bin")).first()
    assert row.sha256.startswith("ba7816bf")


def test_expectations(spark):
    df = spark.createDataFrame([("a", 0.5, "2026-07-21"), ("b", float("nan"), "2026-13-01"),
                                ("b", 1.0, None)], "k string, v double, d string")
    assert {r.k for r in expectations.expect_unique(df, ["k"]).collect()} == {"b"}
    assert expectations.expect_finite(df, ["k"], ["v"], 0.0, 1.0).count() == 2
    bad = {r.problem for r in expectations.expect_iso_date(df, ["k"], "d").collect()}
    assert bad == {"missing", "not a date"}
    assert expectations.expect_equal(df, ["k"], F.col("v"), F.lit(0.5)).count() == 2
    with pytest.raises(ValueError, match="zz"):
        expectations.expect_columns(df, ["k", "zz"])
    with pytest.raises(ValueError):
        expectations.expect_same_features(["a", "b"], ["b", "a"])
    with pytest.raises(ValueError):
        expectations.expect_same_features(["a"], ["a", "b"])


def test_scalar_functions_on_odd_input(spark):
    df = spark.createDataFrame([("12", "Yes "), ("NaN", "YES"), ("abc", None), (None, "no")],
                               "t string, l string")
    rows = df.select(C.lenient_double("t").alias("t"), C.encode_label_ci("l").alias("c"),
                     C.encode_label("l").alias("e"), C.encode_label_map("l").alias("m"),
                     C.clip(C.lenient_double("t"), 0.0, 10.0).alias("k")).collect()
    assert [r.t for r in rows] == [12.0, None, None, None]
    assert [r.c for r in rows] == [1, 1, 0, 0]
    assert [r.e for r in rows] == [0, 0, 0, 0]
    assert [r.m for r in rows] == [None] * 4
    assert [r.k for r in rows] == [10.0, None, None, None]
