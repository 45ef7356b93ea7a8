"""Tables written on the way have a folder of their own, which can be dropped."""

import os

from churnspark.llm import common, quality_rules, suffix_dedup
from churnspark.llm.ngram_join import groups


def test_scratch_is_dropped(spark, documents):
    found = groups(documents).count()
    folder = common.scratch(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    assert found and len(os.listdir(folder)) > 3
    common.drop_scratch(spark)
    assert not os.path.exists(folder)
    assert groups(documents).count() == found


def test_columns_with_a_dot(spark):
    """Stages keep every column, whatever its name."""
    text = " ".join(f"word{i}" for i in range(60))
    docs = spark.createDataFrame([(1, text, 2), (2, text, 3), (3, "few", 4)],
                                 "doc_id long, text string, `a.b` int")
    kept = quality_rules.keep_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r["a.b"] for r in kept.collect()) == [2, 3]
    cut = suffix_dedup.drop_repeats(docs)
    assert cut.columns == docs.columns
    assert sorted((r["a.b"], r.text) for r in cut.collect()) == [(2, ""), (3, ""), (4, "few")]
