"""Rows picked by stored keys: those of a join, and how many of them are shuffled."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.llm import common


@pytest.fixture
def joined(spark):
    """No table is broadcast for its size."""
    key, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


def shuffled(df):
    """Records that the plan of ``df`` shuffles, exchanges used again counted once."""
    df.collect()
    found = {}

    def walk(node):
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            walk(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            walk(node.plan())
        elif kind == "ShuffleExchangeExec":
            found[node.id()] = node.metrics().apply("shuffleRecordsWritten").value()
        inner = node.children()
        for i in range(inner.size()):
            walk(inner.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found.values())


def test_rows_not_among_the_keys_are_not_shuffled(spark, joined):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("word "), 20).alias("text"))
    docs = common.materialise(docs, "docs")
    gone = docs.where("doc_id % 100 = 0")
    kept = corpus_pipeline._without(docs, gone, "doc_id")
    assert shuffled(kept) < 2_000
    assert {r.doc_id for r in kept.collect()} == {i for i in range(20_000) if i % 100}
    named = common.among(docs, common.materialise(gone.select("doc_id"), "named"), "doc_id")
    assert shuffled(named) < 2_000
    assert {r.doc_id for r in named.collect()} == set(range(0, 20_000, 100))


@pytest.mark.parametrize("most", [1, 1 << 11])
def test_without_and_among_are_joins(spark, joined, monkeypatch, most):
    """Also with null and repeated keys, keys that no row has, a column of a taken name, and a sieve that is too small."""
    monkeypatch.setattr(common, "SIEVE_MOST", most)
    rows = spark.range(-6_000, 6_000).select(F.when(F.col("id") % 7 != 0, F.col("id") * 1_000_003).alias("k"), F.col("id").alias("sieve_bits_0"))
    rows = common.materialise(rows.unionByName(rows.where("k % 5 = 0")), "rows")
    for share in ("false", "k % 3 = 0", "true"):
        keys = rows.where(share).select("k").unionByName(spark.createDataFrame([(7,), (None,)], "k long"))
        keys = common.materialise(keys if share != "false" else keys.where("false"), "keys")
        for got, how in ((common.without(rows, keys, "k"), "left_anti"), (common.among(rows, keys, "k"), "left_semi")):
            wanted = rows.join(keys, "k", how)
            assert got.columns == rows.columns
            assert got.count() == wanted.count() and got.exceptAll(wanted).isEmpty(), (share, how)
