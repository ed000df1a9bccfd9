import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import edge_docs
from tierlake.llm import mixing
from tierlake.llm.common import configure


@pytest.mark.parametrize("rate", [0.1, 1.0, 3.7, 31.0, 90.0, 2000.0])
def test_counts_are_poisson(spark, rate):
    rows = spark.range(20_000).select(mixing.poisson(F.lit(rate), 5, F.col("id").cast("string")).alias("n"))
    mean, variance = rows.agg(F.avg("n"), F.variance("n")).first()
    error = 5 * math.sqrt(rate / 20_000)
    assert abs(mean - rate) < error
    assert 0.9 < variance / rate < 1.1


def test_mixture_meets_the_targets(spark):
    configure(spark)
    docs = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise(F.concat(F.lit("b"), F.col("id") % 5)).alias("source"),
        (1 + F.col("id") % 7).alias("n_chars"))
    targets = spark.createDataFrame([("a", 1.0), ("b1", 3.0), ("b2", 0.0)], "source string, weight double")
    rows = mixing.mix(docs, targets, "n_chars").groupBy("source").agg(F.sum("n_chars").alias("n")).collect()
    sizes = {r["source"]: r["n"] for r in rows}
    assert sorted(sizes) == ["a", "b1"]
    assert sizes["b1"] / sizes["a"] == pytest.approx(3, rel=0.05)


def test_edges(spark):
    configure(spark)
    docs = edge_docs(spark)
    targets = spark.createDataFrame([("src", 1.0), (None, 1.0), ("none", 1.0), ("src", None)], "source string, weight double")
    mixed = mixing.mix(docs, targets, "n_chars")
    assert set(docs.columns) - {"copy", "rate"} <= set(mixed.columns)
    rows = mixed.collect()
    assert {r["source"] for r in rows} <= {"src"}  # the null source has no size
    per_text = Counter((r["doc_id"], r["text"]) for r in rows)
    assert per_text[(4, "same words here again and again")] == 2 * per_text[(4, "another text with id four")]
    assert mixing.mix(docs.limit(0), targets, "n_chars").count() == 0
    assert mixing.mix(docs, targets.limit(0), "n_chars").count() == 0
