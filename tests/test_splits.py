"""Predicates of equal parts: every row in exactly one, none much larger than the others."""

from statistics import median

import pytest
from pyspark.sql import functions as F

from millrace.sources.splits import split_predicates


def sizes(df, predicates):
    counts = df.agg(*[F.count_if(F.expr(f"coalesce({p}, false)")).alias(str(k)) for k, p in enumerate(predicates)]).first()
    return list(counts)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the keys are one value, a tenth are null, the rest is dense at one end."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 77).when(n % 10 == 1, None).otherwise(F.floor(F.pow(F.rand(5), 4) * 1_000_000) - 500).cast("long")
    rows = spark.range(0, 60_000, 1, 6).select(n, key.alias("k"))
    return rows.withColumn("d", F.date_add(F.lit("2000-01-01").cast("date"), (F.col("k") % 5000).cast("int"))).cache()


@pytest.mark.parametrize("column", ["k", "d"])
def test_parts_of_a_skewed_key(skewed, column):
    predicates = split_predicates(skewed, column, 24, spread="id")
    found = sizes(skewed, predicates)
    together = skewed.select(sum(F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in predicates).alias("n")).groupBy("n").count().collect()
    assert [(r["n"], r["count"]) for r in together] == [(1, 60_000)]
    filled = [n for n in found if n]
    assert max(filled) <= 2 * median(filled) and 20 <= len(filled) <= 40


def test_without_a_second_column(skewed):
    predicates = split_predicates(skewed, "k", 10)
    assert sum(sizes(skewed, predicates)) == 60_000 and "k = 77" in predicates and "k IS NULL" in predicates


@pytest.mark.parametrize(
    "rows", [[], [(None,)], [(1,)], [(1,)] * 50, [(1,), (2,)], [(None,)] * 40 + [(3,)], [(k,) for k in range(100)]]
)
def test_small_tables(spark, rows):
    df = spark.createDataFrame(rows, "k long")
    for splits in (1, 3, 7):
        assert sum(sizes(df, split_predicates(df, "k", splits, spread="k"))) == len(rows)
    with pytest.raises(ValueError):
        split_predicates(df, "k", 0)
    with pytest.raises(ValueError, match="quantiles"):
        split_predicates(df.withColumn("s", F.lit("x")), "s", 3)
