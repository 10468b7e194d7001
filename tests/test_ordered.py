"""Sliced windows must equal uncut ones, whatever the slice size, ties and skew."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tickloom.operators import ordered


@pytest.fixture(scope="module")
def ticks(spark):
    rnd = random.Random(5)
    rows = []
    for i in range(600):
        symbol = "hot" if i % 3 else rnd.choice("abcdef")
        rows.append((symbol, rnd.randrange(40), i, round(rnd.uniform(0.9, 1.1), 3), None if rnd.random() < 0.4 else i))
    return spark.createDataFrame(rows, "symbol string, t int, id int, x double, maybe int").repartition(5).cache()


def _same(left, right, tolerance=1e-9):
    a, b = (sorted(map(tuple, df.select(*sorted(left.columns)).collect()), key=repr) for df in (left, right))
    assert len(a) == len(b)
    a, b = (sorted(rows, key=lambda r: r[sorted(left.columns).index("id")]) for rows in (a, b))
    for one, two in zip(a, b):
        for p, q in zip(one, two):
            assert p == q or (isinstance(p, float) and abs(p - q) < tolerance), (one, two)


@pytest.mark.parametrize("slices", [60, 5])
@pytest.mark.parametrize("keys", [["symbol"], []])
def test_bounded_window_equals_plain(ticks, sliced, slices, keys):
    def add(df, w):
        return df.withColumns(
            {
                "back": F.lag("id", 1).over(w),
                "ahead": F.lead("id", 2).over(w),
                "seen": F.concat_ws(",", F.collect_list("id").over(w.rowsBetween(-6, 0))),
            }
        )

    sliced(slices)
    assert ordered.cut(ticks, keys, ["t", "id"]).df.select("_slice").distinct().count() > 3
    got = ordered.bounded_window(ticks, keys, ["t", "id"], 6, 2, add)
    _same(got, add(ticks, Window.partitionBy(*keys).orderBy("t", "id")))


@pytest.mark.parametrize("slices", [60, 5])
@pytest.mark.parametrize("reverse", [False, True])
def test_running_equals_plain(ticks, sliced, slices, reverse):
    wanted = {
        "total": ("sum", F.col("x")),
        "product": ("product", F.col("x")),
        "top": ("max", F.col("maybe")),
        "low": ("min", F.col("maybe")),
        "latest": ("last", F.col("maybe")),
    }
    sliced(1)
    plain = ordered.running(ticks, ["symbol"], ["t", "id"], wanted, reverse)
    plain_rows = plain.collect()
    sliced(slices)
    got = ordered.running(ticks, ["symbol"], ["t", "id"], wanted, reverse)
    _same(got, ticks.sparkSession.createDataFrame(plain_rows, plain.schema))


def test_slices_are_balanced_for_a_hot_key(spark, sliced):
    df = spark.range(20_000).select(F.lit("one").alias("symbol"), F.col("id").alias("t"))
    sliced(20)
    sizes = [r["count"] for r in ordered.cut(df, ["symbol"], ["t"]).df.groupBy("_slice").count().collect()]
    assert len(sizes) > 12 and max(sizes) < 3_000


def test_one_timestamp_may_hold_all_rows(spark, sliced):
    df = spark.range(5_000).select(F.lit("one").alias("symbol"), F.lit(1).alias("t"), "id")
    sliced(10)
    sizes = [r["count"] for r in ordered.cut(df, ["symbol"], ["t", "id"]).df.groupBy("_slice").count().collect()]
    assert max(sizes) < 2_000


@pytest.mark.parametrize("n", [1, 2, 5_000])
def test_values_at_ranks(spark, n):
    rnd = random.Random(n)
    micros = [rnd.choice([rnd.randrange(10**15), 77]) for _ in range(n)]
    df = spark.createDataFrame([(m,) for m in micros], "m long").select(F.timestamp_micros("m").alias("ts"))
    ranks = [0, n // 3, n - 1]
    assert ordered.values_at_ranks(df, "ts", lambda _: ranks) == (n, [sorted(micros)[r] for r in ranks])


def test_values_at_ranks_narrows_crowded_buckets(spark):
    df = spark.range(30_000).select(F.timestamp_micros(F.col("id") * 3 + F.lit(10**15)).alias("ts"))
    df = df.union(spark.sql("select timestamp_micros(0) as ts"))
    assert ordered.values_at_ranks(df, "ts", lambda n: [0, 1, 20_000]) == (30_001, [0, 10**15, 10**15 + 3 * 19_999])


def test_values_at_ranks_of_nothing(spark):
    assert ordered.values_at_ranks(spark.sql("select timestamp_micros(0) ts where false"), "ts", lambda n: [0]) == (0, [])


def test_first_rows_limits_before_the_shuffle(ticks):
    plan = ordered.last_rows(ticks, ["symbol"], ["t", "id"], 3)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
