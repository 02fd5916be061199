import pytest
from pyspark.sql import functions as F

from tierflow.functions import round_half_up
from tierflow.operators import (
    avg_by_group,
    group_summary,
    models,
    top_groups_by_sum,
    top_n_per_group,
    yearly_trends,
)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rounding_is_half_away_from_zero_and_total(spark):
    values = [1.005, -1.005, 2.675, 0.125, 1e300, float("inf"), None, 2.00499999]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_up(F.col("v"), 2)).collect()]
    assert got == [1.01, -1.01, 2.68, 0.13, 1e300, float("inf"), None, 2.0]


def test_rounding_rounds_once(spark):
    near = spark.createDataFrame([(1.00499999999996,), (2.3449999999999998,), (2.345,)], ["v"])
    assert [r[0] for r in near.select(round_half_up(F.col("v"), 2)).collect()] == [1.0, 2.34, 2.35]


def test_top_groups_cut_on_the_unrounded_sum(spark):
    df = spark.createDataFrame(
        [("a", 1.004), ("b", 1.001), ("b", 0.002), ("c", None), ("d", 0.5), ("d", None), (None, 9.0)],
        ["k", "v"],
    )
    got = [tuple(r) for r in top_groups_by_sum(df, ["k"], "v", n=3).collect()]
    assert got == [(None, 9.0), ("a", 1.0), ("b", 1.0)]
    assert top_groups_by_sum(df, ["k"], "v", n=10).count() == 4


def test_top_groups_settles_ties(spark):
    df = spark.createDataFrame([(k, 1.0) for k in "fedcba"], ["k", "v"]).repartition(6)
    top = top_groups_by_sum(df, ["k"], "v", n=3, tie_break=["k"])
    assert [r["k"] for r in top.collect()] == ["a", "b", "c"]


def test_top_groups_plan(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", 1.0, 2.0)], ["k", "l", "v", "unused"])
    df.write.parquet(str(tmp_path / "t"))
    plan = plan_of(top_groups_by_sum(spark.read.parquet(str(tmp_path / "t")), ["k", "l"], "v"))
    assert "TakeOrderedAndProject" in plan
    assert "PushedFilters: [IsNotNull(v)]" in plan
    assert "ReadSchema: struct<k:string,l:string,v:double>" in plan
    assert plan.count("HashAggregate") == 2


RANKED = [
    ("a", 2020, 5.0),
    ("b", 2020, 5.0),
    ("c", 2020, 7.0),
    ("d", 2020, None),
    ("e", None, 1.0),
    ("f", None, 3.0),
    ("g", 2021, 2.0),
]


def test_top_n_per_group(spark):
    df = spark.createDataFrame(RANKED, ["id", "year", "v"]).repartition(4)
    top = top_n_per_group(df, ["year"], "v", n=2, rank_col="rank_in_year", tie_break=["id"])
    assert top.columns == ["id", "year", "v", "rank_in_year"]
    got = sorted((tuple(r) for r in top.collect()), key=str)
    assert got == [
        ("a", 2020, 5.0, 2),
        ("c", 2020, 7.0, 1),
        ("e", None, 1.0, 2),
        ("f", None, 3.0, 1),
        ("g", 2021, 2.0, 1),
    ]


def test_top_n_limits_each_group_before_the_shuffle(spark):
    df = spark.createDataFrame(RANKED, ["id", "year", "v"])
    plan = plan_of(top_n_per_group(df, ["year"], "v"))
    partial, shuffle = plan.index("Partial"), plan.index("Exchange")
    assert plan.count("WindowGroupLimit") == 2 and plan.index("Final") < shuffle < partial


def ranked(spark):
    """Groups of very different sizes and values: ties, copies, null keys, NaN, few values."""
    return spark.range(0, 6000, numPartitions=5).select(
        F.when(F.col("id") < 4000, "large").when(F.col("id") < 4003, "tiny").when(
            F.col("id") < 5000, F.lit("copies")
        ).alias("k"),
        F.when(F.col("id") % 7 == 0, F.lit(None))
        .when((F.col("id") >= 4003) & (F.col("id") < 5000), F.lit(1.5))
        .when(F.col("id") % 1000 == 1, F.lit(float("nan")))
        .otherwise((F.col("id") * 7919 % 613).cast("double"))
        .alias("v"),
        F.when((F.col("id") < 4003) | (F.col("id") >= 5000), F.col("id")).alias("id"),
    )


@pytest.mark.parametrize("n", [1, 5, 40])
def test_contenders_hold_the_largest(spark, n):
    df = ranked(spark)
    plain = top_n_per_group(df, ["k"], "v", n=n, tie_break=["id"])
    few = top_n_per_group(df, ["k"], "v", n=n, tie_break=["id"], few_groups=True)
    assert "BroadcastHashJoin" in plan_of(few) and few.dtypes == plain.dtypes
    assert sorted(map(str, few.collect())) == sorted(map(str, plain.collect()))


def test_contenders_leave_out_most_rows(spark):
    df = spark.range(50000).select((F.col("id") % 3).alias("k"), F.rand(1).alias("v"))
    assert 15 <= models._contenders(df, ["k"], "v", 5).count() < 300


def test_too_many_groups_are_ranked_without_bounds(spark, monkeypatch):
    monkeypatch.setattr(models, "MOST_BROADCAST_ROWS", 2)
    df = ranked(spark)
    few = top_n_per_group(df, ["k"], "v", tie_break=["id"], few_groups=True)
    assert "BroadcastHashJoin" not in plan_of(few)


def test_top_n_by_index_equals_the_window(spark, monkeypatch):
    df = spark.range(6000).select(
        "id",
        F.nullif((F.col("id") % 3).cast("int"), F.lit(2)).alias("k"),
        ((F.col("id") * 7919) % 101).cast("double").alias("v"),
    )
    deep = top_n_per_group(df, ["k"], "v", n=1500, tie_break=["id"])
    assert "WindowGroupLimit" not in plan_of(deep)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "1500")
    monkeypatch.setattr(models, "MOST_RANKED_BY_WINDOW", 1500)
    try:
        window = top_n_per_group(df, ["k"], "v", n=1500, tie_break=["id"])
        want = {tuple(r) for r in window.collect()}
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert deep.dtypes == window.dtypes
    assert {tuple(r) for r in deep.collect()} == want and len(want) == 4500


def test_avg_by_group(spark):
    df = spark.createDataFrame(
        [("x", 1.0), ("x", 2.01), ("y", None), ("y", None), (None, 4.0), ("z", None), ("z", 3.0)],
        ["genre", "d"],
    )
    got = [tuple(r) for r in avg_by_group(df, ["genre"], "d", "avg_d").collect()]
    assert got == [(None, 4.0), ("z", 3.0), ("x", 1.51), ("y", None)]


def test_group_summary_sorts_on_the_rounded_sum(spark):
    df = spark.createDataFrame(
        [("de", 1.0, 10.0), ("de", 2.5, None), ("us", 9.999, 20.0), ("fr", None, 30.0)],
        ["country", "s", "skip_rate_%"],
    )
    measures = {"total": ("sum", "s"), "skip": ("avg", "skip_rate_%")}
    got = [tuple(r) for r in group_summary(df, ["country"], measures).collect()]
    assert got == [("us", 10.0, 20.0), ("de", 3.5, 10.0), ("fr", None, 30.0)]
    by_skip = group_summary(df, ["country"], measures, order_by="skip").collect()
    assert [r["country"] for r in by_skip] == ["fr", "us", "de"]
    with pytest.raises(ValueError, match="median"):
        group_summary(df, ["country"], {"m": ("median", "s")})


def test_yearly_trends(spark):
    df = spark.createDataFrame([(2020, 1.0), (2022, 5.5), (2020, 2.0), (2021, None)], ["year", "v"])
    got = [tuple(r) for r in yearly_trends(df, "year", "v").collect()]
    assert got == [(2020, 2, 3.0, None), (2021, 1, None, None), (2022, 1, 5.5, None)]
    full = spark.createDataFrame([(2020, 1.0), (2022, 5.5)], ["year", "v"])
    assert [tuple(r) for r in yearly_trends(full, "year", "v").collect()] == [
        (2020, 1, 1.0, None),
        (2022, 1, 5.5, 4.5),
    ]


def test_a_null_year_is_not_the_year_before(spark):
    df = spark.createDataFrame([(None, 100.0), (2020, 10.0), (2021, 15.0)], "year int, v double")
    assert [tuple(r) for r in yearly_trends(df, "year", "v").collect()] == [
        (None, 1, 100.0, None),
        (2020, 1, 10.0, None),
        (2021, 1, 15.0, 5.0),
    ]


def test_yearly_trends_windows_over_years_only(spark):
    df = spark.createDataFrame([(2020, 1.0)], ["year", "v"])
    plan = plan_of(yearly_trends(df, "year", "v"))
    assert plan.index("Window ") < plan.index("HashAggregate")
