import math
import random
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tierflow.operators import (
    avg_by_group,
    exact_sums,
    group_summary,
    top_groups_by_sum,
    yearly_trends,
)

DRAW = random.Random(1)
GROUPS = {
    "tenths": [0.1] * 10,
    "cancelled": [1e308, 1.0, -1e308],
    "twice": [1e300, 1e-300, -1e300],
    "subnormal": [5e-324] * 3 + [1e-310],
    "negative": [-1e16, 1.0, 1.0, -3.5],
    "wide": [DRAW.uniform(-1, 1) * 10.0 ** DRAW.randint(-300, 300) for _ in range(300)],
    "tie to even": [2.0**53, 1.0],
    "above the tie": [2.0**53, 1.0, 2.0**-600],
    "tie upwards": [2.0**53, 3.0],
    "below": [-(2.0**53), -1.0, -(2.0**-1074)],
    "to nothing": [1e300, 3.0, -3.0, -1e300],
    "zeros": [0.0, -0.0],
    "overflow": [1.7e308, 1.7e308],
    "largest": [1.7976931348623157e308],
    "powers": [2.0**k for k in range(-1074, 1023, 7)],
    "places": [2.0 ** (22 * k) for k in range(-48, 46)],
    "below places": [math.nextafter(2.0 ** (22 * k), 0) for k in range(-47, 46)],
    "many": [DRAW.uniform(0, 1e5) for _ in range(3000)],
}


def total(values):
    """The exact sum, rounded once."""
    exact = sum(map(Fraction, values))
    try:
        return float(exact)
    except OverflowError:
        return math.inf if exact > 0 else -math.inf


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_equal_to_exact_addition_in_any_order(spark, partitions):
    rows = [(name, x) for name, values in GROUPS.items() for x in values]
    random.Random(partitions).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(partitions)
    got = {r["k"]: r["total"] for r in exact_sums(df, ["k"], {"total": "x"}).collect()}
    assert got == {name: total(values) for name, values in GROUPS.items()}


@settings(
    max_examples=8,
    deadline=None,
    derandomize=True,
    phases=[Phase.generate],  # to shrink a case takes minutes, an example being a Spark job
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(st.lists(st.lists(st.floats(allow_nan=False, allow_infinity=False), max_size=8), min_size=1, max_size=40))
def test_any_values(spark, groups):
    rows = [(i, x) for i, values in enumerate(groups) for x in values]
    df = spark.createDataFrame(rows, "k int, x double")
    got = {r["k"]: r["total"] for r in exact_sums(df, ["k"], {"total": "x"}).collect()}
    assert got == {i: total(values) for i, values in enumerate(groups) if values}


def test_nulls_specials_and_names(spark):
    inf, nan = math.inf, math.nan
    rows = [
        ("a", None, None), ("a", None, 1.5), ("b", inf, 1.0), ("b", 1.0, 1.0), ("c", inf, 1.0), ("c", -inf, None),
        ("d", nan, 2.0), (None, 0.25, 0.1), (None, 0.5, 0.2),
    ]
    df = spark.createDataFrame(rows, "`k.%` string, `x y` double, f float")
    found = exact_sums(df, ["k.%"], {"sum.1": "x y", "f": "f"})
    got = {r[0]: tuple(r)[1:] for r in found.collect()}
    assert found.columns == ["k.%", "sum.1", "f"]
    assert got["a"] == (None, 1.5) and got["b"] == (inf, 2.0) and math.isnan(got["c"][0]) and math.isnan(got["d"][0])
    single = [float(r[0]) for r in df.filter("`k.%` is null").select(F.col("f").cast("double")).collect()]
    assert got[None] == (0.75, math.fsum(single))
    assert exact_sums(df, [], {"s": "f"}).first()["s"] == math.fsum([1.5, 1.0, 1.0, 1.0, 2.0, *single])
    assert exact_sums(df.limit(0), ["k.%"], {"s": "f"}).count() == 0
    with pytest.raises(ValueError, match="not float"):
        exact_sums(df, [], {"s": "k.%"})


def test_models_with_exact_sums(spark):
    rows = [(2020, "a", 1e16), (2020, "b", 1.0), (2020, "a", -1e16), (2021, "b", 0.125), (None, "b", None)] * 9
    df = spark.createDataFrame(rows, "year int, k string, x double").repartition(8)
    years = yearly_trends(df, "year", "x", digits=3, exact=True).collect()
    assert [tuple(r) for r in years] == [(None, 9, None, None), (2020, 27, 9.0, None), (2021, 9, 1.125, -7.875)]
    tops = top_groups_by_sum(df, ["k"], "x", digits=3, tie_break=["k"], exact=True)
    assert [tuple(r) for r in tops.collect()] == [("b", 10.125), ("a", 0.0)]
    means = avg_by_group(df, ["k"], "x", "mean", digits=4, exact=True).collect()
    assert [tuple(r) for r in means] == [("b", 0.5625), ("a", 0.0)]
    both = group_summary(df, ["year"], {"s": ("sum", "x"), "m": ("avg", "x")}, digits=4, exact=True).collect()
    assert [tuple(r) for r in both] == [(2020, 9.0, 0.3333), (2021, 1.125, 0.125), (None, None, None)]
    whole = group_summary(df, ["k"], {"s": ("sum", "year")}, exact=True)  # whole numbers need no more
    assert {tuple(r) for r in whole.collect()} == {("a", 18 * 2020), ("b", 9 * 4041)}
    with pytest.raises(ValueError, match="all of doubles"):
        group_summary(df, ["k"], {"s": ("sum", "year"), "x": ("sum", "x")}, exact=True)


def test_tasks_combine_first(spark):
    df = spark.range(1000, numPartitions=4).selectExpr("id % 3 as k", "id / 7 as x")
    plan = exact_sums(df, ["k"], {"s": "x"})._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.rindex("Exchange"):]
    assert "HashAggregate" in first and "partial_sum" in first and "Python" not in plan
