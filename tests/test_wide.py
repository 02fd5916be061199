import re

import pytest
from pyspark.sql import functions as F

from tierflow import PipelineConfig
from tierflow.operators import dedup, refine
from tierflow.plans import Layers, run_bronze, run_silver
from tierflow.plans.pipeline import read_silver

ROWS = [
    ("a", 1.0, "x", 3, 1),
    ("a", 1.0, "x", 2, 9),
    ("a", 1.0, "x", 2, 4),
    ("a", 1.0, "x", None, 0),
    ("b", 0.0, None, 1, 1),
    ("b", -0.0, None, 0, None),
    ("b", 0.0, "", 1, 1),
    (None, float("nan"), None, 5, 5),
    (None, float("nan"), None, 5, 5),
    ("c", 2.0, "x", None, None),
]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(ROWS, "`k.1` string, v double, t string, at int, seq int").repartition(4)


def found(df):
    return sorted(str(tuple(r)) for r in df.withColumn("v", F.col("v") + 0.0).collect())


@pytest.mark.parametrize("ignore", [[], ["at"], ["at", "seq"]], ids=str)
def test_equal_to_the_comparison_of_rows(rows, ignore):
    """But for a single ignored column, where the other rows' values are kept from the earliest row."""
    df = rows if len(ignore) != 1 else rows.drop("seq")
    assert found(dedup(df, ignore, wide=True)) == found(dedup(df, ignore))
    assert dedup(df, ignore, wide=True).columns == df.columns
    assert dedup(df.limit(0), ignore, wide=True).count() == 0


def test_many_copies_are_compared_as_rows(rows, monkeypatch):
    monkeypatch.setattr(refine, "MOST_SHARED", 3)
    assert found(dedup(rows, ["at", "seq"], wide=True)) == found(dedup(rows, ["at", "seq"]))


def test_rows_that_only_share_a_digest_stay(rows, monkeypatch):
    monkeypatch.setattr(refine, "record_digest", lambda schema, columns: F.lit("00" * 16))
    assert found(dedup(rows, ["at", "seq"], wide=True)) == found(dedup(rows, ["at", "seq"]))


def written(spark, df):
    """Bytes that the shuffles of an action wrote, as its plan counts them."""
    execution = df._jdf.queryExecution()
    df._jdf.collectToPython()
    nodes, total = [execution.executedPlan()], 0
    while nodes:
        node = nodes.pop()
        metric = node.metrics().get("shuffleBytesWritten")
        if metric.isDefined():
            total += metric.get().value()
        children = node.children()
        nodes += [children.apply(i) for i in range(children.size())]
    return total


def test_rows_are_not_shuffled(spark):
    """Wide rows without copies: the plan has no exchange, and the digests take a fraction of the rows' bytes."""
    text = F.concat_ws(" ", *(F.sha2(F.concat(F.col("id").cast("string"), F.lit(str(i))), 256) for i in range(20)))
    # a range is partitioned by its id, which would spare the plain form its shuffle
    wide = spark.range(3000, numPartitions=4).select((F.col("id") * 7 % 3001).alias("n"), text.alias("text"))
    plan = dedup(wide, wide=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    digest = refine.record_digest(wide.schema, wide.columns)
    slim = wide.select(F.unhex(digest).alias("digest"), F.col("n").cast("long").alias("n"))
    slim = slim.groupBy("digest").agg(F.count("n"), F.min("n"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        before, after = written(spark, dedup(wide)), written(spark, slim)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert 0 < after < before / 5
    copies = wide.unionAll(wide.filter("n < 10"))
    plan = dedup(copies, wide=True)._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin.*LeftAnti", plan) and "SortMergeJoin" not in plan
    assert dedup(copies, wide=True).count() == 3000


def test_silver_of_wide_rows(spark, tmp_path):
    source = tmp_path / "source" / "streaming"
    source.mkdir(parents=True)
    (source / "a.csv").write_text("Name,Size\nx,1\nx,1\ny,2\n")
    for wide in (False, True):
        config = PipelineConfig(base_uri=str(tmp_path), wide_rows=wide)
        run_bronze(spark, config)
        run_silver(spark, config)
        assert sorted(r["name"] for r in read_silver(spark, config).collect()) == ["x", "y"]
    assert Layers(config).silver
