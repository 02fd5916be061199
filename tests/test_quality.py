import pytest
from pyspark.sql import functions as F

from tierflow.operators import distinct_counts, expect, newest, null_counts, row_counts


@pytest.fixture
def layers(spark):
    bronze = spark.createDataFrame(
        [("a", 1.0), ("a", 1.0), (None, 2.0), ("B", None)], ["artist", "streams"]
    )
    return bronze, bronze.dropDuplicates(), bronze.filter("artist is not null").limit(2)


def test_counts_side_by_side(spark, layers):
    bronze, silver, gold = layers
    counts = row_counts({"bronze_rows": bronze, "silver_rows": silver, "gold_rows": gold})
    assert counts.columns == ["bronze_rows", "silver_rows", "gold_rows"]
    assert tuple(counts.first()) == (4, 3, 2)
    assert all(f.dataType.simpleString() == "bigint" for f in counts.schema)


def test_nulls(spark, layers):
    bronze, silver, _ = layers
    nulls = null_counts(
        {
            "artists_bronze": (bronze, "ARTIST"),
            "streams_silver": (silver, "streams"),
            "streams_bronze": (bronze, "streams"),
        }
    )
    assert nulls.columns == ["artists_bronze", "streams_silver", "streams_bronze"]
    assert tuple(nulls.first()) == (1, 1, 1)


def test_distinct(spark, layers):
    bronze, silver, gold = layers
    counts = distinct_counts({"b": (bronze, "artist"), "s": (bronze, "streams"), "g": (gold, "artist")})
    assert tuple(counts.first())[:2] == (2, 2)


def test_one_table_is_scanned_once(spark, tmp_path):
    spark.range(10).selectExpr("id", "id as b", "id as c").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = null_counts({"a": (df, "id"), "b": (df, "b")})._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1
    assert "ReadSchema: struct<id:bigint,b:bigint>" in plan.toString()


def test_newest(spark):
    df = spark.range(100).withColumnRenamed("id", "t")
    assert [r["t"] for r in newest(df, "t", n=3).collect()] == [99, 98, 97]


def rules():
    return {"positive": F.col("v") > 0, "known": F.col("k") == "a"}


@pytest.fixture
def checked(spark):
    return spark.createDataFrame([("a", 1), ("a", -1), ("b", 2), (None, None)], "k string, v int")


def test_expect_counts_in_the_same_pass(checked):
    kept, seen = expect(checked, rules())
    assert kept.count() == 4
    assert seen.get == {"row_count": 4, "positive": 2, "known": 2}


def test_expect_drop(checked):
    kept, seen = expect(checked, rules(), action="drop")
    assert [tuple(r) for r in kept.collect()] == [("a", 1)]
    assert seen.get["row_count"] == 4


def test_expect_fail(checked):
    # one partition: whichever task fails first ends the job, and the rows break different rules
    failing, _ = expect(checked.coalesce(1), rules(), action="fail")
    with pytest.raises(Exception, match="violated: positive"):
        failing.collect()
    both, _ = expect(checked.filter("v is null"), rules(), action="fail")
    with pytest.raises(Exception, match="violated: positive, known"):
        both.collect()
    passing, _ = expect(checked.filter("v = 1"), rules(), action="fail")
    assert passing.count() == 1
    with pytest.raises(ValueError, match="action"):
        expect(checked, rules(), action="ignore")


def test_estimated_distinct_counts(spark):
    df = spark.range(20_000).selectExpr("id % 5000 as k")
    found = distinct_counts({"n": (df, "k")}, error=0.02)
    assert "Expand" not in found._jdf.queryExecution().executedPlan().toString()
    assert abs(found.first()["n"] - 5000) < 500
