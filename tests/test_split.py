import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tierflow.operators import assign_chunks, split, with_row_index, write_chunks
from tierflow.sources import read_csv

LOOSE = [HealthCheck.function_scoped_fixture]


def sizes(df):
    return {r["chunk"]: r["count"] for r in df.groupBy("chunk").count().collect()}


def test_last_chunk_takes_the_remainder(spark):
    df = spark.range(0, 103, numPartitions=4)
    expected = {1: 20, 2: 20, 3: 20, 4: 20, 5: 23}
    assert sizes(assign_chunks(df, 5)) == expected
    assert sizes(assign_chunks(df, 5, ["id"])) == expected


def test_fewer_rows_than_chunks(spark):
    df = spark.range(3)
    assert sizes(assign_chunks(df, 5)) == sizes(assign_chunks(df, 5, ["id"])) == {5: 3}
    assert assign_chunks(spark.range(0), 5).count() == 0
    assert assign_chunks(spark.range(0), 5, ["id"]).count() == 0
    assert sizes(assign_chunks(df, 1, ["id"])) == {1: 3}
    with pytest.raises(ValueError, match="chunk"):
        assign_chunks(df, 0)


@settings(max_examples=6, deadline=None, suppress_health_check=LOOSE)
@given(st.integers(0, 60), st.integers(1, 9), st.integers(1, 5), st.booleans())
def test_chunk_sizes_add_up(spark, rows, n, partitions, ordered):
    df = spark.range(0, rows, numPartitions=partitions)
    got = sizes(assign_chunks(df, n, ["id"] if ordered else []))
    size = rows // n
    want = {i: size for i in range(1, n)} | {n: rows - size * (n - 1)}
    assert got == {i: c for i, c in want.items() if c}


def messy(spark):
    """Few sort values, nulls, NaN and whole-row copies, over several partitions."""
    return (
        spark.range(0, 4000, numPartitions=7)
        .select(
            F.when(F.col("id") % 5 < 3, F.lit("hot")).when(F.col("id") % 5 == 3, "cold").alias("k"),
            F.when(F.col("id") % 11 == 0, F.lit(float("nan")))
            .when(F.col("id") % 13 != 0, (F.col("id") % 4).cast("double"))
            .alias("v"),
        )
        .repartition(6)
    )


@pytest.mark.parametrize("descending", [(), ("k",), ("v",), ("k", "v")])
def test_sorted_chunks_equal_a_global_sort(spark, descending):
    df = messy(spark)
    order = [F.desc(c) if c in descending else F.asc(c) for c in ("k", "v")]
    size = 4000 // 9
    index = F.row_number().over(Window.orderBy(*order)) - 1
    want = df.withColumn("chunk", F.least(F.floor(index / size) + 1, F.lit(9)).cast("int"))
    got = assign_chunks(df, 9, ["k", "v"], descending)
    by = ("k", "v", "chunk")
    assert {str(r) for r in got.groupBy(*by).count().collect()} == {
        str(r) for r in want.groupBy(*by).count().collect()
    }


def test_row_index_is_gapless_and_follows_the_order(spark):
    df = messy(spark)
    indexed = with_row_index(df, ["k", "v"], descending=["v"])
    assert indexed.columns == ["k", "v", "row_index"]
    numbers = sorted(r[0] for r in indexed.select("row_index").collect())
    assert numbers == list(range(4000))
    want = [str(r) for r in df.orderBy(F.asc("k"), F.desc("v")).collect()]
    assert [str(r) for r in indexed.orderBy("row_index").drop("row_index").collect()] == want


def test_numbers_stay_where_the_input_is_not_repeatable(spark):
    df = spark.range(0, 900, numPartitions=3).withColumn("r", F.expr("uuid()"))
    indexed = with_row_index(df, ["r"])
    first, second = (sorted(map(tuple, indexed.collect()), key=lambda t: t[2]) for _ in range(2))
    assert first == second and [t[1] for t in first] == sorted(t[1] for t in first)


def test_scan_order_is_kept(spark, tmp_path):
    spark.range(0, 500, numPartitions=1).write.csv(str(tmp_path / "one"))
    scan = spark.read.schema("id long").csv(str(tmp_path / "one"))
    indexed = with_row_index(scan)
    assert indexed.filter("id != row_index").count() == 0
    chunk = assign_chunks(scan, 5).groupBy("chunk").agg(F.min("id"), F.max("id")).orderBy("chunk")
    assert [tuple(r) for r in chunk.collect()] == [
        (i + 1, i * 100, i * 100 + 99) for i in range(5)
    ]


def test_copies_of_one_row_spread_over_all_partitions(spark):
    copies = spark.range(0, 20000, numPartitions=4).select(F.lit("same").alias("k"))
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")  # so small a table would end in one partition by itself
    try:
        places = split._ranked(split._identified(copies), ["k"], ())
    finally:
        spark.conf.unset(merging)
    per_part = places.groupBy(F.shiftright("__place", 33)).count().collect()
    assert len(per_part) == 4 and max(r["count"] for r in per_part) < 20000 * 0.4


def test_sorted_chunks_shuffle_the_sort_columns_only(spark, tmp_path):
    source = str(tmp_path / "t")
    spark.range(100).select("id", F.lit("wide").alias("payload")).write.parquet(source)
    chunked = assign_chunks(spark.read.parquet(source), 5, ["id"])
    nodes = chunked._jdf.queryExecution().executedPlan().toString().splitlines()
    rows = [line for line in nodes if not line.startswith("   :")]  # without the subqueries
    assert any("FileScan" in line and source in line for line in rows)
    assert not any("Exchange" in line or "Join" in line for line in rows)


def test_equal_sort_values_at_a_cut_are_told_apart(spark):
    df = spark.range(0, 100, numPartitions=3).withColumn("k", F.floor(F.col("id") / 10))
    assert sizes(assign_chunks(df, 5, ["k"])) == {i: 20 for i in range(1, 6)}  # cuts between values
    assert sizes(assign_chunks(df, 3, ["k"])) == {1: 33, 2: 33, 3: 34}  # cuts inside values
    nulls = df.withColumn("k", F.when(F.col("id") >= 50, F.col("k")))
    assert sizes(assign_chunks(nulls, 3, ["k"], ["k"])) == {1: 33, 2: 33, 3: 34}


def test_write_chunks_keeps_values_whole(spark, tmp_path):
    df = spark.sql(
        """select id, '  padded ' as text, concat('{"k": ', id, ', "q": "a,b"}') as props,
                  timestamp_ntz'2024-01-02 03:04:05.123456' as ts from range(23)"""
    )
    path = str(tmp_path / "chunks")
    write_chunks(df, path, 4, ["id"])
    back = read_csv(spark, path, T.StructType([*df.schema]).add("chunk", T.IntegerType()))
    assert sizes(back) == {1: 5, 2: 5, 3: 5, 4: 8}
    assert {tuple(r) for r in back.drop("chunk").collect()} == {tuple(r) for r in df.collect()}


def test_write_chunks_into_single_files(spark, tmp_path):
    path = tmp_path / "chunks"
    write_chunks(spark.range(0, 50, numPartitions=8), str(path), 5, files_per_chunk=1)
    assert all(len(list((path / f"chunk={i}").glob("*.csv"))) == 1 for i in range(1, 6))
