"""Spark side of the contract. Each query takes a session and a data directory."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import PipelineConfig, operators, sinks, storage
from tierflow.functions import round_half_up
from tierflow.plans import (
    Layers,
    layer_checks,
    layer_checks_incremental,
    run_bronze,
    run_gold,
    run_gold_incremental,
    run_pipeline,
    run_silver,
    stream_silver,
    streamed_counts,
)
from tierflow.plans.pipeline import read_bronze, read_quarantine, read_silver
from tierflow.sources import WRITE_OPTIONS, infer_schema, load_schema, read_csv, read_table
from tierflow.streaming import bronze_schema

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir}/{name}.parquet")


def orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("release_year", F.year("o_orderdate"))


# ---- gold models -------------------------------------------------------------------------------


@query
def top_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["l_partkey", "l_suppkey"]
    return operators.top_groups_by_sum(
        table(spark, sf_dir, "lineitem"), keys, "l_extendedprice", tie_break=keys
    )


@query
def top_groups_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups that cannot be among the first ten are left out by a bound before they are summed."""
    keys = ["l_orderkey"]
    return operators.top_groups_by_sum(
        table(spark, sf_dir, "lineitem"), keys, "l_extendedprice", tie_break=keys, many_groups=True
    )


@query
def top_n_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.top_n_per_group(
        orders_by_year(spark, sf_dir),
        ["release_year"],
        "o_totalprice",
        rank_col="rank_in_year",
        tie_break=["o_orderkey"],
        few_groups=True,
    )


@query
def top_lines_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").withColumn("release_year", F.year("l_shipdate"))
    return operators.top_n_per_group(
        lines,
        ["release_year"],
        "l_extendedprice",
        rank_col="rank_in_year",
        tie_break=["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
        few_groups=True,
    )


@query
def top_n_null_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null group key is a group of its own, null values take no part."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("price"),
    )
    return operators.top_n_per_group(
        orders, ["status"], "price", n=3, rank_col="place", tie_break=["o_orderkey"]
    )


@query
def top_n_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """More rows per group than are ranked by a window."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return operators.top_n_per_group(
        orders, ["o_orderstatus"], "o_totalprice", n=2000, rank_col="place", tie_break=["o_orderkey"]
    )


@query
def avg_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.avg_by_group(
        table(spark, sf_dir, "events"), ["event_type"], "value", "avg_value"
    )


@query
def avg_null_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A null key is a group; a group whose values are all null has a null mean."""
    events = table(spark, sf_dir, "events").select(
        F.nullif("event_type", F.lit("click")).alias("event_type"),
        F.when(F.col("event_type") != "view", F.col("value")).alias("value"),
    )
    return operators.avg_by_group(events, ["event_type"], "value", "avg_value")


@query
def group_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.group_summary(
        table(spark, sf_dir, "customer"),
        ["c_nationkey"],
        {"total_balance": ("sum", "c_acctbal"), "avg_balance": ("avg", "c_acctbal")},
    )


@query
def trends_null_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without a year have a row of their own, and are no year's year before."""
    known = F.when(F.col("o_orderpriority") != "5-LOW", F.col("release_year"))
    orders = orders_by_year(spark, sf_dir).withColumn("release_year", known)
    return operators.yearly_trends(orders, "release_year", "o_totalprice")


@query
def rounding_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values at and right beside x.xx5, rounded once."""
    half = F.col("o_orderkey") * F.lit(0.005)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        round_half_up(half, 2).alias("at_half"),
        round_half_up(half - F.lit(4e-11), 2).alias("below_half"),
    )


@query
def yearly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.yearly_trends(orders_by_year(spark, sf_dir), "release_year", "o_totalprice")


@query
def top_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ["o_custkey"]
    return operators.top_groups_by_sum(
        table(spark, sf_dir, "orders"), keys, "o_totalprice", tie_break=keys
    )


@query
def exact_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums in which large values cancel and leave small ones, which plain addition of doubles loses."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        F.explode(
            F.array(
                F.col("l_partkey") * F.lit(2.0**70),
                F.col("l_quantity") * F.lit(2.0**-30),
                F.col("l_partkey") * F.lit(-(2.0**70)),
            )
        ).alias("amount"),
    )
    return operators.exact_sums(lines, ["l_returnflag"], {"total": "amount"})


@query
def exact_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.group_summary(
        table(spark, sf_dir, "lineitem"),
        ["l_linestatus"],
        {"quantity": ("sum", "l_quantity"), "avg_quantity": ("avg", "l_quantity")},
        exact=True,
    )


# ---- columns and refinement --------------------------------------------------------------------


def messy_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").toDF(
        " Customer Key ", "Name (Full)", "Nation Key", "Balance (Total %)", "Mkt. Segment"
    )


@query
def clean_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.clean_names(messy_customers(spark, sf_dir))


@query
def clean_names_keep_case(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.clean_names(messy_customers(spark, sf_dir), lower=False)


@query
def drop_and_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Technical columns go where they exist, a time stamp comes in."""
    documents = table(spark, sf_dir, "documents").withColumnRenamed("source", "source_file")
    kept = operators.drop_technical(documents.select("doc_id", "lang", "source_file"))
    stamped = operators.stamp(kept, "silver_transform_time", datetime(2024, 1, 2, 12))
    return stamped.withColumn("silver_transform_time", F.col("silver_transform_time").cast("date"))


@query
def dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return operators.dedup(documents.select("text", "lang", "n_chars"))


@query
def dedup_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests are shuffled instead of texts."""
    documents = table(spark, sf_dir, "documents")
    return operators.dedup(documents.select("text", "lang", "n_chars"), wide=True)


@query
def dedup_wide_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few of these rows are alike but for two columns, which are kept together from one row."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_orderkey"]
    return operators.dedup(orders.select(*columns), ignore=["o_orderdate", "o_orderkey"], wide=True)


@query
def dedup_earliest(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return operators.dedup(documents.select("text", "lang", "n_chars", "doc_id"), ignore=["doc_id"])


@query
def dedup_earliest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several ignored columns are kept together, from one row."""
    orders = table(spark, sf_dir, "orders")
    columns = ["o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_orderkey"]
    return operators.dedup(orders.select(*columns), ignore=["o_orderdate", "o_orderkey"])


@query
def dedup_across_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole-row comparison keeps a record once for each ingestion time it came with."""
    documents = table(spark, sf_dir, "documents").select("text", "lang")
    batches = [documents.withColumn("ingestion_time", F.lit(i)) for i in (1, 2)]
    return operators.dedup(batches[0].unionAll(batches[1]))


def mixed_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order prices as text; the priority stands where a price is missing, blanks included."""
    status = F.col("o_orderstatus")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(status == "F", F.col("o_totalprice").cast("string"))
        .when(status == "O", F.col("o_orderpriority"))
        .otherwise(F.lit("  "))
        .alias("price"),
        F.split_part("o_orderpriority", F.lit("-"), F.lit(1)).alias("priority"),
    )


MIXED_SCHEMA = T.StructType().add("price", T.DoubleType()).add("priority", T.IntegerType())


@query
def conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.conform(mixed_prices(spark, sf_dir), MIXED_SCHEMA, rescue=None)


@query
def conform_rescue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.conform(mixed_prices(spark, sf_dir), MIXED_SCHEMA, rescue="rescued")


@query
def conform_lossy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a cast would cut does not fit: fractions, further decimals, times of day."""
    key = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 3 == 0, F.concat(key, F.lit(".5"))).otherwise(key).alias("n"),
        F.when(F.col("o_orderkey") % 5 == 0, F.concat(key, F.lit(".125"))).otherwise(key).alias("d"),
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(day, F.lit(" 10:11:12"))).otherwise(day).alias("day"),
    )
    wanted = T.StructType().add("n", T.IntegerType()).add("d", T.DecimalType(20, 2)).add("day", T.DateType())
    fitted = operators.conform(rows, wanted, rescue="rescued")
    return fitted.withColumn("d", F.col("d").cast("double"))


@query
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return operators.normalize_text(documents, ["text"], case="lower")


@query
def blank_to_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nation names padded, and blank in one region, become trimmed names and nulls."""
    nations = table(spark, sf_dir, "nation").select(
        "n_nationkey",
        F.when(F.col("n_regionkey") == 0, F.lit("   "))
        .otherwise(F.concat(F.lit("  "), F.col("n_name"), F.lit(" ")))
        .alias("name"),
    )
    return operators.normalize_text(nations, ["name"])


@query
def require_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_mktsegment", F.lit("BUILDING")).alias("segment"), "c_acctbal"
    )
    return operators.require_not_null(customers, ["segment", "c_acctbal"])


# ---- quality checks ----------------------------------------------------------------------------


@query
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("orders", "customer", "lineitem", "events", "documents")
    return operators.row_counts({f"{name}_rows": table(spark, sf_dir, name) for name in names})


@query
def null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "open_status", F.nullif("o_orderstatus", F.lit("F"))
    )
    events = table(spark, sf_dir, "events")
    return operators.null_counts(
        {
            "null_status": (orders, "open_status"),
            "null_price": (orders, "o_totalprice"),
            "null_value": (events, "value"),
        }
    )


@query
def distinct_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    return operators.distinct_counts(
        {
            "customers_with_orders": (orders, "o_custkey"),
            "priorities": (orders, "o_orderpriority"),
            "customers": (customers, "C_CUSTKEY"),
        }
    )


def event_rules() -> dict:
    return {
        "small_value": F.col("value") < 100,
        "known_type": F.nullif(F.col("event_type"), F.lit("view")) != "click",
    }


@query
def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    kept, _ = operators.expect(events, event_rules(), action="drop")
    return kept


@query
def expect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule, observed while the rows pass by."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    checked, seen = operators.expect(events, event_rules())
    checked.write.format("noop").mode("overwrite").save()
    counts = seen.get
    schema = ", ".join(f"{name} bigint" for name in counts)
    return spark.createDataFrame([tuple(counts.values())], schema)


@query
def expect_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events arrive in two batches, the second with all of the first again; each refused one is named once."""
    base = storage.staging_path(spark, "quarantine")
    rules = {"small_value": "value_units < 100", "known_type": "nullif(event_type, 'view') <> 'click'"}
    config = PipelineConfig(
        base_uri=base, raw_schema=EVENT_SCHEMA, dataset="events", expectations=rules, on_violation="quarantine"
    )
    events = table(spark, sf_dir, "events").toDF(*EVENT_SCHEMA.fieldNames())
    for arrival in (events.filter(F.col("Event Id") % 2 == 0), events):
        land(arrival, Layers(config).source)
        run_bronze(spark, config)
        stream_silver(spark, config)
    kept = read_silver(spark, config).select("event_id", F.lit("").alias("violated"))
    violated = F.array_join("_violated", ",").alias("violated")
    return kept.unionAll(read_quarantine(spark, config).select("event_id", violated))


@query
def expect_streamed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Violations of each rule, summed over the batches of a stream."""
    rules = {"small_value": "value_units < 100", "known_type": "nullif(event_type, 'view') <> 'click'"}
    config = PipelineConfig(
        base_uri=storage.staging_path(spark, "counts"), raw_schema=EVENT_SCHEMA, dataset="events", expectations=rules
    )
    events = table(spark, sf_dir, "events").toDF(*EVENT_SCHEMA.fieldNames())
    for part in (1, 0):
        land(events.filter(F.col("Event Id") % 2 == part), Layers(config).source)
        run_bronze(spark, config)
        stream_silver(spark, config)
    counts = streamed_counts(spark, config)
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{name} bigint" for name in counts))


@query
def newest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return operators.newest(table(spark, sf_dir, "events"), "ts", n=20)


# ---- splitting ---------------------------------------------------------------------------------


@query
def row_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return operators.with_row_index(
        orders, ["o_orderstatus", "o_orderkey"], descending=["o_orderstatus"]
    )


@query
def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return operators.assign_chunks(orders, 5, ["o_orderkey"])


@query
def chunks_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three sort values only, so that a chunk ends inside one of them: sizes are exact all the same."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    chunked = operators.assign_chunks(orders, 7, ["o_orderstatus"])
    return chunked.groupBy("chunk").agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min("o_orderstatus").alias("first_status"),
        F.max("o_orderstatus").alias("last_status"),
    )


@query
def chunks_scan_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunked = operators.assign_chunks(table(spark, sf_dir, "lineitem"), 7)
    return chunked.groupBy("chunk").agg(F.count(F.lit(1)).alias("row_count"))


@query
def write_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV chunk files, read back with inferred types."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "props")
    path = storage.staging_path(spark, "chunks")
    operators.write_chunks(events, path, 5, ["event_id"])
    return read_csv(spark, path).withColumn("event_id", F.col("event_id").cast("bigint"))


# ---- sources, sinks and streams ----------------------------------------------------------------

EVENT_SCHEMA = (
    T.StructType()
    .add("Event Id", T.LongType())
    .add("Ts", T.TimestampNTZType())
    .add("User Id", T.LongType())
    .add("Event Type", T.StringType())
    .add("Value (Units)", T.DoubleType())
    .add("Props", T.StringType())
)


def land(rows: DataFrame, path: str, **options: object) -> None:
    """Let CSV files with a header arrive in a source directory."""
    rows.write.mode("append").options(**WRITE_OPTIONS, **options).csv(path)


# Compressed files are read by one task each, so they are kept short.
PACKED = {"compression": "gzip", "maxRecordsPerFile": 1_000_000}


def landed_events(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, DataFrame]:
    base = storage.staging_path(spark, "ingest")
    config = PipelineConfig(base_uri=base, raw_schema=EVENT_SCHEMA, dataset="events")
    return config, table(spark, sf_dir, "events").toDF(*EVENT_SCHEMA.fieldNames())


@query
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals and three runs: each file is taken once, the last run finds nothing new."""
    config, events = landed_events(spark, sf_dir)
    early = F.coalesce(F.col("Ts") < F.expr("timestamp_ntz'2024-01-15'"), F.lit(False))
    for arrival in (events.filter(early), events.filter(~early)):
        land(arrival, Layers(config).source)
        run_bronze(spark, config)
    run_bronze(spark, config)
    return read_bronze(spark, config).drop("ingestion_time", "source_file", "_rescued_data")


@query
def ingest_header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four arrivals: columns as in the schema, in another order, with one more, and with two missing."""
    config, events = landed_events(spark, sf_dir)
    source, names = Layers(config).source, EVENT_SCHEMA.fieldNames()
    arrivals = (names, names[::-1], [*names[:2], "Label (New)", *names[2:]], names[:4])
    labelled = events.withColumn("Label (New)", F.col("Event Type"))
    for i, columns in enumerate(arrivals):
        land(labelled.filter(F.col("Event Id") % 4 == i).select(*(f"`{c}`" for c in columns)), source)
        if i % 2:
            run_bronze(spark, config)
    return read_bronze(spark, config).drop("ingestion_time", "source_file")


@query
def ingest_schema_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three arrivals, the later two with columns that were not there before; old rows are null in them."""
    config = PipelineConfig(base_uri=storage.staging_path(spark, "growth"), dataset="events", new_columns="add")
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event Id"),
        F.col("value").alias("Value (Units)"),
        F.col("event_type").alias("Event Type"),
        (F.col("event_id") + F.lit(0.5)).alias("Score"),
    )
    for i, columns in enumerate((["Event Id", "Value (Units)"], ["Event Type", "Event Id"], events.columns)):
        mine = F.least(F.col("Event Id") % 4, F.lit(2)) == i
        land(events.filter(mine).select(*(f"`{c}`" for c in columns)), Layers(config).source)
        run_bronze(spark, config)
        run_silver(spark, config)
    silver = read_silver(spark, config).drop("ingestion_time", "silver_transform_time")
    return silver.withColumn("event_id", F.col("event_id").cast("bigint"))


@query
def ingest_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row names its file and its batch; nothing had to be rescued."""
    config, events = landed_events(spark, sf_dir)
    land(events, Layers(config).source)
    run_bronze(spark, config)
    return read_bronze(spark, config).agg(
        F.count("source_file").alias("rows_with_file"),
        F.count("ingestion_time").alias("rows_with_time"),
        F.count_distinct("ingestion_time").alias("batches"),
        F.count("_rescued_data").alias("rescued"),
    )


@query
def silver_streaming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events arrive twice, in two batches; the streaming refinement keeps each once."""
    config, events = landed_events(spark, sf_dir)
    layers = Layers(config)
    for _ in range(2):
        land(events, layers.source)
        run_bronze(spark, config)
        stream_silver(spark, config)
    first = read_bronze(spark, config).agg(F.min("ingestion_time")).scalar()
    silver = read_silver(spark, config).withColumn("earliest", F.col("ingestion_time") == first)
    return silver.drop("ingestion_time", "silver_transform_time")


@query
def silver_streaming_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four batches, the third with the earliest time; each brings many copies in one file, and old records."""
    config = PipelineConfig(
        base_uri=storage.staging_path(spark, "late"), raw_schema=EVENT_SCHEMA, dataset="events"
    )
    layers = Layers(config)
    schema = bronze_schema(EVENT_SCHEMA)
    events = table(spark, sf_dir, "events")
    names = schema.fieldNames()[: len(events.columns)]
    for batch, day in enumerate((2, 3, 1, 4)):
        mine = events.filter(F.col("event_id") % 4 == batch)
        old = events.filter(F.col("event_id") % 4 < batch).filter(F.col("event_id") % 10 == 0)
        rows = mine.crossJoin(spark.range(5).select("id")).drop("id").unionAll(old).toDF(*names)
        rows = rows.withColumns(
            {
                "ingestion_time": F.lit(datetime(2024, 1, day)),
                "source_file": F.lit(f"file {batch}"),
                "_rescued_data": F.lit(None).cast("string"),
            }
        )
        rows.coalesce(1).write.mode("append").parquet(layers.bronze)
        stream_silver(spark, config)
    silver = read_silver(spark, config).drop("silver_transform_time")
    return silver.withColumn("ingestion_time", F.col("ingestion_time").cast("timestamp_ntz"))


@query
def ingest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the lines have a field that the schema does not name; it is rescued."""
    schema = T.StructType().add("Event Id", T.LongType()).add("Kind", T.StringType()).add("Value", T.DoubleType())
    config = PipelineConfig(
        base_uri=storage.staging_path(spark, "json"), raw_schema=schema, dataset="events", source_format="json"
    )
    events = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("Event Id"),
        F.col("event_type").alias("Kind"),
        F.col("value").alias("Value"),
        F.when(F.col("event_id") % 3 == 0, F.lit("new")).alias("Label"),
    )
    events.write.json(Layers(config).source)
    run_bronze(spark, config)
    return read_bronze(spark, config).drop("ingestion_time", "source_file")


@query
def ingest_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole numbers in all files but the last of twelve: the type that the run infers holds for all."""
    config = PipelineConfig(base_uri=storage.staging_path(spark, "inferred"), dataset="events")
    events = table(spark, sf_dir, "events").select("event_id", "value")
    last = events.agg(F.floor(F.max("event_id") * 11 / 12)).scalar()
    whole = F.floor("value").cast("string")
    amount = F.when(F.col("event_id") <= last, whole).otherwise(F.col("value").cast("string"))
    files = events.select("event_id", amount.alias("amount")).repartitionByRange(12, "event_id")
    land(files, Layers(config).source)
    run_bronze(spark, config)
    run_silver(spark, config)
    silver = read_silver(spark, config)
    return silver.select(F.col("event_id").cast("bigint").alias("event_id"), "amount")


@query
def csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column types found by inference, kept as JSON, loaded and applied."""
    base = storage.staging_path(spark, "infer")
    customers = table(spark, sf_dir, "customer")
    land(customers, f"{base}/files")
    infer_schema(spark, f"{base}/files", f"{base}/schema")
    rows = read_csv(spark, f"{base}/files", load_schema(spark, f"{base}/schema"))
    return rows.withColumn("c_custkey", F.col("c_custkey").cast("bigint"))


def nation_balances(spark: SparkSession, sf_dir: str, measure: str) -> DataFrame:
    return operators.group_summary(
        table(spark, sf_dir, "customer"), ["c_nationkey"], {"balance": (measure, "c_acctbal")}
    )


@query
def refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write replaces the first."""
    path = storage.staging_path(spark, "refresh")
    for measure in ("avg", "sum"):
        sinks.refresh(nation_balances(spark, sf_dir, measure), path)
    return read_table(spark, path)


@query
def write_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second write is skipped."""
    path = storage.staging_path(spark, "once")
    for measure in ("avg", "sum"):
        sinks.write_once(nation_balances(spark, sf_dir, measure), path)
    return read_table(spark, path)


@query
def publish_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three versions of a table, the third made from the second; then a write-once that finds it there."""
    path = storage.staging_path(spark, "published")
    for measure in ("avg", "sum"):
        sinks.refresh(nation_balances(spark, sf_dir, measure), path, snapshots=True)
    sinks.refresh(read_table(spark, path).filter("c_nationkey > 4"), path, snapshots=True)
    sinks.write_once(nation_balances(spark, sf_dir, "avg"), path, snapshots=True)
    return read_table(spark, path)


@query
def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One schema per layer, tables by qualified name, checked with scalar subqueries in SQL."""
    suffix = uuid.uuid4().hex[:12]
    config = PipelineConfig(
        base_uri=storage.staging_path(spark, "catalog"),
        catalog="spark_catalog",
        schemas={layer: f"{layer}_{suffix}" for layer in ("bronze", "silver", "gold")},
    )
    layers = Layers(config)
    layers.bootstrap(spark)
    orders = table(spark, sf_dir, "orders")
    raw, refined = layers.qualify("bronze", "orders"), layers.qualify("silver", "orders")
    sinks.refresh(orders.unionAll(orders), name=raw)
    sinks.refresh(operators.dedup(read_table(spark, name=raw)), name=refined)
    return spark.sql(
        f"""
        SELECT
          (SELECT COUNT(*) FROM {raw}) AS bronze_rows,
          (SELECT COUNT(*) FROM {refined}) AS silver_rows,
          (SELECT COUNT(*) FROM {raw} WHERE O_CustKey IS NULL) AS null_customers,
          (SELECT COUNT(DISTINCT O_CustKey) FROM {refined}) AS distinct_customers
        """
    )


RELEASE_SCHEMA = (
    T.StructType()
    .add("Country", T.StringType())
    .add("Artist", T.StringType())
    .add("Album", T.StringType())
    .add("Genre", T.StringType())
    .add("Release Year", T.IntegerType())
    .add("Total Streams (Millions)", T.DoubleType())
    .add("Streams Last 30 Days (Millions)", T.DoubleType())
    .add("Avg Stream Duration (Min)", T.DoubleType())
    .add("Skip Rate (%)", T.DoubleType())
)


def landed_releases(spark: SparkSession, sf_dir: str) -> tuple[PipelineConfig, DataFrame]:
    """Order lines in the columns of a release table."""
    config = PipelineConfig(
        base_uri=storage.staging_path(spark, "layers"),
        raw_schema=RELEASE_SCHEMA,
        stream_options={"pathGlobFilter": "*{.csv,.csv.gz}"},
    )
    releases = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("country "), F.col("l_linestatus")),
        F.concat(F.lit("artist "), F.col("l_suppkey")),
        F.concat(F.lit("album "), F.col("l_partkey")),
        F.concat(F.lit("genre "), F.col("l_returnflag")),
        F.year("l_shipdate"),
        "l_extendedprice",
        "l_quantity",
        "l_tax",
        "l_discount",
    )
    return config, releases.toDF(*RELEASE_SCHEMA.fieldNames())


@query
def gold_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All releases arrive twice in two runs, through bronze and silver; four gold tables as one."""
    config, releases = landed_releases(spark, sf_dir)
    layers = Layers(config)
    for _ in range(2):
        land(releases, layers.source, **PACKED)
        run_pipeline(spark, config)

    return four_gold_tables(spark, layers)


def four_gold_tables(spark: SparkSession, layers: Layers) -> DataFrame:
    def gold(model: str, key: str, value: str) -> DataFrame:
        return read_table(spark, layers.gold(model)).select(
            F.lit(model).alias("model"),
            F.col(key).cast("string").alias("key"),
            F.col(value).alias("value"),
        )

    return (
        gold("avg_duration_by_genre", "genre", "avg_duration_min")
        .unionByName(gold("genre_country_platform", "country", "total_streams_30d"))
        .unionByName(gold("yearly_stream_trends", "release_year", "total"))
        .unionByName(gold("top_artists", "artist", "total_streams_millions"))
    )


@query
def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Releases arrive in three parts; gold is brought forward after each, from the part that is new."""
    config, releases = landed_releases(spark, sf_dir)
    layers = Layers(config)
    part = F.pmod(F.xxhash64("Album", "Artist"), F.lit(3))
    for i in range(3):
        land(releases.filter(part == i), layers.source, **PACKED)
        run_bronze(spark, config)
        stream_silver(spark, config)
        run_gold_incremental(spark, config)
    return four_gold_tables(spark, layers)


@query
def checks_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, nulls and distinct values of bronze over three arrivals; whether estimates are within four errors."""
    config, events = landed_events(spark, sf_dir)
    for i in range(3):
        land(events.filter(F.col("Event Id") % 3 == i), Layers(config).source)
        run_bronze(spark, config)
        found, _ = layer_checks_incremental(spark, config, {"bronze": ("event_type", "user_id")})["bronze"]
    exact = operators.distinct_counts(
        {c: (table(spark, sf_dir, "events"), c) for c in ("event_type", "user_id")}
    ).first()

    def close(column: str) -> Column:
        return F.abs(F.col(f"distinct_{column}") - exact[column]) <= F.greatest(F.lit(1.0), F.lit(0.032 * exact[column]))

    return found.select(
        "rows", "null_event_type", "null_user_id", (close("event_type") & close("user_id")).alias("within_bound")
    )


@query
def checks_across_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The layer checks, one line for each, after a run that compares whole rows, gold written once."""
    config, releases = landed_releases(spark, sf_dir)
    land(releases, Layers(config).source)
    run_bronze(spark, config)
    run_silver(spark, config, dedup_by="row")
    run_gold(spark, config, mode="once")
    checks = layer_checks(spark, config).values()
    return reduce(
        DataFrame.unionAll, (row.unpivot([], row.columns, "check", "value") for row in checks)
    )
