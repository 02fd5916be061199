"""Exact dedup by sorting content: equal normalised texts become neighbours and are compared in full.

Built-in expressions only. The range exchange draws its splitters from a sample of the keys; each
partition is sorted with spilling, and the window compares neighbouring texts in full: group size and the row that stays
come from the run of equal neighbours. A text with very many copies is cut into runs by document, which sort apart;
only the first rows of these runs are put together by digest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

# Sort keys begin with so many code points of the text, so splitters stay small for any text.
PREFIX = 32
# Copies of one text that one run holds at least before it is cut, and the most texts that are cut.
RUN_ROWS = 4096
MOST_CUT_TEXTS = 500_000


def normalised(text: str) -> Column:
    return F.regexp_replace(common.whole_text(text), common.WHITE_SPACE + "+", "")


def _hot_texts(texts: DataFrame) -> DataFrame:
    """(key, runs) of the texts with more copies than a run holds; at most ``MOST_CUT_TEXTS`` rows.

    A run holds ``RUN_ROWS`` rows, or more where there are over ``RUN_ROWS * MOST_CUT_TEXTS`` rows in
    all, so that the number of texts with more than a run stays bounded whatever the data.
    """
    total = texts.count()
    run_rows = max(RUN_ROWS, -(-total // MOST_CUT_TEXTS))
    counts = texts.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter(F.col("copies") > run_rows).select(
        F.col("key").alias("hot_key"), F.ceil(F.col("copies") / run_rows).alias("runs")
    )


def _compared(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, text_sha256; with ``carry`` the whole row), as the sorted runs tell them."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.char_length(common.whole_text(text_col)).alias("chars"),
        normalised(text_col).alias("norm"),
        *([F.struct("*").alias("row")] if carry else []),
    )
    rows = rows.withColumn("key", F.xxhash64("norm")).withColumn("prefix", F.substring("norm", 1, PREFIX))
    if not carry:  # normalised once; counts and splitters read their own columns
        rows = common.stage(rows, "exact-texts")
    hot = F.broadcast(_hot_texts(rows.select("key")))
    runs = (
        rows.join(hot, F.col("key") == F.col("hot_key"), "left")
        .withColumn("run", F.pmod(F.xxhash64("id", "chars"), F.coalesce("runs", F.lit(1))))
        .select("id", "chars", "key", "run", F.isnotnull("runs").alias("cut"), "prefix", "row" if carry else "norm")
    )
    # Partitions by (prefix, key, run) also keep the rows of a run together, so the window needs no
    # further exchange: it sorts each partition and starts a group wherever neighbouring texts differ.
    sorted_runs = runs.repartitionByRange("prefix", "key", "run")
    if carry:  # the original text travels, and is normalised again
        sorted_runs = sorted_runs.withColumn("norm", normalised(f"row.`{text_col}`"))
    first = Window.partitionBy("prefix", "key", "run", "norm").orderBy(F.desc("chars"), F.col("id").asc_nulls_last())
    whole = first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    compared = common.stage(
        sorted_runs.select(
            "id",
            "cut",
            F.row_number().over(first).alias("place"),
            F.count(F.lit(1)).over(whole).alias("size"),
            F.first("id").over(whole).alias("keep"),
            F.first("chars").over(whole).alias("keep_chars"),
            F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
            *(["row"] if carry else []),
        ),
        "exact-runs",
    )
    # the runs of a cut text, put together by their first rows: (-chars, id is null, id), the smallest stays
    order = F.struct((-F.col("keep_chars")).alias("c"), F.isnull("keep").alias("n"), F.col("keep").alias("i"))
    joined = (
        compared.filter("cut and place = 1")
        .groupBy(F.col("text_sha256").alias("of"))
        .agg(F.sum("size").alias("all"), F.min(order).alias("best"))
    )
    # at most MOST_CUT_TEXTS rows
    found = compared.join(F.broadcast(joined), F.col("text_sha256") == F.col("of"), "left")
    leads = F.isnull("of") | (F.col("keep").eqNullSafe(F.col("best.i")) & (F.col("keep_chars") == -F.col("best.c")))
    return found.select(
        "id",
        F.when(F.isnull("of"), F.col("keep")).otherwise(F.col("best.i")).alias("keep_id"),
        F.coalesce("all", "size").alias("group_size"),
        ((F.col("place") == 1) & leads).alias("kept"),
        "text_sha256",
        *(["row"] if carry else []),
    )


def duplicate_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's duplicate group: ``id_col, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space (U+0020, U+0009 to U+000D). The longest original
    text stays, then the smallest id; exactly one row of a group stays, also among repeated rows. A null
    text counts as empty, and all empty texts form one group. A null id sorts after all others. Other
    columns are not looked at. An empty table gives an empty result.
    """
    return _compared(docs, id_col, text_col, carry=False).withColumnRenamed("id", id_col)


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns of ``docs``; see `duplicate_groups`."""
    return _compared(docs, id_col, text_col, carry=True).filter("kept").select("row.*")
