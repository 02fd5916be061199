from datetime import datetime

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tierflow.operators import clean_name, clean_names, drop_technical, stamp


@pytest.mark.parametrize(
    "raw, cleaned",
    [
        ("  Streams Last 30 Days (Millions) ", "streams_last_30_days_millions"),
        ("Skip Rate (%)", "skip_rate_%"),
        ("a, b", "a,_b"),
        ("Mkt. Segment-Name", "mkt._segment-name"),
        ("a\tb", "a\tb"),
        ("( x )", "_x_"),
    ],
)
def test_clean_name(raw, cleaned):
    assert clean_name(raw) == cleaned


def test_clean_name_keeps_case():
    assert clean_name(" Release Year (AD)", lower=False) == "Release_Year_AD"


@given(st.text(max_size=30))
def test_cleaning_twice_changes_nothing_but_new_edges(name):
    once = clean_name(name)
    assert " " not in once and "(" not in once and ")" not in once
    assert clean_name(once) == once.strip().lower()


def test_clean_names_renames_in_one_projection(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["A b", "c.d (e)", "%"])
    cleaned = clean_names(df)
    assert cleaned.columns == ["a_b", "c.d_e", "%"]
    assert cleaned.first() == (1, 2, 3)


def test_clean_names_reports_collisions(spark):
    df = spark.createDataFrame([(1, 2)], ["A b", "a_b"])
    with pytest.raises(ValueError, match="A b.*a_b"):
        clean_names(df)
    mixed = spark.createDataFrame([(1, 2)], ["A b", "a(b"])
    assert clean_names(mixed, lower=False).columns == ["A_b", "ab"]


def test_drop_technical_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, "f")], ["a", "source_file"])
    assert drop_technical(df).columns == ["a"]
    assert drop_technical(df.drop("source_file")).columns == ["a"]
    assert drop_technical(df, ["a", "b"]).columns == ["source_file"]


def test_stamp(spark):
    df = spark.range(0, 1000, numPartitions=8)
    assert stamp(df, "at").select("at").distinct().count() == 1
    fixed = datetime(2024, 5, 6, 7, 8, 9)
    assert stamp(df, "at", fixed).first()["at"] == fixed
