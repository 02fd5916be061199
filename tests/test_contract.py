import duckdb
import pytest
from compare import TABLES, differences, duck, load_entry

from contract import oracles, registry

SF_DIR = "/root/testdata/sf0.01"
SMALL_DIR = "/root/testdata/sf0.001"

# Columns that keep their values when the tables are made harder.
IDS = {
    "customer": ["c_custkey"],
    "documents": ["doc_id"],
    "events": ["event_id", "ts"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"],
    "orders": ["o_orderkey"],
}

ENTRY = load_entry()
NAMES = sorted(registry.QUERIES)


@pytest.fixture(scope="module")
def connection():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def hard_dir(tmp_path_factory):
    """The small tables with nulls in a tenth of the values and one row in place of a third of all."""
    target = tmp_path_factory.mktemp("hard")
    for table in TABLES:
        source, file = f"'{SMALL_DIR}/{table}.parquet'", f"'{target}/{table}.parquet'"
        rows = f"select * from {source}"
        if table in IDS:
            columns = duckdb.sql(rows).columns
            values = ", ".join(
                c if c in IDS[table] else f"if(hash(n, {i}) % 10 = 0, null, {c}) as {c}"
                for i, c in enumerate(columns)
            )
            names = ", ".join(columns)
            rows = f"""
                with numbered as (select *, row_number() over () as n from {source}),
                holes as (select n, {values} from numbered),
                hot as (select {names} from holes where n = 5)
                select {names} from holes where n % 3 <> 0
                union all
                select hot.* from hot, (select n from numbered where n % 3 = 0) copies
            """
        duckdb.sql(f"copy ({rows}) to {file} (format parquet)")
    return str(target)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, connection, name):
    result = ENTRY.queries()[name](spark, SF_DIR)
    assert differences(result, connection, ENTRY.oracle_sql()[name]) is None


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql_with_nulls_and_copies(spark, hard_dir, name):
    result = ENTRY.queries()[name](spark, hard_dir)
    assert differences(result, duck(hard_dir), ENTRY.oracle_sql()[name]) is None


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(oracles.SQL)
    assert set(NAMES) <= set(ENTRY.queries())


def test_entry(spark):
    assert ENTRY.entry(spark).count() > 0
