import pytest

# Columns beside doc_id and text have names that the operators use themselves.
SCHEMA = (
    "doc_id long, text string, id string, row string, kept string, size string, class string, node string, "
    "score string, words string, component_id string, start string, shard string"
)
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
TEXTS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta"),
    (2, "alpha  beta\tgamma delta epsilon zeta eta theta\n"),
    (3, "Alpha beta gamma delta epsilon zeta eta theta"),
    (4, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (5, None),
    (6, ""),
    (7, " \t\n "),
    (8, "one two"),
    (9, "one two"),
    (10, LONG),
    (11, LONG + " and a little more"),
    (None, "no id here"),
    (None, None),
    (12, "tabs\tand é ü 漢字 words"),
    (12, "tabs\tand é ü 漢字 words"),
    (13, "password = hunter2hunter and AKIA" + "A1" * 9 + " " + "0123456789abcdef" * 2),
]


def rows_of(texts):
    return [(i, t, *["x"] * 11) for i, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Null ids and texts, empty and long texts, ties, repeated rows, clashing columns."""
    return spark.createDataFrame(rows_of(TEXTS), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
