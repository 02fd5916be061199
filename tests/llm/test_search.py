import math
import re
from collections import Counter

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from tierflow.llm import search
from tierflow.llm.queries import QUERIES, SQL

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k=10):
    """Rows (item, rank, doc, score) from Python integers; ``docs`` and ``items`` are (id, text)."""
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    n_docs, n_terms = len(counts), sum(c.total() for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    rows = []
    for item, own in asked.items():
        scored = []
        for d, c in counts:
            m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
            score = sum(w[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in own if c[t])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        for rank, (score, null, d) in enumerate(sorted(scored)[:k], 1):
            rows.append((item, rank, None if null else d, -score))
    return sorted(rows, key=str)


def got(docs, items, **kwargs):
    return sorted(map(tuple, search.ranked_documents(docs, items, **kwargs).collect()), key=str)


ITEMS = [
    (1, "alpha Beta? gamma-delta"),
    (2, "words, EPSILON! é ü"),
    (3, None),
    (4, "..."),
    (5, "nowhere to be found xyzzy"),
    (None, "one two two"),
    (6, "word1x1 word2x2 漢字"),
    (6, "zeta"),
]


@pytest.fixture
def items(spark):
    rows = [(i, t, "x", "x") for i, t in ITEMS]
    return spark.createDataFrame(rows, "item_id long, text string, rank string, item string")


def test_edges(spark, edge_docs, no_docs, items):
    """Null ids and texts, texts without terms, very long texts, ties, repeated rows, clashing columns, empty tables."""
    docs = [(r["doc_id"], r["text"]) for r in edge_docs.collect()]
    assert got(edge_docs, items) == brute(docs, ITEMS)
    assert got(no_docs, items) == [] and got(edge_docs, items.limit(0)) == []
    only_null = items.filter("item_id in (3, 4)")
    assert got(edge_docs, only_null) == []


def test_terms_are_whole_and_neighbours_count(spark):
    docs = [(1, "ab ab abc"), (2, "a-b AB_ab"), (3, "abab ba"), (4, "ab\0ab\x7fab"), (5, "abé éab ab")]
    items = [(1, "AB"), (2, "b a"), (3, "abé")]
    found = got(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert found == brute(docs, items)
    assert {d for i, _, d, _ in found if i == 1} == {1, 2, 4, 5}


def test_many_ties_take_the_smallest_ids(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same words here").alias("text")).repartition(7)
    docs = docs.unionAll(spark.createDataFrame([(9000 + i, "other text") for i in range(9000)], docs.schema))
    found = search.ranked_documents(docs, spark.createDataFrame([(1, "words")], "item_id long, text string"), k=3)
    assert [tuple(r)[1:3] for r in found.orderBy("rank").collect()] == [(1, 0), (2, 1), (3, 2)]


def test_items_in_parts(spark, documents, monkeypatch):
    """Parts change nothing; the running best is pruned often."""
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").collect()]
    docs = [(r["doc_id"], r["text"]) for r in documents.collect()]
    monkeypatch.setattr(search, "PART_BYTES", 1500)
    monkeypatch.setattr(search, "MOST_CELLS", 50)
    monkeypatch.setattr(search, "MOST_SHARES", 7)
    df = spark.createDataFrame(items, "item_id long, text string")
    assert len(list(search._parts(df, "item_id", "text"))) > 3
    assert got(documents.repartition(3), df, k=5) == brute(docs, items, k=5)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    result = QUERIES["op11_ranked_search"](spark, sf_dir)
    assert differences(result, duck(sf_dir), SQL["op11_ranked_search"]) is None
