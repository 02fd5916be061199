import zlib

import pytest

from tierflow.llm import queries, sharding


def check(rows, n_shards, law, slack):
    shards = {}
    for r in rows:
        shards.setdefault(r.shard, []).append(r)
    assert set(shards) <= set(range(n_shards))
    for own in shards.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    weights = [sum(r.size if law == "bytes" else 1 for r in shards.get(s, [])) for s in range(n_shards)]
    assert max(weights) - min(weights) <= slack, weights


@pytest.mark.parametrize("law", ["bytes", "rows"])
def test_sizes(documents, law):
    texts = {r.doc_id: r.text for r in documents.collect()}
    rows = sharding.shards(documents, 8, law).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all(r.size == len(texts[r.doc_id].encode()) + 1 for r in rows)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) for r in rows)
    check(rows, 8, law, max(r.size for r in rows) if law == "bytes" else 1)


def test_query(spark):
    rows = queries.QUERIES["op2_sharding"](spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == 1000 and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    check(rows, 8, "bytes", max(r.size for r in rows))


def test_one_row_in_place_of_most_is_cut(spark):
    docs = spark.range(4000).selectExpr("if(id % 3 = 0, id, 7) as doc_id", "if(id % 3 = 0, string(id), 'hot text') as text")
    rows = sharding.shards(docs, 8, "rows").collect()
    assert len(rows) == 4000
    check(rows, 8, "rows", 1)


def test_edge_cases(edge_docs, no_docs):
    rows = sharding.shards(edge_docs, 2, "rows").collect()
    assert len(rows) == edge_docs.count()
    check(rows, 2, "rows", 1)
    assert next(r for r in rows if r.doc_id == 5).size == 1 and next(r for r in rows if r.doc_id == 5).text_crc32 == 0
    assert sharding.shards(no_docs).count() == 0
    with pytest.raises(ValueError):
        sharding.shards(edge_docs, 2, "colour")
