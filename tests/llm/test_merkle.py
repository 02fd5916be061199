import hashlib
import zlib
from collections import defaultdict

import pytest
from compare import differences, duck
from pyspark.sql import functions as F

from tierflow.llm import merkle
from tierflow.llm.queries import MANIFEST_FIELDS, QUERIES, SQL

FIELDS = ("doc_id", "source", "text")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(nodes):
    """Root, and for each leaf its siblings level by level as (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for leaf, i in enumerate(at):
            run, j = runs[i // 16], i % 16
            paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
        nodes, at = [sha("".join(run)) for run in runs], [i // 16 for i in at]
    return nodes[0], paths


def brute(rows):
    """Sorted (id, leaf, subroot, root, path) of rows (doc_id, source, text)."""
    groups = defaultdict(list)
    for doc_id, source, text in rows:
        groups[source].append(((doc_id is not None, doc_id or 0, leaf := leaf_of((doc_id, source, text))), doc_id, leaf))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([leaf for *_, leaf in sorted(groups[s])]) for s in order}
    root, above = tree([trees[s][0] for s in order]) if order else (None, [])
    found = []
    for s, upper in zip(order, above):
        subroot, paths = trees[s]
        for (_, doc_id, leaf), path in zip(sorted(groups[s]), paths):
            found.append((doc_id, leaf, subroot, root, path + upper))
    return sorted(found, key=str)


def got(df, **kwargs):
    rows = merkle.manifest(df, FIELDS, **kwargs).collect()
    return sorted(
        [(r["doc_id"], r["leaf"], r["subroot"], r["root"], [tuple(x) for x in r["path"]]) for r in rows], key=str
    )


def rows(counts):
    return [(i, f"s{s}" if s else None, f"text {i} é漢") for s, n in counts.items() for i in range(n)]


SCHEMA = "doc_id long, source string, text string"


@pytest.mark.parametrize(
    "counts",
    [{1: 1}, {0: 2}, {1: 16}, {1: 17, 0: 1}, {1: 256, 2: 257}, {1: 4097, 2: 3, 0: 16}, {i: 1 + i % 3 for i in range(20)}],
    ids=str,
)
def test_equals_a_plain_tree(spark, counts):
    data = rows(counts)
    assert got(spark.createDataFrame(data, SCHEMA).repartition(5)) == brute(data)


def test_more_groups_than_a_block_holds(spark):
    data = [(i, f"group {i}", "x") for i in range(300)]
    assert got(spark.createDataFrame(data, SCHEMA)) == brute(data)


def test_edges(spark, edge_docs, no_docs):
    """Null ids, sources and texts, repeated rows, clashing columns, a long text; an empty table."""
    docs = edge_docs.withColumn("source", F.when(F.col("doc_id") > 6, "b"))
    docs = docs.withColumn("rank", F.lit("x")).withColumn("node", F.lit("x")).withColumn("group", F.lit(1))
    data = [tuple(r) for r in docs.select(*FIELDS).collect()]
    assert got(docs) == brute(data)
    assert got(no_docs.withColumn("source", F.lit("a"))) == []


def test_a_changed_row_is_found(spark):
    data = rows({1: 40, 2: 5})
    df = spark.createDataFrame(data, SCHEMA)
    changed = merkle.leaf_digest([F.col("doc_id"), F.col("source"), F.concat("text", F.lit("!"))])
    proofs = merkle.manifest(df, FIELDS, carry={"changed": changed})
    path = F.col("path")
    checked = proofs.select(
        (merkle.folded(F.col("leaf"), path) == F.col("root")).alias("same"),
        (merkle.folded(F.col("changed"), path) == F.col("root")).alias("tampered"),
    )
    assert {tuple(r) for r in checked.collect()} == {(True, False)}


def test_query_equals_plain_version(spark, documents):
    source = [tuple(r) for r in documents.select(*MANIFEST_FIELDS).collect()]
    upper = {d: any("A" <= c <= "Z" for c in t or "") for d, *_, t in source}
    found = QUERIES["op12_merkle_manifest"](spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(source)
    for r in found:
        chosen = zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["verified"] == (not (chosen and upper[r["doc_id"]]))
    leaves = {d: leaf_of((d, s, lang, n, t)) for d, s, lang, n, t in source}
    assert {r["doc_id"]: r["leaf"] for r in found} == leaves
    assert len({r["verified"] for r in found}) == 2


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"
    result = QUERIES["op12_merkle_manifest"](spark, sf_dir)
    assert differences(result, duck(sf_dir), SQL["op12_merkle_manifest"]) is None


def test_proofs_come_without_joins_or_python(spark, documents):
    plan = merkle.manifest(documents, FIELDS)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan and "Arrow" not in plan and "Generate" in plan
