import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import nearest
from tierflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, node long, list string, score string, members string"


def usable(vectors):
    whole = [(i, v) for i, v in vectors if v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    sizes = Counter(len(v) for _, v in whole)
    most = max(sizes, key=lambda n: (sizes[n], n), default=0)
    return [(i, np.array(v, np.float32).astype(float)) for i, v in whole if len(v) == most]


def brute(vectors, k, every):
    """Rows (query, rank, id, score) of all rows, each row but the query's own a candidate."""
    rows = usable(vectors)
    found = []
    for at, (query, q) in enumerate(rows):
        if query is None or query % every:
            continue
        scored = [(-float((q * v).sum()), i is None, i) for j, (i, v) in enumerate(rows) if j != at]
        scored.sort(key=lambda r: (r[0], r[1], r[2] or 0))
        found += [(query, n, i, round(-s, 9)) for n, (s, _, i) in enumerate(scored[:k], 1)]
    return sorted(found, key=str)


def frame(spark, vectors, partitions=3):
    rows = [(i, v, 1, "x", "x", "x") for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA).repartition(partitions)


def got(df, k, every):
    rows = nearest.nearest(df, F.col("vec_id") % every == 0, k=k).collect()
    return sorted([(r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in rows], key=str)


@pytest.fixture
def exact(monkeypatch):
    """Every list is probed and no test fails a neighbour."""
    monkeypatch.setattr(nearest, "WANTED_RECALL", 1.0)
    monkeypatch.setattr(nearest, "RISK", 0.0)
    monkeypatch.setattr(nearest, "MOST_TRIED", 100_000)


def test_edges(spark, exact):
    """Null ids, vectors and components, zero and odd lengths, ties, repeated rows, clashing columns; few rows."""
    vectors = [
        (0, [1.0, 2.0, 3.0]),
        (1, [1.0, 2.0, 3.0]),
        (2, [-1.0, 0.5, 0.0]),
        (2, [-1.0, 0.5, 0.0]),
        (2, [4.0, 4.0, 4.0]),
        (None, [3.0, 2.0, 1.0]),
        (4, None),
        (6, []),
        (8, [0.0, 0.0, -0.0]),
        (10, [1.0, None, 3.0]),
        (12, [1.0, float("nan"), 3.0]),
        (14, [1.0, float("inf"), 3.0]),
        (16, [1.0, 2.0]),
        (18, [0.0, 0.0, 1e-3]),
        (-20, [1e4, -1e4, 0.0]),
    ]
    for k in (3, 50):
        assert got(frame(spark, vectors), k, 2) == brute(vectors, k, 2)
    assert got(frame(spark, []), 5, 2) == []
    assert got(frame(spark, [(4, None), (6, [])]), 5, 2) == []
    assert got(frame(spark, [(4, [1.0])]), 5, 2) == []


def test_copies_and_ties_equal_brute_force(spark, exact):
    """A third of all rows have one vector, many others come twice; lengths differ widely."""
    random = np.random.default_rng(3)
    vectors = [(i, (random.standard_normal(24) * random.choice([0.2, 1, 3])).tolist()) for i in range(400)]
    vectors += [(400 + i, vectors[7][1]) for i in range(300)] + [(700 + i, vectors[i][1]) for i in range(200)]
    vectors += [(900 + i, [float(x) for x in random.integers(-1, 2, 24)]) for i in range(100)]
    assert got(frame(spark, vectors, 5), 10, 7) == brute(vectors, 10, 7)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_query_recall(spark, size):
    rows = spark.read.parquet(f"/root/testdata/{size}/embeddings.parquet").collect()
    want = brute([(r["vec_id"], r["embedding"]) for r in rows], 20, 20)
    result = QUERIES["op13_nearest"](spark, f"/root/testdata/{size}")
    assert [f"{f.name} {f.dataType.simpleString()}" for f in result.schema] == [
        "query_id bigint", "rank int", "vec_id bigint", "score double"
    ]
    found = result.collect()
    assert len(found) == len(want)
    scores = {(q, i): s for q, _, i, s in brute([(r["vec_id"], r["embedding"]) for r in rows], 10**9, 20)}
    assert all(abs(scores[r["query_id"], r["vec_id"]] - r["score"]) < 1e-9 for r in found)
    both = {(q, i) for q, _, i, _ in want} & {(r["query_id"], r["vec_id"]) for r in found}
    assert len(both) >= 0.93 * len(want)
    ranked = sorted((r["query_id"], r["rank"], -r["score"]) for r in found)
    assert all(a[2] <= b[2] for a, b in zip(ranked, ranked[1:]) if a[0] == b[0])


def test_components_keep_their_precision(spark, exact):
    """Doubles that single precision would round are searched as they are."""
    random = np.random.default_rng(9)
    vectors = [(i, random.standard_normal(8).tolist()) for i in range(60)]
    vectors += [(60, [1.0 + 1e-12, *[0.0] * 7]), (61, [1.0, *[0.0] * 7])]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = nearest.nearest(df, F.col("vec_id") % 20 == 0, k=61).collect()
    scores = {(r["query_id"], r["vec_id"]): r["score"] for r in rows}
    points = {i: np.array(v) for i, v in vectors}
    assert len(rows) == 4 * 61 and all(s == (points[q] * points[i]).sum() for (q, i), s in scores.items())
    assert scores[20, 60] != scores[20, 61]


def test_clustered_vectors_probe_few_lists(spark):
    """Where vectors lie in groups, few lists hold the neighbours, and those are found."""
    random = np.random.default_rng(5)
    middle = random.standard_normal((60, 32)) * 3
    points = middle[random.integers(0, 60, 3000)] + random.standard_normal((3000, 32)) * 0.3
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    vectors = [(i, p.tolist()) for i, p in enumerate(points)]
    df = frame(spark, vectors)
    model = nearest._fit(nearest._distinct(nearest._whole(df, F.lit(True), "vec_id", "embedding"), 20), 20)
    assert model.probes <= len(model.centres) / 3
    want = brute(vectors, 20, 50)
    both = {(q, i) for q, _, i, _ in want} & {(q, i) for q, _, i, _ in got(df, 20, 50)}
    assert len(both) >= 0.93 * len(want)


def test_abandoned_early():
    """Far candidates leave before all dimensions are read, near ones stay to the end."""
    random = np.random.default_rng(1)
    dims = 128
    model = nearest._Model("f8", 1.0, np.linalg.qr(random.standard_normal((dims, dims)))[0], np.empty((0, dims)), 1)
    base = random.standard_normal(dims - 1)
    base /= np.linalg.norm(base) * 1.0001
    near = base + random.standard_normal((50, dims - 1)) * 0.01
    near /= np.linalg.norm(near, axis=1, keepdims=True) * 1.0001
    far = random.standard_normal((2000, dims - 1))
    far /= np.linalg.norm(far, axis=1, keepdims=True) * 1.0001
    spread = model.spread(np.concatenate([near, far])).astype(np.float32)
    columns = [np.ascontiguousarray(spread[:, d : d + 16].T) for d in range(0, dims, 16)]
    asks = model.spread(base[None], as_queries=True).astype(np.float32)
    reach = np.array([0.05], np.float32)
    read = []

    class Counted(np.ndarray):
        @property
        def T(self):
            read.append(1)
            return np.asarray(self).T

    limits = nearest._limits(dims)
    q, c = nearest._left(asks, [m.view(Counted) for m in columns], reach, limits, 5)
    inside = {i for i in range(50) if ((asks[0] - spread[i]) ** 2).sum() <= 0.05}
    assert set(c.tolist()) == inside and len(inside) > 10
    assert len(read) >= 6  # after the first blocks single candidates were followed, not all


def test_limits_follow_the_law():
    """A random rotation leaves a larger share in the first dimensions with about the stated chance."""
    random = np.random.default_rng(2)
    points = random.standard_normal((200_000, 65))
    shares = (points**2).cumsum(axis=1) / (points**2).sum(axis=1, keepdims=True)
    for i, limit in enumerate(nearest._limits(65)):
        above = (shares[:, (i + 1) * nearest.COLUMNS - 1] > limit).mean()
        assert 0.3 * nearest.RISK < above < 3 * nearest.RISK
