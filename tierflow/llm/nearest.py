"""Approximate nearest neighbours by inner product: inverted lists, scanned dimension by dimension.

One more component per vector makes all of them equally long, so that the largest inner product is the smallest
distance. A random rotation spreads every distance evenly over the dimensions. Vectors fall into lists by nearest
centre; a list is stored in blocks of rows, each a few matrices of some rotated dimensions for all its rows. A batch of
queries that probe the list meets each block. After every matrix the distances so far are tested: under a random
rotation the share of a squared distance that lies in ``d`` of ``D`` dimensions follows a Beta(d/2, (D-d)/2) law, so a
candidate whose partial distance is more than the share that the query's bound could reach is abandoned. What is
left gets its inner product in double precision from the vectors as they came. The bound is that of the nearest
neighbours in the first few lists of each query, which are searched before the others.

Equal vectors are searched once, so copies without number cost one candidate. Centres and the number of lists
to probe are fitted on a bounded sample; all vectors are indexed.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import ref

from .common import groups_of_rows, stage

# The sample: vectors that the centres are fitted on, of which so many serve as queries, and the share of their
# neighbours that the probed lists have to hold.
MOST_FITTED = 16_384
MOST_TRIED = 512
WANTED_RECALL = 0.97
ROUNDS = 8
# Lists: half the root of the number of vectors, at most so many.
MOST_LISTS = 1024
# The part of the probed lists that is searched first, for the bounds.
FIRST_SHARE = 8
# Rows of a block and of a batch of queries, and dimensions of a column block.
BLOCK_ROWS = 1024
BATCH_ROWS = 128
COLUMNS = 16
# Chance that a test abandons a neighbour, and what single precision may add to a squared distance of at most 4.
RISK = 0.001
SLACK = 2e-5
# Below this share of candidates left, they are followed one by one.
FEW_LEFT = 0.1
_SEED = 20_000


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """The ``k`` nearest rows found for each query row: ``query_id, rank, id_col, score``.

    ``score`` is the inner product in double precision; the largest is nearest, equal ones rank by ascending id, null
    last. Every row but the query's own is a candidate, all of them if there are fewer than ``k``. Vectors
    that are null, empty, zero, hold a null or non-finite component, or are not of the table's most frequent length
    (of equally frequent ones the greatest) take no part. Rows that repeat an id or a vector are candidates each for
    itself, and a query row that is repeated has its ranks repeated. A row for which ``is_query`` is null is no query;
    other columns are not looked at. An empty table gives an empty result. Calling this runs jobs.
    """
    rows = _whole(vectors, is_query, id_col, vector_col)
    nodes = _distinct(rows, k)
    model = _fit(nodes, k)
    if model is None:
        ids = vectors.select(ref(id_col)).schema[0].dataType
        return vectors.sparkSession.createDataFrame(
            [], f"query_id bigint, rank int, `{id_col}` {ids.simpleString()}, score double"
        )
    placed = stage(nodes.mapInArrow(_placer(model), _PLACED), "nearest-placed")
    blocks = _blocks(placed)
    queries = placed.filter("probes is not null").select("node", "vector", "probes")
    first = max(1, model.probes // FIRST_SHARE)
    best = _best(queries.withColumn("bound", F.lit(-math.inf)), blocks, model, k, 1, first)
    if model.probes > first:
        bounds = best.groupBy(F.col("query").alias("node")).agg(
            F.when(F.count(F.lit(1)) > k, F.min("score")).alias("bound")
        )
        bounded = stage(
            queries.join(bounds, "node", "left").withColumn("bound", F.coalesce("bound", F.lit(-math.inf))),
            "nearest-bounded",
        )
        rest = _best(bounded, blocks, model, k, first + 1, model.probes - first)
        best = _top(best.unionByName(rest), k)
    return _expanded(rows, nodes, best, k, id_col)


# ---- rows and distinct vectors --------------------------------------------------------------------


def _whole(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector, asked) of the rows that take part; vectors of single precision stay so, all others are doubles."""
    single = vectors.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    rows = vectors.select(
        ref(id_col).alias("id"),
        (ref(vector_col) if single else ref(vector_col).cast("array<double>")).alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    )
    finite = F.forall("vector", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    rows = rows.filter(finite & F.exists("vector", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vector").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims"))
    most = sizes.first()
    return rows.filter(F.size("vector") == (most["dims"] if most else 0))


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """(node, vector, asked, members): each vector once, with the ids of its first ``k + 1`` rows.

    Each task passes on at most that many rows of a vector, those asked for and the others.
    """
    place = F.row_number().over(Window.partitionBy("vector", "asked").orderBy(F.col("id").asc_nulls_last()))
    few = rows.withColumn("place", place).filter(F.col("place") <= k + 1)
    ids = F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("none"), "id")))
    nodes = few.groupBy("vector").agg(F.slice(ids, 1, k + 1).alias("first"), F.max("asked").alias("asked"))
    return stage(
        nodes.select(F.monotonically_increasing_id().alias("node"), "vector", "asked", F.col("first.id").alias("members")),
        "nearest-vectors",
    )


def _expanded(rows: DataFrame, nodes: DataFrame, best: DataFrame, k: int, id_col: str) -> DataFrame:
    """Rows for vectors: the members of each query's best vectors, without the query's own row."""
    hit = F.struct("score", (F.col("query") == F.col("node")).alias("own"), "members")
    hits = best.join(nodes.select("node", "members"), "node").groupBy("query").agg(F.collect_list(hit).alias("hits"))
    asked = rows.filter("asked").join(nodes.filter("asked").select("vector", F.col("node").alias("query")), "vector")

    def without_own(found: Column) -> Column:
        own = F.array_position(found["members"], F.col("query_id")) - 1
        others = F.filter(found["members"], lambda _, i: i != own)
        return F.when(found["own"], others).otherwise(found["members"])

    ranked = F.flatten(
        F.transform(
            "hits",
            lambda found: F.transform(
                without_own(found),
                lambda member: F.struct((-found["score"]).alias("far"), member.isNull().alias("none"), member.alias("id")),
            ),
        )
    )
    return (
        asked.select("query", F.col("id").alias("query_id"))
        .join(hits, "query")
        .select("query_id", F.posexplode(F.slice(F.sort_array(ranked), 1, k)).alias("place", "hit"))
        .select(
            "query_id",
            (F.col("place") + 1).alias("rank"),
            F.col("hit.id").alias(id_col),
            (-F.col("hit.far")).alias("score"),
        )
    )


# ---- the fit --------------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Model:
    kind: str  # of the components as they came
    norm: float  # of the longest vector, which all are divided by
    rotation: np.ndarray
    centres: np.ndarray
    probes: int

    @property
    def dims(self) -> int:
        return len(self.rotation)

    def spread(self, vectors: np.ndarray, as_queries: bool = False) -> np.ndarray:
        """Scaled, lengthened to 1 (a query by nothing) and rotated."""
        scaled = vectors / self.norm
        rest = np.zeros(len(scaled)) if as_queries else np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        return np.column_stack([scaled, rest]) @ self.rotation

    def by_distance(self, points: np.ndarray) -> np.ndarray:
        """Distance to each centre, less what all have in common."""
        return (self.centres**2).sum(axis=1) - 2 * points @ self.centres.T


def _fit(nodes: DataFrame, k: int) -> _Model | None:
    # the largest component in a projection of its own, not once more for each component
    scaled = nodes.select("vector", F.array_max(F.transform("vector", F.abs)).alias("largest"))
    largest = F.col("largest")
    squares = F.aggregate("vector", F.lit(0.0), lambda total, x: total + (x / largest) * (x / largest))
    count, norm = scaled.agg(F.count(F.lit(1)), F.max(largest * F.sqrt(squares))).first()
    if not count:
        return None
    every = -(-count // MOST_FITTED)
    drawn = nodes.filter(F.pmod(F.xxhash64("vector"), F.lit(every)) == 0).select("vector")
    sample = _matrix(drawn.limit(2 * MOST_FITTED).toArrow()["vector"].combine_chunks())
    if not len(sample):
        sample = _matrix(nodes.select("vector").limit(1).toArrow()["vector"].combine_chunks())
    kind, sample = sample.dtype.str, sample.astype(float)
    random = np.random.default_rng(_SEED)
    dims = sample.shape[1] + 1
    rotation, _ = np.linalg.qr(random.standard_normal((dims, dims)))
    n_lists = max(1, min(MOST_LISTS, int(math.sqrt(count) / 2), len(sample)))
    start = _Model(kind, norm, rotation, np.empty((0, dims)), 1)
    points = start.spread(sample)
    model = _Model(kind, norm, rotation, points[random.choice(len(points), n_lists, replace=False)].copy(), n_lists)
    for _ in range(ROUNDS):
        nearest_centre = model.by_distance(points).argmin(axis=1)
        sizes = np.bincount(nearest_centre, minlength=n_lists)
        sums = np.zeros_like(model.centres)
        np.add.at(sums, nearest_centre, points)
        full = sizes > 0
        model.centres[full] = sums[full] / sizes[full, None]
    return _Model(kind, norm, rotation, model.centres, _probes(model, sample, points, k))


def _probes(model: _Model, sample: np.ndarray, points: np.ndarray, k: int) -> int:
    """The fewest lists that hold the wanted share of the neighbours which sampled queries have in the sample.

    In the whole table the neighbours are nearer than in a sample of it, and so are their lists.
    """
    n_lists, tried = len(model.centres), min(MOST_TRIED, len(sample))
    if len(sample) <= k + 1:
        return n_lists
    scores = sample[:tried] @ sample.T
    scores[np.arange(tried), np.arange(tried)] = -np.inf
    found = np.argpartition(-scores, k - 1, axis=1)[:, :k]
    order = model.by_distance(model.spread(sample[:tried], as_queries=True)).argsort(axis=1)
    place = np.empty_like(order)
    np.put_along_axis(place, order, np.arange(n_lists)[None, :], axis=1)
    lists = model.by_distance(points).argmin(axis=1)
    reached = np.bincount(np.take_along_axis(place, lists[found], axis=1).ravel(), minlength=n_lists).cumsum()
    return int(np.searchsorted(reached, WANTED_RECALL * found.size)) + 1


def _limits(dims: int) -> list[float]:
    """For each column block but the last: the share of a squared distance that lies in the dimensions so far at most."""
    angle = (np.arange(200_000) + 0.5) * (math.pi / 2 / 200_000)
    shares = []
    for d in range(COLUMNS, dims, COLUMNS):
        # Beta(d/2, (dims-d)/2) in the angle, where its density is bounded
        density = (d - 1) * np.log(np.sin(angle)) + (dims - d - 1) * np.log(np.cos(angle))
        chance = np.exp(density - density.max()).cumsum()
        shares.append(float(np.sin(angle[np.searchsorted(chance, (1 - RISK) * chance[-1])]) ** 2))
    return shares


# ---- lists, blocks and batches --------------------------------------------------------------------

_PLACED = "node long, list int, least long, spread binary, vector binary, probes array<int>"


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _bytes_of(matrix: np.ndarray) -> list[bytes]:
    return [row.tobytes() for row in np.ascontiguousarray(matrix)]


def _placer(model: _Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each vector with its list, in rotated form, and for queries the lists to probe, nearest first."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in groups_of_rows([1] * whole.num_rows, BLOCK_ROWS):
                batch = whole.slice(rows.start, rows.stop - rows.start)
                vectors = _matrix(batch.column("vector"))
                spread = model.spread(vectors.astype(float))
                asked = batch.column("asked").to_numpy(zero_copy_only=False)
                asks = model.spread(vectors[asked].astype(float), as_queries=True)
                probes = iter(model.by_distance(asks).argsort(axis=1)[:, : model.probes].tolist())
                # an id that is null ranks last
                least = [m[0].as_py() if m[0].is_valid else np.iinfo(np.int64).max for m in batch.column("members")]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node"),
                        pa.array(model.by_distance(spread).argmin(axis=1).astype(np.int32)),
                        pa.array(least, pa.int64()),
                        pa.array(_bytes_of(spread.astype(np.float32)), pa.binary()),
                        pa.array(_bytes_of(vectors), pa.binary()),
                        pa.array([next(probes) if a else None for a in asked], pa.list_(pa.int32())),
                    ],
                    ["node", "list", "least", "spread", "vector", "probes"],
                )

    return place


def _in_parts(rows: DataFrame, part_rows: int) -> DataFrame:
    """Deal the rows of each list to parts of about ``part_rows``, however many a list has."""
    parts = rows.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / part_rows).alias("parts"))  # MOST_LISTS rows at most
    return rows.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("node"), "parts"))


def _joined(column: pa.ChunkedArray) -> bytes:
    return b"".join(column.to_pylist())


def _blocks(placed: DataFrame) -> DataFrame:
    def pack(rows: pa.Table) -> pa.Table:
        spread = np.frombuffer(_joined(rows["spread"]), np.float32).reshape(rows.num_rows, -1)
        columns = [spread[:, d : d + COLUMNS].T.tobytes() for d in range(0, spread.shape[1], COLUMNS)]
        return pa.table(
            {
                "list": rows["list"].slice(0, 1),
                "nodes": [rows["node"].to_numpy().tobytes()],
                "least": [rows["least"].to_numpy().tobytes()],
                "columns": [columns],
                "vectors": [_joined(rows["vector"])],
            }
        )

    rows = _in_parts(placed.select("node", "list", "least", "spread", "vector"), BLOCK_ROWS)
    kind = "list int, nodes binary, least binary, columns array<binary>, vectors binary"
    return stage(rows.groupBy("list", "part").applyInArrow(pack, kind), "nearest-blocks")


def _batches(queries: DataFrame, start: int, length: int) -> DataFrame:
    """The queries that probe a list, in batches; of each query the lists from ``start`` on."""

    def pack(rows: pa.Table) -> pa.Table:
        return pa.table(
            {
                "list": rows["list"].slice(0, 1),
                "queries": [rows["node"].to_numpy().tobytes()],
                "bounds": [rows["bound"].to_numpy().tobytes()],
                "asked": [_joined(rows["vector"])],
            }
        )

    probes = F.explode(F.slice("probes", start, length)).alias("list")
    rows = _in_parts(queries.select("node", "bound", "vector", probes), BATCH_ROWS)
    kind = "list int, queries binary, bounds binary, asked binary"
    return rows.groupBy("list", "part").applyInArrow(pack, kind)


# ---- the search -----------------------------------------------------------------------------------


def _top(found: DataFrame, k: int) -> DataFrame:
    """The best ``k + 1`` vectors of each query, its own among them."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least", "node")
    return found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + 1).drop("place")


def _best(queries: DataFrame, blocks: DataFrame, model: _Model, k: int, start: int, length: int) -> DataFrame:
    meetings = _batches(queries, start, length).join(blocks, "list").drop("list")
    found = meetings.mapInArrow(_searcher(model, k + 1), "query long, node long, least long, score double")
    return stage(_top(found, k), "nearest-found")


def _searcher(model: _Model, wanted: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    limits = _limits(model.dims)

    def doubles(vectors: pa.Scalar) -> np.ndarray:
        return np.frombuffer(vectors.as_py(), model.kind).reshape(-1, model.dims - 1).astype(float)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                queries, bounds, asked, nodes, least, columns, vectors = (c[row] for c in batch.columns)
                queries, nodes, least = (np.frombuffer(x.as_py(), np.int64) for x in (queries, nodes, least))
                bounds = np.frombuffer(bounds.as_py(), np.float64)
                asked, vectors = doubles(asked), doubles(vectors)
                asks = model.spread(asked, as_queries=True).astype(np.float32)
                matrices = [np.frombuffer(x, np.float32).reshape(-1, len(nodes)) for x in columns.as_py()]
                reach = ((asked / model.norm) ** 2).sum(axis=1) + 1 - 2 * bounds / model.norm / model.norm + SLACK
                q, c = _left(asks, matrices, reach.astype(np.float32), limits, wanted)
                scores = _products(asked, vectors, q, c)
                kept = np.flatnonzero(scores >= bounds[q])
                kept = kept[np.lexsort((least[c[kept]], -scores[kept], q[kept]))]
                place = np.arange(len(kept)) - np.searchsorted(q[kept], q[kept])
                kept = kept[place < wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(queries[q[kept]]), pa.array(nodes[c[kept]]), pa.array(least[c[kept]]), pa.array(scores[kept])],
                    ["query", "node", "least", "score"],
                )

    return search


def _products(asked: np.ndarray, vectors: np.ndarray, q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of pairs, each summed the same way wherever it stands."""
    scores = np.empty(len(q))
    for part in groups_of_rows([1] * len(q), 1 << 15):
        scores[part] = (asked[q[part]] * vectors[c[part]]).sum(axis=1)
    return scores


def _left(
    asks: np.ndarray, matrices: list[np.ndarray], reach: np.ndarray, limits: list[float], wanted: int
) -> tuple[np.ndarray, np.ndarray]:
    """The (query, candidate) pairs that no test abandons, by column block."""
    so_far = np.zeros((len(asks), matrices[0].shape[1]), np.float32)
    pairs = None
    at = 0
    for i, matrix in enumerate(matrices):
        part = asks[:, at : at + len(matrix)]
        at += len(matrix)
        limit = reach * np.float32(limits[i] if i < len(limits) else 1)
        if pairs is None:
            so_far += (part**2).sum(axis=1)[:, None]
            so_far += (matrix**2).sum(axis=0)
            so_far -= 2 * (part @ matrix)
            alive = so_far <= limit[:, None]
            if i < len(limits) and alive.mean() < FEW_LEFT:
                pairs = np.nonzero(alive)
                far = so_far[pairs]
        else:
            q, c = pairs
            far = far + ((part[q] - matrix.T[c]) ** 2).sum(axis=1)
            near = far <= limit[q]
            pairs, far = (q[near], c[near]), far[near]
    if pairs is not None:
        return pairs
    if so_far.shape[1] > wanted:
        nearest_here = np.partition(so_far, wanted - 1, axis=1)[:, wanted - 1]
        alive &= so_far <= nearest_here[:, None] + np.float32(SLACK)
    return np.nonzero(alive)
