"""Near-duplicate classes by HyperMinHash.

A document's set is its distinct 5-word shingles. A sketch has one register for each of a number of hash
functions: the leading-zero count and some mantissa bits of the function's minimum over the set, in two bytes. Each
function sees the whole set (the k-function form), so a short document leaves no register empty. Bands of
compressed registers propose candidates, a collision-corrected estimate sifts them, and the sets decide.

Equal sets are one node. A bucket of n nodes proposes each node with the bucket's hub, its most central node, and with
its smallest node, about 2n pairs; one of three nodes proposes all three pairs. Where that leaves more than one class in a
bucket of four or more, a join on the rarest shingles of the sets concerned proposes the rest. The estimate sifts these pairs
too, before any text is read. Pairs of one class are not listed, but a group of many sets that are all just less alike than the
limit, such as pages of one template, has as many classes as sets, and most of its pairs are verified.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common
from .components import components

WIDTH = 5
PERCENT = 75
# 32 bands of 4 registers: two sets that are 75 % alike share no band with a chance of 5 in a million.
REGISTERS = 128
BAND_ROWS = 4
MANTISSA_BITS = 10
# Pairs are verified from this estimate on: over four and a half standard errors below the limit.
LEAST_ESTIMATE = 0.57
# Fixed value of the HyperMinHash paper (Yu and Weber): chance collisions of a register at equal set sizes, times 2^bits.
COLLISION = 0.169919487159739093975315012348
# Ids up to this number are broadcast to pick their texts (16 MB); more are joined by a shuffle.
MOST_BROADCAST_IDS = 2_000_000

_FACTOR = common._stream(3, REGISTERS) | np.uint64(1)
_SHIFT = common._stream(4, REGISTERS)


def shingle_set(words: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """The sorted set of shingle hashes; fewer words than ``width`` give one for the sequence, none give none."""
    if 0 < len(words) < width:
        return np.array([common.sequence_hash(words)], np.uint64)
    return np.unique(common.shingle_hashes(words, width))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """The sketch of each non-empty set, a row of ``REGISTERS`` two-byte numbers."""
    values = np.concatenate(sets)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    least = np.empty((REGISTERS, len(sets)), np.uint64)
    work = np.empty_like(values)
    for i in range(REGISTERS):
        np.multiply(values, _FACTOR[i], out=work)
        np.add(work, _SHIFT[i], out=work)
        np.minimum.reduceat(work, starts, out=least[i])
    zeros = 53 - np.frexp((least >> np.uint64(11)).astype(np.float64))[1]
    rest = least << (np.minimum(zeros, 62) + 1).astype(np.uint64)
    mantissa = rest >> np.uint64(64 - MANTISSA_BITS)
    return np.ascontiguousarray(((zeros.astype(np.uint64) << np.uint64(MANTISSA_BITS)) | mantissa).astype("<u2").T)


def estimate(left: np.ndarray, right: np.ndarray, left_size, right_size) -> np.ndarray:
    """Jaccard estimates from sketches, less the collisions that chance alone brings."""
    share = (left == right).mean(axis=-1)
    ratio = left_size / right_size
    by_chance = COLLISION * 4 * ratio / (1 + ratio) ** 2 / 2**MANTISSA_BITS
    return share - by_chance


def alike(left: np.ndarray, right: np.ndarray, percent: int = PERCENT) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _digest(values: np.ndarray) -> bytes | None:
    return blake2b(values.tobytes(), digest_size=16).digest() if len(values) else None


def sketches(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, size, print, sketch) of every row; ``print`` is a digest of the set, null for an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in common.texts_in_groups(batch.column(1)):
                words, starts = common.word_hashes(texts)
                sets = [shingle_set(words[a:b]) for a, b in zip(starts[:-1], starts[1:])]
                full = [s for s in sets if len(s)]
                kept = iter(registers(full)) if full else iter(())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[rows.start : rows.stop].cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([_digest(s) for s in sets], pa.binary()),
                        pa.array([next(kept).tobytes() if len(s) else None for s in sets], pa.binary()),
                    ],
                    names=["id", "size", "print", "sketch"],
                )

    return docs.select(id_col, text_col).mapInArrow(run, "id long, size long, print binary, sketch binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(len(column), REGISTERS)


def _bands(nodes: DataFrame) -> DataFrame:
    """(bucket, node): one row for each band of each node's sketch."""
    bands = REGISTERS // BAND_ROWS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = common._stream(5, bands)
        for batch in batches:
            if batch.num_rows:
                packed = _matrix(batch.column(1)).view("<u8")  # four two-byte registers at once
                buckets = common.mix(packed ^ seeds).view(np.int64).ravel()
                ids = np.repeat(batch.column(0).to_numpy(), bands)
                yield pa.RecordBatch.from_arrays([pa.array(buckets), pa.array(ids)], names=["bucket", "node"])

    return nodes.select("node", "sketch").mapInArrow(run, "bucket long, node long")


def _likely(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Those (a, b) whose sketches make them likely."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, sketch_a, size_a, sketch_b, size_b = batch.columns
                guess = estimate(_matrix(sketch_a), _matrix(sketch_b), size_a.to_numpy(), size_b.to_numpy())
                chosen = pa.array(guess >= LEAST_ESTIMATE)
                yield pa.RecordBatch.from_arrays([a.filter(chosen), b.filter(chosen)], names=["a", "b"])

    def side(name: str) -> DataFrame:
        columns = {"node": name, "sketch": f"sketch_{name}", "size": f"size_{name}"}
        return nodes.select([F.col(c).alias(to) for c, to in columns.items()])

    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.select("a", "b", "sketch_a", "size_a", "sketch_b", "size_b").mapInArrow(run, "a long, b long")


def _texts(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``ids`` (node, ...) with the texts of their documents; few ids are broadcast."""
    few = ids.count() <= MOST_BROADCAST_IDS
    texts = docs.select(F.col(id_col).cast("long").alias("id"), common.whole_text(text_col).alias("text"))
    return texts.join(F.broadcast(ids) if few else ids, F.col("id") == F.col("node")).drop("id")


def _verified(pairs: DataFrame, docs: DataFrame, id_col: str, text_col: str, label: str) -> DataFrame:
    """Those (a, b) whose full sets are alike enough."""
    pairs = common.stage(pairs, f"{label}-pairs")
    if pairs.isEmpty():
        return pairs
    ids = common.stage(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{label}-ids")
    texts = common.stage(_texts(docs, ids, id_col, text_col), f"{label}-texts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, None  # rows come sorted by b
        for batch in batches:
            linked = []
            for b, text_b, text_a in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
                if b != last or last_set is None:
                    last, last_set = b, shingle_set(common.word_hashes([text_b.as_py()])[0])
                linked.append(alike(shingle_set(common.word_hashes([text_a.as_py()])[0]), last_set))
            linked = pa.array(linked, pa.bool_())
            both = [batch.column(i).filter(linked) for i in range(2)]
            yield pa.RecordBatch.from_arrays(both, names=["a", "b"])

    with_a = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a")
    with_b = with_a.join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return common.stage(with_b.select("a", "b", "text_b", "text_a").mapInArrow(run, "a long, b long"), f"{label}-links")


def _shingles_of(docs: DataFrame, ids: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, class, size, shingle): the sets of the documents in ``ids`` (node, class)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, kind, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                found = shingle_set(common.word_hashes([text.as_py()])[0]).view(np.int64)
                same = [pa.array(np.full(len(found), x, np.int64)) for x in (node, kind, len(found))]
                yield pa.RecordBatch.from_arrays([*same, pa.array(found)], names=["node", "class", "size", "shingle"])

    texts = _texts(docs, ids, id_col, text_col)
    return texts.select("node", "class", "text").mapInArrow(run, "node long, class long, size long, shingle long")


def _remaining(docs: DataFrame, members: DataFrame, classes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Pairs between the classes that are left in buckets of four or more, and that may be links.

    No link is left out, by the prefix filter: shingles are ordered by how few of these sets have them. Two sets that are alike
    share one of the first quarter of either, and at the first that they share enough of both must still lie ahead.
    Only rows outside the commonest class of a shingle look for partners.
    """
    found = members.filter("n > 3").join(classes, "node", "left").select(
        "bucket", "node", F.coalesce("component", "node").alias("class")
    )
    ends = found.groupBy("bucket").agg(F.min("class").alias("first"), F.max("class").alias("last"))
    unsettled = ends.filter("first < last")
    ids = found.join(unsettled, "bucket", "left_semi").select("node", "class").distinct()
    sets = common.stage(_shingles_of(docs, common.stage(ids, "near-open"), id_col, text_col), "near-sets")
    shared = sets.groupBy("shingle").agg(F.count(F.lit(1)).alias("sets"))
    ordered = Window.partitionBy("node").orderBy("sets", "shingle")
    places = sets.join(shared, "shingle").withColumn("place", F.row_number().over(ordered) - 1)
    first = places.filter(F.col("place") * 100 <= F.col("size") * (100 - PERCENT))
    heads = common.stage(first.select("node", "class", "size", "shingle", "place"), "near-heads")
    commonest = (
        heads.groupBy("shingle", "class")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("shingle")
        .agg(F.max_by("class", "n").alias("main"), F.count(F.lit(1)).alias("classes"))
        .filter("classes > 1")
        .select("shingle", "main")
    )
    mixed = common.stage(heads.join(commonest, "shingle"), "near-mixed")
    left = mixed.filter(F.col("class") != F.col("main"))
    a, b = left.alias("a"), mixed.alias("b")
    ahead = F.least(F.col("a.size") - F.col("a.place"), F.col("b.size") - F.col("b.place"))
    enough = ahead * (100 + PERCENT) >= (F.col("a.size") + F.col("b.size")) * PERCENT
    met = a.join(b, (F.col("a.shingle") == F.col("b.shingle")) & (F.col("a.class") != F.col("b.class")) & enough)
    return met.select(F.greatest("a.node", "b.node").alias("a"), F.least("a.node", "b.node").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's near-duplicate class: ``id_col, n_shingles, component_id, kept``.

    Words are runs without white space, A to Z in lower case. Rows are linked whose sets have an intersection of at
    least 75 % of their union; ``component_id`` is the smallest id reachable over links, and rows with that
    id are kept. Fewer than five words make one shingle; a null or empty text has an empty set and is linked with
    nothing. A row with a null id has the class of its equals, or none (null) if they have no id either, and is then
    kept. Repeated rows get equal results. Other columns are not looked at. An empty table gives an empty result.
    """
    found = common.stage(sketches(docs, id_col, text_col), "near-sketches")
    nodes = common.stage(
        found.filter("size > 0 and id is not null")
        .groupBy("print")
        .agg(F.min("id").alias("node"), F.any_value("sketch").alias("sketch"), F.any_value("size").alias("size")),
        "near-nodes",
    )
    bands = _bands(nodes)
    ends = F.min("node").alias("lo"), F.max("node").alias("hi")
    counts = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), *ends).filter("n > 1")
    members = common.stage(bands.join(counts, "bucket"), "near-members")
    # a node amid its group shares large buckets with it: the most central one of a bucket is its hub
    central = members.groupBy("node").agg(F.sum("n").alias("met"))
    hub = members.join(central, "node").groupBy("bucket").agg(F.max_by("node", F.struct("met", "node")).alias("hub"))
    # of three nodes the hub may be the smallest: with the largest as well all pairs are proposed
    partners = F.when(F.col("n") == 3, F.array("hub", "lo", "hi")).otherwise(F.array("hub", "lo"))
    hubs = members.join(hub, "bucket").select("node", F.explode(partners).alias("hub"))
    hubs = hubs.filter("node <> hub")
    pairs = hubs.select(F.greatest("node", "hub").alias("a"), F.least("node", "hub").alias("b")).distinct()
    links = _verified(_likely(pairs, nodes), docs, id_col, text_col, "near")
    classes = common.stage(components(links), "near-classes")
    rest = _remaining(docs, members, classes, id_col, text_col)
    more = _verified(_likely(rest, nodes), docs, id_col, text_col, "near-more")
    if not more.isEmpty():
        merged = classes.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more.select("a", "b"))
        classes = common.stage(components(merged), "near-classes")
    component = F.coalesce("component", "node").alias("component")
    prints = common.stage(nodes.join(classes, "node", "left").select("print", component), "near-prints")
    return (
        found.join(prints, "print", "left")
        .withColumn("component_id", F.when(F.col("size") == 0, F.col("id")).otherwise(F.col("component")))
        .select(
            F.col("id").alias(id_col),
            F.col("size").alias("n_shingles"),
            "component_id",
            F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that are kept, with all columns of ``docs``; see `near_duplicates`."""
    found = near_duplicates(docs, id_col, text_col)
    dropped = common.stage(found.filter("not kept").select(F.col(id_col).alias("dropped")).distinct(), "near-dropped")
    few = dropped.count() <= MOST_BROADCAST_IDS
    return docs.join(F.broadcast(dropped) if few else dropped, F.col(id_col) == F.col("dropped"), "left_anti")
