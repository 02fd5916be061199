"""Merkle manifest of a dataset: one tree per group of rows, one tree over the groups' roots.

Rows are ranked within their group from one global sorted index, so no group is sorted in one task. The rank's
hexadecimal digits are columns; a block holds the 256 rows that differ in the last two digits only. Grouping the last
digit away nests up to 16 rows in a run and hashes them, grouping away the next nests the runs, so a block is one row
of bounded size that holds its whole subtree. The blocks' digests are the rows of the next, 256 times smaller table,
until a group has one block. From the top down, the path above a block is put into the block's row, by one grouping of
both, and a transform and an explode of the nested structs emit one proof per row.

Built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import ref
from tierflow.operators.split import MOST_BROADCAST_ROWS, with_row_index

from . import common

# Children of a node, and the bits of one digit of a rank.
FAN = 16
BITS = 4
# Levels of the tree that one block nests.
DIGITS = 2

_PATH = T.ArrayType(T.StructType().add("left", T.StringType()).add("right", T.StringType()))


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the parts in a row."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as its UTF-8 byte count, a colon and its text, or ``-`` for null."""
    texts = [value.cast("string") for value in values]
    sized = [F.concat(F.octet_length(text).cast("string"), F.lit(":"), text) for text in texts]
    return digest(*(F.coalesce(field, F.lit("-")) for field in sized))


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and its siblings."""
    return F.aggregate(path, leaf, lambda node, level: digest(level["left"], node, level["right"]))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    levels = F.transform(path, lambda level: F.concat(level["left"], level["right"]))
    return F.sha2(F.array_join(levels, ""), 256)


def manifest(
    docs: DataFrame,
    fields: Sequence[str],
    group_col: str = "source",
    id_col: str = "doc_id",
    carry: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Proof of each row: ``id_col, leaf, subroot, root, path`` and the columns ``carry``.

    ``path`` lists the siblings of the row's node at each level, as the texts left and right of it, from the leaf
    to ``root``; ``folded(leaf, path)`` equals ``root`` for a row as it was. ``leaf`` is the digest of ``fields``.
    Within a group rows ascend by id, null first, then by leaf; groups ascend bytewise, the null group first. A group of
    one row has the leaf as ``subroot``, and a table of one group its ``subroot`` as ``root``. Repeated rows are leaves
    of their own with one digest. Texts of any length give leaves of one size; other columns are not looked at. An
    empty table gives an empty result. Calling this runs jobs.
    """
    carried = carry or {}
    leaves = common.stage(
        docs.select(
            ref(group_col).alias("group"),
            ref(id_col).alias("id"),
            leaf_digest([ref(c) for c in fields]).alias("node"),
            F.struct(ref(id_col).alias("id"), *(value.alias(name) for name, value in carried.items())).alias("load"),
        ),
        "merkle-leaves",
    )
    groups = _in_groups(with_row_index(leaves, ["group", "id", "node"], index_col="rank"))
    group_tables = _rolled(groups)
    subroots = group_tables[-1].select("group", "node")
    ranked = with_row_index(subroots, ["group"], index_col="rank").select(
        F.lit(0).alias("group"), "rank", "node", F.struct(F.col("group").alias("group")).alias("load")
    )
    levels = ranked.agg(_levels(F.count(F.lit(1)))).first()[0]
    top_tables = _rolled(ranked.withColumn("levels", F.lit(levels)))
    root = top_tables[-1].select("node").first()
    start = F.struct(F.array().cast(_PATH).alias("path"), F.lit(None).cast("string").alias("subroot"))
    of_groups = _descended(top_tables, top_tables[-1].withColumn("above", start))
    above = of_groups.select(
        F.col("load.group").alias("group"),
        F.lit(0).cast("long").alias("block"),
        F.struct("path", F.col("node").alias("subroot")).alias("above"),
    )
    proofs = _descended(group_tables, _handed_down(group_tables[-1], above))
    return proofs.select(
        F.col("load.id").alias(id_col),
        F.col("node").alias("leaf"),
        "subroot",
        F.lit(root and root["node"]).cast("string").alias("root"),
        "path",
        *(F.col("load").getField(name).alias(name) for name in carried),
    )


def _levels(rows: Column) -> Column:
    """How often 16 nodes become one until one is left: the hexadecimal digits of the last rank."""
    return F.when(rows > 1, F.length(F.hex(rows - 1))).otherwise(0)


def _in_groups(indexed: DataFrame) -> DataFrame:
    """Turn the global index into the rank within the group; the levels of the group's tree."""
    groups = common.stage(
        indexed.groupBy(F.col("group").alias("of")).agg(
            F.min("rank").alias("start"), _levels(F.count(F.lit(1))).alias("levels")
        ),
        "merkle-groups",
    )
    if groups.count() <= MOST_BROADCAST_ROWS:
        groups = F.broadcast(groups)
    return indexed.join(groups, F.col("group").eqNullSafe(F.col("of"))).select(
        "group", "levels", (F.col("rank") - F.col("start")).alias("rank"), "node", "load"
    )


def _rolled(items: DataFrame) -> list[DataFrame]:
    """Tables of blocks (group, levels, block, node, kids), the next one over the digests of the one before."""
    tables: list[DataFrame] = []
    while True:
        tables.append(common.stage(_blocks(items, DIGITS * len(tables)), "merkle-blocks"))
        deepest = tables[-1].agg(F.max("levels")).first()[0] or 0
        if deepest <= DIGITS * len(tables):
            return tables
        items = tables[-1].select(
            "group", "levels", F.col("block").alias("rank"), "node", F.struct("block").alias("load")
        )


def _blocks(items: DataFrame, level: int) -> DataFrame:
    """Group the last digits of the rank away, one after the other; runs hash where the tree has that level."""

    def digit(i: int) -> Column:
        return F.shiftright("rank", BITS * i).bitwiseAND(F.lit(FAN - 1)).alias(f"digit{i}")

    block = F.shiftright("rank", BITS * DIGITS).alias("block")
    # dealt by block once; every grouping below finds its rows in place
    nested = items.select(
        "group", "levels", block, *map(digit, range(DIGITS)), F.struct("node", "load").alias("kid")
    ).repartition("group", "block")
    for i in range(DIGITS):
        keys = ["group", "levels", "block", *(f"digit{j}" for j in range(i + 1, DIGITS))]
        runs = nested.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(f"digit{i}", "kid"))).alias("run"))
        kids = F.transform("run", lambda member: member["kid"]).alias("kids")
        joined = F.sha2(F.array_join(F.col("kids.node"), ""), 256)
        node = F.when(F.col("levels") > level + i, joined).otherwise(F.col("kids")[0]["node"]).alias("node")
        nested = runs.select(*keys, kids).select(*keys, F.struct(node, F.col("kids")).alias("kid"))
    return nested.select("group", "levels", "block", "kid.node", "kid.kids")


def _handed_down(blocks: DataFrame, above: DataFrame) -> DataFrame:
    """The rows of ``blocks`` with what lies ``above`` each: one grouping of both, a block having one row in each."""
    both = blocks.unionByName(above, allowMissingColumns=True)
    names = ("levels", "kids", "above")
    return both.groupBy("group", "block").agg(*(F.first(c, ignorenulls=True).alias(c) for c in names))


def _descended(tables: list[DataFrame], top: DataFrame) -> DataFrame:
    """Emit the nodes below ``top``, the last of the tables, table by table: load, node, path, subroot."""
    blocks = top
    for level in range(len(tables) - 1, 0, -1):
        emitted = _emitted(blocks, DIGITS * level).select(
            "group", F.col("load.block").alias("block"), F.struct("path", "subroot").alias("above")
        )
        blocks = _handed_down(tables[level - 1], emitted)
    return _emitted(blocks, 0)


def _emitted(blocks: DataFrame, level: int) -> DataFrame:
    """One row per node that the blocks nest, with the siblings on its way up."""

    def siblings(at: int, nodes: Column, place: Column) -> Column:
        left = F.array_join(F.slice(nodes, F.lit(1), place), "")
        right = F.array_join(F.slice(nodes, place + 2, F.lit(FAN)), "")
        step = F.array(F.struct(left.alias("left"), right.alias("right")))
        return F.when(F.col("levels") > at, step).otherwise(F.array().cast(_PATH))

    def proofs(run: Column, i: Column) -> Column:
        return F.transform(
            run["kids"],
            lambda kid, j: F.struct(
                kid["load"].alias("load"),
                kid["node"].alias("node"),
                F.concat(
                    siblings(level, run["kids"]["node"], j), siblings(level + 1, F.col("kids")["node"], i)
                ).alias("below"),
            ),
        )

    found = F.explode(F.flatten(F.transform("kids", proofs))).alias("found")
    return blocks.select("group", "above", found).select(
        "group",
        "found.load",
        "found.node",
        F.concat("found.below", "above.path").alias("path"),
        F.col("above.subroot").alias("subroot"),
    )
