"""CSV files bound by their own headers: columns may be moved, added or missing from file to file."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow import storage
from tierflow.functions import clean_name
from tierflow.sources.files import MALFORMED, UNKNOWN, settings_of

# Headers are read by so many threads; each reads the first line of a file.
READERS = 16

# Number types from narrow to wide; any other two different types meet in text.
_WIDENING = (T.IntegerType(), T.LongType(), T.DoubleType())


@dataclass(frozen=True)
class HeaderGroup:
    """The files that begin with one header line, and the column names in it."""

    names: tuple[str, ...]
    paths: tuple[str, ...]

    def places(self) -> dict[str, int]:
        """Position of each column by cleaned name; of names that clean to the same, the first."""
        found: dict[str, int] = {}
        for i, name in enumerate(self.names):
            found.setdefault(clean_name(name), i)
        return found


def literal_path(path: str) -> str:
    """``path`` with the characters that a reader would take for a pattern escaped."""
    return "".join(f"\\{c}" if c in "[]{}*?\\" else c for c in path)


def by_header(spark: SparkSession, paths: Sequence[str], **options: object) -> list[HeaderGroup]:
    """The files grouped by their header line; files without any line are left out.

    One line of each file is read on the driver, beside the listing that holds the file's name. How a line splits into
    names is left to Spark's reader, once for each different header.
    """
    encoding = str(options.get("encoding", options.get("charset", "UTF-8")))
    with ThreadPoolExecutor(max_workers=READERS) as pool:
        lines = list(pool.map(lambda path: storage.first_line(spark, path, encoding), paths))
    groups = defaultdict(list)
    for path, line in zip(paths, lines):
        if line is not None:
            groups[line].append(path)
    # as a row of values: as column names, those that occur twice would be changed
    settings = settings_of("csv", options | {"header": "false", "inferSchema": "false"})
    found = []
    for _, same in sorted(groups.items()):
        first = spark.read.options(**settings).csv(literal_path(same[0])).first()
        names = tuple(f"_c{i}" if name is None else name.strip("\ufeff") for i, name in enumerate(first))
        found.append(HeaderGroup(names, tuple(same)))
    return found


def read_by_header(
    spark: SparkSession,
    groups: Iterable[HeaderGroup],
    schema: T.StructType,
    technical: Sequence[str] = (),
    **options: object,
) -> DataFrame | None:
    """The rows of all groups as text: the columns of ``schema`` under cleaned names, null where a file has none.

    A column that the schema does not name goes to the JSON column ``UNKNOWN``, under its cleaned name; one that is
    called like another of its file, or like one of ``technical``, gets its position as a suffix. A line that does not
    parse is in ``MALFORMED``. One scan per header, projections and a union, no shuffle. None without a group.
    """
    parts = [_bound(spark, group, schema, technical, options) for group in groups]
    rows = None
    for part in parts:
        rows = part if rows is None else rows.unionAll(part)
    return rows


def _bound(
    spark: SparkSession, group: HeaderGroup, schema: T.StructType, technical: Sequence[str], options: dict
) -> DataFrame:
    columns = [f"__{i}" for i in range(len(group.names))]
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*columns, MALFORMED]])
    # bound by position, each group by the header that its files have in common
    settings = settings_of("csv", options | {"enforceSchema": "true", "columnNameOfCorruptRecord": MALFORMED})
    raw = spark.read.schema(text).options(**settings).csv([literal_path(p) for p in group.paths])
    places = group.places()
    wanted = [clean_name(f.name) for f in schema]
    known = [
        (F.col(columns[places[name]]) if name in places else F.lit(None).cast("string")).alias(name) for name in wanted
    ]
    taken = {places[name] for name in wanted if name in places}
    unknown = [
        F.col(columns[i]).alias(_own_name(group, i, technical)) for i in range(len(columns)) if i not in taken
    ]
    rest = F.lit(None).cast("string")
    if unknown:
        rest = F.nullif(F.to_json(F.struct(*unknown)), F.lit("{}"))
    return raw.select(*known, F.col(MALFORMED), rest.alias(UNKNOWN), F.col("_metadata.file_path").alias("__file"))


def _own_name(group: HeaderGroup, place: int, technical: Sequence[str]) -> str:
    name = clean_name(group.names[place])
    return name if group.places()[name] == place and name not in technical else f"{name}_{place}"


def infer_by_header(
    spark: SparkSession, groups: Iterable[HeaderGroup], known: T.StructType | None = None, **options: object
) -> T.StructType:
    """``known``, and the columns of the groups that it does not name, with types inferred from all their rows.

    Where groups differ in a column's type, numbers meet in the wider type and all else in text.
    """
    fields = {clean_name(f.name): f for f in known or T.StructType()}
    fixed = set(fields)
    settings = settings_of("csv", {"inferSchema": "true", "enforceSchema": "true"} | options)
    for group in groups:
        new = {name: i for name, i in group.places().items() if name not in fixed}
        if not new:
            continue
        inferred = spark.read.options(**settings).csv([literal_path(p) for p in group.paths]).schema
        for name, i in new.items():
            kind = inferred[i].dataType
            if name in fields:
                kind = wider(fields[name].dataType, kind)
            fields[name] = T.StructField(fields[name].name if name in fields else group.names[i], kind)
    return T.StructType(list(fields.values()))


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The type that holds the values of both."""
    if a == b:
        return a
    if a in _WIDENING and b in _WIDENING:
        return max(a, b, key=_WIDENING.index)
    return T.StringType()
