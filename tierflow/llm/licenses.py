"""License scanning: MinHash bands over overlapping windows retrieve templates, exact containment verifies them.

Built-in expressions only. Shingles are pairs of neighbouring words. Templates fall into classes of like length, and each
class has its own windows: an occurrence lies wholly in at least one of them, and the window is little longer, so
its Jaccard similarity with the template is at least ``least_jaccard``. The number of bands follows from that and
``MOST_MISSED``. A window that holds a template also holds most of the shingles that are minima of the template, so
only windows with as many minima get a signature. Where a template has too few minima for that to tell, as a long one
has, all of its shingles stand for them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

# Share of a template's shingles that a window must hold.
LEAST_CONTAINED = 0.75
BAND_ROWS = 2
# Chance that a window which holds a template shares no band with it.
MOST_MISSED = 1e-4
# Lengths of a class differ by this factor at most; windows start every so many parts of the class's length.
CLASS_RATIO = math.sqrt(2)
STRIDE_PARTS = 8
# Templates are taken in parts of about so many words, which bounds what is broadcast and what the driver holds.
PART_WORDS = 100_000

# Notices by their usual short names, and the standard texts and file headers of ``license_texts``.
TEMPLATES = {
    "all-rights-reserved": "All rights reserved",
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"
    ),
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}
_CREATIVE_COMMONS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
TEMPLATES |= {
    f"cc-{short}-4.0-notice": f"This work is licensed under a Creative Commons {name} 4.0 International License"
    for short, name in _CREATIVE_COMMONS.items()
}
TEMPLATES |= {
    f"{path.stem}-text".replace("-header-text", "-header"): path.read_text(encoding="utf-8")
    for path in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))
}
_PARTING = r"[\x20\x09-\x0D\p{Punct}]+"


def words_of(text: Column) -> Column:
    """Lower-case words; white space and ASCII punctuation part them."""
    return F.array_remove(F.split(F.lower(text), _PARTING), "")


def _pair(words: Column, i: Column) -> Column:
    return F.xxhash64(words[i], words[i + 1])


def _shingles(words: Column) -> Column:
    pairs = F.transform(F.sequence(F.lit(0), F.size(words) - 2), lambda i: _pair(words, i))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(F.array().cast("array<bigint>"))


@dataclass(frozen=True)
class Windows:
    """The windows of a class of templates of ``shortest`` to ``longest`` words."""

    shortest: int
    longest: int

    @property
    def stride(self) -> int:
        return max(1, self.longest // STRIDE_PARTS)

    @property
    def width(self) -> int:
        return self.longest + self.stride - 1

    @property
    def least_jaccard(self) -> float:
        """With the least containment that counts, and nothing else alike."""
        template, window = self.shortest - 1, self.width - 1
        both = LEAST_CONTAINED * template
        return both / (template + window - both)

    @property
    def bands(self) -> int:
        return math.ceil(math.log(MOST_MISSED) / math.log1p(-min(0.999, self.least_jaccard**BAND_ROWS)))


def _signature(shingles: Column, size: int) -> Column:
    """The minimum over the shingles of each of ``size`` hash functions."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda j: F.array_min(F.transform(shingles, lambda s: F.xxhash64(s, j))),
    )


def _with_bands(rows: DataFrame, shingles: str, bands: int) -> DataFrame:
    """A row for each band value of the column ``shingles``; the signature is a column, so it is made once."""

    def band(b: Column) -> Column:
        return F.xxhash64(b, *(F.col("signature")[b * BAND_ROWS + r] for r in range(BAND_ROWS)))

    signed = rows.withColumn("signature", _signature(F.col(shingles), bands * BAND_ROWS))
    values = F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), band)
    return signed.withColumn("band", F.explode(values)).drop("signature")


def _classes(lengths: list[int]) -> list[Windows]:
    found: list[Windows] = []
    for length in sorted(set(lengths)):
        if found and length <= found[-1].shortest * CLASS_RATIO:
            found[-1] = Windows(found[-1].shortest, length)
        else:
            found.append(Windows(length, length))
    return found


def default_templates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(sorted(TEMPLATES.items()), "license string, notice string")


def _parts(templates: DataFrame, name_col: str, notice_col: str) -> Iterator[DataFrame]:
    """Templates of two words or more, in parts of about ``PART_WORDS`` words; a longer template is whole."""
    rows = templates.select(
        F.col(name_col).alias("license"), words_of(F.coalesce(F.col(notice_col), F.lit(""))).alias("words")
    ).filter(F.size("words") > 1)
    parts = -(-(rows.agg(F.sum(F.size("words"))).first()[0] or 0) // PART_WORDS)
    for part in range(parts):
        yield rows.filter(F.pmod(F.xxhash64("license", "words"), F.lit(parts)) == part)


def _scan(docs: DataFrame, templates: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, license, start, contained) of each window and template that hold."""
    known = templates.select("license", _shingles(F.col("words")).alias("shingles"), F.size("words").alias("length"))
    classes = _classes([r["length"] for r in known.select("length").distinct().collect()])
    bands = max(windows.bands for windows in classes)
    size = bands * BAND_ROWS
    of_length = [F.when(F.col("length").between(w.shortest, w.longest), F.lit(k)) for k, w in enumerate(classes)]
    known = known.withColumn("kind", F.coalesce(*of_length))

    def least(j: Column) -> Column:
        order = F.transform("shingles", lambda s: F.struct(F.xxhash64(s, j).alias("h"), s.alias("s")))
        return F.array_min(order)["s"]

    # Minima (or all shingles) of each class's templates, and how many of them a window of the class holds at least if it holds a template.
    minima: list[set[int]] = [set() for _ in classes]
    needed = [10**9] * len(classes)
    of_each = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(size - 1)), least))
    for r in known.select("kind", "shingles", of_each.alias("least")).collect():
        n = len(r["shingles"])
        spare = n - math.ceil(LEAST_CONTAINED * n)
        chosen = r["least"] if len(r["least"]) > 2 * spare else r["shingles"]
        minima[r["kind"]].update(chosen)
        needed[r["kind"]] = max(1, min(needed[r["kind"]], len(chosen) - spare))
    every = sorted(set().union(*minima))

    words = F.col("words")
    places = F.filter(F.sequence(F.lit(0), F.size("words") - 2), lambda i: _pair(words, i).isin(every))
    # The row number identifies repeated rows. As it is not a function of the row, the filter below stays
    # above it, and the words are not split again for the filter.
    hits = (
        docs.select(F.col(id_col).alias("id"), words_of(common.whole_text(text_col)).alias("words"))
        .select(
            "id",
            "words",
            F.when(F.size("words") > 1, places).alias("places"),
            F.monotonically_increasing_id().alias("row"),
        )
        .filter(F.size("places") > 0)
    )

    def opened(kind: int, windows: Windows) -> Column:
        """Windows with as many minima as are needed: those over a run of so many neighbouring ones."""
        telling, reach = F.col(f"telling{kind}"), windows.width - 2

        def run_end(k: Column) -> Column:
            return F.get(telling, k + (needed[kind] - 1))

        runs = F.filter(
            F.transform(telling, lambda i, k: F.struct(i.alias("first"), run_end(k).alias("last"))),
            lambda run: run["last"] - run["first"] <= reach,
        )

        def starts(run: Column) -> Column:
            low = F.greatest(F.lit(0), F.ceil((run["last"] - reach) / windows.stride)).cast("int")
            high = F.floor(run["first"] / windows.stride).cast("int")
            none = F.array().cast("array<int>")
            return F.when(low <= high, F.transform(F.sequence(low, high), lambda k: k * windows.stride)).otherwise(none)

        begins = F.array_distinct(F.flatten(F.transform(runs, starts)))
        return F.transform(
            begins, lambda b: F.struct(F.lit(kind).alias("kind"), b.alias("start"), F.lit(windows.width).alias("width"))
        )

    telling = [
        F.filter("places", lambda i: _pair(words, i).isin(sorted(own))).alias(f"telling{kind}")
        for kind, own in enumerate(minima)
    ]
    every_window = F.concat(*(opened(kind, windows) for kind, windows in enumerate(classes)))
    window = hits.select("row", "id", "words", *telling).select("row", "id", "words", F.explode(every_window).alias("w"))
    sliced = window.select(
        "row", "id", "w.kind", "w.start", F.slice("words", F.col("w.start") + 1, F.col("w.width")).alias("window")
    )
    held = sliced.select("row", "id", "kind", "start", _shingles(F.col("window")).alias("held"))
    shelf = _with_bands(known.select("license", "kind", "shingles"), "shingles", bands)
    met = _with_bands(held, "held", bands).join(F.broadcast(shelf), ["kind", "band"])
    contained = F.size(F.array_intersect("shingles", "held")) / F.size("shingles")
    return met.select("row", "id", "license", "start", contained.alias("contained")).filter(
        F.col("contained") >= LEAST_CONTAINED
    )


def license_matches(
    docs: DataFrame,
    templates: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    name_col: str = "license",
    notice_col: str = "notice",
) -> DataFrame:
    """A row for each document and license that it holds: ``id_col, license, contained, start_word, windows``.

    ``contained`` is the largest share of the notice's word pairs in one window, ``start_word`` the first window with
    that share, ``windows`` the number of windows that hold the notice. Words are lower-case, parted by white space and
    ASCII punctuation. Null and empty texts and notices of fewer than two words match nothing; a null id is kept;
    repeated rows of documents give repeated rows, repeated templates one; other columns are not looked at; without
    documents or templates the result is empty.
    """
    templates = default_templates(docs.sparkSession) if templates is None else templates
    found = None
    for part in _parts(templates, name_col, notice_col):
        scanned = _scan(docs, part, id_col, text_col)
        found = scanned if found is None else found.union(scanned)
    if found is None:
        nothing = docs.limit(0).select(F.lit(0).alias("row"), F.col(id_col).alias("id"))
        found = nothing.select("*", F.lit("").alias("license"), F.lit(0).alias("start"), F.lit(0.0).alias("contained"))
    best = F.max(F.struct("contained", (-F.col("start")).alias("s"))).alias("best")
    return (
        found.groupBy("row", "id", "license")
        .agg(best, F.count_distinct("start").alias("windows"))
        .select(
            F.col("id").alias(id_col),
            "license",
            F.col("best.contained").alias("contained"),
            (-F.col("best.s")).cast("long").alias("start_word"),
            "windows",
        )
    )
