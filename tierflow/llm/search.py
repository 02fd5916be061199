"""Ranked lexical search for a set of items: one automaton of all their terms is run over every text.

The terms of the items, each between two blanks, form an Aho-Corasick automaton that goes to the tasks as a list of
terms of bounded size; more items are searched part by part. A text has its separators made blanks first, so that each
match is a whole term, and neighbouring terms share the blank between them. A first pass over the texts counts the
documents, their terms, and the documents of each item term. A second one counts the occurrences again, from the text:
there is no index of the documents. Each automaton output leads to the items that hold the term; a task keeps the best
documents of each item, and the best of all tasks are ranked.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from operator import itemgetter

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.functions import ref

from .common import groups_of_rows

# Letters and digits of ASCII and everything beyond it are parts of terms; only A to Z change case.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = 0x20
_TABLE = bytes(
    c + 0x20 if 0x41 <= c <= 0x5A else c if c >= 0x80 or 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A else _BLANK
    for c in range(256)
)

# Items are searched in parts with so many bytes of terms, a single larger item alone.
PART_BYTES = 8 << 20
# Scores of so many (document, item) pairs, and so many shares of single terms in them, are held at a time.
MOST_CELLS = 1 << 19
MOST_SHARES = 1 << 20
# Rows of a part's best documents are ranked in so many runs before they are ranked as a whole.
RUNS = 64

_COUNTS = "term long, docs long"
_DOCS, _TERMS = -1, -2  # the two counts over all documents, beside those of single terms


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The ``k`` best documents of each item: ``item_col, rank, id_col, score``.

    A document scores, over the item's distinct terms, the sum of ``w * (10**9 * tf div (1000 * tf + 8 * m))``, where
    ``w = floor(1000 * ln((2 * N + 2) / (2 * df + 1)))`` and ``m = 10 + 90 * n * N div L``: documents N with a term,
    terms L of all documents and n of the document, documents df with the term, occurrences tf. Documents without a
    score above 0 are not listed. Equal scores rank by ascending id, null last; repeated documents rank each for
    itself, in any order. Rows of one item id, null included, are one item with the terms of all. A null or empty text
    has no terms, and an item without terms no documents. Texts of any length are read whole; other columns are not
    looked at. Empty tables give an empty result. Calling this runs jobs.
    """
    spark = docs.sparkSession
    texts = docs.select(ref(id_col).cast("long").alias("id"), ref(text_col).cast("binary").alias("text"))
    schema = T.StructType().add(item_col, items.schema[item_col].dataType).add("rank", T.IntegerType())
    schema = schema.add(id_col, T.LongType()).add("score", T.LongType())
    found = []
    for names, terms in _parts(items, item_col, item_text_col):
        best = _best(texts, terms, k)
        table = spark.createDataFrame(list(enumerate(names)), T.StructType().add("item", T.LongType()).add(schema[0]))
        found.append(
            best.join(F.broadcast(table), "item").select(
                ref(item_col), "rank", F.col("id").alias(id_col), "score"
            )
        )
    return reduce(DataFrame.unionAll, found) if found else spark.createDataFrame([], schema)


def _parts(items: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list, list[set[bytes]]]]:
    """Item ids and their terms, read in the order of the ids and cut by the size of the terms."""
    lowered = F.translate(ref(text_col), _UPPER, _LOWER)
    terms = F.transform(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0)), lambda t: t.cast("binary"))
    rows = items.select(ref(item_col).alias("item"), terms.alias("terms")).orderBy("item")
    names: list = []
    sets: list[set[bytes]] = []
    size = 0
    for row in rows.toLocalIterator():
        fresh = {bytes(t) for t in row["terms"] or ()}
        if names and names[-1] == row["item"]:
            fresh -= sets[-1]
            sets[-1] |= fresh
        else:
            if size > PART_BYTES:
                yield names, sets
                names, sets, size = [], [], 0
            names.append(row["item"])
            sets.append(fresh)
        size += sum(map(len, fresh))
    if any(sets):
        yield names, sets


def _best(texts: DataFrame, item_terms: list[set[bytes]], k: int) -> DataFrame:
    """(item, rank, id, score) of one part; items by number."""
    terms = sorted(set().union(*item_terms))
    place = {term: i for i, term in enumerate(terms)}
    counted = texts.select("text").mapInArrow(_counter(terms), _COUNTS)
    sums = counted.groupBy("term").agg(F.sum("docs").alias("docs")).toArrow()  # two rows more than terms at most
    counts = dict(zip(sums["term"].to_pylist(), sums["docs"].to_pylist()))
    n_docs, n_terms = counts.get(_DOCS, 0), counts.get(_TERMS, 0)
    weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(i, 0) + 1))) for i in range(len(terms))]
    pairs = sorted((place[term], item) for item, own in enumerate(item_terms) for term in own)
    scorer = _scorer(terms, np.array(weights, np.int64), np.array(pairs, np.int64), len(item_terms), n_docs, n_terms, k)
    best = texts.mapInArrow(scorer, "item long, id long, score long, run int")
    order = [F.desc("score"), F.col("id").asc_nulls_last()]
    for keys in (["item", "run"], ["item"]):
        best = best.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
        best = best.filter(F.col("rank") <= k)
    return best.select("item", "rank", "id", "score")


def _automaton(terms: list[bytes]) -> ahocorasick.Automaton:
    """The terms between blanks; one character for each byte, so that any bytes are matched."""
    automaton = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        automaton.add_word(f" {term.decode('latin-1')} ", i)
    automaton.make_automaton()
    return automaton


def _prepared(text: bytes) -> tuple[str, int]:
    """The text as the automaton reads it, and how many terms it has."""
    plain = b"".join((b" ", text.translate(_TABLE), b" "))
    inside = np.frombuffer(plain, np.uint8) != _BLANK
    return plain.decode("latin-1"), int(np.count_nonzero(inside[1:] > inside[:-1]))


def _counter(terms: list[bytes]):
    """Counts documents, their terms, and the documents that hold each of ``terms``; one row each and task."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, counts = _automaton(terms), Counter()
        for batch in batches:
            for text in batch.column("text"):
                plain, n = _prepared(text.as_py() or b"")
                if n:
                    counts[_DOCS] += 1
                    counts[_TERMS] += n
                    counts.update(set(map(itemgetter(1), automaton.iter(plain))))
        yield pa.RecordBatch.from_pydict(
            {"term": pa.array(list(counts), pa.int64()), "docs": pa.array(list(counts.values()), pa.int64())}
        )

    return count


def _scorer(
    terms: list[bytes], weights: np.ndarray, pairs: np.ndarray, n_items: int, n_docs: int, n_terms: int, k: int
):
    """Scores documents for all items and keeps the best of each; ``pairs`` are (term, item), by term."""
    first = np.searchsorted(pairs[:, 0], np.arange(len(terms)))
    items_of = np.bincount(pairs[:, 0], minlength=len(terms))

    def scores(entries: list[tuple[np.ndarray, np.ndarray]], lengths: list[int]) -> np.ndarray:
        """Documents x items; a document's entries are its term numbers and their occurrences."""
        doc = np.repeat(np.arange(len(entries)), [len(t) for t, _ in entries])
        term, tf = (np.concatenate(part) for part in zip(*entries))
        floor = np.array([8 * (10 + 90 * n * n_docs // n_terms) for n in lengths], np.int64)
        share = weights[term] * (10**9 * tf // (1000 * tf + floor[doc]))
        total = np.zeros(len(entries) * n_items, np.int64)
        ends = np.cumsum(items_of[term])
        cuts = np.unique(np.searchsorted(ends, np.arange(MOST_SHARES, ends[-1], MOST_SHARES)))
        for part in np.split(np.arange(len(term)), cuts):
            fan = items_of[term[part]]
            at = np.arange(fan.sum()) + np.repeat(first[term[part]] - (np.cumsum(fan) - fan), fan)
            np.add.at(total, np.repeat(doc[part] * n_items, fan) + pairs[at, 1], np.repeat(share[part], fan))
        return total.reshape(len(entries), n_items)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, best = _automaton(terms), _Best(n_items, k)
        for batch in batches:
            ids = batch.column("id")
            lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
            for rows in groups_of_rows([1] * len(lengths), max(1, MOST_CELLS // n_items)):
                kept, entries, sizes = [], [], []
                for row in range(rows.start, rows.stop):
                    plain, n = _prepared(batch.column("text")[row].as_py() or b"")
                    tf = Counter(map(itemgetter(1), automaton.iter(plain))) if n else None
                    if tf:
                        kept.append(row)
                        sizes.append(n)
                        entries.append((np.fromiter(tf, np.int64, len(tf)), np.fromiter(tf.values(), np.int64, len(tf))))
                if kept:
                    best.add(scores(entries, sizes), ids.take(pa.array(kept)))
        yield best.batch()

    return score


class _Best:
    """The best documents of each item that a task has seen."""

    def __init__(self, n_items: int, k: int) -> None:
        self.n_items, self.k = n_items, k
        self.least = np.ones(n_items, np.int64)  # what a score has to reach
        self.rows = np.empty((0, 4), np.int64)  # item, -score, id is null, id

    def add(self, scores: np.ndarray, ids: pa.Array) -> None:
        doc, item = np.nonzero(scores >= self.least)
        null = ids.is_null().to_numpy(zero_copy_only=False)
        number = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False)
        fresh = np.column_stack([item, -scores[doc, item], null[doc], number[doc]])
        self.rows = np.concatenate([self.rows, fresh.astype(np.int64)])
        if len(self.rows) > 4 * self.k * self.n_items:
            self.prune()

    def prune(self) -> None:
        self.rows = self.rows[np.lexsort(self.rows.T[::-1])]
        start = np.searchsorted(self.rows[:, 0], self.rows[:, 0])
        place = np.arange(len(self.rows)) - start
        last = self.rows[place == self.k - 1]
        self.least[last[:, 0]] = -last[:, 1]
        self.rows = self.rows[place < self.k]

    def batch(self) -> pa.RecordBatch:
        self.prune()
        item, negated, null, number = self.rows.T
        run = np.bitwise_and(number, RUNS - 1)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(item),
                pa.array(number, mask=null.astype(bool)),
                pa.array(-negated),
                pa.array(run.astype(np.int32)),
            ],
            ["item", "id", "score", "run"],
        )
