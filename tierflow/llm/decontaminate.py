"""Benchmark decontamination: rare n-grams that a training text shares with a test item seed local alignments of the two.

An item's word pairs are ranked by the number of training texts that hold them, and the rarest are its seeds: as many that
no copy that reaches the least score by words replaced or left out can be without all of them (`seed_count`). So common phrases
bring no work, and an edited copy is found whether it is the only leak of its item or one of a large group. A
text with a seed is aligned around it with the item by Smith-Waterman on words. Stretches of a text that hold too few of the
item's words to reach the least score are passed over without an alignment.

Texts are read twice where they lie, for the counts and for the alignments; only counts of the items' own word pairs are
shuffled. Items are taken in parts of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WIDTH = 2
# Long items are aligned in segments of so many words.
SEGMENT = 256
MATCH, MISMATCH, GAP = 2, -1, -1
# Share of a segment's full score from which a text counts as contaminated, and the least number of words that this takes:
# shorter items have to lie in a text whole.
LEAST_SCORE = 0.5
LEAST_WORDS = 4
# Items are broadcast in parts of about so many bytes.
PART_BYTES = 8 << 20
# Seed hits of one text are laid out at most so many at a time.
MOST_HITS = 1 << 20
_FILTER_BITS = 20


def least_score(length: int) -> float:
    """The alignment score that a segment of so many words takes."""
    return max(LEAST_SCORE * MATCH * length, MATCH * min(LEAST_WORDS, length))


def to_spare(length: int) -> int:
    """Score points that an edited copy may lose."""
    return int(MATCH * length - least_score(length))


def seed_count(length: int) -> int:
    """How many of a segment's rarest n-grams are seeds.

    A word replaced or left out costs its match and a penalty, and breaks ``WIDTH`` n-grams; one at the item's end costs its
    match, and breaks one. One more seed than may be broken leaves one whole in every such copy. A word put in costs a
    penalty only, so a copy with so many words put in, two thirds of the item's, may be missed.
    """
    broken = WIDTH * to_spare(length) // (MATCH - max(MISMATCH, GAP))
    return min(broken + 1, length - WIDTH + 1)


def segments_of(names: list, texts: list[str]) -> tuple[list, list[np.ndarray]]:
    """The items' segments as word hashes, and the item of each; items of one word have none."""
    owner, segments = [], []
    for name, text in zip(names, texts):
        words = common.word_hashes([text], marks_part=True)[0]
        for part in np.array_split(words, max(1, round(len(words) / SEGMENT))):
            if len(part) >= WIDTH:
                owner.append(name)
                segments.append(part)
    return owner, segments


def index(names: list, segments: list[np.ndarray], grams: np.ndarray, texts_with: np.ndarray) -> dict:
    """Segments and their seeds, sorted by n-gram, with segment and place; ``texts_with`` counts the texts of each of ``grams``.

    A dictionary of arrays, so that executors need no class of this library.
    """
    seeds, owner, place = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for number, words in enumerate(segments):
        own = common.shingle_hashes(words, WIDTH)
        count = texts_with[np.searchsorted(grams, own)]
        rarest = np.lexsort((own, count))[: seed_count(len(words))]
        rarest = rarest[count[rarest] > 0]  # the others are in no text
        seeds.append(own[rarest])
        owner.append(np.full(len(rarest), number))
        place.append(rarest)
    flat = np.concatenate(seeds)
    order = np.argsort(flat, kind="stable")
    return {
        "names": names,
        "segments": segments,
        "grams": flat[order],
        "segment": np.concatenate(owner)[order],
        "place": np.concatenate(place)[order],
        "filter": gram_filter(flat),
    }


def gram_filter(grams: np.ndarray) -> np.ndarray:
    """Marks the first bits of the n-grams: most others are told apart by one look."""
    marks = np.zeros(1 << _FILTER_BITS, bool)
    marks[grams >> np.uint64(64 - _FILTER_BITS)] = True
    return marks


def _among(grams: np.ndarray, known: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions in ``grams`` of those in the sorted ``known``, with the ranges of their entries."""
    at = np.flatnonzero(marks[grams >> np.uint64(64 - _FILTER_BITS)])
    low = np.searchsorted(known, grams[at], "left")
    high = np.searchsorted(known, grams[at], "right")
    hit = low < high
    return at[hit], low[hit], high[hit]


def align(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Best local alignment score and the end of its stretch in ``text``."""
    ramp = -GAP * np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    best, end = 0, 0
    for word in item:
        step = row[:-1] + np.where(text == word, MATCH, MISMATCH)
        row[1:] = np.maximum(np.maximum(step, row[1:] + GAP), 0)
        row = np.maximum.accumulate(row + ramp) - ramp  # gaps along the text
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def _windows(starts: np.ndarray, length: int, n_words: int) -> list[tuple[int, int]]:
    """Stretches of a text in which the item may lie, from the ascending places where seeds put its first word."""
    slack = to_spare(length)  # words put in or left out between the seed and either end
    out: list[tuple[int, int]] = []
    for at in starts.tolist():
        start, end = max(0, at - slack), min(n_words, at + length + slack)
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def _may_reach(item: np.ndarray, text: np.ndarray) -> bool:
    """Whether ``text`` has as many of the item's words, near enough, as the least score takes."""
    least = least_score(len(item)) / MATCH
    met = np.isin(text, item)
    if np.isin(item, text[met]).sum() < least:
        return False
    # Each word that an alignment passes over costs one, so one of the least score is in at most so many words.
    span = len(item) + to_spare(len(item))
    sums = np.concatenate([[0], np.cumsum(met)])
    return len(text) <= span or (sums[span:] - sums[:-span]).max() >= least


def _hits(words: np.ndarray, seeds: dict) -> Iterator[tuple[int, np.ndarray]]:
    """(segment, ascending places of its first word) by the seeds that a text has, in layouts of bounded size."""
    at, low, high = _among(common.shingle_hashes(words, WIDTH), seeds["grams"], seeds["filter"])
    many = high - low
    ends = np.cumsum(many)
    begin = 0
    while begin < len(at):
        done = ends[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + MOST_HITS, "right")))
        n = many[begin:stop]
        entry = np.arange(n.sum()) + np.repeat(low[begin:stop] - np.cumsum(n) + n, n)
        segment = seeds["segment"][entry]
        start = np.repeat(at[begin:stop], n) - seeds["place"][entry]
        order = np.lexsort((start, segment))
        segment, start = segment[order], start[order]
        cuts = np.flatnonzero(np.diff(segment)) + 1
        for number, places in zip(segment[np.concatenate([[0], cuts])].tolist(), np.split(start, cuts)):
            yield number, places
        begin = stop


def matches(words: np.ndarray, seeds: dict) -> list[tuple]:
    """(item, score, start, end, seeds) of each item that a text has a copy of: its best segment and stretch."""
    best: dict = {}
    for segment, places in _hits(words, seeds):
        item = seeds["segments"][segment]
        for start, end in _windows(places, len(item), len(words)):
            if not _may_reach(item, words[start:end]):
                continue
            score, stop = align(item, words[start:end])
            share = score / (MATCH * len(item))
            name = seeds["names"][segment]
            if score >= least_score(len(item)) and (name not in best or share > best[name][1]):
                _, back = align(item[::-1], words[start : start + stop][::-1])
                best[name] = (name, share, start + stop - back, start + stop, len(places))
    return list(best.values())


def _words(texts: pa.Array) -> Iterator[np.ndarray]:
    for _, group in common.texts_in_groups(texts):
        words, starts = common.word_hashes(group, marks_part=True)
        for a, b in zip(starts[:-1], starts[1:]):
            yield words[a:b]


def _texts_with(docs: DataFrame, text_col: str, grams: np.ndarray) -> np.ndarray:
    """How many texts hold each of ``grams``, which are sorted and those of one part of the items."""
    shared = docs.sparkSession.sparkContext.broadcast((grams, gram_filter(grams)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, marks = shared.value
        for batch in batches:
            counts = np.zeros(len(known), np.int64)
            for words in _words(batch.column(0)):
                _, low, _ = _among(common.shingle_hashes(words, WIDTH), known, marks)
                counts[np.unique(low)] += 1
            held = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["gram", "texts"])

    found = docs.select(text_col).mapInArrow(run, "gram long, texts long")
    sums = found.groupBy("gram").agg(F.sum("texts").alias("texts")).toArrow()
    out = np.zeros(len(grams), np.int64)
    out[sums["gram"].to_numpy()] = sums["texts"].to_numpy()
    shared.unpersist()
    return out


def _parts(docs: DataFrame, text_col: str, items: DataFrame, item_col: str, item_text_col: str) -> Iterator[dict]:
    """The items in parts of bounded size, with their seeds."""
    rows = items.filter(F.col(item_text_col).isNotNull()).select(
        F.col(item_col).alias("item"), F.col(item_text_col).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = -(-size // PART_BYTES)
    for part in range(parts):
        found = sorted(rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).collect(), key=str)
        names, segments = segments_of([r["item"] for r in found], [r["text"] for r in found])
        if segments:
            grams = np.unique(np.concatenate([common.shingle_hashes(s, WIDTH) for s in segments]))
            yield index(names, segments, grams, _texts_with(docs, text_col, grams))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """A row for each document and item that it holds a copy of.

    ``id_col, item_col, score`` (share of the full alignment score), ``start, end`` (words of the
    document, end exclusive; punctuation parts words), ``seeds``. Items of two to four words have to lie in a text
    whole; those of one word and null texts match nothing; a null id is kept; repeated rows of documents give repeated rows,
    repeated items one; other columns are not looked at; without documents or items the result is empty. The
    counts that rank the seeds are taken when this is called.
    """
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField(item_col, benchmark.schema[item_col].dataType),
            T.StructField("score", T.DoubleType()),
            *(T.StructField(c, T.LongType()) for c in ("start", "end", "seeds")),
        ]
    )
    context = docs.sparkSession.sparkContext
    result = docs.sparkSession.createDataFrame([], out)
    for seeds in _parts(docs, text_col, benchmark, item_col, item_text_col):
        shared = context.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            from pyspark.sql.pandas.types import to_arrow_schema

            schema = to_arrow_schema(out)
            for batch in batches:
                rows = []
                for name, words in zip(batch.column(0).to_pylist(), _words(batch.column(1))):
                    rows += [(name, *m) for m in matches(words, shared.value)]
                columns = list(zip(*rows)) or [()] * len(schema)
                arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
                yield pa.RecordBatch.from_arrays(arrays, schema=schema)

        result = result.union(docs.select(id_col, text_col).mapInArrow(run, out))
    return result


def without_contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` that hold a copy of no item, with all their columns; rows without text stay."""
    context = docs.sparkSession.sparkContext
    place = docs.columns.index(text_col)
    for seeds in _parts(docs, text_col, benchmark, item_col, item_text_col):
        shared = context.broadcast(seeds)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not matches(words, shared.value) for words in _words(batch.column(place))]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
