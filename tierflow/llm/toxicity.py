"""Toxicity by a support vector machine with a gap-weighted subsequence kernel.

The kernel counts common subsequences of three letters, each weighted by a decay for every position that it spans,
so letters put into an insult lower its value but do not hide it. Landmark words give the Nyström map, and a
squared-hinge machine is fitted in its space on the words of labelled documents. A fitted machine is a weighted sum of
kernels with the landmarks, which unrolls into one weight for each subsequence; that table scores words.
A document's decision pools its words, and logistic calibration turns it into a probability.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

DECAY = 0.4
# Letters are told apart by so many classes, 0 for none; a subsequence is three of them.
CLASSES = 64
LONGEST_WORD = 24
# Bounds of the fit: labelled documents, their words (the most telling, others by hash) and landmarks.
MOST_LABELLED = 20_000
TELLING_WORDS = 6_000
OTHER_WORDS = 16_000
LANDMARKS = 512
PENALTY = 8.0
# Directions of the landmarks' kernel below this share of the largest are left out.
LEAST_DIRECTION = 1e-6
# A task remembers the scores of so many words at most.
MOST_REMEMBERED = 250_000

# Look-alikes of letters.
_LOOK_ALIKES = str.maketrans("013457@$", "oieastas")
_SPACED = re.compile(r"(?<!\S)\w(?:\s\w){2,}(?!\S)")
_CLASS_OF = 27 + np.arange(1 << 16) % (CLASSES - 27)
_CLASS_OF[ord("a") : ord("z") + 1] = np.arange(1, 27)
_CLASS_OF[0] = 0
_CLASS_OF = _CLASS_OF.astype(np.int32)


def normalise(word: str) -> str:
    """Lower-case letters only, look-alikes read as letters, between marks of the word's ends."""
    return f"^{''.join(filter(str.isalnum, word.lower().translate(_LOOK_ALIKES)))}$"


def words_of(text: str) -> set[str]:
    """The distinct raw words, and words spelt with spaces between their letters."""
    lower = text.lower()
    found = set(lower.split())
    found.update("".join(run.split()) for run in _SPACED.findall(lower))
    return found


def _windows(word: str) -> list[str]:
    """The word, or overlapping windows of a long one."""
    if len(word) <= LONGEST_WORD:
        return [word]
    half = LONGEST_WORD // 2
    return [word[at : at + LONGEST_WORD] for at in range(0, len(word) - half, half)]


def letter_codes(words: list[str]) -> np.ndarray:
    """Words of at most ``LONGEST_WORD`` letters as rows of letter classes, filled up with 0."""
    if not words:
        return np.zeros((0, LONGEST_WORD), np.int32)
    points = np.array(words, f"U{LONGEST_WORD}").view(np.uint32).reshape(len(words), LONGEST_WORD)
    return _CLASS_OF[points & 0xFFFF]


def _triples(codes: np.ndarray) -> Iterator[tuple[np.ndarray, float]]:
    """Subsequence number in each row and its weight, for each choice of three places; number 0 is none."""
    width = int((codes != 0).any(axis=0).sum()) if len(codes) else 0
    for i in range(width - 2):
        for j in range(i + 1, width - 1):
            pair = (codes[:, i] * CLASSES + codes[:, j]) * CLASSES
            for k in range(j + 1, width):
                yield np.where(codes[:, k] > 0, pair + codes[:, k], 0), DECAY ** (k - i + 1)


def self_kernel(codes: np.ndarray) -> np.ndarray:
    """The kernel of each row with itself, by the usual recursion over prefixes."""
    n, width = codes.shape
    width = int((codes != 0).any(axis=0).sum()) if n else 0
    equal = [[(codes[:, i] == codes[:, j]) & (codes[:, i] > 0) for j in range(width)] for i in range(width)]
    square = np.float32(DECAY * DECAY)
    # prefix[i][j]: sum over common subsequences of the prefixes, weighted by what they span to the ends
    prefix = np.ones((width + 1, width + 1, n), np.float32)
    for _ in range(2):
        step = np.zeros_like(prefix)
        for i in range(1, width + 1):
            row = np.zeros(n, np.float32)
            for j in range(1, width + 1):
                row = np.float32(DECAY) * row + square * prefix[i - 1, j - 1] * equal[i - 1][j - 1]
                step[i, j] = np.float32(DECAY) * step[i - 1, j] + row
        prefix = step
    total = np.zeros(n, np.float32)
    for i in range(width):
        for j in range(width):
            total += square * prefix[i, j] * equal[i][j]
    return total


def _by_width(codes: np.ndarray, rows: int = 1 << 14) -> Iterator[np.ndarray]:
    """Row numbers in blocks of similar length."""
    lengths = (codes != 0).sum(axis=1)
    order = np.argsort(lengths, kind="stable")
    limits = np.searchsorted(lengths[order], [7, 9, 11, 13, 17, LONGEST_WORD + 1])
    for low, high in zip([0, *limits[:-1]], limits):
        size = rows if high < len(order) else rows // 8
        for at in range(low, high, size):
            yield order[at : min(at + size, high)]


def unit_scores(codes: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Each row's normalised kernel sum with what the ``table`` of subsequence weights stands for."""
    shape = (len(codes), *table.shape[1:])
    out = np.zeros(shape, np.float32)
    for rows in _by_width(codes):
        part = codes[rows]
        total = np.zeros((len(rows), *table.shape[1:]), np.float32)
        for number, weight in _triples(part):
            total += np.float32(weight) * table[number]
        norm = np.sqrt(np.maximum(self_kernel(part), 1e-20))
        out[rows] = total / norm.reshape(-1, *[1] * (total.ndim - 1))
    return out


@dataclass
class Model:
    """``table``: a weight for each subsequence; ``calibration``: intercept and the weights of the pooled values."""

    table: np.ndarray | None
    bias: float
    calibration: np.ndarray
    constant: float | None = None

    def word_scores(self, words: list[str]) -> np.ndarray:
        """The machine's decision for each raw word; the largest of a long word's windows."""
        windows, owner = [], []
        for i, word in enumerate(words):
            parts = _windows(normalise(word))
            windows += parts
            owner += [i] * len(parts)
        out = np.full(len(words), -np.inf, np.float32)
        np.maximum.at(out, np.array(owner, int), unit_scores(letter_codes(windows), self.table) + self.bias)
        return out


def _landmark_features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Subsequence numbers that occur in the landmarks, and their normalised weights in each landmark."""
    numbers, weights = zip(*((number, weight) for number, weight in _triples(codes)))
    used, place = np.unique(np.stack(numbers), return_inverse=True)
    place = place.reshape(len(numbers), -1)
    features = np.zeros((len(used), len(codes)), np.float32)
    for row, weight in zip(place, weights):
        features[row, np.arange(len(codes))] += weight
    features[used == 0] = 0
    return used, features / np.sqrt(np.maximum(self_kernel(codes), 1e-20))


def fit_machine(words: list[str], toxic: np.ndarray, clean: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights of subsequences and bias, from normalised words (most telling first) and their documents."""
    codes = letter_codes(words)
    keep = (codes != 0).sum(axis=1) >= 3
    codes, toxic, clean = codes[keep], toxic[keep], clean[keep]
    _, first = np.unique(codes, axis=0, return_index=True)
    first.sort()
    half = LANDMARKS // 2
    marks = np.concatenate([first[:half], first[half:][:: max(1, (len(first) - half) // half)][:half]])
    used, features = _landmark_features(codes[marks])
    lookup = np.zeros(CLASSES**3, np.int32)
    lookup[used] = np.arange(1, len(used) + 1)
    dense = np.vstack([np.zeros((1, len(marks)), np.float32), features])
    kernel = np.zeros((len(codes), len(marks)), np.float32)
    for at in range(0, len(codes), 4096):
        part = codes[at : at + 4096]
        for rows in _by_width(part, 1024):
            total = np.zeros((len(rows), len(marks)), np.float32)
            for number, weight in _triples(part[rows]):
                total += np.float32(weight) * dense[lookup[number]]
            kernel[at + rows] = total / np.sqrt(np.maximum(self_kernel(part[rows]), 1e-20))[:, None]
    values, vectors = np.linalg.eigh(kernel[marks].astype(float))
    good = values > LEAST_DIRECTION * values.max()
    to_space = vectors[:, good] / np.sqrt(values[good])
    z = np.hstack([kernel @ to_space, np.ones((len(codes), 1))])
    del kernel
    w = np.zeros(z.shape[1])
    ridge = np.ones(len(w))
    ridge[-1] = 1e-3
    blocks = [slice(at, at + 2048) for at in range(0, len(z), 2048)]
    for _ in range(30):  # Newton steps for the squared hinge; a word counts as toxic and as clean, by its documents
        gradient, hessian = ridge * w, np.diag(ridge)
        for rows in blocks:
            value = z[rows] @ w
            for y, weight in ((1.0, toxic[rows]), (-1.0, clean[rows])):
                margin = 1 - y * value
                pull = PENALTY * weight * (margin > 0)
                gradient -= z[rows].T @ (pull * y * margin)
                hessian += z[rows].T @ (pull[:, None] * z[rows])
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    table = np.zeros(CLASSES**3, np.float32)
    table[used] = features @ (to_space @ w[:-1])
    table[0] = 0
    return table, float(w[-1])


def fit_calibration(pooled: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Logistic regression with a small ridge, by Newton steps."""
    x = np.hstack([np.ones((len(pooled), 1)), pooled])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        hessian = x.T @ ((p * (1 - p))[:, None] * x) + 1e-2 * np.eye(len(w))
        step = np.linalg.solve(hessian, x.T @ (p - toxic) + 1e-2 * w)
        w -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out(id_col: str = "doc_id") -> Column:
    """Rows whose labels are not learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


class _Pool:
    """Pools the word scores of texts; remembers words between batches."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.known: dict[str, float] = {}

    def __call__(self, texts: pa.Array) -> tuple[list[float], list[float]]:
        """For each text the largest score, and the logarithm of one more than the words with a score above 0."""
        tops, aboves = [], []
        for _, group in common.texts_in_groups(texts):
            found = [words_of(t) for t in group]
            if len(self.known) > MOST_REMEMBERED:
                self.known = {}
            fresh = list(set().union(*found) - self.known.keys())
            self.known.update(zip(fresh, self.model.word_scores(fresh).tolist()))
            for words in found:
                scores = [self.known[w] for w in words] or [self.model.bias]
                tops.append(max(scores))
                aboves.append(float(np.log1p(sum(s > 0 for s in scores))))
        return tops, aboves


def _pooled(docs: DataFrame, model: Model, passed: list[str], text_col: str) -> DataFrame:
    """Columns ``passed``, and the pooled word scores ``top`` and ``above`` of each row's whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = T.StructType(
        [docs.schema[c] for c in passed] + [T.StructField(c, T.DoubleType()) for c in ("top", "above")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(shared.value)
        for batch in batches:
            tops, aboves = pool(batch.column(len(passed)))
            columns = [batch.column(i) for i in range(len(passed))]
            columns += [pa.array(tops, pa.float64()), pa.array(aboves, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=out.names)

    return docs.select(*passed, text_col).mapInArrow(run, out)


def _labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> DataFrame:
    """(text, toxic) of about ``MOST_LABELLED`` labelled rows at most, never of held-out ones."""
    usable = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
        .groupBy(F.col(id_col).alias("labelled"))
        .agg(F.max(label_col).cast("long").alias("toxic"))
    )
    chance = MOST_LABELLED / max(1, usable.count())
    if chance < 1:
        u = F.pmod(F.xxhash64("labelled", F.lit(10)), F.lit(1 << 30)) / float(1 << 30)
        usable = usable.filter(u < chance)
    drawn = docs.select(F.col(id_col).alias("id"), common.whole_text(text_col).alias("text")).join(
        F.broadcast(usable), F.col("id") == F.col("labelled")
    )
    return common.stage(drawn.select("text", "toxic"), "toxicity-labelled")


def _document_words(texts: DataFrame) -> DataFrame:
    """(word, toxic): the distinct normalised words of each text, long ones in windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                words = {w for raw in words_of(text.as_py()) for w in _windows(normalise(raw)) if len(w) > 2}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(sorted(words), pa.string()), pa.array([toxic] * len(words), pa.int64())],
                    names=["word", "toxic"],
                )

    return texts.select("text", "toxic").mapInArrow(run, "word string, toxic long")


def fit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Model:
    """A model from the labelled documents that are not held out.

    At most about ``MOST_LABELLED`` of them are drawn, by a hash of their id. Without labels of both kinds the
    model is constant: the share of toxic ones, 0 without any.
    """
    drawn = _labelled_sample(docs, labels, id_col, text_col, label_col)
    total, toxic = drawn.agg(F.count(F.lit(1)), F.sum("toxic")).first()
    if not toxic or toxic == total:
        return Model(None, 0.0, np.zeros(3), constant=float(bool(toxic)))
    prior = toxic / total
    counted = _document_words(drawn).groupBy("word").agg(F.sum("toxic").alias("bad"), F.count(F.lit(1)).alias("all"))
    surplus = (F.col("bad") - F.col("all") * prior) / F.sqrt(F.col("all") * (prior * (1 - prior)) + 0.5)
    counted = common.stage(counted.withColumn("surplus", surplus), "toxicity-words")
    telling = counted.orderBy(F.desc("surplus"), "word").limit(TELLING_WORDS)
    others = counted.orderBy(F.xxhash64("word"), "word").limit(OTHER_WORDS)
    rows = {r["word"]: r for part in (telling, others) for r in part.collect()}
    if not rows:
        return Model(None, 0.0, np.zeros(3), constant=prior)
    bad = np.array([r["bad"] for r in rows.values()], float)
    every = np.array([r["all"] for r in rows.values()], float)
    table, bias = fit_machine(list(rows), bad, every - bad)
    model = Model(table, bias, np.zeros(3))
    scored = np.array(_pooled(drawn, model, ["toxic"], "text").collect(), float).reshape(-1, 3)
    model.calibration = fit_calibration(scored[:, 1:], scored[:, 0])
    return model


def score(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()
) -> DataFrame:
    """``id_col, held_out, score, predicted`` and the columns ``keep`` of every row, from its whole text alone.

    A null text counts as empty. A null id is kept and is not held out; repeated rows are scored one by one;
    other columns are not looked at; an empty table gives an empty result.
    """
    if model.constant is not None:
        pooled = docs.select(id_col, *keep).withColumn("score", F.lit(model.constant))
    else:
        a, b, c = (float(x) for x in model.calibration)
        logit = F.lit(a) + F.col("top") * b + F.col("above") * c
        pooled = _pooled(docs, model, [id_col, *keep], text_col).withColumn("score", 1 / (1 + F.exp(-logit)))
    return pooled.select(
        id_col,
        held_out(id_col).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *keep,
    )


def without_toxic(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows whose score is below 0.5, with all columns of ``docs``."""
    if model.constant is not None:
        return docs.filter(F.lit(model.constant < 0.5))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pool = _Pool(shared.value)
        a, b, c = shared.value.calibration
        for batch in batches:
            tops, aboves = pool(batch.column(place))
            yield batch.filter(pa.array(a + b * np.array(tops) + c * np.array(aboves) < 0, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
