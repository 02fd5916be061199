"""Language-model scoring: a causal self-attention model on subword ids, trained in numpy.

Subwords are those of a public vocabulary for `` word`` with its space. Each id has a class: frequent ids one of
their own, the others one of some shared classes. The model gives a class from the classes before it, by one layer of
self-attention on top of the corpus's class bigrams; the id given its class comes from the corpus's counts.

A word's probability is the mean of two: the product over its ids, and the attention's probability of its first id
times the word's share of the training words with that first id.

One pass over the texts stages the ids of each and counts the words and ids of the training texts, which give the
classes. The passes after it read the ids: the first counts class bigrams; the second trains the attention on every
window, where each task starts from one model, fitted to a bounded draw of windows, and the mean of the tasks' models is
the result; the last scores every text in overlapping windows, each token once. Word counts beyond a bounded table are
joined.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common
from .packing import encoder_of, load_ranks

# Classes: one for the end of a text, some for one id each, and the rest for ids of like frequency. The model first
# gives one of ``GROUPS`` groups of classes, then a class of the group.
GROUPS = 32
MEMBERS = 32
CLASSES = GROUPS * MEMBERS
SHARED = 64
# A window has this many tokens; the last ``SCORED`` are scored, with those before them as context.
WINDOW = 48
SCORED = 32
WIDTH = 16
# The bounded first fit, from which every task starts: windows and steps.
FIRST_WINDOWS = 10_000
FIRST_STEPS = 800
BATCH = 96
RATE = 1e-2
# The table of word counts that travels to every task has at most so many words.
MOST_BROADCAST_WORDS = 1_000_000
MOST_REMEMBERED = 1_000_000
# Texts are taken apart in groups of about so many bytes: in a larger group more words repeat.
TAKEN_BYTES = 2 << 20
SMOOTHING = 5.0
# Weight of the product over a word's ids; the rest has the word's frequency.
PRODUCT_SHARE = 0.5

END_WORD = -1  # key of the end token among word hashes
_FIXED_POINT = 1 << 24
_LN10 = np.log(10)  # natural logs and powers take a fraction of the time of those of ten
# Kinds of counted keys.
WORD, ID, FIRST, BIGRAM, WEIGHT, TRAINED, WINDOWS = range(7)


# ---- attention model ----------------------------------------------------------------------------------------


def _first_weights(seed: int = 8) -> dict[str, np.ndarray]:
    draw = np.random.default_rng(seed)

    def normal(*shape: int) -> np.ndarray:
        return (draw.standard_normal(shape) * 0.3).astype(np.float32)

    return {
        "embed": normal(CLASSES, WIDTH),
        "place": normal(WINDOW, WIDTH) * np.float32(0.3),
        "query": normal(WIDTH, WIDTH),
        "key": normal(WIDTH, WIDTH),
        "value": normal(WIDTH, WIDTH),
        "group": np.zeros((WIDTH, GROUPS), np.float32),
        "member": np.zeros((GROUPS, WIDTH, MEMBERS), np.float32),
    }


def _pack_weights(weights: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([weights[name].ravel() for name in sorted(weights)])


def _unpack_weights(flat: np.ndarray) -> dict[str, np.ndarray]:
    """The weights as parts of the array that `_pack_weights` makes."""
    out, at = {}, 0
    shapes = {name: w.shape for name, w in _first_weights().items()}
    for name in sorted(shapes):
        size = int(np.prod(shapes[name]))
        out[name] = flat[at : at + size].reshape(shapes[name])
        at += size
    return out


@dataclass
class Bigrams:
    """Log probabilities of a class after a class, split into the group's and the class's in its group."""

    slots: np.ndarray  # of each class: group * MEMBERS + member
    groups: np.ndarray  # (class before, group)
    members: np.ndarray  # (group, class before, member)

    def __post_init__(self) -> None:
        self.group_of, self.member_of = self.slots // MEMBERS, self.slots % MEMBERS

    @classmethod
    def of(cls, counts: np.ndarray, slots: np.ndarray) -> Bigrams:
        single = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * CLASSES)
        share = (counts + SMOOTHING * single) / (counts.sum(axis=1, keepdims=True) + SMOOTHING)
        by_slot = np.empty_like(share)
        by_slot[:, slots] = share
        by_slot = by_slot.reshape(CLASSES, GROUPS, MEMBERS)
        groups = by_slot.sum(axis=2)
        members = (by_slot / groups[:, :, None]).transpose(1, 0, 2)
        return cls(slots, np.log(groups).astype(np.float32), np.ascontiguousarray(np.log(members), np.float32))


def slots_of(counts: np.ndarray) -> np.ndarray:
    """Puts classes with like neighbours into one group: by the second singular vector of their bigrams."""
    share = counts + counts.sum() * 1e-9 + 1e-6
    scaled = share / np.sqrt(share.sum(axis=1, keepdims=True) * share.sum(axis=0, keepdims=True))
    left = np.linalg.svd(scaled)[0][:, 1]
    slots = np.empty(CLASSES, np.int64)
    slots[np.lexsort((np.arange(CLASSES), left))] = np.arange(CLASSES)
    return slots


# In a window, the token at place i is predicted from the inputs up to place i: its predecessor and before.
_SEEN = np.tril(np.ones((WINDOW, WINDOW), np.float32))
# Where the numbers of each class lie in the flat embedding.
_SPREAD = np.arange(CLASSES * WIDTH).reshape(CLASSES, WIDTH)


class Room(dict):
    """Arrays that every batch uses again, as fresh memory costs as much as the sums in it."""

    def array(self, name: str, shape: tuple[int, ...], dtype: np.dtype) -> np.ndarray:
        size = int(np.prod(shape))
        if name not in self or len(self[name]) < size or self[name].dtype != dtype:
            self[name] = np.empty(size, dtype)
        return self[name][:size].reshape(shape)


def _exp(x: np.ndarray, bounded: bool) -> np.ndarray:
    """In place. Logits stay far below what overflows, so they get a bound only where a first try has overflown."""
    if bounded:
        np.minimum(x, np.float32(60), out=x)
    return np.exp(x, out=x)


def _drawn(logits: np.ndarray, columns: np.ndarray, bounded: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials in place of the logits; their sums, the logs of the shares of one column of each row, its places."""
    at = np.arange(0, logits.size, logits.shape[1])
    at += columns
    picked = logits.ravel().take(at)
    total = _exp(logits, bounded) @ np.ones(logits.shape[1], logits.dtype)
    return total, picked - np.log(total), at


def _slopes(
    logits: np.ndarray, columns: np.ndarray, share_of: np.ndarray, bounded: bool
) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss at one column of each row, and the slopes by the logits, to be multiplied by a factor of each row."""
    total, logs, at = _drawn(logits, columns, bounded)
    logits.ravel()[at] -= total
    return -float(logs @ share_of), logits, (share_of / total)[:, None]


def _by_group(groups: np.ndarray) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """An order that puts rows of a group together, and the places of each group in it."""
    order = np.argsort(groups.astype(np.uint8), kind="stable")
    bounds = np.concatenate([[0], np.cumsum(np.bincount(groups, minlength=GROUPS))]).tolist()
    return order, [(g, slice(bounds[g], bounds[g + 1])) for g in range(GROUPS) if bounds[g] < bounds[g + 1]]


def _group_logits(weights: dict, bigrams: Bigrams, state: np.ndarray, before: np.ndarray, room: Room) -> np.ndarray:
    shape = len(state), GROUPS
    logits = np.matmul(state, weights["group"], out=room.array("group logits", shape, state.dtype))
    known = room.array("known", shape, bigrams.groups.dtype)
    logits += bigrams.groups.take(before, axis=0, out=known, mode="clip")  # with "raise" there is a copy
    return logits


def _member_logits(
    weights: dict,
    bigrams: Bigrams,
    state: np.ndarray,
    before: np.ndarray,
    groups: np.ndarray,
    parts: list,
    room: Room,
) -> np.ndarray:
    """Logits of the classes in the row's own group; rows are ordered by group, as ``parts`` says."""
    shape = len(state), MEMBERS
    logits = room.array("member logits", shape, state.dtype)
    for group, own in parts:
        np.matmul(state[own], weights["member"][group], out=logits[own])
    rows, known = groups * CLASSES, room.array("known", shape, bigrams.members.dtype)
    rows += before
    logits += bigrams.members.reshape(-1, MEMBERS).take(rows, axis=0, out=known, mode="clip")
    return logits


def gradients(
    weights: dict,
    bigrams: Bigrams,
    inputs: np.ndarray,
    targets: np.ndarray,
    used: np.ndarray,
    room: Room | None = None,
) -> tuple:
    """Mean loss over the used tokens and its gradients; all arrays are (windows, WINDOW)."""
    room = Room() if room is None else room
    with np.errstate(over="ignore", invalid="ignore"):
        loss, found = _gradients(weights, bigrams, inputs, targets, used, room, False)
    return (loss, found) if np.isfinite(loss) else _gradients(weights, bigrams, inputs, targets, used, room, True)


def _gradients(
    weights: dict,
    bigrams: Bigrams,
    inputs: np.ndarray,
    targets: np.ndarray,
    used: np.ndarray,
    room: Room,
    bounded: bool,
) -> tuple:
    """Softmaxes stay undivided: their sums divide the narrower arrays that they are multiplied with."""
    kind, shape = weights["embed"].dtype, inputs.shape
    scale = kind.type(WIDTH**-0.5)
    narrow = inputs.size, WIDTH
    x = weights["embed"].take(inputs, axis=0, out=room.array("x", (*shape, WIDTH), kind), mode="clip")
    x += weights["place"]
    flat = x.reshape(narrow)
    project = np.hstack([weights["query"] * scale, weights["key"], weights["value"]])
    projected = np.matmul(flat, project, out=room.array("projected", (len(flat), 3 * WIDTH), kind))
    q, k, v = (projected.reshape(*shape, 3 * WIDTH)[..., at : at + WIDTH] for at in range(0, 3 * WIDTH, WIDTH))
    wide = room.array("wide", (*shape, WIDTH + 1), kind)
    wide[..., :WIDTH], wide[..., WIDTH] = v, 1  # the last column sums
    attend = np.matmul(q, k.transpose(0, 2, 1), out=room.array("attend", (*shape, WINDOW), kind))
    _exp(attend, bounded)
    attend *= _SEEN
    short = np.flatnonzero(~used.all(axis=1))
    attend[short] *= used[short][:, None, :]
    summed = np.matmul(attend, wide, out=room.array("summed", wide.shape, kind))
    total = np.ascontiguousarray(summed[..., WIDTH:])
    drawn = np.divide(summed[..., :WIDTH], total, out=room.array("drawn", x.shape, kind))
    # every row of the outputs in the order of the groups
    counts, hit = used.ravel(), targets.ravel()
    groups = bigrams.group_of.take(hit)
    order, parts = _by_group(groups)
    share_of = (counts / np.float32(max(1, int(counts.sum())))).astype(kind).take(order)
    state = np.add(drawn, x, out=room.array("moved", x.shape, kind)).reshape(narrow)
    state = state.take(order, axis=0, out=room.array("state", narrow, kind), mode="clip")
    before, groups, members = inputs.ravel().take(order), groups.take(order), bigrams.member_of.take(hit.take(order))
    logits = _group_logits(weights, bigrams, state, before, room)
    loss, slopes, factor = _slopes(logits, groups, share_of, bounded)
    weighed = np.multiply(state, factor, out=room.array("moved", narrow, kind))
    found = {"group": weighed.T @ slopes, "member": np.zeros_like(weights["member"])}
    d_sorted = np.matmul(slopes, weights["group"].T, out=room.array("d_sorted", narrow, kind))
    d_sorted *= factor
    logits = _member_logits(weights, bigrams, state, before, groups, parts, room)
    more, slopes, factor = _slopes(logits, members, share_of, bounded)
    state *= factor
    d_member = room.array("moved", narrow, kind)
    for group, own in parts:
        np.matmul(state[own].T, slopes[own], out=found["member"][group])
        np.matmul(slopes[own], weights["member"][group].T, out=d_member[own])
    d_member *= factor
    d_sorted += d_member
    d_x = room.array("d_x", narrow, kind)
    d_x[order] = d_sorted
    d_state = d_x.reshape(x.shape)
    # the slope of a softmax by its scores: the share times what its value adds beyond the mean
    d_drawn = np.divide(d_state, total, out=room.array("d_drawn", x.shape, kind))
    off = np.einsum("wpi,wpi->wp", d_drawn, drawn)
    d_scores = np.matmul(d_drawn, v.transpose(0, 2, 1), out=room.array("d_scores", attend.shape, kind))
    d_scores -= off[..., None]
    d_scores *= attend
    d_projected = room.array("d_projected", projected.shape, kind)
    d_q, d_k, d_v = (d_projected.reshape(*shape, 3 * WIDTH)[..., at : at + WIDTH] for at in range(0, 3 * WIDTH, WIDTH))
    np.matmul(d_scores, k, out=d_q)
    np.matmul(d_scores.transpose(0, 2, 1), q, out=d_k)
    np.matmul(attend.transpose(0, 2, 1), d_drawn, out=d_v)
    by_project = flat.T @ d_projected
    found["query"], found["key"], found["value"] = np.split(by_project, 3, axis=1)
    found["query"] = found["query"] * scale
    d_x += np.matmul(d_projected, project.T, out=room.array("moved", narrow, kind))
    found["place"] = d_x.reshape(x.shape).sum(axis=0)
    found["embed"] = np.zeros_like(weights["embed"])
    places = room.array("places", narrow, _SPREAD.dtype)
    _SPREAD.take(inputs.ravel(), axis=0, out=places, mode="clip")
    np.add.at(found["embed"].ravel(), places.ravel(), d_x.ravel())
    return loss + more, found


class Trainer:
    """Adam steps on batches of windows; the weights are parts of one array."""

    def __init__(self, weights: dict[str, np.ndarray], bigrams: Bigrams, rate: float = RATE) -> None:
        self.flat = _pack_weights(weights)
        self.weights = _unpack_weights(self.flat)
        self.bigrams = bigrams
        self.rate = rate
        self.step = 0
        self.room = Room()
        self.mean, self.square = np.zeros((2, len(self.flat)), self.flat.dtype)

    def train(self, windows: np.ndarray) -> float:
        """``windows``: (n, WINDOW + 1) classes, the first of each the predecessor; -1 where there is none."""
        used = windows[:, 1:] >= 0
        classes = np.maximum(windows, 0).astype(np.intp)
        loss, found = gradients(self.weights, self.bigrams, classes[:, :-1], classes[:, 1:], used, self.room)
        self.step += 1
        slope = _pack_weights(found)
        self.mean *= 0.9
        self.mean += 0.1 * slope
        np.square(slope, out=slope)
        slope *= 0.01
        self.square *= 0.99
        self.square += slope
        size = np.sqrt(self.square / (1 - 0.99**self.step))
        size += 1e-8
        np.divide(self.mean, size, out=size)
        size *= self.rate / (1 - 0.9**self.step)
        self.flat -= size
        return loss


def training_windows(classes: np.ndarray) -> np.ndarray:
    """A text's classes, the end included, as windows of ``WINDOW`` with the predecessor of each; -1 fills up."""
    count = -(-len(classes) // WINDOW)
    rows = np.full(count * WINDOW, -1, np.int16)
    rows[: len(classes)] = classes
    before = np.append(np.int16(0), classes[WINDOW - 1 :: WINDOW])[:count]  # a text follows the end of another
    return np.column_stack([before, rows.reshape(count, WINDOW)])


@dataclass
class Scorer:
    """The trained model with its products of weights made beforehand."""

    weights: dict[str, np.ndarray]
    bigrams: Bigrams

    def __post_init__(self) -> None:
        w, scale = self.weights, np.float32(WIDTH**-0.5)
        context = WINDOW - SCORED
        self.tables = {name: w["embed"] @ w[name] for name in ("query", "key", "value")}
        self.places = {name: w["place"] @ w[name] for name in ("query", "key", "value")}
        self.tables["query"] = self.tables["query"] * scale
        self.places["query"] = self.places["query"][context:] * scale
        # with a column of ones, so that one product gives the weighted values and the sum of the weights
        self.tables["value"] = np.hstack([self.tables["value"], np.ones((CLASSES, 1), np.float32)])
        self.places["value"] = np.hstack([self.places["value"], np.zeros((WINDOW, 1), np.float32)])
        self.seen = _SEEN[context:]
        self.room = Room()

    def log_probabilities(self, texts: list[np.ndarray], at_once: int = 256) -> np.ndarray:
        """log10 probability of each class of all texts in a row (the ends included), windows in batches."""
        counts = np.array([-(-len(t) // SCORED) for t in texts], np.int64)
        context = WINDOW - SCORED
        # each text lies behind the context of its first window, and begins at a window; its last window has none of it
        starts = np.concatenate([[0], np.cumsum(counts + 1)])
        flat = np.full(starts[-1] * SCORED + WINDOW + 1, -1, np.int16)
        for text, start in zip(texts, (starts * SCORED + context).tolist()):
            flat[start] = 0  # column 0 of a window is the predecessor of its first token
            flat[start + 1 : start + 1 + len(text)] = text
        real = np.ones(starts[-1], bool)
        real[starts[1:] - 1] = False
        rows = np.lib.stride_tricks.sliding_window_view(flat, WINDOW + 1)[::SCORED][: len(real)][real]
        out = np.empty((len(rows), SCORED))
        for at in range(0, len(rows), at_once):
            own = slice(at, at + at_once)
            with np.errstate(over="ignore", invalid="ignore"):
                out[own] = self._windows(rows[own], False)
            if not np.isfinite(out[own]).all():
                out[own] = self._windows(rows[own], True)
        return out[rows[:, WINDOW - SCORED + 1 :] >= 0] / np.log(10)

    def _windows(self, rows: np.ndarray, bounded: bool) -> np.ndarray:
        """Log probabilities of the scored tokens of each window."""
        inputs, targets = rows[:, :-1], np.maximum(rows[:, WINDOW - SCORED + 1 :], 0)
        edges = np.flatnonzero(inputs.min(axis=1) < 0)  # windows at the ends of a text
        shown = inputs[edges] >= 0
        inputs = np.maximum(inputs, 0).astype(np.intp)
        context = WINDOW - SCORED
        last = inputs[:, context:]

        def laid(name: str, classes: np.ndarray) -> np.ndarray:
            table = self.tables[name]
            out = self.room.array(name, (*classes.shape, table.shape[1]), table.dtype)
            table.take(classes, axis=0, out=out, mode="clip")
            out += self.places[name]
            return out

        key, value, query = laid("key", inputs), laid("value", inputs), laid("query", last)
        scores = self.room.array("scores", (*last.shape, WINDOW), key.dtype)
        _exp(np.matmul(query, key.transpose(0, 2, 1), out=scores), bounded)
        scores *= self.seen
        scores[edges] *= shown[:, None, :]
        summed = np.matmul(scores, value, out=self.room.array("summed", (*last.shape, WIDTH + 1), key.dtype))
        state = self.room.array("state", query.shape, key.dtype)
        np.divide(summed[..., :WIDTH], summed[..., WIDTH:], out=state)  # the last column counts
        state += self.weights["embed"].take(last, axis=0)
        state += self.weights["place"][context:]
        hit = targets.ravel()
        groups = self.bigrams.group_of.take(hit)
        order, parts = _by_group(groups)
        state, before, groups = state.reshape(-1, WIDTH).take(order, axis=0), last.ravel().take(order), groups.take(order)
        members = self.bigrams.member_of.take(hit.take(order))
        _, logs, _ = _drawn(_group_logits(self.weights, self.bigrams, state, before, self.room), groups, bounded)
        logits = _member_logits(self.weights, self.bigrams, state, before, groups, parts, self.room)
        out = np.empty(len(hit))
        out[order] = logs + _drawn(logits, members, bounded)[1]
        return out.reshape(last.shape)


# ---- words, ids and classes -----------------------------------------------------------------------------------


def class_table(ids: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The class of each of ``size`` ids. Class 0 is the end; frequent ids come first; ties go to the smaller id."""
    full = np.zeros(size, np.int64)
    full[ids] = counts
    order = np.argsort(-full, kind="stable")
    single = CLASSES - SHARED - 1
    table = np.empty(size, np.int16)
    table[order[:single]] = np.arange(1, single + 1)
    rest = order[single:]
    mass = np.cumsum(full[rest] + 0.5)
    table[rest] = single + 1 + np.minimum((mass - mass[0]) * SHARED // mass[-1], SHARED - 1).astype(np.int16)
    return table


class _Numbers(dict):
    """Gives each new key the next number and notes it."""

    def __init__(self) -> None:
        self.fresh: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        number = self[key] = len(self)
        self.fresh.append(key)
        return number


class Words:
    """Remembers the words of a task: their ids and a number for each."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.encoder = encoder_of(ranks)
        self.begins = np.zeros(max(ranks.values()) + 1, bool)
        self.begins[[i for piece, i in ranks.items() if piece[:1] == b" "]] = True
        self.clear()

    def clear(self) -> None:
        self.numbers = _Numbers()
        self.ids = np.empty(0, np.int32)
        self.starts = np.zeros(1, np.int64)

    def take(self, texts: pa.Array | list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts in a row, and where each text's begin."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        found = pc.ascii_split_whitespace(pc.ascii_lower(texts))
        coded = found.flatten().dictionary_encode()  # a word that repeats is looked up once
        different = coded.dictionary.cast(pa.binary())
        line = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(different)], pa.int32()), different), b"\n")
        words = line[0].as_py().split(b"\n") if len(different) else []
        at = words.index(b"") if b"" in words else None  # white space at the ends of a text leaves empty ones
        if at is not None:
            del words[at]
        of = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        of = of if at is None else np.insert(of, at, -1)
        numbers = of[coded.indices.to_numpy()]
        full = numbers >= 0
        fresh, self.numbers.fresh = self.numbers.fresh, []
        if fresh:
            line = b" ".join([b"", *fresh]).decode("utf-8", "replace")
            ids = self.encoder.encode_to_numpy(line, disallowed_special=()).astype(np.int32)
            starts = np.flatnonzero(self.begins[ids])
            self.starts = np.concatenate([self.starts, len(self.ids) + starts[1:], [len(self.ids) + len(ids)]])
            self.ids = np.concatenate([self.ids, ids])
        bounds = np.concatenate([[0], np.cumsum(found.value_lengths().to_numpy())])
        return numbers[full], np.concatenate([[0], np.cumsum(full)])[bounds]

    def token_ids(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in a row, and where each word's begin."""
        lengths = (self.starts[1:] - self.starts[:-1])[numbers]
        ends = np.cumsum(lengths)
        flat = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self.starts[numbers] - (ends - lengths), lengths)
        return self.ids[flat], np.concatenate([[0], ends])

    def counts(self, seen: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(kind, keys, counts) of words, of ids and of the words that begin with an id, from the words' counts."""
        size = len(self.begins)
        values, hashes, ids_seen = id_values(size), [np.empty(0, np.uint64)], np.zeros(size, np.int64)
        for at in range(0, len(seen), 1 << 16):  # so many words at a time, so that the arrays stay small
            bounds = self.starts[at : at + (1 << 16) + 1]
            ids, times = self.ids[bounds[0] : bounds[-1]], seen[at : at + (1 << 16)]
            hashes.append(common.run_hashes(values[ids], bounds - bounds[0]))
            ids_seen += np.bincount(ids, np.repeat(times, np.diff(bounds)), minlength=size).astype(np.int64)
        yield WORD, np.concatenate(hashes).view(np.int64), seen
        yield ID, np.arange(size), ids_seen
        firsts_seen = np.bincount(self.ids[self.starts[:-1]], seen, minlength=size)
        yield FIRST, np.arange(size), firsts_seen.astype(np.int64)


def id_values(size: int) -> np.ndarray:
    """What an id adds to the hash of a word: a word is known by its ids."""
    return common.mix(np.arange(1, size + 1, dtype=np.uint64))


def _id_type(size: int) -> type:
    """The type of staged ids, for a vocabulary of ``size``."""
    return np.uint16 if size <= 1 << 16 else np.uint32


def _staged_ids(column: pa.Array, size: int) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Rows in groups: the ids of their texts in a row, and where each text's begin."""
    kind = np.dtype(_id_type(size))
    wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    bounds = np.frombuffer(places, wide)[column.offset : column.offset + len(column) + 1] // kind.itemsize
    flat = np.frombuffer(data or b"", kind, bounds[-1] if len(column) else 0)
    for part in common.groups_of_rows(np.diff(bounds).tolist(), common.GROUP_BYTES // 4):
        own = bounds[part.start : part.stop + 1].astype(np.int64)
        yield part, flat[own[0] : own[-1]], own - own[0]


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that the model doesn't learn from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


@dataclass
class Model:
    scorer: Scorer
    classes: np.ndarray  # of each id
    within: np.ndarray  # log10 probability of each id in its class
    total: int  # training tokens (words and ends)
    distinct: int
    ends: int  # training texts
    share: float  # weight of the product over a word's ids
    firsts: np.ndarray  # training words that begin with each id
    begins: np.ndarray  # whether a word begins with each id
    words: np.ndarray  # sorted hashes of frequent words
    counts: np.ndarray

    def __post_init__(self) -> None:
        # where the hashes with the same first bits begin among the sorted ones
        self.shift = 63 - min(20, max(1, len(self.words).bit_length()))
        self.half = 1 << (63 - self.shift)
        self.first_of = np.searchsorted(self.words >> self.shift, np.arange(-self.half, self.half)).astype(np.int32)

    def counts_of(self, hashes: np.ndarray) -> np.ndarray:
        """The counts of words in the table, -1 for others."""
        if not len(self.words):
            return np.full(len(hashes), -1)
        last = len(self.words) - 1
        at = np.minimum(self.first_of.take((hashes >> self.shift) + self.half), last)
        behind = np.flatnonzero(self.words.take(at) < hashes)
        while len(behind):
            behind = behind[at[behind] < last]
            at[behind] += 1
            behind = behind[self.words.take(at[behind]) < hashes[behind]]
        return np.where(self.words.take(at) == hashes, self.counts.take(at), -1)

    def mix(self, product: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """log10 probability of words from the product's and first id's log10 and their training counts.

        ``first`` has the number of words with that first id taken off already.
        """
        with np.errstate(divide="ignore"):
            plain = first + np.log((1 - self.share) * np.maximum(counts, 0)) / _LN10
        product = product + np.log10(self.share)
        top, low = np.maximum(plain, product), np.minimum(plain, product)
        return top + np.log(1 + np.exp((low - top) * _LN10)) / _LN10


def _first_fit(texts: DataFrame, classes: np.ndarray, bigrams: Bigrams, tokens: int) -> dict:
    """Attention weights to start from, by about ``FIRST_WINDOWS`` of the windows of all texts."""
    width = np.dtype(_id_type(len(classes))).itemsize
    chance = min(1.0, FIRST_WINDOWS * WINDOW / max(1, tokens))
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = shared.value
        for batch in batches:
            found = [np.empty((0, WINDOW + 1), np.int16)]
            marks, wanted = (batch.column(at).to_numpy().astype(np.uint64) for at in (0, 1))
            for part, ids, cuts in _staged_ids(batch.column(2), len(classes)):
                for a, b, mark, n in zip(cuts[:-1], cuts[1:], marks[part], wanted[part]):
                    windows = training_windows(np.append(classes.take(ids[a:b]), np.int16(0)))
                    places = common.mix(mark + np.arange(n, dtype=np.uint64)) % np.uint64(len(windows))
                    found.append(windows[np.unique(places)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row.tobytes() for row in np.concatenate(found)], pa.binary())], names=["window"]
            )

    mark = F.xxhash64("ids").bitwiseAND(F.lit((1 << 62) - 1))  # equal texts have the same luck
    pieces = F.ceil((F.octet_length("ids") / width + 1) / WINDOW)
    wanted = F.floor(pieces * chance + mark / float(1 << 62))
    chosen = texts.select(mark.alias("mark"), wanted.alias("wanted"), "ids").filter("wanted > 0")
    drawn = sorted(chosen.mapInArrow(draw, "window binary").toArrow()["window"].to_pylist())
    trainer = Trainer(_first_weights(), bigrams)
    if drawn:
        windows = np.frombuffer(b"".join(drawn), np.int16).reshape(-1, WINDOW + 1)
        draw_rows = np.random.default_rng(9)
        steps = min(FIRST_STEPS, 4 * len(windows))
        for step in range(steps):
            trainer.rate = RATE * min(1, (step + 1) / 50) * (1 - step / steps)
            trainer.train(windows[draw_rows.integers(0, len(windows), BATCH)])
    return trainer.weights


def _rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    full = n != 0
    keys, n = keys[full], n[full]
    kinds = pa.array(np.full(len(keys), kind, np.int32))
    return pa.RecordBatch.from_arrays(
        [kinds, pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))], names=["kind", "key", "n"]
    )


def _summed(texts: DataFrame, run) -> DataFrame:
    found = texts.mapInArrow(run, "kind int, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n")).filter("n <> 0")


@dataclass
class Tokens:
    """The texts of a table as ids."""

    docs: DataFrame  # row, id, held, ids
    counts: DataFrame  # kind, key, n: of the words of training texts, of ids and of words that begin with an id
    id_col: str


def tokens(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> Tokens:
    """The ids of all texts, staged, so that `fit` and `score` need not take the texts apart again."""
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(tokenizer_path))
    id_kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words(ranks.value)
        kind = _id_type(len(words.begins))
        seen = np.zeros(0, np.int64)
        ends, schema = 0, None

        def counted() -> pa.RecordBatch:
            found = [*words.counts(seen), (WORD, np.array([END_WORD]), np.array([ends]))]
            columns = {
                "kind": pa.array([k for k, _, _ in found], pa.int32()),
                "keys": pa.array([keys[n > 0].tobytes() for _, keys, n in found], pa.binary()),
                "counts": pa.array([n[n > 0].tobytes() for _, _, n in found], pa.binary()),
            }
            return pa.RecordBatch.from_arrays(
                [columns.get(f.name, pa.nulls(len(found), f.type)) for f in schema], schema=schema
            )

        for batch in batches:
            id_type = batch.column(1).type
            schema = pa.schema(
                [("row", pa.int64()), ("id", id_type), ("held", pa.bool_()), ("ids", pa.binary())]
                + [("kind", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())]
            )
            learnt = ~batch.column(2).to_numpy(zero_copy_only=False)
            sizes = pc.binary_length(batch.column(3)).to_pylist()
            for part in common.groups_of_rows(sizes, TAKEN_BYTES):
                if len(words.numbers) > MOST_REMEMBERED:
                    yield counted()
                    words.clear()
                    seen, ends = np.zeros(0, np.int64), 0
                rows = batch.slice(part.start, part.stop - part.start)
                numbers, starts = words.take(rows.column(3))
                grown = np.bincount(numbers[np.repeat(learnt[part], np.diff(starts))], minlength=len(words.numbers))
                grown[: len(seen)] += seen
                seen = grown
                ends += int(learnt[part].sum())
                ids, word_starts = words.token_ids(numbers)
                cuts = (word_starts[starts] * np.dtype(kind).itemsize).astype(np.int32)
                buffers = [None, pa.py_buffer(cuts), pa.py_buffer(ids.astype(kind))]
                found = [*rows.columns[:3], pa.Array.from_buffers(pa.binary(), len(rows), buffers)]
                found += [pa.nulls(len(rows), f.type) for f in [*schema][4:]]
                yield pa.RecordBatch.from_arrays(found, schema=schema)
        if schema is not None:
            yield counted()

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, *found in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                yield _rows(kind, *(np.frombuffer(x.as_buffer(), np.int64) for x in found))

    text = common.whole_text(text_col).alias("text")
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), held_out(id_col).alias("held"), text
    )
    out = f"row long, id {id_kind}, held boolean, ids binary, kind int, keys binary, counts binary"
    staged = common.stage(rows.mapInArrow(run, out), "lm-tokens")
    return Tokens(
        staged.filter("row IS NOT NULL").select("row", "id", "held", "ids"),
        _summed(staged.filter("kind IS NOT NULL").select("kind", "keys", "counts"), spread),
        id_col,
    )


def _streams(
    batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int], classes: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The classes of a group of texts in a row, each text with its end, and where the texts begin and end.

    The column has the texts, or their ids as `tokens` stages them.
    """
    words = None
    for batch in batches:
        column = batch.column(0)
        if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
            for _, ids, cuts in _staged_ids(column, len(classes)):
                yield np.insert(classes.take(ids), cuts[1:], 0), cuts + np.arange(len(cuts))
            continue
        words = words or Words(ranks)
        for _, texts in common.texts_in_groups(column):
            if len(words.numbers) > MOST_REMEMBERED:
                words.clear()
            numbers, starts = words.take(texts)
            ids, word_starts = words.token_ids(numbers)
            cuts = word_starts[starts]
            yield np.insert(classes.take(ids), cuts[1:], 0), cuts + np.arange(len(cuts))


def _bigrams(texts: DataFrame, ranks: Broadcast, classes: np.ndarray) -> Bigrams:
    """The class bigrams of all texts."""
    shared = texts.sparkSession.sparkContext.broadcast(classes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = np.zeros(CLASSES * CLASSES, np.int64)
        for stream, _ in _streams(batches, ranks.value, shared.value):
            codes = stream.astype(np.int32)
            codes[1:] += stream[:-1].astype(np.int32) * CLASSES  # before the first stands an end, class 0
            pairs += np.bincount(codes, minlength=len(pairs))
        yield _rows(BIGRAM, np.arange(len(pairs)), pairs)

    found = _summed(texts, run).toArrow()  # bounded by the number of classes
    table = np.zeros(CLASSES * CLASSES)
    table[found["key"].to_numpy()] = found["n"].to_numpy()
    table = table.reshape(CLASSES, CLASSES)
    return Bigrams.of(table, slots_of(table))


def _trained(
    texts: DataFrame, ranks: Broadcast, classes: np.ndarray, bigrams: Bigrams, weights: dict
) -> tuple[dict, int, int]:
    """Weights after training on every window of all texts, the steps of all tasks, and their windows."""
    shared = texts.sparkSession.sparkContext.broadcast((classes, bigrams, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, bigrams, weights = shared.value
        trainer = Trainer(weights, bigrams, rate=RATE / 10)
        waiting = np.empty((0, WINDOW + 1), np.int16)
        windows = 0
        for stream, bounds in _streams(batches, ranks.value, classes):
            waiting = np.concatenate([waiting, *(training_windows(stream[a:b]) for a, b in zip(bounds, bounds[1:]))])
            whole = len(waiting) // BATCH * BATCH
            for at in range(0, whole, BATCH):
                trainer.train(waiting[at : at + BATCH])
            windows += whole
            waiting = waiting[whole:]
        if len(waiting):
            trainer.train(waiting)
            windows += len(waiting)
        flat = np.rint(_pack_weights(trainer.weights).astype(float) * _FIXED_POINT).astype(np.int64) * trainer.step
        yield _rows(TRAINED, np.arange(len(flat)), flat)
        yield _rows(WEIGHT, np.array([0]), np.array([trainer.step]))
        yield _rows(WINDOWS, np.array([0]), np.array([windows]))

    found = _summed(texts, run).toArrow()  # bounded by the number of weights
    kinds, keys, n = (found[c].to_numpy() for c in ("kind", "key", "n"))
    steps, windows = (int(n[kinds == kind].sum()) for kind in (WEIGHT, WINDOWS))
    if steps:
        flat = np.zeros(len(_pack_weights(weights)))
        flat[keys[kinds == TRAINED]] = n[kinds == TRAINED]
        weights = _unpack_weights((flat / _FIXED_POINT / steps).astype(np.float32))
    return weights, steps, windows


def fit(
    docs: DataFrame | Tokens, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[Model, DataFrame]:
    """The model, and the table (word, n) of the counts that are not in it; learns from rows not held out.

    ``docs`` is the table, or its `tokens`, whose columns are known.
    """
    found = docs if isinstance(docs, Tokens) else tokens(docs, tokenizer_path, id_col, text_col)
    texts = found.docs.filter(~F.col("held")).select("ids")
    ranks = texts.sparkSession.sparkContext.broadcast(load_ranks(tokenizer_path))
    counted = common.stage(found.counts, "lm-counts")
    words = counted.filter(F.col("kind") == WORD).select(F.col("key").alias("word"), "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    ends = words.filter(F.col("word") == END_WORD).first()
    # The counts that occur are few; the smallest n that leaves a bounded number of words at or above it.
    sizes = words.groupBy("n").agg(F.count(F.lit(1)).alias("words")).collect()
    above, least = 0, None
    for r in sorted(sizes, key=lambda r: -r["n"]):
        if above + r["words"] > MOST_BROADCAST_WORDS:
            break
        above, least = above + r["words"], r["n"]
    kept = words.filter(F.col("n") >= least) if least is not None else words.limit(0)
    frequent = kept.toArrow().sort_by("word")
    rest = words.filter(F.col("n") < least) if least is not None else words
    # bounded by the number of ids
    others = counted.filter(F.col("kind") != WORD).toArrow()
    kinds, keys, n = (others[c].to_numpy() for c in ("kind", "key", "n"))

    def filled(kind: int, size: int) -> np.ndarray:
        out = np.zeros(size)
        out[keys[kinds == kind]] = n[kinds == kind]
        return out

    size = max(ranks.value.values()) + 1
    firsts, per_id = filled(FIRST, size), filled(ID, size)
    classes = class_table(np.arange(size), per_id, size)
    smooth = per_id + 0.5
    within = np.log10(smooth / np.bincount(classes, smooth, minlength=CLASSES)[classes])
    bigrams = _bigrams(texts, ranks, classes)
    start = _first_fit(texts, classes, bigrams, int(per_id.sum()) + (ends["n"] if ends else 0))
    weights, _, _ = _trained(texts, ranks, classes, bigrams, start)
    model = Model(
        Scorer(weights, bigrams),
        classes,
        within,
        int(total),
        int(distinct),
        ends["n"] if ends else 0,
        PRODUCT_SHARE,
        firsts,
        Words(ranks.value).begins,
        frequent["word"].to_numpy().astype(np.int64),
        frequent["n"].to_numpy().astype(np.int64),
    )
    return model, rest


def score(
    docs: DataFrame | Tokens,
    model: Model,
    rest: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``id_col, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row's whole text.

    Words are runs without white space, A to Z in lower case, and an end. ``base_score`` is the sum of smoothed word
    logs, ``score`` the model's log10 probability. A null or empty text has its end alone. A null id is kept and is
    learnt from; repeated rows are scored one by one; other columns are not looked at; an empty table gives an empty
    result, and without training texts all words are unknown. ``docs`` is the table, or its `tokens`.
    """
    found = docs if isinstance(docs, Tokens) else tokens(docs, tokenizer_path, id_col, text_col)
    id_col = found.id_col
    shared = rest.sparkSession.sparkContext.broadcast(model)
    kind = found.docs.schema["id"].dataType.simpleString()
    out = f"row long, id {kind}, n_tokens long, known long, base double, score double, "
    out += "words array<long>, products array<double>, firsts array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        size = len(model.classes)
        values, log_firsts = id_values(size), np.log10(np.maximum(model.firsts, 1))
        log_all = np.log10(model.total + model.distinct + 1)
        for batch in batches:
            for part, ids, cuts in _staged_ids(batch.column(2), size):
                ids = ids.astype(np.intp)
                word_starts = np.append(np.flatnonzero(model.begins.take(ids)), len(ids))
                starts = np.searchsorted(word_starts, cuts)
                hashes = common.run_hashes(values.take(ids), word_starts).view(np.int64)
                counts = model.counts_of(hashes)
                kinds, inside = model.classes.take(ids), np.concatenate([[0.0], np.cumsum(model.within.take(ids))])
                ends = np.zeros(1, np.int16)
                sequences = [np.concatenate([kinds[a:b], ends]) for a, b in zip(cuts[:-1], cuts[1:])]
                logs_of = model.scorer.log_probabilities(sequences)
                end_at = cuts[1:] + np.arange(len(cuts) - 1)
                running = np.concatenate([[0.0], np.cumsum(np.delete(logs_of, end_at))]) + inside
                begins = word_starts[:-1]
                product = running[word_starts[1:]] - running[begins]  # of each word
                first = running[begins + 1] - running[begins] - log_firsts.take(ids[begins])
                mixed = model.mix(product, first, counts)
                summed = np.concatenate([[0.0], np.cumsum(np.where(counts >= 0, mixed, 0))])
                scores = summed[starts[1:]] - summed[starts[:-1]] + logs_of[end_at]
                logs = np.concatenate([[0.0], np.cumsum(np.log10(np.maximum(counts, 0) + 1.0))])
                sure = np.concatenate([[0], np.cumsum(counts > 0)])
                lengths = np.diff(starts) + 1
                base = logs[starts[1:]] - logs[starts[:-1]] + np.log10(model.ends + 1) - lengths * log_all
                certain = sure[starts[1:]] - sure[starts[:-1]] + (model.ends > 0)
                odd = np.flatnonzero(counts < 0)
                bounds = pa.array(np.searchsorted(odd, starts), pa.int32())
                odd_hashes = pa.array(hashes[odd])
                odd_products, odd_firsts = pa.array(product[odd]), pa.array(first[odd])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[part.start : part.stop],
                        batch.column(1)[part.start : part.stop],
                        pa.array(lengths, pa.int64()),
                        pa.array(certain, pa.int64()),
                        pa.array(base, pa.float64()),
                        pa.array(scores, pa.float64()),
                        pa.ListArray.from_arrays(bounds, odd_hashes),
                        pa.ListArray.from_arrays(bounds, odd_products),
                        pa.ListArray.from_arrays(bounds, odd_firsts),
                    ],
                    names=["row", "id", "n_tokens", "known", "base", "score", "words", "products", "firsts"],
                )

    scored = common.stage(found.docs.select("row", "id", "ids").mapInArrow(run, out), "lm-scored")
    odd = scored.select("row", F.explode(F.arrays_zip("words", "products", "firsts")).alias("w")).select("row", "w.*")
    counted = odd.join(rest, F.col("words") == F.col("word"), "left")
    share, n = F.lit(model.share), F.coalesce("n", F.lit(0))
    # as in `Model.mix`: the larger of the two, and what the smaller adds
    product, plain = F.col("products") + F.log10(share), F.col("firsts") + F.log10((1 - share) * n)
    top, low = F.greatest(product, plain), F.least(product, plain)
    both = top + F.log10(1 + F.pow(F.lit(10.0), low - top))
    mixed = F.when(n == 0, product).otherwise(both)
    added = counted.groupBy("row").agg(
        F.sum(F.log10(n + 1.0)).alias("more"), F.count("n").alias("more_known"), F.sum(mixed).alias("more_score")
    )
    return scored.join(added, "row", "left").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("more", F.lit(0.0))).alias("base_score"),
        (F.col("score") + F.coalesce("more_score", F.lit(0.0))).alias("score"),
    )
