"""Cost-balanced packing of tokenised documents into training sequences.

The cost of a piece is linear plus quadratic in its length: tokens pass through every layer, and attention inside a
piece is quadratic. Pieces go, longest first, to the cheapest sequence that has room. Packing is local to a
task: a task gathers a block of about ``BLOCK_TOKENS`` tokens, packs it and goes on, so nothing is shuffled
and memory is bounded; a block leaves less than one sequence of padding.

Ids equal those of the ``tokenizers`` library for the vocabulary file, added tokens such as ``<|endoftext|>`` in a text
included. They are made by `tiktoken` from the ranks of that file, which takes a quarter of the time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T


CAPACITY = 2048
END_ID = 1
BLOCK_TOKENS = 1 << 20
# Cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR = 1.0
QUADRATIC = 1.0 / 1024

Piece = tuple[int, int, int]  # document's place in the block, start, length


def cost(length: int) -> float:
    return LINEAR * length + QUADRATIC * length * length


def pack(pieces: list[Piece], capacity: int = CAPACITY) -> list[list[Piece]]:
    """Pieces as sequences of at most ``capacity``; as few sequences as the tokens need.

    Longest first; each goes to the cheapest of all sequences with room for it. Where none has room, the piece is
    cut and fills the cheapest.
    """
    total = sum(p[2] for p in pieces)
    sequences: list[list[Piece]] = [[] for _ in range(-(-total // capacity))]
    # (cost, sequence) by the room left, and a tree with the cheapest of each range of rooms
    by_room: list[list[tuple[float, int]]] = [[] for _ in range(capacity + 1)]
    leaves = capacity + 1
    none = (float("inf"), -1, 0)
    tree = [none] * (2 * leaves)

    def renew(room: int) -> None:
        at = leaves + room
        tree[at] = (*by_room[room][0], room) if by_room[room] else none
        while at > 1:
            at //= 2
            tree[at] = min(tree[2 * at], tree[2 * at + 1])

    def cheapest(room: int) -> tuple[float, int, int]:
        best, low, high = none, leaves + room, 2 * leaves
        while low < high:
            if low % 2:
                best = min(best, tree[low])
                low += 1
            if high % 2:
                high -= 1
                best = min(best, tree[high])
            low, high = low // 2, high // 2
        return best

    by_room[capacity] = [(0.0, s) for s in range(len(sequences))]  # a heap as it is
    if sequences:
        renew(capacity)
    for doc, start, length in sorted(pieces, key=lambda p: (-p[2], p[0])):
        while length:
            spent, s, room = cheapest(length)
            if s < 0:
                spent, s, room = cheapest(1)
            part = min(room, length)
            heappop(by_room[room])
            renew(room)
            sequences[s].append((doc, start, part))
            start, length = start + part, length - part
            if room > part:
                heappush(by_room[room - part], (spent + cost(part), s))
                renew(room - part)
    return sequences


def load_ranks(path: str) -> dict[bytes, int]:
    """The pieces of a byte-level ``tokenizers`` file as bytes, with their ids."""
    vocabulary = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte_of[c] for c in piece): i for piece, i in vocabulary.items() if set(piece) <= byte_of.keys()}


def load_added(path: str) -> dict[str, int]:
    """The added tokens of a ``tokenizers`` file, which it finds in a text before any other piece, with their ids."""
    tokens = json.load(open(path, encoding="utf-8")).get("added_tokens") or []
    for token in tokens:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added token with conditions on its neighbours: {token['content']!r}")
    added = {token["content"]: token["id"] for token in tokens}
    for a in added:
        if any(b != a and b.startswith(a) for b in added):
            raise ValueError(f"added token that another begins with: {a!r}")
    return added


def encoder_of(ranks: dict[bytes, int], added: dict[str, int] | None = None):
    """An encoder for such pieces; its ``encode`` takes added tokens as such where they are allowed."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added or {})


def load_encoder(path: str):
    return encoder_of(load_ranks(path), load_added(path))


def ids_of(encoder, text: str) -> np.ndarray:
    """The text's ids, with the encoder's added tokens wherever they stand in it."""
    return encoder.encode_to_numpy(text, allowed_special="all", disallowed_special=())


def packed(
    docs: DataFrame,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of all documents in sequences: ``id_col, start, length, ids, doc_tokens, sequence_id, offset``.

    A document's ids are those of its whole text, with the file's added tokens where they stand in it, and then ``end_id``; a null text counts as empty, so it
    gives that one id. Documents longer than a sequence fill sequences of their own first. ``ids`` is
    binary, little-endian unsigned 32-bit. ``sequence_id`` is unique; its high bits are the task. Repeated rows are
    packed one by one; null ids are kept; other columns are not looked at; an empty table gives an empty result.
    The rows of a task are taken in their order, so ``docs`` should be a table or a file scan, whose recomputation
    gives the same rows.
    """
    out = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("start", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("ids", T.BinaryType()),
            T.StructField("doc_tokens", T.LongType()),
            T.StructField("sequence_id", T.LongType()),
            T.StructField("offset", T.LongType()),
        ]
    )

    ranks = docs.sparkSession.sparkContext.broadcast((load_ranks(tokenizer_path), load_added(tokenizer_path)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(*ranks.value)
        next_id = TaskContext.get().partitionId() << 40
        schema = None

        def emit(names: list, ids: list[np.ndarray], sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal next_id
            columns: list[list] = [[] for _ in range(7)]
            for sequence in sequences:
                offset = 0
                for doc, start, length in sequence:
                    tokens = ids[doc]
                    piece = tokens[start : start + length].tobytes()
                    for column, value in zip(columns, (names[doc], start, length, piece, len(tokens), next_id, offset)):
                        column.append(value)
                    offset += length
                next_id += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        names: list = []
        ids: list[np.ndarray] = []
        pieces: list[Piece] = []
        whole: list[list[Piece]] = []
        held = 0
        for batch in batches:
            if schema is None:
                long, binary = pa.int64(), pa.binary()
                kinds = [batch.schema.field(0).type, long, long, binary, long, long, long]
                schema = pa.schema([pa.field(f.name, k) for f, k in zip(out, kinds)])
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                tokens = ids_of(encoder, text.as_py() or "")
                tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                doc = len(names)
                names.append(name)
                ids.append(tokens)
                full = len(tokens) // capacity * capacity
                whole += [[(doc, at, capacity)] for at in range(0, full, capacity)]
                if len(tokens) > full:
                    pieces.append((doc, full, len(tokens) - full))
                held += len(tokens)
                if held >= BLOCK_TOKENS:
                    yield emit(names, ids, whole + pack(pieces, capacity))
                    names, ids, pieces, whole, held = [], [], [], [], 0
        if names:
            yield emit(names, ids, whole + pack(pieces, capacity))

    return docs.select(id_col, text_col).mapInArrow(run, out)
