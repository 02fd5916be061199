import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import packing, queries


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(queries.tokenizer_path())
    found.encode_special_tokens = True
    return found


@pytest.fixture(scope="module")
def unchanged():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


@pytest.fixture(scope="module")
def encoder():
    return packing.load_encoder(queries.tokenizer_path())


def whole(rows):
    out = {}
    for r in rows:
        out.setdefault(r.doc_id, []).append((r.start, np.frombuffer(r.ids, "<u4"), r))
    return out


def test_every_id_lies_in_one_piece(documents, tokenizer):
    rows = packing.packed(documents, queries.tokenizer_path()).collect()
    texts = {r.doc_id: r.text for r in documents.collect()}
    for doc, pieces in whole(rows).items():
        want = tokenizer.encode(texts[doc], add_special_tokens=False).ids + [1]
        pieces.sort(key=lambda p: p[0])
        assert [p[0] for p in pieces] == np.cumsum([0, *(len(p[1]) for p in pieces)])[:-1].tolist()
        assert np.concatenate([p[1] for p in pieces]).tolist() == want
        assert {p[2].doc_tokens for p in pieces} == {len(want)}
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == np.cumsum([0, *(r.length for r in own)])[:-1].tolist()
        assert sum(r.length for r in own) <= 2048
    tokens = sum(r.length for r in rows)
    assert len(sequences) * 2048 - tokens < 2048 * documents.rdd.getNumPartitions()


def test_query_digests(spark):
    directory = "/root/testdata/sf0.001"
    rows = queries.QUERIES["op7_packing"](spark, directory).collect()
    pieces = packing.packed(spark.read.parquet(f"{directory}/documents.parquet"), queries.tokenizer_path()).collect()
    assert sorted((r.doc_id, r.start, r.ids_crc32) for r in rows) == sorted((r.doc_id, r.start, zlib.crc32(r.ids)) for r in pieces)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_ids_equal_the_library(encoder, tokenizer, text):
    assert encoder.encode_to_numpy(text, disallowed_special=()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_special_strings_are_text(encoder, tokenizer):
    text = "a <|endoftext|> b"
    assert encoder.encode_to_numpy(text, disallowed_special=()).tolist() == tokenizer.encode(text, add_special_tokens=False).ids


ADDED = ["a<|endoftext|>b", "<|endoftext|>", " <|endoftext|> <|endoftext|>\n<|endoftext|><|endoftext|>.", "<|endoftext|"]


def test_added_tokens_in_texts_equal_the_unchanged_library(spark, unchanged):
    docs = spark.createDataFrame(list(enumerate(ADDED)), "doc_id long, text string")
    for r in packing.packed(docs, queries.tokenizer_path()).collect():
        want = [*unchanged.encode(ADDED[r.doc_id], add_special_tokens=False).ids, packing.END_ID]
        assert np.frombuffer(r.ids, "<u4").tolist() == want and r.doc_tokens == len(want)


@settings(max_examples=150, deadline=None)
@given(parts=st.lists(st.text(max_size=20), min_size=1, max_size=4))
def test_ids_around_added_tokens_equal_the_unchanged_library(encoder, unchanged, parts):
    text = "<|endoftext|>".join(parts)
    assert packing.ids_of(encoder, text).tolist() == unchanged.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 2047), max_size=40))
def test_pack_needs_no_more_sequences_than_tokens(lengths):
    sequences = packing.pack([(i, 0, n) for i, n in enumerate(lengths)])
    assert len(sequences) == -(-sum(lengths) // 2048)
    assert all(sum(p[2] for p in s) <= 2048 for s in sequences)
    covered = {}
    for s in sequences:
        for doc, start, n in s:
            covered.setdefault(doc, []).append((start, n))
    assert {d: sum(n for _, n in p) for d, p in covered.items()} == dict(enumerate(lengths))


def plain_pack(pieces, capacity):
    """Every sequence is asked for room."""
    sequences = [[] for _ in range(-(-sum(p[2] for p in pieces) // capacity))]
    left = [[0.0, s, capacity] for s in range(len(sequences))]
    for doc, start, length in sorted(pieces, key=lambda p: (-p[2], p[0])):
        while length:
            best = min([x for x in left if x[2] >= length] or [x for x in left if x[2]])
            part = min(best[2], length)
            sequences[best[1]].append((doc, start, part))
            best[0] += packing.cost(part)
            best[2] -= part
            start, length = start + part, length - part
    return sequences


@pytest.mark.parametrize("seed", range(20))
def test_a_piece_is_cut_only_where_no_sequence_has_room(seed):
    draw = np.random.default_rng(seed)
    lengths = np.minimum(draw.lognormal(4.5, 1.2, 600).astype(int) + 1, 2047).tolist()
    pieces = [(i, 0, n) for i, n in enumerate(lengths)]
    assert packing.pack(pieces) == plain_pack(pieces, packing.CAPACITY)


def test_longest_go_to_the_cheapest():
    sequences = packing.pack([(0, 0, 1500), (1, 0, 1400), (2, 0, 600), (3, 0, 500)])
    assert sorted(sorted(p[0] for p in s) for s in sequences) == [[0, 3], [1, 2]]


def test_edge_cases(edge_docs, no_docs):
    rows = packing.packed(edge_docs, queries.tokenizer_path()).collect()
    found = whole(rows)
    assert [p[1].tolist() for p in found[5]] == [[1]] and [p[1].tolist() for p in found[6]] == [[1]]
    assert sum(len(p[1]) for p in found[12]) == 2 * found[12][0][2].doc_tokens
    assert len(found[None]) == 2
    assert sum(len(p[1]) for p in found[10]) == found[10][0][2].doc_tokens > 100_000
    assert packing.packed(no_docs, queries.tokenizer_path()).count() == 0
