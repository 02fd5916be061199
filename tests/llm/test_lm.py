import dataclasses
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from brute import words

from tierflow.llm import lm, packing, queries

DIRECTORY = "/root/testdata/sf0.001"
PATH = queries.tokenizer_path()


def plain_base(texts):
    """Expected columns of each row, word by word."""
    tokens = {i: [*words(t), None] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    counts = Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    total, distinct = sum(counts.values()), len(counts)
    return {
        i: (
            held[i],
            len(ws),
            sum(counts[w] > 0 for w in ws),
            total,
            sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in ws),
        )
        for i, ws in tokens.items()
    }


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DIRECTORY}/documents.parquet")


@pytest.fixture(scope="module")
def fitted(docs):
    return lm.fit(docs, PATH)


def check(docs, rows):
    want = plain_base({r.doc_id: r.text for r in docs.collect() if r.doc_id is not None})
    for r in rows:
        if r.doc_id is not None:
            held, n, known, total, base = want[r.doc_id]
            assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n, known, total)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert r.score < 0


def test_query(spark, docs):
    rows = queries.QUERIES["op8_lm_scoring"](spark, DIRECTORY).collect()
    assert len(rows) == docs.count()
    check(docs, rows)


def test_joined_counts_give_the_same(spark, docs, monkeypatch):
    """With a small table of frequent words the others come from the join."""
    whole = {r.doc_id: r for r in lm.score(docs, *lm.fit(docs, PATH), PATH).collect()}
    monkeypatch.setattr(lm, "MOST_BROADCAST_WORDS", 50)
    model, rest = lm.fit(docs, PATH)
    assert len(model.words) <= 50
    for r in lm.score(docs, model, rest, PATH).collect():
        assert r.n_known == whole[r.doc_id].n_known
        assert r.base_score == pytest.approx(whole[r.doc_id].base_score, rel=1e-9)
        assert r.score == pytest.approx(whole[r.doc_id].score, rel=1e-3)


def test_probabilities_of_all_classes_sum_to_one(fitted):
    scorer = fitted[0].scorer
    draw = np.random.default_rng(0)
    context = draw.integers(1, lm.CLASSES, 40)
    texts = [np.append(context, c).astype(np.int16) for c in range(lm.CLASSES)]
    last = scorer.log_probabilities(texts).reshape(lm.CLASSES, -1)[:, -1]
    assert (10**last).sum() == pytest.approx(1, abs=1e-4)


def test_ids_of_a_class_and_words_of_a_first_id_sum_to_one(fitted):
    model = fitted[0]
    sums = np.bincount(model.classes, 10**model.within, minlength=lm.CLASSES)
    assert np.allclose(sums[sums > 0], 1)


def test_each_token_is_scored_once_in_its_window(fitted):
    """Batched windows give what the training pass gives for the same window."""
    scorer = fitted[0].scorer
    draw = np.random.default_rng(1)
    text = draw.integers(1, lm.CLASSES, 2 * lm.SCORED + 5)
    logs = scorer.log_probabilities([text.astype(np.int16), text[:3].astype(np.int16)])
    assert len(logs) == len(text) + 3 and np.allclose(logs[-3:], logs[:3], atol=1e-5)
    # the last window alone: its context and tokens as one training window
    start = 2 * lm.SCORED
    context = lm.WINDOW - lm.SCORED
    inputs = np.full((1, lm.WINDOW), 0)
    window = text[start - context - 1 : start - context - 1 + lm.WINDOW]
    inputs[0, : len(window)] = window
    targets = np.zeros_like(inputs)
    targets[0, : len(window) - 1] = window[1:]
    used = np.zeros(inputs.shape, bool)
    used[0, : len(window) - 1] = True
    only = np.arange(lm.WINDOW) >= context
    everything, _ = lm.gradients(scorer.weights, scorer.bigrams, inputs, targets, used)
    earlier = used & ~only
    # loss over the context alone, from the same visible inputs
    shown = np.where(used, 1, 0).sum()
    n_context = earlier.sum()
    context_loss, _ = lm.gradients(scorer.weights, scorer.bigrams, inputs, targets, earlier)
    total = everything * shown - context_loss * n_context
    assert -total / np.log(10) == pytest.approx(logs[start : start + 5].sum(), rel=1e-3)


def test_gradients_equal_differences():
    draw = np.random.default_rng(2)
    bigrams = lm.Bigrams.of(draw.random((lm.CLASSES, lm.CLASSES)), draw.permutation(lm.CLASSES))
    # all in double precision, so that a short step tells the slope
    double = {name: getattr(bigrams, name).astype(np.float64) for name in ("groups", "members")}
    bigrams = dataclasses.replace(bigrams, **double)
    weights = {k: w.astype(np.float64) for k, w in lm._first_weights().items()}
    weights["group"] = draw.normal(0, 0.1, weights["group"].shape)
    weights["member"] = draw.normal(0, 0.1, weights["member"].shape)
    inputs, targets = draw.integers(0, lm.CLASSES, (2, 2, lm.WINDOW))
    used = np.ones(inputs.shape, bool)
    used[1, 30:] = False
    _, found = lm.gradients(weights, bigrams, inputs, targets, used)
    for name in weights:
        place = np.unravel_index(np.abs(found[name]).argmax(), found[name].shape)
        losses = []
        for step in (1e-4, -1e-4):
            moved = {k: w.copy() for k, w in weights.items()}
            moved[name][place] += step
            losses.append(lm.gradients(moved, bigrams, inputs, targets, used)[0])
        assert (losses[0] - losses[1]) / 2e-4 == pytest.approx(float(found[name][place]), rel=1e-5), name


def test_training_beats_the_bigrams(fitted, docs):
    model = fitted[0]
    keeper = lm.Words(packing.load_ranks(PATH))
    untrained = lm.Scorer(lm._first_weights(), model.scorer.bigrams)
    sequences = []
    for r in docs.limit(60).collect():
        numbers, _ = keeper.take([r.text])
        sequences.append(np.append(model.classes[keeper.token_ids(numbers)[0]], 0).astype(np.int16))
    assert model.scorer.log_probabilities(sequences).sum() > untrained.log_probabilities(sequences).sum()


def test_words_have_their_ids():
    keeper = lm.Words(packing.load_ranks(PATH))
    text = "Some words, some  Words\tagain é 漢字 x y <|endoftext|>"
    numbers, starts = keeper.take([text, "", "words again"])
    assert starts.tolist() == [0, 9, 9, 11]
    ids, begins = keeper.token_ids(numbers)
    encoded = [keeper.encoder.encode_ordinary(" " + w.decode()) for w in text.encode().lower().split()]
    assert [ids[a:b].tolist() for a, b in zip(begins[:-1], begins[1:])][:9] == encoded


@pytest.mark.parametrize("parts", [1, 40])
def test_every_window_trains_however_the_texts_are_dealt(spark, docs, fitted, parts):
    model = fitted[0]
    texts = docs.limit(60).select("text").repartition(parts)
    keeper = lm.Words(packing.load_ranks(PATH))
    sizes = [len(keeper.token_ids(keeper.take([r.text])[0])[0]) + 1 for r in texts.collect()]
    ranks = spark.sparkContext.broadcast(packing.load_ranks(PATH))
    start = lm._first_weights()
    weights, steps, windows = lm._trained(texts, ranks, model.classes, model.scorer.bigrams, start)
    assert windows == sum(-(-n // lm.WINDOW) for n in sizes) and steps >= windows / lm.BATCH
    assert any((weights[name] != start[name]).any() for name in start)


def test_classes_come_from_all_training_texts(docs, fitted, monkeypatch):
    keeper = lm.Words(packing.load_ranks(PATH))
    counts = np.zeros(len(keeper.begins), np.int64)
    for r in docs.filter(~lm.held_out()).collect():
        counts += np.bincount(keeper.token_ids(keeper.take([r.text or ""])[0])[0], minlength=len(counts))
    monkeypatch.setattr(lm, "FIRST_WINDOWS", 20)
    monkeypatch.setattr(lm, "FIRST_STEPS", 5)
    model, _ = lm.fit(docs, PATH)
    want = lm.class_table(np.arange(len(counts)), counts, len(counts))
    assert (model.classes == want).all() and (fitted[0].classes == want).all()


def test_edge_cases(edge_docs, no_docs):
    model, rest = lm.fit(edge_docs, PATH)
    rows = lm.score(edge_docs, model, rest, PATH).collect()
    assert len(rows) == edge_docs.count()
    of = {r.doc_id: r for r in rows}
    assert of[5].n_tokens == of[6].n_tokens == of[7].n_tokens == 1
    assert of[10].n_tokens == 60_001 and not of[None].held_out
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert lm.score(no_docs, model, rest, PATH).count() == 0
    nothing, nothing_left = lm.fit(no_docs, PATH)
    rows = lm.score(edge_docs, nothing, nothing_left, PATH).collect()
    assert {r.n_known for r in rows} == {0} and {r.train_tokens for r in rows} == {0}
    assert all(math.isfinite(r.score) for r in rows)


def test_texts_are_taken_apart_once(docs):
    """What fit and score read are the staged ids, not the texts; the rows are those of the table itself."""
    tokens = lm.tokens(docs, PATH)
    model, rest = lm.fit(tokens, PATH)
    scored = lm.score(tokens, model, rest, PATH)
    for read in (tokens.docs, tokens.counts, rest, scored):
        assert not set(read.inputFiles()) & set(docs.inputFiles())
    rows = scored.collect()
    assert len(rows) == docs.count()
    check(docs, rows)
    keeper = lm.Words(packing.load_ranks(PATH))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in tokens.docs.limit(50).collect():
        want = keeper.token_ids(keeper.take([texts[r.id]])[0])[0]
        assert np.frombuffer(r.ids, np.uint16).tolist() == want.tolist()


def test_words_are_those_between_ascii_white_space():
    keeper = lm.Words(packing.load_ranks(PATH))
    texts = [" a\x0b\x0cB\x1cC d \r\n", "", " \t ", "É x\x85y\x00z a", "\u00a0lead trail\u3000"]
    numbers, starts = keeper.take(texts)
    known = {n: w for w, n in keeper.numbers.items()}
    found = [[known[n] for n in numbers[a:b].tolist()] for a, b in zip(starts[:-1], starts[1:])]
    assert found == [t.encode().lower().split() for t in texts]
    ids, begins = keeper.token_ids(numbers)
    assert (np.flatnonzero(keeper.begins[ids]) == begins[:-1]).all()


def test_counts_of_words_are_found_by_their_hashes(fitted):
    draw = np.random.default_rng(3)
    ends = [-(1 << 63), -1, 0, (1 << 63) - 1]
    hashes = np.unique(np.concatenate([ends, draw.integers(-(1 << 63), 1 << 63, 500), np.arange(40) + (7 << 40)]))
    model = dataclasses.replace(fitted[0], words=hashes[::2], counts=np.arange(len(hashes[::2])) + 5)
    want = np.where(np.arange(len(hashes)) % 2 == 0, np.arange(len(hashes)) // 2 + 5, -1)
    assert (model.counts_of(hashes) == want).all()


def test_logits_that_overflow_are_bounded(fitted):
    scorer = fitted[0].scorer
    weights = lm._first_weights()
    weights["embed"][:] = 6
    weights["query"][:] = weights["key"][:] = np.eye(lm.WIDTH)  # scores are 144 and more; exp of that is no float32
    inputs, targets = np.random.default_rng(4).integers(0, lm.CLASSES, (2, 3, lm.WINDOW))
    loss, found = lm.gradients(weights, scorer.bigrams, inputs, targets, np.ones(inputs.shape, bool))
    assert np.isfinite(loss) and all(np.isfinite(g).all() for g in found.values())
    text = targets.ravel().astype(np.int16)
    assert np.isfinite(lm.Scorer(weights, scorer.bigrams).log_probabilities([text])).all()
