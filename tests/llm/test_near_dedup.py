import random

import numpy as np
import pytest
from brute import near_classes

from tierflow.llm import common, components, near_dedup, queries


def check(docs, found):
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id is not None}
    classes, sizes = near_classes(texts)
    rows = [r for r in found.collect() if r.doc_id is not None]
    assert {r.doc_id: r.component_id for r in rows} == classes
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def test_query_equals_all_pairs(spark, documents):
    check(documents, queries.QUERIES["op5_near_dedup"](spark, "/root/testdata/sf0.001"))


def edited(words, draw, rate):
    return " ".join(f"new{draw.random():.9f}" if draw.random() < rate else w for w in words)


def test_group_of_copies_around_the_limit(spark):
    """Copies whose similarities lie on both sides of the limit, and a chain of small steps."""
    draw = random.Random(5)
    words = [f"w{draw.randrange(3000)}" for _ in range(120)]
    texts = [edited(words, draw, draw.choice([0.0, 0.005, 0.01, 0.02, 0.03])) for _ in range(150)]
    chain = [f"c{i}" for i in range(60)]
    for step in range(12):
        texts.append(" ".join(chain[step * 2 : step * 2 + 36]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs, near_dedup.near_duplicates(docs))


def test_a_link_between_two_of_three_versions_with_the_smallest_as_hub(spark):
    """Every band that the linked two share also holds the smallest, which is linked with neither and is the hub."""
    seed = 58411
    draw = random.Random(seed)
    texts = []
    for version in range(3):
        words = [f"w{i}" for i in range(100)]
        for i in draw.sample(range(100), 2):
            words[i] = f"{version}x{i}x{seed}"
        texts.append(" ".join(f"{w}s{seed}" for w in words))
    sets = [near_dedup.shingle_set(common.word_hashes([t])[0]) for t in texts]
    a, b, c = near_dedup.registers(sets).view("<u8")
    assert ((b == c) & (a == b)).any() and not ((b == c) & (a != b)).any()
    assert near_dedup.alike(sets[1], sets[2]) and not any(near_dedup.alike(sets[0], s) for s in sets[1:])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs, near_dedup.near_duplicates(docs))


def test_pairs_of_a_template_group_are_sifted_before_texts_are_read(spark, monkeypatch):
    """Pages that share half of their words, with a few near copies among them: few pairs reach the texts."""
    draw = random.Random(9)
    template = [f"t{k}" for k in range(300)]
    texts = []
    for page in range(120):
        words = list(template)
        for k in range(12):  # twelve places of five shingles each
            words[25 * k + draw.randrange(25)] = f"p{page}x{k}"
        texts.append(" ".join(words))
    texts += [f"{texts[k]} again" for k in range(0, 120, 10)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    counts = []
    verified = near_dedup._verified

    def counted(pairs, *rest):
        counts.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(near_dedup, "_verified", counted)
    check(docs, near_dedup.near_duplicates(docs))
    assert sum(counts) < len(texts) ** 2 / 8


def test_short_texts(spark):
    draw = random.Random(6)
    texts = [" ".join(draw.choice("abc") for _ in range(draw.randrange(12))) for _ in range(250)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs, near_dedup.near_duplicates(docs))


def test_edge_cases(edge_docs, no_docs):
    found = near_dedup.near_duplicates(edge_docs)
    check(edge_docs.filter("doc_id is not null"), found)
    rows = found.collect()
    assert len(rows) == edge_docs.count()
    assert sum(r.kept for r in rows if r.doc_id is None) == 2  # without an id, and without equals that have one
    of = {r.doc_id: r for r in rows}
    assert of[1].component_id == of[2].component_id == of[3].component_id == of[4].component_id == 1
    assert of[5].n_shingles == 0 and of[5].kept and of[8].n_shingles == 1 and not of[9].kept
    assert of[11].component_id == 10
    left = near_dedup.without_near_duplicates(edge_docs)
    assert left.schema.names == edge_docs.schema.names
    assert sorted(r.doc_id for r in left.collect() if r.doc_id is not None) == [1, 5, 6, 7, 8, 10, 12, 12, 13]
    assert near_dedup.near_duplicates(no_docs).count() == 0
    assert near_dedup.without_near_duplicates(no_docs).count() == 0


def test_estimate_is_near_the_truth():
    values = common.mix(np.arange(3000, dtype=np.uint64))
    left, right = np.sort(values[:2000]), np.sort(values[500:2500])
    sketches = near_dedup.registers([left, right])
    guess = near_dedup.estimate(sketches[0], sketches[1], 2000.0, 2000.0)
    assert abs(guess - 1500 / 2500) < 0.15
    apart = near_dedup.registers([values[:1000], values[1000:2000]])
    assert abs(near_dedup.estimate(apart[0], apart[1], 1000.0, 1000.0)) < 0.05


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    draw = random.Random(seed)
    links = [(draw.randrange(400), draw.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 540)]
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        if a != b:
            ra, rb = root(a), root(b)
            parent[max(ra, rb)] = min(ra, rb)
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {i: root(i) for i in parent}
    assert len(found) == len(parent)


def test_no_links(spark):
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0
