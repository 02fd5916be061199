import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tierflow.llm import automata, queries, secrets

SCANNER = secrets.Scanner()
BASE = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    (re.compile("AKIA[A-Z0-9]+"), 0, 20),
    (re.compile("[0-9a-f]+"), 0, 24),
]


def plain(text):
    return sorted(
        (m.start(), rule, m.end())
        for rule, (pattern, group, least) in enumerate(BASE)
        for m in pattern.finditer(text)
        if len(m.group(group)) >= least
    )


PIECES = (
    ["token", "pass", "password", "secret", "api_key", "apikey", "API", "AKIA", "KIA", "A", '="', ": ", "=", ":", " ", "'"]
    + ["abcdef", "0123456789abcdef", "é", "f" * 9, "X", "_", "-", "Q1", "deadbeef", "TOKEN", "ſecret", "\n", "e", "漢"]
)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=30).map("".join))
def test_base_spans_equal_regular_expressions(text):
    assert [s for s in SCANNER.spans(text) if s[1] < 3] == plain(text)


@settings(max_examples=200, deadline=None)
@given(st.sampled_from(["ab*c|a+", "(a|bc)?d{2,3}", "[a-c]{2,}x", "a{3}", "(ab|a)(c|bcd)"]), st.text("abcdx", max_size=12))
def test_automata_accept_what_the_expression_matches(pattern, text):
    automaton = automata.compile_rules([automata.parse(pattern)], anywhere=False)
    back = automata.compile_rules([automata.parse(pattern)], anywhere=False, backwards=True)
    for machine, data in ((automaton, text), (back, text[::-1])):
        state = 0
        for byte in data.encode():
            state = machine.rows[state][machine.classes[byte]]
        assert bool(machine.accepts[state]) == bool(text and re.fullmatch(pattern, text))


def test_query_equals_regular_expressions(spark):
    directory = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{directory}/documents.parquet").collect()}
    rows = queries.QUERIES["op4_secrets"](spark, directory).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = plain(texts[r.doc_id])
        line = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in want)
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(r.spans.split(","))


def test_more_rules_add_spans():
    text = "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a1B2" * 10
    assert [SCANNER.rules[r].kind for _, r, _ in SCANNER.spans(text)] == ["private_key", "code_host"]


def test_edge_cases(edge_docs, no_docs):
    rows = secrets.secret_spans(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    of = {r.doc_id: r for r in rows}
    assert (of[13].n_assign, of[13].n_access, of[13].n_hex) == (1, 1, 1)
    assert of[5].spans == "" and of[5].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert secrets.secret_spans(no_docs).count() == 0
