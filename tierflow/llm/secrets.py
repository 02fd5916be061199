"""Secret scanning with one deterministic automaton for all rules.

The rules' expressions become one minimal automaton that reads each byte of a text once and reports where a match of
any rule ends. Only there a rule's own automata find the leftmost start, running backwards, and the farthest end.
Matches of a rule do not overlap; those that fail the rule's length test are dropped, but use up their bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame

from . import automata


@dataclass(frozen=True)
class Rule:
    """``group`` of a match (0: all of it) has at least ``least`` characters; ``base`` rules are counted."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    ignore_case: bool = False
    base: bool = False


# The base rules in the order of their kinds, then forms of well-known credentials. Shorter hex runs
# than 24 never count, so the automaton only reports those that do.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        least=6,
        group=2,
        ignore_case=True,
        base=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20, base=True),
    Rule("hex", r"[0-9a-f]{24,}", least=24, base=True),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", least=1),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", least=40),
)


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES) -> None:
        self.rules = rules
        nodes = [automata.parse(r.pattern, r.ignore_case) for r in rules]
        self.all = automata.compile_rules(nodes, anywhere=True)
        self.ahead = [automata.compile_rules([n], anywhere=False) for n in nodes]
        self.back = [automata.compile_rules([n], anywhere=False, backwards=True) for n in nodes]
        self.tests = [re.compile(r.pattern, re.IGNORECASE | re.ASCII if r.ignore_case else re.ASCII) for r in rules]

    def scan(self, data: bytes) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches in bytes, sorted."""
        found: list[tuple[int, int, int]] = []
        ends = [0] * len(self.rules)
        rows, accepts, first = self.all.rows, self.all.accepts, self.all.first_accepting
        view = memoryview(data)
        state = at = 0
        for kind in data.translate(self.all.classes):
            state = rows[state][kind]
            at += 1
            if state >= first:
                for rule in accepts[state]:
                    if at > ends[rule]:
                        start = self._farthest(self.back[rule], reversed(view[ends[rule] : at]))
                        if start:
                            start = at - start
                            ends[rule] = end = start + self._farthest(self.ahead[rule], view[start:])
                            if self._passes(rule, data[start:end]):
                                found.append((start, rule, end))
        return sorted(found)

    @staticmethod
    def _farthest(automaton: automata.Automaton, data: Iterable[int]) -> int:
        """How many bytes the longest match from the beginning takes; 0 for none."""
        state = best = 0
        for n, byte in enumerate(data, 1):
            state = automaton.rows[state][automaton.classes[byte]]
            if state >= automaton.first_accepting:
                best = n
            elif state == automaton.dead:
                break
        return best

    def _passes(self, rule: int, match: bytes) -> bool:
        group = self.rules[rule].group
        if group == 0:
            return len(match) >= self.rules[rule].least
        return len(self.tests[rule].fullmatch(match.decode("ascii")).group(group)) >= self.rules[rule].least

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule, end) of all matches in code points, sorted."""
        data = text.encode("utf-8", "surrogatepass")
        found = self.scan(data)
        if len(data) == len(text):
            return found
        out = []
        done = chars = 0
        for start, rule, end in found:  # matches are ASCII
            chars += len(data[done:start].decode("utf-8", "surrogatepass"))
            done = start
            out.append((chars, rule, chars + end - start))
        return out


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """``id_col``, a count for each base kind, ``base_sha256`` and ``spans`` of every row's whole text.

    A span is ``kind:start:end`` in code points, end exclusive; spans are sorted by start, then by the order of the
    rules, and joined by commas. ``base_sha256`` is the digest of the base spans alone, joined likewise. A null
    text counts as empty; rows without a secret have counts of 0 and no spans; a null id is kept; repeated rows are
    scanned one by one; other columns are not looked at; an empty table gives an empty result.
    """
    base = [i for i, r in enumerate(rules) if r.base]
    names = [id_col, *(f"n_{rules[i].kind}" for i in base), "base_sha256", "spans"]
    kinds = [docs.schema[id_col].dataType.simpleString(), *["long"] * len(base), "string", "string"]

    shared = docs.sparkSession.sparkContext.broadcast(Scanner(rules))  # its size depends on the rules alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = shared.value
        for batch in batches:
            counts: list[list[int]] = [[] for _ in base]
            digests, every = [], []
            for text in batch.column(1):
                spans = scanner.spans(text.as_py() or "")
                shown = [f"{rules[r].kind}:{start}:{end}" for start, r, end in spans]
                for column, i in zip(counts, base):
                    column.append(sum(r == i for _, r, _ in spans))
                main = ",".join(s for s, (_, r, _) in zip(shown, spans) if rules[r].base)
                digests.append(sha256(main.encode()).hexdigest())
                every.append(",".join(shown))
            columns = [batch.column(0), *(pa.array(c, pa.int64()) for c in counts)]
            columns += [pa.array(digests, pa.string()), pa.array(every, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(id_col, text_col).mapInArrow(run, ", ".join(f"`{n}` {k}" for n, k in zip(names, kinds)))
