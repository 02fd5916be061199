"""Regular expressions as minimal deterministic automata over bytes.

Expressions have literals, classes, groups, alternatives and the quantifiers ``? * + {n} {n,} {n,m}``; bytes of
UTF-8 beyond ASCII only occur outside the rules. Thompson's construction gives a non-deterministic automaton, subset
construction a deterministic one, and partition refinement the minimal one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

Charset = frozenset[int]


@dataclass
class Fragments:
    """A non-deterministic automaton that grows by fragments (start, end)."""

    moves: list[list[tuple[Charset, int]]] = field(default_factory=list)
    free: list[list[int]] = field(default_factory=list)

    def state(self) -> int:
        self.moves.append([])
        self.free.append([])
        return len(self.moves) - 1

    def literal(self, chars: Charset) -> tuple[int, int]:
        a, b = self.state(), self.state()
        self.moves[a].append((chars, b))
        return a, b


# ---- expressions: ("set", chars) | ("cat", parts) | ("alt", parts) | ("rep", part, low, high or None) ---------


def _both_cases(chars: Charset) -> Charset:
    text = bytes(chars)
    return frozenset(text.lower() + text.upper())


class _Reader:
    def __init__(self, pattern: str, ignore_case: bool) -> None:
        self.pattern, self.at, self.ignore_case = pattern, 0, ignore_case

    def peek(self) -> str:
        return self.pattern[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.pattern[self.at - 1]

    def char(self) -> int:
        c = self.take()
        if c != "\\":
            return ord(c)
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.pattern[self.at - 2 : self.at], 16)
        return ord(c)

    def chars(self) -> Charset:
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.pattern[self.at + 1] != "]":
                self.take()
                high = self.char()
            found.update(range(low, high + 1))
        self.take()
        return frozenset(found)

    def either(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return ("alt", parts) if len(parts) > 1 else parts[0]

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            if self.peek() == "(":
                self.take()
                part = self.either()
                self.take()
            else:
                if self.peek() == "[":
                    self.take()
                    chars = self.chars()
                else:
                    chars = frozenset([self.char()])
                part = ("set", _both_cases(chars) if self.ignore_case else chars)
            parts.append(self.repeated(part))
        return ("cat", parts)

    def repeated(self, part):
        bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}
        if self.peek() in bounds and self.peek():
            return ("rep", part, *bounds[self.take()])
        if self.peek() == "{":
            end = self.pattern.index("}", self.at)
            low, comma, high = self.pattern[self.at + 1 : end].partition(",")
            self.at = end + 1
            return ("rep", part, int(low), int(high) if high else None if comma else int(low))
        return part


def parse(pattern: str, ignore_case: bool = False):
    return _Reader(pattern, ignore_case).either()


def _build(nfa: Fragments, node, backwards: bool) -> tuple[int, int]:
    kind = node[0]
    if kind == "set":
        return nfa.literal(node[1])
    if kind == "alt":
        a, b = nfa.state(), nfa.state()
        for part in node[1]:
            start, end = _build(nfa, part, backwards)
            nfa.free[a].append(start)
            nfa.free[end].append(b)
        return a, b
    if kind == "cat":
        a = at = nfa.state()
        for part in reversed(node[1]) if backwards else node[1]:
            start, end = _build(nfa, part, backwards)
            nfa.free[at].append(start)
            at = end
        return a, at
    _, part, low, high = node
    a = at = nfa.state()
    for _ in range(low if high is not None or low == 0 else low - 1):
        start, end = _build(nfa, part, backwards)
        nfa.free[at].append(start)
        at = end
    out = nfa.state()
    if high is None:
        start, end = _build(nfa, part, backwards)
        nfa.free[at].append(start)
        nfa.free[end] += [start, out]
        if low == 0:
            nfa.free[at].append(out)
    else:
        nfa.free[at].append(out)
        for _ in range(high - low):
            start, end = _build(nfa, part, backwards)
            nfa.free[at].append(start)
            nfa.free[end].append(out)
            at = end
    return a, out


# ---- deterministic automata ---------------------------------------------------------------------------------


@dataclass
class Automaton:
    """``rows[state][classes[byte]]`` is the next state; ``accepts[state]`` the rules that end there, ascending.

    Bytes of one class move all states alike. State 0 is the start, ``dead`` one without a way out, or -1. States
    from ``first_accepting`` on accept.
    """

    classes: bytes
    rows: list[list[int]]
    accepts: list[tuple[int, ...]]
    dead: int
    first_accepting: int


def compile_rules(nodes: list, anywhere: bool, backwards: bool = False) -> Automaton:
    """One automaton for all rules; with ``anywhere`` a match may begin at any byte."""
    nfa = Fragments()
    start = nfa.state()
    ends = {}
    for rule, node in enumerate(nodes):
        a, b = _build(nfa, node, backwards)
        nfa.free[start].append(a)
        ends[b] = rule

    def closure(states: set[int]) -> frozenset[int]:
        todo, seen = list(states), set(states)
        while todo:
            for t in nfa.free[todo.pop()]:
                if t not in seen:
                    seen.add(t)
                    todo.append(t)
        return frozenset(s for s in seen if nfa.moves[s] or s in ends)

    charsets = list({chars for moves in nfa.moves for chars, _ in moves})
    kinds: dict[tuple[bool, ...], int] = {}
    classes = bytes(kinds.setdefault(tuple(c in chars for chars in charsets), len(kinds)) for c in range(256))
    examples = [classes.index(k) for k in range(len(kinds))]
    begin = closure({start})
    numbers, queue = {begin: 0}, [begin]
    rows: list[list[int]] = []
    for subset in queue:  # subset construction
        moves = [move for s in subset for move in nfa.moves[s]]
        row = []
        for c in examples:
            target = closure({t for chars, t in moves if c in chars})
            after = target | begin if anywhere else target
            if after not in numbers:
                numbers[after] = len(numbers)
                queue.append(after)
            row.append(numbers[after])
        rows.append(row)
    accepts = [tuple(sorted(ends[s] for s in subset if s in ends)) for subset in queue]
    return _minimal(classes, rows, accepts)


def _minimal(classes: bytes, rows: list[list[int]], accepts: list[tuple[int, ...]]) -> Automaton:
    """Merges states that no continuation tells apart."""
    kinds = {a: i for i, a in enumerate(dict.fromkeys(accepts))}
    block = [kinds[a] for a in accepts]
    while True:
        numbers: dict[tuple, int] = {}
        refined = [numbers.setdefault((b, *(block[t] for t in row)), len(numbers)) for b, row in zip(block, rows)]
        if len(numbers) == len(set(block)):
            break
        block = refined
    member = {b: s for s, b in reversed(list(enumerate(block)))}
    # the start first (unless it accepts), then the others, accepting ones last
    order = sorted(member, key=lambda b: (bool(accepts[member[b]]), b != block[0], member[b]))
    number = {b: i for i, b in enumerate(order)}
    if number[block[0]] != 0:
        raise ValueError("a rule matches the empty string")
    new_rows = [[number[block[t]] for t in rows[member[b]]] for b in order]
    new_accepts = [accepts[member[b]] for b in order]
    first = next((i for i, a in enumerate(new_accepts) if a), len(order))
    dead = next((i for i in range(first) if all(t == i for t in new_rows[i])), -1)
    return Automaton(classes, new_rows, new_accepts, dead, first)
