"""Regular expressions as one minimal deterministic automaton over bytes.

Supported syntax: literals, ``\\xNN`` and escaped characters, ``[...]`` classes with ranges (ASCII),
groups, ``|``, ``? * +``, ``{m}``, ``{m,}``, ``{m,n}``, and ``(?i:...)`` for letters in either case.
"""

from __future__ import annotations

import string
from collections import defaultdict
from dataclasses import dataclass

# A node of a parsed expression: ("set", bytes), ("seq", nodes), ("alt", nodes), ("loop", node, least, most or None)
Node = tuple


class _Parser:
    def __init__(self, pattern: str) -> None:
        self.text, self.at, self.fold = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self, token: str = "") -> str:
        found = self.text[self.at : self.at + max(1, len(token))]
        if not found or (token and found != token):
            raise ValueError(f"{self.text!r}: expected {token or 'more'} at {self.at}")
        self.at += len(found)
        return found

    def whole(self) -> Node:
        node = self.choice()
        if self.peek():
            raise ValueError(f"{self.text!r}: unexpected {self.peek()!r} at {self.at}")
        return node

    def choice(self) -> Node:
        nodes = [self.sequence()]
        while self.peek() == "|":
            self.take()
            nodes.append(self.sequence())
        return nodes[0] if len(nodes) == 1 else ("alt", nodes)

    def sequence(self) -> Node:
        nodes = []
        while self.peek() not in ("", "|", ")"):
            nodes.append(self.repeated())
        return ("seq", nodes)

    def repeated(self) -> Node:
        node = self.atom()
        while (sign := self.peek()) and sign in "?*+{":
            self.take()
            if sign == "{":
                bounds = ""
                while self.peek() != "}":
                    bounds += self.take()
                self.take("}")
                low, comma, high = bounds.partition(",")
                node = ("loop", node, int(low), int(high) if high else None if comma else int(low))
            else:
                node = ("loop", node, int(sign == "+"), 1 if sign == "?" else None)
        return node

    def letter(self) -> int:
        char = self.take()
        if char == "\\":
            char = self.take()
            if char == "x":
                return int(self.take() + self.take(), 16)
        return ord(char)

    def folded(self, codes: set[int]) -> Node:
        if self.fold:
            for code in list(codes):
                if chr(code) in string.ascii_letters:
                    codes.add(ord(chr(code).swapcase()))
        return ("set", frozenset(codes))

    def atom(self) -> Node:
        if self.peek() == "(":
            self.take()
            before = self.fold
            if self.peek() == "?":
                self.take("?")
                self.fold |= self.take() == "i"
                if self.take() != ":":
                    self.take(":")
            node = self.choice()
            self.take(")")
            self.fold = before
            return node
        if self.peek() == "[":
            self.take()
            codes: set[int] = set()
            while self.peek() != "]":
                first = self.letter()
                if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                    self.take()
                    codes.update(range(first, self.letter() + 1))
                else:
                    codes.add(first)
            self.take("]")
            return self.folded(codes)
        code = self.letter()
        if code > 127:
            return ("seq", [("set", frozenset({b})) for b in chr(code).encode()])
        return self.folded({code})


def parse(pattern: str) -> Node:
    return _Parser(pattern).whole()


def reverse(node: Node) -> Node:
    """The expression that matches the same texts read backwards."""
    kind = node[0]
    if kind == "seq":
        return ("seq", [reverse(x) for x in reversed(node[1])])
    if kind == "alt":
        return ("alt", [reverse(x) for x in node[1]])
    if kind == "loop":
        return ("loop", reverse(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self) -> None:
        self.empty: dict[int, list[int]] = defaultdict(list)
        self.steps: dict[int, tuple[frozenset[int], int]] = {}
        self.size = 0

    def new(self) -> int:
        self.size += 1
        return self.size - 1

    def add(self, node: Node, start: int) -> int:
        """Wire ``node`` in behind ``start``; the state behind it."""
        kind = node[0]
        if kind == "set":
            inner, end = self.new(), self.new()
            self.empty[start].append(inner)
            self.steps[inner] = (node[1], end)
            return end
        if kind == "seq":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if kind == "alt":
            end = self.new()
            for part in node[1]:
                self.empty[self.add(part, start)].append(end)
            return end
        _, inner, low, high = node
        for _ in range(low):
            start = self.add(inner, start)
        if high is None:
            loop = self.new()
            self.empty[start].append(loop)
            self.empty[self.add(inner, loop)].append(loop)
            return loop
        end = self.new()
        for _ in range(high - low):
            self.empty[start].append(end)
            start = self.add(inner, start)
        self.empty[start].append(end)
        return end

    def closure(self, states: frozenset[int]) -> frozenset[int]:
        seen, todo = set(states), list(states)
        while todo:
            for to in self.empty.get(todo.pop(), ()):
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
        return frozenset(seen)


@dataclass(frozen=True)
class Automaton:
    """``next[state + byte]`` is the next state, times 256; ``accepts[state >> 8]`` the rules that match there.

    States are ordered: those below ``quiet`` accept nothing. State 0 is the start. ``dead`` is the
    state no match leaves (-1 if there is none).
    """

    next: list[int]
    accepts: tuple[tuple[int, ...], ...]
    quiet: int
    dead: int

    @property
    def states(self) -> int:
        return len(self.accepts)


def _subsets(nodes: list[Node], anywhere: bool) -> tuple[list[list[int]], list[frozenset[int]]]:
    nfa = _Nfa()
    root = nfa.new()
    ends = {}
    for rule, node in enumerate(nodes):
        ends[nfa.add(node, root)] = rule
    start = nfa.closure(frozenset({root}))
    ids, rows, labels, todo = {start: 0}, [], [], [start]
    known: dict[frozenset[int], int] = {}
    for states in todo:
        by_byte: list[set[int]] = [set() for _ in range(256)]
        for state in states:
            if state in nfa.steps:
                codes, to = nfa.steps[state]
                for code in codes:
                    by_byte[code].add(to)
        row = []
        for reached in map(frozenset, by_byte):
            if reached not in known:
                after = nfa.closure(reached) | (start if anywhere else frozenset())
                if after not in ids:
                    ids[after] = len(ids)
                    todo.append(after)
                known[reached] = ids[after]
            row.append(known[reached])
        rows.append(row)
        labels.append(frozenset(ends[s] for s in states if s in ends))
    return rows, labels


def _minimal(rows: list[list[int]], labels: list[frozenset[int]]) -> list[int]:
    """The class of each state once equal ones are merged (partition refinement)."""
    kinds = {label: i for i, label in enumerate(dict.fromkeys(labels))}
    block = [kinds[label] for label in labels]
    while True:
        keys = [(block[s], *[block[t] for t in row]) for s, row in enumerate(rows)]
        names = {key: i for i, key in enumerate(dict.fromkeys(keys))}
        refined = [names[key] for key in keys]
        if len(names) == len(set(block)):
            return refined
        block = refined


def compile_rules(nodes: list[Node], anywhere: bool) -> Automaton:
    """Subset construction and minimisation of the union of ``nodes``; each is one rule.

    ``anywhere``: a match may begin at any byte; else at the first only.
    """
    rows, labels = _subsets(nodes, anywhere)
    block = _minimal(rows, labels)
    members: dict[int, int] = {}
    for state, kind in enumerate(block):
        members.setdefault(kind, state)
    # the start first, then quiet states, then accepting ones
    order = sorted(members, key=lambda k: (bool(labels[members[k]]), k != block[0], k))
    if labels[0]:
        raise ValueError("a rule matches the empty text")
    place = {kind: i for i, kind in enumerate(order)}
    numbers = [i << 8 for i in range(len(order))]  # one object per state; a plain list reads faster than packed ints
    table: list[int] = []
    for kind in order:
        table.extend(numbers[place[block[t]]] for t in rows[members[kind]])
    accepts = tuple(tuple(sorted(labels[members[k]])) for k in order)
    quiet = sum(not a for a in accepts) << 8
    dead = next(
        (i << 8 for i, a in enumerate(accepts) if not a and all(t == i << 8 for t in table[i << 8 : (i + 1) << 8])), -1
    )
    return Automaton(table, accepts, quiet, dead)
