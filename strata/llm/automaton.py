"""Regular expressions over bytes, many of them compiled into one minimal deterministic automaton.

The dialect: ASCII literals, ``\\xHH`` and escaped signs, ``\\d``, ``\\w`` and ``\\s`` (ASCII), classes with ranges
and ``^`` (which takes in every byte from 128 on), ``( )``, ``(?: )``, ``(?i: )``, ``|``, ``* + ? {m} {m,} {m,n}``.

An expression becomes a position automaton: one state per place in it, no empty moves. The subset
construction runs over all rules at once. Within one rule a subset keeps its runs apart by where they
began, earliest first: a run that reaches a match cuts off those that began after it, as they overlap it,
and no run begins while a matched one lives. So the states themselves follow the rule of leftmost matches
that do not overlap, and one pass needs no second look at the text. Merging equal states (partition
refinement) and equal bytes then makes the transition array small.

A rule must be such that a match is extended byte by byte (a run that has matched either matches again
with the next byte or ends), that only the earliest run can match, and that a match has two bytes or
more; ``compile_rules`` raises ValueError otherwise.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Hashable
from dataclasses import dataclass

import numpy as np

_WORD = frozenset(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_")
_NAMED = {"d": frozenset(b"0123456789"), "w": _WORD, "s": frozenset(b" \t\n\r\x0b\x0c")}
_SIGNS = {"t": b"\t", "n": b"\n", "r": b"\r"}


class Parser:
    """Recursive descent; a tree is ("set", bytes), ("cat", trees), ("or", trees) or ("rep", tree, least, most)."""

    def __init__(self, pattern: str):
        self.text, self.at, self.folded = pattern, 0, False

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self, sign: str) -> bool:
        if found := self.text.startswith(sign, self.at):
            self.at += len(sign)
        return found

    def tree(self):
        tree = self.choice()
        if self.at < len(self.text):
            raise ValueError(f"cannot read {self.text!r} at {self.at}")
        return tree

    def choice(self):
        ways = [self.sequence()]
        while self.take("|"):
            ways.append(self.sequence())
        return ways[0] if len(ways) == 1 else ("or", ways)

    def sequence(self):
        items = []
        while self.peek() and self.peek() not in "|)":
            items.append(self.repeated())
        return ("cat", items)

    def repeated(self):
        item = self.atom()
        while self.peek() and self.peek() in "*+?{":
            sign = self.text[self.at]
            self.at += 1
            if sign == "{":
                end = self.text.index("}", self.at)
                least, comma, most = self.text[self.at : end].partition(",")
                self.at = end + 1
                item = ("rep", item, int(least), (int(most) if most else None) if comma else int(least))
            else:
                item = ("rep", item, int(sign == "+"), 1 if sign == "?" else None)
        return item

    def atom(self):
        if self.take("("):
            before = self.folded
            if self.take("?i:"):
                self.folded = True
            else:
                self.take("?:")
            inner = self.choice()
            if not self.take(")"):
                raise ValueError(f"no closing bracket in {self.text!r}")
            self.folded = before
            return inner
        return ("set", self.fold(self.klass() if self.take("[") else self.sign()))

    def fold(self, those: frozenset[int]) -> frozenset[int]:
        return those | set(bytes(those).swapcase()) if self.folded else those

    def sign(self) -> frozenset[int]:
        sign = self.text[self.at]
        self.at += 1
        if sign != "\\":
            if sign in ".^$*+?{" or ord(sign) > 127:
                raise ValueError(f"{sign!r} has no meaning here in {self.text!r}")
            return frozenset(sign.encode())
        sign = self.text[self.at]
        self.at += 1
        if sign == "x":
            self.at += 2
            return frozenset([int(self.text[self.at - 2 : self.at], 16)])
        return _NAMED.get(sign) or frozenset(_SIGNS.get(sign, sign.encode()))

    def klass(self) -> frozenset[int]:
        other, those = self.take("^"), set()
        while not self.take("]"):
            if self.peek() and self.peek() in ".^$*+?{":
                first = frozenset(self.peek().encode())
                self.at += 1
            else:
                first = self.sign()
            if self.peek() == "-" and self.text[self.at + 1 : self.at + 2] != "]":
                self.at += 1
                first = range(min(first), max(self.sign()) + 1)
            those.update(first)
        return frozenset(range(256)) - those if other else frozenset(those)


class Positions:
    """The position automaton of one or more expressions."""

    def __init__(self):
        self.sets: list[frozenset[int]] = []
        self.follow: list[set[int]] = []

    def add(self, tree) -> tuple[bool, set[int], set[int]]:
        """(may be empty, first positions, last positions) of a tree, after linking its positions."""
        kind, body = tree[:2]
        if kind == "set":
            self.sets.append(body)
            self.follow.append(set())
            return False, {len(self.sets) - 1}, {len(self.sets) - 1}
        if kind == "or":
            ways = [self.add(way) for way in body]
            return any(w[0] for w in ways), set().union(*(w[1] for w in ways)), set().union(*(w[2] for w in ways))
        if kind == "cat":
            return self.chain([self.add(item) for item in body])
        least, most = tree[2:]
        copies = [self.add(body) for _ in range(max(least, 1) if most is None else most)]
        if most is None:
            for p in copies[-1][2]:
                self.follow[p] |= copies[-1][1]
        return self.chain([(empty or i >= least, f, l) for i, (empty, f, l) in enumerate(copies)])

    def chain(self, items) -> tuple[bool, set[int], set[int]]:
        empty, first, last = True, set(), set()
        for may_skip, start, end in items:
            for p in last:
                self.follow[p] |= start
            first = first | start if empty else first
            last = last | end if may_skip else set(end)
            empty = empty and may_skip
        return empty, first, last


@dataclass(frozen=True)
class Table:
    """Transitions by state and class of byte; state 0 is the start, ``marks`` has the output of each state."""

    classes: np.ndarray
    moves: np.ndarray
    marks: tuple

    def rows(self) -> list:
        """State 0 as a list: entries 0 to 255 are the lists of the next states, entry 256 the output."""
        rows = [[None] * 257 for _ in self.marks]
        for row, to, mark in zip(rows, self.moves[:, self.classes].tolist(), self.marks):
            row[:256] = [rows[state] for state in to]
            row[256] = mark
        return rows[0]


def tabulate(
    sets: list[frozenset[int]], start: Hashable, step: Callable[[Hashable, int], Hashable],
    mark: Callable[[Hashable], object], most: int = 100_000,
) -> Table:
    """Subset construction from ``start`` by ``step(state, byte)``, then merging of equal states."""
    kinds: dict[tuple, int] = {}
    classes = np.array([kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256)])
    samples = [int(np.flatnonzero(classes == k)[0]) for k in range(len(kinds))]
    known, order, moves = {start: 0}, [start], []
    for state in order:  # grows while it runs
        line = []
        for byte in samples:
            to = step(state, byte)
            if to not in known:
                if len(order) >= most:
                    raise ValueError(f"more than {most} states")
                known[to] = len(order)
                order.append(to)
            line.append(known[to])
        moves.append(line)
    return minimise(classes, np.array(moves), [mark(state) for state in order])


def minimise(classes: np.ndarray, moves: np.ndarray, marks: list) -> Table:
    """Partition refinement: states are one if they have one output and lead to the same parts."""
    outputs: dict = {}
    part = np.array([outputs.setdefault(m, len(outputs)) for m in marks])
    while True:
        _, first, finer = np.unique(np.column_stack([part, part[moves]]), axis=0, return_index=True, return_inverse=True)
        finer = finer.ravel()
        if len(first) == part.max() + 1:
            break
        part = finer
    # The start comes first.
    rank = np.argsort(np.argsort(first, kind="stable"), kind="stable")
    states = np.sort(first)
    return Table(classes, rank[finer][moves[states]].astype(np.int32), tuple(marks[i] for i in states))


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds a match; it counts if it has ``least`` bytes and ``keep``, if given, fits all of it.

    Counting in the automaton multiplies its states, so lengths of the whole match belong in ``least``.
    """

    kind: str
    pattern: str
    keep: str | None = None
    least: int = 0


@dataclass(frozen=True)
class Scanner:
    """``forward`` marks, per state, the rules with a match that ends there and whether it counts;
    ``back[r]`` reads a match of rule ``r`` from its end and marks where it may begin."""

    rules: tuple[Rule, ...]
    forward: Table
    back: tuple[Table, ...]


class _Runs:
    """One rule's part of the combined subset construction."""

    def __init__(self, rule: Rule):
        self.rule, places = rule, Positions()
        empty, first, match = places.add(Parser(rule.pattern).tree())
        counts = match
        if rule.keep is not None:
            _, more, counts = places.add(Parser(rule.keep).tree())
            first = first | more
        if empty or first & match:
            raise ValueError(f"a match of {rule.kind} must have two bytes or more")
        self.sets, self.first = places.sets, frozenset(first)
        self.match, self.counts, self.follow = frozenset(match), frozenset(counts), places.follow

    def step(self, runs: tuple[frozenset, ...], byte: int) -> tuple[frozenset, ...]:
        out, seen = [], set()
        for run in (*runs, None):
            ahead = self.first if run is None else set().union(*(self.follow[p] for p in run))
            now = frozenset(p for p in ahead if byte in self.sets[p]) - seen
            matched = bool(now & self.match)
            if run is not None and run & self.match and now and not matched:
                raise ValueError(f"a match of {self.rule.kind} is not extended byte by byte")
            if not now:
                continue
            out.append(now)
            seen |= now
            if matched:
                if len(out) > 1:
                    raise ValueError(f"a later run of {self.rule.kind} can match before an earlier one")
                break
        return tuple(out)

    def mark(self, runs: tuple[frozenset, ...]) -> bool | None:
        """None without a match, else whether it counts."""
        return bool(runs[0] & self.counts) if runs and runs[0] & self.match else None

    def back(self) -> Table:
        places = Positions()
        _, first, last = places.add(Parser(self.rule.pattern).tree())
        before: list[set[int]] = [set() for _ in places.sets]
        for p, after in enumerate(places.follow):
            for q in after:
                before[q].add(p)

        def step(state, byte):
            ahead = last if state is None else set().union(*(before[p] for p in state))
            return frozenset(p for p in ahead if byte in places.sets[p])

        # 2 where a match may begin, 1 while one may still be found, 0 at the dead end.
        return tabulate(places.sets, None, step, lambda s: 1 if s is None else 2 if s & first else int(bool(s)))


@functools.lru_cache
def compile_rules(rules: tuple[Rule, ...]) -> Scanner:
    parts = [_Runs(rule) for rule in rules]

    def mark(state):
        found = [(r, part.mark(runs)) for r, (part, runs) in enumerate(zip(parts, state))]
        return tuple((r, counts) for r, counts in found if counts is not None)

    forward = tabulate(
        [s for part in parts for s in part.sets],
        tuple(() for _ in parts),
        lambda state, byte: tuple(part.step(runs, byte) for part, runs in zip(parts, state)),
        mark,
    )
    return Scanner(rules, forward, tuple(part.back() for part in parts))


def finder(scanner: Scanner) -> Callable[[bytes], list[tuple[int, int, int]]]:
    """A function from bytes to the (rule, start, end) that count, in the order of their ends."""
    forward, back = scanner.forward.rows(), [table.rows() for table in scanner.back]
    none = [-2] * len(scanner.rules)
    least = [rule.least for rule in scanner.rules]

    def find(data: bytes) -> list[tuple[int, int, int]]:
        found: list[tuple[int, int, int]] = []
        last, floor, good = none.copy(), [0] * len(none), [False] * len(none)

        def close(rule: int) -> None:
            end = last[rule] + 1
            if good[rule]:
                row, begin = back[rule], end
                for at in range(end - 1, floor[rule] - 1, -1):
                    row = row[data[at]]
                    if not row[256]:
                        break
                    if row[256] == 2:
                        begin = at
                if end - begin >= least[rule]:
                    found.append((rule, begin, end))
            floor[rule] = end

        row = forward
        for at, byte in enumerate(data):
            row = row[byte]
            if row[256]:
                for rule, counts in row[256]:
                    if last[rule] >= 0 and last[rule] != at - 1:
                        close(rule)
                    last[rule], good[rule] = at, counts
        for rule, end in enumerate(last):
            if end >= 0:
                close(rule)
        return found

    return find
