"""Probabilistic automata inferred from example strings by state merging.

A prefix tree of the examples is folded in two passes. States of one depth are
merged when their stopping and branching frequencies, and those of everything
below them, agree within the Hoeffding bound; few examples agree with anything
there, so that every depth keeps a few states with many examples each. Then
states of different depth are merged by the same test, which has those counts
to decide by: a format of fixed length or with a prefix keeps both, as states
with other lengths before them differ in where they stop, and a repeating part
of any length becomes a loop. States with too few examples for the test to
tell anything stay apart. What is left is a small automaton with counted
transitions, which gives the likelihood of any string.
"""

from __future__ import annotations

from math import log, sqrt

#: classes of credential characters: one symbol each
_CLASS = {**{c: "9" for c in "0123456789"}, **{c: "x" for c in "abcdef"}, **{c: "l" for c in "ghijklmnopqrstuvwxyz"},
          **{c: "X" for c in "ABCDEF"}, **{c: "U" for c in "GHIJKLMNOPQRSTUVWXYZ"}}
CLASSES = str.maketrans(_CLASS)
_FEW = 8  # passes that tell nothing yet about where strings end
SYMBOLS = 5 + 6  # the classes above and the characters + / _ . = - kept as they are


class Automaton:
    """States with counts: strings that pass, strings that stop, and a counted successor per symbol."""

    def __init__(self, alpha: float = 0.05, least: int = 20):
        self.alpha, self.least = alpha, least
        self.passed: list[int] = []
        self.stopped: list[int] = []
        self.next: list[dict[str, int]] = []
        self.count: list[dict[str, int]] = []

    def _state(self) -> int:
        for column, v in ((self.passed, 0), (self.stopped, 0), (self.next, {}), (self.count, {})):
            column.append(v)
        return len(self.passed) - 1

    def _tree(self, strings: list[str]) -> None:
        self._state()
        for s in strings:
            q = 0
            self.passed[0] += 1
            for c in s:
                self.count[q][c] = self.count[q].get(c, 0) + 1
                q = self.next[q].setdefault(c, None) if self.next[q].get(c) is not None else self._child(q, c)
                self.passed[q] += 1
            self.stopped[q] += 1

    def _child(self, q: int, c: str) -> int:
        self.next[q][c] = self._state()
        return self.next[q][c]

    def _differ(self, f1: int, n1: int, f2: int, n2: int) -> bool:
        bound = sqrt(log(2 / self.alpha) / 2) * (1 / sqrt(n1) + 1 / sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def _compatible(self, a: int, b: int) -> bool:
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            n1, n2 = self.passed[a], self.passed[b]
            if self._differ(self.stopped[a], n1, self.stopped[b], n2):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._differ(self.count[a].get(c, 0), n1, self.count[b].get(c, 0), n2):
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree of b to a; b is a tree, so this ends."""
        todo = [(a, b)]
        while todo:
            a, b = todo.pop()
            self.passed[a] += self.passed[b]
            self.stopped[a] += self.stopped[b]
            for c, q in self.next[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + self.count[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], q))
                else:
                    self.next[a][c] = q

    def _by_depth(self) -> list[int]:
        """Merge compatible states of one depth, from the root on; the states left, by depth."""
        layer, kept = [0], [0]
        while layer:
            edges = sorted(((q, c) for q in layer for c in self.next[q]), key=lambda x: (-self.passed[self.next[x[0]][x[1]]], x))
            layer = []
            for q, c in edges:
                new = self.next[q][c]
                old = next((k for k in layer if self._compatible(k, new)), None)
                if old is None:
                    layer.append(new)
                else:
                    self.next[q][c] = old
                    self._fold(old, new)
            kept += layer
        return kept

    def _alike(self, a: int, b: int, of: dict[int, int]) -> bool:
        """Whether two classes, and those that follow them on equal symbols, are compatible; loops are met once."""
        todo, met = [(a, b)], set()
        while todo:
            a, b = (of[x] for x in todo.pop())
            if a == b or (a, b) in met:
                continue
            met.add((a, b))
            n1, n2 = self.passed[a], self.passed[b]
            if self._differ(self.stopped[a], n1, self.stopped[b], n2):
                return False
            for c in self.count[a].keys() | self.count[b].keys():
                if self._differ(self.count[a].get(c, 0), n1, self.count[b].get(c, 0), n2):
                    return False
            todo += [(self.next[a][c], self.next[b][c]) for c in self.next[a].keys() & self.next[b].keys()]
        return True

    def _join(self, a: int, b: int, of: dict[int, int]) -> None:
        """Make one class of a and b, and of what follows them on equal symbols; `of` maps states to their class."""
        todo = [(a, b)]
        while todo:
            a, b = sorted(of[x] for x in todo.pop())
            if a == b:
                continue
            for state, own in of.items():
                if own == b:
                    of[state] = a
            self.passed[a] += self.passed[b]
            self.stopped[a] += self.stopped[b]
            for c, q in self.next[b].items():
                self.count[a][c] = self.count[a].get(c, 0) + self.count[b][c]
                if c in self.next[a]:
                    todo.append((self.next[a][c], q))
                else:
                    self.next[a][c] = q

    def _across_depths(self, states: list[int]) -> list[int]:
        """Merge compatible states of different depth; the classes left, the root first."""
        rename = {q: i for i, q in enumerate(states)}  # by depth, so a class is named by its shallowest state
        for column in ("passed", "stopped", "count"):
            setattr(self, column, [getattr(self, column)[q] for q in states])
        self.next = [{c: rename[t] for c, t in self.next[q].items()} for q in states]
        of = {i: i for i in range(len(states))}
        kept: list[int] = []
        for q in range(len(states)):
            if of[q] != q:
                continue
            if self.passed[q] >= self.least:
                old = next((k for k in kept if of[k] == k and self.passed[k] >= self.least and self._alike(k, q, of)), None)
                if old is not None:
                    self._join(old, q, of)
                    continue
            kept.append(q)
        kept = [q for q in kept if of[q] == q]
        self.next = [{c: of[t] for c, t in self.next[q].items()} for q in range(len(states))]
        return kept

    def fit(self, strings: list[str]) -> Automaton:
        """Infer from examples (already in symbols)."""
        self._tree(sorted(strings))
        kept = self._across_depths(self._by_depth())
        place = {k: i for i, k in enumerate(kept)}
        self.passed = [self.passed[k] for k in kept]
        self.stopped = [self.stopped[k] for k in kept]
        self.count = [self.count[k] for k in kept]
        self.next = [{c: place[t] for c, t in self.next[k].items()} for k in kept]
        return self

    def may_end(self, string: str) -> bool:
        """Whether an example has ended in the state that the string ends in, or too few have passed there to tell."""
        q = 0
        for c in string:
            q = self.next[q].get(c, q)
        return self.stopped[q] > 0 or self.passed[q] < _FEW

    def log_likelihood(self, string: str, stops: bool = True) -> float:
        """Natural log of the probability of a string, or of all that begin with it; unseen symbols and stops get a small
        share (add-half)."""
        q, total = 0, 0.0
        for c in string:
            n = self.passed[q] + 0.5 * (SYMBOLS + 1)
            total += log((self.count[q].get(c, 0) + 0.5) / n)
            q = self.next[q].get(c, q)
        return total if not stops else total + log((self.stopped[q] + 0.5) / (self.passed[q] + 0.5 * (SYMBOLS + 1)))
