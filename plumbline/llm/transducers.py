"""Weighted transducers over word kinds: composed, then run over many clauses at once.

A transducer reads the kinds of a clause's words.  Each arc passes the word on; if the word is an
insult, the state it leads to marks it and multiplies its weight.  A clause is accepted with the
weight of the state it ends in.  Composition reads one machine's output with the next: states are
pairs, marks join, weights multiply.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

import numpy as np

KINDS = ("other", "target", "negation", "reported", "modal", "harm")
ANY = "*"


@dataclass(frozen=True)
class Transducer:
    """``arcs``: (state, kind or ANY) to state, no arc: rejected; ``marks``: state to (marks, factor); ``final``: weight of ending in a state, none: rejected."""

    start: tuple
    arcs: dict
    marks: dict
    final: dict

    def step(self, state, kind: str):
        return self.arcs.get((state, kind), self.arcs.get((state, ANY)))


def compose(a: Transducer, b: Transducer) -> Transducer:
    """The machine that reads with ``a`` and then, what it gives, with ``b``."""
    start = tuple(itertools.product(a.start, b.start))
    arcs, todo, seen = {}, list(start), set(start)
    while todo:
        x, y = todo.pop()
        for kind in KINDS:
            to = (a.step(x, kind), b.step(y, kind))
            if None not in to:
                arcs[(x, y), kind] = to
                if to not in seen:
                    seen.add(to)
                    todo.append(to)
    none = ("", 1.0)
    marks = {(x, y): (a.marks.get(x, none)[0] + b.marks.get(y, none)[0], a.marks.get(x, none)[1] * b.marks.get(y, none)[1]) for x, y in seen}
    final = {(x, y): a.final[x] * b.final[y] for x, y in seen if x in a.final and y in b.final}
    return Transducer(start, arcs, marks, final)


class Compiled:
    """A machine as arrays; state 0 rejects."""

    def __init__(self, m: Transducer):
        states = sorted({s for s, _ in m.arcs} | set(m.arcs.values()) | set(m.start), key=repr)
        number = {s: i + 1 for i, s in enumerate(states)}
        self.next = np.zeros((len(states) + 1, len(KINDS)), np.int32)
        for (s, kind), to in m.arcs.items():
            for k in range(len(KINDS)) if kind == ANY else [KINDS.index(kind)]:
                if kind != ANY or (s, KINDS[k]) not in m.arcs:
                    self.next[number[s], k] = number[to]
        self.factor = np.array([0.0, *(m.marks.get(s, ("", 1.0))[1] for s in states)])
        self.marks = ["", *(m.marks.get(s, ("", 1.0))[0] for s in states)]
        self.final = np.array([np.nan, *(m.final.get(s, np.nan) for s in states)])
        self.start = [number[s] for s in m.start]
        # after so many other words in a row, one more changes no state
        power, self.settled = np.arange(len(states) + 1), 0
        while not np.array_equal(self.next[power, 0], power) and self.settled < len(states):
            power, self.settled = self.next[power, 0], self.settled + 1

    def short(self, kinds: np.ndarray, weights: np.ndarray, clause: np.ndarray) -> np.ndarray:
        """Which words need reading: the others are plain words after ``settled`` plain words of their clause."""
        plain = (kinds == 0) & (weights == 0)
        place = np.arange(len(kinds))
        new = np.ones(len(kinds), bool)
        new[1:] = clause[1:] != clause[:-1]
        since = place - np.maximum.accumulate(np.where(~plain, place, np.where(new, place - 1, -1)))
        return ~plain | (since <= max(1, self.settled))

    def __call__(self, kinds: np.ndarray, weights: np.ndarray, clause: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """(weight, count of each mark) of each clause; ``clause`` numbers the words' clauses, in order.

        The weight is that of the insults, each by its factor, and of the end state, over all accepted ways.
        """
        read = self.short(kinds, weights, clause)
        kinds, weights, clause = kinds[read], weights[read], clause[read]
        first = np.flatnonzero(np.r_[True, clause[1:] != clause[:-1]]) if len(clause) else np.zeros(0, np.int64)
        size = np.diff(np.r_[first, len(clause)])
        order = np.argsort(-size, kind="stable")
        first, size = first[order], size[order]
        letters = sorted({x for m in self.marks for x in m})
        has = {x: np.array([x in m for m in self.marks]) for x in letters}
        total, counts = np.zeros(len(first)), {x: np.zeros(len(first), np.int64) for x in letters}
        for begin in self.start:
            state = np.full(len(first), begin)
            own, marked = np.zeros(len(first)), {x: np.zeros(len(first), np.int64) for x in letters}
            n = len(first)
            for p in range(int(size[0]) if n else 0):
                while size[n - 1] <= p:
                    n -= 1
                at = first[:n] + p
                state[:n] = s = self.next[state[:n], kinds[at]]
                own[:n] += weights[at] * self.factor[s]
                for x in letters:
                    marked[x][:n] += has[x][s] & (weights[at] > 0)
            end = self.final[state]
            ok = ~np.isnan(end)
            total[ok] += own[ok] + end[ok]
            for x in letters:
                counts[x][ok] += marked[x][ok]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        return total[back], {x: c[back] for x, c in counts.items()}
