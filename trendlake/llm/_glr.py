"""Cheapest repair of a sequence of roles by a generalised LR parser.

The frontier after each row is a graph-structured stack: one node for each stack top, with what
may lie below it. Rows are kept, reroled or deleted and turns inserted at a cost; nodes with equal tops merge,
the lesser (cost, audit) stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

#: The grammar of (s?(ua)+)?, capital letters are its rules, and what edits cost.
GRAMMAR = (("S", ""), ("S", "P"), ("S", "sP"), ("P", "ua"), ("P", "Pua"))
INSERT, REROLE, DELETE, CUT_OFF = 3, 3, 4, 3

Stack = tuple  # of (state, stack below) for each state that may lie on top


class Automaton:
    """States of the LR(0) automaton of a grammar whose first rule's head is the start."""

    def __init__(self, rules) -> None:
        self.rules, self.start = rules, rules[0][0]
        states = [self._closed({(r, 0) for r, (head, _) in enumerate(rules) if head == self.start})]
        self.moves: dict[tuple[int, str], int] = {}
        for at, items in enumerate(states):  # grows meanwhile
            for symbol in sorted({rules[r][1][dot] for r, dot in items if dot < len(rules[r][1])}):
                to = self._closed({(r, dot + 1) for r, dot in items if rules[r][1][dot : dot + 1] == symbol})
                if to not in states:
                    states.append(to)
                self.moves[at, symbol] = states.index(to)
        done = [[rules[r] for r, dot in items if dot == len(rules[r][1])] for items in states]
        self.reduces = [[(head, len(body)) for head, body in d if head != self.start] for d in done]
        self.accepts = [any(head == self.start for head, _ in d) for d in done]

    def _closed(self, items: set) -> frozenset:
        while True:
            heads = {self.rules[r][1][dot] for r, dot in items if dot < len(self.rules[r][1])}
            more = {(r, 0) for r, (head, _) in enumerate(self.rules) if head in heads}
            if more <= items:
                return frozenset(items)
            items = items | more


AUTOMATON = Automaton(GRAMMAR)

#: A node: state, what lies below, cost above the cheapest node's, and the rank of its audit.
Node = tuple[int, Stack, int, int]
START: tuple[Node, ...] = ((0, (), 0, 0),)


@lru_cache(1 << 12)
def _merged(a: Stack, b: Stack) -> Stack:
    below = dict(a)
    for state, stack in b:
        below[state] = _merged(below[state], stack) if state in below else stack
    return tuple(sorted(below.items()))


def _bases(state: int, below: Stack, n: int) -> Iterator[tuple[int, Stack]]:
    """What is on top after ``n`` nodes were taken off."""
    if n == 0:
        yield state, below
    else:
        for lower, stack in below:
            yield from _bases(lower, stack, n - 1)


class _Tops:
    """Nodes by state. A node's value is (cost, rank of the audit so far, what is added to it), the node it came from last."""

    def __init__(self) -> None:
        self.nodes: dict[int, tuple[Stack, tuple, int]] = {}

    def put(self, state: int, below: Stack, value: tuple, origin: int) -> bool:
        """Add a node and all that it reduces to; whether anything was new or cheaper.

        Equal tops merge to the lesser value. What can follow a top does not depend on what lies
        below it in this grammar, so nothing that ends cheaper is lost.
        """
        old = self.nodes.get(state)
        if old is None:
            self.nodes[state] = below, value, origin
        else:
            merged = _merged(old[0], below)
            if value >= old[1] and merged == old[0]:
                return False
            self.nodes[state] = (merged, value, origin) if value < old[1] else (merged, *old[1:])
        below, value, origin = self.nodes[state]
        for head, n in AUTOMATON.reduces[state]:
            for base, stack in list(_bases(state, below, n)):
                self.put(AUTOMATON.moves[base, head], ((base, stack),), value, origin)
        return True

    def shift(self, state: int, below: Stack, role: str, value: tuple, origin: int) -> bool:
        to = AUTOMATON.moves.get((state, role))
        return to is not None and self.put(to, ((state, below),), value, origin)


def _with_inserts(frontier: tuple[Node, ...]) -> _Tops:
    """The frontier and what inserted turns make of it."""
    tops = _Tops()
    for i, (state, below, cost, rank) in enumerate(frontier):
        tops.put(state, below, (cost, rank, ""), i)
    changed = True
    while changed:
        changed = False
        for state, (below, (cost, rank, piece), origin) in list(tops.nodes.items()):
            for role in "ua":
                changed |= tops.shift(state, below, role, (cost + INSERT, rank, piece + "I"), origin)
    return tops


@lru_cache(1 << 16)
def advance(frontier: tuple[Node, ...], initial: str, useless: bool, cut_off: bool) -> tuple[tuple[Node, ...], int, tuple[tuple[int, str], ...]]:
    """The frontier after one more row, its least cost, and of each node (origin, piece of the audit).

    A piece is the inserts before the row and the row's own edit. No piece begins another, so
    audits of as many rows compare like their pieces, one after the other; their ranks stand
    for them. Costs are above the least, so the frontiers, and what is cached, are few.
    """
    tops, extra = _Tops(), CUT_OFF if cut_off else 0
    for state, (below, (cost, rank, piece), origin) in _with_inserts(frontier).nodes.items():
        tops.put(state, below, (cost + DELETE, rank, piece + "D"), origin)
        if not useless:
            tops.shift(state, below, initial, (cost + extra, rank, piece + "K"), origin)
            for role in "ua":
                tops.shift(state, below, role, (cost + REROLE + extra, rank, piece + "R"), origin)
    least = min(value[0] for _, value, _ in tops.nodes.values())
    ranks = {audit: i for i, audit in enumerate(sorted({value[1:] for _, value, _ in tops.nodes.values()}))}
    nodes = sorted((state, below, value[0] - least, ranks[value[1:]], origin, value[2]) for state, (below, value, origin) in tops.nodes.items())
    return tuple(n[:4] for n in nodes), least, tuple(n[4:] for n in nodes)


@lru_cache(1 << 12)
def finish(frontier: tuple[Node, ...]) -> tuple[int, int, str]:
    """The cheapest end: cost above the frontier's least, node, and inserts after the last row."""
    ends = [(value, origin) for state, (_, value, origin) in _with_inserts(frontier).nodes.items() if AUTOMATON.accepts[state]]
    (cost, _, piece), origin = min(ends)
    return cost, origin, piece


def repair(rows: list[tuple[str, bool, bool]]) -> tuple[int, str]:
    """Least cost and audit for rows of (initial of the role, has to go, is cut off)."""
    frontier, total, steps = START, 0, []
    for row in rows:
        frontier, cost, origins = advance(frontier, *row)
        total += cost
        steps.append(origins)
    cost, node, piece = finish(frontier)
    pieces = [piece]
    for origins in reversed(steps):
        node, piece = origins[node]
        pieces.append(piece)
    return total + cost, "".join(reversed(pieces))
