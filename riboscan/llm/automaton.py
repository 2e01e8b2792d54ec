"""Byte automata from regular expressions: Thompson construction, subset construction, minimisation.

Supported: literals, ``[...]`` classes with ranges, groups, ``|``, ``?``,
``*``, ``+``, ``{m}``, ``{m,}``, ``{m,n}``, ``\\xHH`` and escaped characters;
ASCII only.
"""

from __future__ import annotations

from functools import reduce

import numpy as np


class _Parser:
    """Builds NFA fragments (start, end); edges[s] is a list of (byte set or None, target)."""

    def __init__(self, edges: list[list], ignore_case: bool):
        self.edges, self.fold = edges, ignore_case

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def parse(self, pattern: str) -> tuple[int, int]:
        self.p, self.i = pattern, 0
        out = self.either()
        if self.i != len(pattern):
            raise ValueError(f"unexpected {pattern[self.i]!r} in {pattern!r}")
        return out

    def more(self, stops: str = "") -> bool:
        return self.i < len(self.p) and self.p[self.i] not in stops

    def either(self) -> tuple[int, int]:
        arms = [self.sequence()]
        while self.more() and self.p[self.i] == "|":
            self.i += 1
            arms.append(self.sequence())
        if len(arms) == 1:
            return arms[0]
        a, b = self.state(), self.state()
        for x, y in arms:
            self.edges[a].append((None, x))
            self.edges[y].append((None, b))
        return a, b

    def sequence(self) -> tuple[int, int]:
        a = b = self.state()
        while self.more("|)"):
            begin = self.i
            x, y = self.atom()
            least, most = self.count()
            end, copies = self.i, [(x, y)]
            for _ in range(max(least, most or 1, 1) - 1):
                self.i = begin
                copies.append(self.atom())
            self.i = end
            for n, (x, y) in enumerate(copies):
                skip = self.state()
                self.edges[b].append((None, x))
                self.edges[y].append((None, skip))
                if n >= least:
                    self.edges[b].append((None, skip))
                if most is None and n == len(copies) - 1:
                    self.edges[y].append((None, x))
                b = skip
        return a, b

    def count(self) -> tuple[int, int | None]:
        if not self.more():
            return 1, 1
        c = self.p[self.i]
        if c in "?*+":
            self.i += 1
            return {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
        if c == "{":
            body = self.p[self.i + 1 : (end := self.p.index("}", self.i))]
            self.i = end + 1
            low, comma, high = body.partition(",")
            return int(low), int(high) if high else None if comma else int(low)
        return 1, 1

    def char(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "\\":
            c = self.p[self.i]
            self.i += 1
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def atom(self) -> tuple[int, int]:
        if self.p[self.i] == "(":
            self.i += 1
            out = self.either()
            self.i += 1
            return out
        if self.p[self.i] == "[":
            self.i += 1
            found = set()
            while self.p[self.i] != "]":
                c = self.char()
                if self.p[self.i] == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    found |= set(range(c, self.char() + 1))
                else:
                    found.add(c)
            self.i += 1
        else:
            found = {self.char()}
        if self.fold:
            found |= {ord(chr(c).swapcase()) for c in found if chr(c).isalpha()}
        a, b = self.state(), self.state()
        self.edges[a].append((frozenset(found), b))
        return a, b


class Automaton:
    """Transition arrays of a minimal deterministic automaton.

    ``step[state * classes + class_of[byte]]`` is the next state times
    ``classes``; ``accepts[state]`` has bit r set if pattern r ends there; with
    ``search`` a match may begin at any byte. With ``reverse`` it reads matches
    from their last byte to their first.
    """

    def __init__(self, patterns: list[tuple[str, bool]], search: bool, reverse: bool = False):
        edges: list[list] = [[]]
        ends = {}
        for r, (pattern, fold) in enumerate(patterns):
            a, b = _Parser(edges, fold).parse(pattern)
            edges[0].append((None, a))
            ends[b] = r
        if reverse:
            back: list[list] = [[(None, b) for b in ends], *[[] for _ in edges[1:]]]
            firsts = {a: r for r, (_, a) in enumerate(edges[0])}
            for s, out in enumerate(edges[1:], 1):
                for chars, t in out:
                    back[t].append((chars, s))
            edges, ends = back, firsts
        sets = {s for out in edges for s, _ in out if s}
        self.alphabet = frozenset().union(*sets)
        column = [tuple(b in s for s in sets) for b in range(256)]
        kinds = {c: i for i, c in enumerate(dict.fromkeys(column))}
        class_of = np.array([kinds[c] for c in column])
        sample = [int(np.flatnonzero(class_of == i)[0]) for i in range(len(kinds))]

        def close(state: int) -> int:
            """The states reached without a byte, as bits."""
            todo, seen = [state], 1 << state
            while todo:
                for s, t in edges[todo.pop()]:
                    if s is None and not seen >> t & 1:
                        seen |= 1 << t
                        todo.append(t)
            return seen

        closed = [close(q) for q in range(len(edges))]
        moves: list[list[tuple[int, int]]] = [[] for _ in edges]  # of each state: byte class, states reached
        for q, out in enumerate(edges):
            for s, t in out:
                moves[q] += [(i, closed[t]) for i, b in enumerate(sample) if s and b in s]
        first, again = closed[0], closed[0] if search else 0
        index, table, i = {first: 0}, [], 0
        order = [first]
        while i < len(order):
            row, rest = [again] * len(sample), order[i]
            while rest:
                low = rest & -rest
                for c, target in moves[low.bit_length() - 1]:
                    row[c] |= target
                rest ^= low
            table.append([])
            for target in row:
                if target not in index:
                    index[target] = len(order)
                    order.append(target)
                table[-1].append(index[target])
            i += 1
        accept = [reduce(int.__or__, (1 << r for q, r in ends.items() if states >> q & 1), 0) for states in order]
        self._minimise(np.array(table), np.array(accept), class_of)
        #: No path to an accepting state leads from here (without search: the empty set).
        self.dead = None if search else self._at.get(index.get(0, -1))

    def _minimise(self, table: np.ndarray, accept: np.ndarray, class_of: np.ndarray) -> None:
        """Moore's partition refinement, then merges of equal byte columns."""
        _, part = np.unique(accept, return_inverse=True)
        while True:
            _, new = np.unique(np.column_stack([part, part[table]]), axis=0, return_inverse=True)
            new = new.ravel()
            if new.max() == part.max():
                break
            part = new
        _, seen = np.unique(part, return_index=True)
        rank = np.empty(len(seen), int)
        rank[part[np.sort(seen)]] = np.arange(len(seen))  # the start state is 0
        part = rank[part]
        _, seen = np.unique(part, return_index=True)
        small = part[table][seen]
        columns, inverse = np.unique(small, axis=1, return_inverse=True)
        self.class_of = inverse.ravel()[class_of].astype(np.uint8)
        self.classes = columns.shape[1]
        self.step = (columns * self.classes).astype(np.int32).ravel()
        self.accepts = accept[seen]
        self._at = {old: int(new) for old, new in enumerate(part)}
        self.rows = columns.tolist()
        self.byte_class = self.class_of.tolist()
        self.accept_list = self.accepts.tolist()

    def trace(self, data: bytes) -> np.ndarray:
        """The rule bits of the state after each byte."""
        rows, accept, state, out = self.rows, self.accept_list, 0, []
        for c in data.translate(self.class_of.tobytes()):
            state = rows[state][c]
            out.append(accept[state])
        return np.array(out, np.int64)

    def longest(self, data: bytes, at: int, end: int) -> int:
        """End of the longest match that begins at ``at``; -1 if none does."""
        state, found = 0, -1
        rows, kind, accept, dead = self.rows, self.byte_class, self.accept_list, self.dead
        while at < end:
            state = rows[state][kind[data[at]]]
            if state == dead:
                break
            at += 1
            if accept[state]:
                found = at
        return found
