"""Suffix automata."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class SuffixAutomaton:
    """All substrings of some sequences, as the smallest automaton that accepts their suffixes.

    Each state stands for the substrings that end at the same places; `length` is its longest,
    `link` the state of their longest proper suffix that ends at more places. `owner` is the smallest
    owner of a sequence in which a state's substrings occur. Sequences are told apart by symbols
    of their own, so no substring runs over an end.
    """

    def __init__(self) -> None:
        self.next: list[dict[Hashable, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.owner: list[int | None] = [None]
        self._last = 0
        self._added = 0

    def _extend(self, symbol: Hashable, owner: int | None) -> None:
        nexts, link, length = self.next, self.link, self.length
        state, at = len(nexts), self._last
        nexts.append({})
        link.append(0)
        length.append(length[at] + 1)
        self.owner.append(owner)
        while at >= 0 and symbol not in nexts[at]:
            nexts[at][symbol] = state
            at = link[at]
        if at >= 0:
            old = nexts[at][symbol]
            if length[old] == length[at] + 1:
                link[state] = old
            else:
                copy = len(nexts)
                nexts.append(dict(nexts[old]))
                link.append(link[old])
                length.append(length[at] + 1)
                self.owner.append(self.owner[old])
                while at >= 0 and nexts[at].get(symbol) == old:
                    nexts[at][symbol] = copy
                    at = link[at]
                link[old] = link[state] = copy
        self._last = state

    def add(self, sequence: Iterable[Hashable], owner: int | None = None) -> None:
        if self._added:
            self._extend((self._added,), None)
        self._added += 1
        for symbol in sequence:
            self._extend(symbol, owner)

    def settle(self) -> None:
        """Hand each state's owner down to the shorter substrings it ends with."""
        owner, link = self.owner, self.link
        for state in sorted(range(1, len(link)), key=self.length.__getitem__, reverse=True):
            above = link[state]
            if above > 0 and owner[state] is not None and (owner[above] is None or owner[state] < owner[above]):
                owner[above] = owner[state]

    def matches(self, sequence: Sequence[Hashable]) -> Iterable[tuple[int, int]]:
        """Matching statistics: at each symbol, the state and length of the longest match that ends there."""
        state = long = 0
        for symbol in sequence:
            while state and symbol not in self.next[state]:
                state = self.link[state]
                long = self.length[state]
            if symbol in self.next[state]:
                state, long = self.next[state][symbol], long + 1
            yield state, long

    def ancestor(self, state: int, length: int) -> int:
        """The state that holds the suffix of that length of a longer match."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state
