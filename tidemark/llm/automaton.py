"""Suffix automaton over sequences of any hashable symbols."""

from __future__ import annotations

from collections.abc import Hashable, Iterable


class Automaton:
    """States with their transitions, suffix link, longest length and first end position.

    Sequences are added one after the other; ``first`` is the position (over all symbols
    added so far) at which the strings of a state end for the first time.
    """

    def __init__(self):
        self.next: list[dict[Hashable, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [-1]
        self.added = 0

    def add(self, sequence: Iterable[Hashable]) -> int:
        """Add all substrings of a sequence; the state of the sequence itself."""
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            self.added += 1
        return last

    def _state(self, length: int, link: int, nexts: dict[Hashable, int], first: int) -> int:
        self.next.append(nexts)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.link) - 1

    def _split(self, at: int, symbol: Hashable, below: int) -> int:
        copy = self._state(self.length[at] + 1, self.link[below], dict(self.next[below]), self.first[below])
        self.link[below] = copy
        while at >= 0 and self.next[at].get(symbol) == below:
            self.next[at][symbol] = copy
            at = self.link[at]
        return copy

    def _extend(self, last: int, symbol: Hashable) -> int:
        below = self.next[last].get(symbol)
        if below is not None:
            return below if self.length[below] == self.length[last] + 1 else self._split(last, symbol, below)
        new, at = self._state(self.length[last] + 1, 0, {}, self.added), last
        while at >= 0 and symbol not in self.next[at]:
            self.next[at][symbol] = new
            at = self.link[at]
        if at >= 0:
            below = self.next[at][symbol]
            self.link[new] = below if self.length[below] == self.length[at] + 1 else self._split(at, symbol, below)
        return new
