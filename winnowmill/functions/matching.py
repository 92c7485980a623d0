"""Similarity of two texts by their longest matching blocks, found with suffix automata."""

from __future__ import annotations

from collections import Counter

# From this length on, characters that make up more than one in POPULAR_SHARE of the second
# text (and one more) start no block, they only lengthen one.
LONG = 200
POPULAR_SHARE = 100


class SuffixAutomaton:
    """All substrings of a sequence; built in time in proportion to its length. None matches nothing."""

    def __init__(self, symbols) -> None:
        self.next, self.link, self.length, self.first = [{}], [-1], [0], [-1]
        last = 0
        for place, symbol in enumerate(symbols):
            if symbol is None:
                last = 0
                continue
            last = self._add(last, symbol, place)

    def _state(self, arcs: dict, link: int, length: int, first: int) -> int:
        self.next.append(arcs)
        self.link.append(link)
        self.length.append(length)
        self.first.append(first)
        return len(self.next) - 1

    def _split(self, state: int, symbol) -> int:
        """The state of the longest string that ends ``state`` and goes on by ``symbol``, on its own."""
        target = self.next[state][symbol]
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(dict(self.next[target]), self.link[target], self.length[state] + 1, self.first[target])
        self.link[target] = copy
        while state >= 0 and self.next[state].get(symbol) == target:
            self.next[state][symbol] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, symbol, place: int) -> int:
        if symbol in self.next[last]:  # after a gap the same string may come again
            return self._split(last, symbol)
        new, state = self._state({}, 0, self.length[last] + 1, place), last
        while state >= 0 and symbol not in self.next[state]:
            self.next[state][symbol] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, symbol)
        return new

    def longest(self, other) -> tuple[int, int, int]:
        """Longest common block ``(start in other, start in own, length)``: of several the first in other, then in own."""
        best, state, size = (0, 0, 0), 0, 0
        for place, symbol in enumerate(other):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if symbol in self.next[state]:
                state = self.next[state][symbol]
                size += 1
            if size > best[2]:
                best = (place - size + 1, self.first[state] - size + 1, size)
        return best


def matched(a: str, b: str) -> int:
    """Characters in matching blocks: the longest one, then those on its left and on its right, and so on."""
    popular = set()
    if len(b) >= LONG:
        popular = {c for c, n in Counter(b).items() if n > len(b) // POPULAR_SHARE + 1}
    total, open_ = 0, [(0, len(a), 0, len(b))]
    while open_:
        alow, ahigh, blow, bhigh = open_.pop()
        if alow >= ahigh or blow >= bhigh:
            continue
        own = b[blow:bhigh]
        automaton = SuffixAutomaton([None if c in popular else c for c in own] if popular else own)
        i, j, size = automaton.longest(a[alow:ahigh])
        i, j = (i + alow, j + blow) if size else (alow, blow)
        while size and i > alow and j > blow and a[i - 1] == b[j - 1]:
            i, j, size = i - 1, j - 1, size + 1
        while size and i + size < ahigh and j + size < bhigh and a[i + size] == b[j + size]:
            size += 1
        if not size and popular and a[alow] == b[blow]:  # an empty block at the start still grows
            while i + size < ahigh and j + size < bhigh and a[i + size] == b[j + size]:
                size += 1
        if size:
            total += size
            open_ += [(alow, i, blow, j), (i + size, ahigh, j + size, bhigh)]
    return total


def ratio(a: str, b: str) -> float:
    """Twice the matched characters over all; 1 for two empty texts."""
    return 2.0 * matched(a, b) / (len(a) + len(b)) if a or b else 1.0
