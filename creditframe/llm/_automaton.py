"""Suffix automata of symbol sequences."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass
class Automaton:
    """The smallest automaton of all substrings of one sequence; state 0 is the start.

    ``length`` is the longest substring a state stands for, ``link`` the state of its longest suffix in
    another state, ``end`` the place after its first occurrence.
    """

    step: list[dict[int, int]] = field(default_factory=lambda: [{}])
    link: list[int] = field(default_factory=lambda: [-1])
    length: list[int] = field(default_factory=lambda: [0])
    end: list[int] = field(default_factory=lambda: [0])
    copies: set[int] = field(default_factory=set)

    def _state(self, step: dict[int, int], link: int, length: int, end: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.end.append(end)
        return len(self.step) - 1

    def extend(self, last: int, symbol: int) -> int:
        """The state of the whole sequence after one more symbol."""
        new = self._state({}, 0, self.length[last] + 1, self.length[last] + 1)
        at = last
        while at >= 0 and symbol not in self.step[at]:
            self.step[at][symbol] = new
            at = self.link[at]
        if at < 0:
            return new
        to = self.step[at][symbol]
        if self.length[to] > self.length[at] + 1:
            part = self._state(dict(self.step[to]), self.link[to], self.length[at] + 1, self.end[to])
            self.copies.add(part)
            while at >= 0 and self.step[at].get(symbol) == to:
                self.step[at][symbol] = part
                at = self.link[at]
            self.link[to] = part
            to = part
        self.link[new] = to
        return new

    def ends(self) -> list[list[int]]:
        """The places after every occurrence of each state's substrings."""
        found = [[] if s == 0 or s in self.copies else [e] for s, e in enumerate(self.end)]
        for s in sorted(range(1, len(self.step)), key=lambda s: -self.length[s]):
            if self.link[s] > 0:
                found[self.link[s]] += found[s]
        return found


def build(symbols: list[int]) -> Automaton:
    out, last = Automaton(), 0
    for symbol in symbols:
        last = out.extend(last, symbol)
    return out
