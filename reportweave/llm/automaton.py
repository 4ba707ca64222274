"""A suffix automaton over several sequences, grown one sequence at a time."""

from __future__ import annotations

from collections.abc import Sequence


class SuffixAutomaton:
    """All substrings of the sequences added so far. States hold transitions, a suffix link and a length."""

    def __init__(self) -> None:
        self.steps: list[dict] = [{}]
        self.link = [-1]
        self.length = [0]

    def add(self, sequence: Sequence) -> None:
        """Adds all substrings of ``sequence``; symbols can be anything that can be hashed."""
        at = 0
        for symbol in sequence:
            at = self._extend(at, symbol)

    def _extend(self, last: int, symbol) -> int:
        """The state of the sequence so far followed by ``symbol``."""
        steps, link, length = self.steps, self.link, self.length
        known = steps[last].get(symbol)
        if known is not None:  # an earlier sequence went here
            return known if length[known] == length[last] + 1 else self._clone(last, symbol, known)
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        at = last
        while at >= 0 and symbol not in steps[at]:
            steps[at][symbol] = new
            at = link[at]
        if at >= 0:
            target = steps[at][symbol]
            link[new] = target if length[target] == length[at] + 1 else self._clone(at, symbol, target)
        return new

    def _clone(self, at: int, symbol, state: int) -> int:
        """Splits off the shorter substrings of ``state``, which occur in more places."""
        steps, link, length = self.steps, self.link, self.length
        clone = len(steps)
        steps.append(dict(steps[state]))
        length.append(length[at] + 1)
        link.append(link[state])
        link[state] = clone
        while at >= 0 and steps[at].get(symbol) == state:
            steps[at][symbol] = clone
            at = link[at]
        return clone

    def matching_statistics(self, sequence: Sequence) -> list[int]:
        """For every place the length of the longest substring ending there that was added before."""
        steps, link, length = self.steps, self.link, self.length
        at = matched = 0
        out = []
        for symbol in sequence:
            step = steps[at].get(symbol)
            while step is None and at:
                at = link[at]
                matched = length[at]
                step = steps[at].get(symbol)
            if step is None:
                matched = 0
            else:
                at = step
                matched += 1
            out.append(matched)
        return out
