"""A generalised suffix automaton over word numbers."""

from __future__ import annotations


class SuffixAutomaton:
    """Holds every substring of the sequences added; streams others for matching statistics."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, moves: dict[int, int]) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(0)
        return len(self.next) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for its substrings up to p's length and one."""
        copy = self._state(self.length[p] + 1, dict(self.next[q]))
        self.link[copy], self.link[q] = self.link[q], copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            q = self.next[last].get(c)
            if q is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
                continue
            new, p = self._state(self.length[last] + 1, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                q = self.next[p][c]
                self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
            last = new

    def matching(self, sequence: list[int]) -> list[int]:
        """For each place, the length of the longest substring that ends there and is held."""
        out, state, n = [], 0, 0
        step, link, length = self.next, self.link, self.length
        for c in sequence:
            while state and c not in step[state]:
                state = link[state]
                n = length[state]
            q = step[state].get(c)
            state, n = (0, 0) if q is None else (q, n + 1)
            out.append(n)
        return out
