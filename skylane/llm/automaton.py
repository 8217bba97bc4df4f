"""Suffix automaton over word numbers, with counts of occurrences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """Accepts every substring of the added sequences; ``seen[s]`` counts where state s ends."""

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length, self.seen = [-1], [0], [0]

    def _state(self, step: dict[int, int], link: int, length: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.seen.append(0)
        return len(self.link) - 1

    def _clone(self, p: int, q: int, c: int) -> int:
        """Split the words of state q that are no longer than p's plus c."""
        twin = self._state(dict(self.step[q]), self.link[q], self.length[p] + 1)
        self.link[q] = twin
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = twin
            p = self.link[p]
        return twin

    def add(self, symbols: Iterable[int], times: int = 1) -> None:
        """Add one more reference text that occurs ``times`` times."""
        last = 0
        for c in symbols:
            q = self.step[last].get(c)
            if q is not None:  # an earlier text has this continuation
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, q, c)
            else:
                new, p = self._state({}, 0, self.length[last] + 1), last
                while p >= 0 and c not in self.step[p]:
                    self.step[p][c] = new
                    p = self.link[p]
                if p >= 0:
                    q = self.step[p][c]
                    self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, q, c)
                last = new
            self.seen[last] += times

    def close(self) -> None:
        """Sum the counts along suffix links, longest states first; add nothing afterwards."""
        for s in sorted(range(1, len(self.link)), key=self.length.__getitem__, reverse=True):
            if self.link[s] > 0:
                self.seen[self.link[s]] += self.seen[s]

    def repeated(self, symbols: Sequence[int], size: int) -> list[int]:
        """Starts of the windows of ``size`` symbols that the reference holds at least twice.

        Streams the text once; the state is cut back so that it always stands
        for the last ``size`` symbols when the matching statistic reaches them.
        """
        out, s, n = [], 0, 0
        step, link, length, seen = self.step, self.link, self.length, self.seen
        for i, c in enumerate(symbols):
            while s and c not in step[s]:
                s = link[s]
                n = length[s]
            if c in step[s]:
                s = step[s][c]
                n += 1
            while s and length[link[s]] >= size:
                s = link[s]
                n = length[s]
            if n >= size and seen[s] >= 2:
                out.append(i - size + 1)
        return out
