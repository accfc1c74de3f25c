"""Probabilistic automata learnt from examples by merging states of their prefix tree.

States are merged in the order of the red-blue framework when the Hoeffding bound
finds no difference in how often each ends or goes on with each symbol, here and in
all states after them.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

#: Symbols are classes of characters; a character not listed stands for itself.
_CLASSES = ("0123456789", "abcdef", "ghijklmnopqrstuvwxyz", "ABCDEF", "GHIJKLMNOPQRSTUVWXYZ")
_SYMBOL = {c: chr(97 + k) for k, cs in enumerate(_CLASSES) for c in cs}
_LOG_SIZE = {chr(97 + k): math.log2(len(cs)) for k, cs in enumerate(_CLASSES)}
#: Probability, in bits, of a step that no example took.
UNSEEN = -12.0


def symbols(text: str) -> str:
    return "".join(_SYMBOL.get(c, c) for c in text)


class Automaton:
    """``next[state][symbol]``, with the log-probabilities of steps and of ending."""

    def __init__(self, examples: Iterable[str], alpha: float = 0.05):
        self.next: list[dict[str, int]] = [{}]
        self.count: list[dict[str, int]] = [{}]
        self.ends: list[int] = [0]
        for text in examples:
            state = 0
            for s in symbols(text):
                self.count[state][s] = self.count[state].get(s, 0) + 1
                if s not in self.next[state]:
                    self.next[state][s] = len(self.next)
                    self.next.append({})
                    self.count.append({})
                    self.ends.append(0)
                state = self.next[state][s]
            self.ends[state] += 1
        self.factor = math.sqrt(0.5 * math.log(2 / alpha))
        self._merge_states()
        self.steps = []
        for k in range(len(self.next)):
            n = self._total(k)
            self.steps.append({s: math.log2(c / n) for s, c in self.count[k].items()} if n else {})
        self.final = [math.log2(e / n) if e and (n := self._total(k)) else UNSEEN for k, e in enumerate(self.ends)]

    def _total(self, state: int) -> int:
        return self.ends[state] + sum(self.count[state].values())

    def _alike(self, a: int, b: int) -> bool:
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            n, m = self._total(a), self._total(b)
            if not n or not m:
                continue
            bound = self.factor * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for s in self.count[a].keys() | self.count[b].keys():
                if abs(self.count[a].get(s, 0) / n - self.count[b].get(s, 0) / m) > bound:
                    return False
                if s in self.next[a] and s in self.next[b]:
                    stack.append((self.next[a][s], self.next[b][s]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the tree below ``b`` to the states from ``a`` on."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            self.ends[a] += self.ends[b]
            for s, n in self.count[b].items():
                self.count[a][s] = self.count[a].get(s, 0) + n
                if s in self.next[a]:
                    stack.append((self.next[a][s], self.next[b][s]))
                else:
                    self.next[a][s] = self.next[b][s]

    def _merge_states(self) -> None:
        red, blue = [0], [(0, s) for s in sorted(self.next[0])]
        while blue:
            parent, s = blue.pop(0)
            state = self.next[parent][s]
            if state in red:
                continue
            like = next((r for r in red if self._alike(r, state)), None)
            if like is None:
                red.append(state)
            else:
                self.next[parent][s] = like
                self._fold(like, state)
            blue = [(r, x) for r in red for x in sorted(self.next[r]) if self.next[r][x] not in red]

    def bits(self, text: str) -> float:
        """The log-probability per character."""
        state, total = 0, 0.0
        for s in symbols(text):
            total += self.steps[state].get(s, UNSEEN) - _LOG_SIZE.get(s, 0.0)
            state = self.next[state].get(s, 0)
        return (total + self.final[state]) / max(1, len(text))
