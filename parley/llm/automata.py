"""Probabilistic automata from labelled strings by merging prefix-tree states.

The strings form a prefix tree with counts. States are visited from the root;
each new state is merged into the first kept state whose ending frequency and
symbol frequencies, and those of all states behind it, differ by no more than
a Hoeffding bound; otherwise it is kept. What remains is a deterministic
automaton with a probability for each step and for ending.

Characters are read as classes (digits, letters a-f, other letters, each in
either case, and every sign for itself), so that few labelled strings do.
Inside a class characters count as equally likely.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterable

CLASS_SIZE = {"0": 10, "a": 6, "g": 20, "A": 6, "G": 20}
_CLASSES = {**dict.fromkeys("0123456789", "0"), **dict.fromkeys("abcdef", "a"), **dict.fromkeys("ABCDEF", "A")}
_CLASSES |= dict.fromkeys("ghijklmnopqrstuvwxyz", "g") | dict.fromkeys("GHIJKLMNOPQRSTUVWXYZ", "G")
_TRANSLATE = str.maketrans(_CLASSES)


def classes(token: str) -> str:
    """The token as one class sign per character."""
    return token.translate(_TRANSLATE)


class Automaton:
    """Counts of a deterministic automaton; state 0 is the start."""

    def __init__(self) -> None:
        self.visits: list[int] = []
        self.ends: list[int] = []
        self.steps: list[dict[str, list[int]]] = []  # symbol -> [state, count]
        self._state()

    def _state(self) -> int:
        self.visits.append(0)
        self.ends.append(0)
        self.steps.append({})
        return len(self.visits) - 1

    def _insert(self, symbols: str) -> None:
        state = 0
        self.visits[0] += 1
        for symbol in symbols:
            step = self.steps[state].get(symbol)
            if step is None:
                step = self.steps[state][symbol] = [self._state(), 0]
            step[1] += 1
            state = step[0]
            self.visits[state] += 1
        self.ends[state] += 1

    def _compatible(self, first: int, second: int, alpha: float) -> bool:
        scale = math.sqrt(0.5 * math.log(2 / alpha))
        todo = [(first, second)]
        while todo:
            a, b = todo.pop()
            n, m = self.visits[a], self.visits[b]
            bound = scale * (1 / math.sqrt(n) + 1 / math.sqrt(m))
            if abs(self.ends[a] / n - self.ends[b] / m) > bound:
                return False
            for symbol in self.steps[a].keys() | self.steps[b].keys():
                x, y = self.steps[a].get(symbol), self.steps[b].get(symbol)
                if abs((x[1] if x else 0) / n - (y[1] if y else 0) / m) > bound:
                    return False
                if x and y:
                    todo.append((x[0], y[0]))
        return True

    def _fold(self, kept: int, tree: int) -> None:
        """Add the counts of the tree below ``tree`` to those reached from ``kept``."""
        todo = [(kept, tree)]
        while todo:
            a, b = todo.pop()
            self.visits[a] += self.visits[b]
            self.ends[a] += self.ends[b]
            for symbol, (state, count) in self.steps[b].items():
                step = self.steps[a].get(symbol)
                if step is None:
                    self.steps[a][symbol] = [state, count]
                else:
                    step[1] += count
                    todo.append((step[0], state))

    def loglik(self, token: str) -> float:
        """Log-likelihood in bits; minus infinity if the automaton has no such string."""
        state, total = 0, 0.0
        for symbol in classes(token):
            step = self.steps[state].get(symbol)
            if step is None:
                return -math.inf
            total += math.log2(step[1] / self.visits[state] / CLASS_SIZE.get(symbol, 1))
            state = step[0]
        return total + math.log2(max(self.ends[state], 0.5) / self.visits[state])


def infer(strings: Iterable[str], alpha: float = 0.05) -> Automaton:
    """An automaton of the strings; ``alpha`` is the confidence of each comparison."""
    machine = Automaton()
    for text in sorted(strings):
        machine._insert(classes(text))
    kept = [0]
    waiting = deque((0, symbol) for symbol in sorted(machine.steps[0]))
    seen = {0}
    while waiting:
        parent, symbol = waiting.popleft()
        state = machine.steps[parent][symbol][0]
        if state in seen:
            continue
        for other in kept:
            if machine._compatible(other, state, alpha):
                machine.steps[parent][symbol][0] = other
                machine._fold(other, state)
                break
        else:
            kept.append(state)
            seen.add(state)
        # Folding may give any kept state new steps.
        waiting.extend((k, s) for k in kept for s in sorted(machine.steps[k]) if machine.steps[k][s][0] not in seen)
    return machine
