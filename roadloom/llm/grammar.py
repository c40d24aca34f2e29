"""Letter-to-letter weighted transducers over word classes, and their composition.

A transducer reads one symbol a step and writes one symbol; each arc adds a weight. Composition feeds the output of
the first to the second, state by state, and adds the weights. All machines here are deterministic and total: a
symbol without an arc of its own is copied, without weight, and the state stays or falls back as ``rest`` says.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

Arc = tuple[object, str, float]


class Transducer:
    """``step(state, symbol) -> (state, symbol out, weight)`` from ``start``; arcs met are kept in a table."""

    def __init__(self, start: object, step: Callable[[object, str], Arc]):
        self.start, self._step, self._arcs = start, step, {}

    def step(self, state: object, symbol: str) -> Arc:
        """One arc."""
        key = (state, symbol)
        if key not in self._arcs:
            self._arcs[key] = self._step(state, symbol)
        return self._arcs[key]

    def run(self, symbols: Iterable[str]) -> tuple[list[str], float]:
        """Output symbols and the sum of weights."""
        state, out, total = self.start, [], 0.0
        for s in symbols:
            state, o, w = self.step(state, s)
            out.append(o)
            total += w
        return out, total


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that runs ``first`` and then ``second`` on its output."""

    def step(state, symbol):
        a, b = state
        a, mid, w1 = first.step(a, symbol)
        b, out, w2 = second.step(b, mid)
        return (a, b), out, w1 + w2

    return Transducer((first.start, second.start), step)


def scope(mark: str, reach: int, rewrite: dict[str, str], until: str = "end") -> Transducer:
    """Within ``reach`` symbols after ``mark`` (0: up to ``until``), symbols are rewritten by the table."""

    def step(left, symbol):
        if symbol == until:
            return 0, symbol, 0.0
        if symbol == mark:
            return (reach or -1), symbol, 0.0
        out = rewrite.get(symbol, symbol) if left else symbol
        return (left - 1 if left > 0 else left), out, 0.0

    return Transducer(0, step)


def spelling(entries: dict[str, float]) -> Transducer:
    """Reads a word's letters and ``$``; the weight is that of the heaviest entry that it matches, a beginning or, with ``$``, a whole word.

    States are the nodes of the entries' trie with the weight so far; None is outside of the trie.
    """
    inner = {f[:k] for f in entries for k in range(len(f) + 1)}

    def step(state, symbol):
        node, best = state
        node = node + symbol if node is not None and node + symbol in inner else None
        more = max(0.0, entries.get(node, 0.0) - best)
        return (node, best + more), symbol, more

    return Transducer(("", 0.0), step)


class Cascade:
    """Machines that run one after another on each other's output, some of them from the end of the tape."""

    def __init__(self, machines: list[tuple[Transducer, bool]]):
        self.machines = machines

    def run(self, symbols: list[str]) -> list[str]:
        """What the last machine writes."""
        for machine, reverse in self.machines:
            symbols = machine.run(symbols[::-1])[0][::-1] if reverse else machine.run(symbols)[0]
        return symbols
