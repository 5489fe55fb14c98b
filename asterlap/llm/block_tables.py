"""Four-Russians tables for the cheapest edits that give a sequence of turns its grammar.

A conversation's roles must match ``(s?(ua)+)?``. Its grammar has four states: nothing yet, a system turn, after a user
turn, after an assistant turn. Edits of a turn are Delete, Keep and Rerole; turns without text can be Inserted anywhere.
For a place in the conversation the cost-to-go is a vector with an entry per state: the least cost of all edits from there
to the end. Taken off its minimum, such a vector is one of few, because two inserted turns lead from any state to any
useful other one. So the step over a turn is a lookup by (vector, symbol), and the step over a block of ``BLOCK`` turns a
lookup by (vector, block), precomputed for every block of that length.

Symbols are an initial (s, u, a or another) and whether the turn is truncated: eight of them. Turns that must go don't
change a vector and need no symbol.
"""

from functools import lru_cache

import numpy as np

BLOCK = 4
SYMBOLS = 8
#: Symbol of turns that must be deleted.
MUST_GO = 8
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 1, 2, 5, 5
NEVER = 2**60
STATES = 4
INITIALS = "sua"
#: What a state becomes by a turn with this initial. Fixed values.
NEXT = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The initial that may be inserted in a state or given to a turn there.
GIVEN = {0: "u", 1: "u", 2: "a", 3: "u"}
ENDS = (0, 3)
#: Expanded blocks that a worker remembers.
REMEMBERED = 100_000


def after_given(state: int) -> int:
    return NEXT[GIVEN[state]][state]


def moves(state: int, symbol: int) -> list[tuple[str, int, int, str]]:
    """(letter, cost, next state, initial said) of the edits of a turn, by letter."""
    initial, late = (INITIALS + " ")[symbol % 4], UNFINISHED * (symbol // 4)
    found = [("D", DELETE, state, "")]
    if state in NEXT.get(initial, ()):
        found.append(("K", KEEP + late, NEXT[initial][state], initial))
    return [*found, ("R", REROLE + late, after_given(state), GIVEN[state])]


def with_inserts(costs: list[int]) -> list[int]:
    """Costs when turns may be inserted first."""
    for _ in range(STATES):
        costs = [min(costs[s], INSERT + costs[after_given(s)]) for s in range(STATES)]
    return costs


def over_turn(vector: tuple, symbol: int) -> tuple[tuple, int]:
    """The vector before a turn, from the one behind it, and what was taken off it."""
    costs = with_inserts([min(c + vector[n] for _, c, n, _ in moves(s, symbol)) for s in range(STATES)])
    least = min(costs)
    return tuple(c - least if c < NEVER else NEVER for c in costs), least


class Tables:
    """``vectors``: every vector that can occur, the one at the end first and those that ask for a certain state at the
    end next; ``step``, ``off``: over a turn; ``block_step``, ``block_off``: over a block, its first turn counting most."""

    def __init__(self):
        end = tuple(with_inserts([0 if s in ENDS else NEVER for s in range(STATES)]))
        asked = [tuple(0 if s == e else NEVER for s in range(STATES)) for e in range(STATES)]
        self.vectors = [end, *asked]
        self.ids = {v: i for i, v in enumerate(self.vectors)}
        step, off = [], []
        for v in self.vectors:  # grows meanwhile
            found = [over_turn(v, s) for s in range(SYMBOLS)]
            for w, _ in found:
                if w not in self.ids:
                    self.ids[w] = len(self.vectors)
                    self.vectors.append(w)
            step.append([self.ids[w] for w, _ in found])
            off.append([least for _, least in found])
        self.step, self.off = np.array(step, np.int32), np.array(off, np.int64)
        self.block_step, self.block_off = self.step, self.off
        for _ in range(BLOCK - 1):
            one = self.step[self.block_step]  # vector, rest of the block, symbol before it
            more = self.block_off[:, :, None] + self.off[self.block_step]
            self.block_step = one.swapaxes(1, 2).reshape(len(step), -1)
            self.block_off = more.swapaxes(1, 2).reshape(len(step), -1)
        self.memory: dict = {}

    def blocks(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The first turns, which fill no block, and the codes of the blocks behind them."""
        head = len(symbols) % BLOCK
        powers = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
        return symbols[:head], symbols[head:].reshape(-1, BLOCK).astype(np.int64) @ powers

    def back(self, symbols: np.ndarray, vector: int) -> tuple[int, int]:
        """The vector before all the turns, from the one behind them, and what was taken off on the way."""
        head, codes = self.blocks(symbols)
        total = 0
        for code in codes[::-1].tolist():
            total += int(self.block_off[vector, code])
            vector = int(self.block_step[vector, code])
        for symbol in head[::-1].tolist():
            total += int(self.off[vector, symbol])
            vector = int(self.step[vector, symbol])
        return vector, total

    def matrix(self, symbols: np.ndarray) -> list[int]:
        """Least costs from each state before the turns to each state behind them, row by row."""
        columns = []
        for asked in range(STATES):
            vector, total = self.back(symbols, 1 + asked)
            columns.append([c + total if c < NEVER else NEVER for c in self.vectors[vector]])
        return [columns[j][i] for i in range(STATES) for j in range(STATES)]

    def expand(self, symbols: tuple, behind: int, state: int) -> tuple[list[tuple[str, str]], int]:
        """Letters and said initials of each turn of a block, and the state behind it. Vectors inside the block are found
        backward from the one behind it; then the least letter that lies on a cheapest way is taken, turn by turn."""
        key = (symbols, behind, state)
        if key in self.memory:
            return self.memory[key]
        inside = [behind]
        for symbol in reversed(symbols):
            inside.append(int(self.step[inside[-1], symbol]))
        inside.reverse()
        out = []
        for k, symbol in enumerate(symbols):
            here, then = self.vectors[inside[k]], self.vectors[inside[k + 1]]
            taken = int(self.off[inside[k + 1], symbol])
            letters = said = ""
            while True:
                aim = here[state] + taken
                best = {letter: (n, i) for letter, c, n, i in moves(state, symbol) if c + then[n] == aim}
                if here[after_given(state)] + INSERT == here[state]:
                    best["I"] = (after_given(state), GIVEN[state])
                letter = min(best)
                state, initial = best[letter]
                letters, said = letters + letter, said + initial
                if letter != "I":
                    break
            out.append((letters, said))
        if len(self.memory) > REMEMBERED:
            self.memory.clear()
        self.memory[key] = out, state
        return out, state

    def trace(self, symbols: np.ndarray, behind: int, state: int) -> tuple[list[tuple[str, str]], int]:
        """The ASCII-least cheapest edits of the turns, as in ``expand``."""
        head, codes = self.blocks(symbols)
        at = [behind]
        for code in codes[::-1].tolist():
            at.append(int(self.block_step[at[-1], code]))
        at.reverse()
        out = []
        parts = [tuple(head.tolist())] + [tuple(b) for b in symbols[len(head):].reshape(-1, BLOCK).tolist()]
        for part, vector in zip(parts, at):
            more, state = self.expand(part, vector, state)
            out += more
        return out, state

    def last_inserts(self, state: int) -> tuple[str, str]:
        """Letters and initials behind the last turn."""
        letters = said = ""
        while state not in ENDS and state < STATES:
            letters, said, state = letters + "I", said + GIVEN[state], after_given(state)
        return letters, said


@lru_cache(maxsize=1)
def tables() -> Tables:
    """One for all tasks of a Python worker."""
    return Tables()
