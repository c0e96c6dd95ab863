"""Cheapest edits of role sequences as min-plus transfer matrices.

The wanted role sequences `(s?(ua)+)?` are read by four states: START, after a system row, after a user row, after an assistant row. A row,
or any stretch of rows, is a 4 x 4 matrix: the cost of the cheapest edits that lead from one state to another, and where among the
edits from that state their letters rank in ASCII order. Inserted rows stand before a row, so every stretch ends with a row's letter, and edits of
one stretch that end in different states differ within both: ranks suffice to break ties of any longer stretch, and letters
(a rope: the state between a rule's two halves) are looked up only for the edits that are chosen.
"""

from dataclasses import dataclass
from functools import lru_cache

import numpy as np

START, SYSTEM, USER, ASSISTANT = range(4)
#: What is read next, after each state: an inserted or renamed row can only be this.
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Letters of rows: role initial (o: any other) and fault.
INITIALS = "suao"
FINE, DELETED, CUT = range(3)
TERMINALS = len(INITIALS) * 3
INSERT, RENAME, DELETE, MEND = 5, 1, 2, 5
FAR = 1 << 40  # no way


def symbol(initial: int, fault: int) -> int:
    return initial * 3 + fault


def kept_state(state: int, initial: str) -> int | None:
    """The state after a kept row of that role, None where it may not stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    after = {"u": USER, "a": ASSISTANT}.get(initial)
    return after if after == NEXT[state] else None


@dataclass
class Matrices:
    """cost and rank of n stretches as n x 4 x 4; mid: the state between the two halves they were made of."""

    cost: np.ndarray
    rank: np.ndarray
    mid: np.ndarray

    def __getitem__(self, at) -> "Matrices":
        return Matrices(self.cost[at], self.rank[at], self.mid[at])


def _terminal(code: int) -> list[list[tuple[int, str]]]:
    initial, fault = INITIALS[code // 3], code % 3
    cells = [[(FAR, "~")] * 4 for _ in range(4)]
    for p in range(4):
        state, inserted = p, 0
        while inserted < 4:  # further inserted rows only lead round again
            ways = [(DELETE, "D", state)]
            if fault != DELETED:
                mend = MEND if fault == CUT else 0
                ways.append((RENAME + mend, "R", NEXT[state]))
                after = kept_state(state, initial)
                if after is not None:
                    ways.append((mend, "K", after))
            for cost, letter, q in ways:
                cells[p][q] = min(cells[p][q], (cost + INSERT * inserted, "I" * inserted + letter))
            state, inserted = NEXT[state], inserted + 1
    return cells


_CELLS = [_terminal(code) for code in range(TERMINALS)]


def terminals() -> Matrices:
    cost = np.array([[[c for c, _ in row] for row in cells] for cells in _CELLS], dtype=np.int64)
    rank = np.array([[[sorted(x for _, x in row).index(x) for _, x in row] for row in cells] for cells in _CELLS], dtype=np.int64)
    return Matrices(cost, rank, np.zeros_like(rank))


def compose(a: Matrices, b: Matrices) -> Matrices:
    """One stretch after the other, for n pairs at once."""
    way = np.minimum(a.cost[:, :, :, None] + b.cost[:, None, :, :], FAR)
    mid = np.argmin(way * 8 + a.rank[:, :, :, None], axis=2)
    cost = np.take_along_axis(way, mid[:, :, None, :], axis=2)[:, :, 0, :]
    first = np.take_along_axis(a.rank, mid, axis=2)
    rows = np.arange(len(mid))[:, None, None]
    second = b.rank[rows, mid, np.arange(4)[None, None, :]]
    key = np.where(cost < FAR, first * 8 + second, 64)
    rank = (key[:, :, None, :] < key[:, :, :, None]).sum(axis=3)
    return Matrices(cost, rank, mid)


def stack(parts: list[Matrices]) -> Matrices:
    return Matrices(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("cost", "rank", "mid")))


#: What a stretch that ends the conversation costs besides, by its last state: inserted rows up to a full pair.
LAST = {START: 0, SYSTEM: 2 * INSERT, USER: INSERT, ASSISTANT: 0}
ENDING = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}


def last_state(m: Matrices) -> tuple[np.ndarray, np.ndarray]:
    """(cost, state) of the cheapest edits of whole conversations."""
    whole = m.cost[:, START, :] + np.array([LAST[q] for q in range(4)])
    state = np.argmin(whole * 8 + m.rank[:, START, :], axis=1)
    return np.minimum(whole[np.arange(len(state)), state], FAR), state


class Grammar:
    """Matrices of terminals and rules (left, right), each made once from its halves, with ropes of edits."""

    def __init__(self, rules: list[tuple[int, int]]):
        self.rules = rules
        parts, count = [terminals()], TERMINALS
        while count < TERMINALS + len(rules):  # rules whose halves are known go together
            ready = [r for r in rules[count - TERMINALS :] if max(r) < count]
            until = next((i for i, r in enumerate(rules[count - TERMINALS :]) if max(r) >= count), len(ready))
            known = stack(parts)
            left, right = zip(*rules[count - TERMINALS : count - TERMINALS + until])
            parts = [known, compose(known[np.array(left)], known[np.array(right)])]
            count += until
        self.matrices = stack(parts)
        first, last, clashes = [[c // 3 for c in range(TERMINALS)] for _ in range(2)] + [[0] * TERMINALS]
        for left, right in rules:
            clashes.append(clashes[left] + clashes[right] + clash(last[left], first[right]))
            first.append(first[left])
            last.append(last[right])
        self.first, self.last, self.clashes = np.array(first), np.array(last), np.array(clashes)
        self.letters = lru_cache(maxsize=1 << 14)(self._letters)

    def _letters(self, s: int, p: int, q: int) -> str:
        """The edits of a symbol from one state to another."""
        if s < TERMINALS:
            return _CELLS[s][p][q][1]
        left, right = self.rules[s - TERMINALS]
        mid = int(self.matrices.mid[s, p, q])
        return self.letters(left, p, mid) + self.letters(right, mid, q)

    def products(self, sequences: list[np.ndarray]) -> Matrices:
        """Matrices of sequences of symbols, none of them empty: all first symbols, then all second ones, ..."""
        out = self.matrices[np.array([s[0] for s in sequences])]
        size = np.array([len(s) for s in sequences])
        for t in range(1, int(size.max())):
            open_ = np.flatnonzero(size > t)
            made = compose(out[open_], self.matrices[np.array([sequences[i][t] for i in open_])])
            out.cost[open_], out.rank[open_], out.mid[open_] = made.cost, made.rank, made.mid
        return out

    def clashes_of(self, sequence: np.ndarray) -> int:
        """Neighbouring roles that may not follow each other."""
        between = sum(clash(int(a), int(b)) for a, b in zip(self.last[sequence[:-1]], self.first[sequence[1:]]))
        return int(self.clashes[sequence].sum()) + between

    def edits(self, sequence: np.ndarray, p: int, q: int) -> str:
        """Letters of the cheapest edits of a sequence from one state to another."""
        states = chosen_states(self.matrices[sequence], p, q)
        return "".join(self.letters(int(s), a, b) for s, a, b in zip(sequence, states[:-1], states[1:]))


def clash(a: int, b: int) -> int:
    return 0 if INITIALS[a] + INITIALS[b] in ("su", "ua", "au") else 1


def chosen_states(m: Matrices, p: int, q: int) -> list[int]:
    """States before, between and after the stretches of one conversation along its cheapest edits from p to q."""
    so_far, mids = m[:1], []
    for t in range(1, len(m.cost)):
        so_far = compose(so_far, m[t : t + 1])
        mids.append(so_far.mid[0, p])
    states = [q]
    for mid in reversed(mids):
        states.append(int(mid[states[-1]]))
    return [p, *reversed(states)]
