"""Linear classifiers of many folds and penalties at once, by L-BFGS over blocks of rows.

All classes of all problems are columns of one coefficient matrix. A step evaluates loss and gradient of every open problem in one job;
each problem has its own memory, step length and end. Only coefficients (features x classes) are on the driver.
"""

from collections import deque
from dataclasses import dataclass, field

import numpy as np

from hirelake.operators.blocks import Block, added

MEMORY, SUFFICIENT = 10, 1e-4
#: A problem ends when its largest gradient is this, or when a step lowers the mean loss by less than this part of it.
GRADIENT, PROGRESS = 1e-4, 1e-9


@dataclass(frozen=True)
class Problem:
    """The rows of one fold, and the factor C of the summed loss next to half the squared coefficients."""

    fold: int
    C: float


@dataclass
class Solution:
    """coefficients: features x classes, the intercepts in the last row."""

    coefficients: np.ndarray
    converged: bool
    steps: int


def softmax_loss(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Loss of each row, and its slope by the margins."""
    top = margins.max(axis=1, keepdims=True)
    e = np.exp(margins - top)
    total = e.sum(axis=1, keepdims=True)
    rows = np.arange(len(labels))
    loss = np.log(total[:, 0]) + top[:, 0] - margins[rows, labels]
    slope = e / total
    slope[rows, labels] -= 1
    return loss, slope


def squared_hinge_loss(margins: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One class against the rest, for all classes; the sum of their losses."""
    sign = -np.ones_like(margins)
    sign[np.arange(len(labels)), labels] = 1
    short = np.maximum(0, 1 - sign * margins)
    return (short * short).sum(axis=1), -2 * sign * short


@dataclass
class _State:
    x: np.ndarray
    loss: float = np.inf
    gradient: np.ndarray | None = None
    direction: np.ndarray | None = None
    step: float = 1.0
    steps: int = 0
    ended: str = ""
    pairs: deque = field(default_factory=lambda: deque(maxlen=MEMORY))

    def trial(self) -> np.ndarray:
        return self.x if self.gradient is None else self.x + self.step * self.direction

    def turn(self) -> None:
        """A new direction, by the pairs of steps and changes of gradient remembered."""
        q, back = self.gradient.copy(), []
        for s, y, rho in reversed(self.pairs):
            a = rho * (s * q).sum()
            q -= a * y
            back.append((a, s, y, rho))
        if self.pairs:
            s, y, rho = self.pairs[-1]
            q /= rho * (y * y).sum()
        for a, s, y, rho in reversed(back):
            q += s * (a - rho * (y * q).sum())
        self.direction = -q
        if (self.direction * self.gradient).sum() >= 0:
            self.direction, _ = -self.gradient, self.pairs.clear()
        self.step = 1.0 if self.pairs else min(1.0, 1 / (np.abs(self.gradient).sum() + 1e-300))

    def take(self, loss: float, gradient: np.ndarray) -> None:
        if self.gradient is None:
            self.loss, self.gradient = loss, gradient
        else:
            slope = (self.direction * self.gradient).sum()
            if not loss <= self.loss + SUFFICIENT * self.step * slope:
                bend = 2 * (loss - self.loss - self.step * slope)
                best = -slope * self.step**2 / bend if np.isfinite(bend) and bend > 0 else 0
                self.step = min(max(best, 0.1 * self.step), 0.5 * self.step)
                if self.step < 1e-12:
                    self.ended = "no step"
                return
            s, y = self.step * self.direction, gradient - self.gradient
            if (s * y).sum() > 1e-12 * (y * y).sum():
                self.pairs.append((s, y, 1 / (s * y).sum()))
            before = self.loss
            self.x, self.loss, self.gradient, self.steps = self.x + s, loss, gradient, self.steps + 1
            if before - loss <= PROGRESS * max(abs(loss), 1e-300):
                self.ended = "progress"
        if np.abs(self.gradient).max() <= GRADIENT:
            self.ended = "gradient"
        if not self.ended:
            self.turn()


def solve(blocks, problems: list[Problem], sizes: dict[int, tuple[int, int]], loss, classes: int, max_iter: int, penal_intercept: bool) -> dict[Problem, Solution]:
    """The coefficients of each problem; `sizes` has the features and rows of each fold.

    The objective is loss summed over the learning rows by weight, times C, plus half the squared coefficients, all divided by C x rows.
    """
    states = {p: _State(np.zeros((sizes[p.fold][0] + 1, classes))) for p in problems}
    for _ in range(4 * max_iter):
        open_ = [p for p in problems if not states[p].ended and states[p].steps < max_iter]
        if not open_:
            break
        trials = {p: states[p].trial() for p in open_}
        matrices = {f: np.hstack([trials[p] for p in open_ if p.fold == f]) for f in {p.fold for p in open_}}

        def of_block(block: Block, matrices=matrices) -> dict:
            if not block.learn or block.fold not in matrices:
                return {}
            matrix = matrices[block.fold]
            margins = block.times(matrix[:-1]) + matrix[-1]
            slopes, losses = np.empty_like(margins), []
            for a in range(0, margins.shape[1], classes):
                each, slope = loss(margins[:, a : a + classes], block.labels)
                losses.append((each * block.weights).sum())
                slopes[:, a : a + classes] = slope * block.weights[:, None]
            return {block.fold: np.vstack([block.transposed_times(slopes), slopes.sum(axis=0), np.repeat(losses, classes)])}

        sums = added(blocks, of_block)
        for f in matrices:
            for i, p in enumerate(q for q in open_ if q.fold == f):
                own, n = sums[f][:, i * classes : (i + 1) * classes] / sizes[f][1], sizes[f][1]
                x, penalty = trials[p].copy(), 1 / (p.C * n)
                if not penal_intercept:
                    x[-1] = 0
                states[p].take(own[-1, 0] + penalty / 2 * (x * x).sum(), own[:-1] + penalty * x)
    return {p: Solution(s.x, s.ended in ("gradient", "progress", "no step"), s.steps) for p, s in states.items()}


def confusion(blocks, coefficients: dict[Problem, np.ndarray], classes: int) -> dict[Problem, np.ndarray]:
    """actual x predicted counts of the held-out rows of each problem's fold."""

    def of_block(block: Block) -> dict:
        out = {}
        for p, w in coefficients.items():
            if not block.learn and block.fold == p.fold:
                predicted = (block.times(w[:-1]) + w[-1]).argmax(axis=1)
                out[p] = np.bincount(block.labels * classes + predicted, minlength=classes * classes).reshape(classes, classes)
        return out

    return added(blocks, of_block)
