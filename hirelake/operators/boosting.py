"""Multiclass boosted trees on histograms, for several folds at once.

Each feature is cut at quantiles of its values. A round grows one tree for each class, level by level: an aggregate adds up the sums of gradients and
Hessians of the softmax loss by (fold, class, node, feature, bin) and gives the best split of each node; only splits reach the driver. Executors keep the margins
and the places of their rows between jobs; where those are lost, they are made again from the trees so far, which alone decide them. Gradients and
Hessians are whole multiples of a power of two, so sums are exact in any order: how rows are dealt out decides no split, and of equal splits the first feature's is taken.
"""

import json
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators.blocks import Block, added, sparse

#: Bins of a feature at most, cells that its quantiles are read from, penalty of a leaf's value, and least Hessian of a node.
BINS, CELLS, PENALTY, LEAST_HESSIAN = 16, 256, 1.0, 1.0
#: Rows of a fold that are dealt to one task at most: its sums need no exchange then, so it grows so many rounds before it answers. With more
#: rows each level of each round is one aggregate over all tasks; the trees are the same.
ROWS_TOGETHER, ROUNDS_A_JOB = 50_000, 25
#: Gradients and Hessians of a fold are rounded to its weight divided by two to this power. Entries of a tree that are looked at together.
EXACT_BITS, ENTRIES = 50, 1 << 18
SEED = 42


# ------------------------------------------------------------------- binning


def _edges(rows) -> dict[int, list[np.ndarray]]:
    """Cuts of each feature of each fold: quantiles of its values other than zero, and cuts on either side of zero."""
    return _edges_and_units(rows)[0]


def _edges_and_units(rows) -> tuple[dict[int, list[np.ndarray]], dict[int, float]]:
    """`_edges`, and the power of two that each fold's gradients and Hessians are whole multiples of: sums over all its rows are then exact, whatever their order."""

    def span(block: Block) -> dict:
        if not block.learn:
            return {}
        low, high = np.full(block.size, np.inf), np.full(block.size, -np.inf)
        np.minimum.at(low, block.features, block.values)
        np.maximum.at(high, block.features, block.values)
        return {block.fold: _Span(low, high, block.weights.sum())}

    spans = added(rows, span)

    def cells(block: Block) -> dict:
        if not block.learn:
            return {}
        low, width = spans[block.fold].low, spans[block.fold].width()
        at = np.clip(((block.values - low[block.features]) / width[block.features]).astype(np.int64), 0, CELLS - 1)
        return {block.fold: np.bincount(block.features.astype(np.int64) * CELLS + at, minlength=block.size * CELLS)}

    out = {}
    for fold, counts in added(rows, cells).items():
        low, high, width = spans[fold].low, spans[fold].high, spans[fold].width()
        running = counts.reshape(-1, CELLS).cumsum(axis=1)
        out[fold] = []
        for f, own in enumerate(running):
            if not own[-1]:
                out[fold].append(np.zeros(0))
                continue
            wanted = own[-1] * np.arange(1, BINS - 2) / (BINS - 2)
            cuts = low[f] + width[f] * (np.searchsorted(own, wanted) + 1)
            zero = [0.0] * bool(high[f] > 0) + [-1e-12] * bool(low[f] < 0)
            out[fold].append(np.unique(np.concatenate([cuts[cuts < high[f]], zero])))
    return out, {fold: 2.0 ** (np.ceil(np.log2(max(span.weight, 1e-300))) - EXACT_BITS) for fold, span in spans.items()}


@dataclass
class _Span:
    low: np.ndarray
    high: np.ndarray
    weight: float

    def __add__(self, other: "_Span") -> "_Span":
        return _Span(np.minimum(self.low, other.low), np.maximum(self.high, other.high), self.weight + other.weight)

    def width(self) -> np.ndarray:
        width = (self.high - self.low) / CELLS
        return np.where(np.isfinite(width) & (width > 0), width, 1.0)


@dataclass
class Binned:
    """Blocks of one fold by columns: entries of feature f are at starts[f]:starts[f + 1], by bin; zero_bin is the bin of rows without an entry.
    `parts` has the name and the rows of each block, `unit` what gradients are rounded to."""

    parts: list[tuple]
    fold: int
    starts: np.ndarray
    rows: np.ndarray
    bins: np.ndarray
    zero_bin: np.ndarray
    labels: np.ndarray
    weights: np.ndarray
    unit: float = 0.0

    def right_of(self, feature: int, cut: int) -> np.ndarray:
        """Whether each row goes to the right of a cut."""
        a, b = self.starts[feature], self.starts[feature + 1]
        out = np.full(len(self.labels), self.zero_bin[feature] > cut)
        out[self.rows[a:b]] = self.bins[a:b] > cut
        return out

    def counts(self) -> np.ndarray:
        """features x bins: the number of entries."""
        features = len(self.starts) - 1
        return np.bincount(np.repeat(np.arange(features) * BINS, np.diff(self.starts)) + self.bins, minlength=features * BINS).reshape(features, BINS)

    def sampled(self, round_: int, share: float) -> np.ndarray:
        """The rows of a round, drawn block by block."""
        return np.concatenate([np.random.default_rng([SEED, 1, round_, self.fold, *name]).random(n) < share for name, n in self.parts])


def _binned(name: tuple, block: Block, edges: list[np.ndarray], unit: float = 0.0) -> Binned:
    order = np.argsort(block.features, kind="stable")
    features, values = block.features[order].astype(np.int64), block.values[order]
    starts = np.searchsorted(features, np.arange(block.size + 1))
    bins = np.zeros(len(values), np.uint8)
    for f in np.unique(features).tolist():
        a, b = starts[f], starts[f + 1]
        bins[a:b] = np.searchsorted(edges[f], values[a:b])  # x > edge goes right
    zero = np.array([np.searchsorted(e, 0.0) for e in edges], np.uint8)
    rows = block.rows()[order].astype(np.int32)
    by_bin = np.argsort(features * BINS + bins, kind="stable")
    return Binned([(name, len(block))], block.fold, starts, rows[by_bin], bins[by_bin], zero, block.labels, block.weights, unit)


def _merged(parts: list[Binned]) -> Binned:
    """Blocks of one fold as one."""
    first = parts[0]
    if len(parts) == 1:
        return first
    begins = np.concatenate([[0], np.cumsum([len(p.labels) for p in parts])])
    starts = np.sum([p.starts for p in parts], axis=0)
    rows, bins = np.empty(starts[-1], np.int32), np.empty(starts[-1], np.uint8)
    for f in range(len(starts) - 1):
        own = np.concatenate([p.bins[p.starts[f] : p.starts[f + 1]] for p in parts])
        order = np.argsort(own, kind="stable")
        rows[starts[f] : starts[f + 1]] = np.concatenate([p.rows[p.starts[f] : p.starts[f + 1]] + a for p, a in zip(parts, begins)])[order]
        bins[starts[f] : starts[f + 1]] = own[order]
    labels, weights = (np.concatenate([getattr(p, c) for p in parts]) for c in ("labels", "weights"))
    return Binned([x for p in parts for x in p.parts], first.fold, starts, rows, bins, first.zero_bin, labels, weights, first.unit)


# ------------------------------------------------------------------- growing


@dataclass
class Tree:
    """Nodes as in a heap (children of i: 2 i + 1, 2 i + 2); feature is -1 at a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    @staticmethod
    def of_depth(depth: int) -> "Tree":
        n = 2 ** (depth + 1) - 1
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n))


def _descend(block: Binned, tree: Tree, place: np.ndarray, level: int) -> None:
    """Moves rows from the nodes of a level to their children."""
    nodes = np.arange(2**level - 1, 2 ** (level + 1) - 1)
    nodes = nodes[tree.feature[nodes] >= 0]
    to = np.arange(len(tree.feature), dtype=place.dtype)
    to[nodes] = 2 * nodes + 1 + (block.zero_bin[tree.feature[nodes]] > tree.cut[nodes])  # where rows without an entry go
    before = place.copy()
    place[:] = to[before]
    for node in nodes.tolist():
        a, b = block.starts[tree.feature[node]], block.starts[tree.feature[node] + 1]
        rows = block.rows[a:b]
        own = before[rows] == node
        place[rows[own]] = 2 * node + 1 + (block.bins[a:b][own] > tree.cut[node])


class _Held:
    """What a task keeps of a block between jobs: margins after `round_` rounds, and places of rows after `level` levels of the next."""

    def __init__(self, block: Binned, classes: int):
        self.round_, self.margins, self.counts = 0, np.zeros((len(block.labels), classes)), block.counts()
        self.begin(block)

    def begin(self, block: Binned):
        self.level, self.places = 0, [np.zeros(len(block.labels), np.int32) for _ in range(self.margins.shape[1])]
        self.slopes, self.entries = None, {}

    def brought_to(self, block: Binned, done: list, current: list[Tree], round_: int, level: int, depth: int) -> "_Held":
        while self.round_ < round_:
            trees = done[self.round_].value[block.fold]
            for c, tree in enumerate(trees):
                for k in range(self.level, depth):
                    _descend(block, tree, self.places[c], k)
            self.end(block, trees)
        while self.level < level:
            for c, tree in enumerate(current):
                _descend(block, tree, self.places[c], self.level)
            self.level += 1
        return self

    def end(self, block: Binned, trees: list[Tree]) -> None:
        """The end of a round, when all rows are at the leaves of its trees."""
        for c, tree in enumerate(trees):
            self.margins[:, c] += tree.value[self.places[c]]
        self.round_ += 1
        self.begin(block)

    def derivatives(self, block: Binned) -> tuple[np.ndarray, np.ndarray]:
        if self.slopes is None:
            e = np.exp(self.margins - self.margins.max(axis=1, keepdims=True))
            p = e / e.sum(axis=1, keepdims=True)
            bend = np.maximum(2 * p * (1 - p), 1e-16) * block.weights[:, None]
            p[np.arange(len(p)), block.labels] -= 1
            slopes = p * block.weights[:, None], bend
            self.slopes = tuple(np.asfortranarray(np.rint(d / block.unit) * block.unit if block.unit else d) for d in slopes)
        return self.slopes

    def entries_of(self, block: Binned, c: int, level: int, chosen: np.ndarray, sampled: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows and cells (place among the chosen features x BINS + bin) of the entries of chosen features, by cell, the cells that have any, and where each begins:
        the same on all levels of a tree, held until its last. Rows that are not sampled are in no node."""
        if c not in self.entries or level == 0:
            counts = self.counts[chosen].ravel()
            begins = counts.cumsum() - counts
            filled = np.flatnonzero(counts)
            ends = zip(block.starts[chosen].tolist(), block.starts[chosen + 1].tolist())
            rows = np.concatenate([block.rows[a:b] for a, b in ends])
            self.entries[c] = rows, np.repeat(np.arange(len(counts), dtype=np.int32), counts), filled, begins[filled]
        return self.entries[c]


#: Of one training run at a time: block name -> _Held. Only spares work; see `brought_to`.
_HELD: dict[str, dict] = {}


def _sums(block: Binned, held: _Held, c: int, level: int, open_: np.ndarray, chosen: np.ndarray, sampled: np.ndarray) -> np.ndarray:
    """Sums of gradient and Hessian as 2 x open nodes x chosen features x bins; rows without an entry are in the bin of zero."""
    slopes = [d[:, c] for d in held.derivatives(block)]
    of_node = np.full(2**level, -1, np.int16)
    of_node[open_] = np.arange(len(open_))
    index = held.places[c] - (2**level - 1)
    node = np.where((index >= 0) & sampled, of_node[np.maximum(index, 0)], np.int16(-1))
    rows, cell, filled, begins = held.entries_of(block, c, level, chosen, sampled)
    cells, inside = len(chosen) * BINS, node >= 0
    out = np.zeros((2, len(open_), cells))
    if level == 0:  # all sampled rows: sums of stretches, as entries are in the order of their cells
        slopes = [np.where(inside, d, 0.0) for d in slopes]
        ends = np.append(begins, len(rows))
        a = 0
        while a < len(filled):
            b = max(a + 1, int(np.searchsorted(ends, begins[a] + ENTRIES, "right")) - 1)
            some = rows[begins[a] : ends[b]].astype(np.intp)
            for i, d in enumerate(slopes):
                out[i, 0, filled[a:b]] = np.add.reduceat(d[some], begins[a:b] - begins[a])
            a = b
    else:
        used, at = [], []
        for a in range(0, len(rows), ENTRIES):
            own = node[rows[a : a + ENTRIES]]
            some = np.flatnonzero(own >= 0)
            used.append(rows[a : a + ENTRIES][some])
            at.append(own[some].astype(np.int64) * cells + cell[a : a + ENTRIES][some])
        if used:
            used, at = np.concatenate(used), np.concatenate(at)
            for i, d in enumerate(slopes):
                out[i] = np.bincount(at, d[used], minlength=len(open_) * cells).reshape(len(open_), cells)
    out = out.reshape(2, len(open_), len(chosen), BINS)
    for i, d in enumerate(slopes):
        total = np.bincount(node[inside], d[inside], minlength=len(open_))
        zero = block.zero_bin[chosen]
        out[i][:, np.arange(len(chosen)), zero] += total[:, None] - out[i].sum(axis=2)
    return out


def _best(sums: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """gain, feature, cut, left gradient and Hessian, gradient and Hessian of each open node."""
    out = np.empty((sums.shape[1], 7))
    for node, (gradients, hessians) in enumerate(zip(*sums)):  # one node's numbers stay in a core's cache
        g, h = gradients[0].sum(), hessians[0].sum()
        left_g, left_h = (np.ascontiguousarray(x.T).cumsum(axis=0)[:-1] for x in (gradients, hessians))
        right_g, right_h = g - left_g, h - left_h
        gain = left_g**2 / (left_h + PENALTY) + right_g**2 / (right_h + PENALTY) - g**2 / (h + PENALTY)
        gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = -np.inf
        column, cut = divmod(int(gain.T.argmax()), BINS - 1)  # the first feature of the best, then its first cut
        out[node] = gain[cut, column], chosen[column], cut, left_g[cut, column], left_h[cut, column], g, h
    return out


def _grown(block: Binned, held: _Held, c: int, depth: int, rate: float, chosen: np.ndarray, sampled: np.ndarray) -> Tree:
    """The next tree of a class, where one task has all rows of the fold; their places are left at its leaves.

    Of two children the entries of the smaller one alone are added up: sums are exact, so those of the other are what is left of their parent's."""
    tree, place, open_, above = Tree.of_depth(depth), held.places[c], [0], {}
    for level in range(depth):
        if level == 0:
            sums = {0: _sums(block, held, c, 0, np.array([0]), chosen, sampled)[:, 0]}
        else:
            index = place[sampled] - (2**level - 1)
            count = np.bincount(index[index >= 0], minlength=2**level)
            smaller = [min((2 * i, 2 * i + 1), key=lambda k: count[k]) for i in sorted({k // 2 for k in open_})]
            sums = {}
            for k, own in zip(smaller, _sums(block, held, c, level, np.array(smaller), chosen, sampled).swapaxes(0, 1)):
                if k in open_:
                    sums[k] = own
                if k ^ 1 in open_:
                    sums[k ^ 1] = above[k // 2] - own
        found = [_best(sums[k][:, None], chosen)[0] for k in open_]
        open_, above = _split(tree, level, np.array(open_), found, rate), sums
        _descend(block, tree, place, level)
        if not open_:
            break
    held.entries.pop(c, None)
    return tree


def _drawn(features: int, share: float, *key: int) -> np.ndarray:
    return np.sort(np.random.default_rng([SEED, *key]).permutation(features)[: max(1, round(share * features))])


def grow(rows, sizes: dict[int, tuple[int, int]], classes: int, rounds: int, depth: int, rate: float, sample: float, columns: float) -> dict[int, "Trees"]:
    """The trees of each fold. Each round draws the share `sample` of the rows, each tree the share `columns` of the features."""
    context, run = rows.context, uuid.uuid4().hex
    edges, units = _edges_and_units(rows)
    sent_edges = context.broadcast(edges)
    learning = rows.filter(lambda b: b.learn)
    together = max(n for _, n in sizes.values()) <= ROWS_TOGETHER
    binned_rows = learning.map(lambda b: _binned((), b, sent_edges.value[b.fold], units[b.fold]))
    if together:  # a fold's rows in one task
        numbers = {f: i for i, f in enumerate(sorted(sizes))}
        binned_rows = binned_rows.keyBy(lambda b: b.fold).partitionBy(len(numbers), lambda f: numbers[f]).values()

    def merged(part: int, blocks):
        of_fold: dict = {}
        for i, b in enumerate(blocks):
            b.parts = [((part, i), len(b.labels))]
            of_fold.setdefault(b.fold, []).append(b)
        for own in of_fold.values():
            yield _merged(own)

    held_rows = binned_rows.mapPartitionsWithIndex(merged).persist(StorageLevel.MEMORY_AND_DISK)
    done: list = []

    def held_of(b: Binned, before: list, current: list[Tree], round_: int, level: int) -> _Held:
        if run not in _HELD:
            _HELD.clear()
            _HELD[run] = {}
        name = b.fold, b.parts[0][0]
        own = _HELD[run].get(name)
        if own is None or (own.round_, own.level) > (round_, level):
            own = _HELD[run][name] = _Held(b, classes)
        return own.brought_to(b, before, current, round_, level, depth)

    def summed(b: Binned, open_: dict, round_: int, level: int, current: dict, before: list) -> dict:
        """(fold, class) to the sums of its open nodes over one block."""
        own = held_of(b, before, current[b.fold], round_, level)
        sampled = b.sampled(round_, sample)
        asked = [c for c in range(classes) if (b.fold, c) in open_]
        return {(b.fold, c): _sums(b, own, c, level, open_[b.fold, c], _drawn(len(b.starts) - 1, columns, round_, c, b.fold), sampled) for c in asked}

    def best_of(key: tuple[int, int], sums: np.ndarray, round_: int) -> np.ndarray:
        return _best(sums, _drawn(sizes[key[0]][0], columns, round_, key[1], key[0]))

    def one_round(round_: int, folds_: list[int], found_at) -> dict[int, list[Tree]]:
        """One tree for each class of each fold; `found_at` gives the best splits of the open nodes of a level."""
        current = {f: [Tree.of_depth(depth) for _ in range(classes)] for f in folds_}
        open_ = {(f, c): np.array([0]) for f in folds_ for c in range(classes)}
        for level in range(depth):
            found = found_at(open_, round_, level, current)
            split = {(f, c): _split(current[f][c], level, nodes, found.get((f, c), ()), rate) for (f, c), nodes in open_.items()}
            open_ = {k: np.array(nodes) for k, nodes in split.items() if nodes}
            if not open_:
                break
        return current

    def over_all(open_, round_, level, current):
        parts = held_rows.mapPartitions(lambda blocks: _added(summed(b, open_, round_, level, current, done) for b in blocks).items())
        return dict(parts.reduceByKey(lambda a, b: a + b, len(open_)).map(lambda x: (x[0], best_of(*x, round_))).collect())

    def rounds_here(blocks, first: int, last: int):
        own = next(iter(blocks), None)  # all rows of one fold
        if own is None:
            return []
        held, made = held_of(own, done, [], first, 0), []
        for round_ in range(first, last):
            sampled = own.sampled(round_, sample)
            made.append([_grown(own, held, c, depth, rate, _drawn(len(own.starts) - 1, columns, round_, c, own.fold), sampled) for c in range(classes)])
            held.end(own, made[-1])
        return [(own.fold, made)]

    for first in range(0, rounds, ROUNDS_A_JOB if together else 1):
        last = min(rounds, first + ROUNDS_A_JOB)
        if together:
            of_fold = dict(held_rows.mapPartitions(lambda blocks, first=first, last=last: rounds_here(blocks, first, last)).collect())
            made = [{f: trees[i] for f, trees in of_fold.items()} for i in range(last - first)]
        else:
            made = [one_round(first, list(sizes), over_all)]
        done += [context.broadcast(m) for m in made]
    held_rows.unpersist()
    return {f: Trees.of([d.value[f] for d in done], edges[f]) for f in sizes}


@dataclass
class _Here:
    """Trees of a round that the task itself has grown, in the shape of broadcast ones."""

    value: dict[int, list[Tree]]


def _added(parts) -> dict:
    out: dict = {}
    for part in parts:
        for key, sums in part.items():
            out[key] = out[key] + sums if key in out else sums
    return out


def _split(tree: Tree, level: int, nodes: np.ndarray, found, rate: float) -> list[int]:
    """Puts the best splits into a tree; the children that may be split further, by their place in the next level."""
    split = []
    for index, (gain, feature, cut, left_g, left_h, g, h) in zip(nodes, found):
        node = 2**level - 1 + index
        if level == 0:
            tree.value[0] = -rate * g / (h + PENALTY)
        if not gain > 1e-6:
            continue
        tree.feature[node], tree.cut[node] = feature, cut
        for child, (cg, ch) in ((2 * node + 1, (left_g, left_h)), (2 * node + 2, (g - left_g, h - left_h))):
            tree.value[child] = -rate * cg / (ch + PENALTY)
            if ch >= 2 * LEAST_HESSIAN:
                split.append(child - (2 ** (level + 1) - 1))
    return split


# ------------------------------------------------------------------- applying


@dataclass
class Trees:
    """Trees of all rounds and classes (rounds x classes x nodes), with values to be compared instead of bins."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    @staticmethod
    def of(rounds: list[list[Tree]], edges: list[np.ndarray]) -> "Trees":
        stack = lambda a: np.array([[getattr(t, a) for t in trees] for trees in rounds])
        feature, cut = stack("feature"), stack("cut")
        threshold = np.zeros(feature.shape)
        for at in zip(*np.nonzero(feature >= 0)):
            threshold[at] = edges[feature[at]][cut[at]]
        return Trees(feature, threshold, stack("value"))

    def margins(self, rows: np.ndarray, features: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """n x classes, of rows given by their entries."""
        known = np.unique(self.feature[self.feature >= 0])
        out = np.zeros((n, self.feature.shape[1]))
        place = np.searchsorted(known, features)
        place[place == len(known)] = 0
        used = (known[place] == features) if len(known) else np.zeros(len(features), bool)
        dense = np.zeros((n, max(1, len(known))))
        dense[rows[used], place[used]] = values[used]
        every, depth = np.arange(n), int(np.log2(self.feature.shape[2] + 1)) - 1
        for trees in range(len(self.feature)):
            for c in range(out.shape[1]):
                feature, threshold = self.feature[trees, c], self.threshold[trees, c]
                column = np.searchsorted(known, np.maximum(feature, 0)) if len(known) else np.zeros(len(feature), int)
                column = np.minimum(column, max(0, len(known) - 1))
                node = np.zeros(n, np.int64)
                for _ in range(depth):
                    inner = feature[node] >= 0
                    if not inner.any():
                        break
                    node = np.where(inner, 2 * node + 1 + (dense[every, column[node]] > threshold[node]), node)
                out[:, c] += self.value[trees, c][node]
        return out


def confusion(rows, trees: dict[tuple[int, int], Trees], classes: int) -> dict[tuple[int, int], np.ndarray]:
    """actual x predicted counts of the held-out rows, by (setting, fold)."""

    def of_block(block: Block) -> dict:
        out = {}
        for (i, fold), own in trees.items():
            if not block.learn and block.fold == fold:
                predicted = own.margins(block.rows(), block.features, block.values, len(block)).argmax(axis=1)
                out[i, fold] = np.bincount(block.labels * classes + predicted, minlength=classes * classes).reshape(classes, classes)
        return out

    return added(rows, of_block)


class BoostedTreesModel(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """`features` to `rawPrediction` (margins, an array), `probability` and `prediction`."""

    trees = Param(Params._dummy(), "trees", "features, thresholds and values as JSON", TypeConverters.toString)

    def __init__(self):
        super().__init__()

    @staticmethod
    def of(trees: Trees) -> "BoostedTreesModel":
        text = json.dumps([trees.feature.tolist(), trees.threshold.tolist(), trees.value.tolist()])
        return BoostedTreesModel()._set(trees=text)

    def fitted(self) -> Trees:
        return Trees(*(np.array(x) for x in json.loads(self.getOrDefault(self.trees))))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        trees = self.fitted()

        @F.pandas_udf("array<double>")
        def margins(vectors: pd.DataFrame) -> pd.Series:
            out = []
            for a in range(0, len(vectors), 1000):
                parts = [sparse(*x) for x in vectors.iloc[a : a + 1000][["type", "size", "indices", "values"]].itertuples(index=False)]
                rows = np.repeat(np.arange(len(parts)), [len(p[1]) for p in parts])
                out += trees.margins(rows, np.concatenate([p[1] for p in parts]), np.concatenate([p[2] for p in parts]), len(parts)).tolist()
            return pd.Series(out)

        out = dataset.withColumn("rawPrediction", margins(F.unwrap_udt("features")))
        powers = F.transform("rawPrediction", lambda m: F.exp(m - F.array_max("rawPrediction")))
        total = F.aggregate(powers, F.lit(0.0), lambda a, x: a + x)
        first = F.array_position(F.col("rawPrediction"), F.array_max("rawPrediction")) - 1
        return out.withColumn("probability", array_to_vector(F.transform(powers, lambda p: p / total))).withColumn("prediction", first.cast("double"))
