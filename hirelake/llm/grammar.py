"""Re-Pair over many short sequences at once: a shared grammar whose rules stand for pairs of symbols that often follow each other.

Sequences are arrays of symbols. Each round counts the neighbouring pairs of all sequences on Spark, takes the most frequent ones that cannot
overlap each other as new rules, and replaces them everywhere. The grammar has at most ROUNDS * RULES_A_ROUND rules, whatever the input.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Rounds of replacing, and new rules of one round at most.
ROUNDS, RULES_A_ROUND = 8, 32
#: Pairs that occur less often over all sequences get no rule.
LEAST_OFTEN = 4

_NONE = np.int64(-1)


def _alternate(same: np.ndarray) -> np.ndarray:
    """Of each run of true places the first, third, fifth, ...: pairs of one symbol with itself, without overlap."""
    first = same & ~np.concatenate([[False], same[:-1]])
    at = np.arange(len(same))
    begun = np.maximum.accumulate(np.where(first, at, -1))
    return same & ((at - begun) % 2 == 0)


def _joined(sequences: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All symbols with an end mark behind each sequence, and the place behind each mark."""
    size = np.diff(sequences.offsets.to_numpy())
    values = sequences.flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(size + 1)
    out = np.full(len(values) + len(size), _NONE)
    marks = np.zeros(len(out), dtype=bool)
    marks[ends - 1] = True
    out[~marks] = values
    return out, ends


def pair_counts(sequences: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """left, right, count of neighbouring symbols; a symbol's pairs with itself are counted without overlap."""
    symbols, _ = _joined(sequences)
    left, right = symbols[:-1], symbols[1:]
    counted = (left >= 0) & (right >= 0)
    same = counted & (left == right)
    counted &= ~same | _alternate(same)
    codes, often = np.unique(left[counted] << 32 | right[counted], return_counts=True)
    return codes >> 32, codes & 0xFFFFFFFF, often


def replace(sequences: pa.Array, rules: list[tuple[int, int, int]]) -> pa.Array:
    """The sequences with each pair (left, right) of `rules` (symbol, left, right) replaced by its symbol; the pairs must not overlap."""
    symbols, ends = _joined(sequences)
    if not len(symbols) or not rules:
        return sequences
    codes = np.array([left << 32 | right for _, left, right in rules])
    order = np.argsort(codes)
    names = np.array([s for s, _, _ in rules])[order]
    own = symbols[:-1] << 32 | np.maximum(symbols[1:], 0)
    at = np.minimum(np.searchsorted(codes[order], own), len(codes) - 1)
    hit = (codes[order][at] == own) & (symbols[:-1] >= 0) & (symbols[1:] >= 0)
    same = hit & (symbols[:-1] == symbols[1:])
    hit &= ~same | _alternate(same)
    out = symbols.copy()
    out[:-1][hit] = names[at[hit]]
    gone = np.concatenate([[False], hit])
    kept = out[~gone]
    marks = np.flatnonzero(kept == _NONE)
    offsets = np.concatenate([[0], marks + 1 - np.arange(1, len(marks) + 1)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(kept[kept != _NONE], pa.int32()))


def _without_overlap(found: list, most: int) -> list[tuple[int, int]]:
    """Of pairs by falling count those whose places cannot overlap: no symbol is right in one and left in another."""
    lefts, rights, alone, out = set(), set(), set(), []
    for left, right in found:
        used = lefts | rights
        if len(out) == most:
            break
        if left == right:
            if left in used:
                continue
            alone.add(left)
        elif left in rights or right in lefts or left in alone or right in alone:
            continue
        lefts.add(left)
        rights.add(right)
        out.append((left, right))
    return out


def compress(sequences: DataFrame, column: str, terminals: int) -> tuple[DataFrame, list[tuple[int, int]]]:
    """`sequences` with its array<int> `column` of symbols 0..terminals-1 rewritten, and the rules (left, right) of symbols terminals, terminals + 1, ...

    Ties between equally frequent pairs go to the smaller symbols, so a grammar does not depend on partitioning.
    """
    rules: list[tuple[int, int]] = []
    sequences = common.stored(sequences, "sequences")
    others = [c for c in sequences.columns if c != column]
    schema = sequences.schema

    def counted(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in pair_counts(batch.column(column))], ["left", "right", "often"])

    for _ in range(ROUNDS):
        pairs = sequences.select(column).mapInArrow(common.handing_back(counted), "left bigint, right bigint, often bigint")
        pairs = pairs.groupBy("left", "right").agg(F.sum("often").alias("often")).where(F.col("often") >= LEAST_OFTEN)
        best = pairs.orderBy(F.desc("often"), "left", "right").limit(8 * RULES_A_ROUND).collect()
        chosen = _without_overlap([(r["left"], r["right"]) for r in best], RULES_A_ROUND)
        if not chosen:
            break
        new = [(terminals + len(rules) + i, *pair) for i, pair in enumerate(chosen)]
        rules += chosen

        def rewritten(batches, new=new):
            for batch in batches:
                if batch.num_rows:
                    made = {**{c: batch.column(c) for c in others}, column: replace(batch.column(column), new)}
                    yield pa.RecordBatch.from_arrays([made[c] for c in batch.schema.names], batch.schema.names)

        sequences = common.stored(sequences.mapInArrow(common.handing_back(rewritten), schema), "sequences")
    return sequences, rules
