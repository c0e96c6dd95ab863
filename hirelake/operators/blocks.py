"""Training vectors as numpy blocks, for learners that go over all rows again and again.

A learner's step is one job: a function of each block, added up over blocks. Blocks are read from a written table and held by the
executors (memory, else disk); a lost one is read again. Rows of several folds stand in one table, so one job steps all folds at once.
"""

import pickle
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.sources.stages import materialize

#: Partitions whose results are added on the driver at once; more are added among executors first.
ADDED_AT_ONCE = 16
#: Entries that are multiplied together, so that their products stay in a core's cache.
ENTRIES = 1 << 17


@dataclass
class Block:
    """Rows of one fold in sparse form: row i holds values[offsets[i]:offsets[i + 1]] at the features of the same places. Features have the
    smallest type that holds them: a learner's steps are read from the store again and again, and cost by the byte."""

    fold: int
    learn: bool
    size: int
    offsets: np.ndarray
    features: np.ndarray
    values: np.ndarray
    labels: np.ndarray
    weights: np.ndarray

    def __len__(self) -> int:
        return len(self.labels)

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), np.diff(self.offsets))

    def _stretches(self):
        """First and last row, places of features as numpy's own index type, and values of stretches of rows."""
        a, n = 0, len(self)
        while a < n:
            b = min(n, max(a + 1, int(np.searchsorted(self.offsets, self.offsets[a] + ENTRIES, "right")) - 1))
            some = slice(self.offsets[a], self.offsets[b])
            yield a, b, self.features[some].astype(np.intp, copy=False), self.values[some]
            a = b

    def times(self, matrix: np.ndarray) -> np.ndarray:
        """rows x columns: the block times a matrix of features x columns."""
        columns, out = np.ascontiguousarray(matrix.T), np.zeros((matrix.shape[1], len(self)))
        for a, b, features, values in self._stretches():
            rows = np.repeat(np.arange(b - a), np.diff(self.offsets[a : b + 1]))
            for c, column in enumerate(columns):
                out[c, a:b] = np.bincount(rows, column[features] * values, minlength=b - a)
        return np.ascontiguousarray(out.T)

    def transposed_times(self, matrix: np.ndarray) -> np.ndarray:
        """features x columns: the block's columns times a matrix of rows x columns."""
        features, lengths = self.features.astype(np.intp, copy=False), np.diff(self.offsets)
        out = []
        for column in np.ascontiguousarray(matrix.T):
            products = np.repeat(column, lengths)
            products *= self.values
            out.append(np.bincount(features, products, minlength=self.size))  # at once: stretches would add up in another order
        return np.stack(out, axis=1)


def sparse(kind, size, indices, values):
    """(size, features, values) of one ML vector, dense (kind 1) or sparse."""
    if kind == 1:
        values = np.asarray(values, dtype=float)
        at = np.flatnonzero(values)
        return len(values), at, values[at]
    return size, np.asarray(indices, dtype=np.int64), np.asarray(values, dtype=float)


def blocks_of(vectors: DataFrame):
    """RDD of blocks of `vectors` (fold int, learn boolean, label, weight, features)."""
    v = F.unwrap_udt("features")
    plain = vectors.select("fold", "learn", "label", "weight", *[v[c].alias(c) for c in ("type", "size", "indices", "values")])

    def pack(batches):
        for batch in batches:
            columns = {c: batch.column(c) for c in batch.schema.names}
            fold, learn = columns["fold"].to_numpy(), columns["learn"].to_numpy(zero_copy_only=False)
            parts = [sparse(*x) for x in zip(*(columns[c].to_pylist() for c in ("type", "size", "indices", "values")))]
            made = []
            for f, own in sorted(set(zip(fold.tolist(), learn.tolist()))):
                at = np.flatnonzero((fold == f) & (learn == own))
                some = [parts[i] for i in at]
                size = int(some[0][0])
                features = np.concatenate([p[1] for p in some]).astype(np.min_scalar_type(max(0, size - 1)))
                block = Block(
                    int(f), bool(own), size, np.concatenate([[0], np.cumsum([len(p[1]) for p in some])]), features,
                    np.concatenate([p[2] for p in some]), columns["label"].to_numpy()[at].astype(np.int64), columns["weight"].to_numpy()[at],
                )
                made.append(pickle.dumps(block))
            yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["block"])

    packed = materialize(plain.mapInArrow(pack, "block binary"), "blocks")
    return packed.rdd.map(lambda r: pickle.loads(r["block"])).persist(StorageLevel.MEMORY_AND_DISK)


def added(blocks, of_block: Callable[[Block], dict]) -> dict:
    """key -> sum over all blocks of the arrays that `of_block` gives."""

    def plus(a: dict, b: dict) -> dict:
        for key, value in b.items():
            a[key] = a[key] + value if key in a else value
        return a

    def partial(part):
        out: dict = {}
        for block in part:
            plus(out, of_block(block))
        return [out]

    parts = blocks.mapPartitions(partial)
    return parts.reduce(plus) if parts.getNumPartitions() <= ADDED_AT_ONCE else parts.treeReduce(plus)
