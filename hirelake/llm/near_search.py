"""Approximate nearest neighbours by a hash-prefix forest.

Each tree gives every vector a string of hash bits (sides of random hyperplanes) and keeps the strings sorted. A query descends
to its longest matching prefix in each tree; then all trees ascend together, a level at a time, and the vectors that share the
shorter prefix become candidates. The ascent ends when a vector as near as the k-th best found so far would have been met in some tree with
probability 1 - `miss`: it stops early where near vectors exist and goes on where there are none, at any table size.
Inner products become angles by one more component that brings all vectors of a block to one length.
"""

import functools

import numpy as np
from pyspark.sql import DataFrame

from hirelake.llm import vectors as v

TREES = 24
BITS = 64
#: Prefix lengths at which the trees stop on their way up.
LEVELS = (64, 48, 40, 32, 26, 22, 19, 16, 14, 12, 11, 10, 9, 8, 7, 6, 5, 4, 3, 2, 1, 0)
MISS = 0.03


@functools.lru_cache(maxsize=2)
def _planes(dim: int, trees: int) -> np.ndarray:
    """Normals of the hyperplanes, the same in every task."""
    return np.random.default_rng(20_240 + dim).standard_normal((dim, trees * BITS)).astype(np.float32)


def hash_strings(vectors: np.ndarray, trees: int) -> np.ndarray:
    """trees x rows: the bits of each vector's string, the first bit highest."""
    sides = (vectors.astype(np.float32) @ _planes(vectors.shape[1], trees)) > 0
    packed = np.packbits(sides.reshape(len(vectors), trees, BITS), axis=2)
    return np.ascontiguousarray(packed).view(">u8").reshape(len(vectors), trees).T.astype(np.uint64)


def search_block(query_ids, queries, ids, rows, k: int, trees: int = TREES, miss: float = MISS):
    """(query row, id, score) of the k largest inner products found for each query."""
    lengths = np.linalg.norm(rows, axis=1)
    longest = lengths.max()
    unit = rows / longest
    rest = np.sqrt(np.maximum(0.0, 1.0 - (lengths / longest) ** 2))
    own_lengths = np.linalg.norm(queries, axis=1)
    strings = hash_strings(np.column_stack([unit, rest]), trees)
    asked = hash_strings(np.column_stack([queries / own_lengths[:, None], np.zeros(len(queries))]), trees)
    order = np.argsort(strings, axis=1, kind="stable")
    ordered = np.take_along_axis(strings, order, axis=1)

    spans = np.empty((len(LEVELS), trees, len(queries), 2), dtype=np.int64)
    for at, level in enumerate(LEVELS):
        below = np.uint64((1 << (BITS - level)) - 1)
        for t in range(trees):
            spans[at, t, :, 0] = np.searchsorted(ordered[t], asked[t] & ~below, side="left")
            spans[at, t, :, 1] = np.searchsorted(ordered[t], asked[t] | below, side="right")

    found = ([], [], [])
    for i, query in enumerate(queries):
        seen = np.zeros(len(rows), dtype=bool)
        seen[ids == query_ids[i]] = True
        near, scores = np.zeros(0, np.int64), np.zeros(0)
        total = -1
        for at, level in enumerate(LEVELS):
            reached = int((spans[at, :, i, 1] - spans[at, :, i, 0]).sum())
            if reached == total:
                fresh = near[:0]
            else:
                total = reached
                met = np.concatenate([order[t, spans[at, t, i, 0] : spans[at, t, i, 1]] for t in range(trees)])
                met = met[~seen[met]]
                seen[met] = True
                fresh = np.unique(met)
            if len(fresh):
                near, scores = np.concatenate([near, fresh]), np.concatenate([scores, rows[fresh] @ query])
                if len(scores) > 8 * k:  # only what can still be among the best, with room for rounding
                    least = np.partition(scores, len(scores) - k)[len(scores) - k]
                    some = scores >= least - 1e-9 * max(1.0, abs(least))
                    near, scores = near[some], scores[some]
            if len(scores) >= k:
                kth = np.partition(scores, len(scores) - k)[len(scores) - k]
                angle = np.arccos(np.clip(kth / (own_lengths[i] * longest), -1.0, 1.0))
                if (1.0 - (1.0 - angle / np.pi) ** level) ** trees <= miss:
                    break
        exact = (rows[near] * query).sum(axis=1)  # one order of adding for all rows, so equal vectors tie
        top = v.best_of(ids[near], exact, k)
        found[0].append(np.full(len(top), i))
        found[1].append(ids[near][top])
        found[2].append(exact[top])
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def nearest(queries: DataFrame, vectors: DataFrame, k: int = 20, trees: int = TREES, miss: float = MISS) -> DataFrame:
    """query_id, rank, vec_id, score (double): the k vectors of largest inner product found for each query.

    `queries` and `vectors` have vec_id, embedding. Vectors that are null or zero, or hold null or non-finite components, take no
    part. A query never meets its own vec_id. Every vector is indexed; fewer candidates than k give all of
    them; ties go to the smaller vec_id; without vectors or queries there are no rows.
    """
    base, asked = (v.usable(df).where("exists(vector, x -> x <> 0)") for df in (vectors, queries))
    return v.search_blocks(asked, base, lambda *a: search_block(*a, k, trees, miss), k, "double")
