"""Exact top-k inner products by branch and bound over dimension blocks in vertical layout.

A block of vectors is kept dimension by dimension. For a query the dimensions are taken in order of the query's mass, a few at a
time. What is still to come of a candidate's score is at most the product of the remaining lengths of query and candidate, so
after each step every candidate has a lower and an upper bound; those whose upper bound is below the k-th best lower bound go, and
the arrays are compacted. Who is left after the last step has its exact score.
"""

import math

import numpy as np
from pyspark.sql import DataFrame

from hirelake.llm import vectors as v

#: Dimensions that are added between two rounds of bounds.
STEP = 8
#: Products of two vectors whose squared lengths are below this fit 64 bits; those of larger ones are worked out in whole numbers of any size.
MOST_MASS = 2.0**62
LEAST_SCORE, MOST_SCORE = -(2**63), 2**63 - 1


def exact_rows(rows: np.ndarray, levels: int) -> np.ndarray:
    """floor(levels * x) of each component as a Python integer; doubles from 2^52 on are whole already."""
    whole = [[int(x) * levels if abs(x) >= 2.0**52 else math.floor(x * levels) for x in row] for row in rows.tolist()]
    return np.array(whole, dtype=object).reshape(rows.shape)


def _within(scores: np.ndarray) -> np.ndarray:
    """Scores of any size, those beyond 64 bits as the nearest that has them."""
    return np.array([min(max(s, LEAST_SCORE), MOST_SCORE) for s in scores], dtype=np.int64)


def search_block(query_ids, queries, ids, rows, k: int, levels: int = 256):
    """(query row, id, score) of the k highest integer inner products of each query with other ids' rows."""
    with np.errstate(over="ignore"):
        asked, whole = np.floor(queries * levels), np.floor(rows * levels)
        usual, usual_query = ((x**2).sum(axis=1) < MOST_MASS for x in (whole, asked))
    columns = np.ascontiguousarray(whole[usual].T.astype(np.int64))  # vertical: one dimension after the other
    squares = (columns.astype(np.float64) ** 2).sum(axis=0)
    usual_ids, wide_ids, wide = ids[usual], ids[~usual], exact_rows(rows[~usual], levels)
    found = ([], [], [])
    for i, own in enumerate(query_ids):
        if usual_query[i]:
            near, score = _best_bounded(own, asked[i].astype(np.int64), usual_ids, columns, squares, k)
        else:
            near = usual_ids[usual_ids != own]
            score = _within(columns.T[usual_ids != own].astype(object) @ exact_rows(queries[i : i + 1], levels)[0]) if len(near) else np.zeros(0, np.int64)
        if (others := wide_ids != own).any():
            near = np.concatenate([near, wide_ids[others]])
            score = np.concatenate([score, _within(wide[others] @ exact_rows(queries[i : i + 1], levels)[0])])
        top = v.best_of(near, score, k)
        found[0].append(np.full(len(top), i))
        found[1].append(near[top])
        found[2].append(score[top])
    return tuple(np.concatenate(f) if f else np.zeros(0, np.int64) for f in found)


def _best_bounded(own, query: np.ndarray, ids: np.ndarray, columns: np.ndarray, squares: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) among which the k best are, by bounds that drop the others."""
    mass = query.astype(np.float64) ** 2
    order = np.argsort(-mass, kind="stable")
    left = np.flatnonzero(ids != own)
    score = np.zeros(len(left), dtype=np.int64)
    open_mass = squares[left]
    for at in range(0, len(order), STEP):
        for d in order[at : at + STEP]:
            x = columns[d, left]
            score += query[d] * x
            open_mass = open_mass - x.astype(np.float64) ** 2
        to_come = mass[order[at + STEP :]].sum()
        if not to_come or len(left) <= k:
            continue
        reach = np.sqrt(to_come * np.maximum(open_mass, 0.0)) * (1 + 1e-9) + 1.0
        low = score - reach
        least = np.partition(low, len(low) - k)[len(low) - k]
        stay = np.flatnonzero(score + reach >= least)
        if len(stay) < len(left):
            left, score, open_mass = left[stay], score[stay], open_mass[stay]
    return ids[left], score


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5, levels: int = 256) -> DataFrame:
    """query_id, rank, vec_id, score (long): each query's k highest integer inner products with all other vectors.

    `queries` and `vectors` have vec_id, embedding. Null vectors and ones with null or non-finite components take no part.
    A product beyond 64 bits counts as the nearest score that has them. A query never meets its own vec_id. Fewer candidates than k
    give all of them; ties go to the smaller vec_id; without vectors or queries there are no rows.
    """
    return v.search_blocks(v.usable(queries), v.usable(vectors), lambda *a: search_block(*a, k, levels), k, "bigint")
