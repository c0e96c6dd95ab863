import math
from fractions import Fraction

import numpy as np
import pytest

from hirelake.llm import exact_search, near_search, queries
from hirelake.llm import vectors as v

ODD = [
    (1, None), (2, []), (3, [1.0, None]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, [0.0, 0.0]), (7, [1.0, 0.5]), (8, [1.0, 0.5]),
    (8, [1.0, 0.5]), (50, [1.0, 1.0]), (100, [-0.001, 2.0]), (9, [3.0, 3.0]), (10, [1.0, 2.0, 3.0]), (150, [1.0, 2.0, 3.0]), (None, [9.0, 9.0]), (200, [1e20, 1.0]),
]
SCHEMA = "vec_id long, embedding array<float>, vector string, dim string, score int"


def frame(spark, rows):
    return spark.createDataFrame([(i, e, "x", "y", 1) for i, e in rows], SCHEMA)


def ranked(df):
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect())


def plain(rows, step, k, value, keep, score):
    seen = {i: value(e) for i, e in rows if i is not None and e and all(x is not None and np.isfinite(x) for x in e)}
    seen = {i: x for i, x in seen.items() if keep(x)}
    out = []
    for q, x in seen.items():
        if q % step == 0:
            others = sorted((-score(x, y), i) for i, y in seen.items() if i != q and len(y) == len(x))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(others[:k])]
    return sorted(out)


def quantise(e):
    return [math.floor(256 * Fraction(float(np.float32(x)))) for x in e]


def dot(x, y):
    return sum(a * b for a, b in zip(x, y))


def test_exact_odd(spark):
    df = frame(spark, ODD)
    expected = plain(ODD, 50, 5, quantise, lambda x: True, within)
    assert ranked(exact_search.top_k(df.where("vec_id % 50 = 0"), df)) == expected
    assert len(expected) > 5 and 200 in {r[0] for r in expected}


def within(x, y):
    return min(max(dot(x, y), -(2**63)), 2**63 - 1)


def test_long_vectors_have_their_scores(spark):
    rows = [(50, [1e10, 0.0]), (2, [1e7, 0.0]), (1, [1.0, 1.0]), (100, [0.5, 0.5]), (3, [-1e10, 1.0]), (4, [1e30, 0.0]), (150, [3e38, -3e38]), (5, [2.0**51 + 1, 0.5])]
    df = frame(spark, rows)
    got = ranked(exact_search.top_k(df.where("vec_id % 50 = 0"), df))
    assert got == plain(rows, 50, 5, quantise, lambda x: True, within)
    assert [r[2] for r in got if r[0] == 100][:3] == [4, 5, 50] and {r[3] for r in got if r[0] == 50} >= {2**63 - 1}


@pytest.mark.parametrize("least, held, asked", [(2048, 32768, 8192), (30, 64, 7)])
def test_exact_random(spark, monkeypatch, least, held, asked):
    for name, value in (("LEAST_ROWS", least), ("ROWS_PER_BLOCK", held), ("QUERIES_PER_BLOCK", asked)):
        monkeypatch.setattr(v, name, value)
    rng = np.random.default_rng(3)
    rows = [(i, x.tolist()) for i, x in enumerate((rng.standard_normal((400, 20)) / 4).astype(np.float32))]
    rows += [(1000 + i, rows[0][1]) for i in range(30)]
    df = frame(spark, rows)
    assert ranked(exact_search.top_k(df.where("vec_id % 50 = 0"), df)) == plain(rows, 50, 5, quantise, bool, dot)


def test_near_odd(spark):
    rows = [r for r in ODD if r[0] != 200]
    df = frame(spark, rows)
    got = ranked(near_search.nearest(df.where("vec_id % 50 = 0"), df))
    assert got == plain(rows, 50, 20, lambda e: [float(np.float32(x)) for x in e], any, dot)  # fewer than k: all


def test_nothing(spark):
    df = frame(spark, ODD)
    assert exact_search.top_k(df.limit(0), df).count() == 0
    assert near_search.nearest(df.limit(0), df.limit(0)).count() == 0


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.1"])
def test_near_recall(spark, folder):
    path = f"/root/testdata/{folder}"
    out = ranked(queries.QUERIES["op6_near_search"](spark, path))
    rows = spark.read.parquet(f"{path}/embeddings.parquet").toPandas()
    ids, m = rows["vec_id"].to_numpy(), np.stack(rows["embedding"]).astype(np.float64)
    place = {i: at for at, i in enumerate(ids)}
    got = {}
    for q, _, i, s in out:
        assert s == pytest.approx(m[place[q]] @ m[place[i]], abs=1e-12)
        got.setdefault(q, set()).add(i)
    hit = total = 0
    for q in ids[ids % 20 == 0]:
        s = m @ m[place[q]]
        s[place[q]] = -np.inf
        best = set(ids[np.argsort(-s, kind="stable")[:20]])
        hit, total = hit + len(best & got[q]), total + len(best)
        assert len(got[q]) == 20
    assert hit / total >= 0.95


def test_copies_tie_by_id(spark):
    rows = [(i, [0.1, 0.7, -0.3]) for i in range(300)]
    got = ranked(near_search.nearest(frame(spark, rows[:1]), frame(spark, rows), k=20))
    assert [r[2] for r in got] == list(range(1, 21))
