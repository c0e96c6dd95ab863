"""The solvers behind the classifiers against plain computations on dense numbers."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from hirelake.operators import blocks, boosting, linear

CLASSES = 3


def made_up(spark, n=90, features=6, folds=2, held=20, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for f in range(folds):
        for i in range(n + held):
            x = np.round(rng.normal(size=features) * (rng.random(features) < 0.6), 3)
            y = int(np.argmax([x[0] - x[1], x[1] * x[2], x[3] + 0.3]))
            v = Vectors.dense(x) if i % 2 else Vectors.sparse(features, np.flatnonzero(x).tolist(), x[x != 0].tolist())
            rows.append((f, i < n, float(y), float(rng.choice([0.5, 1.0, 2.0])) if i < n else 0.0, v, x.tolist()))
    df = spark.createDataFrame(rows, ["fold", "learn", "label", "weight", "features", "x"])
    df = df.withColumn("fold", F.col("fold").cast("int"))
    return rows, blocks.blocks_of(df.drop("x").repartition(3)), {f: (features, n) for f in range(folds)}


def of_fold(rows, fold, learn=True):
    own = [r for r in rows if r[0] == fold and r[1] == learn]
    return np.array([r[5] for r in own]), np.array([int(r[2]) for r in own]), np.array([r[3] for r in own])


@pytest.mark.parametrize("loss, penal", [(linear.softmax_loss, False), (linear.squared_hinge_loss, True)])
def test_solutions_have_no_slope(spark, loss, penal):
    rows, made, sizes = made_up(spark)
    problems = [linear.Problem(f, c) for f in sizes for c in (0.1, 3.0)]
    found = linear.solve(made, problems, sizes, loss, CLASSES, 500, penal)
    for p, s in found.items():
        x, y, weights = of_fold(rows, p.fold)
        margins = x @ s.coefficients[:-1] + s.coefficients[-1]
        slope = loss(margins, y)[1] * weights[:, None] / len(y)
        own = s.coefficients.copy()
        own[-1] *= penal
        gradient = np.vstack([x.T @ slope, slope.sum(axis=0)]) + own / (p.C * len(y))
        assert s.converged and np.abs(gradient).max() <= 1.1e-4
    x, y, _ = of_fold(rows, 0, learn=False)
    w = found[problems[1]].coefficients
    told = linear.confusion(made, {problems[1]: w}, CLASSES)[problems[1]]
    assert told.sum() == len(y) and np.diag(told).sum() == ((x @ w[:-1] + w[-1]).argmax(axis=1) == y).sum()


def test_logistic_equals_sparks(spark):
    rows, made, sizes = made_up(spark, folds=1)
    found = linear.solve(made, [linear.Problem(0, 3.0)], sizes, linear.softmax_loss, CLASSES, 500, False)[linear.Problem(0, 3.0)]
    x, y, weights = of_fold(rows, 0)
    df = spark.createDataFrame([(Vectors.dense(a), float(b), float(c)) for a, b, c in zip(x, y, weights)], ["features", "label", "weight"])
    n = weights.sum()  # Spark divides by the weights, not by the rows
    model = LogisticRegression(family="multinomial", regParam=1 / (3.0 * n), standardization=False, weightCol="weight", tol=1e-10, maxIter=500).fit(df)
    assert np.abs(model.coefficientMatrix.toArray().T - found.coefficients[:-1]).max() < 0.02


def test_slopes_of_losses():
    rng = np.random.default_rng(1)
    margins, labels = rng.normal(size=(7, 3)), rng.integers(0, 3, 7)
    for loss in (linear.softmax_loss, linear.squared_hinge_loss):
        base, slope = loss(margins, labels)
        for k in range(3):
            moved = margins.copy()
            moved[:, k] += 1e-6
            assert (loss(moved, labels)[0] - base) / 1e-6 == pytest.approx(slope[:, k], abs=1e-4)


def dense_bins(x, edges):
    return np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)


def test_first_splits_are_the_best_of_all(spark):
    rows, made, sizes = made_up(spark)
    grown = boosting.grow(made, sizes, CLASSES, 1, 1, 0.5, 1.0, 1.0)
    edges = boosting._edges(made)
    for fold, trees in grown.items():
        x, y, weights = of_fold(rows, fold)
        bins = dense_bins(x, edges[fold])
        for c in range(CLASSES):
            g = (1 / 3 - (y == c)) * weights
            h = 2 * (1 / 3) * (2 / 3) * weights
            score = lambda at: g[at].sum() ** 2 / (h[at].sum() + 1)
            gains = {}
            for f, e in enumerate(edges[fold]):
                for cut in range(len(e)):
                    left = bins[:, f] <= cut
                    if h[left].sum() >= 1 and h[~left].sum() >= 1:
                        gains[f, cut] = score(left) + score(~left) - score(np.ones(len(g), bool))
            f, threshold = int(trees.feature[0, c, 0]), trees.threshold[0, c, 0]
            cut = edges[fold][f].tolist().index(threshold)
            assert gains[f, cut] == pytest.approx(max(gains.values()))
            left = x[:, f] <= threshold
            assert trees.value[0, c, 1] == pytest.approx(-0.5 * g[left].sum() / (h[left].sum() + 1))
            assert trees.value[0, c, 2] == pytest.approx(-0.5 * g[~left].sum() / (h[~left].sum() + 1))


def test_trees_of_one_task_and_of_many_are_the_same(spark, monkeypatch):
    rows, made, sizes = made_up(spark)
    here = boosting.grow(made, sizes, CLASSES, 4, 3, 0.3, 1.0, 0.7)
    monkeypatch.setattr(boosting, "ROWS_TOGETHER", 0)
    over_all = boosting.grow(made, sizes, CLASSES, 4, 3, 0.3, 1.0, 0.7)
    for f in sizes:
        assert (here[f].feature == over_all[f].feature).all() and here[f].threshold == pytest.approx(over_all[f].threshold)
        assert here[f].value == pytest.approx(over_all[f].value)
        x, y, _ = of_fold(rows, f)
        at, column = np.nonzero(x)
        margins = here[f].margins(at, column, x[at, column], len(x))
        assert (margins.argmax(axis=1) == y).mean() > 0.8


def test_lost_places_are_made_again_from_the_trees(spark):
    rows, made, sizes = made_up(spark, folds=1)
    edges = boosting._edges(made)[0]
    x, y, weights = of_fold(rows, 0)
    at, column = np.nonzero(x)
    block = blocks.Block(0, True, x.shape[1], np.searchsorted(at, np.arange(len(x) + 1)), column, x[at, column], y, weights)
    b = boosting._binned((0, 0), block, edges)
    assert all((b.right_of(f, cut) == (x[:, f] > edges[f][cut])).all() for f in range(x.shape[1]) for cut in range(len(edges[f])))
    rng = np.random.default_rng(2)
    rounds = []
    for _ in range(3):
        trees = [boosting.Tree.of_depth(2) for _ in range(CLASSES)]
        for t in trees:
            t.feature[:3], t.cut[:3], t.value[:] = rng.integers(0, x.shape[1], 3), rng.integers(0, 4, 3), rng.normal(size=7)
        rounds.append(boosting._Here({0: trees}))
    step_by_step = boosting._Held(b, CLASSES)
    for r in range(3):
        for level in range(3):
            step_by_step.brought_to(b, rounds, rounds[r].value[0], r, level, 2)
    at_once = boosting._Held(b, CLASSES).brought_to(b, rounds, rounds[2].value[0], 2, 2, 2)
    assert (at_once.margins == step_by_step.margins).all() and all((p == q).all() for p, q in zip(at_once.places, step_by_step.places))


def test_stored_trees_predict_the_same(spark, tmp_path):
    rows, made, sizes = made_up(spark, folds=1)
    trees = boosting.grow(made, sizes, CLASSES, 3, 2, 0.3, 0.8, 1.0)[0]
    model = boosting.BoostedTreesModel.of(trees)
    model.write().save(f"file://{tmp_path}/trees")
    df = spark.createDataFrame([(r[4],) for r in rows], ["features"])
    told = [r["rawPrediction"] for r in boosting.BoostedTreesModel.load(f"file://{tmp_path}/trees").transform(df).collect()]
    x = np.array([r[5] for r in rows])
    at, column = np.nonzero(x)
    assert np.array(told) == pytest.approx(trees.margins(at, column, x[at, column], len(x)))


def test_sums_of_a_tree_share_its_entries():
    """The entries of a tree's rows and features are picked once for all its levels; the sums are those of a plain loop."""
    rng = np.random.default_rng(2)
    n, features = 40, 5
    x = np.where(rng.random((n, features)) < 0.6, np.round(rng.normal(size=(n, features)), 2), 0.0)
    row, column = np.nonzero(x)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
    block = blocks.Block(0, True, features, offsets, column, x[row, column], rng.integers(0, CLASSES, n), rng.random(n) + 0.5)
    edges = [np.array([-0.5, 0.0, 0.7])] * features
    binned = boosting._binned((0, 0), block, edges)
    held, chosen, sampled = boosting._Held(binned, CLASSES), np.array([0, 2, 3]), rng.random(n) < 0.8
    tree = boosting.Tree.of_depth(2)
    tree.feature[0], tree.cut[0] = 2, 1
    boosting._sums(binned, held, 0, 0, np.array([0]), chosen, sampled)
    first = held.entries_of(binned, 0, 0, chosen, sampled)
    held.brought_to(binned, [], [tree] * CLASSES, 0, 1, 2)
    for open_ in ([0, 1], [1]):
        got = boosting._sums(binned, held, 0, 1, np.array(open_), chosen, sampled)
        want = np.zeros_like(got)
        for i in np.flatnonzero(sampled):
            node = int(np.searchsorted(edges[2], x[i, 2]) > 1)
            for place, f in enumerate(chosen):
                if node in open_:
                    for k, d in enumerate(held.derivatives(binned)):
                        want[k, open_.index(node), place, np.searchsorted(edges[f], x[i, f])] += d[i, 0]
        assert np.allclose(got, want)
    again = held.entries_of(binned, 0, 1, chosen, sampled)
    assert held.entries[0] is again and all(np.array_equal(a, b) for a, b in zip(first, again))


def test_dealing_decides_no_split(spark):
    """Sums are exact: rows in another order, in more blocks, give the very same trees, also where features split alike."""
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(120, 4)) * (rng.random((120, 4)) < 0.5), 2)
    x = np.hstack([x, -x, 3 * x])
    y, weights = rng.integers(0, CLASSES, 120), rng.choice([0.3, 0.7, 1.9], 120)

    def grown(order, parts, together):
        made = []
        for own in np.array_split(order, parts):
            at, column = np.nonzero(x[own])
            offsets = np.searchsorted(at, np.arange(len(own) + 1))
            made.append(blocks.Block(0, True, x.shape[1], offsets, column, x[own][at, column], y[own], weights[own]))
        boosting.ROWS_TOGETHER = 50_000 if together else 0
        return boosting.grow(spark.sparkContext.parallelize(made, parts), {0: (x.shape[1], 120)}, CLASSES, 5, 4, 0.3, 1.0, 0.7)[0]

    was = boosting.ROWS_TOGETHER
    try:
        first = grown(np.arange(120), 1, True)
        for order, parts, together in ((rng.permutation(120), 7, True), (rng.permutation(120), 3, False)):
            other = grown(order, parts, together)
            assert all((getattr(first, c) == getattr(other, c)).all() for c in ("feature", "threshold", "value"))
    finally:
        boosting.ROWS_TOGETHER = was


def test_only_the_smaller_child_is_added_up(monkeypatch):
    rng = np.random.default_rng(3)
    n, features = 200, 6
    x = np.where(rng.random((n, features)) < 0.3, np.round(rng.normal(size=(n, features)), 2), 0.0)
    at, column = np.nonzero(x)
    block = blocks.Block(0, True, features, np.searchsorted(at, np.arange(n + 1)), column, x[at, column], rng.integers(0, CLASSES, n), rng.random(n) + 3)
    b = boosting._binned((0, 0), block, [np.array([-0.5, -1e-12, 0.0, 0.7])] * features, 2.0**-40)
    held, chosen, sampled = boosting._Held(b, CLASSES), np.arange(features), rng.random(n) < 0.9
    sums, looked, found = boosting._sums, [], []
    monkeypatch.setattr(boosting, "_sums", lambda *a: (looked.append((a[3], len(a[4]))), sums(*a))[1])
    monkeypatch.setattr(boosting, "_best", lambda s, c, best=boosting._best: (found.append(s.copy()), best(s, c))[1])
    tree = boosting._grown(b, held, 0, 3, 0.3, chosen, sampled)
    inner = [int((tree.feature[2**k - 1 : 2 ** (k + 1) - 1] >= 0).sum()) for k in range(3)]
    assert inner[1] == 2 and looked[0] == (0, 1) and all(n <= inner[k - 1] for k, n in looked[1:])
    again = boosting._Held(b, CLASSES).brought_to(b, [], [tree] * CLASSES, 0, 1, 3)
    assert (np.stack(found[1:3])[:, :, 0] == sums(b, again, 0, 1, np.array([0, 1]), chosen, sampled).swapaxes(0, 1)).all()


def test_blocks_multiply_in_stretches(spark, monkeypatch):
    """Rows without entries, stretches of few rows and of one long row; features travel in two bytes where that is enough."""
    monkeypatch.setattr(blocks, "ENTRIES", 7)
    rng = np.random.default_rng(8)
    x = np.where(rng.random((30, 300)) < 0.02, rng.normal(size=(30, 300)), 0.0)
    x[[0, 4, 29]], x[7] = 0.0, 1.5
    at, column = np.nonzero(x)
    block = blocks.Block(0, True, 300, np.searchsorted(at, np.arange(31)), column.astype(np.uint16), x[at, column], np.zeros(30, int), np.ones(30))
    w, m = rng.normal(size=(300, 4)), rng.normal(size=(30, 4))
    assert np.allclose(block.times(w), x @ w) and np.allclose(block.transposed_times(m), x.T @ m)
    rows = [(0, True, 0.0, 1.0, Vectors.sparse(300, np.flatnonzero(r).tolist(), r[r != 0].tolist())) for r in x]
    df = spark.createDataFrame(rows, ["fold", "learn", "label", "weight", "features"]).withColumn("fold", F.col("fold").cast("int"))
    made = blocks.blocks_of(df.coalesce(1)).collect()
    assert made[0].features.dtype.itemsize == 2 and np.array_equal(np.concatenate([b.features for b in made]), column)
