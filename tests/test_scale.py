"""Rules that must hold whatever the size and the distribution."""

import random

import numpy as np
import pandas as pd
import pytest

from hirelake.functions import fixed
from hirelake.operators import cleaning, clustering, folds, kmeans, stats


def test_numbers_order_as_doubles(spark):
    values = np.concatenate([
        [0.0, 5e-324, 1e-310, 2.0**-1022, 1.7976931348623157e308, np.inf, 3.9999999999999996, 4.0, 4.000000000000001, 0.1, 0.30000000000000004],
        2.0 ** np.arange(-1074, 1024), np.exp(np.random.default_rng(1).normal(size=500) * 100),
    ])
    values = np.concatenate([values, -values])
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    rows = sorted((r["k"], r["v"]) for r in df.select("v", stats.ordered_number(df.v).alias("k")).collect())
    assert all(a[1] <= b[1] and (a[0] == b[0]) == (a[1] == b[1]) for a, b in zip(rows, rows[1:]))


def test_a_million_values_in_a_tiny_range(spark):
    df = spark.range(1_000_000).selectExpr("id / 1e9 AS v", "id % 3 AS g")
    out = {r["g"]: r for r in stats.quantiles(df, "v", stats.QUARTILES, ["g"]).collect()}
    for g in range(3):
        values = np.arange(g, 1_000_000, 3) / 1e9
        assert out[g]["count"] == len(values)
        assert [out[g][n] for n in stats.QUARTILES] == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]), rel=1e-12)


def test_nan_is_missing_and_infinities_are_ends(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, float("nan"), None, float("inf"), 2.0, float("-inf"), 3.0)], "v double")
    assert stats.medians(df, "v").first().asDict() == {"count": 5, "median": 2.0}
    ends = spark.createDataFrame([(float("inf"),), (float("inf"),)], "v double")
    assert stats.medians(ends, "v").first()["median"] == float("inf")


def test_folds_of_a_crowded_cell(spark):
    """Three thousand postings without company: the deal is that of one sorted list."""
    import hashlib

    rows = [(f"posting-{i}", "Mid") for i in range(3000)] + [(f"firm-{i % 20}", random.Random(i).choice(fixed.CLASSES)) for i in range(400)]
    df = spark.createDataFrame(rows, "grp string, level string")
    got = {r["grp"]: r["fold"] for r in folds.assign_group_folds(df, "grp", "level", fixed.CLASSES).collect()}
    pdf = pd.DataFrame(rows, columns=["grp", "level"])
    totals = pdf.level.value_counts()
    rarity = sorted(range(3), key=lambda i: (totals.get(fixed.CLASSES[i], 0), i))
    counts = pd.crosstab(pdf.grp, pdf.level).reindex(columns=fixed.CLASSES, fill_value=0)

    def place(g):
        n = counts.loc[g]
        part = int(hashlib.md5(g.encode()).hexdigest()[:8], 16) % folds.PARTS
        return [-int(np.log2(n.iloc[i] + 1)) for i in rarity], part, -int(n.sum()), g

    order = sorted(counts.index, key=place)
    assert got == {g: i % 5 if i // 5 % 2 == 0 else 4 - i % 5 for i, g in enumerate(order)}


def test_a_posting_without_id_is_kept(spark):
    rows = [(None, "A", "c", "text"), (None, "a ", "c", "text"), (3, "B", "c", "x"), (None, "B", "c", "x")]
    df = spark.createDataFrame(rows, "job_id long, title string, company_name string, description_clean string")
    out = sorted((r["job_id"] is None, r["title"].strip().lower()) for r in cleaning.deduplicate(df).collect())
    assert out == [(False, "b"), (True, "a")]


def test_names_that_no_longer_fit_stop_the_run(spark):
    terms = spark.createDataFrame([(0, "network admin"), (1, "payroll")], "cluster int, term string")
    names = spark.createDataFrame([(0, "Networks", "network"), (1, "Finance", "ledger")], "cluster int, name string, signature string")
    clustering.require_names(terms, names.where("cluster = 0"))
    with pytest.raises(ValueError, match="1"):
        clustering.require_names(terms, names)


def plain_silhouettes(points, labels):
    far = np.sqrt(((points[:, None] - points[None]) ** 2).sum(axis=2))
    scores = []
    for i, c in enumerate(labels):
        own = far[i][labels == c].sum() / max(1, (labels == c).sum() - 1)
        other = min(far[i][labels == k].mean() for k in set(labels.tolist()) - {c})
        scores.append((other - own) / max(own, other) if (labels == c).sum() > 1 else 0.0)
    return np.array(scores)


def test_silhouette_of_given_labels(spark, monkeypatch):
    monkeypatch.setattr(kmeans, "BLOCK_ROWS", 7)
    points = np.random.default_rng(2).normal(size=(61, 3)) + np.vstack([np.repeat([[0, 0, 0], [5, 0, 0], [0, 6, 1]], 20, axis=0), [[9, 9, 9]]])
    labels = np.append(np.repeat([4, 1, 2], 20), 7)
    df = spark.createDataFrame([(p.tolist(), int(c), "x") for p, c in zip(points, labels)], "v array<double>, c int, _other string").repartition(3)
    got = {r["c"]: (r["size"], r["silhouette"]) for r in clustering.silhouette(df, "v", "c").collect()}
    scores = plain_silhouettes(points, labels)
    assert set(got) == {1, 2, 4, 7}
    for c, (size, score) in got.items():
        assert size == (labels == c).sum() and score == pytest.approx(scores[labels == c].mean())


def test_all_sets_at_once_equal_sets_alone(spark):
    points = np.random.default_rng(3).normal(size=(200, 4)) + np.repeat(np.eye(4) * 6, 50, axis=0)
    df = spark.createDataFrame([(p.tolist(),) for p in points], "z array<double>").repartition(4)
    blocks, sample = kmeans.dense_blocks(df, "z"), kmeans.start_rows(df, "z", 64)
    sets = [(k, s) for k in (2, 4, 5) for s in (1, 2, 3)]
    together = kmeans.fit_all(blocks, sample, sets)
    for s in sets:
        centres, cost = kmeans.fit_all(blocks, sample, [s])[s]
        assert together[s][0] == pytest.approx(centres) and together[s][1] == pytest.approx(cost)
        gaps = ((points[:, None] - centres[None]) ** 2).sum(axis=2)
        assert cost == pytest.approx(gaps.min(axis=1).sum())
        if s[0] == 4:  # at rest: every centre is the mean of its rows
            for i in range(4):
                own = points[gaps.argmin(axis=1) == i]
                assert not len(own) or np.abs(own.mean(axis=0) - centres[i]).max() < 0.05
    best = min(together[4, s][1] for s in (1, 2, 3))
    assert best < 200 * 4 * 1.2
    scan = {r["k"]: r for r in clustering.scan_k(df, range(2, 5), inits=3, seed=1, sample=None)}
    labels = ((points[:, None] - kmeans.best_of_starts(df, [4], 3, 1, "z")[4][0][None]) ** 2).sum(axis=2).argmin(axis=1)
    assert scan[4]["silhouette"] == pytest.approx(plain_silhouettes(points, labels).mean())
    assert scan[4]["inertia"] < scan[3]["inertia"] < scan[2]["inertia"]


def test_stored_tables_are_shuffled_in_many_parts(spark):
    """What a task sorts must not grow with the table where the number of shuffle partitions is small and fixed."""
    from hirelake.sources import stages as stored

    name, parts = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", []
    before, store = spark.conf.get(name, None), stored.StageStore()

    def inner():
        parts.append(int(spark.conf.get(name)))
        return spark.range(3)

    def outer():
        rows = store.get(spark, "parts", "inner", inner)
        parts.append(int(spark.conf.get(name)))
        return rows.groupBy("id").count()

    assert store.get(spark, "parts", "outer", outer).count() == 3
    assert min(parts) >= 200 and spark.conf.get(name, None) == before

    def broken():
        raise ValueError("no table")

    with pytest.raises(ValueError):
        store.get(spark, "parts", "broken", broken)
    assert spark.conf.get(name, None) == before
