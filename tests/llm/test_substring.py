import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import substring_dedup

from .conftest import ids_and_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(rows, window):
    words = [WORD.findall(t) for _, t in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = Counter()
    for (d, _), w in zip(rows, words):
        covered = set()
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                covered.update(range(i, i + window))
        out[d, len(w), len(covered), " ".join(x for i, x in enumerate(w) if i not in covered)] += 1
    return out


def result(df):
    return Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in df.collect())


def passages(seed, n, window):
    """Texts put together from shared passages of lengths around the window, near copies, and loops."""
    rng = random.Random(seed)
    pool = [[f"p{rng.randrange(3000)}" for _ in range(rng.randrange(1, 4 * window))] for _ in range(40)]
    texts = []
    for _ in range(n):
        words = []
        for _ in range(rng.randrange(4)):
            part = rng.choice(pool)
            a = rng.randrange(len(part))
            words += part[a : a + rng.randrange(1, 3 * window)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5))]
        texts.append(words)
        if rng.random() < 0.4 and words:
            copy = list(words)
            copy[rng.randrange(len(copy))] = "edit"
            texts.append(copy)
        if rng.random() < 0.05:
            texts.append(["loop", "la"] * rng.randrange(2 * window))
    return [(i, rng.choice([" ", "\n", " \t"]).join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("window", [35, 5, 1, 60])
@pytest.mark.parametrize("crowded, gathered, sent", [(2000, 500_000, 10**6), (2, 100, -1), (0, 1000, 10**6)])
def test_passages(spark, monkeypatch, window, crowded, gathered, sent):
    for name, value in (("CROWDED", crowded), ("GATHERED", gathered), ("SENT_WHOLE", sent)):
        monkeypatch.setattr(substring_dedup, name, value)
    rows = passages(window + crowded, 150, window)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got, expected = result(substring_dedup.remove_repeats(df, window)), plain(rows, window)
    assert got == expected
    assert sum(k[2] for k in expected) > 0


def test_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert result(substring_dedup.remove_repeats(docs, 35)) == plain(ids_and_texts(docs), 35)


def test_odd(odd, empty):
    assert result(substring_dedup.remove_repeats(odd, 35)) == plain(ids_and_texts(odd), 35)
    assert substring_dedup.remove_repeats(empty, 35).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80), st.integers(1, 12))
def test_deep_suffixes(ids, window):
    starts = np.arange(max(0, len(ids) - window + 1))
    node = substring_dedup.deep_suffixes(np.array(ids), starts, window)
    grams = [tuple(ids[i : i + window]) for i in starts]
    seen = Counter(grams)
    assert [n >= 0 for n in node] == [seen[g] > 1 for g in grams]
    assert all((node[i] == node[j]) == (grams[i] == grams[j]) for i in starts for j in starts if node[i] >= 0)
