import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from hirelake.llm import jaccard_join
from hirelake.llm.components import components

from .conftest import ids_and_texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LIKE = jaccard_join.Likeness(4, 17, 20)


def shingles(text, n):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text))
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def roots(n, links):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in links:
        parent[find(a)] = find(b)
    return [find(i) for i in range(n)]


def plain(rows, like):
    """All pairs that share a shingle."""
    sets = [shingles(t, like.words) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    both = Counter()
    for h in holders.values():
        both.update((a, b) for k, a in enumerate(h) for b in h[k + 1 :])
    links = [(a, b) for (a, b), n in both.items() if like.of * n >= like.least * (len(sets[a]) + len(sets[b]) - n)]
    root = roots(len(rows), links)
    least = {}
    for (d, _), r in zip(rows, root):
        least[r] = d if least.get(r) is None else min(least[r], d if d is not None else least[r])
    return Counter((d, len(s), least[r]) for (d, _), s, r in zip(rows, sets, root))


def result(df):
    return Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect())


def edited(rng, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
    return words


def family(seed, n):
    """Chains, stars and strangers of all sizes around the threshold."""
    rng = random.Random(seed)
    texts = []
    while len(texts) < n:
        base = [f"w{rng.randrange(10**5)}" for _ in range(rng.choice([1, 3, 5, 8, 9, 12, 20, 40, 100, 300]))]
        texts.append(base)
        at = base
        for _ in range(rng.randrange(5)):
            at = edited(rng, at if rng.random() < 0.6 else base, rng.randrange(0, 1 + len(base) // 40 + 1))
            at = at[: max(1, len(at) - rng.randrange(3))]
            texts.append(at)
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts[:n])]


@pytest.mark.parametrize("like", [LIKE, jaccard_join.Likeness()])
@pytest.mark.parametrize("gathered, together", [(1_000_000, 2048), (300, 3)])
def test_families(spark, monkeypatch, like, gathered, together):
    monkeypatch.setattr(jaccard_join, "GATHERED", gathered)
    monkeypatch.setattr(jaccard_join, "COMPARED_TOGETHER", together)
    rows = family(gathered, 700)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    assert result(jaccard_join.near_duplicates(df, like)) == plain(rows, like)


def test_table(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    rows = ids_and_texts(spark.read.parquet(path))
    assert result(jaccard_join.near_duplicates(spark.read.parquet(path), LIKE)) == plain(rows, LIKE)


def test_odd(odd, empty):
    assert result(jaccard_join.near_duplicates(odd, LIKE)) == plain(ids_and_texts(odd), LIKE)
    assert jaccard_join.near_duplicates(empty, LIKE).count() == 0


def degrees(rows, like):
    """Links of each row: other sets that its set is linked with."""
    sets = [frozenset(shingles(t, like.words)) for _, t in rows]
    each = [s for s in set(sets) if s]
    n = {s: sum(1 for o in each if o != s and like.of * len(s & o) >= like.least * len(s | o)) for s in each}
    return Counter((d, n.get(s, 0)) for (d, _), s in zip(rows, sets))


@pytest.mark.parametrize("at_once, together", [(200_000, 1024), (1, 7)])
def test_links_are_whole(spark, monkeypatch, at_once, together):
    """Near copies of one text, most of them linked with each other and not just with one, some of them twice."""
    monkeypatch.setattr(jaccard_join, "SENT_WHOLE", at_once)
    monkeypatch.setattr(jaccard_join, "COMPARED_TOGETHER", together)
    rng = random.Random(8)
    base = [f"w{i}" for i in range(200)]
    texts = [" ".join(edited(rng, base, rng.randrange(4))) for _ in range(60)]
    rows = [(i, t) for i, t in enumerate([*texts, *texts[:5]])] + [(100 + i, t) for i, t in family(3, 150)] + [(None, texts[7]), (3, "a b")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = Counter((r["doc_id"], r["links"]) for r in jaccard_join.near_duplicates(df, LIKE).collect())
    assert out == degrees(rows, LIKE) and max(n for _, n in out) > 20


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 10**6), st.sampled_from([LIKE, jaccard_join.Likeness()]), st.integers(1, 400), st.data())
def test_linked_sets_share_a_key(seed, like, n, data):
    rng = np.random.default_rng(seed)
    both = rng.integers(0, 2**63, n, dtype=np.int64).astype(np.uint64)
    spare = n * (like.of - like.least) // like.least
    left = data.draw(st.integers(0, spare))
    right = data.draw(st.integers(0, spare - left))
    a, b = (np.unique(np.concatenate([both, rng.integers(0, 2**63, k, dtype=np.int64).astype(np.uint64)])) for k in (left, right))
    assert like.of * n >= like.least * (n + left + right)
    if left + right:
        cells = like.cells(2 * n + 10)
        keys = [set(jaccard_join.part_keys(x, like, cells).tolist()) for x in (a, b)]
        assert keys[0] & keys[1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 9)), max_size=60), st.integers(1, 7))
def test_meeting_over_batches(rows, size):
    rows = sorted(set(rows))
    keys, classes = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 1))
    carry, got = None, []
    for at in range(0, len(rows), size):
        batch = pa.RecordBatch.from_arrays([pa.array(keys[at : at + size]), pa.array(classes[at : at + size]), pa.array([None] * len(keys[at : at + size]), pa.int64())], ["key", "cls", "hub"])
        carry, out = jaccard_join._meet(carry, batch)
        got += list(zip(*(c.to_pylist() for c in out.columns))) if out is not None else []
    by_key = defaultdict(list)
    for k, c in rows:
        by_key[k].append(c)
    assert sorted(got) == [(k, c, by_key[k][0]) for k, c in rows if len(by_key[k]) > 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**20), st.integers(-9, 9), st.booleans()), min_size=1, max_size=80), st.integers(0, 44))
def test_packed_keys(rows, shift):
    rows = sorted(set(rows))
    keys = np.array([r[0] for r in rows], dtype=np.uint64) << np.uint64(shift)
    classes, alone = np.array([r[1] for r in rows], dtype=np.int64), np.array([r[2] for r in rows])
    for got, given_ in zip(jaccard_join._unpacked(jaccard_join._packed(keys, classes, alone)), (keys, classes, alone)):
        assert got.tolist() == given_.tolist()


def between(n, apart):
    """Texts of a common passage, in families of five that are linked among themselves and hardly with others."""
    base = [f"w{i}" for i in range(120)]
    texts = []
    for i in range(n):
        family_ = [f"f{i // 5}x{k}" for k in range(apart)]
        texts.append(" ".join([*base, *family_, *([f"own{i}"] if i % 5 else [])]))
    return list(enumerate(texts))


@pytest.mark.parametrize("together", [512, 7])
def test_group_of_many_components(spark, monkeypatch, together):
    """One group of many components whose sketches leave links open: it is settled without a row a pair."""
    monkeypatch.setattr(jaccard_join, "COMPARED_TOGETHER", together)
    rows = between(200, 12)
    made = []
    whole = jaccard_join.links_across

    def counted(*args):
        made.append(whole(*args))
        return made[-1]

    monkeypatch.setattr(jaccard_join, "links_across", counted)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(jaccard_join.near_duplicates(df, LIKE)) == plain(rows, LIKE)
    assert all(m.count() < 200 * (200 / together + 1) for m in made)


@pytest.mark.parametrize("together, batch", [(512, 1000), (7, 1000), (7, 3)])
def test_open_members_once_a_group(spark, monkeypatch, together, batch):
    """However many blocks a group has, its tasks make a row for each open member once, and miss none."""
    monkeypatch.setattr(jaccard_join, "COMPARED_TOGETHER", together)
    monkeypatch.setattr(type(spark.range(1)), "distinct", lambda self: self)  # nothing is made that would have to go again
    rng = np.random.default_rng(3)
    common_ = rng.integers(0, 2**63, 100).astype(np.uint64)
    sets = [np.concatenate([common_, rng.integers(0, 2**63, 8 if i < 90 else 300).astype(np.uint64)]) for i in range(100)]
    made = [(i, i // 3, len(s), jaccard_join._sketch(s).view(np.int64).tolist()) for i, s in enumerate(sets)]
    classes = spark.createDataFrame([(c, n, s) for c, _, n, s in made], "cls long, n long, sketch array<long>")
    groups = spark.createDataFrame([(k, c, own) for k in (5, 6) for c, own, _, _ in made], "key long, cls long, component long")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        out = sorted(tuple(r) for r in jaccard_join._open_members(groups, classes, LIKE).collect())
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert out == [(k, i, i // 3, 108) for k in (5, 6) for i in range(90)]


def test_components(spark):
    rng = random.Random(5)
    n = 400
    links = [(rng.randrange(n), rng.randrange(n)) for _ in range(250)] + [(i, i + 1) for i in range(300, 360)] + [(399, i) for i in range(380, 399)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    root = roots(n, links)
    least = {}
    for i, r in enumerate(root):
        least[r] = min(i, least.get(r, i))
    assert out == {i: least[root[i]] for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
