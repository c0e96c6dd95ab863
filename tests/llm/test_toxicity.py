import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from hirelake.llm import queries, toxicity

from .conftest import ODD


def column(texts):
    return pa.array(texts, pa.string())


def net_for(texts, seed=0):
    rng = np.random.default_rng(seed)
    v = toxicity.Vocabulary(column(texts))
    net = toxicity.Network.start(v.hashes[::2], rng.standard_normal(len(v.hashes[::2])).astype(np.float32), rng)
    return v, net


TEXTS = ["one Two, three. four five", "two", "(six) six seven " * 20, "é ñandú 1 2 3 " * 9]


def test_gradients():
    v, net = net_for(TEXTS)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}
    _, numbers, lengths = v.windows()
    aim = np.arange(len(numbers)) % 2 * 1.0

    def loss():
        z = net.run(net.project(net.inputs(v)), numbers, lengths).astype(np.float64)
        return np.mean(np.logaddexp(0, z) - aim * z)

    g = net.gradients(v, numbers, lengths, aim)
    rng = np.random.default_rng(1)
    for name, x in net.p.items():
        direction = rng.standard_normal(x.shape)
        kept, step = x.copy(), 1e-2
        x += step * direction
        up = loss()
        x -= 2 * step * direction
        down = loss()
        x[...] = kept
        assert (up - down) / (2 * step) == pytest.approx((g[name] * direction).sum(), rel=0.03, abs=3e-4), name


def test_windows_cover_all_and_overlap():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        v = toxicity.Vocabulary(column([None, " ".join(f"w{i}" for i in range(n)), "x y"]))
        row, numbers, lengths = v.windows()
        mine = row == 1
        assert mine.sum() == (0 if not n else max(0, -(-(n - 32) // 16)) + 1)
        flat = [list(numbers[i, : lengths[i]]) for i in np.flatnonzero(mine)]
        words = list(v.of[v.words.first[1] : v.words.first[2]])
        assert flat == [words[a : a + 32] for a in range(0, 16 * mine.sum(), 16)]
        assert (numbers[mine][np.arange(32) >= lengths[mine][:, None]] == len(v.hashes)).all()


def test_words_are_stripped_and_lowered():
    v = toxicity.Vocabulary(column(["Idiot, (idiot) idiot### IDIOT ... ..."]))
    assert len(v.hashes) == 2


def test_a_text_scores_the_same_in_any_batch():
    _, net = net_for(TEXTS, 3)
    alone = [toxicity.score_batch(column([t]), net)[0] for t in TEXTS + ODD]
    assert np.allclose(alone, toxicity.score_batch(column(TEXTS + ODD), net), atol=1e-6)


def test_one_class_gives_the_base_rate():
    for toxic in ([0, 0, 0], [1, 1, 1], []):
        net = toxicity.train(TEXTS[: len(toxic)], np.array(toxic, dtype=np.int64))
        assert toxicity.score_batch(column(["any", ""]), net) == pytest.approx([(sum(toxic) + 0.5) / (len(toxic) + 1)] * 2, abs=1e-6)


def test_the_border_holds_for_the_ratio_of_all_labels(spark):
    logits, toxic = np.array([-3.0, -2, -1, 0, 1, 2, 3, 4]), np.array([0, 0, 0, 1, 0, 0, 1, 1])
    assert toxicity._border(logits, toxic) == 2.5 and toxicity._border(logits, toxic, (1, 10)) == -0.5
    rng = np.random.default_rng(1)
    texts = [f"{'vile' if toxic and rng.random() < 0.7 or not toxic and rng.random() < 0.3 else 'kind'} w{i % 9}" for i in range(900) for toxic in [i % 10 == 0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(900)], "doc_id long, toxic int")
    called = [(toxicity.score_batch(column(texts), toxicity.fit(docs, labels, most)) >= 0.5).sum() for most in ({1: 1000, 0: 2000}, {1: 60, 0: 60})]
    assert max(called) < 100  # one in ten is toxic, and words tell too little to call more than that


def test_odd(spark, odd, empty):
    _, net = net_for(TEXTS)
    out = toxicity.score(odd, net).collect()
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == sorted([*range(len(ODD)), 4, 4])
    assert all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(empty, net).count() == 0
    labels = spark.createDataFrame([(1, 1, "t"), (1, 0, "t"), (2, None, "t"), (None, 1, "t"), (99, 1, "t")], "doc_id long, toxic int, text string")
    assert toxicity.fit(odd, labels.limit(0)).p["bias"][0] == 0


def test_memory_of_scoring():
    """Character strings of many different words are looked up a part at a time."""
    words = [f"{i * 7919 % 1000003:06d}{i % 97}word{i}" for i in range(60_000)]
    few = " ".join(words[:50])
    net = toxicity.train([few, few + " vile"], np.array([0, 1]))
    texts = column([" ".join(words[a : a + 600]) for a in range(0, len(words), 600)])
    tracemalloc.start()
    try:
        scores = toxicity.score_batch(texts, net)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert len(scores) == 100 and peak < 60 * texts.nbytes


def test_held_out_accuracy(spark):
    path = "/root/testdata/sf0.1"
    out = {r["doc_id"]: r for r in queries.QUERIES["op5_toxicity"](spark, path).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in out.items())
    assert all(r["predicted"] == int(r["score"] >= 0.5) for r in out.values())
    known = [(out[r["doc_id"]]["score"], r["toxic"]) for r in spark.read.parquet(f"{path}/labels.parquet").collect() if out[r["doc_id"]]["held_out"]]
    score, toxic = (np.array(x) for x in zip(*known))
    ranks = np.argsort(np.argsort(score))
    n = toxic.sum()
    assert (ranks[toxic == 1].sum() - n * (n - 1) / 2) / (n * (len(toxic) - n)) > 0.95
    assert ((score >= 0.5) == toxic).mean() > 0.95
