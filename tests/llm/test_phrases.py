"""Phrase mining against counting every phrase, written from the rules."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from hirelake.llm import phrases

SCHEMA = "doc_id long, text string, lang string"


def mined(rows, longest, least, share=50, of=100, first=None):
    counts, total = {}, Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        plain = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain):
            words = tuple(w for w in re.split(r"[\x20\x09]+", piece) if w)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[words[i : i + k]] += 1
    out = []
    for lang, f in counts.items():
        often = {p: n for p, n in f.items() if len(p) > 1 and n >= least}
        beaten = set()
        for p, n in often.items():
            inner = {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}
            beaten |= {q for q in inner if of * n >= share * often[q]}
        ranked = []
        for p, a in often.items():
            if p not in beaten:
                score, _, l, r = min((1000000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (score, a, p, l, r) in enumerate(sorted(ranked)[:first]):
            out.append((lang, i + 1, p.decode(), -a, l, r, total[lang], -score))
    return sorted(out)


def got(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def made_up(seed, docs=120):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "Straße", "日本", "x\x1cy", "new", "york", "city", "a", "a", "É", "--"] + [f"w{i}" for i in range(40)]
    rows = []
    for i in range(docs):
        words = []
        for _ in range(rng.randint(0, 60)):
            words += rng.choice([["New", "York", "city"], ["a", "a", "a"], [rng.choice(vocabulary)], [rng.choice(vocabulary)], [rng.choice(vocabulary)]])
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\x0b"]) for w in words), rng.choice(["en", "de", None, ""])))
    return rows + [(7, None, "en"), (7, "", "xx"), (8, "one. two", "yy")] + [(9, "same line here again", "en")] * 30


@pytest.mark.parametrize("longest, least", [(3, 10), (2, 4), (4, 5)])
def test_equals_counting_everything(spark, longest, least):
    rows = made_up(longest)
    assert got(phrases.collocations(spark.createDataFrame(rows, SCHEMA), longest, least)) == mined(rows, longest, least)


def test_failures_of_the_sample_are_found_in_further_passes(spark, monkeypatch):
    rows = made_up(11)
    monkeypatch.setattr(phrases, "PROPOSED", 10**6)  # the sample proposes nothing at all
    assert got(phrases.collocations(spark.createDataFrame(rows, SCHEMA), first=5)) == mined(rows, 3, 10, first=5)


def test_filters_too_small_lose_nothing(spark, monkeypatch):
    rows = made_up(12)
    monkeypatch.setattr(phrases, "MOST_BITS", 64)
    assert got(phrases.collocations(spark.createDataFrame(rows, SCHEMA))) == mined(rows, 3, 10)


def test_counts_of_many_buckets_handed_on_often(spark, monkeypatch):
    rows = made_up(14)
    monkeypatch.setattr(phrases, "BYTES_A_BUCKET", 100)
    monkeypatch.setattr(phrases, "GATHERED", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        assert got(phrases.collocations(spark.createDataFrame(rows, SCHEMA).repartition(5))) == mined(rows, 3, 10)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_words_of_equal_hash_begin_again_with_another(spark, monkeypatch):
    plain = phrases.Pieces.salted
    monkeypatch.setattr(phrases.Pieces, "salted", lambda self, tags, salt: plain(self, tags, salt) % np.uint64(50) + np.uint64(1) if salt == 0 else plain(self, tags, salt))
    w = phrases.Pieces(pa.array(["a b c d"]))
    assert (w.salted(np.zeros(4, np.uint64), 0) <= 50).all()
    assert w.salted(np.zeros(4, np.uint64), 1).tolist() != w.salted(np.zeros(4, np.uint64), 2).tolist()


def test_added_up_tells_phrases_of_one_hash_apart(monkeypatch):
    columns = [np.array([1, 2, 1, 2, 1], np.uint64), np.array([5, 6, 5, 6, 7], np.uint64)]
    monkeypatch.setattr(phrases, "phrase_keys", lambda c: np.zeros(len(c[0]), np.uint64))
    found, many, _ = phrases._added_up(columns, np.ones(5, np.int64))
    assert sorted(zip(found[0].tolist(), found[1].tolist(), many.tolist())) == [(1, 5, 2), (1, 7, 1), (2, 6, 2)]


def test_long_text_empty_table_and_clashing_columns(spark):
    long_ = [(1, "alpha beta gamma " * 40000 + "q" * 100000, "en"), (2, None, None)]
    assert got(phrases.collocations(spark.createDataFrame(long_, SCHEMA))) == mined(long_, 3, 10)
    assert phrases.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = made_up(13)
    clashing = spark.createDataFrame([(*r, 1, "x", 2, 3, "z") for r in rows], SCHEMA + ", h1 long, word string, k int, many long, phrase string")
    assert got(phrases.collocations(clashing, first=3)) == mined(rows, 3, 10, first=3)
