import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from hirelake.llm import byte_bpe, common, packing, token_counts, vocab

from .conftest import ids_and_texts, sample

RANKS, PATTERN = "byte_bpe_50k.tiktoken", public_tokenizers.PATTERN
ANY = st.text(st.sampled_from("aB c.,!#'\n\t1éÉİΣĳ▁ 　🙂st<|>"), max_size=60)


@pytest.fixture(scope="module")
def bpe():
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=vocab.rank_file(RANKS), special_tokens={})


@pytest.fixture(scope="module")
def piece():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def word():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


# ---------------------------------------------------------------- byte-level BPE


@pytest.mark.parametrize("chunk", [byte_bpe.CHUNK, 40])
def test_encode_equals_the_library(odd, bpe, chunk):
    out = byte_bpe.decode(byte_bpe.encode(odd, RANKS, PATTERN, chunk, 16), RANKS).collect()
    expected = Counter((d, vocab.ids_to_bytes(bpe.encode_ordinary(t)), t.encode()) for d, t in ids_and_texts(odd))
    assert Counter((r["doc_id"], bytes(r["ids"]), bytes(r["text"])) for r in out) == expected


def test_chunks_of_real_texts(spark, bpe):
    docs = sample(spark, 60)
    out = {r["doc_id"]: bytes(r["ids"]) for r in byte_bpe.encode(docs, RANKS, PATTERN, 200, 30).collect()}
    assert out == {d: vocab.ids_to_bytes(bpe.encode_ordinary(t)) for d, t in ids_and_texts(docs)}


@settings(max_examples=300, deadline=None)
@given(ANY, st.integers(3, 12), st.integers(1, 6))
def test_stitched_chunks(text, chunk, overlap):
    n = max(1, -(-(len(text) - overlap) // chunk))
    pieces = [text[i * chunk : (i + 1) * chunk + overlap] if i + 1 < n else text[i * chunk :] for i in range(n)]
    parts = [byte_bpe.encode_chunk(p, overlap if i else 0, chunk, i + 1 == n, RANKS, PATTERN) for i, p in enumerate(pieces)]
    got = byte_bpe.stitch(parts)
    assert got is None or got == byte_bpe.encode_text(text, RANKS, PATTERN)


def test_encode_nothing(empty):
    assert byte_bpe.encode(empty, RANKS, PATTERN).count() == 0


# ---------------------------------------------------------------- token counts


def test_counts_equal_the_library(odd, piece):
    out = Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts.token_counts(odd, limit=50).collect())
    expected = [(d, len(t.encode()), len(piece.encode(t))) for d, t in ids_and_texts(odd)]
    assert out == Counter((*e, e[2] > 50) for e in expected)


def test_counts_with_few_held(spark, piece, monkeypatch):
    monkeypatch.setattr(token_counts, "HELD", 5)
    monkeypatch.setattr(token_counts, "GATHERED", 50)
    docs = sample(spark, 100)
    out = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(docs).collect()}
    assert out == {d: len(piece.encode(t)) for d, t in ids_and_texts(docs)}


def test_long_pre_tokens_are_not_held(spark, piece, monkeypatch):
    context, held = type(spark.sparkContext), []
    broadcast = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: held.append(value) or broadcast(self, value))
    rows = [(0, "a b " + "x" * 64), (1, "日本語" * 300 + " a"), (2, "y" * 65), (3, "y" * 65 + " b")]
    out = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {d: len(piece.encode(t)) for d, t in rows}
    assert [set(h) for h in held if isinstance(h, dict)] == [{"a", "b", "x" * 64}]


def test_count_nothing(empty):
    assert token_counts.token_counts(empty).count() == 0


@settings(max_examples=300, deadline=None)
@given(ANY)
def test_pre_tokens_add_up(text):
    piece = vocab.piece_tokenizer("piece_bpe_32k.model")
    assert sum(max(1, len(piece.encode(p))) for p in token_counts.pre_tokens(text)) == len(piece.encode(text))


# ---------------------------------------------------------------- packing


@settings(max_examples=300, deadline=None)
@given(ANY)
def test_word_ids(text):
    whole = vocab.word_tokenizer("word_bpe_49k.json").encode(text, add_special_tokens=False).ids
    assert vocab.word_ids(vocab.word_memory("word_bpe_49k.json"), [text, text]) == [vocab.ids_to_bytes(whole)] * 2


def test_tasks_of_other_kinds_drop_what_is_held():
    memory = vocab.word_memory("word_bpe_49k.json")
    list(common.handing_back(lambda batches: batches, holds=True)(iter([])))
    assert vocab.word_memory("word_bpe_49k.json") is memory
    list(common.handing_back(lambda batches: batches)(iter([])))
    assert vocab.word_memory.cache_info().currsize == vocab.word_tokenizer.cache_info().currsize == 0


def check_packing(out, docs, word, capacity):
    expected = Counter()
    for d, t in docs:
        ids = [*word.encode(t, add_special_tokens=False).ids, 1]
        for piece, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at : at + capacity]
            expected[d, piece, at, len(part), zlib.crc32(vocab.ids_to_bytes(part))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == expected
    sequences = defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for members in sequences.values():
        end = 0
        for offset, length in sorted(members):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences), -(-sum(r["length"] for r in out) // capacity)


@pytest.mark.parametrize("capacity", [4096, 64, 7])
def test_packing_odd(odd, word, capacity):
    check_packing(packing.pack(odd, capacity=capacity).collect(), ids_and_texts(odd), word, capacity)


def test_packing_is_dense(spark, word):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    used, least = check_packing(packing.pack(docs, capacity=4096).collect(), ids_and_texts(docs), word, 4096)
    assert used <= least + 2


def test_pack_nothing(empty):
    assert packing.pack(empty).count() == 0


def best_count(lengths, capacity):
    """Least number of sequences, by trying everything."""
    best = len(lengths)

    def go(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for r in {r: k for k, r in enumerate(rooms) if r >= lengths[i]}.items():
            go(i + 1, [*rooms[: r[1]], r[0] - lengths[i], *rooms[r[1] + 1 :]])
        go(i + 1, [*rooms, capacity - lengths[i]])

    lengths = sorted(lengths, reverse=True)
    go(0, [])
    return best


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_reduction_keeps_an_optimum(lengths):
    counts = np.bincount(lengths, minlength=21)
    left = counts.copy()
    fixed = packing.reduce_by_dominance(left, 20)
    held = Counter()
    for g in fixed:
        assert sum(a * n for a, n in g.items) <= 20
        for length, n in g.items:
            held[length] += n * g.times
    assert all(held[k] + left[k] == counts[k] for k in range(21))
    rest = [k for k in range(21) for _ in range(left[k])]
    assert sum(g.times for g in fixed) + best_count(rest, 20) == best_count(lengths, 20)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=200))
def test_plan_places_all(lengths):
    counts = np.bincount(lengths, minlength=21)
    held = Counter()
    for g in packing.plan(counts, 20):
        assert sum(a * n for a, n in g.items) <= 20 and g.times > 0
        for length, n in g.items:
            held[length] += n * g.times
    assert all(held[k] == counts[k] for k in range(21))
