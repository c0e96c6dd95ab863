"""The stages against brute force, each on what the one before kept."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
import public_tokenizers
from hirelake.llm import jaccard_join, secrets, toxicity

from .test_jaccard import plain as plain_groups
from .test_secrets import plain as plain_secrets
from .test_substring import plain as plain_repeats
from .test_tokens import check_packing

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def expected_toxic(spark, rows):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    docs = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    net = toxicity.fit(docs, labels)
    return [r for r in rows if not r[1] or toxicity.score_batch(pa.array([r[1]], pa.string()), net)[0] < 0.5]


def expected_groups(rows):
    groups = plain_groups([(r[0], r[1] or "") for r in rows], jaccard_join.Likeness(5, 4, 5))
    stay = {d for d, _, c in groups if d == c}
    return [r for r in rows if r[0] in stay]


def expected_repeats(rows):
    out = {k[0]: k for k in plain_repeats([(r[0], r[1] or "") for r in rows], 35)}
    texts = [(r, out[r[0]][3] if out[r[0]][2] else r[1]) for r in rows]
    return [(r[0], t, r[2], r[3], None if t is None else len(t)) for r, t in texts]


def expected_secrets(rows):
    out = []
    for r in rows:
        spans = sorted(plain_secrets(r[1]) + [s for s in secrets.scan_text(r[1]) if s[2] not in secrets.BASE_KINDS], key=lambda s: (s[0], secrets.ORDER[s[2]]))
        text = secrets.redact(r[1], spans)
        out.append((r[0], text, r[2], r[3], len(text)))
    return out


def test_all_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = rows_of(docs)
    steps = [lambda x: expected_toxic(spark, x), expected_groups, expected_repeats, expected_secrets]
    for (name, stage), expect in zip(corpus_pipeline.STAGES, steps):
        out = stage(spark, docs, FOLDER)
        assert out.schema == docs.schema, name
        rows = sorted(expect(rows))
        assert rows_of(out) == rows, name
        docs = spark.createDataFrame(rows, docs.schema)
    packed = corpus_pipeline.run(spark, FOLDER).collect()
    word = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    used, least = check_packing(packed, [(r[0], r[1]) for r in rows], word, 4096)
    assert used <= least + 1


def test_stages_find_what_they_should(spark):
    words = [f"w{i}" for i in np.random.default_rng(0).integers(0, 10**6, 3000)]
    shared = " ".join(words[:60])
    rows = [
        (0, " ".join(words[100:300]), "en", "s", 1), (1, " ".join([*words[100:299], "edit"]), "en", "s", 1),
        (2, " ".join([*words[400:500], shared]), "en", "s", 1), (3, shared + "\n" + " ".join(words[600:700]), "en", "s", 1),
        (4, "clean  text,\n as it was", "en", "s", 1), (5, "token=abcdefgh12 end", "en", "s", 1), (6, None, "en", "s", None), (7, "", None, None, 0),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["near_duplicates"](spark, docs, FOLDER)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3, 4, 5, 6, 7]
    cut = {r["doc_id"]: r["text"] for r in stages["substring_dedup"](spark, kept, FOLDER).collect()}
    assert cut[2] == " ".join(words[400:500]) and cut[3] == " ".join(words[600:700])
    assert cut[0] == rows[0][1] and cut[4] == rows[4][1] and cut[6] is None and cut[7] == ""
    masked = {r["doc_id"]: (r["text"], r["n_chars"]) for r in stages["secret_scan"](spark, kept, FOLDER).collect()}
    assert masked[5] == ("[assign] end", 12) and masked[4][0] == rows[4][1] and masked[6] == (None, None)


def test_rows_of_one_id_and_different_text_stay(spark):
    words = [f"w{i}" for i in range(900)]
    texts = [" ".join(words[a : a + 100]) for a in range(0, 900, 100)]
    rows = [
        (1, texts[0]), (1, None), (1, ""), (2, texts[1]), (2, texts[2]), (3, texts[1] + " edit"), (4, texts[3]), (4, texts[3]), (5, texts[4]),
        (5, texts[4] + " edit"), (5, texts[5]), (6, texts[0]), (6, texts[6]), (None, texts[0]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.one_of_each_group(spark, docs, FOLDER).collect()]
    near = {(5, texts[4]), (5, texts[4] + " edit")}
    assert len(near & set(kept)) == 1 and sorted(set(kept) - near, key=str) == sorted(set(rows) - near - {(3, texts[1] + " edit"), (6, texts[0])}, key=str)
    assert len(kept) == len(set(kept))


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_odd_and_empty(spark, odd, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, odd, FOLDER)
    if name != "packing":
        assert out.schema == odd.schema
        ids = [r["doc_id"] for r in out.collect()]
        assert None in ids and 0 in ids
    assert stage(spark, empty, FOLDER).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_columns_of_clashing_names_stay_as_they_are(spark, name):
    words = [f"w{i}" for i in range(200)]
    texts = [" ".join(words[:120]), " ".join([*words[:119], "edit"]), " ".join([*words[130:190], *words[:40]]), "token=abcdefgh12 end", None, "toxic or not"]
    names = ["kept", "n_words", "n_removed", "score", "_key", "key", "spans", "component", "component_id", "label", "window", "ids", "row", "_given0", "kept_sha256"]
    rows = [(i, t, *[f"{c} {i}" for c in names]) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, ["doc_id", "text", *names])
    plain = docs.select("doc_id", "text")
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, docs, FOLDER)
    if name == "packing":
        assert {r["doc_id"] for r in got.collect()} == {r[0] for r in rows}
        return
    assert got.columns == docs.columns
    out = got.collect()
    assert all(r[c] == f"{c} {r['doc_id']}" for r in out for c in names)
    assert sorted((r["doc_id"], r["text"] or "") for r in out) == sorted((r["doc_id"], r["text"] or "") for r in stage(spark, plain, FOLDER).collect())
