"""Token counts of documents without their ids.

A pre-token is a stretch of spaces with what follows up to the next space. No piece of the vocabulary
joins a letter to a space after it, so a text has as many tokens as its pre-tokens together. Each
distinct pre-token is encoded once; documents meet the counts by pre-token.
"""

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, vocab

#: Most frequent pre-tokens whose counts every task holds; the others are joined. Bounds a broadcast.
HELD = 200_000
#: Bytes of a held pre-token at most; longer ones are joined.
HELD_BYTES = 64
#: Distinct pre-tokens a task gathers before it hands them on.
GATHERED = 200_000
STRETCH = re.compile(" +[^ ]*")


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens without their first space. The tokenizer puts a space before the text, and knows U+2581 as one."""
    if not text:
        return []
    text = text.replace("▁", " ")
    parts = text.split(" ")
    return parts if "" not in parts else [s[1:] for s in STRETCH.findall(" " + text)]


def distinct_pre_tokens(docs: DataFrame) -> DataFrame:
    """piece, freq: over all documents, added up within tasks first."""

    def run(batches):
        held: Counter = Counter()
        for batch in batches:
            for text in common.texts_of(batch):
                held.update(pre_tokens(text))
                if len(held) > GATHERED:
                    yield rows(held)
                    held = Counter()
        if held:
            yield rows(held)

    def rows(held):
        return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["piece", "freq"])

    found = docs.select("text").mapInArrow(common.handing_back(run), "piece string, freq bigint")
    return found.groupBy("piece").agg(F.sum("freq").alias("freq"))


def count_pieces(pieces: DataFrame, model: str) -> DataFrame:
    """Adds tokens: how many the tokenizer makes of a pre-token."""

    def run(batch: pa.RecordBatch) -> dict:
        encoded = vocab.piece_tokenizer(model).encode(batch.column("piece").to_pylist(), num_threads=1)
        # A lone space is one token, but the empty text it is kept as has none.
        return {"piece": batch.column("piece"), "freq": batch.column("freq"), "tokens": pa.array([max(1, len(e)) for e in encoded], pa.int64())}

    return common.per_batch(pieces, run, "piece string, freq bigint, tokens bigint")


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document of `docs` (doc_id, text).

    Null texts count as empty: no bytes, no tokens. Rows of equal doc_id are counted each; of rows equal
    in doc_id and text each gives a row. Other columns are ignored; an empty table gives an empty table.
    """
    counted = common.stored(count_pieces(distinct_pre_tokens(docs), model), "pre-tokens")
    top = counted.where(F.octet_length("piece") <= HELD_BYTES).orderBy(F.desc("freq"), "piece").limit(HELD).select("piece", "tokens")
    held = docs.sparkSession.sparkContext.broadcast({r["piece"]: r["tokens"] for r in top.toLocalIterator()})

    def run(batches):
        known = held.value
        for batch in batches:
            doc, key, size, piece, number = [], [], [], [], []
            ids, keys = batch.column("doc_id").to_pylist(), batch.column("key").to_pylist()
            for d, k, text in zip(ids, keys, common.texts_of(batch)):
                total, open_ = 0, []
                for p, n in Counter(pre_tokens(text)).items():
                    if p in known:
                        total += n * known[p]
                    else:
                        open_.append((p, n))
                # The document's own row: no pre-token has a space within, so its name meets none.
                rows = [(f"- {d} {k}", total), *open_]
                doc += [d] * len(rows)
                key += [k] * len(rows)
                size += [len(text.encode()), *[None] * len(open_)]
                piece += [r[0] for r in rows]
                number += [r[1] for r in rows]
            columns = [pa.array(c, pa.int64()) for c in (doc, key, size, number)] + [pa.array(piece, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_bytes", "number", "piece"])

    schema = "doc_id bigint, key bigint, n_bytes bigint, number bigint, piece string"
    parts = docs.select("doc_id", "text", common.text_key("text").alias("key")).mapInArrow(common.handing_back(run), schema)
    joined = parts.join(counted.select("piece", F.col("tokens").alias("each")), "piece", "left")
    total = F.sum(F.when(F.col("n_bytes").isNotNull(), F.col("number")).otherwise(F.col("number") * F.col("each")))
    per_doc = joined.groupBy("doc_id", "key").agg(total.alias("total"), F.max("n_bytes").alias("n_bytes"), F.count("n_bytes").alias("copies"))
    return per_doc.select(
        "doc_id", "n_bytes", F.expr("total div copies").alias("n_tokens"), F.expr(f"total div copies > {limit}").alias("over_limit"),
        F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
    ).drop("copy")
