"""Byte-level BPE encoding and decoding, long texts in overlapping chunks.

Texts longer than `chunk` characters become chunks that reach `overlap` characters into the next one. Every
chunk is split into pre-tokens by itself, from its first character on. The split pattern never looks back,
so as soon as two neighbours have a pre-token boundary in common, they agree from there on: the left one is
used up to that boundary, the right one after it. A text in which two neighbours have no common boundary in the overlap
(a run of letters longer than that) is encoded in one piece.
"""

import functools
from collections import defaultdict

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common, vocab

CHUNK, OVERLAP = 32_768, 1_024


@functools.lru_cache(maxsize=2)
def _encoder(ranks: str, pattern: str):
    """(split pattern, pre-token -> ids as bytes)."""
    import tiktoken

    bpe = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=vocab.rank_file(ranks), special_tokens={})
    merge = bpe._core_bpe.encode_single_piece
    return regex.compile(pattern), vocab.Memory(lambda piece: vocab.ids_to_bytes(merge(piece.encode())), vocab.PIECES_REMEMBERED)


@functools.lru_cache(maxsize=2)
def _bytes_of_ids(ranks: str) -> list[bytes]:
    by_rank = {r: b for b, r in vocab.rank_file(ranks).items()}
    return [by_rank.get(i, b"") for i in range(max(by_rank) + 1)]


def encode_text(text: str, ranks: str, pattern: str) -> bytes:
    split, memory = _encoder(ranks, pattern)
    return b"".join(map(memory.__getitem__, split.findall(text)))


def decode_ids(ids: bytes, ranks: str) -> bytes:
    """The raw bytes of ids (little-endian unsigned 32-bit), one after the other."""
    return b"".join(map(_bytes_of_ids(ranks).__getitem__, memoryview(ids).cast("I")))


def encode_chunk(text: str, head: int, tail: int, last: bool, ranks: str, pattern: str):
    """A chunk's ids: pre-token starts in its first `head` characters, its middle, those from `tail` on.

    Both lists hold (position, ids of the pre-token that starts there). If more text follows, the pre-token at the
    chunk's end may be cut: its start is listed, without ids.
    """
    split, memory = _encoder(ranks, pattern)
    starts, middle, ends = [], [], []
    for m in split.finditer(text):
        at, ids = m.start(), memory[m.group()]
        if not last and m.end() == len(text):
            ids = b""
        if at < head:
            starts.append((at, ids))
        elif last or at < tail:
            middle.append(ids)
        else:
            ends.append((at - tail, ids))
    return starts, b"".join(middle), ends


def stitch(chunks: list[tuple]) -> bytes | None:
    """Ids of a text from its chunks' (starts, middle, ends) in order; None if two neighbours never agree."""
    out = []
    for i, (starts, middle, ends) in enumerate(chunks):
        if i:
            out.append(b"".join(ids for at, ids in starts if at >= joint))
        else:
            out.append(b"".join(ids for _, ids in starts))
        out.append(middle)
        if i + 1 < len(chunks):
            right = {at for at, _ in chunks[i + 1][0]}
            joint = next((at for at, _ in ends if at in right), None)
            if joint is None:
                return None
            out.append(b"".join(ids for at, ids in ends if at < joint))
    return b"".join(out)


CHUNK_PARTS = (
    "doc_id bigint, key bigint, row bigint, chunk int, start_at array<int>, start_ids array<binary>, middle binary, "
    "end_at array<int>, end_ids array<binary>"
)


def _long(chunk: int):
    return F.coalesce(F.length("text"), F.lit(0)) > chunk


def _encode_chunks(docs: DataFrame, ranks: str, pattern: str, chunk: int, overlap: int) -> DataFrame:
    def cut(batches):
        for batch in batches:
            for doc, key, text in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "key", "text"))):
                n = max(1, -(-(len(text) - overlap) // chunk))
                for i in range(n):
                    piece = text[i * chunk : (i + 1) * chunk + overlap] if i + 1 < n else text[i * chunk :]
                    yield pa.RecordBatch.from_pylist(
                        [{"doc_id": doc, "key": key, "chunk": i, "last": i + 1 == n, "piece": piece}],
                        schema=pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("chunk", pa.int32()), ("last", pa.bool_()), ("piece", pa.string())]),
                    )

    def encode(batch: pa.RecordBatch) -> dict:
        rows = batch.to_pylist()
        parts = [encode_chunk(r["piece"], overlap if r["chunk"] else 0, chunk, r["last"], ranks, pattern) for r in rows]
        return {
            **{n: batch.column(n) for n in ("doc_id", "key", "chunk")},
            "start_at": pa.array([[a for a, _ in p[0]] for p in parts], pa.list_(pa.int32())),
            "start_ids": pa.array([[b for _, b in p[0]] for p in parts], pa.list_(pa.binary())),
            "middle": pa.array([p[1] for p in parts], pa.binary()),
            "end_at": pa.array([[a for a, _ in p[2]] for p in parts], pa.list_(pa.int32())),
            "end_ids": pa.array([[b for _, b in p[2]] for p in parts], pa.list_(pa.binary())),
        }

    pieces = docs.mapInArrow(common.handing_back(cut), "doc_id bigint, key bigint, chunk int, last boolean, piece string")
    spread = pieces.repartition("doc_id", "key", "chunk")
    return common.per_batch(spread, encode, CHUNK_PARTS.replace("row bigint, ", ""))


def encode(docs: DataFrame, ranks: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit) of every document of `docs` (doc_id, text).

    Null texts count as empty and have no ids. Rows of equal doc_id are encoded each; rows equal in doc_id and text
    give a row each. Other columns are ignored; an empty table gives an empty table.
    """

    def whole(batch: pa.RecordBatch) -> dict:
        return {"doc_id": batch.column("doc_id"), "ids": pa.array([encode_text(t, ranks, pattern) for t in common.texts_of(batch)], pa.binary())}

    rows = docs.select("doc_id", "text")
    short = common.per_batch(rows.where(~_long(chunk)), whole, "doc_id bigint, ids binary")

    long_rows = rows.where(_long(chunk)).withColumn("key", common.text_key("text"))
    parts = _encode_chunks(long_rows, ranks, pattern, chunk, overlap)

    def join_up(batch: pa.RecordBatch) -> dict:
        ids, copies = [], []
        for parts in batch.column("parts").to_pylist():
            by_chunk = defaultdict(list)
            for p in parts:
                by_chunk[p["chunk"]].append(p)
            first = [by_chunk[i][0] for i in range(len(by_chunk))]
            ids.append(stitch([(list(zip(p["start_at"], p["start_ids"])), p["middle"], list(zip(p["end_at"], p["end_ids"]))) for p in first]))
            copies.append(len(by_chunk[0]))
        return {"doc_id": batch.column("doc_id"), "key": batch.column("key"), "ids": pa.array(ids, pa.binary()), "copies": pa.array(copies, pa.int64())}

    columns = ["chunk", "start_at", "start_ids", "middle", "end_at", "end_ids"]
    by_doc = parts.groupBy("doc_id", "key").agg(F.collect_list(F.struct(*columns)).alias("parts"))
    stitched = common.stored(common.per_batch(by_doc, join_up, "doc_id bigint, key bigint, ids binary, copies bigint"), "stitched")
    done = stitched.where("ids IS NOT NULL").select("doc_id", "ids", F.explode(F.expr("sequence(1L, copies)")).alias("copy")).drop("copy")
    open_ = stitched.where("ids IS NULL").select(F.col("doc_id").alias("open_id"), F.col("key").alias("open_key"))
    again = long_rows.join(open_, F.col("doc_id").eqNullSafe(F.col("open_id")) & (F.col("key") == F.col("open_key")), "left_semi")
    return short.unionByName(done).unionByName(common.per_batch(again.select("doc_id", "text"), whole, "doc_id bigint, ids binary"))


def decode(encoded: DataFrame, ranks: str) -> DataFrame:
    """Adds text (binary): the bytes of `ids`; null ids have none."""

    def run(batch: pa.RecordBatch) -> dict:
        ids = batch.column("ids")
        return {"doc_id": batch.column("doc_id"), "ids": ids, "text": pa.array([decode_ids(i or b"", ranks) for i in ids.to_pylist()], pa.binary())}

    return common.per_batch(encoded.select("doc_id", "ids"), run, "doc_id bigint, ids binary, text binary")
