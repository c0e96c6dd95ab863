"""Packing documents into sequences of a fixed number of tokens.

Dominance reduction after Martello and Toth: a document is fixed for good beside a
partner whenever that set is at least as good as every other set it could share a
sequence with; what is left is packed best-fit, longest first. Both work on the
counts of lengths (at most `capacity` numbers, whatever the corpus), which is all
the driver sees. Documents learn their place from their rank among those of equal
length.
"""

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common, vocab

#: Pieces of one length that a task ranks at a time, on average at most.
RANKED_TOGETHER = 20_000
LEAST_PARTS = 128


@dataclass
class Group:
    """`times` sequences filled alike: (length, copies) in order."""

    items: list[tuple[int, int]]
    times: int


def _fits(present: np.ndarray, capacity: int) -> np.ndarray:
    """largest[x]: the largest present length of at most x, 0 if none."""
    marks = np.zeros(capacity + 1, dtype=np.int64)
    marks[present] = present
    return np.maximum.accumulate(marks)


def reduce_by_dominance(counts: np.ndarray, capacity: int) -> list[Group]:
    """Fix dominating sets, longest document first; `counts` keeps what stays open.

    A document j and partner k (the longest that fits) are fixed if they fill the
    sequence, if no two documents fit beside j, or if no three do and k is at least as
    long as any two that do: any other set with j could swap its rest for k. A
    document that nothing fits beside is fixed alone.
    """
    fixed = []
    changed = True
    while changed:
        changed = False
        for length in np.flatnonzero(counts)[::-1]:
            length = int(length)
            while counts[length]:
                counts[length] -= 1  # j itself
                room = capacity - length
                present = np.flatnonzero(counts)
                largest = _fits(present, capacity)
                k = int(largest[room])
                if k == 0:
                    times = int(counts[length]) + 1
                    counts[length] = 0
                    fixed.append(Group([(length, 1)], times))
                    changed = True
                    break
                if k != room and not _partner_dominates(counts, present, largest, room, k):
                    counts[length] += 1
                    break
                if k == length:
                    times = (int(counts[length]) + 1) // 2
                    counts[length] += 1 - 2 * times
                    fixed.append(Group([(length, 2)], times))
                else:
                    # Beside the copies of both lengths the test is the same again: what fits only grows scarcer.
                    times = min(int(counts[length]) + 1, int(counts[k]))
                    counts[length] -= times - 1
                    counts[k] -= times
                    fixed.append(Group([(length, 1), (k, 1)], times))
                changed = True
    return fixed


def _partner_dominates(counts, present, largest, room: int, k: int) -> bool:
    smallest = np.repeat(present[:3], np.minimum(counts[present[:3]], 3))[:3]
    if len(smallest) < 2 or smallest[:2].sum() > room:
        return True
    if len(smallest) == 3 and smallest.sum() <= room:
        return False
    first = present[present < room]
    second = largest[room - first]
    lone = (second == first) & (counts[first] < 2)
    if lone.any():  # a length that is there once makes no pair with itself
        second[lone] = largest[first[lone] - 1]
    pairs = np.where(second > 0, first + second, 0)
    return int(pairs.max(initial=0)) <= k


def best_fit(counts: np.ndarray, capacity: int) -> list[Group]:
    """Best-fit decreasing on counts of lengths: each length goes where least room is left that it fits in."""
    open_: dict[int, list[Group]] = {}
    for length in np.flatnonzero(counts)[::-1]:
        length, left = int(length), int(counts[length])
        while left:
            room = min((r for r in open_ if r >= length), default=None)
            if room is None:
                per = capacity // length
                room, group = capacity, Group([], -(-left // per))
            else:
                group = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                per = room // length
            full = min(group.times, left // per)
            if full:
                open_.setdefault(room - per * length, []).append(Group([*group.items, (length, per)], full))
            left -= full * per
            rest = group.times - full
            if rest and 0 < left:  # then left < per: one sequence takes them all
                open_.setdefault(room - left * length, []).append(Group([*group.items, (length, left)], 1))
                rest, left = rest - 1, 0
            if rest and group.items:
                open_.setdefault(room, []).append(Group(group.items, rest))
    return [g for groups in open_.values() for g in groups]


def plan(counts: np.ndarray, capacity: int) -> list[Group]:
    """Sequences for `counts[length]` documents of each length."""
    left = counts.astype(np.int64).copy()
    return reduce_by_dominance(left, capacity) + best_fit(left, capacity)


def places(groups: list[Group]) -> dict[str, np.ndarray]:
    """Ranges of ranks per length, ordered by length and rank: where each range's documents go.

    The document of `length` and rank r, `start` <= r < `start` of the next range, goes to sequence
    `sequence + (r - start) // copies`, at `offset + (r - start) % copies * length`.
    """
    rows, sequence = [], 0
    used: dict[int, int] = {}
    for g in groups:
        offset = 0
        for length, copies in g.items:
            start = used.get(length, 0)
            rows.append((length, start, sequence, offset, copies))
            used[length] = start + copies * g.times
            offset += copies * length
        sequence += g.times
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 5).T
    return dict(zip(("length", "start", "sequence", "offset", "copies"), columns))


def encode_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: documents as ids plus `end_id`, cut only if longer than `capacity`."""
    end = vocab.ids_to_bytes([end_id])

    def run(batch: pa.RecordBatch) -> dict:
        memory = vocab.word_memory(tokenizer)
        out = {n: [] for n in ("row", "piece", "start", "length", "ids_crc32")}
        for row, ids in enumerate(vocab.word_ids(memory, common.texts_of(batch))):
            ids += end
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at : at + 4 * capacity]
                for name, value in zip(out, (row, piece, at // 4, len(part) // 4, zlib.crc32(part))):
                    out[name].append(value)
        return {
            "doc_id": batch.column("doc_id").take(pa.array(out["row"], pa.int64())),
            "piece": pa.array(out["piece"], pa.int32()),
            **{n: pa.array(out[n], pa.int64()) for n in ("start", "length", "ids_crc32")},
        }

    return common.per_batch(docs.select("doc_id", "text"), run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint", holds=True)


def pack(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs` (doc_id, text).

    Null and empty texts are the end id alone. Longer documents than `capacity` are cut
    into full pieces and a last one. Rows of equal doc_id are documents of their own. Other columns are
    ignored. An empty table gives an empty table. A sequence is filled without gaps from 0.
    """
    pieces = common.stored(encode_pieces(docs, tokenizer, capacity, end_id), "pieces")
    by_length = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in by_length:
        counts[r["length"]] = r["n"]
    where = pieces.sparkSession.sparkContext.broadcast(places(plan(counts, capacity)))

    parts = max(LEAST_PARTS, int(counts.max()) // RANKED_TOGETHER)
    part = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts))
    cell = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    ranked = pieces.withColumn("part", part).withColumn("rank", F.row_number().over(cell) - 1)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = pieces.withColumn("part", part).groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    sizes = sizes.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = ranked.join(sizes, ["length", "part"]).withColumn("rank", F.col("rank") + F.col("before"))

    def place(batch: pa.RecordBatch) -> dict:
        w = where.value
        length, rank = (batch.column(n).to_numpy(zero_copy_only=False).astype(np.int64) for n in ("length", "rank"))
        at = np.empty(len(length), dtype=np.int64)
        for value in np.unique(length):
            lo, hi = np.searchsorted(w["length"], [value, value + 1])
            mine = length == value
            at[mine] = lo + np.searchsorted(w["start"][lo:hi], rank[mine], side="right") - 1
        k = rank - w["start"][at]
        return {
            **{n: batch.column(n) for n in ("doc_id", "piece", "start", "length", "ids_crc32")},
            "sequence_id": w["sequence"][at] + k // w["copies"][at],
            "offset": w["offset"][at] + k % w["copies"][at] * length,
        }

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"
    return common.per_batch(ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank"), place, schema, holds=True)
