"""Removal of passages that occur more than once, by prefix-partitioned suffix trees over words.

A window is `window` consecutive words of a document. Of the suffixes that start within a window, the one whose first `prefix` words hash
lowest stands for it (its anchor); equal windows have equal anchors at equal places, so only anchors are indexed, about one suffix in a
dozen. They are split by their prefixes:

1. A prefix that occurs once leads to a leaf too high up in the tree: nothing that starts so repeats.
2. Suffixes that agree in everything their windows cover are one leaf class. Where a class occurs twice, all its windows repeat.
3. Prefixes that several classes share form memory-sized groups. Each group's subtrees are built over the words themselves: all suffixes of a group
   are sorted, neighbours' common lengths computed, and every internal node at least `window` words deep marks the suffixes below it.
4. A prefix that more than CROWDED classes share is made longer, up to whole windows: then a prefix is a deep node by itself, and counting
   its suffixes, within tasks first, is enough. So no task holds an unbounded group.

Maximal repeats are the unions of windows found to repeat. Class, prefix and window equality in 1, 2 and 4 is that of 64-bit hashes
(taken together with the prefix hash); 3 compares words.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common

#: Suffixes a task gathers before it adds up those that agree.
GATHERED = 500_000
#: Classes that one prefix may have in a subtree; beyond, prefixes get longer.
CROWDED = 2_000
#: Suffixes whose documents are sent to every executor at most; beyond that, the documents are shuffled.
SENT_WHOLE = 1_000_000
#: A suffix stands for windows that start at most this many words before it, less one.
MOST_BEFORE = 24
_R = 0x9E3779B97F4A7C15 | 1


def prefix_words(window: int) -> int:
    return max(-(-window // 3), window - MOST_BEFORE + 1)


class Anchors:
    """Suffixes that stand for the windows of a batch of texts: row, word position, the windows' first and last start, prefix hash, class hash."""

    def __init__(self, column: pa.Array, window: int):
        prefix = prefix_words(window)
        self.words = words = common.Words(column)
        self.window, n = window, len(words)
        counts = words.counts()
        ends = np.repeat(words.first[1:], counts)
        starts = np.flatnonzero(ends - np.arange(n) >= window)
        self.hashes = hashes = words.hashes() if len(starts) else np.zeros(n, np.uint64)
        if not len(starts):
            empty = np.zeros(0, dtype=np.int64)
            self.row = self.at = self.low = self.high = self.first = empty
            self.key = self.cls = empty.astype(np.uint64)
            return
        order = common.grams(hashes, prefix)
        best, size, spread = np.arange(len(order)), 1, window - prefix + 1
        while size < spread:
            step = min(size, spread - size)
            left, right = best[:-step], best[step:]
            best = np.where(order[right] < order[left], right, left)
            size += step
        anchor = best[starts]
        edge = np.flatnonzero(np.diff(anchor, prepend=-1))
        last = np.append(edge[1:], len(anchor)) - 1
        place = anchor[edge]
        self.low, self.high = starts[edge], starts[last]
        self.row = np.searchsorted(words.first, place, side="right") - 1
        self.first = words.first[self.row]
        self.key = order[place]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * common.powers(_R, n), dtype=np.uint64)])
        back = common.powers(pow(_R, -1, 2**64), n)
        self.at = place - self.first
        text = (sums[self.high + window] - sums[self.low]) * back[self.low]
        shape = ((place - self.low).astype(np.uint64) << np.uint64(32)) + (place - self.high).astype(np.uint64)
        self.cls = common.chain(common.mix(text), shape)

    def packed(self) -> np.ndarray:
        """Position, and how many words before it its first and last window start, in one number."""
        place = self.at + self.first
        return (self.at << 16) + ((place - self.low) << 8) + (place - self.high)


def _unpack(at: np.ndarray):
    return at >> 16, (at >> 8) & 255, at & 255


def _rows(docs: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """The columns kept, under one name, beside the text and the number of the row's document."""
    others = dict.fromkeys(["doc_id", *keep])
    others.pop("text", None)
    return docs.select("text", F.xxhash64("text", "doc_id").alias("doc"), F.struct(*others).alias("row"))


def suffix_classes(rows: DataFrame, window: int) -> DataFrame:
    """key, cls, n, doc, at, classes: every class of a prefix that occurs more than once, with one of its suffixes."""

    def emit(batches):
        held, size = [], 0
        for batch in batches:
            a = Anchors(batch.column("text"), window)
            doc = batch.column("doc").to_numpy()
            held.append((a.key, a.cls, doc[a.row], a.packed()))
            size += len(a.key)
            if size >= GATHERED:
                yield add_up(held)
                held, size = [], 0
        if size:
            yield add_up(held)

    def add_up(held):
        key, cls, doc, at = (np.concatenate(c) for c in zip(*held))
        order = np.lexsort((cls, key))
        key, cls = key[order], cls[order]
        first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])]))
        n = np.diff(np.append(first, len(key)))
        columns = (common.signed(key[first]), common.signed(cls[first]), n, doc[order][first], at[order][first])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "cls", "n", "doc", "at"])

    found = rows.select("text", "doc").mapInArrow(common.handing_back(emit), "key bigint, cls bigint, n bigint, doc bigint, at bigint")
    by_key = Window.partitionBy("key")
    merged = found.repartition("key").groupBy("key", "cls").agg(F.sum("n").alias("n"), F.min(F.struct("doc", "at")).alias("one"))
    counted = merged.withColumn("classes", F.count(F.lit(1)).over(by_key)).where("classes > 1 OR n > 1")
    return counted.select("key", "cls", "n", "one.doc", "one.at", "classes")


def deep_suffixes(ids: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Subtree of the suffixes at `starts`: the number of the internal node `window` deep that each is below (-1: below none).

    `ids` are word numbers, of passages one after the other; each suffix has `window` words within its own. Suffixes are sorted by doubling
    the length their ranks stand for; neighbours with equal ranks at `window` words have a common length of at least that, and a run of such
    neighbours is a deep node.
    """
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    rank, length = ids.astype(np.int64), 1
    while length < window:
        step = min(length, window - length)
        pairs = rank[:-step] * (int(rank.max()) + 1) + rank[step:]
        if 2 * length >= window:  # only the wanted suffixes any more
            pairs = pairs[starts]
        rank = np.unique(pairs, return_inverse=True)[1]
        length += step
    if window == 1:
        rank = rank[starts]
    order = np.argsort(rank, kind="stable")
    deep = np.concatenate([rank[order][1:] == rank[order][:-1], [False]])
    below = deep | np.concatenate([[False], deep[:-1]])
    node = np.full(len(starts), -1, dtype=np.int64)
    node[order[below]] = rank[order[below]]
    return node


def _trees(passages: DataFrame, window: int) -> DataFrame:
    """key, cls, mask of passages (key, cls, at, words): bit d says that the window starting d words before the anchor repeats."""

    def build(table: pa.Table) -> pa.RecordBatch:
        words = table.column("words").combine_chunks()
        sizes = np.diff(words.offsets.to_numpy())
        first = np.cumsum(sizes) - sizes
        ids = words.flatten().dictionary_encode().indices.to_numpy()
        _, high, low = _unpack(table.column("at").to_numpy())
        n = high - low + 1  # windows of a passage; the first starts with it
        owner = np.repeat(np.arange(len(n)), n)
        offset = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        node = deep_suffixes(ids, first[owner] + offset, window)
        bits = np.where(node >= 0, np.left_shift(np.int64(1), high[owner] - offset), 0)
        masks = np.bitwise_or.reduceat(bits, np.cumsum(n) - n)
        some = np.flatnonzero(masks)
        columns = [table.column(c).combine_chunks().take(pa.array(some)) for c in ("key", "cls")]
        return pa.RecordBatch.from_arrays([*columns, pa.array(masks[some], pa.int64())], ["key", "cls", "mask"])

    def run(batches):
        open_ = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if open_ is not None:
                table = pa.concat_tables([open_, table])
            keys = table.column("key").to_numpy()
            whole = int(np.searchsorted(keys == keys[-1], True)) if len(keys) else 0  # where the last prefix begins
            open_ = table.slice(whole)
            if whole:
                yield build(table.slice(0, whole))
        if open_ is not None and open_.num_rows:
            yield build(open_)

    grouped = passages.repartition("key").sortWithinPartitions("key")
    return grouped.mapInArrow(common.handing_back(run), "key bigint, cls bigint, mask bigint")


def repeated_windows(rows: DataFrame, window: int) -> DataFrame:
    """key, cls, mask of every class with a repeated window; mask -1 stands for all its windows."""
    classes = common.stored(suffix_classes(rows, window), "suffix-classes")
    full = classes.where("n > 1").select("key", "cls", F.lit(-1).cast("long").alias("mask"))
    shared = classes.where("classes > 1")
    wanted = shared.select("doc", F.struct("at", F.col("n").alias("n"), (F.col("classes") > CROWDED).alias("crowded")).alias("one"))
    by_doc = wanted.groupBy("doc").agg(F.collect_list("one").alias("wanted"))
    by_doc = F.broadcast(by_doc) if shared.count() <= SENT_WHOLE else by_doc
    asked = rows.join(by_doc, "doc").select("text", "wanted")

    def cut(batch: pa.RecordBatch):
        a = Anchors(batch.column("text"), window)
        lists = batch.column("wanted")
        sizes = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten()
        at = flat.field("at").to_numpy()
        row = np.repeat(np.arange(len(sizes)), sizes)
        # Anchors and wanted ones meet by row and position.
        have = (a.row.astype(np.int64) << 40) + a.at
        found = np.searchsorted(have, (row.astype(np.int64) << 40) + (at >> 16))
        return a, found, at, flat.field("n").to_numpy(), flat.field("crowded").to_numpy(zero_copy_only=False)

    def passages(batch: pa.RecordBatch) -> dict:
        a, found, at, _, crowded = cut(batch)
        found, at = found[~crowded], at[~crowded]
        data, starts, ends = a.words.data.tobytes(), a.words.starts.tolist(), a.words.ends.tolist()
        text = [[data[starts[i] : ends[i]] for i in range(low, high)] for low, high in zip(a.low[found].tolist(), (a.high[found] + window).tolist())]
        return {"key": common.signed(a.key[found]), "cls": common.signed(a.cls[found]), "at": at, "words": pa.array(text, pa.list_(pa.binary()))}

    def windows(batch: pa.RecordBatch) -> dict:
        a, found, _, n, crowded = cut(batch)
        found, n = found[crowded], n[crowded]
        each = a.high[found] - a.low[found] + 1
        owner = np.repeat(found, each)
        start = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each) + a.low[owner]
        whole = common.grams(a.hashes, window)
        return {
            "key": common.signed(a.key[owner]), "cls": common.signed(a.cls[owner]), "n": np.repeat(n, each),
            "before": (a.at + a.first)[owner] - start, "whole": common.signed(whole[start]),
        }

    mixed = asked.where(F.exists("wanted", lambda w: ~w["crowded"]))
    crowds = asked.where(F.exists("wanted", lambda w: w["crowded"]))
    trees = _trees(common.per_batch(mixed, passages, "key bigint, cls bigint, at bigint, words array<binary>"), window)

    longer = common.per_batch(crowds, windows, "key bigint, cls bigint, n bigint, before bigint, whole bigint").distinct()
    nodes = longer.groupBy("key", "before", "whole").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
    marked = longer.drop("n").join(nodes, ["key", "before", "whole"])
    crowded = marked.groupBy("key", "cls").agg(F.bit_or(F.expr("shiftleft(1L, cast(before as int))")).alias("mask"))

    every = full.unionByName(trees).unionByName(crowded)
    return every.groupBy("key", "cls").agg(F.bit_or("mask").alias("mask"))


def remove_repeats(docs: DataFrame, window: int = 35, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep`, n_words, n_removed and kept of every document of `docs` (doc_id, text).

    A word is removed if a window that covers it also starts elsewhere, in the same document or another; windows are judged on the
    input. kept is the other words joined by one space. Null and empty texts have no words and keep an empty text. Documents shorter than a window keep
    all words. Repeated rows are documents of their own, so their windows repeat. Columns not kept are ignored; kept ones must not be named
    n_words, n_removed or kept; an empty table gives an empty
    table.
    """
    rows = _rows(docs, keep)
    marks = common.stored(repeated_windows(rows, window), "repeated-windows")

    def locate(batch: pa.RecordBatch) -> dict:
        a = Anchors(batch.column("text"), window)
        return {"key": common.signed(a.key), "cls": common.signed(a.cls), "doc": batch.column("doc").to_numpy()[a.row], "at": a.packed()}

    suffixes = common.per_batch(rows.select("text", "doc"), locate, "key bigint, cls bigint, doc bigint, at bigint")
    hits = suffixes.join(marks, ["key", "cls"]).groupBy("doc").agg(F.collect_set(F.struct("at", "mask")).alias("hits"))

    def cut_out(batch: pa.RecordBatch) -> dict:
        words = common.Words(batch.column("text"))
        lists = batch.column("hits")
        cover = np.zeros(len(words) + 1, dtype=np.int64)
        sizes = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
        flat = lists.flatten()
        if len(flat):
            sizes = np.where(lists.is_null().to_numpy(zero_copy_only=False), 0, sizes)
            row = np.repeat(np.arange(len(sizes)), sizes)
            at, high, low = _unpack(flat.field("at").to_numpy())
            mask = flat.field("mask").to_numpy()
            place = words.first[row] + at
            for before in range(int(high.max()) + 1):
                on = (before >= low) & (before <= high) & ((mask >> np.minimum(before, 63)) & 1 == 1)
                np.add.at(cover, place[on] - before, 1)
                np.add.at(cover, place[on] - before + window, -1)
        stays = np.cumsum(cover)[:-1] <= 0
        kept, removed = [], []
        for i, text in enumerate(common.texts_of(batch)):
            mine = stays[words.first[i] : words.first[i + 1]]
            own = text.encode().split()  # bytes.split() knows exactly the ASCII white space
            removed.append(int(len(mine) - mine.sum()))
            kept.append(b" ".join(own if not removed[-1] else [w for w, s in zip(own, mine.tolist()) if s]).decode())
        return {
            "n_words": pa.array(words.counts(), pa.int64()),
            "n_removed": pa.array(removed, pa.int64()), "kept": pa.array(kept, pa.string()),
        }

    joined = rows.join(hits, "doc", "left").select("row", "text", "hits")
    out = common.per_batch(joined, cut_out, "n_words bigint, n_removed bigint, kept string", ("row", "text"))
    return out.select(*[F.col("text") if c == "text" else F.col(f"row.{c}") for c in keep], "n_words", "n_removed", "kept")
