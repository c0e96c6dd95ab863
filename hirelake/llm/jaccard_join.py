"""Documents with nearly equal sets of word shingles: a parity-sketch join.

A set's sketch is cut into parts. Each shingle belongs to one part by its hash and flips one of the part's 2^64 bits, so sketches of
two sets differ in no more bits than the sets in shingles. Sets similar enough differ in at most `reach` shingles; with one
part more than that, some part is the same in both. So documents meet by equality on (size cell, part, bits), and every pair that
is to be linked meets. Sizes are covered by overlapping cells, since similar sets have similar sizes. Parts this wide are never
written out: a part stands as the sum without carry of the scrambled places of its set bits, so unlike sets meet by shared shingles only,
not by chance. There are as many parts more than needed as are likely to be empty, so that empty parts, alike in unlike sets, are hardly ever keys.

Keys travel packed: a task gathers many, deals them into buckets by their upper bits and hands on one packed row a bucket.

Documents of equal sets are one class and go through once. In a group of classes that meet, each meets the smallest only, within tasks first,
and is compared with the smallest, so the work grows with the group, not with its square. Classes that end up connected need no more
comparing. In the groups that still hold several components, whole sketches (some bits for each shingle) are compared across components, block by block within
tasks that hold a block while the rest of its group passes by; members of pairs that these do not rule out, each once a group, travel again with their sets, and every
such pair is compared exactly or connected within its task, which hands on the links that connect, fewer than members. No pair is left out, and none is made a row.

Linked sets are of one component, so links are counted once the components are known: all pairs of a component's classes, block by block within
tasks, which hand on a count per class and no pairs. That work grows with the square of a component, and its sets travel once a block.
"""

import functools
import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common
from hirelake.llm.components import components

#: Bits of a whole sketch for each shingle, at least, and of any sketch at least; rounded up to a power of two.
BITS_PER_SHINGLE, LEAST_BITS = 1, 256
#: Keys a task gathers before it links those that are alike among them and hands them on.
GATHERED = 500_000
#: Width of a size cell: its largest size over its smallest.
CELL_RATIO = 1.6
#: Sketches of at least so many parts have more of them than are needed, so that empty parts, which many documents share, need not be joined on.
SPARE_FROM = 8
#: Keys of all documents that go into one bucket, about; a task holds one bucket.
KEYS_IN_BUCKET = 1_000_000
#: Bits of a key that travel. Keys that are alike in them meet, so fewer bits only make pairs that the sketches rule out.
KEY_BITS = 46
#: Members of a group all of whose pairs are made at once.
FEW_MEMBERS = 4
#: Members of a larger group, or of a component when links are counted, that make one block; a task compares two blocks.
COMPARED_TOGETHER = 512
#: Rows that are sent to every executor at most, else joined by a shuffle.
SENT_WHOLE = 200_000
#: Shingles of the sets of one block, about; a task holds two blocks.
SHINGLES_TOGETHER = 1 << 20


@dataclass(frozen=True)
class Likeness:
    """Sets are linked if their Jaccard similarity is at least `least` / `of`; shingles have `words` words."""

    words: int = 5
    least: int = 4
    of: int = 5

    def reach(self, sizes: int) -> int:
        """How many shingles may be in one of two linked sets only, given the sum of their sizes."""
        return sizes * (self.of - self.least) // (self.of + self.least)

    def cells(self, largest: int) -> list[tuple[int, int]]:
        """(smallest, largest size) of overlapping cells; any two linked, different sets share one."""
        low = next(n for n in itertools.count(1) if self.reach(n + n * self.of // self.least) >= 1)
        out, high = [], 0
        while high < largest:
            high = max(int(low * CELL_RATIO), high + 1, low + 1)
            out.append((low, high))
            low = -(-self.least * (high + 1) // self.of)
        return out

    @functools.lru_cache(maxsize=1024)
    def parts(self, low: int, high: int) -> tuple[int, int]:
        """Parts of the sketches of a cell, and how many of them are spare."""
        reach, spare = self.reach(2 * high), 0
        while reach >= SPARE_FROM:
            parts = reach + 1 + spare
            empty = parts * math.exp(-low / parts)  # of the smallest sets, on average
            if spare > empty + 2 * math.sqrt(empty):
                break
            spare += 1
        return reach + 1 + spare, spare


def shingle_sets(column: pa.Array, words: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, A-Z lower-cased. A text of fewer words is one shingle."""
    w = common.Words(column, lower=True)
    hashes = w.hashes()
    runs = common.grams(hashes, words)
    out = []
    for a, b in zip(w.first[:-1].tolist(), w.first[1:].tolist()):
        if b - a >= words:
            found = np.sort(runs[a : b - words + 1])
            out.append(found[np.concatenate([[True], found[1:] != found[:-1]])])
        elif b > a:
            out.append(common.mix(common.grams(hashes[a:b], b - a) + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _class(found: np.ndarray) -> np.uint64:
    """Tells sets apart whatever their order: two sums over scrambled members, and the size."""
    if not len(found):
        return np.uint64(0)
    one, two = common.mix(found + np.uint64(0x51)), common.mix(found ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    total = np.array([one.sum(dtype=np.uint64), np.bitwise_xor.reduce(two), len(found)], dtype=np.uint64)
    return common.chain(common.chain(total[:1], total[1:2]), total[2:])[0]


def _sketch(found: np.ndarray) -> np.ndarray:
    """A power of two of bits as 64-bit integers, each bit the parity of the shingles that fall on it.

    The two halves added without carry are the sketch of half the size, so sketches of any sizes compare.
    """
    bits = max(LEAST_BITS, 1 << (BITS_PER_SHINGLE * len(found) - 1).bit_length()) if len(found) else LEAST_BITS
    places = (common.mix(found ^ np.uint64(0x0DD)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits).astype(np.uint8) & 1).view(np.int64)


def summaries(docs: DataFrame, words: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """keep..., doc_id, n_shingles, cls, sketch of each document; cls stands for the set."""

    def run(batch: pa.RecordBatch) -> dict:
        sets = shingle_sets(batch.column("text"), words)
        return {
            "doc_id": batch.column("doc_id"),
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "cls": pa.array(np.array([_class(s) for s in sets], dtype=np.uint64).view(np.int64)),
            "sketch": pa.array([_sketch(s) for s in sets], pa.list_(pa.int64())),
        }

    return common.per_batch(docs.select("doc_id", "text", *keep), run, "doc_id bigint, n_shingles bigint, cls bigint, sketch array<bigint>", keep)


def part_keys(found: np.ndarray, like: Likeness, cells: list[tuple[int, int]]) -> np.ndarray:
    """Keys of a set: one for each part of its sketch, in each cell that covers its size."""
    out = []
    for number, (low, high) in enumerate(cells):
        if not low <= len(found) <= high:
            continue
        parts, spare = like.parts(low, high)
        part = ((found >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
        bits = np.zeros(parts, dtype=np.uint64)
        np.bitwise_xor.at(bits, part.astype(np.int64), common.mix(found))
        keys = common.chain(common.mix(np.arange(parts, dtype=np.uint64) + np.uint64(number << 32)), bits)
        empty = bits == 0
        # Of two sets that agree in spare + 1 parts, one with at most `spare` empty parts agrees in another one.
        out.append(keys[~empty] if empty.sum() <= spare else keys)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _linked_within(keys: np.ndarray, classes: np.ndarray):
    """keys, classes, hubs of gathered keys in their order: copies once; a key's hub is its smallest class here."""
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    new = np.ones(len(keys), dtype=bool)
    new[1:] = (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])
    keys, classes = keys[new], classes[new]  # copies within the task
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    size = np.diff(np.append(first, len(keys)))
    return keys, classes, np.repeat(classes[first], size), np.repeat(size == 1, size)


def _packed(keys: np.ndarray, classes: np.ndarray, alone: np.ndarray) -> bytes:
    """Sorted keys and their classes as bytes: steps from key to key, places in a table of classes, whether a key was met once."""
    table, places = np.unique(classes, return_inverse=True)
    steps = np.diff(keys, prepend=np.uint64(0))
    steps[0] = 0
    narrow, small = int(steps.max()) < 1 << 32, len(table) <= 1 << 16
    head = np.array([len(keys), len(table), narrow, small, keys[0]], dtype=np.uint64)
    return b"".join(
        [
            head.tobytes(),
            steps.astype(np.uint32 if narrow else np.uint64).tobytes(),
            table.tobytes(),
            places.astype(np.uint16 if small else np.uint32).tobytes(),
            np.packbits(alone).tobytes(),
        ]
    )


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """keys, classes and alone of packed bytes."""
    head = np.frombuffer(data, np.uint64, 5)
    n, of_table, narrow, small = head[:4].tolist()
    at = head.nbytes
    out = []
    for kind, count in ((np.uint32 if narrow else np.uint64, n), (np.int64, of_table), (np.uint16 if small else np.uint32, n), (np.uint8, -(-n // 8))):
        out.append(np.frombuffer(data, kind, count, at))
        at += out[-1].nbytes
    steps, table, places, alone = out
    return head[4] + np.cumsum(steps, dtype=np.uint64), table[places], np.unpackbits(alone, count=n).astype(bool)


def _buckets(keys: np.ndarray, classes: np.ndarray, buckets: int) -> pa.RecordBatch:
    """bucket, packed, followers of gathered keys. Only one class a key goes to the key's bucket; those that follow it are spread over all."""
    keys, classes, hubs, alone = _linked_within(keys >> np.uint64(64 - KEY_BITS), classes)
    lead = alone | (hubs == classes)
    upper = np.uint64(KEY_BITS - 32)
    bucket = ((keys >> upper) * np.uint64(buckets)) >> np.uint64(32)
    rows = []
    own, k, c, one = bucket[lead], keys[lead], classes[lead], alone[lead]
    for a, b in _groups([own]):
        rows.append((int(own[a]), _packed(k[a:b], c[a:b], one[a:b]), None))
    if not lead.all():
        k, c, h = keys[~lead], classes[~lead], hubs[~lead]
        own = common.mix(c.view(np.uint64) ^ k) % np.uint64(buckets)
        order = np.argsort(own, kind="stable")
        own, told = own[order], np.stack([common.signed(k), c, h], axis=1)[order]
        for a, b in _groups([own]):
            rows.append((int(own[a]), None, told[a:b].tobytes()))
    columns = list(zip(*rows))
    kinds = (pa.int64(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["bucket", "packed", "followers"])


def shared_keys(docs: DataFrame, like: Likeness, largest: int, buckets: int) -> DataFrame:
    """key, cls, hub of every class that meets another: hub is the class it is to be compared with."""
    cells = like.cells(largest)

    def emit(batches):
        keys, classes, held = [], [], 0
        for batch in batches:
            for found in shingle_sets(batch.column("text"), like.words):
                own = part_keys(found, like, cells)
                if len(own):
                    keys.append(own)
                    classes.append(np.full(len(own), _class(found), dtype=np.uint64).view(np.int64))
                    held += len(own)
            if held >= GATHERED:
                yield _buckets(np.concatenate(keys), np.concatenate(classes), buckets)
                keys, classes, held = [], [], 0
        if held:
            yield _buckets(np.concatenate(keys), np.concatenate(classes), buckets)

    found = docs.select("text").mapInArrow(common.handing_back(emit), "bucket bigint, packed binary, followers binary")
    dealt = found.repartition("bucket").sortWithinPartitions("bucket")
    names = ["key", "cls", "hub"]

    def meet(batches):
        bucket, waiting = None, []
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("bucket", "packed", "followers")]
            for own, packed, followers in zip(*columns):
                if followers is not None:
                    told = np.frombuffer(followers, np.int64).reshape(-1, 3)
                    yield pa.RecordBatch.from_arrays([pa.array(told[:, i].copy()) for i in range(3)], names)
                    continue
                if own != bucket and waiting:
                    yield from met(waiting)
                    waiting = []
                bucket = own
                waiting.append(packed)
        if waiting:
            yield from met(waiting)

    def met(waiting: list[bytes]):
        keys, classes, alone = (np.concatenate(c) for c in zip(*map(_unpacked, waiting)))
        order = np.lexsort((classes, keys))
        keys, classes = common.signed(keys[order]), classes[order]
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (classes[1:] != classes[:-1])]))
        alone = np.logical_and.reduceat(alone[order], first)  # copies of several tasks go once
        keys, classes = keys[first], classes[first]
        hubs = pa.array(classes, mask=alone)
        _, out = _meet(None, pa.RecordBatch.from_arrays([pa.array(keys), pa.array(classes), hubs], names))
        if out is not None:
            yield out

    return dealt.mapInArrow(common.handing_back(meet), "key bigint, cls bigint, hub bigint")


def _meet(carry, batch):
    """Rows of keys that several rows have, hubs replaced by the key's smallest; `carry` is the open key's (key, hub, waiting)."""
    keys = batch.column("key").to_numpy()
    classes = batch.column("cls").to_numpy()
    alone = batch.column("hub").is_null().to_numpy(zero_copy_only=False)
    hubs = batch.column("hub").fill_null(0).to_numpy()
    follower = ~alone & (hubs != classes)
    kept = [(keys[follower], classes[follower], hubs[follower])]
    keys, classes, alone = keys[~follower], classes[~follower], alone[~follower]
    if len(keys):
        waiting = carry is not None and carry[2]
        if carry is not None:  # the open key's hub once more in front, as a row to be sent if it still waits
            keys, classes = np.append(carry[0], keys), np.append(carry[1], classes)
            alone = np.append(True, alone)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        size = np.diff(np.append(first, len(keys)))
        smallest = np.repeat(classes[first], size)
        send = ~alone | np.repeat(size > 1, size)
        last_waits = bool(alone[-1]) and size[-1] == 1
        if carry is not None:
            if size[0] == 1:
                send[0] = False  # nobody joined it
                if len(first) == 1:
                    last_waits = waiting
            else:
                send[0] = waiting
        carry = (keys[-1], smallest[-1], last_waits)
        kept.append((keys[send], classes[send], smallest[send]))
    columns = [np.concatenate(c) for c in zip(*kept)]
    if not len(columns[0]):
        return carry, None
    return carry, pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["key", "cls", "hub"])


def _halved(a: str, b: str):
    """The sketch a, brought down to the size of b if it is larger (sizes in a cell differ by one step at most)."""
    half = (F.size(a) / 2).cast("int")
    halves = F.zip_with(F.slice(a, 1, half), F.slice(a, half + 1, half), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(a) > F.size(b), halves).otherwise(F.col(a))


def _near_sizes(a: str, b: str, like: Likeness):
    """Whether the sizes of two sets leave it open that they are linked."""
    x, y = F.col(f"{a}_n"), F.col(f"{b}_n")
    return F.least(x, y) * like.of >= F.greatest(x, y) * like.least


def _apart(a: str, b: str):
    """Bits in which two sketches differ."""
    x, y = f"{a}_sketch", f"{b}_sketch"
    differing = F.zip_with(_halved(x, y), _halved(y, x), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    return F.aggregate(differing, F.lit(0).cast("bigint"), lambda sum_, u: sum_ + u)


def _near_apart(a: str, b: str, like: Likeness):
    return F.col("apart") * (like.of + like.least) <= (F.col(f"{a}_n") + F.col(f"{b}_n")) * (like.of - like.least)


def verified(pairs: DataFrame, docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """u, v of those pairs (a, b) whose sets, made anew from the texts, are similar enough."""
    reps = classes.select("cls", "rep")
    wanted = pairs.join(reps.select(F.col("cls").alias("b"), F.col("rep").alias("doc")), "b").select("doc", F.col("b").alias("own"), F.col("a").alias("hub"))
    hubs = pairs.select("a").distinct().join(reps.select(F.col("cls").alias("a"), F.col("rep").alias("doc")), "a").select("doc", F.col("a").alias("own"), F.col("a").alias("hub"))
    asked = common.stored(wanted.unionByName(hubs.withColumn("hub", F.col("own"))), "asked")
    by_doc = asked.groupBy("doc").agg(F.collect_set(F.struct("own", "hub")).alias("asked"))
    n = asked.count()
    by_doc = F.broadcast(by_doc) if n <= SENT_WHOLE else by_doc
    found = docs.select("doc_id", "text").join(by_doc, F.col("doc_id").eqNullSafe(F.col("doc"))).select("text", "asked")

    def run(batch: pa.RecordBatch) -> dict:
        own, hub, sets = [], [], []
        for found, asked in zip(shingle_sets(batch.column("text"), like.words), batch.column("asked").to_pylist()):
            cls = int(np.array([_class(found)]).view(np.int64)[0])
            for ask in asked:
                if ask["own"] == cls:
                    own.append(cls)
                    hub.append(ask["hub"])
                    sets.append(found.view(np.int64))
        return {"own": pa.array(own, pa.int64()), "hub": pa.array(hub, pa.int64()), "members": pa.array(sets, pa.list_(pa.int64()))}

    made = common.per_batch(found, run, "own bigint, hub bigint, members array<bigint>")
    hub_sets = made.where("own = hub").select("hub", F.col("members").alias("hub_members")).dropDuplicates(["hub"])
    both = F.size(F.array_intersect("members", "hub_members"))
    either = F.size("members") + F.size("hub_members") - both
    met = made.where("own <> hub").join(hub_sets, "hub").where(both * like.of >= either * like.least)
    return met.select(F.col("hub").alias("u"), F.col("own").alias("v")).distinct()


def _whole_groups(batches, names: list[str]):
    """Tables of whole groups from batches sorted by `names`: the rows of a group are held until its last one has come."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if held[0].slice(0, 1).select(names).equals(batch.slice(batch.num_rows - 1).select(names)):
            continue
        table = pa.Table.from_batches(held)
        last = [table.column(c)[-1].as_py() for c in names]
        same = np.logical_and.reduce([table.column(c).to_numpy() == x for c, x in zip(names, last)])
        whole = len(same) - int(np.argmin(same[::-1]))
        yield table.slice(0, whole)
        held = table.slice(whole).combine_chunks().to_batches()
    if held:
        yield pa.Table.from_batches(held)


def _groups(columns: list[np.ndarray]):
    """(first, end) of each run of equal values in all columns."""
    edges = np.flatnonzero(np.concatenate([[True], np.logical_or.reduce([c[1:] != c[:-1] for c in columns]), [True]]))
    return zip(edges[:-1].tolist(), edges[1:].tolist())


def _blocked(rows: DataFrame) -> DataFrame:
    """`rows` of groups (key, cls, n, ...) with the number of blocks of their group, their block and `other`: one row for each block of the group."""
    sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"))
    blocks = f"cast(ceil(greatest(members / {COMPARED_TOGETHER}, shingles / {SHINGLES_TOGETHER})) as int)"
    blocked = rows.join(sizes.select("key", F.expr(blocks).alias("blocks")), "key")
    blocked = blocked.withColumn("block", F.expr("cast(pmod(xxhash64(cls), blocks) as int)"))
    return blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))


def _block_pairs(rows: DataFrame, *columns: str) -> DataFrame:
    """key, left, right, block, `columns` of the members of groups (key, cls, n, ...) cut into blocks: one row for each block to be compared with."""
    return _blocked(rows).select("key", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "block", *columns)


def _folded(sketches: list[np.ndarray]) -> np.ndarray:
    """The sketches, all brought down to the smallest one's size."""
    shortest = min(len(x) for x in sketches)
    return np.stack([np.bitwise_xor.reduce(x.reshape(-1, shortest), axis=0) for x in sketches])


def _left_open(i: int, j: np.ndarray, n: np.ndarray, folded: np.ndarray, like: Likeness) -> np.ndarray:
    """Those of the sets j whose sizes and sketches leave a link with set i open."""
    j = j[np.minimum(n[j], n[i]) * like.of >= np.maximum(n[j], n[i]) * like.least]
    apart = np.bitwise_count(folded[j] ^ folded[i]).sum(axis=1, dtype=np.int64)
    return j[apart * (like.of + like.least) <= (n[j] + n[i]) * (like.of - like.least)]


def _by_blocks(cells: DataFrame, lists: str, columns: list[str], compare, schema: str) -> DataFrame:
    """Rows of `compare` for each pair of blocks: given the columns, the lists, and the places of the members of both sides, it returns arrays or None."""
    names = ["key", "left", "right"]
    out_names = [c.split()[0] for c in schema.split(",")]

    def run(batches):
        for table in _whole_groups(batches, names):
            held = {c: table.column(c).to_numpy() for c in (*names, "block", *columns)}
            arrays = table.column(lists).combine_chunks()
            at, words = arrays.offsets.to_numpy(), arrays.flatten().to_numpy().view(np.uint64)
            at = at - at[0]
            for a, b in _groups([held[c] for c in names]):
                of_group = {c: held[c][a:b] for c in (*names, "block", *columns)}
                sides = [np.flatnonzero(of_group["block"] == held[c][a]) for c in ("left", "right")]
                out = compare(of_group, [words[at[k] : at[k + 1]] for k in range(a, b)], *sides)
                if out is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], out_names)

    return cells.repartition(*names).sortWithinPartitions(*names).mapInArrow(common.handing_back(run), schema)


@dataclass
class _Block:
    """Members of a group; `open_` are those with a link to another component left open."""

    cls: np.ndarray
    component: np.ndarray
    n: np.ndarray
    sketches: list[np.ndarray]
    open_: np.ndarray

    def __add__(self, other: "_Block") -> "_Block":
        both = (np.concatenate([getattr(x, c) for x in (self, other)]) for c in ("cls", "component", "n"))
        return _Block(*both, self.sketches + other.sketches, np.concatenate([self.open_, other.open_]))

    def meet(self, others: "_Block", like: Likeness) -> None:
        """Marks own members whose sketches leave a link with one of `others` open."""
        closed = np.flatnonzero(~self.open_)
        if not len(closed):
            return
        first, n = len(self.n), np.concatenate([self.n, others.n])
        folded = _folded(self.sketches + others.sketches)
        for i in closed.tolist():
            apart = first + np.flatnonzero(others.component != self.component[i])
            self.open_[i] = len(_left_open(i, apart, n, folded, like)) > 0


def _open_members(groups: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """key, cls, component, n of the members of groups (key, cls, component) whose sketches leave a link with another component open.

    A task holds a block while all other members of the group pass by, so it hands on each member once a group, however many blocks that has.
    """
    sized = groups.select("key", "cls", "component").join(classes.select("cls", "n"), "cls")
    passing = (F.col("block") != F.col("other")).cast("int").alias("passing")
    cells = _blocked(sized).select("key", F.col("other").alias("block"), passing, "cls", "component", "n").join(classes.select("cls", "sketch"), "cls")
    names = ["key", "cls", "component", "n"]

    def told(key: int, own: _Block) -> pa.RecordBatch:
        columns = [np.full(int(own.open_.sum()), key, np.int64), *(x[own.open_] for x in (own.cls, own.component, own.n))]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    def run(batches):
        cell, own = None, None
        for batch in batches:
            rows = {c: batch.column(c).to_numpy() for c in ("key", "block", "passing", "cls", "component", "n")}
            lists = batch.column("sketch")
            at, words = lists.offsets.to_numpy(), lists.flatten().to_numpy().view(np.uint64)
            at = at - at[0]
            for a, b in _groups([rows[c] for c in ("key", "block", "passing")]):
                if cell != (rows["key"][a], rows["block"][a]):
                    if own is not None:
                        yield told(cell[0], own)
                    cell, own = (rows["key"][a], rows["block"][a]), None
                sketches = [words[at[k] : at[k + 1]] for k in range(a, b)]
                part = _Block(*(rows[c][a:b] for c in ("cls", "component", "n")), sketches, np.zeros(b - a, dtype=bool))
                if own is None:
                    own = part
                elif not rows["passing"][a]:  # a block may come in several batches
                    part.meet(own, like)
                    own = own + part
                own.meet(part, like)
        if own is not None:
            yield told(cell[0], own)

    dealt = cells.repartition("key", "block").sortWithinPartitions("key", "block", "passing")
    return dealt.mapInArrow(common.handing_back(run), "key bigint, cls bigint, component bigint, n bigint")


def sets_of(wanted: DataFrame, docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """cls, members of the classes `wanted` (cls), made anew from one text of each."""
    reps = common.stored(wanted.distinct().join(classes.select("cls", "rep"), "cls"), "reps")
    by_doc = reps.groupBy("rep").agg(F.collect_list("cls").alias("asked"))
    by_doc = F.broadcast(by_doc) if reps.count() <= SENT_WHOLE else by_doc
    texts = docs.select("doc_id", "text").join(by_doc, F.col("doc_id").eqNullSafe(F.col("rep"))).select("text", "asked")

    def make(batch: pa.RecordBatch) -> dict:
        own, sets = [], []
        for found, asked in zip(shingle_sets(batch.column("text"), like.words), batch.column("asked").to_pylist()):
            cls = int(np.array([_class(found)]).view(np.int64)[0])
            if cls in asked:
                own.append(cls)
                sets.append(found.view(np.int64))
        return {"cls": pa.array(own, pa.int64()), "members": pa.array(sets, pa.list_(pa.int64()))}

    # Documents of equal id may hold a set twice.
    return common.per_batch(texts, make, "cls bigint, members array<bigint>").dropDuplicates(["cls"])


def links_across(groups: DataFrame, docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """u, v: links that connect all members of a group (key, cls, component) that links across components connect.

    Members whose sketches leave such a link open are compared exactly, pair of blocks by pair of blocks, each in one task. A task hands on a
    link only if it connects what its own links have not connected, so a pair of blocks has fewer links than members.
    """
    open_ = common.stored(_open_members(groups, classes, like), "open-members")
    sets = sets_of(open_.select("cls"), docs, classes, like)
    cells = _block_pairs(open_, "cls", "component", "n").join(sets, "cls")

    def compare(rows: dict, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray):
        n, cls, tree = rows["n"], rows["cls"], rows["component"].copy()
        folded, linked = _folded([_sketch(x).view(np.uint64) for x in sets]), _linked(sets, like)
        links, among = [], rows["left"][0] == rows["right"][0]
        for i in left.tolist():
            others = right[right > i] if among else right
            near = _left_open(i, others[tree[others] != tree[i]], n, folded, like)
            for j in linked(i, near).tolist():
                if tree[j] != tree[i]:
                    links.append((cls[i], cls[j]))
                    tree[tree == tree[j]] = tree[i]
        return [np.array(c) for c in zip(*links)] if links else None

    return _by_blocks(cells, "members", ["cls", "component", "n"], compare, "u bigint, v bigint")


def _one_of_each(groups: DataFrame) -> DataFrame:
    """`groups` (key, cls, component) without those whose classes are those of another, and without those of one component."""
    marks = [F.bit_xor(F.xxhash64("cls", F.lit(i))).alias(f"mark{i}") for i in range(2)]
    told = groups.groupBy("key").agg(F.count(F.lit(1)).alias("members"), *marks, F.min("component").alias("low"), F.max("component").alias("high"))
    keys = told.where("low <> high").groupBy("members", "mark0", "mark1").agg(F.min("key").alias("key"))
    return groups.join(keys.select("key"), "key")


def _small_pairs(shared: DataFrame) -> DataFrame:
    """a, b: all pairs of the classes of each key, for keys of few."""
    lists = shared.groupBy("key").agg(F.array_sort(F.collect_set("cls")).alias("own"))
    pairs = F.flatten(F.transform("own", lambda a: F.transform(F.filter("own", lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return lists.select(F.explode(pairs).alias("pair")).select("pair.*")


def _members(rows: DataFrame, found: DataFrame, node: str, name: str = "component") -> DataFrame:
    """Adds the component of a column of classes; a class without links is its own."""
    known = found.select(F.col("node").alias(node), F.col("component").alias(name))
    return rows.join(known, node, "left").withColumn(name, F.coalesce(name, node))


def _linked(sets: list[np.ndarray], like: Likeness):
    """A function that gives those of the sets j that are linked with set i, all given as places."""
    n = np.array([len(s) for s in sets])
    members, places = np.unique(np.concatenate(sets), return_inverse=True)
    places = np.split(places.astype(np.int32), np.cumsum(n)[:-1])
    held = np.zeros(len(members), np.uint8)

    def linked(i: int, j: np.ndarray) -> np.ndarray:
        if not len(j):
            return j
        held[places[i]] = 1
        of_all = held[np.concatenate([places[k] for k in j.tolist()])]
        both = np.add.reduceat(of_all, np.cumsum(n[j]) - n[j], dtype=np.int64)
        held[places[i]] = 0
        return j[both * like.of >= (n[j] + n[i] - both) * like.least]

    return linked


def _links_of(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, like: Likeness) -> np.ndarray:
    """Links of each of the sorted sets with those of the other side, both given as places; equal sides: links among them."""
    n = np.array([len(s) for s in sets])
    folded, linked = _folded([_sketch(s).view(np.uint64) for s in sets]), _linked(sets, like)
    links = np.zeros(len(sets), np.int64)
    among = np.array_equal(left, right)
    for at, i in enumerate(left.tolist()):
        j = linked(i, _left_open(i, right[at + 1 :] if among else right, n, folded, like))
        links[i] += len(j)
        links[j] += 1
    return links


def link_counts(links: DataFrame, found: DataFrame, docs: DataFrame, classes: DataFrame, like: Likeness) -> DataFrame:
    """cls, links of each class of the components `found`: how many other classes it is linked with. `links` (u, v) are those known.

    A component all of whose pairs are known links is settled; in the others all pairs are compared.
    """
    known = links.join(found, F.col("u") == F.col("node")).groupBy("component").agg(F.count(F.lit(1)).alias("known"))
    of_found = found.join(classes.select(F.col("cls").alias("node"), "n"), "node")
    sizes = of_found.groupBy("component").agg(F.count(F.lit(1)).alias("members"))
    sizes = sizes.join(known, "component").where("2 * known < members * (members - 1)")
    asked = of_found.join(sizes.select("component"), "component").select(F.col("component").alias("key"), F.col("node").alias("cls"), "n")
    asked = common.stored(asked, "asked")
    settled = links.select(F.explode(F.array("u", "v")).alias("cls")).join(asked.select("cls"), "cls", "left_anti")
    settled = settled.groupBy("cls").agg(F.count(F.lit(1)).alias("links"))
    cells = _block_pairs(asked, "cls").join(sets_of(asked.select("cls"), docs, classes, like), "cls")

    def compare(rows: dict, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray):
        counted = _links_of(sets, left, right, like)
        return [rows["cls"][counted > 0], counted[counted > 0]] if counted.any() else None

    counted = _by_blocks(cells, "members", ["cls"], compare, "cls bigint, links bigint").groupBy("cls").agg(F.sum("links").alias("links"))
    return common.stored(settled.unionByName(counted), "link-counts")


def near_duplicates(docs: DataFrame, like: Likeness = Likeness(), count_links: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, n_shingles, component_id, links of each document of `docs` (doc_id, text); without `count_links` no links.

    Columns of `docs` named by `keep` stay, with `component` behind them: one number for the rows of a component (null: no words), as several
    components may have the same smallest doc_id if ids repeat.

    Two documents are linked if their shingle sets are similar enough; component_id is the smallest doc_id reachable by links, itself
    included. `links` is the number of other sets that the document's set is linked with; sets of copies count once, its own not. Documents without words (null, empty)
    are linked with nothing and have their own id. Rows of equal doc_id are documents of their own; other columns are ignored; an empty
    table gives an empty table.
    """
    summary = common.stored(summaries(docs, like.words, keep), "summaries")
    some = summary.where("n_shingles > 0")
    classes = some.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n"), F.max("sketch").alias("sketch"))
    classes = common.stored(classes, "classes")
    largest, shingles = (x or 0 for x in classes.agg(F.max("n"), F.sum("n")).first())
    # A set has fewer keys than shingles, being in two cells at most for most sizes, and about half as many.
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), shingles // KEYS_IN_BUCKET)

    shared = common.stored(shared_keys(docs, like, largest, buckets), "shared")
    sizes = shared.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
    sized = shared.join(sizes, "key")
    few = F.col("members") <= FEW_MEMBERS
    to_hub = sized.where(~few & (F.col("cls") != F.col("hub"))).select(F.least("hub", "cls").alias("a"), F.greatest("hub", "cls").alias("b"))
    pairs = _small_pairs(sized.where(few)).unionByName(to_hub).distinct()
    for side in ("b", "a"):
        pairs = pairs.join(classes.select(F.col("cls").alias(side), F.col("n").alias(f"{side}_n"), F.col("sketch").alias(f"{side}_sketch")), side)
    near = pairs.where(_near_sizes("a", "b", like)).withColumn("apart", _apart("a", "b")).where(_near_apart("a", "b", like))
    near = common.stored(near.select("a", "b", "apart"), "near-pairs")

    # All pairs at once if they are few; else one to compare with for each class, the others if they are still apart then.
    tried = near.select("a", "b")
    if near.count() > SENT_WHOLE:
        tried = common.stored(near.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    links = common.stored(verified(tried, docs, classes, like), "links")
    found = common.stored(components(links), "components")

    left = near.join(tried.withColumn("tried", F.lit(True)), ["a", "b"], "left").where("tried IS NULL")
    left = _members(_members(left.select("a", "b"), found, "a", "a_in"), found, "b", "b_in").where("a_in <> b_in")
    left = common.stored(left.select("a", "b"), "left-pairs")
    if not left.isEmpty():
        links = common.stored(links.unionByName(verified(left, docs, classes, like)), "links")
        found = common.stored(components(links), "components")

    large = sized.where(~few).select("key", "cls").distinct()
    groups = common.stored(_one_of_each(_members(large, found, "cls")), "mixed-groups")
    if not groups.isEmpty():
        links = common.stored(links.unionByName(links_across(groups, docs, classes, like)), "links")
        found = common.stored(components(links), "components")

    joined = classes.select("cls", "rep").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    joined = joined.select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    smallest = joined.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class, told = joined.join(smallest, "component"), ["component_id", *(["component"] if keep else [])]
    if count_links:
        degree = link_counts(links, found, docs, classes, like)
        of_class, told = of_class.join(degree, "cls", "left").withColumn("links", F.coalesce("links", F.lit(0).cast("long"))), [*told, "links"]
    of_class = common.stored(of_class.select("cls", *told), "of-class")
    linked = some.select("doc_id", *keep, "n_shingles", "cls").join(of_class, "cls").select("doc_id", *keep, "n_shingles", *told)
    none = {"component_id": F.col("doc_id"), "component": F.lit(None).cast("long"), "links": F.lit(0).cast("long")}
    return linked.unionByName(summary.where("n_shingles = 0").select("doc_id", *keep, "n_shingles", *[none[c].alias(c) for c in told]))
