"""Phrases of neighbouring words by Toivonen's method, and how strongly their words belong together.

A sample of the documents proposes words and phrases. The full pass counts the proposed ones and their negative border exactly: every
word, and every phrase whose two phrases of one word less are proposed. Phrases of the border that turn out frequent are failures of the
sample: they allow longer phrases that were not counted, so a further pass counts those, until no pass finds new ones. Since a
phrase is never more frequent than its parts, the frequent phrases are then all counted, whatever the sample was.

Sets of phrases reach the tasks as Bloom filters of at most MOST_BITS bits. A false hit only counts a phrase too many; a filter that is too small for its
phrases lets more of them be counted, up to all, and never loses one.

A word is a 64-bit hash of language and word, a phrase the hashes of its words. Every word is counted by its text too, so two words of one hash are seen, and
counting starts again with another hash. Counts are added up within tasks before they are sent, and travel packed: one row a task and bucket of hashes. There
are as many buckets as let one fit into a task, which adds it up and hands on what is frequent.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.llm import common

#: One document in so many is in the sample, and a word or phrase that occurs so often there is proposed.
SAMPLED, PROPOSED = 4, 2
#: Phrases a task gathers before it adds them up and hands them on.
GATHERED = 1_500_000
#: Bytes of all texts for each bucket of counts.
BYTES_A_BUCKET = 8 << 20
#: Bits of a filter for each phrase, and of any filter at most.
BITS_EACH, MOST_BITS = 16, 1 << 27
BREAKS = b".,;:!?\n\x0b\x0c\r"

_PLAIN = bytes(range(256)).translate(bytes.maketrans(BREAKS + b"\t", b"\n" * len(BREAKS) + b" "))


class Pieces(common.Words):
    """Lower-cased words of texts cut into pieces; `next_in(k)` says where a word and the k after it stand in one piece."""

    def __init__(self, column: pa.Array):
        column = column.cast(pa.large_string())
        column = column.fill_null("") if column.null_count else column
        raw = column.buffers()[2]
        if raw is not None:
            plain = pa.py_buffer(raw.to_pybytes().translate(_PLAIN))
            column = pa.Array.from_buffers(pa.large_string(), len(column), [None, column.buffers()[1], plain], offset=column.offset)
        super().__init__(column, lower=True)
        self.piece = np.searchsorted(np.flatnonzero(self.data == 10), self.starts) + self.rows()

    def follows(self) -> np.ndarray:
        """Whether each word but the last has its next one in the same piece."""
        return self.piece[1:] == self.piece[:-1]

    def salted(self, tags: np.ndarray, salt: int) -> np.ndarray:
        """Hashes of the words with their tags, others for each salt (0 to 255), never zero."""
        plain, self.data = self.data, self.data ^ np.uint8(salt)
        h = common.chain(tags, self.hashes())
        self.data = plain
        return np.maximum(h, np.uint64(1))

    def texts(self, at: np.ndarray) -> pa.Array:
        """The words at these places."""
        size = self.ends[at] - self.starts[at]
        offsets = np.concatenate([[0], np.cumsum(size)])
        places = np.arange(offsets[-1]) + np.repeat(self.starts[at] - offsets[:-1], size)
        return pa.Array.from_buffers(pa.large_string(), len(at), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(self.data[places])])


def _tag(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


# ------------------------------------------------------------------- filters


def _filter_words(phrases: int) -> int:
    return 1 << max(6, int(min(MOST_BITS, max(1, phrases) * BITS_EACH) // 64 - 1).bit_length())


def _marks(keys: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit word of the filter that a key belongs to, and its four bits there."""
    places = common.mix(keys ^ np.uint64(0xF117E5))
    bits = np.zeros(len(keys), np.uint64)
    for k in range(4):
        bits |= np.uint64(1) << ((places >> np.uint64(40 + 6 * k)) & np.uint64(63))
    return (places & np.uint64(words - 1)).astype(np.int64), bits


def _passes(keys: np.ndarray, bloom: np.ndarray) -> np.ndarray:
    at, bits = _marks(keys, len(bloom))
    return (bloom[at] & bits) == bits


def phrase_keys(columns: list[np.ndarray]) -> np.ndarray:
    """One hash of each phrase, given the hashes of its words."""
    out = columns[0]
    for c in columns[1:]:
        out = common.chain(out, c)
    return out


def _bloom(phrases: DataFrame, k: int) -> np.ndarray:
    """The filter of phrases (h1, ..., hk); bits are put together within tasks and by word of the filter, so only the filter itself is fetched."""
    words = _filter_words(phrases.count())
    names = [f"h{i + 1}" for i in range(k)]

    def run(batches):
        bloom = np.zeros(words, np.uint64)
        for batch in batches:
            at, bits = _marks(phrase_keys([batch.column(c).to_numpy().view(np.uint64) for c in names]), words)
            np.bitwise_or.at(bloom, at, bits)
        at = np.flatnonzero(bloom)
        for a in range(0, len(at), 100_000):
            some = at[a : a + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(common.signed(bloom[some]))], ["place", "bits"])

    found = phrases.select(*names).mapInArrow(common.handing_back(run), "place bigint, bits bigint").groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(words, np.uint64)
    out[found.column("place").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return out


# ------------------------------------------------------------------ counting


def _added_up(columns: list[np.ndarray], many: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Different phrases with the sum of their counts, and the place of one of each."""
    keys = phrase_keys(columns)
    order = np.argsort(keys)
    new = np.ones(len(order), bool)
    new[1:] = keys[order][1:] != keys[order][:-1]
    differ = np.zeros(len(order), bool)
    for c in columns:
        differ[1:] |= c[order][1:] != c[order][:-1]
    if (differ & ~new).any():  # two phrases of one hash
        order = np.lexsort(columns[::-1])
        new = np.ones(len(order), bool)
        new[1:] = np.logical_or.reduce([c[order][1:] != c[order][:-1] for c in columns])
    first = np.flatnonzero(new)
    sums = np.add.reduceat(many[order], first) if len(first) else many[:0]
    return [c[order][first] for c in columns], sums, order[first]


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


class _Gathered:
    """Counts of one task on their way out: words with their texts, phrases by their hashes."""

    def __init__(self, longest: int, buckets: int):
        self.longest, self.buckets = longest, buckets
        self.names = [f"h{i + 1}" for i in range(longest)]
        self.empty()

    def empty(self):
        self.parts, self.held = {k: [] for k in range(1, self.longest + 1)}, 0

    def add(self, columns: list[np.ndarray], *texts) -> None:
        if len(columns[0]):
            many = texts[0] if texts else np.ones(len(columns[0]), np.int64)
            self.parts[len(columns)].append((columns, many, *texts[1:]))
            self.held += len(columns[0])

    def table(self, k: int, columns: list[np.ndarray], lang, word, many: np.ndarray) -> pa.Table:
        hashes = [pa.array(common.signed(c)) for c in columns] + [pa.array(np.zeros(len(many), np.int64))] * (self.longest - k)
        texts = [pa.nulls(len(many), pa.string()) if t is None else t.cast(pa.string()) for t in (lang, word)]
        return pa.table([pa.array(np.full(len(many), k, np.int32)), *hashes, *texts, pa.array(many)], ["k", *self.names, "lang", "word", "many"])

    def batches(self):
        """Rows (bucket, counts): those of one length whose hashes are in a bucket."""
        for k, parts in self.parts.items():
            if not parts:
                continue
            columns, many, at = _added_up([np.concatenate(c) for c in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))
            lang, word = (pa.concat_arrays([p[i] for p in parts]).take(pa.array(at)) for i in (2, 3)) if k == 1 else (None, None)
            yield from self.dealt(self.table(k, columns, lang, word, many), phrase_keys(columns))
        self.empty()

    def dealt(self, table: pa.Table, keys: np.ndarray):
        bucket = ((keys >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(np.int64)
        if (bucket[1:] < bucket[:-1]).any():
            order = np.argsort(bucket, kind="stable")
            table, bucket = table.take(pa.array(order)), bucket[order]
        edges = np.append(np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])), len(bucket)) if len(bucket) else np.zeros(1, int)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            yield pa.RecordBatch.from_arrays([pa.array(bucket[a : a + 1]), pa.array([_packed(table.slice(a, b - a))], pa.binary())], ["bucket", "counts"])


def _merged(tables: list[pa.Table], names: list[str]) -> pa.Table:
    """The counts of one bucket added up."""
    table = pa.concat_tables(tables)
    few = table.filter(pc.less_equal(table["k"], 1))
    words = few.group_by(["k", *names, "lang", "word"]).aggregate([("many", "sum")]).rename_columns(table.schema.names)
    rest = table.filter(pc.greater(table["k"], 1))
    columns, many, at = _added_up([rest[n].to_numpy().view(np.uint64) for n in names], rest["many"].to_numpy())
    texts = pa.nulls(len(many), pa.string())
    phrases = pa.table([rest["k"].take(pa.array(at)), *[pa.array(common.signed(c)) for c in columns], texts, texts, pa.array(many)], table.schema.names)
    return pa.concat_tables([words.select(table.schema.names), phrases])


def _counts(docs: DataFrame, salt: int, longest: int, filters, least: int, buckets: int) -> DataFrame:
    """k, h1..., lang, word, many: of each word (k = 1) and phrase counted in a pass, and of each language (k = 0) its words.

    `filters` are those of all passes so far, as broadcast lists of {length: filter}; the last one's phrases are counted unless an earlier pass did. None stands
    for the sample: all phrases but the longest. Rows of fewer than `least` are left out, but for words.
    """
    names = [f"h{i + 1}" for i in range(longest)]
    sample, first = filters is None, filters is None or len(filters.value) == 1

    def run(batches):
        out, words_of = _Gathered(longest, buckets), {}
        for batch in batches:
            if not batch.num_rows:
                continue
            w = Pieces(batch.column("text"))
            lang = batch.column("lang")
            langs = lang.to_pylist()
            tag = {x: _tag(x) for x in set(langs)}
            rows = w.rows()
            h = w.salted(np.array([tag[x] for x in langs], np.uint64)[rows], salt)
            if first:
                (different,), many, at = _added_up([h], np.ones(len(h), np.int64))
                out.add([different], many, lang.take(pa.array(rows[at])).cast(pa.large_string()), w.texts(at))
                for text, n in zip(langs, w.counts().tolist()):
                    words_of[text] = words_of.get(text, 0) + n
            follows = w.follows()
            stands = np.ones(len(h), bool)  # where a phrase of k words begins
            passed = [] if sample else [_passes(h, f[1]) for f in filters.value]
            for k in range(2, longest + (not sample)):
                n = max(0, len(h) - k + 1)
                stands = stands[: n + 1][:n] & follows[k - 2 : k - 2 + n]
                columns = [h[i : i + n] for i in range(k)]
                if sample:
                    at = np.flatnonzero(stands)
                else:
                    counted = [p[:-1] & p[1:] for p in passed] if n else [np.zeros(0, bool)] * len(passed)
                    wanted = counted[-1] & stands
                    for c in counted[:-1]:
                        wanted &= ~c
                    at = np.flatnonzero(wanted)
                    if k < longest:
                        keys = phrase_keys(columns)
                        passed = [_passes(keys, f[k]) & stands for f in filters.value]
                out.add([c[at] for c in columns])
            if out.held >= GATHERED:
                yield from out.batches()
        yield from out.batches()
        words_of = {x: n for x, n in words_of.items() if n}
        if words_of:
            langs, zeros = pa.array(list(words_of), pa.string()), np.zeros(len(words_of), np.uint64)
            yield from out.dealt(out.table(0, [], langs, None, np.array(list(words_of.values()), np.int64)), zeros)

    def add_up(batches):
        current, tables = None, []
        for batch in batches:
            for bucket, counts in zip(batch.column("bucket").to_pylist(), batch.column("counts")):
                if bucket != current and tables:
                    yield from handed_on(tables)
                    tables = []
                current = bucket
                tables.append(pa.ipc.open_stream(counts.as_buffer()).read_all())
        if tables:
            yield from handed_on(tables)

    def handed_on(tables: list[pa.Table]):
        made = _merged(tables, names)
        kept = pc.or_(pc.less_equal(made["k"], 0 if sample else 1), pc.greater_equal(made["many"], least))
        yield from made.filter(kept).combine_chunks().to_batches(max_chunksize=50_000)

    schema = f"k int, {', '.join(f'{n} bigint' for n in names)}, lang string, word string, many bigint"
    packed = docs.select(F.col("text"), F.col("lang")).mapInArrow(common.handing_back(run), "bucket bigint, counts binary")
    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(common.handing_back(add_up), schema)


def _new(known: DataFrame, k: int, bloom) -> bool:
    """Whether there are phrases of k words that a filter did not let through."""
    names = [f"h{i + 1}" for i in range(k)]

    def run(batches):
        for batch in batches:
            keys = phrase_keys([batch.column(c).to_numpy().view(np.uint64) for c in names])
            new = ~_passes(keys, bloom.value[-1][k])
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(np.array([int(new.sum())]))], ["n"])

    return not known.where(F.col("k") == k).select(*names).mapInArrow(common.handing_back(run), "n bigint").isEmpty()


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))


def frequent(docs: DataFrame, longest: int = 3, least: int = 10) -> DataFrame:
    """k, h1..., lang, word, many: counts of all words (k = 1), all phrases of 2 to `longest` words that occur `least` times or more, and the words of
    each language (k = 0), per language of `docs` (text, lang). lang and word are null for phrases; h1... are the hashes of their words.
    """
    docs, context = _plain(docs), docs.sparkSession.sparkContext
    buckets = 1 + (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BYTES_A_BUCKET
    for salt in range(8):
        drawn = docs.where(F.pmod(F.xxhash64("text", "lang", F.lit("sample")), F.lit(SAMPLED)) == 0)
        proposed = common.stored(_counts(drawn, salt, longest, None, PROPOSED, buckets), "proposed")
        filters = [{k: _bloom(proposed.where(F.col("k") == k), k) for k in range(1, longest)}]
        known, clash = None, False
        while True:
            sent = context.broadcast(filters)
            made = common.stored(_counts(docs, salt, longest, sent, least, buckets), "counted")
            if known is None:
                clash = not made.where("k = 1").groupBy("h1").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
                if clash:
                    break
            known = made if known is None else common.stored(known.unionByName(made), "known")
            often = known.where(F.col("many") >= least)
            if not any(_new(often, k, sent) for k in range(1, longest)):
                return known
            filters = [*filters, {k: _bloom(often.where(F.col("k") == k), k) for k in range(1, longest)}]
        if not clash:
            break
    raise ValueError("words of equal hash with every salt")


# ------------------------------------------------------------------- scoring


def collocations(docs: DataFrame, longest: int = 3, least: int = 10, covered: tuple[int, int] = (50, 100), first: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of the phrases of each language, best score first, then the more frequent, then in byte order.

    a is how often a phrase of 2 to `longest` words occurs, at least `least` times; l and r how often the two parts do at the cut of the lowest
    score = floor(1000000 * a * a / (l * r)), of equal ones the first cut; n the words of the language. A phrase within a longer one that occurs at least
    `covered` (part, of) of its times is left out, whether the longer one is or not. With `first`, so many of each language. Counts up to 10^15 are exact.

    Letters A-Z are lower-cased. Phrases do not reach over a line or one of `.,;:!?`. A null text is empty, a null lang is `und`; repeated rows
    count each; other columns are ignored; an empty table gives an empty table.
    """
    names = [f"h{i + 1}" for i in range(longest)]
    known = frequent(docs, longest, least)
    often = known.where((F.col("k") >= 1) & (F.col("many") >= least))
    phrases = often.where("k > 1").drop("lang", "word")

    # a phrase's two phrases of one word less, and so on: each looks at those one word longer, which have seen longer ones
    share, of = covered
    beaten = None
    for k in range(longest, 2, -1):
        longer = phrases.where(F.col("k") == k)
        if beaten is not None and k < longest:
            longer = longer.select("k", *names, "many").unionByName(beaten.where(F.col("k") == k).select("k", *names, "many"))
        zero = [F.lit(0).cast("long")] * (longest - k + 1)
        parts = [[*names[i : i + k - 1], *zero] for i in (0, 1)]
        made = None
        for p in parts:
            some = longer.select(F.lit(k - 1).alias("k"), *[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in zip(names, p)], "many")
            made = some if made is None else made.unionByName(some)
        made = made.groupBy("k", *names).agg(F.max("many").alias("many"))
        beaten = made if beaten is None else beaten.unionByName(made)
    if beaten is not None:
        beaten = beaten.withColumnRenamed("many", "longer")
        phrases = phrases.join(beaten, ["k", *names], "left").where(F.col("longer").isNull() | (F.col("longer") * of < F.col("many") * share)).drop("longer")

    def part(a, b):  # hashes of the words a .. b - 1, the rest zero
        return F.struct(*[(F.col(names[a + i]) if a + i < b else F.lit(0).cast("long")).alias(n) for i, n in enumerate(names)])

    cuts = F.array(*[
        F.struct(F.lit(j).alias("cut"), part(0, j).alias("left"), F.coalesce(*[F.when(F.col("k") == k, part(j, k)) for k in range(j + 1, longest + 1)]).alias("right"))
        for j in range(1, longest)
    ])
    open_ = phrases.select("k", *names, F.col("many").alias("a"), F.explode(F.filter(cuts, lambda c: c["cut"] < F.col("k"))).alias("c"))
    sides = often.select(F.struct(*names).alias("key"), F.col("many"))
    for side in ("left", "right"):
        named = sides.select(F.col("key").alias(side), F.col("many").alias(side[0]))
        open_ = (open_.withColumn(side, F.col(f"c.{side}"))).join(named, side).drop(side)
    wide = lambda c: f"cast({c} as decimal(15,0))"
    score = F.expr(f"(cast(1000000 as decimal(7,0)) * ({wide('a')} * {wide('a')})) div ({wide('l')} * {wide('r')})")
    scored = open_.withColumn("score", score).withColumn("cut", F.col("c.cut"))
    scored = scored.groupBy("k", *names, "a").agg(F.min(F.struct("score", "cut", "l", "r")).alias("best"))
    scored = scored.select("k", *names, "a", "best.l", "best.r", "best.score")

    words = often.where("k = 1").select("h1", "lang", "word")
    for i, n in enumerate(names):
        told = words.select(F.col("h1").alias(n), *([F.col("lang")] if i == 0 else []), F.col("word").alias(f"word{i}"))
        scored = scored.join(told, n, "inner" if i < 2 else "left")
    totals = known.where("k = 0").select("lang", F.col("many").alias("n"))
    scored = scored.select("lang", F.concat_ws(" ", *[f"word{i}" for i in range(longest)]).alias("phrase"), "a", "l", "r", "score")
    scored = common.stored(scored, "scored")
    best = ["score", "a"]
    order = [*[F.desc(c) for c in best], F.asc("phrase")]
    if first is not None:  # most rows fall in shares of a language, so that one language is not one task's work
        shared = Window.partitionBy("lang", "share").orderBy(*order)
        scored = scored.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("rank", F.row_number().over(shared)).where(F.col("rank") <= first)
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    if first is not None:
        ranked = ranked.where(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
