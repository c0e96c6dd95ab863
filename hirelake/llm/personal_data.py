"""Personal data: four kinds by pattern and checksum, further identifiers by contexts learnt from those (bootstrapping).

The base kinds are seeds. A slot is a run of words that hold a digit or `@`; its contexts are the two words before it, and the word on each side of it.
Contexts and the identifiers that stand in them form a graph. In each round a context is scored by how many of all its occurrences in the corpus hold a
trusted identifier of a kind, if enough different ones do; an identifier is scored by the trusted contexts it stands in (noisy or); those that score
high are trusted from then on, and lend support to further contexts. Identifiers found this way are given as further kinds, where they stand in a trusted context.

Everything is DataFrame functions. Patterns are written so that Java's matcher neither tries a run of characters twice nor recurses over it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Different trusted identifiers that a context needs.
SUPPORT = 3
#: Share of a context's occurrences that must hold trusted identifiers, and score from which an identifier is trusted.
CONTEXT_FROM, IDENTIFIER_FROM = 0.8, 0.8
ROUNDS = 4
#: An identifier has so many digits at least, unless it holds an `@`, and so many characters at most.
LEAST_DIGITS, MOST_CHARACTERS = 4, 128
#: Characters before and after a slot that its contexts are read from.
CONTEXT_CHARACTERS = 128
#: One document in so many is looked at first, to see which contexts are far too frequent.
FIRST_COUNTED = 16
#: Contexts that are sent to every executor at most; more are joined by a shuffle.
SENT_WHOLE = 200_000

_WORD, _SPACE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"
_PLAIN = r"[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"
_LOCAL = "[A-Za-z0-9._%+-]"
#: Kind and pattern. A run is entered at its start, or where the match before it ended.
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this character (for ip and card: without a digit) has none of the kind.
_NEEDS = {"email": "@", "phone": "+"}
SLOT = rf"(?<!{_WORD}){_PLAIN}(?:\x20{_PLAIN})*+"
KINDS = (*BASE, *(f"context_{k}" for k in BASE))
_NO_SPANS = "CAST(array() AS array<struct<start: bigint, end: bigint, found: string>>)"
_BLOCK = 64


def _let(value: Column, then) -> Column:
    """`then` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("bigint"), lambda a, x: a + x)


def _ends_after(sizes: Column) -> Column:
    """Sums of the sizes up to each, itself included: within blocks, and of the blocks before."""

    def of(sizes: Column) -> Column:
        blocks = F.when(F.size(sizes) > 0, F.sequence(F.lit(0), F.floor((F.size(sizes) - 1) / _BLOCK).cast("int"))).otherwise(F.expr("CAST(array() AS array<int>)"))
        totals = F.transform(blocks, lambda b: _sum(F.slice(sizes, b * _BLOCK + 1, _BLOCK)))
        before = F.aggregate(
            totals, F.array(F.lit(0).cast("bigint")), lambda out, x: F.concat(out, F.array(F.element_at(out, -1) + x))
        )
        return _let(before, lambda before: F.transform(sizes, lambda _, i: F.element_at(before, F.floor(i / _BLOCK).cast("int") + 1) + _sum(F.slice(sizes, F.floor(i / _BLOCK).cast("int") * _BLOCK + 1, i % _BLOCK + 1))))

    return _let(sizes, of)


def located(text: Column, pattern: str) -> Column:
    """The leftmost matches, none overlapping another: array of (start, end, found, before, after), in characters.

    before and after are the text up to the match before and up to the next one.
    """

    def spans(both: Column) -> Column:
        found, between = both["found"], both["between"]
        sizes = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda a, b: F.length(a).cast("bigint") + F.length(b))
        return _let(_ends_after(sizes), lambda ends: F.transform(found, lambda m, i: F.struct(
            (F.get(ends, i) - F.length(m)).alias("start"), F.get(ends, i).alias("end"), m.alias("found"),
            F.get(between, i).alias("before"), F.get(between, i + 1).alias("after"),
        )))

    return _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("between")), spans)


def _luhn(digits: Column) -> Column:
    """Whether the checksum of a string of digits holds."""
    doubled = lambda d: d * 2 - F.when(d > 4, 9).otherwise(0)
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 1, doubled(d.try_cast("int"))).otherwise(d.try_cast("int")).cast("bigint"))
    return _sum(values) % 10 == 0


def _holds(kind: str, found: Column) -> Column:
    if kind == "ip":
        plain = lambda p: F.ltrim(p, F.lit("0"))
        return F.forall(F.split(found, "[.]"), lambda p: (F.length(plain(p)) <= 3) & (F.coalesce(plain(p).try_cast("int"), F.lit(0)) <= 255))
    if kind == "card":
        digits = F.translate(found, " -", "")
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(F.translate(found, "+ ().-", "")).between(9, 15)
    return F.lit(True)


def _base_spans(text: Column, kind: str) -> Column:
    there = F.contains(text, F.lit(_NEEDS[kind])) if kind in _NEEDS else text.rlike("[0-9]")
    spans = F.transform(F.filter(located(text, BASE[kind]), lambda s: _holds(kind, s["found"])), lambda s: F.struct(s["start"], s["end"], s["found"]))
    return F.when(there, spans).otherwise(F.expr(_NO_SPANS))


def _near(text: Column, behind: bool) -> Column:
    """The part of a text next to a slot, without a word that the limit has cut."""
    part, cut = (F.left(text, F.lit(CONTEXT_CHARACTERS)), f"{_WORD}++$") if behind else (F.right(text, F.lit(CONTEXT_CHARACTERS)), f"^{_WORD}++")
    return F.lower(F.when(F.length(text) > CONTEXT_CHARACTERS, F.regexp_replace(part, cut, "")).otherwise(text))


def _trimmed(slot: Column) -> Column:
    """A slot without signs around it: (start, end, found, left2, left1: the words before, right1: the word behind)."""

    def of(lead: Column) -> Column:
        found = F.regexp_replace(F.substr(slot["found"], F.length(lead) + 1), r"(?<=[\p{L}0-9])[^\p{L}0-9]++$", "")
        start = slot["start"] + F.length(lead)
        return _let(F.struct(found.alias("found"), _near(slot["before"], False).alias("before"), _near(slot["after"], True).alias("after")), lambda x: F.struct(
            start.alias("start"), (start + F.length(x["found"])).alias("end"), x["found"].alias("found"),
            F.regexp_extract(x["before"], rf"(?<!{_WORD})({_WORD}++){_SPACE}++{_WORD}++{_SPACE}++$", 1).alias("left2"),
            F.regexp_extract(x["before"], rf"(?<!{_WORD})({_WORD}++){_SPACE}++$", 1).alias("left1"),
            F.regexp_extract(x["after"], rf"^{_SPACE}++({_WORD}++)", 1).alias("right1"),
        ))

    return _let(F.regexp_extract(slot["found"], r"^([^\p{L}0-9@+]*+)", 1), of)


def _identifier(found: Column) -> Column:
    digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    return (F.length(found) <= MOST_CHARACTERS) & ((digits >= LEAST_DIGITS) | found.rlike(r"[\p{L}0-9]@[\p{L}0-9]"))


def _context(tag: str, a: Column, b: Column) -> Column:
    return F.xxhash64(F.lit(tag), a, b)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, key, base (kind to spans), slots of each document; key tells rows of one id and different texts apart."""
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    text = F.col("text")
    slots = F.filter(F.transform(located(text, SLOT), _trimmed), lambda s: _identifier(s["found"]))
    slots = F.when(text.rlike("[0-9@]"), slots)
    base = [_base_spans(text, k).alias(k) for k in BASE]
    return docs.select("doc_id", common.text_key("text").alias("key"), *base, slots.alias("slots"))


def occurrences(scan: DataFrame) -> DataFrame:
    """doc_id, key, start, end, identifier, kind (null: not of a base kind), contexts of each slot."""
    slots = scan.select("doc_id", "key", *BASE, F.explode("slots").alias("slot"))
    kind = F.coalesce(*[F.when(F.exists(k, lambda s: (s["start"] == F.col("slot.start")) & (s["end"] == F.col("slot.end"))), F.lit(k)) for k in BASE])
    left2, left1, right1 = (F.col(f"slot.{c}") for c in ("left2", "left1", "right1"))
    contexts = F.array(
        F.when((left2 != "") & (left1 != ""), F.struct(_context("before", left2, left1).alias("id"), F.concat_ws(" ", left2, left1, F.lit("_")).alias("context"))),
        F.when((left1 != "") & (right1 != ""), F.struct(_context("around", left1, right1).alias("id"), F.concat_ws(" ", left1, F.lit("_"), right1).alias("context"))),
    )
    return slots.select(
        "doc_id", "key", F.col("slot.start").alias("start"), F.col("slot.end").alias("end"), F.lower("slot.found").alias("identifier"),
        kind.alias("kind"), F.filter(contexts, lambda c: c.isNotNull()).alias("contexts"),
    )


def _everywhere(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """id, everywhere: how often the contexts `wanted` (id) occur in all texts, whatever word stands in them."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col("text").cast("string"), F.lit(""))), rf"{_SPACE}+"), lambda w: w != "")
    before = lambda w: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), F.slice(w, 2, F.greatest(F.size(w) - 2, F.lit(0))), lambda a, b: _context("before", a, b))
    around = lambda w: F.zip_with(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), F.slice(w, 3, F.greatest(F.size(w) - 2, F.lit(0))), lambda a, b: _context("around", a, b))
    ids = docs.select(F.explode(_let(words, lambda w: F.concat(before(w), around(w)))).alias("id"))
    few = wanted.count() <= SENT_WHOLE
    return ids.join(F.broadcast(wanted) if few else wanted, "id", "left_semi").groupBy("id").agg(F.count(F.lit(1)).alias("everywhere"))


def bootstrap(docs: DataFrame, seen: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(context id, kind, context, score of the trusted contexts; identifier, kind, score of the trusted identifiers) from `occurrences`."""
    edges = seen.select("identifier", "kind", F.explode("contexts").alias("c")).groupBy("identifier", "kind", F.col("c.id").alias("id"), F.col("c.context").alias("context"))
    edges = common.stored(edges.agg(F.count(F.lit(1)).alias("n")), "context-edges")
    # slots of several words are not among the single words between two others
    spaced = F.when((F.locate(" ", F.col("identifier")) > 0) & F.col("context").contains(" _ "), F.col("n")).otherwise(0)
    open_ = edges.groupBy("id").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("slots"), F.sum(spaced).alias("spaced"))
    open_ = common.stored(open_.where(f"different >= {SUPPORT}").select("id", "slots", "spaced"), "contexts")
    # a context that occurs too often in a part of the documents alone is none in all of them, and need not be counted there
    some = docs.where(F.pmod(F.xxhash64("text"), F.lit(FIRST_COUNTED)) == 0)
    first = open_.join(_everywhere(some, open_.select("id")), "id", "left")
    share = (F.col("spaced") + F.coalesce("everywhere", F.lit(0))) * CONTEXT_FROM <= F.col("slots")
    open_ = common.stored(first.where(share).select("id", "spaced"), "contexts")
    totals = open_.join(_everywhere(docs, open_.select("id")), "id", "left")
    totals = totals.select("id", F.greatest(F.lit(1), F.col("spaced") + F.coalesce("everywhere", F.lit(0))).alias("everywhere"))
    graph = common.stored(edges.join(totals, "id"), "context-graph")

    seeds = graph.where("kind IS NOT NULL").select("identifier", "kind", F.lit(1.0).alias("score")).distinct()
    seeds = trusted = common.stored(seeds, "identifiers")
    known = trusted.count()
    for _ in range(ROUNDS):
        held = graph.drop("kind").join(trusted, "identifier")
        contexts = held.groupBy("id", "kind").agg(
            F.count_distinct("identifier").alias("support"), F.min("context").alias("context"),
            F.least(F.lit(1.0), F.sum(F.col("n") * F.col("score")) / F.max("everywhere")).alias("score"),
        )
        contexts = contexts.where((F.col("support") >= SUPPORT) & (F.col("score") >= CONTEXT_FROM)).select("id", "kind", "context", "score")
        contexts = common.stored(contexts, "trusted-contexts")
        unseen = graph.where("kind IS NULL").select("identifier", "id").join(contexts, "id")
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-9)))))
        scored = unseen.groupBy("identifier", "kind").agg((1 - doubt).alias("score")).where(F.col("score") >= IDENTIFIER_FROM)
        best = scored.groupBy("identifier").agg(F.max(F.struct("score", "kind")).alias("best")).select("identifier", "best.kind", "best.score")
        trusted = common.stored(seeds.unionByName(best.select("identifier", "kind", "score")), "identifiers")
        now = trusted.count()
        if now == known:
            break
        known = now
    return contexts, trusted


def _named(kind: str) -> Column:
    number = F.lit(KINDS.index(kind) + 1)
    return F.transform(kind, lambda s: F.struct(s["start"], number.alias("order"), s["end"], F.lit(kind).alias("kind")))


def find(docs: DataFrame) -> DataFrame:
    """doc_id, spans of each document of `docs` (doc_id, text): array of (start, end, kind) by start, then kind as in KINDS, then end.

    Positions are characters, the end is the first one behind. The base kinds are leftmost matches of their patterns, none overlapping one of its own
    kind; matches that fail the kind's check (ip: parts up to 255; card: 12 to 19 digits and their checksum; phone: 9 to 15 digits) are left out. `context_...` are
    slots that hold no base kind as a whole, trusted by their contexts. Null texts count as empty; rows of equal doc_id are documents of their own;
    other columns are ignored; an empty table gives an empty table.
    """
    scan = common.stored(scanned(docs), "personal-scan")
    seen = common.stored(occurrences(scan), "slots")
    contexts, trusted = bootstrap(docs, seen)
    place = seen.where("kind IS NULL").drop("kind").withColumn("c", F.explode("contexts")).withColumn("id", F.col("c.id"))
    found = place.join(contexts.select("id", "kind"), "id").join(trusted.select("identifier", "kind"), ["identifier", "kind"])
    order = lambda k: F.array_position(F.array(*[F.lit(x) for x in KINDS]), k).cast("int")
    named = found.select("doc_id", "key", F.struct("start", order(F.concat(F.lit("context_"), F.col("kind"))).alias("order"), "end", F.concat(F.lit("context_"), F.col("kind")).alias("kind")).alias("span"))
    further = named.groupBy("doc_id", "key").agg(F.collect_set("span").alias("further")).withColumnRenamed("doc_id", "own_id").withColumnRenamed("key", "own_key")
    base = F.concat(*[_named(k) for k in BASE])
    rows = scan.select("doc_id", "key", base.alias("base"))
    rows = rows.join(further, F.col("doc_id").eqNullSafe(F.col("own_id")) & (F.col("key") == F.col("own_key")), "left")
    spans = F.array_sort(F.concat("base", F.coalesce("further", F.expr("filter(base, x -> false)"))))
    return rows.select("doc_id", F.transform(spans, lambda s: F.struct(s["start"], s["end"], s["kind"])).alias("spans"))
