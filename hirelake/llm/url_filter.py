"""URL verdicts by a list of canonical URLs: a blocked Bloom filter first, an exact hash join for what it lets through.

A listed URL is a host and a path, like `example.net/en/`; it holds for the host, its subdomains, and all paths
that start with its own. So a page's URL has a few candidate keys: every ending of its host (as long as listed hosts
get) with every beginning of its path (of a length that is listed). The filter keeps, for each page, the keys
that may be listed; almost all pages are through after that, without a join. The rest meet the list by equality.
"""

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.llm import common

#: Words of 64 bits in the filter at most: 8 MB. A longer list only lets more through to the join.
MOST_BLOCKS = 1 << 20
BITS_PER_URL = 16
#: A list of at most so many URLs goes to every executor; a longer one is shuffled, keys spread over SALTS parts.
SENT_WHOLE = 50_000
SALTS = 16

_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What stands between the first `://` and the next `/`, `?`, `#` or the end, A-Z in lower case; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """What follows the host up to `?`, `#` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _mask(key: Column) -> Column:
    """Four bits of a key's block."""
    h = F.xxhash64(key, F.lit(1))
    return _pair(h, 0).bitwiseOR(_pair(h, 12))


def _pair(h: Column, at: int) -> Column:
    one = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, at + s).bitwiseAND(F.lit(63)).cast("int")) for s in (0, 6)]
    return one[0].bitwiseOR(one[1])


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """One row, one column: the filter of `key` as an array of 64-bit blocks."""
    words = keys.select(_block(F.col("key"), blocks).alias("block"), _mask(F.col("key")).alias("mask"))
    filled = words.groupBy("block").agg(F.bit_or("mask").alias("bits"))
    all_blocks = keys.sparkSession.range(blocks).select(F.col("id").cast("int").alias("block"))
    dense = all_blocks.join(filled, "block", "left").select("block", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    ordered = F.array_sort(F.collect_list(F.struct("block", "bits")))
    return dense.agg(F.transform(ordered, lambda b: b["bits"]).alias("filter"))


def _candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    names = F.split(host, r"\.")
    size = F.size(names)
    endings = F.transform(
        F.sequence(F.greatest(F.lit(1), size - labels + 1), size),
        lambda i: F.array_join(F.slice(names, i, size), "."),
    )
    wanted = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    beginnings = F.transform(wanted, lambda n: F.substring(path, F.lit(1), n))
    return F.flatten(F.transform(endings, lambda e: F.transform(beginnings, lambda b: F.concat(e, b))))


def judge(pages: DataFrame, listed: DataFrame, otherwise: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict for each row of `pages` (page_id, url).

    `listed` has rule (`host/path...`) and verdict. The longest rule that fits decides; a rule listed with two verdicts
    blocks. Where none fits, rule is null and the verdict `otherwise`. Null URLs and ones without `://` have an empty host and
    path, which no rule fits. Repeated rows give a row each. Other columns of `pages` are ignored; an empty
    list or table is fine.
    """
    spark = pages.sparkSession
    rules = listed.where("rule <> ''").groupBy(F.col("rule").alias("key")).agg(F.max("verdict").alias("listed_verdict"))
    host_labels = F.size(F.split(F.substring_index("key", "/", 1), r"\."))
    path_length = F.length("key") - F.length(F.substring_index("key", "/", 1))
    shape = rules.agg(F.count(F.lit(1)).alias("n"), F.max(host_labels).alias("labels"), F.collect_set(path_length).alias("lengths")).first()
    blocks = 1
    while blocks < MOST_BLOCKS and blocks * 64 < shape["n"] * BITS_PER_URL:
        blocks *= 2

    rows = pages.groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.select("page_id", "url", "copies", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    bits = bloom_filter(rules.select("key"), blocks).scalar()
    rows = rows.withColumn("bits", bits)
    keys = _candidates(F.col("host"), F.col("path"), shape["labels"] or 1, sorted(shape["lengths"]))
    keys = keys if shape["lengths"] else F.array().cast("array<string>")
    maybe = F.filter(keys, lambda k: F.element_at("bits", _block(k, blocks) + 1).bitwiseAND(_mask(k)) == _mask(k))
    rows = rows.withColumn("key", F.explode_outer(maybe)).drop("bits")

    if shape["n"] <= SENT_WHOLE:
        met = rows.join(F.broadcast(rules), "key", "left")
    else:
        salt = F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int")
        salted = rules.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        some = rows.where("key IS NOT NULL").withColumn("salt", salt)
        met = some.join(salted, ["key", "salt"], "left").drop("salt").unionByName(
            rows.where("key IS NULL").withColumn("listed_verdict", F.lit(None).cast("string"))
        )
    fits = F.when(F.col("listed_verdict").isNotNull(), F.struct(F.length("key").alias("n"), "key", "listed_verdict"))
    best = met.groupBy("page_id", "url", "host", "path", "copies").agg(F.max(fits).alias("best"))
    return best.select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.coalesce(F.col("best.listed_verdict"), F.lit(otherwise)).alias("verdict"),
        F.explode(F.expr("sequence(1L, copies)")).alias("copy"),
    ).drop("copy")
