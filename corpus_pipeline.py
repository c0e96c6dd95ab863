"""Documents to packed training sequences: five stages, each written as Parquet and read again by the next.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept. All but the last
return the columns of `documents`, whatever the names of those besides doc_id, text and n_chars.
"""

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import common, jaccard_join, packing, secrets, substring_dedup, toxicity

WORDS_REPEATED = 35
TOXIC_FROM = 0.5
SEQUENCE = 4096
#: Ids of removed documents that are sent to every executor at most; more are joined by a shuffle.
SENT_WHOLE = 500_000
#: Stages hold trained parameters, tokenizers and components, which SQL does not express.
ORACLE_SQL = None


def apart(stage):
    """A stage for which all columns but doc_id, text and n_chars have names of their own, so that none clashes with what the operators make."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        hidden = {c: c if c in ("doc_id", "text", "n_chars") else f"_given{i}" for i, c in enumerate(docs.columns)}
        out = stage(spark, docs.select(*[docs[f"`{c}`"].alias(h) for c, h in hidden.items()]), sf_dir)
        return out.select(*[F.col(h).alias(c) for c, h in hidden.items()])

    return run


@apart
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network trained on the labelled ones does not find toxic; empty ones stay."""
    net = toxicity.fit(docs, common.table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, net, tuple(docs.columns))
    empty = F.trim(F.coalesce("text", F.lit(""))) == ""
    return scored.where((F.col("score") < TOXIC_FROM) | empty).select(*docs.columns)


@apart
def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by four fifths of their five-word shingles, the one of the smallest id.

    Rows of equal id are documents of their own: of those with the same text one stays (the smallest of the other columns), those of different
    texts go only if they are linked with one that stays. Documents without id, and without words, stay.
    """
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    repeated = common.stored(repeated, "repeated-ids")
    several = not repeated.isEmpty()
    if several:
        others = [c for c in docs.columns if c not in ("doc_id", "text")]
        least = docs.join(repeated, "doc_id", "left_semi").groupBy("doc_id", "text").agg(F.min(F.struct(F.lit(0).alias("_"), *others)).alias("row"))
        least = least.select("doc_id", "text", *[F.col("row")[c].alias(c) for c in others]).select(*docs.columns)
        docs = common.stored(docs.join(repeated, "doc_id", "left_anti").select(*docs.columns).unionByName(least), "documents")
    texts = docs.select("doc_id", "text", common.text_key("text").alias("_key"))
    found = jaccard_join.near_duplicates(texts, jaccard_join.Likeness(words=5, least=4, of=5), count_links=False, keep=("_key",))
    removed = found.where("doc_id <> component_id").select("doc_id", "_key")
    if several:  # texts of the smallest id that are linked with each other
        firsts = found.where("doc_id = component_id AND component IS NOT NULL").join(repeated, "doc_id", "left_semi")
        least = firsts.groupBy("component").agg(F.min("_key").alias("least"))
        removed = removed.unionByName(firsts.join(least, "component").where("_key > least").select("doc_id", "_key"))
    removed = common.stored(removed, "removed")
    few = removed.count() <= SENT_WHOLE
    keyed = docs.withColumn("_key", common.text_key("text"))
    return keyed.join(F.broadcast(removed) if few else removed, ["doc_id", "_key"], "left_anti").select(*docs.columns)


@apart
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words or more that occur more than once are cut out; texts without any stay as they are."""
    out = substring_dedup.remove_repeats(docs, WORDS_REPEATED, tuple(docs.columns))
    return _with_text(out, docs, F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text")))


@apart
def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by marks of their kind; texts without any stay as they are."""
    return _with_text(secrets.redacted(docs), docs, F.col("text"))


def _with_text(df: DataFrame, docs: DataFrame, text) -> DataFrame:
    df = df.withColumn("text", text)
    if "n_chars" in docs.columns:
        df = df.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return df.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset: sequences of at most 4,096 tokens."""
    return packing.pack(docs, "word_bpe_49k.json", SEQUENCE, end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", one_of_each_group),
    ("substring_dedup", cut_repeats),
    ("secret_scan", mask_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sequences of all documents of a folder."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(common.prepare(spark), docs, sf_dir), name)
    return docs
