"""The registered queries of this folder: each applies its operator to whole tables and derives its digest columns."""

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm import (
    byte_bpe,
    common,
    conversations,
    exact_search,
    jaccard_join,
    near_search,
    packing,
    personal_data,
    phrases,
    secrets,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_substring_dedup")
def op1(spark, sf):
    """Passages of 35 words and more that occur twice are taken out."""
    out = substring_dedup.remove_repeats(common.table(spark, sf, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

OP2_SQL = f"""
WITH rules(rule, listed) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in RULES.items())}),
judged AS (SELECT row_number() OVER () AS n, page_id,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
parts AS (SELECT rule, listed, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path FROM rules)
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(listed, length(rule)), 'allow') AS verdict
FROM judged LEFT JOIN parts ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
GROUP BY n, page_id, host, path"""


@query("op2_url_filter", OP2_SQL)
def op2(spark, sf):
    listed = spark.createDataFrame(list(RULES.items()), "rule string, verdict string")
    return url_filter.judge(common.table(spark, sf, "pages"), listed)


@query("op3_byte_bpe")
def op3(spark, sf):
    """Encodes every document, decodes the ids again, and gives digests of both."""
    ranks = "byte_bpe_50k.tiktoken"
    encoded = byte_bpe.encode(common.table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN)

    def digest(batch: pa.RecordBatch) -> dict:
        ids = batch.column("ids").to_pylist()
        return {
            "doc_id": batch.column("doc_id"),
            "n_tokens": pa.array([len(i) // 4 for i in ids], pa.int64()),
            "ids_sha256": pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
            "decoded_sha256": pa.array([hashlib.sha256(byte_bpe.decode_ids(i, ranks)).hexdigest() for i in ids], pa.string()),
        }

    return common.per_batch(encoded, digest, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def _of_kinds(spans, kinds):
    return F.filter(spans, lambda s: s["kind"].isin(*kinds))


def _joined(spans):
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


@query("op4_secret_scan")
def op4(spark, sf):
    found = secrets.find_secrets(common.table(spark, sf, "documents"))
    return found.select(
        "doc_id", *[F.size(_of_kinds(F.col("spans"), [k])).cast("long").alias(f"n_{k}") for k in secrets.BASE_KINDS],
        F.sha2(_joined(_of_kinds(F.col("spans"), secrets.BASE_KINDS)), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
    )


@query("op5_toxicity")
def op5(spark, sf):
    docs = common.table(spark, sf, "documents")
    net = toxicity.fit(docs, common.table(spark, sf, "labels"))
    score = F.col("score")
    return toxicity.score(docs, net).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (score >= 0.5).cast("int").alias("predicted")
    )


@query("op6_near_search")
def op6(spark, sf):
    vectors = common.table(spark, sf, "embeddings")
    return near_search.nearest(vectors.where("vec_id % 20 = 0"), vectors, k=20)


@query("op7_token_counts")
def op7(spark, sf):
    return token_counts.token_counts(common.table(spark, sf, "documents"), "piece_bpe_32k.model", 4096)


OP8_SQL = """
WITH whole AS (SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM whole q JOIN whole c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v))
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scores QUALIFY rank <= 5"""


@query("op8_exact_search", OP8_SQL)
def op8(spark, sf):
    vectors = common.table(spark, sf, "embeddings")
    return exact_search.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5, levels=256)


@query("op9_ngram_jaccard")
def op9(spark, sf):
    """Links at 85 % of 4-word shingles."""
    return jaccard_join.near_duplicates(common.table(spark, sf, "documents"), jaccard_join.Likeness(words=4, least=17, of=20))


@query("op10_packing")
def op10(spark, sf):
    return packing.pack(common.table(spark, sf, "documents"), "word_bpe_49k.json", 4096, end_id=1)


@query("op11_conversation_repair")
def op11(spark, sf):
    """Conversations with faults put in, and their cheapest repair."""
    given = common.table(spark, sf, "conversations")
    return conversations.repair(conversations.damaged(given), ids=given)


@query("op12_personal_data")
def op12(spark, sf):
    """Base kinds by pattern, further identifiers by the contexts that those induce."""
    spans = F.col("spans")
    return personal_data.find(common.table(spark, sf, "documents")).select(
        "doc_id", *[F.size(_of_kinds(spans, [k])).cast("long").alias(f"n_{k}") for k in personal_data.BASE],
        F.sha2(_joined(_of_kinds(spans, personal_data.BASE)), 256).alias("base_sha256"), _joined(spans).alias("spans"),
    )


OP13_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
words AS (SELECT lang, [x FOR x IN string_split_regex(piece, '[ \\t]+') IF x <> ''] AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
places AS (SELECT lang, k, unnest([ws[i:i + k - 1] FOR i IN range(1, len(ws) - k + 2)]) AS ws FROM words, (VALUES (1), (2), (3)) AS t(k) WHERE len(ws) >= k),
grams AS (SELECT lang, k, ws, count(*) AS f FROM places GROUP BY ALL),
often AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM grams WHERE f >= 10),
parts AS (SELECT lang, k, phrase, f AS a, j, array_to_string(ws[:j], ' ') AS left_, array_to_string(ws[j + 1:], ' ') AS right_
    FROM often, (VALUES (1), (2)) AS t(j) WHERE k > j),
cuts AS (SELECT p.*, l.f AS l, r.f AS r, CAST((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
    FROM parts p JOIN often l ON l.lang = p.lang AND l.phrase = p.left_ JOIN often r ON r.lang = p.lang AND r.phrase = p.right_),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_ AS (SELECT lang, array_to_string(ws[p:p + 1], ' ') AS phrase, max(f) AS longer FROM often, (VALUES (1), (2)) AS t(p) WHERE k = 3 GROUP BY ALL)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank, b.phrase, a, l, r, n, score
FROM best b JOIN totals USING (lang) LEFT JOIN inner_ i ON i.lang = b.lang AND i.phrase = b.phrase AND b.k = 2
WHERE longer IS NULL OR 100 * longer < 50 * a QUALIFY rank <= 2000"""


@query("op13_phrase_mining", OP13_SQL)
def op13(spark, sf):
    """The 2,000 strongest phrases of two and three words of each language."""
    return phrases.collocations(common.table(spark, sf, "documents"), longest=3, least=10, covered=(50, 100), first=2000)
