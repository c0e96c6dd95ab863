"""TF-IDF in long form: (document, term, weight).

tf is 1 + ln(count), idf is ln((1 + n) / (1 + df)) + 1, each document has unit
length. Terms are counted where the texts are read, so no text is shuffled; the
counts are written once and read back for the vocabulary and for the weights.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions import text as T
from hirelake.sources.stages import materialize


def term_counts(docs: DataFrame, key: str, text: str, stop_words=(), ngrams: int = 2, pattern: str = T.TOKEN) -> DataFrame:
    """How often each term occurs in each document: key, term, tf."""
    split = T.with_terms(docs.select(key, F.col(text).alias("_text")), "_text", "_terms", stop_words, ngrams, pattern)
    # An outer explode: an inner one would have the texts tokenised twice, for a filter on empty lists.
    terms = split.select(key, F.explode_outer("_terms").alias("term")).where("term IS NOT NULL")
    return terms.groupBy(key, "term").agg(F.count(F.lit(1)).alias("tf"))


def fit_vocabulary(
    counts: DataFrame, n_docs: DataFrame, min_df: int = 5, max_df: float = 0.8, max_features: int = 20_000
) -> DataFrame:
    """term, df, idf of the `max_features` most frequent terms that are neither rare nor everywhere.

    `n_docs` is a one-row, one-column frame. Frequency is over the whole corpus;
    ties go by term.
    """
    return _most_frequent(counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")), n_docs, min_df, max_df, max_features)


def vocabulary_of_texts(
    docs: DataFrame, key: str, text: str, stop_words=(), min_df: int = 5, max_df: float = 0.8, max_features: int = 20_000,
    ngrams: int = 2, pattern: str = T.TOKEN,
) -> DataFrame:
    """`fit_vocabulary` of the `term_counts` of texts, without a row for each document and term.

    Each text gives its terms and, after them, its different terms, which are added up by term where it is read. Rows
    of one key are one document, so where keys repeat the counts by document are made after all.
    """
    n_docs = docs.agg(F.count(F.lit(1)))
    if not docs.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        return fit_vocabulary(term_counts(docs, key, text, stop_words, ngrams, pattern), n_docs, min_df, max_df, max_features)
    split = T.with_terms(docs.select(F.col(text).alias("_text")), "_text", "_terms", stop_words, ngrams, pattern)
    both = split.select(F.size("_terms").alias("all"), F.concat("_terms", F.array_distinct("_terms")).alias("_both"))
    # Outer, as in `term_counts`.
    terms = both.select("all", F.posexplode_outer("_both").alias("at", "term")).where("term IS NOT NULL")
    different = (F.col("at") >= F.col("all")).cast("int")
    per_term = terms.groupBy("term").agg(F.sum(different).alias("df"), F.sum(1 - different).alias("cf"))
    return _most_frequent(per_term, n_docs, min_df, max_df, max_features)


def _most_frequent(per_term: DataFrame, n_docs: DataFrame, min_df: int, max_df: float, max_features: int) -> DataFrame:
    n = n_docs.scalar()
    kept = per_term.withColumn("n", n).where((F.col("df") >= min_df) & (F.col("df") <= F.lit(float(max_df)) * F.col("n")))
    top = kept.orderBy(F.desc("cf"), "term").limit(max_features)
    return top.select("term", "df", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weigh(counts: DataFrame, vocabulary: DataFrame, key: str, max_features: int = 20_000) -> DataFrame:
    """key, term, tfidf. The vocabulary has at most `max_features` rows; Spark sends it whole if it is small."""
    weighed = counts.join(vocabulary, "term").withColumn("w", (1 + F.log("tf")) * F.col("idf"))
    length = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(key)))
    return weighed.select(key, "term", (F.col("w") / length).alias("tfidf"))


def tfidf(
    docs: DataFrame, key: str, text: str, stop_words=(), min_df: int = 5, max_df: float = 0.8,
    max_features: int = 20_000, ngrams: int = 2, pattern: str = T.TOKEN,
) -> DataFrame:
    counts = materialize(term_counts(docs, key, text, stop_words, ngrams, pattern), "term-counts")
    vocabulary = fit_vocabulary(counts, docs.agg(F.count(F.lit(1))), min_df, max_df, max_features)
    return weigh(counts, vocabulary, key, max_features)
