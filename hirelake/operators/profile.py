"""Profiling of a raw table: columns, value counts, rates, link tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.operators import stats


def _unpivot(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row per (column, value), values as text."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns]
    return df.select(F.inline(F.array(*pairs)))


def column_profile(df: DataFrame, order: str, columns: list[str] | None = None) -> DataFrame:
    """column, dtype, non_null, missing_pct, n_unique, example for each column.

    Distinct values are counted by a digest of long ones, so texts themselves are
    not shuffled. The example is the first non-NULL value by `order`, 60 letters of it.
    """
    columns = columns or df.columns
    value = F.when(F.length("value") > 32, F.concat(F.lit("md5:"), F.md5("value"))).otherwise(F.col("value"))
    distinct = _unpivot(df, columns).groupBy("column", value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    counted = distinct.groupBy("column").agg(
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
        F.sum("n").alias("total"),
        F.count("value").alias("n_unique"),
    )
    firsts = df.agg(
        *[
            F.min_by(F.substring(F.col(c).cast("string"), 1, 60), F.when(F.col(c).isNotNull(), F.col(order))).alias(c)
            for c in columns
        ]
    )
    types = dict(df.dtypes)
    examples = firsts.select(
        F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.lit(types[c]).alias("dtype"), F.col(c).alias("example")) for c in columns
        ]))
    )
    return counted.join(examples, "column").select(
        "column",
        "dtype",
        "non_null",
        F.round(100 * (1 - F.col("non_null") / F.col("total")), 1).alias("missing_pct"),
        "n_unique",
        "example",
    )


def approximate_distinct(df: DataFrame, columns: list[str] | None = None, rsd: float = 0.02) -> DataFrame:
    """column, n_unique from sketches, in one pass and one row: for very wide tables."""
    columns = columns or df.columns
    one = df.agg(*[F.approx_count_distinct(c, rsd).alias(c) for c in columns])
    return one.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_unique")) for c in columns])))


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """column, value, count, pct: NULL is a value of its own."""
    counted = _unpivot(df, columns).groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    return stats.with_share(counted, "count", df.agg(F.count(F.lit(1))))


def by_month(df: DataFrame, timestamp: str) -> DataFrame:
    """month, postings, and the first and last time of the month."""
    return df.groupBy(F.date_format(timestamp, "yyyy-MM").alias("month")).agg(
        F.count(F.lit(1)).alias("postings"), F.min(timestamp).alias("first"), F.max(timestamp).alias("last")
    )


def any_present_rate(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.round(F.avg(F.coalesce(*[F.col(c) for c in columns]).isNotNull().cast("int")), 6).alias("rate"),
    )


def link_stats(links: DataFrame, job_id: str = "job_id") -> DataFrame:
    """rows, jobs and mean links per job, from per-job counts."""
    per_job = links.groupBy(job_id).agg(F.count(F.lit(1)).alias("n"))
    return per_job.agg(
        F.sum("n").alias("rows"),
        F.count(job_id).alias("jobs"),
        F.round(F.avg("n"), 6).alias("per_job"),
    )


def top_names(links: DataFrame, names: DataFrame, key: str, name: str, top: int = 15) -> DataFrame:
    """Most frequent names of a link table; links are counted per key before the join."""
    counted = links.groupBy(key).agg(F.count(F.lit(1)).alias("n")).join(names, key)
    return counted.groupBy(name).agg(F.sum("n").alias("count")).orderBy(F.desc("count"), name).limit(top)


def pattern_rate(df: DataFrame, text: str, pattern: str) -> DataFrame:
    """Share of rows whose text matches; a missing text does not."""
    hit = F.coalesce(F.col(text).rlike(pattern), F.lit(False))
    return df.agg(F.count(F.lit(1)).alias("rows"), F.round(F.avg(hit.cast("int")), 6).alias("rate"))
