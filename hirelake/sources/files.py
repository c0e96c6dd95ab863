"""Reading raw files and writing results."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.functions import fixed

_TYPES = {
    "job_id": "bigint", "company_id": "double", "remote_allowed": "double", "min_salary": "double",
    "med_salary": "double", "max_salary": "double", "listed_time": "double",
    "original_listed_time": "double", "views": "double", "applies": "double",
}
_FINAL_TYPES = {"company_id": "bigint", "remote_allowed": "int", "listed_time": "bigint", "original_listed_time": "bigint"}

# Cells read as missing.
NA_TOKENS = """
#N/A|#N/A N/A|#NA|-1.#IND|-1.#QNAN|-NaN|-nan|1.#IND|1.#QNAN|<NA>|N/A|NA|NULL|NaN|None|n/a|nan|null
""".strip().split("|")


def read_csv(spark: SparkSession, path: str, columns: list[str], types: dict[str, str] = {}) -> DataFrame:
    """Read columns of a CSV by name: quoted line breaks, doubled quotes, missing-value words.

    All columns are read as text under the file's own header; only the wanted
    ones are parsed further.
    """
    raw = (
        spark.read.option("header", True)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )

    def value(c: str) -> Column:
        known = F.when(~F.col(c).isin("", *NA_TOKENS), F.col(c))
        return known.try_cast(types[c]).alias(c) if c in types else known.alias(c)

    return raw.select(*[value(c) for c in columns])


def read_postings_csv(spark: SparkSession, path: str) -> DataFrame:
    df = read_csv(spark, path, fixed.POSTING_COLUMNS, _TYPES)
    return df.withColumns({c: F.col(c).cast(t) for c, t in _FINAL_TYPES.items()})


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def join_names(links: DataFrame, names: DataFrame, key: str, name: str, job_id: str = "job_id") -> DataFrame:
    """Names per job, sorted and distinct, joined by "|". Links without a name are dropped.

    Distinct (job, name) pairs are formed before they are gathered, and a job
    gathers at most as many as the lookup has names.
    """
    named = links.join(names, key).where(F.col(name).isNotNull()).select(job_id, name).distinct()
    return named.groupBy(job_id).agg(F.concat_ws("|", F.array_sort(F.collect_list(name))).alias("names"))


def attach_names(postings: DataFrame, links: DataFrame, names: DataFrame, key: str, name: str, out: str) -> DataFrame:
    joined = join_names(links, names, key, name).select(F.col("job_id").alias("_id"), F.col("names").alias(out))
    return postings.join(joined, F.col("job_id") == F.col("_id"), "left").drop("_id")


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").option("compression", compression).partitionBy(*partition_by).parquet(path)


def as_sink_types(jobs: DataFrame) -> DataFrame:
    """Single-precision amounts, as the stored clean table has them."""
    amounts = ("salary_min", "salary_max", "salary_yearly", "views", "applies")
    return jobs.withColumns({c: F.col(c).cast(T.FloatType()) for c in amounts if c in jobs.columns})


def file_inventory(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """table, file, size_mb, rows, columns for every Parquet file of the given tables, largest first.

    Files are listed and counted by Spark from their metadata; the loop is over
    tables, since each has a schema of its own.
    """
    out = None
    for name, path in tables.items():
        data = spark.read.parquet(path)
        counted = data.groupBy(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
            F.count(F.lit(1)).alias("rows")
        )
        one = counted.select(
            F.lit(name).alias("table"),
            F.element_at(F.split("path", "/"), -1).alias("file"),
            F.round(F.col("bytes") / 1e6, 1).alias("size_mb"),
            "rows",
            F.lit(len(data.columns)).alias("columns"),
        )
        out = one if out is None else out.unionByName(one)
    return out.orderBy(F.desc("size_mb"), "table", "file")
