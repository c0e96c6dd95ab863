"""Posting features without any fitting, and small fitted ones done as aggregates."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions import fixed, skills, text

VARIANTS = ("with_title", "without_title")
NUMERIC = ["log_desc_words", "years_required", "skill_count"]
FLAGS = list(fixed.KEYWORD_FLAGS)


def build_features(
    df: DataFrame,
    title: str = "title",
    description: str = "description_clean",
    company: str = "company_name",
    key: str = "job_id",
    variants: tuple[str, ...] = VARIANTS,
    exact: bool = True,
    keep: tuple[str, ...] = (),
    clean: bool = True,
) -> DataFrame:
    """One row per posting and variant: text, log words, years, flags, skill ids and count.

    What depends on the description alone is computed once; only the text, and
    the flags and skills found in it, exist per variant. The variant is a column,
    so one variant is a partition-pruned read of the stored table. `clean=False`
    takes texts that have just been cleaned as they are.
    """

    def cleaned_text(c: str) -> Column:
        return F.when(F.col(c).isNotNull(), text.clean_text(c, exact)) if clean else F.col(c)

    cleaned = df.select(
        key,
        *keep,
        F.col(company).alias("_company"),
        cleaned_text(title).alias("_title"),
        cleaned_text(description).alias("_desc"),
    )
    bare = text.remove_company(F.concat_ws(" ", "_desc"), "_company")
    texts = {
        "with_title": text.remove_company(F.concat_ws(" ", "_title", "_desc"), "_company"),
        "without_title": F.col("_bare"),
    }
    rows = (
        cleaned.withColumn("_bare", bare)
        .withColumn("log_desc_words", F.log1p(text.word_count("_bare").cast("double")))
        .withColumn("years_required", text.years_required("_bare"))
        .select(
            key,
            *keep,
            "log_desc_words",
            "years_required",
            F.inline(F.array(*[F.struct(F.lit(v).alias("variant"), texts[v].alias("text")) for v in variants])),
        )
        .withColumns(text.keyword_flags("text"))
    )
    out = skills.with_skill_ids(rows, "text").withColumn("skill_count", F.size("skill_ids"))
    return out.select(key, *keep, "variant", "text", *NUMERIC[:2], *FLAGS, "skill_ids", "skill_count")


def skill_matrix(df: DataFrame, key: str = "job_id", ids: str = "skill_ids") -> DataFrame:
    """One 0/1 column per skill, and their number."""
    flags = [
        f"CAST(array_contains({ids}, {i}) AS INT) AS {skills.skill_slug(e.name)}" for i, e in enumerate(skills.SKILLS)
    ]
    return df.selectExpr(key, *flags, f"size({ids}) AS skill_count")


def impute_median(df: DataFrame, columns: list[str], key: str = "job_id") -> DataFrame:
    """Missing numbers become the exact median; <column>_missing says where."""
    from hirelake.operators import stats

    out = df.select(key, *columns)
    for c in columns:
        median = stats.medians(df, c).select("median").scalar()
        out = out.withColumn(f"{c}_missing", F.col(c).isNull().cast("int")).withColumn(c, F.coalesce(F.col(c).cast("double"), median))
    return out


def standardize(df: DataFrame, columns: list[str], key: str = "job_id") -> DataFrame:
    """(x - mean) / population standard deviation; a constant column becomes 0."""
    moments = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))])
    one = df.select(key, *columns).withColumn("m", moments.select(F.struct("*")).scalar())

    def z(c: str) -> Column:
        std = F.col(f"m.std_{c}")
        return ((F.col(c) - F.col(f"m.mean_{c}")) / F.when(std == 0, 1.0).otherwise(std)).alias(c)

    return one.select(key, *[z(c) for c in columns])


def class_counts(df: DataFrame, label: str, classes: list[str]) -> DataFrame:
    """One row: a map from class to its number of rows."""
    counts = [F.count_if(F.col(label) == c) for c in classes]
    return df.agg(F.map_from_arrays(text.literal_array(classes), F.array(*counts)).alias("counts"))


def with_balanced_weight(df: DataFrame, label: str, classes: list[str], out: str = "weight") -> DataFrame:
    """Weight n / (k x n_class), so that every class weighs the same in total."""
    counts = class_counts(df, label, classes).scalar()
    total = F.aggregate(F.map_values("_counts"), F.lit(0).cast("bigint"), lambda a, b: a + b)
    present = F.size(F.filter(F.map_values("_counts"), lambda n: n > 0))
    return (
        df.withColumn("_counts", counts)
        .withColumn(out, total / (present * F.col("_counts")[F.col(label)]))
        .drop("_counts")
    )


def group_key(company, job_id) -> Column:
    """A company is a group; a posting without one is a group of its own."""
    return F.lower(F.coalesce(F.col(company), F.concat(F.lit("job_"), F.col(job_id).cast("string"))))
