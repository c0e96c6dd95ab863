"""From raw postings to the clean table: filter, clean, deduplicate, normalise."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions import fixed, text
from hirelake.operators import location, stats


def tech_titles(df: DataFrame, title: str = "title") -> DataFrame:
    return df.where(text.is_tech_title(title))


def with_clean_text(df: DataFrame, title: str = "title", description: str = "description", exact: bool = True) -> DataFrame:
    """Clean title and description (in a new column)."""
    return df.withColumns({
        title: text.clean_text(title, exact),
        "description_clean": text.clean_text(description, exact),
    })


def without_empty(df: DataFrame, description: str = "description_clean") -> DataFrame:
    """Rows that have a description left. Placed after the aggregate of `deduplicate`,
    since a filter right above the cleaning would be pushed below it and clean twice."""
    return df.where(F.length(description) > 0)


def deduplicate(
    df: DataFrame,
    title: str = "title",
    company: str = "company_name",
    description: str = "description_clean",
    order: str = "job_id",
    attached: tuple[str, ...] = (),
) -> DataFrame:
    """Keep the first row by `order` of each (title, company, description).

    Copies are reduced by an aggregate rather than ranked in a window, so a
    third of all rows being copies of one posting is folded before the shuffle.
    The key is a digest: neither the shuffle nor the sort compares long texts.
    """
    parts = [
        F.lower(text.strip(title)),
        F.lower(text.strip(F.coalesce(F.col(company), F.lit("")))),
        F.lower(F.col(description)),
    ]
    # The digest of each part has a fixed length, so no part can run into the next.
    key = F.sha2(F.concat(*[F.sha2(F.coalesce(p, F.lit("")), 256) for p in parts]), 256)
    # NULL ids come last instead of being left out; equal ones are told apart by a digest of the row,
    # without the columns `attached` by id alone.
    own = [c for c in df.columns if c not in attached]
    rank = F.struct(F.col(order).isNull().alias("none"), F.col(order).alias("id"), F.xxhash64(*own).alias("row"))
    first = F.min_by(F.struct(*df.columns), rank).alias("row")
    return df.groupBy(key.alias("_key")).agg(first).select("row.*")


def to_yearly(amount, pay_period) -> Column:
    """Yearly amount; NULL for an unknown or missing pay period."""
    factor = text.literal_map({k: float(v) for k, v in fixed.PAY_PERIODS.items()})
    return F.col(amount).cast("double") * factor[F.upper(F.col(pay_period))]


def iqr_bounds(df: DataFrame, value: str, k: float = 1.5) -> DataFrame:
    """One row (low, high): Q1 - k x IQR and Q3 + k x IQR."""
    q = stats.quantiles(df, value, {"q1": 0.25, "q3": 0.75})
    iqr = F.col("q3") - F.col("q1")
    return q.select((F.col("q1") - k * iqr).alias("low"), (F.col("q3") + k * iqr).alias("high"))


def with_yearly_amounts(df: DataFrame) -> DataFrame:
    """salary_min, salary_max and salary_yearly in USD a year, before outlier removal.

    A missing currency counts as USD; amounts in any other currency become NULL.
    """
    usd = F.coalesce(F.col("currency"), F.lit("USD")) == "USD"
    low = F.when(usd, to_yearly("min_salary", "pay_period"))
    mid = F.when(usd, to_yearly("med_salary", "pay_period"))
    high = F.when(usd, to_yearly("max_salary", "pay_period"))
    return (
        df.withColumn("salary_min", low)
        .withColumn("salary_max", high)
        .withColumn("salary_yearly", F.coalesce(mid, (F.col("salary_min") + F.col("salary_max")) / 2))
    )


def with_yearly_salary(df: DataFrame, k: float = 1.5) -> DataFrame:
    """Yearly salary columns with IQR outliers blanked, not dropped.

    A row without a yearly salary loses a lone minimum or maximum as well. The
    fences are a scalar subquery over `df`, so `df` should be a written table.
    """
    yearly = with_yearly_amounts(df)
    fences = iqr_bounds(yearly, "salary_yearly", k).select(F.struct("low", "high")).scalar()
    kept = F.col("salary_yearly").between(F.col("_fences.low"), F.col("_fences.high"))
    out = yearly.withColumn("_fences", fences).withColumn("_kept", F.coalesce(kept, F.lit(False)))
    for c in ("salary_min", "salary_max", "salary_yearly"):
        out = out.withColumn(c, F.when(F.col("_kept"), F.col(c)))
    return out.drop("_fences", "_kept")


def outlier_rules(df: DataFrame, value: str = "salary_yearly") -> DataFrame:
    """What each outlier rule would cut: rule, low, high, removed."""
    counts = stats.value_counts(df, value)
    logs = counts.where("v > 0").withColumn("v", F.log("v"))
    quarters = {"q1": 0.25, "q3": 0.75}

    def fences(of: DataFrame, k: float, back) -> DataFrame:
        q = stats.quantiles_of_counts(of, quarters)
        iqr = F.col("q3") - F.col("q1")
        return q.select(back(F.col("q1") - k * iqr).alias("low"), back(F.col("q3") + k * iqr).alias("high"))

    def same(c: Column) -> Column:
        return c

    rules = {
        "IQR k=1.5": fences(counts, 1.5, same),
        "IQR k=3": fences(counts, 3.0, same),
        "IQR on log": fences(logs, 1.5, F.exp),
    }
    out = None
    for name, bounds in rules.items():
        b = bounds.select(F.struct("low", "high")).scalar()
        rows = (
            counts.withColumn("b", b)
            .groupBy()
            .agg(
                F.first("b").alias("b"),
                F.coalesce(F.sum(F.when(~F.col("v").between(F.col("b.low"), F.col("b.high")), F.col("n"))), F.lit(0)).alias("removed"),
            )
            .select(
                F.lit(name).alias("rule"),
                F.round("b.low").cast("long").alias("low"),
                F.round("b.high").cast("long").alias("high"),
                "removed",
            )
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def map_seniority(level, mapping: dict[str, str] | None = None) -> Column:
    """Seniority class of an experience level; NULL if unknown."""
    level = F.col(level) if isinstance(level, str) else level
    return text.literal_map(mapping or fixed.SENIORITY)[level]


def label_options(df: DataFrame, level: str = "experience_level", title: str = "title") -> DataFrame:
    """Class counts under four label mappings: option, one column per class."""
    spec = {**fixed.SENIORITY, "Associate": "Mid"}
    plain = map_seniority(level, spec)
    titled = (F.col(level) == "Mid-Senior level") & F.col(title).rlike("(?iuU)" + fixed.SENIOR_TITLE)
    options = {
        "A": plain,
        "B": F.when(titled, "Senior").otherwise(plain),
        "C": map_seniority(level),
        "D": F.when(plain.isin("Mid", "Senior"), "Experienced").otherwise(plain),
    }
    pairs = F.array(*[F.struct(F.lit(o).alias("option"), c.alias("label")) for o, c in options.items()])
    classes = [*fixed.CLASSES, "Experienced"]
    long = df.where(F.col(level).isNotNull()).select(F.inline(pairs))
    counted = long.groupBy("option").agg(*[F.count_if(F.col("label") == c).alias(c) for c in classes])
    return counted


def near_misses(df: DataFrame, title: str = "title", top: int = 30) -> DataFrame:
    """Most frequent rejected titles that look technical."""
    rejected = df.where(~text.is_tech_title(title) & F.col(title).rlike("(?iuU)" + fixed.NEAR_MISS))
    counted = rejected.groupBy(F.lower(title).alias("title")).agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "title").limit(top)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """A random sample of n rows that does not depend on how rows are partitioned."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(n)


FINAL_COLUMNS = """
job_id title description_raw description_clean company_id company_name industries skill_categories
experience_level seniority employment_type work_type location city state location_level pay_period
salary_min salary_max salary_yearly listed_date original_listed_date views applies
""".split()


def deduped_postings(raw: DataFrame, exact: bool = True, attach: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The row-reducing half of the cleaning: tech titles, clean text, no copies.

    `attach` adds columns by id alone. It joins before the deduplication: raw postings come out of joins by id, so they lie
    in that order already, while after it all texts would be shuffled and sorted once more.
    """
    tech = raw.transform(tech_titles)
    named = attach(tech) if attach else tech
    attached = tuple(c for c in named.columns if c not in tech.columns)
    return named.transform(with_clean_text, exact=exact).transform(deduplicate, attached=attached).transform(without_empty)


def finish_postings(deduped: DataFrame, k: float = 1.5, min_city_count: int = 5) -> DataFrame:
    """The column-adding half, on a written table: salary, place, labels, dates."""
    out = with_yearly_salary(deduped, k)
    out = location.with_location(out, "location", min_city_count)
    out = (
        out.withColumn("work_type", text.work_type("remote_allowed", "title", "description_clean"))
        .withColumn("seniority", map_seniority("formatted_experience_level"))
        .withColumn("listed_date", F.timestamp_millis("listed_time"))
        .withColumn("original_listed_date", F.timestamp_millis("original_listed_time"))
        .withColumnsRenamed({
            "description": "description_raw",
            "formatted_experience_level": "experience_level",
            "formatted_work_type": "employment_type",
        })
    )
    return out.select(*FINAL_COLUMNS)


def build_dataset(
    raw: DataFrame,
    materialize: Callable[[DataFrame, str], DataFrame],
    attach: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """Raw postings to the clean table.

    `attach` adds the columns industries and skill_categories, by id (see `deduped_postings`).
    `materialize(df, name)` writes an intermediate table and returns it read back:
    the fences and the city dictionary each read the deduplicated rows again.
    """
    return finish_postings(materialize(deduped_postings(raw, attach=attach), "deduped"))


def funnel(raw: DataFrame, jobs: DataFrame) -> DataFrame:
    """Rows after each step: raw, tech titles, deduplicated, with a salary, with a state."""
    first = raw.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(text.is_tech_title("title")).alias("tech_rows"),
    )
    then = jobs.agg(
        F.count(F.lit(1)).alias("deduped_rows"),
        F.count("salary_yearly").alias("salary_rows"),
        F.round(F.avg(F.col("state").isNotNull().cast("int")), 6).alias("state_share"),
    )
    return first.withColumn("t", then.select(F.struct("*")).scalar()).select(
        "raw_rows", "tech_rows", (F.round(F.col("tech_rows") / F.nullif("raw_rows", F.lit(0)), 6)).alias("tech_share"), "t.*"
    )
