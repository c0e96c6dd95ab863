"""Summary tables behind the charts and the dashboard.

All of them read the serving mart: one narrow row per posting that already
carries its role cluster and the positions of its skills, so no report joins
postings to skills.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hirelake.functions import fixed, skills, text
from hirelake.operators import cooccurrence, stats

MART_COLUMNS = """
job_id title company_name seniority employment_type work_type city state location_level salary_yearly listed_date
""".split()
WIDTH = len(skills.SKILLS)


def serving_mart(jobs: DataFrame, job_skills: DataFrame, clusters: DataFrame) -> DataFrame:
    """Postings with cluster, skill ids and count, and two text measures, joined by job_id."""
    return (
        jobs.select(
            *MART_COLUMNS,
            text.word_count("description_clean").alias("desc_words"),
            text.years_required("description_clean").alias("years_required"),
        )
        .join(clusters, "job_id")
        .join(job_skills, "job_id")
        .withColumn("skill_count", F.size("skill_ids"))
    )


def unmatched_ids(jobs: DataFrame, other: DataFrame, key: str = "job_id") -> DataFrame:
    """Keys present on one side only; no rows if the two tables cover the same postings."""
    left = jobs.select(key).join(other.select(key), key, "left_anti")
    return left.unionByName(other.select(key).join(jobs.select(key), key, "left_anti"))


def wide_mart(mart: DataFrame) -> DataFrame:
    """The mart with one 0/1 column per skill, as an export."""
    flags = [f"CAST(array_contains(skill_ids, {i}) AS TINYINT) AS {skills.skill_slug(e.name)}" for i, e in enumerate(skills.SKILLS)]
    return mart.selectExpr(*MART_COLUMNS, "cluster", "skill_count", *flags)


def rows(df: DataFrame) -> Column:
    return df.agg(F.count(F.lit(1))).scalar()


def skill_counts(mart: DataFrame, by: list[str] = ()) -> DataFrame:
    """by..., skill_id, postings."""
    long = mart.select(*by, F.explode("skill_ids").alias("skill_id"))
    return long.groupBy(*by, "skill_id").agg(F.count(F.lit(1)).alias("postings"))


def _percent(part: Column, whole: Column) -> Column:
    return part * 100.0 / F.nullif(whole, F.lit(0))


def top_skills(mart: DataFrame, top: int = 25) -> DataFrame:
    """skill, postings, share of all postings in percent."""
    counted = skill_counts(mart).withColumn("skill", skills.skill_name("skill_id"))
    best = counted.orderBy(F.desc("postings"), "skill").limit(top)
    return best.select("skill_id", "skill", "postings", _percent(F.col("postings"), rows(mart)).alias("share"))


def _ids_of(top: DataFrame) -> Column:
    return top.agg(F.collect_list("skill_id")).scalar()


def skills_by_level(mart: DataFrame, top: int = 15, levels=fixed.CLASSES) -> DataFrame:
    """Share of each level's postings that mention each of the top skills, and the largest share."""
    labelled = mart.where(F.col("seniority").isNotNull())
    sizes = labelled.agg(*[F.count_if(F.col("seniority") == c).alias(c) for c in levels]).select(F.struct("*")).scalar()
    ids = _ids_of(top_skills(mart, top))
    long = labelled.select("seniority", F.explode(F.array_intersect("skill_ids", ids)).alias("skill_id"))
    counted = long.groupBy("skill_id").agg(*[F.count_if(F.col("seniority") == c).alias(c) for c in levels])
    # A top skill that no labelled posting mentions still has its row.
    every = top_skills(mart, top).select("skill_id", "skill").join(counted, "skill_id", "left").withColumn("_n", sizes)
    out = every.select("skill", *[F.coalesce(_percent(F.col(c), F.col(f"_n.{c}")), F.lit(0.0)).alias(c) for c in levels])
    return out.withColumn("highest", F.greatest(*levels))


def skill_cooccurrence(mart: DataFrame, top: int = 20) -> DataFrame:
    """row skill, column skill: percent of the row skill's postings that also mention the column skill."""
    named = top_skills(mart, top).select("skill_id", "skill", "postings")
    pairs = cooccurrence.skill_pairs(mart, WIDTH)
    r = named.select(F.col("skill_id").alias("a"), F.col("skill").alias("row_skill"), F.col("postings").alias("row_n"))
    c = named.select(F.col("skill_id").alias("b"), F.col("skill").alias("column_skill"))
    # Zero pairs come from the dictionary (at most `top` squared), not from postings.
    grid = r.withColumn("others", _ids_of(named)).withColumn("b", F.explode("others")).where("a <> b").join(c, "b")
    both = grid.join(pairs, ["a", "b"], "left")
    return both.select("row_skill", "column_skill", (F.coalesce("n", F.lit(0)) * 100.0 / F.col("row_n")).alias("pct"))


def label_distribution(mart: DataFrame, label: str = "seniority") -> DataFrame:
    counted = mart.groupBy(F.coalesce(F.col(label), F.lit("Unlabeled")).alias("label")).agg(F.count(F.lit(1)).alias("count"))
    return stats.with_share(counted, "count", rows(mart))


def coverage(mart: DataFrame, value: str, by: str) -> DataFrame:
    """Share of rows with a value, and its median, per group."""
    known = mart.where(F.col(by).isNotNull())
    shares = known.groupBy(by).agg(F.avg(F.col(value).isNotNull().cast("int")).alias("coverage"))
    middle = stats.medians(known, value, [by]).select(by, "median")
    return stats.null_safe_join(shares, middle, [by], "left")


def top_values(mart: DataFrame, column: str, top: int = 15) -> DataFrame:
    """Most frequent values with counts, and the share of rows without one."""
    counted = mart.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("postings"))
    missing = mart.agg(F.avg(F.col(column).isNull().cast("int"))).scalar()
    return counted.orderBy(F.desc("postings"), column).limit(top).withColumn("missing_share", missing)


def median_by(mart: DataFrame, by: str, value: str = "salary_yearly", min_n: int = 40) -> DataFrame:
    """Median per group with enough values, next to the overall median."""
    grouped = stats.medians(mart.where(F.col(by).isNotNull()), value, [by]).where(F.col("count") >= min_n)
    overall = stats.medians(mart, value).select("median").scalar()
    return grouped.select(by, F.col("count").alias("n"), "median", overall.alias("overall"))


def median_spread(medians: DataFrame) -> DataFrame:
    return medians.agg(F.count(F.lit(1)).alias("groups"), (F.max("median") - F.min("median")).alias("spread"))


def work_type_mix(mart: DataFrame, levels=fixed.CLASSES) -> DataFrame:
    """Work-type shares of all postings and of each level; one row per group, 0 where a type is missing."""
    groups = F.array_compact(F.array(F.lit("All postings"), F.when(F.col("seniority").isin(*levels), F.col("seniority"))))
    expanded = mart.select(F.explode(groups).alias("group"), "work_type")
    counted = expanded.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("work_type") == w).alias(w) for w in fixed.WORK_TYPES]
    )
    return counted.select("group", "n", *[_percent(F.col(w), F.col("n")).alias(w.replace("-", "_")) for w in fixed.WORK_TYPES])


def salary_by_skill(mart: DataFrame, min_n: int = 60, top: int = 25) -> DataFrame:
    paid = mart.where(F.col("salary_yearly").isNotNull()).select("salary_yearly", F.explode("skill_ids").alias("skill_id"))
    enough = stats.medians(paid, "salary_yearly", ["skill_id"]).where(F.col("count") >= min_n)
    named = enough.select(skills.skill_name("skill_id").alias("skill"), F.col("count").alias("n"), "median")
    return named.orderBy(F.desc("median"), "skill").limit(top)


def daily_counts(mart: DataFrame, start: str, date: str = "listed_date") -> DataFrame:
    """Postings per day from `start` on, days without any included; weekends marked."""
    counted = mart.groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("postings"))
    # One row per day of the range, which is as long as the calendar, not the data.
    ends = counted.agg(F.min("day").alias("first"), F.max("day").alias("last")).where("first IS NOT NULL")
    days = ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("day"))
    return (
        days.join(counted, "day", "left")
        .where(F.col("day") >= F.lit(start).cast("date"))
        .select("day", F.coalesce("postings", F.lit(0)).alias("postings"), (F.weekday("day") >= 5).alias("weekend"))
    )


def busiest_days(mart: DataFrame, before: str, top: int = 2, date: str = "listed_date") -> DataFrame:
    """Rows before a date, and the share of all rows on the `top` busiest days."""
    counted = mart.groupBy(F.to_date(date).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    busiest = counted.orderBy(F.desc("n"), "day").limit(top).agg(F.sum("n")).scalar()
    return counted.agg(
        F.coalesce(F.sum(F.when(F.col("day") < F.lit(before).cast("date"), F.col("n"))), F.lit(0)).alias("rows_before"),
        F.sum("n").alias("rows"),
    ).select("rows_before", "rows", (busiest * 1.0 / F.col("rows")).alias("busiest_share"))


def distinctive_terms(weights: DataFrame, labels: DataFrame, key: str, label: str, classes=fixed.CLASSES, top: int = 12) -> DataFrame:
    """Terms whose mean TF-IDF in a class exceeds that in the others the most: label, term, difference, rank.

    A document without a term counts as 0, so sums are divided by document counts.
    """
    sums = weights.join(labels.select(key, label), key).groupBy("term").agg(
        *[F.sum(F.when(F.col(label) == c, F.col("tfidf")).otherwise(0.0)).alias(f"s{i}") for i, c in enumerate(classes)]
    )
    sizes = labels.agg(*[F.count_if(F.col(label) == c).alias(f"n{i}") for i, c in enumerate(classes)]).select(F.struct("*")).scalar()
    everywhere = sum((F.col(f"s{i}") for i in range(len(classes))), F.lit(0.0))
    docs = sum((F.col(f"_n.n{i}") for i in range(len(classes))), F.lit(0))

    def gap(i: int) -> Column:
        inside = F.col(f"s{i}") / F.nullif(F.col(f"_n.n{i}"), F.lit(0))
        return inside - (everywhere - F.col(f"s{i}")) / F.nullif(docs - F.col(f"_n.n{i}"), F.lit(0))

    rows_ = F.array(*[F.struct(F.lit(c).alias("label"), F.col("term"), gap(i).alias("difference")) for i, c in enumerate(classes)])
    long = sums.withColumn("_n", sizes).select(F.inline(rows_)).where(F.col("difference").isNotNull())
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc(F.round("difference", 12)), "term"))
    return long.withColumn("rank", rank).where(F.col("rank") <= top)


def signature_skills(mart: DataFrame, min_share: float = 10.0, top: int = 3, by: str = "cluster") -> DataFrame:
    """Per cluster, the skills most over-represented against all postings, of those in enough of its postings."""
    sizes = mart.groupBy(by).agg(F.count(F.lit(1)).alias("size"))
    overall = skill_counts(mart).select("skill_id", _percent(F.col("postings"), rows(mart)).alias("overall"))
    within = skill_counts(mart, [by]).join(sizes, by).withColumn("share", _percent(F.col("postings"), F.col("size")))
    lifted = within.where(F.col("share") >= min_share).join(overall, "skill_id")
    lifted = lifted.select(by, skills.skill_name("skill_id").alias("skill"), "share", (F.col("share") / F.col("overall")).alias("lift"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(F.round("lift", 9)), "skill"))
    return lifted.withColumn("rank", rank).where(F.col("rank") <= top)


def level_mix(mart: DataFrame, by: str = "cluster", levels=fixed.CLASSES) -> DataFrame:
    """Seniority shares per cluster, labelled postings only."""
    labelled = mart.where(F.col("seniority").isin(*levels)).groupBy(by)
    counted = labelled.agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.col("seniority") == c).alias(c) for c in levels])
    return counted.select(by, "n", *[_percent(F.col(c), F.col("n")).alias(c) for c in levels])


def cluster_profile(mart: DataFrame, by: str = "cluster") -> DataFrame:
    """Size, median salary to the thousand, % remote, % Entry of the labelled, skills per posting."""
    plain = mart.groupBy(by).agg(
        F.count(F.lit(1)).alias("postings"),
        F.round(F.avg((F.col("work_type") == "remote").cast("int")) * 100, 1).alias("remote_pct"),
        F.round(_percent(F.count_if(F.col("seniority") == "Entry"), F.count("seniority")), 1).alias("entry_pct"),
        F.round(F.avg("skill_count"), 1).alias("avg_skills"),
    )
    middle = stats.medians(mart, "salary_yearly", [by]).select(by, F.round("median", -3).alias("median_salary"))
    return stats.null_safe_join(plain, middle, [by], "left")


def kpis(mart: DataFrame) -> DataFrame:
    """Postings, companies, median salary, salary coverage, remote share: one row."""
    companies = mart.select("company_name").distinct().agg(F.count("company_name")).scalar()
    median = stats.medians(mart, "salary_yearly").select("median").scalar()
    base = mart.agg(
        F.count(F.lit(1)).alias("postings"),
        F.avg(F.col("salary_yearly").isNotNull().cast("int")).alias("salary_coverage"),
        F.avg((F.col("work_type") == "remote").cast("int")).alias("remote_share"),
    )
    return base.select("postings", companies.alias("companies"), median.alias("median_salary"), "salary_coverage", "remote_share")


def group_counts(mart: DataFrame, by: str = "cluster") -> DataFrame:
    return mart.groupBy(by).agg(F.count(F.lit(1)).alias("postings"))


def filtered(mart: DataFrame, levels=(), clusters=(), states=()) -> DataFrame:
    """Rows of the chosen levels, clusters and states; an empty choice means all."""
    for column, chosen in (("seniority", levels), ("cluster", clusters), ("state", states)):
        if chosen:
            mart = mart.where(F.col(column).isin(*chosen))
    return mart


def skill_table(mart: DataFrame, chosen: DataFrame, top: int = 20, minimum: int = 30) -> DataFrame:
    """Top skills of the chosen postings: share, postings, category, share of all postings.

    No rows if fewer than `minimum` postings were chosen.
    """
    enough = rows(chosen) >= minimum
    overall = skill_counts(mart).select("skill_id", F.round(_percent(F.col("postings"), rows(mart)), 4).alias("overall"))
    best = top_skills(chosen, top).join(overall, "skill_id").where(enough)
    return best.select(
        "skill", F.round("share", 4).alias("share"), "postings", skills.skill_category("skill_id").alias("category"), "overall"
    )
