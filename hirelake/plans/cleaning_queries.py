"""Profiling and cleaning queries."""

from pyspark.sql import functions as F

from hirelake.functions import fixed, text
from hirelake.operators import cleaning, location, profile, stats
from hirelake.plans import postings, sql, stages
from hirelake.plans.registry import query
from hirelake.session import spread
from hirelake.sources import files
from hirelake.sources.stages import materialize

# ---------------------------------------------------------------- profiling

PROFILED = {
    "job_id": "bigint", "title": "string", "description": "string", "company_id": "bigint", "company_name": "string",
    "location": "string", "formatted_experience_level": "string", "remote_allowed": "int", "pay_period": "string",
    "min_salary": "double", "currency": "string", "listed_time": "bigint",
}
COUNTED = ["formatted_experience_level", "pay_period", "formatted_work_type", "remote_allowed", "currency"]


@query("column_profile", " UNION ALL ".join(
    f"""SELECT {sql.q(c)} AS "column", {sql.q(t)} AS dtype, count({c}) AS non_null,
    round(100 * (1 - count({c})::DOUBLE / count(*)), 1) AS missing_pct, count(DISTINCT {c}) AS n_unique,
    substr(CAST(arg_min({c}, job_id) FILTER (WHERE {c} IS NOT NULL) AS VARCHAR), 1, 60) AS example FROM raw_postings"""
    for c, t in PROFILED.items()
))
def column_profile(spark, sf):
    return profile.column_profile(stages.raw(spark, sf), "job_id", list(PROFILED))


@query("value_counts_null", " UNION ALL ".join(
    f"""SELECT {sql.q(c)} AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count,
    {sql.share('count(*)', '(SELECT count(*) FROM raw_postings)')} AS pct FROM raw_postings GROUP BY {c}""" for c in COUNTED
))
def value_counts_null(spark, sf):
    return profile.value_counts(stages.raw(spark, sf), COUNTED)


@query("listed_by_month", """
SELECT strftime(t, '%Y-%m') AS month, count(*) AS postings, strftime(min(t), '%Y-%m-%d %H:%M:%S') AS first,
    strftime(max(t), '%Y-%m-%d %H:%M:%S') AS last
FROM (SELECT epoch_ms(listed_time) AS t FROM raw_postings) GROUP BY 1""")
def listed_by_month(spark, sf):
    months = profile.by_month(stages.raw(spark, sf).select(F.timestamp_millis("listed_time").alias("t")), "t")
    return months.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("first", "last")})


@query("any_salary_rate", """
SELECT count(*) AS rows, round(avg(CAST(coalesce(min_salary, med_salary, max_salary) IS NOT NULL AS INTEGER)), 6) AS rate
FROM raw_postings""")
def any_salary_rate(spark, sf):
    return profile.any_present_rate(stages.raw(spark, sf), ["min_salary", "med_salary", "max_salary"])


_DESCRIBE = ", ".join(
    f"round({e}, 4) AS {n}"
    for n, e in {
        "mean": "avg(salary_yearly)", "std": "stddev_samp(salary_yearly)", "min": "min(salary_yearly)",
        "q1": "quantile_cont(salary_yearly, 0.25)", "median": "median(salary_yearly)",
        "q3": "quantile_cont(salary_yearly, 0.75)", "max": "max(salary_yearly)",
    }.items()
)


@query("describe_by_group", f"""
SELECT coalesce(pay_period, 'all') AS pay_period, count, mean, std, min, q1, median, q3, max FROM (
SELECT pay_period, count(salary_yearly) AS count, {_DESCRIBE} FROM jobs WHERE salary_yearly IS NOT NULL GROUP BY pay_period
UNION ALL SELECT NULL, count(salary_yearly), {_DESCRIBE} FROM jobs)""")
def describe_by_group(spark, sf):
    jobs = stages.jobs(spark, sf)
    by = stats.describe(jobs, "salary_yearly", ["pay_period"])
    both = by.unionByName(stats.describe(jobs, "salary_yearly").withColumn("pay_period", F.lit("all")))
    return both.withColumns({c: F.round(c, 4) for c in both.columns if c not in ("pay_period", "count")})


@query("link_stats", """
SELECT 'skills' AS link, count(*) AS rows, count(DISTINCT l_orderkey) AS jobs,
    round(count(*)::DOUBLE / count(DISTINCT l_orderkey), 6) AS per_job FROM lineitem
UNION ALL SELECT 'industries', count(*), count(DISTINCT l_orderkey), round(count(*)::DOUBLE / count(DISTINCT l_orderkey), 6)
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""")
def link_stats(spark, sf):
    skills = profile.link_stats(postings.job_skill_links(spark, sf)).withColumn("link", F.lit("skills"))
    return skills.unionByName(
        profile.link_stats(postings.job_industry_links(spark, sf)).withColumn("link", F.lit("industries"))
    )


@query("top_link_names", """
(SELECT 'skills' AS link, p_type AS name, count(*) AS count FROM lineitem JOIN part ON l_partkey = p_partkey
 GROUP BY p_type ORDER BY count(*) DESC, p_type LIMIT 15)
UNION ALL
(SELECT 'industries', n_name, count(*) FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
 JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name ORDER BY count(*) DESC, n_name LIMIT 15)""")
def top_link_names(spark, sf):
    skills = profile.top_names(
        postings.job_skill_links(spark, sf), postings.skill_mapping(spark, sf), "skill_abr", "skill_name"
    )
    industries = profile.top_names(
        postings.job_industry_links(spark, sf), postings.industry_mapping(spark, sf), "industry_id", "industry_name"
    )
    return skills.select(F.lit("skills").alias("link"), F.col("skill_name").alias("name"), "count").unionByName(
        industries.select(F.lit("industries").alias("link"), F.col("industry_name").alias("name"), "count")
    )


@query("distinct_locations", """
SELECT DISTINCT location, city, state FROM jobs WHERE location_level = 'metro' ORDER BY location, city, state LIMIT 10""")
def distinct_locations(spark, sf):
    metro = stages.jobs(spark, sf).where("location_level = 'metro'").select("location", "city", "state")
    return metro.distinct().orderBy("location", "city", "state").limit(10)


GIVEN = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _inventory(spark, sf):
    return files.file_inventory(spark, {n: f"{sf}/{n}.parquet" for n in GIVEN})


@query("file_inventory")
def file_inventory(spark, sf):
    """Files of all given tables. File names and sizes are no SQL values; `table_inventory` checks the rest."""
    return _inventory(spark, sf)


@query("table_inventory", " UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", (SELECT count(*) FROM {n}) AS rows, CAST((SELECT count(*) FROM (DESCRIBE {n})) AS INTEGER) AS columns" for n in GIVEN))
def table_inventory(spark, sf):
    return _inventory(spark, sf).groupBy("table").agg(F.sum("rows").alias("rows"), F.max("columns").alias("columns"))


# ---------------------------------------------------------------- cleaning


@query("join_names", """
SELECT l_orderkey AS job_id, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS names
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IS NOT NULL GROUP BY l_orderkey""")
def join_names(spark, sf):
    return files.join_names(
        postings.job_skill_links(spark, sf), postings.skill_mapping(spark, sf), "skill_abr", "skill_name"
    )


@query("title_filter", f"SELECT job_id, title, {sql.title_ok('title')} AS is_tech FROM raw_postings")
def title_filter(spark, sf):
    return stages.raw(spark, sf).select("job_id", "title", text.is_tech_title("title").alias("is_tech"))


@query("clean_text", f"SELECT doc_id, {sql.clean('text')} AS text FROM documents")
def clean_text(spark, sf):
    return spread(postings.table(spark, sf, "documents")).select("doc_id", text.clean_text("text").alias("text"))


@query("clean_pages", f"SELECT page_id, {sql.clean('html', {'&middot;': '·', '&copy;': '©'})} AS text FROM pages")
def clean_pages(spark, sf):
    return spread(postings.table(spark, sf, "pages")).select("page_id", text.clean_text("html").alias("text"))


@query("dedupe_exact", "SELECT job_id, title, company_name FROM deduped")
def dedupe_exact(spark, sf):
    return cleaning.deduped_postings(stages.raw(spark, sf)).select("job_id", "title", "company_name")


_FACTOR = sql.lookup("upper(pay_period)", {k: float(v) for k, v in fixed.PAY_PERIODS.items()}) + "::DOUBLE"


@query("to_yearly", f"""
SELECT job_id, round(min_salary * {_FACTOR}, 4) AS min_yearly, round(med_salary * {_FACTOR}, 4) AS med_yearly,
    round(max_salary * {_FACTOR}, 4) AS max_yearly FROM raw_postings""")
def to_yearly(spark, sf):
    return stages.raw(spark, sf).select(
        "job_id",
        *[F.round(cleaning.to_yearly(f"{c}_salary", "pay_period"), 4).alias(f"{c}_yearly") for c in ("min", "med", "max")],
    )


@query("iqr_bounds", "SELECT round(low, 4) AS low, round(high, 4) AS high FROM fences")
def iqr_bounds(spark, sf):
    yearly = cleaning.with_yearly_amounts(stages.deduped(spark, sf))
    return cleaning.iqr_bounds(yearly, "salary_yearly").select(F.round("low", 4).alias("low"), F.round("high", 4).alias("high"))


@query("yearly_salary", """
SELECT job_id, round(salary_min, 4) AS salary_min, round(salary_max, 4) AS salary_max,
    round(salary_yearly, 4) AS salary_yearly FROM salaried""")
def yearly_salary(spark, sf):
    out = cleaning.with_yearly_salary(stages.deduped(spark, sf))
    return out.select("job_id", *[F.round(c, 4).alias(c) for c in ("salary_min", "salary_max", "salary_yearly")])


def _rule(name: str, k: float, source: str, back: str) -> str:
    v = "ln(salary_yearly)" if source == "log" else "salary_yearly"
    only = "salary_yearly > 0" if source == "log" else "true"
    return f"""SELECT '{name}' AS rule, CAST(round(low) AS BIGINT) AS low, CAST(round(high) AS BIGINT) AS high,
    (SELECT count(*) FROM yearly WHERE salary_yearly NOT BETWEEN low AND high) AS removed FROM (
    SELECT {back}(q1 - {k} * (q3 - q1)) AS low, {back}(q3 + {k} * (q3 - q1)) AS high FROM (
    SELECT quantile_cont({v}, 0.25) AS q1, quantile_cont({v}, 0.75) AS q3 FROM yearly WHERE {only}))"""


@query("outlier_rules", " UNION ALL ".join([
    _rule("IQR k=1.5", 1.5, "", ""), _rule("IQR k=3", 3, "", ""), _rule("IQR on log", 1.5, "log", "exp"),
]))
def outlier_rules(spark, sf):
    return cleaning.outlier_rules(cleaning.with_yearly_amounts(stages.deduped(spark, sf)))


@query("parse_location", "SELECT job_id, location, city, state, location_level FROM parsed")
def parse_location(spark, sf):
    return stages.deduped(spark, sf).select("job_id", "location", location.parse_location("location").alias("p")).select(
        "job_id", "location", "p.*"
    )


@query("metro_resolution", "SELECT job_id, location, city, state, location_level FROM jobs")
def metro_resolution(spark, sf):
    return location.with_location(stages.deduped(spark, sf).select("job_id", "location"), "location")


@query("modal_state", "SELECT city, state, CAST(total AS BIGINT) AS count FROM city_states")
def modal_state(spark, sf):
    parsed = stages.deduped(spark, sf).select(location.parse_location("location").alias("p")).select("p.*")
    return location.modal(parsed.where("state IS NOT NULL AND city IS NOT NULL"), "city", "state")


@query("work_type", f"""
SELECT job_id, {sql.work_type('remote_allowed', 'title', 'description_clean')} AS work_type FROM deduped""")
def work_type(spark, sf):
    return stages.deduped(spark, sf).select(
        "job_id", text.work_type("remote_allowed", "title", "description_clean").alias("work_type")
    )


@query("map_seniority", f"""
SELECT job_id, formatted_experience_level, {sql.lookup('formatted_experience_level', fixed.SENIORITY)} AS seniority
FROM raw_postings""")
def map_seniority(spark, sf):
    return stages.raw(spark, sf).select(
        "job_id", "formatted_experience_level", cleaning.map_seniority("formatted_experience_level").alias("seniority")
    )


_SPEC = sql.lookup("experience_level", {**fixed.SENIORITY, "Associate": "Mid"})
_OPTIONS = {
    "A": _SPEC,
    "B": f"CASE WHEN experience_level = 'Mid-Senior level' AND {sql.matches('title', '(?i)' + fixed.SENIOR_TITLE)} "
    f"THEN 'Senior' ELSE {_SPEC} END",
    "C": sql.lookup("experience_level", fixed.SENIORITY),
    "D": f"CASE WHEN {_SPEC} IN ('Mid', 'Senior') THEN 'Experienced' ELSE {_SPEC} END",
}
_CLASS_COUNTS = ", ".join(f'count(*) FILTER (WHERE label = {sql.q(c)}) AS "{c}"' for c in [*fixed.CLASSES, "Experienced"])


@query("label_options", " UNION ALL ".join(
    f"SELECT '{o}' AS option, {_CLASS_COUNTS} FROM (SELECT {e} AS label FROM jobs WHERE experience_level IS NOT NULL)"
    for o, e in _OPTIONS.items()
))
def label_options(spark, sf):
    return cleaning.label_options(stages.jobs(spark, sf))


@query("epoch_to_date", """
SELECT job_id, strftime(epoch_ms(listed_time), '%Y-%m-%d %H:%M:%S') AS listed,
    CAST(epoch_ms(original_listed_time) AS DATE) AS original_date FROM raw_postings""")
def epoch_to_date(spark, sf):
    return stages.raw(spark, sf).select(
        "job_id",
        F.date_format(F.timestamp_millis("listed_time"), "yyyy-MM-dd HH:mm:ss").alias("listed"),
        F.to_date(F.timestamp_millis("original_listed_time")).alias("original_date"),
    )


_KEPT_AS_IS = [
    c for c in cleaning.FINAL_COLUMNS
    if c not in ("salary_min", "salary_max", "salary_yearly", "listed_date", "original_listed_date", "industries", "skill_categories")
]


@query("build_dataset", f"""
SELECT {', '.join('j.' + c for c in _KEPT_AS_IS)}, round(salary_min, 4) AS salary_min, round(salary_max, 4) AS salary_max,
    round(salary_yearly, 4) AS salary_yearly, strftime(listed_date, '%Y-%m-%d %H:%M:%S') AS listed_date,
    strftime(original_listed_date, '%Y-%m-%d %H:%M:%S') AS original_listed_date, s.names AS skill_categories, i.names AS industries
FROM jobs j
LEFT JOIN (SELECT l_orderkey, string_agg(DISTINCT p_type, '|' ORDER BY p_type) AS names
    FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_orderkey) s ON s.l_orderkey = j.job_id
LEFT JOIN (SELECT l_orderkey, string_agg(DISTINCT n_name, '|' ORDER BY n_name) AS names
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY l_orderkey) i
    ON i.l_orderkey = j.job_id""")
def build_dataset(spark, sf):
    jobs = cleaning.build_dataset(stages.raw(spark, sf), materialize, lambda df: stages.with_names(spark, sf, df))
    out = jobs.withColumns({c: F.round(c, 4) for c in ("salary_min", "salary_max", "salary_yearly")})
    return out.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("listed_date", "original_listed_date")}
    )


@query("funnel", f"""
SELECT (SELECT count(*) FROM raw_postings) AS raw_rows, (SELECT count(*) FROM tech) AS tech_rows,
    round((SELECT count(*) FROM tech)::DOUBLE / (SELECT count(*) FROM raw_postings), 6) AS tech_share,
    count(*) AS deduped_rows, count(salary_yearly) AS salary_rows,
    round(avg(CAST(state IS NOT NULL AS INTEGER)), 6) AS state_share FROM jobs""")
def funnel(spark, sf):
    return cleaning.funnel(stages.raw(spark, sf), stages.jobs(spark, sf))


@query("near_miss", f"""
SELECT lower(title) AS title, count(*) AS count FROM raw_postings
WHERE NOT {sql.title_ok('title')} AND {sql.matches('title', '(?i)' + fixed.NEAR_MISS)}
GROUP BY lower(title) ORDER BY count(*) DESC, 1 LIMIT 30""")
def near_miss(spark, sf):
    return cleaning.near_misses(stages.raw(spark, sf))


@query("sample_kept_dropped", " UNION ALL ".join(
    f"""(SELECT job_id, title, {kept} AS kept FROM raw_postings WHERE {sql.title_ok('title')} = {kept}
    ORDER BY md5(CAST(job_id AS VARCHAR) || ':42'), job_id LIMIT 30)""" for kept in ("true", "false")
))
def sample_kept_dropped(spark, sf):
    titles = stages.raw(spark, sf).select("job_id", "title", text.is_tech_title("title").alias("kept"))
    return cleaning.sample_rows(titles.where("kept"), "job_id", 30).unionByName(
        cleaning.sample_rows(titles.where("NOT kept"), "job_id", 30)
    )


@query("url_rate", """
SELECT count(*) AS rows, round(avg(CAST(regexp_matches(description_raw, 'https?://|www[.]') AS INTEGER)), 6) AS rate FROM jobs""")
def url_rate(spark, sf):
    return profile.pattern_rate(stages.jobs(spark, sf), "description_raw", r"https?://|www\.")
