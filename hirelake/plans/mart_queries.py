"""Dashboard and report queries over the serving mart."""

from pyspark.sql import functions as F

from hirelake.functions import fixed, skills
from hirelake.operators import marts, stats, tfidf
from hirelake.plans import sql, stages
from hirelake.plans.feature_queries import STOP, term_tables
from hirelake.plans.registry import query

LEVELS = fixed.CLASSES
DAILY_FROM = "2024-01-02"
WORD_PAIR_TOKEN = rf"(?<![{sql.W}])[{sql.W}]{{2,}}"

_ALL = "(SELECT count(*) FROM jobs)"
sql.TABLES["skill_totals"] = "SELECT skill, count(*) AS postings FROM job_skill GROUP BY skill"


def _top(n: int) -> str:
    return f"(SELECT skill, postings FROM skill_totals ORDER BY postings DESC, skill LIMIT {n})"


@query("serving_mart", f"""
SELECT j.job_id, title, company_name, seniority, employment_type, work_type, city, state, location_level,
    round(salary_yearly, 4) AS salary_yearly, strftime(listed_date, '%Y-%m-%d %H:%M:%S') AS listed_date, cluster,
    CAST(len(skills) AS INTEGER) AS skill_count,
    {', '.join(f"CAST(list_contains(skills, {sql.q(e.name)}) AS INTEGER) AS {skills.skill_slug(e.name)}" for e in skills.SKILLS)}
FROM jobs j JOIN job_skill_list s ON s.job_id = j.job_id""")
def serving_mart(spark, sf):
    mart = marts.serving_mart(stages.jobs(spark, sf), stages.job_skills(spark, sf), stages.clusters(spark, sf))
    wide = marts.wide_mart(mart)
    casts = [f"CAST({skills.skill_slug(e.name)} AS INT) AS {skills.skill_slug(e.name)}" for e in skills.SKILLS]
    plain = [c for c in marts.MART_COLUMNS if c not in ("salary_yearly", "listed_date")]
    return wide.selectExpr(
        *plain, "round(salary_yearly, 4) AS salary_yearly", "date_format(listed_date, 'yyyy-MM-dd HH:mm:ss') AS listed_date",
        "cluster", "skill_count", *casts,
    )


@query("top_skills", f"SELECT skill, postings, {sql.share('postings', _ALL, 6)} AS share FROM {_top(25)}")
def top_skills(spark, sf):
    return marts.top_skills(stages.mart(spark, sf)).select("skill", "postings", F.round("share", 6).alias("share"))


_LEVEL_SHARES = ", ".join(
    f"""round(count(*) FILTER (WHERE seniority = '{c}') * 100.0::DOUBLE
    / (SELECT count(*) FROM jobs WHERE seniority = '{c}'), 6) AS "{c}" """ for c in LEVELS
)


BY_LEVEL_SQL = f"""SELECT skill, "Entry", "Mid", "Senior", greatest("Entry", "Mid", "Senior") AS highest FROM (
SELECT t.skill, {_LEVEL_SHARES} FROM {_top(15)} t LEFT JOIN job_skill s ON s.skill = t.skill
LEFT JOIN jobs j ON j.job_id = s.job_id GROUP BY t.skill)"""


def rounded_levels(out):
    return out.select("skill", *[F.round(c, 6).alias(c) for c in (*LEVELS, "highest")])


@query("skills_by_level", BY_LEVEL_SQL)
def skills_by_level(spark, sf):
    return rounded_levels(marts.skills_by_level(stages.mart(spark, sf)))


@query("skill_cooccurrence", f"""
SELECT a.skill AS row_skill, b.skill AS column_skill, round(count(y.job_id) * 100.0::DOUBLE / any_value(a.postings), 6) AS pct
FROM {_top(20)} a JOIN {_top(20)} b ON a.skill <> b.skill
JOIN job_skill x ON x.skill = a.skill LEFT JOIN job_skill y ON y.job_id = x.job_id AND y.skill = b.skill
GROUP BY a.skill, b.skill""")
def skill_cooccurrence(spark, sf):
    return marts.skill_cooccurrence(stages.mart(spark, sf)).withColumn("pct", F.round("pct", 6))


@query("label_distribution", f"""
SELECT coalesce(seniority, 'Unlabeled') AS label, count(*) AS count, {sql.share('count(*)', _ALL)} AS pct FROM jobs GROUP BY 1""")
def label_distribution(spark, sf):
    return marts.label_distribution(stages.mart(spark, sf))


sql.TABLES["measures"] = f"""SELECT job_id, seniority, salary_yearly, CAST({sql.word_count('description_clean')} AS DOUBLE) AS desc_words,
    {sql.years('description_clean')} AS years_required FROM jobs"""
_MEASURES = ["desc_words", "years_required", "salary_yearly"]


def _box(m: str) -> str:
    return f"""SELECT '{m}' AS measure, seniority, n, round(least(low, q1), 4) AS whisker_low, round(q1, 4) AS q1,
    round(median, 4) AS median, round(q3, 4) AS q3, round(greatest(high, q3), 4) AS whisker_high FROM (
    SELECT b.*, min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1)) AS low, max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1)) AS high
    FROM (SELECT seniority, count(*) AS n, quantile_cont({m}, 0.25) AS q1, quantile_cont({m}, 0.5) AS median,
        quantile_cont({m}, 0.75) AS q3 FROM measures WHERE seniority IS NOT NULL AND {m} IS NOT NULL GROUP BY seniority) b
    JOIN (SELECT seniority, {m} AS v FROM measures WHERE {m} IS NOT NULL) d USING (seniority)
    GROUP BY ALL)"""


@query("box_stats", " UNION ALL ".join(_box(m) for m in _MEASURES))
def box_stats(spark, sf):
    labelled = stages.mart(spark, sf).where("seniority IS NOT NULL")
    pairs = F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in _MEASURES])
    long = labelled.select("seniority", F.inline(pairs))
    out = stats.box_stats(long, "value", ["measure", "seniority"])
    return out.withColumns({c: F.round(c, 4) for c in ("whisker_low", "q1", "median", "q3", "whisker_high")})


@query("years_coverage", """
SELECT seniority, round(avg(CAST(years_required IS NOT NULL AS INTEGER)), 6) AS coverage, median(years_required) AS median
FROM measures WHERE seniority IS NOT NULL GROUP BY seniority""")
def years_coverage(spark, sf):
    out = marts.coverage(stages.mart(spark, sf), "years_required", "seniority")
    return out.withColumn("coverage", F.round("coverage", 6))


@query("top_states", """
SELECT state, count(*) AS postings, (SELECT round(avg(CAST(state IS NULL AS INTEGER)), 6) FROM jobs) AS missing_share
FROM jobs WHERE state IS NOT NULL GROUP BY state ORDER BY count(*) DESC, state LIMIT 15""")
def top_states(spark, sf):
    out = marts.top_values(stages.mart(spark, sf), "state")
    return out.withColumn("missing_share", F.round("missing_share", 6))


_OVERALL = "(SELECT round(median(salary_yearly), 4) FROM jobs)"


def _medians(by: str, min_n: int) -> str:
    return f"""SELECT {by}, count(salary_yearly) AS n, round(median(salary_yearly), 4) AS median, {_OVERALL} AS overall
    FROM jobs WHERE {by} IS NOT NULL GROUP BY {by} HAVING count(salary_yearly) >= {min_n}"""


def _rounded(df, *columns, places=4):
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("median_by_state", _medians("state", 20))
def median_by_state(spark, sf):
    return _rounded(marts.median_by(stages.mart(spark, sf), "state", min_n=20), "median", "overall")


@query("work_type_mix", """
SELECT "group", count(*) AS n, round(count(*) FILTER (WHERE work_type = 'remote') * 100.0::DOUBLE / count(*), 6) AS remote,
    round(count(*) FILTER (WHERE work_type = 'hybrid') * 100.0::DOUBLE / count(*), 6) AS hybrid,
    round(count(*) FILTER (WHERE work_type = 'on-site') * 100.0::DOUBLE / count(*), 6) AS on_site
FROM (SELECT 'All postings' AS "group", work_type FROM jobs
    UNION ALL SELECT seniority, work_type FROM jobs WHERE seniority IS NOT NULL) GROUP BY "group" """)
def work_type_mix(spark, sf):
    return _rounded(marts.work_type_mix(stages.mart(spark, sf)), "remote", "hybrid", "on_site", places=6)


@query("salary_by_skill", """
SELECT skill, count(*) AS n, round(median(salary_yearly), 4) AS median FROM job_skill JOIN jobs USING (job_id)
WHERE salary_yearly IS NOT NULL GROUP BY skill HAVING count(*) >= 20 ORDER BY median(salary_yearly) DESC, skill LIMIT 25""")
def salary_by_skill(spark, sf):
    return _rounded(marts.salary_by_skill(stages.mart(spark, sf), min_n=20), "median")


@query("daily_counts", f"""
SELECT day, count(job_id) AS postings, isodow(day) >= 6 AS weekend FROM (
    SELECT CAST(unnest(generate_series((SELECT min(CAST(listed_date AS DATE)) FROM jobs)::TIMESTAMP,
        (SELECT max(CAST(listed_date AS DATE)) FROM jobs)::TIMESTAMP, INTERVAL 1 DAY)) AS DATE) AS day)
LEFT JOIN jobs ON CAST(listed_date AS DATE) = day WHERE day >= DATE '{DAILY_FROM}' GROUP BY day""")
def daily_counts(spark, sf):
    return marts.daily_counts(stages.mart(spark, sf), DAILY_FROM)


@query("busiest_days", f"""
SELECT (SELECT count(*) FROM jobs WHERE CAST(listed_date AS DATE) < DATE '{DAILY_FROM}') AS rows_before, count(*) AS rows,
    round((SELECT sum(n) FROM (SELECT count(*) AS n FROM jobs GROUP BY CAST(listed_date AS DATE)
        ORDER BY n DESC LIMIT 2))::DOUBLE / count(*), 6) AS busiest_share FROM jobs""")
def busiest_days(spark, sf):
    return _rounded(marts.busiest_days(stages.mart(spark, sf), DAILY_FROM), "busiest_share", places=6)


sql.TABLES["labelled_texts"] = "SELECT job_id, seniority, description_clean AS text FROM jobs WHERE seniority IS NOT NULL"
term_tables("level", "labelled_texts", "true", STOP, 5, 1.0, 20_000, token=f"([{sql.W}]{{2,}})")
_SUMS = ", ".join(f"sum(CASE WHEN seniority = '{c}' THEN tfidf ELSE 0 END) AS s{i}" for i, c in enumerate(LEVELS))
_GAPS = " UNION ALL ".join(
    f"""SELECT '{c}' AS label, term, s{i} / (SELECT count(*) FROM labelled_texts WHERE seniority = '{c}')
    - (s0 + s1 + s2 - s{i}) / (SELECT count(*) FROM labelled_texts WHERE seniority <> '{c}') AS difference FROM sums"""
    for i, c in enumerate(LEVELS)
)
sql.TABLES["sums"] = f"SELECT term, {_SUMS} FROM level_tfidf JOIN labelled_texts USING (job_id) GROUP BY term"


@query("distinctive_terms", f"""
SELECT label, term, round(difference, 6) AS difference, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY label ORDER BY round(difference, 12) DESC, term) AS rank FROM ({_GAPS}))
WHERE rank <= 12""")
def distinctive_terms(spark, sf):
    labelled = stages.jobs(spark, sf).where("seniority IS NOT NULL").select("job_id", "seniority", "description_clean")
    weights = tfidf.tfidf(labelled, "job_id", "description_clean", STOP, max_df=1.0, pattern=WORD_PAIR_TOKEN)
    return _rounded(marts.distinctive_terms(weights, labelled, "job_id", "seniority"), "difference", places=6)


@query("signature_skills", f"""
SELECT cluster, skill, round(share, 6) AS share, round(lift, 6) AS lift, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(lift, 9) DESC, skill) AS rank FROM (
        SELECT cluster, skill, share, share / (t.postings * 100.0::DOUBLE / {_ALL}) AS lift FROM (
            SELECT cluster, skill, count(*) * 100.0::DOUBLE / any_value(size) AS share FROM job_skill JOIN jobs USING (job_id)
            JOIN (SELECT cluster, count(*) AS size FROM jobs GROUP BY cluster) USING (cluster) GROUP BY cluster, skill)
        JOIN skill_totals t USING (skill) WHERE share >= 10))
WHERE rank <= 3""")
def signature_skills(spark, sf):
    return _rounded(marts.signature_skills(stages.mart(spark, sf)), "share", "lift", places=6)


@query("salary_by_cluster", _medians("cluster", 15))
def salary_by_cluster(spark, sf):
    return _rounded(marts.median_by(stages.mart(spark, sf), "cluster", min_n=15), "median", "overall")


_MIX = ", ".join(f"""round(count(*) FILTER (WHERE seniority = '{c}') * 100.0::DOUBLE / count(*), 6) AS "{c}" """ for c in LEVELS)


@query("cluster_level_mix", f"SELECT cluster, count(*) AS n, {_MIX} FROM jobs WHERE seniority IS NOT NULL GROUP BY cluster")
def cluster_level_mix(spark, sf):
    return _rounded(marts.level_mix(stages.mart(spark, sf)), *LEVELS, places=6)


@query("cluster_profile", """
SELECT cluster, count(*) AS postings, round(avg(CAST(work_type = 'remote' AS INTEGER)) * 100, 1) AS remote_pct,
    round(count(*) FILTER (WHERE seniority = 'Entry') * 100.0::DOUBLE / nullif(count(seniority), 0), 1) AS entry_pct,
    round(avg(len(skills)), 1) AS avg_skills, round(median(salary_yearly), -3) AS median_salary
FROM jobs JOIN job_skill_list USING (job_id) GROUP BY cluster""")
def cluster_profile(spark, sf):
    return marts.cluster_profile(stages.mart(spark, sf))


@query("kpis", """
SELECT count(*) AS postings, count(DISTINCT company_name) AS companies, round(median(salary_yearly), 4) AS median_salary,
    round(avg(CAST(salary_yearly IS NOT NULL AS INTEGER)), 6) AS salary_coverage,
    round(avg(CAST(work_type = 'remote' AS INTEGER)), 6) AS remote_share FROM jobs""")
def kpis(spark, sf):
    out = _rounded(marts.kpis(stages.mart(spark, sf)), "median_salary")
    return _rounded(out, "salary_coverage", "remote_share", places=6)


@query("role_counts", "SELECT cluster, count(*) AS postings FROM jobs GROUP BY cluster")
def role_counts(spark, sf):
    return marts.group_counts(stages.mart(spark, sf))


_CHOICE = {"levels": ["Entry", "Mid"], "clusters": [0, 1, 2, 3, 4], "states": ["TX", "WA", "NY"]}
_CHOSEN = "seniority IN ('Entry', 'Mid') AND cluster IN (0, 1, 2, 3, 4) AND state IN ('TX', 'WA', 'NY')"


def _shares(where: str, top: int) -> str:
    return f"""SELECT skill, count(*) AS postings,
    round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM jobs WHERE {where}), 4) AS share
    FROM job_skill JOIN jobs USING (job_id) WHERE {where} AND (SELECT count(*) FROM jobs WHERE {where}) >= 30
    GROUP BY skill ORDER BY postings DESC, skill LIMIT {top}"""


@query("filtered_skill_share", _shares(_CHOSEN, 20))
def filtered_skill_share(spark, sf):
    mart = stages.mart(spark, sf)
    return marts.skill_table(mart, marts.filtered(mart, **_CHOICE)).select("skill", "postings", "share")


@query("skill_table", f"""
SELECT f.skill, f.share, f.postings, d.category, {sql.share('t.postings', _ALL, 4)} AS overall
FROM ({_shares("seniority = 'Mid'", 20)}) f JOIN skill_totals t ON t.skill = f.skill JOIN skill_dictionary d ON d.skill = f.skill""")
def skill_table(spark, sf):
    mart = stages.mart(spark, sf)
    return marts.skill_table(mart, marts.filtered(mart, levels=["Mid"]))


def _spread(by: str, min_n: int) -> str:
    return f"""SELECT '{by}' AS by, count(*) AS groups, round(max(median) - min(median), 4) AS spread FROM (
    SELECT median(salary_yearly) AS median FROM jobs WHERE {by} IS NOT NULL GROUP BY {by} HAVING count(salary_yearly) >= {min_n})"""


@query("median_spread", f"{_spread('state', 20)} UNION ALL {_spread('cluster', 15)}")
def median_spread(spark, sf):
    mart = stages.mart(spark, sf)
    by_state = marts.median_spread(marts.median_by(mart, "state", min_n=20)).withColumn("by", F.lit("state"))
    by_cluster = marts.median_spread(marts.median_by(mart, "cluster", min_n=15)).withColumn("by", F.lit("cluster"))
    return _rounded(by_state.unionByName(by_cluster), "spread")


@query("cluster_titles", """
SELECT cluster, string_agg(title, '; ' ORDER BY n DESC, title) AS titles FROM (
    SELECT cluster, lower(title) AS title, count(*) AS n FROM jobs GROUP BY cluster, lower(title)
    QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, lower(title)) <= 4) GROUP BY cluster""")
def cluster_titles(spark, sf):
    from hirelake.operators import clustering

    return clustering.top_titles(stages.mart(spark, sf))
