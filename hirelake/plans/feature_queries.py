"""Text features, fitted features and group folds."""

from pyspark.sql import functions as F

from hirelake.functions import fixed, skills, text
from hirelake.operators import features, folds, tfidf
from hirelake.plans import sql, stages
from hirelake.plans.registry import query
from hirelake.session import spread

STOP = fixed.ENGLISH_STOP_WORDS
CLUSTER_STOP = list(dict.fromkeys([*fixed.ENGLISH_STOP_WORDS, *fixed.BOILERPLATE_WORDS]))

_with_title = sql.remove_company(f"(t || ' ' || d)", "company_name")
_bare = sql.remove_company("d", "company_name")

sql.TABLES.update({
    "model_texts": f"""SELECT job_id, variant, bare, CASE variant WHEN 'with_title' THEN titled ELSE bare END AS text FROM (
        SELECT job_id, {_with_title} AS titled, {_bare} AS bare FROM (
        SELECT job_id, company_name, {sql.clean('title')} AS t, {sql.clean('description_clean')} AS d FROM jobs)),
        (VALUES ('with_title'), ('without_title')) AS v(variant)""",
    "features": f"""SELECT job_id, variant, text, ln(1 + {sql.word_count('bare')}) AS log_desc_words, {sql.years('bare')} AS years_required,
        {', '.join(f"{sql.flag('text', p)} AS {n}" for n, p in fixed.KEYWORD_FLAGS.items())},
        skills, CAST(len(skills) AS INTEGER) AS skill_count
        FROM (SELECT *, {sql.skill_list('text')} AS skills FROM model_texts)""",
    "labelled": """SELECT job_id, title, company_name, description_clean, seniority,
        lower(coalesce(company_name, 'job_' || CAST(job_id AS VARCHAR))) AS "group" FROM jobs WHERE seniority IS NOT NULL""",
})


@query("remove_company", f"SELECT job_id, {sql.remove_company('description_raw', 'company_name')} AS text FROM jobs")
def remove_company(spark, sf):
    return stages.jobs(spark, sf).select("job_id", text.remove_company("description_raw", "company_name").alias("text"))


@query("model_text", "SELECT job_id, variant, text FROM model_texts")
def model_text(spark, sf):
    parts = ("title", "description_clean", "company_name")
    both = F.array(*[
        F.struct(F.lit(v).alias("variant"), text.model_text(*parts, include_title=v == "with_title").alias("text"))
        for v in features.VARIANTS
    ])
    return stages.jobs(spark, sf).select("job_id", F.inline(both))


sql.TABLES["cluster_texts"] = f"""SELECT job_id, t || ' ' || t || ' ' || t || ' ' || {_bare} AS text FROM (
    SELECT job_id, company_name, {sql.clean('title')} AS t, {sql.clean('description_clean')} AS d FROM jobs)"""


@query("cluster_text", "SELECT job_id, text FROM cluster_texts")
def cluster_text(spark, sf):
    return stages.cluster_texts(spark, sf)


@query("skill_extract", "SELECT job_id, skill FROM job_skill")
def skill_extract(spark, sf):
    texts = spread(stages.jobs(spark, sf), "job_id").select("job_id", F.concat_ws(" ", "title", "description_clean").alias("text"))
    found = skills.with_skill_ids(texts, "text")
    return found.select("job_id", F.explode(skills.skill_names("skill_ids")).alias("skill"))


_FLAGS = ", ".join(
    f"CAST(list_contains(skills, {sql.q(e.name)}) AS INTEGER) AS {skills.skill_slug(e.name)}" for e in skills.SKILLS
)


@query("skill_matrix", f"SELECT job_id, {_FLAGS}, CAST(len(skills) AS INTEGER) AS skill_count FROM job_skill_list")
def skill_matrix(spark, sf):
    return features.skill_matrix(stages.job_skills(spark, sf))


_PLAIN = "lower(skill)"
for _mark, _word in skills.SPELLED.items():
    _PLAIN = f"replace({_PLAIN}, {sql.q(_mark)}, {sql.q(_word)})"


@query("skill_slug", f"""
SELECT skill, postings, 'skill_' || trim(regexp_replace({_PLAIN}, '[^a-z0-9]+', '_', 'g'), '_') AS slug
FROM (SELECT skill, count(*) AS postings FROM job_skill GROUP BY skill)""")
def skill_slug(spark, sf):
    counted = stages.job_skills(spark, sf).select(F.explode("skill_ids").alias("id")).groupBy("id")
    named = counted.agg(F.count(F.lit(1)).alias("postings")).select(skills.skill_name("id").alias("skill"), "postings")
    return named.withColumn("slug", skills.skill_slug_column(F.col("skill")))


@query("years_required", f"SELECT job_id, {sql.years('description_clean')} AS years FROM jobs")
def years_required(spark, sf):
    return stages.jobs(spark, sf).select("job_id", text.years_required("description_clean").alias("years"))


@query("keyword_flags", f"""
SELECT job_id, {', '.join(f"{sql.flag('t', p)} AS {n}" for n, p in fixed.KEYWORD_FLAGS.items())}
FROM (SELECT job_id, title || ' ' || description_clean AS t FROM jobs)""")
def keyword_flags(spark, sf):
    texts = stages.jobs(spark, sf).select("job_id", F.concat_ws(" ", "title", "description_clean").alias("t"))
    return texts.select("job_id", *[c.alias(n) for n, c in text.keyword_flags("t").items()])


@query("desc_words", f"""
SELECT job_id, words, round(ln(1 + words), 6) AS log_words
FROM (SELECT job_id, {sql.word_count('description_clean')} AS words FROM jobs)""")
def desc_words(spark, sf):
    counted = stages.jobs(spark, sf).select("job_id", text.word_count("description_clean").alias("words"))
    return counted.withColumn("log_words", F.round(F.log1p("words"), 6))


_FEATURES = f"""SELECT job_id, variant, text, round(log_desc_words, 6) AS log_desc_words, years_required,
{', '.join(fixed.KEYWORD_FLAGS)}, array_to_string(skills, '|') AS skills, skill_count FROM features"""


def _features_out(df):
    out = df.withColumn("log_desc_words", F.round("log_desc_words", 6))
    return out.withColumn("skills", F.concat_ws("|", skills.skill_names("skill_ids"))).drop("skill_ids")


@query("build_features", _FEATURES)
def build_features(spark, sf):
    return _features_out(features.build_features(spread(stages.jobs(spark, sf), "job_id")))


@query("feature_variant", _FEATURES + " WHERE variant = 'without_title'")
def feature_variant(spark, sf):
    return _features_out(stages.features(spark, sf).where("variant = 'without_title'"))


@query("tokenize", f"SELECT doc_id, array_to_string({sql.tokens('text')}, ' ') AS tokens FROM documents")
def tokenize(spark, sf):
    docs = spread(spark.read.parquet(f"{sf}/documents.parquet"))
    return docs.select("doc_id", F.concat_ws(" ", text.tokens("text")).alias("tokens"))


@query("stopwords_removed", f"""
SELECT job_id, array_to_string({sql.stop_filter('w', CLUSTER_STOP)}, ' ') AS tokens
FROM (SELECT job_id, {sql.tokens('text')} AS w FROM cluster_texts)""")
def stopwords_removed(spark, sf):
    split = text.with_terms(stages.cluster_texts(spark, sf), "text", "t", CLUSTER_STOP, ngrams=1)
    return split.select("job_id", F.concat_ws(" ", "t").alias("tokens"))


def term_tables(prefix: str, source: str, where: str, stop_words, min_df: int, max_df: float, max_features: int, token=None) -> None:
    """SQL tables <prefix>_counts, _vocab and _tfidf for the texts of a table."""
    words = f"regexp_extract_all(lower(text), {sql.q(token or sql.TOKEN)}, 1)"
    sql.TABLES.update({
        f"{prefix}_docs": f"SELECT * FROM {source} WHERE {where}",
        f"{prefix}_terms": f"""SELECT job_id, unnest(list_concat(w, {sql.bigrams('w')})) AS term
            FROM (SELECT job_id, {sql.stop_filter(words, stop_words)} AS w FROM {prefix}_docs)""",
        f"{prefix}_counts": f"SELECT job_id, term, count(*) AS tf FROM {prefix}_terms GROUP BY job_id, term",
        f"{prefix}_vocab": f"""SELECT term, df, ln((1 + n) / (1.0::DOUBLE + df)) + 1 AS idf FROM (
            SELECT term, count(*) AS df, sum(tf) AS cf, (SELECT count(*) FROM {prefix}_docs) AS n FROM {prefix}_counts GROUP BY term)
            WHERE df >= {min_df} AND df <= {max_df}::DOUBLE * n ORDER BY cf DESC, term LIMIT {max_features}""",
        f"{prefix}_tfidf": f"""SELECT job_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY job_id)) AS tfidf FROM (
            SELECT job_id, term, (1 + ln(tf)) * idf AS w FROM {prefix}_counts JOIN {prefix}_vocab USING (term))""",
    })


term_tables("model", "model_texts", "variant = 'with_title'", STOP, 5, 0.8, 20_000)
term_tables("role", "cluster_texts", "true", CLUSTER_STOP, 5, 0.5, 20_000)


@query("ngrams", "SELECT term, count(*) AS postings, CAST(sum(tf) AS BIGINT) AS occurrences FROM model_counts GROUP BY term")
def ngrams(spark, sf):
    texts = stages.features(spark, sf).where("variant = 'with_title'")
    counts = tfidf.term_counts(texts, "job_id", "text", STOP)
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("postings"), F.sum("tf").alias("occurrences"))


@query("tfidf", "SELECT job_id, term, round(tfidf, 6) AS tfidf FROM model_tfidf")
def tfidf_query(spark, sf):
    texts = stages.features(spark, sf).where("variant = 'with_title'")
    return tfidf.tfidf(texts, "job_id", "text", STOP).withColumn("tfidf", F.round("tfidf", 6))


@query("cluster_tfidf", "SELECT job_id, term, round(tfidf, 6) AS tfidf FROM role_tfidf")
def cluster_tfidf(spark, sf):
    out = tfidf.tfidf(stages.cluster_texts(spark, sf), "job_id", "text", CLUSTER_STOP, max_df=0.5)
    return out.withColumn("tfidf", F.round("tfidf", 6))


_NUM = features.NUMERIC
_TITLED = "FROM features WHERE variant = 'with_title'"


@query("impute_median", f"""
SELECT job_id, {', '.join(
    f"round(coalesce({c}::DOUBLE, (SELECT median({c}) {_TITLED})), 6) AS {c}, CAST({c} IS NULL AS INTEGER) AS {c}_missing" for c in _NUM
)} {_TITLED}""")
def impute_median(spark, sf):
    out = features.impute_median(stages.features(spark, sf).where("variant = 'with_title'"), _NUM)
    return out.withColumns({c: F.round(c, 6) for c in _NUM})


@query("standardize", f"""
SELECT job_id, {', '.join(
    f"round(({c} - (SELECT avg({c}) {_TITLED})) / (SELECT stddev_pop({c}) {_TITLED}), 6) AS {c}" for c in ("log_desc_words", "skill_count")
)} {_TITLED}""")
def standardize(spark, sf):
    columns = ["log_desc_words", "skill_count"]
    out = features.standardize(stages.features(spark, sf).where("variant = 'with_title'"), columns)
    return out.withColumns({c: F.round(c, 6) for c in columns})


@query("balanced_weights", """
SELECT job_id, seniority, round((SELECT count(*) FROM labelled)::DOUBLE
    / ((SELECT count(DISTINCT seniority) FROM labelled) * count(*) OVER (PARTITION BY seniority)), 6) AS weight FROM labelled""")
def balanced_weights(spark, sf):
    out = features.with_balanced_weight(stages.labelled(spark, sf), "seniority", fixed.CLASSES)
    return out.select("job_id", "seniority", F.round("weight", 6).alias("weight"))


@query("group_key", 'SELECT job_id, "group", seniority FROM labelled')
def group_key(spark, sf):
    return stages.labelled(spark, sf).select("job_id", "group", "seniority")


sql.TABLES.update({
    "class_totals": """SELECT seniority, count(*) AS total, row_number() OVER (ORDER BY count(*),
        CASE seniority WHEN 'Entry' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END) AS rarity FROM labelled GROUP BY seniority""",
    "group_cells": """SELECT "group", count(*) AS size,
        floor(log2(1 + count(*) FILTER (WHERE rarity = 1))) AS m1, floor(log2(1 + count(*) FILTER (WHERE rarity = 2))) AS m2,
        floor(log2(1 + count(*) FILTER (WHERE rarity = 3))) AS m3
        FROM labelled JOIN class_totals USING (seniority) GROUP BY "group" """,
    "group_folds": """SELECT "group", CAST(CASE WHEN (place // 5) % 2 = 0 THEN place % 5 ELSE 4 - place % 5 END AS INTEGER) AS fold
        FROM (SELECT "group", row_number() OVER (ORDER BY m1 DESC, m2 DESC, m3 DESC,
            CAST('0x' || substr(md5("group"), 1, 8) AS BIGINT) % 1024, size DESC, "group") - 1 AS place FROM group_cells)""",
    "folded": 'SELECT l.*, f.fold FROM labelled l JOIN group_folds f USING ("group")',
})


@query("group_folds", 'SELECT "group", fold FROM group_folds')
def group_folds(spark, sf):
    return folds.assign_group_folds(stages.labelled(spark, sf), "group", "seniority", fixed.CLASSES)


@query("fold_leak_check", 'SELECT "group", min(fold) AS first, max(fold) AS last FROM folded GROUP BY "group" HAVING min(fold) <> max(fold)')
def fold_leak_check(spark, sf):
    return folds.leaks(stages.folded(spark, sf), "group")


@query("fold_balance", """
SELECT fold, count(*) AS rows, count(*) FILTER (WHERE seniority = 'Entry') AS "Entry",
    count(*) FILTER (WHERE seniority = 'Mid') AS "Mid", count(*) FILTER (WHERE seniority = 'Senior') AS "Senior",
    round(count(*)::DOUBLE / (SELECT count(*) FROM folded), 6) AS share FROM folded GROUP BY fold""")
def fold_balance(spark, sf):
    return folds.balance(stages.folded(spark, sf), "seniority", fixed.CLASSES)
