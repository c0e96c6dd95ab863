"""Evaluation, audit, recommendation and cluster queries that need no trained model.

Predictions come from a rule on title words and clusters from the posting number,
so the numbers can be checked in SQL.
"""

from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import clustering, evaluation, recommend, tfidf
from hirelake.plans import sql, stages
from hirelake.plans.feature_queries import CLUSTER_STOP
from hirelake.plans.postings import table
from hirelake.plans.registry import query

CLASSES = fixed.CLASSES

sql.TABLES["predictions"] = f"""SELECT *, {', '.join(
    f"CASE WHEN pred = '{c}' THEN conf WHEN pred = '{CLASSES[i - 1]}' THEN (1 - conf) * 0.6 ELSE (1 - conf) * 0.4 END AS p_{c}"
    for i, c in enumerate(CLASSES)
)} FROM (SELECT job_id, title, company_name, description_clean, seniority AS actual,
    CASE WHEN {sql.matches('title', stages.ENTRY_TITLE)} THEN 'Entry'
         WHEN {sql.matches('title', stages.SENIOR_TITLE)} THEN 'Senior' ELSE 'Mid' END AS pred,
    0.5::DOUBLE + (job_id % 40) / 100.0::DOUBLE AS conf FROM folded WHERE fold = 0)"""


def evaluation_sql(source: str) -> str:
    """metric, label, value for a table with columns actual and pred."""
    per = ", ".join(
        f"""count(*) FILTER (WHERE actual = '{c}' AND pred = '{c}')::DOUBLE AS h{i},
        count(*) FILTER (WHERE actual = '{c}')::DOUBLE AS s{i}, count(*) FILTER (WHERE pred = '{c}')::DOUBLE AS p{i}"""
        for i, c in enumerate(CLASSES)
    )
    k = range(len(CLASSES))

    def r(a: str, b: str) -> str:
        return f"coalesce({a} / nullif({b}, 0), 0)"

    measures = {
        "precision": [r(f"h{i}", f"p{i}") for i in k],
        "recall": [r(f"h{i}", f"s{i}") for i in k],
        "f1": [r(f"2 * h{i}", f"(s{i} + p{i})") for i in k],
    }
    rows = []
    for name, values in measures.items():
        rows += [(name, c, values[i]) for i, c in enumerate(CLASSES)]
        rows.append((name, "macro avg", f"({' + '.join(values)}) / 3"))
        rows.append((name, "weighted avg", r(f"({' + '.join(f'{v} * s{i}' for i, v in enumerate(values))})", "(s0 + s1 + s2)")))
    rows += [("support", c, f"s{i}") for i, c in enumerate(CLASSES)]
    rows.append(("accuracy", "all", r("(h0 + h1 + h2)", "(s0 + s1 + s2)")))
    rows.append(("balanced_accuracy", "all", r(f"({' + '.join(measures['recall'])})", "(sign(s0) + sign(s1) + sign(s2))")))
    rows.append(("macro_f1", "all", r(f"({' + '.join(measures['f1'])})", "(sign(s0 + p0) + sign(s1 + p1) + sign(s2 + p2))")))
    return f"WITH cells AS (SELECT {per} FROM {source}) " + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, '{c}' AS label, round({v}, 6) AS value FROM cells" for m, c, v in rows
    )


@query("evaluate_metrics", f"SELECT * FROM ({evaluation_sql('predictions')})")
def evaluate_metrics(spark, sf):
    return evaluation.evaluate(stages.predictions(spark, sf)).withColumn("value", F.round("value", 6))


@query("baseline_eval", f"""SELECT * FROM ({evaluation_sql('''(SELECT seniority AS actual, (SELECT seniority FROM folded
    WHERE fold <> 0 GROUP BY seniority ORDER BY count(*) DESC, seniority LIMIT 1) AS pred FROM folded WHERE fold = 0)''')})""")
def baseline_eval(spark, sf):
    folded = stages.folded(spark, sf)
    return evaluation.baseline(folded.where("fold <> 0"), folded.where("fold = 0"), "seniority").withColumn(
        "value", F.round("value", 6)
    )


_PER_PRED = ", ".join(f"""count(*) FILTER (WHERE actual = t.c AND pred = '{c}') AS "{c}" """ for c in CLASSES)
_CONFUSION = f"""SELECT t.c AS actual, {_PER_PRED} FROM (VALUES ('Entry'), ('Mid'), ('Senior')) AS t(c), predictions GROUP BY t.c"""


@query("confusion", _CONFUSION)
def confusion(spark, sf):
    return evaluation.confusion(stages.predictions(spark, sf))


_TOTAL = '("Entry" + "Mid" + "Senior")'


@query("confusion_norm", f"""SELECT actual, {', '.join(f'round(coalesce("{c}"::DOUBLE / nullif({_TOTAL}, 0), 0), 6) AS "{c}"' for c in CLASSES)}
FROM ({_CONFUSION})""")
def confusion_norm(spark, sf):
    out = evaluation.confusion_shares(stages.predictions(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in CLASSES})


@query("split_summary", f"""
SELECT CASE WHEN fold = 0 THEN 'test' ELSE 'train' END AS side, count(*) AS rows, count(DISTINCT "group") AS groups,
{', '.join(f"""count(*) FILTER (WHERE seniority = '{c}') AS "{c}" """ for c in CLASSES)} FROM folded GROUP BY 1""")
def split_summary(spark, sf):
    return evaluation.split_summary(stages.folded(spark, sf), "seniority", "group")


_CONFIDENCE = "greatest(p_Entry, p_Mid, p_Senior)"


@query("error_counts", f"""
SELECT actual, pred, count(*) AS count, round(avg({_CONFIDENCE}), 6) AS confidence,
    (SELECT round(avg(CAST(actual <> pred AS INTEGER)), 6) FROM predictions) AS error_rate
FROM predictions WHERE actual <> pred GROUP BY actual, pred""")
def error_counts(spark, sf):
    out = evaluation.error_counts(stages.predictions(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("confidence", "error_rate")})


@query("error_sample", f"""
SELECT job_id, title, actual, pred, round({_CONFIDENCE}, 2) AS confidence, substr(description_clean, 1, 160) || '...' AS snippet FROM (
    SELECT *, row_number() OVER (PARTITION BY actual, pred ORDER BY md5(CAST(job_id AS VARCHAR) || ':0'), job_id) AS rn
    FROM predictions WHERE actual <> pred) WHERE rn <= 4 ORDER BY actual, pred, rn LIMIT 20""")
def error_sample(spark, sf):
    return evaluation.error_sample(stages.predictions(spark, sf))


@query("residual_dups", """
SELECT count(*) FILTER (WHERE n > 1) AS groups, CAST(coalesce(sum(n) FILTER (WHERE n > 1), 0) AS BIGINT) AS rows FROM (
    SELECT count(*) AS n FROM predictions GROUP BY lower(title), lower(coalesce(company_name, '')))""")
def residual_dups(spark, sf):
    return evaluation.residual_duplicates(stages.predictions(spark, sf))


PREFIX = "the"


@query("prefix_share", f"""
SELECT round(coalesce(avg(CAST(starts_with(lower(description_clean), '{PREFIX}') AS INTEGER)) FILTER (WHERE actual <> pred), 0), 6) AS in_errors,
    round(avg(CAST(starts_with(lower(description_clean), '{PREFIX}') AS INTEGER)), 6) AS in_all FROM predictions""")
def prefix_share(spark, sf):
    out = evaluation.prefix_share(stages.predictions(spark, sf), PREFIX)
    return out.withColumns({c: F.round(c, 6) for c in out.columns})


@query("company_mention_rate", """
SELECT count(*) AS rows, round(avg(CAST(contains(lower(description_raw || ' ' || title), lower(location)) AS INTEGER)), 6) AS rate
FROM (SELECT title, description_raw, string_split(title, ' ')[1] AS location FROM jobs WHERE company_name IS NOT NULL)""")
def company_mention_rate(spark, sf):
    # The derived company names occur in no text, so the title's first word stands in for the name.
    texts = stages.jobs(spark, sf).where("company_name IS NOT NULL").select(
        F.concat_ws(" ", "description_raw", "title").alias("text"), F.split("title", " ")[0].alias("name")
    )
    return evaluation.company_mention_rate(texts, "text", "name").withColumn("rate", F.round("rate", 6))


@query("label_concentration", """
SELECT company_name, CAST(sum(n) AS BIGINT) AS n, arg_max(seniority, (n, -rarity)) AS label,
    round(max(n)::DOUBLE / sum(n), 6) AS share FROM (
    SELECT company_name, seniority, count(*) AS n, CASE seniority WHEN 'Entry' THEN 0 WHEN 'Mid' THEN 1 ELSE 2 END AS rarity
    FROM jobs WHERE seniority IS NOT NULL AND company_name IS NOT NULL GROUP BY company_name, seniority)
GROUP BY company_name HAVING sum(n) >= 10""")
def label_concentration(spark, sf):
    return evaluation.label_concentration(stages.jobs(spark, sf)).withColumn("share", F.round("share", 6))


# ---------------------------------------------------------------- recommendation and scoring gates


sql.TABLES["overlap"] = """SELECT a.job_id, b.job_id AS other, count(*) AS w FROM job_skill a
    JOIN jobs ja ON ja.job_id = a.job_id JOIN job_skill b ON b.skill = a.skill JOIN jobs jb ON jb.job_id = b.job_id
    WHERE ja.cluster = jb.cluster GROUP BY a.job_id, b.job_id
    UNION ALL SELECT a.job_id, b.job_id, 1 FROM jobs a JOIN jobs b ON a.cluster = b.cluster
    WHERE NOT EXISTS (SELECT 1 FROM job_skill s WHERE s.job_id = a.job_id)"""


@query("related_skills", """
SELECT job_id, skill, round(share, 6) AS share, CAST(rank AS INTEGER) AS rank FROM (
    SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY round(share, 12) DESC, skill) AS rank FROM (
        SELECT o.job_id, s.skill, sum(o.w)::DOUBLE / any_value(p.total) AS share
        FROM overlap o JOIN job_skill s ON s.job_id = o.other
        JOIN (SELECT job_id, count(*) AS pool, sum(w) AS total FROM overlap GROUP BY job_id) p ON p.job_id = o.job_id AND p.pool >= 20
        WHERE NOT EXISTS (SELECT 1 FROM job_skill f WHERE f.job_id = o.job_id AND f.skill = s.skill)
        GROUP BY o.job_id, s.skill) WHERE round(share, 12) >= 0.10) WHERE rank <= 6""")
def related_skills(spark, sf):
    mart = stages.mart(spark, sf).select("job_id", "cluster", "skill_ids")
    out = recommend.RelatedSkills(mart).transform(mart)
    return out.withColumn("share", F.round("share", 6))


@query("score_gates", f"""
SELECT doc_id, words, CASE WHEN described < {recommend.MIN_WORDS} THEN '{recommend.TOO_SHORT}'
    WHEN words < {recommend.LOW_CONFIDENCE_WORDS} THEN '{recommend.UNRELIABLE}' END AS warning
FROM (SELECT doc_id, {sql.word_count("source || ' ' || text")} AS words, {sql.word_count("text")} AS described FROM documents)""")
def score_gates(spark, sf):
    from hirelake.operators import scoring

    gated = scoring.with_gates(table(spark, sf, "documents"), "source", "text")
    return gated.select("doc_id", "words", "warning")


# ---------------------------------------------------------------- clusters given as labels


@query("l2_normalize", """
SELECT vec_id, CAST(i - 1 AS INTEGER) AS dim, round(embedding[i]::DOUBLE / sqrt(list_sum([x::DOUBLE * x::DOUBLE FOR x IN embedding])), 6) AS value
FROM (SELECT vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)""")
def l2_normalize(spark, sf):
    vectors = table(spark, sf, "embeddings")
    unit = vectors.select("vec_id", F.posexplode(clustering.l2_normalized("embedding")).alias("dim", "value"))
    return unit.withColumn("value", F.round("value", 6))


@query("silhouette_by_label", """
WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sizes AS (SELECT label AS other, count(*) AS n FROM e GROUP BY label),
sums AS (SELECT a.vec_id, a.label, b.label AS other, sum(list_distance(a.v, b.v)) AS total FROM e a, e b GROUP BY ALL),
means AS (SELECT vec_id, label, max(CASE WHEN label = other THEN n END) AS own,
    max(CASE WHEN label = other THEN total / greatest(n - 1, 1) END) AS a, min(CASE WHEN label <> other THEN total / n END) AS b
    FROM sums JOIN sizes USING (other) GROUP BY vec_id, label)
SELECT label, count(*) AS size, round(avg(CASE WHEN own = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) AS silhouette FROM means GROUP BY label""")
def silhouette_by_label(spark, sf):
    return clustering.silhouette(table(spark, sf, "embeddings"), "embedding", "label").withColumn("silhouette", F.round("silhouette", 6))


@query("inertia_by_label", """
SELECT label, CAST(count(DISTINCT vec_id) AS BIGINT) AS size, round(sum((v - m) * (v - m)), 6) AS inertia FROM (
    SELECT label, vec_id, v, avg(v) OVER (PARTITION BY label, i) AS m FROM (
        SELECT label, vec_id, i, embedding[i]::DOUBLE AS v FROM (
            SELECT *, unnest(generate_series(1, len(embedding))) AS i FROM embeddings)))
GROUP BY label""")
def inertia_by_label(spark, sf):
    return clustering.inertia(table(spark, sf, "embeddings"), "embedding", "label").withColumn("inertia", F.round("inertia", 6))


sql.TABLES["role_top_terms"] = """SELECT cluster, term, mean, rank FROM (
    SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY round(mean, 12) DESC, term) AS rank FROM (
        SELECT cluster, term, sum(tfidf) / any_value(size) AS mean FROM role_tfidf JOIN jobs USING (job_id)
        JOIN (SELECT cluster, count(*) AS size FROM jobs GROUP BY cluster) USING (cluster) GROUP BY cluster, term))
    WHERE rank <= 15"""


def _top_terms(spark, sf):
    weights = tfidf.tfidf(stages.cluster_texts(spark, sf), "job_id", "text", CLUSTER_STOP, max_df=0.5)
    return clustering.top_terms(weights, stages.clusters(spark, sf))


@query("cluster_top_terms", "SELECT cluster, term, round(mean, 6) AS mean, CAST(rank AS INTEGER) AS rank FROM role_top_terms")
def cluster_top_terms(spark, sf):
    return _top_terms(spark, sf).withColumn("mean", F.round("mean", 6))


_NAMES = ", ".join(f"({i}, {sql.q(n)}, {sql.q(s)})" for i, (n, s) in enumerate(fixed.ROLE_SIGNATURES.items()))


@query("cluster_name_check", f"""
SELECT cluster, name, signature FROM (VALUES {_NAMES}) AS n(cluster, name, signature)
WHERE NOT EXISTS (SELECT 1 FROM role_top_terms t WHERE t.cluster = n.cluster AND contains(t.term, n.signature))""")
def cluster_name_check(spark, sf):
    return clustering.failed_names(_top_terms(spark, sf), stages.role_names(spark))
