"""Queries that fit models, and the round trips of stored tables and models.

Classifiers and role clusters run with the full settings of `fixed`.
"""

import uuid

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hirelake.functions import fixed, skills
from hirelake.operators import attributions, clustering, evaluation, features, lsa, models, recommend, scoring
from hirelake.plans import stages
from hirelake.plans.feature_queries import CLUSTER_STOP
from hirelake.plans.registry import query
from hirelake.session import work_dir
from hirelake.sources import files
from hirelake.streaming import scoring as stream_scoring

CLASSES = fixed.CLASSES
#: Changes to the settings of `fixed`, for each classifier that is compared: none.
SETTINGS = {"Logistic Regression": {}, "Linear SVM": {}, "Boosted Trees": {}}
_FITTED: dict[tuple, object] = {}


def _once(spark, sf, name, make):
    """Fitted models shared by the queries of one session."""
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _FITTED:
        _FITTED[key] = make()
    return _FITTED[key]


def _path(spark, name: str) -> str:
    return f"{work_dir(spark)}/hirelake/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def training_rows(spark, sf, variant: str = "with_title"):
    """Labelled feature rows of one variant with group, fold and the fold among training rows."""
    rows = stages.training(spark, sf).where(F.col("variant") == variant)
    return rows.drop("variant")


def _train(spark, sf, variant: str = "with_title"):
    return training_rows(spark, sf, variant).where("fold <> 0")


def _test(spark, sf, variant: str = "with_title"):
    return training_rows(spark, sf, variant).where("fold = 0")


def fitted(spark, sf, name: str, variant: str = "with_title") -> models.SeniorityModel:
    return _once(
        spark, sf, (name, variant),
        lambda: models.fit(_train(spark, sf, variant), name, SETTINGS[name], include_title=variant == "with_title"),
    )


def roles(spark, sf) -> clustering.RoleModel:
    return _once(
        spark, sf, "roles",
        lambda: clustering.fit_roles(
            stages.cluster_texts(spark, sf), stop_words=CLUSTER_STOP, signatures=fixed.ROLE_SIGNATURES
        ),
    )


def _predicted(spark, sf, name):
    test = _test(spark, sf)
    return fitted(spark, sf, name).predict(test, ("seniority",)).withColumnRenamed("seniority", "actual")


@query("feature_vector")
def feature_vector(spark, sf):
    prepared = models.fit_preprocessor(_train(spark, sf), max_features=fixed.MAX_TERMS["Logistic Regression"])
    vectors = prepared.model.transform(_test(spark, sf))
    v = F.unwrap_udt("features")
    return vectors.select("job_id", F.size(v["values"]).alias("values"), v["size"].alias("size"))


@query("logreg_predict")
def logreg_predict(spark, sf):
    return _predicted(spark, sf, "Logistic Regression")


@query("svm_predict")
def svm_predict(spark, sf):
    return _predicted(spark, sf, "Linear SVM")


@query("gbt_predict")
def gbt_predict(spark, sf):
    return _predicted(spark, sf, "Boosted Trees")


@query("predictions")
def predictions(spark, sf):
    test = _test(spark, sf).join(stages.labelled(spark, sf).select("job_id", "title", "company_name", "description_clean"), "job_id")
    out = fitted(spark, sf, "Logistic Regression").predict(test, ("title", "company_name", "description_clean", "seniority"))
    return out.withColumnRenamed("seniority", "actual").withColumn("variant", F.lit("with_title"))


def compared(spark, sf):
    return _once(spark, sf, "compared", lambda: models.compare_models(_train(spark, sf), SETTINGS, parallelism=fixed.CV_FOLDS))


@query("cv_compare")
def cv_compare(spark, sf):
    return compared(spark, sf)


@query("grid_search")
def grid_search(spark, sf):
    """The whole grid of the classifier that the comparison puts first."""
    name, params = models.best_params(compared(spark, sf))
    return models.grid_search(_train(spark, sf), name, fixed_params=params, parallelism=fixed.CV_FOLDS)


def _variant_scores(spark, sf):
    out = None
    for variant in features.VARIANTS:
        model = fitted(spark, sf, "Logistic Regression", variant)
        scored = model.predict(_test(spark, sf, variant), ("seniority",)).withColumnRenamed("seniority", "actual")
        one = evaluation.evaluate(scored).withColumn("variant", F.lit(variant))
        out = one if out is None else out.unionByName(one)
    return out


@query("title_ablation")
def title_ablation(spark, sf):
    return evaluation.compare_variants(_variant_scores(spark, sf))


@query("feature_push")
def feature_push(spark, sf):
    return models.feature_push(fitted(spark, sf, "Logistic Regression"), _test(spark, sf))


def explainer(spark, sf):
    return _once(spark, sf, "explainer", lambda: models.tree_explainer(fitted(spark, sf, "Boosted Trees"), _train(spark, sf)))


@query("tree_effects")
def tree_effects(spark, sf):
    """What pushes test postings towards each class in the boosted model."""
    return models.tree_effects(fitted(spark, sf, "Boosted Trees"), _test(spark, sf), explainer(spark, sf))


@query("tree_attributions")
def tree_attributions(spark, sf):
    """What each feature adds to the margin of each class, for every test posting."""
    told = attributed_test(spark, sf).select("job_id", F.inline("attributions"))
    names = fitted(spark, sf, "Boosted Trees").names
    return told.select("job_id", models.class_name("class", CLASSES).alias("class"), models.class_name("feature", names).alias("feature"), "value")


def attributed_test(spark, sf):
    model = fitted(spark, sf, "Boosted Trees")
    scored = model.classifier.transform(model.preprocess.transform(_test(spark, sf)))
    return attributions.attributed(scored, explainer(spark, sf))


@query("lsa_vectors")
def lsa_vectors(spark, sf):
    model = roles(spark, sf)
    z = model.vectors(stages.cluster_texts(spark, sf)).select("job_id", F.posexplode(vector_to_array("z")).alias("dim", "value"))
    return z.withColumn("explained_variance", F.lit(model.explained_variance))


@query("kmeans_assign")
def kmeans_assign(spark, sf):
    return roles(spark, sf).transform(stages.cluster_texts(spark, sf)).select("job_id", "cluster", "cluster_name")


@query("cluster_sizes")
def cluster_sizes(spark, sf):
    assigned = roles(spark, sf).transform(stages.cluster_texts(spark, sf))
    return assigned.groupBy("cluster", "cluster_name").agg(F.count(F.lit(1)).alias("size"))


@query("k_scan")
def k_scan(spark, sf):
    from hirelake.sources.stages import materialize

    vectors = materialize(roles(spark, sf).vectors(stages.cluster_texts(spark, sf)).select("z"), "k-scan")
    return spark.createDataFrame(clustering.scan_k(vectors, range(fixed.ROLE_RANGE[0], fixed.ROLE_RANGE[1] + 1)), "k int, inertia double, silhouette double")


# ---------------------------------------------------------------- scoring


def _to_score(spark, sf):
    return stages.raw(spark, sf).select("job_id", "title", "description", "company_name")


def related(spark, sf) -> recommend.RelatedSkills:
    """The reference postings carry the trained clusters, as the scored ones do."""

    def make():
        assigned = roles(spark, sf).transform(stages.cluster_texts(spark, sf)).select("job_id", "cluster")
        return recommend.RelatedSkills(stages.job_skills(spark, sf).join(assigned, "job_id"))

    return _once(spark, sf, "related", make)


def _flat(scored):
    return scored.select(
        "job_id", "words", "seniority", *[F.col("probabilities")[c].alias(f"p_{c}") for c in CLASSES], "role",
        F.concat_ws("|", "skills").alias("skills"),
        F.concat_ws("|", F.transform("related", lambda r: r["skill"])).alias("related"), "warning",
    )


@query("score_batch")
def score_batch(spark, sf):
    model = fitted(spark, sf, "Logistic Regression")
    return _flat(scoring.score(_to_score(spark, sf), model, roles(spark, sf), related(spark, sf)))


@query("score_stream")
def score_stream(spark, sf):
    source, sink, state = (_path(spark, n) for n in ("arriving", "scores", "stream-state"))
    _to_score(spark, sf).repartition(4).write.parquet(source)
    model = fitted(spark, sf, "Logistic Regression")
    running = stream_scoring.score_files(spark, source, sink, state, model, roles(spark, sf), related(spark, sf), files_per_batch=2)
    running.awaitTermination()
    return _flat(stream_scoring.read_scores(spark, sink))


@query("saved_model")
def saved_model(spark, sf):
    """A stored model, loaded again, scores raw postings."""
    path = _path(spark, "model")
    fitted(spark, sf, "Logistic Regression").save(path)
    loaded = models.SeniorityModel.load(path)
    return loaded.transform(_to_score(spark, sf))


# ---------------------------------------------------------------- sources and sinks


@query("src_csv_roundtrip", """
SELECT job_id, title, description, company_id, company_name, location, formatted_experience_level, formatted_work_type,
    remote_allowed, round(min_salary, 4) AS min_salary, round(med_salary, 4) AS med_salary, round(max_salary, 4) AS max_salary,
    pay_period, currency, listed_time, original_listed_time, round(views, 6) AS views, applies FROM raw_postings""")
def src_csv_roundtrip(spark, sf):
    path = _path(spark, "postings-csv")
    files.write_csv(stages.raw(spark, sf).drop("quality"), path)
    back = files.read_postings_csv(spark, path)
    money = {c: F.round(c, 4) for c in ("min_salary", "med_salary", "max_salary")}
    return back.withColumns({**money, "views": F.round("views", 6)})


@query("parquet_sink", "SELECT location_level, count(*) AS postings, count(salary_yearly) AS salaries FROM jobs GROUP BY location_level")
def parquet_sink(spark, sf):
    """The serving mart written as zstd Parquet, one folder per location level, and read back."""
    path = _path(spark, "mart-zstd")
    wide = files.as_sink_types(stages.mart(spark, sf))
    files.write_parquet(wide, path, "zstd", ("location_level",))
    back = spark.read.parquet(path)
    return back.groupBy("location_level").agg(F.count(F.lit(1)).alias("postings"), F.count("salary_yearly").alias("salaries"))


@query("skill_cache_refill", "SELECT job_id, CAST(len(skills) AS INTEGER) AS skill_count FROM job_skill_list")
def skill_cache_refill(spark, sf):
    """A stored skill table with a third of its postings missing is completed for those alone."""
    path = _path(spark, "skill-cache")
    jobs = stages.jobs(spark, sf)
    stages.job_skills(spark, sf).where("job_id % 3 <> 0").write.parquet(path)
    missing = jobs.join(spark.read.parquet(path), "job_id", "left_anti")
    texts = missing.select("job_id", F.concat_ws(" ", "title", "description_clean").alias("text"))
    skills.with_skill_ids(texts, "text").select("job_id", "skill_ids").write.mode("append").parquet(path)
    return spark.read.parquet(path).select("job_id", F.size("skill_ids").alias("skill_count"))


@query("metrics_document")
def metrics_document(spark, sf):
    """All metrics of a run as a long table, and the same as one JSON document."""
    scores = _variant_scores(spark, sf)
    entries = F.map_from_entries(F.sort_array(F.collect_list(F.struct(F.concat_ws(" ", "metric", "label"), "value"))))
    return scores.groupBy("variant").agg(F.to_json(entries).alias("metrics"))
