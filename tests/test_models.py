import numpy as np
import pytest
from conftest import values
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import clustering, features, lsa, models, recommend, scoring, tfidf, training
from hirelake.plans import model_queries
from hirelake.sources import files
from hirelake.sources.stages import materialize
from hirelake.streaming import scoring as stream_scoring

POSTINGS = [
    ("Senior Platform Developer", "You lead our backend group and mentor newcomers. At least 8 years of experience running Python services on AWS infrastructure.", "Senior"),
    ("Junior Frontend Developer", "A first job after school. 1 year of experience writing JavaScript and React pages with patient teammates around you.", "Entry"),
    ("Analytics Engineer", "Keep nightly Spark and SQL jobs healthy with Airflow. 4 years of experience shaping warehouse tables and reports.", "Mid"),
    ("Intern", "A paid internship over the summer where students try SQL and Excel on small tasks with daily help.", "Entry"),
    ("Director of Analytics", "You lead three departments and own the roadmap for machine learning. 11 years of experience or more is expected.", "Senior"),
    ("Network Engineer", "Look after Cisco switches, firewalls and VMware hosts in two sites. 5 years of experience with routing problems.", "Mid"),
]


@pytest.fixture(scope="module")
def postings(spark):
    rows = [(i, p[0], f"{p[1]} Batch {'xyz'[i % 3]} number {i}.", f"Company {i % 17}", p[2]) for i in range(120) for p in [POSTINGS[i % 6]]]
    df = spark.createDataFrame(rows, "job_id long, title string, description string, company_name string, seniority string")
    return materialize(df.withColumn("group", F.col("company_name")), "postings")


@pytest.fixture(scope="module")
def rows(postings):
    made = features.build_features(postings, description="description", variants=("with_title",))
    return materialize(made.join(postings.select("job_id", "seniority", "group"), "job_id"), "rows")


@pytest.fixture(scope="module")
def seniority(rows):
    return models.fit(rows, "Logistic Regression", {"max_features": 300, "max_iter": 30}, min_df=2)


@pytest.fixture(scope="module")
def roles(spark, postings):
    from hirelake.functions import text

    texts = postings.select("job_id", text.cluster_text("title", "description", "company_name").alias("text"))
    return clustering.fit_roles(texts, k=6, dims=8, min_df=2, inits=3, signatures={"Networks": "network", "Interns": "intern"})


def test_vector_form_equals_long_form(spark, rows):
    model = models.fit_tfidf(rows, "job_id", "text", min_df=2, max_features=200)
    terms = models.vocabulary_of(model)
    out = model.transform(rows).select("job_id", F.unwrap_udt("tfidf").alias("v"))
    vectors = {(r.job_id, terms[i]): x for r in out.collect() for i, x in zip(r.v.indices, r.v["values"])}
    long = tfidf.tfidf(rows, "job_id", "text", fixed.ENGLISH_STOP_WORDS, min_df=2, max_features=200)
    expected = {(r.job_id, r.term): r.tfidf for r in long.collect()}
    assert vectors == pytest.approx(expected) and len(expected) > 1000


def test_numbers_are_imputed_and_scaled(spark):
    df = spark.createDataFrame([(1.0, 5), (None, 5), (3.0, 5), (8.0, 5)], "a double, b int")
    stage, names = models.fit_numeric(df, ["a", "b"])
    assert names == ["a_z", "a_missing_z", "b_z"]
    out = stage.transform(df).select(*names).toPandas()
    filled = np.array([1, 3, 3, 8.0])
    assert out["a_z"].tolist() == pytest.approx(((filled - filled.mean()) / filled.std()).tolist())
    assert out["a_missing_z"].std(ddof=0) == pytest.approx(1) and out["b_z"].abs().max() == 0


def test_classifiers_learn_and_balance(spark, rows, seniority):
    scored = seniority.predict(rows, ("seniority",)).withColumnRenamed("seniority", "actual")
    macro, balanced = models.macro_f1_and_balanced(scored, fixed.CLASSES)
    assert macro > 0.95 and balanced > 0.95
    assert scored.where(F.abs(F.col("p_Entry") + F.col("p_Mid") + F.col("p_Senior") - 1) > 1e-9).count() == 0
    svm = models.fit(rows, "Linear SVM", {"max_features": 300, "max_iter": 10}, min_df=2).predict(rows, ("seniority",))
    assert "p_Mid" not in svm.columns and svm.where("pred = seniority").count() > 110
    trees = models.fit(rows, "Boosted Trees", {"max_features": 50, "max_depth": 2, "rounds": 3}, min_df=2).predict(rows, ("seniority",))
    assert trees.where("pred = seniority").count() > 110
    assert trees.where(F.abs(F.col("p_Entry") + F.col("p_Mid") + F.col("p_Senior") - 1) > 1e-9).count() == 0


def test_cross_validation_and_grid(rows):
    train = materialize(models.with_cv_folds(rows, n_folds=2), "cv")
    quick = {"max_features": 100, "max_iter": 5}
    tried = models.grid_search(train, "Logistic Regression", {"C": [0.001, 3.0]}, quick, n_folds=2, parallelism=2, min_df=2).collect()
    means = {r["place"]: r["macro_f1"] for r in tried}
    assert len(tried) == 2 and means[1] >= means[2] and all(r["folds"] == 2 for r in tried)
    scores = models.fold_scores(train, [("Logistic Regression", quick)], n_folds=2, parallelism=2, min_df=2)
    of_folds = [r["value"] for r in scores.where("metric = 'macro_f1'").collect()]
    compared = models.ranked(scores).first()
    assert compared["macro_f1"] == pytest.approx(np.mean(of_folds)) and compared["macro_f1_spread"] == pytest.approx(np.std(of_folds))
    assert compared["macro_f1"] > 0.5 and models.best_params(models.ranked(scores)) == ("Logistic Regression", quick)


def test_grid_query_tries_the_whole_grid_of_the_winner(spark, monkeypatch):
    first, asked = spark.createDataFrame([("Linear SVM", "{}", 1)], "model string, params string, place int"), []
    monkeypatch.setattr(model_queries, "compared", lambda *_: first)
    monkeypatch.setattr(model_queries, "_train", lambda *_: None)
    monkeypatch.setattr(models, "fold_scores", lambda train, tries, **_: asked.extend(tries) or spark.createDataFrame([], models.SCORES))
    model_queries.grid_search(spark, "")
    grid = fixed.CLASSIFIER_GRIDS["Linear SVM"]
    assert asked == [("Linear SVM", {"C": c, "max_features": n}) for c in grid["C"] for n in grid["max_features"]]


def test_queries_fit_with_the_full_settings():
    asked = {n: ({**models.CANDIDATES[n].params, **s}, s.get("max_features", models.CANDIDATES[n].max_features)) for n, s in model_queries.SETTINGS.items()}
    assert asked == {n: (s, fixed.MAX_TERMS[n]) for n, s in fixed.CLASSIFIER_SETTINGS.items()}


def test_limit_of_passes_is_told(rows):
    with pytest.warns(UserWarning, match="without having converged"):
        models.fit(rows, "Logistic Regression", {"max_features": 100, "max_iter": 1}, min_df=2)


def test_whole_training_run(spark, postings, tmp_path):
    made = features.build_features(postings, description="description").join(postings.select("job_id", "seniority", "group"), "job_id")
    company = F.substring("group", 9, 2).cast("int")
    marked = materialize(made.withColumn("fold", F.when(company < 4, 0).otherwise(1)).withColumn("cv_fold", company % 2), "run", ("variant",))
    variants = {v: marked.where(F.col("variant") == v).drop("variant") for v in features.VARIANTS}
    quick = {"max_features": 100, "max_iter": 20}
    run = training.train(variants, {"Logistic Regression": quick}, {"C": [0.001, 3.0]}, n_folds=2, min_df=2)
    assert run.name == "Logistic Regression" and set(run.fitted) == set(features.VARIANTS)
    assert run.params["C"] == models.best_params(run.tuned)[1]["C"]
    run.store(str(tmp_path / "run"))
    stored = spark.read.parquet(str(tmp_path / "run" / "predictions"))
    tested = variants["with_title"].where("fold = 0").count()
    assert {r["variant"]: r["count"] for r in stored.groupBy("variant").count().collect()} == dict.fromkeys(features.VARIANTS, tested)
    sections = {r["section"] for r in spark.read.parquet(str(tmp_path / "run" / "metrics")).select("section").distinct().collect()}
    assert sections == {"split", "baseline", "comparison", "tuning", "test"}
    other = spark.createDataFrame([("clusters", "all", "k", "", 10.0)], training.METRICS)
    training.store_metrics(other, str(tmp_path / "run" / "metrics"))
    merged = training.metrics_document(spark.read.parquet(str(tmp_path / "run" / "metrics")))
    assert {r["section"] for r in merged.collect()} == sections | {"clusters"}
    loaded = models.SeniorityModel.load(str(tmp_path / "run" / "model" / "without_title"))
    assert loaded.include_title is False
    mixed = {v: df.withColumn("fold", F.lit(1) * (F.col("job_id") % 2)) for v, df in variants.items()}
    with pytest.raises(ValueError):
        training.train(mixed, {"Logistic Regression": quick}, n_folds=2, min_df=2)


def test_feature_push_names_telling_terms(rows, seniority):
    top = models.feature_push(seniority, rows, top=15)
    assert top.count() == 45
    senior = values(top.where("class = 'Senior'"), "feature")
    assert {"lead", "kw_lead"} & set(senior) and not any(f.endswith("_z") for f in senior)


def test_saved_model_takes_raw_postings(spark, postings, seniority, tmp_path):
    seniority.save(str(tmp_path / "m"))
    loaded = models.SeniorityModel.load(str(tmp_path / "m"))
    raw = postings.select("job_id", "title", "description", "company_name")
    before = {r.job_id: r for r in seniority.transform(raw).collect()}
    for r in loaded.transform(raw).collect():
        assert r.pred == before[r.job_id].pred and r.p_Mid == pytest.approx(before[r.job_id].p_Mid)
    direct = loaded.pipeline().transform(raw)
    assert direct.select("prediction").count() == 120


def test_svd_equals_numpy(spark):
    from hirelake.functions.vectors import sparse_vector

    rng = np.random.default_rng(0)
    a = rng.random((60, 4)) @ rng.random((4, 25)) * (rng.random((60, 25)) < 0.6)
    data = [(i, [int(j) for j in np.flatnonzero(a[i])], [float(x) for x in a[i][a[i] != 0]]) for i in range(60)] + [(60, [], [])]
    df = spark.createDataFrame(data, "i int, indices array<int>, v array<double>").repartition(5)
    sparse = materialize(df.select("i", sparse_vector(F.lit(25), F.col("indices"), F.col("v")).alias("f")), "svd")
    v = lsa.fit(sparse, "f", 25, dims=5, passes=8)
    _, s, vt = np.linalg.svd(a, full_matrices=False)
    assert np.abs(v.T @ vt[:5].T) == pytest.approx(np.eye(5), abs=1e-6)
    assert np.linalg.norm(a @ v, axis=0) == pytest.approx(s[:5])
    z = {r.i: r.z for r in sparse.select("i", lsa.projected(spark, v, "f", normalize=False).alias("z")).collect()}
    assert np.array([z[i] for i in range(60)]) == pytest.approx(a @ v) and z[60] == [0.0] * 5
    chunk = lsa.CHUNK
    try:
        lsa.CHUNK = 7  # many small chunks give the same result
        assert np.abs(lsa.fit(sparse, "f", 25, dims=5, passes=8).T @ vt[:5].T) == pytest.approx(np.eye(5), abs=1e-6)
    finally:
        lsa.CHUNK = chunk


def test_roles_find_the_groups(spark, postings, roles, tmp_path):
    from hirelake.functions import text

    texts = postings.select("job_id", text.cluster_text("title", "description", "company_name").alias("text"))
    assigned = roles.transform(texts).join(postings.select("job_id", "title"), "job_id")
    assert assigned.groupBy("title").agg(F.count_distinct("cluster").alias("n")).where("n > 1").count() == 0
    assert assigned.select("cluster").distinct().count() == 6
    assert {"Networks", "Interns"} <= set(roles.names) and 0 < roles.explained_variance <= 1 + 1e-9
    roles.save(str(tmp_path / "r"))
    again = clustering.RoleModel.load(str(tmp_path / "r"))
    assert sorted(values(again.transform(texts), "job_id", "cluster_name")) == sorted(values(assigned, "job_id", "cluster_name"))
    lengths = roles.vectors(texts).select(F.aggregate(vector_to_array("z"), F.lit(0.0), lambda x, y: x + y * y).alias("n"))
    assert lengths.where("abs(n - 1) > 1e-9").count() == 0
    scan = clustering.scan_k(roles.vectors(texts).cache(), range(2, 4), inits=1)
    assert [r["k"] for r in scan] == [2, 3] and scan[1]["inertia"] < scan[0]["inertia"]


def related_of(postings, roles):
    from hirelake.functions import skills, text

    texts = postings.select("job_id", text.cluster_text("title", "description", "company_name").alias("text"))
    found = skills.with_skill_ids(postings.select("job_id", "description"), "description").select("job_id", "skill_ids")
    return recommend.RelatedSkills(found.join(roles.transform(texts).select("job_id", "cluster"), "job_id"))


def test_scoring_gates_and_fields(spark, postings, seniority, roles):
    asked = spark.createDataFrame(
        [(1, "Engineer", ""), (2, "Engineer", "   "), (3, "Engineer", "Writes Python for us"), (4, None, None),
         (5, "Network Engineer", POSTINGS[5][1] + " A Cisco exam is welcome.")],
        "job_id long, title string, description string",
    )
    out = {r.job_id: r for r in scoring.score(asked, seniority, roles, related_of(postings, roles)).collect()}
    for i in (1, 2, 3, 4):
        assert out[i].seniority is None and out[i].role is None and out[i].warning == recommend.TOO_SHORT
    assert out[5].seniority == "Mid" and out[5].role == "Networks" and out[5].warning == recommend.UNRELIABLE
    assert {"Cisco", "Firewalls", "VMware"} <= set(out[5].skills)
    assert sum(out[5].probabilities.values()) == pytest.approx(1)
    assert scoring.score(asked, seniority, roles).select("related").where("related IS NOT NULL").count() == 0


def test_stream_scores_each_file_once(spark, postings, seniority, roles, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    raw = postings.select("job_id", "title", "description", "company_name")
    raw.where("job_id < 60").repartition(3).write.parquet(source)
    for _ in range(2):  # the second run finds nothing new
        stream_scoring.score_files(spark, source, sink, state, seniority, roles, files_per_batch=2).awaitTermination()
        assert stream_scoring.read_scores(spark, sink).count() == 60
    raw.where("job_id >= 60").write.mode("append").parquet(source)
    stream_scoring.score_files(spark, source, sink, state, seniority, roles).awaitTermination()
    scored = stream_scoring.read_scores(spark, sink)
    assert scored.count() == 120 and scored.select("job_id").distinct().count() == 120
    batch = {r.job_id: r.seniority for r in scoring.score(raw, seniority, roles).collect()}
    assert {r.job_id: r.seniority for r in scored.collect()} == batch


def test_stream_scores_a_file_on_all_cores(spark, postings, seniority, roles, tmp_path):
    source, sink, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    raw = postings.select("job_id", "title", "description", "company_name")
    raw.coalesce(1).write.parquet(source)
    stream_scoring.score_files(spark, source, sink, state, seniority, roles, files_per_batch=1).awaitTermination()
    assert len(list((tmp_path / "out" / "batch=0").glob("part-*.parquet"))) == spark.sparkContext.defaultParallelism > 1
    assert stream_scoring.read_scores(spark, sink).count() == raw.count()


def test_csv_keeps_line_breaks_quotes_and_missing(spark, tmp_path):
    path = tmp_path / "p.csv"
    path.write_text('extra,name,job_id,amount\n1,"two\nlines, ""quoted""",7,NA\n2,None,8,1.5\n3,  padded ,9,\n')
    out = files.read_csv(spark, str(path), ["job_id", "name", "amount"], {"job_id": "bigint", "amount": "double"})
    assert sorted(values(out, "job_id", "name", "amount")) == [(7, 'two\nlines, "quoted"', None), (8, None, 1.5), (9, "  padded ", None)]


def test_join_names(spark):
    links = spark.createDataFrame([(1, "b"), (1, "a"), (1, "a"), (2, "x"), (3, "n")], "job_id int, k string")
    names = spark.createDataFrame([("a", "Art"), ("b", "Biz"), ("n", None)], "k string, name string")
    assert values(files.join_names(links, names, "k", "name"), "job_id", "names") == [(1, "Art|Biz")]
    jobs = spark.createDataFrame([(1,), (9,)], "job_id int")
    assert sorted(values(files.attach_names(jobs, links, names, "k", "name", "cats"), "job_id", "cats")) == [(1, "Art|Biz"), (9, None)]
