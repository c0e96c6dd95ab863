"""Facts that hold for any fitted model, as rows SQL can state: what is predicted, for whom, and how it hangs together."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from hirelake.functions import fixed
from hirelake.operators import attributions
from hirelake.plans import model_queries as m
from hirelake.plans import stages
from hirelake.plans.registry import query

CLASSES = fixed.CLASSES
P = [f"p_{c}" for c in CLASSES]
TESTED = "SELECT job_id, seniority AS actual, TRUE AS sums_to_one, TRUE AS pred_is_largest FROM folded WHERE fold = 0"


def _facts(predicted):
    total, most = sum((F.col(p) for p in P[1:]), F.col(P[0])), F.greatest(*P)
    own = F.coalesce(*[F.when(F.col("pred") == c, F.col(p)) for c, p in zip(CLASSES, P)])
    return predicted.select("job_id", "actual", (F.abs(total - 1) < 1e-9).alias("sums_to_one"), (own == most).alias("pred_is_largest"))


@query("logreg_facts", TESTED)
def logreg_facts(spark, sf):
    return _facts(m.logreg_predict(spark, sf))


@query("gbt_facts", TESTED)
def gbt_facts(spark, sf):
    return _facts(m.gbt_predict(spark, sf))


def _no_feature_twice(attributions):
    """Class and feature as one number: distinct numbers are found by hashing, distinct structs by comparing each with each."""
    once = F.array_distinct(F.transform(attributions, lambda x: x["class"].cast("bigint") * 2**32 + x["feature"]))
    return F.size(once) == F.size(attributions)


@query("attribution_facts", "SELECT job_id, TRUE AS adds_up, TRUE AS no_feature_twice FROM folded WHERE fold = 0")
def attribution_facts(spark, sf):
    """Of every test posting, base and attributions add up to the margin of each class."""
    told = m.attributed_test(spark, sf)
    apart = F.zip_with("rawPrediction", attributions.margin_of("attributions", m.explainer(spark, sf)), lambda a, b: F.abs(a - b))
    return told.select("job_id", (F.array_max(apart) < 1e-9).alias("adds_up"), _no_feature_twice("attributions").alias("no_feature_twice"))


@query("svm_facts", "SELECT job_id, seniority AS actual, TRUE AS known_class FROM folded WHERE fold = 0")
def svm_facts(spark, sf):
    return m.svm_predict(spark, sf).select("job_id", "actual", F.col("pred").isin(*CLASSES).alias("known_class"))


@query("saved_model_facts", "SELECT job_id, TRUE AS same FROM raw_postings")
def saved_model_facts(spark, sf):
    """A stored model predicts what the live one does."""
    live = m.fitted(spark, sf, "Logistic Regression").transform(m._to_score(spark, sf))
    stored = m.saved_model(spark, sf).select("job_id", F.col("pred").alias("stored"), F.col(P[1]).alias("p"))
    same = (F.col("pred") == F.col("stored")) & (F.abs(F.col(P[1]) - F.col("p")) < 1e-9)
    return live.join(stored, "job_id").select("job_id", same.alias("same"))


@query("score_stream_facts", "SELECT job_id, TRUE AS same FROM raw_postings")
def score_stream_facts(spark, sf):
    """Arriving files are scored as the table is."""
    columns = [c for c in m.score_batch(spark, sf).columns if c != "job_id" and not c.startswith("p_")]
    batch = m.score_batch(spark, sf).select("job_id", F.struct(*columns).alias("batch"))
    stream = m.score_stream(spark, sf).select("job_id", F.struct(*columns).alias("stream"))
    return batch.join(stream, "job_id").select("job_id", F.col("batch").eqNullSafe(F.col("stream")).alias("same"))


@query("kmeans_facts", "SELECT job_id, TRUE AS nearest, TRUE AS unit_length FROM jobs")
def kmeans_facts(spark, sf):
    """Every posting is in the cluster of its nearest centre; its coordinates have unit length, or are zero without known words."""
    model = m.roles(spark, sf)
    z = model.kmeans.transform(model.vectors(stages.cluster_texts(spark, sf)))
    z = z.select("job_id", "cluster", vector_to_array("z").alias("z"))
    distances = F.array(*[
        F.aggregate(F.zip_with("z", F.lit([float(x) for x in c]), lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
        for c in model.kmeans.clusterCenters()
    ])
    length = F.aggregate("z", F.lit(0.0), lambda s, x: s + x * x)
    own = F.element_at(distances, F.col("cluster") + 1)
    return z.select("job_id", (own <= F.array_min(distances) + 1e-9).alias("nearest"), ((F.abs(length - 1) < 1e-9) | (length == 0)).alias("unit_length"))


@query("cluster_facts", f"SELECT count(*) AS postings, CAST({fixed.ROLE_CLUSTERS} AS BIGINT) AS clusters FROM jobs")
def cluster_facts(spark, sf):
    sizes = m.cluster_sizes(spark, sf)
    return sizes.agg(F.sum("size").alias("postings"), F.count(F.lit(1)).alias("clusters"))


@query("cv_facts", f"SELECT unnest({list(m.SETTINGS)}) AS model, CAST({fixed.CV_FOLDS} AS BIGINT) AS folds, TRUE AS scores_in_range")
def cv_facts(spark, sf):
    """Every classifier is scored on every fold."""
    inside = F.col("macro_f1").between(0, 1) & F.col("balanced_accuracy").between(0, 1)
    return m.compared(spark, sf).select("model", "folds", inside.alias("scores_in_range"))
