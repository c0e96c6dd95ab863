"""The chain of written tables every report reads: raw -> deduped -> jobs -> skills -> features."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import fixed, skills, text
from hirelake.operators import cleaning, marts
from hirelake.operators.features import build_features, group_key
from hirelake.operators.folds import assign_group_folds, with_folds
from hirelake.plans import postings
from hirelake.session import spread
from hirelake.sources import files
from hirelake.sources.stages import STORE

CLUSTERS = 10


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return postings.raw_postings(spark, sf)


def with_names(spark: SparkSession, sf: str, df: DataFrame) -> DataFrame:
    """Add skill_categories and industries, the joined names of two link tables.

    Links of other postings, most of them, are dropped before names are gathered.
    """
    ids = postings.table(spark, sf, "documents").select(F.col("doc_id").alias("job_id"))

    def of_postings(links: DataFrame) -> DataFrame:
        return links.join(ids, "job_id", "left_semi")

    out = files.attach_names(
        df, of_postings(postings.job_skill_links(spark, sf)), postings.skill_mapping(spark, sf),
        "skill_abr", "skill_name", "skill_categories",
    )
    return files.attach_names(
        out, of_postings(postings.job_industry_links(spark, sf)), postings.industry_mapping(spark, sf),
        "industry_id", "industry_name", "industries",
    )


def deduped(spark: SparkSession, sf: str) -> DataFrame:
    return STORE.get(spark, sf, "deduped", lambda: cleaning.deduped_postings(raw(spark, sf), attach=lambda df: with_names(spark, sf, df)))


def jobs(spark: SparkSession, sf: str) -> DataFrame:
    return STORE.get(spark, sf, "jobs", lambda: cleaning.finish_postings(deduped(spark, sf)))


def job_skills(spark: SparkSession, sf: str) -> DataFrame:
    """job_id, skill_ids: the skills of title and description, as dictionary positions."""

    def build() -> DataFrame:
        texts = spread(jobs(spark, sf), "job_id").select("job_id", F.concat_ws(" ", "title", "description_clean").alias("text"))
        return skills.with_skill_ids(texts, "text").select("job_id", "skill_ids")

    return STORE.get(spark, sf, "job_skills", build)


def clusters(spark: SparkSession, sf: str) -> DataFrame:
    """A stand-in role assignment that needs no trained model: job_id modulo 10."""
    return jobs(spark, sf).select("job_id", (F.col("job_id") % CLUSTERS).cast("int").alias("cluster"))


def jobs_with_cluster(spark: SparkSession, sf: str) -> DataFrame:
    return jobs(spark, sf).withColumn("cluster", (F.col("job_id") % CLUSTERS).cast("int"))


def cluster_texts(spark: SparkSession, sf: str) -> DataFrame:
    def build() -> DataFrame:
        wide = spread(jobs(spark, sf).select("job_id", "title", "description_clean", "company_name"), "job_id")
        return wide.select("job_id", text.cluster_text("title", "description_clean", "company_name").alias("text"))

    return STORE.get(spark, sf, "cluster_texts", build)


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Both feature variants, one folder per variant."""
    return STORE.get(spark, sf, "features", lambda: build_features(spread(jobs(spark, sf), "job_id")), ("variant",))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    known = jobs(spark, sf).where("seniority IS NOT NULL")
    return known.select(
        "job_id", "title", "company_name", "description_clean", "seniority", group_key("company_name", "job_id").alias("group")
    )


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return with_folds(labelled(spark, sf), "group", "seniority", fixed.CLASSES)


def mart(spark: SparkSession, sf: str) -> DataFrame:
    """The serving mart, written with its cluster and skill ids."""
    return STORE.get(
        spark, sf, "mart", lambda: marts.serving_mart(jobs(spark, sf), job_skills(spark, sf), clusters(spark, sf))
    )


ENTRY_TITLE = "Intern|Technician"
SENIOR_TITLE = "Senior|Director|Architect"


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Test rows (fold 0) with a class and class probabilities from a rule on title words."""
    ruled = folded(spark, sf).where("fold = 0").select(
        "job_id", "title", "company_name", "description_clean", F.col("seniority").alias("actual"),
        F.when(F.col("title").rlike(ENTRY_TITLE), "Entry").when(F.col("title").rlike(SENIOR_TITLE), "Senior").otherwise("Mid").alias("pred"),
        (F.lit(0.5) + (F.col("job_id") % 40) / 100.0).alias("conf"),
    )
    classes = fixed.CLASSES
    return ruled.withColumns({
        f"p_{c}": F.when(F.col("pred") == c, F.col("conf"))
        .when(F.col("pred") == classes[i - 1], (1 - F.col("conf")) * 0.6)
        .otherwise((1 - F.col("conf")) * 0.4)
        for i, c in enumerate(classes)
    })


def role_names(spark: SparkSession) -> DataFrame:
    rows = [(i, name, term) for i, (name, term) in enumerate(fixed.ROLE_SIGNATURES.items())]
    return spark.createDataFrame(rows, "cluster int, name string, signature string")


def training(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled feature rows with group, fold, and for training rows their fold among themselves."""

    def build() -> DataFrame:
        rows = STORE.get(spark, sf, "folded", lambda: folded(spark, sf).select("job_id", "seniority", "group", "fold"))
        inner = assign_group_folds(rows.where("fold <> 0"), "group", "seniority", fixed.CLASSES, fixed.CV_FOLDS)
        marked = rows.join(inner.withColumnRenamed("fold", "cv_fold"), "group", "left")
        return features(spark, sf).join(marked, "job_id")

    return STORE.get(spark, sf, "training", build, ("variant",))
