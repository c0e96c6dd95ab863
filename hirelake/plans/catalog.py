"""Imports every module that registers queries, and holds the flagship query."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions import skills
from hirelake.operators import cleaning, marts
from hirelake.plans import (  # noqa: F401
    cleaning_queries,
    evaluation_queries,
    fact_queries,
    feature_queries,
    mart_queries,
    model_queries,
    stages,
)
from hirelake.plans.registry import query
from hirelake.sources.stages import materialize


@query("skills_by_level_from_raw", mart_queries.BY_LEVEL_SQL)
def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Share of each seniority level's postings that mention each of the top skills, from raw
    postings on: filter, clean, deduplicate, match, write the narrow result, aggregate it."""
    kept = cleaning.deduped_postings(stages.raw(spark, sf))
    texts = kept.select(
        "job_id",
        cleaning.map_seniority("formatted_experience_level").alias("seniority"),
        F.concat_ws(" ", "title", "description_clean").alias("text"),
    )
    matched = skills.with_skill_ids(texts, "text").select("job_id", "seniority", "skill_ids")
    return mart_queries.rounded_levels(marts.skills_by_level(materialize(matched, "matched")))
