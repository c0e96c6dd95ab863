"""The postings view: raw postings derived from the given tables, in two dialects.

The given texts hold no job words, so titles, closing sentences, places and
levels are dealt out from short lists by arithmetic on the row's own columns.
`raw_postings` is the Spark form and `RAW_POSTINGS_SQL` the SQL form.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.functions.skills import SKILL_NAMES
from hirelake.functions import text
from hirelake.session import spread

TITLES = [
    "Senior Software Engineer", "Data Analyst", "Registered Nurse", "DevOps Engineer (Remote)",
    "Mechanical Engineer", "Help Desk Technician", "Director of Data Science", "Sales Engineer",
    "Cloud Architect", "Machine Learning Engineer", "Software Engineering Intern", "Accountant",
]
LEVELS = [
    "Internship", "Entry level", "Associate", "Mid-Senior level", "Mid-Senior level",
    "Mid-Senior level", "Director", "Executive", "Not Applicable",
]
LOCATIONS = [
    "Austin, TX", "Los Angeles, California, United States", "United States", "Texas",
    "Greater Seattle Area", "Seattle, wa", "New York, New York", "Washington, United States",
    "Nowhere, United States", "Dallas-Fort Worth Metroplex", "Dallas, TX", "Fort Worth, TX",
    "Toronto, Ontario, Canada", "Utah Area", "Springfield, IL", "Springfield, MA",
]
OPENINGS = [
    "4+ years of experience writing Python and SQL.",
    "You ship <b>services</b> in Java &amp; C++. 6-8 years of experience.",
    "Hybrid week. AWS, Docker and Kubernetes.",
    "Hybrid cloud rollout. Azure and Terraform.",
    "Coach and mentor our intern group. Read https://example.com/open?role=7 first.",
    "JavaScript, TypeScript, Node.js and Angular.",
    "Lead our architect circle. 9 years of experience expected.",
    "Windows Server, Active Directory, ServiceNow.",
    "Machine learning in PyTorch and TensorFlow.",
    "backed by 30 years of experience in this trade",
    "Agile planning, Scrum and Jira.",
    "Principal analyst seat. Tableau and Power BI.",
]
# Every dictionary entry is named in one of the sentences.
SENTENCES = [f"{opening} Useful: {', '.join(SKILL_NAMES[i :: len(OPENINGS)])}." for i, opening in enumerate(OPENINGS)]
EMPLOYMENT = {"F": "Full-time", "O": "Contract", "P": "Part-time"}
PERIODS = {"1": ("YEARLY", 1), "2": ("HOURLY", 2080), "3": ("MONTHLY", 12), "5": ("biweekly", 26)}
DAY_MS = 86_400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str):
    return F.element_at(text.literal_array(values), F.expr(index).cast("int") + 1)


def raw_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, orders, events, labels = (table(spark, sf_dir, t) for t in ("documents", "orders", "events", "labels"))
    docs = spread(docs, "doc_id")
    joined = (
        docs.join(orders, F.col("doc_id") == F.col("o_orderkey"))
        .join(events, F.col("doc_id") == F.col("event_id"))
        .join(labels.select(F.col("doc_id").alias("labelled_id"), "quality"), F.col("doc_id") == F.col("labelled_id"), "left")
    )
    priority = F.substring("o_orderpriority", 1, 1)
    period = factor = None
    for digit, (name, per_year) in PERIODS.items():
        period = F.when(priority == digit, name) if period is None else period.when(priority == digit, name)
        factor = F.when(priority == digit, per_year) if factor is None else factor.when(priority == digit, per_year)
    base = F.round(
        (F.lit(20000) + F.col("o_totalprice") / 2.5) / factor.otherwise(1) * F.when(F.expr("doc_id % 97 = 5"), 100).otherwise(1), 2
    )
    doc = F.col("doc_id")
    listed = F.unix_millis(F.col("ts").cast("timestamp"))
    return joined.withColumn("base", base).select(
        doc.alias("job_id"),
        _pick(TITLES, "n_chars % 12").alias("title"),
        F.concat("text", F.lit(" "), _pick(SENTENCES, "(n_chars div 12) % 12")).alias("description"),
        F.col("o_custkey").alias("company_id"),
        F.when(
            F.expr("(n_chars div 144) % 17 <> 0"), F.concat(F.lit("Company "), F.expr("(n_chars div 5) % 40").cast("string"))
        ).alias("company_name"),
        _pick(LOCATIONS, "o_custkey % 16").alias("location"),
        F.when(doc % 10 != 9, _pick(LEVELS, "least(doc_id % 10, 8)")).alias("formatted_experience_level"),
        F.coalesce(*[F.when(F.col("o_orderstatus") == k, v) for k, v in EMPLOYMENT.items()]).alias("formatted_work_type"),
        F.when(doc % 4 == 0, 1).alias("remote_allowed"),
        F.when(doc % 3 != 0, F.col("base") * 0.8).alias("min_salary"),
        F.when(doc % 3 == 0, F.col("base")).alias("med_salary"),
        F.when((doc % 3 != 0) & (doc % 29 != 0), F.col("base") * 1.2).alias("max_salary"),
        period.alias("pay_period"),
        F.when(doc % 50 == 7, "EUR").when(doc % 5 == 0, None).otherwise("USD").alias("currency"),
        listed.alias("listed_time"),
        (listed - (doc % 7) * F.lit(DAY_MS)).alias("original_listed_time"),
        F.col("value").alias("views"),
        F.when(doc % 3 != 1, F.floor(F.col("value") / 10).cast("double")).alias("applies"),
        F.col("quality"),
    )


def job_skill_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_partkey").alias("skill_abr"))


def skill_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("skill_abr"), F.col("p_type").alias("skill_name"))


def job_industry_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    return items.join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_orderkey").alias("job_id"), F.col("s_nationkey").alias("industry_id")
    )


def industry_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("industry_id"), F.col("n_name").alias("industry_name")
    )


def _sql_list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


_PRIORITY = "substr(o_orderpriority, 1, 1)"
RAW_POSTINGS_SQL = f"""
SELECT doc_id AS job_id,
  list_extract({_sql_list(TITLES)}, n_chars % 12 + 1) AS title,
  text || ' ' || list_extract({_sql_list(SENTENCES)}, (n_chars // 12) % 12 + 1) AS description,
  o_custkey AS company_id,
  CASE WHEN (n_chars // 144) % 17 <> 0 THEN 'Company ' || CAST((n_chars // 5) % 40 AS VARCHAR) END AS company_name,
  list_extract({_sql_list(LOCATIONS)}, o_custkey % 16 + 1) AS location,
  CASE WHEN doc_id % 10 <> 9 THEN list_extract({_sql_list(LEVELS)}, doc_id % 10 + 1) END AS formatted_experience_level,
  CASE o_orderstatus {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in EMPLOYMENT.items())} END AS formatted_work_type,
  CASE WHEN doc_id % 4 = 0 THEN 1 END AS remote_allowed,
  CASE WHEN doc_id % 3 <> 0 THEN base * 0.8 END AS min_salary,
  CASE WHEN doc_id % 3 = 0 THEN base END AS med_salary,
  CASE WHEN doc_id % 3 <> 0 AND doc_id % 29 <> 0 THEN base * 1.2 END AS max_salary,
  CASE {_PRIORITY} {' '.join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in PERIODS.items())} END AS pay_period,
  CASE WHEN doc_id % 50 = 7 THEN 'EUR' WHEN doc_id % 5 = 0 THEN NULL ELSE 'USD' END AS currency,
  listed_time,
  listed_time - (doc_id % 7) * {DAY_MS} AS original_listed_time,
  value AS views,
  CASE WHEN doc_id % 3 <> 1 THEN floor(value / 10) END AS applies,
  quality
FROM (
  SELECT d.doc_id, d.text, d.n_chars, o.*, e.value, l.quality,
    epoch_us(e.ts) // 1000 AS listed_time,
    round((20000 + o_totalprice / 2.5::DOUBLE)
      / CASE {_PRIORITY} {' '.join(f"WHEN '{k}' THEN {v[1]}" for k, v in PERIODS.items())} ELSE 1 END
      * CASE WHEN d.doc_id % 97 = 5 THEN 100 ELSE 1 END, 2) AS base
  FROM documents d
  JOIN orders o ON o.o_orderkey = d.doc_id
  JOIN events e ON e.event_id = d.doc_id
  LEFT JOIN labels l ON l.doc_id = d.doc_id
)
"""
