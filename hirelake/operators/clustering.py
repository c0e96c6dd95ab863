"""Role clusters: describing them, naming them, measuring them, and finding them."""

from dataclasses import dataclass, field

import numpy as np
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.functions import text
from hirelake.operators import kmeans, lsa
from hirelake.session import spread

#: Rows of the silhouette of a scan.
SILHOUETTE_ROWS = 4_000


def top_titles(mart: DataFrame, top: int = 4, by: str = "cluster") -> DataFrame:
    """The most common titles of each cluster, joined by "; "."""
    counted = mart.groupBy(by, F.lower("title").alias("title")).agg(F.count(F.lit(1)).alias("n"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("n"), "title"))
    best = counted.withColumn("rank", rank).where(F.col("rank") <= top)
    listed = F.array_sort(F.collect_list(F.struct("rank", "title")))
    return best.groupBy(by).agg(F.concat_ws("; ", F.transform(listed, lambda s: s["title"])).alias("titles"))


def l2_normalized(vector: str) -> Column:
    """Array scaled to unit length; a zero vector stays zero."""
    v = F.col(vector).cast("array<double>")
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(v, lambda x: x / F.when(length == 0, 1.0).otherwise(length))


def centroids(df: DataFrame, vector: str, by: str) -> DataFrame:
    """Mean vector per cluster, added up inside each task first: by, centroid, size."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    grouped = df.groupBy(by).agg(mean.alias("m"), F.count(F.lit(1)).alias("size"))
    return grouped.select(by, vector_to_array("m").alias("centroid"), "size")


def inertia(df: DataFrame, vector: str, by: str) -> DataFrame:
    """Size and sum of squared distances to the mean, per cluster."""
    means = centroids(df, vector, by).select(by, "centroid")
    gap = F.zip_with(F.col(vector).cast("array<double>"), "centroid", lambda a, b: (a - b) * (a - b))
    distance = F.aggregate(gap, F.lit(0.0), lambda a, x: a + x)
    return df.join(means, by).groupBy(by).agg(F.count(F.lit(1)).alias("size"), F.sum(distance).alias("inertia"))


def top_terms(weights: DataFrame, clusters: DataFrame, key: str = "job_id", by: str = "cluster", top: int = 15) -> DataFrame:
    """Terms with the highest mean TF-IDF per cluster, absent terms counting as 0."""
    sizes = clusters.groupBy(by).agg(F.count(F.lit(1)).alias("size"))
    sums = weights.join(clusters.select(key, by), key).groupBy(by, "term").agg(F.sum("tfidf").alias("total"))
    means = sums.join(sizes, by).select(by, "term", (F.col("total") / F.col("size")).alias("mean"))
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc(F.round("mean", 12)), "term"))
    return means.withColumn("rank", rank).where(F.col("rank") <= top)


def failed_names(terms: DataFrame, names: DataFrame, by: str = "cluster") -> DataFrame:
    """Named clusters none of whose top terms contains the signature term; no rows if all names fit."""
    found = terms.join(names, by).where(F.contains("term", F.col("signature"))).select(by).distinct()
    return names.join(found, by, "left_anti")


def require_names(terms: DataFrame, names: DataFrame, by: str = "cluster") -> None:
    """Stop the run if a named cluster no longer has its signature term among its top terms."""
    wrong = failed_names(terms, names, by).select(by).limit(20).collect()
    if wrong:
        raise ValueError(f"clusters that no longer fit their names: {sorted(r[by] for r in wrong)}")


def silhouette(df: DataFrame, vector: str, by: str) -> DataFrame:
    """by, size, silhouette (the mean of its rows) of each cluster of a given assignment, by Euclidean distances between all rows."""
    codes = df.select(by).distinct().withColumn("_code", F.row_number().over(Window.orderBy(by)) - 1)  # one row a cluster
    coded = df.join(codes, df[by].eqNullSafe(codes[by])).select(vector, "_code")
    blocks = kmeans.dense_blocks(coded, vector, "_code")
    try:
        clusters = codes.count()

        scored = kmeans.silhouettes(blocks, [0], [clusters]).join(blocks.keyBy(lambda b: b[0]))
        sums = scored.flatMap(lambda x: [(int(c), (float(x[1][0][0][x[1][1][2][0] == c].sum()), int((x[1][1][2][0] == c).sum()))) for c in np.unique(x[1][1][2][0])])
        found = sums.reduceByKey(lambda a, b: (a[0] + b[0], a[1] + b[1])).map(lambda x: (x[0], x[1][1], x[1][0] / x[1][1])).collect()  # one row a cluster
    finally:
        blocks.unpersist()
    return codes.join(df.sparkSession.createDataFrame(found, "_code int, size long, silhouette double"), "_code").drop("_code")


def name_by_signature(terms: DataFrame, signatures: DataFrame, by: str = "cluster") -> DataFrame:
    """The role name whose signature term ranks best among a cluster's top terms.

    Cluster numbers depend on the seed; the names follow the terms instead.
    """
    # A handful of clusters by a handful of names, matched by the words a term is made of.
    parts = terms.select(by, "rank", "term", F.explode(_stretches("term")).alias("signature"))
    best = parts.join(signatures, "signature").groupBy(by).agg(F.min(F.struct("rank", "name"))["name"].alias("name"))
    return terms.select(by).distinct().join(best, by, "left").select(
        by, F.coalesce("name", F.concat(F.lit("Cluster "), F.col(by).cast("string"))).alias("name")
    )


def _stretches(term: str) -> Column:
    """A term of one or two words, and each of its words."""
    return F.array_distinct(F.concat(F.array(term), F.split(term, " ")))


# ---------------------------------------------------------------- finding clusters


def best_kmeans(vectors: DataFrame, k: int, inits: int = 10, seed: int = 42, features: str = "z") -> KMeansModel:
    """The model with the lowest cost of several starts. `vectors` should be a written table."""
    return kmeans.to_model(kmeans.best_of_starts(vectors, [k], inits, seed, features)[k][0], features)


def scan_k(
    vectors: DataFrame, ks: range = range(4, 16), inits: int = 10, seed: int = 42, features: str = "z", sample: int | None = SILHOUETTE_ROWS
) -> list[dict]:
    """Cost over all rows and Euclidean silhouette for each number of clusters.

    The silhouette is that of `sample` rows (those of the smallest hashes) by their distances among each other, or of all rows where it is None.
    """
    ks = list(ks)
    found = kmeans.best_of_starts(vectors, ks, inits, seed, features)
    if sample is not None:
        rows = kmeans.start_rows(vectors, features, sample).tolist()
        vectors = vectors.sparkSession.createDataFrame([(r,) for r in rows], f"{features} array<double>")
    blocks = kmeans.dense_blocks(vectors, features)
    scores = kmeans.mean_silhouettes(blocks, [found[k][0] for k in ks], ks)
    blocks.unpersist()
    return [{"k": k, "inertia": found[k][1], "silhouette": s} for k, s in zip(ks, scores)]


@dataclass
class RoleModel:
    """Role clusters: text to TF-IDF to LSA coordinates to the nearest centre, with a name per cluster."""

    words: PipelineModel
    components: np.ndarray
    kmeans: KMeansModel
    names: list[str] = field(default_factory=list)
    explained_variance: float = 0.0

    def vectors(self, texts: DataFrame, text_col: str = "text") -> DataFrame:
        """Input columns plus z, the unit-length coordinates."""
        kept = texts.columns
        made = self.words.transform(texts)
        z = lsa.projected(texts.sparkSession, self.components, "tfidf")
        return made.withColumn("z", array_to_vector(z)).select(*kept, "z")

    def transform(self, texts: DataFrame, text_col: str = "text") -> DataFrame:
        """Input columns plus cluster and cluster_name."""
        kept = texts.columns
        out = self.kmeans.transform(self.vectors(texts, text_col))
        names = text.literal_array(self.names)
        return out.select(*kept, "cluster", F.element_at(names, F.col("cluster") + 1).alias("cluster_name"))

    def top_terms(self, spark, top: int = 15) -> DataFrame:
        """Terms of each centre, mapped back from coordinates to words: cluster, term, weight, rank."""
        vocabulary = np.array(next(s.vocabulary for s in self.words.stages if isinstance(s, CountVectorizerModel)))
        weights = np.array(self.kmeans.clusterCenters()) @ self.components.T
        rows = []
        for c, w in enumerate(weights):
            order = np.lexsort((vocabulary, -np.round(w, 12)))[:top]
            rows += [(c, str(vocabulary[j]), float(w[j]), rank + 1) for rank, j in enumerate(order)]
        return spark.createDataFrame(rows, "cluster int, term string, weight double, rank int")

    def save(self, path: str) -> None:
        self.words.write().overwrite().save(f"{path}/words")
        self.kmeans.write().overwrite().save(f"{path}/kmeans")
        spark = SparkSession.getActiveSession()
        rows = [(i, [float(x) for x in r]) for i, r in enumerate(self.components)]
        spark.createDataFrame(rows, "term int, row array<double>").write.mode("overwrite").parquet(f"{path}/components")
        named = [(i, n, self.explained_variance) for i, n in enumerate(self.names)]
        spark.createDataFrame(named, "cluster int, name string, explained double").write.mode("overwrite").parquet(f"{path}/names")

    @staticmethod
    def load(path: str) -> "RoleModel":
        spark = SparkSession.getActiveSession()
        rows = spark.read.parquet(f"{path}/components").orderBy("term").collect()
        named = spark.read.parquet(f"{path}/names").orderBy("cluster").collect()
        return RoleModel(
            PipelineModel.load(f"{path}/words"), np.array([r["row"] for r in rows]), KMeansModel.load(f"{path}/kmeans"),
            [r["name"] for r in named], named[0]["explained"],
        )


def explained_variance(weighed: DataFrame, z: DataFrame) -> float:
    """Variance of the coordinates over the variance of the TF-IDF columns."""

    def total(df: DataFrame, column: str) -> float:
        return float(df.select(Summarizer.variance(F.col(column)).alias("v")).first()["v"].toArray().sum())

    whole = total(weighed, "tfidf")
    return total(z, "z") / whole if whole else 0.0


def fit_roles(
    texts: DataFrame, k: int = 10, dims: int = 100, stop_words=(), max_features: int = 20_000, min_df: int = 5,
    max_df: float = 0.5, inits: int = 10, passes: int = 5, seed: int = 42, signatures: dict[str, str] | None = None,
    key: str = "job_id",
) -> RoleModel:
    """Fit role clusters on key and text, and name them by their signature terms."""
    from hirelake.operators import models
    from hirelake.sources.stages import materialize

    spark = texts.sparkSession
    words = models.fit_tfidf(texts, key, "text", stop_words, min_df, max_df, max_features)
    weighed = materialize(words.transform(texts).select(key, "tfidf"), "role-tfidf")
    weighed = spread(weighed, key)
    n_terms = len(models.vocabulary_of(words))
    components = lsa.fit(weighed, "tfidf", n_terms, min(dims, n_terms), passes=passes, seed=seed)
    raw = weighed.select(array_to_vector(lsa.projected(spark, components, "tfidf", normalize=False)).alias("z"))
    explained = explained_variance(weighed, raw)
    z = weighed.select(key, array_to_vector(lsa.projected(spark, components, "tfidf")).alias("z"))
    vectors = materialize(z, "role-vectors")
    model = RoleModel(words, components, best_kmeans(vectors, k, inits, seed), [], explained)
    wanted = spark.createDataFrame(list((signatures or {}).items()) or [("", "")], "name string, signature string")
    named = name_by_signature(model.top_terms(spark), wanted).orderBy("cluster").collect()
    model.names = [r["name"] for r in named]
    return model
