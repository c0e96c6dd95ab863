"""Seniority classifiers: fitting, comparing, tuning, explaining and storing them.

The stateless part (texts, flags, skills) is computed once and cannot leak; what
is learnt from data (vocabulary, medians, scales, coefficients) is learnt from
the training rows alone, again in every fold.
"""

import itertools
import json
import warnings
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel, Transformer
from pyspark.ml.classification import LinearSVC, LinearSVCModel, LogisticRegressionModel, OneVsRestModel
from pyspark.ml.feature import (
    CountVectorizerModel, ElementwiseProduct, NGram, Normalizer, RegexTokenizer, SQLTransformer, StopWordsRemover,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, Identifiable
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hirelake.functions import fixed, skills, text
from hirelake.functions.vectors import SublinearTf
from hirelake.operators import attributions, blocks, boosting, evaluation, features, folds, linear, stats, tfidf
from hirelake.sources.stages import materialize

# ---------------------------------------------------------------- preprocessing


class PostingFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """First stage of a stored model: raw title, description and company to feature columns."""

    includeTitle = Param(Params._dummy(), "includeTitle", "use the title", TypeConverters.toBoolean)
    key = Param(Params._dummy(), "key", "column that identifies a posting", TypeConverters.toString)

    def __init__(self, includeTitle: bool = True, key: str = "job_id"):
        super().__init__()
        self._set(includeTitle=includeTitle, key=key)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        variant = "with_title" if self.getOrDefault(self.includeTitle) else "without_title"
        return features.build_features(
            dataset, "title", "description", "company_name", self.getOrDefault(self.key), (variant,)
        )


def term_stages(input_col: str, stop_words) -> list:
    """Native stages from a text column to an array of words and word pairs in `terms`."""
    return [
        RegexTokenizer(inputCol=input_col, outputCol="_words", pattern=text.TOKEN, gaps=False, toLowercase=True),
        StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=list(stop_words), caseSensitive=True, locale="en_US"),
        NGram(n=2, inputCol="_kept", outputCol="_pairs"),
        SQLTransformer(statement="SELECT *, concat(_kept, _pairs) AS terms FROM __THIS__"),
    ]


def fit_tfidf(
    docs: DataFrame, key: str, text_col: str, stop_words=fixed.ENGLISH_STOP_WORDS, min_df: int = 5, max_df: float = 0.8,
    max_features: int = 20_000, output: str = "tfidf",
) -> PipelineModel:
    """Text to unit-length TF-IDF vectors, with the vocabulary of the long form.

    The vocabulary and its idf come to the driver as model state: at most
    `max_features` rows.
    """
    vocabulary = tfidf.vocabulary_of_texts(docs, key, text_col, stop_words, min_df, max_df, max_features)
    rows = vocabulary.select("term", "idf").collect()
    if not rows:
        raise ValueError("no term is frequent enough for a vocabulary")
    rows.sort(key=lambda r: r["term"])
    return PipelineModel([
        *term_stages(text_col, stop_words),
        CountVectorizerModel.from_vocabulary([r["term"] for r in rows], inputCol="terms", outputCol="_counts"),
        SublinearTf("_counts", "_tf"),
        ElementwiseProduct(scalingVec=Vectors.dense([r["idf"] for r in rows]), inputCol="_tf", outputCol="_weighed"),
        Normalizer(p=2.0, inputCol="_weighed", outputCol=output),
    ])


def vocabulary_of(model: PipelineModel) -> list[str]:
    return next(s.vocabulary for s in model.stages if isinstance(s, CountVectorizerModel))


def fit_numeric(train: DataFrame, columns: list[str] = features.NUMERIC) -> tuple[SQLTransformer, list[str]]:
    """Median imputation, missing indicators and scaling as one SQL stage, and the columns it makes.

    All columns are learnt from one table of (column, value, count).
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = stats.value_counts(train.select(F.inline(pairs)), "value", ["column"])
    total = train.agg(F.count(F.lit(1))).scalar()
    middles = stats.quantiles_of_counts(counts, {"median": 0.5}, ["column"])
    joined = counts.join(middles.select("column", "median"), "column").withColumn("total", total)
    n = F.col("n")
    # The rows without a value all hold the median.
    sums = joined.groupBy("column").agg(
        F.first("median").alias("median"), F.first("total").alias("total"), F.sum(n).alias("known"),
        F.sum(n * F.col("v")).alias("sum"),
    )
    mean = (F.col("sum") + (F.col("total") - F.col("known")) * F.col("median")) / F.col("total")
    means = sums.withColumn("mean", mean)
    spread = (
        counts.join(means, "column")
        .groupBy("column")
        .agg(
            *[F.first(c).alias(c) for c in ("median", "total", "known", "mean")],
            F.sum(n * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))).alias("squares"),
        )
    )
    learnt = {r["column"]: r for r in spread.collect()}  # one row per column
    selected, names = [], []
    for c in columns:
        r = learnt.get(c)
        if r is None:  # no value at all: nothing to learn
            continue
        gone = r["total"] - r["known"]
        std = ((r["squares"] + gone * (r["median"] - r["mean"]) ** 2) / r["total"]) ** 0.5 or 1.0
        selected.append(f"(coalesce(CAST({c} AS DOUBLE), {r['median']!r}D) - {r['mean']!r}D) / {std!r}D AS {c}_z")
        names.append(f"{c}_z")
        if gone:
            rate = gone / r["total"]
            selected.append(f"(CAST({c} IS NULL AS DOUBLE) - {rate!r}D) / {(rate * (1 - rate)) ** 0.5 or 1.0!r}D AS {c}_missing_z")
            names.append(f"{c}_missing_z")
    return SQLTransformer(statement=f"SELECT *, {', '.join(selected)} FROM __THIS__"), names


@dataclass
class Preprocessor:
    """Fitted stages from feature columns to one sparse vector, and the name of each position."""

    model: PipelineModel
    names: list[str]


def fit_preprocessor(train: DataFrame, key: str = "job_id", max_features: int = 20_000, min_df: int = 5) -> Preprocessor:
    words = fit_tfidf(train, key, "text", max_features=max_features, min_df=min_df)
    numeric, numeric_names = fit_numeric(train)
    known = skills.SKILL_NAMES
    skill_names = ", ".join(text.sql_literal(n) for n in known)
    listed = SQLTransformer(
        statement=f"SELECT *, transform(skill_ids, i -> element_at(array({skill_names}), i + 1)) AS _skills FROM __THIS__"
    )
    flags = CountVectorizerModel.from_vocabulary(known, inputCol="_skills", outputCol="skill_flags")
    flags.setBinary(True)
    assembled = VectorAssembler(
        inputCols=["tfidf", "skill_flags", *numeric_names, *features.FLAGS], outputCol="features", handleInvalid="keep"
    )
    names = [*vocabulary_of(words), *[skills.skill_slug(n) for n in known], *numeric_names, *features.FLAGS]
    return Preprocessor(PipelineModel([*words.stages, numeric, listed, flags, assembled]), names)


# ---------------------------------------------------------------- classifiers


@dataclass
class Candidate:
    """A kind of classifier, and how many terms it gets. `learn` fits several settings on the learning rows of several folds at once."""

    learn: object
    params: dict
    grid: dict[str, list]
    max_features: int = 20_000


def _logistic_model(coefficients: np.ndarray) -> LogisticRegressionModel:
    weights, classes = coefficients[:-1].T, coefficients.shape[1]
    matrix = DenseMatrix(classes, weights.shape[1], weights.ravel().tolist(), isTransposed=True)
    made = JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", Identifiable()._randomUID(), matrix, Vectors.dense(coefficients[-1]), classes, True
    )
    return LogisticRegressionModel(made)


def _svm_model(coefficients: np.ndarray) -> OneVsRestModel:
    kind = "org.apache.spark.ml.classification.LinearSVCModel"
    made = [JavaWrapper._new_java_obj(kind, Identifiable()._randomUID(), Vectors.dense(c[:-1]), float(c[-1])) for c in coefficients.T]
    return OneVsRestModel([LinearSVCModel(m) for m in made])._set(featuresCol="features", labelCol="label", classifier=LinearSVC())


class _Linear:
    """Linear classifiers of all folds and penalties as one matrix."""

    def __init__(self, loss, to_model, penal_intercept: bool):
        self.loss, self.to_model, self.penal_intercept = loss, to_model, penal_intercept

    def fit(self, rows, sizes: dict, settings: list[dict], classes: int) -> dict[tuple[int, int], tuple[object, bool]]:
        """(setting, fold) to what was learnt, and whether it converged."""
        out = {}
        for limit in {s["max_iter"] for s in settings}:
            asked = {(i, f): linear.Problem(f, s["C"]) for i, s in enumerate(settings) if s["max_iter"] == limit for f in sizes}
            found = linear.solve(rows, list(dict.fromkeys(asked.values())), sizes, self.loss, classes, limit, self.penal_intercept)
            out |= {k: (found[p].coefficients, found[p].converged) for k, p in asked.items()}
        return out

    def confusion(self, rows, learnt: dict, classes: int) -> dict:
        problems = {linear.Problem(f, float(i)): w for (i, f), (w, _) in learnt.items()}
        return {(int(p.C), p.fold): c for p, c in linear.confusion(rows, problems, classes).items()}


class _Boosted:
    """Boosted trees: the folds of one setting at once, settings one after the other."""

    def fit(self, rows, sizes: dict, settings: list[dict], classes: int) -> dict[tuple[int, int], tuple[object, bool]]:
        out = {}
        for i, s in enumerate(settings):
            grown = boosting.grow(rows, sizes, classes, s["rounds"], s["max_depth"], s["rate"], fixed.BOOSTED_SAMPLE, float(fixed.BOOSTED_COLUMNS))
            out |= {(i, f): (trees, True) for f, trees in grown.items()}
        return out

    def confusion(self, rows, learnt: dict, classes: int) -> dict:
        return boosting.confusion(rows, {k: trees for k, (trees, _) in learnt.items()}, classes)

    to_model = staticmethod(boosting.BoostedTreesModel.of)


_LEARNERS = {
    "Logistic Regression": _Linear(linear.softmax_loss, _logistic_model, penal_intercept=False),
    "Linear SVM": _Linear(linear.squared_hinge_loss, _svm_model, penal_intercept=True),
    "Boosted Trees": _Boosted(),
}
CANDIDATES = {n: Candidate(learn, fixed.CLASSIFIER_SETTINGS[n], fixed.CLASSIFIER_GRIDS[n], fixed.MAX_TERMS[n]) for n, learn in _LEARNERS.items()}


def label_index(label: str, classes: list[str]) -> Column:
    return text.literal_map({c: float(i) for i, c in enumerate(classes)})[F.col(label)]


@dataclass
class SeniorityModel:
    """A fitted classifier: from raw postings (`transform`) or from feature columns (`predict`)."""

    preprocess: PipelineModel
    classifier: object
    classes: list[str]
    names: list[str] = field(default_factory=list)
    include_title: bool = True
    key: str = "job_id"

    def predict(self, feature_rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """key, keep..., pred and p_<class> (where the classifier gives probabilities)."""
        out = self.classifier.transform(self.preprocess.transform(feature_rows))
        columns = [self.key, *keep, class_name("prediction", self.classes).alias("pred")]
        probabilities = self._probabilities(out)
        if probabilities is not None:
            out = out.withColumn("_p", probabilities)
            columns += [F.col("_p")[i].alias(f"p_{c}") for i, c in enumerate(self.classes)]
        return out.select(*columns)

    def _probabilities(self, out: DataFrame) -> Column | None:
        return vector_to_array("probability") if "probability" in out.columns else None

    def transform(self, postings: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
        """Predictions from title, description and company_name."""
        variant = "with_title" if self.include_title else "without_title"
        rows = features.build_features(postings, "title", "description", "company_name", self.key, (variant,), keep=keep)
        return self.predict(rows, keep)

    def pipeline(self) -> PipelineModel:
        """The whole model as one storable pipeline that takes raw postings."""
        return PipelineModel([PostingFeatures(self.include_title, self.key), *self.preprocess.stages, self.classifier])

    def save(self, path: str) -> None:
        self.pipeline().write().overwrite().save(f"{path}/pipeline")
        spark = SparkSession.getActiveSession()
        meta = json.dumps({"classes": self.classes, "include_title": self.include_title, "key": self.key})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").text(f"{path}/meta")
        names = spark.createDataFrame(list(enumerate(self.names)), "position int, name string")
        names.coalesce(1).write.mode("overwrite").parquet(f"{path}/names")

    @staticmethod
    def load(path: str) -> "SeniorityModel":
        spark = SparkSession.getActiveSession()
        stages = PipelineModel.load(f"{path}/pipeline").stages
        meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
        names = [r["name"] for r in spark.read.parquet(f"{path}/names").orderBy("position").collect()]
        return SeniorityModel(
            PipelineModel(stages[1:-1]), stages[-1], meta["classes"], names, meta["include_title"], meta["key"]
        )


def class_name(index: str, classes: list[str]) -> Column:
    return F.element_at(text.literal_array(classes), F.col(index).cast("int") + 1)


def fit(
    train: DataFrame, name: str, params: dict | None = None, label: str = "seniority", classes: list[str] = fixed.CLASSES,
    key: str = "job_id", min_df: int = 5, include_title: bool = True, prepared: Preprocessor | None = None,
) -> SeniorityModel:
    """Fit the preprocessing and one classifier on feature rows with a label.

    The assembled vectors are written once: every pass of the optimiser reads
    them back instead of splitting the texts again.
    """
    candidate = CANDIDATES[name]
    params = {**candidate.params, **(params or {})}
    terms = params.pop("max_features", candidate.max_features)
    prepared = prepared or fit_preprocessor(train, key, terms, min_df)
    rows = blocks.blocks_of(_vectors(train, prepared, 0, label, classes))
    try:
        learnt, converged = candidate.learn.fit(rows, _sizes(rows), [params], len(classes))[0, 0]
    finally:
        rows.unpersist()
    if not converged:
        warnings.warn(f"{name} stopped after {params['max_iter']} passes without having converged", stacklevel=2)
    return SeniorityModel(prepared.model, candidate.learn.to_model(learnt), classes, prepared.names, include_title, key)


def _vectors(train: DataFrame, prepared: Preprocessor, fold: int, label: str, classes: list[str], held_out: DataFrame | None = None) -> DataFrame:
    """fold, learn, label, weight, features of the rows to learn from, and of those to be judged."""
    rows = features.with_balanced_weight(train, label, classes).withColumn("learn", F.lit(True))
    if held_out is not None:
        rows = rows.unionByName(held_out.withColumn("weight", F.lit(0.0)).withColumn("learn", F.lit(False)))
    rows = prepared.model.transform(rows.withColumn("label", label_index(label, classes)))
    return rows.select(F.lit(fold).alias("fold"), "learn", "label", "weight", "features")


def _sizes(rows) -> dict[int, tuple[int, int]]:
    """Features and learning rows of each fold."""
    count = blocks.added(rows, lambda b: {b.fold: np.array([b.size if b.learn else 0, len(b) if b.learn else 0, 1 if b.learn else 0])})
    return {f: (int(size // parts), int(n)) for f, (size, n, parts) in count.items()}


# ---------------------------------------------------------------- selection


def macro_f1_and_balanced(predictions: DataFrame, classes: list[str]) -> tuple[float, float]:
    wanted = evaluation.evaluate(predictions, classes=classes).where("metric IN ('macro_f1', 'balanced_accuracy')")
    found = {r["metric"]: r["value"] for r in wanted.collect()}
    return found["macro_f1"], found["balanced_accuracy"]


def scores_of(confusion: np.ndarray) -> tuple[float, float]:
    """(macro F1, balanced accuracy) of actual x predicted counts: as `evaluate`, over the classes that occur (F1: in either; accuracy: as actual)."""
    hit, actual, told = np.diag(confusion), confusion.sum(axis=1), confusion.sum(axis=0)
    f1 = 2 * hit / np.maximum(actual + told, 1)
    return float(f1[actual + told > 0].mean()), float((hit[actual > 0] / actual[actual > 0]).mean())


def cross_validate_all(
    train: DataFrame, name: str, settings: list[dict], label: str = "seniority", classes: list[str] = fixed.CLASSES,
    fold: str = "cv_fold", n_folds: int = fixed.CV_FOLDS, parallelism: int = 1, key: str = "job_id", min_df: int = 5,
) -> list[list[tuple[float, float]]]:
    """(macro F1, balanced accuracy) of each fold, for each of several settings of a classifier; everything is fitted again per fold.

    `train` should be a written table. Vocabularies, medians and scales are learnt once for each fold and number of terms, side by side
    with `parallelism`; then the classifiers of all folds and settings are fitted together, and judged together.
    """
    candidate = CANDIDATES[name]
    full = [{**candidate.params, "max_features": candidate.max_features, **s} for s in settings]
    out: list = [None] * len(settings)

    def prepared(i: int, terms: int) -> DataFrame:
        learn, held_out = train.where(F.col(fold) != i), train.where(F.col(fold) == i)
        return materialize(_vectors(learn, fit_preprocessor(learn, key, terms, min_df), i, label, classes, held_out), "fold-vectors")

    for terms in dict.fromkeys(s["max_features"] for s in full):
        of_fold = inheritable_thread_target(train.sparkSession)(lambda i, terms=terms: prepared(i, terms))
        with ThreadPoolExecutor(parallelism) as pool:
            parts = list(pool.map(of_fold, range(n_folds)))
        every = parts[0]
        for part in parts[1:]:
            every = every.unionByName(part)
        rows = blocks.blocks_of(every)
        at = [i for i, s in enumerate(full) if s["max_features"] == terms]
        try:
            learnt = candidate.learn.fit(rows, _sizes(rows), [full[i] for i in at], len(classes))
            judged = candidate.learn.confusion(rows, learnt, len(classes))
        finally:
            rows.unpersist()
        for k, i in enumerate(at):
            out[i] = [scores_of(judged[k, f]) for f in range(n_folds)]
    return out


def cross_validate(train: DataFrame, name: str, params: dict | None = None, **cv_args) -> list[tuple[float, float]]:
    """(macro F1, balanced accuracy) of each fold of one setting."""
    return cross_validate_all(train, name, [params or {}], **cv_args)[0]


SCORES = "model string, params string, fold int, metric string, value double"


def fold_scores(train: DataFrame, tries: list[tuple[str, dict]], **cv_args) -> DataFrame:
    """model, params, fold, metric, value: the cross-validated scores of several classifiers or settings."""
    rows = []
    for name in dict.fromkeys(n for n, _ in tries):
        settings = [params for n, params in tries if n == name]
        for params, scores in zip(settings, cross_validate_all(train, name, settings, **cv_args)):
            for fold, (f1, accuracy) in enumerate(scores):
                told = (name, json.dumps(params, sort_keys=True), fold)
                rows += [(*told, "macro_f1", f1), (*told, "balanced_accuracy", accuracy)]
    return train.sparkSession.createDataFrame(rows, SCORES)


def ranked(scores: DataFrame) -> DataFrame:
    """model, params, place, and mean and spread over the folds of each metric; the highest mean macro F1 has place 1."""

    def of(metric):
        return F.when(F.col("metric") == metric, F.col("value"))

    summed = scores.groupBy("model", "params").agg(
        F.avg(of("macro_f1")).alias("macro_f1"), F.stddev_pop(of("macro_f1")).alias("macro_f1_spread"),
        F.avg(of("balanced_accuracy")).alias("balanced_accuracy"), F.count(of("macro_f1")).alias("folds"),
    )
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("macro_f1"), "model", "params")  # one row a try
    return summed.withColumn("place", F.row_number().over(order))


def compare_models(train: DataFrame, settings: dict[str, dict] | None = None, **cv_args) -> DataFrame:
    """`ranked` scores of each classifier with its own settings, changed by `settings[name]`; only those named, if any are."""
    return ranked(fold_scores(train, list((settings or {n: {} for n in CANDIDATES}).items()), **cv_args))


def grid_search(train: DataFrame, name: str, grid: dict[str, list] | None = None, fixed_params: dict | None = None, **cv_args) -> DataFrame:
    """`ranked` scores of every combination of a grid."""
    grid = grid or CANDIDATES[name].grid
    tries = [(name, {**(fixed_params or {}), **dict(zip(grid, values))}) for values in itertools.product(*grid.values())]
    return ranked(fold_scores(train, tries, **cv_args))


def best_params(tried: DataFrame) -> tuple[str, dict]:
    """Classifier and settings of place 1."""
    first = tried.where("place = 1").first()
    return first["model"], json.loads(first["params"])


def with_cv_folds(train: DataFrame, label: str = "seniority", classes: list[str] = fixed.CLASSES, n_folds: int = fixed.CV_FOLDS) -> DataFrame:
    """Folds of the training rows alone, in `cv_fold`."""
    assigned = folds.assign_group_folds(train, "group", label, classes, n_folds).withColumnRenamed("fold", "cv_fold")
    return train.join(assigned, "group")


def feature_push(model: SeniorityModel, feature_rows: DataFrame, top: int = 15) -> DataFrame:
    """Per class, the features that push predictions towards it: coefficient x value where
    the feature is present, averaged over all rows. Scaled numbers are left out."""
    spark = feature_rows.sparkSession
    vectors = model.preprocess.transform(feature_rows).select("features")
    mean = vectors.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    push = model.classifier.coefficientMatrix.toArray() * mean
    plain = np.array([not n.endswith("_z") for n in model.names])
    rows = []
    for i, c in enumerate(model.classes):
        order = sorted(np.flatnonzero(plain), key=lambda j: (-push[i, j], model.names[j]))[:top]
        rows += [(c, rank + 1, model.names[j], float(push[i, j])) for rank, j in enumerate(order)]
    return spark.createDataFrame(rows, "class string, rank int, feature string, push double")


def tree_explainer(model: SeniorityModel, background: DataFrame) -> attributions.Explainer:
    """What attributes the margins of a boosted model; `background` are the feature rows that left-out features follow, as a rule the training rows."""
    return attributions.explainer(model.classifier.fitted(), model.preprocess.transform(background))


def tree_effects(model: SeniorityModel, feature_rows: DataFrame, explained: attributions.Explainer, top: int = 15) -> DataFrame:
    """class, kind, rank, feature, effect of a boosted model. Of kind `present`: the `top` features that push rows towards the class, by their attributions in rows
    that have them over all rows. Of kind `numeric`: all scaled numbers in use, by the mean size of their attributions."""
    present, size, _ = attributions.effects(model.preprocess.transform(feature_rows), explained)
    names = [model.names[f] for f in explained.known]
    numeric = [n.endswith("_z") for n in names]
    rows = []
    for i, c in enumerate(model.classes):
        for kind, effect, most in (("present", present[i], top), ("numeric", size[i], len(names))):
            own = [j for j, is_numeric in enumerate(numeric) if is_numeric == (kind == "numeric")]
            own.sort(key=lambda j: (-effect[j], names[j]))
            rows += [(c, kind, rank + 1, names[j], float(effect[j])) for rank, j in enumerate(own[:most])]
    return feature_rows.sparkSession.createDataFrame(rows, "class string, kind string, rank int, feature string, effect double")
