"""Training and scoring as Spark ML jobs."""

from __future__ import annotations

import itertools
import math
import random
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, Evaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.util import inheritable_thread_target

from .. import fixed_values as fv
from ..config import TrainingConfig
from ..sources.scratch import materialize
from . import forest, tree_search
from .metrics import balanced_score, confusion
from .splitting import class_counts, stratified_folds

FEATURES, LABEL, WEIGHT, FOLD = "features", "label", "class_weight", "fold"
KEY = ["encounter_id", "snapshot_date"]


# --- inputs ---------------------------------------------------------------------------------
def fill_missing(rows: DataFrame, features: list[str], value: float = 0.0) -> DataFrame:
    """Missing model inputs take ``value`` (0 is the training mean of a scaled column), so that
    every row is trained on and scored."""
    return rows.withColumns(
        {c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(value)) for c in features}
    )


def assembler(features: list[str]) -> VectorAssembler:
    """The vector of the named columns; the names travel with it as metadata."""
    return VectorAssembler(inputCols=features, outputCol=FEATURES)


@dataclass(frozen=True)
class ClassBalance:
    negatives: int
    positives: int

    @staticmethod
    def of(rows: DataFrame, label: str = LABEL) -> "ClassBalance":
        counts = class_counts(rows, label).first()
        return ClassBalance(counts["n0"], counts["n1"])

    @property
    def rows(self) -> int:
        return self.negatives + self.positives

    def weights(self, mode: str | float | None) -> tuple[float, float]:
        """Weights of class 0 and 1: none, ``balanced``, ``scale_pos_weight`` or a number."""
        if mode is None or not self.negatives or not self.positives:
            return 1.0, 1.0
        if mode == "balanced":
            return self.rows / (2.0 * self.negatives), self.rows / (2.0 * self.positives)
        if mode == "scale_pos_weight":
            return 1.0, self.negatives / self.positives
        return 1.0, float(mode)


def with_class_weight(rows: DataFrame, balance: ClassBalance, mode: str | float | None) -> DataFrame:
    w0, w1 = balance.weights(mode)
    return rows.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, w1).otherwise(w0))


# --- estimators -------------------------------------------------------------------------------
def logistic_regression(n: int, penalty: str = "l2", C: float = 1.0, max_iter: int = 1000) -> LogisticRegression:
    """L1 or L2 with inverse strength ``C``. Spark's loss is a mean, hence ``1 / (C * n)``."""
    return LogisticRegression(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        elasticNetParam=1.0 if penalty == "l1" else 0.0,
        regParam=1.0 / (C * max(n, 1)),
        standardization=False,
        maxIter=max_iter,
    )


def random_forest(
    trees: int = 100, max_depth: int = 10, min_leaf: int = 1, seed: int = 42, subset: str = "sqrt"
) -> RandomForestClassifier:
    return RandomForestClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        numTrees=trees,
        maxDepth=max_depth,
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=subset,
        seed=seed,
    )


def boosted_trees(
    rounds: int = 100,
    max_depth: int = 5,
    learning_rate: float = 0.1,
    subsample: float = 1.0,
    column_share: float = 1.0,
    min_leaf: int = 1,
    min_gain: float = 0.0,
    seed: int = 42,
) -> GBTClassifier:
    return GBTClassifier(
        featuresCol=FEATURES,
        labelCol=LABEL,
        weightCol=WEIGHT,
        maxIter=rounds,
        maxDepth=max_depth,
        stepSize=learning_rate,
        subsamplingRate=subsample,
        featureSubsetStrategy="all" if column_share == 1.0 else str(column_share),
        minInstancesPerNode=min_leaf,
        minInfoGain=min_gain,
        seed=seed,
    )


SEARCH_SPACES, WIDE_SEARCH_SPACES = fv.SEARCH_SPACES, fv.WIDE_SEARCH_SPACES


def estimator(algorithm: str, n: int, seed: int = 42, **params) -> Estimator:
    params = {k: v for k, v in params.items() if k != "class_weight"}
    if algorithm == "logistic_regression":
        return logistic_regression(n, **params)
    if algorithm == "random_forest":
        return random_forest(seed=seed, **params)
    if algorithm in ("xgboost", "lightgbm"):
        return boosted_trees(seed=seed, **params)
    raise ValueError(f"unknown algorithm {algorithm!r}")


def draw_settings(space: dict[str, list], draws: int, seed: int) -> list[dict]:
    """``draws`` settings of the grid without repetition, in a seeded order."""
    names = sorted(space)
    grid = [dict(zip(names, values, strict=True)) for values in itertools.product(*(space[n] for n in names))]
    return random.Random(seed).sample(grid, min(draws, len(grid)))


class BalancedEvaluator(Evaluator):
    """AUC of hard labels, the mean of the two class recalls, from distributed counts."""

    def _evaluate(self, dataset: DataFrame) -> float:
        counts = confusion(dataset, [], F.col("prediction"), F.col(LABEL))
        value = counts.select(balanced_score().alias("score")).first()["score"]
        return 0.0 if value is None else value

    def isLargerBetter(self) -> bool:
        return True


def search_evaluator(metric: str) -> Evaluator:
    if metric == "balanced":
        return BalancedEvaluator()
    return BinaryClassificationEvaluator(labelCol=LABEL, numBins=0)


@dataclass
class SearchResult:
    model: Model
    params: dict
    score: float


#: Training data has a partition for each slot of the session: fewer if they had less than the first number of rows, and
#: a multiple of the slots if they had more than the second. The short jobs of tree levels cost by the task.
PARTITION_ROWS, PARTITION_ROWS_MOST = 10_000, 200_000
#: Up to so many rows a task of the search fits a tree setting by itself, over all of them; above, each fit is Spark jobs
#: over all rows. Nothing is left out either way.
SEARCH_ROWS = 2_000_000


def spread(rows: DataFrame, count: int) -> DataFrame:
    """Training rows over partitions that keep every slot busy: a stored table of few megabytes is one partition."""
    slots = rows.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, math.ceil(count / (slots * PARTITION_ROWS_MOST)))
    return rows.repartition(max(1, min(rounds * slots, math.ceil(count / PARTITION_ROWS))))


def fold_table(train: DataFrame, features: list[str], folds: int, seed: int) -> DataFrame:
    """(features, label, fold) of the training rows, assembled and stored once for all fits."""
    keyed = stratified_folds(train, LABEL, [k for k in KEY if k in train.columns], folds, seed)
    packed = assembler(features).transform(fill_missing(keyed, features)).select(FEATURES, LABEL, FOLD)
    return materialize(packed, "search-folds")


def cross_validate(
    algorithm: str,
    table: DataFrame,
    settings: list[dict],
    folds: int,
    balance: ClassBalance,
    metric: str = "auc",
    seed: int = 42,
    parallelism: int | None = None,
) -> list[float]:
    """Mean held-out score of each of the settings over the folds of a ``fold_table``, every (setting, fold) a fit.

    Every fit takes all rows outside its fold. Trees are fitted one to a task up to ``SEARCH_ROWS`` rows; above, and for linear
    models, a fit is Spark jobs, as many at once as the session has slots.
    """
    spark = table.sparkSession
    if algorithm in tree_search.FITS and balance.rows <= SEARCH_ROWS:
        weights = [balance.weights(s.get("class_weight")) for s in settings]
        rows = tree_search.collected(table, balance.rows)
        scores = tree_search.fold_scores(rows, algorithm, settings, weights, folds, metric, seed, spark)
        return [sum(s) / folds for s in scores]
    cached = spread(table, balance.rows).persist()
    evaluator = search_evaluator(metric)

    def score_of(job: tuple[int, int]) -> tuple[int, int, float]:
        number, fold = job
        params = settings[number]
        rows = cached.where(F.col(FOLD) != fold)
        if algorithm == "random_forest":
            model = forest.fit(
                estimator(algorithm, balance.rows, seed, **params), rows, balance.rows, balance.weights(params.get("class_weight"))
            )
        else:
            weighted = with_class_weight(rows, balance, params.get("class_weight"))
            model = estimator(algorithm, balance.rows, seed, **params).fit(weighted)
        return number, fold, evaluator.evaluate(model.transform(cached.where(F.col(FOLD) == fold)))

    work = [(number, fold) for number in range(len(settings)) for fold in range(folds)]
    scores = [[0.0] * folds for _ in settings]
    try:
        with ThreadPool(min(parallelism or spark.sparkContext.defaultParallelism, len(work) or 1)) as pool:
            for number, fold, score in pool.imap_unordered(inheritable_thread_target(spark)(score_of), work):
                scores[number][fold] = score
    finally:
        cached.unpersist()
    return [sum(s) / folds for s in scores]


def random_search(
    algorithm: str,
    train: DataFrame,
    features: list[str],
    config: TrainingConfig = TrainingConfig(),
    space: dict[str, list] | None = None,
    parallelism: int | None = None,
) -> SearchResult:
    """Seeded random search over stratified folds; the winner (the first drawn, if several are equal) is the only
    one fitted by Spark on all rows."""
    seed = config.random_state
    balance = ClassBalance.of(train)
    table = fold_table(train, features, config.cv_folds, seed)
    drawn = draw_settings(space or SEARCH_SPACES[algorithm], config.search_draws, seed)
    settings = [{"class_weight": config.class_weight, **s} for s in drawn]  # where the space has no weights
    scores = cross_validate(
        algorithm, table, settings, config.cv_folds, balance, config.search_metric, seed, parallelism
    )
    best = max(range(len(settings)), key=lambda i: (scores[i], -i))
    model = fit_packed(algorithm, table, balance, seed, **settings[best])
    return SearchResult(PipelineModel([assembler(features), model]), settings[best], scores[best])


def fit_packed(
    algorithm: str, table: DataFrame, balance: ClassBalance, seed: int = 42, class_weight: str | float | None = None,
    **params,
) -> Model:
    """One model over rows whose features are a vector already. Forests have jobs of their own (``forest.fit``)."""
    chosen = estimator(algorithm, balance.rows, seed, **params)
    if algorithm == "random_forest":
        return forest.fit(chosen, table, balance.rows, balance.weights(class_weight))
    return fit_dealt(chosen, with_class_weight(spread(table, balance.rows), balance, class_weight))


def fit_dealt(chosen: Estimator, rows: DataFrame) -> Model:
    """One model over rows that ``spread`` has dealt out. Spark's linear estimator would have them dealt out four times, to
    log their partitions, to fit and for two training summaries; they are kept while it runs."""
    if not isinstance(chosen, LogisticRegression):
        return chosen.fit(rows)
    kept = rows.select(FEATURES, LABEL, WEIGHT).persist()
    try:
        return chosen.fit(kept)
    finally:
        kept.unpersist()


def fit(
    algorithm: str,
    train: DataFrame,
    features: list[str],
    seed: int = 42,
    class_weight: str | float | None = None,
    **params,
) -> PipelineModel:
    """One model with the settings given, and the assembler of its features before it."""
    balance, packer = ClassBalance.of(train), assembler(features)
    if algorithm == "random_forest":
        packed = packer.transform(fill_missing(train, features))
        return PipelineModel([packer, fit_packed(algorithm, packed, balance, seed, class_weight, **params)])
    dealt = fill_missing(spread(train.select(*features, LABEL), balance.rows), features)
    packed = packer.transform(with_class_weight(dealt, balance, class_weight))
    return PipelineModel([packer, fit_dealt(estimator(algorithm, balance.rows, seed, **params), packed)])


# --- scoring --------------------------------------------------------------------------------------
def probability(model: Model, rows: DataFrame, features: list[str], name: str) -> DataFrame:
    """``rows``, unchanged, plus the probability of class 1 under ``name``."""
    packed = rows.select(F.struct("*").alias("_row"), *features)
    scored = model.transform(fill_missing(packed, features))
    return scored.select("_row.*", vector_to_array(F.col("probability"))[1].alias(name))


def score(model: Model, rows: DataFrame, features: list[str], algorithm: str) -> DataFrame:
    """Prediction rows: key, algorithm, probability and time."""
    scored = probability(model, rows, features, "model_predictions")
    return scored.select(
        *KEY,
        F.lit(algorithm).alias("model_algorithm"),
        "model_predictions",
        F.current_timestamp().alias("prediction_timestamp"),
    )


def label_scored(predictions: DataFrame, algorithm: str) -> DataFrame:
    """Add the constant columns of a prediction table to bare scores."""
    return predictions.withColumns(
        {"model_algorithm": F.lit(algorithm), "prediction_timestamp": F.current_timestamp()}
    )


def soft_vote(predictions: DataFrame, algorithms: list[str] = fv.ALGORITHMS) -> DataFrame:
    """Mean probability of the named models per row, as one more algorithm."""
    chosen = predictions.where(F.col("model_algorithm").isin(*algorithms))
    return chosen.groupBy(*KEY).agg(
        F.lit("voting_ensemble").alias("model_algorithm"),
        F.avg("model_predictions").alias("model_predictions"),
    )


def fit_together(
    work: dict[tuple, tuple[str, DataFrame, list[str], dict]], seed: int = 42, parallelism: int | None = None
) -> dict[tuple, PipelineModel]:
    """Independent fits (algorithm, rows, features, settings), as many at once as the session has slots."""
    if not work:
        return {}
    session = next(iter(work.values()))[1].sparkSession

    def one(key: tuple) -> tuple[tuple, PipelineModel]:
        algorithm, rows, features, settings = work[key]
        return key, fit(algorithm, rows, features, seed, **settings)

    with ThreadPool(min(parallelism or session.sparkContext.defaultParallelism, len(work))) as pool:
        return dict(pool.imap_unordered(inheritable_thread_target(session)(one), work))


def out_of_fold(
    algorithms: list[str], train: DataFrame, features: list[str], folds: int = 3, seed: int = 42,
    settings: dict[str, dict] | None = None,
) -> DataFrame:
    """Probabilities of each base model on rows it was not fitted on; all fits run together."""
    folded = materialize(stratified_folds(train, LABEL, KEY, folds, seed), "folds")
    given = settings or {}
    work = {
        (i, a): (a, folded.where(F.col(FOLD) != i), features, given.get(a, {})) for i in range(folds) for a in algorithms
    }
    models, parts = fit_together(work, seed), None
    for i in range(folds):
        held = folded.where(F.col(FOLD) == i)
        for algorithm in algorithms:
            held = probability(models[i, algorithm], held, features, f"p_{algorithm}")
        parts = held if parts is None else parts.unionByName(held)
    return materialize(parts, "out-of-fold")


@dataclass
class StackedModel:
    base: dict[str, PipelineModel]
    meta: PipelineModel
    features: list[str]

    def score(self, rows: DataFrame) -> DataFrame:
        scored = rows
        for algorithm, model in self.base.items():
            scored = probability(model, scored, self.features, f"p_{algorithm}")
        return probability(self.meta, scored, [f"p_{a}" for a in self.base], "model_predictions").drop(
            *[f"p_{a}" for a in self.base]
        )


def stack(
    algorithms: list[str], train: DataFrame, features: list[str], folds: int = 3, seed: int = 42,
    settings: dict[str, dict] | None = None,
) -> StackedModel:
    """Logistic meta model over out-of-fold probabilities; base models refitted on all rows."""
    settings = settings or {}
    held_out = out_of_fold(algorithms, train, features, folds, seed, settings)
    meta = fit("logistic_regression", held_out, [f"p_{a}" for a in algorithms], seed)
    whole = fit_together({(a,): (a, train, features, settings.get(a, {})) for a in algorithms}, seed)
    return StackedModel({a: whole[a,] for a in algorithms}, meta, features)


# --- inspection and persistence ------------------------------------------------------------------
IMPORTANCE = T.StructType(
    [
        T.StructField("algorithm", T.StringType()),
        T.StructField("method", T.StringType()),
        T.StructField("feature", T.StringType()),
        T.StructField("importance", T.DoubleType()),
    ]
)


def feature_importance(spark: SparkSession, model: PipelineModel, algorithm: str) -> DataFrame:
    """(algorithm, method, feature, importance): coefficients or tree importances, each under
    the name the assembler gave its column."""
    names = model.stages[0].getInputCols()
    fitted = model.stages[-1]
    linear = hasattr(fitted, "coefficients")
    values = (fitted.coefficients if linear else fitted.featureImportances).toArray()
    method = "coefficients" if linear else "feature_importances"
    rows = [(algorithm, method, n, float(v)) for n, v in zip(names, values, strict=True)]
    return spark.createDataFrame(rows, IMPORTANCE)


def top_features(importance: DataFrame, limit: int = 20) -> DataFrame:
    """The features of greatest absolute importance: a top-k report."""
    return importance.orderBy(F.abs("importance").desc(), "feature").limit(limit)


def save_model(model: PipelineModel, root: str, algorithm: str, version: str) -> str:
    path = f"{root}/{algorithm}/v{version}/model"
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
