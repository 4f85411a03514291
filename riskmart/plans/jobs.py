"""The jobs of the mart: load, preprocess, train, score, monitor, decide, compare.

Each job is one function over tables. A run covers every month it is given in one plan per
output table; rerunning it replaces exactly the partitions it covers.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv
from .. import schemas
from ..config import RiskConfig, Thresholds
from ..functions.dates import snapshot_month, with_split
from ..operators import drift, governance, layers, metrics, monitoring, quality, registry, scaling, training
from ..session import prepare
from ..sources import readers, version_index, writers
from ..sources.scratch import materialize


@dataclass(frozen=True)
class Mart:
    """Folder layout below one base URI (local, S3A, HDFS, ...)."""

    base: str

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    @property
    def labels(self) -> str:
        return f"{self.base}/gold/label_store"

    @property
    def features(self) -> str:
        return readers.feature_source(self.base)

    @property
    def uploads(self) -> str:
        return readers.feature_source(self.base, uploaded=True)

    @property
    def preprocessed(self) -> str:
        return f"{self.base}/gold/preprocessed"

    @property
    def predictions(self) -> str:
        return f"{self.base}/gold/model_predictions"

    @property
    def monitoring(self) -> str:
        return f"{self.base}/gold/model_monitoring"

    @property
    def governance(self) -> str:
        return f"{self.base}/gold/model_governance"

    @property
    def registry(self) -> str:
        return f"{self.base}/models"

    @property
    def comparison(self) -> str:
        return f"{self.registry}/comparison"

    @property
    def monitoring_reports(self) -> str:
        return f"{self.registry}/monitoring"

    @property
    def prediction_metadata(self) -> str:
        return f"{self.base}/gold/model_prediction_metadata"

    @property
    def triggers(self) -> str:
        return f"{self.base}/triggers"


def load(
    spark: SparkSession,
    raw: DataFrame,
    mart: Mart,
    first: date | None = None,
    last: date | None = None,
    bronze_format: str = "parquet",
) -> DataFrame:
    """Raw rows to bronze, silver and both gold stores, one write each; only bronze is shuffled, as
    its files hold one month each. Returns the row counts of the loaded months (lazy)."""
    prepare(spark)
    for path in (mart.bronze, mart.silver, mart.labels, mart.features):
        readers.refuse_stream_table(spark, path)
    writers.write_months(layers.bronze(raw, first, last), mart.bronze, bronze_format)
    read = readers.read_csv_table if bronze_format == "csv" else readers.read_table
    bronze = _window(read(spark, mart.bronze, schemas.RAW_ENCOUNTER), first, last)
    writers.write_months(layers.silver(bronze), mart.silver, grouped=True)
    silver = _window(readers.read_table(spark, mart.silver, schemas.ENCOUNTER), first, last)
    writers.write_months(layers.label_store(silver), mart.labels, grouped=True)
    writers.write_months(layers.feature_store(silver), mart.features, grouped=True)
    labels = _window(readers.read_table(spark, mart.labels, schemas.LABEL_STORE), first, last)
    features = _window(readers.read_table(spark, mart.features, schemas.FEATURE_STORE), first, last)
    return layers.rows_per_layer(
        {"bronze": bronze, "silver": silver, "label_store": labels, "feature_store": features}
    )


def _window(rows: DataFrame, first: date | None, last: date | None) -> DataFrame:
    """Prune to the months of a run, by partition directory."""
    if first is not None:
        rows = rows.where(F.col(readers.MONTH) >= first.strftime("%Y-%m"))
    if last is not None:
        rows = rows.where(F.col(readers.MONTH) <= last.strftime("%Y-%m"))
    return rows


def model_table(spark: SparkSession, mart: Mart, config: RiskConfig) -> DataFrame:
    """Labels joined to features within the three windows, with ``split``.

    The date filter sits on both inputs before the join, so both scans are pruned.
    """
    first, last = config.splits.train.start, config.splits.oot.end
    labels = readers.months_between(readers.read_table(spark, mart.labels, schemas.LABEL_STORE), first, last)
    features = readers.months_between(
        readers.read_table(spark, mart.features, schemas.FEATURE_STORE), first, last
    )
    joined = layers.model_rows(labels.drop(readers.MONTH), features.drop(readers.MONTH))
    return with_split(joined, config.splits)


def stage(rows: DataFrame) -> DataFrame:
    """The joined rows with their split, stored once: everything after reads them without the join."""
    return materialize(rows.select(*training.KEY, *fv.MODEL_FEATURES, "label", "split"), "model-rows")


def store_run(spark: SparkSession, staged: DataFrame, path: str, run: str) -> str:
    """Fit the scaler on the staged train rows, store the scaled splits, the scaler and the metadata as one run."""
    scaled, scaler = scaling.preprocess(staged)
    metadata = staged.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col("label").cast("double")).alias("positive_rate")
    )
    return writers.write_splits(scaled.select(*staged.columns), scaler.table(spark), metadata, path, run)


def preprocess(spark: SparkSession, mart: Mart, config: RiskConfig, run: str) -> str:
    """Split, fit the scaler on train, scale all splits, store them as one run.

    The join runs once. A run whose rows fail a gate is not stored.
    """
    staged = stage(model_table(spark, mart, config))
    quality.enforce(quality.measure(staged, quality.training_gates(config.gates)))
    return store_run(spark, staged, mart.preprocessed, run)


#: Rows of a stored run: scaled features are fractions.
SPLIT_ROWS = T.StructType(
    [
        T.StructField("encounter_id", T.LongType()),
        T.StructField("snapshot_date", T.DateType()),
        *[T.StructField(f, T.DoubleType()) for f in fv.MODEL_FEATURES],
        T.StructField("label", T.IntegerType()),
    ]
)


def store_baseline(
    spark: SparkSession, staged: DataFrame, scored: DataFrame, path: str, features: list[str] = fv.MODEL_FEATURES
) -> DataFrame:
    """The files that later months are held against, below ``path``: ``features`` (JSON), ``baseline`` statistics of the
    train rows (JSON), ``drift`` from train to out-of-time (CSV) and ``thresholds`` (JSON). Returns the drift table.

    ``staged`` has the features by split, ``scored`` the scores and labels by split of the model that is watched.
    """
    order = [(i, name) for i, name in enumerate(features)]
    writers.write_json(spark.createDataFrame(order, "position int, feature string").coalesce(1), f"{path}/features")
    train = staged.where(F.col("split") == "train")
    writers.write_json(drift.baseline_statistics(train, features), f"{path}/baseline")
    found = materialize(drift.drift_table(staged, features), "drift")
    writers.write_csv(found, f"{path}/drift", decimals={c: 6 for c in ("ks_stat", "p_value", "psi")})
    out_of_time = scored.where(F.col("split") == "oot")
    auc = metrics.roc_auc(out_of_time, ["split"], "model_predictions", "label")
    rate = out_of_time.groupBy("split").agg(F.avg("model_predictions").alias("pred_rate"))
    observed = auc.join(rate, "split").withColumn("gini", metrics.gini(F.col("auc")))
    writers.write_json(governance.monitoring_thresholds(observed), f"{path}/thresholds")
    return found


def load_run(spark: SparkSession, run_path: str) -> tuple[DataFrame, scaling.Scaler]:
    """The splits and the scaler of a preprocessing run."""
    table = spark.read.schema(scaling.SCALER_SCHEMA).parquet(f"{run_path}/scaler")
    return readers.read_splits(spark, run_path, SPLIT_ROWS), scaling.Scaler.from_table(table)


def train(
    spark: SparkSession,
    mart: Mart,
    run_path: str,
    algorithm: str,
    version: str,
    config: RiskConfig,
    space: dict | None = None,
) -> str:
    """Search, evaluate on test and OOT, and register one algorithm; returns the path of the model.

    A version exists from the moment its index row is committed, which comes last; versions beyond the newest ten of
    the algorithm are deleted then.
    """
    splits, _ = load_run(spark, run_path)
    gates = [*(quality.split_rows(s) for s in registry.SPLITS), quality.both_classes("train")]
    quality.enforce(quality.measure(splits, gates))
    rows = splits.where(F.col("split") == "train").select(*training.KEY, *fv.MODEL_FEATURES, "label")
    found = training.random_search(algorithm, rows, fv.MODEL_FEATURES, config.training, space)
    held_out = splits.where(F.col("split") != "train")
    scored = training.probability(found.model, held_out, fv.MODEL_FEATURES, "model_predictions")
    evaluation = metrics.evaluate(
        scored, ["split"], "model_predictions", "label", config.prediction_threshold
    ).select(F.lit(algorithm).alias("algorithm"), F.lit(version).alias("version"), "*")
    samples = splits.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    importance = training.feature_importance(spark, found.model, algorithm)
    documents = registry.performance_documents(
        evaluation, samples, importance, splits=config.splits, feature_count=len(found.model.stages[0].getInputCols())
    )
    documents = materialize(documents, "performance")  # one row, which three files and the index take
    path = training.save_model(found.model, mart.registry, algorithm, version)
    enabled = config.training.enabled_algorithms()
    register(spark, mart, documents, registry.model_metadata(documents, found.params, found.score, enabled))
    return path


def register(spark: SparkSession, mart: Mart, documents: DataFrame, metadata: DataFrame | None = None) -> int:
    """Store the documents of saved versions and commit them to the version index; returns the snapshot number.

    ``documents`` are performance documents, any number of versions of any algorithms.
    """
    index = registry.version_index(documents, mart.registry)
    for row in index.select("algorithm", "version", "performance_path", "metadata_path").collect():
        own = (F.col("algorithm") == row.algorithm) & (F.col("version") == row.version)
        writers.write_json(documents.where(own), row.performance_path)
        writers.write_json((documents if metadata is None else metadata).where(own), row.metadata_path)
    return version_index.commit(spark, mart.registry, index)


def latest_model(spark: SparkSession, mart: Mart, algorithm: str) -> str:
    """Path of the newest registered model of an algorithm."""
    newest = version_index.latest(spark, mart.registry).where(F.col("algorithm") == algorithm).first()
    if newest is None:
        raise ValueError(f"no version of {algorithm!r} is registered in {mart.registry}")
    return newest.model_path


def performance(spark: SparkSession, mart: Mart) -> DataFrame:
    """The performance document of the newest registered version of each algorithm."""
    documents = spark.read.schema(schemas.PERFORMANCE_DOCUMENT).option("recursiveFileLookup", True).option(
        "pathGlobFilter", "*.json"
    ).json(f"{mart.registry}/*/*/performance")
    newest = version_index.latest(spark, mart.registry).select("algorithm", "version")
    return documents.join(newest, ["algorithm", "version"], "left_semi")


def compare(spark: SparkSession, mart: Mart, config: RiskConfig) -> DataFrame:
    """Comparison rows of the newest version of each enabled algorithm, in configured order.

    For two models or more the comparison is also stored, as a JSON document and a CSV file of the newest comparison.
    """
    order = config.training.enabled_algorithms()
    position = F.array_position(F.array(*[F.lit(a) for a in order]), F.col("model"))
    rows = registry.flatten_documents(performance(spark, mart))
    compared = materialize(rows.where(F.col("model").isin(*order)).withColumn("position", position), "comparison")
    if compared.count() >= 2:
        writers.write_json(registry.comparison_document(compared), f"{mart.comparison}/json")
        # As many rows as algorithms, in order: one file.
        writers.write_csv(registry.comparison_file(compared).coalesce(1), f"{mart.comparison}/csv")
    return compared


def pick_algorithm(comparison: DataFrame | None, override: str | None = None) -> str:
    """Override, else recommendation, else default."""
    if override:
        return override
    if comparison is None:
        return fv.DEFAULT_ALGORITHM
    return registry.chosen_model(registry.recommendation(comparison)).first()["algorithm"]


def score_month(
    spark: SparkSession,
    mart: Mart,
    model_path: str,
    run_path: str,
    algorithm: str,
    month: date,
    uploaded: bool = False,
) -> DataFrame:
    """Score one month of the feature store (or of the uploads) and store the predictions."""
    source = mart.uploads if uploaded else mart.features
    features = readers.month_of(readers.read_table(spark, source, schemas.FEATURE_STORE), month)
    quality.require_rows(features, f"features of {month:%Y-%m}")
    _, scaler = load_run(spark, run_path)
    scaled = scaler.transform(features, fv.MODEL_FEATURES)
    predictions = training.score(training.load_model(model_path), scaled, fv.MODEL_FEATURES, algorithm)
    return store_predictions(spark, mart, predictions, algorithm, month)


def store_predictions(spark: SparkSession, mart: Mart, predictions: DataFrame, algorithm: str, month: date) -> DataFrame:
    """Store the scores of a month and a metadata record of them; returns the stored rows."""
    writers.write_predictions(predictions, mart.predictions)
    table = readers.month_of(readers.read_table(spark, mart.predictions, schemas.PREDICTIONS), month)
    stored = table.where(F.col("model_algorithm") == algorithm)
    record = stored.agg(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.lit(month.isoformat()).alias("snapshot_date"),
        F.lit(algorithm).alias("algorithm"),
        F.count(F.lit(1)).alias("num_predictions"),
        F.avg("model_predictions").alias("avg_probability"),
        F.lit(f"{mart.predictions}/model_algorithm={algorithm}/{readers.MONTH}={month:%Y-%m}").alias("predictions_path"),
    )
    writers.write_json(record, f"{mart.prediction_metadata}/{algorithm}/{month:%Y-%m}")
    return stored


def monitor(spark: SparkSession, mart: Mart, limits: Thresholds = Thresholds()) -> DataFrame:
    """Monitor all algorithms and months that have predictions and labels; store the table and a report per model.
    No month in common is an error."""
    predictions = readers.read_table(spark, mart.predictions, schemas.PREDICTIONS).drop(readers.MONTH)
    labels = readers.read_table(spark, mart.labels, schemas.LABEL_STORE)
    writers.write_parquet(monitoring.monitor(layers.scored_rows(predictions, labels)), mart.monitoring)
    stored = spark.read.schema(schemas.MONITORING).parquet(mart.monitoring)
    quality.enforce(quality.measure(stored, [quality.has_rows("monitored_months")]))
    writers.write_json(monitoring.monitoring_documents(stored, limits), mart.monitoring_reports)
    return stored


def govern(
    monitored: DataFrame, mart: Mart, limits: Thresholds = Thresholds(), auto_retrain: bool = False
) -> DataFrame:
    """Decide on the newest month of every model; store records and retrain triggers."""
    decided = governance.decide(monitoring.latest(monitored), limits, auto_retrain)
    writers.write_json(governance.governance_documents(decided, limits), mart.governance)
    writers.write_json(governance.retrain_triggers(decided), mart.triggers)
    return decided


def monitor_and_decide(predictions: DataFrame, labels: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    """Which models have degraded in which month, and must they be retrained?

    Join, metrics, status and decision as one lazy plan over all models and months.
    """
    return monitor_rows(layers.scored_rows(predictions, labels), limits)


def monitor_rows(scored: DataFrame, limits: Thresholds = Thresholds()) -> DataFrame:
    monitored = monitoring.with_status(monitoring.monitor(scored), limits)
    return governance.decide(monitored, limits)


def with_months(rows: DataFrame) -> DataFrame:
    return rows.withColumn("snapshot_month", snapshot_month(F.col("snapshot_date")))
