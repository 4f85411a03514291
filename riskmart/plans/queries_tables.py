"""Registered queries: scans, sinks, projections, joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixed_values as fv
from .. import schemas
from ..functions import dates, encounter
from ..operators import drift, layers, monitoring, quality, registry, scaling
from ..operators import metrics as m
from ..sources import readers, writers
from ..sources.scratch import materialize
from . import check_sql as c
from . import jobs
from .catalog import CONFIG, MONTH, SPLITS, Tables, query, r6, r6_sql

MONTH_SQL = "DATE '1998-07-01'"
RAW_SAMPLE = ["encounter_id", "race", "age", "diag_1", "max_glu_serum", "A1Cresult", "glyburide-metformin", "readmitted", "snapshot_date"]
# An empty text and a missing one are the same in a CSV file.
RAW_SQL = ", ".join(f"nullif({c.quote(n)}, '') AS {c.quote(n)}" for n in RAW_SAMPLE)
LABELS_SQL = "SELECT encounter_id, label, snapshot_date FROM labels"


# --- S: scans -------------------------------------------------------------------------------------
@query("s1_csv_scan", c.with_blocks(f"SELECT {RAW_SQL} FROM raw", "raw"))
def _(t: Tables):
    path = t.path("raw-csv")
    writers.write_csv(t.raw, path)
    return readers.read_csv(t.spark, path, schemas.RAW_ENCOUNTER).select(*[F.col(f"`{n}`") for n in RAW_SAMPLE])


@query(
    "s2_csv_month_scan",
    c.with_blocks(
        "SELECT encounter_id, patient_nbr, diag_1, snapshot_date, '1998-07' AS snapshot_month FROM raw "
        "WHERE snapshot_date = '1998-07-01'",
        "raw",
    ),
)
def _(t: Tables):
    path = t.path("bronze-csv")
    writers.write_months(t.bronze, path, "csv")
    table = readers.read_csv_table(t.spark, path, schemas.RAW_ENCOUNTER)
    return table.where(F.col("snapshot_month") == "1998-07").select(
        "encounter_id", "patient_nbr", "diag_1", "snapshot_date", "snapshot_month"
    )


@query(
    "s3_parquet_month_scan",
    c.with_blocks(
        f"SELECT encounter_id, race, num_medications, snapshot_date FROM silver WHERE snapshot_date = {MONTH_SQL}",
        "silver",
    ),
)
def _(t: Tables):
    path = t.path("silver")
    writers.write_months(t.silver, path)
    month = readers.month_of(readers.read_table(t.spark, path, schemas.ENCOUNTER), MONTH)
    return month.select("encounter_id", "race", "num_medications", "snapshot_date")


@query(
    "s4_merged_schema_scan",
    c.with_blocks(
        "SELECT encounter_id, is_female, CASE WHEN snapshot_date >= DATE '1999-01-01' THEN "
        "round(medication_density, 6) END AS medication_density, snapshot_date FROM features",
        "features",
    ),
)
def _(t: Tables):
    # The older months were written before medication_density existed.
    path = t.path("features-grown")
    old = F.col("snapshot_date") < F.lit(SPLITS.test.start)
    writers.write_months(t.features.where(old).drop("medication_density"), path)
    writers.write_months(t.features.where(~old), path)
    merged = readers.read_table_merged(t.spark, path)
    return merged.select("encounter_id", "is_female", r6("medication_density"), "snapshot_date")


@query("s5_recursive_scan", c.with_blocks(LABELS_SQL, "labels"))
def _(t: Tables):
    path = t.path("labels")
    writers.write_months(t.labels, f"{path}/store/v1")
    return readers.read_tree(t.spark, path, schemas.LABEL_STORE)


@query("s6_multi_path_scan", c.with_blocks(LABELS_SQL, "labels"))
def _(t: Tables):
    path = t.path("labels")
    writers.write_months(t.labels, path)
    centuries = [f"{path}/snapshot_month={c}*" for c in ("19", "20")]
    return readers.read_paths(t.spark, centuries, schemas.LABEL_STORE)


@query(
    "s7_month_or_full_scan",
    c.with_blocks(
        "SELECT 'partition' AS source, encounter_id, label, snapshot_date FROM labels "
        f"WHERE snapshot_date = {MONTH_SQL} UNION ALL "
        f"SELECT 'tree', encounter_id, label, snapshot_date FROM labels WHERE snapshot_date = {MONTH_SQL}",
        "labels",
    ),
)
def _(t: Tables):
    by_month, flat = t.path("labels"), t.path("labels-flat")
    writers.write_months(t.labels, by_month)
    writers.write_parquet(t.labels, flat)
    found = []
    for source, root in [("partition", by_month), ("tree", flat)]:
        rows = readers.month_or_scan(t.spark, root, MONTH, schemas.LABEL_STORE, whole_tree=source == "tree")
        found.append(rows.select(F.lit(source).alias("source"), "encounter_id", "label", "snapshot_date"))
    return layers.stack_rows(found)


SNAPSHOT_FEATURES = ["encounter_id", "age_midpoint", "insulin_ord", "severity_x_visits", "snapshot_date"]
SNAPSHOT_SQL = c.with_blocks(
    f"SELECT {', '.join(SNAPSHOT_FEATURES)} FROM features WHERE snapshot_date = {MONTH_SQL}", "features"
)


@query("s8_snapshot_feature_scan", SNAPSHOT_SQL)
def _(t: Tables):
    mart = t.mart()
    writers.write_months(t.features, mart.features)
    table = readers.read_table(t.spark, mart.features, schemas.FEATURE_STORE)
    return readers.months_between(table, MONTH, MONTH).select(*SNAPSHOT_FEATURES)


@query("s9_uploaded_feature_scan", SNAPSHOT_SQL)
def _(t: Tables):
    mart = t.mart()
    writers.write_months(t.features, mart.uploads)
    source = readers.feature_source(mart.base, uploaded=True)
    return readers.month_of(readers.read_table(t.spark, source, schemas.FEATURE_STORE), MONTH).select(
        *SNAPSHOT_FEATURES
    )


MONITORED = c.monitoring_blocks("scored")
MONITORED_COLUMNS = f"row_count, {r6_sql('auc', 'gini', 'psi')}"


@query(
    "s10_json_document_scan",
    c.with_blocks(
        f"SELECT model_algorithm AS algorithm, snapshot_month AS month, {MONITORED_COLUMNS}, "
        "(SELECT max(snapshot_month) FROM monitored) AS latest_snapshot_month FROM monitored",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    path = t.path("monitoring-json")
    writers.write_json(monitoring.monitoring_documents(monitoring.monitor(t.scored)), path)
    documents = readers.read_json_lines(t.spark, path, schemas.MONITORING_DOCUMENT)
    months = documents.select("algorithm", "latest_snapshot_month", F.inline("monthly_summary"))
    return months.select(
        "algorithm", "month", "row_count", r6("auc"), r6("gini"), r6("psi"), "latest_snapshot_month"
    )


@query(
    "s11_latest_run",
    c.with_blocks(
        "SELECT model_algorithm, snapshot_month AS version, count(*) AS rows FROM scored s WHERE snapshot_month = "
        "(SELECT max(snapshot_month) FROM scored x WHERE x.model_algorithm = s.model_algorithm) GROUP BY ALL",
        "scored",
    ),
)
def _(t: Tables):
    runs = t.scored.groupBy("model_algorithm", F.col("snapshot_month").alias("version")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    return readers.latest_run(runs, "version", ["model_algorithm"])


def _scaled_sql(column: str) -> str:
    value = f"ln(1 + CAST({column} AS DOUBLE))" if column in c.LOGGED else f"CAST({column} AS DOUBLE)"
    return (
        f"({value} - (SELECT avg({value}) FROM model_rows WHERE split = 'train')) / "
        f"(SELECT CASE WHEN stddev_pop({value}) = 0 THEN 1 ELSE stddev_pop({value}) END FROM model_rows WHERE split = 'train')"
    )


PREPROCESSED_SQL = c.with_blocks(
    "SELECT encounter_id, "
    + ", ".join(
        f"round({_scaled_sql(f)}, 6) AS {f}" if f in c.LOGGED + c.SCALED else f"CAST({f} AS DOUBLE) AS {f}"
        for f in c.STORED
    )
    + ", label, split FROM model_rows",
    "model_rows",
)


SAMPLES = {
    "samples": "SELECT count(*) FILTER (WHERE split = 'train') AS train_samples, count(*) FILTER (WHERE split = 'test') AS test_samples, "
    f"count(*) FILTER (WHERE split = 'oot') AS oot_samples FROM (SELECT {c.SPLIT} AS split FROM labels)"
}


def _scaled_output():
    scaled = fv.LOG_SCALE_COLUMNS + fv.SCALE_ONLY_COLUMNS
    return ["encounter_id", *[r6(f) if f in scaled else f for f in fv.MODEL_FEATURES], "label", "split"]


@query("s12_preprocessed_splits", PREPROCESSED_SQL)
def _(t: Tables):
    run = jobs.store_run(t.spark, jobs.stage(t.model_rows), t.mart().preprocessed, "20010801_000000")
    return readers.read_splits(t.spark, run, jobs.SPLIT_ROWS).select(*_scaled_output())


# --- K: sinks -------------------------------------------------------------------------------------------
@query(
    "k1_bronze_write",
    c.with_blocks("SELECT snapshot_date AS day, count(*) AS rows, count(DISTINCT encounter_id) AS keys FROM raw GROUP BY 1", "raw"),
)
def _(t: Tables):
    path = t.path("bronze")
    for _attempt in range(2):  # the second write replaces the same partitions
        writers.write_months(t.bronze, path)
    table = readers.read_table(t.spark, path, schemas.RAW_ENCOUNTER)
    return table.groupBy(F.col("snapshot_date").alias("day")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("encounter_id").alias("keys")
    )


@query(
    "k2_gold_write",
    c.with_blocks(
        "SELECT strftime(snapshot_date, '%Y-%m') AS snapshot_month, count(*) AS rows, sum(label)::BIGINT AS positives, "
        "sum(is_female)::BIGINT AS women FROM labels JOIN features USING (encounter_id, snapshot_date) GROUP BY 1",
        "labels",
        "features",
    ),
)
def _(t: Tables):
    mart = t.mart()
    jobs.load(t.spark, t.raw, mart)
    jobs.load(t.spark, t.raw, mart, first=SPLITS.test.start, last=SPLITS.test.end)  # rerun of two years
    labels = readers.read_table(t.spark, mart.labels, schemas.LABEL_STORE)
    features = readers.read_table(t.spark, mart.features, schemas.FEATURE_STORE).drop("snapshot_month")
    return layers.model_rows(labels, features).groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.sum("is_female").alias("women")
    )


@query(
    "k2_incremental_load",
    c.with_blocks(
        "SELECT strftime(snapshot_date, '%Y-%m') AS snapshot_month, count(*) AS rows, sum(label)::BIGINT AS positives, "
        "sum(is_female)::BIGINT AS women FROM labels JOIN features USING (encounter_id, snapshot_date) GROUP BY 1",
        "labels",
        "features",
    ),
)
def _(t: Tables):
    from ..streaming.incremental import load_new_files

    mart, landing, checkpoints = t.mart(), t.path("landing"), t.path("stream-checkpoints")
    early = F.col("snapshot_date") < "1999-01-01"
    writers.write_csv(t.raw.where(early), f"{landing}/first")
    load_new_files(t.spark, f"{landing}/*", mart, checkpoints)
    writers.write_csv(t.raw.where(~early), f"{landing}/second")
    load_new_files(t.spark, f"{landing}/*", mart, checkpoints)  # only the new files are read
    labels = readers.read_table(t.spark, mart.labels, schemas.LABEL_STORE)
    features = readers.read_table(t.spark, mart.features, schemas.FEATURE_STORE).drop("snapshot_month")
    return layers.model_rows(labels, features).groupBy("snapshot_month").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"), F.sum("is_female").alias("women")
    )


@query(
    "k3_preprocessing_run",
    c.with_blocks(
        "SELECT split, count(*) AS rows, round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate FROM model_rows GROUP BY split",
        "model_rows",
    ),
)
def _(t: Tables):
    mart = t.mart()
    writers.write_months(t.labels, mart.labels)
    writers.write_months(t.features, mart.features)
    run = jobs.preprocess(t.spark, mart, CONFIG, "20010801_000000")
    metadata = t.spark.read.schema("split string, rows long, positive_rate double").json(f"{run}/metadata")
    return metadata.select("split", "rows", r6("positive_rate"))


def _stamped(t: Tables):
    return t.predictions.withColumn("prediction_timestamp", F.current_timestamp())


@query(
    "k4_prediction_metadata",
    c.with_blocks(
        f"SELECT model_algorithm AS algorithm, '{MONTH.isoformat()}' AS snapshot_date, count(*) AS num_predictions, "
        "round(avg(model_predictions), 6) AS avg_probability, "
        f"'model_algorithm=' || model_algorithm || '/snapshot_month={MONTH:%Y-%m}' AS stored_at "
        f"FROM preds WHERE strftime(snapshot_date, '%Y-%m') = '{MONTH:%Y-%m}' GROUP BY model_algorithm",
        "preds",
    ),
)
def _(t: Tables):
    mart = t.mart()
    month = _stamped(t).where(dates.in_month(F.col("snapshot_date"), MONTH))
    for algorithm in fv.ALGORITHMS:
        jobs.store_predictions(t.spark, mart, month.where(F.col("model_algorithm") == algorithm), algorithm, MONTH)
    records = t.spark.read.schema(schemas.PREDICTION_METADATA).json(f"{mart.prediction_metadata}/*/*")
    return records.select(
        "algorithm",
        "snapshot_date",
        "num_predictions",
        r6("avg_probability"),
        F.replace("predictions_path", F.lit(f"{mart.predictions}/"), F.lit("")).alias("stored_at"),
    )


@query(
    "k4_predictions_write",
    c.with_blocks(
        "SELECT model_algorithm, encounter_id, snapshot_date, round(model_predictions, 6) AS model_predictions FROM preds "
        "WHERE snapshot_date = (SELECT max(snapshot_date) FROM preds)",
        "preds",
    ),
)
def _(t: Tables):
    path = t.path("predictions")
    writers.write_predictions(_stamped(t), path)
    table = readers.read_table(t.spark, path, schemas.PREDICTIONS)
    newest = table.agg(F.max("snapshot_month").alias("snapshot_month"))
    return table.join(F.broadcast(newest), "snapshot_month").select(
        "model_algorithm", "encounter_id", "snapshot_date", r6("model_predictions")
    )


@query(
    "k5_json_report",
    c.with_blocks(
        f"SELECT model_algorithm AS algorithm, snapshot_month AS latest_snapshot_month, {c.DECISION} AS decision, "
        f"{c.REASON} AS reason, {r6_sql('auc', 'psi')}, row_count FROM monitored m WHERE snapshot_month = "
        "(SELECT max(snapshot_month) FROM monitored x WHERE x.model_algorithm = m.model_algorithm)",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    mart = t.mart()
    jobs.govern(monitoring.monitor(t.scored), mart)
    schema = (
        "algorithm string, latest_snapshot_month string, decision string, reason string, "
        "metrics struct<auc:double,gini:double,psi:double,row_count:bigint>"
    )
    records = t.spark.read.schema(schema).json(mart.governance)
    return records.select(
        "algorithm",
        "latest_snapshot_month",
        "decision",
        "reason",
        r6(F.col("metrics.auc")).alias("auc"),
        r6(F.col("metrics.psi")).alias("psi"),
        F.col("metrics.row_count").alias("row_count"),
    )


EVALUATED = c.evaluation_blocks("split_scores", "model_algorithm, split")
METRIC_PAIRS = [(s, name, "auc" if name == "auc_roc" else name) for s in ("test", "oot") for name in fv.METRICS]
WIDE_SQL = (
    "SELECT model_algorithm AS model, "
    + ", ".join(f"max({n}) FILTER (WHERE split = '{s}') AS {s}_{short}" for s, n, short in METRIC_PAIRS)
    + " FROM evaluated GROUP BY model_algorithm"
)


def _evaluation(t: Tables):
    return m.evaluate(t.split_scores, ["model_algorithm", "split"], "model_predictions", "label")


CSV_SQL = [
    (f"printf('%.4f', {n})" if n in registry.METRIC_COLUMNS else "'N/A'" if n == "top_feature" else n, header)
    for n, header in zip(registry.COMPARISON_COLUMNS, registry.CSV_HEADER, strict=True)
]


def registered(t: Tables) -> jobs.Mart:
    """A mart in whose registry the score tables' models stand as one version each."""
    mart = t.mart()
    evaluation = _evaluation(t).select(F.col("model_algorithm").alias("algorithm"), F.lit("20010801").alias("version"), "*")
    documents = registry.performance_documents(evaluation, label_samples(t), splits=SPLITS)
    jobs.register(t.spark, mart, materialize(documents, "documents"))
    return mart


@query(
    "k6_comparison_csv",
    c.with_blocks(
        "SELECT " + ", ".join(f'{value} AS "{header}"' for value, header in CSV_SQL) + " FROM wide CROSS JOIN samples",
        "split_scores",
        "labels",
        extra={**EVALUATED, "wide": WIDE_SQL, **SAMPLES},
    ),
)
def _(t: Tables):
    mart = registered(t)
    jobs.compare(t.spark, mart, CONFIG)
    kinds = ["string", *["long"] * 3, *["string"] * 15]
    schema = ", ".join(f"{header} {kind}" for header, kind in zip(registry.CSV_HEADER, kinds, strict=True))
    return t.spark.read.schema(schema).option("header", True).csv(f"{mart.comparison}/csv")


@query(
    "k5_comparison_json",
    c.with_blocks(
        "SELECT w.model, round(w.oot_gini, 6) AS oot_gini, round(w.test_auc, 6) AS test_auc, train_samples, "
        "(SELECT count(*) FROM wide) AS models_compared, (SELECT model FROM wide ORDER BY oot_gini DESC LIMIT 1) AS recommended_model "
        "FROM wide w CROSS JOIN samples",
        "split_scores",
        "labels",
        extra={**EVALUATED, "wide": WIDE_SQL, **SAMPLES},
    ),
)
def _(t: Tables):
    mart = registered(t)
    jobs.compare(t.spark, mart, CONFIG)
    row = "array<struct<model:string,oot_gini:double,test_auc:double,train_samples:bigint>>"
    schema = f"models_compared long, comparison_table {row}, recommended_model string"
    document = t.spark.read.schema(schema).json(f"{mart.comparison}/json")
    listed = document.select("models_compared", "recommended_model", F.inline("comparison_table"))
    return listed.select("model", r6("oot_gini"), r6("test_auc"), "train_samples", "models_compared", "recommended_model")


@query(
    "k5_monitoring_json",
    c.with_blocks(
        f"SELECT model_algorithm AS algorithm, snapshot_month AS month, {r6_sql('auc', 'gini', 'psi')}, row_count FROM monitored",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    mart = t.mart()
    writers.write_predictions(_stamped(t), mart.predictions)
    writers.write_months(t.labels, mart.labels)
    jobs.monitor(t.spark, mart)
    reports = t.spark.read.schema(schemas.MONITORING_DOCUMENT).json(mart.monitoring_reports)
    months = reports.select("algorithm", F.inline("monthly_summary"))
    return months.select("algorithm", "month", r6("auc"), r6("gini"), r6("psi"), "row_count")


@query(
    "k7_features_csv",
    c.with_blocks(
        "SELECT encounter_id, is_female, age_midpoint, round(medication_density, 6) AS medication_density, diag_1, "
        "snapshot_date FROM features",
        "features",
    ),
)
def _(t: Tables):
    path = t.path("features-csv")
    writers.write_csv(t.features, path)
    return readers.read_csv(t.spark, path, schemas.FEATURE_STORE).select(
        "encounter_id", "is_female", "age_midpoint", r6("medication_density"), "diag_1", "snapshot_date"
    )


@query(
    "k8_monitoring_parquet",
    c.with_blocks(
        f"SELECT model_algorithm, snapshot_month, {MONITORED_COLUMNS} FROM monitored", "scored", extra=MONITORED
    ),
)
def _(t: Tables):
    mart = t.mart()
    writers.write_predictions(_stamped(t), mart.predictions)
    writers.write_months(t.labels, mart.labels)
    return jobs.monitor(t.spark, mart).select(
        "model_algorithm", "snapshot_month", "row_count", r6("auc"), r6("gini"), r6("psi")
    )


@query(
    "k9_retrain_triggers",
    c.with_blocks(
        f"SELECT model_algorithm, snapshot_month, {c.DECISION} AS decision, {c.REASON} AS reason FROM monitored m "
        "WHERE (auc < 0.7 OR psi > 0.25) AND snapshot_month = "
        "(SELECT max(snapshot_month) FROM monitored x WHERE x.model_algorithm = m.model_algorithm)",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    mart = t.mart()
    jobs.govern(monitoring.monitor(t.scored), mart, auto_retrain=True)
    schema = "model_algorithm string, snapshot_month string, decision string, reason string"
    return t.spark.read.schema(schema).json(mart.triggers)


BASELINE_FEATURES = fv.MODEL_FEATURES


def baseline_blocks(source: str, features: list[str]) -> dict[str, str]:
    return {
        "long": c.feature_long(features, source),
        "stats": "SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
        "quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75 "
        "FROM long GROUP BY feature",
    }


STATS = ["mean", "std", "min", "max", "q25", "q50", "q75"]
BASELINE_SQL = c.with_blocks(
    f"SELECT feature, {r6_sql(*STATS)} FROM stats", "features", extra=baseline_blocks("features", BASELINE_FEATURES)
)


@query("k10_baseline_files", BASELINE_SQL)
def _(t: Tables):
    path = t.path("baseline-json")
    writers.write_json(drift.baseline_statistics(t.features, BASELINE_FEATURES), path)
    schema = ", ".join(["feature string", *[f"{s} double" for s in STATS]])
    return t.spark.read.schema(schema).json(path).select("feature", *[r6(s) for s in STATS])


DRIFT_FEATURES = fv.MODEL_FEATURES
DRIFTS = c.drift_blocks(DRIFT_FEATURES)
SCORE_FEATURES = [f"p_{a}" for a in fv.ALGORITHMS]
SCORE_DRIFTS = c.drift_blocks(SCORE_FEATURES, "wide_scores")


@query(
    "k10_drift_report_csv",
    c.with_blocks(
        "SELECT feature, printf('%.6f', ks_stat) AS ks_stat, printf('%.6f', psi) AS psi, drift_detected FROM drifts",
        "wide_scores",
        extra=SCORE_DRIFTS,
    ),
)
def _(t: Tables):
    path = t.path("drift-csv")
    table = drift.drift_table(t.wide_scores, SCORE_FEATURES).drop("p_value")
    writers.write_csv(table, path, decimals={"ks_stat": 6, "psi": 6})
    schema = "feature string, ks_stat string, psi string, drift_detected boolean"
    return t.spark.read.schema(schema).option("header", True).csv(path)


@query(
    "k10_thresholds_file",
    c.with_blocks(
        "SELECT round(0.9::DOUBLE * (2 * auc - 1), 6) AS min_gini, round(0.9::DOUBLE * auc, 6) AS min_auc, "
        "CAST(0.2 AS DOUBLE) AS max_psi, CAST(0.15 AS DOUBLE) AS max_ks_stat, "
        "round(0.8::DOUBLE * rate, 6) AS min_pred_rate, round(1.2::DOUBLE * rate, 6) AS max_pred_rate, "
        "CAST(5 AS DOUBLE) AS max_null_pct, CAST(1000 AS DOUBLE) AS min_records_per_month, 14 AS features FROM "
        "(SELECT auc FROM aucs WHERE model_algorithm = 'xgboost' AND split = 'oot') CROSS JOIN "
        "(SELECT avg(model_predictions) AS rate FROM split_scores WHERE model_algorithm = 'xgboost' AND split = 'oot')",
        "split_scores",
        extra={"aucs": c.auc_sql("split_scores", "model_algorithm, split")},
    ),
)
def _(t: Tables):
    path = t.path("baseline")
    jobs.store_baseline(t.spark, jobs.stage(t.model_rows), t.split_scores.where("model_algorithm = 'xgboost'"), path)
    names = {
        "performance": ["min_gini", "min_auc"], "drift": ["max_psi", "max_ks_stat"],
        "predictions": ["min_pred_rate", "max_pred_rate"], "data_quality": ["max_null_pct", "min_records_per_month"],
    }
    schema = ", ".join(f"{group} struct<{', '.join(f'{n}: double' for n in inner)}>" for group, inner in names.items())
    stored = t.spark.read.schema(schema).json(f"{path}/thresholds")
    features = t.spark.read.schema("position int, feature string").json(f"{path}/features")
    counted = features.agg(F.count(F.lit(1)).cast("int").alias("features"))
    values = [r6(F.col(f"{group}.{n}")).alias(n) for group, inner in names.items() for n in inner]
    return stored.select(*values).join(F.broadcast(counted))  # one row each


# --- P: projections, filters, predicates -----------------------------------------------------------------------
@query(
    "p1_month_list",
    "SELECT CAST(unnest(generate_series(date_trunc('month', min(o_orderdate)), max(o_orderdate), INTERVAL 1 MONTH)) AS DATE) "
    "AS snapshot_date FROM orders",
)
def _(t: Tables):
    bounds = t.table("orders").agg(
        F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end")
    )
    return dates.month_list(bounds)


@query(
    "p2_month_predicate",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 7",
)
def _(t: Tables):
    orders = t.table("orders").where(dates.in_month(F.col("o_orderdate"), MONTH))
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"))


@query("p3_temporal_split", c.with_blocks(f"SELECT encounter_id, snapshot_date, {c.SPLIT} AS split FROM labels WHERE ({c.SPLIT}) IS NOT NULL", "labels"))
def _(t: Tables):
    return dates.with_split(t.labels, SPLITS).select("encounter_id", "snapshot_date", "split")


@query(
    "p4_relative_windows",
    "SELECT DISTINCT d AS train_date, CAST(d - INTERVAL 12 MONTH - INTERVAL 24 MONTH AS DATE) AS train_test_start, "
    "CAST(d - INTERVAL 12 MONTH - INTERVAL 1 DAY AS DATE) AS train_test_end, CAST(d - INTERVAL 12 MONTH AS DATE) AS oot_start, "
    "CAST(d - INTERVAL 1 DAY AS DATE) AS oot_end FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders)",
)
def _(t: Tables):
    months = t.labels.select(F.col("snapshot_date").alias("train_date")).distinct()
    return months.select("train_date", *dates.relative_window_columns(F.col("train_date"), 24, 12))


@query(
    "p5_date_range_before_join",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, label, age_midpoint FROM labels JOIN features USING (encounter_id, snapshot_date) "
        "WHERE snapshot_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31'",
        "labels",
        "features",
    ),
)
def _(t: Tables):
    inside = dates.in_window(F.col("snapshot_date"), SPLITS.test)
    joined = layers.model_rows(t.labels.where(inside), t.features.where(inside))
    return joined.select("encounter_id", "snapshot_date", "label", "age_midpoint")


@query("p6_snapshot_filter", c.with_blocks(f"{LABELS_SQL} WHERE snapshot_date = {MONTH_SQL}", "labels"))
def _(t: Tables):
    return t.labels.where(F.col("snapshot_date") == F.lit(MONTH)).select("encounter_id", "label", "snapshot_date")


@query(
    "p7_store_columns",
    c.with_blocks(
        "SELECT encounter_id, "
        + ", ".join("round(medication_density, 6) AS medication_density" if f == "medication_density" else f for f in c.STORED)
        + ", diag_1, diag_2, diag_3, snapshot_date FROM features",
        "features",
    ),
)
def _(t: Tables):
    return t.features.select(*[r6(n) if n == "medication_density" else n for n in fv.FEATURE_STORE_COLUMNS])


@query(
    "p8_feature_columns",
    c.with_blocks(
        "SELECT " + ", ".join("round(medication_density, 6) AS medication_density" if f == "medication_density" else f for f in c.STORED) + " FROM model_rows",
        "model_rows",
    ),
)
def _(t: Tables):
    names = layers.feature_names(t.model_rows.columns)
    return t.model_rows.select(*[r6(n) if n == "medication_density" else n for n in names])


@query(
    "p9_typed_cast",
    c.with_blocks(
        f"SELECT encounter_id, patient_nbr, {', '.join(c.INTEGERS)}, gender, change, snapshot_date FROM silver", "silver"
    ),
)
def _(t: Tables):
    return layers.typed(t.bronze).select("encounter_id", "patient_nbr", *c.INTEGERS, "gender", "change", "snapshot_date")


@query(
    "p10_label",
    c.with_blocks("SELECT encounter_id, readmitted, CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END AS label FROM silver", "silver"),
)
def _(t: Tables):
    return t.silver.select("encounter_id", "readmitted", encounter.readmission_label(F.col("readmitted")).alias("label"))


@query(
    "p11_prediction_literals",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, 'xgboost' AS model_algorithm, round(model_predictions, 6) AS model_predictions, "
        "true AS stamped FROM preds WHERE model_algorithm = 'xgboost'",
        "preds",
    ),
)
def _(t: Tables):
    from ..operators.training import label_scored

    bare = t.predictions.where(F.col("model_algorithm") == "xgboost").drop("model_algorithm")
    return label_scored(bare, "xgboost").select(
        "encounter_id", "snapshot_date", "model_algorithm", r6("model_predictions"),
        F.col("prediction_timestamp").isNotNull().alias("stamped"),
    )


@query(
    "p12_present_columns",
    c.with_blocks(f"SELECT encounter_id, {', '.join(c.LOGGED[:2])}, {', '.join(c.SCALED)} FROM features", "features"),
)
def _(t: Tables):
    narrow = t.features.drop("medication_density")
    wanted = ["encounter_id", *fv.LOG_SCALE_COLUMNS, *fv.SCALE_ONLY_COLUMNS, "medical_specialty"]
    return narrow.select(*layers.present(wanted, narrow.columns))


@query(
    "p13_enabled_algorithms",
    c.with_blocks(
        "SELECT model_algorithm, encounter_id, round(model_predictions, 6) AS model_predictions FROM preds "
        "WHERE model_algorithm IN (SELECT model_algorithm FROM preds GROUP BY 1 HAVING max(model_predictions) > 0.99)",
        "preds",
    ),
)
def _(t: Tables):
    settings = t.predictions.groupBy(F.col("model_algorithm").alias("algorithm")).agg(
        (F.max("model_predictions") > 0.99).alias("enabled")
    )
    kept = registry.enabled_only(t.predictions, settings, "model_algorithm")
    return kept.select("model_algorithm", "encounter_id", r6("model_predictions"))


# --- J: joins ----------------------------------------------------------------------------------------------------
@query(
    "j1_labels_features",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, label, age_midpoint, severity_x_visits, round(medication_density, 6) AS "
        "medication_density FROM labels JOIN features USING (encounter_id, snapshot_date)",
        "labels",
        "features",
    ),
)
def _(t: Tables):
    return layers.model_rows(t.labels, t.features).select(
        "encounter_id", "snapshot_date", "label", "age_midpoint", "severity_x_visits", r6("medication_density")
    )


@query(
    "j2_predictions_labels",
    c.with_blocks(
        "SELECT model_algorithm, encounter_id, snapshot_date, snapshot_month, label, "
        "round(model_predictions, 6) AS model_predictions FROM scored",
        "scored",
    ),
)
def _(t: Tables):
    return t.scored.select(
        "model_algorithm", "encounter_id", "snapshot_date", "snapshot_month", "label", r6("model_predictions")
    )


SHARES = {
    "shares": "SELECT split, age AS category, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split) AS share "
    f"FROM (SELECT age, {c.SPLIT} AS split FROM silver) WHERE age IS NOT NULL AND split IS NOT NULL "
    "GROUP BY split, age",
}


@query(
    "j3_aligned_distributions",
    c.with_blocks(
        "SELECT category, round(coalesce(e.share, 1e-6), 6) AS expected, round(coalesce(a.share, 1e-6), 6) AS actual FROM "
        "(SELECT * FROM shares WHERE split = 'train') e FULL JOIN (SELECT * FROM shares WHERE split = 'oot') a USING (category)",
        "silver",
        extra=SHARES,
    ),
)
def _(t: Tables):
    rows = _age_by_split(t)
    shares = drift.category_shares(rows, ["split"], "category")
    return drift.aligned_shares(
        shares.where(F.col("split") == "train"), shares.where(F.col("split") == "oot"), ["category"]
    ).select("category", r6("expected"), r6("actual"))


def _age_by_split(t: Tables):
    """Age bands by split."""
    rows = dates.with_split(t.silver.select("age", "snapshot_date"), SPLITS)
    return rows.select("split", F.col("age").alias("category"))


@query(
    "j4_months_against_reference",
    c.with_blocks(
        "SELECT c.model_algorithm, c.snapshot_month, CAST(c.bin AS INTEGER) AS bin, round(CAST(f.n AS DOUBLE) / f.total, 6) AS expected, "
        "round(CAST(c.n AS DOUBLE) / c.total, 6) AS actual FROM cells c JOIN cells f ON f.model_algorithm = c.model_algorithm "
        "AND f.bin = c.bin AND f.snapshot_month = (SELECT min(snapshot_month) FROM months_seen s "
        "WHERE s.model_algorithm = c.model_algorithm)",
        "scored",
        extra=c.psi_blocks("scored"),
    ),
)
def _(t: Tables):
    from pyspark.sql import Window

    cells = drift.score_histogram(t.scored, ["model_algorithm", "snapshot_month"], "model_predictions")
    first = Window.partitionBy("model_algorithm", "bin").orderBy("snapshot_month")
    return cells.select(
        "model_algorithm", "snapshot_month", "bin", r6(F.first("share").over(first)).alias("expected"), r6("share").alias("actual")
    )


LOOKUPS = ["age_midpoint", "age_group_index", "admission_type_desc", "admission_severity_score", "discharge_severity_score",
           "admission_source_risk_score", "max_glu_serum_ord", "A1Cresult_ord", "insulin_ord"]


@query(
    "j5_code_lookups",
    c.with_blocks("SELECT encounter_id, " + ", ".join(f"{c.FEATURES[n]} AS {n}" for n in LOOKUPS) + " FROM silver", "silver"),
)
def _(t: Tables):
    return layers.feature_store(t.silver, ["encounter_id", *LOOKUPS])


SIDES = {
    "p": "SELECT DISTINCT CAST(date_trunc('month', l_shipdate) AS DATE) AS snapshot_date FROM lineitem",
    "l": "SELECT DISTINCT snapshot_date FROM labels",
}


def _sides(t: Tables):
    """Days of shipment months and of labels: the first go on for some months after the last label."""
    shipped = t.table("lineitem").select(F.to_date(F.trunc("l_shipdate", "month")).alias("snapshot_date"))
    return shipped, t.labels


@query(
    "j6_date_coverage",
    c.with_blocks(
        "SELECT snapshot_date, p.snapshot_date IS NOT NULL AS in_predictions, l.snapshot_date IS NOT NULL AS in_labels "
        "FROM p FULL JOIN l USING (snapshot_date)",
        "labels",
        extra=SIDES,
    ),
)
def _(t: Tables):
    return monitoring.date_coverage(*_sides(t))


# --- U: set operations ---------------------------------------------------------------------------------------------
@query("u1_common_dates", c.with_blocks("SELECT snapshot_date FROM p INTERSECT SELECT snapshot_date FROM l", "labels", extra=SIDES))
def _(t: Tables):
    return monitoring.common_dates(*_sides(t))


@query(
    "u2_missing_dates",
    c.with_blocks(
        "SELECT 'labels' AS missing_in, snapshot_date FROM (SELECT * FROM p EXCEPT SELECT * FROM l) UNION ALL "
        "SELECT 'predictions', snapshot_date FROM (SELECT * FROM l EXCEPT SELECT * FROM p)",
        "labels",
        extra=SIDES,
    ),
)
def _(t: Tables):
    p, l = _sides(t)
    return layers.stack_rows(
        [
            monitoring.dates_only_in(p, l).select(F.lit("labels").alias("missing_in"), "snapshot_date"),
            monitoring.dates_only_in(l, p).select(F.lit("predictions").alias("missing_in"), "snapshot_date"),
        ]
    )


@query(
    "u3_union_of_frames",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, is_female, NULL::INTEGER AS label FROM features UNION ALL "
        "SELECT encounter_id, snapshot_date, NULL::INTEGER, label FROM labels",
        "features",
        "labels",
    ),
)
def _(t: Tables):
    left = t.features.select("encounter_id", "snapshot_date", "is_female")
    return layers.stack_rows([left, t.labels.select("encounter_id", "snapshot_date", "label")])


@query("u4_category_union", c.with_blocks("SELECT DISTINCT category FROM shares", "silver", extra=SHARES))
def _(t: Tables):
    shares = drift.category_shares(_age_by_split(t), ["split"], "category")
    return drift.aligned_shares(
        shares.where(F.col("split") == "train"), shares.where(F.col("split") == "oot"), ["category"]
    ).select("category")


# --- F: features ------------------------------------------------------------------------------------------------------
def _feature_query(name: str, columns: list[str], rounded: bool = False):
    """Register a query of encounter_id and the named derived columns."""
    texts = [
        f"round(CAST({c.FEATURES[n]} AS DOUBLE), 6) AS {n}" if rounded else f"{c.FEATURES[n]} AS {c.quote(n)}" for n in columns
    ]
    check = c.with_blocks(f"SELECT encounter_id, {', '.join(texts)} FROM silver", "silver")

    @query(name, check)
    def _(t: Tables):
        rows = layers.feature_store(t.silver, ["encounter_id", *columns])
        if not rounded:
            return rows
        return rows.select("encounter_id", *[F.round(F.col(n).cast("double"), 6).alias(n) for n in columns])


_feature_query("f1_race_cleaned", ["race_cleaned"])
_feature_query("f2_race_flags", ["race_AfricanAmerican", "race_Caucasian", "race_Asian", "race_Hispanic"])
_feature_query("f3_is_female", ["is_female"])
_feature_query("f4_age_midpoint", ["age_midpoint"])
_feature_query("f5_age_group_index", ["age_group_index"])
_feature_query("f6_age_group_label", ["age_group_label"])
_feature_query("f7_admission_type", ["admission_type_desc"])
_feature_query("f8_admission_severity", ["admission_severity_score"])
_feature_query("f9_discharge_severity", ["discharge_severity_score"])
_feature_query("f10_admission_source_risk", ["admission_source_risk_score"])
_feature_query("f11_medication_intensity", ["medication_intensity"], rounded=True)
_feature_query("f12_diagnosis_density", ["diagnosis_density"], rounded=True)
_feature_query("f13_glucose_ordinal", ["max_glu_serum_ord"])
_feature_query("f14_a1c_ordinal", ["A1Cresult_ord"])
_feature_query("f15_drug_ordinals", [f"{d}_ord" for d in fv.DRUGS])
_feature_query("f17_diabetes_med_flag", ["diabetesMed"])
_feature_query("f18_total_visits", ["total_visits"])
_feature_query("f19_poor_glucose_control", ["poor_glucose_control"])
_feature_query("f20_severity_x_visits", ["severity_x_visits"])
_feature_query("f21_medication_density", ["medication_density"], rounded=True)


@query(
    "f16_change_flag",
    c.with_blocks(
        "SELECT encounter_id, CASE WHEN lower(change) = 'ch' THEN 1 ELSE 0 END AS change_flag, "
        "CASE WHEN change = 'ch' THEN 1 ELSE 0 END AS change_flag_exact FROM silver",
        "silver",
    ),
)
def _(t: Tables):
    return t.silver.select(
        "encounter_id",
        encounter.change_flag(F.col("change")).alias("change_flag"),
        encounter.change_flag(F.col("change"), exact_case=True).alias("change_flag_exact"),
    )


@query("f22_lab_placeholders", c.with_blocks("SELECT encounter_id, max_glu_serum, A1Cresult FROM silver", "silver"))
def _(t: Tables):
    return t.silver.select("encounter_id", "max_glu_serum", "A1Cresult")


CATEGORIES = ["diag_1_category", "diag_2_category", "diag_3_category"]
CATEGORY_LIST = f"[{', '.join(CATEGORIES)}]"


@query("f23_icd9_category", c.with_blocks(f"SELECT encounter_id, {', '.join(CATEGORIES)} FROM diagnoses", "diagnoses"))
def _(t: Tables):
    return t.diagnoses.select("encounter_id", *CATEGORIES)


@query(
    "f24_high_risk_diag_count",
    c.with_blocks(
        "SELECT encounter_id, "
        + " + ".join(f"CASE WHEN {n} IN ('circulatory', 'diabetes', 'injury') THEN 1 ELSE 0 END" for n in CATEGORIES)
        + " AS high_risk_diag_count FROM diagnoses",
        "diagnoses",
    ),
)
def _(t: Tables):
    return t.diagnoses.select("encounter_id", "high_risk_diag_count")


@query(
    "f25_primary_category_dummies",
    c.with_blocks(
        "SELECT encounter_id, "
        + ", ".join(f"CASE WHEN diag_1_category = '{n}' THEN 1 ELSE 0 END AS diag1_{n}" for n in fv.ICD9_CATEGORIES)
        + " FROM diagnoses",
        "diagnoses",
    ),
)
def _(t: Tables):
    return t.diagnoses.select("encounter_id", *[f"diag1_{n}" for n in fv.ICD9_CATEGORIES])


@query(
    "f26_has_circulatory",
    c.with_blocks(
        f"SELECT encounter_id, CASE WHEN list_contains({CATEGORY_LIST}, 'circulatory') THEN 1 ELSE 0 END AS has_circulatory "
        "FROM diagnoses",
        "diagnoses",
    ),
)
def _(t: Tables):
    return t.diagnoses.select("encounter_id", "has_circulatory")


@query(
    "f27_multiple_systems",
    c.with_blocks(
        f"SELECT encounter_id, CASE WHEN len(list_distinct({CATEGORY_LIST})) = 3 THEN 1 ELSE 0 END AS multiple_systems "
        "FROM diagnoses",
        "diagnoses",
    ),
)
def _(t: Tables):
    return t.diagnoses.select("encounter_id", "multiple_systems")


@query(
    "f28_log1p",
    c.with_blocks(
        "SELECT encounter_id, " + ", ".join(f"round(ln(1 + CAST({n} AS DOUBLE)), 6) AS {n}" for n in c.LOGGED) + " FROM features",
        "features",
    ),
)
def _(t: Tables):
    return t.features.select("encounter_id", *[r6(F.log1p(F.col(n))).alias(n) for n in fv.LOG_SCALE_COLUMNS])


@query("f29_scaled_features", PREPROCESSED_SQL)
def _(t: Tables):
    scaled, _scaler = scaling.preprocess(jobs.stage(t.model_rows))
    return scaled.select(*_scaled_output())


def _variant_sql(logged: list[str], scaled: list[str]) -> str:
    parts = []
    for n in logged + scaled:
        value = f"ln(1 + CAST({n} AS DOUBLE))" if n in logged else f"CAST({n} AS DOUBLE)"
        parts.append(
            f"round(({value} - (SELECT avg({value}) FROM model_rows WHERE split = 'train')) / "
            f"(SELECT stddev_pop({value}) FROM model_rows WHERE split = 'train'), 6) AS {n}"
        )
    return c.with_blocks(f"SELECT encounter_id, split, {', '.join(parts)} FROM model_rows", "model_rows")


@query("f29_scaled_without_log", _variant_sql([], c.LOGGED + c.SCALED))
def _(t: Tables):
    scaled, _scaler = scaling.preprocess(jobs.stage(t.model_rows), scaling.SCALE_ALL)
    return scaled.select("encounter_id", "split", *[r6(n) for n in fv.LOG_SCALE_COLUMNS + fv.SCALE_ONLY_COLUMNS])


@query("f29_scaled_logged_only", _variant_sql(c.LOGGED, []))
def _(t: Tables):
    scaled, _scaler = scaling.preprocess(jobs.stage(t.model_rows), scaling.LOG_ONLY)
    return scaled.select("encounter_id", "split", *[r6(n) for n in fv.LOG_SCALE_COLUMNS])


@query("f30_snapshot_month", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS snapshot_month FROM orders")
def _(t: Tables):
    return t.table("orders").select("o_orderkey", dates.snapshot_month(F.col("o_orderdate")).alias("snapshot_month"))


@query(
    "f31_normalised_date",
    c.with_blocks(
        "SELECT encounter_id, strftime(TRY_CAST(CASE WHEN TRY_CAST(encounter_id AS BIGINT) % 11 = 0 THEN 'n/a' "
        "ELSE snapshot_date END AS DATE), '%Y-%m-%d') AS day FROM raw",
        "raw",
    ),
)
def _(t: Tables):
    text = F.when(F.col("encounter_id").try_cast("long") % 11 == 0, "n/a").otherwise(F.col("snapshot_date"))
    return t.raw.select("encounter_id", dates.normalise_date(text).alias("day"))


@query(
    "f32_gini",
    c.with_blocks(
        f"SELECT model_algorithm, split, {r6_sql('auc')}, round(2 * auc - 1, 6) AS gini FROM aucs",
        "split_scores",
        extra={"aucs": c.auc_sql("split_scores", "model_algorithm, split")},
    ),
)
def _(t: Tables):
    auc = m.roc_auc(t.split_scores, ["model_algorithm", "split"], "model_predictions", "label")
    return auc.select("model_algorithm", "split", r6("auc"), r6(m.gini(F.col("auc"))).alias("gini"))


@query(
    "f33_hard_class",
    c.with_blocks(
        "SELECT model_algorithm, encounter_id, CASE WHEN model_predictions > CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS predicted "
        "FROM preds",
        "preds",
    ),
)
def _(t: Tables):
    return t.predictions.select(
        "model_algorithm", "encounter_id", m.hard_class(F.col("model_predictions"), CONFIG.prediction_threshold).alias("predicted")
    )


def label_samples(t: Tables):
    """Labelled rows by split."""
    return dates.with_split(t.labels, SPLITS).groupBy("split").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "f34_document_defaults",
    c.with_blocks(
        "SELECT model, round(test_auc, 6) AS test_auc, round(oot_auc, 6) AS oot_auc, train_samples, test_samples, oot_samples, "
        "'N/A' AS top_feature FROM (SELECT model_algorithm AS model, max(auc) FILTER (WHERE split = 'test') AS test_auc, "
        "max(auc) FILTER (WHERE split = 'oot') AS oot_auc FROM aucs GROUP BY 1) CROSS JOIN samples",
        "split_scores",
        "labels",
        extra={"aucs": c.auc_sql("split_scores", "model_algorithm, split"), **SAMPLES},
    ),
)
def _(t: Tables):
    # Documents of a run that stored no importance.
    evaluation = m.evaluate(t.split_scores, ["model_algorithm", "split"], "model_predictions", "label").select(
        F.col("model_algorithm").alias("algorithm"), F.lit("1").alias("version"), "*"
    )
    flat = registry.flatten_documents(registry.performance_documents(evaluation, label_samples(t)))
    return flat.select(
        "model", r6("test_auc"), r6("oot_auc"), "train_samples", "test_samples", "oot_samples", "top_feature"
    )


@query(
    "f35_vector_assembly",
    c.with_blocks(
        "SELECT encounter_id, 14 AS size, round(coalesce(age_midpoint, 0) + coalesce(severity_x_visits, 0) + "
        "coalesce(admission_severity_score, 0) + coalesce(insulin_ord, 0) + CAST(0 AS DOUBLE), 6) AS part_sum FROM model_rows",
        "model_rows",
    ),
)
def _(t: Tables):
    from pyspark.ml.functions import vector_to_array

    from ..operators import training

    filled = training.fill_missing(t.model_rows, fv.MODEL_FEATURES)
    vectors = training.assembler(fv.MODEL_FEATURES).transform(filled).withColumn("v", vector_to_array("features"))
    places = [fv.MODEL_FEATURES.index(n) + 1 for n in ("age_midpoint", "severity_x_visits", "admission_severity_score", "insulin_ord")]
    total = sum((F.element_at("v", i) for i in places), F.lit(0.0))
    return vectors.select("encounter_id", F.size("v").alias("size"), r6(total).alias("part_sum"))


@query("f36_partition_label", "SELECT o_orderkey, strftime(o_orderdate, '%Y_%m') AS partition_label FROM orders")
def _(t: Tables):
    return t.table("orders").select("o_orderkey", dates.partition_label(F.col("o_orderdate")).alias("partition_label"))


@query(
    "f37_weight_columns",
    c.with_blocks(
        "SELECT encounter_id, CASE weight WHEN '[0-25)' THEN 12 WHEN '[25-50)' THEN 37 WHEN '[50-75)' THEN 62 WHEN '[75-100)' "
        "THEN 87 WHEN '[100-125)' THEN 112 WHEN '[125-150)' THEN 137 WHEN '[150-175)' THEN 162 WHEN '[175-200)' THEN 187 "
        "WHEN '>200' THEN 225 END AS weight_midpoint, CASE WHEN weight IN ('[0-25)', '[25-50)') THEN 'Underweight' "
        "WHEN weight IN ('[50-75)', '[75-100)') THEN 'Normal' WHEN weight IN ('[100-125)', '[125-150)') THEN 'Overweight' "
        "WHEN weight IN ('[150-175)', '[175-200)', '>200') THEN 'Obese' ELSE 'Unknown' END AS weight_group_label, "
        "CASE WHEN weight IN ('[150-175)', '[175-200)', '>200') THEN 1 ELSE 0 END AS is_obese FROM silver",
        "silver",
    ),
)
def _(t: Tables):
    return layers.feature_store(t.silver, ["encounter_id", "weight_midpoint", "weight_group_label", "is_obese"])


@query(
    "f38_payer_risk",
    c.with_blocks(
        "SELECT encounter_id, CASE WHEN payer_code IN ('BC', 'CH', 'CM', 'CP', 'HM', 'MP', 'PO', 'SI') THEN 4 "
        "WHEN payer_code IN ('MC', 'MD', 'SP', 'FR', 'OG', 'DM') THEN 3 WHEN payer_code = 'WC' THEN 2 "
        "WHEN payer_code = 'UN' THEN 1 WHEN payer_code IN ('OT', '?') THEN 0 END AS payer_risk_score FROM silver",
        "silver",
    ),
)
def _(t: Tables):
    return layers.feature_store(t.silver, ["encounter_id", "payer_risk_score"])


# --- X: documented options on tables --------------------------------------------------------------------------------------
@query(
    "x1_deduplicated_silver",
    c.with_blocks("SELECT encounter_id, snapshot_date, max(race) AS race FROM silver GROUP BY encounter_id, snapshot_date", "silver"),
)
def _(t: Tables):
    doubled = layers.stack_rows([t.silver, t.silver.where(F.col("encounter_id") % 3 == 0)])
    return layers.deduplicate(doubled).select("encounter_id", "snapshot_date", "race")


@query(
    "x5_not_yet_scored",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, is_female FROM features WHERE encounter_id NOT IN "
        "(SELECT encounter_id FROM preds WHERE model_algorithm = 'xgboost' AND model_predictions < 0.5)",
        "features",
        "preds",
    ),
)
def _(t: Tables):
    done = t.predictions.where((F.col("model_algorithm") == "xgboost") & (F.col("model_predictions") < 0.5))
    return layers.not_yet_scored(t.features, done).select("encounter_id", "snapshot_date", "is_female")


# --- Q: quality gates ---------------------------------------------------------------------------------------------------------
@query(
    "q1_null_percentages",
    c.with_blocks(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, round(avg(CASE WHEN {f} IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END), 6) AS null_pct, "
            f"avg(CASE WHEN {f} IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END) < 5 AS passed FROM model_rows"
            for f in quality.KEY_FEATURES
        ),
        "model_rows",
    ),
)
def _(t: Tables):
    return quality.null_percentages(t.model_rows, quality.KEY_FEATURES).select(
        "feature", r6("null_pct"), (F.col("null_pct") < 5).alias("passed")
    )


def _gate(name: str, check: quality.Check, sql: str):
    """Register one gate, measured on its own."""

    @query(name, sql)
    def _(t: Tables):
        return quality.measure(t.model_rows, [check]).select("check", r6("value"), "passed")


_gate(
    "q2_positive_rate",
    quality.positive_rate(),
    c.with_blocks(
        "SELECT 'label_positive_rate' AS check, round(avg(CAST(label AS DOUBLE)), 6) AS value, "
        "avg(label) > 0.05 AND avg(label) < 0.3 AS passed FROM model_rows",
        "model_rows",
    ),
)
_gate(
    "q3_no_future_dates",
    quality.no_days_after(SPLITS.oot.end),
    c.with_blocks(
        "SELECT 'days_after_oot_end' AS check, CAST(greatest(0, date_diff('day', DATE '2001-12-31', max(snapshot_date))) AS DOUBLE) "
        "AS value, max(snapshot_date) <= DATE '2001-12-31' AS passed FROM model_rows",
        "model_rows",
    ),
)
_gate(
    "q4_age_range",
    quality.ages_in_range(),
    c.with_blocks(
        "SELECT 'age_out_of_range' AS check, CAST(count(*) FILTER (WHERE age_midpoint NOT BETWEEN 0 AND 100) AS DOUBLE) AS value, "
        "count(*) FILTER (WHERE age_midpoint NOT BETWEEN 0 AND 100) = 0 AS passed FROM model_rows",
        "model_rows",
    ),
)


@query(
    "q5_duplicate_keys",
    "SELECT 'duplicate_records' AS check, CAST(count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS DOUBLE) AS value, "
    "count(*) = count(DISTINCT (l_orderkey, l_linenumber)) AS passed FROM lineitem",
)
def _(t: Tables):
    copies = quality.duplicate_count(t.table("lineitem"), ["l_orderkey", "l_linenumber"])
    return copies.select(
        F.lit("duplicate_records").alias("check"),
        F.col("duplicates").cast("double").alias("value"),
        (F.col("duplicates") == 0).alias("passed"),
    )


@query("q6_required_columns", c.with_blocks("SELECT encounter_id, snapshot_date, label FROM labels", "labels"))
def _(t: Tables):
    return quality.require_columns(t.labels, ["encounter_id", "snapshot_date", "label"]).select(
        "encounter_id", "snapshot_date", "label"
    )


@query(
    "q7_enough_history",
    c.with_blocks(
        "SELECT 'months_of_history' AS check, CAST(count(DISTINCT snapshot_date) AS DOUBLE) AS value, "
        "count(DISTINCT snapshot_date) >= 10 AS passed FROM model_rows UNION ALL "
        "SELECT 'train_rows', CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE), count(*) FILTER (WHERE split = 'train') > 1000 "
        "FROM model_rows UNION ALL "
        "SELECT 'test_rows', CAST(count(*) FILTER (WHERE split = 'test') AS DOUBLE), count(*) FILTER (WHERE split = 'test') > 500 "
        "FROM model_rows",
        "model_rows",
    ),
)
def _(t: Tables):
    checks = [quality.months_of_history(10), quality.split_rows("train", 1000), quality.split_rows("test", 500)]
    return quality.measure(t.model_rows, checks).select("check", "value", "passed")


@query(
    "q8_non_empty_stores",
    c.with_blocks(
        "SELECT 'labels' AS check, CAST(count(*) AS DOUBLE) AS value, count(*) > 0 AS passed FROM labels UNION ALL "
        "SELECT 'features', CAST(count(*) AS DOUBLE), count(*) > 0 FROM features UNION ALL "
        "SELECT 'merged', CAST(count(*) AS DOUBLE), count(*) > 0 FROM scored UNION ALL "
        "SELECT 'missing_month', CAST(count(*) AS DOUBLE), count(*) > 0 FROM labels WHERE snapshot_date = DATE '2030-01-01'",
        "labels",
        "features",
        "scored",
    ),
)
def _(t: Tables):
    missing = t.labels.where(F.col("snapshot_date") == "2030-01-01")
    return quality.non_empty_report(
        {"labels": t.labels, "features": t.features, "merged": t.scored, "missing_month": missing}
    ).select("check", "value", "passed")


@query(
    "q9_configured_windows",
    c.with_blocks("SELECT split, min(snapshot_date) AS first_seen, max(snapshot_date) AS last_seen, count(*) AS rows FROM model_rows GROUP BY split", "model_rows"),
)
def _(t: Tables):
    from ..config import splits_from_dict

    windows = splits_from_dict(
        {
            "train": {"start_date": "1995-01-01", "end_date": "1998-12-31"},
            "test": {"start_date": "1999-01-01", "end_date": "2000-12-31"},
            "oot": {"start_date": "2001-01-01", "end_date": "2001-12-31"},
        }
    )
    return dates.with_split(layers.model_rows(t.labels, t.features), windows).groupBy("split").agg(
        F.min("snapshot_date").alias("first_seen"),
        F.max("snapshot_date").alias("last_seen"),
        F.count(F.lit(1)).alias("rows"),
    )


