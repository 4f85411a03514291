"""Registered queries: aggregates, ranking, metrics, drift, monitoring, governance, registry, ML."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..config import TrainingConfig
from ..functions import dates, stability
from ..operators import drift, governance, layers, monitoring, quality, registry, scaling, splitting, training
from ..operators import metrics as m
from ..sources import version_index
from ..sources.scratch import materialize
from . import check_sql as c
from . import jobs
from .catalog import CONFIG, SPLITS, Tables, query, r6, r6_sql
from .queries_tables import (
    BASELINE_SQL,
    BASELINE_FEATURES,
    DRIFT_FEATURES,
    DRIFTS,
    SAMPLES,
    EVALUATED,
    METRIC_PAIRS,
    MONITORED,
    MONITORED_COLUMNS,
    SCORE_DRIFTS,
    label_samples,
    SCORE_FEATURES,
    STATS,
    WIDE_SQL,
    _evaluation,
    registered,
)

MODEL_SPLIT = ["model_algorithm", "split"]
MODEL_MONTH = ["model_algorithm", "snapshot_month"]
SCORE, LABEL = "model_predictions", "label"


# --- A: aggregations --------------------------------------------------------------------------------------
@query(
    "a1_rows_per_layer",
    c.with_blocks(
        " UNION ALL ".join(
            f"SELECT '{layer}' AS layer, strftime(CAST(snapshot_date AS DATE), '%Y-%m') AS snapshot_month, count(*) AS rows "
            f"FROM {source} GROUP BY 2"
            for layer, source in [("bronze", "raw"), ("silver", "silver"), ("label_store", "labels"), ("feature_store", "features")]
        ),
        "raw",
        "silver",
        "labels",
        "features",
    ),
)
def _(t: Tables):
    named = [("bronze", t.bronze), ("silver", t.silver), ("label_store", t.month(t.labels)), ("feature_store", t.month(t.features))]
    return layers.rows_per_layer(dict(named))


@query("a2_label_by_split", c.with_blocks("SELECT split, label, count(*) AS rows FROM model_rows GROUP BY split, label", "model_rows"))
def _(t: Tables):
    return t.model_rows.groupBy("split", "label").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a3_positive_rate",
    c.with_blocks(
        "SELECT split, count(*) AS rows, round(avg(CAST(label AS DOUBLE)), 6) AS positive_rate FROM model_rows GROUP BY split",
        "model_rows",
    ),
)
def _(t: Tables):
    return t.model_rows.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.avg(F.col("label").cast("double")), 6).alias("positive_rate")
    )


CLASS_SQL = (
    "SELECT n0, n1, round(CAST(n0 AS DOUBLE) / n1, 6) AS scale_pos_weight, "
    "round(CAST(n0 + n1 AS DOUBLE) / (2 * n0), 6) AS weight_0, round(CAST(n0 + n1 AS DOUBLE) / (2 * n1), 6) AS weight_1 FROM "
    "(SELECT count(*) FILTER (WHERE label = 0) AS n0, count(*) FILTER (WHERE label = 1) AS n1 FROM model_rows WHERE split = 'train')"
)


@query("a4_class_ratio", c.with_blocks(f"SELECT n0, n1, scale_pos_weight FROM ({CLASS_SQL})", "model_rows"))
def _(t: Tables):
    counts = splitting.class_counts(t.model_rows.where(F.col("split") == "train"))
    return counts.select("n0", "n1", r6("scale_pos_weight"))


@query("a5_rows_per_month", c.with_blocks("SELECT snapshot_month, count(*) AS rows FROM scored GROUP BY 1", "scored"))
def _(t: Tables):
    return t.scored.groupBy("snapshot_month").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a6_prediction_summary",
    c.with_blocks(
        "SELECT model_algorithm, count(*) AS num_predictions, round(avg(model_predictions), 6) AS avg_probability FROM preds GROUP BY 1",
        "preds",
    ),
)
def _(t: Tables):
    return monitoring.score_summary(t.predictions, ["model_algorithm"]).select(
        "model_algorithm", "num_predictions", r6("avg_probability")
    )


@query(
    "a7_normalised_counts",
    c.with_blocks(
        "SELECT split, category, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY split), 6) AS share "
        f"FROM (SELECT race AS category, {c.SPLIT} AS split FROM silver) WHERE category IS NOT NULL AND split IS NOT NULL "
        "GROUP BY split, category",
        "silver",
    ),
)
def _(t: Tables):
    rows = dates.with_split(t.silver.select("race", "snapshot_date"), SPLITS).withColumnRenamed("race", "category")
    return drift.category_shares(rows, ["split"], "category").select("split", "category", "n", r6("share"))


def _histogram_sql(bins: int, source: str, keys: str) -> str:
    return (
        f"SELECT {keys}, CAST(r.bin AS INTEGER) AS bin, count(b.bin) AS n, round(CAST(count(b.bin) AS DOUBLE) / max(total), 6) AS share "
        f"FROM (SELECT {keys}, count(*) AS total FROM {source} GROUP BY {keys}) g CROSS JOIN "
        f"(SELECT unnest(range({bins})) AS bin) r LEFT JOIN (SELECT {keys}, {c.bin_case('model_predictions', bins)} AS bin "
        f"FROM {source}) b USING ({keys}, bin) GROUP BY {keys}, r.bin"
    )


@query("a8_ten_bin_histogram", c.with_blocks(_histogram_sql(10, "scored", "model_algorithm, snapshot_month"), "scored"))
def _(t: Tables):
    return drift.score_histogram(t.scored, MODEL_MONTH, SCORE, 10).select(*MODEL_MONTH, "bin", "n", r6("share"))


@query("a9_twenty_bin_histogram", c.with_blocks(_histogram_sql(20, "split_scores", "model_algorithm, split"), "split_scores"))
def _(t: Tables):
    return drift.score_histogram(t.split_scores, MODEL_SPLIT, SCORE, 20).select(*MODEL_SPLIT, "bin", "n", r6("share"))


PRICE_FEATURES = ["l_extendedprice", "l_quantity", "l_discount"]


@query(
    "a10_exact_percentiles",
    "WITH long AS ("
    + c.feature_long(PRICE_FEATURES, "lineitem")
    + "), lists AS (SELECT feature, list(value ORDER BY value) AS vals, count(*) AS n FROM long GROUP BY feature) "
    + " UNION ALL ".join(
        f"SELECT feature, {i} AS position, round({c.lerp('vals', 'n', repr(p))}, 6) AS percentile FROM lists"
        for i, p in enumerate(drift.DECILES)
    ),
)
def _(t: Tables):
    cuts = drift.exact_percentiles(t.table("lineitem"), PRICE_FEATURES, drift.DECILES)
    return cuts.select("feature", "position", r6("percentile"))


@query("a11_baseline_statistics", BASELINE_SQL)
def _(t: Tables):
    return drift.baseline_statistics(t.features, BASELINE_FEATURES).select("feature", *[r6(s) for s in STATS])


@query(
    "a12_null_percentage",
    c.with_blocks(
        " UNION ALL ".join(
            f"SELECT '{f}' AS feature, round(avg(CASE WHEN {f} IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END), 6) AS null_pct FROM features"
            for f in c.STORED
        ),
        "features",
    ),
)
def _(t: Tables):
    return quality.null_percentages(t.features, fv.MODEL_FEATURES).select("feature", r6("null_pct"))


@query(
    "a13_distinct_dates",
    c.with_blocks(
        "SELECT count(DISTINCT snapshot_date) AS dates, min(snapshot_date) AS first_date, max(snapshot_date) AS last_date FROM labels",
        "labels",
    ),
)
def _(t: Tables):
    return t.labels.agg(
        F.count_distinct("snapshot_date").alias("dates"),
        F.min("snapshot_date").alias("first_date"),
        F.max("snapshot_date").alias("last_date"),
    )


@query(
    "a14_duplicate_count",
    "SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
)
def _(t: Tables):
    return quality.duplicate_count(t.table("lineitem"), ["l_orderkey", "l_linenumber"])


CONFUSION_SQL = c.confusion_sql("split_scores", "model_algorithm, split")
RATES_SQL = ", ".join(f"round({text}, 6) AS {name}" for name, text in c.RATES.items())


def _confusion(t: Tables):
    return m.confusion(t.split_scores, MODEL_SPLIT, m.hard_class(F.col(SCORE)), F.col(LABEL))


@query(
    "a15_confusion_counts",
    c.with_blocks("SELECT model_algorithm, split, tp, fp, tn, fn FROM conf", "split_scores", extra={"conf": CONFUSION_SQL}),
)
def _(t: Tables):
    return _confusion(t)


WIDE = {**EVALUATED, "wide": WIDE_SQL}
WIDE_NAMES = [f"{s}_{n}" for s, _m, n in METRIC_PAIRS]


def _wide(t: Tables):
    """Comparison rows with their listed position."""
    position = F.array_position(F.array(*[F.lit(a) for a in fv.ALGORITHMS]), F.col("model"))
    return registry.wide_metrics(_evaluation(t)).withColumn("position", position)


BEST_SQL = c.with_blocks(
    "SELECT " + ", ".join(f"(SELECT model FROM wide ORDER BY {b} DESC, model LIMIT 1) AS {b}" for b in registry.BEST_BY),
    "split_scores",
    extra=WIDE,
)


@query("a16_argmax_per_metric", BEST_SQL)
def _(t: Tables):
    return registry.best_models(_wide(t))


def _scaler_sql() -> str:
    parts = [(n, True) for n in c.LOGGED] + [(n, False) for n in c.SCALED]
    rows = []
    for n, log in parts:
        value = f"ln(1 + CAST({n} AS DOUBLE))" if log else f"CAST({n} AS DOUBLE)"
        rows.append(
            f"SELECT '{n}' AS feature, {str(log).lower()} AS log, round(avg({value}), 6) AS mean, "
            f"round(stddev_pop({value}), 6) AS std_pop FROM model_rows WHERE split = 'train'"
        )
    return c.with_blocks(" UNION ALL ".join(rows), "model_rows")


@query("a17_scaler_statistics", _scaler_sql())
def _(t: Tables):
    fitted = scaling.scaler_statistics(t.model_rows.where(F.col("split") == "train"))
    return fitted.select("feature", "log", r6("mean"), r6("std_pop"))


@query(
    "a18_monthly_score_moments",
    c.with_blocks(
        "SELECT model_algorithm, snapshot_month, round(avg(model_predictions), 6) AS avg_probability, "
        "round(stddev_samp(model_predictions), 6) AS std_probability FROM scored GROUP BY ALL",
        "scored",
    ),
)
def _(t: Tables):
    return monitoring.score_summary(t.scored, MODEL_MONTH).select(*MODEL_MONTH, r6("avg_probability"), r6("std_probability"))


@query(
    "a19_mean_score_shift",
    c.with_blocks(
        "SELECT model_algorithm, round(a, 6) AS mean_train, round(b, 6) AS mean_oot, round(abs(b - a), 6) AS shift FROM "
        "(SELECT model_algorithm, avg(model_predictions) FILTER (WHERE split = 'train') AS a, "
        "avg(model_predictions) FILTER (WHERE split = 'oot') AS b FROM split_scores GROUP BY 1)",
        "split_scores",
    ),
)
def _(t: Tables):
    shift = monitoring.mean_shift(t.split_scores, "model_algorithm", "split", SCORE, "train", "oot")
    return shift.select("model_algorithm", r6("mean_train"), r6("mean_oot"), r6("shift"))


@query(
    "a20_condition_share",
    c.with_blocks(
        "SELECT CAST(sum(hit) AS BIGINT) AS cases, round(avg(hit) * 100, 6) AS pct FROM (SELECT CASE WHEN "
        "'circulatory' IN (diag_1_category, diag_2_category, diag_3_category) THEN CAST(1 AS DOUBLE) ELSE 0 END AS hit FROM diagnoses)",
        "diagnoses",
    ),
)
def _(t: Tables):
    return t.diagnoses.agg(
        F.sum("has_circulatory").alias("cases"),
        F.round(F.avg(F.col("has_circulatory").cast("double")) * 100.0, 6).alias("pct"),
    )


@query(
    "a21_bad_rate_by_period",
    c.with_blocks(
        "SELECT strftime(snapshot_date, '%Y-%m') AS period, round(avg(CAST(label AS DOUBLE)), 6) AS bad_rate FROM labels GROUP BY 1",
        "labels",
    ),
)
def _(t: Tables):
    return t.month(t.labels).groupBy(F.col("snapshot_month").alias("period")).agg(
        F.round(F.avg(F.col("label").cast("double")), 6).alias("bad_rate")
    )


# --- W: ranking ---------------------------------------------------------------------------------------------
AUC_COLUMNS = "pos, neg, round(auc, 6) AS auc"


@query(
    "w1_rank_sum_auc",
    "WITH "
    + ", ".join(
        [
            "volume AS (SELECT 'volume' AS model_algorithm, strftime(l_shipdate, '%Y-%m') AS snapshot_month, "
            "l_quantity / CAST(50 AS DOUBLE) AS model_predictions, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem)",
            f"aucs AS ({c.auc_sql('volume', 'snapshot_month')})",
        ]
    )
    + f" SELECT snapshot_month, {AUC_COLUMNS} FROM aucs",
)
def _(t: Tables):
    return m.roc_auc(t.volume, ["snapshot_month"], SCORE, LABEL).select("snapshot_month", "pos", "neg", r6("auc"))


@query(
    "w2_cumulative_precision",
    c.with_blocks(
        "SELECT model_algorithm, split, round(pr_auc, 6) AS pr_auc FROM aps",
        "split_scores",
        extra={"aps": c.average_precision_sql("split_scores", "model_algorithm, split")},
    ),
)
def _(t: Tables):
    return m.average_precision(t.split_scores, MODEL_SPLIT, SCORE, LABEL).select(*MODEL_SPLIT, r6("pr_auc"))


@query(
    "w3_ecdf_distance",
    c.with_blocks("SELECT feature, round(ks_stat, 6) AS ks_stat FROM kss", "model_rows", extra={k: DRIFTS[k] for k in ("long", "vals", "cums", "kss")}),
)
def _(t: Tables):
    totals = drift.value_totals(t.model_rows, "split", "train", "oot", DRIFT_FEATURES)
    return drift.ks_statistic(totals).select("feature", r6("ks_stat"))


@query(
    "w4_newest_versions",
    c.with_blocks(
        "SELECT * FROM (SELECT model_algorithm, snapshot_month, row_count, "
        "CAST(row_number() OVER (PARTITION BY model_algorithm ORDER BY snapshot_month DESC) AS INTEGER) AS recency FROM "
        "(SELECT model_algorithm, snapshot_month, count(*) AS row_count FROM scored GROUP BY ALL)) WHERE recency <= 10",
        "scored",
    ),
)
def _(t: Tables):
    counts = t.scored.groupBy(*MODEL_MONTH).agg(F.count(F.lit(1)).alias("row_count"))
    return registry.newest(counts, ["model_algorithm"], "snapshot_month", keep=10)


@query(
    "w5_reference_month",
    c.with_blocks(
        "SELECT DISTINCT model_algorithm, snapshot_month, min(snapshot_month) OVER (PARTITION BY model_algorithm) AS reference_month "
        "FROM scored",
        "scored",
    ),
)
def _(t: Tables):
    months = t.scored.select(*MODEL_MONTH).distinct()
    first = F.min("snapshot_month").over(Window.partitionBy("model_algorithm"))
    return months.withColumn("reference_month", first)


@query(
    "w6_stratified_folds",
    c.with_blocks(
        "SELECT label, CAST(fold AS INTEGER) AS fold, n // 5 + CASE WHEN fold < n % 5 THEN 1 ELSE 0 END AS rows FROM "
        "(SELECT label, count(*) AS n FROM labels GROUP BY label) CROSS JOIN (SELECT unnest(range(5)) AS fold)",
        "labels",
    ),
)
def _(t: Tables):
    folded = splitting.stratified_folds(t.labels, "label", ["encounter_id"], folds=5, seed=42)
    return folded.groupBy("label", "fold").agg(F.count(F.lit(1)).alias("rows"))


# --- T: sorts and top-k reports -----------------------------------------------------------------------------------
@query(
    "t1_sorted_by_key",
    c.with_blocks("SELECT encounter_id, label, snapshot_date FROM labels", "labels"),
)
def _(t: Tables):
    return t.labels.select("encounter_id", "label", "snapshot_date").orderBy("encounter_id")


LATEST_SQL = c.with_blocks(
    f"SELECT model_algorithm, snapshot_month, {MONITORED_COLUMNS} FROM monitored m WHERE snapshot_month = "
    "(SELECT max(snapshot_month) FROM monitored x WHERE x.model_algorithm = m.model_algorithm)",
    "scored",
    extra=MONITORED,
)


@query("t2_latest_month", LATEST_SQL)
def _(t: Tables):
    return monitoring.latest(monitoring.monitor(t.scored)).select(
        *MODEL_MONTH, "row_count", r6("auc"), r6("gini"), r6("psi")
    )


@query(
    "t3_top_features",
    "SELECT 'logistic_regression' AS algorithm, 'coefficients' AS method, CAST(unnest(range(1, 15)) AS INTEGER) AS position, "
    "TRUE AS known, TRUE AS ordered",
)
def _(t: Tables):
    model = training.fit("logistic_regression", _training_rows(t), fv.MODEL_FEATURES)
    top = training.top_features(training.feature_importance(t.spark, model, "logistic_regression"))
    by_size = Window.orderBy(F.abs("importance").desc(), "feature")  # a report of a few rows
    ahead = F.coalesce(F.lag(F.abs("importance")).over(by_size) >= F.abs("importance"), F.lit(True))
    return top.select(
        "algorithm",
        "method",
        F.row_number().over(by_size).alias("position"),
        F.col("feature").isin(*fv.MODEL_FEATURES).alias("known"),
        ahead.alias("ordered"),
    )


@query(
    "t4_models_by_oot_gini",
    c.with_blocks("SELECT model, round(oot_gini, 6) AS oot_gini FROM wide", "split_scores", extra=WIDE),
)
def _(t: Tables):
    return registry.ranked_models(_wide(t)).select("model", r6("oot_gini"))


@query(
    "t5_versions_newest_first",
    c.with_blocks(
        "SELECT * FROM (SELECT model_algorithm AS algorithm, snapshot_month AS version, "
        "CAST(row_number() OVER (PARTITION BY model_algorithm ORDER BY snapshot_month DESC) AS INTEGER) AS recency, round(auc, 6) AS auc FROM aucs) "
        "WHERE recency <= 10",
        "scored",
        extra={"aucs": c.auc_sql("scored", "model_algorithm, snapshot_month")},
    ),
)
def _(t: Tables):
    auc = m.roc_auc(t.scored, MODEL_MONTH, SCORE, LABEL)
    versions = auc.select(F.col("model_algorithm").alias("algorithm"), F.col("snapshot_month").alias("version"), r6("auc"))
    return registry.newest(versions, ["algorithm"], "version").select("algorithm", "version", "recency", "auc")


@query(
    "t6_top_drifted",
    c.with_blocks(
        "SELECT feature, round(ks_stat, 6) AS ks_stat, round(psi, 6) AS psi FROM drifts WHERE drift_detected "
        "ORDER BY psi DESC, feature LIMIT 15",
        "wide_scores",
        extra=SCORE_DRIFTS,
    ),
)
def _(t: Tables):
    table = drift.drift_table(t.wide_scores, SCORE_FEATURES)
    return drift.top_drifted(table).select("feature", r6("ks_stat"), r6("psi"))


@query("t7_months_ascending", c.with_blocks("SELECT DISTINCT snapshot_month FROM scored", "scored"))
def _(t: Tables):
    return t.scored.select("snapshot_month").distinct().orderBy("snapshot_month")


# --- E: classification metrics ------------------------------------------------------------------------------------------
@query("e1_confusion_rates", c.with_blocks(f"SELECT model_algorithm, split, {RATES_SQL} FROM conf", "split_scores", extra={"conf": CONFUSION_SQL}))
def _(t: Tables):
    rated = _confusion(t).select(*MODEL_SPLIT, *m.rates())
    return rated.select(*MODEL_SPLIT, r6("accuracy"), r6("precision"), r6("recall"), r6("f1"))


AUCS = {"aucs": c.auc_sql("scored", "model_algorithm, snapshot_month")}


@query(
    "e2_roc_auc",
    c.with_blocks(f"SELECT model_algorithm, snapshot_month, {AUC_COLUMNS} FROM aucs", "scored", extra=AUCS),
)
def _(t: Tables):
    return m.roc_auc(t.scored, MODEL_MONTH, SCORE, LABEL).select(*MODEL_MONTH, "pos", "neg", r6("auc"))


@query(
    "e3_gini",
    c.with_blocks("SELECT model_algorithm, snapshot_month, round(2 * auc - 1, 6) AS gini FROM aucs", "scored", extra=AUCS),
)
def _(t: Tables):
    auc = m.roc_auc(t.scored, MODEL_MONTH, SCORE, LABEL)
    return auc.select(*MODEL_MONTH, r6(m.gini(F.col("auc"))).alias("gini"))


@query(
    "e4_average_precision",
    c.with_blocks(
        "SELECT snapshot_month, round(pr_auc, 6) AS pr_auc FROM aps",
        "volume",
        extra={"aps": c.average_precision_sql("volume", "snapshot_month")},
    ),
)
def _(t: Tables):
    return m.average_precision(t.volume, ["snapshot_month"], SCORE, LABEL).select("snapshot_month", r6("pr_auc"))


@query(
    "e5_balanced_score",
    c.with_blocks(
        "SELECT model_algorithm, split, round((CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2, 6) "
        "AS balanced FROM conf",
        "split_scores",
        extra={"conf": CONFUSION_SQL},
    ),
)
def _(t: Tables):
    return _confusion(t).select(*MODEL_SPLIT, r6(m.balanced_score()).alias("balanced"))


@query(
    "e1_document_label_rates",
    "WITH conf AS (SELECT lang, count(*) FILTER (WHERE p = 1 AND quality = 1) AS tp, count(*) FILTER (WHERE p = 1 AND quality = 0) AS fp, "
    "count(*) FILTER (WHERE p = 0 AND quality = 0) AS tn, count(*) FILTER (WHERE p = 0 AND quality = 1) AS fn FROM "
    "(SELECT lang, quality, CASE WHEN n_chars > 500 THEN 1 ELSE 0 END AS p FROM labels JOIN documents USING (doc_id)) GROUP BY lang) "
    f"SELECT lang, tp, fp, tn, fn, {RATES_SQL} FROM conf",
)
def _(t: Tables):
    rows = t.table("labels").join(t.table("documents").select("doc_id", "lang", "n_chars"), "doc_id")
    counts = m.confusion(rows, ["lang"], F.when(F.col("n_chars") > 500, 1).otherwise(0), F.col("quality"))
    rated = counts.select("lang", "tp", "fp", "tn", "fn", *m.rates())
    return rated.select("lang", "tp", "fp", "tn", "fn", r6("accuracy"), r6("precision"), r6("recall"), r6("f1"))


# --- D: drift, monitoring, governance --------------------------------------------------------------------------------------
@query(
    "d1_psi_by_month",
    c.with_blocks(
        "SELECT model_algorithm, snapshot_month, row_count, round(psi, 6) AS psi FROM psis", "scored", extra=c.psi_blocks("scored")
    ),
)
def _(t: Tables):
    psi = drift.population_stability(t.scored, ["model_algorithm"], "snapshot_month", SCORE)
    return psi.select(*MODEL_MONTH, "row_count", r6("psi"))


CSI_TERM = c.term("es", "ac")


@query(
    "d2_csi_by_day",
    "WITH shares AS (SELECT day, category, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY day) AS share FROM "
    "(SELECT CAST(ts AS DATE) AS day, event_type AS category FROM events) GROUP BY day, category), "
    "ref AS (SELECT category, share FROM shares WHERE day = (SELECT min(day) FROM shares)) "
    "SELECT 'event_type' AS feature, d.day AS period, round(sum(" + c.term("coalesce(r.share, 1e-6)", "coalesce(s.share, 1e-6)") + "), 6) AS csi "
    "FROM (SELECT DISTINCT day FROM shares) d CROSS JOIN (SELECT DISTINCT category FROM shares) g "
    "LEFT JOIN shares s ON s.day = d.day AND s.category = g.category LEFT JOIN ref r ON r.category = g.category GROUP BY d.day",
)
def _(t: Tables):
    events = t.table("events").select(F.to_date("ts").alias("period"), "event_type")
    return drift.characteristic_stability_by_period(events, "period", ["event_type"]).select("feature", "period", r6("csi"))


CSI_FEATURES = ["race", "age", "diag_1"]


@query(
    "d2_csi_train_oot",
    c.with_blocks(
        f"SELECT feature, round(sum({CSI_TERM}), 6) AS csi FROM (SELECT feature, category, coalesce(e.share, 1e-6) AS es, "
        "coalesce(a.share, 1e-6) AS ac FROM (SELECT * FROM shares WHERE split = 'train') e FULL JOIN "
        "(SELECT * FROM shares WHERE split = 'oot') a USING (feature, category)) GROUP BY feature",
        "silver",
        extra={
            "long": " UNION ALL ".join(
                f"SELECT '{f}' AS feature, {c.SPLIT} AS split, {f} AS category FROM silver WHERE {f} IS NOT NULL" for f in CSI_FEATURES
            ),
            "shares": "SELECT feature, split, category, CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY feature, split) AS share "
            "FROM long WHERE split IS NOT NULL GROUP BY feature, split, category",
        },
    ),
)
def _(t: Tables):
    rows = dates.with_split(t.silver.select(*CSI_FEATURES, "snapshot_date"), SPLITS)
    return drift.sample_stability(rows, CSI_FEATURES).select("feature", r6("csi"))


@query(
    "d3_quantile_psi",
    c.with_blocks("SELECT feature, round(psi, 6) AS psi FROM qpsi", "model_rows", extra={k: v for k, v in DRIFTS.items() if k != "drifts"}),
)
def _(t: Tables):
    totals = drift.value_totals(t.model_rows, "split", "train", "oot", DRIFT_FEATURES)
    return drift.quantile_psi(totals).select("feature", r6("psi"))


@query(
    "d4_ks_test",
    c.with_blocks(
        "SELECT feature, round(ks_stat, 6) AS ks_stat, round(p_value, 6) AS p_value, "
        "CASE WHEN few THEN 'exact' ELSE 'asymptotic' END AS method FROM ksp",
        "model_rows",
        extra={k: DRIFTS[k] for k in ("long", "vals", "cums", "kss", "lams", "walk", "walked", "ksp")},
    ),
)
def _(t: Tables):
    totals = drift.value_totals(t.model_rows, "split", "train", "oot", DRIFT_FEATURES)
    return drift.ks_statistic(totals).select("feature", r6("ks_stat"), r6("p_value"), "method")


@query(
    "d5_drift_table",
    c.with_blocks(
        f"SELECT feature, {r6_sql('ks_stat', 'p_value', 'psi')}, drift_detected FROM drifts", "model_rows", extra=c.drift_blocks(c.STORED)
    ),
)
def _(t: Tables):
    table = drift.drift_table(t.model_rows, fv.MODEL_FEATURES)
    return table.select("feature", r6("ks_stat"), r6("p_value"), r6("psi"), "drift_detected")


@query(
    "d5_drift_summary",
    c.with_blocks(
        "SELECT count(*) AS features, count(*) FILTER (WHERE drift_detected) AS drifted, "
        "round(avg(CASE WHEN drift_detected THEN CAST(100 AS DOUBLE) ELSE 0 END), 6) AS drifted_pct FROM drifts",
        "wide_scores",
        extra=SCORE_DRIFTS,
    ),
)
def _(t: Tables):
    summary = drift.drift_summary(drift.drift_table(t.wide_scores, SCORE_FEATURES))
    return summary.select("features", "drifted", r6("drifted_pct"))


@query(
    "d6_train_baseline",
    c.with_blocks(
        f"SELECT feature, {r6_sql(*STATS)} FROM stats",
        "model_rows",
        extra={
            "train_rows": "SELECT * FROM model_rows WHERE split = 'train'",
            "long": c.feature_long(BASELINE_FEATURES, "train_rows"),
            "stats": "SELECT feature, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min, max(value) AS max, "
            "quantile_cont(value, 0.25) AS q25, quantile_cont(value, 0.5) AS q50, quantile_cont(value, 0.75) AS q75 FROM long GROUP BY feature",
        },
    ),
)
def _(t: Tables):
    train = t.model_rows.where(F.col("split") == "train")
    return drift.baseline_statistics(train, BASELINE_FEATURES).select("feature", *[r6(s) for s in STATS])


@query("d7_psi_band", c.with_blocks(f"SELECT model_algorithm, snapshot_month, {c.BAND} AS psi_band FROM psis", "scored", extra=c.psi_blocks("scored")))
def _(t: Tables):
    psi = drift.population_stability(t.scored, ["model_algorithm"], "snapshot_month", SCORE)
    return psi.select(*MODEL_MONTH, stability.psi_band(F.col("psi")).alias("psi_band"))


@query("d8_health_status", c.with_blocks(f"SELECT model_algorithm, snapshot_month, {c.STATUS} AS status FROM monitored", "scored", extra=MONITORED))
def _(t: Tables):
    return monitoring.with_status(monitoring.monitor(t.scored)).select(*MODEL_MONTH, "status")


@query(
    "d9_monthly_monitoring",
    c.with_blocks(
        f"SELECT model_algorithm, snapshot_month, {MONITORED_COLUMNS}, {c.BAND} AS psi_band, {c.STATUS} AS status FROM monitored",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    report = monitoring.with_status(monitoring.monitor(t.scored))
    return report.select(*MODEL_MONTH, "row_count", r6("auc"), r6("gini"), r6("psi"), "psi_band", "status")


@query(
    "d9_volume_monitoring",
    c.with_blocks(
        f"SELECT model_algorithm, snapshot_month, {MONITORED_COLUMNS} FROM monitored", "volume", extra=c.monitoring_blocks("volume")
    ),
)
def _(t: Tables):
    return monitoring.monitor(t.volume).select(*MODEL_MONTH, "row_count", r6("auc"), r6("gini"), r6("psi"))


DECIDED_SQL = c.with_blocks(
    f"SELECT model_algorithm, snapshot_month, {MONITORED_COLUMNS}, {c.STATUS} AS status, {c.DECISION} AS decision, "
    f"({c.DECISION}) = 'Retrain' AS retrain_needed, {c.REASON} AS reason FROM monitored",
    "scored",
    extra=MONITORED,
)


def decisions(t: Tables):
    """The flagship: which models have degraded in which month, and must they be retrained?"""
    decided = jobs.monitor_and_decide(t.predictions, t.labels, CONFIG.thresholds)
    return decided.select(
        *MODEL_MONTH, "row_count", r6("auc"), r6("gini"), r6("psi"), "status", "decision", "retrain_needed", "reason"
    )


query("d10_governance_decision", DECIDED_SQL)(decisions)


FEATURE_RULES = {"max_psi": ("psi", 0.2), "critical_psi": ("psi", 0.5), "max_ks_stat": ("ks_stat", 0.15), "max_null_pct": ("null_pct", 5.0)}
EXTRA_FEATURE_RULES = {"data_drift_psi": ("psi", 0.2), "missing_rate": ("null_pct", 10.0)}


def _feature_alerts_sql(rules: dict) -> str:
    return " UNION ALL ".join(
        f"SELECT CAST(NULL AS VARCHAR) AS model_algorithm, feature, '{rule}' AS rule, round({metric}, 6) AS value, "
        f'CAST({limit} AS DOUBLE) AS "limit", {metric} > {limit} AS alert FROM seen'
        for rule, (metric, limit) in rules.items()
    )


#: PSI and KS of train against out-of-time, and the share of missing values out of time, by feature.
SEEN = {
    **{k: v for k, v in DRIFTS.items() if k not in ("lams", "walk", "walked", "ksp", "drifts")},
    "missing": " UNION ALL ".join(
        f"SELECT '{f}' AS feature, avg(CASE WHEN {f} IS NULL THEN CAST(100 AS DOUBLE) ELSE 0 END) AS null_pct FROM model_rows WHERE split = 'oot'"
        for f in DRIFT_FEATURES
    ),
    "seen": "SELECT feature, ks_stat, psi, null_pct FROM kss JOIN qpsi USING (feature) JOIN missing USING (feature)",
}


def _feature_observations(t: Tables):
    """(feature, metric, value) of the model features: drift from train to out-of-time, missing values out of time."""
    drifted = drift.drift_table(t.model_rows, fv.MODEL_FEATURES, exact_rows=0)
    missing = drift.null_shares(t.model_rows.where(F.col("split") == "oot"), ["split"], fv.MODEL_FEATURES)
    return layers.stack_rows(
        [
            governance.observations(drifted, ["feature"], ["psi", "ks_stat"]),
            governance.observations(missing, ["feature"], ["null_pct"]),
        ]
    )


def _all_alerts(models, features, rules: dict):
    """Alerts over the long table of all observations: those of models and those of features."""
    by_model = models.withColumn("feature", F.lit(None).cast("string"))
    by_feature = features.withColumn("model_algorithm", F.lit(None).cast("string"))
    found = governance.scan_rules(by_model.unionByName(by_feature), ["model_algorithm", "feature"], rules)
    return found.select("model_algorithm", "feature", "rule", r6("value"), r6("limit"), "alert")


@query(
    "d11_baseline_alerts",
    c.with_blocks(
        "SELECT model_algorithm, CAST(NULL AS VARCHAR) AS feature, rule, round(value, 6) AS value, round(bound, 6) AS \"limit\", alert FROM ("
        "SELECT o.model_algorithm, 'min_gini' AS rule, 2 * o.auc - 1 AS value, 0.9::DOUBLE * (2 * b.auc - 1) AS bound, 2 * o.auc - 1 < 0.9::DOUBLE * (2 * b.auc - 1) AS alert "
        "FROM o JOIN b USING (model_algorithm) UNION ALL "
        "SELECT o.model_algorithm, 'min_auc', o.auc, 0.9::DOUBLE * b.auc, o.auc < 0.9::DOUBLE * b.auc FROM o JOIN b USING (model_algorithm) UNION ALL "
        "SELECT model_algorithm, 'max_pred_shift', shift, 0.05::DOUBLE, shift > 0.05::DOUBLE FROM s UNION ALL "
        "SELECT model_algorithm, 'min_pred_rate', rate, 0.8::DOUBLE * base, rate < 0.8::DOUBLE * base FROM s UNION ALL "
        "SELECT model_algorithm, 'max_pred_rate', rate, 1.2::DOUBLE * base, rate > 1.2::DOUBLE * base FROM s UNION ALL "
        "SELECT model_algorithm, 'min_records_per_month', n, 1000::DOUBLE, n < 1000 FROM s) UNION ALL " + _feature_alerts_sql(FEATURE_RULES),
        "split_scores",
        "model_rows",
        extra={
            **SEEN,
            "aucs": c.auc_sql("split_scores", "model_algorithm, split"),
            "b": "SELECT model_algorithm, auc FROM aucs WHERE split = 'test'",
            "o": "SELECT model_algorithm, auc FROM aucs WHERE split = 'oot'",
            "s": "SELECT model_algorithm, abs(avg(model_predictions) FILTER (WHERE split = 'oot') - avg(model_predictions) "
            "FILTER (WHERE split = 'train')) AS shift, avg(model_predictions) FILTER (WHERE split = 'oot') AS rate, "
            "avg(model_predictions) FILTER (WHERE split = 'test') AS base, CAST((SELECT min(n) FROM (SELECT model_algorithm AS m, "
            "snapshot_month, count(*) AS n FROM split_scores WHERE split = 'oot' GROUP BY ALL) x WHERE x.m = y.model_algorithm) AS DOUBLE) AS n "
            "FROM split_scores y GROUP BY model_algorithm",
        },
    ),
)
def _(t: Tables):
    metrics = ["auc", "gini", "pred_shift", "pred_rate", "row_count"]
    models = governance.observations(_observed(t), ["model_algorithm"], metrics)
    return _all_alerts(models, _feature_observations(t), governance.ALERT_RULES)


def _observed(t: Tables):
    """One row per model: the metrics that rules watch, and ``base_`` ones of the test split."""
    auc = m.roc_auc(t.split_scores, MODEL_SPLIT, SCORE, LABEL)
    quality_now = auc.groupBy("model_algorithm").agg(
        F.max(F.when(F.col("split") == "oot", F.col("auc"))).alias("auc"),
        F.max(F.when(F.col("split") == "test", F.col("auc"))).alias("base_auc"),
    )
    monthly = t.split_scores.groupBy(*MODEL_SPLIT, "snapshot_month").agg(
        F.count(F.lit(1)).alias("n"), F.sum(SCORE).alias("total")
    )
    mean = {s: F.sum(F.when(F.col("split") == s, F.col("total"))) / F.sum(F.when(F.col("split") == s, F.col("n"))) for s in ("train", "test", "oot")}
    scores = monthly.groupBy("model_algorithm").agg(
        F.abs(mean["oot"] - mean["train"]).alias("pred_shift"),
        mean["oot"].alias("pred_rate"),
        mean["test"].alias("base_pred_rate"),
        F.min(F.when(F.col("split") == "oot", F.col("n"))).alias("row_count"),
    )
    return quality_now.join(scores, "model_algorithm").withColumns(
        {"gini": m.gini(F.col("auc")), "base_gini": m.gini(F.col("base_auc"))}
    )


# --- R: registry -------------------------------------------------------------------------------------------------------
def _documents(t: Tables):
    evaluation = _evaluation(t).select(F.col("model_algorithm").alias("algorithm"), F.lit("20010801").alias("version"), "*")
    return registry.performance_documents(evaluation, label_samples(t))


COMPARISON_SQL = c.with_blocks(
    f"SELECT model, train_samples, test_samples, oot_samples, {r6_sql(*WIDE_NAMES)}, 'N/A' AS top_feature FROM wide CROSS JOIN samples",
    "split_scores",
    "labels",
    extra={**WIDE, **SAMPLES},
)


@query("r1_model_performance", COMPARISON_SQL)
def _(t: Tables):
    return jobs.compare(t.spark, registered(t), CONFIG).select(
        "model", "train_samples", "test_samples", "oot_samples", *[r6(n) for n in registry.METRIC_COLUMNS], "top_feature"
    )


@query(
    "r1_temporal_splits",
    "SELECT algorithm, split, first AS start_date, last AS end_date, 14 AS feature_count FROM "
    "(SELECT unnest(['logistic_regression', 'random_forest', 'xgboost']) AS algorithm) CROSS JOIN "
    f"(VALUES {', '.join(repr((n, w.start.isoformat(), w.end.isoformat())) for n, w in SPLITS.named().items())}) w(split, first, last)",
)
def _(t: Tables):
    documents = jobs.performance(t.spark, registered(t))
    windows = F.array(
        *[F.struct(F.lit(n).alias("split"), F.col(f"temporal_splits.{n}").alias("w")) for n in SPLITS.named()]
    )
    each = documents.select("algorithm", "data_info.feature_count", F.inline(windows))
    return each.select("algorithm", "split", "w.start_date", "w.end_date", F.col("feature_count").cast("int").alias("feature_count"))


@query("r2_wide_comparison", COMPARISON_SQL)
def _(t: Tables):
    flat = registry.flatten_documents(_documents(t))
    return flat.select(
        "model", "train_samples", "test_samples", "oot_samples", *[r6(n) for n in registry.METRIC_COLUMNS], "top_feature"
    )


@query("r3_best_models", BEST_SQL)
def _(t: Tables):
    return registry.comparison_document(_comparison(t)).select("best_models.*")


def _comparison(t: Tables):
    position = F.array_position(F.array(*[F.lit(a) for a in fv.ALGORITHMS]), F.col("model"))
    return registry.flatten_documents(_documents(t)).withColumn("position", position)


@query(
    "r4_recommended_model",
    c.with_blocks(
        "SELECT model AS recommended_model, 'Best OOT GINI: ' || printf('%.4f', oot_gini) AS recommendation_reason, "
        "(SELECT count(*) FROM wide) AS models_compared FROM wide ORDER BY oot_gini DESC LIMIT 1",
        "split_scores",
        extra=WIDE,
    ),
)
def _(t: Tables):
    return registry.recommendation(_wide(t))


@query(
    "r5_comparison_needs_two",
    c.with_blocks(
        "SELECT set_size, recommended_model FROM (SELECT 'three' AS set_size, (SELECT model FROM wide ORDER BY oot_gini DESC LIMIT 1) "
        "AS recommended_model) ",
        "split_scores",
        extra=WIDE,
    ),
)
def _(t: Tables):
    whole = _wide(t)
    single = whole.where(F.col("model") == "xgboost")
    named = [("three", whole), ("one", single)]
    return layers.stack_rows(
        [registry.recommendation(rows).select(F.lit(n).alias("set_size"), "recommended_model") for n, rows in named]
    )


@query(
    "r6_chosen_model",
    c.with_blocks(
        "SELECT 'override' AS given, 'random_forest' AS algorithm UNION ALL "
        "SELECT 'recommendation', (SELECT model FROM wide ORDER BY oot_gini DESC LIMIT 1) UNION ALL SELECT 'nothing', 'xgboost'",
        "split_scores",
        extra=WIDE,
    ),
)
def _(t: Tables):
    recommended = registry.recommendation(_wide(t))
    nothing = recommended.where(F.col("models_compared") < 2)
    named = [
        ("override", registry.chosen_model(recommended, "random_forest")),
        ("recommendation", registry.chosen_model(recommended)),
        ("nothing", registry.chosen_model(nothing)),
    ]
    return layers.stack_rows([f.select(F.lit(n).alias("given"), "algorithm") for n, f in named])


def _monthly_documents(t: Tables):
    """A registry in which every model was retrained each month: one version per month."""
    scored = t.split_scores.where(F.col("split") != "train")
    evaluation = m.evaluate(scored, ["model_algorithm", "snapshot_month", "split"], SCORE, LABEL).select(
        F.col("model_algorithm").alias("algorithm"), F.col("snapshot_month").alias("version"), "*"
    )
    samples = scored.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
    return registry.performance_documents(evaluation, samples)


MONTHLY_EVALUATED = c.evaluation_blocks("held_out", "model_algorithm, snapshot_month, split")
INDEX_SQL = (
    "SELECT model_algorithm AS algorithm, snapshot_month AS version, 'models/' || model_algorithm || '/v' || snapshot_month || '/model' "
    "AS model_path, 'models/' || model_algorithm || '/v' || snapshot_month || '/metadata' AS metadata_path, "
    + ", ".join(
        f"round(coalesce(max({n}) FILTER (WHERE split = '{s}'), 0), 6) AS {s}_{short}"
        for n, short in [("auc_roc", "auc"), ("gini", "gini"), ("pr_auc", "pr_auc"), ("accuracy", "accuracy")]
        for s in ("test", "oot")
    )
    + " FROM evaluated GROUP BY ALL"
)
INDEX_METRICS = [f"{s}_{n}" for n in ("auc", "gini", "pr_auc", "accuracy") for s in ("test", "oot")]
INDEX = {"held_out": "SELECT * FROM split_scores WHERE split <> 'train'", **MONTHLY_EVALUATED, "version_rows": INDEX_SQL}


@query("r7_version_index", c.with_blocks("SELECT * FROM version_rows", "split_scores", extra=INDEX))
def _(t: Tables):
    root = t.mart().registry
    index = registry.version_index(_monthly_documents(t), "models")
    version_index.commit(t.spark, root, index, keep=1000)
    return version_index.versions(t.spark, root).select(
        "algorithm", "version", "model_path", "metadata_path", *[r6(n) for n in INDEX_METRICS]
    )


@query(
    "r8_registry_retention",
    c.with_blocks(
        "SELECT algorithm, version, recency FROM (SELECT algorithm, version, CAST(row_number() OVER (PARTITION BY algorithm ORDER BY version DESC) "
        "AS INTEGER) AS recency FROM version_rows) WHERE recency <= 10",
        "split_scores",
        extra=INDEX,
    ),
)
def _(t: Tables):
    root = t.mart().registry
    index = materialize(registry.version_index(_monthly_documents(t), "models"), "index")
    early = F.col("version") < "2001-06"
    for rows in (index.where(early), index.where(~early)):  # two commits: the second pushes versions of the first out
        version_index.commit(t.spark, root, rows)
    kept = version_index.versions(t.spark, root)
    return registry.newest(kept, ["algorithm"], "created_at", keep=1000).select("algorithm", "version", "recency")


# --- X: documented options -------------------------------------------------------------------------------------------------
@query(
    "x2_drift_zones",
    c.with_blocks(
        "SELECT model_algorithm, snapshot_month, CASE WHEN auc >= 0.75 THEN 'green' WHEN auc >= 0.7 THEN 'yellow' WHEN auc IS NOT NULL "
        "THEN 'red' END AS auc_zone, CASE WHEN psi < 0.1 THEN 'green' WHEN psi <= 0.25 THEN 'yellow' WHEN psi IS NOT NULL THEN 'red' END "
        "AS psi_zone, CASE WHEN gini >= 0.5 THEN 'green' WHEN gini >= 0.4 THEN 'yellow' WHEN gini IS NOT NULL THEN 'red' END AS gini_zone, "
        "CASE WHEN row_count > 500 THEN 'green' WHEN row_count >= 100 THEN 'yellow' ELSE 'red' END AS volume_zone FROM monitored",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    return monitoring.drift_zones(monitoring.monitor(t.scored))


@query(
    "x3_documented_alerts",
    c.with_blocks(
        "SELECT model_algorithm, CAST(NULL AS VARCHAR) AS feature, 'accuracy_drop' AS rule, round(o, 6) AS value, round(0.95::DOUBLE * b, 6) AS \"limit\", o < 0.95::DOUBLE * b AS alert FROM "
        f"(SELECT model_algorithm, max(acc) FILTER (WHERE split = 'oot') AS o, max(acc) FILTER (WHERE split = 'test') AS b FROM "
        f"(SELECT model_algorithm, split, {c.RATES['accuracy']} AS acc FROM conf) GROUP BY 1) UNION ALL "
        + _feature_alerts_sql(EXTRA_FEATURE_RULES),
        "split_scores",
        "model_rows",
        extra={"conf": CONFUSION_SQL, **SEEN},
    ),
)
def _(t: Tables):
    accuracy = _confusion(t).select(*MODEL_SPLIT, m.rates()[0])
    observed = accuracy.groupBy("model_algorithm").agg(
        F.max(F.when(F.col("split") == "oot", F.col("accuracy"))).alias("accuracy"),
        F.max(F.when(F.col("split") == "test", F.col("accuracy"))).alias("base_accuracy"),
    )
    models = governance.observations(observed, ["model_algorithm"], ["accuracy"])
    return _all_alerts(models, _feature_observations(t), governance.EXTRA_ALERT_RULES)


@query(
    "x4_test_oot_degradation",
    c.with_blocks("SELECT model, round((oot_auc - test_auc) / test_auc, 6) AS degradation FROM wide", "split_scores", extra=WIDE),
)
def _(t: Tables):
    return registry.degradation(_wide(t)).select("model", r6("degradation"))


@query(
    "x6_exit_codes",
    c.with_blocks(
        f"SELECT model_algorithm, snapshot_month, CASE {c.DECISION} WHEN 'Retrain' THEN 2 WHEN 'Schedule Retrain' THEN 1 ELSE 0 END AS exit_code "
        "FROM monitored",
        "scored",
        extra=MONITORED,
    ),
)
def _(t: Tables):
    decided = governance.decide(monitoring.monitor(t.scored))
    return decided.select(*MODEL_MONTH, governance.exit_code(F.col("decision")).alias("exit_code"))


# --- M: training and scoring ---------------------------------------------------------------------------------------------------
def _scaled(t: Tables):
    """Preprocessed splits over a stored table, which is what fitting reads again and again."""
    stored = materialize(t.model_rows.select(*training.KEY, *fv.MODEL_FEATURES, "label", "split"), "model-rows")
    scaled, _scaler = scaling.preprocess(stored)
    return scaled


def _training_rows(t: Tables):
    return _train_of(_scaled(t))


def _train_of(splits):
    return splits.where(F.col("split") == "train").drop("split")


FEATURE_SQL = "(SELECT unnest([" + ", ".join(f"'{f}'" for f in fv.MODEL_FEATURES) + "]) AS feature)"


def _tree_sql(algorithm: str) -> str:
    """Importances are shares: none below zero, one in all."""
    return (
        f"SELECT '{algorithm}' AS algorithm, 'feature_importances' AS method, feature, TRUE AS not_negative, "
        f"CAST(1 AS DOUBLE) AS importance_sum FROM {FEATURE_SQL}"
    )


def _shares(importance):
    """Each feature of a tree model, whether its importance is a share, and the sum of all."""
    total = F.sum("importance").over(Window.partitionBy("algorithm"))
    return importance.select(
        "algorithm", "method", "feature", (F.col("importance") >= 0).alias("not_negative"), F.round(total, 6).alias("importance_sum")
    )


def _fitted_shares(t: Tables, algorithm: str, **params):
    model = training.fit(algorithm, _training_rows(t), fv.MODEL_FEATURES, **params)
    return _shares(training.feature_importance(t.spark, model, algorithm))


@query(
    "m1_logistic_regression",
    c.with_blocks(
        "SELECT 'logistic_regression' AS algorithm, 'coefficients' AS method, feature, TRUE AS finite, rows, "
        f"round(weighted, 3) AS weighted_probability FROM {FEATURE_SQL} CROSS JOIN "
        "(SELECT count(*) AS rows, sum(label * n / (2 * n1)) / sum(CASE WHEN label = 1 THEN n / (2 * n1) ELSE n / (2 * n0) END) AS weighted "
        "FROM (SELECT label, CAST(count(*) OVER () AS DOUBLE) AS n, CAST(sum(label) OVER () AS DOUBLE) AS n1, "
        "CAST(count(*) OVER () - sum(label) OVER () AS DOUBLE) AS n0 FROM model_rows WHERE split = 'train'))",
        "model_rows",
    ),
)
def _(t: Tables):
    """With a free intercept the weighted mean probability of the fitted rows is their weighted mean label."""
    train = _training_rows(t)
    model = training.fit("logistic_regression", train, fv.MODEL_FEATURES, penalty="l2", C=0.1, class_weight="balanced")
    weighted = training.with_class_weight(
        training.probability(model, train, fv.MODEL_FEATURES, "p"), training.ClassBalance.of(train), "balanced"
    )
    weight = F.col(training.WEIGHT)
    fitted = weighted.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("p") * weight) / F.sum(weight), 3).alias("weighted_probability")
    )
    importance = training.feature_importance(t.spark, model, "logistic_regression")
    finite = ~F.isnan("importance") & (F.abs("importance") < float("inf"))
    return importance.select("algorithm", "method", "feature", finite.alias("finite")).join(F.broadcast(fitted))  # one row


@query("m2_random_forest", _tree_sql("random_forest"))
def _(t: Tables):
    return _fitted_shares(t, "random_forest", class_weight="balanced")


@query("m3_boosted_trees", _tree_sql("xgboost"))
def _(t: Tables):
    return _fitted_shares(t, "xgboost", class_weight="scale_pos_weight", subsample=0.8)


@query("m4_second_boosted_variant", _tree_sql("lightgbm"))
def _(t: Tables):
    return _fitted_shares(t, "lightgbm", class_weight=3.0, min_leaf=20, column_share=0.8)


HELD_OUT_SQL = "SELECT split, count(*) AS rows FROM model_rows WHERE split <> 'train' GROUP BY split"


def _in_range(score: str):
    return F.bool_and(F.col(score).between(0, 1)).alias("in_range")


@query(
    "m5_random_search",
    c.with_blocks(
        "SELECT model_algorithm, split, rows, TRUE AS in_range, 20 AS settings, TRUE AS from_the_space FROM "
        "(SELECT unnest(['logistic_regression', 'random_forest', 'xgboost']) AS model_algorithm) "
        f"CROSS JOIN ({HELD_OUT_SQL})",
        "model_rows",
    ),
)
def _(t: Tables):
    splits, config, scored = _scaled(t), TrainingConfig(), []
    for algorithm in training.SEARCH_SPACES:
        found = training.random_search(algorithm, _train_of(splits), fv.MODEL_FEATURES, config)
        space = training.SEARCH_SPACES[algorithm]
        drawn = training.draw_settings(space, config.search_draws, config.random_state)
        rows = training.probability(found.model, splits.where(F.col("split") != "train"), fv.MODEL_FEATURES, "p")
        scored.append(
            rows.select(
                F.lit(algorithm).alias("model_algorithm"),
                "split",
                "p",
                F.lit(len(drawn)).alias("settings"),
                F.lit(all(found.params[k] in values for k, values in space.items())).alias("from_the_space"),
            )
        )
    return layers.stack_rows(scored).groupBy("model_algorithm", "split", "settings", "from_the_space").agg(
        F.count(F.lit(1)).alias("rows"), _in_range("p")
    )


@query(
    "m6_stratified_split",
    c.with_blocks(
        "SELECT label, part, CASE WHEN part = 'test' THEN test ELSE n - test END AS rows FROM (SELECT label, count(*) AS n, "
        "CAST(floor(count(*) * CAST(0.2 AS DOUBLE) + CAST(0.5 AS DOUBLE)) AS BIGINT) AS test FROM labels GROUP BY label) "
        "CROSS JOIN (SELECT unnest(['train', 'test']) AS part)",
        "labels",
    ),
)
def _(t: Tables):
    parts = splitting.stratified_split(t.labels, "label", ["encounter_id"], test_share=0.2, seed=88)
    return parts.groupBy("label", "part").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "m7_random_split",
    c.with_blocks(
        "SELECT part, count(*) AS rows, CAST(sum(label) AS BIGINT) AS positives FROM (SELECT label, CASE WHEN "
        "CAST('0x' || left(md5('42:' || encounter_id), 8) AS BIGINT) < 3435973837 THEN 'train' ELSE 'test' END AS part FROM labels) "
        "GROUP BY part",
        "labels",
    ),
)
def _(t: Tables):
    parts = splitting.random_split(t.labels, ["encounter_id"], train_share=0.8, seed=42)
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows"), F.sum("label").alias("positives"))


@query("m8_class_weights", c.with_blocks(f"SELECT n0, n1, weight_0, weight_1, scale_pos_weight FROM ({CLASS_SQL})", "model_rows"))
def _(t: Tables):
    counts = splitting.class_counts(t.model_rows.where(F.col("split") == "train"))
    return counts.select("n0", "n1", r6("weight_0"), r6("weight_1"), r6("scale_pos_weight"))


@query(
    "m9_evaluate_models",
    c.with_blocks(
        f"SELECT model_algorithm, split, CAST(rows AS BIGINT) AS rows, {r6_sql(*fv.METRICS, 'balanced')} FROM evaluated",
        "split_scores",
        extra=EVALUATED,
    ),
)
def _(t: Tables):
    return _evaluation(t).select(*MODEL_SPLIT, "rows", *[r6(n) for n in fv.METRICS], r6("balanced"))


@query(
    "m10_feature_importance",
    "SELECT algorithm, CASE algorithm WHEN 'logistic_regression' THEN 'coefficients' ELSE 'feature_importances' END AS method, feature, "
    "CASE WHEN algorithm <> 'logistic_regression' THEN CAST(1 AS DOUBLE) END AS importance_sum, 14 AS ranks "
    f"FROM (SELECT unnest(['logistic_regression', 'random_forest', 'xgboost']) AS algorithm) CROSS JOIN {FEATURE_SQL}",
)
def _(t: Tables):
    train = _training_rows(t)
    found = []
    for algorithm in training.SEARCH_SPACES:
        model = training.fit(algorithm, train, fv.MODEL_FEATURES)
        found.append(training.feature_importance(t.spark, model, algorithm))
    own = Window.partitionBy("algorithm")
    ranked = layers.stack_rows(found).withColumn(
        "rank", F.row_number().over(own.orderBy(F.abs("importance").desc(), "feature"))
    )
    share = F.when(F.col("method") != "coefficients", F.round(F.sum("importance").over(own), 6))
    ranks = F.size(F.collect_set("rank").over(own))
    return ranked.select("algorithm", "method", "feature", share.alias("importance_sum"), ranks.alias("ranks"))


@query(
    "m11_score_snapshot",
    c.with_blocks(
        "SELECT snapshot_date, 'random_forest' AS model_algorithm, count(*) AS rows, TRUE AS in_range FROM model_rows "
        "WHERE split IS NOT NULL GROUP BY snapshot_date",
        "model_rows",
    ),
)
def _(t: Tables):
    """A stored model scores all snapshots."""
    splits = _scaled(t)
    fitted = training.fit("random_forest", _train_of(splits), fv.MODEL_FEATURES)
    model = training.load_model(training.save_model(fitted, t.mart().registry, "random_forest", "1"))
    predictions = training.score(model, splits.drop("split", "label"), fv.MODEL_FEATURES, "random_forest")
    return predictions.groupBy("snapshot_date", "model_algorithm").agg(F.count(F.lit(1)).alias("rows"), _in_range("model_predictions"))


@query(
    "m12_soft_vote",
    c.with_blocks(
        "SELECT encounter_id, snapshot_date, 'voting_ensemble' AS model_algorithm, round(avg(model_predictions), 6) AS model_predictions "
        "FROM preds GROUP BY encounter_id, snapshot_date",
        "preds",
    ),
)
def _(t: Tables):
    return training.soft_vote(t.predictions).select("encounter_id", "snapshot_date", "model_algorithm", r6("model_predictions"))


@query(
    "m13_stacking",
    c.with_blocks(f"SELECT split, rows, TRUE AS in_range FROM ({HELD_OUT_SQL})", "model_rows"),
)
def _(t: Tables):
    splits = _scaled(t)
    model = training.stack(fv.ALGORITHMS, _train_of(splits), fv.MODEL_FEATURES, folds=3)
    scored = model.score(splits.where(F.col("split") != "train"))
    return scored.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), _in_range("model_predictions"))


@query("m14_forest_importance", _tree_sql("random_forest"))
def _(t: Tables):
    rows = materialize(t.model_rows.select(*training.KEY, *fv.MODEL_FEATURES, "label"), "model-rows")
    model = training.fit("random_forest", rows, fv.MODEL_FEATURES, seed=42, trees=100, max_depth=10)
    return _shares(training.top_features(training.feature_importance(t.spark, model, "random_forest")))


@query(
    "m15_saved_model",
    c.with_blocks(
        "SELECT snapshot_date, count(*) AS rows, TRUE AS same, '20010801' AS version FROM model_rows WHERE split = 'oot' GROUP BY snapshot_date",
        "model_rows",
    ),
)
def _(t: Tables):
    """Two versions are trained and registered; the newest is found through the index and scores as it did before."""
    mart, splits, algorithm = t.mart(), _scaled(t), "logistic_regression"
    models = {}
    for version, strength in (("20010701", 1.0), ("20010801", 0.1)):
        models[version] = training.fit(algorithm, _train_of(splits), fv.MODEL_FEATURES, C=strength)
        scored = training.probability(models[version], splits.where("split <> 'train'"), fv.MODEL_FEATURES, SCORE)
        evaluation = m.evaluate(scored, ["split"], SCORE, LABEL)
        named = evaluation.select(F.lit(algorithm).alias("algorithm"), F.lit(version).alias("version"), "*")
        samples = splits.groupBy("split").agg(F.count(F.lit(1)).alias("rows"))
        training.save_model(models[version], mart.registry, algorithm, version)
        jobs.register(t.spark, mart, materialize(registry.performance_documents(named, samples, splits=SPLITS), "documents"))
    newest = version_index.latest(t.spark, mart.registry).first()
    rows = splits.where(F.col("split") == "oot")
    before = training.probability(models["20010801"], rows, fv.MODEL_FEATURES, "before")
    both = training.probability(training.load_model(newest.model_path), before, fv.MODEL_FEATURES, "after")
    return both.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("rows"),
        F.bool_and(F.abs(F.col("before") - F.col("after")) < 1e-12).alias("same"),
        F.lit(newest.version).alias("version"),
    )
