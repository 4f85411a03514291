"""The jobs end to end on a small mart, and the rules of each step."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart import fixed_values as fv
from riskmart import schemas
from riskmart.config import DEFAULT_SPLITS, Thresholds, TrainingConfig, Window, config_from_dict, splits_from_dict
from riskmart.operators import governance, layers, monitoring, quality, registry, scaling, training
from riskmart.plans import catalog, jobs
from riskmart.sources import readers, scratch, writers

CONFIG = catalog.CONFIG.with_(training=TrainingConfig(search_draws=2, cv_folds=2))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return catalog.Tables(spark, sf_dir)


@pytest.fixture(scope="module")
def mart(spark, tables):
    mart = tables.mart()
    jobs.load(spark, tables.raw, mart)
    return mart


def sorted_rows(df):
    return sorted(map(str, df.collect()))


# --- load ----------------------------------------------------------------------------------------
def test_rerun_of_some_months_leaves_the_tables_unchanged(spark, tables, mart):
    def stored():
        return sorted_rows(readers.read_table(spark, mart.features, schemas.FEATURE_STORE))

    before = stored()
    counts = jobs.load(spark, tables.raw, mart, date(1999, 1, 1), date(1999, 12, 31))
    assert {r["layer"] for r in counts.collect()} == {"bronze", "silver", "label_store", "feature_store"}
    assert counts.select("snapshot_month").distinct().count() == 12
    assert stored() == before


def test_csv_bronze_gives_the_same_features(spark, tables, mart):
    other = tables.mart()
    jobs.load(spark, tables.raw, other, date(1998, 1, 1), date(1998, 6, 30), bronze_format="csv")
    months = readers.months_between(readers.read_table(spark, mart.features, schemas.FEATURE_STORE), date(1998, 1, 1), date(1998, 6, 30))
    assert sorted_rows(readers.read_table(spark, other.features, schemas.FEATURE_STORE)) == sorted_rows(months)


def test_stream_loads_each_file_once(spark, tables):
    from riskmart.streaming.incremental import load_new_files

    mart, landing, checkpoints = tables.mart(), tables.path("landing"), tables.path("checkpoints")
    early = F.col("snapshot_date") < "1997-01-01"
    counts = []
    for name, rows in [("a", tables.raw.where(early)), ("b", tables.raw.where(~early)), (None, None)]:
        if name:
            writers.write_csv(rows, f"{landing}/{name}")
        load_new_files(spark, f"{landing}/*", mart, checkpoints)
        counts.append(readers.read_table(spark, mart.features, schemas.FEATURE_STORE).count())
    assert 0 < counts[0] < counts[1] == counts[2] == tables.raw.count()


def test_month_reads(spark, tables, mart):
    table = readers.read_table(spark, mart.labels, schemas.LABEL_STORE)
    month = readers.month_of(table, date(1998, 7, 1))
    assert "PartitionFilters: [isnotnull(snapshot_month" in month._jdf.queryExecution().toString()
    assert readers.month_or_scan(spark, mart.labels, date(2030, 1, 1), schemas.LABEL_STORE).isEmpty()
    with pytest.raises(quality.QualityError):
        quality.require_rows(readers.month_of(table, date(2030, 1, 1)), "2030-01")


def test_scratch_follows_the_session_setting(spark):
    assert scratch.fresh_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# --- preprocess, train, score, monitor, decide ------------------------------------------------------
def test_splits_are_disjoint_and_exhaustive(spark, tables):
    rows = tables.model_rows
    assert rows.count() == tables.labels.count()
    seen = {r["split"]: (r["a"], r["b"]) for r in rows.groupBy("split").agg(F.min("snapshot_date").alias("a"), F.max("snapshot_date").alias("b")).collect()}
    assert seen["train"][1] < seen["test"][0] <= seen["test"][1] < seen["oot"][0]


def test_scaling(spark):
    rows = spark.createDataFrame(
        [(1, 3, "train"), (1, 5, "train"), (1, None, "train"), (1, 9, "oot")], "insulin_ord int, age_midpoint int, split string"
    )
    scaled, scaler = scaling.preprocess(rows, features=["insulin_ord", "age_midpoint"])
    got = [r["age_midpoint"] for r in scaled.collect()]
    assert got[0] == pytest.approx(-1) and got[1] == pytest.approx(1) and got[2] is None
    assert [r["insulin_ord"] for r in scaled.collect()] == [0.0] * 4  # a constant column is centred only
    again = scaling.Scaler.from_table(scaler.table(spark))
    assert again == scaler
    lazy = scaling.scaler_statistics(rows.where("split = 'train'")).collect()
    assert {r["feature"]: (r["log"], r["mean"], r["std_pop"]) for r in lazy} == scaler.stats


@pytest.fixture(scope="module")
def trained(spark, mart):
    run = jobs.preprocess(spark, mart, CONFIG, "run1")
    spaces = {
        "logistic_regression": {"penalty": ["l1", "l2"], "C": [0.1], "class_weight": ["balanced"], "max_iter": [10]},
        "random_forest": {"trees": [5], "max_depth": [3], "min_leaf": [1], "class_weight": [None]},
        "xgboost": {"rounds": [3], "max_depth": [2], "learning_rate": [0.1], "class_weight": ["scale_pos_weight"]},
    }
    return run, {a: jobs.train(spark, mart, run, a, "20010801_000000", CONFIG, space) for a, space in spaces.items()}


def test_training_to_decision(spark, mart, trained):
    run, models = trained
    splits, scaler = jobs.load_run(spark, run)
    assert {r["split"] for r in splits.select("split").distinct().collect()} == {"train", "test", "oot"}
    assert set(scaler.stats) == set(fv.LOG_SCALE_COLUMNS + fv.SCALE_ONLY_COLUMNS)

    comparison = jobs.compare(spark, mart, CONFIG)
    rows = {r["model"]: r for r in comparison.collect()}
    assert set(rows) == set(models) and set(comparison.columns) >= set(registry.COMPARISON_COLUMNS)
    assert all(0 <= r["oot_auc"] <= 1 and r["top_feature"] in fv.MODEL_FEATURES for r in rows.values())
    best = max(rows.values(), key=lambda r: (r["oot_gini"], -r["position"]))["model"]
    assert jobs.pick_algorithm(comparison) == best
    assert jobs.pick_algorithm(comparison, "random_forest") == "random_forest"
    assert jobs.pick_algorithm(None) == "xgboost"

    for month in (date(2001, 1, 1), date(2001, 2, 1)):
        stored = jobs.score_month(spark, mart, models[best], run, best, month)
        features = readers.month_of(readers.read_table(spark, mart.features, schemas.FEATURE_STORE), month)
        assert stored.count() == features.count() > 0
        assert stored.where(~F.col("model_predictions").between(0, 1)).isEmpty()
    jobs.score_month(spark, mart, models[best], run, best, date(2001, 2, 1))  # replaces, does not double

    monitored = jobs.monitor(spark, mart)
    assert [r["snapshot_month"] for r in monitored.orderBy("snapshot_month").collect()] == ["2001-01", "2001-02"]
    decided = jobs.govern(monitored, mart, auto_retrain=True).collect()
    assert len(decided) == 1 and decided[0]["snapshot_month"] == "2001-02"
    assert decided[0]["decision"] in (governance.RETRAIN, governance.SCHEDULE, governance.NO_ACTION)


def test_uploaded_features_are_scored(spark, tables, mart, trained):
    run, models = trained
    upload = readers.month_of(readers.read_table(spark, mart.features, schemas.FEATURE_STORE), date(2001, 3, 1))
    writers.write_months(upload, mart.uploads)
    got = jobs.score_month(spark, mart, models["random_forest"], run, "random_forest", date(2001, 3, 1), uploaded=True)
    assert got.count() == upload.count()


# --- ML on a planted signal ---------------------------------------------------------------------------
@pytest.fixture(scope="module")
def planted(spark):
    x = (F.xxhash64("id") % 1000) / 1000.0
    z = (F.xxhash64("id", F.lit(1)) % 1000) / 1000.0
    noise = (F.xxhash64("id", F.lit(2)) % 1000) / 1000.0
    return spark.range(0, 800).select(
        F.col("id").alias("encounter_id"),
        F.lit(date(2000, 1, 1)).alias("snapshot_date"),
        x.alias("x"),
        z.alias("z"),
        F.lit(None).cast("double").alias("empty"),
        (x + 0.3 * noise > 0).cast("int").alias("label"),
    ).cache()


FEATURES = ["x", "z", "empty"]


@pytest.mark.parametrize(
    ("algorithm", "params"),
    [
        ("logistic_regression", {"max_iter": 20, "C": 10}),
        ("random_forest", {"trees": 10, "max_depth": 4}),
        ("xgboost", {"rounds": 5, "max_depth": 3}),
        ("lightgbm", {"rounds": 5, "max_depth": 3, "class_weight": 3.0}),
    ],
)
def test_models_find_the_signal(spark, planted, algorithm, params):
    model = training.fit(algorithm, planted, FEATURES, **params)
    scored = training.probability(model, planted, FEATURES, "p")
    assert scored.columns == [*planted.columns, "p"]
    assert scored.where("empty is not null").isEmpty()  # inputs come back as they were
    assert scored.count() == 800
    from riskmart.operators.metrics import roc_auc

    assert roc_auc(scored, [], "p", "label").first()["auc"] > 0.9
    ranked = training.top_features(training.feature_importance(spark, model, algorithm)).collect()
    assert ranked[0]["feature"] == "x" and len(ranked) == 3
    again = training.probability(training.fit(algorithm, planted, FEATURES, **params), planted, FEATURES, "p")
    assert scored.agg(F.round(F.sum("p"), 6)).first() == again.agg(F.round(F.sum("p"), 6)).first()


@pytest.mark.parametrize("packed", [False, True])
def test_a_linear_fit_takes_its_rows_once_and_leaves_nothing_kept(spark, planted, packed):
    passed = spark.sparkContext.accumulator(0)
    rows = planted.withColumn("x", F.udf(lambda x: passed.add(1) or x, "double")("x"))
    balance, kept = training.ClassBalance.of(planted), spark.sparkContext._jsc.getPersistentRDDs
    before = set(kept())
    if packed:
        table = training.assembler(FEATURES).transform(training.fill_missing(rows, FEATURES))
        training.fit_packed("logistic_regression", table, balance)
    else:
        training.fit("logistic_regression", rows, FEATURES)
    assert passed.value == 800 and set(kept()) <= before


@pytest.mark.parametrize("metric", ["auc", "balanced"])
def test_random_search(planted, metric):
    space = {"penalty": ["l2"], "C": [0.001, 10], "class_weight": [None, "balanced"], "max_iter": [10]}
    found = training.random_search(
        "logistic_regression", planted, FEATURES, TrainingConfig(search_draws=4, cv_folds=2, search_metric=metric), space
    )
    assert found.score > 0.8 and set(found.params) == set(space)


def test_search_settings_are_seeded():
    space = training.SEARCH_SPACES["xgboost"]
    assert training.draw_settings(space, 20, 42) == training.draw_settings(space, 20, 42)
    assert len({str(s) for s in training.draw_settings(space, 20, 42)}) == 20
    assert len(training.draw_settings({"a": [1, 2]}, 20, 42)) == 2


def test_class_weights():
    balance = training.ClassBalance(90, 10)
    assert balance.weights(None) == (1.0, 1.0)
    assert balance.weights("balanced") == (100 / 180, 5.0)
    assert balance.weights("scale_pos_weight") == (1.0, 9.0)
    assert balance.weights(3.0) == (1.0, 3.0)


def test_stacking_and_voting(planted):
    settings = {"logistic_regression": {"max_iter": 10}, "random_forest": {"trees": 5, "max_depth": 3}}
    held_out = training.out_of_fold(list(settings), planted, FEATURES, folds=2, settings=settings)
    assert held_out.count() == 800 and held_out.where("p_random_forest is null").isEmpty()
    stacked = training.stack(list(settings), planted, FEATURES, folds=2, settings=settings)
    scores = stacked.score(planted)
    from riskmart.operators.metrics import roc_auc

    assert roc_auc(scores, [], "model_predictions", "label").first()["auc"] > 0.9
    base = [training.score(m, planted, FEATURES, a) for a, m in stacked.base.items()]
    vote = training.soft_vote(layers.stack_rows(base), list(settings))
    assert vote.count() == 800


# --- monitoring and governance rules --------------------------------------------------------------------
CASES = [
    # auc, psi, status, decision
    (0.70, 0.10, "healthy", "No Action"),
    (0.6999, 0.0, "critical", "Retrain"),
    (0.80, 0.25, "warning", "Schedule Retrain"),
    (0.80, 0.2501, "critical", "Retrain"),
    (0.60, 0.30, "critical", "Retrain"),
    (0.60, 0.20, "critical", "Retrain"),
    (None, 0.11, "warning", "Schedule Retrain"),
    (None, None, "healthy", "No Action"),
    (0.90, None, "healthy", "No Action"),
]


@pytest.fixture(scope="module")
def cases(spark):
    rows = [("m", f"2000-{i + 1:02d}", 10, a, None if a is None else 2 * a - 1, p) for i, (a, p, *_x) in enumerate(CASES)]
    return spark.createDataFrame(rows, schemas.MONITORING)


def test_status_and_decision(cases):
    decided = governance.decide(monitoring.with_status(cases)).orderBy("snapshot_month").collect()
    assert [(r["status"], r["decision"]) for r in decided] == [c[2:] for c in CASES]
    assert [r["retrain_needed"] for r in decided] == [c[3] == "Retrain" for c in CASES]
    reasons = [r["reason"] for r in decided]
    assert reasons[0] == governance.HEALTHY_REASON
    assert reasons[1] == "AUC (0.6999) below threshold (0.70)"
    assert reasons[4] == "AUC (0.6000) below threshold (0.70); PSI (0.3000) exceeds critical threshold (0.25)"
    assert reasons[5] == "AUC (0.6000) below threshold (0.70)"
    assert reasons[6] == "PSI (0.1100) exceeds warning threshold (0.10)"


def test_decision_never_weakens_as_psi_grows(spark):
    strength = {"No Action": 0, "Schedule Retrain": 1, "Retrain": 2}
    rows = spark.createDataFrame([("m", f"{i:03d}", 1, 0.8, 0.6, i / 100) for i in range(50)], schemas.MONITORING)
    got = [strength[r["decision"]] for r in governance.decide(rows).orderBy("snapshot_month").collect()]
    assert got == sorted(got)


def test_triggers_and_exit_codes(cases):
    off, on = governance.decide(cases), governance.decide(cases, auto_retrain=True)
    assert governance.retrain_triggers(off).isEmpty()
    assert governance.retrain_triggers(on).count() == sum(c[3] == "Retrain" for c in CASES)
    codes = on.orderBy("snapshot_month").select(governance.exit_code(F.col("decision"))).collect()
    assert [r[0] for r in codes] == [{"No Action": 0, "Schedule Retrain": 1, "Retrain": 2}[c[3]] for c in CASES]
    strict = governance.decide(cases, Thresholds(auc=0.95)).where("auc is not null")
    assert strict.where("decision <> 'Retrain'").isEmpty()


def test_alerts_use_the_metrics_present(spark):
    seen = spark.createDataFrame([("m", 0.5, 0.6, 0.3, 500)], "model string, gini double, base_gini double, psi double, row_count int")
    found = {r["rule"]: r["alert"] for r in governance.alerts(seen, ["model"]).collect()}
    assert found == {"min_gini": True, "max_psi": True, "critical_psi": False, "min_records_per_month": True}
    with pytest.raises(ValueError):
        governance.alerts(seen.select("model"), ["model"])


# --- registry -----------------------------------------------------------------------------------------------
def comparison(spark, rows):
    filled = [(m, i, *[g] * len(registry.METRIC_COLUMNS)) for i, (m, g) in enumerate(rows)]
    schema = ", ".join(["model string, position int", *[f"{c} double" for c in registry.METRIC_COLUMNS]])
    return spark.createDataFrame(filled, schema)


def test_ties_go_to_the_first_listed(spark):
    tied = comparison(spark, [("a", 0.2), ("b", 0.5), ("c", 0.5)])
    assert registry.recommendation(tied).first()["recommended_model"] == "b"
    assert set(registry.best_models(tied).first()) == {"b"}
    document = registry.comparison_document(tied).first()
    assert [r["model"] for r in document["comparison_table"]] == ["b", "c", "a"]
    assert document["recommendation_reason"] == "Best OOT GINI: 0.5000"


def test_absent_metrics_have_defaults(spark):
    names = ", ".join(f"{m} double" for m in fv.METRICS)
    evaluation = spark.createDataFrame([("a", "1", "test", *[0.7] * len(fv.METRICS))], f"algorithm string, version string, split string, {names}")
    samples = spark.createDataFrame([("train", 5), ("test", 2)], "split string, rows long")
    row = registry.flatten_documents(registry.performance_documents(evaluation, samples)).first()
    assert (row["test_auc"], row["oot_auc"], row["oot_samples"], row["top_feature"]) == (0.7, 0.0, 0, "N/A")


def test_one_model_gives_no_comparison(spark):
    single = comparison(spark, [("a", 0.2)])
    assert registry.comparison_document(single).isEmpty()
    assert registry.chosen_model(registry.recommendation(single)).first()["algorithm"] == "xgboost"


def test_retention_and_latest(spark):
    versions = spark.createDataFrame([("m", f"v{i:02d}", i) for i in range(15)] + [("n", "v01", 1)], "algorithm string, version string, x int")
    kept = registry.newest(versions, ["algorithm"], "version", keep=10)
    assert kept.count() == 11 and kept.where("algorithm = 'm'").agg(F.min("version")).first()[0] == "v05"
    assert readers.latest_run(versions, "version", ["algorithm"]).where("algorithm = 'm'").first()["x"] == 14
    assert readers.latest_run(versions.drop("algorithm")).first()["version"] == "v14"


def test_enabled_algorithms(spark):
    models = spark.createDataFrame([("a",), ("b",)], "model string")
    some = spark.createDataFrame([("a", True), ("b", False)], "algorithm string, enabled boolean")
    assert [r[0] for r in registry.enabled_only(models, some).collect()] == ["a"]
    assert registry.enabled_only(models, some.withColumn("enabled", F.lit(False))).count() == 2
    assert TrainingConfig(enabled={"xgboost": False}).enabled_algorithms() == fv.ALGORITHMS


# --- quality and configuration ----------------------------------------------------------------------------------
def test_quality_report_and_enforcement(spark):
    schema = "encounter_id long, snapshot_date date, age_midpoint int, admission_severity_score int, poor_glucose_control int, label int"
    good = [(i, date(2000, 1 + i % 12, 1), 50, 1, 0, int(i % 5 == 0)) for i in range(100)]
    report = quality.quality_report(spark.createDataFrame(good, schema), date(2000, 12, 31))
    assert quality.enforce(report).where("not passed").isEmpty()
    bad = good + [(1, date(2000, 2, 1), 200, None, 0, 1), (500, date(2001, 1, 1), 50, 1, 0, 0)]
    failed = {r["check"] for r in quality.quality_report(spark.createDataFrame(bad, schema), date(2000, 12, 31)).where("not passed").collect()}
    assert failed == {"duplicate_records", "age_out_of_range", "days_after_oot_end"}
    with pytest.raises(quality.QualityError, match="duplicate_records"):
        quality.enforce(quality.quality_report(spark.createDataFrame(bad, schema), date(2000, 12, 31)))


def test_required_columns(spark):
    with pytest.raises(quality.QualityError, match="label"):
        quality.require_columns(spark.range(1), ["id", "label"])


def test_configuration():
    windows = {"train": ("1999-01-01", "2005-12-31"), "test": ("2006-01-01", "2007-12-31"), "oot": ("2008-01-01", "2008-12-31")}
    document = {
        "temporal_splits": {k: {"start_date": a, "end_date": b} for k, (a, b) in windows.items()},
        "model_config": {"random_state": 7, "cv_folds": 3},
        "training_config": {"enabled_algorithms": {"xgboost": True, "random_forest": False}},
    }
    config = config_from_dict(document)
    assert config.splits == DEFAULT_SPLITS and config.training.random_state == 7
    assert config.training.enabled_algorithms() == ["xgboost"]
    with pytest.raises(ValueError, match="training_config"):
        config_from_dict({k: v for k, v in document.items() if k != "training_config"})
    with pytest.raises(ValueError, match="oot"):
        splits_from_dict({k: v for k, v in document["temporal_splits"].items() if k != "oot"})
    with pytest.raises(ValueError):
        Window(date(2001, 1, 1), date(2000, 1, 1))
