"""Registry commits, gates of the jobs, and marts that are loaded by one way only."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from riskmart.config import DOCUMENTED_GATES, Gates, TrainingConfig, config_from_dict
from riskmart.operators import quality, registry
from riskmart.plans import catalog, jobs
from riskmart.schemas import VERSION_INDEX
from riskmart.sources import readers, version_index, writers

SPACE = {"penalty": ["l2"], "C": [0.1], "max_iter": [3]}
CONFIG = catalog.CONFIG.with_(training=TrainingConfig(search_draws=1, cv_folds=2))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return catalog.Tables(spark, sf_dir)


@pytest.fixture(scope="module")
def mart(spark, tables):
    mart = tables.mart()
    writers.write_months(tables.labels, mart.labels)
    writers.write_months(tables.features, mart.features)
    return mart


def rows_of(spark, *versions, algorithm="a", gini=0.5):
    rows = [(v, f"m{v}", f"d{v}", f"p{v}", v, algorithm, *[gini] * 8) for v in versions]
    return spark.createDataFrame(rows, VERSION_INDEX)


def kept(spark, root):
    return sorted((r.algorithm, r.version) for r in version_index.versions(spark, root).collect())


def test_twelve_versions_leave_ten(spark, mart):
    run = jobs.preprocess(spark, mart, CONFIG, "run1")
    paths = {}
    for i in range(12):
        paths[f"{i:02d}"] = jobs.train(spark, mart, run, "logistic_regression", f"{i:02d}", CONFIG, SPACE)
    index = {r.version: r for r in version_index.versions(spark, mart.registry).collect()}
    assert sorted(index) == [f"{i:02d}" for i in range(2, 12)]
    for version, row in index.items():
        assert row.model_path == paths[version] and 0 <= row.oot_auc <= 1
        metadata = spark.read.json(row.metadata_path).first()
        assert metadata.version == version and '"C": 0.1' in metadata.best_params
        assert metadata.temporal_splits.oot.end_date == "2001-12-31" and metadata.data_info.feature_count == 14
    assert not readers.exists(spark, f"{mart.registry}/logistic_regression/v01")
    assert jobs.latest_model(spark, mart, "logistic_regression") == paths["11"]
    assert [r.version for r in jobs.performance(spark, mart).collect()] == ["11"]
    with pytest.raises(ValueError, match="no version of 'xgboost'"):
        jobs.latest_model(spark, mart, "xgboost")


def test_a_commit_that_dies_leaves_the_index_as_it_was(spark, tables, monkeypatch):
    root = tables.path("registry")
    assert kept(spark, root) == []
    version_index.commit(spark, root, rows_of(spark, "1", "2"))
    with monkeypatch.context() as broken:
        broken.setattr(version_index, "_rename", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError, match="killed"):
            version_index.commit(spark, root, rows_of(spark, "3"))
    writers.write_json(rows_of(spark, "4"), f"{root}/versions/.staging-left-over")  # of a writer that could not clean up
    assert kept(spark, root) == [("a", "1"), ("a", "2")]
    version_index.commit(spark, root, rows_of(spark, "3"))
    assert kept(spark, root) == [("a", "1"), ("a", "2"), ("a", "3")]


def test_two_writers_keep_both_rows(spark, tables, monkeypatch):
    root = tables.path("registry")
    version_index.commit(spark, root, rows_of(spark, "1"))
    stale, seen = version_index._snapshots(spark, root), []
    real = version_index._snapshots
    version_index.commit(spark, root, rows_of(spark, "2"))

    def first_stale(*args):
        seen.append(1)
        return stale if len(seen) == 1 else real(*args)

    monkeypatch.setattr(version_index, "_snapshots", first_stale)
    version_index.commit(spark, root, rows_of(spark, "3"))
    assert len(seen) == 2
    monkeypatch.undo()
    assert kept(spark, root) == [("a", "1"), ("a", "2"), ("a", "3")]


def test_a_version_is_replaced_and_old_ones_go_by_algorithm(spark, tables):
    root = tables.path("registry")
    version_index.commit(spark, root, rows_of(spark, *"12345").unionByName(rows_of(spark, "1", algorithm="b")), keep=3)
    version_index.commit(spark, root, rows_of(spark, "5", gini=0.9), keep=3)
    assert kept(spark, root) == [("a", "3"), ("a", "4"), ("a", "5"), ("b", "1")]
    assert {(r.algorithm, r.version, r.oot_gini) for r in version_index.latest(spark, root).collect()} == {("a", "5", 0.9), ("b", "1", 0.5)}
    assert len(version_index._snapshots(spark, root)) == 2


def test_jobs_stop_at_gates(spark, mart, tables):
    with pytest.raises(quality.QualityError, match="months_of_history"):
        jobs.preprocess(spark, mart, CONFIG.with_(gates=Gates(min_months=1000)), "stopped")
    with pytest.raises(quality.QualityError, match="train_rows"):
        jobs.preprocess(spark, mart, CONFIG.with_(gates=DOCUMENTED_GATES), "stopped")
    assert not readers.exists(spark, f"{mart.preprocessed}/run=stopped")

    other = tables.mart()
    one_class = jobs.stage(tables.model_rows.where("label = 0"))
    run = jobs.store_run(spark, one_class, other.preprocessed, "one")
    with pytest.raises(quality.QualityError, match="train_classes"):
        jobs.train(spark, other, run, "logistic_regression", "1", CONFIG, SPACE)

    stamped = tables.predictions.withColumn("prediction_timestamp", F.current_timestamp())
    writers.write_predictions(stamped.withColumn("snapshot_date", F.lit(date(2030, 1, 1))), other.predictions)
    writers.write_months(tables.labels, other.labels)
    with pytest.raises(quality.QualityError, match="monitored_months"):
        jobs.monitor(spark, other)


def test_only_the_checks_asked_for_are_computed(spark, tables):
    plan = quality.measure(tables.model_rows, [quality.positive_rate()])._jdf.queryExecution().optimizedPlan().toString()
    assert "age_midpoint" not in plan.split("\n")[0] and "count(" not in plan
    assert "duplicates" not in plan


def test_batch_and_stream_do_not_mix(spark, tables):
    from riskmart.streaming.incremental import load_new_files

    few = tables.raw.where(F.col("snapshot_date") < "1995-06-01")
    landing = tables.path("landing")
    writers.write_csv(few, f"{landing}/a")
    streamed, loaded = tables.mart(), tables.mart()
    load_new_files(spark, f"{landing}/*", streamed, tables.path("checkpoints"))
    with pytest.raises(ValueError, match="loaded by a stream"):
        jobs.load(spark, few, streamed)
    jobs.load(spark, few, loaded)
    with pytest.raises(ValueError, match="loaded by batch jobs"):
        load_new_files(spark, f"{landing}/*", loaded, tables.path("checkpoints"))
    load_new_files(spark, f"{landing}/*", streamed, tables.path("checkpoints"))  # a stream may go on


def test_comparison_file_and_enabled_models(spark):
    rows = [("m1", 5, 3, 2, *[0.5] * 14, "age", 0), ("m2", 5, 3, 2, *[0.75] * 14, "N/A", 1)]
    schema = ", ".join(["model string", *[f"{c} long" for c in registry.COMPARISON_COLUMNS[1:4]],
                        *[f"{c} double" for c in registry.METRIC_COLUMNS], "top_feature string", "position int"])
    found = registry.comparison_file(spark.createDataFrame(rows, schema)).collect()
    assert [r.Model for r in found] == ["m2", "m1"] and found[0].OOT_GINI == "0.7500" and len(found[0]) == 19


def test_all_configuration_keys_are_read():
    document = {
        "temporal_splits": {n: {"start_date": f"200{i}-01-01", "end_date": f"200{i}-12-31"} for i, n in enumerate(("train", "test", "oot"))},
        "model_config": {"random_state": 7, "cv_folds": 3},
        "training_config": {"n_iter": 4, "search_metric": "balanced", "class_weight": None, "enabled_algorithms": {"xgboost": True}},
        "thresholds": {"auc": 0.6, "psi_warning": 0.2},
        "governance_config": {"auto_retrain": True},
        "gates": {"min_months": 3, "positive_rate": [0.1, 0.2], "last_day": "2002-12-31"},
    }
    config = config_from_dict(document)
    assert (config.training.search_draws, config.training.search_metric, config.training.cv_folds) == (4, "balanced", 3)
    assert (config.thresholds.auc, config.thresholds.psi_warning, config.thresholds.psi_critical) == (0.6, 0.2, 0.25)
    assert config.auto_retrain and config.gates == Gates(3, positive_rate=(0.1, 0.2), last_day=date(2002, 12, 31))
