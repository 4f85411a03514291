"""Drift without stored pieces, exact p-values, one-pass category stability and alerts over all metrics."""

import itertools
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskmart.functions.stability import two_sample_p_value
from riskmart.operators import drift, governance, ranking


def brute_p_value(n1, n2, limit):
    """Share of all ways to merge two samples whose distributions differ by limit / (n1 n2) or more."""
    hits = total = 0
    for places in itertools.combinations(range(n1 + n2), n1):
        chosen, i, j, widest = set(places), 0, 0, 0
        for k in range(n1 + n2):
            i, j = (i + 1, j) if k in chosen else (i, j + 1)
            widest = max(widest, abs(i * n2 - j * n1))
        total += 1
        hits += widest >= limit
    return hits / total


@pytest.mark.parametrize("n1, n2", [(3, 3), (4, 5), (2, 7), (1, 6), (6, 4), (7, 7)])
def test_exact_p_value_equals_all_permutations(n1, n2):
    for limit in range(n1 * n2 + 1):
        assert two_sample_p_value(limit / (n1 * n2), n1, n2) == pytest.approx(brute_p_value(n1, n2, limit), abs=1e-12)


def test_exact_p_value_of_large_samples():
    assert two_sample_p_value(0.02, 10_000, 10_000) == pytest.approx(0.0366, abs=2e-4)  # near the asymptotic one
    assert two_sample_p_value(1.0, 5_000, 5_000) < 1e-300 or two_sample_p_value(1.0, 5_000, 5_000) == 0.0
    assert two_sample_p_value(0.5, 0, 10) == two_sample_p_value(0.0, 5, 5) == 1.0


def samples(spark, n1=60, n2=40):
    rng = np.random.default_rng(2)
    rows = [("train", float(x), None if i % 7 else 1.0, "ab"[i % 2]) for i, x in enumerate(rng.normal(size=n1))]
    rows += [("oot", float(x), 2.0, "abc"[i % 3]) for i, x in enumerate(rng.normal(0.6, size=n2))]
    rows += [("test", 1e9, 1e9, "z"), ("oot", float("nan"), None, None)]
    return spark.createDataFrame(rows, "split string, x double, y double, k string")


def test_method_follows_the_sample_sizes(spark):
    totals = drift.value_totals(samples(spark), "split", "train", "oot", ["x", "y"])
    found = {r.feature: r for r in drift.ks_statistic(totals).collect()}
    assert found["x"].method == found["y"].method == "exact"
    assert found["x"].p_value == pytest.approx(two_sample_p_value(found["x"].ks_stat, 60, 40))
    few = {r.feature: r for r in drift.ks_statistic(totals, exact_rows=50).collect()}
    assert few["x"].method == "asymptotic" and few["y"].method == "exact"
    assert few["x"].p_value == pytest.approx(found["x"].p_value, abs=0.05)


def test_no_job_while_a_plan_is_built_and_one_read(spark, tmp_path):
    path = f"{spark.conf.get('spark.checkpoint.dir')}/drift-{np.random.default_rng().integers(1 << 60)}"
    samples(spark).write.parquet(path)
    rows = spark.read.schema("split string, x double, y double, k string").parquet(path)
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    plans = [
        drift.drift_table(rows, ["x", "y"], exact_rows=0),
        drift.exact_percentiles(rows.where("split = 'train'"), ["x", "y"]),
        drift.sample_stability(rows, ["k"]),
        drift.characteristic_stability_by_period(rows, "split", ["k"]),
    ]
    assert len(tracker.getJobIdsForGroup(None)) == before
    for plan in plans:
        plan.collect()
        final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        read_by_stages = [part for part in final.split("\n") if "FileScan" in part]
        assert len(read_by_stages) == 1, final


def test_totals_fail_rather_than_mix_pieces(spark):
    frame = spark.createDataFrame([("g", i, 1) for i in range(50)], "g string, v int, n int")
    assert ranking.running_totals(frame, ["g"], "v", ["n"]).agg(F.max("n_to")).first()[0] == 50
    plan = ranking.running_totals(frame, ["g"], "v", ["n"])._jdf.queryExecution().optimizedPlan().toString()
    assert re.search("raise_error|RaiseError", plan)


def test_one_pass_stability_equals_two_tables(spark):
    rows = samples(spark)
    pair = drift.characteristic_stability(rows.where("split = 'train'"), rows.where("split = 'oot'"), ["k"]).first()
    assert drift.sample_stability(rows, ["k"]).first().csi == pytest.approx(pair.csi, abs=1e-12)


def test_every_rule_scans_every_observation(spark):
    models = spark.createDataFrame(
        [("a", 0.5, 0.6, 0.7, 0.8, 0.2, 0.5, 0.2, 900), ("b", None, 0.6, 0.7, 0.7, 0.01, 0.2, 0.2, 5000)],
        "model string, gini double, base_gini double, auc double, base_auc double, pred_shift double, pred_rate double, "
        "base_pred_rate double, row_count long",
    )
    features = spark.createDataFrame([("f", 0.3, 0.2, 7.0), ("g", 0.6, 0.1, 0.0)], "model string, psi double, ks_stat double, null_pct double")
    long = governance.observations(models, ["model"], ["gini", "auc", "pred_shift", "pred_rate", "row_count"]).unionByName(
        governance.observations(features, ["model"], ["psi", "ks_stat", "null_pct"])
    )
    found = {(r.model, r.rule): r.alert for r in governance.scan_rules(long, ["model"]).collect()}
    assert {rule for _, rule in found} == set(governance.ALERT_RULES) and len(governance.ALERT_RULES) == 10
    assert {k for k, alert in found.items() if alert} == {
        ("a", "min_gini"), ("a", "min_auc"), ("a", "max_pred_shift"), ("a", "max_pred_rate"), ("a", "min_records_per_month"),
        ("f", "max_psi"), ("f", "max_ks_stat"), ("f", "max_null_pct"), ("g", "max_psi"), ("g", "critical_psi"),
    }
    wide = {(r.model, r.rule): r.alert for r in governance.alerts(models, ["model"]).collect()}
    assert all(found[k] == v for k, v in wide.items())
    extra = governance.scan_rules(long, ["model"], governance.EXTRA_ALERT_RULES).collect()
    assert {r.rule for r in extra} == {"data_drift_psi", "missing_rate"}
