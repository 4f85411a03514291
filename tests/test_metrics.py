"""Ranking, metrics and drift against brute force on tied random data."""

import math
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskmart.functions import stability
from riskmart.operators import drift, metrics, monitoring, splitting
from riskmart.operators.ranking import running_totals


def brute_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    if not pos or not neg:
        return None
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for _, y in pairs)
    if not total:
        return 0.0
    out = seen = tp = 0
    for s in sorted({s for s, _ in pairs}, reverse=True):
        hits = [y for x, y in pairs if x == s]
        seen += len(hits)
        tp += sum(hits)
        out += sum(hits) / total * tp / seen
    return out


def scored(spark, groups):
    rows = [(g, float(s), int(y)) for g, pairs in groups.items() for s, y in pairs]
    return spark.createDataFrame(rows, "g string, s double, y int")


def close(a, b):
    return (a is None and b is None) or (a is not None and b is not None and math.isclose(a, b, abs_tol=1e-9))


def random_groups(seed):
    rng = random.Random(seed)
    return {
        # one group holds most rows; scores are tied
        "hot": [(rng.randint(0, 40) / 40, rng.random() < 0.3) for _ in range(600)],
        "fine": [(rng.random(), rng.random() < 0.5) for _ in range(100)],
        "one class": [(rng.random(), 0) for _ in range(20)],
        "all tied": [(0.5, i % 2) for i in range(10)],
    }


@pytest.mark.parametrize("seed", [1, 2])
def test_auc_and_average_precision(spark, seed):
    groups = random_groups(seed)
    rows = scored(spark, groups)
    auc = {r["g"]: r["auc"] for r in metrics.roc_auc(rows, ["g"], "s", "y").collect()}
    full = {r["g"]: r for r in metrics.evaluate(rows, ["g"], "s", "y").collect()}
    for g, pairs in groups.items():
        assert close(auc[g], brute_auc(pairs)), g
        assert close(full[g]["auc_roc"], brute_auc(pairs)), g
        assert close(full[g]["pr_auc"], brute_ap(pairs)), g
        tp = sum(1 for s, y in pairs if s > 0.5 and y)
        fp = sum(1 for s, y in pairs if s > 0.5 and not y)
        assert close(full[g]["precision"], tp / (tp + fp) if tp + fp else 0.0)
        assert full[g]["rows"] == len(pairs)


def test_auc_symmetries(spark):
    rows = scored(spark, random_groups(5))
    def auc(score):
        frame = rows.withColumn("t", score)
        return {r["g"]: r["auc"] for r in metrics.roc_auc(frame, ["g"], "t", "y").collect()}

    plain = auc(F.col("s"))
    assert all(close(v, plain[g]) for g, v in auc(F.exp(F.col("s") * 3)).items())
    flipped = auc(1 - F.col("s"))
    assert all(v is None or close(v, 1 - plain[g]) for g, v in flipped.items())


def test_missing_scores_keep_their_row(spark):
    rows = spark.createDataFrame(
        [("m", "2000-01", s, y) for s, y in [(0.2, 0), (0.8, 1), (None, 1), (float("nan"), 0), (1.5, 1), (-0.5, 0)]],
        "model_algorithm string, snapshot_month string, model_predictions double, label int",
    )
    report = monitoring.monitor(rows).first()
    assert report["row_count"] == 6 and report["auc"] == 1.0 and report["psi"] == 0.0


def test_null_group_is_kept(spark):
    rows = spark.createDataFrame([(None, 0.1, 0), (None, 0.9, 1), ("a", 0.5, 1)], "g string, s double, y int")
    assert {r["g"]: r["rows"] for r in metrics.evaluate(rows, ["g"], "s", "y").collect()} == {None: 2, "a": 1}


def numpy_psi(e, a):
    edges = np.linspace(0, 1, 11)
    e = np.histogram(e, bins=edges)[0] / len(e)
    a = np.histogram(a, bins=edges)[0] / len(a)
    e, a = np.where(e == 0, 1e-6, e), np.where(a == 0, 1e-6, a)
    return float(np.sum((e - a) * np.log(e / a)))


EDGY = [0.0, 0.1, 0.2, 0.3, 0.30000000000000004, 0.6, 0.7, 0.9999, 1.0, -0.2, 1.2]


def test_bins_follow_numpy(spark):
    rows = spark.createDataFrame([(v,) for v in EDGY], "v double")
    for bins in (10, 20):
        got = [r[0] for r in rows.select(stability.score_bin(F.col("v"), bins)).collect()]
        for value, found in zip(EDGY, got, strict=True):
            counts = np.histogram([value], bins=np.linspace(0, 1, bins + 1))[0]
            assert found == (int(counts.argmax()) if counts.sum() else None), (value, bins)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.sampled_from(EDGY), min_size=1, max_size=30), st.lists(st.floats(0, 1), min_size=1, max_size=30))
def test_psi_follows_numpy(spark, first, second):
    rows = spark.createDataFrame(
        [("m", "2000-01", s) for s in first] + [("m", "2000-02", s) for s in second],
        "model string, month string, s double",
    )
    found = {r["month"]: r["psi"] for r in drift.population_stability(rows, ["model"], "month", "s").collect()}
    assert found["2000-01"] == 0.0
    assert close(found["2000-02"], numpy_psi(first, second)) and found["2000-02"] >= 0


def python_csi(e, a):
    def shares(values):
        kept = [v for v in values if v is not None]
        return {c: kept.count(c) / len(kept) for c in set(kept)}

    e, a = shares(e), shares(a)
    return sum((e.get(c, 1e-6) - a.get(c, 1e-6)) * math.log(e.get(c, 1e-6) / a.get(c, 1e-6)) for c in e.keys() | a.keys())


def test_csi(spark):
    months = {"1": list("aaabbc"), "2": list("aabd") + [None], "3": list("ccc")}
    rows = spark.createDataFrame([(m, v) for m, values in months.items() for v in values], "month string, f string")
    found = {r["month"]: r["csi"] for r in drift.characteristic_stability_by_period(rows, "month", ["f"]).collect()}
    for m, values in months.items():
        assert math.isclose(found[m], python_csi(months["1"], values), abs_tol=1e-9)
        pair = drift.characteristic_stability(rows.where("month = '1'"), rows.where(F.col("month") == m), ["f"]).first()
        assert math.isclose(pair["csi"], python_csi(months["1"], values), abs_tol=1e-9)


def numpy_quantile_psi(e, a):
    edges = np.percentile(e, np.linspace(0, 100, 11))
    pe, pa = np.histogram(e, bins=edges)[0] / len(e), np.histogram(a, bins=edges)[0] / len(a)
    pe, pa = np.where(pe == 0, 1e-4, pe), np.where(pa == 0, 1e-4, pa)
    return float(np.sum((pa - pe) * np.log(pa / pe)))


def brute_ks(e, a):
    return max(abs(np.mean(np.array(e) <= v) - np.mean(np.array(a) <= v)) for v in set(e) | set(a))


SAMPLES = {
    "ties": ([1, 1, 1, 2, 3, 4, 5, 6, 7, 8], [0, 1, 2, 2, 2, 8, 9]),
    "constant": ([5.0] * 12, [5.0] * 7 + [6.0]),
    "random": (list(np.random.default_rng(3).normal(size=400)), list(np.random.default_rng(4).normal(0.4, 1.5, size=300))),
    "integers": (list(np.random.default_rng(5).integers(0, 6, 200)), list(np.random.default_rng(6).integers(1, 8, 150))),
}


def test_drift_table(spark):
    names = list(SAMPLES)
    rows = []
    for i, name in enumerate(names):
        for side, values in zip(("train", "oot"), SAMPLES[name], strict=True):
            for v in values:
                cells = [None] * len(names)
                cells[i] = float(v)
                rows.append((side, *cells))
    rows += [("train", *[float("nan")] * len(names)), ("test", *[99.0] * len(names))]
    frame = spark.createDataFrame(rows, ", ".join(["split string", *[f"`{n}` double" for n in names]]))
    found = {r["feature"]: r for r in drift.drift_table(frame, names).collect()}
    assert set(found) == set(names)
    for name, (e, a) in SAMPLES.items():
        assert math.isclose(found[name]["psi"], numpy_quantile_psi(e, a), abs_tol=1e-9), name
        assert math.isclose(found[name]["ks_stat"], brute_ks(e, a), abs_tol=1e-9), name
    assert found["random"]["drift_detected"] and found["random"]["p_value"] < 0.05
    baseline = {r["feature"]: r for r in drift.baseline_statistics(frame.where("split = 'train'"), names).collect()}
    for name, (e, _) in SAMPLES.items():
        got = baseline[name]
        want = [np.mean(e), np.std(e, ddof=1), min(e), max(e), *np.percentile(e, [25, 50, 75])]
        assert np.allclose([got[c] for c in ("mean", "std", "min", "max", "q25", "q50", "q75")], [float(w) for w in want])


def test_running_totals_match_a_plain_window(spark):
    rng = random.Random(9)
    rows = [(g, v, rng.randint(1, 4)) for g in ("a", "b", None) for v in range(200 if g == "a" else 5)]
    frame = spark.createDataFrame(rows, "g string, v int, n long")
    for descending in (False, True):
        got = {(r["g"], r["v"]): (r["n_to"], r["n_all"]) for r in running_totals(frame, ["g"], "v", ["n"], descending).collect()}
        for g in ("a", "b", None):
            mine = sorted([(v, n) for h, v, n in rows if h == g], reverse=descending)
            total = 0
            for v, n in mine:
                total += n
                assert got[(g, v)] == (total, sum(n for _, n in mine))


@pytest.mark.parametrize("used", [["pos", "neg_to"], ["neg_to"], ["pos", "neg_all"], ["neg", "pos_all"], ["neg", "pos_to", "neg_all"]])
def test_running_totals_of_few_measures_read_one_shuffle(spark, used):
    value = (F.xxhash64("id") % 100_000).alias("v")
    frame = spark.range(0, 20_000, 1, 8).select((F.col("id") % 3).alias("g"), value).distinct()
    counts = frame.select("g", "v", F.lit(7).alias("rows"), (F.col("v") % 2 == 0).cast("long").alias("pos"), F.lit(1).cast("long").alias("neg"))
    plan = running_totals(counts, ["g"], "v", ["pos", "neg"]).select("g", "v", *used)
    got = plan.toPandas().set_index(["g", "v"]).sort_index()
    final = plan._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final, final
    want = counts.toPandas().set_index(["g", "v"]).sort_index()
    by_group = want.groupby(level="g")
    for m in ("pos", "neg"):
        want[f"{m}_to"], want[f"{m}_all"] = by_group[m].cumsum(), by_group[m].transform("sum")
    assert (got[used].to_numpy() == want[used].to_numpy()).all()


def test_folds_are_stratified_and_do_not_depend_on_partitioning(spark):
    rows = spark.range(0, 1000).select(F.col("id"), (F.col("id") % 10 == 0).cast("int").alias("label"))
    one = splitting.stratified_folds(rows.coalesce(1), "label", ["id"], folds=5, seed=7)
    many = splitting.stratified_folds(rows.repartition(13), "label", ["id"], folds=5, seed=7)
    assert one.exceptAll(many).isEmpty() and many.count() == 1000
    sizes = {(r["label"], r["fold"]): r["count"] for r in one.groupBy("label", "fold").count().collect()}
    assert all(sizes[(0, f)] == 180 and sizes[(1, f)] == 20 for f in range(5))
    few = splitting.number_in_strata(rows, ["label"], ["id"], 7, pieces=2).select("id", "number")
    lots = splitting.number_in_strata(rows, ["label"], ["id"], 7, pieces=64).select("id", "number")
    assert few.exceptAll(lots).isEmpty()
    parts = splitting.stratified_split(rows, "label", ["id"], 0.2).groupBy("label", "part").count().collect()
    assert {(r["label"], r["part"]): r["count"] for r in parts} == {(0, "test"): 180, (0, "train"): 720, (1, "test"): 20, (1, "train"): 80}


def test_random_split_needs_no_shuffle(spark):
    rows = splitting.random_split(spark.range(0, 20000), ["id"], 0.8)
    assert "Exchange" not in rows._jdf.queryExecution().toString()
    share = rows.where("part = 'train'").count() / 20000
    assert 0.78 < share < 0.82
