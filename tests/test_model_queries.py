from contextlib import suppress
from unittest.mock import MagicMock

import pytest

import __spark_entry__ as entry
from riskmart.operators import training
from riskmart.plans import catalog, queries_models

FITTED = ["m1_logistic_regression", "m2_random_forest", "m3_boosted_trees", "m4_second_boosted_variant", "m10_feature_importance",
          "m11_score_snapshot", "m13_stacking", "m15_saved_model", "t3_top_features"]


@pytest.fixture
def staged(monkeypatch):
    monkeypatch.setattr(catalog, "Tables", MagicMock())
    monkeypatch.setattr(queries_models, "_scaled", MagicMock())
    for name in ("feature_importance", "probability", "score", "save_model", "load_model", "top_features"):
        monkeypatch.setattr(training, name, MagicMock())
    return monkeypatch


@pytest.mark.parametrize("name", FITTED)
def test_models_have_the_size_of_the_reference(spark, staged, name):
    seen = []
    staged.setattr(training, "fit", lambda algorithm, *_, **params: seen.append((algorithm, params)) or MagicMock())

    def stack(algorithms, *_, folds=3, settings=None, **__):
        seen.extend((a, (settings or {}).get(a, {})) for a in algorithms)
        return MagicMock()

    staged.setattr(training, "stack", stack)
    with suppress(Exception):  # nothing is fitted, so what follows may fail
        entry.queries()[name](spark, "")
    assert seen
    for algorithm, params in seen:
        model = training.estimator(algorithm, 100, **params)
        if algorithm == "logistic_regression":
            assert model.getMaxIter() == 1000
        elif algorithm == "random_forest":
            assert model.getNumTrees() >= 50 and model.getMaxDepth() >= 5
        else:
            assert model.getMaxIter() >= 50 and model.getMaxDepth() >= 3


def test_search_covers_all_algorithms(spark, staged):
    seen = []

    def search(algorithm, train, features, config, space=None):
        seen.append((algorithm, config.search_draws, config.cv_folds, space))
        return MagicMock()

    staged.setattr(training, "random_search", search)
    with suppress(Exception):
        entry.queries()["m5_random_search"](spark, "")
    assert seen == [(a, 20, 5, None) for a in ("logistic_regression", "random_forest", "xgboost")]
