"""Configuration: plain dataclasses; only dates and thresholds reach the plans."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace
from datetime import date

from . import fixed_values as fv


@dataclass(frozen=True)
class Window:
    """A closed interval of snapshot dates."""

    start: date
    end: date

    def __post_init__(self):
        if self.start > self.end:
            raise ValueError(f"window starts after its end: {self.start} > {self.end}")


@dataclass(frozen=True)
class TemporalSplits:
    train: Window
    test: Window
    oot: Window

    def named(self) -> dict[str, Window]:
        return {"train": self.train, "test": self.test, "oot": self.oot}


@dataclass(frozen=True)
class Thresholds:
    auc: float = fv.AUC_THRESHOLD
    psi_warning: float = fv.PSI_WARNING
    psi_critical: float = fv.PSI_CRITICAL


@dataclass(frozen=True)
class TrainingConfig:
    random_state: int = 42
    cv_folds: int = 5
    search_draws: int = 20
    search_metric: str = "auc"  # or "balanced": AUC of hard labels
    class_weight: str | None = "balanced"
    enabled: dict[str, bool] = field(default_factory=lambda: {a: True for a in fv.ALGORITHMS})

    def enabled_algorithms(self) -> list[str]:
        """Algorithms switched on, in order; all of them when none is."""
        return [a for a, on in self.enabled.items() if on] or list(fv.ALGORITHMS)


@dataclass(frozen=True)
class Gates:
    """What a run must hold. By default ten months of history, rows in every split and two classes to learn from; the
    other checks are off at None."""

    min_months: int = 10
    min_train_rows: int = 0
    min_test_rows: int = 0
    max_null_pct: float | None = None
    positive_rate: tuple[float, float] | None = None
    ages: tuple[int, int] | None = None
    last_day: date | None = None
    unique_keys: bool = False


#: The stricter limits of the documentation.
DOCUMENTED_GATES = Gates(10, 1000, 500, 5.0, (0.05, 0.30), (0, 100), None, True)


@dataclass(frozen=True)
class RiskConfig:
    splits: TemporalSplits
    training: TrainingConfig = TrainingConfig()
    thresholds: Thresholds = Thresholds()
    prediction_threshold: float = 0.5
    auto_retrain: bool = False
    gates: Gates = Gates()

    def with_(self, **changes) -> "RiskConfig":
        return replace(self, **changes)


# The published windows: seven years to fit, two to test, one held out.
DEFAULT_SPLITS = TemporalSplits(
    train=Window(date(1999, 1, 1), date(2005, 12, 31)),
    test=Window(date(2006, 1, 1), date(2007, 12, 31)),
    oot=Window(date(2008, 1, 1), date(2008, 12, 31)),
)


def splits_from_dict(document: dict) -> TemporalSplits:
    """Build the three windows from a nested dictionary of ISO dates; raises on gaps (Q9)."""
    windows = {}
    for name in ("train", "test", "oot"):
        section = document.get(name) or {}
        missing = [k for k in ("start_date", "end_date") if not section.get(k)]
        if missing:
            raise ValueError(f"window {name!r} lacks {', '.join(missing)}")
        windows[name] = Window(
            date.fromisoformat(section["start_date"]), date.fromisoformat(section["end_date"])
        )
    return TemporalSplits(**windows)


def _gates(given: dict) -> Gates:
    """Lists become ranges and ISO texts days; an unknown name raises."""
    values = {k: tuple(v) if isinstance(v, list) else v for k, v in given.items()}
    if isinstance(values.get("last_day"), str):
        values["last_day"] = date.fromisoformat(values["last_day"])
    return Gates(**values)


def config_from_dict(document: dict) -> RiskConfig:
    """Validate the sections of a configuration document and build the config (Q9)."""
    missing = [k for k in ("temporal_splits", "model_config", "training_config") if k not in document]
    if missing:
        raise ValueError(f"configuration lacks the sections {', '.join(missing)}")
    model, training = document["model_config"], document["training_config"]
    given = {
        "random_state": model.get("random_state"),
        "cv_folds": model.get("cv_folds"),
        "search_draws": training.get("n_iter"),
        "search_metric": training.get("search_metric"),
        "class_weight": training.get("class_weight"),
        "enabled": training.get("enabled_algorithms"),
    }
    limits = {f.name: (document.get("thresholds") or {}).get(f.name) for f in fields(Thresholds)}
    present = lambda values: {k: v for k, v in values.items() if v is not None}
    return RiskConfig(
        splits=splits_from_dict(document["temporal_splits"]),
        training=TrainingConfig(**present(given)),
        thresholds=Thresholds(**present(limits)),
        prediction_threshold=document.get("inference_config", {}).get("prediction_threshold", 0.5),
        auto_retrain=bool((document.get("governance_config") or {}).get("auto_retrain", False)),
        gates=_gates(present(document.get("gates") or {})),
    )
