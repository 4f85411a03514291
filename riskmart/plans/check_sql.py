"""ANSI SQL building blocks of the check queries, run by DuckDB on the same tables.

The blocks restate each rule in SQL on its own; only the encounter view, which is test input,
is shared with the engine.
"""

from __future__ import annotations

from ..sources import encounters as en

DRUG_CASE = "CASE {c} WHEN 'No' THEN 0 WHEN 'Steady' THEN 1 WHEN 'Down' THEN -1 WHEN 'Up' THEN 2 END"

INTEGERS = [
    "admission_type_id", "discharge_disposition_id", "admission_source_id", "time_in_hospital",
    "num_lab_procedures", "num_procedures", "num_medications", "number_outpatient",
    "number_emergency", "number_inpatient", "number_diagnoses",
]


def quote(name: str) -> str:
    return f'"{name}"' if "-" in name else name


def _silver_column(name: str) -> str:
    if name in ("encounter_id", "patient_nbr"):
        return f"TRY_CAST({name} AS BIGINT) AS {name}"
    if name in INTEGERS:
        return f"TRY_CAST({name} AS INTEGER) AS {name}"
    if name == "snapshot_date":
        return "CAST(snapshot_date AS DATE) AS snapshot_date"
    if name in ("max_glu_serum", "A1Cresult"):
        return f"CASE WHEN {name} IS NULL OR {name} IN ('', '?') THEN 'None' ELSE {name} END AS {name}"
    return quote(name)


_RAW = (
    "SELECT "
    + ", ".join(f"{text} AS {quote(name)}" for name, text in en.RAW_EXPRESSIONS.items())
    + " FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS lines, sum(l_linenumber) AS lines_sum"
    " FROM lineitem GROUP BY l_orderkey) l ON l_orderkey = o_orderkey"
    " LEFT JOIN customer ON c_custkey = o_custkey"
)

# Every rule of the feature store, written out.
FEATURES = {
    "race_cleaned": "CASE WHEN race IN ('?', 'Unknown') THEN 'Unknown' ELSE race END",
    "race_AfricanAmerican": "CASE WHEN race = 'AfricanAmerican' THEN 1 ELSE 0 END",
    "race_Caucasian": "CASE WHEN race = 'Caucasian' THEN 1 ELSE 0 END",
    "race_Asian": "CASE WHEN race IN ('Asian', 'Unknown', '?') THEN 1 ELSE 0 END",
    "race_Hispanic": "CASE WHEN race = 'Hispanic' THEN 1 ELSE 0 END",
    "is_female": "CASE WHEN gender = 'Female' THEN 1 ELSE 0 END",
    "age_midpoint": "CASE age WHEN '[0-10)' THEN 5 WHEN '[10-20)' THEN 15 WHEN '[20-30)' THEN 25 "
    "WHEN '[30-40)' THEN 35 WHEN '[40-50)' THEN 45 WHEN '[50-60)' THEN 55 WHEN '[60-70)' THEN 65 "
    "WHEN '[70-80)' THEN 75 WHEN '[80-90)' THEN 85 WHEN '[90-100)' THEN 95 END",
    "age_group_index": "CASE age WHEN '[0-10)' THEN 1 WHEN '[10-20)' THEN 2 WHEN '[20-30)' THEN 3 "
    "WHEN '[30-40)' THEN 4 WHEN '[40-50)' THEN 5 WHEN '[50-60)' THEN 6 WHEN '[60-70)' THEN 7 "
    "WHEN '[70-80)' THEN 8 WHEN '[80-90)' THEN 9 WHEN '[90-100)' THEN 10 END",
    "age_group_label": "CASE WHEN age IN ('[0-10)', '[10-20)', '[20-30)') THEN 'Young' "
    "WHEN age IN ('[30-40)', '[40-50)', '[50-60)', '[60-70)') THEN 'Adult' "
    "WHEN age IN ('[70-80)', '[80-90)', '[90-100)') THEN 'Senior' ELSE 'Unknown' END",
    "admission_type_desc": "CASE admission_type_id WHEN 1 THEN 'Emergency' WHEN 2 THEN 'Urgent' "
    "WHEN 3 THEN 'Elective' WHEN 4 THEN 'Newborn' WHEN 5 THEN 'Not Available' WHEN 6 THEN 'Unknown' "
    "WHEN 7 THEN 'Trauma Center' WHEN 8 THEN 'Not Mapped' END",
    "admission_severity_score": "CASE WHEN admission_type_id IN (1, 7) THEN 3 WHEN admission_type_id = 2 "
    "THEN 2 WHEN admission_type_id IN (3, 4) THEN 1 WHEN admission_type_id IN (5, 6, 8) THEN 0 END",
    "discharge_severity_score": "CASE WHEN discharge_disposition_id IN (1, 6, 8) THEN 1 "
    "WHEN discharge_disposition_id IN (2, 3, 4, 5, 15, 16, 17, 22, 23, 24, 27, 28, 29, 30, 10, 12) THEN 2 "
    "WHEN discharge_disposition_id IN (13, 14, 9) THEN 3 WHEN discharge_disposition_id = 7 THEN 4 "
    "WHEN discharge_disposition_id IN (11, 19, 20, 21) THEN 5 "
    "WHEN discharge_disposition_id IN (18, 25, 26) THEN 0 END",
    "admission_source_risk_score": "CASE WHEN admission_source_id IN (1, 2, 3, 11, 12, 13, 14, 23, 24) THEN 1 "
    "WHEN admission_source_id IN (7, 8) THEN 2 WHEN admission_source_id IN (4, 5, 6, 10, 18, 22, 25, 26) THEN 3 "
    "WHEN admission_source_id = 19 THEN 4 WHEN admission_source_id IN (9, 15, 17, 20, 21) THEN 0 END",
    "medication_intensity": "CASE WHEN num_medications > 0 "
    "THEN CAST(CAST(time_in_hospital AS DOUBLE) / num_medications AS FLOAT) END",
    "diagnosis_density": "CASE WHEN number_diagnoses > 0 "
    "THEN CAST(CAST(num_lab_procedures + num_procedures AS DOUBLE) / number_diagnoses AS FLOAT) END",
    "max_glu_serum_ord": "CASE max_glu_serum WHEN 'None' THEN 0 WHEN 'Norm' THEN 1 WHEN '>200' THEN 2 "
    "WHEN '>300' THEN 3 END",
    "A1Cresult_ord": "CASE A1Cresult WHEN 'None' THEN 0 WHEN 'Norm' THEN 1 WHEN '>7' THEN 2 WHEN '>8' THEN 3 END",
    **{f"{d}_ord": DRUG_CASE.format(c=quote(d)) for d in en.DRUGS},
    "diabetesMed": "CASE WHEN diabetesMed = 'Yes' THEN 1 ELSE 0 END",
    "total_visits": "CASE WHEN number_diagnoses > 0 "
    "THEN CAST(number_outpatient + number_emergency + number_inpatient AS INTEGER) END",
    "poor_glucose_control": "CASE WHEN max_glu_serum IN ('>200', '>300') OR A1Cresult IN ('>7', '>8', '>9') "
    "THEN 1 ELSE 0 END",
}
FEATURES["severity_x_visits"] = f"({FEATURES['discharge_severity_score']}) * ({FEATURES['total_visits']})"
FEATURES["medication_density"] = (
    f"CAST({FEATURES['medication_intensity']} AS DOUBLE) / "
    f"CAST(CAST({FEATURES['diagnosis_density']} AS FLOAT) + CAST(1 AS FLOAT) AS DOUBLE)"
)

STORED = [
    "race_AfricanAmerican", "race_Caucasian", "race_Asian", "race_Hispanic", "is_female", "age_midpoint",
    "admission_severity_score", "admission_source_risk_score", "poor_glucose_control", "metformin_ord",
    "insulin_ord", "diabetesMed", "severity_x_visits", "medication_density",
]
LOGGED = ["age_midpoint", "severity_x_visits", "medication_density"]
SCALED = ["admission_severity_score", "admission_source_risk_score", "metformin_ord", "insulin_ord"]

_PREDICTIONS = " UNION ALL ".join(
    f"SELECT o_orderkey AS encounter_id, {en.SNAPSHOT_EXPRESSION} AS snapshot_date, "
    f"'{a}' AS model_algorithm, {en.score_expression(a)} AS model_predictions FROM orders"
    for a in en.SCORE_SHAPES
)
SPLIT = (
    "CASE WHEN snapshot_date BETWEEN DATE '1995-01-01' AND DATE '1998-12-31' THEN 'train' "
    "WHEN snapshot_date BETWEEN DATE '1999-01-01' AND DATE '2000-12-31' THEN 'test' "
    "WHEN snapshot_date BETWEEN DATE '2001-01-01' AND DATE '2001-12-31' THEN 'oot' END"
)


def icd9(column: str) -> str:
    number = (
        f"CASE WHEN regexp_matches(trim({column}), '^[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?$') "
        f"THEN TRY_CAST(trim({column}) AS DOUBLE) END"
    )
    ranges = [
        ("circulatory", 390, 460), ("respiratory", 460, 520), ("diabetes", 250, 251), ("digestive", 520, 580),
        ("injury", 800, 1000), ("neoplasms", 140, 240), ("musculoskeletal", 710, 740), ("genitourinary", 580, 630),
    ]
    arms = " ".join(f"WHEN {number} >= {lo} AND {number} < {hi} THEN '{name}'" for name, lo, hi in ranges)
    return (
        f"CASE WHEN {column} IS NULL OR {column} = '?' THEN 'unknown' {arms} "
        f"WHEN ({number}) IS NOT NULL THEN 'other' WHEN trim({column}) LIKE 'V%' THEN 'supplementary_v' "
        f"WHEN trim({column}) LIKE 'E%' THEN 'supplementary_e' ELSE 'other' END"
    )


# name -> (needs, text)
_BLOCKS: dict[str, tuple[tuple[str, ...], str]] = {
    "raw": ((), _RAW),
    "silver": (("raw",), f"SELECT {', '.join(_silver_column(c) for c in en.RAW_EXPRESSIONS)} FROM raw"),
    "labels": (
        (),
        f"SELECT o_orderkey AS encounter_id, {en.LABEL_EXPRESSION} AS label, "
        f"{en.SNAPSHOT_EXPRESSION} AS snapshot_date FROM orders",
    ),
    "features": (
        ("silver",),
        "SELECT encounter_id, "
        + ", ".join(f"{FEATURES[c]} AS {c}" for c in STORED)
        + ", diag_1, diag_2, diag_3, snapshot_date FROM silver",
    ),
    "model_rows": (
        ("labels", "features"),
        f"SELECT f.*, label, split FROM features f JOIN (SELECT *, {SPLIT} AS split FROM labels) l "
        "USING (encounter_id, snapshot_date) WHERE split IS NOT NULL",
    ),
    "preds": ((), _PREDICTIONS),
    "scored": (
        ("preds", "labels"),
        "SELECT p.*, label, strftime(snapshot_date, '%Y-%m') AS snapshot_month FROM preds p "
        "JOIN labels USING (encounter_id, snapshot_date)",
    ),
    "split_scores": (("scored",), f"SELECT *, {SPLIT} AS split FROM scored"),
    "wide_scores": (
        (),
        f"SELECT *, {SPLIT} AS split FROM (SELECT o_orderkey AS encounter_id, {en.SNAPSHOT_EXPRESSION} AS snapshot_date, "
        + ", ".join(f"{en.score_expression(a)} AS p_{a}" for a in en.SCORE_SHAPES)
        + " FROM orders)",
    ),
    "diagnoses": (
        ("silver",),
        "SELECT encounter_id, diag_1, diag_2, diag_3, "
        + ", ".join(f"{icd9(f'diag_{i}')} AS diag_{i}_category" for i in (1, 2, 3))
        + " FROM silver",
    ),
    "volume": (
        (),
        "SELECT 'volume' AS model_algorithm, strftime(l_shipdate, '%Y-%m') AS snapshot_month, "
        "l_quantity / CAST(50 AS DOUBLE) AS model_predictions, "
        "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label FROM lineitem",
    ),
}


def with_blocks(body: str, *blocks: str, extra: dict[str, str] | None = None) -> str:
    """``WITH`` the named blocks, what they need, and ``extra`` ones, then ``body``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in _BLOCKS[name][0]:
            add(need)
        if name not in ordered:
            ordered.append(name)

    for block in blocks:
        add(block)
    parts = [f"{name} AS ({_BLOCKS[name][1]})" for name in ordered]
    parts += [f"{name} AS ({text})" for name, text in (extra or {}).items()]
    return f"WITH RECURSIVE {', '.join(parts)} {body}" if parts else body


def bin_case(score: str, bins: int = 10) -> str:
    arms = " ".join(
        f"WHEN {score} < {i} * (CAST(1 AS DOUBLE) / {bins}) THEN {i - 1}" for i in range(1, bins)
    )
    return f"CASE WHEN {score} < 0 OR {score} > 1 THEN NULL {arms} ELSE {bins - 1} END"


def auc_sql(source: str, keys: str, score: str = "model_predictions", label: str = "label") -> str:
    """SELECT keys, pos, neg, auc."""
    return (
        f"SELECT {keys}, CAST(sum(p) AS BIGINT) AS pos, CAST(sum(n) AS BIGINT) AS neg, "
        "CASE WHEN sum(p) > 0 AND sum(n) > 0 THEN sum(CAST(p AS DOUBLE) * (below + n / CAST(2 AS DOUBLE))) "
        "/ (CAST(sum(p) AS DOUBLE) * CAST(sum(n) AS DOUBLE)) END AS auc FROM ("
        f"SELECT *, coalesce(sum(n) OVER (PARTITION BY {keys} ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING "
        "AND 1 PRECEDING), 0) AS below FROM ("
        f"SELECT {keys}, {score} AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {source} "
        f"GROUP BY {keys}, {score}) d) c GROUP BY {keys}"
    )


def average_precision_sql(source: str, keys: str, score: str = "model_predictions", label: str = "label") -> str:
    """SELECT keys, pr_auc."""
    return (
        f"SELECT {keys}, coalesce(sum(CAST(p AS DOUBLE) / nullif(total, 0) * (tp / CAST(tp + fp AS DOUBLE))), 0) AS pr_auc FROM ("
        f"SELECT *, sum(p) OVER (PARTITION BY {keys}) AS total, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM ("
        f"SELECT {keys}, {score} AS s, sum({label}) AS p, sum(1 - {label}) AS n FROM {source} "
        f"GROUP BY {keys}, {score}) d WINDOW w AS (PARTITION BY {keys} ORDER BY s DESC "
        f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) c GROUP BY {keys}"
    )


def confusion_sql(source: str, keys: str, score: str = "model_predictions", label: str = "label") -> str:
    """SELECT keys, tp, fp, tn, fn."""

    def count(condition: str, name: str) -> str:
        return f"count(*) FILTER (WHERE {condition}) AS {name}"

    hit = f"{score} > CAST(0.5 AS DOUBLE)"
    return (
        f"SELECT {keys}, {count(f'{hit} AND {label} = 1', 'tp')}, {count(f'{hit} AND {label} = 0', 'fp')}, "
        f"{count(f'NOT ({hit}) AND {label} = 0', 'tn')}, {count(f'NOT ({hit}) AND {label} = 1', 'fn')} "
        f"FROM {source} GROUP BY {keys}"
    )


def ratio(numerator: str, denominator: str) -> str:
    return f"CASE WHEN ({denominator}) = 0 THEN CAST(0 AS DOUBLE) ELSE CAST({numerator} AS DOUBLE) / ({denominator}) END"


RATES = {
    "accuracy": ratio("tp + tn", "tp + fp + tn + fn"),
    "precision": ratio("tp", "tp + fp"),
    "recall": ratio("tp", "tp + fn"),
    "f1": ratio("2 * tp", "2 * tp + fp + fn"),
}


def evaluation_blocks(source: str, keys: str) -> dict[str, str]:
    """Blocks ending in ``evaluated``: keys and the seven metrics."""
    rates = ", ".join(f"{text} AS {name}" for name, text in RATES.items())
    return {
        "aucs": auc_sql(source, keys),
        "aps": average_precision_sql(source, keys),
        "conf": confusion_sql(source, keys),
        "evaluated": f"SELECT {keys}, pos + neg AS rows, auc AS auc_roc, 2 * auc - 1 AS gini, pr_auc, {rates}, "
        "(CAST(tp AS DOUBLE) / nullif(tp + fn, 0) + CAST(tn AS DOUBLE) / nullif(tn + fp, 0)) / 2 AS balanced "
        f"FROM aucs JOIN aps USING ({keys}) JOIN conf USING ({keys})",
    }


def share_sql(count: str, total: str, floor: str) -> str:
    return f"CASE WHEN {count} = 0 THEN CAST({floor} AS DOUBLE) ELSE CAST({count} AS DOUBLE) / {total} END"


def term(e: str, a: str) -> str:
    return f"(({e}) - ({a})) * ln(({e}) / ({a}))"


def psi_blocks(source: str, model: str = "model_algorithm", month: str = "snapshot_month") -> dict[str, str]:
    """Blocks ending in ``psis``: model, month, row_count, psi against the first month."""
    e, a = share_sql("f.n", "f.total", "1e-6"), share_sql("c.n", "c.total", "1e-6")
    return {
        "months_seen": f"SELECT {model}, {month}, count(*) AS total FROM {source} GROUP BY {model}, {month}",
        "binned": f"SELECT {model}, {month}, {bin_case('model_predictions')} AS bin, count(*) AS n "
        f"FROM {source} GROUP BY {model}, {month}, bin",
        "cells": f"SELECT m.{model}, m.{month}, m.total, r.bin, coalesce(b.n, 0) AS n FROM months_seen m "
        "CROSS JOIN (SELECT unnest(range(10)) AS bin) r LEFT JOIN binned b "
        f"ON b.{model} = m.{model} AND b.{month} = m.{month} AND b.bin = r.bin",
        "psis": f"SELECT c.{model}, c.{month}, c.total AS row_count, sum({term(e, a)}) AS psi FROM cells c "
        f"JOIN cells f ON f.{model} = c.{model} AND f.bin = c.bin "
        f"AND f.{month} = (SELECT min({month}) FROM months_seen s WHERE s.{model} = c.{model}) "
        f"GROUP BY c.{model}, c.{month}, c.total",
    }


def monitoring_blocks(source: str) -> dict[str, str]:
    """Blocks ending in ``monitored``: model, month, row_count, auc, gini, psi."""
    return {
        "monthly_auc": auc_sql(source, "model_algorithm, snapshot_month"),
        **psi_blocks(source),
        "monitored": "SELECT model_algorithm, snapshot_month, row_count, auc, 2 * auc - 1 AS gini, psi "
        "FROM psis JOIN monthly_auc USING (model_algorithm, snapshot_month)",
    }


DECISION = (
    "CASE WHEN auc < 0.7 OR psi > 0.25 THEN 'Retrain' WHEN psi > 0.1 THEN 'Schedule Retrain' ELSE 'No Action' END"
)
STATUS = "CASE WHEN auc < 0.7 OR psi > 0.25 THEN 'critical' WHEN psi > 0.1 THEN 'warning' ELSE 'healthy' END"
BAND = (
    "CASE WHEN psi < 0.1 THEN 'none' WHEN psi < 0.25 THEN 'moderate' WHEN psi >= 0.25 THEN 'significant' END"
)
REASON = (
    "CASE WHEN NOT coalesce(auc < 0.7, false) AND NOT coalesce(psi > 0.1, false) "
    "THEN 'Model metrics within acceptable range' ELSE concat_ws('; ', "
    "CASE WHEN auc < 0.7 THEN 'AUC (' || printf('%.4f', auc) || ') below threshold (0.70)' END, "
    "CASE WHEN psi > 0.25 THEN 'PSI (' || printf('%.4f', psi) || ') exceeds critical threshold (0.25)' "
    "WHEN psi > 0.1 AND NOT coalesce(auc < 0.7, false) "
    "THEN 'PSI (' || printf('%.4f', psi) || ') exceeds warning threshold (0.10)' END) END"
)


def feature_long(features: list[str], source: str, ids: str = "") -> str:
    """(ids, feature, value) without NULLs."""
    prefix = f"{ids}, " if ids else ""
    return " UNION ALL ".join(
        f"SELECT {prefix}'{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {source} WHERE {f} IS NOT NULL"
        for f in features
    )


def lerp(sorted_list: str, n: str, p: str) -> str:
    """Linear-interpolated percentile of a sorted list, taken from the nearer end."""
    rank = f"(CAST({p} AS DOUBLE) * ({n} - 1))"
    a = f"{sorted_list}[CAST(floor({rank}) AS BIGINT) + 1]"
    b = f"{sorted_list}[CAST(ceil({rank}) AS BIGINT) + 1]"
    t = f"({rank} - floor({rank}))"
    return f"CASE WHEN {t} < 0.5 THEN {a} + ({b} - {a}) * {t} ELSE {b} - ({b} - {a}) * (1 - {t}) END"


def drift_blocks(features: list[str], source: str = "model_rows") -> dict[str, str]:
    """Blocks ending in ``drifts``: feature, ks_stat, p_value, psi of train against oot."""
    edges = ", ".join(lerp("vals", "n", f"{i * 10.0 / 100.0!r}") for i in range(11))
    series = (
        "list_sum(list_transform(range(1, 101), lambda k: (CASE WHEN k % 2 = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(-2 AS DOUBLE) END) "
        "* exp(CAST(-2 AS DOUBLE) * k * k * lam * lam)))"
    )
    counts = ", ".join(
        f"sum({m}) FILTER (WHERE bin = {i}) AS {m}{i}" for m in ("e", "a") for i in range(10)
    )
    total = " + ".join(
        term(
            share_sql(f"coalesce(e{i}, 0)", "ne", "1e-4"),
            share_sql(f"coalesce(a{i}, 0)", "na", "1e-4"),
        )
        for i in range(10)
    )
    return {
        "long": feature_long(features, source, "split"),
        "vals": "SELECT feature, value, count(*) FILTER (WHERE split = 'train') AS e, "
        "count(*) FILTER (WHERE split = 'oot') AS a FROM long WHERE split IN ('train', 'oot') GROUP BY feature, value",
        "cums": "SELECT *, sum(e) OVER w AS ec, sum(a) OVER w AS ac, sum(e) OVER (PARTITION BY feature) AS ne, "
        "sum(a) OVER (PARTITION BY feature) AS na FROM vals WINDOW w AS (PARTITION BY feature ORDER BY value "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)",
        "kss": "SELECT feature, max(abs(CAST(ec AS DOUBLE) / ne - CAST(ac AS DOUBLE) / na)) AS ks_stat, "
        "CAST(max(ne) AS DOUBLE) AS ne, CAST(max(na) AS DOUBLE) AS na FROM cums GROUP BY feature",
        "lams": "SELECT *, ks_stat * sqrt(ne * na / (ne + na)) AS lam, greatest(ne, na) <= 10000 AS few, "
        "CAST(round(ks_stat * ne * na) AS BIGINT) AS lim, CAST(ne AS BIGINT) AS n1, CAST(ne + na AS BIGINT) AS nn FROM kss",
        # Draws without replacement that stay inside the band, one after another.
        "walk": "SELECT feature, CAST(0 AS BIGINT) AS k, CAST(0 AS BIGINT) AS i, CAST(1 AS DOUBLE) AS p FROM lams WHERE few AND lim > 0 "
        "UNION ALL SELECT feature, k + 1, i + s, sum(p * CASE WHEN s = 1 THEN n1 - i ELSE nn - n1 - k + i END / (nn - k)) "
        "FROM walk JOIN lams USING (feature), (VALUES (0), (1)) steps(s) "
        "WHERE k < nn AND abs((i + s) * nn - (k + 1) * n1) < lim AND i + s <= n1 AND k + 1 - i - s <= nn - n1 "
        "GROUP BY feature, k, i + s",
        "walked": "SELECT feature, max(p) AS inside FROM walk JOIN lams USING (feature) WHERE k = nn GROUP BY feature",
        "ksp": "SELECT feature, ks_stat, few, CASE WHEN few AND lim <= 0 THEN 1.0 WHEN few THEN 1 - coalesce(inside, 0) "
        f"WHEN lam < 0.2 THEN 1.0 ELSE greatest(0.0, least(1.0, {series})) END "
        "AS p_value FROM lams LEFT JOIN walked USING (feature)",
        "lists": "SELECT feature, list(value ORDER BY value) AS vals, count(*) AS n FROM long WHERE split = 'train' "
        "GROUP BY feature",
        "edges": f"SELECT feature, [{edges}] AS edges FROM lists",
        "bins": "SELECT c.*, CASE WHEN value < edges[1] OR value > edges[11] THEN NULL "
        "ELSE least(len(list_filter(edges, lambda x: x <= value)) - 1, 9) END AS bin FROM cums c JOIN edges USING (feature)",
        "hists": f"SELECT feature, max(ne) AS ne, max(na) AS na, {counts} FROM bins GROUP BY feature",
        "qpsi": f"SELECT feature, {total} AS psi FROM hists",
        "drifts": "SELECT feature, ks_stat, p_value, psi, (p_value < 0.05 OR psi > 0.1) AS drift_detected "
        "FROM ksp JOIN qpsi USING (feature)",
    }
