"""The encounter view over the star-schema test tables.

The tables hold no hospital data, so a deterministic view derives one raw encounter per
order. Each column is one SQL expression that means the same in Spark SQL and in ANSI SQL,
so that the engine and the check queries start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixed_values import DRUGS, PAYER_RISK, WEIGHT_BANDS

KEY, CUST = "o_orderkey", "o_custkey"


def _pick(index: str, values: list[str | None]) -> str:
    """CASE over ``index`` = 0, 1, ...; None gives NULL."""
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values)
    )
    return f"CASE {index} {arms} END"


def _diagnosis(i: int) -> str:
    special = {0: "'?'", 1: "'V45'", 2: "'E909'", 3: "'250.83'", 4: "'250d'", 5: "NULL", 6: "' 486 '", 7: "'428'"}
    arms = " ".join(f"WHEN {k} THEN {v}" for k, v in special.items())
    other = f"CAST(({KEY} * 7 + {331 * i}) % 1000 AS STRING)"
    return f"CASE ({KEY} + {5 * i}) % 13 {arms} ELSE {other} END"


def _text(expression: str) -> str:
    return f"CAST({expression} AS STRING)"


PAYERS = sorted(PAYER_RISK)

# raw column -> expression; every raw column is text, as in a CSV file
RAW_EXPRESSIONS: dict[str, str] = {
    "encounter_id": _text(KEY),
    "patient_nbr": _text(CUST),
    "race": "CASE c_mktsegment WHEN 'AUTOMOBILE' THEN 'Caucasian' WHEN 'BUILDING' THEN 'AfricanAmerican' "
    "WHEN 'FURNITURE' THEN '?' WHEN 'HOUSEHOLD' THEN 'Hispanic' "
    f"WHEN 'MACHINERY' THEN CASE WHEN {CUST} % 2 = 0 THEN 'Asian' END END",
    "gender": _pick(f"{CUST} % 2", ["Female", "Male"]),
    "age": f"'[' || {_text(f'10 * ({CUST} % 11)')} || '-' || {_text(f'10 * ({CUST} % 11) + 10')} || ')'",
    "weight": f"CASE WHEN {KEY} % 4 <> 0 THEN '?' ELSE {_pick(f'({KEY} // 4) % 9', WEIGHT_BANDS)} END",
    "admission_type_id": f"CASE WHEN {KEY} % 97 = 0 THEN '?' WHEN {KEY} % 89 = 0 THEN '12x' "
    f"ELSE substr(o_orderpriority, 1, 1) END",
    "discharge_disposition_id": _text(f"1 + {KEY} % 30"),
    "admission_source_id": _text(f"1 + {CUST} % 26"),
    "time_in_hospital": _text(f"1 + {KEY} % 14"),
    "payer_code": _pick(f"{KEY} % {len(PAYERS)}", PAYERS),
    "medical_specialty": "'?'",
    "num_lab_procedures": _text("coalesce(lines_sum, 0)"),
    "num_procedures": _text(f"{KEY} % 7"),
    "num_medications": _text("coalesce(lines, 0)"),
    "number_outpatient": _text(f"{KEY} % 4"),
    "number_emergency": _text(f"{KEY} % 3"),
    "number_inpatient": _text(f"{KEY} % 5"),
    "diag_1": _diagnosis(1),
    "diag_2": _diagnosis(2),
    "diag_3": _diagnosis(3),
    "number_diagnoses": _text(f"{KEY} % 10"),
    "max_glu_serum": _pick(f"{KEY} % 7", ["None", "Norm", ">200", ">300", "?", None, ""]),
    "A1Cresult": _pick(f"{CUST} % 8", ["None", "Norm", ">7", ">8", ">9", "?", None, ""]),
    **{
        drug: _pick(f"({KEY} // {j + 1} + {j}) % 6", ["No", "Steady", "Up", "Down", None, "No"])
        for j, drug in enumerate(DRUGS)
    },
    "change": _pick(f"{KEY} % 3", ["Ch", "No", "ch"]),
    "diabetesMed": _pick(f"{KEY} % 2", ["Yes", "No"]),
    "readmitted": "CASE o_orderstatus WHEN 'F' THEN '<30' WHEN 'O' THEN '>30' WHEN 'P' THEN 'NO' END",
    "snapshot_date": _text("CAST(date_trunc('month', o_orderdate) AS DATE)"),
}

# Prediction stand-in: a pseudo-random part plus a label signal that fades month by month.
# algorithm -> (multiplier of the random part, strength of the signal)
SCORE_SHAPES = {
    "logistic_regression": (7919, 0.36),
    "random_forest": (6007, 0.40),
    "xgboost": (4513, 0.44),
}
_MONTHS = "((year(o_orderdate) - 1995) * 12 + month(o_orderdate) - 1)"
LABEL_EXPRESSION = "CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END"
SNAPSHOT_EXPRESSION = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def score_expression(algorithm: str) -> str:
    """Score in [0, 1]; written with CAST so that no literal is read as a decimal."""
    multiplier, strength = SCORE_SHAPES[algorithm]

    def double(x) -> str:
        return f"CAST({x} AS DOUBLE)"

    noise = f"{double(f'({KEY} * {multiplier}) % 10007')} / {double(10007)} * {double(0.6)}"
    signal = f"{double(LABEL_EXPRESSION)} * ({double(strength)} - {double(0.004)} * {double(_MONTHS)})"
    return f"least({double(1)}, {noise} + {signal})"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders")


def raw_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One text row per order. Line items are summed per order before the join, so the large
    table is shuffled once, pre-aggregated, on the key the orders are joined on."""
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.count(F.lit(1)).alias("lines"), F.sum("l_linenumber").alias("lines_sum"))
    )
    orders = _orders(spark, sf_dir)
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    joined = orders.join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left").join(
        customers, orders["o_custkey"] == customers["c_custkey"], "left"
    )
    return joined.select(
        *[F.expr(_spark(text)).alias(name) for name, text in RAW_EXPRESSIONS.items()]
    )


def _spark(text: str) -> str:
    return text.replace("//", "div")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label store: it needs the orders alone."""
    return table(spark, sf_dir, "orders").select(
        F.col(KEY).alias("encounter_id"),
        F.expr(LABEL_EXPRESSION).alias("label"),
        F.expr(SNAPSHOT_EXPRESSION).alias("snapshot_date"),
    )


def predictions(spark: SparkSession, sf_dir: str, algorithms: list[str] | None = None) -> DataFrame:
    """Predictions of the three stand-in models, one row per encounter and algorithm."""
    scores = F.array(
        *[
            F.struct(F.lit(a).alias("model_algorithm"), F.expr(score_expression(a)).alias("model_predictions"))
            for a in algorithms or list(SCORE_SHAPES)
        ]
    )
    return _orders(spark, sf_dir).select(
        F.col(KEY).alias("encounter_id"),
        F.expr(SNAPSHOT_EXPRESSION).alias("snapshot_date"),
        F.inline(scores),
    )


def wide_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per encounter with the score of each stand-in model in a column of its own."""
    return table(spark, sf_dir, "orders").select(
        F.col(KEY).alias("encounter_id"),
        F.expr(SNAPSHOT_EXPRESSION).alias("snapshot_date"),
        *[F.expr(score_expression(a)).alias(f"p_{a}") for a in SCORE_SHAPES],
    )


def volume_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A scored table ten times as long, one row per line item, for volume tests."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit("volume").alias("model_algorithm"),
        F.date_format("l_shipdate", "yyyy-MM").alias("snapshot_month"),
        (F.col("l_quantity") / F.lit(50.0)).alias("model_predictions"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
    )
