"""Feature rules of one encounter, as columns over the cleaned table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .lookups import flag, lookup, lookup_groups


# --- demographics ----------------------------------------------------------------
def race_cleaned(race: Column) -> Column:
    """``?`` becomes ``Unknown``; a NULL race stays NULL."""
    return F.when(race.isin("?", "Unknown"), "Unknown").otherwise(race)


# flag -> the cleaned races it marks
RACE_FLAGS = {
    "race_AfricanAmerican": ["AfricanAmerican"],
    "race_Caucasian": ["Caucasian"],
    "race_Asian": ["Asian", "Unknown"],
    "race_Hispanic": ["Hispanic"],
    "race_Unknown": ["Unknown"],
}


def race_flag(race: Column, name: str, strict: bool = False) -> Column:
    """One race indicator. By default an unknown race counts as Asian, which the stored features
    rely on; ``strict`` gives it (and NULL) the flag ``race_Unknown`` alone."""
    cleaned = race_cleaned(race)
    if name == "race_Unknown":
        return flag(cleaned.isNull() | (cleaned == "Unknown"))
    return flag(cleaned.isin(*[r for r in RACE_FLAGS[name] if not strict or r != "Unknown"]))


def race_flags(race: Column, strict: bool = False) -> list[Column]:
    names = [n for n in RACE_FLAGS if strict or n != "race_Unknown"]
    return [race_flag(race, n, strict).alias(n) for n in names]


def is_female(gender: Column) -> Column:
    return flag(gender == "Female")


def age_midpoint(age: Column) -> Column:
    return lookup(age, fv.AGE_MIDPOINT)


def age_group_index(age: Column) -> Column:
    return lookup(age, fv.AGE_INDEX)


def age_group_label(age: Column) -> Column:
    return F.coalesce(lookup_groups(age, fv.AGE_LABELS), F.lit("Unknown"))


# --- admission and discharge -----------------------------------------------------
def admission_type_desc(code: Column) -> Column:
    return lookup(code, fv.ADMISSION_TYPE)


def admission_severity_score(code: Column) -> Column:
    """Score of the admission type that the code stands for."""
    return lookup(code, {c: fv.ADMISSION_SEVERITY[name] for c, name in fv.ADMISSION_TYPE.items()})


def discharge_severity_score(code: Column) -> Column:
    return lookup(code, fv.DISCHARGE_SEVERITY)


def admission_source_risk_score(code: Column) -> Column:
    return lookup(code, fv.ADMISSION_SOURCE_RISK)


# --- intensity ---------------------------------------------------------------------
# The stored ratios are single precision, so the density built on them is too
# exact in double to match; the casts below keep the stored digits.
def medication_intensity() -> Column:
    meds = F.col("num_medications")
    return F.when(meds > 0, (F.col("time_in_hospital") / meds).cast("float"))


def diagnosis_density() -> Column:
    diagnoses = F.col("number_diagnoses")
    work = F.col("num_lab_procedures") + F.col("num_procedures")
    return F.when(diagnoses > 0, (work / diagnoses).cast("float"))


def medication_density() -> Column:
    divisor = diagnosis_density() + F.lit(1.0).cast("float")
    return F.try_divide(medication_intensity().cast("double"), divisor.cast("double"))


def total_visits() -> Column:
    visits = F.col("number_outpatient") + F.col("number_emergency") + F.col("number_inpatient")
    return F.when(F.col("number_diagnoses") > 0, visits.cast("int"))


def severity_x_visits() -> Column:
    return discharge_severity_score(F.col("discharge_disposition_id")) * total_visits()


# --- laboratory and drugs ------------------------------------------------------------
def none_if_missing(result: Column) -> Column:
    """Laboratory placeholders: NULL, empty and ``?`` read as the text ``None``."""
    missing = result.isNull() | result.isin("", "?")
    return F.when(missing, F.lit("None")).otherwise(result)


def max_glu_serum_ord(result: Column) -> Column:
    return lookup(result, fv.GLUCOSE_ORDINAL)


def a1c_result_ord(result: Column) -> Column:
    return lookup(result, fv.A1C_ORDINAL)


def poor_glucose_control() -> Column:
    return flag(
        F.col("max_glu_serum").isin(*fv.HIGH_GLUCOSE) | F.col("A1Cresult").isin(*fv.HIGH_A1C)
    )


def drug_ord(drug: str) -> Column:
    return lookup(F.col(f"`{drug}`"), fv.DRUG_ORDINAL)


def drug_ordinals(drugs: list[str] = fv.DRUGS) -> list[Column]:
    return [drug_ord(d).alias(f"{d}_ord") for d in drugs]


def change_flag(change: Column, exact_case: bool = False) -> Column:
    """Medication changed. The data writes ``Ch``; ``exact_case`` accepts only ``ch``."""
    return flag((change if exact_case else F.lower(change)) == "ch")


def diabetes_med_flag(answer: Column) -> Column:
    return flag(answer == "Yes")


# --- label -----------------------------------------------------------------------------
def readmission_label(readmitted: Column) -> Column:
    return flag(readmitted == "<30").cast("int")


# --- optional columns, off by default ----------------------------------------------------
def weight_midpoint(weight: Column) -> Column:
    return lookup(weight, fv.WEIGHT_MIDPOINT).cast("int")


def weight_group_label(weight: Column) -> Column:
    return F.coalesce(lookup_groups(weight, fv.WEIGHT_LABELS), F.lit("Unknown"))


def is_obese(weight: Column) -> Column:
    return flag(weight.isin(*fv.WEIGHT_LABELS["Obese"]))


def payer_risk_score(payer: Column) -> Column:
    return lookup(payer, fv.PAYER_RISK)
