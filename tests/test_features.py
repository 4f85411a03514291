"""Feature rules on hand-made rows, with the edge cases of each map and guard."""

from datetime import date

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from riskmart import fixed_values as fv
from riskmart.functions import dates, encounter, icd9
from riskmart.operators import layers
from riskmart.schemas import ENCOUNTER_COLUMNS, RAW_ENCOUNTER

BASE = {c: None for c in ENCOUNTER_COLUMNS} | {
    "encounter_id": "1",
    "race": "Caucasian",
    "gender": "Female",
    "age": "[70-80)",
    "admission_type_id": "1",
    "discharge_disposition_id": "11",
    "admission_source_id": "7",
    "time_in_hospital": "3",
    "num_lab_procedures": "40",
    "num_procedures": "2",
    "num_medications": "12",
    "number_outpatient": "1",
    "number_emergency": "2",
    "number_inpatient": "3",
    "number_diagnoses": "6",
    "max_glu_serum": "None",
    "A1Cresult": "None",
    "insulin": "Up",
    "metformin": "Down",
    "change": "Ch",
    "diabetesMed": "Yes",
    "readmitted": "<30",
    "snapshot_date": "1999-01-01",
}


def silver(spark, *changes):
    rows = [(i, *((BASE | c)[n] for n in ENCOUNTER_COLUMNS)) for i, c in enumerate(changes or ({},))]
    schema = StructType([StructField("i", IntegerType()), *RAW_ENCOUNTER.fields])
    return layers.silver(layers.bronze(spark.createDataFrame(rows, schema)))


def values(spark, column, name, inputs):
    """The derived column for each input value of the raw column ``name``, in one job."""
    rows = layers.feature_store(silver(spark, *[{name: v} for v in inputs]), ["i", column])
    return [r[1] for r in rows.orderBy("i").collect()]


def derived(spark, *columns, **changes):
    return tuple(layers.feature_store(silver(spark, changes), list(columns)).first())


def test_stored_columns_and_types(spark):
    features = layers.feature_store(silver(spark))
    assert features.columns == fv.FEATURE_STORE_COLUMNS
    assert len(features.columns) == 19 and len(fv.MODEL_FEATURES) == 14
    types = dict(features.dtypes)
    assert types["medication_density"] == "double" and types["snapshot_date"] == "date"
    assert types["severity_x_visits"] == "int"


RACES = {
    "AfricanAmerican": (1, 0, 0, 0),
    "Caucasian": (0, 1, 0, 0),
    "Asian": (0, 0, 1, 0),
    "Unknown": (0, 0, 1, 0),
    "?": (0, 0, 1, 0),
    "Hispanic": (0, 0, 0, 1),
    "Other": (0, 0, 0, 0),
    None: (0, 0, 0, 0),
}


def test_race_flags(spark):
    rows = silver(spark, *[{"race": r} for r in RACES]).orderBy("i").select(*encounter.race_flags(F.col("race")))
    assert [tuple(r) for r in rows.collect()] == list(RACES.values())


def test_strict_race_has_its_own_unknown_flag(spark):
    rows = silver(spark, {"race": "?"}, {"race": None}, {"race": "Asian"})
    strict = rows.select(*encounter.race_flags(F.col("race"), strict=True)).collect()
    assert [(r["race_Asian"], r["race_Unknown"]) for r in strict] == [(0, 1), (0, 1), (1, 0)]


def test_age(spark):
    bands = [*fv.AGE_BANDS, "[100-110)", None]
    assert values(spark, "age_midpoint", "age", bands) == [*range(5, 100, 10), None, None]
    assert values(spark, "age_group_index", "age", bands) == [*range(1, 11), None, None]
    labels = ["Young"] * 3 + ["Adult"] * 4 + ["Senior"] * 3 + ["Unknown"] * 2
    assert values(spark, "age_group_label", "age", bands) == labels


def test_admission_severity(spark):
    codes = ["1", "2", "3", "4", "5", "6", "7", "8", "9", "?", None]
    expected = [3, 2, 1, 1, 0, 0, 3, 0, None, None, None]
    assert values(spark, "admission_severity_score", "admission_type_id", codes) == expected


def test_severity_maps_cover_their_codes(spark):
    codes = list(fv.DISCHARGE_SEVERITY)
    assert sorted(codes) == list(range(1, 31))
    found = values(spark, "discharge_severity_score", "discharge_disposition_id", ["7", "18", "21", "99"])
    assert found == [4, 0, 5, None]
    found = values(spark, "admission_source_risk_score", "admission_source_id", ["16", "19", "20", "26", None])
    assert found == [None, 4, 0, 3, None]


def test_ratios_and_guards(spark):
    import numpy as np

    intensity, density = np.float32(3 / 12), np.float32(42 / 6)
    expected = float(intensity) / float(np.float32(density + np.float32(1)))
    assert derived(spark, "medication_density", "severity_x_visits", "total_visits") == (expected, 30, 6)
    columns = ["medication_intensity", "diagnosis_density", "total_visits", "medication_density"]
    no_drugs, no_diagnoses = derived(spark, *columns, num_medications="0"), derived(spark, *columns, number_diagnoses="0")
    assert no_drugs == (None, 7.0, 6, None) and no_diagnoses == (0.25, None, None, None)
    assert derived(spark, "severity_x_visits", discharge_disposition_id="99") == (None,)


def test_laboratory(spark):
    missing = [None, "", "?"]
    assert values(spark, "max_glu_serum", "max_glu_serum", missing) == ["None"] * 3
    assert values(spark, "A1Cresult_ord", "A1Cresult", [*missing, "Norm", ">7", ">8", ">9"]) == [0, 0, 0, 1, 2, 3, None]
    assert values(spark, "poor_glucose_control", "A1Cresult", [">9", ">7", "Norm", None]) == [1, 1, 0, 0]
    assert values(spark, "poor_glucose_control", "max_glu_serum", [">300", ">200", "Norm"]) == [1, 1, 0]


def test_drugs_and_flags(spark):
    drug = "glyburide-metformin"
    codes = {"No": 0, "Steady": 1, "Down": -1, "Up": 2, None: None, "x": None}
    assert values(spark, f"{drug}_ord", drug, codes) == list(codes.values())
    exact = silver(spark).select(
        encounter.change_flag(F.col("change")), encounter.change_flag(F.col("change"), exact_case=True)
    )
    assert tuple(exact.first()) == (1, 0)
    assert values(spark, "diabetesMed", "diabetesMed", ["Yes", "No", None]) == [1, 0, 0]


def test_malformed_integers_become_null(spark):
    row = silver(spark, {"num_medications": "12x", "time_in_hospital": "?", "encounter_id": "4294967296"}).first()
    assert row["num_medications"] is None and row["time_in_hospital"] is None
    assert row["encounter_id"] == 4294967296


def test_label(spark):
    rows = silver(spark, *[{"readmitted": r} for r in ("<30", ">30", "NO", None)])
    assert [r["label"] for r in layers.label_store(rows).collect()] == [1, 0, 0, 0]


ICD9 = {
    "250.83": "diabetes", "251": "other", "428": "circulatory", "390": "circulatory", "459.99": "circulatory",
    "460": "respiratory", " 486 ": "respiratory", "520": "digestive", "580": "genitourinary", "629.9": "genitourinary",
    "710": "musculoskeletal", "740": "other", "140": "neoplasms", "240": "other", "800": "injury", "1000": "other",
    "V45": "supplementary_v", "E909": "supplementary_e", "?": "unknown", None: "unknown", "250d": "other",
    "nan": "other", "abc": "other", "2.5e2": "diabetes", " V1": "supplementary_v",
}


def test_icd9(spark):
    rows = spark.createDataFrame([(c, c, None, i) for i, c in enumerate(ICD9)], "diag_1 string, diag_2 string, diag_3 string, i int")
    found = icd9.with_diagnosis_categories(rows).orderBy("i").collect()
    assert [r["diag_1_category"] for r in found] == list(ICD9.values())
    assert all(r["diag_3_category"] == "unknown" for r in found)


def test_diagnosis_counts(spark):
    rows = spark.createDataFrame(
        [("428", "250.1", "850"), ("428", "429", "V1"), (None, "?", None)], "diag_1 string, diag_2 string, diag_3 string"
    )
    found = layers.diagnosis_features(rows).collect()
    assert [r["high_risk_diag_count"] for r in found] == [3, 2, 0]
    assert [r["has_circulatory"] for r in found] == [1, 1, 0]
    assert [r["multiple_systems"] for r in found] == [1, 0, 0]
    assert [r["diag1_unknown"] for r in found] == [0, 0, 1]
    assert len([c for c in found[0].asDict() if c.startswith("diag1_")]) == len(fv.ICD9_CATEGORIES)


def test_month_list(spark):
    bounds = spark.createDataFrame([(date(1999, 1, 15), date(2008, 12, 31))], "start date, end date")
    months = [r[0] for r in dates.month_list(bounds).collect()]
    assert len(months) == 120 and months[0] == date(1999, 1, 1) and months[-1] == date(2008, 12, 1)


def test_relative_windows():
    windows = dates.relative_windows(date(2009, 1, 1), 108, 12)
    assert (windows.oot.start, windows.oot.end) == (date(2008, 1, 1), date(2008, 12, 31))
    assert (windows.train_test.start, windows.train_test.end) == (date(1999, 1, 1), date(2007, 12, 31))


def test_dates(spark):
    row = spark.createDataFrame([("2008-03-01 00:00:00", "oops")], "a string, b string").select(
        dates.normalise_date(F.col("a")), dates.normalise_date(F.col("b"))
    ).first()
    assert tuple(row) == ("2008-03-01", None)
