"""ICD-9 diagnosis grouping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import fixed_values as fv
from .lookups import flag

# A plain decimal number. Spark reads '250d' as 250.0, hence the guard.
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_WHITESPACE = " \t\n\r\f\v"


def code_number(code: Column) -> Column:
    """The code as a number; NULL unless it is a plain decimal."""
    text = F.trim(code, F.lit(_WHITESPACE))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def category_of(code: Column, number: Column) -> Column:
    """One of twelve categories, from a code and its number; NULL and ``?`` are ``unknown``."""
    out = F.when(code.isNull() | (code == "?"), "unknown")
    for category, (low, high) in fv.ICD9_RANGES.items():
        out = out.when((number >= low) & (number < high), category)
    text = F.trim(code, F.lit(_WHITESPACE))
    out = out.when(number.isNull() & text.startswith("V"), "supplementary_v")
    out = out.when(number.isNull() & text.startswith("E"), "supplementary_e")
    return out.otherwise("other")


def with_diagnosis_categories(rows: DataFrame) -> DataFrame:
    """Add ``diag_<i>_category``. The numbers get a projection of their own, so that each code is
    parsed once and not once per range."""
    parsed = rows.select("*", *[code_number(F.col(f"diag_{i}")).alias(f"_number_{i}") for i in (1, 2, 3)])
    categories = [
        category_of(F.col(f"diag_{i}"), F.col(f"_number_{i}")).alias(f"diag_{i}_category") for i in (1, 2, 3)
    ]
    return parsed.select(*[F.col(f"`{c}`") for c in rows.columns], *categories)


def _categories() -> Column:
    return F.array(*[F.col(f"diag_{i}_category") for i in (1, 2, 3)])


def high_risk_diag_count() -> Column:
    hits = [flag(F.col(f"diag_{i}_category").isin(*fv.HIGH_RISK_CATEGORIES)) for i in (1, 2, 3)]
    return hits[0] + hits[1] + hits[2]


def primary_category_dummies() -> list[Column]:
    """Fixed one-hot columns, so that the schema does not depend on the data."""
    primary = F.col("diag_1_category")
    return [flag(primary == c).alias(f"diag1_{c}") for c in fv.ICD9_CATEGORIES]


def has_circulatory() -> Column:
    return flag(F.array_contains(_categories(), "circulatory"))


def multiple_systems() -> Column:
    return flag(F.size(F.array_distinct(_categories())) == 3)
