"""Histogram and stability-index expressions over small arrays of counts."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import fixed_values as fv


def bin_edges(bins: int) -> list[float]:
    """Equal-width edges on [0, 1]; computed as ``i * (1 / bins)`` so that an edge such as
    0.30000000000000004 is the value the histogram contract expects."""
    width = 1.0 / bins
    return [0.0] + [i * width for i in range(1, bins)] + [1.0]


def score_bin(score: Column, bins: int = 10) -> Column:
    """Bin number 0..bins-1 of a score; the last bin is closed; NULL outside [0, 1].

    Explicit edge comparison: ``width_bucket`` puts 0.3 and 1.0 in other bins.
    """
    edges = bin_edges(bins)
    inside = (score >= F.lit(edges[0])) & (score <= F.lit(edges[-1]))
    out = F.lit(bins - 1)
    for i in range(bins - 2, -1, -1):
        out = F.when(score < F.lit(edges[i + 1]), F.lit(i)).otherwise(out)
    return F.when(inside, out)


def share(count: Column, total: Column, floor: float) -> Column:
    """count / total with an empty cell lifted to ``floor``."""
    value = F.try_divide(count.cast("double"), total.cast("double"))
    return F.when(count == 0, F.lit(floor)).otherwise(value)


def index_term(expected: Column, actual: Column) -> Column:
    return (expected - actual) * F.log(expected / actual)


def stability_index(
    expected: Column,
    expected_total: Column,
    actual: Column,
    actual_total: Column,
    floor: float = fv.SHARE_FLOOR,
) -> Column:
    """Sum of ``(e - a) * ln(e / a)`` over two equally long arrays of counts."""
    terms = F.zip_with(
        expected,
        actual,
        lambda e, a: index_term(share(e, expected_total, floor), share(a, actual_total, floor)),
    )
    return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term)


def histogram_counts(bin_column: Column, weight: Column, bins: int) -> Column:
    """Aggregate: array of weight sums for bin 0..bins-1, in one pass and without a bin key."""
    return F.array(
        *[F.sum(F.when(bin_column == i, weight).otherwise(F.lit(0))) for i in range(bins)]
    )


def kolmogorov_p_value(d: Column, n1: Column, n2: Column, terms: int = 100) -> Column:
    """Asymptotic two-sample p-value, ``2 * sum (-1)^(k-1) exp(-2 k^2 lambda^2)``."""
    n1, n2 = n1.cast("double"), n2.cast("double")
    lam = d * F.sqrt(n1 * n2 / (n1 + n2))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)),
        F.lit(0.0),
        lambda total, k: total
        + F.when(k % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * k * k * lam * lam),
    )
    # The series does not converge near zero, where the p-value is 1.
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def two_sample_p_value(d: float, n1: int, n2: int) -> float:
    """Probability that two samples of these sizes from one continuous distribution differ by ``d`` or more.

    Merging the samples in order draws their rows without replacement: after k draws, i from the first, the next one is
    from the first with probability (n1 - i) / (n1 + n2 - k). The walks that stay closer than ``d`` to the diagonal are
    followed draw by draw, as one vector over the values of i inside the band.
    """
    n1, n2 = int(n1), int(n2)
    both = n1 + n2
    limit = round(d * n1 * n2)  # the distance is a whole number of 1 / (n1 n2)
    if limit <= 0 or not n1 or not n2:
        return 1.0
    low, inside = 0, np.ones(1)
    for k in range(both):
        first = max(0, k + 1 - n2, ((k + 1) * n1 - limit) // both + 1)
        last = min(n1, k + 1, -(-((k + 1) * n1 + limit) // both) - 1)
        if first > last:
            return 1.0
        i = np.arange(low, low + len(inside))
        moved = np.zeros(len(inside) + 1)  # values of i from low on
        moved[:-1] = inside * (n2 - k + i)
        moved[1:] += inside * (n1 - i)
        kept = np.zeros(last - first + 1)
        start, stop = max(first, low), min(last, low + len(inside)) + 1
        kept[start - first : stop - first] = moved[start - low : stop - low] / (both - k)
        low, inside = first, kept
    return float(min(1.0, max(0.0, 1.0 - inside[n1 - low])))


@F.pandas_udf(T.DoubleType())
def exact_p_value(d: pd.Series, n1: pd.Series, n2: pd.Series) -> pd.Series:
    """``two_sample_p_value`` of each row, null for a null distance: for reports of a row per feature."""
    found = [None if pd.isna(x) else two_sample_p_value(x, a, b) for x, a, b in zip(d, n1, n2)]
    return pd.Series(found, dtype="float64")


def psi_band(psi: Column) -> Column:
    return (
        F.when(psi < fv.PSI_WARNING, "none")
        .when(psi < fv.PSI_CRITICAL, "moderate")
        .when(psi >= fv.PSI_CRITICAL, "significant")
    )
