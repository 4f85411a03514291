"""Distribution drift: stability indices, Kolmogorov-Smirnov, baselines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import fixed_values as fv
from ..functions import stability as st
from .ranking import percentiles, running_totals, usable

DECILES = [i * 10.0 / 100.0 for i in range(11)]
QUARTILES = [0.25, 0.5, 0.75]
#: Samples of more rows take the asymptotic p-value of the Kolmogorov-Smirnov test.
EXACT_ROWS = 10_000


def _long(rows: DataFrame, ids: list[str], features: list[str], kind: str, name: str) -> DataFrame:
    """(ids, feature, value) by ``inline``: plans that read the long form twice share its shuffle, which they would not
    with ``unpivot``, whose copies the planner does not recognise as equal."""
    cells = [F.struct(F.lit(f).alias("feature"), F.col(f"`{f}`").cast(kind).alias(name)) for f in features]
    return rows.select(*ids, F.inline(F.array(*cells)))


def unpivot_features(rows: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """Long form (ids, feature, value) with NULL and NaN values left out."""
    return _long(rows, ids, features, "double", "value").where(usable(F.col("value")))


def unpivot_categories(rows: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """Long form (ids, feature, category) with NULL values left out."""
    return _long(rows, ids, features, "string", "category").where(F.col("category").isNotNull())


# --- score histograms -----------------------------------------------------------------
def score_histogram(rows: DataFrame, keys: list[str], score: str, bins: int = 10) -> DataFrame:
    """Share of all rows of the group per bin; every bin is present. One row per (keys, bin)."""
    bin_column = st.score_bin(F.col(score), bins)
    counted = rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"),
        st.histogram_counts(bin_column, F.lit(1), bins).alias("counts"),
    )
    cells = counted.select(*keys, "rows", F.posexplode("counts").alias("bin", "n"))
    return cells.select(*keys, "bin", "n", (F.col("n") / F.col("rows")).alias("share"))


def population_stability(
    rows: DataFrame, keys: list[str], order: str, score: str, bins: int = 10
) -> DataFrame:
    """PSI of every period against the first one of its group, in one pass over the rows."""
    bin_column = st.score_bin(F.col(score), bins)
    counted = rows.groupBy(*keys, order).agg(
        F.count(F.lit(1)).alias("row_count"),
        st.histogram_counts(bin_column, F.lit(1), bins).alias("counts"),
    )
    return against_first(counted, keys, order).select(*keys, order, "row_count", "psi")


def against_first(counted: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Add ``psi`` to per-period histograms (``row_count``, ``counts``): the reference is the
    first period. The window sees one row per period."""
    by_period = Window.partitionBy(*keys).orderBy(order)
    reference = counted.withColumns(
        {
            "first_counts": F.first("counts").over(by_period),
            "first_rows": F.first("row_count").over(by_period),
        }
    )
    psi = st.stability_index(
        F.col("first_counts"), F.col("first_rows"), F.col("counts"), F.col("row_count")
    )
    return reference.withColumn("psi", psi).drop("first_counts", "first_rows")


# --- categories ---------------------------------------------------------------------------
def category_counts(rows: DataFrame, keys: list[str], category: str) -> DataFrame:
    """Non-null values per category, with the total of their group.

    The totals have one row per group, so the join on the group key is either broadcast by the
    adaptive planner or, if the groups are many, split where one of them is hot.
    """
    counts = rows.where(F.col(category).isNotNull()).groupBy(*keys, category).agg(
        F.count(F.lit(1)).alias("n")
    )
    return counts.join(counts.groupBy(*keys).agg(F.sum("n").alias("total")), keys)


def category_shares(rows: DataFrame, keys: list[str], category: str) -> DataFrame:
    """Share of each category among the non-null values of its group."""
    return category_counts(rows, keys, category).select(
        *keys, category, "n", (F.col("n") / F.col("total")).alias("share")
    )


def aligned_shares(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """Two share tables over the union of their categories; a missing share is 1e-6."""
    e = expected.select(*on, F.col("share").alias("expected"))
    a = actual.select(*on, F.col("share").alias("actual"))
    both = e.join(a, on, "full_outer")
    fill = F.lit(fv.SHARE_FLOOR)
    return both.select(
        *on, F.coalesce("expected", fill).alias("expected"), F.coalesce("actual", fill).alias("actual")
    )


def characteristic_stability(expected: DataFrame, actual: DataFrame, features: list[str]) -> DataFrame:
    """CSI per categorical feature between two tables."""
    sides = [
        category_shares(unpivot_categories(side, [], features), ["feature"], "category")
        for side in (expected, actual)
    ]
    terms = aligned_shares(*sides, on=["feature", "category"])
    return terms.groupBy("feature").agg(
        F.sum(st.index_term(F.col("expected"), F.col("actual"))).alias("csi")
    )


def sample_stability(
    rows: DataFrame, features: list[str], sample: str = "split", expected: str = "train", actual: str = "oot"
) -> DataFrame:
    """CSI per categorical feature between two samples of ``rows``, which are read once: both samples are counted in
    one aggregate, and the totals are sums of its result."""
    long = unpivot_categories(rows.where(F.col(sample).isin(expected, actual)), [sample], features)
    counts = long.groupBy("feature", "category").agg(
        F.count_if(F.col(sample) == expected).alias("e"), F.count_if(F.col(sample) == actual).alias("a")
    )
    totals = counts.groupBy("feature").agg(F.sum("e").alias("e_all"), F.sum("a").alias("a_all"))
    shares = [st.share(F.col(c), F.col(f"{c}_all"), fv.SHARE_FLOOR) for c in ("e", "a")]
    return counts.join(totals, "feature").groupBy("feature").agg(F.sum(st.index_term(*shares)).alias("csi"))


def characteristic_stability_by_period(rows: DataFrame, period: str, features: list[str]) -> DataFrame:
    """CSI of every period against the first, per feature.

    A reference category that a period lacks adds ``term(e, 1e-6)``. Summing that over the whole
    reference once, and taking it back where the period does have the category, needs one
    equi-join and no pairing of periods with categories.
    """
    dated = rows.where(F.col(period).isNotNull())  # here, so that all uses of the counts have one plan
    counts = unpivot_categories(dated, [period], features).groupBy("feature", period, "category").agg(
        F.count(F.lit(1)).alias("n")
    )
    # One row per (feature, period): the window below sees no categories.
    totals = counts.groupBy("feature", period).agg(F.sum("n").alias("total"))
    dated_totals = totals.withColumn("first_period", F.min(period).over(Window.partitionBy("feature")))
    shares = counts.join(dated_totals, ["feature", period]).withColumn("share", F.col("n") / F.col("total"))
    absent = st.index_term(F.col("e"), F.lit(fv.SHARE_FLOOR))
    reference = shares.where(F.col(period) == F.col("first_period")).select(
        "feature", "category", F.col("share").alias("e")
    )
    all_absent = reference.groupBy("feature").agg(F.sum(absent).alias("all_absent"))
    matched = shares.select("feature", period, "category", "share").join(
        reference, ["feature", "category"], "left"
    )
    term = st.index_term(F.coalesce("e", F.lit(fv.SHARE_FLOOR)), F.col("share"))
    taken_back = F.when(F.col("e").isNotNull(), absent).otherwise(0.0)
    summed = matched.groupBy("feature", period).agg(F.sum(term - taken_back).alias("present"))
    return summed.join(all_absent, "feature").select(
        "feature", period, (F.col("present") + F.col("all_absent")).alias("csi")
    )


# --- numeric features -------------------------------------------------------------------------
def null_shares(rows: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """(ids, feature, null_pct) from one aggregate over the rows."""
    missing = [(F.avg((~usable(F.col(f"`{f}`").cast("double"))).cast("double")) * 100.0).alias(f) for f in features]
    return rows.groupBy(*ids).agg(*missing).unpivot(ids, features, "feature", "null_pct")


def value_totals(rows: DataFrame, sample: str, expected: str, actual: str, features: list[str]) -> DataFrame:
    """Running counts of two samples over the pooled distinct values of each feature."""
    long = unpivot_features(rows.where(F.col(sample).isin(expected, actual)), [sample], features)
    counts = long.groupBy("feature", "value").agg(
        F.count_if(F.col(sample) == expected).alias("expected"),
        F.count_if(F.col(sample) == actual).alias("actual"),
    )
    return running_totals(counts, ["feature"], "value", ["expected", "actual"])


def _widest_gap() -> Column:
    """Aggregate: largest distance of the two empirical distributions."""
    f1 = F.try_divide(F.col("expected_to").cast("double"), F.col("expected_all").cast("double"))
    f2 = F.try_divide(F.col("actual_to").cast("double"), F.col("actual_all").cast("double"))
    return F.max(F.abs(f1 - f2)).alias("ks_stat")


def _sample_sizes() -> list[Column]:
    return [F.max("expected_all").alias("n_expected"), F.max("actual_all").alias("n_actual")]


def _p_value(exact_rows: int) -> dict[str, Column]:
    """Columns ``p_value`` and ``method`` of rows with ks_stat and sample sizes; one row for each feature."""
    sizes = [F.col("n_expected"), F.col("n_actual")]
    few = F.greatest(*sizes) <= exact_rows
    distance = F.when(few, F.col("ks_stat"))  # null, and so no recurrence, for larger samples
    exact = st.exact_p_value(distance, *sizes)
    return {
        "p_value": F.when(few, exact).otherwise(st.kolmogorov_p_value(F.col("ks_stat"), *sizes)),
        "method": F.when(few, "exact").otherwise("asymptotic"),
    }


def ks_statistic(totals: DataFrame, exact_rows: int = EXACT_ROWS) -> DataFrame:
    """Largest distance of the two empirical distributions, its p-value and the ``method`` of that: ``exact`` where both
    samples have at most ``exact_rows`` rows, else ``asymptotic``."""
    widest = totals.groupBy("feature").agg(_widest_gap(), *_sample_sizes())
    return widest.withColumns(_p_value(exact_rows))


def quantile_edges(totals: DataFrame, measure: str = "expected", bins: int = 10) -> DataFrame:
    """Sorted array of ``bins + 1`` percentile edges per feature."""
    probabilities = [i * (100.0 / bins) / 100.0 for i in range(bins + 1)]
    cuts = percentiles(totals, ["feature"], "value", measure, probabilities, beside=["expected", "actual"])
    return cuts.groupBy("feature").agg(F.sort_array(F.collect_list("percentile")).alias("edges"))


def quantile_bin(value: Column, edges: Column, bins: int = 10) -> Column:
    """Last bin whose lower edge is at most the value; NULL outside the edges."""
    reached = F.size(F.filter(edges, lambda e: e <= value)) - 1
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, -1))
    return F.when(inside, F.least(reached, F.lit(bins - 1)))


def _with_quantile_bins(totals: DataFrame, bins: int) -> DataFrame:
    """The edges are one array of ``bins + 1`` numbers per feature column, whatever the data, so
    they are broadcast to the collapsed values; raw rows are not read again."""
    edges = F.broadcast(quantile_edges(totals, bins=bins))
    return totals.join(edges, "feature").withColumn(
        "bin", quantile_bin(F.col("value"), F.col("edges"), bins)
    )


def _quantile_counts(bins: int) -> list[Column]:
    return [
        st.histogram_counts(F.col("bin"), F.col("expected"), bins).alias("e"),
        st.histogram_counts(F.col("bin"), F.col("actual"), bins).alias("a"),
    ]


def _quantile_index() -> Column:
    return st.stability_index(
        F.col("e"), F.col("n_expected"), F.col("a"), F.col("n_actual"), floor=fv.QUANTILE_SHARE_FLOOR
    )


def quantile_psi(totals: DataFrame, bins: int = 10) -> DataFrame:
    """PSI on the expected sample's quantile bins, per feature."""
    counted = _with_quantile_bins(totals, bins).groupBy("feature").agg(
        *_quantile_counts(bins), *_sample_sizes()
    )
    return counted.select("feature", _quantile_index().alias("psi"))


def drift_table(
    rows: DataFrame,
    features: list[str],
    sample: str = "split",
    expected: str = "train",
    actual: str = "oot",
    max_p: float = 0.05,
    max_psi: float = 0.1,
    bins: int = 10,
    exact_rows: int = EXACT_ROWS,
) -> DataFrame:
    """KS, p-value, quantile PSI and drift flag for every feature, in one aggregate."""
    totals = value_totals(rows, sample, expected, actual, features)
    counted = _with_quantile_bins(totals, bins).groupBy("feature").agg(
        _widest_gap(), *_quantile_counts(bins), *_sample_sizes()
    )
    both = counted.withColumns(_p_value(exact_rows)).select("feature", "ks_stat", "p_value", _quantile_index().alias("psi"))
    flagged = F.coalesce(F.col("p_value") < max_p, F.lit(False)) | F.coalesce(
        F.col("psi") > max_psi, F.lit(False)
    )
    return both.withColumn("drift_detected", flagged)


def top_drifted(drift: DataFrame, limit: int = 15) -> DataFrame:
    """The drifted features with the greatest PSI: a top-k report."""
    return drift.where("drift_detected").orderBy(F.desc("psi"), "feature").limit(limit)


def drift_summary(drift: DataFrame) -> DataFrame:
    return drift.agg(
        F.count(F.lit(1)).alias("features"),
        F.count_if("drift_detected").alias("drifted"),
        (F.avg(F.col("drift_detected").cast("double")) * 100.0).alias("drifted_pct"),
    )


def exact_percentiles(
    rows: DataFrame, features: list[str], probabilities: list[float] = QUARTILES
) -> DataFrame:
    """Exact percentiles per feature: (feature, position, percentile)."""
    long = unpivot_features(rows, [], features)
    counts = long.groupBy("feature", "value").agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(counts, ["feature"], "value", ["n"])
    return percentiles(totals, ["feature"], "value", "n", probabilities)


def baseline_statistics(rows: DataFrame, features: list[str]) -> DataFrame:
    """Mean, sample standard deviation, extremes and quartiles per feature."""
    def moments_of(feature: str) -> Column:
        raw = F.col(f"`{feature}`").cast("double")
        value = F.when(usable(raw), raw)
        return F.struct(
            F.lit(feature).alias("feature"),
            F.avg(value).alias("mean"),
            F.stddev_samp(value).alias("std"),
            F.min(value).alias("min"),
            F.max(value).alias("max"),
        )

    # One wide aggregate: the rows are not multiplied by the number of features.
    wide_moments = rows.agg(*[moments_of(f).alias(f"m{i}") for i, f in enumerate(features)])
    moments = wide_moments.select(F.inline(F.array(*[F.col(f"m{i}") for i in range(len(features))])))
    quartiles = exact_percentiles(rows, features, QUARTILES)
    wide = quartiles.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("position") == i, F.col("percentile"))).alias(name)
            for i, name in enumerate(["q25", "q50", "q75"])
        ]
    )
    return moments.join(wide, "feature")
