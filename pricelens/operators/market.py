"""Per-type percentile trim and market statistics.

The percentiles are exact and never gather a type's prices in one task. A price
is first counted into coarse, order-preserving buckets (a plain partial
aggregation). Running counts over the buckets tell which bucket holds each
wanted order statistic; only that bucket is looked at again, cut finer until
it is small, and finally sorted. A product type that holds a third of all rows
costs the same few narrow scans as any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .joins import lookup_join

LOWER, UPPER = 0.10, 0.90
# Buckets per unit of ln(1 + |price|), and cuts of a bucket per refinement round.
_LOG_BUCKETS = 64
_CUTS = 1024
# A bucket with at most this many distinct-price rows may be sorted by one task.
SORT_LIMIT = 1_000_000
# Each round divides a bucket's price range by _CUTS; the first buckets span 1.6 %
# of a price. After four rounds fewer than 200 distinct doubles fit into one.
_MAX_ROUNDS = 4


def _log_bucket(value: Column) -> Column:
    """Monotone in value, for either sign."""
    return F.floor(F.signum(value) * F.log1p(F.abs(value)) * F.lit(_LOG_BUCKETS))


def _histogram(rows: DataFrame, keys: list[str], bucket: Column) -> DataFrame:
    return rows.groupBy(*keys, bucket.alias("_bucket")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi")
    )


def _running(keys: list[str], order: str):
    """Running count before each bucket and the next bucket's smallest value."""
    window = Window.partitionBy(*keys).orderBy(order)
    before = F.coalesce(
        F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    return window, before


def _first_targets(rows: DataFrame, key: str, probabilities: list[float]) -> DataFrame:
    """One row per type and probability: the bucket that holds its lower order statistic."""
    window, before = _running([key], "_bucket")
    total = F.sum("_n").over(Window.partitionBy(key))
    counted = (
        _histogram(rows, [key], _log_bucket(F.col("_v")))
        .withColumns({
            "_before": before, "_total": total, "_next": F.lead("_lo").over(window),
        })
        .withColumn("_p", F.explode(F.array(*[F.lit(float(p)) for p in probabilities])))
        .withColumn("_position", F.col("_p") * (F.col("_total") - 1))
        .withColumn("_rank", F.floor("_position"))
    )
    return counted.filter(
        (F.col("_rank") >= F.col("_before")) & (F.col("_rank") < F.col("_before") + F.col("_n"))
    ).select(key, "_p", "_position", "_rank", "_before", "_n", "_lo", "_hi", "_next")


def _inside(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Rows that lie in a target's bucket: one or two targets per key."""
    wanted = targets.select(
        key, "_p", "_position", "_rank", "_before",
        F.col("_lo").alias("_from"), F.col("_hi").alias("_to"), F.col("_next").alias("_after"),
    )
    return lookup_join(rows, wanted, [key]).filter(F.col("_v").between(F.col("_from"), F.col("_to")))


_STATE = ["_p", "_position", "_rank", "_before", "_after"]


def _refined(rows: DataFrame, targets: DataFrame, key: str) -> DataFrame:
    """Cut each target bucket into equal price ranges and keep the one with the rank."""
    inside = _inside(rows, targets, key)
    width = F.col("_to") - F.col("_from")
    cut = F.floor(F.coalesce(F.try_divide(F.col("_v") - F.col("_from"), width), F.lit(0.0)) * _CUTS)
    keys = [key, *_STATE]
    window, before = _running([key, "_p"], "_bucket")
    counted = _histogram(inside, keys, cut).withColumns({
        "_start": F.col("_before") + before,
        "_next": F.coalesce(F.lead("_lo").over(window), F.col("_after")),
    })
    return counted.filter(
        (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n"))
    ).select(
        key, "_p", "_position", "_rank", F.col("_start").alias("_before"), "_n", "_lo", "_hi",
        "_next",
    )


def percentile_bounds(
    df: DataFrame,
    value: str,
    key: str = "type_of_product",
    lower: float = LOWER,
    upper: float = UPPER,
    sort_limit: int = SORT_LIMIT,
) -> DataFrame:
    """Exact per-key percentiles with linear interpolation.

    Returns ``key, lower_bound, upper_bound`` as a written table (one row per
    key). Rows without key or value take no part. ``df`` is read two times or
    more: pass a written table, not a plan that joins or parses.
    """
    rows = df.select(F.col(key), F.col(value).alias("_v")).filter(
        F.col(key).isNotNull() & F.col("_v").isNotNull() & ~F.isnan("_v")
    )
    targets = materialize(_first_targets(rows, key, [lower, upper]), "targets")
    for _ in range(_MAX_ROUNDS):
        # A bucket of one value needs no cutting, however often it occurs.
        largest = targets.filter("_lo < _hi").agg(F.max("_n")).first()[0]
        if largest is None or largest <= sort_limit:
            break
        targets = materialize(_refined(rows, targets, key), "targets")

    keys = [key, *_STATE]
    equal = _inside(rows, targets, key).groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    window, before = _running([key, "_p"], "_v")
    ranked = equal.withColumns({
        "_start": F.col("_before") + before,
        "_higher": F.coalesce(F.lead("_v").over(window), F.col("_after"), F.col("_v")),
    }).filter(
        (F.col("_rank") >= F.col("_start")) & (F.col("_rank") < F.col("_start") + F.col("_n"))
    )
    next_value = F.when(F.col("_rank") + 1 < F.col("_start") + F.col("_n"), F.col("_v")).otherwise(
        F.col("_higher")
    )
    quantile = F.col("_v") + (next_value - F.col("_v")) * (F.col("_position") - F.col("_rank"))
    bounds = ranked.groupBy(key).agg(
        F.max(F.when(F.col("_p") == float(lower), quantile)).alias("lower_bound"),
        F.max(F.when(F.col("_p") == float(upper), quantile)).alias("upper_bound"),
    )
    return materialize(bounds, "bounds")


def trim_outliers(
    df: DataFrame,
    value: str,
    key: str = "type_of_product",
    lower: float = LOWER,
    upper: float = UPPER,
    bounds: DataFrame | None = None,
) -> DataFrame:
    """Keep rows whose value lies within its type's percentile bounds, ends included."""
    if bounds is None:
        bounds = percentile_bounds(df, value, key, lower, upper)
    return (
        lookup_join(df, bounds, [key])
        .filter(F.col(value).between(F.col("lower_bound"), F.col("upper_bound")))
        .drop("lower_bound", "upper_bound")
    )


def market_stats(df: DataFrame, value: str, key: str = "type_of_product") -> DataFrame:
    """Smallest and largest price and the number of priced offers per type."""
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.min(value).alias("market_min"),
            F.max(value).alias("market_max"),
            F.count(value).alias("competitor_count"),
        )
    )


def known_types(*tables: DataFrame, key: str = "type_of_product") -> DataFrame:
    """Distinct product types over all given tables."""
    result = tables[0].select(key).distinct()
    for table in tables[1:]:
        result = result.union(table.select(key).distinct())
    return result.distinct()
