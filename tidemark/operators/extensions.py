"""Two stricter readings of the bundle steps; no plan uses them unless asked."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import ColumnLike, as_column
from .scale import skew_join


def ordered_before(first_a: ColumnLike, first_b: ColumnLike) -> Column:
    """1 if a happened and b did not happen earlier (or never happened)."""
    a, b = as_column(first_a), as_column(first_b)
    return F.when(a.isNotNull() & F.coalesce(a <= b, F.lit(True)), 1).otherwise(0)


def dose_per_kg(
    doses: DataFrame,
    weights: DataFrame,
    keys: Sequence[str],
    dose: str,
    weight: str,
    threshold: float,
) -> DataFrame:
    """Total dose per kg of body weight for each key, and whether it reaches the threshold.

    Doses are summed before they meet the weights, so a key with very many doses
    reaches the join as one row. ``weights`` has one row per key.
    """
    total = doses.groupBy(*keys).agg(F.sum(dose).alias("total_dose"))
    ratio = F.col("total_dose") / F.when(F.col(weight) > 0, F.col(weight))
    return (
        skew_join(total, weights.select(*keys, weight), keys)
        .withColumn("dose_per_kg", ratio)
        .withColumn("dose_reached", F.when(ratio >= threshold, 1).otherwise(0))
    )
