"""Water allocation under a budget, for any number of scenarios at once.

Maximising a sum of straight lines under one budget and a lower and upper bound per crop is
the fractional knapsack problem: everyone gets the minimum, then the steepest lines are
filled first. That is a running sum over the crops of a scenario.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def allocate(coefficients: DataFrame, budget: str, crop: str = "crop_type", scenario: list[str] | None = None) -> DataFrame:
    """Adds water, expected_yield and status to rows of slope, intercept, min_water, max_water.

    ``budget`` is a column of the row's scenario. A window partition is one scenario, with one
    row per crop.
    """
    group = W.partitionBy(*scenario) if scenario else W.partitionBy(F.lit(0))
    by_slope = group.orderBy(F.desc("slope"), crop).rowsBetween(W.unboundedPreceding, -1)
    room = F.when(F.col("slope") > 0, F.col("max_water") - F.col("min_water")).otherwise(F.lit(0.0))
    df = coefficients.withColumns({"__base": F.sum("min_water").over(group), "__room": room})
    df = df.withColumn("__prior", F.coalesce(F.sum("__room").over(by_slope), F.lit(0.0)))
    rest = F.col(budget) - F.col("__base")
    extra = F.least(F.col("__room"), F.greatest(F.lit(0.0), rest - F.col("__prior")))
    feasible = F.col("__base") <= F.col(budget)
    df = df.withColumns(
        {
            "status": F.when(feasible, "Optimal").otherwise("Infeasible"),
            "water": F.when(feasible, F.col("min_water") + extra),
        }
    )
    df = df.withColumn("expected_yield", F.col("slope") * F.col("water") + F.col("intercept"))
    return df.drop("__base", "__room", "__prior")


def efficiency(allocation: DataFrame) -> DataFrame:
    ratio = F.when(F.col("water") > 0, F.col("expected_yield") / F.col("water")).when(F.col("water").isNotNull(), 0.0)
    return allocation.withColumn("efficiency", ratio)


def totals(allocation: DataFrame, budget: str, scenario: list[str] | None = None) -> DataFrame:
    """Status, water used and saved, and total expected yield per scenario."""
    return allocation.groupBy(*(scenario or []), "status", budget).agg(
        F.sum("water").alias("total_water_used"),
        (F.first(budget) - F.sum("water")).alias("water_saved"),
        F.sum("expected_yield").alias("total_expected_yield"),
    )
