"""Filters, searches, pages and samples of the farm table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillage.operators.profile import YIELD, distinct_counts, long_form

# Quick filters as (min, max) of the yield.
PRESETS = {"high_yield": (5000.0, None), "low_yield": (None, 2000.0), "optimal": (3000.0, 7000.0)}


def by_equality(df: DataFrame, **wanted) -> DataFrame:
    """Equality on each given column; an empty or missing parameter is no predicate."""
    for column, value in wanted.items():
        if value is not None and value != "":
            df = df.where(F.col(column) == F.lit(value))
    return df


def _bound(value):
    try:
        return None if value in (None, "") else float(value)
    except (TypeError, ValueError):
        return None


def by_range(df: DataFrame, column: str, low=None, high=None) -> DataFrame:
    """Closed range; a bound that is empty, zero or not a number is ignored."""
    low, high = _bound(low), _bound(high)
    if low:
        df = df.where(F.col(column) >= low)
    if high:
        df = df.where(F.col(column) <= high)
    return df


def dashboard_filter(df: DataFrame, region=None, crop_type=None, irrigation_type=None, min_yield=None, max_yield=None):
    df = by_equality(df, region=region, crop_type=crop_type, irrigation_type=irrigation_type)
    return by_range(df, YIELD, min_yield, max_yield)


def preset(df: DataFrame, name: str) -> DataFrame:
    low, high = PRESETS[name]
    return by_range(df, YIELD, low, high)


def count_and_mean(df: DataFrame) -> DataFrame:
    """Rows and mean yield of all matches; the mean of nothing is 0."""
    return df.agg(
        F.count("*").alias("total_records"), F.coalesce(F.avg(YIELD), F.lit(0.0)).alias("average_yield")
    )


def explorer_summary(df: DataFrame) -> DataFrame:
    totals = df.agg(F.count("*").alias("total_records"), F.coalesce(F.avg(YIELD), F.lit(0.0)).alias("avg_yield"))
    unique = distinct_counts(df, ["crop_type", "region"]).agg(
        *[
            F.coalesce(
                F.max(F.when(F.col("variable") == c, F.col("unique_values"))), F.lit(0).cast("bigint")
            ).alias(name)
            for c, name in (("crop_type", "unique_crops"), ("region", "unique_regions"))
        ]
    )
    return totals.crossJoin(F.broadcast(unique))


def first_rows(df: DataFrame, n: int, *order: str) -> DataFrame:
    return df.orderBy(*order).limit(n)


def page(df: DataFrame, number: int, size: int, *order: str) -> DataFrame:
    """Rows [(number - 1) * size, number * size) in the given order."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_count(df: DataFrame, size: int) -> DataFrame:
    rows = F.count("*")
    return df.agg(rows.alias("total_records"), F.ceil(rows / size).cast("bigint").alias("total_pages"))


def shown(column: Column, data_type: T.DataType) -> Column:
    """A value as the page prints it; missing, empty and zero values print nothing."""
    if isinstance(data_type, T.NumericType):
        text = F.regexp_replace(column.cast("string"), r"\.0$", "")
        return F.when(column != 0, text)
    text = column.cast("string")
    return F.when(text != "", text)


def search(df: DataFrame, term: str, columns: list[str] | None = None) -> DataFrame:
    """Rows where any column contains the term, in any letter case."""
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    cells = F.array(*[shown(F.col(f.name), f.dataType) for f in fields])
    needle = term.lower()
    return df.where(F.exists(cells, lambda x: F.coalesce(F.lower(x).contains(needle), F.lit(False))))


def range_warnings(df: DataFrame, specs: list[tuple], column: str = YIELD) -> DataFrame:
    """Check filter bounds against the range of the data.

    ``specs`` holds (name, low, high); a missing bound counts as 0 or as no limit.
    """
    spec = df.sparkSession.createDataFrame(specs, "name string, low double, high double")
    ends = df.agg(F.min(column).alias("data_min"), F.max(column).alias("data_max"))
    low = F.coalesce("low", F.lit(0.0))
    high = F.coalesce("high", F.lit(float("inf")))
    bounded = F.col("high").isNotNull()
    return spec.crossJoin(F.broadcast(ends)).select(
        "name",
        (low > high).alias("inverted"),
        ((low > 0) & (low < F.col("data_min") * 0.5)).alias("very_low_min"),
        (bounded & (high > F.col("data_max") * 1.5)).alias("very_high_max"),
        ((low > 0) & bounded & ((high - low) < 100)).alias("very_narrow"),
    )


def options(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct choices of every filter list in one pass."""
    return (
        long_form(df, columns, cast="string")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("variable", "value")
    )


def not_in_domain(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Rows outside the domain; a missing value is outside."""
    return df.where(~F.coalesce(F.col(column).isin(domain), F.lit(False)))


def renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(a).alias(b) for a, b in names.items() if a in df.columns])


def valid_pairs(df: DataFrame, x: str, y: str) -> DataFrame:
    """Rows where both columns hold a number."""
    return df.where(
        F.expr(f"try_cast(`{x}` AS double)").isNotNull() & F.expr(f"try_cast(`{y}` AS double)").isNotNull()
    )


def seeded_order(columns: list[str], seed: int = 42) -> Column:
    """A reproducible pseudo-random order of the rows, equal on any partitioning."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns]))


def seeded_sample(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """The n first rows in the seeded order (all rows when there are fewer)."""
    return df.orderBy(seeded_order(key, seed), *key).limit(n)
