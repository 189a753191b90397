"""Missing values, price series and their averages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tillage.functions import agronomy as ag
from tillage.operators.orderstats import LINEAR, mode_of, order_statistics
from tillage.operators.profile import long_form


# ---- daily series --------------------------------------------------------------------------------
# A window partition below is one series: one row per day, so its size is bounded by the calendar.


def _neighbours(series: str, order: str):
    w = W.partitionBy(series).orderBy(order)
    return w.rowsBetween(W.unboundedPreceding, W.currentRow), w.rowsBetween(W.currentRow, W.unboundedFollowing)


def interpolate(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    """Linear interpolation by row position, then the last value forward and the first back."""
    before, after = _neighbours(series, order)
    v = F.col(value)
    df = df.withColumn("__p", F.row_number().over(W.partitionBy(series).orderBy(order)))
    at = F.when(v.isNotNull(), F.struct(F.col("__p").alias("p"), v.alias("v")))
    df = df.withColumns({"__l": F.last(at, True).over(before), "__r": F.first(at, True).over(after)})
    left, right = F.col("__l"), F.col("__r")
    step = (right["v"] - left["v"]) / (right["p"] - left["p"])
    between = left["v"] + step * (F.col("__p") - left["p"])
    filled = F.coalesce(v, F.when(left.isNotNull() & right.isNotNull(), between), left["v"], right["v"])
    return df.withColumn(value, filled).drop("__p", "__l", "__r")


def fill_forward_back(df: DataFrame, series: str, order: str, value: str) -> DataFrame:
    before, after = _neighbours(series, order)
    filled = F.coalesce(F.last(value, True).over(before), F.first(value, True).over(after))
    return df.withColumn(value, filled)


def _by_series(df: DataFrame, order: str, columns: list[str], fill) -> DataFrame:
    """Apply a series job to the columns of a wide table: each column is its own partition."""
    rows = long_form(df, columns, [order])
    done = fill(rows, "variable", order, "value")
    wide = [F.max(F.when(F.col("variable") == c, F.col("value"))).alias(c) for c in columns]
    return done.groupBy(order).agg(*wide)


def interpolate_wide(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    return _by_series(df, order, columns, interpolate)


def fill_wide(df: DataFrame, order: str, columns: list[str]) -> DataFrame:
    return _by_series(df, order, columns, fill_forward_back)


# ---- fills by a statistic of the column --------------------------------------------------------------


def mean_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    means = df.agg(*[F.avg(c).alias(f"__m_{c}") for c in columns])
    return _fill_from(df, means, columns)


def medians(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row with the exact median of every column, as ``__m_<column>``."""
    stats = order_statistics(long_form(df, columns), ["variable"], "value", {"median": (0.5, LINEAR)})
    return stats.agg(*[F.max(F.when(F.col("variable") == c, F.col("median"))).alias(f"__m_{c}") for c in columns])


def median_fill(df: DataFrame, columns: list[str]) -> DataFrame:
    return _fill_from(df, medians(df, columns), columns) if columns else df


def mode_fill(df: DataFrame, columns: list[str], unknown: str = "Unknown") -> DataFrame:
    """Most frequent label (the smallest on a tie), or ``unknown`` where a column is empty."""
    if not columns:
        return df
    tops = mode_of(long_form(df, columns, cast="string"), ["variable"], "value")
    one = tops.agg(
        *[
            F.coalesce(F.max(F.when(F.col("variable") == c, F.col("top_value"))), F.lit(unknown)).alias(f"__m_{c}")
            for c in columns
        ]
    )
    return _fill_from(df, one, columns)


def _fill_from(df: DataFrame, one_row: DataFrame, columns: list[str]) -> DataFrame:
    # ``one_row`` is a global aggregate: exactly one row, whatever the data
    joined = df.crossJoin(F.broadcast(one_row))
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.col(f"__m_{c}")) for c in columns})
    return filled.select(*df.columns)


def drop_incomplete(df: DataFrame) -> DataFrame:
    return df.dropna()


def handle_missing(df: DataFrame, strategy: str = "interpolate", order: str = "date") -> DataFrame:
    """Fill or drop missing values of a wide daily table by a named strategy."""
    numbers = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    if strategy == "interpolate":
        return interpolate_wide(df, order, numbers)
    if strategy == "ffill":
        return fill_wide(df, order, numbers)
    if strategy == "mean":
        return mean_fill(df, numbers)
    if strategy == "drop":
        return drop_incomplete(df)
    return df


def missing_total(df: DataFrame, name: str) -> DataFrame:
    cells = F.lit(0)
    for c in df.columns:
        cells = cells + F.col(c).isNull().cast("int")
    return df.agg(
        F.lit(name).alias("strategy"),
        F.count("*").alias("n"),
        F.coalesce(F.sum(cells), F.lit(0)).cast("bigint").alias("missing"),
    )


def with_missing(df: DataFrame, columns: list[str]) -> list[str]:
    """The columns that miss a value: one aggregate, one row to the driver."""
    if not columns:
        return []
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    return [c for c in columns if row[c]]


def fill_lenient(df: DataFrame) -> DataFrame:
    """Median for numbers, most frequent label for text. Only columns that miss a value need either."""
    kinds = {f.name: f.dataType for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.StringType))}
    missing = with_missing(df, list(kinds))
    numbers = [c for c in missing if isinstance(kinds[c], T.NumericType)]
    labels = [c for c in missing if isinstance(kinds[c], T.StringType)]
    order = df.columns
    return mode_fill(median_fill(df, numbers), labels).select(*order)


# ---- prices ----------------------------------------------------------------------------------------------


def normalized_prices(df: DataFrame, commodities: list[str]) -> DataFrame:
    """Adds EUR per kg columns to cents per trading unit."""
    return df.withColumns(
        {
            f"{c}_EUR_PER_KG": ag.cents_to_eur_per_kg(c, ag.KG_PER_UNIT[c])
            for c in commodities
            if c in df.columns
        }
    )


def average_prices(prices: DataFrame, commodities: list[str], year: int = 2024, proxy: int = 2023) -> DataFrame:
    """One row of averages for the year, or for the proxy year when the year has no rows."""
    y = F.year("date")
    use_year = F.count_if(y == year) > 0
    cols = []
    for c in commodities:
        v = F.col(f"{c}_EUR_PER_KG")
        cols.append(
            F.when(use_year, F.avg(F.when(y == year, v))).otherwise(F.avg(F.when(y == proxy, v))).alias(c)
        )
    return prices.agg(*cols)


def average_prices_long(prices: DataFrame, commodities: list[str], year: int = 2024, proxy: int = 2023) -> DataFrame:
    one = average_prices(prices, commodities, year, proxy)
    return one.unpivot([], commodities, "commodity", "avg_price")


def day_spine(df: DataFrame, date: str = "date") -> DataFrame:
    """Every calendar day between the first and the last date."""
    ends = df.agg(F.min(date).alias("a"), F.max(date).alias("b")).where(F.col("a").isNotNull())
    return ends.select(F.explode(F.sequence("a", "b")).alias("date"))


def seasonal_series(df: DataFrame, date: str = "date") -> DataFrame:
    """Daily baseline price of rice over the calendar of the given series."""
    return day_spine(df, date).select("date", ag.seasonal_price("date").alias("RICE_EUR_PER_KG"))
