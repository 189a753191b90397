"""Correlations, regressions, histograms, box summaries and analysis of variance."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators.orderstats import LINEAR, QUARTILES, UPPER, join_on_keys, order_statistics
from tillage.operators.profile import YIELD
from tillage.session import materialize

# the functions of the tasks travel with the job: executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def pearson(x: str, y: str) -> Column:
    """Pearson correlation over the rows that hold both values; missing where one does not vary
    (the built-in function divides by zero there)."""
    spread = F.sqrt(F.regr_sxx(F.col(y), F.col(x)) * F.regr_syy(F.col(y), F.col(x)))
    return F.try_divide(F.regr_sxy(F.col(y), F.col(x)), spread)


def gram(df: DataFrame, columns: list[str]) -> DataFrame:
    """Sums of products of all pairs of columns, from one pass: i, j (i < j), n, and of the rows that
    hold both values the sums x, y, xx, yy and xy of the values less a fixed number per column.

    A task adds up one small matrix per sum for all its rows; the matrices are merged by cell. The
    fixed numbers, a row's values, keep the sums small, so little is lost to rounding.
    """
    numbers = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in columns])
    first = numbers.agg(*[F.first(c, ignorenulls=True).alias(c) for c in columns]).first()
    centre = np.array([v or 0.0 for v in first], float)
    size = len(columns)

    def add(batches):
        total = np.zeros((4, size, size))
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(size)], 1)
            known = ~np.isnan(x)
            x, held = np.where(known, x - centre, 0.0), known.astype(float)
            total += np.stack([held.T @ held, x.T @ held, (x * x).T @ held, x.T @ x])
        i, j = np.triu_indices(size, 1)
        sums = [total[0][i, j], total[1][i, j], total[1][j, i], total[2][i, j], total[2][j, i], total[3][i, j]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, *sums)], names=["i", "j", "n", "x", "y", "xx", "yy", "xy"])

    parts = numbers.mapInArrow(add, "i bigint, j bigint, n double, x double, y double, xx double, yy double, xy double")
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "x", "y", "xx", "yy", "xy")])


def correlations(df: DataFrame, columns: list[str], full: bool = True) -> DataFrame:
    """Pairwise-complete Pearson correlations of all columns, long form, from one pass.

    ``full`` gives the whole matrix, otherwise the part below the diagonal.
    """
    n = F.col("n")
    spread = (F.col("xx") - F.try_divide(F.col("x") * F.col("x"), n)) * (F.col("yy") - F.try_divide(F.col("y") * F.col("y"), n))
    r = F.when(spread > 0, F.try_divide(F.col("xy") - F.try_divide(F.col("x") * F.col("y"), n), F.sqrt(spread)))
    # every pair has a row, also where no row holds both values
    pairs = df.sparkSession.createDataFrame([(i, j) for j in range(len(columns)) for i in range(j)], "i bigint, j bigint")
    found = pairs.join(gram(df, columns), ["i", "j"], "left").select("i", "j", r.alias("r"))
    names = F.array(*[F.lit(c) for c in columns])

    def cells(i, j):
        return found.select(names[F.col(i)].alias("row"), names[F.col(j)].alias("column"), F.col(i).alias("i"), F.col(j).alias("j"), "r")

    below = cells("j", "i")
    if not full:
        return below
    numbers = [(c, c, k, k, 1.0) for k, c in enumerate(columns)]
    diagonal = df.sparkSession.createDataFrame(numbers, "row string, column string, i bigint, j bigint, r double")
    mirror = F.array(F.struct("row", "column", "i", "j", "r"), F.struct(
        F.col("column").alias("row"), F.col("row").alias("column"), F.col("j").alias("i"), F.col("i").alias("j"), "r"))
    return below.select(F.inline(mirror)).unionByName(diagonal)


def target_correlations(df: DataFrame, columns: list[str], target: str = YIELD) -> DataFrame:
    """Correlation of each column with the target, by strength."""
    others = [c for c in columns if c != target]
    one = df.agg(*[pearson(c, target).alias(c) for c in others])
    out = one.unpivot([], others, "feature", "r")
    return out.withColumns(
        {"direction": F.when(F.col("r") > 0, "up").otherwise("down"), "strength": ag.strength_three("r")}
    ).orderBy(F.desc(F.abs("r")), "feature")


def pair_correlation(df: DataFrame, x: str, y: str) -> DataFrame:
    """r and r squared; 0 where a column does not vary."""
    r = F.coalesce(pearson(x, y), F.lit(0.0))
    return df.agg(F.count(F.when(F.col(x).isNotNull() & F.col(y).isNotNull(), 1)).alias("n"), r.alias("r"), (r * r).alias("r_squared"))


def _both(x, y) -> Column:
    return F.col(x).isNotNull() & F.col(y).isNotNull()


def trend_line(df: DataFrame, x: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """Least squares line with its end points at the smallest and largest x, per group."""
    rows = df.where(_both(x, y))
    line = rows.groupBy(*(keys or [])).agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
        F.count("*").alias("n"),
    )
    return line.withColumns(
        {
            "y_at_min": F.col("slope") * F.col("x_min") + F.col("intercept"),
            "y_at_max": F.col("slope") * F.col("x_max") + F.col("intercept"),
        }
    )


# Coefficients of a crop with too few rows.
WATER_DEFAULTS = {
    "slope": 5.0, "intercept": 2000.0, "r_squared": 0.0, "min_water": 100.0, "max_water": 400.0,
    "avg_yield": 3000.0,
}


def water_response(df: DataFrame, keys: list[str] | None = None, rain: str = "rainfall_mm", y: str = YIELD) -> DataFrame:
    """Yield over rain per crop: line, fit, 10 % and 90 % rain quantiles and mean yield."""
    keys = keys or ["crop_type"]
    fits = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        F.regr_slope(y, rain).alias("slope"),
        F.regr_intercept(y, rain).alias("intercept"),
        F.regr_r2(y, rain).alias("r_squared"),
        F.avg(y).alias("avg_yield"),
    )
    bounds = order_statistics(df, keys, rain, {"min_water": (0.1, LINEAR), "max_water": (0.9, LINEAR)})
    out = join_on_keys(fits, bounds, keys)
    enough = F.col("n") > 10
    return out.select(
        *keys, "n", *[F.when(enough, F.col(c)).otherwise(F.lit(v)).alias(c) for c, v in WATER_DEFAULTS.items()]
    )


def shape(df: DataFrame, column: str) -> DataFrame:
    """Population skewness and excess kurtosis; 0 where the column does not vary."""
    return df.agg(
        F.coalesce(F.skewness(column), F.lit(0.0)).alias("skewness"),
        F.coalesce(F.kurtosis(column), F.lit(0.0)).alias("kurtosis"),
    )


def histogram(df: DataFrame, column: str, bins: int = 30, density: bool = False) -> DataFrame:
    """Equal-width counts over [min, max]; the last bin is closed. Empty bins stay."""
    rows = df.select(F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())
    ends = rows.agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("*").alias("total"))
    ends = ends.where(F.col("total") > 0).withColumn("width", (F.col("hi") - F.col("lo")) / bins)
    # the ends are one row and the grid is one row per bin
    placed = rows.crossJoin(F.broadcast(ends))
    number = F.floor(F.try_divide(F.col("v") - F.col("lo"), F.col("width")))
    placed = placed.withColumn("bin", F.least(F.coalesce(number, F.lit(0)), F.lit(bins - 1)).cast("bigint"))
    counts = placed.groupBy("bin").agg(F.count("*").alias("n"))
    grid = ends.select("lo", "width", "total", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("b"))
    grid = grid.withColumn("bin", F.col("b").cast("bigint"))
    out = grid.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + F.col("bin") * F.col("width")).alias("start"),
        (F.col("lo") + (F.col("bin") + 1) * F.col("width")).alias("end"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
        "total",
        "width",
    )
    if density:
        out = out.withColumn("density", F.try_divide(F.col("n"), F.col("total") * F.col("width")))
    return out.drop("total", "width")


def _fences(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    boxes = order_statistics(df, keys, value, QUARTILES)
    iqr = F.col("q3") - F.col("q1")
    return boxes.withColumns({"lower_fence": F.col("q1") - 1.5 * iqr, "upper_fence": F.col("q3") + 1.5 * iqr})


def box_summary(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Quartiles, whisker ends inside the 1.5 IQR fences, and the number of outliers.

    Equal values of a group meet the fences once, with their count.
    """
    keys = keys or []
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__c"))
    fenced = join_on_keys(counts, _fences(df, value, keys), keys)
    v, lo, hi = F.col(value), F.col("lower_fence"), F.col("upper_fence")
    inside = v.between(lo, hi)
    return fenced.groupBy(*keys, "q1", "median", "q3", "lower_fence", "upper_fence").agg(
        F.min(F.when(inside, v)).alias("whisker_low"),
        F.max(F.when(inside, v)).alias("whisker_high"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col("__c"))).cast("bigint").alias("outliers"),
        F.sum("__c").alias("n"),
    )


def outliers(df: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """The rows beyond the fences. The fences are written first, so that their true size
    decides whether they are broadcast to the rows or joined by shuffle."""
    keys = keys or []
    fences = materialize(_fences(df, value, keys), "fences")
    fenced = join_on_keys(df.where(F.col(value).isNotNull()), fences, keys)
    return fenced.where(~F.col(value).between(F.col("lower_fence"), F.col("upper_fence"))).select(*df.columns)


def anova(df: DataFrame, key: str, metric: str) -> DataFrame:
    """One-way analysis of variance over the rows that hold a number."""
    g = F.coalesce(F.when(F.col(key) != "", F.col(key)), F.lit("Unknown"))
    rows = df.select(g.alias("g"), F.col(metric).cast("double").alias("v")).where(F.col("v").isNotNull())
    groups = rows.groupBy("g").agg(
        F.count("*").alias("n"), F.avg("v").alias("m"), (F.var_pop("v") * F.count("*")).alias("ssw")
    )
    overall = rows.agg(F.avg("v").alias("overall"))
    parts = groups.crossJoin(F.broadcast(overall))
    out = parts.agg(
        F.count("*").alias("groups"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.pow(F.col("m") - F.col("overall"), 2)).alias("ss_between"),
        F.sum("ssw").alias("ss_within"),
    )
    out = out.withColumns({"df_between": F.col("groups") - 1, "df_within": F.col("n") - F.col("groups")})
    f = F.try_divide(
        F.try_divide(F.col("ss_between"), F.col("df_between")), F.try_divide(F.col("ss_within"), F.col("df_within"))
    )
    return out.withColumn("f_value", f).withColumn("significant", F.col("f_value") > 3).drop("groups", "n")


def pair_statistics(df: DataFrame, x: str, y: str) -> DataFrame:
    """Chart statistics: correlation with its label, ranges and upper medians."""
    rows = df.where(_both(x, y))
    base = rows.agg(
        F.count("*").alias("n"),
        F.coalesce(pearson(x, y), F.lit(0.0)).alias("r"),
        F.min(x).alias("x_min"),
        F.max(x).alias("x_max"),
        F.min(y).alias("y_min"),
        F.max(y).alias("y_max"),
    ).withColumn("strength", ag.strength_four("r"))
    for c, name in ((x, "x_median"), (y, "y_median")):
        base = base.crossJoin(F.broadcast(order_statistics(rows, [], c, {name: (0.5, UPPER)})))
    return base
