"""Descriptive aggregates: KPIs, group statistics, distributions, time series, pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from tillage.functions import agronomy as ag
from tillage.operators.orderstats import (
    LINEAR,
    QUARTILES,
    UPPER,
    join_on_keys,
    mode_of,
    order_statistics,
)
from tillage.session import materialize

YIELD = "yield_kg_per_hectare"


def rounded(df: DataFrame, digits: int = 4, *skip: str) -> DataFrame:
    """Round every double column once, at the edge."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType) and f.name not in skip
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def long_form(df: DataFrame, columns: list[str], keys: list[str] | None = None, cast: str = "double") -> DataFrame:
    """One row per (row, column): variable and value."""
    keys = keys or []
    return df.select(*keys, *[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(
        keys, columns, "variable", "value"
    )


def group_stats(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """The one-pass grouped aggregate; combines before the shuffle."""
    return df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns by declared type."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def existing(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


# ---- KPIs -------------------------------------------------------------------------------------


def home_kpis(df: DataFrame) -> DataFrame:
    # two distinct counts in one aggregate would double the rows; the distinct values of
    # both columns come out of one counting pass instead
    totals = df.agg(
        F.count("*").alias("total_farms"),
        F.avg(YIELD).alias("avg_yield"),
        F.max(YIELD).alias("max_yield"),
        F.min(YIELD).alias("min_yield"),
    )
    distinct = distinct_counts(df, ["crop_type", "region"]).agg(
        F.max(F.when(F.col("variable") == "crop_type", F.col("unique_values"))).alias("total_crops"),
        F.max(F.when(F.col("variable") == "region", F.col("unique_values"))).alias("total_regions"),
    )
    return rounded(totals.crossJoin(F.broadcast(distinct)), 2)


def distinct_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-missing values per column: duplicates collapse before the shuffle."""
    return (
        long_form(df, columns, cast="string")
        .where(F.col("value").isNotNull())
        .distinct()
        .groupBy("variable")
        .agg(F.count("*").alias("unique_values"))
    )


def yield_statistics(df: DataFrame, value: str = YIELD, quartiles: bool = False) -> DataFrame:
    return grouped_summary(df, [], value, quartiles)


def counted(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The mergeable summary behind moments, quantiles and modes: each group's values with their number,
    collapsed where they were read and written once. Whatever is asked next reads only this."""
    return materialize(df.groupBy(*keys, F.col(value).alias("__value")).agg(F.count("*").alias("__times")), "counted")


def moments(summary: DataFrame, keys: list[str]) -> DataFrame:
    """n, mean, std (sample), min and max per group of a ``counted`` table. The squares are those of
    the distances from the mean, so large numbers lose nothing."""
    v, n = F.col("__value").cast("double"), F.when(F.col("__value").isNotNull(), F.col("__times")).otherwise(0)
    first = summary.groupBy(*keys).agg(
        F.sum("__times").alias("n"), F.sum(n).alias("__n"), (F.try_divide(F.sum(v * n), F.sum(n))).alias("mean"),
        F.min("__value").alias("min"), F.max("__value").alias("max"))
    away = join_on_keys(summary, first.select(*keys, "mean", "__n"), keys)
    squares = away.groupBy(*keys).agg(
        F.when(F.max("__n") > 1, F.sqrt(F.sum((v - F.col("mean")) * (v - F.col("mean")) * n) / (F.max("__n") - 1))).alias("std"))
    return join_on_keys(first, squares, keys).select(*keys, "n", "mean", "std", "min", "max")


def grouped_summary(df: DataFrame, keys: list[str], value: str = YIELD, quartiles: bool = True) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quantiles per group, in one scan of ``df``."""
    wanted = QUARTILES if quartiles else {"median": (0.5, LINEAR)}
    return summarised(counted(df, keys, value), keys, wanted)


def summarised(summary: DataFrame, keys: list[str], wanted: dict) -> DataFrame:
    found = order_statistics(summary, keys, "__value", wanted, weight="__times")
    return join_on_keys(moments(summary, keys), found, keys)


def top_values(df: DataFrame, columns: list[str], k: int = 10) -> DataFrame:
    """Most frequent values per column with the number of distinct values."""
    counts = (
        long_form(df, columns, cast="string")
        .where(F.col("value").isNotNull())
        .groupBy("variable", "value")
        .agg(F.count("*").alias("n"))
    )
    unique = counts.groupBy("variable").agg(F.count("*").alias("unique_values"))
    order = W.partitionBy("variable").orderBy(F.desc("n"), "value")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return join_on_keys(top, unique, ["variable"]).withColumn("rank", F.col("rank").cast("bigint"))


def null_counts(df: DataFrame) -> DataFrame:
    """Column, declared type, rows and missing values: one aggregate over all columns."""
    one = df.agg(
        F.count("*").alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.lit(t).alias("data_type"), F.col(c).alias("missing"))
            for c, t in df.dtypes
        ]
    )
    return one.select(F.col("__rows").alias("total_records"), F.inline(rows))


def missing_report(df: DataFrame) -> DataFrame:
    """Columns with missing values, count and percent."""
    counts = null_counts(df).where(F.col("missing") > 0)
    share = F.round(F.col("missing") / F.col("total_records") * 100, 2)
    return counts.select("column", "missing", share.alias("missing_pct"))


# ---- group tables -----------------------------------------------------------------------------


def distribution(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def top_per_group(df: DataFrame, group: str | None, member: str, k: int, value: str = YIELD) -> DataFrame:
    """The k members with the highest mean, per group or overall."""
    keys = [group] if group else []
    means = df.groupBy(*keys, member).agg(F.avg(value).alias("mean"))
    if not group:
        return means.orderBy(F.desc("mean"), member).limit(k)
    order = W.partitionBy(group).orderBy(F.desc("mean"), member)
    return means.withColumn("rank", F.row_number().over(order).cast("bigint")).where(F.col("rank") <= k)


def best_group(df: DataFrame, key: str, value: str = YIELD) -> DataFrame:
    """Group with the highest mean; the first name wins a tie."""
    means = df.groupBy(key).agg(F.avg(value).alias("mean"))
    best = F.min(F.struct((-F.col("mean")).alias("neg"), F.col(key).alias("name")))
    return means.agg(best.alias("b")).select(
        F.lit(key).alias("dimension"), F.col("b.name").alias("best"), (-F.col("b.neg")).alias("mean")
    )


def severity_impact(df: DataFrame, status: str = "crop_disease_status") -> DataFrame:
    stats = df.groupBy(status).agg(
        F.avg(YIELD).alias("mean"), F.stddev_samp(YIELD).alias("std"), F.count("*").alias("n")
    )
    return stats.withColumn("severity", ag.severity_rank(status).cast("bigint")).orderBy("severity", status)


BROWSER_SEVERITY = ["No Disease", "No disease", "Healthy", "Mild", "Moderate", "Severe", "Unknown"]


def positive_impact(df: DataFrame, status: str = "crop_disease_status") -> DataFrame:
    """Disease impact over positive yields; missing status is Unknown, unknown ones come last."""
    s = F.coalesce(F.when(F.col(status) != "", F.col(status)), F.lit("Unknown"))
    stats = df.where(F.col(YIELD) > 0).groupBy(s.alias(status)).agg(
        F.avg(YIELD).alias("mean"), F.count("*").alias("n")
    )
    place = F.coalesce(ag.severity_rank(status, BROWSER_SEVERITY).cast("bigint"), F.lit(999).cast("bigint"))
    return stats.withColumn("place", place).orderBy("place", status)


def climate_impact(df: DataFrame) -> DataFrame:
    """Mean yield per temperature and moisture bucket; an empty bucket stays, without mean."""
    valid = df.where(
        ((F.coalesce("temperature_C", F.lit(0.0)) > 0) | (F.coalesce("soil_moisture_pct", F.lit(0.0)) > 0))
        & (F.col(YIELD) > 0)
    )
    pairs = F.array(
        F.struct(F.lit("temperature").alias("factor"), ag.temperature_bucket().alias("bucket")),
        F.struct(F.lit("moisture").alias("factor"), ag.moisture_bucket().alias("bucket")),
    )
    stats = (
        valid.select(YIELD, F.inline(pairs))
        .where(F.col("bucket").isNotNull())
        .groupBy("factor", "bucket")
        .agg(F.avg(YIELD).alias("mean"), F.count("*").alias("n"))
    )
    labels = [("temperature", b) for b in ag.TEMPERATURE_BUCKETS] + [("moisture", b) for b in ag.MOISTURE_BUCKETS]
    grid = df.sparkSession.createDataFrame(labels, "factor string, bucket string")
    return grid.join(stats, ["factor", "bucket"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def loss_from_disease(df: DataFrame, healthy="No Disease", severe="Severe") -> DataFrame:
    status = F.col("crop_disease_status")
    means = df.agg(
        F.avg(F.when(status == healthy, F.col(YIELD))).alias("healthy_yield"),
        F.avg(F.when(status == severe, F.col(YIELD))).alias("severe_yield"),
    )
    loss = F.try_divide(F.col("healthy_yield") - F.col("severe_yield"), F.col("healthy_yield")) * 100
    return means.withColumn("yield_loss_pct", loss)


def rate_by_group(df: DataFrame, key: str, condition: Column) -> DataFrame:
    """Share of matching rows per group in percent; a group without a match has no rate."""
    stats = df.groupBy(key).agg(F.count_if(condition).alias("hits"), F.count("*").alias("n"))
    return stats.withColumn("rate_pct", F.when(F.col("hits") > 0, F.col("hits") / F.col("n") * 100))


def date_ranges(df: DataFrame, columns: list[str]) -> DataFrame:
    one = df.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("min", F.min), ("max", F.max))])

    def text(c):
        return F.coalesce(F.date_format(F.col(c), "yyyy-MM-dd"), F.lit("N/A"))

    rows = [
        F.struct(F.lit(c).alias("column"), text(f"{c}_min").alias("first"), text(f"{c}_max").alias("last"))
        for c in columns
    ]
    return one.select(F.inline(F.array(*rows)))


def top_share(df: DataFrame, member: str, k: int = 5, value: str = YIELD) -> DataFrame:
    """Best members by mean, each with its percent of the overall maximum."""
    top = top_per_group(df, None, member, k, value).withColumn("mean", F.round("mean", 2))
    peak = df.agg(F.round(F.max(value), 2).alias("max_value"))
    share = F.coalesce(F.try_divide(F.col("mean"), F.col("max_value")) * 100, F.lit(0.0))
    return top.crossJoin(F.broadcast(peak)).select(member, "mean", share.alias("share_pct"))


# ---- tables of many variables --------------------------------------------------------------------


def upper_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, population deviation, extremes and non-interpolated quartiles per variable."""
    rows = long_form(df, existing(df, columns)).where(F.col("value").isNotNull() & ~F.isnan("value"))
    moments = rows.groupBy("variable").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    picks = {"q1": (0.25, UPPER), "median": (0.5, UPPER), "q3": (0.75, UPPER)}
    return join_on_keys(moments, order_statistics(rows, ["variable"], "value", picks), ["variable"])


def describe(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and interpolated quartiles per variable."""
    # the long form has many rows per variable and few values: it is counted once, the plain means come
    # from the columns themselves
    rows = long_form(df, columns).where(F.col("value").isNotNull())
    v = F.col("value")
    plain = rows.groupBy("variable").agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max"))
    return join_on_keys(plain, order_statistics(rows, ["variable"], "value", QUARTILES), ["variable"])


def profile(df: DataFrame, dates: list[str], categories: list[str], numbers: list[str]) -> DataFrame:
    """The whole-table profile in long form: section, field, stat, number, text."""
    none_text = F.lit(None).cast("string")
    none_num = F.lit(None).cast("double")

    def stats(section, frame, field, names):
        rows = [
            F.struct(
                F.lit(section).alias("section"),
                field.alias("field"),
                F.lit(n).alias("stat"),
                F.round(F.col(n).cast("double"), 2).alias("number"),
                none_text.alias("text"),
            )
            for n in names
        ]
        return frame.select(F.inline(F.array(*rows)))

    # one scan: all columns, whatever their type, as counted values
    numeric = [YIELD, *[c for c in numbers if c != YIELD]]

    def cell(c, number, text):
        return F.struct(F.lit(c).alias("variable"), number.alias("__value"), text.alias("text"))

    cells = [cell(c, F.col(c).cast("double"), none_text) for c in numeric]
    cells += [cell(c, none_num, F.date_format(F.col(c), "yyyy-MM-dd")) for c in dates]
    cells += [cell(c, none_num, F.col(c).cast("string")) for c in categories]
    known = df.select(F.inline(F.array(*cells))).groupBy("variable", "__value", "text").agg(F.count("*").alias("__times"))
    known = materialize(known, "counted")
    texts = known.where(F.col("text").isNotNull())

    asked = df.sparkSession.createDataFrame([(c,) for c in dates], "column string")
    spans = texts.groupBy(F.col("variable").alias("column")).agg(F.min("text").alias("first"), F.max("text").alias("last"))
    dated = asked.join(spans, "column", "left").fillna("N/A", ["first", "last"])
    dated = dated.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("date_range").alias("section"),
                        F.col("column").alias("field"),
                        F.lit(s).alias("stat"),
                        none_num.alias("number"),
                        F.col(c).alias("text"),
                    )
                    for s, c in (("min", "first"), ("max", "last"))
                ]
            )
        )
    )
    best = F.min(F.struct((-F.col("__times")).alias("neg"), F.col("text").alias("v"))).alias("best")
    top = texts.where(F.col("variable").isin(categories)).groupBy("variable").agg(best, F.count("*").alias("unique_values"))
    top = top.select("variable", "unique_values", F.col("best.v").alias("top_value"), (-F.col("best.neg")).alias("top_count"))
    top = top.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit("categorical").alias("section"),
                        F.col("variable").alias("field"),
                        F.lit(s).alias("stat"),
                        num.cast("double").alias("number"),
                        text.alias("text"),
                    )
                    for s, num, text in (
                        ("unique_values", F.col("unique_values"), none_text),
                        ("top_count", F.col("top_count"), none_text),
                        ("top_value", none_num, F.col("top_value")),
                    )
                ]
            )
        )
    )
    figures = summarised(known.where(F.col("variable").isin(numeric) & F.col("__value").isNotNull()).select("variable", "__value", "__times"), ["variable"], QUARTILES)
    overall = stats("yield", figures.where(F.col("variable") == YIELD), F.lit(YIELD), ["mean", "median", "std", "min", "max", "q1", "q3"])
    numeric = stats("numerical", figures.where(F.col("variable").isin(numbers)), F.col("variable"), ["mean", "std", "min", "max", "median"])
    return overall.unionByName(dated).unionByName(top).unionByName(numeric)


# ---- explorers --------------------------------------------------------------------------------------


def _aggregate(df: DataFrame, keys: list[str], metric: str, how: str, name: str = "value") -> DataFrame:
    """mean / sum / population std / upper median of a metric per group, by name."""
    if how == "median":
        return order_statistics(df, keys, metric, {name: (0.5, UPPER)})
    v = F.col(metric)
    agg = {"mean": F.avg, "sum": F.sum, "std": F.stddev_pop}.get(how, F.avg)
    return df.groupBy(*keys).agg(agg(v).alias(name))


def time_series(df: DataFrame, time: str, metric: str, how: str = "mean", group: str | None = None) -> DataFrame:
    """Metric per time value and optional group; rows without time or metric are left out."""
    g = F.col(group) if group else F.lit("All")
    rows = df.select(g.alias("grp"), F.col(time).alias("time"), F.col(metric).cast("double").alias("metric"))
    rows = rows.where(F.col("time").isNotNull() & F.col("metric").isNotNull() & ~F.isnan("metric"))
    return _aggregate(rows, ["grp", "time"], "metric", how)


def heatmap(df: DataFrame, x: str, y: str, metric: str = "count", how: str = "mean") -> DataFrame:
    """Every (y, x) cell of the two axes in long form; a cell without value is 0."""
    rows = df.select(F.col(x).alias("x"), F.col(y).alias("y"), *([] if metric == "count" else [metric]))
    counts = rows.groupBy("x", "y").agg(F.count("*").alias("n"))
    if metric == "count":
        cells = counts.withColumn("value", F.col("n").cast("double"))
    else:
        cells = join_on_keys(counts, _aggregate(rows, ["x", "y"], metric, how), ["x", "y"])
    # the axes hold the distinct labels of two category columns, and the grid is the result
    # that was asked for: its size is the number of cells of the picture
    grid = counts.select("x").distinct().crossJoin(counts.select("y").distinct())
    return join_on_keys(grid, cells, ["x", "y"]).select(
        "y",
        "x",
        F.coalesce("value", F.lit(0.0)).alias("value"),
        F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def group_boxes(df: DataFrame, key: str, metric: str) -> DataFrame:
    """Five-number summary per group, by the upper median in descending order."""
    g = F.coalesce(F.when(F.col(key) != "", F.col(key)), F.lit("Unknown"))
    rows = df.select(g.alias("grp"), F.col(metric).cast("double").alias("v")).where(F.col("v").isNotNull())
    ends = rows.groupBy("grp").agg(F.min("v").alias("min"), F.max("v").alias("max"), F.count("*").alias("n"))
    picks = {**QUARTILES, "sort_median": (0.5, UPPER)}
    boxes = join_on_keys(ends, order_statistics(rows, ["grp"], "v", picks), ["grp"])
    return boxes.orderBy(F.desc("sort_median"), "grp")


def cross_tab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts per row label, one column per given label (single pass, no pivot discovery)."""
    return df.groupBy(row).agg(*[F.count_if(F.col(column) == v).alias(v.replace(" ", "_")) for v in values])


def cross_share(df: DataFrame, row: str, column: str, scale: float = 100.0) -> DataFrame:
    """Share of each column label within its row label, long form."""
    counts = df.groupBy(row, column).agg(F.count("*").alias("n"))
    totals = counts.groupBy(row).agg(F.sum("n").alias("total"))
    joined = join_on_keys(counts, totals, [row])
    return joined.select(row, column, "n", (F.col("n") / F.col("total") * scale).alias("share"))


def category_share(df: DataFrame, columns: list[str]) -> DataFrame:
    """Percent of the rows per label, for several category columns at once."""
    rows = long_form(df, columns, cast="string").where(F.col("value").isNotNull())
    counts = rows.groupBy("variable", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("variable").agg(F.sum("n").alias("total"))
    joined = join_on_keys(counts, totals, ["variable"])
    return joined.select("variable", "value", "n", (F.col("n") / F.col("total") * 100).alias("share_pct"))


# ---- predictions against the means -------------------------------------------------------------------


def against_global_mean(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    mean = df.agg(F.avg(YIELD).alias("global_mean"))
    diff = F.when(
        F.col("global_mean") > 0, (F.col(prediction) - F.col("global_mean")) / F.col("global_mean") * 100
    ).otherwise(F.lit(0.0))
    out = df.crossJoin(F.broadcast(mean)).withColumn("diff_pct", diff)
    return out.withColumn("performance", ag.performance_label("diff_pct"))


def target_attainment(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """Prediction as percent of the regional mean, capped at 150; the global mean stands in
    where a region has no positive mean."""
    sums = df.groupBy("region").agg(F.sum(YIELD).alias("s"), F.count(YIELD).alias("c"))
    # written first: its true size decides whether it is broadcast or joined by shuffle
    regional = materialize(
        sums.select(F.col("region").alias("__region"), F.try_divide(F.col("s"), F.col("c")).alias("regional_mean")),
        "regional_means",
    )
    overall = df.agg(F.avg(YIELD).alias("global_mean"))
    out = df.join(regional, F.col("region").eqNullSafe(F.col("__region")), "left").drop("__region")
    out = out.crossJoin(F.broadcast(overall))
    base = F.when(F.col("regional_mean") > 0, F.col("regional_mean")).otherwise(F.col("global_mean"))
    pct = F.least(F.try_divide(F.col(prediction), base) * 100, F.lit(150.0))
    out = out.withColumn("attainment_pct", pct)
    label = F.when(F.col("regional_mean") > 0, ag.attainment_label("attainment_pct")).otherwise(
        "of national average"
    )
    return out.withColumn("attainment", label)
