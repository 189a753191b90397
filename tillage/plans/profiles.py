"""Dashboard, analysis and exploration aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators import filters, profile as pr
from tillage.operators.warehouse import warehouse_of
from tillage.plans.registry import Y, query
from tillage.sources.binding import (
    COMMODITIES,
    COMMODITY_SQL,
    DERIVED_COLUMNS,
    FARM_COLUMNS,
    commodity_prices,
    commodity_sql,
    farm,
    farm_sql,
)
from tillage.operators import cleaning

CATEGORIES = ["region", "crop_type", "irrigation_type", "fertilizer_type", "crop_disease_status"]
NUMBERS = [
    "soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct",
    "sunlight_hours", "pesticide_usage_ml", "NDVI_index", "total_days",
]
SUMMARY = [Y, "soil_moisture_pct", "temperature_C", "rainfall_mm", "NDVI_index", "soil_pH",
           "humidity_pct", "sunlight_hours", "pesticide_usage_ml", "total_days"]

QUANTS = f"""quantile_cont({Y}, 0.25) AS q1, quantile_cont({Y}, 0.5) AS median, quantile_cont({Y}, 0.75) AS q3"""


def r(expr: str, name: str, digits: int = 4) -> str:
    return f"round({expr}, {digits}) AS {name}"


def mean(col: str, name: str, digits: int = 4) -> str:
    return r(f'avg("{col}")', name, digits)


def stacked_sql(columns, cast: str = "DOUBLE") -> str:
    """A CTE ``long`` with one row per (row, column)."""
    parts = [f"SELECT '{c}' AS variable, CAST(\"{c}\" AS {cast}) AS value FROM farm" for c in columns]
    return "long AS (" + " UNION ALL ".join(parts) + ")"


@query(
    "a01_home_kpis",
    farm_sql(
        f"""SELECT count(*) AS total_farms, {r(f"avg({Y})", "avg_yield", 2)}, {r(f"max({Y})", "max_yield", 2)},
        {r(f"min({Y})", "min_yield", 2)}, count(DISTINCT crop_type) AS total_crops,
        count(DISTINCT region) AS total_regions FROM farm"""
    ),
)
def _(spark, d):
    return pr.home_kpis(farm(spark, d, "crop_type", "region", Y))


@query(
    "a02_yield_statistics",
    farm_sql(
        f"""SELECT count(*) AS n, {mean(Y, "mean")}, {r(f"stddev_samp({Y})", "std")}, min({Y}) AS min,
        max({Y}) AS max, {r(f"quantile_cont({Y}, 0.5)", "median")} FROM farm"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.yield_statistics(farm(spark, d, Y)))


@query(
    "a03_value_counts_top10",
    farm_sql(
        """SELECT variable, value, n, CAST(rank AS BIGINT) AS rank, unique_values FROM (
          SELECT variable, value, count(*) AS n,
            row_number() OVER (PARTITION BY variable ORDER BY count(*) DESC, value) AS rank,
            count(*) OVER (PARTITION BY variable) AS unique_values
          FROM long WHERE value IS NOT NULL GROUP BY variable, value) WHERE rank <= 10""",
        stacked_sql(["region", "crop_type"], "VARCHAR"),
    ),
)
def _(spark, d):
    return pr.top_values(farm(spark, d, "region", "crop_type"), ["region", "crop_type"])


_OVERVIEW = FARM_COLUMNS + DERIVED_COLUMNS
_SPARK_TYPES = {
    **{c: "double" for c in _OVERVIEW},
    **{c: "string" for c in ("farm_id", "region", "crop_type", "irrigation_type", "fertilizer_type",
                             "sensor_id", "crop_disease_status", "sowing_season")},
    **{c: "date" for c in ("sowing_date", "harvest_date", "timestamp")},
    **{c: "int" for c in ("total_days", "sowing_month", "harvest_month", "heat_stress", "drought_stress")},
}


@query(
    "a04_overview",
    farm_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", '{_SPARK_TYPES[c]}' AS data_type, count(*) - count("{c}") AS missing,
            count(*) AS total_records FROM farm"""
            for c in _OVERVIEW
        )
    ),
)
def _(spark, d):
    return pr.null_counts(farm(spark, d, *_OVERVIEW))


@query(
    "a04_overview_sample",
    farm_sql(
        f"""SELECT farm_id, crop_type, region, {Y} FROM farm
        ORDER BY farm_id, {Y}, crop_type, region LIMIT 10"""
    ),
)
def _(spark, d):
    return filters.first_rows(farm(spark, d, "farm_id", "crop_type", "region", Y), 10, "farm_id", Y, "crop_type", "region")


def _profile_sql() -> str:
    none = "CAST(NULL AS VARCHAR) AS text"
    parts = []
    for stat, expr in {
        "mean": f"avg({Y})", "median": f"quantile_cont({Y}, 0.5)", "std": f"stddev_samp({Y})",
        "min": f"min({Y})", "max": f"max({Y})", "q1": f"quantile_cont({Y}, 0.25)",
        "q3": f"quantile_cont({Y}, 0.75)",
    }.items():
        parts.append(f"SELECT 'yield' AS section, '{Y}' AS field, '{stat}' AS stat, round({expr}, 2) AS number, {none} FROM farm")
    for c in ("sowing_date", "harvest_date"):
        for f in ("min", "max"):
            parts.append(
                f"""SELECT 'date_range', '{c}', '{f}', CAST(NULL AS DOUBLE),
                coalesce(strftime({f}({c}), '%Y-%m-%d'), 'N/A') FROM farm"""
            )
    for c in CATEGORIES:
        top = f"(SELECT {c} AS v, count(*) AS n FROM farm WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY n DESC, v LIMIT 1)"
        parts.append(f"SELECT 'categorical', '{c}', 'unique_values', CAST(count(DISTINCT {c}) AS DOUBLE), NULL FROM farm")
        parts.append(f"SELECT 'categorical', '{c}', 'top_count', CAST(n AS DOUBLE), NULL FROM {top}")
        parts.append(f"SELECT 'categorical', '{c}', 'top_value', CAST(NULL AS DOUBLE), v FROM {top}")
    for c in NUMBERS:
        for stat, expr in {
            "mean": f'avg("{c}")', "std": f'stddev_samp("{c}")', "min": f'min("{c}")', "max": f'max("{c}")',
            "median": f'quantile_cont("{c}", 0.5)',
        }.items():
            parts.append(f"SELECT 'numerical', '{c}', '{stat}', round(CAST({expr} AS DOUBLE), 2), NULL FROM farm")
    return farm_sql(" UNION ALL ".join(parts))


@query("a05_profile", _profile_sql())
def _(spark, d):
    df = farm(spark, d, Y, "sowing_date", "harvest_date", *CATEGORIES, *NUMBERS)
    return pr.profile(df, ["sowing_date", "harvest_date"], CATEGORIES, NUMBERS)


def _summary_sql(key: str) -> str:
    return farm_sql(
        f"""SELECT {key}, n, round(mean, 4) AS mean, round(std, 4) AS std, min, max, round(q1, 4) AS q1,
        round(median, 4) AS median, round(q3, 4) AS q3 FROM (
          SELECT {key}, count(*) AS n, avg({Y}) AS mean, stddev_samp({Y}) AS std, min({Y}) AS min,
          max({Y}) AS max, {QUANTS} FROM farm GROUP BY {key})"""
    )


@query("a06_crop_stats", _summary_sql("crop_type"))
def _(spark, d):
    return pr.rounded(pr.grouped_summary(farm(spark, d, "crop_type", Y), ["crop_type"]))


for _key, _cols in {
    "a06_crop_region_distribution": ["crop_type", "region"],
    "a06_crop_irrigation_distribution": ["crop_type", "irrigation_type"],
    "a07_region_crop_distribution": ["region", "crop_type"],
}.items():
    query(_key, farm_sql(f"SELECT {', '.join(_cols)}, count(*) AS n FROM farm GROUP BY {', '.join(_cols)}"))(
        lambda spark, d, cols=_cols: pr.distribution(farm(spark, d, *cols), cols)
    )


@query("a07_region_stats", _summary_sql("region"))
def _(spark, d):
    return pr.rounded(pr.grouped_summary(farm(spark, d, "region", Y), ["region"]))


@query(
    "a07_region_top_crops",
    farm_sql(
        f"""SELECT region, crop_type, round(mean, 4) AS mean, CAST(rank AS BIGINT) AS rank FROM (
          SELECT region, crop_type, avg({Y}) AS mean,
          row_number() OVER (PARTITION BY region ORDER BY avg({Y}) DESC, crop_type) AS rank
          FROM farm GROUP BY region, crop_type) WHERE rank <= 5"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.top_per_group(farm(spark, d, "region", "crop_type", Y), "region", "crop_type", 5))


def _grouped(key: str, by: list[str], aggs: dict[str, tuple[str, str]], digits: int = 2):
    """Register one plain grouped aggregate: alias -> (function, column)."""
    sql_fn = {"mean": "avg", "std": "stddev_samp", "count": "count", "min": "min", "max": "max"}
    fn = {"mean": F.avg, "std": F.stddev_samp, "count": F.count, "min": F.min, "max": F.max}
    select = [f"{c}" for c in by]
    for alias, (f, c) in aggs.items():
        col = "*" if c == "*" else f'"{c}"'
        call = f"{sql_fn[f]}({col})"
        select.append(f"{call} AS {alias}" if f == "count" else f"round({call}, {digits}) AS {alias}")
    sql = farm_sql(f"SELECT {', '.join(select)} FROM farm GROUP BY {', '.join(by)}")
    cols = list(dict.fromkeys(by + [c for _, c in aggs.values() if c != "*"]))

    @query(key, sql)
    def _(spark, d):
        exprs = {a: fn[f](c) for a, (f, c) in aggs.items()}
        return pr.rounded(pr.group_stats(farm(spark, d, *cols), by, **exprs), digits)


_grouped("a08_crop_comparison", ["crop_type"], {"mean": ("mean", Y), "std": ("std", Y), "n": ("count", "*")})
_grouped("a10_region_yield_temperature", ["region"], {"avg_yield": ("mean", Y), "avg_temp": ("mean", "temperature_C")}, 4)
_grouped(
    "a11_region_dashboard",
    ["region"],
    {
        "avg_yield": ("mean", Y), "farm_count": ("count", "*"), "avg_temp": ("mean", "temperature_C"),
        "avg_rainfall": ("mean", "rainfall_mm"), "avg_ndvi": ("mean", "NDVI_index"),
    },
)
_grouped(
    "a12_region_eda",
    ["region"],
    {
        "avg_yield": ("mean", Y), "yield_std": ("std", Y), "farm_count": ("count", "*"),
        "avg_temp": ("mean", "temperature_C"), "avg_rainfall": ("mean", "rainfall_mm"),
        "avg_humidity": ("mean", "humidity_pct"), "avg_soil_moisture": ("mean", "soil_moisture_pct"),
        "avg_ndvi": ("mean", "NDVI_index"),
    },
)
_grouped(
    "a13_crop_eda",
    ["crop_type"],
    {
        "avg_yield": ("mean", Y), "yield_std": ("std", Y), "n": ("count", "*"),
        "avg_growing_days": ("mean", "total_days"), "avg_temp": ("mean", "temperature_C"),
        "avg_rainfall": ("mean", "rainfall_mm"), "avg_soil_moisture": ("mean", "soil_moisture_pct"),
        "avg_ph": ("mean", "soil_pH"), "avg_ndvi": ("mean", "NDVI_index"),
    },
)


@query(
    "a14_yield_by_three_dimensions",
    farm_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS variable, {c} AS value, {mean(Y, "mean", 2)}, {r(f"stddev_samp({Y})", "std", 2)},
            min({Y}) AS min, max({Y}) AS max FROM farm GROUP BY {c}"""
            for c in ("region", "crop_type", "crop_disease_status")
        )
    ),
)
def _(spark, d):
    dims = ["region", "crop_type", "crop_disease_status"]
    rows = pr.long_form(farm(spark, d, Y, *dims), dims, [Y], "string")
    stats = pr.group_stats(
        rows, ["variable", "value"], mean=F.avg(Y), std=F.stddev_samp(Y), min=F.min(Y), max=F.max(Y)
    )
    return pr.rounded(stats, 2)


@query(
    "a15_disease_impact",
    farm_sql(
        f"""SELECT crop_disease_status, {mean(Y, "mean")}, {r(f"stddev_samp({Y})", "std")}, count(*) AS n,
        CAST(CASE crop_disease_status WHEN 'No Disease' THEN 1 WHEN 'Mild' THEN 2 WHEN 'Moderate' THEN 3
        WHEN 'Severe' THEN 4 END AS BIGINT) AS severity FROM farm GROUP BY crop_disease_status"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.severity_impact(farm(spark, d, "crop_disease_status", Y)))


@query(
    "a16_disease_impact_positive",
    farm_sql(
        f"""SELECT status AS crop_disease_status, {mean(Y, "mean")}, count(*) AS n,
        CAST(CASE status WHEN 'No Disease' THEN 1 WHEN 'No disease' THEN 2 WHEN 'Healthy' THEN 3 WHEN 'Mild' THEN 4
        WHEN 'Moderate' THEN 5 WHEN 'Severe' THEN 6 WHEN 'Unknown' THEN 7 ELSE 999 END AS BIGINT) AS place FROM (
          SELECT coalesce(nullif(crop_disease_status, ''), 'Unknown') AS status, {Y} FROM farm WHERE {Y} > 0)
        GROUP BY status"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.positive_impact(farm(spark, d, "crop_disease_status", Y)))


TEMP_CASE = """CASE WHEN "temperature_C" > 0 AND "temperature_C" < 20 THEN '<20°C'
  WHEN "temperature_C" >= 20 AND "temperature_C" <= 25 THEN '20-25°C'
  WHEN "temperature_C" > 25 AND "temperature_C" <= 30 THEN '25-30°C' WHEN "temperature_C" > 30 THEN '>30°C' END"""
MOIST_CASE = """CASE WHEN soil_moisture_pct > 0 AND soil_moisture_pct < 30 THEN '<30%'
  WHEN soil_moisture_pct >= 30 AND soil_moisture_pct <= 50 THEN '30-50%'
  WHEN soil_moisture_pct > 50 AND soil_moisture_pct <= 70 THEN '50-70%' WHEN soil_moisture_pct > 70 THEN '>70%' END"""


@query(
    "a17_climate_impact",
    farm_sql(
        f"""SELECT g.factor, g.bucket, round(avg({Y}), 4) AS mean, count({Y}) AS n FROM grid g LEFT JOIN (
          SELECT 'temperature' AS factor, {TEMP_CASE} AS bucket, {Y} FROM farm WHERE {Y} > 0
          UNION ALL SELECT 'moisture', {MOIST_CASE}, {Y} FROM farm WHERE {Y} > 0) v
        ON g.factor = v.factor AND g.bucket = v.bucket GROUP BY g.factor, g.bucket""",
        """grid AS (SELECT * FROM (VALUES ('temperature', '<20°C'), ('temperature', '20-25°C'),
        ('temperature', '25-30°C'), ('temperature', '>30°C'), ('moisture', '<30%'), ('moisture', '30-50%'),
        ('moisture', '50-70%'), ('moisture', '>70%')) t(factor, bucket))""",
    ),
)
def _(spark, d):
    return pr.rounded(pr.climate_impact(farm(spark, d, "temperature_C", "soil_moisture_pct", Y)))


_grouped("a18_monthly_trend", ["sowing_month"], {"avg_yield": ("mean", Y)}, 4)
_grouped(
    "a19_monthly_climate",
    ["sowing_month"],
    {"avg_yield": ("mean", Y), "avg_temp": ("mean", "temperature_C"), "avg_rainfall": ("mean", "rainfall_mm")},
    4,
)


@query(
    "a20_month_histograms",
    farm_sql(
        """SELECT variable, CAST(value AS BIGINT) AS month, count(*) AS n FROM long GROUP BY variable, value""",
        stacked_sql(["sowing_month", "harvest_month"], "BIGINT"),
    ),
)
def _(spark, d):
    months = ["sowing_month", "harvest_month"]
    rows = pr.long_form(farm(spark, d, *months), months, cast="bigint")
    return rows.groupBy("variable", F.col("value").alias("month")).agg(F.count("*").alias("n"))


def _upper(col: str, keys: str, p: float = 0.5, name: str = "value", source: str = "farm") -> str:
    return f"""(SELECT {keys}, v AS {name} FROM (SELECT {keys}, {col} AS v,
      row_number() OVER (PARTITION BY {keys} ORDER BY {col}) AS rn, count(*) OVER (PARTITION BY {keys}) AS n
      FROM {source} WHERE {col} IS NOT NULL) WHERE rn = CAST(floor(n * {p}) AS BIGINT) + 1)"""


for _how, _expr in {"mean": f"avg({Y})", "sum": f"sum({Y})", "std": f"stddev_pop({Y})"}.items():
    query(
        f"a21_time_series_{_how}",
        farm_sql(
            f"""SELECT region AS grp, CAST(sowing_month AS BIGINT) AS "time", round({_expr}, {1 if _how == "mean" else 4}) AS value
            FROM farm GROUP BY region, sowing_month"""
        ),
    )(
        lambda spark, d, how=_how: pr.rounded(
            pr.time_series(farm(spark, d, "region", "sowing_month", Y), "sowing_month", Y, how, "region"), 1 if how == "mean" else 4
        ).withColumn("time", F.col("time").cast("bigint"))
    )


@query(
    "a21_time_series_median",
    farm_sql(f"""SELECT 'All' AS grp, CAST(sowing_month AS BIGINT) AS "time", value FROM {_upper(Y, "sowing_month")}"""),
)
def _(spark, d):
    out = pr.time_series(farm(spark, d, "sowing_month", Y), "sowing_month", Y, "median")
    return out.withColumn("time", F.col("time").cast("bigint"))


for _metric, _how, _expr in (
    ("count", "mean", "CAST(count(*) AS DOUBLE)"),
    (Y, "mean", f"avg({Y})"),
    (Y, "sum", f"sum({Y})"),
):
    _name = "count" if _metric == "count" else _how
    query(
        f"a22_heatmap_{_name}",
        farm_sql(
            """SELECT ys.y, xs.x, round(coalesce(c.value, 0), 4) AS value, coalesce(c.n, 0) AS n
            FROM (SELECT DISTINCT region AS y FROM farm) ys CROSS JOIN (SELECT DISTINCT crop_type AS x FROM farm) xs
            LEFT JOIN cells c ON c.y = ys.y AND c.x = xs.x""",
            f"""cells AS (SELECT region AS y, crop_type AS x, {_expr} AS value, count(*) AS n
            FROM farm GROUP BY region, crop_type)""",
        ),
    )(
        lambda spark, d, metric=_metric, how=_how: pr.rounded(
            pr.heatmap(
                farm(spark, d, *(["crop_type", "region"] + ([] if metric == "count" else [metric]))),
                "crop_type",
                "region",
                metric,
                how,
            ),
            4,
        )
    )


@query(
    "a22_heatmap_median",
    farm_sql(
        f"""SELECT region AS y, crop_type AS x, value, n FROM {_upper(Y, "region, crop_type")}
        JOIN (SELECT region, crop_type, count(*) AS n FROM farm GROUP BY region, crop_type) USING (region, crop_type)"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.heatmap(farm(spark, d, "crop_type", "region", Y), "crop_type", "region", Y, "median"))


@query(
    "a23_group_boxes",
    farm_sql(
        f"""SELECT irrigation_type AS grp, min({Y}) AS min, max({Y}) AS max, count(*) AS n,
        round(quantile_cont({Y}, 0.25), 4) AS q1, round(quantile_cont({Y}, 0.5), 4) AS median,
        round(quantile_cont({Y}, 0.75), 4) AS q3, any_value(u.value) AS sort_median
        FROM farm JOIN {_upper(Y, "irrigation_type")} u USING (irrigation_type) GROUP BY irrigation_type"""
    ),
)
def _(spark, d):
    return pr.rounded(pr.group_boxes(farm(spark, d, "irrigation_type", Y), "irrigation_type", Y))


@query("a24_crosstab_region_crop", farm_sql("SELECT region, " + ", ".join(
    f"count(*) FILTER (crop_type = '{c}') AS {c}" for c in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
) + " FROM farm GROUP BY region"))
def _(spark, d):
    labels = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
    return pr.cross_tab(farm(spark, d, "region", "crop_type"), "region", "crop_type", labels)


@query("a24_crosstab_crop_irrigation", farm_sql("SELECT crop_type, " + ", ".join(
    f"count(*) FILTER (irrigation_type = '{c}') AS {c}"
    for c in ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
) + " FROM farm GROUP BY crop_type"))
def _(spark, d):
    labels = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return pr.cross_tab(farm(spark, d, "crop_type", "irrigation_type"), "crop_type", "irrigation_type", labels)


def _share_sql(row: str, col: str, scale: int) -> str:
    return farm_sql(
        f"""SELECT {row}, {col}, count(*) AS n,
        round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY {row}) * {scale}, 4) AS share
        FROM farm GROUP BY {row}, {col}"""
    )


@query("a25_disease_share_by_region", _share_sql("region", "crop_disease_status", 100))
def _(spark, d):
    return pr.rounded(pr.cross_share(farm(spark, d, "region", "crop_disease_status"), "region", "crop_disease_status"))


@query("a27_severe_rate_by_crop", farm_sql(
    """SELECT crop_type, count(*) FILTER (crop_disease_status = 'Severe') AS hits, count(*) AS n,
    round(nullif(count(*) FILTER (crop_disease_status = 'Severe'), 0) * 100.0::DOUBLE / count(*), 4) AS rate_pct
    FROM farm GROUP BY crop_type"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "crop_type", "crop_disease_status")
    return pr.rounded(pr.rate_by_group(df, "crop_type", F.col("crop_disease_status") == "Severe"))


@query("a28_best_groups", farm_sql(" UNION ALL ".join(
    f"""(SELECT '{c}' AS dimension, {c} AS best, {mean(Y, "mean")} FROM farm GROUP BY {c}
    ORDER BY avg({Y}) DESC, {c} LIMIT 1)""" for c in ("region", "crop_type"))))  # fmt: skip
def _(spark, d):
    best = pr.best_group(farm(spark, d, "region", Y), "region")
    return pr.rounded(best.unionByName(pr.best_group(farm(spark, d, "crop_type", Y), "crop_type")))


@query("a29_yield_loss", farm_sql(
    f"""SELECT round(h, 4) AS healthy_yield, round(s, 4) AS severe_yield, round((h - s) / h * 100, 4) AS yield_loss_pct
    FROM (SELECT avg({Y}) FILTER (crop_disease_status = 'No Disease') AS h,
    avg({Y}) FILTER (crop_disease_status = 'Severe') AS s FROM farm)"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(pr.loss_from_disease(farm(spark, d, "crop_disease_status", Y)))


_KG = {"CORN": 25.4, "WHEAT": 27.2, "SOYBEANS": 27.2, "COTTON": 0.453}
AVERAGE_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS commodity, round(avg("{c}" / 100 * 0.92::DOUBLE / {_KG[c]}::DOUBLE), 6) AS avg_price FROM commodity
    WHERE year("date") = (SELECT CASE WHEN count(*) FILTER (year("date") = 2024) > 0 THEN 2024 ELSE 2023 END FROM commodity)"""
    for c in COMMODITIES
)


@query("a30_average_prices", commodity_sql(AVERAGE_SQL))
def _(spark, d):
    prices = cleaning.normalized_prices(commodity_prices(spark, d), COMMODITIES)
    return pr.rounded(cleaning.average_prices_long(prices, COMMODITIES, 2024, 2023), 6)


@query("a31_crop_mean_price", farm_sql(
    f"SELECT crop_type, {r('avg(price)', 'price_per_kg_EUR', 6)} FROM farm JOIN price USING (crop_type) GROUP BY crop_type",
    COMMODITY_SQL,
    f"avgs AS ({AVERAGE_SQL})",
    """price AS (SELECT p_type AS crop_type, CASE p_type
      WHEN 'ECONOMY' THEN (SELECT avg_price FROM avgs WHERE commodity = 'CORN')
      WHEN 'SMALL' THEN (SELECT avg_price FROM avgs WHERE commodity = 'WHEAT')
      WHEN 'MEDIUM' THEN (SELECT avg_price FROM avgs WHERE commodity = 'SOYBEANS')
      WHEN 'LARGE' THEN (SELECT avg_price FROM avgs WHERE commodity = 'COTTON')
      WHEN 'STANDARD' THEN 1.45::DOUBLE ELSE 0.45::DOUBLE END AS price FROM part GROUP BY p_type)"""))  # fmt: skip
def _(spark, d):
    from tillage.plans.warehouse import priced_farm

    df = priced_farm(spark, d, "crop_type", price_digits=6)
    return pr.rounded(pr.group_stats(df, ["crop_type"], price_per_kg_EUR=F.avg("price_per_kg_EUR")), 6)


@query("a34_distinct_counts", farm_sql(" UNION ALL ".join(
    f"SELECT '{c}' AS variable, count(DISTINCT {c}) AS unique_values FROM farm"
    for c in ("farm_id", "sensor_id", *CATEGORIES))))
def _(spark, d):
    cols = ["farm_id", "sensor_id", *CATEGORIES]
    return pr.distinct_counts(farm(spark, d, *cols), cols)


@query("a35_explorer_summary", farm_sql(
    f"""SELECT count(*) AS total_records, coalesce({f"round(avg({Y}), 4)"}, 0) AS avg_yield,
    count(DISTINCT crop_type) AS unique_crops, count(DISTINCT region) AS unique_regions
    FROM farm WHERE crop_disease_status = 'Severe' AND irrigation_type = 'BUILDING'"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "crop_type", "region", "irrigation_type", "crop_disease_status", Y)
    matching = filters.by_equality(df, crop_disease_status="Severe", irrigation_type="BUILDING", region="")
    return pr.rounded(filters.explorer_summary(matching))


@query("a36_bar_means", farm_sql(f"""SELECT rainfall_mm AS x, {mean(Y, "mean")} FROM farm GROUP BY rainfall_mm"""))
def _(spark, d):
    df = filters.valid_pairs(farm(spark, d, "rainfall_mm", Y), "rainfall_mm", Y)
    return pr.rounded(df.groupBy(F.col("rainfall_mm").alias("x")).agg(F.avg(Y).alias("mean")))


@query("a38_describe", farm_sql(
    """SELECT variable, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
    round(min(value), 6) AS min, round(max(value), 6) AS max, round(quantile_cont(value, 0.25), 4) AS q1,
    round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3
    FROM long GROUP BY variable""", stacked_sql([Y, *NUMBERS])))  # fmt: skip
def _(spark, d):
    out = pr.describe(farm(spark, d, Y, *NUMBERS), [Y, *NUMBERS])
    return pr.rounded(out.withColumns({"min": F.round("min", 6), "max": F.round("max", 6)}), 4, "min", "max")


_ALL_NUMBERS = [Y, *NUMBERS, "latitude", "longitude", "yield_per_day", "water_efficiency", "pesticide_efficiency", "heat_stress", "drought_stress", "growing_conditions_score"]


@query("a38_describe_all", farm_sql(
    """SELECT variable, count(value) AS n, round(avg(value), 4) AS mean, round(stddev_samp(value), 4) AS std,
    round(min(value), 4) AS min, round(max(value), 4) AS max, round(quantile_cont(value, 0.25), 4) AS q1,
    round(quantile_cont(value, 0.5), 4) AS median, round(quantile_cont(value, 0.75), 4) AS q3
    FROM long GROUP BY variable""", stacked_sql(_ALL_NUMBERS)))  # fmt: skip
def _(spark, d):
    return pr.rounded(pr.describe(farm(spark, d, *_ALL_NUMBERS), _ALL_NUMBERS), 4)


@query("a39_categorical_counts", farm_sql(
    "SELECT variable, value, count(*) AS n FROM long GROUP BY variable, value",
    stacked_sql([*CATEGORIES, "sowing_season"], "VARCHAR")))
def _(spark, d):
    cols = [*CATEGORIES, "sowing_season"]
    rows = pr.long_form(farm(spark, d, *cols), cols, cast="string")
    return rows.groupBy("variable", "value").agg(F.count("*").alias("n"))


@query("a40_source_kpis", farm_sql(
    f"""SELECT count(*) AS row_count, CAST({len(FARM_COLUMNS)} AS BIGINT) AS column_count,
    count(DISTINCT crop_type) AS crop_types, count(DISTINCT region) AS regions FROM farm"""))  # fmt: skip
def _(spark, d):
    from tillage.operators import quality

    return quality.source_kpis(farm(spark, d, *FARM_COLUMNS))


_UPPER_SQL = farm_sql(
    """SELECT variable, round(mean, 4) AS mean, round(std, 4) AS std, round(mn, 6) AS min, round(mx, 6) AS max,
    round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3 FROM (
      SELECT variable, avg(value) AS mean, stddev_pop(value) AS std, min(value) AS mn, max(value) AS mx,
      max(value) FILTER (rn = CAST(floor(n * 0.25) AS BIGINT) + 1) AS q1,
      max(value) FILTER (rn = CAST(floor(n * 0.5) AS BIGINT) + 1) AS median,
      max(value) FILTER (rn = CAST(floor(n * 0.75) AS BIGINT) + 1) AS q3
      FROM (SELECT *, row_number() OVER (PARTITION BY variable ORDER BY value) AS rn,
        count(*) OVER (PARTITION BY variable) AS n FROM long WHERE value IS NOT NULL) GROUP BY variable)""",
    stacked_sql(SUMMARY),
)


@query("a09_statistical_summary", _UPPER_SQL)
def _(spark, d):
    out = pr.upper_summary(farm(spark, d, *SUMMARY), SUMMARY)
    exact = ["min", "max", "q1", "median", "q3"]
    return pr.rounded(out.withColumns({c: F.round(c, 6) for c in exact}), 4, *exact)


RULE_SQL = """(CASE crop_type WHEN 'Wheat' THEN 3500 WHEN 'Corn' THEN 4500 WHEN 'Rice' THEN 4200
  WHEN 'Soybean' THEN 2800 WHEN 'Barley' THEN 3200 ELSE 3500 END) * (1
  + (CASE WHEN soil_moisture_pct < 30 THEN -0.3::DOUBLE WHEN soil_moisture_pct > 70 THEN -0.2::DOUBLE
      WHEN soil_moisture_pct BETWEEN 40 AND 60 THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END
    + CASE WHEN "soil_pH" BETWEEN 6.0::DOUBLE AND 7.0::DOUBLE THEN 0.1::DOUBLE
        WHEN "soil_pH" < 5.5::DOUBLE OR "soil_pH" > 7.5::DOUBLE THEN -0.2::DOUBLE ELSE 0.0::DOUBLE END
    + CASE crop_disease_status WHEN 'Severe' THEN -0.4::DOUBLE WHEN 'Moderate' THEN -0.2::DOUBLE
        WHEN 'Mild' THEN -0.1::DOUBLE ELSE 0.0::DOUBLE END
    + CASE irrigation_type WHEN 'Drip' THEN 0.15::DOUBLE WHEN 'Sprinkler' THEN 0.1::DOUBLE ELSE 0.0::DOUBLE END))"""
RULE_INPUTS = ["crop_type", "soil_moisture_pct", "soil_pH", "crop_disease_status", "irrigation_type"]


@query("a41_prediction_vs_mean", farm_sql(
    f"""SELECT farm_id, crop_type, round(prediction, 4) AS prediction, round(diff, 4) AS diff_pct,
    CASE WHEN diff > 20 THEN 'Excellent' WHEN diff > 0 THEN 'Good' WHEN diff > -10 THEN 'Average'
    ELSE 'Below Average' END AS performance FROM (
      SELECT farm_id, crop_type, prediction, (prediction - m) / m * 100 AS diff FROM
      (SELECT *, {RULE_SQL} AS prediction FROM farm), (SELECT avg({Y}) AS m FROM farm))"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", Y, *RULE_INPUTS).withColumn("prediction", ag.rule_score())
    out = pr.against_global_mean(df)
    return pr.rounded(out.select("farm_id", "crop_type", "prediction", "diff_pct", "performance"))


@query("a42_target_attainment", farm_sql(
    f"""SELECT farm_id, region, round(pct, 4) AS attainment_pct,
    CASE WHEN pct >= 120 THEN 'Excellent - Well above regional average' WHEN pct >= 100 THEN 'Good - Above regional average'
    WHEN pct >= 80 THEN 'Average - Near regional average' ELSE 'Below regional average' END AS attainment FROM (
      SELECT farm_id, region, least(pesticide_efficiency * 20 / m * 100, 150.0::DOUBLE) AS pct
      FROM farm JOIN (SELECT region, avg({Y}) AS m FROM farm GROUP BY region) USING (region))"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "region", "pesticide_efficiency", Y)
    out = pr.target_attainment(df.withColumn("prediction", F.col("pesticide_efficiency") * 20))
    return pr.rounded(out.select("farm_id", "region", "attainment_pct", "attainment"))


@query("a43_top_crop_share", farm_sql(
    f"""SELECT crop_type, round(m, 2) AS mean, round(round(m, 2) / x * 100, 4) AS share_pct FROM
    (SELECT crop_type, avg({Y}) AS m FROM farm GROUP BY crop_type ORDER BY m DESC, crop_type LIMIT 5),
    (SELECT round(max({Y}), 2) AS x FROM farm)"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(pr.top_share(farm(spark, d, "crop_type", Y), "crop_type"))


@query("a44_date_ranges", farm_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS "column", coalesce(strftime(min({c}), '%Y-%m-%d'), 'N/A') AS first,
    coalesce(strftime(max({c}), '%Y-%m-%d'), 'N/A') AS last FROM farm""" for c in ("sowing_date", "harvest_date"))))  # fmt: skip
def _(spark, d):
    return pr.date_ranges(farm(spark, d, "sowing_date", "harvest_date"), ["sowing_date", "harvest_date"])
