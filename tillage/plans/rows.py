"""Row-level transforms, labels and filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators import cleaning, filters
from tillage.operators import profile as pr
from tillage.operators import stats
from tillage.plans.profiles import MOIST_CASE, NUMBERS, RULE_INPUTS, RULE_SQL, TEMP_CASE, stacked_sql
from tillage.plans.registry import Y, query
from tillage.sources.binding import (
    COMMODITIES,
    COMMODITY_SQL,
    FARM_COLUMNS,
    commodity_prices,
    commodity_sql,
    farm,
    farm_sql,
)

PRICE_SELECT = ", ".join(
    f"""round("{c}" / 100 * 0.92::DOUBLE / {ag.KG_PER_UNIT[c]}::DOUBLE, 6) AS "{c}_EUR_PER_KG" """ for c in COMMODITIES
)
DAY = "strftime(\"date\", '%Y-%m-%d') AS day"


def by_day(df):
    return df.select(F.date_format("date", "yyyy-MM-dd").alias("day"), *[c for c in df.columns if c != "date"])


# ---- prices and series ---------------------------------------------------------------------------------


@query("t01_price_normalisation", commodity_sql(f"SELECT {DAY}, {PRICE_SELECT} FROM commodity"))
def _(spark, d):
    out = cleaning.normalized_prices(commodity_prices(spark, d), COMMODITIES)
    return pr.rounded(by_day(out.select("date", *[f"{c}_EUR_PER_KG" for c in COMMODITIES])), 6)


_LONG = "prices AS (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS variable, "date", "{c}" AS value FROM commodity""" for c in COMMODITIES
) + ")"
_POS = """pos AS (SELECT variable, "date", value, row_number() OVER (PARTITION BY variable ORDER BY "date") AS p FROM prices)"""
_INTERPOLATED = """SELECT a.variable, strftime(a."date", '%Y-%m-%d') AS day, round(coalesce(a.value,
    CASE WHEN l.value IS NOT NULL AND r.value IS NOT NULL THEN l.value + (r.value - l.value) / (r.p - l.p) * (a.p - l.p) END,
    l.value, r.value), 4) AS value FROM pos a
  LEFT JOIN pos l ON l.variable = a.variable AND l.p = (SELECT max(p) FROM pos x WHERE x.variable = a.variable AND x.p <= a.p AND x.value IS NOT NULL)
  LEFT JOIN pos r ON r.variable = a.variable AND r.p = (SELECT min(p) FROM pos x WHERE x.variable = a.variable AND x.p >= a.p AND x.value IS NOT NULL)"""

# all days with their interpolated price, unrounded
FILLED_SQL = (_LONG, _POS, "filled AS (" + _INTERPOLATED.replace("strftime(a.\"date\", '%Y-%m-%d') AS day, round(", 'a."date", ').replace("r.value), 4) AS value", "r.value) AS value") + ")")


def _series(spark, d):
    return pr.long_form(commodity_prices(spark, d), COMMODITIES, ["date"])


@query("t02_interpolation", commodity_sql(_INTERPOLATED, _LONG, _POS))
def _(spark, d):
    return pr.rounded(by_day(cleaning.interpolate(_series(spark, d), "variable", "date", "value")))


@query("t03_fill_forward_back", commodity_sql(
    """SELECT variable, strftime("date", '%Y-%m-%d') AS day, round(coalesce(
      last_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY "date" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
      first_value(value IGNORE NULLS) OVER (PARTITION BY variable ORDER BY "date" ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
    ), 4) AS value FROM prices""", _LONG))  # fmt: skip
def _(spark, d):
    return pr.rounded(by_day(cleaning.fill_forward_back(_series(spark, d), "variable", "date", "value")))


@query("t04_mean_fill", commodity_sql(
    f"SELECT {DAY}, " + ", ".join(f'round(coalesce("{c}", (SELECT avg("{c}") FROM commodity)), 4) AS "{c}"' for c in COMMODITIES)
    + " FROM commodity"))
def _(spark, d):
    return pr.rounded(by_day(cleaning.mean_fill(commodity_prices(spark, d), COMMODITIES)))


GAP_SQL = """gaps AS (SELECT farm_id, CASE WHEN pesticide_usage_ml > 5 THEN "temperature_C" END AS "temperature_C",
  CASE WHEN soil_moisture_pct > 12 THEN rainfall_mm END AS rainfall_mm,
  CASE WHEN soil_moisture_pct < 75 THEN irrigation_type END AS irrigation_type,
  CAST(NULL AS VARCHAR) AS fertilizer_type FROM farm)"""


def with_gaps(spark, d):
    """Farm rows that lose some values by a fixed rule: the source tables have none missing."""
    df = farm(spark, d, "farm_id", "temperature_C", "rainfall_mm", "irrigation_type", "pesticide_usage_ml", "soil_moisture_pct")
    m = F.col("soil_moisture_pct")
    return df.select(
        "farm_id",
        F.when(F.col("pesticide_usage_ml") > 5, F.col("temperature_C")).alias("temperature_C"),
        F.when(m > 12, F.col("rainfall_mm")).alias("rainfall_mm"),
        F.when(m < 75, F.col("irrigation_type")).alias("irrigation_type"),
        F.lit(None).cast("string").alias("fertilizer_type"),
    )


@query("t05_median_fill", farm_sql(
    """SELECT farm_id, round(coalesce("temperature_C", (SELECT quantile_cont("temperature_C", 0.5) FROM gaps)), 6) AS "temperature_C",
    round(coalesce(rainfall_mm, (SELECT quantile_cont(rainfall_mm, 0.5) FROM gaps)), 6) AS rainfall_mm FROM gaps""", GAP_SQL))  # fmt: skip
def _(spark, d):
    columns = ["temperature_C", "rainfall_mm"]
    return pr.rounded(cleaning.median_fill(with_gaps(spark, d).select("farm_id", *columns), columns), 6)


@query("t06_mode_fill", farm_sql(
    """SELECT farm_id, coalesce(irrigation_type, (SELECT irrigation_type FROM gaps WHERE irrigation_type IS NOT NULL
      GROUP BY irrigation_type ORDER BY count(*) DESC, irrigation_type LIMIT 1), 'Unknown') AS irrigation_type,
    coalesce(fertilizer_type, 'Unknown') AS fertilizer_type FROM gaps""", GAP_SQL))  # fmt: skip
def _(spark, d):
    columns = ["irrigation_type", "fertilizer_type"]
    return cleaning.mode_fill(with_gaps(spark, d).select("farm_id", *columns), columns)


@query("t07_drop_incomplete", farm_sql(
    """SELECT farm_id, round("temperature_C", 6) AS "temperature_C", rainfall_mm, irrigation_type FROM gaps
    WHERE "temperature_C" IS NOT NULL AND rainfall_mm IS NOT NULL AND irrigation_type IS NOT NULL""", GAP_SQL))  # fmt: skip
def _(spark, d):
    return pr.rounded(cleaning.drop_incomplete(with_gaps(spark, d).drop("fertilizer_type")), 6)


_MISSING = " + ".join(f'(count(*) - count("{c}"))' for c in COMMODITIES)
_COMPLETE = " AND ".join(f'"{c}" IS NOT NULL' for c in COMMODITIES)


@query("t08_missing_strategies", commodity_sql(
    f"""SELECT 'none' AS strategy, count(*) AS n, {_MISSING} AS missing FROM commodity
    UNION ALL SELECT s, count(*), 0 FROM commodity, (VALUES ('interpolate'), ('ffill'), ('mean')) t(s) GROUP BY s
    UNION ALL SELECT 'drop', count(*), 0 FROM commodity WHERE {_COMPLETE}"""))  # fmt: skip
def _(spark, d):
    prices = commodity_prices(spark, d)
    out = cleaning.missing_total(prices, "none")
    for strategy in ("interpolate", "ffill", "mean", "drop"):
        out = out.unionByName(cleaning.missing_total(cleaning.handle_missing(prices, strategy), strategy))
    return out


PRICE_SQL = (
    COMMODITY_SQL,
    "avgs AS (SELECT " + ", ".join(
        f"""round(avg("{c}" / 100 * 0.92::DOUBLE / {ag.KG_PER_UNIT[c]}::DOUBLE), 6) AS "{c}" """ for c in COMMODITIES)
    + " FROM commodity WHERE year(\"date\") = 2024)",
    """price AS (SELECT p_type AS crop_type, CASE p_type WHEN 'ECONOMY' THEN (SELECT "CORN" FROM avgs)
      WHEN 'SMALL' THEN (SELECT "WHEAT" FROM avgs) WHEN 'MEDIUM' THEN (SELECT "SOYBEANS" FROM avgs)
      WHEN 'LARGE' THEN (SELECT "COTTON" FROM avgs) WHEN 'STANDARD' THEN 1.45::DOUBLE ELSE 0.45::DOUBLE END AS price
      FROM part GROUP BY p_type)""",
)


@query("t09_price_lookup", farm_sql(
    """SELECT crop_type, price AS "price_per_kg_EUR", count(*) AS n FROM farm JOIN price USING (crop_type)
    GROUP BY crop_type, price""", *PRICE_SQL))  # fmt: skip
def _(spark, d):
    from tillage.plans.warehouse import priced_farm

    df = priced_farm(spark, d, "crop_type", price_digits=6)
    return df.groupBy("crop_type", "price_per_kg_EUR").agg(F.count("*").alias("n"))


@query("t10_revenue", farm_sql(
    f"""SELECT farm_id, round({Y} * price, 8) AS "revenue_per_hectare_EUR" FROM farm LEFT JOIN price USING (crop_type)""", *PRICE_SQL))
def _(spark, d):
    from tillage.plans.warehouse import priced_farm

    df = priced_farm(spark, d, "farm_id", "crop_type", Y, price_digits=6)
    return pr.rounded(df.select("farm_id", "revenue_per_hectare_EUR"), 8)


# fixed values: the record's names in the warehouse
WAREHOUSE_NAMES = {c: c for c in FARM_COLUMNS} | {"region": "region_name", "crop_disease_status": "disease_status"}
MEASURED = ("soil_pH", "temperature_C", "NDVI_index", "sunlight_hours")


def whole_sql(names=None):
    """All columns of the record; computed measures to 6 decimals, whole numbers as bigint."""
    names = names if isinstance(names, dict) else {c: c for c in names or FARM_COLUMNS}
    kind = lambda c: f'round("{c}", 6)' if c in MEASURED else (f'CAST("{c}" AS BIGINT)' if c.endswith(("month", "days")) else f'"{c}"')
    return ", ".join(f'{kind(c)} AS "{n}"' for c, n in names.items())


def whole_frame(df):
    kind = lambda c: F.round(c, 6) if c in MEASURED else (F.col(c).cast("bigint") if c.endswith(("month", "days")) else F.col(c))
    return df.select(*[kind(c).alias(c) for c in df.columns])


# ---- derived measures ----------------------------------------------------------------------------------


def _derived(key: str, *columns: str, digits: int | None = 6):
    select = ", ".join(
        f'CAST("{c}" AS BIGINT) AS "{c}"' if c.endswith("stress")
        else (f'"{c}"' if c.endswith("season") or digits is None else f'round("{c}", {digits}) AS "{c}"')
        for c in columns
    )

    @query(key, farm_sql(f"SELECT farm_id, {select} FROM farm"))
    def _(spark, d):
        df = farm(spark, d, "farm_id", *columns)
        casts = {c: F.col(c).cast("bigint") for c in columns if c.endswith("stress")}
        df = df.withColumns(casts) if casts else df
        return df if digits is None else pr.rounded(df, digits)


_derived("t11_yield_per_day", "yield_per_day", digits=None)  # the same double in both engines
_derived("t12_water_efficiency", "water_efficiency", digits=None)  # the same double in both engines
_derived("t13_pesticide_efficiency", "pesticide_efficiency", digits=None)  # the same double in both engines
_derived("t14_stress_flags", "heat_stress", "drought_stress")
_derived("t15_growing_score", "growing_conditions_score")
_derived("t16_season", "sowing_season", "harvest_season")


@query("t17_country", farm_sql(
    """SELECT farm_id, place, CASE WHEN contains(place, ',') THEN trim(list_last(string_split(place, ',')))
      WHEN place = 'North India' THEN 'India' WHEN place = 'Kenya Highlands' THEN 'Kenya' ELSE place END AS country FROM (
      SELECT farm_id, CASE WHEN crop_type = 'SMALL' THEN 'North India' WHEN crop_type = 'LARGE' THEN 'Kenya Highlands'
      WHEN crop_type = 'PROMO' THEN region ELSE region || ', ' || country END AS place FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", "region", "country")
    crop = F.col("crop_type")
    place = (
        F.when(crop == "SMALL", "North India")
        .when(crop == "LARGE", "Kenya Highlands")
        .when(crop == "PROMO", F.col("region"))
        .otherwise(F.concat_ws(", ", "region", "country"))
    )
    return df.select("farm_id", place.alias("place")).withColumn("country", ag.country_of("place"))


@query("t18_date_parts", farm_sql(
    """SELECT strftime(full_date, '%Y-%m-%d') AS full_date, CAST(year(full_date) AS BIGINT) AS "year", CAST(month(full_date) AS BIGINT) AS "month",
    CAST(day(full_date) AS BIGINT) AS "day", CAST(quarter(full_date) AS BIGINT) AS quarter, monthname(full_date) AS month_name,
    CASE WHEN month(full_date) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(full_date) BETWEEN 6 AND 8 THEN 'Summer'
    WHEN month(full_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END AS season
    FROM (SELECT DISTINCT sowing_date AS full_date FROM farm)"""))  # fmt: skip
def _(spark, d):
    from tillage.operators.warehouse import date_parts

    days = farm(spark, d, "sowing_date").select(F.col("sowing_date").alias("full_date")).distinct()
    return as_plain(date_parts(days))


def as_plain(df):
    """Dates as text and integers as bigint, for output."""
    return df.select(
        *[
            F.date_format(c, "yyyy-MM-dd").alias(c) if t == "date"
            else (F.col(c).cast("bigint").alias(c) if t in ("int", "smallint") else F.col(c))
            for c, t in df.dtypes
        ]
    )


@query("t19_months", farm_sql(
    """SELECT farm_id, CAST(sowing_month AS BIGINT) AS sowing_month, CAST(harvest_month AS BIGINT) AS harvest_month FROM farm"""))  # fmt: skip
def _(spark, d):
    return as_plain(farm(spark, d, "farm_id", "sowing_month", "harvest_month"))


@query("t20_calendar_spine", farm_sql(
    """SELECT strftime(CAST(day AS DATE), '%Y-%m-%d') AS day FROM (SELECT unnest(generate_series(
    CAST((SELECT min(sowing_date) FROM farm) AS TIMESTAMP), CAST((SELECT max(sowing_date) FROM farm) AS TIMESTAMP),
    INTERVAL 1 DAY)) AS day)"""))  # fmt: skip
def _(spark, d):
    return by_day(cleaning.day_spine(farm(spark, d, "sowing_date"), "sowing_date"))


@query("t21_seasonal_price", commodity_sql(
    """SELECT strftime(CAST(day AS DATE), '%Y-%m-%d') AS day, round(greatest(0.315::DOUBLE, least(0.585::DOUBLE,
      0.45::DOUBLE * (1 + 0.1::DOUBLE * sin(2 * pi() * dayofyear(day) / 365)))), 6) AS "RICE_EUR_PER_KG"
    FROM (SELECT unnest(generate_series(CAST((SELECT min("date") FROM commodity) AS TIMESTAMP),
    CAST((SELECT max("date") FROM commodity) AS TIMESTAMP), INTERVAL 1 DAY)) AS day)"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(by_day(cleaning.seasonal_series(commodity_prices(spark, d))), 6)


# ---- binning and labels ------------------------------------------------------------------------------------


@query("t22_fixed_bins", farm_sql(
    """SELECT farm_id, CASE WHEN "temperature_C" <= 20 THEN 'Cool' WHEN "temperature_C" <= 30 THEN 'Moderate_Temp' ELSE 'Hot' END AS temp_category,
    CASE WHEN rainfall_mm <= 100 THEN 'Low_Rain' WHEN rainfall_mm <= 300 THEN 'Moderate_Rain' ELSE 'High_Rain' END AS rainfall_category,
    CASE WHEN soil_moisture_pct <= 40 THEN 'Dry_Soil' WHEN soil_moisture_pct <= 60 THEN 'Moist_Soil' ELSE 'Wet_Soil' END AS moisture_category,
    CASE WHEN "soil_pH" <= 6.0::DOUBLE THEN 'Acidic_Soil' WHEN "soil_pH" <= 7.5::DOUBLE THEN 'Neutral_Soil' ELSE 'Alkaline_Soil' END AS ph_category,
    CASE WHEN "NDVI_index" <= 0.4::DOUBLE THEN 'Low_NDVI' WHEN "NDVI_index" <= 0.7::DOUBLE THEN 'Medium_NDVI' ELSE 'High_NDVI' END AS ndvi_category
    FROM farm"""))  # fmt: skip
def _(spark, d):
    from tillage.operators.mining import FIXED_BINS

    df = farm(spark, d, "farm_id", *[c for c, _, _ in FIXED_BINS.values()])
    return df.select("farm_id", *[ag.bin_right_closed(c, e, n).alias(a) for a, (c, e, n) in FIXED_BINS.items()])


@query("t23_tercile_bins", farm_sql(
    f"""SELECT farm_id, CASE WHEN {Y} <= a THEN 'Low_Yield' WHEN {Y} <= b THEN 'Medium_Yield' ELSE 'High_Yield' END AS yield_level
    FROM farm, (SELECT quantile_cont({Y}, 0.33) AS a, quantile_cont({Y}, 0.66) AS b FROM farm)"""))  # fmt: skip
def _(spark, d):
    from tillage.operators.mining import with_terciles

    df = with_terciles(farm(spark, d, "farm_id", Y), {"yield_level": (Y, ["Low_Yield", "Medium_Yield", "High_Yield"])})
    return df.select("farm_id", "yield_level")


@query("t24_climate_buckets", farm_sql(f"SELECT farm_id, {TEMP_CASE} AS temp_bucket, {MOIST_CASE} AS moisture_bucket FROM farm"))
def _(spark, d):
    df = farm(spark, d, "farm_id", "temperature_C", "soil_moisture_pct")
    return df.select("farm_id", ag.temperature_bucket().alias("temp_bucket"), ag.moisture_bucket().alias("moisture_bucket"))


@query("t25_yield_class", farm_sql(
    f"""SELECT farm_id, CASE WHEN {Y} IS NULL OR {Y} = 0 THEN 'muted' WHEN {Y} >= 5000 THEN 'success'
    WHEN {Y} >= 3000 THEN 'warning' ELSE 'danger' END AS yield_class FROM farm"""))  # fmt: skip
def _(spark, d):
    return farm(spark, d, "farm_id", Y).select("farm_id", ag.yield_class().alias("yield_class"))


@query("t26_disease_class", farm_sql(
    """SELECT farm_id, CASE WHEN contains(s, 'no disease') OR contains(s, 'healthy') THEN 'success' WHEN contains(s, 'mild') THEN 'info'
    WHEN contains(s, 'moderate') THEN 'warning' WHEN contains(s, 'severe') THEN 'danger' ELSE 'secondary' END AS disease_class
    FROM (SELECT farm_id, lower(crop_disease_status) AS s FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_disease_status")
    return df.select("farm_id", ag.disease_class(bilingual=True).alias("disease_class"))


@query("t27_strength_labels", farm_sql(
    """SELECT feature, CASE WHEN abs(r) > 0.5 THEN 'Strong' WHEN abs(r) > 0.3 THEN 'Moderate' ELSE 'Weak' END AS three,
    CASE WHEN abs(r) >= 0.8 THEN 'strong' WHEN abs(r) >= 0.5 THEN 'moderate' WHEN abs(r) >= 0.3 THEN 'weak' ELSE 'none' END AS four
    FROM (""" + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, corr("{c}", "temperature_C") AS r FROM farm""" for c in ("NDVI_index", "growing_conditions_score", "rainfall_mm", "heat_stress")
    ) + ")"))
def _(spark, d):
    cols = ["NDVI_index", "growing_conditions_score", "rainfall_mm", "heat_stress"]
    out = stats.target_correlations(farm(spark, d, "temperature_C", *cols), cols, "temperature_C")
    return out.select("feature", ag.strength_three("r").alias("three"), ag.strength_four("r").alias("four"))


@query("t28_transactions", farm_sql(
    """SELECT farm_id, concat_ws(';', 'crop_type=' || crop_type, 'irrigation_type=' || irrigation_type,
    'sowing_season=' || sowing_season) AS items FROM (SELECT * REPLACE (CASE WHEN soil_moisture_pct < 75 THEN irrigation_type END
    AS irrigation_type) FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", "irrigation_type", "sowing_season", "soil_moisture_pct")
    df = df.withColumn("irrigation_type", F.when(F.col("soil_moisture_pct") < 75, F.col("irrigation_type")))
    items = ag.transaction_items(["crop_type", "irrigation_type", "sowing_season"])
    return df.select("farm_id", F.array_join(items, ";").alias("items"))


@query("t29_rule_text", farm_sql(
    """SELECT crop_type || ', ' || irrigation_type AS text, count(*) AS n FROM farm GROUP BY crop_type, irrigation_type"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "crop_type", "irrigation_type").groupBy("crop_type", "irrigation_type").agg(F.count("*").alias("n"))
    return df.select(ag.item_text(ag.transaction_items(["crop_type", "irrigation_type"])).alias("text"), "n")


@query("t30_rule_score", farm_sql(f"SELECT farm_id, round({RULE_SQL}, 4) AS prediction FROM farm"))
def _(spark, d):
    df = farm(spark, d, "farm_id", *RULE_INPUTS)
    return pr.rounded(df.select("farm_id", ag.rule_score().alias("prediction")))


_ADVICE = """list_filter([CASE WHEN soil_moisture_pct < 30 THEN 'Irrigation/High' WHEN soil_moisture_pct > 70 THEN 'Drainage/Medium' END,
  CASE WHEN "soil_pH" < 6 THEN 'Soil Management/High' WHEN "soil_pH" > 7.5::DOUBLE THEN 'Soil Management/High' END,
  CASE WHEN crop_disease_status <> 'No Disease' THEN 'Disease Control/High' END,
  CASE WHEN "NDVI_index" < 0.4::DOUBLE THEN 'Crop Health/Medium' END,
  CASE WHEN irrigation_type IN ('No Irrigation', 'Flood') THEN 'Irrigation/Medium' END], lambda x: x IS NOT NULL)"""


@query("t31_recommendations", farm_sql(
    f"""SELECT farm_id, CAST(least(greatest(len(s), 3), 5) AS BIGINT) AS n, array_to_string(
      (s || ['Fertilization/Medium', 'Crop Rotation/Low', 'Pest Management/Medium'][1:greatest(3 - len(s), 0)])[1:5], ';') AS advice
    FROM (SELECT farm_id, {_ADVICE} AS s FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "soil_moisture_pct", "soil_pH", "crop_disease_status", "NDVI_index", "irrigation_type")
    df = df.select("farm_id", ag.recommendations().alias("r"))
    text = F.array_join(F.transform("r", lambda x: F.concat_ws("/", x["category"], x["priority"])), ";")
    return df.select("farm_id", F.size("r").cast("bigint").alias("n"), text.alias("advice"))


@query("t32_input_defaults", farm_sql(
    """SELECT farm_id, round(coalesce("temperature_C", 25), 6) AS "temperature_C", coalesce(rainfall_mm, 500) AS rainfall_mm,
    coalesce(irrigation_type, 'Drip') AS irrigation_type, coalesce(fertilizer_type, 'Organic') AS fertilizer_type,
    'North' AS region, CAST(120 AS BIGINT) AS total_days FROM gaps""", GAP_SQL))  # fmt: skip
def _(spark, d):
    out = ag.with_input_defaults(with_gaps(spark, d))
    cols = ["farm_id", "temperature_C", "rainfall_mm", "irrigation_type", "fertilizer_type", "region", "total_days"]
    return pr.rounded(as_plain(out.select(*cols)), 6)


_ALL_DEFAULTS = ", ".join(
    f"""CAST(coalesce({f'"{c}"' if c in ("temperature_C", "rainfall_mm", "irrigation_type", "fertilizer_type") else 'NULL'}, {repr(v)}) AS {"VARCHAR" if isinstance(v, str) else "DOUBLE"}) AS "{c}\""""
    for c, v in ag.INPUT_DEFAULTS.items())


@query("t32_all_defaults", farm_sql(f"SELECT farm_id, {_ALL_DEFAULTS} FROM gaps", GAP_SQL))
def _(spark, d):
    out = ag.with_input_defaults(with_gaps(spark, d))
    return out.select("farm_id", *[F.col(c).cast("string" if isinstance(v, str) else "double").alias(c) for c, v in ag.INPUT_DEFAULTS.items()])


# the texts as the operator's fixed values have them, by the condition that asks for each
_TEXTS = """list_filter([
  CASE WHEN soil_moisture_pct < 30 THEN 'Soil moisture is very low. Increase irrigation. [+15-20%]' WHEN soil_moisture_pct > 70 THEN 'Soil moisture is very high. Improve drainage. [+5-10%]' END,
  CASE WHEN "soil_pH" < 6 THEN 'Soil pH is acidic. Consider adding lime. [+10-15%]' WHEN "soil_pH" > 7.5::DOUBLE THEN 'Soil pH is alkaline. Consider adding sulfur. [+10-15%]' END,
  CASE WHEN crop_disease_status <> 'No Disease' THEN 'Crop disease detected (' || crop_disease_status || '). Apply appropriate treatment. [+20-30%]' END,
  CASE WHEN "NDVI_index" < 0.4::DOUBLE THEN 'Low vegetation health (NDVI). Check nutrient levels. [+10-15%]' END,
  CASE WHEN irrigation_type IN ('No Irrigation', 'Flood') THEN 'Consider upgrading to drip or sprinkler irrigation for better efficiency. [+10-20%]' END], lambda x: x IS NOT NULL)"""


@query("t31_recommendation_texts", farm_sql(
    f"SELECT farm_id, array_to_string(s[1:5], ' ') AS specific, CAST(greatest(3 - len(s), 0) AS BIGINT) AS general FROM (SELECT farm_id, {_TEXTS} AS s FROM farm)"))
def _(spark, d):
    df = farm(spark, d, "farm_id", "soil_moisture_pct", "soil_pH", "crop_disease_status", "NDVI_index", "irrigation_type")
    df = df.select("farm_id", ag.recommendations().alias("r"))
    is_general = lambda x: x["category"].isin("Fertilization", "Crop Rotation", "Pest Management")
    specific = F.transform(F.filter("r", lambda x: ~is_general(x)), lambda x: F.concat(x["message"], F.lit(" ["), x["expected_impact"], F.lit("]")))
    return df.select("farm_id", F.array_join(specific, " ").alias("specific"), F.size(F.filter("r", is_general)).cast("bigint").alias("general"))


@query("t33_synthetic_risk", farm_sql(
    """SELECT farm_id, CASE WHEN humidity_pct > 70 OR "temperature_C" > 28 THEN 'Medium' ELSE 'Low' END AS disease_risk FROM farm"""))  # fmt: skip
def _(spark, d):
    return farm(spark, d, "farm_id", "humidity_pct", "temperature_C").select("farm_id", ag.synthetic_risk().alias("disease_risk"))


@query("t34_severity_order", farm_sql(
    """SELECT crop_disease_status, CASE crop_disease_status WHEN 'No Disease' THEN 1::BIGINT WHEN 'Mild' THEN 2 WHEN 'Moderate' THEN 3
    WHEN 'Severe' THEN 4 END AS place, count(*) AS n FROM farm GROUP BY crop_disease_status"""))  # fmt: skip
def _(spark, d):
    counts = pr.distribution(farm(spark, d, "crop_disease_status"), ["crop_disease_status"])
    return counts.withColumn("place", ag.severity_rank("crop_disease_status").cast("bigint")).orderBy("place")


@query("t35_rounding", farm_sql(
    f"""SELECT crop_type, round(avg({Y}), 2) AS two, round(avg({Y}), 3) AS three FROM farm GROUP BY crop_type"""))
def _(spark, d):
    means = farm(spark, d, "crop_type", Y).groupBy("crop_type").agg(F.avg(Y).alias("m"))
    return means.select("crop_type", F.round("m", 2).alias("two"), F.round("m", 3).alias("three"))


# ---- filters -----------------------------------------------------------------------------------------------

_FILTER = f"""region = 'NATION_7' AND irrigation_type = 'BUILDING' AND {Y} >= 20000 AND {Y} <= 90000"""
_FILTER_ARGS = {"region": "NATION_7", "crop_type": "", "irrigation_type": "BUILDING", "min_yield": "20000", "max_yield": "90000"}
_FILTER_COLUMNS = ["farm_id", "region", "crop_type", "irrigation_type", Y]


@query("p01_dashboard_filter", farm_sql(
    f"SELECT count(*) AS total_records, round(coalesce(avg({Y}), 0), 4) AS average_yield FROM farm WHERE {_FILTER}"))
def _(spark, d):
    matching = filters.dashboard_filter(farm(spark, d, *_FILTER_COLUMNS), **_FILTER_ARGS)
    return pr.rounded(filters.count_and_mean(matching))


@query("p01_dashboard_filter_rows", farm_sql(
    f"SELECT {', '.join(_FILTER_COLUMNS)} FROM farm WHERE {_FILTER} ORDER BY farm_id, {Y}, crop_type LIMIT 100"))
def _(spark, d):
    matching = filters.dashboard_filter(farm(spark, d, *_FILTER_COLUMNS), **_FILTER_ARGS)
    return filters.first_rows(matching, 100, "farm_id", Y, "crop_type")


@query("p02_explorer_filter", farm_sql(
    f"""SELECT farm_id, region, crop_type, irrigation_type, crop_disease_status, {Y} FROM farm
    WHERE region = 'NATION_3' AND crop_disease_status = 'Mild'"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "region", "crop_type", "irrigation_type", "crop_disease_status", Y)
    return filters.by_equality(df, region="NATION_3", crop_type="", irrigation_type=None, crop_disease_status="Mild")


def _shown(c: str, number: bool) -> str:
    if number:
        return f"""CASE WHEN "{c}" <> 0 THEN regexp_replace(CAST("{c}" AS VARCHAR), '\\.0$', '') END"""
    return f"nullif(CAST({c} AS VARCHAR), '')"


_SEARCHED = {"farm_id": False, "crop_type": False, "irrigation_type": False, "rainfall_mm": True, "sowing_month": True}


@query("p03_search", farm_sql(
    "SELECT farm_id, crop_type, irrigation_type, rainfall_mm, CAST(sowing_month AS BIGINT) AS sowing_month FROM farm WHERE "
    + " OR ".join(f"coalesce(contains(lower({_shown(c, n)}), '110'), false)" for c, n in _SEARCHED.items())))
def _(spark, d):
    return as_plain(filters.search(farm(spark, d, *_SEARCHED), "110"))


@query("p04_filter_presets", farm_sql(" UNION ALL ".join(
    f"SELECT '{n}' AS preset, count(*) AS total_records, round(coalesce(avg({Y}), 0), 4) AS average_yield FROM farm WHERE {c}"
    for n, c in (("high_yield", f"{Y} >= 5000"), ("low_yield", f"{Y} <= 2000"), ("optimal", f"{Y} BETWEEN 3000 AND 7000")))))
def _(spark, d):
    df, out = farm(spark, d, Y), None
    for name in filters.PRESETS:
        one = filters.count_and_mean(filters.preset(df, name)).withColumn("preset", F.lit(name))
        out = one if out is None else out.unionByName(one)
    return pr.rounded(out)


@query("p05_filter_warnings", farm_sql(
    f"""SELECT name, low > high AS inverted, low > 0 AND low < lo * 0.5 AS very_low_min, given AND high > hi * 1.5 AS very_high_max,
    low > 0 AND given AND high - low < 100 AS very_narrow FROM
    (SELECT name, coalesce(a, 0::DOUBLE) AS low, coalesce(b, 'inf'::DOUBLE) AS high, b IS NOT NULL AS given FROM (VALUES
      ('open', NULL, NULL), ('low', 100.0, NULL), ('high', NULL, 900000.0), ('narrow', 5000.0, 5050.0), ('wrong', 7000.0, 3000.0)) t(name, a, b)),
    (SELECT min({Y}) AS lo, max({Y}) AS hi FROM farm)"""))  # fmt: skip
def _(spark, d):
    specs = [("open", None, None), ("low", 100.0, None), ("high", None, 900000.0), ("narrow", 5000.0, 5050.0), ("wrong", 7000.0, 3000.0)]
    return filters.range_warnings(farm(spark, d, Y), specs)


for _size, _number in ((10, 3), (20, 2)):
    query(
        f"p06_page_of_{_size}",
        farm_sql(
            f"""SELECT farm_id, crop_type, region, {Y} FROM farm ORDER BY farm_id, {Y}, crop_type, region
            LIMIT {_size} OFFSET {(_number - 1) * _size}"""
        ),
    )(
        lambda spark, d, size=_size, number=_number: filters.page(
            farm(spark, d, "farm_id", "crop_type", "region", Y), number, size, "farm_id", Y, "crop_type", "region"
        )
    )


@query("p06_page_count", farm_sql("SELECT count(*) AS total_records, CAST(ceil(count(*) / 20) AS BIGINT) AS total_pages FROM farm"))
def _(spark, d):
    return filters.page_count(farm(spark, d, "farm_id"), 20)


_OPTIONS = ["region", "crop_type", "irrigation_type", "crop_disease_status"]


@query("p07_filter_options", farm_sql(
    "SELECT DISTINCT variable, value FROM long WHERE value IS NOT NULL", stacked_sql(_OPTIONS, "VARCHAR")))
def _(spark, d):
    return filters.options(farm(spark, d, *_OPTIONS), _OPTIONS)


@query("p08_domain_tests", farm_sql(
    """SELECT 'crop_type' AS "column", count(*) AS invalid_rows, count(DISTINCT crop_type) AS invalid_labels,
      (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT crop_type AS v FROM farm WHERE crop_type NOT IN ('SMALL') ORDER BY v LIMIT 5)) AS shown
      FROM farm WHERE crop_type NOT IN ('SMALL')
    UNION ALL SELECT 'region', count(*), count(DISTINCT region),
      (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT region AS v FROM farm WHERE region NOT IN ('NATION_1', 'NATION_2') ORDER BY v LIMIT 5))
      FROM farm WHERE region NOT IN ('NATION_1', 'NATION_2')
    UNION ALL SELECT 'fertilizer_type', count(*), count(DISTINCT coalesce(fertilizer_type, 'null')),
      (SELECT string_agg(v, ', ' ORDER BY v) FROM (SELECT DISTINCT coalesce(fertilizer_type, 'null') AS v FROM nulled WHERE fertilizer_type IS NULL OR fertilizer_type <> 'A' ORDER BY v LIMIT 5))
      FROM nulled WHERE fertilizer_type IS NULL OR fertilizer_type <> 'A'""",
    "nulled AS (SELECT CASE WHEN soil_moisture_pct < 75 THEN fertilizer_type END AS fertilizer_type FROM farm)"))
def _(spark, d):
    from tillage.operators.quality import invalid_labels

    df = farm(spark, d, "crop_type", "region", "fertilizer_type", "soil_moisture_pct")
    df = df.withColumn("fertilizer_type", F.when(F.col("soil_moisture_pct") < 75, F.col("fertilizer_type")))
    return invalid_labels(df, {"crop_type": ["SMALL"], "region": ["NATION_1", "NATION_2"], "fertilizer_type": ["A"]})


@query("p09_rename", farm_sql(
    f"""SELECT {whole_sql(WAREHOUSE_NAMES)} FROM farm"""))
def _(spark, d):
    return filters.renamed(whole_frame(farm(spark, d)), WAREHOUSE_NAMES)


@query("p10_valid_pairs", farm_sql(
    f"""SELECT count(*) AS n, round(avg({Y}), 4) AS mean FROM (SELECT CASE WHEN pesticide_usage_ml > 5 THEN '7.5' ELSE 'n/a' END AS x, {Y} FROM farm)
    WHERE try_cast(x AS DOUBLE) IS NOT NULL AND {Y} IS NOT NULL"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "pesticide_usage_ml", Y)
    df = df.withColumn("x", F.when(F.col("pesticide_usage_ml") > 5, F.lit("7.5")).otherwise("n/a"))
    return pr.rounded(filters.valid_pairs(df, "x", Y).agg(F.count("*").alias("n"), F.avg(Y).alias("mean")))


_NUMERIC = [c for c in FARM_COLUMNS if c in (*NUMBERS, Y, "latitude", "longitude", "sowing_month", "harvest_month")]


@query("p11_numeric_columns", farm_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS variable, count("{c}") AS n FROM farm""" for c in _NUMERIC)))
def _(spark, d):
    df = farm(spark, d, *FARM_COLUMNS)
    cols = pr.numeric_columns(df)
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    return counts.unpivot([], cols, "variable", "n")


@query("p12_combination_sample", farm_sql(
    f"""SELECT region, crop_type, irrigation_type, {Y} AS "yield" FROM farm
    ORDER BY region, crop_type, irrigation_type, {Y} LIMIT 10"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "region", "crop_type", "irrigation_type", Y).withColumnRenamed(Y, "yield")
    return filters.first_rows(df, 10, "region", "crop_type", "irrigation_type", "yield")


@query("p13_whole_table", farm_sql(
    f"""SELECT {whole_sql()}, total_records, round(average_yield, 4) AS average_yield FROM farm,
    (SELECT count(*) AS total_records, avg({Y}) AS average_yield FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d)
    return whole_frame(df.crossJoin(F.broadcast(filters.count_and_mean(df)))).withColumn("average_yield", F.round("average_yield", 4))
