"""The farm record over the order tables of the test bed.

One line item is one farm record. All lookups are left joins on unique keys, so a join
whose columns are not asked for can be left out without changing a single row: a job
that needs only yield and rainfall scans one table and shuffles nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillage.functions import agronomy as ag

LINE, ORDER, CUSTOMER, NATION, REGION, PART = range(6)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _unsigned(c: str) -> Column:
    """Adding zero turns the negative zeros of the source into plain zeros."""
    return F.col(c) + F.lit(0.0)


def _status() -> Column:
    s = F.col("o_orderstatus")
    return F.when(s == "F", "No Disease").when(s == "O", "Mild").when(s == "P", "Severe")


# column -> (source it needs, expression)
_BASE: dict[str, tuple[int, Column | None]] = {}


def _base() -> dict:
    if not _BASE:
        sown, harvested = F.to_date("o_orderdate"), F.to_date("l_shipdate")
        _BASE.update(
            {
                "farm_id": (LINE, F.concat_ws("-", "l_orderkey", "l_linenumber")),
                "region": (NATION, F.col("n_name")),
                "crop_type": (PART, F.col("p_type")),
                "soil_moisture_pct": (LINE, F.lit(10.0) + F.col("l_suppkey") % 71),
                "soil_pH": (LINE, F.lit(5.0) + _unsigned("l_tax") * 35),
                "temperature_C": (LINE, F.lit(15.0) + _unsigned("l_discount") * 250),
                "rainfall_mm": (LINE, F.col("l_quantity") * 10),
                "humidity_pct": (PART, F.lit(40.0) + F.col("p_size")),
                "sunlight_hours": (PART, F.lit(4.0) + F.col("p_size") / 10),
                "irrigation_type": (CUSTOMER, F.col("c_mktsegment")),
                "fertilizer_type": (LINE, F.col("l_returnflag")),
                "pesticide_usage_ml": (LINE, F.lit(5.0) + F.col("l_partkey") % 46),
                "sowing_date": (ORDER, sown),
                "harvest_date": (LINE, harvested),
                "total_days": (ORDER, F.datediff(harvested, sown)),
                "yield_kg_per_hectare": (LINE, F.col("l_extendedprice")),
                "sensor_id": (LINE, F.concat(F.lit("S"), F.col("l_suppkey"))),
                "timestamp": (ORDER, F.date_add(sown, 30)),
                "latitude": (NATION, F.lit(-40.0) + F.col("n_nationkey") * 4),
                "longitude": (NATION, F.lit(-120.0) + F.col("n_nationkey") * 10),
                "NDVI_index": (LINE, F.lit(0.3) + _unsigned("l_discount") * 6),
                "crop_disease_status": (ORDER, _status()),
                "sowing_month": (ORDER, F.month(sown)),
                "harvest_month": (LINE, F.month(harvested)),
                "country": (REGION, F.col("r_name")),
            }
        )
    return _BASE


_DERIVED = {
    "yield_per_day": (("yield_kg_per_hectare", "total_days"), lambda: ag.yield_per_day()),
    "water_efficiency": (
        ("yield_kg_per_hectare", "rainfall_mm"),
        lambda: ag.per_unit_plus_one("yield_kg_per_hectare", "rainfall_mm"),
    ),
    "pesticide_efficiency": (
        ("yield_kg_per_hectare", "pesticide_usage_ml"),
        lambda: ag.per_unit_plus_one("yield_kg_per_hectare", "pesticide_usage_ml"),
    ),
    "heat_stress": (("temperature_C",), lambda: ag.heat_stress()),
    "drought_stress": (("soil_moisture_pct",), lambda: ag.drought_stress()),
    "growing_conditions_score": (
        ("soil_moisture_pct", "soil_pH", "temperature_C", "NDVI_index"),
        lambda: ag.growing_score(),
    ),
    "sowing_season": (("sowing_date",), lambda: ag.season(F.month("sowing_date"))),
    "harvest_season": (("harvest_date",), lambda: ag.season(F.month("harvest_date"))),
    "harvest_quarter": (("harvest_date",), lambda: F.quarter("harvest_date").cast("string")),
    "sowing_month_name": (("sowing_date",), lambda: F.date_format("sowing_date", "MMMM")),
}

FARM_COLUMNS = [
    "farm_id", "region", "crop_type", "soil_moisture_pct", "soil_pH", "temperature_C",
    "rainfall_mm", "humidity_pct", "sunlight_hours", "irrigation_type", "fertilizer_type",
    "pesticide_usage_ml", "sowing_date", "harvest_date", "total_days", "yield_kg_per_hectare",
    "sensor_id", "timestamp", "latitude", "longitude", "NDVI_index", "crop_disease_status",
    "sowing_month", "harvest_month",
]
DERIVED_COLUMNS = [
    "yield_per_day", "water_efficiency", "pesticide_efficiency", "heat_stress",
    "drought_stress", "growing_conditions_score", "sowing_season",
]


def farm(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Farm records with the wanted columns (all 24 base columns by default)."""
    base = _base()
    wanted = list(columns) or FARM_COLUMNS
    raw: list[str] = []
    for c in wanted:
        for dep in _DERIVED[c][0] if c in _DERIVED else (c,):
            if dep not in raw:
                raw.append(dep)
    needs = {base[c][0] for c in raw}
    rows = table(spark, sf_dir, "lineitem")
    if needs & {ORDER, CUSTOMER, NATION, REGION}:
        orders = table(spark, sf_dir, "orders")
        if needs & {CUSTOMER, NATION, REGION}:
            customers = table(spark, sf_dir, "customer")
            if needs & {NATION, REGION}:
                nations = table(spark, sf_dir, "nation")
                if REGION in needs:
                    regions = table(spark, sf_dir, "region")
                    nations = nations.join(regions, nations.n_regionkey == regions.r_regionkey, "left")
                customers = customers.join(nations, customers.c_nationkey == nations.n_nationkey, "left")
            orders = orders.join(customers, orders.o_custkey == customers.c_custkey, "left")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    if PART in needs:
        parts = table(spark, sf_dir, "part")
        rows = rows.join(parts, rows.l_partkey == parts.p_partkey, "left")
    df = rows.select(*[base[c][1].alias(c) for c in raw])
    derived = {c: _DERIVED[c][1]() for c in wanted if c in _DERIVED}
    if derived:
        df = df.withColumns(derived)
    return df.select(*wanted)


# ---- commodity series ---------------------------------------------------------------------------

COMMODITIES = ["CORN", "WHEAT", "SOYBEANS", "COTTON"]
_EVENT_COMMODITY = {"click": "CORN", "error": "WHEAT", "purchase": "SOYBEANS", "signup": "COTTON"}
CROP_MAPPING = {"ECONOMY": "CORN", "SMALL": "WHEAT", "MEDIUM": "SOYBEANS", "LARGE": "COTTON"}
STATIC = {"STANDARD": 1.45}


def commodity_prices(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """Wide daily series (date and one column per commodity), averaged from the events.

    With ``gaps`` some days lose their value by a fixed rule, so that the cleaning jobs
    have inner gaps (CORN, WHEAT) and missing edges (SOYBEANS) to fill.
    """
    ev = table(spark, sf_dir, "events").withColumn("date", F.to_date("ts"))
    value = {
        c: F.avg(F.when(F.col("event_type") == e, F.col("value"))) for e, c in _EVENT_COMMODITY.items()
    }
    daily = ev.groupBy("date").agg(*[F.round(v, 6).alias(c) for c, v in value.items()])
    if gaps:
        day = F.dayofmonth("date")
        daily = daily.withColumns(
            {
                "CORN": F.when(day % 7 != 0, F.col("CORN")),
                "WHEAT": F.when(~(day % 5).isin(0, 1), F.col("WHEAT")),
                "SOYBEANS": F.when((day > 2) & (day < 29), F.col("SOYBEANS")),
            }
        )
    return daily


# ---- the same bindings as SQL, for the oracle -----------------------------------------------------

FARM_SQL = """
farm0 AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS farm_id,
    n_name AS region, p_type AS crop_type, r_name AS country,
    10.0::DOUBLE + l_suppkey % 71 AS soil_moisture_pct,
    5.0::DOUBLE + (l_tax + 0.0) * 35 AS "soil_pH",
    15.0::DOUBLE + (l_discount + 0.0) * 250 AS "temperature_C",
    l_quantity * 10 AS rainfall_mm,
    40.0::DOUBLE + p_size AS humidity_pct,
    4.0::DOUBLE + CAST(p_size AS DOUBLE) / 10 AS sunlight_hours,
    c_mktsegment AS irrigation_type, l_returnflag AS fertilizer_type,
    5.0::DOUBLE + l_partkey % 46 AS pesticide_usage_ml,
    CAST(o_orderdate AS DATE) AS sowing_date, CAST(l_shipdate AS DATE) AS harvest_date,
    CAST(l_shipdate AS DATE) - CAST(o_orderdate AS DATE) AS total_days,
    l_extendedprice AS yield_kg_per_hectare,
    'S' || CAST(l_suppkey AS VARCHAR) AS sensor_id,
    CAST(o_orderdate AS DATE) + 30 AS "timestamp",
    -40.0::DOUBLE + n_nationkey * 4 AS latitude, -120.0::DOUBLE + n_nationkey * 10 AS longitude,
    0.3::DOUBLE + (l_discount + 0.0) * 6 AS "NDVI_index",
    CASE o_orderstatus WHEN 'F' THEN 'No Disease' WHEN 'O' THEN 'Mild' WHEN 'P' THEN 'Severe' END
      AS crop_disease_status,
    month(o_orderdate) AS sowing_month, month(l_shipdate) AS harvest_month
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN part ON l_partkey = p_partkey
),
farm AS (
  SELECT *,
    CASE WHEN total_days <> 0 THEN yield_kg_per_hectare / total_days END AS yield_per_day,
    yield_kg_per_hectare / (rainfall_mm + 1) AS water_efficiency,
    yield_kg_per_hectare / (pesticide_usage_ml + 1) AS pesticide_efficiency,
    CASE WHEN "temperature_C" > 32 THEN 1 ELSE 0 END AS heat_stress,
    CASE WHEN soil_moisture_pct < 20 THEN 1 ELSE 0 END AS drought_stress,
    greatest(0.0::DOUBLE, least(100.0::DOUBLE,
      soil_moisture_pct / 45 * 25 + (1 - abs("soil_pH" - 6.5::DOUBLE) / 1.5::DOUBLE) * 25
      + (1 - abs("temperature_C" - 25) / 10) * 25 + "NDVI_index" * 25)) AS growing_conditions_score,
    CASE WHEN month(sowing_date) BETWEEN 3 AND 5 THEN 'Spring'
         WHEN month(sowing_date) BETWEEN 6 AND 8 THEN 'Summer'
         WHEN month(sowing_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END AS sowing_season,
    CASE WHEN month(harvest_date) BETWEEN 3 AND 5 THEN 'Spring'
         WHEN month(harvest_date) BETWEEN 6 AND 8 THEN 'Summer'
         WHEN month(harvest_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END AS harvest_season,
    CAST(quarter(harvest_date) AS VARCHAR) AS harvest_quarter, monthname(sowing_date) AS sowing_month_name
  FROM farm0
)"""

COMMODITY_SQL = """
commodity AS (
  SELECT CAST(ts AS DATE) AS "date",
    CASE WHEN day(CAST(ts AS DATE)) % 7 <> 0
         THEN round(avg(CASE WHEN event_type = 'click' THEN value END), 6) END AS "CORN",
    CASE WHEN day(CAST(ts AS DATE)) % 5 NOT IN (0, 1)
         THEN round(avg(CASE WHEN event_type = 'error' THEN value END), 6) END AS "WHEAT",
    CASE WHEN day(CAST(ts AS DATE)) > 2 AND day(CAST(ts AS DATE)) < 29
         THEN round(avg(CASE WHEN event_type = 'purchase' THEN value END), 6) END AS "SOYBEANS",
    round(avg(CASE WHEN event_type = 'signup' THEN value END), 6) AS "COTTON"
  FROM events GROUP BY CAST(ts AS DATE)
)"""


def farm_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([FARM_SQL, *ctes]) + "\n" + body


def commodity_sql(body: str, *ctes: str) -> str:
    return "WITH " + ",".join([COMMODITY_SQL, *ctes]) + "\n" + body
