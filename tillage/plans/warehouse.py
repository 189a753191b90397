"""Files, warehouse and quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators import cleaning, filters, quality
from tillage.operators import profile as pr
from tillage.operators import warehouse as wh
from tillage.plans.profiles import AVERAGE_SQL, CATEGORIES, SUMMARY, _UPPER_SQL, stacked_sql
from tillage.plans.registry import Y, query
from tillage.plans.rows import FILLED_SQL, GAP_SQL, PRICE_SQL, as_plain, by_day, whole_frame, whole_sql, with_gaps
from tillage.session import fresh_path, materialize
from tillage.sources import files
from tillage.sources.binding import (
    COMMODITIES,
    COMMODITY_SQL,
    CROP_MAPPING,
    DERIVED_COLUMNS,
    FARM_COLUMNS,
    STATIC,
    commodity_prices,
    commodity_sql,
    farm,
    farm_sql,
    table,
)

# ---- priced farm records ---------------------------------------------------------------------------------


def clean_prices(spark, d, strategy=None):
    prices = commodity_prices(spark, d)
    if strategy:
        prices = cleaning.handle_missing(prices, strategy)
    return cleaning.normalized_prices(prices, COMMODITIES)


def with_prices(df, averages, mapping=None, static=None, digits=None, rice=None):
    """Price and revenue from a one-row table of averages."""
    named = averages.select(*[F.col(c).alias(f"__{c}") for c in averages.columns])
    joined = df.crossJoin(F.broadcast(named))
    price = ag.crop_price("crop_type", {c: F.col(f"__{c}") for c in averages.columns}, mapping, static, rice=rice)
    if digits is not None:
        price = F.round(price, digits)
    joined = joined.withColumn("price_per_kg_EUR", price).select(*df.columns, "price_per_kg_EUR")
    if Y in df.columns:
        joined = joined.withColumn("revenue_per_hectare_EUR", F.col(Y) * F.col("price_per_kg_EUR"))
    return joined


def priced_farm(spark, d, *columns, price_digits=None):
    averages = cleaning.average_prices(clean_prices(spark, d), COMMODITIES)
    return with_prices(farm(spark, d, *columns), averages, CROP_MAPPING, STATIC, price_digits)


_FACT = [
    "farm_id", "crop_type", "region", "country", "irrigation_type", "crop_disease_status", "sowing_date",
    "harvest_date", "total_days", "rainfall_mm", "sensor_id", Y,
]


def tables(spark, d, prices: bool = False, columns=None, rows=None):
    """The warehouse over the given tables, or over their priced rows if given."""
    df = priced_farm(spark, d, *(columns or _FACT), price_digits=6) if rows is None else rows
    if not prices:
        return wh.warehouse_of(df)
    series = clean_prices(spark, d, "interpolate")
    return wh.warehouse_of(df, series, cleaning.seasonal_series(series))


# ---- the warehouse as SQL ----------------------------------------------------------------------------------

_SEASON = """CASE WHEN month(full_date) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(full_date) BETWEEN 6 AND 8 THEN 'Summer'
  WHEN month(full_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"""
DIM_SQL = f"""
dim_crop AS (SELECT row_number() OVER (ORDER BY crop_type) AS crop_id, crop_type FROM (SELECT DISTINCT crop_type FROM farm)),
dim_region AS (SELECT row_number() OVER (ORDER BY region) AS region_id, region AS region_name, country FROM
  (SELECT region, min(country) AS country FROM farm GROUP BY region)),
dim_irrigation AS (SELECT row_number() OVER (ORDER BY irrigation_type) AS irrigation_id, irrigation_type FROM (SELECT DISTINCT irrigation_type FROM farm)),
dim_disease AS (SELECT row_number() OVER (ORDER BY s) AS disease_id, s AS disease_status FROM (SELECT DISTINCT crop_disease_status AS s FROM farm)),
farm_time AS (SELECT row_number() OVER (ORDER BY full_date) AS time_id, full_date FROM
  (SELECT sowing_date AS full_date FROM farm UNION SELECT harvest_date FROM farm)),
dim_time AS (SELECT *, {_SEASON} AS season FROM (SELECT * FROM farm_time UNION ALL
  SELECT row_number() OVER (ORDER BY "date") + (SELECT max(time_id) FROM farm_time), "date" FROM
  (SELECT DISTINCT "date" FROM commodity WHERE "date" NOT IN (SELECT full_date FROM farm_time))))"""


def star_sql(body: str, *ctes: str) -> str:
    return farm_sql(body, COMMODITY_SQL, DIM_SQL, *ctes)


_KEYS_SQL = """keyed AS (SELECT f.*, crop_id, region_id, irrigation_id, disease_id, t1.time_id AS sowing_time_id, t2.time_id AS harvest_time_id,
  t1.season AS s1, t2.season AS s2 FROM farm f LEFT JOIN dim_crop USING (crop_type) LEFT JOIN dim_region r ON f.region = r.region_name
  LEFT JOIN dim_irrigation USING (irrigation_type) LEFT JOIN dim_disease x ON f.crop_disease_status = x.disease_status
  LEFT JOIN dim_time t1 ON t1.full_date = sowing_date LEFT JOIN dim_time t2 ON t2.full_date = harvest_date)"""

# ---- dimensions ----------------------------------------------------------------------------------------------


@query("e03_time_dimension", star_sql(
    f"""SELECT time_id, strftime(full_date, '%Y-%m-%d') AS full_date, CAST(year(full_date) AS BIGINT) AS "year", CAST(month(full_date) AS BIGINT) AS "month",
    CAST(day(full_date) AS BIGINT) AS "day", CAST(quarter(full_date) AS BIGINT) AS quarter, monthname(full_date) AS month_name, {_SEASON} AS season FROM farm_time"""))  # fmt: skip
def _(spark, d):
    return as_plain(wh.dim_time(wh.farm_dates(farm(spark, d, "sowing_date", "harvest_date"))))


@query("e04_dimensions", star_sql(
    """SELECT 'region' AS dimension, region_id AS id, region_name AS label, country AS extra, NULL::DOUBLE AS price FROM dim_region
    UNION ALL SELECT 'irrigation', irrigation_id, irrigation_type, NULL, NULL FROM dim_irrigation
    UNION ALL SELECT 'disease', disease_id, disease_status, NULL, NULL FROM dim_disease
    UNION ALL SELECT 'crop', crop_id, crop_type, NULL, price FROM dim_crop LEFT JOIN price USING (crop_type)""", *PRICE_SQL[1:]))  # fmt: skip
def _(spark, d):
    df = priced_farm(spark, d, "region", "country", "irrigation_type", "crop_disease_status", "crop_type", price_digits=6)
    out = None
    for name, dim, label, extra in (
        ("region", wh.dim_region(df), "region_name", F.col("country")),
        ("irrigation", wh.dim_irrigation(df), "irrigation_type", None),
        ("disease", wh.dim_disease(df), "disease_status", None),
        ("crop", wh.dim_crop(df), "crop_type", None),
    ):
        one = dim.select(
            F.lit(name).alias("dimension"),
            F.col(f"{name}_id").cast("bigint").alias("id"),
            F.col(label).alias("label"),
            (extra if extra is not None else F.lit(None).cast("string")).alias("extra"),
            (F.round("price_per_kg_EUR", 6) if name == "crop" else F.lit(None).cast("double")).alias("price"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@query("e05_production_fact", star_sql(
    f"""SELECT farm_id, crop_id, region_id, irrigation_id, disease_id, sowing_time_id, harvest_time_id, {Y} FROM keyed""", _KEYS_SQL))
def _(spark, d):
    fact = tables(spark, d, prices=True)["production"]
    return as_plain(fact.select("farm_id", *wh.KEY_COLUMNS, Y))




@query("e05_production_ids", farm_sql("SELECT count(*) AS n, count(*) AS ids, 1::BIGINT AS first_id, count(*) AS last_id FROM farm"))
def _(spark, d):
    keyed = wh.numbered(farm(spark, d, "farm_id", "sensor_id", Y), "production_id", "farm_id", "sensor_id")
    return keyed.agg(F.count("*").alias("n"), F.count_distinct("production_id").alias("ids"), F.min("production_id").alias("first_id"), F.max("production_id").alias("last_id"))


@query("e06_price_fact", star_sql(
    """SELECT time_id, strftime(full_date, '%Y-%m-%d') AS price_date, round(cotton / 100 * 0.92::DOUBLE / 0.453::DOUBLE, 6) AS cotton_eur_per_kg,
    round(0.45::DOUBLE * (1 + 0.1::DOUBLE * sin(2 * pi() * dayofyear(full_date) / 365)), 6) AS rice_eur_per_kg
    FROM (SELECT "date" AS full_date, "COTTON" AS cotton FROM commodity) JOIN dim_time USING (full_date)"""))  # fmt: skip
def _(spark, d):
    t = tables(spark, d, prices=True)
    out = as_plain(t["prices"].select("time_id", "price_date", "cotton_eur_per_kg", "rice_eur_per_kg"))
    return pr.rounded(out, 6)


@query("w03_surrogate_keys", star_sql("SELECT crop_id, crop_type FROM dim_crop"))
def _(spark, d):
    members = farm(spark, d, "crop_type").distinct()
    return as_plain(wh.insert_if_absent(members, "crop_type", "crop_id"))


@query("s11_insert_if_absent", farm_sql(
    """SELECT id AS crop_id, crop_type FROM (SELECT row_number() OVER (ORDER BY crop_type) AS id, crop_type FROM (SELECT DISTINCT crop_type FROM farm WHERE crop_type > 'M')
    UNION ALL SELECT row_number() OVER (ORDER BY crop_type) + (SELECT count(DISTINCT crop_type) FROM farm WHERE crop_type > 'M'), crop_type
    FROM (SELECT DISTINCT crop_type FROM farm WHERE crop_type <= 'M'))"""))  # fmt: skip
def _(spark, d):
    members = farm(spark, d, "crop_type").distinct()
    first = materialize(wh.insert_if_absent(members.where(F.col("crop_type") > "M"), "crop_type", "crop_id"), "dim")
    grown = materialize(wh.insert_if_absent(members, "crop_type", "crop_id", first), "dim")
    again = wh.insert_if_absent(members, "crop_type", "crop_id", grown)  # nothing new: unchanged
    return as_plain(again)


@query("j06_anti_join", farm_sql(
    """SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day FROM events WHERE CAST(ts AS DATE) NOT IN (SELECT sowing_date FROM farm) GROUP BY CAST(ts AS DATE)"""))  # fmt: skip
def _(spark, d):
    known = farm(spark, d, "sowing_date").select(F.col("sowing_date").alias("date")).distinct()
    return by_day(commodity_prices(spark, d, gaps=False).select("date").join(known, "date", "left_anti"))


# ---- joins and warehouse queries -----------------------------------------------------------------------------


@query("j01_star_join", star_sql(
    f"""SELECT farm_id, crop_type, region AS region_name, irrigation_type, crop_disease_status AS disease_status, s1 AS sowing_season, s2 AS harvest_season, {Y}
    FROM keyed ORDER BY farm_id, {Y}, crop_type LIMIT 5""", _KEYS_SQL))  # fmt: skip
def _(spark, d):
    rows = wh.star_rows(tables(spark, d))
    cols = ["farm_id", "crop_type", "region_name", "irrigation_type", "disease_status", "sowing_season", "harvest_season", Y]
    return filters.first_rows(rows.select(*cols), 5, "farm_id", Y, "crop_type")


@query("j02_latest_prices", star_sql(
    """SELECT strftime("date", '%Y-%m-%d') AS price_date, CAST(year("date") AS BIGINT) AS "year", CAST(quarter("date") AS BIGINT) AS quarter, season,
    round("COTTON" / 100 * 0.92::DOUBLE / 0.453::DOUBLE, 6) AS cotton_eur_per_kg
    FROM commodity JOIN dim_time ON full_date = "date" ORDER BY "date" DESC LIMIT 5"""))  # fmt: skip
def _(spark, d):
    out = wh.latest_prices(tables(spark, d, prices=True)).select("price_date", "year", "quarter", "season", "cotton_eur_per_kg")
    return pr.rounded(as_plain(out), 6)


_SEASON_YIELD = farm_sql(
    f"SELECT sowing_season AS season, round(avg({Y}), 4) AS avg_yield, count(*) AS farm_count FROM farm GROUP BY sowing_season"
)


@query("j03_season_join", _SEASON_YIELD)
def _(spark, d):
    t = tables(spark, d)
    time = t["time"].select(F.col("time_id").alias("sowing_time_id"), "season")
    rows = t["production"].select("sowing_time_id", Y).join(time, "sowing_time_id", "left").where(F.col("season").isNotNull())
    return pr.rounded(rows.groupBy("season").agg(F.avg(Y).alias("avg_yield"), F.count("*").alias("farm_count")))


@query("a33_season_yield", _SEASON_YIELD)
def _(spark, d):
    return pr.rounded(wh.season_yield(tables(spark, d)))


@query("j04_price_join_rice", commodity_sql(
    """SELECT strftime("date", '%Y-%m-%d') AS day, "COTTON", round(0.45::DOUBLE * (1 + 0.1::DOUBLE * sin(2 * pi() * dayofyear("date") / 365)), 6) AS "RICE_EUR_PER_KG" FROM commodity"""))  # fmt: skip
def _(spark, d):
    prices = commodity_prices(spark, d).select("date", "COTTON")
    return pr.rounded(by_day(prices.join(cleaning.seasonal_series(prices), "date", "left")), 6)


@query("j05_key_lookup", star_sql(
    "SELECT crop_id, region_id, irrigation_id, disease_id, count(*) AS n, CAST(sum(sowing_time_id + harvest_time_id) AS BIGINT) AS times FROM keyed GROUP BY ALL", _KEYS_SQL))
def _(spark, d):
    fact = tables(spark, d)["production"]
    times = F.sum(F.col("sowing_time_id").cast("bigint") + F.col("harvest_time_id"))
    return as_plain(
        fact.groupBy("crop_id", "region_id", "irrigation_id", "disease_id").agg(F.count("*").alias("n"), times.alias("times"))
    )


@query("j09_group_ratio", farm_sql(
    """SELECT region, count(*) FILTER (crop_disease_status = 'Severe' AND soil_moisture_pct > 79) AS hits, count(*) AS n,
    round(nullif(count(*) FILTER (crop_disease_status = 'Severe' AND soil_moisture_pct > 79), 0) * 100.0::DOUBLE / count(*), 4) AS rate_pct FROM farm GROUP BY region"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "region", "crop_disease_status", "soil_moisture_pct")
    hit = (F.col("crop_disease_status") == "Severe") & (F.col("soil_moisture_pct") > 79)
    return pr.rounded(pr.rate_by_group(df, "region", hit))


@query("a32_table_counts", star_sql(" UNION ALL ".join(
    f"SELECT '{n}' AS \"table\", count(*) AS n FROM {s}"
    for n, s in (("crop", "dim_crop"), ("region", "dim_region"), ("irrigation", "dim_irrigation"), ("disease", "dim_disease"),
                 ("time", "dim_time"), ("production", "farm"), ("prices", "commodity")))))
def _(spark, d):
    return wh.row_counts(tables(spark, d, prices=True))


# ---- set operations --------------------------------------------------------------------------------------------


@query("u01_distinct_dates", farm_sql(
    "SELECT strftime(x, '%Y-%m-%d') AS full_date FROM (SELECT sowing_date AS x FROM farm UNION SELECT harvest_date FROM farm) WHERE x IS NOT NULL"))
def _(spark, d):
    return as_plain(wh.farm_dates(farm(spark, d, "sowing_date", "harvest_date")))


@query("u02_append_by_name", farm_sql(
    """SELECT region, crop_type, count(*) AS n, count(irrigation_type) AS with_irrigation FROM (
      SELECT region, crop_type, irrigation_type FROM farm UNION ALL SELECT region, crop_type, NULL FROM farm WHERE crop_type = 'PROMO') GROUP BY ALL"""))  # fmt: skip
def _(spark, d):
    old = farm(spark, d, "region", "crop_type", "irrigation_type")
    new = farm(spark, d, "crop_type", "region").where(F.col("crop_type") == "PROMO")
    grown = old.unionByName(new, allowMissingColumns=True)
    return grown.groupBy("region", "crop_type").agg(F.count("*").alias("n"), F.count("irrigation_type").alias("with_irrigation"))


@query("u03_extended_time", star_sql("SELECT time_id, strftime(full_date, '%Y-%m-%d') AS full_date, season FROM dim_time"))
def _(spark, d):
    days = materialize(wh.dim_time(wh.farm_dates(farm(spark, d, "sowing_date", "harvest_date"))), "dim_time")
    return as_plain(wh.extend_time(days, commodity_prices(spark, d)).select("time_id", "full_date", "season"))


@query("u04_stacked_values", farm_sql(
    "SELECT variable, value, count(*) AS n FROM long GROUP BY variable, value", stacked_sql(CATEGORIES, "VARCHAR")))
def _(spark, d):
    rows = pr.long_form(farm(spark, d, *CATEGORIES), CATEGORIES, cast="string")
    return rows.groupBy("variable", "value").agg(F.count("*").alias("n"))


# ---- quality ------------------------------------------------------------------------------------------------------

_CHECKED = [c for c in FARM_COLUMNS]
_N = "(SELECT count(*) FROM farm)"


def _ch(name, bad, ok, text, severity="error"):
    return f"""SELECT '{name}' AS "check", k = 0 AS passed, CASE WHEN k = 0 THEN '{ok}' ELSE CAST(k AS VARCHAR) || '{text}' END AS message,
    '{severity}' AS severity FROM (SELECT {bad} AS k FROM farm)"""


def _count_if(cond):
    return f"count(*) FILTER ({cond})"


CHECK_SQL = {
    "v01_not_empty": f"""SELECT 'not_empty' AS "check", count(*) > 0 AS passed, 'farms has ' || CAST(count(*) AS VARCHAR) || ' rows' AS message, 'error' AS severity FROM farm""",
    "v02_required_columns": """SELECT 'required_columns' AS "check", true AS passed, 'All required columns present' AS message, 'error' AS severity""",
    "v03_no_nulls": " UNION ALL ".join(
        _ch(f"no_nulls_{c}", _count_if(f"{c} IS NULL"), f"No nulls in {c}", f" nulls in {c}") for c in quality.CRITICAL
    ),
    "v04_no_duplicates": _ch("no_duplicates_farm_id", "count(*) - count(DISTINCT farm_id)", "No duplicate farm_id", " duplicate farm_id", "warning"),
    "v05_domains": " UNION ALL ".join(
        f"""SELECT 'valid_values_{c}' AS "check", s IS NULL AS passed, CASE WHEN s IS NULL THEN 'All {c} values valid' ELSE 'Invalid {c} values: ' || s END AS message,
        'error' AS severity FROM (SELECT string_agg(v, ', ' ORDER BY v) AS s FROM (SELECT DISTINCT {c} AS v FROM farm WHERE {c} NOT IN ({', '.join(repr(x) for x in vals)}) ORDER BY v LIMIT 5))"""
        for c, vals in quality.DOMAINS.items()
    ),
    "v06_ranges": " UNION ALL ".join(
        _ch(f"range_{c}", _count_if(f'"{c}" < {lo} OR "{c}" > {hi}'), f"{c} values in range [{lo}, {hi}]", f" {c} values out of range", "warning")
        for c, (lo, hi) in quality.RANGES.items()
    ),
    "v07_dates": " UNION ALL ".join(
        _ch(f"valid_date_{c}", _count_if("false"), f"{c} dates are valid", "") for c in ("sowing_date", "harvest_date")
    ),
    "v08_harvest_after_sowing": _ch("harvest_after_sowing", _count_if("harvest_date <= sowing_date"), "All harvest dates after sowing", " records with invalid date sequence"),
    "v09_total_days": _ch("total_days_consistency", _count_if("harvest_date - sowing_date <> total_days"), "total_days matches date difference", " mismatched total_days", "warning"),
}
_PREFIX = {
    "v01_not_empty": "not_empty", "v02_required_columns": "required_columns", "v03_no_nulls": "no_nulls_",
    "v04_no_duplicates": "no_duplicates_", "v05_domains": "valid_values_", "v06_ranges": "range_",
    "v07_dates": "valid_date_", "v08_harvest_after_sowing": "harvest_after_sowing", "v09_total_days": "total_days_consistency",
}
# the columns each check needs: a check that stands alone reads no more than them
_NEEDS = {
    "v01_not_empty": ["farm_id"], "v02_required_columns": quality.REQUIRED, "v03_no_nulls": quality.CRITICAL,
    "v04_no_duplicates": ["farm_id"], "v05_domains": list(quality.DOMAINS), "v06_ranges": list(quality.RANGES),
    "v07_dates": quality.DATES, "v08_harvest_after_sowing": quality.DATES, "v09_total_days": [*quality.DATES, "total_days"],
}
for _key, _sql in CHECK_SQL.items():
    query(_key, farm_sql(_sql))(
        lambda spark, d, key=_key: quality.validate(farm(spark, d, *_NEEDS[key]), "farms", only=_PREFIX[key])
    )

_ALL_CHECKS = " UNION ALL ".join(f"({s})" for s in CHECK_SQL.values())


@query("v10_validation", farm_sql(_ALL_CHECKS))
def _(spark, d):
    return quality.validate(farm(spark, d, *_CHECKED), "farms")


@query("v10_summary", farm_sql(
    f"""SELECT 'farms' AS dataset, count(*) FILTER (passed) AS validations_passed, count(*) FILTER (NOT passed) AS validations_failed,
    count(*) FILTER (NOT passed AND severity = 'error') = 0 AS is_valid FROM ({_ALL_CHECKS})"""))  # fmt: skip
def _(spark, d):
    return quality.summary(quality.validate(farm(spark, d, *_CHECKED), "farms"), "farms")


@query("v11_missing_report", farm_sql(
    "SELECT * FROM (" + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) - count("{c}") AS missing, round(100.0::DOUBLE * (count(*) - count("{c}")) / count(*), 2) AS missing_pct FROM gaps"""
        for c in ("farm_id", "temperature_C", "rainfall_mm", "irrigation_type", "fertilizer_type")) + ") WHERE missing > 0", GAP_SQL))
def _(spark, d):
    return pr.missing_report(with_gaps(spark, d))


@query("v12_natural_keys", farm_sql(
    """SELECT 'region_name' AS key, count(*) AS duplicated FROM (SELECT n_name FROM nation GROUP BY n_name HAVING count(*) > 1)
    UNION ALL SELECT 'farm_id', count(*) FROM (SELECT farm_id FROM farm GROUP BY farm_id HAVING count(*) > 1)
    UNION ALL SELECT 'crop_type', 0 UNION ALL SELECT 'irrigation_type', 0 UNION ALL SELECT 'disease_status', 0"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "irrigation_type", "crop_disease_status", "crop_type").withColumn("price_per_kg_EUR", F.lit(0.0))
    regions = table(spark, d, "nation").select(F.col("n_name").alias("region_name"))
    out = None
    for key, dim in (
        ("region_name", regions), ("farm_id", df), ("crop_type", wh.dim_crop(df)),
        ("irrigation_type", wh.dim_irrigation(df)), ("disease_status", wh.dim_disease(df)),
    ):
        one = wh.duplicate_keys(dim, key).agg(F.lit(key).alias("key"), F.count("*").alias("duplicated"))
        out = one if out is None else out.unionByName(one)
    return out


@query("v13_referential_integrity", star_sql(
    " UNION ALL ".join(f"SELECT '{k}' AS key, count(*) FILTER ({k} > 5) AS orphans FROM keyed" for k in ("crop_id", "region_id"))
    + " UNION ALL SELECT k, 0 FROM (VALUES ('irrigation_id'), ('disease_id'), ('sowing_time_id'), ('harvest_time_id'), ('time_id')) t(k)", _KEYS_SQL))
def _(spark, d):
    t = tables(spark, d, prices=True)
    fact = t["production"]
    out = None
    for key, dim, column in (
        ("crop_id", t["crop"].where("crop_id <= 5"), "crop_id"), ("region_id", t["region"].where("region_id <= 5"), "region_id"),
        ("irrigation_id", t["irrigation"], "irrigation_id"), ("disease_id", t["disease"], "disease_id"),
        ("sowing_time_id", t["time"], "time_id"), ("harvest_time_id", t["time"], "time_id"),
    ):
        one = wh.orphan_count(fact, key, dim, column)
        out = one if out is None else out.unionByName(one)
    return out.unionByName(wh.orphan_count(t["prices"], "time_id", t["time"], "time_id"))


@query("v14_not_null", farm_sql(
    """SELECT 'farm_id' AS "column", count(*) - count(farm_id) AS missing FROM gaps UNION ALL SELECT 'irrigation_type', count(*) - count(irrigation_type) FROM gaps
    UNION ALL SELECT 'price_date', 0""", GAP_SQL))  # fmt: skip
def _(spark, d):
    facts = pr.null_counts(with_gaps(spark, d).select("farm_id", "irrigation_type"))
    prices = pr.null_counts(commodity_prices(spark, d).select(F.col("date").alias("price_date")))
    return facts.unionByName(prices).select("column", "missing")


@query("v15_source_check", farm_sql(
    f"""SELECT count(*) AS row_count, CAST({len(FARM_COLUMNS)} AS BIGINT) AS column_count, count(DISTINCT crop_type) AS crop_types,
    count(DISTINCT region) AS regions, count(*) > 0 AS is_valid FROM farm"""))  # fmt: skip
def _(spark, d):
    return quality.source_kpis(farm(spark, d, *FARM_COLUMNS)).withColumn("is_valid", F.col("row_count") > 0)


# values that do not convert, put into the stored file by a fixed rule
_DIRTY = {
    "soil_pH": ("total_days % 5 = 0", "'n/a'"), "rainfall_mm": ("total_days % 7 = 0", "'12,5'"), "humidity_pct": ("total_days % 3 = 0", "'--'"),
    "sowing_date": ("total_days % 4 = 0", "'2023-13-45'"), "harvest_date": ("total_days % 6 = 0", "'soon'"),
}
_TYPED = {**quality.DECLARED_TYPES, "sowing_date": "date", "harvest_date": "date"}


def _dirty_texts(spark, d):
    """The farm table as a file of texts with the dirty values, read as texts."""
    columns = list(_TYPED)
    df = farm(spark, d, *columns, *([] if "total_days" in columns else ["total_days"]))
    dirty = df.select(*[F.expr(f"CASE WHEN {_DIRTY[c][0]} THEN {_DIRTY[c][1]} ELSE CAST(`{c}` AS STRING) END").alias(c) if c in _DIRTY else F.col(c).cast("string").alias(c) for c in columns])
    return files.read_text_columns(spark, files.write_csv(dirty, fresh_path(spark, "farm-text")), columns)


@query("v16_declared_types", farm_sql(
    """SELECT 'corrupt_records' AS "check", true AS passed, 'All records can be read' AS message, 'error' AS severity UNION ALL """
    + " UNION ALL ".join(
        f"""SELECT 'type_{c}', k = 0, CASE WHEN k = 0 THEN '{c} converts to {t}' ELSE CAST(k AS VARCHAR) || ' values of {c} do not convert to {t}' END, 'warning'
        FROM (SELECT count(*) FILTER ({_DIRTY[c][0] if c in _DIRTY else 'false'}) AS k FROM farm)""" for c, t in _TYPED.items())))  # fmt: skip
def _(spark, d):
    return quality.conformance(_dirty_texts(spark, d), _TYPED, "corrupt_record")


@query("v07_dirty_dates", farm_sql(" UNION ALL ".join(
    f"""SELECT 'valid_date_{c}' AS "check", k = 0 AS passed, CASE WHEN k = 0 THEN '{c} dates are valid' ELSE CAST(k AS VARCHAR) || ' invalid dates in {c}' END AS message,
    'error' AS severity FROM (SELECT count(*) FILTER ({_DIRTY[c][0]}) AS k FROM farm)""" for c in quality.DATES)))  # fmt: skip
def _(spark, d):
    return quality.validate(_dirty_texts(spark, d).select(*quality.DATES), "farms", only="valid_date_")


# ---- the stored star schema ---------------------------------------------------------------------------------------


def _stored_star(spark, d):
    """The star schema as stored, with rows that break its constraints by fixed rules."""
    t = tables(spark, d, prices=True)
    t["crop"] = t["crop"].unionByName(t["crop"].where("crop_id <= 2"))
    t["time"] = t["time"].unionByName(t["time"].where("time_id <= 3"))
    t["prices"] = t["prices"].withColumn("price_date", F.when(F.col("time_id") % 5 != 0, F.col("price_date")))
    days = F.col("total_days")
    t["production"] = t["production"].withColumns(
        {"farm_id": F.when(days % 7 != 0, F.col("farm_id")), "crop_id": F.when(days % 11 == 0, F.col("crop_id") + 1000).otherwise(F.col("crop_id"))})
    return {name: materialize(df, f"star-{name}") for name, df in t.items()}


_BROKEN = {
    ("crop", "unique", "crop_type"): "SELECT least(2, count(*)) FROM dim_crop", ("time", "unique", "full_date"): "SELECT count(*) FROM dim_time WHERE time_id <= 3",
    ("production", "not_null", "farm_id"): "SELECT count(*) FROM farm WHERE total_days % 7 = 0",
    ("prices", "not_null", "price_date"): """SELECT count(*) FROM commodity JOIN dim_time ON full_date = "date" WHERE time_id % 5 = 0""",
    ("production", "foreign_key", "crop_id"): "SELECT count(*) FROM farm WHERE total_days % 11 = 0",
}


def _constraints(key, kind):
    mine = [c for c in wh.CONSTRAINTS if c[1] == kind]
    sql = " UNION ALL ".join(
        f"""SELECT '{c[0]}' AS "table", '{c[1]}' AS kind, '{c[2]}' AS "column", CAST(({_BROKEN.get(c[:3], "SELECT 0")}) AS BIGINT) AS violations""" for c in mine)
    query(key, star_sql(sql))(lambda spark, d: wh.constraint_report(_stored_star(spark, d), mine))


_constraints("v12_stored_keys", "unique")
_constraints("v13_stored_references", "foreign_key")
_constraints("v14_stored_not_null", "not_null")

_STAMP = "2024-01-01 06:00:00"
_NARROW = {**wh.PRODUCTION_TYPES, Y: "decimal(6,2)"}  # some yields do not fit


@query("e05_typed_load", star_sql(
    f"""SELECT CASE WHEN round(abs({Y}), 2) < 10000 THEN 'loaded' ELSE 'quarantined' END AS target, count(*)::BIGINT AS n, round(sum(round({Y}, 2)), 0) AS total,
    sum(total_days)::BIGINT AS days, CASE WHEN round(abs({Y}), 2) < 10000 THEN count(*) ELSE 0 END::BIGINT AS ids FROM farm GROUP BY round(abs({Y}), 2) < 10000"""))  # fmt: skip
def _(spark, d):
    # the members, the ranges of the ids, the fact and its quarantine read the rows in turn; written once, their joins run a single time
    rows = materialize(priced_farm(spark, d, *_FACT, price_digits=6), "priced-farm")
    good, bad = wh.typed_production(rows, tables(spark, d, prices=True, rows=rows), _STAMP, _NARROW)
    total = F.round(F.sum(F.round(F.col(Y).cast("double"), 2)), 0).alias("total")
    one = good.agg(F.lit("loaded").alias("target"), F.count("*").alias("n"), total, F.sum("total_days").cast("bigint").alias("days"), F.count_distinct("production_id").alias("ids"))
    two = bad.agg(F.lit("quarantined").alias("target"), F.count("*").alias("n"), total, F.sum("total_days").cast("bigint").alias("days"), F.lit(0).cast("bigint").alias("ids"))
    return one.unionByName(two).where("n > 0")


_PER_KG = ", ".join(
    f"round({c.lower()} / 100 * 0.92::DOUBLE / {k}::DOUBLE, 4) AS {wh.PRICE_COLUMNS[f'{c}_EUR_PER_KG']}" for c, k in ag.KG_PER_UNIT.items() if c in COMMODITIES)


@query("e06_typed_prices", star_sql(
    f"""SELECT row_number() OVER (ORDER BY full_date) AS price_id, time_id, strftime(full_date, '%Y-%m-%d') AS price_date, {_PER_KG},
    round(0.45::DOUBLE * (1 + 0.1::DOUBLE * sin(2 * pi() * dayofyear(full_date) / 365)), 4) AS rice_eur_per_kg, '{_STAMP}' AS created_at
    FROM (SELECT "date" AS full_date, {", ".join(f"max(value) FILTER (variable = '{c}') AS {c.lower()}" for c in COMMODITIES)} FROM filled GROUP BY "date") JOIN dim_time USING (full_date)""",
    *FILLED_SQL))
def _(spark, d):
    good, _ = wh.typed_prices(tables(spark, d, prices=True)["prices"], _STAMP)
    prices = [F.col(c).cast("double").alias(c) for c in wh.PRICE_COLUMNS.values()]
    return as_plain(good.select("price_id", "time_id", "price_date", *prices, F.date_format("created_at", "yyyy-MM-dd HH:mm:ss").alias("created_at")))


# ---- sources and sinks ----------------------------------------------------------------------------------------------


def _farm_file(spark, d, *columns):
    """The farm table as a CSV file in the shared folder."""
    return files.write_csv(files.farm_file_columns(farm(spark, d, *columns)), fresh_path(spark, "farm-csv"))


@query("s01_farm_csv", farm_sql(
    f"""SELECT farm_id, region, crop_type, soil_moisture_pct, round("temperature_C", 6) AS "temperature_C", strftime(sowing_date, '%Y-%m-%d') AS sowing_date,
    total_days, {Y} FROM (SELECT * REPLACE (CAST(total_days AS BIGINT) AS total_days) FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = files.read_farm(spark, _farm_file(spark, d))
    cols = ["farm_id", "region", "crop_type", "soil_moisture_pct", "temperature_C", "sowing_date", "total_days", Y]
    return pr.rounded(as_plain(df.select(*cols)), 6)


def _commodity_file(spark, d, dirty=False):
    df = commodity_prices(spark, d)
    date = F.date_format("date", "yyyy-MM-dd")
    if dirty:
        date = F.when(F.dayofmonth("date") == 13, "not a date").otherwise(date)
    out = df.select(date.alias("Date"), *COMMODITIES, F.lit(1.0).alias("GOLD"))
    return files.write_csv(out, fresh_path(spark, "commodity-csv")), out.columns


@query("s02_commodity_csv", commodity_sql('SELECT strftime("date", \'%Y-%m-%d\') AS day, "CORN", "WHEAT", "SOYBEANS", "COTTON" FROM commodity'))
def _(spark, d):
    path, header = _commodity_file(spark, d)
    return by_day(files.read_commodities(spark, path, header))


@query("s03_lenient_farm", farm_sql(
    """SELECT farm_id, CASE WHEN soil_moisture_pct <> 10 THEN strftime(sowing_date, '%Y-%m-%d') END AS sowing_date,
    round(coalesce("temperature_C", (SELECT quantile_cont("temperature_C", 0.5) FROM dirty)), 6) AS "temperature_C",
    coalesce(irrigation_type, (SELECT irrigation_type FROM dirty WHERE irrigation_type IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS irrigation_type
    FROM dirty""",
    """dirty AS (SELECT * REPLACE (CASE WHEN pesticide_usage_ml > 5 THEN "temperature_C" END AS "temperature_C",
      CASE WHEN soil_moisture_pct < 75 THEN irrigation_type END AS irrigation_type) FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, *FARM_COLUMNS)
    dirty = df.withColumns(
        {
            "sowing_date": F.when(F.col("soil_moisture_pct") != 10, F.col("sowing_date").cast("string")).otherwise("31/31/99"),
            "temperature_C": F.when(F.col("pesticide_usage_ml") > 5, F.col("temperature_C")),
            "irrigation_type": F.when(F.col("soil_moisture_pct") < 75, F.col("irrigation_type")),
        }
    )
    path = files.write_csv(files.farm_file_columns(dirty), fresh_path(spark, "farm-dirty"))
    out = files.read_farm_lenient(spark, path).select("farm_id", "sowing_date", "temperature_C", "irrigation_type")
    return pr.rounded(as_plain(out), 6)


@query("s04_lenient_commodity", commodity_sql(
    """SELECT CASE WHEN day("date") <> 13 THEN strftime("date", '%Y-%m-%d') END AS day, "CORN", "WHEAT", "SOYBEANS", "COTTON" FROM commodity"""))  # fmt: skip
def _(spark, d):
    path, header = _commodity_file(spark, d, dirty=True)
    found = files.read_commodities(spark, path, header, lenient=True)
    absent = files.read_commodities(spark, path + "-absent", header, lenient=True)
    return by_day(found.unionByName(absent))


def _products(spark, d, category):
    """The part table in the shape of a retail price file; names hold commas."""
    df = table(spark, d, "part")
    price = F.col("p_retailprice")
    wanted = F.col("p_type").isin("SMALL", "MEDIUM", "LARGE") if category == "Fruit" else F.col("p_type").isin("PROMO", "ECONOMY", "STANDARD")
    out = df.where(wanted).select(
        F.concat_ws(", ", "p_name", "p_brand").alias("Product"), F.col("p_type").alias("Form"), price.alias("AverageRetailPrice"),
        F.lit("per pound").alias("AverageRetailPriceUnitOfMeasure"), F.lit(0.9).alias("PreparationYieldFactor"),
        F.lit(0.25).alias("SizeOfACupEquivalent"), F.lit("pounds").alias("CupEquivalentUnitOfMeasure"),
        (price / 4).alias("AveragePricePerCupEquivalent"), F.lit(category).alias("Category"),
    )
    return files.read_product_prices(spark, files.write_csv(out, fresh_path(spark, f"prices-{category}")))


for _key, _category, _types in (
    ("s05_fruit_prices", "Fruit", ("SMALL", "MEDIUM", "LARGE")),
    ("s06_vegetable_prices", "Vegetable", ("PROMO", "ECONOMY", "STANDARD")),
):
    query(
        _key,
        f"""SELECT p_name || ', ' || p_brand AS "Product", p_type AS "Form", p_retailprice AS "AverageRetailPrice", round(p_retailprice / 4, 6) AS "AveragePricePerCupEquivalent",
        '{_category}' AS "Category" FROM part WHERE p_type IN {_types}""",
    )(
        lambda spark, d, category=_category: pr.rounded(
            _products(spark, d, category).select("Product", "Form", "AverageRetailPrice", "AveragePricePerCupEquivalent", "Category"), 6
        )
    )


@query("s07_none_labels", farm_sql(
    """SELECT irrigation_type, crop_disease_status, count(*) AS n FROM (SELECT CASE irrigation_type WHEN 'BUILDING' THEN 'No Irrigation' ELSE irrigation_type END AS irrigation_type,
    crop_disease_status FROM farm) GROUP BY ALL"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, *FARM_COLUMNS).replace({"BUILDING": "None"}, subset=["irrigation_type"])
    df = df.replace({"No Disease": "None"}, subset=["crop_disease_status"])
    path = files.write_csv(files.farm_file_columns(df), fresh_path(spark, "farm-none"))
    return pr.distribution(files.read_farm_none_labels(spark, path), ["irrigation_type", "crop_disease_status"])


@query("s08_warehouse_read", star_sql("SELECT region_id, region_name, country FROM dim_region"))
def _(spark, d):
    dim = materialize(wh.dim_region(farm(spark, d, "region", "country")), "dim_region")
    return as_plain(dim)


@query("s09_enriched_csv", farm_sql(
    f"SELECT count(*) AS n, round(sum({Y}), 2) AS total_yield, round(avg(growing_conditions_score), 4) AS score, count(DISTINCT country) AS countries, "
    + " + ".join(f'count("{c}")' for c in [*FARM_COLUMNS, *DERIVED_COLUMNS, "country"]) + " AS cells FROM farm"))
def _(spark, d):
    record = [*FARM_COLUMNS, *DERIVED_COLUMNS, "country"]
    df = priced_farm(spark, d, *record)
    path = files.write_csv(df, fresh_path(spark, "enriched"))
    back = spark.read.schema(df.schema).option("header", True).csv(path)
    return pr.rounded(
        back.agg(
            F.count("*").alias("n"), F.round(F.sum(Y), 2).alias("total_yield"),
            F.avg("growing_conditions_score").alias("score"), F.countDistinct("country").alias("countries"),
            sum((F.count(c) for c in record), F.lit(0)).alias("cells"),
        )
    )


@query("s10_full_refresh", farm_sql(f"SELECT count(*) AS n, round(sum({Y}), 2) AS total_yield FROM farm WHERE crop_type = 'LARGE'"))
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", Y)
    path = fresh_path(spark, "fact")
    files.full_refresh(df, path)
    return files.full_refresh(df.where(F.col("crop_type") == "LARGE"), path).agg(F.count("*").alias("n"), F.round(F.sum(Y), 2).alias("total_yield"))


@query("s12_filtered_export", farm_sql(f"SELECT {whole_sql()} FROM farm WHERE region = 'NATION_4'"))
def _(spark, d):
    df = filters.by_equality(farm(spark, d), region="NATION_4", crop_type="")
    return whole_frame(spark.read.schema(df.schema).option("header", True).csv(files.write_csv(df, fresh_path(spark, "export"))))


def _explorer_sql(header, where):
    cols = ", ".join(
        f'round("{c}", 6) AS "{h}"' if c in ("temperature_C",) else f'"{c}" AS "{h}"' for c, h in header.items()
    )
    return farm_sql(f"SELECT {cols} FROM farm WHERE {where}")


for _key, _short, _header in (
    ("s13_explorer_export", False, files.EXPLORER_HEADER),
    ("s13_explorer_export_short", True, files.EXPLORER_HEADER_SHORT),
):

    @query(_key, _explorer_sql(_header, "true"))
    def _(spark, d, short=_short, header=_header):
        df = farm(spark, d, *header)
        out = files.explorer_export(df, short)
        path = files.write_csv(out, fresh_path(spark, "explorer"), quote_all=not short)
        return pr.rounded(spark.read.schema(out.schema).option("header", True).csv(path), 6)


@query("s14_summary_export", f"""SELECT variable AS "Variable", round(mean, 2) AS "Mean", round(std, 2) AS "Std Dev", round(min, 2) AS "Min", round(q1, 2) AS "25%",
    round(median, 2) AS "Median", round(q3, 2) AS "75%", round(max, 2) AS "Max" FROM ({_UPPER_SQL})""")  # fmt: skip
def _(spark, d):
    summary = pr.upper_summary(farm(spark, d, *SUMMARY), SUMMARY)
    exact = {c: F.round(c, 6) for c in ("min", "max", "q1", "median", "q3")}
    out = files.summary_export(summary.withColumns({**exact, "mean": F.round("mean", 4), "std": F.round("std", 4)}))
    return spark.read.schema(out.schema).option("header", True).csv(files.write_csv(out, fresh_path(spark, "summary")))


@query("s19_audit_record", farm_sql(
    """SELECT 'SUCCESS' AS status, 'daily_farm_pipeline' AS dag_id, count(*) AS rows_processed, false AS model_retrained FROM farm
    UNION ALL SELECT 'SUCCESS', 'daily_farm_pipeline', count(*), true FROM farm WHERE crop_type = 'SMALL'"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "crop_type")
    path = fresh_path(spark, "audit")
    small = df.where(F.col("crop_type") == "SMALL").count()
    for rows, model in ((df.count(), None), (small, "models/best"), (small, "models/best")):  # the last one twice, as by a retried run
        files.append_audit(
            spark, path, timestamp="2024-01-01T06:00:00", status="SUCCESS", dag_id="daily_farm_pipeline",
            execution_date="2024-01-01", rows_processed=rows, model_retrained=model is not None, model_path=model, run_id=f"run-{model}",
        )
    return files.read_audit(spark, path).select("status", "dag_id", "rows_processed", "model_retrained")


@query("s20_processed_copy", farm_sql(
    f"SELECT {whole_sql([*FARM_COLUMNS, 'yield_per_day', 'water_efficiency'])}, 'daily' AS processed_by, true AS stamped FROM farm"))
def _(spark, d):
    back = materialize(files.with_lineage(farm(spark, d), "daily"), "processed")
    record = whole_frame(back.select(*FARM_COLUMNS, "yield_per_day", "water_efficiency", "processed_by", "processed_at"))
    return record.withColumn("stamped", F.col("processed_at").isNotNull()).drop("processed_at")
