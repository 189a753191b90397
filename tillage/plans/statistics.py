"""Statistics, ranks and top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.operators import filters
from tillage.operators import profile as pr
from tillage.operators import quality, stats
from tillage.operators.orderstats import UPPER, order_statistics
from tillage.plans.profiles import CATEGORIES, stacked_sql
from tillage.plans.registry import Y, query
from tillage.sources.binding import FARM_COLUMNS, farm, farm_sql

CORR = ["soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct", "pesticide_usage_ml",
        "total_days", Y, "NDVI_index", "latitude", "longitude", "sunlight_hours", "sowing_month", "harvest_month"]
_PAIRS = [(i, j) for i in range(len(CORR)) for j in range(len(CORR))]


def _wrapped(pairs) -> str:
    """One aggregate over all pairs, unfolded into rows."""
    cols = ", ".join(
        f"""struct_pack("row" := '{CORR[i]}', "column" := '{CORR[j]}', i := {i}::BIGINT, j := {j}::BIGINT, r := round("""
        + ("1.0::DOUBLE" if i == j else f'corr("{CORR[min(i, j)]}", "{CORR[max(i, j)]}")')
        + ", 6))"
        for i, j in pairs
    )
    return farm_sql(f'SELECT s."row" AS "row", s."column" AS "column", s.i AS i, s.j AS j, s.r AS r FROM (SELECT unnest([{cols}]) AS s FROM farm)')


@query("x01_correlation_matrix", _wrapped(_PAIRS))
def _(spark, d):
    return pr.rounded(stats.correlations(farm(spark, d, *CORR), CORR), 6)


@query("x02_lower_triangle", _wrapped([(i, j) for i, j in _PAIRS if i > j]))
def _(spark, d):
    return pr.rounded(stats.correlations(farm(spark, d, *CORR), CORR, full=False), 6)


@query("x03_target_correlations", farm_sql(
    """SELECT feature, round(r, 6) AS r, CASE WHEN r > 0 THEN 'up' ELSE 'down' END AS direction,
    CASE WHEN abs(r) > 0.5 THEN 'Strong' WHEN abs(r) > 0.3 THEN 'Moderate' ELSE 'Weak' END AS strength FROM ("""
    + " UNION ALL ".join(f"""SELECT '{c}' AS feature, corr("{c}", {Y}) AS r FROM farm""" for c in CORR if c != Y) + ")"))
def _(spark, d):
    return pr.rounded(stats.target_correlations(farm(spark, d, *CORR), CORR), 6)


@query("x03_top3_correlations", farm_sql(
    "SELECT feature, round(r, 6) AS r FROM ("
    + " UNION ALL ".join(f"""SELECT '{c}' AS feature, corr("{c}", {Y}) AS r FROM farm""" for c in CORR if c != Y)
    + ") ORDER BY abs(r) DESC, feature LIMIT 3"))
def _(spark, d):
    return pr.rounded(stats.target_correlations(farm(spark, d, *CORR), CORR).select("feature", "r").limit(3), 6)


@query("x04_pair_correlation", farm_sql(
    f"""SELECT count(rainfall_mm) AS n, round(coalesce(corr(rainfall_mm, water_efficiency), 0), 6) AS r,
    round(power(coalesce(corr(rainfall_mm, water_efficiency), 0), 2), 6) AS r_squared FROM farm"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(stats.pair_correlation(farm(spark, d, "rainfall_mm", "water_efficiency"), "rainfall_mm", "water_efficiency"), 6)


def _trend(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    g = f"GROUP BY {keys}" if keys else ""
    return farm_sql(
        f"""SELECT {k}round(s, 6) AS slope, round(i, 4) AS intercept, x_min, x_max, n, round(s * x_min + i, 4) AS y_at_min,
        round(s * x_max + i, 4) AS y_at_max FROM (SELECT {k}regr_slope({Y}, soil_moisture_pct) AS s, regr_intercept({Y}, soil_moisture_pct) AS i,
        min(soil_moisture_pct) AS x_min, max(soil_moisture_pct) AS x_max, count(*) AS n FROM farm {g})"""
    )


def _line(df, keys=None):
    out = stats.trend_line(df, "soil_moisture_pct", Y, keys)
    return pr.rounded(out.withColumn("slope", F.round("slope", 6)), 4, "slope")


@query("x05_trend_line", _trend(""))
def _(spark, d):
    return _line(farm(spark, d, "soil_moisture_pct", Y))


@query("x06_trend_by_group", _trend("crop_type"))
def _(spark, d):
    return _line(farm(spark, d, "soil_moisture_pct", "crop_type", Y), ["crop_type"])


WATER_SQL = f"""water AS (SELECT crop_type, count(*) AS n,
  CASE WHEN count(*) > 10 THEN regr_slope({Y}, rainfall_mm) ELSE 5 END AS slope,
  CASE WHEN count(*) > 10 THEN regr_intercept({Y}, rainfall_mm) ELSE 2000 END AS intercept,
  CASE WHEN count(*) > 10 THEN regr_r2({Y}, rainfall_mm) ELSE 0 END AS r_squared,
  CASE WHEN count(*) > 10 THEN quantile_cont(rainfall_mm, 0.1) ELSE 100 END AS min_water,
  CASE WHEN count(*) > 10 THEN quantile_cont(rainfall_mm, 0.9) ELSE 400 END AS max_water,
  CASE WHEN count(*) > 10 THEN avg({Y}) ELSE 3000 END AS avg_yield FROM farm GROUP BY crop_type)"""


@query("x07_water_response", farm_sql(
    """SELECT crop_type, n, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(r_squared, 4) AS r_squared,
    round(min_water, 4) AS min_water, round(max_water, 4) AS max_water, round(avg_yield, 4) AS avg_yield FROM water""", WATER_SQL))  # fmt: skip
def _(spark, d):
    return pr.rounded(stats.water_response(farm(spark, d, "crop_type", "rainfall_mm", Y)))


@query("x08_shape", farm_sql(
    """SELECT round(m3 / power(s, 3), 4) AS skewness, round(m4 / power(s, 4) - 3, 4) AS kurtosis FROM (
    SELECT avg(power(water_efficiency - m, 3)) AS m3, avg(power(water_efficiency - m, 4)) AS m4, any_value(sd) AS s FROM farm,
    (SELECT avg(water_efficiency) AS m, stddev_pop(water_efficiency) AS sd FROM farm))"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(stats.shape(farm(spark, d, "water_efficiency"), "water_efficiency"))


def histogram_sql(column: str, bins: int, density: bool = False, source: str = "farm") -> str:
    extra = ', round(CASE WHEN "end" > "start" THEN n / (total * width) END, 8) AS density' if density else ""
    return f"""SELECT bin, round("start", 4) AS "start", round("end", 4) AS "end", n{extra} FROM (
      SELECT b AS bin, lo + b * width AS "start", lo + (b + 1) * width AS "end", coalesce(n, 0) AS n, total, width FROM
      (SELECT unnest(range({bins})) AS b) CROSS JOIN (SELECT min({column}) AS lo, (max({column}) - min({column})) / {bins} AS width,
        count({column}) AS total FROM {source}) LEFT JOIN
      (SELECT least(CAST(floor(({column} - lo) / ((hi - lo) / {bins})) AS BIGINT), {bins - 1}) AS hb, count(*) AS n FROM {source},
        (SELECT min({column}) AS lo, max({column}) AS hi FROM {source}) GROUP BY hb) ON hb = b)"""


@query("x09_histogram", farm_sql(histogram_sql(Y, 30)))
def _(spark, d):
    return pr.rounded(stats.histogram(farm(spark, d, Y), Y, 30))


for _c, _b in (("water_efficiency", 25), ("growing_conditions_score", 20)):
    query(f"x09_histogram_{_b}_bins", farm_sql(histogram_sql(_c, _b)))(
        lambda spark, d, c=_c, b=_b: pr.rounded(stats.histogram(farm(spark, d, c), c, b))
    )


@query("x10_density", farm_sql(histogram_sql(Y, 30, True)))
def _(spark, d):
    out = stats.histogram(farm(spark, d, Y), Y, 30, density=True)
    return pr.rounded(out.withColumn("density", F.round("density", 8)), 4, "density")


def _box_sql(keys: str) -> str:
    k = f"{keys}, " if keys else ""
    on = f"USING ({keys})" if keys else "ON true"
    g = f"GROUP BY {keys}" if keys else ""
    return farm_sql(
        f"""SELECT {k}round(any_value(q1), 4) AS q1, round(any_value(md), 4) AS median, round(any_value(q3), 4) AS q3,
        round(any_value(lf), 4) AS lower_fence, round(any_value(uf), 4) AS upper_fence,
        round(min(water_efficiency) FILTER (water_efficiency BETWEEN lf AND uf), 4) AS whisker_low,
        round(max(water_efficiency) FILTER (water_efficiency BETWEEN lf AND uf), 4) AS whisker_high,
        count(*) FILTER (water_efficiency NOT BETWEEN lf AND uf) AS outliers, count(*) AS n
        FROM farm JOIN (SELECT *, q1 - 1.5::DOUBLE * (q3 - q1) AS lf, q3 + 1.5::DOUBLE * (q3 - q1) AS uf FROM (SELECT {k}
          quantile_cont(water_efficiency, 0.25) AS q1, quantile_cont(water_efficiency, 0.5) AS md, quantile_cont(water_efficiency, 0.75) AS q3
          FROM farm {g})) b {on} {g}"""
    )


@query("x11_box_summary", _box_sql(""))
def _(spark, d):
    return pr.rounded(stats.box_summary(farm(spark, d, "water_efficiency"), "water_efficiency"))


@query("x11_box_by_region", _box_sql("region"))
def _(spark, d):
    return pr.rounded(stats.box_summary(farm(spark, d, "water_efficiency", "region"), "water_efficiency", ["region"]))


@query("x11_outliers", farm_sql(
    """SELECT farm_id, crop_type, round(water_efficiency, 6) AS water_efficiency FROM farm JOIN (SELECT crop_type,
      quantile_cont(water_efficiency, 0.25) AS q1, quantile_cont(water_efficiency, 0.75) AS q3 FROM farm GROUP BY crop_type) USING (crop_type)
    WHERE water_efficiency NOT BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", "water_efficiency")
    return pr.rounded(stats.outliers(df, "water_efficiency", ["crop_type"]), 6)


@query("x12_anova", farm_sql(
    f"""SELECT round(ssb, 0) AS ss_between, round(ssw, 0) AS ss_within, k - 1 AS df_between, n - k AS df_within,
    round(ssb / (k - 1) / (ssw / (n - k)), 4) AS f_value, ssb / (k - 1) / (ssw / (n - k)) > 3 AS significant FROM (
      SELECT count(*) AS k, CAST(sum(c) AS BIGINT) AS n, sum(c * power(m - o, 2)) AS ssb, sum(v * c) AS ssw FROM
      (SELECT region, count(*) AS c, avg({Y}) AS m, var_pop({Y}) AS v FROM farm GROUP BY region), (SELECT avg({Y}) AS o FROM farm))"""))  # fmt: skip
def _(spark, d):
    out = stats.anova(farm(spark, d, "region", Y), "region", Y)
    wide = {c: F.round(c, 0) for c in ("ss_between", "ss_within")}
    return pr.rounded(out.withColumns(wide))


_MATRIX = ["soil_moisture_pct", "temperature_C", "rainfall_mm", "NDVI_index", Y]


@query("x13_scatter_matrix", farm_sql(
    "SELECT crop_type, " + ", ".join(f'round("{c}", 6) AS "{c}"' for c in _MATRIX) + " FROM farm"))
def _(spark, d):
    return pr.rounded(farm(spark, d, "crop_type", *_MATRIX), 6)


@query("x14_category_share", farm_sql(
    """SELECT variable, value, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY variable) * 100, 4) AS share_pct
    FROM long GROUP BY variable, value""", stacked_sql(CATEGORIES, "VARCHAR")))  # fmt: skip
def _(spark, d):
    return pr.rounded(pr.category_share(farm(spark, d, *CATEGORIES), CATEGORIES))


@query("a37_pair_statistics", farm_sql(
    f"""SELECT count(*) AS n, round(coalesce(corr(soil_moisture_pct, {Y}), 0), 6) AS r, min(soil_moisture_pct) AS x_min, max(soil_moisture_pct) AS x_max,
    min({Y}) AS y_min, max({Y}) AS y_max, CASE WHEN abs(corr(soil_moisture_pct, {Y})) >= 0.8 THEN 'strong' WHEN abs(corr(soil_moisture_pct, {Y})) >= 0.5 THEN 'moderate'
    WHEN abs(corr(soil_moisture_pct, {Y})) >= 0.3 THEN 'weak' ELSE 'none' END AS strength,
    (SELECT soil_moisture_pct FROM farm ORDER BY soil_moisture_pct LIMIT 1 OFFSET (SELECT count(*) // 2 FROM farm)) AS x_median,
    (SELECT {Y} FROM farm ORDER BY {Y} LIMIT 1 OFFSET (SELECT count(*) // 2 FROM farm)) AS y_median FROM farm"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(stats.pair_statistics(farm(spark, d, "soil_moisture_pct", Y), "soil_moisture_pct", Y), 6)


# ---- ranks and top-k ---------------------------------------------------------------------------------------


@query("w01_top5_crops", farm_sql(
    f"SELECT crop_type, round(avg({Y}), 4) AS mean FROM farm GROUP BY crop_type ORDER BY avg({Y}) DESC, crop_type LIMIT 5"))
def _(spark, d):
    return pr.rounded(pr.top_per_group(farm(spark, d, "crop_type", Y), None, "crop_type", 5))


@query("w02_crop_means_ascending", farm_sql(f"SELECT crop_type, round(avg({Y}), 4) AS mean FROM farm GROUP BY crop_type"))
def _(spark, d):
    return pr.rounded(pr.group_stats(farm(spark, d, "crop_type", Y), ["crop_type"], mean=F.avg(Y)).orderBy("mean", "crop_type"))


@query("w05_top1_per_group", farm_sql(
    f"""SELECT crop_type, region, round(m, 4) AS mean, 1::BIGINT AS rank FROM (SELECT crop_type, region, avg({Y}) AS m,
    row_number() OVER (PARTITION BY crop_type ORDER BY avg({Y}) DESC, region) AS k FROM farm GROUP BY crop_type, region) WHERE k = 1"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(pr.top_per_group(farm(spark, d, "crop_type", "region", Y), "crop_type", "region", 1))


@query("w06_bottom5_regions", farm_sql(
    f"SELECT region, round(avg({Y}), 4) AS mean FROM farm GROUP BY region ORDER BY avg({Y}), region LIMIT 5"))
def _(spark, d):
    means = farm(spark, d, "region", Y).groupBy("region").agg(F.avg(Y).alias("mean"))
    return pr.rounded(means.orderBy("mean", "region").limit(5))


@query("w07_duplicate_keys", farm_sql("SELECT count(*) - count(DISTINCT farm_id) AS duplicates FROM farm"))
def _(spark, d):
    return quality.duplicate_rows(farm(spark, d, "farm_id"), "farm_id")


@query("w08_full_duplicates", farm_sql(
    f"""SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM farm GROUP BY {', '.join(f'"{c}"' for c in FARM_COLUMNS)})"""))
def _(spark, d):
    return quality.full_duplicates(farm(spark, d))


@query("w09_upper_median", farm_sql(
    f"""SELECT crop_type, n, v AS upper_median FROM (SELECT crop_type, {Y} AS v, row_number() OVER (PARTITION BY crop_type ORDER BY {Y}) AS rn,
    count(*) OVER (PARTITION BY crop_type) AS n FROM farm) WHERE rn = CAST(floor(n * 0.5) AS BIGINT) + 1"""))  # fmt: skip
def _(spark, d):
    return order_statistics(farm(spark, d, "crop_type", Y), ["crop_type"], Y, {"upper_median": (0.5, UPPER)}, count_as="n")


_SAMPLE_KEY = ["farm_id", "sensor_id", "sowing_month", "harvest_month", "fertilizer_type"]


@query("w10_seeded_sample", farm_sql(
    f"""SELECT farm_id, sensor_id FROM farm ORDER BY md5(concat_ws('|', '42', {', '.join(f'CAST({c} AS VARCHAR)' for c in _SAMPLE_KEY)})),
    {', '.join(_SAMPLE_KEY)} LIMIT 5000"""))  # fmt: skip
def _(spark, d):
    return filters.seeded_sample(farm(spark, d, *_SAMPLE_KEY), 5000, _SAMPLE_KEY).select("farm_id", "sensor_id")


@query("w11_sorted_line", farm_sql(f"""SELECT rainfall_mm AS x, {Y} AS y FROM farm"""))
def _(spark, d):
    df = farm(spark, d, "rainfall_mm", Y)
    return filters.valid_pairs(df, "rainfall_mm", Y).select(F.col("rainfall_mm").alias("x"), F.col(Y).alias("y")).orderBy("x", "y")


@query("w13_percent_of_total", farm_sql(
    f"""SELECT crop_type, round(sum({Y}), 2) AS total, round(sum({Y}) / sum(sum({Y})) OVER () * 100, 4) AS share_pct FROM farm GROUP BY crop_type"""))
def _(spark, d):
    sums = farm(spark, d, "crop_type", Y).groupBy("crop_type").agg(F.sum(Y).alias("total"))
    whole = sums.agg(F.sum("total").alias("whole"))
    out = sums.crossJoin(F.broadcast(whole))
    return out.select("crop_type", F.round("total", 2).alias("total"), F.round(F.col("total") / F.col("whole") * 100, 4).alias("share_pct"))
