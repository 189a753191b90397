"""M11-M103: the 28 cube queries and W04, W12 ranks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.operators import cube
from tillage.operators import profile as pr
from tillage.operators.warehouse import farm_dates
from tillage.plans.registry import Y, query
from tillage.sources.binding import commodity_prices, farm, farm_sql, table

_SQL = {
    "total_yield": f"sum({Y})", "yield_per_day": "sum(yield_per_day)", "water_efficiency": "sum(water_efficiency)",
    "soil_moisture": "sum(soil_moisture_pct)", "soil_ph": 'sum("soil_pH")',
    "growing_score": "sum(growing_conditions_score)", "production_count": "count(*)",
}


def _columns(measures, *attributes):
    needed = [cube.MEASURES[m] for m in measures if cube.MEASURES[m]]
    return list(dict.fromkeys([*attributes, *needed]))


def _measure_sql(measures, digits=2):
    return ", ".join(
        f"{_SQL[m]} AS {m}" if m == "production_count" else f"round({_SQL[m]}, {digits}) AS {m}" for m in measures
    )


def cells_sql(measures, attributes, where="", digits=2) -> str:
    labels = ", ".join(f"CASE WHEN grouping({a}) = 1 THEN 'All' ELSE coalesce({a}, 'Unknown') END AS {a}" for a in attributes)
    w = f"WHERE {where}" if where else ""
    return f"SELECT {labels}, {_measure_sql(measures, digits)} FROM farm {w} GROUP BY CUBE ({', '.join(attributes)})"


def _simple(key: str, measures: list[str], attributes: list[str], top=None, bottom=None, digits=2):
    sql = cells_sql(measures, attributes, digits=6)
    if top:
        sql = f"SELECT * FROM ({sql}) ORDER BY {top[0]} DESC, {attributes[0]} LIMIT {top[1]}"
    if bottom:
        sql = f"SELECT * FROM ({sql}) ORDER BY {bottom[0]}, {attributes[0]} LIMIT {bottom[1]}"
    cols = ", ".join([*attributes, *[m if m == "production_count" else f"round({m}, {digits}) AS {m}" for m in measures]])

    @query(key, farm_sql(f"SELECT {cols} FROM ({sql})"))
    def _(spark, d):
        fact = farm(spark, d, *_columns(measures, *attributes))
        return pr.rounded(cube.cube_query(fact, measures, attributes, top=top, bottom=bottom), digits)


_simple("m11_yield_by_crop", ["total_yield"], ["crop_type"])
_simple("m12_count_by_region", ["production_count"], ["region"])


@query("m13_all_measures", farm_sql(f"SELECT {_measure_sql(cube.MEASURES)} FROM farm"))
def _(spark, d):
    return pr.rounded(cube.cube_query(farm(spark, d, *_columns(cube.MEASURES)), list(cube.MEASURES), []), 2)


_simple("m21_yield_by_crop_region", ["total_yield"], ["crop_type", "region"])
_simple("m22_efficiency_by_irrigation_crop", ["water_efficiency"], ["irrigation_type", "crop_type"])
_simple("m23_yield_by_season_crop", ["total_yield"], ["harvest_season", "crop_type"])

# ---- sets that keep members without facts ----------------------------------------------------------

_TIME_SQL = """time_members AS (SELECT sowing_date AS full_date FROM farm UNION SELECT harvest_date FROM farm
  UNION SELECT CAST(ts AS DATE) FROM events)"""


def time_members(spark, d, expr, name):
    """Attribute labels of the whole time dimension: farm days and price days."""
    days = farm_dates(farm(spark, d, "sowing_date", "harvest_date"))
    prices = commodity_prices(spark, d, gaps=False).select(F.col("date").alias("full_date"))
    return days.unionByName(prices).select(expr("full_date").alias(name)).distinct()


def _kept_sql(measures, attribute, member_expr, member_source, where="") -> str:
    cols = ", ".join(f"c.{m}" for m in measures)
    return farm_sql(
        f"""SELECT coalesce(m.{attribute}, c.{attribute}) AS {attribute}, {cols} FROM (
          SELECT DISTINCT {member_expr} AS {attribute} FROM {member_source} UNION SELECT 'All') m
        FULL JOIN ({cells_sql(measures, [attribute], where)}) c ON m.{attribute} = c.{attribute}""",
        _TIME_SQL,
    )


def _month_name(c):
    return F.date_format(c, "MMMM")


_SEASON_SQL = """CASE WHEN month(full_date) BETWEEN 3 AND 5 THEN 'Spring' WHEN month(full_date) BETWEEN 6 AND 8 THEN 'Summer'
  WHEN month(full_date) BETWEEN 9 AND 11 THEN 'Fall' ELSE 'Winter' END"""


def _season(c):
    from tillage.functions.agronomy import season

    return season(F.month(c))


for _key, _measures, _attr, _expr, _sql_expr in (
    ("m31_yield_by_quarter", ["total_yield"], "harvest_quarter", lambda c: F.quarter(c).cast("string"), "CAST(quarter(full_date) AS VARCHAR)"),
    ("m32_by_sowing_month", ["total_yield", "production_count"], "sowing_month_name", _month_name, "monthname(full_date)"),
    ("m33_yield_by_season", ["total_yield"], "harvest_season", _season, _SEASON_SQL),
):
    query(_key, _kept_sql(_measures, _attr, _sql_expr, "time_members"))(
        lambda spark, d, ms=_measures, a=_attr, e=_expr: pr.rounded(
            cube.cube_query(farm(spark, d, *_columns(ms, a)), ms, [a], members=time_members(spark, d, e, a)), 2
        )
    )

_CROPS = ("crop_type", "p_type", "part")
_REGIONS = ("region", "n_name", "nation")


def _sliced(key, measures, attribute, member, slicer):
    column, source = member[1], member[2]
    where = " AND ".join(f"{a} = '{v}'" for a, v in slicer.items())

    @query(key, _kept_sql(measures, attribute, column, source, where))
    def _(spark, d):
        fact = farm(spark, d, *_columns(measures, attribute, *slicer))
        members = table(spark, d, source).select(F.col(column).alias(attribute)).distinct()
        return pr.rounded(cube.cube_query(fact, measures, [attribute], slicer, members), 2)


_sliced("m41_region_yield_of_crop", ["total_yield"], "region", _REGIONS, {"crop_type": "SMALL"})
_sliced("m42_crop_efficiency_of_irrigation", ["water_efficiency", "total_yield"], "crop_type", _CROPS, {"irrigation_type": "BUILDING"})
_sliced("m43_crop_yield_healthy", ["total_yield"], "crop_type", _CROPS, {"crop_disease_status": "No Disease"})

# ---- top and bottom ------------------------------------------------------------------------------------

_simple("m51_top5_regions", ["total_yield"], ["region"], top=("total_yield", 5))
_simple("m52_top3_crops_efficiency", ["water_efficiency"], ["crop_type"], top=("water_efficiency", 3))
_simple("m53_bottom5_regions_score", ["growing_score"], ["region"], bottom=("growing_score", 5))

# ---- calculated members --------------------------------------------------------------------------------


@query("m61_average_ph", farm_sql(
    f"""SELECT crop_type, round(max(total_yield) FILTER (region = 'All'), 2) AS total_yield, round(avg(soil_ph), 4) AS avg_soil_ph
    FROM ({cells_sql(["total_yield", "soil_ph"], ["crop_type", "region"], digits=6)}) GROUP BY crop_type"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, *_columns(["total_yield", "soil_ph"], "crop_type", "region"))
    crossed = cube.cells(fact, ["total_yield", "soil_ph"], ["crop_type", "region"])
    out = crossed.groupBy("crop_type").agg(
        F.round(F.max(F.when(F.col("region") == cube.ALL, F.col("total_yield"))), 2).alias("total_yield"),
        F.round(F.avg("soil_ph"), 4).alias("avg_soil_ph"),
    )
    return out


@query("m62_yield_moisture_ratio", farm_sql(
    f"""SELECT crop_type, round(total_yield, 2) AS total_yield, round(CASE WHEN soil_moisture <> 0 THEN total_yield / soil_moisture END, 4) AS ratio
    FROM ({cells_sql(["total_yield", "soil_moisture"], ["crop_type"], digits=6)})"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, *_columns(["total_yield", "soil_moisture"], "crop_type"))
    out = cube.cells(fact, ["total_yield", "soil_moisture"], ["crop_type"])
    ratio = F.when(F.col("soil_moisture") != 0, F.col("total_yield") / F.col("soil_moisture"))
    return out.select("crop_type", F.round("total_yield", 2).alias("total_yield"), F.round(ratio, 4).alias("ratio"))


@query("m63_performance_score", farm_sql(
    f"""SELECT crop_type, round(total_yield, 2) AS total_yield, round(water_efficiency, 2) AS water_efficiency,
    round(total_yield * water_efficiency / 100 / 1000000, 2) AS score_millions
    FROM ({cells_sql(["total_yield", "water_efficiency"], ["crop_type"], digits=8)})"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, *_columns(["total_yield", "water_efficiency"], "crop_type"))
    out = cube.cells(fact, ["total_yield", "water_efficiency"], ["crop_type"])
    score = F.col("total_yield") * F.col("water_efficiency") / 100
    return pr.rounded(out.withColumn("score_millions", score / 1000000), 2)


def _rank_sql(measure, attribute):
    return farm_sql(
        f"""SELECT {attribute}, round({measure}, 2) AS {measure}, rank() OVER (ORDER BY {measure} DESC) AS rank
        FROM ({cells_sql([measure], [attribute], digits=6)})"""
    )


@query("m71_rank_crops", _rank_sql("total_yield", "crop_type"))
def _(spark, d):
    return pr.rounded(cube.ranked(farm(spark, d, *_columns(["total_yield"], "crop_type")), "total_yield", "crop_type"), 2)


@query("m72_rank_regions_efficiency", _rank_sql("water_efficiency", "region"))
def _(spark, d):
    fact = farm(spark, d, *_columns(["water_efficiency"], "region"))
    return pr.rounded(cube.ranked(fact, "water_efficiency", "region"), 2)


@query("w04_rank_with_gaps", farm_sql(
    """SELECT region, production_count, rank() OVER (ORDER BY production_count DESC) AS rank
    FROM (SELECT region, count(*) // 100 AS production_count FROM farm GROUP BY region)"""))  # fmt: skip
def _(spark, d):
    from pyspark.sql.window import Window as W

    counts = farm(spark, d, "region").groupBy("region").agg(F.floor(F.count("*") / 100).alias("production_count"))
    return counts.withColumn("rank", F.rank().over(W.orderBy(F.desc("production_count"))).cast("bigint"))


_simple("m81_yield_by_country", ["total_yield"], ["country"])


@query("m82_average_score_by_irrigation", farm_sql(
    f"""SELECT irrigation_type, round(avg(growing_score), 2) AS avg_growing_score
    FROM ({cells_sql(["growing_score"], ["irrigation_type", "crop_type"], digits=6)}) GROUP BY irrigation_type"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, *_columns(["growing_score"], "irrigation_type", "crop_type"))
    return pr.rounded(cube.average_over(fact, "growing_score", "irrigation_type", "crop_type", "avg_growing_score"), 2)


_simple("m83_by_disease", ["total_yield", "production_count"], ["crop_disease_status"])
_simple("m91_sowing_harvest_season", ["total_yield"], ["sowing_season", "harvest_season"])


@query("m92_healthy_vs_diseased", farm_sql(
    f"""SELECT CASE WHEN grouping(crop_type) = 1 THEN 'All' ELSE crop_type END AS crop_type, round(sum({Y}) FILTER (crop_disease_status = 'No Disease'), 2) AS healthy_yield,
    round(sum({Y}) FILTER (crop_disease_status = 'Severe'), 2) AS diseased_yield,
    round(coalesce(sum({Y}) FILTER (crop_disease_status = 'No Disease'), 0) - coalesce(sum({Y}) FILTER (crop_disease_status = 'Severe'), 0), 2) AS yield_difference
    FROM farm GROUP BY ROLLUP (crop_type)"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, "crop_type", "crop_disease_status", Y)
    names = ("healthy_yield", "diseased_yield", "yield_difference")
    return pr.rounded(cube.contrast(fact, "total_yield", "crop_type", "crop_disease_status", "No Disease", "Severe", names), 2)


@query("m101_share_of_total", farm_sql(
    f"""SELECT crop_type, round(total_yield, 2) AS total_yield, round(total_yield / max(total_yield) FILTER (crop_type = 'All') OVER () * 100, 4) AS share_pct
    FROM ({cells_sql(["total_yield"], ["crop_type"], digits=6)})"""))  # fmt: skip
def _(spark, d):
    out = cube.share_of_all(farm(spark, d, *_columns(["total_yield"], "crop_type")), "total_yield", "crop_type")
    return pr.rounded(out.withColumn("total_yield", F.round("total_yield", 2)), 4)


@query("m102_best_irrigation_per_crop", farm_sql(
    """SELECT crop_type, irrigation_type, round(v, 2) AS water_efficiency FROM (SELECT crop_type, irrigation_type, sum(water_efficiency) AS v,
    row_number() OVER (PARTITION BY crop_type ORDER BY sum(water_efficiency) DESC, irrigation_type) AS k FROM farm
    GROUP BY crop_type, irrigation_type) WHERE k = 1"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, *_columns(["water_efficiency"], "crop_type", "irrigation_type"))
    return pr.rounded(cube.best_member(fact, "water_efficiency", "crop_type", "irrigation_type"), 2)


_simple(
    "m103_country_crop_dashboard",
    ["total_yield", "water_efficiency", "growing_score", "production_count"],
    ["country", "crop_type"],
)


@query("m00_cube_builder", farm_sql(cells_sql(["total_yield", "production_count"], ["country", "irrigation_type", "harvest_season"], "crop_type = 'LARGE'")))
def _(spark, d):
    measures, attributes = ["total_yield", "production_count"], ["country", "irrigation_type", "harvest_season"]
    fact = farm(spark, d, *_columns(measures, *attributes, "crop_type"))
    return pr.rounded(cube.cube_query(fact, measures, attributes, {"crop_type": "LARGE"}), 2)


@query("j07_member_cross_join", farm_sql(
    f"""SELECT c.crop_type, r.region, round(sum({Y}), 2) AS total_yield FROM (SELECT DISTINCT p_type AS crop_type FROM part) c
    CROSS JOIN (SELECT n_name AS region FROM nation) r LEFT JOIN farm f
    ON f.crop_type = c.crop_type AND f.region = r.region GROUP BY c.crop_type, r.region"""))  # fmt: skip
def _(spark, d):
    fact = farm(spark, d, "crop_type", "region", Y)
    sums = fact.groupBy("crop_type", "region").agg(F.sum(Y).alias("total_yield"))
    crops = table(spark, d, "part").select(F.col("p_type").alias("crop_type")).distinct()
    regions = table(spark, d, "nation").select(F.col("n_name").alias("region"))
    # the grid of two member sets is the asked result; facts meet it as sums
    return pr.rounded(crops.crossJoin(regions).join(sums, ["crop_type", "region"], "left"), 2)
