"""The warehouse build reads its joins once and writes the export small."""

import datetime
import glob

from tillage.plans import pipelines
from tillage.plans.registry import Y
from tillage.sources.binding import COMMODITIES, CROP_MAPPING, STATIC


def inputs(spark):
    farms = spark.createDataFrame([(f"f{i}", c, float(100 + i)) for i, c in enumerate(["ECONOMY", "SMALL", None, "LARGE", "PROMO, \"x\""] * 30)], f"farm_id string, crop_type string, {Y} double")
    days = [(datetime.date(2024, 1, 1 + i), *[float(200 + i + j) for j in range(len(COMMODITIES))]) for i in range(5)]
    return farms, spark.createDataFrame(days, "date date, " + ", ".join(f"{c} double" for c in COMMODITIES))


def test_enriched_rows_are_made_once_and_exported_whole(spark, tmp_path):
    farms, prices = inputs(spark)
    lazy = pipelines.run_etl(farms, prices, mapping=CROP_MAPPING, static=STATIC)["enriched"]
    path = str(tmp_path / "enriched")
    stored = pipelines.run_etl(farms, prices, csv=path, mapping=CROP_MAPPING, static=STATIC)["enriched"]
    plan = stored._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and stored.columns == lazy.columns
    want = sorted(map(str, lazy.collect()))
    assert sorted(map(str, stored.collect())) == want
    assert glob.glob(f"{path}/*.csv.gz") and not glob.glob(f"{path}/*.csv")
    back = spark.read.schema(stored.schema).option("header", True).option("escape", '"').csv(path)
    assert sorted(map(str, back.collect())) == want
