import math

import pytest
from pyspark.sql import functions as F

from tillage.functions import agronomy as ag


def column(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_right_closed_bins(spark):
    out = column(
        spark, [(20.0,), (20.1,), (30.0,), (30.1,), (None,)], "t double",
        ag.bin_right_closed("t", [20, 30], ["Cool", "Moderate_Temp", "Hot"]),
    )
    assert out == ["Cool", "Moderate_Temp", "Moderate_Temp", "Hot", None]


def test_climate_buckets(spark):
    rows = [(0.0,), (19.9,), (20.0,), (25.0,), (30.0,), (30.1,)]
    out = column(spark, rows, "temperature_C double", ag.temperature_bucket())
    assert out == [None, "<20°C", "20-25°C", "20-25°C", "25-30°C", ">30°C"]


def test_price_lookup_levels(spark):
    rows = [("Maize",), ("Wheat",), ("Olives",), ("Rye",)]
    with_rice = ag.crop_price("crop", {"CORN": F.lit(0.2)}, rice=F.lit(0.4))
    assert column(spark, rows, "crop string", with_rice) == [0.2, 0.0, 1.5, 0.4]
    assert column(spark, rows, "crop string", ag.crop_price("crop", {"CORN": F.lit(0.2)}))[3] == 0.45


def test_country(spark):
    rows = [("Nile Delta, Egypt",), ("North India",), ("Foo",)]
    assert column(spark, rows, "r string", ag.country_of("r")) == ["Egypt", "India", "Foo"]


def test_growing_score_keeps_missing_and_clips(spark):
    schema = "soil_moisture_pct double, soil_pH double, temperature_C double, NDVI_index double"
    rows = [(None, 6.5, 25.0, 0.5), (90.0, 6.5, 25.0, 1.0), (0.0, 0.0, 50.0, 0.0), (45.0, 6.5, 25.0, 0.0)]
    assert column(spark, rows, schema, ag.growing_score()) == [None, 100.0, 0.0, 75.0]


def test_synthetic_risk_never_high(spark):
    rows = [(85.0, 31.0), (60.0, 20.0), (75.0, 20.0)]
    assert column(spark, rows, "humidity_pct double, temperature_C double", ag.synthetic_risk()) == ["Medium", "Low", "Medium"]


def test_zero_days_have_no_rate(spark):
    rows = [(100.0, 0), (100.0, 50)]
    assert column(spark, rows, "yield_kg_per_hectare double, total_days int", ag.yield_per_day()) == [None, 2.0]


def test_labels(spark):
    assert column(spark, [(0.6,), (-0.4,), (0.1,)], "r double", ag.strength_three("r")) == ["Strong", "Moderate", "Weak"]
    assert column(spark, [(0.8,), (-0.5,), (0.3,), (0.2,)], "r double", ag.strength_four("r")) == ["strong", "moderate", "weak", "none"]
    assert column(spark, [(0.0,), (5000.0,), (3000.0,), (1.0,), (None,)], "y double", ag.yield_class("y")) == [
        "muted", "success", "warning", "danger", "muted",
    ]
    words = [("No Disease",), ("SEVERE blight",), ("léger",), (None,), ("odd",)]
    assert column(spark, words, "s string", ag.disease_class("s")) == ["success", "danger", "secondary", "secondary", "secondary"]
    assert column(spark, words, "s string", ag.disease_class("s", bilingual=True))[2] == "info"


def test_rule_score(spark):
    schema = "crop_type string, soil_moisture_pct double, soil_pH double, crop_disease_status string, irrigation_type string"
    rows = [("Corn", 50.0, 6.5, "No Disease", "Drip"), ("Rye", 20.0, 8.0, "Severe", "Flood")]
    got = column(spark, rows, schema, ag.rule_score())
    assert got == pytest.approx([4500 * 1.35, 3500 * 0.1])


def test_recommendations_fill_up_and_cap(spark):
    schema = "soil_moisture_pct double, soil_pH double, crop_disease_status string, NDVI_index double, irrigation_type string"
    rows = [(50.0, 6.5, "No Disease", 0.6, "Drip"), (20.0, 5.0, "Mild", 0.1, "Flood"), (80.0, 6.5, "No Disease", 0.6, "Drip")]
    out = column(spark, rows, schema, ag.recommendations())
    assert [x["category"] for x in out[0]] == ["Fertilization", "Crop Rotation", "Pest Management"]
    assert [x["category"] for x in out[1]] == ["Irrigation", "Soil Management", "Disease Control", "Crop Health", "Irrigation"]
    assert "(Mild)" in out[1][2]["message"]
    assert [x["category"] for x in out[2]] == ["Drainage", "Fertilization", "Crop Rotation"]


def test_transactions_skip_missing(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    out = df.select(ag.transaction_items(["x", "y"]).alias("i"), ag.item_text(ag.transaction_items(["x", "y"])).alias("t")).collect()
    assert [r["i"] for r in out] == [["x=a"], ["x=b", "y=c"]]
    assert [r["t"] for r in out] == ["a", "b, c"]


def test_seasonal_price_is_held_in_its_band(spark):
    df = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-12-31')) AS d")
    prices = [r[0] for r in df.select(ag.seasonal_price("d", volatility=0.9)).collect()]
    assert min(prices) == pytest.approx(0.45 * 0.7) and max(prices) == pytest.approx(0.45 * 1.3)
    assert prices[0] == pytest.approx(0.45 * (1 + 0.9 * math.sin(2 * math.pi / 365)))


def test_input_defaults(spark):
    df = spark.createDataFrame([(None, "Rice")], "temperature_C double, crop_type string")
    row = ag.with_input_defaults(df).first()
    assert row["temperature_C"] == 25.0 and row["crop_type"] == "Rice" and row["region"] == "North"
