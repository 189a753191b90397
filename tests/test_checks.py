"""Typed loads, constraints, conformance, sums of products and weighted itemsets on odd rows."""

from itertools import combinations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillage.operators import mining, models, quality, stats
from tillage.operators import warehouse as wh
from tillage.sources import files


def test_overflow_goes_to_quarantine(spark):
    rows = [("a", 1.005, 5.0), ("b", 99999.0, 5.0), ("c", None, None), ("d", 1.0, -1e9), ("e", 99999.0, 1e9), ("f", 999.995, 0.0)]
    df = spark.createDataFrame(rows, "id string, x double, y double")
    good, bad = wh.split_overflow(df, {"x": "decimal(5,2)", "y": "decimal(4,1)", "z": "int"})
    assert dict(good.dtypes)["x"] == "decimal(5,2)"
    assert sorted(r["id"] for r in good.collect()) == ["a", "c"]
    assert {r["id"]: r["overflowed"] for r in bad.collect()} == {"b": ["x"], "d": ["y"], "e": ["x", "y"], "f": ["x"]}
    prices = spark.createDataFrame([("2024-01-02", 1, 0.5), ("2024-01-01", 2, 1e9), ("2024-01-01", 3, 0.25)], "price_date string, time_id int, corn_eur_per_kg double")
    good, bad = wh.typed_prices(prices, "2024-01-01 06:00:00")
    assert [(r["price_id"], r["time_id"]) for r in good.orderBy("price_id").collect()] == [(1, 3), (2, 1)] and bad.count() == 1
    assert wh.typed_prices(prices.limit(0), "2024-01-01")[0].count() == 0


def test_constraints(spark):
    crop = spark.createDataFrame([(1, "a"), (2, "a"), (3, None), (4, None), (5, "b")], "crop_id int, crop_type string")
    fact = spark.createDataFrame([("f", 1), (None, 9), ("g", 9), ("h", None)], "farm_id string, crop_id int")
    declared = [("crop", "unique", "crop_type"), ("crop", "not_null", "crop_type"), ("crop", "unique", "crop_id"), ("production", "not_null", "farm_id"), ("production", "foreign_key", "crop_id", "crop", "crop_id")]
    got = {(r["table"], r["kind"], r["column"]): r["violations"] for r in wh.constraint_report({"crop": crop, "production": fact}, declared).collect()}
    assert got == {("crop", "unique", "crop_type"): 1, ("crop", "not_null", "crop_type"): 2, ("crop", "unique", "crop_id"): 0, ("production", "not_null", "farm_id"): 1, ("production", "foreign_key", "crop_id"): 2}
    empty = wh.constraint_report({"crop": crop.limit(0), "production": fact.limit(0)}, declared)
    assert {r["violations"] for r in empty.collect()} == {0}


def test_conformance_of_a_dirty_file(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b,c\n1,2024-01-01,x\noops,2024-13-01,y\n3\n,,\n4,2024-02-02,z,extra\n")
    text = files.read_text_columns(spark, str(tmp_path / "f.csv"), ["a", "b", "c"])
    got = {r["check"]: (r["passed"], r["message"]) for r in quality.conformance(text, {"a": "double", "b": "date", "c": "string", "d": "int"}, "corrupt_record").collect()}
    assert got["corrupt_records"] == (False, "2 corrupt records")
    assert got["type_a"] == (False, "1 values of a do not convert to double") and got["type_b"][0] is False
    assert got["type_c"][0] and got["type_d"] == (False, "d is absent, expected int")


def test_correlations_with_gaps(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 4)) + 1e6
    x[:, 3] = 7.0
    x[rng.random(x.shape) < 0.2] = np.nan
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd"))).repartition(4)
    got = {(r["row"], r["column"]): r["r"] for r in stats.correlations(df, list("abcd")).collect()}
    want = pd.DataFrame(x, columns=list("abcd")).corr()
    assert len(got) == 16
    for (p, q), r in got.items():
        if "d" in (p, q) and p != q:
            assert r is None
        else:
            assert abs(r - (1 if p == q else want.loc[p, q])) < 1e-6
    assert {r["r"] for r in stats.correlations(df.limit(0), ["a", "b"]).collect()} == {None, 1.0}


@pytest.mark.parametrize("support", [0.05, 0.3])
def test_itemsets_equal_brute_force(spark, support):
    rng = np.random.default_rng(3)
    rows = [[f"i{j}" for j in range(70) if rng.random() < 0.9 / (1 + j)] for _ in range(120)] + [[], ["i0", "i0", None], [None]] * 3
    df = spark.createDataFrame([(r,) for r in rows], "items array<string>").repartition(4)
    baskets = [frozenset(x for x in r if x is not None) for r in rows]
    want, names = {}, sorted(set().union(*baskets))
    for k in range(1, 7):
        for s in combinations(names, k) if k < 3 else {tuple(sorted({*a, b})) for a in [w for w in want if len(w) == k - 1] for b in names if b not in a}:
            n = sum(set(s) <= b for b in baskets)
            if n >= support * len(baskets):
                want[s] = n
    got = {tuple(r["items"]): r["freq"] for r in mining.frequent_itemsets(df, support).collect()}
    assert got == want
    assert mining.frequent_itemsets(df.limit(0)).count() == 0


def test_normal_equations(spark):
    rng = np.random.default_rng(4)
    n = 300
    pdf = pd.DataFrame({"a": rng.normal(size=n), "k": rng.choice(list("xyz"), n)})
    pdf["y"] = 3 * pdf["a"] + pdf["k"].map({"x": 0, "y": 5, "z": 9}) + rng.normal(size=n)
    design = np.c_[pdf["a"], pd.get_dummies(pdf["k"]).to_numpy(float)]
    pdf["prediction"] = design @ np.linalg.lstsq(design, pdf["y"], rcond=None)[0]
    got = models.normal_equations(spark.createDataFrame(pdf), ["a"], ["k"], "y").collect()
    assert len(got) == 4 and max(abs(r["rest"]) for r in got) < 1e-9
    worse = spark.createDataFrame(pdf).withColumn("prediction", F.col("prediction") + F.when(F.col("k") == "x", 1.0).otherwise(0.0))
    assert max(abs(r["rest"]) for r in models.normal_equations(worse, ["a"], ["k"], "y").collect()) > 0.1
