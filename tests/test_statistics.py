import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillage.operators import profile as pr
from tillage.operators import stats
from tillage.operators.orderstats import LINEAR, RANK, UPPER, mode_of, order_statistics


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows and one value most of its rows; signs, ties and gaps occur."""
    rng = random.Random(7)
    rows = [("hot", 5.0)] * 400 + [("hot", rng.gauss(0, 100)) for _ in range(301)]
    rows += [("b", float(i)) for i in range(1, 5)] + [("one", -3.5)] + [(None, x) for x in (1.0, 2.0)]
    rows += [("b", None), ("none", None), ("tiny", 1e-12), ("tiny", -1e12), ("tiny", 1e12)]
    return rows, spark.createDataFrame(rows, "g string, v double").repartition(7)


def test_order_statistics_match_pandas(skewed):
    rows, df = skewed
    wanted = {f"p{int(p * 100)}": (p, LINEAR) for p in (0.0, 0.1, 0.25, 0.33, 0.5, 0.66, 0.75, 0.9, 1.0)}
    got = {r["g"]: r for r in order_statistics(df, ["g"], "v", wanted, count_as="n").collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        assert got[g]["n"] == len(vs)
        for name, (p, _) in wanted.items():
            assert got[g][name] == pytest.approx(pd.Series(vs).quantile(p), rel=1e-12, abs=1e-9), (g, name)


def test_upper_pick_and_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in (4, 1, 3, 2)], "v double")
    row = order_statistics(df, [], "v", {"m": (0.5, UPPER), "mid": (0.5, LINEAR), "r": (0.8, RANK), "top": (1.0, UPPER)}).first()
    assert (row["m"], row["mid"], row["r"], row["top"]) == (3.0, 2.5, 4.0, 4.0)


def test_order_statistics_by_scans_are_the_same(spark):
    rows = [(None if i % 5 == 0 else i % 3, None if i % 11 == 0 else float("nan") if i % 13 == 0 else (i * i % 97 - 40) / 7) for i in range(600)]
    df = spark.createDataFrame(rows, "g int, v double")
    wanted = {"lo": (0.33, LINEAR), "hi": (0.66, LINEAR), "up": (0.5, UPPER), "r": (0.8, RANK)}
    both = [{tuple(r) for r in order_statistics(df, ["g"], "v", wanted, count_as="n", scans=s).collect()} for s in (False, True)]
    assert both[0] == both[1] and len(both[0]) == 4


def test_order_statistics_of_nothing(spark):
    df = spark.createDataFrame([], "v double")
    assert order_statistics(df, [], "v", {"m": (0.5, LINEAR)}).collect() == []


def test_mode_tie_takes_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "v string")
    assert mode_of(df, [], "v").first()["top_value"] == "a"


def test_histogram_closes_last_bin_and_keeps_empty_ones(spark):
    values = [0.0, 0.1, 5.0, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    out = stats.histogram(df, "v", 4, density=True).orderBy("bin").collect()
    expected, edges = np.histogram(values, bins=4)
    assert [r["n"] for r in out] == list(expected)
    assert [r["start"] for r in out] == pytest.approx(list(edges[:-1]))
    assert sum(r["density"] * 2.5 for r in out) == pytest.approx(1.0)


def test_histogram_of_a_constant(spark):
    df = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert [r["n"] for r in stats.histogram(df, "v", 3).orderBy("bin").collect()] == [2, 0, 0]


def test_shape_matches_moments(spark):
    values = [1.0, 2.0, 2.0, 9.0]
    x = np.array(values)
    z = (x - x.mean()) / x.std()
    row = stats.shape(spark.createDataFrame([(v,) for v in values], "v double"), "v").first()
    assert row["skewness"] == pytest.approx((z**3).mean()) and row["kurtosis"] == pytest.approx((z**4).mean() - 3)
    flat = stats.shape(spark.createDataFrame([(1.0,), (1.0,)], "v double"), "v").first()
    assert flat["skewness"] == 0 and flat["kurtosis"] == 0


def test_correlation_of_constant_is_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "x double, y double")
    row = stats.pair_correlation(df, "x", "y").first()
    assert row["r"] == 0 and row["r_squared"] == 0


def test_correlation_matrix_is_pairwise_complete(spark):
    pdf = pd.DataFrame({"a": [1.0, 2.0, 3.0, None], "b": [2.0, None, 1.0, 5.0], "c": [1.0, 0.0, 4.0, 2.0]})
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in pdf.to_numpy().tolist()], "a double, b double, c double")
    want = pdf.corr()
    for r in stats.correlations(df, ["a", "b", "c"]).collect():
        assert r["r"] == pytest.approx(want.loc[r["row"], r["column"]])


def test_box_summary_counts_outliers(spark):
    values = [1.0, 2.0, 3.0, 4.0, 5.0, 100.0, 100.0]
    df = spark.createDataFrame([(v,) for v in values + [-50.0]], "v double")
    row = stats.box_summary(df, "v").first()
    far = [r["v"] for r in stats.outliers(df, "v").collect()]
    assert row["n"] == 8 and row["outliers"] == len(far)
    assert row["whisker_high"] <= row["upper_fence"]


def test_anova(spark):
    groups = {"a": [1.0, 2.0, 3.0], "b": [2.0, 3.0, 4.0], "c": [10.0, 11.0, 12.0]}
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("a", None)]
    row = stats.anova(spark.createDataFrame(rows, "g string, v double"), "g", "v").first()
    everything = np.concatenate([np.array(v) for v in groups.values()])
    between = sum(len(v) * (np.mean(v) - everything.mean()) ** 2 for v in groups.values())
    within = sum(((np.array(v) - np.mean(v)) ** 2).sum() for v in groups.values())
    assert row["f_value"] == pytest.approx((between / 2) / (within / 6))
    assert row["df_within"] == 6 and row["significant"]


def test_few_rows_take_default_coefficients(spark):
    rows = [("few", float(i), float(i)) for i in range(10)] + [("many", float(i), 3.0 * i + 1) for i in range(11)]
    df = spark.createDataFrame(rows, "crop_type string, rainfall_mm double, yield_kg_per_hectare double")
    out = {r["crop_type"]: r for r in stats.water_response(df).collect()}
    assert out["few"]["slope"] == 5 and out["few"]["max_water"] == 400
    assert out["many"]["slope"] == pytest.approx(3) and out["many"]["min_water"] == pytest.approx(1)


def test_heatmap_fills_the_grid(spark):
    df = spark.createDataFrame([("x1", "y1", 2.0), ("x1", "y1", 4.0), ("x2", "y2", 6.0)], "x string, y string, m double")
    cells = {(r["y"], r["x"]): (r["value"], r["n"]) for r in pr.heatmap(df, "x", "y", "m", "median").collect()}
    assert cells == {("y1", "x1"): (4.0, 2), ("y2", "x2"): (6.0, 1), ("y1", "x2"): (0.0, 0), ("y2", "x1"): (0.0, 0)}


def test_rate_without_hits_is_missing(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 0)], "g string, v int")
    out = {r["g"]: r["rate_pct"] for r in pr.rate_by_group(df, "g", F.col("v") == 1).collect()}
    assert out == {"a": 50.0, "b": None}
