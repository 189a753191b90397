"""The forest against a plain tree, in one task and split over tasks."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tillage.operators import forest, models


def plain_tree(x, y, w, depth):
    """Predictions of a tree grown by trying every cut of every feature at every node."""
    out = np.full(len(y), (w * y).sum() / w.sum())
    base = (w * y).sum() ** 2 / w.sum()
    best = (1e-9 * max(abs(base), 1), None)
    for f in range(x.shape[1]):
        for c in np.unique(x[:, f])[:-1]:
            go = x[:, f] <= c
            gain = (w * y)[go].sum() ** 2 / w[go].sum() + (w * y)[~go].sum() ** 2 / w[~go].sum() - base
            if gain > best[0] + 1e-9 * max(abs(base), 1):
                best = (gain, go)
    if depth and len(y) > 1 and best[1] is not None:
        for side in (best[1], ~best[1]):
            out[side] = plain_tree(x[side], y[side], w[side], depth - 1)
    return out


@pytest.mark.parametrize("depth", [0, 1, 3, 30])
def test_a_tree_equals_a_plain_one(depth):
    rng = np.random.default_rng(depth)
    x = np.c_[rng.integers(0, 9, (60, 2)), rng.integers(0, 2, 60), np.zeros(60, int)].astype(np.uint8)
    y, w = np.round(x[:, 0] * 3.0 + x[:, 2] * 7 + rng.normal(size=60), 2), rng.integers(1, 4, 60).astype(float)
    feature, cut, left, value, gains = forest.grow(x, y, w, depth, [9, 9, 2, 1])
    got = value[forest.walk(x, feature, cut, left)]
    assert np.allclose(got, plain_tree(x, y, w, depth))
    assert (gains > 0).sum() == len(set(feature[feature >= 0]))


def test_draws_are_poisson():
    rows = np.arange(200_000).astype(np.uint64)
    a, b = forest.draws(rows, 1, 42), forest.draws(rows, 2, 42)
    assert abs(a.mean() - 1) < 0.02 and abs(a.var() - 1) < 0.03 and abs(np.corrcoef(a, b)[0, 1]) < 0.01


@pytest.fixture(scope="module")
def table(spark):
    rows = spark.range(3000).select(
        (F.col("id") % 37).cast("double").alias("a"), (F.xxhash64("id") % 1000 / 10.0).alias("b"), (F.col("id") % 2).cast("double").alias("c"))
    rows = rows.withColumn("y", F.col("a") * 10 + F.when(F.col("b") > 20, 50).otherwise(F.col("c") * 5)).repartition(5)
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)


def test_forest(spark, table, tmp_path):
    whole = forest.ForestRegressor(numTrees=5, maxDepth=12, labelCol="y").fit(table)
    split = forest.ForestRegressor(numTrees=5, maxDepth=12, labelCol="y", localRows=400).fit(table)
    assert max(len(t.feature) for t in whole.tops) == 1 < max(len(t.feature) for t in split.tops)
    one = {r["a"]: r["prediction"] for r in whole.transform(table).where("c = 0 AND b < 0").groupBy("a").agg(F.avg("prediction").alias("prediction")).collect()}
    two = {r["a"]: r["prediction"] for r in split.transform(table).where("c = 0 AND b < 0").groupBy("a").agg(F.avg("prediction").alias("prediction")).collect()}
    assert one.keys() == two.keys() and all(abs(one[k] - two[k]) < 1e-6 for k in one)
    error = models.regression_metrics(whole.transform(table), "f", "y").first()
    assert error["R2"] > 0.99
    assert abs(whole.featureImportances.toArray() - split.featureImportances.toArray()).max() < 1e-6
    # saved within a pipeline and read back
    PipelineModel(stages=[whole]).write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    a, b = (sorted(r[0] for r in m.transform(table).select("prediction").collect()) for m in (whole, back))
    assert a == b
    # other columns and vectors pass through, a missing number goes to the right
    odd = table.limit(3).withColumn("prediction", F.lit("old"))
    assert whole.transform(odd).columns == [*table.columns, "prediction"]
    assert whole.transform(table.limit(0)).count() == 0


def test_forest_without_variety(spark):
    rows = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.createDataFrame([(1.0, 2.0)] * 30 + [(1.0, None)], "a double, y double"))
    model = forest.ForestRegressor(numTrees=2, maxDepth=3, labelCol="y").fit(rows)
    assert forest.ForestRegressor(numTrees=9, maxDepth=3, labelCol="y").fit(rows.limit(1)).transform(rows).first()["prediction"] == 2.0
    assert {r[0] for r in model.transform(rows).select("prediction").collect()} == {2.0}
    assert model.featureImportances.toArray().tolist() == [0.0]


def test_one_hot_columns_are_counted_together(monkeypatch):
    rng = np.random.default_rng(5)
    label = rng.integers(0, 21, 300)
    x = np.c_[rng.integers(0, 9, 300), label[:, None] == np.arange(20), rng.integers(0, 2, 300)].astype(np.uint8)
    y, w = np.round(x[:, 0] + label * 2.0 + rng.normal(size=300), 2), rng.integers(1, 4, 300).astype(float)
    passes, count = [], np.bincount
    monkeypatch.setattr(forest.np, "bincount", lambda *a, **k: passes.append(1) or count(*a, **k))
    feature, cut, left, value, _ = forest.grow(x, y, w, 4, [9] + [2] * 21)
    assert len(passes) < 4 * 22
    assert np.allclose(value[forest.walk(x, feature, cut, left)], plain_tree(x, y, w, 4))


def test_a_tree_does_not_depend_on_how_many_nodes_are_split_together(monkeypatch):
    rng = np.random.default_rng(6)
    x = np.c_[rng.integers(0, 9, (500, 3)), rng.integers(0, 2, (500, 3))].astype(np.uint8)
    y, w = rng.normal(size=500), rng.integers(1, 4, 500).astype(float)
    whole = forest.grow(x, y, w, 8, [9] * 3 + [2] * 3)
    monkeypatch.setattr(forest, "CELLS", 20)
    assert all(np.array_equal(a, b) for a, b in zip(whole, forest.grow(x, y, w, 8, [9] * 3 + [2] * 3)))


def test_only_the_smaller_child_of_a_large_node_is_counted(monkeypatch):
    rng = np.random.default_rng(7)
    x = rng.integers(0, 9, (20_000, 3)).astype(np.uint8)
    y, w = x[:, 0] * 3.0 + x[:, 1] + rng.normal(size=len(x)), np.ones(len(x))
    rows, count = [], np.bincount
    monkeypatch.setattr(forest.np, "bincount", lambda at, *a, **k: rows.append(len(at)) or count(at, *a, **k))
    feature, cut, left, value, _ = forest.grow(x, y, w, 4, [9] * 3)
    # two sums for each of 3 features: all rows at the root, then at most half of them; and two sums a level for the children
    assert sum(rows) <= len(x) * (2 * 3 * (1 + 3 * 0.5) + 2 * 4)
    assert np.allclose(value[forest.walk(x, feature, cut, left)], plain_tree(x, y, w, 4))


@pytest.mark.parametrize("depth", [3, 9])
def test_large_nodes_with_leaves_among_them(monkeypatch, depth):
    monkeypatch.setattr(forest, "WIDE_ROWS", 3)
    rng = np.random.default_rng(8)
    label = rng.integers(0, 6, 900)
    x = np.c_[rng.integers(0, 9, (900, 2)), label[:, None] == np.arange(5)].astype(np.uint8)
    y = np.where(label < 3, 4.0, np.round(x[:, 0] * 3.0 + label + x[:, 1] * rng.normal(size=900), 2))
    w = rng.integers(1, 4, 900).astype(float)
    feature, cut, left, value, _ = forest.grow(x, y, w, depth, [9, 9, 2, 2, 2, 2, 2])
    assert np.allclose(value[forest.walk(x, feature, cut, left)], plain_tree(x, y, w, depth))


def test_a_label_travels_as_one_byte(spark):
    rows = spark.range(200).selectExpr("id AS row", "double(id) AS y", "id % 4 AS l")
    rows = rows.select("row", "y", F.expr("unhex(concat(lpad(hex(row % 9), 2, '0'), " + ", ".join(f"IF(l = {i}, '01', '00')" for i in range(3)) + ", IF(row % 2 = 0, '01', '00')))").alias("bins"))
    fit, sizes = forest.ForestRegressor(numTrees=1, labelCol="y"), [9, 2, 2, 2, 2]
    total, units = fit._units(rows, sizes)
    assert total == 200 and units == [(0, 0), (1, 3), (4, 1)]
    columns = np.stack([np.frombuffer(r[0], np.uint8) for r in rows.select("bins").collect()], 1)
    codes = forest._coded(columns, units)
    assert codes.shape == (3, 200) and codes[1].tolist() == [(i % 4 + 1) % 4 for i in range(200)]


def test_every_tree_has_a_task_of_its_own(spark):
    slots = forest._slots(spark, 37)
    dealt = spark.createDataFrame([(s,) for s in slots], "slot bigint").repartition(37, "slot")
    assert sorted(r[0] for r in dealt.select(F.spark_partition_id()).collect()) == list(range(37))
