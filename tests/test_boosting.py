"""Own boosting against the engine's, and the engine's random numbers."""

import re

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from tillage.operators import boosting, engine_draws, models

Y = models.YIELD


@pytest.fixture(scope="module")
def ready(spark):
    """More rows than the engine takes its cuts from, with labels, a constant and zeros."""
    rows = spark.range(13_000).selectExpr(
        "double(id % 37) AS a", "xxhash64(id) % 1000 / 10.0 AS b", "double(id % 2) AS c", "1.0 AS d", "concat('l', id % 5) AS l", "concat('m', hash(id) % 3) AS m",
        f"id % 37 * 10 + IF(xxhash64(id) % 1000 > 200, 50, id % 2 * 5) + IF(id % 5 = 2, 30, 0) + xxhash64(id, 1) % 1000 / 300 AS {Y}").repartition(5)
    fitted = models.Pipeline(stages=models.preprocessor(["a", "b", "c", "d"], ["l", "m"])).fit(rows)
    out = fitted.transform(rows).select("features", Y).persist()
    yield out
    out.unpersist()


def test_numbers_are_the_engines(spark):
    engine = spark._jvm.org.apache.spark.util.random.XORShiftRandom
    for seed in (0, 42, -7, 12_345_678_901):
        assert engine(seed).nextInt() == engine_draws.first_int(seed)
        theirs, mine = engine(seed), engine_draws.Uniform(seed)
        assert [theirs.nextDouble() for _ in range(2505)] == np.concatenate([mine.next(5), mine.next(0), mine.next(2500)]).tolist()


def test_trees_are_the_engines(spark, ready, tmp_path, monkeypatch):
    monkeypatch.setattr(boosting, "REBUILD", 3)
    monkeypatch.setattr(boosting, "BLOCK", 700)
    asked = {"maxIter": 5, "maxDepth": 4, "stepSize": 0.3, "seed": 7, "labelCol": Y, "cacheNodeIds": False}
    theirs, mine = GBTRegressor(**asked).fit(ready), boosting.BoostedRegressor(**asked).fit(ready)
    shape = [re.sub(r"Predict: \S+", "", m.toDebugString.split("\n", 1)[1]) for m in (theirs, mine)]
    assert shape[0] == shape[1] and shape[0].count("If") > 50
    assert np.allclose(theirs.featureImportances.toArray(), mine.featureImportances.toArray())
    both = mine.transform(theirs.transform(ready).withColumnRenamed("prediction", "p"))
    assert both.agg(F.max(F.abs(F.col("p") - F.col("prediction")))).first()[0] < 1e-9
    mine.write().overwrite().save(str(tmp_path / "m"))
    assert GBTRegressionModel.load(str(tmp_path / "m")).toDebugString == mine.toDebugString


def test_blocks_are_passed_not_vectors(ready, monkeypatch):
    """A pass for each level of each tree, over bytes; the engine is not asked."""
    passes, added = [], boosting.BoostedRegressor._added
    monkeypatch.setattr(GBTRegressor, "_fit_java", lambda *_: pytest.fail("the engine grows the trees"))
    monkeypatch.setattr(boosting.BoostedRegressor, "_added", lambda self, *a: passes.append(a[2]) or added(self, *a))
    models.regressors(rounds=2, boost_depth=3)["Gradient Boosting"].fit(ready)
    assert passes == [0, 1, 2, 0, 1, 2]


def test_equal_targets_and_other_settings(ready):
    flat = boosting.BoostedRegressor(maxIter=3, labelCol="one").fit(ready.withColumn("one", F.lit(4.0)))
    assert flat.transform(ready).select("prediction").distinct().collect() == [(4.0,)]
    assert boosting.BoostedRegressor(maxIter=2, labelCol=Y, subsamplingRate=0.5).fit(ready).getNumTrees == 2


@pytest.mark.parametrize("value", [None, float("nan")])
def test_missing_targets_are_refused_as_by_the_engine(ready, value):
    some = ready.limit(50).withColumn(Y, F.when(F.rand(1) > 0.3, F.col(Y)).otherwise(F.lit(value)))
    with pytest.raises(PySparkException):
        boosting.BoostedRegressor(maxIter=2, labelCol=Y).fit(some)
