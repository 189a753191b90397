"""The registered models have the published sizes; nothing is fitted here."""

import pytest
from pyspark.ml.functions import array_to_vector

import __spark_entry__
from tillage.operators import models
from tillage.plans import models as plans


class Stopped(Exception):
    pass


@pytest.mark.parametrize("query", ["l06_random_forest", "l07_gradient_boosting", "l08_best_model", "e02_daily_pipeline"])
def test_published_sizes(spark, sf_dir, monkeypatch, query):
    seen = {}

    def train(rows, numeric, labels, chosen=None):
        seen.update(chosen or models.regressors())
        raise Stopped

    monkeypatch.setattr(plans.models, "train", train)
    with pytest.raises(Stopped):
        __spark_entry__.queries()[query](spark, sf_dir)
    if query in ("l08_best_model", "e02_daily_pipeline"):
        assert len(seen) == 3
    if "Random Forest" in seen:
        assert (seen["Random Forest"].getNumTrees(), seen["Random Forest"].getMaxDepth()) == (300, 18)
    if "Gradient Boosting" in seen:
        assert (seen["Gradient Boosting"].getMaxIter(), seen["Gradient Boosting"].getMaxDepth()) == (200, 4)


def test_boosting_walks_its_trees(spark):
    """Nodes kept per row cost a join of all rows at every level, and change no split."""
    boosting = models.regressors(rounds=3)["Gradient Boosting"]
    assert not boosting.getCacheNodeIds()
    rows = spark.range(400).selectExpr("array(double(id % 7), double(id * id % 31)) AS v", f"double(id % 7 * 10 + id * id % 31) AS {models.YIELD}")
    rows = rows.select(array_to_vector("v").alias("features"), models.YIELD).persist()
    kept = boosting.copy({boosting.cacheNodeIds: True})
    a, b = (m.fit(rows).toDebugString.split("\n", 1)[1] for m in (boosting, kept))
    assert a == b
