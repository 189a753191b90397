"""The first centres of all k, drawn together, against the engine's own draws."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from tillage.operators import clustering, engine_draws


def vectors(spark, rows, parts, of):
    cells = F.array(*[(F.xxhash64("id", F.lit(i)) % of / 100.0 + F.lit(float(i))) for i in range(4)])
    return spark.range(0, rows, 1, parts).select(array_to_vector(cells).alias("features"))


@pytest.mark.parametrize("rows,parts,of", [(20_000, 7, 1000), (300, 3, 1000), (400, 2, 1), (5, 1, 50), (40, 9, 1000)])
def test_centres_are_the_engines(spark, rows, parts, of):
    ready = vectors(spark, rows, parts, of).persist()
    cells = clustering._cells(ready).persist()
    drawn = clustering._drawn(cells, list(range(2, 9)))
    for k, centres in drawn.items():
        engine = KMeans(k=k, seed=clustering.SEED, featuresCol="features", maxIter=0, solver="row").fit(ready)
        assert np.allclose(np.array(engine.clusterCenters()), centres, atol=1e-9)
    cells.unpersist(), ready.unpersist()


def test_a_pass_draws_for_every_k(spark, monkeypatch):
    """Seven passes for all k, none of them the engine's."""
    ready, passes, told = vectors(spark, 3000, 3, 1000), [], clustering._told
    monkeypatch.setattr(KMeans, "_fit", lambda *_: pytest.fail("the engine draws"))
    monkeypatch.setattr(clustering, "_told", lambda *a: passes.append(1) or told(*a))
    assert len(clustering.fitted(ready)) == 7 and len(passes) == 7


@pytest.mark.parametrize("fraction", [0.0005, 0.02, 0.4, 0.6, 1.0])
def test_sampled_places_are_the_engines(spark, fraction):
    rows = spark.sparkContext._jvm.java.util.ArrayList(list(range(6000)))
    sample = spark.sparkContext._jsc.parallelize(rows, 1).sample(False, fraction, 11).collect()
    seed = spark.sparkContext._jvm.java.util.Random(11).nextLong()
    assert list(sample) == engine_draws.sampled_places(6000, fraction, seed).tolist()
