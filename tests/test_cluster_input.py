"""The clusters read what they need, and all records of it."""

import pytest

from tillage.operators import clustering
from tillage.plans import models as plans


class Stopped(Exception):
    pass


@pytest.fixture
def small_splits(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for k in old:
        spark.conf.set(k, "512")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def write(spark, folder, twice):
    lines = [(i // 2, i % 7, i % 9, i % 2 + 1, float(i % 11), 100.0 + i * 37 % 89, i % 5 / 100, i % 3 / 100) for i in range(400)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double",
    ).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    orders = [(i, i % 10) for i in range(200)] + [(3, 3)] * twice
    spark.createDataFrame([(None, 1), (None, 2), *orders], "o_orderkey long, o_custkey long").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame([(i, i % 3) for i in range(10)], "c_custkey long, c_nationkey long").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(i, f"n{i}") for i in range(3)], "n_nationkey long, n_name string").write.parquet(f"{folder}/nation.parquet")
    spark.createDataFrame([(i, f"t{i}", i) for i in range(7)], "p_partkey long, p_type string, p_size int").write.parquet(f"{folder}/part.parquet")


def asked(spark, folder, monkeypatch, *columns):
    seen = []

    def farm(spark, d, *wanted):
        seen.extend(wanted)
        raise Stopped

    with monkeypatch.context() as m, pytest.raises(Stopped):
        m.setattr(plans, "farm", farm)
        plans.clustered(spark, folder, *columns)
    return seen


def test_joins_that_no_column_needs_are_left_out(spark, tmp_path, monkeypatch, small_splits):
    write(spark, str(tmp_path), 0)
    assert set(asked(spark, str(tmp_path), monkeypatch)) == set(clustering.FEATURES)
    assert set(asked(spark, str(tmp_path), monkeypatch, "region")) == {"region", *clustering.FEATURES}
    rows = plans._ready(spark, str(tmp_path), "farm_id")
    assert rows.columns == ["farm_id", "features"] and rows.count() == 400


def test_repeated_lookups_repeat_their_records(spark, tmp_path, monkeypatch, small_splits):
    write(spark, str(tmp_path), 1)
    assert asked(spark, str(tmp_path), monkeypatch) == plans._CLUSTER_COLUMNS
    assert plans._ready(spark, str(tmp_path)).count() == 402


def test_records_that_are_dealt_out_stay_whole(spark, tmp_path, monkeypatch):
    write(spark, str(tmp_path), 0)
    assert asked(spark, str(tmp_path), monkeypatch) == plans._CLUSTER_COLUMNS
