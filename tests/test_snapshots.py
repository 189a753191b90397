"""Loads that fail halfway, are tried again, or meet nothing."""

import pytest
from pyspark.sql import functions as F

from tillage.session import fresh_path
from tillage.sources import files, snapshots


def test_a_failed_load_keeps_the_old_rows(spark):
    path = fresh_path(spark, "snapshots")
    schema = "id bigint, x double"
    assert snapshots.current(spark, path, schema).count() == 0
    with pytest.raises(FileNotFoundError):
        snapshots.current(spark, path)
    old = spark.range(10).select("id", (F.col("id") / 2).alias("x"))
    files.full_refresh(old, path)
    # some tasks write their rows before another one fails
    bad = spark.range(100).repartition(8).select("id", F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("double")).otherwise(1.0).alias("x"))
    with pytest.raises(Exception, match="broken row"):
        snapshots.load(bad, path, "second")
    assert sorted(r["id"] for r in snapshots.current(spark, path, schema).collect()) == list(range(10))
    # the same load again, now sound; and once more after it is complete
    snapshots.load(bad.where("id < 50"), path, "second")
    snapshots.load(old, path, "second")
    assert snapshots.current(spark, path).count() == 50 and snapshots.history(spark, path).count() == 2
    # a table may be rewritten from its own rows
    assert files.full_refresh(snapshots.current(spark, path).where("id < 5"), path).count() == 5


def test_audit_records_of_a_retried_run_count_once(spark):
    path = fresh_path(spark, "audit-retry")
    for run, n in (("a", 1), ("a", 1), ("b", 2), (None, 3), (None, 3)):
        files.append_audit(spark, path, status="SUCCESS", rows_processed=n, run_id=run)
    assert sorted(r["rows_processed"] for r in files.read_audit(spark, path).collect()) == [1, 2, 3, 3]
