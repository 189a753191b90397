"""Data-quality checks: one row per check, from few passes over the data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.operators.profile import YIELD

REQUIRED = ["farm_id", "crop_type", "region", YIELD]
CRITICAL = ["farm_id", "crop_type", YIELD]

# Valid labels and ranges.
DOMAINS = {
    "crop_type": ["Wheat", "Maize", "Rice", "Soybean", "Cotton"],
    "region": ["North India", "South India", "Central USA", "South USA", "East Africa"],
    "fertilizer_type": ["Organic", "Inorganic", "Mixed"],
}
RANGES = {
    "soil_moisture_pct": (0, 100),
    "soil_pH": (0, 14),
    "temperature_C": (-20, 50),
    "rainfall_mm": (0, 1000),
    "humidity_pct": (0, 100),
    "sunlight_hours": (0, 24),
    "pesticide_usage_ml": (0, 100),
    YIELD: (0, 10000),
    "NDVI_index": (0, 1),
}
DECLARED_TYPES = {
    "farm_id": "string", "region": "string", "crop_type": "string", "soil_moisture_pct": "double",
    "soil_pH": "double", "temperature_C": "double", "rainfall_mm": "double", "humidity_pct": "double",
    "sunlight_hours": "double", "irrigation_type": "string", "fertilizer_type": "string",
    "pesticide_usage_ml": "double", YIELD: "double",
}
DATES = ["sowing_date", "harvest_date"]


def duplicate_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows beyond the first of each key; missing keys are equal to each other."""
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def full_duplicates(df: DataFrame) -> DataFrame:
    return df.groupBy(*df.columns).agg(F.count("*").alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias("duplicates")
    )


def invalid_labels(df: DataFrame, domains: dict | None = None, keep: int = 5) -> DataFrame:
    """Per column: how many rows and labels are outside the domain, and the first labels.

    Labels collapse before they meet; only ``keep`` per column are ever ranked together.
    """
    domains = {c: v for c, v in (domains or DOMAINS).items() if c in df.columns}
    pairs = F.array(
        *[
            F.when(
                ~F.coalesce(F.col(c).isin(v), F.lit(False)),
                F.struct(F.lit(c).alias("column"), F.coalesce(F.col(c), F.lit("null")).alias("label")),
            )
            for c, v in domains.items()
        ]
    )
    labels = (
        df.select(F.inline(F.array_compact(pairs))).groupBy("column", "label").agg(F.count("*").alias("n"))
    )
    totals = labels.groupBy("column").agg(F.sum("n").alias("invalid_rows"), F.count("*").alias("invalid_labels"))
    first = labels.withColumn("k", F.row_number().over(W.partitionBy("column").orderBy("label")))
    first = first.where(F.col("k") <= keep)
    shown = first.groupBy("column").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "label"))), lambda x: x["label"]), ", ").alias("shown")
    )
    return totals.join(shown, "column", "left")


def _check(name, passed, message, severity="error"):
    text = message if not isinstance(message, str) else F.lit(message)
    return F.struct(
        F.lit(name).alias("check"), passed.alias("passed"), text.alias("message"), F.lit(severity).alias("severity")
    )


def _say(ok_text, count, bad_text):
    return F.when(count == 0, F.lit(ok_text)).otherwise(F.concat(count.cast("string"), F.lit(bad_text)))


def validate(df: DataFrame, name: str = "dataset", domains: dict | None = None, ranges: dict | None = None, only: str = "") -> DataFrame:
    """The checks of a farm table whose name starts with ``only``: check, passed, message, severity.

    All counts come from one aggregate without a shuffle of rows. The duplicate count reads and shuffles
    the farm ids alone, and invalid labels their own columns; neither runs unless it is asked for.
    """
    asked_for = lambda check: check.startswith(only) or only.startswith(check)
    domains = DOMAINS if domains is None else domains
    ranges = {c: r for c, r in (RANGES if ranges is None else ranges).items() if c in df.columns}
    critical = [c for c in CRITICAL if c in df.columns]
    dates = [c for c in DATES if c in df.columns]
    missing = [c for c in REQUIRED if c not in df.columns]

    counts = {"rows": F.count("*")}
    for c in critical:
        counts[f"null_{c}"] = F.count_if(F.col(c).isNull())
    for c, (low, high) in ranges.items():
        counts[f"range_{c}"] = F.count_if((F.col(c) < low) | (F.col(c) > high))
    for c in dates:
        text = F.col(c).cast("string")
        counts[f"date_{c}"] = F.count_if(text.isNotNull() & F.try_to_date(text).isNull())
    s, h = (F.try_to_date(F.col(c).cast("string")) if c in dates else F.lit(None).cast("date") for c in DATES)
    if len(dates) == 2:
        counts["sequence"] = F.count_if(h <= s)
        if "total_days" in df.columns:
            counts["days"] = F.count_if(F.coalesce(F.datediff(h, s) != F.col("total_days"), F.lit(True)))

    by = "farm_id" in df.columns and asked_for("no_duplicates_")
    one = df.agg(*[F.coalesce(e, F.lit(0)).cast("bigint").alias(a) for a, e in counts.items()])
    if by:
        twice = df.groupBy("farm_id").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))
        one = one.crossJoin(F.broadcast(twice))

    n = F.col("rows")
    checks = [
        _check(
            "not_empty",
            n > 0,
            F.when(n > 0, F.concat(F.lit(f"{name} has "), n.cast("string"), F.lit(" rows"))).otherwise(f"{name} is empty"),
        ),
        _check(
            "required_columns",
            F.lit(not missing),
            "All required columns present" if not missing else f"Missing columns: {missing}",
        ),
    ]
    for c in critical:
        k = F.col(f"null_{c}")
        checks.append(_check(f"no_nulls_{c}", k == 0, _say(f"No nulls in {c}", k, f" nulls in {c}")))
    if by:
        k = F.col("duplicates")
        checks.append(
            _check("no_duplicates_farm_id", k == 0, _say("No duplicate farm_id", k, " duplicate farm_id"), "warning")
        )
    for c, (low, high) in ranges.items():
        k = F.col(f"range_{c}")
        ok = f"{c} values in range [{low}, {high}]"
        checks.append(_check(f"range_{c}", k == 0, _say(ok, k, f" {c} values out of range"), "warning"))
    for c in dates:
        k = F.col(f"date_{c}")
        checks.append(_check(f"valid_date_{c}", k == 0, _say(f"{c} dates are valid", k, f" invalid dates in {c}")))
    if "sequence" in counts:
        k = F.col("sequence")
        text = _say("All harvest dates after sowing", k, " records with invalid date sequence")
        checks.append(_check("harvest_after_sowing", k == 0, text))
    if "days" in counts:
        k = F.col("days")
        text = _say("total_days matches date difference", k, " mismatched total_days")
        checks.append(_check("total_days_consistency", k == 0, text, "warning"))
    counted = one.select(F.inline(F.array(*checks))).where(F.col("check").startswith(only))

    present = [c for c in domains if c in df.columns] if asked_for("valid_values_") else []
    if not present:
        return counted
    asked = df.sparkSession.createDataFrame([(c,) for c in present], "column string")
    found = asked.join(invalid_labels(df, domains), "column", "left")
    ok = F.col("invalid_rows").isNull()
    labels = found.select(
        F.concat(F.lit("valid_values_"), "column").alias("check"),
        ok.alias("passed"),
        F.when(ok, F.concat(F.lit("All "), "column", F.lit(" values valid")))
        .otherwise(F.concat(F.lit("Invalid "), "column", F.lit(" values: "), "shown"))
        .alias("message"),
        F.lit("error").alias("severity"),
    )
    return counted.unionByName(labels)


def summary(results: DataFrame, name: str = "dataset") -> DataFrame:
    """Passed and failed checks; only failed errors make the data invalid."""
    passed = F.col("passed")
    return results.agg(
        F.lit(name).alias("dataset"),
        F.count_if(passed).alias("validations_passed"),
        F.count_if(~passed).alias("validations_failed"),
        (F.count_if(~passed & (F.col("severity") == "error")) == 0).alias("is_valid"),
    )


def conformance(text: DataFrame, declared: dict | None = None, corrupt: str | None = None) -> DataFrame:
    """How the texts of a stored table convert to the declared types: a check per column, with the
    count of values that do not, and one for records that the reader could not split. One aggregate."""
    declared = declared or DECLARED_TYPES
    counts = {c: F.count_if(F.col(c).isNotNull() & F.expr(f"try_cast(`{c}` AS {t})").isNull()) for c, t in declared.items() if c in text.columns}
    broken = F.count_if(F.col(corrupt).isNotNull()) if corrupt else F.lit(0).cast("bigint")
    one = text.agg(*[e.alias(c) for c, e in counts.items()], broken.alias("__broken"))
    rows = [_check("corrupt_records", F.col("__broken") == 0, _say("All records can be read", F.col("__broken"), " corrupt records"))]
    for c, t in declared.items():
        if c in counts:
            k = F.col(c)
            rows.append(_check(f"type_{c}", k == 0, _say(f"{c} converts to {t}", k, f" values of {c} do not convert to {t}"), "warning"))
        else:
            rows.append(_check(f"type_{c}", F.lit(False), F.lit(f"{c} is absent, expected {t}"), "warning"))
    return one.select(F.inline(F.array(*rows)))


def source_kpis(df: DataFrame) -> DataFrame:
    """Rows, columns, distinct crops and regions of a source."""
    from tillage.operators.profile import distinct_counts

    totals = df.agg(F.count("*").alias("row_count"), F.lit(len(df.columns)).cast("bigint").alias("column_count"))
    unique = distinct_counts(df, ["crop_type", "region"]).agg(
        *[
            F.coalesce(F.max(F.when(F.col("variable") == c, F.col("unique_values"))), F.lit(0).cast("bigint")).alias(a)
            for c, a in (("crop_type", "crop_types"), ("region", "regions"))
        ]
    )
    return totals.crossJoin(F.broadcast(unique))


class EmptySource(RuntimeError):
    """The source of a pipeline holds no rows."""


def require_rows(df: DataFrame) -> int:
    """Row count of a source; an empty source stops the pipeline."""
    n = df.count()
    if n == 0:
        raise EmptySource("the source is empty")
    return n
