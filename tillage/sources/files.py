"""CSV, JSON and Parquet sources and sinks with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from tillage.session import materialize
from tillage.sources import snapshots
from tillage.operators.cleaning import fill_lenient

_D, _S, _I = T.DoubleType(), T.StringType(), T.IntegerType()

# Columns of the farm file in order. Names with a percent sign become _pct.
FARM_FILE = [
    ("farm_id", _S), ("region", _S), ("crop_type", _S), ("soil_moisture_%", _D), ("soil_pH", _D),
    ("temperature_C", _D), ("rainfall_mm", _D), ("humidity_%", _D), ("sunlight_hours", _D),
    ("irrigation_type", _S), ("fertilizer_type", _S), ("pesticide_usage_ml", _D), ("sowing_date", T.DateType()),
    ("harvest_date", T.DateType()), ("total_days", _I), ("yield_kg_per_hectare", _D), ("sensor_id", _S),
    ("timestamp", T.DateType()), ("latitude", _D), ("longitude", _D), ("NDVI_index", _D),
    ("crop_disease_status", _S), ("sowing_month", _I), ("harvest_month", _I),
]
COMMODITY_FILE = ["Date", "CORN", "WHEAT", "SOYBEANS", "COTTON"]
PRODUCT_FILE = [
    ("Product", _S), ("Form", _S), ("AverageRetailPrice", _D), ("AverageRetailPriceUnitOfMeasure", _S),
    ("PreparationYieldFactor", _D), ("SizeOfACupEquivalent", _D), ("CupEquivalentUnitOfMeasure", _S),
    ("AveragePricePerCupEquivalent", _D), ("Category", _S),
]
DATE_COLUMNS = ["sowing_date", "harvest_date", "timestamp"]


def _schema(fields, text: tuple = ()) -> T.StructType:
    return T.StructType([T.StructField(n, _S if n in text else t, True) for n, t in fields])


def _plain(name: str) -> str:
    return name.replace("_%", "_pct")


def _reader(spark: SparkSession, schema: T.StructType):
    return spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("quote", '"').option("escape", '"')


def read_farm(spark: SparkSession, path: str) -> DataFrame:
    df = _reader(spark, _schema(FARM_FILE)).csv(path)
    return df.select(*[F.col(f"`{c}`").alias(_plain(c)) for c in df.columns])


def read_farm_none_labels(spark: SparkSession, path: str) -> DataFrame:
    """The token None is a label in two columns; it is read as missing and renamed there."""
    df = _reader(spark, _schema(FARM_FILE)).option("nullValue", "None").csv(path)
    df = df.select(*[F.col(f"`{c}`").alias(_plain(c)) for c in df.columns])
    return df.withColumns(
        {
            "irrigation_type": F.coalesce("irrigation_type", F.lit("No Irrigation")),
            "crop_disease_status": F.coalesce("crop_disease_status", F.lit("No Disease")),
        }
    )


def read_farm_lenient(spark: SparkSession, path: str) -> DataFrame:
    """Bad dates become missing; missing numbers take the median, labels the mode. The lines are parsed once."""
    df = _reader(spark, _schema(FARM_FILE, tuple(DATE_COLUMNS))).csv(path)
    df = df.select(*[F.col(f"`{c}`").alias(_plain(c)) for c in df.columns])
    return fill_lenient(materialize(df.withColumns({c: F.try_to_date(c) for c in DATE_COLUMNS}), "farm-read"))


def read_commodities(spark: SparkSession, path: str, columns: list[str], lenient: bool = False) -> DataFrame:
    """Daily prices with only the known commodities. ``columns`` is the file's header.

    Leniently, a bad date becomes missing and an absent file an empty table.
    """
    fields = [(c, _S if c == "Date" else _D) for c in columns]
    try:
        raw = _reader(spark, _schema(fields)).csv(path)
    except AnalysisException:
        if not lenient:
            raise
        raw = spark.createDataFrame([], _schema(fields))
    parse = F.try_to_date if lenient else F.to_date
    kept = [c for c in COMMODITY_FILE if c in columns and c != "Date"]
    return raw.select(parse(F.col("Date")).alias("date"), *kept)


def read_product_prices(spark: SparkSession, path: str) -> DataFrame:
    """Retail prices of fruit or vegetables; product names are quoted when they hold a comma."""
    return _reader(spark, _schema(PRODUCT_FILE)).csv(path)


def read_text_columns(spark: SparkSession, path: str, columns: list[str], corrupt: str = "corrupt_record") -> DataFrame:
    """A file as it stands: every column as text, and the whole line of a record with too few or too many."""
    schema = _schema([*((c, _S) for c in columns), (corrupt, _S)])
    return _reader(spark, schema).option("enforceSchema", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt).csv(path)


# ---- sinks -----------------------------------------------------------------------------------------------


def write_csv(df: DataFrame, path: str, quote_all: bool = False, compression: str = "none") -> str:
    # the escape option matches the readers: a quote inside a field is doubled
    writer = df.write.mode("overwrite").option("header", True).option("escape", '"').option("nullValue", "").option("emptyValue", "")
    writer.option("quoteAll", quote_all).option("compression", compression).csv(path)
    return path


def farm_file_columns(df: DataFrame) -> DataFrame:
    """Farm records under the names of the farm file."""
    return df.select(*[F.col(_plain(n)).alias(n) for n, _ in FARM_FILE if _plain(n) in df.columns])


def full_refresh(df: DataFrame, path: str, load_id: str | None = None) -> DataFrame:
    """Replace the rows of a table as a whole and read them back; until the new ones are complete, and
    if they never are, the old ones stay."""
    snapshots.load(df, path, load_id)
    return snapshots.current(df.sparkSession, path, df.schema)


# Headers of the explorer exports.
EXPLORER_HEADER = {
    "farm_id": "ID", "region": "Région", "crop_type": "Culture", "yield_kg_per_hectare": "Rendement (kg/ha)",
    "soil_moisture_pct": "Humidité sol (%)", "temperature_C": "Température (°C)",
    "rainfall_mm": "Précipitations (mm)", "crop_disease_status": "Statut maladie",
}
EXPLORER_HEADER_SHORT = {
    **EXPLORER_HEADER,
    "soil_moisture_pct": "Humidité (%)",
    "crop_disease_status": "Maladie",
    "irrigation_type": "Irrigation",
}


def explorer_export(df: DataFrame, short: bool = False) -> DataFrame:
    header = EXPLORER_HEADER_SHORT if short else EXPLORER_HEADER
    return df.select(*[F.col(c).alias(h) for c, h in header.items()])


SUMMARY_HEADER = {
    "variable": "Variable", "mean": "Mean", "std": "Std Dev", "min": "Min", "q1": "25%", "median": "Median",
    "q3": "75%", "max": "Max",
}


def summary_export(summary: DataFrame) -> DataFrame:
    return summary.select(
        *[(F.col(c) if c == "variable" else F.round(c, 2)).alias(h) for c, h in SUMMARY_HEADER.items()]
    )


AUDIT = "timestamp string, status string, dag_id string, execution_date string, rows_processed bigint, model_retrained boolean, model_path string, run_id string"


def append_audit(spark: SparkSession, path: str, **fields) -> str:
    """Append one run record as a JSON line. With a ``run_id``, ``read_audit`` counts a record once
    that a retried run has appended twice."""
    row = {n: fields.get(n) for n in [f.split()[0] for f in AUDIT.split(", ")]}
    spark.createDataFrame([row], AUDIT).coalesce(1).write.mode("append").json(path)
    return path


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    """The run records: of those with one ``run_id`` the first in order, and all without."""
    rows = spark.read.schema(AUDIT).json(path)
    named = rows.where(F.col("run_id").isNotNull()).groupBy("run_id").agg(F.min(F.struct(*rows.columns)).alias("r")).select("r.*")
    return rows.where(F.col("run_id").isNull()).unionByName(named)


def with_lineage(df: DataFrame, by: str) -> DataFrame:
    """Processing stamp, and the two basic metrics where they are not there yet."""
    from tillage.functions import agronomy as ag

    if "yield_per_day" not in df.columns:
        df = df.withColumn("yield_per_day", ag.yield_per_day())
    if "water_efficiency" not in df.columns:
        df = df.withColumn("water_efficiency", ag.per_unit_plus_one("yield_kg_per_hectare", "rainfall_mm"))
    return df.withColumns({"processed_at": F.current_timestamp(), "processed_by": F.lit(by)})
