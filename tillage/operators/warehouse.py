"""Star schema: dimensions with surrogate keys, production and price facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.functions import agronomy as ag
from tillage.operators.profile import YIELD
from tillage.session import materialize, task_count


# ---- surrogate keys ----------------------------------------------------------------------------------


def insert_if_absent(new: DataFrame, key: str, id_column: str, existing: DataFrame | None = None) -> DataFrame:
    """Members of ``existing`` unchanged, then the new ones numbered after them by natural key.

    The numbering window runs over dimension members only (labels, days), never over facts.
    """
    new = new.where(F.col(key).isNotNull())
    if existing is None:
        return new.withColumn(id_column, F.row_number().over(W.orderBy(key))).select(id_column, *new.columns)
    fresh = new.join(existing, key, "left_anti")
    last = existing.agg(F.coalesce(F.max(id_column), F.lit(0)).alias("__last"))
    numbered = fresh.crossJoin(F.broadcast(last)).withColumn(
        id_column, (F.row_number().over(W.orderBy(key)) + F.col("__last")).cast("int")
    )
    return existing.unionByName(numbered.select(*existing.columns))


# ---- dimensions ------------------------------------------------------------------------------------------


def crop_members(df: DataFrame) -> DataFrame:
    return df.groupBy("crop_type").agg(F.avg("price_per_kg_EUR").alias("price_per_kg_EUR"))


def region_members(df: DataFrame) -> DataFrame:
    """One row per region name; of several countries the first by name."""
    return df.groupBy(F.col("region").alias("region_name")).agg(F.min("country").alias("country"))


def label_members(df: DataFrame, column: str, name: str) -> DataFrame:
    return df.select(F.col(column).alias(name)).distinct()


def farm_dates(df: DataFrame) -> DataFrame:
    """Distinct sowing and harvest dates from one scan."""
    return (
        df.select(F.explode(F.array("sowing_date", "harvest_date")).alias("full_date"))
        .where(F.col("full_date").isNotNull())
        .distinct()
    )


def date_parts(df: DataFrame, date: str = "full_date") -> DataFrame:
    month = F.month(date)
    return df.withColumns(
        {
            "year": F.year(date),
            "month": month,
            "day": F.dayofmonth(date),
            "quarter": F.quarter(date),
            "month_name": F.date_format(date, "MMMM"),
            "season": ag.season(month),
        }
    )


def dim_crop(df, existing=None):
    return insert_if_absent(crop_members(df), "crop_type", "crop_id", existing)


def dim_region(df, existing=None):
    return insert_if_absent(region_members(df), "region_name", "region_id", existing)


def dim_irrigation(df, existing=None):
    members = label_members(df, "irrigation_type", "irrigation_type")
    return insert_if_absent(members, "irrigation_type", "irrigation_id", existing)


def dim_disease(df, existing=None):
    members = label_members(df, "crop_disease_status", "disease_status")
    return insert_if_absent(members, "disease_status", "disease_id", existing)


def dim_time(dates: DataFrame, existing=None):
    return insert_if_absent(date_parts(dates.select("full_date").distinct()), "full_date", "time_id", existing)


# ---- facts ---------------------------------------------------------------------------------------------------

# Column types of the production fact and of the price fact.
PRODUCTION_TYPES = {
    "total_days": "int", "soil_moisture_pct": "decimal(5,2)", "soil_pH": "decimal(4,2)",
    "temperature_C": "decimal(5,2)", "rainfall_mm": "decimal(8,2)", "humidity_pct": "decimal(5,2)",
    "sunlight_hours": "decimal(5,2)", "pesticide_usage_ml": "decimal(8,2)", "NDVI_index": "decimal(4,2)",
    YIELD: "decimal(10,2)", "price_per_kg_EUR": "decimal(10,4)", "revenue_per_hectare_EUR": "decimal(12,2)",
    "yield_per_day": "decimal(10,4)", "water_efficiency": "decimal(10,4)",
    "growing_conditions_score": "decimal(5,2)", "latitude": "decimal(10,6)", "longitude": "decimal(10,6)",
}
PRICE_COLUMNS = {
    "CORN_EUR_PER_KG": "corn_eur_per_kg",
    "WHEAT_EUR_PER_KG": "wheat_eur_per_kg",
    "SOYBEANS_EUR_PER_KG": "soybean_eur_per_kg",
    "COTTON_EUR_PER_KG": "cotton_eur_per_kg",
    "RICE_EUR_PER_KG": "rice_eur_per_kg",
}
PRICE_TYPE = "decimal(10,4)"


def _lookup(fact: DataFrame, dim: DataFrame, natural: str, fact_column: str, id_column: str, as_id: str):
    """Replace a natural key by its surrogate key; no match gives a missing key.

    No join hint: the dimensions are written tables of known size, which Spark broadcasts
    while they are small and joins by shuffle when they are not.
    """
    keys = dim.select(F.col(natural).alias(f"__{as_id}"), F.col(id_column).alias(as_id))
    return fact.join(keys, fact[fact_column] == keys[f"__{as_id}"], "left").drop(f"__{as_id}")


def with_dimension_keys(df: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    df = _lookup(df, dims["crop"], "crop_type", "crop_type", "crop_id", "crop_id")
    df = _lookup(df, dims["region"], "region_name", "region", "region_id", "region_id")
    df = _lookup(df, dims["irrigation"], "irrigation_type", "irrigation_type", "irrigation_id", "irrigation_id")
    df = _lookup(df, dims["disease"], "disease_status", "crop_disease_status", "disease_id", "disease_id")
    df = _lookup(df, dims["time"], "full_date", "sowing_date", "time_id", "sowing_time_id")
    return _lookup(df, dims["time"], "full_date", "harvest_date", "time_id", "harvest_time_id")


KEY_COLUMNS = ["crop_id", "region_id", "irrigation_id", "disease_id", "sowing_time_id", "harvest_time_id"]


def fact_production(df: DataFrame, dims: dict[str, DataFrame], typed: bool = False) -> DataFrame:
    """Measures with the six dimension keys; ``typed`` casts to the declared decimals."""
    df = with_dimension_keys(df, dims)
    measures = [c for c in PRODUCTION_TYPES if c in df.columns]
    cast = {c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in PRODUCTION_TYPES.items()} if typed else {}
    plain = ["farm_id", *KEY_COLUMNS, "sowing_date", "harvest_date"]
    extra = [c for c in ("sensor_id",) if c in df.columns]
    return df.select(*plain, *[cast.get(c, F.col(c)).alias(c) for c in measures], *extra)


def fact_prices(prices: DataFrame, rice: DataFrame, time: DataFrame, typed: bool = False) -> DataFrame:
    joined = prices.join(rice, "date", "left")
    keyed = _lookup(joined, time, "full_date", "date", "time_id", "time_id")

    def price(a):
        return F.col(a).cast(PRICE_TYPE) if typed else F.col(a)

    named = [price(a).alias(b) for a, b in PRICE_COLUMNS.items() if a in keyed.columns]
    return keyed.select("time_id", F.col("date").alias("price_date"), *named)


def split_overflow(df: DataFrame, types: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """The rows cast to the declared types, and the quarantine: the untouched rows of which a value
    does not fit its type, with the names of these columns. Missing values fit every type."""
    known = {c: F.expr(f"try_cast(`{c}` AS {t})") for c, t in types.items() if c in df.columns}
    lost = F.array_compact(F.array(*[F.when(F.col(c).isNotNull() & e.isNull(), F.lit(c)) for c, e in known.items()]))
    marked = df.withColumn("overflowed", lost)
    good = marked.where(F.size("overflowed") == 0).select(*[known.get(c, F.col(c)).alias(c) for c in df.columns])
    return good, marked.where(F.size("overflowed") > 0)


def typed_production(df: DataFrame, dims: dict[str, DataFrame], stamp: str, types: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """The production fact as declared: decimals, ids 1, 2, ... in farm order, the time of the load; and its quarantine."""
    good, bad = split_overflow(fact_production(df, dims), types or PRODUCTION_TYPES)
    order = [c for c in ("farm_id", "sensor_id") if c in good.columns]
    return numbered(good, "production_id", *order).withColumn("created_at", F.lit(stamp).cast("timestamp")), bad


def typed_prices(prices: DataFrame, stamp: str) -> tuple[DataFrame, DataFrame]:
    """The price fact as declared, in the order of its days; and its quarantine."""
    good, bad = split_overflow(prices, dict.fromkeys(PRICE_COLUMNS.values(), PRICE_TYPE))
    return numbered(good, "price_id", "price_date").withColumn("created_at", F.lit(stamp).cast("timestamp")), bad


def extend_time(time: DataFrame, prices: DataFrame) -> DataFrame:
    """Price days not yet in the time dimension come after the farm days."""
    dates = prices.select(F.col("date").alias("full_date")).where(F.col("date").isNotNull())
    return dim_time(dates, time)


def members(df: DataFrame) -> DataFrame:
    """The members of all dimensions: kind, label, extra and mean price.

    Rows collapse to their combination of labels, and to their days, within the task that read
    them; only those short lists are taken apart into members.
    """
    text = F.lit(None).cast("string")
    price = F.col("price_per_kg_EUR") if "price_per_kg_EUR" in df.columns else F.lit(None).cast("double")
    labels = ["crop_type", "region", "country", "irrigation_type", "crop_disease_status"]
    combined = df.groupBy(*labels).agg(F.sum(price).alias("s"), F.count(price).alias("c"))
    named = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), F.col(c).alias("label"), extra.alias("extra"))
            for kind, c, extra in (
                ("crop", "crop_type", text),
                ("region", "region", F.col("country")),
                ("irrigation", "irrigation_type", text),
                ("disease", "crop_disease_status", text),
            )
        ]
    )
    rows = combined.select(F.inline(named), "s", "c").where(F.col("label").isNotNull())
    named_rows = rows.groupBy("kind", "label", "extra").agg(F.try_divide(F.sum("s"), F.sum("c")).alias("price"))
    days = farm_dates(df).select(
        F.lit("day").alias("kind"), F.col("full_date").cast("string").alias("label"), text.alias("extra"),
        F.lit(None).cast("double").alias("price"),
    )
    return named_rows.unionByName(days)


def warehouse_of(df: DataFrame, prices: DataFrame | None = None, rice: DataFrame | None = None) -> dict[str, DataFrame]:
    """All tables of the warehouse.

    The members are written once to the shared folder. What derives from that small table has
    a known size, so the facts look their keys up by broadcast as long as it stays small.
    """
    known = materialize(members(df), "members")

    def of(kind):
        return known.where(F.col("kind") == kind)

    crops = of("crop").select(F.col("label").alias("crop_type"), F.col("price").alias("price_per_kg_EUR"))
    regions = of("region").groupBy(F.col("label").alias("region_name")).agg(F.min("extra").alias("country"))
    days = of("day").select(F.to_date("label").alias("full_date"))
    time = dim_time(days)
    if prices is not None:
        time = extend_time(time, prices)
    tables = {
        "crop": insert_if_absent(crops, "crop_type", "crop_id"),
        "region": insert_if_absent(regions, "region_name", "region_id"),
        "irrigation": insert_if_absent(of("irrigation").select(F.col("label").alias("irrigation_type")), "irrigation_type", "irrigation_id"),
        "disease": insert_if_absent(of("disease").select(F.col("label").alias("disease_status")), "disease_status", "disease_id"),
        "time": materialize(time, "dim_time") if prices is not None else time,
    }
    tables["production"] = fact_production(df, tables)
    if prices is not None:
        tables["prices"] = fact_prices(prices, rice, tables["time"])
    return tables


# ---- warehouse queries -----------------------------------------------------------------------------------------


def star_rows(t: dict[str, DataFrame]) -> DataFrame:
    """Production with its dimension labels; seasons are optional, the other keys required."""
    f = t["production"]
    sow = t["time"].select(F.col("time_id").alias("sowing_time_id"), F.col("season").alias("sowing_season"))
    harvest = t["time"].select(F.col("time_id").alias("harvest_time_id"), F.col("season").alias("harvest_season"))
    return (
        f.join(t["crop"].select("crop_id", "crop_type"), "crop_id")
        .join(t["region"].select("region_id", "region_name"), "region_id")
        .join(t["irrigation"].select("irrigation_id", "irrigation_type"), "irrigation_id")
        .join(t["disease"].select("disease_id", "disease_status"), "disease_id")
        .join(sow, "sowing_time_id", "left")
        .join(harvest, "harvest_time_id", "left")
    )


def latest_prices(t: dict[str, DataFrame], n: int = 5) -> DataFrame:
    time = t["time"].select("time_id", "year", "quarter", "season")
    return t["prices"].join(time, "time_id").orderBy(F.desc("price_date")).limit(n)


def season_yield(t: dict[str, DataFrame]) -> DataFrame:
    """Mean yield and farms per sowing season.

    Rows collapse per time key first, so the join sees at most one row per day.
    """
    per_day = t["production"].groupBy("sowing_time_id").agg(F.sum(YIELD).alias("s"), F.count(YIELD).alias("c"), F.count("*").alias("n"))
    time = t["time"].select(F.col("time_id").alias("sowing_time_id"), "season").where(F.col("season").isNotNull())
    seasons = per_day.join(time, "sowing_time_id").groupBy("season")
    return seasons.agg(
        (F.sum("s") / F.sum("c")).alias("avg_yield"), F.sum("n").alias("farm_count")
    ).orderBy(F.desc("avg_yield"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("table"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


# ---- declared constraints ------------------------------------------------------------------------------------------


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def orphan_count(fact: DataFrame, key: str, dim: DataFrame, id_column: str) -> DataFrame:
    """Keys of the fact without a dimension member; a missing key is allowed.

    Only the distinct keys meet the dimension, with their row counts.
    """
    keys = fact.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(F.count("*").alias("c"))
    ids = dim.select(F.col(id_column).alias("__key"))
    lost = keys.join(ids, "__key", "left_anti")
    return lost.agg(F.lit(key).alias("key"), F.coalesce(F.sum("c"), F.lit(0)).cast("bigint").alias("orphans"))


# The constraints of the star schema (table, kind, column, referenced table and column).
CONSTRAINTS = [
    ("crop", "unique", "crop_type"), ("region", "unique", "region_name"), ("irrigation", "unique", "irrigation_type"),
    ("disease", "unique", "disease_status"), ("time", "unique", "full_date"),
    ("crop", "not_null", "crop_type"), ("region", "not_null", "region_name"), ("irrigation", "not_null", "irrigation_type"),
    ("disease", "not_null", "disease_status"), ("time", "not_null", "full_date"), ("production", "not_null", "farm_id"), ("prices", "not_null", "price_date"),
    ("production", "foreign_key", "crop_id", "crop", "crop_id"), ("production", "foreign_key", "region_id", "region", "region_id"),
    ("production", "foreign_key", "irrigation_id", "irrigation", "irrigation_id"), ("production", "foreign_key", "disease_id", "disease", "disease_id"),
    ("production", "foreign_key", "sowing_time_id", "time", "time_id"), ("production", "foreign_key", "harvest_time_id", "time", "time_id"),
    ("prices", "foreign_key", "time_id", "time", "time_id"),
]


def constraint_report(tables: dict[str, DataFrame], declared: list[tuple] | None = None) -> DataFrame:
    """table, kind, column and violations of every declared constraint over stored tables.

    ``unique`` counts the rows beyond the first of a key, ``foreign_key`` the rows whose key has no
    member. A table is read once: its rows collapse to one count per constraint and value, with
    missing values and the mere presence of a row where the value does not matter.
    """
    declared, out = declared or CONSTRAINTS, None
    for name in dict.fromkeys(c[0] for c in declared):
        mine = [c for c in declared if c[0] == name]
        cells = []
        for i, c in enumerate(mine):
            value = F.col(c[2]).cast("string")
            # a present value of a column that must only be present is of no interest
            cells.append(F.struct(F.lit(i).alias("i"), value.isNull().alias("missing"), (F.lit(None).cast("string") if c[1] == "not_null" else value).alias("value")))
        counts = tables[name].select(F.explode(F.array(*cells)).alias("c")).groupBy("c.i", "c.missing", "c.value").agg(F.count("*").alias("n"))
        counts = materialize(counts, f"constraints-{name}")
        for i, c in enumerate(mine):
            seen = counts.where(F.col("i") == i)
            if c[1] == "not_null":
                bad = seen.agg(F.sum(F.when(F.col("missing"), F.col("n"))).alias("k"))
            elif c[1] == "unique":
                bad = seen.where("NOT missing").agg(F.sum(F.col("n") - 1).alias("k"))
            else:
                known = tables[c[3]].select(F.col(c[4]).cast("string").alias("value")).distinct()
                bad = seen.where("NOT missing").join(known, "value", "left_anti").agg(F.sum("n").alias("k"))
            one = bad.select(F.lit(name).alias("table"), F.lit(c[1]).alias("kind"), F.lit(c[2]).alias("column"), F.coalesce("k", F.lit(0)).cast("bigint").alias("violations"))
            out = one if out is None else out.unionByName(one)
    return out


def numbered(df: DataFrame, id_column: str, *order: str) -> DataFrame:
    """``df`` with ids 1, 2, ... in the order of the given columns: unique for equal rows too.

    Rows are sorted by ranges and written once; each range then starts after the rows of the ranges
    before it. The running sum is over the ranges, never over the rows.
    """
    at = F.col("__at")
    stored = materialize(
        df.repartitionByRange(task_count(df.sparkSession), *order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    held = stored.groupBy(F.shiftright(at, 33).alias("__range")).agg(F.count("*").alias("__n"))
    before = held.select("__range", (F.sum("__n").over(W.orderBy("__range")) - F.col("__n")).alias("__before"))
    # one row per range, so the broadcast is bounded by the number of tasks
    joined = stored.withColumn("__range", F.shiftright(at, 33)).join(F.broadcast(before), "__range")
    return joined.select((F.col("__before") + at.bitwiseAND(F.lit(2**33 - 1)) + 1).alias(id_column), *df.columns)
