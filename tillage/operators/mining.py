"""Association rules: discretised features, frequent itemsets, rules with any consequent."""

from __future__ import annotations

import math
import sys
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators.orderstats import LINEAR, order_statistics
from tillage.operators.profile import YIELD, existing, long_form
from tillage.session import materialize

# the functions of the tasks travel with the job: executors need no installed package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK = 8192  # distinct baskets that are counted together

# Bins (column, edges, labels); every interval is closed on the right.
FIXED_BINS = {
    "temp_category": ("temperature_C", [20, 30], ["Cool", "Moderate_Temp", "Hot"]),
    "rainfall_category": ("rainfall_mm", [100, 300], ["Low_Rain", "Moderate_Rain", "High_Rain"]),
    "moisture_category": ("soil_moisture_pct", [40, 60], ["Dry_Soil", "Moist_Soil", "Wet_Soil"]),
    "ph_category": ("soil_pH", [6.0, 7.5], ["Acidic_Soil", "Neutral_Soil", "Alkaline_Soil"]),
    "ndvi_category": ("NDVI_index", [0.4, 0.7], ["Low_NDVI", "Medium_NDVI", "High_NDVI"]),
}
TERCILE_BINS = {
    "yield_level": (YIELD, ["Low_Yield", "Medium_Yield", "High_Yield"]),
    "water_eff_category": ("water_efficiency", ["Low_Water_Eff", "Medium_Water_Eff", "High_Water_Eff"]),
}
ITEM_COLUMNS = [
    "crop_type", "region", "irrigation_type", "fertilizer_type", "yield_level", "temp_category",
    "rainfall_category", "moisture_category", "ph_category", "ndvi_category", "water_eff_category",
    "sowing_season",
]
MIN_SUPPORT, MIN_CONFIDENCE = 0.03, 0.4


def with_terciles(df: DataFrame, bins: dict | None = None) -> DataFrame:
    """Labels by the exact 0.33 and 0.66 quantiles of each column."""
    bins = {a: b for a, b in (bins or TERCILE_BINS).items() if b[0] in df.columns}
    columns = [c for c, _ in bins.values()]
    cuts = order_statistics(
        long_form(df, columns), ["variable"], "value", {"lo": (0.33, LINEAR), "hi": (0.66, LINEAR)}, scans=True
    )
    one = cuts.agg(
        *[F.max(F.when(F.col("variable") == c, F.col(e))).alias(f"__{e}_{c}") for c in columns for e in ("lo", "hi")]
    )
    joined = df.crossJoin(F.broadcast(one))
    labelled = {
        a: ag.bin_right_closed(c, [F.col(f"__lo_{c}"), F.col(f"__hi_{c}")], labels) for a, (c, labels) in bins.items()
    }
    return joined.withColumns(labelled).select(*df.columns, *labelled)


def discretise(df: DataFrame) -> DataFrame:
    fixed = {
        a: ag.bin_right_closed(c, edges, labels) for a, (c, edges, labels) in FIXED_BINS.items() if c in df.columns
    }
    return with_terciles(df).withColumns(fixed)


def transactions(df: DataFrame) -> DataFrame:
    return df.select(ag.transaction_items(existing(df, ITEM_COLUMNS)).alias("items"))


def _packed_baskets(baskets: DataFrame, names: list[str]) -> DataFrame:
    """Distinct baskets with their weights, BLOCK to a row: bits (one per frequent item) and weights."""
    place, width = {x: i for i, x in enumerate(names)}, -(-len(names) // 8)

    def encode(batches):
        for b in batches:
            items = b.column("items")
            bits = np.zeros((b.num_rows, width * 8), bool)
            flat = items.flatten().dictionary_encode()
            at = np.array([place.get(x, -1) for x in flat.dictionary.to_pylist()], np.int64)
            row = np.repeat(np.arange(b.num_rows), np.diff(items.offsets.to_numpy()))
            held = at[flat.indices.to_numpy()] if len(row) else np.zeros(0, np.int64)
            bits[row[held >= 0], held[held >= 0]] = True
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in np.packbits(bits, axis=1)], pa.binary())], names=["bits"])

    def block(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK):
                part = b.slice(at, BLOCK)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b"".join(part.column("bits").to_pylist())], pa.binary()), pa.array([part.column("w").to_numpy().astype(np.int64).tobytes()], pa.binary())], names=["bits", "w"])

    known = baskets.select(F.array_compact("items").alias("items")).where(F.size("items") > 0)
    weighted = known.mapInArrow(encode, "bits binary").groupBy("bits").agg(F.count("*").alias("w"))
    return materialize(weighted.mapInArrow(block, "bits binary, w binary"), "baskets", spread=True)


def frequent_itemsets(baskets: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """Itemsets with their frequency and support; the items of a set are sorted.

    Equal baskets collapse to one with a weight. Sets grow by one item a level: the frequent sets of
    a level meet the blocks of weighted baskets, which count each set together with every later
    item; the counts are added up by set and item, and what stays frequent is the next level. Only
    the frequent items are brought to the driver, at most the mean basket size over the support;
    the sets stay tables. Missing items do not count, repeated ones once.
    """
    spark = baskets.sparkSession
    schema = "items array<string>, freq bigint, support double"
    items = baskets.select(F.explode(F.array_distinct(F.array_compact("items"))).alias("item"))
    total = baskets.count()
    if not total:
        return spark.createDataFrame([], schema)
    need = math.ceil(min_support * total)
    singles = sorted((r["item"], r["n"]) for r in items.groupBy("item").agg(F.count("*").alias("n")).where(F.col("n") >= need).collect())
    names, width = [x for x, _ in singles], -(-len(singles) // 8)
    if not names:
        return spark.createDataFrame([], schema)
    blocks = _packed_baskets(baskets, names)

    def count(batches):
        for b in batches:
            for r in b.to_pylist():
                bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8).reshape(-1, width), axis=1)[:, : len(names)].T.astype(bool)
                w = np.frombuffer(r["w"], np.int64)
                weighted = (bits * w.astype(float)).T  # sums of whole numbers, exact below 2**53
                for at in range(0, len(r["sets"]), 256):
                    some = r["sets"][at : at + 256]
                    inside = np.stack([bits[s].all(0) for s in some]).astype(float)
                    n = inside @ weighted
                    n[np.arange(len(names)) <= np.array([s[-1] for s in some])[:, None]] = 0
                    which, item = np.nonzero(n)
                    made = [some[i] + [j] for i, j in zip(which.tolist(), item.tolist())]
                    yield pa.RecordBatch.from_arrays([pa.array(made, pa.list_(pa.int32())), pa.array(n[which, item].astype(np.int64))], names=["ids", "n"])

    level = spark.createDataFrame([([i], n) for i, (_, n) in enumerate(singles)], "ids array<int>, n bigint")
    found = [level]
    for _ in range(len(names)):
        # one row: the frequent sets of a level, a part of the result
        sets = found[-1].agg(F.collect_list("ids").alias("sets"))
        sums = blocks.crossJoin(F.broadcast(sets)).mapInArrow(count, "ids array<int>, n bigint").groupBy("ids").agg(F.sum("n").alias("n"))
        level = materialize(sums.where(F.col("n") >= need), "itemsets")
        if level.isEmpty():
            break
        found.append(level)
    words = F.array(*[F.lit(x) for x in names])
    every = reduce(DataFrame.unionAll, found)
    return materialize(
        every.select(F.transform("ids", lambda i: F.get(words, i)).alias("items"), F.col("n").alias("freq"), (F.col("n") / F.lit(total)).alias("support")), "itemsets")


def association_rules(itemsets: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """All rules antecedent => consequent over every split of every frequent itemset.

    The table of frequent itemsets is a result, not data: its size depends on the support
    threshold, and each set of s items gives 2^s - 2 splits.
    """
    chosen = lambda i: F.getbit(F.col("mask"), i)
    last = (F.pow(F.lit(2), F.size("items")) - 2).cast("int")
    splits = (
        itemsets.where(F.size("items") > 1)
        .withColumn("mask", F.explode(F.sequence(F.lit(1), last)))
        .select(
            F.filter("items", lambda x, i: chosen(i) == 1).alias("antecedents"),
            F.filter("items", lambda x, i: chosen(i) == 0).alias("consequents"),
            "support",
        )
    )
    left = itemsets.select(F.col("items").alias("antecedents"), F.col("support").alias("support_a"))
    right = itemsets.select(F.col("items").alias("consequents"), F.col("support").alias("support_c"))
    joined = splits.join(left, "antecedents").join(right, "consequents")
    confidence = F.col("support") / F.col("support_a")
    metrics = joined.select(
        "antecedents",
        "consequents",
        "support",
        confidence.alias("confidence"),
        (confidence / F.col("support_c")).alias("lift"),
        (F.col("support") - F.col("support_a") * F.col("support_c")).alias("leverage"),
        F.when(confidence >= 1, F.lit(float("inf")))
        .otherwise(F.try_divide(1 - F.col("support_c"), 1 - confidence))
        .alias("conviction"),
    )
    return metrics.where(F.col("confidence") >= min_confidence)


def by_lift(rules: DataFrame):
    """Highest lift first; confidence, then the item texts decide equal lifts."""
    return [
        F.desc(F.round("lift", 9)),
        F.desc(F.round("confidence", 9)),
        F.array_join("antecedents", ", "),
        F.array_join("consequents", ", "),
    ]


def top_rules(rules: DataFrame, n: int) -> DataFrame:
    return rules.orderBy(*by_lift(rules)).limit(n)


def high_yield(rules: DataFrame) -> DataFrame:
    return rules.where(F.exists("consequents", lambda x: x.contains("High_Yield")))


def as_text(rules: DataFrame) -> DataFrame:
    return rules.withColumns({c: F.array_join(c, ", ") for c in ("antecedents", "consequents")})


def insights(rules: DataFrame, n: int = 10) -> DataFrame:
    """One sentence per top rule, or a default line when there is no rule."""
    sentence = F.format_string(
        "When: %s → High Yield (Confidence: %.1f%%, Lift: %.2f)",
        ag.item_text("antecedents"),
        F.col("confidence") * 100,
        F.col("lift"),
    )
    found = top_rules(high_yield(rules), n).select(sentence.alias("insight"))
    none = rules.sparkSession.createDataFrame(
        [("No significant patterns found for high yield prediction.",)], "insight string"
    )
    counted = found.agg(F.count("*").alias("c"))
    default = none.crossJoin(F.broadcast(counted)).where(F.col("c") == 0).select("insight")
    return found.unionByName(default)
