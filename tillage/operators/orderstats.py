"""Exact order statistics (medians, quartiles, terciles, upper picks) at any group size.

The built-in exact percentile keeps every distinct value of a group in one aggregation
buffer. Here no task ever holds a group:

1. rows collapse to (group, bucket, value, count), combined before the shuffle, so equal
   values cost nothing and a hot group spreads over all tasks by value;
2. ``bucket`` is a monotone function of the value: a step of about 0.3 % of its size, and
   within that a thousandth of the range of all values, so that neither a long tail nor a
   narrow band of values fills one bucket. The number of buckets is bounded, whatever the
   rows; running counts over them tell exactly which bucket holds each wanted rank;
3. only the values of those buckets are ranked, one bucket per window partition.

A bad bucketing could only make step 3 slower, never wrong.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

LINEAR = "linear"  # interpolated between the two neighbours of (n - 1) * p
UPPER = "upper"  # the value at position floor(n * p), no interpolation
RANK = "rank"  # the ceil(n * p)-th smallest value

_BUCKETS_PER_OCTAVE = 256
_STEPS = 1024


def _bucket(value):
    magnitude = F.floor(F.log2(F.abs(value) + F.lit(1.0)) * _BUCKETS_PER_OCTAVE)
    return F.when(value < 0, -magnitude).otherwise(magnitude)


def _position(n, p: float, mode: str):
    if mode == LINEAR:
        return (n - 1) * F.lit(float(p))
    if mode == UPPER:
        return F.least(F.floor(n * F.lit(float(p))), n - 1).cast("double")
    return F.greatest(F.ceil(n * F.lit(float(p))) - 1, F.lit(0)).cast("double")


def order_statistics(
    df: DataFrame,
    keys: list[str],
    value: str,
    wanted: dict[str, tuple[float, str]],
    count_as: str | None = None,
    weight: str | None = None,
    scans: bool = False,
) -> DataFrame:
    """One row per group: its keys and one column per wanted order statistic.

    ``wanted`` maps an output column to (p, mode). Missing values are left out; a group
    with no value has no row. With ``weight``, a row stands for as many equal ones.

    With ``scans``, for few groups in rows that are cheap to read again: the rows are read three times
    (range, counts by bucket, values of the wanted buckets), and only counts and those values are shuffled.
    """
    k = [f"__k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(c).alias(a) for c, a in zip(keys, k)], F.col(value).cast("double").alias("__v"), (F.col(weight) if weight else F.lit(1)).cast("long").alias("__w"))
    # the join below would infer the last of these filters on one of its two uses of ``values``
    # only, and the shuffle of the counts would then not be shared between them
    rows = rows.where(F.col("__v").isNotNull() & ~F.isnan("__v") & _bucket(F.col("__v")).isNotNull())
    values = rows.withColumnRenamed("__w", "__c") if scans else rows.groupBy(*k, "__v").agg(F.sum("__w").alias("__c"))
    ends = values.agg(F.min("__v").alias("__min"), F.max("__v").alias("__max"))
    step = F.try_divide(F.col("__v") - F.col("__min"), F.col("__max") - F.col("__min")) * _STEPS
    values = (
        values.crossJoin(F.broadcast(ends))
        .withColumns({"__b": _bucket(F.col("__v")), "__s": F.coalesce(F.floor(step), F.lit(0))})
        .drop("__min", "__max")
    )

    buckets = values.groupBy(*k, "__b", "__s").agg(F.sum("__c").alias("__bc"))
    group = W.partitionBy(*k) if k else W.partitionBy(F.lit(0))
    running = group.orderBy("__b", "__s").rowsBetween(W.unboundedPreceding, W.currentRow)
    buckets = buckets.withColumns(
        {
            "__n": F.sum("__bc").over(group),
            "__before": F.sum("__bc").over(running) - F.col("__bc"),
        }
    )
    n, before = F.col("__n"), F.col("__before")
    hit = F.lit(False)
    for p, mode in wanted.values():
        pos = _position(n, p, mode)
        for edge in (F.floor(pos), F.ceil(pos)):
            hit = hit | ((edge >= before) & (edge < before + F.col("__bc")))
    targets = buckets.where(hit).select(
        *[F.col(c).alias(f"{c}t") for c in k], F.col("__b").alias("__bt"), F.col("__s").alias("__st"), "__n", "__before"
    )

    on = (F.col("__b") == F.col("__bt")) & (F.col("__s") == F.col("__st"))
    for c in k:
        on = on & F.col(c).eqNullSafe(F.col(f"{c}t"))
    inside = W.partitionBy(*k, "__b", "__s").orderBy("__v").rowsBetween(W.unboundedPreceding, W.currentRow)
    if scans:  # at most two buckets per group and wanted statistic
        near = values.join(F.broadcast(targets), on)
        found = near.groupBy(*[c for c in near.columns if c != "__c"]).agg(F.sum("__c").alias("__c"))
    else:
        found = values.join(targets, on)
    ranked = found.withColumn("__end", F.col("__before") + F.sum("__c").over(inside))
    start, end = F.col("__end") - F.col("__c"), F.col("__end")

    picks = [F.max("__n").alias("__n")]
    for name, (p, mode) in wanted.items():
        pos = _position(F.col("__n"), p, mode)
        for side, edge in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            at = (edge >= start) & (edge < end)
            picks.append(F.max(F.when(at, F.col("__v"))).alias(f"__{side}_{name}"))
    picked = ranked.groupBy(*k).agg(*picks)

    out = [F.col(a).alias(c) for c, a in zip(keys, k)]
    if count_as:
        out.append(F.col("__n").alias(count_as))
    for name, (p, mode) in wanted.items():
        pos = _position(F.col("__n"), p, mode)
        lo, hi = F.col(f"__lo_{name}"), F.col(f"__hi_{name}")
        out.append((lo + (hi - lo) * (pos - F.floor(pos))).alias(name))
    if not keys:
        picked = picked.where(F.col("__n").isNotNull())
    return picked.select(*out)


QUARTILES = {"q1": (0.25, LINEAR), "median": (0.5, LINEAR), "q3": (0.75, LINEAR)}


def join_on_keys(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Join two aggregates on their group keys, where a missing key is a group too."""
    if not keys:
        # both sides are single rows
        return left.crossJoin(F.broadcast(right))
    renamed = right.select(
        *[F.col(c).alias(f"__r_{c}") for c in keys], *[c for c in right.columns if c not in keys]
    )
    on = F.lit(True)
    for c in keys:
        on = on & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return left.join(renamed, on, how).drop(*[f"__r_{c}" for c in keys])


def value_counts(df: DataFrame, keys: list[str], value: str, count_as: str = "n") -> DataFrame:
    return df.groupBy(*keys, value).agg(F.count("*").alias(count_as))


def mode_of(df: DataFrame, keys: list[str], value: str, name: str = "top_value", count_as: str = "top_count"):
    """Most frequent value per group, the smallest one on a tie.

    Counting by value first keeps the buffer at one candidate per group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("__n"))
    top = F.min(F.struct((-F.col("__n")).alias("neg"), F.col(value).alias("v"))).alias("__top")
    return counts.groupBy(*keys).agg(top).select(
        *keys, F.col("__top.v").alias(name), (-F.col("__top.neg")).alias(count_as)
    )
