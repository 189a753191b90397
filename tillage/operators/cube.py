"""OLAP queries over a fact table with its dimension attributes.

A member set holds the All member next to the labels, missing keys land on Unknown, and
sets that are not restricted to non-empty cells keep members without facts. Rows collapse
to one per attribute combination first; the grouping sets then expand that small table,
not the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.operators.profile import YIELD

ALL, UNKNOWN = "All", "Unknown"

# The seven measures; all are sums but the row count.
MEASURES = {
    "total_yield": YIELD,
    "yield_per_day": "yield_per_day",
    "water_efficiency": "water_efficiency",
    "soil_moisture": "soil_moisture_pct",
    "soil_ph": "soil_pH",
    "growing_score": "growing_conditions_score",
    "production_count": None,
}


def _label(attribute: str) -> Column:
    return F.coalesce(F.col(attribute).cast("string"), F.lit(UNKNOWN)).alias(attribute)


def _sums(measures: list[str]) -> list[Column]:
    return [
        F.count("*").alias(m) if MEASURES[m] is None else F.sum(MEASURES[m]).alias(m) for m in measures
    ]


def cells(
    fact: DataFrame,
    measures: list[str],
    attributes: list[str],
    slicer: dict | None = None,
    include_all: bool = True,
) -> DataFrame:
    """Non-empty cells of the crossed member sets."""
    for attribute, value in (slicer or {}).items():
        fact = fact.where(F.col(attribute) == F.lit(value))
    if not attributes:
        return fact.agg(*_sums(measures))
    base = fact.groupBy(*[_label(a) for a in attributes]).agg(*_sums(measures))
    if not include_all:
        return base
    cubed = base.cube(*attributes).agg(
        *[F.grouping(a).alias(f"__g_{a}") for a in attributes], *[F.sum(m).alias(f"__s_{m}") for m in measures]
    )
    return cubed.select(
        *[F.when(F.col(f"__g_{a}") == 1, F.lit(ALL)).otherwise(F.col(a)).alias(a) for a in attributes],
        *[F.col(f"__s_{m}").alias(m) for m in measures],
    )


def cube_query(
    fact: DataFrame,
    measures: list[str],
    attributes: list[str],
    slicer: dict | None = None,
    members: DataFrame | None = None,
    top: tuple[str, int] | None = None,
    bottom: tuple[str, int] | None = None,
    include_all: bool = True,
) -> DataFrame:
    """The general query. ``members`` holds the labels of the (single) attribute and keeps
    those without facts; ``top`` and ``bottom`` keep the n best or worst by a measure."""
    out = cells(fact, measures, attributes, slicer, include_all)
    if members is not None:
        attribute = attributes[0]
        labels = members.select(_label(attribute)).distinct()
        if include_all:
            everything = members.sparkSession.createDataFrame([(ALL,)], f"{attribute} string")
            labels = labels.unionByName(everything)
        # a member only the facts know (a missing key) belongs to the set as well
        out = labels.join(out, attribute, "full")
    for spec, order in ((top, F.desc), (bottom, F.asc_nulls_last)):
        if spec:
            out = out.where(F.col(spec[0]).isNotNull()).orderBy(order(spec[0]), *attributes).limit(spec[1])
    return out


def average_over(fact: DataFrame, measure: str, row: str, over: str, name: str, include_all: bool = True) -> DataFrame:
    """Average of a summed measure over the member set of another attribute, per row member."""
    crossed = cells(fact, [measure], [row, over], include_all=include_all)
    return crossed.groupBy(row).agg(F.avg(measure).alias(name))


def ranked(fact: DataFrame, measure: str, attribute: str, include_all: bool = True) -> DataFrame:
    """Members with their rank by a measure, descending; equal values share a rank.

    The window runs over the members of one attribute, not over facts.
    """
    out = cells(fact, [measure], [attribute], include_all=include_all)
    order = W.orderBy(F.desc(measure))
    return out.withColumn("rank", F.rank().over(order).cast("bigint")).orderBy(F.desc(measure), attribute)


def share_of_all(fact: DataFrame, measure: str, attribute: str, include_all: bool = True) -> DataFrame:
    """Percent of the grand total per member; 0 when the total is 0."""
    out = cells(fact, [measure], [attribute], include_all=True)
    total = out.where(F.col(attribute) == ALL).agg(F.sum(measure).alias("__all"))
    share = F.when(F.col("__all") == 0, F.lit(0.0)).otherwise(F.col(measure) / F.col("__all") * 100)
    out = out.crossJoin(F.broadcast(total)).withColumn("share_pct", share).drop("__all")
    return out if include_all else out.where(F.col(attribute) != ALL)


def contrast(fact: DataFrame, measure: str, row: str, attribute: str, left, right, names, include_all: bool = True):
    """A measure at two members of an attribute and their difference, per row member; a
    missing side counts as 0 in the difference."""
    column = F.col(MEASURES[measure])
    sides = [F.sum(F.when(F.col(attribute) == v, column)) for v in (left, right)]
    base = fact.groupBy(_label(row)).agg(*[s.alias(n) for s, n in zip(sides, names)])
    if include_all:
        total = base.agg(*[F.sum(n).alias(n) for n in names[:2]]).withColumn(row, F.lit(ALL))
        base = base.unionByName(total)
    a, b = (F.coalesce(F.col(n), F.lit(0.0)) for n in names[:2])
    return base.withColumn(names[2], F.when(F.col(names[0]).isNotNull() | F.col(names[1]).isNotNull(), a - b))


def best_member(fact: DataFrame, measure: str, row: str, attribute: str) -> DataFrame:
    """The member of an attribute with the highest measure, per row member."""
    crossed = cells(fact, [measure], [row, attribute], include_all=False)
    order = W.partitionBy(row).orderBy(F.desc(measure), attribute)
    best = crossed.withColumn("__k", F.row_number().over(order)).where(F.col("__k") == 1)
    return best.drop("__k")
