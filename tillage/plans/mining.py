"""Association rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillage.operators import mining
from tillage.operators import profile as pr
from tillage.plans.registry import Y, query
from tillage.session import fresh_path, materialize
from tillage.sources import files
from tillage.sources.binding import farm, farm_sql

_INPUTS = [
    "crop_type", "region", "irrigation_type", "fertilizer_type", "sowing_season", Y, "temperature_C",
    "rainfall_mm", "soil_moisture_pct", "soil_pH", "NDVI_index", "water_efficiency",
]


def _cut(c, lo, hi, labels):
    return f"CASE WHEN \"{c}\" <= {lo} THEN '{labels[0]}' WHEN \"{c}\" <= {hi} THEN '{labels[1]}' ELSE '{labels[2]}' END"


_BINNED = ", ".join(
    [f"{_cut(c, *[f'{float(e)}::DOUBLE' for e in edges], labels)} AS {a}" for a, (c, edges, labels) in mining.FIXED_BINS.items()]
    + [f"{_cut(c, f'lo_{a}', f'hi_{a}', labels)} AS {a}" for a, (c, labels) in mining.TERCILE_BINS.items()]
)
_CUTS = ", ".join(
    f'quantile_cont("{c}", 0.33) AS lo_{a}, quantile_cont("{c}", 0.66) AS hi_{a}' for a, (c, _) in mining.TERCILE_BINS.items()
)
BINNED_SQL = f"""binned AS MATERIALIZED (SELECT crop_type, region, irrigation_type, fertilizer_type, sowing_season, {_BINNED}
  FROM farm, (SELECT {_CUTS} FROM farm))"""
_C = mining.ITEM_COLUMNS
_LEVELS = len(_C) + 1  # a basket has one item per column at most


def _levelwise() -> str:
    """Itemsets grown one item at a time, keeping only frequent ones, until a level is empty."""
    items = ", ".join(f"'{c}=' || {c}" for c in _C)
    ctes = [
        f"long_items AS MATERIALIZED (SELECT tid, unnest([{items}]) AS item FROM (SELECT *, row_number() OVER () AS tid FROM binned))",
        f"lim AS (SELECT {mining.MIN_SUPPORT} * count(*) AS k FROM binned)",
        """f1 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY item) AS id, item, [item] AS items, n AS freq FROM
        (SELECT item, count(*) AS n FROM long_items GROUP BY item) WHERE n >= (SELECT k FROM lim))""",
        "o1 AS MATERIALIZED (SELECT tid, id, id AS last FROM long_items JOIN f1 USING (item))",
    ]
    for k in range(2, _LEVELS):
        ctes += [
            f"""p{k} AS MATERIALIZED (SELECT o.tid, o.id AS prev, i.id AS last FROM o{k - 1} o JOIN o1 i ON o.tid = i.tid AND i.id > o.last)""",
            f"""f{k} AS MATERIALIZED (SELECT row_number() OVER () AS id, c.prev, c.last, list_append(a.items, b.item) AS items, n AS freq
            FROM (SELECT prev, last, count(*) AS n FROM p{k} GROUP BY prev, last) c JOIN f{k - 1} a ON a.id = c.prev
            JOIN f1 b ON b.id = c.last WHERE n >= (SELECT k FROM lim))""",
            f"o{k} AS MATERIALIZED (SELECT tid, f.id, p.last FROM p{k} p JOIN f{k} f ON p.prev = f.prev AND p.last = f.last)",
        ]
    return ", ".join(ctes)


_SETS = " UNION ALL ".join(f"SELECT items, freq FROM f{k}" for k in range(1, _LEVELS))
SETS_SQL = f"""{_levelwise()}, supports AS MATERIALIZED (SELECT items, freq, CAST(freq AS DOUBLE) / (SELECT count(*) FROM binned) AS support FROM ({_SETS}))"""
RULES_SQL = f"""rules AS MATERIALIZED (SELECT a.items AS antecedents, c.items AS consequents, z.support, z.support / a.support AS confidence,
  z.support / a.support / c.support AS lift, z.support - a.support * c.support AS leverage,
  CASE WHEN z.support / a.support >= 1 THEN 'inf'::DOUBLE ELSE (1 - c.support) / (1 - z.support / a.support) END AS conviction
  FROM supports z JOIN supports a ON len(a.items) < len(z.items) AND list_has_all(z.items, a.items)
  JOIN supports c ON c.items = list_filter(z.items, lambda x: NOT list_contains(a.items, x))
  WHERE z.support / a.support >= {mining.MIN_CONFIDENCE})"""
_TEXT = "array_to_string(antecedents, ', ') AS antecedents, array_to_string(consequents, ', ') AS consequents"
_METRICS = ", ".join(f"round({m}, 6) AS {m}" for m in ("support", "confidence", "lift", "leverage", "conviction"))
_ORDER = "ORDER BY round(lift, 9) DESC, round(confidence, 9) DESC, array_to_string(antecedents, ', '), array_to_string(consequents, ', ')"
_HIGH = "len(list_filter(consequents, lambda x: contains(x, 'High_Yield'))) > 0"


def rules_sql(body):
    return farm_sql(body, BINNED_SQL, SETS_SQL, RULES_SQL)


def _discretised(spark, d):
    # the quantiles and the labels read the rows in turn; written once, the farm joins run a single time
    return mining.discretise(materialize(farm(spark, d, *_INPUTS), "mining-rows"))


def _itemsets(spark, d):
    # the baskets are read several times; written once, the quantiles behind them run a single time
    baskets = materialize(mining.transactions(_discretised(spark, d)), "baskets", spread=True)
    return mining.frequent_itemsets(baskets)


def _rules(spark, d):
    return mining.association_rules(_itemsets(spark, d))


@query("r01_discretised", farm_sql(
    f"""SELECT {", ".join(c for c in _C if c.endswith(("category", "level")))}, count(*) AS n FROM binned GROUP BY ALL""", BINNED_SQL))
def _(spark, d):
    cols = [c for c in _C if c.endswith(("category", "level"))]
    return pr.distribution(_discretised(spark, d).select(*cols), cols)


@query("r02_frequent_itemsets", farm_sql(
    "SELECT array_to_string(items, ', ') AS items, freq, round(support, 6) AS support FROM supports", BINNED_SQL, SETS_SQL))
def _(spark, d):
    return _itemsets(spark, d).select(F.array_join("items", ", ").alias("items"), "freq", F.round("support", 6).alias("support"))


@query("r03_rules", rules_sql(f"SELECT {_TEXT}, round(support, 6) AS support, round(confidence, 6) AS confidence FROM rules"))
def _(spark, d):
    out = mining.as_text(_rules(spark, d)).select("antecedents", "consequents", "support", "confidence")
    return pr.rounded(out, 6)


@query("r04_rule_metrics", rules_sql(f"SELECT {_TEXT}, {_METRICS} FROM rules"))
def _(spark, d):
    return pr.rounded(mining.as_text(_rules(spark, d)), 6)


@query("r05_high_yield_rules", rules_sql(f"SELECT {_TEXT}, {_METRICS} FROM rules WHERE {_HIGH}"))
def _(spark, d):
    return pr.rounded(mining.as_text(mining.high_yield(_rules(spark, d))), 6)


@query("r06_insights", rules_sql(
    f"""SELECT 'When: ' || array_to_string(list_transform(antecedents, lambda x: split_part(x, '=', 2)), ', ') || ' → High Yield (Confidence: '
    || printf('%.1f', confidence * 100) || '%, Lift: ' || printf('%.2f', lift) || ')' AS insight FROM (SELECT * FROM rules WHERE {_HIGH} {_ORDER} LIMIT 10)
    UNION ALL SELECT 'No significant patterns found for high yield prediction.' WHERE NOT EXISTS (SELECT 1 FROM rules WHERE {_HIGH})"""))  # fmt: skip
def _(spark, d):
    return mining.insights(_rules(spark, d))


@query("w12_top15_rules", rules_sql(f"SELECT {_TEXT}, round(lift, 6) AS lift FROM (SELECT * FROM rules {_ORDER} LIMIT 15)"))
def _(spark, d):
    return pr.rounded(mining.as_text(mining.top_rules(_rules(spark, d), 15)).select("antecedents", "consequents", "lift"), 6)


@query("s15_rules_export", rules_sql(f"SELECT {_TEXT}, {_METRICS} FROM rules WHERE {_HIGH}"))
def _(spark, d):
    out = mining.as_text(mining.high_yield(_rules(spark, d)))
    path = files.write_csv(out, fresh_path(spark, "rules"))
    return pr.rounded(spark.read.schema(out.schema).option("header", True).csv(path), 6)
