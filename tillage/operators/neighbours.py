"""Exact nearest neighbours without pairing every row with every row.

Equal feature vectors collapse first, so copies of one farm cost one point. The space is
then cut into cells by a balanced tree that grows with the points; each query looks into its own
cell, which bounds the distance of its k-th neighbour, and then walks the tree, leaving every
branch that is farther away than that. Cells are cut into chunks of bounded size, so that no task holds more than one chunk of points
against one chunk of queries, however many points a cell holds.

Neighbours are ordered by distance and, at equal distance, by class label. Distances are
rounded to nine digits, so that this order does not depend on the sum's last bits.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.session import materialize, task_count

# the helpers below travel to the executors with the job: they need no installed package there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

CHUNK = 20_000  # points or queries of one cell that meet in one task
CELL_ROWS = 500  # points per cell that a small table aims at
MAX_CELLS = 1 << 17  # bound of the tree that every task holds; the cells grow with the points up to there
FEW = 1000  # so many queries travel to the points instead of meeting them by cell
SAMPLE_ROWS = 20  # rows per cell that place the cuts; the cuts steer the speed, not the result
MOST_SAMPLE = 1 << 19  # rows that place the cuts, in all: the driver holds them
DIGITS = 9


# ---- standardisation ------------------------------------------------------------------------------------


def scale_row(df: DataFrame, features: list[str]) -> DataFrame:
    """One row with the mean and population deviation of each feature (0 counts as 1)."""
    cols = []
    for f in features:
        std = F.stddev_pop(f)
        cols += [F.avg(f).alias(f"__mean_{f}"), F.when(std > 0, std).otherwise(1.0).alias(f"__std_{f}")]
    return df.agg(*cols)


def standardised(df: DataFrame, scale: DataFrame, features: list[str]) -> DataFrame:
    joined = df.crossJoin(F.broadcast(scale))
    return joined.withColumns(
        {f: (F.col(f) - F.col(f"__mean_{f}")) / F.col(f"__std_{f}") for f in features}
    ).select(*df.columns)


# ---- cells ----------------------------------------------------------------------------------------------------


class CellTree:
    """Cells that cover the space: a balanced tree of cuts, each at the median of the widest side of a
    sample. What is at or below a cut goes left; the right child follows the left one."""

    def __init__(self, sample: np.ndarray, cells: int):
        most = max(1, -(-len(sample) // cells))
        self.axis, self.cut, self.left, parts = [-1], [0.0], [0], [sample]
        at = 0
        while at < len(parts):
            inside, parts[at] = parts[at], None
            if len(inside) > most:
                for axis in np.argsort(-np.ptp(inside, axis=0)):
                    values = np.unique(inside[:, axis])
                    if len(values) > 1:
                        middle = np.median(inside[:, axis])
                        # the largest value must stay above the cut
                        middle = middle if middle < values[-1] else values[-2]
                        below = inside[:, axis] <= middle
                        self.axis[at], self.cut[at], self.left[at] = int(axis), float(middle), len(parts)
                        parts += [inside[below], inside[~below]]
                        self.axis += [-1, -1]
                        self.cut += [0.0, 0.0]
                        self.left += [0, 0]
                        break
            at += 1
        self.axis, self.cut, self.left = np.array(self.axis, np.int16), np.array(self.cut), np.array(self.left, np.int32)

    def home(self, x: np.ndarray) -> np.ndarray:
        """The cell of each row, in as many steps as the tree is deep."""
        at, live = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(live):
            live = live[self.axis[at[live]] >= 0]
            here = at[live]
            at[live] = self.left[here] + (x[live, self.axis[here]] > self.cut[here])
        return at

    def within(self, x: np.ndarray, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) for every cell that comes as close to a row as its reach: branches that are
        farther away are left where they begin."""
        rows, cells = [], []
        for begin in range(0, len(x), 500):
            row = np.arange(begin, min(len(x), begin + 500))
            node, gap = np.zeros(len(row), np.int64), np.zeros((len(row), x.shape[1]))
            while len(row):
                leaf = self.axis[node] < 0
                rows.append(row[leaf])
                cells.append(node[leaf])
                row, node, gap = row[~leaf], node[~leaf], gap[~leaf]
                axis, over = self.axis[node].astype(np.int64), x[row, self.axis[node]] - self.cut[node]
                found = []
                for side, away in ((0, over), (1, -over)):
                    g = gap.copy()
                    each = np.arange(len(row))
                    g[each, axis] = np.maximum(g[each, axis], away)
                    near = np.sqrt((g * g).sum(1)) <= reach[row]
                    found.append((row[near], self.left[node][near] + side, g[near]))
                row, node, gap = (np.concatenate(p) for p in zip(*found))
        return np.concatenate(rows), np.concatenate(cells)


# ---- the join ---------------------------------------------------------------------------------------------------


def _closest(queries: pd.DataFrame, points: pd.DataFrame, features: list[str], k: int, folds: bool) -> pd.DataFrame:
    """The nearest points of each query of one chunk: at least k rows' worth, by (distance, label).

    With folds, a query takes no neighbour of its own fold: points carry their fold. A query that knows
    its reach takes no point beyond it.
    """
    q, p = queries[features].to_numpy(float), points[features].to_numpy(float)
    weight = points["__w"].to_numpy(np.int64)
    label = points["label"].to_numpy(object)
    rank_of = pd.Series(label).rank(method="dense").to_numpy()
    fold = points["__fold"].to_numpy(np.int64) if folds else None
    reach = queries["__reach"].to_numpy(float) if "__reach" in queries.columns else np.full(len(q), np.inf)
    tag = points["__tag"].to_numpy(object) if "__tag" in points.columns else None
    out = []
    step = max(1, 4_000_000 // max(len(p), 1))
    for start in range(0, len(q), step):
        block = q[start : start + step]
        dist = np.zeros((len(block), len(p)))
        for axis in range(p.shape[1]):
            gap = block[:, axis][:, None] - p[:, axis]
            dist += gap * gap
        dist = np.sqrt(dist, out=dist)
        if folds:
            own = queries["__fold"].to_numpy(np.int64)[start : start + step]
            dist[own[:, None] == fold] = np.inf
        # every point at the k-th distance stays in, so ties are resolved by label below
        if len(p) > k:
            limit = np.partition(dist, k - 1, axis=1)[:, k - 1] + 10.0**-DIGITS
        else:
            limit = np.full(len(block), np.inf)
        limit = np.minimum(limit, reach[start : start + step] + 10.0**-DIGITS)
        row, col = np.nonzero((dist <= limit[:, None]) & np.isfinite(dist))
        found = pd.DataFrame(
            {
                "__q": queries["__q"].to_numpy()[start : start + step][row],
                "distance": np.round(dist[row, col], DIGITS),
                "label": label[col],
                "__o": rank_of[col],
                "n": weight[col],
            }
        )
        if tag is not None:
            found["__tag"] = tag[col]
            found = found.sort_values(["__q", "distance", "__o", "__tag"], kind="stable")
        else:
            found = found.groupby(["__q", "distance", "label", "__o"], as_index=False, sort=False)["n"].sum()
            found = found.sort_values(["__q", "distance", "__o"], kind="stable")
        before = found.groupby("__q")["n"].cumsum() - found["n"]
        out.append(found[before < k].drop(columns="__o"))
    return pd.concat(out) if out else pd.DataFrame(columns=["__q", "distance", "label", "n"])


def _trim(found: pd.DataFrame, k: int) -> pd.DataFrame:
    """The first k rows' worth of candidates per query."""
    by = [c for c in ("__q", "distance", "label", "__tag") if c in found.columns]
    found = found.groupby(by, as_index=False, sort=True)["n"].sum()
    before = found.groupby("__q")["n"].cumsum() - found["n"]
    return found[before < k]


def _chunked(df: DataFrame, keys: list[str], key_hash, name: str) -> DataFrame:
    """Adds a chunk number per cell such that a chunk holds about CHUNK rows."""
    sizes = df.groupBy(*keys).agg(F.ceil(F.count("*") / CHUNK).cast("int").alias(f"{name}s"))
    out = df.join(sizes, keys)
    return out.withColumn(name, F.pmod(key_hash, F.col(f"{name}s")).cast("int"))


def _steering(places: DataFrame, features: list[str], rows: int, total: int) -> DataFrame:
    """About so many of the places, by a hash of their values: every task picks its own, so the driver gets no more."""
    if rows >= total:
        return places.select(*features)
    whole = 1 << 40
    return places.where(F.pmod(F.xxhash64(*features, F.lit(1)), F.lit(whole)) < int(rows / total * whole)).select(*features)


def nearest(
    queries: DataFrame,
    points: DataFrame,
    features: list[str],
    k: int,
    key: str,
    label: str,
    fold: str | None = None,
    tag: str | None = None,
) -> DataFrame:
    """Neighbours of each query: key, rank, distance, label, n (points at that place), taken.

    ``taken`` is how many of the n equal points belong to the k nearest. With ``fold``, points
    of the query's own fold are not its neighbours. With ``tag``, points keep an identity and
    come out one by one; otherwise equal points are counted together.
    """
    tasks = task_count(queries.sparkSession)
    folds = fold is not None
    fold_of = F.col(fold).cast("bigint") if folds else F.lit(-1).cast("bigint")
    vectors = [F.col(f).cast("double").alias(f) for f in features]

    # ---- collapse equal vectors; the written tables are read several times below
    q = queries.select(F.col(key).alias("__key"), *vectors, fold_of.alias("__fold"))
    # 128 bits: no two vectors of any real table share it; the number in the written table travels in its place
    q = q.withColumn("__md5", F.md5(F.concat_ws("|", *[F.col(f).cast("string") for f in [*features, "__fold"]])))
    distinct = q.groupBy("__md5").agg(*[F.first(f).alias(f) for f in [*features, "__fold"]])
    numbered = materialize(distinct.withColumn("__q", F.monotonically_increasing_id()), "sites")
    sites = numbered.drop("__md5")
    p = points.select(
        *vectors, F.col(label).cast("string").alias("label"), fold_of.alias("__fold"),
        *([F.col(tag).cast("string").alias("__tag")] if tag else []),
    )
    extra = ["__tag"] if tag else []

    order = [F.col("distance"), F.col("label"), *([F.col("__tag")] if tag else [])]
    running = W.partitionBy("__q").orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)

    def best(found: DataFrame) -> DataFrame:
        """The k nearest of the candidates: a window over at most k rows per chunk searched."""
        merged = found.groupBy("__q", "distance", "label", *extra).agg(F.sum("n").alias("n"))
        merged = merged.withColumn("__end", F.sum("n").over(running))
        return merged.where(F.col("__end") - F.col("n") < k)

    def ranked(merged: DataFrame) -> DataFrame:
        taken = F.least(F.col("n"), F.lit(k) - (F.col("__end") - F.col("n")))
        rank = F.row_number().over(W.partitionBy("__q").orderBy(*order))
        found = merged.select("__q", rank.alias("rank"), "distance", "label", *extra, "n", taken.cast("bigint").alias("taken"))
        names_out = [F.col("__key").alias(key), "rank", "distance", "label", "n", "taken"]
        if tag:
            names_out.append(F.col("__tag").alias(tag))
        # one answer per key: rows that share a key share their vector
        keys = q.select("__key", "__md5").distinct().join(numbered.select("__md5", "__q"), "__md5")
        return keys.join(found, "__q").select(*names_out)

    schema = "__q bigint, distance double, label string, n bigint" + (", __tag string" if tag else "")
    names = [c.split()[0] for c in schema.split(", ")]

    few = sites.limit(FEW + 1).toPandas()
    if len(few) <= FEW:
        few_sites = few

        def scan(batches):
            """The nearest points of one partition for every query: at most k per query."""
            kept = None
            for b in batches:
                near = _closest(few_sites, b, features, k, folds)[names]
                if kept is not None:
                    near = _trim(pd.concat([kept, near]), k)
                kept = near
            if kept is not None:
                yield kept

        return ranked(best(p.withColumn("__w", F.lit(1).cast("bigint")).mapInPandas(scan, schema)))

    # ---- equal points of the other path collapse, too
    places = materialize(p.groupBy(*features, "label", "__fold", *extra).agg(F.count("*").alias("__w")), "places")

    # ---- cells from a bounded sample
    total = places.count()
    cells = max(1, min(MAX_CELLS, total // CELL_ROWS))
    held = _steering(places, features, min(SAMPLE_ROWS * cells, MOST_SAMPLE), total).toArrow()
    some = np.column_stack([held[f].to_numpy().astype(float) for f in features])
    del held
    if len(some) == 0:
        return queries.limit(0).select(F.col(key)).withColumns(
            {"rank": F.lit(0), "distance": F.lit(0.0), "label": F.lit(""), "n": F.lit(0), "taken": F.lit(0)}
        )
    tree = queries.sparkSession.sparkContext.broadcast(CellTree(some, cells))  # 15 bytes per node

    def home(batches):
        for b in batches:
            yield b.assign(__cell=tree.value.home(b[features].to_numpy(float)).astype("int32"))

    def with_cell(df):
        return df.mapInPandas(home, ", ".join(f"`{n}` {t}" for n, t in df.dtypes) + ", __cell int")

    located = materialize(
        _chunked(with_cell(places), ["__cell"], F.xxhash64(*features, "label", "__fold", *extra), "__pc"), "located"
    )
    chunks = materialize(
        located.groupBy("__cell").agg(F.max("__pcs").alias("__pcs")), "chunks"
    )

    def meet(_key, left, right):
        if len(left) == 0 or len(right) == 0:
            return pd.DataFrame(columns=names)
        return _closest(left, right, features, k, folds)[names]

    def search(asked: DataFrame) -> DataFrame:
        """Queries with a target cell, against every chunk of the points of that cell."""
        spread = _chunked(asked.join(chunks, "__cell"), ["__cell"], F.xxhash64("__q"), "__qc")
        spread = spread.withColumn("__pc", F.explode(F.sequence(F.lit(0), F.col("__pcs") - 1)))
        # a chunk of points is needed once per chunk of queries of its cell
        wanted = spread.select("__cell", "__pc", "__qc").distinct()
        sides = located.select(*features, "label", "__fold", *extra, "__w", "__cell", "__pc").join(wanted, ["__cell", "__pc"])
        # names of its own: both sides descend from the same queries
        sides = sides.withColumnsRenamed({c: f"{c}_p" for c in ("__cell", "__pc", "__qc")})
        left = spread.select("__q", *features, "__fold", *[c for c in ("__reach",) if c in asked.columns], "__cell", "__pc", "__qc")
        by = ["__cell", "__pc", "__qc"]
        # a fixed number of tasks: the groups are small in bytes and heavy in arithmetic, and
        # would otherwise be merged into a few tasks
        theirs = [f"{c}_p" for c in by]
        left, sides = left.repartition(tasks, *by), sides.repartition(tasks, *theirs)
        return left.groupBy(*by).cogroup(sides.groupBy(*theirs)).applyInPandas(meet, schema)

    near = materialize(best(search(with_cell(sites))), "near")
    reach = near.groupBy("__q").agg(
        F.when(F.max("__end") >= k, F.max("distance")).otherwise(F.lit(float("inf"))).alias("__reach")
    )
    bounded = sites.join(reach, "__q", "left").fillna(float("inf"), ["__reach"])

    def neighbours_cells(batches):
        for b in batches:
            x = b[features].to_numpy(float)
            own = tree.value.home(x)
            row, col = tree.value.within(x, b["__reach"].to_numpy() + 10.0**-DIGITS)
            other = col != own[row]
            row, col = row[other], col[other]
            yield b.iloc[row].assign(__cell=col.astype("int32"))

    # the k-th distance goes along: a further cell answers with what comes closer, in most cases nothing
    fields = ", ".join(f"`{n}` {t}" for n, t in bounded.dtypes) + ", __cell int"
    further = search(bounded.mapInPandas(neighbours_cells, fields))
    return ranked(best(near.select(*names).unionByName(further)))
