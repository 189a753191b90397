"""K-Means over standardised features, with profiles and labels of the clusters."""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.operators import cleaning, engine_draws, neighbours
from tillage.operators.profile import YIELD, cross_share, existing

# Clustering and profile features.
FEATURES = [
    YIELD, "soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct", "sunlight_hours",
    "NDVI_index", "water_efficiency", "growing_conditions_score",
]
PROFILE = [YIELD, "water_efficiency", "growing_conditions_score", "temperature_C", "rainfall_mm", "soil_pH"]
SEED = 42
STEPS, TOLERANCE = 20, 1e-4  # the engine's own limits of K-Means
BLOCK = 64  # vectors in a row of the cells
STEP_ROWS = 4096  # vectors that are measured together: what is made of them stays in the processor's cache

# the helpers below travel to the executors with the job: they need no installed package there
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def prepared(df: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Features filled by their median; the standardised vector comes next to them."""
    features = existing(df, features or FEATURES)
    filled = cleaning.median_fill(df, cleaning.with_missing(df, features))
    scale = neighbours.scale_row(filled, features)
    joined = filled.crossJoin(F.broadcast(scale))
    z = {f"__z_{f}": (F.col(f) - F.col(f"__mean_{f}")) / F.col(f"__std_{f}") for f in features}
    ready = joined.withColumns(z)
    assembled = VectorAssembler(inputCols=list(z), outputCol="features").transform(ready)
    return assembled.select(*df.columns, "features")


def _cells(ready: DataFrame) -> DataFrame:
    """The vectors, BLOCK of them as the bytes of one row: a pass over them moves bytes and nothing else."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                x = b.column("v").flatten().to_numpy(zero_copy_only=False)
                size = len(x) // b.num_rows
                parts = [x[at : at + BLOCK * size].tobytes() for at in range(0, len(x), BLOCK * size)]
                yield pa.RecordBatch.from_arrays([pa.array([size] * len(parts), pa.int32()), pa.array(parts, pa.binary())], names=["width", "block"])

    return ready.select(vector_to_array("features").alias("v")).mapInArrow(run, "width int, block binary")


def _nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The nearest centre of each row, the first on a tie."""
    away = (-2 * c) @ x.T
    away += (c * c).sum(1)[:, None]
    best, own = away[0].copy(), np.zeros(len(x), np.int64)
    for j in range(1, len(c)):
        own[away[j] < best] = j
        np.minimum(best, away[j], out=best)
    return own


def _steps(batches):
    """The vectors of a task in their order, STEP_ROWS at a time or fewer."""
    for b in batches:
        if b.num_rows:
            at, data = b.column("block").buffers()[1:]
            at = np.frombuffer(at, np.int32)[b.column("block").offset :][: b.num_rows + 1]
            x = np.frombuffer(data, np.float64, (at[-1] - at[0]) // 8, at[0]).reshape(-1, b.column("width")[0].as_py())
            for begin in range(0, len(x), STEP_ROWS):
                yield x[begin : begin + STEP_ROWS]


def _added(cells: DataFrame, measure, shapes: dict[int, int]) -> dict[int, np.ndarray]:
    """What ``measure(x)`` finds in the rows of a task for each k, added up over the tasks: a few numbers
    per k and task travel."""

    def run(batches):
        held = {k: np.zeros(n) for k, n in shapes.items()}
        for x in _steps(batches):
            for k, found in measure(x).items():
                held[k] += found
        yield pa.RecordBatch.from_arrays([pa.array(list(held)), pa.array([v.tobytes() for v in held.values()], pa.binary())], names=["k", "sums"])

    total = {k: np.zeros(n) for k, n in shapes.items()}
    for r in cells.mapInArrow(run, "k bigint, sums binary").collect():
        total[r["k"]] += np.frombuffer(r["sums"])
    return total


def _told(cells: DataFrame, ask) -> list[list[np.ndarray]]:
    """What ``ask(partition, steps)`` says of each task's vectors, in the order of the tasks: a few arrays of numbers."""

    def run(batches):
        found = [np.ascontiguousarray(v, float) for v in ask(TaskContext.get().partitionId(), _steps(batches))]
        parts = pa.array([[v.tobytes() for v in found]], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), parts], names=["part", "found"])

    rows = sorted(cells.mapInArrow(run, "part bigint, found array<binary>").collect(), key=lambda r: r["part"])
    return [[np.frombuffer(v) for v in r["found"]] for r in rows]


def _costs(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances, centres by vectors."""
    away = (-2 * c) @ x.T
    away += (c * c).sum(1)[:, None]
    away += (x * x).sum(1)
    return np.maximum(away, 0.0, out=away)


def _first(cells: DataFrame, seed: int) -> np.ndarray:
    """The vector that the engine's ``takeSample(1)`` takes."""
    counts = [int(f[0][0]) for f in _told(cells, lambda _, steps: [[sum(len(x) for x in steps)]])]
    total, rand = sum(counts), SparkSession.active()._jvm.java.util.Random(seed)
    if not total:
        raise ValueError("no rows to draw centres from")
    gamma = -np.log(1e-4) / total
    share = min(1.0, max(1e-10, 1 / total + gamma + np.sqrt(gamma * gamma + 2 * gamma / total)))
    found: list[np.ndarray] = []
    while not found:
        seeds = SparkSession.active()._jvm.java.util.Random(rand.nextInt()) if total > 1 else None
        seeds = [seeds.nextLong() for _ in counts] if seeds else None

        def ask(part, steps, seeds=seeds):
            places = engine_draws.sampled_places(counts[part], share, seeds[part]) if seeds else np.arange(counts[part])
            begin, out = 0, []
            for x in steps:
                out += list(x[places[(places >= begin) & (places < begin + len(x))] - begin])
                begin += len(x)
            return out

        found = [v for f in _told(cells, ask) for v in f]
    for i in range(len(found) - 1, 0, -1):
        j = rand.nextInt(i + 1)
        found[i], found[j] = found[j], found[i]
    return found[0]


def _drawn(cells: DataFrame, ks: list[int]) -> dict[int, np.ndarray]:
    """The first centres of the engine (k-means|| with two steps) for each k, the passes shared by all k: the random
    numbers do not depend on k, so every row is drawn once for all of them."""
    seed = engine_draws.first_int(SEED)
    jump = engine_draws.jump()
    centres = {k: _first(cells, seed)[None] for k in ks[:1]}
    centres = dict.fromkeys(ks, centres[ks[0]])
    for step in range(2):
        here = dict(centres)

        def costs(x, here=here):
            every = np.unique(np.concatenate(list(here.values())), axis=0)
            away = _costs(x, every)
            of = {tuple(c): i for i, c in enumerate(every.tolist())}
            return np.stack([away[[of[tuple(c)] for c in here[k].tolist()]].min(0) for k in ks])

        sums = sum(f[0] for f in _told(cells, lambda _, steps: [sum((costs(x).sum(1) for x in steps), np.zeros(len(ks)))]))

        def ask(part, steps, step=step, sums=sums, costs=costs):
            numbers, out = engine_draws.Uniform(seed ^ (step << 16) ^ part, jump), []
            with np.errstate(divide="ignore", invalid="ignore"):
                for x in steps:
                    taken = numbers.next(len(x)) < 2.0 * costs(x) * np.array(ks)[:, None] / sums[:, None]
                    some = np.flatnonzero(taken.any(0))
                    out.append(np.column_stack([taken[:, some].T, x[some]]))
            return [np.concatenate(out).ravel()] if out else []

        found = [np.concatenate([f[0].reshape(-1, len(ks) + centres[ks[0]].shape[1]) for f in _told(cells, ask) if f])]
        centres = {k: np.concatenate([centres[k], found[0][found[0][:, i] > 0, len(ks) :]]) for i, k in enumerate(ks)}
    centres = {k: np.array(list(dict.fromkeys(map(tuple, c.tolist())))) for k, c in centres.items()}
    many = {k: c for k, c in centres.items() if len(c) > k}
    if many:
        weights = _told(cells, lambda _, steps: _weights(steps, many))
        weights = [sum(w) for w in zip(*weights)]
        centres |= {k: _local(many[k], w, k) for k, w in zip(many, weights)}
    return centres


def _weights(steps, many: dict[int, np.ndarray]) -> list[np.ndarray]:
    """For each k how many vectors are nearest to each of its centres."""
    held = {k: np.zeros(len(c)) for k, c in many.items()}
    for x in steps:
        for k, c in many.items():
            held[k] += np.bincount(_nearest(x, c), minlength=len(c))
    return list(held.values())


def _local(c: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """The engine's own choice of k among weighted centres: a few dozen vectors."""
    sc = SparkSession.active().sparkContext
    local = sc._jvm.org.apache.spark.mllib.clustering

    def doubles(values):
        out = sc._gateway.new_array(sc._jvm.double, len(values))
        for i, v in enumerate(values):
            out[i] = float(v)
        return out

    points = sc._gateway.new_array(local.VectorWithNorm, len(c))
    for i, row in enumerate(c):
        points[i] = local.VectorWithNorm(doubles(row))
    found = local.LocalKMeans.kMeansPlusPlus(0, points, doubles(weights), k, 30)
    return np.array([list(v.vector().toArray()) for v in found])


def _by_cluster(own: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Per cluster the number of its rows, then their values added up."""
    member = (own == np.arange(size)[:, None]).astype(float)
    return np.column_stack([member.sum(1), member @ values])


def fitted(ready: DataFrame, low: int = 2, high: int = 8, cells: DataFrame | None = None) -> dict[int, np.ndarray]:
    """The centres for each k. The first ones are those that the engine draws (k-means||); the steps that follow are
    those of its K-Means, and one pass over the rows makes a step for every k that still moves."""
    if cells is None:
        cells = _cells(ready).persist()
        try:
            return fitted(ready, low, high, cells)
        finally:
            cells.unpersist()
    centres = _drawn(cells, list(range(low, high + 1)))
    moving = dict(centres)
    for _ in range(STEPS):
        if not moving:
            break

        def measure(x, moving=moving):
            return {k: _by_cluster(_nearest(x, c), x, len(c)).ravel() for k, c in moving.items()}

        sums = _added(cells, measure, {k: len(c) * (c.shape[1] + 1) for k, c in moving.items()})
        before, moving = moving, {}
        for k, c in before.items():
            n, s = np.split(sums[k].reshape(len(c), -1), [1], 1)
            centres[k] = np.where(n > 0, s / np.maximum(n, 1), c)  # a centre without rows stays
            if (((centres[k] - c) ** 2).sum(1) > TOLERANCE**2).any():
                moving[k] = centres[k]
    return centres


def compared(ready: DataFrame, low: int = 2, high: int = 8) -> tuple[dict[int, np.ndarray], list[tuple[int, float, float]]]:
    """The clusterings of every k and what ``k_selection`` says of them, from cells that are made once."""
    cells = _cells(ready).persist()
    try:
        models = fitted(ready, low, high, cells)
        return models, k_selection(ready, low, high, models, cells)
    finally:
        cells.unpersist()


def k_selection(
    ready: DataFrame, low: int = 2, high: int = 8, models: dict[int, np.ndarray] | None = None, cells: DataFrame | None = None
) -> list[tuple[int, float, float]]:
    """(k, inertia, silhouette) for each k, of the clusterings ``models`` if given. The silhouette is that of
    squared distances, from the sums of each cluster."""
    own_cells = cells is None
    cells = _cells(ready).persist() if own_cells else cells
    try:
        models = models or fitted(ready, low, high, cells)

        def spread(x):
            out = {}
            for k, c in models.items():
                own, square = _nearest(x, c), (x * x).sum(1)
                away = ((x - c[own]) ** 2).sum(1)
                out[k] = _by_cluster(own, np.column_stack([x, square, away]), len(c)).ravel()
            return out

        sums = _added(cells, spread, {k: len(c) * (c.shape[1] + 3) for k, c in models.items()})
        tables = {k: sums[k].reshape(len(c), -1) for k, c in models.items()}
        if any((t[:, 0] > 0).sum() < 2 for t in tables.values()):
            raise ValueError("a silhouette needs two clusters with rows")

        def silhouettes(x):
            out, square = {}, (x * x).sum(1)
            for k, t in tables.items():
                own, n = _nearest(x, models[k]), t[:, 0]
                with np.errstate(divide="ignore", invalid="ignore"):
                    mean = square[:, None] + t[:, -2] / n - 2 * (x @ (t[:, 1:-2] / n[:, None]).T)
                    at = np.arange(len(x))
                    mine = mean[at, own] * n[own] / (n[own] - 1)
                    mean[:, n == 0] = np.inf
                    mean[at, own] = np.inf
                    other = mean.min(1)
                    score = np.where(mine < other, 1 - mine / other, np.where(mine > other, other / mine - 1, 0.0))
                out[k] = np.array([np.where(n[own] > 1, score, 0.0).sum()])
            return out

        scores = _added(cells, silhouettes, dict.fromkeys(tables, 1))
        return [(k, float(t[:, -1].sum()), float(scores[k][0] / t[:, 0].sum())) for k, t in sorted(tables.items())]
    finally:
        if own_cells:
            cells.unpersist()


def best_k(selection: list[tuple[int, float, float]]) -> int:
    return max(selection, key=lambda row: (row[2], -row[0]))[0]


def _placed(ready: DataFrame, c: np.ndarray) -> DataFrame:
    """``ready`` with the number of the nearest centre as ``__raw`` and the vector's cells as ``__v``."""

    @F.pandas_udf("int")
    def own(*columns: pd.Series) -> pd.Series:
        return pd.Series(_nearest(np.stack([v.to_numpy(float) for v in columns], 1), c).astype("int32"))

    rows = ready.withColumn("__v", vector_to_array("features"))
    return rows.withColumn("__raw", own(*[F.col("__v")[i] for i in range(c.shape[1])]))


def misplaced(ready: DataFrame, k: int, centres: np.ndarray | None = None) -> DataFrame:
    """What an independent look at a clustering finds: rows, rows without a cluster, and rows for
    which another centre is nearer than their own. Distances are computed anew from the centres."""
    centres = fitted(ready, k, k)[k] if centres is None else centres
    v = F.col("__v")
    away = [sum(((v[i] - float(c)) * (v[i] - float(c)) for i, c in enumerate(centre)), F.lit(0.0)) for centre in centres]
    rows = _placed(ready, centres).select("__raw", F.array(*away).alias("away"))
    own = F.get("away", F.col("__raw"))
    return rows.agg(
        F.count("*").alias("n"), F.count_if(F.col("__raw").isNull() | own.isNull()).alias("unassigned"),
        F.count_if(own > F.array_min("away") + 1e-9).alias("not_nearest"))


def inertia_gap(ready: DataFrame) -> DataFrame:
    """Per k the inertia of ``k_selection`` against that from sums by cluster, |x|^2 - 2 x c + |c|^2, as a share.
    One pass: rows collapse to sums by the clusters they have for every k, at most 8! groups."""
    models, selection = compared(ready)
    ks, size = sorted(models), next(iter(models.values())).shape[1]

    @F.pandas_udf("array<int>")
    def places(*columns: pd.Series) -> pd.Series:
        x = np.stack([v.to_numpy(float) for v in columns], 1)
        return pd.Series(list(np.stack([_nearest(x, models[k]) for k in ks], 1).astype("int32")))

    v = F.col("__v")
    rows = ready.select(vector_to_array("features").alias("__v")).withColumn("__raws", places(*[v[i] for i in range(size)]))
    sums = rows.groupBy("__raws").agg(
        F.count("*").alias("n"), *[F.sum(v[i]).alias(f"s{i}") for i in range(size)], sum((F.sum(v[i] * v[i]) for i in range(size)), F.lit(0.0)).alias("squares"))
    of = {k: F.array(*[F.array(*[F.lit(float(c)) for c in centre]) for centre in models[k]]) for k in ks}
    inertias = {k: inertia for k, inertia, _ in selection}
    cases = F.array(*[
        F.struct(F.lit(k).cast("bigint").alias("k"), F.get(of[k], F.get("__raws", F.lit(i))).alias("c"), F.lit(max(inertias[k], 1e-300)).alias("inertia"))
        for i, k in enumerate(ks)])
    each = sums.select("n", "squares", *[f"s{i}" for i in range(size)], F.inline(cases))
    centre = lambda i: F.get("c", F.lit(i))
    part = F.col("squares") + sum((F.col("n") * centre(i) * centre(i) - 2 * centre(i) * F.col(f"s{i}") for i in range(size)), F.lit(0.0))
    return each.groupBy("k").agg((F.sum(part) / F.first("inertia") - 1).alias("gap"))


def assigned(ready: DataFrame, k: int, centres: np.ndarray | None = None) -> DataFrame:
    """Rows with their cluster, numbered by descending mean yield."""
    centres = fitted(ready, k, k)[k] if centres is None else centres
    rows = _placed(ready, centres).drop("features", "__v")
    means = rows.groupBy("__raw").agg(F.avg(YIELD).alias("m"))
    # one row per cluster
    numbered = means.withColumn("cluster", F.row_number().over(W.orderBy(F.desc("m"), "__raw")) - 1).select("__raw", "cluster")
    return rows.join(F.broadcast(numbered), "__raw").drop("__raw")


def best_assigned(ready: DataFrame) -> DataFrame:
    """The rows with their cluster of the best k; the models that were compared place them, too."""
    models, selection = compared(ready)
    k = best_k(selection)
    return assigned(ready, k, models[k])


def centres(rows: DataFrame, features: list[str] | None = None) -> DataFrame:
    """Centres in original units: the means of the members."""
    features = existing(rows, features or FEATURES)
    return rows.groupBy("cluster").agg(*[F.avg(f).alias(f) for f in features])


def normalised_profile(centre_rows: DataFrame) -> DataFrame:
    """Each cluster's profile values, scaled to 0..1 across the features of that cluster."""
    cols = existing(centre_rows, PROFILE)
    low, high = F.least(*cols), F.greatest(*cols)
    return centre_rows.select("cluster", *[F.try_divide(F.col(c) - low, high - low).alias(c) for c in cols])


def sizes(rows: DataFrame) -> DataFrame:
    """Members and mean yield per cluster, against the mean of all rows."""
    stats = rows.groupBy("cluster").agg(F.count("*").alias("n"), F.avg(YIELD).alias("avg_yield"), F.sum(YIELD).alias("s"))
    overall = stats.agg((F.sum("s") / F.sum("n")).alias("overall"))
    out = stats.crossJoin(F.broadcast(overall))
    return out.select("cluster", "n", "avg_yield", "overall", (F.col("avg_yield") > F.col("overall")).alias("above_mean"))


def labelled(size_rows: DataFrame) -> DataFrame:
    label = (
        F.when(F.col("avg_yield") > F.col("overall") * 1.1, "High Performers")
        .when(F.col("avg_yield") < F.col("overall") * 0.9, "Underperformers")
        .otherwise("Average Performers")
    )
    return size_rows.withColumn("label", label)


def summary(rows: DataFrame, top: int = 2) -> DataFrame:
    """Size, mean yield, mean efficiency and the most frequent crops per cluster."""
    stats = rows.groupBy("cluster").agg(
        F.count("*").alias("n"), F.avg(YIELD).alias("avg_yield"), F.avg("water_efficiency").alias("avg_water_efficiency")
    )
    counts = rows.groupBy("cluster", "crop_type").agg(F.count("*").alias("c"))
    order = W.partitionBy("cluster").orderBy(F.desc("c"), "crop_type")
    first = counts.withColumn("k", F.row_number().over(order)).where(F.col("k") <= top)
    names = first.groupBy("cluster").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "crop_type"))), lambda x: x["crop_type"]), ", ").alias("top_crops")
    )
    return stats.join(names, "cluster")


def shares(rows: DataFrame, column: str) -> DataFrame:
    return cross_share(rows, "cluster", column, 1.0)
