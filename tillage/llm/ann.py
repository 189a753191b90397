"""Approximate nearest neighbours by a forest of sorted hash strings (longest common prefixes)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillage.llm.common import hold, tasks
from tillage.session import materialize

BITS = 63


def _usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector of the rows that take part: not null, no null or non-finite component, not
    all zero, and as long as the longest of them."""
    v = F.col("vector")
    fine = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)))
    return rows.crossJoin(F.broadcast(rows.agg(F.max(F.size("vector")).alias("longest")))).where(F.size("vector") == F.col("longest")).drop("longest")


def fit_planes(points: np.ndarray, trees: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """A direction per tree and bit, from one sampled vector to another, and its median."""
    rng = np.random.default_rng(seed)
    ends = rng.integers(0, len(points), (2, trees * BITS))
    planes = (points[ends[0]] - points[ends[1]]).T
    planes += 1e-3 * rng.standard_normal(planes.shape) * np.abs(points).max()  # two equal ends still part something
    cuts = [np.median(points @ planes[:, t * BITS : (t + 1) * BITS], axis=0) for t in range(trees)]
    return planes, np.concatenate(cuts)


def reach_for(entries: DataFrame, keys_of, kind: np.dtype, k: int, trees: int, recall: float, queries: int = 64) -> int:
    """How many sorted neighbours to either side a query has to take from every tree so that the share
    ``recall`` of the true ``k`` nearest of some asked entries is found. Brute force gives the true ones; one more
    scan counts the entries before each of them in every tree, so the share is known for any reach."""
    some = entries.where("asked").orderBy(F.xxhash64("entry")).limit(queries).select("entry", "vector").collect()
    if not some:
        return 0
    points = np.stack([np.frombuffer(r["vector"], kind) for r in some]).astype(float)
    own = np.array([r["entry"] for r in some])

    def brute(batches):
        hold("ann")
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                cells = part.column("vector").to_pylist()
                held = np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1).astype(float)
                far = ((points**2).sum(1)[:, None] - 2 * points @ held.T + (held**2).sum(1)).clip(0)
                far[own[:, None] == part.column("entry").to_numpy()[None, :]] = np.inf
                best = np.argsort(far, 1)[:, :k]
                q, j = np.repeat(np.arange(len(points)), best.shape[1]), best.ravel()
                fine = np.isfinite(far[q, j])
                yield pa.RecordBatch.from_arrays([pa.array(q[fine]), pa.array(far[q, j][fine]), pa.array([cells[x] for x in j[fine]], pa.binary())], names=["q", "far", "vector"])

    order = Window.partitionBy("q").orderBy("far", "vector")
    true = (
        entries.select("entry", "vector").mapInArrow(brute, "q long, far double, vector binary")
        .withColumn("at", F.row_number().over(order)).where(F.col("at") <= k).select("q", "vector").collect())
    if not true:
        return 0
    asked = keys_of(points)
    theirs = keys_of(np.stack([np.frombuffer(r["vector"], kind) for r in true]).astype(float))
    mine = asked[[r["q"] for r in true]]
    low, high = np.minimum(mine, theirs), np.maximum(mine, theirs)
    edges = [np.unique(np.r_[low[:, t], high[:, t] + 1]) for t in range(trees)]
    start = np.r_[0, np.cumsum([len(e) + 1 for e in edges])]

    def counted(batches):
        hold("ann")
        seen = np.zeros(start[-1], np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                cells = batch.slice(at, 1000).column("vector").to_pylist()
                keys = keys_of(np.frombuffer(b"".join(cells), kind).reshape(len(cells), -1))
                for t in range(trees):
                    seen[start[t] : start[t + 1]] += np.bincount(np.searchsorted(edges[t], keys[:, t], "right"), minlength=len(edges[t]) + 1)
        full = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(seen[full])], names=["slot", "n"])

    slots = np.zeros(start[-1], np.int64)
    for r in entries.select("vector").mapInArrow(counted, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():
        slots[r["slot"]] = r["n"]
    apart = np.full(len(true), np.iinfo(np.int64).max)
    for t in range(trees):
        before = np.cumsum(slots[start[t] : start[t + 1]])  # entries with a key below each edge
        span = before[np.searchsorted(edges[t], high[:, t] + 1)] - before[np.searchsorted(edges[t], low[:, t])]
        apart = np.minimum(apart, span - 1)
    return int(np.sort(apart)[min(len(apart), int(np.ceil(recall * len(apart)))) - 1])


def nearest(vectors: DataFrame, k: int = 10, trees: int = 80, width: int | None = None, sample: int = 4_000,
            id_col: str = "vec_id", vector_col: str = "embedding", every: int = 100, recall: float = 0.95) -> DataFrame:
    """The ``k`` nearest found of every row whose id is divisible by ``every``: query_id, rank from
    1, the id (as ``id_col``) and score, the Euclidean distance in double precision. Nearest first,
    ties to the smaller id; fewer rows where there are fewer candidates.

    Each tree gives every vector a long hash string, and its vectors are sorted by it. A query
    descends in all trees to the entries with the longest common prefix, and the trees ascend together
    to shorter prefixes until each has given up to ``width`` entries on either side. These
    are measured on the original vectors; a tree passes on the k + 1 nearest, which is all
    that the result can take from it. By default ``width`` grows as the number of vectors to the power
    0.6 (100 at least), and further until 64 of the queries, compared with brute force, find the share
    ``recall`` of their true neighbours. The directions and medians come from
    at most ``sample`` vectors, those of the smallest hash; all vectors are indexed.

    The sorted arrays are one range-partitioned shuffle, so a prefix that very many vectors
    share spreads over several tasks; a query near the end of a range takes more from the other side.
    Equal vectors are one entry with its k + 1 smallest ids (no query can need more). Null vectors,
    vectors of zeros, shorter ones than the longest, and those with null or non-finite components take
    no part, nor do null ids; an id that occurs twice counts as two rows. An empty table
    gives an empty result.
    """
    spark = vectors.sparkSession
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind = np.dtype("<f4" if single else "<f8")

    def packed(batches):
        hold("ann")
        for batch in batches:
            column = batch.column("vector")
            cells = [np.asarray(x, kind).tobytes() for x in column.to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(cells, pa.binary())], names=["id", "vector"])

    rows = materialize(_usable(vectors, id_col, vector_col).mapInArrow(packed, "id long, vector binary"), "ann-rows")
    some = rows.select("vector").orderBy(F.xxhash64("vector")).limit(sample).collect()
    if not some:
        return spark.createDataFrame([], f"query_id long, rank int, {id_col} long, score double")
    planes, cuts = fit_planes(np.array([np.frombuffer(r["vector"], kind) for r in some], float), trees)

    first = Window.partitionBy("vector").orderBy("id")
    asked = rows.where(F.col("id") % every == 0)
    distinct = (
        rows.withColumn("at", F.row_number().over(first)).where(F.col("at") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids")))
    entries = materialize(
        distinct.join(asked.select("vector").distinct().withColumn("asked", F.lit(True)), "vector", "left")
        .select("vector", "ids", F.col("asked").isNotNull().alias("asked"), F.xxhash64("vector").alias("entry"), F.col("ids")[0].alias("low")), "ann-entries")
    n = entries.count()
    weights = (1 << np.arange(BITS - 1, -1, -1)).astype(np.int64)

    def keys_of(points):
        bits = points @ planes > cuts
        return np.stack([bits[:, t * BITS : (t + 1) * BITS] @ weights for t in range(trees)], 1)

    reach = width or max(100, int(np.ceil(0.25 * n**0.6)), reach_for(entries, keys_of, kind, k, trees, recall))

    def hashed(batches):
        hold("ann")
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                m = part.num_rows
                points = np.frombuffer(b"".join(part.column("vector").to_pylist()), kind).reshape(m, -1)
                keys = keys_of(points)
                again = pa.array(np.repeat(np.arange(m), trees))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(trees, dtype=np.int32), m)), pa.array(keys.ravel()), *(part.column(c).take(again) for c in ("entry", "low", "asked", "vector"))],
                    names=["tree", "key", "entry", "low", "asked", "vector"])

    def neighbours(batches):
        hold("ann")
        held = pa.Table.from_batches(list(batches), schema=None) if (batches := [b for b in batches if b.num_rows]) else None
        if held is None:
            return
        tree, entry, low, ask = (held.column(c).to_numpy() for c in ("tree", "entry", "low", "asked"))
        points = np.frombuffer(b"".join(held.column("vector").to_pylist()), kind).reshape(len(tree), -1)
        out = []
        for q in np.flatnonzero(ask):
            begin, end = np.searchsorted(tree, tree[q]), np.searchsorted(tree, tree[q], "right")
            a, b = max(begin, q - reach), min(end, q + reach + 1)
            a, b = max(begin, min(a, b - 2 * reach - 1)), min(end, max(b, a + 2 * reach + 1))
            score = np.sqrt(((points[a:b].astype(float) - points[q].astype(float)) ** 2).sum(1))
            best = np.lexsort((low[a:b], score))[: k + 1]
            out.append((np.full(len(best), entry[q]), entry[a:b][best], low[a:b][best], score[best]))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out)], names=["query", "entry", "low", "score"])

    # ranges hold several times the reach, so few queries are near the end of one
    parts = max(1, min(max(tasks(spark), trees, n * trees // 100_000), n * trees // (8 * reach)))
    forest = (
        entries.repartition(tasks(spark)).mapInArrow(hashed, "tree int, key long, entry long, low long, asked boolean, vector binary")
        .repartitionByRange(parts, "tree", "key", "entry").sortWithinPartitions("tree", "key", "entry"))
    found = forest.mapInArrow(neighbours, "query long, entry long, low long, score double")
    near = Window.partitionBy("query").orderBy("score", "low", "entry")
    taken = (
        found.groupBy("query", "entry").agg(F.first("score").alias("score"), F.first("low").alias("low"))
        .withColumn("place", F.row_number().over(near)).where(F.col("place") <= k + 1).select("query", "entry", "score"))
    known = entries.select("entry", F.explode("ids").alias("id"))
    lists = taken.join(known, "entry").groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("found"))
    # a query's list has at most (k + 1) * (k + 1) ids; its own goes, the first k others stay
    queries = asked.select(F.col("id").alias("query_id"), F.xxhash64("vector").alias("query"))
    mine = queries.join(lists, "query").select("query_id", F.slice(F.filter("found", lambda f: f["id"] != F.col("query_id")), 1, k).alias("found"))
    return mine.select("query_id", F.posexplode("found").alias("at", "f")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("f.id").alias(id_col), F.col("f.score").alias("score"))
