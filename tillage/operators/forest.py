"""A regression forest whose trees are grown to their full depth: the rows of large nodes are split by
histograms over all tasks, and a node that fits one task is grown there to the end.

A deep tree has more nodes than histograms could be kept for, level by level, over all trees at
once. Nodes with at most ``local_rows`` rows therefore travel, as one byte per feature and row, to a
task that finishes them. A tree takes each row as often as a Poisson draw from the row's number in the
written table says, so a lost task draws the same rows again.
"""

from __future__ import annotations

import itertools
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillage.session import fresh_path, materialize

# the helpers below travel to the executors with the job: they need no installed package there
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LOCAL_ROWS = 4_000_000  # rows that a task grows by itself
SENT_ROWS = 140_000_000  # rows that the trees of one pass send
CELLS = 1 << 14  # of a feature's histograms that are made together
WIDE_ROWS, WIDE_BYTES = 64, 32 << 20  # rows a node, and bytes, up to which a task keeps the histograms of a level
HISTOGRAM_BYTES = 256 << 20  # of the nodes that one pass splits
_CHANCES = np.cumsum(np.exp(-1) / np.array([1, 1, 2, 6, 24, 120, 720, 5040], float))  # Poisson with mean 1
_PART = "tree int, part int, feature binary, cut binary, left binary, value binary, gains array<double>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def draws(rows: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often a tree takes each row."""
    salt = _mixed(np.array([tree * 1_000_003 + seed], np.uint64))
    u = (_mixed(rows ^ salt) >> np.uint64(11)).astype(float) / 2.0**53
    return np.searchsorted(_CHANCES, u, "right")


def histograms(codes: np.ndarray, y: np.ndarray, w: np.ndarray, node: np.ndarray, nodes: int, widths: list[int]) -> np.ndarray:
    """The weights and weighted targets by node and code, the units side by side."""
    wy, out = w * y, []
    for code, size in zip(codes, widths):
        at = node * size + code
        out.append(np.stack([np.bincount(at, v, nodes * size).reshape(nodes, size) for v in (w, wy)]))
    return np.concatenate(out, 2)


def _by_feature(sums: np.ndarray, units: list[tuple[int, int]], sizes: list[int]) -> np.ndarray:
    """What ``histograms`` found, by the bins of every feature: of one that shares a unit, not set is all the rest."""
    bound, at = np.r_[0, np.cumsum(sizes)], 0
    whole = sums[:, :, : units[0][1] + 1 if units[0][1] else sizes[units[0][0]]].sum(2, keepdims=True)
    out = np.repeat(whole, bound[-1], 2)
    for f, members in units:
        if members:
            set_ = sums[:, :, at + 1 : at + members + 1]
            out[:, :, bound[f] + 1 : bound[f + members] : 2] = set_
            out[:, :, bound[f] : bound[f + members] : 2] -= set_
        else:
            out[:, :, bound[f] : bound[f + 1]] = sums[:, :, at : at + sizes[f]]
        at += members + 1 if members else sizes[f]
    return out


def best_splits(sums: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """Per node: feature (-1 if no split helps), the last bin that goes left, and what the split gains."""
    nodes = sums[0].shape[1]
    n, s = sums[0][0].sum(1), sums[0][1].sum(1)
    base = s * s / np.maximum(n, 1e-300)
    gain, feature, cut = np.full(nodes, 0.0), np.full(nodes, -1), np.zeros(nodes, np.int64)
    for f, both in enumerate(sums):
        if both.shape[2] < 2:
            continue
        left = np.cumsum(both[:, :, :-1], 2)
        ln, ls = left
        rn, rs = n[:, None] - ln, s[:, None] - ls
        with np.errstate(divide="ignore", invalid="ignore"):
            got = np.where((ln > 0.5) & (rn > 0.5), ls * ls / ln + rs * rs / rn, -np.inf) - base[:, None]
        at = got.argmax(1)
        most = got[np.arange(nodes), at]
        better = most > gain + 1e-9 * np.maximum(np.abs(base), 1)
        gain[better], feature[better], cut[better] = most[better], f, at[better]
    return feature, cut, gain


def _met(columns: np.ndarray, sizes: list[int]) -> np.ndarray:
    """Per feature of two bins the last feature of two bins before it that is set in a row of its own; -1 for none."""
    met, last = np.full(len(sizes), -1), np.full(columns.shape[1], -1)
    for f, size in enumerate(sizes):
        if size == 2:
            on = np.flatnonzero(columns[f])
            met[f] = last[on].max(initial=-1)
            last[on] = f
    return met


def _grouped(met: np.ndarray, sizes: list[int]) -> list[tuple[int, int]]:
    """(first feature, members) of what is counted together. Neighbouring features of two bins of
    which no row has more than one set share a histogram by member (0: none is set), so one-hot columns
    cost as much as the label they stand for; a feature of more bins stands alone, with 0 members."""
    units = []
    for f, size in enumerate(sizes):
        if size < 2:
            continue
        first, members = units[-1] if units else (0, 0)
        if size == 2 and 0 < members < 255 and first + members == f and met[f] < first:
            units[-1] = (first, members + 1)
        else:
            units.append((f, int(size == 2)))
    return units


def _coded(columns: np.ndarray, units: list[tuple[int, int]]) -> np.ndarray:
    """A row of codes per unit: the bin, or the member that is set."""
    out = np.zeros((len(units), columns.shape[1]), np.uint8)
    for code, (f, members) in zip(out, units):
        if members:
            for m in range(members):
                code[columns[f + m] > 0] = m + 1
        else:
            code[:] = columns[f]
    return out


class _Best:
    """The best split of some nodes so far; their rows are n and add up to 0."""

    def __init__(self, n: np.ndarray, base: np.ndarray):
        self.n, self.least = n, 1e-9 * np.maximum(base, 1)
        self.gain, self.feature, self.cut = np.zeros(len(n)), np.full(len(n), -1), np.zeros(len(n), np.int64)

    def look(self, f: int, members: int, cells: np.ndarray, sums: np.ndarray) -> None:
        """Weights and centred targets of one unit, bins by nodes."""
        if members:  # not set goes left
            n, s = cells[1:], sums[1:]
        else:
            n, s = np.cumsum(cells[:-1], 0), np.cumsum(sums[:-1], 0)
        room = self.n - n
        room *= n
        np.maximum(room, 0.5, out=room)  # no rows on one side: their sum is 0, and so is the gain
        got = s * s
        got /= room
        top = got.max(0) * self.n
        at = np.flatnonzero(top > self.gain + self.least)
        if len(at):
            self.gain[at] = top[at]
            # the first of equals; a member, like a feature, must gain more than the one before it
            least = self.least[at] if members else 1e-12 * top[at]
            place = (got[:, at] * self.n[at] >= top[at] - least).argmax(0)
            self.feature[at], self.cut[at] = (f + place, 0) if members else (f, place)


def _centred(sums: np.ndarray, cells: np.ndarray, mean: np.ndarray) -> np.ndarray:
    return sums - cells * mean


def _wide_splits(units, widths: list[int], codes, w, wy, node, n, s, held, family):
    """The best splits of nodes with many rows each, whose histograms are kept for the next level: there only the
    smaller child of a node is counted, and the other is what is left. ``family``: the parent of each pair of nodes."""
    count, mean = len(n), s / n
    best, kept = _Best(n, s * mean), []
    if held is not None:
        pairs = n.reshape(-1, 2)
        small = 2 * np.arange(len(pairs)) + (pairs[:, 1] < pairs[:, 0])
        rank = np.full(count + 1, -1)
        rank[small] = np.arange(len(small))
        local = rank[node]
        rows = np.flatnonzero(local >= 0)
        local, ww, ss = local[rows], w[rows], wy[rows]
    else:
        rows, local, ww, ss = None, node, w, wy
    nodes = count if held is None else len(small)
    at = np.empty(len(local), np.int64)
    for u, (f, members) in enumerate(units):
        size = widths[u]
        np.multiply(codes[u] if held is None else codes[u].take(rows), nodes, out=at, dtype=np.int64)
        at += local
        cells, sums = (np.bincount(at, v, nodes * size).reshape(size, nodes) for v in (ww, ss))
        if held is not None:
            both = np.empty((2, size, count))
            both[0][:, small], both[1][:, small] = cells, sums
            both[0][:, small ^ 1], both[1][:, small ^ 1] = held[u][0][:, family] - cells, held[u][1][:, family] - sums
            cells, sums = both
            sums[cells == 0] = 0.0
        kept.append((cells, sums))
        best.look(f, members, cells, _centred(sums, cells, mean))
    return best, kept


def _deep_splits(units, widths: list[int], codes, w, wy, node, n, s):
    """The best splits of nodes whose rows lie in the order of the nodes, some nodes at a time: what is made of
    them stays in the processor's cache, however many nodes a level has."""
    count, mean = len(n), s / n
    ends, centred = np.cumsum(np.bincount(node, minlength=count)), wy - w * mean[node]
    gain, feature, cut = np.zeros(count), np.full(count, -1), np.zeros(count, np.int64)
    step = max(1, CELLS // max(widths, default=1))
    for begin in range(0, count, step):
        end = min(count, begin + step)
        a, b = int(ends[begin - 1]) if begin else 0, int(ends[end - 1])
        if a == b:
            continue
        local, ww, ss, nodes = node[a:b] - begin, w[a:b], centred[a:b], end - begin
        best = _Best(n[begin:end], s[begin:end] * mean[begin:end])
        at = np.empty(b - a, np.int64)
        for u, (f, members) in enumerate(units):
            np.multiply(codes[u, a:b], nodes, out=at, dtype=np.int64)
            at += local
            best.look(f, members, *(np.bincount(at, v, nodes * widths[u]).reshape(widths[u], nodes) for v in (ww, ss)))
        gain[begin:end], feature[begin:end], cut[begin:end] = best.gain, best.feature, best.cut
    return feature, cut, gain


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """A tree of at most ``depth`` splits in a row: feature (-1 for a leaf), cut, left child (the right one
    follows it), value, and the gains by feature."""
    units = _grouped(_met(x.T, sizes), sizes)
    return grow_coded(units, _coded(x.T, units), y, w, depth, sizes)


def grow_coded(units: list[tuple[int, int]], codes: np.ndarray, y: np.ndarray, w: np.ndarray, depth: int, sizes: list[int]) -> tuple[np.ndarray, ...]:
    """``grow`` on a row of codes per unit. All nodes of a level are split together; once nodes are small, the rows
    are kept in the order of their nodes."""
    widths = [m + 1 if m else sizes[f] for f, m in units]
    unit_of, member = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for u, (f, members) in enumerate(units):
        unit_of[f : f + max(members, 1)] = u
        member[f : f + members] = np.arange(1, members + 1)
    wy, node = w * y, np.zeros(len(y), np.int64)
    weight, total = np.array([w.sum()]), np.array([wy.sum()])
    feature, cut, left = [np.array([-1])], [np.array([0])], [np.array([0])]
    value, gains, made = [total / weight], np.zeros(len(sizes)), 1
    held, family, wide = None, None, True
    for _ in range(depth):
        if not len(node) or not units:
            break
        count = len(weight)  # also the node of rows whose leaf is found
        wide = wide and len(node) >= WIDE_ROWS * count and 16 * sum(widths) * count <= WIDE_BYTES
        if wide:
            best, held = _wide_splits(units, widths, codes, w, wy, node, weight, total, held, family)
            f, c, g = best.feature, best.cut, best.gain
        else:
            if held is not None:  # from here on in the order of the nodes
                held, order = None, np.argsort(node, kind="stable")
                order = order[: np.count_nonzero(node < count)]
                codes, w, wy, node = codes.take(order, 1), w[order], wy[order], node[order]
            f, c, g = _deep_splits(units, widths, codes, w, wy, node, weight, total)
        split = f >= 0
        if not split.any():
            break
        np.add.at(gains, f[split], g[split])
        feature[-1], cut[-1] = f, c
        rank = np.cumsum(split) - 1
        left[-1] = np.where(split, made + 2 * rank, 0)
        family = np.flatnonzero(split)
        rows = np.flatnonzero(np.r_[split, False][node])
        node = node[rows]
        # right goes what is above low and not above high
        which = member[f]
        low, high = (np.where(which > 0, a, b).astype(np.uint8)[node] for a, b in ((which - 1, c), (which, 255)))
        own = codes.reshape(-1).take((unit_of[f] * codes.shape[1])[node] + rows)
        node = (2 * rank)[node] + ((own > low) & (own <= high))
        children = 2 * len(family)
        ww, ss = (w, wy) if len(rows) == len(w) else (w[rows], wy[rows])
        weight, total = np.bincount(node, ww, children), np.bincount(node, ss, children)
        value.append(total / np.maximum(weight, 1e-300))
        for part, empty in ((feature, -1), (cut, 0), (left, 0)):
            part.append(np.full(children, empty))
        made += children
        if wide:
            if len(rows) < 0.8 * len(w):
                codes, w, wy = codes.take(rows, 1), ww, ss
            elif len(rows) < len(w):
                node, some = np.full(len(w), children), node
                node[rows] = some
            continue
        go = (np.bincount(node, minlength=children) > 1)[node]  # a single row has nothing to split
        rows, node = rows[go], node[go]
        order = np.argsort(node, kind="stable")
        rows, node = rows[order], node[order]
        codes, w, wy = codes.take(rows, 1), w[rows], wy[rows]
    return np.concatenate(feature), np.concatenate(cut), np.concatenate(left), np.concatenate(value), gains


def walk(x: np.ndarray, feature: np.ndarray, cut: np.ndarray, left: np.ndarray) -> np.ndarray:
    """The leaf of each row."""
    at, live = np.zeros(len(x), np.int64), np.arange(len(x))
    while len(live):
        f = feature[at[live]]
        live = live[f >= 0]
        here = at[live]
        at[live] = left[here] + (x[live, feature[here]] > cut[here])
    return at


def _matrix(column, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist() if hasattr(column, "to_pylist") else column), np.uint8).reshape(-1, width)


class Top:
    """The distributed upper part of one tree; ``part`` numbers the leaves that tasks finish."""

    def __init__(self):
        self.feature, self.cut, self.left, self.level, self.part = [-1], [0], [0], [0], [0]

    def arrays(self):
        return np.array(self.feature), np.array(self.cut), np.array(self.left), np.array(self.part)


def _slots(spark: SparkSession, tasks: int) -> list[int]:
    """A number for each of so many shuffle partitions that is dealt to it."""
    ids = spark.range(24 * tasks + 100).select("id", F.pmod(F.hash("id"), F.lit(tasks)).alias("at"))
    found = dict(ids.groupBy("at").agg(F.min("id")).collect())
    return [found.get(i, i) for i in range(tasks)]


class ForestRegressor:
    """Fits ``numTrees`` trees of ``maxDepth`` on rows drawn with replacement; every split looks at all
    features, numbers in at most ``maxBins`` bins between values of the data."""

    def __init__(self, numTrees: int = 300, maxDepth: int = 18, seed: int = 42, labelCol: str = "label", featuresCol: str = "features", predictionCol: str = "prediction", maxBins: int = 32, localRows: int = LOCAL_ROWS):
        self.trees, self.depth, self.seed, self.label, self.features, self.prediction, self.bins, self.local = numTrees, maxDepth, seed, labelCol, featuresCol, predictionCol, maxBins, localRows

    def getNumTrees(self) -> int:
        return self.trees

    def getMaxDepth(self) -> int:
        return self.depth

    def _cuts(self, df: DataFrame) -> list[list[float]]:
        width = df.schema[self.features].metadata.get("ml_attr", {}).get("num_attrs") or len(df.select(self.features).first()[0])
        cells = df.select(vector_to_array(self.features).alias("v")).select(*[F.get("v", F.lit(i)).alias(f"f{i}") for i in range(width)])
        chances = [i / self.bins for i in range(self.bins + 1)]
        found = cells.approxQuantile(cells.columns, chances, 1 / (8 * self.bins))
        return [sorted({v for v in q if v == v})[:-1] for q in found]  # below or at a cut goes left

    def fit(self, df: DataFrame) -> ForestModel:
        spark, label = df.sparkSession, self.label
        df = df.where(F.col(label).isNotNull() & ~F.isnan(label))
        cuts = self._cuts(df)
        sizes, width = [len(c) + 1 for c in cuts], len(cuts)
        rows = materialize(binned(df.select(self.features, label), self.features, cuts).select(
            "bins", F.col(label).cast("double").alias("y")).withColumn("row", F.monotonically_increasing_id()), "forest-rows", spread=True)
        total, units = self._units(rows, sizes)
        tops = [Top() for _ in range(self.trees)]
        gains = np.zeros((self.trees, width))
        if total > self.local and units:
            self._split_large(rows, tops, gains, sizes, total, units)
        path = fresh_path(spark, "forest")
        batch = max(1, min(self.trees, SENT_ROWS // max(total, 1)))
        for begin in range(0, self.trees, batch):
            some = {t: tops[t] for t in range(begin, min(self.trees, begin + batch))}
            self._grow_small(rows, some, sizes, units).write.mode("append").parquet(path)
        return ForestModel(path, cuts, tops, gains, self.features, self.prediction)

    def _units(self, rows: DataFrame, sizes: list[int]) -> tuple[int, list[tuple[int, int]]]:
        """The number of rows, and which features share a histogram in all of them."""

        def met(batches):
            n, most = 0, np.full(len(sizes), -1)
            for b in batches:
                n, most = n + b.num_rows, np.maximum(most, _met(_matrix(b.column("bins"), len(sizes)).T, sizes))
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([most.tolist()], pa.list_(pa.int64()))], names=["n", "met"])

        found = rows.select("bins").mapInArrow(met, "n bigint, met array<bigint>").collect()
        return sum(r["n"] for r in found), _grouped(np.max([r["met"] for r in found] or [[-1] * len(sizes)], 0), sizes)

    def _split_large(self, rows: DataFrame, tops: list[Top], gains: np.ndarray, sizes: list[int], total: int, units: list[tuple[int, int]]) -> None:
        """Splits the nodes of over ``localRows`` rows, level by level and some trees at a time."""
        seed, width, bound = self.seed, len(sizes), np.r_[0, np.cumsum(sizes)]
        widths = [m + 1 if m else sizes[f] for f, m in units]
        node_bytes = 16 * int(bound[-1])
        open_ = {(t, 0): total for t in range(len(tops))}
        for level in range(self.depth):
            wide = sorted(k for k, n in open_.items() if n > self.local)
            if not wide:
                break
            step = max(1, HISTOGRAM_BYTES // node_bytes)
            open_ = {}
            for begin in range(0, len(wide), step):
                some = wide[begin : begin + step]
                by_tree = {t: [n for u, n in some if u == t] for t in {t for t, _ in some}}
                arrays = {t: tops[t].arrays() for t in by_tree}

                def count(batches, by_tree=by_tree, arrays=arrays):
                    held = {}
                    for b in batches:
                        x, y, ids = _matrix(b.column("bins"), width), b.column("y").to_numpy(), b.column("row").to_numpy().view(np.uint64)
                        codes = _coded(x.T, units)
                        for t, nodes in by_tree.items():
                            w = draws(ids, t, seed)
                            at = walk(x, *arrays[t][:3])
                            place = np.full(len(arrays[t][0]), -1)
                            place[nodes] = np.arange(len(nodes))
                            use = np.flatnonzero((w > 0) & (place[at] >= 0))
                            got = histograms(codes.take(use, 1), y[use], w[use].astype(float), place[at[use]], len(nodes), widths)
                            held[t] = held[t] + got if t in held else got
                    held = {t: _by_feature(sums, units, sizes).transpose(1, 0, 2) for t, sums in held.items()}
                    out = [(t, n, held[t][i].tobytes()) for t, nodes in by_tree.items() if t in held for i, n in enumerate(nodes)]
                    yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), pa.array([o[2] for o in out], pa.binary())], names=["tree", "node", "sums"])

                def choose(pdf: pd.DataFrame) -> pd.DataFrame:
                    sums = sum(np.frombuffer(s).reshape(2, 1, -1) for s in pdf["sums"])
                    f, c, g = best_splits([sums[:, :, a:b] for a, b in zip(bound[:-1], bound[1:])])
                    split = int(f[0]) >= 0
                    part = sums[0, 0, bound[f[0]] : bound[f[0] + 1]] if split else np.zeros(1)
                    low = part[: c[0] + 1].sum() if split else 0.0
                    return pd.DataFrame({"tree": pdf["tree"][:1], "node": pdf["node"][:1], "feature": f, "cut": c, "gain": g, "low": [low], "high": [part.sum() - low]})

                found = rows.mapInArrow(count, "tree int, node int, sums binary").groupBy("tree", "node").applyInPandas(
                    choose, "tree int, node int, feature int, cut int, gain double, low double, high double")
                # one row per node that holds over localRows rows
                for r in sorted(found.collect(), key=lambda r: (r["tree"], r["node"])):
                    if r["feature"] < 0:
                        continue
                    top = tops[r["tree"]]
                    at = len(top.feature)
                    top.feature[r["node"]], top.cut[r["node"]], top.left[r["node"]] = r["feature"], r["cut"], at
                    gains[r["tree"], r["feature"]] += r["gain"]
                    for i, n in enumerate((r["low"], r["high"])):
                        top.feature.append(-1)
                        top.cut.append(0)
                        top.left.append(0)
                        top.level.append(level + 1)
                        top.part.append(at + i)
                        open_[r["tree"], at + i] = n

    def _grow_small(self, rows: DataFrame, tops: dict[int, Top], sizes: list[int], units: list[tuple[int, int]]) -> DataFrame:
        """The parts below the upper ends of some trees, each grown in one task."""
        seed, width, depth = self.seed, len(sizes), self.depth
        arrays = {t: top.arrays() for t, top in tops.items()}
        levels = {t: top.level for t, top in tops.items()}
        # a task for each group: the groups are few and heavy, and two in one task wait for each other
        groups = [(t, p) for t, (feature, *_) in arrays.items() for p in np.flatnonzero(feature < 0).tolist()]
        tasks = min(len(groups), 2000)
        slots = {g: key for g, key in zip(groups, itertools.cycle(_slots(rows.sparkSession, tasks)))}

        def send(batches):
            for b in batches:
                x, ids, y = _matrix(b.column("bins"), width), b.column("row").to_numpy().view(np.uint64), b.column("y").to_numpy()
                codes = _coded(x.T, units)
                for t, (feature, cut, left, _) in arrays.items():
                    w = draws(ids, t, seed)
                    use = np.flatnonzero(w)
                    if len(feature) > 1:
                        at = walk(x[use], feature, cut, left)
                        found = [(p, use[at == p]) for p in np.unique(at).tolist()]
                    else:
                        found = [(0, use)] if len(use) else []
                    # a row for each part, unit by unit: a group has few rows, and equal bytes lie together
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([slots[t, p] for p, _ in found], pa.int64()), pa.array([t] * len(found), pa.int32()), pa.array([p for p, _ in found], pa.int32()), pa.array([codes.take(r, 1).tobytes() for _, r in found], pa.binary()),
                         pa.array([y[r].tobytes() for _, r in found], pa.binary()), pa.array([w[r].astype(np.uint8).tobytes() for _, r in found], pa.binary())],
                        names=["slot", "tree", "part", "bins", "y", "w"])

        def finish(pdf: pd.DataFrame) -> pd.DataFrame:
            t, part = int(pdf["tree"].iloc[0]), int(pdf["part"].iloc[0])
            y, w = (np.frombuffer(b"".join(pdf[c]), kind) for c, kind in (("y", np.float64), ("w", np.uint8)))
            codes = np.concatenate([np.frombuffer(b, np.uint8).reshape(len(units), len(n)) for b, n in zip(pdf["bins"], pdf["w"])], 1)
            f, c, left, value, gains = grow_coded(units, codes, y, w.astype(float), depth - levels[t][part], sizes)
            packed = [f.astype(np.int16).tobytes(), c.astype(np.uint8).tobytes(), left.astype(np.int32).tobytes(), value.astype(np.float32).tobytes()]
            return pd.DataFrame([[t, part, *packed, gains.tolist()]], columns=["tree", "part", "feature", "cut", "left", "value", "gains"])

        sent = rows.mapInArrow(send, "slot bigint, tree int, part int, bins binary, y binary, w binary")
        return sent.repartition(tasks, "slot").groupBy("slot", "tree", "part").applyInPandas(finish, _PART)


def binned(df: DataFrame, features: str, cuts: list[list[float]], name: str = "bins") -> DataFrame:
    """``df`` without ``features``, with one byte per feature in ``name``: how many cuts are below the value."""
    rest = [c for c in df.columns if c != features]
    schema = ", ".join([*(f"`{n}` {t}" for n, t in df.select(*rest).dtypes), f"`{name}` binary"])

    def run(batches):
        for b in batches:
            cells = b.column("__cells").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cuts))
            out = np.stack([np.searchsorted(c, cells[:, i]) for i, c in enumerate(cuts)], 1).astype(np.uint8) if b.num_rows else np.zeros((0, len(cuts)), np.uint8)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array([r.tobytes() for r in out], pa.binary())], names=[*rest, name])

    return df.select(*rest, vector_to_array(features).alias("__cells")).mapInArrow(run, schema)


class ForestModel(Model, MLWritable, MLReadable):
    """The fitted forest. Its parts lie in the shared folder as a table and are read one row group at a
    time by the tasks that score, so no task and no driver holds the whole of it."""

    def __init__(self, path: str = "", cuts=None, tops=None, gains=None, features: str = "features", prediction: str = "prediction"):
        super().__init__()
        self.path, self.cuts, self.tops, self.gains, self.features, self.prediction = path, cuts, tops, gains, features, prediction

    @property
    def featureImportances(self) -> DenseVector:
        """Each tree's gains by feature as shares, averaged over the trees."""
        spark = SparkSession.active()
        each = spark.read.parquet(self.path).select("tree", F.posexplode("gains").alias("f", "g")).groupBy("tree", "f").agg(F.sum("g").alias("g")).collect()
        total = self.gains.copy()  # trees x features
        for r in each:
            total[r["tree"], r["f"]] += r["g"]
        mean = (total / np.maximum(total.sum(1, keepdims=True), 1e-300)).mean(0)
        return DenseVector(mean / max(mean.sum(), 1e-300))

    def _transform(self, df: DataFrame) -> DataFrame:
        width, path = len(self.cuts), self.path
        arrays = [top.arrays() for top in self.tops]
        kept = df.drop(self.prediction)
        names = kept.columns
        cells = kept.withColumn("__features", F.col(self.features))
        # ml vectors do not travel in Arrow: they are rebuilt from their cells afterwards
        vectors = [f.name for f in kept.schema if f.dataType.typeName() == "vectorudt" or "Vector" in type(f.dataType).__name__]
        plain = cells.withColumns({v: vector_to_array(v) for v in vectors}) if vectors else cells
        ready = binned(plain, "__features", self.cuts, "__bins")
        order = [*names, self.prediction]
        schema = ", ".join([*(f"`{n}` {t}" for n, t in ready.drop("__bins").dtypes), f"`{self.prediction}` double"])

        def parts():
            fs, root = pafs.FileSystem.from_uri(path)
            for info in sorted(fs.get_file_info(pafs.FileSelector(root)), key=lambda i: i.path):
                if info.path.endswith(".parquet"):
                    with fs.open_input_file(info.path) as source:
                        for batch in pq.ParquetFile(source).iter_batches(batch_size=8, columns=["tree", "part", "feature", "cut", "left", "value"]):
                            yield from batch.to_pylist()

        def run(batches):
            held, n = [], 0

            def score(held):
                x = np.concatenate([_matrix(b.column("__bins"), width) for b in held])
                total, seen, ends = np.zeros(len(x)), np.zeros(len(x)), {}
                for r in parts():
                    t = r["tree"]
                    feature, cut, left, part = arrays[t]
                    at = np.arange(len(x))
                    if len(feature) > 1:
                        if t not in ends:
                            ends = {t: walk(x, feature, cut, left)}
                        at = np.flatnonzero(ends[t] == r["part"])
                        if not len(at):
                            continue
                    f, c, child = np.frombuffer(r["feature"], np.int16), np.frombuffer(r["cut"], np.uint8), np.frombuffer(r["left"], np.int32)
                    seen[at] += 1
                    total[at] += np.frombuffer(r["value"], np.float32)[walk(x[at], f, c, child)]
                total, done = total / np.maximum(seen, 1), 0  # a tree that drew no row has no say
                for b in held:
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in names), pa.array(total[done : done + b.num_rows])], names=order)
                    done += b.num_rows

            for b in batches:
                if b.num_rows:
                    held.append(b)
                    n += b.num_rows
                if n >= 200_000:  # rows that go through the forest together
                    yield from score(held)
                    held, n = [], 0
            if held:
                yield from score(held)

        out = ready.mapInArrow(run, schema)
        if vectors:
            from pyspark.ml.functions import array_to_vector

            out = out.withColumns({v: array_to_vector(v) for v in vectors})
        return out

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, spark = self.model, SparkSession.active()
        extra = {"cuts": m.cuts, "tops": [[list(map(int, getattr(t, k))) for k in ("feature", "cut", "left", "part")] for t in m.tops], "gains": m.gains.tolist(), "features": m.features, "prediction": m.prediction}
        DefaultParamsWriter.saveMetadata(m, path, spark, extraMetadata={"forest": extra})
        spark.read.parquet(m.path).write.parquet(f"{path}/parts")


class _Reader(MLReader):
    def load(self, path: str) -> ForestModel:
        got = DefaultParamsReader.loadMetadata(path, SparkSession.active())
        extra, tops = got["forest"], []
        for feature, cut, left, part in extra["tops"]:
            top = Top()
            top.feature, top.cut, top.left, top.part = feature, cut, left, part
            tops.append(top)
        model = ForestModel(f"{path}/parts", extra["cuts"], tops, np.array(extra["gains"]), extra["features"], extra["prediction"])
        model._resetUid(got["uid"])
        return model
