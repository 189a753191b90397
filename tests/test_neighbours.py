"""The cell tree against brute force, above the number of queries that travel to the points."""

import numpy as np
import pandas as pd
import pytest

from tillage.operators import neighbours

DIMS = ["a", "b", "c"]


def table(n, seed):
    rng = np.random.default_rng(seed)
    x = np.round(np.where(rng.random((n, 3)) < 0.5, rng.normal(size=(n, 3)), rng.integers(0, 3, (n, 3))), 2)
    out = pd.DataFrame(x, columns=DIMS)
    return out.assign(id=[f"{seed}-{i}" for i in range(n)], label=rng.choice(list("xyz"), n), fold=rng.integers(0, 5, n))


def test_tree_finds_every_cell_in_reach():
    rng = np.random.default_rng(1)
    x, q = rng.normal(size=(2000, 3)), rng.normal(size=(300, 3))
    tree = neighbours.CellTree(x, 64)
    home = tree.home(x)
    assert len(np.unique(home)) > 32 and set(tree.axis[home]) == {-1}
    reach = rng.random(300)
    row, cell = tree.within(q, reach)
    seen = set(zip(row.tolist(), cell.tolist()))
    near = np.sqrt(((q[:, None] - x) ** 2).sum(2)) <= reach[:, None]
    assert {(i, home[j]) for i, j in zip(*np.nonzero(near))} <= seen
    assert len(seen) < 300 * len(np.unique(home))
    same = neighbours.CellTree(np.zeros((50, 3)), 8)
    assert len(same.axis) == 1 and set(same.home(q)) == {0}


@pytest.mark.parametrize("fold,tag", [(None, None), ("fold", None), (None, "id")])
def test_many_queries_equal_brute_force(spark, monkeypatch, fold, tag):
    monkeypatch.setattr(neighbours, "CELL_ROWS", 25)
    monkeypatch.setattr(neighbours, "CHUNK", 40)
    points, asked = table(2500, 1), table(1300, 2).drop_duplicates(DIMS + ["fold"])
    assert len(asked) > neighbours.FEW
    k = 4
    got = neighbours.nearest(
        spark.createDataFrame(asked.rename(columns={"id": "q"})[["q", "fold", *DIMS]]), spark.createDataFrame(points), DIMS, k, "q", "label", fold=fold, tag=tag).toPandas()
    got = got.sort_values(["q", "rank"])
    found = {q: g[["distance", "label", "taken", *([tag] if tag else [])]].values.tolist() for q, g in got.groupby("q")}
    for r in asked.itertuples():
        dist = np.round(np.sqrt(((points[DIMS].to_numpy() - np.array([r.a, r.b, r.c])) ** 2).sum(1)), neighbours.DIGITS)
        near = points.assign(d=dist)
        near = near[near["fold"] != r.fold] if fold else near
        want = near.sort_values(["d", "label", "id"] if tag else ["d", "label"]).head(k)
        flat = [(d, lab, *rest) for d, lab, n, *rest in found[r.id] for _ in range(int(n))][:k]
        assert [f[:2] for f in flat] == list(zip(want["d"], want["label"]))
        if tag:
            assert [f[2] for f in flat] == want["id"].tolist()


def test_a_further_cell_answers_only_within_reach():
    points = table(200, 3).assign(__w=1)
    asked = table(20, 4).assign(__q=range(20))
    every = neighbours._closest(asked, points, DIMS, 5, False)
    assert every["n"].sum() >= 100
    reach = every.groupby("__q")["distance"].min()
    near = neighbours._closest(asked.assign(__reach=reach.to_numpy()), points, DIMS, 5, False)
    assert sorted(near["__q"].unique()) == list(range(20)) and (near["distance"].to_numpy() <= reach[near["__q"]].to_numpy()).all()
    none = neighbours._closest(asked.assign(__reach=-1.0), points, DIMS, 5, False)
    assert len(none) == 0


def test_the_driver_gets_a_bounded_sample(spark, monkeypatch):
    """Sorting for the first rows would send as many of them from every task."""
    rows = spark.createDataFrame(table(4000, 5))
    some = neighbours._steering(rows, DIMS, 400, 4000)
    assert 300 < some.count() < 500 and neighbours._steering(rows, DIMS, 4000, 4000).count() == 4000
    plan = some._jdf.queryExecution().toString()
    assert "TakeOrdered" not in plan and "Sort" not in plan and "Limit" not in plan
    asked, steering = [], neighbours._steering
    monkeypatch.setattr(neighbours, "_steering", lambda places, dims, n, total: asked.append((n, total)) or steering(places, dims, n, total))
    monkeypatch.setattr(neighbours, "MOST_SAMPLE", 200)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 25)
    test_many_queries_equal_brute_force(spark, monkeypatch, "fold", None)
    assert len(asked) == 1 and asked[0][0] == 200 < asked[0][1]
