import itertools
import os

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillage.operators import allocate, cleaning, clustering, cube, filters, mining, models, neighbours, quality
from tillage.operators import warehouse as wh
from tillage.session import fresh_path, shared_folder
from tillage.sources import files

Y = "yield_kg_per_hectare"


# ---- cleaning ---------------------------------------------------------------------------------------


def test_interpolation_by_position(spark):
    values = [None, 1.0, None, None, 4.0, None]
    days = [f"2024-01-{d:02d}" for d in (1, 2, 5, 20, 21, 22)]
    df = spark.createDataFrame([("s", d, v) for d, v in zip(days, values)], "s string, d string, v double")
    out = cleaning.interpolate(df.repartition(3), "s", "d", "v").orderBy("d").collect()
    assert [r["v"] for r in out] == [1.0, 1.0, 2.0, 3.0, 4.0, 4.0]


def test_strategies(spark):
    df = spark.createDataFrame([("2024-01-01", None, 1.0), ("2024-01-02", 2.0, None), ("2024-01-03", 4.0, 3.0)], "date string, a double, b double")
    fill = {r["date"]: (r["a"], r["b"]) for r in cleaning.handle_missing(df, "ffill").collect()}
    assert fill == {"2024-01-01": (2.0, 1.0), "2024-01-02": (2.0, 1.0), "2024-01-03": (4.0, 3.0)}
    mean = {r["date"]: (r["a"], r["b"]) for r in cleaning.handle_missing(df, "mean").collect()}
    assert mean["2024-01-01"] == (3.0, 1.0) and mean["2024-01-02"] == (2.0, 2.0)
    assert cleaning.handle_missing(df, "drop").count() == 1


def test_lenient_fill(spark):
    df = spark.createDataFrame([(1.0, "a", None), (None, "b", None), (4.0, None, None), (2.0, "b", None)], "n double, s string, e string")
    rows = cleaning.fill_lenient(df).collect()
    assert sorted(r["n"] for r in rows) == [1.0, 2.0, 2.0, 4.0]
    assert sorted(r["s"] for r in rows) == ["a", "b", "b", "b"] and {r["e"] for r in rows} == {"Unknown"}


def test_average_prices_fall_back_to_proxy_year(spark):
    df = spark.sql("SELECT * FROM VALUES (date'2023-05-01', 100D), (date'2023-06-01', 300D), (date'2022-01-01', 9D) t(date, CORN)")
    prices = cleaning.normalized_prices(df, ["CORN"])
    assert cleaning.average_prices(prices, ["CORN"]).first()["CORN"] == pytest.approx(200 / 100 * 0.92 / 25.4)


# ---- filters --------------------------------------------------------------------------------------------


def test_filter_ignores_empty_and_bad_bounds(spark):
    df = spark.createDataFrame([("r", "c", "i", 10.0), ("r", "d", "i", 20.0)], f"region string, crop_type string, irrigation_type string, {Y} double")
    assert filters.dashboard_filter(df, "", None, "", "x", "").count() == 2
    assert filters.dashboard_filter(df, "r", "", "", "15", None).count() == 1
    assert filters.count_and_mean(df.where("false")).first()["average_yield"] == 0


def test_search_skips_falsy_values(spark):
    df = spark.createDataFrame([("A10", 0.0, 5.0), ("b", 10.0, 0.0), ("", 0.0, 0.0)], "s string, x double, z double")
    assert filters.search(df, "10").count() == 2
    assert filters.search(df, "0.0").count() == 0
    assert filters.search(df, "a1").count() == 1


def test_pages(spark):
    df = spark.range(25).toDF("id")
    assert [r["id"] for r in filters.page(df, 3, 10, "id").collect()] == [20, 21, 22, 23, 24]
    assert filters.page_count(df, 10).first()["total_pages"] == 3


# ---- warehouse --------------------------------------------------------------------------------------------


def test_surrogate_keys_are_stable(spark):
    first = wh.insert_if_absent(spark.createDataFrame([("b",), ("c",)], "k string"), "k", "id")
    grown = wh.insert_if_absent(spark.createDataFrame([("a",), ("c",), (None,)], "k string"), "k", "id", first)
    assert {r["k"]: r["id"] for r in grown.collect()} == {"b": 1, "c": 2, "a": 3}


def test_missing_dimension_member_gives_missing_key(spark):
    fact = spark.createDataFrame([("x",), ("y",)], "crop_type string")
    dim = spark.createDataFrame([(1, "x")], "crop_id int, crop_type string")
    out = {r["crop_type"]: r["k"] for r in wh._lookup(fact, dim, "crop_type", "crop_type", "crop_id", "k").collect()}
    assert out == {"x": 1, "y": None}
    keyed = fact.withColumn("k", F.when(F.col("crop_type") == "x", 7))
    assert wh.orphan_count(keyed, "k", dim, "crop_id").first()["orphans"] == 1


def test_region_with_two_countries_takes_first_name(spark):
    df = spark.createDataFrame([("r", "Z"), ("r", "A")], "region string, country string")
    assert wh.region_members(df).first()["country"] == "A"


# ---- quality ------------------------------------------------------------------------------------------------


def test_validator(spark):
    schema = f"farm_id string, crop_type string, region string, fertilizer_type string, soil_pH double, {Y} double, sowing_date string, harvest_date string, total_days int"
    rows = [
        ("f1", "Wheat", "North India", "Organic", 7.0, 100.0, "2024-01-01", "2024-01-11", 10),
        ("f1", "Rye", "North India", None, None, 100.0, "2024-01-01", "2024-01-01", 5),
        (None, "Wheat", "North India", "Mixed", 20.0, None, "bad", "2024-01-02", 1),
        (None, "Wheat", "North India", "Mixed", 3.0, 1.0, "2024-01-01", "2024-01-02", 1),
    ]
    out = {r["check"]: r for r in quality.validate(spark.createDataFrame(rows, schema), "t").collect()}
    assert out["not_empty"]["passed"] and out["not_empty"]["message"] == "t has 4 rows"
    assert out["no_nulls_farm_id"]["message"] == "2 nulls in farm_id"
    assert out["no_duplicates_farm_id"]["message"] == "2 duplicate farm_id"  # missing ids are equal
    assert not out["valid_values_crop_type"]["passed"] and "Rye" in out["valid_values_crop_type"]["message"]
    assert out["valid_values_region"]["passed"]
    assert not out["valid_values_fertilizer_type"]["passed"]  # a missing label is invalid
    assert out["range_soil_pH"]["message"] == "1 soil_pH values out of range"  # a missing number is not
    assert not out["valid_date_sowing_date"]["passed"] and out["valid_date_harvest_date"]["passed"]
    assert out["harvest_after_sowing"]["message"].startswith("1 ")
    assert out["total_days_consistency"]["message"].startswith("2 ")  # a missing difference is a mismatch
    whole = quality.summary(spark.createDataFrame(list(out.values())), "t").first()
    assert not whole["is_valid"] and whole["validations_passed"] + whole["validations_failed"] == len(out)


def test_warnings_do_not_invalidate(spark):
    rows = [("a", True, "", "error"), ("b", False, "", "warning")]
    df = spark.createDataFrame(rows, "check string, passed boolean, message string, severity string")
    assert quality.summary(df).first()["is_valid"]


def test_empty_source_stops(spark):
    with pytest.raises(quality.EmptySource):
        quality.require_rows(spark.range(0))


# ---- cube ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def facts(spark):
    rows = [("a", "x", 10.0), ("a", "y", 5.0), ("b", "x", 10.0), ("c", None, 5.0), (None, "y", 1.0)]
    return spark.createDataFrame(rows, f"crop string, region string, {Y} double")


def test_cube_labels_all_and_unknown(facts):
    out = {(r["crop"], r["region"]): r["total_yield"] for r in cube.cells(facts, ["total_yield"], ["crop", "region"]).collect()}
    assert out[("All", "All")] == 31 and out[("a", "All")] == 15 and out[("All", "x")] == 20
    assert out[("c", "Unknown")] == 5 and out[("Unknown", "y")] == 1


def test_empty_members_stay(facts, spark):
    members = spark.createDataFrame([("a",), ("z",)], "crop string")
    out = {r["crop"]: r["total_yield"] for r in cube.cube_query(facts, ["total_yield"], ["crop"], {"region": "x"}, members).collect()}
    assert out == {"All": 20.0, "a": 10.0, "b": 10.0, "z": None}


def test_rank_leaves_gaps(facts):
    rows = facts.where("crop IS NOT NULL AND (region = 'x' OR crop = 'c')")
    out = {r["crop"]: r["rank"] for r in cube.ranked(rows, "total_yield", "crop", include_all=False).collect()}
    assert out == {"a": 1, "b": 1, "c": 3}


def test_average_runs_over_all_member(facts):
    out = {r["crop"]: r["m"] for r in cube.average_over(facts, "total_yield", "crop", "region", "m").collect()}
    assert out["a"] == pytest.approx((10 + 5 + 15) / 3)


def test_contrast_counts_missing_side_as_zero(facts):
    out = {r["crop"]: r["d"] for r in cube.contrast(facts, "total_yield", "crop", "region", "x", "y", ("h", "s", "d")).collect()}
    assert out["a"] == 5 and out["b"] == 10 and out["c"] is None and out["All"] == 14


# ---- mining ----------------------------------------------------------------------------------------------------


def test_itemsets_and_rules_match_brute_force(spark):
    rng = np.random.default_rng(3)
    baskets = [[f"{c}={v}" for c, v in zip("abcd", rng.integers(0, 2, 4)) if rng.random() < 0.9] for _ in range(300)]
    df = spark.createDataFrame([(b,) for b in baskets], "items array<string>")
    sets = mining.frequent_itemsets(df, 0.1)
    got = {tuple(r["items"]): r["freq"] for r in sets.collect()}
    items = sorted({i for b in baskets for i in b})
    want = {}
    for k in range(1, 5):
        for combo in itertools.combinations(items, k):
            n = sum(set(combo) <= set(b) for b in baskets)
            if n >= 30:
                want[combo] = n
    assert got == want
    rules = {(tuple(r["antecedents"]), tuple(r["consequents"])): r for r in mining.association_rules(sets, 0.2).collect()}
    expected = {}
    for z, n in want.items():
        for k in range(1, len(z)):
            for a in itertools.combinations(z, k):
                c = tuple(i for i in z if i not in a)
                if n / want[a] >= 0.2:
                    expected[(a, c)] = (n / want[a], n / want[a] / (want[c] / 300))
    assert set(rules) == set(expected) and any(len(c) > 1 for _, c in rules)
    for key, (confidence, lift) in expected.items():
        assert rules[key]["confidence"] == pytest.approx(confidence) and rules[key]["lift"] == pytest.approx(lift)


def test_certain_rule_has_infinite_conviction_and_no_rule_gives_default_line(spark):
    df = spark.createDataFrame([(["a", "b"],)] * 3 + [(["b"],)], "items array<string>")
    rules = mining.association_rules(mining.frequent_itemsets(df, 0.1), 0.9)
    certain = [r for r in rules.collect() if r["antecedents"] == ["a"]]
    assert certain[0]["conviction"] == float("inf")
    assert mining.insights(rules).collect()[0][0].startswith("No significant patterns")


# ---- neighbours ------------------------------------------------------------------------------------------------


def brute_neighbours(q, p, labels, k):
    """(distance, label) of the k nearest rows of each query."""
    out = []
    for x in q:
        dist = np.round(np.sqrt(((p - x) ** 2).sum(axis=1)), 9)
        out.append(sorted(zip(dist, labels))[:k])
    return out


@pytest.mark.parametrize("chunk", [20_000, 40])
def test_neighbours_match_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(neighbours, "CHUNK", chunk)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 30)
    rng = np.random.default_rng(11)
    # many equal rows, a hot spot with a third of all points, and a spread-out rest
    p = np.vstack([np.zeros((200, 3)), rng.integers(0, 4, (200, 3)), rng.normal(0, 5, (200, 3))]).astype(float)
    labels = [str(x) for x in rng.integers(0, 3, len(p))]
    q = np.vstack([p[::17], rng.normal(0, 6, (20, 3)), np.zeros((5, 3))])
    features = ["a", "b", "c"]
    points = spark.createDataFrame([(*map(float, r), s) for r, s in zip(p, labels)], "a double, b double, c double, s string")
    asked = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(q)], "id int, a double, b double, c double")
    found = neighbours.nearest(asked, points, features, 7, "id", "s").toPandas()
    want = brute_neighbours(q, p, labels, 7)
    for i, rows in enumerate(want):
        mine = found[found["id"] == i].sort_values("rank")
        flat = [(d, s) for d, s, t in zip(mine["distance"], mine["label"], mine["taken"]) for _ in range(t)]
        assert flat == pytest.approx(rows) if not flat else [f[1] for f in flat] == [r[1] for r in rows]
        assert [f[0] for f in flat] == pytest.approx([r[0] for r in rows])


def test_exact_match_takes_all_votes(spark):
    found = spark.createDataFrame([(1, 0.0, "b", 1), (1, 0.1, "a", 3), (2, 1.0, "a", 1), (2, 2.0, "b", 2)], "id int, distance double, label string, taken bigint")
    votes = {(r["id"], r["label"]): r["probability"] for r in models.class_votes(found, "id").collect()}
    assert votes[(1, "b")] == 1.0 and votes[(1, "a")] == 0.0 and votes[(2, "a")] == pytest.approx(0.5)
    best = {r["id"]: r["predicted"] for r in models.predicted_class(models.class_votes(found, "id"), "id").collect()}
    assert best == {1: "b", 2: "a"}  # a tie goes to the first label


def test_k_selection_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 6, (120, 2)).astype(float)
    y = [("a" if v[0] + rng.normal(0, 1) > 2.5 else "b") for v in x]
    rows = spark.createDataFrame([(str(i), *map(float, v), s) for i, (v, s) in enumerate(zip(x, y))], "id string, p double, q double, s string")
    got = {r["k"]: r["accuracy"] for r in models.k_selection(rows, ["p", "q"], "id", "s", max_k=4, folds=3).collect()}
    u = models.hash_fraction(["id"], models.SEED + 1)
    fold = np.array([r[0] for r in rows.select(F.floor(u * 3).cast("int")).collect()])
    for k in range(1, 5):
        scores = []
        for f in range(3):
            inside, outside = np.where(fold == f)[0], np.where(fold != f)[0]
            near = brute_neighbours(x[inside], x[outside], [y[i] for i in outside], k)
            guess = [min(set(s for _, s in n), key=lambda c: (-sum(s == c for _, s in n), c)) for n in near]
            scores.append(np.mean([g == y[i] for g, i in zip(guess, inside)]))
        assert got[k] == pytest.approx(np.mean(scores))


def test_similarity_needs_three_features(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0)], "t string, soil_pH double, rainfall_mm double")
    assert models.similar_farms(df.withColumnRenamed("t", "q"), df, "q", "t") is None


# ---- models --------------------------------------------------------------------------------------------------------


def test_unseen_label_is_all_zeros(spark):
    from pyspark.ml import Pipeline

    train = spark.createDataFrame([(1.0, "a"), (3.0, "b")], "n double, c string")
    fitted = Pipeline(stages=models.preprocessor(["n"], ["c"])).fit(train)
    out = fitted.transform(spark.createDataFrame([(2.0, "new"), (2.0, "b")], "n double, c string")).collect()
    assert list(out[0]["features"].toArray()) == [0.0, 0.0, 0.0] and list(out[1]["features"].toArray()) == [0.0, 0.0, 1.0]


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(1000).withColumn("id", F.col("id").cast("string"))
    one = {r["id"] for r in models.split(df.repartition(1), ["id"])[0].collect()}
    many = {r["id"] for r in models.split(df.repartition(13), ["id"])[0].collect()}
    assert one == many and 760 < len(one) < 840


def test_stratified_split_is_exact_per_class(spark):
    df = spark.range(700).select(F.col("id").cast("string").alias("id"), F.when(F.col("id") < 600, "big").otherwise("small").alias("c"))
    out = {(r["c"], r["in_train"]): r["count"] for r in models.stratified_split(df, "c", ["id"]).groupBy("c", "in_train").count().collect()}
    assert out == {("big", True): 480, ("big", False): 120, ("small", True): 80, ("small", False): 20}


def test_classification_report(spark):
    rows = [("a", "a")] * 3 + [("a", "b")] + [("b", "b")] * 2 + [("c", "a")]
    out = {r["label"]: r for r in models.classification_report(spark.createDataFrame(rows, "actual string, predicted string")).collect()}
    assert out["a"]["precision"] == pytest.approx(0.75) and out["a"]["recall"] == pytest.approx(0.75)
    assert out["c"]["precision"] == 0 and out["c"]["f1"] == 0 and out["c"]["support"] == 1
    assert out["accuracy"]["f1"] == pytest.approx(5 / 7) and out["weighted avg"]["recall"] == pytest.approx(5 / 7)


def test_cascade_names_its_source(spark):
    schema = "crop_type string, soil_moisture_pct double, soil_pH double, crop_disease_status string, irrigation_type string"
    df = spark.createDataFrame([("Wheat", 50.0, 6.5, "No Disease", "Drip"), ("Wheat", None, 6.5, "Mild", "Drip")], schema)
    out = models.score_cascade(df, spark.createDataFrame([(1234.0,)], "m double")).collect()
    assert [r["model_used"] for r in out] == ["Rule-Based Fallback", "Average Yield"]
    assert out[1]["prediction"] == 1234.0 and [r["confidence"] for r in out] == [0.65, 0.5]


def test_training_and_saved_pipeline(spark):
    from pyspark.ml import PipelineModel
    from pyspark.ml.regression import GBTRegressor, LinearRegression

    rows = [(float(i % 7), "a" if i % 2 else "b", 3.0 * (i % 7) + (5 if i % 2 else 0)) for i in range(80)]
    df = spark.createDataFrame(rows, f"soil_pH double, crop_type string, {Y} double")
    numeric, labels = models.feature_lists(df)
    fitted = models.train(df, numeric, labels, {
        "Linear Regression": LinearRegression(labelCol=Y), "Gradient Boosting": GBTRegressor(labelCol=Y, maxIter=3, seed=1),
    })
    table = models.compare(fitted, df)
    assert models.best_model(table).first()["Model"] == "Linear Regression"
    assert models.feature_importance(fitted["Linear Regression"], df, numeric, labels) is None
    importance = models.feature_importance(fitted["Gradient Boosting"], df, numeric, labels).collect()
    assert {r["feature"] for r in importance} == {"soil_pH", "crop_type_a", "crop_type_b"}
    path = fresh_path(spark, "test-model")
    fitted["Linear Regression"].write().overwrite().save(path)
    back = PipelineModel.load(path).transform(df).agg(F.max(F.abs(F.col("prediction") - F.col(Y)))).first()[0]
    assert back < 1e-3


# ---- clusters ------------------------------------------------------------------------------------------------------


def test_clusters_are_numbered_by_yield(spark):
    rows = [(f"f{i}", "c1" if i % 2 else "c2", 100.0 + i % 3, 1.0) for i in range(30)] + [(f"g{i}", "c3", 900.0 + i % 3, 9.0) for i in range(20)]
    df = spark.createDataFrame(rows, f"farm_id string, crop_type string, {Y} double, water_efficiency double")
    ready = clustering.prepared(df)
    selection = clustering.k_selection(ready, 2, 3)
    assert clustering.best_k(selection) == 2 and selection[0][1] >= selection[1][1]
    out = clustering.assigned(ready, 2)
    sizes = {r["cluster"]: (r["n"], r["label"]) for r in clustering.labelled(clustering.sizes(out)).collect()}
    assert sizes == {0: (20, "High Performers"), 1: (30, "Underperformers")}
    tops = {r["cluster"]: r["top_crops"] for r in clustering.summary(out).collect()}
    assert tops == {0: "c3", 1: "c1, c2"}
    profile = clustering.normalised_profile(clustering.centres(out)).collect()
    assert all(r[Y] == 1.0 and r["water_efficiency"] == 0.0 for r in profile)


def test_joint_steps_are_those_of_the_engine(spark):
    import numpy as np
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.evaluation import ClusteringEvaluator

    rows = [(f"f{i}", float(i * 37 % 101), float(i * i % 53), i % 7 / 3) for i in range(300)]
    ready = clustering.prepared(spark.createDataFrame(rows, f"farm_id string, {Y} double, soil_pH double, NDVI_index double")).persist()
    fits = clustering.fitted(ready, 2, 4)
    for k, inertia, silhouette in clustering.k_selection(ready, models=fits):
        model = KMeans(k=k, seed=42, featuresCol="features").fit(ready.select("features"))
        assert np.allclose(model.clusterCenters(), fits[k])
        assert silhouette == pytest.approx(ClusteringEvaluator().evaluate(model.transform(ready)))
        assert clustering.misplaced(ready, k, fits[k]).first().asDict() == {"n": 300, "unassigned": 0, "not_nearest": 0}
        assert 0 < inertia <= model.summary.trainingCost + 1e-6
    ready.unpersist()


def test_one_pass_serves_every_k(spark, monkeypatch):
    ready = clustering.prepared(spark.createDataFrame([(f"f{i}", float(i * 37 % 101), float(i * i % 53)) for i in range(200)], f"farm_id string, {Y} double, soil_pH double"))
    passes, added = [], clustering._added
    monkeypatch.setattr(clustering, "_added", lambda cells, measure, shapes: passes.append(len(shapes)) or added(cells, measure, shapes))
    clustering.best_assigned(ready)
    assert len(passes) <= clustering.STEPS + 2 and passes[0] == passes[-1] == 7


def test_vectors_travel_in_blocks(spark):
    import numpy as np

    rows = [(f"f{i}", float(i * 37 % 101), float(i * i % 53)) for i in range(200)]
    ready = clustering.prepared(spark.createDataFrame(rows, f"farm_id string, {Y} double, soil_pH double").coalesce(1))
    cells = clustering._cells(ready)
    assert cells.count() == -(-200 // clustering.BLOCK)
    sums = clustering._added(cells, lambda x: {1: np.r_[len(x), (x * x).sum(0)]}, {1: 3})
    assert np.allclose(sums[1], [200, 200, 200])


def test_one_pass_judges_every_inertia(spark, monkeypatch):
    ready = clustering.prepared(spark.createDataFrame([(f"f{i}", float(i * 37 % 101), float(i * i % 53)) for i in range(200)], f"farm_id string, {Y} double, soil_pH double"))
    monkeypatch.setattr(clustering, "_placed", lambda *_: pytest.fail("the rows are placed once for each k"))
    gaps = {r["k"]: r["gap"] for r in clustering.inertia_gap(ready).collect()}
    assert sorted(gaps) == list(range(2, 9)) and all(abs(g) < 1e-9 for g in gaps.values())


# ---- allocation -----------------------------------------------------------------------------------------------------


def coefficients(spark, budget):
    rows = [("a", 5.0, 0.0, 10.0, 50.0, budget), ("b", 2.0, 0.0, 10.0, 50.0, budget), ("c", -1.0, 0.0, 10.0, 50.0, budget)]
    return spark.createDataFrame(rows, "crop_type string, slope double, intercept double, min_water double, max_water double, budget double")


def test_allocation(spark):
    out = allocate.allocate(coefficients(spark, 75.0), "budget")
    assert {r["crop_type"]: r["water"] for r in out.collect()} == {"a": 50.0, "b": 15.0, "c": 10.0}
    total = allocate.totals(out, "budget").first()
    assert total["total_water_used"] == 75 and total["water_saved"] == 0 and total["status"] == "Optimal"
    rich = allocate.allocate(coefficients(spark, 1000.0), "budget").agg(F.sum("water")).first()[0]
    assert rich == 110


def test_infeasible_allocation(spark):
    out = allocate.allocate(coefficients(spark, 20.0), "budget").collect()
    assert {r["status"] for r in out} == {"Infeasible"} and all(r["water"] is None for r in out)


def test_allocation_cannot_be_improved(spark):
    rng = np.random.default_rng(9)
    rows = []
    for s in range(20):
        for c in range(6):
            low = float(rng.uniform(0, 50))
            rows.append((s, f"c{c}", float(rng.normal(0, 3)), 1.0, low, low + float(rng.uniform(0, 80)), 300.0))
    df = spark.createDataFrame(rows, "s int, crop_type string, slope double, intercept double, min_water double, max_water double, budget double")
    pdf = allocate.allocate(df, "budget", scenario=["s"]).toPandas()
    for _, g in pdf[pdf["status"] == "Optimal"].groupby("s"):
        assert (g["water"] >= g["min_water"] - 1e-9).all() and (g["water"] <= g["max_water"] + 1e-9).all()
        assert g["water"].sum() <= 300 + 1e-6
        spare = 300 - g["water"].sum()
        for (_, a), (_, b) in itertools.permutations(g.iterrows(), 2):
            # no crop below its maximum may gain from spare water or from a flatter crop
            if a["slope"] > 0 and a["water"] < a["max_water"] - 1e-9:
                assert spare < 1e-6 and not (b["slope"] < a["slope"] and b["water"] > b["min_water"] + 1e-9)


# ---- files -------------------------------------------------------------------------------------------------------------


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert shared_folder(spark) == named.rstrip("/") if named else "tillage-shared" in shared_folder(spark)


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        @staticmethod
        def get(key, default=None):
            return default

    class Context:
        master = "spark://somewhere:7077"

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(RuntimeError):
        shared_folder(Session)
    Context.master = "local[2]"
    assert shared_folder(Session).endswith("tillage-shared")


def test_product_prices_keep_commas_and_quotes(spark, tmp_path):
    header = ",".join(n for n, _ in files.PRODUCT_FILE)
    lines = [header, 'Apples,Fresh,1.86,per pound,0.9,0.2425,pounds,0.5,Fruit', '"Apples, ""ready"" to drink",Juice,0.95,per pint,1.0,0.5,pints,0.47,Fruit']
    path = tmp_path / "fruit.csv"
    path.write_text("\n".join(lines) + "\n")
    rows = files.read_product_prices(spark, str(path)).collect()
    assert [r["Product"] for r in rows] == ["Apples", 'Apples, "ready" to drink'] and rows[1]["AverageRetailPrice"] == 0.95


def test_lenient_commodities(spark, tmp_path):
    path = tmp_path / "c.csv"
    path.write_text("Date,CORN,GOLD\n2024-01-01,1.5,9\nnever,2.5,9\n")
    rows = files.read_commodities(spark, str(path), ["Date", "CORN", "GOLD"], lenient=True).collect()
    assert rows[1]["date"] is None and rows[1]["CORN"] == 2.5 and rows[0].asDict().keys() == {"date", "CORN"}
    absent = files.read_commodities(spark, str(tmp_path / "no.csv"), ["Date", "CORN"], lenient=True)
    assert absent.count() == 0 and absent.columns == ["date", "CORN"]
    with pytest.raises(Exception):
        files.read_commodities(spark, str(tmp_path / "no.csv"), ["Date", "CORN"]).count()


def test_audit_appends(spark):
    path = fresh_path(spark, "audit-test")
    for n in (1, 2):
        files.append_audit(spark, path, status="SUCCESS", rows_processed=n)
    assert sorted(r["rows_processed"] for r in spark.read.json(path).collect()) == [1, 2]


def test_pandas_agrees_on_quote_all(spark):
    df = spark.createDataFrame([("a,b", 1.5, None)], "s string, x double, n string")
    path = files.write_csv(df.coalesce(1), fresh_path(spark, "quoted"), quote_all=True)
    part = next(os.path.join(path, f) for f in os.listdir(path) if f.endswith(".csv"))
    with open(part) as f:
        assert f.read().splitlines()[1].startswith('"a,b","1.5"')
    assert pd.read_csv(part).loc[0, "s"] == "a,b"


def test_large_tables_are_not_dealt_out_again(spark):
    from tillage.session import materialize

    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(4 * cores))
    try:
        assert materialize(spark.range(100 * cores).repartition(cores), "spread", spread=True).rdd.getNumPartitions() == cores
        assert materialize(spark.range(100).coalesce(1), "spread", spread=True).rdd.getNumPartitions() == 4 * cores
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_least_squares_keeps_no_rows_and_leaves_nothing(spark, monkeypatch):
    from pyspark.ml.regression import LinearRegression

    rows = [(float(i % 17), "ab"[i % 2] if i % 9 else None, "xyz"[i % 3], float(i * 31 % 23)) for i in range(120)]
    df = spark.createDataFrame(rows, f"soil_pH double, crop_type string, region string, {Y} double").fillna("?", ["crop_type"])
    monkeypatch.setattr(type(df), "persist", lambda *_: pytest.fail("the rows are read once"))
    numeric, labels = ["soil_pH"], ["crop_type", "region"]
    model = models.train(df, numeric, labels, {"Linear Regression": LinearRegression(labelCol=Y, featuresCol="features")})["Linear Regression"]
    scored = model.transform(df)
    left = {(r["feature"], r["value"]): r["rest"] for r in models.normal_equations(scored, numeric, labels).collect()}
    assert len(left) == 7 and all(abs(v) < 1e-6 for v in left.values())
    # a wrong prediction leaves the mean error of each label
    off = scored.withColumn("prediction", F.lit(0.0))
    left = {(r["feature"], r["value"]): r["rest"] for r in models.normal_equations(off, numeric, labels).collect()}
    y = [r[3] for r in rows]
    spread = (sum(v * v for v in y) / len(y) - (sum(y) / len(y)) ** 2) ** 0.5
    mine = [r[3] for r in rows if r[2] == "y"]
    assert left["region", "y"] == pytest.approx(sum(mine) / len(mine) / spread)


def test_disease_features_join_once(spark, sf_dir, monkeypatch):
    from tillage.plans import models as plans

    names, made = [], plans.materialize
    monkeypatch.setattr(plans, "materialize", lambda df, name, **more: names.append(name) or made(df, name, **more))
    import __spark_entry__

    assert __spark_entry__.queries()["l14_disease_features"](spark, sf_dir).count() > 0
    assert names == ["disease-rows"]


# ---- loads that read their rows in turn ----------------------------------------------------------------------------------


def test_complete_columns_need_no_statistic(spark, monkeypatch):
    rows = [(f"f{i}", "a" if i % 3 else None, float(i) if i % 4 else None, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "farm_id string, irrigation_type string, temperature_C double, rainfall_mm double")
    seen, long = [], cleaning.long_form
    monkeypatch.setattr(cleaning, "long_form", lambda d, columns, *a, **b: seen.append(columns) or long(d, columns, *a, **b))
    got = {r["farm_id"]: (r["irrigation_type"], r["temperature_C"], r["rainfall_mm"]) for r in cleaning.fill_lenient(df).collect()}
    assert seen == [["temperature_C"], ["irrigation_type"]]
    assert got["f0"] == ("a", 6.0, 0.0) and got["f5"] == ("a", 5.0, 5.0) and len(got) == 12


def test_typed_load_joins_its_rows_once(spark, sf_dir, monkeypatch):
    import __spark_entry__
    from tillage.plans import warehouse as plans

    made, priced = [], plans.priced_farm
    monkeypatch.setattr(plans, "priced_farm", lambda *a, **b: made.append(a) or priced(*a, **b))
    rows = {r["target"]: r["n"] for r in __spark_entry__.queries()["e05_typed_load"](spark, sf_dir).collect()}
    assert len(made) == 1 and sum(rows.values()) == spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
