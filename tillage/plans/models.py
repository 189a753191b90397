"""Models, clusters and allocation."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tillage.functions import agronomy as ag
from tillage.operators import allocate, clustering, models, stats
from tillage.operators import profile as pr
from tillage.plans.profiles import RULE_INPUTS, RULE_SQL
from tillage.plans.registry import Y, query
from tillage.plans.rows import GAP_SQL, with_gaps
from tillage.plans.statistics import WATER_SQL, histogram_sql
from tillage.session import fresh_path, materialize, task_count
from tillage.sources import files
from tillage.sources.binding import farm, farm_sql, table

_NUMERIC = models.NUMERIC_BASE + models.NUMERIC_EXTENDED
_LABELS = models.CATEGORICAL + models.SEASONAL
_KEY = ["farm_id", "sensor_id"]
# columns that a fitted pipeline adds
_MADE = ["__num", "__scaled", "features", *[f"__ix_{c}" for c in _LABELS], *models.categorical_vectors(_LABELS)]


def _u(columns, seed=models.SEED):
    text = ", ".join(f"CAST({c} AS VARCHAR)" for c in columns)
    return f"CAST(CAST('0x' || substr(md5(concat_ws('|', '{seed}', {text})), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656.0::DOUBLE"


# ---- features and splits -----------------------------------------------------------------------------


@query("l01_feature_selection", farm_sql(" UNION ALL ".join(
    f"""SELECT '{c}' AS feature, '{k}' AS kind, count("{c}") AS n FROM farm"""
    for k, cs in (("numeric", _NUMERIC), ("categorical", _LABELS)) for c in cs)))
def _(spark, d):
    df = farm(spark, d, Y, *_NUMERIC, *_LABELS)
    numeric, labels = models.feature_lists(df)
    counts = df.agg(*[F.count(c).alias(c) for c in [*numeric, *labels]])
    kind = F.when(F.col("feature").isin(labels), "categorical").otherwise("numeric")
    return counts.unpivot([], [*numeric, *labels], "feature", "n").withColumn("kind", kind)


@query("l02_preprocessing", farm_sql(
    """SELECT farm_id, round(("temperature_C" - m1) / s1, 6) AS temperature_scaled, round((rainfall_mm - m2) / s2, 6) AS rainfall_scaled,
    CAST(crop_type = 'ECONOMY' AS INT)::DOUBLE AS crop_first, CAST(crop_type = 'LARGE' AS INT)::DOUBLE AS crop_second FROM farm,
    (SELECT avg("temperature_C") AS m1, stddev_samp("temperature_C") AS s1, avg(rainfall_mm) AS m2, stddev_samp(rainfall_mm) AS s2 FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "temperature_C", "rainfall_mm", "crop_type")
    fitted = Pipeline(stages=models.preprocessor(["temperature_C", "rainfall_mm"], ["crop_type"])).fit(df)
    v = vector_to_array("features")
    named = {"temperature_scaled": v[0], "rainfall_scaled": v[1], "crop_first": v[2], "crop_second": v[3]}
    return pr.rounded(fitted.transform(df).select("farm_id", *[e.alias(n) for n, e in named.items()]), 6)


@query("l03_split", farm_sql(
    f"""SELECT u < 0.8::DOUBLE AS in_train, count(*) AS n, round(avg({Y}), 4) AS mean FROM (SELECT {_u(_KEY)} AS u, {Y} FROM farm) GROUP BY in_train"""))
def _(spark, d):
    train, test = models.split(farm(spark, d, *_KEY, Y), _KEY)
    rows = train.withColumn("in_train", F.lit(True)).unionByName(test.withColumn("in_train", F.lit(False)))
    return pr.rounded(rows.groupBy("in_train").agg(F.count("*").alias("n"), F.avg(Y).alias("mean")))


@query("l04_stratified_split", farm_sql(
    f"""SELECT crop_disease_status, u <= cut AS in_train, count(*) AS n FROM (SELECT crop_disease_status, {_u(_KEY)} AS u FROM farm) JOIN (
      SELECT crop_disease_status, max(u) FILTER (rn <= ceil(n * 0.8::DOUBLE)) AS cut FROM (SELECT *, row_number() OVER (PARTITION BY crop_disease_status ORDER BY u) AS rn,
        count(*) OVER (PARTITION BY crop_disease_status) AS n FROM (SELECT crop_disease_status, {_u(_KEY)} AS u FROM farm)) GROUP BY crop_disease_status)
    USING (crop_disease_status) GROUP BY ALL"""))  # fmt: skip
def _(spark, d):
    parts = models.stratified_split(farm(spark, d, *_KEY, "crop_disease_status"), "crop_disease_status", _KEY)
    return pr.distribution(parts, ["crop_disease_status", "in_train"])


# ---- regression -----------------------------------------------------------------------------------------


def _sets(spark, d, exclude_leaky=False):
    df = farm(spark, d, *_KEY, Y, *_NUMERIC, *_LABELS)
    numeric, labels = models.feature_lists(df, exclude_leaky)
    # the hash is written with the rows: every pass of a training reads it instead of making it again
    ready = models.prepared(df.withColumn("__u", models.hash_fraction(_KEY)), numeric, labels)
    return (*models.split(ready, _KEY, drawn="__u"), numeric, labels)


def _trained(spark, d, *names):
    train, test, numeric, labels = _sets(spark, d)
    chosen = {n: m for n, m in models.regressors().items() if n in names}
    return models.train(train, numeric, labels, chosen), test, numeric, labels


for _key, _name in (
    ("l05_linear_regression", "Linear Regression"),
    ("l06_random_forest", "Random Forest"),
    ("l07_gradient_boosting", "Gradient Boosting"),
):

    @query(_key)
    def _(spark, d, name=_name):
        fitted, test, _, _ = _trained(spark, d, name)
        return models.regression_metrics(fitted[name].transform(test), name)


# ---- fitted models, checked by what must hold of them -----------------------------------------------------

_TRAIN_ROWS = f"train_rows AS (SELECT * FROM farm WHERE {_u(_KEY)} < 0.8::DOUBLE)"
_TEST_ROWS = f"test_rows AS (SELECT * FROM farm WHERE {_u(_KEY)} >= 0.8::DOUBLE)"


@query("l05_normal_equations", farm_sql(
    " UNION ALL ".join([f"SELECT '{c}' AS feature, '' AS value, 0.0::DOUBLE AS rest" for c in _NUMERIC]
                       + [f"SELECT DISTINCT '{c}', CAST({c} AS VARCHAR), 0.0::DOUBLE FROM train_rows" for c in _LABELS]), _TRAIN_ROWS))
def _(spark, d):
    train, _, numeric, labels = _sets(spark, d)
    fitted = models.train(train, numeric, labels, {"Linear Regression": models.regressors()["Linear Regression"]})["Linear Regression"]
    left = models.normal_equations(fitted.transform(train), numeric, labels)
    return left.withColumn("rest", F.abs(F.round("rest", 3)))


@query("l09_importance_shares", farm_sql(
    "SELECT (" + " + ".join([f"count(DISTINCT {c})" for c in _LABELS]) + f" + {len(_NUMERIC)})::BIGINT AS features, 1.0::DOUBLE AS total, 0::BIGINT AS negative FROM train_rows", _TRAIN_ROWS))
def _(spark, d):
    fitted, test, numeric, labels = _trained(spark, d, "Gradient Boosting")
    shares = models.feature_importance(fitted["Gradient Boosting"], test, numeric, labels)
    return shares.agg(F.count("*").alias("features"), F.round(F.sum("importance"), 6).alias("total"), F.count_if(F.col("importance") < 0).alias("negative"))


@query("l11_scores_by_hand", farm_sql("SELECT count(*)::BIGINT AS n, 0::BIGINT AS different FROM test_rows", _TEST_ROWS))
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    final = fitted["Linear Regression"].stages[-1]
    weights = F.array(*[F.lit(float(w)) for w in final.coefficients.toArray()])
    by_hand = F.aggregate(F.zip_with(vector_to_array("features"), weights, lambda x, w: x * w), F.lit(float(final.intercept)), lambda a, x: a + x)
    scored = fitted["Linear Regression"].transform(test)
    return scored.agg(F.count("*").alias("n"), F.count_if(F.abs(F.col("prediction") - by_hand) > 1e-6 * F.greatest(F.abs(by_hand), F.lit(1.0))).alias("different"))


@query("l12_model_cascade_counts", farm_sql("SELECT 'ML Model' AS model_used, count(*)::BIGINT AS n FROM test_rows", _TEST_ROWS))
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    fresh = models.with_model_inputs(test.drop("heat_stress", "drought_stress", "growing_conditions_score"))
    out = models.score_cascade(fresh, test.agg(F.avg(Y)), fitted["Linear Regression"])
    return out.groupBy("model_used").agg(F.count("*").alias("n"))


@query("s18_saved_equals_fitted", farm_sql("SELECT count(*)::BIGINT AS n, 0::BIGINT AS different FROM test_rows", _TEST_ROWS))
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    path = fresh_path(spark, "model")
    fitted["Linear Regression"].write().overwrite().save(path)
    once = fitted["Linear Regression"].transform(test).withColumnRenamed("prediction", "__fitted").drop(*_MADE)
    again = PipelineModel.load(path).transform(once)
    return again.agg(F.count("*").alias("n"), F.count_if(~F.col("prediction").eqNullSafe(F.col("__fitted"))).alias("different"))


@query("l08_regression_metrics", farm_sql(
    f"""SELECT 'Rule Score' AS "Model", round(1 - sse / sst, 3) AS "R2", round(sqrt(sse / n), 3) AS "RMSE", round(sae / n, 3) AS "MAE" FROM (
    SELECT sum(power({Y} - p, 2)) AS sse, sum(abs({Y} - p)) AS sae, count(*) AS n, var_pop({Y}) * count(*) AS sst FROM (SELECT {Y}, {RULE_SQL} AS p FROM farm))"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, Y, *RULE_INPUTS).withColumn("prediction", ag.rule_score())
    return models.regression_metrics(df, "Rule Score")


@query("l08_best_model")
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression", "Random Forest", "Gradient Boosting")
    return models.best_model(models.compare(fitted, test))


@query("l09_feature_importance")
def _(spark, d):
    fitted, test, numeric, labels = _trained(spark, d, "Gradient Boosting")
    return pr.rounded(models.feature_importance(fitted["Gradient Boosting"], test, numeric, labels), 6)


@query("l10_residual_histogram", farm_sql(
    histogram_sql("residual", 30, source="predicted"), f"predicted AS (SELECT {Y} - {RULE_SQL} AS residual FROM farm)"))
def _(spark, d):
    df = farm(spark, d, Y, *RULE_INPUTS).withColumn("prediction", ag.rule_score())
    return pr.rounded(stats.histogram(models.residuals(df), "residual", 30))


@query("l11_batch_scoring")
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    scored = fitted["Linear Regression"].transform(test).withColumn("confidence", F.lit(0.85))
    return pr.rounded(scored.select("farm_id", "prediction", "confidence"), 3)


@query("l12_scoring_cascade", farm_sql(
    f"""SELECT farm_id, round(coalesce(CASE WHEN soil_moisture_pct IS NOT NULL THEN {RULE_SQL} END, (SELECT avg({Y}) FROM farm)), 4) AS prediction,
    CASE WHEN soil_moisture_pct IS NOT NULL THEN 0.65::DOUBLE ELSE 0.5::DOUBLE END AS confidence,
    CASE WHEN soil_moisture_pct IS NOT NULL THEN 'Rule-Based Fallback' ELSE 'Average Yield' END AS model_used
    FROM (SELECT * REPLACE (CASE WHEN soil_moisture_pct < 75 THEN soil_moisture_pct END AS soil_moisture_pct) FROM farm)"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", *RULE_INPUTS)
    df = df.withColumn("soil_moisture_pct", F.when(F.col("soil_moisture_pct") < 75, F.col("soil_moisture_pct")))
    out = models.score_cascade(df, farm(spark, d, Y).agg(F.avg(Y)))
    return pr.rounded(out.select("farm_id", "prediction", "confidence", "model_used"))


@query("l12_model_cascade")
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    fresh = models.with_model_inputs(test.drop("heat_stress", "drought_stress", "growing_conditions_score"))
    out = models.score_cascade(fresh, test.agg(F.avg(Y)), fitted["Linear Regression"])
    return pr.rounded(out.groupBy("model_used").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean")), 2)


_STEPS = ", ".join(f"({s}::DOUBLE)" for s in models.STEPS)


@query("l13_sensitivity", farm_sql(
    f"""SELECT parameter, variation, count(*) AS n, round(avg({RULE_SQL.replace('soil_moisture_pct', 'm')}), 4) AS mean_prediction FROM (
    SELECT f.*, p.parameter, v.variation, CASE WHEN p.parameter = 'soil_moisture_pct' THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, soil_moisture_pct * (1 + v.variation)))
      ELSE soil_moisture_pct END AS m FROM farm f, (VALUES ('soil_moisture_pct'), ('temperature_C'), ('rainfall_mm'), ('NDVI_index')) p(parameter), (VALUES {_STEPS}) v(variation))
    GROUP BY parameter, variation"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, *RULE_INPUTS, "temperature_C", "rainfall_mm", "NDVI_index")
    scored = models.sensitivity_inputs(df).withColumn("prediction", ag.rule_score())
    out = scored.groupBy("parameter", "variation").agg(F.count("*").alias("n"), F.avg("prediction").alias("mean_prediction"))
    return pr.rounded(out)


# ---- classification -----------------------------------------------------------------------------------


@query("l14_disease_features", farm_sql(
    """SELECT label, code, count(*) AS n, round(avg(t), 4) AS temperature FROM (SELECT crop_disease_status AS label,
      CAST(dense_rank() OVER (ORDER BY crop_disease_status) - 1 AS DOUBLE) AS code, coalesce(g, (SELECT quantile_cont("temperature_C", 0.5) FROM gaps)) AS t
      FROM (SELECT crop_disease_status, CASE WHEN pesticide_usage_ml > 5 THEN "temperature_C" END AS g FROM farm)) GROUP BY label, code""", GAP_SQL))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "crop_disease_status", "pesticide_usage_ml", *models.DISEASE_FEATURES)
    df = df.withColumn("temperature_C", F.when(F.col("pesticide_usage_ml") > 5, F.col("temperature_C"))).drop("pesticide_usage_ml")
    # gaps, median, labels and the table read the rows in turn; written once, the joins behind them run a single time
    rows = models.disease_rows(materialize(df, "disease-rows"), "farm_id")
    indexer = StringIndexer(inputCol="crop_disease_status", outputCol="code", stringOrderType="alphabetAsc").fit(rows)
    out = indexer.transform(rows).groupBy(F.col("crop_disease_status").alias("label"), "code")
    return pr.rounded(out.agg(F.count("*").alias("n"), F.avg("temperature_C").alias("temperature")))


def _disease_sets(spark, d):
    """Train and test rows under a key that stands for the row's own values."""
    df = farm(spark, d, *_KEY, "crop_disease_status", *models.DISEASE_FEATURES)
    key = F.md5(F.concat_ws("|", *_KEY, *[F.col(c).cast("string") for c in models.DISEASE_FEATURES]))
    parts = models.stratified_split(df, "crop_disease_status", _KEY).withColumn("row_key", key)
    rows = models.disease_rows(materialize(parts, "disease", spread=True), "row_key")
    return rows.where("in_train"), rows.where("NOT in_train")


def _knn(spark, d, k=5):
    train, test = _disease_sets(spark, d)
    return models.knn_probabilities(train, test, models.DISEASE_FEATURES, "row_key", "crop_disease_status", k), test


@query("l15_knn_classifier")
def _(spark, d):
    votes, test = _knn(spark, d)
    out = models.predicted_class(votes, "row_key").join(test, "row_key")
    return models.classification_report(out, "crop_disease_status", "predicted")


@query("l16_k_selection")
def _(spark, d):
    train, _ = _disease_sets(spark, d)
    return pr.rounded(models.k_selection(train, models.DISEASE_FEATURES, "row_key", "crop_disease_status"), 6)


# the same classifier over the vectors of the embeddings table, where SQL can compare every pair
_V = [f"f{i}" for i in range(7)]
_VECTOR_SQL = [
    "v AS (SELECT vec_id, CAST(label AS VARCHAR) AS label, " + ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS {f}" for i, f in enumerate(_V)) + " FROM embeddings WHERE embedding IS NOT NULL AND label IS NOT NULL)",
    "s AS (SELECT " + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS s_{f}" for f in _V) + " FROM v WHERE vec_id % 5 <> 0)",
    "near AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS rk FROM (SELECT q.vec_id, q.label AS actual, p.label, round(sqrt("
    + " + ".join(f"power((q.{f} - p.{f}) / s_{f}, 2)" for f in _V) + "), 9) AS d FROM v q, v p, s WHERE q.vec_id % 5 = 0 AND p.vec_id % 5 <> 0))",
    "votes AS (SELECT vec_id, actual, label, CASE WHEN min(d) OVER (PARTITION BY vec_id) = 0 THEN CAST(d = 0 AS INT)::DOUBLE ELSE 1 / d END AS w FROM near WHERE rk <= 5)",
    "shares AS (SELECT vec_id, actual, label, sum(w) / sum(sum(w)) OVER (PARTITION BY vec_id) AS probability FROM votes GROUP BY vec_id, actual, label)",
]


def _with(body, *ctes):
    return "WITH " + ", ".join(ctes) + "\n" + body


def _vectors(spark, d):
    rows = table(spark, d, "embeddings").where("embedding IS NOT NULL AND label IS NOT NULL")
    return rows.select("vec_id", F.col("label").cast("string").alias("label"), *[F.get("embedding", F.lit(i)).cast("double").alias(f) for i, f in enumerate(_V)])


def _vector_votes(spark, d):
    rows = materialize(_vectors(spark, d), "vectors", spread=True)
    test = rows.where("vec_id % 5 = 0")
    return models.knn_probabilities(rows.where("vec_id % 5 <> 0"), test, _V, "vec_id", "label", 5), test


@query("l15_knn_of_vectors", _with(
    """SELECT actual, predicted, count(*) AS n FROM (SELECT vec_id, actual, label AS predicted, row_number() OVER (PARTITION BY vec_id ORDER BY round(probability, 12) DESC, label) AS k FROM shares)
    WHERE k = 1 GROUP BY actual, predicted""", *_VECTOR_SQL))  # fmt: skip
def _(spark, d):
    votes, test = _vector_votes(spark, d)
    out = models.predicted_class(votes, "vec_id").join(test.select("vec_id", F.col("label").alias("actual")), "vec_id")
    return models.confusion(out)


@query("l19_vector_probabilities", _with("SELECT vec_id, label, round(probability, 6) AS probability FROM shares WHERE probability > 0", *_VECTOR_SQL))
def _(spark, d):
    votes, _ = _vector_votes(spark, d)
    return votes.where("probability > 0").select("vec_id", "label", F.round("probability", 6).alias("probability"))


@query("l16_k_selection_of_vectors", _with(
    """SELECT k, round(avg(accuracy), 6) AS accuracy FROM (SELECT k, fold, avg(CASE WHEN predicted = actual THEN 1.0::DOUBLE ELSE 0 END) AS accuracy FROM (
      SELECT *, row_number() OVER (PARTITION BY vec_id, k ORDER BY n DESC, predicted) AS place FROM (
        SELECT k, vec_id, fold, actual, label AS predicted, count(*) AS n FROM close, range(1, 21) t(k) WHERE rk <= k GROUP BY ALL)) WHERE place = 1 GROUP BY k, fold) GROUP BY k""",
    _VECTOR_SQL[0], f"folded AS (SELECT *, floor({_u(['vec_id'], models.SEED + 1)} * 5) AS fold FROM v)",
    "close AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY d, label) AS rk FROM (SELECT q.vec_id, q.fold, q.label AS actual, p.label, round(sqrt("
    + " + ".join(f"power(q.{f} - p.{f}, 2)" for f in _V) + "), 9) AS d FROM folded q, folded p WHERE q.fold <> p.fold))"))
def _(spark, d):
    out = models.k_selection(materialize(_vectors(spark, d), "vectors", spread=True), _V, "vec_id", "label")
    return out.select(F.col("k").cast("bigint").alias("k"), F.round("accuracy", 6).alias("accuracy"))


_ACTUAL = "CASE crop_disease_status WHEN 'No Disease' THEN 'Low' WHEN 'Mild' THEN 'Medium' ELSE 'High' END"
_JUDGED_SQL = f"""judged AS (SELECT {_ACTUAL} AS actual, CASE WHEN humidity_pct > 70 OR "temperature_C" > 28 THEN 'Medium' ELSE 'Low' END AS predicted FROM farm)"""


def _judged(spark, d):
    df = farm(spark, d, "crop_disease_status", "humidity_pct", "temperature_C")
    status = F.col("crop_disease_status")
    actual = F.when(status == "No Disease", "Low").when(status == "Mild", "Medium").otherwise("High")
    return df.select(actual.alias("actual"), ag.synthetic_risk().alias("predicted"))


@query("l17_classification_report", farm_sql(
    """SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores
    UNION ALL SELECT 'accuracy', round(a, 6), round(a, 6), round(a, 6), n FROM (SELECT avg(CASE WHEN actual = predicted THEN 1.0::DOUBLE ELSE 0 END) AS a, count(*) AS n FROM judged)
    UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM scores
    UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
      round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores""",
    _JUDGED_SQL,
    """scores AS (SELECT label, p AS precision, r AS recall, CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END AS f1, support FROM (
      SELECT label, CASE WHEN claimed > 0 THEN hits::DOUBLE / claimed ELSE 0 END AS p, CASE WHEN support > 0 THEN hits::DOUBLE / support ELSE 0 END AS r, support FROM (
        SELECT l.label, count(*) FILTER (actual = l.label) AS support, count(*) FILTER (predicted = l.label) AS claimed,
        count(*) FILTER (actual = l.label AND predicted = l.label) AS hits FROM judged, (SELECT DISTINCT actual AS label FROM judged) l GROUP BY l.label)))"""))  # fmt: skip
def _(spark, d):
    return pr.rounded(models.classification_report(_judged(spark, d)), 6)


@query("l18_confusion_matrix", farm_sql("SELECT actual, predicted, count(*) AS n FROM judged GROUP BY ALL", _JUDGED_SQL))
def _(spark, d):
    return models.confusion(_judged(spark, d))


@query("l19_knn_probabilities")
def _(spark, d):
    votes, _ = _knn(spark, d)
    rounded = votes.withColumn("probability", F.round("probability", 6))
    return models.probability_maps(rounded, "row_key").select("row_key", F.to_json("probabilities").alias("probabilities"))


@query("l20_class_distribution", farm_sql("SELECT crop_disease_status, count(*) AS n FROM farm GROUP BY crop_disease_status"))
def _(spark, d):
    return pr.distribution(farm(spark, d, "crop_disease_status"), ["crop_disease_status"])


# ---- similarity ------------------------------------------------------------------------------------------

_SIM = models.SIMILARITY_FEATURES
_TAG = "concat_ws('/', farm_id, sensor_id, CAST(round(yield_kg_per_hectare * 100) AS BIGINT))"
_Z = " + ".join(f'power((q."{f}" - p."{f}") / s."{f}", 2)' for f in _SIM)


def _similar_sql(by: str) -> str:
    return farm_sql(
        f"""SELECT {by}, tag, CAST(rank AS BIGINT) AS rank, round(distance, 4) AS distance, round(coalesce(1 - distance / nullif(max(distance) OVER (PARTITION BY {by}), 0), 1), 3) AS similarity_score FROM (
          SELECT {by}, tag, distance, row_number() OVER (PARTITION BY {by} ORDER BY round(distance, 9), tag) AS rank FROM (
            SELECT q.{by}, p.tag, sqrt({_Z}) AS distance FROM asked q, (SELECT *, {_TAG} AS tag FROM farm) p, spread s)) WHERE rank <= 5""",
        "spread AS (SELECT " + ", ".join(f'stddev_pop("{f}") AS "{f}"' for f in _SIM) + " FROM farm)",
        f"asked AS (SELECT {by}, " + ", ".join(f'round(avg("{f}"), 3) AS "{f}"' for f in _SIM) + f" FROM farm GROUP BY {by})",
    )


# query rows against the whole table: the mean farm of each region, and of each crop
for _key, _by in (("l21_similar_farms", "region"), ("j08_query_rows_by_table", "crop_type")):

    @query(_key, _similar_sql(_by))
    def _(spark, d, by=_by):
        df = farm(spark, d, *_KEY, by, Y, *_SIM)
        tag = F.concat_ws("/", "farm_id", "sensor_id", F.round(F.col(Y) * 100).cast("bigint").cast("string"))
        asked = df.groupBy(by).agg(*[F.round(F.avg(f), 3).alias(f) for f in _SIM])
        out = models.similar_farms(asked, df.withColumn("tag", tag), by, "tag")
        return pr.rounded(out.withColumns({"rank": F.col("rank").cast("bigint"), "distance": F.round("distance", 4)}), 4)


# mean farms of the regions, some of them without their temperature, rain and pH
_LACKS = "region < 'NATION_2'"
_GAPS = ("temperature_C", "rainfall_mm", "soil_pH")
_ZG = " + ".join(f'coalesce(power((q."{f}" - p."{f}") / s."{f}", 2), 0)' for f in _SIM)


@query("l21_similar_farm_attributes", farm_sql(
    f"""SELECT region, tag, CAST(rank AS BIGINT) AS rank, round(distance, 4) AS distance, round(coalesce(1 - distance / nullif(max(distance) OVER (PARTITION BY region), 0), 1), 3) AS similarity_score,
    CASE WHEN {_LACKS} THEN {len(_SIM) - len(_GAPS)} ELSE {len(_SIM)} END::BIGINT AS features_used, r AS farm_region, c AS farm_crop_type, y AS farm_{Y}, m AS farm_soil_moisture_pct, h AS "farm_soil_pH" FROM (
      SELECT *, row_number() OVER (PARTITION BY region ORDER BY round(distance, 9), tag) AS rank FROM (
        SELECT q.region, p.tag, sqrt({_ZG}) AS distance, p.region AS r, p.crop_type AS c, round(p.{Y}, 2) AS y, round(p.soil_moisture_pct, 4) AS m, round(p."soil_pH", 4) AS h
        FROM asked q, (SELECT *, {_TAG} AS tag FROM farm) p, spread s)) WHERE rank <= 5""",
    "spread AS (SELECT " + ", ".join(f'stddev_pop("{f}") AS "{f}"' for f in _SIM) + " FROM farm)",
    "asked AS (SELECT region, " + ", ".join(f'CASE WHEN {_LACKS} THEN NULL ELSE round(avg("{f}"), 3) END AS "{f}"' if f in _GAPS else f'round(avg("{f}"), 3) AS "{f}"' for f in _SIM) + " FROM farm GROUP BY region)"))
def _(spark, d):
    df = farm(spark, d, *_KEY, "region", "crop_type", Y, *_SIM)
    tag = F.concat_ws("/", "farm_id", "sensor_id", F.round(F.col(Y) * 100).cast("bigint").cast("string"))
    asked = df.groupBy("region").agg(*[F.round(F.avg(f), 3).alias(f) for f in _SIM])
    asked = asked.withColumns({f: F.expr(f"CASE WHEN NOT ({_LACKS}) THEN `{f}` END") for f in _GAPS})
    out = models.similar_farms(asked, df.withColumn("tag", tag), "region", "tag", attributes=["region", "crop_type", Y, "soil_moisture_pct", "soil_pH"])
    rounded = {"rank": F.col("rank").cast("bigint"), "distance": F.round("distance", 4), f"farm_{Y}": F.round(f"farm_{Y}", 2)}
    return pr.rounded(out.withColumns(rounded), 4)


_WANTED = {"crop_type": "SMALL", "region": "NATION_9", "soil_moisture_pct": 45.0, "soil_pH": 6.5, "temperature_C": 25.0, "rainfall_mm": 240.0, "NDVI_index": 0.6}
_DIFFS = " ".join(f'- abs("{f}" - {_WANTED[f]}::DOUBLE) / {max(_WANTED[f], 1.0)}::DOUBLE * 0.1::DOUBLE' for f in models.SCORED)


@query("l22_filtered_similarity", farm_sql(
    f"""SELECT farm_id, {Y}, round(greatest(0.1::DOUBLE, least(0.95::DOUBLE, 1.0::DOUBLE {_DIFFS})), 6) AS similarity_score FROM farm
    WHERE crop_type = 'SMALL' AND region = 'NATION_9' ORDER BY similarity_score DESC, farm_id, {Y} LIMIT 10"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", "region", Y, *models.SCORED)
    out = models.filtered_similarity(df, _WANTED, ["farm_id", Y])
    return pr.rounded(out.select("farm_id", Y, "similarity_score"), 6)


@query("l22_similarity_fallback", farm_sql(
    f"""SELECT farm_id, {Y}, 0.5::DOUBLE AS similarity_score FROM farm ORDER BY md5(concat_ws('|', '42', farm_id, CAST({Y} AS VARCHAR))), farm_id, {Y} LIMIT 10"""))
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type", "region", Y, *models.SCORED)
    out = models.filtered_similarity(df, {**_WANTED, "crop_type": "ABSENT"}, ["farm_id", Y])
    return out.select("farm_id", Y, "similarity_score")


@query("l23_aligned_columns", farm_sql(
    """SELECT farm_id, CAST(crop_type = 'SMALL' AS BIGINT) AS crop_small, CAST(0 AS BIGINT) AS crop_unseen, CAST(crop_type = 'LARGE' AS BIGINT) AS crop_large FROM farm"""))  # fmt: skip
def _(spark, d):
    df = farm(spark, d, "farm_id", "crop_type")
    hot = df.select("farm_id", *[(F.col("crop_type") == v).cast("bigint").alias(f"crop_{v.lower()}") for v in ("SMALL", "LARGE", "PROMO")])
    out = models.aligned(hot, ["farm_id", "crop_small", "crop_unseen", "crop_large"])
    return out.withColumn("crop_unseen", F.col("crop_unseen").cast("bigint"))


# ---- clusters ----------------------------------------------------------------------------------------------


@query("k01_features", farm_sql(
    f"""SELECT farm_id, round(({Y} - m1) / s1, 6) AS yield_scaled, round((water_efficiency - m2) / s2, 6) AS efficiency_scaled FROM farm,
    (SELECT avg({Y}) AS m1, stddev_pop({Y}) AS s1, avg(water_efficiency) AS m2, stddev_pop(water_efficiency) AS s2 FROM farm)"""))  # fmt: skip
def _(spark, d):
    ready = clustering.prepared(farm(spark, d, "farm_id", *clustering.FEATURES))
    v = vector_to_array("features")
    return pr.rounded(ready.select("farm_id", v[0].alias("yield_scaled"), v[8].alias("efficiency_scaled")), 6)


_CLUSTER_COLUMNS = ["farm_id", "region", "crop_type", *clustering.FEATURES]


# the lookups behind the columns that the features do not need, with their keys
_LOOKUPS = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}


def _repeats(spark, d, name, key):
    return not table(spark, d, name).where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


def _whole_records(spark, d):
    """Is a record more than its columns? A lookup with a repeated key repeats the records that meet it, so its join
    may not be left out; a table of few splits is dealt out by its whole records, which decides the draw of the centres."""
    splits = table(spark, d, "lineitem").rdd.getNumPartitions()
    if splits < min(task_count(spark), spark.sparkContext.defaultParallelism):
        return True
    return any(_repeats(spark, d, name, key) for name, key in _LOOKUPS.items())


def _ready(spark, d, *columns):
    """The vectors of all records, next to them the wanted columns (or more)."""
    whole = _whole_records(spark, d)
    wanted = _CLUSTER_COLUMNS if whole else list(dict.fromkeys([*columns, *clustering.FEATURES]))
    stored = materialize(farm(spark, d, *wanted), "cluster-rows", spread=True)
    ready = clustering.prepared(stored)
    return materialize(ready if whole else ready.select(*columns, "features"), "cluster-input")


def _selected(spark, d):
    return clustering.k_selection(_ready(spark, d))


def clustered(spark, d, *columns):
    """The clustered rows of the best k, written once for the tables made of them: the wanted columns
    and the yield, which numbers the clusters."""
    kept = list(dict.fromkeys([*columns, Y]))
    return materialize(clustering.best_assigned(_ready(spark, d, *kept)).select(*kept, "cluster"), "clustered")


@query("k02_k_selection")
def _(spark, d):
    rows = [(int(k), i, s) for k, i, s in _selected(spark, d)]
    return pr.rounded(spark.createDataFrame(rows, "k bigint, inertia double, silhouette double"))


@query("k02_inertia_by_hand", "SELECT k::BIGINT AS k, 0.0::DOUBLE AS gap FROM range(2, 9) t(k)")
def _(spark, d):
    return clustering.inertia_gap(_ready(spark, d)).withColumn("gap", F.abs(F.round("gap", 6)))


@query("k03_nearest_centre", farm_sql("SELECT count(*)::BIGINT AS n, 0::BIGINT AS unassigned, 0::BIGINT AS not_nearest FROM farm"))
def _(spark, d):
    ready = _ready(spark, d)
    fits, selection = clustering.compared(ready)
    k = clustering.best_k(selection)
    return clustering.misplaced(ready, k, fits[k])


@query("k04_centres_balance", farm_sql(
    " UNION ALL ".join(f"""SELECT '{c}' AS feature, round(avg("{c}"), 4) AS mean FROM farm""" for c in clustering.FEATURES)))
def _(spark, d):
    rows = clustered(spark, d, *clustering.FEATURES)
    both = clustering.centres(rows).join(rows.groupBy("cluster").agg(F.count("*").alias("members")), "cluster")
    # centres weighted by their members give the means of all rows
    one = both.agg(*[(F.sum(F.col(c) * F.col("members")) / F.sum("members")).alias(c) for c in clustering.FEATURES])
    return pr.rounded(one.unpivot([], clustering.FEATURES, "feature", "mean"))


@query("k06_sizes_balance", farm_sql(f"SELECT count(*)::BIGINT AS n, round(avg({Y}), 4) AS overall, 0::BIGINT AS wrong_flags FROM farm"))
def _(spark, d):
    sizes = clustering.sizes(clustered(spark, d))
    wrong = F.count_if(F.col("above_mean") != (F.col("avg_yield") > F.col("overall")))
    return pr.rounded(sizes.agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("avg_yield")) / F.sum("n")).alias("overall"), wrong.alias("wrong_flags")))


@query("k03_assignment")
def _(spark, d):
    return clustered(spark, d, "farm_id").select("farm_id", F.col("cluster").cast("bigint").alias("cluster"))


@query("k04_centres")
def _(spark, d):
    return pr.rounded(clustering.centres(clustered(spark, d, *clustering.FEATURES)))


@query("k05_normalised_profile")
def _(spark, d):
    return pr.rounded(clustering.normalised_profile(clustering.centres(clustered(spark, d, *clustering.PROFILE))))


@query("k06_cluster_sizes")
def _(spark, d):
    return pr.rounded(clustering.sizes(clustered(spark, d)))


@query("k07_cluster_labels")
def _(spark, d):
    return pr.rounded(clustering.labelled(clustering.sizes(clustered(spark, d))))


@query("k08_cluster_summary")
def _(spark, d):
    return pr.rounded(clustering.summary(clustered(spark, d, "water_efficiency", "crop_type")))


for _key, _column in (("a26_cluster_crop_share", "crop_type"), ("a26_cluster_region_share", "region")):
    query(_key)(lambda spark, d, c=_column: pr.rounded(clustering.shares(clustered(spark, d, c), c)))


# the same tables over a grouping that SQL can repeat
_RULE_CLUSTER = """grouped AS (SELECT *, CAST(CASE WHEN soil_moisture_pct < 30 THEN 0 WHEN soil_moisture_pct < 60 THEN 1 ELSE 2 END AS BIGINT) AS cluster FROM farm)"""


def _ruled(spark, d):
    m = F.col("soil_moisture_pct")
    cluster = F.when(m < 30, 0).when(m < 60, 1).otherwise(2).cast("bigint")
    return farm(spark, d, *_CLUSTER_COLUMNS).withColumn("cluster", cluster)


@query("k05_profile_of_groups", farm_sql(
    "SELECT cluster, " + ", ".join(f'round(("{c}" - lo) / (hi - lo), 4) AS "{c}"' for c in clustering.PROFILE) + " FROM (SELECT *, least("
    + ", ".join(f'"{c}"' for c in clustering.PROFILE) + ") AS lo, greatest(" + ", ".join(f'"{c}"' for c in clustering.PROFILE) + ") AS hi FROM (SELECT cluster, "
    + ", ".join(f'avg("{c}") AS "{c}"' for c in clustering.PROFILE) + " FROM grouped GROUP BY cluster))", _RULE_CLUSTER))
def _(spark, d):
    return pr.rounded(clustering.normalised_profile(clustering.centres(_ruled(spark, d))))


@query("k07_labels_of_groups", farm_sql(
    f"""SELECT cluster, n, round(a, 4) AS avg_yield, round(o, 4) AS overall, a > o AS above_mean, CASE WHEN a > o * 1.1::DOUBLE THEN 'High Performers' WHEN a < o * 0.9::DOUBLE THEN 'Underperformers'
    ELSE 'Average Performers' END AS label FROM (SELECT cluster, count(*) AS n, avg({Y}) AS a FROM grouped GROUP BY cluster), (SELECT avg({Y}) AS o FROM grouped)""", _RULE_CLUSTER))  # fmt: skip
def _(spark, d):
    return pr.rounded(clustering.labelled(clustering.sizes(_ruled(spark, d))))


@query("k08_summary_of_groups", farm_sql(
    f"""SELECT cluster, count(*) AS n, round(avg({Y}), 4) AS avg_yield, round(avg(water_efficiency), 4) AS avg_water_efficiency, any_value(t.top_crops) AS top_crops FROM grouped JOIN (
      SELECT cluster, string_agg(crop_type, ', ' ORDER BY k) AS top_crops FROM (SELECT cluster, crop_type, row_number() OVER (PARTITION BY cluster ORDER BY count(*) DESC, crop_type) AS k
        FROM grouped GROUP BY cluster, crop_type) WHERE k <= 2 GROUP BY cluster) t USING (cluster) GROUP BY cluster""", _RULE_CLUSTER))  # fmt: skip
def _(spark, d):
    return pr.rounded(clustering.summary(_ruled(spark, d)))


@query("a26_group_crop_share", farm_sql(
    """SELECT cluster, crop_type, count(*) AS n, round(CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (PARTITION BY cluster), 4) AS share FROM grouped GROUP BY cluster, crop_type""", _RULE_CLUSTER))  # fmt: skip
def _(spark, d):
    return pr.rounded(clustering.shares(_ruled(spark, d), "crop_type"))


@query("s16_clustered_export")
def _(spark, d):
    out = clustered(spark, d, *_CLUSTER_COLUMNS)
    path = files.write_csv(out, fresh_path(spark, "clustered-csv"))
    back = spark.read.schema(out.schema).option("header", True).csv(path)
    return back.groupBy("cluster").agg(F.count("*").alias("n"), F.round(F.avg(Y), 4).alias("avg_yield"))


@query("s16_export_complete", farm_sql(f"SELECT count(*)::BIGINT AS n, round(avg({Y}), 2) AS avg_yield, 0::BIGINT AS without_cluster FROM farm"))
def _(spark, d):
    out = clustered(spark, d, *_CLUSTER_COLUMNS)
    path = files.write_csv(out, fresh_path(spark, "clustered-csv"))
    back = spark.read.schema(out.schema).option("header", True).csv(path)
    return back.agg(F.count("*").alias("n"), F.round(F.avg(Y), 2).alias("avg_yield"), F.count_if(F.col("cluster").isNull()).alias("without_cluster"))


@query("s17_model_tables_export")
def _(spark, d):
    fitted, test, numeric, labels = _trained(spark, d, "Linear Regression", "Random Forest", "Gradient Boosting")
    comparison = models.compare(fitted, test).drop("place")
    importance = pr.rounded(models.feature_importance(fitted["Gradient Boosting"], test, numeric, labels), 3)
    files.write_csv(importance, fresh_path(spark, "importance"))
    path = files.write_csv(comparison, fresh_path(spark, "comparison"))
    return spark.read.schema(comparison.schema).option("header", True).csv(path)


@query("s18_saved_pipeline")
def _(spark, d):
    fitted, test, _, _ = _trained(spark, d, "Linear Regression")
    path = fresh_path(spark, "model")
    fitted["Linear Regression"].write().overwrite().save(path)
    back = PipelineModel.load(path)
    return pr.rounded(back.transform(test).select("farm_id", "prediction"), 3)


# ---- allocation -----------------------------------------------------------------------------------------


@query("o01_water_coefficients", farm_sql(
    """SELECT crop_type, round(slope, 4) AS slope, round(intercept, 4) AS intercept, round(min_water, 4) AS min_water, round(max_water, 4) AS max_water FROM water""", WATER_SQL))  # fmt: skip
def _(spark, d):
    out = stats.water_response(farm(spark, d, "crop_type", "rainfall_mm", Y))
    return pr.rounded(out.select("crop_type", "slope", "intercept", "min_water", "max_water"))


def _allocation_sql(body, group, budgets, water=WATER_SQL):
    part = f"PARTITION BY {group}" if group else ""
    rows = ", ".join(f"({b}::DOUBLE)" for b in budgets)
    return farm_sql(
        body,
        water,
        f"""base AS (SELECT *, sum(min_water) OVER ({part}) AS low, CASE WHEN slope > 0 THEN max_water - min_water ELSE 0 END AS room FROM water, (VALUES {rows}) b(budget))""",
        f"""filled AS (SELECT *, coalesce(sum(room) OVER ({part} ORDER BY slope DESC, crop_type ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM base)""",
        """placed AS (SELECT *, CASE WHEN low <= budget THEN 'Optimal' ELSE 'Infeasible' END AS status,
          CASE WHEN low <= budget THEN min_water + least(room, greatest(0, budget - low - prior)) END AS water FROM filled)""",
        "allocation AS (SELECT *, slope * water + intercept AS expected_yield FROM placed)",
    )


_TOTALS = """round(sum(water), 4) AS total_water_used, round(any_value(budget) - sum(water), 4) AS water_saved, round(sum(expected_yield), 4) AS total_expected_yield"""


def _budgets(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "budget double")


def _allocated(spark, d, budgets, keys=None):
    keys = keys or ["crop_type"]
    fits = stats.water_response(farm(spark, d, *keys, "rainfall_mm", Y), keys)
    # a handful of budgets against one row per crop
    cases = fits.crossJoin(F.broadcast(_budgets(spark, budgets)))
    scenario = ["budget", *[k for k in keys if k != "crop_type"]]
    return allocate.allocate(cases, "budget", "crop_type", scenario), scenario


@query("o02_allocation", _allocation_sql(
    "SELECT budget, crop_type, status, round(water, 4) AS water, round(expected_yield, 4) AS expected_yield FROM allocation", "budget", [100, 1000, 5000]))
def _(spark, d):
    out, _ = _allocated(spark, d, [100, 1000, 5000])
    return pr.rounded(out.select("budget", "crop_type", "status", "water", "expected_yield"))


@query("o03_allocation_totals", _allocation_sql(f"SELECT budget, status, {_TOTALS} FROM allocation GROUP BY budget, status", "budget", [100, 1000, 5000]))
def _(spark, d):
    out, _ = _allocated(spark, d, [100, 1000, 5000])
    return pr.rounded(allocate.totals(out, "budget"))


@query("o04_water_efficiency", _allocation_sql(
    "SELECT crop_type, round(CASE WHEN water > 0 THEN expected_yield / water WHEN water IS NOT NULL THEN 0 END, 4) AS efficiency FROM allocation", "budget", [1000]))
def _(spark, d):
    out, _ = _allocated(spark, d, [1000])
    return pr.rounded(allocate.efficiency(out).select("crop_type", "efficiency"))


_REGION_WATER = WATER_SQL.replace("SELECT crop_type, count(*)", "SELECT region, crop_type, count(*)").replace("GROUP BY crop_type", "GROUP BY region, crop_type")


@query("o05_many_scenarios", _allocation_sql(
    f"SELECT region, budget, status, {_TOTALS} FROM allocation GROUP BY region, budget, status", "budget, region", [200, 800, 1600, 3200], _REGION_WATER))
def _(spark, d):
    out, scenario = _allocated(spark, d, [200, 800, 1600, 3200], ["region", "crop_type"])
    return pr.rounded(allocate.totals(out, "budget", ["region"]))
