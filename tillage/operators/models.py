"""Yield regression, disease classification, scoring and similarity."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from tillage.functions import agronomy as ag
from tillage.operators import cleaning, neighbours, stats
from tillage.operators.boosting import BoostedRegressor
from tillage.operators.forest import ForestRegressor
from tillage.operators.orderstats import RANK, join_on_keys, order_statistics
from tillage.operators.profile import YIELD, existing
from tillage.session import materialize

# Model inputs.
NUMERIC_BASE = [
    "soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct", "sunlight_hours",
    "pesticide_usage_ml", "NDVI_index", "total_days",
]
NUMERIC_EXTENDED = [
    "water_efficiency", "pesticide_efficiency", "heat_stress", "drought_stress", "growing_conditions_score",
]
LEAKY = ["water_efficiency", "pesticide_efficiency"]  # quotients of the target
CATEGORICAL = ["region", "crop_type", "irrigation_type", "fertilizer_type", "crop_disease_status"]
SEASONAL = ["sowing_season"]
DISEASE_FEATURES = [
    "soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct", "sunlight_hours", "NDVI_index",
]
SIMILARITY_FEATURES = [
    "soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "humidity_pct", "sunlight_hours",
    "NDVI_index", "total_days",
]
SEED = 42


# ---- features and splits ------------------------------------------------------------------------------------


def feature_lists(df: DataFrame, exclude_leaky: bool = False) -> tuple[list[str], list[str]]:
    numeric = existing(df, NUMERIC_BASE + NUMERIC_EXTENDED)
    if exclude_leaky:
        numeric = [c for c in numeric if c not in LEAKY]
    return numeric, existing(df, CATEGORICAL + SEASONAL)


def prepared(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """The rows of a training run, written once, with the columns filled that need it."""
    stored = materialize(df, "training", spread=True)
    filled = cleaning.median_fill(stored, cleaning.with_missing(stored, numeric))
    return cleaning.mode_fill(filled, cleaning.with_missing(stored, categorical))


def preprocessor(numeric: list[str], categorical: list[str]) -> list:
    """Standardised numbers and one-hot labels; a label not seen in training is all zeros."""
    stages = [VectorAssembler(inputCols=numeric, outputCol="__num", handleInvalid="keep")]
    stages.append(StandardScaler(inputCol="__num", outputCol="__scaled", withMean=True, withStd=True))
    if categorical:
        indexed = [f"__ix_{c}" for c in categorical]
        # the slot of unseen labels is the last one, and dropping it leaves them all zeros
        stages.append(
            StringIndexer(inputCols=categorical, outputCols=indexed, handleInvalid="keep", stringOrderType="alphabetAsc")
        )
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=categorical_vectors(categorical), dropLast=True))
    stages.append(VectorAssembler(inputCols=["__scaled", *categorical_vectors(categorical)], outputCol="features"))
    return stages


def categorical_vectors(categorical: list[str]) -> list[str]:
    return [f"__oh_{c}" for c in categorical]


def hash_fraction(columns: list[str], seed: int = SEED):
    """A number in [0, 1) from the row's own values: the same on any engine and partitioning."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") / float(16**12)


def split(df: DataFrame, key: list[str], train: float = 0.8, seed: int = SEED, drawn: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by the hash of their key, or by the column ``drawn`` that holds it already."""
    if drawn:
        return df.where(F.col(drawn) < train).drop(drawn), df.where(F.col(drawn) >= train).drop(drawn)
    u = hash_fraction(key, seed)
    return df.where(u < train), df.where(u >= train)


def stratified_split(df: DataFrame, label: str, key: list[str], train: float = 0.8, seed: int = SEED) -> DataFrame:
    """Adds ``in_train``: the rows of each class up to the class's own ``train`` share in hash order.

    The cut is an order statistic per class, so no class ever meets in one window.
    """
    hashed = df.withColumn("__u", hash_fraction(key, seed))
    cuts = order_statistics(hashed, [label], "__u", {"__cut": (train, RANK)})
    return join_on_keys(hashed, cuts, [label]).withColumn("in_train", F.col("__u") <= F.col("__cut")).drop("__u", "__cut")


# ---- regression ---------------------------------------------------------------------------------------------------


def regressors(trees: int = 300, depth: int = 18, rounds: int = 200, boost_depth: int = 4, rate: float = 0.05) -> dict:
    common = {"labelCol": YIELD, "featuresCol": "features"}
    # a walk down four levels costs less than to write and join the node of every row at each of them
    return {
        "Linear Regression": LinearRegression(**common),
        "Random Forest": ForestRegressor(numTrees=trees, maxDepth=depth, seed=SEED, **common),
        "Gradient Boosting": BoostedRegressor(maxIter=rounds, maxDepth=boost_depth, stepSize=rate, seed=SEED, cacheNodeIds=False, **common),
    }


def train(train_set: DataFrame, numeric: list[str], categorical: list[str], models: dict | None = None) -> dict[str, PipelineModel]:
    """One fitted pipeline per model; the preprocessing is fitted once and shared."""
    fitted = Pipeline(stages=preprocessor(numeric, categorical)).fit(train_set)
    ready = fitted.transform(train_set).select("features", YIELD)
    chosen = models or regressors()
    # these read the rows a few times and keep what they need: to keep vectors for them costs more than to make them
    if any(not isinstance(m, (LinearRegression, ForestRegressor, BoostedRegressor)) for m in chosen.values()):
        ready.persist()
    try:
        return {
            name: PipelineModel(stages=[*fitted.stages, estimator.fit(ready)])
            for name, estimator in chosen.items()
        }
    finally:
        ready.unpersist()


def regression_metrics(df: DataFrame, name: str, actual: str = YIELD, predicted: str = "prediction") -> DataFrame:
    """R2, RMSE and MAE from one aggregate."""
    error = F.col(actual) - F.col(predicted)
    sums = df.agg(
        F.sum(error * error).alias("sse"),
        F.sum(F.abs(error)).alias("sae"),
        F.count(error).alias("n"),
        (F.var_pop(actual) * F.count(actual)).alias("sst"),
    )
    return sums.select(
        F.lit(name).alias("Model"),
        F.round(1 - F.try_divide(F.col("sse"), F.col("sst")), 3).alias("R2"),
        F.round(F.sqrt(F.try_divide(F.col("sse"), F.col("n"))), 3).alias("RMSE"),
        F.round(F.try_divide(F.col("sae"), F.col("n")), 3).alias("MAE"),
    )


def compare(models: dict[str, PipelineModel], test_set: DataFrame) -> DataFrame:
    out = None
    for place, (name, model) in enumerate(models.items()):
        one = regression_metrics(model.transform(test_set), name).withColumn("place", F.lit(place).cast("bigint"))
        out = one if out is None else out.unionByName(one)
    return out


def best_model(comparison: DataFrame) -> DataFrame:
    """The highest rounded R2; the first model on a tie."""
    return comparison.orderBy(F.desc("R2"), "place").limit(1)


def feature_importance(model: PipelineModel, df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame | None:
    """Importance by expanded feature name, or None for a model without importances."""
    final = model.stages[-1]
    if not hasattr(final, "featureImportances"):
        return None
    labels = next(s for s in model.stages if hasattr(s, "labelsArray")).labelsArray if categorical else []
    names = [*numeric, *[f"{c}_{v}" for c, vs in zip(categorical, labels) for v in vs]]
    values = final.featureImportances.toArray().tolist()
    rows = list(zip(names, values, strict=True))
    return df.sparkSession.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")


def normal_equations(df: DataFrame, numeric: list[str], categorical: list[str], actual: str = YIELD, predicted: str = "prediction") -> DataFrame:
    """What least squares leaves to be explained: per number its correlation with the error, and per
    label the mean error of its rows over the spread of the target. All are 0 on the training rows of
    a linear model. Two scans: one row of sums of products, and sums by all labels together, which are taken apart."""
    error = F.col(actual) - F.col(predicted)
    rows = df.select(*numeric, *categorical, error.alias("__error"), F.col(actual).alias("__actual"))
    one = rows.agg(F.stddev_pop("__actual").alias("__spread"), *[stats.pearson(c, "__error").alias(c) for c in numeric])
    one = materialize(one, "sums-of-products")  # one row
    spread = F.broadcast(one.select("__spread"))
    numbers = one.select(*numeric).unpivot([], numeric, "feature", "rest")
    numbers = numbers.select("feature", F.lit("").alias("value"), F.coalesce("rest", F.lit(0.0)).alias("rest"))
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("string").alias("value")) for c in categorical]))
    together = rows.groupBy(*categorical).agg(F.sum("__error").alias("__sum"), F.count("__error").alias("__n"))
    labels = together.select(cells.alias("cell"), "__sum", "__n").groupBy("cell").agg(F.try_divide(F.sum("__sum"), F.sum("__n")).alias("rest"))
    return numbers.unionByName(labels.crossJoin(spread).select("cell.feature", "cell.value", (F.col("rest") / F.col("__spread")).alias("rest")))


def residuals(df: DataFrame, actual: str = YIELD, predicted: str = "prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


# ---- scoring -------------------------------------------------------------------------------------------------------


def with_model_inputs(df: DataFrame) -> DataFrame:
    """Derived inputs from the raw ones, where absent. The two quotients of the target need
    the yield; for a new row they stay missing."""
    y = F.col(YIELD) if YIELD in df.columns else F.lit(None).cast("double")
    made = {
        "water_efficiency": y / (F.col("rainfall_mm") + 1),
        "pesticide_efficiency": y / (F.col("pesticide_usage_ml") + 1),
        "heat_stress": ag.heat_stress(),
        "drought_stress": ag.drought_stress(),
        "growing_conditions_score": ag.growing_score(),
    }
    return df.withColumns({c: e for c, e in made.items() if c not in df.columns})


def score_cascade(df: DataFrame, mean_yield: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Prediction from the model, else the rule score, else the mean; each row names its source."""
    scored = df
    if model is not None:
        scored = model.transform(df).withColumn("__model", F.nanvl("prediction", F.lit(None).cast("double")))
        scored = scored.select(*df.columns, "__model")
    else:
        scored = df.withColumn("__model", F.lit(None).cast("double"))
    one = mean_yield.select(F.col(mean_yield.columns[0]).alias("__mean"))
    usable = F.col("soil_moisture_pct").isNotNull() & F.col("soil_pH").isNotNull() & F.col("crop_type").isNotNull()
    rule = F.when(usable, ag.rule_score())
    out = scored.crossJoin(F.broadcast(one)).withColumns(
        {
            "prediction": F.coalesce("__model", rule, "__mean"),
            "model_used": F.when(F.col("__model").isNotNull(), "ML Model")
            .when(rule.isNotNull(), "Rule-Based Fallback")
            .otherwise("Average Yield"),
        }
    )
    confidence = (
        F.when(F.col("model_used") == "ML Model", 0.85).when(F.col("model_used") == "Rule-Based Fallback", 0.65).otherwise(0.5)
    )
    return out.withColumn("confidence", confidence).select(*df.columns, "prediction", "confidence", "model_used")


# Varied parameters with their bounds, and the relative steps.
SENSITIVITY = {"soil_moisture_pct": (0.0, 100.0), "temperature_C": None, "rainfall_mm": None, "NDVI_index": (0.0, 1.0)}
STEPS = [-0.3, -0.2, -0.1, 0.0, 0.1, 0.2, 0.3]


def sensitivity_inputs(df: DataFrame) -> DataFrame:
    """Each row once per parameter and step, with that parameter changed: 28 variants per row."""
    cases = []
    for name, bounds in SENSITIVITY.items():
        for step in STEPS:
            value = F.col(name) * F.lit(1 + step)
            if bounds:
                value = F.greatest(F.lit(bounds[0]), F.least(F.lit(bounds[1]), value))
            changed = [value.alias(c) if c == name else F.col(c).alias(c) for c in SENSITIVITY if c in df.columns]
            cases.append(F.struct(F.lit(name).alias("parameter"), F.lit(step).alias("variation"), *changed))
    keep = [c for c in df.columns if c not in SENSITIVITY]
    return df.select(*keep, F.inline(F.array(*cases)))


def aligned(df: DataFrame, trained: list[str]) -> DataFrame:
    """The trained columns in order: missing ones are 0, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in trained])


# ---- nearest neighbour classification -------------------------------------------------------------------------------


def disease_rows(df: DataFrame, key: str, label: str = "crop_disease_status") -> DataFrame:
    """Features with missing values filled by the median, and the class label."""
    features = existing(df, DISEASE_FEATURES)
    filled = cleaning.median_fill(df, cleaning.with_missing(df, features))
    return filled.where(F.col(label).isNotNull())


def class_votes(found: DataFrame, key: str) -> DataFrame:
    """Vote share per class, weight 1/distance; exact matches take all the weight."""
    exact = F.sum(F.when(F.col("distance") == 0, F.col("taken"))).alias("exact")
    inverse = F.sum(F.when(F.col("distance") > 0, F.col("taken") / F.col("distance"))).alias("inverse")
    votes = found.groupBy(key, "label").agg(exact, inverse)
    # a row has at most k classes; the window keeps the search behind the votes a single one
    whole = W.partitionBy(key)
    votes = votes.withColumns({"all_exact": F.sum("exact").over(whole), "all_inverse": F.sum("inverse").over(whole)})
    share = F.when(F.col("all_exact").isNotNull(), F.coalesce("exact", F.lit(0)) / F.col("all_exact")).otherwise(
        F.col("inverse") / F.col("all_inverse")
    )
    return votes.select(key, "label", share.alias("probability"))


def knn_probabilities(train_set, test_set, features, key, label, k: int = 5) -> DataFrame:
    scale = neighbours.scale_row(train_set, features)
    found = neighbours.nearest(
        neighbours.standardised(test_set, scale, features), neighbours.standardised(train_set, scale, features),
        features, k, key, label,
    )
    return class_votes(found, key)


def predicted_class(votes: DataFrame, key: str) -> DataFrame:
    """The class with the largest share; the first by name on a tie."""
    best = F.min(F.struct((-F.round("probability", 12)).alias("p"), F.col("label").alias("l"))).alias("b")
    return votes.groupBy(key).agg(best).select(key, F.col("b.l").alias("predicted"), (-F.col("b.p")).alias("probability"))


def probability_maps(votes: DataFrame, key: str) -> DataFrame:
    """One map of class to share per row; a row has at most k classes."""
    pairs = F.sort_array(F.collect_list(F.struct("label", "probability")))
    return votes.groupBy(key).agg(F.map_from_entries(pairs).alias("probabilities"))


def k_selection(train_set, features, key, label, max_k: int = 20, folds: int = 5, hash_key: list[str] | None = None):
    """Cross-validated accuracy of uniform votes for k = 1..max_k, on unscaled features.

    The neighbours are found once; every k reads the same ranks.
    """
    u = hash_fraction(hash_key or [key], SEED + 1)
    rows = train_set.withColumn("__f", F.floor(u * folds).cast("int"))
    found = neighbours.nearest(rows, rows, features, max_k, key, label, fold="__f")
    start = F.sum("taken").over(
        W.partitionBy(key).orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
    ) - F.col("taken")
    steps = found.withColumn("start", start).withColumn("k", F.explode(F.sequence(F.lit(1), F.lit(max_k))))
    steps = steps.withColumn("votes", F.least(F.col("taken"), F.greatest(F.lit(0), F.col("k") - F.col("start"))))
    votes = steps.where(F.col("votes") > 0).groupBy(key, "k", "label").agg(F.sum("votes").alias("votes"))
    best = F.min(F.struct((-F.col("votes")).alias("v"), F.col("label").alias("l"))).alias("b")
    chosen = votes.groupBy(key, "k").agg(best).select(key, "k", F.col("b.l").alias("predicted"))
    judged = chosen.join(rows.select(key, "__f", F.col(label).alias("actual")), key)
    per_fold = judged.groupBy("k", "__f").agg(
        F.avg((F.col("predicted") == F.col("actual")).cast("double")).alias("accuracy")
    )
    return per_fold.groupBy("k").agg(F.avg("accuracy").alias("accuracy")).orderBy("k")


def best_k(selection: DataFrame) -> DataFrame:
    return selection.orderBy(F.desc("accuracy"), "k").limit(1)


# ---- classification reports -------------------------------------------------------------------------------------------


def confusion(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    return df.groupBy(actual, predicted).agg(F.count("*").alias("n"))


def classification_report(df: DataFrame, actual: str = "actual", predicted: str = "predicted") -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy and the two averages."""
    cells = confusion(df, actual, predicted)
    pairs = F.array(
        F.struct(F.col(actual).alias("label"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("claimed")),
        F.struct(F.col(predicted).alias("label"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("claimed")),
    )
    hit = F.when(F.col(actual) == F.col(predicted), F.col("n")).otherwise(F.lit(0))
    per_cell = cells.select(F.col("n"), (hit / 2).alias("half"), F.inline(pairs))
    sums = per_cell.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("claimed").alias("claimed"), F.sum("half").alias("hits")
    )
    zero = F.lit(0.0)
    scores = sums.select(
        "label",
        F.coalesce(F.try_divide(F.col("hits"), F.col("claimed")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("hits"), F.col("support")), zero).alias("recall"),
        F.col("support").cast("bigint").alias("support"),
        "hits",
    )
    p, r = F.col("precision"), F.col("recall")
    scores = scores.withColumn("f1", F.coalesce(F.try_divide(2 * p * r, p + r), zero))
    totals = scores.agg(
        F.sum("support").alias("n"),
        F.sum("hits").alias("hits"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support")).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")],
    )
    accuracy = F.try_divide(F.col("hits"), F.col("n"))
    summary = F.array(
        *[
            F.struct(
                F.lit(name).alias("label"),
                *[(accuracy if name == "accuracy" else F.col(f"{name.split()[0]}_{c}")).alias(c) for c in ("precision", "recall", "f1")],
                F.col("n").cast("bigint").alias("support"),
            )
            for name in ("accuracy", "macro avg", "weighted avg")
        ]
    )
    return scores.select("label", "precision", "recall", "f1", "support").unionByName(totals.select(F.inline(summary)))


# ---- similar farms ----------------------------------------------------------------------------------------------------


def similar_farms(queries: DataFrame, farms: DataFrame, key: str, tag: str, k: int = 5, attributes: list[str] | None = None) -> DataFrame | None:
    """The k nearest farms of each query on the standardised features both tables have.

    A query with gaps is compared on the features it has, with farms that have them all; queries
    with fewer than three features have no answer, and without three common columns there is none at all.
    The farthest of the k scores 0; when all are at distance 0 they score 1. With ``attributes``
    each farm comes with these columns (named ``farm_*``) and the number of features that were used.
    """
    features = [f for f in SIMILARITY_FEATURES if f in queries.columns and f in farms.columns]
    if len(features) < 3:
        return None
    scale = neighbours.scale_row(farms, features)
    known = [F.when(F.col(f).isNotNull() & ~F.isnan(F.col(f).cast("double")), 1 << i).otherwise(0) for i, f in enumerate(features)]
    masked = queries.withColumn("__mask", reduce(lambda a, b: a + b, known))
    out = None
    # which features are missing: at most 2 ** 8 kinds of queries, in practice a few
    for (mask,) in sorted(masked.select("__mask").distinct().collect()):
        used = [f for i, f in enumerate(features) if mask >> i & 1]
        if len(used) < 3:
            continue
        whole = farms.dropna(subset=used).withColumn("__any", F.lit("farm"))
        found = neighbours.nearest(
            neighbours.standardised(masked.where(F.col("__mask") == mask).select(key, *used), scale, used),
            neighbours.standardised(whole, scale, used), used, k, key, "__any", tag=tag,
        ).withColumn("features_used", F.lit(len(used)).cast("bigint"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = queries.limit(0).select(F.col(key)).withColumns({tag: F.lit(""), "rank": F.lit(0), "distance": F.lit(0.0), "features_used": F.lit(0).cast("bigint")})
    found = out.where(F.col("rank") <= k)
    far = F.max("distance").over(W.partitionBy(key))
    score = F.coalesce(1 - F.try_divide(F.col("distance"), far), F.lit(1.0))
    named = found.select(key, tag, "rank", "distance", F.round(score, 3).alias("similarity_score"), "features_used")
    if attributes is None:
        return named.drop("features_used")
    # a few rows per query meet the farms once
    theirs = farms.select(F.col(tag).cast("string").alias(tag), *[F.col(c).alias(f"farm_{c}") for c in attributes]).dropDuplicates([tag])
    return materialize(named, "similar").join(theirs, tag)


# Compared features of the filtered similarity score.
SCORED = ["soil_moisture_pct", "soil_pH", "temperature_C", "rainfall_mm", "NDVI_index"]


def filtered_similarity(df: DataFrame, wanted: dict, order: list[str], k: int = 10) -> DataFrame:
    """Farms of the asked crop and region, scored by closeness; a sample at 0.5 when there are none."""
    from tillage.operators.filters import by_equality, seeded_sample

    base, same = 0.5, df
    for column, bonus in (("crop_type", 0.3), ("region", 0.2)):
        if wanted.get(column):
            base += bonus
            same = by_equality(same, **{column: wanted[column]})
    score = F.lit(base)
    for f in SCORED:
        if wanted.get(f) is not None and f in df.columns:
            value = float(wanted[f])
            score = score - F.abs(F.col(f) - value) / max(value, 1.0) * 0.1
    clipped = F.greatest(F.lit(0.1), F.least(F.lit(0.95), score))
    found = same.withColumn("similarity_score", clipped).orderBy(F.desc("similarity_score"), *order).limit(k)
    some = found.agg(F.count("*").alias("__c"))
    sample = seeded_sample(df, k, order).withColumn("similarity_score", F.lit(0.5))
    fallback = sample.crossJoin(F.broadcast(some)).where(F.col("__c") == 0).drop("__c")
    return found.unionByName(fallback)
