"""Segments, churn and lifetime value: training sets, models, scoring, evaluation."""

from math import ceil

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Window
from pyspark.sql import functions as F

from spendgrid.functions.bands import at_least, lookup_text
from spendgrid.functions.dialect import (
    count_where,
    exact_avg,
    exact_sum,
    local_frame,
    months_before,
    ratio,
    round_half,
    strict_greatest,
    strict_least,
    sum_where,
)
from spendgrid.functions.labels import CHURN_LEVELS, CLV_TIERS, SEGMENTS
from spendgrid.functions.ordering import bucket_ends, ntile_of, order_statistics
from spendgrid.operators import lloyd
from spendgrid.operators.features import ActivityWindow, activities, activity_in

# The inputs of the three models.
SEGMENT_FEATURES = [
    "val_trns",
    "nr_trns",
    "lst_trns_days",
    "avg_val",
    "active_months",
    "active_destinations",
    "active_nav_categories",
    "NR_TRNS_WEEKEND",
    "NR_TRNS_WEEK",
]
_BEHAVIOUR = [
    "nr_trns",
    "val_trns",
    "avg_val",
    "active_months",
    "days_between",
    "active_destinations",
    "active_nav_categories",
    "NR_TRNS_WEEKEND",
    "NR_TRNS_WEEK",
]
_PERSON = ["age", "estimated_income", "main_banked"]
CHURN_FEATURES = [*_BEHAVIOUR, "pct_morning", "pct_evening", "txn_trend", *_PERSON]
CLV_FEATURES = [*_BEHAVIOUR, "days_since_last", "spend_trend", *_PERSON]


def _with_person(features, customers):
    """Add age, income and main-bank flag; missing values count as zero."""
    person = customers.select("UNIQUE_ID", *_PERSON)
    joined = features.join(person, "UNIQUE_ID", "left")
    return joined.na.fill(0, _PERSON)


# --- segments ---------------------------------------------------------------


def _vectors(inputs):
    return [
        VectorAssembler(inputCols=inputs, outputCol="_raw", handleInvalid="error"),
        StandardScaler(inputCol="_raw", outputCol="features", withMean=True, withStd=True),
    ]


def _fitted(stages, rows):
    """A fitted pipeline that keeps the losses of its training and lets go of the rest.

    The summary of a model holds the training data and their session, and goes into every task
    that applies the model; a session in which writes are observed cannot be sent there.
    """
    model = Pipeline(stages=stages).fit(rows)
    last = model.stages[-1]
    model.losses = [float(x) for x in getattr(last.summary, "objectiveHistory", ())]
    last._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def fit_segments(scores, k=5, max_iter=20, seed=42):
    kmeans = KMeans(k=k, maxIter=max_iter, seed=seed, featuresCol="features", predictionCol="centroid_id")
    return _fitted([*_vectors(SEGMENT_FEATURES), kmeans], scores.na.fill(0, SEGMENT_FEATURES))


def cluster(model, scores):
    return model.transform(scores.na.fill(0, SEGMENT_FEATURES)).drop("_raw")


def assign_segments(clustered, customers):
    """Rank clusters by mean spend, name them and add demographics.

    `clustered` is the scores with a centroid_id. One row per cluster comes to the
    driver; the ranks go back as literals, so the customers are not shuffled by a
    handful of cluster ids.
    """
    spend = clustered.groupBy("centroid_id").agg(exact_avg("val_trns").alias("spend")).collect()
    ranked = sorted(spend, key=lambda row: (-row["spend"], row["centroid_id"]))
    ranks = {row["centroid_id"]: i + 1 for i, row in enumerate(ranked)}
    names = dict(enumerate(SEGMENTS, start=1))
    scores = [c for c in clustered.columns if c not in ("centroid_id", "UNIQUE_ID", "features")]
    return (
        clustered.withColumn("cluster_id", lookup_text(F.col("centroid_id"), ranks).cast("bigint"))
        .withColumn("segment_name", lookup_text(F.col("cluster_id"), names))
        .select("UNIQUE_ID", "cluster_id", "segment_name", *scores)
        .join(customers.drop("vertical_sales_index"), "UNIQUE_ID", "left")
    )


# --- churn ------------------------------------------------------------------


def _windows(params):
    """The three windows that the models learn from and score, by the prefix of their columns."""
    p = params
    return {
        "churn_": ActivityWindow(p.window_months, p.churn_outcome_months, p.trend_recent_months, p.churn_early_months),
        "now_": ActivityWindow(p.window_months, 0, p.trend_recent_months, p.trend_early_months),
        "clv_": ActivityWindow(p.clv_observation_start, p.clv_future_months, p.trend_recent_months, p.trend_early_months),
    }


def customer_activity(txns, as_of, params):
    """The features of all model windows and both outcomes per customer, by one scan of the facts."""
    day = F.col("EFF_DATE")
    back = F.max(day >= months_before(as_of, params.churn_outcome_months)).alias("back")
    future = exact_sum("trns_amt", where=day >= months_before(as_of, params.clv_future_months)).alias("future_spend")
    return activities(txns, as_of, _windows(params), [back, future])


def churn_training_set(txns, customers, as_of, params, keep_id=False, wide=None):
    """Observation-window features and whether the customer stayed away afterwards.

    wide: customer_activity(), where it is at hand.
    """
    wide = customer_activity(txns, as_of, params) if wide is None else wide
    observed = activity_in(wide, "churn_", params.min_model_txns, ["back"])
    labelled = observed.withColumn("churned", F.when(F.col("back"), 0).otherwise(1).cast("bigint"))
    key = ["UNIQUE_ID"] if keep_id else []
    return _with_person(labelled, customers).select(*key, *CHURN_FEATURES, "churned")


def activity_current(txns, as_of, params, wide=None):
    """Features of the newest window, for scoring churn and value alike."""
    wide = customer_activity(txns, as_of, params) if wide is None else wide
    return activity_in(wide, "now_", params.min_model_txns)


def churn_features_current(current):
    return current.drop("spend_trend")


def _split(rows):
    """Deterministic 80/20 split by content hash, stable when a task is rerun."""
    held_out = F.pmod(F.xxhash64(*rows.columns), F.lit(10)) >= 8
    return rows.where(~held_out), rows.where(held_out)


def class_weights(train, label="churned"):
    """Add weight n / (2 * n_class); the class counts are two numbers."""
    row = train.agg(F.count("*").alias("n"), F.sum(label).alias("pos")).first()
    positives = row["pos"] or 0
    negatives = row["n"] - positives
    weight = F.when(F.col(label) == 1, row["n"] / (2.0 * max(positives, 1))).otherwise(
        row["n"] / (2.0 * max(negatives, 1))
    )
    return train.withColumn("_weight", weight)


def fit_churn(training, max_iter=50):
    train, _ = _split(training)
    model = LogisticRegression(
        labelCol="churned",
        weightCol="_weight",
        maxIter=max_iter,
        predictionCol="predicted_label",
        probabilityCol="_probability",
        rawPredictionCol="_score",
    )
    return _fitted([*_vectors(CHURN_FEATURES), model], class_weights(train.na.fill(0, CHURN_FEATURES)))


CHURN_PERSON = ["age", "gender_label", "income_segment", "estimated_income", "credit_risk_class", "age_group", "income_group"]
CLV_PERSON = ["age", "gender_label", "income_segment", "age_group", "income_group"]


def attach_person(features, customers, columns):
    """The scoring features with the demographics of the result, joined once."""
    return features.join(customers.select("UNIQUE_ID", *columns), "UNIQUE_ID", "left")


def _scored(model, features, customers, inputs, columns, results):
    """Model results beside the features and the untouched demographics.

    The model passes all columns on, so nothing is joined back: the demographics travel
    in a struct while their namesakes, with gaps filled, are inputs of the model.
    """
    person = customers.select("UNIQUE_ID", F.struct(*columns).alias("_person"), *_PERSON)
    rows = features.join(person, "UNIQUE_ID", "left").na.fill(0, inputs)
    return model.transform(rows).select(*features.columns, "_person.*", *results)


def predict_churn(model, features, customers):
    """The scoring features and demographics with churn_probability and predicted_label."""
    results = [
        round_half(vector_to_array("_probability")[1], 4).alias("churn_probability"),
        F.col("predicted_label").cast("bigint").alias("predicted_label"),
    ]
    return _scored(model, features, customers, CHURN_FEATURES, CHURN_PERSON, results)


def score_churn(predictions):
    """Churn risk table: probability, level, activity and demographics."""
    return predictions.select(
        "UNIQUE_ID",
        "churn_probability",
        "predicted_label",
        at_least(F.col("churn_probability"), CHURN_LEVELS).alias("churn_risk_level"),
        F.col("nr_trns").alias("total_txns"),
        F.col("val_trns").alias("total_spend"),
        "days_since_last",
        "txns_last_3m",
        "txns_prev_3m",
        "active_months",
        "active_destinations",
        "txn_trend",
        *CHURN_PERSON,
    )


# --- lifetime value ---------------------------------------------------------


def clv_training_set(txns, customers, as_of, params, keep_id=False, wide=None):
    """Features from months -18 to -6 and the spend of the last 6 months."""
    wide = customer_activity(txns, as_of, params) if wide is None else wide
    observed = activity_in(wide, "clv_", params.min_model_txns, ["future_spend"])
    key = ["UNIQUE_ID"] if keep_id else []
    return (
        _with_person(observed, customers)
        .na.fill(0, ["future_spend"])
        .select(*key, *CLV_FEATURES, "future_spend")
        .withColumnRenamed("days_since_last", "recency_days")
    )


def clv_features_current(current):
    return current.withColumnRenamed("days_since_last", "recency_days")


_CLV_INPUTS = ["recency_days" if c == "days_since_last" else c for c in CLV_FEATURES]


def fit_clv(training, max_iter=50):
    train, _ = _split(training)
    model = LinearRegression(labelCol="future_spend", maxIter=max_iter, predictionCol="predicted_future_spend")
    return _fitted([*_vectors(_CLV_INPUTS), model], train.na.fill(0, _CLV_INPUTS))


def predict_clv(model, features, customers):
    """The scoring features and demographics with predicted_future_spend."""
    return _scored(model, features, customers, _CLV_INPUTS, CLV_PERSON, ["predicted_future_spend"])


def score_clv(predictions, params, **limits):
    """Predictions floored at zero, capped at the top percentile and cut into tiers.

    `predictions` must be a written table: the cap and the tier limits are selected
    from it before the tiers are assigned by comparison with literals.
    """
    floored = strict_greatest(F.col("predicted_future_spend"), F.lit(0.0))
    valued = predictions.withColumn("_value", floored)
    total, order = valued.count(), ["_value", "UNIQUE_ID"]
    top, ends = max(1, ceil(params.clv_cap_percentile * total)), bucket_ends(total, params.quantiles)
    found = order_statistics(valued, order, [top, *ends], total=total, **limits)
    capped = valued.withColumn("_value", strict_least(F.col("_value"), F.lit(found.get(top, (None,))[0]).cast("double")))
    if max(ends) > top:  # only then does the cap change the order at the end of a tier
        found = order_statistics(capped, order, ends, total=total, **limits)
    tiers = {params.quantiles - i: tier for i, tier in enumerate(CLV_TIERS)}
    quintile = ntile_of(order, ends, found)
    return capped.select(
        "UNIQUE_ID",
        round_half("_value", 2).alias("predicted_clv"),
        F.col("val_trns").alias("historical_spend"),
        "nr_trns",
        "active_months",
        "recency_days",
        "spend_trend",
        lookup_text(quintile, tiers).alias("clv_tier"),
        *CLV_PERSON,
    )


# --- evaluation -------------------------------------------------------------


def squared_distance(a, b):
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda total, squared: total + squared
    )


def _distance(a, b):
    return F.sqrt(squared_distance(a, b))


def davies_bouldin(clustered):
    """Davies-Bouldin index and mean squared distance of clustered vectors.

    Two aggregations over the rows. The centres, one per cluster, go back to the rows
    as literals, and only pairs of centres are compared.
    """
    size = len(SEGMENT_FEATURES)
    rows = clustered.select("centroid_id", vector_to_array("features").alias("x"))
    centres = rows.groupBy("centroid_id").agg(*[F.avg(F.col("x")[i]).alias(f"c{i}") for i in range(size)]).collect()
    centre = F.lit(None).cast("array<double>")
    for row in centres:
        centre = F.when(
            F.col("centroid_id") == row["centroid_id"], F.array(*[F.lit(row[f"c{i}"]) for i in range(size)])
        ).otherwise(centre)
    scatter = (
        rows.withColumn("_d", _distance(F.col("x"), centre))
        .groupBy("centroid_id")
        .agg(F.avg("_d").alias("s"), F.sum(F.col("_d") * F.col("_d")).alias("sq"), F.count("*").alias("n"))
        .withColumn("centre", centre)
    )
    everything = scatter.agg(
        F.collect_list(F.struct("centroid_id", "centre", "s")).alias("cs"),
        ratio(F.sum("sq"), F.sum("n")).alias("mean_squared_distance"),
    )
    one = F.col("one")
    worst = F.array_max(
        F.transform(
            F.filter("cs", lambda c: c["centroid_id"] != one["centroid_id"]),
            lambda c: F.try_divide(one["s"] + c["s"], _distance(one["centre"], c["centre"])),
        )
    )
    return (
        everything.select("mean_squared_distance", "cs", F.explode("cs").alias("one"))
        .withColumn("worst", worst)
        .agg(F.avg("worst").alias("davies_bouldin_index"), F.max("mean_squared_distance").alias("mean_squared_distance"))
    )


def evaluate_clusters(clustered):
    """Davies-Bouldin, mean squared distance and silhouette, one row."""
    silhouette = ClusteringEvaluator(predictionCol="centroid_id", featuresCol="features").evaluate(clustered)
    return davies_bouldin(clustered).withColumn("silhouette", F.lit(silhouette))


def evaluate_churn(model, training):
    """Metrics on the held-out split, one row."""
    _, test = _split(training)
    scored = model.transform(test.na.fill(0, CHURN_FEATURES)).cache()
    try:
        metrics = {}
        for name, metric in {
            "accuracy": "accuracy",
            "precision": "precisionByLabel",
            "recall": "recallByLabel",
            "f1_score": "fMeasureByLabel",
            "log_loss": "logLoss",
        }.items():
            metrics[name] = MulticlassClassificationEvaluator(
                labelCol="churned",
                predictionCol="predicted_label",
                probabilityCol="_probability",
                metricName=metric,
                metricLabel=1.0,
            ).evaluate(scored.withColumn("churned", F.col("churned").cast("double")))
        metrics["roc_auc"] = BinaryClassificationEvaluator(
            labelCol="churned", rawPredictionCol="_score", metricName="areaUnderROC"
        ).evaluate(scored)
    finally:
        scored.unpersist()
    return local_frame(training.sparkSession, [tuple(metrics.values())], list(metrics))


def evaluate_clv(model, training):
    _, test = _split(training)
    scored = model.transform(test.na.fill(0, _CLV_INPUTS))
    metrics = {
        name: RegressionEvaluator(
            labelCol="future_spend", predictionCol="predicted_future_spend", metricName=metric
        ).evaluate(scored)
        for name, metric in {"r2_score": "r2", "mean_absolute_error": "mae"}.items()
    }
    return local_frame(training.sparkSession, [tuple(metrics.values())], list(metrics))


def centroid_table(clustered):
    """Mean of each feature per cluster, in original units."""
    means = clustered.groupBy("centroid_id").agg(
        *[round_half(exact_avg(c), 2).alias(c) for c in SEGMENT_FEATURES]
    )
    return means.unpivot("centroid_id", SEGMENT_FEATURES, "feature", "value")


def centroid_pivot(centroids, k=5):
    """The centroid table with features as rows and clusters as columns."""
    wide = centroids.groupBy("feature").pivot("centroid_id", list(range(1, k + 1))).agg(F.max("value"))
    return wide.withColumnsRenamed({str(i): f"cluster_{i}" for i in range(1, k + 1)})


def fit_checks(churn_model, churn_training, clv_model, clv_training, tolerance=1e-3):
    """Whether the gradient of each fitted loss vanishes on the rows it was fitted on.

    Per model one aggregation: the weighted mean of error x feature for every scaled
    feature and for the intercept.
    """
    train, _ = _split(churn_training)
    churn = churn_model.transform(class_weights(train.na.fill(0, CHURN_FEATURES)))
    churn = churn.select(vector_to_array("features").alias("x"), "_weight", (vector_to_array("_probability")[1] - F.col("churned")).alias("e"))
    train, _ = _split(clv_training)
    clv = clv_model.transform(train.na.fill(0, _CLV_INPUTS)).withColumn("e", F.col("predicted_future_spend") - F.col("future_spend"))
    scale = F.greatest(F.stddev_samp("future_spend"), F.lit(1e-9))
    clv = clv.select(vector_to_array("features").alias("x"), F.lit(1.0).alias("_weight"), "e", "future_spend")

    def optimum(rows, n, unit, name):
        slopes = [F.abs(F.sum(F.col("_weight") * F.col("e") * F.col("x")[i]) / F.sum("_weight") / unit) for i in range(n)]
        slopes.append(F.abs(F.sum(F.col("_weight") * F.col("e")) / F.sum("_weight") / unit))
        return rows.agg((F.greatest(*slopes) < tolerance).alias("at_optimum")).select(F.lit(name).alias("model"), "at_optimum")

    return optimum(churn, len(CHURN_FEATURES), F.lit(1.0), "churn").union(optimum(clv, len(_CLV_INPUTS), scale, "clv"))


def _curve(spark, rows):
    """Iteration, loss and change; at most max_iter rows."""
    step = Window.orderBy("iteration")
    return (
        local_frame(spark, rows, ["iteration", "loss"])
        .withColumn("improvement", round_half(F.col("loss") - F.lag("loss").over(step), 4))
        .withColumn("loss", round_half("loss", 4))
    )


def training_curve(spark, model):
    """Loss per iteration of a fitted churn or lifetime-value pipeline."""
    return _curve(spark, list(enumerate(model.losses)))


def segment_training_curve(scores, k=5, max_iter=20, seed=42):
    """Cost of k clusters before each step of one fit, and after its last."""
    rows = _scaled(scores)
    try:
        costs = lloyd.fit(rows, [k], max_iter, seed).costs.get(k, [])
    finally:
        rows.unpersist()
    return _curve(scores.sparkSession, list(enumerate(costs)))


def _scaled(scores):
    rows = scores.na.fill(0, SEGMENT_FEATURES).select(*SEGMENT_FEATURES)
    return lloyd.prepared(Pipeline(stages=_vectors(SEGMENT_FEATURES)).fit(rows).transform(rows))


def elbow(scores, ks=range(3, 9), max_iter=20, seed=42):
    """Davies-Bouldin index per number of clusters; all are fitted in one loop and discarded."""
    rows = _scaled(scores)
    try:
        found = lloyd.davies_bouldin(rows, lloyd.fit(rows, list(ks), max_iter, seed).centres)
    finally:
        rows.unpersist()
    return local_frame(scores.sparkSession, [(k, *found.get(k, (float("nan"),) * 2)) for k in ks], ["k", "davies_bouldin_index", "mean_squared_distance"])


# --- rules without a model --------------------------------------------------


def churn_rules(txns, customers, as_of, min_txns=2):
    """Five risk levels from recency and quarter-on-quarter counts, whole history."""
    day = F.col("EFF_DATE")
    last = day >= months_before(as_of, 3)
    previous = (day >= months_before(as_of, 6)) & ~last
    seen = (
        txns.groupBy("UNIQUE_ID")
        .agg(
            F.count("*").alias("total_txns"),
            exact_sum("trns_amt").alias("total_spend"),
            F.datediff(F.lit(as_of), F.max("EFF_DATE")).cast("bigint").alias("days_since_last"),
            count_where(last).alias("txns_last_3m"),
            count_where(previous).alias("txns_prev_3m"),
            sum_where(last, "trns_amt").alias("spend_last_3m"),
            sum_where(previous, "trns_amt").alias("spend_prev_3m"),
        )
        .where(F.col("total_txns") >= min_txns)
    )
    days, now, before = F.col("days_since_last"), F.col("txns_last_3m"), F.col("txns_prev_3m")
    level = (
        F.when(days > 180, "Churned")
        .when((days > 90) & (now < before), "High Risk")
        .when((days > 60) | (now < before * 0.5), "Medium Risk")
        .when(now >= before, "Low Risk")
        .otherwise("Stable")
    )
    person = customers.select(
        "UNIQUE_ID", "age", "gender_label", "income_segment", "credit_risk_class", "age_group", "income_group"
    )
    return seen.withColumn("risk_level", level).join(person, "UNIQUE_ID", "left")
