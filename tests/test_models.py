import pytest
from pyspark.sql import functions as F

from spendgrid.functions.labels import CLV_TIERS, SEGMENTS
from spendgrid.operators import ml
from spendgrid.plans import catalog


@pytest.fixture(scope="module")
def w(spark):
    return catalog.warehouse(spark, "/root/testdata/sf0.01", modelled=True)


def test_segments_are_ordered_by_spend(w):
    rows = w.cluster_profiles.orderBy("cluster_id").collect()
    spends = [r["avg_total_spend"] for r in rows]
    assert spends == sorted(spends, reverse=True)
    assert [r["segment_name"] for r in rows] == SEGMENTS[: len(rows)]
    assert w.segments.count() == w.rfm_scores.count()


def test_churn_scores_are_probabilities(w):
    row = w.churn.agg(F.min("churn_probability"), F.max("churn_probability"), F.count("*")).first()
    assert 0 <= row[0] <= row[1] <= 1
    assert row[2] == w.churn_features.count()
    wrong = w.churn.where((F.col("churn_probability") > 0.5001) & (F.col("predicted_label") == 0))
    assert wrong.count() == 0


def test_tiers_are_even_and_ordered(w):
    rows = {r["clv_tier"]: r for r in w.clv.groupBy("clv_tier").agg(F.count("*").alias("n"), F.min("predicted_clv").alias("lo"), F.max("predicted_clv").alias("hi")).collect()}
    assert set(rows) == set(CLV_TIERS)
    assert max(r["n"] for r in rows.values()) - min(r["n"] for r in rows.values()) <= 1
    for better, worse in zip(CLV_TIERS, CLV_TIERS[1:]):
        assert rows[better]["lo"] >= rows[worse]["hi"]
    assert min(r["lo"] for r in rows.values()) >= 0


def test_davies_bouldin_matches_a_direct_computation(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    size = len(ml.SEGMENT_FEATURES)
    points = np.concatenate([rng.normal(c, 1.0, (20, size)) for c in (0, 4, 9)])
    labels = np.repeat([0, 1, 2], 20)
    df = spark.createDataFrame(
        [(int(k), Vectors.dense(x)) for k, x in zip(labels, points)], ["centroid_id", "features"]
    )
    centres = np.array([points[labels == k].mean(axis=0) for k in range(3)])
    spreads = [np.linalg.norm(points[labels == k] - centres[k], axis=1).mean() for k in range(3)]
    worst = [
        max((spreads[i] + spreads[j]) / np.linalg.norm(centres[i] - centres[j]) for j in range(3) if j != i)
        for i in range(3)
    ]
    assert ml.davies_bouldin(df).first()["davies_bouldin_index"] == pytest.approx(np.mean(worst))


def test_class_weights_balance(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "churned int")
    sums = {r["churned"]: r["w"] for r in ml.class_weights(df).groupBy("churned").agg(F.sum("_weight").alias("w")).collect()}
    assert sums == {0: 2.0, 1: 2.0}


def test_curve_and_split(w):
    curve = ml.training_curve(w.spark, w.model("churn")).orderBy("iteration").collect()
    assert curve[0]["improvement"] is None and curve[-1]["loss"] <= curve[0]["loss"]
    train, test = ml._split(w.churn_training)
    assert train.count() + test.count() == w.churn_training.count()


def plain_lloyd(x, centres, steps):
    import numpy as np

    costs = []
    for _ in range(steps):
        distances = ((x[:, None, :] - centres[None]) ** 2).sum(2)
        own = distances.argmin(1)
        costs.append(distances.min(1).sum())
        centres = np.array([x[own == i].mean(0) if (own == i).any() else c for i, c in enumerate(centres)])
    return costs


def test_all_k_in_one_loop_equal_plain_steps(spark):
    import numpy as np
    from pyspark.ml.linalg import Vectors

    from spendgrid.operators import lloyd

    rng = np.random.default_rng(3)
    points = np.concatenate([rng.normal(c, 2.5, (150, 9)) for c in (0, 4, 9)])
    df = spark.createDataFrame([(Vectors.dense(x),) for x in points], ["features"]).repartition(3)
    rows = lloyd.prepared(df)
    # The first centres are those of the loop without a step.
    start = lloyd.fit(rows, [2, 3, 5], max_iter=0, seed=1).centres
    trace = lloyd.fit(rows, [2, 3, 5], max_iter=12, seed=1)
    for k, costs in trace.costs.items():
        assert costs == pytest.approx(plain_lloyd(points, start[k], len(costs)))
        assert all(b <= a * (1 + 1e-12) for a, b in zip(costs, costs[1:])) and len(costs) <= 13
    found = lloyd.davies_bouldin(rows, trace.centres)
    for k, centres in trace.centres.items():
        own = ((points[:, None, :] - centres[None]) ** 2).sum(2).argmin(1)
        clustered = spark.createDataFrame([(int(c), Vectors.dense(x)) for c, x in zip(own, points)], ["centroid_id", "features"])
        want = ml.davies_bouldin(clustered).first()
        assert found[k] == pytest.approx((want["davies_bouldin_index"], want["mean_squared_distance"]))
    rows.unpersist()


def test_repeated_points_and_no_points(spark):
    from pyspark.ml.linalg import Vectors

    from spendgrid.operators import lloyd

    same = lloyd.prepared(spark.createDataFrame([(Vectors.dense([1.0, 2.0]),)] * 7, ["features"]))
    assert lloyd.fit(same, [3]).costs == {3: [0.0]}
    assert lloyd.davies_bouldin(same, lloyd.fit(same, [3]).centres) == {3: (None, 0.0)}
    none = same.where("false")
    assert lloyd.fit(none, [2]).costs == {}
