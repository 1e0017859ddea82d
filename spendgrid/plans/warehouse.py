"""The table graph: raw tables -> staged -> features -> marts.

Tables are written once to the shared folder and read back, so downstream tables and
reports scan a pruned Parquet table instead of repeating the joins, and a lost
executor costs a re-read, not a recomputation. Views and reports stay lazy.
"""

import hashlib
import threading
import uuid

from pyspark.sql import functions as F

from spendgrid.functions.dialect import count_where, distinct_months, round_half
from spendgrid.operators import audiences, features, marts, ml, staging
from spendgrid.params import Params
from spendgrid.session import release, shared_folder, written_once
from spendgrid.sources.tables import Watch, bucketed_name, delete, extent, write_bucketed, write_table

# Written tables: name -> (partition columns, cluster columns).
_MERCHANT = ([], ["CATEGORY_TWO", "DESTINATION"])
_PLAIN = ([], [])
STORED = {
    "transactions": (["txn_month"], ["CATEGORY_TWO", "DESTINATION"]),
    "customers": ([], ["income_segment", "gender"]),
    "rfm_features": _PLAIN,
    "customer_category_spend": _MERCHANT,
    "rfm_scores": _PLAIN,
    "merchant_totals": _PLAIN,
    "destination_metrics": _MERCHANT,
    "churn_training": _PLAIN,
    "customer_activity": _PLAIN,
    "clv_training": _PLAIN,
    "segments": ([], ["segment_name"]),
    "churn": ([], ["churn_risk_level"]),
    "clv_predictions": _PLAIN,
    "clv": ([], ["clv_tier"]),
    "cluster_profiles": _PLAIN,
    "cluster_summary": _PLAIN,
    "behavioral_summary": _PLAIN,
    "geo_summary": ([], ["PROVINCE", "CATEGORY_TWO"]),
    # small enough that one folder per month would only make tiny files
    "monthly_trends": ([], ["month", "CATEGORY_TWO", "DESTINATION"]),
    "demographic_summary": ([], ["CATEGORY_TWO"]),
    "cohort_retention": _PLAIN,
    "category_affinity": _PLAIN,
    "churn_rules": ([], ["risk_level"]),
    "momentum": ([], ["momentum_status"]),
    "category_propensity": ([], ["CATEGORY_TWO"]),
    "store_loyalty": _PLAIN,
    "store_time_patterns": _PLAIN,
    "client_segment_mix": _MERCHANT,
    "category_scorecard": _PLAIN,
    "pitch_opportunities": _PLAIN,
    "churn_explained": ([], ["churn_risk_level"]),
    "audience_members": ([], ["audience_id"]),
    "audience_catalog": _PLAIN,
    "audience_client_overlap": _MERCHANT,
}
# Tables with rows per customer that others join on the customer: dealt into buckets by it.
CUSTOMER = "UNIQUE_ID"
BUCKETED = {
    "customers",
    "rfm_features",
    "customer_category_spend",
    "rfm_scores",
    "customer_activity",
    "segments",
    "churn",
    "clv",
    "momentum",
    "audience_members",
}
# Conditions whose rows are counted while a table is written.
WATCHED = {
    "segments": {"unnamed": "segment_name IS NULL", "without_age": "age IS NULL"},
    # The benchmarks are the merchants with spend.
    "destination_metrics": {"benchmarks": "total_spend > 0", "without_share": "total_spend > 0 AND market_share_pct IS NULL"},
    "clv": {"negative": "predicted_clv < 0"},
}
# Where the stored transactions take so many bytes, the shuffle files of a table go once it is written.
RELEASE_BYTES = 32 << 20
TREND_MONTHS = 1200  # months of trends that are told apart, back from the newest day
_BUILT, _MEASURED = {}, {}
# Threads of a session share the tables: the first that asks for one builds it, others wait for it.
_LOCKS = {}
# Application ids tell seconds apart at best, so sessions that share a folder may have the same.
_PROCESS = uuid.uuid4().hex[:12]


class Warehouse:
    """Derived tables of one set of raw tables, by name.

    `raw` is a callable returning RawTables and `key` names the source, usually its
    folder: derived tables are shared between warehouses of the same folder as long as
    its files stay as they are. With modelled=False the segment, churn and value tables come from fixed
    formulas in place of fitted models, which makes every table reproducible in plain
    SQL; with modelled=True models are fitted.
    """

    def __init__(self, spark, key, raw, params=None, modelled=False):
        self.spark = spark
        self.folder = key
        self.params = params or Params()
        self.modelled = modelled
        self._raw_source = raw
        self._raw = None
        self._lazy = {}
        self._scratch = []
        app = spark.sparkContext.applicationId
        # The staged and feature tables do not depend on the models; other files, or the
        # same files changed, are another source.
        self._base = f"{app}-{_PROCESS}/{_digest(key, state_of(spark, key), self.params)}"
        self._root = shared_folder(spark)

    @property
    def raw(self):
        if self._raw is None:
            self._raw = self._raw_source()
        return self._raw

    @property
    def as_of(self):
        slot = (self._root, self._base, "as_of")
        with _lock(slot):
            if slot not in _BUILT:
                _BUILT[slot] = staging.date_bounds(self.table("transactions"))
            return _BUILT[slot]

    def __getattr__(self, name):
        if name.startswith("_") or not hasattr(type(self), f"_build_{name}"):
            raise AttributeError(name)
        return self.table(name)

    def table(self, name):
        if name not in STORED:
            if name not in self._lazy:
                self._lazy[name] = getattr(self, f"_build_{name}")()
            return self._lazy[name]
        slot = self._slot(name)
        with _lock(slot):
            if not self._stands(slot):
                self.store_in(name, f"{self._root}/spendgrid/{self._base}/{slot[2]}/{name}")
            path, schema, _ = _BUILT[slot]
        if name in BUCKETED:
            return self.spark.table(bucketed_name(path))
        return self.spark.read.schema(schema).parquet(path)

    def _slot(self, name):
        variant = "modelled" if self.modelled and name in _MODEL_TABLES else "fixed"
        return (self._root, self._base, variant, name)

    def _stands(self, slot):
        """Whether a stored table is there as it was written; one that has lost files or its catalog entry is built again."""
        if slot in _BUILT:
            (path, _, written), name = _BUILT[slot], slot[-1]
            listed = name not in BUCKETED or self.spark.catalog.tableExists(bucketed_name(path))
            if not (listed and extent(self.spark, path) == written):
                del _BUILT[slot]
        return slot in _BUILT

    def store_in(self, name, path):
        """Build a stored table into path, or copy it there when it stands elsewhere already."""
        slot = self._slot(name)
        with _lock(slot):
            stands = self._stands(slot)
            if stands and _BUILT[slot][0] == path:
                return
            parts = [self.table(name)] if stands else getattr(self, f"_parts_of_{name}", lambda: [getattr(self, f"_build_{name}")()])()
            measured = []
            while parts:
                built, watch = parts.pop(0), Watch(**self._metrics_of(name))
                if name in BUCKETED:
                    stored = write_bucketed(built, path, CUSTOMER, self.params.customer_buckets, STORED[name][1], watch=watch)
                else:
                    stored = write_table(built, path, *STORED[name], mode="append" if measured else "overwrite", watch=watch)
                measured.append(watch.values())
                if parts:  # the shuffle files of a part go before the next one's come
                    del built
                    release(self.spark)
            _BUILT[slot] = (path, stored.schema, extent(self.spark, path))
            _MEASURED[slot] = measured[0] if len(measured) == 1 else {m: sum(x[m] for x in measured) for m in measured[0]}
            del built
            if self._is_large():
                release(self.spark)

    def _is_large(self):
        """Whether shuffle files are worth a collection of the driver's garbage."""
        slot = self._slot("transactions")
        return slot in _BUILT and _BUILT[slot][2][1] >= RELEASE_BYTES

    def _metrics_of(self, name):
        """What is measured while a table is written, besides its rows."""
        if name == "monthly_trends":
            return {"months": distinct_months("month", F.lit(self.as_of), TREND_MONTHS)}
        return {metric: count_where(F.expr(condition)) for metric, condition in WATCHED.get(name, {}).items()}

    def measures(self, name):
        """The metrics of a stored table, as they were when it was written."""
        self.table(name)
        return _MEASURED[self._slot(name)]

    def scratch(self, name):
        """Folder in the shared folder for files of one query, until it is finished()."""
        self._scratch.append(f"{self._root}/spendgrid/{self._base}/scratch/{name}")
        return self._scratch[-1]

    def finished(self, result):
        """The result of a query; if it has written scratch files, it is stored and they go."""
        if self._scratch:
            result = written_once(result)
        while self._scratch:
            delete(self.spark, self._scratch.pop())
        return result

    def model(self, name):
        slot = (self._root, self._base, "model", name)
        with _lock(slot):
            if slot not in _BUILT:
                _BUILT[slot] = getattr(self, f"_fit_{name}")()
            return _BUILT[slot]

    # staged tables and features

    def _build_transactions(self):
        return staging.stage_transactions(self.raw.transactions, self.raw.lookups)

    def _parts_of_transactions(self):
        return [staging.stage_transactions(part, self.raw.lookups) for part in self.raw.parts()]

    def _build_customers(self):
        return staging.stage_customers(self.raw.snapshots)

    def _build_customer_category_spend(self):
        return features.customer_category_spend(
            self.transactions, self.as_of, self.params.window_months
        )

    def _build_merchant_totals(self):
        return features.merchant_totals(self.customer_category_spend)

    def _build_destination_metrics(self):
        return features.destination_metrics(self.merchant_totals, self.customer_category_spend)

    def _build_rfm_features(self):
        p = self.params
        return features.rfm_features(
            self.transactions, self.as_of, p.window_months, p.min_feature_txns, p.median_accuracy
        )

    def _build_rfm_scores(self):
        return features.rfm_scores(self.rfm_features, self.params.quantiles)

    # models and the tables they feed

    def _fit_segments(self):
        p = self.params
        return ml.fit_segments(self.rfm_scores, p.segments, p.kmeans_iterations, p.seed)

    def _fit_churn(self):
        return ml.fit_churn(self.churn_training, self.params.model_iterations)

    def _fit_clv(self):
        return ml.fit_clv(self.clv_training, self.params.model_iterations)

    def _build_customer_activity(self):
        return ml.customer_activity(self.transactions, self.as_of, self.params)

    def _build_churn_training(self):
        return ml.churn_training_set(
            self.transactions, self.customers, self.as_of, self.params, wide=self.customer_activity
        )

    def _build_clv_training(self):
        return ml.clv_training_set(
            self.transactions, self.customers, self.as_of, self.params, wide=self.customer_activity
        )

    def _build_activity_current(self):
        return ml.activity_current(self.transactions, self.as_of, self.params, wide=self.customer_activity)

    def _build_churn_features(self):
        return ml.churn_features_current(self.activity_current)

    def _build_clv_features(self):
        return ml.clv_features_current(self.activity_current)

    def _build_clustered(self):
        if self.modelled:
            return ml.cluster(self.model("segments"), self.rfm_scores)
        return self.rfm_scores.withColumn("centroid_id", F.col("m_score"))

    def _build_segments(self):
        return ml.assign_segments(self.clustered, self.customers)

    def _build_churn(self):
        scored = self.churn_features
        if self.modelled:
            predictions = ml.predict_churn(self.model("churn"), scored, self.customers)
        else:
            predictions = recency_as_churn(ml.attach_person(scored, self.customers, ml.CHURN_PERSON))
        return ml.score_churn(predictions)

    def _build_clv_predictions(self):
        if self.modelled:
            return ml.predict_clv(self.model("clv"), self.clv_features, self.customers)
        return ml.attach_person(self.clv_features, self.customers, ml.CLV_PERSON).withColumn(
            "predicted_future_spend", F.col("val_trns") / F.lit(2.0) - F.lit(2000.0)
        )

    def _build_clv(self):
        return ml.score_clv(self.clv_predictions, self.params)

    # summary tables

    def _build_cluster_profiles(self):
        return marts.cluster_profiles(self.segments)

    def _build_cluster_summary(self):
        return marts.cluster_summary(self.cluster_profiles)

    def _build_behavioral_summary(self):
        return marts.behavioral_summary(self.transactions, self.segments)

    def _build_geo_summary(self):
        return marts.geo_summary(self.transactions)

    def _build_monthly_trends(self):
        return marts.monthly_trends(self.transactions)

    def _build_demographic_summary(self):
        return marts.demographic_summary(self.customer_category_spend, self.customers)

    def _build_benchmarks(self):
        return marts.destination_benchmarks(self.destination_metrics)

    def _build_cohort_retention(self):
        return marts.cohort_retention(self.transactions, self.params.retention_horizon)

    def _build_category_affinity(self):
        p = self.params
        return marts.category_affinity(self.transactions, self.as_of, p.window_months, p.min_shared_customers)

    def _build_category_scorecard(self):
        return marts.category_scorecard(
            self.transactions, self.customer_category_spend, self.benchmarks, self.churn, self.segments, self.as_of
        )

    def _build_pitch_opportunities(self):
        return marts.pitch_opportunities(self.benchmarks, self.customer_category_spend, self.churn)

    def _build_churn_explained(self):
        return marts.churn_explained(self.churn)

    def _build_churn_rules(self):
        return ml.churn_rules(self.transactions, self.customers, self.as_of, self.params.min_feature_txns)

    def _build_momentum(self):
        p = self.params
        return marts.spend_momentum(
            self.transactions, self.customers, self.as_of, p.window_months, p.min_momentum_months
        )

    def _build_category_propensity(self):
        p = self.params
        return marts.category_propensity(
            self.transactions,
            self.segments,
            self.customer_category_spend,
            self.as_of,
            p.window_months,
            p.max_adoption_pct,
        )

    def _build_store_loyalty(self):
        return marts.store_loyalty(
            self.customer_category_spend, self.params.min_store_customers
        )

    def _build_store_time_patterns(self):
        p = self.params
        return marts.store_time_patterns(self.transactions, self.as_of, p.window_months, p.min_store_txns)

    def _build_client_segment_mix(self):
        return marts.client_segment_mix(
            self.customer_category_spend, self.segments, self.params.min_client_customers
        )

    def _build_audience_members(self):
        return audiences.audience_members(
            self.customers,
            self.customer_category_spend,
            self.segments,
            self.churn,
            self.rfm_features,
            self.momentum,
            self.transactions,
            self.as_of,
            self.params,
        )

    def _build_audience_catalog(self):
        return audiences.audience_catalog(
            self.audience_members,
            self.customers,
            self.rfm_features,
            self.segments,
            self.churn,
            self.params.min_audience_size,
        )

    def _build_audience_client_overlap(self):
        return audiences.audience_client_overlap(
            self.customer_category_spend,
            self.audience_members,
            self.audience_catalog,
            self.params.min_client_customers,
        )


# Tables that differ between fitted models and fixed formulas.
_MODEL_TABLES = {
    "segments",
    "churn",
    "clv_predictions",
    "clv",
    "cluster_profiles",
    "cluster_summary",
    "behavioral_summary",
    "category_propensity",
    "client_segment_mix",
    "category_scorecard",
    "pitch_opportunities",
    "churn_explained",
    "audience_members",
    "audience_catalog",
    "audience_client_overlap",
}


def build_all(warehouse, folder, tables=tuple(STORED)):
    """Write every table under folder, in dependency order; returns name -> path.

    Each table is written once, to its place there, and tables that need it read it from there.
    """
    for name in tables:
        warehouse.store_in(name, f"{folder}/{name}")
    return {name: f"{folder}/{name}" for name in tables}


def recency_as_churn(features):
    """Churn scores without a model: days since the last purchase over a year."""
    probability = round_half(F.least(F.col("days_since_last"), F.lit(365)) / F.lit(365.0), 4)
    return features.select(
        "*",
        probability.alias("churn_probability"),
        F.when(probability >= 0.5, 1).otherwise(0).cast("bigint").alias("predicted_label"),
    )


def state_of(spark, folder):
    """Names, sizes and times of the files in a folder; empty if it is no folder."""
    top = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = top.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(top):
        return ()
    found, listed = [], files.listFiles(top, True)
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def _lock(slot):
    """Lock of one stored table or value; a build takes those of what it reads, which never lead back to it."""
    return _LOCKS.setdefault(slot, threading.RLock())


def _digest(*parts):
    return hashlib.sha256(repr(parts).encode()).hexdigest()[:16]


