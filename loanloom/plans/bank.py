"""The bank of the driver tables: all relations, wired together.

Stages follow the life of a batch run: customers, features, value and segments
are written once per application as Parquet in the shared checkpoint folder and
read by everything after them, as a nightly run would do.  All else is a lazy
plan.  Fitted parameters (score range, label cuts, quartiles) are a few numbers.
"""

from __future__ import annotations

import datetime
import functools
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.operators import book, clv, features, forecast, models, scoring, segments
from loanloom.operators.kmeans import Centres
from loanloom.session import limit_methods, materialise
from loanloom.sources import bank_views

TIE_BREAK = ["o_orderkey"]

# Segment centres in standardised space, in the order of the clustering inputs.
CENTROIDS = {
    0: [0.8, 0.8, -0.2, 0.2, -0.3, 0.0, 0.0, 0.2, 0.0, 1.2, -0.9],
    1: [-0.8, -0.6, 0.3, -0.2, 0.4, 0.0, 0.0, -0.1, -0.1, -0.6, 1.0],
    2: [0.3, -0.2, -0.2, 0.3, -0.3, -0.4, -0.4, 0.2, 0.1, -0.2, -0.3],
    3: [-0.1, 0.0, 0.1, -0.2, 0.1, 0.8, 0.8, -0.8, 0.0, -0.1, 0.1],
}

_banks: dict[tuple[str, str], "Bank"] = {}


def kept(method):
    """Build a relation or a fitted parameter once per bank."""
    @functools.wraps(method)
    def once(self):
        with self._lock:
            if method.__name__ not in self._kept:
                self._kept[method.__name__] = method(self)
            return self._kept[method.__name__]
    return once


class Bank:
    """Relations of one table folder in one application."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        limit_methods(spark)
        self.tables = bank_views.DriverTables(spark, sf_dir)
        self._kept: dict[str, object] = {}
        # Reports may be asked for from several threads; a stage is still built once.
        self._lock = threading.RLock()

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Bank":
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in _banks or _banks[key].spark is not spark:
            _banks[key] = cls(spark, sf_dir)
        return _banks[key]

    def _stage(self, df: DataFrame, name: str) -> DataFrame:
        """Write a table of one row per customer, bucketed like all the others."""
        return materialise(df, f"loanloom_{name}", "customer_id", self.size())

    @kept
    def size(self) -> int:
        return self.tables("customer").count()

    # -- base tables ----------------------------------------------------------

    @kept
    def people(self) -> DataFrame:
        """Customers without a label, with their raw risk score (stage output)."""
        base = bank_views.customers(self.tables)
        return self._stage(base.withColumn("raw_score", scoring.raw_risk()), "customers")

    def unlabelled(self) -> DataFrame:
        return self.people().drop("raw_score")

    @kept
    def repayments(self) -> DataFrame:
        return bank_views.repayments(self.tables)

    def transactions(self, *columns: str) -> DataFrame:
        return bank_views.transactions(self.tables, columns or bank_views.TRANSACTION_COLUMNS)

    @kept
    def spending(self) -> DataFrame:
        """Transactions without the category, which the features do not read."""
        return self.transactions("customer_id", "transaction_date", "amount", "transaction_type")

    @kept
    def latest_date(self) -> datetime.date:
        return features.latest_date(self.transactions("transaction_date"))

    # -- score and label --------------------------------------------------------

    @kept
    def risk_scale(self) -> scoring.RiskScale:
        return scoring.fit_risk_scale(self.people(), F.col("raw_score"))

    @kept
    def scored(self) -> DataFrame:
        return self.people().withColumn("risk_score", scoring.risk_score(self.risk_scale(), F.col("raw_score")))

    @kept
    def label_cuts(self) -> scoring.LabelCuts:
        return scoring.fit_label_cuts(self.scored())

    @kept
    def customers(self) -> DataFrame:
        """Customers with ``risk_score`` and ``defaulted``; the coin is the parity of the key."""
        label = scoring.default_label(F.col("risk_score"), self.label_cuts(), F.col("c_custkey") % 2)
        return self.scored().withColumn("defaulted", label).drop("c_custkey", "raw_score")

    @kept
    def risk(self) -> DataFrame:
        return scoring.assign_risk_tiers(self.customers(), "risk_score")

    # -- value ------------------------------------------------------------------

    @kept
    def clv_values(self) -> DataFrame:
        """Estimated value per customer (stage output)."""
        return self._stage(clv.estimate_clv(self.customers(), self.risk()), "clv")

    @kept
    def clv_cuts(self) -> list[float]:
        return clv.fit_clv_cuts(self.clv_values())

    @kept
    def clv(self) -> DataFrame:
        return clv.with_clv_tier(self.clv_values(), self.clv_cuts())

    # -- features and segments ---------------------------------------------------

    @kept
    def levels(self) -> dict[str, list[str]]:
        return features.fit_levels(self.unlabelled())

    @kept
    def build_features(self) -> DataFrame:
        """The feature build itself, from the tables."""
        return features.customer_features(self.customers().drop("risk_score"), self.repayments(),
                                          self.spending(), TIE_BREAK, self.latest_date())

    @kept
    def features(self) -> DataFrame:
        """One row of features per customer (stage output)."""
        return self._stage(self.build_features(), "features")

    @kept
    def matrix(self) -> DataFrame:
        return features.one_hot(self.features(), self.levels())

    @kept
    def cluster_inputs(self) -> DataFrame:
        return segments.cluster_inputs(self.features(), self.clv_values(), self.risk())

    @kept
    def scaler(self) -> segments.Scaler:
        return segments.fit_scaler(self.cluster_inputs())

    @kept
    def segmented(self) -> DataFrame:
        """Clustering inputs and label with the nearest segment (stage output)."""
        segment = segments.nearest_centroid_column(self.scaler(), CENTROIDS)
        wanted = dict.fromkeys(["customer_id", *segments.CLUSTER_FEATURES, "defaulted"])
        return self._stage(self.cluster_inputs().select(*wanted, segment.alias("segment")), "segments")

    @kept
    def segments(self) -> DataFrame:
        return self.segmented().select("customer_id", "segment")

    @kept
    def vectors(self) -> DataFrame:
        return segments.standardised_vectors(self.cluster_inputs(), self.scaler())

    # -- revenue series ----------------------------------------------------------------

    def build_revenue(self, *by: str) -> DataFrame:
        """Monthly revenue straight from the transactions."""
        rows = self.transactions("transaction_date", "amount", "transaction_type", *by)
        return forecast.monthly_revenue(rows, by)

    @kept
    def kmeans(self) -> Centres:
        return segments.fit_kmeans(self.vectors())[0]

    @kept
    def revenue(self) -> DataFrame:
        """Monthly revenue (stage output: a few rows that forecasts read many times)."""
        return materialise(self.build_revenue(), "revenue")

    @kept
    def category_revenue(self) -> DataFrame:
        """Monthly revenue per category (stage output)."""
        return materialise(self.build_revenue("category"), "category_revenue")

    # -- the 360 view -------------------------------------------------------------

    @kept
    def book(self) -> DataFrame:
        return book.customer_360(self.customers().drop("risk_score"), self.risk(), self.clv())

    @kept
    def segmented_book(self) -> DataFrame:
        return book.customer_360(self.book(), segments=self.segments())

    # -- trained models -------------------------------------------------------------

    @kept
    def training(self) -> tuple[DataFrame, list[str]]:
        return models.training_set(self.matrix())

    def trained(self, name: str):
        """A model fitted on the training rows, kept for the reports that read it."""
        with self._lock:
            if name not in self._kept:
                data, inputs = self.training()
                train = data.where(F.col("split") == "train")
                self._kept[name] = models.fit(models.estimators(inputs, train.count())[name], train)
            return self._kept[name]

    @kept
    def comparison(self) -> DataFrame:
        """The three models compared, with five folds each (a few rows)."""
        data, inputs = self.training()
        return models.compare(data, inputs, fitted=self.trained)[0]
