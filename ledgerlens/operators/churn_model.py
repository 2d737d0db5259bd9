"""Churn model (H7-H14) on Spark ML.

The reference trains a scikit-learn random forest on one machine. Here the
same feature set goes through Spark ML stages (distributed training and
scoring):

* H7  favourites encoded by sorted label order (``StringIndexer``,
  ``alphabetAsc``), fitted once and reused for scoring;
* H8  a deterministic stratified 80/20 split with the stratified-split
  class sizes; rows are chosen by a seeded hash of the customer key
  (no class is ranked on one task);
* H9  ``RandomForestClassifier`` (100 trees, depth 8, seed 42) with
  balanced class weights ``n / (2 * n_class)`` from the training split;
* H10 accuracy and exact ROC-AUC (rank sums) on the held-out split;
* H11 feature importances; H12-H14 probabilities, risk levels, top risks.

Random streams differ from scikit-learn, so only the shape, ranges and
determinism of the outputs are checked, not value parity.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens import schema as S
from ledgerlens.functions.labels import risk_level
from ledgerlens.session import scratch_path
from ledgerlens.sources import files

SEED = 42
TRAIN_FRACTION = 0.8
# Ranges of scores in which negatives are ranked side by side.
AUC_BUCKETS = 4096


@dataclass
class ChurnModel:
    model: PipelineModel
    features: tuple[str, ...]
    train_rows: int
    test_rows: int


def stratified_sizes(class_counts: dict[int, int], test_fraction: float = 1 - TRAIN_FRACTION) -> dict[int, int]:
    """Training rows per class, by the stratified-split rule.

    n_test = ceil(test_fraction * n); each class gets floor(n_c * n_train / n)
    training rows, and the rows still missing go to the largest remainders
    (ties: smaller class label first).
    """
    n = sum(class_counts.values())
    if n == 0:
        return {c: 0 for c in class_counts}
    n_train = n - math.ceil(test_fraction * n)
    exact = {c: k * n_train / n for c, k in class_counts.items()}
    sizes = {c: math.floor(v) for c, v in exact.items()}
    left = n_train - sum(sizes.values())
    for c in sorted(exact, key=lambda c: (-(exact[c] - sizes[c]), c))[:left]:
        sizes[c] += 1
    return sizes


def split(features: DataFrame, seed: int = SEED, train_fraction: float = TRAIN_FRACTION) -> DataFrame:
    """H8: add ``is_train``: per class, the ``stratified_sizes`` rows with the smallest seeded hash.

    Exact class sizes without ranking a class on one task: a histogram of the
    hash's top 16 bits per class (at most 2 x 65,536 rows) locates the bucket
    holding each class's cut, and only that bucket's hashes are ranked.
    Give it a written table: ``features`` is read three times.
    """
    spark = features.sparkSession
    h = features.withColumn("_h", F.xxhash64("customer_email", F.lit(seed))).withColumn("_b", F.shiftright("_h", 48))
    hist = files.scratch_table(h.groupBy("churned", "_b").agg(F.count(F.lit(1)).alias("c")), "churn_histogram")
    # one row per class
    counts = {r["churned"]: r["n"] for r in hist.groupBy("churned").agg(F.sum("c").alias("n")).collect()}
    sizes = stratified_sizes(counts, 1 - train_fraction)
    want = spark.createDataFrame([(c, int(k)) for c, k in sizes.items()], "churned int, k long")
    w = Window.partitionBy("churned").orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("cum", F.sum("c").over(w)).join(F.broadcast(want), "churned")
    cut = hist.where(F.col("cum") >= F.col("k")).groupBy("churned").agg(
        F.min_by("_b", "_b").alias("cut_b"), F.min_by(F.col("cum") - F.col("c"), "_b").alias("below"), F.first("k").alias("k")
    )
    inside = h.join(F.broadcast(cut), "churned").where(F.col("_b") == F.col("cut_b")).select("churned", "_h", "below", "k")
    w2 = Window.partitionBy("churned").orderBy("_h")  # one 2^-16 slice of one class
    last = inside.withColumn("r", F.row_number().over(w2) + F.col("below")).where(F.col("r") == F.col("k"))
    thr = last.select("churned", F.col("_h").alias("cut_h")).join(cut.select("churned", "cut_b"), "churned")
    out = h.join(F.broadcast(thr), "churned", "left")
    is_train = (F.col("_b") < F.col("cut_b")) | ((F.col("_b") == F.col("cut_b")) & (F.col("_h") <= F.col("cut_h")))
    return out.withColumn("is_train", F.coalesce(is_train, F.lit(False))).drop("_h", "_b", "cut_b", "cut_h")


def with_class_weights(train: DataFrame) -> DataFrame:
    """Balanced weights ``n / (2 * n_class)`` computed on the training split (two-row table)."""
    counts = train.groupBy("churned").agg(F.count(F.lit(1)).alias("n_class"))
    total = counts.agg(F.sum("n_class").alias("n"))
    w = counts.crossJoin(total).select("churned", (F.col("n") / (2.0 * F.col("n_class"))).alias("w"))
    return train.join(F.broadcast(w), "churned")  # at most two rows (one per class)


def build_model(features: tuple[str, ...] = S.CHURN_FEATURES, num_trees: int = 100, max_depth: int = 8, seed: int = SEED) -> Pipeline:
    stages = [
        StringIndexer(inputCol="fav_category", outputCol="fav_category_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        StringIndexer(inputCol="fav_region", outputCol="fav_region_index", stringOrderType="alphabetAsc", handleInvalid="keep"),
        # plain numbers: without the nominal attribute, trees split them as such and any number of categories will do
        SQLTransformer(statement="SELECT *, fav_category_index + 0D AS fav_category_enc, fav_region_index + 0D AS fav_region_enc FROM __THIS__"),
        VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep"),
        RandomForestClassifier(
            featuresCol="features",
            labelCol="label",
            weightCol="w",
            numTrees=num_trees,
            maxDepth=max_depth,
            seed=seed,
        ),
    ]
    return Pipeline(stages=stages)


def _prepared(features: DataFrame) -> DataFrame:
    return features.withColumn("label", F.col("churned").cast("double"))


def train(
    features: DataFrame,
    feature_cols: tuple[str, ...] = S.CHURN_FEATURES,
    num_trees: int = 100,
    max_depth: int = 8,
    model_dir: str | None = None,
) -> tuple[ChurnModel, DataFrame]:
    """H7-H9: fit the model stages on the training split; returns the model and the held-out rows.

    Give it a written table (``files.scratch_table``). The split is written
    once, and every pass of the fit and the evaluation reads that table.
    """
    data = files.scratch_table(split(_prepared(features)), "churn_split")
    sizes = {r["is_train"]: r["count"] for r in data.groupBy("is_train").count().collect()}
    tr = with_class_weights(data.where("is_train"))
    te = data.where(~F.col("is_train")).withColumn("w", F.lit(1.0))
    fitted = build_model(feature_cols, num_trees, max_depth).fit(tr)
    # Persist the fitted model to shared storage and score with the loaded
    # copy: the artifact survives the driver, and a loaded model carries no
    # training summary (whose session reference cannot be shipped to tasks).
    path = model_dir or scratch_path(features.sparkSession, f"churn_model_{uuid.uuid4().hex[:12]}")
    fitted.write().overwrite().save(path)
    model = PipelineModel.load(path)
    return ChurnModel(model, feature_cols, sizes.get(True, 0), sizes.get(False, 0)), te


def rank_auc(scored: DataFrame, score_col: str = "score", label_col: str = "label") -> DataFrame:
    """One row, ``auc``: the exact area under the ROC curve by rank sums (Mann-Whitney), equal scores at their mid-rank.

    Rows are counted per distinct score and label first. The negatives below
    a score are a running sum inside one of ``AUC_BUCKETS`` ranges of scores,
    plus those of the lower ranges; so no task orders all scores. NULL with
    one class only. Scores are in [0, 1].
    """
    positive = F.col(label_col) == 1
    counted = scored.where(F.col(score_col).isNotNull() & F.col(label_col).isNotNull()).groupBy(F.col(score_col).cast("double").alias("s"))
    counted = counted.agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
    counted = counted.withColumn("bucket", F.floor(F.col("s") * AUC_BUCKETS))
    below = Window.partitionBy("bucket").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    placed = counted.withColumn("before", F.coalesce(F.sum("neg").over(below), F.lit(0)))
    # wins of the positives over negatives of their own bucket (halves for ties), a row per bucket
    wins = F.sum(F.col("pos") * (F.col("before") + F.col("neg") / 2))
    buckets = placed.groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), wins.alias("wins"))
    lower = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = buckets.withColumn("before", F.coalesce(F.sum("neg").over(lower), F.lit(0)))
    total = F.sum(F.col("wins") + F.col("pos") * F.col("before"))
    return buckets.agg(F.try_divide(total, (F.sum("pos") * F.sum("neg")).cast("double")).alias("auc"))


def evaluate(cm: ChurnModel, test: DataFrame, spark: SparkSession) -> DataFrame:
    """Accuracy and ROC-AUC in % (2 decimals; AUC NULL with one class only) plus split sizes, one row."""
    pred = cm.model.transform(test).select("label", "prediction", vector_to_array("probability")[1].alias("score"))
    pred = files.scratch_table(pred, "churn_evaluation")
    hits = pred.agg(F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"))
    return hits.crossJoin(rank_auc(pred)).select(
        F.bround(F.col("accuracy") * 100, 2).alias("accuracy_pct"),
        F.bround(F.col("auc") * 100, 2).alias("roc_auc_pct"),
        F.lit(cm.train_rows).cast("long").alias("train_rows"),
        F.lit(cm.test_rows).cast("long").alias("test_rows"),
    )


def feature_importance(cm: ChurnModel, spark: SparkSession, top: int | None = S.TOP_FEATURES) -> DataFrame:
    """Feature importances rounded to 4, descending (top ``top``)."""
    imp = cm.model.stages[-1].featureImportances.toArray()
    rows = [(f, float(round(v, 4))) for f, v in zip(cm.features, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")
    return df.limit(top) if top else df


def score(cm: ChurnModel, features: DataFrame) -> DataFrame:
    """H12 + H13: churn probability % (1 decimal) and risk level for every customer."""
    pred = cm.model.transform(_prepared(features).withColumn("w", F.lit(1.0)))
    prob = F.bround(vector_to_array("probability")[1] * 100.0, 1)
    out = pred.withColumn("churn_probability", prob).withColumn("risk_level", risk_level("churn_probability"))
    cols = ("customer_email", "total_orders", "total_spent", "days_since_last", "churn_probability", "risk_level")
    return out.select(*cols).orderBy(F.col("churn_probability").desc(), "customer_email")


def top_risk(scored: DataFrame, n: int = S.TOP_RISK_ROWS) -> DataFrame:
    """The ``n`` highest-probability High-risk customers (a per-partition top-k)."""
    return scored.where(F.col("risk_level") == "High").orderBy(F.col("churn_probability").desc(), "customer_email").limit(n)
