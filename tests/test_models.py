"""Forecast and churn model: shapes, ranges, determinism (no value parity with the reference's libraries)."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from ledgerlens.operators import churn_model, customers, forecast
from ledgerlens.plans import catalog


def test_forecast_shape_and_band(spark):
    c = catalog.clean(spark, SF_SMALL)
    fc = forecast.forecast(c, 30)
    rows = fc.collect()
    assert len(rows) == 30 and all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in rows)
    last = c.where(F.col("order_status") == "Delivered").agg(F.max("sale_date")).first()[0]
    assert min(r.ds for r in rows) > last
    per_cat = forecast.forecast(c, 10, by="category")
    assert per_cat.groupBy("series").count().where("count != 10").count() == 0


def test_churn_model_outputs(spark):
    feats = customers.customer_features(catalog.clean(spark, SF_SMALL))
    cm, test = churn_model.train(feats, num_trees=10, max_depth=4)
    scored = churn_model.score(cm, feats)
    agg = scored.agg(F.min("churn_probability"), F.max("churn_probability"), F.count(F.lit(1))).first()
    assert 0 <= agg[0] <= agg[1] <= 100 and agg[2] == feats.count()
    assert set(r.risk_level for r in scored.select("risk_level").distinct().collect()) <= {"High", "Medium", "Low"}
    m = churn_model.evaluate(cm, test, spark).first()
    assert m.train_rows + m.test_rows == feats.count()
    # days_since_last is both the label's source and a feature, so the model separates the classes
    assert m.roc_auc_pct > 50 and 0 <= m.accuracy_pct <= 100
    w = churn_model.with_class_weights(churn_model.split(churn_model._prepared(feats)).where("is_train"))
    tot = w.agg(F.sum("w")).first()[0]
    assert abs(tot - w.count()) < 1e-6  # balanced weights sum to n


def test_stratified_sizes_follow_the_split_rule(spark):
    assert churn_model.stratified_sizes({0: 21, 1: 118}) == {0: 17, 1: 94}  # n_test = ceil(27.8) = 28
    assert churn_model.stratified_sizes({0: 10, 1: 5}) == {0: 8, 1: 4}
    feats = customers.customer_features(catalog.clean(spark, SF_SMALL))
    s = churn_model.split(feats)
    counts = {r.churned: r["count"] for r in feats.groupBy("churned").count().collect()}
    train = {r.churned: r["count"] for r in s.where("is_train").groupBy("churned").count().collect()}
    assert train == churn_model.stratified_sizes(counts)
    assert {r.customer_email for r in s.where("is_train").collect()} == {r.customer_email for r in churn_model.split(feats.repartition(3)).where("is_train").collect()}
