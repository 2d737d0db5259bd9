"""Command line: ``python -m ledgerlens <command> --tables DIR --out DIR``.

Commands mirror the reference's entry points, each as one Spark application:

    batch      load -> clean/save -> KPI -> forecast -> MIS tables (J1)
    validate   quality checks and score on the cleaned data (V1-V7)
    kpis       KPI summary, monthly revenue, category revenue (K)
    trends     monthly/category/region/weekend trends and shares (TR)
    impact     category and region impact scores (I)
    churn      customer features, model metrics, importances, predictions CSV (H)
    forecast   daily revenue forecast and projections (F)
    reports    MIS, impact, prediction and coach report datasets (R)

Every command except ``batch`` reads the cleaned table and its roll-up that
``batch`` wrote to ``--out``. Results are written as Parquet datasets under ``--out``.
"""

from __future__ import annotations

import argparse
import dataclasses
import datetime as dt
import sys

from ledgerlens import schema as S
from ledgerlens.operators import churn_model, customers, forecast, impact, kpis, projection, quality, reports, trends
from ledgerlens.plans import batch
from ledgerlens.session import get_spark
from ledgerlens.sources import files, fixture


def _outputs(cmd: str, c, r, spark, out: str, params) -> dict:
    """Result tables of a command over the cleaned sales ``c`` and their roll-up ``r``."""
    if cmd == "validate":
        chk = quality.checks(c, params)
        return {"quality_checks": chk, "quality_score": quality.score(chk)}
    if cmd == "kpis":
        return {"kpi_summary": kpis.kpi_summary(r, c), "monthly_revenue": kpis.monthly(r), "category_revenue": kpis.category_revenue(r)}
    if cmd == "trends":
        return {
            "monthly_trend": trends.monthly_trend(r),
            "category_trend": trends.category_trend(r),
            "region_trend": trends.region_trend(r),
            "weekend_vs_weekday": trends.weekend_vs_weekday(r),
            "category_share": trends.category_share(r),
        }
    if cmd == "impact":
        return {"category_scores": impact.score_categories(r), "region_scores": impact.score_regions(r)}
    if cmd == "churn":
        feats = files.scratch_table(customers.customer_features(c, params.churn_days), "customer_features")
        cm, test = churn_model.train(feats, model_dir=f"{out}/churn_model")
        scored = churn_model.score(cm, feats)
        files.write_csv(scored, f"{out}/churn_predictions_csv")
        return {
            "customer_features": feats,
            "churn_metrics": churn_model.evaluate(cm, test, spark),
            "feature_importance": churn_model.feature_importance(cm, spark, top=None),
            "churn_predictions": scored,
            "top_risk": churn_model.top_risk(scored),
        }
    if cmd == "forecast":
        fc = forecast.prediction(r, params.forecast_days)
        return {
            "sales_forecast": fc,
            "forecast_summary": forecast.forecast_summary(fc.where("is_future")),
            "revenue_projection": projection.revenue_projection(r, params.default_growth),
            "category_projection": projection.category_projection(r, params.default_growth),
        }
    if cmd == "reports":
        return {
            "mis_summary": reports.mis_summary(r),
            "mis_monthly": reports.mis_monthly(r),
            "mis_categories": reports.mis_categories(r),
            "mis_data": reports.mis_data(c),
            "impact_metrics": reports.impact_metrics(r),
            "impact_categories": reports.impact_categories(r),
            "coach_cards": reports.coach_cards(r, params.churn_days, c),
            "churn_alert": reports.churn_alert(c, params.churn_days),
        }
    raise SystemExit(f"unknown command {cmd}")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="ledgerlens")
    ap.add_argument("command", choices=["batch", "validate", "kpis", "trends", "impact", "churn", "forecast", "reports"])
    ap.add_argument("--tables", required=True, help="directory with the source tables (<name>.parquet)")
    ap.add_argument("--out", required=True, help="output directory (shared storage on a cluster)")
    ap.add_argument("--master", default=None)
    ap.add_argument("--csv", default=None, help="batch: raw CSV feed (path or glob) instead of the source tables")
    ap.add_argument("--as-of", type=dt.date.fromisoformat, default=None, help="today's date for the run")
    ap.add_argument("--min-date", type=dt.date.fromisoformat, default=None, help="earliest valid sale date")
    ap.add_argument("--categories", default=None, help="allowed categories, comma-separated (V5)")
    ap.add_argument("--min-rows", type=int, default=None, help="fewest rows of a valid table (V6)")
    ap.add_argument("--input-gb", type=float, default=None, help="size of the input, for the number of shuffle partitions on a cluster")
    args = ap.parse_args(argv)
    spark = get_spark(master=args.master, input_gb=args.input_gb)
    params = S.Params() if args.csv else fixture.fixture_params()
    categories = tuple(c.strip() for c in args.categories.split(",")) if args.categories else None
    given = {"as_of": args.as_of, "min_date": args.min_date, "allowed_categories": categories, "min_rows": args.min_rows}
    params = dataclasses.replace(params, **{k: v for k, v in given.items() if v is not None})
    out = args.out.rstrip("/")
    if args.command == "batch":
        steps = batch.run(spark, args.tables, out, params, args.csv)
        steps.show(truncate=False)
        return int(any(r["status"] == "failed" and r["step"] in batch.CRITICAL for r in steps.collect()))
    c, r = (files.read_table(spark, f"{out}/{name}") for name in ("cleaned_sales", "sales_rollup"))
    for name, df in _outputs(args.command, c, r, spark, out, params).items():
        n = files.write_table(df, f"{out}/{args.command}/{name}")
        print(f"{args.command}/{name}: {n} rows")
    return 0


if __name__ == "__main__":
    sys.exit(main())
