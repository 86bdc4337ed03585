"""Batch entry point: ``python -m riskframe {eda,hypotheses,training} INPUT OUTPUT``.

Loads and checks a policy file, runs one plan and writes its result tables as Parquet
under OUTPUT. With ``spark-submit`` the session settings come from the cluster.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from riskframe.plans import eda, hypothesis, training
from riskframe.sources import load_policies, stage, write_result


def tables(plan: str, df: DataFrame, as_of_year: int) -> dict[str, DataFrame]:
    """Result tables of one plan by name."""
    if plan == "eda":
        return eda.eda_report(df)
    if plan == "hypotheses":
        columns = [c for c in ("Province", "PostalCode", "Gender", "TotalPremium", "TotalClaims") if c in df.columns]
        summary = stage(hypothesis.test_summary(stage(df.select(columns))))
        return {"summary": summary, "recommendations": hypothesis.recommendations(summary)}
    out = {}
    for task in (training.SEVERITY, training.PREMIUM, training.CLAIM_PROBABILITY):
        report = training.run_task(df, task, as_of_year)
        if report.status == "ok":
            out[f"{task.name}_comparison"] = report.comparison
            out[f"{task.name}_importance"] = report.importance
    return out


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskframe", description=__doc__)
    parser.add_argument("plan", choices=["eda", "hypotheses", "training"])
    parser.add_argument("input")
    parser.add_argument("output")
    parser.add_argument("--format", default="csv")
    parser.add_argument("--as-of-year", type=int, default=2015)
    options = parser.parse_args(argv)
    spark = SparkSession.builder.appName(f"riskframe-{options.plan}").getOrCreate()
    df = load_policies(spark, options.input, fmt=options.format)
    for name, table in tables(options.plan, df, options.as_of_year).items():
        write_result(table, f"{options.output}/{name}")


if __name__ == "__main__":
    main()
