"""Command line: ``spark-submit``-able jobs over shared folders, one per stage.

    python -m steprisk inspect        TRANSACTIONS_CSV REPORT
    python -m steprisk build-features TRANSACTIONS_CSV FEATURES
    python -m steprisk train          FEATURES MODEL [--runs RUN_LOG]
    python -m steprisk train-benchmark TRANSACTIONS_CSV {leaky,safe} [--runs RUN_LOG]
    python -m steprisk thresholds     FEATURES MODEL TABLE
    python -m steprisk drift          FEATURES MODEL SCORES REPORT
    python -m steprisk retrain        FEATURES MODEL DRIFT_REPORT CANDIDATE REPORT
    python -m steprisk score          REQUESTS MODEL DECISIONS
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from steprisk.operators.history import behavioral_features
from steprisk.operators.metrics import (
    best_f1_threshold,
    lowest_cost_threshold,
    nearest_threshold,
    threshold_sweep,
)
from steprisk.operators.quality import quality_report, validate_target
from steprisk.operators.split import strict_time_split
from steprisk.plans.lifecycle import lifecycle_report
from steprisk.plans.monitoring import drift_report, store_scores
from steprisk.plans.training import (
    Boosting,
    load_model,
    log_training,
    save_model,
    score_feature_table,
    score_transactions,
    train_behavioral,
    train_leakage_safe,
    train_leaky_benchmark,
)
from steprisk.schema import DRIFT_REPORT, TRANSACTIONS
from steprisk.sources.features import output_summary, write_features
from steprisk.sources.reports import read_report, write_report, write_threshold_table
from steprisk.sources.transactions import read_transactions, with_row_key


def inspect(spark: SparkSession, args: argparse.Namespace) -> None:
    table = validate_target(read_transactions(spark, args.transactions))
    write_report(quality_report(table, TRANSACTIONS.fieldNames()), args.report)


def build_features(spark: SparkSession, args: argparse.Namespace) -> None:
    table = with_row_key(read_transactions(spark, args.transactions))
    write_features(behavioral_features(table), args.features)
    output_summary(spark.read.parquet(args.features)).show()


def train(spark: SparkSession, args: argparse.Namespace) -> None:
    trained = train_behavioral(spark.read.parquet(args.features), boosting=Boosting(rounds=args.rounds))
    save_model(trained.model, args.model)
    trained.metrics.show()
    if args.runs:
        log_training(trained, args.runs, "transaction-risk", "behavioral")


def train_benchmark(spark: SparkSession, args: argparse.Namespace) -> None:
    fit = {"leaky": train_leaky_benchmark, "safe": train_leakage_safe}[args.variant]
    trained = fit(with_row_key(read_transactions(spark, args.transactions)), boosting=Boosting(rounds=args.rounds))
    trained.metrics.show()
    if args.runs:
        log_training(trained, args.runs, "transaction-risk", args.variant)


def thresholds(spark: SparkSession, args: argparse.Namespace) -> None:
    _, later, _ = strict_time_split(spark.read.parquet(args.features))
    scored = score_feature_table(load_model(spark, args.model), later, dtype="float")
    write_threshold_table(threshold_sweep(scored), args.table)
    sweep = spark.read.csv(args.table, header=True, inferSchema=True)
    for pick in (nearest_threshold, best_f1_threshold, lowest_cost_threshold):
        pick(sweep).show()


def drift(spark: SparkSession, args: argparse.Namespace) -> None:
    scored = score_feature_table(load_model(spark, args.model), spark.read.parquet(args.features))
    write_report(drift_report(store_scores(scored, args.scores)), args.report)


def retrain(spark: SparkSession, args: argparse.Namespace) -> None:
    report = lifecycle_report(
        read_report(spark, args.drift_report, DRIFT_REPORT),
        spark.read.parquet(args.features),
        load_model(spark, args.model),
        args.candidate,
        args.model,
        boosting=Boosting(rounds=args.rounds),
    )
    if report.isEmpty():
        print("retraining not recommended")
    else:
        write_report(report, args.report)


def score(spark: SparkSession, args: argparse.Namespace) -> None:
    decided = score_transactions(load_model(spark, args.model), spark.read.parquet(args.requests))
    decided.write.mode("overwrite").parquet(args.decisions)
    spark.read.parquet(args.decisions).groupBy("valid", "prediction").agg(F.count(F.lit(1)).alias("rows")).show()


def main() -> None:
    parser = argparse.ArgumentParser(prog="steprisk", description=__doc__.splitlines()[0])
    jobs = parser.add_subparsers(required=True)

    def job(run, name: str, *paths: str) -> argparse.ArgumentParser:
        command = jobs.add_parser(name)
        for path in paths:
            command.add_argument(path)
        command.set_defaults(run=run)
        return command

    job(inspect, "inspect", "transactions", "report")
    job(build_features, "build-features", "transactions", "features")
    job(thresholds, "thresholds", "features", "model", "table")
    job(drift, "drift", "features", "model", "scores", "report")
    job(score, "score", "requests", "model", "decisions")
    fits = [
        job(train, "train", "features", "model"),
        job(train_benchmark, "train-benchmark", "transactions"),
        job(retrain, "retrain", "features", "model", "drift_report", "candidate", "report"),
    ]
    fits[1].add_argument("variant", choices=["leaky", "safe"])
    for command in fits:
        command.add_argument("--rounds", type=int, default=Boosting().rounds)
    for command in fits[:2]:
        command.add_argument("--runs", default="")
    args = parser.parse_args()
    spark = SparkSession.builder.appName("steprisk").getOrCreate()
    args.run(spark, args)


if __name__ == "__main__":
    main()
