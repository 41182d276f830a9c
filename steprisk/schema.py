"""Schemas and fixed domain values shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# The raw transaction columns and their types.
TRANSACTIONS = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("nameOrig", T.StringType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("newbalanceOrig", T.DoubleType()),
        T.StructField("nameDest", T.StringType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("newbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("isFlaggedFraud", T.IntegerType()),
    ]
)

# The accepted transaction types.
TRANSACTION_TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")

# The eight columns the history build needs: no post-transaction balances, no flag.
# Columns the history is built from.
HISTORY_INPUT = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "nameDest", "oldbalanceDest", "isFraud",
)

# Columns of the stored feature table (a row key is kept beside them).
FEATURE_TABLE = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("type", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("oldbalanceOrg", T.DoubleType()),
        T.StructField("oldbalanceDest", T.DoubleType()),
        T.StructField("isFraud", T.IntegerType()),
        T.StructField("orig_prior_txn_count", T.LongType()),
        T.StructField("orig_prior_amount_sum", T.DoubleType()),
        T.StructField("orig_prior_amount_mean", T.DoubleType()),
        T.StructField("orig_steps_since_prev_txn", T.IntegerType()),
        T.StructField("orig_account_age_steps", T.IntegerType()),
        T.StructField("amount_vs_prior_mean", T.DoubleType()),
        T.StructField("orig_dest_prior_txn_count", T.LongType()),
        T.StructField("dest_seen_before", T.IntegerType()),
    ]
)

# Numeric columns watched for drift, stored ones first, derived ones after.
STORED_DRIFT_FEATURES = (
    "amount", "oldbalanceOrg", "oldbalanceDest", "orig_prior_txn_count", "orig_prior_amount_mean",
    "orig_steps_since_prev_txn", "orig_account_age_steps", "amount_vs_prior_mean",
    "orig_dest_prior_txn_count", "dest_seen_before",
)
DRIFT_FEATURES = (*STORED_DRIFT_FEATURES, "step", "hour", "day", "amount_to_orig_balance")

# Decision and monitoring constants.
DECISION_THRESHOLD = 0.98
REVIEW_THRESHOLD = 0.50
REFERENCE_END_STEP = 355
CHALLENGER_CUTOFF_STEP = 525

# Field names of the published drift report.
_METRIC = T.StructType(
    [
        T.StructField("feature", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("severity", T.StringType()),
    ]
)

DRIFT_REPORT = T.StructType(
    [
        T.StructField("reference_rows", T.LongType()),
        T.StructField("current_rows", T.LongType()),
        T.StructField("overall_severity", T.StringType()),
        T.StructField("metrics", T.ArrayType(_METRIC)),
        T.StructField(
            "label_monitoring",
            T.StructType(
                [
                    T.StructField("reference_fraud_rate", T.DoubleType()),
                    T.StructField("current_fraud_rate", T.DoubleType()),
                    T.StructField("fraud_rate_ratio", T.DoubleType()),
                ]
            ),
        ),
        T.StructField(
            "heldout_performance",
            T.StructType(
                [
                    T.StructField("evaluation_window", T.StringType()),
                    T.StructField("threshold", T.DoubleType()),
                    T.StructField("rows", T.LongType()),
                    T.StructField("fraud_cases", T.LongType()),
                    T.StructField("roc_auc", T.DoubleType()),
                    T.StructField("pr_auc", T.DoubleType()),
                    T.StructField("precision", T.DoubleType()),
                    T.StructField("recall", T.DoubleType()),
                    T.StructField("f1", T.DoubleType()),
                    T.StructField("true_negatives", T.LongType()),
                    T.StructField("false_positives", T.LongType()),
                    T.StructField("false_negatives", T.LongType()),
                    T.StructField("true_positives", T.LongType()),
                ]
            ),
        ),
        T.StructField("model_score_reference_rows", T.LongType()),
        T.StructField("model_score_current_rows", T.LongType()),
        T.StructField("reference_window", T.StringType()),
        T.StructField("current_window", T.StringType()),
        T.StructField("reference_step_max", T.IntegerType()),
        T.StructField("current_step_min", T.IntegerType()),
    ]
)

# Field names of the published lifecycle report.
_MODEL_METRICS = T.StructType(
    [T.StructField(name, T.DoubleType()) for name in ("roc_auc", "pr_auc", "precision", "recall", "f1")]
    + [T.StructField(name, T.LongType()) for name in ("tn", "fp", "fn", "tp")]
)

LIFECYCLE_REPORT = T.StructType(
    [
        T.StructField(
            "trigger",
            T.StructType(
                [
                    T.StructField("retraining_recommended", T.BooleanType()),
                    T.StructField("auto_promotion_allowed", T.BooleanType()),
                    T.StructField("severity", T.StringType()),
                    T.StructField("reasons", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("candidate_cutoff_step", T.IntegerType()),
        T.StructField("training_window", T.StringType()),
        T.StructField("evaluation_window", T.StringType()),
        T.StructField("decision_threshold", T.DoubleType()),
        T.StructField("champion_metrics", _MODEL_METRICS),
        T.StructField("candidate_metrics", _MODEL_METRICS),
        T.StructField(
            "promotion",
            T.StructType(
                [
                    T.StructField("promotion_recommended", T.BooleanType()),
                    T.StructField("decision", T.StringType()),
                    T.StructField("reasons", T.ArrayType(T.StringType())),
                ]
            ),
        ),
        T.StructField("production_model", T.StringType()),
        T.StructField("candidate_model", T.StringType()),
    ]
)
