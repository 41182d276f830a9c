"""Data quality checks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from steprisk.schema import TRANSACTION_TYPES, TRANSACTIONS


# Invalid values that an error names.
SHOWN_VALUES = 100


def missing_columns(df: DataFrame, expected: Iterable[str] = tuple(TRANSACTIONS.fieldNames())) -> list[str]:
    """Expected columns the table lacks, sorted. Looks at the schema only; further columns are fine."""
    return sorted(set(expected) - set(df.columns))


def validate_schema(df: DataFrame, expected: Iterable[str] = tuple(TRANSACTIONS.fieldNames())) -> DataFrame:
    """The table itself, or an error naming the missing columns."""
    missing = missing_columns(df, expected)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def invalid_targets(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """Distinct label values other than 0 and 1; NULL labels are ignored."""
    return df.where(F.col(label).isNotNull() & ~F.col(label).isin(0, 1)).select(label).distinct()


def validate_target(df: DataFrame, label: str = "isFraud") -> DataFrame:
    """The table itself, or an error with the invalid label values: the least ``SHOWN_VALUES``, and whether there are more."""
    wrong = [row[0] for row in invalid_targets(df, label).orderBy(label).limit(SHOWN_VALUES + 1).collect()]
    if wrong:
        more = " and more" if len(wrong) > SHOWN_VALUES else ""
        raise ValueError(f"invalid {label} values: {wrong[:SHOWN_VALUES]}{more}")
    return df


def duplicate_row_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each identical group. Leave a surrogate key out of ``columns``.

    Two 64-bit hashes of every row are counted first; whole rows are moved and compared only where both repeat. Partial
    counts run before either shuffle, so many copies of one row cost one shuffled row per task.
    """
    columns = list(columns or df.columns)
    digest = ["_row_digest_1", "_row_digest_2"]
    rows = df.select(*columns).withColumns({name: F.xxhash64(F.lit(seed), *columns) for seed, name in enumerate(digest)})
    repeated = rows.groupBy(*digest).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1").select(*digest)
    return (
        rows.join(repeated, digest, "left_semi")
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"))
    )


def _absent(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def null_counts(df: DataFrame) -> DataFrame:
    """(column, missing) with NULL and NaN both counted, one scan for all columns."""
    counted = df.agg(*[F.count_if(_absent(field)).alias(field.name) for field in df.schema])
    return counted.unpivot([], list(df.columns), "column", "missing")


def type_counts(df: DataFrame) -> DataFrame:
    """Rows per transaction type, most frequent first; NULL types are not listed."""
    return (
        df.where("type IS NOT NULL")
        .groupBy("type")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("rows"), "type")
    )


def class_balance(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows, columns, fraud, legitimate and fraud rate in one aggregate."""
    width = len(columns or df.columns)
    return df.agg(
        F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("isFraud"), F.lit(0)).alias("fraud_transactions")
    ).select(
        "rows",
        F.lit(width).alias("columns"),
        "fraud_transactions",
        (F.col("rows") - F.col("fraud_transactions")).alias("legitimate_transactions"),
        F.try_divide("fraud_transactions", "rows").alias("fraud_rate"),
    )


def quality_report(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One nested row: class balance, duplicates, missing values per column and rows per type.

    Two scans: one aggregate per type gives balance, missing values and types, the other one counts duplicates.
    Nothing is gathered on the driver.
    """
    columns = list(columns or df.columns)
    table = df.select(*columns)
    validate_schema(table)
    per_type = table.groupBy(F.col("type").alias("_type")).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.sum("isFraud").alias("_fraud"),
        *[F.count_if(_absent(field)).alias(f"_absent{place}") for place, field in enumerate(table.schema)],
    )
    missing = [
        F.struct(F.lit(name).alias("key"), F.coalesce(F.sum(f"_absent{place}"), F.lit(0)).alias("value"))
        for place, name in enumerate(columns)
    ]
    frequent_first = F.array_sort(
        F.collect_list(F.when(F.col("_type").isNotNull(), F.struct((-F.col("_rows")).alias("n"), F.col("_type").alias("type"))))
    )
    counted = per_type.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum("_fraud"), F.lit(0)).alias("fraud_transactions"),
        F.map_from_entries(F.array(*missing)).alias("missing_values"),
        F.map_from_entries(F.transform(frequent_first, lambda t: F.struct(t["type"], -t["n"]))).alias("transaction_types"),
    )
    return counted.crossJoin(duplicate_row_count(table)).select(  # one row beside one row
        "rows",
        F.lit(len(columns)).alias("columns"),
        "fraud_transactions",
        (F.col("rows") - F.col("fraud_transactions")).alias("legitimate_transactions"),
        F.try_divide("fraud_transactions", "rows").alias("fraud_rate"),
        "duplicate_rows",
        "missing_values",
        "transaction_types",
    ).to(QUALITY_REPORT)


QUALITY_REPORT = T.StructType(
    [
        T.StructField("rows", T.LongType()),
        T.StructField("columns", T.IntegerType()),
        T.StructField("fraud_transactions", T.LongType()),
        T.StructField("legitimate_transactions", T.LongType()),
        T.StructField("fraud_rate", T.DoubleType()),
        T.StructField("duplicate_rows", T.LongType()),
        T.StructField("missing_values", T.MapType(T.StringType(), T.LongType())),
        T.StructField("transaction_types", T.MapType(T.StringType(), T.LongType())),
    ]
)


# The rules a scoring request must satisfy.
NON_NEGATIVE = (
    "amount", "oldbalanceOrg", "oldbalanceDest", "orig_prior_txn_count", "orig_prior_amount_mean",
    "orig_account_age_steps", "amount_vs_prior_mean", "orig_dest_prior_txn_count",
)


def invalid_type(types: Sequence[str] = TRANSACTION_TYPES) -> Column:
    return F.coalesce(~F.col("type").isin(*types), F.lit(True))


def _fails(rule: Column) -> Column:
    """A rule that cannot be evaluated (missing value) counts as violated."""
    return ~F.coalesce(rule, F.lit(False))


def violated_rules() -> Column:
    """Array of the names of the request rules a row violates, empty when it is valid."""
    rules = [F.when(_fails(F.col("step") >= 1), F.lit("step"))]
    rules += [
        F.when(_fails((F.col(name) >= 0) & ~F.isnan(F.col(name).cast("double"))), F.lit(name))
        for name in NON_NEGATIVE
    ]
    rules += [
        F.when(_fails(F.col("orig_steps_since_prev_txn").isNotNull()), F.lit("orig_steps_since_prev_txn")),
        F.when(_fails(F.col("dest_seen_before").between(0, 1)), F.lit("dest_seen_before")),
        F.when(invalid_type(), F.lit("type")),
    ]
    return F.array_compact(F.array(*rules))


def validate_scoring_rows(df: DataFrame) -> DataFrame:
    """Input rows with ``violations`` and ``valid``; nothing is dropped here."""
    return df.withColumn("violations", violated_rules()).withColumn("valid", F.size("violations") == 0)


def invalid_types(df: DataFrame, types: Sequence[str] = TRANSACTION_TYPES) -> DataFrame:
    """Rows whose type is not one of ``types``."""
    return df.where(invalid_type(types))
