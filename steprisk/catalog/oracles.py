"""Independent SQL for the registered queries.

History is written as a self-join on "earlier", metrics as plain sorts and counts over all rows: the SQL follows
the definitions and shares no plan with the Spark code.
"""

from __future__ import annotations

from collections.abc import Sequence

ORACLES: dict[str, str] = {}

TYPES = ("CASH_IN", "CASH_OUT", "DEBIT", "PAYMENT", "TRANSFER")
RAW = (
    "step", "type", "amount", "nameOrig", "oldbalanceOrg", "newbalanceOrig", "nameDest", "oldbalanceDest",
    "newbalanceDest", "isFraud", "isFlaggedFraud",
)

TX = """tx AS (
  SELECT event_id,
    CAST(floor(epoch_us(ts) / 3600000000.0) - 473352 + 1 AS INTEGER) AS step,
    CASE event_type WHEN 'signup' THEN 'CASH_IN' WHEN 'click' THEN 'CASH_OUT' WHEN 'view' THEN 'DEBIT'
                    WHEN 'purchase' THEN 'PAYMENT' ELSE 'TRANSFER' END AS type,
    value AS amount,
    'C' || user_id AS nameOrig,
    CAST((user_id * 37) % 500 AS DOUBLE) AS oldbalanceOrg,
    greatest((user_id * 37) % 500 - value, 0.0) AS newbalanceOrig,
    'M' || json_extract_string(props, '$.k') AS nameDest,
    CAST((CAST(json_extract_string(props, '$.k') AS BIGINT) * 53) % 300 AS DOUBLE) AS oldbalanceDest,
    (CAST(json_extract_string(props, '$.k') AS BIGINT) * 53) % 300 + value AS newbalanceDest,
    CASE WHEN event_type = 'error' AND value >= 100 THEN 1 ELSE 0 END AS isFraud,
    CASE WHEN value >= 250 THEN 1 ELSE 0 END AS isFlaggedFraud
  FROM events
)"""


def earlier(name: str, condition: str) -> str:
    """History per row as a self-join: ``h`` runs over the earlier rows of the same origin."""
    return f"""{name} AS (
  SELECT t.event_id,
    count(h.event_id) AS n,
    CAST(coalesce(sum(CAST(h.amount AS DECIMAL(28,6))), 0) AS DOUBLE) AS total,
    max(h.step) AS previous,
    least(t.step, coalesce(min(h.step), t.step)) AS first,
    CAST(count(h.event_id) FILTER (WHERE h.nameDest = t.nameDest) AS BIGINT) AS pair_n
  FROM tx t LEFT JOIN tx h ON h.nameOrig = t.nameOrig AND {condition}
  GROUP BY t.event_id, t.step
)"""


STEP_HISTORY = earlier("hist", "h.step < t.step")
ROW_HISTORY = earlier("hist", "(h.step < t.step OR (h.step = t.step AND h.event_id < t.event_id))")

FEATURES = {
    "orig_prior_txn_count": "CAST(n AS BIGINT)",
    "orig_prior_amount_sum": "total",
    "orig_prior_amount_mean": "CASE WHEN n > 0 THEN total / n ELSE 0.0 END",
    "orig_steps_since_prev_txn": "CAST(coalesce(step - previous, -1) AS INTEGER)",
    "orig_account_age_steps": "CAST(step - first AS INTEGER)",
    "amount_vs_prior_mean": "CASE WHEN n > 0 AND total > 0 THEN amount / (total / n) ELSE 0.0 END",
    "orig_dest_prior_txn_count": "pair_n",
    "dest_seen_before": "CASE WHEN pair_n > 0 THEN 1 ELSE 0 END",
    "orig_previous_step": "previous",
    "orig_first_step": "first",
}
STORED = tuple(FEATURES)[:8]


def columns(names: Sequence[str]) -> str:
    return ", ".join(f"{FEATURES[name]} AS {name}" if name in FEATURES else name for name in names)


FEAT = f"""{TX}, {STEP_HISTORY}, feat AS (
  SELECT event_id, step, type, amount, oldbalanceOrg, oldbalanceDest, isFraud, {columns(STORED)}
  FROM tx JOIN hist USING (event_id)
)"""

SCORED = f"{TX}, scored AS (SELECT *, least(1.0, amount / 300) AS score FROM tx)"


def from_tx(select: str) -> str:
    return f"WITH {TX} {select}"


def from_feat(select: str) -> str:
    return f"WITH {FEAT} {select}"


def from_scored(select: str) -> str:
    return f"WITH {SCORED} {select}"


# --- sources and sinks -------------------------------------------------------------------------------------------

ORACLES["read_transactions"] = from_tx("SELECT * FROM tx")
ORACLES["typed_projection"] = from_tx(
    "SELECT event_id, step, type, amount, nameOrig, oldbalanceOrg, nameDest, oldbalanceDest, isFraud FROM tx"
)
ORACLES["write_features"] = from_feat("SELECT * FROM feat")
ORACLES["read_window"] = from_feat(
    "SELECT event_id, step, type, isFraud, amount, oldbalanceOrg, oldbalanceDest, orig_prior_txn_count, "
    "orig_prior_amount_mean, orig_steps_since_prev_txn, orig_account_age_steps, amount_vs_prior_mean, "
    "orig_dest_prior_txn_count, dest_seen_before FROM feat WHERE step < 355"
)
ORACLES["output_summary"] = from_tx(
    "SELECT count(*) AS rows, min(step) AS min_step, max(step) AS max_step FROM tx"
)

QUALITY = f"""SELECT count(*) AS rows, 11 AS columns, CAST(sum(isFraud) AS BIGINT) AS fraud_transactions,
  CAST(count(*) - sum(isFraud) AS BIGINT) AS legitimate_transactions,
  round(CAST(sum(isFraud) AS DOUBLE) / count(*), 9) AS fraud_rate,
  count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(RAW)} FROM tx)) AS duplicate_rows,
  {", ".join(f"count(*) FILTER (WHERE type = '{name}') AS rows_{name}" for name in TYPES)}
FROM tx"""
ORACLES["write_report"] = ORACLES["quality_report"] = from_tx(QUALITY)
ORACLES["log_run"] = from_scored(
    """, counts AS (
  SELECT count(*) FILTER (WHERE score < 0.5 AND isFraud = 0) AS tn, count(*) FILTER (WHERE score >= 0.5 AND isFraud = 0) AS fp,
    count(*) FILTER (WHERE score < 0.5 AND isFraud = 1) AS fn, count(*) FILTER (WHERE score >= 0.5 AND isFraud = 1) AS tp
  FROM scored), entries AS (
  SELECT 'param' AS kind, 'threshold' AS key, '0.5' AS value
  UNION ALL SELECT 'metric', 'tn', CAST(tn AS VARCHAR) FROM counts UNION ALL SELECT 'metric', 'fp', CAST(fp AS VARCHAR) FROM counts
  UNION ALL SELECT 'metric', 'fn', CAST(fn AS VARCHAR) FROM counts UNION ALL SELECT 'metric', 'tp', CAST(tp AS VARCHAR) FROM counts)
SELECT 'transaction-risk' AS experiment, 'run-1' AS run_id, 'proxy' AS run_name, kind, key, value FROM entries"""
)

# --- data quality ------------------------------------------------------------------------------------------------

ORACLES["missing_columns"] = from_tx("SELECT count(*) AS rows, 'amount,type' AS missing FROM tx")
ORACLES["invalid_targets"] = from_tx(
    "SELECT DISTINCT isFraud + isFlaggedFraud AS isFraud FROM tx WHERE isFraud + isFlaggedFraud NOT IN (0, 1)"
)
ORACLES["duplicate_row_count"] = from_tx(
    f"""SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT {", ".join(RAW)} FROM tx)) AS duplicate_rows,
  'all columns' AS "over" FROM tx
UNION ALL
SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT step, type, nameOrig FROM tx)), 'keys' FROM tx"""
)
ORACLES["null_counts"] = from_tx(
    "SELECT 'type' AS \"column\", count(*) FILTER (WHERE type = 'DEBIT') AS missing FROM tx "
    "UNION ALL SELECT 'amount', count(*) FILTER (WHERE amount >= 250) FROM tx "
    "UNION ALL SELECT 'oldbalanceOrg', count(*) FILTER (WHERE isFraud = 1) FROM tx "
    + " ".join(
        f"UNION ALL SELECT '{name}', count(*) - count({name}) FROM tx"
        for name in RAW
        if name not in ("type", "amount", "oldbalanceOrg")
    )
)
ORACLES["type_counts"] = from_tx("SELECT type, count(*) AS rows FROM tx GROUP BY type")
ORACLES["class_balance"] = from_tx(
    """SELECT count(*) AS rows, 11 AS columns, CAST(sum(isFraud) AS BIGINT) AS fraud_transactions,
  CAST(count(*) - sum(isFraud) AS BIGINT) AS legitimate_transactions,
  round(CAST(sum(isFraud) AS DOUBLE) / count(*), 9) AS fraud_rate FROM tx"""
)
REQUESTS = f"""{FEAT}, requests AS (
  SELECT * REPLACE (CASE WHEN amount >= 250 THEN -amount ELSE amount END AS amount,
    CASE WHEN orig_dest_prior_txn_count >= 2 THEN 2 ELSE dest_seen_before END AS dest_seen_before,
    CASE WHEN oldbalanceDest = 0 THEN 'UNKNOWN' ELSE type END AS type) FROM feat
)"""
ORACLES["validate_scoring_rows"] = f"""WITH {REQUESTS}
SELECT event_id, amount >= 0 AND dest_seen_before <= 1 AND type <> 'UNKNOWN' AS valid,
  concat_ws(',', CASE WHEN amount < 0 THEN 'amount' END, CASE WHEN dest_seen_before > 1 THEN 'dest_seen_before' END,
            CASE WHEN type = 'UNKNOWN' THEN 'type' END) AS violations FROM requests"""
ORACLES["invalid_types"] = from_tx("SELECT event_id, 'UNKNOWN' AS type FROM tx WHERE oldbalanceDest = 0")

# --- per-row features --------------------------------------------------------------------------------------------

ROW_FEATURES = {
    "amount_log": "round(ln(1 + amount), 9)",
    "orig_balance_delta": "oldbalanceOrg - newbalanceOrig",
    "dest_balance_delta": "newbalanceDest - oldbalanceDest",
    "orig_balance_error": "oldbalanceOrg - amount - newbalanceOrig",
    "dest_balance_error": "oldbalanceDest + amount - newbalanceDest",
    "amount_to_orig_balance": "amount / (oldbalanceOrg + 1)",
    "hour": "CAST(step % 24 AS INTEGER)",
    "day": "CAST(floor(step / 24) AS INTEGER)",
}
for _name, _formula in ROW_FEATURES.items():
    ORACLES[_name] = from_tx(f"SELECT event_id, {_formula} AS {_name} FROM tx")


def one_hot(names: Sequence[str] = TYPES, column: str = "type") -> str:
    return ", ".join(f"CAST({column} = '{name}' AS INTEGER) AS type_{name}" for name in names)


ORACLES["type_one_hot"] = from_tx(f"SELECT event_id, {one_hot()} FROM tx")
ORACLES["type_one_hot_learned"] = from_tx(
    f"SELECT event_id, {one_hot(['CASH_IN', 'CASH_OUT', 'PAYMENT', 'TRANSFER'])} FROM tx WHERE step >= 355"
)
ORACLES["leaky_benchmark_features"] = from_tx(
    "SELECT event_id, step, amount, oldbalanceOrg, newbalanceOrig, oldbalanceDest, newbalanceDest, "
    + ", ".join(f"{formula} AS {name}" for name, formula in ROW_FEATURES.items())
    + " FROM tx"
)
ORACLES["safe_features"] = from_tx(
    "SELECT event_id, step, amount, oldbalanceOrg, oldbalanceDest, "
    + ", ".join(f"{ROW_FEATURES[name]} AS {name}" for name in ("hour", "day", "amount_to_orig_balance"))
    + f", {one_hot()} FROM tx"
)
MODEL_NUMERIC = (
    "step", "amount", "oldbalanceOrg", "oldbalanceDest", "hour", "day", "amount_to_orig_balance",
    "orig_prior_txn_count", "orig_prior_amount_mean", "orig_steps_since_prev_txn", "orig_account_age_steps",
    "amount_vs_prior_mean", "orig_dest_prior_txn_count", "dest_seen_before",
)


def model_input(kind: str) -> str:
    cells = ", ".join(f"CAST({ROW_FEATURES.get(name, name)} AS {kind}) AS {name}" for name in MODEL_NUMERIC)
    return from_feat(f"SELECT event_id, {cells}, {one_hot()} FROM feat")


ORACLES["model_features"] = model_input("FLOAT")
ORACLES["model_features_f64"] = model_input("DOUBLE")

# --- history -----------------------------------------------------------------------------------------------------

ORACLES["origin_step_agg"] = from_tx(
    "SELECT step, nameOrig, count(*) AS step_txn_count, "
    "CAST(sum(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS step_amount_sum FROM tx GROUP BY step, nameOrig"
)
ORACLES["pair_step_agg"] = from_tx(
    "SELECT step, nameOrig, nameDest, count(*) AS pair_step_txn_count FROM tx GROUP BY step, nameOrig, nameDest"
)


def history(names: Sequence[str], joined: str = STEP_HISTORY) -> str:
    return f"WITH {TX}, {joined} SELECT event_id, {columns(names)} FROM tx JOIN hist USING (event_id)"


for _name in FEATURES:
    ORACLES[_name] = history([_name])
ORACLES["attach_origin_history"] = history(
    ["orig_prior_txn_count", "orig_prior_amount_sum", "orig_previous_step", "orig_first_step"]
)
ORACLES["attach_pair_history"] = history(["orig_dest_prior_txn_count"])
ORACLES["behavioral_features"] = ORACLES["behavioral_features_grouped"] = ORACLES["write_features"]
ORACLES["behavioral_features_hot"] = ORACLES["write_features"]

ROW_NAMES = {
    "row_prior_txn_count": "orig_prior_txn_count",
    "row_prior_amount_sum": "orig_prior_amount_sum",
    "row_prior_amount_mean": "orig_prior_amount_mean",
    "row_steps_since_prev": "orig_steps_since_prev_txn",
    "row_account_age": "orig_account_age_steps",
    "row_amount_vs_prior_mean": "amount_vs_prior_mean",
    "row_pair_prior_count": "orig_dest_prior_txn_count",
    "row_dest_seen_before": "dest_seen_before",
}
for _name, _column in ROW_NAMES.items():
    ORACLES[_name] = history([_column], ROW_HISTORY)
ORACLES["row_behavioral_features"] = ORACLES["row_behavioral_features_hot"] = history([*RAW, *STORED], ROW_HISTORY)

# --- splits ------------------------------------------------------------------------------------------------------


def cut(share: float) -> str:
    return f"""cut AS (
  SELECT step AS cutoff FROM (SELECT step, row_number() OVER (ORDER BY step) - 1 AS place, count(*) OVER () AS n FROM tx)
  WHERE place = CAST(floor(n * CAST({share} AS DOUBLE)) AS BIGINT))"""


ORACLES["cutoff_step"] = f"WITH {TX}, {cut(0.8)} SELECT cutoff AS cutoff_step FROM cut"
ORACLES["strict_time_split"] = (
    f"WITH {TX}, {cut(0.8)} SELECT event_id, step, CASE WHEN step < cutoff THEN 'train' ELSE 'test' END AS split FROM tx, cut"
)
ORACLES["split_guards"] = f"""WITH {TX}, {cut(0.9)}
SELECT CASE WHEN step < cutoff THEN 'train' ELSE 'test' END AS split, count(*) AS rows, min(step) AS first,
  max(step) AS last, any_value(cutoff) AS cutoff_step FROM tx, cut GROUP BY 1"""
ORACLES["positional_split"] = from_tx(
    """SELECT event_id, CASE WHEN row_number() OVER (ORDER BY event_id) <= floor(count(*) OVER () * CAST(0.8 AS DOUBLE))
  THEN 'train' ELSE 'test' END AS split FROM tx"""
)
ORACLES["fixed_windows"] = from_tx(
    "SELECT event_id, step, CASE WHEN step < 355 THEN 'reference' ELSE 'current' END AS \"window\" FROM tx"
)

# --- models ------------------------------------------------------------------------------------------------------

ORACLES["class_weight"] = f"""WITH {TX}, {cut(0.8)}
SELECT count(*) FILTER (WHERE isFraud = 1) AS positives, count(*) FILTER (WHERE isFraud = 0) AS negatives,
  CAST(count(*) FILTER (WHERE isFraud = 0) AS DOUBLE) / greatest(count(*) FILTER (WHERE isFraud = 1), 1) AS scale_pos_weight
FROM tx, cut WHERE step < cutoff"""
ORACLES["classify"] = from_scored(
    "SELECT event_id, CASE WHEN score >= 0.98 THEN 'fraud' ELSE 'legitimate' END AS prediction FROM scored"
)
ORACLES["risk_level"] = from_scored(
    "SELECT event_id, CASE WHEN score >= 0.98 THEN 'HIGH' WHEN score >= 0.5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level "
    "FROM scored"
)

# --- evaluation --------------------------------------------------------------------------------------------------


def counts(source: str, by: str = "", threshold: str = "CAST(0.5 AS DOUBLE)") -> str:
    """tn, fp, fn, tp and the three rates, per ``by`` (a list ending in a comma, or empty)."""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""counts AS (SELECT {by}
    count(*) FILTER (WHERE score < {threshold} AND isFraud = 0) AS tn, count(*) FILTER (WHERE score >= {threshold} AND isFraud = 0) AS fp,
    count(*) FILTER (WHERE score < {threshold} AND isFraud = 1) AS fn, count(*) FILTER (WHERE score >= {threshold} AND isFraud = 1) AS tp
  FROM {source} {group}),
pr AS (SELECT *, CAST(tp AS DOUBLE) / greatest(tp + fp, 1) AS p, CAST(tp AS DOUBLE) / greatest(tp + fn, 1) AS r FROM counts),
rates AS (SELECT *, 2 * p * r / greatest(p + r, CAST(1e-12 AS DOUBLE)) AS f FROM pr)"""


def ranking(source: str, by: str = "") -> str:
    """Area under ROC and average precision from per-score totals above each score."""
    part = f"PARTITION BY {by.rstrip(', ')}" if by else ""
    group = f"GROUP BY {by.rstrip(', ')}" if by else ""
    return f"""per_score AS (SELECT {by} score, count(*) FILTER (WHERE isFraud = 1) AS pos, count(*) FILTER (WHERE isFraud = 0) AS neg
  FROM {source} GROUP BY {by} score),
above AS (SELECT *, CAST(sum(pos) OVER w AS DOUBLE) AS tp_at, CAST(sum(neg) OVER w AS DOUBLE) AS fp_at FROM per_score
  WINDOW w AS ({part} ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
ranked AS (SELECT {by}
    CASE WHEN sum(pos) * sum(neg) > 0 THEN sum(neg * (tp_at - pos + CAST(pos AS DOUBLE) / 2)) / CAST(sum(pos) * sum(neg) AS DOUBLE) END AS auc,
    CASE WHEN sum(pos) > 0 THEN sum(pos * tp_at / (tp_at + fp_at)) / CAST(sum(pos) AS DOUBLE) ELSE 0.0 END AS ap
  FROM above {group})"""


RATES = "round(p, 9) AS precision, round(r, 9) AS recall, round(f, 9) AS f1"
COSTS = (
    "CAST(fp AS DOUBLE) AS false_positive_cost, CAST(fn * 100 AS DOUBLE) AS false_negative_cost, "
    "CAST(fp + fn * 100 AS DOUBLE) AS estimated_business_cost"
)

_COUNTS = f"WITH {SCORED}, {counts('scored')} "
ORACLES["confusion_counts"] = f"{_COUNTS} SELECT tn, fp, fn, tp FROM counts"
ORACLES["precision_recall_f1"] = f"{_COUNTS} SELECT {RATES} FROM rates"
ORACLES["false_positive_rate"] = (
    f"{_COUNTS} SELECT round(CAST(fp AS DOUBLE) / greatest(fp + tn, 1), 9) AS false_positive_rate FROM counts"
)
ORACLES["business_cost"] = f"{_COUNTS} SELECT {COSTS} FROM counts"
ORACLES["roc_auc"] = f"WITH {SCORED}, {ranking('scored')} SELECT round(auc, 9) AS roc_auc FROM ranked"
ORACLES["average_precision"] = f"WITH {SCORED}, {ranking('scored')} SELECT round(ap, 9) AS pr_auc FROM ranked"
ORACLES["classification_report"] = f"""{_COUNTS}, base AS (
  SELECT CAST(tn AS DOUBLE) / greatest(tn + fn, 1) AS p0, CAST(tn AS DOUBLE) / greatest(tn + fp, 1) AS r0, p AS p1, r AS r1, f AS f1,
    tn + fp AS n0, fn + tp AS n1, CAST(tn + tp AS DOUBLE) / (tn + fp + fn + tp) AS acc FROM rates),
c AS (SELECT *, 2 * p0 * r0 / greatest(p0 + r0, CAST(1e-12 AS DOUBLE)) AS f0 FROM base),
lines AS (
  SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS n FROM c UNION ALL SELECT '1', p1, r1, f1, n1 FROM c
  UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM c
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM c
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1),
    (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1 FROM c)
SELECT class, {RATES}, n AS support FROM lines"""
ORACLES["evaluate_threshold"] = (
    f"{_COUNTS} SELECT CAST(0.5 AS DOUBLE) AS threshold, {RATES}, tp, fp, fn, tn, {COSTS} FROM rates"
)
SWEEP = f"""WITH {SCORED}, grid AS (
  SELECT CAST(0.01 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS threshold FROM range(99) r(i)),
tested AS (SELECT threshold, score, isFraud FROM scored, grid), {counts("tested", "threshold, ", "threshold")},
sweep AS (SELECT threshold AS t, f, round(threshold, 9) AS threshold, {RATES}, tp, fp, fn, tn, {COSTS} FROM rates)"""
SWEEP_COLUMNS = (
    "threshold, precision, recall, f1, tp, fp, fn, tn, false_positive_cost, false_negative_cost, estimated_business_cost"
)
ORACLES["threshold_sweep"] = ORACLES["write_threshold_table"] = f"{SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep"
ORACLES["best_f1_threshold"] = f"{SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep ORDER BY f DESC, t LIMIT 1"
ORACLES["lowest_cost_threshold"] = (
    f"{SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep ORDER BY estimated_business_cost, t LIMIT 1"
)
ORACLES["nearest_threshold"] = (
    f"{SWEEP} SELECT {SWEEP_COLUMNS} FROM sweep ORDER BY abs(t - CAST(0.5 AS DOUBLE)), t LIMIT 1"
)
HELDOUT = """'held_out_current_window' AS evaluation_window, CAST(0.5 AS DOUBLE) AS threshold, tn + fp + fn + tp AS rows,
  fn + tp AS fraud_cases, round(auc, 6) AS roc_auc, round(ap, 6) AS pr_auc, round(p, 6) AS precision, round(r, 6) AS recall,
  round(f, 6) AS f1, tn AS true_negatives, fp AS false_positives, fn AS false_negatives, tp AS true_positives"""
CURRENT = "current_rows AS (SELECT * FROM scored WHERE step >= 355)"
ORACLES["heldout_performance"] = (
    f"WITH {SCORED}, {CURRENT}, {ranking('current_rows')}, {counts('current_rows')} SELECT {HELDOUT} FROM rates, ranked"
)
ORACLES["model_evaluation"] = f"""WITH {SCORED}, later AS (SELECT * FROM scored WHERE step >= 525), {ranking("later")}, {counts("later")}
SELECT round(auc, 9) AS roc_auc, round(ap, 9) AS pr_auc, {RATES}, tn, fp, fn, tp FROM rates, ranked"""

# --- drift -------------------------------------------------------------------------------------------------------

WATCHED = (
    "amount", "oldbalanceOrg", "oldbalanceDest", "orig_prior_txn_count", "orig_prior_amount_mean",
    "orig_steps_since_prev_txn", "orig_account_age_steps", "amount_vs_prior_mean", "orig_dest_prior_txn_count",
    "dest_seen_before", "step", "hour", "day", "amount_to_orig_balance",
)
SCORE = "model_fraud_probability"
WINDOWED = f"""{FEAT}, windowed AS (
  SELECT *, CASE WHEN step < 355 THEN 'reference' ELSE 'current' END AS side, step % 24 AS hour, floor(step / 24) AS day,
    amount / (oldbalanceOrg + 1) AS amount_to_orig_balance, least(1.0, amount / 300) AS {SCORE}
  FROM feat
)"""


def stability(values: Sequence[tuple[str, str]], source: str = "windowed") -> str:
    """Population stability index of each (name, expression), from sorted values and explicit bins."""
    long = "\n  UNION ALL ".join(
        f"SELECT '{name}' AS feature, CAST({value} AS DOUBLE) AS v, side FROM {source} WHERE {value} IS NOT NULL"
        for name, value in values
    )
    return f"""long AS ({long}),
sorted AS (SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY v) - 1 AS place, count(*) OVER (PARTITION BY feature) AS n
  FROM long WHERE side = 'reference'),
shares AS (SELECT CASE WHEN i = 10 THEN CAST(1 AS DOUBLE) ELSE i * CAST(0.1 AS DOUBLE) END AS q FROM range(11) r(i)),
spots AS (SELECT feature, n, (n - 1) * q AS spot FROM (SELECT DISTINCT feature, n FROM sorted), shares),
quantiles AS (
  SELECT DISTINCT s.feature,
    CASE WHEN spot - floor(spot) < 0.5 THEN a.v + (b.v - a.v) * (spot - floor(spot))
         ELSE b.v - (b.v - a.v) * (1 - (spot - floor(spot))) END AS edge
  FROM spots s JOIN sorted a ON a.feature = s.feature AND a.place = floor(spot)
    JOIN sorted b ON b.feature = s.feature AND b.place = least(floor(spot) + 1, s.n - 1)),
ranges AS (SELECT feature, min(v) AS low, max(v) AS high, count(DISTINCT side) AS sides FROM long GROUP BY feature),
few AS (SELECT feature FROM quantiles GROUP BY feature HAVING count(*) < 3),
edges AS (
  SELECT feature, edge FROM quantiles JOIN ranges USING (feature) WHERE feature NOT IN (SELECT feature FROM few) AND sides = 2
  UNION
  SELECT feature, CASE WHEN i = 10 THEN high ELSE low + i * ((high - low) / 10) END FROM ranges, range(11) r(i)
  WHERE feature IN (SELECT feature FROM few) AND low < high AND sides = 2),
placed AS (SELECT feature, edge, CAST(row_number() OVER (PARTITION BY feature ORDER BY edge) - 1 AS INTEGER) AS position,
    count(*) OVER (PARTITION BY feature) AS n_edges FROM edges),
bins AS (SELECT a.feature, a.position AS bin, CASE WHEN a.position = 0 THEN -1e300 ELSE a.edge END AS lo,
    CASE WHEN b.position = a.n_edges - 1 THEN 1e300 ELSE b.edge END AS hi
  FROM placed a JOIN placed b ON a.feature = b.feature AND b.position = a.position + 1),
bin_counts AS (SELECT b.feature, b.bin, count(*) FILTER (WHERE side = 'reference') AS reference,
    count(*) FILTER (WHERE side = 'current') AS current
  FROM bins b LEFT JOIN long l ON l.feature = b.feature AND l.v >= b.lo AND l.v < b.hi GROUP BY b.feature, b.bin),
floored AS (SELECT feature, greatest(CAST(reference AS DOUBLE) / sum(reference) OVER w, CAST(1e-6 AS DOUBLE)) AS e,
    greatest(CAST(current AS DOUBLE) / sum(current) OVER w, CAST(1e-6 AS DOUBLE)) AS a FROM bin_counts WINDOW w AS (PARTITION BY feature)),
index_values AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM floored GROUP BY feature),
drift AS (SELECT feature, 'PSI' AS metric, coalesce(psi, 0.0) AS value
  FROM (SELECT DISTINCT feature FROM long) LEFT JOIN index_values USING (feature))"""


def level(value: str) -> str:
    return f"CASE WHEN {value} >= 0.25 THEN 'HIGH' WHEN {value} >= 0.1 THEN 'MEDIUM' ELSE 'LOW' END"


def named(names: Sequence[str]) -> list[tuple[str, str]]:
    return [(name, name) for name in names]


METRIC = f"SELECT feature, metric, round(value, 6) AS value, {level('value')} AS severity"
_ALL = f"WITH {WINDOWED}, {stability(named([*WATCHED, SCORE]))}"
ORACLES["psi_edges"] = f"{_ALL} SELECT feature, position, edge FROM placed"
ORACLES["psi_fallback_edges"] = (
    f"WITH {WINDOWED}, {stability(named(['dest_seen_before', 'orig_dest_prior_txn_count']))} "
    "SELECT feature, position, edge FROM placed"
)
ORACLES["psi_bin_counts"] = f"{_ALL} SELECT feature, bin, reference, current FROM bin_counts"
ORACLES["psi"] = f"{_ALL} SELECT feature, round(psi, 9) AS psi FROM index_values"
ORACLES["numeric_drift"] = f"WITH {WINDOWED}, {stability(named(WATCHED))} {METRIC} FROM drift"
ORACLES["score_drift"] = f"WITH {WINDOWED}, {stability(named([SCORE]))} {METRIC} FROM drift"
VARIATION = """by_type AS (SELECT type, CAST(count(*) FILTER (WHERE side = 'reference') AS DOUBLE) / (SELECT count(*) FROM windowed WHERE side = 'reference') AS e,
    CAST(count(*) FILTER (WHERE side = 'current') AS DOUBLE) / (SELECT count(*) FROM windowed WHERE side = 'current') AS a
  FROM windowed GROUP BY type),
variation AS (SELECT 'type' AS feature, 'total_variation' AS metric, sum(abs(e - a)) / 2 AS value FROM by_type)"""
ORACLES["categorical_total_variation"] = f"WITH {WINDOWED}, {VARIATION} {METRIC} FROM variation"
ORACLES["severity"] = from_scored(f"SELECT event_id, {level('score')} AS severity FROM scored")
ORACLES["overall_severity"] = from_scored(
    f"SELECT type, {level('max(score)')} AS overall_severity FROM scored GROUP BY type"
)
SHIFT = """SELECT round(r, 8) AS reference_fraud_rate, round(c, 8) AS current_fraud_rate, round(c / greatest(r, 1e-12), 4) AS fraud_rate_ratio
FROM (SELECT avg(isFraud) FILTER (WHERE side = 'reference') AS r, avg(isFraud) FILTER (WHERE side = 'current') AS c FROM windowed)"""
ORACLES["label_shift"] = f"WITH {WINDOWED} {SHIFT}"
ORACLES["window_profile"] = (
    f"WITH {WINDOWED} SELECT side AS \"window\", count(*) AS rows, min(step) AS min_step, max(step) AS max_step "
    "FROM windowed GROUP BY side"
)
_REPORT = f"{_ALL}, {VARIATION}, metrics AS ({METRIC} FROM (SELECT * FROM drift UNION ALL SELECT * FROM variation))"
_WORST = (
    "CASE WHEN count(*) FILTER (WHERE severity = 'HIGH') > 0 THEN 'HIGH' "
    "WHEN count(*) FILTER (WHERE severity = 'MEDIUM') > 0 THEN 'MEDIUM' ELSE 'LOW' END"
)
ORACLES["drift_report"] = (
    f"{_REPORT} SELECT (SELECT {_WORST} FROM metrics) AS overall_severity, feature, metric, value, severity FROM metrics"
)
ORACLES["read_report"] = f"""{_REPORT}, scored AS (SELECT *, {SCORE} AS score FROM windowed), {CURRENT},
  {ranking("current_rows")}, {counts("current_rows")}, shift AS ({SHIFT})
SELECT (SELECT count(*) FROM windowed WHERE side = 'reference') AS reference_rows,
  (SELECT count(*) FROM windowed WHERE side = 'current') AS current_rows, (SELECT {_WORST} FROM metrics) AS overall_severity,
  shift.*, {HELDOUT}, 'step < 355' AS reference_window, 'step >= 355' AS current_window,
  (SELECT max(step) FROM windowed WHERE side = 'reference') AS reference_step_max,
  (SELECT min(step) FROM windowed WHERE side = 'current') AS current_step_min
FROM rates, ranked, shift"""

# --- lifecycle rules ---------------------------------------------------------------------------------------------

_SEGMENTS = [(f"hour_{hour}", f"CASE WHEN hour = {hour} THEN score END") for hour in range(24)]
ORACLES["retraining_policy"] = f"""WITH {WINDOWED}, segmented AS (SELECT *, {SCORE} AS score FROM windowed),
{stability(_SEGMENTS, "segmented")},
held_out AS (SELECT * FROM segmented WHERE side = 'current'), {ranking("held_out", "hour, ")},
shift AS (SELECT hour, round(avg(isFraud) FILTER (WHERE side = 'current') / greatest(avg(isFraud) FILTER (WHERE side = 'reference'), 1e-12), 4)
  AS fraud_rate_ratio FROM segmented GROUP BY hour),
facts AS (SELECT CAST(hour AS INTEGER) AS hour, {level("value")} AS score_severity, fraud_rate_ratio, round(ap, 9) AS pr_auc
  FROM shift JOIN ranked USING (hour) JOIN drift ON feature = 'hour_' || hour),
fired AS (SELECT *, concat_ws(' ', CASE WHEN score_severity = 'HIGH' THEN 'High model-score distribution drift detected.' END,
  CASE WHEN fraud_rate_ratio >= 2 THEN 'Fraud prevalence shifted beyond the configured threshold.' END,
  CASE WHEN pr_auc < 0.9 THEN 'Held-out PR-AUC fell below the configured minimum.' END) AS reasons FROM facts)
SELECT hour, score_severity, fraud_rate_ratio, pr_auc, reasons <> '' AS retraining_recommended, false AS auto_promotion_allowed,
  CASE WHEN reasons <> '' THEN 'HIGH' ELSE 'LOW' END AS severity, reasons FROM fired"""

BOTH = f"""{FEAT}, both_scores AS (
  SELECT step % 24 AS hour, isFraud, 'champion' AS model, least(1.0, amount / 300) AS score FROM feat WHERE step >= 525
  UNION ALL
  SELECT step % 24, isFraud, 'candidate', least(1.0, CASE WHEN type = 'TRANSFER' THEN amount / 250 ELSE amount / 1000 END)
  FROM feat WHERE step >= 525
)"""
ORACLES["champion_vs_challenger"] = f"""WITH {BOTH}, {ranking("both_scores", "model, ")}, {counts("both_scores", "model, ")}
SELECT model, round(auc, 9) AS roc_auc, round(ap, 9) AS pr_auc, {RATES}, tn, fp, fn, tp FROM rates JOIN ranked USING (model)"""
_SIDES = ", ".join(
    f"max({value}) FILTER (WHERE model = '{side}') AS {side}_{name}"
    for side in ("champion", "candidate")
    for name, value in (("pr_auc", "round(ap, 9)"), ("recall", "round(r, 9)"), ("precision", "round(p, 9)"), ("fp", "fp"))
)
ORACLES["promotion_gate"] = f"""WITH {BOTH}, {ranking("both_scores", "hour, model, ")}, {counts("both_scores", "hour, model, ")},
pairs AS (SELECT CAST(hour AS INTEGER) AS hour, {_SIDES} FROM rates JOIN ranked USING (hour, model) GROUP BY hour),
judged AS (SELECT *, concat_ws(' ',
  CASE WHEN candidate_pr_auc - champion_pr_auc < 0 THEN 'Candidate PR-AUC does not meet the required improvement.' END,
  CASE WHEN champion_recall - candidate_recall > 0.02 THEN 'Candidate recall degradation exceeds the allowed limit.' END,
  CASE WHEN champion_precision - candidate_precision > 0.05 THEN 'Candidate precision degradation exceeds the allowed limit.' END,
  CASE WHEN CAST(candidate_fp AS DOUBLE) / greatest(champion_fp, 1) > 2 THEN 'Candidate false-positive increase exceeds the allowed limit.' END
  ) AS reasons FROM pairs)
SELECT *, reasons = '' AS promotion_recommended,
  CASE WHEN reasons = '' THEN 'CANDIDATE_APPROVED_FOR_REVIEW' ELSE 'KEEP_PRODUCTION' END AS decision FROM judged"""

# --- fitted models: what holds for any model ---------------------------------------------------------------------

ORACLES["save_load_model"] = from_tx("SELECT count(*) AS rows, 0 AS differing FROM tx")
ORACLES["score"] = from_tx("SELECT event_id, true AS is_probability, true AS walk_agrees FROM tx")
ORACLES["fit_classifier"] = (
    f"WITH {TX}, {cut(0.8)} SELECT event_id, isFraud, true AS is_probability FROM tx, cut WHERE step >= cutoff"
)
ORACLES["train_challenger"] = from_tx(
    "SELECT event_id, true AS is_probability, true AS walk_agrees FROM tx WHERE step >= 525"
)
ORACLES["score_transactions"] = ORACLES["score_stream"] = f"""WITH {REQUESTS}, checked AS (
  SELECT event_id, amount >= 0 AND dest_seen_before <= 1 AND type <> 'UNKNOWN' AS valid,
    concat_ws(',', CASE WHEN amount < 0 THEN 'amount' END, CASE WHEN dest_seen_before > 1 THEN 'dest_seen_before' END,
              CASE WHEN type = 'UNKNOWN' THEN 'type' END) AS violations FROM requests)
SELECT event_id, valid, violations, CASE WHEN valid THEN CAST(0.5 AS DOUBLE) END AS threshold, true AS consistent FROM checked"""
_HELD_OUT = """SELECT CAST(count(*) FILTER (WHERE isFraud = 0) AS BIGINT) AS negatives,
  CAST(count(*) FILTER (WHERE isFraud = 1) AS BIGINT) AS positives"""
ORACLES["train_behavioral"] = ORACLES["train_leakage_safe"] = (
    f"WITH {TX}, {cut(0.8)} {_HELD_OUT}, any_value(cutoff) AS cutoff_step FROM tx, cut WHERE step >= cutoff"
)
ORACLES["train_leaky_benchmark"] = from_tx(
    f"""{_HELD_OUT}, CAST(NULL AS INTEGER) AS cutoff_step
FROM (SELECT isFraud, row_number() OVER (ORDER BY event_id) > floor(count(*) OVER () * CAST(0.8 AS DOUBLE)) AS later FROM tx)
WHERE later"""
)
# The proxy score drifts enough to ask for retraining on every supplied table.
ORACLES["lifecycle_report"] = from_tx(
    """SELECT true AS retraining_recommended, 525 AS candidate_cutoff_step, 'step < 525' AS training_window,
  'step >= 525' AS evaluation_window, CAST(0.5 AS DOUBLE) AS decision_threshold,
  count(*) FILTER (WHERE isFraud = 0) AS champion_negatives, count(*) FILTER (WHERE isFraud = 1) AS champion_positives,
  count(*) FILTER (WHERE isFraud = 0) AS candidate_negatives, count(*) FILTER (WHERE isFraud = 1) AS candidate_positives,
  true AS gate_agrees FROM tx WHERE step >= 525"""
)

# --- a whole fit in SQL ------------------------------------------------------------------------------------------


def boosted(rounds: int, depth: int, rate: float) -> str:
    """Weighted boosting of regression trees under the logistic loss, from ``examples`` (event_id, later, y, w, xs)."""
    steps = ["""spread AS MATERIALIZED (SELECT event_id, unnest(range(1, 1 + len(xs))) AS feature, unnest(xs) AS value FROM examples)""",
        """ends AS MATERIALIZED (SELECT feature, value, lead(value) OVER (PARTITION BY feature ORDER BY value) AS above
  FROM (SELECT DISTINCT feature, value FROM spread JOIN examples USING (event_id) WHERE NOT later))""",
        "margin0 AS (SELECT event_id, CAST(0 AS DOUBLE) AS f FROM examples)"]
    for turn in range(1, rounds + 1):
        steps.append(f"""at{turn}_0 AS MATERIALIZED (SELECT event_id, later, xs, w, 1 AS node,
    CASE WHEN {turn} = 1 THEN y ELSE 4 * y / (1 + exp(2 * y * f)) END AS target
  FROM examples JOIN margin{turn - 1} USING (event_id))""")
        for level in range(depth):
            rows, name = f"at{turn}_{level}", f"{turn}_{level}"
            steps.append(f"""sums{name} AS (SELECT node, feature, value, sum(w) AS w, sum(w * target) AS s
  FROM {rows} JOIN spread USING (event_id) WHERE NOT later GROUP BY ALL)""")
            steps.append(f"""sides{name} AS (SELECT node, feature, value, sum(w) OVER below AS wl, sum(s) OVER below AS sl,
    sum(w) OVER whole AS wt, sum(s) OVER whole AS st, lead(value) OVER (PARTITION BY node, feature ORDER BY value) AS next
  FROM sums{name} WINDOW below AS (PARTITION BY node, feature ORDER BY value), whole AS (PARTITION BY node, feature))""")
            steps.append(f"""best{name} AS MATERIALIZED (SELECT node, feature, (value + above) / 2 AS cut FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, feature, value) AS place FROM (
      SELECT *, sl * sl / wl + (st - sl) * (st - sl) / (wt - wl) - st * st / wt AS gain FROM sides{name} WHERE next IS NOT NULL))
  JOIN ends USING (feature, value) WHERE place = 1 AND gain > 1e-9)""")
            steps.append(f"""at{turn}_{level + 1} AS MATERIALIZED (SELECT event_id, later, xs, w, target,
    CASE WHEN cut IS NULL THEN node WHEN xs[feature] <= cut THEN 2 * node ELSE 2 * node + 1 END AS node
  FROM {rows} LEFT JOIN best{name} USING (node))""")
        weight = 1.0 if turn == 1 else rate
        steps.append(f"""margin{turn} AS MATERIALIZED (SELECT event_id, f + {weight} * leaf AS f
  FROM at{turn}_{depth} JOIN margin{turn - 1} USING (event_id)
  JOIN (SELECT node, sum(w * target) / sum(w) AS leaf FROM at{turn}_{depth} WHERE NOT later GROUP BY node) USING (node))""")
    return ",\n".join(steps)


ORACLES["fit_classifier_coarse"] = f"""WITH {FEAT}, {cut(0.8)},
weight AS (SELECT count(*) FILTER (WHERE isFraud <> 1) / greatest(count(*) FILTER (WHERE isFraud = 1), 1) AS positive
  FROM feat, cut WHERE step < cutoff),
examples AS MATERIALIZED (SELECT event_id, step >= cutoff AS later, CASE WHEN isFraud = 1 THEN 1.0::DOUBLE ELSE -1.0 END AS y,
    CASE WHEN isFraud = 1 THEN positive ELSE 1.0::DOUBLE END AS w,
    [CAST(step % 24 AS DOUBLE), least(floor(amount / 20), 30.0), least(orig_prior_txn_count, 20)::DOUBLE] AS xs
  FROM feat, cut, weight),
{boosted(3, 2, 0.3)}
SELECT event_id, round(1 / (1 + exp(-2 * f)), 9) AS score FROM margin3 JOIN examples USING (event_id) WHERE later"""
