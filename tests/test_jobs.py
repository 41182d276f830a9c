"""Sources, sinks, training, scoring, reports and streaming end to end on the smallest tables."""

import glob
import json
import threading

import pyarrow.parquet as parquet
import pytest
from pyspark.sql import functions as F

from steprisk.catalog import queries
from steprisk.functions.rowfeatures import MODEL_FEATURES, model_columns
from steprisk.operators.drift import SCORE_FEATURE
from steprisk.operators.history import behavioral_features
from steprisk.operators.metrics import threshold_sweep
from steprisk.operators.quality import quality_report
from steprisk.plans import lifecycle, monitoring, training, trees
from steprisk.plans import boosting as boosting_module
from steprisk.plans.training import Boosting
from steprisk.schema import DRIFT_FEATURES, DRIFT_REPORT, FEATURE_TABLE, LIFECYCLE_REPORT, TRANSACTIONS
from steprisk.sources import features as feature_source
from steprisk.sources import reports, runlog
from steprisk.sources.events import read_events_as_transactions
from steprisk.sources.transactions import read_transactions, typed_projection, with_row_key
from steprisk.streaming.scoring import score_stream
from tests.conftest import SMALL

FEW = Boosting(rounds=3, depth=3)


@pytest.fixture(scope="module")
def champion(features):
    return training.train_behavioral(features, boosting=FEW).model


def same(left, right):
    right = right.select(*left.columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_csv_round_trip(spark, tx, tmp_path):
    path = str(tmp_path / "tx")
    tx.select("event_id", *TRANSACTIONS.fieldNames()).write.csv(path, header=True)
    table = read_transactions(spark, path)
    assert [table.schema[f.name].dataType for f in TRANSACTIONS] == [f.dataType for f in TRANSACTIONS]
    assert same(tx.drop("event_id"), table.drop("event_id"))


def test_csv_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_transactions(spark, str(tmp_path / "nothing"))
    (tmp_path / "short.csv").write_text("step,type\n1,DEBIT\n")
    with pytest.raises(ValueError, match="amount"):
        read_transactions(spark, str(tmp_path / "short.csv"))


def test_typed_projection_of_dirty_text(spark):
    text = spark.createDataFrame(
        [("1", "DEBIT", "oops", "C1", "2.5", "M1", "0", "1")],
        "step string, type string, amount string, nameOrig string, oldbalanceOrg string, nameDest string, "
        "oldbalanceDest string, isFraud string",
    )
    row = typed_projection(text, permissive=True).first()
    assert (row.step, row.amount, row.oldbalanceOrg, row.isFraud) == (1, None, 2.5, 1)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        typed_projection(text).collect()


def test_row_key(spark, tx):
    assert with_row_key(tx) is tx
    keyed = with_row_key(tx.drop("event_id"))
    assert keyed.select("event_id").distinct().count() == tx.count()


def test_step_does_not_depend_on_the_session_zone(spark, tx):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        moved = read_events_as_transactions(spark, "/root/testdata/sf0.001").select("event_id", "step").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted(moved) == sorted(tx.select("event_id", "step").collect())


@pytest.mark.parametrize("global_order", [False, True])
def test_feature_sink(spark, tx, tmp_path, global_order):
    path = str(tmp_path / "features")
    feature_source.write_features(behavioral_features(tx), path, global_order=global_order)
    table = spark.read.parquet(path)
    assert table.columns == ["event_id", *FEATURE_TABLE.fieldNames()]
    assert [table.schema[f.name].dataType for f in FEATURE_TABLE] == [f.dataType for f in FEATURE_TABLE]
    per_file = table.select(F.input_file_name().alias("f"), "step").collect()
    for name in {row.f for row in per_file}:
        inside = [row.step for row in per_file if row.f == name]
        assert inside == sorted(inside)
    assert tuple(feature_source.output_summary(table).first()) == (1000, 1, 720)


def test_read_window_reaches_the_scan(spark, features, tmp_path):
    path = str(tmp_path / "features")
    feature_source.write_features(features, path)
    window = feature_source.read_window(spark, path, "step < 355", ["step", "amount"])
    plan = window._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(step,355)" in plan and "ReadSchema: struct<step:int,amount:double>" in plan
    assert window.agg(F.max("step")).first()[0] == 354


def test_step_predicates_skip_files(spark, features, tmp_path):
    """The footers tell which files a window on steps need not open."""
    path = str(tmp_path / "ordered")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        feature_source.write_features(features, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spans = []
    for file in glob.glob(f"{path}/*.parquet"):
        footer = parquet.ParquetFile(file).metadata
        groups = [footer.row_group(n).column(footer.schema.names.index("step")).statistics for n in range(footer.num_row_groups)]
        spans.append((min(g.min for g in groups), max(g.max for g in groups)))
    spans.sort()
    assert len(spans) > 2 and all(one[1] <= two[0] for one, two in zip(spans, spans[1:]))
    assert any(low >= 355 for low, _ in spans)


def test_report_round_trip(spark, tx, tmp_path):
    report = quality_report(tx, TRANSACTIONS.fieldNames())
    reports.write_report(report, str(tmp_path / "report"))
    assert reports.read_report(spark, str(tmp_path / "report"), report.schema).collect() == report.collect()
    (tmp_path / "pretty.json").write_text(json.dumps(report.first().asDict(), indent=2))
    assert reports.read_report(spark, str(tmp_path / "pretty.json"), report.schema).collect() == report.collect()
    with pytest.raises(FileNotFoundError):
        reports.read_report(spark, str(tmp_path / "nothing"), report.schema)


def test_threshold_table_round_trip(spark, features, tmp_path):
    sweep = threshold_sweep(features.withColumn("score", F.least(F.lit(1.0), F.col("amount") / 300)))
    reports.write_threshold_table(sweep, str(tmp_path / "sweep"))
    (part,) = (tmp_path / "sweep").glob("part-*.csv")
    assert part.read_text().startswith("threshold,precision,recall,f1,tp,fp,fn,tn,")
    assert same(sweep, reports.read_threshold_table(spark, str(tmp_path / "sweep"), sweep.schema))


def test_run_log_appends(spark, tmp_path):
    path = str(tmp_path / "runs")
    first = runlog.log_run(spark, path, "e", "a", {"depth": 6}, {"roc_auc": 0.5})
    second = runlog.log_run(spark, path, "e", "b", {"depth": 7}, {})
    rows = runlog.read_runs(spark, path).collect()
    assert {(r.run_id, r.kind, r.key, r.value) for r in rows} == {
        (first, "param", "depth", "6"), (first, "metric", "roc_auc", "0.5"), (second, "param", "depth", "7"),
    }


def test_model_round_trip(spark, champion, features, tmp_path):
    path = str(tmp_path / "model")
    training.save_model(champion, path)
    loaded = training.load_model(spark, path)
    assert same(
        training.score_feature_table(champion, features).select("event_id", "score"),
        training.score_feature_table(loaded, features).select("event_id", "score"),
    )
    with pytest.raises(FileNotFoundError):
        training.load_model(spark, str(tmp_path / "other"))


def test_walk_down_stored_trees_gives_the_score(spark, champion, features, tmp_path):
    path = str(tmp_path / "walked")
    training.save_model(champion, path)
    some = features.withColumn("oldbalanceOrg", F.when(F.col("event_id") % 5 > 0, F.col("oldbalanceOrg")))
    scored = training.score_feature_table(champion, some)
    inputs = model_columns("double")
    both = trees.walked_score(spark, path, scored, list(inputs), FEW.depth, inputs=inputs)
    assert both.where("abs(score - walked) > 1e-9 OR walked IS NULL").isEmpty()
    assert both.select("walked").distinct().count() > 5
    assert trees.stored_nodes(spark, path).select("tree").distinct().count() == FEW.rounds


def test_bins_reach_the_fit(spark):
    rows = spark.range(2000).select((F.col("id") % 500).alias("x"), (F.col("id") % 500 == 321).cast("int").alias("isFraud"))
    found = {}
    for bins in (32, 1000):
        boosting = Boosting(rounds=1, depth=2, row_fraction=1.0, bins=bins)
        scored = training.score(training.fit_classifier(rows, ["x"], boosting=boosting, positive_weight=1.0), rows)
        found[bins] = scored.where("score > 0.5 AND isFraud = 1").count()
    assert found == {32: 0, 1000: 4}


def test_fit_uses_all_cores_and_few_jobs(spark):
    """Rows of a single input partition are fitted by several tasks, and a level of a tree is one job of one stage."""
    rows = spark.range(0, 4000, 1, 1).select((F.col("id") % 97).alias("x"), (F.col("id") % 97 > 60).cast("int").alias("isFraud"))
    context, seen = spark.sparkContext, []
    for rounds in (2, 6):
        context.setJobGroup(f"fit-{rounds}", "fit")
        training.fit_classifier(rows, ["x"], boosting=Boosting(rounds=rounds, depth=3), positive_weight=2.0)
        tracker = context.statusTracker()
        stages = [tracker.getJobInfo(job).stageIds for job in tracker.getJobIdsForGroup(f"fit-{rounds}")]
        seen.append((len(stages), max(tracker.getStageInfo(at).numTasks for ids in stages for at in ids if tracker.getStageInfo(at))))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert seen[1][0] - seen[0][0] <= 4 * 3 and min(tasks for _, tasks in seen) >= context.defaultParallelism


def test_fit_goes_on_where_margins_are_worked_out_anew(spark, monkeypatch):
    rows = spark.range(600).select(
        (F.col("id") * 7919 % 601).alias("x"), F.when(F.col("id") % 5 > 0, F.col("id") % 13).alias("z"),
        (F.col("id") * 7919 % 601 + F.col("id") % 13 > 400).cast("int").alias("isFraud"),
    )
    found = []
    for after in (60, 2):
        monkeypatch.setattr(boosting_module, "REBASE", after)
        model = training.fit_classifier(rows, ["x", "z"], boosting=Boosting(rounds=7, depth=3), positive_weight=1.0)
        found.append([row.score for row in training.score(model, rows).orderBy("x").collect()])
    assert found[0] == found[1] and len(set(found[0])) > 5


def test_missing_values_are_split_from_all_others(spark):
    rows = spark.range(1000).select(F.when(F.col("id") % 4 > 0, F.col("id")).alias("x"), (F.col("id") % 4 == 0).cast("int").alias("isFraud"))
    model = training.fit_classifier(rows, ["x"], boosting=Boosting(rounds=1, depth=1, row_fraction=1.0), positive_weight=1.0)
    assert training.score(model, rows).where("(score > 0.5) != (isFraud = 1)").isEmpty()
    with pytest.raises(ValueError, match="neither 0 nor 1"):
        training.fit_classifier(rows.withColumn("isFraud", F.lit(2)), ["x"], boosting=FEW, positive_weight=1.0)


def test_thresholds_of_a_rare_class_are_as_many_as_its_weight(spark):
    rows = spark.range(20000).select(F.col("id").cast("double").alias("x"), (F.col("id") >= 19800).alias("_positive"))
    (at,) = boosting_module.split_candidates(rows, ["x"], 32, 99.0)
    assert 14 <= sum(at >= 19800) <= 17 and len(at) == 31


def test_scoring_reads_only_model_inputs(spark, champion, features):
    scored = training.score_feature_table(champion, features).select("event_id", "score")
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "isFraud" not in plan and "orig_prior_amount_sum" not in plan


def test_scores_are_probabilities(champion, features):
    scored = training.score_feature_table(champion, features)
    assert scored.columns == [*features.columns, "score"] and scored.count() == features.count()
    low, high = scored.agg(F.min("score"), F.max("score")).first()
    assert 0.0 <= low < high <= 1.0


@pytest.mark.parametrize("train", [training.train_leaky_benchmark, training.train_leakage_safe])
def test_benchmark_trainings(spark, tx, tmp_path, train):
    trained = train(tx, boosting=FEW)
    row = trained.metrics.first()
    assert row.tn + row.fp + row.fn + row.tp == 200
    run = training.log_training(trained, str(tmp_path / "runs"), "transaction-risk", "test")
    logged = {r.key: r.value for r in runlog.read_runs(spark, str(tmp_path / "runs")).where(F.col("run_id") == run).collect()}
    assert logged["n_estimators"] == "3" and "pr_auc" in logged and "false_positive_rate" in logged


def test_weight_of_missing_positives(spark):
    df = spark.createDataFrame([(0,), (0,)], "isFraud int")
    assert training.class_weight(df).first().scale_pos_weight == 2.0


def requests_from(features):
    return features.withColumn("type", F.when(F.col("event_id") % 10 == 0, "INVALID").otherwise(F.col("type")))


def test_scoring_rejects_and_decides(champion, features):
    rows = training.score_transactions(champion, requests_from(features), threshold=0.5).collect()
    assert len(rows) == 1000
    for row in rows:
        if row.event_id % 10 == 0:
            assert row.violations == ["type"] and row.fraud_probability is None and row.prediction is None
        else:
            assert row.valid and row.threshold == 0.5 and row.prediction in ("fraud", "legitimate")
            assert row.fraud_probability == round(row.fraud_probability, 6)


def test_stream_equals_batch(spark, champion, features, tmp_path):
    source, output = str(tmp_path / "requests"), str(tmp_path / "decisions")
    requests = requests_from(features)
    requests.repartition(3).write.parquet(source)
    stream = spark.readStream.schema(requests.schema).parquet(source)
    score_stream(champion, stream, output, str(tmp_path / "state"), 0.5, available_now=True).awaitTermination()
    assert same(training.score_transactions(champion, requests, 0.5), spark.read.parquet(output))


def test_monitoring_and_lifecycle(spark, champion, features, tmp_path):
    scored = monitoring.store_scores(training.score_feature_table(champion, features), str(tmp_path / "scores"))
    report = monitoring.drift_report(scored, threshold=0.5)
    reports.write_report(report, str(tmp_path / "drift"))
    row = reports.read_report(spark, str(tmp_path / "drift"), DRIFT_REPORT).first()
    assert row == report.first()
    assert row.reference_rows + row.current_rows == 1000
    assert [m.feature for m in row.metrics] == [*DRIFT_FEATURES, "type", SCORE_FEATURE]
    last_before, first_after = features.agg(
        F.max(F.when(F.col("step") < 355, F.col("step"))), F.min(F.when(F.col("step") >= 355, F.col("step")))
    ).first()
    assert (row.reference_step_max, row.current_step_min) == (last_before, first_after)
    assert row.overall_severity == "HIGH"
    assert row.heldout_performance["rows"] == row.current_rows

    poor = report.withColumn(
        "label_monitoring", F.col("label_monitoring").withField("fraud_rate_ratio", F.lit(5.0))
    )
    result = lifecycle.lifecycle_report(
        poor, features, champion, str(tmp_path / "candidate"), threshold=0.5, boosting=FEW
    )
    reports.write_report(result, str(tmp_path / "lifecycle"))
    found = reports.read_report(spark, str(tmp_path / "lifecycle"), LIFECYCLE_REPORT).first()
    assert found == result.first()
    assert found.trigger.retraining_recommended and not found.trigger.auto_promotion_allowed
    assert found.promotion.decision in ("KEEP_PRODUCTION", "CANDIDATE_APPROVED_FOR_REVIEW")
    assert sum(found.candidate_metrics[name] for name in ("tn", "fp", "fn", "tp")) == features.where("step >= 525").count()
    training.load_model(spark, str(tmp_path / "candidate"))


def test_lifecycle_query_fits_both_models_at_once(spark, champion, monkeypatch):
    """Each fit waits until the other one runs."""
    both, taken = threading.Barrier(2, timeout=90), []

    def fitting(name):
        def fit(*given):
            both.wait()
            taken.append(name)
            return champion

        return fit

    monkeypatch.setattr(queries, "champion", fitting("champion"))
    monkeypatch.setattr(lifecycle, "train_challenger", fitting("challenger"))
    row = queries.QUERIES["lifecycle_report"](spark, SMALL).first()
    assert sorted(taken) == ["challenger", "champion"]
    assert row.retraining_recommended and row.champion_negatives == row.candidate_negatives > 0


def test_failed_champion_fails_the_lifecycle(spark, features, champion, monkeypatch, tmp_path):
    def broken(*given):
        raise ValueError("no champion")

    monkeypatch.setattr(queries, "champion", broken)
    monkeypatch.setattr(lifecycle, "train_challenger", lambda *given: champion)
    with pytest.raises(ValueError, match="no champion"):
        queries.QUERIES["lifecycle_report"](spark, SMALL)


def test_few_rows_are_added_up_by_few_tasks(spark, monkeypatch):
    """A level's job has a task for every ``BLOCK_ROWS`` rows, whatever the cluster's size; the trees are those of many tasks."""
    rows = spark.range(2_000).selectExpr("CAST(hash(id) % 100 AS DOUBLE) AS x", "CAST(hash(id) % 100 > 30 AS INT) AS isFraud")
    parts, nodes, inner = [], [], boosting_module._fitted_tree
    monkeypatch.setattr(boosting_module, "_fitted_tree", lambda state, *given: parts.append(state.getNumPartitions()) or inner(state, *given))
    for size in (1 << 17, 500, 100):
        monkeypatch.setattr(boosting_module, "BLOCK_ROWS", size)
        trees = boosting_module.fit_trees(
            rows.select("x", (F.col("isFraud") == 1).alias(boosting_module.POSITIVE)), ["x"], 2.0, Boosting(rounds=1, depth=3, row_fraction=1.0)
        )
        nodes.append([node[:1] + node[3:] for node in trees[0][0].nodes])
    assert parts == [1, 4, 4] and nodes[0] == nodes[1] == nodes[2] and len(nodes[0]) > 1


def test_stable_report_stops_the_lifecycle(spark, features, champion, tmp_path):
    calm = spark.createDataFrame(
        [{"metrics": [], "label_monitoring": {"fraud_rate_ratio": 1.0}, "heldout_performance": {"pr_auc": 0.95}}],
        DRIFT_REPORT,
    )
    report = lifecycle.lifecycle_report(calm, features, champion, str(tmp_path / "candidate"))
    assert report.collect() == [] and "promotion" in report.columns


def test_model_inputs_hold_nothing_known_later():
    assert not {"newbalanceOrig", "newbalanceDest", "isFlaggedFraud", "isFraud"} & set(MODEL_FEATURES)


def test_row_keys_do_not_depend_on_splits(spark, tmp_path):
    """Several files of several blocks: the same key for every row under two sizes of a split, without gaps, in file order."""
    folder = str(tmp_path / "many")
    rows = spark.range(6_000).selectExpr("id AS mark", "repeat('x', CAST(id % 40 AS INT)) AS pad").repartitionByRange(3, "mark")
    rows.sortWithinPartitions("mark").write.csv(folder, header=True)
    before, found = spark.conf.get("spark.sql.files.maxPartitionBytes"), []
    try:
        for size in ("134217728", "9000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            keyed = with_row_key(spark.read.csv(folder, header=True))
            found.append({int(row["mark"]): row["event_id"] for row in keyed.collect()})
            if size == "9000":
                assert spark.read.csv(folder, header=True).rdd.getNumPartitions() > 6
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] == {n: n for n in range(6_000)}
