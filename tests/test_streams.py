"""Stream scoring: quarantine, audit rows and repeated batches; plans of batch queries."""

import json
import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
from tenura.operators import audit, quality, retention, score
from tenura.plans import model_queries, registry
from tenura.session import fresh_path
from tenura.sources import files
from tenura.sources.audit_log import BatchLog, append_log, request_rows
from tenura.sources.views import view
from tenura.streaming import scoring, volume
from tenura.streaming.replay import replay
from test_contracts import GOOD


@pytest.fixture(scope="module")
def model(spark, folder):
    return model_queries.loaded(spark, folder)


def _request(number, employees):
    return json.dumps({"request_id": f"r{number}", "created_at": "2024-01-31T10:00:00Z", "employees": employees})


def _start(spark, source, model, sinks):
    scoring.start_scoring(spark, str(source), model, sinks).awaitTermination()


def test_stream(spark, model, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    people = [{**GOOD, "employee_id": f"e{i}", "age": 30 + i} for i in range(10)]
    twice = {**people[0], "employee_id": "twice"}
    lines = [
        _request(1, people[:6]), _request(2, people[6:9] + [{**people[9], "age": 17}]), "{broken", _request(4, []),
        json.dumps({"request_id": "r5", "created_at": "2024-01-31T10:00:00Z"}), _request(6, [{**people[1], "poste": 17}]),
        json.dumps({"request_id": "r7", "created_at": "nonsense", "employees": people[:1]}), _request(8, [twice, twice]),
    ]
    (source / "a.json").write_text("\n".join(lines))
    sinks = scoring.Sinks(f"{tmp_path}/out")
    _start(spark, source, model, sinks)
    assert spark.read.parquet(sinks.scored).count() == 11
    held = spark.read.parquet(sinks.quarantine)
    rules = {(r["request_id"], r["rule"]) for r in held.select("request_id", F.inline("errors")).collect()}
    assert {("r2", "range"), ("r4", "employees_required"), ("r5", "employees_required"), ("r6", "text")} <= rules
    assert held.where(F.col("payload") == "{broken").count() == 1
    requests = spark.read.parquet(sinks.requests)
    by_status = {r["http_status"]: r["n"] for r in requests.groupBy("http_status").agg(F.count("*").alias("n")).collect()}
    assert by_status == {200: 2, 422: 6} and requests.where("response_time_ms is null or created_date is null").count() == 0
    logged = spark.read.parquet(sinks.predictions)
    assert logged.where(~F.col("attrition_prob").between(0, 1)).count() == 0
    assert logged.select("id").distinct().count() == 11
    assert quality.orphans(logged, requests).count() == 0
    assert logged.join(requests.select(F.col("id").alias("request_id"), "http_status"), "request_id").count() == 11
    shots = logged.withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))
    by_department = audit.avg_prob_by_snapshot(shots, audit.latest(shots)).collect()
    assert [(r["department"], r["prediction_count"]) for r in by_department] == [("Warehouse", 11)]

    # A later file is picked up where the stream stopped.
    (source / "b.json").write_text(_request(9, [{**people[0], "employee_id": "late"}]))
    _start(spark, source, model, sinks)
    assert spark.read.parquet(sinks.scored).count() == 12
    assert spark.read.parquet(sinks.predictions).count() == 12


def test_repeated_batch_and_new_checkpoint(spark, model, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(_request(1, [{**GOOD, "employee_id": "e1"}]))
    sinks = scoring.Sinks(f"{tmp_path}/out")
    for _ in range(2):  # the same micro-batch of the same run leaves one copy
        scoring.score_batch(files.read_batches(spark, str(source)), 0, model, sinks, "first")
    assert spark.read.parquet(sinks.scored).count() == 1 and spark.read.parquet(sinks.predictions).count() == 1
    scoring.score_batch(files.read_batches(spark, str(source)), 0, model, sinks, "second")
    assert spark.read.parquet(sinks.predictions).count() == 2


def test_a_failing_log_does_not_stop_scoring(spark, model, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    out.mkdir()
    (source / "a.json").write_text(_request(1, [{**GOOD, "employee_id": "e1"}]))
    (out / "predictions").write_text("a file where a folder should be")
    sinks = scoring.Sinks(str(out))
    _start(spark, source, model, sinks)
    assert spark.read.parquet(sinks.scored).count() == 1
    (out / "predictions").unlink()
    assert scoring.repair_log(spark, sinks, model.version) == 1
    assert spark.read.parquet(sinks.predictions).count() == 1 and scoring.repair_log(spark, sinks, model.version) == 0


@pytest.mark.parametrize("lost_at", ["requests", "commit"])
def test_a_lost_writer_leaves_nothing_that_is_read(spark, model, tmp_path, monkeypatch, lost_at):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.json").write_text(_request(1, [{**GOOD, "employee_id": "e1"}]))
    sinks = scoring.Sinks(f"{tmp_path}/out")
    batches = files.read_batches(spark, str(source))
    scoring.score_batch(batches, 0, model, sinks, "run")
    write, publish = BatchLog.write, BatchLog.publish

    def lose(*_):
        raise RuntimeError("lost")

    def write_first(log, df, path, run, batch_id):
        if path == log.requests and lost_at == "requests":
            lose()
        write(log, df, path, run, batch_id)

    monkeypatch.setattr(BatchLog, "write", write_first)
    if lost_at == "commit":
        monkeypatch.setattr(BatchLog, "publish", lose)
    with pytest.raises(RuntimeError, match="lost"):
        scoring.score_batch(batches, 1, model, sinks, "run")
    assert spark.read.parquet(sinks.predictions).count() == 2  # written, but not published
    assert [t.count() for t in sinks.log.published(spark)] == [1, 1]
    with pytest.raises(RuntimeError, match="lost"):  # a published batch that is written again is out of sight until it is whole
        scoring.score_batch(batches, 0, model, sinks, "run")
    assert [t.count() for t in sinks.log.published(spark)] == [0, 0]
    monkeypatch.setattr(BatchLog, "write", write)
    monkeypatch.setattr(BatchLog, "publish", publish)
    assert scoring.repair_log(spark, sinks, model.version) == 2
    assert [t.count() for t in sinks.log.published(spark)] == [2, 2]
    assert scoring.repair_log(spark, sinks, model.version) == 0


def test_every_prediction_of_a_request_has_a_row(spark):
    requests = spark.createDataFrame([(1,), (2,), (3,)], "id long")
    rows = [(f"p{i}", 1 if i < 90 else 2, 0.5, "LOW") for i in range(100)]
    predictions = spark.createDataFrame(rows, "id string, request_id long, attrition_prob double, risk_level string")
    got = audit.requests_with_predictions(requests, predictions).collect()
    places = {k: sorted(r["position"] for r in got if r["id"] == k and r["position"]) for k in (1, 2, 3)}
    assert places == {1: list(range(1, 91)), 2: list(range(1, 11)), 3: []} and len(got) == 101


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["build_central", "rate_by_category", "fk_orphans", "profile_columns", "validate_rows",
                                  "under_random", "stratified_folds", "requests_with_predictions"])
def test_no_single_partition_exchange(spark, folder, name):
    """Only totals of buckets may meet in one task."""
    plan = _plan(entry_points.queries()[name](spark, folder))
    for line in plan.splitlines():
        if "SinglePartition" in line:
            assert name in ("under_random",), line


def test_filters_and_columns_reach_the_scan(spark, folder):
    plan = _plan(audit.count_by_risk(view(spark, folder, "predictions").where(F.col("created_at") > "2000-01-01")))
    assert re.search(r"PushedFilters: \[.*GreaterThan\(l_shipdate", plan)
    assert re.search(r"ReadSchema: struct<l_discount:double,l_shipdate:timestamp_ntz>", plan)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - {
    n for n in registry.QUERIES if n.startswith(("cv_", "clf_", "oof", "gate_rank_fit", "threshold_metrics_cv",
                                                       "train", "model", "score", "explain", "stream", "smote",
                                                       "near", "tomek", "knn", "over", "corr_k", "corr_s"))}))
def test_no_cross_join(spark, folder, name):
    plan = _plan(entry_points.queries()[name](spark, folder))
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_look_back_reaches_the_file_statistics(spark, folder):
    predictions = view(spark, folder, "predictions")
    plan = _plan(audit.daily_volume(predictions, audit.latest(predictions)))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(l_shipdate", plan)


def test_log_round_trip_by_day(spark, folder):
    path = fresh_path(spark, "log")
    requests = view(spark, folder, "requests")
    rows = request_rows(requests, "/p", F.col("request_data"), F.col("http_status"), F.col("created_at"), F.col("id"))
    append_log(rows, path)
    log = spark.read.parquet(path)
    recent = audit.since(log, audit.latest(log), 30)
    assert "PartitionFilters: [isnotnull(created_date" in _plan(recent)
    assert recent.count() == audit.since(requests, audit.latest(requests), 30).count()


def test_cleanup_leaves_other_days_alone(spark, tmp_path):
    day = "TIMESTAMP '2024-01-01 10:00:00'"
    requests = spark.range(40).selectExpr(
        "concat('r', id) AS id", f"{day} - make_interval(0, 0, 0, 0, cast(id * 12 AS INT)) AS created_at"
    ).withColumn("created_date", F.to_date("created_at"))
    predictions = requests.selectExpr("concat('p', id) AS id", "id AS request_id", "created_at + INTERVAL 30 HOURS AS created_at")
    predictions = predictions.withColumn("created_date", F.to_date("created_at"))
    paths = [f"{tmp_path}/{name}" for name in ("requests", "predictions")]
    for df, path in zip((requests, predictions), paths):
        append_log(df, path)
    moment = spark.range(1).select(F.expr(day)).first()[0]
    before = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("*/created_date=2024-01-01/*.parquet")}
    removed = retention.cleanup(spark, *paths, moment, days=10)
    kept = spark.read.parquet(paths[0])
    assert removed == 40 - kept.count() and kept.agg(F.min("created_at")).first()[0] >= moment - timedelta(days=10)
    left = spark.read.parquet(paths[1])
    assert left.count() == kept.count() and quality.orphans(left, kept).count() == 0
    after = {p.name: p.stat().st_mtime_ns for p in tmp_path.glob("*/created_date=2024-01-01/*.parquet")}
    assert before and before == after
    assert not list(tmp_path.glob("requests/created_date=2023-12-15"))
    assert retention.cleanup(spark, *paths, moment, days=10) == 0


def test_months_without_known_outcomes_have_no_accuracy(spark):
    predictions = spark.createDataFrame([("e1", 0.9, "2024-01-05"), ("e2", 0.1, "2024-02-05")], "employee_id string, attrition_prob double, d string")
    predictions = predictions.withColumn("created_at", F.col("d").cast("timestamp_ntz"))
    outcomes = spark.createDataFrame([("e1", True), ("e2", None)], "employee_id string, actual boolean")
    got = {r["month"]: r["accuracy"] for r in audit.accuracy_over_time(predictions, outcomes).collect()}
    assert got == {"2024-01": 1.0, "2024-02": None}


def _deliveries(spark, rows):
    return spark.createDataFrame(rows, "n int, created_at string, request_id string")


def _days(found):
    return {str(r["date"]): r[1] for r in found.collect()}


def test_late_rows_are_kept_until_their_day_is_closed(spark):
    rows = _deliveries(spark, [
        (1, "2024-01-01 08:00:00", "a"), (1, "2024-01-02 10:00:00", "b"),
        # The watermark is 1 January, 10:00: the first is still open.
        (2, "2024-01-01 09:00:00", "c"), (2, "2024-01-03 23:00:00", "d"),
        # It is 2 January, 23:00 now: the first is closed, the second is not.
        (3, "2024-01-01 09:30:00", "e"), (3, "2024-01-02 11:00:00", "f"), (3, "2024-01-05 12:00:00", "g"),
        # 4 January, 12:00: late by days; and rows without a time or delivery.
        (4, "2024-01-03 12:00:00", "h"), (4, "2024-01-04 13:00:00", "i"), (4, None, "j"), (None, "2024-01-04 13:00:00", "k"),
        (5, "2024-01-09 00:00:00", "l"),
    ])
    found = replay(rows, F.col("n"), volume.daily_volume)
    assert _days(found) == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-03": 1, "2024-01-04": 1, "2024-01-05": 1}


def test_repeats_are_counted_once_across_deliveries(spark):
    rows = _deliveries(spark, [
        (1, "2024-01-01 08:00:00", "a"), (1, "2024-01-01 08:00:00", "a"), (1, "2024-01-01 20:00:00", "b"),
        (2, "2024-01-01 08:00:00", "a"), (2, "2024-01-02 07:00:00", "a"), (2, "2024-01-02 08:00:00", "c"),
        (3, "2024-01-02 08:00:00", "c"), (3, "2024-01-06 00:00:00", "z"),
        (4, "2024-01-09 00:00:00", "y"),
    ])
    found = replay(rows, F.col("n"), volume.daily_requests)
    assert _days(found) == {"2024-01-01": 2, "2024-01-02": 2, "2024-01-06": 1}


def test_replay_does_not_depend_on_files(spark):
    rows = _deliveries(spark, [(d, f"2024-01-{1 + (d * 3 + i) % 20:02d} 06:00:00", str(i)) for d in range(4) for i in range(30)])
    one, many = (replay(rows.repartition(n), F.col("n"), volume.daily_volume) for n in (1, 7))
    assert _days(one) == _days(many) != {}
    assert _days(replay(rows.limit(0), F.col("n"), volume.daily_volume)) == {}
