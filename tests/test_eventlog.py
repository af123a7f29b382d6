"""Metrics from the event log of a real run, and from hand-written lines."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from strataflow.catalogue.runs import _event_logs
from strataflow.operators.stages import LEDGER_COLUMNS
from strataflow.sources import digest_event_log, event_log_ledger, event_log_metrics, run_wall_clock, stage_memory

RUN = """
import sys
from pyspark.sql import SparkSession
from strataflow.plans import run_pipeline, telemetry_config
base, root, logs = sys.argv[1:]
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", logs).config("spark.sql.shuffle.partitions", "2")
         .config("spark.sql.warehouse.dir", base + "/warehouse").getOrCreate())
run_pipeline(spark, telemetry_config(root, run="7")).collect()
spark.stop()
"""


def test_real_event_log_sums_by_stage(spark, tmp_path):
    from tests.test_layers import landing

    root, logs = landing(tmp_path / "landing"), tmp_path / "logs"
    logs.mkdir()
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"PYTHONPATH": home}
    command = [sys.executable, "-c", RUN, str(tmp_path), root, str(logs)]
    done = subprocess.run(command, env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
    found = {r.job_group: r for r in event_log_metrics(spark, str(logs)).collect()}
    assert set(found) == {"7/bronze", "7/silver", "7/gold", None}
    for stage, rows_out in (("bronze", 15), ("silver", 9), ("gold", 9)):
        row = found[f"7/{stage}"]
        assert row.rows_out == rows_out
        assert row.tasks >= row.stages > 0
        assert row.failed_tasks == 0
        assert row.write_bytes > 0
        assert row.elapsed_ms >= 0

    ledger = event_log_ledger(spark, str(logs))
    assert ledger.columns == ["app", *LEDGER_COLUMNS]
    (run,) = ledger.collect()
    assert run.run == 7
    assert run.total_time == run.t_bronze + run.t_silver + run.t_gold
    assert run.write_gold > 0
    assert run.cpu_ingest is None


def test_hand_written_events(spark, tmp_path):
    task = {"Event": "SparkListenerTaskEnd", "Stage ID": 3, "Task End Reason": {"Reason": "Success"},
            "Task Info": {"Launch Time": 1000, "Finish Time": 3000},
            "Task Metrics": {"Executor Run Time": 2000, "Executor CPU Time": 1_000_000_000,
                             "Input Metrics": {"Bytes Read": 100, "Records Read": 5},
                             "Output Metrics": {"Bytes Written": 300, "Records Written": 5}}}
    lost = {"Event": "SparkListenerTaskEnd", "Stage ID": 3, "Task End Reason": {"Reason": "ExecutorLostFailure"},
            "Task Info": {"Launch Time": 1000, "Finish Time": 2000}}
    start = {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 3},
             "Properties": {"spark.jobGroup.id": "r/bronze"}}
    skipped = {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 4}, "Properties": {}}
    noise = {"Event": "SparkListenerJobEnd", "Job ID": 1}
    lines = [json.dumps(e, separators=(",", ":")) for e in (start, task, noise, lost, skipped)]
    (tmp_path / "app-1.inprogress").write_text("\n".join([*lines, '{"Event":"SparkListenerTaskEnd","Stage']) + "\n")
    row = event_log_metrics(spark, str(tmp_path)).where("job_group = 'r/bronze'").first()
    assert (row.app, row.stages, row.tasks, row.failed_tasks) == ("app-1", 1, 2, 1)
    assert (row.run_ms, row.read_bytes, row.write_bytes, row.spill_bytes) == (2000, 100, 300, 0)
    assert (row.elapsed_ms, row.cpu_pct, row.throughput) == (2000, 50.0, 200.0)


WHOLE_RUN = """
import json, sys, time
from dataclasses import replace
from pyspark.sql import SparkSession
from strataflow.plans import run_pipeline, telemetry_config
base, root, logs = sys.argv[1:]
spark = (SparkSession.builder.master("local-cluster[2,1,1024]").config("spark.ui.enabled", "false")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.logStageExecutorMetrics", "true").config("spark.executor.heartbeatInterval", "500ms")
         .config("spark.eventLog.dir", logs).config("spark.sql.shuffle.partitions", "2").config("spark.driver.memory", "1g")
         .config("spark.checkpoint.dir", base + "/shared").config("spark.sql.warehouse.dir", base + "/warehouse").getOrCreate())
clocks = {}
def run(number, **settings):
    began = time.time()
    run_pipeline(spark, telemetry_config(root, run=number, prefix=f"r{number}_", **settings), lambda name, s: clocks.update({f"{number}/{name}": s})).collect()
run("1", ingest=base + "/arrived", checkpoint=base + "/seen")
run("2", mode="once", checkpoint=base + "/noted")
for number in "34":
    run(number, gold_by_label=True)
run("3", gold_by_label=True)
print("CLOCKS", json.dumps(clocks))
spark.stop()
"""


@pytest.fixture(scope="module")
def whole_run(tmp_path_factory):
    """The logs of runs on two executors: with an ingest stage, loading once, and replacing a partitioned table."""
    from tests.test_layers import landing

    base = tmp_path_factory.mktemp("whole")
    root, logs = landing(base / "landing"), base / "logs"
    logs.mkdir()
    home = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = {k: v for k, v in os.environ.items() if not k.startswith(("PYSPARK_", "SPARK_"))} | {"PYTHONPATH": home}
    env |= {"SPARK_SCALA_VERSION": "2.13", "SPARK_LOCAL_IP": "127.0.0.1", "PYSPARK_PYTHON": sys.executable, "SPARK_HOME": spark_home(base)}
    done = subprocess.run([sys.executable, "-c", WHOLE_RUN, str(base), root, str(logs)], env=env, cwd=base, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]
    return str(logs), json.loads(done.stdout.rpartition("CLOCKS ")[2])


def spark_home(base):
    """Spark's folder by links, as executors write their logs into it."""
    import pyspark

    home = base / "spark"
    (home / "work").mkdir(parents=True)
    for p in Path(pyspark.__file__).parent.iterdir():
        if p.name != "work":
            (home / p.name).symlink_to(p)
    return str(home)


def events_of(logs):
    lines = [line for path in Path(logs).glob("eventlog_v2_*/events_*") for line in path.read_text().splitlines()]
    return [json.loads(line) for line in lines]


def test_rows_out_are_those_of_tables(spark, whole_run):
    found = {r.job_group: r for r in event_log_metrics(spark, whole_run[0]).collect()}
    # run 3 ran twice
    want = {"1/ingest": 15, "2/bronze": 15, "2/silver": 9, "2/gold": 9, "3/bronze": 30, "3/silver": 18, "3/gold": 18, "4/gold": 9}
    assert {group: found[group].rows_out for group in want} == want
    assert found["3/bronze"].file_rows > 0 and found["2/silver"].file_rows >= 9  # headers, and batches aside


def test_memory_is_that_of_the_log(spark, whole_run):
    logs, _ = whole_run
    events = events_of(logs)
    size = {e["Resource Profile Id"]: e["Executor Resource Requests"]["memory"]["Amount"] << 20 for e in events if e["Event"].endswith("ResourceProfileAdded")}
    capacity = {e["Executor ID"]: size[e["Executor Info"]["Resource Profile Id"]] for e in events if e["Event"].endswith("ListenerExecutorAdded")}
    peak = {}

    def tell(stage, executor, metrics):
        if stage >= 0 and metrics["JVMHeapMemory"] > 0 and executor in capacity:
            peak[stage, executor] = max(peak.get((stage, executor), 0), metrics["JVMHeapMemory"])

    groups, ran = {}, set()
    for e in events:
        if e["Event"].endswith("StageExecutorMetrics"):
            tell(e["Stage ID"], e["Executor ID"], e["Executor Metrics"])
        elif e["Event"].endswith("ExecutorMetricsUpdate"):
            for m in e["Executor Metrics Updated"]:
                tell(m["Stage ID"], e["Executor ID"], m["Executor Metrics"])
        elif e["Event"].endswith("TaskEnd"):
            ran.add(e["Stage ID"])
            tell(e["Stage ID"], e["Task Info"]["Executor ID"], e["Task Executor Metrics"])
        elif e["Event"].endswith("StageSubmitted"):
            groups[e["Stage Info"]["Stage ID"]] = e["Properties"].get("spark.jobGroup.id")
    assert set(capacity.values()) == {1024 << 20}
    got = {(r.stage_id, r.executor): (r.heap_bytes, r.capacity_bytes) for r in stage_memory(spark, logs).collect()}
    assert got == {k: (v, float(capacity[k[1]])) for k, v in peak.items()} and len(got) > 20
    for r in event_log_metrics(spark, logs).where("job_group LIKE '%/silver'").collect():
        shares = {}
        for (stage, executor), heap in peak.items():
            if stage in ran and groups[stage] == r.job_group:
                shares[executor] = max(shares.get(executor, 0), 100 * heap / capacity[executor])
        assert r.mem_pct == pytest.approx(sum(shares.values()) / len(shares)) and r.mem_peak_pct == pytest.approx(max(shares.values()))


def test_ledger_of_a_run_with_ingest(spark, whole_run):
    ledger = {r.run: r for r in event_log_ledger(spark, whole_run[0]).collect()}
    assert set(ledger) == {1, 2, 3, 4}
    first = ledger[1].asDict()
    assert all(first[f"{figure}_{stage}"] is not None for stage in ("ingest", "bronze", "silver", "gold") for figure in ("t", "cpu", "mem", "read", "write"))
    assert first["write_ingest"] > 0 and first["read_ingest"] > 0 and first["mem_bronze"] > 0 and ledger[2].t_ingest is None


def test_wall_clock_of_a_run(spark, whole_run):
    logs, clocks = whole_run
    by_group = {r.job_group: r for r in run_wall_clock(spark, logs, by="job_group").collect()}
    for group in ("4/bronze", "4/silver", "4/gold", "2/silver"):
        r = by_group[group]
        assert r.jobs_ms + r.commit_ms + r.planning_ms + r.waiting_ms + r.driver_ms == r.wall_ms
        assert r.wall_ms == pytest.approx(1000 * clocks[group], rel=0.01, abs=60)
    runs = {r.run: r for r in run_wall_clock(spark, logs).collect()}
    total = sum(s for group, s in clocks.items() if group.startswith("4/"))
    assert runs["4"].wall_ms == pytest.approx(1000 * total, rel=0.01, abs=120)
    assert runs["4"].planning_ms > 0 and runs["4"].jobs_ms > 0


def written(base, **events):
    """A rolling log of one application with these events in its files; returns the folder of logs."""
    for file, some in events.items():
        path = base / "eventlog_v2_app" / f"{file}_app"
        path.parent.mkdir(exist_ok=True)
        path.write_text("".join(json.dumps(e, separators=(",", ":")) + "\n" for e in some))
    return str(base)


def task_end(stage, executor, launch, written=0, heap=0, reason="Success"):
    return {"Event": "SparkListenerTaskEnd", "Stage ID": stage, "Task End Reason": {"Reason": reason},
            "Task Info": {"Launch Time": launch, "Finish Time": launch + 10, "Executor ID": executor},
            "Task Metrics": {"Executor Run Time": 8, "Executor CPU Time": 4_000_000, "Input Metrics": {"Bytes Read": 3, "Records Read": 1},
                             "Output Metrics": {"Bytes Written": written, "Records Written": 1}},
            "Task Executor Metrics": {"JVMHeapMemory": heap}}


def test_log_is_read_once_and_added_up_where_it_is_read(spark, tmp_path):
    start = {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 1}, "Properties": {"spark.jobGroup.id": "r/gold"}}
    logs = written(tmp_path, events_1=[start, *(task_end(i % 3, str(i % 2), i) for i in range(600))])
    metrics = event_log_metrics(spark, logs)
    assert not any("eventlog_v2_" in file for file in metrics.inputFiles())  # the log was read when this was called
    assert {(r.job_group, r.tasks, r.stages) for r in metrics.collect()} == {("r/gold", 200, 1), (None, 400, 2)}
    assert digest_event_log(spark, logs).count() == 7  # three stages on two executors each, and a start


def test_events_of_several_files_add_up(spark, tmp_path):
    sql, insert = "org.apache.spark.sql.execution.ui.SparkListenerSQL", "Execute InsertIntoHadoopFsRelationCommand"
    submitted = {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 1}, "Properties": {"spark.jobGroup.id": "q1", "spark.sql.execution.id": "5"}}
    again = {"Event": "SparkListenerStageSubmitted", "Stage Info": {"Stage ID": 1}, "Properties": {"spark.jobGroup.id": "q1"}}
    named = {"Event": "org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent", "runId": "q1", "name": "2/ingest"}
    planned = {"Event": f"{sql}ExecutionStart", "executionId": 5, "rootExecutionId": 5, "sparkPlanInfo": {"nodeName": "x", "simpleString": "x"}}
    adapted = {"Event": f"{sql}AdaptiveExecutionUpdate", "executionId": 5, "sparkPlanInfo": {"nodeName": insert, "simpleString": f"{insert} file:/a, `c`.`d`.`t`"}}
    beside = {**planned, "executionId": 6, "rootExecutionId": 6, "sparkPlanInfo": {"nodeName": insert, "simpleString": f"{insert} file:/a, [b]"}}
    files = {**submitted, "Stage Info": {"Stage ID": 2}, "Properties": {"spark.jobGroup.id": "q1", "spark.sql.execution.id": "6"}}
    executors = [{"Event": "SparkListenerExecutorAdded", "Executor ID": e, "Executor Info": {"Resource Profile Id": 0}} for e in "12"]
    profile = {"Event": "SparkListenerResourceProfileAdded", "Resource Profile Id": 0, "Executor Resource Requests": {"memory": {"Amount": 100}}}
    beat = {"Event": "SparkListenerExecutorMetricsUpdate", "Executor ID": "2",
            "Executor Metrics Updated": [{"Stage ID": 1, "Executor Metrics": {"JVMHeapMemory": 50 << 20}}, {"Stage ID": -1, "Executor Metrics": {"JVMHeapMemory": 99 << 20}}]}
    silent = {"Event": "SparkListenerExecutorMetricsUpdate", "Executor ID": "1", "Executor Metrics Updated": []}
    lost = {"Event": "SparkListenerTaskEnd", "Stage ID": 1, "Task End Reason": {"Reason": "ExecutorLostFailure"}, "Task Info": {"Launch Time": 1, "Finish Time": 2, "Executor ID": "1"}}
    logs = written(
        tmp_path,
        events_1=[*executors, named, submitted, planned, task_end(1, "1", 100, 7, 10 << 20), beat, silent, lost],
        events_2=[profile, again, adapted, beside, files, task_end(1, "1", 900, 8, 20 << 20), task_end(1, "2", 400, 9), task_end(2, "2", 500, 30)],
    )
    (row,) = event_log_metrics(spark, logs).collect()
    assert (row.app, row.job_group, row.stages, row.tasks, row.failed_tasks) == ("app", "2/ingest", 2, 5, 1)
    assert (row.write_bytes, row.rows_out, row.file_bytes, row.file_rows) == (24, 3, 30, 1)
    assert (row.run_ms, row.cpu_pct, row.read_bytes, row.elapsed_ms) == (32, 50.0, 12, 909)
    assert (row.mem_pct, row.mem_peak_pct) == (35.0, 50.0)
    heap = {(r.stage_id, r.executor): r.heap_bytes >> 20 for r in stage_memory(spark, logs).collect()}
    assert heap == {(1, "1"): 20, (1, "2"): 50}


def test_made_logs_are_compressed_and_rolled(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strataflow.catalogue.logs.EVENTS_PER_FILE", 3000)
    n = F.col("id")
    spark.range(10_000).select(
        n.alias("l_orderkey"), (n % 200).alias("l_partkey"), (n % 10).alias("l_suppkey"), (n % 7).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"), F.lit("N").alias("l_returnflag"), F.when(n % 2 == 0, "F").otherwise("O").alias("l_linestatus"),
    ).coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    logs = _event_logs(spark, str(tmp_path), F.lit("1/gold"))
    lines = spark.read.option("recursiveFileLookup", True).text(logs).select("value", F.col("_metadata.file_path").alias("path"))
    size, n_lines = lines.agg(F.sum(F.length("value") + 1), F.count("value")).first()
    assert n_lines == 2 * 10_000 + 10  # two events a line, and a stage of each supplier
    assert 4 * sum(p.stat().st_size for p in Path(logs).glob("*/part-*")) < size
    assert max(r["count"] for r in lines.groupBy("path").count().collect()) <= 3000
    assert {(r.app, r.tasks) for r in event_log_metrics(spark, logs).collect()} == {("F", 5000), ("O", 5000)}
