"""Queries for what event logs tell of memory, of the targets of writes, and of time by the clock."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.catalogue.registry import query, table
from strataflow.session import scratch_path
from strataflow.sources import event_log_ledger, event_log_metrics, run_wall_clock

_CORE, _SQL = "SparkListener", "org.apache.spark.sql.execution.ui.SparkListenerSQL"
_QUERY_START = "org.apache.spark.sql.streaming.StreamingQueryListener$QueryStartedEvent"


def _struct(**fields: Column | str) -> Column:
    """Fields of an event; an underscore stands for a space."""
    return F.struct(*[(F.lit(v) if isinstance(v, str) else v).alias(k.replace("_", " ")) for k, v in fields.items()])


# A log is rolled after this many events, as Spark rolls its own, and compressed, as its lines repeat the same names.
EVENTS_PER_FILE, LOG_CODEC = 1_000_000, "lz4"


def write_events(events: list[DataFrame], path: str) -> str:
    """The log of one application, in files that are no more than one task's work to read."""
    for some in events:
        some.write.mode("append").option("compression", LOG_CODEC).option("maxRecordsPerFile", EVENTS_PER_FILE).text(path)
    return path


def _text(event: Column) -> Column:
    return F.to_json(event).alias("value")


def _stage_logs(spark: SparkSession, sf_dir: str) -> str:
    """Lineitem as the log of one application: a line is a task, a supplier a stage and its own SQL execution, a part's
    number chooses the executor. Every seventh supplier is a streaming query's stage."""
    lines = table(spark, sf_dir, "lineitem")
    supplier, part = F.col("l_suppkey"), F.col("l_partkey")
    executor = (part % 4).cast("string")
    stage_of = F.when(supplier % 3 == 0, "bronze").when(supplier % 3 == 1, "silver").otherwise("gold")
    run = (supplier % 10).cast("string")
    group = F.when(supplier % 7 == 0, F.concat(F.lit("stream-"), run)).otherwise(F.concat(run, F.lit("/"), stage_of))
    task = _struct(
        Event=f"{_CORE}TaskEnd",
        Stage_ID=supplier,
        Task_End_Reason=_struct(Reason="Success"),
        Task_Info=_struct(Launch_Time=F.col("l_orderkey"), Finish_Time=F.col("l_orderkey") + 5, Executor_ID=executor),
        Task_Metrics=_struct(
            Executor_Run_Time=F.lit(4), Executor_CPU_Time=F.lit(1_000_000), Input_Metrics=_struct(Bytes_Read=part, Records_Read=F.lit(1)),
            Output_Metrics=_struct(Bytes_Written=F.col("l_orderkey"), Records_Written=F.col("l_linenumber")),
        ),
        Task_Executor_Metrics=_struct(JVMHeapMemory=part * 100_000),
    )
    path = scratch_path(spark, "suppliers")  # found once, as every kind of event below is made of them
    lines.select("l_suppkey").distinct().write.parquet(path)
    suppliers = spark.read.parquet(path)
    properties = F.struct(group.alias("spark.jobGroup.id"), supplier.cast("string").alias("spark.sql.execution.id"))
    stage = _struct(Event=f"{_CORE}StageSubmitted", Stage_ID=F.lit(None).cast("bigint"), Stage_Info=_struct(Stage_ID=supplier), Properties=properties)
    peak = _struct(
        Event=f"{_CORE}StageExecutorMetrics", Executor_ID=executor, Stage_ID=supplier, Executor_Metrics=_struct(JVMHeapMemory=supplier * 3_000_000)
    )
    beat = _struct(
        Event=f"{_CORE}ExecutorMetricsUpdate",
        Executor_ID=executor,
        Executor_Metrics_Updated=F.array(*(_struct(Stage_ID=s, Executor_Metrics=_struct(JVMHeapMemory=supplier * 4_000_000)) for s in (supplier, F.lit(-1)))),
    )

    def node(name: str, text: str | Column, children: Column) -> Column:
        return _struct(nodeName=name, simpleString=text, children=children)

    insert = "Execute InsertIntoHadoopFsRelationCommand"
    leaf = F.array(node("WriteFiles", "WriteFiles", F.array().cast("array<string>")))
    place = f'{insert} file:/a "quoted" path, false, Parquet, Overwrite, '
    plans = {
        0: node(insert, f"{place}`spark_catalog`.`layer`.`t`, [a, b]", leaf),
        1: node(insert, f"{place}[a, b]", leaf),
        2: node("AdaptiveSparkPlan", "AdaptiveSparkPlan isFinalPlan=false", F.array(node(insert, f"{place}[a]", leaf))),
    }
    runs = []
    for kind, plan in plans.items():
        mine = suppliers.where(supplier % 4 == kind)
        root = supplier + 1_000_000 if kind == 2 else supplier
        run_start = _struct(Event=f"{_SQL}ExecutionStart", executionId=supplier, rootExecutionId=root, sparkPlanInfo=plan)
        runs.append(mine.select(_text(run_start)))
        if kind == 2:
            maker = node("Execute SaveAsV1TableCommand", "Execute SaveAsV1TableCommand", leaf)
            runs.append(mine.select(_text(_struct(Event=f"{_SQL}ExecutionStart", executionId=root, rootExecutionId=root, sparkPlanInfo=maker))))
    executors = spark.range(4)
    profile = F.col("id") % 2
    named = _struct(Event=_QUERY_START, runId=F.concat(F.lit("stream-"), run), name=F.concat(run, F.lit("/ingest")))
    heartbeats = lines.where("l_partkey % 4 = 3").groupBy("l_suppkey").agg(F.min("l_partkey").alias("l_partkey"))
    events = [
        lines.select(_text(task)),
        suppliers.select(_text(stage)),
        lines.where("l_partkey % 4 = 1").select("l_suppkey", "l_partkey").select(_text(peak)),
        heartbeats.select(_text(beat)),
        *runs,
        executors.select(_text(_struct(Event=f"{_CORE}ExecutorAdded", Executor_ID=F.col("id").cast("string"), Executor_Info=_struct(Resource_Profile_Id=profile)))),
        executors.where("id < 2").select(
            _text(
                _struct(
                    Event=f"{_CORE}ResourceProfileAdded",
                    Resource_Profile_Id=profile,
                    Executor_Resource_Requests=_struct(memory=_struct(Amount=1024 + 512 * profile)),
                )
            )
        ),
        suppliers.where(supplier % 7 == 0).select(_text(named)).distinct(),
    ]
    return write_events(events, f"{scratch_path(spark, 'eventlogs')}/eventlog_v2_app")


_STAGE_LOG = """
    t AS (SELECT *, CASE WHEN l_suppkey % 7 = 0 THEN 'ingest' WHEN l_suppkey % 3 = 0 THEN 'bronze' WHEN l_suppkey % 3 = 1
            THEN 'silver' ELSE 'gold' END AS stage, CAST(l_suppkey % 10 AS INTEGER) AS run, l_partkey % 4 AS executor FROM lineitem),
    heap AS (
      SELECT run, stage, executor, l_partkey * 100000 AS b FROM t
      UNION ALL SELECT run, stage, executor, l_suppkey * 3000000 FROM t WHERE executor = 1
      UNION ALL SELECT run, stage, executor, l_suppkey * 4000000 FROM t WHERE executor = 3),
    mem AS (
      SELECT run, stage, avg(p) AS mem, max(p) AS peak FROM (
        SELECT run, stage, executor, max(b) * 100.0 / ((1024 + 512 * (executor % 2)) * 1048576.0) AS p FROM heap GROUP BY run, stage, executor)
      GROUP BY ALL)
    """


@query(
    "q49_log_memory_and_targets",
    f"""
    WITH {_STAGE_LOG},
    s AS (
      SELECT run, stage, CAST(sum(CASE WHEN l_suppkey % 4 <> 1 THEN l_linenumber ELSE 0 END) AS BIGINT) AS rows_out,
        CAST(sum(CASE WHEN l_suppkey % 4 <> 1 THEN l_orderkey ELSE 0 END) AS BIGINT) AS write_bytes,
        CAST(sum(CASE WHEN l_suppkey % 4 = 1 THEN l_linenumber ELSE 0 END) AS BIGINT) AS file_rows,
        CAST(sum(CASE WHEN l_suppkey % 4 = 1 THEN l_orderkey ELSE 0 END) AS BIGINT) AS file_bytes
      FROM t GROUP BY ALL)
    SELECT run || '/' || stage AS job_group, rows_out, write_bytes, file_rows, file_bytes,
      round(mem, 6) AS mem_pct, round(peak, 6) AS mem_peak_pct
    FROM s JOIN mem USING (run, stage)
    """,
)
def memory_and_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Heap by executor from three kinds of event, and output to tables apart from files beside them."""
    found = event_log_metrics(spark, _stage_logs(spark, sf_dir))
    rounded = (F.round(c, 6).alias(c) for c in ("mem_pct", "mem_peak_pct"))
    return found.select("job_group", "rows_out", "write_bytes", "file_rows", "file_bytes", *rounded)


@query(
    "q50_log_ledger_with_ingest",
    f"""
    WITH {_STAGE_LOG},
    s AS (SELECT run, stage, (max(l_orderkey + 5) - min(l_orderkey)) / 1e3 AS t, sum(l_partkey) / 1048576.0 AS rd,
            sum(CASE WHEN l_suppkey % 4 <> 1 THEN l_orderkey ELSE 0 END) / 1048576.0 AS wr FROM t GROUP BY ALL)
    SELECT run, round(sum(t), 6) AS total_time, max(t) FILTER (WHERE stage = 'ingest') AS t_ingest,
      max(CASE WHEN stage = 'ingest' THEN CAST(25 AS DOUBLE) END) AS cpu_ingest, round(max(mem) FILTER (WHERE stage = 'ingest'), 6) AS mem_ingest,
      round(max(rd) FILTER (WHERE stage = 'ingest'), 9) AS read_ingest, round(max(wr) FILTER (WHERE stage = 'ingest'), 9) AS write_ingest,
      round(max((rd + wr) / t) FILTER (WHERE stage = 'ingest'), 9) AS throughput_ingest,
      round(max(mem) FILTER (WHERE stage = 'bronze'), 6) AS mem_bronze, round(max(mem) FILTER (WHERE stage = 'silver'), 6) AS mem_silver,
      round(max(mem) FILTER (WHERE stage = 'gold'), 6) AS mem_gold, round(max(wr) FILTER (WHERE stage = 'gold'), 9) AS write_gold
    FROM s JOIN mem USING (run, stage) GROUP BY run
    """,
)
def ledger_with_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = event_log_ledger(spark, _stage_logs(spark, sf_dir))
    digits = {"total_time": 6, "mem_ingest": 6, "mem_bronze": 6, "mem_silver": 6, "mem_gold": 6}
    digits |= {"read_ingest": 9, "write_ingest": 9, "throughput_ingest": 9, "write_gold": 9}
    return ledger.select("run", "t_ingest", F.col("cpu_ingest").cast("double").alias("cpu_ingest"), *(F.round(c, d).alias(c) for c, d in digits.items()))


_CLOCK_JOBS = """
    j AS (SELECT o_custkey % 5 AS run, o_custkey AS x, o_custkey * 100 + 10 + o_orderkey % 70 AS a,
            o_custkey * 100 + 10 + o_orderkey % 70 + o_orderkey % 13 AS b FROM orders),
    e AS (SELECT c_custkey % 5 AS run, c_custkey AS x, c_custkey * 100 - c_custkey % 40 AS a, c_custkey * 100 + 60 + c_custkey % 50 AS b FROM customer)
    """


@query(
    "q51_run_wall_clock",
    f"""
    WITH {_CLOCK_JOBS},
    edge AS (SELECT x, min(a) AS first, max(b) AS last FROM j GROUP BY x),
    ms AS (
      SELECT run, unnest(range(a, b)) AS tick, 1 AS kind FROM j
      UNION ALL SELECT run, unnest(range(greatest(last, a), b)), 2 FROM e JOIN edge USING (x)
      UNION ALL SELECT run, unnest(range(a, least(first, b))), 3 FROM e JOIN edge USING (x)
      UNION ALL SELECT run, unnest(range(a, b)), 3 FROM e ANTI JOIN edge USING (x)
      UNION ALL SELECT run, unnest(range(a, b)), 4 FROM e),
    first_kind AS (SELECT run, tick, min(kind) AS kind FROM ms GROUP BY ALL),
    wall AS (SELECT run, max(b) - min(a) AS wall_ms FROM (SELECT * FROM j UNION ALL SELECT * FROM e) GROUP BY run)
    SELECT CAST(run AS VARCHAR) AS run, wall_ms, count(*) FILTER (WHERE kind = 1) AS jobs_ms, count(*) FILTER (WHERE kind = 2) AS commit_ms,
      count(*) FILTER (WHERE kind = 3) AS planning_ms, count(*) FILTER (WHERE kind = 4) AS waiting_ms, wall_ms - count(*) AS driver_ms
    FROM first_kind JOIN wall USING (run) GROUP BY run, wall_ms
    """,
)
def wall_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as jobs within customers as SQL executions of five runs; the SQL looks at every millisecond."""
    customer, order = F.col("o_custkey"), F.col("o_orderkey")
    start = customer * 100 + 10 + order % 70
    group = lambda who: F.concat((who % 5).cast("string"), F.when(who % 2 == 0, "/bronze").otherwise("/silver"))
    properties = F.struct(group(customer).alias("spark.jobGroup.id"), customer.cast("string").alias("spark.sql.execution.id"))
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    begun = _struct(Event=f"{_SQL}ExecutionStart", executionId=key, time=key * 100 - key % 40, jobGroupId=group(key))
    ended = _struct(Event=f"{_SQL}ExecutionEnd", executionId=key, time=key * 100 + 60 + key % 50)
    events = [
        orders.select(_text(_struct(Event=f"{_CORE}JobStart", Job_ID=order, Submission_Time=start, Properties=properties))),
        orders.select(_text(_struct(Event=f"{_CORE}JobEnd", Job_ID=order, Completion_Time=start + order % 13))),
        customers.select(_text(begun)),
        customers.select(_text(ended)),
    ]
    return run_wall_clock(spark, write_events(events, f"{scratch_path(spark, 'eventlogs')}/eventlog_v2_app")).drop("app")
