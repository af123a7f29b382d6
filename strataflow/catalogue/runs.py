"""Queries for the run analytics; samples and ledgers are derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.catalogue.logs import write_events
from strataflow.catalogue.registry import as_of, query, table
from strataflow.functions import sort_by_category
from strataflow.operators import (
    compare_configs,
    counter_delta,
    ledger_long,
    ledger_wide,
    mean_by,
    run_ledger,
    stage_columns,
    stage_metrics,
    stage_share,
)
from strataflow.session import scratch_path
from strataflow.sources import event_log_ledger, event_log_metrics, read_ledger, write_ledger


@query(
    "q15_concat_missing",
    """
    SELECT c_custkey, c_name, c_acctbal, NULL::BIGINT AS s_suppkey, NULL::VARCHAR AS s_name, 'customer' AS config
    FROM customer
    UNION ALL SELECT NULL, NULL, NULL, s_suppkey, s_name, 'supplier' FROM supplier
    """,
)
def concat_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = {
        "customer": table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal"),
        "supplier": table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
    }
    paths = {label: scratch_path(spark, label) for label in frames}
    for label, df in frames.items():
        write_ledger(df, paths[label])
    paths["absent"] = scratch_path(spark, "absent")  # never written, so skipped
    return read_ledger(spark, paths, {label: df.schema for label, df in frames.items()} | {"absent": T.StructType()})


@query(
    "q20_mean_by",
    """
    SELECT event_type, round(avg(CASE WHEN event_id % 7 <> 0 THEN value END), 6) AS m1,
      round(avg(value), 6) AS m2, round(avg(CASE WHEN event_id % 11 <> 0 THEN value END), 6) AS m3
    FROM events GROUP BY event_type
    """,
)
def means(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select(
        "event_type",
        F.when(F.col("event_id") % 7 != 0, F.col("value")).alias("m1"),
        F.col("value").alias("m2"),
        F.when(F.col("event_id") % 11 == 0, float("nan")).otherwise(F.col("value")).alias("m3"),
    )
    out = mean_by(events, "event_type", ["m1", "m2", "m3"])
    return out.select("event_type", *[F.round(m, 6).alias(m) for m in ("m1", "m2", "m3")])


@query(
    "q21_ledger_long",
    """
    SELECT c_custkey, c_mktsegment, 'c_acctbal' AS metric, c_acctbal AS value FROM customer
    UNION ALL SELECT c_custkey, c_mktsegment, 'c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer
    """,
)
def long_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_long(table(spark, sf_dir, "customer"), ["c_custkey", "c_mktsegment"], ["c_acctbal", "c_nationkey"])


@query(
    "q22_run_filter",
    "SELECT event_id, event_type, value FROM events WHERE user_id = 23",
)
def one_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").where(F.col("user_id") == 23).select("event_id", "event_type", "value")


PRIORITIES = ["3-MEDIUM", "1-URGENT", "2-HIGH", "5-LOW"]


@query(
    "q23_category_rank",
    """
    SELECT o_orderpriority, CAST(CASE o_orderpriority WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2
      WHEN '2-HIGH' THEN 3 WHEN '5-LOW' THEN 4 END AS BIGINT) AS cat_rank,
      count(*) AS n FROM orders GROUP BY 1, 2
    """,
)
def ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return sort_by_category(sizes, "o_orderpriority", PRIORITIES)


def _exact_sum(col: Column) -> Column:
    """Sum of cent amounts, independent of the order of addition."""
    return F.coalesce(F.sum(col.cast("decimal(18,2)")).cast("double"), F.lit(0.0))


@query(
    "q24_stage_share",
    """
    WITH s AS (SELECT user_id,
      CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'view'), 0) AS DOUBLE) AS bronze,
      CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'click'), 0) AS DOUBLE) AS silver,
      CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'purchase'), 0) AS DOUBLE) AS gold,
      CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'signup'), 0) AS DOUBLE) AS ingest,
      CAST(coalesce(sum(CAST(value AS DECIMAL(18,2))) FILTER (WHERE event_type = 'error'), 0) AS DOUBLE) AS failed
      FROM events GROUP BY user_id)
    SELECT user_id, bronze, silver, gold, ingest, failed, round(bronze + silver + gold + ingest + failed, 6) AS total,
      round(gold / nullif(bronze + silver + gold + ingest + failed, 0), 6) AS gold_share FROM s
    """,
)
def shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"view": "bronze", "click": "silver", "purchase": "gold", "signup": "ingest", "error": "failed"}
    sums = stage_columns(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "event_type",
        list(names),
        {"sum": (_exact_sum, "value")},
        lambda figure, stage: names[stage],
    )
    out = stage_share(sums, list(names.values()))
    rounded = [F.round(c, 6).alias(c) for c in ("total", "gold_share")]
    return out.select("user_id", *names.values(), *rounded)


@query(
    "q25_stage_metrics",
    """
    WITH e AS (SELECT user_id, event_type, value,
      CASE WHEN user_id = 1 AND event_type = 'view' THEN TIMESTAMP '2024-01-01 00:00:00' ELSE ts END AS ts FROM events),
    s AS (SELECT user_id AS run, event_type AS stage, count(*) AS n_samples,
      epoch_us(max(ts)) - epoch_us(min(ts)) AS elapsed_us,
      CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS total FROM e
      GROUP BY 1, 2)
    SELECT run, stage, n_samples, elapsed_us, total, round(total / nullif(elapsed_us / 1e6, 0), 9) AS throughput FROM s
    """,
)
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views of one user are all at one time: a stage without any length."""
    viewed = (F.col("user_id") == 1) & (F.col("event_type") == "view")
    at = F.when(viewed, as_of()).otherwise(F.col("ts")).alias("ts")
    samples = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"), F.col("event_type").alias("stage"), at, "value"
    )
    out = stage_metrics(samples, sums={"total": F.col("value").cast("decimal(18,2)")})
    return out.select(
        "run",
        "stage",
        "n_samples",
        "elapsed_us",
        F.col("total").cast("double").alias("total"),
        F.round("throughput", 9).alias("throughput"),
    )


_DELTA = """
    SELECT o_orderstatus, o_orderkey,
      o_orderkey * 1000 - lag(o_orderkey * 1000, 1, 0) OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS delta
    FROM orders
    """


def _status_deltas(spark: SparkSession, sf_dir: str, order: list[str], ranges: int | None = None) -> DataFrame:
    counters = table(spark, sf_dir, "orders").select(
        "o_orderstatus", "o_orderkey", (F.col("o_orderkey") * 1000).alias("counter"), F.lit("one day").alias("day")
    )
    out = counter_delta(counters, ["o_orderstatus"], order, ["counter"], ranges=ranges)
    return out.select("o_orderstatus", "o_orderkey", F.col("counter_delta").alias("delta"))


@query("q27_counter_delta", _DELTA)
def deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _status_deltas(spark, sf_dir, ["o_orderkey"])


@query("q41_counter_delta_sliced", _DELTA)
def deltas_sliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by a text that is one for all rows, then the key, in many ranges."""
    return _status_deltas(spark, sf_dir, ["day", "o_orderkey"], ranges=40)


@query(
    "q28_ledger_wide",
    """
    SELECT user_id, count(*) FILTER (WHERE event_type = 'click') AS click_n,
      max(value) FILTER (WHERE event_type = 'click') AS click_max,
      count(*) FILTER (WHERE event_type = 'view') AS view_n,
      max(value) FILTER (WHERE event_type = 'view') AS view_max,
      count(*) FILTER (WHERE event_type = 'error') AS error_n,
      max(value) FILTER (WHERE event_type = 'error') AS error_max,
      count(*) FILTER (WHERE event_type = 'purchase') AS purchase_n,
      max(value) FILTER (WHERE event_type = 'purchase') AS purchase_max,
      count(*) FILTER (WHERE event_type = 'signup') AS signup_n,
      max(value) FILTER (WHERE event_type = 'signup') AS signup_max
    FROM events GROUP BY user_id
    """,
)
def wide_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage_columns(
        table(spark, sf_dir, "events"),
        ["user_id"],
        "event_type",
        ["click", "view", "error", "purchase", "signup"],
        {"n": (F.count, "value"), "max": (F.max, "value")},
        lambda figure, stage: f"{stage}_{figure}",
    )


@query(
    "q42_ledger_there_and_back",
    "SELECT o_orderkey, o_totalprice, CAST(o_custkey AS DOUBLE) AS o_custkey FROM orders",
)
def there_and_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    metrics = ["o_totalprice", "o_custkey"]
    long = ledger_long(table(spark, sf_dir, "orders"), ["o_orderkey"], metrics)
    return ledger_wide(long, ["o_orderkey"], metrics)


@query(
    "q35_compare_configs",
    """
    WITH m AS (SELECT o_orderpriority AS config, avg(o_totalprice) AS total_time,
        avg(CASE WHEN o_orderkey % 5 <> 0 THEN o_totalprice * 0.25 END) AS t_bronze,
        avg(o_totalprice * 0.5) AS t_silver, avg(CAST(o_custkey AS DOUBLE)) AS t_gold
      FROM orders GROUP BY 1)
    SELECT config, CAST(CASE config WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2
        WHEN '2-HIGH' THEN 3 WHEN '5-LOW' THEN 4 END AS BIGINT) AS cat_rank,
      round(total_time, 4) AS total_time, round(t_bronze, 4) AS t_bronze, round(t_silver, 4) AS t_silver,
      round(t_gold, 4) AS t_gold, round(t_bronze + t_silver + t_gold, 4) AS t_stages,
      round(t_gold / (t_bronze + t_silver + t_gold), 6) AS t_gold_share,
      round((SELECT total_time FROM m WHERE config = '1-URGENT') / total_time, 6) AS speedup
    FROM m
    """,
)
def compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as run ledgers, one result file per priority; every fifth bronze time is blank."""
    price, key = F.col("o_totalprice"), F.col("o_orderkey")
    ledger = table(spark, sf_dir, "orders").select(
        "o_orderpriority",
        key.alias("run"),
        price.alias("total_time"),
        F.when(key % 5 != 0, price * 0.25).alias("t_bronze"),
        (price * 0.5).alias("t_silver"),
        F.col("o_custkey").cast("double").alias("t_gold"),
    )
    root = scratch_path(spark, "ledger")
    write_ledger(ledger, root, ["o_orderpriority"])
    paths = {label: f"{root}/o_orderpriority={label}" for label in [*PRIORITIES, "4-NOT SPECIFIED"]}
    schema = T.StructType([f for f in ledger.schema.fields if f.name != "o_orderpriority"])
    metrics = ["total_time", "t_bronze", "t_silver", "t_gold"]
    out = compare_configs(read_ledger(spark, paths, schema), "1-URGENT", PRIORITIES, metrics=metrics)
    return out.select(
        "config",
        "cat_rank",
        *[F.round(c, 4).alias(c) for c in (*metrics, "t_stages")],
        F.round("t_gold_share", 6).alias("t_gold_share"),
        F.round("speedup", 6).alias("speedup"),
    )


@query(
    "q36_run_ledger",
    """
    WITH s AS (SELECT user_id AS run, event_type AS stage,
        (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS t, avg(value) AS cpu,
        max(event_id) * 4096 / 1048576.0 AS rd, max(event_id) * 1024 / 1048576.0 AS wr
      FROM events GROUP BY 1, 2),
    w AS (SELECT run, max(t) FILTER (WHERE stage = 'view') AS t_view, max(t) FILTER (WHERE stage = 'click') AS t_click,
        max(cpu) FILTER (WHERE stage = 'view') AS cpu_view, max(cpu) FILTER (WHERE stage = 'click') AS cpu_click,
        max(rd) FILTER (WHERE stage = 'view') AS read_view, max(wr) FILTER (WHERE stage = 'click') AS write_click,
        max((rd + wr) / nullif(t, 0)) FILTER (WHERE stage = 'view') AS throughput_view,
        max(t) FILTER (WHERE stage = 'purchase') AS t_purchase, max(t) FILTER (WHERE stage = 'error') AS t_error,
        max(t) FILTER (WHERE stage = 'signup') AS t_signup
      FROM s GROUP BY run)
    SELECT run, round(coalesce(t_view, 0) + coalesce(t_click, 0) + coalesce(t_purchase, 0) + coalesce(t_error, 0)
        + coalesce(t_signup, 0), 3) AS total_time, t_view, t_click, t_purchase, t_error, t_signup, round(cpu_view, 6) AS cpu_view,
      round(cpu_click, 6) AS cpu_click, read_view, write_click, round(throughput_view, 9) AS throughput_view FROM w
    """,
)
def ledger_of_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as counter samples: a user is a run, a kind of event a stage."""
    samples = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run"),
        F.col("event_type").alias("stage"),
        F.col("event_id").alias("sample"),
        "ts",
        F.col("value").alias("cpu_pct"),
        (F.col("value") / 2).alias("mem_pct"),
        (F.col("event_id") * 4096).alias("read_bytes"),
        (F.col("event_id") * 1024).alias("write_bytes"),
    )
    out = run_ledger(samples, stages=("view", "click", "purchase", "error", "signup"))
    return out.select(
        "run",
        F.round("total_time", 3).alias("total_time"),
        *[f"t_{stage}" for stage in ("view", "click", "purchase", "error", "signup")],
        F.round("cpu_view", 6).alias("cpu_view"),
        F.round("cpu_click", 6).alias("cpu_click"),
        "read_view",
        "write_click",
        F.round("throughput_view", 9).alias("throughput_view"),
    )


def _event_logs(spark: SparkSession, sf_dir: str, group_of: Column) -> str:
    """Lineitem written as the event logs of two applications: a line is a task, a supplier
    a stage in the job group ``group_of``."""
    lines = table(spark, sf_dir, "lineitem")
    failed = F.col("l_returnflag") == "R"
    launch = F.col("l_orderkey") * 10

    def group(**fields: Column) -> Column:
        return F.struct(*[v.alias(k.replace("_", " ")) for k, v in fields.items()])

    task = F.struct(
        F.lit("SparkListenerTaskEnd").alias("Event"),
        F.col("l_suppkey").alias("Stage ID"),
        group(Reason=F.when(failed, "ExceptionFailure").otherwise("Success")).alias("Task End Reason"),
        group(Launch_Time=launch, Finish_Time=launch + F.col("l_quantity").cast("bigint")).alias("Task Info"),
        group(
            Executor_Run_Time=F.col("l_quantity").cast("bigint"),
            Executor_CPU_Time=F.col("l_partkey") * 1000,
            Peak_Execution_Memory=F.col("l_partkey"),
            Input_Metrics=group(Bytes_Read=F.col("l_orderkey"), Records_Read=F.col("l_linenumber")),
            Output_Metrics=group(Bytes_Written=F.when(~failed, F.col("l_suppkey"))),
            Shuffle_Write_Metrics=group(Shuffle_Bytes_Written=F.col("l_partkey")),
        ).alias("Task Metrics"),
    )
    stage = F.struct(
        F.lit("SparkListenerStageSubmitted").alias("Event"),
        group(Stage_ID=F.col("l_suppkey")).alias("Stage Info"),
        F.struct(group_of.alias("spark.jobGroup.id")).alias("Properties"),
    )
    other = F.struct(F.lit("SparkListenerTaskStart").alias("Event"), F.col("l_suppkey").alias("Stage ID"))
    logs = scratch_path(spark, "eventlogs")
    for app in ("F", "O"):
        its = lines.where(F.col("l_linestatus") == app)
        tasks = its.select(F.explode(F.array(F.to_json(task), F.to_json(other))).alias("value"))
        events = tasks.union(its.select("l_suppkey").distinct().select(F.to_json(stage)))
        write_events([events], f"{logs}/eventlog_v2_{app}")
    return logs


@query(
    "q34_event_log",
    """
    WITH t AS (SELECT l_linestatus AS app, CASE l_suppkey % 3 WHEN 0 THEN 'run/bronze' WHEN 1 THEN 'run/silver' END
        AS job_group, * FROM lineitem)
    SELECT app, job_group, count(DISTINCT l_suppkey) AS stages, count(*) AS tasks,
      count(*) FILTER (WHERE l_returnflag = 'R') AS failed_tasks,
      CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS run_ms, CAST(sum(l_partkey * 1000) AS BIGINT) AS cpu_ns,
      CAST(sum(l_orderkey) AS BIGINT) AS read_bytes, CAST(sum(l_linenumber) AS BIGINT) AS rows_in,
      CAST(sum(CASE WHEN l_returnflag <> 'R' THEN l_suppkey ELSE 0 END) AS BIGINT) AS write_bytes,
      CAST(sum(l_partkey) AS BIGINT) AS shuffle_bytes, max(l_partkey) AS peak_bytes,
      max(l_orderkey * 10 + CAST(l_quantity AS BIGINT)) - min(l_orderkey * 10) AS elapsed_ms
    FROM t GROUP BY app, job_group
    """,
)
def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third supplier's stage has no job group."""
    kind = F.col("l_suppkey") % 3
    logs = _event_logs(spark, sf_dir, F.when(kind == 0, "run/bronze").when(kind == 1, "run/silver"))
    return event_log_metrics(spark, logs).select(
        "app", "job_group", "stages", "tasks", "failed_tasks", "run_ms", "cpu_ns", "read_bytes",
        "rows_in", "write_bytes", "shuffle_bytes", "peak_bytes", "elapsed_ms",
    )


@query(
    "q43_event_log_ledger",
    """
    WITH t AS (SELECT l_linestatus AS app, CAST(l_suppkey % 10 AS INTEGER) AS run,
        CASE l_suppkey % 3 WHEN 0 THEN 'bronze' WHEN 1 THEN 'silver' ELSE 'gold' END AS stage, * FROM lineitem),
    s AS (SELECT app, run, stage,
        (max(l_orderkey * 10 + CAST(l_quantity AS BIGINT)) - min(l_orderkey * 10)) / 1e3 AS t,
        sum(l_partkey * 1000) / 1e4 / sum(CAST(l_quantity AS BIGINT)) AS cpu,
        sum(l_orderkey) / 1048576.0 AS rd,
        sum(CASE WHEN l_returnflag <> 'R' THEN l_suppkey ELSE 0 END) / 1048576.0 AS wr
      FROM t GROUP BY app, run, stage)
    SELECT app, run, round(sum(t), 6) AS total_time,
      max(t) FILTER (WHERE stage = 'bronze') AS t_bronze, max(t) FILTER (WHERE stage = 'gold') AS t_gold,
      round(max(cpu) FILTER (WHERE stage = 'silver'), 6) AS cpu_silver,
      max(rd) FILTER (WHERE stage = 'bronze') AS read_bronze, max(wr) FILTER (WHERE stage = 'gold') AS write_gold,
      round(max((rd + wr) / t) FILTER (WHERE stage = 'silver'), 6) AS throughput_silver
    FROM s GROUP BY app, run
    """,
)
def event_log_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten numbered runs of three stages in each application."""
    kind = F.col("l_suppkey") % 3
    stage = F.when(kind == 0, "bronze").when(kind == 1, "silver").otherwise("gold")
    logs = _event_logs(spark, sf_dir, F.concat((F.col("l_suppkey") % 10).cast("string"), F.lit("/"), stage))
    return event_log_ledger(spark, logs).select(
        "app", "run", F.round("total_time", 6).alias("total_time"), "t_bronze", "t_gold",
        F.round("cpu_silver", 6).alias("cpu_silver"), "read_bronze", "write_gold",
        F.round("throughput_silver", 6).alias("throughput_silver"),
    )
