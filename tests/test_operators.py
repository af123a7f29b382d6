"""Unions, profiles, counters, ledgers and comparisons on small hand-made frames."""

import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import Window
from pyspark.sql import functions as F

from strataflow.functions import clock_micros
from strataflow.operators import counters
from strataflow.operators import (
    compare_configs,
    counter_delta,
    ledger_long,
    ledger_wide,
    mean_by,
    persisted,
    preview,
    profile_counts,
    profile_duplicates,
    profile_nulls,
    run_ledger,
    stage_columns,
    stage_metrics,
    stage_share,
    union_by_name,
    union_labelled,
)
from strataflow.operators.stages import LEDGER_COLUMNS
from strataflow.session import cluster_conf
from strataflow.sources import LEDGER_SCHEMA, read_ledger, write_ledger


def test_union_is_strict_by_default(spark):
    a, b = spark.range(2), spark.range(1).withColumn("x", F.lit(1))
    with pytest.raises(AnalysisException):
        union_labelled({"a": a, "b": b}, "src").collect()
    both = union_labelled({"a": a, "b": b}, "src", allow_missing=True)
    assert sorted((r.id, r.src, r.x) for r in both.collect()) == [(0, "a", None), (0, "b", 1), (1, "a", None)]
    with pytest.raises(ValueError, match="nothing"):
        union_by_name([])


def test_union_keeps_duplicates_and_widens(spark):
    a = spark.sql("SELECT 1 AS k, 'x' AS s")
    b = spark.sql("SELECT 'x' AS s, 1L AS k")
    out = union_by_name([a, b, b])
    assert dict(out.dtypes)["k"] == "bigint"
    assert [tuple(r) for r in out.collect()] == [(1, "x")] * 3


def test_profiles(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, "x")], "a int, b string")
    assert {(r.col, r.n_null) for r in profile_nulls(df).collect()} == {("a", 0), ("b", 2)}
    assert [(r.a, r.b, r.n) for r in profile_duplicates(df).collect()] == [(1, None, 2)]
    assert {(r.tbl, r.n) for r in profile_counts({"d": df, "none": df.limit(0)}).collect()} == {("d", 3), ("none", 0)}
    assert [r.a for r in preview(df, [F.col("a").desc()], 1).collect()] == [2]
    with persisted(df) as kept:
        assert kept.is_cached
    assert not df.is_cached


def plain_deltas(df, start):
    w = Window.partitionBy("g").orderBy("t")
    before = F.when(F.row_number().over(w) == 1, F.lit(start)).otherwise(F.lag("c").over(w))
    return df.withColumn("c_delta", F.col("c") - before)


@pytest.mark.parametrize("start", [0, 5, None])
@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_counter_delta_matches_a_plain_window(spark, start, ranges):
    rng = random.Random(ranges)
    rows, seen = [], set()
    for _ in range(600):
        g = rng.choice(["hot", "hot", "hot", "warm", None, "x1", "x2"])
        t = rng.choice([None, *range(-200, 200)]) if g == "hot" else rng.randrange(10**6)
        if (g, t) not in seen:
            seen.add((g, t))
            rows.append((g, t, rng.choice([None, *range(1000)])))
    df = spark.createDataFrame(rows, "g string, t bigint, c bigint").repartition(5)
    got = counter_delta(df, ["g"], ["t"], ["c"], start, ranges=ranges)
    assert got.columns == ["g", "t", "c", "c_delta"]
    assert sorted(map(str, got.collect())) == sorted(map(str, plain_deltas(df, start).collect()))


@pytest.mark.parametrize("ranges", [1, 5])
def test_counter_delta_start_per_row(spark, ranges):
    rows = [("a", 1, 10, 4), ("a", 2, 15, 0), ("a", 3, 15, 0), ("b", 1, 7, 7)]
    df = spark.createDataFrame(rows, "g string, t int, c int, at_start int")
    out = counter_delta(df, ["g"], ["t"], ["c"], {"c": F.col("at_start")}, ranges=ranges)
    assert sorted((r.g, r.t, r.c_delta) for r in out.collect()) == [("a", 1, 6), ("a", 2, 5), ("a", 3, 0), ("b", 1, 0)]


def test_counter_delta_by_time_and_two_keys(spark):
    df = spark.range(2000).select(
        (F.col("id") % 2).cast("int").alias("run"),
        F.lit("bronze").alias("stage"),
        F.timestamp_seconds(F.col("id")).alias("ts"),
        (F.col("id") * 3).alias("a"),
        (F.col("id") * 5).alias("b"),
    )
    out = counter_delta(df, ["run", "stage"], ["ts"], ["a", "b"], ranges=20)
    assert out.count() == 2000
    first = out.where("a < 6").select("run", "a_delta", "b_delta").orderBy("run").collect()
    assert [tuple(r) for r in first] == [(0, 0, 0), (1, 3, 5)]
    assert {tuple(r) for r in out.where("a >= 6").select("a_delta", "b_delta").collect()} == {(6, 10)}


def test_counter_delta_slices_limit_a_window(spark):
    df = spark.range(50_000).select(F.lit("one").alias("g"), F.col("id").alias("t"), F.col("id").alias("c"))
    out = counter_delta(df, ["g"], ["t"], ["c"], ranges=25)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [n for n in out.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect() if n]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(sizes) == 50_000
    assert len(sizes) > 4
    assert out.agg(F.sum("c_delta")).first()[0] == 49_999


@pytest.mark.parametrize("ranges", [1, 9])
def test_counter_delta_takes_any_order(spark, ranges):
    rows = [(g, f"{i // 10:03d}", i % 10, i * i) for g in "ab" for i in range(100)]
    df = spark.createDataFrame(rows, "g string, t string, u int, c long")
    got = counter_delta(df, ["g"], ["t", "u"], ["c"], ranges=ranges).collect()
    assert sorted((r.g, r.c, r.c_delta) for r in got) == sorted((g, i * i, 2 * i - 1 if i else 0) for g in "ab" for i in range(100))


def test_counter_delta_cuts_along_the_whole_order(spark):
    """One day only: the ranges must be cut by the second column."""
    df = spark.range(1000).select(F.lit("one").alias("g"), F.lit(1).alias("day"), F.col("id").alias("o"), F.col("id").alias("c"))
    out = counter_delta(df, ["g"], ["day", "o"], ["c"], ranges=10)
    sizes = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" in sizes and out.agg(F.sum("c_delta")).first()[0] == 999
    stored = counters._in_ranges(df, ["g", "day", "o"], 10).groupBy("__range").count().collect()
    assert max(r["count"] for r in stored) < 300


def test_counter_delta_scans_its_input_once(spark):
    """What the result reads is the written ranges, not the input."""
    df = spark.range(100).select(F.lit(1).alias("g"), F.col("id").alias("t"), F.col("id").alias("c"))
    plan = counter_delta(df, ["g"], ["t"], ["c"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Range (" not in plan


def test_duplicates_shuffle_no_text(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang")
    plan = profile_duplicates(docs)._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("HashAggregate(keys=[__hash") :]
    assert "hashpartitioning(__hash" in first and "text" not in first.split("Exchange")[1].split("\n")[0]


def test_stage_metrics_edges(spark):
    rows = [
        (1, "silver", "2024-01-01 00:00:00", 10, 50.0),
        (1, "silver", "2024-01-01 00:00:02", 30, None),
        (1, "gold", "2024-01-01 00:00:00", 7, float("nan")),
        (1, "ingest", "2024-01-01 00:00:00", None, None),
    ]
    df = spark.createDataFrame(rows, "run int, stage string, ts string, b bigint, cpu double")
    out = stage_metrics(
        df.withColumn("ts", F.to_timestamp("ts")), sums={"moved": F.col("b")}, means={"cpu": F.col("cpu")}
    )
    got = {r.stage: (r.n_samples, r.elapsed_us, r.moved, r.cpu, r.throughput) for r in out.collect()}
    assert got == {
        "silver": (2, 2_000_000, 40, 50.0, 20.0),
        "gold": (1, 0, 7, None, None),
        "ingest": (1, 0, 0, None, None),
    }


def test_stage_columns_fills_counts(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (1, "a", 3.0), (2, "b", 1.0)], "run int, stage string, v double")
    out = stage_columns(df, ["run"], "stage", ["a", "b"], {"n": (F.count, "v"), "max": (F.max, "v")})
    assert {tuple(r) for r in out.collect()} == {(1, 2, 3.0, 0, None), (2, 0, None, 1, 1.0)}
    assert out.columns == ["run", "n_a", "max_a", "n_b", "max_b"]


def test_ledger_there_and_back(spark):
    metrics = ["t_bronze", "t_silver"]
    wide = spark.createDataFrame([(1, 1.5, None), (2, 2.5, 0.0)], "run int, t_bronze double, t_silver double")
    long = ledger_long(wide, ["run"], metrics)
    assert long.count() == 4
    assert sorted(map(str, ledger_wide(long, ["run"], metrics).collect())) == sorted(map(str, wide.collect()))


def test_run_ledger_has_the_wide_shape(spark):
    rows = [
        (1, "bronze", 0, "2024-01-01 00:00:00", 10.0, 40.0, 1 << 20, 0),
        (1, "bronze", 1, "2024-01-01 00:00:04", 30.0, 60.0, 3 << 20, 6 << 20),
        (1, "gold", 0, "2024-01-01 00:01:00", 90.0, 60.0, 0, 0),
    ]
    schema = (
        "run int, stage string, sample int, ts string, "
        "cpu_pct double, mem_pct double, read_bytes bigint, write_bytes bigint"
    )
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.to_timestamp("ts"))
    out = run_ledger(df)
    assert out.columns == list(LEDGER_COLUMNS)
    row = out.first()
    assert (row.t_bronze, row.cpu_bronze, row.mem_bronze) == (4.0, 20.0, 50.0)
    assert (row.read_bronze, row.write_bronze, row.throughput_bronze) == (3.0, 6.0, 2.25)
    assert (row.t_gold, row.throughput_gold, row.t_silver, row.total_time) == (0.0, None, None, 4.0)


def test_mean_by_skips_blanks(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 3.0), ("b", None)]
    df = spark.createDataFrame(rows, "c string, v double")
    assert {tuple(r) for r in mean_by(df, "c", ["v"]).collect()} == {("a", 2.0), ("b", None)}


def test_stage_share(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (0.0, 0.0, 0.0)], "a double, b double, c double")
    got = [tuple(r) for r in stage_share(df, ["a", "b", "c"]).collect()]
    assert got == [(1.0, None, 3.0, 4.0, 0.25, 0.0, 0.75), (0.0, 0.0, 0.0, 0.0, None, None, None)]


def ledger_rows(config_scale):
    out = []
    for run in (1, 2):
        row = {c: float(run) * config_scale for c in LEDGER_COLUMNS}
        row["run"] = run
        row["cpu_ingest"] = row["mem_ingest"] = None
        row["cpu_gold"] = None if run == 2 else 50.0
        out.append(row)
    return out


def test_ledger_files_and_comparison(spark, tmp_path):
    paths = {}
    for config, scale in (("small", 4.0), ("large", 2.0)):
        rows = [tuple(r[c] for c in LEDGER_COLUMNS) for r in ledger_rows(scale)]
        paths[config] = str(tmp_path / config)
        write_ledger(spark.createDataFrame(rows, LEDGER_SCHEMA), paths[config])
    paths["gone"] = str(tmp_path / "gone")
    ledger = read_ledger(spark, paths)
    assert ledger.columns == [*LEDGER_COLUMNS, "config"]
    assert ledger.count() == 4
    assert ledger.where("cpu_ingest IS NULL").count() == 4
    with pytest.raises(AnalysisException):
        read_ledger(spark, paths, skip_missing=False)
    out = {r.config: r for r in compare_configs(ledger, "small", ["large", "small"]).collect()}
    assert (out["large"].speedup, out["small"].speedup) == (2.0, 1.0)
    assert (out["large"].cat_rank, out["small"].cat_rank) == (1, 2)
    assert out["small"].cpu_gold == 50.0
    assert out["small"].t_stages == 18.0
    assert math.isclose(out["small"].t_gold_share, 1 / 3)


def test_read_ledger_infers_types(spark, tmp_path):
    write_ledger(spark.sql("SELECT 1 AS run, 2.5D AS total_time"), str(tmp_path / "a"))
    write_ledger(spark.sql("SELECT 2 AS run, 3 AS total_time, 'x' AS note"), str(tmp_path / "b"))
    both = read_ledger(spark, {"a": str(tmp_path / "a"), "b": str(tmp_path / "b")}, schema=None)
    assert dict(both.dtypes) == {"run": "int", "total_time": "double", "note": "string", "config": "string"}
    assert sorted((r.run, r.total_time, r.note) for r in both.collect()) == [(1, 2.5, None), (2, 3.0, "x")]


def test_clock_micros_grows_with_a_zoneless_time(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # no 02:30 on 2024-03-10 there
    try:
        times = ["1969-12-31 23:59:59.5", "2024-03-10 01:59:59.999999", "2024-03-10 02:30:00", "2024-03-10 03:00:00"]
        df = spark.createDataFrame([(t,) for t in times], "s string").select(F.col("s").cast("timestamp_ntz").alias("t"))
        micros = [r[0] for r in df.select(clock_micros(df, "t")).collect()]
        days = df.select(F.col("t").cast("date").alias("d"))
        assert days.select(clock_micros(days, "d")).first()[0] == -86_400_000_000
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert micros[0] == -500_000
    assert [b - a for a, b in zip(micros[1:], micros[2:])] == [1_800_000_001, 1_800_000_000]
    with pytest.raises(TypeError, match="timestamp"):
        clock_micros(spark.range(1), "id")


def test_read_ledger_with_nothing(spark, tmp_path):
    empty = read_ledger(spark, {"x": str(tmp_path / "x")})
    assert empty.columns == [*LEDGER_COLUMNS, "config"]
    assert empty.count() == 0


def test_cluster_conf_is_bounded():
    small, large = cluster_conf(1 << 20), cluster_conf(100 << 40)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert large["spark.sql.shuffle.partitions"] == "32000"
    assert large["spark.sql.files.maxPartitionBytes"] == "1049m"
