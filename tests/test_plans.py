"""Physical plans: shuffles, pushdown, pruning."""

import re

from pyspark.sql import functions as F

from strataflow.catalogue.cleaning import LINE_SPEC, dirty_lines
from strataflow.functions import require_not_null
from strataflow.operators import (
    dedup,
    profile_counts,
    profile_nulls,
    stage_columns,
    stage_metrics,
    union_labelled,
)
from strataflow.plans import clean


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[-1]


def exchanges(df):
    return len(re.findall(r"\bExchange\b", plan(df)))


def test_clean_shuffles_once_with_map_side_reduction(spark, sf_dir):
    df = clean(dirty_lines(spark, sf_dir), LINE_SPEC)
    assert exchanges(df) == 1
    before_shuffle = plan(df).split("Exchange")[1]
    assert "WindowGroupLimit" in before_shuffle
    assert len(re.findall(r"Filter \(", before_shuffle)) == 1
    assert "python" not in plan(df).lower()


def test_not_null_reaches_the_scan(spark, sf_dir):
    df = require_not_null(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_tax", "l_discount"])
    assert "PushedFilters: [IsNotNull(l_tax), IsNotNull(l_discount)]" in plan(df)


def test_dedup_any_shuffles_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert exchanges(dedup(lines, ["l_tax", "l_discount"], keep="any")) == 1
    numbers = lines.drop("l_returnflag", "l_linestatus")
    assert plan(dedup(numbers, ["l_tax", "l_discount"], keep="any")).count("HashAggregate") == 2


def test_union_needs_no_shuffle_and_a_label_filter_leaves_one_scan(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    df = union_labelled({"a": lines, "b": lines, "c": lines}, "src")
    assert exchanges(df) == 0
    assert plan(df).count("FileScan") == 3
    assert plan(df.where(F.col("src") == "b")).count("FileScan") == 1


def test_counts_read_no_column(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert "ReadSchema: struct<>" in plan(profile_counts({"l": lines}))
    assert "ReadSchema: struct<l_tax:double>" in plan(profile_nulls(lines, ["l_tax"]))


def test_wide_form_shuffles_once(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    figures = {"n": (F.count, "value"), "m": (F.max, "value")}
    df = stage_columns(events, ["user_id"], "event_type", ["view", "click"], figures)
    assert exchanges(df) == 1
    assert "HashAggregate" in plan(df)
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan(df)


def test_stage_metrics_aggregates_in_hash_maps(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    df = stage_metrics(events, ["user_id", "event_type"], sums={"v": F.col("value")}, means={"m": F.col("value")})
    assert exchanges(df) == 1
    assert "SortAggregate" not in plan(df)
    assert plan(df).count("HashAggregate") == 2
