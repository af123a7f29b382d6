"""Column rules, cleaning and de-duplication, with their edge values."""

import datetime
import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from strataflow.functions import (
    nan_to_null,
    require_not_null,
    sort_by_category,
    to_double,
    trim_columns,
    with_category_rank,
    with_load_time,
)
from strataflow.operators import dedup
from strataflow.plans import CleanSpec, clean


def test_not_null_keeps_nan_and_blank(spark):
    df = spark.createDataFrame([(float("nan"), ""), (None, "x"), (1.0, None), (2.0, "  ")], "v double, s string")
    kept = require_not_null(df, ["v", "s"]).collect()
    assert [r.s for r in kept] == ["", "  "]
    assert require_not_null(df, []).count() == 4


def test_trim_takes_spaces_only(spark):
    df = spark.createDataFrame([("  a b ", "\tx ", " y "), (None, "", "   ")], "a string, b string, c string")
    assert [tuple(r) for r in trim_columns(df, ["a", "b", "c"]).collect()] == [
        ("a b", "\tx", " y"),
        (None, "", ""),
    ]


@pytest.mark.parametrize(
    ("text", "value"),
    [("1.5", 1.5), (" 2 ", 2.0), ("1e3", 1000.0), ("bad", None), ("", None), (None, None), ("1.0d", 1.0),
     ("1f", 1.0), ("1_000", None), ("-0.0", -0.0), ("Infinity", math.inf)],
)
def test_to_double(spark, text, value):
    got = to_double(spark.createDataFrame([(text,)], "v string"), ["v"]).first().v
    assert got == value
    if value == 0:
        assert math.copysign(1, got) == math.copysign(1, value)


def test_to_double_nan(spark):
    assert math.isnan(to_double(spark.createDataFrame([("NaN",)], "v string"), ["v"]).first().v)


def test_load_time(spark):
    df = spark.range(3)
    moments = {r.t for r in with_load_time(df, "t").collect()}
    assert len(moments) == 1
    for given in ("2024-01-01 00:00:00", datetime.datetime(2024, 1, 1), F.lit("2024-01-01").cast("timestamp")):
        assert with_load_time(df, "t", given).first().t == datetime.datetime(2024, 1, 1)


def test_nan_to_null(spark):
    df = spark.createDataFrame([(1.0,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in df.select(nan_to_null(F.col("v"))).collect()] == [1.0, None, None]


def test_category_rank_and_order(spark):
    df = spark.createDataFrame([("b",), ("z",), ("a",), (None,)], "c string")
    assert [r.cat_rank for r in with_category_rank(df, "c", ["b", "a"]).collect()] == [1, None, 2, None]
    assert [r.c for r in sort_by_category(df, "c", ["b", "a"]).collect()] == ["b", "a", None, "z"]


def test_sort_by_category_cuts_a_large_category(spark):
    df = spark.range(20_000).select(F.when(F.col("id") < 19_000, "big").otherwise("small").alias("c"), "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = sort_by_category(df, "c", ["small", "big"]).rdd.glom().map(lambda rows: [r.c for r in rows]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(parts, []) == ["small"] * 1000 + ["big"] * 19_000
    assert max(len(p) for p in parts) < 8000


def test_dedup_equalities(spark):
    nan = float("nan")
    rows = [(None, 1), (None, 2), (nan, 3), (nan, 4), (0.0, 5), (-0.0, 6)]
    df = spark.createDataFrame(rows, "k double, t int")
    for keep in ("first", "any"):
        assert dedup(df, ["k"], ["t"], keep).count() == 3
    assert sorted(r.t for r in dedup(df, ["k"], ["t"]).collect()) == [1, 3, 5]


def test_dedup_any_keeps_a_whole_row(spark):
    rows = [("a", 1, "x", 10), ("a", 1, "y", 20), ("b", None, None, 30), ("b", None, "z", 40)]
    df = spark.createDataFrame(rows, "k string, n int, s string, v int")
    kept = [tuple(r) for r in dedup(df, ["k", "n"], keep="any").collect()]
    assert sorted(r[0] for r in kept) == ["a", "b"]
    assert set(kept) <= set(rows)


def test_dedup_keeps_the_original_zero(spark):
    df = spark.createDataFrame([(0.0, 2), (-0.0, 1)], "k double, t int")
    kept = dedup(df, ["k"], ["t"]).first()
    assert kept.t == 1
    assert math.copysign(1, kept.k) == -1


def test_dedup_rejects_unknown_keep(spark):
    with pytest.raises(ValueError, match="keep"):
        dedup(spark.range(1), ["id"], keep="last")


def test_dedup_without_order_uses_all_columns(spark):
    df = spark.createDataFrame([("a", "y", 1), ("a", "x", 9), ("a", None, 5)], "k string, s string, n int")
    assert tuple(dedup(df, ["k"]).first()) == ("a", None, 5)


def test_dedup_ignores_unorderable_columns(spark):
    df = spark.sql("SELECT 1 AS k, 2 AS t, map('a', 1) AS m UNION ALL SELECT 1, 1, map('b', 2)")
    assert dedup(df, ["k"], ["t"]).first().m == {"b": 2}


@pytest.mark.parametrize("seed", range(3))
def test_dedup_depends_on_the_data_only(spark, seed):
    rng = random.Random(seed)
    values = [None, float("nan"), 0.0, -0.0, 1.0]
    rows = [
        (rng.choice(values), rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice(values))
        for _ in range(300)
    ]
    schema = "k double, g string, t int, rest double"
    results = set()
    for partitions in (1, 3, 7):
        rng.shuffle(rows)
        df = spark.createDataFrame(rows, schema).repartition(partitions)
        results.add(tuple(sorted(repr(tuple(r)) for r in dedup(df, ["k", "g"], ["t"]).collect())))
    assert len(results) == 1

    def norm(v):
        return "nan" if isinstance(v, float) and math.isnan(v) else v

    assert len(results.pop()) == len({(norm(r[0]), r[1]) for r in rows})


def test_dedup_hot_key_sends_one_row_per_task(spark):
    df = spark.range(0, 60000, 1, 6).select(F.when(F.col("id") % 3 > 0, 0).otherwise(F.col("id")).alias("k"), "id")
    kept = dedup(df, ["k"], ["id"])
    assert kept.count() == 20000
    assert kept.where("k = 0").first().id == 0


SPEC = CleanSpec(
    not_null=("m", "v"),
    trim=("m",),
    to_double=("v",),
    dedup_keys=("m", "v"),
    dedup_order=("t",),
)


def test_clean_checks_nulls_before_casting(spark):
    rows = [(" a ", "1", 3), ("a", "1.0", 2), (None, "1", 1), ("  ", "bad", 1), ("b", None, 1), ("\t", "x", 5)]
    out = clean(spark.createDataFrame(rows, "m string, v string, t int"), SPEC, "2024-01-01 00:00:00")
    got = {(r.m, r.v, r.t) for r in out.collect()}
    assert got == {("a", 1.0, 2), ("", None, 1), ("\t", None, 5)}
    assert out.columns == ["m", "v", "t", "processed_at"]


def test_clean_is_idempotent(spark):
    rows = [(m, v, t) for (m, v), t in itertools.product([(" a", "1"), ("b ", "NaN"), ("c", "bad")], range(4))]
    df = spark.createDataFrame(rows, "m string, v string, t int")
    once = clean(df, SPEC, "2024-01-01 00:00:00")
    again = clean(once.drop("processed_at").where(F.col("v").isNotNull()), SPEC, "2024-01-01 00:00:00")
    expected = once.where(F.col("v").isNotNull())
    assert sorted(map(str, again.collect())) == sorted(map(str, expected.collect()))
