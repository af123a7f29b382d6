"""Replacing and appending to tables with the driver lost at every step."""

import re
import uuid

import pytest
from pyspark.sql import DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from strataflow.session import scratch_path
from strataflow.sources import ensure_layers, list_tables, read_layer, reset_layers, table_name, write_layer
from strataflow.sources.tables import ASIDE, LOAD_COMMIT


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:10]}_"
    ensure_layers(spark, name, scratch_path(spark, "layers"))
    yield name
    reset_layers(spark, name)


class Lost(BaseException):
    """The driver is gone: nothing after it runs, no clean-up either."""


def lose_driver_at(monkeypatch, step):
    """Raises before the n-th statement or write that changes something; False if there are fewer."""
    sql, save, seen = SparkSession.sql, DataFrameWriter.saveAsTable, []

    def count():
        seen.append(1)
        if len(seen) == step:
            raise Lost

    def statement(self, text, *args, **kwargs):
        if re.match(r"\s*(CREATE|ALTER|DROP|INSERT)", text):
            count()
        return sql(self, text, *args, **kwargs)

    def written(self, *args, **kwargs):
        count()
        return save(self, *args, **kwargs)

    monkeypatch.setattr(SparkSession, "sql", statement)
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", written)
    return seen


def rows(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("by", [(), ("b",)])
@pytest.mark.parametrize("change", ["rows", "columns", "first"])
def test_replace_leaves_old_or_new_rows_at_every_step(spark, prefix, monkeypatch, by, change):
    old = spark.range(20).select(F.col("id").alias("a"), (F.col("id") % 3).alias("b"))
    new = spark.range(5).select(F.col("id").alias("a"), (F.col("id") % 2 + 7).alias("b"))
    if change == "columns":
        new = new.select("a", F.lit("x").alias("c"), "b")
    states, step, done = set(), 0, False
    while not done:
        step += 1
        table = f"t{step}"
        name = table_name("gold", table, prefix)
        if change != "first":
            for _ in range(2):
                write_layer(old, name, partition_by=by)
            assert rows(spark.table(name)) == rows(old)
        with monkeypatch.context() as m:
            seen = lose_driver_at(m, step)
            try:
                write_layer(new, name, partition_by=by)
                done = True
            except Lost:
                pass
        if change == "rows":  # whoever reads finds one or the other at any moment
            assert rows(spark.table(name).select("a", "b")) in (rows(old), rows(new))
        there = spark.catalog.tableExists(name) or change != "first"
        found = rows(read_layer(spark, "gold", table, prefix).select(*new.columns if done else ("a", "b"))) if there else None
        assert found in ([rows(new)] if done else [rows(old.select("a", "b")), rows(new.select("a", "b")), *([None] if change == "first" else [])])
        states.add(str(found))
        write_layer(new, name, partition_by=by)  # the next run
        assert rows(read_layer(spark, "gold", table, prefix).select(*new.columns)) == rows(new)
        shown = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {prefix}gold_layer LIKE '{table}*'").collect()]
        assert len(shown) == 2 and len([t for t in shown if ASIDE in t]) == 1  # nothing unfinished is left
    assert step > len(seen) >= 3 and len(states) >= 2


def test_partitions_of_a_replaced_table(spark, prefix):
    name = table_name("gold", "t", prefix)
    for n in (3, 2):
        write_layer(spark.range(30).select("id", (F.col("id") % n).alias("part")), name, partition_by=["part"])
    table = spark.table(name)
    assert rows(table.groupBy("part").count()) == [(0, 15), (1, 15)]
    plan = table.where("part = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(part" in plan and len(table.where("part = 1").inputFiles()) <= len(table.inputFiles())
    write_layer(spark.range(4).select("id", F.lit(9).cast("bigint").alias("part")), name, "append", ["part"])
    assert spark.table(name).where("part = 9").count() == 4 and spark.table(name).count() == 34
    assert list_tables(spark, "gold", prefix) == ["t"]


def test_a_failed_write_leaves_the_table(spark, prefix):
    name = table_name("gold", "t", prefix)
    write_layer(spark.range(3), name)
    broken = spark.range(5).select(F.when(F.col("id") == 4, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        write_layer(broken, name)
    assert rows(spark.table(name)) == [(0,), (1,), (2,)]
    write_layer(spark.table(name).where("id > 0"), name)  # reads what it replaces
    assert rows(spark.table(name)) == [(1,), (2,)]


def test_an_append_that_is_repeated_replaces_itself(spark, prefix, monkeypatch):
    name = table_name("bronze", "t", prefix)
    load = lambda low, high, commit: write_layer(spark.range(low, high).select("id"), name, "append", commit=commit)
    load(0, 5, "monday's")
    load(5, 9, "b")
    step, done = 0, False
    while not done:
        step += 1
        with monkeypatch.context() as m:
            lose_driver_at(m, step)
            try:
                load(9, 12, "c")
                done = True
            except Lost:
                pass
        load(9, 12, "c")
        load(0, 5, "monday's")
        assert sorted(r["id"] for r in spark.table(name).collect()) == list(range(12))
    assert {r[LOAD_COMMIT] for r in spark.table(name).select(LOAD_COMMIT).distinct().collect()} == {"monday's", "b", "c"}
    other = table_name("bronze", "plain", prefix)
    write_layer(spark.range(3), other)
    with pytest.raises(ValueError, match="commit"):
        write_layer(spark.range(3), other, "append", commit="x")
