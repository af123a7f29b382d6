"""Each rule matters: with the rule left out, the rows differ from the SQL's."""

import uuid

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from strataflow.catalogue import cleaning, landing, layers, runs
from strataflow.plans import CleanSpec
from tests.compare import connect, duck_rows, spark_rows


def without(spec, **changes):
    return CleanSpec(**{**spec.__dict__, **changes})


BROKEN = {
    "q05_require_not_null": lambda m: m.setattr(cleaning, "require_not_null", lambda df, cols: df.dropna(subset=cols)),
    "q06_trim_columns": lambda m: m.setattr(cleaning, "trim_columns", lambda df, cols: df),
    "q07_to_double": lambda m: m.setattr(
        cleaning,
        "to_double",
        lambda df, cols: df.withColumns({c: F.col(c).try_cast("int").cast("double") for c in cols}),
    ),
    "q08_dedup_first": lambda m: m.setattr(cleaning, "ORDER", list(reversed(cleaning.ORDER))),
    "q09_dedup_any_keys": lambda m: m.setattr(cleaning, "dedup", lambda df, keys, keep: df),
    "q10_silver_clean": lambda m: m.setattr(cleaning, "LINE_SPEC", without(cleaning.LINE_SPEC, trim=())),
    "q11_gold_union": lambda m: m.setattr(layers, "RETURN_CLASS", {"returned": "R", "accepted": "A", "none": "A"}),
    "q12_table_replace": lambda m: m.setattr(
        layers, "write_layer", lambda df, name, mode, parts: df.write.mode("append").saveAsTable(name)
    ),
    "q13_table_append": lambda m: m.setattr(
        layers, "write_layer", lambda df, name, mode: df.write.mode("overwrite").saveAsTable(name)
    ),
    "q16_profile_nulls": lambda m: m.setattr(
        cleaning,
        "dirty_lines",
        lambda s, d: cleaning.table(s, d, "lineitem").withColumnsRenamed(
            {"l_returnflag": "returnflag", "l_quantity": "quantity", "l_linestatus": "linestatus"}
        ),
    ),
    "q20_mean_by": lambda m: m.setattr(
        runs, "mean_by", lambda df, by, metrics: df.groupBy(by).agg(*[F.avg(c).alias(c) for c in metrics])
    ),
    "q27_counter_delta": lambda m: m.setattr(
        runs, "counter_delta", lambda *a, **k: runs_counter_delta(*a, start=None, **k)
    ),
    "q30_ingest_once": lambda m: m.setattr(
        landing, "ingest_once", lambda s, src, dst, check, cols: fresh_checkpoint(s, src, dst, check, cols)
    ),
    "q32_all_layers": lambda m: m.setattr(layers, "FLAG_SPEC", without(layers.FLAG_SPEC, not_null=())),
    "q33_load_guard": lambda m: m.setattr(landing, "pending_files", lambda manifest, loaded: manifest),
    "q44_bronze_once": lambda m: m.setattr(
        layers, "build_bronze", lambda *a, mode, checkpoint, **k: real_build_bronze(*a, mode="append", **k)
    ),
}

runs_counter_delta = runs.counter_delta
real_ingest_once = landing.ingest_once
real_build_bronze = layers.build_bronze


def fresh_checkpoint(spark, src, dst, check, cols):
    other = f"{dst}-{uuid.uuid4().hex}"
    real_ingest_once(spark, src, f"{other}-a", f"{check}-{uuid.uuid4().hex}", cols)
    twice = real_ingest_once(spark, src, f"{other}-b", f"{check}-{uuid.uuid4().hex}", cols)
    return twice.union(spark.read.schema(twice.schema).parquet(f"{other}-a"))


@pytest.mark.parametrize("name", sorted(BROKEN))
def test_broken_rule_is_noticed(spark, sf_dir, monkeypatch, name):
    BROKEN[name](monkeypatch)
    got = spark_rows(contract.queries()[name](spark, sf_dir))
    assert got != duck_rows(connect(sf_dir), contract.oracle_sql()[name])

