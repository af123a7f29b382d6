"""Queries that build and reset layer tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataflow.catalogue.registry import as_of, query, scratch_layers, table
from strataflow.operators import profile_counts, union_labelled
from strataflow.plans import CleanSpec, PipelineConfig, build_bronze, run_pipeline, telemetry_config
from strataflow.plans.presets import TELEMETRY_COLUMNS
from strataflow.session import scratch_path
from strataflow.sources import (
    LAYERS,
    list_tables,
    read_layer,
    reset_layers,
    table_name,
    write_landing,
    write_layer,
)

RETURN_CLASS = {"returned": "R", "accepted": "A", "none": "N"}


def _by_return_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = {label: lines.where(F.col("l_returnflag") == flag) for label, flag in RETURN_CLASS.items()}
    return union_labelled(parts, "return_class")


@query(
    "q11_gold_union",
    """
    SELECT *, 'returned' AS return_class FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT *, 'accepted' FROM lineitem WHERE l_returnflag = 'A'
    UNION ALL SELECT *, 'none' FROM lineitem WHERE l_returnflag = 'N'
    """,
)
def gold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_return_class(spark, sf_dir)


_CONTENT_BY_CLASS = """
    SELECT CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'accepted' ELSE 'none' END AS return_class,
      count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS orders, CAST(sum(l_partkey * l_linenumber) AS BIGINT) AS parts,
      CAST(sum(l_suppkey * l_linenumber) AS BIGINT) AS supps, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
      CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS price,
      CAST(sum(CAST(round(l_discount * 100) AS BIGINT) * l_linenumber) AS BIGINT) AS discount,
      CAST(sum(CAST(round(l_tax * 100) AS BIGINT) * l_linenumber) AS BIGINT) AS tax,
      max(l_shipdate) AS last_ship, count(*) FILTER (WHERE l_linestatus = 'F') AS closed
    FROM lineitem GROUP BY 1
    """


def _replaced_twice(spark: SparkSession, sf_dir: str, partition_by: list[str]) -> DataFrame:
    name = table_name("gold", "lines", scratch_layers(spark, "replace"))
    for _ in range(2):
        write_layer(_by_return_class(spark, sf_dir), name, "replace", partition_by)
    number, cents = F.col("l_linenumber"), lambda c: F.round(F.col(c) * 100).cast("bigint")
    return spark.table(name).groupBy("return_class").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("l_orderkey").alias("orders"),
        F.sum(F.col("l_partkey") * number).alias("parts"),
        F.sum(F.col("l_suppkey") * number).alias("supps"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
        F.sum(cents("l_extendedprice")).alias("price"),
        F.sum(cents("l_discount") * number).alias("discount"),
        F.sum(cents("l_tax") * number).alias("tax"),
        F.max("l_shipdate").alias("last_ship"),
        F.count_if(F.col("l_linestatus") == "F").alias("closed"),
    )


@query("q12_table_replace", _CONTENT_BY_CLASS)
def table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced_twice(spark, sf_dir, [])


@query("q39_table_by_label", _CONTENT_BY_CLASS)
def table_by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _replaced_twice(spark, sf_dir, ["return_class"])


@query(
    "q13_table_append",
    """
    SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier
    """,
)
def table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = table_name("bronze", "supplier_bz", scratch_layers(spark, "append"))
    suppliers = table(spark, sf_dir, "supplier")
    write_layer(suppliers, name, "append")
    write_layer(suppliers.select(*reversed(suppliers.columns)), name, "append")
    return spark.table(name)


@query(
    "q31_reset_layers",
    """
    SELECT 'before' AS step, CAST(2 AS BIGINT) AS n_tables,
           (SELECT count(*) FROM orders) + (SELECT count(*) FROM events) AS n_rows
    UNION ALL SELECT 'after', 0, 0 UNION ALL SELECT 'missing_layer', 0, 0
    """,
)
def reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = scratch_layers(spark, "reset")

    def state(step: str) -> DataFrame:
        tables = [(layer, t) for layer in LAYERS for t in list_tables(spark, layer, prefix)]
        kept = {t: read_layer(spark, layer, t, prefix) for layer, t in tables}
        rows = profile_counts(kept).agg(F.sum("n")).first()[0] if kept else 0
        return spark.range(1).select(
            F.lit(step).alias("step"),
            F.lit(len(tables)).cast("bigint").alias("n_tables"),
            F.lit(rows).cast("bigint").alias("n_rows"),
        )

    write_layer(table(spark, sf_dir, "orders"), table_name("bronze", "orders_bz", prefix))
    write_layer(table(spark, sf_dir, "events"), table_name("silver", "events_bz", prefix))
    steps = [state("before")]
    reset_layers(spark, prefix)
    steps.append(state("after"))
    for layer in LAYERS:
        spark.sql(f"DROP DATABASE {prefix}{layer}_layer")
    reset_layers(spark, prefix)
    steps.append(state("missing_layer"))
    return steps[0].union(steps[1]).union(steps[2])


FLAG_SPEC = CleanSpec(
    not_null=("rf",),
    trim=("rf",),
    to_double=("l_quantity", "l_discount", "l_tax"),
    dedup_keys=("l_quantity", "l_discount", "l_tax", "rf", "l_linestatus"),
    dedup_order=("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
)


def land_lines(spark: SparkSession, sf_dir: str) -> dict[str, str]:
    """Lineitem as landing folders, one per return flag, with a padded or blank flag column."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_orderkey") % 17 != 0, F.concat(F.lit(" "), "l_returnflag", F.lit(" ")))
    root = scratch_path(spark, "landing")
    write_landing(lines.withColumn("rf", flag).withColumn("source", F.col("l_returnflag")), root, ["source"])
    return {label: f"{root}/source={label}" for label in ("A", "N", "R")}


def lines_config(spark: SparkSession, landing: dict[str, str]) -> PipelineConfig:
    return PipelineConfig(
        landing=landing,
        spec=FLAG_SPEC,
        gold_table="all_lines",
        gold_label="return_class",
        prefix=scratch_layers(spark, "lines"),
        as_of=as_of(),
    )


_ALL_LAYERS = """
    WITH raw AS (SELECT *, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE ' ' || l_returnflag || ' ' END AS rf
                 FROM lineitem),
    d AS (SELECT DISTINCT l_quantity, l_discount, l_tax, trim(rf) AS rf, l_linestatus FROM raw WHERE rf IS NOT NULL)
    SELECT 'bronze' AS layer, l_returnflag AS source, count(*) AS n FROM lineitem GROUP BY 2
    UNION ALL SELECT 'silver', rf, count(*) FROM d GROUP BY rf
    UNION ALL SELECT 'gold', 'all', count(*) FROM d
    """


@query("q32_all_layers", _ALL_LAYERS)
def all_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_pipeline(spark, lines_config(spark, land_lines(spark, sf_dir)))


_READINGS = """
    SELECT CASE l_returnflag WHEN 'A' THEN 'recommissioned' WHEN 'R' THEN 'regular_alt' ELSE 'second_life' END
             AS battery_type,
           strftime(l_shipdate, '%m:%d:%Y %H:%M:%S') AS start_time,
           CAST(l_orderkey * 100000000 + l_partkey * 1000 + l_suppkey % 1000 AS DOUBLE) AS "time",
           l_quantity AS voltage_charger, l_discount AS temperature_battery, l_tax AS voltage_load,
           CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE CAST(l_linenumber AS DOUBLE) END AS current_load,
           CAST(l_partkey % 3 AS DOUBLE) AS temperature_mosfet, 26.0::DOUBLE AS temperature_resistor,
           l_linestatus AS mission_type, l_extendedprice
    FROM lineitem WHERE l_orderkey % 4 <> 0
    """


@query(
    "q40_telemetry_gold",
    f"""
    WITH readings AS ({_READINGS})
    SELECT battery_type, start_time, "time", '-1' AS mode, voltage_charger, temperature_battery, voltage_load,
           current_load, temperature_mosfet, temperature_resistor, mission_type,
           TIMESTAMP '2024-01-01 00:00:00' AS created_at, TIMESTAMP '2024-01-01 00:00:00' AS processed_at
    FROM readings QUALIFY row_number() OVER (
      PARTITION BY battery_type, voltage_charger, temperature_battery, voltage_load, current_load,
                   temperature_mosfet, temperature_resistor, mission_type
      ORDER BY "time", start_time) = 1
    """,
)
def telemetry_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem recast as cycler readings: every fourth order rests, some currents are malformed."""
    flags = {"A": "recommissioned_batteries", "R": "regular_alt_batteries", "N": "second_life_batteries"}
    rest = F.col("l_orderkey") % 4 == 0
    place = F.col("l_orderkey") * 100_000_000 + F.col("l_partkey") * 1000 + F.col("l_suppkey") % 1000

    def in_discharge(value: Column) -> Column:
        return F.when(~rest, value)

    cells = {
        "start_time": F.date_format("l_shipdate", "MM:dd:yyyy HH:mm:ss"),
        "time": place,
        "mode": F.when(rest, "0").otherwise(" -1 "),
        "voltage_charger": F.col("l_quantity"),
        "temperature_battery": F.col("l_discount"),
        "voltage_load": in_discharge(F.col("l_tax")),
        "current_load": in_discharge(
            F.when(F.col("l_suppkey") % 11 == 0, "n/a").otherwise(F.col("l_linenumber").cast("string"))
        ),
        "temperature_mosfet": in_discharge(F.col("l_partkey") % 3),
        "temperature_resistor": in_discharge(F.lit("26")),
        "mission_type": in_discharge(F.concat(F.lit(" "), "l_linestatus")),
    }
    lines = table(spark, sf_dir, "lineitem")
    root = scratch_path(spark, "telemetry")
    for flag, folder in flags.items():
        rows = lines.where(F.col("l_returnflag") == flag).select(*[cells[c].alias(c) for c in TELEMETRY_COLUMNS])
        write_landing(rows, f"{root}/{folder}")
    config = telemetry_config(root, prefix=scratch_layers(spark, "telemetry"), as_of=as_of())
    run_pipeline(spark, config)
    # the pack number is the name Spark gave the file, so it is left out here
    return read_layer(spark, "gold", config.gold_table, config.prefix).drop("battery_number")


@query(
    "q44_bronze_once",
    """
    SELECT l_returnflag AS source, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS key_sum
    FROM lineitem GROUP BY l_returnflag
    """,
)
def bronze_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the landing files before the first run, the rest before the second, none
    before the third."""
    lines = table(spark, sf_dir, "lineitem").withColumn("source", F.col("l_returnflag"))
    root, seen = scratch_path(spark, "landing"), scratch_path(spark, "seen")
    prefix = scratch_layers(spark, "once")
    sources = {f"{flag}_bz": f"{root}/source={flag}" for flag in ("A", "N", "R")}
    early = F.col("l_linestatus") == "F"
    for part in (lines.where(early), lines.where(~early), None):
        if part is not None:
            write_landing(part, root, ["source"], mode="append")
        build_bronze(spark, sources, mode="once", checkpoint=seen, prefix=prefix, as_of=as_of())
    loaded = {flag: read_layer(spark, "bronze", f"{flag}_bz", prefix) for flag in ("A", "N", "R")}
    return (
        union_labelled(loaded, "source")
        .groupBy("source")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("l_orderkey").cast("bigint")).alias("key_sum"))
    )


@query(
    "q45_once_mixed",
    "SELECT o_orderstatus, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS key_sum FROM orders GROUP BY o_orderstatus",
)
def once_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of plain and compressed files, and of columns in another order, with a change of mode in between."""
    columns = ["o_orderkey", "o_custkey", "o_orderstatus"]
    orders = table(spark, sf_dir, "orders").select(columns)
    root, seen, prefix = scratch_path(spark, "landing"), scratch_path(spark, "seen"), scratch_layers(spark, "mixed")
    part = F.pmod(F.xxhash64("o_orderkey"), F.lit(3))

    def load(mode: str) -> None:
        build_bronze(spark, {"orders_bz": root}, columns, mode=mode, checkpoint=seen, prefix=prefix, as_of=as_of())

    write_landing(orders.where(part == 0), root)
    load("once")
    orders.where(part == 1).write.mode("append").option("header", True).option("compression", "gzip").csv(root)
    load("replace")
    load("once")
    write_landing(orders.where(part == 2).select(columns[::-1]), root, mode="append")
    for _ in range(2):
        load("once")
    key = F.col("o_orderkey").cast("bigint")
    loaded = read_layer(spark, "bronze", "orders_bz", prefix)
    return loaded.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.sum(key).alias("key_sum"))


@query("q48_layers_by_batches", _ALL_LAYERS)
def layers_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All layers in load-once runs: closed lines, then open ones, then nothing new."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_orderkey") % 17 != 0, F.concat(F.lit(" "), "l_returnflag", F.lit(" ")))
    lines = lines.withColumn("rf", flag).withColumn("source", F.col("l_returnflag"))
    root, closed = scratch_path(spark, "landing"), F.col("l_linestatus") == "F"
    config = lines_config(spark, {label: f"{root}/source={label}" for label in ("A", "N", "R")})
    config = replace(config, mode="once", checkpoint=scratch_path(spark, "seen"))
    for part in (lines.where(closed), lines.where(~closed), None):
        if part is not None:
            write_landing(part, root, ["source"], mode="append")
        counts = run_pipeline(spark, config)
    return counts


@query(
    "q52_rows_by_layer",
    """
    WITH raw AS (SELECT *, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE ' ' || l_returnflag || ' ' END AS rf FROM lineitem),
    d AS (SELECT DISTINCT l_quantity, l_discount, l_tax, trim(rf) AS rf, l_linestatus FROM raw WHERE rf IS NOT NULL),
    n AS (SELECT l_returnflag AS source, count(*) AS n, count(rf) AS valued FROM raw GROUP BY 1),
    w AS (SELECT rf AS source, count(*) AS written FROM d GROUP BY 1)
    SELECT 'bronze' AS layer, source || '_bz' AS source, n AS rows_in, CAST(0 AS BIGINT) AS no_value, CAST(0 AS BIGINT) AS malformed,
      CAST(0 AS BIGINT) AS repeated, n AS written FROM n
    UNION ALL SELECT 'silver', source || '_bz', n, n - valued, 0, valued - written, written FROM n JOIN w USING (source)
    UNION ALL SELECT 'gold', 'all_lines', CAST(sum(written) AS BIGINT), 0, 0, 0, CAST(sum(written) AS BIGINT) FROM w
    """,
)
def rows_by_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each layer read, left out and wrote, counted by the tasks that wrote it."""
    reports: list = []
    run_pipeline(spark, lines_config(spark, land_lines(spark, sf_dir)), reports=reports)
    bronze, silver, gold = (report.rows_df() for report in reports)
    return bronze.union(silver).union(gold)


@query(
    "q53_gold_content_by_batches",
    """
    WITH raw AS (SELECT *, CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE ' ' || l_returnflag || ' ' END AS rf FROM lineitem),
    first AS (
      SELECT * FROM raw WHERE rf IS NOT NULL QUALIFY row_number() OVER (
        PARTITION BY l_quantity, l_discount, l_tax, rf, l_linestatus
        ORDER BY strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S'), CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
          CAST(l_suppkey AS VARCHAR)) = 1)
    SELECT l_returnflag AS return_class, l_orderkey AS order_key, l_partkey AS part_key, l_suppkey AS supp_key,
      CAST(l_linenumber AS BIGINT) AS line, l_quantity, l_discount, l_tax, l_linestatus, trim(rf) AS rf, l_shipdate AS ship_date
    FROM first
    """,
)
def gold_content_by_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of gold after load-once runs: closed lines, then open ones, whose keys all differ, then nothing new."""
    lines = table(spark, sf_dir, "lineitem")
    flag = F.when(F.col("l_orderkey") % 17 != 0, F.concat(F.lit(" "), "l_returnflag", F.lit(" ")))
    lines = lines.withColumn("rf", flag).withColumn("source", F.col("l_returnflag"))
    root, closed = scratch_path(spark, "landing"), F.col("l_linestatus") == "F"
    config = lines_config(spark, {label: f"{root}/source={label}" for label in ("A", "N", "R")})
    config = replace(config, mode="once", checkpoint=scratch_path(spark, "seen"))
    for part in (lines.where(closed), lines.where(~closed), None):
        if part is not None:
            write_landing(part, root, ["source"], mode="append")
        run_pipeline(spark, config)
    gold = read_layer(spark, "gold", config.gold_table, config.prefix)
    number = lambda c, name: F.col(c).cast("bigint").alias(name)
    return gold.select(
        "return_class", number("l_orderkey", "order_key"), number("l_partkey", "part_key"), number("l_suppkey", "supp_key"),
        number("l_linenumber", "line"), "l_quantity", "l_discount", "l_tax", "l_linestatus", "rf",
        F.col("l_shipdate").cast("timestamp_ntz").alias("ship_date"),
    )
