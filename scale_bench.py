"""Times the layer build on a landing tree of several GB derived from lineitem.

    python scale_bench.py [copies] [runs]

Writes three folders, one with half of the rows (36 MB of CSV per copy at
sf0.1), then builds all layers ``runs`` times in ``replace`` mode. Prints one JSON line
per run with seconds per stage, rows per layer and landing MB per second.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

import bench
from strataflow.catalogue.registry import as_of, scratch_layers
from strataflow.plans import TELEMETRY_SOURCES, run_pipeline, telemetry_config
from strataflow.session import cluster_conf, scratch_path
from strataflow.sources import landing_manifest, write_landing



def readings() -> dict[str, Column]:
    """Lineitem and a copy number as cycler cells; a quarter of the rows is rest."""
    rest = F.col("l_orderkey") % 4 == 0

    def on_load(value: Column) -> Column:
        return F.when(~rest, value)

    return {
        "start_time": F.date_format("l_shipdate", "MM:dd:yyyy HH:mm:ss"),
        "time": F.col("l_orderkey") + F.col("copy") * 1_000_000 + F.col("l_linenumber") / 10,
        "mode": F.when(rest, "0").otherwise(" -1 "),
        "voltage_charger": F.round(F.col("l_extendedprice") / 1000 + F.col("copy") % 50, 3),
        "temperature_battery": F.col("l_quantity"),
        "voltage_load": on_load(F.col("l_tax")),
        "current_load": on_load(F.col("l_discount")),
        "temperature_mosfet": on_load(F.col("l_partkey") % 60),
        "temperature_resistor": on_load(F.col("l_suppkey") % 60),
        "mission_type": on_load(F.col("l_linenumber") % 2),
    }


def land(spark: SparkSession, sf_dir: str, copies: int) -> str:
    """Write the tree; a quarter of the rows goes to each of the last two folders."""
    root = scratch_path(spark, "scale")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cells = [cell.alias(name) for name, cell in readings().items()]
    rows = lines.repartition(32).withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(copies))))
    part = F.pmod(F.xxhash64("l_orderkey", "l_partkey", "copy"), F.lit(4))
    for i, folder in enumerate(TELEMETRY_SOURCES):
        its = part < 2 if i == 0 else part == i + 1
        write_landing(rows.where(its).select(*cells), f"{root}/{folder}")
    return root


def main() -> None:
    copies = int(sys.argv[1]) if len(sys.argv) > 1 else 10
    runs = int(sys.argv[2]) if len(sys.argv) > 2 else 3
    spark = bench.session(int(os.environ.get("BENCH_CPUS", os.cpu_count() or 4)))
    root = land(spark, os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), copies)
    mb = landing_manifest(spark, root).agg(F.sum("bytes")).first()[0] / 2**20
    for key, value in cluster_conf(int(mb * 2**20)).items():
        spark.conf.set(key, value)
    config = telemetry_config(root, prefix=scratch_layers(spark, "scale"), as_of=as_of())
    for run in range(1, runs + 1):
        stages: dict[str, float] = {}
        started = time.perf_counter()
        counts = run_pipeline(spark, config, stages.__setitem__).groupBy("layer").agg(F.sum("n").alias("n")).collect()
        total = time.perf_counter() - started
        line = {
            "run": run,
            "landing_mb": round(mb, 1),
            "total_s": round(total, 2),
            "stages_s": {name: round(s, 2) for name, s in stages.items()},
            "rows": {r["layer"]: r["n"] for r in counts},
            "mb_per_s": round(mb / total, 1),
        }
        print(json.dumps(line), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
