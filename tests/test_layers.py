"""Layer tables: the cycler fixtures end to end, write modes, failures, resets."""

import gzip
import os
import uuid
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from strataflow.plans import (
    TELEMETRY_COLUMNS,
    TELEMETRY_SPEC,
    CleanSpec,
    LayerError,
    build_bronze,
    build_gold,
    build_silver,
    layer_counts,
    run_pipeline,
    telemetry_config,
)
from strataflow.session import scratch_path, shared_dir
from strataflow.sources import (
    ensure_layers,
    list_tables,
    read_layer,
    reset_layers,
    table_name,
    write_layer,
)
from strataflow.sources.keyindex import KeyIndex
from tests.test_landing import put

AS_OF = "2024-01-01 00:00:00"
HEADER = ",".join(TELEMETRY_COLUMNS)
PACK = """\
01:02:2022 10:00:00,0.0, -1 ,8.1,20,8.0,16,25,26,0
01:02:2022 10:00:00,1.0,-1,8.1,20,8.0,16,25,26,0
01:02:2022 10:00:00,2.0,0,8.1,20,,,,,
01:02:2022 10:00:00,3.0,-1,bad,20,8.0,16,25,26,"  "
01:02:2022 10:00:00,4.0,-1,NaN,20,8.0,-0.0,25,26,0
"""


@pytest.fixture
def prefix(spark):
    name = f"t{uuid.uuid4().hex[:10]}_"
    ensure_layers(spark, name, scratch_path(spark, "layers"))
    yield name
    reset_layers(spark, name)


def landing(root):
    put(root, "regular_alt_batteries/battery00.csv", f"{HEADER}\n{PACK}")
    put(root, "recommissioned_batteries/battery02.csv", f"{HEADER}\n{PACK}")
    put(root, "second_life_batteries/battery13.csv", f"{HEADER}\n{PACK}")
    return str(root)


def counts(df):
    return {(r.layer, r.source): r.n for r in df.collect()}


LABELS = ("recommissioned", "regular_alt", "second_life")
EXPECTED = {(layer, label): n for layer, n in (("bronze", 5), ("silver", 3)) for label in LABELS}
EXPECTED["gold", "all"] = 9


def test_cycler_fixture_end_to_end(spark, prefix, tmp_path):
    config = telemetry_config(landing(tmp_path), prefix=prefix, as_of=AS_OF)
    seconds = {}
    assert counts(run_pipeline(spark, config, seconds.__setitem__)) == EXPECTED
    assert list(seconds) == ["bronze", "silver", "gold"]

    bronze = read_layer(spark, "bronze", "regular_alt_batteries_bz", prefix)
    assert [f.dataType.simpleString() for f in bronze.schema.fields] == ["string"] * 11 + ["timestamp"]
    silver = read_layer(spark, "silver", "regular_alt_batteries_bz", prefix)
    rows = {r.time: r for r in silver.collect()}
    assert sorted(rows) == [0.0, 3.0, 4.0]
    assert rows[0.0].mode == "-1"
    assert rows[3.0].voltage_charger is None
    assert rows[3.0].mission_type == ""
    assert str(rows[4.0].current_load) == "-0.0"
    assert dict(silver.dtypes)["start_time"] == "string"
    gold = read_layer(spark, "gold", "all_batteries_gold", prefix)
    assert len(gold.columns) == 14
    assert gold.columns[-2:] == ["processed_at", "battery_type"]
    found = gold.select("battery_type", "battery_number").distinct().collect()
    assert {tuple(r) for r in found} == {
        ("regular_alt", "battery00"),
        ("recommissioned", "battery02"),
        ("second_life", "battery13"),
    }


def test_replace_twice_is_once_and_append_accumulates(spark, prefix, tmp_path):
    root = landing(tmp_path)
    for _ in range(2):
        assert counts(run_pipeline(spark, telemetry_config(root, prefix=prefix))) == EXPECTED
    appended = counts(run_pipeline(spark, telemetry_config(root, prefix=prefix, mode="append")))
    assert appended["bronze", "regular_alt"] == 10
    assert appended["silver", "regular_alt"] == 6  # three old rows, and three from all of bronze
    assert appended["gold", "all"] == 18


def test_once_loads_new_files_only(spark, prefix, tmp_path):
    root = landing(tmp_path / "in")
    config = telemetry_config(root, prefix=prefix, mode="once", checkpoint=str(tmp_path / "seen"))
    assert counts(run_pipeline(spark, config)) == EXPECTED
    assert counts(run_pipeline(spark, config)) == EXPECTED
    put(root, "second_life_batteries/battery36.csv", f"{HEADER}\n{PACK}".replace("8.1", "8.2"))
    again = counts(run_pipeline(spark, config))
    assert again["bronze", "second_life"] == 10
    # one new reading at 8.2 V; the bad and NaN readings are the same in both packs
    assert again["silver", "second_life"] == 4
    assert again["bronze", "regular_alt"] == 5
    with pytest.raises(ValueError, match="checkpoint"):
        build_bronze(spark, {"x": root}, mode="once", prefix=prefix)


def test_three_loads_are_one_build(spark, prefix, tmp_path):
    """Silver and gold by batches equal a full build, and a later run writes only its own batch."""
    root = landing(tmp_path / "in")
    config = telemetry_config(root, prefix=prefix, mode="once", checkpoint=str(tmp_path / "seen"), as_of=AS_OF)
    silver = table_name("silver", "second_life_batteries_bz", prefix)
    files = []
    for n in range(3):
        run_pipeline(spark, config)
        files.append(set(spark.table(silver).inputFiles()))
        put(root, f"second_life_batteries/more{n}.csv", f"{HEADER}\n{PACK}".replace("8.1", f"9.{n}"))
    assert all(before <= after for before, after in zip(files, files[1:], strict=False))
    run_pipeline(spark, config)
    read = lambda: sorted(map(str, read_layer(spark, "gold", "all_batteries_gold", prefix).drop("load_batch").collect()))
    by_batches = read()
    assert len(by_batches) == 9 + 3
    run_pipeline(spark, replace(config, mode="replace"))
    assert read() == by_batches
    run_pipeline(spark, config)  # starts anew
    assert read() == by_batches


def test_packs_with_equal_readings_collapse(spark, prefix, tmp_path):
    put(tmp_path, "b/one.csv", f"{HEADER}\n{PACK}")
    put(tmp_path, "b/two.csv", f"{HEADER}\n{PACK}")
    build_bronze(spark, {"b_bz": str(tmp_path / "b")}, lineage="battery_number", prefix=prefix)
    build_silver(spark, ["b_bz"], TELEMETRY_SPEC, prefix=prefix)
    silver = read_layer(spark, "silver", "b_bz", prefix)
    assert silver.count() == 3
    assert {r.battery_number for r in silver.collect()} == {"one"}


def test_bronze_headers_by_name(spark, prefix, tmp_path):
    lines = [line.split(",") for line in PACK.splitlines()]
    turned = "\n".join(",".join(reversed(line)) for line in [HEADER.split(","), *lines])
    put(tmp_path, "b/one.csv", f"{HEADER}\n{PACK}")
    put(tmp_path, "b/turned.csv", turned + "\n")
    put(tmp_path, "b/none.csv", f"{HEADER}\n")
    sources = {"b_bz": str(tmp_path / "b")}
    for headers in ("auto", "by_file"):
        report = build_bronze(spark, sources, TELEMETRY_COLUMNS, AS_OF, headers=headers, lineage="pack", prefix=prefix)
        assert report.to_df().count() == 0
        rows = read_layer(spark, "bronze", "b_bz", prefix)
        one, turned_rows = (
            sorted(map(str, rows.where(F.col("pack") == pack).drop("pack").collect())) for pack in ("one", "turned")
        )
        assert len(one) == 5
        assert one == turned_rows
    with pytest.raises(LayerError, match="header"):
        build_bronze(spark, sources, TELEMETRY_COLUMNS, headers="same", prefix=prefix)


@pytest.mark.parametrize("mode", ["replace", "once"])
def test_bronze_takes_the_order_from_the_files(spark, prefix, tmp_path, mode):
    put(tmp_path, "b/one.csv", "b,a\n2,1\n")
    put(tmp_path, "b/two.csv", "b,a\n4,3\n")
    sources = {"b_bz": [str(tmp_path / "b")]}
    seen = str(tmp_path / "seen")
    build_bronze(spark, sources, ("a", "b"), mode=mode, checkpoint=seen, headers="same", prefix=prefix)
    rows = read_layer(spark, "bronze", "b_bz", prefix).select("a", "b")
    assert sorted(tuple(r) for r in rows.collect()) == [("1", "2"), ("3", "4")]


def test_bronze_reports_rejected_files_and_loads_the_rest(spark, prefix, tmp_path):
    put(tmp_path, "b/good.csv", "a,b\n1,2\n")
    put(tmp_path, "b/short.csv", "a\n1\n")
    put(tmp_path, "c/fine.csv", "a,b\n3,4\n")
    sources = {"b_bz": str(tmp_path / "b"), "c_bz": str(tmp_path / "c"), "gone_bz": str(tmp_path / "gone")}
    report = build_bronze(spark, sources, ("a", "b"), on_error="report", prefix=prefix)
    seen = sorted((r.source, os.path.basename(r.file or ""), r.problem.split(" ")[0]) for r in report.to_df().collect())
    assert seen[0] == ("b_bz", "short.csv", "missing")
    assert seen[1][0] == "gone_bz"
    assert "PATH_NOT_FOUND" in seen[1][2]
    assert counts(layer_counts(spark, {"bronze": {"b": "b_bz", "c": "c_bz"}}, prefix)) == {
        ("bronze", "b"): 1,
        ("bronze", "c"): 1,
    }
    with pytest.raises(LayerError, match="short.csv"):
        build_bronze(spark, sources, ("a", "b"), prefix=prefix)


def test_silver_failure_is_not_swallowed(spark, prefix, tmp_path):
    put(tmp_path, "b/x.csv", "a,b\n1,2\n")
    build_bronze(spark, {"b_bz": str(tmp_path / "b")}, prefix=prefix)
    with pytest.raises(LayerError, match="silver.b_bz"):
        build_silver(spark, ["b_bz"], CleanSpec(not_null=("nope",)), prefix=prefix)
    with pytest.raises(ValueError, match="on_error"):
        build_silver(spark, ["b_bz"], CleanSpec(), on_error="ignore", prefix=prefix)


def test_gold_keeps_duplicates_and_prunes_by_label(spark, prefix):
    for name in ("a_bz", "b_bz"):
        write_layer(spark.range(3), table_name("silver", name, prefix))
    for by_label in (False, True):
        build_gold(spark, {"a": "a_bz", "b": "b_bz"}, "all_rows", "kind", prefix, by_label)
        gold = read_layer(spark, "gold", "all_rows", prefix)
        assert sorted(tuple(r) for r in gold.collect()) == [(i, k) for i in range(3) for k in "ab"]
    plan = gold.where("kind = 'a'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan


def test_append_matches_names_and_refuses_other_columns(spark, prefix):
    name = table_name("bronze", "x_bz", prefix)
    df = spark.sql("SELECT 1 AS a, 'x' AS b")
    write_layer(df, name, "append")
    write_layer(df.select("b", "a"), name, "append")
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")] * 2
    with pytest.raises(Exception, match="(?i)column"):
        write_layer(df.withColumn("c", F.lit(1)), name, "append")
    write_layer(spark.table(name).where("a = 1").limit(1), name, "replace")
    assert [tuple(r) for r in spark.table(name).collect()] == [(1, "x")]
    with pytest.raises(ValueError, match="mode"):
        write_layer(df, name, "upsert")


@pytest.mark.parametrize("partition_by", [[], ["p"]])
def test_failed_replace_leaves_the_old_rows(spark, prefix, partition_by):
    name = table_name("silver", "x_bz", prefix)
    failing = spark.range(1000).select(F.expr("IF(id = 999, raise_error('lost'), id)").cast("bigint").alias("a"), F.lit("q").alias("p"))
    write_layer(spark.range(3).select(F.col("id").alias("a"), F.lit("q").alias("p")), name, "replace", partition_by)
    for mode in ("replace", "append"):
        with pytest.raises(Exception, match="lost"):
            write_layer(failing, name, mode, partition_by)
        assert sorted(r.a for r in spark.table(name).collect()) == [0, 1, 2]
    assert list_tables(spark, "silver", prefix, unfinished=True) == ["x_bz"]
    write_layer(spark.table(name).where("a > 0"), name, "replace", partition_by)
    assert sorted(r.a for r in spark.table(name).collect()) == [1, 2]


def test_replace_takes_other_columns(spark, prefix):
    name = table_name("gold", "x", prefix)
    for df in (spark.range(2), spark.range(3).withColumn("b", F.lit("x")), spark.sql("SELECT 'y' AS b, 1L AS id")):
        write_layer(df, name)
        assert spark.table(name).dtypes == df.dtypes
        assert sorted(map(str, spark.table(name).collect())) == sorted(map(str, df.collect()))
    write_layer(spark.table(name), f"{name[:-1]}_parts`", partition_by=["b"])
    write_layer(spark.range(2), f"{name[:-1]}_parts`")
    assert spark.table(f"{name[:-1]}_parts`").count() == 2


def numbers(spark, prefix, table="b_bz"):
    return sorted(r.a for r in read_layer(spark, "bronze", table, prefix).collect())


def test_once_takes_late_compressed_and_turned_files(spark, prefix, tmp_path):
    """Old file times, a compressed file, another order of columns, other columns, odd names; nested folders are other sources."""
    src, seen = tmp_path / "b", str(tmp_path / "seen")
    sources = {"b_bz": [str(src)]}

    def run(mode="once", **options):
        return build_bronze(spark, sources, ("a", "b"), mode=mode, prefix=prefix, checkpoint=seen, on_error="report", **options)

    put(src, "one.csv", "a,b\n1,x\n")
    assert run().to_df().count() == 0 and numbers(spark, prefix) == ["1"]
    os.utime(put(src, "late.csv", "a,b\n2,x\n"), (1_000_000_000, 1_000_000_000))
    put(src, "turned [1].csv", "b,a\nx,3\n")
    with gzip.open(src / "z.csv.gz", "wt") as f:
        f.write("a,b\n4,x\n")
    put(src, "sub/nested.csv", "a,b\n9,x\n")
    put(src, "note.txt", "a,b\n9,x\n")
    put(src, "bad.csv", "a,c\n9,x\n")
    report = run()
    assert [(os.path.basename(r.file), r.problem) for r in report.to_df().collect()] == [("bad.csv", "missing b; unexpected c")]
    for _ in range(2):
        assert numbers(spark, prefix) == ["1", "2", "3", "4"]
        run()
    run("replace")
    assert numbers(spark, prefix) == ["1", "2", "3", "4"]


def test_modes_in_every_order(spark, prefix, tmp_path):
    src, seen = tmp_path / "b", str(tmp_path / "seen")
    orders = ("once", "append", "replace", "once"), ("replace", "once", "append", "once")
    for k, order in enumerate(orders):
        table, expected = f"t{k}_bz", []
        for n, mode in enumerate(order):
            put(src, f"{k}/f{n}.csv", f"a\n{n}\n")
            there = [str(i) for i in range(n + 1)]
            build_bronze(spark, {table: str(src / str(k))}, mode=mode, prefix=prefix, checkpoint=seen)
            batched = n > 0 and expected_batched
            if mode == "append":
                expected = sorted(expected + there)
            elif mode == "replace" or not batched:
                expected = there
            else:
                expected = sorted(expected + [x for x in there if x not in expected])
            expected_batched = mode == "once" or (mode == "append" and batched)
            assert numbers(spark, prefix, table) == expected, (order, n)


def test_once_continues_after_a_crash(spark, prefix, tmp_path, monkeypatch):
    """A run that died after writing a batch and before noting its files."""
    from strataflow.sources import loaded

    src, seen = tmp_path / "b", str(tmp_path / "seen")
    for n in range(5):
        put(src, f"f{n}.csv", f"a\n{n}\n")
    note = loaded.note_files

    def dying(spark, paths, seen, batch):
        if batch == 2:
            raise RuntimeError("lost")
        note(spark, paths, seen, batch)

    monkeypatch.setattr(loaded, "note_files", dying)
    name = table_name("bronze", "b_bz", prefix)
    read = lambda paths: spark.read.option("header", True).csv(paths)
    with pytest.raises(RuntimeError, match="lost"):
        loaded.load_new_files(spark, str(src), name, seen, read, files_per_batch=2)
    monkeypatch.setattr(loaded, "note_files", note)
    assert loaded.load_new_files(spark, str(src), name, seen, read, files_per_batch=3) == 3
    assert numbers(spark, prefix) == [str(n) for n in range(5)]


def test_ingest_stage_places_columns_and_reports_others(spark, prefix, tmp_path):
    root = landing(tmp_path / "in")
    turned = ",".join(TELEMETRY_COLUMNS[::-1])
    row = ",".join(PACK.split("\n")[0].split(",")[::-1])
    put(root, "second_life_batteries/battery14.csv", f"{turned}\n{row}\n")
    put(root, "second_life_batteries/other.csv", "x,y\n1,2\n")
    config = telemetry_config(root, prefix=prefix, as_of=AS_OF, ingest=f"{tmp_path}/arrived", checkpoint=f"{tmp_path}/seen")
    with pytest.raises(LayerError, match="other.csv: missing .*; unexpected x, y"):
        run_pipeline(spark, config)
    found = counts(run_pipeline(spark, config))
    assert found == EXPECTED | {("bronze", "second_life"): 6, ("silver", "second_life"): 3} and counts(run_pipeline(spark, config)) == found
    bronze = read_layer(spark, "bronze", "second_life_batteries_bz", prefix).where("battery_number = 'battery14'")
    assert [(r.start_time, r.time, r.mode) for r in bronze.select("start_time", "time", "mode").collect()] == [("01:02:2022 10:00:00", "0.0", " -1 ")]


def test_every_rejected_file_is_reported(spark, prefix, tmp_path):
    put(tmp_path, "b/good.csv", "a,b\n1,2\n")
    for n in range(1001):
        put(tmp_path, f"b/bad{n}.csv", f"a,c{n}\n1,2\n")
    report = build_bronze(spark, {"b_bz": str(tmp_path / "b")}, ("a", "b"), on_error="report", prefix=prefix)
    assert report.to_df().select("file").distinct().count() == 1001
    assert numbers(spark, prefix) == ["1"]


def test_reset_needs_no_database_and_keeps_the_current_one(spark, prefix):
    current = spark.catalog.currentDatabase()
    spark.range(1).createOrReplaceTempView("a_view")
    write_layer(spark.range(1), table_name("gold", "odd_name", prefix))
    assert list_tables(spark, "gold", prefix) == ["odd_name"]
    assert len(reset_layers(spark, prefix)) == 1
    assert list_tables(spark, "gold", prefix) == []
    assert reset_layers(spark, "never_made_") == []
    assert spark.catalog.currentDatabase() == current
    assert spark.table("a_view").count() == 1
    with pytest.raises(ValueError, match="layer"):
        list_tables(spark, "platinum", prefix)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_a_batch_reads_and_moves_little_of_the_old_side(spark, prefix, sf_dir):
    """The old side is the index alone: two longs a row, in the buckets that they are stored in."""
    name = table_name("silver", "lines", prefix)
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumn("load_batch", F.lit(1).cast("bigint"))
    lines.write.partitionBy("load_batch").saveAsTable(name)
    keys = ("l_orderkey", "l_partkey", "l_returnflag")
    index = KeyIndex(name, keys, "load_batch")
    index.add(spark, 1)
    few = lines.where("l_orderkey % 100 = 0").drop("load_batch")
    for partitions in ("8", "3", "50"):  # whatever the session's shuffles are now
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            found = index.found(index.hashed(few), 2)
            text = found._jdf.queryExecution().executedPlan().toString()
            old_side = text[text.index("FileScan parquet spark_catalog") - 400 : text.index("FileScan parquet spark_catalog") + 900]
            assert "ShuffledHashJoin" in text and "Sort " not in text and "Bucketed: true" in old_side
            assert "ReadSchema: struct<key_hash:bigint,key_check:bigint>" in old_side
            join = text[text.index("ShuffledHashJoin") :]
            assert join.index("FileScan parquet spark_catalog") < join.index("Exchange")  # only the batch is dealt
            assert found.count() == few.select(*keys).distinct().count()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert index.without_known(few.withColumn("l_returnflag", F.lit("none")), 2).count() == few.count()
    assert index.without_known(few, 2).count() == 0 and index.without_known(few, 1).count() == few.count()


def test_index_tells_keys_apart(spark, prefix):
    rows = [("a", None, 0.0), (None, "a", 0.0), ("", "a", float("nan")), (None, None, None), ("a", "b", 1.0)]
    frame = spark.createDataFrame(rows, "x string, y string, z double")
    name = table_name("silver", "odd", prefix)
    frame.withColumn("load_batch", F.lit(1).cast("bigint")).write.partitionBy("load_batch").saveAsTable(name)
    index = KeyIndex(name, ("x", "y", "z"), "load_batch")
    index.add(spark, 1)
    assert index.without_known(frame, 2).count() == 0
    other = [("a", None, -0.0), (None, "a", 1.0), ("", "a", 0.0), (None, "", None), ("b", "a", 1.0)]
    assert index.without_known(spark.createDataFrame(other, frame.schema), 2).count() == 4  # both zeros are equal


def test_silver_after_a_crash_before_its_index(spark, prefix, tmp_path, monkeypatch):
    """A batch that was written and not indexed is indexed by the next run; so are tables that have no index yet."""
    from strataflow.sources import keyindex

    root = landing(tmp_path / "in")
    config = telemetry_config(root, prefix=prefix, mode="once", checkpoint=str(tmp_path / "seen"))
    assert counts(run_pipeline(spark, config)) == EXPECTED
    put(root, "second_life_batteries/b.csv", f"{HEADER}\n{PACK}".replace("8.1", "8.2"))
    add = keyindex.KeyIndex.add

    def dying(self, spark, batch):
        if batch == 2:
            raise RuntimeError("lost")
        add(self, spark, batch)

    monkeypatch.setattr(keyindex.KeyIndex, "add", dying)
    with pytest.raises(LayerError, match="lost"):
        run_pipeline(spark, config)
    monkeypatch.setattr(keyindex.KeyIndex, "add", add)
    put(root, "second_life_batteries/c.csv", f"{HEADER}\n{PACK}".replace("8.1", "8.2"))  # as b.csv
    for _ in range(2):
        assert counts(run_pipeline(spark, config))["silver", "second_life"] == 4
    index = KeyIndex(table_name("silver", "second_life_batteries_bz", prefix), TELEMETRY_SPEC.dedup_keys, "load_batch")
    assert index.batches(spark) == {1, 2, 3} and spark.table(index.name).count() == 4
    index.drop(spark)
    put(root, "second_life_batteries/d.csv", f"{HEADER}\n{PACK}".replace("8.1", "8.3"))
    assert counts(run_pipeline(spark, config))["silver", "second_life"] == 5
    assert "second_life_batteries_bz__keys" not in list_tables(spark, "silver", prefix)


def test_a_pack_has_one_name_whether_compressed_or_not(spark, prefix, tmp_path):
    put(tmp_path, "b/one.csv", f"{HEADER}\n{PACK}")
    with gzip.open(tmp_path / "b" / "one.csv.gz", "wt") as f:
        f.write(f"{HEADER}\n{PACK}")
    for every in (False, True):
        build_bronze(spark, {"b_bz": str(tmp_path / "b")}, lineage="pack", prefix=prefix, every_suffix=every)
        rows = read_layer(spark, "bronze", "b_bz", prefix)
        assert {r.pack for r in rows.select("pack").collect()} == {"one"} and rows.count() == 10


def test_rows_are_counted_while_they_are_written(spark, prefix, tmp_path):
    root = landing(tmp_path / "in")
    put(root, "second_life_batteries/more.csv", f"{HEADER}\n{PACK}")
    config = telemetry_config(root, prefix=prefix, as_of=AS_OF)
    reports = []
    run_pipeline(spark, config, reports=reports)
    found = {(r.layer, r.source): r for report in reports for r in report.rows_df().collect()}
    assert set(found) == {(layer, t) for layer in ("bronze", "silver") for t in config.tables.values()} | {("gold", config.gold_table)}
    second = found["silver", "second_life_batteries_bz"]
    # of each file five rows: one rests, one has a bad number, two are equal but for their time
    assert (second.rows_in, second.no_value, second.malformed, second.repeated, second.written) == (10, 2, 2, 5, 3)
    assert found["bronze", "second_life_batteries_bz"].written == 10 and found["gold", config.gold_table].written == 9
    once = telemetry_config(root, prefix=f"{prefix}o_", mode="once", checkpoint=str(tmp_path / "seen"))
    for expected in (10, 0):
        reports = []
        run_pipeline(spark, once, reports=reports)
        rows = {(r.layer, r.source): r.written for report in reports for r in report.rows_df().collect()}
        assert rows.get(("bronze", "second_life_batteries_bz"), 0) == expected
    reset_layers(spark, f"{prefix}o_")


def test_counts_of_folders_without_files(spark, prefix, tmp_path):
    put(tmp_path, "b/one.csv", "a,b\n")
    for mode in ("once", "replace"):
        report = build_bronze(spark, {"b_bz": str(tmp_path / "b")}, ("a", "b"), mode=mode, prefix=prefix, checkpoint=str(tmp_path / "s"), count_rows=True)
        assert [r.written for r in report.rows_df().collect()] == [0]
    (tmp_path / "c").mkdir()
    options = {"mode": "once", "prefix": prefix, "checkpoint": str(tmp_path / "s"), "on_error": "report", "count_rows": True}
    report = build_bronze(spark, {"c_bz": str(tmp_path / "c")}, ("a", "b"), headers="same", **options)
    assert [r.written for r in report.rows_df().collect()] in ([0], [])  # an empty folder has no columns to find
