"""Landing files: headers, blanks, spaces, lineage, manifest, load-once."""

import gzip
import os
import uuid
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from strataflow.functions import with_file_lineage
from strataflow.sources import (
    landing_columns,
    landing_headers,
    landing_manifest,
    landing_sources,
    pending_files,
    read_landing,
    rejected_files,
    write_landing,
)
from strataflow.streaming import ingest, ingest_once, ingest_rejects, load_table_once


def put(root, name, text):
    path = os.path.join(str(root), name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_blank_is_null_and_spaces_stay(spark, tmp_path):
    put(tmp_path, "a.csv", 'a,b\n1,\n2,"  "\n3,""\n4, x \n')
    rows = {r.a: r.b for r in read_landing(spark, str(tmp_path), ["a", "b"]).collect()}
    assert rows == {"1": None, "2": "  ", "3": None, "4": " x "}


def test_every_column_is_text(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b\n1,2.5\n")
    df = read_landing(spark, str(tmp_path), ["a", "b"])
    assert [t for _, t in df.dtypes] == ["string", "string"]
    assert landing_columns(spark, str(tmp_path)) == ["a", "b"]


def test_other_header_fails_instead_of_swapping(spark, tmp_path):
    put(tmp_path, "a.csv", "a,b\n1,2\n")
    put(tmp_path, "b.csv", "b,a\n2,1\n")
    with pytest.raises(Exception, match="header"):
        read_landing(spark, str(tmp_path), ["a", "b"]).collect()


@pytest.mark.parametrize("broadcast_bytes", [0, 1 << 20])
def test_by_file_places_columns_and_rejects_others(spark, tmp_path, monkeypatch, broadcast_bytes):
    monkeypatch.setattr("strataflow.sources.landing.MAX_BROADCAST_BYTES", broadcast_bytes)
    put(tmp_path, "a.csv", "a,b\n1,2\n3,4\n")
    put(tmp_path, "b.csv", 'b,"a"\n6,5\n')
    put(tmp_path, "few.csv", "a\n9\n")
    put(tmp_path, "more.csv", "a,b,c\n9,9,9\n")
    put(tmp_path, "empty.csv", "a,b\n")
    put(tmp_path, "late.csv", "\n\nb,a\n8,7\n")
    df = read_landing(spark, str(tmp_path), ["a", "b"], headers="by_file", lineage="src")
    assert sorted(tuple(r) for r in df.collect()) == [
        ("1", "2", "a"),
        ("3", "4", "a"),
        ("5", "6", "b"),
        ("7", "8", "late"),
    ]
    bad = {os.path.basename(r.file_path): r.reason for r in rejected_files(spark, str(tmp_path), ["a", "b"]).collect()}
    assert bad == {"few.csv": "missing b", "more.csv": "unexpected c"}


def test_header_is_the_first_line_of_a_split_file(spark, tmp_path):
    put(tmp_path, "big.csv", "a,b\n" + "".join(f"{i},{i * i}\n" for i in range(20000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        assert [r.header for r in landing_headers(spark, str(tmp_path)).collect()] == ["a,b"]
        df = read_landing(spark, str(tmp_path), ["b", "a"], headers="by_file")
        assert df.rdd.getNumPartitions() > 4
        assert df.agg(F.count("a"), F.sum(F.col("a").cast("bigint"))).first()[:] == (20000, 199990000)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("headers", ["same", "by_file"])
def test_lineage_strips_the_suffix_once_and_decodes(spark, tmp_path, headers):
    for name in ("b.csv.01.csv", "x y+z%20.csv", "plain.csv"):
        put(tmp_path, name, "a\n1\n")
    one = read_landing(spark, str(tmp_path), ["a"], headers, lineage="s")
    assert {r.s for r in one.collect()} == {"b.csv.01", "x y+z%20", "plain"}
    every = read_landing(spark, str(tmp_path), ["a"], headers, lineage="s", every=True)
    assert {r.s for r in every.collect()} == {"b.01", "x y+z%20", "plain"}


def test_lineage_on_any_file_scan(spark, sf_dir):
    df = with_file_lineage(spark.read.parquet(f"{sf_dir}/region.parquet"), "s", ".parquet")
    assert {r.s for r in df.collect()} == {"region"}


def test_manifest_lists_without_reading(spark, tmp_path):
    root = tmp_path / "landing"
    put(root, "one/a.csv", "a\n1\n")
    put(root, "one/deep er/b.csv", "a\n1\n")
    put(root, "data/skip.csv", "a\n1\n")
    put(root, "stray.csv", "a\n1\n")
    put(root, "one/note.txt", "x")
    man = landing_manifest(spark, str(root))
    rows = sorted((r.folder, r.table_name, r.file_name, r.source_id, r.bytes) for r in man.collect())
    assert rows == [("deep er", "deep er_bz", "b.csv", "b", 4), ("one", "one_bz", "a.csv", "a", 4)]
    sources = landing_sources(man)
    assert sources == {"deep er_bz": [f"file:{root}/one/deep er"], "one_bz": [f"file:{root}/one"]}
    plan = man._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_pending_files_keeps_null_safe_rest(spark):
    manifest = spark.createDataFrame([("a",), ("b",), (None,)], "path string")
    loaded = spark.createDataFrame([("a",), (None,)], "path string")
    assert [r.path for r in pending_files(manifest, loaded).collect()] == ["b"]


def test_write_landing_keeps_cells(spark, tmp_path):
    cells = [("1", " pad "), ("2", 'say "hi", ok'), ("3", None), ("4", "  ")]
    write_landing(spark.createDataFrame(cells, "a string, b string"), str(tmp_path / "o"))
    back = read_landing(spark, str(tmp_path / "o"), ["a", "b"])
    assert sorted(tuple(r) for r in back.collect()) == cells


def test_write_landing_keeps_rows(spark, tmp_path):
    """Line breaks and rows of one null."""
    texts = ["a\nb", "a\rb", "a\r\nb", 'q"\n"', "plain", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    with pytest.raises(Exception, match="line break"):
        write_landing(df, str(tmp_path / "no"))
    write_landing(df, str(tmp_path / "o"), multi_line=True)
    for headers in ("same", "by_file"):
        back = [r.t for r in read_landing(spark, str(tmp_path / "o"), ["t"], headers, multi_line=True).collect()]
        assert sorted(map(str, back)) == sorted(map(str, texts))
    write_landing(df.where("t is null or t = 'plain'"), str(tmp_path / "one"))
    assert read_landing(spark, str(tmp_path / "one"), ["t"]).count() == 2


def test_small_files_share_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("strataflow.sources.landing.SMALL_FILE_BYTES", 400)
    for i in range(300):
        put(tmp_path, f"f{i:03d}.csv", f"a,b{i % 3}\n{i},1\n")
    for i in range(2):
        put(tmp_path, f"large{i}.csv", f"a,c{i}\n" + "1,2\n" * 200)
    put(tmp_path, "bom.csv", "\ufeffa,d\n1,2\n")
    put(tmp_path, "blank.csv", " \r\n\n  \r" * 5000 + " a,e\r\n1,2\n")
    put(tmp_path, "small_blank.csv", "  \r\n\n \r a,f\r1,2")
    put(tmp_path, "none.csv", " \n  \n")
    put(tmp_path, "empty.csv", "")
    with gzip.open(tmp_path / "packed.csv.gz", "wt") as out:
        out.write('\n"a",g\n1,2\n')
    found = landing_headers(spark, str(tmp_path))
    assert {os.path.basename(r.file_path): r.header for r in found.collect()} == {
        **{f"f{i:03d}.csv": f"a,b{i % 3}" for i in range(300)}, "large0.csv": "a,c0", "large1.csv": "a,c1", "bom.csv": "a,d",
        "blank.csv": " a,e", "small_blank.csv": " a,f", "packed.csv.gz": '"a",g',
    }
    assert [r.names for r in found.where("file_path like '%packed%'").collect()] == [["a", "g"]]
    assert found.rdd.getNumPartitions() < 30  # three large files have a task each


def test_load_once_lists_once(spark, tmp_path, monkeypatch):
    """Batches of a call are taken from one listing; a file that comes meanwhile is the next call's."""
    from strataflow.sources import loaded

    real, listed = loaded.landing_files, []
    monkeypatch.setattr(loaded, "landing_files", lambda *a: listed.append(1) or real(*a))
    for i in range(5):
        put(tmp_path / "in", f"{i} é.csv", f"a,b\n{i},x\n")
    table = f"default.listed_{uuid.uuid4().hex}"
    sizes = []

    def read(paths):
        sizes.append(len(paths))
        if len(sizes) == 1:
            put(tmp_path / "in", "0 late.csv", "a,b\n9,x\n")
        return read_landing(spark, paths, ["a", "b"])

    load = lambda: loaded.load_new_files(spark, str(tmp_path / "in"), table, str(tmp_path / "seen"), read, files_per_batch=2)
    assert (load(), sizes, len(listed)) == (5, [2, 2, 1], 1)
    assert (load(), sizes, len(listed)) == (1, [2, 2, 1, 1], 2) and load() == 0
    assert sorted(r.a for r in spark.table(table).collect()) == ["0", "1", "2", "3", "4", "9"]
    spark.sql(f"DROP TABLE {table}")


def test_headers_need_no_sort_or_shuffle(spark, tmp_path):
    for n in range(5):
        put(tmp_path, f"{n}.csv", "a,b\n" + "1,2\n" * 5000)
    found = landing_headers(spark, str(tmp_path))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert found.count() == 5 and "Sort" not in plan and "Exchange" not in plan
    rows = read_landing(spark, str(tmp_path), ["b", "a"], headers="by_file")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and rows.count() == 25000 and rows.first()[:] == ("2", "1")


def test_ingest_once_loads_each_file_once(spark, tmp_path):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    put(src, "7/a.csv", "a,b\n1,x\n2,y\n")
    put(src, "7/b.csv", "a,b\n3,z\n")

    def run():
        loaded = ingest_once(spark, src, dst, check, ["a", "b"])
        return sorted((r.a, r.b, r.source_id, r.folder) for r in loaded.collect())

    first = [("1", "x", "a", "7"), ("2", "y", "a", "7"), ("3", "z", "b", "7")]
    assert run() == first
    assert run() == first
    put(src, "8/a.csv", "a,b\n4,w\n")
    assert run() == [*first, ("4", "w", "a", "8")]


@pytest.mark.parametrize("into", ["path", "table"])
def test_load_continues_after_a_crash_without_loading_twice(spark, tmp_path, into):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    columns = ["a", "b"]
    table = f"default.loaded_{uuid.uuid4().hex}"
    for i, name in enumerate("abc"):
        path = put(src, f"7/{name}.csv", f"{'x,y' if name == 'c' else 'a,b'}\n{i},{name}\n")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))

    def run():
        if into == "path":
            loaded = ingest_once(spark, src, dst, check, columns, files_per_batch=1)
        else:
            loaded = load_table_once(spark, f"{src}/7", table, check, columns, files_per_batch=1)
        return sorted((r.a, r.b, r.source_id) for r in loaded.collect())

    with pytest.raises(Exception, match="c.csv"):
        run()
    put(src, "7/c.csv", "a,b\n2,c\n")
    expected = [("0", "a", "a"), ("1", "b", "b"), ("2", "c", "c")]
    assert run() == expected
    assert run() == expected
    spark.sql(f"DROP TABLE IF EXISTS {table}")


@pytest.mark.parametrize("lost", ["before the rows", "after the rows"])
def test_ingest_places_columns_by_header_across_a_crash(spark, tmp_path, monkeypatch, lost):
    src, dst, check = (str(tmp_path / d) for d in ("src", "dst", "check"))
    for i, (name, text) in enumerate({"a": "a,b\n1,x\n", "b é": "b,a\ny,2\n", "few": "a\n9\n", "c": "\nb,a\n,3\nw,\n", "none": "a,b\n"}.items()):
        path = put(src, f"7/{name}.csv", text)
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
    told = []

    def run():
        loaded = ingest_once(
            spark, src, dst, check, ["a", "b"], files_per_batch=1, headers="by_file", on_rejects=lambda bad: told.extend(bad.collect())
        )
        return sorted((r.a or "", r.b or "", r.source_id, r.folder) for r in loaded.collect())

    real = ingest.read_by_header
    count = []

    def read(*args, **kwargs):
        count.append(1)
        if len(count) == 4 and lost == "before the rows":
            raise RuntimeError("lost here")
        return real(*args, **kwargs)

    output = ingest._output

    @contextmanager
    def leave(session):
        with output(session):
            yield
        if len(count) == 4 and lost == "after the rows":
            raise RuntimeError("lost here")

    monkeypatch.setattr(ingest, "read_by_header", read)
    monkeypatch.setattr(ingest, "_output", leave)
    with pytest.raises(Exception, match="lost here"):
        run()
    count.extend([1] * 10)
    first = [("", "w", "c", "7"), ("1", "x", "a", "7"), ("2", "y", "b é", "7"), ("3", "", "c", "7")]
    assert run() == first
    assert run() == first
    rejects = ingest_rejects(spark, dst).collect()
    assert [(os.path.basename(r.file_path), r.header, r.reason) for r in rejects] == [("few.csv", "a", "missing b")]
    put(src, "8/mended.csv", "b,a\nz,9\n")
    put(src, "8/odd.csv", "a,b,c\n1,2,3\n")
    assert run() == [*first, ("9", "z", "mended", "8")]
    assert [(os.path.basename(r.file_path), r.reason) for r in told] == [("odd.csv", "unexpected c")]
    assert ingest_rejects(spark, dst).count() == 2


def test_ingest_by_header_of_nothing(spark, tmp_path):
    os.makedirs(tmp_path / "src")
    load = lambda: ingest_once(spark, str(tmp_path / "src"), str(tmp_path / "dst"), str(tmp_path / "seen"), ["a"], headers="by_file")
    assert load().columns == ["a", "source_id", "folder"] and load().count() == 0 and ingest_rejects(spark, str(tmp_path / "dst")).count() == 0
    with gzip.open(tmp_path / "src" / "z.csv.gz", "wt") as f:
        f.write("a\n5\n")
    assert [tuple(r) for r in load().collect()] == [("5", "z", "src")]
