"""Layer databases and managed tables."""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from strataflow.sources.keyindex import KEYS

# The layers, each kept in a database of this name.
LAYERS = ("bronze", "silver", "gold")
LAYER_SUFFIX = "_layer"
ASIDE = "__aside_"
POINTER, NEXT = "strataflow.pointer", "strataflow.next"
LOAD_COMMIT = "load_commit"


def quoted(*parts: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in parts)


def layer_database(layer: str, prefix: str = "") -> str:
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    return f"{prefix}{layer}{LAYER_SUFFIX}"


def ensure_layers(spark: SparkSession, prefix: str = "", location: str | None = None) -> list[str]:
    """Create the layer databases that are missing, below ``location`` if given.

    The session's current database stays as it is.
    """
    names = [layer_database(layer, prefix) for layer in LAYERS]
    root = location.rstrip("/").replace("'", "\\'") if location else None
    for name in names:
        where = f" LOCATION '{root}/{name}.db'" if root else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name)}{where}")
    return names


def _all_tables(spark: SparkSession, layer: str, prefix: str) -> list[str]:
    name = layer_database(layer, prefix)
    if not spark.catalog.databaseExists(quoted(name)):
        return []
    shown = spark.sql(f"SHOW TABLES IN {quoted(name)}").where("NOT isTemporary")
    return sorted(row["tableName"] for row in shown.collect())


def list_tables(spark: SparkSession, layer: str, prefix: str = "", unfinished: bool = False) -> list[str]:
    """Table names of a layer, sorted; none if its database is missing.

    ``unfinished`` adds tables that a lost driver was writing in order to replace another. Those that hold a table's
    contents, and indexes of keys, are never listed.
    """
    there = _all_tables(spark, layer, prefix)
    names = [t for t in there if not _helper(t)]
    if not unfinished:
        return names
    place = {t: _Described.of(spark, table_name(layer, t, prefix)).location for t in there if ASIDE in t or any(x.startswith(t + ASIDE) for x in there)}
    return sorted([*names, *(t for t in there if ASIDE in t and place.get(t.partition(ASIDE)[0]) != place[t])])


def _helper(table: str) -> bool:
    return ASIDE in table or table.endswith(KEYS)


def reset_layers(spark: SparkSession, prefix: str = "", layers: Sequence[str] = LAYERS) -> list[str]:
    """Drop every table of the layers and return their names; missing databases are fine."""
    dropped = []
    for layer in layers:
        for table in _all_tables(spark, layer, prefix):
            name = quoted(layer_database(layer, prefix), table)
            spark.sql(f"DROP TABLE IF EXISTS {name}")
            if not _helper(table):
                dropped.append(name)
    return dropped


def table_name(layer: str, table: str, prefix: str = "") -> str:
    return quoted(layer_database(layer, prefix), table)


def read_layer(spark: SparkSession, layer: str, table: str, prefix: str = "") -> DataFrame:
    name = table_name(layer, table, prefix)
    recover_table(spark, name)
    return spark.table(name)


def _parts(spark: SparkSession, name: str) -> tuple[str, str]:
    """Quoted database and bare name of a table."""
    found = [a or b for a, b in re.findall(r"`((?:[^`]|``)*)`|([^`.]+)", name)]
    bare = [part.replace("``", "`") for part in found]
    return quoted(bare[-2] if len(bare) > 1 else spark.catalog.currentDatabase()), bare[-1]


@dataclass(frozen=True)
class _Described:
    """What the catalog says of a table; asked for in one statement that runs no job."""

    columns: tuple[tuple[str, str], ...]
    partitions: tuple[str, ...]
    location: str
    properties: str

    @classmethod
    def of(cls, spark: SparkSession, name: str) -> _Described:
        rows = [(r["col_name"], r["data_type"]) for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()]
        ends = [i for i, (c, _) in enumerate(rows) if c == "" or c.startswith("# ")]
        columns = tuple(rows[: ends[0] if ends else len(rows)])
        at = next((i for i, (c, _) in enumerate(rows) if c == "# Partition Information"), None)
        partitions = itertools.takewhile(lambda r: r[0] and not r[0].startswith("# "), rows[at + 2 :]) if at is not None else ()
        details = dict(rows[ends[-1] :]) if ends else {}
        return cls(columns, tuple(c for c, _ in partitions), details.get("Location", ""), details.get("Table Properties", ""))

    def has(self, key: str) -> bool:
        return f"{key}=" in self.properties

    @property
    def shape(self) -> tuple:
        return self.columns, self.partitions

    @property
    def place(self) -> str:
        return self.location.replace("'", "\\'")


def _versions(spark: SparkSession, name: str) -> list[str]:
    """The tables that hold a table's contents, old, new or unfinished."""
    database, bare = _parts(spark, name)
    shown = [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()]
    return [f"{database}.{quoted(t)}" for t in shown if t.startswith(f"{bare}{ASIDE}".lower())]


def _make_pointer(spark: SparkSession, name: str, version: _Described) -> None:
    """A table that has its rows, and finds its partitions, where ``version`` has them."""
    fields = ", ".join(f"{quoted(c)} {kind}" for c, kind in version.columns)
    by = f"PARTITIONED BY ({', '.join(map(quoted, version.partitions))})" if version.partitions else ""
    maker = spark.newSession()  # this setting is for this table only: its partitions are those of the folder
    maker.conf.set("spark.sql.hive.manageFilesourcePartitions", "false")
    database, bare = _parts(spark, name)
    table = f"{database}.{quoted(bare)}"
    maker.sql(f"CREATE TABLE {table} ({fields}) USING parquet {by} LOCATION '{version.place}' TBLPROPERTIES ('{POINTER}' = 'true')")
    spark.sql(f"REFRESH TABLE {table}")


def recover_table(spark: SparkSession, name: str) -> None:
    """Finishes the replacement of a table whose driver was lost after it gave up the old one; nothing to do otherwise."""
    if not spark.catalog.tableExists(name):
        for version in _versions(spark, name):
            described = _Described.of(spark, version)
            if described.has(NEXT):
                _make_pointer(spark, name, described)
                spark.sql(f"ALTER TABLE {version} UNSET TBLPROPERTIES IF EXISTS ('{NEXT}')")
                return


def drop_versions(spark: SparkSession, name: str, keep: str | None = None) -> None:
    """Drops contents that a table no longer has, or that were never finished."""
    kept = _parts(spark, keep)[1].lower() if keep else None
    for version in _versions(spark, name):
        if _parts(spark, version)[1].lower() != kept:
            spark.sql(f"DROP TABLE IF EXISTS {version}")


def _replace(df: DataFrame, name: str, partition_by: Sequence[str]) -> None:
    spark = df.sparkSession
    recover_table(spark, name)
    database, bare = _parts(spark, name)
    version = f"{database}.{quoted(f'{bare}{ASIDE}{uuid.uuid4().hex[:12]}')}"
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).saveAsTable(version)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    new = _Described.of(spark, version)
    old = _Described.of(spark, name) if spark.catalog.tableExists(name) else None
    if old and old.has(POINTER) and old.shape == new.shape:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{new.place}'")
        spark.sql(f"REFRESH TABLE {name}")
    else:
        # other columns can't be pointed at: from here on the next run would finish
        spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{NEXT}' = 'true')")
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        _make_pointer(spark, name, new)
        spark.sql(f"ALTER TABLE {version} UNSET TBLPROPERTIES IF EXISTS ('{NEXT}')")
    drop_versions(spark, name, keep=version)


def _append_commit(df: DataFrame, name: str, commit: str) -> None:
    """The rows as the partition of their commit, whole or not at all; the same commit again replaces its rows."""
    spark, view = df.sparkSession, f"commit_{uuid.uuid4().hex}"
    recover_table(spark, name)
    if LOAD_COMMIT in df.columns:
        raise ValueError(f"{LOAD_COMMIT} is the column of the commits")
    if not spark.catalog.tableExists(name):
        fields = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in df.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({fields}, {LOAD_COMMIT} STRING) USING parquet PARTITIONED BY ({LOAD_COMMIT})")
    columns = spark.table(name).columns
    if LOAD_COMMIT not in columns or _Described.of(spark, name).has(POINTER):
        raise ValueError(f"{name} was made without commits; only tables that began with one take more")
    label = commit.replace("\\", "\\\\").replace("'", "\\'")
    df.createOrReplaceTempView(view)
    try:
        rows = f"SELECT {', '.join(quoted(c) for c in columns if c != LOAD_COMMIT)} FROM {view}"
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD_COMMIT} = '{label}') {rows}")
    finally:
        spark.catalog.dropTempView(view)


def write_layer(
    df: DataFrame, name: str, mode: str = "replace", partition_by: Sequence[str] = (), commit: str | None = None
) -> None:
    """Write a table. ``replace`` is repeatable, ``append`` adds rows by column name.

    A table that is replaced points to its contents, which are a table of their own beside it: the new rows are written
    there once, partitioned or not, and then one change of the location in the catalog makes them the table's. So a
    driver or a write that is lost at any step leaves the old rows or the new ones, readers find one or the other, and a
    frame may read the table that it replaces. Only if the columns change, or the table wasn't written
    like this before, must it be dropped and made anew; the new contents carry a note
    by then, from which the next write or :func:`read_layer` finishes. Old contents are dropped afterwards.

    ``append`` adds rows twice if it is repeated, unless ``commit`` names the load: its rows are then one
    partition of the column ``load_commit``, which the same load replaces if it is repeated.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"mode must be 'replace' or 'append', not {mode!r}")
    if mode == "replace":
        _replace(df, name, partition_by)
    elif commit is not None:
        if partition_by:
            raise ValueError("a table of commits has no other partitions")
        _append_commit(df, name, commit)
    else:
        recover_table(df.sparkSession, name)
        writer = df.write.mode("append")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)
