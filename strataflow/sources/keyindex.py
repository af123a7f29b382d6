"""An index of the keys that a load-once table has, so that a new batch needn't read the table.

The index is a bucketed table of 128-bit key hashes, with a partition for each batch. A batch is dealt to the
same buckets and held in memory bucket by bucket, while the index streams past it: the old side is neither shuffled nor
sorted, and of each old row 16 bytes are read. What is found is at most as large as the batch.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = "__keys"
MAX_BUCKETS = 4096
_HASHES = ("key_hash", "key_check")
_SALT = "another 64 bits"


@dataclass(frozen=True)
class KeyIndex:
    """Of ``table``, for rows that are equal in ``keys`` (nulls and NaN equal themselves, both zeros each other)."""

    table: str
    keys: Sequence[str]
    batch: str

    @property
    def name(self) -> str:
        return f"{self.table[:-1]}{KEYS}`" if self.table.endswith("`") else f"{self.table}{KEYS}"

    def hashed(self, rows: DataFrame) -> DataFrame:
        """``rows`` with the two hashes. Which keys are null is hashed too, as Spark's hash passes over nulls."""
        keys = [F.col(f"`{k}`") for k in self.keys]
        nulls = F.concat(F.lit(""), *(F.when(k.isNull(), "1").otherwise("0") for k in keys))
        first, second = F.xxhash64(*keys, nulls), F.xxhash64(F.lit(_SALT), nulls, *reversed(keys))
        return rows.withColumns(dict(zip(_HASHES, (first, second), strict=True)))

    def make(self, spark: SparkSession) -> None:
        """The index, empty if it isn't there; it has as many buckets as a shuffle has partitions now."""
        buckets = min(int(spark.conf.get("spark.sql.shuffle.partitions")), MAX_BUCKETS)
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({_HASHES[0]} BIGINT, {_HASHES[1]} BIGINT, {self.batch} BIGINT) USING parquet "
            f"PARTITIONED BY ({self.batch}) CLUSTERED BY ({', '.join(_HASHES)}) INTO {buckets} BUCKETS"
        )

    def drop(self, spark: SparkSession) -> None:
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def batches(self, spark: SparkSession) -> set[int]:
        """The batches that are indexed; a row for each load, whatever its size."""
        if not spark.catalog.tableExists(self.name):
            return set()
        return {int(r[0].rpartition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {self.name}").collect()}

    def add(self, spark: SparkSession, batch: int) -> None:
        """Indexes a batch of the table as it is there, or indexes it again."""
        self.make(spark)
        rows = spark.table(self.table).where(F.col(self.batch) == batch).select([F.col(f"`{k}`") for k in self.keys])
        hashes = self.hashed(rows).select(*_HASHES)
        view = f"keys_{uuid.uuid4().hex}"
        hashes.repartition(self._buckets(spark), *_HASHES).createOrReplaceTempView(view)
        try:
            spark.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({self.batch} = {batch}) SELECT * FROM {view}")
        finally:
            spark.catalog.dropTempView(view)

    def _buckets(self, spark: SparkSession) -> int:
        shown = spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").where("col_name = 'Num Buckets'").first()
        return int(shown["data_type"])

    def found(self, hashes: DataFrame, batch: int) -> DataFrame:
        """The hashes among ``hashes`` that other batches have."""
        spark = hashes.sparkSession
        self.make(spark)
        old = spark.table(self.name).where(F.col(self.batch) != batch).select(*_HASHES)
        mine = hashes.select(*_HASHES).repartition(self._buckets(spark), *_HASHES)  # dealt as the buckets are
        return old.join(mine.hint("shuffle_hash"), list(_HASHES), "left_semi").distinct()

    def without_known(self, rows: DataFrame, batch: int) -> DataFrame:
        """The rows whose keys no other batch has; ``rows`` is read twice, so it should be stored."""
        hashed = self.hashed(rows)
        known = self.found(hashed, batch)
        return hashed.join(known, list(_HASHES), "left_anti").select([F.col(f"`{c}`") for c in rows.columns])
