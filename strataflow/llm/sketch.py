"""Document fingerprints by a threshold-scaled sketch.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Sketches of the
same fraction merge by union, and the share of one that lies in another estimates
containment, whatever the lengths. Beside it stand the number of different shingles and the least
hash, so that texts too short to keep a hash stay comparable.

A fingerprint is written ``number:least:hashes``, hashes as 16 hexadecimal digits each, rising.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from strataflow.llm.common import add_columns, hidden, ship_package, written

SHINGLE = 5
FRACTION = 1 / 8
SEED = 11


@dataclass(frozen=True)
class Sketch:
    number: int
    least: int
    kept: np.ndarray  # rising, of unsigned 64-bit hashes

    def __str__(self) -> str:
        return f"{self.number}:{self.least:016x}:{self.kept.astype('>u8').tobytes().hex()}"

    @classmethod
    def read(cls, fingerprint: str) -> Sketch:
        number, least, kept = fingerprint.split(":")
        return cls(int(number), int(least, 16), np.frombuffer(bytes.fromhex(kept), dtype=">u8").astype(np.uint64))

    def merge(self, other: Sketch) -> Sketch:
        """The sketch of both texts together; ``number`` is then estimated from what is kept in common."""
        kept = np.union1d(self.kept, other.kept)
        both = len(self.kept) + len(other.kept)
        number = round((self.number + other.number) * len(kept) / both) if both else max(self.number, other.number)
        full = [s.least for s in (self, other) if s.number]
        return Sketch(number, min(full, default=0), kept)

    def sample(self) -> np.ndarray:
        """What stands for the text: the kept hashes, or the least one if none is kept."""
        return self.kept if len(self.kept) or not self.number else np.array([self.least], dtype=np.uint64)


def sketch(text: str | None, shingle: int = SHINGLE, fraction: float = FRACTION) -> Sketch:
    """Of a whole text. Words are split at ASCII white space, A-Z lower-cased; a text of fewer words is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return Sketch(0, 0, np.zeros(0, dtype=np.uint64))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: max(1, len(words) - shingle + 1)].tolist()
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    value = xxhash.xxh64_intdigest
    hashes = np.unique(np.array([value(line[a:b], SEED) for a, b in zip(starts, stops, strict=True)], dtype=np.uint64))
    return Sketch(len(hashes), int(hashes[0]), hashes[: np.searchsorted(hashes, np.uint64(int(fraction * 2**64)))])


def containment(a: Sketch, b: Sketch) -> float:
    """Share of the smaller text's shingles that the larger has; 1 if neither has words, 0 if one hasn't."""
    if not a.number or not b.number:
        return float(a.number == b.number)
    x, y = a.sample(), b.sample()
    if not len(a.kept) or not len(b.kept):  # a least hash alone: does the other's least one, or sketch, have it?
        x, y = (x, np.append(y, np.uint64(b.least))) if not len(a.kept) else (y, np.append(x, np.uint64(a.least)))
        return float(np.isin(x, y).mean())
    return len(np.intersect1d(x, y, assume_unique=True)) / min(len(x), len(y))


def resemblance(a: Sketch, b: Sketch) -> float:
    """Share of the shingles of both texts that are common to them."""
    if not a.number or not b.number:
        return float(a.number == b.number)
    x, y = a.sample(), b.sample()
    return len(np.intersect1d(x, y, assume_unique=True)) / len(np.union1d(x, y))


def edited(text: str | None, following: str | None) -> str:
    """The last third of the code points replaced by the first as many (or all) of ``following``."""
    text = text or ""
    k = len(text) // 3
    return text[: len(text) - k] + (following or "")[:k]


def chained(docs: DataFrame, partitions: int | None = None) -> tuple[DataFrame, str, str, str]:
    """Rows dealt into ranges of falling ids and sorted, each range ending with the first row of the next as a guest.

    So whoever reads a partition in order sees for every row the one that follows it in the whole
    table. The last range's guest is the first row of all. Equal ids are ordered by a hash of the
    text, then the text; null ids come last. Ranges are cut by id and hash, so rows of one id, or without any, are
    many ranges too; only rows of one id and one text stay together. Ids and hashes are written once and read to find the ranges'
    borders, which are bounded by the number of partitions. Texts are shuffled once.
    """
    spark = docs.sparkSession
    into = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = 4 * into  # several ranges for each partition even out their sizes
    part, guest, tie = hidden("part"), hidden("guest"), hidden("tie")
    # rises in the order of the chain; the complement of an id falls as its negative does, without overflow
    falling = F.coalesce(F.bitwise_not(F.col("doc_id").cast("long")), F.lit(0))
    hashed = F.xxhash64(F.coalesce("text", F.lit("")))
    keys = docs.select(F.col("doc_id").isNull().cast("long").alias("none"), falling.alias("i"), hashed.alias("t"))
    keys, key = written(keys, "sketch-keys"), ["none", "i", "t"]
    # Spark's own range partitioning gives the borders: a row for each range
    ranges = keys.repartitionByRange(n, *key).groupBy(F.spark_partition_id().alias("r"))
    lows = sorted(tuple(r["low"]) for r in ranges.agg(F.min(F.struct(*key)).alias("low")).collect())
    cuts = np.array(lows[1:], dtype=np.int64).reshape(-1, 3)

    @F.pandas_udf(T.IntegerType())
    def place(none: pd.Series, i: pd.Series, t: pd.Series) -> pd.Series:
        low, high = np.zeros(len(i), dtype=np.int64), np.full(len(i), len(cuts))
        while (low < high).any():  # how many cuts are not over the key
            middle = (low + high) // 2
            c, over = cuts[np.minimum(middle, max(len(cuts) - 1, 0))], np.zeros(len(i), dtype=bool)
            for k, mine in enumerate((t, i, none)):  # the later decides
                mine = mine.to_numpy()
                over = (c[:, 2 - k] > mine) | ((c[:, 2 - k] == mine) & over)
            open_, right = low < high, ~over
            low, high = np.where(open_ & right, middle + 1, low), np.where(open_ & over, middle, high)
        return pd.Series(low).astype("int32")

    first = F.min(F.struct(*key)).alias("f")
    heads = written(keys.groupBy(place(*key).alias("p")).agg(first), "sketch-heads")
    before = Window.orderBy("p")  # a row for each range
    last = heads.agg(F.max("p")).first()[0] or 0
    to = heads.withColumn("to", F.coalesce(F.lag("p").over(before), F.lit(last))).select("p", "f", "to")
    none = F.col("doc_id").isNull().cast("long")
    dealt = docs.withColumn(tie, hashed).withColumn(part, place(none, falling, F.col(tie)))
    guests = (
        dealt.join(F.broadcast(to), F.col(part) == F.col("p"))
        .where((F.col("f.none") == none) & (F.col("f.i") == falling) & (F.col("f.t") == F.col(tie)))
        .dropDuplicates(["p"])
        .select(*(F.col(f"`{c}`") for c in docs.columns), tie, F.col("to").alias(part), F.lit(True).alias(guest))
    )
    rows = dealt.withColumn(guest, F.lit(False)).unionByName(guests)
    order = [F.col("doc_id").desc_nulls_last(), F.col(tie), F.col("text")]
    chain = rows.repartition(into, part).sortWithinPartitions(part, guest, *order)
    return chain, part, guest, tie


def fingerprint_documents(docs: DataFrame, *, shingle: int = SHINGLE, fraction: float = FRACTION, partitions: int | None = None) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next and resemblances).

    Needs ``doc_id`` and ``text``; other columns aren't read. The next document is the one with the
    next smaller id; repeated rows and equal ids follow each other, null ids come last, and the
    first row follows the last; a single row follows itself. Null texts count as empty.
    ``near_*`` are containments of the smaller in the larger, ``alike_*`` resemblances.
    """
    ship_package(docs.sparkSession)
    source = docs.select("doc_id", "text")
    placed, part, guest, _ = chained(source, partitions)
    schema = T.StructType(
        [source.schema["doc_id"], T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next", "alike_edited", "alike_next")]
    )
    types = [to_arrow_type(f.dataType) for f in schema.fields]

    def row(doc_id, text: str, mine: Sketch, following: str, theirs: Sketch) -> tuple:
        new = edited(text, following)
        changed = sketch(new, shingle, fraction)
        sha = sha256(new.encode("utf-8", "surrogatepass")).hexdigest()
        near = containment(mine, changed), containment(mine, theirs), resemblance(mine, changed), resemblance(mine, theirs)
        return (doc_id, len(text), sha, str(mine), str(changed), *near)

    def read(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            yield from zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out, size = None, [], 0
        for p, is_guest, doc_id, text in read(batches):
            text = text or ""
            print_of = sketch(text, shingle, fraction)
            if held and held[0] == p:
                out.append(row(*held[1:], text, print_of))
                size += len(text)
            held = None if is_guest else (p, doc_id, text, print_of)
            if size > 4_000_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)
                out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=schema.names)

    return placed.select(part, guest, "doc_id", "text").mapInArrow(run, schema)


def sketch_column(docs: DataFrame, name: str = "fingerprint", *, shingle: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """``docs`` with the fingerprint of each whole text."""
    return add_columns(docs, ["text"], [(name, T.StringType())], lambda texts: [[str(sketch(t, shingle, fraction)) for t in texts]])
