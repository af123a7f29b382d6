"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints within ``max_bits`` differing bits meet at a variant between them: every
fingerprint emits all variants within half the radius. For an odd radius one of two must go
one bit further. Two fingerprints at an odd distance differ in the parity of their bits, so
only those of even parity emit the outer shell; and as one half of the word holds at
least half (rounded up) of the differing bits, outer variants flip bits of one half only.

All fingerprints that share a variant are linked to the least of those whose variant lies in
the inner ball: that is within the radius for each, and keeps every connection without
making pairs of a group. Two that meet in outer shells only have equal parity, so their
distance is under the radius and they also meet in inner balls. A variant has no more
fingerprints than its ball, whatever the number of copies.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, hidden, written
from strataflow.llm.components import component_roots

SEED = 42


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of UTF-8 text as a signed integer.

    A-Z are lower-cased; words are runs of anything but space and U+0009 to U+000D; a shingle
    is ``shingle`` words joined by a space, repeats included, the whole sequence if there are
    fewer words. A bit is set if it is set in over half of the XXH64 values. No words: 0.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_digest
    if len(words) <= shingle:
        return int.from_bytes(digest(b" ".join(words), SEED), "big", signed=True)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - shingle + 1].tolist()
    stops = ends[shingle - 1 :].tolist()
    counts = np.zeros(64, dtype=np.int64)
    for k in range(0, len(starts), 8192):
        some = b"".join([digest(line[a:b], SEED) for a, b in zip(starts[k : k + 8192], stops[k : k + 8192], strict=True)])
        counts += np.unpackbits(np.frombuffer(some, dtype=np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(starts)).tobytes(), "big", signed=True)


def masks(max_bits: int) -> tuple[list[int], list[int]]:
    """The bits to flip for the inner ball and for the outer shell (none if the radius is even)."""
    inner, outer = max_bits // 2, (max_bits + 1) // 2
    signed = lambda bits: int.from_bytes(sum(1 << b for b in bits).to_bytes(8, "big"), "big", signed=True)
    ball = [signed(c) for r in range(inner + 1) for c in combinations(range(64), r)]
    if outer == inner:
        return ball, []
    return ball, [signed(c) for half in (range(32), range(32, 64)) for c in combinations(half, outer)]


def fingerprint_links(prints: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): links that connect all fingerprints of the column ``fp`` within ``max_bits`` of each other, verified."""
    ball, shell = masks(max_bits)
    all_masks = F.lit(ball + shell)
    numbers = lambda n: F.lit(list(range(n)))
    flips = numbers(len(ball))
    if shell:
        even = F.bit_count("fp") % 2 == 0
        flips = F.when(even, numbers(len(ball) + len(shell))).otherwise(flips)
    into = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # what is shuffled is a variant and the number of its mask; the fingerprint follows from both
    variants = (
        prints.select("fp").distinct().repartition(into, F.xxhash64("fp"))
        .select("fp", F.explode(flips).alias("flip"))
        .select(F.col("fp").bitwiseXOR(F.get(all_masks, F.col("flip"))).alias("variant"), "flip")
        .repartition("variant")
        .withColumn("fp", F.col("variant").bitwiseXOR(F.get(all_masks, F.col("flip"))))
        .withColumn("inner", F.col("flip") < len(ball))
    )
    least = F.min(F.when(F.col("inner"), F.col("fp"))).over(Window.partitionBy("variant"))
    met = variants.select(F.col("fp").alias("a"), least.alias("b")).where("b is not null and a != b").distinct()
    return met.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp) of each row; a null text has no words."""
    narrow = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.col("text").cast("binary").alias("text"))
    compute = lambda texts: [[fingerprint(t, shingle) for t in texts]]
    return add_columns(narrow, ["text"], [("fp", T.LongType())], compute, keep=["doc_id", "text_hash"])


def rooted_fingerprints(docs: DataFrame, shingle: int, max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of the rows, and (of, least, root) of each fingerprint: its least id, and its component's root."""
    prints = written(fingerprints(docs, shingle), "simhash-prints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    roots = component_roots(fingerprint_links(nodes, max_bits))
    root = F.coalesce("root", "fp").alias("root")
    return prints, nodes.join(roots, nodes["fp"] == roots["node"], "left").select(F.col("fp").alias("of"), "least", root)


def near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of ``docs``.

    Needs ``doc_id`` and ``text``; other columns aren't read. ``component_id`` is the smallest
    id that links of at most ``max_bits`` bits reach, the row's own included; null ids come
    last, so it is null only where no id is reachable. Null and empty texts have the
    fingerprint 0, which links like any other. Repeated rows each get their row; an empty
    table gives none.
    """
    prints, rooted = rooted_fingerprints(docs, shingle, max_bits)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = written(rooted.join(named, "root").select("of", "component_id"), "simhash-labels")
    text = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return prints.join(labels, F.col("fp") == F.col("of")).select("doc_id", text, "component_id")


def drop_near_duplicates(docs: DataFrame, *, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """One row of each component, with all its columns: that of the smallest id, null last, then of the least text hash.

    So rows that repeat an id with other texts, and rows without an id, are treated as any others. Of rows with equal id and
    text any one stays. The choice is made of ids and hashes only; texts are joined to it once, unsorted.
    """
    prints, rooted = rooted_fingerprints(docs, shingle, max_bits)
    rows = prints.groupBy("fp", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "n")
    best = rows.join(rooted, F.col("fp") == F.col("of")).groupBy("root").agg(F.min(order).alias("best"))
    best = written(best.select("best.*"), "simhash-kept")
    d, h, n = hidden("id"), hidden("hash"), hidden("n")
    chosen = best.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h), F.col("n").alias(n))
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h))
    kept = docs.join(chosen.hint("shuffle_hash"), same)
    if best.where("n > 1").isEmpty():
        return kept.drop(d, h, n)
    again = kept.where(F.col(n) > 1).dropDuplicates([d, h])
    return kept.where(F.col(n) == 1).unionByName(again).drop(d, h, n)
