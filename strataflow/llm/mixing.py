"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only.

Every document of a source is due ``target / source size`` copies. The whole part is given;
the fractions are rounded by the pivotal method: two documents meet, probability moves
from one to the other at random (keeping both expectations and the sum of
``size * probability``) until one of them is 0 or 1. That one is settled, the other meets
the next. So the words taken of a source miss its target by less than the size of the one
document that is left over at the end; as large documents meet first, that is a small one. Every document gets the
floor or the ceiling of its rate.

The meetings form a tree: each level deals the unsettled documents of a source into blocks of
about ``FAN_IN`` by a hash, settles all but one in each block, and writes its result. A
source with a third of all rows is many blocks; the number of levels is the logarithm of the
largest source.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strataflow.llm.common import hidden, without, written

FAN_IN = 32
RESULT = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    """Runs of anything but space and U+0009 to U+000D; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), max_copies: float = 3.0) -> DataFrame:
    """(source, source_size, n_docs, target): ``weights`` repeat over the sources by code point, null last.

    The targets share the sum of all sizes by weight; none is above ``max_copies`` times its
    source, and what that cuts off is shared by weight among the others until none is above.
    A level of sharing is one aggregate over one row for each source.
    """
    sources = written(
        sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs")), "mix-sources"
    )
    ranked = written(_ranked(sources).withColumn("weight", _weight(F.col("rank"), weights)), "mix-ranks")
    cap = F.col("source_size") * F.lit(float(max_copies))
    level = F.lit(None).cast("double")
    due, cut = None, -1
    while True:
        above = F.coalesce(F.col("weight") * level >= cap, F.lit(False))
        now = ranked.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(above, cap)).alias("capped"),
            F.sum(F.when(~above, F.col("weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("n"),
        ).first()
        if now["n"] == cut or not now["open"]:
            break
        cut, due = now["n"], ((now["all"] or 0) - (now["capped"] or 0.0)) / now["open"]
        level = F.lit(due)
    share = F.when(F.coalesce(F.col("weight") * level >= cap, F.lit(False)), cap).otherwise(F.col("weight") * level)
    return ranked.select("source", "source_size", "n_docs", F.coalesce(share, F.lit(0.0)).alias("target"))


def _ranked(sources: DataFrame) -> DataFrame:
    """``rank`` from 0 by code point, null last: ranges are ranked side by side, each after the rows of those before."""
    order = [F.col("source").asc_nulls_last()]
    parts = written(sources.repartitionByRange(8, *order).withColumn("part", F.spark_partition_id()), "mix-ranges")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.groupBy("part").agg(F.count(F.lit(1)).alias("rows")).select(  # 8 rows
        "part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset")
    )
    within = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return parts.withColumn("within", within).join(F.broadcast(offsets), "part").select(
        "source", "source_size", "n_docs", (F.col("offset") + F.col("within")).alias("rank")
    )


def _weight(rank: Column, weights: Sequence[float]) -> Column:
    return F.element_at(F.lit([float(w) for w in weights]), (rank % len(weights) + 1).cast("int"))


def copies(docs: DataFrame, *, weights: Sequence[float] = (1, 2, 3), max_copies: float = 3.0, seed: int = 7) -> DataFrame:
    """(doc_id, rep, source, size, source_size, target, copies, taken) for each row of ``docs``.

    Needs ``doc_id``, ``source`` and ``text``; other columns aren't read. Rows that share id,
    source and size are told apart by ``rep``, 1 and up. A null text has size 0; documents of
    size 0 get the whole copies and, by chance, one more, and take 0 words. A null source is a
    source. An empty table gives no rows. Reruns give the same: chance is a hash of id and seed.
    """
    key = ["doc_id", "source", "size"]
    rows = docs.select(F.col("doc_id"), F.col("source"), word_count(F.col("text")).alias("size"))
    sizes = written(rows.withColumn("rep", F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(1)))), "mix-sizes")
    targets = written(source_targets(sizes, weights, max_copies), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    t = targets.withColumnRenamed("source", "of")
    due = (
        sizes.join(t, F.col("source").eqNullSafe(F.col("of")))  # one row for each source: Spark broadcasts it if small
        .withColumn("rate", rate)
        .withColumn("whole", F.floor("rate").cast("int"))
        .withColumn("p", F.col("rate") - F.col("whole"))
        .select(*key, "rep", "source_size", "n_docs", "target", "whole", "p")
    )
    fractional = (F.col("size") > 0) & (F.col("p") > 0)
    due = due.withColumn("shift", F.lit(0))
    settled = [due.where(~fractional).select(*key, "rep", _by_chance(seed, -1))]
    rank = F.struct("size", F.xxhash64(F.lit(seed), F.col("doc_id").cast("string"), F.col("rep")).alias("h"), "rep")
    open_rows = due.where(fractional).select(*key, "rep", "p", "shift", "n_docs", "source_size", "target", "whole", rank.alias("order"))
    heavy, after = _heaviest(open_rows, seed)
    settled.append(heavy)
    open_rows = (
        open_rows.drop("p", "shift")
        .join(after.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .where(F.col("order") < F.col("cut"))
        .select(*key, "rep", "p", "shift", "n_docs")
    )
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    level = 0
    while True:
        blocks = F.ceil(F.col("n_docs") / F.lit(float(FAN_IN ** (level + 1)))).cast("long")
        result = written(_meet(open_rows, seed, level, blocks), f"mix-level-{level}")
        settled.append(result.select(F.inline("done")))
        open_rows = result.where(F.col("left.p").isNotNull()).select("left.*")
        if most <= FAN_IN ** (level + 1):
            break
        level += 1
    settled.append(open_rows.select(*key, "rep", _by_chance(seed, -2)))
    extra = reduce(DataFrame.unionByName, settled).select(*(F.col(c).alias(f"x_{c}") for c in [*key, "rep"]), "extra")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"x_{c}")) for c in [*key, "rep"]))
    n = F.col("whole") + F.col("extra")
    return due.join(extra, same).select(
        "doc_id", "rep", "source", "size", "source_size", "target", n.alias("copies"), (F.col("size") * n).alias("taken")
    )


def _uniform(seed: int, level: int) -> Column:
    """0 to 1, by a hash of the document."""
    at = F.xxhash64(F.col("doc_id").cast("string"), F.col("source"), F.col("size"), F.col("rep"), F.lit(seed), F.lit(level))
    return F.pmod(at, F.lit(1 << 52)) / F.lit(float(1 << 52))


def _by_chance(seed: int, level: int) -> Column:
    return (F.col("shift") + F.when(_uniform(seed, level) < F.col("p"), 1).otherwise(0)).alias("extra")


def _heaviest(open_rows: DataFrame, seed: int) -> tuple[DataFrame, DataFrame]:
    """Settles the ``FAN_IN`` largest documents of each source first, each against all that come after it.

    A document may be too large for the few it meets in the tree to balance it. So the largest meet, one after the
    other, all smaller documents of the source as one partner: the document gets its floor or ceiling at random, and
    the others take the difference, each within the same floor and ceiling. Where they are too few for one of the two, the
    other is taken, and where they are too few for both, the one that misses less; only there are expectations not
    kept. Returns what is settled, and for each source (source, p, shift, cut): the fraction that all documents of an
    ``order`` under ``cut`` are due from then on, and by how many whole copies more than before.
    """
    key = ["doc_id", "source", "size", "rep"]
    by_size = Window.partitionBy("source").orderBy(F.desc("order"))  # limited in each task before the shuffle
    heavy = open_rows.withColumn("k", F.row_number().over(by_size)).where(F.col("k") <= FAN_IN)
    pools = heavy.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("k", _uniform(seed, -3).alias("u"), *(c for c in key if c != "source"), "whole"))).alias("es"),
        F.min("order").alias("cut"), F.first("whole").alias("whole"),
        F.first(F.struct(F.col("target").alias("due"), F.col("source_size").cast("double").alias("pool"))).alias("start"),
    )
    done_type = f"array<struct<doc_id:{dict(open_rows.dtypes)['doc_id']},size:bigint,rep:int,extra:int>>"
    def more(acc: Column, x: Column) -> Column:
        """Whether ``x`` gets one more than the whole copies; the others' share of what is due then is 0 to ``others``."""
        extra, others = acc["due"] - x["whole"] * acc["pool"], acc["pool"] - x["size"]
        short, over = x["size"] - extra, extra - others  # if it does, if it doesn't
        by_chance = x["u"] * acc["pool"] < extra
        return F.when((short <= 0) & (over <= 0), by_chance).when((short > 0) & (over > 0), short <= over).otherwise(over > 0)

    def draw(acc: Column, x: Column) -> Column:
        def settle(n: Column) -> Column:
            one = F.array(F.struct(x["doc_id"], x["size"], x["rep"], n - x["whole"])).cast(done_type)
            return F.struct(
                (acc["due"] - n * x["size"]).alias("due"), (acc["pool"] - x["size"]).alias("pool"), F.concat(acc["done"], one).alias("done")
            )

        return let((x["whole"] + F.when(more(acc, x), 1).otherwise(0)).cast("int"), settle)

    state = F.struct(F.col("start.due").alias("due"), F.col("start.pool").alias("pool"), F.array().cast(done_type).alias("done"))
    drawn = written(pools.select("source", "cut", "whole", F.aggregate("es", state, draw).alias("m")), "mix-heavy")
    settled = drawn.select("source", F.inline("m.done")).select(*key, "extra")
    left = drawn.where("m.pool > 0").withColumn("p", F.least(F.greatest(F.col("m.due") / F.col("m.pool") - F.col("whole"), F.lit(0.0)), F.lit(1.0)))
    after = left.select("source", F.col("p") - F.floor("p"), F.floor("p").cast("int").alias("shift"), "cut").toDF("source", "p", "shift", "cut")
    return settled, written(after, "mix-after-heavy")


def _meet(open_rows: DataFrame, seed: int, level: int, blocks: Column) -> DataFrame:
    """One level of the tree: a block for each row, with what is ``done`` and the document ``left``."""
    entry = F.struct(
        (-F.col("size")).alias("turn"),  # large documents first: the one left over at the end is small
        F.xxhash64(F.lit(seed + 2), F.lit(level), F.col("doc_id").cast("string"), F.col("rep")).alias("tie"),  # not u: it must not order
        _uniform(seed, level).alias("u"),
        *(F.col(c) for c in ("doc_id", "source", "size", "rep", "p", "shift", "n_docs")),
    )
    dealt = open_rows.select(
        F.col("source"),
        F.pmod(F.xxhash64(F.lit(seed + 1), F.lit(level), F.col("doc_id").cast("string"), F.col("rep")), blocks).alias("block"),
        entry.alias("e"),
    )
    blocks_of = dealt.groupBy("source", "block").agg(F.array_sort(F.collect_list("e")).alias("es"))
    kinds = dict(open_rows.dtypes)
    left_type = f"struct<doc_id:{kinds['doc_id']},source:{kinds['source']},size:bigint,rep:int,p:double,shift:int,n_docs:bigint>"
    done_type = f"array<struct<doc_id:{kinds['doc_id']},source:{kinds['source']},size:bigint,rep:int,extra:int>>"
    start = F.struct(F.lit(None).cast(left_type).alias("left"), F.array().cast(done_type).alias("done"))
    met = F.aggregate("es", start, lambda acc, x: _step(acc, x, left_type, done_type))
    return blocks_of.select(met.alias("m")).select("m.left", "m.done")


def _step(acc: Column, x: Column, left_type: str, done_type: str) -> Column:
    """The document left so far meets ``x``."""
    a = acc["left"]

    def unsettled(d: Column, p: Column) -> Column:
        return F.struct(d["doc_id"].alias("doc_id"), d["source"], d["size"], d["rep"], p.alias("p"), d["shift"], d["n_docs"]).cast(left_type)

    def settled(d: Column, extra: Column) -> Column:
        return F.array(F.struct(d["doc_id"], d["source"], d["size"], d["rep"], extra + d["shift"])).cast(done_type)

    def moved(m: Column) -> Column:
        # up: a gains, x loses; a is settled if it reaches its end before x does
        new_a = F.when(m["up"], a["p"] + m["gain"]).otherwise(a["p"] - m["loss"])
        new_x = F.when(m["up"], x["p"] - m["gain"] * m["ratio"]).otherwise(x["p"] + m["loss"] * m["ratio"])
        a_ends = F.when(m["up"], m["gain"] >= 1 - a["p"]).otherwise(m["loss"] >= a["p"])
        bound = lambda p: F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0))
        up, down = F.lit(1), F.lit(0)
        left = F.when(a_ends, unsettled(x, bound(new_x))).otherwise(unsettled(a, bound(new_a)))
        done = F.when(a_ends, settled(a, F.when(m["up"], up).otherwise(down))).otherwise(
            settled(x, F.when(m["up"], down).otherwise(up))
        )
        return F.struct(left.alias("left"), F.concat(acc["done"], done).alias("done"))

    def meeting(limits: Column) -> Column:
        both = limits["gain"] + limits["loss"]
        up = F.when(both > 0, x["u"] * both < limits["loss"]).otherwise(F.lit(False))
        return let(F.struct(limits["gain"], limits["loss"], limits["ratio"], up.alias("up")), moved)

    ratio = a["size"] / x["size"]
    limits = F.struct(
        F.least(1 - a["p"], x["p"] / ratio).alias("gain"),
        F.least(a["p"], (1 - x["p"]) / ratio).alias("loss"),
        ratio.alias("ratio"),
    )
    first = F.struct(unsettled(x, x["p"]).alias("left"), acc["done"].alias("done"))
    return F.when(a.isNull(), first).otherwise(let(limits, meeting))


def mix(docs: DataFrame, *, weights: Sequence[float] = (1, 2, 3), max_copies: float = 3.0, seed: int = 7) -> DataFrame:
    """The documents that the mix takes, each once, with ``size, source_size, target, copies, taken``.

    ``copies`` says how often to read a document. Documents with no copies are left out; an
    input column with the name of a result column is replaced. Nulls, repeated rows and
    empty tables are as in :func:`copies`.
    """
    rep, size = hidden("rep"), hidden("size")
    base = without(docs, RESULT).withColumn(size, word_count(F.col("text")))
    key = ["doc_id", "source", size]
    base = base.withColumn(rep, F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("text"))))
    plan = copies(docs, weights=weights, max_copies=max_copies, seed=seed).where("copies > 0")
    plan = plan.select(*(F.col(c).alias(hidden(c) if c in ("doc_id", "source", "rep") else c) for c in plan.columns))
    by = dict(zip(("doc_id", "rep", "source"), plan.columns[:3], strict=True))
    same = (
        F.col("doc_id").eqNullSafe(F.col(by["doc_id"]))
        & F.col("source").eqNullSafe(F.col(by["source"]))
        & (F.col(size) == F.col("size"))
        & (F.col(rep) == F.col(by["rep"]))
    )
    return base.join(plan, same).drop(*by.values(), rep, size)
