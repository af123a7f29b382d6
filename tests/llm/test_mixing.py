import math
import random
from collections import defaultdict
from fractions import Fraction

import pytest

from strataflow.llm.mixing import copies, mix, source_targets, word_count
from tests.llm.conftest import prose

WEIGHTS = (1, 2, 3)


def shared(sizes):
    """Targets by repeated sharing, in exact fractions; ``sizes`` by source, in order."""
    weight = {s: Fraction(WEIGHTS[i % 3]) for i, s in enumerate(sizes)}
    target, full, left = {}, set(), Fraction(sum(sizes.values()))
    while True:
        free = [s for s in sizes if s not in full]
        if not free:
            return target
        rest = left - sum(3 * sizes[s] for s in full)
        target = {s: Fraction(3 * sizes[s]) if s in full else rest * weight[s] / sum(weight[f] for f in free) for s in sizes}
        over = {s for s in free if target[s] >= 3 * sizes[s]}
        if not over:
            return target
        full |= over


def check(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["source"]].append(r)
    order = sorted(by, key=lambda s: (s is None, (s or "").encode()))
    want = shared({s: sum(r["size"] for r in by[s]) for s in order})
    for s, docs in by.items():
        total = sum(r["size"] for r in docs)
        assert {r["source_size"] for r in docs} == {total}
        assert all(r["target"] == pytest.approx(float(want[s])) for r in docs)
        rate = float(want[s]) / total if total else 0
        assert all(r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= 3 for r in docs)
        if rate == int(rate):
            assert {r["copies"] for r in docs} == {int(rate)}
        largest = max((r["size"] for r in docs), default=0)
        assert abs(sum(r["taken"] for r in docs) - float(want[s])) <= largest
    return by, want


def table(spark, sizes):
    rows = [(i, prose(i, n) if n else "", s) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_taken(spark):
    sizes = [("b", 3 + i % 17) for i in range(400)] + [("a", 5)] * 3 + [("c", 900)] + [("c", 2)] * 300 + [(None, 1 + i % 4) for i in range(90)]
    sizes += [("é", 0)] * 4 + [("Z", 40), ("𝄞", 8), ("￮", 8)]
    rows = copies(table(spark, sizes)).collect()
    assert len(rows) == len(sizes)
    by, want = check(rows)
    for s in ("b", "c"):  # many documents: the mix comes close, whatever the largest is
        assert abs(sum(r["taken"] for r in by[s]) - float(want[s])) <= 0.02 * float(want[s])


def test_reruns_agree_and_seeds_differ(spark, real_docs):
    few = real_docs.where("doc_id < 200")
    get = lambda docs, seed: sorted((r["doc_id"], r["taken"]) for r in copies(docs, seed=seed).collect())
    assert get(few, 1) == get(few.repartition(5), 1) != get(few, 2)


def test_real_sources(real_docs):
    check(copies(real_docs).collect())


def test_chance_has_the_right_mean(spark):
    """Over many like sources the documents of each size, the large one too, average the rate."""
    sizes = [(f"s{k:03d}", n) for k in range(60) for n in [1, 2, 3, 4, 5] * 30 + [60]]
    by_size = defaultdict(list)
    for r in copies(table(spark, sizes)).collect():
        by_size[r["size"]].append((r["copies"], r["target"] / r["source_size"]))
    for size, got in by_size.items():
        assert sum(c for c, _ in got) / len(got) == pytest.approx(sum(x for _, x in got) / len(got), abs=0.17 if size == 60 else 0.05)


def test_copies_are_floor_or_ceiling(spark):
    """In sources of 1 to 50 documents and of one very large one too; what others can balance they balance."""
    rng = random.Random(4)
    sizes = [(f"n{n:02d}", rng.choice([1, 3, 9, 40, 200])) for n in range(1, 51) for _ in range(n)]
    sizes += [(f"x{k:02d}", n) for k in range(30) for n in [600] + [rng.randint(1, 9) for _ in range(11)]]
    sizes += [(f"y{k:02d}", n) for k in range(20) for n in [50, 40, 30] + [rng.randint(1, 3) for _ in range(200)]]
    by = defaultdict(list)
    for r in copies(table(spark, sizes)).collect():
        by[r["source"]].append(r)
        rate = r["target"] / r["source_size"]
        assert r["copies"] in (math.floor(rate + 1e-9), math.ceil(rate - 1e-9)), (r["source"], r["size"], rate, r["copies"])
    for s, rows in by.items():
        miss, due = sum(r["taken"] for r in rows) - rows[0]["target"], rows[0]["target"]
        part = due / rows[0]["source_size"] % 1
        if s[0] == "y":
            assert abs(miss) <= 3
        if s[0] == "x":  # the others hold too little to balance it, so the nearer side is taken
            largest, all_words = 600, rows[0]["source_size"]
            extra = part * all_words
            assert abs(miss) <= max(9, min(abs(largest - extra), abs(extra - (all_words - largest))) + 9)


def test_word_count(spark):
    texts = [None, "", " \t\n\x0b\x0c\r", "a", " a  b c d\x1ce ", "x\x0by"]
    got = spark.createDataFrame([(t,) for t in texts], "text string").select(word_count("text")).collect()
    assert [r[0] for r in got] == [0, 0, 0, 1, 2, 2]


def test_targets_when_all_are_full(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 0), ("c", 0)], "source string, size long")
    assert {r["source"]: r["target"] for r in source_targets(sizes).collect()} == {"a": 10.0, "b": 0.0, "c": 0.0}


def test_mix_returns_texts(spark, real_docs):
    mixed = mix(real_docs).collect()
    plan = {r["doc_id"]: r["copies"] for r in copies(real_docs).collect() if r["copies"]}
    assert {r["doc_id"]: r["copies"] for r in mixed} == plan and all(r["text"] is not None for r in mixed)


def test_plan_has_no_python(spark, real_docs):
    plan = copies(real_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "Cartesian" not in plan
