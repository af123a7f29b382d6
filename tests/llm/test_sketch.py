import hashlib
import random

import pytest
import xxhash

from strataflow.llm import queries
from strataflow.llm.sketch import Sketch, chained, containment, edited, fingerprint_documents, resemblance, sketch
from tests.llm.conftest import prose


def ordered(docs):
    """Falling ids, nulls last."""
    return sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0)))


def expected(docs):
    line = ordered(docs)
    out = {}
    for k, (i, text) in enumerate(line):
        following = line[(k + 1) % len(line)][1]
        new = edited(text, following)
        mine, changed, theirs = sketch(text), sketch(new), sketch(following)
        sha = hashlib.sha256(new.encode()).hexdigest()
        out[i] = (len(text or ""), sha, str(mine), str(changed), containment(mine, changed), containment(mine, theirs))
    return out


COLUMNS = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def found(df):
    return {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in df.collect()}


def test_real_documents(spark, sf_dir, real_docs):
    docs = [(r["doc_id"], r["text"]) for r in real_docs.select("doc_id", "text").collect()]
    assert found(queries.op10_document_fingerprints(spark, sf_dir)) == expected(docs)


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_uneven_ids(spark, partitions):
    rng = random.Random(partitions)
    ids = rng.sample(range(-50, 50), 30) + rng.sample(range(10**12, 10**12 + 10**6), 30) + [None]
    docs = [(i, rng.choice([None, "", "a", "é" * 7, prose(i or 1, rng.randint(1, 60))])) for i in ids]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert found(fingerprint_documents(df, partitions=partitions)) == expected(docs)


def test_least_and_largest_ids(spark):
    docs = [(-(2**63), "a b c"), (2**63 - 1, "d e f"), (0, "g h i"), (-5, "j k l")]
    assert found(fingerprint_documents(spark.createDataFrame(docs, "doc_id long, text string"), partitions=2)) == expected(docs)


def test_one_row_follows_itself(spark):
    df = spark.createDataFrame([(1, "abc def ghi")], "doc_id long, text string")
    assert found(fingerprint_documents(df)) == expected([(1, "abc def ghi")])


def test_repeated_ids_follow_each_other(spark):
    df = spark.createDataFrame([(2, "same text here"), (2, "same text here"), (1, "x y z")], "doc_id long, text string")
    rows = fingerprint_documents(df).collect()
    assert sorted((r["doc_id"], r["near_next"]) for r in rows) == [(1, 0.0), (2, 0.0), (2, 1.0)]


@pytest.mark.parametrize("hot", [None, 7, -(2**63), 2**63 - 1])
def test_a_hot_id_is_many_ranges(spark, hot):
    rng = random.Random(1)
    docs = [(hot, prose(k, rng.randint(1, 30))) for k in range(1500)] + [(k, prose(-k, 9)) for k in range(-20, 20)] + [(hot, "same words")] * 5
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    chain, part, _, _ = chained(df, 8)
    sizes = [r["count"] for r in chain.groupBy(part).count().collect()]
    assert len(sizes) > 16 and max(sizes) < 300
    line = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), signed(xxhash.xxh64_intdigest(d[1], 42))))
    want = []
    for k, (i, text) in enumerate(line):
        following = line[(k + 1) % len(line)][1]
        want.append((i is None, i or 0, len(text), hashlib.sha256(edited(text, following).encode()).hexdigest(), float(text == following)))
    got = fingerprint_documents(df, partitions=8).collect()
    assert sorted((r[0] is None, r[0] or 0, r["n_chars"], r["edited_sha256"], float(r["near_next"] == 1)) for r in got) == sorted(want)


def signed(h):
    return h - 2**64 if h >= 2**63 else h


def test_edit():
    assert edited("abcdefg", "XY") == "abcdeXY" and edited("abcdef", "X") == "abcdX" and edited("ab", "XYZ") == "ab"
    assert edited(None, "x") == "" and edited("abc", None) == "ab" and edited("\U0001d11eab", "\U0001d11fz") == "\U0001d11ea\U0001d11f"


def shingles(text):
    words = text.lower().split()
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def test_estimates_of_unequal_documents():
    long = prose(1, 8000).split()
    for share in (0.0, 0.25, 0.5, 1.0):
        small = " ".join(long[: int(800 * share)] + prose(2, 800 - int(800 * share)).split())
        a, b = shingles(small), shingles(" ".join(long))
        assert containment(sketch(small), sketch(" ".join(long))) == pytest.approx(len(a & b) / len(a), abs=0.15)
        assert resemblance(sketch(small), sketch(" ".join(long))) == pytest.approx(len(a & b) / len(a | b), abs=0.05)


def test_merge_and_read():
    a, b = prose(1, 900), prose(2, 500)
    both = sketch(a).merge(sketch(b))
    assert set(both.kept) == set(sketch(a).kept) | set(sketch(b).kept) and containment(sketch(b), both) == 1.0
    assert str(Sketch.read(str(both))) == str(both)
    assert sketch(None).number == 0 and containment(sketch(""), sketch(None)) == 1.0 and containment(sketch(""), sketch("a")) == 0.0
    assert str(sketch("A  b\nc")) == str(sketch("a b c"))
