import random
import re

import numpy as np
import xxhash

from strataflow.llm.components import component_roots
from strataflow.llm.simhash import drop_near_duplicates, fingerprint, fingerprint_links, masks, near_duplicates
from tests.llm.conftest import prose


def slow_fingerprint(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)]
    values = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(v >> b & 1 for v in values) > len(values))


def classes(nodes, linked):
    """Smallest member of the component of each node, by union of all linked pairs."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_fingerprint_by_definition():
    texts = [None, "", " \t", "One", "One TWO", "a b c", "É b C d", "x y z  q\x0bw", prose(3, 500), prose(1, 9000), "a a a a a a"]
    for t in texts:
        got = fingerprint(None if t is None else t.encode())
        assert got & (2**64 - 1) == slow_fingerprint(t)


def test_spark_hash_is_the_same(spark):
    text = prose(5, 3)
    assert spark.createDataFrame([(text,)], "t string").selectExpr("xxhash64(t)").first()[0] == fingerprint(text.encode())


def planted(max_bits):
    rng = random.Random(max_bits)
    prints = [0, -1]
    for _ in range(150):
        f = rng.getrandbits(64)
        prints.append(f)
        for d in (1, 2, 3, 4, 5):
            g = f
            for b in rng.sample(range(64), d):
                g ^= 1 << b
            prints.append(g)
    chain = rng.getrandbits(64)
    for b in range(0, 48, 3):  # each link has three bits, the ends are far apart
        prints.append(chain)
        chain ^= 7 << b
    return sorted({signed(p & (2**64 - 1)) for p in prints})


def test_links_connect_what_is_near(spark):
    for max_bits in (1, 2, 3):
        prints = planted(max_bits)
        u = np.array(prints, dtype=np.int64).view(np.uint64)
        near = [(prints[a], prints[b]) for a in range(len(u)) for b in np.flatnonzero(np.bitwise_count(u ^ u[a]) <= max_bits).tolist()]
        links = fingerprint_links(spark.createDataFrame([(p,) for p in prints], "fp long"), max_bits)
        pairs = [(r["a"], r["b"]) for r in links.collect()]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= max_bits for a, b in pairs)
        root = {r["node"]: r["root"] for r in component_roots(links).collect()}
        assert {p: root.get(p, p) for p in prints} == classes(prints, near)


def test_every_variant_shares_a_bounded_group():
    ball, shell = masks(3)
    assert len(ball) == 65 and len(shell) == 992 and len(set(ball + shell)) == 1057


def test_components_of_long_paths_and_hubs(spark):
    path = [(i, i + 1) for i in range(0, 200)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    links = path + hub + [(5, 5), (7, 8), (8, 7)]
    got = {r["node"]: r["root"] for r in component_roots(spark.createDataFrame(links, "a long, b long")).collect()}
    nodes = {n for e in links for n in e}
    assert {n: got.get(n, n) for n in nodes} == classes(nodes, links)


def test_documents_against_brute_force(spark, real_docs):
    rows = real_docs.select("doc_id", "text").collect()[:400]
    extra = [(10_000 + i, r["text"].replace(".", ";", 1)) for i, r in enumerate(rows[:60])] + [(20_000, None), (20_001, ""), (-3, " ")]
    docs = [(r["doc_id"], r["text"]) for r in rows] + extra
    got = {r["doc_id"]: r for r in near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    prints = {i: slow_fingerprint(t) for i, t in docs}
    assert {i: int(r["fingerprint"], 16) for i, r in got.items()} == prints
    ids = list(prints)
    near = [(a, b) for a in ids for b in ids if a < b and (prints[a] ^ prints[b]).bit_count() <= 3]
    assert {i: r["component_id"] for i, r in got.items()} == classes(ids, near)
    assert got[20_000]["fingerprint"] == "0" * 16 and got[20_001]["component_id"] == -3


def kept(spark, rows):
    left = drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    return sorted(((r["doc_id"], r["text"]) for r in left), key=str)


def test_one_of_each_group_stays(spark):
    """Rows without an id are copies like any others, and go before those that have one."""
    rows = [(4, prose(1, 30)), (2, prose(1, 30)), (2, prose(1, 30)), (9, prose(2, 30)), (None, prose(2, 30)), (None, None), (7, None)]
    assert [i for i, _ in kept(spark, rows)] == [2, 7, 9]


def test_rows_that_share_an_id_or_have_none(spark):
    x, y, z = prose(1, 30), prose(2, 30), prose(3, 30)
    assert kept(spark, [(None, x)] * 3 + [(1, x), (2, y), (2, z), (2, x)]) == [(1, x), (2, y), (2, z)]
    assert kept(spark, [(None, x)] * 3 + [(None, y)]) == sorted([(None, x), (None, y)], key=str)
    assert kept(spark, [(5, x)] * 4 + [(5, y)] * 2) == sorted([(5, x), (5, y)], key=str)
    (only,) = kept(spark, [(None, x), (None, x.replace(" ", "  ")), (None, x + " ")])
    assert only[0] is None


def test_texts_are_joined_without_a_sort(spark, capsys):
    docs = spark.createDataFrame([(i, prose(i, 30)) for i in range(20)], "doc_id long, text string")
    drop_near_duplicates(docs).explain()
    plan = capsys.readouterr().out
    assert "Window" not in plan and "Sort" not in plan and "ShuffledHashJoin" in plan
