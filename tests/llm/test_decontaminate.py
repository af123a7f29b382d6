import numpy as np
import pytest

from strataflow.llm import queries
from strataflow.llm.decontaminate import NAME, NUMBER, UNIT, WORD, Vocabulary, contaminated, drop_contaminated, template, verified, windows
from tests.llm.conftest import prose

ITEM = (
    "On monday Maria bought 12 apples and 3 kg of flour at the small market near the old river bridge. Later that day Maria gave 12 apples to her "
    "friend Tom and used 3 kg of flour to bake bread for the whole village before the evening bell."
)
OTHER_VALUES = ITEM.replace("Maria", "Sofia").replace("12", "250").replace("3 kg", "7 lb").replace("Tom", "Ali")
BROKEN = ITEM.replace("Maria bought 12", "Sofia bought 250").replace("gave 12", "gave 9").replace("Tom", "Ali").replace("3 kg of flour to", "5 lb of flour to")


def fillers(n):
    return prose(n, 120)


def test_template():
    words = Vocabulary()
    tokens, kinds, _ = template("Anna paid $3.50 for 5kg. Then Bob ran ten miles -- fast!\nNew line at 20 %", words)
    assert kinds.tolist() == [WORD, WORD, NUMBER, WORD, NUMBER, WORD, NAME, WORD, NUMBER, UNIT, WORD, WORD, WORD, WORD, NUMBER, UNIT]
    same = template("Anna paid $9 for 70kg. Then Eve ran two km -- fast!\nNew line at 1 %", words)[0]
    assert (tokens == same).all() and len(template(None, words)[0]) == len(template(" -- ", words)[0]) == 0


def test_windows_are_equal_only_for_equal_templates():
    words = Vocabulary()
    a, ka, _ = template("one alpha two beta gamma delta 5 kg 6", words)
    hashes, at = windows(a, ka)
    assert at.tolist() == [0, 1, 2, 3, 4] and len(set(hashes.tolist())) == 5
    assert windows(a[:4], ka[:4])[0].size == 0


@pytest.mark.parametrize("text, hit, same", [(ITEM, True, True), (OTHER_VALUES, True, False), (BROKEN, False, False)])
def test_slots(text, hit, same):
    share, consistent, equal = verified(f"{fillers(1)}. {text} {fillers(2)}", ITEM)
    assert share >= 0.8 and consistent == hit and equal == same


def test_scattered_windows_are_no_passage():
    words = ITEM.split()
    torn = " ".join(" ".join(words[k : k + 6]) + " " + prose(k, 40) for k in range(0, len(words) - 5))
    assert verified(torn, ITEM)[0] < 0.8


def brute(docs, items):
    """Pairs with four fifths of an item's literal five-word windows, by looking at every pair."""
    grams = lambda t: {tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(len(w) - 4)}
    of_items = {i: grams(t) for i, t in items}
    return {(d, i) for d, t in docs for g in [grams(t)] for i, want in of_items.items() if len(want & g) >= 0.8 * len(want)}


def test_real_tables(spark, sf_dir, real_docs):
    docs = [(r["doc_id"], r["text"]) for r in real_docs.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    rows = queries.op9_benchmark_decontamination(spark, sf_dir).collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == brute(docs, items) and len(rows) > 5


def test_planted(spark):
    docs = [(1, f"{fillers(1)} {ITEM}"), (2, f"{OTHER_VALUES}\n{fillers(2)}"), (3, f"{fillers(3)} {BROKEN}"), (4, fillers(4)), (5, None), (6, ""), (None, ITEM)]
    docs += [(7, " ".join(ITEM.split()[:12]) + " " + fillers(5)), (1, f"{fillers(1)} {ITEM}"), (8, ITEM.upper()), (9, ITEM.replace("village", "town"))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(10, ITEM), (11, "too short"), (12, None), (13, fillers(99))], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["same_values"] for r in contaminated(df, bench).collect()}
    assert {k: got[k] for k in got if k[0] != 8} == {(1, 10): True, (2, 10): False, (9, 10): True, (None, 10): True}
    left = [r["doc_id"] for r in drop_contaminated(df, bench).collect()]
    assert sorted(i for i in left if i != 8) == [3, 4, 5, 6, 7] and None not in left


def test_join_beyond_broadcast_gives_the_same(spark, sf_dir, real_docs):
    bench = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    get = lambda: sorted((r["doc_id"], r["item_id"]) for r in contaminated(real_docs, bench).collect())
    want = get()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert get() == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hashes_of_one_word_don_t_depend_on_the_vocabulary():
    a, b = Vocabulary(), Vocabulary()
    for w in "some other words first".split():
        b[w]
    assert np.array_equal(template(ITEM, a)[0], template(ITEM, b)[0])


def test_copies_in_another_letter_case(spark):
    names = "Then Anna met Omar and Lena near Berlin while Peter told Maria about Oslo and Paul saw Ines with Karl at Rome."
    docs = [(8, ITEM.upper()), (20, f"{fillers(1)} {ITEM.lower()}"), (21, ITEM.title()), (22, names.upper()), (23, names.lower()), (24, names.title())]
    docs += [(25, "DIE STRASSE " + fillers(3)), (26, BROKEN.upper())]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for item in ({10: ITEM, 11: names}, {10: ITEM.upper(), 11: names.title()}):
        bench = spark.createDataFrame(list(item.items()), "item_id long, text string")
        got = {(r["doc_id"], r["item_id"]): r["same_values"] for r in contaminated(df, bench).collect()}
        assert got == {(8, 10): True, (20, 10): True, (21, 10): True, (22, 11): True, (23, 11): True, (24, 11): True}
        assert sorted(r["doc_id"] for r in drop_contaminated(df, bench).collect()) == [25, 26]
    assert verified("DIE GROSSE STRASSE AM FLUSS", "Die große Straße am Fluss") == (1.0, True, True)


def test_items_of_few_words(spark):
    sums, table = "3 + 5 = 8 and 17 20 31 = 68", "12.5 13.1 17 kg 19 kg 20 21.7 25"
    names, short = "Anna Berta Carla Dora Emil Fritz Gustav", "Capital of Peru?"
    mixed = "The table below shows the yearly harvest of the three farms: 10 20 30 40 50 60 70 80 90 and nothing else was counted there"
    items = {1: sums, 2: table, 3: names, 4: short, 5: "7 * 8", 6: mixed, 7: "?!", 8: "Lima"}
    docs = [(k, f"{fillers(k)} {t} {fillers(k + 50)}") for k, t in items.items() if k not in (7, 8)]
    docs += [(12, "so 12.5 13.1 18 kg 19 kg 21 21.7 26 it is"), (13, "Anna Carla Berta Emil Dora Gustav Fritz"), (14, "CAPITAL OF PERU is Quito"), (15, "capital of the Peru")]
    docs += [(16, mixed.replace("0 ", "7 ")), (17, mixed.replace(": 10 20 30 40 50 60 70 80 90", "")), (18, "he flew to lima."), (19, "7 and 8 ?!"), (20, None)]
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["same_values"] for r in contaminated(df, bench).collect()}
    assert got == dict.fromkeys([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (14, 4), (18, 8)], True) | {(16, 6): False}
    assert sorted(r["doc_id"] for r in drop_contaminated(df, bench).collect()) == [12, 13, 15, 17, 19, 20]
