"""Benchmark decontamination by template canonicalisation.

Numbers, names and units are replaced by typed placeholders, so that a question with other values keeps its
template. Windows of five template tokens are hashed and joined with those of the benchmark; a
document that has 0.8 or more of an item's windows is a candidate. The windows have a second, case-folded form,
in which names are words in lower case, so that copies in another letter case are found; either form
will do. Where too few words would be left in a window, as in arithmetic and tables, the second form has the
literal tokens, and a text of fewer than five tokens is one such window: verbatim copies of those are found, whatever
they consist of. A candidate is checked on the texts: within one stretch of the document there must be that many windows in
place, and each value of the item must stand for one value of the document throughout.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, hidden, memories, written

WINDOW = 5
SIMILARITY = 0.8
MAX_MEMO = 300_000  # words remembered in a worker while it hashes; more are looked at again
BATCH_CHARS = 1 << 20  # of text that is hashed at a time; a longer text is hashed alone
TABLE_BITS = 22  # the benchmark's window hashes are known in tasks by one of so many bits each (as a power of 2)
LEAST_WORDS = 2  # a window of placeholders only says nothing; it counts by its literal tokens
WORD, NUMBER, UNIT, NAME = 0, 1, 2, 3
UNITS = frozenset(
    "mm cm dm m km in inch inches ft foot feet yard yards mile miles mg g kg t ton tons oz lb lbs pound pounds ml cl l liter liters litre "
    "litres gallon gallons s sec second seconds min minute minutes h hour hours day days week weeks month months year years cent cents "
    "dollar dollars euro euros usd eur gbp % $ € £ ° degree degrees percent mph kmh kph hz khz mhz ghz kb mb gb tb w kw kwh v a".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:st|nd|rd|th|%|[a-z]{1,3})?")
_EDGE = "\"'()[]{}<>,;:!?.…“”‘’«»„`*_~#&|-–—$€£%"
_STEP = np.uint64(0x9E3779B97F4A7C15)
SPECIAL = dict.fromkeys(UNITS, UNIT) | dict.fromkeys(NUMBER_WORDS, NUMBER)
_POWERS = np.array([pow(0x9E3779B97F4A7C15, k, 1 << 64) for k in range(WINDOW)], dtype=np.uint64)


def value(raw: str) -> str:
    """What a raw word stands for in a slot: lower case, without punctuation around it."""
    return raw.casefold().strip(_EDGE)


class Vocabulary(dict):
    """Of a raw word: a number, under which its hash, kind, place in a sentence and literal hash are kept."""

    def __init__(self) -> None:
        super().__init__()
        self.rows: list[tuple[int, int, bool, bool, int]] = []
        self.table = np.zeros((0, 5), dtype=np.uint64)

    def __missing__(self, raw: str) -> int:
        if raw.isalpha():
            core, ends = raw.casefold(), False
            kind = SPECIAL.get(core, WORD)
            capital = not kind and len(raw) > 1 and raw[0].isupper() and not raw.isupper()
        else:
            core = value(raw)
            ends = raw.rstrip("\"')]}”’»")[-1:] in (".", "!", "?", ":")
            low = raw.lower()
            kind = SPECIAL.get(core) or SPECIAL.get(low, WORD)
            if not kind and _NUMBER.fullmatch(low.strip(_EDGE[:-4] + "%")):
                kind = NUMBER
            core = core or (low if kind else "")
            letters = raw.lstrip(_EDGE)
            capital = not kind and len(core) > 1 and letters[:1].isupper() and not letters.isupper()
        literal = xxhash.xxh64_intdigest(core) if core else 0
        token = xxhash.xxh64_intdigest("\0unit" if kind == UNIT else "\0number") if kind and core else literal
        self.rows.append((token, kind, capital, ends, literal))
        self[raw] = len(self)
        return len(self) - 1

    def look_up(self, ids: np.ndarray) -> np.ndarray:
        """Rows of the table, which doubles when it is full and takes in what is new."""
        known = len(self)
        if self.rows:
            while len(self.table) < known:
                self.table = np.concatenate([self.table, np.zeros((max(1024, len(self.table)), 5), dtype=np.uint64)])
            self.table[known - len(self.rows) : known] = self.rows
            self.rows = []
        return self.table[ids]


def remembered() -> Vocabulary:
    """A worker's words, kept from task to task of a step."""
    words = memories.get("words")
    if words is None or len(words) >= MAX_MEMO:
        words = memories["words"] = Vocabulary()
    return words


_NAME_TOKEN = np.uint64(xxhash.xxh64_intdigest("\0name"))


def templates(texts: Sequence[str | None], words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes, kinds, the numbers of the raw words, and of their texts; words of punctuation only are left out.

    A name is a capitalised word that doesn't begin a sentence or line.
    """
    ids, begins, sizes = array("q"), [], []
    number = words.__getitem__
    for text in texts:
        before = len(ids)
        for line in (text or "").split("\n"):
            of_line = line.split()
            if of_line:
                begins.append(len(ids))
                ids.extend(map(number, of_line))
        sizes.append(len(ids) - before)
    at = np.frombuffer(ids, dtype=np.int64) if ids else np.zeros(0, dtype=np.int64)
    rows = words.look_up(at) if len(at) else np.zeros((0, 5), dtype=np.uint64)
    starts = np.zeros(len(at), dtype=bool)
    if len(at):
        starts[1:] = rows[:-1, 3] > 0
        starts[begins] = True
    name = (rows[:, 2] > 0) & ~starts
    real = rows[:, 0] > 0
    tokens = np.where(name, _NAME_TOKEN, rows[:, 0])[real]
    return tokens, np.where(name, NAME, rows[:, 1]).astype(np.int8)[real], at[real], np.repeat(np.arange(len(sizes)), sizes)[real]


def template(text: str | None, words: Vocabulary) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one text."""
    return templates([text], words)[:3]


def mixed(tokens: np.ndarray) -> np.ndarray:
    return tokens ^ (tokens >> np.uint64(29))


def mixed_sums(of_step: Callable[[int], np.ndarray], width: int, n: int) -> np.ndarray:
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total += of_step(k) * _POWERS[k]
    return ((total ^ (total >> np.uint64(32))) * _STEP).view(np.int64)


def sums(tokens: np.ndarray, width: int = WINDOW) -> np.ndarray:
    """A hash of each run of ``width`` tokens."""
    n, all_mixed = max(len(tokens) - width + 1, 0), mixed(tokens)
    return mixed_sums(lambda k: all_mixed[k : k + n], width, n)


def in_windows(marks: np.ndarray) -> np.ndarray:
    """How many of each window's tokens are marked."""
    n = max(len(marks) - WINDOW + 1, 0)
    total = np.zeros(n, dtype=np.int8)
    for k in range(WINDOW):
        total += marks[k : k + n]
    return total


def wordy(plain: np.ndarray) -> np.ndarray:
    """Whether each window has enough words, of which of its tokens are words."""
    return in_windows(plain) >= LEAST_WORDS


def windows(tokens: np.ndarray, kinds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows with enough words in them, and where each starts."""
    at = np.flatnonzero(wordy(kinds == WORD))
    return sums(tokens)[at], at


def folded(kinds: np.ndarray, ids: np.ndarray, words: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows in the form in which names are words, and literal ones where too few are words."""
    rows = words.look_up(ids)
    hashes = np.where(wordy((kinds == WORD) | (kinds == NAME)), sums(rows[:, 0]), sums(rows[:, 4]))
    return hashes, np.arange(len(hashes))


def hashed_windows(text: str | None, lengths: Sequence[int] = ()) -> tuple[np.ndarray, np.ndarray, int]:
    """The different window hashes of the template and of the folded form, and the number of tokens.

    The folded form has the literal runs of ``lengths`` as well.
    """
    words = remembered()
    tokens, kinds, ids = template(text, words)
    made = [folded(kinds, ids, words)[0], *(sums(words.look_up(ids)[:, 4], n) for n in lengths)]
    return np.unique(windows(tokens, kinds)[0]), np.unique(np.concatenate(made)), len(tokens)


def bit_of(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the bit of each hash is: the place of its long, and the bit's in that."""
    place = hashes.view(np.uint64) >> np.uint64(64 - TABLE_BITS)
    return (place >> np.uint64(6)).astype(np.int64), place & np.uint64(63)


def bit_table(wanted: DataFrame) -> np.ndarray:
    """The bits of all hashes ``w``, in longs; their number doesn't depend on the benchmark's size."""
    place = F.shiftrightunsigned("w", 64 - TABLE_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    longs = wanted.groupBy(F.shiftright(place, 6).cast("int").alias("at")).agg(F.bit_or(bit).alias("bits")).collect()
    table = np.zeros(1 << (TABLE_BITS - 6), dtype=np.int64)
    for r in longs:
        table[r["at"]] = r["bits"]
    return table.view(np.uint64)


def known_windows(texts: Sequence[str | None], lengths: Sequence[int], table: np.ndarray) -> list[list]:
    """The different window hashes of each text, in both forms together, whose bits are in the table.

    A window with words enough and no name has one hash for both forms, so only the others are hashed anew.
    All texts are hashed as one sequence; windows that reach over a border are left out.
    """
    out: list[list] = []
    batch: list[str | None] = []
    size = 0
    for k, text in enumerate(texts):
        batch.append(text)
        size += len(text or "")
        if size >= BATCH_CHARS or k + 1 == len(texts):
            out += _known_windows(batch, lengths, table)
            batch, size = [], 0
    return [out]


def _known_windows(texts: Sequence[str | None], lengths: Sequence[int], table: np.ndarray) -> list:
    words = remembered()
    tokens, kinds, ids, of = templates(texts, words)
    whole = lambda width: of[: max(len(of) - width + 1, 0)] == of[width - 1 :]
    inside = whole(WINDOW)
    plain, name = in_windows(kinds == WORD), in_windows(kinds == NAME)
    enough = plain + name >= LEAST_WORDS
    usual, named, bare = (np.flatnonzero(x & inside) for x in (plain >= LEAST_WORDS, (name > 0) & enough, ~enough))
    made = [(usual, sums(tokens)[usual])]
    made += [(at, sums_at(words.table[:, c], ids, at)) for c, at in ((0, named), (4, bare)) if len(at)]
    for n in lengths:
        at = np.flatnonzero(whole(n))
        made.append((at, sums(words.look_up(ids)[:, 4], n)[at]))
    hits: list[list] = [[] for _ in texts]
    for at, hashes in made:
        long, bit = bit_of(hashes)
        hit = np.flatnonzero((table[long] >> bit) & np.uint64(1))
        for k, h in zip(of[at[hit]].tolist(), hashes[hit].tolist(), strict=True):
            hits[k].append(h)
    return [list(set(some)) if some else some for some in hits]


def sums_at(table: np.ndarray, ids: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A hash of each window that starts in ``at``, of the hashes in ``table`` of the words ``ids``."""
    return mixed_sums(lambda k: mixed(table[ids[at + k]]), WINDOW, len(at))


def item_windows(texts: Sequence[str | None]) -> list[list]:
    """Of each text: the hashes of both forms, whether each is in the template and in the folded form, how many are,
    and the number of tokens if it is below a window's."""
    out: list[list] = [[], [], [], [], [], []]
    for text in texts:
        t, f, n = hashed_windows(text)
        if 0 < n < WINDOW:
            t, f, n = hashed_windows(text, [n])
        both = np.union1d(t, f)
        made = both, np.isin(both, t).astype(np.int32), np.isin(both, f).astype(np.int32), len(t), len(f), n if n < WINDOW else 0
        for column, v in zip(out, made, strict=True):
            column.append(v)
    return out


def verified(text: str | None, item: str | None, similarity: float = SIMILARITY) -> tuple[float, bool, bool]:
    """(share of the item's windows in place, slots consistent, all values equal) in the best stretch of ``text``.

    A stretch spans at most a quarter more tokens than the item. Slots are consistent if four
    fifths of the item's slots agree with one value of the document for each value of the item.
    Of the two forms the one that passes counts, or else the one with the larger share. The template's share is
    the lesser of that of the windows with enough words and that of all, of which the others must be in line
    with these. An item of fewer than five tokens must be there as it is.
    """
    words = Vocabulary()
    tokens, kinds, ids = template(text, words)
    i_tokens, i_kinds, i_ids = template(item, words)
    raw = list(words)
    values, i_values = [value(raw[i]) for i in ids], [value(raw[i]) for i in i_ids]
    i_folded = np.where(i_kinds == NAME, WORD, i_kinds)
    if len(i_tokens) < WINDOW:
        literal, i_literal = words.look_up(ids)[:, 4], words.look_up(i_ids)[:, 4]
        there = len(i_literal) > 0 and bool(np.isin(sums(i_literal, len(i_literal)), sums(literal, len(i_literal))).all())
        return float(there), there, there
    every = sums(tokens), sums(i_tokens)
    both = [
        in_place(windows(tokens, kinds), windows(i_tokens, i_kinds), i_kinds, values, i_values, similarity, every),
        in_place(folded(kinds, ids, words), folded(i_kinds, i_ids, words), i_folded, values, i_values, similarity),
    ]
    return max(both, key=lambda r: (r[1] and r[0] >= similarity, *r))


Windows = tuple[np.ndarray, np.ndarray]


def in_place(
    of_text: Windows,
    of_item: Windows,
    i_kinds: np.ndarray,
    values: Sequence[str],
    i_values: Sequence[str],
    similarity: float,
    every: Windows | None = None,
) -> tuple[float, bool, bool]:
    """What ``verified`` says, by the windows of one form; ``every`` has the hashes of all windows of text and item."""
    i_hashes, i_at = of_item
    if not len(i_hashes):
        return 0.0, False, False
    kinds_of, kind = np.unique(i_hashes, return_inverse=True)  # equal windows of the item are met together
    places = [i_at[some] for some in np.split(np.argsort(kind, kind="stable"), np.cumsum(np.bincount(kind))[:-1])]
    hashes, starts = of_text
    hit = np.isin(hashes, i_hashes)
    at, met = starts[hit], np.searchsorted(kinds_of, hashes[hit])
    spots, weights = at.tolist(), [len(p) for p in places]
    span = -(-5 * len(i_kinds) // 4)
    counts = [0] * len(places)
    best, best_range, left, now = 0, (0, 0), 0, 0
    for right, w in enumerate(met.tolist()):
        now += 0 if counts[w] else weights[w]
        counts[w] += 1
        while spots[left] < spots[right] - span:
            gone = int(met[left])
            counts[gone] -= 1
            now -= 0 if counts[gone] else weights[gone]
            left += 1
        if now > best:
            best, best_range = now, (left, right + 1)
    at, met = at[slice(*best_range)], met[slice(*best_range)]
    share = best / len(i_hashes)
    more: list[tuple[int, int]] = []
    if every and len(every[1]) > len(i_hashes) and len(at):
        some, earliest = np.unique(met, return_index=True)
        first = {int(k): int(at[n]) for w, n in zip(some.tolist(), earliest.tolist(), strict=True) for k in places[w]}
        more = in_line(first, np.setdiff1d(np.arange(len(every[1])), i_at), *every)
        share = min(share, (best + len(more)) / len(every[1]))
    slots = i_kinds != WORD
    slotted = [p[in_windows(slots)[p] > 0] for p in places]
    times = np.array([len(p) for p in slotted], dtype=np.int64)[met]
    text_at = np.concatenate([np.repeat(at, times), np.array([a for a, _ in more], dtype=np.int64)])
    item_at = np.concatenate([*(slotted[w] for w in met.tolist()), np.array([k for _, k in more], dtype=np.int64)]).astype(np.int64)
    pairs: dict[int, Counter] = defaultdict(Counter)  # of the item's place: the document's places
    width = int(text_at.max(initial=0)) + WINDOW
    for j in range(WINDOW):
        filled_here = slots[item_at + j]
        pair, n = np.unique((item_at + j)[filled_here] * width + (text_at + j)[filled_here], return_counts=True)
        for place, spot, c in zip((pair // width).tolist(), (pair % width).tolist(), n.tolist(), strict=True):
            pairs[place][spot] += c
    filled: dict[tuple, Counter] = defaultdict(Counter)
    for place, spots_of in pairs.items():
        spot = min(spots_of, key=lambda p: (-spots_of[p], p))
        filled[(i_kinds[place], i_values[place])][values[spot]] += 1
    total = sum(sum(c.values()) for c in filled.values())
    agree = sum(max(c.values()) for c in filled.values())
    equal = all(set(c) == {value} for (_, value), c in filled.items())
    return share, agree >= similarity * total, equal


def in_line(matched: dict[int, int], rest: np.ndarray, hashes: np.ndarray, i_hashes: np.ndarray) -> list[tuple[int, int]]:
    """(place in the text, place in the item) of the item's windows ``rest`` that are as far from the next one
    matched, before or behind, as in the item."""
    known, out = sorted(matched), []
    for k in rest.tolist():
        right = bisect_left(known, k)
        for near in known[max(right - 1, 0) : right + 1]:
            at = k + matched[near] - near
            if 0 <= at < len(hashes) and hashes[at] == i_hashes[k]:
                out.append((at, k))
                break
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, text_hash, item_id, containment, same_values): documents that hold a benchmark item.

    Needs ``doc_id`` and ``text``, and ``item_id`` and ``text`` of the benchmark. Windows of both sides are
    joined by hash, those of documents if their hash has a bit of the benchmark's in a table of fixed size; Spark broadcasts the benchmark's only while their written size is under its limit and
    shuffles both otherwise. Items of fewer than five tokens, down to a single one, are found wherever their tokens stand in
    a row, also by chance; documents are read for runs of the lengths that such items have. Null texts
    and texts of punctuation only match nothing. Rows that are alike give one result; empty tables give none.
    """
    hashes = T.ArrayType(T.LongType())
    items = benchmark.select("item_id", "text").where("text is not null").distinct()
    flags = T.ArrayType(T.IntegerType())
    fields = [("w", hashes), ("in_t", flags), ("in_f", flags), *((n, T.IntegerType()) for n in ("n_t", "n_f", "short"))]
    held = written(add_columns(items, ["text"], fields, item_windows).where("n_t > 0 or n_f > 0"), "bench")
    each = held.select("item_id", "n_t", "n_f", F.explode(F.arrays_zip("w", "in_t", "in_f")).alias("z"))
    wanted = written(each.select("z.*", "item_id", "n_t", "n_f"), "bench-windows")
    lengths = sorted(r["short"] for r in held.where("short > 0").select("short").distinct().collect())  # at most four
    source = docs.select("doc_id", "text").where("text is not null")
    named, table = source.withColumn("text_hash", F.xxhash64("text")), bit_table(wanted)
    find = lambda texts: known_windows(texts, lengths, table)
    hashed = add_columns(named, ["text"], [("h", hashes)], find, keep=["doc_id", "text_hash"])
    present = hashed.select("doc_id", "text_hash", F.explode("h").alias("h")).join(wanted, F.col("h") == F.col("w"))
    counted = present.groupBy("doc_id", "text_hash", "item_id", "n_t", "n_f").agg(F.sum("in_t").alias("m_t"), F.sum("in_f").alias("m_f"))
    enough = lambda m, n: (F.col(n) > 0) & (F.col(m) >= similarity * F.col(n))
    candidates = counted.where(enough("m_t", "n_t") | enough("m_f", "n_f")).select("doc_id", "text_hash", "item_id")
    candidates = written(candidates.distinct(), "bench-candidates")
    c = candidates.select(F.col("doc_id").alias("c_id"), F.col("text_hash").alias("c_hash"), "item_id")
    rows = source.withColumn("text_hash", F.xxhash64("text")).join(
        c, F.col("text_hash").eqNullSafe(F.col("c_hash")) & F.col("doc_id").eqNullSafe(F.col("c_id"))
    )
    texts = held.select(F.col("item_id").alias("b_id"), F.col("text").alias("item_text"))
    paired = rows.join(texts, F.col("item_id").eqNullSafe(F.col("b_id"))).select("doc_id", "text_hash", "item_id", "text", "item_text")

    def check(texts: Sequence[str], of: Sequence[str]) -> list[list]:
        return [list(v) for v in zip(*(verified(t, i, similarity) for t, i in zip(texts, of, strict=True)), strict=True)]

    fields = [("containment", T.DoubleType()), ("consistent", T.BooleanType()), ("same_values", T.BooleanType())]
    checked = add_columns(paired, ["text", "item_text"], fields, check)
    passed = checked.where(F.col("consistent") & (F.col("containment") >= similarity))
    return passed.groupBy("doc_id", "text_hash", "item_id").agg(
        F.max("containment").alias("containment"), F.max("same_values").alias("same_values")
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their columns."""
    found = contaminated(docs, benchmark, similarity=similarity).select("doc_id", "text_hash").distinct()
    h, d = hidden("hash"), hidden("id")
    found = written(found.select(F.col("doc_id").alias(d), F.col("text_hash").alias(h)), "bench-found")
    same = F.col("doc_id").eqNullSafe(F.col(d)) & (F.xxhash64("text") == F.col(h)) & F.col("text").isNotNull()
    return docs.join(found, same, "left_anti")
