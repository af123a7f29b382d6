"""Periodic runs of words, found in a grammar of the text.

A run is a stretch of words with a smallest period, long enough and repeated often enough, that neither
neighbour extends. The words are numbered and compressed by Re-Pair: the most frequent pairs become
rules, until no pair repeats. Runs that cross the boundary of a rule's two halves are computed once for each rule and
copied to all places where the rule stands; the sequence that remains gets a balanced tree of halves. Every run lies
whole in the smallest rule that covers it, and crosses its boundary, so merging what is found gives all maximal runs.

Two words that stand next to each other in a run do so as often as the run repeats. So a text is first cut wherever
a pair is rarer, and only the pieces are compressed: most texts have none. All texts of a batch are worked on side by
side in numpy arrays; time is about n log n, memory linear in the batch, or in its longest text.
"""

from __future__ import annotations

import itertools
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, hidden

#: A run has at least so many words, and its period so many times.
LEAST_WORDS, LEAST_REPEATS = 6, 4
#: Words that are worked on at a time, and pairs of a boundary and a period.
BATCH_WORDS, BATCH_PERIODS = 400_000, 1_000_000
PRIME = 2**31 - 1
RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def spread(numbers: np.ndarray, salt: int) -> np.ndarray:
    """The numbers scattered over 64 bits."""
    x = numbers.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt * 0x632BE59BD9B4E019 % 2**64)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers ``start, start + 1, ...`` of every start, ``size`` of them, one after the other."""
    before = np.cumsum(sizes) - sizes
    return np.arange(sizes.sum()) + np.repeat(starts - before, sizes)


@dataclass
class Pieces:
    """Stretches of texts that may hold runs: their words, where each word stands, and the number of its piece."""

    word: np.ndarray
    at: np.ndarray
    piece: np.ndarray


def cut(word: np.ndarray, text: np.ndarray, least_words: int, least_repeats: int) -> Pieces:
    """The stretches all of whose pairs occur in them ``least_repeats - 1`` times; those too short for a run go.

    Counts are of hashed pairs: two that share a hash count more, so nothing of a run is ever cut.
    """
    found = Pieces(word, np.arange(len(word)), text)
    for salt in itertools.count(1):
        n = len(found.word)
        if n < least_words:
            return Pieces(found.word[:0], found.at[:0], found.piece[:0])
        joined = found.piece[1:] == found.piece[:-1]
        key = spread(spread(found.piece[:-1], salt) + found.word[:-1].astype(np.uint64), salt) + found.word[1:].astype(np.uint64)
        bits = max(10, int(n).bit_length() + 2)
        key = (spread(key, salt) >> np.uint64(64 - bits)).astype(np.int64)
        joined &= np.bincount(key[joined], minlength=1 << bits)[key] >= least_repeats - 1
        start = np.concatenate(([True], ~joined))
        piece = np.cumsum(start) - 1
        long = np.bincount(piece) >= least_words
        keep = long[piece]
        found = Pieces(found.word[keep], found.at[keep], piece[keep])
        if len(found.word) > 0.95 * n:
            return found


@dataclass
class Nodes:
    """Nonterminals by their first place in the text: where it starts, where its second half does, where it ends.

    ``place`` lists the starts of all places, those of node k from ``first[k]``, ``count[k]`` of them.
    """

    lo: np.ndarray
    mid: np.ndarray
    hi: np.ndarray
    place: np.ndarray
    first: np.ndarray
    count: np.ndarray


def grammar(p: Pieces) -> Nodes:
    """Re-Pair of every piece, then a balanced tree over what remains of it.

    In a pass pairs go by their number of occurrences, the most frequent first: an occurrence is replaced if no
    overlapping pair comes before its own, so all of the first pair's are. A pair that doesn't repeat never will.
    """
    n = len(p.word)
    _, symbol = np.unique(p.piece * (int(p.word.max(initial=0)) + 1) + p.word, return_inverse=True)  # each piece has its own
    symbol, lo, hi = symbol.astype(np.int64), np.arange(n), np.arange(1, n + 1)
    joined = np.append(p.piece[1:] == p.piece[:-1], False)
    size, rules = n, []
    while True:
        i = np.flatnonzero(joined)
        if not len(i):
            break
        key = symbol[i] * size + symbol[i + 1]
        kinds, kind = np.unique(key, return_inverse=True)
        again = np.append(False, (i[1:] == i[:-1] + 1) & (key[1:] == key[:-1]))  # overlaps the same pair, as in a a a
        k = np.arange(len(i))
        usable = (k - np.maximum.accumulate(np.where(again, 0, k))) % 2 == 0
        count = np.bincount(kind[usable], minlength=len(kinds))
        joined[i[count[kind] < 2]] = False
        rank = np.empty(len(kinds), dtype=np.int64)
        rank[np.lexsort((spread(kinds, 7), count))] = np.arange(len(kinds))
        mine = np.where(usable & (count[kind] >= 2), rank[kind], -1)
        ranks = np.full(len(symbol) + 2, -1)
        ranks[i + 1] = mine
        chosen = (mine >= 0) & (mine > ranks[i]) & (mine > ranks[i + 2])
        chosen &= np.bincount(kind[chosen], minlength=len(kinds))[kind] >= 2
        left, right = i[chosen], i[chosen] + 1
        if not len(left):
            continue  # nothing repeats: all pairs are settled now
        made, name = np.unique(kind[chosen], return_inverse=True)
        order = np.argsort(name, kind="stable")
        times = np.bincount(name)
        first = order[np.cumsum(times) - times]
        rules.append((lo[left[first]], lo[right[first]], hi[right[first]], lo[left[order]], times))
        symbol[left], hi[left], joined[left] = size + name, hi[right], joined[right]
        size += len(made)
        rest = np.ones(len(symbol), dtype=bool)
        rest[right] = False
        symbol, lo, hi, joined = symbol[rest], lo[rest], hi[rest], joined[rest]
    piece = p.piece[lo]
    while len(lo):
        number = np.arange(len(lo)) - np.searchsorted(piece, piece, side="left")
        left = np.flatnonzero((number % 2 == 0) & np.append(piece[1:] == piece[:-1], False))
        if not len(left):
            break
        rules.append((lo[left], lo[left + 1], hi[left + 1], lo[left], np.ones(len(left), dtype=np.int64)))
        hi[left] = hi[left + 1]
        rest = np.ones(len(lo), dtype=bool)
        rest[left + 1] = False
        lo, hi, piece = lo[rest], hi[rest], piece[rest]
    lo, mid, hi, place, count = (np.concatenate([r[c] for r in rules] or [np.zeros(0, dtype=np.int64)]) for c in range(5))
    return Nodes(lo, mid, hi, place, np.cumsum(count) - count, count)


class Matches:
    """How far two stretches of a sequence agree, by hashes of all prefixes; false agreement is possible, the rest isn't."""

    def __init__(self, word: np.ndarray, salt: int):
        n = len(word)
        base = 256 + int(spread(np.array([salt]), 3)[0] % (PRIME - 512))
        self.power = np.ones(n + 1, dtype=np.int64)
        filled, step = 1, base  # step is the base to the power of filled
        while filled <= n:
            some = min(filled, n + 1 - filled)
            self.power[filled : filled + some] = self.power[:some] * step % PRIME
            filled, step = filled + some, step * step % PRIME
        value = (spread(word, salt) % np.uint64(PRIME)).astype(np.int64)
        self.prefix = np.concatenate(([0], np.cumsum(value * self.power[:n] % PRIME) % PRIME))

    def equal(self, a: np.ndarray, shift: np.ndarray, size: np.ndarray) -> np.ndarray:
        one = (self.prefix[a + size] - self.prefix[a]) % PRIME * self.power[shift] % PRIME
        return one == (self.prefix[a + shift + size] - self.prefix[a + shift]) % PRIME

    def forward(self, a: np.ndarray, shift: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words from ``a`` on are those ``shift`` words later, ``most`` at most."""
        size = np.zeros(len(a), dtype=np.int64)
        for step in (1 << b for b in reversed(range(int(most.max(initial=0)).bit_length()))):
            longer = np.minimum(size + step, most)
            size = np.where((longer > size) & self.equal(a, shift, longer), longer, size)
        return size

    def backward(self, a: np.ndarray, shift: np.ndarray, most: np.ndarray) -> np.ndarray:
        """How many words before ``a`` are those ``shift`` words later, ``most`` at most."""
        size = np.zeros(len(a), dtype=np.int64)
        for step in (1 << b for b in reversed(range(int(most.max(initial=0)).bit_length()))):
            longer = np.minimum(size + step, most)
            size = np.where((longer > size) & self.equal(a - longer, shift, longer), longer, size)
        return size


def crossing(word: np.ndarray, nodes: Nodes, matches: Matches, least_words: int, least_repeats: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(node, start, end, period) of the runs within each node that cross its boundary, by the node's first place.

    Half of a run lies on one side of the boundary, more than a period. So its period moves the two words at the boundary to
    equal ones on that side; a period that does so is tried, in both directions as far as the node goes.
    """
    for side in (-1, 1):
        reach = np.minimum(2 * (nodes.mid - nodes.lo if side < 0 else nodes.hi - nodes.mid) // least_repeats, (nodes.hi - nodes.lo) // least_repeats)
        reach = np.where(nodes.hi - nodes.lo >= least_words, reach, 0)
        some = np.flatnonzero(reach > 0)
        tasks = np.cumsum(reach[some]) // BATCH_PERIODS
        for few in np.split(some, np.flatnonzero(np.diff(tasks)) + 1):
            node = np.repeat(few, reach[few])
            period = ranges(np.ones(len(few), dtype=np.int64), reach[few])
            mid = nodes.mid[node]
            fits = (word[mid] == word[mid + side * period]) & (word[mid - 1] == word[mid - 1 + side * period])
            node, period = node[fits], period[fits]
            a = nodes.mid[node] - 1 - (period if side < 0 else 0)  # a and a + 1 are the same a period later
            start = a - matches.backward(a, period, a - nodes.lo[node])
            end = a + 2 + period
            end = end + matches.forward(a + 2, period, nodes.hi[node] - end)
            long = end - start >= np.maximum(least_words, least_repeats * period)
            yield node[long], start[long], end[long], period[long]


def smallest(group: np.ndarray, start: np.ndarray, end: np.ndarray, period: np.ndarray) -> np.ndarray:
    """The rows of the smallest period of each (group, start, end): the others are its multiples."""
    order = np.lexsort((period, end, start, group))
    g, s, e = group[order], start[order], end[order]
    return order[np.append(True, (g[1:] != g[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1]))[: len(order)]]


def merged(start: np.ndarray, end: np.ndarray, period: np.ndarray) -> tuple[np.ndarray, ...]:
    """Intervals of one period that share a period's words are one run; then the smallest period of each stretch."""
    order = np.lexsort((end, start, period))
    start, end, period = start[order], end[order], period[order]
    if not len(start):
        return start, end, period
    kind = np.cumsum(np.append(False, period[1:] != period[:-1]))
    wide = int(end.max()) + 1
    reach = np.maximum.accumulate(end + kind * wide) - kind * wide  # the furthest end of this period so far
    fresh = np.append(True, (kind[1:] != kind[:-1]) | (start[1:] > reach[:-1] - period[1:]))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(start)) - 1
    start, end, period = start[first], reach[last], period[first]
    keep = smallest(np.zeros(len(start), dtype=np.int64), start, end, period)
    return start[keep], end[keep], period[keep]


def runs_of_words(
    word: np.ndarray, text: np.ndarray, least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs, sorted by start and period; places count through all texts.

    ``word`` has the numbers of the words of all texts in a row, ``text`` that of each word's text.
    """
    if least_words < 2 or least_repeats < 3:
        raise ValueError("a run has at least two words, and its period three times")
    p = cut(word, text, least_words, least_repeats)
    nodes = grammar(p)
    for salt in itertools.count(1):
        matches = Matches(p.word, salt)
        parts = list(crossing(p.word, nodes, matches, least_words, least_repeats))
        node, start, end, period = (np.concatenate([x[c] for x in parts] or [np.zeros(0, dtype=np.int64)]).astype(np.int64) for c in range(4))
        keep = smallest(node, start, end, period)
        node, start, end, period = node[keep], start[keep], end[keep], period[keep]
        times = nodes.count[node]
        moved = nodes.place[ranges(nodes.first[node], times)] - np.repeat(nodes.lo[node], times)
        start, end, period = merged(np.repeat(start, times) + moved, np.repeat(end, times) + moved, np.repeat(period, times))
        inside = ranges(start, end - period - start)
        if np.array_equal(p.word[inside], p.word[inside + np.repeat(period, end - period - start)]):
            break  # else two stretches had one hash: again with other hashes
    order = np.lexsort((period, start))
    start, end, period = start[order], end[order], period[order]
    return p.at[start], end - start, period


def collapse(words: Sequence[bytes], runs: Sequence[tuple[int, int, int]]) -> bytes:
    """The words but those that a run has after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    step = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        step[start + period] += 1
        step[start + length] -= 1
    return b" ".join(itertools.compress(words, (np.cumsum(step)[:-1] == 0).tolist()))


def text_runs(
    texts: Sequence[bytes | None], least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS
) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of every text, and its collapsed text."""
    found: list[list[tuple[int, int, int]]] = []
    short: list[bytes] = []
    batch: list[list[bytes]] = []
    size = 0

    def work() -> None:
        names: dict[bytes, int] = defaultdict(itertools.count().__next__)
        numbers = np.fromiter((names[w] for words in batch for w in words), dtype=np.int64, count=size)
        sizes = np.array([len(words) for words in batch])
        before = np.cumsum(sizes) - sizes
        start, length, period = runs_of_words(numbers, np.repeat(np.arange(len(batch)), sizes), least_words, least_repeats)
        of = np.searchsorted(before, start, side="right") - 1
        mine: dict[int, list] = defaultdict(list)
        for k, *run in zip(of.tolist(), (start - before[of]).tolist(), length.tolist(), period.tolist(), strict=True):
            mine[k].append(tuple(run))
        found.extend(mine.get(k, []) for k in range(len(batch)))
        short.extend(collapse(words, mine.get(k, [])) for k, words in enumerate(batch))

    for text in texts:
        batch.append((text or b"").split())
        size += len(batch[-1])
        if size > BATCH_WORDS:
            work()
            batch, size = [], 0
    if batch:
        work()
    return found, short


def periodic_runs(docs: DataFrame, *, text: str = "text", least_words: int = LEAST_WORDS, least_repeats: int = LEAST_REPEATS) -> DataFrame:
    """``docs`` with ``runs`` (array of start, length, period, by start and period) and the ``collapsed`` text.

    Words are split at space and U+0009 to U+000D and counted from 0. ``collapsed`` has a run's first period only, words
    joined by a space. A null text has no words: no runs and an empty collapsed text, as an empty one. Every row has its
    result whatever repeats; an empty table gives none; columns of these names are replaced.
    """
    raw = hidden("raw")
    source = docs.withColumn(raw, F.col(f"`{text}`").cast("binary"))
    fields = [("runs", T.ArrayType(RUN, False)), ("collapsed", T.BinaryType())]

    def compute(texts: list[bytes | None]) -> tuple[list, list]:
        runs, short = text_runs(texts, least_words, least_repeats)
        return [[dict(zip(RUN.names, r, strict=True)) for r in some] for some in runs], short

    made = add_columns(source, [raw], fields, compute).drop(raw)
    return made.withColumn("collapsed", F.col("collapsed").cast("string"))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs``, in one of ten texts of which, chosen by the id's crc32, the words from some place on repeat a stretch.

    A changed text is its words joined by a space.
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words, n, a, p = (hidden(c) for c in ("words", "n", "a", "p"))
    g = F.floor(h / 10)
    split = F.when(h % 10 == 0, F.expr(r"regexp_extract_all(text, r'[^\x20\x09-\x0D]+', 0)"))
    made = docs.withColumn(words, split).withColumn(n, F.size(words).cast("long"))
    made = made.withColumn(a, F.when(F.col(n) > 0, g % F.col(n)).cast("int"))
    made = made.withColumn(p, (1 + F.floor((F.col(n) - F.col(a)) / (3 + g % 8))).cast("int"))
    rest = (F.col(n) - F.col(a)).cast("int")
    unit = F.slice(words, F.col(a) + 1, F.col(p))
    again = F.slice(F.flatten(F.array_repeat(unit, F.ceil(rest / F.col(p)).cast("int"))), F.lit(1), rest)
    changed = F.concat_ws(" ", F.slice(words, F.lit(1), F.col(a)), again)
    text = F.when(F.col(a).isNotNull(), changed).otherwise(F.col("text"))
    return made.withColumn("text", text).drop(words, n, a, p)


def run_digest() -> list[Column]:
    """The number of ``runs``, the longest of them, and hashes of all runs and of the ``collapsed`` text."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    line = F.transform("runs", lambda r: F.concat_ws(",", *(r[c].cast("string") for c in RUN.names)))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return [
        F.size("runs").cast("long").alias("n_runs"),
        (-best["s"]).alias("start"),
        best["length"].alias("length"),
        (-best["p"]).alias("period"),
        F.floor(1000 * best["length"] / -best["p"]).alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    ]
