"""Toxicity: boosted trees over dense features with isotonic calibration.

The lexicon is a short list of insults and what the labels add to it: words and word beginnings that
labelled toxic documents have and clean ones hardly ever. The trees are fitted to features that
use, for each half of the sample, the lexicon learned from the other half, so they see no
lexicon fitted to their own rows. Calibration uses scores of rows unseen by the scoring trees.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from math import log, log1p
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, hidden, labelled_sample, memories, ship_package, written
from strataflow.llm.gbt import Isotonic, Trees, fit_isotonic, fit_trees

MAX_TRAINING_ROWS = 16_000
MAX_LEARNED = 4_000
INSULTS = frozenset("idiot moron loser stupid pathetic worthless scum clown trash disgusting imbecile dumb jerk".split())
SECOND_PERSON = frozenset(
    "you your yours yourself youre du dich dir dein deine euch tu te toi ton ta tes vous votre vos usted ustedes tus ti".split()
)
OBFUSCATED = re.compile(r"[^\W\d_]+[0-9@$*]+[^\W\d_]+|[^\W\d_]\*{2,}")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
WORD = re.compile(r"\w+")
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
NEAR = 4
NAMES = (
    "hits distinct_hits hit_share weight_share strongest listed learned_words learned_beginnings close_to_you you_share "
    "upper capital_words bangs asks symbols obfuscated stretched words tightest"
).split()


MAX_MEMO = 200_000  # tokens remembered in a worker while it scores; more are looked at again


class Token(NamedTuple):
    """What the features need of a token between blanks."""

    words: int
    weight: float
    hit: str
    listed: bool
    whole: bool
    you: bool
    shouting: bool
    obfuscated: bool
    stretched: bool


@dataclass(frozen=True)
class Lexicon:
    """Weights of whole words and of word beginnings."""

    words: dict[str, float]
    beginnings: dict[str, float]
    name: str = field(default_factory=lambda: uuid.uuid4().hex, compare=False)
    memo: dict[str, Token] = field(default_factory=dict, compare=False, repr=False)

    def __getstate__(self) -> dict:
        return {"words": self.words, "beginnings": self.beginnings, "name": self.name}

    def __setstate__(self, state: dict) -> None:
        """A worker process keeps what it remembers of a lexicon from task to task of a step."""
        self.__dict__.update(state, memo=memories.setdefault(state["name"], {}))

    def weight(self, word: str) -> float:
        """0 for a word that isn't in it."""
        return max(self.words.get(word, 0.0), *(self.beginnings.get(word[:k], 0.0) for k in (4, 5, 6)))

    def token(self, raw: str) -> Token:
        known = self.memo.get(raw)
        if known is None:
            plain = raw.isalpha()
            words = [raw.lower()] if plain else WORD.findall(raw.lower())
            weight, hit = max([(self.weight(w), w) for w in words], default=(0.0, ""))
            known = Token(
                len(words),
                weight,
                hit if weight else "",
                hit in INSULTS,
                hit in self.words,
                not SECOND_PERSON.isdisjoint(words),
                len(raw) > 1 and raw.isupper(),
                not plain and OBFUSCATED.search(raw) is not None,
                STRETCHED.search(raw) is not None,
            )
            if len(self.memo) >= MAX_MEMO:
                self.memo.clear()
            self.memo[raw] = known
        return known


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """The values of ``NAMES`` for a whole text; all zeros for null, empty or wordless texts."""
    text = text or ""
    raw = text.split()
    seen = [(lexicon.token(w), c) for w, c in Counter(raw).items()]
    n = sum(t.words * c for t, c in seen)
    if not n:
        return [0.0] * len(NAMES)
    hits = [(t, c) for t, c in seen if t.weight]
    count = sum(c for _, c in hits)
    you = sum(c for t, c in seen if t.you)
    close, tight = 0, 0.0
    if hits:
        at = np.array([i for i, w in enumerate(raw) if lexicon.token(w).weight])
        tight = float(max(np.searchsorted(at, at + 25, side="left") - np.arange(len(at)))) / 25
        if you:
            mine = np.array([i for i, w in enumerate(raw) if lexicon.token(w).you])
            spot = np.searchsorted(mine, at)
            gap = np.minimum(np.abs(mine[np.minimum(spot, len(mine) - 1)] - at), np.abs(mine[np.maximum(spot - 1, 0)] - at))
            close = int((gap <= NEAR).sum())
    size, tokens = len(text), len(raw)
    return [
        float(count),
        float(len({t.hit for t, _ in hits})),
        count / n,
        sum(t.weight * c for t, c in hits) / n,
        max((t.weight for t, _ in hits), default=0.0),
        float(sum(c for t, c in hits if t.listed)),
        float(sum(c for t, c in hits if t.whole)),
        float(sum(c for t, c in hits if not t.whole)),
        close / max(count, 1),
        you / n,
        sum(map(text.count, UPPER)) / size,
        sum(c for t, c in seen if t.shouting) / tokens,
        text.count("!") / size,
        text.count("?") / size,
        sum(map(text.count, "#$%&*@")) / size,
        sum(c for t, c in seen if t.obfuscated) / tokens,
        sum(c for t, c in seen if t.stretched) / tokens,
        log1p(n),
        tight,
    ]


@dataclass(frozen=True)
class ToxicityModel:
    lexicon: Lexicon
    trees: Trees
    calibration: Isotonic

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.calibration(self.trees.raw(np.array([features(t, self.lexicon) for t in texts])))


def learn_lexicon(sample: DataFrame, *, max_words: int = MAX_LEARNED, support: int = 5, odds: float = 12.0) -> Lexicon:
    """Words and beginnings of 4 to 6 letters in ``support`` toxic documents or more, and ``odds`` times likelier there.

    Equal texts count once. Counts are summed in each task before the shuffle; at most
    ``max_words`` entries reach the driver, the best supported first.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            toxic: Counter = Counter()
            clean: Counter = Counter()
            for text, y in zip(batch["text"], batch["y"], strict=True):
                words = set(WORD.findall((text or "").lower()))
                (toxic if y else clean).update({f"{w} " for w in words} | {w[:k] for w in words for k in (4, 5, 6) if len(w) > k})
            tokens = list(toxic.keys() | clean.keys())
            yield pd.DataFrame({"token": tokens, "t": [toxic[w] for w in tokens], "c": [clean[w] for w in tokens]})

    ship_package(sample.sparkSession)
    texts = sample.groupBy("text").agg(F.max("y").alias("y"))
    totals = texts.agg(F.coalesce(F.sum("y"), F.lit(0)).alias("t"), F.count(F.lit(1)).alias("n")).first()
    n_toxic, n_clean = totals["t"], totals["n"] - totals["t"]
    counts = texts.mapInPandas(count, "token string, t long, c long").groupBy("token").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    ratio = ((F.col("t") + 0.5) / (n_toxic + 1.0)) / ((F.col("c") + 0.5) / (n_clean + 1.0))
    best = counts.where((F.col("t") >= support) & (ratio >= odds)).orderBy(F.desc("t"), "token").limit(max_words).collect()
    weigh = lambda r: min(6.0, log((r["t"] + 0.5) / (n_toxic + 1.0) / ((r["c"] + 0.5) / (n_clean + 1.0))))
    words = {r["token"][:-1]: weigh(r) for r in best if r["token"].endswith(" ")}
    beginnings = {r["token"]: weigh(r) for r in best if not r["token"].endswith(" ")}
    return Lexicon(dict.fromkeys(INSULTS, 4.0) | words, beginnings)


def _featured(sample: DataFrame, lexicon: Lexicon) -> DataFrame:
    field = ("x", T.ArrayType(T.DoubleType()))
    return add_columns(sample, ["text"], [field], lambda texts: [[features(t, lexicon) for t in texts]]).select("doc_id", "x", "y")


def train_toxicity(
    documents: DataFrame, labels: DataFrame, *, usable: Column | None = None, max_rows: int = MAX_TRAINING_ROWS
) -> ToxicityModel:
    """Fits on at most ``max_rows`` labelled documents; only their features are gathered.

    ``usable`` is a condition on ``labels`` that says what may be learned from. Null labels and
    ids are left out. Without any labels the scores are those of an untrained model, 0.5.
    """
    sample = labelled_sample(documents, labels, "toxic", F.lit(True) if usable is None else usable, max_rows)
    sample = written(sample, "toxicity-sample")
    half = F.pmod(F.xxhash64("text"), F.lit(2)) == 0
    parts = (sample.where(half), sample.where(~half))
    rows = []
    for part, lexicon in zip(parts, map(learn_lexicon, reversed(parts)), strict=True):
        rows += _featured(part, lexicon).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, len(NAMES))
    y = np.array([r["y"] for r in rows], dtype=float)
    fold = np.arange(len(y)) % 3
    unseen = np.zeros(len(y))
    for k in range(3 if len(y) >= 30 else 0):
        unseen[fold == k] = fit_trees(x[fold != k], y[fold != k], trees=60, depth=3).raw(x[fold == k])
    calibration = fit_isotonic(unseen, y) if len(y) >= 30 else fit_isotonic(np.zeros(0), y)
    return ToxicityModel(learn_lexicon(sample), fit_trees(x, y, trees=60, depth=3), calibration)


def score_toxicity(docs: DataFrame, model: ToxicityModel, column: str = "score") -> DataFrame:
    """``docs`` with ``column``, 0 to 1, from the whole ``text`` alone; null texts score as empty ones.

    Every row gets a score, repeated rows the same one; an input column of that name is replaced.
    """
    return add_columns(docs, ["text"], [(column, T.DoubleType())], lambda texts: [model.scores(texts)])


def drop_toxic(docs: DataFrame, model: ToxicityModel, limit: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score under ``limit``, with their columns."""
    score = hidden("score")
    return score_toxicity(docs, model, score).where(F.col(score) < limit).drop(score)
