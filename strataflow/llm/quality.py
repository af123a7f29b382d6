"""Quality classifier: boosted trees over statistics of the whole text."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from math import log1p

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, labelled_sample
from strataflow.llm.gbt import Trees, fit_trees

MAX_TRAINING_ROWS = 12_000
NAMES = (
    "chars words word_length long_words upper digits symbols stops commas spaces bars bangs other_bytes lines "
    "line_words repeated_lines distinct_words repeated_pairs repeated_triples top_word top_triple unending_lines "
    "sentence_words capital_words symbol_words one_letter_words"
).split()
_BYTES = {
    "upper": range(65, 91),
    "digits": range(48, 58),
    "symbols": b"#$%&*@^_~|<>{}[]\\/=+",
    "stops": b".?",
    "commas": b",;:",
    "spaces": b" \t\n\r",
    "bars": b"|",
    "bangs": b"!",
    "other_bytes": range(128, 256),
}
_PICK = np.zeros((256, len(_BYTES)))
for _column, _codes in enumerate(_BYTES.values()):
    _PICK[list(_codes), _column] = 1


def statistics(text: str | None) -> list[float]:
    """The values of ``NAMES``; a null text counts as empty, and an empty one is all zeros."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = text.split()
    if not words:
        return [log1p(len(text))] + [0.0] * (len(NAMES) - 1)
    n, size = len(words), len(raw)
    shares = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) @ _PICK / size
    lines = [x for x in text.split("\n") if x.strip()]
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    triples = Counter(zip(words, words[1:], words[2:], strict=False))
    ends = sum(map(text.count, (". ", ".\n", "? ", "! "))) + 1
    return [
        log1p(len(text)),
        log1p(n),
        sum(map(len, words)) / n,
        sum(c for w, c in seen.items() if len(w) > 14) / n,
        *shares.tolist(),
        log1p(len(lines)),
        log1p(n / len(lines)),
        1 - len(set(lines)) / len(lines),
        len(seen) / n,
        1 - pairs / max(n - 1, 1),
        1 - len(triples) / max(n - 2, 1),
        max(seen.values()) / n,
        (max(triples.values()) if triples else 0) / n,
        sum(x[-1] not in ".!?" for x in lines) / len(lines),
        log1p(n / ends),
        sum(c for w, c in seen.items() if len(w) > 1 and w.isupper()) / n,
        sum(c for w, c in seen.items() if not w[-1].isalnum() and w[-1] not in ".,;:!?\"')") / n,
        sum(c for w, c in seen.items() if len(w) == 1) / n,
    ]


@dataclass(frozen=True)
class QualityModel:
    trees: Trees

    def scores(self, texts: Sequence[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        return self.trees.probability(np.array([statistics(t) for t in texts]))


def train_quality(
    documents: DataFrame, labels: DataFrame, *, usable: Column | None = None, max_rows: int = MAX_TRAINING_ROWS
) -> QualityModel:
    """Fits on at most ``max_rows`` labelled documents; executors make the statistics, only those are gathered.

    ``usable`` is a condition on ``labels`` that says what may be learned from. Null labels and
    ids are left out. Without any labels every score is one half.
    """
    sample = labelled_sample(documents, labels, "quality", F.lit(True) if usable is None else usable, max_rows)
    rows = add_columns(
        sample, ["text"], [("x", T.ArrayType(T.DoubleType()))], lambda texts: [[statistics(t) for t in texts]]
    ).select("doc_id", "x", "y").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, len(NAMES))
    return QualityModel(fit_trees(x, np.array([r["y"] for r in rows], dtype=float)))


def score_quality(docs: DataFrame, model: QualityModel, column: str = "score") -> DataFrame:
    """``docs`` with ``column``, 0 to 1, from the whole ``text`` alone; null texts score as empty ones.

    Every row gets a score, repeated rows the same one; an input column of that name is replaced.
    """
    return add_columns(docs, ["text"], [(column, T.DoubleType())], lambda texts: [model.scores(texts)])
