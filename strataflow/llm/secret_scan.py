"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

A candidate is a run of characters that keys and tokens are made of. For every class of
characters, a window slides over the runs of that class; its Shannon entropy comes from the counts of
its characters, which each step changes by one out and one in. Windows over the limit of
their class are joined to spans, and spans of several classes that overlap to one. Of a span, what allow-listed strings
cover isn't reported. A span that a pattern's match covers says nothing new; one that goes beyond it is reported whole.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from hashlib import sha256
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns

Span = tuple[str, int, int]

KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a maximal run of 16 or more: the same as dropping shorter maximal runs
_NAMES = ("passw", "secret", "token", "api")


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``pattern`` are searched by windows of ``window`` characters with ``bits`` of entropy or more."""

    pattern: re.Pattern
    window: int
    bits: float
    mixed: int  # of lower case, upper case and digits, so many must occur


CLASSES = (
    CharacterClass(re.compile(r"[0-9A-F]{24,}"), 24, 3.0, 2),
    CharacterClass(re.compile(r"[a-z0-9]{20,}"), 20, 3.4, 2),
    CharacterClass(re.compile(r"[A-Z0-9]{20,}"), 20, 3.4, 2),
    CharacterClass(re.compile(r"[A-Za-z0-9]{20,}"), 20, 3.6, 3),
    CharacterClass(re.compile(r"[A-Za-z0-9+/=_-]{24,}"), 24, 3.9, 3),
)
#: Strings that look random but are none: paths and links, ids in standard forms, sample values, alphabets.
_PART = r"(?:[A-Z]?[a-z]++(?:[A-Z][a-z]{2,}+)*+\d{0,4}+|\d{1,4}+)"  # of a path: words, and numbers of few digits
ALLOWED = (
    re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", re.IGNORECASE),
    re.compile(r"example|sample|dummy|placeholder|lorem|xxxx|abcdefgh|qwerty|0123456|1234567|sha\d{3}-", re.IGNORECASE),
    re.compile(rf"(?<![a-z])(?:(?:[a-z]{{2,}}[-_/+]){{3,}}|[a-z]{{8,}}+\d{{1,4}}+[a-z]{{8,}})|(?:[A-Z]?[a-z]{{3,}}){{4,}}|(?:/{_PART}(?:[-_.]{_PART})*+(?![A-Za-z0-9])){{3,}}/?"),
)


def base_spans(text: str) -> list[Span]:
    """The fixed kinds, leftmost and non-overlapping in each kind; matches that fail the length are dropped."""
    found = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def high_entropy(run: str, window: int, bits: float) -> list[tuple[int, int]]:
    """Spans of ``run`` that windows of ``bits`` or more cover, by counts that change with each step."""
    if len(run) < window:
        return []
    part = [0.0] + [c * log2(c) for c in range(1, window + 1)]  # entropy = log2(window) - sum(part) / window
    counts: dict[str, int] = {}
    total = 0.0
    limit = (log2(window) - bits) * window + 1e-9
    spans: list[tuple[int, int]] = []
    for end, new in enumerate(run, 1):
        c = counts.get(new, 0)
        counts[new] = c + 1
        total += part[c + 1] - part[c] if c < window else 0.0
        start = end - window
        if start > 0:
            old = run[start - 1]
            c = counts[old]
            counts[old] = c - 1
            total += part[c - 1] - part[c] if c <= window else 0.0
        if start >= 0 and total <= limit:
            if spans and start <= spans[-1][1]:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((start, end))
    return spans


def joined(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """``spans`` in order, overlapping ones as one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def not_allowed(run: str, kind: CharacterClass) -> list[tuple[int, int]]:
    """The spans of high entropy of ``run`` without what the allow list covers.

    Allow-listed matches as long as a window are cut out. A piece with shorter ones stays whole, unless
    they are over half of it and the rest alone has no window of high entropy.
    """
    spans = high_entropy(run, kind.window, kind.bits)
    known = joined(m.span() for a in ALLOWED for m in a.finditer(run)) if spans else []
    if not known:
        return spans
    out, first = [], 0
    for a, b in spans:
        while first < len(known) and known[first][1] <= a:
            first += 1
        inside, k = [], first
        while k < len(known) and known[k][0] < b:
            inside.append((max(known[k][0], a), min(known[k][1], b)))
            k += 1
        cuts = [(x, y) for x, y in inside if y - x >= kind.window]
        small = [(x, y) for x, y in inside if y - x < kind.window]
        at = 0
        for x, y in zip([a, *(y for _, y in cuts)], [*(x for x, _ in cuts), b], strict=True):
            if cuts and not high_entropy(run[x:y], kind.window, kind.bits):
                continue
            while at < len(small) and small[at][1] <= x:
                at += 1
            rest, covered, end = [], 0, x
            while at < len(small) and small[at][0] < y:
                rest.append(run[end : small[at][0]])
                covered, end = covered + small[at][1] - small[at][0], small[at][1]
                at += 1
            rest.append(run[end:y])
            if 2 * covered <= y - x or high_entropy("".join(rest), kind.window, kind.bits):
                out.append((x, y))
    return out


def entropy_spans(text: str, taken: Sequence[Span], classes: Sequence[CharacterClass] = CLASSES) -> list[Span]:
    """Added spans of all classes: not allow-listed, those that overlap are one, none that ``taken`` covers whole."""
    found: list[tuple[int, int]] = []
    for kind in classes:
        for m in kind.pattern.finditer(text):
            run = m.group()
            looks = any(map(str.isdigit, run)) + any(map(str.isupper, run)) + any(map(str.islower, run))
            if looks >= kind.mixed:
                found += [(a + m.start(), b + m.start()) for a, b in not_allowed(run, kind)]
    base = joined((a, b) for _, a, b in taken)
    ends = [b for _, b in base]
    added = []
    for a, b in joined(found):
        near = bisect_left(ends, b)  # the first that ends at b or later
        if near == len(base) or base[near][0] > a:
            added.append(("entropy", a, b))
    return added


def ordered(spans: Sequence[Span], kinds: Sequence[str]) -> list[Span]:
    rank = {k: i for i, k in enumerate(kinds)}
    return sorted(spans, key=lambda s: (s[1], rank[s[0]], s[2]))


def written_out(spans: Sequence[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def digest(spans: Sequence[Span]) -> str:
    return sha256(written_out(spans).encode()).hexdigest()


SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
)


def find_secrets(text: str | None) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans of a whole text, ordered by start, then kind; none for null."""
    base = base_spans(text or "")
    return ordered(base, KINDS), ordered(base + entropy_spans(text or "", base), KINDS)


Find = Callable[[Sequence[str | None]], list[tuple[list[Span], list[Span]]]]


def scan(docs: DataFrame, find: Find = lambda texts: [find_secrets(t) for t in texts]) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (kind, start, end) in code points, end exclusive.

    Whole texts are read; a null text has no spans. Repeated rows each get theirs; input columns
    named ``base`` or ``found`` are replaced. An empty table stays empty.
    """

    def compute(texts: Sequence[str | None]) -> list[list]:
        named = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]
        both = find(texts)
        return [[named(b) for b, _ in both], [named(a) for _, a in both]]

    return add_columns(docs, ["text"], [("base", SPANS), ("found", SPANS)], compute)


def digest_columns(kinds: Sequence[str]) -> list[Column]:
    """A count for each of ``kinds`` in the column ``base``, its digest, and all spans of ``found`` as text."""
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return [*map(count, kinds), F.sha2(written("base"), 256).alias("base_sha256"), written("found").alias("spans")]


def masked(text: str | None, spans: Sequence[Span], mask: str = "[secret]") -> str | None:
    """``text`` with every stretch that spans cover replaced by ``mask``."""
    if not text or not spans:
        return text
    out, at = [], 0
    for _, a, b in sorted(spans, key=lambda s: s[1]):
        if a >= at:
            out += [text[at:a], mask]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with secrets in ``text`` masked and, if there is a column ``n_chars``, it counted anew.

    No row is dropped; rows without secrets and null texts stay as they are. Repeated rows are masked alike, an empty table
    stays empty, very long texts are read whole.
    """
    count = [c for c in docs.columns if c.lower() == "n_chars"]
    cleaned = add_columns(
        docs, ["text"], [("text", T.StringType())], lambda texts: [[masked(t, find_secrets(t)[1]) for t in texts]]
    )
    for c in count:
        kind = docs.schema[c].dataType
        cleaned = cleaned.withColumn(c, F.when(F.col("text").isNull(), F.col(c)).otherwise(F.length("text").cast(kind)))
    return cleaned.select([F.col(f"`{c}`") for c in docs.columns])
