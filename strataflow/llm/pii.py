"""Personal data: fixed patterns, and a character-level bidirectional LSTM with CRF transitions.

The tagger is trained in numpy from labelled spans: windows of documents with the spans that the
patterns find, and made windows with forms that the patterns miss (numbers without a plus, dots
between digits, spelled-out addresses, IPv6) among dates, prices and versions. It reads
overlapping windows of the whole text. Each character takes its tag from the window in which
it is farthest from an edge, so spans that cross windows are decoded as one. Every kind of span
holds a digit, an ``@`` or a spelled-out one, so windows without any of these have no tags to
give and aren't read. A span of the tagger counts if its form checks out exactly.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from heapq import nsmallest
from ipaddress import ip_address
from random import Random

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns
from strataflow.llm.lstm import Adam, Params, backward, crf_decode, crf_gradient, forward, new_bilstm
from strataflow.llm.secret_scan import SPANS, Span, ordered, scan

KINDS = ("email", "ip", "card", "phone")
WINDOW, STRIDE = 64, 32
MAX_WINDOWS, MADE = 600, 1_400
_ANCHOR = re.compile(r"[0-9@]|\[at\]|\(at\)", re.IGNORECASE)
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _byte(digits: str) -> bool:
    """Whether the number is at most 255, with any zeros before it."""
    digits = digits.lstrip("0")
    return len(digits) <= 3 and int(digits or "0") <= 255


def base_spans(text: str) -> list[Span]:
    """The fixed kinds, leftmost and non-overlapping in each kind; matches that fail the check are dropped.

    The patterns are written so that they take linear time: a number can only start where a run of
    digits does, and an address is found from its ``@``.
    """
    found: list[Span] = []
    if "@" in text:
        after = 0
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > after and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            if start < m.start():
                found.append(("email", start, m.end()))
                after = m.end()
    found += [("ip", m.start(), m.end()) for m in _IP.finditer(text) if all(_byte(p) for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14 and 14 <= len(d := digits_of(m.group())) <= 19 and luhn(d):
            found.append(("card", m.start(), m.end()))
    if "+" in text:
        found += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text) if 10 <= len(digits_of(m.group())) <= 15]
    return found


_SPELLED = re.compile(
    r"[\w.%+-]+\s?(?:@|[\[(]\s?at\s?[\])])\s?[\w-]+(?:\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[\w-]+)*\s?(?:\.|[\[(]\s?dot\s?[\])])\s?[A-Za-z]{2,}",
    re.IGNORECASE,
)
_NUMBER = re.compile(r"\(?(?:00|0|\+)?\d[\d]*\)?(?:[\x20./-]{1,2}\(?\d+\)?){1,6}")


def checks_out(kind: str, text: str) -> bool:
    """Whether a span of the tagger has the exact form of its kind."""
    digits = digits_of(text)
    if kind == "email":
        return _SPELLED.fullmatch(text) is not None
    if kind == "ip":
        try:
            return bool(ip_address(text)) and text.count(":") != 2
        except ValueError:
            return False
    if kind == "card":
        return re.fullmatch(r"\d(?:[\x20./-]?\d)+", text) is not None and 13 <= len(digits) <= 19 and luhn(digits)
    return _NUMBER.fullmatch(text) is not None and 9 <= len(digits) <= 15 and not re.fullmatch(r"\d+(?:[./]\d+)*", text)


# --- windows ---------------------------------------------------------------------------------

_CODES = np.full(0x250, 3, dtype=np.int64)
_CODES[[9, 10, 11, 12, 13, 32]] = [1, 2, 1, 1, 2, 1]
_CODES[33:127] = np.arange(94) + 5
WIDTH, ALPHABET = 12, 99


def encode(text: str) -> np.ndarray:
    """A code for each code point: printable ASCII, white space, other letters, the rest; 0 is padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(points < 0x250, _CODES[np.minimum(points, 0x24F)], 4)


def window_starts(text: str) -> list[int]:
    """Starts of the windows that hold an anchor, multiples of the stride; the last may be short."""
    last = max(0, -(-(len(text) - WINDOW) // STRIDE)) if len(text) > WINDOW else 0
    at = set()
    for m in _ANCHOR.finditer(text):
        k = m.start() // STRIDE
        at |= {min(k, last), min(max(k - 1, 0), last)}
    return [k * STRIDE for k in sorted(at)]


def tags_of(spans: Sequence[Span], start: int, length: int) -> np.ndarray:
    """0 outside; 1 and 2 for the first and further characters of the first kind, and so on."""
    tags = np.zeros(length, dtype=np.int64)
    for kind, a, b in spans:
        k = 1 + 2 * KINDS.index(kind)
        x, y = max(a - start, 0), min(b - start, length)
        if x < y:
            tags[x:y] = k + 1
            if a >= start:
                tags[a - start] = k
    return tags


@dataclass(frozen=True)
class Tagger:
    embedding: np.ndarray
    network: Params
    moves: np.ndarray

    def tag(self, windows: Sequence[np.ndarray]) -> list[np.ndarray]:
        """The best tags of each encoded window, decoded in batches."""
        out: list[np.ndarray] = []
        for k in range(0, len(windows), 256):
            some = windows[k : k + 256]
            x, mask = padded(some)
            scores, _ = forward(self.network, self.embedding[x], mask)
            tags = crf_decode(scores, self.moves, mask)
            out += [tags[: len(w), i] for i, w in enumerate(some)]
        return out

    def spans(self, texts: Sequence[str]) -> list[list[Span]]:
        """What the tagger finds in whole texts, all windows of all texts in common batches."""
        codes: list[np.ndarray] = []
        at = []
        for n, text in enumerate(texts):
            for s in window_starts(text):
                at.append((n, s))
                codes.append(encode(text[s : s + WINDOW]))
        found: list[list[Span]] = [[] for _ in texts]
        stretch: list[tuple[int, np.ndarray]] = []
        for (n, s), tags in zip(at, self.tag(codes), strict=True):
            if stretch and (n != was or s > stretch[-1][0] + STRIDE):
                found[was] += reconciled(stretch)
                stretch = []
            stretch.append((s, tags))
            was = n
        if stretch:
            found[was] += reconciled(stretch)
        return found


def padded(windows: Sequence[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, windows))
    x = np.zeros((steps, len(windows)), dtype=np.int64)
    mask = np.zeros((steps, len(windows)), dtype=np.float32)
    for i, w in enumerate(windows):
        x[: len(w), i], mask[: len(w), i] = w, 1
    return x, mask


def reconciled(windows: Sequence[tuple[int, np.ndarray]]) -> list[Span]:
    """Spans of neighbouring windows: a character has the tag of the window that sees most on both its sides."""
    first, end = windows[0][0], max(s + len(t) for s, t in windows)
    tags, depth = np.zeros(end - first, dtype=np.int64), np.full(end - first, -1)
    for s, t in windows:
        here = np.minimum(np.arange(len(t)), np.arange(len(t))[::-1])
        part = slice(s - first, s - first + len(t))
        better = here > depth[part]
        tags[part] = np.where(better, t, tags[part])
        depth[part] = np.where(better, here, depth[part])
    spans, kind, start = [], 0, 0
    for i, t in enumerate([*tags.tolist(), 0]):
        now = (t + 1) // 2
        if kind and (now != kind or t % 2 == 1):
            spans.append((KINDS[kind - 1], first + start, first + i))
            kind = 0
        if now and not kind:
            kind, start = now, i
    return spans


def find_personal_data(texts: Sequence[str | None], tagger: Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and all spans of each whole text; what the tagger adds overlaps nothing else."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) if _ANCHOR.search(t) else [] for t in texts]
    added = tagger.spans(texts) if tagger else [[] for _ in texts]
    out = []
    for text, mine, more in zip(texts, base, added, strict=True):
        everything = list(mine)
        for kind, a, b in more:
            while a < b and text[a] in " \t\r\n.,;:!?\"'<>[]{}-/":
                a += 1
            while a < b and text[b - 1] in " \t\r\n.,;:!?\"'<>[]{}-/(":
                b -= 1
            if not any(x < b and a < y for _, x, y in everything) and checks_out(kind, text[a:b]):
                everything.append((kind, a, b))
        out.append((ordered(mine, KINDS), ordered(everything, KINDS)))
    return out


# --- training --------------------------------------------------------------------------------


def made_windows(n: int, seed: int = 3) -> list[tuple[str, list[Span]]]:
    """Labelled windows from random forms, with numbers that are no personal data among them."""
    rng = Random(seed)
    d = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    word = lambda: "".join(rng.choice("aeioustrnmlhdcgpbfvk") for _ in range(rng.randint(2, 8)))

    def email() -> str:
        at, dot = rng.choice([("@", "."), (" [at] ", " [dot] "), ("[at]", "."), (" (at) ", " (dot) "), ("@", ".")])
        return f"{word()}{rng.choice(['', '.', '_'])}{word()}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de', 'fr'])}"

    def ip() -> str:
        four = ".".join(str(rng.randint(0, 255)) for _ in range(4))
        return four if rng.random() < 0.6 else ":".join(f"{rng.randint(0, 65535):x}" for _ in range(8))

    def card() -> str:
        body = rng.choice("3456") + d(rng.choice([12, 14, 14, 14, 17]))
        number = next(body + c for c in "0123456789" if luhn(body + c))
        gap = rng.choice(["", "", " ", "-", "."])
        return gap.join(number[i : i + 4] for i in range(0, len(number), 4))

    def phone() -> str:
        form = rng.choice(["+{} ({}) {}-{}", "({1}) {2}-{3}", "{1}-{2}-{3}", "00{0} {1} {2} {3}", "+{} {} {} {}", "0{1}/{2} {3}", "{1} {2} {3}"])
        return form.format(rng.randint(1, 99), d(3), d(3), d(4))

    def other() -> str:
        year = rng.randint(1900, 2030)
        return rng.choice([
            f"{year}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}", f"{rng.randint(1, 28)}.{rng.randint(1, 12)}.{year}", f"{d(2)}:{d(2)}",
            f"${d(3)}.{d(2)}", f"{rng.randint(1, 9)}.{rng.randint(0, 20)}", f"v{rng.randint(1, 9)}.{d(1)}.{d(2)}", d(rng.randint(1, 12)),
            f"{year}-{year + 1}", f"p. {d(2)}-{d(3)}", f"#{d(5)}", f"@{word()}", "".join(rng.choice("0123456789abcdef") for _ in range(40)),
        ])

    makers = {"email": email, "ip": ip, "card": card, "phone": phone}
    out = []
    for _ in range(n):
        text, spans = "", []
        while len(text) < WINDOW - 8:
            kind = rng.choice([*KINDS, None, None])
            text += " ".join(word() for _ in range(rng.randint(0, 5))) + rng.choice([" ", " ", ": ", ", ", " (", "\n"])
            piece = makers[kind]() if kind else other()
            if kind:
                spans.append((kind, len(text), len(text) + len(piece)))
            text += piece + rng.choice([" ", " ", ". ", ", ", ") ", "\n"])
        out.append((text[:WINDOW], [s for s in spans if s[1] < WINDOW]))
    return out


def labelled_windows(docs: DataFrame, max_windows: int = MAX_WINDOWS) -> list[tuple[str, list[Span]]]:
    """At most ``max_windows`` different windows of documents with what the patterns find in them, the same on every run.

    They are those of the least hashes; each batch gives its own least ones, so few are shuffled.
    """
    window = T.StructType([T.StructField("hash", T.LongType()), T.StructField("text", T.StringType()), T.StructField("spans", SPANS)])

    def windows(texts: Sequence[str]) -> list[list]:
        least: dict[str, tuple] = {}
        for text in texts:
            spans = base_spans(text)
            for s in window_starts(text):
                part = text[s : s + WINDOW]
                inside = sorted((a - s, b - s, k) for k, a, b in spans if a < s + WINDOW and b > s)
                known = least.get(part)
                if known is None or inside < known[1]:
                    hashed = known[0] if known else int.from_bytes(xxhash.xxh64_digest(part.encode(), 42), "big", signed=True)
                    least[part] = (hashed, inside)
            if len(least) > 20 * max_windows:
                least = dict(nsmallest(max_windows, least.items(), key=lambda w: (w[1][0], w[0])))
        rows = nsmallest(max_windows, least.items(), key=lambda w: (w[1][0], w[0]))
        named = [{"hash": h, "text": t, "spans": [{"kind": k, "start": a, "end": b} for a, b, k in of]} for t, (h, of) in rows]
        return [named, *([] for _ in texts[1:])]

    marked = docs.select("text").where(F.col("text").rlike("[0-9@]"))
    found = add_columns(marked, ["text"], [("w", T.ArrayType(window))], lambda texts: [windows(texts)])
    each = found.select(F.explode("w").alias("w")).groupBy("w.hash", "w.text").agg(F.min("w.spans").alias("spans"))
    rows = each.orderBy("hash", "text").limit(max_windows).collect()
    return [(r["text"], [(s["kind"], s["start"], s["end"]) for s in r["spans"]]) for r in rows]


def fit_tagger(examples: Sequence[tuple[str, list[Span]]], *, hidden: int = 20, epochs: int = 6, seed: int = 1) -> Tagger:
    """Adam on the CRF's likelihood, in batches of 24 windows."""
    rng = np.random.default_rng(seed)
    embedding = rng.normal(0, 0.3, (ALPHABET, WIDTH)).astype(np.float32)
    network, moves = new_bilstm(rng, WIDTH, hidden, 1 + 2 * len(KINDS)), np.zeros((9, 9), np.float32)
    tagger = Tagger(embedding, network, moves)
    data = [(encode(t), tags_of(spans, 0, len(t))) for t, spans in examples if t]
    adam = Adam(0.02)
    for epoch in range(epochs):
        adam.rate = 0.02 * 0.65**epoch
        order = rng.permutation(len(data))
        for k in range(0, len(order), 24):
            some = [data[i] for i in order[k : k + 24]]
            x, mask = padded([w for w, _ in some])
            tags, _ = padded([t for _, t in some])
            scores, memory = forward(network, embedding[x], mask, keep=True)
            _, d_scores, d_moves = crf_gradient(scores, tags, moves, mask)
            grads, d_x = backward(network, memory, d_scores)
            once = np.zeros((x.size, ALPHABET), np.float32)
            once[np.arange(x.size), x.ravel()] = 1
            grads |= {"embedding": once.T @ d_x.reshape(-1, WIDTH), "moves": d_moves}
            adam.step({**network, "embedding": embedding, "moves": moves}, grads)
    return tagger


def train_tagger(docs: DataFrame, *, max_windows: int = MAX_WINDOWS, made: int = MADE) -> Tagger:
    return fit_tagger(labelled_windows(docs, max_windows) + made_windows(made))


def scan_personal_data(docs: DataFrame, tagger: Tagger) -> DataFrame:
    """``docs`` with ``base`` and ``found``: arrays of (kind, start, end) in code points, end exclusive.

    Whole texts are read; a null or empty text has no spans. Repeated rows each get theirs; input
    columns named ``base`` or ``found`` are replaced. An empty table stays empty.
    """
    return scan(docs, lambda texts: find_personal_data(texts, tagger))
