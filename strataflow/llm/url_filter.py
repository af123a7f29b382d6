"""URL filter: rules by host and path, and boosted trees on lexical features for the rest.

The trees learn from labelled URLs: a bounded sample of those that a rule decides, and examples made
of syllables that differ by their build alone; no word counts for or against a URL. Suffix statistics are smoothed shares of blocked URLs among the
labelled ones of a suffix, each row's own label left out while training.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from math import log2
from random import Random
from string import ascii_lowercase, ascii_uppercase

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, without
from strataflow.llm.gbt import Trees, fit_trees

MAX_LABELLED = 4_000
MADE = 6_000
NAMES = (
    "length host_length path_length depth labels hyphens digits host_digits path_digits entropy host_entropy parameters "
    "fragment longest_label longest_run escapes vowels suffix_share domain_share"
).split()
SUFFIXES = "com net org info biz top edu uk ca io".split()


_PARTS, _PORT = re.compile(r"([^/?#]*)([^?#]*)(.*)", re.S), re.compile(r":[0-9]*$")
_LOWER = str.maketrans(ascii_uppercase, ascii_lowercase)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    def __str__(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What follows the first ``://``, split; both empty if there is none. A-Z in the host are lower-cased."""
    at = F.locate("://", F.coalesce(url, F.lit("")))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return F.translate(host, ascii_uppercase, ascii_lowercase), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; nulls if none does. Of equal lengths the first counts."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in reversed(sorted(rules, key=lambda r: -len(str(r)))):
        fits = ((host == r.host) | F.endswith(host, F.lit(f".{r.host}"))) & F.startswith(path, F.lit(r.path))
        rule, verdict = F.when(fits, F.lit(str(r))).otherwise(rule), F.when(fits, F.lit(r.verdict)).otherwise(verdict)
    return rule, verdict


def entropy(text: str) -> float:
    n = len(text)
    return -sum(c / n * log2(c / n) for c in Counter(text).values()) if n else 0.0


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host and path as in :func:`host_and_path`, and what follows the path."""
    host, path, tail = _PARTS.match((url or "").partition("://")[2]).groups()
    return host.translate(_LOWER), path, tail


def lexical(url: str | None) -> list[float]:
    """All values of ``NAMES`` but the last two; an empty or null URL has zeros."""
    url = url or ""
    low, (host, path, tail) = url.lower(), split_url(url)
    query = tail.partition("?")[2].partition("#")[0]
    digits = lambda s: sum(c.isdigit() for c in s) / max(len(s), 1)
    runs = [len(x) for x in re.findall(r"\w+", path)]
    return [
        float(len(url)),
        float(len(host)),
        float(len(path)),
        float(path.count("/")),
        float(host.count(".")),
        float(host.count("-")),
        digits(url),
        digits(host),
        digits(path),
        entropy(low),
        entropy(host),
        float(query.count("=")),
        float("#" in url),
        float(max(map(len, host.split(".")))),
        float(max(runs, default=0)),
        float(low.count("%")),
        sum(c in "aeiou" for c in host) / max(len(host), 1),
    ]


def suffixes(url: str | None) -> tuple[str, str]:
    """The last label of the host, and the last two, without a port."""
    labels = _PORT.sub("", split_url(url)[0]).split(".")
    return labels[-1], ".".join(labels[-2:])


@dataclass(frozen=True)
class UrlModel:
    trees: Trees
    share: float
    blocked: dict[str, tuple[float, float]]

    def suffix_share(self, key: str, own: float | None = None) -> float:
        """Share of blocked URLs, smoothed by 20 of average ones; ``own`` label left out."""
        total, n = self.blocked.get(key, (0.0, 0.0))
        if own is not None:
            total, n = total - own, n - 1
        return (total + 20 * self.share) / (n + 20)

    def rows(self, urls: Sequence[str | None], labels: Sequence[float] | None = None) -> np.ndarray:
        own = labels if labels is not None else [None] * len(urls)
        return np.array([
            [*lexical(u), *(self.suffix_share(k, y) for k in suffixes(u))] for u, y in zip(urls, own, strict=True)
        ]).reshape(-1, len(NAMES))

    def scores(self, urls: Sequence[str | None]) -> np.ndarray:
        """0 to 1, higher: likelier one to block."""
        return self.trees.probability(self.rows(urls))


def made_examples(n: int, seed: int = 5) -> list[tuple[str, float]]:
    """Labelled URLs that differ by their build alone; words, suffixes, languages and ids are dealt alike to both labels.

    Made to be found by machines: hosts joined of words or holding numbers, names without vowels, and
    deep paths of random parts with long queries. Made to be read: a name, in one label or two, and a path that may be long, but of words.
    """
    rng = Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve".split()
    word = lambda most=4: "".join(rng.choice(syllables) for _ in range(rng.randint(2, most)))
    consonants = lambda: "".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(rng.randint(8, 16)))
    number = lambda: str(rng.randint(1, 10 ** rng.randint(1, 8)))
    digits = lambda: rng.choice(["", "", word(2)[:1]]) + rng.choice("-./").join(number() for _ in range(rng.choice([1, 1, 2, 3])))
    part = lambda: digits() if rng.random() < 0.3 else rng.choice("-_").join(word() for _ in range(rng.randint(1, 6)))
    out = []
    for i in range(n):
        bad = i % 2
        name = word(6) if rng.random() < 0.5 else word()
        form = rng.random() if bad else 1.0
        if form < 0.5:
            name = "-".join(word(rng.choice([2, 3])) for _ in range(rng.choice([2, 2, 2, 3, 4])))
        elif form < 0.65:
            name = f"{name}{rng.choice(['', '-'])}{rng.randint(10, 99999999)}"
        elif form < 0.8:
            name = consonants()
        elif not bad and rng.random() < 0.02:
            name = f"{name}-{word()}"
        host = f"{rng.choice(['', 'www.', 'm.', 'blog.', 'docs.', 'en.'])}{name}.{rng.choice(['', '', 'example.', 'co.', 'ac.'])}{rng.choice(SUFFIXES)}"
        path = f"/{rng.choice(['en', 'de', 'fr', 'es'])}/{rng.randint(1, 99999)}{rng.choice(['', '/', '.html'])}"
        if bad and (form >= 0.8 or rng.random() < 0.2):
            path += "/" + "/".join(f"{word()}{rng.randint(0, 9999)}" for _ in range(rng.randint(2, 5)))
            path += "?" + "&".join(f"{word()}={rng.randint(0, 10**8)}" for _ in range(rng.randint(4, 7)))
        else:
            kind = rng.random()
            if kind < 0.2:
                path = rng.choice(["", "/"])
            elif kind < 0.6:  # headings, dates and numbers of articles as paths, alike for both
                path = "/" + "/".join(part() for _ in range(rng.randint(1, 4)))
                path = path.title() if rng.random() < 0.2 else path
            path += rng.choice(["", "", "#top", "?page=2&ref=x", "?utm_source=feed"])
        out.append((f"{rng.choice(['http', 'https'])}://{host}{path}", float(bad)))
    return out


def train_url_model(
    pages: DataFrame, rules: Sequence[Rule] = RULES, *, max_rows: int = MAX_LABELLED, made: int = MADE
) -> UrlModel:
    """Fits on at most ``max_rows`` different URLs that a rule decides, the same on every run, and ``made`` examples."""
    host, path = host_and_path(F.col("url"))
    rule, verdict = matching_rule(host, path, rules)
    ruled = pages.select("url", rule.alias("rule"), verdict.alias("verdict")).where("rule is not null").distinct()
    rows = ruled.orderBy(F.xxhash64("url"), "url").limit(max_rows).collect()
    examples = sorted((r["url"], float(r["verdict"] == "block")) for r in rows) + made_examples(made)
    urls, y = [u for u, _ in examples], np.array([b for _, b in examples])
    blocked: dict[str, list[float]] = {}
    for u, b in examples:
        for k in suffixes(u):
            entry = blocked.setdefault(k, [0.0, 0.0])
            entry[0] += b
            entry[1] += 1
    share = float(y.mean()) if len(y) else 0.5
    model = UrlModel(fit_trees(np.zeros((0, len(NAMES))), y[:0]), share, {k: (a, n) for k, (a, n) in blocked.items()})
    return UrlModel(fit_trees(model.rows(urls, y.tolist()), y, trees=80, depth=3), share, model.blocked)


def judge(pages: DataFrame, model: UrlModel, rules: Sequence[Rule] = RULES, limit: float = 0.5) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict`` and the model's ``score``.

    A null URL or one without ``://`` has an empty host and path and no rule; the model decides it as
    an empty URL. Repeated rows each get theirs, an empty table stays empty; input columns of
    those names are replaced.
    """
    base = without(pages, ("host", "path", "rule", "verdict", "score"))
    scored = add_columns(base, ["url"], [("score", T.DoubleType())], lambda urls: [model.scores(urls)])
    host, path = host_and_path(F.col("url"))
    split = scored.withColumns({"host": host, "path": path})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    guess = F.when(F.col("score") >= limit, F.lit("block")).otherwise(F.lit("allow"))
    return split.withColumns({"rule": rule, "verdict": F.coalesce(verdict, guess)})
