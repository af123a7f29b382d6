"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: stretches of text between block-level tags. Each block becomes a vector of
its hashed tag path, its hashed words and a few measures; a bidirectional LSTM in numpy reads
the whole sequence of a page and scores every block in the light of all others.

There are no labelled pages, so the labels come from markup: blocks of a bounded sample of pages whose
path says ``article`` or ``footer``, and made pages in many layouts. In training, telling tags and
names are hidden at random, so the network learns to use the place of a block and its
neighbours as well.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache
from html import unescape
from math import log1p
from random import Random
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataflow.llm.common import add_columns, without
from strataflow.llm.lstm import Adam, Params, backward, forward, new_bilstm

MAX_PAGES, MADE = 250, 2_000
MAX_TRAINING_CHARS = 60_000
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr".split()
)
#: Drawings and formulas: their own tags are no blocks; a tag of ``BREAKS_OUT`` ends them, as in browsers.
FOREIGN = frozenset(("svg", "math"))
BREAKS_OUT = frozenset(
    "address article aside b big blockquote body br center code dd div dl dt em embed fieldset figure footer form h1 h2 h3 h4 h5 h6 head header hr i "
    "img li listing main menu meta nav nobr ol p pre ruby s section small span strike strong sub sup table tt u ul var foreignobject".split()
)
#: These may stand within a paragraph, which goes on behind them.
WITHIN = frozenset("noscript template svg iframe object select textarea".split())
CLOSES = dict.fromkeys(WITHIN, frozenset()) | {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: Tags and words of class and id attributes that say what a part of a page is for.
MAIN = frozenset("article main".split())
MAIN_WORDS = frozenset("article content post entry story body main".split())
OTHER = frozenset("head title nav header footer aside form button dialog menu".split())
OTHER_WORDS = frozenset(
    "nav menu header footer foot sidebar side aside ad ads advert advertisement sponsor promo banner cookie consent notice "
    "comment comments reply replies respond share social related form login signup subscribe newsletter breadcrumb "
    "pagination popup modal toolbar copyright widget".split()
)
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(?P<raw>script|style)(?=[\s/>])(?:[^"'>]++|"[^"]*+"|'[^']*+')*+>.*?(?:</(?P=raw)(?=[\s/>])[^>]*>|\Z)"""
    r"""|<(?P<end>/)?(?P<tag>[a-zA-Z][^\s/>]*+)(?=[\s/>])(?P<rest>(?:[^"'>]++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*>|(?P<text>[^<]+|<)""",
    re.DOTALL | re.IGNORECASE,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.IGNORECASE)
PATH, WORDS = 256, 32
MEASURES = 10
WIDTH = PATH + WORDS + MEASURES


class Place:
    """An open element with those around it: what vectors need is carried along, so a deep path costs no more than a flat one."""

    __slots__ = ("around", "names", "slots", "length")

    def __init__(self, around: Place | None, names: tuple[str, ...]) -> None:
        self.around, self.names = around, names
        self.slots = around.slots if around else 0  # a bit for each hashed name
        for name in names:
            self.slots |= 1 << _slot(name, PATH)
        self.length = len(names) + (around.length if around else 0)

    def path(self) -> tuple[str, ...]:
        parts, at = [], self
        while at is not None:
            parts.append(at.names)
            at = at.around
        return tuple(name for names in reversed(parts) for name in names)


class Block:
    """The text of a leaf, how much of it is linked, and the names of the elements around it, outer ones first."""

    __slots__ = ("place", "text", "linked")

    def __init__(self, path: Place | Sequence[str], text: str, linked: int) -> None:
        self.place = path if isinstance(path, Place) else Place(None, tuple(path))
        self.text, self.linked = text, linked

    @property
    def path(self) -> tuple[str, ...]:
        return self.place.path()

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Block) and (self.path, self.text, self.linked) == (other.path, other.text, other.linked)


@lru_cache(maxsize=200_000)
def _slot(token: str, width: int) -> int:
    return crc32(token.encode("utf-8", "surrogatepass")) % width


@lru_cache(maxsize=20_000)
def _named(tag: str, rest: str) -> tuple[str, ...]:
    """The tag, and the words of its class, id and role."""
    words = [w.lower() for m in _NAMES.finditer(rest) for w in re.split(r"[\s_-]+", m[1] or m[2] or m[3] or "") if w]
    return (tag, *(f".{w}" for w in words))


def blocks(html: str | None) -> list[Block]:
    """The leaf blocks of a page in order; scripts, styles and comments are none. Null and empty pages have no blocks.

    All other elements are read, of which formulas belong to the block around them. Elements that aren't closed
    end with their parent.
    """
    out: list[Block] = []
    stack: list[tuple[str, Place]] = []  # inline elements have the place of what is around them
    top = Place(None, ())
    parts: list[str] = []
    linked = 0

    def end_block() -> None:
        nonlocal parts, linked
        text = " ".join(unescape("".join(parts)).split())
        if text:
            out.append(Block(stack[-1][1] if stack else top, text, linked))
        parts, linked = [], 0

    for m in _TOKEN.finditer(html or ""):
        text = m["text"]
        if text is not None:
            parts.append(text)
            if any(tag == "a" for tag, _ in stack[-4:]):
                linked += len(text)
            continue
        tag = m["tag"]
        if tag is None:
            if m["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        closed = tag in FOREIGN and m["rest"].endswith("/")
        if stack and stack[-1][0] in FOREIGN and tag not in FOREIGN:
            if not m["end"] and tag in BREAKS_OUT:
                if tag != "foreignobject":
                    if stack[-1][0] not in INLINE:
                        end_block()
                    del stack[-1]
            elif not m["end"] or all(t != tag for t, _ in stack):
                parts.append(" " if tag in ("text", "title", "desc", "annotation") else "")
                continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                parts.append(" " if tag == "br" else "")
            elif m["end"]:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == tag:
                        del stack[k]
                        break
                    if stack[k][0] not in INLINE:
                        break
            elif not closed:
                stack.append((tag, stack[-1][1] if stack else top))
            continue
        if closed:
            continue
        end_block()
        if m["end"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            shut = CLOSES.get(tag, () if "-" in tag else {"p"})
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in shut:
                    del stack[k:]
                    break
                if stack[k][0] not in INLINE:
                    break
            stack.append((tag, Place(stack[-1][1] if stack else top, _named(tag, m["rest"]))))
    end_block()
    return out


def vectors(page: Sequence[Block], hide: Random | None = None) -> np.ndarray:
    """A row for each block; ``hide`` leaves out the telling names of a page at random."""
    x = np.zeros((len(page), WIDTH), np.float32)
    # names must stay where only they tell a part within the article from the article
    gone = hide is not None and hide.random() < 0.25 and not any(taught(b) is False and _telling(b, MAIN, MAIN_WORDS) for b in page)
    n = max(len(page) - 1, 1)
    for i, b in enumerate(page):
        slots = b.place.slots
        if gone:
            left = (t for t in b.path if t.lstrip(".") not in MAIN and t.lstrip(".") not in MAIN_WORDS and t.lstrip(".") not in OTHER_WORDS)
            slots = Place(None, tuple(left)).slots
        x[i, :PATH] = np.unpackbits(np.frombuffer(slots.to_bytes(PATH // 8, "little"), np.uint8), bitorder="little")
        words = b.text.lower().split()
        for slot, n_words in Counter(_slot(w, WORDS) for w in words).items():
            x[i, PATH + slot] = n_words / len(words)
        size = len(b.text)
        x[i, PATH + WORDS :] = (
            log1p(size) / 6,
            log1p(len(words)) / 4,
            min(b.linked / size, 1),
            sum(map(b.text.count, ".!?,;")) / len(words),
            b.text[-1] in ".!?\"'",
            b.text[0].isupper(),
            i / n,
            min(b.place.length, 60) / 10,
            "©" in b.text or "|" in b.text,
            sum(map(b.text.count, "0123456789")) / size,
        )
    return x


@dataclass(frozen=True)
class BlockLabeller:
    network: Params

    def keep(self, pages: Sequence[Sequence[Block]]) -> list[np.ndarray]:
        """For each page, which blocks are main text; pages of like lengths are read together."""
        out: list[np.ndarray] = [np.zeros(len(p), bool) for p in pages]
        order = sorted((len(p), i) for i, p in enumerate(pages) if p)
        while order:
            take, cells = 0, 0
            while take < min(len(order), 256) and (take == 0 or (take + 1) * order[take][0] <= 16_384):
                take += 1
            some, order = order[:take], order[take:]
            cells = some[-1][0]
            x, mask = np.zeros((cells, take, WIDTH), np.float32), np.zeros((cells, take), np.float32)
            for j, (n, i) in enumerate(some):
                x[:n, j], mask[:n, j] = vectors(pages[i]), 1
            scores, _ = forward(self.network, x, mask)
            for j, (n, i) in enumerate(some):
                out[i] = scores[:n, j, 0] > 0
        return out


def _telling(block: Block, tags: frozenset[str], words: frozenset[str]) -> bool:
    return any(token in tags or (token[0] == "." and token[1:] in words) for token in block.path)


def taught(block: Block) -> bool | None:
    """What the markup says of a block: main text, other, or nothing. Other parts may stand within the article."""
    if _telling(block, OTHER, OTHER_WORDS):
        return False
    return True if _telling(block, MAIN, MAIN_WORDS) else None


def made_pages(n: int, seed: int = 4) -> list[list[tuple[Block, bool]]]:
    """Labelled pages in many layouts, from random words."""
    rng = Random(seed)
    syllables = "th er on an re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve sch ung ción eau".split()
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    phrase = lambda a, b: " ".join(word() for _ in range(rng.randint(a, b)))
    sentence = lambda: phrase(3, 18).capitalize() + "."
    pages = []
    for _ in range(n):
        page: list[tuple[Block, bool]] = []
        shell = [(), ("div", ".wrapper"), ("div", ".page", ".container")][rng.randrange(3)]
        root = ("html", "body", *shell)

        def other(path: tuple[str, ...], texts: list[str], link: bool, page=page, root=root) -> None:
            page.extend((Block(root + path, t, len(t) if link else 0), False) for t in texts)

        def part(tag: str, names: Sequence[str], rng=rng) -> tuple[str, ...]:
            return (tag,) if rng.random() < 0.4 else ("div", f".{rng.choice(names)}")

        def heading(path: tuple[str, ...], page=page, rng=rng, root=root) -> None:
            if rng.random() < 0.5:
                page.append((Block((*root, *path, rng.choice(["h2", "h3", "h4"])), phrase(1, 4).capitalize(), 0), False))

        def paragraphs(a: int, b: int, rng=rng) -> list[str]:
            return [" ".join(sentence() for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(a, b))]

        def comments(around: tuple[str, ...] = (), rng=rng) -> None:
            where = (*around, rng.choice(["div", "section", "ol"]), f".{rng.choice(['comments', 'comment', 'replies'])}")
            heading(where)
            other((*where, *rng.choice([("p",), ("div", "p"), ("li",), ("li", "p"), ("div", ".comment", "p")])), paragraphs(1, 5), False)

        def side(around: tuple[str, ...] = (), rng=rng) -> None:
            where = around + (part("aside", ["sidebar", "related", "widget", "side", "social", "newsletter"]))
            heading(where)
            if rng.random() < 0.6:
                other((*where, "ul", "li"), [phrase(2, 6) for _ in range(rng.randint(2, 6))], True)
            else:
                other((*where, "p") if rng.random() < 0.7 else where, paragraphs(1, 3), False)

        def menu(around: tuple[str, ...] = (), rng=rng) -> None:
            where = around + part("nav", ["menu", "nav", "breadcrumb", "pagination", "toolbar"])
            heading(where)
            other((*where, *rng.choice([("ul", "li"), ("ol", "li"), ()])), [phrase(1, 3) for _ in range(rng.randint(2, 8))], True)

        def notice(around: tuple[str, ...] = (), rng=rng) -> None:
            tag, name = rng.choice(["div", "section", "p"]), f".{rng.choice(['cookie', 'notice', 'consent', 'popup', 'banner'])}"
            inner = () if tag == "p" else rng.choice([(), ("p",)])
            other((*around, tag, name, *inner), paragraphs(1, 1), False)

        def advert(around: tuple[str, ...] = (), rng=rng) -> None:
            name = f".{rng.choice(['ad', 'ads', 'advert', 'advertisement', 'sponsor', 'promo', 'share'])}"
            inner = rng.choice([(), ("p",), ("h3",)])
            other((*around, rng.choice(["div", "section"]), name, *inner), [sentence() if rng.random() < 0.6 else phrase(2, 8)], rng.random() < 0.4)

        def form(around: tuple[str, ...] = (), rng=rng) -> None:
            where = around + part("form", ["subscribe", "login", "signup", "newsletter", "form"])
            heading(where)
            other((*where, "label"), [phrase(1, 4) for _ in range(rng.randint(1, 3))], False)
            if rng.random() < 0.5:
                other((*where, *rng.choice([("p",), ("button",), ()])), [phrase(1, 5).capitalize()], False)

        def foot(around: tuple[str, ...] = (), rng=rng) -> None:
            where = around + part("footer", ["footer", "copyright", "foot"])
            text = f"© {word()}.{word()}.org · {sentence()}" if not around or rng.random() < 0.3 else sentence()
            other((*where, *rng.choice([(), ("p",)])), [text], False)

        parts_within = (comments, side, menu, notice, advert, form, foot)
        title = phrase(3, 10).capitalize()
        page.append((Block(("html", "head", "title"), title, 0), False))
        if rng.random() < 0.4:
            other(part("header", ["header", "banner"]), [phrase(1, 4)], False)
        if rng.random() < 0.8:
            menu()
        if rng.random() < 0.3:
            notice()
        if rng.random() < 0.5:
            advert()
        nested = rng.random() < 0.5
        main = rng.choice([("article",), ("article",), ("main",), ("main", "article"), ("div", ".content"), ("div", ".post", ".entry")])
        if rng.random() < 0.8:
            page.append((Block((*root, *main, rng.choice(["h1", "h1", "h2"])), title, 0), True))
        for _ in range(rng.randint(1, 14)):
            inner = rng.choice([("p",)] * 8 + [("h2",), ("ul", "li"), ("blockquote",), ("table", "tr", "td"), ("pre",)])
            text = phrase(1, 6).capitalize() if inner == ("h2",) else " ".join(sentence() for _ in range(rng.randint(1, 6)))
            page.append((Block((*root, *main, *inner), text, 0), True))
            if nested and rng.random() < 0.15:
                rng.choice(parts_within)(main)
        if nested and rng.random() < 0.5:
            rng.choice(parts_within)(main)
        for piece, chance in ((side, 0.35), (comments, 0.35), (form, 0.3), (notice, 0.1), (foot, 0.85)):
            if rng.random() < chance:
                piece()
        pages.append(page)
    return pages


def fit_labeller(pages: Sequence[Sequence[tuple[Block, bool]]], *, hidden: int = 16, epochs: int = 9, seed: int = 2) -> BlockLabeller:
    """Adam on the log loss of every block, in batches of 16 pages of like lengths."""
    rng, hide = np.random.default_rng(seed), Random(seed)
    network, adam = new_bilstm(rng, WIDTH, hidden, 1), Adam(0.01)
    pages = sorted((p for p in pages if p), key=len)
    batches = [pages[k : k + 16] for k in range(0, len(pages), 16)]
    for epoch in range(epochs):
        adam.rate = 0.012 * 0.7**epoch
        for k in rng.permutation(len(batches)):
            some = batches[k]
            steps = max(map(len, some))
            x, mask = np.zeros((steps, len(some), WIDTH), np.float32), np.zeros((steps, len(some)), np.float32)
            y = np.zeros((steps, len(some)), np.float32)
            for j, page in enumerate(some):
                x[: len(page), j], mask[: len(page), j] = vectors([b for b, _ in page], hide), 1
                y[: len(page), j] = [main for _, main in page]
            scores, memory = forward(network, x, mask, keep=True)
            d = (1 / (1 + np.exp(-np.clip(scores[:, :, 0], -30, 30))) - y) * mask / mask.sum()
            adam.step(network, backward(network, memory, d[:, :, None].astype(np.float32))[0])
    return BlockLabeller(network)


def train_labeller(pages: DataFrame, *, max_pages: int = MAX_PAGES, made: int = MADE) -> BlockLabeller:
    """Fits on at most ``max_pages`` pages, the same on every run, and ``made`` pages.

    Pages of over ``MAX_TRAINING_CHARS`` characters are not learned from, so that what is gathered is
    bounded; extraction reads all pages whole. A sampled page counts if markup decides all its blocks.
    """
    short = pages.where(F.length("html") <= MAX_TRAINING_CHARS).select("html", F.xxhash64("html").alias("hash"))
    chosen = short.select("hash").distinct().orderBy("hash").limit(max_pages)  # only hashes are shuffled and sorted
    sample = sorted(r["html"] for r in short.join(F.broadcast(chosen), "hash").select("html").distinct().collect())
    labelled = [[(b, taught(b)) for b in blocks(html)] for html in sample]
    return fit_labeller([p for p in labelled if all(v is not None for _, v in p)] + made_pages(made))


def main_texts(pages: Sequence[str | None], labeller: BlockLabeller) -> list[str]:
    cut = [blocks(h) for h in pages]
    return [" ".join(b.text for b, k in zip(p, keep, strict=True) if k) for p, keep in zip(cut, labeller.keep(cut), strict=True)]


def extract(pages: DataFrame, labeller: BlockLabeller) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``, its code points: the blocks of main text joined by a space.

    The whole ``html`` is read; a null or empty page, or one without main text, has an empty text.
    Repeated rows each get theirs, an empty table stays empty; input columns named ``text`` or
    ``n_chars`` are replaced.
    """
    base = without(pages, ("text", "n_chars"))
    made = add_columns(base, ["html"], [("text", T.StringType())], lambda htmls: [main_texts(htmls, labeller)])
    return made.withColumn("n_chars", F.length("text").cast("long"))
