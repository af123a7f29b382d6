import math
import re
import time
from html import unescape

import pytest

from strataflow.llm import queries
from strataflow.llm.html_extract import MADE, PATH, WORDS, Block, blocks, fit_labeller, made_pages, main_texts, vectors
from strataflow.llm.url_filter import NAMES, RULES, lexical, made_examples, suffixes, train_url_model


def slow_rule(url):
    """Host, path and rule by definition."""
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return host, path, max(fits, key=lambda r: len(str(r)), default=None)


URLS = [
    None, "", "plain", "http://net", "http://net/", "http://NET/x?y", "https://a.b.example.net/en/1", "https://example.net/en", "x://example.com/de/",
    "https://m.example.com/de/9?q=/de/", "https://example.com?x/de/", "https://a.org/fr/1#y", "https://a.xorg/fr/1", "https://notexample.net/en/1", "a://b://c/net/",
    "http://É.Net/Ä", "http://casino-spam.info/en/1", "://org/fr/", "http://example.com:80/de/1",
]


def test_urls_by_definition(spark, tmp_path):
    spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string").write.parquet(f"{tmp_path}/pages.parquet")
    rows = {r["page_id"]: r for r in queries.op5_url_filter(spark, str(tmp_path)).collect()}
    for i, u in enumerate(URLS):
        host, path, rule = slow_rule(u)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, None if rule is None else str(rule))
        assert rows[i]["verdict"] == (rule.verdict if rule else "block" if rows[i]["score"] >= 0.5 else "allow")
    assert rows[URLS.index("http://casino-spam.info/en/1")]["verdict"] == "block"


def test_real_urls(spark, sf_dir):
    rows = queries.op5_url_filter(spark, sf_dir).collect()
    urls = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    assert len(rows) == len(urls)
    for r in rows:
        host, path, rule = slow_rule(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, None if rule is None else str(rule))
        assert r["verdict"] == (rule.verdict if rule else "block" if "-" in host else "allow")


def test_url_model_on_unseen_examples(spark, sf_dir):
    model = train_url_model(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    fresh = made_examples(1000, seed=99)
    right = sum((s >= 0.5) == (y == 1) for s, (_, y) in zip(model.scores([u for u, _ in fresh]), fresh, strict=True))
    assert right > 950


# Labelled by hand, and not looked at while the model was made.
ORDINARY = """https://freecodecamp.org/news https://downloads.apache.org/spark https://www.farmersweekly.co.uk https://winnipeg.ca https://adsabs.harvard.edu
https://en.wikipedia.org/wiki/Casino https://www.theguardian.com/environment/2023/nov/12/rivers-and-lakes https://www.si.edu/exhibitions https://docs.rs/serde/latest/serde/
https://www.uni-goettingen.de/en/1.html https://www.bl.uk/collection-items https://www.who.int/news/item/05-05-2023-statement https://pubmed.ncbi.nlm.nih.gov/31978945/
https://www.postgresql.org/docs/16/sql-select.html https://www.louvre.fr/en/explore https://www.bahn.de/ https://www.zeit.de/wissen/2022-07/klima https://plato.stanford.edu/entries/kant/
https://www.weather.gov/ https://www.rfc-editor.org/rfc/rfc2616 https://en.cppreference.com/w/cpp/container/vector https://www.seriouseats.com/perfect-pan-pizza-recipe https://openlibrary.org/works/OL45804W
https://www.jstor.org/stable/2118331 https://www.abc.net.au/news/2024-01-10/heat/103299999 https://pandas.pydata.org/docs/ https://www.ft.com/markets https://www.doi.org/10.1000/182 https://www.ikea.com/gb/en/p/billy-00263850/ https://www.museodelprado.es/en""".split()
SUSPECT = """http://cheap-watches-outlet.top/ https://win-big-now.info/en/1 http://a8xk2q9zt4.biz/ https://best-loans-24.com/de/7 http://login-verify-account.net.ru/x
https://hotdeals8841923.com/ http://xkqzvbrtpw.top/a https://free-gift-cards.io/?ref=x http://pay-day-cash.org/en/3 https://m.crypto-doubler.com/fr/12""".split()


def test_ordinary_and_suspect_hosts(spark, sf_dir):
    model = train_url_model(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    ordinary, suspect = model.scores(ORDINARY), model.scores(SUSPECT)
    print("allowed", (ordinary < 0.5).mean(), "blocked", (suspect >= 0.5).mean(), [u for u, s in zip(ORDINARY, ordinary, strict=True) if s >= 0.5])
    assert (ordinary[:6] < 0.5).all() and (ordinary < 0.5).mean() >= 0.8 and (suspect >= 0.5).mean() >= 0.8


def test_host_of_lexical_features():
    assert suffixes("http://a.org?x=1.net") == ("org", "a.org") and suffixes("http://a.Example.org:8080/x") == ("org", "example.org")
    assert suffixes(None) == suffixes("plain") == ("", "") and lexical(None) == lexical("") and len(lexical("x://y")) == len(NAMES) - 2
    values = dict(zip(NAMES, lexical("http://ab.c1?p=1&q=2/3#f"), strict=False))
    assert (values["host_length"], values["path_length"], values["depth"], values["parameters"], values["fragment"]) == (5, 0, 0, 2, 1)
    assert values["digits"] == 4 / 24 and values["host_digits"] == 0.2 and values["host_entropy"] == pytest.approx(math.log2(5))


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";if(a<b)x();</script></head>
<body><nav><ul><li><a href="/x">Home</a><li><a href='/y>z'>More &amp; more</a></ul></nav><!-- <p>gone</p> -->
<article><h1>Big&nbsp;title</h1><p>One <b>bold</b>
 text<br>and more.<p>Two &lt;x&gt; &#233;<div class="ad big">Buy</div><table><tr><td>cell<td>next</table></article>
<footer>&copy; site</footer></body></html>"""


def test_blocks():
    got = blocks(PAGE)
    assert [b.text for b in got] == ["T", "Home", "More & more", "Big title", "One bold text and more.", "Two <x> é", "Buy", "cell", "next", "© site"]
    assert got[4].path[-2:] == ("article", "p") and ".ad" in got[6].path and got[1].linked == 4
    assert blocks(None) == blocks("") == blocks("<script>x") == []
    assert [b.text for b in blocks("a < b <p>c")] == ["a < b", "c"]
    assert blocks("<p>" * 5000 + "x")[0] == Block(("p",), "x", 0)


@pytest.mark.parametrize(
    "inner, texts",
    [
        ('<svg class="i"/><p>one</p><p>two</p>', ["one", "two"]),
        ("<p>one <svg class=i /> two</p><p>three</p>", ["one two", "three"]),
        ("<svg-icon name='x'></svg-icon><p>one</p><template-x></template-x><select-box>two</select-box>", ["one", "two"]),
        ("<p>one <svg-icon></svg-icon>two</p>", ["one", "two"]),
        ("<object data='x'><p>one</p></object><p>two</p>", ["one", "two"]),
        ("<p>Let <math><mi>x</mi><mo>+</mo><mspace/><mn>1</mn></math> be, <math/>so</p>", ["Let x+1 be, so"]),
        ("<svg><g><path d='M0'/><text>label</text></g></svg><p>one</p>", ["label", "one"]),
        ("<p>one</p><svg><p>two</p>", ["one", "two"]),
        ("<p>one</p><math><mi>x<p>two</p>", ["one", "x", "two"]),
        ("<noscript><p>one</p></noscript><template><p>two</p></template><iframe>three</iframe>", ["one", "two", "three"]),
        ("<select><option>one<option>two</select><textarea>three</textarea><p>four</p>", ["one", "two", "three", "four"]),
        ("<p>one</p><iframe src='x'><p>two</p>", ["one", "two"]),
        ("<p>one</p><script src='a>b'>x</script ><style>p{}</style><script-x>two</script-x><!-- gone -->", ["one", "two"]),
    ],
)
def test_nothing_but_scripts_styles_and_comments_is_lost(inner, texts):
    got = blocks(f"<body><article>{inner}</article><footer>foot</footer><p>last</p></body>")
    assert [b.text for b in got] == [*texts, "foot", "last"]
    assert all("article" in b.path for b in got[:-2]) and got[-2].path == ("body", "footer") and got[-1].path == ("body", "p")


def test_all_words_of_a_block_count():
    bag = lambda text: vectors([Block(("p",), text, 0)])[0, PATH : PATH + WORDS]
    start = "alpha beta gamma delta " * 10
    one, other = bag(start + "subscribe newsletter " * 40), bag(start + "village harvest " * 40)
    assert abs(one - other).sum() > 0.5 and abs(one.sum() - 1) < 1e-5 and abs(other.sum() - 1) < 1e-5


@pytest.fixture(scope="module")
def labeller():
    return fit_labeller(made_pages(300))


@pytest.fixture(scope="module")
def full_labeller():
    return fit_labeller(made_pages(MADE))


def test_unseen_layouts(labeller):
    pages = made_pages(80, seed=50)
    kept = labeller.keep([[b for b, _ in p] for p in pages])
    right = sum(int(k == y) for keep, p in zip(kept, pages, strict=True) for k, (_, y) in zip(keep, p, strict=True))
    assert right / sum(map(len, pages)) > 0.97
    assert main_texts([PAGE, None, ""], labeller)[1:] == ["", ""]


PARTS = {
    "comments": '<section class="comments"><h3>Replies</h3><p>I do not agree with this at all.</p><p>Well said, thank you for it!</p></section>',
    "comments by id": '<div id="comments"><p>First of all, this is wrong.</p><div class="comment"><p>No, it is right.</p></div></div>',
    "sidebar": '<div class="sidebar"><h3>Related</h3><ul><li><a href="/a">Another story</a><li><a href="/b">One more</a></ul></div>',
    "aside": "<aside><h2>Most read</h2><p>Some words about other things on this site.</p></aside>",
    "nav": '<nav><ul><li><a href="/1">Home</a><li><a href="/2">World</a><li><a href="/3">Sports</a></ul></nav>',
    "menu": '<div class="menu"><a href="/1">Home</a> <a href="/2">World</a></div>',
    "footer": "<footer>© 2024 The Site. All rights reserved.</footer>",
    "form": "<form><h3>Join us</h3><label>Your mail</label><input><button>Send</button></form>",
    "notice": '<div class="cookie notice"><p>We use small files to remember you. Do you agree?</p></div>',
    "advert": '<div class="ad"><p>Buy two chairs and get a table for nothing today!</p></div>',
}
ARTICLE = ["The river rose again", "On Monday the water reached the old bridge, and the school was closed.", "Nobody was hurt, the mayor said on the radio."]


@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main><article>{}</article></main>", '<div class="page"><article>{}</article></div>'])
@pytest.mark.parametrize("part", PARTS)
def test_parts_within_and_beside_the_article(full_labeller, frame, part):
    title, one, two = ARTICLE
    first, second = f"<h1>{title}</h1><p>{one}</p>", f"<p>{two}</p>"
    page = "<html><head><title>T</title></head><body>{}</body></html>"
    within = [page.format(frame.format(first + PARTS[part] + second)), page.format(frame.format(first + second + PARTS[part]))]
    beside = [page.format(PARTS[part] + frame.format(first + second)), page.format(frame.format(first + second) + PARTS[part])]
    assert main_texts(within + beside, full_labeller) == [" ".join(ARTICLE)] * 4


def test_deep_pages_take_linear_time():
    start = time.monotonic()
    page = blocks('<div class="a b c">x' * 50_000)
    assert len(page) == 50_000 and vectors(page).shape[0] == 50_000 and page[2].path == ("div", ".a", ".b", ".c") * 3
    assert time.monotonic() - start < 8  # 2 s here; copied paths took minutes


def test_pages_are_read_alike_in_any_company(labeller):
    pages = [[b for b, _ in p] for p in made_pages(30, seed=51)]
    together = labeller.keep(pages)
    assert all((labeller.keep([p])[0] == k).all() for p, k in zip(pages, together, strict=True))


def test_real_pages(spark, sf_dir):
    """These pages mark their articles, so the text is known."""
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    rows = queries.op6_html_extraction(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for r in rows:
        inside = re.search("<article>(.*?)(</article>|<footer>)", pages[r["page_id"]]["html"], re.S)[1]
        want = " ".join(unescape(re.sub(r"<[a-z/][^>]*>", lambda m: "" if m[0] in ("<b>", "</b>") else " ", inside)).split())
        assert r["text"] == want and r["n_chars"] == len(want) and r["url"] == pages[r["page_id"]]["url"]
