"""Main text of pages against a plain reading of the given pages, and on pages of other kinds."""

import html
import re

import pytest
from pyspark.sql import functions as F

from millrace.llm import extraction, queries
from millrace.llm.extraction import Weights, best_region, main_text

SF = "/root/testdata/sf0.001"


def brute(page):
    """The given pages have one article of headings and paragraphs."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", found[1]) if found else []
    blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "")).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_given_pages(spark, sf):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    found = queries.op12_extraction(spark, sf).collect()
    assert len(found) == len(pages)
    for r in found:
        page = pages[r["page_id"]]
        assert (r["url"], r["text"], r["n_chars"]) == (page["url"], brute(page["html"]), len(brute(page["html"])))
        assert brute(page["html"]).split("\n")[0][:20] in html.unescape(page["html"][r["start"] : r["end"]])


@pytest.fixture(scope="module")
def weights(spark):
    return extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))


def brute_region(scores):
    sums = [(sum(scores[a:b]), -a, b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)]
    best = max(sums, default=(0, 0, 0))
    return (-best[1], best[2]) if best[0] > 0 else None


def test_region():
    assert best_region([]) is None and best_region([-1.0, 0.0]) is None
    assert best_region([-1, 3, -1, 2, -9, 3]) == (1, 4)
    for seed in range(200):
        scores = [((seed * 7919 + k * 104729) % 23 - 11) / 2 + k * 1e-6 for k in range(seed % 13)]
        assert best_region(scores) == brute_region(scores)


NAV = '<nav class="top"><ul><li><a href="/a">Home</a></li><li><a href="/b">About us</a></li><li><a href="/c">Shop</a></li></ul></nav>'
SIDE = '<aside><h3>Popular</h3><ul><li><a href="/x">Ten things to read now</a></li></ul></aside>'
FOOT = "<footer><p>&copy; 2024 Some company. All rights are reserved by them.</p></footer>"
TEXT = "<h1>A title</h1><p>First words of it, <b>bold</b> and <i>thin</i>.</p><p>Fish &amp; chips&nbsp;cost\n  &#8364;5 &lt;now&gt;.</p>"
WANTED = "A title\nFirst words of it, bold and thin.\nFish & chips cost €5 <now>."

PAGES = {
    "article": (f"<html><body>{NAV}<article>{TEXT}</article>{SIDE}{FOOT}</body></html>", WANTED),
    "main": (f"<html><body>{NAV}<main>{TEXT}</main>{FOOT}", WANTED),
    "no mark": (f"<html><head><title>T</title></head><body>{NAV}<div id='content'>{TEXT}</div>{SIDE}{FOOT}</body></html>", WANTED),
    "plain div": (f"<body><div class='sidebar'>Some words beside</div><div>{TEXT}</div>{FOOT}", WANTED),
    "foreign inside": (
        f"<article>{TEXT}<div class='ad-box'>Buy this thing today</div><form><label>Mail</label><button>Send it</button></form>"
        "<div class='cookieNotice'>We use cookies for many things</div><p>The end.</p><section id='comments'><h2>Comments</h2><p>I like it very much</p></section></article>",
        WANTED + "\nThe end.",
    ),
    "comments as articles": (f"<main>{TEXT}</main><article class='comment'>So do I and all of my friends</article>", WANTED),
    "header of an article": (f"<header>My site of words</header><article><header><h1>A title</h1></header><p>Words.</p><footer>By me</footer></article>", "A title\nWords."),
    "scripts": ("<article><script>if (a<b) x('</p>')</script><style>p{}</style><p>a<!-- no <p>b</p> -->b</p><noscript>Turn it on</noscript></article>", "ab"),
    "unclosed": ("<article><p>one<p>two<ul><li>three<li>four</ul><table><tr><td>a<td>b<tr><td>c</table>five<br>six", "one\ntwo\nthree\nfour\na b\nc\nfive six"),
    "quotes": ('<article><p title="a > b" data-x=\'</article>\'>one</p><p class="never closed>two</p></article>', "one\ntwo"),
    "signs": ("<article><p>1 < 2 and 3 <4 &am &amp</p></article>", "1 < 2 and 3 <4 &am &"),
    "no tags": ("only  words\n here", "only words here"),
    "long tail": (f"<article>{TEXT}<aside>{'many other words ' * 500}</aside><p>On.</p></article>", WANTED + "\nOn."),
    "empty": ("", ""),
    "no text": ("<html><body><img src='x'></body></html>", ""),
    "menu only": (f"<body>{NAV}</body>", ""),
    "comment open": ("<article><p>a</p><!-- never ends <p>b</p>", "a"),
}


@pytest.mark.parametrize("name", PAGES)
def test_kinds(weights, name):
    page, wanted = PAGES[name]
    assert main_text(page, weights)[0] == wanted


@pytest.mark.parametrize("name", ["article", "main", "foreign inside", "comments as articles", "scripts", "no tags", "empty"])
def test_prior_alone(name):
    page, wanted = PAGES[name]
    assert main_text(page, Weights())[0] == wanted


def test_learned(weights):
    """Words of menus and footers are outside, paragraphs inside, also without marks of the main part."""
    assert weights.bias + weights.names["t:p"] > 0 > weights.bias + weights.names["t:footer"]
    assert weights.names["t:li"] < 0 < weights.names["t:p"]
    assert weights.tags["li"] > 0.9 > 0.1 > weights.tags["p"]


def test_labels_teach_new_names(spark):
    """A class that no prior knows is foreign where labelled pages have it outside."""
    page = "<body><div class='zebra'>some other words of it</div><article><p>{}</p></article></body>"
    pages = spark.createDataFrame([(k, None, page.format("word " * (k % 9 + 5))) for k in range(80)], "page_id long, url string, html string")
    learned = extraction.train(pages)
    assert learned.names["w:zebra"] < -1
    text, _, _ = main_text("<body><div class='zebra'>some other words of it</div><p>The own text of it</p></body>", learned)
    assert text == "The own text of it"


def test_odd_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 100_000 + "</article>"
    deep = "<div>" * 20_000 + "deep words" + "</div>" * 20_000
    rows = [(None, None, None), (1, "u", ""), (2, "u", PAGES["main"][0]), (2, "u", PAGES["main"][0]), (3, None, long), (4, "u", deep), (None, "u", "word")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("text", "start", "digest", "kind")})
    out = sorted((tuple(r)[:4] for r in extraction.extract(frame.repartition(3)).collect()), key=str)
    text = "\n".join(["word & word"] * 100_000)
    expected = [(None, None, "", 0), (1, "u", "", 0), (2, "u", WANTED, len(WANTED)), (2, "u", WANTED, len(WANTED)), (3, None, text, len(text)), (4, "u", "deep words", 10), (None, "u", "word", 4)]
    assert out == sorted(expected, key=str)
    assert extraction.extract(frame.limit(0)).count() == 0
