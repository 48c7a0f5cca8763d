"""Main text of ordinary markup, and templates against classes found by hand."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitrine.llm import html_extract as H


def text(html):
    return H.main_text(H.parse(html)[0], set())


BODY = "<article><p>One long paragraph.</p><p>Another one.</p></article>"
MAIN = "One long paragraph.\n\nAnother one."


@pytest.mark.parametrize("html, want", [
    (f"<html><head><title>t</title><meta charset=x><style>p{{}}</style>{BODY}", MAIN),  # no </head>, no <body>
    (f"<head><title>t</title>bare words{BODY}", MAIN),
    (f"<datalist><option value=a><option value=b></datalist>{BODY}", MAIN),
    (f"<select><option>x<option>y</select>{BODY}", MAIN),
    ("<article><p>a</p><button>Go<p>b</p><p>c</p></article>", "a\n\nb\n\nc"),
    ("<article><p>a</p><button><div>Go</div></button><p>b <svg><text>no</text></svg>c</p><video src=x>old browser<p>d</p></article>", "a\n\nb c\n\nd"),
    ('<article class="post tag-ads category-promo"><p>Body of a post</p></article>', "Body of a post"),
    ('<article class="comment"><p>me too</p></article><article><p>the text itself</p></article>', "the text itself"),
    ('<div class="content"><p>' + "long text " * 30 + "</p></div><div><article><p>teaser</p></article></div>", ("long text " * 30).strip()),
    ("<article><p>" + "word " * 90 + "</p></article><article><h3><a href=x>Read this next</a></h3></article>", ("word " * 90).strip()),
    ('<article><p>a</p><p class="advertisement">buy</p><p hidden>h</p><p style="display:none">d</p><ul><li class="share">tweet<li>kept</ul>'
     '<p>x<span class="ad">buy</span> y</p></article>', "a\n\nkept\n\nx y"),
    ('<article><p class=ad>left open<p>b</p><li class="share"><b>no</b></li><li>c</li><h2 class="sponsored">no</h2><h2>d</h2></article>', "b\n\nc\n\nd"),
    ('<div class="page has-sidebar"><p>' + "all of the text " * 9 + '</p></div><div class="sidebar"><p>aside</p></div>', ("all of the text " * 9).strip()),
    ('<article><p>a <span class="ad">b <span>c</span> d</span> e</p></article>', "a e"),
    ("<article><p>1 < 2 &amp; 3 > 2</p><!-- <p>no</p> --><p>x</article>", "1 < 2 & 3 > 2\n\nx"),
])
def test_ordinary_markup(html, want):
    assert text(html) == want


def test_broken_pages_never_fail():
    rng = np.random.default_rng(12)
    parts = ["<p>", "</p>", "<div class='ad'>", "</div>", "<article>", "</article>", "<option>", "<button>", "</button>", "<head>", "text", "&amp;", "<", ">",
             "<script>", "</script>", "<svg>", "<li class=share>", "<span hidden>", "</span>", '"', "<a href=x", "</li>", "<!--"]
    for _ in range(1500):
        html = "".join(rng.choice(parts, 25))
        blocks, tokens = H.parse(html)
        assert all(b.text and b.text == " ".join(b.text.split()) for b in blocks) and text(html) is not None
        assert all(0 <= b.at <= len(tokens) for b in blocks)


def by_hand(pages, min_pages, min_share):
    """Valid classes of one host from its occurrence vectors, written out."""
    seen = {}
    for html in pages:
        blocks, tags = H.parse(html)
        seen.setdefault(tuple(b.text for b in blocks), (Counter(tags) + Counter(b.token for b in blocks)))
    distinct = list(seen.values())
    vectors = defaultdict(set)
    for t in set().union(*distinct):
        vectors[tuple(c[t] for c in distinct)].add(t)
    return {frozenset(ts) for v, ts in vectors.items() if len(ts) >= 2 and (n := sum(x > 0 for x in v)) >= min_pages and n >= min_share * len(distinct)}


def test_classes_equal_those_of_written_out_vectors(spark):
    rng = np.random.default_rng(13)
    rows = []
    for host in ("a", "b"):
        for i in range(12):
            items = "".join(f"<li><b>{x}</b></li>" for x in rng.choice(["x", "y", "z"], rng.integers(1, 4)))
            extra = "<section><h2>Extra</h2><p>sometimes</p></section>" if rng.random() < 0.5 else ""
            rows.append((host, f"<nav><p>menu</p></nav><article><h1>T{i % 9}</h1><ul>{items}</ul>{extra}</article><footer><p>end</p></footer>"))
    df = spark.createDataFrame(rows, "host string, html string")
    got = defaultdict(set)
    for r in H.templates(df).collect():
        got[r.host].add(frozenset(r.tokens))
        assert set(r.tags) | set(r.texts) <= set(r.tokens)
    for host in "ab":
        assert got[host] == by_hand([h for x, h in rows if x == host], H.MIN_PAGES, H.MIN_SHARE)


def test_order_and_nesting_of_classes():
    classes = {1: 10, 2: 10, 3: 20, 4: 20}
    sizes = {10: 2, 20: 2}
    good = lambda tokens: {c: ok for c, (_, ok) in H.orders(tokens, classes, sizes).items()}
    assert good([1, 3, 4, 3, 4, 2]) == {10: True, 20: True}  # 20 repeats inside 10
    assert good([1, 2, 3, 4]) == {10: True, 20: True}  # beside each other
    assert good([1, 3, 2, 4]) == {10: True, 20: False}  # across
    assert good([2, 1, 1, 2])[10] is False and good([1, 9, 2]) == {10: True}
    one = H.orders([1, 2], classes, sizes)[10][0]
    assert one == H.orders([1, 2, 1, 2], classes, sizes)[10][0] != H.orders([2, 1], classes, sizes)[10][0]


def test_slots_decide_where_no_name_does(spark):
    """A link list and rotating notices in elements that no list names, and pages without an article element."""
    rng = np.random.default_rng(14)
    rows = []
    for i in range(40):
        words = " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet"], 60))
        links = "".join(f'<a href="/{x}">Link to page {x}</a> ' for x in rng.integers(0, 999, 6))
        page = (f"<body><div class=k1><p>Top</p></div><article><h1>Title {i}</h1><p>{words}</p><div class=k7>{links}</div></article>"
                f"<div class=k2><p>Notice {i % 3}: the office is closed</p></div></body>")
        rows.append((i, f"http://one.example/{i}", page))
        plain = (f"<body><div class=k1><p>Top {i}</p></div><div class=k3><p>{words} {i}</p></div><div class=k2><p>Notice {i % 2} of today</p></div>"
                 f"<div class=k4><p>Seen {i} times</p></div></body>")
        rows.append((100 + i, f"http://two.example/{i}", plain))
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    by = {r.page_id: r.text for r in H.extract_pages(df).collect()}
    for i, _, page in rows:
        words = page.split("<p>")[2].split("</p>")[0]
        assert by[i] == (f"Title {i}\n\n{words}" if i < 100 else words)
    known = H.deduced(df.withColumn("host", H.host_of(F.col("url")))).collect()
    assert {r.host for r in known} == {"one.example", "two.example"} and all(r.classes and r.no_article for r in known)
