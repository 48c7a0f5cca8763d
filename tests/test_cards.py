"""Cards by element (A11, B5-B7, B16, B17, K6) on hand-written pages."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.sources.cards import CardSelectors, ingest_cards, page_cards, parse_cards
from vitrine.sources.selectors import Automaton, Places, parse

SHOP = CardSelectors('div[data-testid="card"]', title="h2.title", price="p.price", link="a")
PAGE = """
<nav><a href="/menu">Menu</a></nav>
<DIV DATA-TESTID='card' class="x"><A data-href="/no" HREF='/tv'><h2 class="big title"> TV <b>55&quot;</b> &amp; Fog&atilde;o&#8211;1 </h2></A>
  <p class=price>R$ 1.234,50</p><p class="price">R$ 9,00</p></DIV>
<div data-testid="card"><h2 class="title">Sem pre\u00e7o</h2><a href="https://x.example/2">ver</a><br><img src=x></div>
<div data-testid="card"><h2 class="title"></h2><a>sem link</a><p class="price">R$ 5,00</p>
"""


def test_fields_quotes_case_entities_and_open_elements():
    cards = page_cards(PAGE, SHOP)
    assert cards == [
        {"title": 'TV55"& Fog\u00e3o\u20131', "price_text": "R$ 1.234,50", "href": "/tv"},
        {"title": "Sem pre\u00e7o", "price_text": None, "href": "https://x.example/2"},
        {"title": "", "price_text": "R$ 5,00", "href": None},
    ]


def test_link_around_the_card_and_unread_elements():
    html = '<a href="/far"><a href="/near"><div class="c"><h3>A<script>x</script><!-- n -->B</h3></div></a></a><div class="c"></div>'
    cards = page_cards(html, CardSelectors(".c", title="h3", link="<a[href]"))
    assert [(c["title"], c["href"]) for c in cards] == [("AB", "/near"), (None, None)]


def test_selectors():
    assert page_cards("<ul id=l><li><b>1</b></li></ul><li><b>2</b></li>", CardSelectors("#l li", title="b", link=None)) == [
        {"title": "1", "price_text": None, "href": None}]
    for bad in ("", "a >", "> a", "a,,b", "a:last-child", "a:has(b)", "a:not(b c)", "a:not()", "a:nth-child(x)", "a[b", "a)", "a:not(b"):
        with pytest.raises(ValueError):
            parse(bad)


LISTING = """
<ul class="grid"><li class="ad"><div class="card promo"><h2>Anúncio</h2><a href="/ad">x</a></div></li>
<li><div class="card"><span class="brand">M</span><h2 data-k="title-1">Fogão</h2><h2>outro</h2><p>de R$ 9,00</p><p class="now big">R$ 8,50</p>
  <div><a href="#top">topo</a><a href="/p/fogao">ver</a></div></div></li>
<li><div class="card"><h2 data-k="title-2">TV</h2><p class="now">R$ 99,00</p><a href="/p/tv" rel="item nofollow">ver</a><b><h2>fim</h2></b></div></li></ul>
<div class="card"><h2 data-k="title-9">fora</h2></div>"""


@pytest.mark.parametrize("selectors, want", [
    (CardSelectors("ul.grid > li > .card", "h2", "p", "a"), [("Anúncio", None, "/ad"), ("Fogão", "de R$ 9,00", "#top"), ("TV", "R$ 99,00", "/p/tv")]),
    (CardSelectors("li:not(.ad) .card", 'h2[data-k^="title"]', "p + p, p.now", 'a[href^="/p/"]'), [("Fogão", "R$ 8,50", "/p/fogao"), ("TV", "R$ 99,00", "/p/tv")]),
    (CardSelectors("li:nth-child(n+2) > div", "h2 ~ h2", "p:nth-of-type(2)", "a[rel~=item]"), [("outro", "R$ 8,50", None), (None, None, "/p/tv")]),
    (CardSelectors("li ~ li .card", "h2[data-k$='1' i]", "p[class*=ow]", "div > a:nth-child(2)"), [("Fogão", "R$ 8,50", "/p/fogao"), (None, "R$ 99,00", None)]),
    (CardSelectors(".grid + .card, .card.promo", "*:first-child", None, None), [("Anúncio", None, None), ("fora", None, None)]),
])
def test_selector_combinators(selectors, want):
    assert [tuple(c.values()) for c in page_cards(LISTING, selectors)] == want


def test_fields_are_looked_for_inside_the_card_only():
    """A combinator does not reach around the card, and a nested card has its own fields."""
    html = '<main><div class="c"><p>1</p><div class="c"><p>2</p><h3>in</h3></div><h3>out</h3></div></main>'
    got = page_cards(html, CardSelectors("div.c", title="main h3, h3", price=".c > p, p:first-child", link=None))
    assert [(c["title"], c["price_text"]) for c in got] == [("in", "1"), ("in", "2")]


class Node:
    def __init__(self, tag, cls, children):
        self.tag, self.cls, self.children = tag, cls, children


def brute(node, path, before, chain):
    """Whether the last compound of ``chain`` fits the node and the rest fits around it; the tree is at hand."""
    comb, (tag, cls) = chain[-1]
    if not ((tag in ("*", node.tag)) and (cls is None or cls == node.cls)):
        return False
    if len(chain) == 1:
        return True
    rest = chain[:-1]
    if comb == ">":
        return bool(path) and brute(*path[-1], rest)
    if comb == " ":
        return any(brute(*p, rest) for p in path)
    near = before[-1:] if comb == "+" else before
    return any(brute(n, path, before[:i], rest) for n, i in zip(near, range(len(before) - len(near), len(before))))


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.builds(Node, st.sampled_from("ab"), st.sampled_from([None, "x", "y"]), st.just([])),
                    lambda kids: st.builds(Node, st.sampled_from("ab"), st.sampled_from([None, "x", "y"]), st.lists(kids, max_size=4)), max_leaves=14),
       st.lists(st.tuples(st.sampled_from([" ", ">", "+", "~"]), st.tuples(st.sampled_from("ab*"), st.sampled_from([None, "x", "y"]))), min_size=1, max_size=4))
def test_automaton_equals_search_in_the_tree(tree, chain):
    text = "".join((f" {comb} " if i and comb != " " else " " if i else "") + tag + (f".{cls}" if cls else "") for i, (comb, (tag, cls)) in enumerate(chain))
    run, places, found, want = Automaton({"s": text}).run(), Places(), [], []

    def walk(node, path, before):
        own = run.push(places.push(node.tag, {"class": node.cls} if node.cls else {}))
        found.append(run.accepted(own, "s"))
        want.append(brute(node, path, before, chain))
        for i, kid in enumerate(node.children):
            walk(kid, [*path, (node, path, before)], node.children[:i])
        run.pop()
        places.pop()

    walk(tree, [], [])
    assert found == want


def test_null_and_empty_pages_have_no_cards(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, PAGE), (3, PAGE)], "page_id long, html string")
    got = sorted((r.page_id, len(r.cards)) for r in parse_cards(df, SHOP).collect())
    assert got == [(1, 0), (2, 0), (3, 3), (3, 3)]
    assert parse_cards(df.limit(0), SHOP).count() == 0


@pytest.mark.parametrize("mode, style, want", [
    ("strict", "digits", [("k", 1, 1234.5)]),
    ("lenient", "digits", [("k", 1, 1234.5), ("k", 2, 0.0)]),
    ("tag", "nullable", [("k", 1, 1234.5), ("k", 2, None)]),
    ("priced", "nullable", [("k", 1, 1234.5)]),
])
def test_ingest_applies_price_validity_and_cut(spark, tmp_path, mode, style, want):
    late = PAGE.replace("/tv", "/late")
    rows = [(1, "k", 1, PAGE, False), (2, "k", 2, "<p>no cards</p>", False), (3, "k", 3, late, False),
            (4, "f", 1, "", True), (5, "f", 2, late, False)]
    pages = spark.createDataFrame(rows, "page_id long, category string, page int, html string, failed boolean")
    out = ingest_cards(pages, str(tmp_path / "t"), SHOP, domain="https://shop.example", mode=mode, price_style=style,
                       failed_col="failed")
    got = sorted(out.collect(), key=lambda r: r.pos)
    assert [(r.category, r.pos, r.price) for r in got] == want and {r.page_id for r in got} == {1}
    assert got[0].url == "https://shop.example/tv"
