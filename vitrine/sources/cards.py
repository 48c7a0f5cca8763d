"""Product cards of stored pages by element.

Where the link pattern of ``pages.extract_links`` reads fixed templates
inside the JVM, this reads any markup: an event parser follows the open
elements and collects title, price text and link of every card. Python runs
in one ``mapInArrow`` over the pages, without a shuffle; a task holds one Arrow
batch of pages and the cards of a few.
"""

from __future__ import annotations

from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.functions.prices import parse_price
from vitrine.functions.urls import url_relative
from vitrine.session import cut_lineage
from vitrine.sources.pages import crawl_cut, listing_valid
from vitrine.sources.selectors import Automaton, Places
from vitrine.sources.sinks import save_by_category

# Fixed values of HTML: elements that have no end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(["script", "style", "template"])

#: Pages whose cards leave a task together.
PAGES_AT_ONCE = 64

CARD = T.StructType([
    T.StructField("title", T.StringType()),
    T.StructField("price_text", T.StringType()),
    T.StructField("href", T.StringType()),
])
_CARDS = pa.list_(pa.struct([("title", pa.string()), ("price_text", pa.string()), ("href", pa.string())]))


@dataclass(frozen=True)
class CardSelectors:
    """Selectors (``selectors``) of a card and, inside it, of title, price
    and link. A ``link`` that starts with ``<`` is looked for among the elements
    around the card. None: no such field."""

    card: str
    title: str | None = None
    price: str | None = None
    link: str | None = "a"


class CardParser(HTMLParser):
    """Cards of one page, in page order. A field is the text of its first
    element: pieces stripped and joined (H18), character references decoded;
    None where the card has no such element."""

    def __init__(self, selectors: CardSelectors):
        super().__init__(convert_charrefs=True)
        around = (selectors.link or "").startswith("<")
        page = {"card": selectors.card}
        if around:
            page["around"] = selectors.link[1:]
        fields = {"title": selectors.title, "price_text": selectors.price, "href": None if around else selectors.link}
        self.page, self.around = Automaton(page).run(), around
        self.inside = Automaton({k: v for k, v in fields.items() if v})
        self.places = Places()
        self.cards, self.unseen = [], 0
        # open elements: (tag, href if it may be the link around a card)
        self.path = []
        # open cards: (depth of the element, card, its run of the automaton of fields)
        self.open = []
        # open fields: (depth of the element, card, field, pieces)
        self.reading = []

    def handle_starttag(self, tag, attrs):
        seen = {}
        for k, v in attrs:  # of a repeated attribute the first counts
            seen.setdefault(k, v or "")
        element = self.places.push(tag, seen)
        own = self.page.push(element)
        depth = len(self.path) + 1
        for _, card, run in self.open:
            bits = run.push(element)
            for name in ("title", "price_text"):
                if name not in card and run.accepted(bits, name):
                    card[name] = None
                    self.reading.append((depth, card, name, []))
            if "href" not in card and run.accepted(bits, "href"):
                card["href"] = seen.get("href")
        if self.page.accepted(own, "card"):
            card = {}
            if self.around:
                card["href"] = next((p[1].get("href") for p in reversed(self.path) if p[1] is not None), None)
            self.cards.append(card)
            self.open.append((depth, card, self.inside.run()))
        self.path.append((tag, seen if self.page.accepted(own, "around") else None))
        if tag in UNSEEN:
            self.unseen += 1
        if tag in VOID:
            self._leave(depth)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._leave(len(self.path))

    def handle_endtag(self, tag):
        for depth in range(len(self.path), 0, -1):
            if self.path[depth - 1][0] == tag:
                self._leave(depth)
                return

    def _leave(self, depth: int):
        """Close the element at ``depth`` and all that is open inside it."""
        self.unseen -= sum(tag in UNSEEN for tag, _ in self.path[depth - 1:])
        for at in range(len(self.path), depth - 1, -1):
            self.places.pop()
            self.page.pop()
            for start, _, run in self.open:
                if at > start:
                    run.pop()
        del self.path[depth - 1:]
        for at, card, name, pieces in self.reading:
            if at >= depth:
                card[name] = "".join(pieces)
        self.reading = [r for r in self.reading if r[0] < depth]
        self.open = [o for o in self.open if o[0] < depth]

    def handle_data(self, data):
        if self.reading and not self.unseen and (piece := data.strip()):
            for *_, pieces in self.reading:
                pieces.append(piece)

    def finish(self) -> list[dict]:
        self.close()
        if self.path:  # elements that the page never closes end with it
            self._leave(1)
        return self.cards


def page_cards(html: str | None, selectors: CardSelectors) -> list[dict]:
    """The cards of one page; none for a null or empty page."""
    parser = CardParser(selectors)
    parser.feed(html or "")
    return [{k: c.get(k) for k in CARD.names} for c in parser.finish()]


def parse_cards(pages: DataFrame, selectors: CardSelectors, keep=("page_id",), html_col: str = "html") -> DataFrame:
    """One row per page with ``keep`` and ``cards``, an array of
    (title, price text, raw link). A null or empty page has no cards; repeated
    pages give repeated rows; other columns are not read."""
    keep = list(keep)
    rows = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    CardParser(selectors)  # a bad selector fails here, before any task

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, PAGES_AT_ONCE):
                part = batch.slice(a, PAGES_AT_ONCE)
                cards = [page_cards(html.as_py(), selectors) for html in part.column("__html")]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k) for k in keep), pa.array(cards, _CARDS)], [*keep, "cards"])

    return rows.mapInArrow(run, T.StructType([*rows.select(*keep).schema.fields, T.StructField("cards", T.ArrayType(CARD))]))


def ingest_cards(pages: DataFrame, path: str, selectors: CardSelectors, category_col: str = "category",
                 domain: str | None = None, mode: str = "strict", price_style: str = "digits",
                 failed_col: str | None = None, link_col: str | None = None, page_col: str = "page") -> DataFrame:
    """K6 over cards: pages -> cards -> cut at the first page without cards
    or the first failed one (B16, B17) -> price (H1/H2) -> validity (B5
    ``strict``, B6 ``lenient``, B7 ``tag``; ``priced``: B7 and a price, B2) ->
    per-category sink (A7) -> one table again (U1).

    A card without a price text is priced 0 in the strict style of H2 and has
    no price otherwise. ``link_col`` is the page's link for cards that have
    none of their own. Pages are parsed once: the card arrays, far smaller
    than the documents, are written to the checkpoint folder, and both the
    cut and the rows are read from there. Returns ``page_id, pos, title, price, url``
    and the category of the rows under ``path``."""
    if mode not in ("strict", "lenient", "tag", "priced"):
        raise ValueError(f"unknown validity mode {mode!r}")
    keep = list(dict.fromkeys(c for c in ("page_id", category_col, page_col, failed_col, link_col) if c))
    parsed = parse_cards(pages, selectors, keep).withColumn("n_cards", F.size("cards"))
    kept = crawl_cut(cut_lineage(parsed, "page-cards"), category_col, page_col, failed_col=failed_col)
    own = F.col("c.href") if link_col is None else F.coalesce("c.href", link_col)
    cards = kept.select(*keep, F.posexplode("cards").alias("pos0", "c")).select(
        "page_id", category_col, (F.col("pos0") + 1).alias("pos"), F.col("c.title").alias("title"),
        parse_price(F.col("c.price_text"), price_style).alias("price"), own.alias("href"),
    )
    valid = listing_valid(F.col("title"), F.col("price"), F.col("href"), "tag" if mode == "priced" else mode)
    if mode == "priced":
        valid = valid & F.col("price").isNotNull()
    rows = cards.where(valid).select("page_id", "pos", "title", "price", url_relative("href", domain).alias("url"), category_col)
    save_by_category(rows, path, category_col)
    return pages.sparkSession.read.schema(rows.schema).parquet(path)
