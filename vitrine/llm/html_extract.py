"""Main text of web pages by equivalence-class template deduction.

1. Of all pages of a host, tokens (a tag with its path of enclosing elements, a text block with
   its path) that occur equally often on every page form a class.
2. A class is valid if its tag tokens come in one order wherever it occurs, and its occurrences lie inside or
   beside those of other classes, never across: valid classes nest into the host's template.
3. The gaps between consecutive template tokens are the slots. What a slot holds on all pages (amount of text, share of
   links, number of different texts) tells articles from link lists and notices that rotate.
4. Of a page, the blocks of its article's slots are the text. The lists of element and class names below decide on hosts
   with few pages, and where a slot alone says nothing.
"""

from __future__ import annotations

import bisect
import functools
import re
from dataclasses import dataclass
from html import unescape

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import text_or_empty, written

#: A class belongs to the template if its tokens lie on so many distinct pages of the host at least, and on this share of them.
MIN_PAGES, MIN_SHARE = 3, 0.3
#: Tokens with one occurrence vector that make a class.
MIN_CLASS = 2
#: Rows of a host are dealt into so many parts when its template is joined to them.
SALTS = 16
#: A slot is a link list if this share of its text on all pages stands in links; it holds rotating notices if on so many
#: pages or more its texts repeat so that at most this share of them differ; it is part of the main text of pages without
#: an article if its text times its variety reaches this share of the largest slot's.
LINK_SLOT, ROTATING, MAIN_SLOT = 0.8, (10, 0.1), 0.05
#: An article element is a teaser beside the text if it has less than this share of the text outside articles or in the largest one.
TEASER = 0.2

# Elements by what they mean for the text.
RAW = frozenset("script style noscript textarea title iframe".split())
#: Elements whose content is no text of the page.
UNSEEN = frozenset("svg math object select option optgroup button canvas audio video template datalist".split())
#: What may stand in a head; anything else ends it.
HEAD = frozenset("base head html link meta noscript script style template title".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: Elements that the stack follows; all others may be left open by their authors.
NESTED = frozenset("article aside body blockquote details dialog div dl fieldset figure footer form header main menu nav ol section table td th tr ul".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
BOILER_TAGS = frozenset("aside dialog fieldset footer form menu nav".split())
BOILER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertisements adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies disqus footer gdpr header login masthead menu modal nav navbar navigation newsletter notice notices pager pagination "
    "popup promo promotion promotions related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription tags teaser toolbar topbar widget".split()
)
#: Of these, words that also hold for an article element (a reader's comment is often one).
BOILER_ARTICLES = frozenset("ad ads advert comment comments promo related replies reply sponsored teaser".split())
#: Inside an article these words alone can be the topic of a section ...
TOPICS = frozenset("banner consent cookie cookies header login menu navigation newsletter notice notices promotion promotions related reply search share "
                   "sharing social sponsor subscription tags widget".split())
#: ... and only these parts beside a boilerplate word make a boilerplate name.
PARTS = frozenset("area articles bar block bottom box button buttons container content form icons inline inner item items left link links list media more "
                  "outer panel posts right section slot stories top unit wrapper".split())
CONTENT_WORDS = frozenset("article content entry post story".split())

TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<(?P<raw>" + "|".join(sorted(RAW)) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*+)(?P<attrs>(?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|<[!?/][^>]*+>|<(?P<broken>/?[a-zA-Z][^>]*+)>|<[!?/a-zA-Z][^>]*+\Z",
    re.S | re.I,
)
ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


SPOILS = re.compile(r"class|id\s*=|hidden|style|role", re.I)


@dataclass(slots=True)
class Block:
    text: str
    rank: int  # 2 inside an article, 1 inside other content, 0 elsewhere
    boiler: bool
    linked: float  # share of the text that stands in links
    token: int
    heading: bool = False
    region: int = 0  # the outermost article or content element around it
    suspect: int = 0  # the outermost element around it whose name only suggests boilerplate
    at: int = 0  # tag tokens before it


@dataclass(slots=True)
class Frame:
    """An open element."""

    name: str
    path: str
    rank: int = 0
    boiler: bool = False
    own: bool = False  # boilerplate of the element's own kind
    doubt: bool = False  # boilerplate where it is mostly links
    region: int = 0
    suspect: int = 0


def _hash(*parts: str) -> int:
    return xxhash.xxh64_intdigest("\x1f".join(parts)) - (1 << 63)


def _split(name: str) -> list[str]:
    return re.findall(r"[a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower())


@functools.lru_cache(maxsize=4096)
def _attributes(attrs: str) -> tuple[dict, list[list[str]], bool]:
    """(attributes, words of each class name and of the id, hidden)."""
    found = {k.lower(): unescape(a or b or c) for k, a, b, c in ATTR.findall(attrs)}
    names = [_split(n) for n in f"{found.get('class', '')} {found.get('id', '')}".split()]
    hidden = bool(HIDDEN.search(found.get("style", ""))) or found.get("aria-hidden", "").lower() == "true" or bool(
        re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", re.sub(r"\"[^\"]*\"|'[^']*'", "", attrs), re.I))
    return found, names, hidden


def _whole(names: list[list[str]], words: frozenset, topics: frozenset = frozenset()) -> bool:
    """Whether a name is made of these words and neutral parts only (a topic word alone is none)."""
    for parts in names:
        if any(w in words for w in parts) and all(w in words or w in PARTS or w.isdigit() for w in parts) and (
                len(parts) > 1 or parts[0] not in topics):
            return True
    return False


@functools.lru_cache(maxsize=4096)
def _spoilt(attrs: str) -> bool:
    """Whether the attributes of a paragraph, list item or inline element make it boilerplate."""
    if not SPOILS.search(attrs):
        return False
    found, names, hidden = _attributes(attrs)
    return hidden or found.get("role", "").lower() in BOILER_ROLES or _whole(names, BOILER_WORDS)


@functools.lru_cache(maxsize=4096)
def _meaning(name: str, attrs: str):
    """(boilerplate by the element itself, by a whole name, by a word of a name, content by its names, label)."""
    if not attrs.strip():
        return name in BOILER_TAGS, False, name == "header", False, name
    found, names, hidden = _attributes(attrs)
    label = f"{found.get('class', '')} {found.get('id', '')}".lower()
    role = found.get("role", "").lower()
    by_tag = name in BOILER_TAGS or hidden or role in BOILER_ROLES
    if name in ("article", "main"):  # blog software writes topics and tags into the class of an article
        return by_tag or _whole(names, BOILER_ARTICLES), False, False, False, f"{name} {label}"
    if name in ("body", "html"):
        return hidden, False, False, False, name
    words = {w for n in names for w in n}
    return (by_tag, _whole(names, BOILER_WORDS, TOPICS), name == "header" or bool(words & BOILER_WORDS),
            bool(words & CONTENT_WORDS) or role in ("main", "article"), f"{name} {label}")


class Ends:
    """Whether an element that cannot hold its own kind has an end tag."""

    def __init__(self, html: str):
        self.html, self.known = html, {}

    def of(self, name: str, at: int) -> int | None:
        """Where its end tag ends, if that comes before the next start tag of the same name."""
        if name not in self.known:
            tags = [(m.start(), m.end(), m[0][1] == "/") for m in re.finditer(rf"</?{re.escape(name)}(?![a-zA-Z0-9:-])[^>]*>", self.html, re.I)]
            self.known[name] = [t[0] for t in tags], tags
        starts, tags = self.known[name]
        i = bisect.bisect_left(starts, at)
        return tags[i][1] if i < len(tags) and tags[i][2] else None


def parse(html: str) -> tuple[list[Block], list[int]]:
    """The text blocks of a page, in order, and its tag tokens in order (a tag with its
    path of enclosing elements; a block's token is its text with its path)."""
    blocks: list[Block] = []
    tokens: list[int] = []
    stack = [Frame("", "")]
    pieces: list[str] = []
    linked, in_link, head, heading = 0, 0, False, False
    skip = 0  # what stands before this place is no text
    loose = False  # in an element without end tag whose content is no text: up to the next block
    inline, depth = "", 0  # in an inline element that is boilerplate
    regions = 0
    ends = Ends(html)

    def flush():
        nonlocal linked, inline, depth
        inline, depth = "", 0
        if pieces:
            text = " ".join("".join(pieces).split())
            if text:
                f = stack[-1]
                share = min(1.0, linked / max(1, len(text)))
                blocks.append(Block(text, f.rank, f.boiler or f.doubt and share > 0.5, share, _hash("t", f.path, text), heading,
                                    f.region, f.suspect, len(tokens)))
            pieces.clear()
        linked = 0

    def say(text: str):
        nonlocal linked, head
        if not text or loose or inline:
            return
        if head:
            if not text.strip():
                return
            head = False
        if "&" in text:
            text = unescape(text)
        pieces.append(text)
        if in_link:
            linked += len(text.strip())

    at = 0
    for m in TAG.finditer(html):
        if m.start() < skip:
            continue
        if at < m.start():
            say(html[at: m.start()])
        at = m.end()
        name = m["name"]
        if m["broken"]:
            name = re.match(r"/?([a-zA-Z][a-zA-Z0-9:-]*)", m["broken"])[1]
        if not name:
            continue
        name = name.lower()
        closing = bool(m["close"]) or bool(m["broken"] and m["broken"][0] == "/")
        attrs = m["attrs"] or ""
        if name == "head":
            flush()
            head = not closing
            continue
        if head and not closing and name not in HEAD:
            head = False
        if name in UNSEEN:
            loose = False
            if not closing and not attrs.rstrip().endswith("/"):
                end = ends.of(name, at)
                if end is None:
                    loose = True
                else:
                    skip = at = end
        elif name in BLOCKS:
            loose = False
            flush()
            heading = not closing and name in HEADINGS
            tokens.append(_hash("/" if closing else "", stack[-1].path, name))
            if stack[-1].name == "p" or stack[-1].name == name == "li":  # a boilerplate paragraph or item that its author left open
                stack.pop()
                if closing and name == "p":
                    continue
            if name not in NESTED:
                if closing:
                    if stack[-1].name == name:
                        stack.pop()
                elif attrs and _spoilt(attrs):
                    f = stack[-1]
                    stack.append(Frame(name, f"{f.path}>{name}", f.rank, True, True, f.doubt, f.region, f.suspect))
                continue
            if closing:
                for i in range(len(stack) - 1, 0, -1):
                    if stack[i].name == name:
                        del stack[i:]
                        break
                continue
            f = stack[-1]
            by_tag, by_name, by_word, content, label = _meaning(name, attrs)
            path = f"{f.path}>{label}"
            if name in ("article", "main") and not by_tag:
                # wrappers that only carry a suspicious name do not spoil the article in them
                regions += 1
                new = f.region if f.rank == 2 or name == "main" and f.region else regions
                stack.append(Frame(name, path, max(f.rank, 2 if name == "article" else 1), f.own, f.own, f.doubt, new, 0))
                continue
            header = name == "header" and f.rank == 2  # an article's own header holds its title
            spoils = by_name or by_word
            regions += 1
            inside = f.rank == 2
            unsure = by_word and inside and not header and not by_name
            suspect = f.suspect or (regions if spoils and not inside and not by_tag and name != "header" else 0)
            bad = by_tag or (not inside and name == "header") or (inside and by_name and not header)
            rank, region = f.rank, f.region
            if content and not (by_tag or spoils):
                rank, region = max(rank, 1), region or regions
            stack.append(Frame(name, path, rank, f.boiler or bad, f.own or by_tag, f.doubt or unsure, region, suspect))
        elif name == "br":
            if not loose and not inline:
                pieces.append(" ")
        elif inline:
            if name == inline:
                depth += -1 if closing else 1
                if not depth:
                    inline = ""
        else:
            if name == "a":
                in_link = 0 if closing else 1
            if not closing and attrs and name not in VOID and _spoilt(attrs):
                inline, depth = name, 1
    if skip <= at:
        say(html[at:])
    flush()
    return _suspects(blocks), tokens


def _suspects(blocks: list[Block]) -> list[Block]:
    """An element whose name suggests boilerplate is that, unless most of the
    page's other text stands in it (a layout named after its sidebar)."""
    mass: dict[int, int] = {}
    for b in blocks:
        if not b.boiler:
            mass[b.suspect] = mass.get(b.suspect, 0) + len(b.text)
    total = sum(mass.values())
    for b in blocks:
        if b.suspect and 2 * mass.get(b.suspect, 0) <= total:
            b.boiler = True
    return blocks


def article_blocks(blocks: list[Block]) -> list[Block]:
    """The blocks inside the page's article, or inside its other content
    elements; none if it has neither. Teasers beside the text are left out: article
    elements that are small beside the page's other content, and
    small ones that are mostly links beside the largest."""
    mass: dict[int, int] = {}
    links: dict[int, float] = {}
    articles, other = set(), 0
    for b in blocks:
        if b.boiler or not b.rank:
            continue
        mass[b.region] = mass.get(b.region, 0) + len(b.text)
        links[b.region] = links.get(b.region, 0) + b.linked * len(b.text)
        if b.rank == 2:
            articles.add(b.region)
        else:
            other += len(b.text)
    inside = [b for b in blocks if not b.boiler and b.rank]
    of_articles = sum(len(b.text) for b in inside if b.rank == 2)
    if articles and of_articles >= TEASER * other:
        top = max(mass[r] for r in articles)
        teaser = {r for r in articles if mass[r] < TEASER * top and links[r] > 0.5 * mass[r]}
        return [b for b in inside if b.rank == 2 and b.region not in teaser]
    return [b for b in inside if b.rank < 2]


def article_key(inside: list[Block]) -> int | None:
    """Names the article: prints, parts and edited copies of it share its
    first heading. Without a heading its text names it."""
    if not inside:
        return None
    return _hash("a", *next(([b.text] for b in inside if b.heading), [b.text for b in inside]))


def slots_of(blocks: list[Block], tokens: list[int], classes: dict[int, int]) -> list[int]:
    """The slot of each block: the last template tag token before it (0: none)."""
    out, last, done = [], 0, 0
    for b in blocks:
        for t in tokens[done: b.at]:
            if t in classes:
                last = t
        done = max(done, b.at)
        out.append(last)
    return out


def main_text(blocks: list[Block], template: frozenset | set, slots: list[int] | None = None, no_article: frozenset | set = frozenset(),
              minor: frozenset | set = frozenset()) -> str:
    """The blocks in the page's article that the template does not hold. An
    article that stands mostly in the template is a copy, and stays whole. Slots in
    ``no_article`` (link lists, rotating notices) go; those in ``minor`` go where the page has no
    article or content element."""
    of = {id(b): s for b, s in zip(blocks, slots or [])}
    inside = article_blocks(blocks)
    if inside:
        if 2 * sum(len(b.text) for b in inside if b.token in template) > sum(len(b.text) for b in inside):
            template = frozenset()
        kept = [b for b in inside if b.token not in template and of.get(id(b)) not in no_article]
        # a slot that holds the whole article is no list beside it
        kept = kept if 2 * sum(len(b.text) for b in kept) >= sum(len(b.text) for b in inside if b.token not in template) else [
            b for b in inside if b.token not in template]
        return "\n\n".join(b.text for b in kept)
    rest = [b for b in blocks if not b.boiler and b.token not in template and b.linked <= 0.5]
    main = [b for b in rest if of.get(id(b)) not in no_article and of.get(id(b)) not in minor]
    return "\n\n".join(b.text for b in main or rest)


def _tokens(batches):
    """(host, page, token, times) of each page: ``page`` stands for its text,
    so copies of a page are one page. The root token 0 lies once on each. It and the
    blocks inside an article also name the article."""
    for batch in batches:
        hosts, pages, tokens, times, texts, articles = [], [], [], [], [], []
        for host, html in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
            blocks, tags = parse(html)
            page = _page(blocks)
            seen: dict[int, int] = {}
            for t in tags:
                seen[t] = seen.get(t, 0) + 1
            of_text = {b.token for b in blocks}
            inside = article_blocks(blocks)
            article, of_article = article_key(inside), {0, *(b.token for b in inside)}
            for b in blocks:
                seen[b.token] = seen.get(b.token, 0) + 1
            seen[0] = 1
            n = len(seen)
            hosts += [host] * n
            pages.append(np.full(n, page, np.int64))
            tokens += seen.keys()
            times += seen.values()
            texts += [t in of_text for t in seen]
            articles += [article if t in of_article else None for t in seen]
        if hosts:
            yield pa.RecordBatch.from_arrays(
                [pa.array(hosts, pa.string()), pa.array(np.concatenate(pages)), pa.array(np.array(tokens, np.int64)), pa.array(np.array(times, np.int64)), pa.array(texts), pa.array(articles, pa.int64())],
                ["host", "page", "token", "times", "is_text", "article"])


def _page(blocks: list[Block]) -> int:
    return _hash("p", *[b.text for b in blocks])


def orders(tokens: list[int], classes: dict[int, int], sizes: dict[int, int]) -> dict[int, tuple[int, bool]]:
    """For each class on the page: (its tokens in order, hashed; whether
    it is in order and nested). A class of n tag tokens is in order if it reads as one
    sequence of its n tokens over and over, and nested if no other class that
    opens inside an occurrence is still open when that goes on."""
    found: dict[int, list[int]] = {}
    for t in tokens:
        if t in classes:
            found.setdefault(classes[t], []).append(t)
    good = {}
    for c, sequence in found.items():
        first = sequence[: sizes[c]]
        good[c] = len(set(first)) == sizes[c] and sequence == first * (len(sequence) // sizes[c])
    place = {c: {t: i for i, t in enumerate(found[c][: sizes[c]])} for c in found if good[c]}
    stack: list[int] = []  # open occurrences
    for t in tokens:
        c = classes.get(t)
        if c is None or not good.get(c):
            continue
        i = place[c][t]
        if i and c in stack:
            while stack[-1] != c:
                good[stack.pop()] = False  # opened inside, not finished
        elif not i and sizes[c] > 1:
            stack.append(c)
        if i and i == sizes[c] - 1 and stack and stack[-1] == c:
            stack.pop()
    for c in stack:
        good[c] = False
    return {c: (_hash("o", *map(str, found[c][: sizes[c]])), good[c]) for c in found}


def _slots(batches):
    """Per page: a row for each class on it (its order, whether it nests) and one for
    each slot (its text, how much of that is linked, whether it lies in the article)."""
    for batch in batches:
        out: dict[str, list] = {k: [] for k in ("host", "key", "is_class", "page", "text", "ok", "chars", "linked")}

        def put(*values):
            for k, v in zip(out, values):
                out[k].append(v)

        for host, html, known in zip(*(batch.column(k).to_pylist() for k in ("host", "html", "classes"))):
            if not known:
                continue
            classes = {x["token"]: x["class_id"] for x in known}
            sizes: dict[int, int] = {}
            for c in classes.values():
                sizes[c] = sizes.get(c, 0) + 1
            blocks, tokens = parse(html)
            page = _page(blocks)
            for c, (order, ok) in orders(tokens, classes, sizes).items():
                put(host, c, True, page, order, ok, 0, 0)
            inside = {id(b) for b in article_blocks(blocks)}
            held: dict[int, list[Block]] = {}
            for b, s in zip(blocks, slots_of(blocks, tokens, classes)):
                if not b.boiler:
                    held.setdefault(s, []).append(b)
            for s, bs in held.items():
                put(host, s, False, page, _hash("s", *[b.text for b in bs]), any(id(b) in inside for b in bs), sum(len(b.text) for b in bs),
                    round(sum(b.linked * len(b.text) for b in bs)))
        if out["host"]:
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(out[k], t) for k, t in zip(out, kinds)], list(out))


def host_of(url) -> "F.Column":
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)", 1))


def templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE, min_class: int = MIN_CLASS) -> DataFrame:
    """``host, class_id, support, tokens, texts`` of each valid class.

    A token's occurrence vector (how often it lies on each distinct page of
    the host) is summed into one fingerprint, so a host with a third of all
    pages sends partial sums, never its pages, to a task. Tokens of equal vector
    are a class. Valid classes have tokens enough, and lie on enough pages; since a
    token names its path of enclosing elements, the classes nest as the elements do.
    Of ``texts``, those inside articles must lie in as many different articles, and in that share of the host's."""
    found = pages.select("host", "html").mapInArrow(_tokens, "host string, page long, token long, times long, is_text boolean, article long")
    cells = found.groupBy("host", "token", "page").agg(F.max("times").alias("times"), F.max("is_text").alias("is_text"), F.max("article").alias("article"))
    vectors = written(cells.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("page", "times")).alias("vector"), F.max("is_text").alias("is_text"),
        F.count_distinct("article").alias("articles")
    ).where((F.col("n") >= min_pages)), "html-vectors")
    size = vectors.where("token = 0").select("host", F.col("n").alias("distinct_pages"), F.col("articles").alias("distinct_articles"))
    classes = vectors.where("token <> 0").groupBy("host", F.xxhash64("n", "vector").alias("class_id"), "n").agg(
        F.count(F.lit(1)).alias("size"), F.collect_list("token").alias("tokens"),
        F.collect_list(F.when(F.col("is_text"), F.struct("token", "articles"))).alias("texts"))
    common = lambda x: (x["articles"] == 0) | (x["articles"] >= min_pages) & (x["articles"] >= min_share * F.col("distinct_articles"))
    return classes.join(size, "host").where((F.col("size") >= min_class) & (F.col("n") >= min_share * F.col("distinct_pages"))).select(
        "host", "class_id", F.col("n").alias("support"), "tokens", F.transform(F.filter("texts", common), lambda x: x["token"]).alias("texts"),
        F.array_except("tokens", F.transform("texts", lambda x: x["token"])).alias("tags"))


def with_host(rows: DataFrame, of_host: DataFrame) -> DataFrame:
    """``rows`` with what is known of their host (one row per host), a large
    host's rows dealt into parts that each get a copy. Hosts without a row get nulls."""
    copies = of_host.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).withColumnRenamed("host", "__host")
    dealt = rows.withColumn("__part", F.pmod(F.xxhash64("html"), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, (F.col("host") == F.col("__host")) & (F.col("__part") == F.col("__salt")), "left").drop("__host", "__salt", "__part")


def deduced(pages: DataFrame, min_pages: int = MIN_PAGES, **rules) -> DataFrame:
    """``host, constant, classes, no_article, minor``: of each host with a template its constant
    texts, the tag tokens of its valid nested classes, and the slots that hold link lists or rotating
    notices, or are small beside the host's main slots."""
    classes = written(templates(pages, min_pages=min_pages, **rules), "html-classes")
    tags = classes.select("host", "class_id", F.explode("tags").alias("token"))
    of_host = tags.groupBy("host").agg(F.collect_list(F.struct("token", "class_id")).alias("classes"))
    schema = "host string, key long, is_class boolean, page long, text long, ok boolean, chars long, linked long"
    rows = with_host(pages, of_host).where(F.col("classes").isNotNull()).select("host", "html", "classes").mapInArrow(_slots, schema)
    # copies of a page count once
    rows = rows.groupBy("host", "key", "is_class", "page").agg(
        F.min("text").alias("text"), F.bool_and("ok").alias("ok"), F.max("chars").alias("chars"), F.max("linked").alias("linked"))
    stats = written(rows.groupBy("host", "key", "is_class").agg(
        F.count(F.lit(1)).alias("n"), F.min("text").alias("low"), F.max("text").alias("high"), F.bool_and("ok").alias("all_ok"),
        F.bool_or("ok").alias("any_ok"), F.approx_count_distinct("text").alias("texts"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked")),
        "html-slots")
    valid = stats.where("is_class AND all_ok AND low = high").select("host", F.col("key").alias("class_id"))
    good = tags.join(valid, ["host", "class_id"])
    slots = stats.where("NOT is_class").join(good.select("host", F.col("token").alias("key")), ["host", "key"])
    weight = F.col("chars") / F.col("n") * F.least(F.lit(1.0), F.col("texts") / F.col("n"))
    top = slots.groupBy("host").agg(F.max(weight).alias("top"))
    n, share = ROTATING
    links = F.col("linked") >= LINK_SLOT * F.col("chars")
    rotating = (F.col("n") >= n) & (F.col("texts") <= share * F.col("n")) & ~F.col("any_ok")
    judged = slots.join(top, "host").select("host", "key", (F.col("n") >= min_pages) & (links | rotating), weight < MAIN_SLOT * F.col("top")).toDF(
        "host", "key", "list", "small")
    verdict = judged.groupBy("host").agg(F.collect_list(F.when(F.col("list"), F.col("key"))).alias("no_article"),
                                         F.collect_list(F.when(F.col("small"), F.col("key"))).alias("minor"))
    tokens = good.groupBy("host").agg(F.collect_list("token").alias("classes"))
    constant = classes.select("host", F.explode("texts").alias("t")).groupBy("host").agg(F.collect_set("t").alias("constant"))
    return constant.join(tokens, "host", "full").join(verdict, "host", "full")


def _extract(keep: list[str]):
    def run(batches):
        for batch in batches:
            texts = []
            known = [batch.column(k).to_pylist() for k in ("html", "constant", "classes", "no_article", "minor")]
            for html, constant, classes, no_article, minor in zip(*known):
                blocks, tokens = parse(html)
                slots = slots_of(blocks, tokens, dict.fromkeys(classes)) if classes else None
                texts.append(main_text(blocks, set(constant or ()), slots, set(no_article or ()), set(minor or ())))
            yield pa.RecordBatch.from_arrays([*[batch.column(k) for k in keep], pa.array(texts, pa.string())], [*keep, "text"])

    return run


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", **rules) -> DataFrame:
    """id, url, ``text`` and ``n_chars`` of every page: the article's blocks in
    page order, joined by two line feeds.

    The template of a host is deduced from all its pages. Text that belongs to it
    (the same block at the same place on many pages) is no slot and goes;
    of the slots, those inside boilerplate elements (menus, headers,
    footers, sidebars, notices, adverts, forms, comments, hidden elements) go
    too, and so do slots that hold link lists on all the host's pages, or, outside articles, a few notices in turn.
    Blocks inside an article are template only if they stand in several different
    articles, and an article that is mostly template stays whole. What is left inside ``article`` is the text; without one (or with a teaser
    only), what lies inside other content elements, else the slots with the host's mass of varying text.

    Null html is an empty page with an empty text; pages without a url make
    a host of their own; a host with fewer than three distinct pages has no template, so
    only the elements decide; repeated pages count once in the vectors and
    each has its row; broken markup never fails; an empty table gives an
    empty result; other columns are not read."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), text_or_empty(html_col).alias("html")).withColumn("host", host_of(F.col("url")))
    joined = with_host(rows, written(deduced(rows, **rules), "html-templates")).select("id", "url", "html", "constant", "classes", "no_article", "minor")
    schema = T.StructType([f for f in joined.schema.fields if f.name in ("id", "url")] + [T.StructField("text", T.StringType())])
    text = joined.mapInArrow(_extract(["id", "url"]), schema)
    return text.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
