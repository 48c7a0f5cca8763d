"""CSS selectors as one stack automaton over parse events.

Every selector is a chain of compound conditions with combinators between them. All
compounds of all selectors get one bit each. Of an element, bit i says that it ends a
match of its selector's first compounds up to i; that follows from the bits of
its ancestors (blank), its parent (``>``), its previous sibling (``+``) or any earlier
sibling (``~``). So a start tag costs one pass over the compounds, however deep it stands, and
an end tag one pop; the page is never held as a tree.

Supported: tag, ``*``, ``.class``, ``#id``, ``[a]``, ``[a=b]``, ``[a~=b]``, ``[a|=b]``, ``[a^=b]``, ``[a$=b]``,
``[a*=b]`` (a trailing ``i`` ignores case), ``:not(...)`` of one compound, ``:first-child``, ``:nth-child``,
``:first-of-type``, ``:nth-of-type`` (``an+b``, ``odd``, ``even``), all four combinators and lists with commas.
What needs the elements that come after (``:last-child``, ``:has``) is refused.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

_NAME = r"(?:[\w-]|[^\x00-\x7f]|\\.)+"
_TOKEN = re.compile(rf"""
    (?P<attr>\[\s*(?P<a>{_NAME})\s*(?:(?P<op>[~|^$*]?=)\s*(?:"(?P<q>[^"]*)"|'(?P<s>[^']*)'|(?P<v>[^\]\s]+))\s*(?P<i>[iI])?\s*)?\])
  | \.(?P<cls>{_NAME}) | \#(?P<id>{_NAME}) | (?P<not>:not\(\s*) | :(?P<pseudo>[\w-]+)(?:\(\s*(?P<arg>[^)]*)\))?
  | (?P<any>\*) | (?P<tag>{_NAME}) | (?P<close>\s*\)) | (?P<comma>\s*,\s*) | (?P<comb>\s*[>+~]\s*|\s+)""", re.X)
_NTH = re.compile(r"\s*(?:(?P<a>[+-]?\d*)n\s*(?P<b>[+-]\s*\d+)?|(?P<k>[+-]?\d+))\s*$")


@dataclass(frozen=True)
class Element:
    tag: str
    attrs: dict
    index: int  #: place among the element children of its parent, from 1
    of_type: int  #: place among those of its tag


def _nth(text: str):
    """(a, b) of ``an+b``."""
    word = text.strip().lower()
    if word in ("odd", "even"):
        return 2, int(word == "odd")
    m = _NTH.match(word)
    if not m:
        raise ValueError(f"{text!r} is no an+b")
    if m["k"]:
        return 0, int(m["k"])
    a = m["a"]
    return (int(a + "1") if a in ("", "+", "-") else int(a)), int((m["b"] or "0").replace(" ", ""))


def _is_nth(i: int, a: int, b: int) -> bool:
    return i == b if a == 0 else (i - b) % abs(a) == 0 and (i - b) // a >= 0


def _attribute(name, op, value, fold):
    def test(e: Element) -> bool:
        if name not in e.attrs:
            return False
        have, want = (e.attrs[name] or "", value) if not fold else ((e.attrs[name] or "").lower(), value.lower())
        if op is None:
            return True
        if op == "=":
            return have == want
        if op == "~=":
            return want in have.split()
        if op == "|=":
            return have == want or have.startswith(want + "-")
        if want == "":  # the other operators match nothing then
            return False
        return have.startswith(want) if op == "^=" else have.endswith(want) if op == "$=" else want in have

    return test


def _plain(name: str) -> str:
    return re.sub(r"\\(.)", r"\1", name)


def _condition(m: re.Match, text: str):
    if m["attr"]:
        value = next((m[k] for k in ("q", "s", "v") if m[k] is not None), None)
        return _attribute(_plain(m["a"]).lower(), m["op"], value, bool(m["i"]))
    if m["cls"]:
        return _attribute("class", "~=", _plain(m["cls"]), False)
    if m["id"]:
        return _attribute("id", "=", _plain(m["id"]), False)
    if m["tag"]:
        tag = _plain(m["tag"]).lower()
        return lambda e: e.tag == tag
    if m["any"]:
        return lambda e: True
    name = (m["pseudo"] or "").lower()
    if name in ("first-child", "first-of-type") and m["arg"] is None:
        a, b = 0, 1
    elif name in ("nth-child", "nth-of-type") and m["arg"]:
        a, b = _nth(m["arg"])
    else:
        raise ValueError(f"selector {text!r} is not supported at {m[0]!r}")
    if name.endswith("child"):
        return lambda e: _is_nth(e.index, a, b)
    return lambda e: _is_nth(e.of_type, a, b)


def parse(text: str) -> list[list[tuple[str, list]]]:
    """The selectors of a list: each a list of (combinator before it, conditions)."""
    out, chain, conditions, comb, negated, at = [], [], [], "", None, 0
    body = text.strip()

    def end_compound():
        nonlocal conditions
        if not conditions or negated is not None:
            raise ValueError(f"selector {text!r} has an empty part")
        chain.append((comb, conditions))
        conditions = []

    while at < len(body):
        m = _TOKEN.match(body, at)
        if not m:
            raise ValueError(f"selector {text!r} is not supported at {body[at:]!r}")
        at = m.end()
        if m["comma"]:
            end_compound()
            out.append(chain)
            chain, comb = [], ""
        elif m["comb"] and negated is None:
            end_compound()
            comb = m["comb"].strip() or " "
        elif m["not"] and negated is None:
            negated = []
        elif m["close"] and negated:
            inner, negated = negated, None
            conditions.append(lambda e, inner=inner: not all(c(e) for c in inner))
        elif m["comb"] or m["not"] or m["close"]:
            raise ValueError(f"selector {text!r} is not supported at {m[0]!r}")
        else:
            (conditions if negated is None else negated).append(_condition(m, text))
    end_compound()
    return [*out, chain]


class Automaton:
    """Selectors (by name) compiled to bits; ``run()`` starts over a page or a part of one."""

    def __init__(self, selectors: dict[str, str]):
        self.steps: list[tuple[list, str, int]] = []  # (conditions, combinator, bit that must hold before)
        self.accepts: dict[str, int] = {}
        for name, text in selectors.items():
            self.accepts[name] = 0
            for chain in parse(text):
                for k, (comb, conditions) in enumerate(chain):
                    self.steps.append((conditions, comb if k else "", 1 << (len(self.steps) - 1) if k else 0))
                self.accepts[name] |= 1 << (len(self.steps) - 1)

    def run(self) -> Run:
        return Run(self)


class Run:
    """The open elements, each as four sets of bits: its own, those of its
    ancestors, those of its last child so far and of all children so far."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.stack = [[0, 0, 0, 0]]

    def push(self, element: Element) -> int:
        """Opens an element; returns its bits."""
        parent = self.stack[-1]
        above = parent[0] | parent[1]
        before = {"": 0, " ": above, ">": parent[0], "+": parent[2], "~": parent[3]}
        own = 0
        for i, (conditions, comb, need) in enumerate(self.automaton.steps):
            if (not comb or before[comb] & need) and all(c(element) for c in conditions):
                own |= 1 << i
        parent[2] = own
        parent[3] |= own
        self.stack.append([own, above, 0, 0])
        return own

    def pop(self) -> None:
        self.stack.pop()

    def accepted(self, own: int, name: str) -> bool:
        return bool(own & self.automaton.accepts.get(name, 0))


class Places:
    """Gives each element its place among its siblings."""

    def __init__(self):
        self.children = [Counter()]

    def push(self, tag: str, attrs: dict) -> Element:
        here = self.children[-1]
        here[None] += 1
        here[tag] += 1
        self.children.append(Counter())
        return Element(tag, attrs, here[None], here[tag])

    def pop(self) -> None:
        self.children.pop()
