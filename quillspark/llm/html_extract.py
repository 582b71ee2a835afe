"""HTML extraction (operator 4): a tree-structured graphical model over the DOM.

Block elements are nodes with a hidden label, content or not.  A child's label depends on its parent's
(the pairwise potential) and a node's features on its label: its tag and what its names say, its own text and
the texts next to it, and how text and links are spread under it.  One upward and one downward pass of sum-product
messages give the exact marginal of each node; blocks whose node is more likely content than not
make up the text.  All tables are estimated from labelled pages, which label_pages() writes: pages
of many layouts whose content nodes carry a mark.

Markup is read as browsers read it, as far as text needs it: attribute quoting, elements whose text is raw,
implied ends, and end tags that match nothing.  Each tag takes constant time over all, however deep the page is.
"""

from __future__ import annotations

import functools
import html
import math
import random
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled pages that the model is trained on, and their seed.
PAGES, SEED = 700, 4
MARK = "data-content-label"

#: A name, then a value in quotes only if they follow the equals sign at once.
ATTRIBUTE = r"""=?[^\s/>=]+(?:\s*=\s*(?:"[^"]*(?:"|\Z)|'[^']*(?:'|\Z)|[^\s>"'][^\s>]*)?)?"""
TOKEN = re.compile(rf"<!--(?:-?>|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]+|{ATTRIBUTE}|=)*+)(?:>|\Z)", re.S)
NAMED = re.compile(r"""(?<![^\s/])(class|id|role)\s*=\s*(?:"([^"]*)|'([^']*)|([^\s>"'][^\s>]*))|=\s*(?:"[^"]*"?|'[^']*'?)""", re.I)
#: Elements whose content is raw up to their own end tag.
RAW = frozenset("script style textarea title iframe xmp noembed noframes".split())
#: Elements whose text is not shown, or no part of a text; any block element ends those of FIELDS.
MUTE = frozenset("noscript template svg canvas audio video button select option optgroup datalist".split())
FIELDS = frozenset("svg select option optgroup datalist".split())
VOID = frozenset("area base br col embed img input link meta param source track".split())
BLOCK = frozenset(
    "html body div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr td th caption article section main nav header footer "
    "aside form fieldset legend figure figcaption blockquote pre address details summary dialog menu head center search hgroup".split()
)
HEADINGS = frozenset(f"h{i}" for i in range(1, 7))
CELL = ("td", "th", "caption")
ROW = (*CELL, "tr")
PART = (*ROW, "thead", "tbody", "tfoot")
#: What a start tag ends, up to the next scope; other blocks end a paragraph.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ROW, "td": CELL, "th": CELL, "tbody": PART, "thead": PART, "tfoot": PART}
SCOPES = frozenset("ul ol dl table body html article section main div nav aside header footer form td th caption".split())
#: End tags of other elements have no effect beyond these.
WALLS = frozenset(("table", *CELL))
TABLES = frozenset(("table", *PART))
#: What words in class, id and role say of an element; the first line that has one counts.
HINTS = [
    ("hidden", ""),  # by the attribute or the style, no name says so
    ("comment", "comment comments reply replies discuss discussion respond disqus"),
    ("ad", "ad ads advert adverts advertisement sponsor sponsored promo banner adslot"),
    ("notice", "cookie cookies consent notice alert popup modal gdpr newsletter subscribe signup overlay toast"),
    ("nav", "nav navbar menu breadcrumb breadcrumbs pagination pager toc navigation skip"),
    ("foot", "footer foot copyright legal colophon contentinfo"),
    ("side", "sidebar aside related widget recommended trending popular more tags complementary"),
    ("social", "share sharing social follow login search form toolbar"),
    ("head", "header masthead branding logo topbar site"),
    ("meta", "byline author meta dateline timestamp posted published"),
    ("main", "article content post entry story main body text prose page copy"),
]
#: Names that begin with one of these say what is elsewhere.
ABOUT = frozenset("has with without no is".split())
#: Elements whose texts look alike.
GROUPS = dict.fromkeys(HEADINGS, "h") | dict.fromkeys("li td th dt dd".split(), "i")
RANK_OF = {w: rank for rank, (_, words) in reversed(list(enumerate(HINTS))) for w in words.split()}
WORDS = re.compile(r"[a-z]+")
SENTENCE = re.compile(r"[.!?…。！？؟।][\"')»”」』]?\s*$")
#: Characters that each say as much as some letters of an alphabet: ideographs and syllables.
DENSE = re.compile(r"[\u3040-\u30ff\u3400-\u9fff\uac00-\ud7af\uf900-\ufaff]")
ATTRIBUTES = re.compile(r"""([^\s/=>]+)(?:\s*=\s*(?:"([^"]*)|'([^']*)|([^\s>]*)))?""")
UNSHOWN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
#: Wordings of short texts that are no part of an article.
FORMULA = re.compile(r"©|\(c\)|copyright|all rights reserved|cookies?\b|newsletter|subscribe|\b(?:log|sign) ?(?:in|up|out)\b|advertisement|sponsored|privacy policy|terms of (?:use|service)|read more|related (?:posts|articles|stories)|\bshare (?:this|on)\b|leave a (?:comment|reply)|skip to", re.I)


def units(text: str) -> int:
    """The length of a text in letters of an alphabet."""
    return len(text) if text.isascii() else len(text) + 2 * len(DENSE.findall(text))


def is_hidden(attributes: str) -> bool:
    """Whether the element is not shown: the attribute hidden (but not until-found), or a style of its own."""
    for m in ATTRIBUTES.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" and value.lower() != "until-found" or name == "style" and UNSHOWN.search(value):
            return True
    return False


def hint_of(attributes: str) -> str:
    low = attributes.lower()
    if ("hidden" in low or "none" in low) and is_hidden(attributes):
        return "hidden"
    best = len(HINTS)
    for m in NAMED.finditer(attributes):
        if m[1]:
            for name in (m[2] or m[3] or m[4] or "").split():
                words = WORDS.findall(name.lower())
                if words and words[0] not in ABOUT:
                    best = min(best, *(RANK_OF.get(w, best) for w in words), best)
    return HINTS[best][0] if best < len(HINTS) else "none"


#: Least length of a sentence that counts as prose.
PROSE = 40


class Node:
    __slots__ = ("tag", "hint", "label", "parent", "chars", "linked", "stops", "formula", "prose", "near", "all_chars", "all_linked", "all_prose", "most", "whole")

    def __init__(self, tag: str, attributes: str, parent: int):
        self.tag, self.parent = tag, parent
        self.hint = hint_of(attributes) if attributes and tag not in ("html", "body") else "none"
        self.label = bool(attributes) and MARK in attributes
        self.chars = self.linked = self.stops = self.formula = self.prose = self.near = 0
        self.all_chars = self.all_linked = self.all_prose = self.most = 0
        self.whole = 1

    def add(self, text: str, linked: int) -> None:
        size = units(text)
        self.chars += size
        self.linked += min(linked * size // max(1, len(text)), size)
        stop = bool(SENTENCE.search(text))
        self.stops += stop
        if len(text) < 200 and FORMULA.search(text):
            self.formula += 1
        if size >= PROSE and (stop or size >= 240) and 3 * linked < len(text):
            self.prose += size

    def features(self) -> tuple:
        """What is seen of the element; None where it says nothing."""
        spread = own = near = formula = None
        if self.all_chars > self.chars:  # text in elements under it
            share = 4 * self.all_prose // self.whole
            # of the elements that have all prose the innermost, where it parts, is told from those around it
            parts = self.all_prose > self.most
            spread = (self.tag in ("html", "body"), (share, parts) if self.all_prose else None, (4 * self.all_linked >= self.all_chars) + (4 * self.all_linked >= 3 * self.all_chars))
        if self.chars:
            length = (self.chars >= 25) + (self.chars >= 80) + (self.chars >= 240)
            links = 0 if not self.linked else 1 + (2 * self.linked >= self.chars)
            own = (GROUPS.get(self.tag, "p"), length, links, self.stops > 0)
            near = (length > 1, self.near)
            formula = self.formula > 0
        return (self.tag, self.hint), own, near, spread, formula

    def kind(self) -> tuple:
        """What the potential between this element and its children depends on."""
        return (self.tag, self.hint)


class Reader:
    """The open elements of a page, its block nodes and its blocks of text."""

    def __init__(self) -> None:
        self.nodes = [Node("#root", "", -1)]
        self.blocks: list[tuple[int, str]] = []
        self.stack: list[tuple[str, str, int]] = [("#root", "#root", 0)]  # name, kind, nearest block node
        # how many are open of each kind: since the last scope, since the last wall, at all, and inline ones since the last block
        self.scopes: list[tuple[str, Counter]] = [("#root", Counter())]
        self.walls: list[tuple[str, Counter]] = [("#root", Counter())]
        self.open: Counter = Counter()
        self.inline: list[Counter] = [Counter()]
        self.held: list[str] = []
        self.linked = self.muted = 0

    def push(self, name: str, attributes: str = "") -> None:
        kind = "h" if name in HEADINGS else name
        self.open[kind] += 1
        if name in BLOCK:
            self.flush()
            self.nodes.append(Node(name, attributes, self.stack[-1][2]))
            if self.nodes[self.stack[-1][2]].hint == "hidden":
                self.nodes[-1].hint = "hidden"
            self.stack.append((name, kind, len(self.nodes) - 1))
            self.scopes[-1][1][kind] += 1
            self.walls[-1][1][kind] += 1
            if name in SCOPES:
                self.scopes.append((kind, Counter()))
            if name in WALLS:
                self.walls.append((kind, Counter()))
            self.inline.append(Counter())
        else:
            self.stack.append((name, kind, self.stack[-1][2]))
            self.inline[-1][name] += 1
            self.muted += name in MUTE

    def pop(self) -> str:
        name, kind, _ = self.stack[-1]
        if name in BLOCK:
            self.flush()
            self.inline.pop()
            if name in SCOPES:
                self.scopes.pop()
            if name in WALLS:
                self.walls.pop()
            self.scopes[-1][1][kind] -= 1
            self.walls[-1][1][kind] -= 1
        else:
            self.inline[-1][name] -= 1
            self.muted -= name in MUTE
        self.stack.pop()
        self.open[kind] -= 1
        return kind

    def pop_to(self, kinds: tuple[str, ...]) -> None:
        while self.pop() not in kinds:
            pass

    def within_body(self) -> None:
        """A page without its outer tags has them all the same."""
        if self.stack[-1][0] in ("#root", "html"):
            self.push("body")

    def text(self, raw: str) -> None:
        if self.muted or self.stack[-1][0] in ("#root", "html") and raw.isspace():
            return
        self.within_body()
        if "&" in raw:
            raw = html.unescape(raw)
        self.held.append(raw)
        if self.open["a"]:
            self.linked += len(raw)

    def flush(self) -> None:
        """The text held so far is a block of the innermost block element."""
        if self.held:
            text = " ".join("".join(self.held).split())
            if text:
                owner = self.stack[-1][2]
                self.nodes[owner].add(text, self.linked)
                self.blocks.append((owner, text))
            self.held.clear()
        self.linked = 0

    def start(self, name: str, attributes: str) -> None:
        if name in VOID or name in ("hr", "wbr"):
            if name == "hr":
                self.flush()
            elif name != "wbr" and not self.muted:
                self.held.append(" ")
            return
        if name not in BLOCK:
            if name == "a" and "href" not in attributes.lower():
                return
            if name == "a" and self.inline[-1]["a"]:
                self.pop_to(("a",))
            self.within_body()
            self.push(name)
            return
        while self.muted and self.stack[-1][0] in FIELDS:
            self.pop()
        kinds = ENDS.get(name, ("p",))
        while self.scopes[-1][0] in kinds or any(self.scopes[-1][1][k] for k in kinds):
            self.pop_to(kinds)
        if name in HEADINGS and self.stack[-1][1] == "h" or self.stack[-1][0] == "head" and name != "head":
            self.pop()
        if name not in ("html", "head", "body"):
            self.within_body()
        elif self.open[name]:  # there is but one of these
            return
        self.push(name, attributes)

    def end(self, name: str) -> None:
        kind = "h" if name in HEADINGS else name
        if name == "br":
            self.held.append(" ")
        elif name not in BLOCK:
            if self.inline[-1][name]:
                self.pop_to((name,))
        elif self.walls[-1][0] == kind or self.walls[-1][1][kind] or name in TABLES and self.open[kind]:
            self.pop_to((kind,))
        elif name == "p":
            self.flush()

    def finish(self) -> tuple[list[Node], list[tuple[int, str]]]:
        self.flush()
        nodes = self.nodes
        for (a, before), (b, after) in zip(self.blocks, self.blocks[1:]):
            if a != b:  # whether the texts before and after it in the page, of other elements, are long
                nodes[b].near |= units(before) >= 60
                nodes[a].near |= 2 * (units(after) >= 60)
        for node in reversed(nodes):
            node.all_chars += node.chars
            node.all_linked += node.linked
            node.all_prose += node.prose
            if node.parent >= 0:
                above = nodes[node.parent]
                above.all_chars += node.all_chars
                above.all_linked += node.all_linked
                above.all_prose += node.all_prose
                above.most = max(above.most, node.all_prose)
        for node in nodes:
            node.whole = max(1, nodes[0].all_prose)
        return nodes, self.blocks


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Block nodes (parents before children) and the page's blocks of text with their node, in order."""
    reader = Reader()
    ends: dict[str, int] = {}  # where the next end tags of raw and mute elements are
    at, size = 0, len(page)
    while at < size:
        lt = page.find("<", at)
        if lt < 0:
            lt = size
        if lt > at:
            reader.text(page[at:lt])
        if lt == size:
            break
        m = TOKEN.match(page, lt)
        if not m:  # a lone <
            reader.text("<")
            at = lt + 1
            continue
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            reader.end(name)
            continue
        if name in RAW or name in MUTE:
            if ends.get(name, -1) < at:
                end = re.compile(f"</{re.escape(name)}(?=[\\s/>])", re.I).search(page, at)
                ends[name] = end.start() if end else size
            if ends[name] == size and name not in ("option", "optgroup"):
                # without an end tag a script is the rest of the page, of other elements only the tag goes
                if name in ("script", "style"):
                    break
                continue
            if name in RAW:
                close = page.find(">", ends[name])
                at = size if close < 0 else close + 1
                continue
        reader.start(name, m[3])
    return reader.finish()


class Model:
    """Conditional tables: features given the label, a child's label given its parent's."""

    def __init__(self, pages: list[str]):
        seen: list[list[Counter]] = []
        total = [0, 0]
        steps: dict[tuple, list[list[int]]] = {}
        whole = [[1, 1], [1, 1]]
        for page in pages:
            nodes, _ = parse(page)
            for node in nodes:
                f = node.features()
                if not seen:
                    seen = [[Counter(), Counter()] for _ in f]
                for table, value in zip(seen, f):
                    if value is not None:
                        table[node.label][value] += 1
                total[node.label] += 1
                if node.parent >= 0:
                    above = nodes[node.parent]
                    for kind in (above.kind(), above.hint):
                        steps.setdefault(kind, [[0, 0], [0, 0]])[above.label][node.label] += 1
                    whole[above.label][node.label] += 1
        # a kind of parent seen rarely, or under one label alone, leans on the table of all parents
        self.step = [[x / sum(row) for x in row] for row in whole]
        self.steps = {
            kind: [[(x + 2 * y) / (sum(row) + 2) for x, y in zip(row, prior)] for row, prior in zip(table, self.step)]
            for kind, table in steps.items()
        }
        # smoothed likelihood ratios, one table for each feature; unseen values say nothing
        self.ratio = []
        for none, content in seen:
            kinds = set(none) | set(content)
            n0, n1 = sum(none.values()) + len(kinds), sum(content.values()) + len(kinds)
            self.ratio.append({v: math.log((content[v] + 1) / n1) - math.log((none[v] + 1) / n0) for v in kinds})
        # what a tag and a hint say alone, for a tag with a hint never seen together
        for part in (0, 1):
            none, content = Counter(), Counter()
            for v, c in seen[0][0].items():
                none[v[part]] += c
            for v, c in seen[0][1].items():
                content[v[part]] += c
            kinds = set(none) | set(content)
            for v in kinds:
                self.ratio[0][(part, v)] = math.log((content[v] + 1) / (total[1] + len(kinds))) - math.log((none[v] + 1) / (total[0] + len(kinds)))

    def table(self, node: Node) -> list[list[float]]:
        """A child's label given this node's; of a tag never seen with these names, what the names alone say."""
        return self.steps.get(node.kind()) or self.steps.get(node.hint) or self.step

    def evidence(self, node: Node) -> float:
        if node.hint == "hidden":  # nor is anything in it shown
            return -60.0
        f = node.features()
        first = self.ratio[0].get(f[0])
        if first is None:
            first = self.ratio[0].get((0, node.tag) if node.hint == "none" else (1, node.hint), 0.0)
        return first + sum(table.get(v, 0.0) for table, v in zip(self.ratio[1:], f[1:]))

    def marginals(self, nodes: list[Node], given: int | None = None) -> list[float]:
        """The probability of content of each node; of a node that is given, and so of those around it, as content."""
        n = len(nodes)
        tables = [self.table(node) for node in nodes]
        # odds of the evidence in a node's own subtree, content against none
        own = [self.evidence(node) for node in nodes]
        if given:
            own[given] += 60.0
        up = [0.0] * n
        for i in range(n - 1, 0, -1):
            own[i] = max(-60.0, min(60.0, own[i]))
            e = math.exp(own[i])
            (s00, s01), (s10, s11) = tables[nodes[i].parent]
            up[i] = math.log((s10 + s11 * e) / (s00 + s01 * e))
            own[nodes[i].parent] += up[i]
        belief = [0.0] * n
        belief[0] = -60.0  # the page as a whole is no article
        for i in range(1, n):
            # what the parent believes without this child
            (s00, s01), (s10, s11) = tables[nodes[i].parent]
            e = math.exp(max(-60.0, min(60.0, belief[nodes[i].parent] - (up[i] if nodes[i].parent else 0.0))))
            belief[i] = own[i] + math.log((s01 + s11 * e) / (s00 + s10 * e))
        return [1 / (1 + math.exp(-max(-60.0, min(60.0, b)))) for b in belief]


class Writer:
    """Writes labelled pages: content elements of each carry MARK.  Layouts, wrappers, words and lengths vary."""

    MARKED = f' {MARK}="1"'
    SYLLABLES = ["ka", "lo", "mi", "ren", "tu", "sa", "ve", "don", "e", "ist"]

    #: Letters or syllables of other scripts, what words are joined by, and what ends a sentence.
    SCRIPTS = [
        ("да но ме ри ста ол ку в не тел".split(), " ", ".?!"),
        (list("的一是了我不在人有他这上大来以中到说"), "", "。？！"),
        (list("のにはをたがでとしれさあいうカキト水車"), "", "。"),
        ("ال من في على كان هذا ما لا قد".split(), " ", ".؟"),
        ("กา ที่ นี่ มี ไม่ เรา วัน คน ไป".split(), "", " "),
    ]

    def __init__(self, seed: int):
        self.random = random.Random(seed)
        self.plain = self.boxes = False
        self.syllables, self.blank, self.stops = self.SYLLABLES, " ", "...?!"

    def chance(self, p: float) -> bool:
        return self.random.random() < p

    def pick(self, *choices: str) -> str:
        return self.random.choice(choices)

    def words(self, a: int, b: int) -> str:
        r = self.random
        return self.blank.join("".join(r.choice(self.syllables) for _ in range(r.randint(1, 4))) for _ in range(r.randint(a, b)))

    def sentence(self) -> str:
        text = self.words(1, 16)
        if self.chance(0.1):
            text += f' <a href="/x">{self.words(1, 3)}</a> ' + self.words(1, 5)
        if self.chance(0.08):
            text = f"<b>{text}" + self.pick("</b>", "")
        return text.capitalize() + (self.pick(*self.stops) if self.chance(0.8) else "") + self.pick("", "", "", "<br>")

    def paragraph(self) -> str:
        return " ".join(self.sentence() for _ in range(self.random.choice([1, 1, 2, 3, 5, 8])))

    def short(self) -> str:
        return self.random.choice([lambda: self.words(1, 4), self.sentence, self.sentence, self.paragraph])()

    def attrs(self, *names: str) -> str:
        """A class or id that says something; on plain pages one that says nothing, or none."""
        if self.plain:
            return self.pick("", "", f' class="{self.words(1, 1)}"', f' id="{self.words(1, 1)}"')
        return f' {self.pick("class", "class", "id")}="{self.pick(*names)}"' if names and self.chance(0.85) else ""

    def named(self, tag: str, *names: str) -> str:
        """A start tag whose name is what tells it from content."""
        return f"<{tag}{self.attrs()}>" if self.plain else f'<{tag} {self.pick("class", "id")}="{self.pick(*names)}">'

    def links(self, n: int) -> str:
        items = [f'<a href="/{i}">{self.words(1, 3)}</a>' for i in range(n)]
        return self.random.choice([lambda: "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>", lambda: self.pick(" | ", " ", " &middot; ").join(items)])()

    def formula(self) -> str:
        return self.pick(f"&copy; 20{self.random.randint(10, 30)} {self.words(1, 3)}", f"Copyright {self.words(1, 3)}. All rights reserved.", f"All rights reserved {self.words(1, 2)}.", f"{self.words(1, 2)} privacy policy")

    def boiler(self, kind: str) -> str:
        r, plain = self.random, self.plain
        semantic = not self.boxes  # whether the page uses elements that tell what they are
        if kind == "nav":
            if semantic and self.chance(0.7):
                return f"<nav{self.attrs('menu', 'nav', 'main-menu')}>{self.links(r.randint(2, 8))}</nav>"
            return self.named("div", "menu", "navbar", "breadcrumb") + f"{self.links(r.randint(2, 7))}</div>"
        if kind == "header":
            inner = r.choice([f"<h1>{self.words(1, 3)}</h1>", f"<p>{self.sentence()}</p>", self.words(1, 4)]) + self.pick("", self.links(3))
            if not semantic:
                return self.named("div", "header", "masthead", "site-title") + (f'<a href="/">{self.words(1, 3)}</a>' if plain else inner) + "</div>"
            return f"<header{self.attrs('header', 'masthead', 'site-header')}>{inner}</header>"
        if kind == "footer":
            inner = r.choice([lambda: self.formula(), lambda: f"<p>{self.formula()}</p>", lambda: self.links(3), lambda: "<p>" + self.short() + "</p>", self.short] if not plain or semantic else [lambda: self.formula(), lambda: f"<p>{self.formula()}</p>", lambda: self.links(3) + self.formula()])()
            return f"<footer{self.attrs('footer')}>{inner}</footer>" if semantic and self.chance(0.75) or semantic and plain else self.named("div", "footer", "site-foot", "colophon") + inner + "</div>"
        if kind == "side":
            t = self.pick("aside", "aside", "div") if semantic else "div"
            if t == "aside":
                inner = r.choice([self.links(4), f"<p>{self.short()}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.paragraph()}</p>", f"<h3>{self.words(1, 3)}</h3>{self.links(3)}"])
                return f"<aside{self.attrs('sidebar', 'related')}>{inner}</aside>"
            inner = f"<h3>{self.words(1, 3)}</h3>{self.links(r.randint(3, 6))}"
            return self.named("div", "sidebar", "related", "widget") + (inner if plain else r.choice([inner, f"<p>{self.short()}</p>", f"<h2>{self.words(1, 3)}</h2><p>{self.paragraph()}</p>"])) + "</div>"
        if kind == "ad":
            if plain:
                return f"<div{self.attrs()}>{self.pick('Advertisement', 'Sponsored', f'Sponsored {self.words(1, 3)}')}</div>"
            t = self.pick("div", "div", "section", "p")
            return self.named(t, "ad", "ads", "advert", "promo", "sponsored", "banner") + (r.choice([self.short, self.paragraph])() if t == "p" else r.choice([self.short(), "<p>" + self.short() + "</p>"])) + f"</{t}>"
        if kind == "notice":
            inner = self.pick(f"{self.words(1, 6)} cookies {self.words(1, 4)}.", f"Subscribe {self.words(1, 5)} newsletter.") if plain else self.short()
            return self.named("div", "cookie-notice", "cookie", "consent", "notice", "newsletter", "popup") + r.choice([inner, f"<p>{inner}</p>"]) + f"<button>{self.words(1, 2)}</button></div>"
        if kind == "hidden":
            t = self.pick("p", "div", "div", "section")
            how = self.pick(" hidden", ' hidden=""', ' style="display:none"', " style='visibility: hidden; top: 0'")
            return f"<{t}{self.attrs('text', 'content', 'box')}{how}>{r.choice([self.paragraph(), self.short()]) if t == 'p' or self.chance(0.4) else '<p>' + self.paragraph() + '</p>'}</{t}>"
        if kind == "form":
            return f"<form{self.attrs('search', 'login')}>{r.choice(['', '<p>' + self.short() + '</p>', '<label>' + self.words(1, 3) + '</label>'])}<input><button>{self.words(1, 2)}</button></form>"
        # comments: what they say is like an article, so their names tell them apart
        t = self.pick("section", "div", "div")

        def one() -> str:
            k = self.pick("p", "div", "li", "article")
            mark = f' class="{self.pick("comment", "reply")}"' if self.chance(0.85) else ""
            return f"<{k}{mark}>{'<p>' + self.paragraph() + '</p>' if k in ('div', 'article') else self.paragraph()}</{k}>"

        name = self.pick("comments", "comment-list", "replies", "discussion comments")
        return f'<{t} {self.pick("class", "id")}="{name}"><h3>{self.words(1, 3)}</h3>{"".join(one() for _ in range(r.randint(1, 4)))}</{t}>'

    def part(self) -> str:
        """A piece of an article."""
        r, m = self.random, self.MARKED
        kind = r.random()
        if kind < 0.67:
            return f"<p{m}>{self.paragraph()}" + self.pick("</p>", "</p>", "</p>", "")
        if kind < 0.72:
            t = self.pick("h2", "h2", "h3", "h4")
            return f"<{t}{m}>{self.words(1, 6)}</{t}>"
        if kind < 0.77:
            t = self.pick("ul", "ul", "ol")
            return f"<{t}{m}>" + "".join(f"<li{m}>{r.choice([self.sentence(), self.words(1, 5)])}" + self.pick("</li>", "") for _ in range(r.randint(1, 4))) + f"</{t}>"
        if kind < 0.80:
            return f"<blockquote{m}>{r.choice([f'<p{m}>{self.paragraph()}</p>', self.paragraph()])}</blockquote>"
        if kind < 0.82:
            return f"<table{m}>" + "".join(f"<tr{m}><td{m}>{self.words(1, 4)}</td><td{m}>{self.words(1, 4)}</td></tr>" for _ in range(r.randint(1, 4))) + "</table>"
        if kind < 0.85:
            return f'<figure{m}><img src="x.png"><figcaption{m}>{r.choice([self.sentence(), self.words(2, 8)])}</figcaption></figure>'
        if kind < 0.87:
            return f"<pre{m}>{self.words(1, 5)} = {self.words(1, 3)};\n{self.words(1, 6)}</pre>"
        if kind < 0.89:
            return f"<dl{m}><dt{m}>{self.words(1, 3)}</dt><dd{m}>{self.sentence()}</dd></dl>"
        if kind < 0.9:
            return f"<div{m}>{self.paragraph()}</div>"
        if kind < 0.92:
            return f"<p{m}>{self.formula()}</p>"
        return self.boiler(self.pick("ad", "ad", "side", "notice", "form", "hidden"))

    def titled(self, title: str) -> str:
        """An article's own header: its title is content, who wrote it and when is not."""
        about = f'<p class="{self.pick("byline", "author", "post-meta", "entry-meta", "dateline")}">{self.words(2, 5)}</p>' if self.chance(0.4) else ""
        return f"<header{self.attrs('entry-header', 'article-header')}{self.MARKED}>{title}{about}</header>"

    def about(self) -> str:
        """An article's own footer: no content."""
        return f"<footer{self.attrs('entry-footer', 'post-footer')}>{self.random.choice([lambda: self.words(1, 3) + ': ' + self.links(1), lambda: '<p>' + self.words(2, 5) + '</p>', lambda: self.links(3)])()}</footer>"

    def content(self) -> str:
        r, m = self.random, self.MARKED
        short = self.chance(0.2)
        if short:
            one = lambda: self.words(1, 5) + self.pick("", ".") if self.chance(0.4) else self.words(6, 16).capitalize() + self.stops[0]
            parts = "".join(f"<p{m}>{one()}</p>" for _ in range(r.randint(1, 2)))
        else:
            parts = "".join(self.part() for _ in range(r.randint(1, 9)))
        if self.plain and self.boxes:
            # without names and telling elements an article is known by its prose
            prose = lambda: " ".join(self.sentence() for _ in range(r.randint(3, 9)))
            shape = r.random()
            if shape < 0.5:
                parts = f"<p{m}>{prose()}</p>" + parts + f"<p{m}>{prose()}</p>"
            elif shape < 0.75:
                parts = "".join(f"<div{m}>{prose()}</div>" for _ in range(r.randint(2, 5)))
            else:
                parts = "<br><br>".join(prose() for _ in range(r.randint(2, 4)))
        top = self.pick("h1", "h1", "h2") if self.chance(0.8) else ""
        title = f"<{top}{m}>{self.words(1, 10)}</{top}>" if top else ""
        if title and not self.boxes and self.chance(0.2):
            title = self.titled(title)
        end = self.about() if not self.boxes and self.chance(0.15) else ""
        inside = title + parts + end + (self.boiler("comment") if self.chance(0.12) else "")
        if self.boxes:
            t, hint = "div", self.attrs("article-body", "content", "post entry", "story", "main-text")
        else:
            t, hint = r.choice([("article", ""), ("article", ""), ("article", ' class="post"'), ("main", ""), ("main", ' id="content"'), ("div", ' class="article-body"'), ("div", ' id="content"'), ("div", ' class="post entry"'), ("section", ' class="story"')])
            if self.plain and t in ("article", "main"):
                hint = self.attrs()
        page = f"<{t}{hint}{m}>{inside}</{t}>"
        return f"<div{self.attrs('wrapper', 'container', 'row')}>{page}</div>" if self.chance(0.2) else page

    def page(self) -> str:
        usual = self.SYLLABLES, " ", "...?!"
        self.syllables, self.blank, self.stops = self.random.choice(self.SCRIPTS) if self.chance(0.25) else usual
        self.boxes = self.chance(0.4)
        self.plain = self.chance(0.6 if self.boxes else 0.2)
        before = [self.boiler(k) for k in ("header", "nav", "notice", "ad", "form", "side") if self.chance(0.45)]
        after = [self.boiler(k) for k in ("comment", "side", "ad", "form", "notice") if self.chance(0.35)]
        if self.chance(0.1):
            self.random.choice([before, after]).append(self.boiler("hidden"))
        self.random.shuffle(before)
        self.random.shuffle(after)
        foot = self.boiler("footer") if self.chance(0.85) else ""
        if self.boxes and self.chance(0.3):  # a table lays the page out; a cell is the article's box
            inside = self.content()
            cells = [f"<td>{''.join(before)}</td>", f"<td>{inside}</td>", f"<td>{''.join(after)}</td>"]
            if self.chance(0.5):
                page = f"<table><tr>{''.join(cells)}</tr></table>" + foot
            else:  # rows over and under it, and the article in its cell without a box or in one
                cell = f"<td{self.MARKED}>{inside}</td>" if self.chance(0.3) else cells[1]
                rows = [f"<td colspan=2>{''.join(before) or self.links(4)}</td>", cell + (f"<td>{self.links(4)}</td>" if self.chance(0.5) else ""), f"<td colspan=2>{foot if foot and self.chance(0.4) else self.formula()}</td>"]
                page = "<table>" + "".join(f"<tr>{x}</tr>" for x in rows) + "</table>"
        else:
            page = "".join(before) + self.content() + "".join(after) + foot
            if self.chance(0.15):
                page = f"<div{self.attrs('wrapper', 'container', 'page')}>{page}</div>"
        shell = self.random.random()
        if shell < 0.85:
            page = f"<!DOCTYPE html><html><head><title>{self.words(1, 6)}</title><style>p{{margin:0}}</style></head><body>{page}</body></html>"
        elif shell < 0.93:
            page = f"<body>{page}"
        if self.chance(0.08):  # a page that was cut
            page = page[: self.random.randint(len(page) // 2, len(page))]
        return page


def label_pages(count: int = PAGES, seed: int = SEED) -> list[str]:
    writer = Writer(seed)
    return [writer.page() for _ in range(count)]


@functools.lru_cache(maxsize=1)
def trained() -> Model:
    return Model(label_pages())


#: Elements and names that say that they hold no article, and elements that say that they do.
OTHERS, OTHER_HINTS = frozenset("nav footer aside header form dialog menu".split()), frozenset(("hidden", "comment", "ad", "notice", "nav", "foot", "side", "social", "head", "meta"))
HOLDERS = ("article", "main")


def holder(nodes: list[Node]) -> int | None:
    """The element that must hold the article of a page none of whose prose seems to be content: of those that nothing around them speaks against
    an article or main element with text, or the innermost that has all the prose.  None if there is neither: such a page has no article.
    """
    free, prose = [True] * len(nodes), [0] * len(nodes)
    for i, node in enumerate(nodes):
        free[i] = node.tag not in OTHERS and node.hint not in OTHER_HINTS and (node.parent < 0 or free[node.parent])
        prose[i] = node.prose if free[i] and not node.formula else 0
    for i in range(len(nodes) - 1, 0, -1):
        prose[nodes[i].parent] += prose[i]
    said = [i for i, node in enumerate(nodes) if node.tag in HOLDERS and free[i] and node.all_chars > node.all_linked]
    if said:
        return max(said, key=lambda i: (prose[i], nodes[i].all_chars, -i))
    return max((i for i in range(1, len(nodes)) if prose[i] == prose[0]), default=None) if prose[0] else None


def extract(page: str | None, model: Model) -> tuple[str, int, float]:
    """The main text, its number of blocks, and the least sure of all decisions (0.5 to 1)."""
    nodes, blocks = parse(page or "")
    content = model.marginals(nodes)
    if not any(nodes[o].prose and content[o] > 0.5 for o, _ in blocks) and (given := holder(nodes)):
        content = model.marginals(nodes, given)
    kept = [text for owner, text in blocks if content[owner] > 0.5]
    return "\n\n".join(kept), len(kept), min((max(content[o], 1 - content[o]) for o, _ in blocks), default=1.0)


def extract_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars, n_blocks and sureness of each row's whole html, without a shuffle.

    Character references are decoded, white space inside a block becomes one space, blocks are trimmed and
    joined in page order by two line ends.  A null or empty page, or one without content, has an empty text.
    Broken markup (unclosed tags, a lone <, cut pages) is read as far as it goes.  A page of any length is read
    whole, in time linear in it.  A node as likely content as not is no content.  Elements that are not shown, by the attribute hidden
    or a style of their own, are no content, as menus are none.  Where no prose is likely, an article or main element, else the innermost
    element with all prose that no menu or the like holds, is given as content and the messages are passed anew: a page with an article has a text.  Repeated rows each
    give a row; extra columns, whatever their names, are not read; an empty table gives an empty one.
    The model is trained on the driver and sent with the tasks: tables of some hundred numbers.
    """
    model = trained()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [extract(x.as_py(), model) for x in batch.column(2)]
            texts, counts, sure = (list(x) for x in zip(*rows)) if rows else ([], [], [])
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(counts, pa.int64()), pa.array(sure, pa.float64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *new], ["page_id", "url", "text", "n_chars", "n_blocks", "sureness"])

    return pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.col(html_col).cast("string")).mapInArrow(
        run, "page_id long, url string, text string, n_chars long, n_blocks long, sureness double"
    )
