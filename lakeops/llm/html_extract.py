"""Main text of HTML pages by tree scoring.

A page is read into a tree. Elements that cannot be article text (scripts, forms,
menus, page headers and footers, sidebars, notices, adverts, reader comments) are taken
out by tag, role, and words of their class and id; not by name if they hold the article, or another of
their names is that of a main container, and names are not looked at where no text would be left. A name
that says something else too (``social-history``) takes nothing out of an article, and elsewhere nothing
that holds more text than the rest of the page. Each paragraph then gives points
for its length and commas to its ancestors, less with every level; a container's points are
discounted by the share of its text that is links. The container with the most
points is kept, with those siblings that look like parts of the same text, and its
blocks are the result.

One Arrow pass over the pages, no shuffle; a page is handled alone and whole, without
recursion and in time proportional to its length, so depth and length are not limited.

Edge cases: null and empty pages, and pages without text, give an empty text; a page
without markup is its own text; unclosed and misnested tags are closed where an
enclosing element ends; unknown character references stay as written; a tag whose quotes are never closed ends
at its first ``>``, and a ``<`` without any ``>`` behind it is text; repeated rows get the same text. Other columns are not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg object canvas video audio select annotation annotation-xml".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span"
    " strike strong sub sup time tt u var wbr"
    " math semantics mrow mi mn mo ms mtext mspace msqrt mroot mfrac msup msub msubsup munder mover munderover mmultiscripts mprescripts"
    " none mtable mtr mtd mstyle mpadded mphantom menclose mfenced merror".split()
)
DROPPED = frozenset("nav aside footer form button input select dialog menu fieldset head map".split()) | RAW
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main"
    " menu nav ol p pre section table ul".split()
)
SAME_CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPES = frozenset("html body table ul ol dl td th div article section main blockquote".split())
LIST_SCOPES = frozenset("html body table ul ol dl".split())
DROPPED_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split()
)
DROPPED_WORDS = re.compile(
    r"ads?|advert\w*|banner\w*|sidebar\w*|side|menu\w*|nav|navbar\w*|navigation|breadcrumbs?|footer\w*|masthead|"
    r"comments?|commentlist|disqus\w*|replies|cookies?|consent|gdpr|notices?|popups?|modals?|newsletter\w*|subscribe\w*|"
    r"subscription|promos?|promotion|sponsor\w*|shar(?:e|ing)|social|related|recommend\w*|widgets?|pagination|pager|"
    r"toolbar|login|signup|skip|outbrain|taboola"
)
PAGE_WORDS = re.compile(r"header|topbar")  # outside an article only
INSIDE_WORDS = re.compile(r"comments?|repl(?:y|ies)|related|sponsored|promo|ads?")  # all that drops a nested article
WRAPPER_WORDS = frozenset("wrap wrapper container layout outer inner area row grid holder".split())  # content-sidebar-wrap
STYLE_PREFIXES = frozenset("has no non with without".split())  # no-sidebar says what is not there
# words that add nothing to a name of the kinds above: cookie-notice-box, post-comments-list
PLAIN_WORDS = frozenset(
    "list item items box block blocks wrap wrapper container section area inner outer layout row col column grid holder group panel pane"
    " slot unit zone module region links link buttons button icons icon bar form title heading top bottom left right center primary"
    " secondary global site small large mobile desktop sticky fixed hidden id js thread count toggle overlay more news topics topic"
    " articles stories header topbar up in out to log".split()
)
PARAGRAPHS = frozenset("p pre blockquote td li dd".split())
CONTAINERS = frozenset("#page body main article section div center table td".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
TAG_POINTS = {"article": 10.0, "main": 10.0, "div": 5.0, "section": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0,
              "ul": -3.0, "ol": -3.0, "dl": -3.0, "h1": -5.0, "h2": -5.0, "h3": -5.0, "th": -5.0}
MAIN_WORDS = re.compile(r"article\w*|body|content\w*|entry\w*|main|page|post\w*|text|story|blog")

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
TAG_HEAD = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
IN_TAG = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
ATTRIBUTE = re.compile(r"([^\s\"'=/>]++)(?:\s*+=\s*+(\"[^\"]*+\"|'[^']*+'|[^\s\"'>]++))?+")
WANTED = frozenset("class id role hidden aria-hidden style".split())
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
PIECES = re.compile(r"[a-z]+")
CAMEL = re.compile(r"([a-z])([A-Z])")
MENU_LINKS = 0.8
MENU_LABEL = 20  # characters of a menu item at most, a single word, in an article
SIBLING_SHARE = 0.2
LEVELS = 5


class Node:
    __slots__ = ("tag", "parent", "parts", "weight", "dropped", "named", "held", "points", "length", "linked", "label", "words")

    def __init__(self, tag: str, parent: "Node | None", dropped: bool = False, weight: float = 0.0, named: str = ""):
        self.tag, self.parent, self.dropped, self.weight, self.named = tag, parent, dropped, weight, named
        self.held = ""
        self.parts: list[str | Node] = []
        self.points = self.length = self.linked = self.label = self.words = 0.0


def _names_main(words: list[str]) -> bool:
    """Whether the words of a label name a main container: main words only, or also those of what it wraps."""
    main = [bool(MAIN_WORDS.fullmatch(w)) for w in words]
    return bool(words) and (all(main) or words[-1] in WRAPPER_WORDS and any(main))


def _judge(tag: str, attributes: str, in_article: bool, in_main: bool) -> tuple[bool, float, str]:
    """Whether an element is no article text, the points its names are worth, and what its names
    say against it: "beside" (no part of an article), "around" (might hold one), "perhaps" (they say more than that) or nothing."""
    inside_article = in_article or in_main
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True, 0.0, ""
    weight, named, main = 0.0, "", False
    if not attributes or tag in ("html", "body"):
        return False, weight, named
    nested = tag in ("article", "main")
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name not in WANTED:
            continue
        if name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return True, 0.0, ""
        if name == "style" and HIDDEN_STYLE.search(value):
            return True, 0.0, ""
        if name == "role" and value.lower() in DROPPED_ROLES:
            return True, 0.0, ""
        if name not in ("class", "id"):
            continue
        for label in value.split():
            words = PIECES.findall(CAMEL.sub(r"\1 \2", label).lower())
            if words and words[0] in STYLE_PREFIXES:
                continue
            main = main or _names_main(words)
            whole = all(w in PLAIN_WORDS or DROPPED_WORDS.fullmatch(w) or MAIN_WORDS.fullmatch(w) or INSIDE_WORDS.fullmatch(w) for w in words)
            for word in words:
                if nested:
                    if whole and INSIDE_WORDS.fullmatch(word):
                        named = "beside"
                elif DROPPED_WORDS.fullmatch(word) or not inside_article and PAGE_WORDS.fullmatch(word):
                    if not whole:
                        named = named or ("" if inside_article else "perhaps")
                    else:
                        named = "beside" if named == "beside" or inside_article and INSIDE_WORDS.fullmatch(word) else "around"
                if MAIN_WORDS.fullmatch(word):
                    weight = 25.0
    if named and not nested and main and not in_article:
        named = ""
    return False, weight, named


def _drop_named(root: Node) -> None:
    """Take out the elements whose names speak against them, but for those around the article itself.

    That is an element around ``main``, or around ``article`` if none stands outside all such elements.
    An article named as a comment or the like holds nothing, and is taken out inside another one.
    """
    nodes = _in_order(root)
    if not any(node.named for node in nodes):
        return
    under: set[int] = set()  # inside a named element
    inside: set[int] = set()  # inside article or main
    free = False
    for node in nodes:
        above = node.parent
        if above is not None and (above.named or id(above) in under):
            under.add(id(node))
        if above is not None and (above.tag in ("article", "main") or id(above) in inside):
            inside.add(id(node))
        free = free or node.tag in ("article", "main") and not node.named and id(node) not in under and id(node) not in inside
    for node in reversed(nodes):
        node.held = ""
        for p in node.parts:
            if isinstance(p, Node) and p.named != "beside":
                kind = "main" if "main" in (p.tag, p.held) else "article" if "article" in (p.tag, p.held) else ""
                node.held = "main" if "main" in (kind, node.held) else kind or node.held
    gone: set[int] = set()
    for node in nodes:
        if not node.named:
            continue
        if node.tag in ("article", "main"):
            goes = id(node) in inside
        else:
            around_it = node.held == "main" or node.held == "article" and (not free or id(node) in inside)
            goes = node.named == "beside" or not around_it
        if goes:
            gone.add(id(node))
    _spare_doubtful(nodes, gone)
    for node in nodes:
        if any(id(p) in gone for p in node.parts):
            node.parts = [p for p in node.parts if id(p) not in gone]


def _spare_doubtful(nodes: list[Node], gone: set[int]) -> None:
    """Leave what only "perhaps" goes, if it holds more text outside links than all that stays without it."""
    if not any(node.named == "perhaps" and id(node) in gone for node in nodes):
        return
    _measure(nodes)
    below: set[int] = set()
    outermost = []
    for node in nodes:
        if node.parent is not None and (id(node.parent) in gone or id(node.parent) in below):
            below.add(id(node))
        elif id(node) in gone:
            outermost.append(node)
    rest = nodes[0].length - nodes[0].linked - sum(n.length - n.linked for n in outermost)
    gone.difference_update(id(n) for n in outermost if n.named == "perhaps" and n.length - n.linked > rest)


class _Tokens:
    """The tags of a page, from left to right. Each character is looked at a bounded number of times:
    what is missing behind some place is remembered, and a tag that fails on an open quote is not tried again inside."""

    def __init__(self, page: str):
        self.page, self.last_end, self.sections, self.quote_fails = page, page.rfind(">"), True, 0

    def next(self, at: int) -> tuple[int, int, str, str, str] | None:
        """Start and end of the next markup, and of a tag its slash, name and attributes (else an empty name)."""
        page = self.page
        while (start := page.find("<", at)) >= 0:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                return start, stop + 3 if stop >= 0 else len(page), "", "", ""
            if start > self.last_end:
                at = start + 1
                continue
            if self.sections and page.startswith("<![CDATA[", start):
                stop = page.find("]]>", start)
                if stop >= 0:
                    return start, stop + 3, "", "", ""
                self.sections = False
            if page[start + 1 : start + 2] in ("!", "?"):
                return start, page.find(">", start) + 1, "", "", ""
            if start >= self.quote_fails and (m := TAG.match(page, start)):
                return start, m.end(), m[1], m[2].lower(), m[3]
            if m := TAG_HEAD.match(page, start):
                if start >= self.quote_fails:
                    self.quote_fails = IN_TAG.match(page, m.end()).end()
                stop = page.find(">", m.end())
                if stop >= 0:
                    return start, stop + 1, m[1], m[2].lower(), page[m.end() : stop]
            at = start + 1
        return None


def parse(page: str, by_name: bool = True) -> Node:
    """The tree of a page; text parts are decoded, dropped elements are left out with all they hold."""
    root = Node("#page", None)
    open_nodes, at, end = [root], 0, len(page)
    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open elements of a tag
    tokens, endless = _Tokens(page), set()

    def close(upto: int) -> None:
        for node in open_nodes[upto:]:
            places[node.tag].pop()
        del open_nodes[upto:]

    def innermost(tags) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def close_within(tags, scopes) -> None:
        """Close the innermost open element among ``tags``, unless a scope stands before it."""
        i = innermost(tags)
        if i and i >= innermost(scopes):
            close(i)

    while at < end:
        found = tokens.next(at)
        if found is None:
            _add_text(open_nodes[-1], page[at:])
            break
        start, stop, slash, tag, attributes = found
        if start > at:
            _add_text(open_nodes[-1], page[at:start])
        at = stop
        if not tag:
            continue
        if slash:
            close_within((tag,), ())
            continue
        if tag in CLOSES_P:
            close_within(("p",), SCOPES - {"p"})
        for same in SAME_CLOSES.get(tag, ()):
            close_within((same,), LIST_SCOPES)
        if tag in RAW:
            closing = None if tag in endless else re.compile(rf"</{tag}[\s/>]", re.I).search(page, at)
            if closing is None:
                endless.add(tag)
                at = end if tag in ("script", "style") else at
            else:
                at = page.find(">", closing.start()) + 1 or end
            continue
        dropped, weight, named = _judge(tag, attributes, bool(places["article"]), bool(places["main"]))
        node = Node(tag, open_nodes[-1], dropped, weight, named)
        if not dropped:
            open_nodes[-1].parts.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            places[tag].append(len(open_nodes))
            open_nodes.append(node)
    if by_name:
        _drop_named(root)
    return root


def _add_text(node: Node, text: str) -> None:
    if text:
        node.parts.append(entities.unescape(text) if "&" in text else text)


def _in_order(root: Node) -> list[Node]:
    """All kept nodes, parents before children."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack.extend(p for p in reversed(node.parts) if isinstance(p, Node))
    return out


def _measure(nodes: list[Node]) -> None:
    """Text length, linked length and longest link of every node, children before parents."""
    for node in reversed(nodes):
        node.length = node.linked = node.label = node.words = 0.0
        for p in node.parts:
            if isinstance(p, str):
                node.length += len(p.strip())
                node.words += len(p.split())
            else:
                node.length += p.length
                node.words += p.words
                node.linked += p.linked
                node.label = max(node.label, p.label)
        if node.tag == "a":
            node.linked = node.length
            node.label = node.length if node.words < 2 else math.inf


def _own_text(node: Node) -> str:
    """The text of a block itself: its strings and inline elements, not the blocks inside it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif part.tag in INLINE:
            stack.extend(reversed(part.parts))
    return " ".join("".join(out).split())


def _score(nodes: list[Node]) -> dict[int, float]:
    """Points of the containers: from paragraphs to their ancestors, then less their link density."""
    for node in nodes:
        node.points = 0.0
    held: dict[int, Node] = {}
    for node in nodes:
        if node.tag in INLINE or node.tag in HEADINGS or not (text := _own_text(node)):
            continue
        density = node.linked / node.length if node.length else 0.0
        points = (1 + text.count(",") + text.count("،") + text.count("、") + min(len(text) / 100, 3)) * (1 - density)
        if node.tag not in PARAGRAPHS:
            held[id(node)] = node
            node.points += points
        above, level = node.parent, 1
        while above is not None and level <= LEVELS:
            held[id(above)] = above
            above.points += points / (1 if level == 1 else 2 if level == 2 else 3 * level)
            above, level = above.parent, level + 1
    return {
        key: (n.points + TAG_POINTS.get(n.tag, 0.0) + n.weight) * (1 - (n.linked / n.length if n.length else 0.0))
        for key, n in held.items() if n.tag in CONTAINERS and n.length
    }


def _kept_siblings(best: Node, scores: dict[int, float]) -> list[Node]:
    if best.parent is None:
        return [best]
    limit = max(10.0, SIBLING_SHARE * scores[id(best)])
    kept = []
    for p in best.parent.parts:
        if not isinstance(p, Node):
            continue
        density = p.linked / p.length if p.length else 1.0
        if p is best or scores.get(id(p), 0.0) >= limit or p.tag in HEADINGS and density < 0.5 or (
            p.tag in PARAGRAPHS and density < 0.25 and (p.length > 80 or (density == 0 and p.length and re.search(r"[.!?](\s|$)", _own_text(p))))
        ):
            kept.append(p)
    return kept


def _is_menu(node: Node, in_article: bool) -> bool:
    """Whether a list is nearly all links; in an article, only one of short single words."""
    if node.tag not in ("ul", "ol", "dl", "div", "table") or not node.length or node.linked < MENU_LINKS * node.length:
        return False
    return not in_article or node.tag == "ul" and node.label <= MENU_LABEL


def _blocks(container: Node) -> list[str]:
    """Block texts of a container in page order, without menus."""
    in_article = container.tag in ("article", "main")
    out: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        if line:
            text = " ".join("".join(line).split())
            if text:
                out.append(text)
            line.clear()

    stack: list[str | Node | None] = [container]
    while stack:
        part = stack.pop()
        if part is None:
            end_block()
        elif isinstance(part, str):
            line.append(part)
        elif part.tag == "br":
            line.append(" ")
        elif part.tag in INLINE:
            stack.extend(reversed(part.parts))
        elif part is not container and _is_menu(part, in_article):
            end_block()
        else:
            end_block()
            stack.append(None)
            stack.extend(reversed(part.parts))
    end_block()
    return out


def main_text(page: str | None) -> str:
    """The main text of one page: its blocks, one to a line."""
    if not page:
        return ""
    return _text_of(parse(page)) or _text_of(parse(page, by_name=False))


def _text_of(root: Node) -> str:
    nodes = _in_order(root)
    _measure(nodes)
    scores = _score(nodes)
    if not scores:
        return "\n".join(_blocks(nodes[0]))
    best = max((n for n in nodes if id(n) in scores), key=lambda n: scores[id(n)])
    whole = best
    while whole is not None:  # an article is kept whole, not only its best section
        if whole.tag in ("article", "main"):
            best = whole
        whole = whole.parent
    scores.setdefault(id(best), 0.0)
    blocks = [b for n in ([best] if best.tag in ("article", "main", "body", "#page") else _kept_siblings(best, scores)) for b in _blocks(n)]
    return "\n".join(blocks)


def extract_text(page: Column) -> Column:
    """Main text of a column of HTML pages."""

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series([main_text(p) for p in pages], dtype=object)

    return run(page)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars per row of ``pages`` (page_id, url, html)."""
    out = pages.select("page_id", "url", extract_text(F.col("html")).alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
