"""Main text of web pages by tree scoring.

A page is read into a tree of block elements; inline tags are transparent and
text belongs to the innermost block. Elements that are boilerplate by their
tag, their role, a whole class name or id ("ad", "comments") or the name of a box of comments or notices
("comment-list", "cookie-notice") are removed, and so are forms, unless a form holds most of the page. A mere
word of a class or id ("related-work"; not the id of a heading) only makes an element suspect: it goes
if it is mostly links or, outside an article or main and unless a heading or
paragraph, if it is short or has many links; else it loses points. Every text block passes points
for its length and its commas, discounted by its link density, to its
container and, halved at each step, to every ancestor. The container with the
best score (discounted by its own link density) is taken, raised to the
``article`` or ``main`` around it, and kept whole. Then at every level from
there to the page, siblings count as content when they are sections beside a
section, have points enough of their own, or are unlinked headings, lists,
tables or paragraphs of any length; all between the first and the last of
them is kept, but for containers that are mostly links. The text is all
blocks left in what was kept, in page order.

Row-wise work: pages stay in their partitions, one batch of them is in memory.

Edge cases: null and empty html give an empty text, as do pages whose every
block is boilerplate; unclosed and stray tags, comments and quotes are read
as browsers roughly do; scripts and other raw elements end at their end tag, whatever they hold; very long pages
and long runs of broken markup are read in one pass; a repeated page gets its row each time, there are no ties
to break; columns named text or n_chars are replaced, others pass through.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter

from pyspark.sql import DataFrame

from .common import append_columns

_TAG = re.compile(r"""</?[a-zA-Z](?>[^\s/>]*)(?>(?:[^>"']|"[^"]*"|'[^']*')*)>|</?[a-zA-Z][^>]*>""")
_ANCHOR = re.compile(r"<(/?)a(?=[\s/>])", re.I)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"""([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "xmp", "noembed", "noframes"}
_RAW_END = {x: re.compile(f"</{x}(?=[\\s/>])", re.I) for x in _RAW}
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_DROPPED = set("nav footer aside button select option datalist dialog menu head svg canvas object audio video map fieldset search math".split())
_PARAGRAPH = set("p pre blockquote td th li h1 h2 h3 h4 h5 h6 dd dt figcaption caption summary address".split())
_BLOCK = _PARAGRAPH | _DROPPED | set("form html body div article section main header ul ol dl table thead tbody tfoot tr figure details hgroup center legend".split())
_ENDS_P = _BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "html", "body", "button", "option", "svg", "math"}
_SAME = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"})}
_BAD = set("nav navbar navigation menu footer sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments disqus replies respond reply share sharing social breadcrumb breadcrumbs pagination pager related recommended recommendations widget toolbar masthead skip gdpr paywall toc".split())
#: Words of ``_BAD`` that, as a whole class name, are in use for content as well.
_UNSURE = set("menu related recommended recommendations consent promotion banner modal overlay widget".split())
#: First or last words of names of boxes that are never article text, and the most words of such a name.
_BOXES, _BOX_WORDS = set("comment comments notice notices".split()), 3
_SURE = _BAD - _UNSURE
_PLAIN = set("p pre blockquote h1 h2 h3 h4 h5 h6".split())
#: Degrees of ``bad``: suspect; suspect, but a heading, a paragraph or within an article or main; boilerplate; a form.
SUSPECT, SPARED, BAD, FORM = 1, 2, 3, 4
#: Characters of a long text; points that a suspect element loses.
LONG, LOSS = 200, 10
_HEADERS = {"header"}
_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "alertdialog", "form", "menu", "menubar", "toolbar"}
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_SECTIONS = {"article", "main", "section"}
_FLOW = _PARAGRAPH | set("ul ol dl table thead tbody tfoot tr figure hgroup".split())
_FIRST = {"div": 5, "article": 25, "main": 15, "section": 5, "pre": 3, "td": 3, "blockquote": 3, "ul": -3, "ol": -3, "dl": -3, "form": -3, "address": -3, "th": -5}


class Node:
    __slots__ = ("tag", "parent", "children", "bad", "score", "points", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None, bad: int = 0):
        self.tag, self.parent, self.bad = tag, parent, bad
        self.children: list = []  # nodes and text blocks ([text, linked characters])
        self.score, self.points, self.chars, self.linked = 0.0, 0.0, 0, 0


def _is_box(name: str) -> bool:
    """A name made for reader comments or notices ("comment-list", "user-comments", "cookie-notice"), not a long slug."""
    words = [w.lower() for w in _WORDS.findall(name)]
    return 0 < len(words) <= _BOX_WORDS and (words[0] in _BOXES or words[-1] in _BOXES)


def _badness(tag: str, attributes: str, inside: bool) -> int:
    """Boilerplate by tag, role, visibility or name, or suspect by a word of class or id; ``inside``: within an article or main."""
    if tag in _DROPPED or tag in _HEADERS and not inside:
        return BAD
    if not attributes or tag in ("html", "body", "article", "main"):
        return FORM if tag == "form" else 0
    suspect = False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "")
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "role" and value.lower() in _ROLES - ({"form"} if tag == "form" else set()):
            return BAD
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return BAD
        if tag == "form":  # decided by what it holds
            continue
        if name == "class" or name == "id" and tag not in _PLAIN:  # the id of a heading or paragraph is an anchor
            tokens = value.lower().split()
            if name == "class" and not _SURE.isdisjoint(tokens):
                return BAD
            if tag not in _PLAIN and (value.strip().lower() in _SURE or any(_is_box(t) for t in value.split()) and (name == "class" or len(_WORDS.findall(value)) < _BOX_WORDS)):
                return BAD
            words = {w.lower() for w in _WORDS.findall(value)}
            suspect = suspect or bool(words & _BAD or not inside and words & _HEADERS)
    if tag == "form":
        return FORM
    return (SPARED if inside or tag in _PLAIN else SUSPECT) if suspect else 0


def _closed_links(page: str) -> set[int]:
    """Places of the links that are ended before another one begins: blocks within them are linked too."""
    out, last = set(), None
    for m in _ANCHOR.finditer(page):
        if m[1]:
            if last is not None:
                out.add(last)
            last = None
        else:
            last = m.start()
    return out


def _tokens(page: str):
    """(start, tag or None, text): text, tags and stray "<", in one pass; what raw elements and comments hold is left out."""
    at, end, last = 0, len(page), page.rfind(">")
    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            yield at, None, page[at:]
            return
        if lt > at:
            yield at, None, page[at:lt]
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
        elif lt > last:  # no tag ends behind this place
            yield lt, None, page[lt:]
            return
        elif page[lt + 1 : lt + 2] in ("!", "?"):
            at = page.find(">", lt) + 1
        elif (m := _TAG.match(page, lt)) is None:
            yield lt, None, "<"
            at = lt + 1
        else:
            name = _NAME.match(m[0])[1].lower()
            yield lt, name, m[0]
            at = m.end()
            if name in _RAW and m[0][1] != "/" and not m[0].endswith("/>"):
                ends = _RAW_END[name].search(page, at)
                if ends is not None:
                    at = page.find(">", ends.start()) + 1 or end
                elif name in ("script", "style"):
                    return  # all the rest is its text


def read_tree(page: str) -> Node:
    root = Node("html", None)
    at, link, pending, linked = root, 0, [], 0  # link: 1 up to the next block, 2 up to the end tag
    inside, opened = 0, Counter()
    whole = _closed_links(page)

    def flush():
        nonlocal linked
        if pending:
            text = " ".join("".join(pending).split())
            if text:
                at.children.append([text, min(linked, len(text))])
            pending.clear()
        linked = 0

    def close(tags: set, stop: set) -> None:
        """Ends the innermost element of ``tags`` and all in it, if none of ``stop`` lies between."""
        nonlocal at, inside
        if not any(opened[t] for t in tags):
            return
        node = at
        while node is not None and node.tag not in tags:
            if node.tag in stop:
                return
            node = node.parent
        if node is None or node.parent is None:
            return
        flush()
        while at is not node.parent:
            inside -= at.tag in ("article", "main")
            opened[at.tag] -= 1
            at = at.parent

    for place, tag, token in _tokens(page):
        if tag is None:
            text = entities.unescape(token)
            pending.append(text)
            if link:
                linked += len(text.strip())
            continue
        if token[1] == "/":
            if tag == "a":
                link = 0
            elif tag in _BLOCK:
                close({tag}, set())
            continue
        if tag in _RAW:
            if tag not in ("title", "style", "script"):
                pending.append(" ")
        elif tag == "a":
            link = 2 if place in whole else 1
        elif tag in ("br", "hr", "img"):
            pending.append(" ")
        elif tag in _BLOCK:
            if tag in _ENDS_P:
                close({"p"}, {"td", "th", "li", "blockquote", "div", "article", "section"})
            if tag in _SAME:
                close(*_SAME[tag])
            if tag == "body" and at.tag == "head":
                close({"head"}, set())
            flush()
            link = 2 if link == 2 else 0
            if tag in ("html", "body"):
                continue
            if tag[0] == "h" and tag[1:].isdigit() and at.tag[0] == "h" and at.tag[1:].isdigit():
                close({at.tag}, set())
            name = _NAME.match(token)
            at.children.append(child := Node(tag, at, _badness(tag, token[name.end() : -1].strip().rstrip("/"), inside > 0)))
            at = child
            opened[tag] += 1
            inside += tag in ("article", "main")
        elif tag == "frameset":
            flush()
    flush()
    return root


def _add_up(node: Node) -> list[Node]:
    """Adds up characters and linked characters without what is boilerplate; the nodes left; iterative, since trees can be deep."""
    order, stack = [], [node]
    while stack:
        n = stack.pop()
        n.children = [c for c in n.children if isinstance(c, list) or c.bad != BAD]
        n.chars = n.linked = 0
        order.append(n)
        stack.extend(c for c in n.children if isinstance(c, Node))
    for n in reversed(order):
        for c in n.children:
            n.chars += len(c[0]) if isinstance(c, list) else c.chars
            n.linked += c[1] if isinstance(c, list) else c.linked
    return order


def _prune(node: Node) -> None:
    """Removes boilerplate, and suspect elements by their length and link density."""
    left = _add_up(node)
    forms = [n for n in left if n.bad == FORM]
    if forms:  # a form around most of the page is the page; others are boilerplate
        for n in forms:
            n.bad = 0 if n.chars >= LONG and 2 * n.chars > node.chars and 2 * n.linked < n.chars else BAD
        left = _add_up(node)
    suspects = [n for n in left if n.bad]
    for n in suspects:
        if 2 * n.linked >= n.chars or n.bad == SUSPECT and (n.chars < LONG or 4 * n.linked >= n.chars):
            n.bad = BAD
    if suspects:
        _add_up(node)


def _score(root: Node) -> list[Node]:
    """The elements with text; their scores, and in ``points`` the points of all their blocks."""
    order, stack = [], [root]
    while stack:
        n = stack.pop()
        order.append(n)
        stack.extend(c for c in n.children if isinstance(c, Node))
    scored: list[Node] = []
    for n in reversed(order):  # children before parents
        own = sum((1 + text.count(",") + min(len(text) / 100, 3)) * (1 - linked / max(1, len(text))) for text, linked in (c for c in n.children if isinstance(c, list)))
        n.points += own
        if n.tag in _PARAGRAPH:
            passed = own + n.score / 2
        else:
            n.score += own
            passed = n.score / 2
        if n.parent is not None:
            n.parent.points += n.points
            n.parent.score += passed
        if n.chars and not (n.tag in _PARAGRAPH and _is_leaf(n)):
            scored.append(n)
    for n in scored:
        n.score = (n.score + _FIRST.get(n.tag, 0) - LOSS * (n.bad > 0)) * (1 - n.linked / n.chars)
    return scored


def _is_content(c: Node | list, node: Node, best: float) -> bool:
    """Whether a sibling of ``node``, which holds the main text, is content too; ``best``: most points of a sibling."""
    if isinstance(c, list):
        return 2 * c[1] < len(c[0])
    if not c.chars or 2 * c.linked >= c.chars:
        return False
    alike = c.tag == node.tag and (c.tag in _SECTIONS or _is_leaf(c) and _is_leaf(node))
    points = c.points - LOSS * (c.bad > 0)
    return points > 0 and (alike or c.tag in _FLOW or points >= min(10.0, 0.1 * best))


def _is_leaf(node: Node) -> bool:
    return all(isinstance(c, list) for c in node.children)


def _around(node: Node) -> tuple[list, list]:
    """What is kept of the siblings before and after ``node``."""
    row = node.parent.children
    at = next(i for i, c in enumerate(row) if c is node)
    best = max(c.points for c in row if isinstance(c, Node))
    found = [i for i, c in enumerate(row) if i == at or _is_content(c, node, best)]
    stays = lambda c: isinstance(c, list) or c.tag in _PARAGRAPH or 2 * c.linked < c.chars
    return [c for c in row[found[0] : at] if stays(c)], [c for c in row[at + 1 : found[-1] + 1] if stays(c)]


def _texts(node: Node) -> list[str]:
    out, stack = [], [node]
    while stack:
        x = stack.pop()
        if isinstance(x, list):
            out.append(x[0])
        else:
            stack.extend(reversed(x.children))
    return out


def main_text(page: str | None) -> str:
    if not page:
        return ""
    root = read_tree(page)
    _prune(root)
    scored = _score(root)
    if not scored:
        return ""
    best = max(scored, key=lambda n: (n.score, n.chars))
    up = best
    while up is not None and up.tag not in ("article", "main"):
        up = up.parent
    if up is not None:
        while up.parent is not None and (outer := next((p for p in _above(up) if p.tag == "article"), None)):
            up = outer
        best = up
    before, after, node = [], [], best  # before: from the innermost level outwards
    while node.parent is not None:
        first, last = _around(node)
        before.append(first)
        after.extend(last)
        node = node.parent
    kept = [*(c for level in reversed(before) for c in level), best, *after]
    return "\n".join(t for c in kept for t in ([c[0]] if isinstance(c, list) else _texts(c)))


def _above(node: Node):
    while node.parent is not None:
        node = node.parent
        yield node


def extract(pages: DataFrame, html: str = "html", drop: tuple = ("html",)) -> DataFrame:
    """``pages`` (without the columns in ``drop``) plus text and n_chars (code points)."""

    def work():
        def rows(column):
            for b in column:
                t = main_text(b.decode() if b else None)
                yield t, len(t)

        return lambda column: list(rows(column))

    return append_columns(pages, [html], "text string, n_chars bigint", work, drop)
