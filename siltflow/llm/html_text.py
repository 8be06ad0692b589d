"""Main-text extraction by scoring the page's tree.

The page is read into a light tree. Elements that are never content (menus, headers, footers,
asides, scripts, styles ...) or have such a role are left out. So are forms and elements whose
class or id says so (adverts, notices, side bars, comments ...), unless the page has its content
in them (see `_prune`). Every remaining block of text gives points for its length
and its commas to its ancestors, less with each step up; a container's points are discounted by
the share of its text inside links. The best container is kept (with its enclosing article, if
it has one), and so are its siblings that score well themselves, and small blocks between them.

Null or empty html gives an empty text, as does a page without any text. Pages that stop in the
middle of a tag lose that tag only. Repeated rows give repeated rows; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltflow.llm._common import arrow_map, table

_MARK = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"  # comments
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]|=\s*(?:\"[^\"]*\"|'[^']*'|(?![\"'\s])))*+)>"
    r"|<[!?/](?![a-zA-Z])[^>]*>?"
    r"|<!\w[^>]*>?"
    r"|</?[a-zA-Z].*\Z",  # a tag that the page's end cuts off
    re.S,
)
_ATTR = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")

#: Elements by their part in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
NEVER = frozenset("script style textarea title xmp iframe noembed noframes head noscript template nav aside footer header button select option datalist dialog menu svg math canvas object audio video map".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul caption".split()
)
ENDS_P = BLOCK - frozenset("body caption dd dt head html legend option tbody td tfoot th thead tr".split()) | frozenset(["dd", "dt"])
CONTAINER = frozenset("article main section div body td blockquote".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar toolbar".split())
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertisements advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies "
    "disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promoted promotion "
    "related recommended recommendations respond replies reply share sharing shoutbox sidebar signup skyscraper social sponsor sponsored subscribe toolbar widget".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
BETWEEN = HEADINGS | frozenset("p ul ol dl pre blockquote table figure address details".split())
MENUS = frozenset("div section ul ol dl table td p center".split())
#: A container that is named like noise but has this share of the text isn't noise.
KEEP_SHARE = 0.8
#: A page's single article is its best container if it has this share of the best one's points.
ARTICLE_SHARE = 0.1
NOT_ARTICLE = frozenset("ad advert comment promo related reply sponsored".split())
_NAME_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
#: Elements that stay open until a parent ends, and what ends them.
ENDED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}}
SCOPE = frozenset("ul ol dl table html body article main section div".split())


class Node:
    __slots__ = ("tag", "parent", "noise", "soft", "kids", "score", "length", "linked", "in_link", "box", "marks", "heads")

    def __init__(self, tag: str, parent: Node | None, noise: bool, soft: bool = False):
        self.tag, self.parent, self.noise, self.soft = tag, parent, noise, soft
        self.kids: list[Node | str] = []
        self.score = 0.0
        self.length = self.linked = self.marks = self.heads = 0
        self.in_link = tag == "a" or parent is not None and parent.in_link
        self.box: Node | None = self if tag in CONTAINER else parent.box if parent is not None else None


def _noisy(attrs: str, words: frozenset[str]) -> tuple[bool, bool]:
    """Whether attributes say that an element is never content, and whether its name says that it is probably not."""
    named = False
    for m in _ATTR.finditer(attrs):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return True, named
        if name == "role" and value.strip().lower() in NOISE_ROLES:
            return True, named
        if name in ("class", "id") and any(x.lower() in words for x in _NAME_PARTS.findall(value)):
            named = True
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, named
    return False, named


class _Path:
    """The open elements, with their numbers by tag: on the whole path, and below each element that bounds a scope."""

    def __init__(self, root: Node):
        self.at = root
        self.open: dict[str, int] = {}
        self.frames: list[dict[str, int]] = [{}]

    def enter(self, node: Node) -> None:
        self.at = node
        self.open[node.tag] = self.open.get(node.tag, 0) + 1
        if node.tag in SCOPE:
            self.frames.append({})
        else:
            self.frames[-1][node.tag] = self.frames[-1].get(node.tag, 0) + 1

    def leave(self, tags: frozenset[str] | set[str]) -> None:
        """Closes elements up to the nearest with one of tags; the caller knows that there is one."""
        while True:
            node = self.at
            self.open[node.tag] -= 1
            if node.tag in SCOPE:
                self.frames.pop()
            else:
                self.frames[-1][node.tag] -= 1
            self.at = node.parent
            if node.tag in tags:
                return

    def in_scope(self, tags) -> bool:
        return any(self.frames[-1].get(t) for t in tags)


def parse(page: str) -> Node:
    """A tree of elements and text. Elements that are never content are left out; soft marks those that are named like noise.

    An element is climbed over only if one that ends there is open, so each is left once and the
    time is in proportion to the page.
    """
    root = Node("html", None, False)
    path = _Path(root)
    pos, end = 0, len(page)
    while pos < end:
        m = _MARK.search(page, pos)
        start, after = (m.start(), m.end()) if m else (end, end)
        if start > pos and not path.at.noise:
            path.at.kids.append(html.unescape(page[pos:start]))
        if not m:
            break
        pos = after
        if not (tag := m[2]):
            continue
        tag = tag.lower()
        if m[1]:
            if path.open.get(tag):
                path.leave({tag})
            continue
        attrs = m[3]
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(page, pos)
            pos = close.end() if close else end
            continue
        if tag in ("html", "body"):
            if tag == "body" and path.at is root:
                body = Node("body", root, False)
                root.kids.append(body)
                path.enter(body)
            continue
        if tag in ENDS_P and path.in_scope(("p",)):
            path.leave({"p"})
        if ends := {k for k, by in ENDED_BY.items() if tag in by}:
            if path.in_scope(ends):
                path.leave(ends)
        at = path.at
        if tag in VOID:
            if not at.noise:
                at.kids.append(Node(tag, at, False))
            continue
        if attrs.endswith("/") and tag not in BLOCK and tag != "a":
            continue
        noise, named = _noisy(attrs, NOT_ARTICLE if tag in ("article", "main") else NOISE_WORDS) if attrs else (False, False)
        node = Node(tag, at, at.noise or noise or tag in NEVER, named or tag == "form")
        if not node.noise:
            at.kids.append(node)
        path.enter(node)
    return root


def _prune(root: Node) -> None:
    """Takes out the elements that are named like noise, unless the page has its content there.

    Such an element stays if it holds an article or main part and none stands outside of them
    all; on pages without these, a first heading in the same way; and if it holds KEEP_SHARE of
    the page's text outside links.
    """
    order: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(k for k in x.kids if not isinstance(k, str))
    for x in reversed(order):
        x.length += 0 if x.in_link else sum(len(k.strip()) for k in x.kids if isinstance(k, str))
        x.marks += x.tag in ("article", "main")
        x.heads += x.tag == "h1"
        if x.parent is not None:
            x.parent.length += x.length
            x.parent.marks += x.marks
            x.parent.heads += x.heads
    outside = [0, 0]
    todo = [root]
    while todo:  # what stands in no such element
        x = todo.pop()
        outside[0] += x.tag in ("article", "main") and not x.soft
        outside[1] += x.tag == "h1" and not x.soft
        todo.extend(k for k in x.kids if not isinstance(k, str) and not k.soft)
    total = root.length
    todo = [root]
    while todo:
        x = todo.pop()
        kept: list[Node | str] = []
        for k in x.kids:
            if isinstance(k, str) or not k.soft or k.tag not in ("article", "main") and (
                (k.marks and not outside[0]) or (k.heads and not root.marks and not outside[1]) or k.length >= KEEP_SHARE * max(total, 1)
            ):
                kept.append(k)
                if not isinstance(k, str):
                    todo.append(k)
        x.kids = kept
    for x in order:
        x.length = 0


def _blocks(node: Node, menus: bool = True) -> list[str]:
    """Texts of the blocks under node, in page order, white space made single and trimmed; without menus, blocks of links are left out."""
    out: list[str] = []
    part: list[str] = []

    def flush():
        if text := " ".join("".join(part).split()):
            out.append(text)
        part.clear()

    todo: list = [node]
    while todo:
        x = todo.pop()
        if x is None:
            flush()
        elif isinstance(x, str):
            part.append(x)
        elif x.tag == "br":
            part.append("\n")
        else:
            block = x.tag in BLOCK
            if not menus and x is not node and x.tag in MENUS and 2 * x.linked > x.length:
                continue
            if block:
                flush()
                todo.append(None)
            todo.extend(reversed(x.kids))
    flush()
    return out


def _score(root: Node) -> list[Node]:
    """Gives every container its points; the containers that have any."""
    found: dict[int, Node] = {}
    order: list[Node] = []
    todo = [root]
    while todo:
        x = todo.pop()
        order.append(x)
        todo.extend(k for k in x.kids if not isinstance(k, str))
    for x in reversed(order):
        own = "".join(k for k in x.kids if isinstance(k, str))
        n = len(own.strip())
        x.length += n
        x.linked += n if x.in_link else 0
        if x.parent is not None:
            x.parent.length += x.length
            x.parent.linked += x.linked
    for x in order:
        if x.tag not in BLOCK or x.tag in ("ul", "ol", "tr", "table", "tbody"):
            continue
        if any(not isinstance(k, str) and k.tag in BLOCK and k.tag != "hr" for k in x.kids) and x.tag not in ("p", "li"):
            own = [k for k in x.kids if isinstance(k, str)]
        else:
            own, inner = [], [x]
            while inner:
                y = inner.pop()
                own += [k for k in y.kids if isinstance(k, str)]
                inner.extend(k for k in y.kids if not isinstance(k, str) and k.tag not in BLOCK)
        text = "".join(own).strip()
        if not text:
            continue
        points = 1 + text.count(",") + min(len(text) / 100, 3)
        # a block counts for what contains it; a div of text right below the body stands for itself
        loose = x.tag in CONTAINER and (x.parent is None or x.parent.tag not in CONTAINER or x.parent.tag == "body")
        share, up = 1.0, x if loose else x.parent and x.parent.box
        while up is not None and share > 1e-9:  # beyond that many containers nothing is left to give
            up.score += points * share
            found[id(up)] = up
            share *= 0.5
            up = up.parent and up.parent.box
    for x in found.values():
        x.score *= 1 - x.linked / max(x.length, 1)
    return list(found.values())


def main_text(page: str | None) -> str:
    """The page's main text: its blocks joined by line feeds."""
    if not page:
        return ""
    root = parse(page)
    _prune(root)
    scored = _score(root)
    if not scored:
        return "\n".join(_blocks(root))
    best = max(scored, key=lambda x: x.score)
    articles = [x for x in scored if x.tag == "article"]
    if len(articles) == 1 and articles[0].score >= ARTICLE_SHARE * best.score:  # the score counts; a mark tells near ones apart
        best = articles[0]
    whole = {}
    up: Node | None = best
    while up is not None:
        if up.tag in ("article", "main"):
            whole[up.tag] = up
        up = up.parent
    best = whole.get("article") or whole.get("main") or best  # an article is kept whole, or the main part where none is marked
    if best.parent is None:
        return "\n".join(_blocks(best, False))
    marked = best.tag in ("article", "main")
    kids = best.parent.kids
    kept = [False] * len(kids)
    for i, kid in enumerate(kids):
        if not isinstance(kid, str):
            prose = kid.tag == "p" and kid.length > 80 and kid.linked < 0.25 * kid.length
            kept[i] = kid is best or (kid.tag == best.tag if marked else prose or kid.tag in CONTAINER and kid.score >= max(2.0, 0.2 * best.score))
    if not marked:  # headings, lists and short paragraphs between kept siblings, and the headings before the first
        first, last = kept.index(True), len(kept) - 1 - kept[::-1].index(True)
        small = lambda kid, tags: not isinstance(kid, str) and kid.tag in tags and kid.linked < 0.5 * max(kid.length, 1)
        for i in range(first, last):
            kept[i] = kept[i] or small(kids[i], BETWEEN)
        for i in range(first - 1, -1, -1):
            if not small(kids[i], HEADINGS) and not (isinstance(kids[i], str) and not kids[i].strip()):
                break
            kept[i] = not isinstance(kids[i], str)
    return "\n".join(x for i, kid in enumerate(kids) if kept[i] for x in _blocks(kid, marked))


def extract(pages: DataFrame, columns: tuple[str, ...] = ("page_id", "url"), html_col: str = "html") -> DataFrame:
    """columns of pages with text and n_chars (code points of text)."""
    kept = pages.select(*columns, F.col(html_col).cast("string").alias("__html"))
    schema = kept.drop("__html").schema

    def make():
        def step(*cols):
            texts = [main_text(x) for x in cols[-1]]
            return {f"c{i}": c for i, c in enumerate(cols[:-1])} | {"text": texts, "n_chars": list(map(len, texts))}

        return step

    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(schema)]
    return arrow_map(kept, make, ", ".join([*fields, "text string, n_chars long"])).toDF(*columns, "text", "n_chars")


def op1_html_extraction(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
