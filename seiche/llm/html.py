"""Main text of web pages by tree scoring.

The page becomes a tree of elements. Each paragraph passes points, for its length and its commas, to its parent (in
full), its grandparent (half) and further ancestors (less and less), discounted by the share of its text in links. The
best container is kept as a whole (or the article around it), with the other containers that score well and those of its
siblings that are prose.

What no article holds (menus, adverts, forms, comments...) goes first, by tag and by the names in class, id and role. A
name says what an element is by its last word: `post-comments` are comments, `with-sidebar` is no sidebar. Names are no
veto: what holds most of the page's points is the article whatever it is called, unless it is comments; and a page that
would be left empty is read without its names. A header inside an article is its title and stays, a page's header goes;
so do footers and asides anywhere.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seiche.llm.common import chunks, tidy

MARKUP = re.compile(r"<(?:!--|!\[CDATA\[|[!?]|(/?)([a-zA-Z][^\s/>]*))")
NAME = re.compile(r"[\s/]*(=?[^\s/>=]*)")
EQUALS = re.compile(r"\s*=\s*")
BARE = re.compile(r"[^\s>]*")
COMMENT_END = re.compile(r"--!?>")
WHITE = re.compile(r"\s+")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
RAW = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>?", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "xmp", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that no article text is in.
NEVER = frozenset("head script style noscript template iframe object embed svg math canvas audio video map nav footer aside button select option textarea input label fieldset dialog menu menuitem title noembed noframes".split())
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split())
#: What is gone without a break in the text around it.
SILENT = INLINE | frozenset("script style template noscript".split())
#: The open elements that the start of another one ends.
ENDS_P = "address article aside blockquote center details dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul li dd dt td th tr".split()
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"td", "th", "tr"}, "option": {"option"}}
ENDED_BY = {t: frozenset(ENDS.get(t, set()) | ({"p"} if t in ENDS_P else set())) for t in {*ENDS, *ENDS_P}}
#: Where the search for an element to end stops.
SCOPE = frozenset("table ul ol dl article section div body html main blockquote".split())
#: How deep the tree goes; what is nested deeper becomes a sibling, as browsers have it.
DEEP = 512

#: What an element is by the last word of a name; the words after it that only say where or which part it is.
COMMENTS = frozenset("comment comments commentlist disqus respond reply replies responses".split())
CHROME = frozenset("ad ads adv advert adverts advertisement advertising advertorial alert alertdialog banner breadcrumb breadcrumbs complementary consent contentinfo cookie cookies footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices notification notifications outbrain overlay pager pagination paywall popup promo promos promotion promotional recommended recommendations related search share sharebar sharing shares sidebar sidebars sidenav signup skip skyscraper social sponsor sponsored sponsors subscribe subscription taboola tagcloud tags toolbar widget widgets".split())
PARTS = frozenset("area articles bar block bottom box button buttons center col column container content form head header holder icons inner inside item items left link links list outer panel pane policy posts right section slot stories text title top unit wrap wrapper zone".split())
#: A name with one of these is about something else than its own element.
ABOUT = frozenset("with without no has have not is".split())
GOOD = frozenset("article articlebody body content entry hentry main page post story text blog prose".split())
WORDS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")

#: The shares of a paragraph's points that go to its parent, its grandparent and so on.
SHARES = (1.0, 0.5, 0.3, 0.2, 0.15, 0.1)
BASE = {"article": 6.0, "main": 3.0, "div": 1.0, "section": 0.6, "pre": 0.6, "td": 0.6, "blockquote": 0.6, "ol": -0.6, "ul": -0.6, "dl": -0.6, "li": -0.6, "th": -1.0}
#: Points for a name of an article; of the best container's score, what another container needs; characters worth a point, points for them at most.
NAMED, LEAST, CHARACTERS, MOST = 5.0, 0.2, 100, 3
PROSE = frozenset("p pre blockquote td div section article main body".split())
#: Blocks that pass their points to what is around them; others get the first share themselves.
LEAVES = frozenset("p pre blockquote h1 h2 h3 h4 h5 h6 li td th dd dt".split())
#: Containers that are part of what is around them.
INSIDE = frozenset("ul ol dl table tbody thead tr td li p span blockquote figure header".split())
#: Siblings of the best container that are text unless they are links for the most part.
TEXT = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())


def is_named(name: str, words: frozenset[str]) -> bool:
    """Does a class, id or role say that its element is one of these?"""
    for token in name.split():
        w = [x.lower() for x in WORDS.split(token) if x]
        if not w or ABOUT & set(w):
            continue
        while len(w) > 1 and w[-1] in PARTS and w[-1] not in words:
            w.pop()
        if w[-1] in words:
            return True
    return False


class Node:
    __slots__ = ("tag", "parent", "depth", "children", "mark", "named", "gone", "points", "score", "chars", "linked")

    def __init__(self, tag: str, parent: Node | None, mark: str = "", named: bool = False):
        """mark: never (no text of an article), comments or chrome (by name, form or header: if nothing speaks against it), or nothing."""
        self.tag, self.parent, self.mark, self.named = tag, parent, mark, named
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []
        self.gone = False
        self.points = self.score = 0.0
        self.chars = self.linked = 0


def marked(tag: str, attributes: list[tuple[str, str]], parent: Node) -> tuple[str, bool]:
    """The mark of an element, and whether it is named like an article."""
    if tag in NEVER:
        return "never", False
    comments = chrome = named = False
    for name, value in attributes:
        if name in ("class", "id", "role", "itemprop"):
            comments = comments or is_named(value, COMMENTS)
            chrome = chrome or is_named(value, CHROME)
            named = named or bool({x.lower() for x in WORDS.split(value)} & GOOD)
        elif name == "hidden" and value.lower() != "until-found" or name == "aria-hidden" and value.lower() == "true" or name == "style" and HIDDEN.search(value):
            return "never", False
    if tag in ("html", "body", "main"):
        return "", named
    if comments:
        return "comments", False
    if tag == "header":
        up = parent
        while up is not None and up.tag not in ("article", "main"):
            up = up.parent
        chrome = chrome or up is None
    return "chrome" if chrome or tag == "form" else "", named and not chrome


class Parser:
    """Reads a page from left to right, with ends implied where browsers imply them. Text stays encoded."""

    def __init__(self, page: str):
        self.page, self.size = page, len(page)
        self.spent: set[str] = set()  # quotes that don't come again
        self.root = self.node = Node("#root", None)
        self.open: dict[str, int] = {}

    def attributes(self, at: int) -> tuple[list[tuple[str, str]], int]:
        """Names and values from here to the end of the tag. A quoted value ends at the next quote like its own, whatever
        is between; if there is none, the tag ends at the next >."""
        page, out = self.page, []
        while True:
            m = NAME.match(page, at)
            at = m.end()
            if not m[1]:
                return out, min(at + 1, self.size)
            name, value = m[1].lower(), ""
            if m := EQUALS.match(page, at):
                at = m.end()
                quote = page[at : at + 1]
                if quote and quote in "\"'":
                    end = -1 if quote in self.spent else page.find(quote, at + 1)
                    if end < 0:
                        self.spent.add(quote)
                        end = page.find(">", at)
                        return out, end + 1 if end >= 0 else self.size
                    value, at = page[at + 1 : end], end + 1
                else:
                    m = BARE.match(page, at)
                    value, at = m[0], m.end()
            out.append((name, entities.unescape(value) if "&" in value else value))

    def enter(self, node: Node) -> None:
        self.node = node
        self.open[node.tag] = self.open.get(node.tag, 0) + 1

    def leave(self, node: Node) -> None:
        """Close this open element and all inside it."""
        up = self.node
        while up is not node.parent:
            self.open[up.tag] -= 1
            up = up.parent
        self.node = node.parent

    def start(self, tag: str, attributes: list[tuple[str, str]], at: int) -> int:
        ends = ENDED_BY.get(tag, ())
        if any(self.open.get(t) for t in ends):
            up = self.node
            while up is not self.root and (up.tag in ends or up.tag not in SCOPE):
                above = up.parent
                if up.tag in ends:
                    self.leave(up)
                up = above
        if tag == "br":
            self.node.children.append(" ")
            return at
        parent = self.node if self.node.depth < DEEP else self.node.parent
        mark, named = marked(tag, attributes, parent)
        new = Node(tag, parent, mark, named)
        parent.children.append(new)
        if tag in RAW:
            end = RAW[tag].search(self.page, at)
            if not mark:
                new.children.append(self.page[at : end.start() if end else self.size])
            return end.end() if end else self.size
        if tag not in VOID and not (self.page[at - 2 : at] == "/>" and tag in ("svg", "math", "path", "g", "use", "circle", "rect")):
            if parent is not self.node:
                self.leave(self.node)
            self.enter(new)
        return at

    def end(self, tag: str) -> None:
        if tag == "br":
            self.node.children.append(" ")
        elif self.open.get(tag):
            up = self.node
            while up.tag != tag:
                if up.tag in SCOPE and tag in INLINE:  # an inline end tag ends nothing outside its block
                    return
                up = up.parent
            self.leave(up)
        elif tag == "p":
            self.node.children.append(Node("p", self.node))

    def tree(self) -> Node:
        page, at = self.page, 0
        while m := MARKUP.search(page, at):
            if m.start() > at:
                self.node.children.append(page[at : m.start()])
            at = m.end()
            if m[2] is None:
                if m[0] == "<!--":
                    end = COMMENT_END.search(page, at) if not page.startswith((">", "->"), at) else re.compile(">").search(page, at)
                    at = end.end() if end else self.size
                else:
                    data = m[0].startswith("<![")
                    end = page.find("]]>" if data else ">", at)
                    if data:
                        self.node.children.append(entities.escape(page[at : end if end >= 0 else self.size]))
                    at = end + (3 if data else 1) if end >= 0 else self.size
                continue
            attributes, at = self.attributes(at)
            if m[1]:
                self.end(m[2].lower())
            else:
                at = self.start(m[2].lower(), attributes, at)
        if at < self.size:
            self.node.children.append(page[at:])
        return self.root


def parse(page: str) -> Node:
    return Parser(page).tree()


def blocks_of(root: Node) -> list[tuple[Node, str, int]]:
    """In page order, of what isn't gone: the block element, its own text (decoded, white space as one space, trimmed; never
    empty) and how many of its characters are in links. Text on either side of an inner block makes two blocks."""
    out: list[tuple[Node, str, int]] = []
    parts: list[str] = []
    holder: Node = root
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = WHITE.sub(" ", entities.unescape("".join(parts))).strip()
            if text:
                out.append((holder, text, min(linked, len(text))))
            parts.clear()
        linked = 0

    stack: list[tuple[Node, Iterator, Node, bool]] = [(root, iter(root.children), root, False)]
    while stack:
        node, rest, block, link = stack[-1]
        for child in rest:
            if isinstance(child, str):
                if not parts:
                    holder = block
                parts.append(child)
                if link:
                    linked += len(child.strip())
            elif child.gone:
                if child.tag not in SILENT:
                    flush()
            else:
                inline = child.tag in INLINE
                if not inline:
                    flush()
                stack.append((child, iter(child.children), block if inline else child, link or child.tag == "a"))
                break
        else:
            stack.pop()
            if node.tag not in INLINE:
                flush()
    flush()
    return out


def points_of(node: Node, text: str, linked: int) -> float:
    """What a block is worth: one, its commas and its length, less its share of links. A heading or a bare line says less than a paragraph."""
    points = (1 + text.count(",") + text.count("，") + text.count("、") + min(len(text) / CHARACTERS, MOST)) * (1 - linked / len(text))
    return points * (1.0 if node.tag in PROSE else 0.25)


def scored(blocks: list[tuple[Node, str, int]]) -> list[Node]:
    """All containers of the blocks in page order, with their points, characters and scores."""
    seen: dict[int, Node] = {}
    for node, text, linked in blocks:
        points = points_of(node, text, linked)
        up = node.parent if node.tag in LEAVES else node
        for share in SHARES:
            if up is None or up.tag == "#root":
                break
            up.points += points * share
            seen[id(up)] = up
            up = up.parent
        up = node
        while up is not None:
            up.chars += len(text)
            up.linked += linked
            up = up.parent
    for x in seen.values():
        x.score = (x.points + BASE.get(x.tag, 0.0) + NAMED * x.named) * (1 - x.linked / max(1, x.chars))
    return list(seen.values())


def remove(root: Node, names: bool) -> None:
    """Mark as gone what no article holds. names: also by name, unless the element holds most of the page's points."""
    nodes = [root]
    for x in nodes:
        x.gone = x.mark == "never"
        if not x.gone:
            nodes += [c for c in x.children if isinstance(c, Node)]
    if not names:
        return
    for x in nodes:
        x.gone = x.gone or x.mark == "comments"
    total = 0.0
    inside: dict[int, float] = {}
    for node, text, linked in blocks_of(root):
        points = points_of(node, text, linked)
        total += points
        up = node
        while up is not None:
            if up.mark == "chrome":
                inside[id(up)] = inside.get(id(up), 0.0) + points
            up = up.parent
    for x in nodes:
        x.gone = x.gone or x.mark == "chrome" and inside.get(id(x), 0.0) <= total / 2


def region(best: Node) -> Node:
    """The container as a whole: the article around it, or else what a list, a table or the like is part of."""
    around, up = best, best
    while up is not None:
        if up.tag in ("article", "main"):
            around = up
            if up.tag == "article":
                break
        up = up.parent
    if around is not best:
        return around
    while best.tag in INSIDE and best.parent is not None and best.parent.tag not in ("#root", "html", "body"):
        best = best.parent
    return best


def main_text(page: str) -> str:
    """The article's blocks joined by line ends; empty if there is none."""
    root = parse(page)
    found: list[tuple[Node, str, int]] = []
    for names in (True, False):
        remove(root, names)
        found = blocks_of(root)
        if found:
            break
    if not found:
        return ""
    containers = scored(found)
    if not containers:
        return "\n".join(t for _, t, _ in found)
    top = max(containers, key=lambda x: x.score)
    best = region(top)
    kept = {id(best)}
    least = max(2.0, LEAST * top.score)
    # containers elsewhere with paragraphs of their own, and an article's other parts
    whole = best.tag == "article"
    for x in containers:
        if x.score >= least and 2 * x.linked < x.chars and x.tag not in ("html", "body") and (x.tag == "article") == whole:
            kept.add(id(x))
    if not whole and best.parent is not None:
        kept.update(id(s) for s in best.parent.children if isinstance(s, Node) and s.tag in TEXT and not s.gone and 2 * s.linked < s.chars)
    out = []
    for node, text, linked in found:
        up = node
        while up is not None and id(up) not in kept:
            up = up.parent
        # bare text beside the best container is a paragraph without its tags
        if up is not None or not whole and node is best.parent and 2 * linked < len(text):
            out.append(text)
    return "\n".join(out)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of pages: the main text of the whole html. Null or empty html, or none
    found: empty text. Of containers that score alike the first in the page is best. Broken markup is read as far as
    browsers would; nothing is cut short, however long the page. One pass, no shuffle; a row needs memory for its own tree.
    An empty table gives no rows. Other columns are ignored; repeated rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in chunks(batches, "html"):
            got = [main_text(t.decode()) for t in texts]
            yield pa.record_batch([part.column(0), part.column(1), pa.array(got, pa.string()), pa.array([len(t) for t in got], pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("bigint"), "url", "html").mapInArrow(tidy(run), "page_id bigint, url string, text string, n_chars bigint")
