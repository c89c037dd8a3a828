"""Main text of web pages by tree scoring.

A page is parsed into a light tree; elements that are never article text (scripts, styles,
navigation, asides; by tag or role) are left out while it is built. Adverts, notices, reader
comments (by class or id) and forms are left out then, unless they hold the article. Inside an
article or main element a name alone says little: reader comments go, what is named an advert or
a share bar if it has little text or mostly links, what has another unlikely name if it is mostly
links. If no text is left, names are not asked. Every paragraph then gives points for its length and its commas to
its parent and, halved and less, to the ancestors above. A container's score is its points
times one minus its link density. The best container is kept (as a whole the article or main element it
stands in), with the siblings that score
well themselves or are plain paragraphs of text. Block texts are joined in page order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Fixed values of HTML: elements without content, elements that break a line of text, elements
# whose content is not text of the page, elements that end an open element of a kind.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("address article blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol p pre section summary table tbody "
                  "td tfoot th thead tr ul".split())
SKIP = frozenset("aside audio button canvas datalist dialog embed fieldset footer form frameset head iframe input legend "
                 "map menu nav noembed noframes noscript object option script select style svg template textarea title "
                 "video".split())
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "tr": "tr td th", "td": "td th", "th": "td th",
        "tbody": "thead tbody tr td th", "tfoot": "thead tbody tr td th", "option": "option"}
SCOPE = frozenset("ul ol dl table article section div body html main td th blockquote".split())

UNLIKELY_ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                           "toolbar status".split())
#: Words of a class or id that mark what surrounds an article.
UNLIKELY = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|breadcrumbs?|comments?|commentlist|"
    r"consent|cookies?|disqus|disclaimer|footer|gdpr|header|masthead|menu|modal|nav|navbar|navigation|newsletter|notices?|"
    r"notification|outbrain|overlay|pager|pagination|popup|promos?|recommended|related|remark|replies|respond|search|share|"
    r"sharing|sidebar|signup|social|sponsor|sponsored|subscribe|taboola|toolbar|widget|alert|login|skip)(?:$|[\s_-]|\d)", re.I)
#: A class or id that is the name of reader comments, as a whole.
COMMENTS = re.compile(r"(?:(?:reader|user|post|article|page|blog|all|the)[-_])?(?:comment-?list|comments?|responses?|repl(?:y|ies)|discussions?|reactions?|"
                      r"disqus)(?:[-_](?:list|area|section|container|wrapper|wrap|thread|block|box|body|item|content|inner|\d+))*", re.I)
#: Words of names that leave little doubt even inside an article.
STRONG = re.compile(r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|adsense|banners?|breadcrumbs?|consent|cookies?|gdpr|login|modal|newsletter|"
                    r"outbrain|overlay|pager|pagination|popup|promos?|share|sharing|signup|skip|sponsor|sponsored|subscribe|taboola|toolbar)(?:$|[\s_-]|\d)", re.I)
#: Characters of a text below which it is little.
LITTLE = 200
#: Titles of lists of links that are no part of the article above them.
RELATED = re.compile(r"(?i)\b(?:related|read (?:more|next)|more (?:from|stories|articles)|you (?:may|might)|recommended|popular|latest|trending|share|follow us|"
                     r"tags|categories)\b")
LIKELY = re.compile(r"(?:^|[\s_-])(?:article|body|content|entry|main|post|story|text)(?:$|[\s_-])", re.I)
#: Marked sections, which pages treat as comments up to the next ``>``.
ODD_DECLARATION = re.compile(r"<!\[[^>]*>?")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

#: Points by tag that a container starts with.
START = {"article": 25.0, "main": 15.0, "section": 3.0, "div": 5.0, "blockquote": 3.0, "pre": 3.0, "td": 3.0,
         "ul": -3.0, "ol": -3.0, "dl": -3.0, "li": -3.0, "form": -3.0, "th": -5.0, "body": 0.0}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Ancestors of a paragraph that it gives points.
ANCESTORS = 64
#: How much a name speaks against an element.
WEAK, SURE, READERS = 1, 2, 3


class Node:
    __slots__ = ("tag", "parent", "children", "points", "chars", "linked", "bonus", "doubtful", "sign")

    def __init__(self, tag: str, parent: Node | None, bonus: float = 0.0):
        self.tag, self.parent, self.bonus = tag, parent, bonus
        self.children: list[Node | str] = []
        self.points = 0.0
        self.chars = self.linked = 0
        self.doubtful = False  # its name, or being a form, speaks against it
        self.sign = 0  # how much its name does


def sign_of(attrs: list[tuple[str, str | None]]) -> int:
    """How much an element's class and id speak against it."""
    names = [n for k, v in attrs if k in ("class", "id") for n in (v or "").split()]
    if any(COMMENTS.fullmatch(n) for n in names):
        return READERS
    words = re.sub(r"([a-z])([A-Z])", r"\1-\2", " ".join(names))
    return SURE if STRONG.search(words) else WEAK if UNLIKELY.search(words) else 0


def unlikely(tag: str, attrs: list[tuple[str, str | None]], inside_article: bool) -> bool | None:
    """Whether an element is never article text; None if only its name or being a form says so."""
    if tag in SKIP and tag != "form":
        return True
    if tag == "header" and not inside_article:
        return True
    if attrs and tag == "article" and inside_article and sign_of(attrs) == READERS:
        return None
    if not attrs or tag in ("html", "body", "article", "main"):
        return None if tag == "form" else False
    found = dict(attrs)
    if "hidden" in found or (found.get("aria-hidden") or "").lower() == "true" or HIDDEN.search(found.get("style") or ""):
        return True
    if (found.get("role") or "").strip().lower() in UNLIKELY_ROLES:
        return True
    if tag == "form":
        return None
    if tag in HEADINGS or tag in ("a", "b", "i", "em", "strong", "span", "p") and inside_article and "id" not in found and "class" not in found:
        return False
    return None if sign_of(attrs) else False


class TreeBuilder(HTMLParser):
    """Builds the tree without what is never article text; open elements end as HTML says."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("html", None)
        self.skipping: list[str] = []  # open elements from the first skipped one on
        self.articles = 0
        self.open: Counter[str] = Counter()  # open elements by name

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skipping:
            if tag not in VOID:
                self.skipping.append(tag)
            if tag == "body" and self.skipping[0] == "head":  # a head that is never closed
                self.skipping.clear()
            return
        if tag in ("html", "body") and self.at is self.root and tag == "html":
            return
        if tag in BLOCK:
            self._end_open("p", SCOPE)
        if tag in ENDS:
            for other in ENDS[tag].split():
                self._end_open(other, frozenset(("ul", "ol", "dl", "table")))
        if tag in VOID:
            if tag not in ("input", "embed"):
                self.at.children.append(Node(tag, self.at))
            return
        verdict = unlikely(tag, attrs, self.articles > 0)
        if verdict:
            self.skipping.append(tag)
            if tag in BLOCK or tag in SKIP:
                self.at.children.append(Node("hr", self.at))  # still breaks the text around it
            return
        if tag == "form" and self._is_open("form"):
            return  # forms do not nest
        bonus = 0.0
        if attrs and tag in ("div", "section", "td"):
            names = " ".join(v or "" for k, v in attrs if k in ("class", "id"))
            bonus = 25.0 if LIKELY.search(names) else 0.0
        node = Node(tag, self.at, bonus)
        node.doubtful = verdict is None
        node.sign = sign_of(attrs) if node.doubtful and attrs else 0
        self.at.children.append(node)
        self.at = node
        self.open[tag] += 1
        self.articles += tag in ("article", "main")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # the slash has no meaning in HTML

    def handle_endtag(self, tag: str) -> None:
        if self.skipping:
            if tag in self.skipping:
                while self.skipping.pop() != tag:
                    pass
            elif tag in ("article", "main", "body") and self._is_open(tag):
                self.skipping.clear()  # a skipped element that was never closed ends with its container
                self._end_open(tag, frozenset())
            return
        if tag == "p" and not self._is_open("p"):
            self.at.children.append(Node("hr", self.at))
        elif tag not in ("html", "body"):
            self._end_open(tag, frozenset() if tag in BLOCK else SCOPE | BLOCK)

    def handle_data(self, data: str) -> None:
        if not self.skipping:
            self.at.children.append(data)

    def parse_comment(self, i: int, report: int = 1) -> int:
        """A comment that is never closed goes to the end of the page."""
        end = self.rawdata.find("-->", i + 2)
        return len(self.rawdata) if end < 0 else end + 3

    def _is_open(self, tag: str) -> bool:
        return self.open[tag] > 0

    def _close(self) -> None:
        self.open[self.at.tag] -= 1
        self.articles -= self.at.tag in ("article", "main")
        self.at = self.at.parent

    def _end_open(self, tag: str, scope: frozenset[str]) -> None:
        """Close the innermost open ``tag``, unless an element of ``scope`` is open inside it."""
        if not self._is_open(tag):
            return
        node = self.at
        while node.tag != tag:
            if node.tag in scope:
                return
            node = node.parent
        while self.at is not node:
            self._close()
        self._close()


#: What opens a tag, comment or declaration.
OPENS = re.compile(r"<[A-Za-z/!?]")


def parse(html: str) -> Node:
    builder = TreeBuilder()
    html = ODD_DECLARATION.sub("", html) if "<![" in html else html
    end = html.rfind(">") + 1  # nothing that opens behind it ends
    builder.feed(html[:end])
    rest = OPENS.search(html, end)
    builder.feed(html[end:rest.start() if rest else len(html)])
    builder.close()
    return builder.root


def in_order(root: Node) -> Iterator[tuple[Node | str, Node, bool]]:
    """All nodes and strings in page order, each element again when it ends (without recursion)."""
    stack: list[tuple[Node | str, Node, bool]] = [(root, root, False)]
    while stack:
        item, parent, ends = stack.pop()
        yield item, parent, ends
        if not ends and isinstance(item, Node):
            stack.append((item, parent, True))
            stack.extend((c, item, False) for c in reversed(item.children))


def prune(root: Node, by_name: bool = True) -> None:
    """Leave out elements that their name speaks against, and forms, unless they hold the article.

    Such an element stays if an article, a main element or a container with a likely name is
    inside it, if it is a heading's wrapper in an article, or if most of the page's paragraph text
    is. Reader comments stay only if there is hardly any text beside them. Inside an article or
    main element names count as :func:`against` says. Without ``by_name`` only forms go.
    """
    if not any(isinstance(n, Node) and n.doubtful for n, _, ends in in_order(root) if not ends):
        return
    text: dict[int, int] = {}  # characters of paragraphs in an element
    size: dict[int, int] = {}  # all characters
    links: dict[int, int] = {}  # characters of links
    link = 0
    holds: set[int] = set()  # elements with an article, a main element or a likely name inside
    titles: set[int] = set()  # elements with a h1 inside
    paragraph = articles = 0
    in_article: set[int] = set()
    for item, parent, ends in in_order(root):
        if isinstance(item, str):
            n = len("".join(item.split()))
            size[id(parent)] = size.get(id(parent), 0) + n
            if link:
                links[id(parent)] = links.get(id(parent), 0) + n
            if paragraph:
                text[id(parent)] = text.get(id(parent), 0) + n
            continue
        if not ends:
            link += item.tag == "a"
            paragraph += item.tag == "p"
            if articles:
                in_article.add(id(item))
            articles += item.tag in ("article", "main")
            continue
        link -= item.tag == "a"
        paragraph -= item.tag == "p"
        articles -= item.tag in ("article", "main")
        if item is root:
            continue
        for counted in (text, size, links):
            counted[id(parent)] = counted.get(id(parent), 0) + counted.get(id(item), 0)
        if id(item) in holds or item.tag in ("article", "main") or item.bonus and not item.doubtful:
            holds.add(id(parent))
        if id(item) in titles or item.tag == "h1":
            titles.add(id(parent))
    most, everything = text.get(id(root), 0) / 2, size.get(id(root), 0)

    def against(child: Node, inside: bool) -> bool:
        """Whether a doubtful element goes."""
        chars, linked = size.get(id(child), 0), links.get(id(child), 0)
        if child.sign == READERS:
            return everything - chars >= LITTLE / 2
        if id(child) in titles and (inside or child.bonus > 0):
            return False
        if inside and child.tag != "form":
            return linked > chars / 2 or child.sign == SURE and chars < LITTLE
        return not (id(child) in holds and not inside or text.get(id(child), 0) > most > 0)

    stack = [root]
    while stack:
        node = stack.pop()
        for k, child in enumerate(node.children):
            if not isinstance(child, Node):
                continue
            if child.doubtful and (by_name or child.tag == "form") and against(child, id(child) in in_article):
                node.children[k] = Node("hr" if child.tag in BLOCK or child.tag in SKIP else "wbr", node)
            else:
                stack.append(child)


def score(root: Node) -> None:
    """Fill in points, characters and linked characters of every element."""
    link = 0
    own: dict[int, list[str]] = {}  # of open blocks: the text that is theirs
    blocks: list[Node] = [root]
    own[id(root)] = []

    def give(block: Node) -> None:
        text = " ".join("".join(own.pop(id(block))).split())
        if not text or block.tag in HEADINGS:
            return
        points = 1.0 + text.count(",") + min(len(text) / 100, 3.0)
        if len(text) < 25:
            points *= 0.2
        # Text of a paragraph counts for what holds it; text right inside a container for itself.
        node, level = (block.parent if block.tag in ("p", "pre", "li", "td", "blockquote", "dd") else block), 0
        while node is not None and level < ANCESTORS:
            node.points += points / (1, 2)[level] if level < 2 else points / (3 * level)
            node, level = node.parent, level + 1

    for item, parent, ends in in_order(root):
        if isinstance(item, str):
            n = len("".join(item.split()))
            parent.chars += n
            parent.linked += n if link else 0
            own[id(blocks[-1])].append(item)
        elif ends:
            if item.tag == "a":
                link -= 1
            if item is not root:
                if item.tag in BLOCK:
                    give(blocks.pop())
                    own[id(blocks[-1])].append(" ")
                parent.chars += item.chars
                parent.linked += item.linked
        elif item is not root:
            link += item.tag == "a"
            if item.tag in BLOCK:
                blocks.append(item)
                own[id(item)] = []
    give(root)


def link_density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def total(node: Node) -> float:
    return (node.points + START.get(node.tag, 0.0) + node.bonus) * (1.0 - link_density(node))


def chosen(root: Node) -> list[Node]:
    """The best container and the siblings that belong to it, in page order."""
    containers = [n for n, _, ends in in_order(root)
                  if isinstance(n, Node) and not ends and n.points > 0 and (n is root or n.tag in START or n.tag in BLOCK)
                  and n.tag not in HEADINGS and n.tag != "p"]
    if not containers:
        return [root]
    best = max(containers, key=total)
    around = [best]
    while around[-1].parent is not None:
        around.append(around[-1].parent)
    # An article or main element with the best container in it is kept as a whole.
    best = next((n for tag in ("article", "main") for n in reversed(around) if n.tag == tag), best)
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * total(best))
    kept = []
    for s in best.parent.children:
        if isinstance(s, str) or s.chars == 0:
            continue
        paragraph = s.tag == "p" and link_density(s) < 0.25 and (s.chars > 80 or s.chars > 0 and s.linked == 0)
        if s is best or paragraph or (s.points > 0 and total(s) >= least and s.tag not in HEADINGS) or s.tag == "h1":
            kept.append(s)
        elif s.tag not in HEADINGS:
            kept.extend(n for n, _, ends in in_order(s) if isinstance(n, Node) and n.tag == "h1" and not ends)
    return kept


def block_texts(root: Node) -> list[str]:
    """Texts of the blocks under ``root``; lists that are mostly links are menus and left out.

    In an article or main element only lists of nothing but links are menus, and only if nothing
    introduces them: a heading that does not speak of related pages, or a line that ends in a colon.
    """
    out: list[str] = []
    now: list[str] = []
    last = ("", "")  # the last text and the element it is of
    menu: Node | None = None
    inside = 0
    node: Node | None = root.parent
    while node is not None:
        inside += node.tag in ("article", "main")
        node = node.parent

    def introduced() -> bool:
        tag, said = last
        return said.endswith(":") or tag in HEADINGS and tag != "h1" and not RELATED.search(said)

    def is_menu(item: Node) -> bool:
        if item.tag not in ("ul", "ol", "dl", "table") or sum(isinstance(c, Node) for c in item.children) <= 2:
            return False
        if inside:
            return item.tag in ("ul", "ol") and item.linked == item.chars > 0 and not introduced()
        return link_density(item) > 0.8

    def flush(tag: str) -> None:
        nonlocal last
        text = " ".join("".join(now).split())
        now.clear()
        if text:
            out.append(text)
            last = tag, text

    for item, parent, ends in in_order(root):
        if isinstance(item, str):
            if menu is None:
                now.append(item)
            continue
        if item.tag in BLOCK:
            flush(item.tag if ends else parent.tag)
        elif item.tag == "br" and not ends:
            now.append(" ")
        if item.tag in ("article", "main"):
            inside += -1 if ends else 1
        if ends:
            if item is menu:
                menu = None
        elif menu is None and is_menu(item):
            menu = item
    flush(root.tag)
    return out


def main_text(html: str | None) -> str:
    """The article of a page, blocks joined by two line feeds; empty if there is none."""
    if not html:
        return ""
    for by_name in (True, False):  # names are not asked again if nothing is left
        root = parse(html)
        prune(root, by_name)
        score(root)
        text = "\n\n".join(t for node in chosen(root) for t in block_texts(node))
        if text:
            break
    return text


def html_extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``.

    Null or empty html, and pages without text outside menus and the like, give an empty text
    with 0 characters. Rows are independent: repeated rows give repeated results, null ids and
    urls are handed through, an empty input gives an empty result.
    """
    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [main_text(h) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"])

    pages = df.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return pages.mapInArrow(extract, "page_id long, url string, text string, n_chars long")
