"""Main text of web pages by consensus paths of a host.

A page's containers are scored by the text of their paragraphs, less links. Each page votes for its
best containers, named by their generalised path (tags and classes from the root, digits as N). Votes
are added up per host in Spark, so one odd page does not decide; then every page is read again and
the text is taken from the containers on its host's winning path. A page without that path uses its
own best container. The text is that of the article or main element around the container; without one, of
the elements around it as far as they add text that is not links, so titles and leads beside the body stay.

Left out everywhere: scripts, styles, forms, navigation, headers, footers, sidebars, notices,
adverts, sharing and comment sections, by tag, role or class. A heading in an article's own header
stays. So does an element marked by a word of its class or id only if it is what the page is about: it
holds the main element, or an article or most of the text outside links (see `_restore`). Hidden are
elements with the attribute hidden or display:none in their style. Inside an article a name of several words
marks only if all are such words or words of layout ("share-buttons", not "market-share"); paragraphs, headings, list
items and inline elements there are marked by no ordinary word (ORDINARY) and by no name of several. Blocks are trimmed, white space within them becomes one space, and they are joined in page
order by one space.

Votes are whole numbers, so sums do not depend on their order; ties go to the smaller path, within a page to
that which begins first. Only path names and votes are grouped by host. The winners, a row per host, are broadcast
after a check of their rows and bytes, and the pages stay where they are. Beyond that, hosts with more than HOT_PAGES
pages still meet their winner by broadcast, and only the pages of the others are shuffled by host.

Parsing takes time in proportion to the page: ends of tags that fail are remembered, open elements are found by
their depth, and lengths of text are counted once for the whole tree.

Edge cases: null or empty html gives an empty text; a null or odd url is the empty host; repeated
rows vote and are extracted one by one; broken markup (open or crossed tags) is closed as browsers
do for paragraphs and lists, else at the end of the enclosing element; a mark within MARK_DEPTH marked elements
follows the innermost of them; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgrid.llm.shared import MAX_BROADCAST_ROWS, broadcast_if_small, stored

CANDIDATES = 3
#: Hosts with more pages are not shuffled to one task.
HOT_PAGES = 10_000
MAX_BROADCAST_BYTES = 64 << 20
MARK_DEPTH = 16

# How tags behave in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("article main section div body td blockquote html center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED = frozenset(
    "script style noscript template svg math canvas iframe object nav aside footer form button select option textarea "
    "input label dialog menu head title audio video map".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp template svg math".split())
CLOSED_BY = {  # an open tag of the key ends when one of these begins
    "p": BLOCKS - {"br", "html", "body"},
    "li": frozenset(["li"]),
    "dt": frozenset(["dt", "dd"]),
    "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr"]),
    "td": frozenset(["td", "th", "tr"]),
    "th": frozenset(["td", "th", "tr"]),
    "option": frozenset(["option"]),
}
# Words in classes, ids and roles that mark what is not the article.
BOILERPLATE = frozenset(
    "nav navbar navigation menu menubar sidebar aside footer header masthead banner cookie cookies consent gdpr notice notices "
    "alert ad ads adv advert adverts advertisement advertising adsense adbox promo promotion sponsor sponsored comment comments "
    "disqus reply replies respond share sharing social related recommended newsletter subscribe subscription signup login popup "
    "modal overlay breadcrumb breadcrumbs pagination pager widget toolbar search contentinfo complementary disclaimer paywall "
    "skip tags toc copyright".split()
)
# Of these, words that text itself is often named by.
ORDINARY = frozenset(
    "alert menu search share sharing social related recommended reply replies respond footer header banner notice notices skip tags "
    "toc popup overlay modal widget toolbar pager login signup comment comments copyright disclaimer navigation".split()
)
# Words of layout that stand beside them in the names of such elements.
LAYOUT = frozenset(
    "area article articles author bar block body bottom box btn button buttons column container content entry form group icon icons inline "
    "inner item items left link links list main more outer page panel post posts right row section site slot stories story text title "
    "tools top unit wrap wrapper".split()
)
_STRONG = re.compile(r"^(comment|sidebar|advert|cookie|navbar|newsletter|breadcrumb)")
_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*+>|<\?[^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S
)
_NAME = re.compile(r"</?[a-zA-Z][^\s/>]*+")
_BOUNDS = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"(?:(?<=[\s=/\"'>])|\A)([^\s=/\"'>]++)\s*+=\s*+(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]++))")
_NOT_SHOWN = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
# Words that make a class a state of the page ("has-sidebar", "comments-open"), not a name of the element.
_STATE = re.compile(r"^(has|have|no|not|with|without|is|show|hide)[-_]|[-_](open|opened|closed|enabled|disabled|on|off|active|visible)$")
_READERS = re.compile(r"^(comment|disqus|repl|respond)")
#: Kinds of marked elements, the likeliest article first.
MARKS = ("state", "mixed", "named", "readers")
#: An element that is only named as boilerplate is kept if it holds so many times the text of the rest.
NAMED_TIMES = 10
_SPLIT = re.compile(r"[^a-z]+")
_DIGITS = re.compile(r"\d+")
_SPACE = re.compile(r"\s+")


class Node:
    __slots__ = ("children", "dropped", "head", "home", "mark", "name", "parent", "size", "tag")

    def __init__(self, tag: str, parent: Node | None, name: str, dropped: bool, mark: str = "") -> None:
        self.tag, self.parent, self.name, self.dropped, self.mark = tag, parent, name, dropped, mark
        self.children: list[Node | str] = []
        self.size = (0, 0)  # letters of text below, of them in links; without dropped parts
        # The nearest container and article or main element, itself included.
        self.home: Node = self if parent is None or tag in CONTAINERS else parent.home
        self.head: Node | None = self if tag in ("article", "main") else parent and parent.head

    def path(self) -> str:
        names, node = [], self
        while node is not None and node.parent is not None:
            names.append(node.name)
            node = node.parent
        return ">".join(reversed(names))


class _Tags:
    """The tags of a page in order. Where one fails for want of its end, no other looks through that text again."""

    def __init__(self, html: str) -> None:
        self.html, self.last = html, html.rfind(">")
        self.bounds: list[int] | None = None  # where > and quotation marks stand, once a tag has failed
        self.ends: dict[int, bool] = {}

    def _has_end(self, at: int) -> bool:
        """Whether a > outside quotation marks follows."""
        if self.bounds is None:
            self.bounds, self.quotes = [], {'"': [], "'": []}
            for m in _BOUNDS.finditer(self.html):
                self.bounds.append(m.start())
                if m[0] != ">":
                    self.quotes[m[0]].append(m.start())
        seen, found = [], False
        while (i := bisect_left(self.bounds, at)) < len(self.bounds):
            at = self.bounds[i]
            if at in self.ends:
                found = self.ends[at]
                break
            seen.append(at)
            if self.html[at] == ">":
                found = True
                break
            quotes = self.quotes[self.html[at]]
            if (k := bisect_right(quotes, at)) == len(quotes):
                break
            at = quotes[k] + 1
        self.ends.update(dict.fromkeys(seen, found))
        return found

    def next(self, at: int) -> re.Match | None:
        while (at := self.html.find("<", at)) >= 0:
            if at > self.last:
                at = self.html.find("<!--", at)
                return _TAG.match(self.html, at) if at >= 0 else None
            if self.bounds is None or not (name := _NAME.match(self.html, at)) or self._has_end(name.end()):
                if m := _TAG.match(self.html, at):
                    return m
                if name := _NAME.match(self.html, at):
                    self._has_end(name.end())
                    at = name.end() - 1 if self.html.find("<", at + 1, name.end()) < 0 else at
            at += 1
        return None


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(text)} if "=" in text else {}


def _is_hidden(attributes: dict[str, str], rest: str) -> bool:
    if _NOT_SHOWN.search(attributes.get("style", "")):
        return True
    if "hidden" not in rest.lower():
        return False
    return attributes.get("hidden", "until-found").lower() != "until-found" or "hidden" in _ATTRIBUTE.sub(" ", rest).lower().replace("/", " ").split()


def _is_word(word: str) -> bool:
    return word in BOILERPLATE or bool(word and _STRONG.match(word))


def _names(name: str, inside: bool, plain: bool) -> bool:
    """Whether a class or id names what is not the article; `plain`: on a paragraph or the like inside an article."""
    parts = [w for w in _SPLIT.split(name) if w]
    if not any(map(_is_word, parts)):
        return False
    if plain:
        return len(parts) == 1 and parts[0] not in ORDINARY
    if not inside or len(parts) == 1 or any(w not in ORDINARY and _STRONG.match(w) for w in parts):
        return True
    return all(_is_word(w) or w in LAYOUT for w in parts)


def _mark(attributes: dict[str, str], inside: bool = False, plain: bool = False) -> str:
    """How class, id and role mark an element: "" not, "state", "mixed" (beside other names), "named" or "readers"."""
    if any(_is_word(w) for key in ("role", "aria-label") for w in _SPLIT.split(attributes.get(key, "").lower())):
        return "named"
    names = [*attributes.get("class", "").lower().split(), *attributes.get("id", "").lower().split()]
    marked = [n for n in names if _names(n, inside, plain)]
    if not marked:
        return ""
    if all(map(_STATE.search, marked)):
        return "state"
    if any(_READERS.match(w) for n in marked if not _STATE.search(n) for w in _SPLIT.split(n)):
        return "readers"
    return "mixed" if len(marked) < len(names) else "named"


def _restore(root: Node) -> None:
    """Decides on elements that only a word marks, and lets dropped elements drop all below them.

    Text is counted without links. An element is held against the rest of the page that no word marks:
    a state drops none with an article or more text than the rest; a name beside others none with one article or
    more text than the rest, unless an article stands elsewhere; a name alone none with an article and more
    text than the rest, on the same condition. Any with NAMED_TIMES the text of the rest stays, and so do
    those around a main element. Sections of comments may hold articles of their own and only stay by NAMED_TIMES.
    """
    plain: dict[int, int] = {}  # text below an element outside marked elements
    heads: dict[int, list[Node]] = {}  # article and main elements likewise
    marked: list[tuple[Node, list[Node]]] = []  # with the marked elements around each, outermost first
    stack: list[tuple[Node, list[Node], bool]] = [(root, [root], False)]
    while stack:
        node, zones, link = stack.pop()
        zone = id(zones[-1])
        for child in node.children:
            if isinstance(child, str):
                plain[zone] = plain.get(zone, 0) + (0 if link else len(child.strip()))
            elif not child.dropped:
                if child.tag in ("article", "main"):
                    heads.setdefault(zone, []).append(child)
                if len(zones) > MARK_DEPTH:
                    child.mark = ""
                if child.mark:
                    marked.append((child, zones))
                stack.append((child, [*zones, child] if child.mark else zones, link or child.tag == "a"))
    held, inside = dict(plain), {k: list(v) for k, v in heads.items()}
    for level in range(len(MARKS)):  # what is kept at one level is part of the rest at the next
        shown = [n for n, zones in marked if not n.mark and not any(z.mark for z in zones)]
        base = sum(plain.get(id(n), 0) for n in [root, *shown])
        seen = {id(root), *map(id, shown)}
        for node, zones in reversed(marked):  # inner elements before those around them
            if node.mark not in MARKS[: level + 1]:
                continue
            own, parts = held.get(id(node), 0), inside.get(id(node), [])
            rest = base + sum(plain.get(id(z), 0) for z in zones if id(z) not in seen)
            keep = any(n.tag == "main" for n in parts) or own > NAMED_TIMES * rest
            if node.mark == "state":
                keep = keep or bool(parts) or own > rest
            elif node.mark == "mixed":
                keep = keep or (len(parts) == 1 or own > rest) and own > 0 and not _beside(node, zones, inside)
            elif node.mark == "named":
                keep = keep or bool(parts) and own > rest and not _beside(node, zones, inside)
            if keep:
                node.mark = ""
                for z in reversed(zones):
                    held[id(z)] = held.get(id(z), 0) + own
                    inside.setdefault(id(z), []).extend(parts)
                    if z.mark:
                        break
    below = [root]
    while below:
        node = below.pop()
        for child in node.children:
            if isinstance(child, Node):
                child.dropped = child.dropped or bool(child.mark) or node.dropped
                below.append(child)
    _measure(root)


def _measure(root: Node) -> None:
    """Sizes of all elements, from the innermost outwards."""
    order = [root]
    for node in order:
        order += [c for c in node.children if isinstance(c, Node) and not c.dropped]
    for node in reversed(order):
        total = linked = 0
        for child in node.children:
            if isinstance(child, str):
                total += len(child.strip())
            elif not child.dropped:
                total += child.size[0]
                linked += child.size[1]
        node.size = (total, total if node.tag == "a" else linked)


def _beside(node: Node, zones: list[Node], inside: dict[int, list[Node]]) -> bool:
    """Whether a zone has, outside marked elements, an article or main that is not around the node."""
    around, up = set(), node.head
    while up is not None:
        around.add(id(up))
        up = up.parent and up.parent.head
    return any(id(n) not in around for z in zones for n in inside.get(id(z), []))


class _Open:
    """The open elements, from the root on, and at which depths they stand."""

    def __init__(self) -> None:
        self.nodes = [Node("", None, "", False)]
        self.depths: dict[str, list[int]] = {}
        self.barriers: list[int] = []  # what a stray inline end tag does not reach beyond
        self.stops: list[int] = []  # where the search for implied ends stops

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.nodes))
        if node.tag in _BARRIERS:
            self.barriers.append(len(self.nodes))
        if node.tag in _STOPS:
            self.stops.append(len(self.nodes))
        self.nodes.append(node)

    def close(self, depth: int) -> None:
        """Closes the element at this depth and all inside it."""
        while len(self.nodes) > depth:
            node = self.nodes.pop()
            self.depths[node.tag].pop()
            if node.tag in _BARRIERS:
                self.barriers.pop()
            if node.tag in _STOPS:
                self.stops.pop()

    def depth(self, tag: str) -> int:
        """Of the innermost open element of this kind; 0 if there is none."""
        depths = self.depths.get(tag)
        return depths[-1] if depths else 0


_FRAMES = BLOCKS | CONTAINERS
_BARRIERS = frozenset("article main body table".split())
_STOPS = CONTAINERS | {"table", "ul", "ol", "dl"}
_CLOSERS = {tag: [k for k, begins in CLOSED_BY.items() if tag in begins] for begins in CLOSED_BY.values() for tag in begins}


def parse(html: str) -> Node:
    """A light tree of elements and texts; comments and declarations are left out."""
    opened, tags = _Open(), _Tags(html)
    root = opened.nodes[0]
    at, size = 0, len(html)
    while at < size:
        m = tags.next(at)
        node = opened.nodes[-1]
        if m is None:
            node.children.append(html[at:])
            break
        if m.start() > at:
            node.children.append(html[at : m.start()])
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = opened.depth(tag)
            if depth and (tag in BLOCKS or not opened.barriers or opened.barriers[-1] <= depth):
                opened.close(depth)
            elif tag in ("p", "br"):
                node.children.append(Node("br", node, "br", False))
            continue
        # Elements whose end is implied: looked for up to the nearest container.
        closers = _CLOSERS.get(tag, ())
        depth, stop = max(map(opened.depth, closers), default=0), opened.stops[-1] if opened.stops else 0
        if depth > stop:
            opened.close(depth)
        elif opened.nodes[stop].tag in closers:
            opened.close(stop)
        node = opened.nodes[-1]
        rest = m[3]
        attributes = _attributes(rest)
        label = next((_DIGITS.sub("N", c) for c in attributes.get("class", "").lower().split()[:1]), "")
        mark = ""
        inside = node.head is not None
        if tag == "header":
            dropped = not inside or bool(_mark({"id": attributes.get("id", "")}))
        else:
            dropped = tag in DROPPED and not (inside and tag == "label")
            if not dropped and rest and tag not in ("html", "body", "article", "main"):
                dropped = _is_hidden(attributes, rest)
                mark = _mark(attributes, inside, inside and (tag in ("p", "li") or tag in HEADINGS or tag not in _FRAMES))
        child = Node(tag, node, f"{tag}.{label}" if label else tag, dropped, mark)
        node.children.append(child)
        if tag in RAW and not rest.endswith("/"):
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(html, at)
            at = end.end() if end else size
        elif tag not in VOID and not (rest.endswith("/") and tag in ("svg", "path")):
            opened.push(child)
    _restore(root)
    return root


def text_of(node: Node) -> list[str]:
    """The blocks of text below a node, decoded and trimmed."""
    blocks: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        if line:
            text = _SPACE.sub(" ", entities.unescape("".join(line))).strip()
            if text:
                blocks.append(text)
            line.clear()

    stack: list[tuple[Node, Iterator, bool]] = [(node, iter(node.children), False)]
    while stack:
        current, children, only_headings = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            if current.tag in BLOCKS:
                end_block()
        elif isinstance(child, str):
            if not only_headings:
                line.append(child)
        elif not child.dropped:
            if child.tag in BLOCKS:
                end_block()
            limited = child.tag == "header" or (only_headings and child.tag not in HEADINGS)
            stack.append((child, iter(child.children), limited))
    end_block()
    return blocks


def score_containers(root: Node) -> dict[int, tuple[Node, float]]:
    """Paragraph text of each container: whole for the nearest one, less for those around it."""
    scores: dict[int, tuple[Node, float]] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        direct = 0
        for child in node.children:
            if isinstance(child, str):
                direct += len(child.strip())
            elif not child.dropped and child.tag not in CONTAINERS and child.tag in BLOCKS:
                total, linked = child.size
                direct += max(0, total - 2 * linked)
                if child.tag in ("ul", "ol", "table", "tbody", "tr", "figure", "header", "dl"):
                    stack.append(child)
            elif not child.dropped:
                stack.append(child)
        up, share = node.home, 1.0
        while direct and share > 0.2:
            weight = share * (1.5 if up.tag in ("article", "main") else 1.0)
            _, before = scores.get(id(up), (up, 0.0))
            scores[id(up)] = (up, before + weight * direct)
            share *= 0.6
            if up.parent is None:
                break
            up = up.parent.home
    return scores


def votes(html: str | None) -> list[tuple[str, int]]:
    """(generalised path, votes) of the page's best containers; a page has about 1000 votes."""
    root = parse(html or "")
    scores = score_containers(root)
    numbers: dict[tuple[int, str], int] = {}  # paths by that of the parent and the last name, in page order
    named: list[Node] = []
    sums: list[float] = []
    stack = [(root, -1)]
    while stack:
        node, above = stack.pop()
        number = numbers.setdefault((above, node.name), len(sums))
        if number == len(sums):
            named.append(node)
            sums.append(0.0)
        sums[number] += scores.get(id(node), (node, 0.0))[1]
        stack += [(c, number) for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
    best = [(named[i].path(), sums[i]) for i in sorted(range(len(sums)), key=lambda i: (-sums[i], i))[:CANDIDATES]]
    total = sum(score for _, score in best)
    return [(path, int(1000 * score / total)) for path, score in best if score]


def _whole(node: Node) -> Node:
    """The article or main element around a container; without one, as far up as only text is added.

    A step up may add no more letters in links than others. Body is only taken for text outside its other containers.
    """
    node = node.head or node
    total, linked = node.size
    while (up := node.parent) is not None and up.tag != "html" and up.parent is not None:
        all_, links = up.size
        if 2 * (links - linked) > all_ - total:
            break
        if up.tag == "body" or node.tag in ("article", "main"):
            others = (c for c in up.children if isinstance(c, Node) and c is not node and not c.dropped and c.tag in CONTAINERS)
            if any(c.size[0] for c in others):
                break
        node, total, linked = up, all_, links
    return node


def _on_path(root: Node, path: str) -> list[Node]:
    """The outermost containers with this path, in page order."""
    found: list[Node] = []
    stack = [(root, 0)]
    while stack:
        node, at = stack.pop()
        for child in reversed(node.children):
            if isinstance(child, Node) and path.startswith(child.name, at):
                end = at + len(child.name)
                if path.startswith(">", end):
                    stack.append((child, end + 1))
                elif end == len(path) and not child.dropped and child.tag in CONTAINERS:
                    stack.append((child, end))
        if node.parent is not None and at == len(path):
            found.append(node)
    return found


def extract(html: str | None, path: str | None = None) -> str:
    """Text of the containers on the path, whole; of the page's own best container if it has none there."""
    root = parse(html or "")
    found = _on_path(root, path) if path else []
    if any(text_of(node) for node in found):
        whole = {id(node): node for node in map(_whole, found)}
        inner = set()
        for node in whole.values():
            up = node.parent
            while up is not None and id(up) not in whole:
                up = up.parent
            if up is not None:
                inner.add(id(node))
        blocks = [b for key, node in whole.items() if key not in inner for b in text_of(node)]
    else:
        blocks = []
        scored = score_containers(root)
        if scored:
            places, order = {}, [root]
            while order:
                node = order.pop()
                places[id(node)] = len(places)
                order += [c for c in reversed(node.children) if isinstance(c, Node) and not c.dropped]
            best = max(scored.values(), key=lambda x: (x[1], -places[id(x[0])]))[0]
            blocks = text_of(_whole(best))
    return " ".join(blocks)


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums: dict[tuple[str, str | None], int] = {}  # a host's pages are counted under no path
        for name, html in zip(batch.column("host").to_pylist(), batch.column("html"), strict=True):
            for path, n in [*votes(html.as_py()), (None, 1)]:
                sums[name, path] = sums.get((name, path), 0) + n
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k[0] for k in sums], pa.string()),
                pa.array([k[1] for k in sums], pa.string()),
                pa.array(list(sums.values()), pa.int64()),
            ],
            names=["host", "path", "votes"],
        )


def _take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [extract(html.as_py(), path.as_py()) for html, path in zip(batch.column("html"), batch.column("path"), strict=True)]
        counts = pa.array([len(t) for t in texts], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), counts, batch.column("path")],
            names=["page_id", "url", "text", "n_chars", "path"],
        )


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, pages): the container path that each host's pages vote for, and how many pages it has."""
    seen = pages.select(host(F.col("url")).alias("host"), "html")
    sums = (
        seen.mapInArrow(_vote, "host string, path string, votes long").groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    )
    # Most votes, then the smaller path.
    best = F.expr("min_by(path, struct(-votes, path)) FILTER (WHERE path IS NOT NULL)")
    return sums.groupBy("host").agg(best.alias("path"), F.max(F.when(F.col("path").isNull(), F.col("votes"))).alias("pages"))


def extract_pages(
    pages: DataFrame, hot_pages: int = HOT_PAGES, broadcast_rows: int = MAX_BROADCAST_ROWS, broadcast_bytes: int = MAX_BROADCAST_BYTES
) -> DataFrame:
    """page_id, url, text, n_chars, path of every page (page_id, url, html)."""
    pages = pages.select("page_id", "url", "html").withColumn("host", host(F.col("url")))
    winners = stored(pages.sparkSession, host_paths(pages), "host-paths")
    hosts, size = winners.agg(F.count(F.lit(1)), F.sum(F.length("host") + F.coalesce(F.length("path"), F.lit(0)))).first()
    if hosts <= broadcast_rows and (size or 0) <= broadcast_bytes:
        joined = pages.join(F.broadcast(winners.drop("pages")), "host", "left")
    else:
        hot = broadcast_if_small(winners.filter(F.col("pages") > hot_pages).drop("pages"), broadcast_rows)
        cold = winners.filter(F.col("pages") <= hot_pages).drop("pages")
        rest = pages.join(hot.select("host"), "host", "left_anti").join(cold, "host", "left")
        joined = pages.join(hot, "host").unionByName(rest)
    return joined.select("page_id", "url", "html", "path").mapInArrow(
        _take, "page_id long, url string, text string, n_chars long, path string"
    )
