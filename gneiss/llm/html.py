"""HTML: a small forgiving tree builder, visible text by blocks, and main-text extraction by tree scoring."""

from __future__ import annotations

import html
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from gneiss.llm.common import small_batches

# Names from the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# What an opening tag ends when it is still open, and what stops that look.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"), "tfoot": ("tbody", "thead", "tr", "td", "th")}
STOPS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "option": ("select",), **dict.fromkeys(("tr", "td", "th", "tbody", "tfoot"), ("table",))}
#: Elements that are never part of an article's text.
DROPPED = frozenset("head script style noscript template iframe object embed svg canvas math audio video map form button input select textarea label fieldset nav footer aside menu dialog search noembed noframes xmp".split())
#: Words of class, id or role names that mark boilerplate.
BOILERPLATE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox sponsor sponsored promo promotion banner masthead nav navbar navigation menu menubar breadcrumb breadcrumbs sidebar aside rail complementary footer footnav contentinfo header topbar toolbar comment comments commentlist discussion disqus respond reply replies share sharing social follow related recommended recommendations teaser teasers popular trending newsletter subscribe signup login register search cookie cookies consent gdpr notice notices notification alert popup modal overlay dialog paywall widget widgets pagination pager skip tags tagcloud form copyright legal disclaimer".split()
)
#: Elements that keep their place whatever their names say.
FRAMES = frozenset("html body article main".split())

#: Of these, words that also name parts of an article, as in "article-header" or "legal-history".
SUBJECTS = frozenset("header banner masthead promotion navigation menu discussion respond related popular trending follow sharing register search cookies notice notices notification alert overlay copyright legal disclaimer tags form rail aside sponsor".split())
#: Of these, words of readers' remarks, which may well be longer than the article.
REMARKS = frozenset("comment comments commentlist disqus reply replies".split())
#: Words that say nothing about what is inside; with these a boilerplate name stays one.
NEUTRAL = frozenset("area bar block bottom box button buttons center container global icon icons inner item items left link links list outer panel posts reader right section site slot top user wrap wrapper".split())
#: First words of names that tell a state of the page, as in "has-sidebar".
STATES = frozenset("has no with without".split())
#: Elements that are dropped by their tag unless they hold the article or most of the page, as a page-wide form does.
HOLDERS = frozenset(("form", "fieldset"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Elements that are menus if they hold little but links.
MENUS = frozenset("div ul ol table tr td section center p".split())

#: A tag, quotes kept together; its beginning alone.
TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>")
TAG_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
#: A tag whose quotes do not close ends at its first >; after so many on a page quotes are no longer looked at.
MOST_UNCLOSED = 16
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME_PART = re.compile(r"[a-z]+")


class Node:
    __slots__ = ("tag", "parent", "raw", "parts", "score", "fed", "length", "linked")

    def __init__(self, tag: str, parent: Node | None, raw: str = ""):
        self.tag, self.parent, self.raw, self.parts = tag, parent, raw, []
        self.score, self.fed = 0.0, False

    def attributes(self) -> dict[str, str]:
        return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(self.raw)}


def tokens(source: str) -> Iterator[tuple[int, int, str, str, str]]:
    """Tags and things to skip, in order: start, end, slash, name, attributes (name "" for comments and the like).

    One scan: a < that begins nothing is text, and no construct is looked for again once it is known not to follow.
    """
    at, n, unclosed = 0, len(source), 0
    last_close = source.rfind(">")
    last_cdata = source.rfind("]]>")
    while (at := source.find("<", at)) >= 0:
        begins = last_close > at and source[at + 1 : at + 2] not in ("!", "?")
        if begins and unclosed < MOST_UNCLOSED and (m := TAG.match(source, at)):
            end = m.end()
            yield at, end, m[1], m[2], m[3]
        elif begins and (m := TAG_NAME.match(source, at)):
            unclosed += 1
            end = source.find(">", m.end()) + 1 or at + 1
            if end > m.end():
                yield at, end, m[1], m[2], source[m.end() : end - 1]
        elif source.startswith("<!--", at):
            end = source.find("-->", at + 4)
            end = n if end < 0 else end + 3
            yield at, end, "", "", ""
        elif source.startswith("<![CDATA[", at) and last_cdata >= at + 9:
            end = source.find("]]>", at + 9) + 3
            yield at, end, "", "", ""
        elif source.startswith(("!", "?"), at + 1) and last_close > at:
            end = source.find(">", at) + 1
            yield at, end, "", "", ""
        else:
            end = at + 1
        at = end


class Open:
    """The open elements, and where among them those of each name are, so that no walk is needed to find one."""

    def __init__(self, root: Node):
        self.stack = [root]
        self.depths: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def push(self, node: Node) -> None:
        self.depths.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in BLOCK:
            self.blocks.append(len(self.stack))
        self.stack.append(node)

    def cut(self, depth: int) -> None:
        """Close all elements from this depth on."""
        while len(self.stack) > depth:
            node = self.stack.pop()
            self.depths[node.tag].pop()
            if node.tag in BLOCK:
                self.blocks.pop()

    def deepest(self, names: tuple[str, ...] | str) -> int:
        return max((self.depths[t][-1] for t in ((names,) if isinstance(names, str) else names) if self.depths.get(t)), default=0)

    def close(self, tag: str) -> None:
        """A closing tag: of an inline element only within the innermost open block."""
        depth = self.deepest(tag)
        if depth and (tag in BLOCK or not self.blocks or depth > self.blocks[-1]):
            self.cut(depth)

    def implied(self, tag: str) -> None:
        """What an opening tag ends."""
        if tag in BLOCK and self.blocks and self.stack[self.blocks[-1]].tag == "p":
            self.cut(self.blocks[-1])
        if tag in ENDS:
            stop = self.deepest(STOPS[tag])
            found = [d[bisect_right(d, stop)] for t in ENDS[tag] if (d := self.depths.get(t)) and d[-1] > stop]
            if found:
                self.cut(min(found))


def parse(source: str) -> Node:
    """The tree of a page: never fails, closes what is left open, keeps raw text in `parts` as strings. Linear in its length."""
    root = Node("#root", None)
    held, at, n = Open(root), 0, len(source)
    for start, end, slash, name, raw in tokens(source):
        if start < at:  # within the raw text of a script or the like
            continue
        if start > at:
            held.stack[-1].parts.append(source[at:start])
        at = end
        if not name:
            continue
        tag = name.lower()
        if slash:
            held.close(tag)
            continue
        held.implied(tag)
        node = Node(tag, held.stack[-1], raw)
        held.stack[-1].parts.append(node)
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(source, at)
            stop = close.start() if close else n
            node.parts.append(source[at:stop])
            at = source.find(">", stop) + 1 or n
        elif tag not in VOID and (tag in BLOCK or not raw.endswith("/")):  # a stray slash means nothing on blocks
            held.push(node)
    if at < n:
        held.stack[-1].parts.append(source[at:])
    return root


def blocks(top: list[Node | str], skip=frozenset()) -> list[str]:
    """Texts of the blocks in page order: references decoded, white space turned into one space and trimmed, no empty ones."""
    out, run = [], []

    def close() -> None:
        text = " ".join(html.unescape("".join(run)).split())
        run.clear()
        if text:
            out.append(text)

    stack: list = [iter(top)]
    ends: list[bool] = [False]
    while stack:
        for part in stack[-1]:
            if isinstance(part, str):
                run.append(part)
            elif part is None or id(part) in skip or part.tag in ("script", "style", "template", "head"):
                continue
            elif part.tag == "br":
                run.append(" ")
            else:
                block = part.tag in BLOCK
                if block:
                    close()
                stack.append(iter(part.parts))
                ends.append(block)
                break
        else:
            stack.pop()
            if ends.pop():
                close()
    close()
    return out


def is_out(node: Node, a: dict[str, str], in_article: bool) -> bool:
    """Whether an element is dropped whatever it holds: by its tag or because it is hidden."""
    if node.tag in DROPPED - HOLDERS or node.tag == "header" and not in_article:
        return True
    if node.tag in FRAMES or not a:
        return False
    return "hidden" in a or a.get("aria-hidden", "").lower() == "true" or "display:none" in a.get("style", "").replace(" ", "").lower()


def named(a: dict[str, str]) -> tuple[bool, frozenset[str]]:
    """Whether class, id or role surely mark boilerplate, and the words of them that may."""
    sure, found = False, set()
    for name in f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".lower().split():
        words = NAME_PART.findall(name)
        hits = BOILERPLATE.intersection(words)
        if hits and words[0] not in STATES:
            found |= hits
            sure |= not hits <= SUBJECTS and all(w in hits or w in NEUTRAL or len(w) == 1 for w in words)
    return sure, frozenset(found)


def boilerplate(root: Node, strict: bool) -> set[int]:
    """Ids of the topmost elements that are dropped before scoring.

    What holds the longest article is never dropped for its names. Names that surely mark boilerplate, if `strict`, drop
    an element; other ones and forms drop it if it is link-dense, or if it is short (without a heading) or not named
    like a part of an article, and does not hold half of the page's text either.
    """
    skip: set[int] = set()
    order: list[tuple[Node, bool, bool]] = []
    names: dict[int, tuple[bool, frozenset[str]]] = {}
    stack = [(root, False, False)]
    while stack:
        node, inside, under = stack.pop()
        order.append((node, inside, under))
        inside = inside or node.tag in ("article", "main")
        for part in node.parts:
            if isinstance(part, Node):
                a = part.attributes() if part.raw else {}
                if is_out(part, a, inside):
                    skip.add(id(part))
                    continue
                said = named(a) if a else (False, frozenset())
                if said[1] or part.tag in HOLDERS:
                    names[id(part)] = said
                stack.append((part, inside, under or said[0]))
    if not names:
        return skip
    headed: set[int] = set()
    for node, _, _ in reversed(order):  # children before parents
        node.length = node.linked = 0
        for part in node.parts:
            if isinstance(part, str):
                node.length += len(part.strip())
            elif id(part) not in skip:
                node.length += part.length
                node.linked += part.linked
                if id(part) in headed:
                    headed.add(id(node))
        if node.tag == "a":
            node.linked = node.length
        if node.tag in HEADINGS and node.length:
            headed.add(id(node))
    prose = {id(node): node.length - node.linked for node, _, _ in order}
    holds: set[int] = set()
    frames = [(node, under) for node, _, under in order if node.tag in ("article", "main") and prose[id(node)]]
    if any(not under for _, under in frames):
        frames = [(node, under) for node, under in frames if not under]
    for tag in ("article", "main"):
        up = max((node for node, _ in frames if node.tag == tag), key=lambda n: prose[id(n)], default=None)
        while up is not None:
            holds.add(id(up))
            up = up.parent
    total, below = 0, set()
    for node, _, _ in order:  # the page's text without what is surely dropped
        if strict and names.get(id(node), (False,))[0] and id(node) not in holds or node.parent is not None and id(node.parent) in below:
            below.add(id(node))
        else:
            total += sum(len(p.strip()) for p in node.parts if isinstance(p, str))
    for node, inside, _ in order:
        if id(node) not in names or id(node) in holds or node.tag in FRAMES:
            continue
        sure, words = names[id(node)]
        keep = False
        if not (strict and sure) and node.linked <= 0.5 * node.length:
            keep = not words & REMARKS and 2 * prose[id(node)] >= total > 0
            own = node.tag not in HOLDERS and words <= SUBJECTS and not sure
            keep = keep or own and (id(node) in headed or prose[id(node)] >= 80) and (inside or is_compound(node))
        if not keep:
            skip.add(id(node))
    return skip


def is_compound(node: Node) -> bool:
    """Whether some name joins a boilerplate word with one of another kind."""
    a = node.attributes()
    return any(BOILERPLATE.intersection(w) and any(x not in BOILERPLATE and x not in NEUTRAL for x in w) for w in map(NAME_PART.findall, f"{a.get('class', '')} {a.get('id', '')} {a.get('role', '')}".lower().split()))


def beside(part: Node, best_score: float, skip: set[int]) -> bool:
    """Whether an element next to the best container is taken with it, by its own text and links."""
    if part.fed and part.score >= max(10.0, best_score * 0.2):
        return True
    if not part.length or part.linked >= 0.25 * part.length and part.tag not in HEADINGS:
        return False
    if part.tag in HEADINGS or part.tag in ("ul", "ol", "dl", "table", "pre", "blockquote", "figure") or part.length > 80:
        return True
    stack = [part]
    while stack:
        for x in stack.pop().parts:
            if isinstance(x, Node) and id(x) not in skip:
                if x.tag in HEADINGS:
                    return True
                stack.append(x)
    return not part.linked and re.search(r"[.!?。！？](\s|$)", "\n".join(blocks([part], skip))) is not None


def main_text(source: str | None) -> str:
    """The article of a page.

    Boilerplate elements go first, by their tag, or by their names where their content does not speak against it. Each
    paragraph then earns a point, a point per comma and up to three for its length, and passes them to its ancestors: all
    to the parent, half to the grandparent, less further up. A container's points are discounted by the part of its text
    that is links. The best container is taken together with siblings that score a fifth as much or hold text of their
    own and few links: headings, lists, tables, loose text, and blocks that are long, headed or whole sentences; within an
    <article> it is the article. Outside of articles, blocks and lists that are little but links are menus and go too.
    A page of which nothing is left is read again with names counting for less. Null or empty pages give the empty text.
    """
    if not source:
        return ""
    root = parse(source)
    return scored_text(root, boilerplate(root, True)) or scored_text(root := parse(source), boilerplate(root, False))


def scored_text(root: Node, skip: set[int]) -> str:
    """The best container's text of a page without the elements in `skip`."""
    inside_article: set[int] = set()
    order: list[Node] = []
    stack = [(root, False)]
    while stack:
        node, inside = stack.pop()
        order.append(node)
        inside = inside or node.tag in ("article", "main")
        if inside:
            inside_article.add(id(node))
        stack.extend((part, inside) for part in node.parts if isinstance(part, Node) and id(part) not in skip)
    own: dict[int, tuple[int, int, int]] = {}  # of its text outside of blocks: length, commas, characters but spaces at ends
    for node in reversed(order):  # children before parents
        length, linked, holds_block = 0, 0, False
        size, commas, solid = -1, 0, 0
        for part in node.parts:
            if isinstance(part, str):
                text = part.strip()
                length += len(text)
                size, commas, solid = size + len(text) + 1, commas + text.count(",") + text.count("，"), solid + len(text)
            elif id(part) not in skip:
                length += part.length
                linked += part.linked
                if part.tag in BLOCK:
                    holds_block = True
                else:
                    inner = own.get(id(part), (0, 0, 0))
                    size, commas, solid = size + inner[0] + 1, commas + inner[1], solid + inner[2]
        node.length, node.linked = length, length if node.tag == "a" else linked
        if node.tag in MENUS and linked > 0.66 * length and id(node) not in inside_article and sum(p.tag in ("a", "li") or p.linked > 0 for p in node.parts if isinstance(p, Node)) > 1:
            skip.add(id(node))
            node.length = node.linked = 0
        own[id(node)] = max(size, 0), commas, solid
        if node.tag in ("p", "pre", "td", "blockquote") or node.tag in BLOCK and not holds_block and node.tag not in ("h1", "h2", "h3", "h4", "h5", "h6", "li"):
            if not solid:
                continue
            points = 1 + commas + min(size / 100, 3)
            level, up = 0, node.parent
            while up is not None and level < 6:
                up.score += points / (1 if level == 0 else 2 if level == 1 else level * 3)
                up.fed = True
                level, up = level + 1, up.parent
    best, best_score = None, 0.0
    for node in order:
        if node.fed and node.tag in BLOCK:
            node.score = (node.score + {"article": 25, "main": 10, "blockquote": 3, "pre": 3, "td": 3}.get(node.tag, 0)) * (1 - (node.linked / node.length if node.length else 0))
            if node.score > best_score:
                best, best_score = node, node.score
    if best is None:
        best = next((n for t in ("article", "main", "body") for n in order if n.tag == t), root)
    up = best
    while up is not None and up.tag != "article":
        up = up.parent
    best = up or best  # what is left of an article is all its own
    taken: list = [best]
    if best.parent is not None and best.tag not in FRAMES:
        taken, run = [], []

        def close() -> None:
            size = sum(len(p.strip()) if isinstance(p, str) else p.length for p in run)
            if sum(p.linked for p in run if isinstance(p, Node)) < 0.5 * size:
                taken.extend(run)
            run.clear()

        for part in best.parent.parts:
            if isinstance(part, str) or part.tag not in BLOCK:
                if isinstance(part, str) or id(part) not in skip:
                    run.append(part)
                continue
            close()
            if part is best or id(part) not in skip and beside(part, best_score, skip):
                taken.append(part)
        close()
    return "\n".join(blocks(taken, skip))


def _extract(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(x) for x in b.column(2).to_pylist()]
        yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=schema)


def extract_main_text(pages: DataFrame, *, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """One row per row of `pages`: page_id, url, text, n_chars (code points).

    Runs where the page lies, without a shuffle. Null or empty pages give an empty text, null keys and urls stay null,
    repeated rows give repeated rows, other columns are ignored, an empty table gives no rows. Of equally scored containers
    the first is taken. Pages are read in time and memory in proportion to their length, however deep, long or broken.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(pages.sparkSession)
    lean = pages.select(pages[key].alias("page_id"), pages[url].alias("url"), pages[source].cast("string").alias("html"))
    out = lean.select("page_id", "url").schema.add("text", "string").add("n_chars", "long")
    arrow = to_arrow_schema(out)
    return lean.mapInArrow(lambda it: _extract(it, arrow), out)
