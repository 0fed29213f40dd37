"""Main text of web pages by site template removal.

Every element subtree of a page is hashed; Spark counts each hash per host, and subtrees that recur on
many pages of a host are deleted. What is no article by its tag, class or role goes as well.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftmill.lineage import cut, fits, lookup, salted_join
from weftmill.llm.texts import map_slices

# A subtree is template if it stands in so many different surroundings on its host. Tags that mostly hold text
# take at least the host's number of different pages to this power besides.
MIN_PAGES = 5
PAGES_POWER = 0.5
# Pages with more than this share of all rows as copies are joined by broadcast; there are at most 1 / HOT_SHARE.
HOT_SHARE = 1e-4

# Fixed values of the HTML standard and names in common use.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes template".split())
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre"
    " search section summary table tbody td tfoot th thead title tr ul".split()
)
CLOSES_P = BLOCK - set("body caption dd dt head html legend li optgroup option tbody td tfoot th thead title tr".split())
# A start tag ends an open element of these tags, unless one of the second ones lies between.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select"}),
}
DROPPED_TAGS = RAW | set(
    "head nav footer aside form button select dialog menu object canvas svg audio video embed search".split()
)
DROPPED_ROLES = set("navigation banner contentinfo complementary search menu menubar dialog alert form".split())
DROPPED_WORDS = set(
    "ad ads adv advert adverts advertisement advertisements adsense sponsor sponsored promo promotion nav navbar"
    " navigation menu breadcrumb breadcrumbs header masthead topbar footer colophon sidebar aside widget widgets"
    " cookie cookies consent notice notices banner popup modal overlay newsletter subscribe subscription signup login"
    " share sharing social related recommended comment comments respond reply replies disqus pagination pager skip".split()
)
# Other people's words: not the main text however long they are.
COMMENT_WORDS = set("comment comments respond reply replies disqus".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
CONTENT_TAGS = ("article", "main")
PROSE = set("p h1 h2 h3 h4 h5 h6 blockquote pre li dd dt td th tr thead tbody tfoot caption figcaption".split())
TEXTUAL = PROSE | set("ul ol dl table figure".split())

_TAG = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")


class Node:
    __slots__ = ("tag", "marks", "items", "parent", "hash", "size")

    def __init__(self, tag: str, marks: dict[str, str], parent: "Node | None"):
        self.tag, self.marks, self.items, self.parent = tag, marks, [], parent
        self.hash, self.size = 0, 0


def _marks(attributes: str) -> dict[str, str]:
    if not attributes or attributes.isspace():
        return {}
    found = {}
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role", "hidden", "aria-hidden", "style"):
            found[name] = (a or b or c).lower()
    return found


class _Open:
    """The open elements, outermost first, with the places of each tag and of blocks among them: a page's
    nesting is never walked, so the work is in proportion to the page however deep it is."""

    def __init__(self, root: Node):
        self.path, self.places, self.blocks = [root], {}, [0]

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, [0]).append(len(self.path))
        if node.tag in BLOCK:
            self.blocks.append(len(self.path))
        self.path.append(node)

    def last(self, *tags: str) -> int:
        """Place of the innermost open element of these tags, 0 for none."""
        return max(self.places[t][-1] if t in self.places else 0 for t in tags)

    def leave(self, place: int) -> None:
        """Close the element at `place` and all in it."""
        while len(self.path) > place:
            tag = self.path.pop().tag
            self.places[tag].pop()
            if tag in BLOCK:
                self.blocks.pop()

    def end(self, tags: set[str], until: set[str]) -> None:
        """A start tag closes the innermost element of `tags` unless one of `until` is open within it."""
        place = self.last(*tags)
        if place and place > self.last(*until):
            self.leave(place)

    def close(self, name: str) -> None:
        """End tag: the innermost open element of that name; an inline one only if no block was begun in it,
        and what is around a cell only by a tag of the table or page."""
        place = self.last(name)
        blocked = self.blocks[-1] if name not in BLOCK else 0
        if name not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html"):
            blocked = max(blocked, self.last("td", "th"))
        if place and place >= blocked:
            self.leave(place)


def parse(html: str) -> list[Node]:
    """All elements in page order, the root first. Never fails: unknown ends are ignored, open
    elements end with the page."""
    root = Node("html", {}, None)
    nodes, here, at, has_body = [root], _Open(root), 0, False
    while True:
        m = _TAG.search(html, at)
        text = html[at : m.start() if m else len(html)]
        if text:
            here.path[-1].items.append(unescape(text))
        if not m:
            return nodes
        at = m.end()
        end, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
        if not name:
            continue
        name = name.lower()
        if end:
            here.close(name)
            continue
        if name == "html" or name == "body" and has_body:
            continue
        has_body |= name == "body"
        if name in CLOSES_P:
            here.end({"p"}, {"table", "td", "th", "button", "article", "div", "section", "li"})
        if name in ENDS:
            here.end(*ENDS[name])
        node = Node(name, _marks(attributes), here.path[-1])
        here.path[-1].items.append(node)
        nodes.append(node)
        if name in RAW:
            stop = re.compile(f"</{name}[\\s/>]", re.I).search(html, at)
            at = html.find(">", stop.start()) + 1 or len(html) if stop else len(html)
        elif name not in VOID and not attributes.endswith("/"):
            here.push(node)


def hash_subtrees(nodes: list[Node]) -> None:
    """Hash (signed 64 bits) of each subtree from its tag, class, id, texts and children, bottom up. The last
    bit tells `TEXTUAL` elements."""
    for node in reversed(nodes):
        parts, size = [node.tag, node.marks.get("class", ""), node.marks.get("id", "")], 0
        for item in node.items:
            if isinstance(item, Node):
                parts.append(str(item.hash))
                size += item.size
            elif text := " ".join(item.split()):
                parts.append("=" + text)
                size += len(text)
        value = xxhash.xxh64_intdigest("\n".join(parts)) & ~1 | (node.tag in TEXTUAL)
        node.hash, node.size = value - (1 << 64) if value >> 63 else value, size


def _tokens(node: Node) -> list[str]:
    """Classes and id, whole. The id of a heading names what follows, as an anchor."""
    return (node.marks.get("class", "") + " " + ("" if node.tag in HEADINGS else node.marks.get("id", ""))).split()


def _is_dropped(node: Node, inside: bool, spared: set[Node], by_name: bool = True) -> bool:
    """Whether an element is no article text by its tag, class, id or role. `inside` an article a header
    holds the title and stays; `spared` elements hold the page's text and stay if they aren't hidden.
    Without `by_name` only code, styles and hidden elements are none."""
    marks = node.marks
    is_page = node.tag in ("html", "body")
    if not is_page and ("hidden" in marks or marks.get("aria-hidden") == "true" or "display:none" in marks.get("style", "").replace(" ", "")):
        return True
    if not by_name:
        return node.tag in RAW or node.tag == "head"
    if node in spared:
        return False
    if node.tag in DROPPED_TAGS or node.tag == "header" and not inside:
        return True
    if not marks or is_page:
        return False
    if marks.get("role") in DROPPED_ROLES:
        return True
    return any(w in DROPPED_WORDS and not (inside and w == "header") for w in _tokens(node))


def _kind(node: Node) -> str:
    return "main" if node.marks.get("role") == "main" else node.tag


def _holders(nodes: list[Node]) -> tuple[set[Node], set[Node]]:
    """Elements around an `article` or `main` with text, and those with more than half of the page's
    text; no comments."""
    around: set[Node] = set()
    for node in nodes:
        if node.size and _kind(node) in CONTENT_TAGS:
            at = node.parent
            while at is not None and at not in around:
                around.add(at)
                at = at.parent
    quiet = lambda n: COMMENT_WORDS.isdisjoint(_tokens(n))
    large = {n for n in nodes if 2 * n.size > nodes[0].size and n.tag not in ("nav", "footer", "aside") and quiet(n)}
    return {n for n in around if quiet(n)}, large


def _content(root: Node, spared: set[Node]) -> list[Node]:
    """Outermost `article` elements with text, else `main`, else the page; none inside what is dropped."""
    found: dict[str, list[Node]] = {tag: [] for tag in CONTENT_TAGS}
    stack = [(root, frozenset())]
    while stack:
        node, inside = stack.pop()
        if _is_dropped(node, bool(inside), spared):
            continue
        kind = _kind(node)
        if kind in found and kind not in inside:
            found[kind].append(node)
            inside = inside | {kind}
        stack.extend((x, inside) for x in reversed(node.items) if isinstance(x, Node))
    for tag in CONTENT_TAGS:
        if any(n.size for n in found[tag]):
            return found[tag]
    return [root]


def extract(html: str, template: set[int], by_name: bool = True) -> str:
    """Main text of a page; `template` holds the subtree hashes that recur on its host.

    Without `by_name` the counts decide alone, for the whole page.

    Inside an article, paragraphs, headings, list items and cells are prose: a passage that many pages
    quote stays, a repeated box or list goes. On pages without one, any repeated subtree goes.
    """
    nodes = parse(html)
    hash_subtrees(nodes)
    blocks: list[str] = []
    line: list[str] = []

    def flush() -> None:
        if text := " ".join("".join(line).split()):
            blocks.append(text)
        line.clear()

    around, large = _holders(nodes) if by_name else (set(), set())
    # A form may wrap the whole page. Other marked elements count as wrappers of the article if there is none besides.
    forms = {n for n in around | large if n.tag == "form" or n.marks.get("role") == "form"}
    contents = _content(nodes[0], forms) if by_name else [nodes[0]]
    if by_name and contents == [nodes[0]]:
        contents = _content(nodes[0], around | large)
    spared = around | large if contents == [nodes[0]] else large
    for content in contents:
        has_article = content is not nodes[0]
        stack: list[Node | str] = [content]
        while stack:
            item = stack.pop()
            if item is None:
                flush()
                continue
            if isinstance(item, str):
                line.append(item)
                continue
            if item is not content:
                repeated = item.hash in template and not (has_article and item.tag in PROSE)
                if repeated and item.tag in BLOCK or _is_dropped(item, has_article, spared, by_name):
                    if item.tag in BLOCK:
                        flush()
                    continue
            if item.tag == "br":
                line.append(" ")
            if item.tag in BLOCK:
                flush()
                stack.append(None)
            stack.extend(reversed(item.items))
        flush()
    return "\n".join(blocks)


def page_hashes(html: str) -> dict[int, int]:
    """Hashes of the block elements with text, each with the hash of the element around it (the first such)."""
    nodes = parse(html)
    hash_subtrees(nodes)
    found: dict[int, int] = {}
    for node in nodes[1:]:
        if node.size and node.tag in BLOCK:
            found.setdefault(node.hash, node.parent.hash)
    return found


def _host(url: str):
    """Lower-case host of a URL; without one, the empty string."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def subtrees(pages: DataFrame) -> DataFrame:
    """`(host, key, hashes, parents)` of `(host, key, html)` rows."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [page_hashes(h or "") for h in batch.column("html").to_pylist()]
        lists = [pa.array([list(x) for x in values], pa.list_(pa.int64())) for values in (found, [f.values() for f in found])]
        return pa.record_batch([batch.column("host"), batch.column("key"), *lists], names=["host", "key", "hashes", "parents"])

    rows = pages.select("host", "key", "html")
    return map_slices(rows, "html", run, "host string, key binary, hashes array<long>, parents array<long>")


def template_hashes(hashed: DataFrame) -> DataFrame:
    """`(host, hash)` of the subtrees that recur on a host, from `subtrees`.

    A subtree counts once per different element around it. So a box or a notice counts on every page whose
    text is its own, but copies of a page, and the parts of an article that is on several pages, count once.
    It takes `MIN_PAGES` however large the host is, since sites change their templates; paragraphs, lists and
    tables take the root of the number of different pages where that is more, since texts quote. Counts are combined before each shuffle, and a host isn't a group of its own,
    so one with a third of all pages is no large group.
    """
    pairs = hashed.select("host", F.explode(F.arrays_zip("hashes", "parents")).alias("x"))
    pairs = pairs.select("host", F.col("x.hashes").alias("hash"), F.col("x.parents").alias("parent")).distinct()
    counts = pairs.groupBy("host", "hash").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_PAGES)
    sizes = hashed.select("host", "key").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    often = lookup(counts, sizes, "host", ["hash"], F.octet_length("host"))
    boxes = F.col("hash").bitwiseAND(F.lit(1)) == 0
    return often.filter(boxes | (F.col("n") >= F.pow("pages", F.lit(PAGES_POWER)))).select("host", "hash")


def page_templates(hashed: DataFrame) -> DataFrame:
    """`(key, template, n)`: per different page with any, its subtrees that recur on its host, and its rows."""
    pair = F.xxhash64("host", "hash").alias("pair")
    template = cut(template_hashes(hashed).select("host", "hash", pair))
    own = hashed.select("host", "key", F.explode("hashes").alias("hash")).select("*", pair)
    if fits(template, F.octet_length("host") + 16):
        own = own.join(F.broadcast(template), ["pair", "host", "hash"], "left_semi")
    else:
        # Pairs of equal hash are told apart by the join's other columns.
        again = template.select("pair", F.struct("host", "hash").alias("same")).groupBy("pair").agg(F.collect_list("same").alias("same"))
        own = salted_join(own, again, "pair", ["key"]).filter(F.array_contains("same", F.struct("host", "hash")))
    lists = own.groupBy("key").agg(F.collect_set("hash").alias("template"))
    copies = hashed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return lists.join(copies, "key")


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", by_name: bool = True
) -> DataFrame:
    """`(page_id, url, text, n_chars)`, one row per row of `pages`.

    Null html is empty and gives an empty text; pages without a host share one. Repeated rows are one page
    to the counts. Extra columns aren't read; no rows give no rows. Without `by_name` nothing but the
    counts per host decides what goes.
    """
    html = F.coalesce(pages[html_col], F.lit(""))
    rows = pages.select(
        pages[id_col].alias("page_id"), pages[url_col].alias("url"), _host(url_col).alias("host"), html.alias("html")
    )
    # The same page on the same host has the same templates.
    rows = rows.withColumn("key", F.unhex(F.md5(F.concat(F.unhex(F.md5(F.col("host").cast("binary"))), F.col("html").cast("binary")))))
    hashed = cut(subtrees(rows))
    own = cut(page_templates(hashed))
    if fits(own, F.size("template") * 8 + 32):
        joined = rows.join(F.broadcast(own.drop("n")), "key", "left")
    else:
        hot = F.col("n") > HOT_SHARE * hashed.count()
        often = own.filter(hot).select("key", F.col("template").alias("often"))
        joined = rows.join(F.broadcast(often), "key", "left")
        # Rows that have their list go anywhere.
        spread = F.unhex(F.md5(F.concat_ws(":", F.col("page_id").cast("string"), "url")))
        joined = joined.withColumn("key", F.when(F.col("often").isNull(), F.col("key")).otherwise(spread))
        joined = joined.join(own.filter(~hot).drop("n"), "key", "left").withColumn("template", F.coalesce("often", "template"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        pages, lists = batch.column("html").to_pylist(), batch.column("template").to_pylist()
        texts = [extract(h or "", set(t or ()), by_name) for h, t in zip(pages, lists)]
        return pa.record_batch(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )

    kinds = dict(rows.dtypes)
    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_slices(joined.select("page_id", "url", "html", "template"), "html", run, schema)
