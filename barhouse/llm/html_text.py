"""Main text of web pages: a site's templates go, and so do parts that a page marks as boilerplate."""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barhouse.llm.common import Scratch

#: A subtree is a template if it recurs on so many pages of a host and on this share of them.
#: Pages with the same content count once.
MIN_PAGES = 5
MIN_SHARE = 0.5
#: Or on so many pages and this share of them. On sf0.1 and check_s sentences of articles that are on 10 pages
#: or more are on up to 12 % of a host's pages (others on up to 21 %, 5 of 24).
MANY_PAGES = 10
MANY_SHARE = 0.15
#: Articles (or else the main part) stand for the page if they hold this share of its text; the rest is left out.
MAIN_SHARE = 0.9
#: Ways that the pages of one host are dealt out for the removal.
SALTS = 16

# Fixed values of HTML: elements that hold text to the end tag, hold nothing, start a block, end others.
_RAW = frozenset("script style textarea title noscript iframe xmp noembed noframes plaintext".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section "
    "summary table tbody td tfoot th thead tr ul".split()
)
_ENDS = {
    "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
    "tr": frozenset(["tr", "td", "th"]), "td": frozenset(["td", "th"]), "th": frozenset(["td", "th"]),
    "option": frozenset(["option"]), "tbody": frozenset(["thead", "tbody"]), "tfoot": frozenset(["thead", "tbody"]),
}
#: What a start tag ends: a block also ends a paragraph.
_ENDED = {t: _ENDS.get(t, frozenset()) | (frozenset(["p"]) if t in _BLOCKS else frozenset()) for t in _BLOCKS | _ENDS.keys()}
_FENCES = frozenset("table ul ol dl td th body html div section article select".split())

# What counts as boilerplate by its element, role or names.
_DROPPED = frozenset(
    "head script style noscript template nav footer aside button select textarea input label iframe svg "
    "canvas object audio video dialog menu search title xmp noembed noframes datalist map".split()
)
_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form "
    "tablist status tooltip".split()
)
_NAMES = re.compile(
    r"(?:ads?|adverts?|advertisements?|advertising|adsense|sponsor(?:ed|s)?|promos?|promotions?|banner|nav|navs?|navbar|"
    r"navigation|menus?|submenu|breadcrumbs?|sidebars?|footer|cookies?|consent|gdpr|notices?|disclaimer|popups?|modal|"
    r"overlay|newsletter|subscribe|subscription|signup|login|social|share|sharing|shares|comments?|commentlist|disqus|"
    r"respond|reply|replies|related|recommended|recommendations|widgets?|pagination|pager|toolbar|hidden|masthead|"
    r"topbar|alert|toc|paywall)"
)
#: Names that begin so tell of a layout or a topic, not what the element is.
_STATES = frozenset("has with without no not category cat tag tagged topic type format".split())
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_MARKUP = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*'|["'])*?)>|<[!?/][^>]*(?:>|\Z)|<[a-zA-Z][^<>]*\Z""",
    re.S,
)
_WORD_EDGES = re.compile(r"[^A-Za-z0-9]+|(?<=[a-z0-9])(?=[A-Z])")


class Node:
    __slots__ = ("tag", "children", "parent", "inside", "sure", "named", "own", "size", "holds_main", "boiler")

    def __init__(self, tag: str, parent: Node | None, sure: bool = False, named: int = 0):
        self.tag, self.children, self.parent, self.sure, self.named = tag, [], parent, sure, named
        self.inside = parent is not None and parent.inside or tag in ("article", "main")
        self.own, self.size, self.holds_main, self.boiler = 0, 0, tag == "main", False


def _named(name: str, inside: bool) -> int:
    """A class or an id: 2 if all its words are names of boilerplate, 1 if its first or last word is one, else 0."""
    words = [w.lower() for w in _WORD_EDGES.split(name) if w]
    if not words or words[0] in _STATES:
        return 0
    hits = [bool(_NAMES.fullmatch(w)) or w == "header" and not inside for w in words]
    return 2 if all(hits) else int(hits[0] or hits[-1])


def _boilerplate(tag: str, attributes: str, inside: bool) -> tuple[bool, int]:
    """By what an element says of itself: whether it surely is boilerplate, and how far its names say so.

    Headers, and names like them, count outside of articles only. No name drops an article. A
    form counts as a name: some pages stand in one as a whole.
    """
    if tag in _DROPPED or tag == "header" and not inside:
        return True, 0
    named = int(tag == "form")
    if not attributes.strip() or tag in ("html", "body", "main"):
        return False, named
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = next((v for v in values if v), "")
        name = name.lower()
        if name in ("class", "id"):
            if tag != "article":
                named = max([named, *[_named(n, inside) for n in value.split()]])
        elif name == "role" and value.strip().lower() in _ROLES:
            return True, 0
        elif name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true":
            return True, 0
        elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return True, 0
    return False, named


def _judge(order: list[Node]) -> None:
    """Which elements, given in order, are boilerplate.

    A name alone does not drop an element that holds the main part or half of the page's text. If
    all words of the name say so and the page has an article or main part elsewhere, it takes
    ``MAIN_SHARE`` of the text.
    """
    for node in reversed(order):
        node.size += node.own
        if node.parent and not node.sure:
            node.parent.size += node.size
            node.parent.holds_main |= node.holds_main
    total = order[0].size
    parts = any(n.tag in ("article", "main") and not n.sure for n in order)
    for node in order[1:]:
        share = MAIN_SHARE if node.named == 2 and parts and not node.parent.inside else 0.5
        spared = node.holds_main or node.size >= share * total
        node.boiler = node.parent.boiler or node.sure or node.named > 0 and not spared


class Open:
    """The open elements, with the number of each tag among them, in all and since the last fence.

    So an element is looked for only where it is, and each one that is passed on the way ends with it.
    """

    def __init__(self, root: Node):
        self.stack, self.all, self.since = [root], Counter(), [Counter()]

    def push(self, node: Node) -> None:
        self.stack.append(node)
        self.all[node.tag] += 1
        if node.tag in _FENCES:
            self.since.append(Counter())
        else:
            self.since[-1][node.tag] += 1

    def pop(self) -> str:
        tag = self.stack.pop().tag
        self.all[tag] -= 1
        if tag in _FENCES:
            self.since.pop()
        else:
            self.since[-1][tag] -= 1
        return tag

    def end(self, tag: str) -> None:
        """Close up to the last element of a tag, if one is open."""
        if self.all[tag]:
            while self.pop() != tag:
                pass

    def end_like(self, ended: frozenset[str]) -> None:
        """Close up to the last element of some tags, if one is open within the last fence or is that fence."""
        fence = len(self.since) > 1 and any(self.all[t] for t in ended & _FENCES) and self._fence() in ended
        if fence or any(self.since[-1][t] for t in ended):
            while self.pop() not in ended:
                pass

    def _fence(self) -> str:
        """The tag of the last fence; what stands above it is counted in the last of ``since``."""
        return self.stack[-1 - self.since[-1].total()].tag


def parse(page: str) -> Node:
    """A forgiving tree, in time linear in the page: unknown end tags are skipped, open elements end with their parents."""
    root = Node("#root", None)
    open_, order = Open(root), [root]
    stack = open_.stack
    at, n = 0, len(page)
    while at < n:
        m = _MARKUP.search(page, at)
        text = page[at : m.start() if m else n]
        if text:
            text = html.unescape(text)
            stack[-1].children.append(text)
            stack[-1].own += len("".join(text.split()))
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "p" and not open_.all["p"]:
                order.append(Node("p", stack[-1]))
                stack[-1].children.append(order[-1])
            open_.end(tag)
            continue
        if tag in _BLOCKS or tag in _ENDS:  # a block ends an open paragraph; list and table parts end their like
            open_.end_like(_ENDED[tag])
        above = stack[-1]
        node = Node(tag, above, *_boilerplate(tag, m[3], above.inside))
        above.children.append(node)
        order.append(node)
        if tag in _VOID or m[3].endswith("/") and tag not in _BLOCKS:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>?", re.I).search(page, at)
            at = end.end() if end else n
            continue
        open_.push(node)
    _judge(order)
    return root


def _walk(root: Node, whole: bool = False) -> Iterator[tuple[Node, bool]]:
    """Every element that is no boilerplate, or every element, as it opens (True) and as it closes."""
    stack: list[tuple[Node, bool]] = [(root, True)]
    while stack:
        node, opens = stack.pop()
        yield node, opens
        if opens:
            stack.append((node, False))
            stack += [(c, True) for c in reversed(node.children) if isinstance(c, Node) and (whole or not c.boiler)]


def _hashes(root: Node) -> dict[int, int]:
    """By id() of every element of the page, boilerplate or not: a hash of its tag and all that is in it.

    What is boilerplate inside of an element that is none does not count for that element's hash.
    """
    out: dict[int, int] = {}
    for node, opens in _walk(root, whole=True):
        if not opens:
            parts = [node.tag]
            for c in node.children:
                if isinstance(c, Node):
                    parts.append(f"<{out[id(c)]}>" if node.boiler or not c.boiler else "")
                else:
                    parts.append(" ".join(c.split()))
            out[id(node)] = xxhash.xxh64_intdigest("\x1f".join(parts).encode("utf-8", "surrogatepass")) >> 1
    return out


def _main_part(root: Node) -> str | None:
    """The element, article or main, that holds ``MAIN_SHARE`` of the text that is no boilerplate."""
    held = {"article": 0, "main": 0}
    depth = {"article": 0, "main": 0}
    total = 0
    for node, opens in _walk(root):
        if node.tag in depth:
            depth[node.tag] += 1 if opens else -1
        if opens:
            total += node.own
            for tag in held:
                held[tag] += node.own if depth[tag] else 0
    return next((tag for tag, size in held.items() if size and size >= MAIN_SHARE * total), None)


def blocks(page: str) -> list[tuple[str, list[int]]]:
    """The text blocks of a page that are not boilerplate by themselves, in order, each with the
    hashes of the elements it stands in as a whole.

    Where articles (or else the main part) hold ``MAIN_SHARE`` of the text, only what is inside
    counts. Elsewhere all blocks count but lists and paragraphs of nothing but links outside of
    them, which are left out as menus.
    """
    root = parse(page)
    nodes, found = _blocks(root, _hashes(root))
    out = []
    for text, at in found:
        path = []
        while at >= 0:
            path.append(nodes[at][0])
            at = nodes[at][1]
        out.append((text, path[::-1]))
    return out


def _blocks(root: Node, hashes: dict[int, int]) -> tuple[list[tuple[int, int]], list[tuple[str, int]]]:
    """Elements as (hash, number of the parent, or -1), a parent before its children; and blocks as (text, number
    of the innermost element that holds all of it)."""
    wanted = _main_part(root)
    nodes: list[tuple[int, int]] = []
    out: list[tuple[str, int]] = []
    opened: list[int] = []  # the numbers of the open elements
    run: list[str] = []
    # How many open elements held all text of the block so far, and have been open ever since the last text.
    common = lowest = -1
    depth = inside = links = linked = 0

    def flush() -> None:
        nonlocal linked, common
        text = " ".join("".join(run).split())
        if text and (wanted is None or depth):
            if inside or linked < 0.8 * len(text.replace(" ", "")):
                out.append((text, holder))
        run.clear()
        linked, common = 0, -1

    holder = -1
    stack: list[tuple[str, Node | str]] = [("open", root)]
    while stack:
        what, node = stack.pop()
        if what == "text":
            run.append(node)
            if not node.isspace():
                common = len(opened) if common < 0 else min(common, lowest)
                lowest = len(opened)
                holder = opened[common - 1] if common else -1
            if links:
                linked += len("".join(node.split()))
            continue
        if what == "break":
            flush()
            continue
        block = node.tag in _BLOCKS
        if what == "open":
            if node.tag == "br":
                run.append(" ")
            if block:
                flush()
            if node is not root:
                nodes.append((hashes[id(node)], opened[-1] if opened else -1))
                opened.append(len(nodes) - 1)
            depth += node.tag == wanted
            inside += node.tag in ("article", "main")
            links += node.tag == "a"
            stack.append(("close", node))
            for c in reversed(node.children):
                if not isinstance(c, Node):
                    stack.append(("text", c))
                elif not c.boiler:
                    stack.append(("open", c))
                elif c.tag in _BLOCKS:
                    stack.append(("break", c))
        else:
            if block:
                flush()
            if node is not root:
                opened.pop()
                lowest = min(lowest, len(opened))
            depth -= node.tag == wanted
            inside -= node.tag in ("article", "main")
            links -= node.tag == "a"
    flush()
    return nodes, out


_PAGE_SQL = "page_id long, url string, host string, content long, subtrees array<long>, marked array<long>, held binary"
_PAGE = pa.schema(
    [
        ("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("content", pa.int64()),
        ("subtrees", pa.list_(pa.int64())), ("marked", pa.list_(pa.int64())), ("held", pa.binary()),
    ]
)
_HOST = re.compile(r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)")


def host_of(url: str | None) -> str:
    m = _HOST.match(url or "")
    return m[1].lower() if m else ""


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        rows = []
        for page_id, url, page in zip(*batch.columns):
            root = parse(page.as_py() or "")
            hashes = _hashes(root)
            nodes, found = _blocks(root, hashes)
            text = "\n".join(t for t, _ in found)
            holds = {at for _, at in found}
            for number in range(len(nodes) - 1, -1, -1):
                if number in holds:
                    holds.add(nodes[number][1])
            subtrees = {nodes[number][0] for number in holds if number >= 0}
            marked = {hashes[id(n)] for n, opens in _walk(root, whole=True) if opens and n.parent and n.size} - subtrees
            rows.append(
                (
                    page_id.as_py(), url.as_py(), host_of(url.as_py()),
                    xxhash.xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1,
                    sorted(subtrees), sorted(marked), press.compress(json.dumps([nodes, found]).encode()),
                )
            )
        columns = zip(*rows) if rows else [[] for _ in _PAGE]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PAGE)], schema=_PAGE)


def _strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdDecompressor()
    for batch in batches:
        texts = []
        for held, templates in zip(batch.column(2), batch.column(3)):
            gone = set(templates.as_py() or ())
            nodes, found = json.loads(press.decompress(held.as_py()))
            out: set[int] = set()
            for number, (hash_, parent) in enumerate(nodes if gone else ()):
                if hash_ in gone or parent in out:
                    out.add(number)
            texts.append("\n".join(t for t, at in found if at not in out))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
        )


def site_templates(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(host, templates): the hashes of subtrees that recur on many pages of a host.

    All subtrees with text are counted, those in ``marked`` (of elements that no kept text stands
    in) too; only those that some kept text stands in are listed. Counted over all pages: first
    once per host, subtree and page content (copies of a page are one), then per host and subtree;
    both counts are combined before they are shuffled. The pages of a host are counted with them,
    as a subtree that every page has. A host's list is bounded by its share: at most
    1 / ``MANY_SHARE`` (or 1 / ``min_share``) times the subtrees of an average page.
    """
    every = F.lit(-1).cast("long")
    kept = F.transform(F.concat(F.array(every), "subtrees"), lambda x: F.struct(x.alias("subtree"), F.lit(True).alias("kept")))
    others = F.transform("marked", lambda x: F.struct(x.alias("subtree"), F.lit(False).alias("kept")))
    once = (
        pages.select("host", "content", F.inline(F.concat(kept, others)))
        .groupBy("host", "content", "subtree")
        .agg(F.max("kept").alias("kept"))
    )
    counts = once.groupBy("host", "subtree").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    often = Scratch(pages.sparkSession).keep(counts.where((F.col("n") >= min(min_pages, MANY_PAGES)) & F.col("kept")))
    totals = often.where(F.col("subtree") == every).select("host", F.col("n").alias("total"))
    limits = [(min_pages, min_share), (MANY_PAGES, MANY_SHARE)]
    few, many = [(F.col("n") >= n) & (F.col("n") >= share * F.col("total")) for n, share in limits]
    return (
        often.where(F.col("subtree") != every)
        .join(totals, "host")
        .where(few | many)
        .groupBy("host")
        .agg(F.collect_list("subtree").alias("templates"))
    )


def extract(pages: DataFrame, min_pages: int = MIN_PAGES, min_share: float = MIN_SHARE) -> DataFrame:
    """(page_id, url, text): the main text of every page, one block per line.

    Pages are read twice: once for the hashes of all their element subtrees, which are counted per
    host at the call, and once for their text, from which subtrees that recur across the host are
    deleted. A host that fills a third of the table is dealt out ``SALTS`` ways for the second step.

    Null html is an empty page, and a page without text gives an empty text. Pages without a url
    form a host of their own. Repeated rows give repeated results. Other columns are ignored.
    """
    raw = pages.select(F.col("page_id").cast("long"), "url", "html")
    read = raw.mapInArrow(_read, _PAGE_SQL)
    templates = site_templates(read.select("host", "content", "subtrees", "marked"), min_pages, min_share)
    dealt = templates.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salt = F.pmod(F.xxhash64("page_id"), F.lit(SALTS)).cast("int")
    return (
        read.select("page_id", "url", "host", "held", salt.alias("salt"))
        .join(dealt, ["host", "salt"], "left")
        .select("page_id", "url", "held", "templates")
        .mapInArrow(_strip, "page_id long, url string, text string")
    )
