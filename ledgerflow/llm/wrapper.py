"""Main text of web pages by wrapper induction.

A page is parsed into a tree of block elements; runs of equal siblings count
as one slot. The skeletons of a host's pages are aligned with the host's most
frequent one by simple tree matching, so that blocks of different pages meet
in the same slot. A block whose text stands in the same slot on at least half
of the host's different pages is template; what varies is content. Elements
that are menus, forms, notices and the like by tag, role or class are left
out on every page.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stage

#: A block is template on a host from so many different pages and this share of them on.
TEMPLATE_PAGES = 5
TEMPLATE_SHARE = 0.5
#: Elements nested deeper are read as if they were siblings; left-out ones stay left out, the first article or main stays one.
DEPTH = 200

# Element names of HTML by what they mean here.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math canvas object audio video".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html head body main article section nav header footer aside form fieldset div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "pre blockquote figure figcaption address details summary center menu dialog hgroup search button select option label".split()
)
DROPPED = frozenset("head nav footer aside form button select option menu dialog search label fieldset".split())
CLOSES_P = BLOCK - frozenset("html head body button label option select".split()) | {"hr"}
CLOSED_BY = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
CLOSED_BY = {k: (frozenset(a.split()), frozenset(b.split())) for k, (a, b) in CLOSED_BY.items()}
#: Words in class, id or role that mark what is not the article.
MARKS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored sponsors promo promotion banner nav navbar navigation menu breadcrumb breadcrumbs sidebar "
    "footer masthead topbar contentinfo complementary cookie cookies consent gdpr notice notices alert popup modal overlay dialog newsletter subscribe subscription signup "
    "login share sharing social related recommended recommendations comment comments disqus respond replies reply pagination pager widget widgets toolbar search skip".split()
)
HEADER_MARKS = frozenset("header banner masthead".split())

_TAG = re.compile(
    r"<!--.*?-->|<!--.*|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*)(?P<attrs2>[^>]*)>|<[/!?a-zA-Z][^>]*\Z",
    re.S,
)
_MARKED_ATTR = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_RAW_END = {t: re.compile(rf"</{t}(?=[\s/>])[^>]*>", re.I) for t in RAW}


class Node:
    """A block element, or one that is left out; ``content`` holds strings, child nodes and None for a line break."""

    __slots__ = ("tag", "name", "content", "drop", "marked", "slot", "up")

    def __init__(self, tag: str, name: str, drop: bool, up: Node | None):
        self.tag, self.name, self.drop, self.up = tag, name, drop, up
        self.content: list = []
        self.marked = False
        self.slot = -1


def _marks(attrs: str) -> tuple[str, frozenset[str]]:
    """(first class, words of class, id and role)."""
    first, words = "", set()
    for m in _MARKED_ATTR.finditer(attrs):
        value = m[2] or m[3] or m[4] or ""
        if m[1].lower() == "class" and not first:
            first = (value.split() or [""])[0]
        words.update(w.lower() for w in _PARTS.findall(value))
    return first, frozenset(words)


def parse(html: str) -> Node:
    """The tree of block elements; tags that are not closed, crossed or cut off at the end are put up with."""
    root = Node("#root", "#root", False, None)
    stack: list[tuple[str, Node | None]] = []
    node, at, met = root, 0, False

    def pop_to(k: int) -> None:
        nonlocal node
        for _, n in stack[k:]:
            if n is not None:
                node = n.up
                break
        del stack[k:]

    pos = 0
    while m := _TAG.search(html, pos):
        if m.start() > at:
            node.content.append(html[at : m.start()])
        at = pos = m.end()
        tag = m["tag"] or m["tag2"]
        if not tag:
            continue
        tag = tag.lower()
        if m["end"] or m["end2"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    pop_to(k)
                    break
            if tag in BLOCK:
                node.content.append(None)
            continue
        if tag in RAW:
            end = _RAW_END[tag].search(html, at)
            at = pos = end.end() if end else len(html)
            continue
        if tag in CLOSES_P:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == "p":
                    pop_to(k)
                    break
                if stack[k][0] in BLOCK:
                    break
        if tag in CLOSED_BY:
            same, stop = CLOSED_BY[tag]
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] in stop:
                    break
                if stack[k][0] in same:
                    pop_to(k)
                    if stack and stack[-1][0] in same:
                        continue
                    break
        if tag in VOID:
            node.content.append(None if tag == "hr" else " " if tag == "br" else "")
            continue
        attrs = m["attrs"] or m["attrs2"] or ""
        first, words = _marks(attrs) if "=" in attrs else ("", frozenset())
        drop = tag in DROPPED or bool(words & MARKS) or bool(attrs and _HIDDEN.search(attrs))
        if tag == "header" or words & HEADER_MARKS:
            drop = not any(t in ("article", "main") for t, _ in stack) and not (tag in ("article", "main", "body", "html"))
        if tag in ("article", "main", "body", "html") and not words & frozenset(("comment", "comments", "reply", "replies", "related", "ad", "ads", "promo")):
            drop = False
        outermost = tag in ("article", "main") and not any(t in ("article", "main") for t, n in stack if n is not None)
        if (tag in BLOCK or drop) and (len(stack) < DEPTH or outermost or (drop and not node.drop)):
            child = Node(tag, f"{tag}.{first}" if first else tag, drop, node)
            child.marked = drop and tag not in DROPPED
            if tag in ("article", "main") and not drop and not met:
                # a page's first article is not part of what a class around it names ("with-sidebar")
                up = node
                while up is not None:
                    up.drop, up = up.drop and not up.marked, up.up
                met = True
            node.content.append(child)
            stack.append((tag, child))
            node = child
        else:
            if tag in BLOCK:
                node.content.append(None)
            stack.append((tag, None))
    if at < len(html):
        node.content.append(html[at:])
    return root


def children(node: Node) -> list[Node]:
    return [c for c in node.content if isinstance(c, Node)]


def skeleton(root: Node) -> str:
    """Names of the tree, runs of equal names as one; sets every node's slot, its run's place in preorder."""
    out: list[str] = []
    count = 0

    def visit(nodes: list[Node]) -> None:
        nonlocal count
        i = 0
        while i < len(nodes):
            j = i
            while j < len(nodes) and nodes[j].name == nodes[i].name:
                nodes[j].slot = count
                j += 1
            count += 1
            out.append(re.sub(r"[(),]", "", nodes[i].name) or "-")
            inner = [c for n in nodes[i:j] for c in children(n)]
            if inner:
                out.append("(")
                visit(inner)
                out.append(")")
            out.append(",")
            i = j

    visit(children(root))
    return "".join(out)


Tree = tuple[str, int, list]


def tree_of(skeleton: str) -> Tree:
    """(name, slot, children) from a skeleton; the slots are numbered as ``skeleton`` does."""
    root: Tree = ("#root", -1, [])
    stack, count = [root], 0
    for m in re.finditer(r"[^(),]+|[()]", skeleton):
        if m[0] == "(":
            stack.append(stack[-1][2][-1])
        elif m[0] == ")":
            stack.pop()
        else:
            stack[-1][2].append((m[0], count, []))
            count += 1
    return root


def simple_tree_matching(a: Tree, b: Tree) -> tuple[int, list[tuple[int, int]]]:
    """Size of the largest order- and level-keeping match of two trees, and its pairs of slots (Yang's algorithm)."""
    if a[0] != b[0]:
        return 0, []
    m, n = len(a[2]), len(b[2])
    best = [[0] * (n + 1) for _ in range(m + 1)]
    found: dict[tuple[int, int], tuple[int, list]] = {}
    for i in range(m):
        row, above = best[i + 1], best[i]
        for j in range(n):
            w = above[j]
            if a[2][i][0] == b[2][j][0]:
                found[i, j] = simple_tree_matching(a[2][i], b[2][j])
                w += found[i, j][0]
            row[j + 1] = max(row[j], above[j + 1], w)
    pairs = [(a[1], b[1])]
    i, j = m, n
    while i and j:
        if best[i][j] == best[i - 1][j]:
            i -= 1
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            pairs += found[i - 1, j - 1][1]
            i, j = i - 1, j - 1
    return best[m][n] + 1, pairs


def aligned(skeleton: str, reference: str) -> list[int]:
    """For each slot of ``skeleton`` the slot of ``reference`` it matches, or -1."""
    tree = tree_of(skeleton)
    out = [-1] * len(re.findall(r"[^(),]+", skeleton))
    for x, y in simple_tree_matching(tree, tree_of(reference))[1]:
        if x >= 0:
            out[x] = y
    return out


def blocks(root: Node) -> list[tuple[Node, str]]:
    """Texts in page order: (block element, its text with references decoded and white space as one blank); left-out elements have none."""
    out: list[tuple[Node, str]] = []
    parts: list[str] = []
    owner = root

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append((owner, text))

    work: list = [(root, iter(root.content))]
    while work:
        node, rest = work[-1]
        for c in rest:
            if c is None:
                close()
            elif isinstance(c, str):
                owner = node
                parts.append(html_lib.unescape(c) if "&" in c else c)
            elif not c.drop:
                close()
                work.append((c, iter(c.content)))
                break
            elif c.tag in BLOCK:
                close()
        else:
            close()
            work.pop()
    return out


def _article(found: list[tuple[Node, str]]) -> list[tuple[Node, str]]:
    """The blocks inside main elements, or else inside articles, in page order; all if there is neither."""
    inside: dict[str, list] = {"main": [], "article": []}
    for node, text in found:
        around, up = set(), node
        while up is not None:
            around.add(up.tag)
            up = up.up
        for tag in around & inside.keys():
            inside[tag].append((node, text))
    return inside["main"] or inside["article"] or found


def text_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def main_text(html: str, reference: str | None = None, template: set[tuple[int, int]] | None = None) -> str:
    """The article's text; blocks in ``template`` (slot of ``reference``, text hash) are left out."""
    root = parse(html)
    found = _article(blocks(root))
    if template and reference:
        slots = aligned(skeleton(root), reference)
        found = [(n, t) for n, t in found if n.slot < 0 or (slots[n.slot], text_hash(t)) not in template]
    return " ".join(t for _, t in found)


def host(url: str = "url"):
    """The lower-cased host of an address column, empty if it has none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1), F.lit(""))


def _page_blocks(pages: DataFrame) -> DataFrame:
    """(host, skeleton, page, slots, hashes) per page with a host; page: hash of all its texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"host": [], "skeleton": [], "page": [], "slots": [], "hashes": []}
            for name, html in zip(batch.column(0), batch.column(1), strict=True):
                root = parse(html.as_py() or "")
                rows["skeleton"].append(skeleton(root))
                found = blocks(root)
                hashes = [text_hash(t) for _, t in found]
                rows["host"].append(name.as_py())
                rows["page"].append(text_hash(",".join(map(str, hashes))))
                rows["slots"].append([n.slot for n, _ in found])
                rows["hashes"].append(hashes)
            types = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), types, strict=True)], names=list(rows))

    return pages.select(host().alias("host"), "html").filter("host != ''").mapInArrow(run, "host string, skeleton string, page bigint, slots array<int>, hashes array<bigint>")


def induce(pages: DataFrame, template_pages: int = TEMPLATE_PAGES, share: float = TEMPLATE_SHARE) -> DataFrame:
    """One wrapper per host with a template: (host, reference, slots, hashes), from all its different pages.

    Copies of a page count once, so a page that was crawled often does not
    make its article template.
    """
    seen = stage(_page_blocks(pages).dropDuplicates(["host", "page"]), "wrapper-blocks")
    shapes = seen.groupBy("host", "skeleton").agg(F.count("*").alias("n"))
    hosts = shapes.groupBy("host").agg(F.sum("n").alias("pages"), F.max(F.struct("n", "skeleton"))["skeleton"].alias("reference")).filter(F.col("pages") >= template_pages)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            host, shape, reference = (batch.column(i).to_pylist() for i in range(3))
            slots = [aligned(s, r) for s, r in zip(shape, reference, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(host, pa.string()), pa.array(shape, pa.string()), pa.array(slots, pa.list_(pa.int32()))], names=["host", "skeleton", "to"])

    fits = shapes.join(hosts, "host").select("host", "skeleton", "reference").mapInArrow(align, "host string, skeleton string, to array<int>")
    texts = (
        seen.select("host", "skeleton", F.explode(F.array_distinct(F.arrays_zip("slots", "hashes"))).alias("b"))
        .groupBy("host", "skeleton", "b.slots", "b.hashes")
        .agg(F.count("*").alias("n"))
        .filter("slots >= 0")
        .join(fits, ["host", "skeleton"])
        .select("host", F.get("to", F.col("slots")).alias("slot"), F.col("hashes").alias("hash"), "n")
        .groupBy("host", "slot", "hash")
        .agg(F.sum("n").alias("n"))
        .filter((F.col("slot") >= 0) & (F.col("n") >= template_pages))
    )
    constant = texts.join(hosts, "host").filter(F.col("n") >= share * F.col("pages"))
    return constant.groupBy("host", "reference").agg(F.collect_list(F.struct("slot", "hash")).alias("template"))  # at most two texts a slot and place


def extract(pages: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, url, text, n_chars.

    Needs page_id, url and html; other columns are ignored. A null or empty
    html has the empty text. Where a page has main elements the text is what they
    hold, else what its articles hold, all of them. A null or broken url
    has no host, its page is read by the rules alone. Pages are read whole;
    tags that are not closed or cut off are put up with.
    """
    wrappers = stage(induce(pages), "wrappers")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, template = None, None
        for batch in batches:
            texts = []
            for html, reference, found in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
                known = found.as_py()
                if known != last:
                    last, template = known, {(t["slot"], t["hash"]) for t in known or []}
                texts.append(main_text(html.as_py() or "", reference.as_py(), template))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"]
            )

    ids = dict(pages.dtypes)["page_id"]
    # a page without host gets a key of its own kind, so that such pages do not meet in one task
    key = F.when(host() != "", host()).otherwise(F.concat(F.lit("?"), F.xxhash64("html").cast("string")))
    rows = pages.select("page_id", "url", "html", key.alias("host")).join(wrappers, "host", "left").select("page_id", "url", "html", "reference", "template")
    return rows.mapInArrow(run, f"page_id {ids}, url string, text string, n_chars bigint")
