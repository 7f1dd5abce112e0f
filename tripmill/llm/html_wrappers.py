"""HTML main-text extraction by wrappers: union-free regular expressions inferred per host.

1. A page becomes a stream of block tags and text runs (``parse``); inline markup belongs to the run.
2. Streams of a host are aligned one after the other (``fold``, ``merge``). Equal tags match if what they hold is
   alike. A mismatch is resolved into an optional element, or, where an element comes again, into
   a repeated group reaching from its first place to its last. Text that differs becomes a slot. The result is an
   expression without unions, such as ``body(nav(ul(li(#)+)) (div.promo(#))? article(h1(#) p(#)+))``.
3. ``decide`` marks in the expression the region of the main text (the one with most text in slots outside links;
   an ``article`` or ``main`` element goes first), and in it what is no text of the article: navigation, notices,
   adverts, forms, comments, menus of links, and text that a host repeats on every page.
4. ``extract`` matches each page with its host's expression and returns the runs of text of the region.

Wrappers are folded map-side (one row for each host and Arrow batch) and merged in rounds of at most ``FAN`` per
group, so a host with a third of all pages is many small groups. Pages meet the decided wrappers by a join that is
broadcast only if the stored table is below ``spark.sql.autoBroadcastJoinThreshold``; otherwise both sides are
exchanged and adaptive execution splits hot hosts. A wrapper's size is bounded by its host's kinds of
elements, not by its pages: where an element has over ``KINDS`` kinds of parts, classes are ignored and equal tags
become one repeated group.

Defined results: null and empty pages have an empty text; pages without a host (null or odd urls) are extracted by
their own wrapper; so are pages whose region is empty under the host's. A page without any
element is one block. Character references are decoded once; white space (as Unicode has it) becomes one
space. Unclosed tags end with their parent. Elements nested deeper than ``DEPTH`` are held by their ancestor of that
depth. Repeated rows, null ids and ties give a row each; columns besides id, url and html are ignored; an empty
table gives an empty result. The order in which pages are aligned follows the files, so reruns agree.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import ship_code, stage

#: Wrappers merged in a group, kinds of parts in an element, nesting.
FAN, KINDS, DEPTH = 64, 96, 100
#: Repeated text up to so many characters, on so many different pages, is the host's and not the article's.
TEMPLATE_CHARS, TEMPLATE_PAGES = 400, 3

# Fixed values of HTML: elements whose content is no markup or not shown, elements that are blocks.
SILENT = "script style noscript template svg math iframe object canvas audio video title head"
RAW = "script|style|noscript|template|textarea|title|iframe|svg|xmp"
BLOCKS = frozenset(
    "html body address article aside blockquote button center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr input label legend li main menu nav ol optgroup "
    "option p pre search section select summary table tbody td textarea tfoot th thead tr ul".split()
) | frozenset(SILENT.split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset("body center dd details div dl fieldset figure li ol section table tbody td tr ul".split())
SCOPES = frozenset("html body article aside div dl fieldset footer form header main nav ol section table td th ul".split())
#: An opening tag closes these open elements, up to the nearest scope.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
    "th": {"td", "th"}, "tbody": {"thead", "tbody", "tr", "td", "th"}, "tfoot": {"thead", "tbody", "tr", "td", "th"},
    "option": {"option"}, "body": {"head"},
}
#: What is not the article, by element and by words of class, id and role.
ASIDE_TAGS = frozenset("nav footer aside form dialog menu button input select textarea search label".split()) | frozenset(SILENT.split())
ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion promoted nav navbar navigation "
    "menu submenu sidebar footer breadcrumb breadcrumbs pagination pager cookie cookies consent gdpr notice notices "
    "banner popup modal overlay newsletter subscribe subscription signup login paywall share sharing social related "
    "recommended recommendations comment comments commentlist reply replies respond disqus search skip toolbar widget "
    "widgets masthead topbar contentinfo complementary copyright alert alertdialog dialog form tags".split()
)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{RAW})\b(?P<raw_attrs>(?>[^>\"']+|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?>[^>\"']+|\"[^\"<]*\"|'[^'<]*'|[\"'])*+)>"
    r"|<[!?/][^>]*>"
    r"|(?P<text>[^<]+|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\bhidden\b(?!\s*=\s*["']?until)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)


class Node:
    """An element or a text run (``#``), of a page or of a wrapper.

    ``least`` and ``most`` say how often it stands in its parent, ``cycle`` in which repeated group; ``pages``
    counts the pages with it, ``text`` is the text that all of them share or None for a slot.
    """

    __slots__ = ("label", "kids", "least", "most", "cycle", "pages", "chars", "links", "text")

    def __init__(self, label, kids=(), least=1, most=1, cycle=0, pages=1, chars=0, links=0, text=None):
        self.label, self.kids, self.least, self.most = label, list(kids), least, most
        self.cycle, self.pages, self.chars, self.links, self.text = cycle, pages, chars, links, text

    @property
    def tag(self) -> str:
        return self.label.split(".", 1)[0]

    def packed(self) -> list:
        return [self.label, [kid.packed() for kid in self.kids], self.least, self.most, self.cycle, self.pages,
                self.chars, self.links, self.text]

    @staticmethod
    def unpacked(values: list) -> Node:
        return Node(values[0], [Node.unpacked(kid) for kid in values[1]], *values[2:])


def _label(tag: str, attrs: str) -> str:
    """The tag with the words of its class, id and role; numbers differ from page to page and are left out."""
    if "=" not in attrs and "hidden" not in attrs.lower():
        return tag
    words = {w for m in _NAMES.finditer(attrs) for w in re.findall(r"[a-z]+", (m[2] or m[3] or m[4] or "").lower())}
    if _HIDDEN.search(attrs):
        words.add("hidden")
    return ".".join([tag, *sorted(words)])


def parse(page: str) -> Node:
    """The page's tree of blocks."""
    root = Node("html")
    stack, run, links, in_link = [root], [], 0, False

    def flush():
        nonlocal links
        text = " ".join(html.unescape("".join(run)).split()) if run else ""
        if text:
            stack[-1].kids.append(Node("#", chars=len(text), links=min(links, len(text)), text=text))
        run.clear()
        links = 0

    for token in _TOKEN.finditer(page):
        text = token["text"]
        if text is not None:
            run.append(text)
            if in_link:
                links += len(text.strip())
            continue
        if token["raw"] is not None or token["tag"] is None:
            continue
        tag = token["tag"].lower()
        if tag not in BLOCKS:
            if tag == "a":
                in_link = not token["end"]
            elif tag in ("br", "img", "wbr"):
                run.append(" " if tag != "wbr" else "")
            continue
        flush()
        if token["end"]:
            in_link = False
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            else:
                if tag == "p":
                    continue
            continue
        if tag == "html":
            continue
        closing = ENDS.get(tag, ())
        for depth in range(len(stack) - 1, 0, -1):
            open_tag = stack[depth].tag
            if open_tag in closing or open_tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6") and tag not in ("label", "button", "input", "select"):
                del stack[depth:]
                if open_tag not in ("td", "th", "tr"):
                    break
            elif open_tag in SCOPES and not (closing and open_tag in ("td", "th")):
                break
        if tag == "body" and any(node.tag == "body" for node in stack):
            continue
        node = Node(_label(tag, token["attrs"] or ""))
        stack[-1].kids.append(node)
        if tag not in VOID and len(stack) < DEPTH:
            stack.append(node)
    flush()
    return root


def alike(a: Node, b: Node) -> bool:
    """Whether two elements can be one element of the expression."""
    if a.label != b.label:
        return False
    if "." in a.label or a.tag not in CONTAINERS:
        return True
    ones, others = {kid.label for kid in a.kids}, {kid.label for kid in b.kids}
    if not ones or not others:
        return ones == others
    return 2 * len(ones & others) >= min(len(ones), len(others))


def _absorb(a: Node, b: Node, repeated: bool) -> None:
    """Makes ``a`` match what ``b`` matches; ``repeated``: b stands beside a, not on another page."""
    if repeated:
        a.least, a.most = a.least + b.least, a.most + b.most
    else:
        a.least, a.most = min(a.least, b.least), max(a.most, b.most)
        a.pages += b.pages
    if a.text != b.text:
        a.text = None
    a.chars += b.chars
    a.links += b.links
    if a.kids or b.kids:
        a.kids = aligned(a.kids, b.kids)


def folded(kids: list[Node], bare: bool = False) -> list[Node]:
    """Parts that come again become one; what stands between its places joins its repeated group."""
    out: list[Node] = []
    for kid in kids:
        for at in range(len(out) - 1, -1, -1):
            if out[at].label == kid.label if bare else alike(out[at], kid):
                if at < len(out) - 1 or out[at].cycle:
                    cycle = min((x.cycle for x in out[at:] if x.cycle), default=max(x.cycle for x in out) + 1)
                    joined = {x.cycle for x in out[at:] if x.cycle}
                    for x in out:
                        if x.cycle in joined:
                            x.cycle = cycle
                    for x in out[at:]:
                        x.cycle = cycle
                _absorb(out[at], kid, repeated=True)
                break
        else:
            out.append(kid)
    if len(out) > KINDS and not bare:
        for kid in out:
            kid.label = kid.tag
        out = folded(out, bare=True)
    return out


def fold(node: Node) -> Node:
    """A page's tree as an expression of its own."""
    for kid in node.kids:
        fold(kid)
    node.kids = folded(node.kids)
    return node


def aligned(a: list[Node], b: list[Node]) -> list[Node]:
    """Two folded lists as one: the longest alignment of alike parts; the rest is optional."""
    same = [[alike(x, y) for y in b] for x in a]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if same[i][j] else max(best[i + 1][j], best[i][j + 1])
    out, i, j, shift = [], 0, 0, max((x.cycle for x in a), default=0)
    for y in b:
        y.cycle += shift if y.cycle else 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and same[i][j]:
            _absorb(a[i], b[j], repeated=False)
            a[i].cycle = a[i].cycle or b[j].cycle
            out.append(a[i])
            i, j = i + 1, j + 1
        elif j == len(b) or i < len(a) and best[i + 1][j] >= best[i][j + 1]:
            a[i].least = 0
            out.append(a[i])
            i += 1
        else:
            b[j].least = 0
            out.append(b[j])
            j += 1
    return folded(out)


def merge(a: Node, b: Node) -> Node:
    """One expression for the pages of both."""
    _absorb(a, b, repeated=False)
    return a


def expression(node: Node) -> str:
    """The wrapper as text: ``?`` optional, ``+`` repeated, ``*`` both, braces around a repeated group, ``#`` a slot."""
    if node.label == "#":
        body = "#" if node.text is None else json.dumps(node.text, ensure_ascii=False)
    else:
        parts, cycle = [], 0
        for kid in node.kids:
            if cycle and kid.cycle != cycle:
                parts.append("}+")
            if kid.cycle and kid.cycle != cycle:
                parts.append("{")
            cycle = kid.cycle
            parts.append(expression(kid))
        body = f"{node.label}({' '.join(parts + ['}+'] * bool(cycle))})" if node.kids else node.label
    return body + {(True, False): "?", (False, True): "+", (True, True): "*"}.get((node.least == 0, node.most > 1), "")


def _aside(node: Node) -> bool:
    tag, *words = node.label.split(".")
    if tag in ASIDE_TAGS or "hidden" in words:
        return True
    if tag == "header" or "header" in words:  # a page's or an article's: only the latter holds a heading beside its links
        return not _has_heading(node)
    return tag not in ("html", "body", "article", "main") and not ASIDE_WORDS.isdisjoint(words) or (
        tag == "article" and not {"comment", "comments", "reply", "related", "sponsored", "ad"}.isdisjoint(words)
    )


def _has_heading(node: Node) -> bool:
    return any(kid.tag in ("h1", "h2", "h3") or not kid.tag == "nav" and _has_heading(kid) for kid in node.kids)


def _template(node: Node, pages: int) -> bool:
    """Text that a host repeats on its pages."""
    return (
        node.label == "#" and node.text is not None and node.most == 1 and len(node.text) <= TEMPLATE_CHARS
        and node.pages >= max(TEMPLATE_PAGES, 0.3 * pages)
    )


def _linked(node: Node) -> bool:
    """A list of links: a menu."""
    items = [kid for kid in node.kids if kid.tag in ("li", "dd", "div", "p", "a", "#")]
    chars, links = _chars(node)
    return node.tag in ("ul", "ol", "dl", "div") and bool(items) and any(k.most > 2 for k in items) and links >= 0.9 * chars > 0


def _chars(node: Node) -> tuple[int, int]:
    if node.label == "#":
        return node.chars, node.links
    sums = [_chars(kid) for kid in node.kids]
    return sum(x for x, _ in sums), sum(y for _, y in sums)


def _mass(node: Node, pages: int) -> int:
    """Characters in slots outside links and outside what is aside."""
    if node.label == "#":
        return 0 if _template(node, pages) else max(0, node.chars - node.links)
    return 0 if _aside(node) else sum(_mass(kid, pages) for kid in node.kids)


def _region(root: Node, pages: int) -> tuple[Node, bool]:
    """The element of the main text, and whether the page names it."""
    total = _mass(root, pages)
    named = {"article": [], "main": []}

    def look(node: Node) -> None:
        for kid in node.kids:
            if kid.label != "#" and not _aside(kid):
                if kid.tag in named or "main" in kid.label.split(".")[1:] and "role" in kid.label:
                    named["article" if kid.tag == "article" else "main"].append(kid)
                look(kid)

    look(root)
    for kind in ("article", "main"):
        if named[kind]:
            largest = max(named[kind], key=lambda x: _mass(x, pages))
            if 2 * _mass(largest, pages) >= total:
                return largest, True
    node = root
    while True:
        parts = [(_mass(kid, pages), kid) for kid in node.kids if kid.label != "#"]
        mass, kid = max(parts, key=lambda x: x[0], default=(0, None))
        if kid is None or kid.tag not in CONTAINERS | {"article", "main", "header"} or 10 * mass < 8 * _mass(node, pages) or not mass:
            return node, False
        node = kid


def decide(wrapper: Node) -> str:
    """The marked wrapper as text: label, mark, parts. Marks: ``!`` the region, ``-`` not the article."""
    pages = wrapper.pages
    region, named = _region(wrapper, pages)

    def marked(node: Node, inside: bool) -> list:
        mark = ""
        if node is region:
            inside, mark = True, "!"
        elif inside and (_aside(node) or _linked(node) or not named and _template(node, pages)):
            mark = "-"
        return [node.label, mark, [marked(kid, inside) for kid in node.kids]]

    return json.dumps(marked(wrapper, False), ensure_ascii=False, separators=(",", ":"))


@lru_cache(maxsize=4096)
def _plan(text: str) -> tuple[Node, dict[int, str]]:
    marks: dict[int, str] = {}

    def build(values: list) -> Node:
        node = Node(values[0], [build(kid) for kid in values[2]])
        marks[id(node)] = values[1]
        return node

    return build(json.loads(text)), marks


def extract(tree: Node, plan: str) -> str:
    """The text of the region, a line for each run of text."""
    root, marks = _plan(plan)
    out: list[str] = []

    def walk(node: Node, known: Node | None, inside: bool) -> None:
        inside = inside or known is not None and marks[id(known)] == "!"
        at, parts = 0, known.kids if known is not None else []
        for kid in node.kids:
            order = [*range(at, len(parts)), *range(at)]
            found = next((n for n in order if alike(parts[n], kid)), None)
            if found is None:  # a wrapper whose classes are ignored
                found = next((n for n in order if parts[n].label == kid.tag and kid.label != "#"), None)
            match, at = (None, at) if found is None else (parts[found], found)
            if inside and (_aside(kid) or match is not None and marks[id(match)] == "-"):
                continue
            if kid.label == "#":
                if inside:
                    out.append(kid.text)
            elif match is not None or inside:
                walk(kid, match, inside)

    walk(tree, root, False)
    return "\n".join(out)


def main_text(page: str, plan: str | None) -> str:
    """The page's main text under its host's plan; under its own wrapper where that has none."""
    if not page:
        return ""
    tree = parse(page)
    text = extract(tree, plan) if plan else ""
    return text or extract(tree, decide(fold(parse(page))))


def host_of(url: Column) -> Column:
    """The lower-cased host without port and user; null where there is none."""
    host = F.regexp_extract(F.lower(url), r"^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:@\s]+)", 1)
    return F.when(F.length(host) > 0, host)


def infer_wrappers(pages: DataFrame, url: str = "url", page: str = "html") -> DataFrame:
    """``host, pages, wrapper, expression, plan``: one row per host, over all of its pages."""
    ship_code(pages.sparkSession)
    read = pages.select(host_of(pages[url]).alias("host"), pages[page].alias("html")).filter(
        F.col("host").isNotNull() & (F.length("html") > 0)
    )

    def infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[str, Node] = {}
            seen = set()
            for host, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = value.as_py()
                digest = (host, xxhash.xxh3_128_intdigest(text))
                if digest in seen:  # an exact copy says nothing new about what is repeated
                    continue
                seen.add(digest)
                tree = fold(parse(text))
                known[host] = merge(known[host], tree) if host in known else tree
            yield _table({host: [node] for host, node in known.items()})

    def _table(nodes: dict[str, list[Node]]) -> pa.RecordBatch:
        rows = []
        for host, parts in nodes.items():
            whole = parts[0]
            for part in parts[1:]:
                whole = merge(whole, part)
            rows.append((host, whole.pages, json.dumps(_short(whole).packed(), ensure_ascii=False)))
        columns = list(zip(*rows)) if rows else [[], [], []]
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, (pa.string(), pa.int64(), pa.string()))],
            ["host", "pages", "wrapper"],
        )

    def unite(table: pa.Table) -> pa.Table:
        packed = sorted(table["wrapper"].to_pylist())
        nodes = [Node.unpacked(json.loads(text)) for text in packed]
        return pa.Table.from_batches([_table({table["host"][0].as_py(): nodes})])

    kinds = "host string, pages bigint, wrapper string"
    parts = stage(read.mapInArrow(infer, kinds), "wrappers")
    while True:  # rounds: a logarithm of the batches
        most = parts.groupBy("host").count().agg(F.max("count")).first()[0] or 0
        if most <= 1:
            break
        salt = F.pmod(F.xxhash64("wrapper"), F.lit(max(1, -(-most // FAN))))
        parts = stage(parts.groupBy("host", salt.alias("salt")).applyInArrow(unite, kinds), "wrappers")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes = [Node.unpacked(json.loads(text)) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([expression(x) for x in nodes], pa.string()),
                 pa.array([decide(x) for x in nodes], pa.string())],
                ["host", "pages", "wrapper", "expression", "plan"],
            )

    return parts.mapInArrow(judge, kinds + ", expression string, plan string")


def _short(node: Node) -> Node:
    """Without long texts: what is too long for a template is a slot anyway."""
    if node.text is not None and len(node.text) > TEMPLATE_CHARS:
        node.text = None
    for kid in node.kids:
        _short(kid)
    return node


def extract_main_text(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html"
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page."""
    plans = stage(infer_wrappers(pages, url, page).select(F.col("host").alias("of_host"), "plan"), "plans")
    read = pages.select(
        pages[page_id].alias("page_id"), pages[url].alias("url"), pages[page].alias("html"), host_of(pages[url]).alias("host")
    )
    joined = read.join(plans, F.col("host") == F.col("of_host"), "left").select("page_id", "url", "html", "plan")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(value.as_py() or "", plan.as_py()) for value, plan in zip(batch.column(2), batch.column(3))
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    id_type = read.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars bigint")
