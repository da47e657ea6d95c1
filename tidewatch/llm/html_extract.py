"""Main text of web pages, with wrappers that are inferred per host as union-free regular expressions.

A page becomes a stream of block tags and text slots. Runs of equal siblings (also with a period of two or three) fold into a
repeated group. The streams of a host are aligned one after the other: tags that one side lacks become optional groups, single
against repeated becomes repeated, and texts that differ become text slots, so that only template text stays literal. Tasks
fold their own pages first; the partial wrappers of a host are then merged in two steps (by host and salt, then by host), one row
at a time, so no host is gathered whole.

The wrapper says where a host keeps its articles (the paths of ``article`` or ``main`` elements outside boilerplate) and which texts
are literally on all its pages. Text is taken from the slots below those paths. A page without such a root gives all its blocks but the
host's literal texts (if the host has at least ``MIN_PAGES`` pages) and blocks that are mostly links; if that leaves nothing, all of them.
Boilerplate is told by tag, role, class and id.

Defined results: null html has an empty text; a null url is a host of its own; unclosed and stray tags are mended as browsers do,
and elements nested more than ``MAX_DEPTH`` deep add their text to the one at that depth; equal pages and ids give a row each.
"""

from __future__ import annotations

import hashlib
import html as html_lib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import slices, widened
from tidewatch.session import materialize

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>|<[!?/][^>]*>?|<[a-zA-Z][^>]*>?", re.S)
ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
RAW = frozenset("script style noscript template svg math iframe object title textarea select datalist xmp noembed noframes canvas audio video button".split())
BLOCKS = frozenset(
    "html body main article section div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre figure figcaption address "
    "header footer nav aside form fieldset legend details summary dialog menu hgroup center dir search".split()
)
VOID = frozenset("hr img input br wbr meta link base area col embed source track param".split())
BOILERPLATE_TAGS = frozenset("head nav footer aside form menu dialog search".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
BOILERPLATE_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead header footer sidebar aside widget widgets ad ads adv advert adverts advertisement advertising "
    "sponsor sponsored sponsors promo promotion cookie cookies consent gdpr notice notices alert alerts popup modal overlay banner comment comments disqus reply replies "
    "respond discussion share sharing social related recommended recommendations newsletter subscribe subscription signup login search pagination pager toolbar skip".split()
)
COMMENT_WORDS = frozenset("comment comments reply replies respond disqus discussion".split())
ROOTS = ("article", "main")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES = {  # tag: which open tags it ends, up to which tags
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "tr": ({"tr"}, {"table"}), "tbody": ({"thead", "tbody", "tr"}, {"table"}), "tfoot": ({"thead", "tbody", "tr"}, {"table"}),
}
MIN_PAGES = 3
MAX_DEPTH = 100
FLUSH_HOSTS = 1000
SALTS = 16


def _words(value: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower()) if w]


class Element:
    __slots__ = ("tag", "label", "path", "children", "dropped", "root", "quiet")

    def __init__(self, tag: str, label: str, path: str, dropped: bool, root: bool, quiet: bool):
        self.tag, self.label, self.path, self.dropped, self.root, self.quiet = tag, label, path, dropped, root, quiet
        self.children: list[Element | Text] = []


class Text:
    __slots__ = ("text", "path", "link_chars", "root")

    def __init__(self, text: str, path: str, link_chars: int, root: bool):
        self.text, self.path, self.link_chars, self.root = text, path, link_chars, root


def _dropped(tag: str, attributes: dict[str, str], in_root: bool) -> bool:
    if tag in ("html", "body"):
        return False
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", attributes.get("style", "").lower()):
        return True
    named = [_words(attributes.get("class", "")), _words(attributes.get("id", ""))]
    if tag in ROOTS:
        return any(w in COMMENT_WORDS for words in named for w in words)
    if tag in BOILERPLATE_TAGS or (tag == "header" and not in_root) or attributes.get("role", "").lower() in BOILERPLATE_ROLES:
        return True
    if in_root and (tag == "header" or tag in HEADINGS):
        return False
    for words in named:
        for k, w in enumerate(words):
            if w in BOILERPLATE_WORDS and not (k and words[k - 1] in ("with", "has", "no", "without")):
                return True
    return False


def parse(text: str | None) -> Element:
    """The tree of block elements and texts of a page."""
    top = Element("", "", "", False, False, False)
    if not text:
        return top
    stack = [top]
    buffer: list[str] = []
    link_chars, links, at = 0, 0, 0

    def flush() -> None:
        nonlocal link_chars
        joined = " ".join("".join(buffer).split())
        buffer.clear()
        own = stack[-1]
        if joined and not own.dropped and not own.quiet:
            own.children.append(Text(joined, own.path, link_chars, own.root))
        link_chars = 0

    def add(piece: str) -> None:
        nonlocal link_chars
        if piece and not stack[-1].dropped:
            decoded = html_lib.unescape(piece)
            buffer.append(decoded)
            if links:
                link_chars += len(decoded.strip())

    def close(k: int) -> None:
        flush()
        del stack[k:]

    while True:
        found = MARKUP.search(text, at)
        if not found:
            add(text[at:])
            break
        add(text[at : found.start()])
        at = found.end()
        if not found[2]:
            continue
        ending, tag = bool(found[1]), found[2].lower()
        if tag in RAW:
            if not ending and not found[3].endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\b[^>]*>?", re.I).search(text, at)
                at = end.end() if end else len(text)
            continue
        if tag == "br":
            buffer.append(" ")
        elif tag == "hr":
            flush()
        elif tag in VOID:
            continue
        elif tag == "a":
            links = max(0, links + (-1 if ending else 1))
        elif tag == "head" or tag in BLOCKS:
            if ending:
                k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag), 0)
                if k:
                    close(k)
                else:
                    flush()
                continue
            flush()
            if tag in ("html", "body") and any(e.tag == tag for e in stack):
                continue
            if tag == "body" or (tag in BLOCKS and stack[-1].tag == "head"):
                k = next((k for k, e in enumerate(stack) if e.tag == "head"), 0)
                if k:
                    del stack[k:]
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag in ("p", "td", "th", "li", "div", "section")), 0)
            if k and stack[k].tag == "p":
                del stack[k:]
            if tag in CLOSES:
                ends, until = CLOSES[tag]
                k = len(stack) - 1
                first = 0
                while k > 0 and stack[k].tag not in until:
                    if stack[k].tag in ends:
                        first = k
                    k -= 1
                if first:
                    del stack[first:]
            attributes = {n.lower(): html_lib.unescape(a or b or c) for n, a, b, c in ATTRIBUTE.findall(found[3])}
            above = stack[-1]
            label = ".".join([tag, *sorted({w for w in attributes.get("class", "").split() if not re.search(r"[\d.]", w)})])
            dropped = above.dropped or _dropped(tag, attributes, above.root)
            # of the head of an article only the headings are text
            quiet = tag not in HEADINGS and (above.quiet or (above.root and tag == "header"))
            root = not dropped and (above.root or tag in ROOTS)
            if len(stack) > MAX_DEPTH and not dropped:  # what lies deeper belongs to the element at that depth
                element = Element(tag, label, above.path, dropped, root, quiet)
                element.children = above.children
            else:
                element = Element(tag, label, f"{above.path}/{label}", dropped, root, quiet)
                if not above.dropped:
                    above.children.append(element)
            if not found[3].endswith("/"):
                stack.append(element)
    flush()
    return top


def texts_of(element: Element) -> list[Text]:
    out: list[Text] = []
    stack: list[Element | Text] = [element]
    while stack:
        node = stack.pop()
        if isinstance(node, Text):
            out.append(node)
        else:
            stack += reversed(node.children)
    return out


# A wrapper node is [label, how often, what]: "" or "?", "*", "+"; what is a list of nodes, or for a text (label "#") the sorted digests of the
# texts that every page has there. One digest alone is template text, any other text is a slot.
Node = list


def _digest(text: str) -> str:
    return hashlib.md5(text.encode("utf-8", "surrogatepass")).hexdigest()[:12]


def _often(a: str, b: str) -> str:
    many, none = bool({a, b} & {"*", "+"}), bool({a, b} & {"*", "?"})
    return {(True, True): "*", (True, False): "+", (False, True): "?", (False, False): ""}[many, none]


def _join(a: Node, b: Node, one_page: bool) -> Node:
    """One node for two with equal labels: what a page has in either, or what two pages have in both."""
    if a[0] == "#":
        return ["#", _often(a[1], b[1]), sorted(set(a[2]) | set(b[2]) if one_page else set(a[2]) & set(b[2]))]
    return [a[0], _often(a[1], b[1]), align(a[2], b[2], one_page)]


def _optional(node: Node, one_page: bool) -> Node:
    return [node[0], _often(node[1], "?"), node[2] if one_page else _slots_only(node[2], node[0] == "#")]


def _slots_only(what: list, text: bool) -> list:
    return [] if text else [[label, often, _slots_only(inner, label == "#")] for label, often, inner in what]


def fold(nodes: list[Node]) -> list[Node]:
    """Repeated groups of one, two or three siblings."""
    out: list[Node] = []
    k = 0
    labels = [n[0] for n in nodes]
    while k < len(nodes):
        for period in (1, 2, 3):
            group = labels[k : k + period]
            times = 1
            while labels[k + times * period : k + (times + 1) * period] == group and len(group) == period:
                times += 1
            if times > 1 and "#" not in group[:1] * (period == 1):
                parts = [nodes[k + t * period : k + (t + 1) * period] for t in range(times)]
                merged = parts[0]
                for part in parts[1:]:
                    merged = [_join(a, b, True) for a, b in zip(merged, part, strict=True)]
                if period == 1:
                    out.append([merged[0][0], "+", merged[0][2]])
                else:
                    out.append(["(" + " ".join(group) + ")", "+", merged])
                k += times * period
                break
        else:
            out.append(nodes[k])
            k += 1
    return out


def align(a: list[Node], b: list[Node], one_page: bool = False) -> list[Node]:
    """The two sequences as one: nodes that only one has become optional."""
    if [n[0] for n in a] == [n[0] for n in b]:
        return [x if x == y else _join(x, y, one_page) for x, y in zip(a, b, strict=True)]
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            best[i][j] = best[i + 1][j + 1] + 1 if a[i][0] == b[j][0] else max(best[i + 1][j], best[i][j + 1])
    out: list[Node] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and a[i][0] == b[j][0]:
            out.append(_join(a[i], b[j], one_page))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and best[i + 1][j] >= best[i][j + 1]):
            out.append(_optional(a[i], one_page))
            i += 1
        else:
            out.append(_optional(b[j], one_page))
            j += 1
    return out


def wrapper_of(element: Element) -> list[Node]:
    """The folded stream of one page."""
    return fold([["#", "", [_digest(c.text)]] if isinstance(c, Text) else [c.label, "", wrapper_of(c) if not c.dropped else []] for c in element.children])


def as_expression(nodes: list[Node]) -> str:
    """The wrapper as a regular expression over tags and #PCDATA."""
    out = []
    for label, often, what in nodes:
        if label == "#":
            body = "#TEXT" if len(what) == 1 else "#PCDATA"
        elif label.startswith("("):
            body = as_expression(what)
        else:
            body = f"<{label}>{as_expression(what)}</{label.split('.')[0]}>"
        out.append(f"({body}){often}" if often else body)
    return "".join(out)


def _survey(nodes: list[Node], path: str, roots: list[str], literals: list[list[str]]) -> None:
    """Collect the paths of the articles, and (path, digest) of the texts that all pages have."""
    for label, _, what in nodes:
        if label == "#":
            literals += [[path, digest] for digest in what]
            continue
        own = path if label.startswith("(") else f"{path}/{label}"
        if label.split(".")[0] in ROOTS:
            if what:  # a dropped one is empty
                roots.append(own)
        else:
            _survey(what, own, roots, literals)


def slots(wrapper: list[Node], n: int) -> dict:
    """What a wrapper over ``n`` pages says of the text slots of its host."""
    roots: list[str] = []
    literals: list[list[str]] = []
    _survey(wrapper, "", roots, literals)
    return {"roots": sorted(set(roots)), "literals": sorted(literals) if n >= MIN_PAGES and not roots else []}


def main_text(page: Element, roots: tuple[str, ...], literals: frozenset[tuple[str, str]]) -> str:
    blocks = texts_of(page)
    chosen = [t for t in blocks if any(t.path == r or t.path.startswith(r + "/") for r in roots)]
    if not chosen:
        chosen = [t for t in blocks if 2 * t.link_chars <= len(t.text) and (t.path, _digest(t.text)) not in literals] or blocks
    return "\n\n".join(t.text for t in chosen)


WRAPPER = "host string, salt int, n long, wrapper string"
WRAPPER_TYPE = pa.schema([("host", pa.string()), ("salt", pa.int32()), ("n", pa.int64()), ("wrapper", pa.string())])


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, tuple[int, list[Node]]] = {}

    def out() -> pa.RecordBatch:
        rows = [{"host": h, "salt": int(_digest(json.dumps(w))[:8], 16) % SALTS, "n": n, "wrapper": json.dumps(w)} for h, (n, w) in held.items()]
        return pa.RecordBatch.from_pylist(rows, schema=WRAPPER_TYPE)

    for batch, texts in slices(batches, "_html"):
        for host, text in zip(batch.column("_host").to_pylist(), texts, strict=True):
            own = wrapper_of(parse(text))
            n, known = held.get(host, (0, None))
            held[host] = (n + 1, own if known is None else align(known, own))
        if len(held) >= FLUSH_HOSTS:
            yield out()
            held = {}
    if held:
        yield out()


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by host: one row for each host."""
    host, salt, n, wrapper = None, 0, 0, None
    for batch in batches:
        for row in batch.to_pylist():
            if wrapper is not None and row["host"] != host:
                yield pa.RecordBatch.from_pylist([{"host": host, "salt": salt, "n": n, "wrapper": json.dumps(wrapper)}], schema=WRAPPER_TYPE)
                wrapper, n = None, 0
            own = json.loads(row["wrapper"])
            host, salt, n, wrapper = row["host"], row["salt"], n + row["n"], own if wrapper is None else align(wrapper, own)
    if wrapper is not None:
        yield pa.RecordBatch.from_pylist([{"host": host, "salt": salt, "n": n, "wrapper": json.dumps(wrapper)}], schema=WRAPPER_TYPE)


def _host(url_col: str) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit("")))


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, salt, n, wrapper): one wrapper a host, of all its pages."""
    parts = int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = pages.select(_host(url_col).alias("_host"), F.coalesce(F.col(html_col), F.lit("")).alias("_html")).mapInArrow(_partial, WRAPPER)
    by_salt = rows.repartition(parts, "host", "salt").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(_merge, WRAPPER)
    by_host = by_salt.repartition(parts, "host").sortWithinPartitions("host", "salt", "wrapper").mapInArrow(_merge, WRAPPER)
    return materialize(by_host, "wrappers")


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", wrappers: DataFrame | None = None) -> DataFrame:
    """All columns of ``pages`` but the html, and ``_text``: the main text of each page by the wrapper of its host."""
    wrappers = infer_wrappers(pages, url_col, html_col) if wrappers is None else wrappers
    rest = [f for f in pages.schema.fields if f.name != html_col]
    names = [f.name for f in rest]
    schema = widened(rest, "_text string")

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"_host": row["host"], "_slots": json.dumps(slots(json.loads(row["wrapper"]), row["n"]))} for row in batch.to_pylist()]
            yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("_host", pa.string()), ("_slots", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str | None, tuple[tuple[str, ...], frozenset[tuple[str, str]]]] = {None: ((), frozenset())}
        for batch, texts in slices(batches, html_col):
            out = []
            for text, found in zip(texts, batch.column("_slots").to_pylist(), strict=True):
                if found not in known:
                    if len(known) >= FLUSH_HOSTS:
                        known = {None: ((), frozenset())}
                    said = json.loads(found)
                    known[found] = (tuple(said["roots"]), frozenset((p, d) for p, d in said["literals"]))
                out.append(main_text(parse(text), *known[found]))
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), pa.array(out, pa.string())], names=[*names, "_text"])

    hosts = wrappers.mapInArrow(plan, "_host string, _slots string")
    return pages.withColumn("_page_host", _host(url_col)).join(hosts, F.col("_page_host") == F.col("_host"), "left").mapInArrow(run, schema)
