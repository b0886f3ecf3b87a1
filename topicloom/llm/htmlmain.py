"""Operator 3: main text by wrapper induction.

Pages are parsed into element trees; inline elements, scripts and comments are no
nodes, and a run of like siblings (paragraphs, list items) is folded into one node.
Pages of equal text count once and pages without text not at all.  A host has up to
WRAPPERS wrappers: its pages are clustered by the upper levels of their trees, and the
most frequent folded tree of each of the largest clusters is one.  Each page's tree is
aligned with them by simple tree matching (Yang 1991): equal roots, then the best
order-keeping matching of children; the wrapper that fits best is the page's own.  A
wrapper node is template if its text is the same on nearly all pages whose own wrapper
it is; or, for pages with that very text, on nearly all pages of the host that have the
node, which serves layouts of few pages; or, on a host of few pages, on all of two or
more, if that is less than half of the page's text.  The other nodes are slots.
Slots are content unless their element says otherwise (navigation, footers, adverts,
forms, comments, ...); where a page marks an article, content is inside it.

Statistics cover all pages: counts are combined in the tasks, then by (host, wrapper,
node, text), so a host with a third of all pages is no single task.  Copies of an article
do not make it look like a template.  The wrapper table has a row a host and joins by
size, as Spark sees fit.

Defined results: a null or empty html gives an empty text; a null or odd url belongs
to the host ''; markup that is cut off or unclosed is closed at the end; white space
is what str.split() takes for it; rows with equal page_id stay separate rows; other
columns are ignored.
"""

from __future__ import annotations

import html as htmllib
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from topicloom.llm.common import land

#: A wrapper node is template if this share of at least so many distinct pages agrees.
TEMPLATE_SHARE, MIN_PAGES = 0.9, 5
#: Wrappers a host, and the levels below the root that tell its clusters apart.
WRAPPERS, LEVELS = 8, 5
MEMO = 5000

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/)?(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
_ATTR = re.compile(r"([^\s=/>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math xmp noembed noframes object".split())
BLOCK = frozenset(
    "html head body article section main nav header footer aside div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead tbody tfoot tr td th caption "
    "blockquote pre figure figcaption form fieldset address details summary hr center dialog menu search hgroup legend option select".split()
)
ENDS_P = BLOCK - frozenset("html head body td th option select legend".split())
#: Elements that an opening tag closes, up to the element that bounds them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, {"html"}),
}
NOISE_TAGS = frozenset("head nav footer aside form fieldset button select option dialog menu search legend".split()) | RAW
#: A class, id or role names such an element if it is one of these words, alone, after words of
#: place, or before any others but a state: "site-nav", "ad-slot"; not "no-sidebar", "comments-open".
_WORDS = (
    r"ad|ads|advert\w*|adverts?|sponsor\w*|promo\w*|banner|cookie\w*|consent|gdpr|notice|notices|alert|popup|modal|overlay|newsletter|subscri\w+|"
    r"sidebar|side-?bar|nav\w*|menu\w*|breadcrumbs?|pagination|pager|footer|site-?header|masthead|topbar|toolbar|comments?|replies|reply|discussion|disqus|"
    r"share|sharing|social\w*|related\w*|recommend\w*|widget\w*|login|search|skip\w*|complementary|contentinfo|navigation|search-?form"
)
_PLACES = (
    "site|page|main|primary|secondary|top|bottom|left|right|upper|lower|global|local|header|head|post|posts|article|entry|story|blog|section|block|user|"
    "mobile|desktop|sticky|floating|inline|js|c|o|m|l|wp|google|dfp|the|div|my|sub"
)
_STATES = "open|opened|closed?|fixed|enabled|disabled|active|inactive|visible|shown|collapsed|expanded|on|off|none|free"
_NOISE = re.compile(rf"(?:(?:{_PLACES})[_-]+)*(?:{_WORDS})(?![^_-])(?!.*[_-](?:{_STATES})$)", re.I)
#: Elements that hold the content whatever their classes say.
HOLDERS = frozenset("html body main article".split())


class Page:
    """Nodes are parallel lists: parent, label, noise; blocks are (node, text)."""

    __slots__ = ("blocks", "label", "noise", "parent", "tag")

    def __init__(self, source: str):
        self.parent, self.tag, self.label, self.noise = [-1], [""], ["#"], [False]
        self.blocks: list[tuple[int, str]] = []
        self._parse(source)

    def _parse(self, source: str) -> None:
        open_tags: list[tuple[str, int]] = [("", 0)]  # inline elements keep their block's node
        parts: list[str] = []
        pos, end = 0, len(source)

        def flush() -> None:
            if parts:
                text = " ".join("".join(parts).split())
                if text:
                    self.blocks.append((open_tags[-1][1], text))
                parts.clear()

        def close_until(names, bounds=()) -> None:
            """Close the innermost open element of ``names`` unless one of ``bounds`` lies inside."""
            for i in range(len(open_tags) - 1, 0, -1):
                t = open_tags[i][0]
                if t in names:
                    if any(x in BLOCK for x, _ in open_tags[i:]):
                        flush()
                    del open_tags[i:]
                    return
                if t in bounds:
                    return

        while pos < end:
            m = _TOKEN.search(source, pos)
            if m is None:
                parts.append(htmllib.unescape(source[pos:]))
                break
            if m.start() > pos:
                parts.append(htmllib.unescape(source[pos : m.start()]))
            pos = max(m.end(), m.start() + 1)
            name = m["tag"]
            if name is None:
                if m["cdata"]:
                    parts.append(m["cdata"])
                continue
            name = name.lower()
            if m["close"]:
                if any(t == name for t, _ in open_tags):
                    close_until({name}, () if name in BLOCK else BLOCK)
                elif name == "p":
                    flush()
                continue
            if name in RAW:
                if not m["attrs"].rstrip().endswith("/"):
                    stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(source, pos)
                    pos = stop.end() if stop else end
                continue
            if name in VOID:
                if name == "hr":
                    flush()
                else:
                    parts.append(" " if name == "br" else "")
                continue
            if name not in BLOCK:
                noise = self.noise[open_tags[-1][1]] or (bool(m["attrs"]) and _is_noise(name, m["attrs"])) or name in NOISE_TAGS
                if noise and not self.noise[open_tags[-1][1]]:  # an inline element of its own kind is a node
                    flush()
                    open_tags.append((name, self._node(open_tags[-1][1], name, m["attrs"], True)))
                else:
                    open_tags.append((name, open_tags[-1][1]))
                continue
            flush()
            if name in ENDS_P:
                close_until({"p"}, BLOCK - {"p"})
            if name in CLOSES:
                names, bounds = CLOSES[name]
                for _ in names:
                    close_until(names, bounds)
            up = open_tags[-1][1]
            noise = self.noise[up] or name in NOISE_TAGS or (bool(m["attrs"]) and _is_noise(name, m["attrs"]))
            if name == "header" and not any(t in ("article", "main") for t, _ in open_tags):
                noise = True
            open_tags.append((name, self._node(up, name, m["attrs"], noise)))
        flush()

    def _node(self, up: int, name: str, attrs: str, noise: bool) -> int:
        kind = ""
        if attrs:
            kind = re.sub(r"\d+", "0", " ".join(_pairs(attrs).get("class", "").split()[:2]))
        self.parent.append(up)
        self.tag.append(name)
        self.label.append(f"{name}.{kind}" if kind else name)
        self.noise.append(noise)
        return len(self.parent) - 1


def _pairs(attrs: str) -> dict[str, str]:
    """Attribute values by lower-case name; the first of a name counts."""
    out: dict[str, str] = {}
    for key, *values in _ATTR.findall(attrs):
        out.setdefault(key.lower(), "".join(values))
    return out


def _is_noise(name: str, attrs: str) -> bool:
    pairs = _pairs(attrs)
    if "hidden" in pairs or pairs.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", pairs.get("style", ""), re.I):
        return True
    return name not in HOLDERS and any(_NOISE.match(t) for k in ("class", "id", "role") for t in pairs.get(k, "").split())


def fold(page: Page) -> tuple[str, list[int]]:
    """The folded tree as text, ``label(child,child)``, and for each element its folded
    node, numbered in preorder.  Like siblings in a row share a node."""
    n = len(page.parent)
    kids: list[list[int]] = [[] for _ in range(n)]
    for v in range(1, n):
        kids[page.parent[v]].append(v)
    form = [""] * n
    for v in range(n - 1, -1, -1):
        below, last = [], None
        for k in kids[v]:
            if form[k] != last:
                below.append(form[k])
                last = form[k]
        label = page.label[v].translate(_PLAIN)
        form[v] = f"{label}({','.join(below)})" if below else label
    at = [0] * n
    count = 0
    stack: list[tuple[list[int]]] = [([0],)]
    while stack:  # one entry: the elements of one folded node
        (group,) = stack.pop()
        for v in group:
            at[v] = count
        count += 1
        # The folded children: the runs of like siblings, the same in every element of the group.
        lanes: list[list[int]] = []
        for v in group:
            lane, last = -1, None
            for k in kids[v]:
                if form[k] != last:
                    lane += 1
                    last = form[k]
                    if lane == len(lanes):
                        lanes.append([])
                lanes[lane].append(k)
        stack += [(x,) for x in reversed(lanes)]
    return form[0], at


_PLAIN = str.maketrans("(),", "___")


def tree_of(form: str) -> tuple[list[str], list[list[int]]]:
    """Labels and children of a folded tree, nodes in preorder."""
    labels, kids, path = [], [], []
    for m in re.finditer(r"[^(),]+|[(),]", form):
        if m[0] == "(":
            path.append(len(labels) - 1)
        elif m[0] == ")":
            path.pop()
        elif m[0] != ",":
            labels.append(m[0])
            kids.append([])
            if path:
                kids[path[-1]].append(len(labels) - 1)
    return labels, kids


def align(form: str, wrapper: str) -> list[int]:
    """Simple tree matching: for every node of ``form`` its node in ``wrapper``, or -1."""
    (la, ka), (lb, kb) = tree_of(form), tree_of(wrapper)
    memo: dict[tuple[int, int], tuple[int, list]] = {}

    def match(a: int, b: int) -> int:
        if la[a] != lb[b]:
            return 0
        if (a, b) in memo:
            return memo[a, b][0]
        x, y = ka[a], kb[b]
        best = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i in range(1, len(x) + 1):
            for j in range(1, len(y) + 1):
                best[i][j] = max(best[i - 1][j], best[i][j - 1], best[i - 1][j - 1] + match(x[i - 1], y[j - 1]))
        memo[a, b] = best[-1][-1] + 1, best
        return memo[a, b][0]

    out = [-1] * len(la)
    match(0, 0)
    todo = [(0, 0)] if la[0] == lb[0] else []
    while todo:
        a, b = todo.pop()
        out[a] = b
        best, i, j = memo[a, b][1], len(ka[a]), len(kb[b])
        while i and j:
            got = match(ka[a][i - 1], kb[b][j - 1])
            if got and best[i][j] == best[i - 1][j - 1] + got:
                todo.append((ka[a][i - 1], kb[b][j - 1]))
                i, j = i - 1, j - 1
            elif best[i][j] == best[i - 1][j]:
                i -= 1
            else:
                j -= 1
    return out


_ALIGNED: dict[tuple[str, str], list[int]] = {}


def aligned(form: str, wrapper: str) -> list[int]:
    got = _ALIGNED.get((form, wrapper))
    if got is None:
        if len(_ALIGNED) >= MEMO:
            _ALIGNED.clear()
        got = _ALIGNED[form, wrapper] = align(form, wrapper)
    return got


def best_of(form: str, wrappers: list[str]) -> int:
    """The wrapper with the largest share of matched nodes; the first of equals."""

    def share(w: str) -> float:
        to = aligned(form, w)
        return 2 * sum(v >= 0 for v in to) / (len(to) + 1 + w.count(",") + w.count("("))

    return max(range(len(wrappers)), key=lambda k: (share(wrappers[k]), -k)) if len(wrappers) > 1 else 0


def shape_of(form: str) -> int:
    """Hash of the upper levels of a folded tree."""
    out, depth = [], 0
    for m in re.finditer(r"[^(),]+|[(),]", form):
        depth += (m[0] == "(") - (m[0] == ")")
        if depth <= LEVELS:
            out.append(m[0])
    return _hash("".join(out))


def _hash(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def host():
    """Column: the lower-case host of url."""
    return F.lower(F.coalesce(F.regexp_extract("url", r"^\s*[A-Za-z][A-Za-z0-9+.-]*://([^/?#\s]*)", 1), F.lit("")))


def outline(source: str) -> tuple[str, dict[int, int], int]:
    """(folded tree, text hash of each folded node with text, hash of the whole text)."""
    page = Page(source)
    form, at = fold(page)
    return form, node_texts(page, at), _hash("\n".join(t for _, t in page.blocks))


def node_texts(page: Page, at: list[int]) -> dict[int, int]:
    """Text hash of each folded node with text."""
    texts: dict[int, list[str]] = {}
    for node, text in page.blocks:
        texts.setdefault(at[node], []).append(text)
    return {v: _hash("\n".join(t)) for v, t in texts.items()}


def induce(pages: DataFrame) -> DataFrame:
    """(host, wrappers, template): a row a host; template lists the constant nodes as
    (wrapper, node, text, kind): kind 0 whatever the page's text there, 1 for that text,
    2 for that text if it is the lesser part of the page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [outline(h or "") for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "host": batch.column("host"),
                    "form": pa.array([x[0] for x in out], pa.string()),
                    "shape": pa.array([shape_of(x[0]) for x in out], pa.int64()),
                    "page": pa.array([x[2] for x in out], pa.int64()),
                    "nodes": pa.array([list(x[1]) for x in out], pa.list_(pa.int32())),
                    "texts": pa.array([list(x[1].values()) for x in out], pa.list_(pa.int64())),
                }
            )

    rows = pages.select(host().alias("host"), "html").mapInArrow(read, "host string, form string, shape long, page long, nodes array<int>, texts array<long>")
    rows = land(rows, "html-outlines")
    distinct = rows.where(F.size("nodes") > 0).groupBy("host", "page").agg(F.min(F.struct("form", "shape", "nodes", "texts")).alias("x")).select("host", "x.*")
    distinct = land(distinct, "html-pages")
    forms = distinct.groupBy("host", "shape", "form").agg(F.count("*").alias("n"))
    shapes = forms.groupBy("host", "shape").agg(F.sum("n").alias("size"), F.max(F.struct("n", "form")).alias("best")).select("host", "size", "best.form")
    most = Window.partitionBy("host").orderBy(F.desc("size"), F.desc(F.length("form")), "form")
    few = shapes.withColumn("r", F.row_number().over(most)).where(F.col("r") <= WRAPPERS)
    wrappers = few.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("r", "form"))).alias("w")).select("host", F.col("w.form").alias("wrappers"))
    sizes = forms.groupBy("host").agg(F.sum("n").alias("pages"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        own: Counter = Counter()
        for batch in batches:
            for r in batch.to_pylist():
                best = best_of(r["form"], r["wrappers"])
                for k, w in enumerate(r["wrappers"]):
                    to = aligned(r["form"], w)
                    keys = [(r["host"], k, to[v], t) for v, t in zip(r["nodes"], r["texts"]) if to[v] >= 0]
                    seen.update(keys)
                    if k == best:
                        own.update(keys)
            if len(seen) > 100_000:
                yield out(seen, own)
        yield out(seen, own)

    def out(seen: Counter, own: Counter) -> pa.RecordBatch:
        host, k, node, text = ([x[i] for x in seen] for i in range(4))
        got = pa.RecordBatch.from_pydict(
            {
                "host": pa.array(host, pa.string()),
                "wrapper": pa.array(k, pa.int32()),
                "node": pa.array(node, pa.int32()),
                "text": pa.array(text, pa.int64()),
                "n": pa.array(list(seen.values()), pa.int64()),
                "own": pa.array([own[x] for x in seen], pa.int64()),
            }
        )
        seen.clear()
        own.clear()
        return got

    counts = distinct.select("host", "form", "nodes", "texts").join(wrappers, "host").mapInArrow(count, "host string, wrapper int, node int, text long, n long, own long")
    counts = counts.groupBy("host", "wrapper", "node", "text").agg(F.sum("n").alias("n"), F.sum("own").alias("own"))
    counts = counts.groupBy("host", "wrapper", "node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "text")).alias("top"), F.sum("own").alias("own"), F.max("own").alias("top_own"))
    kind = (
        F.when((F.col("own") >= MIN_PAGES) & (F.col("top_own") >= TEMPLATE_SHARE * F.col("own")), 0)
        .when((F.col("n") >= MIN_PAGES) & (F.col("top.n") >= TEMPLATE_SHARE * F.col("n")), 1)
        .when((F.col("pages") < MIN_PAGES) & (F.col("n") >= 2) & (F.col("top.n") == F.col("n")), 2)
    )
    constant = counts.join(sizes, "host").withColumn("kind", kind).where("kind is not null")
    template = constant.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("wrapper", "node", F.col("top.text").alias("text"), "kind"))).alias("template"))
    return land(wrappers.join(template, "host", "left"), "html-wrappers")


def main_text(source: str, wrappers: list[str] | None, template: list[dict] | None) -> str:
    """Blocks of the page's content slots, one a line."""
    page = Page(source)
    inside = [False] * len(page.parent)
    marked = [any(not page.noise[v] and page.tag[v] == t for v in range(1, len(page.parent))) for t in ("article", "main")]
    scope = "article" if marked[0] else "main" if marked[1] else ""
    for v in range(1, len(page.parent)):
        inside[v] = inside[page.parent[v]] or (page.tag[v] == scope and not page.noise[v])
    slots = [(v, t) for v, t in page.blocks if not page.noise[v] and (inside[v] or not scope)]
    if slots and wrappers and template:
        form, at = fold(page)
        own = best_of(form, wrappers)
        to = aligned(form, wrappers[own])
        fixed = {x["node"]: x for x in template if x["wrapper"] == own}
        texts = node_texts(page, at)
        for kinds in ((0, 1), (2,)):
            const = {v for v, t in texts.items() if (x := fixed.get(to[v])) and x["kind"] in kinds and (x["kind"] == 0 or x["text"] == t)}
            left = [(v, t) for v, t in slots if at[v] not in const]
            if kinds == (0, 1) or 2 * sum(len(t) for _, t in left) > sum(len(t) for _, t in slots):
                slots = left
    return "\n".join(t for _, t in slots)


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    wrappers = induce(pages.select("url", "html"))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html", host().alias("host")).join(wrappers, "host", "left")

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(h or "", w, t)
                for h, w, t in zip(batch.column("html").to_pylist(), batch.column("wrappers").to_pylist(), batch.column("template").to_pylist())
            ]
            yield pa.RecordBatch.from_pydict({"page_id": batch.column("page_id"), "url": batch.column("url"), "text": pa.array(texts, pa.string()), "n_chars": pa.array(map(len, texts), pa.int64())})

    return rows.mapInArrow(step, "page_id long, url string, text string, n_chars long")
