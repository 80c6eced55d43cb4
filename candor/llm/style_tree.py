"""Main text of pages by a site style tree.

The pages of a host are laid over each other: elements with the same path of tags and classes are one node of the style tree. Per node the tree counts which
sequences of children occur (its presentations) and which texts occur (its contents). A node whose children look alike on all pages, or whose text is the same on
all pages, says nothing about a page; one that differs from page to page does. So the importance of a node is the entropy of its presentations, or one less
the mean entropy of its texts over the pages, whichever is larger, each between 0 and 1. A branch has the mean importance of its nodes, those d levels down with
weight 0.9^d. Branches below THRESHOLD are removed from the page, and so are those that HTML itself marks as no content (navigation, scripts, forms, class names
such as `ad` or `sidebar`, and compound names that end in one; those not for an article or main inside).

Within an `article` (or else `main`) only containers can be removed for low importance, not its own paragraphs and headings: copies of one article on a host
would otherwise lose their text. Without either the whole body is judged.

Counts are taken per Arrow batch first, then summed by node and feature, then by node; all of it sums, so a host with a third of all pages is no
single group. The only rows that meet a page again are the low nodes of its host, in a plain join that Spark may broadcast by their size as written.

Defined cases: NULL or empty html is the empty text. Pages of a NULL url form one host. Nodes seen fewer than LEAST times are kept. Repeated pages are rows of
their own. White space in a block becomes one space, blocks are joined by an empty line in page order. Columns other than the three named are not read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.llm.common import small_batches, text_of
from candor.session import scratch_path

THRESHOLD = 0.2
LEAST = 5
FADING = 0.9

# Fixed lists.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html"
    " legend li main menu nav ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
NO_CONTENT = frozenset(
    "head nav footer aside script style noscript template button select input textarea iframe object embed canvas svg audio video dialog menu title".split()
)
NO_CONTENT_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer header"
    " masthead topbar toolbar cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe subscription signup login share sharing social comment comments"
    " disqus reply replies related recommended recommendations pagination pager widget search copyright".split()
)
NO_CONTENT_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())
#: First parts of names that say something of an element's state or layout, and of names of headings that belong to the text.
STATES = frozenset("has with without no not is are show hide".split())
OF_TEXT = frozenset("article post entry story content section page".split())
#: Last parts of compound names that are as often part of a story's name as of boilerplate, as in `market-share` or `job-search`.
OPEN_NAMES = frozenset("share sharing search notice alert copyright widget pager toolbar overlay header menu banner promo social login".split())
#: What speaks against an element. DOUBTFUL: a form, or an open name, which may hold the whole page. NAMED: a compound name. An article or main inside either stays.
VISIBLE, DOUBTFUL, NAMED, HIDDEN = 0, 1, 2, 3
#: A start tag ends an open element of these, if it is nearer than the element that holds both.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
KEEPS = frozenset("ul ol dl table tbody thead tfoot body html div article section".split())
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre".split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']|"[^"]*"|'[^']*')*+[^>]*)>|<[!?][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_PARTS = re.compile(r"[a-z0-9]+")
_RAW_END = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}


class Node:
    __slots__ = ("children", "has_text", "inside", "label", "parent", "path", "skip", "tag", "text")

    def __init__(self, tag: str, label: str, parent: Node | None, skip: int) -> None:
        self.tag, self.label, self.parent, self.skip = tag, label, parent, skip
        self.path = f"{parent.path}>{label}" if parent else label
        self.children: list[str] = []
        self.text: list[str] = []
        # The nearest article and main around it, itself included.
        self.inside = (parent.inside if parent else frozenset()) | ({tag} if tag in ("article", "main") and not skip else frozenset())


def _named(tag: str, value: str) -> int:
    """What a class or id value says: HIDDEN if one of its names is listed, NAMED or DOUBTFUL if the last part of a compound name is, as in `user-comments` or `market-share`."""
    names = value.split()
    if not NO_CONTENT_NAMES.isdisjoint(names):
        return HIDDEN
    worst = VISIBLE
    if tag != "article":
        for name in names:
            parts = _PARTS.findall(name)
            if len(parts) > 1 and parts[-1] in NO_CONTENT_NAMES and parts[0] not in STATES and not (parts[-1] == "header" and parts[0] in OF_TEXT):
                worst = max(worst, DOUBTFUL if parts[-1] in OPEN_NAMES else NAMED)
    return worst


def _marked(tag: str, attributes: str, inside: frozenset) -> tuple[str, int]:
    """The label of an element, and whether HTML or its names mark it as no content."""
    classes, skip = "", HIDDEN if tag in NO_CONTENT or (tag == "header" and not inside) else DOUBTFUL if tag == "form" else VISIBLE
    seen = set()
    for m in _ATTRIBUTE.finditer(attributes or ""):
        key = m[1].lower()
        # Of an attribute that is repeated the first counts.
        if key not in ("class", "id", "role", "hidden") or key in seen:
            continue
        seen.add(key)
        value = (m[2] or m[3] or m[4] or "").lower()
        if key == "class":
            classes = ".".join(sorted(set(value.split())))
        if key == "hidden":
            skip = HIDDEN if value != "until-found" else skip
        elif key == "role":
            skip = HIDDEN if value in NO_CONTENT_ROLES else skip
        elif tag not in ("html", "body", "main"):
            skip = max(skip, _named(tag, value))
    return f"{tag}.{classes}" if classes else tag, skip


def parse(page: str) -> tuple[list[Node], list[tuple[Node, str]]]:
    """The block elements of a page, and its visible and doubtful blocks of text with the element that each lies in, in page order."""
    root = Node("", "", None, VISIBLE)
    nodes, blocks, stack = [], [], [root]
    opened: list[str] = [""]
    hidden: list[bool] = [False]
    pending: list[str] = []

    def flush() -> None:
        if pending:
            text = " ".join(entities.unescape("".join(pending)).split())
            pending.clear()
            if text:
                node = stack[-1]
                node.text.append(text)
                if node.skip <= DOUBTFUL:
                    blocks.append((node, text))

    def pop_to(depth: int) -> None:
        """Closes elements above `depth`; opened, hidden and stack go in step."""
        if any(opened[k] in BLOCK for k in range(depth, len(opened))):
            flush()
        del opened[depth:], hidden[depth:], stack[depth:]

    at = 0
    while True:
        m = _TOKEN.search(page, at)
        end = m.start() if m else len(page)
        if end > at and not hidden[-1]:
            pending.append(page[at:end])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            for k in range(len(opened) - 1, 0, -1):
                if opened[k] == tag:
                    pop_to(k)
                    break
            continue
        if tag in BLOCK:
            for ended in ("p", *ENDS.get(tag, ())):
                for k in range(len(opened) - 1, 0, -1):
                    if opened[k] == ended:
                        pop_to(k)
                        break
                    if opened[k] in KEEPS:
                        break
            flush()
        if tag == "br":
            pending.append("\n")
        if tag in VOID or (m[3] or "").endswith("/") and tag not in BLOCK:
            continue
        parent = stack[-1]
        label, skip = _marked(tag, m[3], parent.inside)
        if tag in RAW:
            close = _RAW_END[tag].search(page, at)
            at = close.start() if close else len(page)
            continue
        if tag in BLOCK:
            # A compound name may be one of layout: an article or main inside shows that its element is a wrapper.
            above = VISIBLE if tag in ("article", "main") and parent.skip < HIDDEN else parent.skip
            # Inside an inline element that is no content, such as noscript or a button, blocks are none either.
            node = Node(tag, label, parent, HIDDEN if hidden[-1] else max(above, skip))
            parent.children.append(label)
            nodes.append(node)
            stack.append(node)
            # What it hides is in its own state.
            hidden.append(False)
        else:
            stack.append(parent)
            hidden.append(hidden[-1] or skip > VISIBLE)
        opened.append(tag)
    flush()
    return nodes, blocks


def _key(host: str, path: str, memo: dict[str, int] = {}) -> int:  # noqa: B006
    name = f"{host}\n{path}"
    if len(memo) > 200_000:
        memo.clear()
    if name not in memo:
        memo[name] = int.from_bytes(hashlib.blake2b(name.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)
    return memo[name]


def _feature(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(text_of(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def style_tree(pages: DataFrame) -> DataFrame:
    """`node`, `host`, `up` (the nodes above, nearest first), how often it was seen, and its own importance."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            seen: Counter[tuple[int, bool, int]] = Counter()
            above: dict[int, tuple[str, list[int]]] = {}
            for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist()):
                for node in parse(page)[0]:
                    key = _key(host, node.path)
                    if key not in above:
                        ups, up = [], node.parent
                        while up is not None and up.parent is not None:
                            ups.append(_key(host, up.path))
                            up = up.parent
                        above[key] = (host, ups)
                    seen[key, False, _feature("\n".join(node.children))] += 1
                    for text in node.text:
                        seen[key, True, _feature(text)] += 1
            rows = [(k, c, f, n, None, None) for (k, c, f), n in seen.items()] + [(k, None, None, 0, h, u) for k, (h, u) in above.items()]
            kinds = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
            names = ("node", "content", "feature", "n", "host", "up")
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 6, kinds)], list(names))

    counted = pages.select(host_of(F.col("url")).alias("host"), text_of(F.col("html")).alias("html")).mapInArrow(
        count, "node long, content boolean, feature long, n long, host string, up array<long>"
    )
    features = counted.groupBy("node", "content", "feature").agg(F.sum("n").alias("n"), F.max("host").alias("host"), F.max("up").alias("up"))
    shown, said = F.col("content") == F.lit(False), F.col("content") == F.lit(True)
    per_node = features.groupBy("node").agg(
        F.max("host").alias("host"), F.max("up").alias("up"),
        F.sum(F.when(shown, F.col("n"))).alias("m"), F.sum(F.when(shown, F.col("n") * F.log("n"))).alias("shown_log"),
        F.sum(F.when(said, F.col("n"))).alias("m_said"), F.count(F.when(said, 1)).alias("texts"), F.sum(F.when(said, F.log("n"))).alias("said_log"),
    )
    presentation = 1 - F.col("shown_log") / F.col("m") / F.log("m")
    content = 1 - F.col("said_log") / F.col("texts") / F.log("m_said")
    own = F.when(F.col("m") < LEAST, F.lit(1.0)).otherwise(
        F.greatest(F.coalesce(F.when(F.col("m") > 1, presentation), F.lit(0.0)), F.coalesce(F.when(F.col("m_said") > 1, content), F.when(F.col("texts") > 0, F.lit(1.0)), F.lit(0.0)))
    )
    return per_node.select("node", "host", "up", F.col("m").alias("times"), own.alias("importance"))


def low_nodes(tree: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per host the nodes whose branch has a low importance."""
    line = F.transform(F.concat(F.array("node"), "up"), lambda node, d: F.struct(node.alias("node"), F.pow(F.lit(FADING), d).alias("weight")))
    spread = tree.select("node", "host", "times", "importance", F.explode(line).alias("to"))
    branch = spread.groupBy(F.col("to.node").alias("node")).agg(
        F.max("host").alias("host"), F.max(F.when(F.col("node") == F.col("to.node"), F.col("times"))).alias("times"),
        (F.sum(F.col("importance") * F.col("to.weight")) / F.sum("to.weight")).alias("importance"),
    )
    return branch.where((F.col("importance") < threshold) & (F.col("times") >= LEAST)).groupBy("host").agg(F.collect_list("node").alias("low"))


def _text(host: str, page: str, low: set[int]) -> str:
    _, blocks = parse(page)

    def removed(node: Node, within: str | None) -> bool:
        own = True
        while node.parent is not None and node.tag not in (within, "body", "html"):
            flow = own and node.tag in FLOW and within is not None
            if not flow and _key(host, node.path) in low:
                return True
            own = own and node.tag in FLOW
            node = node.parent
        return False

    def kept(chosen: list[tuple[Node, str]], within: str | None) -> list[tuple[Node, str]]:
        return [(n, t) for n, t in chosen if not low or not removed(n, within)]

    def prose(chosen: list[tuple[Node, str]]) -> int:
        return sum(len(t) for n, t in chosen if n.tag in FLOW)

    def joined(chosen: list[tuple[Node, str]]) -> str:
        return "\n\n".join(t for _, t in chosen)

    visible = [(n, t) for n, t in blocks if n.skip == VISIBLE]
    found: list[tuple[Node, str]] = []
    for within in ("article", "main"):
        found = kept([(n, t) for n, t in visible if within in n.inside], within)
        if found:
            # Where more prose stands outside, articles are teasers beside the story.
            outside = kept([(n, t) for n, t in visible if within not in n.inside], None)
            if prose(outside) <= prose(found):
                break
            found = outside
            break
    else:
        found = kept(visible, None)
    # A form or an element of an open name is the page itself if it holds more prose than all else.
    doubtful = kept([(n, t) for n, t in blocks if n.skip == DOUBTFUL], None)
    if prose(doubtful) > prose(found):
        chosen = {id(n) for n, _ in (*found, *doubtful)}
        return joined([(n, t) for n, t in blocks if id(n) in chosen])
    return joined(found)


def extract(pages: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`page_id`, `url` and the main `text` of every page."""
    path = scratch_path(pages.sparkSession, "style_tree")
    low_nodes(style_tree(pages), threshold).write.parquet(path)
    low = pages.sparkSession.read.parquet(path)
    rows = pages.select("page_id", "url", host_of(F.col("url")).alias("host"), text_of(F.col("html")).alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, "html"):
            hosts = batch.column("host").to_pylist()
            # The pages of a host share one list.
            lows = {host: set(batch.column("low")[i].as_py() or ()) for host, i in {h: i for i, h in enumerate(hosts)}.items()}
            texts = [_text(host, page, lows[host]) for host, page in zip(hosts, batch.column("html").to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], ["page_id", "url", "text"])

    schema = f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string"
    return rows.join(low, "host", "left").select("page_id", "url", "host", "html", "low").mapInArrow(run, schema)
