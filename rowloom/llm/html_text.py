"""Main text of web pages, with site template removal.

A page is parsed into text blocks and element subtrees, each subtree with a hash of its tags and text. Subtrees are
counted per host in Spark, over pages of unlike content; a subtree that recurs on many of its host's pages is the site's
template, and all blocks in it are deleted. What does not recur, or on too small a host to tell, is left to rules on tags
and roles (navigation, forms and the like) and on class names with a second sign (adverts, reader comments). Where a page
has article elements that hold a good part of its text, the text is theirs.

Only containers are template: a paragraph, heading, list item or cell that recurs by itself is a text that pages share.
Deletion and rules each take blocks away, so their order does not matter; pages of whose main text no subtree could be
template are therefore not moved to meet the counts (see `removed` for what each of the two takes).
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowloom.llm.batches import sliced, texts
from rowloom.llm.rows import located, new_name, row_key
from rowloom.llm.tables import written

#: Elements without content, elements whose content is never text, elements that end a block (fixed values of HTML).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript svg math iframe object canvas video audio".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td "
    "textarea tfoot th thead tr ul".split()
)
#: Elements that are not main text by their tag or their role.
OUTSIDE = frozenset("nav header footer aside form menu button select textarea dialog head fieldset search label input".split()) | RAW
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words in a class or id that name something else than main text: such as say so wherever they stand, and such as do
#: only beside words for the parts of a page. A class that says what its element has or lacks (has-sidebar) names no such thing.
SURE = re.compile(
    r"(?:ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|popup|modal|navbar|nav|navigation|breadcrumbs?|masthead|footer|sidebar|newsletter|"
    r"comments?|commentlist|disqus|pagination|pager|toolbar|copyright)\d*",
    re.IGNORECASE,
)
UNSURE = re.compile(
    r"(?:banner|notice|alert|overlay|menu|header|side|widgets?|related|recommend\w*|share|sharing|social|subscribe|signup|login|search|respond|responses|replies|reply|skip|legal)\d*",
    re.IGNORECASE,
)
PARTS = frozenset(
    "site page main post posts blog article box bar block wrap wrapper container area section list item items link links button buttons top bottom "
    "left right inner outer global primary secondary mobile desktop icons icon module unit slot col column row panel form small".split()
)
STATES = ("has-", "no-", "with-", "without-", "is-", "not-")


def names_other(given: dict, in_article: bool) -> str:
    """`sure` or `unsure` where an element's class or id names something else than main text, else an empty text. In an
    article, its own header doesn't."""
    names = f"{given.get('class') or ''} {given.get('id') or ''}".lower().split()
    found = ""
    for name in names:
        parts = [part for part in re.split("[_-]+", name) if part and not part.isdigit()]
        if name.startswith(STATES) or (in_article and "header" in parts):
            continue
        hits = [bool(SURE.fullmatch(part)) + 2 * bool(UNSURE.fullmatch(part)) for part in parts]
        if any(hits) and all(hit or part in PARTS for hit, part in zip(hits, parts)):
            found = "sure" if 1 in hits else found or "unsure"
    return found


#: Elements that a start tag closes when they are open (fixed values of HTML).
_P_ENDS = BLOCK - {"br", "body", "html", "caption", "tbody", "td", "tfoot", "th", "thead", "tr", "option", "optgroup", "legend", "textarea", "select"}
#: Blocks that an inline end tag does not close.
_HELD = BLOCK - {"br"}
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
}
#: Blocks that carry the text itself: they are never template by themselves.
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre td th dd dt figcaption caption tr legend summary option br hr".split())
#: Containers that an article's own text may lie in: inside an article, recurrence alone does not make them template.
OWN = frozenset("tbody thead tfoot table ul ol dl figure article main".split())


class Node:
    __slots__ = ("tag", "parent", "outside", "article", "digest", "deletable", "hash", "number", "named")

    def __init__(self, tag: str, parent: Node | None, outside: bool, article: bool, number: int, named: str = ""):
        self.named = named
        self.tag, self.parent, self.outside, self.article, self.number = tag, parent, outside, article, number
        self.digest, self.hash = xxhash.xxh3_64(tag.encode()), 0
        self.deletable = tag in BLOCK and tag not in LEAVES and tag not in ("html", "body") and not (article and tag in OWN)


class Page(HTMLParser):
    """blocks: (text, innermost node) in page order, without raw elements."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.top = self.at = Node("html", None, False, False, 0)
        self.open_tags = Counter(["html"])
        self.blocks: list[tuple[str, Node]] = []
        self.parts: list[str] = []
        self.holder = self.top
        self.raw = 0
        self.nodes = [self.top]
        self.linked: dict[int, int] = {}  # characters of links, by the node that they lie in
        self.feed(html)
        self.close()
        self._flush()
        while self.at is not None:
            self._leave()

    def _flush(self) -> None:
        if self.parts:
            text = " ".join("".join(self.parts).split())
            self.parts = []
            if text:
                self.blocks.append((text, self.holder))

    def _leave(self) -> None:
        node = self.at
        self.open_tags[node.tag] -= 1
        node.hash = int.from_bytes(node.digest.digest(), "big", signed=True)
        if node.parent is not None:
            node.parent.digest.update(node.digest.digest())
        self.at = node.parent

    def _close_to(self, node: Node) -> None:
        if node.tag in BLOCK or node.outside != node.parent.outside or node.named:
            self._flush()
        while self.at is not node:
            self._leave()
        self._leave()

    def _open(self, tags: frozenset | set, stop: frozenset | set) -> Node | None:
        if not any(map(self.open_tags.__getitem__, tags)):
            return None
        node = self.at
        while node is not None and node.tag not in stop:
            if node.tag in tags:
                return node
            node = node.parent
        return None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            return
        if tag in ("html", "body") and self._open({tag}, frozenset()):
            return
        if tag in _P_ENDS and (found := self._open({"p"}, {"article", "div", "section", "td", "li", "button"})):
            self._close_to(found)
        if tag in _CLOSES and (found := self._open(*_CLOSES[tag])):
            self._close_to(found)
        given = dict(attrs)
        named = "" if tag in ("html", "body", "article", "main") else names_other(given, self.at.article)
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
        own_header = tag in ("header", "hgroup") and self.at.article
        outside = self.at.outside or (tag in OUTSIDE and not own_header) or (given.get("role") or "").lower() in ROLES or hidden
        node = Node(tag, self.at, outside, self.at.article or tag in ("article", "main") or (given.get("role") or "").lower() in ("main", "article"), len(self.nodes), named)
        if outside != self.at.outside or named:
            self._flush()
        self.at = node
        self.open_tags[tag] += 1
        self.nodes.append(node)
        self.raw += tag in RAW

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag not in BLOCK:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            if tag == "br":
                self._flush()
            return
        if tag in BLOCK:
            self._flush()
        if found := self._open({tag}, frozenset()):
            if tag not in BLOCK and self._open(_HELD, {tag}):
                return  # an inline end tag does not close blocks that were opened within
            if found is self.top:
                return
            inner = self.at
            while inner is not found:
                self.raw -= inner.tag in RAW
                inner = inner.parent
            self.raw -= tag in RAW
            self._close_to(found)

    def handle_data(self, data: str) -> None:
        if self.raw:
            return
        if not self.parts:
            self.holder = self.at
        self.parts.append(data)
        if self.open_tags["a"] and not data.isspace():
            self.linked[self.at.number] = self.linked.get(self.at.number, 0) + len(" ".join(data.split()))
        if not data.isspace():
            self.at.digest.update(data.encode("utf-8", "surrogatepass"))


def _named_gone(page: Page, main: list[tuple[str, Node]]) -> list[bool]:
    """For each node, whether it lies in an element that its class or id names as something else and for which a second sign
    speaks: half of its text is links; or without all such elements there is a main text, no shorter than the
    element where the name is unsure."""
    n = len(page.nodes)
    top, size, links = [-1] * n, [0] * n, [0] * n  # top: the outermost named element around each node
    for node in page.nodes:
        above = top[node.parent.number] if node.parent else -1
        top[node.number] = above if above >= 0 else node.number if node.named else -1
    rest = 0
    for text, node in main:
        if (at := top[node.number]) >= 0:
            size[at] += len(text)
        else:
            rest += len(text)
    for number, chars in page.linked.items():
        if top[number] >= 0 and not page.nodes[number].outside:
            links[top[number]] += chars
    gone = [False] * n
    for node in page.nodes:
        if (at := top[node.number]) >= 0:
            sure = page.nodes[at].named == "sure"
            gone[node.number] = 2 * links[at] >= size[at] or (rest > 0 and (sure or size[at] <= rest))
    return gone


def main_blocks(page: Page) -> list[tuple[str, Node]]:
    """The blocks that the rules leave: those outside elements that are never main text or are named as something else
    with a second sign. Of these only those of article elements, where these hold a third of the text or more; a shorter
    article is a teaser beside the text."""
    main = [(text, node) for text, node in page.blocks if not node.outside]
    if any(node.named for node in page.nodes):
        gone = _named_gone(page, main)
        main = [(text, node) for text, node in main if not gone[node.number]]
    articles = [(text, node) for text, node in main if node.article]
    return articles if 3 * sum(len(text) for text, _ in articles) >= sum(len(text) for text, _ in main) else main


def outline(html: str) -> dict:
    """subtrees: hashes of the subtrees that may be template; whole: that of the page. Where no such subtree holds any
    main text, text is all of it. Else texts has the blocks, at the node of each, parents the nodes' parents (their
    numbers are smaller) and hashes the nodes' own, zero for those that are no template."""
    page = Page(html)
    main, subtrees = main_blocks(page), sorted({node.hash for node in page.nodes if node.deletable})
    found = {"text": None, "texts": None, "at": None, "parents": None, "hashes": None, "subtrees": subtrees, "whole": page.top.hash}
    covered = [False] * len(page.nodes)
    for node in page.nodes:
        covered[node.number] = node.deletable or (node.parent is not None and covered[node.parent.number])
    if not any(covered[node.number] for _, node in main):
        return found | {"text": " ".join(text for text, _ in main)}
    return found | {
        "texts": [text for text, _ in main], "at": [node.number for _, node in main],
        "parents": [node.parent.number if node.parent else -1 for node in page.nodes], "hashes": [node.hash if node.deletable else 0 for node in page.nodes],
    }


def left(texts: list[str], at: list[int], parents: list[int], hashes: list[int], deleted: list[int] | None) -> str:
    """The blocks that lie in no deleted subtree."""
    gone, dead = set(deleted or ()), []
    for parent, value in zip(parents, hashes):
        dead.append((parent >= 0 and dead[parent]) or (value != 0 and value in gone))
    return " ".join(text for text, node in zip(texts, at) if not dead[node])


KINDS = {
    "text": pa.string(), "texts": pa.list_(pa.string()), "at": pa.list_(pa.int32()), "parents": pa.list_(pa.int32()), "hashes": pa.list_(pa.int64()),
    "subtrees": pa.list_(pa.int64()), "whole": pa.int64(),
}
OUTLINE = "text string, texts array<string>, at array<int>, parents array<int>, hashes array<long>, subtrees array<long>, whole long"


def outlines(pages: DataFrame, *carried: str) -> DataFrame:
    """The carried columns of pages, then those of OUTLINE for each row. A null html is an empty one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 128):
            found = [outline(text) for text in texts(batch.column("html"))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array([x[name] for x in found], kind) for name, kind in KINDS.items())], [*carried, *KINDS])

    rows = pages.select(*carried, "html")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[:-1])
    return rows.mapInArrow(run, f"{schema}, {OUTLINE}")


def host(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_parse_url(url, F.lit("HOST")), F.lit("")))


def templates(outlined: DataFrame, least_pages: int, least_share: float) -> DataFrame:
    """host, subtree: subtrees on `least_pages` or more pages of unlike content of a host, and on `least_share` of them.
    Copies of one page count once; counts are summed on the map side first."""
    each = outlined.select("host", "whole", F.explode("subtrees").alias("subtree")).distinct()
    counts = each.groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_pages)
    sizes = outlined.select("host", "whole").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= least_pages)
    return counts.join(sizes, "host").where(F.col("n") >= F.col("pages") * least_share).select("host", "subtree")


def main_text(pages: DataFrame, least_pages: int = 5, least_share: float = 0.05) -> DataFrame:
    """One row per input row: page_id, url, text, n_chars (code points).

    Blocks have their white space turned into single blanks and are joined by a blank, in page order. A page without
    main text, or with null or empty html, has an empty text. A null url or one without a host counts as a host of its
    own. Null and repeated page_ids are rows like others, each with its own host; repeated rows stay repeated; an empty
    table gives an empty result; other columns are not looked at."""
    rows, key = located(pages), new_name("row")
    rows = rows.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host(F.col("url")).alias("host"), row_key(rows).alias(key))
    parsed = written(outlines(rows, "page_id", "url", "host", key), "outlines", compression="zstd")
    # a hot subtree is one key of the join below; as its other side is a table of its own, adaptive execution can split it
    found = written(templates(parsed, least_pages, least_share), "templates")
    settled = parsed.where("texts IS NULL").select("page_id", "url", "text")
    parts = ["texts", "at", "parents", "hashes"]
    open_pages = parsed.where("texts IS NOT NULL").select("page_id", "url", "host", key, "subtrees", *parts)
    marks = open_pages.select(key, "host", F.explode("subtrees").alias("subtree"))
    deleted = marks.join(found, ["host", "subtree"]).groupBy(key).agg(F.collect_set("subtree").alias("deleted"))
    joined = open_pages.join(deleted, key, "left").select("page_id", "url", *parts, "deleted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 128):
            text = [left(*row) for row in zip(*(column.to_pylist() for column in batch.columns[2:]))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(text, pa.string())], ["page_id", "url", "text"])

    out = settled.union(joined.mapInArrow(run, "page_id long, url string, text string"))
    return out.withColumn("n_chars", F.length("text").cast("long"))


def removed(pages: DataFrame, least_pages: int = 5, least_share: float = 0.05) -> DataFrame:
    """host, n_pages, n_chars (of all text outside scripts and the like), by_template (of these, what template removal
    alone takes), by_rules (what the rules take besides), main: what each step of the operator does to a host's text."""
    rows, key = located(pages), new_name("row")
    rows = rows.select("html", host(F.col("url")).alias("host"), row_key(rows).alias(key))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, 128):
            out: dict[str, list] = {"whole": [], "subtrees": [], "parents": [], "hashes": [], "chars": [], "main": []}
            for page in map(Page, texts(batch.column("html"))):
                chars, main = [0] * len(page.nodes), [0] * len(page.nodes)
                for text, node in page.blocks:
                    chars[node.number] += len(text)
                for text, node in main_blocks(page):
                    main[node.number] += len(text)
                parents = [node.parent.number if node.parent else -1 for node in page.nodes]
                hashes = [node.hash if node.deletable else 0 for node in page.nodes]
                for name, value in zip(out, (page.top.hash, sorted({*hashes} - {0}), parents, hashes, chars, main)):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([batch.column("host"), batch.column(key), *map(pa.array, out.values())], ["host", key, *out])

    schema = f"host string, {key} binary, whole long, subtrees array<long>, parents array<long>, hashes array<long>, chars array<long>, main array<long>"
    parsed = written(rows.mapInArrow(sizes, schema), "sizes")
    found = written(templates(parsed, least_pages, least_share), "templates")
    deleted = parsed.select(key, "host", F.explode("subtrees").alias("subtree")).join(found, ["host", "subtree"]).groupBy(key).agg(F.collect_set("subtree").alias("deleted"))

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            out = []
            for parents, hashes, chars, main, deleted in zip(*(column.to_pylist() for column in batch.columns[1:])):
                gone, dead = set(deleted or ()), []
                for parent, value in zip(parents, hashes):
                    dead.append((parent >= 0 and dead[parent]) or (value != 0 and value in gone))
                kept = sum(m for m, d in zip(main, dead) if not d)
                by_template = sum(c for c, d in zip(chars, dead) if d)
                out.append((sum(chars), by_template, sum(chars) - by_template - kept, kept))
            yield pa.RecordBatch.from_arrays([batch.column("host"), *map(pa.array, zip(*out))], ["host", "n_chars", "by_template", "by_rules", "main"])

    each = parsed.join(deleted, key, "left").select("host", "parents", "hashes", "chars", "main", "deleted")
    each = each.mapInArrow(tally, "host string, n_chars long, by_template long, by_rules long, main long")
    return each.groupBy("host").agg(F.count(F.lit(1)).alias("n_pages"), *(F.sum(c).alias(c) for c in ("n_chars", "by_template", "by_rules", "main")))
