"""Main text of web pages, with what a site repeats on its pages removed.

A page is parsed to a tree once for its elements and once for its text. The structure decides first:
elements that are no article by their tag, role or class go. Every block element's subtree is hashed, also of
those that went (tag, text and the hashes inside; words in italics may recur in any article), and Spark counts per
host beside how many different rests of the article each hash occurs: copies of an article count once, as its blocks
stand beside the same rest in all of them. Subtrees beside at least ``min_pages`` rests and more than
``min_share`` of the host's different articles, or ``many_pages`` and ``many_share``, are the site's template and go as
well, wherever they stand. The shares keep passages and headings that a site holds in several articles.

No page is sent to another task for the counting: only hashes are. Pages with template subtrees then
meet the hashes to delete by a join on the page, as compressed blocks of text.
"""

from __future__ import annotations

import html as entities
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import materialise, slices, str_texts, text_batches

MIN_PAGES = 8
MIN_SHARE = 0.5
#: On so many pages, as in one section of a large site, a smaller share is enough.
MANY_PAGES = 100
MANY_SHARE = 0.1
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements whose content is no markup; none of them is text of an article.
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th"
    " thead tr ul".split()
)
#: Start tags that end an open element of the named tags, up to the nearest of the others.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
NO_ARTICLE_TAGS = frozenset(
    "nav aside footer form script style noscript template iframe button select dialog menu svg object canvas audio video"
    " textarea title head input label datalist noembed noframes xmp".split()
)
NO_ARTICLE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu".split())
NO_ARTICLE_NAMES = frozenset(
    "ad adbox ads adsbygoogle adslot adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " commentform commentlist comments comentarios commentaires consent cookie cookies copyright disclaimer disqus dropdown"
    " footer gdpr kommentare login masthead menu modal nav navbar navigation newsletter notice notices notification overlay"
    " pager pagination popup promo promoted promotion related recommended reply replies respond share sharing sidebar signup"
    " sitenav social sponsor sponsored submenu subscribe subscription tags teaser toolbar topbar widget widgets".split()
)
MAIN_TAGS = ("article", "main")
#: Elements deeper than this are read as siblings, as browsers do; no page is lost by it.
DEEPEST = 512
#: In an article's events: a block begins or ends.
EDGE = -1
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>""")
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""", re.I)


class Element:
    """An element: its tag, whether it can be part of an article, and its texts and elements in order."""

    __slots__ = ("children", "key", "names", "tag", "usable")

    def __init__(self, tag: str, attributes: str = ""):
        self.tag, self.children, self.key = tag, [], 0
        found = {name.lower(): value.strip("\"' ") for name, value in ATTRIBUTE.findall(attributes)} if attributes else {}
        self.names = set(re.split(r"[^a-z]+", f"{found.get('class', '')} {found.get('id', '')}".lower()))
        role = found.get("role", "").lower()
        hidden = "hidden" in found or found.get("aria-hidden", "").lower() == "true"
        self.usable = not (hidden or tag in NO_ARTICLE_TAGS or role in NO_ARTICLE_ROLES)
        if role == "main":
            self.tag = "main"


def parse(page: str) -> Element:
    """The page's tree. Unclosed, misnested and cut-off markup is read as far as it makes sense."""
    root = Element("html")
    stack, at, end, quoted = [root], 0, len(page), True
    while at < end:
        mark = page.find("<", at)
        if mark < 0:
            mark = end
        if mark > at:
            stack[-1].children.append(page[at:mark])
        if mark == end:
            break
        following = page[mark + 1 : mark + 2]
        if page.startswith("<!--", mark):
            close = page.find("-->", mark + 4)
            at = end if close < 0 else close + 3
            continue
        if following in ("!", "?"):
            close = page.find(">", mark)
            at = end if close < 0 else close + 1
            continue
        if not (following.isascii() and following.isalpha()) and not re.match(r"</[a-zA-Z]", page[mark : mark + 3]):
            if following == "/":  # </ without a name: up to >
                close = page.find(">", mark)
                at = end if close < 0 else close + 1
            else:
                stack[-1].children.append("<")
                at = mark + 1
            continue
        match = TAG.match(page, mark) if quoted else None
        if match:
            closing, name, attributes = match.groups()
            at = match.end()
        else:  # a quote or the tag is not closed: from here on tags end at the next >
            quoted = False
            close = page.find(">", mark)
            if close < 0:
                break
            closing, name, attributes = re.match(r"<(/?)([a-zA-Z][^\s/>]*)", page[mark:close]).groups() + ("",)
            at = close + 1
        name = name.lower()
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == name or (name in ("div", "section") and stack[depth].tag == "main" and depth):
                    del stack[depth:]
                    break
            continue
        element = Element(name, attributes)
        if name in RAW:
            close = re.compile(f"</{re.escape(name)}", re.I).search(page, at)
            at = end if close is None else page.find(">", close.start()) + 1 or end
            continue
        if name in BLOCK or name == "option":
            closes, stops = CLOSES.get(name, (set(), set()))
            for depth in range(len(stack) - 1, 0, -1):
                tag = stack[depth].tag
                if tag in closes or (tag == "p" and name in BLOCK):
                    del stack[depth:]
                    break
                if tag in stops or (tag in BLOCK and not closes):
                    break
        stack[-1].children.append(element)
        if name not in VOID and not attributes.endswith("/") and len(stack) < DEEPEST:
            stack.append(element)
    return root


def elements(root: Element):
    """All elements below, each before those inside it."""
    stack = [root]
    while stack:
        element = stack.pop()
        yield element
        stack.extend(c for c in reversed(element.children) if isinstance(c, Element))


def prune(root: Element) -> list[Element]:
    """Takes what is no article out of the tree; the elements whose text is the article's.

    These are the articles of the page, or else its main element, or else all of it. If every
    article stands in, or is, an element whose class or id says that it is none, these names do not
    count for the elements around articles.
    """
    order, holders, named_well = list(elements(root)), set(), False
    for element in reversed(order):
        if element.tag in MAIN_TAGS or any(isinstance(c, Element) and id(c) in holders for c in element.children):
            holders.add(id(element))
    stack = [(root, False)]
    while stack:
        element, named_badly = stack.pop()
        named_badly = named_badly or not element.usable or (element.tag not in ("html", "body") and bool(element.names & NO_ARTICLE_NAMES))
        named_well = named_well or (element.tag in MAIN_TAGS and not named_badly)
        stack.extend((c, named_badly) for c in element.children if isinstance(c, Element))
    for element in order:
        spared = element.tag in ("html", "body") or (not named_well and id(element) in holders)
        if element.usable and not spared:
            element.usable = not (element.names & NO_ARTICLE_NAMES)
    chosen: dict[str, list[Element]] = {"article": [], "main": []}
    stack = [(root, False, False)]
    while stack:
        element, inside, in_article = stack.pop()
        element.children = [c for c in element.children if not isinstance(c, Element) or c.usable]
        if element.tag == "header" and not inside and id(element) not in holders:
            element.children = []
        if element.tag == "article" and not in_article or element.tag == "main" and not inside:
            chosen[element.tag].append(element)
        inside = inside or element.tag in MAIN_TAGS
        in_article = in_article or element.tag == "article"
        stack.extend((c, inside, in_article) for c in reversed(element.children) if isinstance(c, Element))
    return chosen["article"] or chosen["main"] or [root]


def hash_subtrees(order: list[Element]) -> None:
    """Sets ``key`` of elements, given each before those inside it, from the tag, the text and the keys inside that
    can be part of an article."""
    from xxhash import xxh64_intdigest

    for element in reversed(order):
        parts = [element.tag]
        for child in element.children:
            if isinstance(child, Element):
                if child.usable:
                    parts.append(f"\x00{child.key}")
            else:
                parts.append(" ".join(child.split()))
        element.key = xxh64_intdigest("\x01".join(parts).encode("utf-8", "surrogatepass")) >> 1


def counts(element: Element) -> bool:
    """Whether the element's subtree is looked for on other pages."""
    return element.tag in BLOCK and element.tag not in ("html", "body", "main", "article")


def events(chosen: list[Element]) -> list:
    """The article in page order: the texts, EDGE where a block begins or ends, and around each subtree
    its key before it and None after it."""
    out: list = []
    for top in chosen:
        stack: list = [top]
        while stack:
            node = stack.pop()
            if not isinstance(node, Element):
                out.append(node)
                continue
            edge = [EDGE] if node.tag in BLOCK else [" "] if node.tag == "br" else []
            inside = [*edge, *node.children, *edge]
            if node is not top and counts(node):
                inside = [node.key, *inside, None]
            stack.extend(reversed(inside))
        out.append(EDGE)
    return out


def text_of(read: list, deleted: frozenset = frozenset()) -> str:
    """The blocks' texts, one a line, without deleted subtrees; references decoded, white space in a block one space."""
    lines, now, depth, gone_at = [], [], 0, 0

    def end_block():
        line = " ".join(entities.unescape("".join(now)).split())
        if line:
            lines.append(line)
        now.clear()

    for event in read:
        if event is None:
            if gone_at == depth:
                gone_at = 0
            depth -= 1
        elif event == EDGE:
            if not gone_at:
                end_block()
        elif isinstance(event, int):
            depth += 1
            if not gone_at and event in deleted:
                gone_at = depth
                now.append(" ")
        elif not gone_at:
            now.append(event)
    end_block()
    return "\n".join(lines)


def article(page: str) -> list:
    root = parse(page)
    chosen = prune(root)
    hash_subtrees(list(elements(root)))
    return events(chosen)


def rests(page: str) -> tuple[int, dict[int, int], set[int]]:
    """A number for the article's texts, for every subtree in it the number without that subtree, and the subtrees
    that stand only in what :func:`prune` takes out."""
    from xxhash import xxh64_intdigest

    root = parse(page)
    order = list(elements(root))
    chosen = prune(root)
    hash_subtrees(order)
    total, inside, open_ = 0, {}, []
    for event in events(chosen):
        if event is None:
            key, before = open_.pop()
            inside[key] = inside.get(key, 0) + total - before
        elif isinstance(event, int):
            if event != EDGE:
                open_.append((event, total))
        elif words := event.split():
            total += xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"))
    low = (1 << 63) - 1
    return total & low, {key: (total - own) & low for key, own in inside.items()}, {e.key for e in order if counts(e)} - inside.keys()


def host_of(url):
    """Lower-cased host of a url column; empty if there is none."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1))


def subtree_counts(pages: DataFrame) -> DataFrame:
    """``row``, ``host``, ``key``, ``rest``, ``inside`` of every distinct subtree of a page: the article's texts without it,
    by a number, and whether it is in the article; written. Under the key ``EDGE``, a row per page for the whole article."""
    import pyarrow as pa

    def hashed(batches):
        import numpy as np

        for batch in slices(batches, 256):
            keys, beside, inside, sizes = [], [], [], []
            for page in str_texts(batch.column(2)):
                total, own, others = rests(page)
                keys += [EDGE, *own, *others]
                beside += [total, *own.values(), *[total] * len(others)]
                inside += [False, *[True] * len(own), *[False] * len(others)]
                sizes.append(1 + len(own) + len(others))
            owner = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(owner),
                    batch.column(1).take(owner),
                    pa.array(keys, pa.int64()),
                    pa.array(beside, pa.int64()),
                    pa.array(inside, pa.bool_()),
                ],
                names=["row", "host", "key", "rest", "inside"],
            )

    hosts = pages.select("row", F.xxhash64(host_of(F.col("url"))).alias("host"), "html")
    return materialise(hosts.mapInArrow(hashed, "row bigint, host bigint, key bigint, rest bigint, inside boolean"), "subtrees")


def recurring(seen: DataFrame, min_pages: int, min_share: float, many_pages: int, many_share: float) -> DataFrame:
    """``host``, ``key`` of the subtrees that are template; written."""
    times = seen.select("host", "key", "rest").distinct().groupBy("host", "key").agg(F.count("*").alias("n"))
    times = times.filter((F.col("n") >= min(min_pages, many_pages)) | (F.col("key") == EDGE))
    articles = times.filter(F.col("key") == EDGE).select("host", F.col("n").alias("articles"))
    n, of = F.col("n"), F.col("articles")
    usual = (n >= min_pages) & (n > min_share * of)
    many = (n >= many_pages) & (n > many_share * of)
    found = times.filter(F.col("key") != EDGE).join(articles, "host").filter(usual | many)
    return materialise(found.select("host", "key"), "template")


def main_text(
    pages: DataFrame,
    min_pages: int = MIN_PAGES,
    min_share: float = MIN_SHARE,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    many_pages: int = MANY_PAGES,
    many_share: float = MANY_SHARE,
) -> DataFrame:
    """``page_id``, ``url`` and ``text`` per row.

    NULL or empty html, or a page that is template all over, has empty text. Pages without host
    count as one host's. Repeated rows and copied articles count once. Other columns are not read.
    """
    import pyarrow as pa

    text_batches(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("page_id"),
        F.col(url_col).cast("string").alias("url"),
        F.col(html_col).cast("string").alias("html"),
    )
    rows = rows.withColumn("row", F.xxhash64("page_id", "url", "html"))
    seen = subtree_counts(rows)
    template = recurring(seen, min_pages, min_share, many_pages, many_share)
    id_type = rows.schema["page_id"].dataType.simpleString()
    schema = f"page_id {id_type}, url string, text string"

    if template.isEmpty():

        def plain(batches):
            for batch in slices(batches, 256):
                texts = [text_of(article(p)) if p else "" for p in str_texts(batch.column(2))]
                columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["page_id", "url", "text"])

        return rows.select("page_id", "url", "html").mapInArrow(plain, schema)

    def taken_apart(batches):
        import zstandard

        for batch in slices(batches, 256):
            pieces = [article(p) if p else [] for p in str_texts(batch.column(3))]
            packed = [zstandard.ZstdCompressor(level=3).compress(json.dumps(x).encode()) for x in pieces]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array(packed, pa.binary())], names=["row", "page_id", "url", "pieces"]
            )

    def put_together(batches):
        import zstandard

        for batch in slices(batches, 256):
            pieces = [json.loads(zstandard.ZstdDecompressor().decompress(x)) for x in batch.column(2).to_pylist()]
            gone = batch.column(3).to_pylist()
            texts = [text_of(p, frozenset(g or ())) for p, g in zip(pieces, gone, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"]
            )

    apart = rows.select("row", "page_id", "url", "html").mapInArrow(
        taken_apart, f"row bigint, page_id {id_type}, url string, pieces binary"
    )
    deleted = seen.filter("inside").join(template, ["host", "key"]).groupBy("row").agg(F.collect_set("key").alias("gone"))
    return apart.join(deleted, "row", "left").select("page_id", "url", "pieces", "gone").mapInArrow(put_together, schema)
