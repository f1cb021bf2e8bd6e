"""Main text of web pages: element subtrees that recur across a host's pages are its template and go."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venuekit.session import materialize

# Elements of HTML by what they mean for a page's text.
NO_TEXT = frozenset("script style noscript template iframe svg canvas object embed audio video map math head title".split())
RAW = frozenset("script style textarea title iframe noscript xmp noembed noframes".split())
NOT_ARTICLE = frozenset("nav header footer aside form menu dialog button select textarea input label fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "html body address article aside blockquote center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2"
    " h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split()
)
FLOW = frozenset("p h1 h2 h3 h4 h5 h6 li ul ol dl dt dd blockquote pre table thead tbody tfoot tr td th figure figcaption".split())
CLOSES_P = BLOCK - frozenset("br td th tr tbody thead tfoot html body".split())
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "p": ("p",)}
#: elements nested deeper than this become children of the one at this depth, as in browsers
DEPTH = 512
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
SCOPE = frozenset("article section div table td th ul ol dl body html main aside nav header footer form blockquote".split())
# Words in class, id and role that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu breadcrumb"
    " breadcrumbs sidebar footer header cookie cookies consent notice notices newsletter subscribe signup popup modal overlay"
    " comment comments reply replies respond disqus share sharing social related recommended widget pagination pager toolbar"
    " skip login search contentinfo complementary alert hidden".split()
)
# Words that say only where or in what shape a marked element stands.
PLAIN = frozenset("site page main top bottom left right global primary secondary box bar list block area link links item items".split())


def _tags(html: str):
    """(begin, end, closes, name, attributes) of the page's tags in order; comments and the like have no name.

    A tag ends at the first ``>`` outside of quotes. Where there is none up to the end of the page, its quotes are broken, and
    this and all later tags end at their first ``>``: so no part of a page is gone through more than twice.
    """
    import re

    opening, plain = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)"), re.compile("[^>\"']*")
    n, at, broken = len(html), html.find("<"), False
    while at >= 0:
        head = opening.match(html, at)
        if not head:
            if html.startswith("<!--", at):
                end = html.find("-->", at + 4)
                end = n if end < 0 else end + 3
            elif html[at + 1 : at + 2] in ("!", "?", "/"):
                end = html.find(">", at) + 1
            else:
                end = 0
            if end:
                yield at, end, "", "", ""
            at = html.find("<", end or at + 1)
            continue
        end = head.end()
        while not broken:
            end = plain.match(html, end).end()
            if end == n or html[end] == ">":
                break
            end = html.find(html[end], end + 1) + 1 or n
        if broken or end == n:
            broken, end = True, html.find(">", head.end())
            end = n if end < 0 else end
        at = (yield at, min(end + 1, n), head[1], head[2].lower(), html[head.end() : end]) or html.find("<", end)


def parse(html: str) -> list:
    """The page as a tree of [tag, attributes, children]; children are such lists or strings of raw text.

    Tags that may be left open are closed as browsers do; end tags that close nothing are passed over.
    """
    import re

    root: list = ["#root", "", []]
    stack, at, n = [root], 0, len(html)
    tags, after = _tags(html), None
    while True:
        try:
            begin, end, closes, name, attributes = tags.send(after)
        except StopIteration:
            break
        after = None
        if begin > at:
            stack[-1][2].append(html[at:begin])
        at = end
        if not name:
            continue
        if closes:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == name:
                    del stack[i:]
                    break
            continue
        if end == n and html[end - 1] != ">":  # cut off
            continue
        if name in CLOSES_P or name in SAME:
            names = SAME.get(name, ("p",)) + (("p",) if name in CLOSES_P else ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in names:
                    del stack[i:]
                    break
                if stack[i][0] in SCOPE:
                    break
        node: list = [name, attributes, []]
        stack[-1][2].append(node)
        if name in RAW:
            found = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)", re.I).search(html, at)
            after = found.start() if found else n
            node[2].append(html[at:after])
            at = after
        elif name not in VOID and not attributes.endswith("/") and len(stack) < DEPTH:
            stack.append(node)
    if at < n:
        stack[-1][2].append(html[at:])
    return root


def _hidden(attributes: str) -> bool:
    import re

    shut = r"(?:^|\s)hidden(?=[\s=]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true"
    return bool(attributes) and bool(re.search(shut, attributes, re.I))


def _named(tag: str, attributes: str) -> bool:
    """Whether one of an element's classes, its id or its role says that it is not part of an article.

    A name says so if it is made of such words, and of words for place and shape, only: ``cookie-notice`` and ``site-footer``
    do, ``no-sidebar``, ``content-sidebar-wrap`` and ``related-work`` do not. The id of a heading or paragraph is its address.
    """
    import re

    if not attributes or tag in ("html", "body", "main", "article"):
        return bool(attributes) and tag == "article" and bool(re.search(r"\bcomments?\b", attributes))
    found = re.findall(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", attributes, re.I)
    for kind, *values in found:
        if kind.lower() == "id" and (tag == "p" or tag in HEADINGS):
            continue
        for name in "".join(values).split():
            words = {w for w in re.split(r"[^a-z]+", re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower()) if w}
            if not MARKS.isdisjoint(words) and words <= MARKS | PLAIN:
                return True
    return False


def _marked(root) -> set[int]:
    """The elements that by their tag, class, id or role are not part of an article.

    Hidden elements are, whatever they hold. Of the others none is that holds more than half of the page's text in
    paragraphs, so that a form or a wrapper around everything does not take the page with it.
    """
    told: dict[int, int] = {}

    def told_in(node, inside: bool) -> int:
        """Characters of paragraphs in an element."""
        inside = inside or node[0] == "p"
        total = 0
        for child in node[2]:
            if type(child) is list:
                total += 0 if child[0] in NO_TEXT else told_in(child, inside)
            elif inside:
                total += len(child)
        told[id(node)] = total
        return total

    whole = told_in(root, False)
    out: set[int] = set()

    def mark(node) -> None:
        for child in node[2]:
            if type(child) is not list or child[0] in NO_TEXT:
                continue
            tag, attributes = child[0], child[1]
            if _hidden(attributes) and tag not in ("html", "body"):
                out.add(id(child))
            elif (tag in NOT_ARTICLE or _named(tag, attributes)) and not (whole and 2 * told[id(child)] > whole):
                out.add(id(child))
            mark(child)

    mark(root)
    return out


def page_parts(html: str) -> tuple[list[tuple[str, list[int]]], list[int]]:
    """(blocks, subtrees): the text blocks of the page's main part, each with the hashes of the elements around it that
    could be template, and the hashes of all such elements of the page.

    The main part is its articles, else its main elements, else the whole page, less what names itself something else. An
    article inside such an element counts if there is no other. In an article or main element, paragraphs, headings, lists
    and tables are its own text; only other elements can be template there. Elsewhere every element can. All elements are
    counted, wherever they are and whatever their size.

    An element's hash is that of its content; for text elements also that of the path of elements from the root to it, with the
    place of each among its neighbours, so that a heading or a line that comes up now here, now there is none of the
    template. What a host's pages say in the same words at just the same place is taken for template.
    """
    import html as entities

    import xxhash

    root = parse(html)
    marked = _marked(root)
    mains: dict[str, list] = {"article": [], "main": []}
    others: list = []

    def find(node, inside: bool, aside: bool) -> None:
        for child in node[2]:
            if type(child) is list and child[0] not in NO_TEXT:
                tag, apart = child[0], aside or id(child) in marked
                kind = tag if tag in mains else "main" if 'role="main"' in child[1] else ""
                if kind and not (inside and kind == "article"):
                    if not apart:
                        mains[kind].append(child)
                    elif kind == "article" and id(child) not in marked and not _hidden(child[1]):
                        others.append(child)
                find(child, inside or kind == "article", apart)

    find(root, False, False)
    parts = mains["article"] or _outermost(mains["main"]) or _outermost(others) or [root]
    whole = parts == [root]
    subtrees: set[int] = set()
    content: dict[int, int] = {}
    known: dict[int, int] = {}

    def digest(node) -> int:
        """Hash of an element's name and of all that it holds."""
        inner = [node[0]]
        for child in node[2]:
            inner.append(f"<{digest(child)}>" if type(child) is list else " ".join(child.split()))
        content[id(node)] = xxhash.xxh3_64_intdigest("\x1f".join(c for c in inner if c))
        return content[id(node)]

    def place(node, path: int) -> None:
        """Hashes of the elements below, those of text elements with their paths."""
        spot = 0
        for child in node[2]:
            if type(child) is list:
                spot += 1
                own = xxhash.xxh3_64_intdigest(f"{path}/{child[0]}/{spot}")
                at = own if child[0] in FLOW else ""
                known[id(child)] = xxhash.xxh3_64_intdigest(f"{at}:{content[id(child)]}") >> 1
                place(child, own)

    digest(root)
    place(root, 0)
    blocks: list[list] = []
    open_text: list[str] = []

    def flush(around) -> None:
        text = " ".join(entities.unescape("".join(open_text)).split())
        open_text.clear()
        if text:
            blocks.append([text, around])

    def walk(node, around: tuple) -> None:
        for child in node[2]:
            if type(child) is str:
                open_text.append(child)
                continue
            tag = child[0]
            if tag in NO_TEXT or id(child) in marked:
                if tag in BLOCK:
                    flush(around)
                continue
            can_go = tag not in VOID and tag not in ("html", "body", "article", "main") and (whole or tag not in FLOW and tag in BLOCK)
            inner = (*around, known[id(child)]) if can_go else around
            if tag in BLOCK or can_go:
                flush(around)
            walk(child, inner)
            if tag in BLOCK or can_go:
                flush(inner)

    for part in parts:
        flush(())
        walk(part, ())
        flush(())

    def count(node) -> None:
        for child in node[2]:
            if type(child) is list:
                if child[0] not in NO_TEXT and child[0] not in VOID and child[0] not in ("html", "body"):
                    subtrees.add(known[id(child)])
                count(child)

    count(root)
    return [(text, sorted(set(around))) for text, around in blocks], sorted(subtrees)


def _outermost(nodes: list) -> list:
    """Nodes that are not inside an earlier one of the list."""
    out: list = []
    inner: set[int] = set()

    def mark(node) -> None:
        for child in node[2]:
            if type(child) is list:
                inner.add(id(child))
                mark(child)

    for node in nodes:
        if id(node) not in inner:
            out.append(node)
            mark(node)
    return out


def _parts(batches):
    for rows in batches:
        for begin in range(0, len(rows), 500):
            part = rows.iloc[begin : begin + 500]
            found = [page_parts(h) for h in part.html]
            yield part.drop(columns="html").assign(
                blocks=[[{"text": t, "around": a} for t, a in blocks] for blocks, _ in found],
                subtrees=[s for _, s in found],
            )


def host_of(url: Column) -> Column:
    """The host of a URL in lower case, without user and port; null if there is none."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def main_text(pages: DataFrame, least_pages: int = 4) -> DataFrame:
    """(page_id, url, text): the main text of every page; null html: empty.

    Pages are parsed once into blocks of text and hashes of element subtrees. Subtrees are counted by host; one that is on
    ``least_pages`` or more different pages of its host is template, and blocks inside it go, however many pages the host
    has. Pages are different if the text of their main parts is: copies of a page under other urls count as one.
    Character references are decoded; white space in a block becomes one space; blocks are joined by one. Pages without a
    host in their url lose no subtrees. Rows that repeat are treated alike and count as one page; null ids and urls are
    kept.

    Scale: a hot host's subtrees are dealt by host, subtree and page and summed before they meet by host and subtree. Only pages that hold candidates in their main part are joined, by their
    own hash and not by host; their text moves once.
    """
    kinds = dict(pages.dtypes)
    whole = pages.select(
        "page_id", "url", host_of(F.col("url")).alias("host"), F.coalesce("html", F.lit("")).alias("html")
    ).withColumn("page", F.xxhash64("url", "html"))
    block = "struct<text string, around array<bigint>>"
    parsed = materialize(
        whole.mapInPandas(
            _parts,
            f"page_id {kinds['page_id']}, url string, host string, page bigint, blocks array<{block}>, subtrees array<bigint>",
        ),
        "pages",
    )
    placed = parsed.where(F.col("host").isNotNull())
    content = F.xxhash64(F.transform("blocks", lambda b: b["text"]))
    counts = placed.select("host", F.explode("subtrees").alias("subtree"), content.alias("content")).groupBy("host", "subtree").agg(
        F.countDistinct("content").alias("n")
    )
    template = counts.where(F.col("n") >= least_pages).select("host", "subtree")

    own = F.flatten(F.transform("blocks", lambda b: b["around"]))
    parsed = parsed.withColumn("own", F.array_distinct(own))
    plain = parsed.where((F.size("own") == 0) | F.col("host").isNull())
    mixed = parsed.where((F.size("own") > 0) & F.col("host").isNotNull())
    gone = (
        mixed.select("page", "host", F.explode("own").alias("subtree")).join(template, ["host", "subtree"])
        .groupBy("page").agg(F.collect_set("subtree").alias("gone"))
    )
    cleaned = mixed.join(gone, "page", "left")
    kept = F.filter("blocks", lambda b: F.col("gone").isNull() | ~F.arrays_overlap(b["around"], F.col("gone")))
    text = lambda blocks: F.array_join(F.transform(blocks, lambda b: b["text"]), " ")
    return plain.select("page_id", "url", text(F.col("blocks")).alias("text")).union(
        cleaned.select("page_id", "url", text(kept).alias("text"))
    )
