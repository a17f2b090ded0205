"""Main-text extraction from raw pages with site template removal.

Every element subtree is hashed (tag, text and children).  Spark counts on how
many pages of a host each hash occurs; subtrees that recur across many pages of
their host are the site's template and are deleted, besides the elements that
are boilerplate by their tag, role, class or id.
"""

from __future__ import annotations

import html as html_lib
import re
from typing import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import hash64, map_arrow, materialise

NAME = re.compile(r"[a-zA-Z][^\s/>]*")
QUOTE_OR_END = re.compile("""[>"']""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe noframes xmp svg math canvas select audio video object".split())
RAW_ENDS = {tag: re.compile(rf"</{tag}\b", re.I) for tag in RAW}
BOILERPLATE_TAGS = frozenset("head nav header footer aside form menu dialog button fieldset".split())
BOILERPLATE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
BOILERPLATE_NAMES = frozenset(
    "ad ads adsense advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr "
    "notice notices popup modal overlay newsletter subscribe subscription sidebar sidebars menu menus nav navbar navigation navi "
    "breadcrumb breadcrumbs footer header masthead comment comments disqus reply replies respond share sharing social related "
    "recommended recommendations widget widgets toolbar login signup pagination pager".split())
#: boilerplate however much of the page it holds
COMMENT_NAMES = frozenset("comment comments disqus reply replies respond".split())
#: pieces that only say where or in what form a part stands; any other piece makes a name one of content
PLACE_NAMES = frozenset(
    "site page blog post user reader container wrap wrapper box block list item items area section slot unit bar row col column inner outer left "
    "right top bottom main primary secondary global mobile desktop sticky fixed link links icon icons button buttons text title form thread "
    "posts articles js css id m l s xs sm md lg xl".split())
PARAGRAPHS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd blockquote pre td th tr caption figcaption address".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
#: an open paragraph ends before these
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr "
                   "main menu nav ol p pre section table ul".split())
SCOPES = frozenset("table ul ol dl div section article main body aside nav".split())


class Node:
    __slots__ = ("tag", "skip", "children", "size")

    def __init__(self, tag: str, skip: int) -> None:
        self.tag, self.skip = tag, skip
        self.children: list = []  # nodes, texts, and None for a line break
        self.size = 0


def _named(names: str) -> int:
    """0 for class names and ids of content, 1 where one names boilerplate, 2 where one names reader comments.

    A name counts if all its pieces are such words or say a place: ``site-footer``
    does, ``content-banner-wrap`` and ``comment-on-economy`` don't."""
    kind = 0
    for name in names.lower().split():
        pieces = set(re.findall("[a-z]+", name))
        if not pieces.isdisjoint(BOILERPLATE_NAMES) and pieces <= BOILERPLATE_NAMES | PLACE_NAMES:
            kind = max(kind, 1 if pieces.isdisjoint(COMMENT_NAMES) else 2)
    return kind


def _boilerplate(tag: str, attributes: str) -> int:
    """0 content, 1 by its class or id, 2 reader comments by class or id, 3 by its tag, role or because it isn't shown."""
    if tag in BOILERPLATE_TAGS or tag in RAW:
        return 3
    if not attributes or "=" not in attributes and "hidden" not in attributes or tag in ("html", "body"):
        return 0
    found = {k.lower(): (v or "").strip("\"'") for k, v in ATTRIBUTE.findall(attributes)}
    named = _named(f"{found.get('class', '')} {found.get('id', '')}")
    if tag in ("article", "main"):
        return named if named == 2 else 0
    if (found.get("role", "").lower() in BOILERPLATE_ROLES or "hidden" in found or found.get("aria-hidden", "").lower() == "true"
            or re.search(r"display\s*:\s*none", found.get("style", ""), re.I)):
        return 3
    return named


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """``kind, name, rest`` of the page's texts and tags, each character read a bounded number of times.

    Kinds are ``text`` (rest), ``open`` and ``close`` (lower-case name, attributes).
    A tag ends at the first ``>`` outside quotes, at the first of all if its
    quotes never end.  Comments and declarations give nothing; one that isn't
    closed, and a tag cut off at the end, hides the rest.  Send it a name to
    skip to after that element's end tag (to the end, without one)."""
    at, end = 0, len(page)
    dead: set[int] = set()  # quotes, met outside quotes, after which no tag ends

    def tag_end(i: int) -> int:
        start, walked = i, []
        while m := QUOTE_OR_END.search(page, i):
            i = m.start()
            if page[i] == ">":
                return i
            if i in dead:
                break
            walked.append(i)
            i = page.find(page[i], i + 1) + 1
            if not i:
                break
        dead.update(walked)
        return page.find(">", start)

    def past(mark: str, i: int) -> int:
        found = page.find(mark, i)
        return end if found < 0 else found + len(mark)

    start = 0  # of the text that isn't given out yet
    while (at := page.find("<", at)) >= 0:
        name = NAME.match(page, at + 1 + page.startswith("/", at + 1))
        if not name and page[at + 1:at + 2] not in ("!", "?"):
            at += 1
            continue
        tag = name and (name.end(), tag_end(name.end()))
        if tag and tag[1] < 0:
            break  # no tag ends from here on
        if start < at:
            yield "text", "", page[start:at]
        if tag:
            skip = yield ("close" if page[at + 1] == "/" else "open"), name[0].lower(), page[tag[0]:tag[1]]
            start = at = tag[1] + 1
            if skip:
                m = RAW_ENDS[skip].search(page, at)
                start = at = past(">", m.end()) if m else end
                yield "text", "", ""
        elif page.startswith("<![CDATA[", at):
            start = past("]]>", at)
            yield "text", "", html_lib.escape(page[at + 9:start].removesuffix("]]>"))
            at = start
        else:
            start = at = past("-->", at) if page.startswith("<!--", at) else past(">", at)
    rest = page[start:]
    if at >= 0 and (hidden := re.search("<[!?]", page[at:])):
        rest, cdata = page[start:at + hidden.start()], page[at + hidden.start():]
        if cdata.startswith("<![CDATA["):
            rest += html_lib.escape(cdata[9:])
    elif (last := rest.rfind("<")) >= 0 and ">" not in rest[last:] and re.match("[a-zA-Z/]", rest[last + 1:last + 2]):
        rest = rest[:last]
    if rest:
        yield "text", "", rest


def parse(page: str) -> Node:
    """A lenient tree of the page's block elements; inline markup melts into its text."""
    root = Node("html", 0)
    stack = [root]
    places: dict[str, list[int]] = {}  # where in the stack elements of a tag are open
    scopes = [0]

    def close(tags: Iterable[str], scoped: bool = False) -> None:
        """Close the innermost open element of the tags; if scoped, only within the innermost scope."""
        i = max((places[t][-1] for t in tags if places.get(t)), default=0)
        if not i or scoped and i < scopes[-1]:
            return
        for n in reversed(stack[i:]):
            places[n.tag].pop()
        del stack[i:]
        while scopes[-1] >= i:
            scopes.pop()

    found = tokens(page)
    token = next(found, None)
    while token:
        kind, tag, rest = token
        skip_to = None
        if kind == "text":
            stack[-1].children.append(rest)
        elif tag == "br":
            stack[-1].children.append(" ")
        elif kind == "close":
            if tag in INLINE and stack[-1].tag != tag:
                close((tag,), True)
            elif tag not in VOID:
                close((tag,))
                stack[-1].children.append(None) if tag not in INLINE else None
        elif tag in RAW:
            if not rest.rstrip().endswith("/") or tag not in ("svg", "math"):
                skip_to = tag
        elif tag in VOID:
            if tag not in INLINE:
                stack[-1].children.append(None)
        elif (skip := _boilerplate(tag, rest)) or tag not in INLINE:
            if tag in ENDS_P:
                close(("p",), True)
            if tag in CLOSES:
                close(CLOSES[tag], True)
            node = Node(tag, skip)
            stack[-1].children.append(node)
            places.setdefault(tag, []).append(len(stack))
            if tag in SCOPES:
                scopes.append(len(stack))
            stack.append(node)
        if skip_to:
            found.send(skip_to)
        token = next(found, None)
    return root


def _hash(node: Node, found: dict[int, Node], signatures: dict[int, int]) -> None:
    """Hash subtrees bottom up, without recursion; fills the nodes' sizes in text characters."""
    order, todo = [], [node]
    while todo:
        n = todo.pop()
        order.append(n)
        todo += [c for c in n.children if isinstance(c, Node)]
    for n in reversed(order):
        parts, size = [n.tag], 0
        for c in n.children:
            if isinstance(c, Node):
                parts.append(str(signatures[id(c)]))
                size += c.size
            elif c and (words := c.split()):
                parts.append(" ".join(words))
                size += sum(map(len, words))
        n.size = size
        signatures[id(n)] = h = hash64("\x00".join(parts).encode("utf-8", "replace")) - (1 << 63)
        found[h] = n


def subtree_hashes(page: str) -> set[int]:
    """The hashes of all element subtrees of the page that hold text."""
    found: dict[int, Node] = {}
    _hash(parse(page), found, {})
    return {h for h, n in found.items() if n.size}


def extract(page: str, template: frozenset[int] = frozenset()) -> str:
    """The page's main text: blocks in page order, one line each."""
    root = parse(page)
    signatures: dict[int, int] = {}
    _hash(root, {}, signatures)
    half = root.size / 2

    def boilerplate(n: Node) -> bool:
        """A form, or an element named as boilerplate, around most of the page's text is only a wrapper."""
        return n.skip > 0 and not ((n.tag == "form" or n.skip == 1) and n.size > half)

    def live(top: Node, *kinds: str) -> list[Node]:
        """Outermost elements of the kinds, with text, that aren't in boilerplate."""
        out, todo = [], [c for c in reversed(top.children) if isinstance(c, Node)]
        while todo:
            n = todo.pop()
            if not boilerplate(n):
                if n.tag in kinds and n.size:
                    out.append(n)
                else:
                    todo += [c for c in reversed(n.children) if isinstance(c, Node)]
        return out

    def render(tops: list[Node], inside: bool) -> str:
        blocks: list[str] = []
        run: list[str] = []

        def flush() -> None:
            if words := html_lib.unescape("".join(run)).split():
                blocks.append(" ".join(words))
            run.clear()

        def dropped(n: Node) -> bool:
            if boilerplate(n) and not (inside and n.tag == "header"):
                return True
            if signatures[id(n)] not in template or n.tag in ("html", "body") or n.size > half:
                return False
            return not inside or n.tag not in PARAGRAPHS

        todo: list = list(reversed(tops))
        tops_ids = {id(n) for n in tops}
        while todo:
            n = todo.pop()
            if isinstance(n, str):
                run.append(n)
            elif n is None:
                flush()
            elif id(n) in tops_ids or not dropped(n):
                if n.tag not in INLINE:
                    flush()
                    todo.append(None)
                todo += reversed(n.children)
            elif n.tag not in INLINE:
                flush()
        flush()
        return "\n".join(blocks)

    outer = live(root, "article", "main")
    mains = [n for n in outer if n.tag == "main"]
    if not mains:
        return render(outer or [root], bool(outer))
    enclosing = [n for n in outer if n.tag == "article" and live(n, "main")]
    whole = render(enclosing + mains, True)
    articles = [a for n in mains for a in live(n, "article")]
    if articles and not enclosing:
        text = render(articles, True)
        return text if 2 * len(text) >= len(whole) else whole  # articles with less are teasers beside the story
    return whole


def host_of(url_col: str):
    """The lower-case host of a URL, '' where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url_col), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def host_templates(df: DataFrame, url_col: str, html_col: str, min_pages: int, min_share: float) -> DataFrame:
    """``host, template``: the hashes of subtrees on at least ``min_pages`` pages and
    ``min_share`` of the pages of their host.  At most (subtrees a page) / min_share for a host.

    Each task counts its pages' hashes by host before anything is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, int | None], int] = {}

        def rows() -> pa.RecordBatch:
            keys = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                                               pa.array(list(counts.values()), pa.int64())], names=["host", "hash", "pages"])

        for batch in batches:
            for host, page in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[host, None] = counts.get((host, None), 0) + 1  # the pages of the host
                for h in subtree_hashes(page):
                    counts[host, h] = counts.get((host, h), 0) + 1
            if len(counts) > 500_000:
                yield rows()
                counts.clear()
        yield rows()

    pages = df.select(host_of(url_col).alias("host"), F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    counted = map_arrow(pages, run, "host string, hash long, pages long").groupBy("host", "hash").agg(F.sum("pages").alias("pages"))
    counted = materialise(counted.where((F.col("pages") >= min_pages) | F.col("hash").isNull()), "subtree-counts")
    hosts = counted.where("hash is null").select("host", F.col("pages").alias("all_pages"))
    many = counted.where("hash is not null").join(hosts, "host").where(F.col("pages") >= min_share * F.col("all_pages"))
    return materialise(many.groupBy("host").agg(F.sort_array(F.collect_set("hash")).alias("template")), "templates")


def extract_pages(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                  min_pages: int = 10, min_share: float = 0.2) -> DataFrame:
    """``<id_col>, <url_col>, text, n_chars``, one row for each input row.

    The text is that of the page's main element, or of the articles in it that
    hold half of its text or more; without a main element that of the page's
    articles, else of its body.  It goes without boilerplate elements and without
    subtrees on at least ``min_pages`` pages and ``min_share`` of the pages of the
    host.  A class or id is a hint: it counts only if all its pieces are words for
    boilerplate or places, and, comments aside, for at most half of the page's text.  Inside an
    article or main element, paragraphs, headings, list items and cells are
    never deleted for recurring, and a subtree that holds more than half of a
    page's text never is.  Only the three named columns are read.  Null html
    counts as empty and gives the empty text; a null or hostless url belongs to
    the host ''; repeated rows give repeated rows (and count as pages each); no
    rows give no rows.  A very long page is read once from front to end, whatever
    its markup; tags and quotes that never close hide no text before them.
    """
    templates = host_templates(df, url_col, html_col, min_pages, min_share)
    pages = df.select(df[id_col].alias("id"), df[url_col].alias("url"), F.coalesce(F.col(html_col), F.lit("")).alias("html"), host_of(url_col).alias("host"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(page, frozenset(template or ())) for page, template in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                                             names=["id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}
    joined = pages.join(templates, "host", "left").select("id", "url", "html", "template")
    out = map_arrow(joined, run, f"id {kinds['id']}, url {kinds['url']}, text string, n_chars long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
