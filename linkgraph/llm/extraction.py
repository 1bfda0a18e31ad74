"""Main text of web pages by consensus host paths.

Three steps.  Each page's containers are scored by the running text they hold, and
the best one's path of generalised tags and classes is the page's vote.  Spark sums
the votes per host; the paths that win a real share of a host's pages stay.  Every
page is then read again with the one of them that holds most of its running text; a
page on which they hold none falls back to its own best container.
"""

from __future__ import annotations

import heapq
import html
import re
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkgraph.llm.common import small_batches, stash

#: Elements by their role in HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset(
    "script style noscript template head title textarea xmp iframe noembed noframes nav header footer aside form button select "
    "option datalist fieldset label input dialog menu object embed applet canvas svg math audio video map".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details dir div dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr html li main "
    "ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Elements whose start ends an open paragraph; elements that end their own kind.
ENDS_P = BLOCKS - {"br"}
SAME = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
        "option": ("option",), "p": ("p",)}
SCOPES = frozenset("ul ol dl table body html article section div main td th blockquote".split())
CONTAINERS = frozenset("article main section div td body blockquote".split())
#: Words in a class or id that mark a part that is not the article.
NOISE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|popup|modal|overlay|newsletter|subscribe|"
    r"nav\w*|menu|breadcrumbs?|pagination|pager|sidebar|side|widget|related|recommend\w*|share|sharing|social|footer|header|masthead|"
    r"toolbar|comments?|comment-?list|replies|disqus|login|signup|search)(?:$|[\s_-])", re.I)
#: Marks that also stand on parts around an article: such a part is read if it holds running text of at least RESCUE
#: characters and three times what the page has outside of noise.
SOFT = re.compile(r"(?:^|[\s_-])(?:widget|search|share|sharing|social|side)(?:$|[\s_-])", re.I)
RESCUE = 150
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog menu menubar toolbar".split())
TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+(?:\"|\Z)|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)*+)(?:>|\Z)", re.S)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
SPACE = re.compile(r"\s+")


class Node:
    """An element with its text pieces and children in page order."""

    __slots__ = ("tag", "step", "parent", "parts", "noise", "soft", "own", "raw", "key", "holder")

    def __init__(self, tag: str, step: str, parent: Node | None, noise: bool, soft: bool = False):
        self.tag, self.step, self.parent, self.parts, self.noise, self.soft = tag, step, parent, [], noise, soft
        self.own = self.raw = 0.0
        # checksum of the path, and the container that a text here belongs to
        self.key = 0 if parent is None else zlib.crc32((step if parent.parent is None else "/" + step).encode("utf-8", "surrogatepass"), parent.key)
        self.holder: Node = self if parent is None or tag in CONTAINERS else parent.holder


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in ATTRIBUTE.finditer(raw)} if raw.strip("/ \t\r\n") else {}


def general(tag: str, attributes: dict[str, str]) -> str:
    """A step of a path: tag and classes, digits as one sign, so that numbered classes agree."""
    names = sorted({re.sub(r"\d+", "#", c.lower()) for c in attributes.get("class", "").split()})
    return ".".join([tag, *names])


def parse(page: str) -> Node:
    """The element tree of a page; tags that are left open or closed twice do no harm."""
    root = Node("#root", "#root", None, False)
    at, pos, end = root, 0, len(page)

    def text(s: str) -> None:
        if s:
            at.parts.append(html.unescape(s))

    for m in iter(lambda: TOKEN.search(page, pos), None):
        if m.start() > pos:
            text(page[pos:m.start()])
        pos = m.end()
        tag = m[2]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                text(page[m.start() + 9:pos].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1]:
            node = at
            while node is not root and node.tag != tag:
                # an end tag closes nothing outside of the cell or item it stands in
                if node.tag in ("td", "th", "table") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "body", "html", "div", "article", "section", "main"):
                    node = root
                    break
                node = node.parent
            if node is not root:
                at = node.parent
            elif tag in ("p", "br"):
                at.parts.append(Node("br", "br", at, False))
            continue
        same = (*SAME.get(tag, ()), *(("p",) if tag in ENDS_P else ()))
        node = at
        while node is not root and same:
            if node.tag in same:
                at = node.parent
            elif node.tag in SCOPES:
                break
            node = node.parent
        own = _attributes(m[3])
        marks = [] if tag in ("body", "html", "article", "main") else [own.get("class", ""), own.get("id", "")]
        role = own.get("role")
        hard = (tag in SKIPPED and tag != "form" or "hidden" in own or own.get("aria-hidden") == "true"
                or role in NOISE_ROLES and role not in ("form", "search")
                or "display:none" in own.get("style", "").replace(" ", "").lower()
                or any(NOISE.search(SOFT.sub("  ", SOFT.sub("  ", x))) for x in marks))
        soft = not hard and (tag == "form" or role in ("form", "search") or any(SOFT.search(x) for x in marks))
        child = Node(tag, general(tag, own), at, hard or soft, soft)
        at.parts.append(child)
        if tag in VOID or m[3].endswith("/") and tag not in RAW and tag not in BLOCKS:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b", re.I).search(page, pos)
            stop = close.start() if close else end
            child.parts.append(page[pos:stop])
            pos = stop
        at = child
    if pos < end:
        text(page[pos:])
    rescue(root)
    return root


def _solid(part: str) -> int:
    return len(part) - part.count(" ") - part.count("\n")


def rescue(root: Node) -> None:
    """Soft noise that holds the page's text is noise no longer: the largest first, and what lies inside it in turn."""
    order, stack = [], [(root, False)]
    while stack:  # each node before those inside it
        node, linked = stack.pop()
        order.append((node, linked))
        stack += [(part, linked or part.tag == "a") for part in node.parts if not isinstance(part, str) and (part.soft or not part.noise)]
    if not any(node.soft for node, _ in order):
        return
    weight: dict[int, int] = {}
    for node, linked in reversed(order):
        weight[id(node)] = sum(weight.get(id(part), 0) if not isinstance(part, str) else 0 if linked else _solid(part) for part in node.parts)
    heap: list[tuple[int, int, Node]] = []
    clean, place = 0, {id(node): i for i, (node, _) in enumerate(order)}
    links = {id(node) for node, linked in order if linked}

    def enter(node: Node) -> int:
        found, stack = 0, [node]
        while stack:
            node = stack.pop()
            for part in node.parts:
                if isinstance(part, str):
                    found += 0 if id(node) in links else _solid(part)
                elif part.soft and part.noise:
                    heapq.heappush(heap, (-weight[id(part)], place[id(part)], part))
                elif not part.noise:
                    stack.append(part)
        return found

    clean = enter(root)
    while heap:
        most, _, node = heapq.heappop(heap)
        if -most < RESCUE or -most <= 3 * clean:
            break
        node.noise = False
        clean += enter(node)


def blocks(node: Node) -> list[str]:
    """The text blocks under a node in page order, without its noise."""
    done, open_ = [], []

    def close() -> None:
        s = SPACE.sub(" ", "".join(open_)).strip()
        if s:
            done.append(s)
        open_.clear()

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        cur, i = stack.pop()
        if i == 0 and cur.tag in BLOCKS:
            close()
        while i < len(cur.parts):
            part = cur.parts[i]
            i += 1
            if isinstance(part, str):
                open_.append(part)
            elif not part.noise:
                stack.append((cur, i))
                stack.append((part, 0))
                break
        else:
            if cur.tag in BLOCKS:
                close()
    close()
    return done


def path(node: Node) -> str:
    steps = []
    while node.parent is not None:
        steps.append(node.step)
        node = node.parent
    return "/".join(reversed(steps))


def containers(root: Node) -> list[Node]:
    """All containers outside of noise, each before those inside it, with their running text.

    A container has the characters it holds itself, less twice those in links,
    and DECAY of what each container directly inside it has.  So parts of one
    article add up in the container around them, while a wrapper around a single
    one has less than that one.
    """
    found, stack = [root], [(root, False)]
    while stack:
        node, linked = stack.pop()
        if node.tag in CONTAINERS:
            found.append(node)
        for part in node.parts:
            if isinstance(part, str):
                node.holder.own += _solid(part) * (-1 if linked else 1)
            elif not part.noise:
                stack.append((part, linked or part.tag == "a"))
    for node in reversed(found):
        node.raw += max(0.0, node.own)
        if node is not root:
            node.parent.holder.raw += DECAY * node.raw
    return found


#: What the kind of a container counts for, and what is handed on to the one around it.
BONUS = {"article": 3.0, "main": 2.0, "section": 1.2, "body": 0.8, "#root": 0.5}
DECAY = 0.9
#: A path wins a real share of a host with every so many-th of its pages.
SHARE = 20


def score(node: Node) -> float:
    return node.raw * BONUS.get(node.tag, 1.0)


def best(root: Node) -> Node:
    """The container with the best score, the first one in page order among equals."""
    return max(containers(root), key=score)


def vote(page: str | None) -> tuple[str, float]:
    """(path, weight) of a page's best container: its running text; weight 0 without any."""
    node = best(parse(page or ""))
    return path(node), node.raw


def extract(page: str | None, winners: list[str] | None) -> str:
    """Main text of a page: under the winning path with most running text on it, else under the page's own best container."""
    root = parse(page or "")
    found = containers(root)
    most, out = -1.0, []
    for winner in winners if winners is not None else ():
        key = zlib.crc32(winner.encode("utf-8", "surrogatepass"))
        nodes = [n for n in found if n.key == key and path(n) == winner]
        size = sum(n.raw for n in nodes)
        if nodes and size > most:
            text = [b for n in nodes for b in blocks(n)]
            if text:
                most, out = size, text
    return "\n".join(out or blocks(max(found, key=score)))


def host_of(url: Column) -> Column:
    """Host of a URL in lower case; empty where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def consensus(pages: DataFrame, html_column: str = "html", url: str = "url") -> DataFrame:
    """(host, winner, winners): the path with the largest sum of votes of each host, ties by code point, and behind it
    those that win two pages and a SHAREth of the host's pages at least, so no more than SHARE of them.

    Votes are summed by host and path before they meet, so a host with any share
    of the pages costs one row per path and task.
    """
    small_batches(pages.sparkSession)

    @F.pandas_udf("path string, weight double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for docs in batches:
            yield pd.DataFrame([vote(p) for p in docs], columns=["path", "weight"])

    votes = (pages.select(host_of(pages[f"`{url}`"]).alias("host"), run(pages[f"`{html_column}`"].cast("string")).alias("v"))
             .select("host", "v.path", "v.weight").where("weight > 0"))
    sums = votes.groupBy("host", "path").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    sums = stash(sums, "path-votes")
    first = sums.groupBy("host").agg(F.min(F.struct((-F.col("weight")).alias("w"), "path"))["path"].alias("winner"),
                                     F.sum("n").alias("pages"))
    others = (sums.where("n > 1").join(first, "host").where((F.col("n") * SHARE >= F.col("pages")) & (F.col("path") != F.col("winner")))
              .groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("weight")).alias("w"), "path")))["path"].alias("others")))
    return first.join(others, "host", "left").select(
        "host", "winner", F.concat(F.array("winner"), F.coalesce("others", F.array().cast("array<string>"))).alias("winners"))


def extract_pages(pages: DataFrame, html_column: str = "html", url: str = "url", into: str = "text") -> DataFrame:
    """All rows and columns of ``pages`` with the main text in column ``into`` (replaced, if there).

    * null or empty html: empty text.  Pages with null URL or one without a host use their own vote.
    * character references are decoded, white space inside a block is one space, blocks are joined by line feeds.
    * unclosed, misnested and cut off tags are read as far as they go; very long pages are read whole.
    * repeated rows count as often as they are there.
    """
    spark = pages.sparkSession
    small_batches(spark)
    # one short row per host; Spark broadcasts the stored table where its size allows, else joins by host
    winners = stash(consensus(pages, html_column, url).where("host <> ''").select(F.col("host").alias("_host"), F.col("winners").alias("_winner")),
                    "host-paths")

    @F.pandas_udf("string")
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for docs, paths in batches:
            yield pd.Series([extract(p, None if w is None else list(w)) for p, w in zip(docs, paths, strict=True)], dtype=object)

    kept = [c for c in pages.columns if c != into]
    joined = pages.join(winners, host_of(pages[f"`{url}`"]) == winners["_host"], "left")
    return joined.select(*[pages[f"`{c}`"] for c in kept],
                         run(pages[f"`{html_column}`"].cast("string"), winners["_winner"]).alias(into))
