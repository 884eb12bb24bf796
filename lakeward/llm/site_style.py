"""Main text of web pages by a site style tree.

Pages of one host are merged into one tree of style nodes: elements with the same chain of tag, class and role.
What a page's own markup already rules out (below) is left out first, and of pages with article or main only what stands in
them counts.  Each distinct body of a host counts once, so copies of an article do not make it look like a template.
Each style with text of its own gets an importance from 0 to 1: for content, one minus the mean entropy of its distinct
blocks (a block that stands on every page has entropy 1, one that stands on a single page 0), raised by its presentation,
the entropy of the sequences of child styles its pages show.  Styles whose importance is a small share of the best one's on
their host are removed from each page.  So a branch goes only where all styles with text below it are low, never above one that stays.
Branches whose tag, class, id or role names a menu, header, footer, sidebar, notice, advert, form, script,
style or reader comments go as well, which also serves hosts with too few pages to tell.  Of a class, id or role only the last
part counts ("site-menu"; not "menu-open", "has-sidebar", "single-column-form"), and an element that holds a page's only article, main or h1 stays.

Pages are parsed once.  Counts are aggregated by (host, style, block) with partial aggregation, so a host with a third of all
pages is no single task; the table of removed styles is broadcast if measured small, else joined by host.

Defined cases: null or empty html gives an empty text; null or odd urls share the empty host; broken markup is
read as browsers do (a new paragraph ends the open one); repeated pages each get the same text; extra columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeward.llm.textkit import stored
from lakeward.llm.url_cascade import host_and_path

MIN_PAGES = 8                # fewer pages of a style say nothing
LOW_SHARE = 0.2              # of the best importance on the host
PRESENTATION = 0.2           # weight of presentation in a style's composite importance
BROADCAST_BYTES = 4 << 20

SKIP_TAGS = frozenset("nav header footer aside form script style noscript template iframe svg math button select textarea input "
                      "dialog menu head title object embed canvas audio video map option datalist".split())
SKIP_NAMES = frozenset("ad ads advert adverts advertisement advertisements advertising sponsor sponsored promo promotion banner nav navbar "
                       "navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets related share sharing social "
                       "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments "
                       "respond reply replies disqus toolbar pagination pager contentinfo complementary search form".split())
STATES = frozenset("has have with no without not hide show is on off open column columns col layout".split())    # a name after one of these is a state
BLOCK_TAGS = frozenset("address article blockquote body caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 hgroup "
                       "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("script style textarea title xmp iframe noembed noframes".split())
_CLOSES_P = BLOCK_TAGS | frozenset("header footer nav aside form menu dialog".split())
_SAME = {"li": ("ul", "ol"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr",), "th": ("tr",), "option": ("select",)}

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?/][^>]*>""", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+)))?""")
_NAME = re.compile(r"[a-z0-9]+")
_WHITE = re.compile(r"\s+")


def _names_other(value: str) -> bool:
    """Whether a class, id or role attribute says that the element is no main text: a whole name, or the last part of one, that is no state."""
    for name in value.split():
        parts = _NAME.findall(name)
        if parts and parts[-1] in SKIP_NAMES and STATES.isdisjoint(parts):
            return True
    return False


def _style(tag: str, attrs: str) -> tuple[str, bool, bool]:
    """Style of an element, whether its tag or state says it is no main text, and whether its names say so."""
    skip, named = tag in SKIP_TAGS, False
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return tag, skip, named
    role = ""
    for name, a, b, c in _ATTR.findall(attrs):
        name, value = name.lower(), (a or b or c).lower()
        if name in ("class", "id", "role"):
            named = named or _names_other(value)
            role = value if name == "class" else role
        elif name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            skip = True
    return (f"{tag}.{'.'.join(sorted(set(_NAME.findall(role))))}" if role else tag), skip, named


def blocks_of(html: str, spared: frozenset[int] = frozenset()) -> tuple[list[tuple[str, str, bool, bool]], list[tuple[str, tuple[str, ...]]]]:
    """Blocks of a page in order: (style path, text, inside article or main, ruled out by its own
    markup); and (path, child styles) of its branches, without ruled-out ones.  Ruled-out inline elements have no text.

    ``spared``: numbers of the start tags whose names do not rule them out, as they hold the page's only article, main or h1."""
    blocks: list[tuple[str, str, bool, bool]] = []
    # tag, style path, ruled out, inside main, without text, elements above ruled out by their names or spared
    stack: list[tuple[str, str, bool, bool, bool, tuple[int, ...]]] = []
    held: dict[str, list[tuple[int, ...]]] = {}             # of each article, main and h1, the elements that rule it out by their names
    number = 0
    children: dict[str, list[str]] = {}
    buffer: list[str] = []

    def end_block() -> None:
        if buffer:
            text = _WHITE.sub(" ", entities.unescape("".join(buffer))).strip()
            buffer.clear()
            if text:
                _, path, skip, main, _, _ = stack[-1] if stack else ("", "", False, False, False, ())
                blocks.append((path, text, main, skip))

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            if stack[-1][0] in _CLOSES_P or stack[-1][0] in SKIP_TAGS:
                end_block()
            stack.pop()

    at, n = 0, len(html)
    while at < n:
        m = _TOKEN.search(html, at)
        if m is None:
            chunk, at = html[at:], n
        else:
            chunk, at = html[at:m.start()], m.end()
        if chunk and not (stack and stack[-1][4]):
            buffer.append(chunk)
        if m is None or m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:                                            # an end tag
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), None)
            if depth is not None:
                pop_to(depth)
            elif tag in ("p", "br"):
                end_block() if tag == "p" else buffer.append(" ")
            continue
        if tag in _CLOSES_P:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == "p":
                    pop_to(i)
                    break
                if stack[i][0] in _CLOSES_P:
                    break
            end_block()
        if tag in _SAME:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    pop_to(i)
                    break
                if stack[i][0] in _SAME[tag]:
                    break
        number += 1
        style, skip, named = _style(tag, m[3])
        above = stack[-1] if stack else ("", "", False, False, False, ())
        names = above[5]
        if named and tag not in ("html", "body", "article", "main"):
            names = (*names, number)
        if tag in ("article", "main", "h1") and not skip and not (named and tag == "article"):
            place = tuple(i for i in names if i not in spared)
            if place or not above[2]:
                held.setdefault(tag, []).append(place)
        skip = skip or names[-1:] == (number,) and number not in spared
        if not above[2] and not skip:
            children.setdefault(above[1], []).append(style)
        if tag in VOID_TAGS or m[3].rstrip().endswith("/") and tag in ("svg", "path"):
            if tag == "br":
                buffer.append(" ") if not above[4] else None
            continue
        if tag in RAW_TAGS:
            stop = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = stop.end() if stop else n
            continue
        inline = tag not in _CLOSES_P and not skip
        stack.append((tag, above[1] if inline else f"{above[1]}/{style}", above[2] or skip,
                      above[3] or tag in ("article", "main") and not names, above[4] or skip and tag not in _CLOSES_P, names))
    pop_to(0)
    end_block()
    more = {i for places in held.values() if all(places) for place in places for i in place}
    if more:
        return blocks_of(html, spared | more)
    return blocks, [(path, tuple(styles)) for path, styles in children.items()]


def body_of(blocks: list[tuple[str, str, bool, bool]]) -> list[tuple[str, str]]:
    """Style path and text of the blocks that can be main text: those of article or main if the page has any, else of the page."""
    blocks = [b for b in blocks if not b[3]]
    inside = any(main for _, _, main, _ in blocks)
    return [(path, text) for path, text, main, _ in blocks if main or not inside]


def text_of(html: str, low: frozenset[str]) -> str:
    """Main text of a page: its body without the styles of low importance."""
    return "\n\n".join(text for path, text in body_of(blocks_of(html)[0]) if path not in low)


_PARSED = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("host", pa.string()), ("row", pa.int64()), ("body", pa.int64()),
                     ("paths", pa.list_(pa.string())), ("texts", pa.list_(pa.string())), ("content", pa.list_(pa.int64())),
                     ("branches", pa.list_(pa.string())), ("presentation", pa.list_(pa.int64()))])
_PARSED_DDL = ("page_id bigint, url string, host string, row bigint, body bigint, paths array<string>, texts array<string>, "
               "content array<bigint>, branches array<string>, presentation array<bigint>")


def _parse(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import hashlib

    def short(text: str) -> int:
        return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)

    def clean(text: str) -> str:
        return text.encode("utf-8", "replace").decode("utf-8")

    for batch in it:
        for part in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
            out = []
            for page in part.column(4).to_pylist():
                blocks, branches = blocks_of(page or "")
                body = [(path, clean(text)) for path, text in body_of(blocks)]
                texts = [text for _, text in body]
                out.append((short("\n".join(texts)), [path for path, _ in body], texts, [short(text) for text in texts],
                            [path for path, _ in branches], [short("\n".join(styles)) for _, styles in branches]))
            if out:
                yield pa.RecordBatch.from_arrays([*part.columns[:4], *(pa.array(c, t) for c, t in zip(zip(*out), _PARSED.types[4:]))], schema=_PARSED)


def parsed(pages: DataFrame) -> DataFrame:
    """A row per page with its body's blocks (paths, texts, hashes as content) and its branches with their presentation."""
    host, _ = host_and_path(F.col("url"))
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", host.alias("host"), F.monotonically_increasing_id().alias("row"), "html")
    return stored(rows.mapInArrow(_parse, _PARSED_DDL), "page-blocks")


def style_tree(rows: DataFrame) -> DataFrame:
    """host, path, pages, importance of every style with text of its own: the merged trees of all hosts, from ``parsed`` pages."""
    once = rows.groupBy("host", "body").agg(F.min("row").alias("row"))
    hosts = once.groupBy("host").agg(F.count("*").alias("all_pages"))
    distinct = rows.select("host", "row", "paths", "content", "branches", "presentation").join(once.select("row"), "row", "left_semi")

    def cells(kind: str, paths: str):
        pairs = F.transform(F.arrays_zip(paths, kind), lambda x: F.struct(x[paths].alias("path"), F.lit(kind).alias("kind"), x[kind].alias("value")))
        return F.array_distinct(pairs)

    counts = stored(distinct.select("host", F.inline(F.concat(cells("content", "paths"), cells("presentation", "branches"))))
                    .groupBy("host", "path", "kind", "value").agg(F.count("*").alias("c")), "style-counts")
    node = (counts.groupBy("host", "path", "kind")
            .agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.log("c")).alias("clogc"), F.avg(F.log("c")).alias("logc"))
            .join(hosts, "host"))                                                # a row per host and style by now
    scale = F.greatest(F.log(F.col("all_pages").cast("double")), F.lit(1e-9))
    entropy = F.col("logc") / scale                                              # mean entropy of the style's distinct blocks
    shape = (F.log("n") - F.col("clogc") / F.col("n")) / F.greatest(F.log(F.col("n").cast("double")), F.lit(1e-9))
    content = node.filter("kind = 'content'").select("host", "path", F.col("n").alias("blocks"), "all_pages", (1 - entropy).alias("own"))
    shapes = node.filter("kind = 'presentation'").select("host", "path", F.col("n").alias("pages"), shape.alias("shape"))
    return (content.join(shapes, ["host", "path"], "left")
            .select("host", "path", F.coalesce("pages", "blocks").alias("pages"), "blocks", "all_pages",
                    (F.col("own") + PRESENTATION * F.coalesce("shape", F.lit(0.0)) * (1 - F.col("own"))).alias("importance")))


def low_styles(tree: DataFrame) -> DataFrame:
    """host, low: styles of too little importance, on hosts with enough pages."""
    best = F.max("importance").over(Window.partitionBy("host"))
    return (tree.filter((F.col("all_pages") >= MIN_PAGES) & (F.col("blocks") >= MIN_PAGES)).withColumn("best", best)
            .filter(F.col("importance") < LOW_SHARE * F.col("best")).groupBy("host").agg(F.sort_array(F.collect_set("path")).alias("low")))


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row."""
    rows = parsed(pages)
    low = stored(low_styles(style_tree(rows)), "low-styles")
    size = low.agg(F.coalesce(F.sum(F.length("host") + F.length(F.concat_ws("/", "low"))), F.lit(0))).first()[0]
    side = F.broadcast(low) if size <= BROADCAST_BYTES else low
    kept = F.filter(F.arrays_zip("paths", "texts"), lambda b: ~F.coalesce(F.array_contains("low", b["paths"]), F.lit(False)))
    return (rows.select("page_id", "url", "host", "paths", "texts").join(side, "host", "left")
            .select(F.col("page_id").cast(dict(pages.dtypes)["page_id"]).alias("page_id"), "url",
                    F.concat_ws("\n\n", F.transform(kept, lambda b: b["texts"])).alias("text")))
