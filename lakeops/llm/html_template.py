"""Main text of web pages by the meaning of tags and by equivalence classes of template tokens.

The meaning of tags and of their class names decides first: the main text of a page with article or main tags is what
stands in them and not beside the content. The template is not asked there, as what pages repeat inside an article is content.

Other pages lose the texts of their template. Every page is read as tokens: a tag with the path of tags above it, or a
whole text below such a path. Tokens that occur equally often on the same pages have the same occurrence vector and form a
class; a vector is added up as one number per page and count, so classes come from map-side sums, whatever a host's size.
Pages with equal content count once. A class is valid if it is on at least two pages and half of the host's, or on three
pages and half of those of a layout (pages with the same outer tags). A page gives up its valid classes one by one, the
widest first, but none that would leave it less than a fifth of its text: so much in common means near copies, and copies
are content. Order and nesting of the classes are not tested.
"""

from __future__ import annotations

import html as html_entities
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.llm.common import small, written
from lakeops.llm.url_rules import host_of

_TOKEN = re.compile(r"</?([a-zA-Z][^\s/>]*)((?:[^>\"']+|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*+)(?:>|$)|<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"?|'[^']*'?|[^\s>]+))?", re.S)
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_HIDDEN = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "canvas", "audio", "video", "head", "title"}
_RAW = {"script", "style", "textarea", "title", "noscript", "iframe"}
_BESIDE = {"nav", "header", "footer", "aside", "form", "button", "select", "textarea", "dialog", "menu", "label", "fieldset"}
_INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "mark", "q", "rp", "rt", "ruby", "s", "samp",
    "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
_ENDS_P = {
    "address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
    "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul",
}
_MARK = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|advert\w*|adsense|adslot|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumb\w*|header|masthead|footer|foot|sidebar\w*|side|aside|widget\w*|cookie\w*|consent|notice\w*|"
    r"gdpr|popup|modal|overlay|newsletter|subscri\w*|share|sharing|social|comment\w*|reply|replies|disqus|related|recommend\w*|pagination|pager|toolbar|login|signup|search)(?:[^a-z]|$)"
)
#: Names of an article's own heading, which are not a page header.
_HEADING = re.compile(r"\b(?:entry|post|article|story|content|section)[-_]?header\b")
#: Token that stands for a page itself; depth of the outer tags; share of its text that the template leaves every page.
PAGE, OUTER, OWN = 0, 3, 0.2
#: Bytes of templates up to which every task gets all of them; larger ones travel by a join.
TEMPLATE_BYTES = 16 << 20
_ROLE = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "menu", "menubar"}


class Node:
    """An open element; ``path`` is a code of the tags above it and its own, ``block`` the nearest element that is no inline one."""

    __slots__ = ("name", "path", "hidden", "beside", "core", "block")

    def __init__(self, name: str, path: int, hidden: bool, beside: bool, core: bool, above: Node | None = None):
        self.name, self.path, self.hidden, self.beside, self.core = name, path, hidden, beside, core
        self.block = above.block if above is not None and name in _INLINE else self


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html_entities.unescape(v.strip("\"'")) for k, v in _ATTRIBUTE.findall(text)}


@lru_cache(4096)
def _meaning(name: str, attributes: str) -> tuple[str, bool, bool, bool]:
    """(label, core, beside, hidden) of a start tag by its name and attributes."""
    given = _attributes(attributes) if attributes.strip(" /") else {}
    label = f"{given.get('class', '')} {given.get('id', '')}".lower().strip()
    role = given.get("role", "").lower()
    core = name in ("article", "main") or role in ("main", "article") or given.get("itemprop", "").lower() == "articlebody"
    named = bool(label and name not in ("html", "body", "article", "main", "header") and _MARK.search(_HEADING.sub(" ", label)))
    hidden = name in _HIDDEN or "hidden" in given or "display:none" in given.get("style", "").replace(" ", "").lower()
    return label, core, name in _BESIDE or role in _ROLE or named, hidden


def blocks(page: str) -> tuple[list[tuple[int, str, bool, bool]], list[int], set[int]]:
    """Text blocks as (path, text, beside, core) in page order, the paths of all tags, and those of the outer block tags.

    The time is linear in the page however deep its tags nest: a path is a code made of the path above it, and the places
    of open elements are kept by name. Unclosed elements end as browsers end them: a block tag ends an open paragraph, an end tag closes what is open inside
    its element, an end tag without a start is ignored, and the end of a cut page closes everything.
    """
    stack = [Node("", 0, False, False, False)]
    places: dict[str, list[int]] = {}  # where elements of a name are open
    out: list[tuple[int, str, bool, bool]] = []
    tags: list[int] = []
    outer: set[int] = set()
    parts: list[str] = []
    owner = stack[0]

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                out.append((owner.path, text, owner.beside, owner.core))
            parts = []

    def add(raw: str) -> None:
        nonlocal owner
        if raw and not stack[-1].hidden:
            if not parts:
                owner = stack[-1].block
            parts.append(html_entities.unescape(raw) if "&" in raw else raw)

    def close(depth: int) -> None:
        if any(n.name not in _INLINE and n.name not in _HIDDEN for n in stack[depth:]):
            flush()
        for node in stack[depth:]:
            places[node.name].pop()
        del stack[depth:]

    def last(*names: str) -> int:
        """Place of the innermost open element of these names; 0 if none is open."""
        return max((places[x][-1] for x in names if places.get(x)), default=0)

    at, n = 0, len(page)
    while at < n:
        left = page.find("<", at)
        if left < 0:
            add(page[at:])
            break
        if left > at:
            add(page[at:left])
        m = _TOKEN.match(page, left)
        if not m:
            add("<")
            at = left + 1
            continue
        at = m.end()
        name = (m.group(1) or "").lower()
        if not name:
            continue
        if page.startswith("</", m.start()):
            depth = last(name)
            if depth:
                close(depth)
            elif name == "p":
                flush()
            continue
        if name == "br":
            add(" ")
            continue
        if name in _ENDS_P and last("p"):
            close(last("p"))
        if name in ("li", "tr", "td", "th", "dt", "dd", "option"):
            same = {"td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}.get(name, (name,))
            bound = {"li": ("ul", "ol", "menu"), "option": ("select",)}.get(name, ("table", "dl", "tr") if name in ("td", "th") else ("table", "dl"))
            depth = last(*same)
            if depth > last(*bound):
                close(depth)
        if name not in _INLINE and name not in _HIDDEN:
            flush()
        label, is_core, is_beside, is_hidden = _meaning(name, m.group(2))
        top = stack[-1]
        core = top.core or is_core
        # Headings and bylines in a header inside the article belong to it.
        beside = top.beside or (is_beside and not (name == "header" and top.core))
        hidden = top.hidden or is_hidden
        path = token_code(f"{top.path:x}/{name}" + (f".{label}" if label else ""))
        tags.append(path)
        if len(stack) <= OUTER and name not in _INLINE and name not in _HIDDEN and name not in _VOID:
            outer.add(path)
        if name in _VOID or m.group(0).endswith("/>") and name not in _RAW:
            continue
        if name in _RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>]|$)", re.I).search(page, at)
            at = page.find(">", end.start()) + 1 or n if end else n
            continue
        places.setdefault(name, []).append(len(stack))
        stack.append(Node(name, path, hidden, beside, core, top))
    flush()
    return out, tags, outer


def layout_of(outer: set[int]) -> int:
    """Code of the outer tags of a page: the distinct paths of its block tags at a depth of at most ``OUTER``."""
    return token_code("\n".join(f"{t:x}" for t in sorted(outer))) or 1


def text_code(path: int, text: str) -> int:
    return token_code(f"{path:x}\0{text}")


def occurrences(pages: DataFrame) -> DataFrame:
    """(host, layout, token, n, key) of every token of every page: how often the page (key) has it; ``PAGE`` once for each."""
    schema = "host string, layout long, token long, key long, n int"

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, 100):
                part = batch.slice(begin, 100)
                hosts, layouts, tokens, keys, counts = [], [], [], [], []
                for host, key, page in zip(part.column("host").to_pylist(), part.column("key").to_pylist(), part.column("html").to_pylist(), strict=True):
                    seen: dict[int, int] = {PAGE: 1}
                    text, tags, outer = blocks(page or "")
                    for code in (*tags, *(text_code(p, t) for p, t, beside, core in text if beside or not core)):
                        seen[code] = seen.get(code, 0) + 1
                    hosts += [host] * len(seen)
                    layouts += [layout_of(outer)] * len(seen)
                    keys += [key] * len(seen)
                    tokens += seen
                    counts += seen.values()
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), *(pa.array(x, pa.int64()) for x in (layouts, tokens, keys)), pa.array(counts, pa.int32())], ["host", "layout", "token", "key", "n"])

    return pages.mapInArrow(read, schema)


def token_code(token: str) -> int:
    return xxhash.xxh64_intdigest(token.encode("utf-8", "surrogatepass")) - (1 << 63)


def templates(pages: DataFrame, share: float = 0.5) -> DataFrame:
    """(host, tokens, layouts, vectors): the tokens of the valid classes of each host, the widest class first.

    The vector of a token is the sum (bitwise) over pages of a hash of (page, count); equal sums mean equal vectors. Rows
    with the same ``key`` are one page. Layout 0 marks the classes of the whole host; a layout has classes of its own if at
    least a twentieth of the host's pages have it, so a host has at most 21 / ``share`` times as many template tokens as
    a page has tokens.
    """
    twice = written(pages.groupBy("host", "key").agg(F.count("*").alias("rows")).where("rows > 1").select("host", "key"), "repeated")
    again = small(twice, twice.count())
    # Only repeated pages are shuffled, one of each per task.
    distinct_pages = pages.join(again, ["host", "key"], "left_anti").unionByName(pages.join(again, ["host", "key"], "left_semi").dropDuplicates(["host", "key"]).select(pages.columns))
    vectors = written(occurrences(distinct_pages).groupBy("host", "layout", "token").agg(F.bit_xor(F.xxhash64("key", "n")).alias("vector"), F.count("*").alias("support")), "vectors")
    whole = vectors.groupBy("host", "token").agg(F.bit_xor("vector").alias("vector"), F.sum("support").alias("support"))
    is_page = F.col("token") == PAGE
    sizes = whole.where(is_page & (F.col("support") > 1)).select("host", F.col("support").alias("pages"))
    wide = lambda least: F.col("support") >= F.greatest(F.lit(least), F.ceil(F.col("pages") * share))
    of_host = written(whole.where(~is_page & (F.col("support") > 1)).join(sizes, "host").where(wide(2)).select("host", F.lit(0).cast("long").alias("layout"), "token", "vector", "support"), "host-tokens")
    large = vectors.where(is_page & (F.col("support") > 2)).join(sizes, "host").where(F.col("support") * 20 >= F.col("pages")).select("host", "layout", F.col("support").alias("pages"))
    of_layout = vectors.where(~is_page & (F.col("support") > 2)).join(large, ["host", "layout"]).where(wide(3)).select("host", "layout", "token", "vector", "support")
    of_layout = of_layout.join(of_host.select("host", "token"), ["host", "token"], "left_anti")
    valid = of_host.unionByName(of_layout).select("host", F.struct((-F.col("support")).alias("less"), "layout", "vector", "token").alias("t"))
    sorted_tokens = valid.groupBy("host").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return sorted_tokens.select("host", F.col("t.token").alias("tokens"), F.col("t.layout").alias("layouts"), F.col("t.vector").alias("vectors"))


def classes_of(tokens: list[int], layouts: list[int], vectors: list[int]) -> list[tuple[int, set[int]]]:
    """(layout, tokens) of each class of a host's template, in the given order."""
    found: dict[tuple[int, int], set[int]] = {}
    for token, layout, vector in zip(tokens, layouts, vectors, strict=True):
        found.setdefault((layout, vector), set()).add(token)
    return [(layout, members) for (layout, _), members in found.items()]


def main_text(page: str, template: Sequence[tuple[int, set[int]]]) -> str:
    """The main text's blocks in page order, one per line.

    These are the article's blocks; on a page without any, all blocks that are not beside the content, without the
    template's classes, as long as they leave the page a share of ``OWN`` of its text.
    """
    found, _, outer = blocks(page)
    shown = [(path, text, core) for path, text, beside, core in found if not beside]
    article = [text for _, text, core in shown if core]
    if article or not template:
        return "\n".join(article or [text for _, text, _ in shown])
    layout = layout_of(outer)
    codes = [text_code(path, text) for path, text, _ in shown]
    size: dict[int, int] = {}
    for code, (_, text, _) in zip(codes, shown, strict=True):
        size[code] = size.get(code, 0) + len(text)
    gone: set[int] = set()
    left = total = sum(size.values())
    for of, members in template:
        taken = size.keys() & members if of in (0, layout) else ()
        rest = left - sum(size[c] for c in taken)
        if taken and rest >= OWN * total:
            gone |= taken
            left = rest
    return "\n".join(text for code, (_, text, _) in zip(codes, shown, strict=True) if code not in gone)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", share: float = 0.5) -> DataFrame:
    """One row per page: page_id, url, text and n_chars.

    A null or empty page, or one without main text, gives an empty text. Pages with a null url or without a host share the
    empty host. Repeated rows and null ids keep a row each, and equal pages of a host teach its template once. Whole pages
    are read; nothing is cut.
    """
    narrow = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host_of(F.col(url_col)).alias("host"), F.xxhash64(F.col(html_col)).alias("key"), F.col(html_col).alias("html")
    )
    learnt = written(templates(narrow.select("host", "key", "html"), share), "templates")
    tokens, letters = learnt.agg(F.sum(F.size("tokens")), F.sum(F.octet_length("host"))).first()
    pages_only = narrow.select("page_id", "url", "host", "html")
    schema = T.StructType([pages_only.schema["page_id"], pages_only.schema["url"], T.StructField("text", T.StringType())])
    if 24 * (tokens or 0) + (letters or 0) <= TEMPLATE_BYTES:
        rows = {r.host: (r.tokens, r.layouts, r.vectors) for r in learnt.collect()}
        known = narrow.sparkSession.sparkContext.broadcast(rows)
        return pages_only.mapInArrow(lambda batches: _read(batches, known), schema).withColumn("n_chars", F.length("text").cast("long"))
    # A host with very many pages is divided by adaptive execution, as the pages are the left side of the join.
    joined = pages_only.join(learnt, "host", "left").select("page_id", "url", "host", "html", "tokens", "layouts", "vectors")
    return joined.mapInArrow(lambda batches: _read(batches, None), schema).withColumn("n_chars", F.length("text").cast("long"))


def _read(batches: Iterator[pa.RecordBatch], known) -> Iterator[pa.RecordBatch]:
    """Main texts of pages; a host's template is looked up (``known``) or stands in its rows, and is kept from row to row."""
    host, template = None, []
    for batch in batches:
        for begin in range(0, batch.num_rows, 100):
            part = batch.slice(begin, 100)
            found = []
            for row, (of, page) in enumerate(zip(part.column("host").to_pylist(), part.column("html").to_pylist(), strict=True)):
                if of != host:
                    columns = known.value.get(of, ((), (), ())) if known is not None else (part.column(c)[row].as_py() or [] for c in ("tokens", "layouts", "vectors"))
                    host, template = of, classes_of(*columns)
                found.append(main_text(page or "", template))
            yield pa.RecordBatch.from_arrays([part.column("page_id"), part.column("url"), pa.array(found, pa.string())], ["page_id", "url", "text"])
