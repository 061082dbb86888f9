"""Main text of web pages by equivalence classes of tokens across the pages of a host.

Tokens are tags with the path of elements they stand in, and whole text chunks with that path. Tokens
that occur equally often on every page of a host, so that their occurrence vectors are equal, form a
class. Classes that are frequent on the host and large enough nest into its template; text chunks among
them are the template's own words. What remains between the template's tags are slots, and the slots of
the article's container hold the main text.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicegate.llm.common import Batches, Scratch, fields, map_batches, texts_of

# A class belongs to the template if its tokens are on this share of the host's pages, and on at least
# so many pages; fewer pages tell nothing about what a host repeats.
SUPPORT, LEAST_PAGES = 0.6, 4
# A container is the article's if it holds this share of the host's text in slots.
CONTAINER_SHARE = 0.6
# Templates up to this size in all are sent to the tasks; larger sets are joined by host.
BROADCAST_BYTES = 16 << 20

# Element kinds of HTML.
RAW = {"script", "style", "noscript", "template", "textarea", "iframe", "noframes", "xmp", "title", "svg", "math"}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr",
}
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "caption", "center", "dd", "details", "dialog", "div", "dl",
    "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head", "header",
    "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "optgroup", "option", "p", "pre", "search",
    "section", "select", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "button", "video",
    "audio", "object", "canvas", "label", "datalist",
}
# Elements that an opening tag of one of the given kinds closes.
CLOSED_BY = {
    "p": BLOCK - {"td", "th", "caption", "button", "object", "video", "audio", "canvas", "label", "option"},
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot", "thead"}, "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"}, "thead": {"tbody", "tfoot"}, "tbody": {"tbody", "tfoot"},
    "head": {"body"},
}
# Elements and names that mark what is not the article.
NOT_TEXT = {
    "aside", "audio", "button", "canvas", "datalist", "dialog", "footer", "form", "head", "header", "menu", "nav",
    "object", "option", "search", "select", "video",
}
NOT_TEXT_NAMES = {
    "ad", "ads", "adbox", "advert", "adverts", "advertisement", "advertising", "alert", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "disclaimer",
    "disqus", "footer", "gdpr", "header", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter",
    "notice", "notices", "notification", "pager", "pagination", "popup", "promo", "promoted", "promotion", "recommended",
    "related", "replies", "respond", "search", "share", "sharing", "sidebar", "signup", "skip", "social", "sponsor",
    "sponsored", "subscribe", "toolbar", "widget", "widgets",
}
ARTICLE_NAMES = {"article", "articlebody", "entry", "story"}

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.DOTALL
)
_ATTRIBUTE = re.compile(r"""([^\s=/"'<>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_NAME = re.compile("[a-z0-9]+")
_NUMBER = re.compile("[0-9]+")
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.IGNORECASE) for tag in RAW}


@functools.lru_cache(maxsize=4096)
def _described(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """An element's token (numbers in names are left out), whether it is no text, whether an article."""
    found = {k.lower(): (v or "").strip("\"'").lower() for k, v in _ATTRIBUTE.findall(attributes)} if attributes else {}
    label = " ".join(found.get(k, "") for k in ("class", "id", "role", "itemprop")).strip()
    names = set(_NAME.findall(label))
    style = found.get("style", "").replace(" ", "")
    hidden = "hidden" in found or found.get("aria-hidden") == "true" or "display:none" in style
    kinds = found.get("class", "").split()
    by_name = bool(names & NOT_TEXT_NAMES) and tag not in ("html", "body", "main", "article")
    no_text = tag in NOT_TEXT or hidden or by_name
    named = bool(set(_NAME.findall(found.get("itemprop", ""))) & ARTICLE_NAMES) or any(
        kind in ARTICLE_NAMES or kind.startswith(("article-body", "entry-content", "post-content", "story-body"))
        for kind in kinds
    )
    marks = sorted({_NUMBER.sub("#", kind) for kind in kinds})
    return ".".join([tag, *marks]), no_text, named


class Chunk:
    """Text between two block borders, with the elements it stands in."""

    __slots__ = ("path", "text", "linked", "skipped", "article")

    def __init__(self, path: str, text: str, linked: int, skipped: bool, article: bool):
        self.path, self.text, self.linked, self.skipped, self.article = path, text, linked, skipped, article


def parse(page: str) -> Iterator[Chunk | str]:
    """A page's blocks of text, and its opening tags with their paths, in order.

    References are decoded and white space is one space. Elements left open are closed as browsers
    close them; elements that only format text are no part of paths. A page may end anywhere.
    """
    stack: list[tuple[str, str, bool, bool]] = [("", "", False, False)]  # tag, path, no text, article
    parts: list[str] = []
    linked = 0
    links = 0

    def flush() -> Iterator[Chunk]:
        nonlocal linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        parts.clear()
        if text:
            _, path, skipped, article = stack[-1]
            yield Chunk(path, text, min(linked, len(text)), skipped, article)
        linked = 0

    position = 0
    while position < len(page):
        match = _TOKEN.search(page, position)
        text = page[position : match.start() if match else len(page)]
        if text:
            parts.append(text)
            linked += len(text) if links else 0
        if not match:
            break
        position = match.end()
        tag = match[2]
        if tag is None:
            continue
        tag, closing = tag.lower(), bool(match[1])
        if tag in RAW and not closing:
            end = None if match[3].endswith("/") else _RAW_END[tag].search(page, position)
            position = end.end() if end else (position if match[3].endswith("/") else len(page))
            if tag not in ("noscript", "svg", "math"):
                yield f"{stack[-1][1]}/{tag}"
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag == "a":
            links = 0 if closing else 1
        if tag not in BLOCK:
            continue
        yield from flush()
        if closing:
            depth = next((k for k in range(len(stack) - 1, 0, -1) if stack[k][0] == tag), 0)
            if depth:
                del stack[depth:]
            continue
        while len(stack) > 1 and tag in CLOSED_BY.get(stack[-1][0], ()):
            stack.pop()
        token, no_text, named = _described(tag, match[3])
        _, path, skipped, article = stack[-1]
        path = f"{path}/{token}"
        yield path
        if tag in VOID:
            continue
        # A header inside an article is the article's own.
        no_text = no_text and not (article and tag == "header")
        stack.append((tag, path, skipped or no_text, (article or tag in ("article", "main") or named) and not no_text))
    yield from flush()


def _hash(token: str) -> int:
    data = token.encode("utf-8", "surrogatepass")
    return (zlib.crc32(data) << 32 | zlib.crc32(data[::-1], 0x5BD1E995)) - (1 << 63)


def host_of(url: str | None) -> str:
    """The host of an address, in lower case; empty if there is none."""
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def _tokens(batches: Batches) -> Batches:
    """Tokens of a batch's pages by host: on how many pages, and their occurrence vector's digest.

    A digest adds a number for each page and the token's count there, so digests of batches add up,
    and tokens that occur equally often on every page have equal ones. Elements that can hold an
    article also come with their path and the characters of unlinked text in them. The row without a
    token counts a host's pages.
    """
    for batch in batches:
        sums: dict[tuple[str, int], list] = {}
        for url, page in zip(batch.column("url").to_pylist(), texts_of(batch, "html"), strict=True):
            host = host_of(url)
            counts: dict[int, int] = {}
            chars: dict[str, int] = {}
            for item in parse(page):
                token = _hash(item) if isinstance(item, str) else text_token(item)
                counts[token] = counts.get(token, 0) + 1
                if isinstance(item, str):
                    chars.setdefault(item, 0)
                elif not item.skipped:
                    place = item.path
                    while place:
                        chars[place] = chars.get(place, 0) + max(0, len(item.text) - item.linked)
                        place = place.rpartition("/")[0]
            paths = {_hash(path): path for path in chars if container(path)}
            page_key = _hash(f"{url} {page}")
            counts[PAGES] = 1
            for token, n in counts.items():
                row = sums.setdefault((host, token), [0, 0, 0, paths.get(token, ""), 0])
                digest = zlib.crc32(f"{page_key}:{n}".encode())
                row[0] += 1
                row[1] += digest
                row[2] += zlib.crc32(digest.to_bytes(4, "little"), n) * 2654435761 & 0xFFFFFFFF
                row[4] += chars.get(row[3], 0)
        columns = [[host for host, _ in sums], [token for _, token in sums], *zip(*sums.values(), strict=True)]
        kinds = [pa.string(), pa.int64(), *[pa.int64()] * 3, pa.string(), pa.int64()]
        names = ["host", "token", "pages", "first", "second", "path", "chars"]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


# The token that stands for a page itself.
PAGES = 0


def container(path: str) -> bool:
    """Whether a path leads to an element that can hold a whole article."""
    return path.rpartition("/")[2].partition(".")[0] in ("article", "body", "div", "main", "section", "td")


def text_token(chunk: Chunk) -> int:
    return _hash(f"{chunk.path}|{chunk.text}")


def deduce(df: DataFrame, scratch: Scratch, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Templates of hosts: ``host``, ``container`` (path of the article's element), ``fixed`` tokens.

    Occurrence vectors are compared by digests that are added up in the tasks. A class is valid if it
    is on enough of the host's pages and holds three tokens or more, elements among them: a text that
    recurs by itself is no template. ``fixed`` lists the tokens of valid classes; it is bounded by the
    tokens that 60 % of a host's pages share. The container is the deepest element with most of the
    text.
    """
    pages = df.select(df[url_col].alias("url"), df[html_col].alias("html"))
    tokens = map_batches(
        pages, _tokens, "host string, token long, pages long, first long, second long, path string, chars long"
    )
    tokens = tokens.groupBy("host", "token").agg(
        *[F.sum(c).alias(c) for c in ("pages", "first", "second", "chars")], F.max("path").alias("path")
    )
    tokens = scratch.table(tokens, "tokens")
    hosts = tokens.where(F.col("token") == PAGES).select("host", F.col("pages").alias("all_pages"))
    frequent = (
        tokens.where((F.col("token") != PAGES) & (F.col("pages") >= LEAST_PAGES))
        .join(hosts, "host")
        .where(F.col("pages") >= F.col("all_pages") * SUPPORT)
    )
    classes = frequent.groupBy("host", "pages", "first", "second").agg(
        F.collect_list("token").alias("tokens"), F.count("*").alias("size"), F.max("path").alias("path")
    )
    valid = classes.where((F.col("size") >= 3) & (F.col("path") != ""))
    fixed = valid.groupBy("host").agg(F.flatten(F.collect_list("tokens")).alias("fixed"))
    most = tokens.groupBy("host").agg(F.max("chars").alias("most"))
    containers = (
        tokens.where("path <> ''")
        .join(most, "host")
        .where((F.col("chars") >= F.col("most") * CONTAINER_SHARE) & (F.col("chars") > 0))
        .groupBy("host")
        .agg(F.max_by("path", F.struct(F.size(F.split("path", "/")), "path")).alias("container"))
    )
    return scratch.table(
        hosts.select("host").join(containers, "host", "left").join(fixed, "host", "left"), "templates"
    )


def extract(page: str, container_path: str | None, fixed: frozenset[int]) -> str:
    """The main text of a page under its host's template: the slots of the article, as blocks.

    Slots are the chunks that are no token of the template. If the template claims more than half of an
    article, its pages are copies of each other, and the claim is dropped.
    """
    chunks = [item for item in parse(page) if not isinstance(item, str) and not item.skipped]
    own = [chunk for chunk in chunks if chunk.article]
    if not own and container_path:
        own = [c for c in chunks if c.path == container_path or c.path.startswith(container_path + "/")]
    own = own or chunks
    slots = [chunk for chunk in own if text_token(chunk) not in fixed] if fixed else own
    if 2 * sum(len(c.text) for c in slots) < sum(len(c.text) for c in own):
        slots = own
    return "\n\n".join(chunk.text for chunk in slots)


def main_text(
    df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` (code points) of every page.

    ``text`` is the article: blocks in page order, joined by an empty line, without elements and names
    that mark menus, headers, footers, sidebars, notices, adverts, forms and comments, and without the
    template's own words. Pages are read whole, twice: for the templates of their hosts and for their
    texts.

    Null and empty pages have the empty text; pages cut off anywhere are read as far as they go. Pages
    without an address share one nameless host; hosts of fewer than four pages have no template words.
    Repeated rows give a row each, null ids stay null, other columns are not read; an empty table gives
    an empty result.
    """
    scratch = Scratch(df.sparkSession)
    templates = deduce(df, scratch, url_col, html_col)
    scratch.drop("tokens")
    schema = T.StructType(
        [
            *fields(df, {"page_id": id_col, "url": url_col}),
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )
    pages = df.select(df[id_col].alias("id"), df[url_col].alias("url"), df[html_col].alias("html"))

    def written(batch: pa.RecordBatch, texts: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())],
            names=schema.names,
        )

    size = templates.agg(F.sum(64 + F.coalesce(F.size("fixed"), F.lit(0)) * 8)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        rows = templates.toArrow().to_pylist()
        shared = df.sparkSession.sparkContext.broadcast(
            {row["host"]: (row["container"], frozenset(row["fixed"] or ())) for row in rows}
        )

        def extracted(batches: Batches) -> Batches:
            known = shared.value
            for batch in batches:
                urls = batch.column("url").to_pylist()
                templates_of = [known.get(host_of(url), (None, frozenset())) for url in urls]
                yield written(batch, [extract(p, *t) for p, t in zip(texts_of(batch, "html"), templates_of, strict=True)])

        return map_batches(pages, extracted, schema)

    def extracted_joined(batches: Batches) -> Batches:
        for batch in batches:
            containers, fixed = batch.column("container").to_pylist(), batch.column("fixed").to_pylist()
            yield written(
                batch,
                [extract(p, c, frozenset(f or ())) for p, c, f in zip(texts_of(batch, "html"), containers, fixed, strict=True)],
            )

    hosts = map_batches(
        pages, _with_host, T.StructType([*pages.schema.fields, T.StructField("host", T.StringType())])
    )
    return map_batches(hosts.join(templates, "host", "left").drop("host"), extracted_joined, schema)


def _with_host(batches: Batches) -> Batches:
    for batch in batches:
        hosts = pa.array([host_of(url) for url in batch.column("url").to_pylist()], pa.string())
        yield batch.append_column("host", hosts)
