"""Main text of pages by a site style tree.

The pages of a host are merged into one tree whose nodes are tag-and-class paths. A node's importance is
the entropy of what its pages show there, divided by the logarithm of their number: the same text on
every page gives 0, a text of its own on each gives 1. A text that stands at a node on many pages counts as
low by itself, whatever the node's other texts. Nodes whose kind says what they are (navigation, forms, scripts,
adverts, comments) are left out; an article is a prior on the importance of what is in and around it.
What is of low importance is removed from each page, and what is left is its text.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from murmuro.runtime import lookup_join, written

# Nodes of lower importance are removed, once so many pages have them.
LEAST_IMPORTANCE, LEAST_PAGES = 0.35, 3
# What the article says beforehand about a node weighs as much as so many pages.
PRIOR_PAGES = 3

_RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "xmp", "noembed"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split()
)
_NOISE = {"aside", "button", "dialog", "fieldset", "footer", "form", "head", "legend", "menu", "nav", "optgroup"}
_NOISE |= {"option", "search", "select", "canvas", "audio", "video", "object"}
_NOISE_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
_NOISE_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "consent cookie cookies disqus gdpr menu modal nav navbar navigation newsletter notice notices notification "
    "pager pagination popup promo promoted promotion recommended related replies reply respond share sharing "
    "sidebar signup social sponsor sponsored subscribe subscription toolbar widget".split()
)
# Only outside an article: inside one they hold its title or source.
_OUTER_WORDS = {"header", "footer", "masthead", "topbar", "login", "search"}
# Inside an article: what may be noise by its name, and words that may stand in such a name.
_CONTAINERS = {"div", "section", "ul", "ol", "dl", "span", "aside", "center", "figure", "header", "footer", "table"}
_PLAIN_WORDS = set(
    "area bar block bottom box buttons button container content footer form group header icons inline inner item items left link "
    "links list main media outer panel post posts right section slot text top unit wrap wrapper bars boxes lists form forms".split()
)
# Of an article that has comments, not of a comment.
_STATES = {"open", "closed", "status", "count"}
# What a start tag ends: a paragraph, and items of its own kind.
_PARAGRAPH = ("p",)
_ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "option": ("option", "p"), "tr": ("tr", "td", "th", "p")}
_ENDS |= {"td": ("td", "th", "p"), "th": ("td", "th", "p")}
# An end tag of one of these closes what is open inside; a paragraph does not reach beyond them.
_SCOPE = _BLOCK - {"p", "h1", "h2", "h3", "h4", "h5", "h6"}

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_CAMEL = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_DIGITS = re.compile(r"\d+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

KEPT, OPEN, REMOVED = 1, 0, -1


class _Node:
    __slots__ = ("tag", "kind", "path", "article")

    def __init__(self, tag: str, kind: int, path: int, article: bool) -> None:
        self.tag, self.kind, self.path, self.article = tag, kind, path, article


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower(): html.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _is_comment(name: str) -> bool:
    """Does this class or id name a reader's comment, and not, as "comments-open", the state of an article?"""
    words = [w.lower() for w in _CAMEL.findall(name)]
    return bool(words) and (words[0] in ("comment", "reply") or words in (["comments"], ["replies"])) and not _STATES & set(words)


def _noisy(tag: str, attributes: dict[str, str], article: bool) -> bool:
    """Is this node one that never holds main text?"""
    if tag in _NOISE and not (article and tag in ("fieldset", "legend")) or tag == "header" and not article:
        return True
    if not attributes:
        return False
    if "hidden" in attributes or attributes.get("aria-hidden") == "true" or attributes.get("role", "").lower() in _NOISE_ROLES:
        return True
    if _HIDDEN.search(attributes.get("style", "")):
        return True
    if tag == "article":
        return any(_is_comment(c) for c in f"{attributes.get('class', '')} {attributes.get('id', '')}".split())
    if tag in ("html", "body", "main"):
        return False
    names = f"{attributes.get('class', '')} {attributes.get('id', '')}"
    if article:
        # Inside an article a name counts only on a container, and only if all its words say so ("share-buttons").
        return tag in _CONTAINERS and any(_all_noise(n) for n in names.split())
    words = {w.lower() for w in _CAMEL.findall(names)}
    return bool(words & _NOISE_WORDS or words & _OUTER_WORDS)


def _all_noise(name: str) -> bool:
    words = {w.lower() for w in _CAMEL.findall(name) if not w.isdigit()}
    return bool(words & _NOISE_WORDS) and words <= _NOISE_WORDS | _PLAIN_WORDS


def blocks(page: str) -> Iterator[tuple[int, int, bool, str]]:
    """(path, kind, inside an article, text) of each block with text, in page order.

    Lenient as browsers are: unclosed tags, stray end tags and attributes without quotes are taken as they
    come. The work grows with the length of the page.
    """
    stack = [_Node("", OPEN, 0, False)]
    # Where the stack has each tag, and where it has one that closes what is open inside.
    places: dict[str, list[int]] = {}
    scopes: list[int] = []
    text: list[str] = []
    raw_until, at = None, 0

    def flush() -> Iterator[tuple[int, int, bool, str]]:
        if text:
            words = "".join(text).split()
            text.clear()
            if words:
                node = stack[-1]
                yield node.path, node.kind, node.article, " ".join(words)

    def pop() -> None:
        places[stack.pop().tag].pop()
        if scopes and scopes[-1] == len(stack):
            scopes.pop()

    while at < len(page):
        if raw_until:
            found = re.compile(rf"</{raw_until}(?=[\s/>]|\Z)", re.I).search(page, at)
            at, raw_until = found.start() if found else len(page), None
            continue
        token = _TOKEN.search(page, at)
        end = token.start() if token else len(page)
        if end > at and stack[-1].kind != REMOVED:
            piece = page[at:end]
            text.append(html.unescape(piece) if "&" in piece else piece)
        if not token:
            break
        at = token.end()
        tag = token[2].lower() if token[2] else None
        if tag is None:
            continue
        if token[1]:  # an end tag
            if places.get(tag):
                if tag in _BLOCK:
                    yield from flush()
                elif scopes and scopes[-1] > places[tag][-1]:
                    continue  # inline markup does not close blocks
                while stack[-1].tag != tag:
                    pop()
                pop()
            elif tag in ("p", "br"):
                yield from flush() if tag == "p" else ()
                text.append(" ")
            continue
        if tag in ("br", "wbr"):
            text.append(" " if tag == "br" else "")
            continue
        if tag in _BLOCK:
            yield from flush()
            # An open paragraph, or the item before this one, ends here, up to the nearest container.
            before = max((places[t][-1] for t in _ENDS.get(tag, _PARAGRAPH) if places.get(t)), default=0)
            if before and not (scopes and scopes[-1] > before):
                while len(stack) > before:
                    pop()
        if tag in _VOID:
            continue
        if tag in _RAW:
            raw_until = tag
        node = stack[-1]
        attributes = _attributes(token[3]) if token[3] and "=" in token[3] or " hidden" in (token[3] or "") else {}
        article = node.article or tag in ("article", "main")
        kind = node.kind
        if kind != REMOVED and (tag in _RAW or _noisy(tag, attributes, node.article)):
            kind = REMOVED
        elif kind == OPEN and tag in ("article", "main"):
            kind = KEPT
        path = node.path
        if tag in _BLOCK and kind != REMOVED:
            # Ids, and numbers in classes, are often of one page only ("post-123"): nodes below would meet no others.
            path = xxhash.xxh64_intdigest(f"{path} {tag} {_DIGITS.sub('', attributes.get('class', ''))}") >> 1
        if kind == REMOVED and node.kind != REMOVED and tag not in _BLOCK:
            text.append(" " if tag not in _RAW else "")
        places.setdefault(tag, []).append(len(stack))
        if tag in _SCOPE:
            scopes.append(len(stack))
        stack.append(_Node(tag, kind, path, article))
        if token[3] and token[3].rstrip().endswith("/") and tag in ("svg", "math"):
            pop()
            raw_until = None
    yield from flush()


def _kept(page: str) -> list[tuple[int, int, bool, str]]:
    """The page's blocks without removed ones."""
    return [b for b in blocks(page) if b[1] != REMOVED]


def _key(path: int, text: str) -> int:
    return xxhash.xxh64_intdigest(f"{path} {text}") >> 1


def page_nodes(pages: DataFrame) -> DataFrame:
    """(host, page, shown, path, block, whole, first, prior, copies) of pages (host, page, html), a row for each block.

    `shown` is a digest of all that is left of the page, `whole` of what it shows at the path; one block of each
    path is its `first`. `prior` is 1 inside an article; outside it is the share of the page's text that
    is outside, so a page whose article is but a teaser keeps its story; null where there is no article.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for host, page, text in zip(*(batch.column(c).to_pylist() for c in ("host", "page", "html")), strict=True):
                found = _kept(text)
                size = sum(len(b[3]) for b in found)
                outside = sum(len(b[3]) for b in found if not b[2])
                shown, whole = xxhash.xxh64(), {}
                keys: dict[int, tuple[int, float | None]] = {}
                for path, _, article, words in found:
                    line = f"{words}\n"
                    shown.update(f"{path} {line}")
                    whole.setdefault(path, xxhash.xxh64()).update(line)
                    keys.setdefault(_key(path, words), (path, 1.0 if article else outside / size if outside < size else None))
                begun = set()
                for key, (path, prior) in keys.items():
                    digest = whole[path].intdigest() >> 1
                    rows.append((host, page, shown.intdigest() >> 1, path, key, digest, path not in begun, prior))
                    begun.add(path)
            columns = zip(*rows, strict=True) if rows else [[] for _ in kinds]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values(), strict=True)], list(kinds))

    kinds = {"host": pa.string()} | dict.fromkeys(("page", "shown", "path", "block", "whole"), pa.int64())
    kinds |= {"first": pa.bool_(), "prior": pa.float64()}
    schema = "host string, page bigint, shown bigint, path bigint, block bigint, whole bigint, first boolean, prior double"
    rows = pages.select("host", "page", "html").mapInArrow(emit, schema)
    return rows.groupBy(*kinds).agg(F.count(F.lit(1)).alias("copies"))


def node_importance(seen: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of the nodes in distinct rows (host, shown, path, block, whole, first).

    Counted as distinct (host, path, content) rows first, so a large host is spread over its contents.
    """
    counts = seen.where("first").groupBy("host", "path", "whole").agg(F.count(F.lit(1)).alias("c"))
    # sum of -c/n log(c/n) is log n - (sum of c log c) / n
    nodes = counts.groupBy("host", "path").agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("clogc"))
    entropy = F.log("pages") - F.col("clogc") / F.col("pages")
    return nodes.select(
        "host",
        "path",
        "pages",
        F.when(F.col("pages") > 1, entropy / F.log("pages")).otherwise(F.lit(1.0)).alias("importance"),
    )


def removed_blocks(rows: DataFrame, least: float = LEAST_IMPORTANCE, pages: int = LEAST_PAGES) -> DataFrame:
    """(host, page, gone, copies): the low blocks of each page, only pages that have some; `rows` as of `page_nodes`.

    A block is as important as its node, or less where its own text stands at that node on many pages: on c of
    n it gives 1 - log c / log n, whose mean over a node is the node's importance. Pages that show the same count once.
    """
    seen = written(rows.select("host", "shown", "path", "block", "whole", "first").distinct(), "seen")
    nodes = written(node_importance(seen).withColumn("weight", F.col("pages")), "nodes")
    again = seen.groupBy("host", "path", "block").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    again = written(again.withColumn("weight", F.col("c")), "again")
    joined = lookup_join(rows, nodes, ["host", "path"], spread=["page"], weight="weight")
    joined = lookup_join(joined, again, ["host", "path", "block"], "left", spread=["page"], weight="weight")
    n, prior = F.col("pages"), F.col("prior")
    measured = F.least("importance", 1 - F.log("c") / F.log(n))
    low = F.when(prior.isNull(), (measured < least) & (n >= pages))
    low = low.otherwise(n * measured + PRIOR_PAGES * prior < least * (n + PRIOR_PAGES))
    # At most the blocks of one page in a row.
    return joined.where(low).groupBy("host", "page").agg(F.collect_set("block").alias("gone"), F.max("copies").alias("copies"))


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every page.

    Blocks are trimmed, white space inside them becomes one blank, and they are joined by line breaks in
    page order; character references are decoded. Text outside an article (or main) element needs pages of the
    host that show it to be important, unless it is most of its page; text inside needs them to be removed. A
    missing page or one without text gives an empty text, a missing or unreadable URL puts the page on a
    host of its own name "". Repeated rows each give a row. Other columns are left out. No rows give no rows.
    """
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"(?i)^\s*(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:\s]+)", 1))
    pages = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), host.alias("host"))
    pages = pages.withColumn("page", F.xxhash64("html"))
    low = written(removed_blocks(written(page_nodes(pages), "rows")), "removed")
    joined = lookup_join(pages, low, ["host", "page"], "left", spread=["page_id", "url"], weight="copies")
    joined = joined.select("page_id", "url", "html", "gone")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for page, low_blocks in zip(batch.column("html").to_pylist(), batch.column("gone").to_pylist(), strict=True):
                gone = set(low_blocks or ())
                texts.append("\n".join(b[3] for b in _kept(page) if not gone or _key(b[0], b[3]) not in gone))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    return joined.mapInArrow(extract, "page_id bigint, url string, text string, n_chars bigint")
