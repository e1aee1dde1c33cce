"""Main text of web pages by equivalence-class template deduction over the pages of a host."""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcloom.llm.text import bounded, small_batches
from arcloom.llm.url_filter import host_of
from arcloom.storage import small_side, written

#: A class belongs to a host's template if it occurs on this share of the host's pages, and on so many at least.
SUPPORT = 0.9
LEAST_PAGES = 8
#: Template text is left out of a page unless that would take more than this share of the page's main text.
MOST_TEMPLATE = 0.5
#: Template tokens over all hosts up to which the templates may be broadcast.
BROADCAST_TOKENS = 500_000

# HTML element names by role, and words of class, id and role attributes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html li main menu nav ol p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
DROPPED = frozenset(
    "applet aside audio button canvas dialog embed footer form frame frameset head iframe input map math menu nav "
    "noscript object script select style svg template textarea title video".split()
)
BAD_WORDS = frozenset(
    "ad ads adsense advert adverts advertisement advertising advertorial alert banner breadcrumb breadcrumbs "
    "comment comments consent cookie cookies disclaimer disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices overlay pager pagination popup promo promotion recommended "
    "related replies reply respond search share sharing sidebar sidenav signup skip social sponsor sponsored "
    "subscribe subscription toolbar topbar widget".split()
)
BAD_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
GOOD_WORDS = frozenset("article articlebody content entry main post story wrapper container page".split())

_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"<]*\"|'[^'<]*'|[\"'])*)>?",
    re.S,
)
_ATTR = re.compile(r"([^\s=\"'/>]+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


@dataclass
class Frame:
    tag: str
    path: int
    bad: bool
    article: bool
    main: bool
    content: bool
    named: bool = False  # bad only by a class word of what holds the article that this stands in
    form: bool = False  # bad only by a form that holds it


@dataclass
class Block:
    """Text between two block borders: its token, where it stands and how much of it is in links."""

    text: str
    token: int
    frame: Frame
    at: int
    linked: int = 0


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    tokens: list[int] = field(default_factory=list)  # template tokens in page order: tags and text, by path


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass")) >> 1


def _attributes(text: str) -> dict[str, str]:
    return {k.lower(): html.unescape(v.strip("\"'")) for k, v in _ATTR.findall(text)} if text.strip(" /\t\r\n") else {}


def _opened(tag: str, attrs: dict[str, str], parent: Frame) -> Frame:
    names = {w.lower() for w in _WORDS.findall(f"{attrs.get('class', '')} {attrs.get('id', '')}")}
    article = parent.article or tag == "article" or "articleBody" in attrs.get("itemprop", "")
    main = parent.main or tag == "main" or attrs.get("role", "").lower() == "main"
    whole = tag in ("html", "body", "article", "main")
    inherited = parent.bad and not (parent.form and tag in ("article", "main"))  # a form may wrap a whole page
    words = not (whole and not parent.article) and bool(names & BAD_WORDS) and not names & GOOD_WORDS
    hard = (
        tag in DROPPED or "hidden" in attrs or attrs.get("role", "").lower() in BAD_ROLES
        or tag == "header" and not (article or main)
        or bool(names & {"comment", "comments", "ad", "ads", "advert", "advertisement", "cookie"}) and tag not in ("html", "body")
        or re.search(r"display\s*:\s*none", attrs.get("style", "")) is not None
    )
    bad = inherited or hard or words
    form = bad and (parent.form and not (hard or words) if inherited else tag == "form" and not words)
    # a class word outside the article is a hint only; anything else that is bad, or bad inside it, is not
    named = not hard and (parent.named and not (words and article) if parent.bad else words and not article)
    content = parent.content or bool(names & {"content", "article", "story", "entry", "post"}) and not whole
    shown = tag + "." + ".".join(sorted(names)) if names else tag
    return Frame(tag, _hash(parent.path, shown), bad, article, main, content, named, form)


def parse(source: str) -> Page:
    """Blocks and template tokens of a page; unclosed and stray tags are tolerated."""
    page, stack = Page(), [Frame("", 0, False, False, False, False)]
    parts: list[str] = []
    links = linked = at = 0
    owner = stack[0]
    places: dict[str, list[int]] = {}  # where each tag stands on the stack
    holders: list[int] = []  # of them, what a stray end tag inside does not close

    def push(frame: Frame) -> None:
        places.setdefault(frame.tag, []).append(len(stack))
        if frame.tag in ("article", "main", "body", "html"):
            holders.append(len(stack))
        stack.append(frame)

    def pop() -> None:
        places[stack.pop().tag].pop()
        while holders and holders[-1] >= len(stack):
            holders.pop()

    def flush() -> None:
        nonlocal parts, linked
        text = " ".join(html.unescape("".join(parts)).split()) if parts else ""
        if text:
            token = _hash(owner.path, "text", text)
            page.blocks.append(Block(text, token, owner, len(page.tokens), linked))
            page.tokens.append(token)
        parts, linked = [], 0

    def add(text: str) -> None:
        nonlocal linked, owner
        if not text:
            return
        if not parts or owner is not stack[-1]:
            if parts and owner.bad != stack[-1].bad:
                flush()
            owner = stack[-1] if not parts else owner
        parts.append(text)
        if links:
            linked += len(text)

    n = len(source)
    while at < n:
        m = _MARKUP.search(source, at)
        if m is None:
            add(source[at:])
            break
        add(source[at : m.start()])
        at = m.end()
        if m["tag"] is None:
            continue
        tag = m["tag"].lower()
        if m["close"]:
            if tag == "a":
                links = max(0, links - 1)
            if tag in BLOCK:
                flush()
            k = places[tag][-1] if places.get(tag) else 0
            if k and (tag in ("main", "body", "html") or not holders or k >= holders[-1]):
                if any(f.bad != stack[k - 1].bad for f in stack[k:]):
                    flush()
                page.tokens.append(_hash(stack[k].path, "close"))
                while len(stack) > k:
                    pop()
            continue
        if tag in BLOCK:
            flush()
            if stack[-1].tag == "p" or tag == stack[-1].tag and tag in ("li", "dt", "dd", "td", "th", "tr", "option"):
                pop()
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*>", re.I).search(source, at)
            at = end.end() if end else n
            continue
        if tag in VOID:
            if tag != "br" and tag != "hr":
                page.tokens.append(_hash(stack[-1].path, tag))
            continue
        if tag == "a":
            links += 1
        if tag in BLOCK or tag in DROPPED or tag in ("span", "details", "summary"):
            attrs = _attributes(m["attrs"])
            frame = _opened(tag, attrs, stack[-1])
            if frame.bad != stack[-1].bad:
                flush()
            page.tokens.append(_hash(frame.path, "open"))
            if not m["attrs"].rstrip().endswith("/") or tag not in ("span", "svg"):
                push(frame)
    flush()
    return page


def _valid(page: Page, template: dict[int, int]) -> set[int]:
    """Classes of the template that nest on this page: spans of two classes are apart or one holds the other."""
    spans: dict[int, list[int]] = {}
    for i, t in enumerate(page.tokens):
        c = template.get(t)
        if c is not None:
            spans.setdefault(c, [i, i])[1] = i
    ordered, open_, bad = sorted(spans.items(), key=lambda x: (x[1][0], -x[1][1])), [], set()
    for c, (first, last) in ordered:
        while open_ and open_[-1][1] < first:
            open_.pop()
        if open_ and last > open_[-1][1]:
            bad.add(c)
            continue
        open_.append((c, last))
    return set(spans) - bad


def main_blocks(page: Page, template: dict[int, int]) -> list[Block]:
    """Blocks of the page's main slots: what the template leaves, without boilerplate regions.

    Text that the template holds is no main text wherever it stands, unless it is most of the page's text outside
    boilerplate regions. Of what is left, names are tie-breakers: the slots of an article element hold the main text;
    without one those of main, of a content container, or of the whole body without lists of links. An article that
    only a class word of an ancestor calls boilerplate counts if it has more text than those.
    """
    left = page.blocks
    if template:
        valid = _valid(page, template)
        left = [b for b in left if template.get(b.token) not in valid]
    chosen = _by_names(left)
    if template and len(left) < len(page.blocks):
        every = _by_names(page.blocks)
        if _chars(chosen) < (1 - MOST_TEMPLATE) * _chars(every):
            return every
    return chosen


def _by_names(blocks: list[Block]) -> list[Block]:
    """The blocks that element and class names call main text."""
    good = [b for b in blocks if not b.frame.bad]
    if chosen := [b for b in good if b.frame.article]:
        return chosen
    for kind in ("main", "content"):
        if chosen := [b for b in good if getattr(b.frame, kind)]:
            break
    else:
        chosen = [b for b in good if not (b.linked and b.linked * 2 > len(b.text))]
    if not chosen:  # a form around the whole page
        chosen = [b for b in blocks if b.frame.form and not (b.linked and b.linked * 2 > len(b.text))]
    hinted = [b for b in blocks if b.frame.named and b.frame.article]
    return hinted if _chars(hinted) > _chars(chosen) else chosen


def _chars(blocks: list[Block]) -> int:
    return sum(len(b.text) for b in blocks)


def extract(source: str | None, template: dict[int, int] | None = None) -> str:
    """The page's main text: its blocks, one per line."""
    return "\n".join(b.text for b in main_blocks(parse(source or ""), template or {}))


def deduce_templates(pages: DataFrame, support: float = SUPPORT, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, template`` with one row per host that has one; ``pages`` has ``host`` and ``html``.

    A token is a tag or a text with its path. Its occurrence vector (how often it occurs on each page of the host)
    is folded into an order-free fingerprint per batch and then by (host, token), so vectors are never
    gathered and a host with a third of all pages costs no more than its distinct tokens. Tokens of one host with equal vectors form a
    class; classes on at least ``support`` of the host's pages (``least_pages`` at least, of different content)
    make up the template, as an array of (token, class).
    """

    def run(batches):
        for b in small_batches(batches, "html", 4 << 20):
            seen: dict[tuple[str, int], list[int]] = {}
            for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist(), strict=True):
                source = source or ""
                page = xxhash.xxh64_intdigest(source.encode("utf-8", "surrogatepass"))
                counts = Counter(parse(source).tokens)
                counts[0] = 1
                for token, n in counts.items():
                    x = seen.setdefault((host, token), [0, 0, 0, 0])
                    x[0] ^= _hash(page, n)
                    x[1] += 1
                    x[2] += n
                    x[3] |= 1 << (page % 63)
            if seen:
                keys, values = zip(*seen.items(), strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys], pa.int64())]
                    + [pa.array([v[c] for v in values], pa.int64()) for c in range(4)],
                    names=["host", "token", "vector", "pages", "total", "contents"],
                )

    folded = (
        pages.where("host <> ''").select("host", "html")
        .mapInArrow(run, "host string, token long, vector long, pages long, total long, contents long")
        .groupBy("host", "token")
        .agg(
            F.bit_xor("vector").alias("vector"), F.sum("pages").alias("pages"), F.sum("total").alias("total"),
            F.bit_count(F.bit_or("contents")).alias("contents"),
        )
        .where((F.col("pages") >= least_pages) & (F.col("contents") >= least_pages))
    )
    folded = written(folded, "vectors")
    sizes = small_side(written(folded.where("token = 0").select("host", F.col("pages").alias("all")), "sizes"))
    often = folded.where("token <> 0").join(sizes, "host").where(F.col("pages") >= support * F.col("all"))
    return often.select(
        "host", F.struct("token", F.xxhash64("vector", "pages", "total").alias("cls")).alias("x")
    ).groupBy("host").agg(F.collect_list("x").alias("template"))


def extract_pages(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    support: float = SUPPORT, least_pages: int = LEAST_PAGES,
) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page.

    ``text`` is the main text: character references decoded, white space inside a block as one space, blocks in
    page order joined by one line feed; empty if there is none; ``n_chars`` counts its code points. Null pages
    count as empty, null urls have no host and no template. Rows may repeat; other columns are not read.
    """
    spark = bounded(pages).sparkSession
    named = pages.select(
        F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
        host_of(F.col(url_col).cast("string")).alias("host"),
    )
    templates = written(deduce_templates(named, support, least_pages), "templates")
    size = templates.agg(F.coalesce(F.sum(F.size("template")), F.lit(0))).first()[0]
    if size <= BROADCAST_TOKENS:
        found = {r["host"]: {x["token"]: x["cls"] for x in r["template"]} for r in templates.collect()}
        shared, rows = spark.sparkContext.broadcast(found), named.withColumn("template", F.lit(None).cast("array<struct<token:long,cls:long>>"))
    else:
        shared, rows = None, named.join(templates, "host", "left")

    def run(batches):
        for b in small_batches(batches, "html", 4 << 20):
            texts = []
            columns = (b.column(c).to_pylist() for c in ("host", "html", "template"))
            for host, source, own in zip(*columns, strict=True):
                template = shared.value.get(host) if shared else {x["token"]: x["cls"] for x in own or []}
                texts.append(extract(source, template))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    id_type = dict(pages.dtypes)[id_col]
    return rows.select("page_id", "url", "html", "host", "template").mapInArrow(
        run, f"page_id {id_type}, url string, text string, n_chars long"
    )
