"""Main text of web pages by site style trees."""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import bounded_batches, stage
from aislewise.llm.url_rules import split_url

#: Fixed values of HTML: elements without content, with raw text, and that begin a block.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
RAW = frozenset("script style textarea title noscript iframe xmp template noembed".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
    "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split()
)
#: An element of the left set ends an open one of the same kind, up to an element that contains it.
ITEMS = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table", "thead", "tbody", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "optgroup"}),
}
HOLDERS = frozenset("article aside body blockquote div main nav section td th table li".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

#: Presentation of noise: elements, roles, and words of class and id.
NOISE = frozenset(
    "nav footer aside form script style noscript template iframe object svg math canvas button select "
    "textarea input dialog menu head title audio video map".split()
)
NOISE_ROLES = frozenset(
    "navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
    "status toolbar".split()
)
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs comment "
    "comments consent cookie cookies copyright disclaimer disqus footer gdpr login masthead menu modal "
    "nav navbar navigation newsletter notice notices notification overlay pager pagination popup promo "
    "promoted promotion recommended related replies reply respond share sharing sidebar signup skip "
    "social sponsor sponsored subscribe subscription toolbar topbar widget widgets".split()
)
#: What states an element as content; an article is in doubt if a class word is on it or above it.
PLAIN, IN_MAIN, DOUBTED, ARTICLE = range(4)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+|[^>]*)>",
    re.S,
)
CLOSED = re.compile(r"\A<!--.*-->\Z|\A<!\[CDATA\[.*\]\]>\Z", re.S)
#: What is left to find behind the last ">": all of these run to the end.
REST = re.compile(r"<!--|(<!\[CDATA\[)|<[!?]")
ATTRIBUTE = re.compile(
    r"(class|id|role|style|aria-hidden|hidden|itemprop)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?",
    re.I,
)


@dataclass(frozen=True)
class TreeSettings:
    """A node is noise if at least `pages` different pages of its host have it and both its
    entropies are below `least`, in shares of the greatest possible. Of a noise node those contents
    go that `pages` pages and a share `common` of the node's pages have."""

    pages: int = 5
    least: float = 0.2
    common: float = 0.01


@dataclass
class _Open:
    tag: str
    key: int
    noise: bool
    word: bool
    loose: bool
    main: int
    head: bool


@dataclass
class Page:
    """Blocks of text in page order, and per style-tree node its parent, children and texts.

    A block has its node, whether a class word makes it noise, and what states it as content.
    """

    blocks: list[tuple[int, bool, int, str]] = field(default_factory=list)
    parents: dict[int, int] = field(default_factory=dict)
    styles: dict[int, list[str]] = field(default_factory=dict)
    texts: dict[int, list[str]] = field(default_factory=dict)


@lru_cache(maxsize=100_000)
def _node(parent: int, name: str) -> int:
    """Number of the style-tree node below `parent` for elements of one tag and class."""
    digest = hashlib.blake2b(f"{parent}/{name}".encode(errors="replace"), digest_size=8).digest()
    return int.from_bytes(digest, "big", signed=True)


def _value(parts: list[str]) -> int:
    text = "\0".join(parts).encode(errors="replace")
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big", signed=True)


@lru_cache(maxsize=20_000)
def _presentation(tag: str, attributes: str) -> tuple[str, bool, bool, int]:
    """Name of the node, whether it is noise, whether a class word says so, and what it states."""
    given = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(attributes)} if attributes else {}
    words = re.split(r"[^a-z0-9]+", f"{given.get('class', '')} {given.get('id', '')}".lower())
    roles = set(given.get("role", "").lower().split())
    hidden = (
        "hidden" in given
        or given.get("aria-hidden", "").lower() == "true"
        or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", given.get("style", ""), re.I)
    )
    noise = bool(tag in NOISE or roles & NOISE_ROLES or hidden)
    word = bool(NOISE_WORDS & set(words)) and tag not in ("html", "body")
    main = PLAIN
    if tag == "main" or "main" in roles:
        main = IN_MAIN
    elif tag == "article" or given.get("itemprop", "").lower() == "articlebody":
        main = DOUBTED if word else ARTICLE
    name = tag + "".join(f".{w}" for w in sorted(set(words)) if w and not w.isdigit())
    return name, noise, word, PLAIN if noise else main


def parse(source: str) -> Page:
    """One page's blocks and style-tree nodes.

    Open paragraphs and items end where HTML says, wrong end tags are passed over, what is left
    open ends with the page. Any text is a page.
    """
    page, text = Page(), []
    stack = [_Open("", 0, False, False, False, PLAIN, False)]
    # Where in the stack elements of each tag, and blocks, are open.
    places: defaultdict[str, list[int]] = defaultdict(list)
    blocks = [0]
    low: str | None = None

    def flush() -> None:
        if not text:
            return
        joined = " ".join(html.unescape("".join(text)).split())
        text.clear()
        top = stack[blocks[-1]]
        if joined:
            page.texts.setdefault(top.key, []).append(joined)
            page.blocks.append((top.key, top.word, top.main, joined))

    def close(at: int) -> None:
        if blocks[-1] >= at:
            flush()
        for element in stack[at:]:
            places[element.tag].pop()
        del stack[at:]
        while blocks[-1] >= at:
            blocks.pop()

    def nearest(tags: Iterable[str]) -> int:
        return max((places[t][-1] for t in tags if places[t]), default=0)

    def end_open(tags: set[str], up_to: frozenset[str] | set[str]) -> None:
        found = nearest(tags)
        if found and found >= nearest(up_to):
            close(found)

    # No tag ends behind the last ">", so none is looked for there.
    last = source.rfind(">") + 1
    at = 0
    while True:
        token = TOKEN.search(source, at, last)
        if token is None:
            break
        if token.start() > at and not (stack[-1].noise or stack[-1].loose):
            text.append(source[at : token.start()])
        at = token.end()
        if token.group(2) is None:
            told = token.group()
            if at == last and told.startswith(("<!--", "<![CDATA[")) and not CLOSED.search(told):
                told, at = source[token.start() :], len(source)
            if told.startswith("<![CDATA[") and not (stack[-1].noise or stack[-1].loose):
                text.append(html.escape(told[9:].removesuffix("]]>")))
            continue
        tag = token.group(2).lower()
        if token.group(1):
            found = nearest((tag,))
            if found:
                close(found)
            continue
        if tag in VOID:
            if tag == "br":
                text.append(" ")
            elif tag == "hr":
                flush()
            continue
        if tag in BLOCK:
            end_open({"p"}, HOLDERS)
            if tag in ITEMS:
                end_open(*ITEMS[tag])
            if tag in HEADINGS:
                end_open(set(HEADINGS), HOLDERS)
            flush()
        above = stack[-1]
        name, noise, word, main = _presentation(tag, token.group(3).strip())
        if tag == "header":
            # The page's header goes; an article's may hold its headings.
            noise = noise or not above.main
        kept = above.head and tag in HEADINGS
        key = _node(above.key, name)
        page.styles.setdefault(above.key, []).append(name)
        page.styles.setdefault(key, [])
        page.parents[key] = above.key
        if tag in RAW:
            low = source.lower() if low is None else low
            end = low.find(f"</{tag}", at)
            if len(low) != len(source):
                end = re.compile(f"</{tag}", re.I).search(source, at)
                end = end.start() if end else -1
            stop = source.find(">", end) if end >= 0 else -1
            at = stop + 1 if stop >= 0 else len(source)
            continue
        head = tag == "header" and above.main > PLAIN and not noise
        word = word or above.word
        if main and above.main < DOUBTED:
            # A class word of a wrapper, such as "has-sidebar", says nothing of an article below it.
            main = DOUBTED if main == ARTICLE and word else main
            word = False
        places[tag].append(len(stack))
        if tag in BLOCK:
            blocks.append(len(stack))
        stack.append(
            _Open(
                tag,
                key,
                above.noise or noise or (above.head and not kept and tag in BLOCK),
                word,
                # Inline elements under a class word are no block of their own.
                tag not in BLOCK and (above.loose or word and not above.word),
                max(main, above.main) if above.main < DOUBTED else DOUBTED if main == DOUBTED else above.main,
                head or (above.head and not kept),
            )
        )
    if not (stack[-1].noise or stack[-1].loose):
        rest = REST.search(source, at)
        text.append(source[at : rest.start()] if rest else source[at:])
        if rest and rest.group(1):
            text.append(html.escape(source[rest.end() :]))
    flush()
    return page


def _contents(page: Page) -> tuple[dict[int, int], dict[int, int]]:
    """Values of the texts of each node, and of all that the branch below it holds.

    A branch has a value where it holds text in more than its own node.
    """
    own = {key: _value([str(key), *texts]) for key, texts in page.texts.items()}
    below: dict[int, list[str]] = {}
    branches: dict[int, int] = {}
    # Parents were met before their children.
    for key in reversed(page.styles):
        parts = below.pop(key, [])
        if parts:
            branches[key] = value = _value([f"{key}/", *page.texts.get(key, []), *sorted(parts)])
        elif key in own:
            value = own[key]
        else:
            continue
        if key in page.parents:
            below.setdefault(page.parents[key], []).append(str(value))
    return own, branches


def main_text(page: Page, low: frozenset[int]) -> str:
    """The page's blocks without those that the site's style tree makes noise (contents `low`).

    Tags and class words are a prior on what the tree leaves: where a page has an article or
    main element its blocks come first, other text joins them if there is more of it, and
    text that a class word calls noise joins where nothing is stated and it is the larger part.
    Where nothing outweighs the stated content, but all of it is low, it stays.
    """
    noise: set[int] = set()
    if low:
        own, branches = _contents(page)
        gone = set()
        for key in page.styles:
            if page.parents.get(key) in gone or branches.get(key) in low:
                gone.add(key)
        noise = gone | {key for key, value in own.items() if value in low}
    sure = any(main == ARTICLE and not word for _, word, main, _ in page.blocks)
    sizes, whole = [0, 0, 0], 0
    ranks = []
    for key, word, main, text in page.blocks:
        # 0 stated, 1 other text, 2 noise by a class word
        rank = 2 if word else 0 if main and not (sure and main == DOUBTED) else 1
        ranks.append(rank)
        if rank == 0:
            whole += len(text)
        if key not in noise:
            sizes[rank] += len(text)
    stated, other, named = sizes
    if whole and not stated and other <= whole:
        return "\n".join(t for rank, (*_, t) in zip(ranks, page.blocks) if rank == 0)
    taken = {0}
    if other > stated:
        taken.add(1)
    if not whole and named > other:
        taken.add(2)
    return "\n".join(
        t for rank, (key, _, _, t) in zip(ranks, page.blocks) if rank in taken and key not in noise
    )


_TREE_SHAPE = "host string, page long, node long, style long, content long"


def _tree_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for host, source in zip(*(batch.column(c).to_pylist() for c in ("host", "html"))):
            page, of_page = parse(source), _value([source])
            own, branches = _contents(page)
            for key, content in own.items():
                rows.append((host, of_page, key, _value(page.styles.get(key, [])), content))
            for key, content in branches.items():
                rows.append((host, of_page, _node(key, "/"), _value(page.styles[key]), content))
        columns = list(zip(*rows)) or [()] * 5
        kinds = [pa.string(), *[pa.int64()] * 4]
        yield pa.record_batch(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["host", "page", "node", "style", "content"],
        )


def low_contents(pages: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """The site style tree's noise: contents (host, value) of nodes and branches of low importance.

    All pages of a host are merged: elements of the same tag and class below the same node are one
    node. For each node with text two entropies are taken over the host's pages that have
    it, of its child sequences (presentation) and of its texts (content), as shares of the
    logarithm of the number of those pages. What a site repeats has low ones. Equal pages count once.
    A branch, all that an element holds, has an importance of its own. Of what is low, the contents
    that pages share are noise; a page with its own text there keeps it.
    """
    rows = pages.select("host", "html").mapInArrow(_tree_rows, _TREE_SHAPE).distinct()
    long_ = rows.select(
        "host",
        "node",
        F.explode(
            F.array(
                F.struct(F.lit(0).alias("kind"), F.col("style").alias("value")),
                F.struct(F.lit(1).alias("kind"), F.col("content").alias("value")),
            )
        ).alias("x"),
    )
    counts = long_.groupBy("host", "node", "x.kind", "x.value").agg(F.count("*").alias("n"))
    counts = stage(counts, "style-tree")
    n, m = F.col("n"), F.sum("n")
    importance = counts.groupBy("host", "node", "kind").agg(
        m.alias("pages"),
        F.sum(n * F.log(n)).alias("spread"),
    )
    whole_log = F.col("pages") * F.log("pages")
    entropy = F.when(F.col("pages") > 1, (whole_log - F.col("spread")) / whole_log).otherwise(1.0)
    whole = importance.groupBy("host", "node").agg(
        F.max("pages").alias("pages"), F.max(entropy).alias("importance")
    )
    low = (F.col("pages") >= settings.pages) & (F.col("importance") < settings.least)
    shared = counts.where((F.col("kind") == 1) & (F.col("n") >= settings.pages))
    found = shared.join(whole.where(low), ["host", "node"])
    return found.where(F.col("n") >= settings.common * F.col("pages")).select("host", "value")


def extract_text(pages: DataFrame, settings: TreeSettings = TreeSettings()) -> DataFrame:
    """For every page (page_id, url, html) its main text: page_id, url, text, n_chars.

    Character references are decoded, white space in a block is one space, blocks are joined by
    line feeds in page order. Null and empty pages give the empty text. Pages with a null url, or one
    without host, make up one site. Repeated rows each get a row; empty tables give no
    rows; other columns are not read.
    """
    bounded_batches(pages.sparkSession)
    kind = pages.schema["page_id"].dataType.simpleString()
    narrow = pages.select(
        "page_id",
        "url",
        split_url(F.col("url"))[0].alias("host"),
        F.coalesce("html", F.lit("")).alias("html"),
    )
    low = low_contents(narrow, settings).groupBy("host").agg(F.collect_set("value").alias("low"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                main_text(parse(source), frozenset(values or ()))
                for source, values in zip(*(batch.column(c).to_pylist() for c in ("html", "low")))
            ]
            columns = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())]
            columns.append(pa.array([len(t) for t in texts], pa.int64()))
            yield pa.record_batch(columns, names=["page_id", "url", "text", "n_chars"])

    return (
        narrow.join(low, "host", "left")
        .select("page_id", "url", "html", "low")
        .mapInArrow(run, f"page_id {kind}, url string, text string, n_chars long")
    )
