"""HTML extraction (operator 10) by site template removal.

Every page is parsed into elements and text pieces. Each element subtree has two hashes: one over its tags and
text, one over its place (tags, classes and roles from the page down to it, its slot). Spark counts, per host, on how
many different pages a slot holds a text (pages with equal text count once, so copies of a page are no template).

- A subtree is deleted if its text recurs in its slot on ``needed`` different pages: an absolute number that grows with
  the logarithm of the host's pages (3 to begin with, 12 on a million pages).
- All subtrees of a slot are deleted, also those of a text of their own, if the slot occurs at most once on each page and
  more than half of its pages (``needed`` pages without one added) show a text that another page has there too: a
  place where menus, notices or adverts take turns.

Text blocks of the article itself (paragraphs, headings, list items, cells, inline marks) are never deleted this
way: a passage that many articles quote stays. One rule holds for hosts of all sizes. What counts can't show (a host
of few pages, a comment that occurs once) is told by the markup, on every host alike: element kinds that are never main
text (navigation, footers, asides, scripts, styles, forms and headers but for those that hold the article or its title),
elements whose class or role is the name of an advert, notice, sidebar, menu or reader comment as a whole (see named),
and the bounds of the article: if a page has articles that hold at least half of the text of its main element, only
their text is kept, else that of the main element, if there is one.

The table of deleted hashes and slots is broadcast if its counted size is within a bound. Otherwise the subtrees of each
different html are joined to it, hot ones split off (``common.attach``), and pages are joined to what goes from
their own html: a list no longer than the page, however many templates its host has.

Defined cases: null or empty html gives empty text; null urls and urls without
a host have no site and only the markup decides; unclosed and cut-off markup
ends with the page; an unknown character reference stays as it is; repeated
pages are extracted each by itself; columns of the result replace columns of
the same name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from . import common

#: Hashes of all hosts together that may be broadcast (8 bytes each).
BROADCAST_HASHES = 1_000_000

# Element kinds of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary "
                  "table tbody td tfoot th thead title tr ul".split())
#: A start tag of the key ends an open element of the value, up to the nearest of the second value.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
        "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
        "option": ({"option"}, {"select"})}
SCOPE = frozenset("article aside body button div footer form header html main nav section table td th li ul ol blockquote".split())
NOT_TEXT = frozenset("head script style noscript template iframe svg canvas object nav header footer aside form button select "
                     "textarea dialog menu search input noembed noframes title".split())
NAMED = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner sidebar cookie "
                  "cookies consent gdpr notice notices newsletter subscribe subscription signup popup modal overlay menu nav navbar "
                  "navigation breadcrumb breadcrumbs footer header masthead comment comments disqus replies respond share sharing "
                  "social related recommended widget toolbar pagination pager login search contentinfo complementary form alert".split())
#: Words that may stand beside those of NAMED in a class, and classes of the text itself, which no other class makes a box.
BESIDE = frozenset("reader user site page top bottom left right box bar container wrapper list".split())
OWN_TEXT = frozenset("post entry article story content".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 hgroup".split())
FRAME = frozenset(("html", "body", "article", "main"))
UNSEEN = frozenset("head script style noscript template iframe svg canvas object noembed noframes title textarea select button".split())
#: Banned kinds that stand for the page or the article if they hold its text.
WRAPS = frozenset(("form", "header"))
CONTAINER = frozenset("div section aside ul ol dl table nav form header footer figure details fieldset".split())

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)(?:>|\Z)"""
                 r"""|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
NAMES = re.compile(r"""(?<![\w-])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
WORD = re.compile(r"[a-z0-9]+")
MAIN_ROLE = re.compile(r"""\brole\s*=\s*["']?main\b""", re.I)


@dataclass
class Page:
    """Elements in page order and text pieces ``(block, text, element)``; element 0 is the page."""

    tags: list[str] = field(default_factory=lambda: [""])
    parents: list[int] = field(default_factory=lambda: [0])
    banned: list[bool] = field(default_factory=lambda: [False])
    named: list[bool] = field(default_factory=lambda: [False])
    mains: list[bool] = field(default_factory=lambda: [False])
    hashes: list[int] = field(default_factory=lambda: [0])
    slots: list[int] = field(default_factory=lambda: [0])
    pieces: list[tuple[int, str, int]] = field(default_factory=list)


def named(tag: str, attrs: str) -> bool:
    """Whether a whole class or role names a box: a word of NAMED, or words of NAMED and BESIDE joined.

    Headings and classes of the text itself are no boxes. An id is mostly an
    anchor; it counts on a div only, and if joined of two words of NAMED or more.
    """
    if tag in FRAME or tag in HEADINGS:
        return False
    found = False
    for kind, value in NAMES.findall(attrs):
        kind, tokens = kind.lower(), value.strip("\"'").lower().split()
        if kind == "class" and not OWN_TEXT.isdisjoint(tokens):
            return False
        for token in tokens:
            words = set(WORD.findall(token))
            if kind == "id":
                found |= tag == "div" and len(words) > 1 and words <= NAMED
            else:
                found |= token in NAMED or not words.isdisjoint(NAMED) and words <= NAMED | BESIDE
    return found


def place(parent: int, tag: str, attrs: str) -> int:
    """Hash of an element's slot: its tag, classes and role below the slot of its parent."""
    names = " ".join(sorted(f"{k.lower()}={v.strip(chr(34) + chr(39)).lower()}" for k, v in NAMES.findall(attrs) if k.lower() != "id")) if "=" in attrs else ""
    return placed(parent, tag, names)


@lru_cache(maxsize=1 << 14)
def placed(parent: int, tag: str, names: str) -> int:
    from xxhash import xxh3_64_intdigest

    return xxh3_64_intdigest(f"{parent}>{tag} {names}".encode("utf-8", "surrogatepass")) - 2 ** 63


def parse(source: str) -> Page:
    from xxhash import xxh3_64_intdigest

    page, stack, parts, block, at = Page(), [0], [[]], 0, 0

    def text(raw: str) -> None:
        if raw:
            page.pieces.append((block, entities.unescape(raw) if "&" in raw else raw, stack[-1]))
            parts[-1].append(" ".join(raw.split()))

    def close(depth: int) -> None:
        while len(stack) > depth:
            own, inside = stack.pop(), parts.pop()
            held = "\x01".join(x for x in inside if x)
            digest = xxh3_64_intdigest(f"{page.tags[own]}\x00{held}".encode("utf-8", "surrogatepass")) if held else 0
            page.hashes[own] = digest - 2 ** 63
            if held:
                parts[-1].append(f"\x02{digest:x}")

    def open_at(names, until) -> int | None:
        for d in range(len(stack) - 1, 0, -1):
            tag = page.tags[stack[d]]
            if tag in names:
                return d
            if tag in until:
                return None
        return None

    end = len(source)
    while at < end:
        m = TAG.search(source, at)
        text(source[at:m.start() if m else end])
        if not m:
            break
        at = m.end()
        slash, name, attrs = (m.group(1), m.group(2), m.group(3)) if m.group(2) else (m.group(4), m.group(5), m.group(6))
        if not name:
            continue
        name = name.lower()
        if name in BLOCK:
            block += 1
        if slash:
            if (d := open_at({name}, ())) is not None:
                close(d)
            continue
        if name == "br":
            text(" ")
        if name in VOID:
            continue
        if name in BLOCK and (d := open_at({"p"}, SCOPE)) is not None:
            close(d)
        if name in ENDS and (d := open_at(*ENDS[name])) is not None:
            close(d)
        stack.append(len(page.tags))
        parts.append([])
        page.parents.append(stack[-2])
        page.tags.append(name)
        page.hashes.append(0)
        page.slots.append(place(page.slots[stack[-2]], name, attrs))
        page.banned.append(name in NOT_TEXT)
        page.named.append("=" in attrs and named(name, attrs))
        page.mains.append(name in ("article", "main") or "main" in attrs and bool(MAIN_ROLE.search(attrs)))
        if attrs.rstrip().endswith("/") and name in ("svg", "iframe", "script"):
            close(len(stack) - 1)
        elif name in RAW:
            stop = re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I).search(source, at)
            at = stop.start() if stop else end
    close(1)
    return page


def areas(page: Page) -> tuple[list[bool], list[bool]]:
    """Per element: dropped by the markup; inside the article (or main) that holds the text."""
    n = len(page.tags)
    dropped, within, chars, holds = [False] * n, [""] * n, [0] * n, [""] * n
    for i in range(n - 1, 0, -1):  # what an element holds: a main part, else a title
        own = "main" if page.mains[i] else "title" if page.tags[i] == "h1" else holds[i]
        holds[page.parents[i]] = max(holds[page.parents[i]], own, key=("", "title", "main").index)
    for i in range(1, n):
        tag, up = page.tags[i], page.parents[i]
        wraps = tag in WRAPS and (holds[i] == "main" or holds[i] == "title" and (tag == "form" or bool(within[up])))
        dropped[i] = page.banned[i] and not wraps or page.named[i] or dropped[up]
        within[i] = within[up] or ("" if dropped[i] or not page.mains[i] else tag if tag == "article" else "main")
    for _, text, element in page.pieces:
        chars[element] += 0 if dropped[element] else len(text)
    for i in range(n - 1, 0, -1):
        chars[page.parents[i]] += chars[i]
    live = [i for i in range(1, n) if page.mains[i] and not dropped[i]]
    outer = [i for i in live if not within[page.parents[i]]]
    articles = {i for i in live if page.tags[i] == "article"}
    in_article = [False] * n
    for i in range(1, n):
        in_article[i] = in_article[page.parents[i]] or i in articles
    held = sum(chars[i] for i in articles if not in_article[page.parents[i]])
    roots = articles if 2 * held >= sum(chars[i] for i in outer) and articles else set(live) - articles
    inside = [False] * n
    for i in range(1, n):
        inside[i] = i in roots or inside[page.parents[i]]
    return dropped, inside if roots else [True] * n


def may_recur(page: Page, inside: list[bool]) -> list[bool]:
    """Per element, whether its subtree may be a template: all but the frame and the article's own text blocks."""
    has_main = any(page.mains)
    return [tag not in FRAME and (not (own and has_main) or tag in CONTAINER) for tag, own in zip(page.tags, inside, strict=True)]


def subtrees(page: Page) -> dict[tuple[int, int], int]:
    """``(slot, hash)`` of the subtrees that may be a template, and how often the page has the slot."""
    free = may_recur(page, areas(page)[1])
    found = [i for i in range(1, len(page.tags)) if free[i] and page.hashes[i] and page.tags[i] not in ("head", "title")]
    times = Counter(page.slots[i] for i in found)
    return {(page.slots[i], page.hashes[i]): times[page.slots[i]] for i in found}


def main_text(page: Page, recurring: set[tuple[int, int]], slots: set[int] = frozenset(), markup: bool = True) -> str:
    """Text blocks of the main text joined by newlines, without recurring subtrees and those of template slots, then
    (``markup``) without what the markup shows. Scripts, styles and the like are never text."""
    dropped, inside = areas(page)
    free = may_recur(page, inside)
    if not markup:
        dropped, inside = [t in UNSEEN for t in page.tags], [True] * len(page.tags)
    for i in range(1, len(page.tags)):
        dropped[i] = dropped[i] or dropped[page.parents[i]] or free[i] and (page.slots[i] in slots or (page.slots[i], page.hashes[i]) in recurring)
    blocks: dict[int, list[str]] = {}
    for block, text, element in page.pieces:
        if not dropped[element] and inside[element]:
            blocks.setdefault(block, []).append(text)
    lines = (" ".join("".join(pieces).split()) for pieces in blocks.values())
    return "\n".join(x for x in lines if x)


def host_of(url: Column) -> Column:
    """Lower-case host of a url; null without one."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.when(host != "", host)


def page_rows(pages: DataFrame) -> DataFrame:
    """``(host, own, page, slots, hashes, times, w)``: subtrees of each different html of a host; ``own`` is the html's digest,
    ``page`` that of its text. ``pages`` holds ``host``, ``own`` and ``html``."""
    from xxhash import xxh3_64_intdigest

    def found(batches):
        for batch in batches:
            cols = [], [], [], [], [], []
            for part in common.slices(batch, "html"):
                for host, own, source in zip(*(part.column(c).to_pylist() for c in ("host", "own", "html")), strict=True):
                    page = parse(source or "")
                    text = "".join(t for _, t, _ in page.pieces)
                    trees = subtrees(page)
                    row = host, own, xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - 2 ** 63, [k[0] for k in trees], [k[1] for k in trees], list(trees.values())
                    for col, value in zip(cols, row, strict=True):
                        col.append(value)
            kinds = pa.string(), pa.string(), pa.int64(), *[pa.list_(pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["host", "own", "page", "slots", "hashes", "times"])

    rows = common.in_batches(pages.where("host IS NOT NULL").select("host", "own", "html"), found,
                             "host string, own string, page long, slots array<long>, hashes array<long>, times array<long>")
    one = rows.groupBy("host", "own").agg(F.first(F.struct("page", "slots", "hashes", "times")).alias("x"), F.count("*").alias("w"))
    return common.cut(one.select("host", "own", "x.*", "w"))


def templates(rows: DataFrame, min_pages: int) -> tuple[DataFrame, DataFrame]:
    """Of ``page_rows``: the slots of which every text goes ``(host, slot, pages, w)``, and the texts that go from other slots
    ``(host, slot, hash, seen, w)``."""
    one = rows.groupBy("host", "page").agg(F.first(F.struct("slots", "hashes", "times")).alias("x"), F.sum("w").alias("w"))
    one = common.cut(one.select("host", "x.*", "w"))
    hosts = common.cut(one.groupBy("host").agg(F.count("*").alias("n"), F.sum("w").alias("w")))
    each = one.select("host", F.explode(F.arrays_zip("slots", "hashes", "times")).alias("x")).select("host", "x.*")
    counts = each.groupBy("host", F.col("slots").alias("slot"), F.col("hashes").alias("hash")).agg(
        F.count("*").alias("seen"), F.max("times").alias("times"))
    # texts of one page alone can't recur: they are summed by slot and go no further
    single = counts.groupBy("host", "slot").agg(F.sum("seen").alias("pages"), F.max("times").alias("times"),
                                                F.sum(F.when(F.col("seen") > 1, F.col("seen")).otherwise(0)).alias("same"))
    needed = F.greatest(F.lit(min_pages), F.ceil(0.6 * F.log2("n")))
    places = common.attach(common.cut(single), hosts.withColumn("k", F.col("n")), "host", "k")
    full = common.cut(places.where("times = 1").where(2 * F.col("same") > F.col("pages") + needed).select("host", "slot", "pages", "w"))
    again = common.attach(common.cut(counts.where(F.col("seen") >= min_pages)), hosts.withColumn("k", F.col("n")), "host", "k").where(F.col("seen") >= needed)
    return full, common.cut(again.select("host", "slot", "hash", "seen", "w").join(full.select("host", "slot"), ["host", "slot"], "left_anti"))


def lists(of: DataFrame, keys: list[str]) -> DataFrame:
    """``(*keys, slots, hashes, full, w)`` of rows ``(*keys, slot, hash, w)``; a null hash is a slot that goes whole."""
    one = F.col("hash").isNotNull()
    found = of.groupBy(*keys).agg(F.collect_list(F.when(one, F.struct("slot", "hash"))).alias("x"),
                                  F.collect_list(F.when(~one, F.col("slot"))).alias("full"), F.first("w").alias("w"))
    return common.cut(found.select(*keys, F.col("x.slot").alias("slots"), F.col("x.hash").alias("hashes"), "full", "w"))


def own_templates(rows: DataFrame, full: DataFrame, again: DataFrame) -> DataFrame:
    """What goes from each different html alone: its subtrees joined to the templates, hot ones split off."""
    each = rows.select("host", "own", "w", F.explode(F.arrays_zip("slots", "hashes")).alias("x")).select(
        "host", "own", "w", F.col("x.slots").alias("slot"), F.col("x.hashes").alias("hash"))
    text, slot = F.struct("host", "slot", "hash").alias("k"), F.struct("host", "slot").alias("k")
    texts = common.attach(each.select("*", text), again.select(text, "seen"), "k", "seen")
    slots = common.attach(each.select("*", slot), full.select(slot, "pages"), "k", "pages").withColumn("hash", F.lit(None).cast("long"))
    names = ["host", "own", "slot", "hash", "w"]
    return lists(texts.select(*names).unionByName(slots.select(*names).distinct()), ["host", "own"])


def extract(pages: DataFrame, url: str = "url", html: str = "html", min_pages: int = 3, keep: list[str] | None = None,
            markup: bool = True) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` (code points) of the main text; without ``markup`` the counts alone decide."""
    host, own = host_of(common.quoted(url)), F.md5(F.coalesce(common.quoted(html).cast("string"), F.lit("")))
    found = page_rows(pages.select(host.alias("host"), own.alias("own"), common.quoted(html).alias("html")))
    full, again = templates(found, min_pages)
    whole = full.count() + 2 * again.count() <= BROADCAST_HASHES
    keys = ["host"] if whole else ["host", "own"]
    gone = lists(full.select("host", "slot", F.lit(None).cast("long").alias("hash"), "w").unionByName(again.select("host", "slot", "hash", "w")), keys) \
        if whole else own_templates(found, full, again)
    names = ["__slots", "__hashes", "__full"]
    gone = gone.select(F.struct(*keys).alias("__key"), *(F.col(c.strip("_")).alias(c) for c in names), F.col("w").alias("__w"))
    used = pages.columns if keep is None else keep
    key = F.struct(F.coalesce(host, F.lit("")).alias("host"), *([] if whole else [own.alias("own")]))
    rows = pages.select(*map(common.quoted, dict.fromkeys([*used, html])), key.alias("__key"))
    rows = common.attach(rows, gone, "__key", "__w", "left", common.BROADCAST_ROWS if whole else 0)
    rows = rows.withColumn("__key", F.col("__key.host"))

    def run(batch: pa.RecordBatch) -> dict:
        texts, known = [], {}
        for source, site, *lost in zip(*(batch.column(c) for c in (html, "__key", *names)), strict=True):
            if not whole or (site := site.as_py()) not in known:
                slots, hashes, every = (x.as_py() or [] for x in lost)
                known[site if whole else None] = set(zip(slots, hashes, strict=True)), set(every)
            texts.append(main_text(parse(source.as_py() or ""), *known[site if whole else None], markup))
        return {"text": texts, "n_chars": [len(t) for t in texts]}

    return common.map_batches(rows, run, [StructField("text", StringType()), StructField("n_chars", LongType())], [html, "__key", *names], used)
