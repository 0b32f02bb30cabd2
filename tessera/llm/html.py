"""Main text of web pages: page structure and a host suffix array.

A page becomes a stream of tokens, one per text block outside removed elements
(headings, paragraphs, list items, ...). Three kinds of blocks:

* inside ``<article>`` / ``<main>`` (role or element): the article, kept;
* inside menus, headers, footers, sidebars, notices, adverts, forms, scripts,
  styles and reader comments (by element, role, or class / id word): removed;
* any other block is *open*: pages need not mark their article.

The host's suffix array decides open blocks: the streams of all the host's
pages are concatenated, and their suffixes put in order up to a depth of
``min_words`` words (deeper order cannot change whether a repeat of that length
starts there). Equal neighbours of distinct pages are substrings repeated
across pages; the blocks they cover are boilerplate, and the unique blocks stay.
Beside an article a block of fewer words is boilerplate if it stands, as a
whole, outside removed elements on several pages, and text right inside a
container (no heading, paragraph, item or cell) stays in unique runs of
``min_words`` words or more. Blocks inside articles stay,
repeated or not: pages of one host may mirror an article, and its lines may
also stand in removed elements.

Only identifiers are shuffled, keyed by host *and* suffix, with partial
aggregation (two page fingerprints per bucket), so a host with a third of all
pages spreads over all tasks and no host is gathered anywhere. Copies of a page
(equal html) count as one page: a mirrored article is no boilerplate.

Defined results: null or empty html gives an empty text; white space inside a
block becomes one space; ``<br>`` is white space; character references are
decoded after the markup is read; blocks are joined by a blank line; repeated
rows give a row each; a null or odd url is a host of its own. Nothing is cut:
whole pages of any length are read. Elements inside a removed one are removed,
also when their own end tag is missing; a removed or article element that is
never closed reaches to the end of its parent's or its own next closing tag.
A class or id word removes an element as a whole token, alone or with words of
place ("sidebar-left", not "has-sidebar"); words of ``_STRONG_WORD`` also beside
other parts ("ad-300x250", "user-comments"), unless the element is a heading or
holds most of the page's text. Neither removes an article or what holds one;
only lists of reader comments go with the articles in them.
"""

from __future__ import annotations

import html as htmllib
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialise

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>"
    r"|<(?P<raw>script|style|noscript|template|textarea|select|iframe|svg|math|object|title)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
#: elements that end a block
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody "
    "td tfoot th thead tr ul".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_DROP = frozenset("nav header footer aside form menu button dialog input label legend option head".split())
_ARTICLE = frozenset(("article", "main"))
_DROP_ROLE = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog toolbar".split())
#: words of class and id values that name what is no article
_DROP_WORD = frozenset(
    "ad ads advert adverts advertisement adsense sponsor sponsored promo banner nav navbar navigation menu submenu "
    "breadcrumb breadcrumbs header masthead footer sidebar aside widget widgets cookie cookies consent notice notices "
    "popup modal overlay newsletter subscribe subscription signup login comment comments respond disqus reply replies "
    "share sharing social related recommended pagination pager toolbar copyright skip hidden".split())
#: words that only place or hold what a listed word names: "sidebar-left", "ad-slot", "cookie-banner-inner"
_PLACE_WORD = frozenset(
    "left right top bottom upper lower primary secondary tertiary site global page main box wrap wrapper container outer inner "
    "area list item items link links block bar slot unit zone section panel form button buttons icons posts articles text "
    "title heading row column col group body".split())
#: words that name what is no article also beside any other part of a token, and those that do so as its last part
_STRONG_WORD = frozenset(
    "ad ads adsbygoogle advert adverts advertisement adsense sponsored cookie cookies comments disqus paywall related "
    "social newsletter signup subscribe subscription".split())
_LAST_WORD = frozenset(("footer",))
#: first parts that say what an element has, not what it is
_STATE_WORD = frozenset("has have with no not is without".split())
_HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: words of reader comments, whose elements may hold an ``<article>`` per comment
_COMMENT_WORD = frozenset("comment comments respond disqus reply replies".split())
_ATTR = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAMED = re.compile(r"class|id|role|hidden", re.I)
_SPLIT = re.compile(r"[^a-z0-9]+")
ARTICLE, OPEN, REMOVED, BARE = 1, 0, 2, 3
#: elements whose text is a block of prose; text right inside any other element is bare
_PROSE = frozenset("h1 h2 h3 h4 h5 h6 p li dt dd td th blockquote pre figcaption caption summary".split())


def _attributes(attrs: str) -> dict[str, str]:
    """Names and values of a start tag; of a repeated name the first counts."""
    out: dict[str, str] = {}
    if _NAMED.search(attrs):
        for m in _ATTR.finditer(attrs):
            out.setdefault(m.group(1).lower(), m.group(2) or m.group(3) or m.group(4) or "")
    return out


def _names(token: str) -> set[str]:
    """Listed words a whole class or id token consists of, besides words of place; none if it has any other part."""
    parts = set(_SPLIT.split(token)) - {""}
    named = parts & _DROP_WORD
    if not parts <= _DROP_WORD | _PLACE_WORD or (named == {"hidden"} and parts != named):
        return set()
    # the header of a page, section or item, or a header's title, is content, unlike the site's
    if named == {"header"} and parts & {"page", "section", "title", "heading", "text", "item", "body", "block"}:
        return set()
    return named


def _words(attrs: dict[str, str]) -> set[str]:
    return {w for t in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split() for w in _names(t)}


def _strong(attrs: dict[str, str]) -> bool:
    """Whether a class or id token has a strong word among its parts."""
    for t in f"{attrs.get('class', '')} {attrs.get('id', '')}".lower().split():
        parts = [x for x in _SPLIT.split(t) if x]
        if parts and parts[0] not in _STATE_WORD and (_STRONG_WORD.intersection(parts) or parts[-1] in _LAST_WORD):
            return True
    return False


def _dropped(name: str, attrs: dict[str, str]) -> bool:
    """Whether the element, its role or the hidden attribute removes it, whatever it holds."""
    if name in _DROP:
        return True
    if not attrs or name in ("body", "html"):
        return False
    return (attrs.get("role", "").strip().lower() in _DROP_ROLE or "hidden" in attrs
            or attrs.get("aria-hidden", "").strip().lower() == "true")


def blocks(page: str) -> list[tuple[str, int]]:
    """Text blocks of a page outside removed elements, in order, each ARTICLE, OPEN or BARE."""
    return [b for b in all_blocks(page) if b[1] != REMOVED]


def all_blocks(page: str) -> list[tuple[str, int]]:
    """Text blocks of a page in order, each ARTICLE, REMOVED, OPEN (a heading, paragraph, item or cell) or BARE.

    An element that only a class or id word names is judged at the end of the
    page: it stays if it holds an article.
    """
    out: list[tuple[str, int, tuple]] = []
    part: list[str] = []
    stack: list[tuple[str, int, int]] = []      # (element, 0 plain | 1 article | 2 removed | 3 named, serial of a named one)
    removed = article = 0
    named: list[tuple[int, bool]] = []          # (serial, named by comment words only) of the open named elements
    strong: set[int] = set()                    # named elements that only a strong word beside others names
    holds: set[int] = set()                     # named elements that hold an article
    serial = 0

    def flush():
        if part:
            text = " ".join(htmllib.unescape("".join(part)).split())
            if text:
                holder = next((n for n, _, _ in reversed(stack) if n in _BLOCK or n in _PROSE), "")
                free = OPEN if holder in _PROSE else BARE
                out.append((text, REMOVED if removed else ARTICLE if article else free, tuple(n for n, _ in named)))
            part.clear()

    at = 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            part.append(page[at:m.start()])
        at = m.end()
        name = m.group("name")
        if name is None:
            continue
        name = name.lower()
        if name == "br":
            part.append(" ")
            continue
        block = name in _BLOCK
        if m.group("end"):
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if block or any(kind for _, kind, _ in stack[i:]):
                        flush()
                    for _, kind, _ in stack[i:]:
                        removed -= kind == 2
                        article -= kind == 1
                        if kind == 3:
                            named.pop()
                    del stack[i:]
                    break
                if stack[i][0] in ("article", "main", "body", "table") and name not in ("body", "html", "article", "main"):
                    break                       # a stray end tag does not close what holds it
            else:
                if block:
                    flush()
            continue
        if block:
            flush()
            if name in ("p", "li", "dt", "dd", "tr", "td", "th") or (stack and stack[-1][0] == "p"):
                # a new paragraph, item or cell ends the one before it
                like = ("p",) if name not in ("li", "dt", "dd", "tr", "td", "th") else (name, "p")
                k = len(stack)
                while k and (stack[k - 1][0] in like or stack[k - 1][0] not in _BLOCK) and stack[k - 1][1] == 0:
                    k -= 1
                if any(n in like for n, _, _ in stack[k:]):
                    del stack[k:]
        if name in _VOID or m.group("attrs").endswith("/"):
            continue
        attrs = _attributes(m.group("attrs"))
        words = _words(attrs) if attrs and name not in ("body", "html") else set()
        if _dropped(name, attrs):
            kind = 2
        elif name in _ARTICLE or (block and attrs.get("role", "").strip().lower() in ("main", "article")):
            kind = 1
            if not removed:
                # comments are often an <article> each: these do not keep the list that holds them
                comment = name == "article" and words and words <= _COMMENT_WORD
                holds.update(n for n, of_comments in named if not (of_comments and (comment or any(e[0] == "article" for e in stack))))
        else:
            kind = 3 if words or (attrs and name not in _HEADING and name not in ("body", "html") and _strong(attrs)) else 0
        if kind:
            flush()
        serial += 1
        if kind == 3 and not words:
            strong.add(serial)
        if kind == 3:
            named.append((serial, words <= _COMMENT_WORD))
        stack.append((name, kind, serial))
        removed += kind == 2
        article += kind == 1
    if at < len(page):
        part.append(page[at:])
    flush()
    # an element that holds most of what no other element removes is the page's text, whatever it is called
    open_ = [(len(t), inside) for t, kind, inside in out if kind != REMOVED and holds.issuperset(n for n in inside if n not in strong)]
    total = sum(n for n, _ in open_)
    holds.update(i for i in strong if 2 * sum(n for n, inside in open_ if i in inside) > total)
    return [(t, kind if holds.issuperset(inside) else REMOVED) for t, kind, inside in out]


def _runs(texts: list[str], min_words: int) -> list[dict]:
    """Shortest token runs of ``min_words`` words or more that start, and that end, at each token.

    A suffix of the stream cut at that depth is all that decides whether a
    repeat of ``min_words`` words starts there; the prefixes seen from the end
    cover the last tokens of a longer repeat.
    """
    import xxhash
    ids = [xxhash.xxh64_intdigest(t) for t in texts]
    words = [t.count(" ") + 1 for t in texts]
    found = set()
    j, have = 0, 0
    for i in range(len(ids)):                       # shortest run from i on
        j, have = max(i, j), have if j > i else 0
        while have < min_words and j < len(ids):
            have += words[j]
            j += 1
        if have >= min_words:
            found.add((i, j))
        have -= words[i]
    i, have = 0, 0
    for j in range(len(ids)):                       # shortest run up to j
        have += words[j]
        while have - words[i] >= min_words and i < j:
            have -= words[i]
            i += 1
        if have >= min_words:
            found.add((i, j + 1))
    out = []
    for i, j in sorted(found):
        h = xxhash.xxh64_intdigest(b"".join(x.to_bytes(8, "little") for x in ids[i:j]), seed=j - i)
        out.append({"pos": i, "len": j - i, "id": h - (1 << 64) if h >> 63 else h})
    return out


_RUN = "array<struct<pos:int,len:int,id:long,open:boolean>>"


def _stream_batch(min_words: int):
    """Suffix runs of the pages' token streams; ``open``: a run with an open block."""
    import pyarrow as pa
    kind = pa.list_(pa.struct([("pos", pa.int32()), ("len", pa.int32()), ("id", pa.int64()), ("open", pa.bool_())]))

    def of_page(page):
        parsed = blocks(page)
        article = any(k == ARTICLE for _, k in parsed)
        out = [{**r, "open": any(k in (OPEN, BARE) for _, k in parsed[r["pos"]:r["pos"] + r["len"]])} for r in _runs([t for t, _ in parsed], min_words)]
        # short open blocks as wholes; they decide beside an article only
        return out + [{**r, "open": article} for i, (t, k) in enumerate(parsed) if k in (OPEN, BARE) and t.count(" ") + 1 < min_words
                      for r in [{**_runs([t], 1)[0], "pos": i}]]

    def run(batches):
        for batch in batches:
            runs = [of_page(p.as_py() or "") for p in batch.column("_html")]
            yield pa.RecordBatch.from_arrays([batch.column("_key"), batch.column("_host"), pa.array(runs, kind)],
                                             names=["_key", "_host", "runs"])
    return run


def decide(parsed: list[tuple[str, int]], spans: list[dict], min_words: int) -> tuple[list[str], int]:
    """Kept texts of a page's visible blocks, and the number of open blocks that the host's verdict removed.

    ``spans`` are the page's runs that stand on several pages of the host.
    Beside an article, bare text stays in unique runs of ``min_words`` words only.
    """
    repeated = {i for s in spans for i in range(s["pos"], s["pos"] + s["len"]) if parsed[i][1] != ARTICLE}
    article = any(k == ARTICLE for _, k in parsed)
    out, i = [], 0
    while i < len(parsed):
        if parsed[i][1] == ARTICLE:
            out.append(parsed[i][0])
            i += 1
            continue
        j = i
        while j < len(parsed) and parsed[j][1] != ARTICLE and j not in repeated:
            j += 1
        unique = parsed[i:j]
        whole = not article or sum(t.count(" ") + 1 for t, _ in unique) >= min_words
        out += [t for t, k in unique if whole or k == OPEN]
        i = max(j, i + 1)
    return out, len(repeated)


def _text_batch(min_words: int):
    import pyarrow as pa
    keep = ["_id", "_url"]

    def run(batches):
        for batch in batches:
            got = [decide(blocks(p.as_py() or ""), s.as_py() or [], min_words)
                   for p, s in zip(batch.column("_html"), batch.column("spans"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in keep] + [pa.array(["\n\n".join(t) for t, _ in got], pa.string()),
                                                   pa.array([n for _, n in got], pa.int32())], names=[*keep, "text", "removed"])
    return run


def _keyed(pages: DataFrame, page_id: str, url: str, html_col: str) -> DataFrame:
    page, link = F.col(f"`{html_col}`"), F.col(f"`{url}`")
    host = F.lower(F.regexp_extract(link, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    # a page is known by its content: copies are one page, and recomputed rows keep their key
    return pages.select(F.col(f"`{page_id}`").alias("_id"), link.alias("_url"), page.alias("_html"),
                        F.xxhash64(page, F.length(page)).alias("_key"), F.xxhash64(F.coalesce(host, F.lit(""))).alias("_host"))


def host_runs(pages: DataFrame, min_words: int) -> DataFrame:
    """(page ``_key``, ``_host``, ``pos``, ``len``, ``id``, ``open``): the host's suffixes, cut at ``min_words`` words."""
    s = pages.select("_key", "_host", "_html").mapInArrow(_stream_batch(min_words), f"_key long, _host long, runs {_RUN}")
    return s.select("_key", "_host", F.explode("runs").alias("r")).select("_key", "_host", "r.pos", "r.len", "r.id", "r.open")


def boilerplate(pages: DataFrame, min_words: int) -> DataFrame:
    """Per page with open blocks: ``spans``, its runs with such blocks that stand on several pages of the host.

    Equal truncated suffixes are neighbours in the host's suffix order; whether
    such a bucket spans distinct pages only needs its smallest and largest page
    key, aggregated partially.
    """
    suffixes = materialise(host_runs(pages, min_words))
    many = suffixes.groupBy("_host", "id").agg(F.min("_key").alias("lo"), F.max("_key").alias("hi")).where("lo != hi")
    mine = suffixes.where("open").join(many.select("_host", "id"), ["_host", "id"])
    return page_runs(mine).groupBy("_key", "_host").agg(F.collect_list(F.struct("pos", "len")).alias("spans"))


def page_runs(runs: DataFrame) -> DataFrame:
    """Each run of a page once: copies of a page emit the same runs, which must not gather in one task."""
    return runs.select("_key", "_host", "pos", "len").distinct()


def extract(pages: DataFrame, *, page_id: str = "page_id", url: str = "url", html_col: str = "html",
            min_words: int = 8) -> DataFrame:
    """One row per page row: ``page_id``, ``url``, main ``text``, ``removed`` (open blocks judged boilerplate)."""
    src = _keyed(pages, page_id, url, html_col)
    kind = dict(src.dtypes)["_id"]
    spans = materialise(boilerplate(src, min_words))
    out = src.join(spans, ["_key", "_host"], "left").select("_id", "_url", "_html", "spans") \
        .mapInArrow(_text_batch(min_words), f"_id {kind}, _url string, text string, removed int")
    return out.select(F.col("_id").alias(page_id), F.col("_url").alias(url), "text", "removed")
