"""Main text of web pages with a host suffix array (operator 9).

1. Each page is cut into text blocks. Scripts, styles, markup and comments fall away; character
   references are decoded; white space inside a block becomes one blank; elements whose end tag may be
   left out end where HTML ends them. A block knows whether it
   stands in page furniture (menus, headers, footers, sidebars, forms, elements whose class, id or role
   is the name of a notice, an advert or reader comments) and whether it stands in the main part or an article. A name that
   only holds such a word (``site-footer``) counts unless its element holds most of the page's words; ``main``,
   ``article`` and ``body`` are never furniture.
2. The token streams of a host's pages form one suffix array, sorted to a depth of ``REPEAT`` tokens: suffixes meet by the
   rolling hash of their first tokens, wherever in the cluster their pages lie. Those of equal rank on distinct pages are a
   repeated run; overlapping runs join into the longest repeats, and the tokens they cover are marked. Copies of a page
   count as one page, so that an article which stands twice isn't taken for furniture.
3. Furniture is dropped. Of the rest, the main part's blocks stay, or else the articles', or else all.
   Where they are fewer than ``MOST`` of the words, as beside a small card, the blocks outside them are looked at as well:
   such a block is dropped when repeats cover at least ``COVERED`` of it.
4. In the main part of every page a block goes when runs of the whole site cover at least ``COVERED`` of it: notices, adverts
   and links that no name gives away. Such a run stands in the main part of at least ``SITE`` of the host's pages, ``SITE_PAGES``
   distinct ones or more. What fewer articles share is part of each and stays, and so does a main part of which more than
   ``MOST`` would go: it is a copy with changes.

For step 2 only hosts with a page that the repeats have to decide are searched, all pages of them. A task reduces its pages'
suffixes to one row per host and rank, with the smallest and the largest page, before they are shuffled, so that neither a
large host nor a run that stands on all its pages gathers in one task.

For step 4 all pages of hosts with ``SITE_PAGES`` are searched. A run on ``SITE`` of a host's pages stands on ``SITE`` of the
pages in some group, however they are grouped: tasks propose what is so common among their pages, whatever can't reach
``SITE`` by what the groups without a proposal may hold falls away, and the rest is counted on every page. Hosts with few pages a task
are brought together before, so that a group is seldom a single page, all of whose runs would be proposed.

Null or empty pages have the empty text. Pages without host are a host of their own. Broken markup
is read as far as it goes. Rows with equal ``page_id`` are answered one by one.
"""

from __future__ import annotations

import html
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelake.llm.common import broadcast_within, stored

REPEAT = 8                  # tokens
COVERED = 0.6
MOST = 0.5
SITE = (4, 5)               # share of a host's pages
SITE_PAGES = 10
BATCH_TOKENS = 1_000_000    # tokens whose suffixes a task reduces at once
GROUP_TOKENS = 4_000_000    # the same where a group's common suffixes are sought
COUNTED_RUNS = 100_000      # runs whose pages a task counts at once
GROUP_PAGES = 4             # pages of a host a task, below which the host's pages are brought together
MAX_BROADCAST_HOSTS = 100_000
MAX_BROADCAST_RUNS = 1_000_000

# fixed values: elements of HTML by their part in a page
FURNITURE = {"nav", "header", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "noscript",
             "template", "svg", "iframe", "object", "textarea", "label", "fieldset", "datalist", "canvas"}
RAW = {"script", "style", "xmp", "noembed", "noframes"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "caption", "dd", "details", "div", "dl", "dt", "fieldset",
         "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main",
         "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "title", "tr",
         "ul"}
# words of a class, id or role that name page furniture
HINTS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
         "promotion", "banner", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "cookie",
         "cookies", "consent", "notice", "notices", "gdpr", "popup", "modal", "overlay", "newsletter", "subscribe", "signup",
         "login", "share", "sharing", "social", "related", "recommended", "recommendations", "comment", "comments",
         "disqus", "reply", "replies", "footer", "masthead", "toolbar", "widget", "pagination", "pager", "search",
         "contentinfo", "complementary", "alert", "disclaimer", "teaser"}
# names of the main part of a page
MAIN = {"content", "main", "main-content", "maincontent", "page-content", "post-content", "entry-content", "article-body", "story-body"}
# words that turn a name round: no-sidebar
NOT = {"no", "not", "non", "without", "hide", "has", "with"}
# fixed values: open elements that a start tag ends, and where the search for them stops
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"},
        "tbody": {"tbody", "thead", "tfoot"}, "thead": {"tbody", "thead", "tfoot"}, "tfoot": {"tbody", "thead", "tfoot"},
        "option": {"option"}, "optgroup": {"option", "optgroup"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select"}, "optgroup": {"select"}}

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(>|\Z)",
                    re.S)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_WORD = re.compile(r"[a-z0-9]+")


HARD, SOFT, PLAIN, CHIEF = 3, 2, 0, 1       # furniture by name, by a part of a name; nothing; the main part


def _named(attributes: str) -> int:
    """What the names of an element make of it."""
    kind = PLAIN
    for m in _NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().replace("_", "-").split():
            if name in HINTS:
                return HARD
            parts = _WORD.findall(name)
            if HINTS.intersection(parts) and not NOT.intersection(parts):
                kind = SOFT
            elif name in MAIN and kind == PLAIN:
                kind = CHIEF
    if "hidden" in attributes and re.search(r"\bhidden\b(?!\s*=\s*[\"']?false)", attributes):
        return HARD
    return kind


def _ended(stack: list[tuple], name: str) -> int:
    """How many of the open elements a start tag ends."""
    if name in ENDS:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] in ENDS[name]:
                return len(stack) - k
            if stack[k][0] in SCOPE.get(name, {"table"}):
                return 0
    elif name in BLOCK:
        for k in range(len(stack) - 1, -1, -1):
            if stack[k][0] == "p":
                return len(stack) - k
            if stack[k][0] in BLOCK or stack[k][0] in FURNITURE:
                return 0
    return 0


def blocks(page: str) -> list[tuple[str, bool, int]]:
    """(text, in furniture, part) of the text blocks in page order; part is 2 in the main part, 1 in an article, else 0."""
    out: list[tuple[str, bool, int, tuple[int, ...]]] = []
    # name, opens furniture, part it opens, number of a half-named element
    stack: list[tuple[str, bool, int, int]] = []
    text: list[str] = []
    furniture, half = 0, 0

    def flush():
        if text:
            t = " ".join(html.unescape("".join(text)).split())
            if t:
                out.append((t, furniture > 0, max((x[2] for x in stack), default=0), tuple(x[3] for x in stack if x[3])))
            text.clear()

    def close(n):
        nonlocal furniture
        gone = stack[len(stack) - n:]
        if any(x[1] or x[2] or x[3] for x in gone):
            flush()
        del stack[len(stack) - n:]
        furniture -= sum(x[1] for x in gone)

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            cut = re.search(r"<[a-zA-Z/!?][^>]*\Z", page[at:])
            text.append(page[at:at + cut.start()] if cut else page[at:])
            break
        if m.start() > at:
            text.append(page[at:m.start()])
        at = m.end()
        name = m[2] or m[6]
        if not name:
            continue
        name, closing, attributes = name.lower(), bool(m[1] or m[5]), m[3] or m[7] or ""
        if not (m[4] or m[8]):
            break       # cut off inside a tag
        if name in BLOCK or name in FURNITURE:
            flush()
        elif name == "br":
            text.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    close(len(stack) - k)
                    break
            continue
        if n := _ended(stack, name):
            close(n)
        if name in RAW:
            end = re.compile(rf"</{name}\b[^>]*>?", re.I).search(page, at)
            at = end.end() if end else size
            continue
        if name in VOID or attributes.endswith("/") and name not in BLOCK:
            continue
        named = _named(attributes) if attributes and name not in ("html", "body", "article", "main") else PLAIN
        part = 2 if name == "main" or named == CHIEF else 1 if name == "article" else 0
        opens = named == HARD or name in FURNITURE and not (name == "header" and any(x[2] for x in stack))
        half += named == SOFT
        if opens or part or named == SOFT:
            flush()
        stack.append((name, opens, 0 if furniture else part, half if named == SOFT else 0))
        furniture += opens
    flush()
    return _settled(out)


def _settled(found: list[tuple]) -> list[tuple[str, bool, int]]:
    """The blocks, those in half-named elements as furniture unless the element holds most of the page's words."""
    words: dict[int, int] = {}
    total = 0
    for text, furniture, _, halves in found:
        n = 0 if furniture else text.count(" ") + 1
        total += n
        for k in halves:
            words[k] = words.get(k, 0) + n
    return [(text, furniture or any(words[k] <= MOST * total for k in halves), part) for text, furniture, part, halves in found]


_U = np.uint64


def _stream(texts: list[str]) -> np.ndarray:
    """Token ids of a page's blocks, one after another."""
    tokens = " ".join(texts).split(" ") if texts else []
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def _key(stream: np.ndarray) -> int:
    """What copies of a page have in common."""
    return xxhash.xxh64_intdigest(stream.tobytes()) - 2**63


def suffix_ranks(stream: np.ndarray) -> np.ndarray:
    """A number for the first ``REPEAT`` tokens of every suffix that has so many."""
    n = len(stream) - REPEAT + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.zeros(n, np.uint64)
    for k in range(REPEAT):
        h = (h ^ stream[k:k + n]) * _U(0x9E3779B97F4A7C15)
        h ^= h >> _U(32)
    return h.view(np.int64)


def covered(size: int, hits: np.ndarray) -> np.ndarray:
    """Which of ``size`` tokens stand in a run of ``REPEAT`` from one of the places on."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, hits, 1)
    np.add.at(edge, hits + REPEAT, -1)
    return np.cumsum(edge[:-1]) > 0


def _settle(page: list[tuple[str, bool, int]]) -> tuple[list[str], list[bool] | None, list[bool] | None]:
    """(texts, candidates, inside): the main part's blocks, if the structure tells them all; else all blocks, which of them may
    stay, and which are of the main part."""
    plain = [not furniture for _, furniture, _ in page]
    best = max((part for (_, _, part), ok in zip(page, plain) if ok), default=0)
    inside = [ok and part == best and best > 0 for (_, _, part), ok in zip(page, plain)]
    # text outside a small article is main text as well; other articles beside a main part are cards
    may = [ok and part in (0, best) for (_, _, part), ok in zip(page, plain)]
    sizes = [text.count(" ") + 1 for text, _, _ in page]
    n_inside, n_may = (sum(n for n, ok in zip(sizes, x) if ok) for x in (inside, may))
    if inside == may or best and n_inside >= MOST * n_may:
        return [x[0] for x, ok in zip(page, inside) if ok], None, None
    return [x[0] for x in page], may, inside


def _main(texts: list[str], inside: list[bool] | None) -> list[str]:
    """The main part's blocks of those stored."""
    return texts if inside is None else [t for t, ok in zip(texts, inside) if ok]


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars: one row per page."""
    page_type, url_type = (pages.schema[c].dataType.simpleString() for c in ("page_id", "url"))
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))
    rows = pages.select("page_id", "url", F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
                        host.alias("host"))
    base = f"page_id {page_type}, url {url_type}, host string"

    def cut(batches):
        for b in batches:
            cols = [[] for _ in range(5)]
            for page in map(blocks, b.column("html").to_pylist()):
                texts, may, inside = _settle(page)
                main = bool(texts) and (inside is None or any(inside))
                for col, v in zip(cols, (texts, may, inside, main, None if may is None else _key(_stream(texts)))):
                    col.append(v)
            kinds = (pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.bool_()), pa.bool_(), pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("page_id", "url", "host")), *map(pa.array, cols, kinds)],
                                             ["page_id", "url", "host", "texts", "may", "inside", "main", "copy"])

    cut_up = stored(rows.mapInArrow(cut, f"{base}, texts array<string>, may array<boolean>, inside array<boolean>, main boolean, copy long"),
                    "page-blocks")
    site = site_runs(cut_up)
    site = F.broadcast(site) if _within(site, MAX_BROADCAST_RUNS) else site
    text = F.array_join("texts", " ")
    clear = cut_up.filter(F.col("may").isNull())
    plain = clear.join(site, "host", "left_anti").select("page_id", "url", text.alias("text"), F.char_length(text).cast("long").alias("n_chars"))
    unsure = cut_up.filter(F.col("may").isNotNull())
    result = f"page_id {page_type}, url {url_type}, text string, n_chars long"
    columns = "page_id", "url", "texts", "may", "inside", "hits", "site"
    hits_type = "array<int>"
    decided = clear.join(site, "host").withColumn("hits", F.lit(None).cast(hits_type)).select(*columns).mapInArrow(_decide, result)
    if unsure.isEmpty():
        return plain.unionAll(decided)
    runs = repeated(rows, unsure.select("host").distinct())
    found = unsure.select("host", "copy", "texts").dropDuplicates(["host", "copy"]).mapInArrow(_places, "host string, copy long, rank long, at int")
    hits = found.join(runs, ["host", "rank"]).groupBy("host", "copy").agg(F.collect_list("at").alias("hits"))
    beside = unsure.join(hits, ["host", "copy"], "left").join(site, "host", "left").select(*columns).mapInArrow(_decide, result)
    return plain.unionAll(decided).unionAll(beside)


def _within(site: DataFrame, runs: int) -> bool:
    return site.agg(F.coalesce(F.sum(F.size("site")), F.lit(0))).first()[0] <= runs


def least(pages):
    """How many of a number of pages are at least ``SITE`` of them."""
    return -(-SITE[0] * pages // SITE[1])


def site_runs(cut_up: DataFrame) -> DataFrame:
    """(host, site): the runs of ``REPEAT`` tokens that stand in the main part on ``SITE`` of a host's pages, ``SITE_PAGES`` distinct ones at least."""
    main = cut_up.filter("main")
    hosts = stored(main.groupBy("host").agg(F.count("*").alias("total")).filter(F.col("total") >= SITE_PAGES), "page-hosts")
    few = F.col("total") < GROUP_PAGES * cut_up.rdd.getNumPartitions()

    def of(some, *columns):
        return main.join(broadcast_within(some, MAX_BROADCAST_HOSTS), "host").select("host", "texts", "inside", *columns)

    grouped = of(hosts.filter(~few)).unionAll(of(hosts.filter(few)).repartition("host").sortWithinPartitions("host"))
    proposed = stored(grouped.mapInArrow(_proposed, "host string, rank long, gain long"), "page-proposals")
    need = F.ceil(F.col("total") * SITE[0] / SITE[1])
    slack = proposed.filter("rank is null").groupBy("host").agg(F.sum("gain").alias("slack")).join(hosts, "host")
    likely = (proposed.filter("rank is not null").groupBy("host", "rank").agg(F.sum("gain").alias("gain")).join(slack, "host")
              .filter(F.col("gain") + F.col("slack") >= need).groupBy("host").agg(F.collect_list("rank").alias("likely")))
    likely = stored(likely, "page-candidates")
    if likely.isEmpty():
        return likely.withColumnRenamed("likely", "site")
    asked = F.broadcast(likely) if likely.agg(F.sum(F.size("likely"))).first()[0] <= MAX_BROADCAST_RUNS else likely
    counts = (main.join(asked, "host").select("host", "texts", "inside", "likely")
              .mapInArrow(_counted, "host string, rank long, pages long, copies array<long>").groupBy("host", "rank")
              .agg(F.sum("pages").alias("pages"), F.size(F.array_distinct(F.flatten(F.collect_list("copies")))).alias("copies")))
    return stored(counts.join(hosts, "host").filter((F.col("pages") >= need) & (F.col("copies") >= SITE_PAGES))
                  .groupBy("host").agg(F.collect_list("rank").alias("site")), "page-site-runs")


def _mains(batches):
    """(host, stream, likely) of the main parts."""
    for b in batches:
        names = b.schema.names
        likely = b.column("likely") if "likely" in names else None
        for k, (host, texts, inside) in enumerate(zip(*(b.column(c).to_pylist() for c in ("host", "texts", "inside")))):
            yield host, _stream(_main(texts, inside)), None if likely is None else likely[k].values.to_numpy()


def _proposed(batches):
    """(host, rank, gain): what stands on ``SITE`` of a group's pages of a host, as the pages beyond the most that a group without a
    proposal may hold; that number stands in a row without rank."""
    def common(held):
        for host, parts in held.items():
            rank, count = np.unique(np.concatenate(parts), return_counts=True)
            enough = least(len(parts))
            rank, count = rank[count >= enough], count[count >= enough]
            yield pa.RecordBatch.from_arrays([pa.array([host] * (len(rank) + 1), pa.string()), pa.array([None, *rank.tolist()], pa.int64()),
                                              pa.array(np.append(enough - 1, count - enough + 1), pa.int64())], ["host", "rank", "gain"])

    held, size = {}, 0
    for host, stream, _ in _mains(batches):
        rank = np.unique(suffix_ranks(stream))
        held.setdefault(host, []).append(rank)
        size += len(rank)
        if size >= GROUP_TOKENS:
            yield from common(held)
            held, size = {}, 0
    yield from common(held)


def _counted(batches):
    """(host, rank, pages, copies): on how many pages the proposed runs stand, with the smallest keys of ``SITE_PAGES`` distinct ones."""
    def reduced(held):
        for host, runs in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(runs), pa.string()), pa.array(list(runs), pa.int64()),
                                              pa.array([n for n, _ in runs.values()], pa.int64()),
                                              pa.array([list(keys) for _, keys in runs.values()], pa.list_(pa.int64()))],
                                             ["host", "rank", "pages", "copies"])

    held, size = {}, 0
    for host, stream, likely in _mains(batches):
        runs = held.setdefault(host, {})
        size -= len(runs)
        key = _key(stream)
        for r in np.intersect1d(suffix_ranks(stream), likely).tolist():
            run = runs.setdefault(r, [0, set()])
            run[0] += 1
            run[1].add(key)
            if len(run[1]) > SITE_PAGES:
                run[1].remove(max(run[1]))
        size += len(runs)
        if size >= COUNTED_RUNS:
            yield from reduced(held)
            held, size = {}, 0
    yield from reduced(held)


def repeated(rows: DataFrame, hosts: DataFrame) -> DataFrame:
    """(host, rank): the runs of ``REPEAT`` tokens that stand on two or more distinct pages of one of the hosts."""
    some = rows.join(broadcast_within(hosts, MAX_BROADCAST_HOSTS), "host", "left_semi").select("host", "html")
    return (some.mapInArrow(_suffixes, "host string, rank long, low long, high long").groupBy("host", "rank")
            .agg(F.min("low").alias("low"), F.max("high").alias("high")).filter("low < high").select("host", "rank"))


def _suffixes(batches):
    """(host, rank, low, high): the suffixes of a task's pages by host and rank, with their smallest and largest page."""
    def reduced(held):
        for host, parts in held.items():
            rank, copy = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((copy, rank))
            rank, copy = rank[order], copy[order]
            first = np.flatnonzero(np.append(True, rank[1:] != rank[:-1])) if len(rank) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(first), pa.string()), pa.array(rank[first]), pa.array(copy[first]),
                                              pa.array(copy[np.append(first[1:], len(rank)) - 1] if len(first) else copy)],
                                             ["host", "rank", "low", "high"])

    held, size = {}, 0
    for b in batches:
        for host, page in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            stream = _stream([x[0] for x in blocks(page)])
            rank = np.unique(suffix_ranks(stream))
            held.setdefault(host, []).append((rank, np.full(len(rank), _key(stream))))
            size += len(rank)
            if size >= BATCH_TOKENS:
                yield from reduced(held)
                held, size = {}, 0
    yield from reduced(held)


def _places(batches):
    """(host, copy, rank, at): the suffixes of pages with their places."""
    for b in batches:
        for host, copy, texts in zip(*(b.column(c).to_pylist() for c in ("host", "copy", "texts"))):
            rank = suffix_ranks(_stream(texts))
            yield pa.RecordBatch.from_arrays([pa.array([host] * len(rank), pa.string()), pa.array(np.full(len(rank), copy)), pa.array(rank),
                                              pa.array(np.arange(len(rank), dtype=np.int32))], ["host", "copy", "rank", "at"])


def _decide(batches):
    """The text of pages whose blocks the repeats decide."""
    for b in batches:
        out = []
        runs = b.column("site")
        for i, (texts, may, inside, hits) in enumerate(zip(*(b.column(c).to_pylist() for c in ("texts", "may", "inside", "hits")))):
            stay = [True] * len(texts) if inside is None else list(inside)
            if runs[i].is_valid and any(stay):
                for k, drop in zip([k for k, ok in enumerate(stay) if ok], _of_site(_main(texts, inside), runs[i].values.to_numpy())):
                    stay[k] = not drop
            if may is not None:
                at = np.cumsum([0, *(t.count(" ") + 1 for t in texts)])
                marks = covered(int(at[-1]), np.array(hits or [], np.int64))
                for k in range(len(texts)):
                    if may[k] and not inside[k]:
                        stay[k] = marks[at[k]:at[k + 1]].mean() < COVERED
            out.append(" ".join(t for t, ok in zip(texts, stay) if ok))
        yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                                         ["page_id", "url", "text", "n_chars"])


def _of_site(main: list[str], site: np.ndarray) -> list[bool]:
    """Which of the main part's blocks runs of the whole site cover; none, if they are most of it."""
    stream = _stream(main)
    hits = np.flatnonzero(np.isin(suffix_ranks(stream), site))
    if not len(hits):
        return [False] * len(main)
    sizes = np.array([t.count(" ") + 1 for t in main])
    marked = np.add.reduceat(covered(len(stream), hits).astype(np.int64), np.cumsum(sizes) - sizes)
    drop = marked / sizes >= COVERED
    return drop.tolist() if sizes[drop].sum() <= MOST * len(stream) else [False] * len(main)
