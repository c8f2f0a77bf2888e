"""HTML extraction: boilerplate found in suffix arrays of each host's pages.

A page becomes blocks of text with a zone: inside an article or main element, inside an element that
names itself a menu, footer, notice and so on, or open. Everything outside articles is one
stream of words for each page. The streams of a host's pages are concatenated, their suffixes are sorted
(to the depth of the shortest run that counts), and runs that occur on distinct pages cover
their words. Covered blocks are boilerplate, and what names itself boilerplate goes even if it
occurs once. On a page with an article only its blocks are left; on others the open unique blocks.

The words of articles are a second stream, searched in the same way, equal articles of a host as one. Articles
quote each other and have edited copies, so a run is a notice of the site only if at least half of the host's distinct
articles hold it, three or more. Blocks that such runs cover go, unless they are half of the article or more.

A host's pages are dealt by a hash into groups of a bounded size, each with its own suffix array. What a group of
a large host holds on one page only may be repeated in another group: groups report the hashes of their runs, those
on several pages once, and runs that several groups report cover their words too. What half of a host's articles hold,
half of those of some group hold: groups propose runs, and a pass over the pages of hosts with proposals counts
them exactly. So groups do not change the result.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymark.llm.shared import appended, chunks, hashed_words, key_filter, mixed, passing, rolled, stored, word_bytes
from daymark.llm.url_filter import host_of

RUN = 8
GROUP_PAGES = 256
#: A run is a notice if so many distinct articles of a host hold it, and at least half of them.
NOTICES = 3
ARTICLE, OPEN, MARKED = 0, 1, 2

#: Fixed lists of HTML element names, by what they mean for the text.
CONTAINERS = {"article", "main"}
RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas", "select", "xmp"}
MENUS = {"nav", "header", "footer", "aside", "form", "menu", "dialog", "head", "button", "fieldset", "datalist"}
BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: Words of class, id and role names that mark boilerplate.
MARKS = set(
    "ad ads advert advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies disclaimer disqus footer form gdpr header login masthead menu modal nav navbar navigation newsletter notice popup "
    "promo promoted related replies search share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)

_TAG = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")


def _marked(name: str, attributes: str) -> bool:
    if name in MENUS:
        return True
    if not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    return any(MARKS & set(_WORD.findall(part.lower())) for found in _NAMED.findall(attributes) for part in found)


def blocks_of(page: str) -> list[tuple[str, int]]:
    """(text, zone) of each block with text, in page order.

    Character references are decoded, white space inside a block becomes one space and is trimmed.
    Marked elements end with their own end tag; an article that begins inside one ends it, so that
    a missing end tag can't hide the page.
    """
    blocks: list[tuple[str, int]] = []
    text: list[str] = []
    inside = 0  # depth of articles
    skipped, depth = "", 0  # marked element and its depth
    zone, last, raw_end = OPEN, 0, None

    def close() -> None:
        joined = " ".join(entities.unescape("".join(text)).split()) if text else ""
        if joined:
            blocks.append((joined, zone))
        text.clear()

    place = 0
    while True:
        tag = _TAG.search(page, place)
        text.append(page[place : tag.start() if tag else len(page)])
        if tag is None:
            close()
            return blocks
        place = tag.end()
        name = (tag[2] or "").lower()
        if not name:
            continue
        ending = bool(tag[1])
        if name in RAW:
            if not ending and not tag[3].endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(page, place)
                place = end.end() if end else len(page)
            continue
        if name in BLOCKS:
            close()
        elif name == "br":
            text.append(" ")
        if name in VOID:
            continue
        if skipped and not (name in CONTAINERS and not ending and not inside):
            if name == skipped:
                depth += -1 if ending else 1
                if depth == 0:
                    close()
                    skipped = ""
        elif name in CONTAINERS:
            skipped = "" if not ending else skipped
            if ending:
                inside = max(0, inside - 1)
            elif _marked(name, tag[3]):
                skipped, depth = name, 1
            else:
                inside += 1
        elif not ending and not (name == "header" and inside) and name not in ("body", "html") and _marked(name, tag[3]):
            close()
            skipped, depth = name, 1
        zone = MARKED if skipped else ARTICLE if inside else OPEN


def covered_words(streams: list[np.ndarray], run: int = RUN, least: int = 2, owners: list[int] | None = None) -> list[np.ndarray]:
    """Which words of each page's stream lie in a run of `run` words that occurs on `least` pages or more.

    Suffixes are ranked by prefix doubling until the ranks order them by their first `run` words. A page may have
    several streams: owners are the streams' pages, ascending.
    """
    sizes = np.array([len(s) for s in streams])
    page = np.repeat(np.arange(len(streams)) if owners is None else np.array(owners, np.int64), sizes + 1)
    joined = np.zeros(len(page), np.uint64)
    ends = np.cumsum(sizes + 1) - 1
    words = np.ones(len(page), bool)
    words[ends] = False
    joined[words] = np.concatenate(streams) if len(streams) else []
    rank = np.unique(joined, return_inverse=True)[1].astype(np.int64) + len(streams) + 1
    rank[ends] = np.arange(len(streams))  # each page's end differs from all others
    reach = 1
    while reach < run:
        step = min(reach, run - reach)
        following = np.full(len(rank), -1, np.int64)
        following[:-step] = rank[step:]
        rank = np.unique(rank * (len(rank) + len(streams) + 2) + following + 1, return_inverse=True)[1].astype(np.int64)
        reach += step
    order = np.argsort(rank, kind="stable")  # the suffix array, to this depth
    ordered, pages = rank[order], page[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    last = np.concatenate([first[1:], [len(ordered)]]) - 1
    changes = np.concatenate([[0], np.cumsum(pages[1:] != pages[:-1])])
    shared = changes[last] - changes[first] + 1 >= least  # stable order: pages ascend inside a group of equals
    shared &= order[first] + run <= np.repeat(ends, sizes + 1)[order[first]]
    starts = order[np.repeat(shared, last - first + 1)]
    edges = np.zeros(len(rank) + run + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + run, -1)
    held = np.cumsum(edges)[: len(rank)] > 0
    return [held[e - n : e] for e, n in zip(ends, sizes, strict=True)]


def _stream(blocks: list[tuple[str, int]], article: bool = False) -> np.ndarray:
    return hashed_words(" ".join(t for t, zone in blocks if (zone == ARTICLE) == article).lower().encode("utf-8", "replace"), word_bytes())


def _sizes(blocks: list[tuple[str, int]], zones: tuple[int, ...]) -> list[int]:
    """Number of words of each block, negative in zones that none is taken from."""
    return [len(t.lower().encode("utf-8", "replace").split()) * (1 if zone in zones else -1) for t, zone in blocks]


def _codes(words: np.ndarray) -> np.ndarray:
    """Two bytes of each word, enough to propose runs."""
    return (words >> np.uint64(48)).astype(np.uint16)


def _article_key(host: str, words: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(host.encode("utf-8", "replace") + b"\0" + words.tobytes(), digest_size=8).digest(), "little", signed=True)


def _keyed(runs: np.ndarray, host: int) -> np.ndarray:
    return mixed(runs ^ np.uint64(host & 0xFFFFFFFFFFFFFFFF))


def _proposed(articles: list[np.ndarray], least: int, host: int) -> np.ndarray:
    """Hashes of the runs that at least so many of a group's articles (codes of words) hold.

    Words on fewer articles end the streams that are searched.
    """
    held = np.zeros(1 << 16, np.int64)
    for codes in articles:
        held[np.unique(codes)] += 1
    streams, owners = [], []
    for i, codes in enumerate(articles):
        cuts = np.flatnonzero(np.diff(np.concatenate([[False], held[codes] >= least, [False]]).astype(np.int8)))
        for start, end in zip(cuts[::2], cuts[1::2], strict=True):
            if end - start >= RUN:
                streams.append(codes[start:end].astype(np.uint64))
                owners.append(i)
    if not streams:
        return np.empty(0, np.int64)
    found = []
    for stream, covered in zip(streams, covered_words(streams, RUN, least, owners), strict=True):
        inside = np.convolve(covered, np.ones(RUN, np.int64), "valid") == RUN
        found.append(rolled(stream, RUN)[inside])
    return np.unique(_keyed(np.concatenate(found), host)).view(np.int64)


def _reports(streams: list[np.ndarray], bare: np.ndarray, host: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, page, place) of each run of a group; page and place are -1 if they need no answer.

    A run on several pages comes once, without a page. One on a single page comes at each place of it, without
    the page if that has an article.
    """
    every = [rolled(s, RUN) for s in streams]
    sizes = np.array([len(g) for g in every])
    page = np.repeat(np.arange(len(every)), sizes)
    place = np.arange(len(page)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    grams = _keyed(np.concatenate(every), host)
    order = np.argsort(grams, kind="stable")  # pages ascend inside a group of equals
    grams, page, place = grams[order], page[order], place[order]
    first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]])) if len(grams) else np.empty(0, np.int64)
    sizes = np.diff(np.append(first, len(grams)))
    asks = np.repeat(page[first] == page[first + sizes - 1], sizes) & bare[page]
    page, place = np.where(asks, page, -1), np.where(asks, place, -1)
    kept = asks.copy()
    kept[first] = True
    return grams[kept].view(np.int64), page[kept], place[kept]


_REPORTED = ["page_key", "sizes", "held", "gram", "deal", "place", "host_key", "articles", "proposal"]
_NUMBERS = dict.fromkeys(("page_key", "gram", "deal", "place", "host_key", "articles", "proposal"), "Int64")


def boilerplate(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """(page_key, covered): numbers of the blocks that repeated runs cover: of open ones for pages without an article, else of the article's.

    pages: (page_key, host, html). A block counts as covered if four fifths of its words are.
    """
    sizes = pages.groupBy("host").agg(F.count("*").alias("m")).where(F.col("m") > group_pages)
    many = F.coalesce(F.ceil(F.col("m") / group_pages), F.lit(1))

    def streams(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """A row for each page with the words outside its article, and one with its article's words in two bytes each."""
        for frame in chunks(frames, "html"):
            rows = []
            for key, host, page in zip(frame["page_key"], frame["host"], frame["html"], strict=True):
                blocks = blocks_of(page)
                bare = all(zone != ARTICLE for _, zone in blocks)
                # Pages with an article only show others what repeats outside it; those blocks are settled.
                rows.append((False, key, host, _stream(blocks).tobytes(), _sizes(blocks, (OPEN,)) if bare else None))
                if not bare:
                    words = _stream(blocks, article=True)
                    rows.append((True, _article_key(host, words), host, _codes(words).tobytes(), None))
            yield pd.DataFrame(rows, columns=["article", "unit", "host", "words", "sizes"])

    def cover(frame: pd.DataFrame) -> pd.DataFrame:
        """A row for each page without an article, the runs' reports if the host has other groups, and proposals of notices."""
        parts, alone, host_key = [], frame["many"].iloc[0] == 1, int(frame["host_key"].iloc[0])
        is_article = frame["article"].to_numpy(bool)
        articles = [np.frombuffer(w, np.uint16) for w in frame["words"][is_article]]
        if len(articles) >= (NOTICES if alone else 1):
            proposed = _proposed(articles, max((len(articles) + 1) // 2, NOTICES if alone else 1), host_key)
            parts.append(pd.DataFrame({"host_key": [host_key], "articles": [len(articles)]}))
            parts.append(pd.DataFrame({"host_key": host_key, "proposal": proposed}))
        rest = frame[~is_article]
        bare = rest["sizes"].notna().to_numpy(bool)
        if bare.any() or not alone and len(rest):
            words, keys = [np.frombuffer(w, np.uint64) for w in rest["words"]], rest["unit"].to_numpy(np.int64)
            if bare.any():
                held = covered_words(words)
                bits = [np.packbits(held[i]).tobytes() for i in np.flatnonzero(bare)]
                parts.append(pd.DataFrame({"page_key": keys[bare], "sizes": rest["sizes"][bare].to_list(), "held": bits}))
            if not alone:
                grams, page, place = _reports(words, bare, host_key)
                known = pd.array(np.where(page < 0, 0, keys[page]), "Int64")
                known[page < 0] = pd.NA
                parts.append(pd.DataFrame({"page_key": known, "gram": grams, "deal": frame["deal"].iloc[0], "place": place}))
        parts = [part.reindex(columns=_REPORTED).astype(_NUMBERS).astype({"sizes": object, "held": object}) for part in parts if len(part)]
        return pd.concat([part.where(part.notna(), None) for part in parts]) if parts else pd.DataFrame([], columns=_REPORTED)

    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, sizes, bits, places in zip(frame["page_key"], frame["sizes"], frame["held"], frame["places"], strict=True):
                ends = np.cumsum(np.abs(sizes))
                held = np.unpackbits(np.frombuffer(bits, np.uint8))[: ends[-1] if len(ends) else 0].astype(bool)
                found = _covered(sizes, held, places if places is not None else ())
                if found:
                    out.append((key, found))
            yield pd.DataFrame(out, columns=["page_key", "covered"])

    units = "article boolean, unit bigint, host string, words binary, sizes array<bigint>"
    read = pages.mapInPandas(streams, units).dropDuplicates(["article", "unit"])
    dealt = read.join(sizes, "host", "left").withColumns({"many": many, "deal": F.pmod(F.xxhash64("unit"), many), "host_key": F.xxhash64("host")})
    dealt = dealt.select("host", "host_key", "many", "deal", "article", "unit", "words", "sizes")
    kinds = "page_key bigint, sizes array<bigint>, held binary, gram bigint, deal bigint, place bigint, host_key bigint, articles bigint, proposal bigint"
    reported = stored(dealt.groupBy("host", "deal").applyInPandas(cover, kinds), "page-runs")
    runs = reported.where("gram IS NOT NULL").select("gram", "deal", "page_key", "place")
    met = runs.groupBy("gram").agg(F.min("deal").alias("low"), F.max("deal").alias("high")).where("low <> high").select("gram")
    asked = runs.where("page_key IS NOT NULL").join(met, "gram").groupBy("page_key").agg(F.collect_list("place").alias("places"))
    bare = reported.where("held IS NOT NULL").select("page_key", "sizes", "held").join(asked, "page_key", "left")
    found = bare.mapInPandas(settle, "page_key bigint, covered array<bigint>")
    proposals = reported.where("proposal IS NOT NULL").select("host_key", "proposal")
    if proposals.isEmpty():
        return found
    totals = reported.where("articles IS NOT NULL").groupBy("host_key").agg(F.sum("articles").alias("total"))
    return found.unionByName(_notices(pages.withColumn("host_key", F.xxhash64("host")), proposals, totals))


def _covered(sizes: np.ndarray, held: np.ndarray, places: np.ndarray) -> list[int]:
    """Numbers of the blocks of which four fifths lie in held words or in runs at the places."""
    for place in places:
        held[place : place + RUN] = True
    ends = np.cumsum(np.abs(sizes))
    return [i for i, (end, n) in enumerate(zip(ends, sizes, strict=True)) if n > 0 and 5 * held[end - n : end].sum() >= 4 * n]


def _notices(pages: DataFrame, proposals: DataFrame, totals: DataFrame) -> DataFrame:
    """(page_key, covered) of pages whose article holds notices of the site; what is proposed is counted exactly.

    pages: (page_key, host, host_key, html). totals: (host_key, total), the numbers of distinct articles.
    """
    wanted = key_filter(proposals, "proposal")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in chunks(frames, "html"):
            rows = []
            for key, host, host_key, page in zip(frame["page_key"], frame["host"], frame["host_key"], frame["html"], strict=True):
                blocks = blocks_of(page)
                words = _stream(blocks, article=True)
                if len(words) < RUN:
                    continue
                places = np.flatnonzero(wanted.value.passes(_keyed(rolled(_codes(words).astype(np.uint64), RUN), host_key)))
                if len(places):
                    grams = _keyed(rolled(words, RUN), host_key)[places].view(np.int64)
                    sizes = [n if zone == ARTICLE else 0 for n, (_, zone) in zip(_sizes(blocks, (ARTICLE,)), blocks, strict=True)]
                    rows.append((key, host_key, _article_key(host, words), sizes, grams, places))
            yield pd.DataFrame(rows, columns=["page_key", "host_key", "article_key", "sizes", "grams", "places"])

    def settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, sizes, places in zip(frame["page_key"], frame["sizes"], frame["places"], strict=True):
                found = _covered(sizes, np.zeros(sizes.sum(), bool), places)
                if found and 2 * sizes[found].sum() < sizes.sum():
                    out.append((key, found))
            yield pd.DataFrame(out, columns=["page_key", "covered"])

    kinds = "page_key bigint, host_key bigint, article_key bigint, sizes array<bigint>, grams array<bigint>, places array<bigint>"
    hosts = proposals.select("host_key").distinct()
    hits = stored(pages.join(hosts, "host_key", "left_semi").mapInPandas(read, kinds).dropDuplicates(["page_key"]), "notice-runs")
    once = hits.select("host_key", "article_key", F.explode("grams").alias("gram")).distinct()
    counts = once.groupBy("host_key", "gram").agg(F.count("*").alias("n")).join(totals, "host_key")
    notices = counts.where((F.col("n") >= NOTICES) & (2 * F.col("n") >= F.col("total"))).select("gram")
    runs = hits.select("page_key", F.explode(F.arrays_zip("grams", "places")).alias("run"))
    runs = runs.select("page_key", F.col("run.grams").alias("gram"), F.col("run.places").alias("place"))
    held = runs.join(notices, "gram", "left_semi").groupBy("page_key").agg(F.collect_list("place").alias("places"))
    return hits.select("page_key", "sizes").join(held, "page_key").mapInPandas(settle, "page_key bigint, covered array<bigint>")


def text_of(page: str, covered: list[int] | None = None) -> str:
    """The main text: the article's blocks, or else the open blocks; those that are covered go (unless all are)."""
    blocks, gone = blocks_of(page), set(covered if covered is not None else ())
    wanted = ARTICLE if any(zone == ARTICLE for _, zone in blocks) else OPEN
    own = [(i, t) for i, (t, zone) in enumerate(blocks) if zone == wanted]
    return "\n".join([t for i, t in own if i not in gone] or [t for _, t in own])


def extract_text(pages: DataFrame, group_pages: int = GROUP_PAGES) -> DataFrame:
    """pages (url, html and others) with `text`, the main text, and `n_chars`, its code points.

    A null or empty html gives an empty text. A null URL, or one without a host, counts as the empty
    host. Repeated rows do not count as distinct pages and get the same text. Existing columns named text,
    n_chars, page_key or covered are replaced; others stay. An empty table gives no rows.
    """
    kept = pages.drop("text", "n_chars", "covered").withColumn("page_key", F.xxhash64("url", "html"))
    slim = kept.select("page_key", host_of(F.col("url")).alias("host"), "html")
    found = stored(boilerplate(slim, group_pages), "boilerplate")
    marked = kept.withColumn("maybe", passing(key_filter(found, "page_key"))("page_key"))

    def read(htmls: list[str], covered: list | None = None) -> list:
        texts = list(map(text_of, htmls, covered or [None] * len(htmls)))
        return [texts, list(map(len, texts))]

    fields = "text string, n_chars bigint"
    clean = appended(marked.where("NOT maybe").drop("maybe"), ["html"], read, fields)
    met = marked.where("maybe").drop("maybe").join(found, "page_key", "left")
    cut = appended(met, ["html", "covered"], read, fields).drop("covered")
    return clean.unionByName(cut).drop("page_key")
