"""Main text of web pages: markup for what it says, a host's suffix arrays for what it does not."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabscope.llm.batches import CHUNK_BYTES, chunks, texts
from tabscope.llm.common import written

LONG = 8  # words of a repeated run, a power of two
# A run is the host's if LEAST pages and one page in SHARE have it, or COMMON pages where more care is due. What is on
# every second page as well, COMMON at least, is the host's on any page.
LEAST, SHARE, COMMON = 2, 5, 5
DEALT = 128  # pages of a host that are searched together, where it has more
HOT_HOSTS = 1000  # hosts whose pages are dealt to several tasks; any other has under 0.1 % of the pages
MIX = np.uint64(0x9E3779B97F4A7C15)

# fixed values: elements by what they are for
RAW = "script|style|textarea|title|noscript|template|iframe|svg|math|object|audio|video|canvas"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr img".split()
)
FRAME = frozenset("nav footer aside form head button select menu dialog fieldset".split())
MAIN = frozenset("article main".split())
FRAME_ROLE = re.compile(r"navigation|banner|contentinfo|complementary|search|dialog|alert|menu|form")
FRAME_NAME = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|breadcrumbs?|comments?|commentlist|disqus|cookies?|"
    r"consent|gdpr|notice|newsletter|subscribe|popup|modal|menu|nav|navbar|navigation|sidebar|footer|masthead|"
    r"share|sharing|social|related|recommended|pagination|pager|toolbar|widget|login|signup)(?=$|[\s_-])",
    re.I,
)
NAMED = frozenset("div section ul ol dl p table span header aside li".split())
# what a start tag ends: the tags whose nearest open one it closes, within the element that holds them
BLOCK = frozenset(
    "address article aside blockquote center details dialog dd dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split()
)
ENDS = {"li": "li", "dt": "dt dd", "dd": "dt dd", "td": "td th", "th": "td th", "tr": "tr", "option": "option", "optgroup": "option optgroup"}
ENDS |= dict.fromkeys(("thead", "tbody", "tfoot"), "thead tbody tfoot tr td th")
ENDS = {tag: frozenset(closed.split()) for tag, closed in ENDS.items()}
LISTED = frozenset("li dt dd".split())
HOLDS = frozenset("table select datalist".split())  # no cell, row or option outside is closed from inside
HOLDS_P = frozenset("table caption td th button object template".split())
MARKUP = re.compile(
    # an empty drawing or formula holds nothing, not the rest of the page
    r"<(?:svg|math)\b(?:\"[^\"]*\"|'[^']*'|[^\"'>])*/>"
    rf"|<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^\"'>])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^\"'>])*)>|<[!?][^>]*>",
    re.S | re.I,
)
ATTRIBUTE = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)


def is_frame(tag: str, attributes: str) -> bool:
    """Whether an element is for the site and not the page: by tag, role, class or id."""
    if tag in FRAME:
        return True
    if not attributes:
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and FRAME_ROLE.fullmatch(value):
            return True
        if name in ("class", "id") and tag in NAMED and FRAME_NAME.search(value):
            return True
    return False


def implied_end(opened: list[tuple[str, str]], tag: str) -> int:
    """Where the stack of open elements is cut by the start of ``tag``; its length, if nowhere."""
    cut = len(opened)
    if tag in ENDS:
        for k in range(len(opened) - 1, -1, -1):
            other = opened[k][0]
            if other in ENDS[tag]:
                cut = k
                if tag not in ("tbody", "thead", "tfoot", "optgroup"):
                    break
            elif other in HOLDS or tag in LISTED and other not in INLINE and other not in ("address", "div", "p"):
                break
    if tag in BLOCK:
        for k in range(cut - 1, -1, -1):
            if opened[k][0] == "p":
                return k
            if opened[k][0] in HOLDS_P or opened[k][0] in BLOCK:
                break  # the start of that block has ended any p around it
    return cut


def blocks(page: str) -> list[tuple[str, str]]:
    """The page's blocks in order, as (kind, text): ``main`` inside an article or main element,
    ``frame`` in elements that are for the site, ``plain`` elsewhere.

    Elements left open end with the element around them, and paragraphs, items, cells, rows and
    options at the start tag that implies their end; an end tag without a start is ignored. Character references are decoded, white space inside a block is one space, and
    empty blocks are left out. Scripts, styles, comments and the like hold no text.
    """
    found: list[tuple[str, str]] = []
    held: list[str] = []
    opened: list[tuple[str, str]] = []  # tag, and the kind of text inside it

    def close_block() -> None:
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                found.append((opened[-1][1] if opened else "plain", text))
            held.clear()

    at = 0
    for mark in MARKUP.finditer(page):
        if mark.start() > at:
            held.append(page[at : mark.start()])
        at = mark.end()
        tag = mark[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br":
            held.append(" ")
            continue
        inline = tag in INLINE
        if mark[2]:
            for k in range(len(opened) - 1, -1, -1):
                if opened[k][0] == tag:
                    if not inline or len({kind for _, kind in opened[k:]} | {opened[k - 1][1] if k else "plain"}) > 1:
                        close_block()
                    del opened[k:]
                    break
            else:
                if not inline:
                    close_block()
            continue
        cut = implied_end(opened, tag)
        if cut < len(opened):
            close_block()
            del opened[cut:]
        kind = opened[-1][1] if opened else "plain"
        inside = kind
        if kind != "frame":
            if is_frame(tag, mark[4]) or (tag == "header" and kind == "plain"):
                inside = "frame"
            elif tag in MAIN:
                inside = "main"
        if not inline or inside != kind:
            close_block()
        if tag not in VOID and not mark[4].endswith("/"):
            opened.append((tag, inside))
    if at < len(page):
        held.append(page[at:])
    close_block()
    return found


def site(url_col: str) -> Column:
    """A digest of the page's host; pages without one share it."""
    return F.xxhash64(F.coalesce(F.try_parse_url(F.col(url_col), F.lit("HOST")), F.lit("")))


def parse(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """One row per page: row, id, url, site (a digest of the host), ``main``: whether it has a main element,
    ``own``: the blocks inside it, or the ``plain`` ones if it has none, ``around``: the other blocks. Each block
    is a line."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "html"):
            main, own, around = [], [], []
            for page in texts(batch, "html"):
                parts = blocks(page)
                main.append(any(kind == "main" for kind, _ in parts))
                wanted = "main" if main[-1] else "plain"
                own.append("\n".join(t for kind, t in parts if kind == wanted))
                around.append("\n".join(t for kind, t in parts if kind != wanted))
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("row", "id", "url", "site")]
                + [pa.array(main, pa.bool_()), pa.array(own, pa.string()), pa.array(around, pa.string())],
                ["row", "id", "url", "site", "main", "own", "around"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        site(url_col).alias("site"),
        F.col(html_col).alias("html"),
    )
    schema = f"row bigint, id {kind}, url string, site bigint, main boolean, own string, around string"
    return rows.mapInArrow(run, schema)


def word_keys(words: list[str]) -> np.ndarray:
    """A 64-bit number for each word, the same in every task."""
    import xxhash

    coded = pa.array(words, pa.string()).dictionary_encode()
    keys = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    return keys[coded.indices.to_numpy()]


def classes_to(keys: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorts all suffixes of the concatenated streams by their first ``depth`` words.

    keys: one number a word; ends: where the stream of each word ends. Starts from the order of
    single words and doubles: the order by 2k words is the order of pairs of the orders by k. Returns
    the suffix array of the suffixes that have ``depth`` words, and for each of them the
    class of its first ``depth`` words; equal classes stand together.
    """
    _, rank = np.unique(keys, return_inverse=True)
    reach = 1
    while reach < depth:
        follow = np.zeros(len(rank), np.int64)
        follow[:-reach] = rank[reach:] + 1
        follow[np.arange(len(rank)) + reach >= ends] = 0
        _, rank = np.unique(rank * np.int64(len(rank) + 1) + follow, return_inverse=True)
        reach *= 2
    whole = np.flatnonzero(np.arange(len(keys)) + depth <= ends)
    order = whole[np.argsort(rank[whole], kind="stable")]
    return order, rank[order]


def window_keys(keys: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """A 64-bit number for the ``depth`` words from each start."""
    mixed = np.zeros(len(starts), np.uint64)
    for k in range(depth):
        mixed = (mixed ^ keys[starts + k]) * MIX
        mixed ^= mixed >> np.uint64(31)
    return mixed.view(np.int64)


def page_words(pages: list[tuple[str, ...]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words of the pages' streams, one after the other: key, end of its stream, page."""
    streams = [text.split() for page in pages for text in page]
    sizes = np.array([len(s) for s in streams], np.int64)
    owner = np.repeat(np.arange(len(pages)), [len(page) for page in pages])
    keys = word_keys(list(chain.from_iterable(streams)))
    return keys, np.repeat(np.cumsum(sizes), sizes), np.repeat(owner, sizes)


def is_short(block: str) -> bool:
    return bool(block) and block.count(" ") < LONG - 1


def block_key(block: str) -> int:
    """A 64-bit number for a short block; the line end keeps it apart from a word."""
    import xxhash

    return int(np.uint64(xxhash.xxh64_intdigest(block + "\n")).view(np.int64))


def short_keys(main: bool, own: str, around: str) -> set[int]:
    """The short blocks of a page; those inside a main element are its headings and items."""
    return {block_key(b) for text in ((around,) if main else (own, around)) for b in text.split("\n") if is_short(b)}


def counted(pages: list[tuple[bool, str, str]], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of LONG words, and short blocks, that ``least`` of the pages have: keys, and number of distinct pages.

    Sorts the suffixes of the pages' streams; neighbours with LONG words in common are one class.
    """
    found = Counter(chain.from_iterable(short_keys(*page) for page in pages))
    few = [(key, n) for key, n in found.items() if n >= least]
    runs, numbers = [np.array([key for key, _ in few], np.int64)], [np.array([n for _, n in few], np.int64)]
    keys, ends, owner = page_words([page[1:] for page in pages])
    order, rank = classes_to(keys, ends, LONG) if len(keys) else (keys, keys)
    if len(order):
        other = np.r_[True, rank[1:] != rank[:-1]]
        page = owner[order]  # ascends inside a class
        n = np.add.reduceat((other | np.r_[True, page[1:] != page[:-1]]).astype(np.int64), np.flatnonzero(other))
        runs.append(window_keys(keys, order[np.flatnonzero(other)[n >= least]], LONG))
        numbers.append(n[n >= least])
    return np.concatenate(runs), np.concatenate(numbers)


def group_runs(parsed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (site, run, n, whole): what one page in SHARE of a group of a host's pages has.

    The pages of a host are searched together, those of a hot one in groups of about DEALT. A run that one page
    in SHARE of the host has is had by one in SHARE of some group, however they are dealt: none is missed.
    ``whole``: the group is all of the host, and n, the number of distinct pages with the run, is final.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple[bool, str, str]] = []
        at, held, cut = None, 0, False

        def search(whole: bool) -> Iterator[pa.RecordBatch]:
            if whole and len(group) < LEAST:
                return
            runs, n = counted(group, max(LEAST if whole else 1, -(-len(group) // SHARE)))
            columns = [np.full(len(runs), at[0], np.int64), runs, n, np.full(len(runs), whole)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["site", "run", "n", "whole"])

        for batch in batches:
            for site, salt, parts, *page in zip(
                *(batch.column(c).to_pylist() for c in ("site", "salt", "parts", "main", "own", "around"))
            ):
                if group and at != (site, salt, parts):
                    yield from search(at[2] == 1 and not cut)
                    group, held, cut = [], 0, False
                elif held > 2 * CHUNK_BYTES:
                    yield from search(False)
                    group, held, cut = [], 0, True
                at = (site, salt, parts)
                group.append(tuple(page))
                held += len(page[1]) + len(page[2])
        if group:
            yield from search(at[2] == 1 and not cut)

    hot = sizes.where(F.col("pages") > DEALT).orderBy(F.desc("pages"), "site").limit(HOT_HOSTS)
    hot = hot.select("site", F.ceil(F.col("pages") / DEALT).alias("parts"))
    sized = parsed.select("row", "site", "main", "own", "around").join(F.broadcast(hot), "site", "left")
    sized = sized.withColumn("parts", F.coalesce("parts", F.lit(1)).cast("bigint"))
    dealt = sized.withColumn("salt", F.pmod(F.xxhash64("row"), "parts")).drop("row")
    together = dealt.repartition("site", "salt").sortWithinPartitions("site", "salt")
    return together.mapInArrow(run, "site bigint, run bigint, n bigint, whole boolean")


def by_site(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, pa.Scalar]]:
    """For each host of the batch: site, its rows, and the list that came with them."""
    sites = batch.column("site").to_numpy()
    for site in np.unique(sites):
        rows = np.flatnonzero(sites == site)
        yield int(site), rows, batch.column("list")[int(rows[0])]


def count_runs(parsed: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows (site, run, n): distinct pages with each of the runs of ``wanted``, rows (site, list)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(chunks(batches, "own"), "around"):
            pages = list(zip(*(batch.column(c).to_pylist() for c in ("main", "own", "around"))))
            for site, rows, listed in by_site(batch):
                runs = np.sort(listed.values.to_numpy())
                own = [pages[k] for k in rows]
                keys, ends, owner = page_words([page[1:] for page in own])
                starts = np.flatnonzero(np.arange(len(keys)) + LONG <= ends)
                found = window_keys(keys, starts, LONG)
                hit = np.isin(found, runs)
                # a page counts once for a run
                by = np.lexsort((owner[starts[hit]], found[hit]))
                run, page = found[hit][by], owner[starts[hit]][by]
                new = np.r_[True, (run[1:] != run[:-1]) | (page[1:] != page[:-1])][: len(run)]
                short = list(chain.from_iterable(short_keys(*page) for page in own))
                short = np.array(short, np.int64)
                names, n = np.unique(np.r_[run[new], short[np.isin(short, runs)]], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(names), site, np.int64)), pa.array(names), pa.array(n.astype(np.int64))],
                    ["site", "run", "n"],
                )

    each = parsed.select("site", "main", "own", "around").join(wanted, "site")
    found = each.mapInArrow(run, "site bigint, run bigint, n bigint")
    return found.groupBy("site", "run").agg(F.sum("n").alias("n"))


def repeated_runs(parsed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows (site, list): runs of LONG words, and short blocks, that a share of the host's pages has.

    list: structs of the run and its level: 1 from LEAST pages and one in SHARE on, 2 from COMMON pages on, 3 if
    every second page has it as well. Runs of hosts that are searched in groups are counted once more over all pages.
    """
    found = written(group_runs(parsed, sizes), "pages-runs")
    open_ones = found.where("NOT whole").select("site", "run").distinct()
    wanted = written(open_ones.groupBy("site").agg(F.collect_list("run").alias("list")), "pages-wanted")
    counts = found.where("whole").select("site", "run", "n").unionByName(count_runs(parsed, wanted))
    shared = counts.join(sizes, "site").where(f"n >= {LEAST} AND n * {SHARE} >= pages")
    level = f"CASE WHEN n < {COMMON} THEN 1 WHEN n * 2 < pages THEN 2 ELSE 3 END"
    listed = shared.select("site", F.struct("run", F.expr(level).alias("level")).alias("one"))
    return listed.groupBy("site").agg(F.collect_list("one").alias("list"))


def without(words: list[str], levels: np.ndarray, short: np.ndarray, least: int) -> list[str]:
    """The words of a page that are its own.

    levels: the level of the run from each word on. short: words of short blocks that are the host's. Where runs of the
    level ``least`` cover more than half of the page, it is a near copy or mostly boilerplate, and only those
    of level 3 are cut. A stretch of more than half of the page is its body and stays, and so does a page
    that nothing would be left of.
    """

    def covered(level: int) -> np.ndarray:
        gone = short.copy()
        at = np.flatnonzero(levels >= level)
        for k in range(LONG):
            gone[at + k] = True
        return gone

    gone = covered(least)
    if 2 * gone.sum() > len(words):
        gone = covered(3)
    edges = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    for start, end in zip(edges[::2], edges[1::2]):
        if 2 * (end - start) > len(words):
            gone[start:end] = False
    return [w for w, g in zip(words, gone) if not g] or words


def own_text(parsed: DataFrame, repeated: DataFrame) -> DataFrame:
    """Rows (id, url, text): the own blocks of every page without what is the host's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "own"):
            main, own = batch.column("main").to_pylist(), batch.column("own").to_pylist()
            text = [page.replace("\n", " ") for page in own]
            for _, rows, listed in by_site(batch):
                rows = [k for k in rows.tolist() if own[k]]
                if not listed.is_valid or not rows:
                    continue
                runs, level = (listed.values.field(c).to_numpy() for c in ("run", "level"))
                by = np.argsort(runs)
                runs, level = runs[by], level[by]
                common = set(runs[level == 3].tolist())
                keys, ends, _ = page_words([(own[k],) for k in rows])
                starts = np.flatnonzero(np.arange(len(keys)) + LONG <= ends)
                names = window_keys(keys, starts, LONG)
                place = np.minimum(np.searchsorted(runs, names), len(runs) - 1)
                levels = np.zeros(len(keys), np.int64)
                levels[starts] = np.where(runs[place] == names, level[place], 0)
                at = 0
                for k in rows:
                    words = text[k].split(" ")
                    short = np.zeros(len(words), bool)
                    start = 0
                    for block in own[k].split("\n"):
                        end = start + block.count(" ") + 1
                        short[start:end] = not main[k] and is_short(block) and block_key(block) in common
                        start = end
                    mine = levels[at : at + len(words)]
                    at += len(words)
                    if mine.any() or short.any():
                        text[k] = " ".join(without(words, mine, short, 2 if main[k] else 1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(text, pa.string())], ["id", "url", "text"]
            )

    kind = parsed.schema["id"].dataType.simpleString()
    each = parsed.select("id", "url", "site", "main", "own").join(repeated, "site", "left")
    return each.mapInArrow(run, f"id {kind}, url string, text string")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows (id, url, text) for every page.

    Where markup names the article, its blocks are the text, without what is for the site
    (menus, headers, footers, sidebars, notices, adverts, forms, comments); on other pages the
    blocks that are not so marked are. Both are cut by the host's suffix arrays: words covered by a run of LONG words
    that LEAST pages of the host and one in SHARE have, marked or not, are boilerplate; inside a main element COMMON
    pages must have it, so that what few pages quote stays. Outside one, so is a shorter block that COMMON pages and
    every second one have; ``without`` tells what stays on near copies. Blocks are joined by one
    space in page order. Null and empty pages give an empty text, pages without a host are one host, repeated rows
    are pages like any other. Markup is parsed three times, to search, to count and to cut, which takes less than
    to keep all text on disk a second time beside the shuffle.
    """
    parsed = parse(pages, id_col, url_col, html_col)
    sizes = written(pages.groupBy(site(url_col).alias("site")).agg(F.count(F.lit(1)).alias("pages")), "pages-hosts")
    return own_text(parsed, written(repeated_runs(parsed, sizes), "pages-repeated"))
