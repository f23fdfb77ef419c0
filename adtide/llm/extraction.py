"""Main text of web pages by deducing the template of each host.

Tokens (elements by their place, text blocks by place and content) that occur equally often on every
page of a host form an equivalence class. Frequent classes whose tokens keep one order are the
host's template. Tags, roles and class names decide which part of a page is the article; the
template only takes text blocks out of that part. What stands between its tokens is not built into
slots, and the article is not chosen among them.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adtide.sources.files import stage

MIN_PAGES = 3
MIN_SHARE = 0.5
MIN_CLASS = 2
LINK_SHARE = 0.5

# Element kinds of HTML and usual names of page parts.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = set("script style noscript template svg annotation annotation-xml iframe object canvas audio video head title textarea".split())
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td "
    "tfoot th thead tr ul".split()
)
SKIPPED = set("nav aside footer menu dialog button select input label".split())
SKIPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar toolbar".split())
SKIPPED_NAMES = set(
    "ad ads adv advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments consent "
    "cookie cookies copyright disqus footer footers form gdpr login masthead menu menus modal nav navbar navigation "
    "newsletter notice notices pagination pager popup promo promoted promotion related replies reply respond search "
    "share sharing sidebar sidebars signup skip social sponsor sponsored subscribe subscription toolbar topbar widget "
    "widgets ad-banner ad-slot comment-form comment-list comments-area cookie-banner cookie-bar cookie-consent cookie-notice "
    "main-nav menu-bar nav-bar nav-menu related-articles related-posts related-stories share-buttons side-bar site-footer "
    "site-nav skip-link social-links".split()
)
HEADER_NAMES = {"header", "headers", "page-header", "site-header"}
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
CLOSED_BY = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "option": {"option"},
}
LISTS = ("ul", "ol", "dl", "table", "tbody", "select", "menu")
CELLS = ("td", "th", "table", "article", "main", "body")
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*)")
_MARK = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)\s*+=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=/\"'>]+)")
_NAME = re.compile(r"[a-z]+")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)")

#: Parts of a page. NAMED is left out because of a name or a form, OTHER is an article that is marked so or stands there.
PLAIN, ARTICLE, MAIN, SKIP, NAMED, OTHER = range(6)
#: Added to the part of a heading's text.
HEADING = 8


def host_of(url: str | None) -> str:
    found = _HOST.match(url or "")
    return found[1].lower() if found else ""


def _attributes(text: str) -> dict[str, str]:
    return {m[1].lower() if m[1] else m[5].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(text)}


def _role(tag: str, given: dict[str, str], inside: int) -> int:
    """The part of the page that an element opens, given the part that it stands in.

    Names count as whole words of the class or the id only: ``share-price`` is no ``share``.
    """
    if inside == SKIP:
        return SKIP
    role, style = given.get("role", "").lower(), given.get("style", "").replace(" ", "").lower()
    if tag in SKIPPED or role in SKIPPED_ROLES or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in style:
        return SKIP
    names = set(f"{given.get('class', '')} {given.get('id', '')}".lower().split())
    within = inside in (ARTICLE, OTHER)
    if tag == "form" or (tag not in ("html", "body", "main") and names & SKIPPED_NAMES):
        if tag == "article" and inside == PLAIN:
            return OTHER
        return SKIP if within or tag == "article" else NAMED
    if inside == PLAIN and (tag == "header" or (tag != "body" and names & HEADER_NAMES)):
        return NAMED
    article, main = tag == "article" or given.get("itemprop", "").lower() == "articlebody", tag == "main" or role == "main"
    if inside in (NAMED, OTHER):
        return OTHER if article or main else inside
    if article:
        return ARTICLE
    return MAIN if main and not within else inside


def _tag_ends(page: str) -> tuple[list[int], list[int]]:
    """Places of ``>`` and quotes, and for each where a tag that meets it outside quotes ends (-1: nowhere).

    Filled from the page's end, so that unclosed quotes cost no second search.
    """
    marks = [m.start() for m in _MARK.finditer(page)]
    ends = [-1] * (len(marks) + 1)
    following = {"'": -1, '"': -1}
    for i in range(len(marks) - 1, -1, -1):
        sign = page[marks[i]]
        if sign == ">":
            ends[i] = marks[i]
        else:
            if following[sign] >= 0:
                ends[i] = ends[following[sign] + 1]
            following[sign] = i
    return marks, ends


def parse_page(page: str) -> tuple[list[int], list[tuple[int, int, int, int, str]]]:
    """Element tokens in page order, and blocks (tokens before it, own token, part, link chars, text).

    Broken markup never fails: unclosed elements end with their parent, stray ends are ignored,
    an unfinished tag is text. Text before the first or after the last element counts as the body's.
    Elements nest to any depth; the places of open tags are kept by name, so a tag finds its partner
    without a walk over the stack. The time is linear in the page's length, however broken it is.
    A heading's part carries ``HEADING``.
    """
    tokens: list[int] = []
    blocks: list[tuple[int, int, int, int, str]] = []
    stack: list[tuple[str, int, int]] = [("", 0, PLAIN)]  # tag, place, part
    opened: dict[str, list[int]] = {}
    open_blocks: list[int] = [0]
    text: list[str] = []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if text:
            words = entities.unescape("".join(text)).split()
            text.clear()
            if words:
                content = " ".join(words)
                place = stack[-1][1]
                own = xxhash.xxh3_64_intdigest(content.encode("utf-8", "surrogatepass"), place & 0xFFFFFFFF) >> 1
                heading = HEADING if any(opened.get(h) for h in HEADINGS) else 0
                blocks.append((len(tokens), own, stack[-1][2] + heading, min(linked, len(content)), content))
                tokens.append(own)
        linked = 0

    def close(at: int) -> None:
        while len(stack) > at:
            tag = stack.pop()[0]
            opened[tag].pop()
            if tag in BLOCK:
                open_blocks.pop()

    def last(names) -> int:
        """Where the innermost open element of these names stands; 0 without one."""
        return max((opened[n][-1] for n in names if opened.get(n)), default=0)

    def plain(chars: str) -> None:
        nonlocal linked
        text.append(chars)
        if in_link:
            linked += len(chars)

    at, size = 0, len(page)
    marks, ends = _tag_ends(page)
    last_end = page.rfind(">")
    unclosed: set[str] = set()
    while at < size:
        if page[at] != "<":
            start, at = at, page.find("<", at)
            at = size if at < 0 else at
            plain(page[start:at])
            continue
        m = _TAG.match(page, at)
        if m is None:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                at = size if end < 0 else end + 3
            elif page.startswith(("<!", "<?"), at) and last_end > at:
                at = page.index(">", at) + 1
            else:
                plain("<")
                at += 1
            continue
        end = ends[bisect_left(marks, m.end())]
        if end < 0:
            plain("<")
            at += 1
            continue
        tag, given_text, at = m[2], page[m.end() : end], end + 1
        tag = tag.lower()
        if m[1]:
            if tag == "a":
                in_link = 0
            k = last((tag,))
            if tag in BLOCK and k:
                flush()
                close(k)
            elif k > last(CELLS):
                close(k)
            continue
        if tag == "br" or tag == "wbr":
            text.append(" " if tag == "br" else "")
            continue
        if tag in HIDDEN and tag != "head":
            if not given_text.endswith("/") or tag in ("script", "style", "title", "textarea"):
                closing = None if tag in unclosed else re.compile(f"</{re.escape(tag)}(?=[\\s/>])", re.I).search(page, at)
                if closing and last_end >= closing.end():
                    at = page.index(">", closing.end()) + 1
                else:
                    unclosed.add(tag)
                    at = size if tag in ("script", "style") else at
            continue
        if tag in BLOCK:
            flush()
            if stack[-1][0] == "head" and tag != "head":
                close(len(stack) - 1)
            if tag not in ("li", "dd", "dt", "td", "th", "tr", "option"):
                if stack[open_blocks[-1]][0] == "p":  # a block ends an open paragraph
                    close(open_blocks[-1])
            elif tag in CLOSED_BY:
                stop = last(LISTS if tag == "tr" else (*LISTS, "tr"))
                while (k := last(CLOSED_BY[tag])) > stop:
                    close(k)
                    if tag != "tr":
                        break
        if tag in VOID:
            continue
        given = _attributes(given_text) if given_text.strip(" /") else {}
        if tag == "a":
            in_link = 1
        name = f"{tag}.{' '.join(sorted(_NAME.findall(given.get('class', '').lower())))}"
        place = xxhash.xxh3_64_intdigest(name, stack[-1][1] & 0xFFFFFFFF) >> 1
        opened.setdefault(tag, []).append(len(stack))
        if tag in BLOCK:
            open_blocks.append(len(stack))
            tokens.append(place)
        stack.append((tag, place, _role(tag, given, stack[-1][2])))
    flush()
    return tokens, blocks


PARSED = (
    "host string, page binary, tokens binary, at array<int>, own array<bigint>, part array<int>, linked array<int>, "
    "texts array<string>"
)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = {k: [] for k in ("host", "page", "tokens", "at", "own", "part", "linked", "texts")}
        for url, page in zip(batch.column("url").to_pylist(), batch.column("html"), strict=True):
            page = page.as_py() or ""
            tokens, blocks = parse_page(page)
            out["host"].append(host_of(url))
            blob = np.array(tokens, dtype="<i8").tobytes()
            out["page"].append(xxhash.xxh3_128_digest(blob))
            out["tokens"].append(blob)
            for k, v in zip(("at", "own", "part", "linked", "texts"), list(zip(*blocks, strict=True)) or [()] * 5, strict=True):
                out[k].append(list(v))
        kinds = [pa.string(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.string())]
        extra = [c for c in batch.schema.names if c != "html"]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in extra], *[pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)]],
            names=[*extra, *out],
        )


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and token of the batch: pages, and the sum of hashes of (page, times)."""
    for batch in batches:
        pages: dict[tuple[str, int], int] = {}
        sums: dict[tuple[str, int], int] = {}
        for host, page, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            token, times = np.unique(np.frombuffer(blob, dtype="<i8"), return_counts=True)
            seeds = {int(t): xxhash.xxh3_64_intdigest(page, int(t)) for t in np.unique(times)}
            for t, n in zip(token.tolist(), times.tolist(), strict=True):
                key = (host, t)
                pages[key] = pages.get(key, 0) + 1
                sums[key] = (sums.get(key, 0) + seeds[n]) & 0xFFFFFFFFFFFFFFFF
        keys = list(pages)
        signed = [s - (1 << 64) if s >> 63 else s for s in (sums[k] >> 8 for k in keys)]  # 56 bits, so that sums of many tasks fit
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()), pa.array([pages[k] for k in keys], pa.int64()), pa.array(signed, pa.int64())],
            names=["host", "token", "pages", "vector"],
        )


def _orders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per host and class of the batch: least and largest hash of its tokens' order and nesting.

    The root is the host's largest class. A class nests in it if its tokens always stand in the same
    gaps between the root's tokens, so the gap is hashed with each token.
    """
    for batch in batches:
        found: dict[tuple[str, int], tuple[int, int]] = {}
        for host, blob, members, classes in zip(*[batch.column(k).to_pylist() for k in range(4)], strict=True):
            of = dict(zip(members, classes, strict=True))
            sizes = Counter(classes)
            root = min(sizes, key=lambda c: (-sizes[c], c))
            orders: dict[int, dict[int, int]] = {}
            gap = 0
            for t in dict.fromkeys(np.frombuffer(blob, dtype="<i8").tolist()):
                if t in of:
                    gap += of[t] == root
                    orders.setdefault(of[t], {})[t] = gap
            for c, places in orders.items():
                h = xxhash.xxh3_64_intdigest(np.array(list(places.items()), dtype="<i8").tobytes()) >> 1
                lo, hi = found.get((host, c), (h, h))
                found[host, c] = (min(lo, h), max(hi, h))
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in found], pa.string()), pa.array([k[1] for k in found], pa.int64()), pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
            names=["host", "class", "low", "high"],
        )


def host_templates(parsed: DataFrame) -> DataFrame:
    """``host, members``: the template tokens of each host, one row per host.

    Pages of a host with the same tokens in the same order are copies and count as one page. Every
    task sums the occurrence vectors of its pages first, so a host of any size is spread; what is
    left per host is bounded by the tokens that at least half of its pages have.
    """
    per_host = parsed.select("host", "page").distinct().groupBy("host").agg(F.count("*").alias("host_pages"))
    vectors = (
        parsed.select("host", "page", "tokens").dropDuplicates(["host", "page"]).mapInArrow(_occurrences, "host string, token bigint, pages bigint, vector bigint")
        .groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"))
    )
    frequent = vectors.join(stage(per_host, "host_pages"), "host").where(
        (F.col("pages") >= MIN_PAGES) & (F.col("pages") >= MIN_SHARE * F.col("host_pages"))
    )
    classes = frequent.withColumn("class", F.xxhash64("vector", "pages"))
    members = stage(
        classes.groupBy("host", "class").agg(
            F.collect_list("token").alias("tokens")
        ).where(F.size("tokens") >= MIN_CLASS),
        "classes",
    )
    flat = members.select("host", "class", F.explode("tokens").alias("token"))
    maps = stage(
        flat.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("m")).select(
            "host", F.col("m.token").alias("members"), F.col("m.class").alias("classes")
        ),
        "class_maps",
    )
    orders = (
        parsed.select("host", "tokens").join(maps, "host").select("host", "tokens", "members", "classes")
        .mapInArrow(_orders, "host string, class bigint, low bigint, high bigint")
        .groupBy("host", "class").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    )
    valid = orders.where("low = high").select("host", "class")
    return stage(
        members.join(valid, ["host", "class"]).select("host", F.explode("tokens").alias("token"))
        .groupBy("host").agg(F.collect_list("token").alias("members")),
        "templates",
    )


def page_text(blocks: list[tuple[int, int, int, str]], template: set[int]) -> str:
    """Join the texts of the blocks (own token, part, link chars, text) of the page's article that are
    not template, in any part of the page and at any host size.

    The article is the article element's part, else main's, else an article in an element that is
    left out by its name, else whatever is no skipped part; in the last case blocks that are mostly
    links go too. A heading that is template stays in an article, and elsewhere between two blocks
    that stay.
    """
    parts = {part & 7 for _, part, _, _ in blocks}
    wanted = next((p for p in (ARTICLE, MAIN, OTHER) if p in parts), PLAIN)
    out: list[str] = []
    waiting: list[str] = []  # template headings since the last block that stays
    for own, part, linked, text in blocks:
        if part & 7 != wanted or (wanted == PLAIN and linked > LINK_SHARE * len(text)):
            continue
        if own not in template or (part & HEADING and wanted != PLAIN):
            out += [*waiting, text] if out else [text]
            waiting = []
        elif part & HEADING:
            waiting.append(text)
    return "\n".join(out)


def _extract(id_name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = ["own", "part", "linked", "texts", "members"]
            for own, part, linked, texts, members in zip(*[batch.column(c).to_pylist() for c in columns], strict=True):
                out.append(page_text(list(zip(own, part, linked, texts, strict=True)), set(members or ())))
            yield pa.RecordBatch.from_arrays(
                [batch.column(id_name), batch.column("url"), pa.array(out, pa.string()), pa.array(list(map(len, out)), pa.int64())],
                names=[id_name, "url", "text", "n_chars"],
            )

    return run


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``.

    Null or empty bodies and pages without an article text give the empty text. Pages without a
    valid address share the empty host. Hosts with fewer than ``MIN_PAGES`` pages have no template.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(body_col).cast("string").alias("html"))
    kind = rows.schema["page_id"].dataType.simpleString()
    parsed = stage(rows.mapInArrow(_parse, f"page_id {kind}, url string, {PARSED}"), "parsed_pages")
    joined = parsed.select("page_id", "url", "host", "own", "part", "linked", "texts").join(host_templates(parsed), "host", "left")
    return joined.drop("host").mapInArrow(_extract("page_id"), f"page_id {kind}, url string, text string, n_chars bigint").withColumnRenamed("page_id", id_col)
