"""Main text of web pages by nearest-URL differencing.

A page becomes lines (one for each block of text) with a zone: inside the article, elsewhere, or furniture (menus, headers,
footers, sidebars, notices, adverts, forms, comments), told by tags, roles and class names. Pages of a host are ordered by URL path;
each is aligned with its nearest different neighbour by a longest common subsequence of their lines, and shared lines are
deleted. Lines inside the article are kept even if the neighbour has them (a passage that two articles share is text of both),
unless more than half of the host's pages repeat them.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from functools import partial
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociq.llm.common import join_checked, pick, small_batches, stored

#: WIDE: inside the article, but repeated by more than half of the host's pages, of which there are WIDE_PAGES at least.
ARTICLE, OTHER, FURNITURE, WIDE = 0, 1, 2, 3
WIDE_PAGES = 5
#: Pages that share so much of their text outside of furniture are copies, which tell nothing about each other's template.
COPY = 0.95
#: Pages that a range has at least on average.
RANGE = 256

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
# HTML's element kinds, and words that name furniture in classes, ids and roles.
_RAW = {"script", "style", "noscript", "template", "iframe", "textarea", "title", "svg", "math", "object", "canvas", "audio", "video", "select"}
_SIDE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "head", "fieldset"}
_BLOCK = set("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_SIDE_WORDS = set(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist consent cookie cookies disqus footer gdpr login masthead menu modal nav navbar "
    "navigation newsletter notice notices outbrain overlay pagination pager popup promo promoted promotion recommended related reply replies respond search share sharing sidebar signup skip social "
    "sponsor sponsored subscribe subscription taboola toolbar topbar widget widgets complementary contentinfo alert alertdialog".split()
)
#: Parts of a name that say nothing, so that `site-footer` and `comment-list` are furniture and `share-price` and `ad-hoc` are not.
_NEUTRAL = set("site page main global primary secondary top bottom left right inner outer wrap wrapper container box block area section bar list item items link links button buttons slot unit js".split())
_SPACE = re.compile(r"\s+")


def _names_furniture(name: str, zone: int) -> bool:
    """Whether a class, id or role says furniture by all its parts that say anything."""
    parts = {w for w in re.split(r"[^a-z]+", re.sub(r"([a-z])([A-Z])", r"\1-\2", name).lower()) if w and w not in _NEUTRAL}
    return bool(parts) and parts <= (_SIDE_WORDS if zone == ARTICLE else _SIDE_WORDS | {"header"})


def page_lines(page: str) -> list[tuple[str, int]]:
    """(text, zone) of each block of a page, in page order; nothing is cut off or left out but markup and raw elements."""
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    stack: list[tuple[str, int]] = []  # open elements with their zone
    at = 0

    def zone() -> int:
        return stack[-1][1] if stack else OTHER

    def flush() -> None:
        text = _SPACE.sub(" ", html.unescape("".join(held))).strip()
        held.clear()
        if text:
            lines.append((text, zone()))

    while True:
        m = _TOKEN.search(page, at)
        held.append(page[at : m.start()] if m else page[at:])
        if m is None:
            break
        at = m.end()
        if m[1] is not None:
            held.append(m[1])
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            if tag in _BLOCK:
                flush()
            elif tag in ("td", "th"):
                held.append(" ")
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
                if tag not in _BLOCK and stack[k][0] in _BLOCK:
                    break  # an inline end tag does not close a block
            continue
        if tag in _RAW:
            if not m[4].rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page) if tag in ("script", "style") else at
            continue
        if tag == "br" or tag in ("td", "th"):
            held.append(" ")
        if tag in _BLOCK:
            flush()
            for k in range(len(stack) - 1, -1, -1):  # ends that HTML implies
                if stack[k][0] in _CLOSES.get(tag, ()) or stack[k][0] == "p":
                    del stack[k:]
                    break
                if stack[k][0] in _BLOCK:
                    break
        if tag in _VOID or m[4].rstrip().endswith("/") and tag not in _BLOCK:
            continue
        here = zone()
        if here != FURNITURE:
            if tag in _SIDE or (tag == "header" and here != ARTICLE):
                here = FURNITURE
            elif m[4] and tag not in ("html", "body", "article", "main"):
                if any(_names_furniture(name, here) for v in _NAMES.findall(m[4]) for name in v.strip("\"'").split()):
                    here = FURNITURE
            if here == OTHER and (tag in ("article", "main") or re.search(r"\b(?:role|itemprop)\s*=\s*[\"']?(?:main|article|articleBody)\b", m[4], re.I)):
                here = ARTICLE
        stack.append((tag, here))
    flush()
    return lines


def shared_lines(mine: list[str], other: list[str]) -> set[int]:
    """Positions of mine in a longest common subsequence with other (by the equal pairs' longest increasing run)."""
    where: dict[str, list[int]] = defaultdict(list)
    for j, x in enumerate(other):
        where[x].append(j)
    tails: list[int] = []
    ends: list[int] = []  # node of each tail
    nodes: list[tuple[int, int]] = []  # (position in mine, node before)
    for i, x in enumerate(mine):
        for j in reversed(where.get(x, ())):
            k = bisect_left(tails, j)
            nodes.append((i, ends[k - 1] if k else -1))
            if k == len(tails):
                tails.append(j)
                ends.append(len(nodes) - 1)
            else:
                tails[k], ends[k] = j, len(nodes) - 1
    out: set[int] = set()
    n = ends[-1] if ends else -1
    while n >= 0:
        out.add(nodes[n][0])
        n = nodes[n][1]
    return out


def body(lines: list[tuple[str, int]]) -> int:
    """Characters outside of furniture."""
    return sum(len(x) for x, z in lines if z != FURNITURE)


def is_copy(lines: list[tuple[str, int]], other: list[tuple[str, int]]) -> bool:
    """Whether two pages share nearly all of their text outside of furniture."""
    return _alike(*([(x, len(x)) for x, z in p if z != FURNITURE] for p in (lines, other)))


def _alike(mine: list[tuple], theirs: list[tuple]) -> bool:
    """is_copy for the lines outside of furniture, each as what tells it from others, and its characters."""
    common = lambda: sum(mine[k][1] for k in shared_lines([x for x, _ in mine], [x for x, _ in theirs]))
    return mine == theirs or common() >= COPY * max(sum(n for _, n in p) for p in (mine, theirs))


def main_text(lines: list[tuple[str, int]], neighbour: list[tuple[str, int]] | None) -> str:
    """The lines that differencing and zones leave. The neighbour is a page that is no copy; without one the article's lines, or
    without an article all that are no furniture."""
    if neighbour is None:
        inside = any(z in (ARTICLE, WIDE) for _, z in lines)
        return "\n\n".join(x for x, z in lines if (z in (ARTICLE, WIDE) if inside else z == OTHER))
    # differencing first; of what it leaves, and of the article's lines that it takes, zones have the second vote
    gone = shared_lines([x for x, _ in lines], [x for x, _ in neighbour])
    return "\n\n".join(x for k, (x, z) in enumerate(lines) if z == ARTICLE or (z != FURNITURE and k not in gone))


def _line_hash(host: str, line: str) -> int:
    return int.from_bytes(blake2b(f"{host}\0{line}".encode("utf-8", "replace"), digest_size=8).digest(), "little", signed=True)


def _article_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, lines = [], []
        for host, page in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            found = {_line_hash(host, x) for x, z in page_lines(page or "") if z == ARTICLE}
            hosts += [host] * len(found)
            lines += found
        yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(lines, pa.int64())], names=["host", "line"])


def _place(host: str, path: str, page_id: int | None) -> tuple:
    return host, path, page_id is not None, page_id or 0


def _digest(lines: list[tuple[str, int]]) -> str:
    return blake2b(repr(lines).encode("utf-8", "replace"), digest_size=16).hexdigest()


def _range_of(starts: list[tuple], key: tuple) -> int:
    return max(0, bisect_right(starts, key) - 1)


def _bodies(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Of each page with text outside of furniture its range, digest, and the hashes and sizes of those lines, for hosts that more than one range has."""
    starts = model.value
    for batch in batches:
        take, part, digest, hashes, sizes = [], [], [], [], []
        for k, (host, path, page_id, page) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "path", "page_id", "html")), strict=True)):
            at = _range_of(starts, _place(host, path, page_id))
            if not (at and starts[at][0] == host or at + 1 < len(starts) and starts[at + 1][0] == host):
                continue
            found = page_lines(page or "")
            if body(found):
                take.append(k)
                part.append(at)
                digest.append(_digest(found))
                hashes.append([_line_hash("", x) for x, z in found if z != FURNITURE])
                sizes.append([len(x) for x, z in found if z != FURNITURE])
        rows = batch.select(["host", "path", "page_id"]).take(pa.array(take, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(part, pa.int32()), pa.array(digest, pa.string()), pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32()))],
            names=["host", "path", "page_id", "part", "digest", "hashes", "sizes"],
        )


_KEY = pa.struct([("path", pa.string()), ("page_id", pa.int64()), ("digest", pa.string())])
_LINES = pa.list_(pa.struct([("line", pa.int64()), ("size", pa.int32())]))
_CHAIN = pa.schema([("part", pa.int32()), ("host", pa.string()), *[(c, _KEY) for c in ("first", "last", "before", "second")], ("head", _LINES), ("tail", _LINES)])
_CHAIN_TYPE = "part int, host string, " + ", ".join(f"{c} struct<path: string, page_id: bigint, digest: string>" for c in ("first", "last", "before", "second")) + ", head array<struct<line: bigint, size: int>>, tail array<struct<line: bigint, size: int>>"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each range and host, of rows that come ordered: the first and the last page with their lines, the last page before the last run of
    copies and the first one of the second run (null if there is one run)."""
    now: dict | None = None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            key, lines = {c: r[c] for c in ("path", "page_id", "digest")}, list(zip(r["hashes"], r["sizes"], strict=True))
            if now is None or (now["part"], now["host"]) != (r["part"], r["host"]):
                out += [now] if now else []
                now = {"part": r["part"], "host": r["host"], "first": key, "before": None, "second": None, "head": lines}
            elif not _alike(lines, now["tail"]):
                now |= {"before": now["last"], "second": now["second"] or key}
            now |= {"last": key, "tail": lines}
        yield _chain(out)
    yield _chain([now] if now else [])


def _chain(out: list[dict]) -> pa.RecordBatch:
    lists = {c: [[{"line": x, "size": n} for x, n in r[c]] for r in out] for c in ("head", "tail")}
    return pa.RecordBatch.from_arrays([pa.array(lists.get(f.name) or [r[f.name] for r in out], f.type) for f in _CHAIN], schema=_CHAIN)


def _goes_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether the first page of a range is a copy of the host's last page in a range before."""
    for batch in batches:
        pair = [[[(x["line"], x["size"]) for x in p] if p is not None else None for p in batch.column(c).to_pylist()] for c in ("head", "ended")]
        found = [e is not None and _alike(h, e) for h, e in zip(*pair, strict=True)]
        names = [f.name for f in _CHAIN if f.type != _LINES]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(found, pa.bool_())], names=[*names, "goes_on"])


def _neighbours_elsewhere(chain: list) -> dict[tuple, list[tuple[int, int]]]:
    """(host, path, page_id, digest) of the pages that a range needs from other ones, with these ranges and -1 or 1: the different page before the
    run of copies that the range begins in, or, if there is none and the range is within that run, the different page after it.

    chain has the rows of _goes_on; a host has one for each of its ranges.
    """
    need: dict[tuple, list[tuple[int, int]]] = defaultdict(list)
    hosts: dict[str, list] = defaultdict(list)
    for r in sorted(chain, key=lambda r: r["part"]):
        hosts[r["host"]].append(r)
    for host, ranges in hosts.items():
        found, page = [], None
        for k, r in enumerate(ranges):
            if k:
                page = (ranges[k - 1]["before"] or page) if r["goes_on"] else ranges[k - 1]["last"]
            found.append(page)
            if page:
                need[host, *page].append((r["part"], -1))
        page = None
        for k in reversed(range(len(ranges))):
            if k + 1 < len(ranges):
                page = (ranges[k + 1]["second"] or page) if ranges[k + 1]["goes_on"] else ranges[k + 1]["first"]
            if page and not found[k] and not ranges[k]["second"]:
                need[host, *page].append((ranges[k]["part"], 1))
    return dict(need)


def _cut(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    """Lines and zones of each page, with its range; a page also goes to the ranges that need it from here (turn is -1 or 1 there)."""
    starts, need = model.value
    hosts = {key[0] for key in need}
    for batch in batches:
        take, part, turn, digests, lines, zones = [], [], [], [], [], []
        for k, (host, path, page_id, page, wide) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("host", "path", "page_id", "html", "wide")), strict=True)):
            found, wide = page_lines(page or ""), set(wide or ())
            digest = _digest(found)
            elsewhere = need.get((host, path, page_id, digest), []) if host in hosts else []
            for p, side in ((_range_of(starts, _place(host, path, page_id)), 0), *elsewhere):
                take.append(k)
                part.append(p)
                turn.append(side)
                digests.append(digest)
                lines.append([x for x, _ in found])
                zones.append([WIDE if wide and z == ARTICLE and _line_hash(host, x) in wide else z for x, z in found])
        rows = batch.select(["page_id", "url", "host", "path"]).take(pa.array(take, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*rows.columns, pa.array(part, pa.int32()), pa.array(turn, pa.int8()), pa.array(digests, pa.string()), pa.array(lines, pa.list_(pa.string())), pa.array(zones, pa.list_(pa.int8()))],
            names=["page_id", "url", "host", "path", "part", "turn", "digest", "lines", "zones"],
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered; a page's neighbour is the last one before it on its host that is no copy of it, or else the next one."""
    out: list[tuple] = []
    waiting: list[tuple] = []  # pages with no different one before them
    group = last = before = None  # last: the page before; before: the last one that is no copy of it

    def done(row: tuple, other: list | None) -> None:
        page_id, url, lines = row
        text = main_text(lines, other)
        out.append((page_id, url, text, len(text)))

    for batch in batches:
        for r in batch.to_pylist():
            if group != (r["part"], r["host"]):
                for w in waiting:
                    done(w, None)
                waiting, last, before, group = [], None, None, (r["part"], r["host"])
            lines = list(zip(r["lines"], r["zones"], strict=True))
            if r["turn"] < 0:
                before = lines
                continue
            if r["turn"] > 0:
                for w in waiting:
                    done(w, lines)
                waiting = []
                continue
            row = (r["page_id"], r["url"], last if lines == last else lines)
            if not body(lines):
                done(row, None)
                continue
            if last is not None and not is_copy(lines, last):
                for w in waiting:
                    done(w, lines)
                waiting, before = [], last
            if before is None:
                waiting.append(row)
            else:
                done(row, before)
            last = row[2]
        yield _rows(out)
        out.clear()
    for w in waiting:
        done(w, None)
    yield _rows(out)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    schema = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)


def _wide_lines(rows: DataFrame) -> DataFrame:
    """host, wide: hashes (host and line) of the article lines that are on more than half of the host's pages; hosts without one are left out."""
    pages = rows.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= WIDE_PAGES)
    counts = rows.select("host", "html").mapInArrow(_article_lines, "host string, line long").groupBy("line").agg(F.min("host").alias("host"), F.count(F.lit(1)).alias("n"))
    wide = counts.where("n > 1").join(pages, "host").where(2 * F.col("n") > F.col("pages"))
    return wide.groupBy("host").agg(F.collect_list("line").alias("wide"))  # no more than twice the lines of a page


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages.

    A null html is empty and gives an empty text. Pages without a URL, or whose URL has no host, form one host. The neighbour is
    deterministic up to rows that agree in host, path, page_id and html: runs of copies are followed across the ends of ranges, however
    many ranges they fill. A page without a different one on its host is compared with none. Repeated rows are handled each; an empty table gives an empty result;
    other columns are ignored.

    Pages are dealt by ranges of host, path and page_id, so no task holds a host. A first pass over hashes of lines tells for each range which pages of other ranges its
    ends need (two at most), and these are sent there too.
    """
    spark = pages.sparkSession
    small_batches(spark)
    rows = pick(pages, page_id="long", url="string", html="string")
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(F.coalesce("url", F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^#]*)", 1)
    rows = rows.withColumn("host", host).withColumn("path", path)
    keys = ["host", "path", "page_id"]
    n = min(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), rows.select("page_id").count() // RANGE + 1)
    dealt = rows.select(keys).repartitionByRange(n, *keys).withColumn("part", F.spark_partition_id())
    starts = sorted(_place(*r[1]) for r in dealt.groupBy("part").agg(F.min(F.struct(*keys))).collect())
    need = _neighbours_elsewhere(_chains(rows, starts)) if len(starts) > 1 else {}
    model = spark.sparkContext.broadcast((starts, need))
    cut = join_checked(rows, stored(_wide_lines(rows), "wide-lines"), "host", "left").mapInArrow(partial(_cut, model=model), "page_id long, url string, host string, path string, part int, turn byte, digest string, lines array<string>, zones array<byte>")
    near = cut.repartitionById(max(1, len(starts)), F.col("part")).sortWithinPartitions("part", "host", "turn", "path", "page_id", "digest")
    return near.mapInArrow(_compare, "page_id long, url string, text string, n_chars long")


def _chains(rows: DataFrame, starts: list[tuple]) -> list:
    """The rows of _goes_on: a range has two hosts at most that other ranges have too."""
    model = rows.sparkSession.sparkContext.broadcast(starts)
    bodies = rows.mapInArrow(partial(_bodies, model=model), "host string, path string, page_id long, part int, digest string, hashes array<long>, sizes array<int>")
    near = bodies.repartitionById(len(starts), F.col("part")).sortWithinPartitions("part", "host", "path", "page_id", "digest")
    runs = near.mapInArrow(_runs, _CHAIN_TYPE).withColumn("ended", F.lag("tail").over(Window.partitionBy("host").orderBy("part")))
    return runs.mapInArrow(_goes_on, _CHAIN_TYPE.split(", head")[0] + ", goes_on boolean").collect()
