"""HTML extraction by differencing each page with the page of the nearest URL.

``parse`` turns a page into text blocks and knows which of them the markup marks
as the article (inside ``article`` or ``main``, see ``parse``) and which it marks as
furniture (menus, headers, footers, sidebars, notices, adverts, forms, comments,
by element, role, class or id, or a part of these such as comment-list), which go.  Every
page then goes through the differencing: within a host, pages are ordered by URL path, each is paired with
the nearest one before it, else after it, that is no near copy, the two pages'
lines are aligned by a longest common subsequence, and lines that both have are
the site's.  The lines that are the page's own decide: they choose between ``article``
and ``main``, an ``article`` without any (a teaser, a notice) goes if another has some, and
outside a marked article every line of the site goes (``decided``).  A page
with only near copies in its host keeps all its lines.  Lines inside an article that has lines of its own
stay, the shared ones too: articles quote one another.  An element that holds an
article, main part or headline is no furniture, whatever its class; only comments
and related articles after the page's own are.

Pairs are found by a range sort of (host, path), so a host of any size spreads
over tasks; runs of near copies across the borders of tasks are settled from the
first and last runs of each.  Only line hashes and lengths travel there, not pages.

Null html counts as empty and gives an empty text; a null URL belongs to the
host of the empty name.  Repeated rows of one URL are near copies of each
other; an empty table gives an empty one.  Unclosed elements end with the page, unclosed furniture at
the next article or heading; a tag with an unclosed quote ends at its first >.
Very long pages are whole: the alignment's memory is in proportion to their lines.
Other columns are not looked at, whatever their names; one named ``text`` gives way.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

# HTML element names by their part in a page.
RAW = {"script", "style", "noscript", "template", "svg", "math", "iframe", "object", "title", "textarea", "xmp", "noembed"}
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "select", "head", *RAW}
BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
# Whole words of a class, id or role that mark furniture.
_MARKED = re.compile(
    r"(?:^|\s)(?:ads?|advert\w*|sponsor\w*|promo\w*|cookie\w*|consent|gdpr|notice|alert|banner|sidebar|side-?bar|widget|menu|nav|navbar|navigation|"
    r"bread-?crumbs?|footer|header|masthead|comments?|replies|disqus|newsletter|subscribe|signup|social|share|sharing|related|recommended|"
    r"popup|modal|pagination|pager|skip-?link|contentinfo|complementary|search)(?:$|\s)",
    re.I,
)
# Parts of a name (comment-list, article__newsletter-signup) that mark furniture, and parts that make such a name one of the page's layout or state.
_PART = re.compile(
    r"ads?|advert\w*|sponsor\w*|promo\w*|cookies?|consent|gdpr|comments?|replies|disqus|newsletter|subscribe|signup|social|share|sharing|"
    r"related|recommended|breadcrumbs?|popup|modal|pagination|sidebar|navbar|navigation|widgets?",
    re.I,
)
_LAYOUT = set("has no not is with without category tag format content layout page main enabled disabled open closed active".split())
# Names that hold articles of others, once the page's own is read.
_OTHERS = re.compile(r"(?:^|[\s_-])(?:comments?|replies|disqus|related|recommended)(?:$|[\s_-])", re.I)
_NAMED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""\shidden(?=[\s=/>]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
#: Pages that share this much of the text of one of them are near copies, which say nothing about furniture.
NEAR_COPY = 0.9
# A tag's end is the first > outside quotes, or the first at all if a quote is never closed.
_TOKEN = re.compile(r"""<!--.*?(?:-->|$)|<[!?][^>]*(?:>|$)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*(?=>)|[^>]*)>""", re.S)


def _is_furniture(name: str, attributes: str, in_article: bool) -> bool:
    if name in FURNITURE or (name == "header" and not in_article):
        return True
    if name in ("body", "html", "main") or not attributes:
        return False
    if _HIDDEN.search(attributes):
        return True
    if name == "article" and not in_article:
        return False
    return any(_MARKED.search(m) or any(map(_is_marked_name, m.split())) for m in _marks(attributes))


def _is_marked_name(name: str) -> bool:
    parts = re.split("[-_]+", name.lower())
    return len(parts) > 1 and any(map(_PART.fullmatch, parts)) and _LAYOUT.isdisjoint(parts)


def _marks(attributes: str) -> list[str]:
    return [a or b or c for a, b, c in _NAMED.findall(attributes)]


def _raw_end(lower: str, name: str, pos: int) -> int:
    """Where the text of a raw element ends that begins at ``pos``, behind its closing tag."""
    stop = lower.find("</" + name, pos)
    close = lower.find(">", stop) if stop >= 0 else -1
    return pos if stop < 0 else close + 1 if close >= 0 else len(lower)


def _held(page: str) -> dict[int, tuple[int, int]]:
    """Of each element, by the place behind its opening tag: how many ``article``, and how many ``main`` and ``h1`` it has inside."""
    out: dict[int, tuple[int, int]] = {}
    open_: dict[str, list] = {}
    lower, pos, articles, others = None, 0, 0, 0
    while (m := _TOKEN.search(page, pos)) is not None:
        pos = m.end()
        name = (m.group(2) or "").lower()
        if not name or name in VOID:
            continue
        if m.group(1):
            if open_.get(name):
                at, a, o = open_[name].pop()
                out[at] = (articles - a, others - o)
            continue
        if name in RAW:
            lower = page.lower() if lower is None else lower
            pos = _raw_end(lower, name, pos)
            continue
        articles += name == "article"
        others += name in ("main", "h1")
        if not m.group(3).endswith("/"):
            open_.setdefault(name, []).append((m.end(), articles, others))
    for rest in open_.values():  # never closed
        out.update({at: (articles - a, others - o) for at, a, o in rest})
    return out


def parse(page: str | None) -> tuple[list[str], str]:
    """Text blocks in page order, and what they are: those of an ``article``, of ``main``, or of the whole ``page``.

    Articles inside ``main`` go before others; ``main`` goes before articles that
    are all outside it and have less text, as teasers do.
    """
    return _chosen(all_blocks(page))


def _chosen(blocks: list[tuple[str, int, bool]], shared: Collection[int] = ()) -> tuple[list[str], str]:
    own = [0 if i in shared else len(b[0]) for i, b in enumerate(blocks)]
    inner = [i for i, b in enumerate(blocks) if b[1] and b[2]]
    articles = inner or [i for i, b in enumerate(blocks) if b[1]]
    main = [i for i, b in enumerate(blocks) if b[2]]
    kind = "main" if main else "page"
    if articles and (inner or sum(own[i] for i in articles) >= sum(own[i] for i in main)):
        with_own = {blocks[i][1] for i in articles if own[i]}
        at, kind = [i for i in articles if not with_own or blocks[i][1] in with_own], "article"
    else:
        at = [i for i in main or range(len(blocks)) if i not in shared]
    return [blocks[i][0] for i in at], kind


def decided(page: str | None, shared: Collection[int] | None) -> list[str]:
    """The page's text blocks, given the places of those that it shares with its neighbour."""
    return _chosen(all_blocks(page), frozenset(shared or ()))[0]


def all_blocks(page: str | None) -> list[tuple[str, int, bool]]:
    """All text blocks but furniture, in page order: (line, number of the outermost article it is in or 0, in main)."""
    page = page or ""
    blocks: list[tuple[str, int, bool]] = []
    text: list[str] = []
    article = main = 0  # open elements
    outermost = 0  # articles that have begun outside others
    skip, depth, at = "", 0, 0  # furniture that is being passed over, and how often it is open

    def end_block() -> None:
        line = " ".join(entities.unescape("".join(text)).split())
        if line:
            blocks.append((line, outermost if article else 0, main > 0))
        text.clear()

    lower = held = None
    read = 0  # articles that have begun

    def is_own(m: re.Match, name: str) -> bool:
        """Whether an element marked as furniture holds the page's article, main part or headline."""
        nonlocal held
        held = _held(page) if held is None else held
        articles, others = held.get(m.end(), (0, 0))
        if read and not others and any(_OTHERS.search(x) for x in _marks(m.group(3))):
            return False
        return articles + others > 0

    pos = 0
    while True:
        m = _TOKEN.search(page, pos)
        if not skip:
            text.append(page[pos : m.start() if m else len(page)])
        if m is None:
            break
        pos = m.end()
        name = m.group(2)
        if name is None:  # a comment or declaration
            continue
        name = name.lower()
        closing = bool(m.group(1))
        if skip:
            if name == skip:
                depth += -1 if closing else (0 if m.group(3).endswith("/") else 1)
                if not depth:
                    skip = ""
            elif at < 0 and not closing and name in ("article", "main", "h1"):
                skip = ""  # the furniture was never closed
            if skip or closing:
                continue
        if closing:
            if name in BLOCK:
                end_block()
            article -= name == "article" and article > 0
            main -= name == "main" and main > 0
            continue
        if name in RAW:
            end_block() if name != "title" else None
            lower = page.lower() if lower is None else lower
            pos = _raw_end(lower, name, pos)
            continue
        if name not in VOID and not m.group(3).endswith("/") and _is_furniture(name, m.group(3), article > 0) and not is_own(m, name):
            end_block()
            skip, depth = name, 1
            lower = page.lower() if lower is None else lower
            at = lower.find("</" + name, pos)
            continue
        if name == "br":
            text.append(" ")
        elif name in BLOCK:
            end_block()
            outermost += name == "article" and not article
            article += name == "article"
            read += name == "article"
            main += name == "main" or 'role="main"' in m.group(3)
    end_block()
    return blocks


# -- differencing --------------------------------------------------------------


def common_lines(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence of ``a`` and ``b`` (Hirschberg: memory in proportion to the lines)."""

    def row(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        r = np.zeros(len(y) + 1, np.int64)
        for v in x:
            r[1:] = np.maximum.accumulate(np.maximum(r[1:], (r[:-1] + 1) * (y == v)))
        return r

    out: list[int] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            out.append(a0)
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            out.append(a1 - 1)
            a1, b1 = a1 - 1, b1 - 1
        if a0 >= a1 or b0 >= b1:
            continue
        if a1 - a0 == 1:
            if (b[b0:b1] == a[a0]).any():
                out.append(a0)
            continue
        mid = (a0 + a1) // 2
        ahead = row(a[a0:mid], b[b0:b1]) + row(a[mid:a1][::-1], b[b0:b1][::-1])[::-1]
        cut = b0 + int(ahead.argmax())
        todo += [(a0, mid, b0, cut), (mid, a1, cut, b1)]
    return sorted(out)


_URL = re.compile(r"^(?:[a-zA-Z][\w+.-]*:)?//([^/?#]*)([^?#]*)")


def host_and_path(url: str | None) -> tuple[str, str]:
    m = _URL.match(url or "")
    return (m.group(1).lower(), m.group(2)) if m else ("", (url or "").split("?")[0].split("#")[0])


class _Page:
    def __init__(self, r: dict):
        self.rid, self.host, self.path = r["rid"], r["host"], r["path"]
        self.raw, self.edge = r["lines"], r.get("edge")
        self.lines, self.chars = np.frombuffer(r["lines"], np.int64).reshape(2, -1)
        self.total = int(self.chars.sum())

    def shared_with(self, other: _Page) -> list[int] | None:
        """Places of the lines that ``other`` has too; none if one page is nearly all in the other, as copies are."""
        if self.raw == other.raw:
            return None
        at = common_lines(self.lines, other.lines)
        return None if self.chars[at].sum() >= NEAR_COPY * min(self.total, other.total) else at


_PAIR_SCHEMA = "rid binary, drop array<int>, host string, path string, lines binary, waits binary, edge string"


def _emit(rows: list[dict]) -> pa.RecordBatch:
    kinds = {"rid": pa.binary(), "drop": pa.list_(pa.int32()), "host": pa.string(), "path": pa.string(), "lines": pa.binary(), "waits": pa.binary(), "edge": pa.string()}
    return pa.RecordBatch.from_arrays([pa.array([r.get(c) for r in rows], k) for c, k in kinds.items()], names=list(kinds))


class _Host:
    """The pages of a host in a task, in order, as runs of near copies; a run is known by its longest page.

    ``opens``: the host is its task's first, so that pages before these may be in another task.
    """

    def __init__(self, name: str, opens: bool):
        self.name, self.opens = name, opens
        self.before: _Page | None = None  # the run before
        self.run: _Page | None = None
        self.waiting: list[_Page] = []  # pages with no distinct one before, all of the first run
        self.first: list[_Page] = []  # the first two runs

    def add(self, page: _Page) -> list[dict]:
        rows, shared = [], None
        if self.run is None:
            self.run = page
        elif (shared := page.shared_with(self.run)) is None:
            self.run = page if page.total > self.run.total else self.run
        else:
            self._note()
            if not self.opens:
                rows = [{"rid": p.rid, "drop": p.shared_with(page)} for p in self.waiting]
                self.waiting = []
            self.before, self.run = self.run, page
        if self.before is None:
            self.waiting.append(page)
        else:
            rows.append({"rid": page.rid, "drop": page.shared_with(self.before) if shared is None else shared})
        return rows

    def _note(self) -> None:
        if len(self.first) < 2:
            self.first.append(self.run)

    def edges(self) -> list[dict]:
        """The first and last two runs, and the pages that still wait, for the tasks before and after."""
        self._note()
        runs = {p.rid: p for p in [*self.first, *([self.before] if self.before else []), self.run]}
        waits = self.first[0].rid if self.waiting else None
        rows = [
            {"rid": p.rid, "host": p.host, "path": p.path, "lines": p.raw, "edge": "waits" if p.rid == waits else "run"} for p in runs.values()
        ]
        return rows + [{"rid": p.rid, "host": p.host, "path": p.path, "lines": p.raw, "waits": waits} for p in self.waiting]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order: each page's lines shared with the nearest distinct page before it, else after it, of its host.

    Of a task's first and last host there is also what the tasks beside it need.
    """
    host: _Host | None = None
    first = True
    for b in batches:
        rows = []
        for r in b.to_pylist():
            if host is None or host.name != r["host"]:
                if host is not None and first:
                    rows += host.edges()
                first = host is None
                host = _Host(r["host"], first)
            rows += host.add(_Page(r))
        if rows:
            yield _emit(rows)
    if host is not None:
        yield _emit(host.edges())


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tasks' first and last runs in order: for one that found no distinct page in its task, the nearest in others."""

    def found(pages: list[_Page]) -> list[dict]:
        rows = []
        for i, p in enumerate(pages):
            known = {p.raw}
            for q in [*pages[:i][::-1], *pages[i + 1 :]] if p.edge == "waits" else []:
                if q.raw not in known and p.shared_with(q) is not None:
                    rows.append({"waits": p.rid, "lines": q.raw})
                    break
                known.add(q.raw)
        return rows

    pages: list[_Page] = []
    for b in batches:
        for r in b.to_pylist():
            page = _Page(r)
            if pages and pages[-1].host != page.host:
                yield _emit(found(pages))
                pages = []
            pages.append(page)
    yield _emit(found(pages))


def _late(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pages that waited, with the page found for them."""
    for b in batches:
        rows = []
        for r in b.to_pylist():
            other = _Page({**r, "lines": r["other"]})
            rows.append({"rid": r["rid"], "drop": _Page(r).shared_with(other)})
        yield _emit(rows)


def shared_lines(lines: DataFrame) -> DataFrame:
    """(rid, drop) from distinct (rid, host, path, lines): places of the lines that a page shares with its neighbour."""
    ordered = lines.repartitionByRange("host", "path", "rid").sortWithinPartitions("host", "path", "rid")
    found = stored(ordered.mapInArrow(_pairs, _PAIR_SCHEMA), "pairs")
    # the runs of near copies at each task's ends, eight rows of each task at most
    edges = found.where("edge is not null").coalesce(1).sortWithinPartitions("host", "path", "rid").mapInArrow(_across, _PAIR_SCHEMA)
    others = F.broadcast(edges.select("waits", F.col("lines").alias("other")))
    late = found.where("waits is not null").join(others, "waits").select("rid", "host", "path", "lines", "other")
    done = found.where("edge is null and waits is null").select("rid", "drop")
    return done.unionByName(late.mapInArrow(_late, _PAIR_SCHEMA).select("rid", "drop"))


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid, host, path and lines (hashes, then lengths) of pages: rid, url, html."""
    for b in batches:
        out: list[list] = [[], [], []]
        for u, page in zip(b.column(1).to_pylist(), b.column(2)):
            every = [x[0] for x in all_blocks(page.as_py())]
            hashes = np.array([xxhash.xxh64_intdigest(x.encode("utf-8", "replace")) for x in every], np.uint64)
            lines = hashes.tobytes() + np.array(list(map(len, every)), np.int64).tobytes()
            for col, x in zip(out, (*host_and_path(u), lines)):
                col.append(x)
        cols = [pa.array(x, k) for x, k in zip(out, (pa.string(), pa.string(), pa.binary()))]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=["rid", "host", "path", "lines"])


def extract(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """``pages`` columns but the html, and the main text (instead of a column ``text``, if there is one).

    Pages are known by a digest of URL and html: rows that have both in common are one page to
    the differencing.  Its findings, places of lines, are joined to the pages; no text is stored on the way.
    """
    fields = [f for f in pages.schema.fields if f.name not in (html, "text")]
    n = len(fields)
    schema = T.StructType([*[T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)], T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n".join(decided(page.as_py(), shared)) for page, shared in zip(b.column(n), b.column(n + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*[b.column(i) for i in range(n)], pa.array(texts, pa.string())], names=schema.names)

    digest = [F.coalesce(F.sha2(F.col(f"`{c}`").cast("string"), 256), F.lit("")) for c in (url, html)]
    named = pages.select(
        *[F.col(f"`{f.name}`").alias(f"c{i}") for i, f in enumerate(fields)],
        F.unhex(F.sha2(F.concat_ws(" ", *digest), 256)).alias("rid"),
        F.col(f"`{url}`").alias("u"),
        F.col(f"`{html}`").alias("h"),
    )
    lines = named.select("rid", "u", "h").mapInArrow(_lines, "rid binary, host string, path string, lines binary")
    drops = stored(shared_lines(stored(lines.dropDuplicates(["rid"]), "page-lines")), "page-drops")
    rest = named.join(drops, "rid", "left").select(*[f"c{i}" for i in range(n)], "h", "drop").mapInArrow(run, schema)
    return rest.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(fields)], "text")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
