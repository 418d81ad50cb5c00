"""Main text of web pages: nearest-URL page differencing over structured text lines.

A page becomes text lines, one a block, each with the zone it stands in: within an article, within a main
element, within boilerplate (menu, header, footer, sidebar, notice, advert, form, comments) or plain.
Every page of a host is differenced: the pages are sorted by host and URL path, each is paired with the
next page before or behind it that is not nearly the same page, whichever path shares the longer prefix,
and the lines of the two are aligned by their longest common subsequence.  Lines that both share belong
to the template and are deleted, the zones being the evidence beside it: what stands in an article is
text though another page repeats it (paragraphs of copies on one host), and where a page has an article
or main element, plain lines outside do not count though no other page has them.
"""

from __future__ import annotations

import html
import marshal
import re
import tempfile
import zlib
from collections import Counter
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hotbeat.llm.common import written

MAIN, PLAIN, BOILER, IN_MAIN = 0, 1, 2, 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|title|textarea|svg|iframe|object|select|option)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-z][a-z0-9:-]*)([^>]*)(?:>|\Z)"
    r"|<[!?/][^>]*(?:>|\Z)", re.I | re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)

_TARGET = re.compile(r"href\s*=\s*[\"']?#([^\"'\s>]+)", re.I)

INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd",
          "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BOILER_TAGS = {"nav", "footer", "aside", "menu", "dialog", "button", "head"}
#: Words that make a class, id or role boilerplate: alone, or joined only with each other and with ``LAYOUT_WORDS``.
BOILER_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "banner", "sponsor", "sponsored", "promo", "cookie", "cookies", "consent",
                "gdpr", "sidebar", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "share", "sharing", "social",
                "newsletter", "subscribe", "signup", "login", "popup", "modal", "overlay", "notice", "notices", "alert", "toolbar",
                "pagination", "widget", "contentinfo", "complementary", "search"}
#: What stands beside an article and may consist of articles itself.
BESIDE_WORDS = {"comment", "comments", "disqus", "related"}
#: Words that only place or shape a block.
LAYOUT_WORDS = {"left", "right", "top", "bottom", "upper", "lower", "side", "inner", "outer", "main", "primary", "secondary", "site", "page", "post",
                "posts", "article", "articles", "bar", "box", "block", "slot", "unit", "area", "section", "container", "wrapper", "wrap", "panel",
                "list", "item", "items", "link", "links", "button", "buttons", "icon", "icons", "form", "field", "thread", "reader", "user",
                "header", "footer", "toggle", "column", "col", "row", "mobile", "desktop", "sticky", "fixed", "floating"}
#: Boilerplate only outside an article, which may have a header or footer of its own.
PAGE_WORDS = {"header", "footer", "masthead", "topbar", "site-header", "site-footer"}
#: Never boilerplate by a class, and so is no block around a main or article.
WHOLE = {"html", "body", "main", "article"}
SURE, WORDS, BESIDE, FORM, INSIDE = 1, 2, 3, 4, 5
CLOSES_ITSELF = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}


def _kind(value: str, in_main: bool) -> int:
    """0, ``WORDS`` or ``BESIDE`` for the words of a class, id or role."""
    kind = 0
    for word in value.split():
        parts = {p for p in re.split("[-_]+", word) if p}
        named = parts & BOILER_WORDS or not in_main and word in PAGE_WORDS
        beside = parts & BESIDE_WORDS
        if not (named or beside) or word not in PAGE_WORDS and parts - BOILER_WORDS - BESIDE_WORDS - LAYOUT_WORDS:
            continue
        if beside:
            kind = kind or BESIDE
        else:
            kind = WORDS
    return kind


def _mark(tag: str, attributes: str, in_main: bool, targets: set[str]) -> int:
    """0, or why a block may be boilerplate; all but ``SURE`` depend on what it encloses.

    Ids count on blocks, not on headings or inline elements; within an article an id that a link of the
    page points to is a section's name, unless it names comments.
    """
    if tag in BOILER_TAGS or tag == "header" and not in_main:
        return SURE
    mark = FORM if tag == "form" else 0
    if tag in ("html", "body") or not attributes.strip():
        return mark
    for name, *values in _ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and re.search(r"display\s*:\s*none", value):
            return SURE
        if tag in WHOLE or name not in ("class", "role", "id"):
            continue
        kind = _kind(value, in_main)
        if name == "id" and kind and (re.fullmatch("h[1-6]", tag) or tag in INLINE or in_main and kind == WORDS and value in targets):
            continue
        if kind == WORDS:
            mark = INSIDE if in_main and name == "id" and mark != WORDS else WORDS
        elif kind == BESIDE and mark not in (WORDS, INSIDE):
            mark = BESIDE
    return mark


def lines_of(page: str) -> list[tuple[str, int]]:
    """(text, zone) of each block of a page that has text, in page order.

    Classes, ids and roles make a block boilerplate unless it encloses a main or article (for comments and
    related articles: unless it encloses every article); a form, and a block that an id marks within an article, unless it
    encloses a main or article or more than half of the text that is not boilerplate otherwise.
    """
    targets = {t.lower() for t in _TARGET.findall(page)}
    out: list[tuple[str, int, int]] = []  # text, in a main element (1) or an article (2), innermost mark
    stack: list[tuple[str, int, int]] = []  # open blocks: tag, in a main element or an article, innermost mark
    marks: list[tuple[int, int]] = []  # mark around it (-1: none), kind
    wholes: list[tuple[bool, int]] = []  # main and article elements: is an article, mark around it
    text: list[str] = []
    at = 0

    def flush():
        line = " ".join("".join(text).split())
        text.clear()
        if line:
            out.append((line, *stack[-1][1:]) if stack else (line, 0, -1))

    def push(tag, main, around, kind):
        if kind:
            marks.append((around, kind))
            around = len(marks) - 1
        stack.append((tag, main, around))

    for m in _TOKEN.finditer(page):
        if m.start() > at:
            piece = page[at:m.start()]
            text.append(html.unescape(piece) if "&" in piece else piece)
        at = m.end()
        tag = m[3] or m[6]
        if not tag:
            continue  # comment, script, style, doctype
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
        if tag in INLINE or tag == "br":
            if not (m[2] or m[5]) and tag not in VOID and stack and (kind := _mark(tag, m[4] or m[7] or "", stack[-1][1], targets)):
                flush()
                push(tag, *stack[-1][1:], kind)
            elif (m[2] or m[5]) and stack and stack[-1][0] == tag:
                flush()
                stack.pop()
            continue
        flush()
        if m[2] or m[5]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    del stack[k:]
                    break
        elif tag not in VOID:
            while stack and stack[-1][0] in CLOSES_ITSELF.get(tag, ()) or tag != "p" and stack and stack[-1][0] == "p":
                stack.pop()
            main, around = stack[-1][1:] if stack else (0, -1)
            if tag in ("article", "main"):
                wholes.append((tag == "article", around))
                main = 2 if tag == "article" else max(main, 1)
            push(tag, main, around, _mark(tag, m[4] or m[7] or "", main, targets))
    if at < len(page):
        text.append(html.unescape(page[at:]))
    flush()
    zones = (PLAIN, IN_MAIN, MAIN)
    if not marks:
        return [(t, zones[main]) for t, main, _ in out]

    def within(places):
        """Sum of the sizes at and within each mark."""
        total = [0] * len(marks)
        for k, n in places:
            if k >= 0:
                total[k] += n
        for k in range(len(marks) - 1, -1, -1):
            if marks[k][0] >= 0:
                total[marks[k][0]] += total[k]
        return total

    holds, articles = within((k, 1) for _, k in wholes), within((k, 1) for article, k in wholes if article)
    n_articles = sum(article for article, _ in wholes)

    def boilerplate(form):
        mine: list[bool] = []
        for k, (around, kind) in enumerate(marks):
            own = (kind == SURE or kind == WORDS and not holds[k] or kind == BESIDE and (not holds[k] or articles[k] < n_articles)
                   or kind in (FORM, INSIDE) and form(k))
            mine.append(own or around >= 0 and mine[around])
        return mine

    boiler = boilerplate(lambda k: False)
    if any(kind in (FORM, INSIDE) for _, kind in marks):
        rest = [(k, len(t)) for t, _, k in out if k < 0 or not boiler[k]]
        size, whole = within(rest), sum(n for _, n in rest)
        boiler = boilerplate(lambda k: not holds[k] and 2 * size[k] <= whole)
    return [(t, BOILER if k >= 0 and boiler[k] else zones[main]) for t, main, k in out]


def shared_lines(a: list[str], b: list[str]) -> list[bool]:
    """Which lines of ``a`` lie in a longest common subsequence with ``b`` (rows of bits, one a line of ``b``)."""
    places: dict[str, int] = {}
    for j, line in enumerate(b):
        places[line] = places.get(line, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for line in a:
        hit = row & places.get(line, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    out, j = [False] * len(a), len(b) - 1
    for i in range(len(a) - 1, -1, -1):
        # a clear bit: the subsequence grows by that line of b
        above = rows[i - 1] if i else full
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        if above >> j & 1:
            out[i] = True
            j -= 1
    return out


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None) -> str:
    """The lines that are left of a page after differencing against its partner; its main element stays if that leaves nothing of it."""
    shared = shared_lines([t for t, _ in lines], [t for t, _ in partner]) if partner else [False] * len(lines)
    whole = any(zone in (MAIN, IN_MAIN) for _, zone in lines)
    left = [t for (t, zone), s in zip(lines, shared) if zone == MAIN or not s and zone == (IN_MAIN if whole else PLAIN)]
    return "\n".join(left if left or not whole else [t for t, zone in lines if zone == IN_MAIN])


#: Two pages are nearly the same if of neither's plain characters more than this share stands in lines of its own.
NEARLY = 0.05
#: Bytes of a run of nearly equal pages that a task holds in memory; the rest waits in its temporary folder.
RUN_BYTES = 1 << 24
_DECIDED, _OPEN, _EDGE = 0, 1, 2


def nearly_equal(a: list[tuple[str, int]], b: list[tuple[str, int]]) -> bool:
    """Whether two pages are the same one: equal, or apart in little (a date, a counter)."""
    if a == b:
        return True

    def own(x, y):
        theirs, size, alone = Counter(t for t, _ in y), 0, 0
        for t, zone in x:
            if zone != BOILER:
                size += len(t)
                if theirs[t] > 0:
                    theirs[t] -= 1
                else:
                    alone += len(t)
        return alone > NEARLY * size

    return not own(a, b) and not own(b, a)


def differenced(path: str, lines: list[tuple[str, int]], before, after) -> str:
    """Text of a page by the candidates (path, lines) before and behind it; nearly equal ones are no partners."""
    best = None
    for other in (before, after):
        if other and not nearly_equal(lines, other[1]):
            near = len(commonprefix([path, other[0]]))
            if best is None or near > best[0]:
                best = (near, other[1])
    return main_text(lines, best[1] if best else None)


def _unpacked(packed: bytes) -> list[tuple[str, int]]:
    return marshal.loads(zlib.decompress(packed))


def _packed(rows: list[tuple], schema: pa.Schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)


def _in_batches(rows, schema: pa.Schema, size: int = 500):
    done = []
    for row in rows:
        done.append(row)
        if len(done) >= size:
            yield _packed(done, schema)
            done = []
    if done:
        yield _packed(done, schema)


def _runs(rows, part: int):
    """Rows (k, u, text, state, part, run, host, path, lines) of a partition's pages (k, u, host, path, packed lines) in order.

    Pages in a row that are nearly the first of them form a run; the first page of the runs before and
    behind are the candidates.  Pages of the first and last run lack one and stay open; the first pages
    of the two outer runs at each end are handed on as candidates.
    """
    run, head, before, held = -1, None, None, None  # head: host, path, lines, packed lines of the run's first page
    first = True  # the run may go on in the partition before
    previous = None

    def closed(after, last):
        held.seek(0)
        while True:
            try:
                k, u, path, packed = marshal.load(held)
            except EOFError:
                break
            if first or last:
                yield k, u, None, _OPEN, part, run, head[0], path, packed
            else:
                yield k, u, differenced(path, _unpacked(packed), before, after), _DECIDED, part, run, head[0], path, None
        held.close()

    def edge(run, head):
        return None, None, None, _EDGE, part, run, head[0], head[1], head[3]

    for k, u, host, path, packed in rows:
        lines = _unpacked(packed)
        if head is None or head[0] != host or not nearly_equal(lines, head[2]):
            if head is not None:
                yield from closed((path, lines) if head[0] == host else None, False)
                if run <= 1:
                    yield edge(run, head)
                before = head[1:3] if head[0] == host else None
                previous, first = (run, head), False
            run, head, held = run + 1, (host, path, lines, packed), tempfile.SpooledTemporaryFile(RUN_BYTES)
        marshal.dump((k, u, path, packed), held)
    if head is not None:
        yield from closed(None, True)
        yield edge(run, head)
        if previous and previous[0] > 1:
            yield edge(*previous)


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """key, url, text, n_chars (code points) of every page.

    Null or empty html gives an empty text; a page with a null url, alone on its host or among nothing but
    near copies of itself has no partner and keeps all lines of its zone.  Repeated rows stay; other columns
    are ignored.  Pages are range-partitioned by host and path, so a host of any size is spread over
    tasks.  Pages at the edge of a partition find their partners among four pages of each other partition.
    """
    host = F.lower(F.regexp_extract("u", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract("u", r"^[^:]+://[^/?#]*([^?#]*)", 1)
    kind = pages.schema[key].dataType.simpleString()
    given = (pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("u"), F.coalesce(F.col(source), F.lit("")).alias("s"))
             .withColumn("h", F.coalesce(host, F.lit(""))).withColumn("p", F.coalesce(path, F.lit(""))))
    result = f"{key} {kind}, url string, text string, n_chars long"

    def columns(b, *names):
        return zip(*(b.column(c).to_pylist() for c in names))

    def result_schema(b):
        return pa.schema([(key, b.schema.field("k").type), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def alone(batches):
        for b in batches:
            def rows():
                for k, u, s in columns(b, "k", "u", "s"):
                    text = main_text(lines_of(s), None)
                    yield k, u, text, len(text)
            yield from _in_batches(rows(), result_schema(b))

    def parsed(batches):
        for b in batches:
            schema = pa.schema([("k", b.schema.field("k").type), ("u", pa.string()), ("h", pa.string()), ("p", pa.string()), ("lines", pa.binary())])
            yield from _in_batches(((k, u, h, p, zlib.compress(marshal.dumps(lines_of(s)), 2)) for k, u, h, p, s in columns(b, "k", "u", "h", "p", "s")), schema)

    def compared(batches):
        kinds = []

        def rows():
            for b in batches:
                kinds[:] = [b.schema.field("k").type]
                yield from columns(b, "k", "u", "h", "p", "lines")

        out, done = _runs(rows(), TaskContext.get().partitionId()), []
        packed = lambda: _packed(done, pa.schema([
            ("k", kinds[0]), ("u", pa.string()), ("text", pa.string()), ("state", pa.int32()), ("part", pa.int32()),
            ("run", pa.int64()), ("h", pa.string()), ("p", pa.string()), ("lines", pa.binary())]))
        for row in out:
            done.append(row)
            if len(done) >= 500:
                yield packed()
                done.clear()
        if done:
            yield packed()

    whole = given.where("h = ''").select("k", "u", "s").mapInArrow(alone, result)
    sorted_pages = (given.where("h <> ''").select("k", "u", "h", "p", "s")
                    .mapInArrow(parsed, f"k {kind}, u string, h string, p string, lines binary")
                    .withColumn("i", F.monotonically_increasing_id())
                    .repartitionByRange("h", "p", "k", "i").sortWithinPartitions("h", "p", "k", "i"))
    made = written(sorted_pages.mapInArrow(
        compared, f"k {kind}, u string, text string, state int, part int, run long, h string, p string, lines binary"), "html-text", "zstd")
    opened = made.where(f"state = {_OPEN}")
    # four pages a partition at most, of hosts that go across an edge or lie at one
    edges = sorted((r["part"], r["run"], r["h"], r["p"], bytes(r["lines"])) for r in made.where(f"state = {_EDGE}")
                   .join(opened.select("h").distinct(), "h", "left_semi").select("part", "run", "h", "p", "lines").collect())

    def finished(batches):
        by: dict[str, list] = {}
        for part, run, h, p, packed in edges:
            by.setdefault(h, []).append(((part, run), p, _unpacked(packed)))
        for b in batches:
            def rows():
                for k, u, part, run, h, p, packed in columns(b, "k", "u", "part", "run", "h", "p", "lines"):
                    lines = _unpacked(packed)
                    behind = lambda x: (e[1:] for e in x if not nearly_equal(lines, e[2]))
                    before = next(behind(e for e in reversed(by.get(h, ())) if e[0] < (part, run)), None)
                    after = next(behind(e for e in by.get(h, ()) if e[0] > (part, run)), None)
                    text = differenced(p, lines, before, after)
                    yield k, u, text, len(text)
            yield from _in_batches(rows(), result_schema(b))

    decided = made.where(f"state = {_DECIDED}").select(F.col("k").alias(key), F.col("u").alias("url"), "text", F.length("text").cast("long").alias("n_chars"))
    return whole.unionByName(decided).unionByName(opened.select("k", "u", "part", "run", "h", "p", "lines").mapInArrow(finished, result))
