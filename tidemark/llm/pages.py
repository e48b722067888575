"""Main text of web pages by differencing with the page of the nearest URL.

Pages are ordered by host and path, each is paired with the nearest page before or behind it on its host that is no copy of it
(the one that shares more of its path), and their text lines are aligned by longest common subsequence. Shared lines are the site's template and are deleted; markup that names its own
role (article, navigation, footer, advert) then decides what differencing cannot.
"""

from __future__ import annotations

import html as entities
import pickle
import re
import tempfile
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.urls import split_url

#: WRAPPED is inside a main element, but in no article.
CHROME, UNMARKED, MAIN, WRAPPED = 0, 1, 2, 3
#: Pages of one block of the URL order, and the most blocks; beyond that blocks grow, which are read as streams.
BLOCK_PAGES, MAX_BLOCKS = 2_000, 20_000
#: Pages that share so much of their text outside of chrome are versions of one page and no partners: what they share is no template.
COPY_PERCENT = 80
#: Characters of a run of copies that wait in memory for the page behind it; what exceeds them waits on disk.
HELD_CHARS = 16_000_000
#: How a row came into a block: it is one of its pages, stands next to its border, or is the page beyond a run that crosses the border.
OWN, NEAR, FAR = 0, 1, 2

#: Element names of the HTML standard, by what they mean here.
_VOID = set("area base br col embed hr img input link meta source track wbr".split())
_RAW = set("script style textarea title iframe head".split())
#: Elements whose content is no text of the page; without an end tag of their own they end at the next block or with their parent.
_EMBEDDED = set("noscript template svg canvas object select audio video".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_CHROME = set("nav footer aside form menu dialog button label search fieldset".split())
_HEADING = set("h1 h2 h3 h4 h5 h6".split())
#: Words in class or id that mark chrome, those that mark reader comments, and those that mark a container of everything.
_MARKS = set(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar nav navbar navigation menu breadcrumb breadcrumbs "
    "footer cookie cookies consent notice gdpr disclaimer newsletter subscribe subscription signup share sharing social related recommended popup "
    "modal overlay login search widget toolbar pagination pager skip masthead topbar".split()
)
_COMMENTS = set("comment comments disqus reply replies respond discussion".split())
_CONTAINERS = set("content main article post entry body wrapper wrap container layout page".split())
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())

_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|[^<]++|<""", re.S
)
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_MARKING = re.compile(r"class|id\s*=|role|hidden", re.I)


def _region_of(tag: str, attributes: str, around: int, in_main: bool) -> int:
    """The region inside an element, given the region it stands in."""
    if around == CHROME or tag in _CHROME:
        return CHROME
    marks: set[str] = set()
    if _MARKING.search(attributes):
        for name, value in _ATTRIBUTE.findall(attributes):
            name, value = name.lower(), value.strip("\"'").lower()
            if name in ("class", "id"):
                marks.update(re.split(r"[^a-z0-9]+", value))
            elif name == "role" and value in _ROLES or name == "hidden" or (name == "aria-hidden" and value == "true"):
                return CHROME
    if marks & _COMMENTS:
        return CHROME
    if tag in ("article", "main"):
        return MAIN if tag == "article" or around == MAIN else WRAPPED
    if tag == "header" or "header" in marks:
        return CHROME if not in_main else around
    if marks & _MARKS and not marks & _CONTAINERS and tag not in ("body", "html"):
        return CHROME
    return around


def _closed(html: str, tag: str) -> set[int]:
    """Where the start tags of an element end that have an end tag of their own."""
    opened, found = [], set()
    for match in re.finditer(rf"<(/?){tag}(?=[\s/>])[^>]*>", html, re.I):
        if not match[1] and not match[0].endswith("/>"):
            opened.append(match.end())
        elif match[1] and opened:
            found.add(opened.pop())
    return found


def _end_of(html: str, tag: str, position: int, around: set[str]) -> int | None:
    """The end of an element whose start tag ends at ``position``; None if an element of ``around`` ends before it."""
    inner: dict[str, int] = {tag: 1}
    while position < len(html):
        token = _TOKEN.match(html, position)
        position = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            if not inner.get(name) and name in around:
                return None
            inner[name] = max(0, inner.get(name, 0) - 1)
            if not inner[tag]:
                return position
        elif name in _RAW:
            end = re.compile(rf"</{name}(?:\s[^>]*)?>", re.I).search(html, position)
            position = end.end() if end else position
        elif name not in _VOID and not token[3].endswith("/"):
            inner[name] = inner.get(name, 0) + 1
    return None


def text_lines(html: str | None) -> tuple[list[str], list[int]]:
    """The text blocks of a page in order, and the region of each.

    Character references are decoded, white space within a block becomes one space, empty blocks are left out.
    Unclosed elements end with the element around them; an unclosed paragraph or list item ends at the next one. Chrome inside a block (an
    advert in a ``span``, a button, a label) leaves a space in its place, and the block stays one line.
    """
    html = html or ""
    lines, regions = [], []
    buffer: list[tuple[str, int]] = []  # the pieces of the block being read, and the region of each
    stack: list[tuple[str, int]] = []
    position, size = 0, len(html)
    closed: dict[str, set[int]] = {}
    inline: dict[str, int] = {}  # elements opened within an embedded one that has no end tag

    def region() -> int:
        return stack[-1][1] if stack else UNMARKED

    def own_end(tag: str) -> int | None:
        """Where an element just opened ends, if it has an end tag of its own within the element around it."""
        if tag not in closed:
            closed[tag] = _closed(html, tag)
        return _end_of(html, tag, position, {name for name, _ in stack}) if position in closed[tag] else None

    def flush() -> None:
        own = next((r for _, r in buffer if r != CHROME), CHROME)
        for kind in {own, CHROME}:
            line = " ".join(entities.unescape("".join(piece for piece, r in buffer if (r == CHROME) == (kind == CHROME))).split())
            if line:
                lines.append(line)
                regions.append(kind)
        buffer.clear()

    while position < size:
        token = _TOKEN.match(html, position)
        position = token.end()
        tag = token[2]
        if tag is None:
            if html[token.start()] != "<" or token.end() - token.start() == 1:
                buffer.append((token[0], region()))
            continue
        tag = tag.lower()
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            buffer.append((" ", region()))
        within = bool(stack) and stack[-1][0] in _EMBEDDED
        if token[1]:
            if within and tag not in _BLOCK:
                if tag != stack[-1][0] and inline.get(tag):
                    inline[tag] -= 1
                else:
                    flush()
                    stack.pop()
                continue
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    if tag not in _BLOCK and any(name in _BLOCK for name, _ in stack[i + 1 :]):
                        break
                    del stack[i:]
                    break
            continue
        if tag in _VOID or token[3].endswith("/") and tag not in _BLOCK:
            continue
        if tag in _RAW:
            end = re.compile(rf"</{re.escape(tag)}(?:\s[^>]*)?>", re.I).search(html, position)
            if tag != "head" or end:
                position = end.end() if end else size
            continue
        if tag in _EMBEDDED:
            end = own_end(tag)
            if end is not None:
                position = end
            elif not within:
                flush()
                stack.append((tag, CHROME))
                inline = {}
            continue
        if within and tag not in _BLOCK:
            inline[tag] = inline.get(tag, 0) + 1
            continue
        if tag in _BLOCK:
            while stack and (stack[-1][0] == "p" or stack[-1][0] == tag and tag in ("li", "dt", "dd", "td", "th", "tr") or stack[-1][0] not in _BLOCK):
                stack.pop()
        inside = _region_of(tag, token[3], region(), any(r in (MAIN, WRAPPED) for _, r in stack))
        if tag in _BLOCK or inside != region() or any(name == tag for name, _ in stack):
            if tag not in _BLOCK and inside != region():
                buffer.append((" ", region()))
                end = own_end(tag)
                if end is not None:  # whole, with what blocks it holds
                    position = end
                    continue
            stack.append((tag, inside))
    flush()
    return lines, regions


def _rows(a: list, b: list) -> tuple[list[int], int]:
    """Bit rows of the common subsequence table: bit j of row i is 0 where the length grows at ``b[j]``."""
    place: dict = {}
    for j, item in enumerate(b):
        place[item] = place.get(item, 0) | 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, []
    for item in a:
        shared = row & place.get(item, 0)
        row = (row + shared | row - shared) & full
        rows.append(row)
    return rows, full


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each prefix of ``b``."""
    rows, full = _rows(a, b)
    bits = (rows[-1] if rows else full) ^ full
    grown = np.unpackbits(np.frombuffer(bits.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(grown)])


def common_lines(a: list, b: list, limit: int = 400_000_000) -> set[int]:
    """Places of ``a`` on a longest common subsequence with ``b``, exact for any length.

    Tables of more than ``limit`` bits are halved instead of kept, so memory stays bounded.
    """
    low = 0
    while low < min(len(a), len(b)) and a[low] == b[low]:
        low += 1
    tail = 0
    while tail < min(len(a), len(b)) - low and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = {*range(low), *range(len(a) - tail, len(a))}
    x, y = a[low : len(a) - tail], b[low : len(b) - tail]
    if not x or not y:
        return found
    if len(x) * len(y) > limit and len(x) > 1:
        half = len(x) // 2
        cut = int(np.argmax(_lengths(x[:half], y) + _lengths(x[half:][::-1], y[::-1])[::-1]))
        return found | {low + i for i in common_lines(x[:half], y[:cut], limit)} | {low + half + i for i in common_lines(x[half:], y[cut:], limit)}
    rows, _ = _rows(x, y)
    i, j = len(x) - 1, len(y) - 1
    while i >= 0 and j >= 0:
        if rows[i] >> j & 1:
            j -= 1
        elif i and not rows[i - 1] >> j & 1:
            i -= 1
        else:
            found.add(low + i)
            i, j = i - 1, j - 1
    return found


def shared_prefix(a: str, b: str) -> int:
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def main_text(lines: list[str], regions: list[int], partner: list[str] | None) -> str:
    """The lines that remain when those shared with ``partner`` are deleted.

    Inside an article element sharing only means that the article stands twice, so its lines stay and those outside of it and of a
    main element go. Elsewhere the page's own lines remain, those in a main element if there is one; if the partner has all of
    them, they stay.
    """
    articles = [i for i, r in enumerate(regions) if r == MAIN]
    inside = WRAPPED if WRAPPED in regions else UNMARKED
    if articles and inside == UNMARKED:
        return "\n".join(lines[i] for i in articles)
    shared = common_lines(lines, partner) if partner else set()
    kept = [i for i, r in enumerate(regions) if r == MAIN or r == inside and i not in shared]
    return "\n".join(lines[i] for i in kept or [i for i, r in enumerate(regions) if r == inside])


def signature(lines: list[str], regions: list[int]) -> bytes:
    """What :func:`copies` needs to know of a page: hashes of its lines outside of chrome, ascending, then the characters of each."""
    sizes: dict[int, int] = {}
    for line, region in zip(lines, regions):
        if region != CHROME:
            h = xxhash.xxh3_64_intdigest(line.encode(errors="surrogatepass"))
            sizes[h] = sizes.get(h, 0) + len(line)
    hashes = sorted(sizes)
    return np.array(hashes, np.uint64).tobytes() + np.array([sizes[h] for h in hashes], np.int64).tobytes()


def copies(a: bytes, b: bytes) -> bool:
    """Whether two pages, by their signatures, are copies or near copies: COPY_PERCENT of the larger one's characters are shared."""
    if a == b:
        return True
    (x, n), (y, m) = ((np.frombuffer(s[: len(s) // 2], np.uint64), np.frombuffer(s[len(s) // 2 :], np.int64)) for s in (a, b))
    small, large = sorted((int(n.sum()), int(m.sum())))
    if 100 * small < COPY_PERCENT * large:
        return False
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return 100 * int(np.minimum(n[i], m[j]).sum()) >= COPY_PERCENT * large


class _Held:
    """Pages of a run, in order, until the page behind the run is known."""

    def __init__(self) -> None:
        self.pages, self.size, self.file = [], 0, None

    def add(self, page: tuple, size: int) -> None:
        if self.size + size <= HELD_CHARS or not self.pages:
            self.pages.append(page)
            self.size += size
        else:
            self.file = self.file or tempfile.TemporaryFile()
            pickle.dump(page, self.file)

    def drain(self) -> Iterator[tuple]:
        yield from self.pages
        if self.file:
            end = self.file.tell()
            self.file.seek(0)
            while self.file.tell() < end:
                yield pickle.load(self.file)
            self.file.close()
        self.__init__()


def _host(site: str) -> str:
    return site.partition("\0")[0]


def _summaries(rows: Iterator[tuple]) -> Iterator[tuple]:
    """``block, first_open, back_open, before, last_open, on_open, after`` of sorted ``(block, kind, place, signature)``.

    ``first_open`` and ``last_open``: no border of the run of the block's first (last) page is in sight on the side where it
    leaves the block. ``before`` is the place of the page before the last page's run, on its host, ``after`` that of the page behind
    the first page's run; if ``back_open`` (``on_open``), the next block on that side knows it.
    """
    block = None
    for row in rows:
        if row[0] != block:
            if block is not None:
                yield block, first_open, back_open, before, own_run and last[1] == NEAR, not ended and last[1] == NEAR, after
            block, seen, ended, own_run, first_open, back_open = row[0], False, False, False, False, False
            run_before, before, after, from_guest = None, None, None, row[1] == NEAR
        elif (same := _host(row[2][0]) == _host(last[2][0])) is False or not copies(row[3], last[3]):
            if seen and not ended:
                ended, after = True, row[2] if same else None
            run_before, from_guest, own_run = last[2] if same else None, False, False
        if row[1] == OWN:
            if not seen:
                seen, first_open = True, from_guest
            own_run, before, back_open = True, run_before, from_guest
        last = row
    if block is not None:
        yield block, first_open, back_open, before, own_run and last[1] == NEAR, not ended and last[1] == NEAR, after


def _far_guests(summaries: list[tuple]) -> dict[tuple, list[int]]:
    """Places of the pages beyond runs that cross borders, with the blocks that cannot see them."""
    wanted: dict[tuple, list[int]] = {}
    ordered = sorted(summaries, key=lambda s: s[0])
    for side, way in (((1, 2, 3), ordered), ((4, 5, 6), ordered[::-1])):
        known = None
        for summary in way:
            needs, passes, own = (summary[i] for i in side)
            if needs and known is not None:
                wanted.setdefault(known, []).append(summary[0])
            known = known if passes else own
    return wanted


def extract_main_text(df: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``key, url, text, n_chars`` for every row of ``df``.

    Null or empty pages have an empty text; null URLs share an empty host. Copies and near copies that follow each other are a run, of which each
    page meets the page before and the page behind the run, so copies fare alike; a page without another page than copies on
    its host has no partner. Repeated rows repeat.

    Blocks of the global order by host, path and key are found by a range sort of the keys alone, so a host with a third of all
    pages spreads over many tasks. Pages next to a block's border are sent to both sides. A first pass over signatures finds the
    pages beyond runs that cross borders, which are sent along, so pairs are independent of where borders fall. Blocks are read as
    sorted streams; of a long run what exceeds HELD_CHARS waits in a temporary file.
    """
    keyed = df.select(F.col(f"`{key}`").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.col(f"`{html}`").cast("string").alias("html"))
    parts = F.pandas_udf(lambda urls: urls.map(lambda u: "\0".join(split_url(u))), "string")
    order = keyed.select(parts("url").alias("site"), F.col("key").cast("string").alias("key"), F.xxhash64("url").alias("mark"))
    # A number of its own, else adaptive execution would merge these small rows into one block.
    blocks_wanted = min(MAX_BLOCKS, max(8, keyed.count() // BLOCK_PAGES))
    spans = order.repartitionByRange(blocks_wanted, "site", "key", "mark").groupBy(F.spark_partition_id().alias("p")).agg(
        F.min(F.struct("site", F.coalesce("key", F.lit("")).alias("k"), "mark")).alias("low"), F.max(F.struct("site", F.coalesce("key", F.lit("")).alias("k"), "mark")).alias("high")
    )
    edges = sorted((tuple(r["low"]), tuple(r["high"])) for r in spans.collect())  # at most MAX_BLOCKS entries
    lows, highs = [low for low, _ in edges], [high for _, high in edges]
    kind = keyed.schema["key"].dataType.simpleString()
    head = [("block", pa.int32()), ("guest", pa.int32()), ("site", pa.string()), ("k", pa.string()), ("mark", pa.int64()), ("h", pa.int64())]
    names, order_by = [name for name, _ in head], ["block", "site", "k", "mark", "h", "guest"]

    def placed(batch: pa.RecordBatch, far: dict) -> Iterator[tuple]:
        """Row number, head, address, lines and regions of every page, once for each block that needs it."""
        for i, (value, address, mark) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist())):
            lines, regions = text_lines(batch.column(2)[i].as_py())
            h = xxhash.xxh3_64_intdigest("\n".join(lines).encode(errors="surrogatepass") + bytes(regions)) - (1 << 63)
            place = ("\0".join(split_url(address)), "" if value is None else str(value), mark, h)
            block = max(0, bisect_right(lows, place[:3]) - 1)
            targets = [(block, OWN)]
            if block and place[:3] <= lows[block]:
                targets.append((block - 1, NEAR))
            if block + 1 < len(lows) and place[:3] >= highs[block]:
                targets.append((block + 1, NEAR))
            for target in (*targets, *((b, FAR) for b in far.get(place, ()))):
                yield i, (*target, *place), address, lines, regions

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(*place, signature(lines, regions)) for _, place, _, lines, regions in placed(batch, {})]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, (_, t) in enumerate([*head, ("sig", pa.binary())])], [*names, "sig"])

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((r[0], r[1], r[2:6], r[6]) for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in range(7))))
        for summary in _summaries(rows):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(summary)], pa.binary())], ["summary"])

    start = "block int, guest int, site string, k string, mark bigint, h bigint"
    marked = keyed.withColumn("mark", F.xxhash64("url"))
    far: dict[tuple, list[int]] = {}
    if len(lows) > 1:
        signed = marked.mapInArrow(sign, f"{start}, sig binary").repartition("block").sortWithinPartitions(*order_by)
        far = _far_guests([pickle.loads(r["summary"]) for r in signed.mapInArrow(summarise, "summary binary").collect()])  # one for each block

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [*(t for _, t in head), pa.string(), pa.list_(pa.string()), pa.binary()]
        for batch in batches:
            out, places = [], []
            for i, place, address, lines, regions in placed(batch, far):
                out.append((*place, address, lines, bytes(regions)))
                places.append(i)
            columns = [pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)]
            columns.insert(6, batch.column(0).take(pa.array(places, pa.int64())))
            yield pa.RecordBatch.from_arrays(columns, [*names, "key", "url", "lines", "regions"])

    parsed = marked.mapInArrow(parse, f"{start}, key {kind}, url string, lines array<string>, regions binary")
    blocks = parsed.repartition("block").sortWithinPartitions(*order_by)

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def nearest(before, page, after):
            """Lines of the better one of two pages on the page's host, unless they are its copies."""
            path, best = page[2].partition("\0")[2], None
            for other in (before, after):
                if other is not None and not copies(other[-1], page[-1]):
                    near = shared_prefix(path, other[2].partition("\0")[2])
                    if best is None or near > best[0]:
                        best = (near, other[5])
            return best and best[1]

        def results(held: _Held, before, after) -> Iterator[tuple]:
            for page in held.drain():
                yield page[3], page[4], main_text(page[5], list(page[6]), nearest(before, page, after))

        def pages() -> Iterator[tuple]:
            for batch in batches:
                keys = batch.column(6)
                for i, (block, guest, site, address, lines, regions) in enumerate(zip(*(batch.column(c).to_pylist() for c in (0, 1, 2, 7, 8, 9)))):
                    yield block, guest, site, keys.take(pa.array([i])), address, lines, regions, signature(lines, list(regions))

        def texts() -> Iterator[tuple]:
            held, before, last = _Held(), None, None
            for page in pages():
                beside = last is not None and page[0] == last[0] and _host(page[2]) == _host(last[2])
                # A page from afar is known not to be of the run.
                if not beside or FAR in (page[1], last[1]) or not copies(page[-1], last[-1]):
                    yield from results(held, before, page if beside else None)
                    before = last if beside else None
                if page[1] == OWN:
                    held.add(page, sum(map(len, page[5])))
                last = page
            yield from results(held, before, None)

        def emit(rows: list[tuple]) -> pa.RecordBatch:
            keys = pa.concat_arrays([r[0] for r in rows])
            return pa.RecordBatch.from_arrays(
                [keys, pa.array([r[1] for r in rows], pa.string()), pa.array([r[2] for r in rows], pa.string()), pa.array([len(r[2]) for r in rows], pa.int64())],
                ["key", "url", "text", "n_chars"],
            )

        out = []
        for row in texts():
            out.append(row)
            if len(out) == 1_000:
                yield emit(out)
                out = []
        if out:
            yield emit(out)

    found = blocks.mapInArrow(difference, f"key {kind}, url string, text string, n_chars bigint")
    return found.withColumnRenamed("key", key)
