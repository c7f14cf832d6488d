"""HTML extraction: page differencing between pages with the nearest URLs.

A page is cut into lines: the text of its blocks, with references decoded. Each page is compared with the
pages of its host that stand next to it in the order of their URL paths: lines are aligned by their longest
common subsequence, and lines that both pages share are deleted. Copies are no neighbours: equal pages of a host are
one, and near copies look past each other to the next page that differs. A check by elements follows. What an
`article` or `main` element holds stays even where another page repeats it: licences, quotations and copied
articles are content. Furniture that differs from page to page (menus, headers, footers, sidebars, forms,
adverts, notices, comments, hidden parts) is told by element, role, class and id.

Pages are numbered in the order of host and path over all tasks, and aligned in blocks of these numbers, so a
host with a third of all pages is spread like any other. Only line hashes are sent to be aligned.
"""

from __future__ import annotations

import bisect
import html as entities
import re
import zlib
from collections import defaultdict

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.ranking import with_dense_id
from .common import materialise, read, running_sum
from .url_filter import host_and_path

# Elements, roles and words of class and id attributes by what they hold.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noscript template textarea title iframe svg math canvas object select button".split())
BREAKS = set("address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset "
             "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol "
             "optgroup option p pre section summary table tbody td tfoot th thead tr ul".split())
SIDES = set("aside dialog footer head menu nav".split())
ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
WORDS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
            "cookie cookies disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice "
            "notices overlay pager pagination popup promo promoted related share sharing sidebar signup skip social "
            "sponsor sponsored subscribe toolbar widget".split())
COMMENT_WORDS = {"comment", "comments"}
#: Words that say where or how large furniture is. Others make its name that of a wrapper: has-sidebar, share-enabled.
PLACES = set("area bar block bottom box container footer form global group header inner item items link links list "
             "section site thread top".split())

#: Kinds of lines.
OUTSIDE, MAIN, DROPPED = range(3)
#: DROPPED, for the elements inside: an article in DROPPED is main text again, in ASIDE only a main element, in SEALED none.
ASIDE, SEALED = 3, 4
#: Pages, in the order of their URLs, that a task aligns at a time; bounds memory only.
BLOCK = 64
#: Pages next to each other are near copies if they share so much of the text, by characters, that is no furniture.
COPY = 0.8

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>")
_TAG_BEGINS = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)")
_SPECIAL = re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([a-zA-Z][\w:-]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLOCK_BEGINS = re.compile(rf"</?(?:{'|'.join(sorted(BREAKS - {'hr', 'legend', 'optgroup', 'option'}))})[\s/>]", re.I)
_TEXT_BEGINS = re.compile(r"</head\s*>|<(?:body|article|main)[\s>]", re.I)
_RAW_ENDS = {tag: re.compile(rf"</{tag}\s*>", re.I) for tag in RAW}
_RAW_BEGINS = {tag: re.compile(rf"<{tag}[\s>]", re.I) for tag in RAW}
_WORD = re.compile(r"[a-z0-9]+")


def _furniture(names: str, words: set[str]) -> bool:
    """Whether one of the class or id names is made of ``words`` and PLACES: cookie-notice is, has-sidebar is not."""
    for name in names.split():
        parts = set(_WORD.findall(name))
        if parts & words and all(x in words or x in PLACES or x.isdigit() for x in parts):
            return True
    return False


def _kind(tag: str, attributes: str, outer: int) -> int:
    """What an element inside one of kind ``outer`` holds."""
    found: dict[str, str] = {}
    if attributes.strip():
        found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in _ATTRIBUTE.finditer(attributes)}
    role, names = found.get("role"), found.get("class", "") + " " + found.get("id", "")
    if outer == SEALED or "hidden" in found or found.get("aria-hidden") == "true" \
            or "display:none" in found.get("style", "").replace(" ", ""):
        return SEALED
    root = tag in ("html", "body", "main", "article")
    if not root and _furniture(names, COMMENT_WORDS) or (tag == "article" and outer == MAIN and "comment" in names.split()):
        return SEALED
    if tag in SIDES or (role in ROLES and role != "form"):
        return ASIDE
    if tag == "main" or role == "main":
        return MAIN
    if outer == ASIDE:
        return ASIDE
    if role == "form":
        return DROPPED
    if tag == "article" or found.get("itemprop") == "articlebody":
        return MAIN
    if outer == DROPPED or tag == "form" or (not root and _furniture(names, WORDS)):
        return DROPPED
    if outer != MAIN and (tag == "header" or (not root and _furniture(names, {"header"}))):
        return DROPPED
    return outer


class _Source:
    """A page's markup, read forward. No part of it is looked through again and again: what a search that came
    to nothing, or found something far ahead, has learnt holds for all later places up to there."""

    def __init__(self, text: str):
        self.text, self.last_open, self.last_close = text, text.rfind("<"), text.rfind(">")
        self.found: dict[re.Pattern, re.Match | None] = {}
        self.places: list[int] | None = None  # of '>' and quotes, once a tag has no end

    def search(self, pattern: re.Pattern, at: int) -> re.Match | None:
        """The first match from a place on; places never go back."""
        if pattern not in self.found or (last := self.found[pattern]) is not None and last.start() < at:
            self.found[pattern] = pattern.search(self.text, at)
        return self.found[pattern]

    def token(self, at: int) -> tuple[int, int, str, str, str] | None:
        """The next comment, declaration or tag: start, end, slash, name and attributes of a tag."""
        text = self.text
        start = text.find("<", at)
        while start >= 0:
            sign = text[start + 1:start + 2]
            if text.startswith("<!--", start):
                end = text.find("-->", start + 4)
                return start, end + 3 if end >= 0 else len(text), "", "", ""
            if sign in ("!", "?"):
                if self.last_close > start:
                    return start, text.index(">", start) + 1, "", "", ""
            elif begun := _TAG_BEGINS.match(text, start):
                if found := self._tag(start, begun):
                    return start, *found
                if start == self.last_open and self.last_close < start:  # cut off at the page's end
                    return start, len(text), "", "", ""
            start = text.find("<", start + 1)
        return None

    def _tag(self, start: int, begun: re.Match) -> tuple[int, str, str, str] | None:
        if self.places is None:
            if m := _TAG.match(self.text, start):
                return m.end(), m[1], m[2], m[3]
            self._prepare()
        # From quote to quote. A quote or '>' from which one tag found no end gives none to any other.
        k, tried = bisect.bisect_left(self.places, begun.end()), []
        while k < len(self.places) and k not in self.endless:
            tried.append(k)
            if self.text[self.places[k]] == ">":
                return self.places[k] + 1, begun[1], begun[2], self.text[begun.end():self.places[k]]
            k = self.closing[k] + 1
        self.endless.update(tried)
        return None

    def _prepare(self) -> None:
        self.places = [m.start() for m in _SPECIAL.finditer(self.text)]
        self.closing, self.endless = [0] * len(self.places), set()
        following = {"'": len(self.places), '"': len(self.places), ">": 0}
        for k in range(len(self.places) - 1, -1, -1):
            sign = self.text[self.places[k]]
            self.closing[k], following[sign] = following[sign], k

    def raw_end(self, at: int, tag: str, closed: bool) -> int:
        """Where a raw element ends that begins at ``at``: without an end tag of its own at the next block."""
        if closed and tag in ("svg", "math"):
            return at
        end = self.search(_RAW_ENDS[tag], at)
        if tag in ("button", "select"):  # these cannot hold each other, so the end tag may be that of a later one
            again = self.search(_RAW_BEGINS[tag], at)
            end = None if again and end and again.start() < end.start() else end
        if end and not closed:
            return end.end()
        # Blocks in the strings of a script are no blocks.
        block = self.search(_TEXT_BEGINS if tag in ("script", "style") else _BLOCK_BEGINS, at)
        if end and (not block or end.start() < block.start()):
            return end.end()
        return block.start() if block else len(self.text)


class _Open:
    """The elements that are open, innermost last, and where each name was opened last."""

    def __init__(self):
        self.tags: list[str] = [""]
        self.kinds: list[int] = [OUTSIDE]
        self.at: dict[str, list[int]] = defaultdict(list)

    def begin(self, tag: str, kind: int) -> None:
        self.at[tag].append(len(self.tags))
        self.tags.append(tag)
        self.kinds.append(kind)

    def close(self, tag: str, barrier: tuple[str, ...] = ()) -> None:
        """End the innermost element of that name with all inside it, unless a barrier lies between."""
        place = self.at[tag][-1] if self.at.get(tag) else 0
        if not place or any(self.at[b][-1] > place for b in barrier if self.at.get(b)):
            return
        for inner in self.tags[place:]:
            self.at[inner].pop()
        del self.tags[place:], self.kinds[place:]


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """(text, kind) of each block that has text, in page order; in time proportional to the page, whatever it holds."""
    out: list[tuple[str, int]] = []
    opened, buffer, source = _Open(), [], _Source(html or "")

    def flush() -> None:
        if buffer:
            if text := " ".join(entities.unescape("".join(buffer)).split()):
                out.append((text, min(opened.kinds[-1], DROPPED)))
            buffer.clear()

    at = 0
    while token := source.token(at):
        start, end, slash, name, attributes = token
        if start > at:
            buffer.append(source.text[at:start])
        at, tag = end, name.lower()
        if not tag:
            continue
        if tag in BREAKS:
            flush()
        if slash:
            opened.close(tag)
        elif tag in RAW:
            at = source.raw_end(at, tag, attributes.endswith("/"))
        elif tag not in VOID and not attributes.endswith("/"):
            if tag in BREAKS:
                opened.close("p", ("article", "aside", "body", "div", "footer", "form", "main", "nav", "section", "table", "td"))
            if tag == "body":
                opened.close("head")
            if tag == "li":
                opened.close("li", ("ol", "ul", "menu"))
            kind = _kind(tag, attributes, opened.kinds[-1])
            if kind != opened.kinds[-1]:
                flush()
            opened.begin(tag, kind)
    if at < len(source.text):
        buffer.append(source.text[at:])
    flush()
    return out


def _rows(a: list, b: list) -> list[int]:
    """Bit rows of the longest-common-subsequence table: bit j of row i is 0 where b[j] lengthens it."""
    where: dict = defaultdict(int)
    for j, x in enumerate(b):
        where[x] |= 1 << j
    full = (1 << len(b)) - 1
    row, rows = full, [full]
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    return rows


def common_lines(a: list, b: list, cells: int = 1 << 30) -> list[int]:
    """Places in ``a`` of a longest common subsequence of both; tables beyond ``cells`` are split in two."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner_a, inner_b = a[head:len(a) - tail], b[head:len(b) - tail]
    if not inner_a or not inner_b:
        inner = []
    elif len(inner_a) > 1 and len(inner_a) * len(inner_b) > cells:
        half, n = len(inner_a) // 2, len(inner_b)

        def lengths(x: list, y: list) -> np.ndarray:
            row = 0
            for row in _rows_last(x, y):
                pass
            bits = np.frombuffer(format(row, f"0{n}b")[::-1].encode(), np.uint8) == 48
            return np.concatenate([[0], np.cumsum(bits)])

        split = int(np.argmax(lengths(inner_a[:half], inner_b) + lengths(inner_a[half:][::-1], inner_b[::-1])[::-1]))
        inner = common_lines(inner_a[:half], inner_b[:split], cells) + [
            half + i for i in common_lines(inner_a[half:], inner_b[split:], cells)]
    else:
        rows, i, j, inner = _rows(inner_a, inner_b), len(inner_a), len(inner_b), []
        while i and j:
            if inner_a[i - 1] == inner_b[j - 1]:
                i, j = i - 1, j - 1
                inner.append(i)
            elif rows[i] >> (j - 1) & 1:
                j -= 1
            else:
                i -= 1
        inner.reverse()
    return [*range(head), *(head + i for i in inner), *range(len(a) - tail, len(a))]


def _rows_last(a: list, b: list):
    where: dict = defaultdict(int)
    for j, x in enumerate(b):
        where[x] |= 1 << j
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & where.get(x, 0)
        row = ((row + hit) | (row - hit)) & full
        yield row


def _shared_path(a: str, b: str) -> int:
    n = 0
    while n < min(len(a), len(b)) and a[n] == b[n]:
        n += 1
    return n


_SIGNED = "host string, path string, sign binary, lines binary"


def _signed(lines: list[tuple[str, int]]) -> bytes:
    """Eight bytes a line: six of its hash, two of its characters (0 in furniture, 65535 at most)."""
    return b"".join(xxhash.xxh64_digest(t)[:6] + (0 if kind == DROPPED else min(len(t), 65535)).to_bytes(2, "big")
                    for t, kind in lines)


def _sign(batches):
    for batch in batches:
        lines = [_signed(page_lines(page)) for page in batch["html"]]
        yield pd.DataFrame({"host": batch["host"], "path": batch["path"], "lines": lines,
                            "sign": [xxhash.xxh128_digest(x) for x in lines]})


_BODY = "page_id long, url string, host string, sign binary, kinds binary, body binary"


def _bodies(batches):
    for batch in batches:
        out = {"sign": [], "kinds": [], "body": []}
        for page in batch["html"]:
            lines = page_lines(page)
            out["sign"].append(xxhash.xxh128_digest(_signed(lines)))
            out["kinds"].append(bytes(kind for _, kind in lines))
            out["body"].append(zlib.compress("\n".join(t for t, kind in lines if kind != DROPPED).encode("utf-8", "surrogatepass"), 1))
        yield pd.DataFrame({"page_id": _ids(batch), "url": batch["url"], "host": batch["host"], **out})


def _ids(batch: pd.DataFrame):
    return pd.array(batch["page_id"], "string").astype("Int64") if len(batch) else []


def _hashed(raw: bytes) -> list[bytes]:
    return [raw[k:k + 6] for k in range(0, len(raw), 8)]


def _shared(own: pd.Series, others: list[pd.Series]) -> bytes:
    """Bits of the lines that ``own`` shares with the page of ``others`` that has most of its path, the first at a tie."""
    gone = np.zeros(len(own["lines"]) // 8, bool)
    if others:
        other = max(others, key=lambda o: _shared_path(own["path"], o["path"]))
        gone[common_lines(_hashed(own["lines"]), _hashed(other["lines"]))] = True
    return np.packbits(gone).tobytes()


def _weights(raw: bytes) -> dict[bytes, int]:
    out: dict[bytes, int] = defaultdict(int)
    for k in range(0, len(raw), 8):
        out[raw[k:k + 6]] += int.from_bytes(raw[k + 6:k + 8], "big")
    return out


def _near_copies(a: dict[bytes, int], b: dict[bytes, int]) -> bool:
    both = sum(min(n, b.get(x, 0)) for x, n in a.items())
    return both > 0 and both >= COPY * max(sum(a.values()), sum(b.values()))


def _link(key, pages: pd.DataFrame) -> pd.DataFrame:
    """host, place, start: the pages of a block that are near copies of the page before or after them."""
    at = {r["place"]: (r["host"], _weights(r["lines"])) for _, r in pages.iterrows()}

    def linked(place: int) -> bool:  # with the place before
        return place in at and place - 1 in at and at[place][0] == at[place - 1][0] and _near_copies(at[place - 1][1], at[place][1])

    found = [(at[p][0], p, int(not linked(p))) for p in at if p // BLOCK == key[0] and (linked(p) or linked(p + 1))]
    return pd.DataFrame(found, columns=["host", "place", "start"])


def _align(key, pages: pd.DataFrame, runs: pd.DataFrame) -> pd.DataFrame:
    """host, sign, gone: the pages of a block, each aligned with a page of its host before or after its run."""
    at = {r["place"]: r for _, r in pages.iterrows()}
    outer: dict[int, list] = defaultdict(list)
    for _, r in runs.sort_values(["low", "edge"]).iterrows():
        for place in range(max(r["low"], key[0] * BLOCK), min(r["high"], key[0] * BLOCK + BLOCK - 1) + 1):
            outer[place] += [r] if r["lines"] is not None else []
    own = [r for place, r in at.items() if place // BLOCK == key[0]]
    gone = [_shared(r, outer[r["place"]] if r["place"] in outer else [
        o for step in (-1, 1) if (o := at.get(r["place"] + step)) is not None and o["host"] == r["host"]]) for r in own]
    return pd.DataFrame({"host": [r["host"] for r in own], "sign": [r["sign"] for r in own], "gone": gone})


def _finish(batches):
    """Lines that are no furniture and that the page does not share, or that its main element protects."""
    for batch in batches:
        texts = []
        for kinds, body, gone in zip(batch["kinds"], batch["body"], batch["gone"]):
            shared = np.unpackbits(np.frombuffer(gone, np.uint8)) if gone is not None else np.zeros(len(kinds), np.uint8)
            left = [i for i, kind in enumerate(kinds) if kind != DROPPED]
            lines = zlib.decompress(body).decode("utf-8", "surrogatepass").split("\n")
            texts.append("\n".join(t for i, t in zip(left, lines) if kinds[i] == MAIN or not shared[i]))
        yield pd.DataFrame({"page_id": _ids(batch), "url": batch["url"], "text": texts})


def _dealt(placed: DataFrame) -> DataFrame:
    """Rows by blocks of ``BLOCK`` places; the first and last of a block also go to the block next to them."""
    block = [F.floor((F.col("place") + step) / BLOCK) for step in (-1, 0, 1)]
    return placed.withColumn("block", F.explode(F.array_distinct(F.array(*block))))


def _runs(placed: DataFrame) -> DataFrame:
    """block, low, high, edge, path, lines: each run of near copies with the pages around it, in each block it meets.

    A run holds the places low to high; edge is the place before or after it. path and lines are null where
    its host ends.
    """
    links = materialise(_dealt(placed.select("place", "host", "lines")).groupBy("block").applyInPandas(
        _link, "host string, place long, start int"), "links")
    runs = running_sum(links, [], ["place"], "start", "run").groupBy("run", "host").agg(
        F.min("place").alias("low"), F.max("place").alias("high"))
    edges = runs.withColumn("edge", F.explode(F.array(F.col("low") - 1, F.col("high") + 1)))
    around = placed.select(*[F.col(c).alias(n) for c, n in (  # new names: both sides come from ``placed``
        ("place", "edge"), ("host", "host"), ("path", "edge_path"), ("lines", "edge_lines"))])
    blocks = F.sequence(F.floor(F.col("low") / BLOCK), F.floor(F.col("high") / BLOCK))
    return edges.join(around, ["edge", "host"], "left").select(
        F.explode(blocks).alias("block"), "low", "high", "edge",
        F.col("edge_path").alias("path"), F.col("edge_lines").alias("lines"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the main text of each row of ``pages`` (page_id, url, html; other columns unread).

    Blocks have their white space made one space and are joined by a line feed. Null and empty html, and
    pages without any text, give an empty text. Null urls form a host of their own. Pages of a host with
    equal lines are one page, at the least of their paths; pages are neighbours in the order host, path,
    hash of the lines. Of two neighbours the one that shares more of the path counts, at a tie the one before.
    Near copies that follow each other are compared with the pages before and after all of them; where the
    host has no other page, nothing tells their frame from their text, and lines are not deleted for being shared.
    """
    host, path = host_and_path(F.col("url"))
    # Ids travel as text: a null among them would turn the others into floating point.
    rows = pages.select(F.col("page_id").cast("string"), "url", host.alias("host"), path.alias("path"), "html")
    # Only line hashes are sorted and compared; the text moves once, packed, to meet the verdict on its lines.
    distinct = (
        rows.select("host", "path", "html").mapInPandas(_sign, _SIGNED).filter(F.length("lines") > 0)
        .groupBy("host", "sign").agg(F.min("path").alias("path"), F.first("lines").alias("lines")))
    placed = with_dense_id(distinct, ["host", "path", "sign"], "place")
    blocks = _dealt(placed.select("place", "host", "path", "sign", "lines")).groupBy("block")
    verdicts = blocks.cogroup(_runs(placed).groupBy("block")).applyInPandas(_align, "host string, sign binary, gone binary")
    return (
        rows.drop("path").mapInPandas(_bodies, _BODY).join(verdicts, ["host", "sign"], "left")
        .select(F.col("page_id").cast("string"), "url", "kinds", "body", "gone")
        .mapInPandas(_finish, "page_id long, url string, text string"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
