"""Main text of web pages by inferring a wrapper per host: a regular expression without unions.

A page is a stream of block tags and texts; tags inside a line, comments, scripts and styles are not
part of it, and end tags that may be left out (of p, li, ...) are dropped. The streams of a host's
pages are aligned one after another, those that hold an article apart from those that do not. A
wrapper is a sequence of elements, each a tag, a text slot or a repeated group, mandatory or
optional; a mismatch becomes

* a repeated group, if the stream holds a group's body once or several times in a row,
* a text slot, if texts differ,
* an optional element otherwise.

Slots are named by the blocks around them. Texts in menus, headers, footers, sidebars, notices,
adverts, forms and comments have no slot. A block is one of these by its tag, or by a class, id or
role that names one (``site-header``, ``comments``; not ``no-sidebar`` or ``main-content``); words
that an article may use as well (``related work``) count only outside it and only alone.

A page's text is what stands in the slots that the wrapper of its host and kind names. In the wrapper
of pages with text in an article (or main) block these are all slots of that block. For the other
pages of a host the wrapper knows, per slot, how much text they hold there and whether it is the same
on all of them. Slots that hold one text on three or more different pages are left out (copies of a
page count once); of the others those in the deepest block with most of the text are taken, with the
headings, paragraphs, quotations, tables and figures beside it.

Pages are folded to their streams, equal streams are counted and those of a batch aligned where they
are read, so that a host with a third of all pages sends a row per batch; these are aligned in salted
parts, in two levels. The slots of a host are a short list, stored before it is joined to the pages.

Defined results: null or empty pages have an empty text; a page whose address is null or unreadable
is a host by itself, with its copies; repeated rows get equal texts; an empty table gives no rows. A
tag that never ends is text, a quote that never ends is part of its tag, a comment, script or style
that never ends goes on to the end of the page.
"""

from __future__ import annotations

import bisect
import functools
import html as entities
import json
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
STOP = re.compile(r"[>\"']")
NAME = re.compile(r"""(?<![\w-])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", re.I)
LONG_NUMBER = re.compile(r"&#0*(\d+)")
#: Their content is never text. The first two swallow the rest of a page if they do not end.
RAW = frozenset("script style noscript template iframe title textarea svg object".split())
SWALLOWS = frozenset(("script", "style"))
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img input area base col embed link meta param source track".split()
)
IMPLIED = frozenset("p li dt dd tr td th thead tbody tfoot option".split())
#: A tag that opens while one of these is open ends it first.
ENDS = {"li": ("li", "p"), "dt": ("dt", "dd", "p"), "dd": ("dt", "dd", "p"), "tr": ("tr", "td", "th", "p"), "td": ("td", "th", "p"), "th": ("td", "th", "p"), "option": ("option",)}
ASIDE_TAGS = frozenset("nav header footer aside form button select menu dialog head fieldset".split())
ASIDE_NAMES = frozenset(
    "ad ads advert adverts advertisement banner sponsored promo nav navbar navigation menu breadcrumb breadcrumbs header "
    "masthead footer sidebar aside notice notices cookie cookies consent popup modal alert comment comments reply replies "
    "newsletter subscribe login form widget toolbar contentinfo complementary".split()
)
#: These name a part of an article as often as a part of the page around it.
WEAK_NAMES = frozenset("related search share sharing social discussion header banner notice notices form alert reply replies".split())
#: Words that say where or how, beside a name: site-header, ad-slot, sidebar-left.
BESIDE = frozenset(
    "site page top bottom left right main primary secondary global box block wrapper wrap container area list section bar "
    "unit slot post article links link item items inner outer holder panel thread".split()
)
#: An article that is a reader's comment or an advert.
FOREIGN = frozenset("comment comments reply replies ad ads advert advertisement".split())
MAIN = ("article", "main")
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre figure table dl".split())
#: Paths deeper than this go on with a digest of the rest.
DEEP = 48
#: Stretches without a common anchor and with more comparisons than this count as a mismatch.
STRETCH = 250_000


def tokens(html: str) -> Iterator[tuple[str, str]]:
    """("", text), (name, attributes) and ("/" + name, "") in one pass over the page."""
    at, n = 0, len(html)
    last = {q: html.rfind(q) for q in "\"'>"}
    quotes = True
    endless: set[str] = set()
    while at < n:
        start = html.find("<", at)
        if start < 0:
            yield "", html[at:]
            return
        if start > at:
            yield "", html[at:start]
        if html.startswith("<!--", start):
            end = html.find("-->", start + 2)
            if end < 0:
                return
            at = end + 3
            continue
        m = TAG.match(html, start + 1)
        if start > last[">"] or not (m or html[start + 1 : start + 2] in ("!", "?", "/")):
            yield "", "<"
            at = start + 1
            continue
        if not m:
            at = html.find(">", start) + 1
            continue
        end, seek = -1, m.end()
        while quotes and end < 0:
            stop = STOP.search(html, seek)
            if stop is None:
                # Ends inside a value: from here on the page's quotes are not trusted.
                quotes = False
            elif stop[0] == ">":
                end = stop.start()
            else:
                before = stop.start() - 1
                while html[before].isspace():
                    before -= 1
                opens = html[before] == "=" and stop.start() < last[stop[0]]
                seek = html.find(stop[0], stop.end()) + 1 if opens else stop.end()
        if end < 0:
            end = html.find(">", m.end())
        name, attributes, at = m[2].lower(), html[m.end() : end], end + 1
        if m[1]:
            yield f"/{name}", ""
        elif name in RAW:
            if attributes.endswith("/") and name == "svg" or name in endless:
                continue
            close = re.compile(rf"</{name}(?=[\s/>]|$)", re.I).search(html, at)
            if close:
                end = html.find(">", close.end())
                at = end + 1 if end >= 0 else n
            elif name in SWALLOWS:
                return
            else:
                endless.add(name)
        else:
            yield name, attributes


def plain(text: str) -> list[str]:
    """Words of a text, its character references decoded."""
    if "&" in text:
        text = LONG_NUMBER.sub(lambda m: f"&#{m[1]}" if len(m[1]) < 8 else "&#9999999", text)
        text = entities.unescape(text)
    return text.split()


def aside(tag: str, names: list[str], in_main: bool) -> bool:
    """Whether a block with these classes, ids and roles is not part of the main text."""
    if tag in ASIDE_TAGS:
        return True
    if tag in ("html", "body", "main"):
        return False
    parts = [[w for w in re.split(r"[_-]+", name) if w] for name in names]
    if tag == "article":
        return any(len(p) == 1 and p[0] in FOREIGN for p in parts)
    strong = ASIDE_NAMES - WEAK_NAMES if in_main else ASIDE_NAMES
    if any(not strong.isdisjoint(p) and all(w in strong or w in BESIDE for w in p) for p in parts):
        return True
    every = {w for p in parts for w in p}
    return not in_main and not every.isdisjoint(WEAK_NAMES) and every <= ASIDE_NAMES | WEAK_NAMES | BESIDE


def blocks(html: str) -> list[tuple[str, str]]:
    """The stream of a page: ("tag", name), ("end", name) and (slot, text) in order.

    A slot inside an article or main block starts with ``*``. Inside blocks that are not part of the
    main text there are neither slots nor tags.
    """
    out: list[tuple[str, str]] = []
    # Per open block: tag, path, whether it is aside, whether it is inside an article.
    stack: list[tuple[str, str, bool, bool]] = []
    opened: Counter[str] = Counter()
    text: list[str] = []

    def flush() -> None:
        if text:
            _, path, off, inside = stack[-1] if stack else ("", "", False, False)
            words = [] if off else plain("".join(text))
            text.clear()
            if words:
                out.append(("*" * inside + path, " ".join(words)))

    def close() -> None:
        opened[stack.pop()[0]] -= 1

    for tag, attributes in tokens(html):
        if not tag:
            text.append(attributes)
            continue
        if tag.lstrip("/") in INLINE:
            continue
        if tag in ("br", "/br"):
            text.append("\n")
            continue
        flush()
        if tag[0] == "/":
            tag = tag[1:]
            off = bool(stack) and stack[-1][2]
            if opened[tag] > 0:
                while stack[-1][0] != tag:
                    close()
                close()
            if tag not in IMPLIED and not off:
                out.append(("end", tag))
            continue
        ended = ENDS.get(tag, ("p",))
        while stack and stack[-1][0] in ended:
            close()
        if tag == "hr":
            continue
        names = sorted({re.sub(r"[\d.>~]+", "", w) for found in NAME.findall(attributes) for w in "".join(found).lower().split()} - {""})
        _, path, off, inside = stack[-1] if stack else ("", "", False, False)
        name = ".".join([tag, *names])
        inside = inside or tag in MAIN
        if not off:
            out.append(("tag", name))
            off = aside(tag, names, inside)
        if not attributes.rstrip().endswith("/"):
            if len(stack) < DEEP:
                path = f"{path}>{name}" if path else name
            else:
                rest, _, chain = path.partition("~")
                path = f"{rest}~{zlib.crc32(f'{chain}>{name}'.encode('utf-8', 'surrogatepass')):08x}"
            stack.append((tag, path, off, inside))
            opened[tag] += 1
    flush()
    return out


def fold(stream: list[tuple[str, str]]) -> list:
    """Tags and slots with groups that repeat in a row folded to ["+", body]; short bodies first."""
    items: list = [("/" if k == "end" else "") + v if k in ("tag", "end") else "#" + k for k, v in stream]
    for period in range(1, 9):
        out, at = [], 0
        while at < len(items):
            body, n = items[at : at + period], 1
            while len(body) == period and items[at + n * period : at + (n + 1) * period] == body:
                n += 1
            if n > 1 and any(isinstance(x, list) or x.startswith("#") for x in body):
                out.append(["+", body])
                at += n * period
            else:
                # No body that starts inside a run without slots holds one.
                passed = (n - 1) * period + 1
                out += items[at : at + passed]
                at += passed
        items = out
    return items


def align(wrapper: list, page: list) -> list:
    """The wrapper of both: rows [element, optional]."""

    def grouped(items: list, groups: list) -> list:
        """A group's body that stands once is the group as well."""
        for group in groups:
            body, out, at = group[1], [], 0
            while at < len(items):
                part = [e for e, _ in items[at : at + len(body)]]
                if part == body:
                    out.append([group, any(o for _, o in items[at : at + len(body)])])
                    at += len(body)
                else:
                    out.append(items[at])
                    at += 1
            items = out
        return items

    groups = [e for e, _ in [*wrapper, *page] if isinstance(e, list)]
    groups = list({json.dumps(g): g for g in groups}.values())
    wrapper, page = grouped(wrapper, groups), grouped(page, groups)
    a, b = [json.dumps(e) for e, _ in wrapper], [json.dumps(e) for e, _ in page]
    out = []
    for i, ii, j, jj in _stretches(a, b):
        if a[i:ii] == b[j:jj]:
            out += [[e, o or p] for (e, o), (_, p) in zip(wrapper[i:ii], page[j:jj], strict=True)]
        else:
            seen = set(a[i:ii])
            out += [[e, True] for e, _ in wrapper[i:ii]]
            out += [[e, True] for (e, _), name in zip(page[j:jj], b[j:jj], strict=True) if name not in seen]
    return out


def _stretches(a: list[str], b: list[str]) -> Iterator[tuple[int, int, int, int]]:
    """Alike and unlike stretches of both in order, cut at elements that stand once in either."""
    in_a, in_b = Counter(a), Counter(b)
    place = {e: j for j, e in enumerate(b) if in_b[e] == 1}
    # The longest run of common single elements that is in order on both sides.
    tails: list[int] = []
    chain: list[tuple[int, int, int]] = []
    of_tail: list[int] = []
    for i, e in enumerate(a):
        if in_a[e] == 1 and e in place:
            n = bisect.bisect_left(tails, place[e])
            chain.append((i, place[e], of_tail[n - 1] if n else -1))
            tails[n : n + 1] = [place[e]]
            of_tail[n : n + 1] = [len(chain) - 1]
    anchors, at = [], of_tail[-1] if of_tail else -1
    while at >= 0:
        anchors.append(chain[at][:2])
        at = chain[at][2]
    i = j = 0
    for ii, jj in [*reversed(anchors), (len(a), len(b))]:
        if (ii - i) * (jj - j) <= STRETCH:
            for _, p, pp, q, qq in SequenceMatcher(None, a[i:ii], b[j:jj], autojunk=False).get_opcodes():
                yield i + p, i + pp, j + q, j + qq
        else:
            yield i, ii, j, jj
        if ii < len(a):
            yield ii, ii + 1, jj, jj + 1
        i, j = ii + 1, jj + 1


def slots(elements: list) -> set[str]:
    found = set()
    for e in elements:
        found |= slots(e[1]) if isinstance(e, list) else {e[1:]} if e.startswith("#") else set()
    return found


def main_slots(wrapper: list, facts: dict[str, list]) -> set[str]:
    """The slots of the main text of one kind of page: those of the article, where the wrapper has one.

    ``facts``: slot -> [characters, least and largest text hash, up to three hashes of pages].
    """
    held = {s for s in slots([e for e, _ in wrapper]) if s in facts}
    if article := {s for s in held if s.startswith("*")}:
        return article
    held = {s for s in held if facts[s][1] != facts[s][2] or len(facts[s][3]) < 3}
    mass: dict[str, int] = {}
    for s in held:
        path = s.split(">")
        for n in range(1, len(path) + 1):
            block = ">".join(path[:n])
            mass[block] = mass.get(block, 0) + facts[s][0]
    # The deepest block that still holds most of the text.
    whole = sum(facts[s][0] for s in held)
    best = max((b for b in mass if 10 * mass[b] >= 7 * whole), key=lambda b: (b.count(">"), b), default="")
    if PROSE.union(IMPLIED).intersection([best.rpartition(">")[2].partition(".")[0]]):
        best = best.rpartition(">")[0]
    around = best.rpartition(">")[0]
    found = set()
    for s in held:
        beside = s[len(around) :] if not around or s.startswith(f"{around}>") else ""
        prose = any(b.partition(".")[0] in PROSE for b in beside.split(">"))
        if not best or s == best or s.startswith(f"{best}>") or prose:
            found.add(s)
    return found


def _add(facts: dict[str, list], slot: str, chars: int, low: int, high: int, pages: list[int]) -> None:
    old = facts.setdefault(slot, [0, low, high, []])
    facts[slot] = [old[0] + chars, min(old[1], low), max(old[2], high), sorted({*old[3], *pages})[:3]]


def _one(rows: list[tuple[str, str]]) -> tuple[str, str]:
    """One wrapper of all rows (wrapper, facts), aligned in a fixed order, with the facts of all."""
    wrapper, facts, seen = None, {}, None
    for text, fact in sorted(rows):
        for slot, values in json.loads(fact).items():
            _add(facts, slot, *values)
        if text != seen:
            own = json.loads(text)
            wrapper = own if wrapper is None else align(wrapper, own)
        seen = text
    return json.dumps(wrapper), json.dumps(facts)


def _merge(table: pa.Table) -> pa.Table:
    wrapper, facts = _one(list(zip(*(table.column(c).to_pylist() for c in ("wrapper", "facts")), strict=True)))
    first = [[table.column(c)[0].as_py()] for c in ("host", "article")]
    return pa.table([*first, [wrapper], [facts]], ["host", "article", "wrapper", "facts"])


def _crc(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def wrappers(pages: DataFrame) -> DataFrame:
    """Rows (host, article, wrapper, facts) of ``pages`` (host, html): one per host and kind of page."""

    def fold_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[str, bool], dict[str, dict]] = {}
            for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                stream = blocks(html or "")
                texts: dict[str, list[str]] = {}
                for kind, text in stream:
                    if kind not in ("tag", "end"):
                        texts.setdefault(kind, []).append(text)
                article = any(slot.startswith("*") for slot in texts)
                folded = json.dumps([[e, False] for e in fold(stream)])
                facts = found.setdefault((host, article), {}).setdefault(folded, {})
                own = _crc("\n".join(t for kind, t in stream if kind not in ("tag", "end")))
                for slot, held in texts.items():
                    crc = _crc(" ".join(held))
                    _add(facts, slot, sum(map(len, held)), crc, crc, [own])
            rows = [(*key, *_one([(w, json.dumps(f)) for w, f in own.items()])) for key, own in found.items()]
            columns = list(zip(*rows, strict=True)) or [[]] * 4
            kinds = (pa.string(), pa.bool_(), pa.string(), pa.string())
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["host", "article", "wrapper", "facts"])

    kind = "host string, article boolean, wrapper string, facts string"
    met = pages.select("host", "html").mapInArrow(fold_pages, kind)
    for parts in (256, 16):
        part = F.pmod(F.xxhash64("wrapper", "facts"), F.lit(parts))
        met = met.groupBy("host", "article", part.alias("part")).applyInArrow(_merge, kind)
    return met.groupBy("host", "article").applyInArrow(_merge, kind)


@functools.lru_cache(256)
def _known(main: str) -> frozenset[str]:
    return frozenset(json.loads(main))


def chosen_slots(pages: DataFrame) -> DataFrame:
    """Rows (host, in_article, without) of ``pages`` (host, html): the main slots of either kind of page, as JSON."""

    @F.pandas_udf("string")
    def choose(wrapper: pd.Series, facts: pd.Series) -> pd.Series:
        return pd.Series(
            [json.dumps(sorted(main_slots(json.loads(w), json.loads(f)))) for w, f in zip(wrapper, facts, strict=True)],
            dtype=object,
        )

    named = wrappers(pages).select("host", "article", choose("wrapper", "facts").alias("main"))
    return named.groupBy("host").agg(
        F.max(F.when(F.col("article"), F.col("main"))).alias("in_article"),
        F.max(F.when(~F.col("article"), F.col("main"))).alias("without"),
    )


def extract(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``text`` and ``n_chars``."""
    address, body = F.coalesce(F.col(url), F.lit("")), F.coalesce(F.col(html), F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]+)", 1))
    # A page that has no host is one by itself; no host's name holds a blank.
    host = F.when(host == "", F.concat(F.lit("page "), F.md5(body.cast("binary")))).otherwise(host)
    # Written, so that its size is known: small lists are broadcast, others met by host, hot hosts split.
    known = cut_lineage(
        chosen_slots(pages.select(host.alias("host"), F.col(html).alias("html"))).toDF("_host", "_in_article", "_without")
    )
    named = pages.drop("text", "n_chars").withColumn("_host", host).withColumn("_html", F.col(html))

    @F.pandas_udf("string")
    def main_text(html: pd.Series, in_article: pd.Series, without: pd.Series) -> pd.Series:
        out = []
        for page, *kinds in zip(html, in_article, without, strict=True):
            texts = [(kind, t) for kind, t in blocks(page or "") if kind not in ("tag", "end")]
            # The slots that the wrapper of the page's host and kind names.
            main = kinds[0 if any(kind.startswith("*") for kind, _ in texts) else 1]
            out.append(" ".join(t for kind, t in texts if main and kind in _known(main)))
        return pd.Series(out, dtype=object)

    return (
        named.join(known, "_host", "left")
        .withColumn("text", main_text("_html", "_in_article", "_without"))
        .withColumn("n_chars", F.length("text").cast("long"))
        .drop("_host", "_html", "_in_article", "_without")
    )
