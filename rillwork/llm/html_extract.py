"""Main text of HTML pages, with a suffix array over each host's pages.

A page is cut into blocks, each in a zone: ``article`` (inside an article), ``main`` (inside the
main element), ``chrome`` (menus, headers, footers, sidebars, notices, adverts, forms, scripts,
styles, reader comments, by element or by a class, id or role that says nothing else), ``article?`` and
``main?`` (inside them, but with such a word in a longer name, as in ``related-work``) and ``open`` (none of these).

The tokens of all blocks outside article and main are concatenated to the page's
stream, each token hashed together with its host, and the streams of all pages
go through the hash-compared suffix sort: runs of ``RUN_TOKENS`` tokens or more
that also start in another page of the host are boilerplate. The sort runs
once against smaller and once against larger page ids, so the first page
of a run loses it too. Of blocks in doubt and, on pages with neither article nor main element,
of open blocks the uncovered runs are kept.

The suffix array alone can't give the article: articles share passages
with one another, which must stay, while menus and adverts differ from page to
page. So what the markup says for certain comes first, and the suffix array decides on the rest.

Pages are read twice, once for the streams and once for the texts, which cost more to keep on
disk than to read again; the texts meet the suffix array's answer compressed.

A page is read in one pass from left to right whatever is broken in it. A tag ends at the first > outside quotes,
or at the first > where quotes never close.

Defined results: null or empty html gives an empty text; a page without open or
main blocks too; rows that repeat an id and html get equal texts; of rows
that repeat an id with other html, one stands for the page in its host's suffix
array and the others lose nothing to it; pages without an id lose nothing and remove nothing; a null
url is a host of its own; an empty table gives an empty result; further
columns of the input are ignored.
"""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillwork.llm.common import materialize
from rillwork.llm.suffix_dedup import remove_repeats

RUN_TOKENS = 10
_TOKEN_CHARS = 5
_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_"

#: Elements by what HTML says of them.
_BLOCKS = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody tfoot thead tr ul".split())
_SPACES = frozenset("br td th".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CHROME = frozenset("aside button dialog footer form head header iframe menu nav noscript object select svg template textarea title".split())
_IN_PARAGRAPH = frozenset("p b i em strong span a u small".split())
_HINTS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent cookie cookies disclaimer footer gdpr header hidden "
    "masthead menu menubar modal nav navbar navigation newsletter notice notices pagination paywall popup promo promotion related share sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split()
)
#: Words that leave a hint beside them as it is.
_FILLERS = frozenset(
    "area articles author bar block body bottom box button buttons container content form global group icons inline inner item items left link links list main message msg outer page panel policy posts primary reader "
    "replies reply right secondary section site slot stories text thread top unit user wrap wrapper".split()
)
_CONTENT_WORDS = frozenset(("header", "hidden"))  # no hints inside an article
_NEVER_HINTED = frozenset(("html", "body", "main"))
_SECTIONS = frozenset(("article", "main", "body"))

_ATTRIBUTE = re.compile(r"""([^\s=/"']+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"']+))?""")
_HINT_WORD = re.compile(r"[a-z]+|[A-Z](?:[a-z]+|[A-Z]*)")
_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_PLAIN = re.compile(r"""([^<]*+)<(/?)([a-zA-Z][^\s/<>]*+)((?:[^<>"']|"[^<>"]*+"|'[^<>']*+')*+)>""")  # text and a tag without stray marks
_STOP = re.compile(r"[>\"']")
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in "script style textarea title noscript template xmp".split()}
_MAIN_ROLE = re.compile(r"role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articleBody", re.I)
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


def _pieces(page: str) -> Iterator[tuple[str | None, str, str]]:
    """``(None, text, "")``, ``(name, "/", "")`` of end tags and ``(name, "", attributes)`` of others, in order; in time linear in the page."""
    at, first, size = 0, -1, len(page)
    slack = 4 * size  # characters that quotes which never close may cost
    while at < size:
        plain = _PLAIN.match(page, at)
        if plain:
            text, slash, name, value = plain.groups()
            if text:
                yield None, text, ""
            at = plain.end()
        else:
            start = page.find("<", at)
            if start < 0:
                yield None, page[at:], ""
                return
            if start > at:
                yield None, page[at:start], ""
            if page.startswith("<!--", start) or page.startswith("<![CDATA[", start):
                mark, skip = ("-->", 4) if page[start + 2] == "-" else ("]]>", 9)
                end = page.find(mark, start + skip)
                at = size if end < 0 else end + 3
                continue
            if first < start:
                first = page.find(">", start)
            if first < 0:  # no more tags
                yield None, page[start:], ""
                return
            if page[start + 1] in "!?":
                at = first + 1
                continue
            found = _NAME.match(page, start + 1)
            if not found:
                yield None, "<", ""
                at = start + 1
                continue
            pos, end = found.end(), first
            while slack > 0:
                stop = _STOP.search(page, pos)
                if stop and stop[0] == ">":
                    end = stop.start()
                    break
                close = page.find(stop[0], stop.end()) if stop else -1
                if close < 0:
                    slack -= size - found.end()
                    break
                pos = close + 1
            (slash, name), value, at = found.groups(), page[found.end() : end], end + 1
        name = name.lower()
        yield name, slash, value
        if not slash and name in _RAW_END:
            closed = _RAW_END[name].search(page, at)
            at = closed.end() if closed else size
            yield name, "/", ""


def _hinted(name: str, attributes: str, inside: bool) -> str | None:
    """``chrome`` where an element's attributes call it so, ``doubt`` where they may. inside: in an article or main element."""
    if not attributes or name in _NEVER_HINTED:
        return None
    doubt = None
    for key, value in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "chrome"
        if key == "style" and _UNSEEN.search(value):
            return "chrome"
        if key == "role" and value.lower() in ("complementary", "contentinfo", "search", "alert"):
            return "chrome"
        for token in value.split() if key in ("class", "id", "role") else ():
            own = {w.lower() for w in _HINT_WORD.findall(token)}
            hints = own & _HINTS - (_CONTENT_WORDS if inside else frozenset())
            if hints and own <= _HINTS | _FILLERS:
                return "chrome"
            if hints:
                doubt = "doubt"
    return doubt


def blocks(page: str | None) -> list[tuple[str, str]]:
    """``(zone, text)`` of each block in page order, white space as one space; zones: article, main, chrome, open, and article? and main? in doubt."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # open elements, and the zone that holds inside them
    opened: list[Counter] = [Counter()]  # their names, section by section
    sections: Counter = Counter()

    def flush() -> None:
        text = " ".join("".join(held).split())
        held.clear()
        if text:
            out.append((stack[-1][1] if stack else "open", text))

    def pop() -> None:
        name, zone = stack[-1]
        if zone != (stack[-2][1] if len(stack) > 1 else "open"):
            flush()
        stack.pop()
        if name in _SECTIONS:
            opened.pop()
            sections[name] -= 1
        else:
            opened[-1][name] -= 1

    for name, kind, value in _pieces(page or ""):
        if name is None:
            held.append(html.unescape(kind) if "&" in kind else kind)
            continue
        if kind:
            if name in _BLOCKS or name in _CHROME:
                flush()
            elif name in _SPACES:
                held.append(" ")
            if name == "html":  # ends with the page
                continue
            # A stray end tag closes nothing beyond its section.
            if (sections if name in _SECTIONS else opened[-1])[name] > 0:
                while stack[-1][0] != name:
                    pop()
                pop()
            continue
        if name in _BLOCKS or name in _CHROME:
            flush()
            while stack and stack[-1][0] in _IN_PARAGRAPH and name in _BLOCKS and any(n == "p" for n, _ in stack[-8:]):
                pop()  # a block ends an open paragraph
        elif name in _SPACES:
            held.append(" ")
        if name in _VOID or value.endswith("/") and name in ("svg", "path"):
            continue
        zone = stack[-1][1] if stack else "open"
        inside = zone
        if zone != "chrome":
            hint = _hinted(name, value, zone != "open")
            if hint == "chrome" or name in _CHROME and not (name == "header" and zone != "open"):
                inside = "chrome"
            elif hint and zone != "open":
                inside = zone.rstrip("?") + "?"
            elif name == "article" and not zone.endswith("?"):
                inside = "article"
            elif zone == "open" and (name == "main" or _MAIN_ROLE.search(value)):
                inside = "main"
        if inside != zone:
            flush()
        stack.append((name, inside))
        if name in _SECTIONS:
            opened.append(Counter())
            sections[name] += 1
        else:
            opened[-1][name] += 1
    flush()
    return out


def host_of(url: str | None) -> str:
    found = re.match(r"\s*(?:[a-zA-Z][\w+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


def _stream(host: str, tokens: list[str]) -> str:
    """Each token as ``_TOKEN_CHARS`` characters of its hash with the host."""
    seed, out = xxhash.xxh3_64_intdigest(host.encode()), []
    for t in tokens:
        h = xxhash.xxh3_64_intdigest(t.encode(), seed)
        out.append("".join(_DIGITS[h >> 6 * k & 63] for k in range(_TOKEN_CHARS)))
    return "".join(out)


def _laid_out(page: str | None) -> tuple[list[str], list[int], list[str]]:
    """A page's candidate blocks, where each starts in the page's stream (-1: it is kept whole), and the stream's tokens."""
    found = blocks(page)
    zones = {z.rstrip("?") for z, _ in found}
    best = "article" if "article" in zones else "main" if "main" in zones else None
    texts, places, tokens = [], [], []
    for zone, text in found:
        if zone in ("article", "main"):
            if zone == best:
                texts.append(text)
                places.append(-1)
            continue
        if zone == f"{best}?" or zone == "open" and not best:
            texts.append(text)
            places.append(len(tokens))
        tokens += text.split(" ")
    return texts, places, tokens


def _streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        streams = [_stream(host_of(url), _laid_out(page)[2]) for url, page in zip(b["url"].to_pylist(), b["html"].to_pylist())]
        yield pa.RecordBatch.from_arrays([b["page_id"], b["__th"], pa.array(streams, pa.string())], ["page_id", "__th", "stream"])


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=3)
    for b in batches:
        out = [pack.compress(json.dumps(_laid_out(page)[:2]).encode()) for page in b["html"].to_pylist()]
        yield pa.RecordBatch.from_arrays([b["page_id"], b["url"], b["__th"], pa.array(out, pa.binary())], ["page_id", "url", "__th", "packed"])


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor()
    for b in batches:
        texts, gone_of = [], []
        for packed, spans in zip(b["packed"].to_pylist(), b["spans"].to_pylist()):
            gone: set[int] = set()
            for part in spans or []:
                for lo, hi in np.frombuffer(part or b"", "<i8").reshape(-1, 2).tolist():
                    gone.update(range(-(-lo // _TOKEN_CHARS), hi // _TOKEN_CHARS))
            gone_of.append(len(gone))
            kept = []
            for text, at in zip(*json.loads(unpack.decompress(packed))):
                if at >= 0 and gone:
                    text = " ".join(t for k, t in enumerate(text.split(" "), at) if k not in gone)
                if text:
                    kept.append(text)
            texts.append("\n\n".join(kept))
        yield pa.RecordBatch.from_arrays(
            [b["page_id"], b["url"], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(gone_of, pa.int64())], ["page_id", "url", "text", "n_chars", "n_repeated"]
        )


def main_text(pages: DataFrame, run_tokens: int = RUN_TOKENS) -> DataFrame:
    """``(page_id, url, text, n_chars, n_repeated)``, a row per input row.

    ``n_repeated`` counts the tokens outside article and main that the host's suffix array covers.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"), F.xxhash64("url", "html").alias("__th"))
    streams = rows.where("page_id is not null").mapInArrow(_streams, "page_id long, __th long, stream string")
    one = streams.groupBy("page_id").agg(F.min(F.struct("__th", "stream")).alias("s"))
    one = materialize(one.select("page_id", F.col("s.__th").alias("__sh"), F.col("s.stream").alias("stream")), "streams")
    spans = []
    for sign in (1, -1):
        signed = one.select((F.col("page_id") * sign).alias("doc_id"), F.col("stream").alias("text"))
        found = remove_repeats(signed, length=run_tokens * _TOKEN_CHARS).where("n_removed > 0")
        spans.append(found.select((F.col("doc_id") * sign).alias("__id"), "spans"))
    covered = spans[0].unionByName(spans[1]).groupBy("__id").agg(F.collect_list("spans").alias("spans"))
    covered = covered.join(one.select(F.col("page_id").alias("__id"), "__sh"), "__id")
    packed = rows.mapInArrow(_packed, "page_id long, url string, __th long, packed binary")
    on = (packed["page_id"] == covered["__id"]) & (packed["__th"] == covered["__sh"])
    joined = packed.join(covered, on, "left").select("page_id", "url", "packed", "spans")
    return joined.mapInArrow(_finished, "page_id long, url string, text string, n_chars long, n_repeated long")
