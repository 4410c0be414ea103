"""A small tolerant HTML reader: events of block elements and their text."""

from __future__ import annotations

import html
import re
import zlib

_OPENING = re.compile(r"<(?:!--|!|\?|/?([A-Za-z][A-Za-z0-9:-]*))")
# The rest of a tag. A quote opens a value only after an equals sign.
_REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')|=)*+)>""")
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
# Elements whose content is not text; void ones; ones inside a line of text;
# and those that an opening of their own kind closes.
RAW = frozenset("script style textarea noscript template svg iframe title".split())
_TO_THE_END = frozenset("script style textarea title".split())  # if nothing closes them
_XHTML = re.compile(r"<\?xml\b|<!DOCTYPE[^>]*\bXHTML\b|<html[^>]*\bxmlns\s*=", re.I)
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark "
                    "q s samp small span strike strong sub sup time tt u var wbr").split())
CLOSES_SELF = frozenset("p li dt dd tr td th option".split())
_LISTS = ("ul", "ol", "dl", "table", "select")
DEEPEST = 512      # elements nested deeper stand at that depth, as in browsers
LONGEST_LABEL = 256
_KEEPS_P = INLINE | {"script", "style", "noscript", "template"}


def _label(name: str, attributes: str) -> str:
    """``name.class#id`` with digits folded, the element's role in a page."""
    found = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), " ".join(v for v in values if v))
    text = name
    for sign, key in ((".", "class"), ("#", "id"), ("@", "role")):
        if found.get(key):
            text += sign + re.sub(r"\d+", "0", ".".join(sorted(found[key].lower().split())))
    if len(text) > LONGEST_LABEL:
        text = f"{text[:LONGEST_LABEL]}~{zlib.crc32(text.encode('utf-8', 'replace'))}"
    return text


def read_page(page: str) -> tuple[list[str], list[tuple[str, str, int]]]:
    """(paths of the elements opened, blocks), in page order. A path joins
    the labels of the open block elements by ``/``; a block is (path, text,
    characters inside links). Text is decoded, white space folded.

    The time is in proportion to the page, whatever stands in it: where a tag
    has quotes that do not end, quotes count no more from there on, and where
    no ``>`` is left, ``<`` is text.

    An element whose content is not text is skipped up to its closing tag. It
    has none if it ends in ``/>`` (``svg``, and any in XHTML); one that is
    never closed takes the rest of the page only if HTML says so."""
    opened: list[str] = []
    blocks: list[tuple[str, str, int]] = []
    names: list[str] = []
    paths: list[str] = []  # of the open elements
    known: dict[tuple[str, str], str] = {}  # equal paths are one string
    where: dict[str, list[int]] = {}  # depths of the open elements of each name
    parts: list[str] = []
    links = depth = 0
    xhtml = bool(_XHTML.search(page[:2000]))
    unclosed: set[str] = set()  # no closing tag from here on
    quotes = True
    last_end = page.rfind(">")

    def flush():
        nonlocal links
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                blocks.append((paths[-1] if paths else "", text, links))
            parts.clear()
        links = 0

    def close(to: int):
        while len(names) > to:
            where[names.pop()].pop()
            paths.pop()

    at, n = 0, len(page)
    while at < n:
        m = _OPENING.search(page, at)
        stop = m.start() if m else n
        if stop > at:
            text = page[at:stop]
            parts.append(text)
            if depth:
                links += len(text.strip())
        if not m:
            break
        if not m[1]:
            mark = "-->" if m[0] == "<!--" else ">"
            end = page.find(mark, m.end())
            at = end + len(mark) if end >= 0 else n
            continue
        at = m.end()
        if at > last_end:
            parts.append(m[0])
            continue
        rest = _REST.match(page, at) if quotes else None
        if rest:
            attributes, at = rest[1], rest.end()
        else:
            quotes, end = False, page.index(">", at)
            attributes, at = page[at:end], end + 1
        name, closing = m[1].lower(), page[m.start() + 1] == "/"
        if name in INLINE:
            if name == "a":
                depth = 0 if closing else 1
            elif name == "br":
                parts.append("\n")
            continue
        flush()
        depth = 0
        if closing:
            if where.get(name):
                close(where[name][-1])
            continue
        if where.get("p") and name not in _KEEPS_P:
            close(where["p"][0])
        if name in CLOSES_SELF and where.get(name):
            last = where[name][-1]
            if not any(where[x][-1] >= last for x in _LISTS if where.get(x)):
                close(last)
        label = _label(name, attributes)
        key = (paths[min(len(paths), DEEPEST - 1) - 1] if paths else "", label)
        path = known.setdefault(key, f"{key[0]}/{label}" if key[0] else label)
        opened.append(path)
        empty = attributes.rstrip().endswith("/")
        if name in RAW:
            if empty and (xhtml or name == "svg") or name in unclosed:
                continue
            end = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            if end or name in _TO_THE_END:
                at = end.end() if end else n
            else:
                unclosed.add(name)
        elif name not in VOID and not empty:
            where.setdefault(name, []).append(len(names))
            names.append(name)
            paths.append(path)
    flush()
    return opened, blocks
