"""Blocks of text from a page's markup: one fold over its tags, linear in the page.

Built-in expressions cannot match an opener with its closer, so this part runs in Arrow batches and
returns plain blocks; which of them stay is decided by column expressions.
"""

from __future__ import annotations

import re
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from pressroom import fixed_values as V

_BLOCK = pa.struct([("text", pa.string()), ("linked", pa.int32()), ("tags", pa.int32())])
_PAGE = pa.struct([("blocks", pa.list_(_BLOCK)), ("paragraphs", pa.list_(pa.string()))])
_PAGE_TYPE = T.StructType([
    T.StructField("blocks", T.ArrayType(T.StructType([
        T.StructField("text", T.StringType()), T.StructField("linked", T.IntegerType()), T.StructField("tags", T.IntegerType()),
    ]))),
    T.StructField("paragraphs", T.ArrayType(T.StringType())),
])

_MARKUP = re.compile(r"<!--|<(/?)([A-Za-z][A-Za-z0-9:-]*)(?=[\s/>])|<[!?]")
_ENTITY = re.compile(r"&(?:#([0-9]{1,7})|#[xX]([0-9A-Fa-f]{1,6})|([A-Za-z][A-Za-z0-9]*));")
_NAMED_BOX = re.compile(
    r"""\s(?:class|id)\s*=\s*(?:"(?:[^"]*[\s_-])?(?:%(names)s)(?:[\s_-][^"]*)?"|'(?:[^']*[\s_-])?(?:%(names)s)(?:[\s_-][^']*)?'|(?:%(names)s)(?=[\s>/]))"""
    % {"names": "|".join(V.DROPPED_CLASSES)},
    re.I,
)
_RAW = {"script", "style"}
_DROPPED = set(V.DROPPED_ELEMENTS)
_BOXES = {"div", "section", "ul"}
_BLOCKS = set(V.BLOCK_ELEMENTS)
#: Attributes looked at for a box's name.
_ATTRIBUTES = 4096


def _character(found: re.Match) -> str:
    decimal, hexadecimal, name = found.groups()
    if name:
        return " " if name == "nbsp" else html5.get(name + ";", found.group())
    code = int(decimal) if decimal else int(hexadecimal, 16)
    return chr(code) if 0 < code <= 0x10FFFF and not 0xD800 <= code <= 0xDFFF else "�"


def unescaped(text: str) -> str:
    """All named and numeric entities that end in a semicolon, each decoded once."""
    return _ENTITY.sub(_character, text) if "&" in text else text


class _Tag:
    __slots__ = ("start", "end", "name", "closing", "to")

    def __init__(self, start: int, end: int, name: str, closing: bool):
        self.start, self.end, self.name, self.closing = start, end, name, closing
        self.to: int | None = None  # for openers: the place after the closer, where it matters


def _tags(page: str) -> list[_Tag]:
    """Tags and comments in order; openers of elements that may go know where their closer ends."""
    out: list[_Tag] = []
    open_: dict[str, list[_Tag]] = {}
    missing: set[str] = set()
    at = 0
    while found := _MARKUP.search(page, at):
        start = found.start()
        if found.group() == "<!--" and "--" not in missing:
            close = page.find("-->", start + 4)
            if close >= 0:
                at = close + 3
                tag = _Tag(start, at, "", False)
                tag.to = at
                out.append(tag)
                continue
            missing.add("--")
        close = page.find(">", found.end())
        if close < 0:
            break
        at = close + 1
        name = (found.group(2) or "").lower()
        tag = _Tag(start, at, name, bool(found.group(1)))
        out.append(tag)
        if name in _RAW and not tag.closing and name not in missing:
            ending = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            if ending:
                at = tag.to = ending.end()
                continue
            missing.add(name)
        if name in _DROPPED or name in _BOXES:
            if tag.closing:
                if open_.get(name):
                    open_[name].pop().to = at
            elif page[close - 1] != "/":
                open_.setdefault(name, []).append(tag)
    return out


def _goes(page: str, tag: _Tag) -> bool:
    if tag.closing or tag.to is None:
        return False
    if tag.name in _BOXES:
        return _NAMED_BOX.search(page, tag.start, min(tag.end, tag.start + _ATTRIBUTES)) is not None
    return True


def _kept(page: str) -> list[_Tag | str]:
    """The page without comments and elements that go, as tags and the text between them."""
    out: list[_Tag | str] = []
    at = 0
    for tag in _tags(page):
        if tag.start < at:
            continue
        if tag.start > at:
            out.append(unescaped(page[at : tag.start]))
        if _goes(page, tag):
            out.append(" ")
            at = tag.to
        else:
            out.append(tag)
            at = tag.end
    out.append(unescaped(page[at:]))
    return out


def _body(parts: list[_Tag | str]) -> list[_Tag | str]:
    """What is between the first opener and the last closer of the article, or else of the main part."""
    for name in ("article", "main"):
        tags = [(i, p.closing) for i, p in enumerate(parts) if not isinstance(p, str) and p.name == name]
        first = next((i for i, closing in tags if not closing), None)
        last = next((i for i, closing in reversed(tags) if closing), None)
        if first is not None and last is not None and last > first + 1:
            return parts[first + 1 : last]
    return parts


def _text_blocks(parts: list[_Tag | str]) -> list[dict]:
    out, text, linked, tags, in_link = [], [], 0, 0, False
    for part in [*parts, None]:
        if isinstance(part, str):
            text.append(part)
            linked += len(part) * in_link
        elif part is None or part.name in _BLOCKS:
            if text:
                out.append({"text": "".join(text), "linked": linked, "tags": tags})
            text, linked, tags, in_link = [], 0, 0, False
        else:
            tags += 1
            if part.name == "a":
                in_link = not part.closing
                linked += in_link
    return out


def _paragraphs(parts: list[_Tag | str]) -> list[str]:
    out, text = [], None
    for part in parts:
        if isinstance(part, str):
            if text is not None:
                text.append(part)
        elif part.name == "p" and part.closing:
            if text is not None:
                out.append("".join(text))
            text = None
        elif text is not None:
            text.append(" ")
        elif part.name == "p":
            text = []
    return out


def read_page(page: str) -> dict:
    """``blocks`` of the body, with the characters that are links and the tags inside, and ``paragraphs``."""
    parts = _kept(page)
    return {"blocks": _text_blocks(_body(parts)), "paragraphs": _paragraphs(parts)}


def _read(pages: pa.Array) -> pa.Array:
    return pa.array([None if p is None else read_page(p) for p in pages.to_pylist()], _PAGE)


def page_parts(html: Column) -> Column:
    """``struct<blocks: array<struct<text, linked, tags>>, paragraphs: array<string>>`` of a page, null for null."""
    return F.arrow_udf(_read, _PAGE_TYPE)(html)
