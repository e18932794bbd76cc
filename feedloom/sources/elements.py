"""Irregular HTML as element intervals.

A page becomes a row of its text and its elements: every element has the numbers of its first
and last token (``start``, ``end``), its depth, tag, attributes, the start of its parent, its
place among its parent's children (of all tags, and of its own), and the span of its text in
the page's text. Nested repeats, nth children and ``:has`` are then comparisons of intervals in
Spark. The small tokenizer below only decides where an element ends when its end tag is missing.

Defined results: tags and attribute names are lower-cased, of a repeated attribute the first
counts; comments, declarations, scripts and styles hold no elements and no text; end tags without
an open element are left out; what is open at the end of the page ends there. Null and empty
pages have no elements. Text has its character references decoded, white space is kept.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Sequence
from html import unescape
from sys import intern

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_package

ELEMENT = ("struct<start:int,end:int,depth:int,tag:string,attrs:map<string,string>,parent:int,nth:int,nth_of_tag:int,"
           "text_from:int,text_to:int>")
# comments, declarations and whole scripts, then tags with quoted values, then text
_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(script|style)\b(?:[^>"']|"[^"]*"|'[^']*')*>.*?(?:</\1\s*>|\Z)"""
                    r"""|<(/?)([a-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|([^<]+|<)""", re.I | re.S)
_ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
# Fixed values of the HTML standard: elements without content, ...
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# ... start tags that end an open p, ...
ENDS_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main "
                   "menu nav ol p pre section table ul".split())
# ... and elements that the start of a sibling ends: (what ends, where the search stops).
_CELLS, _ROWS, _PARTS = {"td", "th"}, {"tr"}, {"thead", "tbody", "tfoot"}
ENDS: dict[str, tuple[set[str], set[str]]] = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": (_CELLS, {"table", "tr"}), "th": (_CELLS, {"table", "tr"}), "tr": (_CELLS | _ROWS, {"table"} | _PARTS),
    **{t: (_CELLS | _ROWS | _PARTS, {"table"}) for t in _PARTS}, "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}), **{t: ({"p"}, {"button", "td", "th", "table", "li"}) for t in ENDS_P}}


_KIND = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("depth", pa.int32()), ("tag", pa.string()), ("attrs", pa.map_(pa.string(), pa.string())),
                   ("parent", pa.int32()), ("nth", pa.int32()), ("nth_of_tag", pa.int32()), ("text_from", pa.int32()), ("text_to", pa.int32())])


class _Columns:
    """The elements of some pages, a packed column for each field: as Python objects they would take many times the room."""

    def __init__(self) -> None:
        self.ints = {f.name: array("i") for f in _KIND if pa.types.is_integer(f.type)}
        self.tags: list[str] = []
        self.names: list[str] = []
        self.values: list[str] = []
        self.attrs_to = array("i", [0])  # where the attributes of each element end

    def __len__(self) -> int:
        return len(self.tags)

    def row(self, i: int) -> dict:
        at = slice(self.attrs_to[i], self.attrs_to[i + 1])
        own = {"tag": self.tags[i], "attrs": list(zip(self.names[at], self.values[at], strict=True))}
        return {f.name: own[f.name] if f.name in own else self.ints[f.name][i] for f in _KIND}

    def lists(self, upto: array) -> pa.ListArray:
        """An array of the elements of each page, of which ``upto`` has the numbers where they end."""
        plain = lambda a: pa.Array.from_buffers(pa.int32(), len(a), [None, pa.py_buffer(a)])
        own = {"tag": pa.array(self.tags, pa.string()), "attrs": pa.MapArray.from_arrays(
            plain(self.attrs_to), pa.array(self.names, pa.string()), pa.array(self.values, pa.string()))}
        rows = pa.StructArray.from_arrays([own[f.name] if f.name in own else plain(self.ints[f.name]) for f in _KIND], fields=list(_KIND))
        return pa.ListArray.from_arrays(plain(upto), rows)


def _parse(html: str | None, out: _Columns) -> str:
    """The text of one page; its elements, in document order, are added to ``out``."""
    ints, tags = out.ints, out.tags
    text, size, stack, top = [], 0, [], {}  # stack: (element, the numbers of its children by tag), top: those of the page

    def close(upto: int, token: int) -> None:
        while len(stack) > upto:
            i, _ = stack.pop()
            ints["end"][i], ints["text_to"][i] = token, size

    token = 0
    for token, m in enumerate(_TOKEN.finditer(html or "")):
        _, slash, tag, rest, chars = m.groups()
        if chars is not None:
            piece = unescape(chars)
            text.append(piece)
            size += len(piece)
        elif tag and slash:
            at = max((i for i, (e, _) in enumerate(stack) if tags[e] == tag.lower()), default=-1)
            if at >= 0:
                close(at, token)
        elif tag:
            tag = intern(tag.lower())
            ends, stops = ENDS.get(tag, ((), ()))
            for i in range(len(stack) - 1, -1, -1):
                if tags[stack[i][0]] in ends:
                    close(i, token - 1)
                elif tags[stack[i][0]] in stops:
                    break
            parent, counts = (ints["start"][stack[-1][0]], stack[-1][1]) if stack else (-1, top)
            counts[""], counts[tag] = counts.get("", 0) + 1, counts.get(tag, 0) + 1
            attrs: dict[str, str] = {}
            for name, *values in _ATTRIBUTE.findall(rest):
                attrs.setdefault(intern(name.lower()), unescape(next((v for v in values if v), "")))
            row = (token, token, len(stack), parent, counts[""], counts[tag], size, size)
            for column, n in zip(ints.values(), row, strict=True):
                column.append(n)
            tags.append(tag)
            out.names.extend(attrs)
            out.values.extend(attrs.values())
            out.attrs_to.append(len(out.names))
            if tag not in VOID:
                stack.append((len(out) - 1, {}))
    close(0, token)
    return "".join(text)


def parse_page(html: str | None) -> tuple[str, list[dict]]:
    """(text, elements in document order) of one page."""
    out = _Columns()
    return _parse(html, out), [out.row(i) for i in range(len(out))]


#: Characters of markup whose elements a Python worker holds at once; a longer page stands alone.
SLICE_CHARS = 1 << 18


def _slices(bodies: pa.Array):
    """(first row, rows) of neighbouring pages that have ``SLICE_CHARS`` together, or one page."""
    first, size = 0, 0
    for i, n in enumerate(pc.fill_null(pc.utf8_length(bodies), 0).to_pylist()):
        if i > first and size + n > SLICE_CHARS:
            yield first, i - first
            first, size = i, 0
        size += n
    if first < len(bodies):
        yield first, len(bodies) - first


def page_elements(df: DataFrame, body: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` with ``page_text`` and ``elements`` (array of ELEMENT) of each page; row by row, in
    Arrow batches, no shuffle. A batch is parsed and handed on in slices, as the elements of its
    pages take many times the room of the markup."""
    ship_package(df.sparkSession)
    keep = list(keep)
    schema = T.StructType([*(df.schema[k] for k in keep), T.StructField("page_text", T.StringType()),
                           T.StructField("elements", T._parse_datatype_string(f"array<{ELEMENT}>"))])

    def run(batches):
        for b in batches:
            for first, n in _slices(b.column(len(keep))):
                part, out, texts, upto = b.slice(first, n), _Columns(), [], array("i", [0])
                for page in part.column(len(keep)):
                    texts.append(_parse(page.as_py(), out))
                    upto.append(len(out))
                yield pa.RecordBatch.from_arrays([*part.columns[:len(keep)], pa.array(texts, pa.string()), out.lists(upto)],
                                                 names=[*keep, "page_text", "elements"])

    return df.select(*keep, F.col(body).alias("_body")).mapInArrow(run, schema)


def text_of(element: Column, page_text: str = "page_text") -> Column:
    """The whole text inside an element."""
    return F.substr(F.col(page_text), element["text_from"] + 1, element["text_to"] - element["text_from"])


def inside(inner: Column, outer: Column) -> Column:
    """Whether an element lies in another one."""
    return (inner["start"] > outer["start"]) & (inner["end"] <= outer["end"])


def has(elements: Column, outer: Column, tag: str, attr: str | None = None, value: str | None = None) -> Column:
    """``:has``: some element of ``tag`` (with the attribute, of the value) lies in ``outer``."""
    def fits(e: Column) -> Column:
        cond = inside(e, outer) & (e["tag"] == tag)
        if attr is not None:
            found = F.try_element_at(e["attrs"], F.lit(attr))
            cond = cond & (found.isNotNull() if value is None else F.coalesce(found == value, F.lit(False)))
        return cond
    return F.exists(elements, fits)


def rows_of(pages: DataFrame, tag: str, keep: Sequence[str] = (), within: str | None = None, outermost: bool = False) -> DataFrame:
    """A2: one row per element of ``tag``: ``keep``, pos (from 1, in document order), ``e`` (the element),
    ``elements`` and ``page_text`` for further steps. With ``within`` only elements below one of that
    tag; with ``outermost`` those that lie in another row are left to their own level."""
    all_ = F.col("elements")
    found = F.filter(all_, lambda e: e["tag"] == tag)
    if within:
        outer = F.filter(all_, lambda o: o["tag"] == within)
        found = F.filter(found, lambda e: F.exists(outer, lambda o: inside(e, o)))
    if outermost:
        rows = found
        found = F.filter(found, lambda e: ~F.exists(rows, lambda o: inside(e, o)))
    return pages.select(*keep, "page_text", "elements", F.posexplode(found).alias("pos", "e")).withColumn("pos", F.col("pos") + 1)


def children_of(elements: Column, parent: Column, tag: str | None = None) -> Column:
    """The children of an element in document order; ``[n]`` of it, or ``nth``, is the nth child."""
    kids = F.filter(elements, lambda e: e["parent"] == parent["start"])
    return F.filter(kids, lambda e: e["tag"] == tag) if tag else kids


def descendants(elements: Column, outer: Column, tag: str) -> Column:
    return F.filter(elements, lambda e: inside(e, outer) & (e["tag"] == tag))
