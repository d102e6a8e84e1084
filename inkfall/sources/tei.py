"""TEI XML documents as text blocks."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_NS = "{http://www.tei-c.org/ns/1.0}"


def _segments(x: Column) -> Column:
    """The segments of 'page;x0,y0,x1,y1 page;...' as arrays of five numbers; null ones where they are malformed."""
    parts = F.filter(F.split(x, r"\s+"), lambda s: s != "")
    numbers = lambda s: F.concat(F.array(F.get(F.split(s, ";"), F.lit(0)).try_cast("int").cast("double")), F.transform(F.split(F.get(F.split(s, ";"), F.lit(1)), ","), lambda v: v.try_cast("double")))
    return F.transform(parts, lambda s: F.when((F.size(F.split(s, ";")) == 2) & (F.size(numbers(s)) == 5) & F.forall(numbers(s), lambda v: v.isNotNull()), numbers(s)))


def coords(x: Column) -> Column:
    """'page;x0,y0,x1,y1 ...' as page (from 0) and the box around all segments on the first one's page; null if any is malformed."""
    parts = _segments(x)
    ok = (F.size(parts) > 0) & F.forall(parts, lambda p: p.isNotNull())
    page = F.get(F.get(parts, F.lit(0)), F.lit(0))
    own = F.filter(parts, lambda p: p[0] == page)

    def side(k: int, f) -> Column:
        return f(F.transform(own, lambda p: p[k]))

    box = F.array(side(1, F.array_min), side(2, F.array_min), side(3, F.array_max), side(4, F.array_max))
    return F.when(ok, F.struct((page.cast("int") - 1).alias("page_index"), box.alias("bbox")))


def first_segment(x: Column) -> Column:
    """The first segment alone, its page from 1 as it is written; nulls if it is malformed."""
    one = F.get(_segments(x), F.lit(0))
    return F.struct(F.get(one, F.lit(0)).cast("int").alias("page"), F.slice(one, 2, 4).alias("coords"))


def _text(e: ET.Element) -> str:
    return " ".join("".join(e.itertext()).split())


def _blocks(xml: str) -> list[tuple[str, str, str | None]]:
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return []
    out: list[tuple[str, str, str | None]] = []

    def add(kind: str, e: ET.Element | None) -> None:
        if e is not None and (t := _text(e)):
            out.append((kind, t, e.get("coords")))

    add("title", root.find(f".//{_NS}titleStmt/{_NS}title"))
    for p in root.iterfind(f".//{_NS}abstract//{_NS}p"):
        add("abstract", p)
    body = root.find(f".//{_NS}text/{_NS}body")
    if body is not None:
        in_figure = {id(x) for f in body.iter(f"{_NS}figure") for x in f.iter()}
        in_text = {id(x) for p in body.iter(f"{_NS}p") for x in p.iter() if x is not p}
        kinds = {f"{_NS}head": "section", f"{_NS}p": "paragraph", f"{_NS}figDesc": "figure", f"{_NS}formula": "formula", f"{_NS}note": "note"}
        for e in body.iter():
            kind = kinds.get(e.tag)
            # What stands in a figure or a paragraph is in that one's text; other notes than those at the foot are none of the text.
            inner = kind == "paragraph" and id(e) in in_figure or kind in ("formula", "note") and id(e) in in_text
            if kind and not inner and (kind != "note" or e.get("place") == "foot"):
                add(kind, e)
    for d in root.iterfind(f".//{_NS}back//{_NS}div"):
        if d.get("type") in ("funding", "availability"):
            add(d.get("type"), d)
    for b in root.iterfind(f".//{_NS}back//{_NS}listBibl/{_NS}biblStruct"):
        if t := reference_text(b):
            out.append(("reference", t, b.get("coords")))
    return out


def reference_text(e: ET.Element) -> str:
    """A reference as it was cited, if it was kept raw; else its surnames, first title and year."""
    for n in e.iterfind(f".//{_NS}note"):
        if n.get("type") == "raw_reference" and (t := _text(n)):
            return t
    names = [t for a in e.iterfind(f".//{_NS}author") if (n := a.find(f".//{_NS}surname")) is not None and (t := _text(n))]
    titles = [t for a in e.iterfind(f".//{_NS}title") if (t := _text(a))]
    date = e.find(f".//{_NS}date[@type='published']")
    year = "" if date is None else date.get("when", _text(date))
    return " ".join([*names, *titles[:1], *([f"({year})"] if year else [])])


_YEAR = re.compile(r"(?:19|20)\d{2}")


def header_year(xml: str | None) -> str:
    """The year in a document's header: of the imprint, the monograph, the creation, the article, then of any date; '' if there is none."""
    try:
        header = ET.fromstring(xml or "").find(f".//{_NS}teiHeader")
    except ET.ParseError:
        return ""
    if header is None:
        return ""
    source = f".//{_NS}fileDesc//{_NS}sourceDesc//{_NS}biblStruct//"
    paths = (f"{source}{_NS}monogr//{_NS}imprint//{_NS}date", f"{source}{_NS}monogr//{_NS}date", f".//{_NS}profileDesc//{_NS}creation//{_NS}date", f"{source}{_NS}analytic//{_NS}date", f".//{_NS}date")
    for d in (e for p in paths for e in header.iterfind(p)):
        for text in (d.get("when", ""), "".join(d.itertext())):
            if y := _YEAR.search(text):
                return y[0]
    return ""


def _page(coords: str | None) -> int | None:
    head, _, rest = (coords or "").split(" ")[0].partition(";")
    return max(0, int(head) - 1) if rest and ";" not in rest and head.strip().isdigit() else None


def _passages(xml: str) -> list[tuple[int, str]]:
    """Page (from 0) and text of what quality checks read: the abstract, the body's sentences (or paragraphs), captions, headings.

    A sentence without a place of its own has its paragraph's. Text that is no XML is one passage on the first page.
    """
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return [(0, xml)] if xml.strip() else []
    out = [(_page(p.get("coords")), p) for p in root.iterfind(f".//{_NS}abstract//{_NS}p")]
    body = root.find(f".//{_NS}body")
    if body is not None:
        parent = {id(s): _page(p.get("coords")) for p in body.iterfind(f".//{_NS}p") for s in p.iterfind(f"{_NS}s")}
        sentences = body.findall(f".//{_NS}s")
        out += [(_page(s.get("coords")) if s.get("coords") else parent.get(id(s)), s) for s in sentences] or [(_page(p.get("coords")), p) for p in body.iterfind(f".//{_NS}p")]
        out += [(_page(f.get("coords")), c) for f in body.iterfind(f".//{_NS}figure") if (c := f.find(f".//{_NS}figDesc")) is not None]
        out += [(_page(h.get("coords")), h) for h in body.iterfind(f".//{_NS}head")]
    return [(page or 0, t) for page, e in out if (t := _text(e))]


def _rows(docs: DataFrame, key: str, xml: str, parse, shape: str) -> DataFrame:
    """A row for every row that ``parse`` makes of a document, numbered from 0."""
    names = ["k", *[c.split()[0] for c in shape.split(", ")]]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, i, *x) for k, t in zip(b["k"], b["x"], strict=True) if t for i, x in enumerate(parse(t))]
            yield pd.DataFrame(rows, columns=names)

    kind = dict(docs.dtypes)[key]
    rows = docs.select(F.col(key).alias("k"), F.col(xml).alias("x"))
    return rows.mapInPandas(run, f"k {kind}, {shape}").withColumnRenamed("k", key)


def tei_blocks(docs: DataFrame, key: str = "doc_id", xml: str = "tei_xml") -> DataFrame:
    """``key``, ``block_index``, ``block_type``, ``text``, ``coords`` in reading order; a malformed or null document has no block."""
    return _rows(docs, key, xml, _blocks, "block_index int, block_type string, text string, coords string")


def tei_passages(docs: DataFrame, key: str = "doc_id", xml: str = "tei_xml") -> DataFrame:
    """``key``, ``block_index``, ``page_index``, ``text`` of what quality checks read of a document."""
    return _rows(docs, key, xml, _passages, "block_index int, page_index int, text string")


@F.pandas_udf(StringType())
def tei_year(xml: pd.Series) -> pd.Series:
    """The publication year in each document's header."""
    return xml.map(header_year)
