"""Layout XML (ALTO) and issue XML (METS) as nested columns.

The XML is read element by element in Arrow-batched functions; everything that follows from the tree (full text,
normalized boxes, flat word lists) is Spark expressions.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from pagemill.functions.text import normalized_box

#: Bytes of XML whose trees a task holds at a time.
SLICE = 1 << 20
_BOX = "x int, y int, w int, h int"
LAYOUT = f"struct<unit string, engine string, width int, height int, blocks array<struct<id string, {_BOX}, lines array<struct<{_BOX}, words array<struct<text string, {_BOX}, confidence float>>>>>>>"
ISSUE = "struct<lccn string, title string, date string, volume string, issue string, edition string, pages array<struct<sequence int, page_id string, alto string, pdf string, jp2 string>>>"
REFS = "array<struct<lccn string, issue_date string, edition int, path string>>"


def _name(e: ET.Element) -> str:
    return e.tag.rpartition("}")[2]


def _all(e: ET.Element, name: str) -> list[ET.Element]:
    return [x for x in e.iter() if _name(x) == name]


def _by_name(root: ET.Element) -> Callable[[ET.Element, str], Iterable[ET.Element]]:
    """``_all`` for many elements of one tree: names that have a single tag in it are looked up by that."""
    tags: dict[str, list[str]] = {}
    for tag in {e.tag for e in root.iter()}:
        tags.setdefault(tag.rpartition("}")[2], []).append(tag)

    def of(e: ET.Element, name: str) -> Iterable[ET.Element]:
        own = tags.get(name, ())
        return e.iter(own[0]) if len(own) == 1 else _all(e, name) if own else ()

    return of


def _whole(text: str | None) -> int | None:
    if text is None:
        return None
    try:
        return int(float(text))
    except (TypeError, ValueError, OverflowError):
        return None


def _number(text: str | None) -> float | None:
    if text is None:
        return None
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def _box(e: ET.Element) -> dict:
    get = e.get
    return {"x": _whole(get("HPOS")), "y": _whole(get("VPOS")), "w": _whole(get("WIDTH")), "h": _whole(get("HEIGHT"))}


def parse_layout(xml: str | None) -> dict | None:
    """Page size, and blocks of lines of words; empty lines and blocks are left out. None if it isn't well formed."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    named = _by_name(root)
    first = lambda name: next(iter(named(root, name)), None)
    unit, page = first("MeasurementUnit"), first("Page")
    text = lambda e, name: next((x.text or "" for x in named(e, name)), "")
    engines = [f"{text(e, 'softwareName')} {text(e, 'softwareVersion')}".strip() for e in named(root, "processingSoftware")]
    blocks = []
    for b in named(root, "TextBlock"):
        lines = []
        for line in named(b, "TextLine"):
            words = [{"text": content, **_box(w), "confidence": _number(w.get("WC"))} for w in named(line, "String") if (content := w.get("CONTENT"))]
            if words:
                lines.append({**_box(line), "words": words})
        if lines:
            blocks.append({"id": b.get("ID"), **_box(b), "lines": lines})
    size = page.attrib if page is not None else {}
    return {"unit": unit.text if unit is not None else None, "engine": " / ".join([e for e in engines if e][:2]) or None, "width": _whole(size.get("WIDTH")), "height": _whole(size.get("HEIGHT")), "blocks": blocks}


def parse_issue(xml: str | None) -> dict | None:
    """An issue's identity and its pages in order; pages without any file have no number."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    detail = {d.get("type"): next((n.text for n in _all(d, "number")), None) for d in _all(root, "detail")}
    files = {f.get("ID"): next((v for x in _all(f, "FLocat") for k, v in x.attrib.items() if k.rpartition("}")[2] == "href"), None) for f in _all(root, "file")}
    pages = []
    for div in _all(root, "div"):
        if (div.get("TYPE") or "").lower() == "page":
            paths = [files.get(p.get("FILEID")) or "" for p in _all(div, "fptr")]
            of = lambda end: next((p for p in paths if p.lower().endswith(end)), None)  # noqa: B023, E731
            found = {"alto": of(".xml"), "pdf": of(".pdf"), "jp2": of(".jp2")}
            if any(found.values()):
                pages.append({"sequence": len(pages) + 1, "page_id": div.get("ID"), **found})
    lccn = next((i.text for i in _all(root, "identifier") if i.get("type") == "lccn"), None)
    return {"lccn": lccn, "title": root.get("LABEL"), "date": next((d.text for d in _all(root, "dateIssued")), None), "volume": detail.get("volume"), "issue": detail.get("issue"), "edition": detail.get("edition"), "pages": pages}


def parse_refs(xml: str | None) -> list[dict] | None:
    """Issues that a batch names; those without identifier, date or path are left out."""
    try:
        root = ET.fromstring(xml or "")
    except ET.ParseError:
        return None
    refs = [{"lccn": i.get("lccn"), "issue_date": i.get("issueDate"), "edition": _whole(i.get("editionOrder")) or 1, "path": (i.text or "").strip()} for i in _all(root, "issue")]
    return [r for r in refs if r["lccn"] and r["issue_date"] and r["path"]]


def _slices(xml: pa.Array) -> Iterator[pa.Array]:
    """A batch's texts, as many at a time as hold about SLICE bytes."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(xml), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(xml):
        base = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        yield xml.slice(at, end - at)
        at = end


def _column(parse, kind: str, xml: Column | str) -> Column:
    """The trees of a slice are held at once, not those of a batch; they are ten times as large as the XML."""
    arrow = to_arrow_type(DataType.fromDDL(kind))

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            if not len(batch):
                yield pa.array([], arrow)
            for some in _slices(batch):
                yield pa.array([parse(x.as_py()) for x in some], arrow)

    # Otherwise a filter on what was read would be pushed below it, and the XML read once more for it.
    return F.arrow_udf(run, kind).asNondeterministic()(xml)


def layout(xml: Column | str) -> Column:
    return _column(parse_layout, LAYOUT, xml)


def issue(xml: Column | str) -> Column:
    return _column(parse_issue, ISSUE, xml)


def issue_refs(xml: Column | str) -> Column:
    return _column(parse_refs, REFS, xml)


def full_text(blocks: Column) -> Column:
    """Words joined by spaces, lines by line ends, blocks by blank lines."""
    line = lambda x: F.array_join(F.transform(x["words"], lambda w: w["text"]), " ")
    return F.array_join(F.transform(blocks, lambda b: F.array_join(F.transform(b["lines"], line), "\n")), "\n\n")


def flat_lines(blocks: Column) -> Column:
    return F.flatten(F.transform(blocks, lambda b: b["lines"]))


def flat_words(blocks: Column) -> Column:
    return F.flatten(F.transform(flat_lines(blocks), lambda x: x["words"]))


def flattened(parsed: Column) -> dict[str, Column]:
    """Parallel arrays of a page: words, boxes in 0..1000, confidences, lines, blocks."""
    box = lambda e: normalized_box(e["x"], e["y"], e["w"], e["h"], parsed["width"], parsed["height"])
    words, lines = flat_words(parsed["blocks"]), flat_lines(parsed["blocks"])
    said = lambda x: F.array_join(F.transform(x["words"], lambda w: w["text"]), " ")
    return {
        "words": F.transform(words, lambda w: w["text"]),
        "boxes": F.transform(words, box),
        "word_confidences": F.transform(words, lambda w: F.coalesce(w["confidence"], F.lit(1.0).cast("float"))),
        "lines": F.transform(lines, lambda x: F.struct(box(x).alias("box"), said(x).alias("text"))),
        "blocks": F.transform(parsed["blocks"], lambda b: F.struct(b["id"].alias("block_id"), box(b).alias("box"), F.array_join(F.transform(b["lines"], said), "\n").alias("text"))),
    }
