"""Identifiers and links of issues, pages and images, as Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def segments(url: Column) -> Column:
    """The parts of a URL's path, without query and fragment."""
    return F.filter(F.split(F.substring_index(F.substring_index(url, "?", 1), "#", 1), "/"), lambda s: s != "")


def _after(parts: Column, name: str) -> Column:
    """The place (from 0) of what follows the part ``name``; null if there is none."""
    return F.nullif(F.array_position(parts, F.lit(name)), F.lit(0)).cast("int")


def _digits(text: Column, least: int, most: int | None = None) -> Column:
    """``text`` if it is so many digits."""
    return F.when(text.rlike(f"^[0-9]{{{least},{most or ''}}}$"), text)


def issue_of_url(url: Column) -> Column:
    """lccn, date, edition of an issue's URL; null if it names none.

    After ``resource``, ``item`` or ``lccn`` come the identifier and the day: ``<yyyy-mm-dd>[/ed-<n>]`` or
    ``<yyyymmdd>[<edition>]``.
    """
    parts = segments(url)
    at = F.coalesce(*(_after(parts, n) for n in ("resource", "item", "lccn")))
    part = lambda k: F.get(parts, at + k)
    day = part(1)
    plain = F.coalesce(_digits(day, 8, 8), _digits(day, 10, 10))
    dashed = F.when((F.length(day) == 10) & _digits(F.translate(day, "-", ""), 8, 8).isNotNull() & (F.substring(day, 5, 1) == "-") & (F.substring(day, 8, 1) == "-"), day)
    date = F.coalesce(dashed, F.concat_ws("-", F.substring(plain, 1, 4), F.substring(plain, 5, 2), F.substring(plain, 7, 2)))
    named = F.when(F.startswith(part(2), F.lit("ed-")) & dashed.isNotNull(), _digits(F.substring(part(2), 4, 9), 1, 9))
    edition = F.coalesce(named, F.nullif(F.substring(plain, 9, 2), F.lit("")), F.lit("1")).cast("int")
    return F.when(dashed.isNotNull() | plain.isNotNull(), F.struct(part(0).alias("lccn"), date.alias("date"), edition.alias("edition")))


def page_id(lccn: Column, date: Column, edition: Column, sequence: Column) -> Column:
    return F.concat(lccn, F.lit("_"), date, F.lit("_ed-"), edition.cast("string"), F.lit("_seq-"), sequence.cast("string"))


def page_part(prefix: Column, date: Column, edition: Column, sequence: Column) -> Column:
    return F.concat(prefix, F.lit("#"), date, F.lit("#ed-"), edition.cast("string"), F.lit("#p"), _two(sequence))


def chunk_id(prefix: Column, date: Column, edition: Column, sequence: Column, index: Column) -> Column:
    return F.concat(page_part(prefix, date, edition, sequence), F.lit("#c"), _two(index))


def _two(n: Column) -> Column:
    """A number of two digits or more."""
    text = n.cast("string")
    return F.when(F.length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


# A batch whose pages lack their reel; by day (with edition 1 to 9), what to add to page numbers up to a last one.
SHIFTED_BATCH, SHIFTED_LCCN, SHIFTED_REEL = "nn_hardin_ver01", "sn83030193", "0028076582A"
SHIFTS = {"19101201": (7, 20), "19101202": (27, 24), "19101203": (51, 12)}


def image_id(url: Column, no_reel: str = "00000000000") -> Column:
    """The image service's identifier of a page scan: colon-joined storage path, null for other URLs.

    Shapes: ``.../batches/<batch>/data/<lccn>/[<reel>/]<issue>/<page>.jp2``,
    ``.../ndnp/<owner>/<batch>/data/<lccn>/<reel>/<issue>/<page>.jp2``, and URLs that hold an identifier.
    """
    parts, mark = segments(url), "service:ndnp:"
    size, file = F.size(parts), F.element_at(parts, -1)
    page = _digits(F.substring_index(file, ".jp2", 1), 1)
    scan = F.endswith(file, F.lit(".jp2")) & page.isNotNull()
    one, two = _after(parts, "batches"), _after(parts, "ndnp")
    part = lambda k: F.get(parts, k)
    folder = lambda batch: F.when(F.startswith(batch, F.lit("batch_")), batch).otherwise(F.concat(F.lit("batch_"), batch))
    full, bare = scan & (size == one + 6) & (part(one + 1) == "data"), scan & (size == one + 5) & (part(one + 1) == "data")
    stored = scan & (size == two + 7) & (part(two + 2) == "data")
    given = F.get(F.filter(parts, lambda p: p.contains(mark)), F.lit(0))
    split = F.split(F.substring(given, F.locate(mark, given), 1 << 30), ":")
    # service, ndnp, owner, batch, data, lccn, [reel,] issue, page
    held = F.when(given.isNotNull(), split)
    owner = F.substring_index(F.regexp_replace(part(one), "^batch_", ""), "_", 1)
    built = F.coalesce(
        F.when(full | bare, F.array(owner, folder(part(one)), part(one + 2), F.when(full, part(one + 3)).otherwise(no_reel), F.element_at(parts, -2), page)),
        F.when(stored, F.array(part(two), folder(part(two + 1)), part(two + 3), part(two + 4), part(two + 5), page)),
    )
    fresh = F.transform(F.array(built), lambda b: F.when(b.isNotNull(), F.concat_ws(":", F.lit("service:ndnp"), b[0], b[1], F.lit("data"), b[2], _mended(b[1], b[2], b[4], b[5], b[3]))))[0]
    old = F.when((F.get(held, F.lit(3)) == f"batch_{SHIFTED_BATCH}") & (F.get(held, F.lit(5)) == SHIFTED_LCCN), F.concat_ws(":", F.array_join(F.slice(held, 1, 6), ":"), _mended(F.get(held, F.lit(3)), F.get(held, F.lit(5)), F.element_at(held, -2), F.element_at(held, -1), F.lit(no_reel))))
    return F.when(given.isNotNull(), F.coalesce(old, F.array_join(held, ":"))).otherwise(fresh)


def _mended(batch: Column, lccn: Column, issue: Column, page: Column, reel: Column) -> Column:
    """reel:issue:page, with the reel and numbers that the one batch lacks."""
    shifted, n = page, page.try_cast("int")
    for day, (by, last) in SHIFTS.items():
        shifted = F.when(F.startswith(issue, F.lit(day)) & (n <= last), F.lpad((n + by).cast("string"), 4, "0")).otherwise(shifted)
    here = (batch == f"batch_{SHIFTED_BATCH}") & (lccn == SHIFTED_LCCN)
    return F.concat_ws(":", F.when(here, F.lit(SHIFTED_REEL)).otherwise(reel), issue, F.when(here, shifted).otherwise(page))


def image_info(url: Column, base: str) -> Column:
    """Where the image service describes a scan; null for URLs without an identifier."""
    return F.concat(F.lit(base.rstrip("/") + "/"), image_id(url), F.lit("/info.json"))


def image_url(url: Column, base: str, size: str = "600,", region: str = "full") -> Column:
    """A IIIF request for a scan; URLs without an identifier stay as they are."""
    return F.coalesce(F.concat(F.lit(base.rstrip("/") + "/"), image_id(url), F.lit(f"/{region}/{size}/0/default.jpg")), url)


def rescaled(iiif: Column, percent: float) -> Column:
    return F.regexp_replace(iiif, r"pct:\d+(?:\.\d+)?", f"pct:{percent:g}")


def year_of_file(name: Column) -> Column:
    """The year in ``..._<yyyy>[_<mm>_<dd>].parquet``."""
    return F.regexp_extract(name, r"_(\d{4})(?:_\d{2}_\d{2})?\.parquet$", 1).try_cast("int")


def partitioned_path(path: Column) -> Column:
    """A flat file path ``<top>/<state>/<slug>/<file>_<yyyy>_<mm>_<dd>.parquet`` with its year as a folder; else null."""
    pattern = r"^([^/]+/[^/]+/[^/]+)/([^/]+_(\d{4})_\d{2}_\d{2}\.parquet)$"
    return F.when(path.rlike(pattern), F.regexp_replace(path, pattern, "$1/$3/$2"))


def links_in(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit('href="([^"]*)"'), F.lit(1))
