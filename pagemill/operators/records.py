"""Records of chunks, hits and catalogs, projected from tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemill.functions import links
from pagemill.functions import text as tx
from pagemill.operators.chunks import word_chunks
from pagemill.operators.highlight import escaped

# The fields of a chunk that a search returns.
HIT_FIELDS = (
    "text parent_page_id newspaper_title newspaper_slug region city state lccn date year month day season "
    "edition sequence chunk_index chunk_count token_count loc_page_url pdf_url image_url iiif_thumb_url"
).split()
#: Pages whose trimmed text is shorter are not chunked.
LEAST_CHARS = 30


def chunk_records(pages: DataFrame, dim: DataFrame, images: str, chunker: Callable[[DataFrame], DataFrame] = word_chunks, streamed: bool = False) -> DataFrame:
    """One record for each chunk that isn't blank.

    ``pages``: slug, lccn, date, edition, sequence, text and, if known, title, city, state, page_url, pdf_url, image_url;
    ``dim``: slug, title, region, city, state_name, lccn, for what a page lacks.  Chunks keep their place in the
    numbering.  ``streamed``: as incremental ingest writes them, with ``file_path`` and without ``token_count``.
    """
    have = lambda c: F.col(c) if c in pages.columns else F.lit(None).cast("string")
    trimmed = F.trim("text", F.lit(" \t\n\r"))
    p = pages.filter(F.length(trimmed) >= LEAST_CHARS).select(
        "text", "slug", "date", "edition", "sequence", *(have(c).alias(c) for c in ("title", "city", "state", "lccn", "page_url", "pdf_url", "image_url"))
    )
    d = dim.select("slug", F.col("title").alias("d_title"), "region", F.col("city").alias("d_city"), F.col("state_name").alias("d_state"), F.col("lccn").alias("d_lccn"))
    p = p.join(F.broadcast(d) if d.limit(10_001).count() <= 10_000 else d, "slug", "left")
    part = F.split("date", "-")
    number = lambda k: tx.int_or(F.get(part, F.lit(k)), 0)
    either = lambda c, other: F.coalesce(F.nullif(F.col(c), F.lit("")), other)
    c = chunker(p).withColumn("text", F.trim("text", F.lit(" \t\n\r"))).filter("text != ''")
    page = links.page_part(F.col("slug"), F.col("date"), F.col("edition"), F.col("sequence"))
    image = F.coalesce("image_url", F.lit(""))
    out = {
        "_id": links.chunk_id(F.col("slug"), F.col("date"), F.col("edition"), F.col("sequence"), F.col("chunk_index")), "text": F.col("text"), "parent_page_id": page,
        "newspaper_title": either("title", F.col("d_title")), "newspaper_slug": F.col("slug"), "region": F.col("region"), "city": either("city", F.col("d_city")), "state": either("state", F.col("d_state")), "lccn": either("lccn", F.col("d_lccn")),
        "date": F.col("date"), "year": number(0), "month": number(1), "day": number(2), "season": tx.season(number(1)), "edition": F.col("edition"), "sequence": F.col("sequence"),
        "chunk_index": F.col("chunk_index"), "chunk_count": F.col("chunk_count"), "token_count": F.col("token_count"),
        "loc_page_url": F.coalesce("page_url", F.lit("")), "pdf_url": F.coalesce("pdf_url", F.lit("")), "image_url": image, "iiif_thumb_url": links.image_url(image, images, "600,"),
    }
    if streamed:
        del out["token_count"]
        out["file_path"] = image
    return c.select(*(v.alias(k) for k, v in out.items()))


def hit_cards(hits: DataFrame, dim: DataFrame, images: str, excerpt: int = 450) -> DataFrame:
    """What a result page shows of chunk records: numbering from 1, an escaped excerpt, two images, the publication."""
    d = dim.select(F.col("slug").alias("newspaper_slug"), F.col("title").alias("d_title"), F.col("city").alias("d_city"), F.col("state_name").alias("d_state"))
    h = hits.join(d, "newspaper_slug", "left")
    short = F.concat(escaped(F.substring("text", 1, excerpt)), F.when(F.length("text") > excerpt, "...").otherwise(""))
    known = lambda c, other: F.coalesce(c, F.lit(other))
    source = F.coalesce(F.nullif(F.col("image_url"), F.lit("")), F.col("iiif_thumb_url"))
    return h.select(
        F.col("_id").alias("id"), "date", "edition", "sequence", "season", (F.col("chunk_index") + 1).alias("chunk_number"), "chunk_count", F.length("text").alias("char_count"), short.alias("excerpt"),
        known("d_title", "Historical Broadsheet").alias("newspaper_title"), known("d_city", "Unknown").alias("newspaper_city"), known("d_state", "Unknown").alias("newspaper_state"),
        links.image_url(F.coalesce(F.nullif(F.col("iiif_thumb_url"), F.lit("")), F.col("image_url")), images, "600,").alias("thumb_url"), links.image_url(source, images, "1600,").alias("high_res_url"),
    )


def active_years(start: Column, end: Column) -> Column:
    """"1890-1910", with "?" for what is missing or 0."""
    said = lambda y: F.coalesce(F.nullif(y, F.lit(0)).cast("string"), F.lit("?"))
    return F.concat(said(start), F.lit("-"), said(end))


def in_units(size: Column, power: int) -> Column:
    """Bytes in units of 1024 ** power, to two digits; 0 if unknown."""
    return F.coalesce(F.round(size / float(1024**power), 2), F.lit(0.0))


def batch_info(names: DataFrame, given: DataFrame, catalog: DataFrame, remote: DataFrame) -> DataFrame:
    """``names``: name; the others: name, size_bytes. Whose word counts for each batch (origin), its size and owner.

    In turn: what is given with a size, the catalog with a size, remote metadata, the catalog, and nothing but the name.
    """
    sides = (("given", given), ("catalog", catalog), ("remote", remote))
    out = names.select("name")
    for side, df in sides:
        out = out.join(df.select("name", F.struct("size_bytes", F.lit(side).alias("origin")).alias(side)), "name", "left")
    sized = lambda side: F.when(F.coalesce(F.col(f"{side}.size_bytes"), F.lit(0)) > 0, F.col(side))
    none = F.struct(F.lit(None).cast("long").alias("size_bytes"), F.lit("name").alias("origin"))
    out = out.withColumn("i", F.coalesce(sized("given"), sized("catalog"), "remote", "catalog", none))
    return out.select("name", "i.size_bytes", "i.origin", F.when(F.col("name").contains("_"), F.substring_index("name", "_", 1)).alias("awardee"))


def hashed_terms(text: Column, size: int = 16) -> Column:
    """An embedding without a model: counts of the terms by their first character. Blank texts give zeros."""
    first = F.transform(tx.terms(text), lambda t: F.ascii(t) % size)
    counts = lambda first: F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda b: F.size(F.filter(first, lambda x: x == b)).cast("double"))
    # As a variable of a function the terms are found once, not once for each place.
    return F.transform(F.array(first), counts)[0]


def embedded(df: DataFrame, embedder: Callable[[Column], Column] = hashed_terms) -> DataFrame:
    """``df`` (with ``text``) with ``embedding``. ``embedder`` may be a pandas UDF around a model; a blank text goes to it as one space."""
    trimmed = F.trim("text", F.lit(" \t\n\r"))
    return df.withColumn("embedding", embedder(F.when(F.length(trimmed) > 0, F.col("text")).otherwise(F.lit(" "))))


def verified(files: DataFrame, manifest: DataFrame, md5: bool = True) -> DataFrame:
    """``files``: path, content; ``manifest``: path, checksum. path and state: ok, changed, missing or unlisted."""
    digest = F.md5("content") if md5 else F.sha2("content", 256)
    both = files.select("path", digest.alias("found")).join(manifest.select("path", F.lower("checksum").alias("checksum")), "path", "full")
    state = F.when(F.col("found").isNull(), "missing").when(F.col("checksum").isNull(), "unlisted").when(F.col("found") == F.col("checksum"), "ok").otherwise("changed")
    return both.select("path", state.alias("state"))


def seeded_pick(df: DataFrame, key: str, seed: int, among: int = 50, k: int = 1) -> DataFrame:
    """``k`` rows of the first ``among`` by key, at random but the same for a seed."""
    first = df.orderBy(key).limit(among)
    return first.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}"))), key).limit(k)
