"""Optional filters: an argument that is missing (None, 0, empty) filters nothing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains(columns: Sequence[str], wanted: str | None) -> Column | None:
    """Case-insensitive substring in any of the columns; % and _ of ``wanted`` keep their LIKE meaning."""
    return reduce(or_, (F.col(c).ilike(f"%{wanted}%") for c in columns)) if wanted else None


def equals(column: str, wanted) -> Column | None:
    return F.col(column) == wanted if wanted else None


def equals_folded(column: str, wanted: str | None) -> Column | None:
    return F.upper(column) == F.upper(F.lit(wanted)) if wanted else None


def at_least(column: str, least) -> Column | None:
    return F.col(column) >= least if least else None


def at_most(column: str, most) -> Column | None:
    return F.col(column) <= most if most else None


def active_in(start: str, end: str, year: int | None) -> Column | None:
    """The interval holds the year; an open end does, an unknown start doesn't."""
    return (F.col(start) <= year) & (F.col(end).isNull() | (F.col(end) >= year)) if year else None


def where(df: DataFrame, *conditions: Column | None) -> DataFrame:
    given = [c for c in conditions if c is not None]
    return df.filter(reduce(and_, given)) if given else df


def metadata(spec: Mapping[str, object]) -> Column:
    """{"field": value} or {"field": {"$eq": v}} or {"field": {"$in": [...]}}, all of which must hold."""

    def one(field: str, want) -> Column:
        if not isinstance(want, Mapping):
            want = {"$eq": want}
        tests = {"$eq": lambda v: F.col(field) == v, "$in": lambda v: F.col(field).isin(list(v))}
        unknown = set(want) - set(tests)
        if unknown:
            raise ValueError(f"unknown filter operators: {sorted(unknown)}")
        return reduce(and_, (tests[k](v) for k, v in want.items()))

    return reduce(and_, (one(f, w) for f, w in spec.items()), F.lit(True))


_ALL = ("", "all", "(all)", "(any)", "all states", "all newspapers")


def number_of(choice: object) -> int | None:
    """The number at the start of a choice such as "01 - January"; None for any."""
    word = str(choice if choice is not None else "").strip().lower()
    first = word.split()[0] if word and word not in _ALL else ""
    return int(first) or None if first.isdigit() else None


def publications(dim: DataFrame, region: str | None = None, state: str | None = None, newspaper: str | Sequence[str] | None = None) -> DataFrame:
    """The rows of ``dim`` (slug, title, region, state_name) that the choices leave.

    A region overrides a state; a newspaper overrides both: a list of slugs, a region's name, a slug, or any text that
    holds a title or slug.
    """
    named = lambda v: bool(v) and str(v).strip().lower() not in _ALL
    if newspaper and not isinstance(newspaper, str):
        return dim.filter(F.col("slug").isin(list(newspaper)))
    if named(newspaper):
        low = F.lit(str(newspaper).strip().lower())
        exact = (F.lower("region") == low) | (F.col("slug") == str(newspaper).strip())
        loose = dim.filter(F.contains(low, F.lower("title")) | F.contains(low, F.lower("slug"))).orderBy("slug").limit(1)
        sure = dim.filter(exact)
        return sure.unionByName(loose.join(dim.agg(F.bool_or(exact).alias("_sure")).filter("NOT _sure").select(F.lit(1).alias("_one")), F.lit(True)).drop("_one"))
    if named(region):
        return dim.filter(F.lower("region") == str(region).strip().lower())
    if named(state):
        return dim.filter(F.contains(F.lit(str(state).strip().lower()), F.lower("state_name")))
    return dim


def chosen(pages: DataFrame, slugs: DataFrame, month: object = None, day: object = None, front_page: bool = False) -> DataFrame:
    """Pages of the chosen publications; month and day as numbers or as the choices that a form shows."""
    spec = {k: v for k, v in (("month", number_of(month)), ("day", number_of(day)), ("sequence", 1 if front_page else None)) if v}
    return pages.filter(metadata(spec)).join(slugs.select("slug").distinct(), "slug", "left_semi")


def in_json_list(column: str, wanted: str, exact: bool = False) -> Column:
    """Is ``wanted`` in a JSON list: anywhere in its text, or (exact) as an element?"""
    return F.array_contains(F.from_json(column, "array<string>"), wanted) if exact else F.col(column).ilike(f"%{wanted}%")
