"""Date parsing and calendar attributes."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted date formats, tried in this order. Day comes before
# month wherever a string could be read both ways.
DATE_FORMATS = (
    "yyyy-MM-dd",
    "dd/MM/yyyy",
    "MM/dd/yyyy",
    "d/M/yyyy",
    "M/d/yyyy",
    "yyyy/MM/dd",
    "dd-MM-yyyy",
)

# Months of each season, southern hemisphere.
SOUTHERN_SEASONS = {
    "Summer": (12, 1, 2),
    "Autumn": (3, 4, 5),
    "Winter": (6, 7, 8),
    "Spring": (9, 10, 11),
}


# Text each format letter run can match; a superset of what the parser accepts.
_SHAPES = {"yyyy": r"[+-]?\d{4,}", "MM": r"\d{2}", "dd": r"\d{2}", "M": r"\d+", "d": r"\d+"}


def _shape(date_format: str) -> str | None:
    runs = re.findall(r"[A-Za-z]+|[^A-Za-z]+", date_format)
    if any(r[0].isalpha() and r not in _SHAPES for r in runs):
        return None
    return "^" + "".join(_SHAPES.get(r) or re.escape(r) for r in runs) + "$"


def _attempts(text: Column, formats: Sequence[str]) -> list[Column]:
    """A date per format. Texts of another shape are not parsed: a failed parse is costly."""
    attempts = []
    for fmt in formats:
        shape, parsed = _shape(fmt), F.try_to_date(text, fmt)
        attempts.append(parsed if shape is None else F.when(text.rlike(shape), parsed))
    return attempts


def parse_date(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that fits; null when none does (no error under ANSI mode)."""
    return F.coalesce(*_attempts(text, formats))


def matched_format(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """The format :func:`parse_date` used, so ambiguous input can be reviewed."""
    return F.coalesce(*[F.when(d.isNotNull(), F.lit(f)) for d, f in zip(_attempts(text, formats), formats)])


def season_of(month: Column, seasons: Mapping[str, Sequence[int]] = SOUTHERN_SEASONS) -> Column:
    """Season name of a month number; null stays null."""
    return F.coalesce(*[F.when(month.isin(*months), F.lit(name)) for name, months in seasons.items()])
