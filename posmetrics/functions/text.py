"""Cleaning raw text fields with column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(c: Column) -> Column:
    """Collapse white space and trim; nothing left means NULL."""
    return F.nullif(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def title_case(c: Column) -> Column:
    """Every run of letters starts with a capital: O'NEIL-smith -> O'Neil-Smith."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(
        F.transform(
            runs,
            lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(F.substring(w, 2, 2**31 - 1))),
        ),
        "",
    )


def id_text(c: Column) -> Column:
    """An id given as text, as a number, or as an object with an ``id``."""
    return F.when(F.startswith(c, F.lit("{")), F.get_json_object(c, "$.id")).otherwise(c)


def to_zone(c: Column, zone: str) -> Column:
    """ISO 8601 text as the local wall-clock time of ``zone``.

    Text without an offset is in the session's zone, which is UTC. '', 'null' and
    anything else that is no time give NULL.
    """
    return F.convert_timezone(None, F.lit(zone), F.try_to_timestamp(c))
