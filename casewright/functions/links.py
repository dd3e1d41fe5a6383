"""Expressions over page text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hrefs(html: Column) -> Column:
    """Targets of all anchors of a page, in page order."""
    return F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1))


def archive_quarter(href: Column, prefixes: list[str] | None = None) -> Column:
    """``YYYYqN`` of an archive link, null for any other link.

    ``prefixes`` names the accepted file prefixes; without it any word is taken.
    """
    word = "|".join(prefixes) if prefixes else "[a-z]+"
    pattern = rf"(?i)(?:{word})_ascii_(\d{{4}})q([1-4])\.zip$"
    year, number = F.regexp_extract(href, pattern, 1), F.regexp_extract(href, pattern, 2)
    return F.when(year != "", F.concat(year, F.lit("q"), number))
