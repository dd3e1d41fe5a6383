"""Text expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# All signs Unicode counts as white space.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def clean_text(c: Column) -> Column:
    """Trim, collapse inner white space to one blank, blank to null.

    Most cells hold plain signs and single blanks, which a cheaper look tells.
    """
    plain = c.rlike(r"\A[ -~]*+\z") & ~c.contains("  ")
    return F.nullif(F.trim(F.when(plain, c).otherwise(F.regexp_replace(c, r"(?U)\s+", " "))), F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Null for cells of white space only; one that starts with a plain sign is none."""
    return F.when(((c >= "!") & (c < "\x7f")) | ~c.rlike(r"(?U)^\s*$"), c)


def clean_drugname(c: Column) -> Column:
    """Lower case, one final dot off, blanks collapsed, only word signs, blanks and ``-``.

    The letter classes are spelled out because a plain Java ``\\w`` would drop
    accented letters.
    """
    lowered = F.regexp_replace(F.lower(c), r"\.$", "")
    collapsed = F.trim(F.regexp_replace(lowered, r"(?U)\s+", " "))
    return F.regexp_replace(collapsed, r"(?U)[^\p{L}\p{N}_\s-]", "")


def clean_line(c: Column) -> Column:
    """Drop NUL and outer line ends, escape quotes that are not yet escaped."""
    bare = F.regexp_replace(F.regexp_replace(c, r"\x00", ""), r"^[\r\n]+|[\r\n]+$", "")
    return F.regexp_replace(bare, r'(?<!\\)"', r'\\"')


def lookup_key(c: Column) -> Column:
    """Form in which both sides of a vocabulary lookup are compared."""
    return F.lower(F.btrim(c, F.lit(BLANKS)))


def na_tokens(c: Column, tokens: list[str]) -> Column:
    """Null for cells holding one of the missing-value tokens."""
    return F.when(~c.isin(tokens), c)


def quarter_label(c: Column) -> Column:
    """``DEMO18Q1.txt`` or ``.../2018q1/...`` to ``2018Q1``; null when there is none.

    Four-digit years are taken as they are, two-digit years above 50 belong to
    the last century.
    """
    token = F.regexp_extract(c, r"(?i)(\d{4}|\d{2})q[1-4](?!\d)", 0)
    year = F.substring_index(F.upper(token), "Q", 1)
    century = (
        F.when(F.length(year) == 4, F.lit(""))
        .when(year.try_cast("int") > 50, F.lit("19"))
        .otherwise(F.lit("20"))
    )
    return F.when(token != "", F.concat(century, F.upper(token)))


def valid_quarter(c: Column, first_year: int = 2004) -> Column:
    """True for ``YYYYqN`` from the first published year on."""
    return c.rlike(r"(?i)^\d{4}q[1-4]$") & (F.substring(c, 1, 4).try_cast("int") >= first_year)


def era_prefix(year: Column, old: str, new: str, switch_year: int = 2013) -> Column:
    """File-name prefix of an archive by its year."""
    return F.when(year >= switch_year, F.lit(new)).otherwise(F.lit(old))
