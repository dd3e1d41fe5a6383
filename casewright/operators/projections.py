"""Column unification of the two schema eras."""

from __future__ import annotations

import logging
from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions.text import blank_to_null

log = logging.getLogger(__name__)


def resolve_columns(columns: list[str], wanted: list[str]) -> dict[str, str]:
    """Requested name to actual name, ignoring case and outer blanks; absent names left out."""
    by_lower = {c.strip().lower(): c for c in reversed(columns)}
    return {w: by_lower[w.strip().lower()] for w in wanted if w.strip().lower() in by_lower}


def rename_columns(df: DataFrame, names: dict[str, str], header: list[str] | None = None) -> DataFrame:
    """Lower-case all names and apply ``names`` in any case.

    When several columns end under one name the first non-null value wins, the
    column that already bears the name going first. ``header`` gives the names by
    position when the frame itself cannot hold them.
    """
    lowered = {k.lower(): v for k, v in names.items()}
    sources: dict[str, list[str]] = defaultdict(list)
    renamed = []
    for i, column in enumerate(header or df.columns):
        # Positions, since a raw header may hold names that differ only in case.
        bare = column.strip().lower()
        target = lowered.get(bare, bare)
        renamed.append(f"_{i}")
        if target == bare:
            sources[target].insert(0, f"_{i}")
        else:
            sources[target].append(f"_{i}")
    flat = df.toDF(*renamed)
    return flat.select(
        *[
            (F.col(cols[0]) if len(cols) == 1 else F.coalesce(*[F.col(c) for c in cols])).alias(target)
            for target, cols in sources.items()
        ]
    )


def standardize_columns(df: DataFrame, names: dict[str, str], required: list[str]) -> DataFrame:
    """Rename, then append the required columns that are missing as nulls."""
    out = rename_columns(df, names)
    missing = [c for c in required if c not in out.columns]
    return out.select("*", *[F.lit(None).cast("string").alias(c) for c in missing])


def missing_columns(df: DataFrame, kind: str) -> list[str]:
    """Unified columns of a kind that a raw frame cannot fill."""
    have = rename_columns(df, S.ERA_NAMES[kind]).columns
    return [c for c in S.TABLES[kind] if c not in have]


def project(df: DataFrame, kind: str, fill_empty: bool = False) -> DataFrame:
    """Unified columns of one file kind; an unknown kind passes through."""
    if kind not in S.TABLES:
        log.warning("unknown kind %s: columns left as they are", kind)
        return df
    columns = S.TABLES[kind]
    out = standardize_columns(df, S.ERA_NAMES[kind], columns)
    out = out.select(*columns, *(["quarter"] if "quarter" in out.columns and "quarter" not in columns else []))
    return out.na.fill("") if fill_empty else out


def unify_data(
    frames: list[DataFrame],
    names: dict[str, str],
    columns: list[str],
    dup_pairs: list[tuple[str, str]] = (),
) -> DataFrame:
    """One table from frames of several layouts.

    Frames are renamed and stacked by name, a null in the first column of a pair
    takes the value of the second, only ``columns`` stay, blanks become null and
    equal rows are kept once.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True), [rename_columns(f, names) for f in frames]
    )
    have = set(stacked.columns)
    filled = {
        x: F.coalesce(*[F.col(c) for c in (x, y) if c in have]) for x, y in dup_pairs if have & {x, y}
    }
    lost = sorted(have - set(columns))
    if lost:
        log.info("columns not kept: %s", "; ".join(lost))

    def value(name: str):
        if name in filled:
            return filled[name]
        return F.col(name) if name in have else F.lit(None).cast("string")

    return stacked.select(*[blank_to_null(value(c)).alias(c) for c in columns]).distinct()


def unify(frames: list[DataFrame], kind: str) -> DataFrame:
    """Unified table of one kind; rows without the term they exist for are dropped."""
    names = dict(S.ERA_NAMES[kind])
    pairs = []
    if kind == "drug_info":
        names.pop("lot_nbr")
        pairs = [("lot_num", "lot_nbr")]
    out = unify_data(frames, names, S.TABLES[kind], pairs)
    needed = {"indi": "indi_pt", "outc": "outc_cod", "reac": "pt"}.get(kind)
    return out.filter(F.col(needed).isNotNull()) if needed else out
