"""Drug and reaction vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import text as X
from casewright.operators.joins import lookup_join
from casewright.operators.numbering import RANGE_ROWS, numbered


def keep_last(df: DataFrame, key: str, order: str = "line_no") -> DataFrame:
    """Last entry of each dictionary key in file order."""
    newest = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def drug_dictionary(raw: DataFrame) -> DataFrame:
    """(drugname, substance) with cleaned names, the last entry of a name, no empty substance."""
    cleaned = raw.select(
        X.clean_drugname(F.col("drugname")).alias("drugname"),
        F.coalesce("substance", F.lit(S.UNKNOWN_SUBSTANCE)).alias("substance"),
        "line_no",
    ).filter(F.col("drugname").isNotNull())
    return keep_last(cleaned, "drugname").drop("line_no")


def explode_substances(df: DataFrame, column: str = "substance") -> DataFrame:
    """One row per substance of a ``;`` list."""
    return df.withColumn(column, F.explode(F.split(column, ";"))).withColumn(column, F.trim(column))


def trial_flag(df: DataFrame, column: str = "substance") -> DataFrame:
    """Mark substances that carry the trial marker and take the marker off."""
    return df.withColumn("trial", F.coalesce(F.contains(column, F.lit(S.TRIAL_MARK)), F.lit(False))).withColumn(
        column, F.replace(F.col(column), F.lit(S.TRIAL_MARK), F.lit(""))
    )


def drug_synonyms(raw: DataFrame) -> DataFrame:
    """(drugname, substance) rows from a list of comma-separated variations per standard name."""
    rows = raw.select(
        F.explode(F.split("common_variations", ",")).alias("drugname"), F.lower("standardized_name").alias("substance"), "line_no"
    ).withColumn("drugname", X.clean_drugname(F.col("drugname")))
    return keep_last(rows.filter(F.col("drugname") != ""), "drugname").drop("line_no")


def standardize_drugs(
    df: DataFrame, dictionary: DataFrame, synonyms: DataFrame | None = None, measured: bool = False
) -> DataFrame:
    """Clean names, look the substance up, one row per substance, trial marker to a flag.

    A name the dictionary lacks is looked up among the synonyms if given, else it
    is ``UNKNOWN``.
    """
    if "drugname" not in df.columns:
        df = df.withColumnRenamed("drug_name", "drugname")
    named = df.withColumn("drugname", F.coalesce(X.clean_drugname(F.col("drugname")), F.lit(""))).drop("substance")
    out = lookup_join(named, dictionary, ["drugname"], measured=measured)
    if synonyms is not None:
        out = lookup_join(out, synonyms.withColumnRenamed("substance", "_synonym"), ["drugname"], measured=measured)
        out = out.withColumn("substance", F.coalesce("substance", "_synonym")).drop("_synonym")
    out = out.withColumn("substance", F.coalesce("substance", F.lit(S.UNKNOWN_SUBSTANCE)))
    return trial_flag(explode_substances(out))


def drug_stats(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("substance").alias("n_substances"),
        F.count_if("trial").alias("n_trial"),
    )


def llt_to_pt(llt: DataFrame, pt: DataFrame) -> DataFrame:
    """(llt_name, pt_name) in upper case, the last entry of a repeated term."""
    joined = lookup_join(llt, pt.select("pt_code", "pt_name"), ["pt_code"])
    return keep_last(
        joined.select(F.upper("llt_name").alias("llt_name"), F.upper("pt_name").alias("pt_name"), "line_no"),
        "llt_name",
    ).drop("line_no")


def term_dictionary(pts: DataFrame, llt_pt: DataFrame, fixes: DataFrame) -> DataFrame:
    """(term, standard_pt): a preferred term stands for itself, then low-level terms, then manual fixes.

    The three lists become one, so data rows need a single lookup.
    """
    entries = (
        pts.select(X.lookup_key(F.col("pt_name")).alias("term"), X.lookup_key(F.col("pt_name")).alias("standard_pt"), F.lit(1).alias("source"))
        .unionByName(llt_pt.select(X.lookup_key(F.col("llt_name")).alias("term"), X.lookup_key(F.col("pt_name")).alias("standard_pt"), F.lit(2).alias("source")))
        .unionByName(fixes.select(X.lookup_key(F.col("pt")).alias("term"), X.lookup_key(F.col("standard_pt")).alias("standard_pt"), F.lit(3).alias("source")))
    )
    usable = entries.filter(F.col("term").isNotNull() & F.col("standard_pt").isNotNull())
    return usable.groupBy("term").agg(F.min(F.struct("source", "standard_pt")).alias("best")).select("term", "best.standard_pt")


def standardize_pt(df: DataFrame, column: str, terms: DataFrame, measured: bool = False) -> DataFrame:
    """Replace a reaction column by its standard term; no match gives null."""
    keyed = df.withColumn("term", X.lookup_key(F.col(column)))
    return lookup_join(keyed, terms, ["term"], measured=measured).withColumn(column, F.col("standard_pt")).drop("term", "standard_pt")


def pt_frequency(df: DataFrame, column: str, pts: DataFrame, terms: DataFrame, measured: bool = False) -> DataFrame:
    """Per term: rows, share of all rows, whether it is a preferred term and its standard form."""
    counted = (
        df.select(X.lookup_key(F.col(column)).alias("term")).filter(F.col("term").isNotNull()).groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    )
    total = counted.agg(F.sum("n")).scalar()
    names = pts.select(X.lookup_key(F.col("pt_name")).alias("term"), F.lit(True).alias("is_pt")).distinct()
    out = lookup_join(lookup_join(counted, names, ["term"], measured=measured), terms, ["term"], measured=measured)
    return out.select(
        "term", "n", F.round(F.col("n") / total * 100, 2).alias("pct"),
        F.coalesce("is_pt", F.lit(False)).alias("is_pt"), "standard_pt",
    )


def pt_coverage(frequency: DataFrame) -> DataFrame:
    """Share of rows not standard before, and standard after the lookups."""
    n = F.sum("n")
    return frequency.agg(
        n.alias("n_rows"),
        F.round(F.sum(F.when(F.col("is_pt"), 0).otherwise(F.col("n"))) * 100 / n, 3).alias("pct_nonstandard_before"),
        F.round(F.sum(F.when(F.col("standard_pt").isNotNull(), F.col("n")).otherwise(0)) * 100 / n, 3).alias("pct_standard_after"),
    )


def pt_worklist(df: DataFrame, column: str, terms: DataFrame, fixes: DataFrame, measured: bool = False) -> DataFrame:
    """The manual fix list with every term no list knows appended without a target."""
    found = df.select(X.lookup_key(F.col(column)).alias("term")).filter(F.col("term").isNotNull()).distinct()
    unknown = lookup_join(found, terms.select("term"), ["term"], how="left_anti", measured=measured)
    known = fixes.select(X.lookup_key(F.col("pt")).alias("pt"), F.trim("standard_pt").alias("standard_pt"))
    return known.unionByName(unknown.select(F.col("term").alias("pt"), F.lit(None).cast("string").alias("standard_pt"))).distinct()


def flat_hierarchy(levels: list[tuple[DataFrame, DataFrame | None]], names: list[str]) -> DataFrame:
    """Flat term tree with the position of each lowest term.

    ``levels`` goes from the top: each entry is the (code, name) frame of a level
    and the (code, child_code) links to the next one, none for the lowest.
    The rank is a dictionary-sized sort, one row per term of the vocabulary.
    """
    frame, links = levels[0]
    flat = frame.select("code", F.col("name").alias(names[0]))
    for (frame, next_links), name in zip(levels[1:], names[1:]):
        down = links.select("code", "child_code")
        flat = (
            flat.join(down, "code")
            .select(*[n for n in flat.columns if n != "code"], F.col("child_code").alias("code"))
            .join(frame.select("code", F.col("name").alias(name)), "code")
        )
        links = next_links
    return with_term_rank(flat.drop("code"), names)


def with_term_rank(flat: DataFrame, names: list[str], range_rows: int = RANGE_ROWS) -> DataFrame:
    """Number the terms in tree order without sending all of them, or of a branch, to one task."""
    return numbered(flat, names, "pt_rank", range_rows=range_rows).withColumn("pt_rank", F.col("pt_rank").cast("int"))


def term_ranks(hierarchy: DataFrame) -> DataFrame:
    """Lowest rank of each term; the same frame for each call, so it is measured once for all columns."""
    if "_casewright_ranks" not in hierarchy.__dict__:
        hierarchy.__dict__["_casewright_ranks"] = hierarchy.groupBy(X.lookup_key(F.col("pt")).alias("_term")).agg(F.min("pt_rank").alias("_rank"))
    return hierarchy.__dict__["_casewright_ranks"]


def rank_terms(df: DataFrame, column: str, hierarchy: DataFrame, measured: bool = False) -> DataFrame:
    """Rank column of an ordered term, found whatever its case; a term outside the vocabulary gives null for both."""
    ranks = term_ranks(hierarchy)
    out = lookup_join(df.withColumn("_term", X.lookup_key(F.col(column))), ranks, ["_term"], measured=measured)
    return (
        out.withColumn(column, F.when(F.col("_rank").isNotNull(), F.col(column)))
        .withColumnRenamed("_rank", f"{column}_rank")
        .select(*df.columns, f"{column}_rank")
    )
