"""Split of the cleaned release into its ten tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.operators.standardize import encode_factors
from casewright.operators.vocabulary import rank_terms


#: Tasks that the rows of a report with very many rows are spread over, and the column that tells them apart.
PARTS, PART = 32, "_part"
#: Column whose value decides in which part a row of such a report goes; rows that end up equal share it.
PART_BY = {
    "drug": "drug_seq", "drug_info": "drug_seq", "indi": "drug_seq", "ther": "drug_seq", "reac": "pt", "outc": "outc_cod", "rpsr": "rpsr_cod",
}


def with_part(df: DataFrame, by: str, hot: list[int]) -> DataFrame:
    """Rows with their part: 0, or for reports whose hash is among ``hot`` one of ``PARTS`` by a column's value."""
    if not hot:
        return df.withColumn(PART, F.lit(0).cast("long"))
    spread = F.pmod(F.xxhash64(by), F.lit(PARTS))
    return df.withColumn(PART, F.when(F.xxhash64("primaryid").isin(hot), spread).otherwise(F.lit(0).cast("long")))


def in_all_parts(demo: DataFrame, hot: list[int]) -> DataFrame:
    """Reports once per part their rows may lie in."""
    if not hot:
        return demo.withColumn(PART, F.lit(0).cast("long"))
    last = F.when(F.xxhash64("primaryid").isin(hot), F.lit(PARTS - 1)).otherwise(0).cast("long")
    return demo.withColumn(PART, F.explode(F.sequence(F.lit(0).cast("long"), last)))


def _keys(*frames: DataFrame) -> list[str]:
    """Report id, and the part where all frames have one."""
    return ["primaryid", *([PART] if all(PART in f.columns for f in frames) else [])]


def _part(df: DataFrame) -> list[str]:
    return [PART] if PART in df.columns else []


def of_reports(df: DataFrame, demo: DataFrame) -> DataFrame:
    """Rows that belong to a report of the release."""
    keys = _keys(df, demo)
    return df.join(demo.select(*keys), keys, "left_semi").select(*df.columns)


def split_demo(demo: DataFrame) -> DataFrame:
    return demo.select(*S.SPLIT["demo"])


def split_demo_supp(demo: DataFrame, rpsr: DataFrame, how: str = "inner") -> DataFrame:
    """Administrative fields, one row per source; ``how='left'`` also keeps reports without one."""
    keys = _keys(demo, rpsr)
    supp = demo.select(*S.SPLIT["demo_supp"], *keys[1:])
    return supp.join(rpsr.select(*keys, "rpsr_cod"), keys, how).select(*S.SPLIT["demo_supp"], "rpsr_cod")


def _slice(df: DataFrame, demo: DataFrame, name: str) -> DataFrame:
    """The columns of a table for the release's reports, equal rows once."""
    return of_reports(df.select(*S.SPLIT[name], *_part(df)), demo).distinct()


def split_drug(drug: DataFrame, demo: DataFrame) -> DataFrame:
    return encode_factors(_slice(drug, demo, "drug").drop(PART))


def split_drug_name(drug: DataFrame, drug_info: DataFrame, demo: DataFrame) -> DataFrame:
    """Distinct names with the coding fields of the same drug line."""
    info = of_reports(drug_info.select("primaryid", "drug_seq", "val_vbm", "nda_num", *_part(drug_info)), demo)
    names = _slice(drug, demo, "drug_name")
    return info.join(names, [*_keys(info, names), "drug_seq"]).select("primaryid", "drug_seq", "val_vbm", "nda_num", "drugname", "prod_ai")


def split_reac(reac: DataFrame, demo: DataFrame, hierarchy: DataFrame, measured: bool = False) -> DataFrame:
    """Reactions with their rank in the term tree; repeats stay."""
    out = of_reports(reac.select(*S.SPLIT["reac"], *_part(reac)), demo).drop(PART)
    ranked = rank_terms(out, "pt", hierarchy, measured)
    return rank_terms(ranked, "drug_rec_act", hierarchy, measured)


def split_outc(outc: DataFrame, demo: DataFrame) -> DataFrame:
    return encode_factors(of_reports(outc.select(*S.SPLIT["outc"], *_part(outc)), demo)).distinct().drop(PART)


def split_indi(indi: DataFrame, demo: DataFrame, hierarchy: DataFrame, measured: bool = False) -> DataFrame:
    out = of_reports(indi.select(*S.SPLIT["indi"], *_part(indi)), demo)
    return rank_terms(out, "indi_pt", hierarchy, measured).distinct().drop(PART)


def split_ther(ther: DataFrame, demo: DataFrame) -> DataFrame:
    return _slice(ther, demo, "ther").drop(PART)


def split_doses(drug_info: DataFrame, demo: DataFrame) -> DataFrame:
    return _slice(drug_info, demo, "doses").drop(PART)


def split_drug_supp(drug_info: DataFrame, demo: DataFrame) -> DataFrame:
    return _slice(drug_info, demo, "drug_supp").drop(PART)


def split_tables(tables: dict[str, DataFrame], hierarchy: DataFrame, reports: DataFrame | None = None) -> dict[str, DataFrame]:
    """All ten tables of a release; ``tables['demo']`` decides which reports are in.

    ``reports`` may hold the same reports dealt like the tables (``in_all_parts``, ``with_part``): joins then move nothing.
    """
    demo = tables["demo"]
    reports = demo if reports is None else reports
    return {
        "demo": split_demo(demo),
        "demo_supp": split_demo_supp(reports, tables["rpsr"]),
        "drug": split_drug(tables["drug"], reports),
        "drug_name": split_drug_name(tables["drug"], tables["drug_info"], reports),
        "reac": split_reac(tables["reac"], reports, hierarchy),
        "outc": split_outc(tables["outc"], reports),
        "indi": split_indi(tables["indi"], reports, hierarchy),
        "ther": split_ther(tables["ther"], reports),
        "doses": split_doses(tables["drug_info"], reports),
        "drug_supp": split_drug_supp(tables["drug_info"], reports),
    }
