"""Reference dimensions: built-in lists and loaders for files."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions.text import lookup_key
from casewright.operators.vocabulary import keep_last

# ---------------------------------------------------------------------------
# Built-in dictionaries, used when no file is given.
# ---------------------------------------------------------------------------
COUNTRIES = [
    ("us", "United States"), ("uk", "United Kingdom"), ("fr", "France"), ("de", "Germany"), ("it", "Italy"),
    ("es", "Spain"), ("cn", "China"), ("jp", "Japan"), ("kr", "South Korea"), ("ca", "Canada"),
    ("au", "Australia"), ("nz", "New Zealand"),
]
# Codes with a fixed meaning that no file changes; null means "not a country".
COUNTRY_OVERRIDES = [("xe", "Europe"), ("qu", "Oceania"), ("country not specified", None), ("a1", None), ("", None)]
ROUTES = [
    ("ORAL", "ORAL"), ("PO", "ORAL"), ("BY MOUTH", "ORAL"), ("IV", "INTRAVENOUS"), ("INTRAVENOUS", "INTRAVENOUS"),
    ("IM", "INTRAMUSCULAR"), ("INTRAMUSCULAR", "INTRAMUSCULAR"), ("SC", "SUBCUTANEOUS"),
    ("SUBCUTANEOUS", "SUBCUTANEOUS"), ("TOPICAL", "TOPICAL"), ("TOP", "TOPICAL"), ("INHALED", "INHALED"), ("INH", "INHALED"),
]
DOSE_FORMS = [
    ("TAB", "TABLET"), ("TABLET", "TABLET"), ("TABS", "TABLET"), ("CAP", "CAPSULE"), ("CAPSULE", "CAPSULE"),
    ("CAPS", "CAPSULE"), ("SOL", "SOLUTION"), ("SOLUTION", "SOLUTION"), ("SUSP", "SUSPENSION"),
    ("SUSPENSION", "SUSPENSION"), ("INJ", "INJECTION"), ("INJECTION", "INJECTION"), ("CREAM", "CREAM"),
    ("OINT", "OINTMENT"), ("OINTMENT", "OINTMENT"),
]
DOSE_FREQS = [
    ("QD", "ONCE DAILY"), ("ONCE DAILY", "ONCE DAILY"), ("DAILY", "ONCE DAILY"), ("BID", "TWICE DAILY"),
    ("TWICE DAILY", "TWICE DAILY"), ("TID", "THREE TIMES DAILY"), ("THREE TIMES DAILY", "THREE TIMES DAILY"),
    ("QID", "FOUR TIMES DAILY"), ("FOUR TIMES DAILY", "FOUR TIMES DAILY"), ("PRN", "AS NEEDED"),
    ("AS NEEDED", "AS NEEDED"), ("WEEKLY", "WEEKLY"), ("QW", "WEEKLY"), ("BIW", "TWICE WEEKLY"), ("TWICE WEEKLY", "TWICE WEEKLY"),
]
# Mass units in milligrams; the published unit list is not available.
UNITS = [("mg", "MG", 1.0), ("g", "MG", 1000.0), ("ug", "MG", 0.001), ("kg", "MG", 1000000.0), ("ml", "ML", 1.0)]
PT_FIXES = [
    ("headache nos", "headache"), ("back pain nos", "back pain"), ("nausea nos", "nausea"), ("dizziness nos", "dizziness"),
    ("fatigue nos", "fatigue"), ("chest pain nos", "chest pain"), ("abdominal pain nos", "abdominal pain"),
    ("vomiting nos", "vomiting"), ("diarrhoea nos", "diarrhoea"), ("dyspnoea nos", "dyspnoea"),
]

LAYOUTS = {
    "country": ("country", "country_name"),
    "route": ("route", "route_st"),
    "dose_form": ("dose_form", "dose_form_st"),
    "dose_freq": ("dose_freq", "dose_freq_st"),
    "unit": ("unit", "unit_st", "conversion_factor"),
    "pt_fix": ("pt", "standard_pt"),
}
BUILT_IN = {
    "country": COUNTRIES, "route": ROUTES, "dose_form": DOSE_FORMS, "dose_freq": DOSE_FREQS, "unit": UNITS, "pt_fix": PT_FIXES,
}


def _literal(value) -> str:
    if value is None:
        return "CAST(NULL AS STRING)"
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else f"CAST({value} AS DOUBLE)"


def values_sql(rows: list[tuple], columns: tuple[str, ...]) -> str:
    """A small list as an inline SQL table, whose exact size the planner knows."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return f"SELECT * FROM (VALUES {body}) AS t({', '.join(columns)})"


def _key(name: str):
    """Routes match their exact spelling first, all other keys in folded form."""
    key = F.col(LAYOUTS[name][0])
    return F.trim(key) if name == "route" else lookup_key(key)


def _finish(raw: DataFrame, name: str) -> DataFrame:
    """Clean a list of (columns, line_no): keys folded, values trimmed, last entry of a key kept."""
    key, value, *rest = LAYOUTS[name]
    out = keep_last(raw.select(_key(name).alias(key), F.trim(value).alias(value), *rest, "line_no").filter(F.col(key).isNotNull()), key)
    if name == "country":
        fixed = raw.sparkSession.sql(values_sql(COUNTRY_OVERRIDES, (key, value)))
        named = out.select(key, F.coalesce(value, F.lit("NA")).alias(value))
        return named.join(F.broadcast(fixed), key, "left_anti").unionByName(fixed)
    if name == "unit":
        out = out.withColumn("conversion_factor", F.col("conversion_factor").try_cast("double"))
    return out if name == "route" else out.drop("line_no")


def built_in(spark: SparkSession, name: str) -> DataFrame:
    """A built-in list; its keys are unique as written, so it stays an inline table."""
    key, value, *rest = LAYOUTS[name]
    rows = BUILT_IN[name] + (COUNTRY_OVERRIDES if name == "country" else [])
    numbered = [(*row, float(i)) for i, row in enumerate(rows)]
    table = spark.sql(values_sql(numbered, (key, value, *rest, "line_no")))
    out = table.select(_key(name).alias(key), value, *rest, "line_no")
    return out if name == "route" else out.drop("line_no")


def _read(spark: SparkSession, path: str, sep: str, columns: list[str] | None = None) -> DataFrame:
    """Small delimited file with its line order; the named columns are found ignoring case."""
    reader = spark.read.option("sep", sep).option("header", True)
    if columns is not None and sep == "$":
        reader = reader.option("quote", "").schema(S.text_schema(columns))
    raw = reader.csv(path)
    return raw.select(*raw.columns, F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("line_no"))


def load_dim(spark: SparkSession, path: str, name: str, sep: str = ";") -> DataFrame:
    """A dictionary file; an absent file gives an empty dictionary."""
    try:
        raw = _read(spark, path, sep)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        empty = ", ".join(f"{c} {'double' if c == 'conversion_factor' else 'string'}" for c in LAYOUTS[name])
        return _finish(spark.createDataFrame([], f"{empty}, line_no bigint"), name)
    have = {c.strip().lower(): c for c in raw.columns}
    return _finish(raw.select(*[F.col(f"`{have[c]}`").alias(c) for c in LAYOUTS[name]], "line_no"), name)


def load_dims(spark: SparkSession, folder: str | None = None, files: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """All dictionaries: from ``folder`` where a file is named for it, else the built-in list."""
    files = files or {}
    return {
        name: load_dim(spark, f"{folder}/{files[name]}", name) if folder and name in files else built_in(spark, name)
        for name in LAYOUTS
    }


# Column layouts of the term tables, as published with a header line.
LLT_COLUMNS = [
    "llt_code", "llt_name", "pt_code", "llt_whoart_code", "llt_harts_code", "llt_costart_sym", "llt_icd9_code",
    "llt_icd9cm_code", "llt_icd10_code", "llt_currency", "llt_jart_code",
]
PT_COLUMNS = [
    "pt_code", "pt_name", "null_field", "pt_soc_code", "pt_whoart_code", "pt_harts_code", "pt_costart_sym",
    "pt_icd9_code", "pt_icd9cm_code", "pt_icd10_code", "pt_jart_code",
]


def load_terms(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(llt, pt) term tables with their line order."""
    return (
        _read(spark, f"{folder}/llt.asc", "$", LLT_COLUMNS),
        _read(spark, f"{folder}/pt.asc", "$", PT_COLUMNS),
    )


def load_hierarchy_levels(spark: SparkSession, folder: str) -> list[tuple[DataFrame, DataFrame | None]]:
    """(code, name) and (code, child_code) frames from the top level down."""

    def level(name: str, links: str | None):
        codes = spark.read.option("sep", "$").option("header", True).option("quote", "").csv(f"{folder}/{name}.asc")
        frame = codes.select(F.col(f"{name}_code").alias("code"), F.col(f"{name}_name").alias("name"))
        if links is None:
            return frame, None
        raw = spark.read.option("sep", "$").option("header", True).option("quote", "").csv(f"{folder}/{links}.asc")
        parent, child = raw.columns[:2]
        return frame, raw.select(F.col(parent).alias("code"), F.col(child).alias("child_code"))

    return [level("soc", "soc_hlgt"), level("hlgt", "hlgt_hlt"), level("hlt", "hlt_pt"), level("pt", None)]


def load_drug_list(spark: SparkSession, path: str, sep: str = ";") -> DataFrame:
    """(drugname, substance, line_no) of a drug dictionary file."""
    raw = _read(spark, path, sep)
    have = {c.strip().lower(): c for c in raw.columns}
    return raw.select(F.col(f"`{have['drugname']}`").alias("drugname"), F.col(f"`{have['substance']}`").alias("substance"), "line_no")


def load_synonyms(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, ",")
