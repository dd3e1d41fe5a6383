"""Value standardization of whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import text as X
from casewright.functions import values as V
from casewright.operators.joins import lookup_join
from casewright.operators.vocabulary import keep_last


def _column(df: DataFrame, name: str):
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def clean_cells(df: DataFrame) -> DataFrame:
    """Lower-case names; every text cell trimmed, collapsed, blank to null."""
    text = {f.name for f in df.schema.fields if f.dataType.typeName() == "string"}
    return df.select(
        *[(X.clean_text(F.col(c)) if c in text else F.col(c)).alias(c.strip().lower()) for c in df.columns]
    )


def drop_na_tokens(df: DataFrame, tokens: list[str] = ("", "NA", "NULL")) -> DataFrame:
    """Cells holding a missing-value token become null; opt-in, as NA is a country code."""
    return df.select(*[X.na_tokens(F.col(c), list(tokens)).alias(c) for c in df.columns])


def std_sex(df: DataFrame) -> DataFrame:
    return df.withColumn("sex", V.std_sex(_column(df, "sex")))


def std_age(df: DataFrame) -> DataFrame:
    """Replace age and unit by whole days and years."""
    days = V.age_in_days(_column(df, "age"), _column(df, "age_cod"))
    return (
        df.withColumn("age_in_days", days)
        .withColumn("age_in_years", V.age_in_years(F.col("age_in_days")))
        .drop("age", "age_cod")
    )


def std_age_group(df: DataFrame) -> DataFrame:
    return df.withColumn("age_grp", V.age_group(F.col("age_in_days"), F.col("age_in_years")))


def std_weight(df: DataFrame) -> DataFrame:
    kilos = V.weight_in_kg(_column(df, "wt"), _column(df, "wt_cod"))
    return df.withColumn("wt_in_kgs", kilos).drop("wt", "wt_cod")


def std_occupation(df: DataFrame) -> DataFrame:
    return df.withColumn("occp_cod", V.std_occupation(_column(df, "occp_cod")))


def std_outcome(df: DataFrame) -> DataFrame:
    return df.withColumn("outc_cod", V.std_outcome(F.col("outc_cod")))


def mapped(
    df: DataFrame, column: str, dim: DataFrame, key: str, value: str, out: str | None = None, measured: bool = False
) -> DataFrame:
    """``column`` through a dictionary, compared as lower-cased trimmed text; no match gives null."""
    entries = dim.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = lookup_join(df.withColumn("_key", X.lookup_key(F.col(column))), entries, ["_key"], measured=measured)
    return joined.withColumn(out or column, F.col("_value")).drop("_key", "_value")


def std_country(df: DataFrame, countries: DataFrame, measured: bool = False) -> DataFrame:
    """Country codes of event and reporter to names; absent columns are added empty."""
    for column in ("occr_country", "reporter_country"):
        df = df.withColumn(column, _column(df, column))
        df = mapped(df, column, countries, "country", "country_name", measured=measured)
    return df


def std_route(df: DataFrame, routes: DataFrame, measured: bool = False) -> DataFrame:
    """Exact spelling first, then ignoring case.

    The two lookups share one join on the lower-cased route: each entry carries
    the spellings it may match exactly.
    """
    spellings = keep_last(routes, "route").groupBy(F.lower("route").alias("_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("route", "route_st"))).alias("_exact"),
        F.max_by("route_st", "line_no").alias("_any_case"),
    )
    joined = lookup_join(df.withColumn("_key", F.lower("route")), spellings, ["_key"], measured=measured)
    return joined.withColumn(
        "route", F.coalesce(F.try_element_at("_exact", F.col("route")), F.col("_any_case"))
    ).drop("_key", "_exact", "_any_case")


def std_dose_form(df: DataFrame, forms: DataFrame, measured: bool = False) -> DataFrame:
    return mapped(df, "dose_form", forms, "dose_form", "dose_form_st", measured=measured)


def std_dose_freq(df: DataFrame, freqs: DataFrame, measured: bool = False) -> DataFrame:
    return mapped(df, "dose_freq", freqs, "dose_freq", "dose_freq_st", measured=measured)


def std_dose(df: DataFrame, units: DataFrame, measured: bool = False) -> DataFrame:
    """Dose and cumulative dose to standard units; an unknown unit leaves the amount as it is."""
    for unit, amount in (("dose_unit", "dose_amt"), ("cum_dose_unit", "cum_dose_chr")):
        if unit not in df.columns:
            continue
        entries = units.select(F.col("unit").alias("_key"), F.col("unit_st").alias("_unit"), "conversion_factor")
        df = lookup_join(df.withColumn("_key", X.lookup_key(F.col(unit))), entries, ["_key"], measured=measured)
        if amount in df.columns:
            factor = F.coalesce(F.col("conversion_factor"), F.lit(1.0))
            df = df.withColumn(amount, F.col(amount).try_cast("double") * factor)
        df = df.withColumn(unit, F.col("_unit")).drop("_key", "_unit", "conversion_factor")
    return df


def duration_days(df: DataFrame) -> DataFrame:
    return df.withColumn("dur_in_days", V.duration_in_days(F.col("dur"), F.col("dur_cod")))


def std_demo(df: DataFrame, countries: DataFrame, measured: bool = False) -> DataFrame:
    """All demographic standardizations; one projection over the raw columns plus the country lookups."""
    out = std_age_group(std_age(std_weight(std_occupation(std_sex(df)))))
    return std_country(out, countries, measured)


def encode_factors(df: DataFrame) -> DataFrame:
    """Ordered codes get a rank column; unordered factors stay as text, which Parquet stores as a dictionary."""
    ranks = {"role_cod": S.ROLE_ORDER, "outc_cod": S.OUTCOME_ORDER}
    for column, order in ranks.items():
        if column in df.columns:
            df = df.withColumn(column, V.in_codes(F.col(column), order)).withColumn(
                f"{column.split('_')[0]}_rank", V.order_rank(F.col(column), order)
            )
    return df


def finalize_demo(df: DataFrame) -> DataFrame:
    """Factor columns of the finished demographics as plain text; a missing one is added as null."""
    return df.select(
        *[c for c in df.columns if c not in S.DEMO_FACTORS],
        *[_column(df, c).cast("string").alias(c) for c in S.DEMO_FACTORS],
    )
