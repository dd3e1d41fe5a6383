"""Profiles, validation and run summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import values as V
from casewright.functions.text import lookup_key
from casewright.operators.joins import lookup_join
from casewright.operators.numbering import RANGE_ROWS, quantiles


def value_distribution(df: DataFrame, column: str, digits: int = 2) -> DataFrame:
    """Value, rows and share of all rows, null included."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.select("value", "n", F.round(100.0 * F.col("n") / total, digits).alias("pct"))


def top_values(df: DataFrame, column: str, k: int = 5) -> DataFrame:
    """The ``k`` most frequent non-null values."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "value")
        .limit(k)
    )


QUARTILES = [0.25, 0.5, 0.75]


def describe(df: DataFrame, column: str, digits: int = 6, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Count, mean, deviation, extremes and linear quartiles, exact for any number of different values."""
    c = F.col(column)
    q25, q50, q75 = quantiles(df, column, QUARTILES, range_rows)
    out = df.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
    number = lambda q: F.lit(q).cast("double")
    return out.select(
        "n", F.round("mean", digits).alias("mean"), F.round("std", digits).alias("std"), "min",
        number(q25).alias("q25"), number(q50).alias("q50"), number(q75).alias("q75"), "max",
    )


def manufacturer_profile(df: DataFrame) -> DataFrame:
    """Rows, cases, senders, rows without sender, rows left after the last per case and sender.

    Rows are counted per case and sender first; all figures follow from the pairs.
    """
    pairs = df.groupBy("caseid", "mfr_sndr").agg(F.count(F.lit(1)).alias("n"))
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    return pairs.agg(
        rows(F.lit(True)).alias("n_rows"),
        F.countDistinct("caseid").alias("n_cases"),
        F.countDistinct("mfr_sndr").alias("n_senders"),
        rows(F.col("mfr_sndr").isNull()).alias("n_no_sender"),
        F.count_if(F.col("caseid").isNotNull() & F.col("mfr_sndr").isNotNull()).alias("n_last_rows"),
    )


def manufacturers_per_case(df: DataFrame) -> DataFrame:
    """How many cases have two, three, ... senders."""
    pairs = df.filter(F.col("caseid").isNotNull() & F.col("mfr_sndr").isNotNull()).select("caseid", "mfr_sndr").distinct()
    per_case = pairs.groupBy("caseid").agg(F.count(F.lit(1)).alias("n_senders"))
    return per_case.filter("n_senders > 1").groupBy("n_senders").agg(F.count(F.lit(1)).alias("n_cases"))


def coverage(df: DataFrame, column: str) -> DataFrame:
    """Rows with and without a standard value."""
    total, done = F.count(F.lit(1)), F.count(column)
    return df.agg(
        total.alias("n_rows"), done.alias("n_standard"), (total - done).alias("n_nonstandard"),
        F.round(F.when(total > 0, 100.0 * done / total), 1).alias("pct_standard"),
    )


def unmapped_values(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct cleaned values a dictionary lacks, with their rows."""
    counted = (
        df.select(lookup_key(F.col(column)).alias("value")).filter(F.col("value").isNotNull())
        .groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    )
    return lookup_join(counted, dim.select(F.col(key).alias("value")), ["value"], how="left_anti")


def _is_date(c: Column) -> Column:
    return V.full_date(c).isNotNull()


def bad_cells(df: DataFrame, kind: str) -> list[tuple[str, str, Column]]:
    """(rule, column, value) per rule of the kind: the offending value, null when the cell is fine."""
    cells = []
    for column, allowed in S.ALLOWED.get(kind, {}).items():
        if column in df.columns:
            value = F.upper(F.col(column)) if column in S.UPPER_RULES else F.col(column)
            cells.append(("allowed_values", column, F.when(~value.isin(allowed), value)))
    for column in S.DATE_FIELDS.get(kind, []):
        if column in df.columns:
            text = F.col(column).cast("string")
            cells.append(("full_date", column, F.when(~_is_date(text), text)))
    return cells


def invalid_values(df: DataFrame, kind: str) -> DataFrame:
    """Every distinct offending value per rule and column, with its rows."""
    cells = [F.struct(F.lit(r).alias("rule"), F.lit(c).alias("column_name"), v.alias("value")) for r, c, v in bad_cells(df, kind)]
    bad = F.filter(F.array(*cells), lambda x: x["value"].isNotNull())
    return (
        df.select(F.explode(bad).alias("b"))
        .groupBy("b.rule", "b.column_name", "b.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


REPORT_SCHEMA = "kind string, rule string, column_name string, severity string, n_bad bigint, n_values bigint, first_value string, last_value string"


def validate(df: DataFrame, kind: str) -> DataFrame:
    """Findings of one table: errors for missing columns, warnings for bad values.

    A table that lacks a required column is invalid and not looked at further.
    """
    spark = df.sparkSession
    if kind not in S.REQUIRED:
        return spark.createDataFrame([(kind, "unknown_kind", None, "error", None, None, None, None)], REPORT_SCHEMA)
    absent = [c for c in S.REQUIRED[kind] if c not in df.columns]
    if absent:
        rows = [(kind, "required_column", c, "error", None, None, None, None) for c in absent]
        return spark.createDataFrame(rows, REPORT_SCHEMA)
    if not bad_cells(df, kind):
        return spark.createDataFrame([], REPORT_SCHEMA)
    return (
        invalid_values(df, kind)
        .groupBy("rule", "column_name")
        .agg(
            F.sum("n").alias("n_bad"), F.count(F.lit(1)).alias("n_values"),
            F.min("value").alias("first_value"), F.max("value").alias("last_value"),
        )
        .select(F.lit(kind).alias("kind"), "rule", "column_name", F.lit("warning").alias("severity"),
                "n_bad", "n_values", "first_value", "last_value")
    )


def validation_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Findings of several tables as one frame."""
    out = None
    for kind, df in tables.items():
        found = validate(df, kind)
        out = found if out is None else out.unionByName(found)
    return out


def validation_result(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table: its rows, and whether it is free of errors; each table is read once."""
    out = None
    for kind, df in tables.items():
        known = kind in S.REQUIRED
        errors = sum(c not in df.columns for c in S.REQUIRED[kind]) if known else 1
        # A table with errors is not looked at further.
        rules = bad_cells(df, kind) if known and not errors else []
        figures = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count(v).alias(f"n_{i}") for i, (_, _, v) in enumerate(rules)])
        warnings = sum((F.when(F.col(f"n_{i}") > 0, 1).otherwise(0) for i in range(len(rules))), F.lit(0))
        row = figures.select(
            F.lit(kind).alias("kind"), "n_rows", F.lit(errors == 0).alias("valid"), F.lit(errors).cast("long").alias("n_errors"), warnings.cast("long").alias("n_warnings"))
        out = row if out is None else out.unionByName(row)
    return out


def bad_date(name: str) -> Column:
    text = F.col(name).cast("string")
    return text.isNotNull() & ~_is_date(text)


def invalid_dates(df: DataFrame, fields: list[str], by: list[str] = ()) -> DataFrame:
    """Per date field: rows whose value is present but no full date, and their share."""
    present = [f for f in fields if f in df.columns]
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.count_if(bad_date(f)).alias(f) for f in present]
    )
    long = counts.unpivot([*by, "n_rows"], present, "field", "n_invalid")
    return long.withColumn("pct", F.round(F.when(F.col("n_rows") > 0, 100.0 * F.col("n_invalid") / F.col("n_rows")), 1))


def quarter_summary(df: DataFrame, kind: str) -> DataFrame:
    """One row per quarter of a table: rows, rows kept, columns it lacks, invalid dates.

    ``df`` may carry ``_malformed`` from the reader; such rows count as not processed.
    """
    lacking = [c for c in S.TABLES[kind] if c not in df.columns]
    dates = [c for c in S.DATE_FIELDS.get(kind, []) if c in df.columns]
    broken = F.count_if("_malformed") if "_malformed" in df.columns else F.lit(0)
    bad_dates = sum((F.count_if(bad_date(c)) for c in dates), F.lit(0))
    return (
        df.groupBy("quarter")
        .agg(
            F.count(F.lit(1)).alias("total_rows"),
            (F.count(F.lit(1)) - broken).alias("processed_rows"),
            bad_dates.cast("long").alias("invalid_dates"),
        )
        .select(F.lit(kind).alias("kind"), "quarter", "total_rows", "processed_rows",
                F.lit("; ".join(lacking)).alias("missing_columns"), "invalid_dates")
    )


def run_summary(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for kind, df in tables.items():
        part = quarter_summary(df, kind)
        out = part if out is None else out.unionByName(part)
    return out


def summary_totals(summary: DataFrame) -> DataFrame:
    """Totals per kind and over everything next to the single quarters."""
    return (
        summary.rollup("kind", "quarter")
        .agg(
            F.sum("total_rows").alias("total_rows"),
            F.sum("processed_rows").alias("processed_rows"),
            F.sum("invalid_dates").alias("invalid_dates"),
            F.grouping("kind").alias("_all_kinds"),
            F.grouping("quarter").alias("_all_quarters"),
        )
        .select(
            F.when(F.col("_all_kinds") == 1, "ALL").otherwise(F.col("kind")).alias("kind"),
            F.when(F.col("_all_quarters") == 1, "ALL").otherwise(F.col("quarter")).alias("quarter"),
            "total_rows", "processed_rows", "invalid_dates",
            F.round(V.success_rate(F.col("processed_rows"), F.col("total_rows")), 1).alias("success_rate"),
        )
    )


def report_lines(summary: DataFrame, seconds: float | None = None) -> DataFrame:
    """The report of a run as (line_no, line), from a summary of one row per kind and quarter.

    The summary is read several times; hand over a staged one.
    """
    kinds = [*S.FILE_KINDS, "drug_info"]
    at = F.array_position(F.array(*[F.lit(k) for k in kinds]), F.col("kind"))
    place = F.when(at > 0, at).otherwise(len(kinds) + 1).cast("int").alias("place")
    total, done, dates = (F.format_number(c, 0) for c in ("total_rows", "processed_rows", "invalid_dates"))
    share = F.format_string("%.1f%%", F.round(V.success_rate(F.col("processed_rows"), F.col("total_rows")), 1))
    name, first = F.upper("kind"), F.lit(0).alias("place")
    known = summary.filter("quarter IS NOT NULL")

    fixed = [F.lit(x) for x in ("# Processing Summary", "", "## Overall")]
    count = F.concat(F.lit("- Quarters: "), F.countDistinct("quarter").cast("string"))
    took = [F.lit(f"- Seconds: {seconds:.2f}")] if seconds is not None else []
    head = [F.lit(x) for x in ("", "| Kind | Rows | Processed | Success rate | Invalid dates |", "|---|---|---|---|---|")]
    title = known.agg(F.array(*fixed, count, *took, *head).alias("lines")).select(F.lit("").alias("quarter"), first, F.lit("").alias("kind"), "lines")
    per_kind = summary.groupBy("kind").agg(*[F.sum(c).alias(c) for c in ("total_rows", "processed_rows", "invalid_dates")]).select(
        F.lit("").alias("quarter"), place, "kind", F.array(F.format_string("| %s | %s | %s | %s | %s |", name, total, done, share, dates)).alias("lines"))
    quarters = known.select("quarter").distinct().select(
        "quarter", first, F.lit("").alias("kind"), F.array(F.lit(""), F.concat(F.lit("## Quarter "), F.col("quarter"))).alias("lines"))
    lacking = F.when(F.col("missing_columns") != "", F.concat(F.lit("- Missing columns: "), F.col("missing_columns")))
    single = known.select("quarter", place, "kind", F.array_compact(F.array(
        F.lit(""), F.concat(F.lit("### "), name), F.concat(F.lit("- Total rows: "), total), F.concat(F.lit("- Processed rows: "), done),
        F.concat(F.lit("- Success rate: "), share), F.concat(F.lit("- Invalid dates: "), dates), lacking)).alias("lines"))

    parts = title.unionByName(per_kind).unionByName(quarters).unionByName(single)
    lines = parts.select("quarter", "place", "kind", F.posexplode("lines").alias("i", "line"))
    # A few lines per kind and quarter, however many rows the run had.
    return lines.select((F.row_number().over(Window.orderBy("quarter", "place", "kind", "i")) - 1).alias("line_no"), "line")


def render_report(summary: DataFrame, seconds: float | None = None) -> str:
    """The report as one Markdown text."""
    return "\n".join(r["line"] for r in report_lines(summary, seconds).orderBy("line_no").collect()) + "\n"


INTEGER_STEPS = [("tinyint", 127), ("smallint", 32767), ("int", 2147483647)]


def narrow_stats(df: DataFrame, max_share: float = 0.5) -> DataFrame:
    """Per integer and text column the narrowest fitting type.

    A text column with few distinct values is called ``category``. Distinct
    values are counted exactly: grouped by column and value with map-side
    combine, then per column.
    """
    ints = [f.name for f in df.schema.fields if f.dataType.typeName() in ("byte", "short", "integer", "long")]
    texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    one = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.struct(F.min(c).cast("long").alias("low"), F.max(c).cast("long").alias("high")).alias(f"i_{c}") for c in ints],
    )
    if texts:
        values = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(c).alias("v")) for i, c in enumerate(texts)])).alias("x"))
        different = values.filter("x.v IS NOT NULL").groupBy("x.i", "x.v").agg(F.count(F.lit(1)).alias("n")).groupBy("i").agg(F.count(F.lit(1)).alias("n"))
        counts = different.agg(F.map_from_entries(F.collect_list(F.struct("i", "n"))).alias("_distinct"))  # one entry per column
        one = one.join(counts).select("*", *[F.coalesce(F.try_element_at("_distinct", F.lit(i)), F.lit(0)).alias(f"t_{c}") for i, c in enumerate(texts)])

    def int_type(c: str) -> Column:
        fits = F.lit("bigint")
        for name, top in reversed(INTEGER_STEPS):
            fits = F.when((F.col(f"i_{c}.low") >= -top - 1) & (F.col(f"i_{c}.high") <= top), name).otherwise(fits)
        return fits

    rows = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"i_{c}.low").alias("low"), F.col(f"i_{c}.high").alias("high"), int_type(c).alias("target"))
        for c in ints
    ] + [
        F.struct(F.lit(c).alias("column_name"), F.lit(None).cast("long").alias("low"), F.lit(None).cast("long").alias("high"),
                 F.when(F.col(f"t_{c}") / F.col("_rows") < max_share, "category").otherwise("string").alias("target"))
        for c in texts
    ]
    return one.select(F.inline(F.array(*rows)))


def narrow_types(df: DataFrame) -> DataFrame:
    """Cast integer columns to the narrowest type that holds them; Parquet dictionary-codes text itself."""
    target = {r["column_name"]: r["target"] for r in narrow_stats(df).collect()}
    return df.select(
        *[F.col(c).cast(target[c]).alias(c) if target.get(c) in ("tinyint", "smallint", "int") else F.col(c) for c in df.columns]
    )
