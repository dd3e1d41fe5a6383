"""Report completeness, case flags and time to onset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import values as V


def _ids(df: DataFrame, term: str, empty: list[str]) -> DataFrame:
    """Report ids with at least one row that names something; a null term counts as named."""
    named = F.coalesce(~F.col(term).isin(empty), F.lit(True))
    return df.filter(named).select("primaryid").distinct()


def complete_reports(demo: DataFrame, drug: DataFrame, reac: DataFrame) -> DataFrame:
    """Reports with both a drug and a reaction."""
    return demo.join(_ids(drug, "substance", S.EMPTY_SUBSTANCES), "primaryid", "left_semi").join(
        _ids(reac, "pt", S.EMPTY_REACTIONS), "primaryid", "left_semi"
    )


def incomplete_reasons(demo: DataFrame, drug: DataFrame, reac: DataFrame) -> DataFrame:
    """Ids of incomplete reports with what they lack."""
    has_drug = _ids(drug, "substance", S.EMPTY_SUBSTANCES).withColumn("_drug", F.lit(True))
    has_event = _ids(reac, "pt", S.EMPTY_REACTIONS).withColumn("_event", F.lit(True))
    return (
        demo.select("primaryid").distinct()
        .join(has_drug, "primaryid", "left")
        .join(has_event, "primaryid", "left")
        .select("primaryid", F.col("_drug").isNull().alias("no_drug"), F.col("_event").isNull().alias("no_event"))
        .filter("no_drug OR no_event")
    )


def completeness_stats(demo: DataFrame, drug: DataFrame, reac: DataFrame) -> DataFrame:
    reasons = incomplete_reasons(demo, drug, reac).agg(
        F.count_if("no_drug").alias("n_no_drug"),
        F.count_if("no_event").alias("n_no_event"),
        F.count(F.lit(1)).alias("n_incomplete"),
    )
    total = demo.agg(F.countDistinct("primaryid")).scalar()
    return reasons.select(
        total.alias("n_reports"), "n_no_drug", "n_no_event", "n_incomplete",
        (total - F.col("n_incomplete")).alias("n_complete"),
    )


def case_flags(demo: DataFrame, drug: DataFrame) -> DataFrame:
    """Mark reports with a trial drug and reports with a literature reference."""
    trials = drug.filter("trial").select("primaryid").distinct().withColumn("_trial", F.lit(True))
    return (
        demo.join(trials, "primaryid", "left")
        .withColumn("premarketing", F.col("_trial").isNotNull())
        .withColumn("literature", F.col("lit_ref").isNotNull())
        .drop("_trial")
    )


def _until_cutoff(event_dt: Column) -> Column:
    return F.coalesce(event_dt.try_cast("long") <= int(S.ONSET_CUTOFF), F.lit(False))


def time_to_onset(demo: DataFrame, ther: DataFrame) -> DataFrame:
    """Days from therapy start to event, both days counted.

    Only complete dates give a value. Up to 2012 dates were auto-completed, so
    values of zero or less are dropped there; later ones stay. Frames dealt to
    parts of reports (``split.with_part``) join part by part.
    """
    keys = ["primaryid", *(["_part"] if "_part" in demo.columns and "_part" in ther.columns else [])]
    events = demo.filter(F.col("event_dt").isNotNull()).select(*keys, "event_dt")
    days = F.datediff(V.full_date(F.col("event_dt")), V.full_date(F.col("start_dt"))) + 1
    return (
        ther.join(events, keys, "left")
        .withColumn("time_to_onset", days)
        .withColumn(
            "time_to_onset",
            F.when(~((F.col("time_to_onset") <= 0) & _until_cutoff(F.col("event_dt"))), F.col("time_to_onset")),
        )
    )


def onset_stats(df: DataFrame) -> DataFrame:
    """Shares of negative values and of early dates that fall on a first of the month."""
    early = _until_cutoff(F.col("event_dt"))
    negative = F.coalesce(F.col("time_to_onset") < 0, F.lit(False))
    n, n_valid, n_early = F.count(F.lit(1)), F.count("time_to_onset"), F.count_if(early)
    return df.agg(
        n.alias("n_rows"),
        n_valid.alias("n_valid"),
        F.round(F.when(n_valid > 0, 100.0 * F.count_if(negative) / n_valid), 1).alias("pct_negative"),
        F.round(F.when(n_early > 0, 100.0 * F.count_if(early & negative) / n_early), 1).alias("pct_early_negative"),
        F.round(100.0 * F.count_if(early & F.coalesce(F.col("event_dt").endswith("01"), F.lit(False))) / n, 1).alias("pct_early_first"),
    )
