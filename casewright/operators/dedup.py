"""Latest-version selection and rule-based duplicate flags.

Row order carries no meaning in Spark, so every "last" is spelled out as a total
order. A missing date sorts last and therefore wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.operators.numbering import RANGE_ROWS, running


def _number(name: str) -> Column:
    return F.col(name).try_cast("long")


def _first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key. The rank filter lets each map task pass on one row per
    key only, so an over-full key never reaches a single task whole."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_quarter(df: DataFrame, key: str = "primaryid", ties: str = "one") -> DataFrame:
    """Rows of the newest quarter per report id; null ids are dropped.

    ``ties='one'`` keeps one row per id, ``'all'`` every row of that quarter.
    """
    known = df.filter(F.col(key).isNotNull())
    if ties == "all":
        newest = known.groupBy(key).agg(F.max("quarter").alias("quarter"))
        return known.join(newest, [key, "quarter"], "left_semi")
    named = [c for c in ("fda_dt", "caseversion") if c in df.columns]
    order = [F.col("quarter").desc_nulls_last()]
    order += [_number(c).desc_nulls_first() if c == "fda_dt" else _number(c).desc_nulls_last() for c in named]
    return _first(known, [key], order + _rest(df, [key, "quarter"]))


def _rest(df: DataFrame, used: list[str]) -> list[Column]:
    """All other columns, so that equal dates and ids still give the same row on every run.

    Plain columns, not values derived from them: they ride along through the shuffle anyway.
    """
    return [F.col(c).desc_nulls_last() for c in df.columns if c not in used]


def latest_per_case(df: DataFrame) -> DataFrame:
    """Last version of each case; null case ids are dropped."""
    order = [_number("fda_dt").desc_nulls_first()]
    if "caseversion" in df.columns:
        order.append(_number("caseversion").desc_nulls_last())
    order += [F.col("quarter").desc_nulls_last(), _number("primaryid").desc_nulls_last()]
    return _first(df.filter(F.col("caseid").isNotNull()), ["caseid"], order + _rest(df, ["caseid", "quarter"]))


def latest_per_manufacturer(df: DataFrame) -> DataFrame:
    """Last report per manufacturer number and sender; reports lacking either are all kept.

    Reports without the key skip the shuffle, or they would pile up in one task.
    """
    keyed = F.col("mfr_num").isNotNull() & F.col("mfr_sndr").isNotNull()
    order = [_number("fda_dt").desc_nulls_first(), F.col("quarter").desc_nulls_last(), _number("primaryid").desc_nulls_last()]
    last = _first(df.filter(keyed), ["mfr_num", "mfr_sndr"], order + _rest(df, ["mfr_num", "mfr_sndr", "quarter"]))
    return last.unionByName(df.filter(~keyed))


SELECTION_KEYS = ["primaryid", "caseid", "caseversion", "fda_dt", "quarter", "mfr_num", "mfr_sndr"]


def select_reports(demo: DataFrame) -> DataFrame:
    """Newest quarter per report, then last version per case, then per manufacturer number.

    The three selections do not commute, so their order is fixed. After the first
    one the report id is unique, so the other two move only the key columns, and
    their surviving ids pick the full rows where the first one left them: whole
    rows are shuffled once, and stay partitioned by report for the joins to come.
    """
    newest = latest_quarter(demo)
    last = latest_per_manufacturer(latest_per_case(newest.select(*SELECTION_KEYS)))
    return newest.join(last.select("primaryid"), "primaryid", "left_semi")


def drop_nullified(df: DataFrame, deleted: DataFrame) -> DataFrame:
    """Reports whose case is not on the list of deleted cases."""
    return df.join(deleted.select("caseid").distinct(), "caseid", "left_anti")


def term_counts(df: DataFrame, term: str, key: str = "primaryid") -> DataFrame:
    """One row per report: its sorted terms, each with how often it occurs.

    Repeats are counted before terms are gathered, so a report's list holds at
    most one entry per vocabulary term however many rows it has.
    """
    counted = df.groupBy(key, term).agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy(key).agg(
        F.sort_array(F.collect_list(F.when(F.col(term).isNotNull(), F.struct(F.col(term).alias("term"), "n")))).alias(term)
    )


ROLE_LISTS = {"ps": ["PS"], "ss": ["SS"], "ic": ["I", "C"], "suspected": ["PS", "SS"]}


def drug_profile(drug: DataFrame, key: str = "primaryid") -> DataFrame:
    """One row per report from one pass over the drugs.

    The counted substance list of each role set (null when empty), whether any
    drug is named, and whether any is a trial drug.
    """
    named = F.coalesce(~F.col("substance").isin(S.EMPTY_SUBSTANCES), F.lit(True))
    trial = F.col("trial") if "trial" in drug.columns else F.lit(False)
    per_term = drug.groupBy(key, "substance").agg(
        *[F.count_if(F.col("role_cod").isin(codes)).alias(name) for name, codes in ROLE_LISTS.items()],
        F.bool_or(trial).alias("trial"),
    )

    def counted(name: str) -> Column:
        entry = F.struct(F.col("substance").alias("term"), F.col(name).alias("n"))
        return F.sort_array(F.collect_list(F.when(F.col("substance").isNotNull() & (F.col(name) > 0), entry))).alias(name)

    lists = per_term.groupBy(key).agg(
        *[counted(name) for name in ROLE_LISTS],
        F.bool_or(named).alias("has_drug"),
        F.coalesce(F.bool_or("trial"), F.lit(False)).alias("has_trial"),
    )
    return lists.select(key, *[F.when(F.size(n) > 0, F.col(n)).alias(n) for n in ROLE_LISTS], "has_drug", "has_trial")


def reaction_profile(reac: DataFrame, key: str = "primaryid") -> DataFrame:
    """One row per report: its counted reactions and whether any is named."""
    named = F.coalesce(~F.col("pt").isin(S.EMPTY_REACTIONS), F.lit(True))
    counted = reac.groupBy(key, "pt").agg(F.count(F.lit(1)).alias("n"))
    entry = F.when(F.col("pt").isNotNull(), F.struct(F.col("pt").alias("term"), "n"))
    return counted.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("pt"), F.bool_or(named).alias("has_event"))


def joined_terms(counted: Column, sep: str = "; ") -> Column:
    """Counted terms written out with their repeats."""
    repeated = F.transform(counted, lambda x: F.array_repeat(x["term"], x["n"].cast("int")))
    return F.array_join(F.flatten(repeated), sep)


def sorted_term_list(df: DataFrame, term: str, key: str = "primaryid") -> DataFrame:
    return term_counts(df, term, key).withColumn(term, joined_terms(F.col(term)))


def role_lists(drug: DataFrame, key: str = "primaryid") -> DataFrame:
    return drug_profile(drug, key).select(key, *[joined_terms(F.col(n)).alias(n) for n in ROLE_LISTS])


CHUNK_BYTES = 1 << 20


def term_chunks(
    df: DataFrame, term: str, key: str = "primaryid", max_bytes: int = CHUNK_BYTES, sep: str = "; ", range_rows: int = RANGE_ROWS
) -> DataFrame:
    """``key, chunk, text``: a report's sorted terms with their repeats, in chunks that joined by ``sep`` give the whole list.

    A chunk holds the occurrences that begin within its ``max_bytes`` of the
    list, so no row is longer than that and one term, however many rows a
    report has. Terms are counted first, and where each begins in its report's
    list is summed over ranges of reports and terms: a report with a third of
    all rows is spread over tasks like any other. Chunks are numbered by place;
    one that lies inside a longer term has no row. A report without terms has an
    empty chunk.
    """
    counted = df.groupBy(key, term).agg(F.count(F.lit(1)).alias("n")).filter(F.col(term).isNotNull())
    sized = counted.withColumn("_size", (F.octet_length(term) + len(sep.encode())).cast("long"))
    begun = running(sized, [key, term], F.col("_size") * F.col("n"), "_start", key, range_rows)
    size, start, limit = F.col("_size"), F.col("_start"), F.lit(max_bytes).cast("long")
    chunks = F.sequence(F.floor(start / limit), F.floor((start + (F.col("n") - 1) * size) / limit))
    placed = begun.withColumn("chunk", F.explode(chunks))
    # Occurrence j begins at start + j * size.
    first = F.greatest(F.ceil((F.col("chunk") * limit - start) / size), F.lit(0))
    end = F.least(F.ceil(((F.col("chunk") + 1) * limit - start) / size), F.col("n"))
    pieces = placed.withColumn("_times", (end - first).cast("int")).filter("_times > 0")
    lists = pieces.groupBy(key, "chunk").agg(F.sort_array(F.collect_list(F.struct("_start", F.col(term).alias("term"), F.col("_times").alias("n")))).alias("l"))
    empty = df.groupBy(key).agg(F.count(term).alias("n")).filter("n = 0").select(key, F.lit(0).cast("long").alias("chunk"), F.lit("").alias("text"))
    return lists.select(key, "chunk", joined_terms(F.col("l"), sep).alias("text")).unionByName(empty)


REPORT_FIELDS = ["event_dt", "sex", "reporter_country", "age_in_days", "wt_in_kgs"]


def last_of_equals(reports: DataFrame) -> DataFrame:
    """Ids that stay unflagged, with the rules (``_all``, ``_susp``) they pass.

    ``reports`` holds the report fields and the counted lists. Each report
    contributes one key per rule, and a group is reduced to its last report by a
    plain maximum, which combines before the shuffle.
    """
    age = F.struct(
        F.col("fda_dt").isNull().alias("open"), _number("fda_dt").alias("day"), _number("primaryid").alias("id"), "primaryid"
    )
    keyed = reports.select(
        *REPORT_FIELDS,
        age.alias("age"),
        F.explode(
            F.array(
                F.struct(F.lit("all").alias("rule"), F.array("pt", "ps", "ss", "ic").alias("lists")),
                F.struct(F.lit("susp").alias("rule"), F.array("pt", "suspected").alias("lists")),
            )
        ).alias("k"),
    )
    # The hash only leads the sort, so that comparing whole lists is rare; groups are still formed by value.
    lead = F.xxhash64("k.lists", *REPORT_FIELDS).alias("lead")
    return (
        keyed.groupBy(lead, *REPORT_FIELDS, "k.rule", "k.lists")
        .agg(F.max("age").alias("last"))
        .groupBy("last.primaryid")
        .agg(F.bool_or(F.col("rule") == "all").alias("_all"), F.bool_or(F.col("rule") == "susp").alias("_susp"))
    )


def flag_duplicates(demo: DataFrame, kept: DataFrame) -> DataFrame:
    return (
        demo.join(kept, "primaryid", "left")
        .withColumn("rb_duplicates", ~F.coalesce("_all", F.lit(False)))
        .withColumn("rb_duplicates_only_susp", ~F.coalesce("_susp", F.lit(False)))
        .drop("_all", "_susp")
    )


def rule_based_duplicates(demo: DataFrame, reac: DataFrame, drug: DataFrame) -> DataFrame:
    """Flag reports that repeat another one.

    ``rb_duplicates`` compares the report fields, reactions and the drug lists of
    all roles; ``rb_duplicates_only_susp`` the reactions and suspected drugs. Of
    equal reports the last one stays unflagged, as does a report without equals.
    Reports without reactions are flagged. Missing fields compare as equal.
    """
    reports = (
        demo.select("primaryid", "fda_dt", *REPORT_FIELDS)
        .join(reaction_profile(reac), "primaryid")
        .join(drug_profile(drug), "primaryid", "left")
    )
    return flag_duplicates(demo, last_of_equals(reports))


def dup_stats(df: DataFrame) -> DataFrame:
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("n_reports"),
        F.count_if("rb_duplicates").alias("n_dup"),
        F.count_if("rb_duplicates_only_susp").alias("n_dup_susp"),
        F.round(100.0 * F.count_if("rb_duplicates") / total, 1).alias("pct_dup"),
        F.round(100.0 * F.count_if("rb_duplicates_only_susp") / total, 1).alias("pct_dup_susp"),
    )


def dedup_dataset(spark, source: str, target: str, key: str = "primaryid") -> None:
    """Read a Parquet table, keep the newest quarter per id, write it."""
    latest_quarter(spark.read.parquet(source), key).write.mode("overwrite").parquet(target)
