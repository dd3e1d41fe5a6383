"""Composed jobs: ingest, quarter processing and the cleaned release."""

from __future__ import annotations

import datetime as dt
from dataclasses import replace

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import links, text
from casewright.operators import cases, dedup, projections, quality, split
from casewright.operators import standardize as std
from casewright.operators import vocabulary as voc
from casewright.operators.joins import KeyFilter, frequent_hashes
from casewright.session import Workspace, stage, stage_bucketed
from casewright.sources import dims, files
from casewright.sources.tables import write_csv, write_table


def clean_cases(tables: dict[str, DataFrame], countries: DataFrame, measured: bool = False) -> DataFrame:
    """The cleaned demographics of a release.

    Select the current reports, drop incomplete ones, standardize, add the case
    flags and the duplicate flags. Standardization looks at one row at a time, so
    only selected rows go through it.

    Drugs and reactions, the largest tables, are each read and shuffled once, to
    one row per report that serves completeness, flags and duplicate rules. The
    joined reports feed those rules and the final join, so they are staged.
    """
    reports = (
        dedup.select_reports(tables["demo"])
        .join(dedup.reaction_profile(tables["reac"]).filter("has_event"), "primaryid")
        .join(dedup.drug_profile(tables["drug"]).filter("has_drug"), "primaryid")
        .withColumn("premarketing", F.col("has_trial"))
        .withColumn("literature", F.col("lit_ref").isNotNull())
    )
    reports = stage(std.std_demo(reports, countries, measured), "cases")
    demo = reports.drop("pt", *dedup.ROLE_LISTS, "has_event", "has_drug", "has_trial")
    return std.finalize_demo(dedup.flag_duplicates(demo, dedup.last_of_equals(reports)))


def therapy(demo: DataFrame, ther: DataFrame) -> DataFrame:
    """Unified therapies with their length and the time to onset."""
    unified = projections.project(ther, "ther")
    return cases.time_to_onset(projections.project(demo, "demo"), std.duration_days(unified))


def write_therapy(demo: DataFrame, ther: DataFrame, out: str) -> None:
    write_csv(therapy(demo, ther), f"{out}/ther")
    write_csv(demo, f"{out}/demo")


def drug_details(drug: DataFrame, dims: dict[str, DataFrame], measured: bool = False) -> DataFrame:
    """Unified drug details with route, form, frequency and doses standardized."""
    out = projections.project(drug, "drug_info")
    out = std.std_route(out, dims["route"], measured)
    out = std.std_dose_form(out, dims["dose_form"], measured)
    out = std.std_dose_freq(out, dims["dose_freq"], measured)
    return std.std_dose(out, dims["unit"], measured)


def standardize_terms(tables: dict[str, DataFrame], terms: DataFrame, measured: bool = False) -> dict[str, DataFrame]:
    """Reaction, recurrence and indication terms through the term dictionary."""
    reac = voc.standardize_pt(tables["reac"], "pt", terms, measured)
    return {
        **tables,
        "reac": voc.standardize_pt(reac, "drug_rec_act", terms, measured),
        "indi": voc.standardize_pt(tables["indi"], "indi_pt", terms, measured),
    }


def release(
    tables: dict[str, DataFrame],
    out: str,
    *,
    countries: DataFrame,
    dictionary: DataFrame,
    terms: DataFrame,
    hierarchy: DataFrame,
    synonyms: DataFrame | None = None,
    deleted: DataFrame | None = None,
    details: dict[str, DataFrame] | None = None,
) -> None:
    """Unified tables to the ten tables of a cleaned release under ``out``.

    The reports are selected first, and the other tables' rows are kept only where
    their report may be one of these, before anything is standardized or moved.

    ``details``: the route, dose_form, dose_freq and unit dictionaries; the built-in ones if none are given.
    """
    if details is None:
        details = {name: dims.built_in(countries.sparkSession, name) for name in ("route", "dose_form", "dose_freq", "unit")}
    demo = tables["demo"] if deleted is None else dedup.drop_nullified(tables["demo"], deleted)
    demo = stage(dedup.select_reports(demo), "selected")
    selected = KeyFilter(demo.select("primaryid"), "primaryid", Workspace(demo.sparkSession, "selected_keys"))
    tables = {name: selected(df) if name in split.PART_BY else df for name, df in tables.items()}
    tables = standardize_terms(tables, stage(terms, "terms"))
    ready = {
        **tables, "drug": voc.standardize_drugs(tables["drug"], stage(dictionary, "dictionary"), synonyms), "drug_info": drug_details(tables["drug_info"], details),
        "outc": std.encode_factors(tables["outc"]), "ther": std.duration_days(projections.project(tables["ther"], "ther")),
    }
    dealt, hot = dealt_by_report(ready, tables)
    demo = stage(clean_cases({**dealt, "demo": demo}, countries), "demo")
    reports = stage_bucketed(split.in_all_parts(demo, hot), "reports", ["primaryid", split.PART])
    final = {**dealt, "demo": demo, "ther": cases.time_to_onset(reports, dealt["ther"])}
    for name, df in split.split_tables(final, stage(hierarchy, "hierarchy"), reports).items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")


def dealt_by_report(ready: dict[str, DataFrame], raw: dict[str, DataFrame]) -> tuple[dict[str, DataFrame], list[int]]:
    """The tables in buckets by report, so that all joins on reports find their rows together, and the hashes of hot reports.

    Rows of a report that holds much of a table are spread over parts, which the
    reports join part by part; ``raw`` are the tables before they were
    standardized, from which these reports are found by a sketch.
    """
    hot = frequent_hashes([raw[name] for name in split.PART_BY], ["primaryid"])
    keys = ["primaryid", split.PART]
    return {name: stage_bucketed(split.with_part(ready[name], by, hot), name, keys) for name, by in split.PART_BY.items()}, hot


def process_quarter(tables: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Findings and summary of raw tables whose names are already unified."""
    findings = quality.validation_report({k: v for k, v in tables.items() if k in S.REQUIRED})
    return findings, quality.run_summary(tables)


def read_drop(spark: SparkSession, raw: str, folder: str | None = "ascii") -> dict[str, DataFrame]:
    """Every kind a drop holds, all quarters in one frame, with the malformed-line flag."""
    groups = files.header_groups(spark, files.discover(spark, raw, None, folder))
    held = {g.kind for g in groups}
    return {k: files.read_groups(spark, groups, k, flag_malformed=True) for k in S.FILE_KINDS if k in held}


def write_sound(lines: DataFrame, kind: str, path: str, out: str) -> DataFrame:
    """Write the lines of the right width to ``path`` and the others to ``out/rejected/<kind>``; the former read back.

    The files are read again for the others only if the first pass met any. That
    pass has no shuffle: behind one, a plan that turns out empty is cut short and
    its observed figures never arrive.
    """
    seen = Observation(f"lines_{kind}")
    watched = lines.observe(seen, F.count_if("_malformed").alias("malformed"))
    sound = watched.filter(~F.col("_malformed")).drop("_malformed")
    write_table(sound, path, rebalance=False)
    rejected = lines.filter("_malformed") if seen.get["malformed"] else lines.sparkSession.createDataFrame([], lines.schema)
    write_table(rejected, f"{out}/rejected/{kind}", rebalance=False)
    return lines.sparkSession.read.schema(sound.schema).parquet(path)


def to_bronze(spark: SparkSession, raw: str, out: str, folder: str | None = "ascii") -> DataFrame:
    """Repair and convert a drop to Parquet, one table per kind, next to its file list and its rejected lines."""
    listing = files.manifest(spark, raw, folder)
    write_table(listing.drop("quarter"), f"{out}/manifest")
    for kind, df in read_drop(spark, raw, folder).items():
        write_sound(df, kind, f"{out}/{kind}", out)
    return spark.read.parquet(f"{out}/manifest")


def _counted(found: list, limit: int) -> dict[str, int]:
    """Counts per item of a frequent-item aggregate that had room for all items."""
    if len(found) >= limit:
        raise RuntimeError("more files than a run can count; split the drop")
    return {r["item"]: r["count"] for r in found if r["item"] is not None}


class Run:
    """One pass over the files of a kind: what is written is counted on the way.

    The figures come from metrics that Spark observes while the table is written,
    by file and quarter. Counting is exact: the frequent-item aggregate has room
    for more items than there are files. Nothing is shuffled between the scan and
    the writer, so a task that is run again is counted once.
    """

    def __init__(self, kind: str, n_files: int):
        self.kind, self.seen = kind, Observation(f"run_{kind}")
        self.room = 1000 + 2 * n_files

    def _per(self, item: Column, where: Column | None = None) -> Column:
        return F.call_function("approx_top_k", item if where is None else F.when(where, item), F.lit(self.room // 2), F.lit(self.room))

    def watch(self, df: DataFrame) -> DataFrame:
        self.columns = df.columns
        quarter = F.coalesce("quarter", F.lit(""))
        place = F.concat(quarter, F.lit("\t"), F.col("_file"))
        metrics = [self._per(place).alias("rows"), self._per(place, F.col("_malformed")).alias("malformed")]
        self.dates = [c for c in S.DATE_FIELDS.get(self.kind, []) if c in df.columns]
        metrics += [self._per(quarter, quality.bad_date(c)).alias(f"date_{c}") for c in self.dates]
        self.rules = quality.bad_cells(df, self.kind)
        for i, (_, _, value) in enumerate(self.rules):
            sound = F.when(~F.col("_malformed"), value)
            metrics += [F.count(sound).alias(f"n_{i}"), F.min(sound).alias(f"first_{i}"), F.max(sound).alias(f"last_{i}")]
        return df.observe(self.seen, *metrics)

    def collect(self) -> None:
        self.figures = self.seen.get
        self.rows, self.malformed = (_counted(self.figures[n], self.room // 2) for n in ("rows", "malformed"))
        self.bad_dates = [_counted(self.figures[f"date_{c}"], self.room // 2) for c in self.dates]

    def summary(self) -> list[tuple]:
        """kind, quarter, rows, rows kept, columns missing, invalid dates."""
        lacking = "; ".join(c for c in S.TABLES[self.kind] if c not in self.columns)
        totals: dict[str, list[int]] = {}
        for counts, at in ((self.rows, 0), (self.malformed, 1)):
            for place, n in counts.items():
                totals.setdefault(place.split("\t")[0], [0, 0])[at] += n
        return [
            (self.kind, quarter or None, n, n - broken, lacking, sum(d.get(quarter, 0) for d in self.bad_dates))
            for quarter, (n, broken) in sorted(totals.items())
        ]

    def findings(self) -> list[tuple]:
        """Errors for required columns no file has, warnings for bad values among the rows kept."""
        absent = [c for c in S.REQUIRED.get(self.kind, []) if c not in self.columns]
        out = [(self.kind, "required_column", c, "error", None, None, None) for c in absent]
        for i, (rule, column, _) in enumerate(self.rules):
            if self.figures[f"n_{i}"]:
                out.append((self.kind, rule, column, "warning", self.figures[f"n_{i}"], self.figures[f"first_{i}"], self.figures[f"last_{i}"]))
        return out

    @staticmethod
    def place(quarter: str | None, path: str) -> str:
        return f"{quarter or ''}\t{path.rsplit('/', 1)[-1]}"

    def broken(self, groups: list[files.HeaderGroup]) -> list[files.HeaderGroup]:
        """The groups with only those files that have malformed lines; all files if a line's file is not told by its name."""
        places = {self.place(q, p) for g in groups for p, q in zip(g.paths, g.quarters)}
        if not self.malformed.keys() <= places:
            return groups
        return files.only(groups, lambda path, quarter: self.place(quarter, path) in self.malformed)

    def file_rows(self, probe: files.Probe) -> tuple:
        """kind, path, quarter, rows, malformed rows, error class, detail."""
        place = self.place(probe.quarter, probe.path)
        n, bad = self.rows.get(place, 0), self.malformed.get(place, 0)
        error = probe.error if not probe.usable else "empty_file" if n == 0 else "invalid_format" if bad else probe.error
        return self.kind, probe.path, probe.quarter, n, bad, error, probe.detail


SUMMARY = "kind string, quarter string, total_rows long, processed_rows long, missing_columns string, invalid_dates long"
FINDINGS = "kind string, rule string, column_name string, severity string, n_bad long, first_value string, last_value string"
FILE_ERRORS = "kind string, path string, quarter string, n_rows long, n_malformed long, error_class string, detail string"


def _process_kind(spark: SparkSession, kind: str, probes: list[files.Probe], out: str) -> tuple[Run | None, list[files.Probe]]:
    """Write the tables of a kind and count on the way; a file that cannot be read to its end is left out and the rest read anew."""
    while True:
        groups = files.groups_of(probes)
        if not groups:
            return None, probes
        run = Run(kind, sum(len(g.paths) for g in groups))
        try:
            lines = files.read_groups(spark, groups, kind, flag_malformed=True, source_file=True)
            write_table(projections.project(run.watch(lines).filter(~F.col("_malformed")), kind), f"{out}/{kind}", rebalance=False)
            run.collect()
            rejected = spark.createDataFrame([], lines.drop("_file").schema)
            if run.malformed:  # only the files that hold such lines are looked at again
                again = files.read_groups(spark, run.broken(groups), kind, flag_malformed=True)
                rejected = rejected.unionByName(again.filter("_malformed"), allowMissingColumns=True)
            write_table(rejected, f"{out}/rejected/{kind}", rebalance=False)
            if kind == "drug":
                info = files.read_groups(spark, groups, "drug_info", flag_malformed=True)
                write_table(projections.project(info.filter(~F.col("_malformed")), "drug_info"), f"{out}/drug_info", rebalance=False)
            return run, probes
        except (PySparkException, Py4JJavaError) as error:
            lost = files.unreadable_path(error, groups)
            if lost is None:
                raise
            probes = [replace(p, error="unknown_error", detail=str(error)[:500], usable=False) if p.path == lost else p for p in probes]


def process_all(spark: SparkSession, raw: str, out: str, folder: str | None = "ascii") -> DataFrame:
    """Read all quarters, write the projected tables and return the run summary.

    One scan and one write per table: summary, validation findings and the errors
    of each file are observed while the rows go by, and stand beside the tables
    under ``summary``, ``findings`` and ``file_errors``. Lines of the wrong width
    go to ``rejected``. Files that cannot be used are listed and left out; neither
    a broken file nor a poor quarter stops the others.
    """
    probes = files.probe_files(spark, files.discover(spark, raw, None, folder))
    summary, findings, errors = [], [], []
    for kind in S.FILE_KINDS:
        mine = [p for p in probes if p.kind == kind]
        run, mine = _process_kind(spark, kind, mine, out)
        if run is None:
            errors += [(kind, p.path, p.quarter, 0, 0, p.error, p.detail) for p in mine]
            continue
        summary += run.summary()
        findings += run.findings()
        errors += [run.file_rows(p) for p in mine]
    for rows, schema, name in ((summary, SUMMARY, "summary"), (findings, FINDINGS, "findings"), (errors, FILE_ERRORS, "file_errors")):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("overwrite").parquet(f"{out}/{name}")  # a row per kind and quarter, rule or file
    return spark.read.parquet(f"{out}/summary")


def unify_all(spark: SparkSession, raw: str, out: str, folder: str | None = "ascii") -> dict[str, DataFrame]:
    """A drop to its eight unified tables, equal rows kept once; lines of the wrong width are rejected."""
    groups = files.header_groups(spark, files.discover(spark, raw, None, folder))
    unified, work = {}, Workspace(spark, "sound_lines")
    for kind in S.FILE_KINDS:
        lines = files.read_groups(spark, groups, kind, flag_malformed=True)
        if "_malformed" in lines.columns:  # there are files of the kind
            lines = write_sound(lines, kind, work.path(kind), out)
        # Drug details come from the lines of the drug table.
        for table in [kind, "drug_info"] if kind == "drug" else [kind]:
            df = projections.unify([lines], table)
            write_table(df, f"{out}/{table}")
            # With its schema named, a table no file had rows for reads as empty.
            unified[table] = spark.read.schema(df.schema).parquet(f"{out}/{table}")
    work.clear()
    return unified


def quarter_calendar(spark: SparkSession, last: str | None = None, first: str = "2004Q1") -> DataFrame:
    """All quarters from ``first`` to the one of ``last`` (``YYYYMMDD``; today if not given)."""
    end = dt.datetime.strptime(last, "%Y%m%d").date() if last else dt.date.today()
    start = dt.date(int(first[:4]), int(first[5]) * 3 - 2, 1)
    days = spark.sql(
        "SELECT explode(sequence(CAST(:a AS DATE), CAST(:b AS DATE), INTERVAL 3 MONTH)) AS day",
        {"a": start.isoformat(), "b": end.isoformat()},
    )
    return days.select(F.concat(F.year("day"), F.lit("Q"), F.quarter("day")).alias("quarter"))


def quarters_between(df: DataFrame, column: str) -> DataFrame:
    """Every quarter from the first to the last one a date column reaches, empty ones included."""
    span = df.agg(F.trunc(F.min(column), "quarter").alias("a"), F.trunc(F.max(column), "quarter").alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 3 MONTH"))).alias("day"))
    return days.select(F.concat(F.year("day"), F.lit("Q"), F.quarter("day")).alias("quarter"))


def page_links(pages: DataFrame) -> DataFrame:
    """One row per anchor target of each page."""
    return pages.select("page_id", F.posexplode(links.hrefs(F.col("html"))).alias("position", "href"))


def archive_links(pages: DataFrame, prefixes: list[str] | None = None) -> DataFrame:
    """Quarter and link of every archive the pages offer; the last link of a quarter stands."""
    found = page_links(pages).withColumn("quarter", links.archive_quarter(F.col("href"), prefixes))
    return (
        found.filter(F.col("quarter").isNotNull())
        .groupBy("quarter")
        .agg(F.max_by("href", F.struct("page_id", "position")).alias("href"))
    )


def archive_catalog(pages: DataFrame, old: str = "aers", new: str = "faers", first_year: int = 2004, switch_year: int = 2013) -> DataFrame:
    """The archives of some pages with whether their quarter was published, and the file name their era calls for.

    ``named`` says whether the link ends in that name, in any case.
    """
    found = archive_links(pages)
    prefix = text.era_prefix(F.substring("quarter", 1, 4).cast("int"), old, new, switch_year)
    name = F.concat(prefix, F.lit("_ascii_"), "quarter", F.lit(".zip"))
    return found.select(
        "quarter", "href", text.valid_quarter(F.col("quarter"), first_year).alias("valid"), name.alias("file_name"), F.lower("href").endswith(name).alias("named"))
