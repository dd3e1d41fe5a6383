"""Every operator as a query over the adapter views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.functions import text as X
from casewright.functions import values as V
from casewright.operators import cases, coding, dedup, linkage, projections, quality, similarity, split
from casewright.operators import standardize as std
from casewright.operators import vocabulary as voc
from casewright.plans import adapter, release
from casewright.session import exists, fresh_path, stage, tune
from casewright.sources import dims, files, lines
from casewright.sources.tables import write_table
from casewright.streaming import ingest


class Source:
    """Adapter views and dictionaries of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir

    def __call__(self, *names: str):
        found = [adapter.view(self.spark, self.sf_dir, n) for n in names]
        return found[0] if len(found) == 1 else found

    def table(self, name: str) -> DataFrame:
        return adapter.table(self.spark, self.sf_dir, name)

    def dim(self, name: str) -> DataFrame:
        return dims.built_in(self.spark, name)

    def terms(self) -> DataFrame:
        return voc.term_dictionary(*self("pt_terms", "llt_terms"), self.dim("pt_fix"))

    def release_demo(self) -> DataFrame:
        demo, drug = self("demo", "drug")
        newest = std.std_demo(dedup.latest_per_case(demo), self.dim("country"), True)
        return cases.case_flags(newest, drug)

    def tree(self) -> DataFrame:
        return voc.with_term_rank(self("term_tree").distinct(), ["soc", "hlt", "pt"])

    def layouts(self, kind: str, table: str | None = None, **options) -> DataFrame:
        """Both layouts of a kind, each projected to the unified columns."""
        old, new = (projections.project(df, table or kind, **options) for df in self(f"{kind}_old", f"{kind}_new"))
        return old.unionByName(new)


#: Where a job's output lies, by application, data folder and job: queries that read different tables of it share one run.
_RUNS: dict[tuple[str, str, str], str] = {}


def _once(s: Source, job: Callable[[Source], str]) -> str:
    """The folder a job wrote for this data folder; it runs if it has not, or if its folder is gone."""
    key = s.spark.sparkContext.applicationId, s.sf_dir, job.__name__
    if key not in _RUNS or not exists(s.spark, f"{_RUNS[key]}/done/_SUCCESS"):
        _RUNS[key] = job(s)
    return _RUNS[key]


QUERIES: dict[str, Callable[[Source], DataFrame]] = {}


def query(fn: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and text -------------------------------------------------------

def _write_drop(s: Source, path: str) -> None:
    """The drug table as two delimited drops of different layout."""
    for name, where in (("drug_old", "rep_1998q4/ascii/DRUG98Q4.TXT"), ("drug_new", "rep_2004q1/ASCII/drug04q1.txt")):
        s(name).drop("quarter").write.option("sep", "$").option("header", True).option("quote", "").option(
            "emptyValue", "").option("encoding", files.LATIN1).csv(f"{path}/{where}")


@query
def ingest_rows(s):
    path = fresh_path(s.spark, "drop")
    _write_drop(s, path)
    out = files.read_quarter_files(s.spark, path, "drug")
    return out.select("primaryid", "drug_seq", "role_cod", "drugname", "prod_ai", "lot_num", "lot_nbr", "route", "quarter")


@query
def process_all(s):
    path, out = fresh_path(s.spark, "drop"), fresh_path(s.spark, "unified")
    _write_drop(s, path)
    return quality.summary_totals(release.process_all(s.spark, path, out))


@query
def bronze_rows(s):
    path, out = fresh_path(s.spark, "drop"), fresh_path(s.spark, "bronze")
    _write_drop(s, path)
    release.to_bronze(s.spark, path, out)
    return s.spark.read.parquet(f"{out}/drug").groupBy("quarter").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def file_manifest(s):
    path = fresh_path(s.spark, "drop")
    _write_drop(s, path)
    return files.manifest(s.spark, path).select("file_name", "kind", "quarter").distinct()


def _write_broken(s: Source, path: str) -> None:
    """Files that go wrong in different ways, each with as many lines as the newer layout has."""
    new = s("drug_new")
    three = F.concat_ws("$", "primaryid", "drug_seq", "role_cod")
    for rows, where, encoding in (
        (new.select(three.alias("primaryid$drug_seq$role_cod$drugname")), "rep_2004q2/ascii/DRUG04Q2.TXT", "UTF-8"),  # a field short
        (new.select(three.alias("primaryid$drug_seq$role_cod$drugname")).limit(0), "rep_2004q3/ascii/DRUG04Q3.TXT", "UTF-8"),
        (new.select(three.alias("primaryid$drug_seq$role_cod")), "rep_2004q4/ascii/DRUG04Q4.TXT", "UTF-8"),  # no column for the name
        (new.select(F.col("primaryid").alias("invalid")), "rep_2005q1/ascii/DRUG05Q1.TXT", "UTF-8"),  # no report id
        (new.select(three.alias("primaryid$drug_seq$role_cod")), "rep_2005q2/ascii/DRUG05Q2.TXT", "UTF-16BE"),
    ):
        rows.write.option("header", True).option("quote", "").option("sep", "\u0001").option("encoding", encoding).csv(f"{path}/{where}")


@query
def file_errors(s):
    """Error class per file; next to the sound files of the drop, some that are broken in different ways."""
    path = fresh_path(s.spark, "drop")
    _write_drop(s, path)
    _write_broken(s, path)
    found = files.discover(s.spark, path, "drug")
    probes = files.probe_files(s.spark, found)
    rows = files.read_groups(s.spark, files.groups_of(probes), "drug", flag_malformed=True, source_file=True)
    return files.file_errors(rows, found, probes)


def _process(s: Source) -> str:
    path, out = fresh_path(s.spark, "drop"), fresh_path(s.spark, "unified")
    _write_drop(s, path)
    _write_broken(s, path)
    release.process_all(s.spark, path, out)
    write_table(s.spark.range(1).toDF("done"), f"{out}/done")
    return out


def _processed(s: Source, name: str) -> DataFrame:
    """What a run over a drop with broken files leaves beside its tables."""
    return s.spark.read.parquet(f"{_once(s, _process)}/{name}")


@query
def process_file_errors(s):
    name = F.substring_index("path", "/", -1).alias("file_name")
    return _processed(s, "file_errors").select(name, "kind", "quarter", "n_rows", "n_malformed", "error_class")


@query
def process_findings(s):
    return _processed(s, "findings")


@query
def process_rejected(s):
    """Lines that a run sets aside, by quarter."""
    return _processed(s, "rejected/drug").groupBy("quarter").agg(F.count(F.lit(1)).alias("n_lines"), F.count("drugname").alias("n_names"))


@query
def unify_files(s):
    path, out = fresh_path(s.spark, "drop"), fresh_path(s.spark, "unified")
    _write_drop(s, path)
    return release.unify_all(s.spark, path, out)["drug"]


@query
def parquet_sink(s):
    path = fresh_path(s.spark, "reac")
    write_table(s("reac").select("primaryid", "pt", "quarter"), path)
    return s.spark.read.parquet(path)


@query
def detect_delimiter(s):
    return lines.detect_delimiter(s("raw_lines"))


@query
def clean_line(s):
    raw = s("raw_lines")
    return raw.select("file_name", X.clean_line(F.col("value")).alias("value"))


@query
def split_merged(s):
    rules = [(r"DRUG\d\dQ", "$$$$$$", "7475791"), (r"DRUG\d\dQ", "021487$", "7941354")]
    return lines.split_merged_records(s("raw_lines"), rules)


@query
def quarter_label(s):
    return s("raw_lines").groupBy(X.quarter_label(F.col("file_name")).alias("quarter")).agg(F.count(F.lit(1)).alias("n"))


@query
def clean_cells(s):
    return std.clean_cells(s.table("documents").select("doc_id", "text", "lang", "source"))


@query
def na_tokens(s):
    demo = s("demo").select("primaryid", "sex", "age_cod", "occr_country")
    return std.drop_na_tokens(demo, ["", "NA", "NULL", "UNK"])


@query
def narrow_stats(s):
    return quality.narrow_stats(s.table("lineitem"))


@query
def narrow_types(s):
    return quality.narrow_types(s.table("lineitem").select("l_orderkey", "l_linenumber", "l_returnflag"))


def _coded(s: Source) -> tuple[DataFrame, DataFrame]:
    ids = [F.col(c).cast("long").alias(c) for c in ("primaryid", "drug_seq")]
    return coding.encode_categories(s("drug").select(*ids, "role_cod", "substance", "route", "prod_ai"))


@query
def category_codes(s):
    """The code table of all category columns."""
    return _coded(s)[1]


@query
def encode_categories(s):
    return _coded(s)[0]


@query
def decode_categories(s):
    """Codes and back again."""
    coded, codes = _coded(s)
    return coding.decode(coded, codes, ["role_cod", "substance", "route", "prod_ai"])


@query
def page_links(s):
    return release.page_links(s.table("pages"))


@query
def archive_links(s):
    return release.archive_links(s("archive_pages"))


@query
def archive_catalog(s):
    """Archives with the rules that tell which may be fetched, and under which name; the years are those of the test pages."""
    return release.archive_catalog(s("archive_pages"), first_year=1993, switch_year=1996)


@query
def quarter_calendar(s):
    span = release.quarters_between(s.table("orders"), "o_orderdate")
    rows = s("demo").groupBy("quarter").agg(F.count(F.lit(1)).alias("n"))
    return span.join(rows, "quarter", "left").select("quarter", F.coalesce("n", F.lit(0)).alias("n_reports"))


@query
def stream_ingest(s):
    """All reports in two deliveries, each with rows of every quarter."""
    base = fresh_path(s.spark, "stream")
    demo = s("demo").select("primaryid", "caseid", "caseversion", "fda_dt", "sex", "i_f_cod", "quarter")
    initial = F.coalesce(F.col("i_f_cod") == "I", F.lit(False))
    for rows in (demo.filter(initial), demo.filter(~initial)):
        rows.write.mode("append").parquet(f"{base}/landing")
        ingest.ingest_stream(s.spark, f"{base}/landing", demo.schema, f"{base}/table", f"{base}/state", buckets=1).awaitTermination()
    return ingest.current_reports(s.spark, f"{base}/table", "caseid", buckets=1).select("caseid", "quarter", "primaryid")


# --- column unification -----------------------------------------------------

@query
def rename_columns(s):
    old, new = (projections.rename_columns(df, S.ERA_NAMES["drug"]) for df in s("drug_old", "drug_new"))
    return old.unionByName(new, allowMissingColumns=True)


@query
def demo_columns(s):
    return projections.project(s("demo_old"), "demo")


@query
def drug_columns(s):
    return s.layouts("drug")


@query
def drug_info_columns(s):
    return s.layouts("drug", "drug_info")


@query
def reac_columns(s):
    return s.layouts("reac")


@query
def indi_columns(s):
    return s.layouts("indi")


@query
def outc_columns(s):
    return s.layouts("outc", fill_empty=True)


@query
def ther_columns(s):
    return s.layouts("ther")


@query
def rpsr_columns(s):
    return s.layouts("rpsr")


@query
def unify_columns(s):
    old, new = s("drug_old", "drug_new")
    both = projections.project(old, "drug").unionByName(projections.project(new, "drug"))
    return both.groupBy("quarter", "role_cod", "prod_ai").agg(F.count("drugname").alias("n_named"))


@query
def unify_union(s):
    return projections.unify_data(s("rpsr_old", "rpsr_new"), S.ERA_NAMES["rpsr"], ["primaryid", "rpsr_cod"])


@query
def unify_coalesce(s):
    return projections.unify_data(
        s("drug_old", "drug_new"), {"ISR": "primaryid"}, ["primaryid", "drug_seq", "lot_num"], [("lot_num", "lot_nbr")]
    )


@query
def unify_distinct(s):
    return projections.unify_data(s("drug_old", "drug_new"), {"ISR": "primaryid"}, ["role_cod", "drugname", "prod_ai"])


@query
def unify_drug(s):
    return projections.unify(s("drug_old", "drug_new"), "drug")


@query
def unify_drug_info(s):
    return projections.unify(s("drug_old", "drug_new"), "drug_info")


@query
def unify_indi(s):
    return projections.unify(s("indi_old", "indi_new"), "indi")


@query
def unify_outc(s):
    return projections.unify(s("outc_old", "outc_new"), "outc")


@query
def unify_reac(s):
    return projections.unify(s("reac_old", "reac_new"), "reac")


@query
def unify_rpsr(s):
    return projections.unify(s("rpsr_old", "rpsr_new"), "rpsr")


@query
def unify_ther(s):
    return projections.unify(s("ther_old", "ther_new"), "ther")


# --- scalar standardization -------------------------------------------------

@query
def std_sex(s):
    return std.std_sex(s("demo")).select("primaryid", "sex")


@query
def std_age(s):
    return std.std_age(s("demo")).select("primaryid", "age_in_days", "age_in_years")


@query
def std_age_group(s):
    return std.std_age_group(std.std_age(s("demo"))).select("primaryid", "age_grp")


@query
def std_weight(s):
    return std.std_weight(s("demo")).select("primaryid", "wt_in_kgs")


@query
def std_occupation(s):
    return std.std_occupation(s("demo")).select("primaryid", "occp_cod")


@query
def std_outcome(s):
    out = std.std_outcome(s("outc"))
    return out.select("primaryid", "outc_cod", V.outcome_name(F.col("outc_cod")).alias("outcome"))


@query
def clean_drugname(s):
    return s("drug").select("primaryid", "drug_seq", X.clean_drugname(F.col("drugname")).alias("drugname"))


@query
def clean_term_text(s):
    return s.table("documents").select("doc_id", X.clean_drugname(F.col("text")).alias("text"))


@query
def parse_dates(s):
    day = V.parse_date(F.col("raw"))
    return s.spark.sql(adapter.MIXED_DATES, orders=s.table("orders")).select("o_orderkey", F.date_format(day, "yyyy-MM-dd").alias("day"))


@query
def std_numeric(s):
    info = s("drug_info")
    return info.select("primaryid", "drug_seq", V.std_numeric(F.col("dose_amt"), F.trim("dose_unit")).alias("dose"),
                       V.std_numeric(F.col("cum_dose_chr"), F.trim("cum_dose_unit")).alias("cum_dose"))


@query
def role_rank(s):
    return std.encode_factors(s("drug").select("primaryid", "drug_seq", "role_cod"))


@query
def outcome_rank(s):
    return std.encode_factors(s("outc").select("primaryid", "outc_cod"))


@query
def duration_days(s):
    return std.duration_days(s("ther")).select("primaryid", "drug_seq", "dur_in_days")


@query
def finalize_demo(s):
    return std.finalize_demo(s("demo").select("primaryid", "sex", "quarter", "i_f_cod", "occp_cod", "e_sub"))


# --- vocabularies -----------------------------------------------------------

@query
def std_country(s):
    return std.std_country(s("demo"), s.dim("country"), True).select("primaryid", "occr_country", "reporter_country")


@query
def std_route(s):
    return std.std_route(s("drug_info"), s.dim("route"), True).select("primaryid", "drug_seq", "route")


@query
def std_dose_form(s):
    return std.std_dose_form(s("drug_info"), s.dim("dose_form"), True).select("primaryid", "drug_seq", "dose_form")


@query
def std_dose_freq(s):
    return std.std_dose_freq(s("drug_info"), s.dim("dose_freq"), True).select("primaryid", "drug_seq", "dose_freq")


@query
def std_dose(s):
    return std.std_dose(s("drug_info"), s.dim("unit"), True).select(
        "primaryid", "drug_seq", "dose_amt", "dose_unit", "cum_dose_chr", "cum_dose_unit")


@query
def drug_info_clean(s):
    loaded = {n: s.dim(n) for n in ("route", "dose_form", "dose_freq", "unit")}
    return release.drug_details(s("drug_info"), loaded, True)


@query
def drug_dictionary(s):
    return voc.drug_dictionary(s("drug_dictionary"))


@query
def std_drugs(s):
    drug, names = s("drug", "drug_dictionary")
    return voc.standardize_drugs(drug.drop("trial"), voc.drug_dictionary(names)).select(
        "primaryid", "drug_seq", "drugname", "substance", "trial")


@query
def explode_substances(s):
    return voc.explode_substances(s("drug").select("primaryid", "drug_seq", F.col("substance_raw").alias("substance")))


@query
def trial_flag(s):
    return voc.trial_flag(s("drug").select("primaryid", "drug_seq", F.col("substance_raw").alias("substance")))


@query
def drug_synonyms(s):
    raw = s.spark.sql(adapter.SYNONYMS, part=s.table("part"))
    return voc.drug_synonyms(raw)


@query
def std_drugs_synonyms(s):
    raw = s.spark.sql(adapter.SYNONYMS, part=s.table("part"))
    drug, names = s("drug", "drug_dictionary")
    return voc.standardize_drugs(drug.drop("trial"), voc.drug_dictionary(names), voc.drug_synonyms(raw)).select("primaryid", "drug_seq", "substance", "trial")


@query
def drug_stats(s):
    drug, names = s("drug", "drug_dictionary")
    return voc.drug_stats(voc.standardize_drugs(drug.drop("trial"), voc.drug_dictionary(names)))


@query
def llt_pt_join(s):
    return voc.llt_to_pt(*s("llt", "pt"))


@query
def std_pt(s):
    return voc.standardize_pt(s("reac"), "pt_raw", s.terms()).select("primaryid", "pt", "pt_raw")


@query
def std_indications(s):
    terms = s.terms()
    raw = s("reac").select("primaryid", F.col("pt_raw").alias("pt"), F.col("pt_raw").alias("drug_rec_act"))
    out = release.standardize_terms({"reac": raw, "indi": raw.select("primaryid", F.col("pt").alias("indi_pt"))}, terms)
    return out["indi"].groupBy("indi_pt").agg(F.count(F.lit(1)).alias("n"))


@query
def pt_frequency(s):
    return voc.pt_frequency(s("reac"), "pt_raw", s("pt_terms"), s.terms())


@query
def pt_coverage(s):
    return voc.pt_coverage(voc.pt_frequency(s("reac"), "pt_raw", s("pt_terms"), s.terms()))


@query
def pt_worklist(s):
    return voc.pt_worklist(s("reac"), "pt_raw", s.terms(), s.dim("pt_fix"))


@query
def meddra_flat(s):
    region, nation, supplier = s.table("region"), s.table("nation"), s.table("supplier")
    levels = [
        (region.select(F.col("r_regionkey").alias("code"), F.col("r_name").alias("name")),
         nation.select(F.col("n_regionkey").alias("code"), F.col("n_nationkey").alias("child_code"))),
        (nation.select(F.col("n_nationkey").alias("code"), F.col("n_name").alias("name")),
         supplier.select(F.col("s_nationkey").alias("code"), F.col("s_suppkey").alias("child_code"))),
        (supplier.select(F.col("s_suppkey").alias("code"), F.col("s_name").alias("name")), None),
    ]
    return voc.flat_hierarchy(levels, ["soc", "hlt", "pt"])


# --- dictionaries from files ------------------------------------------------

def _write_dictionary(df: DataFrame, path: str, sep: str, quote: str = '"') -> str:
    """A dictionary as one delimited file in the order of ``line_no``: later entries stand for earlier ones."""
    lines = df.repartition(1).sortWithinPartitions("line_no").drop("line_no")
    lines.write.option("sep", sep).option("header", True).option("quote", quote).option("emptyValue", "").csv(path)
    return path


@query
def drug_list_file(s):
    """Drugs through a dictionary file whose header is written in another case."""
    raw = s("drug_dictionary").select("line_no", F.col("drugname").alias("DrugName"), F.col("substance").alias("Substance"))
    path = _write_dictionary(raw, fresh_path(s.spark, "drug_list"), ";")
    names = voc.drug_dictionary(dims.load_drug_list(s.spark, path))
    return voc.standardize_drugs(s("drug").drop("trial"), names).select("primaryid", "drug_seq", "drugname", "substance", "trial")


@query
def synonyms_file(s):
    raw = s.spark.sql(adapter.SYNONYMS, part=s.table("part"))
    return voc.drug_synonyms(dims.load_synonyms(s.spark, _write_dictionary(raw, fresh_path(s.spark, "synonyms"), ",")))


def _term_file(s: Source, df: DataFrame, columns: list[str], path: str) -> None:
    have = set(df.columns)
    filled = df.select("line_no", *[F.col(c) if c in have else F.lit(None).cast("string").alias(c) for c in columns])
    _write_dictionary(filled, path, "$", "")


@query
def term_files(s):
    """Low-level terms to preferred ones, both read from term files."""
    folder = fresh_path(s.spark, "terms")
    _term_file(s, s("llt"), dims.LLT_COLUMNS, f"{folder}/llt.asc")
    _term_file(s, s("pt").withColumn("line_no", F.col("pt_code").cast("long")), dims.PT_COLUMNS, f"{folder}/pt.asc")
    return voc.llt_to_pt(*dims.load_terms(s.spark, folder))


@query
def hierarchy_files(s):
    """A term tree of four levels and the links between them, read from seven files."""
    folder, region, nation, supplier, customer = fresh_path(s.spark, "tree"), *(s.table(t) for t in ("region", "nation", "supplier", "customer"))
    levels = {
        "soc": (region, "r_regionkey", "r_name"), "hlgt": (nation, "n_nationkey", "n_name"),
        "hlt": (supplier, "s_suppkey", "s_name"), "pt": (customer, "c_custkey", "c_name"),
    }
    links = {
        "soc_hlgt": (nation, F.col("n_regionkey"), "n_nationkey"), "hlgt_hlt": (supplier, F.col("s_nationkey"), "s_suppkey"),
        "hlt_pt": (customer, F.col("c_custkey") % 10, "c_custkey"),
    }
    for name, (df, code, text) in levels.items():
        _write_dictionary(df.select(F.col(code).alias("line_no"), F.col(code).alias(f"{name}_code"), F.col(text).alias(f"{name}_name")), f"{folder}/{name}.asc", "$", "")
    for name, (df, code, child) in links.items():
        up, down = name.split("_")
        _write_dictionary(df.select(F.col(child).alias("line_no"), code.alias(f"{up}_code"), F.col(child).alias(f"{down}_code")), f"{folder}/{name}.asc", "$", "")
    return voc.flat_hierarchy(dims.load_hierarchy_levels(s.spark, folder), ["soc", "hlgt", "hlt", "pt"])


def _dims_from(s: Source, **tables: DataFrame) -> dict[str, DataFrame]:
    """All dictionaries: the given ones written to files and read back, the others built in."""
    folder = fresh_path(s.spark, "dims")
    for name, df in tables.items():
        _write_dictionary(df, f"{folder}/{name}.csv", ";")
    return dims.load_dims(s.spark, folder, {name: f"{name}.csv" for name in tables})


@query
def country_file(s):
    """Countries by a file; the fixed codes hold whatever the file says."""
    nation, region = s.table("nation"), s.table("region")
    raw = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        F.col("n_nationkey").alias("line_no"), F.when(F.col("n_nationkey") == 0, "XE").otherwise(F.col("n_name")).alias("Country"), F.concat(F.lit(" "), "r_name").alias("Country_Name"))
    people = s.table("customer").join(nation, F.col("c_nationkey") == nation["n_nationkey"]).select(
        F.col("c_custkey").cast("string").alias("primaryid"), F.lower("n_name").alias("occr_country"),
        F.when(F.col("c_custkey") % 3 == 0, "xe").when(F.col("c_custkey") % 3 == 1, F.concat(F.lit(" "), "n_name")).otherwise("a1").alias("reporter_country"))
    return std.std_country(people, _dims_from(s, country=raw)["country"]).select("primaryid", "occr_country", "reporter_country")


@query
def dose_form_file(s):
    """Dose forms by a file that names each many times: the last line stands."""
    raw = s.table("part").select(F.col("p_partkey").alias("line_no"), F.concat(F.lit(" "), F.lower("p_type")).alias("Dose_Form"), F.col("p_brand").alias("DOSE_FORM_ST"))
    forms = s("drug").select("primaryid", "drug_seq", F.col("prod_ai").alias("dose_form"))
    return std.std_dose_form(forms, _dims_from(s, dose_form=raw)["dose_form"])


@query
def route_file(s):
    """Routes by a file with two spellings of each: the exact one goes first."""
    even = F.col("p_partkey") % 2 == 0
    raw = s.table("part").select(F.col("p_partkey").alias("line_no"), F.when(even, F.col("p_type")).otherwise(F.lower("p_type")).alias("route"), F.col("p_brand").alias("route_st"))
    routes = s("drug").select("primaryid", "drug_seq", F.when(F.col("drug_seq") == "1", F.lower("prod_ai")).when(F.col("drug_seq") == "2", F.initcap("prod_ai")).otherwise(F.col("prod_ai")).alias("route"))
    return std.std_route(routes, _dims_from(s, route=raw)["route"])


@query
def unit_file(s):
    """Doses by a unit file; a factor that is no number leaves the amount as it is."""
    part = s.table("part")
    factor = F.when(F.col("p_size") % 5 == 0, "many").otherwise(F.col("p_size").cast("string"))
    raw = part.select(F.col("p_partkey").alias("line_no"), F.upper("p_brand").alias("unit"), F.col("p_type").alias("unit_st"), factor.alias("conversion_factor"))
    doses = part.select(F.col("p_partkey").cast("string").alias("primaryid"), F.col("p_brand").alias("dose_unit"), F.col("p_partkey").cast("string").alias("dose_amt"))
    return std.std_dose(doses, _dims_from(s, unit=raw)["unit"])


# --- deduplication ----------------------------------------------------------

@query
def dedup_primaryid(s):
    return dedup.latest_quarter(s("demo"), "caseid").select("caseid", "primaryid", "quarter", "fda_dt")


@query
def dedup_primaryid_ties(s):
    return dedup.latest_quarter(s("demo"), "caseid", ties="all").select("caseid", "primaryid", "quarter")


@query
def dedup_case(s):
    return dedup.latest_per_case(s("demo")).select("caseid", "primaryid", "caseversion", "quarter", "fda_dt")


@query
def dedup_manufacturer(s):
    return dedup.latest_per_manufacturer(s("demo")).select("primaryid", "mfr_num", "mfr_sndr", "fda_dt")


@query
def dedup_dataset(s):
    source, target = fresh_path(s.spark, "in"), fresh_path(s.spark, "out")
    s("demo").write.parquet(source)
    dedup.dedup_dataset(s.spark, source, target, "caseid")
    return s.spark.read.parquet(target).select("caseid", "primaryid", "quarter")


def _rb(s):
    demo, reac, drug = s("demo", "reac", "drug")
    return dedup.rule_based_duplicates(std.std_weight(std.std_age(std.std_sex(demo))), reac, drug)


@query
def rb_duplicates(s):
    return _rb(s).select("primaryid", "rb_duplicates")


@query
def rb_duplicates_susp(s):
    return _rb(s).select("primaryid", "rb_duplicates_only_susp")


@query
def sorted_term_list(s):
    return dedup.sorted_term_list(s("reac"), "pt")


@query
def term_chunks(s):
    """Term lists in chunks, here so short that most reports have several."""
    return dedup.term_chunks(s("reac"), "pt", max_bytes=12)


@query
def role_lists(s):
    return dedup.role_lists(s("drug"))


@query
def dup_stats(s):
    return dedup.dup_stats(_rb(s))


SIMILAR_COLUMNS = ["sex", "age", "age_cod", "wt", "wt_cod", "reporter_country", "occr_country", "occp_cod", "e_sub", "rept_cod"]


@query
def similarity_filter(s):
    return similarity.similarity_filter(s("demo").select("caseid", *SIMILAR_COLUMNS), ["caseid"], 0.7)


@query
def similarity_filter_strict(s):
    return similarity.similarity_filter(s("demo").select("caseid", *SIMILAR_COLUMNS), ["caseid"])


#: Evidence in bits of agreeing and of differing values; ages agree within a year, weights within two kilograms.
LINK_FIELDS = [
    linkage.Field("sex", 0.9, -4.0), linkage.Field("age_in_days", 3.5, -3.0, tolerance=365.0), linkage.Field("wt_in_kgs", 2.5, -2.0, tolerance=2.0),
    linkage.Field("event_dt", 4.0, -3.0), linkage.Field("reporter_country", 1.5, -2.5), linkage.Field("occr_country", 1.5, -2.0),
    linkage.Field("mfr_sndr", 2.0, -1.0), linkage.Field("rept_cod", 1.0, -0.5),
]
LINK_PASSES = [["caseid"], ["fda_dt", "reporter_country"], ["mfr_num", "event_dt", "sex"]]
#: Agreement is counted in blocks of at most so many profiles.
LINK_BLOCK = 40


@query
def linkage_score(s):
    """Reports that may tell of the same event under different ids, by fixed weights."""
    demo = std.std_demo(s("demo"), s.dim("country"), True)
    return linkage.linked_pairs(demo, LINK_FIELDS, LINK_PASSES, 9.0)


@query
def linkage_entities(s):
    """Reports with the smallest id of those they are linked with, directly or not, by stronger evidence."""
    # Standardizing takes longer than anything done with the rows later, so it is done once for pairs and members.
    demo = stage(std.std_demo(s("demo"), s.dim("country"), True).select("primaryid", *linkage.compared(LINK_FIELDS, LINK_PASSES)), "standard")
    pairs = linkage.linked_pairs(demo, LINK_FIELDS, LINK_PASSES, 13.0, connecting=True)
    return linkage.entities(pairs, linkage.members(demo, LINK_FIELDS, LINK_PASSES))


@query
def linkage_patterns(s):
    """How often the fields of compared reports agree: what weights are learnt from."""
    demo = std.std_demo(s("demo"), s.dim("country"), True)
    found = stage(linkage.profiles(demo, LINK_FIELDS, LINK_PASSES), "profiles")
    pairs = linkage.candidate_pairs(linkage.with_blocks(found, LINK_FIELDS, LINK_PASSES, LINK_BLOCK), len(LINK_PASSES))
    return linkage.pattern_counts(pairs, LINK_FIELDS)


@query
def drop_nullified(s):
    return dedup.drop_nullified(*s("demo", "deleted")).select("primaryid", "caseid")


# --- cases ------------------------------------------------------------------

@query
def complete_reports(s):
    return cases.complete_reports(*s("demo", "drug", "reac")).select("primaryid", "caseid")


@query
def incomplete_reasons(s):
    return cases.incomplete_reasons(*s("demo", "drug", "reac"))


@query
def completeness_stats(s):
    return cases.completeness_stats(*s("demo", "drug", "reac"))


@query
def case_flags(s):
    return cases.case_flags(*s("demo", "drug")).select("primaryid", "premarketing", "literature")


@query
def time_to_onset(s):
    return cases.time_to_onset(*s("demo", "ther")).select("primaryid", "drug_seq", "start_dt", "event_dt", "time_to_onset")


@query
def therapy_table(s):
    return release.therapy(*s("demo", "ther"))


@query
def onset_stats(s):
    return cases.onset_stats(cases.time_to_onset(*s("demo", "ther")))


@query
def clean_cases(s):
    demo, drug, reac = s("demo", "drug", "reac")
    out = release.clean_cases({"demo": demo, "drug": drug, "reac": reac}, s.dim("country"), True)
    return out.select("primaryid", "caseid", "quarter", "sex", "age_in_days", "age_grp", "wt_in_kgs", "occr_country",
                      "reporter_country", "occp_cod", "premarketing", "literature", "rb_duplicates", "rb_duplicates_only_susp")


# --- split ------------------------------------------------------------------

@query
def split_demo(s):
    return split.split_demo(s.release_demo())


@query
def split_demo_supp(s):
    return split.split_demo_supp(s.release_demo(), s("rpsr"))


@query
def split_drug(s):
    return split.split_drug(s("drug"), s.release_demo())


@query
def split_drug_name(s):
    return split.split_drug_name(*s("drug", "drug_info"), s.release_demo())


@query
def split_reac(s):
    return split.split_reac(s("reac"), s.release_demo(), s.tree())


@query
def split_outc(s):
    return split.split_outc(s("outc"), s.release_demo())


@query
def split_indi(s):
    return split.split_indi(s("indi"), s.release_demo(), s.tree())


@query
def split_ther(s):
    return split.split_ther(release.therapy(*s("demo", "ther")), s.release_demo())


@query
def split_doses(s):
    return split.split_doses(s("drug_info"), s.release_demo())


@query
def split_drug_supp(s):
    return split.split_drug_supp(s("drug_info"), s.release_demo())


# --- the composed release ---------------------------------------------------

def _released(s: Source, name: str) -> DataFrame:
    """One table of a release made from raw views."""
    return s.spark.read.parquet(f"{_once(s, _release)}/{name}")


def _release(s: Source) -> str:
    demo, drug, info, reac, outc, ther, rpsr, names = s("demo", "drug", "drug_info", "reac", "outc", "ther", "rpsr", "drug_dictionary")
    tables = {
        "demo": demo, "drug": drug.drop("trial", "substance", "substance_raw"), "drug_info": info, "outc": outc, "ther": ther, "rpsr": rpsr,
        "reac": reac.select("primaryid", "quarter", F.col("pt_raw").alias("pt"), F.col("pt_raw").alias("drug_rec_act")),
        "indi": s("indi_raw"),
    }
    out = fresh_path(s.spark, "release")
    release.release(
        tables, out, countries=s.dim("country"), dictionary=voc.drug_dictionary(names), terms=s.terms(),
        hierarchy=voc.with_term_rank(s("pt_tree").distinct(), ["soc", "hlt", "pt"]),
    )
    write_table(s.spark.range(1).toDF("done"), f"{out}/done")
    return out


@query
def release_demo(s):
    return _released(s, "demo")


@query
def release_demo_supp(s):
    return _released(s, "demo_supp")


@query
def release_drug(s):
    return _released(s, "drug")


@query
def release_drug_name(s):
    return _released(s, "drug_name")


@query
def release_reac(s):
    return _released(s, "reac")


@query
def release_outc(s):
    return _released(s, "outc")


@query
def release_indi(s):
    return _released(s, "indi")


@query
def release_ther(s):
    return _released(s, "ther")


@query
def release_doses(s):
    return _released(s, "doses")


@query
def release_drug_supp(s):
    return _released(s, "drug_supp")


# --- profiles and validation ------------------------------------------------

@query
def value_distribution(s):
    return quality.value_distribution(s("demo"), "age_cod")


@query
def top_countries(s):
    return quality.top_values(std.std_country(s("demo"), s.dim("country"), True), "reporter_country")


@query
def describe_age(s):
    return quality.describe(std.std_age(s("demo")), "age_in_years")


@query
def describe_weight(s):
    return quality.describe(std.std_weight(s("demo")), "wt_in_kgs")


@query
def describe_price(s):
    """A column with nearly as many values as rows."""
    return quality.describe(s.table("orders"), "o_totalprice")


@query
def mfr_profile(s):
    return quality.manufacturer_profile(s("demo"))


@query
def mfr_per_case(s):
    return quality.manufacturers_per_case(s("demo"))


@query
def route_coverage(s):
    return quality.coverage(std.std_route(s("drug_info"), s.dim("route"), True), "route")


@query
def unmapped_values(s):
    return quality.unmapped_values(s("drug_info"), "dose_form", s.dim("dose_form"), "dose_form")


@query
def validate_demo(s):
    return quality.validate(s("demo"), "demo")


@query
def validate_drug(s):
    return quality.validate(s("drug"), "drug")


@query
def validate_reac(s):
    old, new = (projections.rename_columns(df, S.ERA_NAMES["reac"]) for df in s("reac_old", "reac_new"))
    return quality.validation_result({"reac": old.unionByName(new, allowMissingColumns=True)})


@query
def validate_outc(s):
    return quality.validate(s("outc"), "outc")


@query
def validate_indi(s):
    """Both layouts under their newer names, which the rules do not know before they are unified."""
    old, new = s("indi_old", "indi_new")
    return quality.validation_result({"indi": old.toDF(*new.columns).unionByName(new)})


@query
def validate_ther(s):
    return quality.validate(s("ther"), "ther")


@query
def invalid_values(s):
    return quality.invalid_values(s("demo"), "demo")


@query
def validation_report(s):
    return quality.validation_result({k: s(k) for k in S.REQUIRED})


@query
def invalid_dates(s):
    return quality.invalid_dates(s("demo"), S.DATE_FIELDS["demo"])


@query
def quarter_summary(s):
    return quality.quarter_summary(s("demo"), "demo")


def _quarter(s):
    return release.process_quarter({k: s(k) for k in ("demo", "drug", "reac", "outc", "rpsr", "ther", "indi")})


@query
def process_quarter(s):
    return _quarter(s)[1]


@query
def process_quarter_findings(s):
    return _quarter(s)[0]


@query
def summary_totals(s):
    return quality.summary_totals(quality.run_summary({k: s(k) for k in ("demo", "drug", "ther")}))


@query
def report_lines(s):
    return quality.report_lines(stage(quality.run_summary({k: s(k) for k in ("demo", "drug", "ther")}), "summary"))


def bind(fn: Callable[[Source], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: fn(Source(spark, sf_dir))


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: bind(fn) for name, fn in QUERIES.items()}
