import pytest
from pyspark.sql import functions as F

from casewright import schemas as S
from casewright.operators import cases, quality, split
from casewright.operators import standardize as std
from casewright.operators import vocabulary as voc
from casewright.operators.joins import KeyFilter
from casewright.plans import release
from casewright.session import Workspace
from casewright.sources import dims


def test_completeness_keeps_null_terms(rows):
    demo = rows([(str(i),) for i in range(1, 6)], "primaryid string")
    drug = rows([("1", "a"), ("2", "unspecified"), ("3", None), ("4", "no medication"), ("4", "b")], "primaryid string, substance string")
    reac = rows([("1", "x"), ("2", "x"), ("3", None), ("4", "no adverse event")], "primaryid string, pt string")
    assert sorted(r[0] for r in cases.complete_reports(demo, drug, reac).collect()) == ["1", "3"]
    why = {tuple(r) for r in cases.incomplete_reasons(demo, drug, reac).collect()}
    assert why == {("2", True, False), ("4", False, True), ("5", True, True)}
    assert tuple(cases.completeness_stats(demo, drug, reac).first()) == (5, 2, 2, 3, 2)


def test_flags(rows):
    demo = rows([("1", "ref"), ("2", None)], "primaryid string, lit_ref string")
    drug = rows([("2", True), ("2", True), ("1", False), ("1", None)], "primaryid string, trial boolean")
    got = {r["primaryid"]: (r["premarketing"], r["literature"]) for r in cases.case_flags(demo, drug).collect()}
    assert got == {"1": (False, True), "2": (True, False)}


@pytest.mark.parametrize("event,start,want", [
    ("20130110", "20130101", 10), ("20130101", "20130101", 1), ("20130101", "20130105", -3), ("20121231", "20130101", None),
    ("20121231", "20121231", 1), ("201301", "20130101", None), ("20130101", "2013", None), (None, "20130101", None),
])
def test_time_to_onset(rows, event, start, want):
    demo = rows([("1", event)], "primaryid string, event_dt string")
    ther = rows([("1", "1", start), ("2", "1", start)], "primaryid string, drug_seq string, start_dt string")
    got = {r["primaryid"]: r["time_to_onset"] for r in cases.time_to_onset(demo, ther).collect()}
    assert got == {"1": want, "2": None}


def test_release_tables(spark, rows, tmp_path):
    def table(kind, *data):
        extra = ["quarter"] if "quarter" not in S.TABLES[kind] else []
        columns = S.TABLES[kind] + extra
        return rows([tuple(d.get(c) for c in columns) for d in data], ", ".join(f"{c} string" for c in columns))

    base = dict(quarter="2020Q1", i_f_cod="I", event_dt="20200110", fda_dt="20200301", sex="f", age="40", age_cod="YR", wt="70", wt_cod="KG")
    tables = {
        "demo": table("demo", {**base, "primaryid": "1", "caseid": "c1", "caseversion": "1"}, {**base, "primaryid": "2", "caseid": "c1", "caseversion": "2"},
                      {**base, "primaryid": "3", "caseid": "c3", "caseversion": "1", "lit_ref": "x"}, {**base, "primaryid": "4", "caseid": "c4", "caseversion": "1"},
                      {**base, "primaryid": "5", "caseid": "gone", "caseversion": "1"}),
        "drug": table("drug", *[dict(primaryid=i, drug_seq="1", role_cod="PS", drugname="Duo.") for i in "1235"]),
        "reac": table("reac", *[dict(primaryid=i, pt=" Fatigue") for i in "12345"]),
        "outc": table("outc", dict(primaryid="2", outc_cod="DE"), dict(primaryid="2", outc_cod="DE"), dict(primaryid="9", outc_cod="DE")),
        "indi": table("indi", dict(primaryid="2", drug_seq="1", indi_pt="odd")),
        "rpsr": table("rpsr", dict(primaryid="2", rpsr_cod="HP"), dict(primaryid="2", rpsr_cod="CSM")),
        "ther": table("ther", dict(primaryid="2", drug_seq="1", start_dt="20200101", dur="2", dur_cod="WK")),
        "drug_info": table("drug_info", dict(primaryid="2", drug_seq="1", route="ORAL", val_vbm="1")),
    }
    pts = rows([("Fatigue",)], "pt_name string")
    terms = voc.term_dictionary(pts, rows([], "llt_name string, pt_name string"), dims.built_in(spark, "pt_fix"))
    dictionary = voc.drug_dictionary(rows([("duo", "a; b, trial", 1)], "drugname string, substance string, line_no int"))
    hierarchy = rows([("s", "fatigue", 1)], "soc string, pt string, pt_rank int")
    out = str(tmp_path / "release")
    release.release(tables, out, countries=dims.built_in(spark, "country"), dictionary=dictionary, terms=terms, hierarchy=hierarchy,
                    deleted=rows([("gone",)], "caseid string"))
    got = {name: spark.read.parquet(f"{out}/{name}") for name in S.SPLIT}
    assert sorted(r["primaryid"] for r in got["demo"].collect()) == ["2", "3"]
    assert all(r["premarketing"] for r in got["demo"].collect())
    assert {(r["primaryid"], r["literature"]) for r in got["demo"].collect()} == {("2", False), ("3", True)}
    assert sorted(r["rpsr_cod"] for r in got["demo_supp"].collect()) == ["CSM", "HP"]
    assert {(r["primaryid"], r["substance"], r["role_rank"]) for r in got["drug"].collect()} == {(i, s, 4) for i in "23" for s in "ab"}
    assert [tuple(r) for r in got["outc"].collect()] == [("2", "DE", 7)]
    assert [(r["dur_in_days"], r["time_to_onset"]) for r in got["ther"].collect()] == [(14.0, 10)]
    assert {(r["primaryid"], r["pt"], r["pt_rank"]) for r in got["reac"].collect()} == {("2", "fatigue", 1), ("3", "fatigue", 1)}
    assert got["indi"].first()["indi_pt"] is None
    assert got["drug_name"].count() == 1 and got["doses"].count() == 1 and got["drug_supp"].first()["route"] == "ORAL"


def test_key_filter_keeps_all_rows_of_its_keys_and_few_others(spark, rows):
    keys = rows([(str(i),) for i in range(0, 60000, 20)] + [(None,)], "primaryid string")
    df = rows([(str(i), i) for i in range(60000)], "primaryid string, n int")
    kept = {r["n"] for r in KeyFilter(keys, "primaryid", Workspace(spark, "keys"))(df).collect()}
    assert kept >= set(range(0, 60000, 20)) and len(kept) < 3000 + 57000 / 10
    assert KeyFilter(keys.limit(0), "primaryid", Workspace(spark, "keys"))(df).count() == 0


def test_release_moves_only_rows_of_selected_reports(spark, rows, tmp_path, monkeypatch):
    """Of 2,000 versions of a case one is in the release; the other tables' rows of the rest are not dealt."""
    kinds = {"demo": dict(caseid="c", quarter="2020Q1", fda_dt="20200301"), **{k: {} for k in split.PART_BY}}
    kinds["drug"] = dict(drugname="Duo", drug_seq="1", role_cod="PS")
    kinds["reac"] = dict(pt="Fatigue")
    tables = {}
    for kind, fixed in kinds.items():
        columns = S.TABLES[kind] + (["quarter"] if "quarter" not in S.TABLES[kind] else [])
        own = lambda i: {**fixed, "primaryid": str(i), "caseversion": str(i)}  # noqa: B023, E731
        tables[kind] = rows([tuple(own(i).get(c) for c in columns) for i in range(2000)], ", ".join(f"{c} string" for c in columns))
    dealt = {}
    real = release.stage_bucketed

    def watched(df, name, keys):
        staged = real(df, name, keys)
        dealt[name] = staged.count()
        return staged

    monkeypatch.setattr(release, "stage_bucketed", watched)
    terms = voc.term_dictionary(rows([("Fatigue",)], "pt_name string"), rows([], "llt_name string, pt_name string"), dims.built_in(spark, "pt_fix"))
    out = str(tmp_path / "release")
    release.release(tables, out, countries=dims.built_in(spark, "country"), terms=terms, hierarchy=rows([("s", "fatigue", 1)], "soc string, pt string, pt_rank int"),
                    dictionary=voc.drug_dictionary(rows([("duo", "a", 1)], "drugname string, substance string, line_no int")))
    assert [r["primaryid"] for r in spark.read.parquet(f"{out}/demo").collect()] == ["1999"]
    assert spark.read.parquet(f"{out}/drug").count() == spark.read.parquet(f"{out}/reac").count() == 1
    assert set(split.PART_BY) <= set(dealt) and max(dealt.values()) < 200


def _report_tables(spark, rows, n, hot_rows):
    """Tables of many reports and one that holds much of each of them."""
    ids = [str(i) for i in range(n)] + ["hot"] * hot_rows + ["other"]
    lines = list(enumerate(ids))
    return {
        "drug": rows([(r, str(i % 7), f"s{i % 3}", "PS", f"d{i % 4}", None) for i, r in lines], "primaryid string, drug_seq string, substance string, role_cod string, drugname string, prod_ai string"),
        "drug_info": rows([(r, str(i % 7), *[str(i % 2)] * 14) for i, r in lines], ", ".join(f"{c} string" for c in S.TABLES["drug_info"])),
        "reac": rows([(r, f"p{i % 5}", None) for i, r in lines], "primaryid string, pt string, drug_rec_act string"),
        "indi": rows([(r, str(i % 7), f"p{i % 9}") for i, r in lines], "primaryid string, drug_seq string, indi_pt string"),
        "outc": rows([(r, ["DE", "XX", "HO", "ZZ"][i % 4]) for i, r in lines], "primaryid string, outc_cod string"),
        "rpsr": rows([(r, f"r{i % 3}") for i, r in lines], "primaryid string, rpsr_cod string"),
        "ther": rows([(r, str(i % 7), "20200101", None, None, None) for i, r in lines], ", ".join(f"{c} string" for c in S.TABLES["ther"])),
    }


def test_tables_dealt_by_report_join_without_moving_rows(spark, rows):
    tables = _report_tables(spark, rows, 1200, 900)
    ready = {**tables, "outc": std.encode_factors(tables["outc"]), "ther": std.duration_days(tables["ther"])}
    dealt, hot = release.dealt_by_report(ready, tables)
    assert len(hot) == 1
    spread = dealt["drug"].filter("primaryid = 'hot'").select("_part").distinct().count()
    assert spread > 3 and dealt["drug"].filter("primaryid <> 'hot'").select("_part").distinct().count() == 1
    columns = sorted({*S.SPLIT["demo"], *S.SPLIT["demo_supp"]} - {"event_dt", "primaryid"})
    demo = rows([(str(i) if i else "hot", "20200105") for i in range(0, 1200, 2)], "primaryid string, event_dt string").select("*", *[F.lit("x").alias(c) for c in columns])
    hierarchy = rows([(f"p{i}", i) for i in range(4)], "pt string, pt_rank int")
    reports = release.stage_bucketed(split.in_all_parts(demo, hot), "reports", ["primaryid", "_part"])
    plain = split.split_tables({**ready, "demo": demo, "ther": cases.time_to_onset(demo, ready["ther"])}, hierarchy)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fast = split.split_tables({**dealt, "demo": demo, "ther": cases.time_to_onset(reports, dealt["ther"])}, hierarchy, reports)
        plans = {name: df._jdf.queryExecution().executedPlan().toString() for name, df in fast.items()}
        assert [n for n, p in plans.items() if "hashpartitioning(primaryid" in p] == []
        assert sum("SortMergeJoin" in p for p in plans.values()) == 9
        for name in plain:
            assert fast[name].columns == plain[name].columns
            assert sorted(map(repr, map(tuple, fast[name].collect()))) == sorted(map(repr, map(tuple, plain[name].collect()))), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert spark.catalog.listTables() == [] or all(not t.name.startswith("casewright_") for t in spark.catalog.listTables())


def test_supplement_can_keep_reports_without_source(rows):
    columns = S.SPLIT["demo_supp"]
    demo = rows([tuple("1" if c == "primaryid" else None for c in columns)], ", ".join(f"{c} string" for c in columns))
    rpsr = rows([("2", "HP")], "primaryid string, rpsr_cod string")
    assert split.split_demo_supp(demo, rpsr).count() == 0
    assert split.split_demo_supp(demo, rpsr, how="left").count() == 1


def test_validation(rows):
    good = rows([("1", "I", "20220101", "M", "45", "YR")], "primaryid string, i_f_cod string, event_dt string, sex string, age string, age_cod string")
    assert quality.validate(good, "demo").count() == 0
    bad = rows([("1", "I", "invalid_date", "X", "XX"), ("2", "I", "2022", "M", None)],
               "primaryid string, i_f_cod string, event_dt string, sex string, age_cod string")
    found = {(r["rule"], r["column_name"]): (r["n_bad"], r["first_value"], r["last_value"]) for r in quality.validate(bad, "demo").collect()}
    assert found == {("allowed_values", "sex"): (1, "X", "X"), ("allowed_values", "age_cod"): (1, "XX", "XX"),
                     ("full_date", "event_dt"): (2, "2022", "invalid_date")}
    missing = rows([("data",)], "invalid string")
    assert {r["column_name"] for r in quality.validate(missing, "ther").collect()} == {"primaryid", "drug_seq", "start_dt"}
    assert quality.validate(missing, "nothing").first()["rule"] == "unknown_kind"
    result = {r["kind"]: (r["n_rows"], r["valid"], r["n_errors"], r["n_warnings"]) for r in quality.validation_result({"demo": bad, "reac": missing}).collect()}
    assert result == {"demo": (2, True, 0, 3), "reac": (1, False, 2, 0)}
    upper = rows([("1", "de"), ("2", "zz")], "primaryid string, outc_cod string")
    assert [r["first_value"] for r in quality.validate(upper, "outc").collect()] == ["ZZ"]


def test_profiles(rows):
    df = rows([("a", 1.0), ("a", 2.0), ("b", 3.0), (None, 4.0)], "v string, x double")
    assert {tuple(r) for r in quality.value_distribution(df, "v").collect()} == {("a", 2, 50.0), ("b", 1, 25.0), (None, 1, 25.0)}
    assert [tuple(r) for r in quality.top_values(df, "v", 1).collect()] == [("a", 2)]
    assert tuple(quality.describe(df, "x").first()) == (4, 2.5, 1.290994, 1.0, 1.75, 2.5, 3.25, 4.0)


def test_narrow_types(rows):
    df = rows([(1, 300, 70000, 2**40, "x")] * 3, "a long, b long, c long, d long, s string")
    assert [t for _, t in quality.narrow_types(df).dtypes] == ["tinyint", "smallint", "int", "bigint", "string"]
    targets = {r["column_name"]: r["target"] for r in quality.narrow_stats(df).collect()}
    assert targets["s"] == "category"


def test_quarter_calendar(spark):
    got = [r["quarter"] for r in release.quarter_calendar(spark, "20050215").orderBy("quarter").collect()]
    assert got == ["2004Q1", "2004Q2", "2004Q3", "2004Q4", "2005Q1"]


def test_archive_links(rows):
    pages = rows([(1, '<a href="/f/rep_ascii_2013q1.zip">x</a><a href="/x.html">y</a>'), (2, "<A class=z HREF='/g/rep_ascii_2013Q1.ZIP'>x</A>")],
                 "page_id int, html string")
    assert [tuple(r) for r in release.archive_links(pages).collect()] == [("2013q1", "/g/rep_ascii_2013Q1.ZIP")]
    assert release.page_links(pages).filter(F.col("href") == "/x.html").first()["position"] == 1


def test_archive_catalog_knows_eras_and_first_year(rows):
    pages = rows([(1, '<a href="/f/faers_ascii_2014q1.zip">x</a><a href="/f/AERS_ASCII_2005Q3.ZIP">y</a><a href="/f/aers_ascii_2014q2.zip">z</a><a href="/f/aers_ascii_2003q4.zip">w</a>')],
                 "page_id int, html string")
    got = {r["quarter"]: (r["valid"], r["file_name"], r["named"]) for r in release.archive_catalog(pages).collect()}
    assert got == {
        "2014q1": (True, "faers_ascii_2014q1.zip", True), "2005q3": (True, "aers_ascii_2005q3.zip", True),
        "2014q2": (True, "faers_ascii_2014q2.zip", False), "2003q4": (False, "aers_ascii_2003q4.zip", True)}
