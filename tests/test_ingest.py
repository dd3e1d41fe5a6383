import pathlib
import struct
import zlib

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from casewright import schemas as S
from casewright.operators import projections, quality
from casewright.plans import release
from casewright.sources import files, lines, tables
from casewright.streaming import ingest


def put(root, name, text):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode("latin-1"))


@pytest.fixture
def drop(tmp_path):
    put(tmp_path, "rep_2005q1/ascii/DEMO05Q1.TXT",
        "ISR$CASE$GNDR_COD$ REPT_DT$AGE\r\n1$10$F$20050101$5$\r\n2$11$M$$ 7  8 $\r\n")
    put(tmp_path, "rep_2014q2/ASCII/demo14q2.txt",
        "primaryid$caseid$sex$rept_dt$age$lit_ref\n3$12$UNK$20140101$9$Müller \"q\"\n4$13$F$20140102\n5$14$F$20140103$1$a$b\n")
    put(tmp_path, "rep_2014q2/ascii/DEMO14Q3.txt", "primaryid$caseid$sex$rept_dt$age$lit_ref\n")
    put(tmp_path, "rep_2014q2/ascii/STAT14Q2.txt", "nothing")
    put(tmp_path, "rep_2014q2/ascii/demo_size14q2.txt", "nothing")
    put(tmp_path, "rep_2014q2/ascii/other14q2.txt", "x$y\n1$2\n")
    put(tmp_path, "rep_2014q2/docs/demo14q2.txt", "x$y\n1$2\n")
    put(tmp_path, "rep_2011q2/ascii/DRUG11Q2.txt",
        "ISR$DRUG_SEQ$ROLE_COD$DRUGNAME$A$B$C$D$E$F\n1$1$PS$aspé$$$$$$7475791$2$SS$ibu$$$$$$\n9$9$C$x$$$$$$\n")
    return str(tmp_path)


def test_discover(spark, drop):
    found = {(r["file_name"], r["kind"], r["quarter"]) for r in files.discover(spark, drop).collect()}
    assert found == {("DEMO05Q1.TXT", "demo", "2005Q1"), ("demo14q2.txt", "demo", "2014Q2"), ("DEMO14Q3.txt", "demo", "2014Q3"),
                     ("DRUG11Q2.txt", "drug", "2011Q2")}
    assert files.discover(spark, drop, "ther").count() == 0
    assert files.discover(spark, drop, "demo", folder=None).count() == 4


def test_header_groups_never_mix_layouts(spark, drop):
    groups = files.header_groups(spark, files.discover(spark, drop, "demo"))
    assert sorted(len(g.paths) for g in groups) == [1, 2]


def test_read_two_eras(spark, drop):
    df = files.read_quarter_files(spark, drop, "demo", flag_malformed=True, source_file=True)
    got = {r["primaryid"]: r.asDict() for r in df.collect()}
    assert set(got) == {"1", "2", "3", "4", "5"}
    assert got["1"]["caseid"] == "10" and got["1"]["sex"] == "F" and got["1"]["quarter"] == "2005Q1"
    assert got["2"]["age"] == "7 8" and got["2"]["rept_dt"] is None
    assert got["3"]["lit_ref"] == 'Müller "q"'
    assert {i: r["_malformed"] for i, r in got.items()} == {"1": False, "2": False, "3": False, "4": True, "5": True}
    errors = {r["file_name"]: r["error_class"] for r in files.file_errors(df, files.discover(spark, drop, "demo")).collect()}
    assert errors == {"DEMO05Q1.TXT": None, "demo14q2.txt": "invalid_format", "DEMO14Q3.txt": "empty_file"}
    assert df.filter("_malformed").count() == 2


def test_merged_records_are_cut(spark, drop):
    df = files.read_quarter_files(spark, drop, "drug")
    got = sorted((r["primaryid"], r["drug_seq"], r["role_cod"], r["drugname"]) for r in df.collect())
    assert got == [("1", "1", "PS", "aspé"), ("7475791", "2", "SS", "ibu"), ("9", "9", "C", "x")]


def test_na_tokens_are_opt_in(spark, tmp_path):
    put(tmp_path, "q/ascii/DEMO14Q2.txt", "primaryid$occr_country\n1$NA\n2$NULL\n")
    plain = files.read_quarter_files(spark, str(tmp_path), "demo")
    assert sorted(r["occr_country"] for r in plain.collect()) == ["NA", "NULL"]
    nulled = files.read_quarter_files(spark, str(tmp_path), "demo", na_values=["", "NA", "NULL"])
    assert nulled.filter("occr_country IS NOT NULL").count() == 0


def test_no_files_give_an_empty_table(spark, drop):
    assert files.read_quarter_files(spark, drop, "ther").count() == 0


def test_detect_delimiter(spark, rows):
    df = rows([("a", "x,y$z"), ("a", "x$y"), ("b", "x|y|z"), ("b", "p|q|r"), ("c", "plain"), ("d", "1,2$3")], "file_name string, value string")
    got = {r["file_name"]: r["delimiter"] for r in lines.detect_delimiter(df).collect()}
    assert got == {"a": "$", "b": "|", "d": "$"}


def test_process_all_and_report(spark, drop, tmp_path):
    out = str(tmp_path / "out")
    summary = release.process_all(spark, drop, out)
    got = {(r["kind"], r["quarter"]): (r["total_rows"], r["processed_rows"]) for r in summary.collect()}
    assert got == {("demo", "2005Q1"): (2, 2), ("demo", "2014Q2"): (3, 1), ("drug", "2011Q2"): (3, 3)}
    assert spark.read.parquet(f"{out}/demo").count() == 3
    assert spark.read.parquet(f"{out}/rejected/demo").count() == 2
    text = quality.render_report(summary, 1.5)
    assert "## Quarter 2014Q2" in text and "| DEMO | 5 | 3 | 60.0% | 0 |" in text and "Missing columns" in text


def _bad_checksum(path, good_until):
    """A checksum file beside a local file that fails for what follows ``good_until`` bytes."""
    raw = path.read_bytes()
    sums = [zlib.crc32(raw[i : i + 512]) ^ (i >= good_until) for i in range(0, len(raw), 512)]
    (path.parent / f".{path.name}.crc").write_bytes(b"crc\0" + struct.pack(">i", 512) + b"".join(struct.pack(">I", c) for c in sums))


def test_broken_files_stop_nothing(spark, drop, tmp_path):
    put(tmp_path, "rep_2014q3/ascii/DEMO14Q3.TXT", "invalid\ndata\n")
    put(tmp_path, "rep_2014q4/ascii/DEMO14Q4.TXT", "")
    put(tmp_path, "rep_2015q1/ascii/DEMO15Q1.TXT", "primaryid$caseid\n")
    (tmp_path / "rep_2015q1/ascii/DEMO15Q2.TXT").write_bytes("primaryid$caseid\n1$2\n".encode("utf-16"))
    full = "primaryid$i_f_code$event_dt$sex$age_cod\n"
    put(tmp_path, "rep_2016q1/ascii/DEMO16Q1.TXT", full + "7$I$2016$X$YR\n8$I$20160101$M$ZZ\n9$F$20160101$Q\n10$F$20160101$Y$AA")
    put(tmp_path, "rep_2016q2/ascii/DEMO16Q2.TXT", full + "1$I$2016$M$YR\n")
    _bad_checksum(tmp_path / "rep_2016q2/ascii/DEMO16Q2.TXT", 0)
    put(tmp_path, "rep_2016q3/ascii/DEMO16Q3.TXT", full + "11$I$20160101$M$YR\n" * 9000)
    _bad_checksum(tmp_path / "rep_2016q3/ascii/DEMO16Q3.TXT", 100_000)
    out = str(tmp_path / "out")
    summary = {(r["kind"], r["quarter"]): (r["total_rows"], r["processed_rows"], r["invalid_dates"]) for r in release.process_all(spark, str(tmp_path), out).collect()}
    assert summary == {("demo", "2005Q1"): (2, 2, 0), ("demo", "2014Q2"): (3, 1, 0), ("demo", "2016Q1"): (4, 3, 1), ("drug", "2011Q2"): (3, 3, 0)}
    errors = {r["path"].rsplit("/", 1)[-1]: (r["n_rows"], r["n_malformed"], r["error_class"]) for r in spark.read.parquet(f"{out}/file_errors").collect()}
    assert errors == {
        "DEMO05Q1.TXT": (2, 0, "missing_columns"), "demo14q2.txt": (3, 2, "invalid_format"), "DRUG11Q2.txt": (3, 0, None), "DEMO14Q3.txt": (0, 0, "empty_file"), "DEMO14Q3.TXT": (0, 0, "missing_columns"),
        "DEMO14Q4.TXT": (0, 0, "empty_file"), "DEMO15Q1.TXT": (0, 0, "empty_file"), "DEMO15Q2.TXT": (0, 0, "invalid_format"), "DEMO16Q1.TXT": (4, 1, "invalid_format"),
        "DEMO16Q2.TXT": (0, 0, "unknown_error"), "DEMO16Q3.TXT": (0, 0, "unknown_error")}
    found = {(r["rule"], r["column_name"]): tuple(r)[4:] for r in spark.read.parquet(f"{out}/findings").filter("kind = 'demo'").collect()}
    assert found == {("allowed_values", "sex"): (2, "X", "Y"), ("allowed_values", "age_cod"): (2, "AA", "ZZ"), ("full_date", "event_dt"): (1, "2016", "2016")}
    assert spark.read.parquet(f"{out}/demo").count() == 6 and spark.read.parquet(f"{out}/rejected/demo").count() == 3


def test_a_table_is_read_once(spark, drop, tmp_path):
    """Tasks of the clean kind: one scan that writes, and the empty table of rejects."""
    probes = files.probe_files(spark, files.discover(spark, drop, "drug"))
    (group,) = files.groups_of(probes)
    context = spark.sparkContext
    context.setJobGroup("one pass", "")
    try:
        release._process_kind(spark, "demo", [], str(tmp_path / "none"))
        assert context.statusTracker().getJobIdsForGroup("one pass") == []
        run, _ = release._process_kind(spark, "drug", probes, str(tmp_path / "out"))
        jobs = context.statusTracker().getJobIdsForGroup("one pass")
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 3 and run.summary()[0][:4] == ("drug", "2011Q2", 3, 3)


def test_quarter_and_file_of_a_scan_are_constants(spark, drop, monkeypatch):
    """No row works them out from its path, unless files are too many for a scan each; rows are the same."""
    put(pathlib.Path(drop), "rep_2014q4/ascii/demo 14q4.txt", "primaryid$caseid$sex$rept_dt$age$lit_ref\n6$1$F$20140102$$\n")
    put(pathlib.Path(drop), "rep_2015q3/ascii/demo.txt/part-0", "primaryid$caseid$sex$rept_dt$age$lit_ref\n7$1$F$20140102$$\n")
    groups = files.header_groups(spark, files.discover(spark, drop, "demo"))
    read = lambda: files.read_groups(spark, groups, "demo", flag_malformed=True, source_file=True)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    each = read()
    assert "regexp_extract" not in plan(each)
    got = sorted(tuple(r) for r in each.na.fill("-").collect())
    assert {(r["primaryid"], r["quarter"], r["_file"]) for r in each.filter("primaryid > 5").collect()} == {
        ("6", "2014Q4", "demo 14q4.txt"), ("7", "2015Q3", "demo.txt")}
    monkeypatch.setattr(files, "MOST_SCANS", 0)
    shared = read()
    assert "regexp_extract" in plan(shared)
    # The path of a row stands in its coded form.
    assert sorted(tuple(v.replace("%20", " ") if isinstance(v, str) else v for v in r) for r in shared.na.fill("-").collect()) == got


def test_only_files_with_broken_lines_are_read_again(spark, drop, tmp_path, monkeypatch):
    head = "primaryid$drug_seq$role_cod$drugname"
    put(tmp_path, "rep_2014q2/ascii/DRUG14Q2.txt", f"{head}\n1$1$PS\n2$1$PS$b\n")
    put(tmp_path, "rep_2014q3/ascii/DRUG14Q3.txt", f"{head}\n3$1$PS$c\n")
    put(tmp_path, "rep_2014q4/ascii/DRUG14Q4.txt", f"{head}$prod_ai\n4$1$PS$d$e\n")
    probes = [p for p in files.probe_files(spark, files.discover(spark, str(tmp_path), "drug")) if "14Q" in p.path]
    seen, read = [], files.read_groups
    monkeypatch.setattr(files, "read_groups", lambda spark, groups, *a, **o: seen.append([p[-12:] for g in groups for p in g.paths]) or read(spark, groups, *a, **o))
    run, _ = release._process_kind(spark, "drug", probes, str(tmp_path / "out"))
    assert sorted(map(len, seen)) == [1, 3, 3] and ["DRUG14Q2.txt"] in seen
    rejected = spark.read.parquet(str(tmp_path / "out" / "rejected" / "drug"))
    assert {"prod_ai", "drugname", "quarter"} <= set(rejected.columns) and [(r["primaryid"], r["quarter"]) for r in rejected.collect()] == [("1", "2014Q2")]
    assert spark.read.parquet(str(tmp_path / "out" / "drug")).count() == spark.read.parquet(str(tmp_path / "out" / "drug_info")).count() == 3
    # A place that no file of the run bears: every file is looked at.
    run.malformed = {"2014Q2\telsewhere.txt": 1}
    groups = files.groups_of(probes)
    assert run.broken(groups) == groups


def test_unify_all(spark, drop, tmp_path):
    got = release.unify_all(spark, drop, str(tmp_path / "unified"))
    assert {k: df.count() for k, df in got.items()} == {
        "demo": 3, "drug": 3, "drug_info": 3, "indi": 0, "outc": 0, "reac": 0, "rpsr": 0, "ther": 0}
    assert sorted(r["primaryid"] for r in spark.read.parquet(str(tmp_path / "unified" / "rejected" / "demo")).collect()) == ["4", "5"]
    assert all(set(df.columns) == set(S.TABLES[k]) for k, df in got.items())


def test_a_kind_of_broken_lines_only(spark, tmp_path):
    """Everything is rejected, nothing hangs or fails."""
    put(tmp_path, "rep_2014q2/ascii/REAC14Q2.txt", "primaryid$pt$drug_rec_act\n1\n2\n")
    put(tmp_path, "rep_2014q2/ascii/THER14Q2.txt", "primaryid$drug_seq$start_dt\n")
    got = release.unify_all(spark, str(tmp_path), str(tmp_path / "u"))
    assert all(df.count() == 0 for df in got.values())
    assert release.to_bronze(spark, str(tmp_path), str(tmp_path / "b")).count() == 2
    summary = release.process_all(spark, str(tmp_path), str(tmp_path / "p"))
    assert [tuple(r)[:4] for r in summary.collect()] == [("reac", "2014Q2", 2, 0)]
    for out in "ubp":
        assert spark.read.parquet(str(tmp_path / out / "rejected" / "reac")).count() == 2


def test_bronze(spark, drop, tmp_path):
    out = str(tmp_path / "bronze")
    assert release.to_bronze(spark, drop, out).count() == 4
    assert spark.read.parquet(f"{out}/demo").count() == 3 and spark.read.parquet(f"{out}/rejected/demo").count() == 2
    assert spark.read.parquet(f"{out}/drug").filter("quarter = '2011Q2'").count() == 3


def test_csv_sink(spark, rows, tmp_path):
    tables.write_csv(rows([("1", "a")], "x string, y string"), str(tmp_path / "c"))
    assert [tuple(r) for r in spark.read.option("header", True).csv(str(tmp_path / "c")).collect()] == [("1", "a")]


def test_header_is_the_first_line_of_a_file_of_many_splits(spark, tmp_path):
    lines = "".join(f"{i}$1$PS$name {i}\n" for i in range(20_000))
    put(tmp_path, "q/ascii/DRUG14Q2.txt", "primaryid$drug_seq$role_cod$drugname\n" + lines)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "10000")
    try:
        (group,) = files.header_groups(spark, files.discover(spark, str(tmp_path), "drug"))
        assert group.header == ["primaryid", "drug_seq", "role_cod", "drugname"]
        assert files.read_quarter_files(spark, str(tmp_path), "drug").count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_stream_adds_deliveries(spark, rows, tmp_path):
    schema = "primaryid string, sex string, quarter string"
    landing, target, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    first = rows([("1", " F ", "2020Q1"), ("2", "M", "2020Q1"), ("1", "M", "2020Q2")], schema)
    first.write.parquet(landing)
    ingest.ingest_stream(spark, landing, first.schema, target, state).awaitTermination()
    rows([("1", "F", "2020Q2"), ("3", "", "2020Q2")], schema).write.mode("append").parquet(landing)
    ingest.ingest_stream(spark, landing, first.schema, target, state).awaitTermination()
    rows([("4", "M", "2020Q1"), (None, "F", "2020Q1")], schema).write.mode("append").parquet(landing)
    ingest.ingest_stream(spark, landing, first.schema, target, state, keep=1).awaitTermination()
    assert ingest.CurrentTable(spark, target).versions() == [2]
    got = sorted(tuple(r) for r in ingest.ingested(spark, target).select("primaryid", "sex", "quarter").na.fill("-").collect())
    assert got == [("-", "F", "2020Q1"), ("1", "F", "2020Q1"), ("1", "F", "2020Q2"), ("2", "M", "2020Q1"), ("3", "-", "2020Q2"), ("4", "M", "2020Q1")]


def _table(spark, target, buckets=ingest.BUCKETS):
    return sorted(tuple(r) for r in ingest.ingested(spark, target, buckets=buckets).select("primaryid", "sex", "quarter").na.fill("-").collect())


def test_a_delivery_rewrites_only_what_it_touches(spark, rows, tmp_path):
    schema = "primaryid string, sex string, quarter string"
    table = ingest.CurrentTable(spark, str(tmp_path / "t"), buckets=4)
    table.deliver(rows([(str(i), "F", q) for i in range(40) for q in ("2020Q1", "2020Q2", None)], schema), 0)
    before = table.pointers()
    assert len(before) > 8 and set(before.values()) == {0}
    table.deliver(rows([("7", "M", "2020Q2"), ("7", "X", "2020Q2"), ("99", "M", None), ("8", "M", None), (None, "U", "2020Q2")], schema), 1)
    after = table.pointers()
    changed = {s for s in after if after[s] != before.get(s)}
    assert 2 <= len(changed) <= 4 and all(s.startswith(("2020Q2-", "none-")) for s in changed)
    got = _table(spark, str(tmp_path / "t"))
    assert len(got) == 120 - 2 + 5 and [r for r in got if r[0] == "7"] == [("7", "F", "-"), ("7", "F", "2020Q1"), ("7", "M", "2020Q2"), ("7", "X", "2020Q2")]
    plan = ingest.ingested(spark, str(tmp_path / "t"))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan
    # What no pointer names can go; the rows stay.
    gone = table.drop_unused()
    assert gone and all(p.startswith("version=0/") for p in gone) and _table(spark, str(tmp_path / "t")) == got
    assert table.versions() == [1]


def test_a_delivery_that_failed_is_repeated_and_never_half_seen(spark, rows, tmp_path, monkeypatch):
    schema = "primaryid string, sex string, quarter string"
    target = str(tmp_path / "t")
    table = ingest.CurrentTable(spark, target, buckets=2)
    table.deliver(rows([("1", "F", "2020Q1"), ("2", "F", "2020Q1")], schema), 0)
    second = rows([("1", "M", "2020Q1"), ("3", "M", "2020Q2")], schema)
    with monkeypatch.context() as broken:
        broken.setattr(ingest.CurrentTable, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.deliver(second, 1)
    assert _table(spark, target, 2) == [("1", "F", "2020Q1"), ("2", "F", "2020Q1")]
    with pytest.raises(ValueError):
        ingest.ingested(spark, target, buckets=3)
    for _ in range(2):  # repeated after it was complete, too
        ingest.CurrentTable(spark, target, buckets=2).deliver(second, 1)
        assert _table(spark, target, 2) == [("1", "M", "2020Q1"), ("2", "F", "2020Q1"), ("3", "M", "2020Q2")]
    with pytest.raises(AnalysisException):
        ingest.ingested(spark, str(tmp_path / "nothing"))


def test_a_stream_restarts_from_its_checkpoint(spark, rows, tmp_path, monkeypatch):
    schema = "primaryid string, sex string, quarter string"
    landing, target, state = (str(tmp_path / n) for n in ("landing", "table", "state"))
    first = rows([("1", "F", "2020Q1")], schema)
    first.write.parquet(landing)
    with monkeypatch.context() as broken:
        broken.setattr(ingest.CurrentTable, "_switch", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(StreamingQueryException):
            ingest.ingest_stream(spark, landing, first.schema, target, state).awaitTermination()
    ingest.ingest_stream(spark, landing, first.schema, target, state).awaitTermination()
    assert _table(spark, target) == [("1", "F", "2020Q1")] and ingest.CurrentTable(spark, target).versions() == [0]


def test_resolve_columns_ignores_case():
    have = ["DRUGNAME", "sex", "Age_Cod"]
    assert projections.resolve_columns(have, ["drugname", "SEX", "age_cod", "gone"]) == {
        "drugname": "DRUGNAME", "SEX": "sex", "age_cod": "Age_Cod"}


def test_project_old_names(rows):
    df = rows([("1", "5", "0", "I", None, "M")], "ISR string, CASE string, FOLL_SEQ string, I_F_CODE string, sex string, GNDR_COD string")
    out = projections.project(df, "demo")
    assert out.columns == S.TABLES["demo"]
    row = out.first()
    assert (row["primaryid"], row["caseid"], row["caseversion"], row["i_f_cod"], row["sex"], row["wt"]) == ("1", "5", "0", "I", "M", None)
    assert projections.project(df, "demo", fill_empty=True).first()["wt"] == ""
    assert projections.project(df, "nothing").columns == df.columns


def test_rename_takes_repeated_names(rows):
    df = rows([("1", None, "b")], "x string, y string, z string")
    out = projections.rename_columns(df, {}, ["primaryid", "REPT_DT", " rept_dt"])
    assert [tuple(r) for r in out.collect()] == [("1", "b")]


def test_unify_data(rows):
    old = rows([("1", None, "n1"), ("1", None, "n1"), ("2", " ", "n2")], "ISR string, lot_num string, lot_nbr string")
    new = rows([("3", "l3")], "primaryid string, lot_num string")
    out = projections.unify_data([old, new], {"ISR": "primaryid"}, ["primaryid", "lot_num", "route"], [("lot_num", "lot_nbr")])
    assert sorted(tuple(r) for r in out.na.fill("-").collect()) == [("1", "n1", "-"), ("2", "-", "-"), ("3", "l3", "-")]
