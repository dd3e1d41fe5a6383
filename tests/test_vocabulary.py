import pytest
from pyspark.sql import functions as F

from casewright.operators import joins, numbering
from casewright.operators import standardize as std
from casewright.operators import vocabulary as voc
from casewright.sources import dims


def put(root, name, text):
    (root / name).write_text(text)


@pytest.fixture
def folder(spark, tmp_path):
    put(tmp_path, "llt.asc", "llt_code$llt_name$pt_code$a$b$c$d$e$f$g$h\n1$Tired$11$$$$$$$Y$\n2$Weary$11$$$$$$$Y$\n2$Weary$12$$$$$$$Y$\n3$Lost$99$$$$$$$Y$\n")
    put(tmp_path, "pt.asc", "pt_code$pt_name$null_field$soc$a$b$c$d$e$f$g\n11$Fatigue$$$$$$$$$\n12$Malaise$$$$$$$$$\n")
    for name, text in {
        "soc": "soc_code$soc_name$x\n1$Sb$\n2$Sa$\n", "soc_hlgt": "soc_code$hlgt_code\n1$1\n2$2\n",
        "hlgt": "hlgt_code$hlgt_name$x\n1$G1$\n2$G2$\n", "hlgt_hlt": "hlgt_code$hlt_code\n1$1\n2$2\n",
        "hlt": "hlt_code$hlt_name$x\n1$H1$\n2$H2$\n", "hlt_pt": "hlt_code$pt_code\n1$11\n2$12\n",
    }.items():
        put(tmp_path, f"{name}.asc", text)
    put(tmp_path, "countries.csv", "country;Country_Name\nus;United States\nNA;\nfr;Frankreich\nfr;France\nxe;Nowhere\n")
    return str(tmp_path)


def test_terms(spark, rows, folder):
    llt, pt = dims.load_terms(spark, folder)
    mapped = voc.llt_to_pt(llt, pt)
    assert {tuple(r) for r in mapped.collect()} == {("TIRED", "FATIGUE"), ("WEARY", "MALAISE"), ("LOST", None)}
    terms = voc.term_dictionary(pt, mapped, rows([("tired", "x"), ("beat ", " Fatigue")], "pt string, standard_pt string"))
    data = rows([(" TIRED",), ("Malaise",), ("beat",), ("lost",), ("odd",), (None,)], "pt string")
    assert [r["pt"] for r in voc.standardize_pt(data, "pt", terms).collect()] == ["fatigue", "malaise", "fatigue", None, None, None]
    fixes = rows([("beat", "fatigue")], "pt string, standard_pt string")
    work = {tuple(r) for r in voc.pt_worklist(data, "pt", terms, fixes).collect()}
    assert work == {("beat", "fatigue"), ("lost", None), ("odd", None)}


def test_hierarchy_order(spark, rows, folder):
    flat = voc.flat_hierarchy(dims.load_hierarchy_levels(spark, folder), ["soc", "hlgt", "hlt", "pt"])
    assert {(r["soc"], r["pt"]): r["pt_rank"] for r in flat.collect()} == {("Sa", "Malaise"): 1, ("Sb", "Fatigue"): 2}
    ranked = voc.rank_terms(rows([("Fatigue",), ("odd",)], "pt string"), "pt", flat)
    assert [tuple(r) for r in ranked.collect()] == [("Fatigue", 2), (None, None)]


def test_one_branch_is_ranked_in_many_ranges(rows, monkeypatch):
    names = [("Sa", f"H{i % 3}", f"P{i:03}") for i in range(300)]
    staged, stage = [], numbering.stage
    monkeypatch.setattr(numbering, "stage", lambda df, name: staged.append(stage(df, name)) or staged[-1])
    ranked = voc.with_term_rank(rows(names[::-1], "soc string, hlt string, pt string"), ["soc", "hlt", "pt"], range_rows=20)
    assert sorted(map(tuple, ranked.collect())) == [(*t, i + 1) for i, t in enumerate(sorted(names))]
    assert len(staged) == 2 and staged[1].groupBy("_range").count().agg({"count": "max"}).first()[0] < 60


def test_country_file(spark, rows, folder):
    countries = dims.load_dim(spark, f"{folder}/countries.csv", "country")
    demo = rows([("US",), (" na ",), ("FR",), ("XE",), ("A1",), ("zz",), ("",), (None,)], "occr_country string")
    out = std.std_country(demo, countries)
    assert [r["occr_country"] for r in out.collect()] == ["United States", "NA", "France", "Europe", None, None, None, None]
    assert out.filter("reporter_country IS NOT NULL").count() == 0


def test_absent_dictionary_is_empty(spark, rows, folder):
    gone = dims.load_dim(spark, f"{folder}/none.csv", "dose_form")
    assert std.std_dose_form(rows([("tab",)], "dose_form string"), gone).first()["dose_form"] is None


def test_routes_prefer_the_exact_spelling(spark, rows):
    routes = rows([("IV", "A", 1), ("iv", "B", 2), ("Po", "C", 3), ("PO", "D", 4), ("PO", "E", 5)], "route string, route_st string, line_no int")
    data = rows([("IV",), ("iv",), ("Iv",), ("po",), ("PO",), ("Po",), ("x",), (None,)], "route string")
    assert [r["route"] for r in std.std_route(data, routes).collect()] == ["A", "B", "B", "E", "E", "C", None, None]


def test_doses(spark, rows):
    data = rows([("2", "G ", "x", "ug"), ("3", "drop", "4", None), (None, "mg", "5", "mg")],
                "dose_amt string, dose_unit string, cum_dose_chr string, cum_dose_unit string")
    out = std.std_dose(data, dims.built_in(spark, "unit"), True).select("dose_amt", "dose_unit", "cum_dose_chr", "cum_dose_unit")
    assert [tuple(r) for r in out.collect()] == [(2000.0, "MG", None, "MG"), (3.0, None, 4.0, None), (None, "MG", 5.0, "MG")]


def test_drugs(rows):
    names = voc.drug_dictionary(rows(
        [("Aspirin.", "old", 1), ("ASPIRIN", "acetylsalicylic acid", 2), ("Duo", "a; b, trial", 3), ("none", None, 4)],
        "drugname string, substance string, line_no int"))
    data = rows([("1", " aspirin "), ("2", "duo"), ("3", "Tylenol"), ("4", None), ("5", "none")], "primaryid string, drug_name string")
    synonyms = voc.drug_synonyms(rows([("Acetaminophen", "APAP,Tylenol", 1)], "standardized_name string, common_variations string, line_no int"))

    def run(*more):
        return sorted((r["primaryid"], r["substance"], r["trial"]) for r in voc.standardize_drugs(data, names, *more).collect())

    assert run() == [("1", "acetylsalicylic acid", False), ("2", "a", False), ("2", "b", True), ("3", "UNKNOWN", False),
                     ("4", "UNKNOWN", False), ("5", "UNKNOWN", False)]
    assert ("3", "acetaminophen", False) in run(synonyms)


def test_large_dictionaries_take_the_salted_join(spark, rows, monkeypatch):
    big = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    dim = spark.range(0, 1500, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    want = sorted(map(str, joins.lookup_join(big, dim, ["k"]).collect()))
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert sorted(map(str, joins.lookup_join(big, dim, ["k"]).collect())) == want
    assert joins.lookup_join(big, dim, ["k"], "left_anti").count() == big.join(dim, "k", "left_anti").count()


def test_fits_broadcast(spark):
    assert joins.fits_broadcast(spark.range(10))
    assert not joins.fits_broadcast(spark.range(11), max_rows=10)
    assert not joins.fits_broadcast(spark.range(10).select(F.repeat(F.lit("x"), 1000).alias("s")), max_bytes=5000)


def test_pt_frequency(rows):
    pts = rows([("Nausea",)], "pt_name string")
    terms = rows([("nausea", "nausea"), ("sick", "nausea")], "term string, standard_pt string")
    data = rows([("NAUSEA",), ("sick",), ("sick",), ("odd",), (None,)], "pt string")
    freq = voc.pt_frequency(data, "pt", pts, terms)
    assert {tuple(r) for r in freq.collect()} == {("nausea", 1, 25.0, True, "nausea"), ("sick", 2, 50.0, False, "nausea"), ("odd", 1, 25.0, False, None)}
    assert tuple(voc.pt_coverage(freq).first()) == (4, 75.0, 75.0)
