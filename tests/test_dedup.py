import itertools
import random

import pytest

from casewright.operators import dedup, similarity

DEMO = "primaryid string, caseid string, caseversion string, fda_dt string, quarter string, mfr_num string, mfr_sndr string"


def ids(df):
    return sorted(r["primaryid"] for r in df.collect())


def test_latest_quarter(rows):
    demo = rows([
        ("1", "a", "1", "20200101", "2020Q1", None, None), ("1", "a", "2", "20200201", "2020Q2", None, None),
        ("1", "b", "2", "20200301", "2020Q2", None, None), (None, "c", "1", "20200101", "2021Q1", None, None),
        ("2", "d", "1", "20200101", None, None, None),
    ], DEMO)
    one = dedup.latest_quarter(demo)
    assert ids(one) == ["1", "2"]
    assert one.filter("primaryid = '1'").first()["caseid"] == "b"
    every = dedup.latest_quarter(demo, ties="all")
    assert sorted(r["caseid"] for r in every.collect()) == ["a", "b"]


def test_missing_date_wins(rows):
    demo = rows([
        ("1", "a", "1", "20200101", "2020Q1", "m", "s"), ("2", "a", "1", None, "2020Q1", "m", "s"), ("3", None, "1", None, "2020Q1", "m", None),
        ("4", "b", "9", "20200101", "2020Q1", None, "s"), ("5", "b", "10", "20200101", "2020Q1", "m", "s"),
    ], DEMO)
    assert ids(dedup.latest_per_case(demo)) == ["2", "5"]
    assert ids(dedup.latest_per_manufacturer(demo)) == ["2", "3", "4"]


def test_ids_order_as_numbers(rows):
    demo = rows([("9", "a", "1", "20200101", "2020Q1", "m", "s"), ("10", "a", "1", "20200101", "2020Q1", "m", "s")], DEMO)
    assert ids(dedup.latest_per_case(demo)) == ["10"]


def test_hot_key_is_cut_before_the_shuffle(spark, rows):
    """Rank filters and maxima must combine on the map side."""
    demo = rows([(str(i), "hot" if i % 3 == 0 else str(i), "1", None, "2020Q1", "m", "s") for i in range(300)], DEMO)
    out = dedup.latest_per_case(demo)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert out.count() == 201
    assert out.filter("caseid = 'hot'").first()["primaryid"] == "297"


RB_DEMO = "primaryid string, fda_dt string, event_dt string, sex string, reporter_country string, age_in_days double, wt_in_kgs double"


def _reports(rows):
    demo = rows([
        ("1", "20200101", "20190101", "F", "X", None, 70.0), ("2", "20200102", "20190101", "F", "X", None, 70.0),
        ("3", "20200103", "20190101", "M", "X", None, 70.0), ("4", None, "20190101", "F", "X", None, 70.0),
        ("5", "20200101", "20190101", "F", "X", None, 70.0), ("6", "20200101", None, None, None, None, None),
    ], RB_DEMO)
    reac = rows([(str(i), p) for i in (1, 2, 3, 4, 5) for p in ("b", "a")] + [("4", "a")], "primaryid string, pt string")
    drug = rows([(str(i), "PS", "d1") for i in (1, 2, 3, 4, 5)] + [("1", "C", "d2"), ("2", "I", "d2"), ("5", "C", "d3")],
                "primaryid string, role_cod string, substance string")
    return demo, reac, drug


def test_rule_based_duplicates(rows):
    out = {r["primaryid"]: (r["rb_duplicates"], r["rb_duplicates_only_susp"]) for r in dedup.rule_based_duplicates(*_reports(rows)).collect()}
    assert out == {
        "1": (True, True),    # equal to 2 under both rules, 2 is later
        "2": (False, False),
        "3": (False, False),  # other sex
        "4": (False, False),  # reaction "a" twice
        "5": (False, True),   # other concomitant drug, equal suspects
        "6": (True, True),    # no reaction
    }


def test_term_lists(rows):
    reac = rows([("1", "b"), ("1", "a"), ("1", "b"), ("2", None)], "primaryid string, pt string")
    assert {r["primaryid"]: r["pt"] for r in dedup.sorted_term_list(reac, "pt").collect()} == {"1": "a; b; b", "2": ""}


def test_rule_groups_leave_one_unflagged(rows):
    rng = random.Random(3)
    demo = [(str(i), rng.choice([None, "20200101", "20200102"]), rng.choice(["20190101", None]), rng.choice(["F", None]), "X",
             rng.choice([1.0, None]), None) for i in range(200)]
    reac = [(str(i), rng.choice("ab")) for i in range(200) for _ in range(rng.randint(1, 2))]
    drug = [(str(i), rng.choice(["PS", "SS", "C", "I"]), rng.choice("xy")) for i in range(200) for _ in range(rng.randint(0, 2))]
    out = dedup.rule_based_duplicates(
        rows(demo, RB_DEMO), rows(reac, "primaryid string, pt string"), rows(drug, "primaryid string, role_cod string, substance string")).collect()

    def profile(i, roles):
        return tuple(sorted(s for p, r, s in drug if p == i and r in roles))

    groups = {}
    for d in demo:
        key = (*d[2:], tuple(sorted(p for i, p in reac if i == d[0])), *(profile(d[0], x) for x in (["PS"], ["SS"], ["I", "C"])))
        groups.setdefault(key, []).append(d)
    last = {max(g, key=lambda d: (d[1] is None, d[1] or "", int(d[0])))[0] for g in groups.values()}
    assert {r["primaryid"] for r in out if not r["rb_duplicates"]} == last


def test_drop_nullified(rows):
    demo = rows([("1", "a"), ("2", "b"), ("3", None)], "primaryid string, caseid string")
    gone = rows([("a",), ("a",), (None,)], "caseid string")
    assert ids(dedup.drop_nullified(demo, gone)) == ["2", "3"]


def brute(data, n_keys, threshold):
    kept = []
    for i, a in enumerate(data):
        group = [b for j, b in enumerate(data) if j != i and b[:n_keys] == a[:n_keys]]
        n = len(a) - n_keys
        best = 1.0 if not group else max(sum(x == y for x, y in zip(a[n_keys:], b[n_keys:])) / n for b in group)
        if best >= threshold:
            kept.append(a)
    return sorted(kept, key=repr)


@pytest.mark.parametrize("threshold,chunk", list(itertools.product([0.5, 0.75, 0.9, 1.0], [64, 2])))
def test_similarity_equals_brute_force(rows, threshold, chunk):
    rng = random.Random(7)
    data = [(rng.choice(["k1", "k1", "k2", None, f"u{i}"]), *[rng.choice(["a", "b", None]) for _ in range(4)]) for i in range(80)]
    df = rows(data, "k string, a string, b string, c string, d string")
    got = sorted((tuple(r) for r in similarity.similarity_filter(df, ["k"], threshold, chunk).collect()), key=repr)
    assert got == brute(data, 1, threshold)


@pytest.mark.parametrize("threshold,chunk", [(0.7, 64), (0.9, 8)])
def test_similarity_with_a_hot_key_and_many_columns(rows, threshold, chunk):
    """A key with more rows than a chunk, and so many columns that their choices could not be listed."""
    rng = random.Random(9)
    bases = [tuple(rng.choice("abcdefgh") for _ in range(24)) for _ in range(12)]
    data = []
    for i in range(260):
        cells = list(rng.choice(bases))
        for _ in range(rng.randint(0, 16)):
            cells[rng.randrange(24)] = rng.choice(["x", "y", None, f"u{i}"])
        data.append(("hot" if i % 5 else None, *cells))
    data += data[:5]
    df = rows(data, "k string, " + ", ".join(f"c{i} string" for i in range(24)))
    got = sorted((tuple(r) for r in similarity.similarity_filter(df, ["k"], threshold, chunk).collect()), key=repr)
    expected = brute(data, 1, threshold)
    assert got == expected and 20 < len(expected) < len(data) - 20


def test_similarity_edges(rows):
    df = rows([("k", 1.0), ("k", 1.0), ("j", 2.0)], "k string, v double")
    assert similarity.similarity_filter(df, ["k"]).count() == 3
    assert similarity.similarity_filter(df, []).count() == 3
    assert similarity.similarity_filter(df, ["k"], 0).count() == 3
    assert similarity.similarity_filter(df, ["k"], 1.5).count() == 0
    assert similarity.similarity_filter(df.select("k"), ["k"]).count() == 1


def test_similarity_moves_no_row_twice(spark, rows):
    """The last join moves each row once, and columns that are text travel once to be compared."""
    data = [(f"k{i % 5}", f"a{i % 3}", f"b{i % 4}", float(i % 2)) for i in range(60)]
    df = rows(data, "k string, a string, b string, x double")
    plan = similarity.similarity_filter(df, ["k"], 0.6)._jdf.queryExecution().optimizedPlan().toString()
    whole = next(line for line in plan.splitlines() if "LocalRelation" in line or "LogicalRDD" in line)
    above = next(line for line in plan.splitlines() if "Project [" in line and "AS _row#" in line and "struct(k" in line)
    assert whole and not above.split("struct(k")[0].split("Project [")[1]
    members = [line for line in plan.splitlines() if "collect_list" in line]
    assert members and all("c2," in line or "c2" in line for line in members) and not any(", c0," in line for line in members)
