"""Numbers, quantiles, codes, list chunks and joins with frequent keys."""

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.operators import coding, dedup, joins, numbering, quality


@pytest.mark.parametrize("range_rows", [7, 100_000])
def test_numbers_follow_the_order(rows, range_rows):
    rng = random.Random(1)
    data = [(rng.choice(["a", "b", None]), f"v{rng.randrange(10**6)}") for _ in range(300)]
    df = rows(data, "g string, v string")
    plain = {r["v"]: r["no"] for r in numbering.numbered(df, ["v"], "no", range_rows=range_rows).collect()}
    assert plain == {v: i + 1 for i, v in enumerate(sorted(v for _, v in data))}
    by = {(r["g"], r["v"]): r["no"] for r in numbering.numbered(df, ["v"], "no", by="g", range_rows=range_rows).collect()}
    assert by == {(g, v): i + 1 for g in ("a", "b", None) for i, v in enumerate(sorted(v for h, v in data if h == g))}


@pytest.mark.parametrize("range_rows", [10, 100_000])
@pytest.mark.parametrize("values", [[1.0], [3.0, 1.0], [float(i) for i in range(501)], [2.5] * 40 + [7.0], [random.Random(2).gauss(0, 1) for _ in range(777)]])
def test_quantiles_are_exact(rows, values, range_rows):
    shares = [0, 0.25, 0.37, 0.5, 0.75, 1]
    df = rows([(v,) for v in [*values, None]], "x double")
    assert numbering.quantiles(df, "x", shares, range_rows) == pytest.approx([float(np.quantile(values, s)) for s in shares], abs=1e-12)


def test_describe_a_column_of_different_values_in_ranges(spark, rows):
    df = spark.range(5000).select((F.col("id") * 37 % 5000).cast("double").alias("x"))
    got = quality.describe(df, "x", range_rows=200).first()
    assert tuple(got)[4:7] == (1249.75, 2499.5, 3749.25) and got["n"] == 5000
    assert got["std"] == pytest.approx(statistics.stdev(range(5000)), abs=1e-6)
    assert tuple(quality.describe(rows([], "x double"), "x").first())[4:7] == (None, None, None)


@pytest.mark.parametrize("range_rows", [5, 100_000])
def test_codes_give_the_values_back(rows, range_rows):
    rng = random.Random(4)
    data = [(str(i), rng.choice(["b", "a", None, "é", ""]), rng.choice([f"w{j}" for j in range(40)])) for i in range(200)]
    df = rows(data, "id string, x string, y string")
    assert coding.category_columns(df) == ["x", "y"]
    codes = coding.code_table(df, ["x", "y"], range_rows)
    book = {(r["column_name"], r["value"]): r["code"] for r in codes.collect()}
    for at, c in ((1, "x"), (2, "y")):
        assert {v: n for (k, v), n in book.items() if k == c} == {v: i for i, v in enumerate(sorted({d[at] for d in data} - {None}))}
    coded, codes = coding.encode_categories(df)
    assert dict(coded.dtypes) == {"id": "string", "x": "int", "y": "int"}
    assert {(r["id"], r["x"]) for r in coded.collect()} == {(i, book.get(("x", x), -1)) for i, x, _ in data}
    assert sorted(map(tuple, coding.decode(coded, codes, ["x", "y"]).collect())) == sorted(data)
    other = coding.encode(rows([("1", "new", "w3")], "id string, x string, y string"), codes, ["x", "y"]).first()
    assert tuple(other) == ("1", -1, book["y", "w3"])
    plain, none = coding.encode_categories(rows([("1",), ("2",)], "id string"))
    assert plain.columns == ["id"] and none.collect() == []


@pytest.mark.parametrize("range_rows", [4, 100_000])
@pytest.mark.parametrize("limit", [1, 9, 64, 10_000])
def test_chunks_join_to_the_whole_list(rows, limit, range_rows):
    rng = random.Random(6)
    data = [("hot" if rng.random() < 0.5 else f"r{rng.randrange(30)}", rng.choice(["a", "bb", "term", "längere terme", None])) for _ in range(400)] + [("none", None)]
    df = rows(data, "primaryid string, pt string")
    whole = {r["primaryid"]: r["pt"] for r in dedup.sorted_term_list(df, "pt").collect()}
    chunks = {}
    for r in sorted(dedup.term_chunks(df, "pt", max_bytes=limit, range_rows=range_rows).collect(), key=lambda r: r["chunk"]):
        chunks.setdefault(r["primaryid"], []).append(r["text"])
    assert {k: "; ".join(v) for k, v in chunks.items()} == whole
    assert max(len(t.encode()) for v in chunks.values() for t in v) < limit + len("längere terme".encode()) + 2


def test_frequent_keys_are_found_and_spread(spark, rows):
    big = spark.range(40_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "warm").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("term"), "id")
    hashes = {r["term"]: r["h"] for r in big.select("term", F.xxhash64("term").alias("h")).distinct().collect()}
    assert set(joins.frequent_hashes(big, ["term"])) == {hashes["hot"], hashes["warm"]}
    dictionary = rows([("hot", 1), ("warm", 2), ("k1000", 3), ("k1000", 4), ("unused", 5)], "term string, code int")
    for how in ("left", "inner", "left_anti", "left_semi"):
        expected = sorted(map(repr, map(tuple, big.join(dictionary, "term", how).collect())))
        assert sorted(map(repr, map(tuple, joins.salted_join(big, dictionary, ["term"], how).collect()))) == expected


def test_a_dictionary_is_measured_once(spark, rows):
    dim = rows([("a", 1)], "term string, code int")
    context = spark.sparkContext
    context.setJobGroup("measure", "")
    try:
        assert joins.fits_broadcast(dim)
        jobs = len(context.statusTracker().getJobIdsForGroup("measure"))
        assert joins.fits_broadcast(dim) and not joins.fits_broadcast(dim, max_rows=0)
        assert len(context.statusTracker().getJobIdsForGroup("measure")) == jobs > 0
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
