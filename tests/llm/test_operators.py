"""The training-data operators against brute force and on odd rows."""

import hashlib
import random
import weakref
import zlib

import numpy as np
import pytest
from pyspark.sql import GroupedData
from pyspark.sql import functions as F

import corpus_pipeline
from casewright.llm import bpe, decontaminate, jaccard_join, neighbours, ppm, sharding, suffix_dedup, token_files, toxicity, url_filters
from casewright.llm.queries import BYTE_VOCABULARY, WORD_VOCABULARY, vocabulary

SCHEMA = "doc_id long, text string, h int, row string, n int"  # extra columns with names the operators use inside
ODD = [(1, None), (2, ""), (3, "a b c d"), (3, "a b c d"), (None, "x " * 900), (5, "é" * 700), (6, " \t\n"), (7, "w" * 5000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "r", 2) for i, t in rows], SCHEMA)


def lorem(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return lambda name: Tokenizer.from_file(vocabulary(name))


def test_bpe_equals_the_library(spark, tokenizer):
    own = tokenizer(BYTE_VOCABULARY)
    texts = [t or "" for _, t in ODD] + ["a  b \n c<|endoftext|>'ll 123", lorem(1, 200)]
    rows = bpe.encode(frame(spark, list(enumerate(texts))), vocabulary(BYTE_VOCABULARY)).collect()
    assert {r["doc_id"]: r["ids"] for r in rows} == {i: own.encode(t, add_special_tokens=False).ids for i, t in enumerate(texts)}
    decoded = bpe.decode(bpe.encode(frame(spark, list(enumerate(texts))), vocabulary(BYTE_VOCABULARY)), vocabulary(BYTE_VOCABULARY))
    assert {r["doc_id"]: r["text"] for r in decoded.collect()} == dict(enumerate(texts))


@pytest.mark.parametrize("id_bytes", [2, 4])
@pytest.mark.parametrize("rows", [ODD, []])
def test_token_files_round_trip(spark, tokenizer, tmp_path, rows, id_bytes):
    own, path = tokenizer(WORD_VOCABULARY), str(tmp_path / "files")
    kept = token_files.tokenize(frame(spark, rows), vocabulary(WORD_VOCABULARY), 1, id_bytes).cache()
    token_files.write(kept, path, 49_408, files=3, id_bytes=id_bytes)
    got = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, r["start"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_files.read(spark, path).collect()), key=lambda r: r[2])
    assert [g[:2] for g in got] == sorted(g[:2] for g in got)
    assert sorted(g[3] for g in got) == sorted([*own.encode(t or "", add_special_tokens=False).ids, 1] for _, t in rows)
    assert [g[2] for g in got] == np.cumsum([0] + [len(g[3]) for g in got])[:-1].tolist()


def test_packed_numbers():
    values = np.array([0, 255, 256, 65535, 65536, 2**24, 2**32 - 1], dtype=np.uint32)
    control, data = token_files.pack(values)
    assert token_files.unpack(control, data, len(values)).tolist() == values.tolist()


def brute_components(rows, rule):
    sets, parent = [], list(range(len(rows)))
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i : i + rule.words]) for i in range(len(w) - rule.words + 1)} if len(w) >= rule.words else {tuple(w)} if w else set())

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= rule.percent * len(sets[i] | sets[j]):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    return {rows[i][0]: (len(sets[i]), rows[root(i)][0]) for i in range(len(rows))}


@pytest.mark.parametrize("rule", [jaccard_join.Rule(3, 90), jaccard_join.Rule(2, 80)])
def test_jaccard_components(spark, rule):
    rng, rows = random.Random(5), []
    for base in range(6):
        words = lorem(base, 60).split()
        for _ in range(6):
            copy = [rng.choice("xyz") if rng.random() < 0.015 else w for w in words]
            rows.append((len(rows), " ".join(copy)))
    rows += [(100, None), (101, ""), (102, "A b"), (103, "a B"), (104, "a c")]
    got = jaccard_join.link(frame(spark, rows), rule).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == brute_components(rows, rule)


def test_jaccard_on_odd_and_no_rows(spark):
    rule = jaccard_join.Rule(5, 80)
    kept = jaccard_join.one_of_each(frame(spark, ODD), rule)
    assert kept.columns == ["doc_id", "text", "h", "row", "n"]
    assert kept.count() == 7  # one of the two equal rows goes
    assert jaccard_join.link(frame(spark, []), rule).count() == 0


def brute_repeats(rows, length):
    texts, count = [(i, (t or "").encode()) for i, t in rows], {}
    for _, t in texts:
        for p in range(len(t) - length + 1):
            count[t[p : p + length]] = count.get(t[p : p + length], 0) + 1
    out = []
    for i, t in texts:
        gone = [False] * len(t)
        for p in range(len(t) - length + 1):
            if count[t[p : p + length]] > 1:
                gone[p : p + length] = [True] * length
        kept = bytes(c for c, g in zip(t, gone) if not g)
        out.append((-1 if i is None else i, len(t), sum(gone), sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone)), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def test_suffix_dedup(spark):
    shared = lorem(9, 60)
    rows = ODD + [(20, lorem(1, 40) + shared + lorem(2, 30)), (21, shared + lorem(3, 9)), (22, lorem(4, 200)), (23, shared[:150] + "!" + shared[150:])]
    for length in (40, 400):
        got = suffix_dedup.digest(frame(spark, rows), length).collect()
        assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == brute_repeats(rows, length)
    assert suffix_dedup.digest(frame(spark, [])).count() == 0


def test_suffix_dedup_batches_follow_the_input(spark, monkeypatch):
    shared = lorem(9, 60)
    rows = ODD + [(20, lorem(1, 40) + shared + lorem(2, 30)), (21, shared + lorem(3, 9)), (23, shared[:150] + "!" + shared[150:])] + [(30 + i, lorem(30 + i, 60)) for i in range(20)]
    added, add = [], suffix_dedup.Family.add
    monkeypatch.setattr(suffix_dedup.Family, "add", lambda self, *batch: (add(self, *batch), added.append(sum(x is not None for x in self.levels)))[0])
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 2000, raising=False)
    got = suffix_dedup.digest(frame(spark, rows), 40).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == brute_repeats(rows, 40)
    # As many levels as the number of batches has binary ones.
    assert len(added) == -(-sum(len((t or "").encode()) for _, t in rows) // 2000) > 4
    assert added == [(i + 1).bit_count() for i in range(len(added))]


def brute_passages(rows, length):
    texts, count = [(i, (t or "").split()) for i, t in rows], {}
    for _, t in texts:
        for p in range(len(t) - length + 1):
            count[tuple(t[p : p + length])] = count.get(tuple(t[p : p + length]), 0) + 1
    out = []
    for i, t in texts:
        gone = {q for p in range(len(t) - length + 1) if count[tuple(t[p : p + length])] > 1 for q in range(p, p + length)}
        out.append((-1 if i is None else i, [w for q, w in enumerate(t) if q not in gone]))
    return sorted(out)


def test_suffix_dedup_by_words(spark):
    shared = lorem(9, 60)
    few, other = "\n".join(shared.split()[:50]), " ".join(shared.split()[5:58])
    rows = ODD + [(20, lorem(1, 40) + " " + shared + " " + lorem(2, 30)), (21, shared + "  " + lorem(3, 9)), (22, lorem(4, 200)), (23, lorem(5, 9) + "\t" + few + "\n"), (24, other + " " + lorem(6, 70)), (25, " " + lorem(7, 51) + "\n"), (26, lorem(7, 51))]
    for length in (8, 51):
        got = suffix_dedup.cleaned(frame(spark, rows), length, words=True).collect()
        assert sorted((-1 if r["doc_id"] is None else r["doc_id"], (r["text"] or "").split()) for r in got) == brute_passages(rows, length)
    assert {r["doc_id"]: r["text"] for r in got}[25] == ""


def test_pipeline_cuts_passages_of_51_words(spark):
    passage = lorem(9, 52)
    assert len(passage) < 320
    own = [lorem(i, 30) for i in range(6)]
    texts = [f"{own[0]} {passage} {own[1]}", f"{own[2]}\n{passage}", f"{own[3]} " + " ".join(passage.split()[:50]), lorem(7, 60), f" {passage}\n", None]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars int")
    got = {r["doc_id"]: r for r in corpus_pipeline.cut_repeats(spark, docs, "").collect()}
    # 50 words of the passage stay, a text of nothing but the passage goes.
    assert {i: r["text"].split() for i, r in got.items()} == {0: (own[0] + " " + own[1]).split(), 1: own[2].split(), 2: texts[2].split(), 3: texts[3].split(), 5: []}
    assert all(r["n_chars"] == len(r["text"]) for r in got.values())


def test_decontamination(spark):
    item = lorem(3, 14)
    docs = frame(spark, ODD + [(30, lorem(4, 30) + " " + item.upper() + "! " + lorem(5, 5)), (31, lorem(6, 50)), (32, "one two three")])
    bench = spark.createDataFrame([(1, item, 0), (2, None, 0), (3, "Two, three", 0), (None, "", 0)], "item_id long, text string, spans int")
    got = {r["doc_id"]: r for r in decontaminate.search(docs, bench).withColumn("n_hit", decontaminate.hit_words()).filter("doc_id > 29").collect()}
    assert (got[30]["n_hit"], got[31]["n_hit"], got[32]["n_hit"]) == (14, 0, 2)
    assert [(s["item"], s["doc_word"], s["n_words"]) for s in got[30]["spans"]] == [("1", 30, 14)]
    assert sorted(r[0] for r in decontaminate.clean(docs, bench).select("doc_id").filter("doc_id > 29").collect()) == [31]
    assert decontaminate.search(docs, bench.limit(0)).filter("size(spans) > 0").count() == 0


def test_decontamination_loads_one_pass_at_a_time(spark, monkeypatch):
    items = [lorem(100 + i, 14) for i in range(12)]
    docs = frame(spark, ODD + [(30 + i, lorem(200 + i, 30) + " " + t + " " + items[i - 1]) for i, t in enumerate(items[:6])] + [(50, lorem(300, 40))])
    bench = spark.createDataFrame([*enumerate(items), (12, None), (13, "!"), (None, items[0]), (0, items[0])], "item_id long, text string")

    def results():
        found = sorted((r["doc_id"] or -1, r["n_words"], r["spans"]) for r in decontaminate.search(docs, bench).collect())
        return found, sorted(r["doc_id"] or -1 for r in decontaminate.clean(docs, bench).collect())

    whole, begin, seen, alive = results(), decontaminate.Items.__init__, [], []

    def watched(self, *parts):
        begin(self, *parts)
        seen.append(weakref.ref(self))
        alive.append(sum(r() is not None for r in seen))

    monkeypatch.setattr(decontaminate.Items, "__init__", watched)
    monkeypatch.setattr(decontaminate, "PASS_BYTES", 200)
    assert results() == whole and 50 in whole[1] and 30 not in whole[1]
    assert len(seen) > 6 and max(alive) <= 2


def test_language_model(spark):
    trie_texts = [lorem(i, 20).encode() for i in range(8)]
    keys, counts = np.unique(ppm.strings(trie_texts, 3)[0], return_counts=True)
    pairs, pair_counts = np.unique(ppm.strings(trie_texts, 3)[0] & np.uint64(0xFFFF), return_counts=True)
    trie = ppm.Trie(keys, counts, pairs, pair_counts, 3)
    for context in (b"abc", b"\xff\xff\xff", b"zzz", b"zza"):
        codes = np.uint64(int.from_bytes(context, "big") << 8) | np.arange(256, dtype=np.uint64)
        assert abs((10 ** trie.score(codes)).sum() - 1) < 1e-9
    docs = frame(spark, ODD + [(40 + i, t.decode()) for i, t in enumerate(trie_texts)])
    one = sorted((r[0] or 0, round(r["score"], 6), round(r["base_score"], 6), r["n_known"]) for r in ppm.score(docs, docs, 3).collect())
    cut = sorted((r[0] or 0, round(r["score"], 6), round(r["base_score"], 6), r["n_known"]) for r in ppm.score(docs, docs, 3, entries=100, top=5).collect())
    assert one == cut  # shards and rare words change nothing
    assert ppm.score(docs.limit(0), docs, 3).count() == 0 and ppm.score(docs, docs.limit(0), 3).filter("n_known > 0").count() == 0


def test_toxicity(spark):
    rows = [(i, lorem(i, 30) + (" vile" + "abc"[i % 3] if i % 2 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows] + [(900, None), (None, 1)], "doc_id long, toxic int")
    docs = frame(spark, rows + [(None, None), (901, "")])
    scored = toxicity.score(docs, toxicity.train(docs, labels)).collect()
    held = [r for r in scored if r["doc_id"] is not None and r["doc_id"] < 200 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert np.mean([r["predicted"] == r["doc_id"] % 2 for r in held]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in scored) and len(scored) == 202
    assert toxicity.score(docs, toxicity.train(docs, labels.limit(0))).filter("score != 0.5").count() == 0


def test_sharding(spark):
    got = sharding.assign(frame(spark, ODD + [(100 + i, "t") for i in range(300)])).collect()
    by = {s: sorted(r["slot"] for r in got if r["shard"] == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in by.values())
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1 and len(got) == 308
    assert sharding.assign(frame(spark, [])).count() == 0


def test_url_filters(spark):
    urls = [None, "", "no scheme/x", "HTTP://A.Example.NET/en/1?q", "http://example.net/de/", "http://xexample.net/", "x://org", "x://a.org/fr/", "http://net/#f"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls[-1:])], "page_id long, url string, rule string")
    rules = spark.createDataFrame([("net", "/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "block")], "host string, path string, verdict string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filters.judge(pages, rules).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/1", "example.net/en/", "allow") and got[4][2:] == ("net/", "block") and got[5][2:] == ("net/", "block")
    assert got[6] == ("org", "", None, "allow") and got[7][2:] == ("org/fr/", "block") and got[8] == got[9] == ("net", "/", "net/", "block")
    assert url_filters.judge(pages, rules.limit(0)).filter("rule IS NOT NULL").count() == 0


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(300)] + [(300, None), (301, [0.0] * 8), (302, [float("nan")] * 8), (303, [1.0]), (304, [None] * 8)]
    rows += [(400 + i, [1.0] * 8) for i in range(30)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<double>, rank int")
    config = neighbours.Config(k=5, probes=1.0)
    got = neighbours.search(df, F.col("vec_id") % 100 == 0, config).collect()
    good = [(i, np.array(v)) for i, v in rows if i < 300 or i >= 400]
    for q in (0, 100, 200, 400):
        v = dict(good)[q]
        best = sorted((float(np.sqrt(((w - v) ** 2).sum())), i) for i, w in good if i != q)[:5]
        assert [(r["vec_id"], r["rank"]) for r in sorted((r for r in got if r["query_id"] == q), key=lambda r: r["rank"])] == [(i, k + 1) for k, (_, i) in enumerate(best)]
    assert neighbours.search(df.limit(0), F.lit(True)).count() == 0


def test_neighbours_of_ids_with_several_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(0, np.zeros(8) + 0.1)] + [(1 + i % 2, np.zeros(8) + rng.normal(scale=0.01, size=8)) for i in range(60)] + [(10 + i, rng.normal(size=8) + 3) for i in range(40)]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in rows], "vec_id long, embedding array<double>")
    for config in (neighbours.Config(k=5), neighbours.Config(k=5, rows_per_list=5, probes=0.05)):
        got = sorted((r["rank"], r["vec_id"]) for r in neighbours.search(df, F.col("vec_id") == 0, config).collect())
        assert [rank for rank, _ in got] == [1, 2, 3, 4, 5] and {i for _, i in got[:2]} == {1, 2}
        if config.probes > 0.5:
            nearest = {i: min(float(np.sqrt(((v - rows[0][1]) ** 2).sum())) for j, v in rows if j == i) for i, _ in rows[1:]}
            assert [i for _, i in got] == sorted(nearest, key=nearest.get)[:5]


def test_neighbours_bound_the_queries_of_a_group(spark, monkeypatch):
    rng = np.random.default_rng(2)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(400)], "vec_id long, embedding array<double>")
    config = neighbours.Config(k=3, probes=1.0)
    whole = sorted(map(tuple, neighbours.search(df, F.col("vec_id") < 200, config).collect()))
    asked, cogroup = [], GroupedData.cogroup
    monkeypatch.setattr(GroupedData, "cogroup", lambda self, other: asked.append(other) or cogroup(self, other))
    monkeypatch.setattr(neighbours, "QUERY_ROWS", 20, raising=False)
    assert sorted(map(tuple, neighbours.search(df, F.col("vec_id") < 200, config).collect())) == whole and len(whole) == 600
    assert asked[0].count().agg(F.max("count")).first()[0] < 60
