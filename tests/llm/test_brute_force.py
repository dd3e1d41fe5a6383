"""Operators against plain versions that share no code with them, odd rows included."""

import hashlib
import math
import pickle
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from casewright.llm import decontaminate, ppm, sharding
from test_operators import ODD, frame, lorem


# --- prediction by partial matching -----------------------------------------

class PlainModel:
    """Byte contexts in dictionaries; every probability from its definition."""

    def __init__(self, texts, order):
        self.order = order
        self.seen = defaultdict(Counter)
        for t in texts:
            padded = b"\xff" * order + t + b"\xff"
            for i in range(order, len(padded)):
                for k in range(order + 1):
                    self.seen[padded[i - k : i]][padded[i]] += 1

    def log(self, context, symbol):
        excluded, out = set(), 0.0
        for k in range(self.order, -1, -1):
            counts = {s: n for s, n in self.seen.get(context[len(context) - k :], {}).items() if s not in excluded}
            if not counts:
                continue
            total = sum(counts.values())
            if symbol in counts:
                return out + math.log10((counts[symbol] - 0.5) / total)
            out += math.log10(0.5 * len(counts) / total)
            excluded |= set(counts)
        return out - math.log10(256 - len(excluded))

    def score(self, text):
        padded = b"\xff" * self.order + text + b"\xff"
        return sum(self.log(padded[i - self.order : i], padded[i]) for i in range(self.order, len(padded)))


@pytest.mark.parametrize("order, entries", [(2, 1 << 20), (5, 1 << 20), (3, 150)])
def test_language_model_equals_its_definition(spark, order, entries):
    training = [(i, t) for i, t in enumerate([lorem(i, 25) for i in range(12)] + ["", None, "été  Été\n", "aaa aaa"])]
    asked = ODD + [(100, lorem(3, 25)), (101, "xyz"), (102, "The étéé")]
    scored = ppm.score(frame(spark, asked), frame(spark, training), order, entries=entries).collect()
    model = PlainModel([(t or "").encode() for _, t in training], order)
    words = Counter(w for _, t in training for w in [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None])
    total, kinds = sum(words.values()), len(words)
    expected = []
    for i, t in asked:
        tokens = [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
        base = sum(math.log10((words[w] + 0.5) / (total + 0.5 * (kinds + 1))) for w in tokens)
        expected.append((-1 if i is None else i, len(tokens), sum(words[w] > 0 for w in tokens), total, base, model.score((t or "").encode())))
    got = sorted(((-1 if r["doc_id"] is None else r["doc_id"]), r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in scored)
    assert [g[:4] for g in got] == [e[:4] for e in sorted(expected)]
    for g, e in zip(got, sorted(expected)):
        assert g[4:] == pytest.approx(e[4:], rel=1e-9)


def test_language_model_is_held_in_few_bytes():
    """Every worker of an executor holds the model, so it must not take more than it has to."""
    codes = np.unique(np.random.default_rng(1).integers(0, 1 << 48, 1 << 19, dtype=np.uint64))
    counts = np.ones(len(codes), dtype=np.int64)
    pairs = np.unique(codes & np.uint64(0xFFFF), return_counts=True)
    assert len(pickle.dumps(ppm.Trie(codes, counts, *pairs), 5)) < 90 * len(codes)  # 189 with all numbers as doubles


@pytest.mark.parametrize("limit", [1, 5, 40, 1 << 20])
def test_tally_joins_equal_keys_before_it_gives_rows_up(limit):
    rng, tally, got = np.random.default_rng(limit), ppm.Tally(limit), []
    parts = [rng.integers(0, 30, 25, dtype=np.uint64) for _ in range(20)]
    for keys in parts:
        got += tally.add(keys)
    kept = tally.size
    got += tally.rest()
    found = Counter()
    for keys, n in got:
        found.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    assert found == Counter(np.concatenate(parts).tolist()) and kept <= limit + 30
    assert limit < 60 or len(got) == 1  # all 30 keys fit
    assert not list(ppm.Tally().rest())


# --- sharding ---------------------------------------------------------------

def plain_ring(rows, shards, nodes):
    """Rows one by one around the ring; ``rows``: (part, name, crc, size) with equal rows repeated."""
    points = sorted((int.from_bytes(hashlib.blake2b(f"{s}/{v}".encode(), digest_size=8).digest(), "big", signed=True), s) for s in range(shards) for v in range(nodes))
    arcs = defaultdict(list)
    for part, name, crc, size in rows:
        at = xxhash.xxh64(name.encode(), seed=42).intdigest()
        at -= (at >> 63) << 64
        arc = next((i for i, (p, _) in enumerate(points) if at <= p), 0)
        arcs[arc].append((part, at, name, crc, size))
    room = [len(rows) // shards + (s < len(rows) % shards) for s in range(shards)]
    shard_rows, waiting = defaultdict(list), []
    over = {}
    for arc, (_, owner) in enumerate(points):
        mine = sorted(arcs[arc])
        kept = mine[: room[owner] - len(shard_rows[owner])]
        shard_rows[owner] += kept
        over[arc] = mine[len(kept) :]
    for lap in range(2):
        for arc, (_, owner) in enumerate(points):
            free = room[owner] - len(shard_rows[owner])
            shard_rows[owner] += waiting[:free]
            waiting = waiting[free:] if free else waiting
            if lap == 0:
                waiting = waiting + over[arc]
    assert not waiting
    return sorted((name, crc, size, shard, slot) for shard, placed in shard_rows.items() for slot, (_, _, name, crc, size) in enumerate(placed))


@pytest.mark.parametrize("shards, nodes", [(16, 16), (3, 4)])
def test_sharding_equals_a_walk_row_by_row(spark, shards, nodes):
    docs = frame(spark, ODD + [(100 + i % 170, lorem(i % 120, 3)) for i in range(400)] + [(7, "hot")] * 90)
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), F.crc32(text).alias("crc"), (F.octet_length(text) + 1).cast("long").alias("size"))
    rows = [(r["part"], r["name"], r["crc"], r["size"]) for r in keyed.withColumn("part", F.pmod(F.xxhash64("name", "crc", "size"), F.lit(16))).collect()]
    got = sorted(("" if r["doc_id"] is None else str(r["doc_id"]), r["text_crc32"], r["size"], r["shard"], r["slot"]) for r in sharding.assign(docs, shards, nodes).collect())
    assert got == plain_ring(rows, shards, nodes)


# --- decontamination --------------------------------------------------------

def plain_hits(docs, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    windows = defaultdict(set)
    for item, t in items:
        w = split(t)
        for i in range(max(len(w) - window, 0) + 1):
            if w:
                windows[tuple(w[i : i + window])].add("" if item is None else str(item))
    out = []
    for i, t in docs:
        w, hit, found = split(t), set(), set()
        for size in {len(k) for k in windows}:
            for p in range(len(w) - size + 1):
                owners = windows.get(tuple(w[p : p + size]))
                if owners:
                    hit |= set(range(p, p + size))
                    found |= owners
        out.append((-1 if i is None else i, len(w), len(hit), sorted(found)))
    return sorted(out)


@pytest.mark.parametrize("pass_bytes", [None, 250])
def test_decontamination_equals_brute_force(spark, monkeypatch, pass_bytes):
    rng = random.Random(8)
    items = [(i, lorem(500 + i, rng.randint(1, 25))) for i in range(14)] + [(None, lorem(502, 12)), (3, "Two, three"), (90, ""), (91, None), (92, "!!"), (93, "x x x")]
    docs = list(ODD)
    for i in range(40):
        parts = [lorem(900 + i, rng.randint(0, 30))]
        for _ in range(rng.randint(0, 3)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randint(0, max(len(words) - 1, 0))
            parts += [" ".join(words[a : a + rng.randint(5, 20)]).upper(), lorem(1500 + i, rng.randint(0, 8))]
        docs.append((100 + i, "! ".join(parts)))
    if pass_bytes:
        monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    df, bench = frame(spark, docs), spark.createDataFrame([(i, t, "c") for i, t in items], "item_id long, text string, spans string")
    found = decontaminate.search(df, bench).withColumn("hit", decontaminate.hit_words())
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_words"], r["hit"], sorted({s["item"] for s in r["spans"]})) for r in found.collect())
    expected = plain_hits(docs, items)
    assert got == expected and sum(h > 0 for _, _, h, _ in expected) > 10
    clean = sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in decontaminate.clean(df, bench).collect())
    assert clean == sorted(i for i, _, h, _ in expected if not h)
