"""Phrases, license templates and conversation repair against brute force and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from casewright.llm import conversations, licenses, phrases
from casewright.llm.queries import ORACLE
from casewright.session import Workspace

ODD = [None, "", " \t\n", "a b c d", "a b c d", "é" * 700, "x " * 900, "w" * 5000, "A\tB  c. D e\x0bf;g"]


# --- phrases ----------------------------------------------------------------

def plain_phrases(rows, threshold, best, longest=5):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", lowered):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    frequent = {k: n for k, n in counts.items() if n >= threshold}
    found = {}
    for (lang, *w), a in frequent.items():
        if len(w) < 2:
            continue
        if any(x[0] == lang and len(x) - 1 > len(w) and 100 * b >= 100 * a and any(list(x[1 + i : 1 + i + len(w)]) == w for i in range(len(x) - len(w)))
               for x, b in frequent.items()):
            continue
        cuts = []
        for k in range(1, len(w)):
            left, right = frequent[(lang, *w[:k])], frequent[(lang, *w[k:])]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), a, left, right, totals[lang], score))
    return {(lang, i + 1, p.decode(), a, x, y, n, s) for lang, each in found.items() for i, (_, _, p, a, x, y, n, s) in enumerate(sorted(each)[:best])}


def prose(seed, texts, size):
    rng = random.Random(seed)
    words = ["the", "The", "of", "a", "cat", "été", "on", "mat", "x1", "–"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ", "]
    return [("" if rng.random() < 0.1 else "".join(rng.choice(words[: rng.randint(2, 10)]) + rng.choice(ends) for _ in range(rng.randint(1, size)))) for _ in range(texts)]


@pytest.mark.parametrize("threshold, best", [(3, 2000), (12, 7)])
def test_phrases_equal_brute_force(spark, threshold, best):
    texts = prose(1, 60, 60) + ODD
    rows = [(random.Random(i).choice(["en", "de", None]), t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(la, t, 1, "p", "n") for la, t in rows], "lang string, text string, n int, phrase string, `rank` string").repartition(5)
    found = phrases.collocations(docs, Workspace(spark, "phrases"), threshold, best=best)
    assert {tuple(r) for r in found.collect()} == plain_phrases(rows, threshold, best)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def test_phrases_of_nothing(spark):
    docs = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(docs, Workspace(spark, "phrases")).collect() == []
    few = spark.createDataFrame([(None, None), ("en", ""), ("en", "a b a b")], "lang string, text string")
    assert phrases.collocations(few, Workspace(spark, "phrases")).collect() == []


def test_long_texts_are_cut_between_pieces(monkeypatch):
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 50)
    text = b"\n".join(b"w%d" % i * 7 for i in range(40)) + b" " + b"z" * 90
    parts = list(phrases._parts(text))
    assert b"".join(parts) == text and len(parts) > 5 and all(p.endswith(b"\n") for p in parts[:-1])


@pytest.mark.parametrize("seed", range(5))
def test_summaries_keep_all_frequent_items(seed):
    rng = np.random.default_rng(seed)
    items = np.concatenate([rng.integers(0, 3000, 30_000), np.repeat(np.arange(5000, 5020), 101), rng.zipf(1.3, 20_000) % 9000]).astype(np.uint64)
    rng.shuffle(items)
    true = Counter(items.tolist())
    capacity = phrases.capacity(len(items), 100)
    total = phrases.Summary(capacity)
    for part in np.array_split(items, 13):
        own = phrases.Summary(capacity)
        for piece in np.array_split(part, 7):
            own.merge(*np.unique(piece, return_counts=True))
            own.settle()
        total.merge(own.prints, own.counts, own.taken)
        total.settle()
    assert 0 < total.taken < 100 and len(total.prints) <= capacity
    assert {i for i, n in true.items() if n >= 100} <= set(total.reaching(100).tolist())
    kept = dict(zip(total.prints.tolist(), total.counts.tolist()))
    assert all(kept.get(i, 0) <= n <= kept.get(i, 0) + total.taken for i, n in true.items())


def test_prints_survive_their_short_form():
    values = np.random.default_rng(1).integers(0, 1 << 63, 500).astype(np.uint64)
    assert (phrases._long(phrases._short(values)) == values & np.uint64((1 << 40) - 1)).all()


# --- licenses ---------------------------------------------------------------

MARKUP = [
    ("gift", "given <<optional>>away<</optional>> freely by <<replace who 1..3>> to <<optional>>all <<replace more 0..2>> of<</optional>> us"),
    ("late", "<<optional>>very<</optional>> late <<replace end 2..2>>"),
    ("late", "too late now"),
]


def plain_places(words, phrase_list, templates):
    found = []
    for text, label in phrase_list:
        p = text.split()
        found += [(i, i + len(p), label, True) for i in range(len(words)) if words[i : i + len(p)] == p]
    for label, markup in templates:
        pattern = ""
        for mark, low, high, word in re.findall(r"<<(/?optional|replace \w+ (\d+)\.\.(\d+))>>|([a-z]+)", markup):
            pattern += word + " " if word else {"optional": "(?:", "/optional": ")?"}.get(mark, "(?:[^ ]+ ){%s,%s}" % (low, high))
        for i in range(len(words)):
            # The longest of all readings, as the automaton reports.
            ends = [j for j in range(i + 1, len(words) + 1) if re.fullmatch(pattern, " ".join(words[i:j]) + " ")]
            if ends:
                found.append((i, max(ends), label, False))
    return sorted(found)


def test_license_automata_equal_brute_force(spark):
    rng = random.Random(3)
    words = "given away freely by to all of us very late too now cc nc zz".split()
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    texts += ["Given, AWAY freely by: a b c to us!", "given freely by x to all of us", "given freely by x y z w to us", "very late a", "CC-BY/NC cc by nc"]
    base = [("cc by nc", "nc"), ("of us", "us"), ("us us", "twice")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: [tuple(p) for p in r["places"]] for r in licenses.scan(docs, base, MARKUP).collect()}
    for i, text in enumerate(texts):
        assert got[i] == plain_places(re.findall("[a-z0-9]+", text.lower()), base, MARKUP), text


def test_license_texts_and_odd_rows(spark):
    grant = dict((label, m) for label, m in licenses.TEMPLATES if "hereby granted, free of charge" in m)["mit"]
    full = re.sub(r"<<replace[^>]*>>", "this software and associated documentation files", re.sub(r"<<optional>>.*?<</optional>>", "", grant, flags=re.S))
    texts = ODD + [full, full.replace("without restriction", "with restriction"), "a " * 30_000 + "Released under the MIT License.",
                   "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc", "under the mit license of the apache license, version 2",
                   "This work is licensed under the GNU General Public License, version 3."]
    rows = [(i if i else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words int, places string")
    got = {r["doc_id"]: r for r in licenses.judge(docs).collect()}
    assert len(got) == len(texts)
    empty = ("", "", 0, None, None, 0.0)
    for i, t in enumerate(ODD):
        r = got[i if i else None]
        assert (r["labels"], r["base_labels"], r["n_base"], r["first_word"], r["last_word"], r["score"]) == empty
        assert r["n_words"] == len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))
    rest = [(got[i]["base_labels"], got[i]["labels"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"], got[i]["score"]) for i in range(len(ODD), len(texts))]
    assert rest == [
        ("", "mit", 0, None, None, 1.0), empty, ("mit", "mit", 1, 30_001, 30_001, 1.0), ("cc-by-nc", "cc-by-nc", 1, 2, 2, 1.0),
        ("cc-by-nc", "cc-by-nc", 2, 0, 3, 0.5), ("apache-2,mit", "apache-2,mit", 2, 0, 6, 0.5), ("", "gpl-3", 0, None, None, 1.0),
    ]
    assert licenses.judge(docs.limit(0)).collect() == []


@pytest.mark.parametrize("markup", ["<<replace x 1..2>> a", "<<optional>>a<</optional>>", "<<optional>>a b", "a<</optional>>"])
def test_unsound_templates_are_refused(markup):
    with pytest.raises(ValueError):
        licenses.Automaton.compile("x", markup)


# --- conversations ----------------------------------------------------------

def cheapest(symbols):
    """All edits by plain search: (cost, audit, roles)."""
    from functools import cache

    @cache
    def best(i, state, inserted):
        ways = []
        due = "uuau"[state]
        after = {"u": 2, "a": 3}[due]
        if i == len(symbols):
            if state in (0, 3):
                ways.append((0, "", ()))
        else:
            initial, cut, gone = symbols[i]
            rest = best(i + 1, state, 0)
            ways.append((rest[0] + 2, "D" + rest[1], (None, *rest[2])))
            if not gone:
                if initial == due or initial == "s" and state == 0:
                    rest = best(i + 1, after if initial == due else 1, 0)
                    ways.append((rest[0] + 5 * cut, "K" + rest[1], (initial, *rest[2])))
                rest = best(i + 1, after, 0)
                ways.append((rest[0] + 1 + 5 * cut, "R" + rest[1], (due, *rest[2])))
        if inserted < 3:
            rest = best(i, after, inserted + 1)
            ways.append((rest[0] + 5, "I" + rest[1], (due, *rest[2])))
        return min(ways, default=(10**9, "", ()), key=lambda w: w[:2])

    return best(0, 0, 0)


def plain_repair(rows):
    """conv_id to (gaps, blank, duplicate, truncated, illegal, cost, audit, hash) from raw rows, by the rules as written."""
    groups = {}
    for conv, turn, role, text in rows:
        conv_rows = groups.setdefault(conv, [])
        name = " " if conv is None else str(conv), " " if turn is None else str(turn)
        fault = zlib.crc32(":".join(name).encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 0:
            continue
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        conv_rows += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    out = {}
    for conv, found in groups.items():
        found.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        turns = {t for t, _, _ in found if t is not None}
        blank = duplicate = truncated = 0
        seen, symbols = set(), []
        for _, role, text in found:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            kind = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            blank, duplicate, truncated = blank + (kind == "blank"), duplicate + (kind == "duplicate"), truncated + (kind == "truncated")
            symbols.append((role[:1], kind == "truncated", kind in ("blank", "duplicate")))
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(symbols, symbols[1:]))
        cost, audit, roles = cheapest(tuple(symbols))
        lines, left = [], iter(found)
        for letter, due in zip(audit, roles):
            _, role, text = (None, None, "") if letter == "I" else next(left)
            if letter != "D":
                lines.append((role if letter == "K" else {"u": "user", "a": "assistant"}[due]) + ":" + text)
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, blank, duplicate, truncated, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def odd_conversations(seed):
    rng = random.Random(seed)
    texts = ["Hello.", "Yes!", "cut off", "", " \n", None, "Was? ", "é…", "Long. " * 500, "x "]
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "ux"]
    rows = []
    for conv in [None, -1, *range(60)]:
        for turn in range(rng.randint(1, 12)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 5, None]), rng.choice(roles), rng.choice(texts)))
    return rows + rows[:40]


@pytest.mark.parametrize("seed", [1, 2])
def test_repaired_conversations_equal_brute_force(spark, seed):
    rows = odd_conversations(seed)
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, copies int, kind string").repartition(7)
    found = {r["conv_id"]: tuple(r)[1:] for r in conversations.digest(conversations.damage(df)).collect()}
    assert found == plain_repair(rows)


def test_repaired_rows_are_sound_and_undamaged_input_works(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi."), (1, 2, "user", "There?"), (2, 0, "assistant", "Yes."), (2, 1, "user", "No."), (2, 2, "assistant", "cut"), (3, None, "user", None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    figures = {r["conv_id"]: (r["cost"], r["audit"]) for r in conversations.audits(df).collect()}
    got = {}
    for r in conversations.repair(df).orderBy("conv_id", "position").collect():
        got.setdefault(r["conv_id"], []).append((r["edit"], r["role"], r["text"]))
    assert figures[1] == (1, "KKR") and figures[3] == (2, "D")
    assert got[1] == [("K", "system", "Be kind."), ("K", "user", "Hi."), ("R", "assistant", "There?")]
    assert 3 not in got and all(re.fullmatch("(s?(ua)+)?", "".join(role[0] for _, role, _ in each)) for each in got.values())


def test_a_long_conversation_and_a_block_of_any_size(spark):
    rng = random.Random(5)
    rows = [(7, i // 2, rng.choice(["user", "assistant", "system"]), rng.choice(["One.", "Two.", "three", f"No {i}."])) for i in range(900)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {r["conv_id"]: tuple(r)[1:] for r in conversations.digest(conversations.damage(df)).collect()}
    for block in (1, 2, 3):
        other = conversations.Tables(block)
        symbols = bytes(rng.choice([0, 1, 2, 3, 5, 6, 8]) for _ in range(400))
        assert other.repair(symbols) == conversations.tables().repair(symbols)
    expected = plain_repair_long(rows)
    assert found[7][5] == expected


def plain_repair_long(rows):
    """The cost by a row-by-row program without tables, for lengths the search cannot reach."""
    damaged = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if fault:
            text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
            damaged += [(turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    damaged.sort(key=lambda r: (r[0], r[1], hashlib.sha256(r[2].encode()).digest()))
    best, seen = {0: (0, "")}, set()

    def insert(ways):
        for _ in range(3):
            for state, (cost, audit) in list(ways.items()):
                after = {"u": 2, "a": 3}["uuau"[state]]
                ways[after] = min(ways.get(after, (10**9, "")), (cost + 5, audit + "I"))
        return ways

    for _, role, text in damaged:
        gone = not text.strip(" \t\n\x0b\x0c\r") or (role, text) in seen
        seen.add((role, text))
        cut = 0 if gone or text.rstrip()[-1] in ".!?" else 5
        ways = {}
        for state, (cost, audit) in insert(best).items():
            due = "uuau"[state]
            options = [(state, 2, "D")]
            if not gone:
                options.append(({"u": 2, "a": 3}[due], 1 + cut, "R"))
                if role[0] == due or role[0] == "s" and state == 0:
                    options.append((1 if role[0] == "s" else {"u": 2, "a": 3}[due], cut, "K"))
            for after, more, letter in options:
                ways[after] = min(ways.get(after, (10**9, "")), (cost + more, audit + letter))
        best = ways
    return min(v for s, v in insert(best).items() if s in (0, 3))[0]


def test_empty_conversations(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert conversations.digest(conversations.damage(spark.createDataFrame([], schema))).collect() == []
    dropped = next(t for t in range(100) if zlib.crc32(f"5:{t}".encode()) % 20 == 0)
    df = spark.createDataFrame([(5, dropped, "user", "Hi.")], schema)
    assert [tuple(r) for r in conversations.digest(conversations.damage(df)).collect()] == [(5, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


# --- SQL --------------------------------------------------------------------

@pytest.mark.parametrize("name", ["op11_phrases", "op12_licenses"])
def test_sql_equals_brute_force(name, tmp_path):
    """The SQL is a second form; on hand-made rows it must agree with the rules, too."""
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, lang VARCHAR, text VARCHAR)")
    texts = ["the cat. the cat! the CAT the cat on\tthe  mat"] * 60 + ODD + ["Released under the MIT License."]
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", [(i, "en" if i % 3 else None, t) for i, t in enumerate(texts)])
    rows = con.execute(ORACLE[name]).fetchall()
    if name == "op11_phrases":
        assert set(rows) == plain_phrases([("en" if i % 3 else None, t) for i, t in enumerate(texts)], 100, 2000) and rows
    else:
        assert {r[0]: r[1] for r in rows} == {i: len(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())) for i, t in enumerate(texts)}
        assert rows and {r[6] for r in rows} == {"", "mit"}
