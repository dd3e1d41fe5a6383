"""The suffix index: batches and levels stay in order of key and are merged by scans."""

import re

import pytest

from casewright import session
from casewright.llm import suffix_dedup
from casewright.session import Workspace
from test_operators import ODD, brute_repeats, frame, lorem


def _rows():
    shared = lorem(9, 60)
    return ODD + [(20 + i, lorem(20 + i, 40) + (shared if i % 3 else "") + lorem(80 + i, 20)) for i in range(24)] + [(90, shared), (91, shared * 2)]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_levels_are_merge_scanned_where_they_lie(spark, monkeypatch):
    session.tune(spark)
    meets, merges, sizes = [], [], []
    meet, merge, add = suffix_dedup.Family.meets, suffix_dedup.Family.merged, suffix_dedup.Family.add
    monkeypatch.setattr(suffix_dedup.Family, "meets", lambda self, a, b: (meets.append(meet(self, a, b)), meets[-1])[1])
    monkeypatch.setattr(suffix_dedup.Family, "merged", lambda self, a, b: (merges.append(_plan(merge(self, a, b))), merge(self, a, b))[1])
    monkeypatch.setattr(suffix_dedup.Family, "add", lambda self, *b: (add(self, *b), sizes.append([x is not None and x[0].count() for x in self.levels]))[0])
    work = Workspace(spark, "suffix_index")
    family = suffix_dedup.build(frame(spark, _rows()), work, 40, batches=7)
    # Seven batches: levels of one, two and four of them are left, and each batch met what was there.
    assert [sum(x is not False for x in s) for s in sizes] == [1, 1, 2, 1, 2, 2, 3] and len(meets) == 0 + 1 + 1 + 2 + 1 + 2 + 2 and len(merges) == 1 + 2 + 1
    for plan in [*map(_plan, meets), *merges]:
        assert "SortMergeJoin" in plan and "Exchange" not in plan and not re.search(r"\bSort \[", plan), plan
    entries = {}
    for level, _ in filter(None, family.levels):
        files = {}
        for r in level.selectExpr("key", "ctx", "n", "_metadata.file_name AS f").collect():
            files.setdefault(r["f"], []).append((r["key"], r["ctx"]))
            entries[r["key"], r["ctx"]] = entries.get((r["key"], r["ctx"]), 0) + r["n"]
        assert all(rows == sorted(rows) for rows in files.values()) and len(files) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = suffix_dedup.entries(frame(spark, _rows()), 40, 1).groupBy("key", "ctx").sum("n").collect()
    assert entries == {(r[0], r[1]): r[2] for r in whole}
    work.clear()


@pytest.mark.parametrize("batches", [1, 2, 5, 8])
def test_batches_change_nothing(spark, batches):
    session.tune(spark)
    got = suffix_dedup.digest(frame(spark, _rows()), 40, batches).collect()
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got) == brute_repeats(_rows(), 40)


def test_number_of_batches():
    assert [suffix_dedup.batch_count(n << 20) for n in (0, 33, 170, 860, 3000, 10**6)] == [4, 4, 4, 9, 32, 64]


def test_nothing_is_left_in_the_catalog(spark):
    session.tune(spark)
    suffix_dedup.digest(frame(spark, _rows()), 40).collect()
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("casewright_")] == []
