"""License notices and license texts found by template markup.

A template is plain wording with two kinds of marked regions:

* ``<<optional>> ... <</optional>>``: the wording may stand there or not;
* ``<<replace NAME a..b>>``: a to b words of any kind stand there (a name, a year).

Everything else is mandatory. A template is compiled into a token automaton: one
state per word position, replaceable regions as chains of positions that take
any word, optional regions as ways around. Sets of states become single numbers
on first use, so each word costs one look-up. A text is accepted where the
automaton reads from some word on to its end, so all mandatory wording must
match exactly, in order and without other words between.

Words are what ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` matches after A-Z are
lower-cased. Each text is first tested as a whole: the 64-bit hashes of its
words are looked up among those of the templates, and only texts with two
neighbouring words that may begin a template are read word by word, by their
true words. Everything happens in one map over the documents, without shuffle;
the templates are a fixed list of the caller's.

Defined results: a null text is empty; empty texts have no words and no places;
each row is judged by itself, so repeated rows give repeated rows; an empty
table gives an empty result; further columns are left out. A template must hold a
mandatory word and may not begin with a replaceable region.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casewright.llm import common

# ---------------------------------------------------------------------------
# Phrases that mark a license wherever they stand, and the wording
# of public license notices and texts.
# ---------------------------------------------------------------------------
PHRASES = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
TEMPLATES = [
    ("mit", "released under the <<optional>>terms of the<</optional>> MIT License"),
    ("mit", "licensed under the <<optional>>terms of the<</optional>> MIT License"),
    ("mit", """Permission is hereby granted, free of charge, to any person obtaining a copy of <<replace work 1..8>>
        (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,
        merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is
        furnished to do so, subject to the following conditions: The above copyright notice and this permission notice
        <<optional>>(including the next paragraph)<</optional>> shall be included in all copies or substantial portions of the Software.
        THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND"""),
    ("apache-2", "licensed under the <<optional>>terms of the<</optional>> Apache License, Version 2.0"),
    ("apache-2", """Licensed under the Apache License, Version 2.0 (the "License"); you may not use <<replace work 1..6>> except in compliance
        with the License. You may obtain a copy of the License at <<replace address 1..12>> Unless required by applicable law or agreed to
        in writing, software distributed under the License is distributed on an "AS IS" BASIS"""),
    ("cc-by-nc", "licensed under <<optional>>a<</optional>> <<optional>>the<</optional>> CC BY-NC <<replace version 2..2>>"),
    ("cc-by-nc", "licensed under <<replace article 1..1>> Creative Commons Attribution NonCommercial <<replace version 2..2>> International License"),
    ("cc-by", "licensed under <<replace article 1..1>> Creative Commons Attribution <<replace version 2..2>> International License"),
    ("cc-by-sa", "licensed under <<replace article 1..1>> Creative Commons Attribution ShareAlike <<replace version 2..2>> International License"),
    ("gpl-2", "licensed under the GNU General Public License <<optional>>as published by the Free Software Foundation<</optional>> version 2"),
    ("gpl-3", "licensed under the GNU General Public License <<optional>>as published by the Free Software Foundation<</optional>> version 3"),
    ("gpl-3", """is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License
        as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version"""),
    ("lgpl-3", """licensed under the GNU Lesser General Public License <<optional>>as published by the Free Software Foundation<</optional>> version 3"""),
    ("mpl-2", "subject to the terms of the Mozilla Public License, v. 2.0"),
    ("bsd", """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
        conditions are met: <<optional>>1.<</optional>> Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. <<optional>>2.<</optional>> Redistributions in binary form must reproduce the above copyright
        notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution"""),
    ("isc", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that
        the above copyright notice and this permission notice appear in all copies"""),
    ("unlicense", "This is free and unencumbered software released into the public domain"),
]
#: Number of all words that no template holds.
OTHER = 0
#: Steps an automaton remembers before it starts anew.
MAX_STEPS = 200_000
_MARK = re.compile(r"<<(optional|/optional|replace\s+(\w+)\s+(\d+)\.\.(\d+))>>")


def words_of(text: str | bytes) -> list[bytes]:
    raw = text.encode() if isinstance(text, str) else text
    return raw.translate(common.BY_SIGN).split()


@dataclass
class Automaton:
    """Positions with the word each takes (None: any), the positions that may follow, and those a match may begin and end with."""

    label: str
    words: list[bytes | None] = field(default_factory=list)
    follow: list[set[int]] = field(default_factory=list)
    first: set[int] = field(default_factory=set)
    last: set[int] = field(default_factory=set)

    @staticmethod
    def compile(label: str, markup: str) -> Automaton:
        out = Automaton(label)
        open_ends: set[int] = set()  # positions whose follower comes next
        at_start = True  # nothing mandatory so far
        optional: list[tuple[set[int], bool]] = []
        mandatory = False

        def put(word: bytes | None) -> None:
            nonlocal open_ends, at_start
            place = len(out.words)
            out.words.append(word)
            out.follow.append(set())
            for p in open_ends:
                out.follow[p].add(place)
            if at_start:
                out.first.add(place)
            open_ends, at_start = {place}, False

        def wording(text: str) -> None:
            nonlocal mandatory
            for word in words_of(text):
                mandatory = mandatory or not optional
                put(word)

        done = 0
        for mark in _MARK.finditer(markup):
            wording(markup[done : mark.start()])
            done = mark.end()
            if mark[1] == "optional":
                optional.append((set(open_ends), at_start))
            elif mark[1] == "/optional":
                if not optional:
                    raise ValueError(f"{label}: a region ends that did not begin")
                ends, start = optional.pop()
                open_ends, at_start = open_ends | ends, at_start or start
            else:
                low, high = int(mark[3]), int(mark[4])
                skipped: set[int] = set()
                skip_start = False
                for i in range(high):
                    if i >= low:
                        skipped |= open_ends
                        skip_start = skip_start or at_start
                    put(None)
                open_ends, at_start = open_ends | skipped, at_start or skip_start
        wording(markup[done:])
        if optional or not mandatory or any(out.words[p] is None for p in out.first):
            raise ValueError(f"{label}: a region does not end, nothing is mandatory, or a replaceable region comes first")
        out.last = open_ends
        return out

    def openings(self) -> set[tuple[bytes, bytes | None]]:
        """The two words a match may begin with; None if the second is any, or none."""
        pairs = set()
        for p in self.first:
            pairs |= {(self.words[p], self.words[f]) for f in self.follow[p]}
            if p in self.last:
                pairs.add((self.words[p], None))
        return pairs


class Reader:
    """An automaton whose sets of positions get numbers as they are met."""

    def __init__(self, automaton: Automaton):
        self.automaton = automaton
        self.clear()

    def clear(self) -> None:
        self.sets: list[frozenset[int]] = [frozenset(self.automaton.first)]
        self.numbers = {self.sets[0]: 0}
        self.steps: dict[tuple[int, bytes], tuple[int, bool]] = {}

    def _step(self, state: int, word: bytes) -> tuple[int, bool]:
        a = self.automaton
        took = [p for p in self.sets[state] if a.words[p] is None or a.words[p] == word]
        after = frozenset(f for p in took for f in a.follow[p])
        if after not in self.numbers:
            self.numbers[after] = len(self.sets)
            self.sets.append(after)
        found = self.numbers[after] if after else -1, any(p in a.last for p in took)
        self.steps[state, word] = found
        return found

    def end(self, words: list[bytes], start: int) -> int | None:
        """End of the longest match that begins at ``start``."""
        if len(self.steps) > MAX_STEPS:
            self.clear()
        state, found = 0, None
        for at in range(start, len(words)):
            state, done = self.steps.get((state, words[at])) or self._step(state, words[at])
            if done:
                found = at + 1
            if state < 0:
                break
        return found


class Matcher:
    """All phrases and templates of a scan."""

    def __init__(self, phrases: list[tuple[str, str]], templates: list[tuple[str, str]]):
        self.readers = [(True, Reader(Automaton.compile(label, text))) for text, label in phrases]
        self.readers += [(False, Reader(Automaton.compile(label, markup))) for label, markup in templates]
        vocabulary = sorted({w for _, r in self.readers for w in r.automaton.words if w is not None})
        hashes = common.word_hashes(vocabulary, common.BY_SIGN)[0]
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.number = {vocabulary[j]: i + 1 for i, j in enumerate(order)}
        self.begins = np.zeros((len(vocabulary) + 1, len(vocabulary) + 1), dtype=bool)
        self.by_opening: dict[bytes, list[int]] = {}
        for i, (_, reader) in enumerate(self.readers):
            for one, two in reader.automaton.openings():
                self.begins[self.number[one], slice(None) if two is None else self.number[two]] = True
            for one in {one for one, _ in reader.automaton.openings()}:
                self.by_opening.setdefault(one, []).append(i)

    def candidates(self, texts: list[bytes]) -> tuple[np.ndarray, list[np.ndarray]]:
        """Number of words of each text, and the words at which a template may begin."""
        hashes, counts = common.word_hashes(texts, common.BY_SIGN)
        at = np.searchsorted(self.hashes, hashes)
        at[at == len(self.hashes)] = 0
        ids = np.where(self.hashes[at] == hashes, at + 1, OTHER)
        spots = np.flatnonzero(self.begins[ids, np.append(ids[1:], OTHER)] if len(ids) else ids)
        ends = np.cumsum(counts)
        pieces = np.searchsorted(spots, np.concatenate([[0], ends]))
        return counts, [spots[a:b] - (end - n) for a, b, end, n in zip(pieces, pieces[1:], ends, counts)]

    def places(self, text: bytes, spots: np.ndarray) -> list[tuple[int, int, str, bool]]:
        """(first word, word after the last, label, is a phrase) of every match."""
        words = words_of(text)
        found = []
        for at in spots.tolist():
            for i in self.by_opening.get(words[at], ()):
                phrase, reader = self.readers[i]
                end = reader.end(words, at)
                if end is not None:
                    found.append((at, end, reader.automaton.label, phrase))
        return sorted(found)


PLACE = "struct<first:bigint,after:bigint,label:string,phrase:boolean>"


def scan(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, key: str = "doc_id") -> DataFrame:
    """``key, n_words, places``: every place of a phrase or template in each text, in order."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    id_type = rows.schema["doc_id"].dataType
    matcher = Matcher(phrases, templates)
    place = pa.struct([("first", pa.int64()), ("after", pa.int64()), ("label", pa.string()), ("phrase", pa.bool_())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in common.all_pieces(batches):
            texts = common.text_list(batch.column("text"))
            counts, spots = matcher.candidates(texts)
            found = [
                [dict(zip(("first", "after", "label", "phrase"), p)) for p in matcher.places(text, s)] if len(s) else []
                for text, s in zip(texts, spots)
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(found, pa.list_(place))], ["doc_id", "n_words", "places"])

    schema = f"doc_id {id_type.simpleString()}, n_words bigint, places array<{PLACE}>"
    return rows.mapInArrow(run, schema).withColumnRenamed("doc_id", key)


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")


def judge(docs: DataFrame, phrases: list[tuple[str, str]] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, key: str = "doc_id") -> DataFrame:
    """Counts, labels and a score: 1 if a template is accepted, one half if only a phrase stands there, else 0."""
    base = F.filter("places", lambda p: p["phrase"])
    starts = F.transform(base, lambda p: p["first"])
    accepted = F.exists("places", lambda p: ~p["phrase"])
    return scan(docs, phrases, templates, key).select(
        key, "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        _labels(base).alias("base_labels"), _labels(F.col("places")).alias("labels"),
        F.when(accepted, 1.0).when(F.size(base) > 0, 0.5).otherwise(0.0).alias("score"),
    )
