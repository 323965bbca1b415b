"""Licence texts and notices found by templates with optional and replaceable regions.

A template is the wording of a licence with markup: `[...]` may be left out, `{a|b}` is one of the
wordings given, `{m-n}` is any m to n words. Everything else is mandatory, word by word. It is
compiled into a position automaton over words, which is run over the words of a text; only texts that hold all
mandatory stretches of a template are worth the run, and that is a search for bytes.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import bounded_batches

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))

# Phrases that name a licence, and the wording of public licences and of their notices.
PHRASES = {
    "mit": "under the mit license",
    "apache-2": "apache license version 2",
    "cc-by-nc": "cc by nc",
}
_BSD_CONDITIONS = (
    "redistribution and use in source and binary forms with or without modification are permitted "
    "provided that the following conditions are met [{1|a}] redistributions of source code must retain "
    "the above copyright notice this list of conditions and the following disclaimer [{2|b}] "
    "redistributions in binary form must reproduce the above copyright notice this list of conditions "
    "and the following disclaimer in the documentation and or other materials provided with the "
    "distribution "
)
_BSD_DISCLAIMER = (
    "this software is provided by {1-12} as is and any express or implied warranties including but "
    "not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed in no event shall {1-12} be liable for any direct indirect incidental special exemplary "
    "or consequential damages"
)
_GRANT = "{licensed|released|distributed|published|available} under [the terms of] "
_GNU = (
    "this {program|library|file|software|work} is free software you can redistribute it and or modify it "
    "under the terms of the gnu {kind} as published by the free software foundation [either] version {n} "
    "of the license"
)


class Template(NamedTuple):
    label: str
    wording: str


TEMPLATES = (
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and "
        "associated documentation files the software to deal in the software without restriction "
        "including without limitation the rights to use copy modify merge publish distribute sublicense "
        "and or sell copies of the software and to permit persons to whom the software is furnished to "
        "do so subject to the following conditions the above copyright notice and this permission notice "
        "[including the next paragraph] shall be included in all copies or substantial portions of the "
        "software the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a particular purpose "
        "and {noninfringement|non infringement} in no event shall {1-12} be liable for any claim damages "
        "or other liability",
    ),
    Template("mit", _GRANT + "{the|an} mit {license|licence}"),
    Template("bsd-2", _BSD_CONDITIONS + _BSD_DISCLAIMER),
    Template(
        "bsd-3",
        _BSD_CONDITIONS + "[{3|c}] neither the name of {1-12} nor the names of its contributors may be "
        "used to endorse or promote products derived from this software without specific prior "
        "written permission " + _BSD_DISCLAIMER,
    ),
    Template(
        "isc",
        "permission to use copy modify and [or] distribute this software for any purpose with or without "
        "fee is hereby granted provided that the above copyright notice and this permission notice "
        "appear in all copies",
    ),
    Template(
        "apache-2",
        "licensed under the apache license version 2 0 the license you may not use this {file|work} "
        "except in compliance with the license you may obtain a copy of the license at {0-12} unless "
        "required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind",
    ),
    *(
        Template(f"{short}-{n}", _GNU.replace("{kind}", kind).replace("{n}", str(n)))
        for short, kind, numbers in (
            ("gpl", "general public license", (2, 3)),
            ("lgpl", "lesser general public license", (2, 3)),
            ("agpl", "affero general public license", (3,)),
        )
        for n in numbers
    ),
    *(
        Template(f"{short}-{n}", f"{_GRANT}the gnu {kind} {{version {n}|v {n}|v{n}}}")
        for short, kind, numbers in (
            ("gpl", "general public license", (2, 3)),
            ("lgpl", "lesser general public license", (2, 3)),
            ("agpl", "affero general public license", (3,)),
        )
        for n in numbers
    ),
    Template(
        "mpl-2",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
    ),
    Template(
        "unlicense", "this is free and unencumbered software released into the public domain anyone is "
        "free to copy modify publish use compile sell or distribute this software",
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the "
        "authors be held liable for any damages arising from the use of this software permission is "
        "granted to anyone to use this software for any purpose including commercial applications and to "
        "alter it and redistribute it freely",
    ),
    Template(
        "bsl-1",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of "
        "the software and accompanying documentation covered by this license the software to use "
        "reproduce display distribute execute and transmit the software",
    ),
    *(
        Template(
            label,
            f"{_GRANT}{{a|the}} creative commons {kind} {{1|2|3|4}} {{0|5}} "
            "{international|unported|generic} {license|licence}",
        )
        for label, kind in (
            ("cc-by", "attribution"),
            ("cc-by-sa", "attribution {sharealike|share alike}"),
            ("cc-by-nc", "attribution {noncommercial|non commercial}"),
            ("cc-by-nd", "attribution {noderivatives|noderivs}"),
        )
    ),
    Template("cc0", "cc0 1 0 universal"),
)


class Wording(NamedTuple):
    word: bytes


class AnyWords(NamedTuple):
    least: int
    most: int


class OneOf(NamedTuple):
    ways: tuple[tuple, ...]
    optional: bool


def parse_template(wording: str) -> tuple:
    """The parts of a template in order: Wording, AnyWords and OneOf."""
    marks = re.findall(r"[\[\]{}|]|\d+-\d+(?=\})|[^\s\[\]{}|]+", wording)
    place = 0

    def ways(closing: str) -> tuple[tuple, ...]:
        nonlocal place
        found: list[list] = [[]]
        while place < len(marks):
            mark = marks[place]
            place += 1
            if mark == closing:
                return tuple(tuple(way) for way in found)
            if mark == "|" and closing == "}":
                found.append([])
            elif mark == "[":
                found[-1].append(OneOf(ways("]"), True))
            elif mark == "{":
                found[-1].append(OneOf(ways("}"), False))
            elif mark in "]}|":
                raise ValueError(f"unexpected {mark} in template: {wording}")
            elif re.fullmatch(r"\d+-\d+", mark):
                found[-1].append(AnyWords(*map(int, mark.split("-"))))
            else:
                found[-1] += [Wording(w) for w in WORD.findall(mark.lower().encode())]
        if closing:
            raise ValueError(f"no {closing} in template: {wording}")
        return (tuple(found[0]),)

    return ways("")[0]


class _Piece(NamedTuple):
    """Places that can begin and end a part, and whether it can be passed over."""

    first: int
    last: int
    empty: bool


class Automaton:
    """The position automaton of a template. Places are bits; `follow` has those that may come next."""

    def __init__(self, template: Template) -> None:
        self.label = template.label
        self.follow: list[int] = []
        self.any = 0
        self.of_word: dict[bytes, int] = {}
        parts = parse_template(template.wording)
        whole = self._chain(parts)
        if whole.empty:
            raise ValueError(f"a template without mandatory wording: {template.wording}")
        self.first, self.last = whole.first, whole.last
        self.mandatory = sum(isinstance(p, Wording) for p in parts)
        self.needs = self._stretches(parts)

    def _place(self, word: bytes | None) -> _Piece:
        bit = 1 << len(self.follow)
        self.follow.append(0)
        if word is None:
            self.any |= bit
        else:
            self.of_word[word] = self.of_word.get(word, 0) | bit
        return _Piece(bit, bit, False)

    def _chain(self, parts: Sequence) -> _Piece:
        done = _Piece(0, 0, True)
        for part in parts:
            for piece in self._pieces(part):
                for place in _bits(done.last):
                    self.follow[place] |= piece.first
                done = _Piece(
                    done.first | piece.first if done.empty else done.first,
                    done.last | piece.last if piece.empty else piece.last,
                    done.empty and piece.empty,
                )
        return done

    def _pieces(self, part: Wording | AnyWords | OneOf) -> Iterator[_Piece]:
        if isinstance(part, Wording):
            yield self._place(part.word)
        elif isinstance(part, AnyWords):
            for k in range(part.most):
                yield self._place(None)._replace(empty=k >= part.least)
        else:
            ways = [self._chain(way) for way in part.ways]
            yield _Piece(
                functools.reduce(int.__or__, [w.first for w in ways]),
                functools.reduce(int.__or__, [w.last for w in ways]),
                part.optional or any(w.empty for w in ways),
            )

    @staticmethod
    def _stretches(parts: Sequence) -> list[bytes]:
        """The runs of mandatory words, the longest first."""
        stretches: list[list[bytes]] = [[]]
        for part in parts:
            if isinstance(part, Wording):
                stretches[-1].append(part.word)
            else:
                stretches.append([])
        return sorted((b" " + b" ".join(s) + b" " for s in stretches if s), key=len, reverse=True)

    def matches(self, words: Sequence[bytes]) -> list[tuple[int, int]]:
        """Start and end of each match, in words. The match that ends first is taken, of those the one
        that starts first; the search goes on behind it."""
        found = []
        at: dict[int, int] = {}
        starters = {w for w, bits in self.of_word.items() if bits & self.first}
        for i, word in enumerate(words):
            if not at and not self.first & self.any and word not in starters:
                continue
            fits = self.any | self.of_word.get(word, 0)
            now: dict[int, int] = {}
            for place, start in at.items():
                for nxt in _bits(self.follow[place] & fits):
                    now[nxt] = min(start, now.get(nxt, start))
            for nxt in _bits(self.first & fits):
                now.setdefault(nxt, i)
            ends = [start for place, start in now.items() if self.last >> place & 1]
            if ends:
                found.append((min(ends), i + 1))
                now = {}
            at = now
        return found


def _bits(mask: int) -> Iterator[int]:
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


@dataclass(frozen=True)
class LicenseRules:
    """Phrases by label, and templates."""

    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[Template, ...] = TEMPLATES


@functools.cache
def _compiled(rules: LicenseRules) -> tuple[list[tuple[str, bytes]], list[Automaton]]:
    phrases = [
        (label, b" " + b" ".join(WORD.findall(text.lower().encode())) + b" ") for label, text in rules.phrases
    ]
    return phrases, [Automaton(t) for t in rules.templates]


FOUND = (
    "n_words long, places array<struct<label string, kind string, start long, stop long, wording long>>"
)


def find_licenses(docs: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """The licences of each document: doc_id, n_words and the places where one is named or quoted.

    A place has its label, the kind `phrase` or `template`, its first word, the word after it, and the number
    of mandatory words. Phrases are found wherever their words stand one after another; a
    template's matches do not overlap each other.

    Null and empty texts have no words and no places. Repeated rows and equal ids give a row each.
    Places come by start, stop, label and kind. Very long texts are matched as a whole, in memory of a few times
    their size. An empty table has no rows. Columns besides doc_id and text are not read.
    """
    bounded_batches(docs.sparkSession)
    field = docs.schema["doc_id"]
    schema = f"doc_id {field.dataType.simpleString()}, {FOUND}"
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(lambda batches: _scan(batches, rules), schema)


def _scan(batches: Iterator[pa.RecordBatch], rules: LicenseRules) -> Iterator[pa.RecordBatch]:
    place = pa.struct(
        [("label", pa.string()), ("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()),
         ("wording", pa.int64())]
    )
    for batch in batches:
        found = [find_places(text or b"", rules) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([p for _, p in found], pa.list_(place)),
            ],
            names=["doc_id", "n_words", "places"],
        )


def find_places(text: bytes, rules: LicenseRules) -> tuple[int, list[dict]]:
    """The number of words of a text and the places of its licences."""
    phrases, automata = _compiled(rules)
    words = WORD.findall(text.translate(LOWER))
    line = b" " + b" ".join(words) + b" "
    found = []
    for label, phrase in phrases:
        size = phrase.count(b" ") - 1
        before, seen, at = 0, 0, line.find(phrase)
        while at >= 0:
            before += line.count(b" ", seen, at)
            seen = at
            found.append((before, before + size, label, "phrase", size))
            at = line.find(phrase, at + 1)
    for automaton in automata:
        if all(stretch in line for stretch in automaton.needs):
            found += [
                (start, stop, automaton.label, "template", automaton.mandatory)
                for start, stop in automaton.matches(words)
            ]
    return len(words), [
        {"label": label, "kind": kind, "start": start, "stop": stop, "wording": wording}
        for start, stop, label, kind, wording in sorted(found)
    ]


def summarise_licenses(found: DataFrame) -> DataFrame:
    """Places as one line of labels each; `score` is the largest share of the words that is one
    place's mandatory wording."""
    phrases = F.filter("places", lambda p: p["kind"] == "phrase")
    starts = F.transform(phrases, lambda p: p["start"])
    share = F.array_max(F.transform("places", lambda p: p["wording"])) / F.col("n_words")
    return found.select(
        "doc_id",
        "n_words",
        F.size(phrases).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _labels(phrases).alias("base_labels"),
        _labels(F.col("places")).alias("labels"),
        F.coalesce(F.when(F.col("n_words") > 0, share), F.lit(0.0)).alias("score"),
    )


def _labels(places: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
