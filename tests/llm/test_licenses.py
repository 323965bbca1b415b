from __future__ import annotations

import random
import re

import pytest

from aislewise.llm import licenses as li
from aislewise.llm.oracle import _template_pattern

TEXTS = [
    None,
    "",
    " \n\t",
    "Released under the MIT License. Under the MIT licence? under THE mit license",
    "CC-BY-NC cc by nc cc by nc",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, either version 3 of the License",
    "This program is free software: you can redistribute it and modify it under the terms of the GNU "
    "General Public License as published by the Free Software Foundation, version 3 of the License",
    "Licensed under the terms of the Creative Commons Attribution ShareAlike 4.0 International License",
]


def test_templates_compile():
    for template in li.TEMPLATES:
        automaton = li.Automaton(template)
        assert sum(map(len, automaton.needs)) > 10 and automaton.mandatory > 1


@pytest.mark.parametrize("wording", ["[a b]", "a ]", "{a|b", "a | b"])
def test_templates_without_sense(wording):
    with pytest.raises(ValueError):
        li.Automaton(li.Template("x", wording))


def test_automaton_accepts_what_a_regular_expression_accepts():
    rnd = random.Random(3)
    for _ in range(300):
        wording = " ".join(
            rnd.choice(["a", "b", "a b", "[a]", "[b c]", "{a|b c}", "{0-2}", "{1-2}", "[{a|b} c]"])
            for _ in range(rnd.randint(1, 4))
        )
        wording = f"{rnd.choice('abc')} {wording} {rnd.choice('abc')}"
        automaton = li.Automaton(li.Template("x", wording))
        pattern = re.compile(_template_pattern(li.parse_template(wording)) + "(?= )")
        for _ in range(20):
            words = [rnd.choice("abcd") for _ in range(rnd.randint(0, 12))]
            line = " " + " ".join(words) + " "
            found = automaton.matches([w.encode() for w in words])
            assert bool(found) == bool(pattern.search(line)), (wording, words)
            for start, stop in found:
                assert pattern.match(" " + " ".join(words[start:stop]) + " ")


def test_whole_texts_by_template():
    mit = next(t for t in li.TEMPLATES if t.label == "mit" and "sublicense" in t.wording)
    text = mit.wording.replace("[including the next paragraph] ", "")
    text = text.replace("{noninfringement|non infringement}", "Noninfringement.")
    text = text.replace("{1-12}", "the authors or copyright holders")
    rules = li.LicenseRules()
    n, places = li.find_places(("x " * 50_000 + text + " y" * 50_000).encode(), rules)
    assert [(p["label"], p["start"]) for p in places] == [("mit", 50_000)] and n > 100_000
    assert li.find_places(text.replace("sublicense", "rent").encode(), rules)[1] == []


def test_odd_tables(spark):
    rows = [(i // 2, t, "x") for i, t in enumerate(TEXTS + TEXTS)] + [(None, TEXTS[3], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = li.summarise_licenses(li.find_licenses(docs)).collect()
    assert len(found) == len(rows)
    by_text = {}
    for row in found:
        if row.doc_id is not None:
            by_text.setdefault((row.n_words, row.n_base, row.first_word, row.last_word, row.labels, row.score), 0)
    assert (0, 0, None, None, "", 0.0) in by_text
    assert (13, 2, 1, 9, "mit", 4 / 13) in by_text
    assert (9, 3, 0, 6, "cc-by-nc", 3 / 9) in by_text
    labels = sorted(key[4] for key in by_text)
    assert labels == ["", "", "cc-by-nc", "cc-by-sa", "gpl-3", "mit"]
    assert next(r for r in found if r.doc_id is None).n_base == 2
    empty = li.find_licenses(docs.where("doc_id < 0"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_words", "places"]
    strings = docs.withColumn("doc_id", docs.doc_id.cast("string"))
    assert li.find_licenses(strings).count() == len(rows)
