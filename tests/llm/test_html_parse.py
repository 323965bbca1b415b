from __future__ import annotations

import time

import pytest

from aislewise.llm.html_extract import parse

HARD = {
    "quotes without an end": '<a b="' * 20001,
    "tags without an end": "<a " * 60000,
    "the same before a tag": '<a b="' * 20001 + ">" + "<a '" * 20000,
    "deep and wrongly closed": "<font>" * 15000 + "<section>" * 15000 + "</x>" * 15000 + "</font>" * 20000,
    "paragraph far above": "<p>" + "<font>" * 15000 + "<section>" + "<font>" * 100 + "<div>" * 15000,
    "comment without an end": "<!-- >" * 20000,
}


@pytest.mark.parametrize("kind", HARD)
def test_time_grows_with_the_page(kind):
    begin = time.process_time()
    parse(HARD[kind])
    assert time.process_time() - begin < 5


def blocks(source):
    return [text for *_, text in parse(source).blocks]


def test_what_has_no_end_runs_to_the_end():
    assert blocks("one <b>two</b> <!-- three <p>four") == ["one two"]
    assert blocks("one <![CDATA[ 2 < 3 > 1") == ["one 2 < 3 > 1"]
    assert blocks("one <?php two") == ["one"]
    assert blocks("a > b <x y") == ["a > b <x y"]
    assert blocks("<p>a <!-- b > c --> d") == ["a d"]
    assert blocks("<p>a<p>b<ul><li>c<li>d</ul>e</p>f") == ["a", "b", "c", "d", "ef"]
