from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from aislewise.llm import divergence as dv


def plain(rows, min_docs=3, ranks=200):
    """The contract by plain loops."""
    groups, docs = defaultdict(Counter), defaultdict(Counter)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = []
    for (lang, source), counts in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        others = {s: c for (x, s), c in groups.items() if x == lang}
        whole = sum(others.values(), Counter())

        def p(c):
            total = sum(c[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (c[t] + 1) // total for t in kept}

        def f(a, b):
            return (a - b) ** 2 // b

        mine = p(counts)
        pairs = []
        for other, c in others.items():
            if other != source:
                theirs = p(c)
                pairs.append((sum(f(mine[t], theirs[t]) for t in kept), other))
        base = p(whole)
        terms = [(f(mine[t], base[t]), t) for t in kept if counts[t] > 0 and mine[t] > base[t]]
        for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, k + 1) for k, (value, item) in enumerate(ranked)]
    return sorted(out)


def sample(seed, n=60):
    rnd = random.Random(seed)
    words = ["a", "Bb", "é", "zz-zz", "東京", "abcdefgh", "abcdefghi", "abcdefghijklmnop", "abcdefghijklmnopq",
             "abcdefghijklmnopr" * 3, "x1y", "ÀÉ", "kK", "\n", "_"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [
        (rnd.choice(["en", "de", None, ""]), rnd.choice(["s1", "s2", "ß", None, "Z"]),
         rnd.choice([None, "", " 12 ", " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 60)))]))
        for _ in range(n)
    ]
    return rows + [("xx", "alone", "seldom words"), ("yy", "one", None), ("yy", "two", "!")] + rows[:5]


@pytest.mark.parametrize("rule", [dv.AuditRule(), dv.AuditRule(ranks=3), dv.AuditRule(digest_bits=3), dv.AuditRule(min_docs=1)])
def test_by_plain_loops(spark, rule):
    rows = sample(7)
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "lang string, source string, text string, gid long, term string")
    found = dv.audit_sources(docs.repartition(3), rule)
    assert sorted(map(tuple, found.collect())) == plain(rows, rule.min_docs, rule.ranks)


def test_long_texts_are_counted_whole(spark, monkeypatch):
    text = " ".join(random.Random(1).choices(["ab", "cd", "é" * 30, "Xy"], k=400)).encode()
    monkeypatch.setattr(dv, "GATHER", 50)
    batches = list(dv._count_long(5, text, 0, dv._Told()))
    counts = [b for b in batches if len(b) and b.column("kind")[0].as_py() == "count"]
    names = {}
    for b in batches:
        if len(b) and b.column("kind")[0].as_py() == "term":
            names |= dict(zip(b.column("digest").to_pylist(), b.column("term").to_pylist()))
    [whole] = counts
    got = {names[d].decode(): n for d, n in zip(whole.column("digest").to_pylist(), whole.column("n").to_pylist())}
    assert got == Counter(w.lower() for w in text.decode().split())
    assert set(whole.column("docs").to_pylist()) == {1}


def test_terms_are_told_once_unless_they_share_a_digest():
    told = dv._Told()
    for shift, repeats in ((0, 0), (63, None)):
        for k in range(2):
            _, found = dv._terms([b"one two three four seventeenletterss seventeenletterst", b"two"], shift)
            order = np.argsort(found.digest, kind="stable")
            rows = told.terms(found, order, dv._changes(found.digest[order]))
            if k and repeats is not None:
                assert len(rows) == repeats
        told = dv._Told()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "lang string, source string, text string")
    assert dv.audit_sources(docs).collect() == []
