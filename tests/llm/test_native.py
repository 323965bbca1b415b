from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from aislewise.llm import oracle, queries
from aislewise.llm.quality_rules import clean_lines
from aislewise.llm.sharding import assign_shards
from aislewise.llm.url_rules import UrlRule, judge_urls
from tests.compare import assert_same, duck_result

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, n_words string, shard string, lang string"
ODD = [(1, None, "x", "y", "en"), (2, "", "x", "y", None), (2, "", "x", "y", None),
       (None, "a b c d e f g h i j k.", "x", "y", "en"), (5, "w " * 30000, "x", "y", "en")]


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_same_as_sql(spark, name):
    assert_same(queries.QUERIES[name](spark, SF), duck_result(SF, oracle.SQL[name]))


def test_odd_documents_are_counted(spark):
    rows = {r.doc_id: r for r in clean_lines(spark.createDataFrame(ODD, DOCS)).collect()}
    assert rows[1].n_words == rows[2].n_words == 0 and not rows[1].kept
    assert rows[None].kept and rows[None].clean_text == "a b c d e f g h i j k."
    assert rows[5].n_repeat_words == 30000 and rows[5].base_failed
    assert clean_lines(spark.createDataFrame([], DOCS)).count() == 0


def test_repeated_words_by_brute_force(spark):
    rnd = random.Random(3)
    texts = [(i, " ".join(rnd.choice("abc") for _ in range(rnd.randint(0, 60)))) for i in range(60)]
    for r in clean_lines(spark.createDataFrame(texts, "doc_id long, text string")).collect():
        w = texts[r.doc_id][1].split()
        grams = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        hit = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
        assert r.n_repeat_words == len(hit)


def test_shards_fill_slots_and_grow_into_the_new_one(spark):
    docs = spark.createDataFrame([(i % 700, "t") for i in range(2000)] + [r[:2] for r in ODD], "doc_id long, text string")
    rows = assign_shards(docs.repartition(5)).collect()
    assert len(rows) == 2005 and {r.shard for r in rows} <= set(range(16))
    for shard in {r.shard for r in rows}:
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 16) for r in rows) and any(r.grown_shard == 16 for r in rows)
    assert len({(r.doc_id, r.shard) for r in rows}) == len({r.doc_id for r in rows})
    assert assign_shards(docs.limit(0)).count() == 0


def test_urls_by_given_and_mined_rules(spark):
    bad = [(i, f"https://casino.site{i % 7}.example.net/win/{i}") for i in range(60)]
    good = [(100 + i, f"https://news.site{i % 7}.example.net/day/{i}") for i in range(200)]
    odd = [(900, None), (901, "no host"), (902, "HTTP://A.Example.ORG/en/12?x"), (902, "HTTP://A.Example.ORG/en/12?x")]
    pages = spark.createDataFrame(bad + good + odd, "page_id long, url string")
    pages = pages.withColumn("tokens", F.lit(1)).withColumn("host", F.lit("clash"))
    labels = spark.createDataFrame(
        [(i, int(i >= 100)) for i, _ in bad[:40] + good], "doc_id long, quality int"
    )
    rules = [UrlRule("allow", "org", "/"), UrlRule("block", "example.org", "/en/1")]
    rows = {r.page_id: r for r in judge_urls(pages, labels, rules).collect()}
    assert all(rows[i].verdict == "block" for i, _ in bad)
    assert all(rows[i].verdict == "allow" for i, _ in good)
    assert (rows[900].host, rows[901].path, rows[900].rule) == ("", "", None)
    assert (rows[902].host, rows[902].rule, rows[902].verdict) == ("a.example.org", "example.org/en/1", "block")
    none = judge_urls(pages, labels.limit(0), rules)
    assert none.count() == 264 and none.where("verdict = 'block'").count() == 2


def test_urls_that_only_four_tokens_tell_apart(spark):
    paths = {"a/b/c": "shop", "a/b/x": "shop", "a/x/c": "shop", "x/b/c": "shop", "a/b/c/": "news"}
    bad = [(k, f"http://shop.net/a/b/c?k={k}") for k in range(30)]
    good = [(100 * j + k, f"http://{host}.net/{p}?k={k}") for j, (p, host) in enumerate(paths.items(), 1)
            if j > 1 for k in range(30)]
    pages = spark.createDataFrame(bad + good, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in bad + good], "doc_id long, quality int")
    for r in judge_urls(pages, labels, []).collect():
        assert r.verdict == ("block" if r.page_id < 100 else "allow")
