"""The corpus pipeline against plain Python on a small corpus with planted cases."""

from __future__ import annotations

import itertools
import random
import re

import pytest
import sentencepiece

import corpus_pipeline as cp
from aislewise.llm.common import read_table, stage
from aislewise.llm.sentencepiece_wfst import MODEL

SF = "/root/testdata/sf0.001"
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    """A folder of tables, and the ids of what was planted."""
    folder = str(tmp_path_factory.mktemp("corpus"))
    base = [tuple(r) for r in read_table(spark, SF, "documents").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    items = [r.text for r in read_table(spark, SF, "benchmark").orderBy("item_id").collect()]
    rnd = random.Random(8)
    plain = [r for r in base if r[1] and 80 < len(r[1].split()) < 2000][:20]
    planted = {"copy": [], "near": [], "leak": [], "strange": [], "other": []}

    def plant(kind, text, like):
        k = 100_000 + len(rows)
        rows.append((k, text, like[2], like[3], len(text or "")))
        planted[kind].append((k, like[0]))

    rows = list(base)
    for r in plain[:5]:
        plant("copy", r[1], r)
        words = r[1].split(" ")
        words[len(words) // 2] = "zyx"
        plant("near", " ".join(words), r)
    for r, item in zip(plain[5:10], items):
        words = r[1].split(" ")
        plant("leak", " ".join([*words[:40], item, *words[40:]]), r)
    for text in (None, "", "12 34 !! 5", "?" * 300):
        plant("strange", text, plain[0])
    for r in plain[10:14]:
        words = r[1].split(" ")
        rnd.shuffle(words)
        plant("other", " ".join(words), r)
    spark.createDataFrame(rows, SHAPE).repartition(3).write.parquet(f"{folder}/documents.parquet")
    for name in ("benchmark", "labels"):
        read_table(spark, SF, name).write.parquet(f"{folder}/{name}.parquet")
    return folder, planted, items


@pytest.fixture(scope="module")
def steps(spark, corpus):
    """What went into each stage and what came out of it."""
    docs = read_table(spark, corpus[0], "documents")
    found = {}
    for name, step in cp.STAGES:
        out = stage(step(spark, docs, corpus[0]), name)
        found[name] = docs, out
        docs = out
    return found


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_and_the_rows_they_pass_on(steps):
    for name, (before, after) in list(steps.items())[:-1]:
        assert after.schema.simpleString() == before.schema.simpleString(), name
        assert set(rows_of(after)) <= set(rows_of(before)), name


def test_language_rejects_what_is_none(steps, corpus):
    before, after = steps["language"]
    gone = ids(before) - ids(after)
    assert {k for k, _ in corpus[1]["strange"]} <= gone
    letters = {r.doc_id for r in before.collect() if r.text and len(re.findall(r"[^\W\d_]{2,}", r.text)) > 20}
    assert len(letters & gone) <= 0.03 * len(letters)


def test_toxicity_rejects_labelled_ones(spark, steps, corpus):
    before, after = steps["toxicity"]
    labels = {r.doc_id: r.toxic for r in read_table(spark, corpus[0], "labels").collect()}
    gone, here = ids(before) - ids(after), ids(before)
    toxic = {k for k, t in labels.items() if t == 1 and k in here}
    clean = {k for k, t in labels.items() if t == 0 and k in here}
    assert len(toxic & gone) >= 0.8 * len(toxic)
    assert len(clean & gone) <= 0.05 * len(clean)


def test_one_row_of_each_group_stays(steps):
    before, after = steps["near_duplicates"]
    rows = before.collect()

    def grams(text):
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()

    sets = [grams(r.text) for r in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    kept = {min(r.doc_id for r, h in zip(rows, group) if h == g) for g in set(group)}
    assert ids(after) == kept and after.count() == len(kept)


def test_leaks_go_and_documents_without_a_passage_stay(steps, corpus):
    before, after = steps["decontamination"]
    gone = ids(before) - ids(after)
    assert {k for k, _ in corpus[1]["leak"]} & ids(before) <= gone

    def runs(text):
        words = re.findall(r"[^\W_]+", text.lower())
        return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}

    passages = set().union(*[runs(item) for item in corpus[2]])
    free = {r.doc_id for r in before.collect() if not runs(r.text or "") & passages}
    assert not free & gone
    # What goes shares most of an item, word for word.
    for r in before.collect():
        if r.doc_id in gone:
            assert any(len(runs(i) & runs(r.text)) >= 0.5 * len(runs(i)) for i in corpus[2] if runs(i))


def test_tokens_are_those_of_the_library(steps):
    before, after = steps["tokens"]
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = sorted((r.doc_id, model.encode(r.text)) for r in before.collect())
    assert sorted((r.doc_id, list(r.token_ids)) for r in after.collect()) == want


def test_run_is_the_stages_one_after_another(spark, steps, corpus):
    whole = cp.run(spark, corpus[0])
    assert rows_of(whole) == rows_of(steps["tokens"][1])
