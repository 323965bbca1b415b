from __future__ import annotations

import itertools
import math
import random
import time

import numpy as np
import pyarrow as pa

from aislewise.llm import tokens
from aislewise.llm.common import hashed_sample, read_table
from aislewise.llm.decontaminate import LeakRule, drop_leaks, find_leaks
from aislewise.llm.gru_lm import GruSettings, log_likelihoods, new_gru, score_documents, score_texts, _gradients, _step
from aislewise.llm.gru_lm import _add_by_token, _next_states, _softmax
from aislewise.llm.html_extract import extract_text, main_text, parse
from aislewise.llm.language_id import identify_languages, train_languages
from aislewise.llm.ngram_join import JoinRule, component_of_documents, drop_near_duplicates
from aislewise.llm.sentencepiece_wfst import MODEL, encode_documents, load_transducer
from aislewise.llm.toxicity import Subsequences, ToxicitySettings, score_toxicity, train_toxicity, windows

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (2, ""), (None, "Some words. And more of them here."), (4, "#!? 123 \n\t")]


def odd(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ODD], "doc_id long, text string, score string")


def test_word_hashes_see_words_not_places():
    data, begins = tokens.packed(pa.array(["Ab cd", None, "ab  CD ab"]))
    starts, ends, first = tokens.words(data, begins)
    h = tokens.word_hashes(data, starts, ends)
    assert first.tolist() == [0, 2, 2, 5] and h[0] == h[2] == h[4] and h[1] == h[3] != h[0]
    index = tokens.HashIndex(h[:2])
    assert index.find(np.append(h, np.uint64(9))).tolist() == [0, 1, 0, 1, 0, -1]


def test_near_duplicates_by_brute_force(spark):
    rnd = random.Random(5)
    base = [[rnd.choice("abcdefghijklmnopqrst") * 2 for _ in range(rnd.randint(1, 60))] for _ in range(30)]
    texts = []
    for b in base:
        for _ in range(4):
            w = list(b)
            for _ in range(rnd.randint(0, 2)):
                w[rnd.randrange(len(w))] = rnd.choice("uvw")
            texts.append(" ".join(w))
    texts += [None, "", "  ", texts[0]]
    rows = [(len(texts) - i, t) for i, t in enumerate(texts)] + [(7, texts[-8])]

    def grams(t):
        w = (t or "").split()
        return {tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))} if w else set()

    sets = [grams(t) for _, t in rows]
    group = list(range(len(rows)))
    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            old, new = group[i], group[j]
            group = [new if g == old else g for g in group]
    least = {g: min(r[0] for r, h in zip(rows, group) if h == g) for g in group}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = component_of_documents(docs, JoinRule(3, 80)).collect()
    want = sorted((r[0], len(s), least[g]) for r, s, g in zip(rows, sets, group))
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    kept = drop_near_duplicates(docs.selectExpr("*", "1 as id", "2 as name"), JoinRule(3, 80))
    assert kept.columns == ["doc_id", "text", "id", "name"]
    bare = sum(not s for s in sets)
    assert kept.count() == len({g for g, s in zip(group, sets) if s}) + bare
    assert component_of_documents(odd(spark)).count() == 5
    assert component_of_documents(docs.limit(0)).count() == 0


def test_leaks_are_found_and_clean_documents_left(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choices("abcdefgh", k=5))
    items = [(k, " ".join(word() for _ in range(20 + k))) for k in range(10)] + [(50, None), (51, "")]
    docs = [(k, " ".join(word() for _ in range(80))) for k in range(40)]
    for k in range(10):
        w = items[k][1].split()
        if k % 2:
            w[0] = "other"
        docs.append((100 + k, f"{docs[k][1]} {' '.join(w).upper()}, {docs[k + 1][1]}"))
    docs = spark.createDataFrame(docs + ODD, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = find_leaks(docs, bench, LeakRule(pass_bytes=600))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(100 + k, k) for k in range(10)}
    assert drop_leaks(docs, bench).count() == 45
    assert find_leaks(docs, bench.limit(0)).count() == 0


def test_languages(spark):
    docs = read_table(spark, SF, "documents")
    model = train_languages(docs)
    rows = identify_languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    strange = identify_languages(odd(spark), model).collect()
    assert [r.lang_pred == "und" for r in strange] == [True, True, True, False, True]
    assert train_languages(docs.limit(0)) is None


def test_copies_leave_the_sample_its_distinct_rows(spark):
    copies = spark.range(200_000).selectExpr("'uno dos' as text", "'es' as lang")
    others = spark.range(1000).selectExpr("concat('tres ', id) as text", "'es' as lang")
    few = spark.createDataFrame([("one", "en"), (None, None)], "text string, lang string")
    rows = hashed_sample(copies.union(others).union(few), 400, ["text"], ["lang"]).collect()
    assert 300 < sum(r.lang == "es" for r in rows) < 500 and len(rows) == len(set(rows))
    assert {r.lang for r in rows} == {"es", "en", None}
    assert hashed_sample(others.select("text"), 1, ["text"]).count() >= 1
    assert hashed_sample(others.limit(0), 5, ["text"], ["lang"]).count() == 0


def test_subsequence_kernel_by_brute_force():
    s = ToxicitySettings()
    strings = ["idiot", "idixot", "banana", "toidi"]

    def features(t):
        out = {}
        for at in itertools.combinations(range(len(t)), s.length):
            key = "".join(t[i] for i in at)
            out[key] = out.get(key, 0) + s.decay ** (at[-1] - at[0] + 1)
        return out

    f = [features(t) for t in strings]
    dot = lambda a, b: sum(v * b.get(k, 0) for k, v in a.items())
    want = [[dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) for b in f[:2]] for a in f]
    got = Subsequences(("idiot", "idixot"), s).apply(strings, np.eye(2))
    assert np.allclose(got, want, atol=1e-5)
    assert windows("You i.d.i.o.t, a b c!") == ["you", "idiot", "abc"]


def test_toxicity(spark):
    docs = read_table(spark, SF, "documents")
    model = train_toxicity(docs, read_table(spark, SF, "labels"))
    rows = score_toxicity(odd(spark), model).collect()
    assert len(rows) == 5 and all(0 <= r.score < 0.5 for r in rows)
    assert train_toxicity(docs, read_table(spark, SF, "labels").limit(0)) is None


def test_tokens_are_those_of_the_library(spark):
    import sentencepiece

    machine, other = load_transducer(), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    docs = read_table(spark, SF, "documents")
    for r in encode_documents(docs, machine).join(docs.select("doc_id", "text"), "doc_id").collect():
        assert r.round_trip and r.token_ids == other.encode(r.text)
    rnd = random.Random(1)
    parts = ["a", "the", " ", "   ", "\n", "é", "梦", "😀", "\x00", "12", "!!", "tion"]
    for _ in range(2000):
        text = "".join(rnd.choices(parts, k=rnd.randint(0, 12)))
        assert machine.encode(text) == other.encode(text) and machine.decode(machine.encode(text)) == text
    assert [r.n_tokens for r in encode_documents(odd(spark), machine).collect()][:3] == [0, 0, 0]


def test_gru_is_a_distribution_and_state_carries():
    s = GruSettings(classes=4, hidden=6)
    gru = new_gru(11, s)
    states = np.random.default_rng(0).normal(size=(1, 6)).astype(np.float32)
    every = [math.exp(log_likelihoods(gru, states, np.array([k]))[0]) for k in range(11)]
    assert abs(sum(every) - 1) < 1e-5
    text = np.array([3, 7, 7, 1, 10, 2, 0])
    h, read, want = np.zeros((1, 6), np.float32), 0, 0.0
    for token in text:
        h = _step(gru, np.array([read]), h)[0]
        want += log_likelihoods(gru, h, np.array([token]))[0]
        read = token
    got = score_texts(gru, [text[:3], text, text[:1]], window=2)
    assert abs(got[1] - want) < 1e-4


def test_lm_base_score_by_brute_force(spark):
    rows = [(1, "A b b"), (2, "b c"), (3, None), (4, "zz b"), (4, "zz b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    train = docs.where("doc_id < 4")
    found = score_documents(docs, train, GruSettings(head=1, words=1, streams=2, sample=100))
    counts = {"a": 1, "b": 3, "c": 1, "END": 3}
    scale = 8 + 0.5 * 5
    for r in found.collect():
        words = (dict(rows)[r.doc_id] or "").lower().split() + ["END"]
        want = sum(math.log10((counts.get(w, 0) + 0.5) / scale) for w in words)
        assert abs(r.base_score - want) < 1e-9 and r.n_tokens == len(words)
        assert r.n_known == sum(w in counts for w in words) and r.train_tokens == 8
        assert math.isfinite(r.score) and r.score < 0
    assert score_documents(docs, train.limit(0), GruSettings(sample=10)).count() == 5


def test_html_keeps_the_article(spark):
    page = (
        "<body><header><h1>Site</h1></header><nav>a</nav><main><header><h1>T &amp; x</h1><p>by me</header>"
        "<p>One<br>two <i>t</i>hree<ul><li>A<li>B</ul><div class='ad-box'>buy</div><form>x</form>"
        "<section id=comments><p>nice</section><script>'</p>'</script></main><aside>s</aside>tail"
    )
    assert main_text(parse(page), frozenset()) == "T & x\nOne two three\nA\nB"
    repeated = [(k, f"http://h/{k}", f"<div><p>same words</p></div><span>new {k}</span>") for k in range(8)]
    pages = repeated + [(90, None, None), (91, "http://h/9", ""), (92, "x", "<p>only <b>one")]
    found = extract_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    rows = {r.page_id: (r.text, r.n_chars) for r in found.collect()}
    assert rows[3] == ("new 3", 5) and rows[90] == rows[91] == ("", 0) and rows[92] == ("only one", 8)


def test_html_tree_decides_inside_articles_too(spark):
    page = "<article><p>Story {0} {0}.</p><div class=x{0}><p>Read our terms.</p></div></article><div><p>{1}</div>"
    pages = [(k, f"http://h/{k}", page.format(k, "etc")) for k in range(20)]
    same = "<article><p>all the same</article><p>{}"
    pages += [(50 + k, f"http://i/{k}", same.format(k)) for k in range(40)]
    pages += [(100, "http://i/x", "<article><p>its own text</article>")]
    pages += [(200 + k, f"http://j/{k}", f"<article>card</article><div>The body, text {k}.</div>") for k in range(9)]
    box = "<article><p>Story {0}.</p><div><p>Read our terms.</p></div></article>"
    pages += [(300 + k, f"http://k/{k}", box.format(k)) for k in range(20)]
    menu = "<div><ul><li>Menu</ul><p>Tips</div>"
    pages += [(400 + k, f"http://l/{k}", f"<article>{menu}<p>News {k}</article>") for k in range(20)]
    found = extract_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    text = {r.page_id: r.text for r in found.collect()}
    assert all(text[300 + k] == f"Story {k}." and text[400 + k] == f"News {k}" for k in range(20))
    assert text[3].startswith("Story 3 3.") and "etc" not in text[3]
    # Stated content that all pages of a site share stays, and so does a page's own.
    assert text[60] == "all the same" and text[100] == "its own text"
    # The card is on all pages, the body is not.
    assert all(text[200 + k] == f"The body, text {k}." for k in range(9))
    assert main_text(parse("<article>card</article><div>a longer body"), frozenset()) == "card\na longer body"


def test_class_words_of_wrappers_leave_the_article(spark):
    text = lambda source: main_text(parse(source), frozenset())
    assert text("<div class='layout has-sidebar'><article><p>A<p>B</article></div>") == "A\nB"
    assert text("<main class='no-comments'><h1>T</h1><p>A</main>") == "T\nA"
    assert text("<div id='page-menu-left'><article class='post share-enabled'>A</article></div>") == "A"
    assert text("<article>post</article><section id=comments><article class=comment>no</article></section>") == "post"
    assert text("<article>post <span class=share>no</span><div class=ad>no ad</div></article>") == "post"
    assert text("<div class=ad>buy</div><p>the text") == "the text"
    # Without article, what varies over the host's pages overrules the word; what is repeated does not.
    page = "<div class='layout has-sidebar'><p>Long story of page {0}.</p><div><i>Same.</i></div></div><p>T {0}"
    pages = [(k, f"http://h/{k}", page.format(k)) for k in range(20)]
    found = extract_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == {
        k: f"Long story of page {k}.\nT {k}" for k in range(20)
    }


def test_lm_learns_from_all_texts(spark):
    # The start's sample is a stretch of one text; most word pairs are met outside it.
    rnd = random.Random(4)
    rows = []
    for k in range(300):
        cycle = [f"w{k % 10}x{i}" for i in range(5)]
        at = rnd.randrange(5)
        rows.append((k, " ".join(cycle[(at + i) % 5] for i in range(700))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    s = GruSettings(sample=100, stretch=50, rate=0.2)
    for r in score_documents(docs.limit(40), docs, s).collect():
        assert r.score > 0.6 * r.base_score


def test_gru_turned_arrays_round_as_rows_do():
    rnd = np.random.default_rng(3)
    for columns in (1, 5, 8, 40, 77):
        x = rnd.normal(0, 3, (2300, columns)).astype(np.float32)
        e = np.exp(x - x.max(-1, keepdims=True))
        _softmax(x)
        assert np.array_equal(x, e / e.sum(-1, keepdims=True))
    for size in (1, 50, 900, 6000):
        token, rows = rnd.zipf(1.3, size) % 700, rnd.normal(size=(size, 9)).astype(np.float32)
        got = np.zeros((700, 9), np.float32)
        _add_by_token(got, token, rows)
        order = np.argsort(token, kind="stable")
        found, first = np.unique(token[order], return_index=True)
        want = np.zeros_like(got)
        want[found] += np.add.reduceat(rows[order], first)
        assert np.array_equal(got, want)
    gru = new_gru(700, GruSettings())
    token, h = rnd.integers(0, 700, 2300), rnd.normal(0, 0.5, (2300, 24)).astype(np.float32)
    assert np.array_equal(_next_states(gru, token, h), _step(gru, token, h)[0])


def test_words_by_brute_force():
    texts = [None, "", "A bc", " x\t", "\n", "caf\u00e9 b\u00fc.", "z"]
    data, begins = tokens.packed(pa.array(texts, pa.string()))
    starts, ends, first = tokens.words(data, begins)
    found = [bytes(data[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in (t or "").split()]
    assert np.diff(first).tolist() == [len((t or "").split()) for t in texts]


def test_gru_outputs_cost_less_than_row_by_row():
    s = GruSettings()
    rnd = np.random.default_rng(5)
    gru = new_gru(1565, s)
    states = rnd.normal(0, 0.5, (40_000, s.hidden)).astype(np.float32)
    targets = rnd.zipf(1.2, 40_000) % 1565

    def log_softmax(x):
        x = x - x.max(-1, keepdims=True)
        return x - np.log(np.exp(x).sum(-1, keepdims=True))

    def plain():
        classes = targets // gru.per_class
        out = log_softmax(states @ gru.to_class + gru.class_bias)[np.arange(len(targets)), classes]
        for c in np.unique(classes):
            rows = np.flatnonzero(classes == c)
            within = log_softmax(states[rows] @ gru.to_word[c] + gru.word_bias[c])
            out[rows] += within[np.arange(len(rows)), targets[rows] - c * gru.per_class]
        return out

    def seconds(f):
        at = time.process_time()
        f()
        return time.process_time() - at

    new = lambda: log_likelihoods(gru, states, targets)
    assert np.array_equal(new(), plain())
    pairs = [(seconds(new), seconds(plain)) for _ in range(9)]
    assert min(a for a, _ in pairs) < 0.85 * min(b for _, b in pairs)


def test_gru_gradients_by_differences():
    s = GruSettings(classes=3, hidden=4)
    rnd = np.random.default_rng(0)
    read, target = rnd.integers(0, 8, (2, 5, 6))
    h = np.zeros((5, 4), np.float32)

    def loss(gru):
        state, total = h, 0.0
        for t in range(read.shape[1]):
            state = _step(gru, read[:, t], state * (read[:, t] != 0)[:, None])[0]
            total -= log_likelihoods(gru, state, target[:, t]).sum()
        return total / target.size

    gru = new_gru(8, s)
    for k, v in vars(gru).items():
        vars(gru)[k] = v.astype(np.float64)
    _, grads = _gradients(gru, read, target, h)
    for k, g in grads.items():
        v = vars(gru)[k].reshape(-1)
        for at in rnd.choice(v.size, min(v.size, 8), replace=False):
            if v[at] < -1e8:
                continue
            v[at] += 1e-5
            up = loss(gru)
            v[at] -= 2e-5
            down = loss(gru)
            v[at] += 1e-5
            assert abs((up - down) / 2e-5 - g.reshape(-1)[at]) < 1e-4
