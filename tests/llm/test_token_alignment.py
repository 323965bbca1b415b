from __future__ import annotations

import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from aislewise.llm import token_alignment as ta
from aislewise.llm.queries import BYTE_BPE
from aislewise.llm.sentencepiece_wfst import MODEL

SETTINGS = ta.AlignmentSettings(BYTE_BPE, MODEL)
ODD = [
    None, "", " ", "a", "  two  spaces ", "\n", "a\n b \nc\n\n d", "tab\t x", "don't I'LL we've", "naïve café 東京 語 🙂 b",
    "<|endoftext|> <s> </s> <unk>", "a▁b", "it ▁ x", "x" * 500, "7 777 7777.5", "　wide   space ", "a\x1cb \x1c c", "é" * 40,
    "\x00 a\x00b", "\ufeffword \u200b x", "a\u2028 b \u2029c", "\u00a0a \u00a0 b", "x \u0301e", "\r\n a\r b", "a\x85 b",
]


@pytest.fixture(scope="module")
def pair():
    return ta.TokenPair(Path(BYTE_BPE).read_bytes(), Path(MODEL).read_bytes())


def plain(texts):
    """The contract by plain loops over whole texts."""
    a = Tokenizer.from_file(BYTE_BPE)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    letters = ta._byte_letters()

    def spell_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    found = []
    counts = Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        spelled = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a], [spell_b(i) for i in ids_b]
        if not text or any(b"".join(s) != (" " + text).encode() for s in spelled):
            found.append(None)
            continue
        spans = []
        for ids, sizes in zip((ids_a, ids_b), spelled):
            end = 0
            spans.append([])
            for i, x in zip(ids, sizes):
                spans[-1].append((end, end + len(x), i))
                end += len(x)
        common = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for high in common:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low <= s and e <= high) for side in spans))
            low = high
        links = [(x[2], y[2]) for x in spans[0] for y in spans[1] if x[0] < y[1] and y[0] < x[1]]
        counts.update(links)
        found.append((len(ids_a), len(ids_b), len(groups), links, ";".join(groups)))
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(n, best.get(y, 0))
    rows = []
    for f in found:
        if f is None:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n_groups, links, text = f
        n_best = sum(counts[link] == best[link[1]] for link in links)
        sums = sum(counts[link] for link in links)
        rows.append((n_a, n_b, n_groups, len(links), n_best, sums, hashlib.sha256(text.encode()).hexdigest()))
    return rows


def random_texts(n, seed):
    rnd = random.Random(seed)
    words = ["alpha", "Beta,", "don't", "東京都", "x1", "\n", "\t", "", "naïve", "unbelievable", "🙂🙂", "qzxj", "der", "größer."]
    return [" ".join(rnd.choice(words) for _ in range(rnd.randint(1, 300))) for _ in range(n)]


def test_units_give_what_whole_texts_give(pair):
    texts = [t for t in ODD if t] + random_texts(40, 1)
    assert pair.words
    for text, (a, b, ok) in zip(texts, pair.encode(texts)):
        assert ok == ("▁" not in text)
        if not ok:
            continue
        assert a.tolist() == pair.a.encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == pair.b.encode(text)


def test_any_bracketing_of_any_ranges_gives_the_whole(pair):
    rnd = random.Random(2)
    for text in [t for t in ODD if t and "▁" not in t] + random_texts(12, 3):
        [(a, b, ok)] = pair.encode([text])
        assert ok
        size = len(text.encode()) + 1
        [[whole]] = pair.fragments(a, b, [size], [True], size)
        for width in (1, 2, 3, 7, 50):
            [parts] = pair.fragments(a, b, [size], [True], width)
            while len(parts) > 1:
                k = rnd.randrange(len(parts) - 1)
                parts[k : k + 2] = [ta.compose(parts[k], parts[k + 1], pair)]
            closed = [p for _, p in parts[0].closed]
            assert not len(parts[0].prefix.a) and not len(parts[0].suffix.a)
            assert b";".join(p.rendered for p in closed) == whole.closed[0][1].rendered
            assert np.concatenate([p.pairs for p in closed]).tolist() == whole.closed[0][1].pairs.tolist()
            assert sum(p.n_groups for p in closed) == whole.closed[0][1].n_groups


@pytest.mark.parametrize("most", [1, 1 << 16, (1 << 16) + 1, 1 << 31])
def test_packed_numbers(most):
    for n in (0, 1, 999):
        numbers = np.random.default_rng(n).integers(0, most, n)
        numbers[:1] = most - 1
        assert ta._unpack(ta._pack(numbers), n).tolist() == numbers.tolist()


def test_blocks_number_pairs():
    block = ta._Block()
    rnd = np.random.default_rng(4)
    seen = []
    for _ in range(20):
        pairs = rnd.integers(0, 60, rnd.integers(0, 90))
        numbers = block.add(pairs)
        assert ta._unpack(ta._pack(numbers), len(numbers)).tolist() == numbers.tolist()
        assert block.pairs()[numbers].tolist() == pairs.tolist()
        seen += pairs.tolist()
    assert dict(zip(block.pairs().tolist(), block.counts.tolist())) == Counter(seen)


@pytest.mark.parametrize(
    "settings",
    [
        SETTINGS,
        ta.AlignmentSettings(BYTE_BPE, MODEL, long_chars=60, range_bytes=9, slab_chars=100, block_chars=300, fan_in=2),
        ta.AlignmentSettings(BYTE_BPE, MODEL, long_chars=5, range_bytes=2, slab_chars=1, block_pairs=3, fan_in=3),
    ],
)
def test_by_plain_loops(spark, settings):
    texts = ODD + random_texts(14, 5) + ODD[3:6] + ["long " * 400 + "a▁b"]
    rows = [(None if k == 7 else k // 2, t, "x") for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_a string").repartition(3)
    found = ta.align_tokens(docs, settings)
    expected = [(rows[k][0], *row) for k, row in enumerate(plain(texts))]
    key = str
    assert sorted(map(tuple, found.collect()), key=key) == sorted(expected, key=key)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id string, text string")
    assert ta.align_tokens(docs, SETTINGS).collect() == []
