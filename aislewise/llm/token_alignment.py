"""Alignment of two tokenizers: groups of tokens that cover the same bytes, and links between them.

The tokens of a text are cut where a token of both ends. What lies in a range of bytes of a document is
a fragment: the tokens up to the first common end, the closed groups behind it, and the tokens after the last
one. Fragments compose: the open end of one and the open beginning of the next close to a group, or stay open where
there is no common end. That is associative, so the fragments of a range can be reduced in any bracketing:
those of one piece of text in its task, those of a very long document by a tree across tasks.

Passes: (1) texts of ordinary length are aligned in the task that reads them, very long ones are cut into
pieces; (2) the pieces, spread over the cluster, give fragments; (3) a tree of rounds closes what is open
between pieces; (4) how often each pair of ids is linked is counted over the corpus, from one list of
distinct pairs per block of text, and goes back to the blocks as numbers.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from tokenizers import Tokenizer

from aislewise.llm.common import bounded_batches, stage

SPACE = "▁"
#: Words whose tokens a worker keeps, and as many older ones.
STORE = 150_000
#: The tokens of a word that they don't spell.
BAD = (b"", b"")
#: Characters encoded in one call.
CALL = 1 << 15
# A space between two characters that are no white space: no token of either kind goes on over it.
CUT = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class AlignmentSettings:
    """The files of a byte-level tokenizer and of a SentencePiece model, and sizes.

    A text of more than `long_chars` is cut into pieces of about that many, at a space between words.
    `range_bytes` is the range of a leaf fragment. A slab of about `slab_chars` is aligned at once, and
    `block_chars` of text or `block_pairs` distinct pairs make one block of the counting.
    """

    byte_bpe: str
    piece_bpe: str
    long_chars: int = 1 << 15
    range_bytes: int = 1 << 13
    slab_chars: int = 1 << 19
    block_chars: int = 1 << 24
    block_pairs: int = 1 << 20
    fan_in: int = 16


class Run(NamedTuple):
    """Ids of both kinds that cover the same stretch, or its open part."""

    a: np.ndarray
    b: np.ndarray

    def then(self, other: Run) -> Run:
        return Run(np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]))


NOTHING = Run(np.zeros(0, np.int64), np.zeros(0, np.int64))


class Part(NamedTuple):
    """Closed groups one after another. `pairs` are linked ids, a in the upper half."""

    n_a: int
    n_b: int
    n_groups: int
    rendered: bytes
    pairs: np.ndarray


class Fragment(NamedTuple):
    """A range of a document. Without a common end, `closed` is None and `prefix` has all.

    `closed` has parts in order, each with the place where it belongs.
    """

    prefix: Run
    closed: tuple[tuple[tuple[int, int], Part], ...] | None
    suffix: Run
    #: Place of the range that holds the first common end.
    first: int


def compose(left: Fragment, right: Fragment, pair: TokenPair) -> Fragment:
    """The fragment of two neighbouring ranges."""
    if left.closed is None:
        whole = left.prefix.then(right.prefix)
        return right._replace(prefix=whole)
    if right.closed is None:
        return left._replace(suffix=left.suffix.then(right.prefix))
    joint = left.suffix.then(right.prefix)
    between = (((right.first, 0), pair.close(joint)),) if len(joint.a) else ()
    return Fragment(left.prefix, left.closed + between + right.closed, right.suffix, left.first)


class TokenPair:
    """Two tokenizers, the bytes of their tokens, and the alignment of what they give."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes) -> None:
        self.a = Tokenizer.from_str(byte_bpe.decode())
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        letters = _byte_letters()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.bytes_a = [b""] * size
        for text, i in self.a.get_vocab(with_added_tokens=False).items():
            self.bytes_a[i] = bytes(letters[c] for c in text)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(SPACE, " ").encode()
            for i, piece in enumerate(self._pieces())
        ]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.digits = _digits(max(len(self.bytes_a), len(self.bytes_b)))
        self.words = self._cut_safe(json.loads(byte_bpe))
        # A full store becomes the older one, from which words met again come back.
        self.store: dict[str, tuple[bytes, bytes]] = {}
        self.older: dict[str, tuple[bytes, bytes]] = {}
        self.odd: dict[str, tuple[bytes, bytes]] = {}

    def _pieces(self) -> list[str]:
        return [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]

    def _cut_safe(self, described: dict) -> bool:
        """Whether no token goes on over a space between words, by what the files say."""
        splitter = described.get("pre_tokenizer") or {}
        by_words = (
            splitter.get("type") == "ByteLevel"
            and splitter.get("use_regex", True)
            and not splitter.get("add_prefix_space")
            and described.get("normalizer") is None
        )
        plain = "A  b é ﬁ" == self.b.normalize("A  b é ﬁ").replace(SPACE, " ").removeprefix(" ")
        return by_words and plain and not any(SPACE in p.lstrip(SPACE) for p in self._pieces())

    def encode(self, texts: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray, bool]]:
        """Ids of both kinds of each text, and whether their bytes are those of a space and the text."""
        if not self.words:
            return [self._encode_whole(t) for t in texts]
        if len(self.store) > STORE:
            self.store, self.older = {}, self.store
        if len(self.odd) > STORE:
            self.odd.clear()
        units = [t.split(" ") for t in texts]
        fresh = set().union(*units).difference(self.store)
        again = fresh & self.older.keys()
        self.store.update((u, self.older[u]) for u in again)
        fresh -= again
        uncut = {u for u in fresh if not u or u[0].isspace() or u[-1].isspace()}
        self._learn(fresh - uncut)
        found = []
        for text, us in zip(texts, units):
            if uncut.isdisjoint(us):
                known = [self.store[u] for u in us]
            else:
                known = [self.store.get(u) or self._learn_odd(u) for u in CUT.split(text)]
            a = np.frombuffer(b"".join([k[0] for k in known]), np.int32).astype(np.int64)
            b = np.frombuffer(b"".join([k[1] for k in known]), np.int32).astype(np.int64)
            found.append((a, b, BAD not in known))
        return found

    def _encode_whole(self, text: str) -> tuple[np.ndarray, np.ndarray, bool]:
        a, b = self._ids(text)
        spelled = b" " + text.encode()
        return a.astype(np.int64), b.astype(np.int64), self._spelled(a, b) == (spelled, spelled)

    def _learn(self, units: set[str]) -> None:
        """Tokens of each unit into the store; units are encoded many at a time, joined by spaces."""
        batch: list[str] = []
        size = 0
        for unit in units:
            batch.append(unit)
            size += len(unit)
            if size > CALL:
                self._learn_joined(batch)
                batch, size = [], 0
        if batch:
            self._learn_joined(batch)

    def _learn_odd(self, unit: str) -> tuple[bytes, bytes]:
        """Tokens of a unit with white space at an end, or of two words that only stand together."""
        if unit not in self.odd:
            a, b, good = self._encode_whole(unit)
            self.odd[unit] = (a.astype(np.int32).tobytes(), b.astype(np.int32).tobytes()) if good else BAD
        return self.odd[unit]

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        a = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids
        return np.array(a, np.int32), np.array(self.b.encode(text), np.int32)

    def _spelled(self, a: np.ndarray, b: np.ndarray) -> tuple[bytes, bytes]:
        return (
            b"".join([self.bytes_a[i] for i in a.tolist()]),
            b"".join([self.bytes_b[i] for i in b.tolist()]),
        )

    def _learn_joined(self, units: list[str]) -> None:
        joined = " ".join(units)
        a, b = self._ids(joined)
        text = b" " + joined.encode()
        if self._spelled(a, b) != (text, text):
            if len(units) == 1:
                self.store[units[0]] = BAD
            else:
                self._learn_joined(units[: len(units) // 2])
                self._learn_joined(units[len(units) // 2 :])
            return
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        cuts_a = np.searchsorted(np.cumsum(self.len_a[a]), ends, "right").tolist()
        cuts_b = np.searchsorted(np.cumsum(self.len_b[b]), ends, "right").tolist()
        raw_a, raw_b = a.tobytes(), b.tobytes()
        from_a = from_b = 0
        for unit, to_a, to_b in zip(units, cuts_a, cuts_b):
            self.store[unit] = raw_a[4 * from_a : 4 * to_a], raw_b[4 * from_b : 4 * to_b]
            from_a, from_b = to_a, to_b

    def close(self, run: Run) -> Part:
        """The groups of a stretch that begins and ends at a common end."""
        size = int(self.len_a[run.a].sum())
        [[fragment]] = self.fragments(run.a, run.b, [size], [True], size)
        return fragment.closed[0][1]

    def fragments(
        self, a: np.ndarray, b: np.ndarray, sizes: Sequence[int], heads: Sequence[bool], range_bytes: int
    ) -> list[list[Fragment]]:
        """The fragments of each of several stretches, by ranges of `range_bytes`.

        `a` and `b` are the ids of all stretches one after another, `sizes` their bytes. Both kinds have
        tokens for all bytes. A stretch that is a head begins at a common end, that of the document before.
        A token belongs to the range in which it ends.
        """
        ends_a, ends_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        # Between two ends of any kind lies just one token of each kind, and another two than elsewhere.
        # Stable sorting merges the two sorted halves in one go; ends of both kinds are there twice.
        ends = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
        twice = np.flatnonzero(ends[1:] == ends[:-1])
        common = ends[twice]
        ends = np.delete(ends, twice)
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        upto_a = np.searchsorted(ends_a, common, "right")
        upto_b = np.searchsorted(ends_b, common, "right")
        before_b = np.concatenate([[0], upto_b])
        # One row of letters for each token, a's tokens of a group before b's; the last letter parts tokens.
        letters = np.zeros((len(a) + len(b), self.digits.shape[1] + 1), np.uint8)
        at_a = np.arange(len(a)) + before_b[group_a]
        at_b = np.arange(len(b)) + upto_a[group_b]
        letters[at_a, :-1], letters[at_b, :-1] = self.digits[a], self.digits[b]
        letters[at_a, -1] = np.where(common[group_a] == ends_a, ord("|"), ord(","))
        letters[at_b, -1] = np.where(common[group_b] == ends_b, ord(";"), ord(","))
        pairs = a[np.searchsorted(ends_a, ends)] << 32 | b[np.searchsorted(ends_b, ends)]

        found = []
        begin = 0
        for size, head in zip(sizes, heads):
            ranges = []
            for k, low in enumerate(range(begin, begin + size, range_bytes)):
                high = min(low + range_bytes, begin + size)
                from_g, to_g = np.searchsorted(common, [low, high], "right")
                first = low if head and not k else common[from_g] if from_g < to_g else None
                marks = [low, high] if first is None else [low, first, max(first, common[to_g - 1]) if to_g else first, high]
                in_a = np.searchsorted(ends_a, marks, "right")
                in_b = np.searchsorted(ends_b, marks, "right")
                runs = [Run(a[in_a[i] : in_a[i + 1]], b[in_b[i] : in_b[i + 1]]) for i in range(len(marks) - 1)]
                if first is None:
                    ranges.append(Fragment(runs[0], None, NOTHING, k))
                    continue
                in_c = np.searchsorted(common, marks, "right")
                in_l = np.searchsorted(ends, marks, "right")
                rows = letters[in_a[1] + in_b[1] : in_a[2] + in_b[2]].tobytes().translate(None, b"\0")
                part = Part(
                    len(runs[1].a), len(runs[1].b), int(in_c[2] - in_c[1]), rows[:-1], pairs[in_l[1] : in_l[2]]
                )
                closed = (((k, 1), part),) if part.n_a else ()
                ranges.append(Fragment(runs[0], closed, runs[2], k))
            found.append(ranges)
            begin += size
        return found


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable bytes for
    themselves, the others by their order from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def _digits(n: int) -> np.ndarray:
    """Decimal letters of each number below n, zero bytes after them."""
    width = len(str(n - 1))
    return np.frombuffer(b"".join(str(i).encode().ljust(width, b"\0") for i in range(n)), np.uint8).reshape(n, width)


_pairs: dict[str, TokenPair] = {}


def _pair_of(files: tuple[bytes, bytes]) -> TokenPair:
    """The tokenizers of this worker process, kept for its further tasks."""
    digest = hashlib.sha256(files[0] + files[1]).hexdigest()
    if digest not in _pairs:
        _pairs.clear()
        _pairs[digest] = TokenPair(*files)
    return _pairs[digest]


class _Block:
    """The distinct pairs of a block of text and how often each is linked."""

    def __init__(self) -> None:
        self.sorted = np.zeros(0, np.int64)
        self.number = np.zeros(0, np.int64)
        self.counts = np.zeros(0, np.int64)

    def add(self, pairs: np.ndarray) -> np.ndarray:
        """Numbers of the pairs within the block, in the order given."""
        distinct, where, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        at = np.searchsorted(self.sorted, distinct)
        known = at < len(self.sorted)
        known[known] = self.sorted[at[known]] == distinct[known]
        fresh = np.arange(len(self.counts), len(self.counts) + np.count_nonzero(~known))
        self.sorted = np.insert(self.sorted, at[~known], distinct[~known])
        self.number = np.insert(self.number, at[~known], fresh)
        self.counts = np.concatenate([self.counts, np.zeros(len(fresh), np.int64)])
        numbers = self.number[np.searchsorted(self.sorted, distinct)]
        self.counts[numbers] += counts
        return numbers[where]

    def pairs(self) -> np.ndarray:
        listed = np.empty(len(self.sorted), np.int64)
        listed[self.number] = self.sorted
        return listed


_ZSTD = pa.Codec("zstd", compression_level=3)


def _pack(numbers: np.ndarray) -> bytes:
    """Numbers in two bytes each, or four where a block has more pairs; the first byte says which."""
    width = 2 if not len(numbers) or numbers.max() < 1 << 16 else 4
    return bytes([width]) + _ZSTD.compress(numbers.astype(f"<u{width}").tobytes(), asbytes=True)


def _unpack(packed: bytes, n: int) -> np.ndarray:
    width = packed[0]
    return np.frombuffer(_ZSTD.decompress(packed[1:], n * width, asbytes=True) if n else b"", f"<u{width}")


KEY = ("block", "seg", "side")


def _layout(doc_id: T.DataType) -> T.StructType:
    """Rows of the stored passes. kind: slab (aligned texts), block (its pairs), piece (text yet to be
    aligned), shell (open ends of a piece)."""
    number = T.ArrayType(T.LongType())
    return T.StructType(
        [
            T.StructField("kind", T.StringType()),
            *[T.StructField(k, T.LongType()) for k in KEY],
            T.StructField("ok", T.BooleanType()),
            T.StructField("row", number),
            T.StructField("doc_id", T.ArrayType(doc_id)),
            *[T.StructField(c, number) for c in ("n_a", "n_b", "n_groups", "n_links")],
            T.StructField("sha", T.ArrayType(T.StringType())),
            T.StructField("rendered", T.BinaryType()),
            T.StructField("links", T.BinaryType()),
            T.StructField("pairs", number),
            T.StructField("counts", number),
            T.StructField("text", T.StringType()),
            *[T.StructField(c, number) for c in ("prefix_a", "prefix_b", "suffix_a", "suffix_b")],
        ]
    )


def _record(layout: pa.Schema, rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([row.get(f.name) for row in rows], f.type) for f in layout]
    return pa.RecordBatch.from_arrays(columns, schema=layout)


def _links_row(key: tuple[int, int, int], block: _Block) -> dict:
    return dict(zip(KEY, key)) | {"kind": "block", "pairs": block.pairs(), "counts": block.counts}


def _part_row(key: tuple[int, int, int], row: int, doc_id: object, part: Part) -> list[dict]:
    """A part as a slab of its own, with its block."""
    block = _Block()
    links = block.add(part.pairs)
    slab = dict(zip(KEY, key)) | {
        "kind": "slab", "ok": True, "row": [row], "doc_id": [doc_id], "n_a": [part.n_a], "n_b": [part.n_b],
        "n_groups": [part.n_groups], "n_links": [len(links)], "sha": [""], "rendered": part.rendered,
        "links": _pack(links),
    }
    return [slab, _links_row(key, block)]


def _align_texts(
    batches: Iterator[pa.RecordBatch], files, settings: AlignmentSettings, layout: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """Slabs and blocks of texts of ordinary length; the pieces of longer ones."""
    pair = _pair_of(files.value)
    serial = TaskContext.get().partitionId() << 40
    block, name, chars = _Block(), serial, 0
    slab: list[tuple[int, object, str]] = []
    held = 0

    def aligned() -> Iterator[pa.RecordBatch]:
        nonlocal block, name, chars, slab, held
        if slab:
            yield _record(layout, [_slab_row((name, -1, 0), slab, pair, block)])
        chars += held
        slab, held = [], 0
        if chars > settings.block_chars or len(block.counts) > settings.block_pairs:
            yield _record(layout, [_links_row((name, -1, 0), block)])
            block, name, chars = _Block(), serial, 0

    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            serial += 1
            text = text or ""
            if len(text) > settings.long_chars:
                for seg, piece in enumerate(_pieces(text, settings.long_chars, pair.words)):
                    row = {"kind": "piece", "row": [serial], "doc_id": [doc_id], "seg": seg, "text": piece}
                    yield _record(layout, [row])
                continue
            slab.append((serial, doc_id, text))
            held += len(text)
            if held >= settings.slab_chars:
                yield from aligned()
        yield from aligned()
    yield _record(layout, [_links_row((name, -1, 0), block)])


def _pieces(text: str, size: int, words: bool) -> Iterator[str]:
    """The text cut at spaces between words, each piece of `size` characters or more."""
    begin = 0
    while words and len(text) - begin > size:
        cut = CUT.search(text, begin + size)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.end()
    yield text[begin:]


def _slab_row(
    key: tuple[int, int, int], slab: list[tuple[int, object, str]], pair: TokenPair, block: _Block
) -> dict:
    """Whole texts, aligned at once."""
    encoded = pair.encode([text for _, _, text in slab])
    good = [ok and bool(text) for (_, _, text), (_, _, ok) in zip(slab, encoded)]
    used = [e for e, ok in zip(encoded, good) if ok]
    sizes = [int(pair.len_a[a].sum()) for a, _, _ in used]
    parts = iter(())
    if used:
        a, b = np.concatenate([e[0] for e in used]), np.concatenate([e[1] for e in used])
        whole = pair.fragments(a, b, sizes, [True] * len(used), max(sizes))
        parts = iter([fragment.closed[0][1] for [fragment] in whole])
    empty = Part(0, 0, 0, b"", np.zeros(0, np.int64))
    found = [next(parts) if ok else empty for ok in good]
    links = block.add(np.concatenate([p.pairs for p in found]))
    return dict(zip(KEY, key)) | {
        "kind": "slab", "ok": True,
        "row": [row for row, _, _ in slab], "doc_id": [doc_id for _, doc_id, _ in slab],
        "n_a": [p.n_a for p in found], "n_b": [p.n_b for p in found],
        "n_groups": [p.n_groups for p in found], "n_links": [len(p.pairs) for p in found],
        "sha": [hashlib.sha256(p.rendered).hexdigest() if p.n_a else "" for p in found],
        "links": _pack(links),
    }


def _align_pieces(
    batches: Iterator[pa.RecordBatch], files, settings: AlignmentSettings, layout: pa.Schema
) -> Iterator[pa.RecordBatch]:
    """The fragment of each piece: its leaves, reduced; closed parts as slabs, open ends as a shell."""
    pair = _pair_of(files.value)
    for batch in batches:
        for [row], [doc_id], seg, text in zip(*[batch.column(c).to_pylist() for c in range(4)]):
            [(a, b, ok)] = pair.encode([text])
            key = (row, seg, 1)
            shell = dict(zip(KEY, key)) | {"kind": "shell", "ok": ok, "row": [row], "doc_id": [doc_id]}
            if not ok:
                yield _record(layout, [shell])
                continue
            size = int(pair.len_a[a].sum())
            [leaves] = pair.fragments(a, b, [size], [seg == 0], settings.range_bytes)
            whole = leaves[0]
            for leaf in leaves[1:]:
                whole = compose(whole, leaf, pair)
            rows = [shell | _open_ends(whole, seg)]
            if whole.closed:
                parts = [part for _, part in whole.closed]
                joined = Part(
                    *[sum(p[i] for p in parts) for i in range(3)],
                    b";".join(p.rendered for p in parts),
                    np.concatenate([p.pairs for p in parts]),
                )
                rows += _part_row(key, row, doc_id, joined)
            yield _record(layout, rows)


def _open_ends(fragment: Fragment, first: int) -> dict:
    """A fragment without its closed parts; `counts` has the piece of its first common end, if any."""
    return {
        "prefix_a": fragment.prefix.a, "prefix_b": fragment.prefix.b,
        "suffix_a": fragment.suffix.a, "suffix_b": fragment.suffix.b,
        "counts": [] if fragment.closed is None else [first],
    }


def _reduce(table: pa.Table, files, layout: pa.Schema, root: bool) -> pa.Table:
    """Neighbouring shells of a document as one, and the groups that close between them as slabs.

    The root has no open ends: a document begins and ends with both kinds.
    """
    pair = _pair_of(files.value)
    shells = sorted(table.to_pylist(), key=lambda s: s["seg"])
    row, doc_id = shells[0]["row"][0], shells[0]["doc_id"][0]
    whole = None
    for shell in shells:
        prefix, suffix = (
            Run(*[np.array(shell[f"{end}_{k}"], np.int64) for k in "ab"]) for end in ("prefix", "suffix")
        )
        closed = () if shell["counts"] else None
        fragment = Fragment(prefix, closed, suffix, *(shell["counts"] or [0]))
        whole = fragment if whole is None else compose(whole, fragment, pair)
    rows = []
    for (place, _), part in whole.closed or ():
        rows += _part_row((row, place, 0), row, doc_id, part)
    if not root:
        shell = dict(zip(KEY, (row, shells[0]["seg"], 1)))
        shell |= {"kind": "shell", "ok": True, "row": [row], "doc_id": [doc_id]}
        rows.append(shell | _open_ends(whole, whole.first))
    return pa.Table.from_batches([_record(layout, rows)], schema=layout)


DIGEST = (
    "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def align_tokens(docs: DataFrame, settings: AlignmentSettings) -> DataFrame:
    """doc_id and the alignment of each row's text in numbers.

    n_a, n_b, n_groups, n_links: tokens of both kinds, groups, and pairs of tokens that share a byte. The
    count of a pair of ids is how many links of the corpus have it; count_sum adds the counts of a
    text's links, n_best are the links whose count is the highest that their b id has, equal ones
    included. groups_sha256 is the digest of the ids by group, in order.

    Null and empty texts, and texts whose tokens spell something else than a space and the text, have no
    tokens: zeros and an empty digest; they link nothing. Repeated rows and equal ids count and are
    returned each. A text of any length is aligned whole; one without a space between words is encoded in one
    task. An empty table has no rows. Columns besides doc_id and text are not read.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    files = _broadcast_files(spark, settings)
    texts = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = _layout(texts.schema["doc_id"].dataType)
    layout = to_arrow_schema(schema)
    aligned = stage(
        texts.mapInArrow(lambda rows: _align_texts(rows, files, settings, layout), schema), "aligned"
    )
    pieces = aligned.where("kind = 'piece'").select("row", "doc_id", "seg", "text")
    pieces = pieces.repartition("row", "seg")
    long = stage(
        pieces.mapInArrow(lambda rows: _align_pieces(rows, files, settings, layout), schema), "pieces"
    )
    spoilt = long.where("kind = 'shell' and not ok").select("block", "row", "doc_id").distinct()
    spoilt = stage(spoilt, "spoilt")
    sound = long.join(spoilt.select("block"), "block", "left_anti").select(*schema.names)
    joints = _tree(sound.where("kind = 'shell'"), files, layout, schema, settings)
    stored = aligned.where("kind in ('slab', 'block')")
    for more in (sound.where("kind in ('slab', 'block')"), joints):
        stored = stored.unionByName(more)

    of_whole, of_pieces = _with_counts(stored, texts.schema["doc_id"].dataType)
    whole = of_whole.drop("row", "seg", "side", "rendered")
    of_long = (
        of_pieces.groupBy("row", "doc_id")
        .agg(
            *[F.sum(c).alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
            F.array_sort(F.collect_list(F.struct("seg", "side", "rendered"))).alias("parts"),
        )
        .withColumn("whole", F.array_join(F.transform("parts", lambda p: p["rendered"].cast("string")), ";"))
        .select(
            "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
            F.sha2(F.col("whole").cast("binary"), 256).alias("groups_sha256"),
        )
    )
    zeros = spoilt.select(
        F.col("doc_id")[0].alias("doc_id"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")],
        F.lit("").alias("groups_sha256"),
    )
    return whole.unionByName(of_long).unionByName(zeros)


def _broadcast_files(spark: SparkSession, settings: AlignmentSettings):
    """The two vocabulary files, some megabytes whatever the corpus."""
    files = tuple(Path(p).read_bytes() for p in (settings.byte_bpe, settings.piece_bpe))
    return spark.sparkContext.broadcast(files)


def _tree(
    shells: DataFrame, files, layout: pa.Schema, schema: T.StructType, settings: AlignmentSettings
) -> DataFrame:
    """Rounds that reduce neighbouring shells, `fan_in` at a time, until each document has one.

    What closes in a round is a small part of the documents, and no round holds more than `fan_in` shells
    of one document in a task, unless they have no common end.
    """
    level = stage(shells, "shells")
    found = level.limit(0)
    most = level.agg(F.max("seg")).first()[0]
    width = 1
    while most is not None:
        width *= settings.fan_in
        root = most < width
        near = level.withColumn("place", F.floor(F.col("seg") / width).cast("long"))
        rows = near.groupBy("block", "place").applyInArrow(_reducer(files, layout, root), schema)
        rows = stage(rows, "round")
        found = found.unionByName(rows.where("kind <> 'shell'"))
        level = rows.where("kind = 'shell'")
        if root:
            break
    return found


def _reducer(files, layout: pa.Schema, root: bool) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _reduce(table, files, layout, root)


def _with_counts(stored: DataFrame, doc_id: T.DataType) -> list[DataFrame]:
    """The texts of all slabs with n_best and count_sum, from the corpus counts of their blocks' pairs:
    whole texts, and parts of very long ones."""
    blocks = stored.where("kind = 'block'")
    listed = blocks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("x")).select("x.*")
    totals = listed.groupBy("pairs").agg(F.sum("counts").alias("total"))
    of_b = Window.partitionBy(F.col("pairs").bitwiseAND(F.lit((1 << 32) - 1)))
    totals = totals.withColumn("best", (F.col("total") == F.max("total").over(of_b)).cast("int"))
    of = [f"of_{k}" for k in KEY]
    places = blocks.select(
        *[F.col(k).alias(o) for k, o in zip(KEY, of)], F.posexplode("pairs").alias("place", "pairs")
    )
    numbers = places.join(totals, "pairs").select(*of, "place", "total", "best")
    slabs = stored.where("kind = 'slab'").select(
        *KEY, "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "sha", "rendered", "links"
    )
    field = T.StructType(
        [
            T.StructField("row", T.LongType()),
            T.StructField("seg", T.LongType()),
            T.StructField("side", T.LongType()),
            T.StructField("doc_id", doc_id),
            *[T.StructField(x.split()[0], T.LongType() if "long" in x else T.StringType()) for x in DIGEST.split(", ")],
            T.StructField("rendered", T.BinaryType()),
        ]
    )
    layout = to_arrow_schema(field)
    return [
        slabs.where(f"seg {side} 0").groupBy(*KEY)
        .cogroup(numbers.where(f"of_seg {side} 0").groupBy(*of))
        .applyInArrow(lambda left, right: _look_up(left, right, layout), field)
        for side in ("<", ">=")
    ]


def _look_up(slabs: pa.Table, numbers: pa.Table, layout: pa.Schema) -> pa.Table:
    place = numbers.column("place").to_numpy()
    total, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    total[place] = numbers.column("total").to_numpy()
    best[place] = numbers.column("best").to_numpy()
    columns: dict[str, list] = {f.name: [] for f in layout}
    for slab in slabs.to_pylist():
        sizes = np.array(slab["n_links"], np.int64)
        links = _unpack(slab["links"], int(sizes.sum()))
        ends = np.cumsum(sizes)
        for name, values in (("n_best", best), ("count_sum", total)):
            sums = np.concatenate([[0], np.cumsum(values[links])])
            columns[name] += (sums[ends] - sums[ends - sizes]).tolist()
        n = len(sizes)
        for name in ("row", "doc_id", "n_a", "n_b", "n_groups", "n_links"):
            columns[name] += slab[name]
        columns["groups_sha256"] += slab["sha"]
        columns["seg"] += [slab["seg"]] * n
        columns["side"] += [slab["side"]] * n
        columns["rendered"] += [slab["rendered"]] * n
    return pa.table([pa.array(columns[f.name], f.type) for f in layout], schema=layout)
