"""SentencePiece encoding and decoding as shortest paths of a weighted transducer."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aislewise.llm.common import bounded_batches

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
UNIGRAM, BPE = 1, 2
NORMAL, DEFINED, BYTE = 1, 4, 6
CACHE = 400_000
INFINITE = float("inf")
#: Above all piece numbers and code points, so that two states make one number.
STATES = 1 << 22


class Store:
    """The arcs of a model as a tree of letters, and what a process has worked out with them:
    paths of words and weights of neighbours.

    A full store of words becomes the older one, from which words met again come back; what
    isn't met until the next change is gone. So memory is bounded and common words stay.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]]) -> None:
        #: Below each letter the next ones; "" has the state of the piece that ends there.
        self.arcs: dict = {}
        for piece, (number, _) in pieces.items():
            node = self.arcs
            for letter in piece:
                node = node.setdefault(letter, {})
            node[""] = number + 1
        self.paths: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[int, bool] = {}

    def make_room(self) -> None:
        if len(self.paths) >= CACHE:
            self.older = dict(self.paths)
            self.paths.clear()
        if len(self.pairs) >= CACHE:
            self.pairs.clear()


#: The store of the model that this worker process used last, for its further tasks.
_stores: dict[str, Store] = {}


def _store_of(digest: str, pieces: dict[str, tuple[int, float]]) -> Store:
    if digest not in _stores:
        _stores.clear()
        _stores[digest] = Store(pieces)
    return _stores[digest]


@dataclass
class Transducer:
    """Normaliser, pieces and byte fallback of a SentencePiece model, composed with each input.

    The normaliser writes a mark for each space and one before the text. The piece machine
    has an arc for each piece; where no piece has a character, a path of byte arcs. Composed
    with a text, an accepting path is a segmentation, and encoding takes the path of least
    total weight (the tropical semiring).

    In a unigram model a piece arc weighs minus its score. In a byte-pair model merging decides, not a
    sum of scores; there the state is the last piece, and an arc weighs 0 if merging the
    two pieces' text gives back these two, else infinity. All neighbours being so is the same as
    the whole being the result of merging, hence just one path has finite weight.
    """

    pieces: dict[str, tuple[int, float]]
    texts: list[str]
    bytes_: dict[int, int]
    kind: int
    unknown: int
    prefix: bool
    squeeze: bool
    penalty: float = 0.0
    chunks: re.Pattern | None = None
    digest: str = ""
    store: Store = field(init=False, repr=False)

    def __post_init__(self) -> None:
        self.penalty = 10 - min((s for _, s in self.pieces.values()), default=0.0)
        self.values = {i: b for b, i in self.bytes_.items()}
        whole = repr((self.pieces, self.bytes_, self.kind, self.unknown))
        self.digest = hashlib.sha256(whole.encode("utf-8", "surrogatepass")).hexdigest()
        self.store = Store(self.pieces)
        joined = [p for p in self.pieces if len(p) > 1]
        if any(SPACE in p.lstrip(SPACE) for p in joined):
            return  # a piece runs on into the next word, so texts are composed whole
        alone = "".join(c for c in "\n\t\r" if not any(c in p for p in joined))
        stop = f"[{re.escape(alone)}]|" if alone else ""
        self.chunks = re.compile(f"{SPACE}*[^{SPACE}{re.escape(alone)}]+|{stop}{SPACE}+", re.S)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "store"}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state, store=_store_of(state["digest"], state["pieces"]))

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (SPACE if self.prefix else "") + text.replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        """Piece numbers of the whole text."""
        plain = self.normalise(text)
        parts = self.chunks.findall(plain) if self.chunks else [plain]
        found = list(map(self.store.paths.get, parts))
        if None in found:
            found = [self._learn(p) if f is None else f for p, f in zip(parts, found)]
        return list(chain.from_iterable(found))

    def _learn(self, part: str) -> tuple[int, ...]:
        """The path of a part that the store lacked when its text was looked up."""
        store = self.store
        got = store.paths.get(part)
        if got is not None:
            return got
        store.make_room()
        got = store.older.get(part)
        if got is None:
            path = self._viterbi(part) if self.kind == UNIGRAM else self._compatible(part)
            try:
                got = tuple([self.pieces[p][0] for p in path])
            except KeyError:
                got = tuple([i for p in path for i in self._numbers(p)])
        if len(part) <= 64:
            store.paths[part] = got
        return got

    def _numbers(self, piece: str) -> tuple[int, ...]:
        known = self.pieces.get(piece)
        if known:
            return (known[0],)
        if not self.bytes_:
            return (self.unknown,)
        return tuple(self.bytes_[b] for b in piece.encode("utf-8", "surrogatepass"))

    def _arcs(self, text: str, at: int) -> list[tuple[int, int]]:
        """Ends and states of the arcs that leave a place, the longest last; a letter always is one."""
        node, end, size = self.store.arcs, at, len(text)
        out = []
        while end < size:
            node = node.get(text[end])
            if node is None:
                break
            end += 1
            if "" in node:
                out.append((end, node[""]))
        if not out or out[0][0] > at + 1:
            out.insert(0, (at + 1, len(self.texts) + 1 + ord(text[at])))
        return out

    def _viterbi(self, text: str) -> list[str]:
        """Least sum of weights; of equal ones the path whose last piece is longest."""
        best = [(0.0, -1)] + [(INFINITE, -1)] * len(text)
        for at in range(len(text)):
            for end, _ in self._arcs(text, at):
                known = self.pieces.get(text[at:end])
                total = best[at][0] + (-known[1] if known else self.penalty)
                if total < best[end][0]:
                    best[end] = (total, at)
        path, at = [], len(text)
        while at:
            path.append(text[best[at][1] : at])
            at = best[at][1]
        return path[::-1]

    def _compatible(self, text: str) -> list[str]:
        """The path of finite weight, by depth first over states (place, last piece), long arcs first.

        A state from which no finite path leads on is entered once.
        """
        path: list[str] = []
        at, size = 0, len(text)
        choices, states = [self._arcs(text, 0)] if text else [], [0]
        failed: set[tuple[int, str]] = set()
        pairs = self.store.pairs
        while at < size:
            arcs, left = choices[-1], states[-1] * STATES
            while arcs:
                end, state = arcs.pop()
                fits = pairs.get(left + state)
                if fits is False:
                    continue
                piece = text[at:end]
                if fits is None:
                    last = path[-1] if path else ""
                    fits = pairs[left + state] = self._pair(last, piece)
                if fits and (not failed or (at, piece) not in failed):
                    path.append(piece)
                    states.append(state)
                    at = end
                    if at < size:
                        choices.append(self._arcs(text, at))
                    break
            else:
                if not path:
                    return self._merge(text)  # pieces of one score can leave no path
                choices.pop()
                states.pop()
                last = path.pop()
                at -= len(last)
                failed.add((at, last))
        return path

    def _pair(self, left: str, right: str) -> bool:
        """Whether merging gives two neighbours back; with nothing to the left, the one piece."""
        return self._merge(left + right) == ([left, right] if left else [right])

    def _merge(self, text: str) -> list[str]:
        """Byte-pair merging: again and again the neighbours whose joined piece scores best, leftmost first."""
        parts = list(text)
        while len(parts) > 1:
            best, at = -INFINITE, -1
            for k in range(len(parts) - 1):
                known = self.pieces.get(parts[k] + parts[k + 1])
                if known and known[1] > best:
                    best, at = known[1], k
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def decode(self, ids: list[int]) -> str:
        """The text of piece numbers; bytes are joined, those that are no UTF-8 become U+FFFD."""
        texts, values = self.texts, self.values
        if values.keys().isdisjoint(ids):
            text = "".join(map(texts.__getitem__, ids))
        else:
            out, run = [], bytearray()
            for i in ids:
                if i in values:
                    run.append(values[i])
                    continue
                if run:
                    out.append(run.decode("utf-8", "replace"))
                    run.clear()
                out.append(texts[i])
            text = "".join(out) + run.decode("utf-8", "replace")
        text = text.replace(SPACE, " ")
        return text[1:] if self.prefix and text[:1] == " " else text


def load_transducer(path: str = MODEL) -> Transducer:
    """Compiles a model file; one with a character map for its normaliser is refused."""
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    normal = model.normalizer_spec
    if normal.precompiled_charsmap:
        raise ValueError("only models with the identity normaliser are supported")
    pieces, values, texts = {}, {}, []
    for i, piece in enumerate(model.pieces):
        texts.append(piece.piece if piece.type in (NORMAL, DEFINED) else "")
        if piece.type == BYTE:
            values[int(piece.piece[3:5], 16)] = i
        elif piece.type in (NORMAL, DEFINED):
            pieces[piece.piece] = (i, piece.score)
    spec = model.trainer_spec
    return Transducer(
        pieces, texts, values, spec.model_type, spec.unk_id,
        normal.add_dummy_prefix, normal.remove_extra_whitespaces,
    )


def encode_documents(
    docs: DataFrame,
    machine: Transducer,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """For every row its id as `doc_id`, `token_ids`, `n_tokens` and `round_trip`.

    `round_trip` says whether decoding gives the text back; it can't where the text itself has
    the space mark, or spaces that the normaliser drops. Null and empty texts have no tokens and do round-trip.
    Equal texts give equal tokens. Empty tables give no rows; other columns are not read. The
    compiled machine goes to the tasks: its size is that of the vocabulary. A worker process keeps
    the paths of words for its further tasks, in a store of bounded size.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, flat, same = [0], [], []
            for text in batch.column("text").to_pylist():
                ids = machine.encode(text or "")
                same.append(machine.decode(ids) == (text or ""))
                flat.append(np.array(ids, np.int32))
                sizes.append(sizes[-1] + len(ids))
            values = pa.array(np.concatenate(flat) if flat else np.empty(0, np.int32))
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), values)
            counts = pa.array(np.diff(sizes).astype(np.int64))
            yield pa.record_batch(
                [batch.column("doc_id"), lists, counts, pa.array(same, pa.bool_())],
                names=["doc_id", "token_ids", "n_tokens", "round_trip"],
            )

    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(
        run, f"doc_id {kind}, token_ids array<int>, n_tokens long, round_trip boolean"
    )


def decode_documents(
    encoded: DataFrame, machine: Transducer, id_column: str = "doc_id", ids_column: str = "token_ids"
) -> DataFrame:
    """The `text` of each row of piece numbers, with its id as `doc_id`; null numbers give null."""
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("token_ids").to_pylist()
            texts = [None if x is None else machine.decode(x) for x in lists]
            columns = [batch.column("doc_id"), pa.array(texts, pa.string())]
            yield pa.record_batch(columns, names=["doc_id", "text"])

    bounded_batches(encoded.sparkSession)
    narrow = encoded.select(
        F.col(id_column).alias("doc_id"), F.col(ids_column).alias("token_ids")
    )
    return narrow.mapInArrow(run, f"doc_id {kind}, text string")
