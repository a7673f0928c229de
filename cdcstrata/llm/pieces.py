"""SentencePiece encoding and decoding of BPE models, with a max-plus parallel scan for giant documents.

A text of up to ``GIANT`` characters is encoded by the library whole. A longer one is cut into chunks that are worked on
apart:

A BPE segmentation is the one path of pieces through the text in which every two neighbours, encoded together, stay as
they are. So a step of the path weighs 0 if its two pieces fit and minus infinity if not, and the best path is a
max-plus product. The state at a chunk's boundary is the piece that is the last to begin before it; a chunk yields the
transfer matrix from the states before it to the states behind it, without knowing which is true. The matrices of
a document are combined associatively, in a tree; the products tell every chunk its own entry and exit state, and
each chunk is traced back between the two, again on its own.

The ids are the library's for the whole text; decoding gives the text back, but for U+2581, which a model writes for a
space. A null or empty text has no ids. Rows that repeat a document are encoded alike; giant texts that occur often are
encoded once. Texts without any space, or of characters the model lacks (written as bytes), are cut just the same. A
giant text's matrices meet in one task: at most 65,536 of them (a value holds 2 GB), of some tens of states.
"""

from __future__ import annotations

import binascii
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from cdcstrata.llm.batches import give_back
from cdcstrata.sources.scratch import materialise

GIANT = 32_768
CHUNK = 16_384
SPACE = "▁"
_NORMAL, _BYTE, _BPE = 1, 6, 2
_START = -1


class Pieces:
    """The pieces of a BPE model and which of them may stand side by side."""

    def __init__(self, path: str):
        model = model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        rules = model.normalizer_spec
        if model.trainer_spec.model_type != _BPE or rules.precompiled_charsmap or rules.remove_extra_whitespaces:
            raise ValueError("a BPE model without character rules is wanted")
        self.library = _library(path)
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.id_of = {p.piece: i for i, p in enumerate(model.pieces) if p.type == _NORMAL}
        self.score = {p.piece: p.score for p in model.pieces if p.type == _NORMAL}
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == _BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        self.longest = max(map(len, self.id_of))
        # Where no piece has a space behind another character, none reaches over the beginning of a word.
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in self.id_of)
        self._words: dict[str, bytes] = {}
        self._stable: dict[str, bool] = {}
        self._fit: dict[tuple[str, str], bool] = {}

    def written(self, text: str) -> str:
        """The text as the model sees it."""
        return (self.prefix + text).replace(" ", SPACE) if text else ""

    def merged(self, text: str) -> list[str]:
        """BPE of a short string: the best pair is joined, the leftmost of equals, until none is a piece."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.score.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, piece: str) -> bool:
        """Whether the string is a single piece when encoded; any character is."""
        if len(piece) == 1:
            return True
        if piece not in self.id_of:
            return False
        if (known := self._stable.get(piece)) is None:
            known = self._stable[piece] = self.merged(piece) == [piece]
        return known

    def fit(self, a: str, b: str) -> bool:
        """Whether two pieces stay as they are next to each other."""
        if (known := self._fit.get((a, b))) is None:
            if len(self._fit) > 100_000:
                self._fit.clear()
            known = self._fit[a, b] = self.merged(a + b) == [a, b]
        return known

    def word(self, text: str) -> list[str]:
        """The pieces of a word with the spaces before it; their lengths are remembered."""
        if (known := self._words.get(text)) is None:
            if len(self._words) > 100_000:
                self._words.clear()
            found = self.merged(text)
            self._words[text] = bytes(map(len, found))
            return found
        found, at = [], 0
        for n in known:
            found.append(text[at : at + n])
            at += n
        return found

    def run_ids(self, text: str) -> list[int]:
        """Ids of a run of whole words, which begins with a space: no piece reaches over its ends."""
        return self.library.encode((text[1:] if self.prefix else text).replace(SPACE, " "))

    def ids(self, piece: str) -> list[int]:
        found = self.id_of.get(piece)
        return [self.byte_ids[b] for b in piece.encode()] if found is None else [found]


# --- chunks ---------------------------------------------------------------------------------------
# A state is the piece that begins ``before`` characters ahead of the boundary and ends ``beyond`` behind it, as one
# number, before * 64 + beyond; _START is the state at the beginning of the text.


def entries(pieces: Pieces, window: str, begin: int) -> list[int]:
    """All states that a text may have at a boundary."""
    if begin == 0:
        return [_START]
    found = []
    for before in range(1, min(begin, pieces.longest) + 1):
        for beyond in range(0, pieces.longest - before + 1):
            if begin + beyond <= len(window) and pieces.stable(window[begin - before : begin + beyond]):
                found.append(before * 64 + beyond)
    return found


_WORD_START = re.compile(f"(?<!{SPACE}){SPACE}")
LONG_WORD = 64

Ends = dict[int, dict[int, int]]
Runs = dict[int, int]


def paths(pieces: Pieces, window: str, begin: int, end: int, states: list[int]) -> tuple[Ends, Runs]:
    """Where pieces end, where they begin, and the set of entry states, as bits, from which a path leads there.

    All paths pass the beginning of a word and go on alike, so a run of words is taken in one step, as far as they are not
    too long and end within the chunk; by its end, where it begins is given as well. Else steps are single pieces.
    """
    ends: Ends = {}
    runs: Runs = {}
    for k, state in enumerate(states):
        before, beyond = (0, 0) if state == _START else divmod(state, 64)
        ends.setdefault(begin + beyond, {})[begin - before] = 1 << k
    starts = [m.start() for m in _WORD_START.finditer(window, begin, end)] if pieces.by_word else []
    next_word = dict(zip(starts, starts[1:], strict=False))
    at = begin
    while at < end:
        here = ends.get(at)
        stop = next_word.get(at)
        if here and stop is not None and stop - at <= LONG_WORD:
            mask = 0
            for reached in here.values():
                mask |= reached
            first = at
            while (more := next_word.get(stop)) is not None and more - stop <= LONG_WORD:
                at, stop = stop, more
            runs[stop] = first
            ends[stop] = {stop - len(pieces.word(window[at:stop])[-1]): mask}
            at = stop
            continue
        if here:
            before = [(None if start == at else window[start:at], mask) for start, mask in here.items()]
            for stop in range(at + 1, min(at + pieces.longest, len(window)) + 1):
                piece = window[at:stop]
                if not pieces.stable(piece):
                    continue
                mask = 0
                for last, reached in before:
                    if last is None or pieces.fit(last, piece):
                        mask |= reached
                if mask:
                    ends.setdefault(stop, {})[at] = mask
        at += 1
    return ends, runs


def exits(ends: Ends, end: int) -> dict[int, int]:
    """States behind a chunk, with the entry states that lead to them."""
    return {
        (end - start) * 64 + stop - end: mask
        for stop, here in ends.items()
        if stop >= end
        for start, mask in here.items()
        if start < end
    }


def transfer(pieces: Pieces, window: str, begin: int, end: int) -> tuple[list[int], list[int], np.ndarray]:
    """Entry states, exit states and the matrix between them: 0 where a path leads, else minus infinity."""
    states = entries(pieces, window, begin)
    out = exits(paths(pieces, window, begin, end, states)[0], end)
    matrix = np.full((len(states), len(out)), -np.inf)
    for j, mask in enumerate(out.values()):
        matrix[[k for k in range(len(states)) if mask >> k & 1], j] = 0
    return states, list(out), matrix


def trace(pieces: Pieces, window: str, begin: int, end: int, entry: int, exit_state: int) -> list[int]:
    """Ids of the pieces that begin in the chunk, on the one path between two states."""
    ends, runs = paths(pieces, window, begin, end, [entry])
    before, beyond = divmod(exit_state, 64)
    start, stop, found = end - before, end + beyond, []
    while start >= begin:
        if stop in runs:
            start = runs[stop]
            found.append(pieces.run_ids(window[start:stop]))
            last = next(iter(ends[start]))
        else:
            piece = window[start:stop]
            found.append(pieces.ids(piece))
            last = next(s for s in ends[start] if s == start or pieces.fit(window[s:start], piece))
        if last == start:  # the beginning of the text
            break
        start, stop = last, start
    return [i for some in reversed(found) for i in some]


# --- the scan -------------------------------------------------------------------------------------

Matrix = tuple[list[int], list[int], np.ndarray]


def product(a: Matrix, b: Matrix) -> Matrix:
    """The max-plus product: states in which a ends and b begins are matched by their numbers."""
    place = {s: k for k, s in enumerate(a[1])}
    common = [(place[s], k) for k, s in enumerate(b[0]) if s in place]
    if not common:
        return a[0], b[1], np.full((len(a[0]), len(b[1])), -np.inf)
    x, y = a[2][:, [i for i, _ in common]], b[2][[k for _, k in common]]
    return a[0], b[1], (x[:, :, None] + y[None, :, :]).max(axis=1)


def scan(matrices: list[Matrix]) -> list[tuple[int, int]]:
    """Entry and exit state of every chunk of a document.

    Products are combined up a tree; on the way down, a pair's entry and exit fix the state between its two halves:
    the one with the greatest weight of both ways.
    """
    tree = [matrices]
    while len(tree[-1]) > 1:
        level = tree[-1]
        tree.append([product(*level[k : k + 2]) if k + 1 < len(level) else level[k] for k in range(0, len(level), 2)])
    whole = tree[-1][0]
    last = whole[1][int(np.argmax(whole[2][0]))]
    known = [(_START, last)]
    for level in reversed(tree[:-1]):
        below = []
        for k, (entry, leave) in enumerate(known):
            if 2 * k + 1 == len(level):
                below.append((entry, leave))
                continue
            a, b = level[2 * k], level[2 * k + 1]
            to_middle = dict(zip(a[1], a[2][a[0].index(entry)], strict=True))
            from_middle = dict(zip(b[0], b[2][:, b[1].index(leave)], strict=True))
            middle = max((s for s in b[0] if s in to_middle), key=lambda s: to_middle[s] + from_middle[s])
            below += [(entry, middle), (middle, leave)]
        known = below
    return known


def cut(pieces: Pieces, text: str, size: int = CHUNK) -> list[tuple[str, int, int]]:
    """Windows of the written text, with the chunk's place in each: a piece's length more to either side."""
    whole, margin = pieces.written(text), pieces.longest
    found = []
    for at in range(0, len(whole), size):
        first, end = max(0, at - margin), min(at + size, len(whole))
        found.append((whole[first : end + margin], at - first, end - first))
    return found


# --- Spark ----------------------------------------------------------------------------------------

_LOADED: dict[str, object] = {}


def _pieces(path: str) -> Pieces:
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _library(path: str) -> sentencepiece.SentencePieceProcessor:
    key = f"library {path}"
    if key not in _LOADED:
        _LOADED[key] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[key]


def _portions(texts: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes, so that few texts and ids are Python objects at a time."""
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def _giant_ids(giants: DataFrame, path: str, chunk: int) -> DataFrame:
    """``key`` and ``ids`` of every giant text."""

    def windows(batches):
        pieces = _pieces(path)
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = cut(pieces, text, chunk)
                columns = [[key] * len(found), list(range(len(found))), *map(list, zip(*found, strict=True))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int32(), pa.string(), pa.int32(), pa.int32()), strict=True)],
                    names=["key", "chunk", "window", "begin", "end"],
                )

    def matrices(batches):
        pieces = _pieces(path)
        for batch in batches:
            rows = [transfer(pieces, r["window"], r["begin"], r["end"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([r[0] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[1] for r in rows], pa.list_(pa.int32())),
                    pa.array([r[2].astype(np.float32).ravel().tolist() for r in rows], pa.list_(pa.float32())),
                ],
                names=["key", "chunk", "entries", "exits", "weights"],
            )

    def states(table):
        rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
        read = [
            (r["entries"], r["exits"], np.array(r["weights"]).reshape(len(r["entries"]), len(r["exits"]))) for r in rows
        ]
        known = scan(read)
        return pa.table(
            {
                "key": pa.array([r["key"] for r in rows], pa.string()),
                "chunk": pa.array([r["chunk"] for r in rows], pa.int32()),
                "entry": pa.array([a for a, _ in known], pa.int32()),
                "leave": pa.array([b for _, b in known], pa.int32()),
            }
        )

    def traced(batches):
        pieces = _pieces(path)
        for batch in batches:
            ids = [trace(pieces, r["window"], r["begin"], r["end"], r["entry"], r["leave"]) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32()))], names=["key", "chunk", "ids"]
            )

    texts = giants.groupBy("key").agg(F.first("text").alias("text"))
    chunks = texts.mapInArrow(windows, "key string, chunk int, window string, begin int, end int")
    chunks = materialise(chunks.repartition("key", "chunk"), "giant-chunks")
    transfers = chunks.mapInArrow(matrices, "key string, chunk int, entries array<int>, exits array<int>, weights array<float>")
    found = transfers.groupBy("key").applyInArrow(states, "key string, chunk int, entry int, leave int")
    parts = chunks.join(found, ["key", "chunk"]).select("key", "chunk", "window", "begin", "end", "entry", "leave")
    parts = parts.repartition("key", "chunk").mapInArrow(traced, "key string, chunk int, ids array<int>")
    return parts.groupBy("key").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "ids"))), lambda p: p["ids"])).alias("ids")
    )


_CHECKED = "doc_id bigint, n_chars bigint, n_ids bigint, ids array<int>, ids_crc32 bigint, round_trip boolean"


def _checked(path: str, encoded: bool):
    """A function over batches of (doc_id, text) or (doc_id, text, ids): encode if need be, decode, compare."""

    def run(batches):
        library = _library(path)
        for batch in batches:
            for a, b in _portions(batch.column(1)):
                some = batch.column(1).slice(a, b - a).to_pylist()
                ids = batch.column(2).slice(a, b - a).to_pylist() if encoded else library.encode(some, num_threads=1)
                back = library.decode(ids)
                flat = [np.array(x, "<i4") for x in ids]
                ends = np.cumsum([0, *map(len, flat)], dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, b - a),
                        pa.array([len(x) for x in some], pa.int64()),
                        pa.array([len(x) for x in flat], pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flat))),
                        pa.array([binascii.crc32(x.tobytes()) for x in flat], pa.int64()),
                        pa.array([x == y for x, y in zip(some, back, strict=True)]),
                    ],
                    names=["doc_id", "n_chars", "n_ids", "ids", "ids_crc32", "round_trip"],
                )
        give_back()  # the worker lives on

    return run


def encode(docs: DataFrame, model: str, text: str = "text", giant: int = GIANT, chunk: int = CHUNK) -> DataFrame:
    """One row per row: ``doc_id``, ``n_chars``, ``n_ids``, ``ids``, their CRC-32 as 32-bit integers, ``round_trip``."""
    whole = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    long = F.char_length("text") > giant
    ordinary = whole.filter(~long).mapInArrow(_checked(model, encoded=False), _CHECKED)
    giants = whole.filter(long).withColumn("key", F.sha2("text", 256))
    found = giants.join(_giant_ids(giants.select("key", "text"), model, chunk), "key").select("doc_id", "text", "ids")
    return ordinary.unionByName(found.mapInArrow(_checked(model, encoded=True), _CHECKED))


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``doc_id``, ``ids`` to ``doc_id``, ``text``. Null ids give an empty text."""

    def run(batches):
        library = _library(model)
        for batch in batches:
            texts = library.decode([x or [] for x in batch.column(1).to_pylist()]) if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    ids = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return ids.mapInArrow(run, "doc_id bigint, text string")
