"""Token ids as binary files: frequency-ranked, byte-aligned codes of variable length with separate control bytes.

Documents are dealt by ranges of their id, so the files, and the rows in them, ascend by id. A task encodes its
documents in order and closes a segment whenever ``SEGMENT_IDS`` ids are gathered, so its memory is bounded whatever
the partition holds. A segment ranks its own ids by frequency (ties by id) and writes ranks instead of ids: one to four
bytes each, little-endian, in one stream; the lengths, two bits each and four to a byte, in another. The rank table goes
along. A document that is longer than a segment spans several.

Decoding is table lookup: a control byte gives four lengths, their running sum the offsets, and the bytes are gathered
by position; no loop over ids.

A null or empty text has the end id alone. Rows with a null doc_id come first; rows that repeat a doc_id are all kept,
ordered by text. An empty table gives no segment and no row.
"""

from __future__ import annotations

import binascii
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from cdcstrata.sources.scratch import materialise, scratch_path

SEGMENT_IDS = 1 << 20
MEMO = 900_000  # distinct pieces of text whose ids a worker remembers

#: One row a segment. ``counts``: ids of each document in it; ``opens``/``closes``: whether its first document begins
#: and its last one ends here.
FILE_SCHEMA = (
    "part int, seq int, n_ids bigint, doc_ids array<bigint>, counts array<int>, opens boolean, closes boolean, "
    "ranked binary, control binary, data binary"
)
_ARROW = pa.schema(
    [
        ("part", pa.int32()),
        ("seq", pa.int32()),
        ("n_ids", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("counts", pa.list_(pa.int32())),
        ("opens", pa.bool_()),
        ("closes", pa.bool_()),
        ("ranked", pa.binary()),
        ("control", pa.binary()),
        ("data", pa.binary()),
    ]
)
# Lengths of the four codes of a control byte.
_LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + 1
# A single space between two characters that are not white space: no token of a byte-level BPE crosses its left side.
_CUT = re.compile(r"(?<=\S) (?=\S)")
# Texts in which white space meets white space are cut by the expression, others at every space.
_WIDE = r"[\t-\r\x{1c}-\x{20}\x{85}\pZ]{2}"
_PUNCTUATED = r"^(?P<word>[A-Za-z\x{c0}-\x{d6}\x{d8}-\x{f6}\x{f8}-\x{24f}]+)(?P<mark>[!-/:-@\[-`{-~]+)$"


# --- the code -------------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """Ids to (rank table, control bytes, data bytes)."""
    counts = np.bincount(ids)
    values = np.flatnonzero(counts)
    by_rank = values[np.lexsort((values, -counts[values]))]
    rank = np.empty(len(counts), np.uint32)
    rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    codes = rank[ids]
    lengths = np.uint8(1) + (codes > 0xFF) + (codes > 0xFFFF) + (codes > 0xFFFFFF)
    padded = np.zeros(-(-len(codes) // 4) * 4, np.uint8)
    padded[: len(codes)] = lengths - 1
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    most = 2 if len(by_rank) <= 1 << 16 else 4
    cells = codes.astype(f"<u{most}").view(np.uint8).reshape(-1, most)
    data = cells[np.arange(most) < lengths[:, None]]
    return by_rank.astype("<u4").tobytes(), control.tobytes(), data.tobytes()


def unpack(ranked: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ids of ``pack``, as unsigned 32-bit integers."""
    lengths = _LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    stream = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)])
    codes = stream[starts].astype(np.uint32)
    for k in range(1, int(lengths.max(initial=1))):
        longer = np.flatnonzero(lengths > k)
        codes[longer] |= stream[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return np.frombuffer(ranked, "<u4")[codes]


# --- encoding -------------------------------------------------------------------------------------


class Encoder:
    """The tokenizer, with a bounded memory of the pieces that it has seen.

    A text is cut where no token can cross: before a single space with ink on both sides. A piece is known by what
    follows its space, a piece without one (a text's first) by a tuple. New pieces go to the tokenizer many at a time, as
    one text, whose ids are told apart by the bytes they stand for. A word with punctuation behind it is made of the ids
    of the word and of the punctuation, between which the tokenizer itself always cuts.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.bytes_of = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.bytes_of[i] = len(token)  # a byte-level vocabulary writes each byte as one character
        self.forget()

    def forget(self) -> None:
        self.known: dict[str | tuple[str], int] = {}  # a piece's place in starts
        self.starts, self.flat = array("q", [0]), array("I")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _add(self, piece: str | tuple[str], ids) -> None:
        self.known[piece] = len(self.starts) - 1
        self.flat.extend(ids)
        self.starts.append(len(self.flat))

    def _learn(self, new: list[str | tuple[str]]) -> None:
        """Add pieces, none of them known."""
        known = self.known
        special = re.compile("|".join(map(re.escape, self.special)) or "(?!)").search
        plain = [x for x in new if isinstance(x, str) and x and not x[-1].isspace() and not special(x)]
        for x in set(new).difference(plain):
            known[x] = len(self.starts) - 1
            self.flat.extend(self._ids(x[0] if isinstance(x, tuple) else f" {x}"))
            self.starts.append(len(self.flat))
        for at in range(0, len(plain), 512):
            some = plain[at : at + 512]
            run = np.array(self._ids(" " + " ".join(some)), np.uint32)
            sizes = np.cumsum([len(x.encode()) + 1 for x in some])
            ends = np.searchsorted(np.cumsum(self.bytes_of[run]), sizes) + 1
            first, place = len(self.flat), len(self.starts) - 1
            self.flat.frombytes(run.tobytes())
            known |= zip(some, range(place, place + len(some)), strict=True)
            self.starts.extend((ends + first).tolist())

    def _ranges(self, pieces: pa.Array, heads: list[tuple[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids that hold those of every piece, and where its own begin and end.

        Words with punctuation are not remembered, but put together from their two known parts.
        """
        texts = pieces.to_pylist()
        places, unknown = self._places(texts)
        unseen = pa.array([texts[k] for k in unknown], pa.string())
        parts = pc.extract_regex(unseen, _PUNCTUATED)
        whole = parts.is_null().to_numpy(zero_copy_only=False)
        made, alone = unknown[~whole], unknown[whole]
        parts = parts.filter(pa.array(~whole))
        words = pc.struct_field(parts, "word").to_pylist()
        marks = [(m,) for m in pc.struct_field(parts, "mark").to_pylist()]
        word_at, new_words = self._places(words)
        mark_at, new_marks = self._places(marks)
        head_at, new_heads = self._places(heads)
        tasks = ((places, texts, alone), (word_at, words, new_words), (mark_at, marks, new_marks), (head_at, heads, new_heads))
        self._learn(list(dict.fromkeys(items[k] for _, items, rows in tasks for k in rows.tolist())))
        for at, items, rows in tasks:
            at[rows] = [self.known[items[k]] for k in rows.tolist()]
        places[made] = 0
        starts, flat = np.array(self.starts, np.int64), np.array(self.flat, np.uint32)
        at = np.concatenate([places, head_at])
        first, last = starts[at], starts[at + 1]
        if len(made):
            pair = np.stack([word_at, mark_at], axis=1).ravel()
            both = _gathered(flat, starts[pair], starts[pair + 1])
            ends = np.cumsum(starts[pair + 1] - starts[pair])[1::2] + len(flat)
            first[made] = np.concatenate([[len(flat)], ends[:-1]])
            last[made] = ends
            flat = np.concatenate([flat, both])
        return flat, first, last

    def _places(self, pieces: list[str | tuple[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces are remembered, and which are not."""
        places = np.array([-1 if p is None else p for p in map(self.known.get, pieces)], np.int64)
        return places, np.flatnonzero(places < 0)

    def _split(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """All pieces in a row, and where each text's begin and end."""
        lists = pc.split_pattern(texts, " ")
        if pc.any(wide := pc.match_substring_regex(texts, _WIDE)).as_py():
            found = lists.to_pylist()
            for k in np.flatnonzero(wide.to_numpy(zero_copy_only=False)).tolist():
                found[k] = _CUT.split(texts[k].as_py())
            lists = pa.array(found, pa.list_(pa.string()))
        ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        return lists.flatten(), np.concatenate([[0], ends])

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        if len(self.known) > MEMO:
            self.forget()
        pieces, bounds = self._split(texts)
        coded = pieces.dictionary_encode()
        heads = [(x,) for x in pieces.take(pa.array(bounds[:-1])).to_pylist()]
        flat, first, last = self._ranges(coded.dictionary, heads)
        codes = coded.indices.to_numpy().copy()
        codes[bounds[:-1]] = np.arange(len(heads)) + len(coded.dictionary)
        first, last = first[codes], last[codes]
        ends = np.cumsum(last - first)
        return np.split(_gathered(flat, first, last), ends[bounds[1:-1] - 1])


def _gathered(flat: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The ranges of an array, one after the other."""
    lengths = last - first
    ends = np.cumsum(lengths)
    return flat[np.repeat(first - ends + lengths, lengths) + np.arange(ends[-1] if len(ends) else 0)]


_ENCODERS: dict[str, Encoder] = {}


def _encoder(path: str) -> Encoder:
    """The worker process's own encoder, which tasks after the first find warm."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


class _Segments:
    """Gathers the ids of a task's documents and cuts them into segments."""

    def __init__(self, part: int):
        self.part, self.seq = part, 0
        self.clear(opens=True)

    def clear(self, opens: bool) -> None:
        self.ids, self.docs, self.counts, self.held, self.opens = [], [], [], 0, opens

    def row(self, closes: bool) -> dict:
        ids = np.concatenate(self.ids)
        ranked, control, data = pack(ids)
        out = dict(part=self.part, seq=self.seq, n_ids=len(ids), doc_ids=self.docs, counts=self.counts)
        out |= dict(opens=self.opens, closes=closes, ranked=ranked, control=control, data=data)
        self.seq += 1
        self.clear(opens=closes)
        return out

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[dict]:
        while self.held + len(ids) > SEGMENT_IDS:
            room = SEGMENT_IDS - self.held
            if room:
                self._put(doc_id, ids[:room])
            yield self.row(closes=not room)
            ids = ids[room:]
        self._put(doc_id, ids)

    def _put(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.ids.append(ids)
        self.docs.append(doc_id)
        self.counts.append(len(ids))
        self.held += len(ids)


def _portions(texts: pa.Array, limit: int = 1 << 23) -> Iterator[tuple[int, int]]:
    """Index ranges of about ``limit`` bytes of text."""
    ends, first = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)), 0
    while first < len(texts):
        before = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + limit, "right")))
        yield first, last
        first = last


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2, text: str = "text") -> str:
    """Encode every whole text, append ``end_id``, write segments in ascending doc_id order to ``path``."""

    def run(batches):
        encoder, segments = _encoder(tokenizer), _Segments(TaskContext.get().partitionId())
        end = np.array([end_id], np.uint32)
        for batch in batches:
            ids_of, texts = batch.column(0).to_pylist(), batch.column(1)
            for a, b in _portions(texts):
                for doc_id, ids in zip(ids_of[a:b], encoder.encode(texts.slice(a, b - a)), strict=True):
                    for row in segments.add(doc_id, np.concatenate([ids, end])):
                        yield pa.RecordBatch.from_pylist([row], _ARROW)
        if segments.ids:
            yield pa.RecordBatch.from_pylist([segments.row(closes=True)], _ARROW)

    whole = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    ordered = whole.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.option("compression", "zstd").parquet(path)
    return path


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FILE_SCHEMA).parquet(path)


def _starts(segments: DataFrame) -> DataFrame:
    """Ids before each segment: summed by part first, so no window holds more than the parts or one part's segments."""
    total = segments.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = total.select("part", F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    own = segments.select("part", "seq", F.coalesce(F.sum("n_ids").over(within), F.lit(0)).alias("inside"))
    return own.join(parts, "part").select("part", "seq", (F.col("base") + F.col("inside")).alias("first_id"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """The files read back: ``doc_id``, ``piece`` of a document that spans segments, ``start``, ``ids``."""
    segments = read_segments(spark, path)
    schema = "part int, seq int, row int, doc_id bigint, inside bigint, begins boolean, ends boolean, ids array<bigint>"

    def run(batches):
        for batch in batches:
            for s in batch.to_pylist():
                ids, at = unpack(s["ranked"], s["control"], s["data"], s["n_ids"]), 0
                rows = []
                for k, (doc_id, n) in enumerate(zip(s["doc_ids"], s["counts"], strict=True)):
                    begins, ends = k > 0 or s["opens"], k + 1 < len(s["counts"]) or s["closes"]
                    rows.append((s["part"], s["seq"], k, doc_id, at, begins, ends, ids[at : at + n].tolist()))
                    at += n
                columns = list(zip(*rows, strict=True))
                kinds = [pa.int32()] * 3 + [pa.int64()] * 2 + [pa.bool_()] * 2 + [pa.list_(pa.int64())]
                names = ["part", "seq", "row", "doc_id", "inside", "begins", "ends", "ids"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    rows = segments.mapInArrow(run, schema).join(_starts(segments.select("part", "seq", "n_ids")), ["part", "seq"])
    return rows.withColumn("start", F.col("first_id") + F.col("inside")).drop("inside", "first_id")


def _crc_zeros(crc: int, n: int) -> int:
    """The checksum register after ``n`` zero bytes, by squaring the operator of one zero byte."""

    def times(matrix: list[int], vector: int) -> int:
        out, k = 0, 0
        while vector:
            if vector & 1:
                out ^= matrix[k]
            vector >>= 1
            k += 1
        return out

    odd = [0xEDB88320] + [1 << k for k in range(31)]  # one zero bit; the reflected CRC-32 polynomial
    operator = [times(odd, odd[k]) for k in range(32)]
    operator = [times(operator, operator[k]) for k in range(32)]
    operator = [times(operator, operator[k]) for k in range(32)]  # eight zero bits
    while n:
        if n & 1:
            crc = times(operator, crc)
        operator = [times(operator, operator[k]) for k in range(32)]
        n >>= 1
    return crc


def crc32_combine(first: int, second: int, second_bytes: int) -> int:
    """The CRC-32 of two byte strings in a row, from those of the parts."""
    return _crc_zeros(first, second_bytes) ^ second


def summary(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    Documents that lie in one segment, nearly all, are summed up where they are decoded. The pieces of the others
    (at most two documents a segment) meet by their document's first piece and their checksums are combined.
    """
    segments = read_segments(spark, path)
    schema = "part int, seq int, row int, doc_id bigint, inside bigint, begins boolean, ends boolean, n bigint, crc bigint"

    def run(batches):
        for batch in batches:
            for s in batch.to_pylist():
                raw = unpack(s["ranked"], s["control"], s["data"], s["n_ids"]).astype("<u4").tobytes()
                counts = np.array(s["counts"], np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                crcs = [binascii.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                n = len(counts)
                begins = [True] * n
                closes = [True] * n
                begins[0], closes[-1] = s["opens"], s["closes"]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([s["part"]] * n, pa.int32()),
                        pa.array([s["seq"]] * n, pa.int32()),
                        pa.array(range(n), pa.int32()),
                        pa.array(s["doc_ids"], pa.int64()),
                        pa.array(starts),
                        pa.array(begins),
                        pa.array(closes),
                        pa.array(counts),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=["part", "seq", "row", "doc_id", "inside", "begins", "ends", "n", "crc"],
                )

    first = F.broadcast(_starts(segments.select("part", "seq", "n_ids")))  # a row for each million ids
    rows = materialise(segments.mapInArrow(run, schema), "token-rows").join(first, ["part", "seq"])
    rows = rows.withColumn("start", F.col("first_id") + F.col("inside"))
    whole = rows.filter("begins AND ends").select(
        "doc_id", "start", F.col("n").alias("n_tokens"), F.col("crc").alias("ids_crc32")
    )
    order = Window.partitionBy("part").orderBy("seq", "row").rowsBetween(Window.unboundedPreceding, 0)
    pieces = rows.filter("NOT (begins AND ends)").withColumn("opened", F.sum(F.col("begins").cast("int")).over(order))

    def merge(key, table):
        crc = 0
        found = sorted(table.to_pylist(), key=lambda r: r["start"])
        for r in found:
            crc = crc32_combine(crc, r["crc"], 4 * r["n"])
        total = sum(r["n"] for r in found)
        one = {"doc_id": [found[0]["doc_id"]], "start": [found[0]["start"]], "n_tokens": [total], "ids_crc32": [crc]}
        return pa.table(one, pa.schema([(k, pa.int64()) for k in one]))

    split = pieces.groupBy("part", "opened").applyInArrow(
        merge, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return whole.unionByName(split)


def write_and_read(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """Write the files to the shared folder and sum them up from there."""
    spark = docs.sparkSession
    return summary(spark, write_tokens(docs, scratch_path(spark, "token-files"), tokenizer, end_id))
