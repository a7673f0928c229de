"""Files of coded ids against the tokenizer and an exact round trip."""

import binascii

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cdcstrata.llm import token_files as T
from cdcstrata.llm.vocabularies import vocabulary
from cdcstrata.sources.scratch import scratch_path

PATH = vocabulary("byte_bpe_50k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@given(st.lists(st.integers(0, 2**22), min_size=1, max_size=300))
@settings(max_examples=60, deadline=None)
def test_code_round_trip(ids):
    ids = np.array(ids, np.uint32)
    packed = T.pack(ids)
    assert (T.unpack(*packed, len(ids)) == ids).all()


def test_frequent_ids_take_one_byte():
    ids = np.repeat(np.array([49000, 5], np.uint32), [500, 3])
    ranked, control, data = T.pack(ids)
    assert np.frombuffer(ranked, "<u4").tolist() == [49000, 5] and len(data) == len(ids) and set(control) == {0}


@pytest.mark.parametrize("n", [0, 1, 3, 4, 257, 70_000])
def test_crc_combines(n):
    a, b = b"some bytes", bytes(k % 251 for k in range(n))
    assert T.crc32_combine(binascii.crc32(a), binascii.crc32(b), n) == binascii.crc32(a + b)


ODD = ["", "  a  b ", "x <|endoftext|> y", "<|endoftext|>", "a\n b\n\n c  d\t e", "don't  it's 'll", " lead", " \n ", "it 's",
       "a\x1cb \x85 c　d e", "word*** wörd, ¿qué? 12,5% __x__ x²", "日本 語", "a<|endoftext|>b c", "tail ", "  nb"]


@given(st.text(alphabet=" \n\tab'sl.,*é日² \x85_1", max_size=40))
@settings(max_examples=300, deadline=None)
def test_cutting_never_changes_ids(text):
    assert T._encoder(PATH).encode(pa.array([text]))[0].tolist() == ids_of(text)


def test_odd_texts():
    for text, found in zip(ODD, T._encoder(PATH).encode(pa.array(ODD)), strict=True):
        assert found.tolist() == ids_of(text), text


def wanted(rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*ids_of(text), 2]
        out.append((doc_id, start, len(ids), binascii.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("segment", [T.SEGMENT_IDS, 700])
def test_files(spark, make_docs, odd_texts, monkeypatch, segment):
    rows = [*enumerate([*odd_texts, *ODD]), (3, "again"), (3, "again"), (None, "nameless")]
    if segment != T.SEGMENT_IDS:
        # A document of many segments: cut where the driver can see it.
        cut = T._Segments(0)
        monkeypatch.setattr(T, "SEGMENT_IDS", segment)
        ids = np.arange(5000, dtype=np.uint32)
        made = [*cut.add(1, ids[:10]), *cut.add(2, ids), *cut.add(3, ids[:4])]
        made.append(cut.row(closes=True))
        assert [m["n_ids"] for m in made] == [700] * 7 + [114]
        assert made[0]["doc_ids"] == [1, 2] and made[3]["doc_ids"] == [2] and made[-1]["doc_ids"] == [2, 3]
        assert [m["opens"] for m in made] == [True] + [False] * 7 and made[-1]["closes"]
        return
    docs = make_docs(rows, ["1 AS part", "2 AS seq", "'x' AS data"])
    path = T.write_tokens(docs.repartition(4), scratch_path(spark, "t"), PATH)
    found = [tuple(r) for r in T.summary(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect()]
    assert sorted(found, key=lambda r: r[1]) == wanted(rows)
    whole = sorted(T.read_documents(spark, path).collect(), key=lambda r: r["start"])
    assert [i for r in whole for i in r["ids"]] == [i for d, x in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")) for i in [*ids_of(x), 2]]


def test_documents_over_segments(spark, make_docs):
    """Segments written with a small limit, by hand, read back as whole documents."""
    docs = [(1, np.arange(5, dtype=np.uint32)), (2, np.arange(1000, dtype=np.uint32) % 300), (3, np.arange(7, dtype=np.uint32))]
    limit, rows = T.SEGMENT_IDS, []
    try:
        T.SEGMENT_IDS = 64
        cut = T._Segments(0)
        for doc_id, ids in docs:
            rows += cut.add(doc_id, ids)
        rows.append(cut.row(closes=True))
    finally:
        T.SEGMENT_IDS = limit
    path = scratch_path(spark, "t")
    columns = [f.name for f in T._ARROW]
    spark.createDataFrame([tuple(r[c] for c in columns) for r in rows], T.FILE_SCHEMA).write.parquet(path)
    found = sorted(tuple(r) for r in T.summary(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    at = 0
    for (doc_id, ids), row in zip(docs, found, strict=True):
        assert row == (doc_id, at, len(ids), binascii.crc32(ids.astype("<u4").tobytes()))
        at += len(ids)


def test_empty_table(spark, make_docs):
    path = T.write_tokens(make_docs([]), scratch_path(spark, "t"), PATH)
    assert T.summary(spark, path).collect() == []
