from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given as cases
from hypothesis import settings
from hypothesis import strategies as st

from cuadre.llm import bpe, records
from cuadre.llm.common import new_folder
from cuadre.llm.queries import END_ID, op12_records, vocabulary_path
from tests.llm.tables import MIDDLE, edge_documents, empty, folder


def crc32c(data: bytes) -> int:
    crc = 0xFFFFFFFF
    for byte in data:
        crc ^= byte
        for _ in range(8):
            crc = crc >> 1 ^ (records.POLYNOMIAL if crc & 1 else 0)
    return crc ^ 0xFFFFFFFF


def masked(data: bytes) -> int:
    crc = crc32c(data)
    return ((crc >> 15 | crc << 17) + records.MASK_DELTA) & 0xFFFFFFFF


def vocabulary():
    return bpe.read_vocabulary(vocabulary_path("word_bpe_49k.json"))


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_str(vocabulary())


def expected(rows):
    tokenizer, start, found = library(), 0, []
    for r in sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0)):
        ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, END_ID]
        found.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def result(df):
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[1])


def test_query_equals_the_library(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").select("doc_id", "text").collect()
    assert result(op12_records(spark, MIDDLE)) == expected(rows)


def test_edge_cases(spark, tmp_path):
    given = edge_documents(spark).selectExpr("*", "doc_id AS ids", "doc_id AS start").repartition(3)
    found = op12_records(spark, folder(spark, tmp_path, documents=given))
    assert result(found) == expected(given.collect())


def test_no_documents(spark, tmp_path):
    assert result(op12_records(spark, folder(spark, tmp_path, documents=empty(spark)))) == []


TEXTS = st.text(st.one_of(st.characters(codec="utf-8"), st.sampled_from("aZ's '\t\n  ́\x1c\x85ΣİK<|endoftext|>09,.!")), max_size=60)


@settings(max_examples=300, deadline=None)
@cases(st.lists(TEXTS, max_size=5))
def test_pieces_encode_as_whole_texts(texts):
    encoder, tokenizer = ENCODER or _encoder(), LIBRARY[0]
    ids, counts = encoder.encode(pa.array(texts, pa.string()))
    ids = np.frombuffer(ids, "<u2").tolist()
    for text, count in zip(texts, counts.tolist()):
        assert ids[:count] == [*tokenizer.encode(text, add_special_tokens=False).ids, END_ID]
        ids = ids[count:]
    assert not ids


ENCODER, LIBRARY = None, []


def _encoder():
    global ENCODER
    ENCODER = records.Encoder(vocabulary(), END_ID)
    LIBRARY.append(library())
    return ENCODER


def test_known_checksums():
    # Published check value of CRC-32C.
    assert crc32c(b"123456789") == 0xE3069283
    sums = records.Checksums()
    strings = [bytes((i * k) % 251 for i in range(n)) for k, n in enumerate([4, 5, 63, 64, 65, 128, 129, 4_000, 70_001], 1)]
    assert sums.masked(strings).tolist() == [masked(s) for s in strings]
    assert sums.masked([b"123456789"]).tolist() == [masked(b"123456789")]


def files_of(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    return records.write(docs, vocabulary(), END_ID, new_folder(spark, "records"))


ROWS = [(i, f"text {i} " * (i % 7)) for i in range(500)]


def plain(path):
    return path.removeprefix("file://")


def test_files_are_framed_and_indexed(spark):
    """Read by the description of the format alone."""
    keys, tokens = [], 0
    for file in sorted(files_of(spark, ROWS).collect(), key=lambda f: f["number"]):
        with open(plain(file["path"]), "rb") as stream:
            content = stream.read()
        with open(plain(file["path"]) + ".index", "rb") as stream:
            index = list(struct.iter_unpack("<QQ", stream.read()))
        assert len(index) == file["records"] + 1 and index[-1] == (file["bytes"], file["tokens"]) and len(content) == file["bytes"]
        for (at, before), (end, after) in zip(index, index[1:]):
            size, of_size = struct.unpack_from("<QI", content, at)
            payload = content[at + 12 : at + 12 + size]
            assert of_size == masked(content[at : at + 8])
            assert struct.unpack_from("<I", content, at + 12 + size) == (masked(payload),) and at + 16 + size == end
            flag, key = struct.unpack_from("<Iq", payload)
            assert flag == 2 and after - before == (size - 12) // 2
            keys.append(key)
        tokens += file["tokens"]
    assert keys == list(range(500))


def test_small_pieces(spark, monkeypatch):
    monkeypatch.setattr(records, "PIECE_BYTES", 300)
    monkeypatch.setattr(records, "CHECKED_RECORDS", 3)
    files = files_of(spark, ROWS)
    assert [r["doc_id"] for r in sorted(records.read(files).collect(), key=lambda r: r["start"])] == list(range(500))


def test_shuffled_reads(spark):
    files = files_of(spark, ROWS)
    read = {(r["doc_id"], r["start"], bytes(r["ids"])) for r in records.read(files).collect()}
    once = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in records.shuffled(files, 1).collect()]
    again = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in records.shuffled(files, 1).collect()]
    other = [(r["doc_id"], r["start"], bytes(r["ids"])) for r in records.shuffled(files, 2).collect()]
    assert set(once) == set(other) == read and len(once) == len(read) == 500
    assert once == again != other
    keys = [k for k, _, _ in once]
    assert abs(np.corrcoef(keys, np.arange(500))[0, 1]) < 0.2


@pytest.mark.parametrize("at", [3, 9, 14, 30, -2])
def test_damage_is_noticed(spark, at):
    files = files_of(spark, ROWS[:50])
    path = plain(files.first()["path"])
    with open(path, "r+b") as stream:
        content = bytearray(stream.read())
        content[at] ^= 4
        stream.seek(0)
        stream.write(content)
    with pytest.raises(Exception, match="is damaged"):
        records.read(files).collect()
