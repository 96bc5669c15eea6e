from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from cuadre.llm import bpe
from cuadre.llm.queries import op3_bpe, vocabulary_path
from tests.llm.tables import EDGE_TEXTS, SMALL, edge_documents, empty, folder, texts_of


@pytest.fixture(scope="module")
def known():
    tokenizer = Tokenizer.from_file(vocabulary_path())
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(bpe.read_vocabulary(vocabulary_path()))


def expected(known, text):
    ids = known.encode(text or "", add_special_tokens=False).ids
    decoded = known.decode(ids, skip_special_tokens=False)
    joined = ",".join(map(str, ids))
    return len(ids), hashlib.sha256(joined.encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def test_ids_equal_the_library(known, vocabulary):
    draw = random.Random(5)
    ranges = [(0x20, 0x7F), (0, 0x300), (0x370, 0xD7FF), (0x10000, 0x1FFFF)]
    texts = ["", " ", "a<|endoftext|> b <|endoftext|>", "aaaaaaaa" * 40, "\n\n  x\t", "I'll don't WE'RE", "ab" * 3000]
    texts += ["".join(chr(draw.randrange(*draw.choice(ranges))) for _ in range(50)) for _ in range(200)]
    flat, ends = bpe.Encoder(vocabulary).encode(texts)
    found = [flat[a:b].tolist() for a, b in zip(ends, ends[1:])]
    assert found == [x.ids for x in known.encode_batch(texts, add_special_tokens=False)]


def test_a_full_store_of_words_changes_nothing(monkeypatch, known, vocabulary):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 3)
    encoder = bpe.Encoder(vocabulary)
    for text in ("one two three four five", "one two six"):
        assert encoder.encode([text])[0].tolist() == known.encode(text, add_special_tokens=False).ids


def test_query_on_edge_cases(spark, tmp_path, known):
    found = op3_bpe(spark, folder(spark, tmp_path, documents=edge_documents(spark))).collect()
    want = sorted((str(i), *expected(known, t)) for i, t, _ in EDGE_TEXTS)
    assert sorted((str(r[0]), *r[1:]) for r in found) == want


def test_query_on_documents(spark, known):
    found = {r[0]: tuple(r)[1:] for r in op3_bpe(spark, SMALL).collect()}
    assert found == {i: expected(known, t) for i, t in texts_of(spark, SMALL).items()}


def test_empty_table_and_clashing_columns(spark, known):
    content = bpe.read_vocabulary(vocabulary_path())
    assert bpe.decode(bpe.encode(empty(spark), content), content).count() == 0
    clash = spark.createDataFrame([(1, "a text", "other")], "doc_id long, text string, ids string")
    row = bpe.decode(bpe.encode(clash, content), content).first()
    assert row["text"] == "a text" and row["ids"] == known.encode("a text", add_special_tokens=False).ids


def test_decoding_broken_ids_replaces(spark, vocabulary):
    content = bpe.read_vocabulary(vocabulary_path())
    first = vocabulary.byte_ids[0xE6]
    rows = spark.createDataFrame([(1, [int(first)]), (2, None)], "doc_id long, ids array<int>")
    assert {r["doc_id"]: r["text"] for r in bpe.decode(rows, content).collect()} == {1: "�", 2: ""}
