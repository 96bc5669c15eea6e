"""The corpus pipeline: each stage and all of them against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline as pipeline
from cuadre.llm import langid, tiling
from cuadre.llm.licences import words_of
from cuadre.llm.queries import QUERIES, vocabulary_path
from tests.llm.tables import DOCUMENTS, SMALL, components, edge_documents, empty, repeated_bytes, shingle_set
from tests.llm.test_tiling import naive_tiles

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return sorted(map(tuple, df.select(COLUMNS).collect()), key=str)


def brute_language(spark, given):
    learned = langid.Languages(langid.learn(spark.createDataFrame(given, DOCUMENTS).select("text", "lang")))
    found = [(r, learned.predict(r[1])) for r in given]
    return [r for r, (name, _, margin) in found if name != "und" and margin >= langid.LEAST_MARGIN]


def brute_near(given):
    sets = {r[0]: shingle_set(r[1], pipeline.SHINGLE_WORDS) for r in given}
    least = components(sets, pipeline.SIMILAR_PERCENT)
    return [r for r in given if least[r[0]] == r[0]]


def brute_repeats(given):
    texts = [(r[1] or "").encode() for r in given]
    out = []
    for r, text, covered in zip(given, texts, repeated_bytes(texts, pipeline.REPEAT_BYTES)):
        if any(covered):
            left = bytes(b for b, c in zip(text, covered) if not c).decode("utf-8", "ignore")
            if left:
                out.append((r[0], left, r[2], r[3], len(left)))
        else:
            out.append(r)
    return out


def brute_clean(spark, given):
    items = [words_of((r[1] or "").encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    out = []
    for r in given:
        words = words_of((r[1] or "").encode())
        seeds = {tuple(words[k : k + 5]) for k in range(len(words))}
        hit = [i for i in items if any(tuple(i[k : k + 5]) in seeds for k in range(len(i) - 4))]
        if not any(naive_tiles(words, i, 5) >= tiling.COVERAGE * len(i) for i in hit):
            out.append(r)
    return out


def test_run_against_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select(COLUMNS).collect()]
    spoken = brute_language(spark, given)
    left = brute_clean(spark, brute_repeats(brute_near(spoken)))
    assert 0.95 * len(given) <= len(spoken) and 0 < len(left) < len(given)
    known = Tokenizer.from_file(vocabulary_path())
    want = set()
    for r in left:
        ids = known.encode(r[1], add_special_tokens=False).ids
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        want.add((r[0], len(ids), digest, hashlib.sha256(r[1].encode()).hexdigest()))
    found = pipeline.run(spark, SMALL).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert {tuple(r) for r in found} == want and len(found) == len(want)


def test_registered():
    assert contract.queries()["pipeline"] is pipeline.run and len(pipeline.STAGES) == 5
    assert {k.split("_")[0] for k in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_on_edge_cases(spark, name, stage):
    clash = ["score", "margin", "kept", "removed", "row", "row_a", "tiles", "ids", "component_id", "found", "content"]
    docs = edge_documents(spark)
    wide = docs.selectExpr(*docs.columns, *[f"'own' as {c}" for c in clash])
    found = stage(spark, wide, SMALL).collect()
    if name == "bpe_encoding":
        assert len(found) == docs.count() and all(r["n_tokens"] == len(r["ids"]) for r in found)
        return
    assert found and all(r[c] == "own" for r in found for c in clash)
    assert stage(spark, wide, SMALL).columns == wide.columns
    kept = [r["doc_id"] for r in found]
    if name == "language_id":
        # texts 4 and 5 are one text with two languages: no margin
        assert not {0, 1, 2, 4, 5} & set(kept) and {9, None} <= set(kept)
    if name == "minhash_near_dedup":
        assert 5 not in kept and {0, 1, 2, 3, 4, 7, 8, 9, None} <= set(kept)
    if name == "suffix_array_dedup":
        assert not {7, 8} & set(kept) and kept.count(5) == 2
    if name == "benchmark_decontamination":
        assert len(kept) == docs.count()


def test_rows_of_one_id_stay_once(spark):
    text = " ".join(f"w{i}" for i in range(30))
    given = spark.createDataFrame([(1, text, "en", "s", 1), (1, text, "en", "s", 1), (1, "other", "en", "s", 1)], DOCUMENTS)
    found = pipeline.near_duplicates(spark, given, SMALL).select("text").collect()
    assert sorted(r[0] for r in found) == ["other", text]


@pytest.mark.parametrize("name,stage", pipeline.STAGES)
def test_stage_on_empty_table(spark, name, stage):
    assert stage(spark, empty(spark), SMALL).count() == 0


def test_cut_characters_leave_nothing_behind(spark):
    shared = "é" * 200
    given = spark.createDataFrame([(1, "a" + shared + "b", "fr", "s", 202), (2, shared + "c", "fr", "s", 201)], DOCUMENTS)
    found = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pipeline.repeats(spark, given, SMALL).collect()}
    assert found == {1: ("ab", 2), 2: ("c", 1)}


def test_shared_passages_of_short_words_go(spark):
    """50 words may have far less than REPEAT_BYTES bytes."""
    draw = random.Random(3)
    word = lambda n: "".join(draw.choice("abcdefghijklmnop") for _ in range(n))
    passages = [" ".join(word(n) for _ in range(count)) for n, count in ((1, 51), (2, 60), (3, 50), (2, 49))]
    own = [" ".join(word(9) for _ in range(8)) for _ in range(6)]
    assert all(len(p) < pipeline.REPEAT_BYTES for p in passages)
    texts = [f"{own[0]} {passages[0]} {own[1]} {passages[1]}", f"{passages[1]} {own[2]}\n{passages[0]}\n{own[3]}"]
    texts += [f"{own[4]} {passages[2]}", f"{passages[2]} {own[5]}", *(f"{x} {passages[3]}" for x in own[:2])]
    texts += ["no " * 55 + own[0]]  # repeats itself below REPEAT_BYTES, shared with no document
    given = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], DOCUMENTS)
    found = {r["doc_id"]: r["text"] for r in pipeline.repeats(spark, given, SMALL).collect()}
    want = [f"{own[0]}  {own[1]} ", f" {own[2]}\n\n{own[3]}", f"{own[4]} ", f" {own[5]}", *texts[4:]]
    assert found == dict(enumerate(want))


def test_near_duplicates_of_repeated_and_null_ids_go(spark):
    texts = {k: " ".join(f"{k}{i}" for i in range(60)) for k in "abcde"}
    near = lambda k: texts[k] + " more"
    given = [
        (1, texts["a"]), (2, near("a")), (2, texts["b"]),  # one of two texts of an id goes
        (3, texts["c"]), (3, near("c")),  # near duplicates of one id: one stays
        (None, near("b")), (None, texts["d"]), (None, texts["d"]), (None, near("d")),  # without an id
        (0, near("e")), (None, texts["e"]), (None, ""), (4, ""), (5, None),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in given], DOCUMENTS)
    found = [(r["doc_id"], r["text"]) for r in pipeline.near_duplicates(spark, docs, SMALL).collect()]
    either = lambda i, k: sum((i, t) in found for t in (texts[k], near(k)))
    assert either(3, "c") == either(None, "d") == 1
    sure = {(1, texts["a"]), (2, texts["b"]), (0, near("e")), (None, ""), (4, ""), (5, None)}
    assert sure < set(found) and len(found) == len(sure) + 2
