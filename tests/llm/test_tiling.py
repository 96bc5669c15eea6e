from __future__ import annotations

import random

import pytest

import corpus_pipeline
from cuadre.llm import tiling
from cuadre.llm.licences import words_of
from cuadre.llm.queries import op5_decontamination
from tests.llm.tables import SMALL, documents, edge_documents, empty, folder, texts_of

BENCHMARK = "item_id long, text string"


def naive_tiles(text, item, least):
    """Greedy string tiling word by word."""
    used_text, used_item, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for i in range(len(text)):
            for j in range(len(item)):
                n = 0
                while (
                    i + n < len(text) and j + n < len(item) and text[i + n] == item[j + n] and text[i + n] is not None
                    and i + n not in used_text and j + n not in used_item
                ):
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return covered
        used_text |= set(range(i, i + n))
        used_item |= set(range(j, j + n))
        covered += n


@pytest.mark.parametrize("seed", range(30))
def test_tiles_against_naive(seed):
    draw = random.Random(seed)
    item = [draw.randrange(12) for _ in range(draw.randrange(3, 30))]
    parts = [item[a : a + draw.randrange(1, 12)] for a in (draw.randrange(len(item)) for _ in range(5))]
    text = [x for p in parts for x in [*p, draw.choice([None, 99, *range(12)])]]
    tiles = tiling.greedy_tiles(text, item, 3)
    # of equally long matches either may be marked first, so only the first tile must agree
    longest = max((n for _, _, n in tiles), default=0)
    covered = [(i + k, j + k) for i, j, n in tiles for k in range(n)]
    assert all(text[i] == item[j] for i, j in covered)
    assert len({i for i, _ in covered}) == len({j for _, j in covered}) == len(covered)
    assert [n for _, _, n in tiles] == sorted((n for _, _, n in tiles), reverse=True)
    assert (longest == 0) == (naive_tiles(text, item, 3) == 0)
    assert all(n >= 3 for _, _, n in tiles)
    rest_text = [None if i in {a for a, _ in covered} else x for i, x in enumerate(text)]
    rest_item = [-1 if j in {b for _, b in covered} else x for j, x in enumerate(item)]
    assert naive_tiles(rest_text, rest_item, 3) == 0  # nothing is left


def test_query_on_documents(spark):
    items = {r[0]: words_of(r[1].encode()) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()}
    want = set()
    for i, text in texts_of(spark, SMALL).items():
        words = words_of(text.encode())
        runs = {tuple(words[k : k + 5]) for k in range(len(words))}
        for number, item in items.items():
            if any(tuple(item[k : k + 5]) in runs for k in range(len(item) - 4)):
                if naive_tiles(words, item, 5) >= tiling.COVERAGE * len(item):
                    want.add((i, number))
    assert {(r["doc_id"], r["item_id"]) for r in op5_decontamination(spark, SMALL).collect()} == want and want


def test_reordered_passages_are_caught_and_parts_are_not(spark):
    draw = random.Random(2)
    words = ["".join(draw.choice("abcdefghij") for _ in range(6)) for _ in range(60)]
    item, filler = words[:40], words[40:]
    texts = [
        " ".join(filler + item[20:] + filler + item[:20]),  # halves swapped
        " ".join(item).upper() + "!",
        " ".join(filler + item[:20]),  # half of it
        " ".join(filler),
        " ".join(x + " zz" for x in item),  # every word, no run of five
    ]
    benchmark = spark.createDataFrame([(7, " ".join(item)), (7, " ".join(item)), (8, None), (9, "")], BENCHMARK)
    found = tiling.matches(documents(spark, texts), benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["covered"]) for r in found} == {(0, 7, 40), (1, 7, 40)}
    assert {tuple(x) for x in next(r for r in found if r["doc_id"] == 0)["tiles"]} == {(60, 0, 20), (20, 20, 20)}


def test_short_items_match_whole(spark):
    benchmark = spark.createDataFrame([(1, "two words"), (2, "words two")], BENCHMARK)
    found = tiling.matches(documents(spark, ["some two words here", "two", "", None]), benchmark).collect()
    assert [(r["doc_id"], r["item_id"]) for r in found] == [(0, 1)]


def test_items_made_of_one_unit_are_caught(spark, tmp_path):
    """A seed that stands at several places of an item covers them all."""
    unit = [f"u{i}" for i in range(10)]
    items = [unit * 7, [x + "x" for x in unit[:8]] * 8, ["same"] * 40]
    filler = " ".join(f"f{i}" for i in range(20))
    texts = [f"{filler} {' '.join(x)} {filler}" for x in items]
    texts += [" ".join(unit * 5), " ".join(["same"] * 31), filler]  # covers 50 of 70, 31 of 40 words
    benchmark = spark.createDataFrame([(k, " ".join(x)) for k, x in enumerate(items)], BENCHMARK)
    docs = documents(spark, texts)
    found = tiling.matches(docs, benchmark).collect()
    assert {(r["doc_id"], r["item_id"], r["covered"]) for r in found} == {(0, 0, 70), (1, 1, 64), (2, 2, 40)}
    left = corpus_pipeline.decontamination(spark, docs, folder(spark, tmp_path, benchmark=benchmark))
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 4, 5]


def test_repeated_documents_each_get_their_matches(spark):
    benchmark = spark.createDataFrame([(1, "the same text twice over and over"), (2, "the same text twice")], BENCHMARK)
    found = tiling.matches(edge_documents(spark), benchmark)
    assert sorted((r["doc_id"], r["item_id"]) for r in found.collect()) == [(4, 1), (4, 2), *[(5, 1)] * 2, *[(5, 2)] * 2]
    assert found.columns == ["row_a", "row_b", "doc_id", "item_id", "n_words", "covered", "tiles", "coverage"]


def test_edge_cases(spark, tmp_path):
    benchmark = spark.createDataFrame([(1, "the same text twice over and over")], BENCHMARK)
    found = op5_decontamination(spark, folder(spark, tmp_path, documents=edge_documents(spark), benchmark=benchmark))
    assert sorted({r["doc_id"] for r in found.collect()}) == [4, 5]
    docs = documents(spark, ["the same text twice over and over"])
    assert tiling.matches(docs, empty(spark, BENCHMARK)).count() == 0
    assert tiling.matches(empty(spark), benchmark).count() == 0


def seconds(text, item):
    import time

    start = time.process_time()
    tiles = tiling.greedy_tiles(text, item, 5)
    return time.process_time() - start, tiles


def test_time_follows_the_length_of_texts_that_repeat_themselves():
    for item, unit in (([7] * 400, [7]), ([1, 2, 3] * 130, [1, 2, 3]), ([*range(200)] * 2, [*range(50, 90)])):
        short, _ = seconds(unit * (20_000 // len(unit)), item)
        long, tiles = seconds(unit * (160_000 // len(unit)), item)
        assert long < 20 * max(short, 0.02) and long < 20
        assert sum(n for _, _, n in tiles) >= 0.1 * len(item)
