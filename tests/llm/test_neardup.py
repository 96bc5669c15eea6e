from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from cuadre.llm import neardup
from cuadre.llm.components import connected
from cuadre.llm.queries import op6_minhash
from tests.llm.tables import (
    EDGE_TEXTS, MIDDLE, components, documents, edge_documents, empty, folder, shingle_set, texts_of,
)


def near_copies(seed, groups=4, copies=30):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("aeioulrst") for _ in range(draw.randrange(2, 7)))
    passage, texts = [word() for _ in range(40)], []
    for _ in range(groups):
        base = [word() for _ in range(110)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(draw.randrange(12)):
                at = draw.randrange(len(copy))
                copy[at : at + 1] = draw.choice(([], [word()], [copy[at], copy[at]]))
            texts.append(" ".join(copy))
        texts += [texts[-1], " ".join([word() for _ in range(60)] + passage)]
    return texts


@pytest.mark.parametrize("seed,words,percent", [(1, 3, 85), (2, 3, 85), (3, 5, 80)])
def test_against_all_pairs(spark, monkeypatch, seed, words, percent):
    monkeypatch.setattr(neardup, "BLOCK", 8)  # families of several blocks
    texts = near_copies(seed)
    found = {r["doc_id"]: r for r in neardup.components(documents(spark, texts), words, percent).collect()}
    sets = {i: shingle_set(t, words) for i, t in enumerate(texts)}
    assert {i: r["component_id"] for i, r in found.items()} == components(sets, percent)
    assert all(r["kept"] == (i == r["component_id"]) and r["n_shingles"] == len(sets[i]) for i, r in found.items())


def test_blocks_follow_the_length_of_texts(spark, monkeypatch):
    """Families of few but long documents are cut into blocks by shingles, and lose no link."""
    sizes = []
    frame = type(spark.range(1))
    apply = frame.groupBy

    def counted(self, *keys):
        if [str(k) for k in keys] == ["family", "i", "j"]:
            sizes.extend(r[0] for r in apply(self.where("NOT asks"), *keys).agg(F.sum(F.size("members"))).collect())
        return apply(self, *keys)

    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 600)
    monkeypatch.setattr(frame, "groupBy", counted)
    texts = near_copies(5, groups=2, copies=40)
    found = {r["doc_id"]: r["component_id"] for r in neardup.components(documents(spark, texts), 3, 85).collect()}
    assert found == components({i: shingle_set(t, 3) for i, t in enumerate(texts)}, 85)
    # about 110 shingles each: 40 of them are far more than a block holds
    assert sizes and max(sizes) < 5 * 600


def test_query_on_documents(spark):
    sets = {i: shingle_set(t, 3) for i, t in texts_of(spark, MIDDLE).items()}
    want = components(sets, 85)
    got = {r[0]: tuple(r)[1:] for r in op6_minhash(spark, MIDDLE).collect()}
    assert got == {i: (len(sets[i]), want[i], want[i] == i) for i in sets}


def test_edge_cases(spark, tmp_path):
    found = op6_minhash(spark, folder(spark, tmp_path, documents=edge_documents(spark))).collect()
    assert len(found) == len(EDGE_TEXTS)
    by_id = {r["doc_id"]: r for r in found}
    assert all(by_id[i]["n_shingles"] == 0 and by_id[i]["kept"] for i in (0, 1, 2))
    assert by_id[3]["n_shingles"] == 1 and by_id[7]["n_shingles"] == 1
    assert [r["component_id"] for r in found if r["doc_id"] == 5] == [4, 4] and not by_id[5]["kept"]
    assert by_id[None]["component_id"] is None and by_id[None]["kept"]


def test_empty_table(spark):
    assert neardup.components(empty(spark), 3, 85).count() == 0


def test_keys_find_every_pair_within_the_distance():
    import numpy as np

    draw = np.random.default_rng(4)
    most = 2 * neardup.CHUNKS - 1
    for _ in range(200):
        a = draw.integers(0, 2**16, neardup.HASHES)
        b = a.copy()
        places = draw.choice(neardup.HASHES, most, replace=False)
        b[places] = draw.integers(0, 2**16, most)
        keys = neardup.chunk_keys(np.stack([a, b]).astype(np.uint16))
        assert set(keys[0]) & set(keys[1])


def test_differences_leave_room():
    assert 2 * neardup.CHUNKS > neardup.differences(85) > neardup.HASHES * 0.15 + 3 * (neardup.HASHES * 0.1275) ** 0.5
    assert neardup.differences(80) == 2 * neardup.CHUNKS - 1


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, 50), (50, 70), (200, 300), (300, 200), (5, 5), (5, 6)]
    found = {r[0]: r[1] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(21)}, 50: 50, 70: 50, 100: 50, 200: 200, 300: 200}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0
