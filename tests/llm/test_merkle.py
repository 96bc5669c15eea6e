from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cuadre.llm import merkle
from cuadre.llm.queries import op11_merkle
from tests.llm.tables import DOCUMENTS, MIDDLE, edge_documents, empty, folder

NAMES = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, **changed) -> str:
    values = [changed.get(c, row[c]) for c in merkle.LEAF_COLUMNS]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(leaves):
    """The top, and the siblings and places of each leaf, level by level."""
    paths = [[] for _ in leaves]
    level = [(digest, [i]) for i, digest in enumerate(leaves)]
    while len(level) > 1:
        above = []
        for start in range(0, len(level), 3):
            run = level[start : start + 3]
            for place, (_, below) in enumerate(run):
                for i in below:
                    paths[i].append((place, [d for d, _ in run[:place] + run[place + 1 :]]))
            above.append((h(*[d for d, _ in run]), [i for _, below in run for i in below]))
        level = above
    return level[0][0], paths


def expected(rows):
    by_source = {}
    for r in rows:
        by_source.setdefault(r["source"], []).append(r)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    key = lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r))
    groups = [sorted(by_source[s], key=key) for s in order]
    inner = [tree([leaf_of(r) for r in g]) for g in groups]
    root, outer = tree([top for top, _ in inner]) if inner else (None, [])
    found = []
    for g, (subroot, paths), last in zip(groups, inner, outer):
        for r, path in zip(g, paths):
            path = path + last
            digest = leaf_of(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0 and r["text"] is not None:
                digest = leaf_of(r, text=r["text"].replace("\n", ""))
            for place, siblings in path:
                digest = h(*siblings[:place], digest, *siblings[place:])
            proof = h(*[s for _, siblings in path for s in siblings])
            found.append((r["doc_id"], leaf_of(r), subroot, root, proof, digest, digest == root))
    return sorted(found, key=str)


def result(df):
    assert df.columns == NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{MIDDLE}/documents.parquet").collect()
    found = result(op11_merkle(spark, MIDDLE))
    assert found == expected(rows)
    assert 0 < sum(not r[-1] for r in found) < len(found)


def test_edge_cases(spark, tmp_path):
    given = edge_documents(spark)
    rows = [(i, "a\nb", "en", s, 3) for i, s in [(20, ""), (21, ""), (22, "é"), (23, "z"), (-4, "z"), (None, "z"), (2**62, "z")]]
    given = given.unionByName(spark.createDataFrame(rows, DOCUMENTS)).withColumn("witness", given["doc_id"])
    given = given.withColumn("size", given["doc_id"])
    found = op11_merkle(spark, folder(spark, tmp_path, documents=given.repartition(3)))
    assert result(found) == expected(given.collect())


def test_no_documents(spark, tmp_path):
    assert result(op11_merkle(spark, folder(spark, tmp_path, documents=empty(spark)))) == []


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 26, 27, 28, 83, 250])
def test_rounds_of_small_blocks(spark, monkeypatch, size):
    """Blocks of 9 leaves: several rounds, with partial and lone runs at every level."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    draw = random.Random(size)
    rows = [(i, f"t{i}\n", None, draw.choice("aab"), i) for i in range(size)]
    given = spark.createDataFrame(rows, DOCUMENTS).repartition(3)
    found = merkle.verified(merkle.manifest(given)).select("doc_id", "proof_sha256", "folded_root", "verified")
    wanted = sorted(((r[0], *r[4:]) for r in expected(given.collect())), key=str)
    assert sorted((tuple(r) for r in found.collect()), key=str) == wanted


def test_appended_witnesses_fold_to_the_top():
    for size in [*range(1, 40), 81, 82, 200]:
        appender = merkle.Appender()
        leaves = [hashlib.sha256(str(i).encode()).digest() for i in range(size)]
        for leaf in leaves:
            appender.append(leaf)
        top = appender.close(merkle.levels_of(size))
        for i, (leaf, witness) in enumerate(zip(leaves, appender.witnesses)):
            assert merkle.fold(leaf, i, size, witness) == (top, len(witness))
            assert size == 1 or merkle.fold(leaves[i - 1], i, size, witness)[0] != top
