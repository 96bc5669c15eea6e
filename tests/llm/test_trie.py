from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from cuadre.llm import trie
from cuadre.llm.queries import op13_trie
from tests.llm.tables import MIDDLE, SMALL, empty, folder

TURNS = "conv_id long, turn long, role string, text string, depth string"


def digest(turn):
    role, text = turn
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()


def conversations(rows):
    found = {}
    for r in rows:
        if r["conv_id"] is not None:
            found.setdefault(r["conv_id"], []).append((r["turn"], (r["role"] or "", r["text"] or "")))
    key = lambda x: (x[0] is not None, x[0] or 0, digest(x[1])[:16])
    original = {c: [t for _, t in sorted(turns, key=key)] for c, turns in found.items()}
    rebuilt = {}
    for c, turns in original.items():
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = original.get(c - (c % 5 if c >= 0 else -(-c % 5)), [])[:h] + turns[h:]
    return rebuilt


def expected(paths):
    members = {}
    for c, turns in paths.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    sums = {}
    for node in sorted(members, key=len, reverse=True):
        below = [sums[x] for x in children.get(node, [])]
        own = (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        sums[node] = (sum(x[0] for x in below) or 1, own + sum(x[1] for x in below))
    found = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(paths[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        ends_sha256 = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        found.append((min(ids), len(node), parent, len(ids), len(children.get(node, [])), *sums[node], ends_sha256))
    return sorted(found, key=str)


def result(df):
    assert df.columns == trie.NODE_NAMES
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    for sf_dir in (SMALL, MIDDLE):
        rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").collect()
        assert result(op13_trie(spark, sf_dir)) == expected(conversations(rows))


def edge_turns(spark):
    rows = [(c, t, "user" if t % 2 else "assistant", f"é{t}", "x") for c in range(40, 60) for t in range(c % 7)]
    rows += [(0, None, None, None, "x"), (0, 1, "user", "", "x"), (0, 1, "user", "", "x"), (1, 0, "user", "a", "x"), (1, None, "user", "b", "x")]
    rows += [(None, 0, "user", "no id", "x"), (-3, 0, "user", "minus", "x"), (-3, 1, "user", "minus", "x"), (-5, 0, "user", "minus", "x")]
    rows += [(2**62, 0, "user", "x" * 300_000, "x"), (7, 0, "us", "era", "x"), (8, 0, "user", "a", "x"), (8, 0, "user", "b", "x")]
    rows += [(100 + c, t, "system", "long", "x") for c in (0, 1, 5) for t in range(300)]
    return spark.createDataFrame(rows, TURNS)


def test_edge_cases(spark, tmp_path):
    given = edge_turns(spark)
    found = result(op13_trie(spark, folder(spark, tmp_path, conversations=given.repartition(3))))
    paths = conversations(given.collect())
    assert [] in paths.values()
    assert found == expected(paths)


def test_no_conversations(spark, tmp_path):
    given = empty(spark, "conv_id long, turn long, role string, text string")
    assert result(op13_trie(spark, folder(spark, tmp_path, conversations=given))) == []


def drawn(seed):
    """Paths with shared beginnings, copies, beginnings of others, and empty ones."""
    draw = random.Random(seed)
    paths = {}
    for c in range(120):
        base = list(paths[draw.choice(list(paths))]) if paths and draw.random() < 0.7 else []
        base = base[: draw.randrange(len(base) + 1)] if draw.random() < 0.6 else base
        paths[c * 3] = base + [("user", draw.choice(["a", "bb", "é"])) for _ in range(draw.choice([0, 0, 1, 2, 9]))]
    return paths


def packed(turns):
    return b"".join(digest(t)[:16] + len(t[1].encode()).to_bytes(8, "big") for t in turns)


@pytest.mark.parametrize("container", [1, 5, 40, 10_000])
def test_bursts_do_not_change_the_nodes(spark, container):
    paths = drawn(container)
    rows = [(c, bytearray(packed(turns))) for c, turns in paths.items()]
    given = spark.createDataFrame(rows, "conv_id long, path binary").repartition(3)
    assert result(trie.nodes(given, container)) == expected(paths)


def test_ids_of_copies_are_hashed_in_order(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK_IDS", 7)
    rows = [(c, bytearray(packed([("user", "x")] * (c % 2)))) for c in range(-5, 500)]
    given = spark.createDataFrame(rows, "conv_id long, path binary").repartition(6)
    paths = {c: [("user", "x")] * (c % 2) for c in range(-5, 500)}
    assert result(trie.nodes(given)) == expected(paths)
