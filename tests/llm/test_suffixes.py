from __future__ import annotations

import random

import pytest

from cuadre.llm import merge_sort, suffixes
from cuadre.llm.common import written
from cuadre.llm.queries import op4_suffixes
from tests.llm.tables import EDGE_TEXTS, SMALL, documents, edge_documents, empty, folder, removal, repeated_bytes, texts_of


def edited(draw, text, edits):
    text = bytearray(text, "ascii")
    for _ in range(edits):
        at = draw.randrange(len(text))
        text[at : at + draw.choice((0, 1, 2))] = bytes(draw.choice(b"abcdefgh ") for _ in range(draw.choice((0, 1, 2))))
    return text.decode()


def family(seed, count=24):
    """Texts with shared passages in varying surroundings, near copies, copies and runs of one letter."""
    draw = random.Random(seed)
    word = lambda n: "".join(draw.choice("abcdefgh ") for _ in range(n))
    base, passage = word(400), word(70)
    texts = [edited(draw, base, draw.randrange(8)) for _ in range(count)]
    texts += [word(draw.randrange(60)) + passage[draw.randrange(10) : 55 + draw.randrange(15)] + word(draw.randrange(60)) for _ in range(count)]
    texts += ["a" * 130, "ab" * 70, base, base, word(300), "", word(47), passage * 3]
    return texts


def check(found, texts, length):
    raw = [(t or "").encode() for t in texts]
    want = [removal(t, c) for t, c in zip(raw, repeated_bytes(raw, length))]
    for row in found:
        text = raw[row["doc_id"]]
        runs = [(x["begin"], x["end"]) for x in row["removed"]]
        covered = [any(a <= i < b for a, b in runs) for i in range(len(text))]
        assert removal(text, covered) == want[row["doc_id"]], row["doc_id"]
        assert bytes(row["kept"]) == bytes(b for b, c in zip(text, covered) if not c)
    assert len(found) == len(texts)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_brute_force(spark, monkeypatch, seed):
    # small ranges and runs, so that nodes reach over several parts
    monkeypatch.setattr(merge_sort, "ranges_for", lambda rows: rows // 12)
    monkeypatch.setattr(merge_sort, "RUN_ROWS", 20)
    texts = family(seed)
    docs = documents(spark, texts).repartition(3)
    check(suffixes.remove_repeats(docs, 48).collect(), texts, 48)


def test_query_on_documents(spark):
    texts = texts_of(spark, SMALL)
    raw = [t.encode() for t in texts.values()]
    want = dict(zip(texts, (removal(t, c) for t, c in zip(raw, repeated_bytes(raw, 400)))))
    found = op4_suffixes(spark, SMALL).collect()
    assert {r[0]: tuple(r)[1:5] for r in found} == want
    assert all(len(r["text"].encode()) == r["n_bytes"] - r["n_removed"] or "\ufffd" in r["text"] for r in found)


def test_edge_cases(spark, tmp_path):
    found = op4_suffixes(spark, folder(spark, tmp_path, documents=edge_documents(spark))).collect()
    raw = [(t or "").encode() for _, t, _ in EDGE_TEXTS]
    rows = zip(EDGE_TEXTS, raw)
    # the long texts repeat themselves wholly; nothing else has 400 bytes
    want = sorted((str(x[0]), *removal(t, [len(t) >= 400] * len(t))) for x, t in rows)
    assert sorted((str(r[0]), *r[1:5]) for r in found) == want


def test_repeated_rows_are_occurrences(spark):
    text = "".join(random.Random(1).choice("abcdefgh ") for _ in range(120))
    docs = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert [bytes(r["kept"]) for r in suffixes.remove_repeats(docs, 48).collect()] == [b"", b""]


def test_empty_table_and_clashing_columns(spark):
    assert suffixes.remove_repeats(empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "a" * 100, "x", 5)], "doc_id long, text string, kept string, row_a int")
    row = suffixes.remove_repeats(docs, 48).first()
    assert bytes(row["kept"]) == b"" and row["removed"][0]["end"] == 100


@pytest.mark.parametrize("ranges", [1, 4])
def test_merge_sort(spark, monkeypatch, ranges):
    monkeypatch.setattr(merge_sort, "RUN_ROWS", 7)
    monkeypatch.setattr(merge_sort, "ranges_for", lambda rows: ranges)
    draw = random.Random(ranges)
    rows = [(bytes(draw.choice(b"ab") for _ in range(draw.randrange(12))), draw.randrange(3), i) for i in range(300)]
    df = written(spark.createDataFrame(rows, "k binary, s long, n int").repartition(5), "strings")
    found = merge_sort.merge_sorted(df, "k", "s", ["n"]).orderBy("part", "place").collect()
    assert [(bytes(r["k"]), r["s"]) for r in found] == sorted((k, s) for k, s, _ in rows)
    assert sorted((bytes(r["k"]), r["s"], r["n"]) for r in found) == sorted(rows)
    for a, b in zip(found, found[1:]):
        assert b["lcp"] == (merge_sort.common_prefix(a["k"], b["k"]) if a["part"] == b["part"] else 0)
    assert (len({r["part"] for r in found}) > 1) == (ranges > 1)


def test_loser_tree_does_not_read_known_prefixes(monkeypatch):
    seen = []
    own = merge_sort.common_prefix
    monkeypatch.setattr(merge_sort, "common_prefix", lambda a, b, known=0: seen.append(known) or own(a, b, known))
    strings = [[(b"x" * 50 + bytes([65 + i, 65 + k]), 0, None) for k in range(20)] for i in range(4)]
    lcps = [[0] + [51] * 19 for _ in strings]
    merged = list(merge_sort.LoserTree(strings, lcps))
    assert [x[1][0] for x in merged] == sorted(x[0] for run in strings for x in run)
    assert seen.count(0) <= 3 and max(seen) >= 50  # only the first round starts at the first byte


def test_minimizers_depend_on_windows_alone():
    draw = random.Random(9)
    shared = bytes(draw.choice(b"abcd") for _ in range(200))
    places = []
    for _ in range(2):
        before = bytes(draw.choice(b"abcd") for _ in range(draw.randrange(90)))
        place, first, last, seed = suffixes.anchors(before + shared, 48)
        windows = {i: int(p) for p, a, b in zip(place, first, last) for i in range(a, b + 1)}
        places.append([windows[len(before) + i] - len(before) for i in range(len(shared) - 47)])
    assert places[0] == places[1]
