from __future__ import annotations

import random
import re

import pytest

from cuadre.llm import licences
from cuadre.llm.queries import op8_licences
from tests.llm.tables import EDGE_TEXTS, SMALL, documents, edge_documents, empty, folder, texts_of

PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    places, labels = [], set()
    for phrase, label in PHRASES.items():
        parts = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        places += at
        labels |= {label} if at else set()
    ends = (min(places), max(places)) if places else (None, None)
    return (len(words), len(places), *ends, ",".join(sorted(labels)))


def check(row, text):
    assert tuple(row)[1:6] == base(text), row["doc_id"]
    assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
    assert row["labels"] == ",".join(sorted(set(row["labels"].split(",")))) and 0 <= row["score"] <= 1


def test_query_on_documents(spark):
    texts = texts_of(spark, SMALL)
    found = op8_licences(spark, SMALL).collect()
    assert len(found) == len(texts)
    for row in found:
        check(row, texts[row["doc_id"]])


def test_base_places_in_random_texts(spark, tmp_path):
    draw = random.Random(4)
    words = ["CC", "by", "cc-BY", "General", "public", "license.", "all", "rights", "RESERVED", "é", "K", "_"]
    texts = [draw.choice(" \n,-").join(draw.choice(words) for _ in range(draw.randrange(60))) for _ in range(60)]
    texts += ["cc by", "all rights reserved all rights reserved", "general public licensee", None, ""]
    found = op8_licences(spark, folder(spark, tmp_path, documents=documents(spark, texts))).collect()
    for row in found:
        check(row, texts[row["doc_id"]])


def test_edge_cases(spark, tmp_path):
    found = op8_licences(spark, folder(spark, tmp_path / "a", documents=edge_documents(spark))).collect()
    assert len(found) == len(EDGE_TEXTS)
    for row in found:
        check(row, next(t for i, t, _ in EDGE_TEXTS if i == row["doc_id"]))
    assert op8_licences(spark, folder(spark, tmp_path / "b", documents=empty(spark))).count() == 0


@pytest.mark.parametrize("template", licences.NOTICES, ids=lambda t: t.text[:30])
def test_notices_are_found_whole_and_with_gaps(template):
    words = licences.words_of(template.text.encode())
    frequency = {b"the": 900, b"to": 800, b"and": 900, b"of": 900, b"a": 900, b"in": 700}
    index = licences.Index(licences.TEMPLATES, frequency, 1000)
    found = index.find([b"before"] * 3 + words + [b"after"])
    assert (template.label, False, 3, len(words), 1.0) in found
    if len(words) > 12:  # a word of little weight may be another
        common = next(i for i in range(len(words) - 1, 0, -1) if words[i] in frequency)
        changed = [*words[:common], b"other", *words[common + 1 :]]
        assert any(f[0] == template.label and f[4] < 1 for f in index.find(changed))


def test_mandatory_phrases_must_stand_whole():
    index = licences.Index(licences.TEMPLATES, {}, 1000)
    words = licences.words_of(b"licensed under the apache licence version 2 0")
    assert not [f for f in index.find(words) if f[0] == "apache-2.0"]


def test_anchors_are_enough():
    """No alignment with enough weight lacks all anchors: found equals a search at every place."""
    draw = random.Random(7)
    frequency = {w: draw.randrange(1000) for t in licences.TEMPLATES for w in licences.words_of(t.text.encode())}
    index = licences.Index(licences.TEMPLATES, frequency, 1000)
    everywhere = licences.Index(licences.TEMPLATES, frequency, 1000)
    for k, words in enumerate(everywhere.words):
        for i, word in enumerate(words):
            if (k, i) not in everywhere.postings[word]:
                everywhere.postings[word].append((k, i))
    for _ in range(200):
        words = []
        for _ in range(4):
            part = list(draw.choice(index.words))
            for _ in range(draw.randrange(3)):
                part[draw.randrange(len(part))] = b"other"
            words += part[draw.randrange(2) :] + [b"between"]
        assert index.find(words) == everywhere.find(words)


@pytest.mark.parametrize("template", licences.NOTICES, ids=lambda t: t.label + ": " + t.text[:30])
def test_notices_with_a_word_put_in_or_left_out(template):
    words = licences.words_of(template.text.encode())
    keys = {w for phrase in template.key_phrases for w in phrase.encode().split()}
    index = licences.Index(licences.TEMPLATES, {w: 900 for w in words if w not in keys}, 1000)
    before = [b"before"] * 4
    for at in range(1, len(words)):
        text = before + words[:at] + [b"other"] + words[at:] + [b"after"] * 4
        whole = all(b" %s " % p.encode() in b" %s " % b" ".join(text) for p in template.key_phrases)
        finds = [f for f in index.find(text) if f[0] == template.label]
        assert bool(finds) == whole
        # one occurrence is one find of its template, at its place or shifted by the word
        own = [f for f in finds if f[3] == len(words)]
        assert not own or (len(own) == 1 and abs(own[0][2] - 4) <= licences.BAND)
        if words[at] not in keys:
            finds = index.find(before + words[:at] + words[at + 1 :] + [b"after"])
            assert template.label in {f[0] for f in finds}


def test_share_in_the_band_against_every_choice_of_places():
    """The most weight over all increasing choices of places within the band."""
    draw = random.Random(11)

    def most(words, there, weights, start, i=0, after=-1):
        if i == len(there):
            return 0.0
        found = most(words, there, weights, start, i + 1, after)
        for at in range(max(start + i - licences.BAND, after + 1, 0), min(start + i + licences.BAND + 1, len(words))):
            if words[at] == there[i]:
                found = max(found, weights[i] + most(words, there, weights, start, i + 1, at))
        return found

    seen = 0
    for _ in range(400):
        there = [draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(6)]
        template = licences.Template("x", b" ".join(there).decode(), (there[0].decode(),))
        index = licences.Index([template], {b"a": 5, b"b": 50}, 100)
        words = [draw.choice([b"a", b"b", b"c", b"d", b"e"]) for _ in range(draw.randrange(12))]
        for start in range(-3, len(words)):
            share, _ = index.shares(words, 0, start)
            expected = most(words, there, index.weights[0], start) / sum(index.weights[0])
            if share or expected >= licences.LEAST_MATCH:
                assert share == pytest.approx(expected)
                seen += 1
    assert seen > 100


def test_places_of_a_repeated_notice():
    index = licences.Index(licences.TEMPLATES, {}, 1000)
    words = licences.words_of(b"released under the mit license")
    found = index.find((words + [b"and"]) * 3)
    assert [f[2] for f in found if f[0] == "mit"] == [0, 6, 12]
