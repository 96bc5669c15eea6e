from __future__ import annotations

import base64
import hashlib
import io
import random
import zlib

import pytest

from cuadre.llm import warc
from cuadre.llm.common import new_folder
from cuadre.llm.queries import op7_warc
from tests.llm.tables import SMALL, empty, folder

PAGES = "page_id long, url string, html string, extra int"


def pages(spark):
    draw = random.Random(3)
    bodies = ["", "<p>one</p>", "é" * 300, None, "<p>two</p>", "x" * 400_000]
    rows = [(i, f"http://{draw.choice('abc')}.example.org/{draw.randrange(9)}?Q=1", draw.choice(bodies), 1) for i in range(60)]
    rows += [(60, None, "last", 1), (61, "http://[broken", "odd url", 1), (62, "http://x y/\r\nA: b", "odd url", 1)]
    rows += [(63, "http://z/", "repeated row", 1), (63, "http://z/", "repeated row", 1), (None, "http://z/", "no id", 1)]
    return spark.createDataFrame(rows, PAGES)


def expected(rows):
    first = {}
    for r in rows:
        body = r["html"] or ""
        if r["page_id"] is not None:
            first[body] = min(first.get(body, r["page_id"]), r["page_id"])
    out = []
    for r in rows:
        body = (r["html"] or "").encode()
        least = first.get(r["html"] or "")
        again = least is not None and r["page_id"] != least
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((str(r["page_id"]), len(body), digest, "revisit" if again else "response", least if again else None))
    return sorted(out, key=str)


def result(rows):
    names = ("payload_bytes", "payload_digest", "record_type", "refers_to")
    return sorted(((str(r["page_id"]), *(r[n] for n in names)) for r in rows), key=str)


def test_query_on_edge_cases(spark, tmp_path):
    given = pages(spark).repartition(4)
    found = op7_warc(spark, folder(spark, tmp_path, pages=given)).collect()
    assert result(found) == expected(given.collect())


def test_histories_are_in_global_order(spark, tmp_path):
    found = op7_warc(spark, folder(spark, tmp_path, pages=pages(spark).repartition(4))).collect()
    places = sorted(found, key=lambda r: (r["part"], r["place"]))
    keys = [(r["url_key"].encode(), r["seconds"], 2**63 if r["page_id"] is None else r["page_id"]) for r in places]
    assert keys == sorted(keys)


def test_query_on_pages(spark):
    given = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert result(op7_warc(spark, SMALL).collect()) == expected(given)


def test_archives_hold_the_payloads_and_their_places(spark):
    given = pages(spark).where("page_id < 10")
    archives = warc.write_archives(given, new_folder(spark, "warc"))
    found = warc.read_archives(archives, payload=True).collect()
    bodies = {r["page_id"]: (r["html"] or "").encode() for r in given.collect()}
    for r in found:
        assert bytes(r["payload"]) == (bodies[r["page_id"]] if r["record_type"] == "response" else b"")
        with open(r["archive"], "rb") as file:
            file.seek(r["offset"])
            content = zlib.decompress(file.read(r["length"]), 31)
        assert warc.page_of(warc.parse_record(content)["WARC-Record-ID"]) == r["page_id"]
    assert sum(r["records"] for r in archives.collect()) == len(found) == 10


def test_least_size_of_revisited_payloads(spark):
    given = spark.createDataFrame([(1, "u", "ab", 1), (2, "u", "ab", 1), (3, "u", "abc", 1), (4, "u", "abc", 1)], PAGES)
    found = warc.read_archives(warc.write_archives(given, new_folder(spark, "warc"), least_bytes=3)).collect()
    assert {r["page_id"]: r["refers_to"] for r in found} == {1: None, 2: None, 3: None, 4: 3}


def test_damage_is_noticed():
    good = warc.record(1, "http://a/", b"payload", None)
    content = zlib.decompress(good, 31)
    with pytest.raises(ValueError, match="damaged"):
        warc.parse_record(content.replace(b"payload\r\n\r\n", b"pbyload\r\n\r\n"))
    with pytest.raises(ValueError, match="ends within"):
        list(warc.members(io.BytesIO(good[:-9])))


def test_empty_table(spark, tmp_path):
    assert op7_warc(spark, folder(spark, tmp_path, pages=empty(spark, PAGES))).count() == 0


def test_every_long_is_a_page_id(spark, tmp_path):
    ids = [-(2**63), -(2**62), -(10**12), -1, 0, 10**12, 2**62, 2**63 - 1]
    given = spark.createDataFrame([(i, "http://a/", f"body {i}", 1) for i in ids], PAGES)
    found = op7_warc(spark, folder(spark, tmp_path, pages=given.repartition(3))).collect()
    assert result(found) == expected(given.collect())
    assert [r["page_id"] for r in sorted(found, key=lambda r: (r["part"], r["place"]))] == ids
