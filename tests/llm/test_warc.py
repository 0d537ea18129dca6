from __future__ import annotations

import hashlib

import zstandard

from pluvio.llm import queries, warc
from pluvio.llm.common import staged
from pluvio.session import fresh_path
from tests.llm.conftest import same_rows


def awkward_pages(spark):
    big, other = "<p>" + "x" * 2000 + "</p>", "<p>" + "é" * 700 + "</p>"
    rows = [(1, "http://a/ b\r\nc", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", other), (9, "u", other), (5, "u", "short"), (6, "u", "short"), (7, "u", ""), (8, "u", None), (None, "u", "alone" * 400), (11, "u", "long" * 300_000)]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id bigint, url string, html string, digest string, same int")


def test_query_equals_sql(spark, as_tables):
    folder, database = as_tables(pages=awkward_pages(spark))
    assert same_rows(queries.op4_warc(spark, folder), database.sql(queries.OP4_SQL))


def test_empty_table(spark, as_tables):
    folder, _ = as_tables(pages=awkward_pages(spark).limit(0))
    assert queries.op4_warc(spark, folder).count() == 0


def test_frames_are_independent_and_found_by_the_footer(tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME", 5000)
    writer = warc.BundleWriter(str(tmp_path))
    payloads = [(f"<p>{i}</p>" * (i * 7)).encode() for i in range(120)]
    places = [writer.add(warc.record(i, "http://x", p, hashlib.sha1(p).hexdigest(), None)) for i, p in enumerate(payloads)]
    writer.close()
    reader = warc.BundleReader(writer.path)
    assert len(reader.frames) > 20
    for i in (119, 0, 57, 3):
        assert reader.read(*places[i][1:])["payload"] == payloads[i]
    raw = open(writer.path, "rb").read()
    start, packed, plain = reader.frames[4]
    assert len(zstandard.ZstdDecompressor().decompress(raw[start : start + packed], max_output_size=plain)) == plain
    # A plain decoder skips the seek table and reads all frames in order.
    whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
    assert whole.count(b"WARC/1.1\r\n") == 120


def test_read_returns_payloads(spark):
    index = staged(warc.write(warc.planned(awkward_pages(spark)), fresh_path(spark, "warc")), "index")
    rows = {(r.page_id, r.record_type): r for r in warc.read(index, 2).collect()}
    assert bytes(rows[11, "response"].payload) == b"long" * 300_000
    assert rows[1, "revisit"].payload is None and rows[1, "revisit"].refers_to == 3
    assert rows[1, "revisit"].url == "http://a/%20b%0D%0Ac"
