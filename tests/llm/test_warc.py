"""WARC bundles: exact round trip, random access, seek table."""

import hashlib
import io

import pyarrow.fs
import pytest
import zstandard

from lapse.llm import warc

LONG = "<html>" + "é" * 80 + "</html>"
PAGES = [(5, "http://a.org/", LONG), (3, "http://b.org/x y\r\nz", LONG), (3, "http://b.org/", LONG), (9, None, LONG), (None, "u", LONG),
         (1, "", "short"), (2, "x", "short"), (4, "x", None), (6, "x", ""), (7, "中文", "\r\n\r\nWARC/1.1\r\n\r\n" * 20),
         (8, "x", "z" * 700_000), (10, "x", "a" * 100), (11, "x", "a" * 100), (12, "x", "b" * 99), (13, "x", "b" * 99)]


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id long, url string, html string").selectExpr("*", "'x' AS digest", "1 AS refers_to", "2 AS n")


def test_round_trip(spark, pages, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "FRAME_BYTES", 500)
    folder = str(tmp_path)
    index = warc.write_bundles(warc.with_revisits(pages), folder)
    got = warc.read_bundles(index, folder).collect()
    want = []
    for page, _, html in PAGES:
        body = (html or "").encode()
        same = [p for p, _, h in PAGES if p is not None and (h or "").encode() == body]
        first = min(same) if same else None
        revisit = len(body) >= 100 and page is not None and page > first
        want.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None,
                     None if revisit else body))
    assert sorted(map(str, want)) == sorted(str((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"],
                                                 None if r["payload"] is None else bytes(r["payload"]))) for r in got)


def test_fetch_reads_single_records(spark, pages, tmp_path):
    folder = f"file://{tmp_path}"
    index = warc.write_bundles(warc.with_revisits(pages), folder)
    assert index.count() == len(PAGES)
    rows = warc.fetch_records(index.where("page_id IN (7, 8, 11)"), folder).collect()
    assert sorted((r["page_id"], r["record_type"], r["payload_bytes"]) for r in rows) == [
        (7, "response", len(PAGES[9][2])), (8, "response", 700_000), (11, "revisit", 100)]


def test_frames_are_independent_and_standard(tmp_path):
    fs = pyarrow.fs.LocalFileSystem()
    bundle = warc.BundleWriter(fs, str(tmp_path))
    records = [warc.make_record(i, f"http://h/{i}", bytes([65 + i]) * 200_000, None) for i in range(6)]
    for i, r in enumerate(records):
        bundle.add(i, r)
    index = bundle.close()
    raw = (tmp_path / bundle.name).read_bytes()
    # a plain reader sees one stream of all records and skips the table
    reader = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw), read_across_frames=True)
    assert reader.read() == b"".join(records)
    with fs.open_input_file(str(tmp_path / bundle.name)) as f:
        frames = warc.read_seek_table(f)
    assert len(frames) > 1 and sum(n for _, _, n in frames) == sum(map(len, records))
    for page, _, frame, frame_at, size, at, length in index:
        assert frames[frame][:2] == (frame_at, size)
        data = zstandard.ZstdDecompressor().decompress(raw[frame_at:frame_at + size])
        assert data[at:at + length] == records[page]


def test_damage_is_noticed():
    r = bytearray(warc.make_record(1, "u", b"payload", None))
    r[-6] ^= 1
    with pytest.raises(ValueError):
        warc.parse_record(bytes(r), 0)


def test_empty_table(spark, pages, tmp_path):
    index = warc.write_bundles(warc.with_revisits(pages.where("page_id < 0")), str(tmp_path))
    assert warc.read_bundles(index, str(tmp_path)).count() == 0
