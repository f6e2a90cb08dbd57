"""WARC archives: exact round trips, checked lengths, dictionary frames."""

import base64
import hashlib
import io
import struct

import pytest

from cohortspark.llm import warc
from cohortspark.llm.common import prepare, shared_folder


def archive(records):
    out = io.BytesIO()
    out.close, kept = (lambda: None), out
    writer = warc.Writer(out)
    for r in records:
        writer.add(r)
    writer.close()
    return kept.getvalue()


def pages(n):
    return [warc.record(k, f"http://a.example/{k}", (f"<p>page {k}</p>" + "common words here " * (k % 9)).encode(), None) for k in range(n)]


def test_frames_with_and_without_dictionary():
    for n, leads in ((3, False), (500, True)):
        data = archive(pages(n))
        assert (struct.unpack("<I", data[:4])[0] == warc.SKIPPABLE) == leads
        assert list(warc.frames(io.BytesIO(data))) == pages(n)
    assert list(warc.frames(io.BytesIO(b""))) == []


def test_small_chunks_and_cut_archives(monkeypatch):
    data = archive(pages(300))
    monkeypatch.setattr(warc, "CHUNK", 13)
    assert list(warc.frames(io.BytesIO(data))) == pages(300)
    for cut in (len(data) - 3, 20):
        with pytest.raises(Exception):
            list(warc.frames(io.BytesIO(data[:cut])))


def test_records_are_checked():
    good = warc.record(7, "u", "Straße\r\n\r\nx".encode(), None)
    assert warc.parse(good)["payload"] == "Straße\r\n\r\nx".encode() and warc.parse(good)["page_id"] == 7
    again = warc.parse(warc.record(8, "u\r\nX: 1", b"abc", 7))
    assert again["refers_to"] == 7 and again["payload"] is None and again["payload_bytes"] == 3 and again["url"] == "u%0D%0AX: 1"
    for bad in (good[:-1], good.replace(b"WARC/1.1", b"WARC/9"), good.replace(b"Content-Length: ", b"Content-Length: 1", 1), good.replace(b"x\r\n\r\n", b"y\r\n\r\n"), good.replace(b"WARC-Date: ", b"Other: ")):
        with pytest.raises(ValueError):
            warc.parse(bad)


def test_table(spark):
    rows = [(5, "a", "same"), (3, None, "same"), (9, "b", "same"), (3, "c", "same"), (1, "d", None), (2, "e", ""), (None, "f", "same"), (4, "g", "ü" * 300_000), (6, "h", "own")]
    rows += [(100 + k, f"http://x/{k}", f"<p>{k % 70}</p>" * 50) for k in range(400)]
    df = prepare(spark).createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = shared_folder(spark, "warc-test")
    marked = warc.mark_revisits(df)
    archives = warc.write_archives(marked, folder, archive_bytes=60_000)
    assert archives.count() > 3
    least = {}
    for k, _, t in rows:
        if k is not None:
            least[t or ""] = min(least.get(t or "", k), k)
    want = []
    for k, u, t in rows:
        raw = (t or "").encode()
        other = least[t or ""] if k is not None and least[t or ""] != k else None
        sha = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        want.append((k, u, len(raw), sha, "revisit" if other is not None else "response", other, None if other is not None else raw))
    got = [(*r[:6], None if r[6] is None else bytes(r[6])) for r in warc.read_archives(archives).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    small = warc.mark_revisits(df, least_bytes=100).filter("refers_to is not null and length(html) < 100")
    assert small.count() == 0
    assert warc.archive_and_read(df.limit(0)).collect() == []


def test_lost_records_are_noticed(spark):
    df = prepare(spark).createDataFrame([(k, "u", f"t{k}") for k in range(20)], "page_id long, url string, html string")
    archives = warc.write_archives(warc.mark_revisits(df), shared_folder(spark, "warc-test"))
    with pytest.raises(Exception, match="were written"):
        warc.read_archives(archives.withColumn("records", archives["records"] + 1)).collect()
