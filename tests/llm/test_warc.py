"""Archives: exact round trip, revisits, and damage that the reader must notice."""

import base64
import gzip
import hashlib
import io
import tracemalloc
import zlib

import pytest

from tarnlake.llm import warc

SCHEMA = "page_id long, url string, html string, digest string, payload string, first long"


def _back(spark, rows, **kw):
    folder, manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA), **kw)
    return warc.read_archives(folder, manifest).collect(), manifest


def test_round_trip(spark):
    big, same = "é" * 300_000, "x" * 100
    html = {1: "<p>ä</p>", 2: None, 3: "", 4: same, 5: same, 9: same, 6: "y" * 99, 7: "y" * 99, 8: big, 10: "\r\n\r\nWARC/1.1\r\n\r\n"}
    rows = [(k, f"http://h/{k} a\r\nb" if k % 2 else None, v, "no", "no", 0) for k, v in html.items()] + [(None, "u", same, "", "", 0), (4, "again", same, "", "", 0)]
    got, manifest = _back(spark, rows, archive_bytes=2_000)
    assert manifest.count() > 1 and len(got) == len(rows)
    for r in got:
        data = (html[r["page_id"]] if r["page_id"] is not None else same) or ""
        data = data.encode()
        assert r["payload_bytes"] == len(data) and r["payload_digest"] == hashlib.sha256(data).hexdigest() and r["verified"]
        if r["page_id"] in (5, 9):
            assert (r["record_type"], r["refers_to"], r["payload"]) == ("revisit", 4, None)
        else:
            assert (r["record_type"], r["refers_to"], bytes(r["payload"])) == ("response", None, data)
        assert r["url"] is None or not set(r["url"]) & set(" \r\n")


def test_empty_table(spark):
    got, manifest = _back(spark, [])
    assert got == [] and manifest.count() == 0


def _member(payload=b"hello"):
    return warc.encode_record(3, "http://a/", payload, hashlib.sha256(payload).hexdigest(), None)


def test_records_are_members_of_their_own():
    data = _member() + _member(b"z" * 1_000_000)
    assert [r["payload_bytes"] for r in warc.read_records(io.BytesIO(data))] == [5, 1_000_000]
    assert gzip.decompress(data).count(b"WARC/1.1") == 2
    assert len(zlib.decompressobj(31).decompress(data)) < 1_000


def _damaged(change):
    return zlib.compress(change(gzip.decompress(_member())), wbits=31)


@pytest.mark.parametrize(
    "data",
    [
        _member()[:-4],
        _member()[:40] + b"\0" + _member()[41:],
        _damaged(lambda x: x.replace(b"hello", b"hallo")),
        _damaged(lambda x: x[:-4]),
        _damaged(lambda x: x + b"more"),
        _damaged(lambda x: x.replace(b"WARC/1.1", b"WORC/1.1")),
        _damaged(lambda x: x.replace(b"sha256:2c", b"sha256:00")),
        b"plain text",
    ],
)
def test_damage_is_noticed(data):
    with pytest.raises(warc.WarcError):
        list(warc.read_records(io.BytesIO(data)))


def test_every_cut_is_noticed():
    first, second = _member(), _member(b"z" * 300)
    for k in range(len(first + second)):
        if k == 0 or k == len(first):  # whole records; the manifest tells that some are missing
            assert len(list(warc.read_records(io.BytesIO((first + second)[:k])))) == (k > 0)
            continue
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO((first + second)[:k])))


def test_manifest_is_compared(spark):
    rows = [(k, f"http://h/{k}", f"p{k}" * 50, "", "", 0) for k in range(6)]
    folder, manifest = warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1))
    name = manifest.first()["archive"]
    assert warc.read_archives(folder, manifest.select("archive")).count() == 6
    path = f"{folder.removeprefix('file://')}/{name}"
    with open(path, "rb") as f:
        data = f.read()
    with open(path, "wb") as f:
        f.write(data[: data.rindex(b"\x1f\x8b\x08")])  # without the last record
    assert len(list(warc.read_records(open(path, "rb")))) < 6
    with pytest.raises(Exception, match="its manifest says 6"):
        warc.read_archives(folder, manifest).collect()


def test_urls_come_back(spark):
    urls = ["http://x/\u00e9", "http://\u4f8b\u3048.jp/%41?q=\U0001f600:a: b".replace(" ", ""), "no scheme", "", None]
    got, _ = _back(spark, [(i, u, "h", "", "", 0) for i, u in enumerate(urls)])
    assert {r["page_id"]: r["url"] for r in got} == dict(enumerate([*urls[:2], "no%20scheme", *urls[3:]]))


def _foreign(kind, block, *more, http=True):
    lines = ["WARC/1.0", f"WARC-Type: {kind}", "WARC-Record-ID: <urn:uuid:1>", f"Content-Length: {len(block)}", *more] + ["Content-Type: application/http; msgtype=x"] * http
    return gzip.compress("\r\n".join([*lines, "", ""]).encode() + block + b"\r\n\r\n")


def test_archives_of_other_tools():
    body = b"Wiki in chunks."
    chunked = b"4;x=y\r\nWiki\r\nb\r\n in chunks.\r\n0\r\nA: b\r\n\r\n"
    head = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: Chunked\r\n\r\n"
    sha1 = lambda x: "sha1:" + base64.b32encode(hashlib.sha1(x).digest()).decode()
    data = [
        _foreign("warcinfo", b"software: x\r\n", http=False),
        _foreign("request", b"GET / HTTP/1.1\r\nHost: a\r\n\r\n", "X-Folded: a", "  b"),
        _foreign("response", head + chunked, f"WARC-Payload-Digest: {sha1(chunked)}", f"WARC-Block-Digest: {sha1(head + chunked)}"),
        _foreign("response", head + chunked, f"WARC-Payload-Digest: {sha1(body)}", "WARC-Target-URI: http://a/"),
        _foreign("response", head + chunked, "WARC-Payload-Digest: md9:what"),
        _foreign("revisit", b"", "WARC-Refers-To: <urn:uuid:0>", f"WARC-Payload-Digest: {sha1(body)}"),
        _foreign("response", b"HTTP/1.0 200 OK\r\nContent-Length: 9\r\n\r\nabc", "WARC-Truncated: length"),
    ]
    got = list(warc.read_records(io.BytesIO(b"".join(data))))
    assert [r["record_type"] for r in got] == ["warcinfo", "request", "response", "response", "response", "revisit", "response"]
    assert [r["verified"] for r in got] == [False, False, True, True, False, False, False]
    assert [r["payload"] for r in got] == [b"software: x\r\n", b"", body, body, body, None, b"abc"]
    assert {r["page_id"] for r in got} | {r["refers_to"] for r in got} == {None} and got[3]["url"] == "http://a/"
    for bad in (
        _foreign("response", head + chunked, f"WARC-Payload-Digest: {sha1(b'other')}"),
        _foreign("response", b"HTTP/1.0 200 OK\r\nContent-Length: 9\r\n\r\nabc"),
        _foreign("response", head + chunked[:9]),
        _foreign("resource", b"abc", f"WARC-Block-Digest: {sha1(b'abd')}", http=False),
        gzip.compress(b"WARC/1.0\r\nWARC-Type: metadata\r\n\r\n\r\n\r\n"),
    ):
        with pytest.raises(warc.WarcError):
            list(warc.read_records(io.BytesIO(bad)))


def test_chunks_in_any_pieces():
    coded = b"3\r\nabc\r\n0a\r\n0123456789\r\n0\r\n\r\n"
    for n in range(1, len(coded) + 1):
        chunks = warc._Chunks()
        assert b"".join(chunks.add(coded[i : i + n]) for i in range(0, len(coded), n)) == b"abc0123456789" and chunks.over


def test_large_payloads_are_not_held():
    data = _member(b"\0" * 40_000_000)
    tracemalloc.start()
    (r,) = warc.read_records(io.BytesIO(data), payloads=False)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert r["payload_bytes"] == 40_000_000 and r["payload"] is None and peak < 8 << 20
