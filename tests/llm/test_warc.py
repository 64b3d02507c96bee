"""WARC archives: round trips and what the reader refuses."""

import base64
import hashlib

import pytest
import zstandard

from docflow.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest int"


def page(spark, rows):
    return spark.createDataFrame([(i, u, h, "clash", 1) for i, u, h in rows], SCHEMA)


def told(rows):
    return sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to, r.error) for r in rows), key=repr)


def test_round_trip(spark):
    html = [(1, "http://a/ä b\r\nc", "é" * 10), (2, None, None), (3, "u", ""), (4, "u", "é" * 10), (5, "u", "\r\n\r\nx\r\n"), (6, "u", "z" * 300_000), (6, "u", "z" * 300_000)]
    html += [(100 + i, "u", f"<p>{i % 40} some text of a page</p>" * 20) for i in range(200)]
    got = told(warc.round_trip(page(spark, html), archive_bytes=50_000).collect())
    first = {}
    for i, _, h in sorted(html, key=lambda r: r[0]):
        first.setdefault(h or "", i)
    want = []
    for i, _, h in html:
        b = (h or "").encode()
        origin = first[h or ""]
        want.append((i, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if origin == i else "revisit", None if origin == i else origin, None))
    assert got == sorted(want, key=repr)


def test_payloads_come_back(spark):
    rows = warc.round_trip(page(spark, [(1, "u", "<p>ä</p>"), (2, "u", "<p>ä</p>")])).orderBy("page_id").collect()
    assert bytes(rows[0].payload).decode() == "<p>ä</p>"
    assert rows[1].payload is None


def test_empty_table(spark):
    assert warc.round_trip(page(spark, [])).count() == 0


def archive(records, dictionary=b"", bare=False):
    held = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    packer = zstandard.ZstdCompressor(write_content_size=True, dict_data=held)
    head = b""
    if dictionary:
        head = warc.DICTIONARY_FRAME.to_bytes(4, "little") + len(dictionary).to_bytes(4, "little") + dictionary if bare else warc.dictionary_frame(dictionary)
    return head + b"".join(packer.compress(r) for r in records)


def records(n=30):
    return [warc.record_bytes(i, "http://x/", f"<html>page {i}</html>".encode() * 30, None, False, "2024-01-01T00:00:00Z") for i in range(n)]


@pytest.mark.parametrize("bare", [True, False])
def test_dictionaries(bare):
    dictionary = warc.train_dictionary([r + bytes([i]) * 3000 for i, r in enumerate(records(200))])
    assert dictionary
    got = list(warc.read_archive(archive(records(), dictionary, bare)))
    assert [r["page_id"] for r in got] == list(range(30))
    assert not any(r["error"] for r in got)


def test_archives_without_dictionary():
    assert len(list(warc.read_archive(archive(records())))) == 30
    assert list(warc.read_archive(b"")) == []


@pytest.mark.parametrize(
    ("change", "says"),
    [
        (lambda r: r.replace(b"WARC/1.1", b"WARC/9.9"), "version"),
        (lambda r: r.replace(b"Content-Length: ", b"Content-Length: 9", 1), "content-length"),
        (lambda r: r.replace(b"WARC-Type: response\r\n", b""), "warc-type"),
        (lambda r: r.replace(b"page 1", b"page 2"), "digest"),
        (lambda r: r[:-4], "content-length"),
        (lambda r: r.replace(b"WARC-Date: ", b"WARC-Date "), "header line"),
    ],
)
def test_broken_records_are_reported(change, says):
    rows = list(warc.read_archive(archive([records()[0], change(records()[1]), records()[2]])))
    assert [bool(r["error"]) for r in rows] == [False, True, False]
    assert says in rows[1]["error"].lower()


def test_cut_archives_are_reported():
    whole = archive(records(3))
    rows = list(warc.read_archive(whole[:-5]))
    assert rows[-1]["error"]
    assert list(warc.read_archive(b"\x00\x01\x02\x03rest"))[0]["error"]
    assert list(warc.read_archive(warc.dictionary_frame(b"x" * 100)[:20]))[0]["error"]


def read_ids(data):
    rows = list(warc.read_archive(data))
    return [r["page_id"] for r in rows if not r["error"]], [r["error"] for r in rows if r["error"]]


def test_streamed_frames_and_other_skippable_frames():
    own = records(6)
    streamed = zstandard.ZstdCompressor(write_content_size=False)
    frames = []
    for r in own:
        out = streamed.compressobj()
        frames.append(out.compress(r) + out.flush())
    skipped = (0x184D2A50).to_bytes(4, "little") + (5).to_bytes(4, "little") + b"later"
    assert read_ids(skipped + skipped.join(frames) + skipped) == ([0, 1, 2, 3, 4, 5], [])


def test_reading_goes_on_after_damage():
    own = records(6)
    frames = [zstandard.ZstdCompressor(write_checksum=True).compress(r) for r in own]
    broken = bytearray(frames[2])
    broken[len(broken) // 2] ^= 0xFF
    ids, errors = read_ids(b"".join([*frames[:2], bytes(broken), *frames[3:]]))
    assert ids == [0, 1, 3, 4, 5] and errors
    ids, errors = read_ids(b"junk" + b"".join(frames[:3]) + b"\0\0\0" + b"".join(frames[3:]) + frames[0][:-9])
    assert ids == [0, 1, 2, 3, 4, 5] and len(errors) == 3


def test_a_damaged_dictionary_is_one_error():
    packed = bytearray(warc.dictionary_frame(b"some dictionary " * 40))
    packed[-20:] = b"\xff" * 20
    ids, errors = read_ids(bytes(packed) + archive(records(4)))
    assert ids == [0, 1, 2, 3] and len(errors) == 1
    ids, errors = read_ids((warc.DICTIONARY_FRAME.to_bytes(4, "little") + (9_999).to_bytes(4, "little") + b"x") + archive(records(4)))
    assert ids == [0, 1, 2, 3] and len(errors) == 1


def test_a_record_beyond_the_limit_is_told_and_passed():
    big = warc.record_bytes(9, "u", b"z" * 100_000, None, False, "2024-01-01T00:00:00Z")
    rows = list(warc.read_archive(archive([*records(2), big, *records(2)]), most=50_000))
    assert [bool(r["error"]) for r in rows] == [False, False, True, False, False]


def test_records_of_other_writers():
    def record(fields, block):
        return "".join(["WARC/1.0\r\n", *(f"{k}: {v}\r\n" for k, v in fields.items()), f"Content-Length: {len(block)}\r\n\r\n"]).encode() + block + b"\r\n\r\n"

    base = {"WARC-Record-ID": "<urn:uuid:1>", "WARC-Date": "2020-01-01T00:00:00Z"}
    made = [
        record(base | {"WARC-Type": "warcinfo", "Content-Type": "application/warc-fields"}, b"software: x\r\n"),
        record(base | {"WARC-Type": "response", "Content-Type": "application/http; msgtype=response"}, b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\nabc"),
        record(base | {"WARC-Type": "revisit", "Content-Type": "application/http;msgtype=response"}, b"HTTP/1.1 200 OK\r\n\r\n"),
    ]
    rows = list(warc.read_archive(archive(made)))
    assert [(r["record_type"], r["payload"], r["record_id"], r["error"]) for r in rows] == [
        ("warcinfo", b"software: x\r\n", "<urn:uuid:1>", None),
        ("response", b"abc", "<urn:uuid:1>", None),
        ("revisit", None, "<urn:uuid:1>", None),
    ]


def test_null_page_ids_and_common_payloads(spark, monkeypatch):
    from docflow.llm import common

    monkeypatch.setattr(common, "HOT_ROWS", 20)
    monkeypatch.setattr(common, "HOT_KEYS", 4)
    rows = [(i, f"u{i}", "same" if i % 2 else f"own {i % 30}") for i in range(120)] + [(None, "u", "same"), (None, "u", "only"), (None, "v", "only")]
    got = told(warc.round_trip(page(spark, rows)).collect())
    first = {}
    for i, _, h in rows:
        if i is not None:
            first[h] = min(i, first.get(h, i))
    kinds = sorted(((i, "response" if h not in first or first[h] == i else "revisit", None if h not in first or first[h] == i else first[h]) for i, _, h in rows), key=repr)
    assert sorted(((r[0], r[3], r[4]) for r in got), key=repr) == kinds


def pieces(data, ahead):
    import pyarrow as pa

    return warc.Pieces(pa.BufferReader(data), ahead)


@pytest.mark.parametrize("ahead", [1, 7, 1 << 20])
def test_archives_by_pieces_give_what_whole_ones_give(ahead):
    other = (0x184D2A51).to_bytes(4, "little") + (9).to_bytes(4, "little") + b"x" * 9
    dictionary = warc.train_dictionary(records() * 10)
    good = archive(records(), dictionary)
    hurt = bytearray(archive(records(8)) + b"junk" + other + archive(records(3)))
    hurt[200:210] = b"\0" * 10
    for data in (good, good[:-5], bytes(hurt), b"", b"\0\1\2\3rest", warc.dictionary_frame(b"x" * 100)[:20]):
        assert list(warc.read_archive(pieces(data, ahead))) == list(warc.read_archive(data))


def test_the_next_frame_is_found_across_pieces():
    magic = warc.ZSTD_FRAME.to_bytes(4, "little")
    for before in range(0, 30):
        data = b"." * before + magic + b"..." + magic
        assert warc._next_frame(memoryview(data), 0, 8) == before
        assert warc._next_frame(pieces(data, 2), before + 1, 8) == before + 7
        assert warc._next_frame(memoryview(data), before + 8, 8) == len(data)


def test_large_archives_are_opened_by_tasks(spark, tmp_path):
    (tmp_path / "a.warc.zst").write_bytes(archive(records(20), warc.train_dictionary(records() * 10)))
    (tmp_path / "b.warc.zst").write_bytes(archive(records(2)))
    want = {tuple(r) for r in warc.read_warc(spark, str(tmp_path)).collect()}
    edge = (tmp_path / "b.warc.zst").stat().st_size
    got = warc.read_warc(spark, str(tmp_path), large=edge).collect()
    assert len(got) == 22 and {tuple(r) for r in got} == want
    assert {tuple(r) for r in warc.read_warc(spark, str(tmp_path), large=0).collect()} == want


def test_a_long_archive_takes_the_memory_of_a_piece(tmp_path):
    import os
    import subprocess
    import sys

    path = tmp_path / "long.warc.zst"
    body = [warc.record_bytes(i, "u", os.urandom(1 << 20), None, False, "2024-01-01T00:00:00Z") for i in range(4)]
    part = archive(body)
    with path.open("wb") as out:
        for _ in range(80):
            out.write(part)
    program = f"""
import resource
from pyarrow import fs
from docflow.llm import warc
with fs.LocalFileSystem().open_input_file({str(path)!r}) as f:
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    n = sum(r["error"] is None for r in warc.read_archive(warc.Pieces(f)))
print(n, (resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before) >> 10)
"""
    done = subprocess.run([sys.executable, "-c", program], capture_output=True, text=True, timeout=300, check=True)
    n, grown = map(int, done.stdout.split())
    assert n == 320 and grown < 100
