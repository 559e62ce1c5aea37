"""WARC archives: round trip, revisits, and salvage of damaged files."""

import gzip
import hashlib
import io

import fixtures
import pytest
from pyspark.sql import types as T

from firstlight.llm import warc

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType()), T.StructField("payload", T.StringType())])


def pages():
    same, near = "<p>" + "é" * 600, "<p>" + "é" * 599 + "e"
    rows = [(i, f"http://x/{i}", f"<html>{i}" * (i + 1)) for i in range(25)]
    rows += [(100, "http://a", same), (101, None, same), (102, "http://b\r\nX: 1", same), (103, "u", near), (104, "u", "short"), (105, "u", "short")]
    rows += [(200, "u", None), (201, "u", ""), (202, "u", "WARC/1.1\r\n\r\n" * 200), (203, "u", "\r\n\r\n"), (None, "u", "no id"), (300, "u", "x" * 3_000_000)]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], PAGES).repartition(3)


def test_round_trip(spark):
    rows = pages()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(i, last.get(h or "", i))
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        revisit = len(raw) >= 1000 and i is not None and last[h] != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", last[h] if revisit else None))
    got = warc.round_trip(frame(spark, rows), roll_bytes=2000)
    assert fixtures.rows_of(got, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert warc.round_trip(frame(spark, [])).count() == 0


def archive(n=12, packed=True, size=700):
    records = [warc.encode_record(i, f"http://x/{i}", (f"page {i} " * size).encode(), None) for i in range(n)]
    parts = [warc.gzip_member(r) if packed else r for r in records]
    starts = [sum(map(len, parts[:i])) for i in range(n + 1)]
    return b"".join(parts), starts


def read(raw, begin=0, end=None):
    found = list(warc.salvage(io.BytesIO(raw), len(raw), begin, end))
    return [x["page_id"] for x in found if "gap_reason" not in x], [(x["gap_begin"], x["gap_end"]) for x in found if "gap_reason" in x]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage(packed):
    raw, starts = archive(packed=packed)
    assert read(raw) == (list(range(12)), [])
    at = (starts[4] + starts[5]) // 2
    damaged = raw[:at] + bytes(x ^ 0x55 for x in raw[at : at + 8]) + raw[at + 8 :]
    assert read(damaged) == ([*range(4), *range(5, 12)], [(starts[4], starts[5])])
    lost = raw[: starts[3] + 5] + raw[starts[6] + 9 :]
    gap = starts[7] - starts[6] - 9 + 5
    assert read(lost) == ([0, 1, 2, *range(7, 12)], [(starts[3], starts[3] + gap)])
    assert read(raw[:-3]) == (list(range(11)), [(starts[11], len(raw) - 3)])
    assert read(b"junk" + raw) == (list(range(12)), [(0, 4)])
    assert read(b"") == ([], []) and read(b"nothing here") == ([], [(0, 12)])


def test_a_false_length_is_found_out():
    good = warc.encode_record(1, "u", b"abc" * 500, None)
    bad = warc.encode_record(2, "u", b"abd" * 500, None).replace(b"\r\nContent-Length: ", b"\r\nContent-Length: 9", 1)
    raw = good + bad + warc.encode_record(3, "u", b"x", None)
    assert read(raw)[0] == [1, 3]


@pytest.mark.parametrize("packed", [True, False])
def test_ranges_share_a_file_without_loss(packed):
    raw, starts = archive(packed=packed)
    at = starts[6] + 20
    raw = raw[:at] + b"\x00" * 40 + raw[at + 40 :]
    for step in (50, 333, len(raw)):
        ids, gaps = [], []
        for b in range(0, len(raw), step):
            i, g = read(raw, b, min(len(raw), b + step))
            ids, gaps = ids + i, gaps + g
        assert ids == [*range(6), *range(7, 12)] and gaps == [(starts[6], starts[7])]


def test_other_readers_can_read_the_files(spark, tmp_path):
    manifest = warc.write_archives(warc.with_revisits(frame(spark, pages())), str(tmp_path / "w"))
    text = b"".join(gzip.open(r["path"]).read() for r in manifest.collect())
    assert text.count(b"WARC/1.1\r\nWARC-Type: ") == len(pages())
    listed = warc.read_archives(warc.archive_files(spark, str(tmp_path / "w")), range_bytes=500)
    assert listed.filter("gap_reason is not null").count() == 0
    assert sorted(r["page_id"] or -1 for r in listed.collect()) == sorted(i or -1 for i, _, _ in pages())
    path = manifest.first()["path"]
    whole = open(path, "rb").read()
    open(path, "wb").write(whole[: len(whole) // 2])
    gaps = warc.read_archives(warc.archive_files(spark, str(tmp_path / "w"))).filter("gap_reason is not null").collect()
    assert [(g["path"].endswith(path.rpartition("/")[2]), g["gap_end"]) for g in gaps] == [(True, len(whole) // 2)]
