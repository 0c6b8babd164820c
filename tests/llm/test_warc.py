import hashlib

import pytest

from regista.llm import warc
from regista.workspace import run_folder

PAGES = [(1, "http://a", "short"), (2, None, None), (3, "u", ""), (10, "http://b", "a" * 1000), (12, "http://c", "a" * 1000),
         (11, "http://d", "a" * 1000), (13, "e\r\nX: y", "b" * 999), (14, "f", "b" * 999), (15, "g", "é" * 40000),
         (16, "h", "é" * 40000), (17, "i", "x\r\n\r\nWARC/1.1\r\nContent-Length: 5\r\n\r\n" * 900), (18, "j", "0\r\n\r\n" * 3000)]


def _expected(rows):
    out = []
    for page, _, html in rows:
        data = (html or "").encode()
        last = max(p for p, _, h in rows if (h or "").encode() == data)
        revisit = len(data) >= 1000 and page != last
        out.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", last if revisit else None))
    return sorted(out)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame(PAGES, "page_id bigint, url string, html string").selectExpr("*", "1 AS segment", "'x' AS record")


@pytest.mark.parametrize("segment", [1000, warc.SEGMENT_BYTES])
def test_round_trip(pages, segment):
    assert sorted(map(tuple, warc.round_trip(pages.repartition(3), segment).collect())) == _expected(PAGES)


def test_repeated_rows_and_null_ids(spark):
    rows = [(5, "u", "z" * 2000)] * 3 + [(None, "u", "z" * 2000), (None, "u", "small")]
    got = sorted(map(tuple, warc.round_trip(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()), key=str)
    assert [g[3] for g in got if g[0] == 5].count("response") == 1
    assert [(g[0], g[4]) for g in got if g[3] == "revisit"] == [(5, 5), (5, 5), (None, 5)]
    assert len(got) == 5


def test_empty_table(pages):
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 7, 4096])
def test_chunked_framing(size):
    for payload in (b"", b"x", bytes(range(256)) * 40):
        assert warc.dechunked(warc.chunked(payload, size)) == payload
    assert warc.dechunked(b"3;name=value\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    for broken in (b"", b"5\r\nabc\r\n0\r\n\r\n", b"3\r\nabc", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.dechunked(broken)


def test_faulty_segments_are_told(spark, tmp_path):
    block = warc._HTTP + warc.chunked(b"payload " * 100)
    good = hashlib.sha1(b"payload " * 100).hexdigest()

    def segments(name, cuts, total=len(block), digest=good, leave_out=(), repeat=()):
        out = []
        for i, (s, e) in enumerate(zip(cuts, cuts[1:]), 1):
            if i in leave_out:
                continue
            fields = dict(Segment_Number=i)
            if i == 1:
                fields["Payload_Digest"] = f"sha1:{digest}"
            else:
                fields["Segment_Origin_ID"] = f"<{name}>"
            if e == len(block):
                fields["Segment_Total_Length"] = total
            kind = "response" if i == 1 else "continuation"
            out += [warc._record(kind, name if i == 1 else f"{name}:{i}", block[s:e], **fields)] * (2 if i in repeat else 1)
        return out

    cuts = [0, 100, 300, 500, len(block)]
    records = [*segments("urn:page:1:0", cuts)[::-1], *segments("urn:page:2:0", cuts, leave_out=(2,)),
               *segments("urn:page:3:0", cuts, leave_out=(4,)), *segments("urn:page:4:0", cuts, total=len(block) + 1),
               *segments("urn:page:5:0", cuts, digest="0" * 40), *segments("urn:page:6:0", cuts, repeat=(2, 3)),
               warc._record("revisit", "urn:page:7:0", b"", Payload_Digest=f"sha1:{good}", Refers_To="<urn:page:1:0>"),
               warc._record("revisit", "urn:page:8:0", b"", Payload_Digest=f"sha1:{good}", Refers_To="<urn:page:9:0>")]
    folder = run_folder(spark, "faulty")
    rows = spark.createDataFrame([(bytearray(r),) for r in records], "record binary").repartition(4)
    rows.selectExpr("CAST(record AS string)").write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(folder)
    got = {r.record: (r.payload_bytes, r.fault) for r in warc.read_archives(spark, folder).collect()}
    assert {k for k, v in got.items() if v[1] is None} == {"urn:page:1:0", "urn:page:6:0", "urn:page:7:0"}
    assert all(got[f"urn:page:{i}:0"] == (800, None) for i in (1, 6, 7))
    assert len(got) == 8
