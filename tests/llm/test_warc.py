import gzip
import hashlib

import pytest

from shiplens.llm import warc
from shiplens.llm.warc import (ARC_FIELDS, arc_record, arc_version_block, convert, convert_pages, parse_arc, parse_warc,
                               read_warc, record_id, warc_date, write_arc)
from tests.llm.conftest import table

SCHEMA = "page_id long, url string, html string, record_type string, refers_to long"


def pages():
    big = "<p>é " + "x" * 1200
    return [(1, "http://a.example/ü b", big, "", 0), (2, None, "small", "", 0), (3, "http://b", "small", "", 0), (9, "u", big, "", 0),
            (4, "u", None, "", 0), (5, "u", "", "", 0), (6, "u", "WARC/1.1\r\n\r\n\n\nhttp://x 0.0.0.0 1 t 5\n" * 60, "", 0),
            (7, "u", "y" * 999, "", 0), (8, "u", "y" * 999, "", 0), (None, "u", big, "", 0), (10, "u", "z" * 200_000, "", 0),
            (11, "u", "z" * 200_000, "", 0), (9, "u", big, "", 0)]


def brute(rows):
    top = {}
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        if len(b) >= 1000 and i is not None:
            top[b] = max(i, top.get(b, i))
    out = []
    for i, _, h, *_ in rows:
        b = (h or "").encode()
        t = top.get(b)
        again = t is not None and t != i
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", t if again else None))
    return sorted(out, key=lambda r: tuple((x is not None, x) for x in r))


COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@pytest.mark.parametrize("archive_bytes", [16 << 20, 2000])
def test_round_trip(spark, monkeypatch, archive_bytes):
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", archive_bytes)
    df = spark.createDataFrame(pages(), SCHEMA).repartition(3)
    assert table(convert_pages(df)[1], *COLS) == brute(pages())


def test_empty_table(spark):
    assert table(convert_pages(spark.createDataFrame([], SCHEMA))[1]) == []


@pytest.mark.parametrize("version", ["1", "2"])
def test_arc_versions_are_cut_by_length(version):
    html = b"a\n\nhttp://fake 0.0.0.0 20200101000000 text/html 3\nxyz"
    data = arc_version_block("f.arc.gz", version) + b"\n" + arc_record(version, "f", 0, "http://x y", 7, html) + b"\n" + \
        arc_record(version, "f", 9, None, 8, b"") + b"\n"
    got = list(parse_arc(data))
    assert [list(f) for f, _ in got] == [ARC_FIELDS[version]] * 3
    assert got[1][1].endswith(html) and got[1][0]["URL"] == "http://x%20y" and got[2][0]["URL"] == "-"
    with pytest.raises(ValueError):
        list(parse_arc(data[:-30]))
    with pytest.raises(ValueError):
        list(parse_arc(b"http://x 0 0 t 1\nx\n"))


def test_files_are_warc(spark, tmp_dir):
    """The files themselves: gzip, CRLF headers, linked record ids, types, dates, digests."""
    df = spark.createDataFrame(pages(), SCHEMA).coalesce(1)
    write_arc(df, f"{tmp_dir}/arc")
    convert(spark, f"{tmp_dir}/arc", f"{tmp_dir}/warc")
    import glob
    files = glob.glob(f"{tmp_dir}/warc/*/*.gz")
    data = gzip.decompress(open(files[0], "rb").read())
    got = list(parse_warc(data))
    assert len(files) == 1 and len(got) == len(pages()) + 1 and data.endswith(b"\r\n\r\n")
    assert got[0][0]["WARC-Type"] == "warcinfo"
    ids = {h["WARC-Record-ID"]: h for h, _ in got}
    again = [h for h, _ in got if h["WARC-Type"] == "revisit"]
    assert again and all(ids[h["WARC-Refers-To"]]["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] for h in again)
    assert all(h["WARC-Date"] == "2024-01-01T00:00:00Z" for h, _ in got)
    assert read_warc(spark, f"{tmp_dir}/warc").count() == len(pages())


def test_dates_and_ids():
    assert warc_date("19970417") == "1997-04-17T00:00:00Z" and warc_date("199704") == "1997-04-01T00:00:00Z"
    assert warc_date("20050102030405") == "2005-01-02T03:04:05Z"
    assert record_id("a") == record_id("a") != record_id("b")
