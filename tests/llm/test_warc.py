from __future__ import annotations

import hashlib

import fixtures
from tallyforge.llm import warc

PAGES = "page_id long, url string, html string, page string, digest string"


def page_rows():
    big, other = "<p>" + "a" * 2000, "é" * 500
    return [
        (1, "http://a.B.c/x?y", big),
        (2, "http://a.B.c/x?y", big),
        (3, None, big),
        (None, "x\r\ny\tz", big),
        (5, "", None),
        (5, "", None),
        (6, "h://q", "é\r\n\r\nWARC/1.1\r\n" * 100),
        (7, "http://a.B.c/x?y", other),
        (8, "http://d.e/", other),
        (8, "http://d.e/", other),
        (9, "http://d.e/", "b" * 999),
        (10, "http://d.e/", "b" * 999),
        (11, "http://d.e/", ""),
        (12, "http://f.g/%20?a#b", "x" * 300_000),
    ]


def expected(rows):
    stored = {}
    for page, _, html in rows:
        if html and len(html.encode()) >= 1000 and page is not None:
            stored[html] = max(stored.get(html, page), page)
    out = []
    for page, _, html in rows:
        data, first = (html or "").encode(), stored.get(html)
        revisit = first is not None and page != first
        out.append(
            (page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
        )
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", "x") for row in rows], PAGES)


def test_round_trip(spark):
    got = warc.archive_report(frame(spark, page_rows())).collect()
    named = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(row[n] for n in named) for row in got), key=repr) == expected(page_rows())
    assert warc.archive_report(frame(spark, [])).collect() == []


def test_all_pages_without_an_id(spark):
    rows = [(None, "http://a/", "z" * 1500)] * 3
    got = warc.archive_report(frame(spark, rows)).collect()
    assert [(row.record_type, row.refers_to) for row in got] == [("response", None)] * 3


def test_lookup_in_small_blocks_and_directory_slices(spark, tmp_path):
    rows = [(k, f"http://h{k % 5}.example.com/{k % 7}", f"page {k}") for k in range(200)]
    rows += [(k, "http://hot.example.com/", "same") for k in range(1000, 1060)]
    pages = frame(spark, rows)
    archives = str(tmp_path / "archives")
    warc.write_archives(warc.records(pages, "2024-01-01T00:00:00Z"), archives, file_bytes=4000)
    index = warc.build_index(spark, archives, block_lines=8)
    assert index.directory.count() >= len(rows) / 8
    keys = fixtures.scanned(spark, warc.capture_keys(pages.filter("page_id % 3 = 0")))
    missing = spark.createDataFrame([("aaa)/\tnone",), ("zzz)/\tnone",)], "key string")
    for slices in (1 << 18, 5):
        places = warc.locate(index, keys.union(missing), directory_rows=slices)
        pages_read = sorted(int(row.page) for row in warc.read_records(index, places).collect())
        assert pages_read == sorted(row[0] for row in rows if row[0] % 3 == 0)


def test_a_lookup_opens_only_the_files_it_needs(spark, tmp_path):
    rows = [(k, f"http://h{k}.example.com/", f"page {k} " * 50) for k in range(300)]
    archives = str(tmp_path / "archives")
    warc.write_archives(warc.records(frame(spark, rows), "2024-01-01T00:00:00Z"), archives, file_bytes=4000)
    index = warc.build_index(spark, archives, block_lines=8)
    assert len(list((tmp_path / "archives").glob("*.txt"))) > 20
    keys = fixtures.scanned(spark, warc.capture_keys(frame(spark, rows[7:8])))
    places = fixtures.scanned(spark, warc.locate(index, keys))
    by_file = places.groupBy("path").count()
    assert len(warc.wanted_files(index, by_file, 1).inputFiles()) == 1
    (row,) = warc.read_records(index, places).collect()
    assert row.page == "7" and row.payload_bytes == len(rows[7][2])


def test_large_pages_among_small_ones(spark, tmp_path, monkeypatch):
    """Pages of many megabytes make no large file of the small ones around them."""
    rows = [(k, f"http://a.com/{k}", f"page {k}") for k in range(400)]
    rows += [(1000 + k, f"http://b.com/{k}", chr(97 + k) * (6 << 20)) for k in range(5)]
    archives = tmp_path / "archives"
    monkeypatch.setattr(warc, "MOST_BYTES", 16 << 20)
    warc.write_archives(warc.records(frame(spark, rows).coalesce(1), "2024-01-01T00:00:00Z"), str(archives), file_bytes=1 << 20)
    sizes = sorted(path.stat().st_size for path in archives.glob("*.txt"))
    assert sizes[-1] < 16 << 20 and sum(size > 1 << 20 for size in sizes) == 3 and len(sizes) < 20
    got = warc.archive_report(frame(spark, rows)).collect()
    named = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(row[n] for n in named) for row in got), key=repr) == expected(rows)


def test_archives_are_valid_records(spark, tmp_path):
    archives = tmp_path / "archives"
    warc.write_archives(warc.records(frame(spark, page_rows()), "2024-01-01T00:00:00Z"), str(archives))
    count = 0
    for path in archives.glob("*.txt"):
        data, at = path.read_bytes(), 0
        while at < len(data):
            assert data.startswith(b"WARC/1.1\r\n", at)
            record, at = warc.parse_record(data, at)
            assert data[at - 4 : at] == b"\r\n\r\n"
            count += 1
            if record.headers["WARC-Type"] == "revisit":
                assert record.headers["WARC-Profile"] == warc.PROFILE and not record.payload
    assert count == len(page_rows())


def test_keys_sort_by_reversed_host():
    assert warc.capture_key("http://www.Example.net/a?b", "id") == "net,example,www)/a?b\tid"
    assert warc.capture_key("plain", "id") == "plain\tid"
