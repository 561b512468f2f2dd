"""WARC archives: round trips, revisits, coalesced reads."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemart.llm import files, queries, warc
from tidemart.session import new_shared_path

PAGES = "page_id long, url string, html string"
BODY = "<p>" + "tide " * 40 + "</p>"


def archive(spark, rows, schema=PAGES, **options):
    return warc.write_archive(spark.createDataFrame(rows, schema).repartition(3), new_shared_path(spark, "warc"), **options)


def expected(rows, least=100):
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        equals = [k for k, _, other in rows if (other or "").encode() == data]
        named = [k for k in equals if k is not None]
        first = min(named) if named and len(data) >= least and len(equals) > 1 else None
        visit = first is not None and key != first
        out.append((key, len(data), hashlib.sha256(data).hexdigest(), "revisit" if visit else "response", first if visit else None))
    return sorted(out, key=repr)


ROWS = [
    (5, "http://a/5", BODY), (3, "http://a/3", BODY), (9, None, BODY), (None, "http://a/n", BODY), (3, "http://a/3", BODY),
    (10, "http://a/ü?q=1&r=a b\r\nWARC-Type: fake", "é" * 60), (11, "", "é" * 60), (12, "u", "é" * 49), (13, "u", "é" * 49),
    (14, "u", None), (15, "u", ""), (16, "u", "WARC/1.1\r\n\r\n" + "x" * 200_000), (17, "u", "WARC/1.1\r\n\r\n" + "x" * 200_000), (-1, "u", "\x00\n\r\n\r\n" * 50), (None, None, "z" * 300), (None, None, "z" * 300),
]


def test_round_trip_of_odd_rows(spark):
    index = archive(spark, ROWS)
    records = warc.read_records(index)
    got = records.select(F.col("key").cast("long"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast("long"))
    assert sorted(map(tuple, got.collect()), key=repr) == expected(ROWS)
    full = warc.with_payloads(records).collect()
    assert len(full) == len(ROWS)
    texts = sorted(((None if row.key is None else int(row.key)), bytes(row.payload).decode()) for row in full if row.key is not None)
    assert texts == sorted((key, html or "") for key, _, html in ROWS if key is not None)


def test_query_is_its_operator(spark, tmp_path):
    spark.createDataFrame(ROWS, PAGES).write.parquet(f"{tmp_path}/pages.parquet")
    assert sorted(map(tuple, queries.op13_warc_index(spark, str(tmp_path)).collect()), key=repr) == expected(ROWS)


def test_selected_records_only(spark):
    rows = [(key, f"http://h/{key}", f"<p>{key}</p>" + "tide " * 100) for key in range(400)]
    index = archive(spark, rows)
    some = warc.read_records(index.filter("page_id % 7 = 3")).collect()
    assert sorted(int(row.key) for row in some) == list(range(3, 400, 7))
    assert all(bytes(row.payload).decode() == rows[int(row.key)][2] for row in some)
    assert warc.read_records(index.limit(0)).collect() == []


def test_index_names_what_stands_in_the_files(spark):
    index = archive(spark, ROWS).collect()
    assert len(index) == len(ROWS)
    for file in {row.file for row in index}:
        lines = sorted((row.offset, row.length) for row in index if row.file == file)
        data = files.read(file)
        assert lines[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(lines, [*lines[1:], (len(data), 0)], strict=True))
        assert gzip.decompress(data).count(b"WARC-Type: re") == len(lines)


def test_neighbours_are_read_together():
    lines = [("a", 0, 10), ("a", 10, 10), ("a", 25, 5), ("a", 1000, 10), ("b", 1010, 5), ("b", 1015, 900), ("b", 1915, 5)]
    assert list(warc.coalesced(lines, gap=5, run=100)) == [("a", 0, 30, [0, 1, 2]), ("a", 1000, 1010, [3]), ("b", 1010, 1015, [4]), ("b", 1015, 1915, [5]), ("b", 1915, 1920, [6])]
    assert list(warc.coalesced([], gap=5, run=100)) == []
    assert list(warc.coalesced([("a", 3, 4), ("a", 3, 4)], gap=0, run=10)) == [("a", 3, 7, [0, 1])]


def test_damaged_records_are_errors(tmp_path):
    text = warc.record("1", "u", b"payload", hashlib.sha256(b"payload").hexdigest(), None, "1970-01-01T00:00:00Z")
    assert warc.parse(gzip.compress(text)).payload == b"payload"
    for bad in (text.replace(b"payload\r\n\r\n", b"pAyload\r\n\r\n"), text[:-6] + b"\r\n\r\n", b"no record"):
        with pytest.raises(ValueError):
            warc.parse(gzip.compress(bad))
    path = tmp_path / "short"
    path.write_bytes(b"12345")
    assert files.read_range(str(path), 1, 3) == b"234"
    with pytest.raises(OSError):
        files.read_range(str(path), 3, 9)


def test_text_keys_clashing_columns_and_empty_tables(spark):
    rows = [("b", "u", BODY, 1), ("a: \r\n+%41", "u", BODY, 2)]
    records = warc.read_records(archive(spark, rows, "page_id string, url string, html string, digest int")).collect()
    assert {(row.key, row.refers_to) for row in records} == {("a: \r\n+%41", None), ("b", "a: \r\n+%41")}
    assert warc.read_records(archive(spark, [])).collect() == []
