import base64
import hashlib
import uuid

import pytest

from mercato.llm import warc
from mercato.session import ensure_checkpoint_dir

SCHEMA = "page_id long, url string, html string, h int"


def expected(rows):
    first = {}
    for page, _, html, _ in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, _, html, _ in rows:
        data, keeper = (html or "").encode(), first.get(html or "")
        response = keeper is None or page == keeper
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(),
                    "response" if response else "revisit", None if response else keeper))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def tricky_rows():
    magic = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    rows = [(1, "http://a/", "plain é", 0), (2, None, None, 0), (3, "u\r\nX: y", "", 0), (4, "v", "plain é", 0),
            (None, "n", "only null", 0), (None, "n", "plain é", 0), (5, "m", magic, 0), (6, "m2", "x" + magic * 3, 0),
            (7, "m", magic, 0), (8, "t", "WARC/1.1\r\n", 0), (9, "e", "\r\n\r\n" * 3, 0), (9, "e", "\r\n\r\n" * 3, 0)]
    return rows + [(100 + k, f"http://x/{k}", f"<p>{k}</p>" * (k % 90) + magic * (k % 3), 1) for k in range(400)]


def test_round_trip_with_magic_in_payloads(spark):
    rows = tricky_rows()
    assert result(warc.archived_pages(spark.createDataFrame(rows, SCHEMA))) == expected(rows)


def test_round_trip_over_many_splits(spark):
    """Splits of a few hundred bytes cut headers, payloads and record starts anywhere."""
    rows = tricky_rows()
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    path = f"{ensure_checkpoint_dir(spark)}/archives/{uuid.uuid4().hex}"
    warc.write_archives(spark.createDataFrame(rows, SCHEMA).coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        assert result(warc.read_archives(spark, path)) == expected(rows)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_smaller_payloads_are_all_responses(spark):
    rows = [(1, "a", "xx", 0), (2, "b", "xx", 0), (3, "c", "long enough", 0), (4, "d", "long enough", 0)]
    got = result(warc.archived_pages(spark.createDataFrame(rows, SCHEMA), min_bytes=5))
    assert [r[3:] for r in got] == [("response", None), ("response", None), ("response", None), ("revisit", 3)]


def test_empty_table(spark):
    assert warc.archived_pages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("data", ["", "a", "é" * 99])
def test_base32(spark, data):
    got = spark.createDataFrame([(data,)], "x string").select(warc.base32_sha1("x")).first()[0]
    assert got == base64.b32encode(hashlib.sha1(data.encode()).digest()).decode()
