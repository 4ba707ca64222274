import gzip
import hashlib
import uuid
from pathlib import Path

import pytest
from pyspark.errors import PythonException

from reportweave.llm import warc

SCHEMA = "page_id bigint, url string, html string, digest string, refers_to string, id string"
BIG = "<p>" + "é" * 200


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


ROWS = [
    (5, "http://a/b c\r\nX: y", BIG), (3, "http://b", BIG), (9, None, BIG), (1, "http://c", None), (2, "http://d", ""),
    (4, "http://e", "small"), (6, "http://f", "small"), (7, "http://g", "\r\n\r\nWARC/1.1\r\n\r\n" * 9000), (8, "u", "x" * 99),
    (10, "u", "x" * 99), (11, "u", "y" * 100), (12, "u", "y" * 100), (3, "http://b", BIG), (None, "n", BIG), (None, "n", "only " * 50),
]


def test_query(against_sql):
    against_sql("op8_warc")


def test_edges_and_files(spark, tmp_path):
    folder = str(tmp_path / uuid.uuid4().hex)
    index = warc.write_archives(pages(spark, ROWS), folder)
    got = warc.resolve(warc.read_records(index, folder)).collect()
    assert len(got) == len(ROWS)
    by_digest = {}
    for i, _, html in ROWS:
        if i is not None:
            by_digest.setdefault(html or "", []).append(i)
    expected = []
    for i, _, html in ROWS:
        body = (html or "").encode()
        first = min(by_digest.get(html or "", [None]), key=lambda x: x or 0)
        again = len(body) >= 100 and first is not None and i != first
        expected.append((i, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    key = repr
    assert sorted((tuple(r) for r in got), key=key) == sorted(expected, key=key)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in Path(folder).glob("*.warc.gz"))
    assert whole.count(b"WARC-Type: revisit\r\n") == sum(e[3] == "revisit" for e in expected)
    assert b"http://a/b%20c%0D%0AX:%20y\r\n" in whole


def test_selected_records_and_damage(spark, tmp_path):
    folder = str(tmp_path / uuid.uuid4().hex)
    index = warc.write_archives(pages(spark, ROWS), folder)
    picked = warc.read_records(index.where("page_id IN (3, 7)"), folder).collect()
    assert sorted(r.page_id for r in picked) == [3, 3, 7]
    assert {bytes(r.payload) for r in picked} == {BIG.encode(), ROWS[7][2].encode()}
    assert warc.read_records(index.where("false"), folder).count() == 0
    with pytest.raises(PythonException):
        warc.read_records(index.selectExpr("archive", "offset + 1 AS offset", "length"), folder).collect()
    nothing = warc.write_archives(pages(spark, ROWS).where("false"), folder + "2")
    assert nothing.count() == 0


def test_ranges_are_coalesced():
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array(["a", "a", "a", "b"]), pa.array([0, 10, 900_000, 5]), pa.array([10, 10, 5, 5])], ["archive", "offset", "length"]
    )
    assert list(warc._ranges(batch)) == [
        ("a", 0, 20, [(0, 10), (10, 10)]), ("a", 900_000, 900_005, [(900_000, 5)]), ("b", 5, 10, [(5, 5)])
    ]


def test_record_round_trip():
    raw = warc.build_record(7, "http://x", b"a\r\n\r\nb", "d", None)
    headers, payload = warc.parse_record(raw)
    assert payload == b"a\r\n\r\nb" and headers["WARC-Record-ID"] == "<urn:page:7>"
    assert warc.parse_record(warc.build_record(None, None, b"zz", "d", 4))[1] == b""
