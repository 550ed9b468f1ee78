import hashlib
import re

import pytest

from tidemill.llm.warc import page_of, page_records, read_warc, write_warc
from tidemill.session import scratch_dir

BIG = "<p>é&\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n" * 60
SCHEMA = "page_id long, url string, html string, key string, digest string, size int, latest int"


def archives(spark, rows):
    path = scratch_dir(spark, "test-warc")
    write_warc(page_records(spark.createDataFrame([(*r, "k", "d", 1, 2) for r in rows], SCHEMA)), path)
    return path


ROWS = [
    (1, "http://a\r\nb", BIG), (2, None, BIG), (7, "u", BIG), (None, "x", BIG), (4, "u", None), (5, "u", ""), (6, "u", "s"),
    (8, "u", "s"), (-3, "u", BIG + "x"), (9, "u", BIG * 400), (10, "u", "<" * 999), (11, "u", "<" * 999),
    (12, "u", "<" * 1000), (13, "u", "<" * 1000), (13, "u", "<" * 1000),
]


def test_round_trip(spark):
    got = read_warc(spark, archives(spark, ROWS)).withColumns({"p": page_of("record_id"), "q": page_of("refers_to")}).collect()
    expected = []
    for key, _, html in ROWS:
        raw = (html or "").encode()
        latest = max((k for k, _, h in ROWS if k is not None and h == html), default=None)
        again = len(raw) >= 1000 and key != latest
        expected.append((key, "revisit" if again else "response", latest if again else None, len(raw),
                         "sha1:" + hashlib.sha1(raw).hexdigest(), None if again else raw))
    key = lambda r: str(r[:5])
    assert sorted(((r.p, r.record_type, r.q, r.payload_length, r.payload_digest, None if r.payload is None else bytes(r.payload)) for r in got), key=key) == sorted(expected, key=key)
    assert {r.target_uri for r in got} == {"http://a%0D%0Ab", None, "u", "x"}


def test_predicates_are_pushed(spark):
    path = archives(spark, ROWS)
    some = read_warc(spark, path).where("record_type = 'revisit' and target_uri = 'u' and content_length >= 10 and record_id like 'urn:x-page:1%'")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"\bFilter\b", plan)
    assert {r.record_id for r in some.collect()} == {"urn:x-page:12"}
    assert read_warc(spark, path).where("record_type in ('response', 'x') and payload is not null").count() == 11
    assert read_warc(spark, path, payload=False).where("payload is not null").count() == 0


def test_cut_archives_fail(spark, tmp_path):
    for name, body in (("a", b"WARC/1.1\r\nContent-Length: 10\r\n\r\nabc"), ("b", b"no record\r\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.warc").write_bytes(body)
        with pytest.raises(Exception, match="record"):
            read_warc(spark, str(tmp_path / name)).collect()


def test_empty_table(spark):
    assert read_warc(spark, archives(spark, [])).count() == 0
